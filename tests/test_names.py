from pyspark.sql import functions as F

import pytest

from feedspark.functions.names import feed_matches, name_date, qualified_roots, relative_path, select_names
from feedspark.sources.feeds import scan_feed

from .conftest import envelope, write_doc


def test_feed_word_and_date(spark):
    names = [
        ("DS-OO-NATIONAL-ADVERTISERFEED-20171217-100000",),
        ("ds-oo-national-advertiserfeed-20180101-000000",),
        ("DS-OO-NATIONAL-ADVERTISERFEED",),  # no date: left out
        ("DS-OO-NATIONAL-PROGRAMFEED-20190101-000000",),
        ("X-ADVERTISERFEED-2019123199",),  # longer run: first 8 digits
    ]
    df = spark.createDataFrame(names, "n string")
    out = df.select("n", feed_matches("n", "advertiser").alias("m"), name_date("n").alias("d")).collect()
    got = {r.n: (r.m, r.d) for r in out}
    assert got["DS-OO-NATIONAL-ADVERTISERFEED-20171217-100000"] == (True, 20171217)
    assert got["ds-oo-national-advertiserfeed-20180101-000000"] == (True, 20180101)
    assert got["DS-OO-NATIONAL-ADVERTISERFEED"] == (True, None)
    assert got["DS-OO-NATIONAL-PROGRAMFEED-20190101-000000"][0] is False
    assert got["X-ADVERTISERFEED-2019123199"] == (True, 20191231)
    kept = [r.n for r in df.where(select_names("n", "ADVERTISERFEED", since=20171231)).collect()]
    assert sorted(kept) == ["X-ADVERTISERFEED-2019123199", "ds-oo-national-advertiserfeed-20180101-000000"]


def test_relative_path_ignores_root(spark):
    df = spark.createDataFrame(
        [("file:/data/20991231-ADVERTISERFEED/landing/DS-PROGRAMFEED-20180101",), ("hdfs://nn:8020/data/20991231-ADVERTISERFEED/landing/sub/x",)],
        "p string",
    )
    rel = [r[0] for r in df.select(relative_path(F.col("p"), ["/data/20991231-ADVERTISERFEED/landing"])).collect()]
    assert rel == ["DS-PROGRAMFEED-20180101", "sub/x"]
    # a root on another file system does not match: an error, not a guess
    with pytest.raises(Exception, match="under none of the landing roots"):
        df.select(relative_path(F.col("p"), ["hdfs://nn:8020/data/20991231-ADVERTISERFEED/landing/"])).collect()


@pytest.mark.parametrize("folder", ["land 20990101", "100% ADVERTISERFEED", "Zürich-20990101-feed", "a+b&c=d", "plain"])
def test_no_root_selects_or_dates_a_file(spark, tmp_path, folder, monkeypatch):
    root = tmp_path / folder
    write_doc(root, "DS-ADVERTISERFEED-20180101", envelope(advertisers=[]))
    write_doc(root, "DS-PROGRAMFEED-20300101", envelope(feed="PROGRAM", programs=[]))
    monkeypatch.chdir(tmp_path)
    for spelled in (str(root), f"file://{root}/", str(root)[:-1] + "?"):
        docs = scan_feed(spark, spelled, "advertiser", since=20170101, multi_line=True)
        assert [r._feed_file for r in docs.select("_feed_file").collect()] == ["DS-ADVERTISERFEED-20180101"], spelled
        assert scan_feed(spark, spelled, "advertiser", since=20200101, multi_line=True).count() == 0
    assert len(qualified_roots(spark, [str(tmp_path / "*")])) == 1
