"""Incremental loads: how often their rows move."""
import re

from pyspark.sql import functions as F

from feedspark.operators.dedupe import first_seen
from feedspark.plans import incremental as I


def exchanges(df):
    """Shuffles of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan))


def test_rows_of_entities_move_once_for_the_join_and_every_window(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(200).select(
            F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("string")).alias("id"), (F.col("id") % 3).alias("tenant"),
            (F.col("id") % 2).alias("other"), F.col("id").alias("extract_datetime"),
        )
        for kept, nulls in ((["1", "2"], False), (["1", None], True)):
            entities = spark.createDataFrame([(k,) for k in kept], f"{I._KEY} string")
            mine = I._of_entities(rows, "id", entities)
            want = rows.where(F.col("id").isin([k for k in kept if k]) | (F.col("id").isNull() & F.lit(nulls)))
            assert sorted(map(str, mine.collect())) == sorted(map(str, want.collect()))
            # by two keys that hold the entity: one shuffle a side, for the join
            both = first_seen(first_seen(mine, ["tenant", "id", "other"]), ["id", "tenant"])
            assert exchanges(both) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_differing_rows_are_those_without_an_equal_one(spark):
    wanted = spark.createDataFrame([("a", 1), ("b", None), (None, 3), ("n", 9)], "mo_id string, v long")
    have = spark.createDataFrame([("f1", 1, "a", 1), ("f1", 2, "b", 7), ("f2", 3, None, 3), ("f2", 4, "x", None), ("f2", 5, "x", None)], "_folder string, id long, mo_id string, v long")
    found = {tuple(r.asDict()[c] for c in ("mo_id", "v", "_folder", "id", "_wanted")) for r in I._differing(wanted, have).collect()}
    assert found == {("b", None, None, None, 1), ("n", 9, None, None, 1), ("b", 7, "f1", 2, 0), ("x", None, "f2", 4, 0), ("x", None, "f2", 5, 0)}


def test_known_rows_of_a_batch_are_found_by_the_hash_of_their_key(spark):
    known = spark.createDataFrame([("T", "a", "p"), ("T", "b", "q"), (None, "c", "r"), ("U", None, "s")], "tenant string, id string, rest string")
    batch = spark.createDataFrame([("T", "b"), (None, "c"), ("T", "z"), ("T", "b")], "tenant string, id string")
    found = {tuple(r) for r in I._of_keys(known, batch, ["tenant", "id"]).collect()}
    assert found == {("T", "b", "q"), (None, "c", "r")}


def test_first_run_derives_from_the_ledger_without_looking_for_entities(spark, tmp_path, monkeypatch):
    from feedspark.plans import loads
    from feedspark.plans.catalog import ParquetCatalog

    cat = ParquetCatalog(spark, str(tmp_path / "c"))
    cat.seed("tenant", spark.createDataFrame([(1, "T")], "id long, mo_id string"))
    rows = [("T", i, f"n{i % 4}", f"N{i}", "M", "K", "1") for i in range(8)]
    flat = spark.createDataFrame(rows, "tenant string, extract_datetime long, id string, name string, media string, type string, nielsen_code string")
    flat = flat.withColumn("extract_datetime", F.timestamp_seconds("extract_datetime"))
    looked = []
    was = I.reached
    monkeypatch.setattr(I, "reached", lambda *a: looked.append(a[1]) or was(*a))
    loads.load_destination(flat.where("name <> 'N1'"), cat, only_new=True)
    assert not looked and sorted(r.name for r in cat.read("network").collect()) == ["N0", "N2", "N3", "N5"]
    loads.load_destination(flat, cat, only_new=True)
    assert looked == ["network"] and sorted(r.name for r in cat.read("network").collect()) == ["N0", "N1", "N2", "N3"]


def test_a_changed_lookup_is_followed_without_merging_the_ledger(spark, tmp_path, monkeypatch):
    from feedspark.plans.catalog import ParquetCatalog

    cat = ParquetCatalog(spark, str(tmp_path / "c"))
    cat.seed("tenant", spark.createDataFrame([(1, "T"), (2, "U")], "id long, mo_id string"))
    rows = lambda *r: spark.createDataFrame(r, "tenant string, id string, extract_datetime timestamp, name string, media string, type string, nielsen_code string")
    with cat.transaction():
        cat.part("ledgers")["network"] = {"folders": [cat.store("l", rows(("T", "a", None, "x", "", "", ""))), cat.store("l", rows(("T", "a", None, "w", "", "", ""), ("U", None, None, "y", "", "", "")))], "rows": [1, 2]}
        cat.part("seen")["network"] = {"tenant": cat.folders("tenant")}
        cat.seed("tenant", spark.createDataFrame([(1, "T"), (3, "U")], "id long, mo_id string"))
        monkeypatch.setattr(I, "first_seen", None)
        assert [r[0] for r in I.reached(cat, "network", None).collect()] == [None]
