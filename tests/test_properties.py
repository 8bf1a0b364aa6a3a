"""Property tests: operators against brute force in plain Python on random
inputs (nulls, ties, repeated keys)."""
import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedspark.functions.names import name_date, select_names
from feedspark.operators.dedupe import first_seen
from feedspark.operators.keys import assign_ids

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
stamps = st.one_of(st.none(), st.integers(0, 3).map(lambda d: dt.datetime(2018, 1, 1 + d)))
names = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))
rows = st.lists(st.tuples(keys, keys, stamps, names, st.integers(0, 10**6)), min_size=0, max_size=40)


def _sort_key(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(rows)
def test_first_seen_is_min_per_key(spark, data):
    df = spark.createDataFrame(data, "k1 string, k2 string, extract_datetime timestamp, name string, seq long")
    got = sorted(map(tuple, first_seen(df, ["k1", "k2"], tiebreak=["name", "seq"]).collect()), key=repr)
    best = {}
    for r in data:
        order = (_sort_key(r[2]), _sort_key(r[3]), _sort_key(r[4]))
        k = (r[0], r[1])
        if k not in best or order < best[k][0]:
            best[k] = (order, r)
    want = sorted((v[1] for v in best.values()), key=repr)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.text("abc", min_size=0, max_size=3)), unique=True, max_size=60), st.integers(1, 7), st.integers(0, 100))
def test_assign_ids_is_rank_in_order(spark, data, parts, start):
    df = spark.createDataFrame(data, "tenant_id long, mo_id string")
    got = sorted(map(tuple, assign_ids(df, ["tenant_id", "mo_id"], start=start, num_partitions=parts).collect()))
    # strings order by UTF-8 bytes, as Spark (and DuckDB) do
    want = sorted((start + i, t, m) for i, (t, m) in enumerate(sorted(data, key=lambda r: (r[0], r[1].encode()))))
    assert got == want


name_text = st.builds(
    lambda a, b, c, d: a + b + c + d,
    st.sampled_from(["", "DS-OO-NATIONAL-", "x1234567-"]),
    st.sampled_from(["", "advertiserfeed", "ADVERTISERFEED", "AdvertiserFeed", "ADVERTISER", "PROGRAMFEED"]),
    st.sampled_from(["", "-", "-2017", "-20171217", "-201712171", "-123456789012"]),
    st.sampled_from(["", "-100000", ".json", "-99999999"]),
)


@SETTINGS
@given(st.lists(name_text, max_size=30), st.integers(0, 99999999))
def test_name_predicates_match_python(spark, data, since):
    df = spark.createDataFrame([(n,) for n in data], "n string")
    got = sorted((r.n, r.d, r.s) for r in df.select("n", name_date("n").alias("d"), select_names("n", "advertiser", since).alias("s")).collect())
    want = []
    for n in data:
        m = re.search("([0-9]{8})", n)
        d = int(m.group(1)) if m else None
        want.append((n, d, ("ADVERTISERFEED" in n.upper()) and d is not None and d > since))
    assert got == sorted(want)


feed_rows = st.lists(st.tuples(st.integers(0, 10**6), st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))), max_size=40, unique_by=lambda r: r[0])
dim_rows = st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), max_size=8)


@SETTINGS
@given(feed_rows, dim_rows, st.booleans())
def test_resolve_is_left_outer_join(spark, feed, dim, broadcast):
    from feedspark.operators.lookup import resolve

    f = spark.createDataFrame(feed, "seq long, k string")
    d = spark.createDataFrame(dim, "dim_id long, dim_k string")
    got = sorted(map(tuple, resolve(f, d, "k", "dim_k", broadcast=broadcast).select("seq", "k", "dim_id").collect()), key=repr)
    want = []
    for seq, k in feed:
        hits = [i for i, dk in dim if k is not None and dk == k]
        want += [(seq, k, i) for i in hits] or [(seq, k, None)]
    assert got == sorted(want, key=repr)


pairs = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["x", "y"])), st.one_of(st.none(), st.integers(0, 2))), max_size=15)


@SETTINGS
@given(pairs, pairs)
def test_new_rows_is_null_safe_anti_join(spark, new, old):
    from feedspark.sinks.tables import new_rows

    a = spark.createDataFrame(new, "mo_id string, client_id long")
    b = spark.createDataFrame(old, "mo_id string, client_id long")
    got = sorted(map(tuple, new_rows(a, b, ["mo_id", "client_id"]).collect()), key=repr)
    assert got == sorted([r for r in new if r not in set(old)], key=repr)
