"""Collocations, alignment and tree search against plain versions."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from feedspark.llm import alignment, collocations, kdtree
from feedspark.llm.registry import op11_phrase_collocations

from .helpers import frame, lowered, odd

# --- collocations --------------------------------------------------------------


def plain_collocations(rows, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    f[lang or "und"][tuple(w[i : i + size])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i : i + size]] = max(held[p[i : i + size]], a)
        rows_ = []
        for p, a in cand.items():
            score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            if 100 * held[p] < 80 * a:
                rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows(seed=3):
    rng, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(30)] + ["New", "YORK", "é", "\x1c", "ünder"]
    for i in range(400):
        out = []
        for _ in range(rng.randrange(60)):
            out.append(rng.choice(["new york city hall", "of the", "a b c d e", *words]))
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"]))
        rows.append((i, "".join(out), rng.choice(["en", "en", "de", None, "und"])))
    return rows


def test_collocations_equal_plain_counts(spark):
    rows = phrase_rows()
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows), least=4).collect())
    assert got == plain_collocations([(t, lang) for _, t, lang in rows], least=4) and len(got) > 100


def test_spilled_and_burst_tries_count_the_same(spark, monkeypatch):
    rows = phrase_rows(4)
    for name, value in (("LIMIT", 50), ("BURST", 4), ("CHUNK", 200), ("MOST_BITS", 1 << 16)):
        monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(collocations.HatTrie.__init__, "__defaults__", (4,))
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows), top=7).collect())
    assert got == plain_collocations([(t, lang) for _, t, lang in rows], top=7)


def test_rare_phrases_of_frequent_words_are_not_shuffled(spark, monkeypatch):
    rng, merged, left = random.Random(9), collocations._merged, []
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=300)) + ". new york city", "en") for i in range(40)]

    def kept(runs, *rest):
        left.append(runs.where("phrase LIKE '% %'").count())
        return merged(runs, *rest)

    monkeypatch.setattr(collocations, "_merged", kept)
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows)).collect())
    assert got == plain_collocations([(t, lang) for _, t, lang in rows]) and len(got) == 1
    assert sum(left) < 500


def test_phrases_that_share_buckets_are_told_apart(spark, monkeypatch):
    rows = phrase_rows(5)
    for name, value in (("PAIR", 0), ("HELD", 100)):
        monkeypatch.setattr(collocations, name, value)
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows), least=6).collect())
    assert got == plain_collocations([(t, lang) for _, t, lang in rows], least=6) and len(got) > 50


def test_trie_bursts_and_spills_whole_subtrees():
    rng, trie, want = random.Random(1), collocations.HatTrie(burst=8), Counter()
    for _ in range(2000):
        row = (rng.randrange(5), rng.randrange(6), rng.randrange(9))
        trie.add([row], [2])
        want[row] += 2
    assert any(t[2] for t in trie.root.values()) and trie.size == len(want)
    left = trie.size // 2
    first = [x for tree in trie.spill(left) for x in tree]
    assert trie.size <= left and not {r[0] for r, _ in first} & set(trie.root)
    assert Counter(dict(first + [x for tree in trie.spill(0) for x in tree])) == want


def test_collocations_of_odd_rows(spark):
    df = odd(spark)
    rows = [(r.text, r.lang) for r in df.collect()]
    assert sorted(tuple(r) for r in collocations.mine(df, least=2).collect()) == plain_collocations(rows, least=2)
    empty = collocations.mine(df.limit(0))
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.collect() == []


def test_query_over_whole_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT text, lang FROM '{sf}/documents.parquet'").fetchall()
    assert sorted(tuple(r) for r in op11_phrase_collocations(spark, sf).collect()) == plain_collocations(rows)


# --- alignment -----------------------------------------------------------------


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(alignment.read_models())


def plain_alignment(a, text):
    """(ids and byte ends of A, of B) of a whole text, encoded at once."""
    if not text:
        return [], []
    x, y = a.first.encode(" " + text, add_special_tokens=False).ids, a.second.encode(text)
    p, q = ([t[i] for i in ids] for t, ids in ((a.bytes_a, x), (a.bytes_b, y)))
    if b"".join(p) != (" " + text).encode() or b"".join(q) != (" " + text).encode():
        return [], []
    ends = [np.cumsum([len(b) for b in v]).tolist() for v in (p, q)]
    return list(zip(x, ends[0])), list(zip(y, ends[1]))


def plain_measures(a, rows):
    docs, held = [], Counter()
    for id_, text in rows:
        x, y = plain_alignment(a, text)
        both = {e for _, e in x} & {e for _, e in y}
        groups, left, right = [], iter(x), iter(y)
        for _ in both:
            sides = []
            for side in (left, right):
                ids = []
                for i, e in side:
                    ids.append(str(i))
                    if e in both:
                        break
                sides.append(",".join(ids))
            groups.append("|".join(sides))
        links, starts = Counter(), [[0, *(e for _, e in v)] for v in (x, y)]
        j0 = 0
        for k, (i, e) in enumerate(x):
            while j0 < len(y) and y[j0][1] <= starts[0][k]:
                j0 += 1
            j = j0
            while j < len(y) and starts[1][j] < e:
                links[i, y[j][0]] += 1
                j += 1
        held.update(links.keys())
        docs.append((id_, len(x), len(y), len(groups), links, ";".join(groups)))
    top = Counter()
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    out = []
    for id_, n_a, n_b, n_groups, links, groups in docs:
        best = sum(n for p, n in links.items() if held[p] == top[p[0]])
        total = sum(n * held[p] for p, n in links.items())
        out.append((id_, n_a, n_b, n_groups, sum(links.values()), best, total, hashlib.sha256(groups.encode()).hexdigest() if n_a else ""))
    return sorted(out, key=str)


TEXTS = [
    "x", " ", "  a  b\n\n c ", "don't 'll \t", "日本 é\U0001f600é x", "<|endoftext|> </s> <s> <0x41> <unk>", "a▁b", "z\0k\x1cq \x85 w",
    "tab\tend ", " nbsp wide", "ﬁ ſ K ﷺ", "́ combining ́x", "123 4567 89", "...!!! ??", "über Ãœ Ġ", "1 " * 500, "x" * 3000,
]


def test_alignment_equals_whole_text_encodings(spark, aligner):
    import duckdb

    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows = list(enumerate([None, "", *TEXTS, TEXTS[0], *(t for (t,) in texts[:80])]))
    got = alignment.measure(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_measures(aligner, rows)


def test_small_blocks_and_caches_change_nothing(spark, aligner, monkeypatch):
    rows = [(i, f"{TEXTS[i % len(TEXTS)]} word{i % 7} the cat") for i in range(120)]
    want = plain_measures(aligner, rows)
    for name, value in (("BLOCK", 300), ("STEP", 100), ("CACHE", 5)):
        monkeypatch.setattr(alignment, name, value)
    got = alignment.measure(frame(spark, rows).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_groups_give_ranges_and_ids(spark, aligner):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for r in alignment.align(frame(spark, rows)).collect():
        x, y = plain_alignment(aligner, r.row.text)
        assert [i for g in r.groups for i in g.a] == [i for i, _ in x] and [i for g in r.groups for i in g.b] == [i for i, _ in y]
        assert [g.end for g in r.groups] == sorted({e for _, e in x} & {e for _, e in y})
        assert [g.start for g in r.groups] == [0, *(g.end for g in r.groups)][: len(r.groups)]


def test_alignment_of_odd_rows(spark, aligner):
    df = odd(spark)
    got = sorted((tuple(r) for r in alignment.measure(df).collect()), key=str)
    assert got == plain_measures(aligner, [(r.doc_id, r.text) for r in df.collect()])
    assert alignment.measure(df.limit(0)).collect() == [] and alignment.align(df.limit(0)).collect() == []
    assert alignment.measure(frame(spark, [(1, None), (2, "a▁b")])).select("n_links", "groups_sha256").collect() == [(0, ""), (0, "")]


def test_spans_cut_first_and_bytes_refine():
    size = np.array([2, 1, 1, 3])
    assert alignment.cuts(np.array([0, 1, 1, 4]), np.array([4, 4, 4, 7]), size).tolist() == [2, 3, 4, 7]
    assert alignment.cuts(np.array([0, 2, 3, 4]), np.array([2, 3, 4, 7]), size).tolist() == [2, 3, 4, 7]


# --- tree search ---------------------------------------------------------------


def vector_frame(spark, rows):
    kind = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
                        + [T.StructField(c, T.StringType()) for c in ("id", "v", "dim", "cell", "shard", "place", "rank", "score")])
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], kind)


def plain_top(rows, k=10, mod=100):
    import math

    whole = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = {(i, tuple(max(-(2**63), min(2**63 - 1, x)) for x in v)) for i, v in whole}
    out = []
    for q, v in whole:
        if q % mod == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:k]
            out += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def tops(spark, rows, **options):
    df = vector_frame(spark, rows)
    return sorted(tuple(r) for r in kdtree.nearest(df, df.where("vec_id % 100 = 0"), **options).collect())


def test_tree_search_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=(500, 6)), np.repeat(rng.normal(size=(4, 6)), 120, axis=0), rng.integers(-2, 3, (520, 6)) / 1024])
    rows = [(int(i), x.tolist()) for i, x in zip(rng.permutation(1500), v)]
    want = plain_top(rows)
    assert tops(spark, rows) == want
    for name, value in (("SHARD_ROWS", 60), ("SHARD_MOST", 60), ("LEAF", 8), ("BLOCK", 4), ("QUERY_GROUP", 3)):
        monkeypatch.setattr(kdtree, name, value)
    assert tops(spark, rows) == want


def test_tree_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, -1.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (None, [1.0, 1.0]), (100, []), (7, []), (200, [0.0, 0.0]), (8, [1.0]), (300, [2.0]), (9, [1e300, -1e300]), (400, [1e17, 1e17]), (10, [-0.0001, 0.0])]
    assert tops(spark, rows) == plain_top(rows)
    rows = [(i, [0.5, 0.25]) for i in range(400)]
    assert tops(spark, rows) == plain_top(rows)
    df = vector_frame(spark, rows)
    assert kdtree.nearest(df.limit(0), df.limit(0)).collect() == [] and kdtree.nearest(df.limit(0), df).collect() == []


def test_few_nodes_are_opened_where_boxes_part():
    rng = np.random.default_rng(2)
    v = (rng.normal(size=(40, 8)) * 2000).astype(np.int64).repeat(200, axis=0) + rng.integers(-20, 20, (8000, 8))
    tree = kdtree.build(np.arange(8000), v)
    by = tree.pop("order")
    tree |= {"ids": by, "second": np.full(8000, kdtree._NONE), "vectors": v[by]}
    opened, take = [], kdtree._take
    try:
        kdtree._take = lambda *a: (opened.append(1), take(*a))[1]
        found = kdtree.search(tree, np.array([-1]), v[:1], [(None, False)], 10)
    finally:
        kdtree._take = take
    scores = v @ v[0]
    assert [s for s, _, _ in found[0]] == sorted(scores.tolist(), reverse=True)[:10]
    assert len(opened) * kdtree.LEAF < 8000 / 4
