import hashlib
import random

import numpy as np

from feedspark.llm import near_dedup, repeats

from .helpers import classes, frame, odd


def variants(seed, n, edits, size=120):
    """Texts around one original, each with some words changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(size)] = f"z{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def found(df, size=4):
    return {r.id: r.component for r in near_dedup.classes(df, size=size).collect()}


def test_classes_match_all_pairs(spark):
    texts = [t for s in range(6) for t in variants(s, 12, 9)] + ["a b", "A  B", "a b c", "same same same same", "same same same same same", "Q"]
    rows = list(enumerate(texts, 100))
    assert found(frame(spark, rows)) == classes(dict(rows), 4)


def test_blocks_find_links_that_no_hub_has(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "COLUMNS", 50)
    # many texts at the edge of the threshold around one original
    rows = list(enumerate(variants(3, 60, 16, 200)))
    want = classes(dict(rows), 4)
    assert found(frame(spark, rows)) == want
    assert 1 < len(set(want.values())) < 60


def test_a_chain_is_one_component(spark):
    w = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join(w[k * 5 : k * 5 + 60])) for k in range(8)]
    assert found(frame(spark, rows)) == classes(dict(rows), 4) == dict.fromkeys(range(8), 0)


def test_odd_rows(spark):
    df = odd(spark)
    got = near_dedup.classes(df).collect()
    assert len(got) == df.count()
    of = {r.id: r for r in got if r.id is not None}
    assert of[2].component == 1 and not of[2].kept and of[3].n_shingles == 0 and of[4].component == 4 and of[10].n_shingles == 1
    assert all(r.component is None and r.kept for r in got if r.id is None)
    kept = near_dedup.keep(df)
    assert kept.columns == df.columns and kept.count() == df.count() - 2
    assert near_dedup.classes(df.limit(0)).collect() == []


def test_one_row_of_each_group_stays_where_ids_repeat_or_miss(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    # 2 is a near copy of 1 and a text of its own, 3 heads a group thrice, no id heads another
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, c), (3, c), (4, c), (None, d), (None, d + " end"), (None, a), (None, None), (5, None)]
    kept = near_dedup.keep(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(x for x in got if x[0]) == [(1, a), (2, b), (3, c), (5, None)]
    assert sorted((x[1] or "")[:2] for x in got if x[0] is None) == ["", "d0"]


def test_texts_beyond_one_piece_hash_alike(monkeypatch):
    from feedspark.llm import hashing

    text = " ".join(f"Wort{i}" for i in range(500)).encode()
    whole = hashing.word_hashes(text)
    monkeypatch.setattr(hashing, "PIECE", 64)
    assert np.array_equal(hashing.word_hashes(text), whole)
    assert np.array_equal(hashing.word_hashes(text.upper()), whole)


def test_least_matches_is_the_posterior_bound():
    n, t = 32, 0.8
    grid = np.linspace(0, 1, 200_001)
    for m in (near_dedup.least_matches(n) - 1, near_dedup.least_matches(n)):
        density = grid**m * (1 - grid) ** (n - m)
        assert (density[grid >= t].sum() / density.sum() >= near_dedup.MISS) == (m >= near_dedup.least_matches(n))


def plain_removal(rows):
    seen, out = {}, {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        for k in range(len(b) - 49):
            seen.setdefault(b[k : k + 50], i)
        gone = [False] * len(b)
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def removal(df):
    return {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove(df).collect()}


def test_repeats_match_all_windows(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 2000)
    monkeypatch.setattr(repeats, "SEGMENT", 97)
    rng = random.Random(5)
    shared = ["".join(rng.choice("abcdefgh é") for _ in range(n)) for n in (49, 50, 51, 80, 200)]
    rows = [(i, "".join(rng.choice([*shared, "".join(rng.choice("ab ") for _ in range(rng.randrange(90)))]) for _ in range(rng.randrange(6)))) for i in range(60)]
    rows += [(60, "a" * 300), (61, "a" * 49), (62, "a" * 120), (63, None), (64, "ab" * 100), (65, shared[4]), (66, shared[4])]
    assert removal(frame(spark, rows)) == plain_removal(rows)


def test_a_common_string_between_different_neighbours_is_split(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 5000)
    monkeypatch.setattr(repeats, "HOT", 40, raising=False)
    whole = repeats._firsts

    def bounded(pdf):
        triggers = np.concatenate([np.frombuffer(x, dtype="<u4") for x in pdf["triggers"]])
        assert np.unique(triggers, return_counts=True)[1].max() <= 40
        return whole(pdf)

    monkeypatch.setattr(repeats, "_firsts", bounded)
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    # a string that triggers nearly everywhere
    line = min((noise(20) for _ in range(2000)), key=lambda t: int(repeats._gram_hashes(np.frombuffer(t.encode(), dtype=np.uint8))[0]))
    rows = [(i, noise(60) + line + noise(60)) for i in range(300)]
    # some contexts repeat: in part, in whole, within one text
    rows += [(300 + i, noise(50) + rows[i][1][45 : 110 + i] + noise(50)) for i in range(10)]
    rows += [(310, rows[5][1] + rows[9][1]), (311, rows[7][1]), (312, rows[8][1] * 2), (313, line * 3), (314, line * 5)]
    assert removal(frame(spark, rows)) == plain_removal(rows)


def test_repeats_of_odd_rows(spark):
    df = odd(spark)
    got = repeats.remove(df).collect()
    assert len(got) == df.count()
    of = {r.id: r for r in got if r.id not in (None, 2)}
    twos = [r for r in got if r.id == 2]
    assert [(r.n_removed, r.n_spans) for r in twos] == [(r.n_bytes, 1) for r in twos] and of[1].n_removed == 0 and of[3].n_bytes == 0
    assert of[8].n_removed == 0  # a text repeats itself, but in no smaller document
    assert repeats.remove(df.limit(0)).collect() == []


def test_suffix_order_is_lexicographic():
    chars = np.frombuffer(b"banana bandana " * 9, dtype=np.uint8)
    place = np.arange(len(chars) - repeats.WINDOW)
    by, new = repeats.suffix_order(chars, place)
    raw = chars.tobytes()
    ordered = [raw[p : p + 50] for p in by]
    assert ordered == sorted(ordered)
    assert new.tolist() == [k == 0 or ordered[k] != ordered[k - 1] for k in range(len(ordered))]
