import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedspark.llm import ann, language, quality_model
from feedspark.llm.common import held_out

from .helpers import frame, odd

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.label(docs, language.train(docs)).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").where(held_out(F.col("id")))
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_mixed_text_gets_spans_and_scripts_narrow(spark):
    rows = [(i, "the house and the garden with a tree", "en", "s") for i in range(1, 40)]
    rows += [(i, "der hund und die katze auf dem dach", "de", "s") for i in range(40, 80)] + [(i, "дом и сад и дерево", "ru", "s") for i in range(80, 120)]
    model = language.train(frame(spark, rows))
    assert model["langs"] == ["de", "en", "ru"]
    text = "the garden and the house with a tree. der hund auf dem dach und die katze"
    got = language.label(frame(spark, [(1, text), (2, "сад"), (3, "12 34"), (4, None), (5, "the " * 400 + "сад " * 3)]), model).collect()
    of = {r.id: r for r in got}
    assert [s.split(":")[0] for s in of[1].spans.split(",")] == ["en", "de"] and of[1].spans.split(",")[0].endswith(":36")
    assert (of[2].lang_pred, of[2].score) == ("ru", 1.0) and (of[3].lang_pred, of[4].lang_pred, of[4].score) == ("und", "und", 0.0)
    assert of[5].lang_pred == "en" and 0.9 < of[5].score < 1


def test_letters_above_the_table_and_among_signs(spark):
    rows = [(i, "the house and the garden", "en", "s") for i in range(1, 40)] + [(i, "中文 漢字 的", "zh", "s") for i in range(40, 80)]
    model = language.train(frame(spark, rows))
    texts = ["\U00020000\U00020BB7", "\U00030000", "々", "ℵ ℂ", "ª", "→ ± × ♥ 〒", "\U0001F600", "\U000E0041", "\U0010FFFD"]
    of = {r.id: r for r in language.label(frame(spark, list(enumerate(texts))), model).collect()}
    assert [(of[i].lang_pred, of[i].score) for i in range(3)] == [("zh", 1.0)] * 3
    assert of[3].lang_pred != "und" and (of[4].lang_pred, of[4].score) == ("en", 1.0)
    assert {of[i].lang_pred for i in range(5, 9)} == {"und"}


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(0, 6, 4)
        scores = rng.normal(0, 12, (int(sizes.sum()), 3)).astype(np.float32)
        got, at = language.viterbi(scores, sizes), 0
        for n in sizes:
            s = scores[at : at + n]

            def value(p, s=s):
                return sum(s[k, x] for k, x in enumerate(p)) - language.SWITCH * sum(a != b for a, b in itertools.pairwise(p))

            best = max(itertools.product(range(3), repeat=int(n)), key=value)
            assert abs(value(tuple(got[at : at + n])) - value(best)) < 1e-3
            at += n


def test_training_rows_are_those_of_the_least_hash(spark, monkeypatch):
    rows = [(i, "x", "xyz"[i % 3]) for i in range(3000)] + [(7, "x", "y")] * 40 + [(None, "x", "z")] * 9 + [(5000 + i, "x", "few") for i in range(4)]
    known = frame(spark, rows).select(F.col("doc_id").alias("id"), "lang")
    hashed = sorted((r.lang, r.h, r.id is not None, r.id or 0) for r in known.select("*", F.xxhash64("id").alias("h")).collect())
    for n in (1, 30, 950, 10_000):
        want = {(lang, i if some else None) for lang in ("x", "y", "z", "few") for _, _, some, i in [r for r in hashed if r[0] == lang][:n]}
        got = language.teachers(known, n).collect()
        assert {(r.lang, r.id) for r in got} == want and len(got) == len(want)
    monkeypatch.setattr(language, "MAX_LANGS", 3)
    with pytest.raises(ValueError, match="4 languages"):
        language.teachers(known)


def test_languages_of_odd_rows(spark):
    df = odd(spark)
    got = language.label(df, language.train(df)).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    none = language.train(df.limit(0))
    assert {r.lang_pred for r in language.label(df, none).collect()} == {"und"}
    assert language.label(df.limit(0), none).collect() == []


def test_long_texts_label_like_short_ones(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    model = language.train(docs)
    whole = sorted(language.label(docs, model).collect())
    monkeypatch.setattr(language, "PIECE", 500)
    assert [r[:2] for r in sorted(language.label(docs, model).collect())] == [r[:2] for r in whole]


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.train(docs, labels)
    found = quality_model.predict(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id").where(held_out(F.col("id")))
    right = ((F.col("score") >= quality_model.THRESHOLD).cast("int") == F.col("quality")).cast("double")
    assert found.agg(F.avg(right)).first()[0] > 0.95
    assert len(model["pairs"]) == quality_model.N_PAIRS


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(quality_model.FEATURES)))
    x[:, :2] = rng.uniform(-1, 1, (4000, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality_model.fit(x, y)
    assert ((quality_model.score(model, x) > 0.5) == y).mean() > 0.9


def test_quality_of_odd_rows(spark):
    df = odd(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, None), (None, 1), (6, 0), (10, 0)], "doc_id bigint, quality int")
    got = quality_model.predict(df, quality_model.train(df, labels)).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    blank = quality_model.train(df, labels.limit(0))
    assert {r.score for r in quality_model.predict(df, blank).collect()} == {0.5}
    assert quality_model.predict(df.limit(0), blank).collect() == []


def exact(ids, v, query, k):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.where(ids == ids[query], -9, u @ u[query])
    return ids[np.lexsort((ids, -np.round(s, 12)))[:k]].tolist()


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 400)
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(c, 0.4, (300, 16)) for c in rng.normal(0, 1, (5, 16))]).astype(np.float32)
    v[rng.integers(0, 1500, 500)] = v[7]  # a third is one vector
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>")
    got = {}
    for r in ann.nearest(rows, rows.where("vec_id % 10 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    ids = np.arange(len(v))
    hits = [len(set(exact(ids, v.astype(float), q, 5)) & set(got[q])) for q in got]
    assert len(got) == 150 and all(len(x) == 5 for x in got.values()) and np.mean(hits) / 5 >= 0.9
    assert got[next(q for q in got if (v[q] == v[7]).all())][0] == min(i for i in ids if (v[i] == v[7]).all())


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [2.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 1.0, 1.0]), (50, [1.0, 1.0])]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id bigint, embedding array<float>, rep string, rank string")
    got = sorted((r.query_id, r.rank, r.id) for r in ann.nearest(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 7), (0, 2, 8), (0, 3, 50), (50, 1, 0), (50, 2, 7), (50, 3, 8)]
    assert ann.nearest(df.limit(0), df.limit(0)).collect() == []
