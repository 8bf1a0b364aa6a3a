"""The pipeline against a plain version of every stage."""
import re

import corpus_pipeline
from feedspark.llm import mixing, pieces, quality_rules

from .helpers import classes, frame, odd, secrets, words
from .test_mix_shard_pieces import draw

SF = "/root/testdata/sf0.001"


def good(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = {g for g in grams if grams.count(g) > 1}
    repeated = len({p for i, g in enumerate(grams) if g in many for p in (i, i + 1, i + 2)})
    if len(w) < 50 or 100 * repeated > 50 * len(w):
        return False
    stop = {x for s in quality_rules.STOP_WORDS for x in (s, s.capitalize())}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        2 <= sum(map(len, w)) / len(w) <= 20 and sum(c in "#*$%&|<>" for c in text) / len(w) <= 0.1
        and sum(x in stop for x in w) / len(w) >= 0.04 and (len(text) - len(text.replace("!!", "!"))) / len(w) <= 0.5
        and (len(lines) - len(set(lines))) / len(lines) <= 0.5
        and sum(bool(re.search(r"^[\x20\x09]*[•\-*] ", x)) for x in lines) / len(lines) <= 0.9
        and sum(bool(re.search(r"(\.\.\.|…)[\x20\x09\x0D]*$", x)) for x in lines) / len(lines) <= 0.3
    )


def masked(text):
    out, at = "", 0
    runs = []
    for a, _, b in secrets(text):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    for a, b in runs:
        out, at = out + text[at:a] + "[SECRET]", b
    return out + text[at:]


def test_against_a_plain_version(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {i: r.text for i, r in docs.items() if good(r.text)}
    heads = classes(kept, corpus_pipeline.SHINGLE)
    left = {i: masked(t) for i, t in kept.items() if heads[i] == i}
    rate = {r.source: r.rate for r in mixing.rates(spark.createDataFrame([(i, t, docs[i].source) for i, t in left.items()], "doc_id bigint, text string, source string")).collect()}
    lattice = pieces.Lattice(pieces.read_vocabulary())
    want = []
    for i, t in left.items():
        ids, score, _ = lattice.encode(t, 1)
        want += [(i, docs[i].lang, docs[i].source, len(ids) // 4, score, ids)] * draw(i, rate[docs[i].source])
    got = [(*r[:5], bytes(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(kept) > len(left) > 50


def test_last_stage_keeps_the_n_best_and_decodes(spark):
    docs = frame(spark, [(1, "The quick brown fox jumps over the lazy dog"), (2, "Straße naïve résumé"), (3, "")])
    lattice = pieces.Lattice(pieces.read_vocabulary())
    got = {r.doc_id: r for r in corpus_pipeline.encode(spark, docs, SF).collect()}
    for r in docs.collect():
        _, _, best = lattice.encode(r.text, pieces.N_BEST)
        found = [(n.score, [(c["at"], tuple(c["ids"])) for c in n.changes]) for n in got[r.doc_id].nbest]
        assert found == best and got[r.doc_id].round_trip
    assert len(got[1].nbest) == pieces.N_BEST


def test_odd_rows_pass_every_stage(spark):
    docs = odd(spark)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        # mixing repeats the rows of small sources, and may leave rows out
        assert out.count() <= docs.count() or stage is corpus_pipeline.mix
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []
