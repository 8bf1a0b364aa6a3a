"""Language identification of mixed texts.

A text is cut into words (runs of letters). The script of a word narrows the
languages it can belong to; hashed character n-grams give it a log-likelihood
under each of these; a Viterbi pass with a penalty for every switch labels the
words, and neighbours with one label form a span. A text's language is the one
with most letters.

The model counts n-grams of at most ``MAX_TRAIN`` rows of each learned language
(those of the least hash of their id, found by counts over leading bits of the
hash, so no task ranks a whole language) in a table of fixed size; more than
``MAX_LANGS`` learned languages are an error. Scoring is one pass without a
shuffle, in pieces of ``PIECE`` characters.

Defined results: ``und`` with score 0 for a null text, one without letters, or
when nothing was learned; ties go to the first language in code order; rows
whose lang or id is null teach nothing; repeated rows label alike; an empty table
gives an empty table; texts of any length are read whole (the label path
carries on over pieces' ends within a text); other columns are not looked at.
"""
from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, held_out
from .hashing import mix

MAX_TRAIN = 1_500  # rows a language
MAX_LANGS = 256  # languages a model holds, half a MiB each; more stop the job
BUCKETS = 1 << 15  # n-gram counts a language
ORDERS = (2, 4)
SWITCH = 12.0  # cost of changing language between two words, in nats
WORD_LIMIT = 8.0  # most that one word may speak for or against a language
SCRIPT_SHARE = 0.01  # share of a script in a language's words that makes it one of its own
PIECE = 1 << 19  # characters worked on at once
UNKNOWN = "und"

# First code point, end, script. Letters outside these are script 1.
SCRIPTS = (
    (0x41, 0x5B, 2), (0x61, 0x7B, 2), (0xC0, 0xD7, 2), (0xD8, 0xF7, 2), (0xF8, 0x250, 2), (0x370, 0x400, 3),
    (0x400, 0x530, 4), (0x530, 0x590, 5), (0x5D0, 0x600, 6), (0x620, 0x700, 7), (0x900, 0x980, 8), (0x980, 0xA00, 9),
    (0xE00, 0xE80, 10), (0x10A0, 0x1100, 11), (0x1100, 0x1200, 12), (0x1E00, 0x1F00, 2), (0x1F00, 0x2000, 3),
    (0x3040, 0x3100, 13), (0x3400, 0x4DC0, 14), (0x4E00, 0xA000, 14), (0xAC00, 0xD7B0, 12),
)
# no letters beyond Latin but LETTERS: signs, punctuation, symbols, private use
SILENT = ((0x80, 0xC0), (0xD7, 0xD8), (0xF7, 0xF8), (0x2000, 0x2C00), (0x3000, 0x3040), (0xFE00, 0xFE70), (0xFF00, 0xFF21), (0xE000, 0xF900), (0x1F000, 0x20000))
# scripts of letters in the silent ranges; others there are script 1
LETTERS = {0xAA: 2, 0xBA: 2, 0x2071: 2, 0x207F: 2, 0x2126: 3, 0x212A: 2, 0x212B: 2, 0x2132: 2, 0x214E: 2, 0x3005: 14, 0x303B: 14}
N_SCRIPTS = 15
ABOVE, BEYOND = 0x20000, 0x40000  # from here on Han, and no letters
_LETTER = re.compile(r"[^\W\d_]")


def _script_table() -> np.ndarray:
    out = np.ones(ABOVE + 1, dtype=np.uint8)
    out[:0x80] = 0
    for a, b in SILENT:
        out[a:b] = [LETTERS.get(c, 1) if unicodedata.category(chr(c))[0] == "L" else 0 for c in range(a, b)]
    out[ABOVE] = 14
    for a, b, s in SCRIPTS:
        out[a:b] = s
    return out


_SCRIPT = _script_table()


def _scripts(points: np.ndarray) -> np.ndarray:
    out = _SCRIPT[np.minimum(points, ABOVE)]
    out[points >= BEYOND] = 0
    return out


def words_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and script of every run of letters."""
    script = _scripts(points)
    letter = script > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], letter, [False])).astype(np.int8)))
    return edge[0::2], edge[1::2], script[edge[0::2]]


def _grams(points: np.ndarray, letter_start: np.ndarray, letter_end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every order the buckets of the n-grams that start in each word
    (they may look past its end) and where each word's begin."""
    low = np.where((points >= 65) & (points < 91), points + 32, points)
    low = np.where((points >= 0xC0) & (points < 0xDF), points + 32, low).astype(np.uint64)
    size = letter_end - letter_start
    first = (np.cumsum(size + 1) - (size + 1)).astype(np.int64)
    # words one after another, each with a blank before it
    at = np.arange(int(size.sum() + len(size))) - np.repeat(first, size + 1) + np.repeat(letter_start, size + 1) - 1
    text = low[np.maximum(at, 0)]
    text[first] = 32
    text = np.concatenate((text, np.full(max(ORDERS), 32, dtype=np.uint64)))
    n = len(at)
    h = np.zeros(n, dtype=np.uint64)
    for order in range(1, max(ORDERS) + 1):
        h = h * np.uint64(0x100000001B3) + text[order - 1 : order - 1 + n] + np.uint64(1)
        if order in ORDERS:
            yield (mix(h + np.uint64(order << 56)) >> np.uint64(49)).astype(np.int64), first


assert BUCKETS == 1 << 15  # the shift above keeps 15 bits


def _pieces(texts: list[str]) -> Iterator[list[int]]:
    """Indices of texts of like length, about ``PIECE`` characters together."""
    group, size = [], 0
    for i in sorted(range(len(texts)), key=lambda k: -len(texts[k])):
        group.append(i)
        size += len(texts[i]) + 1
        if size >= PIECE:
            yield group
            group, size = [], 0
    if group:
        yield group


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a blank, and where they start."""
    size = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), np.concatenate(([0], np.cumsum(size)))


def _split_long(points: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most about ``PIECE`` code points that end between words."""
    at = 0
    while at < len(points):
        to = min(at + PIECE, len(points))
        while to < len(points) and _scripts(points[to - 1 : to])[0] > 0:
            to += 1
        yield at, to
        at = to


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram and script counts of a task's rows, one row a language."""
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            if not isinstance(text, str):
                continue
            g = grams.setdefault(lang, np.zeros(len(ORDERS) * BUCKETS, dtype=np.int64))
            s = scripts.setdefault(lang, np.zeros(N_SCRIPTS, dtype=np.int64))
            points, _ = _points([text])
            for a, b in _split_long(points):
                start, end, script = words_of(points[a:b])
                s += np.bincount(script, minlength=N_SCRIPTS)
                for k, (bucket, _) in enumerate(_grams(points[a:b], start, end)):
                    g[k * BUCKETS : (k + 1) * BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
    if grams:
        yield pd.DataFrame({"lang": list(grams), "grams": [g.tobytes() for g in grams.values()], "scripts": [scripts[x].tobytes() for x in grams]})


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    grams = sum(np.frombuffer(x, dtype=np.int64) for x in pdf["grams"])
    scripts = sum(np.frombuffer(x, dtype=np.int64) for x in pdf["scripts"])
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "grams": [grams.tobytes()], "scripts": [scripts.tobytes()]})


def teachers(known: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """The ids of every ``lang`` that come first by hash, until ``max_rows``
    rows lie before them: at most ``max_rows`` times ``MAX_LANGS`` ids."""
    hashed = known.select("id", "lang").withColumn("_h", F.xxhash64("id"))
    # rows per language and leading bits of the hash; a language takes the least
    # hashes up to the range in which it reaches max_rows
    ranges = hashed.groupBy("lang", F.shiftright("_h", 48).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    below = W.partitionBy("lang").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    used = ranges.withColumn("_below", F.coalesce(F.sum("_n").over(below), F.lit(0))).where(F.col("_below") < max_rows)
    limits = cut(used.groupBy("lang").agg(F.max("_range").alias("_last")), "lang_limits")
    if (n := limits.count()) > MAX_LANGS:
        raise ValueError(f"{n} languages; a model holds at most {MAX_LANGS}")
    near = hashed.join(F.broadcast(limits), "lang").where(F.shiftright("_h", 48) <= F.col("_last"))
    order = W.partitionBy("lang").orderBy("_h", "id")
    rows = near.groupBy("lang", "_h", "id").agg(F.count(F.lit(1)).alias("_n"))
    return rows.withColumn("_before", F.sum("_n").over(order) - F.col("_n")).where(F.col("_before") < max_rows).select("id", "lang")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_TRAIN) -> dict:
    """Per language: n-gram log-probabilities and the scripts it uses."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = known.join(F.broadcast(teachers(known, max_rows)), ["id", "lang"])
    shape = "lang string, grams binary, scripts binary"
    counted = rows.select("lang", "text").mapInPandas(_count, shape).groupBy("lang").applyInPandas(_add, shape).collect()
    counted = sorted(counted, key=lambda r: r.lang)
    langs = [r.lang for r in counted]
    if not langs:
        return {"langs": [], "weights": np.zeros((0, 0)), "fits": np.zeros((0, 0))}
    grams = np.stack([np.frombuffer(r.grams, dtype=np.int64) for r in counted]).astype(float) + 0.5
    weights = np.empty_like(grams)
    for k in range(len(ORDERS)):
        part = slice(k * BUCKETS, (k + 1) * BUCKETS)
        weights[:, part] = np.log(grams[:, part] / grams[:, part].sum(axis=1, keepdims=True))
    weights -= weights.mean(axis=0)  # only differences between languages matter
    scripts = np.stack([np.frombuffer(r.scripts, dtype=np.int64) for r in counted]).astype(float)
    fits = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= SCRIPT_SHARE
    fits[:, ~fits.any(axis=0)] = True  # a script nobody uses narrows nothing
    return {"langs": langs, "weights": np.ascontiguousarray(weights.T.astype(np.float32)), "fits": fits.T.copy()}


def word_scores(model: dict, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and per-language score of every word."""
    start, end, script = words_of(points)
    if not len(start):
        return start, end, np.zeros((0, len(model["langs"])), dtype=np.float32)
    total = np.zeros((len(start), len(model["langs"])), dtype=np.float32)
    for k, (bucket, first) in enumerate(_grams(points, start, end)):
        total += np.add.reduceat(model["weights"][k * BUCKETS + bucket], first, axis=0)
    total /= len(ORDERS)
    total -= total.max(axis=1, keepdims=True)
    np.maximum(total, -WORD_LIMIT, out=total)
    return start, end, np.where(model["fits"][script], total, np.float32(-2 * WORD_LIMIT))


def viterbi(scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The best label of every word of several texts at once. ``scores`` holds
    the texts' words one after another, ``sizes`` their numbers of words."""
    n, k = len(sizes), scores.shape[1]
    order = np.argsort(-sizes, kind="stable")
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))[order]
    lengths = sizes[order]
    longest = int(lengths[0]) if n else 0
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts with more than t words
    stay = np.empty((longest, n, k), dtype=bool) if longest * n <= 4 * max(len(scores), 1) else None
    steps: list[np.ndarray] = []
    tops: list[np.ndarray] = []
    value = np.zeros((n, k), dtype=np.float32)
    for t in range(longest):
        m = alive[t]
        v = value[:m]
        top = v.argmax(axis=1)
        best = v[np.arange(m), top] - np.float32(SWITCH)
        same = v >= best[:, None]
        v = np.where(same, v, best[:, None]) + scores[first[:m] + t]
        value[:m] = v - v.max(axis=1, keepdims=True)
        tops.append(top)
        if stay is not None:
            stay[t, :m] = same
        else:
            steps.append(same)
    out = np.zeros(len(scores), dtype=np.int64)
    label = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        m = alive[t]
        now = label[:m]
        out[first[:m] + t] = now
        same = stay[t, :m] if stay is not None else steps[t]
        label[:m] = np.where(same[np.arange(m), now], now, tops[t])
    return out


def _label_group(model: dict, texts: list[str]) -> list[tuple[str, float, str]]:
    langs = model["langs"]
    points, first = _points(texts)
    parts = [word_scores(model, points[a:b]) for a, b in _split_long(points)] if len(points) > 2 * PIECE else [word_scores(model, points)]
    begins = [a for a, _ in _split_long(points)] if len(points) > 2 * PIECE else [0]
    start = np.concatenate([p[0] + a for p, a in zip(parts, begins, strict=True)])
    end = np.concatenate([p[1] + a for p, a in zip(parts, begins, strict=True)])
    scores = np.concatenate([p[2] for p in parts])
    word = np.searchsorted(start, first)  # each text's first word
    label = viterbi(scores, np.diff(word))
    out = []
    for i, text in enumerate(texts):
        a, b = word[i], word[i + 1]
        if a == b or not _LETTER.search(text):
            out.append((UNKNOWN, 0.0, ""))
            continue
        mine, size = label[a:b], end[a:b] - start[a:b]
        letters = np.bincount(mine, size, len(langs))
        best = int(letters.argmax())
        turn = np.flatnonzero(np.diff(mine)) + 1
        runs = zip(np.concatenate(([0], turn)), np.concatenate((turn, [b - a])), strict=True)
        spans = ",".join(f"{langs[mine[s]]}:{start[a + s] - first[i]}:{end[a + e - 1] - first[i]}" for s, e in runs)
        out.append((langs[best], float(letters[best] / letters.sum()), spans))
    return out


def label(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``lang_pred``, ``score`` (share of the letters in that language)
    and ``spans`` (language:start:end in code points, comma-joined)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            rows: list[tuple[str, float, str]] = [(UNKNOWN, 0.0, "")] * len(texts)
            for group in _pieces(texts) if model["langs"] else ():
                for i, found in zip(group, _label_group(model, [texts[i] for i in group]), strict=True):
                    rows[i] = found
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "spans"])
            out.insert(0, "id", pdf["id"].to_numpy())
            yield out

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "id bigint, lang_pred string, score double, spans string")
