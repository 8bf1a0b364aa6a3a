"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts and ratios of one text. Boosting cycles over the features:
each turn fits a tree of at most three leaves to the gradients on one
feature's histogram and adds it to that feature's lookup table; then the same
on two-dimensional tables of the pairs that explain most of the residual. A
text is scored by adding its bins' entries.

The fit reads the features of at most ``MAX_TRAIN`` labelled rows (those of the
least hash), so it is one small task; its model is a few kilobytes and goes to
every scoring task. Scoring is one pass without a shuffle.

Defined results: a null text scores like an empty one; without usable labels
every score is 0.5; a document id that repeats among labels counts once (its
highest label); repeated rows score alike; an empty table gives an empty table;
texts of any length are read whole; other columns are not looked at.
"""
from __future__ import annotations

import json
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .quality_rules import STOP_WORDS

MAX_TRAIN = 20_000
ROUNDS = 150
PAIR_ROUNDS = 60
N_PAIRS = 4
BINS = 32
PAIR_BINS = 12
RATE = 0.15
SHRINK = 1.0  # added to the curvature of a leaf
THRESHOLD = 0.3

FEATURES = (
    "words", "mean_word", "distinct", "stutter", "stop", "symbol", "upper", "digit", "punct",
    "bang", "lines_per_word", "dup_lines", "longest_word", "non_ascii",
)
_STOP = frozenset(x for w in STOP_WORDS for x in (w, w.capitalize()))
_CLASS = {name: np.zeros(256, dtype=bool) for name in ("symbol", "upper", "lower", "digit", "punct", "high")}
_CLASS["symbol"][[ord(c) for c in "#*$%&|<>"]] = True
_CLASS["punct"][[ord(c) for c in ".,;:!?()\"'-"]] = True
_CLASS["upper"][65:91] = _CLASS["lower"][97:123] = _CLASS["digit"][48:58] = _CLASS["high"][128:] = True


def measure(text: str | None) -> tuple[float, ...]:
    """The features of one text, in the order of ``FEATURES``."""
    text = text or ""
    words = text.split()
    n = len(words) or 1
    counts = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    of = {name: int(counts[mask].sum()) for name, mask in _CLASS.items()}
    size = int(counts.sum()) or 1
    lines = [x for x in text.split("\n") if x.strip()]
    letters = of["upper"] + of["lower"] or 1
    return (
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        sum(map(_STOP.__contains__, words)) / n,
        of["symbol"] / n,
        of["upper"] / letters,
        of["digit"] / size,
        of["punct"] / n,
        text.count("!!") / n,
        len(lines) / n,
        (len(lines) - len(set(lines))) / (len(lines) or 1),
        float(max(map(len, words), default=0)),
        of["high"] / size,
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gain(g, h):
    return g * g / (h + SHRINK)


def _cut_points(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of every bin for the best tree of at most three leaves."""

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, -1
        gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
        gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
        gains = _gain(gl, hl) + _gain(gs - gl, hs - hl) - _gain(gs, hs)
        at = int(np.argmax(gains))
        return float(gains[at]), lo + at + 1

    edges = [0, len(g)]
    for _ in range(2):
        gains = [best(a, b) for a, b in zip(edges, edges[1:], strict=False)]
        gain, at = max(gains)
        if gain <= 1e-9:
            break
        edges = sorted([*edges, at])
    out = np.empty(len(g))
    for a, b in zip(edges, edges[1:], strict=False):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SHRINK)
    return out


def _square(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that splits one axis and then each side on the other:
    gain and leaf value of every cell."""
    best = (-1.0, np.zeros_like(g))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for at in range(1, a.shape[0]):
            gain, out = 0.0, np.empty_like(a)
            for rows in (slice(0, at), slice(at, None)):
                gs, hs = a[rows].sum(axis=0), b[rows].sum(axis=0)
                gl, hl = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1]
                gains = _gain(gl, hl) + _gain(gs.sum() - gl, hs.sum() - hl)
                k = int(np.argmax(gains)) + 1
                gain += float(gains[k - 1])
                for cols in (slice(0, k), slice(k, None)):
                    out[rows, cols] = gs[cols].sum() / (hs[cols].sum() + SHRINK)
            if gain > best[0]:
                best = (gain, out.T if flip else out)
    return best


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The model of feature rows ``x`` and labels ``y``, as plain lists."""
    n, k = x.shape
    base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    edges = [_edges(x[:, f], BINS) for f in range(k)]
    codes = [np.searchsorted(edges[f], x[:, f], side="right") for f in range(k)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = {"base": base, "edges": [e.tolist() for e in edges], "tables": [t.tolist() for t in tables], "pairs": []}
    if not n or y.min() == y.max():
        return model
    score = np.full(n, base)

    def sums(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(score)
        return np.bincount(code, y - p, size), np.bincount(code, p * (1 - p), size)

    for _ in range(ROUNDS):
        for f in range(k):
            step = RATE * _cut_points(*sums(codes[f], len(tables[f])))
            tables[f] += step
            score += step[codes[f]]
    coarse = [_edges(x[:, f], PAIR_BINS) for f in range(k)]
    small = [np.searchsorted(coarse[f], x[:, f], side="right") for f in range(k)]
    found = []
    for a in range(k):
        for b in range(a):
            shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
            if min(shape) > 1:
                g, h = (s.reshape(shape) for s in sums(small[a] * shape[1] + small[b], shape[0] * shape[1]))
                found.append((_square(g, h)[0], a, b, shape))
    pairs = []
    for _, a, b, shape in sorted(found, reverse=True)[:N_PAIRS]:
        pairs.append((a, b, shape, small[a] * shape[1] + small[b], np.zeros(shape)))
    for _ in range(PAIR_ROUNDS):
        for _, _, shape, code, grid in pairs:
            g, h = (s.reshape(shape) for s in sums(code, shape[0] * shape[1]))
            step = RATE * _square(g, h)[1]
            grid += step
            score += step.ravel()[code]
    model["tables"] = [t.tolist() for t in tables]
    model["pairs"] = [{"a": a, "b": b, "ea": coarse[a].tolist(), "eb": coarse[b].tolist(), "grid": grid.tolist()} for a, b, _, _, grid in pairs]
    return model


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 of every feature row."""
    out = np.full(len(x), model["base"])
    for f, (e, t) in enumerate(zip(model["edges"], model["tables"], strict=True)):
        out += np.asarray(t)[np.searchsorted(e, x[:, f], side="right")]
    for p in model["pairs"]:
        grid = np.asarray(p["grid"])
        out += grid[np.searchsorted(p["ea"], x[:, p["a"]], side="right"), np.searchsorted(p["eb"], x[:, p["b"]], side="right")]
    return _sigmoid(out)


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([measure(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame(_matrix(pdf["text"]), columns=list(FEATURES)).assign(label=pdf["label"].to_numpy())


def _fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values([*FEATURES, "label"])  # the sum does not depend on the order of arrival
    return pd.DataFrame({"model": [json.dumps(fit(pdf[list(FEATURES)].to_numpy(float), pdf["label"].to_numpy(float)))]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAIN) -> dict:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("double")).alias("label"))
    # at most max_rows rows of two numbers
    some = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(some, "id")
    shape = ", ".join(f"{f} double" for f in FEATURES) + ", label double"
    measured = rows.select("text", "label").mapInPandas(_measured, shape).withColumn("all", F.lit(1))
    fitted = measured.groupBy("all").applyInPandas(_fit_group, "model string").first()
    return json.loads(fitted.model) if fitted else fit(np.empty((0, len(FEATURES))), np.empty(0))


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "score": score(model, _matrix(pdf["text"]))})

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "id bigint, score double")
