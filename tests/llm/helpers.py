"""Odd tables and plain Python versions that operators are held against."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedspark.llm import secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "the cat of the house and a dog in the garden that is for him with all of this and more to be on it"
# prose that passes every rule
GOOD = " ".join(f"{a} {b}" for a, b in zip(PROSE.split() * 3, (f"noun{i}" for i in range(75))))

# names of the contract's columns, then names that operators use themselves
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("id", "row", "kept", "component", "score", "copy", "copies", "_row", "_text", "_id", "key", "rep", "start", "end")]
)


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang, source]) with columns of clashing names."""
    full = [(*r, *(None,) * (4 - len(r)), None, *("x",) * (len(SCHEMA) - 5)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty, blank, repeated and long texts, ties."""
    long = " ".join(f"w{i % 5000} word{i}" for i in range(60_000))
    return frame(spark, [
        (1, GOOD, "en", "a"), (2, GOOD, "en", "a"), (2, GOOD, "en", "a"), (3, None, "en", "b"), (4, "", None, "b"),
        (5, " \t\n ", "en", None), (6, "123 !! | 456", "de", "b"), (None, "a text without an id " * 6, None, None), (None, None, None, None),
        (7, long, "en", "a"), (8, "x" * 300_000, "en", "a"), (9, "é ▁ ñ 日本 \u0000 end\n\n", "es", "c"), (10, "short", "en", "c"),
    ])


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text: str | None, size: int) -> set:
    w = words(lowered(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def classes(texts: dict[int, str | None], size: int) -> dict[int, int]:
    """Component of every id, comparing every pair."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    head = {i: i for i in texts}

    def top(i: int) -> int:
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and top(a) != top(b):
                    p, q = top(a), top(b)
                    head[max(p, q)] = min(p, q)
    return {i: top(i) for i in texts}


def parts(text: str):
    """Start, kind and end of every secret part, weak ones included."""
    for kind, (name, pattern) in enumerate(secret_scan.KINDS):
        for m in re.finditer(pattern, text):
            hit = m[0]
            if (name == "assign" and len(m[2]) < 6) or (name == "access" and len(hit) < 20):
                continue
            if name == "token" and not (re.search("[0-9]", hit) and re.search("[A-Za-z]", hit)):
                continue
            yield m.start(), kind, m.end()


def secrets(text: str) -> list[tuple[int, int, int]]:
    """The reported spans, comparing every pair of parts."""
    found = sorted(parts(text))

    def near(p, role):
        kinds = {secret_scan.RANK[k] for k in secret_scan.ROLES[role]}
        return any(0 <= p[0] - q[2] <= secret_scan.SCOPE or 0 <= q[0] - p[2] <= secret_scan.SCOPE for q in found if q[1] in kinds)

    def told(p):
        if p[1] < secret_scan.N_STRONG:
            return True
        if any(q[1] < secret_scan.N_STRONG and q[0] < p[2] and p[0] < q[2] for q in found):
            return False
        need = {"ident": ("secret",), "token": ("id",), "endpoint": ("id", "secret")}[secret_scan.KINDS[p[1]][0]]
        return all(near(p, role) for role in need)

    return [p for p in found if told(p)]
