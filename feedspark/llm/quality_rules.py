"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in column expression over the row's own text, so the
whole operator is one narrow projection: no shuffle, no user function, nothing
that depends on other rows.

Defined results: a null text counts as a text without words (not kept); an
empty text likewise; a text of any length is measured whole; repeated rows give
repeated results; an empty table gives an empty table; input columns with the
names of metrics are replaced in :func:`judge` and untouched in :func:`keep`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS

# Words of which ordinary prose of the handled languages has some.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by are from this "
    "der die das und zu den von mit ist des im dem nicht ein eine als auf für "
    "le la les de des et un une du que qui en dans pour par sur au est pas "
    "el los las del y por con para se su al como es no"
).split()

# metric, smallest allowed, largest allowed (None: no bound). Ratios are per
# word or per line with a word.
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 50, None),
    ("mean_word_chars", 2.0, 20.0),
    ("symbol_ratio", None, 0.1),
    ("stop_word_ratio", 0.04, None),
    ("bang_word_ratio", None, 0.5),
    ("dup_line_ratio", None, 0.5),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


# derived metrics: name -> expression over the counts of `_counts`
RATIOS = {
    "mean_word_chars": lambda: _ratio("word_chars", "n_words"),
    "symbol_ratio": lambda: _ratio("n_symbols", "n_words"),
    "stop_word_ratio": lambda: _ratio("_n_stop", "n_words"),
    "bang_word_ratio": lambda: _ratio("_n_bang", "n_words"),
    "dup_line_ratio": lambda: _ratio("n_dup_lines", "_n_lines"),
    "bullet_line_ratio": lambda: _ratio("_n_bullet", "_n_lines"),
    "ellipsis_line_ratio": lambda: _ratio("_n_ellipsis", "_n_lines"),
}


def _count(arr: str, test) -> Column:
    return F.size(F.filter(arr, test)).cast("long")


# A window's place in the text takes the low bits of its sort key, its hash the rest.
PLACE_BITS = 17


def _windows(words: str, wide: bool) -> Column:
    """Three-word windows sorted by (hash, first word): packed into one long
    each, or as structs (``wide``) for texts of too many words for that."""
    w = F.col(words)

    def hashed(i):
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def key(i):
        if wide:
            return F.struct(hashed(i).alias("h"), i.alias("p"))
        return hashed(i).bitwiseAND(F.lit(-(1 << PLACE_BITS))).bitwiseOR(i.cast("long"))

    fits = F.size(w) <= (1 << PLACE_BITS)
    return F.when((F.size(w) >= 3) & (~fits if wide else fits), F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), key)))


def _repeat_words(words: str, packed: str, wide: str) -> Column:
    """Words covered by three-word windows that occur twice or more. Windows
    with equal hash bits count only if their words are equal."""
    w, g, s = F.col(words), F.col(packed), F.col(wide)

    def place(x):
        return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def same_words(p, q):
        return (F.get(w, p) == F.get(w, q)) & (F.get(w, p + 1) == F.get(w, q + 1)) & (F.get(w, p + 2) == F.get(w, q + 2))

    def like(x, y):
        return (F.shiftrightunsigned(x, PLACE_BITS) == F.shiftrightunsigned(y, PLACE_BITS)) & same_words(place(x), place(y))

    def like_wide(x, y):
        return (x["h"] == y["h"]) & same_words(x["p"], y["p"])

    twice = F.transform(F.filter(g, lambda x, i: like(x, F.get(g, i - 1)) | like(x, F.get(g, i + 1))), place)
    twice_wide = F.transform(F.filter(s, lambda x, i: like_wide(x, F.get(s, i - 1)) | like_wide(x, F.get(s, i + 1))), lambda x: x["p"])
    at = F.coalesce(twice, twice_wide, F.array().cast("array<int>"))
    return at


def _covered(at: str) -> Column:
    a = F.col(at)
    return F.size(F.array_union(a, F.array_union(F.transform(a, lambda p: p + 1), F.transform(a, lambda p: p + 2)))).cast("long")


def measured(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``carry`` columns, the contract's counts and the other counts."""
    body = F.coalesce(F.col(text), F.lit(""))
    parts = docs.select(
        *carry,
        F.array_remove(F.split(body, BLANKS), "").alias("_words"),
        F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.length(body) - F.length(F.replace(body, F.lit("!!"), F.lit("!")))).cast("long").alias("_n_bang"),
    )
    stop = sorted({x for w in STOP_WORDS for x in (w, w.capitalize())})
    counts = parts.select(
        *carry,
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "_words",
        _windows("_words", False).alias("_packed"),
        _windows("_words", True).alias("_wide"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("_n_lines"),
        _count("_words", lambda x: x.isin(stop)).alias("_n_stop"),
        "_n_bang",
        _count("_lines", lambda x: x.rlike(r"^[\x20\x09]*[•\-*] ")).alias("_n_bullet"),
        _count("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$")).alias("_n_ellipsis"),
    )
    twice = counts.withColumn("_twice", _repeat_words("_words", "_packed", "_wide")).drop("_words", "_packed", "_wide")
    return twice.withColumn("n_repeat_words", _covered("_twice")).drop("_twice")


def _verdict() -> Column:
    """The threshold table as one boolean expression."""
    out = F.lit(True)
    for metric, low, high in THRESHOLDS:
        value = RATIOS[metric]() if metric in RATIOS else F.col(metric)
        if low is not None:
            out = out & (value >= F.lit(low))
        if high is not None:
            out = out & (value <= F.lit(high))
    return out


def judge(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, ratios and verdict of every row: ``carry``, the five counts,
    ``base_failed``, ``kept`` and every ratio of :data:`RATIOS`."""
    m = measured(docs, text, list(carry))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return m.select(
        *carry,
        *MEASURES,
        failed.alias("base_failed"),
        (~failed & _verdict()).alias("kept"),
        *(e().alias(name) for name, e in RATIOS.items()),
    )


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(f"`{text}`").alias("_text"))
    # a filter on what costs much must not be copied into each projection below:
    # it stays above a column that is not deterministic
    judged = judge(row, "_text", ("_row",)).withColumn("_at", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_at") >= 0)).select("_row.*")
