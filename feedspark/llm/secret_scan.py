"""Secret scans with multipart credential linking.

Strong parts (assigned secrets, access identifiers, long hex runs) are always
reported. Weak parts (assigned user names and ids, opaque tokens, endpoints)
are reported only where the parts that complete a credential lie within a scope
of ``SCOPE`` code points: an identifier next to a secret, a token next to an
identifier, an endpoint next to both. A part that overlaps another does not
complete it. The link is an interval join between the parts of one text, carried
out as ordered windows over where parts start and end: for every part the nearest
end up to its start and the nearest start from its end of each role, so a text
with many parts costs a sort, never all pairs.

One pass of regular expressions over each text, one shuffle of a few numbers per
document; texts are never shuffled, and no user function runs.

Defined results: a null text counts as empty (no spans, hash of the empty
string); rows equal in id and text give equal rows, each kept; null ids form
rows of their own; any text length is scanned whole; an empty table gives an
empty table; other input columns are not looked at.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _either(words: str) -> str:
    """The words in any mix of cases."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# Kinds in the order of the span list, with their patterns.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
IDENT = (
    rf"""({_either("client_?id|access_?key(_?id)?|user_?name|user|login|account")})"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
)
TOKEN = r"[A-Za-z0-9+/=_-]{20,}"
ENDPOINT = (
    r"""([a-z][a-z0-9+]{1,15}://[A-Za-z0-9._~:/?@!$&()*+,;=%-]+"""
    rf"""|({_either("endpoint|host(name)?|server")})"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]{3,})"""
)
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("ident", IDENT), ("token", TOKEN), ("endpoint", ENDPOINT))
RANK = {name: i for i, (name, _) in enumerate(KINDS)}
N_STRONG = 3
ROLES = {"id": ("access", "ident"), "secret": ("assign", "hex", "token")}
SCOPE = 300


def _counts_as(kind: str, hit: Column) -> Column:
    """Whether a match of the pattern is a part of its kind."""
    if kind == "assign":
        return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 6
    if kind == "access":
        return F.length(hit) >= 20
    if kind == "token":
        return hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")
    return F.lit(True)


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """All matches with the length of the text between them; where they start
    is summed up once they are rows."""
    pair = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"), F.split(text, pattern, -1).alias("gap"))
    part = F.transform(
        pair,
        lambda z, i: F.struct(
            F.lit(RANK[kind]).alias("kind"), i.alias("i"),
            F.length(z["gap"]).alias("gap"), F.length(z["hit"]).alias("len"), _counts_as(kind, z["hit"]).alias("counts"),
        ),
    )
    # the gap after the last match has no match of its own
    return F.filter(F.when(text.rlike(pattern), part).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,counts:boolean>>")), lambda p: p["len"].isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, ``text_md5``, ``spans`` (array of start, kind, end in
    code points, end exclusive, sorted) and ``covered`` (the spans merged into
    disjoint intervals)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"),
        F.md5(text.cast("binary")).alias("text_md5"),
        F.concat(*(_matches(text, k, p) for k, p in KINDS)).alias("parts"),
    )
    rows = found.groupBy("id", "text_md5").agg(F.count(F.lit(1)).alias("copies"), F.first("parts").alias("parts"))
    # one row per part, and one of kind -1 that keeps a text without parts
    marker = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit(0).alias("len"), F.lit(True).alias("counts")))
    flat = rows.select("id", "text_md5", "copies", F.explode(F.concat("parts", marker)).alias("p")).select("id", "text_md5", "copies", "p.*")
    at = W.partitionBy("id", "text_md5", "kind").orderBy("i")
    flat = flat.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(at)).where("counts")
    flat = flat.select("id", "text_md5", "copies", "kind", (F.col("end") - F.col("len")).alias("start"), "end")

    # both ends of every part, in order of place; equal places see each other
    ends = F.explode(F.array(*(F.struct(F.col(c).alias("pos"), F.lit(c == "start").alias("opens")) for c in ("start", "end"))))
    ends = flat.select("*", ends.alias("e")).select("id", "text_md5", "copies", "kind", "start", "end", "e.*")
    upto = W.partitionBy("id", "text_md5").orderBy("pos").rangeBetween(W.unboundedPreceding, 0)
    onward = W.partitionBy("id", "text_md5").orderBy(F.desc("pos")).rangeBetween(W.unboundedPreceding, 0)
    gaps = {}
    for role, kinds in ROLES.items():
        mine = F.col("kind").isin([RANK[k] for k in kinds])
        gap_before = F.col("pos") - F.max(F.when(mine & ~F.col("opens"), F.col("pos"))).over(upto)
        gap_after = F.min(F.when(mine & F.col("opens"), F.col("pos"))).over(onward) - F.col("pos")
        gaps[role] = F.when(F.col("opens"), gap_before).otherwise(gap_after)
    sides = ends.select("id", "text_md5", "copies", "kind", "start", "end", *(g.alias(f"_{r}") for r, g in gaps.items()))
    flat = sides.groupBy("id", "text_md5", "copies", "kind", "start", "end").agg(*(F.min(f"_{r}").alias(f"_{r}") for r in ROLES))
    near = {r: F.coalesce(F.col(f"_{r}"), F.lit(SCOPE + 1)) <= SCOPE for r in ROLES}

    before = W.partitionBy("id", "text_md5").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy("id", "text_md5").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)
    strong = F.col("kind").between(0, N_STRONG - 1)
    # a weak part inside a strong one is that one again
    again = (F.coalesce(F.max(F.when(strong, F.col("end"))).over(before), F.lit(-1)) > F.col("start")) | (
        F.coalesce(F.min(F.when(strong, F.col("start"))).over(after), F.col("end")) < F.col("end")
    )
    linked = (
        F.when(F.col("kind") == RANK["ident"], near["secret"])
        .when(F.col("kind") == RANK["token"], near["id"])
        .when(F.col("kind") == RANK["endpoint"], near["id"] & near["secret"])
        .otherwise(F.lit(False))
    )
    kept = flat.withColumn("_keep", strong | (F.col("kind") < 0) | (linked & ~again)).where("_keep")

    # merge the kept spans: a new interval starts beyond every end so far
    real = F.col("kind") >= 0
    opens = F.when(real & (F.col("start") > F.coalesce(F.max(F.when(real, F.col("end"))).over(before), F.lit(-1))), 1).otherwise(0)
    runs = kept.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(before.rowsBetween(W.unboundedPreceding, 0)))
    run = W.partitionBy("id", "text_md5", "_run")
    runs = runs.withColumn("_from", F.min(F.when(real, F.col("start"))).over(run)).withColumn("_to", F.max(F.when(real, F.col("end"))).over(run))
    return (
        runs.groupBy("id", "text_md5")
        .agg(
            F.max("copies").alias("copies"),
            F.sort_array(F.collect_list(F.when(real, F.struct("start", "kind", "end")))).alias("spans"),
            F.sort_array(F.collect_set(F.when(real, F.struct("_from", "_to")))).alias("covered"),
        )
        .select("id", "text_md5", "spans", "covered", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
        .drop("_copy")
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*(F.lit(k) for k, _ in KINDS))
    one = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def has_parts(text: Column) -> Column:
    """A cheap, complete test: false only where :func:`scan` finds no span."""
    ident, secret = text.rlike(ACCESS) | text.rlike(IDENT), text.rlike(ASSIGN) | text.rlike(HEX) | text.rlike(TOKEN)
    return F.coalesce(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX) | (ident & secret), F.lit(False))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows with every reported span masked. Only rows with parts are
    joined with their spans; all others pass straight through."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    row = docs.select(F.struct(*names).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    parts = has_parts(F.col("_text"))
    spans = scan(row.where(parts), "_id", "_text").where(F.size("covered") > 0).groupBy("id", "text_md5").agg(F.first("covered").alias("covered"))
    some = row.where(parts).withColumn("_md5", F.md5(F.col("_text").cast("binary")))
    joined = some.join(spans, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_md5") == F.col("text_md5")), "left")
    text, cover = F.col("_text"), F.col("covered")
    # text before each interval, the mask; then the rest
    cut = F.transform(
        cover,
        lambda c, i: F.concat(
            F.substring(text, (F.coalesce(F.get(cover, i - 1)["_to"], F.lit(0)) + 1).cast("int"), (c["_from"] - F.coalesce(F.get(cover, i - 1)["_to"], F.lit(0))).cast("int")),
            F.lit(mask),
        ),
    )
    rest = F.substring(text, (F.get(cover, F.size(cover) - 1)["_to"] + 1).cast("int"), F.length(text))
    masked = F.when(cover.isNull(), text).otherwise(F.concat(F.array_join(cut, ""), rest))
    out = [F.col(f"_row.`{c}`") if c != text_col else masked.alias(c) for c in docs.columns]
    plain = row.where(~parts).select("_row.*")
    return joined.select(*out).unionByName(plain)
