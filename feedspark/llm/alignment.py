"""Alignment of two tokenizers over the same texts.

A byte-level vocabulary (A, of the tokenizers library) and a vocabulary of
pieces (B, of sentencepiece) cut the same bytes, a space and the text, into
tokens. Where both end a token they cut the text into groups; tokens whose
bytes overlap are linked; the documents that hold a pair of ids linked are
counted over the corpus.

Neither vocabulary joins anything across a single space between two characters
that are no white space: A's word pattern starts a word there and no piece of B
holds a mark but in front. So texts fall apart into units there, and a task
aligns every distinct unit once. In a unit A's character offsets and B's spans
are the coarse cuts; where tokens share a character, or a piece stands for a
byte, the decoded bytes of the tokens place the cuts between.

Corpus counts need no table of pairs in any task: texts are packed into blocks
of about ``BLOCK`` bytes, a block sends each distinct pair once with the number
of its documents, and gets the pairs' counts back.

Defined results: a text that is null, empty or whose tokens of A or B do not
give back its bytes (one with a blank mark of B, say) has no tokens, all numbers
are 0 and its groups empty; special tokens' strings in a text are plain text;
every row is a document of its own, so repeated rows count each; ids of any
type, null ones too, are handed through; texts of any length are aligned whole,
one block holding at least one; an empty table gives an empty table; other
columns are not looked at.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedspark.session import scratch_path

# vocabulary files of public tokenizers; parameters everywhere
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BLOCK = 8 << 20  # bytes of text in a block
STEP = 1 << 20  # characters whose new units are aligned at once
CACHE = 400_000  # units a worker keeps from block to block
# a space between two characters that are no white space
_SPLIT = re.compile(r"(?<=\S) (?=\S)").split
_BEFORE, _AFTER = re.compile(r" \s").search, re.compile(r"\s ").search


def read_models(byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> tuple[bytes, bytes]:
    """Both files, a few megabytes, read once on the driver."""
    with open(byte_model, "rb") as a, open(piece_model, "rb") as b:
        return a.read(), b.read()


def _byte_of_letter() -> dict[str, int]:
    """How byte-level vocabularies write bytes: the printable ones of Latin-1
    as themselves, the others, in order, as the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def cuts(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes, from the library's spans (in bytes) as coarse
    cuts and the sizes of the decoded tokens. A span as long as its token is
    the token's own; others share a character with a neighbour or stand for
    a single byte, and there the decoded bytes go on from the last such cut."""
    total = np.cumsum(size)
    own = np.where(end - begin == size, np.arange(len(size)), -1)
    last = np.maximum.accumulate(own)
    return total + np.where(last >= 0, end[last] - total[last], 0)


def _places(text: str) -> np.ndarray:
    """Byte at which every character of ``text`` (and its end) lies."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    return np.concatenate(([0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))))


class Aligner:
    """Aligned units over two vocabularies, as growing flat tables."""

    def __init__(self, models: tuple[bytes, bytes]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(models[0].decode())
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_proto=models[1])
        letters, entries = _byte_of_letter(), self.first.get_vocab(with_added_tokens=True)
        added = {t["id"] for t in json.loads(models[0]).get("added_tokens", ())}
        self.bytes_a = [b""] * (max(entries.values(), default=-1) + 1)
        for token, i in entries.items():
            plain = i in added or any(c not in letters for c in token)
            self.bytes_a[i] = token.encode() if plain else bytes(letters[c] for c in token)
        p, n = self.second, self.second.get_piece_size()
        self.bytes_b = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        if any(MARK in p.id_to_piece(i).lstrip(MARK) for i in range(n)):
            raise ValueError("needs blank marks only at the start of pieces")
        self.width = n
        self.size_a, self.size_b = (np.array([len(x) for x in v], dtype=np.int64) for v in (self.bytes_a, self.bytes_b))
        # an id as written before another one of its side, and at its side's end
        self.inner_a, self.last_a, self.inner_b, self.last_b = (
            np.array([f"{i}{c}" for i in range(m)], dtype=object) for m, c in ((len(self.bytes_a), ","), (len(self.bytes_a), "|"), (n, ","), (n, ";"))
        )
        self.index: dict[str, int] = {}
        self.names: list[str] = []
        self.n_a, self.n_b, self.n_groups, self.start = array("q"), array("q"), array("q"), array("q", [0])
        self.codes = array("q")
        self.groups: list[str | None] = []

    def trim(self) -> None:
        """Forget what came after the first ``CACHE`` units: these hold the
        frequent ones."""
        if len(self.names) > CACHE:
            for unit in self.names[CACHE:]:
                del self.index[unit]
            del self.codes[self.start[CACHE] :], self.start[CACHE + 1 :]
            for x in (self.names, self.n_a, self.n_b, self.n_groups, self.groups):
                del x[CACHE:]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of A and of B over a space and the text; None
        where they do not give back its bytes."""
        coded = self.first.encode(" " + text, add_special_tokens=False)
        found = self.second.encode(text.encode(), return_type="offset_mapping", return_bytes=True)
        data, ids_a, ids_b = b" " + text.encode(), coded.ids, found["ids"]
        if b"".join([self.bytes_a[i] for i in ids_a]) != data or b"".join([self.bytes_b[i] for i in ids_b]) != data:
            return None
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        span_a, span_b = np.array(coded.offsets, dtype=np.int64), np.array(found["offsets"], dtype=np.int64) + 1
        if not text.isascii():
            span_a = _places(" " + text)[span_a]
        span_b[0, 0] = 0  # B's spans leave out the space that it adds in front
        return a, cuts(span_a[:, 0], span_a[:, 1], self.size_a[a]), b, cuts(span_b[:, 0], span_b[:, 1], self.size_b[b])

    def learn(self, units: list[str]) -> None:
        """Align new units: those that a space parts safely all in one text."""
        if not units:
            return
        alone = len(units) == 1 or any(not u or u[0].isspace() or u[-1].isspace() for u in units)
        found = None if alone and len(units) > 1 else self.tokens(" ".join(units))
        if found is None and len(units) > 1:
            odd = [u for u in units if not u or u[0].isspace() or u[-1].isspace()]
            half = len(units) // 2
            for part in [[u] for u in odd] + [[u for u in units if u not in set(odd)]] if odd else (units[:half], units[half:]):
                self.learn(part)
            return
        for unit in units:
            self.index[unit] = len(self.names)
            self.names.append(unit)
        if found is None or not (self.size_a[found[0]].all() and self.size_b[found[2]].all()):
            self.n_a.append(0), self.n_b.append(0), self.n_groups.append(0)
            self.groups.append(None), self.start.append(len(self.codes))
            return
        a, end_a, b, end_b = found
        bounds = np.cumsum([1 + len(u.encode()) for u in units])
        both, every = np.intersect1d(end_a, end_b, assume_unique=True), np.union1d(end_a, end_b)
        # two tokens overlap where no cut of either lies between: one link a stretch
        self.codes.frombytes((a[np.searchsorted(end_a, every)] * self.width + b[np.searchsorted(end_b, every)]).tobytes())
        per = [np.bincount(np.searchsorted(bounds, x), minlength=len(units)) for x in (end_a, end_b, both, every)]
        for x, n in zip((self.n_a, self.n_b, self.n_groups), per, strict=False):
            x.frombytes(n.astype(np.int64).tobytes())
        self.start.frombytes((self.start[-1] + np.cumsum(per[3])).astype(np.int64).tobytes())
        # ids in writing order: of every group A's, then B's
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        upto_a, upto_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
        words = np.empty(len(a) + len(b), dtype=object)
        words[np.arange(len(a)) + np.concatenate(([0], upto_b))[group_a]] = np.where(np.isin(end_a, both), self.last_a[a], self.inner_a[a])
        words[np.arange(len(b)) + upto_a[group_b]] = np.where(np.isin(end_b, both), self.last_b[b], self.inner_b[b])
        words, at = words.tolist(), 0
        for to in np.cumsum(per[0] + per[1]).tolist():
            self.groups.append("".join(words[at:to])[:-1])
            at = to

    def units(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Numbers of the units of every text, in order (None: no text)."""
        parts = [_units(t) if t else None for t in texts]
        known = self.index
        new = list(dict.fromkeys(u for p in parts if p for u in p if u not in known))
        for at in range(0, len(new), 1000):
            self.learn(new[at : at + 1000])
        return [None if p is None else np.array([known[u] for u in p], dtype=np.int64) for p in parts]

    def spans(self, text: str | None) -> list[tuple[int, int, list[int], list[int]]]:
        """(start, end, ids of A, ids of B) of the groups of a text, in bytes
        of a space and the text."""
        found = self.tokens(text) if text else None
        if found is None:
            return []
        a, end_a, b, end_b = found
        both = np.intersect1d(end_a, end_b)
        i, j = ([0, *(np.searchsorted(e, both) + 1).tolist()] for e in (end_a, end_b))
        ends = [0, *both.tolist()]
        return [(ends[k], ends[k + 1], a[i[k] : i[k + 1]].tolist(), b[j[k] : j[k + 1]].tolist()) for k in range(len(both))]


def _units(text: str) -> list[str]:
    if _BEFORE(text) or _AFTER(text) or text[0] == " " or text[-1] == " ":
        return _SPLIT(text)
    return text.split(" ")


def align(docs: DataFrame, text_col: str = "text", byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """``row`` (the input row) with ``groups``: the byte range (in a space and
    the text) and the ids of both tokenizers of every group."""
    models = docs.sparkSession.sparkContext.broadcast(read_models(byte_model, piece_model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(models.value)
        for pdf in batches:
            for at in range(0, len(pdf), 100):
                part = pdf.iloc[at : at + 100]
                found = [[{"start": s, "end": e, "a": a, "b": b} for s, e, a, b in aligner.spans(t)] for t in part["_text"]]
                yield part.drop(columns="_text").assign(groups=pd.Series(found, index=part.index, dtype=object))

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text_col}`").alias("_text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInPandas(run, f"row {kind}, groups array<struct<start:int,end:int,a:array<int>,b:array<int>>>")


def packed(x: np.ndarray) -> bytes:
    """32-bit numbers with their first bytes together, then their second, ...:
    small ones compress well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


_PER_DOC = ("n_a", "n_b", "n_groups", "n_links")


def _pack(aligner: Aligner, ids: list, found: list[np.ndarray | None]) -> dict:
    """One block: numbers of every document, and its distinct pairs as places
    in the block's sorted pairs (``keys``), with how often each is linked."""
    n_a, n_b, n_groups, start, codes = (np.array(x, dtype=np.int64) for x in (aligner.n_a, aligner.n_b, aligner.n_groups, aligner.start, aligner.codes))
    groups, shas, of_doc, units, total = aligner.groups, [], [], [], {c: [] for c in _PER_DOC}
    for k, doc in enumerate(found):
        parts = [groups[u] for u in doc.tolist()] if doc is not None else [None]
        if None in parts:
            shas.append("")
            for c in _PER_DOC:
                total[c].append(0)
            continue
        shas.append(hashlib.sha256(";".join(parts).encode()).hexdigest())
        for c, v in zip(_PER_DOC, (n_a[doc], n_b[doc], n_groups[doc], start[doc + 1] - start[doc]), strict=True):
            total[c].append(int(v.sum()))
        units.append(doc)
        of_doc.append(k)
    unit = np.concatenate(units) if units else np.empty(0, dtype=np.int64)
    doc = np.repeat(np.array(of_doc, dtype=np.int64), [len(u) for u in units])
    # places of each used unit's pairs among the block's distinct pairs
    there = np.zeros(len(n_a), dtype=bool)
    there[unit] = True
    used, unit = np.flatnonzero(there), (np.cumsum(there) - 1)[unit]
    size = start[used + 1] - start[used]
    keys, place = np.unique(codes[_ragged(start[used], size)], return_inverse=True)
    first = np.cumsum(size) - size
    each = (np.repeat(doc, size[unit]) << 32) | place[_ragged(first[unit], size[unit])]
    each, times = np.unique(each, return_counts=True)
    doc, place = each >> 32, each & 0xFFFFFFFF
    return {
        "ids": ids, **total, "groups_sha256": shas, "keys": keys,
        "held": np.bincount(place, minlength=len(keys)).astype(np.int64),
        "sizes": packed(np.bincount(doc, minlength=len(ids))), "places": packed(np.diff(place, prepend=0)), "times": packed(times),
    }


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), start[1], ..."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _blocks(models):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a worker's tasks share its copy of the broadcast, and so one aligner
        held, number = models.value, TaskContext.get().partitionId() << 33
        aligner = held.setdefault("aligner", None) or Aligner(held["files"])
        held["aligner"] = aligner
        ids, found, size = [], [], 0
        for pdf in batches:
            texts = [t if isinstance(t, str) else None for t in pdf["text"]]
            names = [None if i is pd.NA or i != i else i for i in pdf["id"].astype(object)]
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (chars < STEP or to == at):
                    chars, to = chars + len(texts[to] or ""), to + 1
                found += aligner.units(texts[at:to])
                ids, size, at = ids + names[at:to], size + sum(len(t.encode()) for t in texts[at:to] if t), to
                if size >= BLOCK:
                    yield pd.DataFrame([{"block": number, **_pack(aligner, ids, found)}])
                    ids, found, size, number = [], [], 0, number + 1
                    aligner.trim()
        if ids:
            yield pd.DataFrame([{"block": number, **_pack(aligner, ids, found)}])

    return run


def _finish(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Rows of a block's documents, from the corpus counts of its pairs."""
    counts = counts.sort_values("code")
    n, best = counts["n"].to_numpy(dtype=np.int64), counts["best"].to_numpy(dtype=np.int64)
    out = []
    for b in blocks.to_dict("records"):
        times, size = unpacked(b["times"]).astype(np.int64), unpacked(b["sizes"]).astype(np.int64)
        place = np.cumsum(unpacked(b["places"]), dtype=np.uint32).astype(np.int64)  # steps wrap around
        sums = []
        for v in (best, n):
            upto = np.concatenate(([0], np.cumsum(times * v[place] if len(place) else times)))
            ends = np.cumsum(size)
            sums.append(upto[ends] - upto[ends - size])
        out.append(pd.DataFrame({"id": pd.Series(list(b["ids"]), dtype=object), **{c: b[c] for c in _PER_DOC}, "n_best": sums[0], "count_sum": sums[1], "groups_sha256": pd.Series(list(b["groups_sha256"]), dtype=object)}))
    return pd.concat(out) if out else pd.DataFrame(columns=["id", *_PER_DOC, "n_best", "count_sum", "groups_sha256"])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """``id``, tokens of A (``n_a``) and B (``n_b``), groups, links, links whose
    pair is the one of its A id that most documents hold (``n_best``), the sum
    of the links' counts (``count_sum``) and the digest of the groups of every
    row."""
    spark = docs.sparkSession
    files = read_models(byte_model, piece_model)
    width = Aligner(files).width
    models = spark.sparkContext.broadcast({"files": files})
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    numbers = ", ".join(f"{c} array<bigint>" for c in _PER_DOC)
    schema = f"block bigint, ids array<{kind}>, {numbers}, groups_sha256 array<string>, keys array<bigint>, held array<bigint>, sizes binary, places binary, times binary"
    path = scratch_path(spark, "aligned")
    rows.mapInPandas(_blocks(models), schema).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(schema).parquet(path)

    each = blocks.select("block", F.explode(F.arrays_zip("keys", "held")).alias("p")).select("block", F.col("p.keys").alias("code"), F.col("p.held").alias("held"))
    counts = each.groupBy("code").agg(F.sum("held").alias("n")).withColumn("a", F.expr(f"code div {width}"))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    marked = counts.join(top, "a").select("code", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    back = each.select("block", "code").join(marked, "code")
    # read anew, so that its columns are not those of the pairs
    done = spark.read.schema(schema).parquet(path).drop("keys", "held").groupBy("block").cogroup(back.groupBy("block"))
    out = ", ".join(f"{c} bigint" for c in (*_PER_DOC, "n_best", "count_sum"))
    return done.applyInPandas(_finish, f"id {kind}, {out}, groups_sha256 string")
