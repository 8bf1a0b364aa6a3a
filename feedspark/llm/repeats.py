"""Repeated passages by minimizer buckets and a sort of windows.

This stands in for the suffix arrays of a prefix-free parse: only equal
``WINDOW``-byte strings and their least ids are asked for, so no parse order is built.

Removes every byte that lies in a ``WINDOW``-byte string which also starts in a
document with a smaller id. Texts are packed into blocks; then:

1. A rolling hash triggers phrases: each window belongs to the least hash among
   its ``GRAM``-byte substrings (leftmost if equal), and the windows of one trigger are
   a phrase, looking ahead to the end of its last window. What belongs where
   depends on the bytes alone, so equal windows fall under equal triggers.
2. Triggers that occur in one document only are dropped: distinct trigger hashes
   of each block meet in hash buckets, which send back one bit each. A trigger
   with more than ``HOT`` phrases (a common string between different neighbours)
   is split: its windows, under their own hashes, go through this step again, and
   those that two documents hold go on as phrases of one window.
3. The dictionary: distinct phrases of each block with the least id that holds
   them. Per bucket the suffixes of all phrases that start a window are sorted by
   their ``WINDOW`` bytes (the part of the suffix array that matters here);
   neighbours with equal bytes are one string, and the ids that hold its
   phrases give the least id that starts it.
4. Blocks get these ids back phrase by phrase and lay them over their texts.

A block's phrases travel once however often they occur in it, so the most common
passage costs one entry a block, and a common string no more than ``HOT`` entries
beyond those of its windows. Strings are compared byte by byte.

Defined results: a null text is empty; a row without id counts as larger than
all ids (it loses what others have, nobody loses by it); rows with equal ids do
not cover each other; texts shorter than the window keep everything; an empty
table gives an empty table; texts of any length are read whole; other columns
are not looked at.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .hashing import _BYTE, mix, powers

WINDOW = 50
GRAM = 20
SPAN = WINDOW - GRAM + 1  # substrings of a window that can trigger
BLOCK = 1 << 22  # bytes of text in a block
SEGMENT = 1 << 17  # places hashed at once
HOT = 1 << 15  # distinct phrases of one trigger, summed over blocks, that may meet
NO_ID = np.iinfo(np.int64).max
_U = np.uint64
_UP, _DOWN = powers(SEGMENT + WINDOW)
_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every ``GRAM`` bytes, from hashes of powers of two of them."""
    power, size = (data.astype(_U) + _U(1)) * _U(0xBF58476D1CE4E5B9), 1
    out, done, left = None, 0, GRAM
    while left:
        if left & 1:
            n = len(data) - (done + size) + 1
            out = power[:n] if out is None else out[:n] * _U(pow(_BASE, size, 1 << 64)) + power[done : done + n]
            done += size
        left >>= 1
        if left:
            n = len(data) - 2 * size + 1
            power = power[:n] * _U(pow(_BASE, size, 1 << 64)) + power[size : size + n]
            size *= 2
    return mix(out)


def phrases(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigger hash, first window, number of windows, text and hash of every
    phrase of a block; ``sizes`` are the lengths of its texts in ``data``."""
    end = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    out = []
    for s in range(0, max(len(data) - WINDOW + 1, 0), SEGMENT):
        part = data[s : s + SEGMENT + WINDOW - 1]
        h = _gram_hashes(part)
        least, at, reach = h, np.arange(len(h), dtype=np.int32), 1
        while reach < SPAN:
            step = min(reach, SPAN - reach)
            n = len(least) - step
            less = least[step:] < least[:n]
            least, at = np.where(less, least[step:], least[:n]), np.where(less, at[step:], at[:n])
            reach += step
        mine = text[s : s + len(at)]
        whole = np.arange(s, s + len(at)) + WINDOW <= end[mine]
        turn = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (mine[1:] != mine[:-1]) | (whole[1:] != whole[:-1]))))
        size = np.diff(np.append(turn, len(at)))
        turn, size = turn[whole[turn]], size[whole[turn]]
        # hashes of the phrases' bytes from one running sum
        total = np.concatenate(([_U(0)], np.cumsum(_BYTE[part] * _UP[: len(part)], dtype=_U)))
        local = turn
        value = mix((total[local + size + WINDOW - 1] - total[local]) * _DOWN[local] + size.astype(_U))
        out.append((h[at[turn]], turn + s, size, mine[turn], value))
    if not out:
        none = np.empty(0, dtype=np.int64)
        return none.astype(_U), none, none, none, none.astype(_U)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Block:
    """A packed block and its phrases, sorted by bucket and trigger."""

    def __init__(self, row, buckets: int):
        self.ids, self.sizes = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.sizes, dtype=np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.data), dtype=np.uint8)
        self.buckets = buckets
        self._order(*phrases(self.data, self.sizes))

    def _order(self, h, first, windows, text, value) -> None:
        self.first, self.windows, self.text, self.value = first, windows, text, value
        self.bucket, self.key = (h % _U(self.buckets)).astype(np.int64), h
        by = np.lexsort((self.key, self.bucket))
        self.bucket, self.key, self.first, self.windows, self.text, self.value = (
            x[by] for x in (self.bucket, self.key, self.first, self.windows, self.text, self.value)
        )
        self.new = np.concatenate(([True], self.key[1:] != self.key[:-1])) if len(by) else np.empty(0, dtype=bool)

    def counts(self) -> np.ndarray:
        """Distinct phrases of every distinct trigger."""
        start = np.flatnonzero(self.new)
        n = np.diff(np.append(start, len(self.key)))
        line = np.repeat(np.arange(len(n)), n)
        some = np.flatnonzero(n[line] > 1)
        line, value = line[some], self.value[some]
        by = np.lexsort((value, line))
        line, value = line[by], value[by]
        new = np.ones(len(line), dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (value[1:] != value[:-1])
        return np.maximum(np.bincount(line[new], minlength=len(n)), 1)

    def keys(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per bucket the distinct triggers and whether two texts hold each."""
        start = np.flatnonzero(self.new)
        if not len(start):
            return
        low, high = np.minimum.reduceat(self.text, start), np.maximum.reduceat(self.text, start)
        key, bucket, several = self.key[start], self.bucket[start], low != high
        edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        for a, b in zip(edge, edge[1:], strict=False):
            yield int(bucket[a]), key[a:b], several[a:b]

    def marked(self, bits: list, name: str = "bits") -> np.ndarray:
        """Which phrases have a bit of this name for their trigger."""
        sent = {r["bucket"]: r[name] for r in bits if r[name] is not None}
        which = [np.unpackbits(np.frombuffer(sent[b], dtype=np.uint8), count=len(k)) if b in sent else np.zeros(len(k), dtype=np.uint8) for b, k, _ in self.keys()]
        return np.concatenate(which).astype(bool)[np.cumsum(self.new) - 1] if which else np.empty(0, dtype=bool)

    def split(self, bits: list) -> Block:
        """The windows of phrases with hot triggers, each a phrase of its own
        under its own hash."""
        hot = self.marked(bits, "hot")
        n = self.windows[hot]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first, text = np.repeat(self.first[hot], n) + step, np.repeat(self.text[hot], n)
        weights = [mix(np.arange(k, k + WINDOW, dtype=_U)) | _U(1) for k in (1, 1 + WINDOW)]
        key, value = np.empty(len(first), dtype=_U), np.empty(len(first), dtype=_U)
        for a in range(0, len(first), 1 << 14):
            chars = _BYTE[self.data[first[a : a + (1 << 14), None] + np.arange(WINDOW)]]
            key[a : a + (1 << 14)], value[a : a + (1 << 14)] = (mix((chars * w).sum(axis=1, dtype=_U)) for w in weights)
        out = object.__new__(Block)
        out.ids, out.sizes, out.data, out.buckets = self.ids, self.sizes, self.data, self.buckets
        out._order(key, first, np.ones_like(first), text, value)
        return out

    def keep(self, bits: list, shared: list) -> None:
        """Drop phrases whose trigger has no bit in ``bits``, and split those of
        hot triggers into windows, of which those without a bit in ``shared`` are
        dropped; then number the distinct phrases (``entry``)."""
        on = self.marked(bits)
        parts = [(self, on)]
        if any(r["hot"] is not None for r in bits):
            part = self.split(bits)
            parts = [(self, on & ~self.marked(bits, "hot")), (part, part.marked(shared))]
        bucket, key, value, self.first, self.windows, self.text = (
            np.concatenate([getattr(p, name)[o] for p, o in parts]) for name in ("bucket", "key", "value", "first", "windows", "text")
        )
        by = np.lexsort((value, key, bucket))
        bucket, key, value, self.first, self.windows, self.text = (x[by] for x in (bucket, key, value, self.first, self.windows, self.text))
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (value[1:] != value[:-1]))) if len(by) else np.empty(0, dtype=bool)
        self.entry, self.head, self.bucket, self.key = np.cumsum(new) - 1, np.flatnonzero(new), bucket, key

    def entries(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """Per bucket its distinct phrases: triggers, numbers of windows, least
        ids, bytes."""
        if not len(self.head):
            return
        least = np.minimum.reduceat(self.ids[self.text], self.head)
        bucket, first, windows = self.bucket[self.head], self.first[self.head], self.windows[self.head]
        edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        press = zstandard.ZstdCompressor(level=3)
        for a, b in zip(edge, edge[1:], strict=False):
            size = windows[a:b] + WINDOW - 1
            at = np.repeat(first[a:b] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            triggers = (self.key[self.head[a:b]] >> _U(32)).astype("<u4")
            yield int(bucket[a]), triggers.tobytes(), windows[a:b].astype(np.uint8).tobytes(), least[a:b].tobytes(), press.compress(self.data[at].tobytes())

    def removed(self, replies: list) -> np.ndarray:
        """Which bytes go, given every bucket's runs of least ids."""
        mark = np.zeros(len(self.data) + 1, dtype=np.int32)
        if len(self.head):
            sent = {r["bucket"]: r for r in replies}
            buckets = self.bucket[self.head]
            order = buckets[np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))]
            runs = np.concatenate([np.frombuffer(sent[b]["runs"], dtype=np.uint8) for b in order])
            least = np.repeat(np.concatenate([np.frombuffer(sent[b]["least"], dtype=np.int64) for b in order]), runs)
            size = self.windows[self.head]
            start = np.concatenate(([0], np.cumsum(size)[:-1]))
            n = self.windows
            step = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
            covered = least[np.repeat(start[self.entry], n) + step] < np.repeat(self.ids[self.text], n)
            place = (np.repeat(self.first, n) + step)[covered]
            np.add.at(mark, place, 1)
            np.add.at(mark, place + WINDOW, -1)
        return np.cumsum(mark[:-1]) > 0


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    press, made = zstandard.ZstdCompressor(level=3), 0
    task = TaskContext.get().partitionId()

    def block(rows: list[tuple[int, bytes]]) -> pd.DataFrame:
        ids, texts = np.array([r[0] for r in rows], dtype=np.int64), [r[1] for r in rows]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        return pd.DataFrame({"block": [(task << 32) + made], "ids": [ids.tobytes()], "sizes": [sizes.tobytes()], "data": [press.compress(b"".join(texts))], "n_bytes": [int(sizes.sum())]})

    rows, size = [], 0
    for pdf in batches:
        for i, t in zip(pdf["id"], pdf["text"], strict=True):
            raw = t.encode() if isinstance(t, str) else b""
            rows.append((NO_ID if i is None or i != i else int(i), raw))
            size += len(raw)
            if size >= BLOCK:
                yield block(rows)
                rows, size, made = [], 0, made + 1
    if rows:
        yield block(rows)


def _blocks(batches: Iterator[pd.DataFrame], buckets: int):
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            yield row, Block(row, buckets)


def _send_keys(buckets: int, windows: bool = False):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, block in _blocks(batches, buckets):
            if windows:
                block = block.split(row.bits)
            counts, at, sent = block.counts(), 0, []
            for b, k, s in block.keys():
                mine = counts[at : at + len(k)]
                at += len(k)
                # the few counts beyond one: place and count
                more = np.flatnonzero(mine > 1)
                many = np.column_stack((more, mine[more])).astype("<u4").tobytes()
                sent.append((b, row.block, (k >> _U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), np.packbits(s).tobytes(), many))
            yield pd.DataFrame(sent, columns=["bucket", "block", "keys", "several", "many"])

    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bit for every trigger of every block: held by two texts or more; and
    where there are such, which of these are hot."""
    pdf = pdf.sort_values("block")
    parts, several, counts = [], [], []
    for keys, bits, many in zip(pdf["keys"], pdf["several"], pdf["many"], strict=True):
        raw = np.zeros((len(keys) // 6, 8), dtype=np.uint8)
        raw[:, :6] = np.frombuffer(keys, dtype=np.uint8).reshape(-1, 6)
        parts.append(raw.view("<u8").ravel())
        several.append(np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=len(raw)))
        n = np.ones(len(raw), dtype=np.int64)
        more = np.frombuffer(many, dtype="<u4").reshape(-1, 2)
        n[more[:, 0]] = more[:, 1]
        counts.append(n)
    _, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    twice = np.concatenate(several).astype(bool)
    shared = (count > 1) | (np.bincount(which, twice, len(count)) > 0)
    edge = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    on = shared[which]
    hot = (shared & (np.bincount(which, np.concatenate(counts), len(count)) > HOT))[which]
    rows = [
        (b, np.packbits(on[x:y]).tobytes(), np.packbits(hot[x:y]).tobytes() if hot[x:y].any() else None)
        for b, x, y in zip(pdf["block"], edge, edge[1:], strict=False) if on[x:y].any()
    ]
    return pd.DataFrame(rows, columns=["block", "bits", "hot"]).assign(bucket=int(pdf["bucket"].iloc[0]))


def _send_entries(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, block in _blocks(batches, buckets):
            block.keep(row.bits, row.windows if row.windows is not None else [])
            sent = [(b, row.block, *parts) for b, *parts in block.entries()]
            yield pd.DataFrame(sent, columns=["bucket", "block", "triggers", "windows", "least", "chars"])

    return run


def suffix_order(chars: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by the ``WINDOW`` bytes that start there, and which of them
    differ from the one before."""
    wide = -(-WINDOW // 8) * 8
    columns = []
    for k in range(0, wide, 8):
        word = np.zeros((len(place), 8), dtype=np.uint8)
        n = min(8, WINDOW - k)
        word[:, :n] = chars[place[:, None] + np.arange(k, k + n)]
        columns.append(word.view(">u8").ravel().astype(_U))
    by = np.lexsort(columns[::-1])
    new = np.zeros(len(place), dtype=bool)
    if len(place):
        new[0] = True
    for c in columns:
        c = c[by]
        new[1:] |= c[1:] != c[:-1]
    return by, new


def distinct_phrases(chars: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each phrase the first phrase with the same bytes. Hashes propose,
    bytes decide."""
    wide = SPAN + WINDOW - 1
    rows = np.zeros((len(n), wide + 1), dtype=np.uint8)
    rows[:, wide] = n
    size = n + WINDOW - 1
    line = np.repeat(np.arange(len(n)), size)
    step = np.arange(len(line)) - np.repeat(start, size)
    rows[line, step] = chars
    weights = mix(np.arange(1, wide + 2, dtype=_U)) | _U(1)
    value = np.empty(len(n), dtype=_U)
    for a in range(0, len(n), 1 << 14):
        value[a : a + (1 << 14)] = mix((_BYTE[rows[a : a + (1 << 14)]] * weights).sum(axis=1, dtype=_U))
    _, first, which = np.unique(value, return_index=True, return_inverse=True)
    like = first[which]
    differs = (rows != rows[like]).any(axis=1)
    like[differs] = np.flatnonzero(differs)  # such a phrase stands for itself
    return like


def _firsts(pdf: pd.DataFrame) -> pd.DataFrame:
    """For every window of a bucket's phrases the least id that starts it, in
    runs, block by block. Only distinct phrases are sorted, and of these only
    those that share their trigger with another one: all places that start a
    window lie under its one trigger."""
    unpress = zstandard.ZstdDecompressor()
    pdf = pdf.sort_values("block")
    windows = [np.frombuffer(x, dtype=np.uint8).astype(np.int64) for x in pdf["windows"]]
    n, ids = np.concatenate(windows), np.concatenate([np.frombuffer(x, dtype=np.int64) for x in pdf["least"]])
    chars = np.frombuffer(b"".join(unpress.decompress(x) for x in pdf["chars"]), dtype=np.uint8)
    start = np.concatenate(([0], np.cumsum(n + WINDOW - 1)[:-1]))
    like = distinct_phrases(chars, start, n)
    np.minimum.at(ids, like, ids)
    word = np.flatnonzero(like == np.arange(len(n)))  # the dictionary
    triggers = np.concatenate([np.frombuffer(x, dtype="<u4") for x in pdf["triggers"]])
    _, which, count = np.unique(triggers[word], return_inverse=True, return_counts=True)
    word = word[count[which] > 1]
    edge = np.concatenate(([0], np.cumsum(n)))  # of each phrase's windows
    entry = np.repeat(np.arange(len(n)), n)
    least = ids[entry]
    mine = np.repeat(word, n[word])
    step = np.arange(len(mine)) - np.repeat(np.cumsum(n[word]) - n[word], n[word])
    by, new = suffix_order(chars, start[mine] + step)
    if len(by):
        group = np.flatnonzero(new)
        found = np.empty(len(by), dtype=np.int64)
        found[by] = np.repeat(np.minimum.reduceat(ids[mine][by], group), np.diff(np.append(group, len(by))))
        least[edge[mine] + step] = found
    # copies of a phrase take what was found for it
    least = least[np.repeat(edge[like] - edge[:-1], n) + np.arange(len(entry))]
    # runs of one id within one phrase
    turn = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (entry[1:] != entry[:-1]))))
    runs, least = np.diff(np.append(turn, len(entry))), least[turn]
    ends = np.cumsum([x.sum() for x in windows])
    edge = np.concatenate(([0], np.searchsorted(turn, ends)))
    rows = [(b, runs[x:y].astype(np.uint8).tobytes(), least[x:y].tobytes()) for b, x, y in zip(pdf["block"], edge, edge[1:], strict=False)]
    return pd.DataFrame(rows, columns=["block", "runs", "least"]).assign(bucket=int(pdf["bucket"].iloc[0]))


def _lay_over(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, block in _blocks(batches, buckets):
            block.keep(row.bits if row.bits is not None else [], row.windows if row.windows is not None else [])
            gone = block.removed(row.replies if row.replies is not None else [])
            rows, at = [], 0
            for i, size in zip(block.ids.tolist(), block.sizes.tolist(), strict=True):
                mine = gone[at : at + size]
                turn = np.flatnonzero(np.diff(np.concatenate(([False], mine, [False])).astype(np.int8)))
                spans = turn.reshape(-1, 2)
                kept = block.data[at : at + size][~mine].tobytes()
                rows.append((None if i == NO_ID else i, size, int(mine.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans.tolist()))
                at += size
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]).astype({"id": "Int64"})

    return run


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (of the
    remaining bytes) and ``spans`` (removed runs: start, end in bytes) of every row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    packed = cut(rows.mapInPandas(_pack, "block bigint, ids binary, sizes binary, data binary, n_bytes bigint"), "blocks")
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = int(total // BLOCK) + 1
    key_type, bit_type = "bucket bigint, block bigint, keys binary, several binary, many binary", "block bigint, bits binary, hot binary, bucket bigint"
    keys = packed.mapInPandas(_send_keys(buckets), key_type)
    bits = keys.groupBy("bucket").applyInPandas(_shared, bit_type)
    per_block = cut(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits", "hot")).alias("bits")), "shared")
    hot = per_block.where(F.exists("bits", lambda r: r["hot"].isNotNull()))
    if hot.isEmpty():
        per_block = per_block.withColumn("windows", F.lit(None).cast("array<struct<bucket:bigint,bits:binary>>"))
    else:
        again = packed.join(hot, "block").mapInPandas(_send_keys(buckets, windows=True), key_type).groupBy("bucket").applyInPandas(_shared, bit_type)
        windows = cut(again.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("windows")), "shared_windows")
        per_block = per_block.join(windows, "block", "left")
    entries = packed.join(per_block, "block").mapInPandas(_send_entries(buckets), "bucket bigint, block bigint, triggers binary, windows binary, least binary, chars binary")
    firsts = entries.groupBy("bucket").applyInPandas(_firsts, "block bigint, runs binary, least binary, bucket bigint")
    replies = firsts.groupBy("block").agg(F.collect_list(F.struct("bucket", "runs", "least")).alias("replies"))
    asked = packed.join(per_block.join(replies, "block"), "block", "left")
    return asked.mapInPandas(_lay_over(buckets), "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>")
