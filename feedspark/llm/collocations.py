"""Collocations: phrases of two to four words that stick together.

A phrase can only be frequent if its words are, its pairs of neighbours, and
any bucket of hashes it falls into: words are counted first, then the buckets of
pairs of frequent words, then the buckets of phrases of three and four words
whose pairs all lie in frequent buckets, then the phrases of frequent buckets
themselves. A bucket's count is that of all its phrases or more, so no frequent
phrase is held back. What is frequent goes to the tasks as a bitmap of hashes, of
bounded size however much there is of it; a phrase it lets through by mistake is
counted and then left out.

A task counts phrases in a HAT-trie over its own word ids: hash containers under a
shallow trie that burst into a node of containers where they grow. When the trie
holds too much, whole subtrees, the largest first, leave as sorted runs. Spark
deals the runs to partitions by a hash of language and phrase, the whole phrase
being the prefix (a shorter one may be most of a corpus), where equal phrases
meet and their counts are summed; so no task holds a corpus' phrases.

Defined results: a null language is ``und``; null and empty texts hold no words;
every row is a document of its own; ties of scores go to the larger count, then
to the smaller phrase in byte order; numbers are exact at any size; texts of any
length are read whole, in pieces of about ``CHUNK`` bytes cut where phrases end;
an empty table gives an empty table; other columns are not looked at.
"""
from __future__ import annotations

import gc
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words
TOP = 2000  # phrases of a language
INSIDE = 80  # per cent of a phrase's occurrences that a longer one may hold
SCALE = 2_000_000
UNKNOWN = "und"
BURST = 4096  # entries of a container that becomes a node
LIMIT = 300_000  # entries of a trie that sends subtrees out, and words a task numbers
RUN = 50_000  # entries of a run at least, if there are more
CHUNK = 1 << 20  # bytes worked on at once
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 31  # of the bitmap; at most 256 MiB
PER_BUCKET = 4  # occurrences of words for each bucket of phrases, until there are MOST_BITS of them
HELD = 1 << 22  # codes of a task that are counted and sent out at once
SALTS = 64
PAIR = 2_654_435  # a phrase's code: that of all words but the last times this, and the last one's hash
# pieces end at these, which no word holds
_ENDS = bytes(0x0A if c in b".,;:!?\x0b\x0c\r" else c for c in range(256))
_LETTER = np.array([c not in b" \t\n" for c in range(256)])  # of a chunk's bytes


class HatTrie:
    """Counts of id sequences. Under the first id hangs a hash container of
    the other ids; one with more than ``burst`` entries bursts into a node,
    next id to container, where one id at least is left to part it by; a phrase
    that ends there is counted under no further ids."""

    def __init__(self, burst: int = BURST):
        self.burst, self.size = burst, 0
        self.root: dict[int, list] = {}  # id: [entries, container or node, is a node]

    def add(self, rows: list[tuple[int, ...]], counts: list[int]) -> None:
        root = self.root
        for row, n in zip(rows, counts, strict=True):
            tree = root.get(row[0])
            if tree is None:
                tree = root[row[0]] = [0, {}, False]
            rest = row[1:]
            hold = tree[1]
            if tree[2]:
                hold = hold.get(rest[0])
                if hold is None:
                    hold = tree[1][rest[0]] = {}
                rest = rest[1:]
            if rest in hold:
                hold[rest] += n
            else:
                hold[rest] = n
                tree[0] += 1
                self.size += 1
                if not tree[2] and tree[0] > self.burst and len(rest) > 1:
                    self._burst(tree)

    def _burst(self, tree: list) -> None:
        node: dict[int, dict] = {}
        for rest, n in tree[1].items():
            node.setdefault(rest[0], {})[rest[1:]] = n
        tree[1], tree[2] = node, True

    def containers(self, first: int) -> Iterator[tuple[tuple[int, ...], dict]]:
        """Containers below a first id, each with the ids above it."""
        _, hold, node = self.root[first]
        if node:
            for second, container in hold.items():
                yield (first, second), container
        else:
            yield (first,), hold

    def take(self, to: int) -> Iterator[list[tuple[tuple[int, ...], dict]]]:
        """Take out the containers of whole subtrees, the largest first, until
        ``to`` entries are left."""
        for first in sorted(self.root, key=lambda i: -self.root[i][0]):
            if self.size <= to:
                return
            yield list(self.containers(first))
            self.size -= self.root.pop(first)[0]

    def spill(self, to: int) -> Iterator[list[tuple[tuple[int, ...], int]]]:
        """The same as lists of (ids, count)."""
        for tree in self.take(to):
            yield [((*above, *rest), n) for above, container in tree for rest, n in container.items()]


def _chunks(text: str) -> Iterator[bytes]:
    """A text's bytes, A-Z as a-z and line ends where pieces end."""
    data = text.encode().lower().translate(_ENDS)
    at = 0
    while at < len(data):
        to = len(data) if len(data) - at <= CHUNK else data.find(b"\n", at + CHUNK) + 1 or len(data)
        yield data[at:to]
        at = to


def _sorted_run(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    yield from pa.concat_tables(parts).sort_by([("lang", "ascending"), ("phrase", "ascending")]).to_batches()


def _rows_of(lang: pa.Array, phrase: pa.Array, n) -> pa.Table:
    return pa.table({"lang": lang.cast(pa.string()), "phrase": phrase.cast(pa.string()), "n": pa.array(n, pa.int64())})


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    """One text at a time: a batch's are not held twice."""
    for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
        yield lang.as_py(), text.as_py()


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Chunks of about ``CHUNK`` bytes of a language's texts, at most eight waiting."""
    waiting: dict[str, list[bytes]] = {}
    size: Counter = Counter()
    held = 0
    for batch in batches:
        for lang, text in _texts(batch):
            for data in _chunks(text):
                waiting.setdefault(lang, []).append(data)
                size[lang] += len(data)
                held += len(data)
                full = [lang] if size[lang] >= CHUNK else list(waiting) if held >= 8 * CHUNK else []
                for one in full:
                    held -= size.pop(one)
                    yield one, b"\n".join(waiting.pop(one))
    for lang, parts in waiting.items():
        yield lang, b"\n".join(parts)


def _tokens(data: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
    """A chunk's words in order, and the number of each one's piece."""
    chars = np.frombuffer(data, np.uint8)
    inside = _LETTER[chars]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, dtype=np.int32, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(chars[inside])])
    return words.dictionary_encode(), np.cumsum(chars == 0x0A, dtype=np.int32)[start]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of words; a word is a trie's root, so its count hangs there."""
    counts: dict[str, Counter] = {}

    def held() -> Iterator[pa.RecordBatch]:
        if counts:
            yield from _sorted_run([_rows_of(pa.array([lang] * len(c)), pa.array(list(c), pa.binary()), list(c.values())) for lang, c in counts.items()])

    for lang, data in _by_lang(batches):
        words = _tokens(data)[0]
        count = counts.setdefault(lang, Counter())
        for word, n in zip(words.dictionary.to_pylist(), np.bincount(words.indices.to_numpy()).tolist(), strict=True):
            count[word] += n
        if sum(map(len, counts.values())) > LIMIT:
            yield from held()
            counts = {}
    yield from held()


class _Words:
    """Numbers of a task's frequent words; each language has its own."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.of: dict[str, dict[bytes, int]] = {}
        self.word: list[bytes] = []
        self.crc = array("q")
        self.lang: list[str] = []

    def full(self) -> bool:
        return sum(map(len, self.of.values())) > 2 * LIMIT

    def ids(self, lang: str, data: bytes) -> np.ndarray:
        """Ids of the words, -1 for rare ones and behind every piece."""
        tokens, piece = _tokens(data)
        words = tokens.dictionary.to_pylist()
        known = self.of.setdefault(lang, {})
        fresh = [w for w in words if w not in known]
        if fresh:
            head = zlib.crc32(lang.encode() + b"\0")
            crcs = [zlib.crc32(w, head) for w in fresh]
            for w, crc, often in zip(fresh, crcs, _held(self.bits, np.array(crcs)).tolist(), strict=True):
                if often:
                    known[w] = len(self.word)
                    self.word.append(w), self.crc.append(crc), self.lang.append(lang)
                else:
                    known[w] = -1
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))[tokens.indices.to_numpy()]
        return np.append(np.insert(ids, np.flatnonzero(np.diff(piece)) + 1, -1), -1)

    def phrases(self, ids: np.ndarray, pairs: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Sizes from two words on, with the places and codes of the phrases of
        frequent words, all of whose pairs have bits in ``pairs`` if given."""
        if not self.crc:
            return
        word = np.array(self.crc)[ids]
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        code = word[at] * PAIR + word[at + 1]
        if pairs is not None:
            on = _held(pairs, code)
            at, code = at[on], code[on]
        yield 2, at, code
        on = np.zeros(len(ids), dtype=bool)
        on[at] = True
        for size in range(3, LONGEST + 1):
            further = on[at + size - 2]
            at, code = at[further], code[further]
            code = code * PAIR + word[at + size - 1]
            yield size, at, code


def _held(bits: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether the bits of the codes are set."""
    at = code & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7) & 1).astype(bool)


def _count_buckets(words, pairs, buckets: int):
    """Counts of the buckets of pairs of frequent words, or (given a bitmap of
    ``pairs``) of longer phrases, packed by the part of the bitmap they lie in."""

    def packed(codes: list[np.ndarray]) -> pa.RecordBatch:
        place, n = np.unique(np.concatenate(codes), return_counts=True)
        part, start = np.unique(place // LEAST_BITS, return_index=True)
        ends = np.append(start, len(place))

        def column(of: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((ends * of.itemsize).astype(np.int32)), pa.py_buffer(of)])

        return pa.record_batch(
            {"part": pa.array(part, pa.int64()), "places": column((place % LEAST_BITS).astype(np.uint16)), "n": column(n.astype(np.uint32))}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Words(np.frombuffer(words.value, dtype=np.uint8))
        often = None if pairs is None else np.frombuffer(pairs.value, dtype=np.uint8)
        codes, held = [], 0
        for lang, data in _by_lang(batches):
            for size, _, code in own.phrases(own.ids(lang, data), often):
                if size > 2 or often is None:
                    codes.append((code & (buckets - 1)).astype(np.uint32))
                    held += len(code)
                if often is None:
                    break
            if held > HELD:
                yield packed(codes)
                codes, held = [], 0
            if own.full():
                own.clear()
        if held:
            yield packed(codes)
        # the worker goes on to other tasks
        pa.default_memory_pool().release_unused()

    return run


def _count_phrases(words, pairs, longer):
    """Sorted runs of the phrases of frequent words all of whose pairs, and in
    longer ones they themselves, lie in frequent buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trie = _Words(np.frombuffer(words.value, dtype=np.uint8)), HatTrie()
        often, often_longer = (np.frombuffer(b.value, dtype=np.uint8) for b in (pairs, longer))

        def out(to: int) -> Iterator[pa.RecordBatch]:
            words_, langs, found, size = pa.array(own.word, pa.binary()), pa.array(own.lang, pa.string()), [], 0
            for tree in trie.take(to):
                found += tree
                size += sum(len(container) for _, container in tree)
                if size >= RUN:
                    yield from _sorted_run(tables(words_, langs, found))
                    found, size = [], 0
            if found:
                yield from _sorted_run(tables(words_, langs, found))

        def tables(words_: pa.Array, langs: pa.Array, found: list) -> list[pa.Table]:
            rests = [rest for _, container in found for rest in container]
            n = np.fromiter(chain.from_iterable(container.values() for _, container in found), np.int64, len(rests))
            size = np.fromiter(map(len, rests), np.int64, len(rests))
            flat = np.fromiter(chain.from_iterable(rests), np.int64, int(size.sum()))
            start = np.cumsum(size) - size
            held = [len(container) for _, container in found]
            depth = np.repeat([len(above) for above, _ in found], held)
            above = [np.repeat([ids[min(k, len(ids) - 1)] for ids, _ in found], held) for k in (0, 1)]
            parts = []
            for d, s in {*zip(depth.tolist(), size.tolist(), strict=True)}:
                mine = (depth == d) & (size == s)
                ids = [a[mine] for a in above[:d]] + [flat[start[mine] + k] for k in range(s)]
                phrase = pc.binary_join_element_wise(*(words_.take(pa.array(i)) for i in ids), b" ")
                parts.append(_rows_of(langs.take(pa.array(ids[0])), phrase, n[mine]))
            return parts

        def count(ids: np.ndarray) -> None:
            for size, at, code in own.phrases(ids, often):
                if size == 2:
                    both, times = np.unique(ids[at] << 32 | ids[at + 1], return_counts=True)
                    trie.add(list(zip((both >> 32).tolist(), (both & 0xFFFFFFFF).tolist(), strict=True)), times.tolist())
                    continue
                mine = at[_held(often_longer, code)]
                rows = Counter(zip(*(ids[mine + k].tolist() for k in range(size)), strict=True))
                trie.add(list(rows), list(rows.values()))

        # millions of tuples and no cycles among them: nothing to collect
        gc.disable()
        try:
            for lang, data in _by_lang(batches):
                count(own.ids(lang, data))
                if trie.size > LIMIT:
                    yield from out(LIMIT // 2)
                if own.full():
                    yield from out(0)
                    own.clear()
            yield from out(0)
        finally:
            gc.enable()
            # the worker goes on to other tasks
            pa.default_memory_pool().release_unused()

    return run


_RUN = "lang string, phrase string, n bigint"
_PACKED = "part bigint, places binary, n binary"


def _merged(runs: DataFrame, name: str, least: int | None) -> DataFrame:
    """Equal phrases of all runs, summed; those of ``least`` occurrences."""
    total = runs.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    return cut(total if least is None else total.where(F.col("f") >= least), name)


def _code(word: Column) -> Column:
    """Hash of a word of a language."""
    return F.crc32(F.concat("lang", F.lit("\0"), word).cast("binary"))


def _joined(parts: DataFrame, bits: int) -> bytes:
    """A bitmap of its (``part``, ``bits``); parts not given are empty."""
    out = bytearray(bits // 8)
    for r in parts.toLocalIterator():
        out[r["part"] * LEAST_BITS // 8 : (r["part"] + 1) * LEAST_BITS // 8] = r["bits"]
    return bytes(out)


def _bits_of(pdf: pd.DataFrame, held: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "bits": [np.packbits(held, bitorder="little").tobytes()]})


def _width(n: int) -> int:
    """Bits for ``n`` entries, up to ``MOST_BITS``: fuller than meant beyond
    that, a bitmap only holds back less."""
    bits = LEAST_BITS
    while bits < min(n, MOST_BITS):
        bits *= 2
    return bits


def _bitmap(frequent: DataFrame, code: Column, n: int) -> bytes:
    """A bit for the code of every one of ``n`` phrases."""
    bits = _width(BITS_EACH * n)
    place = code.bitwiseAND(F.lit(bits - 1))

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        hold = np.zeros(LEAST_BITS, dtype=np.uint8)
        hold[pdf["place"].to_numpy() % LEAST_BITS] = 1
        return _bits_of(pdf, hold)

    spread = frequent.select(place.alias("place")).distinct().withColumn("part", F.expr(f"place div {LEAST_BITS}"))
    return _joined(spread.groupBy("part").applyInPandas(part, "part bigint, bits binary"), bits)


def _buckets(counts: DataFrame, name: str, buckets: int, least: int) -> bytes:
    """A bit for every bucket of ``least`` occurrences in all tasks together."""

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        places, n = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("places", np.uint16), ("n", np.uint32)))
        return _bits_of(pdf, np.bincount(places, n, LEAST_BITS) >= least)

    return _joined(cut(counts.groupBy("part").applyInPandas(part, "part bigint, bits binary"), name), buckets)


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``phrase``, ``f``, ``words``) of every word and phrase of at
    least ``least`` occurrences, and (``lang``, ``n``), the words of a language."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where("text IS NOT NULL AND text <> ''")
    context = docs.sparkSession.sparkContext
    words = _merged(rows.mapInArrow(_count_words, _RUN), "words", None)
    often = words.where(F.col("f") >= least)
    n, total = often.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    known = context.broadcast(_bitmap(often, _code(F.col("phrase")), n))
    buckets, maps = _width(total // PER_BUCKET), [None]
    for name in ("pairs", "longer"):
        counts = rows.mapInArrow(_count_buckets(known, maps[-1], buckets), _PACKED)
        maps.append(context.broadcast(_buckets(counts, name, buckets, least)))
    more = _merged(rows.mapInArrow(_count_phrases(known, *maps[1:]), _RUN), "counted", least)
    every = often.unionByName(more)
    every = every.withColumn("words", F.size(F.split("phrase", " ")))
    return every, words.groupBy("lang").agg(F.sum("f").alias("n"))


def _inner(phrase: str, words: str, size: str) -> str:
    """SQL: phrases of ``size`` words or more inside one, but itself."""
    return f"""flatten(transform(sequence(2, {words} - 1), s ->
        transform(sequence(1, {words} - s + 1), i -> array_join(slice(split({phrase}, ' '), i, s), ' '))))"""


def mine(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, inside: int = INSIDE
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, its occurrences ``a``, those of the two
    parts of its weakest cut (``l`` and ``r``), the language's words ``n`` and
    the score of the ``top`` phrases of every language."""
    every, totals = phrases(docs, text_col, lang_col, least)
    every = cut(every, "phrases")
    found = every.where("words > 1")
    # the weakest cut: at most three a phrase; both parts are frequent themselves
    split = F.split("phrase", " ")
    parts = found.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    parts = parts.withColumn("first", F.array_join(F.slice(split, 1, F.col("k")), " "))
    parts = parts.withColumn("rest", F.array_join(F.slice(split, F.col("k") + 1, F.col("words")), " "))
    of = [every.select("lang", F.col("phrase").alias(p), F.col("f").alias(c)) for p, c in (("first", "l"), ("rest", "r"))]
    parts = parts.join(of[0], ["lang", "first"]).join(of[1], ["lang", "rest"])
    wide = "decimal(38,0)"  # products may pass 64 bits
    score = F.expr(f"cast(a as {wide}) * {SCALE} div (cast(l as {wide}) + cast(r as {wide}))")
    weakest = parts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # phrases that mostly occur inside one longer phrase
    held = every.where("words > 2").select("lang", "f", F.explode(F.expr(_inner("phrase", "words", "2"))).alias("phrase"))
    held = held.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = weakest.join(held, ["lang", "phrase"], "left")
    kept = kept.where(F.expr(f"most IS NULL OR cast(most as {wide}) * 100 < cast(a as {wide}) * {inside}"))
    kept = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    # the best of each salt first, so that no task orders a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    kept = kept.withColumn("_salt", salt).withColumn("rank", F.row_number().over(W.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return kept.join(F.broadcast(totals) if totals.count() <= 100_000 else totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
