"""SentencePiece encoding and decoding with N-best segmentations.

The vocabulary is a byte-pair one: its scores are the ranks of its merges, taken
as they are for scores of pieces, so the best segmentation is the one of the
largest sum of ranks and need not be that of the merges. Texts are not
normalised.

A text becomes a lattice: every vocabulary piece that matches at a place is an
edge with the piece's score. No piece crosses from a letter to a blank mark, so
the lattice falls apart into units there, and equal units share their work. Per
unit a forward Viterbi pass gives the best score up to every place; these are
exact heuristics for an A-star search from the end backwards, which yields
segmentations in the order of their scores. The N best of a text combine those
of its units: only the N - 1 units whose second choice costs least can differ
from the best.

Scores are whole numbers in the vocabulary, so sums are exact and equal in any
order. Characters no piece covers fall back to their bytes.

Defined results: a null text is encoded like an empty one (no pieces, one
segmentation) and decodes to an empty text; blanks, line ends and blank marks of
a text come back as they were; ties go to the segmentation found first, which
depends on the unit alone; repeated rows give equal rows; an empty table gives
an empty table; texts of any length are encoded whole; other columns are not
looked at.
"""
from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the vocabulary file of a public tokenizer; a parameter everywhere
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
ROWS = 500  # rows of one batch that a task puts out
CACHE = 400_000  # units whose segmentation a task remembers at most
MARK = "▁"
# stands for a blank mark of the text itself; no text holds lone surrogates
_OWN_MARK = "\udc81"


def marked(text: str) -> str:
    """A text as the vocabulary writes it: marks for blanks, one in front."""
    return MARK + text.replace(MARK, _OWN_MARK).replace(" ", MARK)


def read_vocabulary(path: str = MODEL) -> dict:
    """Pieces, byte pieces and their scores of a model file; a few megabytes
    at most, read once on the driver."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    normal = [(p.id_to_piece(i), i, p.get_score(i)) for i in range(n) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    bytes_ = {int(p.id_to_piece(i)[3:5], 16): i for i in range(n) if p.is_byte(i)}
    if len(bytes_) < 256 or any(MARK in piece.lstrip(MARK) for piece, _, _ in normal):
        raise ValueError(f"{path}: needs byte pieces, and blank marks only at the start of pieces")
    return {"pieces": normal, "bytes": bytes_}


class Lattice:
    """Segmentations of units over one vocabulary."""

    def __init__(self, vocabulary: dict):
        import ahocorasick

        self.matcher = ahocorasick.Automaton()
        self.bytes, self.text = vocabulary["bytes"], {i: bytes([b]) for b, i in vocabulary["bytes"].items()}
        for piece, i, score in vocabulary["pieces"]:
            self.matcher.add_word(piece, (len(piece), score, i))
            self.text[i] = piece.replace(MARK, " ").encode()
        self.matcher.make_automaton()
        self.single = frozenset(p for p, _, _ in vocabulary["pieces"] if len(p) == 1)
        self.unknown = min((s for _, _, s in vocabulary["pieces"] if s > -1e8), default=0.0) - 10.0
        lines = any("\n" in p for p, _, _ in vocabulary["pieces"])
        self.units = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if lines else f"\n|{MARK}*[^{MARK}\n]+|{MARK}+").findall
        self.known: dict[str, tuple[bytes, float, float, bool]] = {}
        self.ranked: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def edges(self, unit: str) -> list[tuple[int, int, float, int]]:
        """(start, end, score, id) by end; id -1: the bytes of a character."""
        out = [(end + 1 - size, end + 1, score, i) for end, (size, score, i) in self.matcher.iter(unit)]
        if not self.single.issuperset(unit):
            out += [(k, k + 1, self.unknown, -1) for k, c in enumerate(unit) if c not in self.single]
            out.sort(key=lambda e: e[1])
        return out

    def ids(self, unit: str, path: list[tuple[int, int, float, int]]) -> tuple[int, ...]:
        out: list[int] = []
        for a, b, _, i in path:
            if i >= 0:
                out.append(i)
            else:
                c = unit[a:b]
                out += [self.bytes[x] for x in (MARK if c == _OWN_MARK else c).encode()]
        return tuple(out)

    def best(self, unit: str) -> tuple[bytes, float, float, bool]:
        """Ids (little-endian), score, what the second choice costs (infinite
        if there is none), and whether the ids give back the unit."""
        if unit not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[unit] = self._best(unit)
        return self.known[unit]

    def _forward(self, n: int, edges: list) -> tuple[list[float], list]:
        value, into = [0.0] + [float("-inf")] * n, [None] * (n + 1)
        for e in edges:
            v = value[e[0]] + e[2]
            if v > value[e[1]]:
                value[e[1]], into[e[1]] = v, e
        return value, into

    def _best(self, unit: str) -> tuple[bytes, float, float, bool]:
        n, none = len(unit), float("-inf")
        known = self.single.issuperset(unit)
        found = self.matcher.iter(unit) if known else [(b - 1, (b - a, s, i)) for a, b, s, i in self.edges(unit)]
        # the best and the second best score up to every place
        value, second, into = [0.0] + [none] * n, [none] * (n + 1), [None] * (n + 1)
        for end, (size, score, i) in found:
            end += 1
            a = end - size
            v, top = value[a] + score, value[end]
            if v > top:
                value[end], into[end] = v, (a, i)
                v = second[a] + score
                second[end] = top if top > v else v
            elif v > second[end]:
                second[end] = v
        ids, at = [], n
        while at:
            a, i = into[at]
            if i >= 0:
                ids.append(i)
            else:
                ids += self.ids(unit, [(a, at, 0.0, i)])[::-1]
            at = a
        ids.reverse()
        back = b"".join([self.text[i] for i in ids]) == unit.replace(MARK, " ").replace(_OWN_MARK, MARK).encode()
        return array("i", ids).tobytes(), value[n], value[n] - second[n], back

    def nbest(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations (all, if fewer): backward A-star whose
        heuristic, the forward Viterbi score, is exact."""
        found = self.ranked.get(unit)
        if found is not None and len(found) >= n:
            return found[:n]
        edges = self.edges(unit)
        value, _ = self._forward(len(unit), edges)
        into: list[list] = [[] for _ in range(len(unit) + 1)]
        for e in edges:
            into[e[1]].append(e)
        # of equally good ones the path nearest to the start goes on first, so
        # a unit full of ties is walked through, not spread out
        heap, turn, out = [(-value[-1], len(unit), 0, 0.0, None)], 0, []
        while heap and len(out) < n:
            _, at, _, done, path = heapq.heappop(heap)
            if at == 0:
                edges_, link = [], path
                while link:
                    edges_.append(link[0])
                    link = link[1]
                out.append((done, self.ids(unit, edges_)))
                continue
            for e in into[at]:
                turn += 1
                heapq.heappush(heap, (-(done + e[2] + value[e[0]]), e[0], turn, done + e[2], (e, path)))
        if len(self.ranked) >= CACHE // 10:
            self.ranked.clear()
        self.ranked[unit] = out
        return out

    def encode(self, text: str, n: int) -> tuple[bytes, float, list[tuple[float, list[tuple[int, tuple[int, ...]]]]]]:
        """Ids of the best segmentation, its score, and the ``n`` best as
        (score, units that differ: place in pieces of the best and own ids).
        ``gave_back`` then says that every unit's ids decode to the unit."""
        units = self.units(marked(text)) if text else []
        known, best = self.known.get, self.best
        found = [known(u) or best(u) for u in units]
        ids, score = b"".join([f[0] for f in found]), sum([f[1] for f in found])
        self.gave_back = all([f[3] for f in found])
        if n < 2:
            return ids, score, [(score, [])]
        losses = np.array([f[2] for f in found])
        cheap = np.argsort(losses, kind="stable")[: n - 1]
        choices = []
        for k in sorted(cheap[losses[cheap] < np.inf].tolist()):
            ranked = self.nbest(units[k], n)
            choices.append((k, [(ranked[0][0] - s, i) for s, i in ranked]))
        # best first over how far down each of these units' lists one goes
        heap, seen, out = [(0.0, (0,) * len(choices))], set(), []
        while heap and len(out) < n:
            loss, at = heapq.heappop(heap)
            out.append((score - loss, [(choices[c][0], choices[c][1][r][1]) for c, r in enumerate(at) if r]))
            for c in range(len(at)):
                if at[c] + 1 < len(choices[c][1]):
                    to = (*at[:c], at[c] + 1, *at[c + 1 :])
                    if to not in seen:
                        seen.add(to)
                        heapq.heappush(heap, (sum(choices[d][1][r][0] for d, r in enumerate(to)), to))
        if len(out) > 1:
            place = np.concatenate(([0], np.cumsum([len(f[0]) // 4 for f in found])))
            out = [(s, [(int(place[k]), i) for k, i in diff]) for s, diff in out]
        return ids, score, out

    def decode(self, ids: bytes) -> str:
        text = self.text
        out = b"".join([text[i] for i in np.frombuffer(ids, dtype="<i4").tolist()]).decode(errors="replace")
        return out[1:]


_ENCODED = "ids binary, score double, nbest array<struct<score:double,changes:array<struct<at:int,ids:array<int>>>>>, round_trip boolean"


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL, n_best: int = N_BEST, carry: list[str] | None = None, check: bool = True) -> DataFrame:
    """``row`` (the input row, or its ``carry`` columns) with ``ids`` (32-bit
    little-endian), ``score`` and ``nbest`` of its text: for each of the N best
    segmentations its score and the units in which it differs from the best
    (``at``: the place in the best's pieces); ``round_trip`` says that the ids
    decode to the text (null if not asked to ``check``)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast({"vocabulary": read_vocabulary(model)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a worker's tasks share its copy of the broadcast, and so one lattice and its units
        held = vocabulary.value
        lattice = held.setdefault("lattice", None) or Lattice(held["vocabulary"])
        held["lattice"] = lattice
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                pdf, rows = whole.iloc[at : at + ROWS], []
                for text in pdf["_text"]:
                    ids, score, best = lattice.encode(text or "", n_best)
                    ranked = [{"score": float(s), "changes": [{"at": a, "ids": list(i)} for a, i in d]} for s, d in best]
                    # where every unit comes back, so does the text
                    back = (lattice.gave_back or lattice.decode(ids) == (text or "")) if check else None
                    rows.append((ids, float(score), ranked, back))
                out = pd.DataFrame(rows, columns=["ids", "score", "nbest", "round_trip"])
                yield pd.concat([pdf.drop(columns="_text").reset_index(drop=True), out], axis=1)

    kept = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text_col}`").alias("_text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInPandas(run, f"row {kind}, {_ENCODED}")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(vocabulary.value)
        for pdf in batches:
            yield pdf.assign(decoded=[lattice.decode(x) for x in pdf["ids"]])

    return encoded.mapInPandas(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
