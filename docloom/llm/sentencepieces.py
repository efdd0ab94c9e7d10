"""SentencePiece encoding with exact N-best segmentation, and decoding.

Pieces and scores come from a given model file. A text's best segmentation has the largest sum of piece scores. The N best are found as
in SentencePiece's lattices: a forward Viterbi pass gives every position the best score of all ways that lead to it, and a backward A*
search from the end uses these scores as its heuristic. As they are exact, segmentations leave the agenda in order of score.

No piece holds a space mark after another character, so that a text falls into units (space marks and what follows up to the
next space), and its segmentations are combinations of those of its units. The forward pass runs on all distinct
units of a batch at once. A unit's smallest loss by not taking its best way is the largest score on the agenda of the search after the first
result. In the N best segmentations of a text only the N - 1 units with the smallest losses can deviate, so that the A* search runs
on these alone, and a merge over the losses gives the text's N best.

Characters without a piece become the byte pieces of their UTF-8 form, at a penalty for each byte, so that decoding restores every text.
A literal space mark in a text is written in bytes as well, for it would come back as a space.

Any text ends in a time that grows with its length, also one of a repeated character, for a position of the lattice is expanded N times at most.

Defined results: null and empty texts have no pieces, one segmentation of score 0, and decode to the empty text; of equal scores the way whose last
piece is shorter comes first; repeated rows get equal results; other columns are kept by encode_column and not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .workspace import ship

MARK, LITERAL = "▁", "\ud800"  # no text from Spark holds a lone surrogate
NBEST = 3
U = np.uint64
_UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Units that a worker remembers; it then starts anew.
REMEMBER = 150_000
LONG = 48


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray  # by byte value
    usable: np.ndarray  # ordinary pieces, neither control nor byte pieces
    penalty: float = 0.0
    index: dict[str, int] = field(default_factory=dict)
    longest: int = 0

    def __post_init__(self) -> None:
        self.index = {p: i for i, p in enumerate(self.pieces) if self.usable[i]}
        self.longest = max(map(len, self.index), default=1)
        plain = self.scores[self.usable & (self.scores > -1e8)]
        self.penalty = float(plain.min()) - 10.0 if len(plain) else -10.0
        self.scores = np.where(self.scores > -1e8, self.scores, self.penalty)  # some models mark space runs by a score far below all others
        if any(MARK in p.lstrip(MARK) for p in self.index):
            raise ValueError("a piece holds a space mark after another character")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in ids]
        byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        usable = np.array([not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i)) for i in ids])
        return cls(pieces, np.array([model.get_score(i) for i in ids]), byte_ids, usable)

    def raw_bytes(self, char: str) -> bytes:
        return (MARK if char == LITERAL else char).encode()

    def ways(self, unit: str, end: int) -> Iterator[tuple[int, tuple[int, ...], float]]:
        """Pieces that end at a position, shortest first: where they begin, their ids, their score."""
        char = unit[end - 1]
        one = self.index.get(char)
        if one is None:
            data = self.raw_bytes(char)
            yield end - 1, tuple(int(self.byte_ids[b]) for b in data), self.penalty * len(data)
        for begin in range(end - 1, max(end - self.longest, 0) - 1, -1):
            i = self.index.get(unit[begin:end])
            if i is not None:
                yield begin, (i,), float(self.scores[i])

    def forward(self, unit: str) -> list[float]:
        """The best score of all ways to each position."""
        best = [0.0] + [-np.inf] * len(unit)
        for end in range(1, len(unit) + 1):
            best[end] = max(best[begin] + score for begin, _, score in self.ways(unit, end))
        return best

    def search(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a unit, best first: backward A* with the forward scores as heuristic.

        What follows a position in one of the n best ways is one of the n best from there on, so that each position is
        expanded n times at most; without this bound, ways of equal scores would multiply along a repeated character.
        """
        best = self.forward(unit)
        agenda: list = [(-best[len(unit)], 0, len(unit), 0.0, None)]
        count, found, expanded = 0, [], [0] * (len(unit) + 1)
        while agenda and len(found) < n:
            _, _, end, after, tail = heapq.heappop(agenda)
            expanded[end] += 1
            if expanded[end] > n:
                continue
            if end == 0:
                ids: list[int] = []
                while tail is not None:
                    ids += tail[0]
                    tail = tail[1]
                found.append((after, tuple(ids)))
                continue
            for begin, ids, score in self.ways(unit, end):
                count += 1
                heapq.heappush(agenda, (-(best[begin] + score + after), count, begin, after + score, (ids, tail)))
        return found


class Edit(NamedTuple):
    """Where a segmentation deviates from the best: in which unit, from which piece on, instead of how many pieces, by which ids."""

    unit: int
    first: int
    pieces: int
    ids: tuple[int, ...]


def units_of(text: str) -> list[str]:
    """The text with spaces as marks and one mark before it, cut into units; the empty text has none."""
    if not text:
        return []
    return _UNIT.findall(MARK + text.replace(MARK, LITERAL).replace(" ", MARK))


class Encoder:
    """Segments units in batches and remembers them."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        keys = [(p, i) for p, i in vocabulary.index.items()]
        points, bounds = tk.codes([p for p, _ in keys])
        hashes = tk.hash_spans(points, bounds[:-1], bounds[1:] - 1)
        self.table = tk.HashTable(hashes, np.array([i for _, i in keys]))
        self.score = np.append(vocabulary.scores, -np.inf)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, tuple[bytes, float, float]] = {}  # of a unit: its ids as int32, their score, the smallest loss
        self.aged = self.known
        self.deviations: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}

    def learn(self, units: Sequence[str]) -> None:
        """Segment units that are not known yet; units not seen for long are forgotten."""
        if len(self.known) > REMEMBER:
            self.known, self.aged = {}, self.known
        known, aged = self.known, self.aged
        fresh = [u for u in units if u not in known]
        if aged is not known:
            known.update((u, aged[u]) for u in fresh if u in aged)
            fresh = [u for u in fresh if u not in known]
        short = [u for u in fresh if len(u) <= LONG]
        short.sort(key=len)
        for part in tk.pieces(short, 200_000, 1 << 15):
            self._batch(short[part])
        for u in fresh:
            if len(u) > LONG:
                two = self.v.search(u, 2)
                known[u] = np.array(two[0][1], np.int32).tobytes(), two[0][0], two[0][0] - two[1][0] if len(two) > 1 else np.inf

    def _batch(self, units: Sequence[str]) -> None:
        """Viterbi over all units in step: arrays run over units, the loop over positions and piece lengths."""
        n, lengths = len(units), np.array([len(u) for u in units])
        most = int(lengths.max())
        points, bounds = tk.codes(units)
        power, inverse = tk._powers(len(points))
        sums = np.zeros(len(points) + 1, U)
        np.cumsum((points.astype(U) + U(1)) * power[: len(points)], out=sums[1:])
        first = bounds[:-1]
        best = np.full((n, most + 1), -np.inf)
        best[:, 0] = 0
        piece, back = np.full((n, most + 1), -1, np.int32), np.zeros((n, most + 1), np.int32)
        tried: list[tuple[int, np.ndarray, int, np.ndarray]] = []  # all edges: end, units, begin, score
        for end in range(1, most + 1):
            rows = np.flatnonzero(lengths >= end)
            e = first[rows] + end
            upto = sums[e]
            for size in range(1, min(end, self.v.longest) + 1):
                b = e - size
                own, found = rows, self.table.find(tk.mix((upto - sums[b]) * inverse[b] + U(size * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)))
                if size > 1:
                    ok = np.flatnonzero(found >= 0)
                    own, found = rows[ok], found[ok]
                if not len(own):
                    continue
                score = self.score[found]
                if size == 1:
                    for r in np.flatnonzero(found < 0):
                        score[r] = self.v.penalty * len(self.v.raw_bytes(units[rows[r]][end - 1]))
                tried.append((end, own, end - size, score))
                total = best[own, end - size] + score
                better = total > best[own, end]
                own, total, found = own[better], total[better], found[better]
                best[own, end], piece[own, end], back[own, end] = total, found, end - size
        # follow the best way back; what other edges into its positions would lose is the agenda of the search
        on_way = np.zeros((n, most + 1), bool)
        at, row, turn, came = lengths.copy(), np.arange(n), 0, []
        while len(row):
            on_way[row, at] = True
            came.append((row, np.full(len(row), -turn), piece[row, at], at))
            at = back[row, at]
            row, at, turn = row[at > 0], at[at > 0], turn + 1
        rows, turns, ids, ends = (np.concatenate(c) for c in zip(*came, strict=True))
        order = np.lexsort((turns, rows))
        rows, ids, ends = rows[order], ids[order], ends[order]
        cuts = np.searchsorted(rows, np.arange(n + 1)).tolist()
        odd = set(rows[ids < 0].tolist())
        data = ids.astype(np.int32).tobytes()
        loss = np.full(n, np.inf)
        for end, own, begin, score in tried:
            use = on_way[own, end] & (back[own, end] != begin)
            own, score = own[use], score[use]
            loss[own] = np.minimum(loss[own], best[own, end] - best[own, begin] - score)  # a unit stands once in each of tried
        top, loss = best[np.arange(n), lengths].tolist(), loss.tolist()
        for r, u in enumerate(units):
            own = data[4 * cuts[r] : 4 * cuts[r + 1]]
            if r in odd:
                own = np.array([x for k in range(cuts[r], cuts[r + 1]) for x in ([ids[k]] if ids[k] >= 0 else [self.v.byte_ids[y] for y in self.v.raw_bytes(u[ends[k] - 1])])], np.int32).tobytes()
            self.known[u] = own, top[r], loss[r]

    def nbest(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        key = (unit, n)
        if key not in self.deviations:
            if len(self.deviations) > REMEMBER // 10:
                self.deviations.clear()
            self.deviations[key] = self.v.search(unit, n)
        return self.deviations[key]

    def encode(self, texts: Sequence[str], n: int = NBEST) -> Iterator[tuple[list[float], np.ndarray, list[list[Edit]], list[str]]]:
        """For each text: the scores of its n best segmentations, best first, fewer if it has fewer; the ids of the best; how each of them
        deviates from it; and the text's units."""
        for part in tk.pieces(texts, 1_000_000):
            cut = [units_of(t) for t in texts[part]]
            self.learn(list(dict.fromkeys(chain.from_iterable(cut))))
            for units in cut:
                if not units:
                    yield [0.0], np.zeros(0, np.int32), [[]], units
                    continue
                data, best, loss = zip(*map(self.known.__getitem__, units), strict=True)
                scores, ways = self._merge(units, np.array(loss), float(sum(best)), n)
                edits = [[Edit(u, sum(map(len, data[:u])) // 4, len(data[u]) // 4, other) for u, other in sorted(way)] for way in ways]
                yield scores, np.frombuffer(b"".join(data), np.int32), edits, units

    def _merge(self, units: Sequence[str], loss: np.ndarray, total: float, n: int) -> tuple[list[float], list[list[tuple[int, tuple[int, ...]]]]]:
        m = min(n - 1, len(units))
        if not m:
            return [total], [[]]
        near = np.argpartition(loss, m - 1)[:m] if m < len(units) else np.arange(len(units))
        edge = loss[near].max()
        near = np.concatenate([np.flatnonzero(loss < edge), np.flatnonzero(loss == edge)])[:m]
        merged = [(0.0, [])]
        for u in sorted(near[np.isfinite(loss[near])].tolist()):
            own = self.nbest(units[u], n)
            options = [(own[0][0] - s, [(u, ids)] if k else []) for k, (s, ids) in enumerate(own)]
            merged = heapq.nsmallest(n, ((a + b, x + y) for a, x in merged for b, y in options), key=lambda c: (c[0], c[1]))
        return [total - lost for lost, _ in merged], [ways for _, ways in merged]

    def nbest_ids(self, text: str, n: int = NBEST) -> list[tuple[float, list[int]]]:
        """The n best segmentations of one text, best first."""
        ((scores, best, edits, _),) = self.encode([text], n)
        out = []
        for score, own in zip(scores, edits, strict=True):
            ids = best.tolist()
            for e in reversed(own):
                ids[e.first : e.first + e.pieces] = e.ids
            out.append((score, ids))
        return out


def decode(vocabulary: Vocabulary, ids: Sequence[int]) -> str:
    """The text of a segmentation, without the space that it begins with. Unknown ids raise an IndexError."""
    return decoder(vocabulary)(ids)[1:]


def decoder(vocabulary: Vocabulary):
    """A function that turns ids into what they stand for."""
    surface = [p.replace(MARK, " ").encode() if vocabulary.usable[i] else b"" for i, p in enumerate(vocabulary.pieces)]
    for b, i in enumerate(vocabulary.byte_ids):
        surface[i] = bytes([b])

    def run(ids: Sequence[int]) -> str:
        return b"".join(map(surface.__getitem__, ids)).decode()

    return run


_encoders: dict[str, tuple[Encoder, object]] = {}


ADDED = ("n_pieces int", "piece_ids array<int>", "nbest_scores array<double>", "nbest_edits array<array<struct<first:int,pieces:int,ids:array<int>>>>", "roundtrip boolean")


def encode_column(docs: DataFrame, model_path: str, n: int = NBEST, text_col: str = "text") -> DataFrame:
    """docs with n_pieces and piece_ids (of the best segmentation), nbest_scores, nbest_edits (how each of the n deviates from the best: for a few units
    the ids instead of some pieces; see nbest_ids), and roundtrip, whether the best decodes to the text and the others' units to the same as the best's.

    These names replace equal ones of the input. The model file is read on the driver and its pieces are sent along.
    """
    ship(docs.sparkSession)
    vocabulary = Vocabulary.load(model_path)
    new = [c.split()[0] for c in ADDED]
    source = docs.drop(*new)
    schema = source.withColumns({name: F.lit(None).cast(c.split()[1]) for name, c in zip(new, ADDED, strict=True)}).schema
    return source.mapInArrow(partial(_encode_batches, vocabulary, model_path, n, source.columns.index(text_col), [*source.columns, *new]), schema)


def nbest_ids(best: str = "piece_ids", edits: str = "nbest_edits") -> Column:
    """The ids of all n best segmentations, as an array of arrays."""

    def apply(ids: Column, e: Column) -> Column:
        rest = F.slice(ids, e["first"] + e["pieces"] + 1, F.greatest(F.size(ids) - e["first"] - e["pieces"], F.lit(0)))
        return F.concat(F.slice(ids, F.lit(1), e["first"]), e["ids"], rest)

    return F.transform(edits, lambda own: F.aggregate(F.reverse(own), F.col(best), apply))


def decode_column(docs: DataFrame, model_path: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """docs with the text of each row's piece ids; null ids give null. An equal name of the input is replaced."""
    ship(docs.sparkSession)
    vocabulary = Vocabulary.load(model_path)
    source = docs.drop(text_col)
    at, columns = source.columns.index(ids_col), [*source.columns, text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = decoder(vocabulary)
        for b in batches:
            texts = [None if ids is None else back(ids)[1:] for ids in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], columns)

    return source.mapInArrow(run, source.withColumn(text_col, F.lit(None).cast("string")).schema)


def _encode_batches(vocabulary: Vocabulary, name: str, n: int, at: int, columns: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A function of the module, so that a Python worker keeps its encoder from task to task."""
    if name not in _encoders:
        _encoders[name] = (Encoder(vocabulary), decoder(vocabulary))
    encoder, back = _encoders[name]
    kind = pa.list_(pa.list_(pa.struct([("first", pa.int32()), ("pieces", pa.int32()), ("ids", pa.list_(pa.int32()))])))
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            b = batch.slice(begin, 1000)
            texts = tk.text_list(b.column(at))
            ids, scores, changes, same = [], [], [], []
            for text, (ranked, own, edits, units) in zip(texts, encoder.encode(texts, n), strict=True):
                ids.append(own)
                scores.append(ranked)
                changes.append([[{"first": e.first, "pieces": e.pieces, "ids": e.ids} for e in way] for way in edits])
                surface = [(units[e.unit].replace(MARK, " ").replace(LITERAL, MARK), e.ids) for way in edits for e in way]
                same.append(back(own.tolist())[1:] == text and all(back(x) == u for u, x in surface))
            sizes = np.array([len(x) for x in ids], np.int32)
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes), lists, pa.array(scores, pa.list_(pa.float64())), pa.array(changes, kind), pa.array(same, pa.bool_())], columns)
