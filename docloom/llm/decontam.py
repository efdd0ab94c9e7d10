"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item is contained in a document if the document holds at least the share ``threshold`` of the item's distinct
shingles of five words (an item of 1 to 4 words is one shingle of all its words). Items are partitioned by
the power of two below their number of shingles. For the partition [s, 2s) every document, however long, is cut
into windows of 3s shingles, one at every s-th, so that MinHash applies and a passage as long as an item lies in one of them as a whole.
One agreement of the item's and a window's minimum under any of ``permutations`` makes a candidate. An item of n shingles of which a window holds k
agrees with it under one permutation with the probability k / (n + 3s - k), or more if the window repeats shingles: at n = s and k = 0.8s, the least, 1 / 4, so that all forty fail in one of
100,000 cases; a whole item is missed in one of ten million. Shingles that are scattered over a long document, one in a window, agree with at least 1 / 5,
and one of 7,500 such items is missed. Candidates are compared by the words themselves.

Items are read in blocks, each of which goes to all executors and is searched before the next is read, so that the driver holds one block only.

Defined results: null and empty texts and items contain nothing; very long texts are searched as a whole; items with equal minima are all candidates; repeated items and rows give repeated hits only for repeated
document rows; an empty table gives no rows; the hits carry no other columns, the filter keeps all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .workspace import Workspace, sent, ship

WORDS, THRESHOLD, PERMUTATIONS = 5, 0.8, 40
#: Items are searched in blocks of so many, each of which goes to all executors.
BLOCK = 20_000
SCHEMA = "doc_id bigint, item_id bigint, item_shingles int, shared int, containment double"


def _word_list(text: str) -> list[str]:
    low = text.lower()
    points, bounds = tk.codes([low])
    starts, ends, _ = tk.spans_of(points, bounds)
    return [low[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def _shingle_set(words: Sequence[str], k: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


class ItemIndex:
    """MinHash values of a block of items by shingle length and size partition."""

    def __init__(self, items: Iterable[tuple[int, str]], threshold: float = THRESHOLD, permutations: int = PERMUTATIONS) -> None:
        self.threshold = threshold
        rng = np.random.default_rng(5)
        self.factors = rng.integers(0, 1 << 64, permutations, np.uint64) | np.uint64(1)
        self.masks = rng.integers(0, 1 << 64, permutations, np.uint64)
        self.items: list[tuple[int, int, set[tuple[str, ...]]]] = []
        parts: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for item_id, text in sorted({(i, t) for i, t in items if t}):
            words = _word_list(text)
            k = min(WORDS, len(words))
            if not k:
                continue
            hashes = np.unique(tk.shingles(*tk.words([text]), k)[0])
            shingles = _shingle_set(words, k)
            parts.setdefault((k, len(shingles).bit_length() - 1), []).append((len(self.items), hashes))
            self.items.append((item_id, k, shingles))
        self.parts = []
        for (k, size), members in sorted(parts.items()):
            owners = np.array([m for m, _ in members])
            minima = np.array([[self._permuted(h, p).min() for _, h in members] for p in range(permutations)])
            order = np.argsort(minima, axis=1, kind="stable")
            self.parts.append((k, 1 << size, owners[order], np.take_along_axis(minima, order, 1)))

    def _permuted(self, hashes: np.ndarray, p: int) -> np.ndarray:
        return (hashes ^ self.masks[p]) * self.factors[p]

    def candidates(self, texts: Sequence[str]) -> set[tuple[int, int]]:
        """(text, item) for which the minima of a window of the text and of the item agree."""
        words, offsets = tk.words(texts)
        found: set[tuple[int, int]] = set()
        for k in sorted({part[0] for part in self.parts}):
            hashes, first = tk.shingles(words, offsets, k)
            if not len(hashes):
                continue
            grids = []
            for part in self.parts:
                if part[0] == k:
                    count = -(-np.diff(first) // part[1])
                    text = np.repeat(np.arange(len(texts)), count)
                    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
                    # a window is a step with the next two of the same text
                    more = [np.flatnonzero(text[d:] == text[:-d]) for d in (1, 2)]
                    grids.append((part, text, first[text] + nth * part[1], more))
            for p in range(len(self.factors)):
                permuted = self._permuted(hashes, p)
                for (_, _, owners, minima), text, begins, more in grids:
                    steps = np.minimum.reduceat(permuted, begins)
                    least = steps.copy()
                    for d, at in zip((1, 2), more, strict=True):
                        least[at] = np.minimum(least[at], steps[at + d])
                    lo, hi = np.searchsorted(minima[p], least), np.searchsorted(minima[p], least, "right")
                    for w in np.flatnonzero(hi > lo):
                        found.update((int(text[w]), int(m)) for m in owners[p][lo[w] : hi[w]])
        return found

    def hits(self, texts: Sequence[str]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item id, distinct shingles of the item, how many of them the text has) at or over the threshold."""
        for part in tk.pieces(texts):
            own = texts[part]
            by_text: dict[int, list[int]] = {}
            for text, item in sorted(self.candidates(own)):
                by_text.setdefault(text, []).append(item)
            for text, items in by_text.items():
                words = _word_list(own[text])
                sets = {k: _shingle_set(words, k) for k in {self.items[m][1] for m in items}}
                for m in items:
                    item_id, k, shingles = self.items[m]
                    shared = len(shingles & sets[k])
                    if shared >= self.threshold * len(shingles) - 1e-9:
                        yield part.start + text, item_id, len(shingles), shared


def _indexes(benchmark: DataFrame, block: int) -> Iterator[ItemIndex]:
    rows = ((r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").where("text is not null and item_id is not null").toLocalIterator())
    for chunk in batched(rows, block):
        yield ItemIndex(chunk)


def _hits(source: DataFrame, index: ItemIndex) -> DataFrame:
    """Hits in rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = list(index.hits(tk.text_list(b.column(1))))
            text, item, size, shared = np.array(hits, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text)), pa.array(item), pa.array(size.astype(np.int32)), pa.array(shared.astype(np.int32)), pa.array(shared / np.maximum(size, 1))], ["doc_id", "item_id", "item_shingles", "shared", "containment"])

    return source.mapInArrow(run, SCHEMA)


def find_contaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, containment) of every document row and item it contains."""
    ship(docs.sparkSession)
    source = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    ws, out, last = Workspace(docs.sparkSession, "decontam"), None, None
    for index in _indexes(benchmark, block):
        if last is not None:
            found = ws.save(_hits(source, last), "hits")
            out = found if out is None else out.unionByName(found)
        last = index
    found = docs.sparkSession.createDataFrame([], SCHEMA) if last is None else _hits(source, last)
    return found if out is None else out.unionByName(found)


def _clean(docs: DataFrame, index: ItemIndex) -> DataFrame:
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[hit[0] for hit in index.hits(tk.text_list(b.column(at)))]] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of docs that contain no item, with all their columns. With one block of items the texts are read once; with more, the texts with hits are found first, by their hashes."""
    ship(docs.sparkSession)
    ws, gone, last = Workspace(docs.sparkSession, "decontam"), None, None
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    for index in _indexes(benchmark, block):
        if last is not None:
            found = ws.save(_hits(texts, last).select("doc_id").distinct(), "gone")
            gone = found if gone is None else gone.unionByName(found)
        last = index
    if last is None:
        return docs
    if gone is None:
        return _clean(docs, last)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("__hash"))
    gone = gone.unionByName(ws.save(_hits(texts, last).select("doc_id").distinct(), "gone")).distinct()
    return marked.join(sent(gone.withColumnRenamed("doc_id", "__hash")), "__hash", "left_anti").select(*[F.col("doc")[c].alias(c) for c in docs.columns])
