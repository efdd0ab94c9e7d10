"""Masked pseudo-likelihood: every word is predicted from the words on both sides, and the log-probabilities are added up.

Words are counted over the whole corpus, and each of the ``VOCABULARY`` most frequent has a probability of its own, in three factors. A window network
(vectors of the two words before and after, a tanh layer) predicts the word's class by one softmax and, by a second that also sees the class,
the word's cell in it; the word's share of its cell's count completes the probability. The most frequent words are classes of their own, further
ones share classes and, in these, cells of about equal mass: a word that is frequent enough has a cell of its own. Words beyond the vocabulary are the rarest, most of them of equal counts, and share
their class evenly. So the probabilities of all words of the corpus add up to one. On the input side the most frequent words have
vectors of their own, and the others share some by hash.

The network is trained in numpy: first on a bounded sample of documents, whose result all shards start from, then on all
documents, dealt by a hash of id and text into shards of about ``SHARD_WORDS`` words and read in the order of that hash; the results are averaged, weighted by their words. Neither
shards nor batches depend on how the table is split, so that the scores don't (but for the order in which averages are added up). Only weights and the bounded vocabulary reach the driver.

Defined results: null, empty and wordless texts have no words, a log-likelihood of 0 and no mean; repeated rows get equal scores; very long texts are
scored as a whole; words of equal counts are ranked by hash; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .workspace import Workspace, hash_sample, ship

VOCABULARY, OWN, CLASSES, CELLS = 1 << 20, 31, 64, 64
#: Input vectors, and those of them that belong to one frequent word each.
INPUTS, OWN_INPUTS = 256, 128
SIDE, HIDDEN = 2, 24
#: Documents, those with the smallest hash of their id, on which the common start is trained.
START_DOCUMENTS, START_EPOCHS = 300, 4
SHARD_WORDS, CHUNK_WORDS, BATCH = 4_000_000, 65_536, 4096
PLACES = tuple(p for p in range(-SIDE, SIDE + 1) if p)
U = np.uint64


def _equal_mass(counts: np.ndarray, bins: int) -> np.ndarray:
    """Bins of about equal mass for counts in falling order."""
    mass = (np.cumsum(counts, dtype=float) - counts / 2) / counts.sum()
    return np.minimum((mass * bins).astype(np.int64), bins - 1)


@dataclass
class Lexicon:
    """Of words by hash: class, cell, input vector and the log of the share of the cell; the last entry stands for all other words."""

    hashes: np.ndarray  # in order
    starts: np.ndarray  # by the upper bits of a hash, where hashes of these bits begin
    classes: np.ndarray
    cells: np.ndarray
    shares: np.ndarray
    inputs: np.ndarray  # -1 where the hash decides
    real_classes: np.ndarray  # classes and cells that have words
    real_cells: np.ndarray

    @classmethod
    def build(cls, hashes: np.ndarray, counts: np.ndarray, other_words: int) -> Lexicon:
        """From the most frequent words, in falling order of their counts, and the number of distinct other words."""
        n = len(hashes)
        classes, cells = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        classes[: min(OWN, n)] = np.arange(min(OWN, n))
        classes[n] = CLASSES - 1
        if n > OWN:
            classes[OWN:n] = OWN + _equal_mass(counts[OWN:], CLASSES - 1 - OWN)
            for c in np.unique(classes[OWN:n]):
                at = np.flatnonzero(classes[:n] == c)
                cells[at] = _equal_mass(counts[at], CELLS)
        cell = classes * CELLS + cells
        total = np.bincount(cell[:n], counts, CLASSES * CELLS)
        shares = np.append(np.log(counts / total[cell[:n]]) if n else [], -np.log(max(other_words, 1)))
        real = np.bincount(cell, minlength=CLASSES * CELLS).reshape(CLASSES, CELLS) > 0
        inputs = np.full(n + 1, -1)
        inputs[: min(n, OWN_INPUTS)] = np.arange(min(n, OWN_INPUTS))
        order = np.argsort(hashes)
        places = np.append(order, n)
        shift = U(64 - cls.bits(n))
        starts = np.searchsorted(hashes[order] >> shift, np.arange((1 << cls.bits(n)) + 1, dtype=U))
        return cls(hashes[order], starts.astype(np.int32), classes[places].astype(np.uint8), cells[places].astype(np.uint8), shares[places].astype(np.float32), inputs[places].astype(np.int16), real.any(1), real)

    @staticmethod
    def bits(n: int) -> int:
        return max(4, int(n).bit_length())

    def find(self, words: np.ndarray) -> np.ndarray:
        """Entries of words."""
        n = len(self.hashes)
        out = np.full(len(words), n)
        upper = (words >> U(64 - self.bits(n))).astype(np.int64)
        at, end = self.starts[upper].astype(np.int64), self.starts[upper + 1]
        left = np.flatnonzero(at < end)
        while len(left):
            hit = self.hashes[at[left]] == words[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out

    def read(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries of all words, their input vectors, and by text the index of its first word."""
        words, offsets = tk.words(texts)
        at = self.find(words)
        own = self.inputs[at].astype(np.int64)
        return at, np.where(own >= 0, own, OWN_INPUTS + (words % U(INPUTS - OWN_INPUTS)).astype(np.int64)), offsets


def windows(inputs: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By word the input vectors around it; INPUTS stands for places outside the text."""
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    padded = np.full(len(inputs) + SIDE * (len(n) + 1), INPUTS)
    at = np.arange(len(inputs)) + SIDE * (doc + 1)
    padded[at] = inputs
    return np.stack([padded[at + p] for p in PLACES], 1) if len(inputs) else np.zeros((0, len(PLACES)), np.int64)


class Network:
    """Parameters lie in one array, so that they can be averaged. The lexicon says which classes and cells there are."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray | None = None, seed: int = 3) -> None:
        shapes = [(len(PLACES), INPUTS + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (HIDDEN, CELLS), (CLASSES, CELLS)]
        sizes = [int(np.prod(s)) for s in shapes]
        if weights is None:
            weights = np.random.default_rng(seed).normal(0, 0.1, sum(sizes)).astype(np.float32)
        self.weights = weights.astype(np.float32).copy()
        self.cuts = np.cumsum([0, *sizes])
        self.places, self.shift, self.out, self.bias, self.out2, self.bias2 = self._parts(self.weights, shapes)
        self._shapes = shapes
        self._absent = np.where(lexicon.real_classes, 0, -1e9).astype(np.float32)
        self._absent2 = np.where(lexicon.real_cells, 0, -1e9).astype(np.float32)
        self._split = lexicon.real_cells.sum(1) > 1  # classes of several cells
        self._m, self._v, self._t = np.zeros_like(self.weights), np.zeros_like(self.weights), 0

    def _parts(self, array: np.ndarray, shapes) -> list[np.ndarray]:
        return [array[a:b].reshape(s) for a, b, s in zip(self.cuts, self.cuts[1:], shapes)]

    def _hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.places[0][around[:, 0]] + self.shift
        for j in range(1, len(PLACES)):
            total += self.places[j][around[:, j]]
        return np.tanh(total, out=total)

    def _class_logits(self, h: np.ndarray) -> np.ndarray:
        return h @ self.out + (self.bias + self._absent)

    def _cell_logits(self, h: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return h @ self.out2 + (self.bias2 + self._absent2)[classes]

    def log_probabilities(self, around: np.ndarray, classes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Of the words' cells."""
        out = np.empty(len(classes))
        for a in range(0, len(classes), BATCH):
            c = classes[a : a + BATCH]
            h = self._hidden(around[a : a + BATCH])
            own = _log_softmax(self._class_logits(h), c)
            some = np.flatnonzero(self._split[c])
            own[some] += _log_softmax(self._cell_logits(h[some], c[some]), cells[a : a + BATCH][some])
            out[a : a + BATCH] = own
        return out

    def gradient(self, around: np.ndarray, classes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Of the mean negative log-probability."""
        n, rows = len(classes), np.arange(len(classes))
        h = self._hidden(around)
        z = _softmax(self._class_logits(h))
        z[rows, classes] -= 1
        some = np.flatnonzero(self._split[classes])
        z2 = _softmax(self._cell_logits(h[some], classes[some]))
        z2[np.arange(len(some)), cells[some]] -= 1
        back = z @ self.out.T
        back[some] += z2 @ self.out2.T
        back *= 1 - h * h
        grads = np.zeros_like(self.weights)
        places, shift, out, bias, out2, bias2 = self._parts(grads, self._shapes)
        for j in range(len(PLACES)):
            for k in range(HIDDEN):
                places[j, :, k] = np.bincount(around[:, j], back[:, k], INPUTS + 1)
        shift[:] = back.sum(0)
        out[:] = h.T @ z
        bias[:] = z.sum(0)
        out2[:] = h[some].T @ z2
        order = np.argsort(classes[some], kind="stable")
        own, first = np.unique(classes[some][order], return_index=True)
        if len(own):
            bias2[own] = np.add.reduceat(z2[order], first, axis=0)
        return grads / n

    def step(self, around: np.ndarray, classes: np.ndarray, cells: np.ndarray, rate: float) -> None:
        """One step of Adam on a batch."""
        grads = self.gradient(around, classes, cells)
        self._t += 1
        self._m += 0.1 * (grads - self._m)
        self._v += 0.001 * (grads * grads - self._v)
        self.weights -= rate * (self._m / (1 - 0.9**self._t)) / (np.sqrt(self._v / (1 - 0.999**self._t)) + 1e-8)

    def learn(self, around: np.ndarray, classes: np.ndarray, cells: np.ndarray, rate: float, rng: np.random.Generator, batch: int = BATCH) -> None:
        order = rng.permutation(len(classes))
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            self.step(around[own], classes[own], cells[own], rate)


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _log_softmax(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    own = z[np.arange(len(z)), target].astype(float)
    return own - np.log(np.exp(z, out=z).sum(1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = tk.text_list(b.column(0))
        for part in tk.pieces(texts):
            found, counts = np.unique(tk.words(texts[part])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["word", "n"])


def _train_shards(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of rows (shard, text) in order: the sum over the shards of weights times words, and the number of words."""
    total, words = np.zeros(len(weights)), 0
    shard = network = rng = None
    texts: list[str] = []
    size = seen = 0

    def learn() -> None:
        nonlocal texts, size, seen
        entries, inputs, offsets = lexicon.read(texts)
        network.learn(windows(inputs, offsets), lexicon.classes[entries].astype(np.int64), lexicon.cells[entries].astype(np.int64), 0.003, rng)
        seen += len(entries)
        texts, size = [], 0

    def close() -> None:
        nonlocal total, words
        if texts:
            learn()
        total, words = total + network.weights.astype(float) * seen, words + seen

    for b in batches:
        for own, text in zip(b.column(0).to_pylist(), tk.text_list(b.column(1)), strict=True):
            if own != shard or network is None:
                if network is not None:
                    close()
                shard, network, rng, seen = own, Network(lexicon, weights), np.random.default_rng(1), 0
            texts.append(text)
            size += len(text)
            if size >= 5 * CHUNK_WORDS:  # by characters, so that a chunk ends at the same text wherever it is read
                learn()
    if network is not None:
        close()
    if words:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), float(words)))], ["k", "value", "seen"])


def fit(docs: DataFrame) -> tuple[Lexicon, Network]:
    """Lexicon and network of a corpus of (doc_id, text), from all its documents."""
    spark = docs.sparkSession
    ship(spark)
    ws = Workspace(spark, "lm")
    counts = ws.save(docs.select("text").mapInArrow(_count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    # powers of two bound how many words can be among the most frequent, before any are sorted
    powers = sorted(counts.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect(), reverse=True)
    distinct, total = sum(r["words"] for r in powers), sum(r["n"] for r in powers)
    least = next((r["k"] for i, r in enumerate(powers) if sum(x["words"] for x in powers[: i + 1]) >= VOCABULARY), 0)
    top = counts.where(F.col("n") >= F.lit(1 << least)).orderBy(F.desc("n"), "word").limit(VOCABULARY).toArrow()
    hashes, own = (top.column(c).to_numpy() for c in ("word", "n"))
    ws.drop(counts)
    lexicon = Lexicon.build(hashes.view(U), own, max(distinct - len(own), 0))
    start = Network(lexicon)
    sample = sorted(hash_sample(docs.select("doc_id", "text"), "doc_id", START_DOCUMENTS).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"] or ""))
    rng = np.random.default_rng(9)
    entries, inputs, offsets = lexicon.read([r["text"] or "" for r in sample])
    if len(entries):
        classes, cells = lexicon.classes[entries].astype(np.int64), lexicon.cells[entries].astype(np.int64)
        start.bias[:] = np.log(np.bincount(classes, minlength=CLASSES) + 1.0) - np.log(len(classes) + CLASSES)
        around = windows(inputs, offsets)
        for epoch in range(START_EPOCHS):
            start.learn(around, classes, cells, 0.02 / (1 + epoch), rng, 1024)
    weights = start.weights
    deal = F.xxhash64(F.col("doc_id").cast("string"), "text")
    dealt = docs.select(F.pmod(deal, F.lit(max(1, -(-total // SHARD_WORDS)))).alias("shard"), deal.alias("place"), "text")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "place", "text").select("shard", "text")
    trained = dealt.mapInArrow(lambda batches: _train_shards(batches, lexicon, weights), "k bigint, value double, seen double")
    parts = trained.groupBy("k").agg((F.sum("value") / F.sum("seen")).alias("mean")).orderBy("k").toArrow()
    return lexicon, Network(lexicon, parts.column("mean").to_numpy()) if len(parts) else start


def score(docs: DataFrame, lexicon: Lexicon, network: Network) -> DataFrame:
    """(doc_id, n_words, log_likelihood, per_word) of every row, whole texts."""
    ship(docs.sparkSession)
    weights = network.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(lexicon, weights)
        for b in batches:
            texts = tk.text_list(b.column(1))
            n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for part in tk.pieces(texts):
                entries, inputs, offsets = lexicon.read(texts[part])
                own = net.log_probabilities(windows(inputs, offsets), lexicon.classes[entries].astype(np.int64), lexicon.cells[entries].astype(np.int64))
                sums = np.append(0, np.cumsum(own + lexicon.shares[entries]))
                n[part] = np.diff(offsets)
                total[part] = sums[offsets[1:]] - sums[offsets[:-1]]
            total[n == 0] = 0.0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1), mask=n == 0)], ["doc_id", "n_words", "log_likelihood", "per_word"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id bigint, n_words bigint, log_likelihood double, per_word double")
