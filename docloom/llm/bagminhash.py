"""Near-duplicates by BagMinHash: weighted-Jaccard signatures of shingle counts, banded, and verified on the multisets.

A document is the multiset of its shingles of five words. For every shingle and every whole step of weight there is a Poisson
process of points (time, register); a document holds the processes up to its counts, and each register keeps the
earliest point. Two documents agree in a register with a probability equal to their weighted Jaccard similarity. The steps of weight
form dyadic intervals [0,1), [1,2), [2,4), [4,8) and so on, each with one process for the whole interval. Only
while its points can still enter a register is an interval split into halves: one half inherits the point, the other
draws a later one. So a weight of w costs about log w and not w steps (after Ertl, BagMinHash, 2018).

Documents with equal words are one class. Classes that share a band are compared until no further link can change a group
(see linking), by the exact share min/max of the shingle counts; similarity of at least 0.8 is a link, connected classes are a group, and the
smallest doc_id stands for it. In a round a document is compared with one other at most, and what is left apart in a bucket with all of the bucket.

Defined results: null, empty and wordless texts have no words and so are equal to each other; texts of 1 to 4 words
are one shingle; repeated rows with the same doc_id count as copies, and rows with one doc_id and different texts as different documents; ties go to the smallest doc_id, then to the smallest hash of the row; rows without a doc_id are left out of groups (each is its own and kept); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .linking import link_buckets, ordered
from .workspace import Workspace, sent, ship

WORDS, THRESHOLD = 5, 0.8
#: A pair of similarity 0.8 shares no band with a probability of (1 - 0.8 ** 5) ** 25, one in twenty thousand.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Characters of the texts that a task compares with a hub, or, on either side, of those left in large buckets; a longer text stands alone.
CHUNK = 1_000_000
#: Members of a bucket whose pairs are listed when components are left; larger ones are compared in blocks.
SMALL = 8
#: Classes of more than this share of the rows are joined without a shuffle.
HEAVY = 1000
U = np.uint64


def _wait(state: np.ndarray) -> np.ndarray:
    """Exponential waiting times from the upper halves of random states."""
    return -np.log(((state >> U(32)).astype(np.float64) + 1.0) * 2.0**-32)


def _state(element: np.ndarray, lo: np.ndarray, width: np.ndarray) -> np.ndarray:
    return tk.mix(element ^ tk.mix((lo.astype(U) << U(24)) ^ width.astype(U)))


def signatures(elements: np.ndarray, owners: np.ndarray, weights: np.ndarray, count: int, registers: int = REGISTERS) -> np.ndarray:
    """Times of the earliest points by document and register, given distinct elements (64-bit hashes) with their documents and whole weights.

    Documents without elements keep infinity. A process is its next point: a random state, whose lower half is the register, and a time.
    """
    times = np.full(count * registers, np.inf)

    def show(owner: np.ndarray, state: np.ndarray, x: np.ndarray) -> None:
        slot = owner * registers + (((state & U(0xFFFFFFFF)) * U(registers)) >> U(32)).astype(np.int64)
        np.minimum.at(times, slot, x)

    # intervals [0, 1) of all elements
    s = _state(elements, np.zeros(1, np.int64), np.ones(1, np.int64))
    d, x = owners, _wait(s)
    show(d, s, x)
    # intervals [2 ** (j - 1), 2 ** j) that begin below the weight
    heavy = np.flatnonzero(weights > 1)
    levels = np.ceil(np.log2(weights[heavy])).astype(np.int64)
    of = np.repeat(heavy, levels)
    lo = np.int64(1) << (np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels))
    width, e, owner, w = lo.copy(), elements[of], owners[of], weights[of]
    state = _state(e, lo, width)
    at = _wait(state) / width
    whole = lo + width <= w
    show(owner[whole], state[whole], at[whole])
    while len(d) or len(e):
        limit = times.reshape(count, registers).max(1)
        if len(e):
            live = at <= limit[owner]
            e, owner, w, lo, width, state, at, whole = (a[live] for a in (e, owner, w, lo, width, state, at, whole))
            leaf = width == 1
            d, s, x = np.concatenate([d, owner[leaf]]), np.concatenate([s, state[leaf]]), np.concatenate([x, at[leaf]])
            e, owner, w, lo, width, state, at, whole = (a[~leaf] for a in (e, owner, w, lo, width, state, at, whole))
            # the point falls into either half, the other half draws a later one
            half = width >> 1
            right = ((_state(e, lo, width) >> U(7)) & U(1)).astype(np.int64)
            heir, other = lo + right * half, lo + (1 - right) * half
            drawn = _state(e, other, half)
            later = at + _wait(drawn) / half
            seen = np.concatenate([whole, np.zeros(len(whole), bool)])
            e, owner, w, width = np.tile(e, 2), np.tile(owner, 2), np.tile(w, 2), np.tile(half, 2)
            lo, state, at = np.concatenate([heir, other]), np.concatenate([state, drawn]), np.concatenate([at, later])
            inside = lo < w
            e, owner, w, lo, width, state, at, seen = (a[inside] for a in (e, owner, w, lo, width, state, at, seen))
            whole = lo + width <= w
            new = whole & ~seen
            show(owner[new], state[new], at[new])
        live = x <= limit[d]
        d, s, x = d[live], s[live], x[live]
        s = tk.mix(s + U(0x9E3779B97F4A7C15))
        x = x + _wait(s)
        show(d, s, x)
    return times.reshape(count, registers)


def _counted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, owner) in order, and counts. The owner, below 2 ** 13, takes the place of the lowest bits of the hash."""
    keys = np.sort((hashes & ~U(8191)) | owner.astype(U))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    keys = keys[at]
    return keys & ~U(8191), (keys & U(8191)).astype(np.int64), np.diff(np.append(at, len(hashes)))


def shingle_counts(texts: Sequence[str], k: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of at most 8192 texts: hashes, texts, counts; then the words' hashes and their offsets."""
    words, offsets = tk.words(texts)
    hashes, first = tk.shingles(words, offsets, k)
    return *_counted(hashes, np.repeat(np.arange(len(texts)), np.diff(first))), words, offsets


def _class_keys(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each text's whole sequence of words."""
    place = np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = []
    for salt in (0x8CB92BA72F3D8DD7, 0xD1B54A32D192ED03):
        terms = tk.mix(words ^ tk.mix(place.astype(U) * U(salt)))
        sums = np.zeros(len(terms) + 1, U)
        np.cumsum(terms, out=sums[1:])
        out.append(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(U) * U(salt))
    return out[0], out[1]


def bands_of(times: np.ndarray) -> np.ndarray:
    grouped = tk.mix(times.view(U)).reshape(len(times), BANDS, ROWS)
    factors = tk.mix(np.arange(1, ROWS + 1, dtype=U)) | U(1)
    return tk.mix((grouped * factors).sum(2, dtype=U) ^ tk.mix(np.arange(BANDS, dtype=U)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = tk.text_list(b.column(2))
        for part in tk.pieces(texts, 300_000):
            hashes, owner, counts, words, offsets = shingle_counts(texts[part])
            n = part.stop - part.start
            bands = bands_of(signatures(hashes, owner, counts, n))
            one, two = _class_keys(words, offsets)
            size = np.diff(offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(bands.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(part.start, n), b.column(1).slice(part.start, n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(size), lists], ["doc_id", "row", "k1", "k2", "n_words", "bands"])


def similarity(a: str, b: str) -> float:
    """Weighted Jaccard similarity of the shingle counts; 1 for two texts without words."""
    return float(similarities([a], [b])[0])


def similarities(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Of at most 4096 pairs."""
    n = len(left)
    both = [t for pair in zip(left, right, strict=True) for t in pair]
    hashes, owner, counts, _, _ = shingle_counts(both)
    pair = owner >> 1
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (pair[1:] == pair[:-1]))
    low = np.bincount(pair[same], np.minimum(counts[same], counts[same + 1]), n)
    total = np.bincount(pair, counts, n)
    return np.where(total == 0, 1.0, low / np.maximum(total - low, 1))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (hub, chunk, other, text) in order, the links (a, b): a chunk's first row, without another id, has the hub's text."""
    hub, text = None, ""
    for batch in batches:
        ids, others, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist(), tk.text_list(batch.column(3))
        pairs, left, right = [], [], []
        for i, other, own in zip(ids, others, texts, strict=True):
            if other is None:
                hub, text = i, own
            elif i == hub:
                pairs.append((min(i, other), max(i, other)))
                left.append(text)
                right.append(own)
        keep = np.zeros(len(pairs), bool)
        for part in tk.pieces([x + y for x, y in zip(left, right, strict=True)], 500_000):
            keep[part] = similarities(left[part], right[part]) >= THRESHOLD - 1e-12
        linked = np.array(pairs, np.int64).reshape(-1, 2)[keep]
        yield pa.RecordBatch.from_arrays([pa.array(linked[:, 0]), pa.array(linked[:, 1])], ["a", "b"])


def _links(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The links among candidates (a, b, hub). A hub's candidates are dealt into chunks of bounded size, each with one copy of its text."""
    own = pairs.select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("node"))
    sized = own.join(texts.select("node", "chars"), "node")
    plan = sized.groupBy("hub").agg(F.ceil(F.sum("chars") / CHUNK).cast("int").alias("chunks"))
    dealt = own.join(plan, "hub").select("hub", F.pmod(F.xxhash64("node"), F.greatest("chunks", F.lit(1))).alias("chunk"), "node")
    members = dealt.join(texts, "node").select("hub", "chunk", F.col("node").alias("other"), "text")
    hubs = dealt.select("hub", "chunk").distinct().join(texts.withColumnRenamed("node", "hub"), "hub").select("hub", "chunk", F.lit(None).cast("bigint").alias("other"), "text")
    rows = members.unionByName(hubs).repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", F.col("other").asc_nulls_first())
    return rows.mapInArrow(_verify, "a bigint, b bigint")


def _compare(left_texts: Sequence[str], right_texts: Sequence[str], left_comp: np.ndarray, right_comp: np.ndarray) -> set[tuple[int, int]]:
    """Pairs of different components that a text of the left and one of the right link, by the exact similarity."""

    def gathered(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [(h, o + part.start, c) for part in tk.pieces(texts, 300_000) for h, o, c, _, _ in [shingle_counts(texts[part])]]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    lh, lo, lc = gathered(left_texts)
    rh, ro, rc = gathered(right_texts)
    order = np.argsort(rh, kind="stable")
    rh, ro, rc = rh[order], ro[order], rc[order]
    totals = np.bincount(ro, rc, len(right_texts))
    order = np.argsort(lo, kind="stable")
    lh, lc, cuts = lh[order], lc[order], np.searchsorted(lo[order], np.arange(len(left_texts) + 1))
    links: set[tuple[int, int]] = set()
    for i in range(len(left_texts)):
        h, c = lh[cuts[i] : cuts[i + 1]], lc[cuts[i] : cuts[i + 1]]
        begin, n = np.searchsorted(rh, h), np.searchsorted(rh, h, "right")
        n = n - begin
        at = np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)
        shared = np.bincount(ro[at], np.minimum(np.repeat(c, n), rc[at]), len(right_texts))
        linked = (shared >= (THRESHOLD - 1e-12) * (c.sum() + totals - shared)) & (shared > 0) & (right_comp != left_comp[i])
        links.update((int(left_comp[i]), int(x)) for x in np.unique(right_comp[linked]))
    return links


def _exhaust(ws: Workspace, texts: DataFrame, rest: DataFrame) -> DataFrame:
    """Links between components, from all members (key, id, comp) of the buckets that hold several.

    Pairs in small buckets are compared once, in however many buckets they stand. In a large one all members outside its largest component are compared with
    the whole bucket, in blocks of bounded size: n characters of which u are outside give about u / CHUNK * n / CHUNK tasks, and no row for each pair.
    """
    held = ws.save(rest.join(texts.select(F.col("node").alias("id"), "chars"), "id"), "rest")
    sizes = held.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    main = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.max(F.struct("n", "comp", "chars")).alias("top"))
    plan = main.select("key", "n", F.col("top.comp").alias("main"), F.ceil(F.col("chars") / CHUNK).cast("int").alias("blocks"), F.ceil((F.col("chars") - F.col("top.chars")) / CHUNK).cast("int").alias("outer"))
    held = ws.save(held.join(plan, "key"), "planned")
    few = held.where(F.col("n") <= SMALL).select("key", "id", "comp")
    other = few.toDF("key2", "id2", "comp2")
    pairs = ws.save(ordered(few.join(other, (F.col("key") == F.col("key2")) & (F.col("comp") < F.col("comp2")))), "pairs")
    near = _links(texts, pairs).join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    many = held.where(F.col("n") > SMALL).join(texts.select(F.col("node").alias("id"), "text"), "id").withColumn("deal", F.xxhash64("id"))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1))
    part = lambda n: F.pmod("deal", F.greatest(F.col(n), F.lit(1))).cast("int")
    left = many.where("comp != main").select("key", part("outer").alias("x"), span("blocks").alias("y"), "comp", "text")
    right = many.select("key", span("outer").alias("x"), part("blocks").alias("y"), "comp", "text")
    right = right.toDF(*right.columns)

    def run(one, two):
        import pandas as pd

        links = _compare(one["text"].tolist(), two["text"].tolist(), one["comp"].to_numpy(), two["comp"].to_numpy()) if len(one) and len(two) else ()
        return pd.DataFrame(sorted(links), columns=["a", "b"], dtype="int64")

    keys = ("key", "x", "y")
    return near.unionByName(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "a bigint, b bigint"))


def _row() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text").alias("row")


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, row, class_id, group_id, group_size, stands) of all rows with a doc_id: row is a hash of id and text, and stands is true of those rows that stand for their group."""
    spark = docs.sparkSession
    ship(spark)
    ws = Workspace(spark, "bagminhash")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _row(), "text").where("doc_id is not null")
    signed = ws.save(source.mapInArrow(_sign, "doc_id bigint, row bigint, k1 bigint, k2 bigint, n_words bigint, bands array<bigint>"), "signed")
    classes = signed.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "row")).alias("head"), F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"))
    classes = ws.save(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    heads = classes.where("n_words > 0").select("k1", "k2", "head.doc_id", "head.row", "node")
    banded = signed.join(heads, ["k1", "k2", "doc_id", "row"]).select(F.explode("bands").alias("key"), F.col("node").alias("id")).distinct()
    busy = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = ws.save(banded.join(busy, "key", "left_semi"), "members")
    wanted = heads.join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi").select("node", "doc_id", "row")
    texts = ws.save(source.join(sent(wanted), ["doc_id", "row"]).select("node", "text", F.length("text").cast("bigint").alias("chars")).dropDuplicates(["node"]), "texts")  # repeated rows have one text
    labels = link_buckets(ws, members, lambda pairs: _links(texts, pairs), exhaust=lambda rest: _exhaust(ws, texts, rest))
    ws.drop(members, texts)
    joined = ws.save(classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select("k1", "k2", "head", "n", F.coalesce("label", "node").alias("label")), "joined")
    groups = joined.groupBy("label").agg(F.min("head").alias("first"), F.sum("n").alias("group_size"))
    known = ws.save(joined.join(groups, "label").select("k1", "k2", F.col("head.doc_id").alias("class_id"), "first", "group_size", "n"), "known")
    ws.drop(joined)
    # a class of a large share of all rows is one key; there are fewer than HEAVY of them, and they go to all executors
    large = F.lit(signed.count() / HEAVY)
    rows = signed.select("doc_id", "row", "k1", "k2")
    heavy = F.broadcast(known.where(F.col("n") > large))
    found = rows.join(heavy, ["k1", "k2"]).unionByName(rows.join(heavy, ["k1", "k2"], "left_anti").join(known.where(F.col("n") <= large), ["k1", "k2"]))
    return found.select("doc_id", "row", "class_id", F.col("first.doc_id").alias("group_id"), "group_size", ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))).alias("stands"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, group_id, group_size, kept): class_id is the smallest doc_id with the same words, kept is whether the row or an equal one stands for the group."""
    return _grouped(docs).select("doc_id", "class_id", "group_id", "group_size", F.col("stands").alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that stand for their group, with all their columns; of repeated rows, which have one id and text, one stays. Rows without a doc_id all stay."""
    ws = Workspace(docs.sparkSession, "kept")
    kept = ws.save(_grouped(docs).where("stands").groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).select(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), "n"), "kept")
    once, often = sent(kept.where("n = 1").drop("n")), sent(kept.where("n > 1").drop("n"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("bigint").alias("__doc"), _row().alias("__row"))
    single = marked.join(once, ["__doc", "__row"], "left_semi")
    one_of = marked.join(often, ["__doc", "__row"], "left_semi").dropDuplicates(["__doc", "__row"])
    return single.unionByName(one_of).unionByName(marked.where("__doc is null")).select(*[F.col("doc")[c].alias(c) for c in docs.columns])
