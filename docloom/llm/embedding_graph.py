"""Near-duplicate vectors through a flat graph with robust pruning.

Equal vectors are one node. Nodes are dealt to overlapping shards, those of their nearest centroids (spherical k-means on a bounded sample); a shard too
large for one task is dealt into pieces by hash. In every shard each node gets edges to a robustly pruned choice of its nearest
nodes and of some distant ones, and edges back. A node's lists from all its shards are united. Every node is then
a query in the shards of its nearest centroids, in all their pieces: a greedy beam search starts from the medoids of the shard (and from the query's own node
where it is a member), and from all results over the threshold the search goes on as long as it finds more. Pairs are verified by cosine in double precision.
Recall is audited in every run: if too few of the true links of a bounded sample of nodes were found, twice as many shards are searched.
Connected nodes form a component.

Defined results: null vectors, those with null or non-finite components and zero vectors link with nothing and stand alone; vectors of different lengths never link; rows
without an id link with nothing, have no component and are kept; copies of a vector are linked with each other; an empty table gives no rows; labels and
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import connected_components
from .workspace import Workspace, hash_sample, ship

THRESHOLD = 0.9
#: Rows of a shard on average, and at most; rows that centroids are fitted on.
SHARD, LARGEST, SAMPLE = 2000, 3000, 20_000
OVERLAP, PROBES = 2, 5
#: Nodes whose links are also found by brute force, those with the smallest hashes, and the share of these that must be found.
AUDITED, RECALL = 1000, 0.9
DEGREE, POOL, ALPHA, BEAM, MEDOIDS = 24, 64, 1.2, 48, 8


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Spherical k-means; a centroid without members stays."""
    rng = np.random.default_rng(seed)
    centers = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(sample @ centers.T, 1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centers)
    return centers


def build_lists(vectors: np.ndarray, seed: int = 2) -> list[np.ndarray]:
    """Neighbour lists of a shard of unit vectors: pruned edges and edges back."""
    n = len(vectors)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    v = vectors.astype(np.float32)
    rng = np.random.default_rng(seed)
    width = min(POOL, n - 1)
    picked = np.empty((n, DEGREE), np.int64)
    for a in range(0, n, 256):
        block = v[a : a + 256] @ v.T
        block[np.arange(len(block)), np.arange(a, a + len(block))] = -np.inf
        near = np.argpartition(-block, width - 1, axis=1)[:, :width]
        far = rng.integers(0, n, (len(block), 8))
        pool = np.concatenate([near, far], 1)
        pool[pool == np.arange(a, a + len(block))[:, None]] = -1
        sims = np.where(pool >= 0, np.take_along_axis(block, np.maximum(pool, 0), 1), -np.inf)
        pool = np.take_along_axis(pool, np.argsort(-sims, axis=1, kind="stable"), 1)
        picked[a : a + 256] = robust_prune(v, np.arange(a, a + len(block)), pool)
    source, target = np.repeat(np.arange(n), DEGREE), picked.reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    closeness = np.einsum("nd,nd->n", v[source], v[target])
    order = np.lexsort((-closeness, target))
    back_of, back = target[order], source[order]
    # the nearest edges back stay; a further one hangs on the one DEGREE places before it, so that a node in the middle of a group leads to all of it
    place = np.arange(len(back)) - np.searchsorted(back_of, back_of)
    back_of = np.where(place < DEGREE, back_of, back[np.maximum(np.arange(len(back)) - DEGREE, 0)])
    edges = np.unique(np.concatenate([source * n + target, back_of * n + back]))
    edges = edges[edges // n != edges % n]
    return np.split(edges % n, np.searchsorted(edges // n, np.arange(1, n)))


def robust_prune(v: np.ndarray, nodes: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """For some nodes and their candidates (a row each, -1 for none): the choice of neighbours, padded with -1.

    The nearest candidate is taken, and those nearer to it by the factor ALPHA than to the node are dropped; and so on.
    """
    out = np.full((len(nodes), DEGREE), -1, np.int64)
    there = v[pool]
    to_node = np.where(pool >= 0, 1 - np.einsum("nd,ncd->nc", v[nodes], there), np.inf)
    alive, rows = pool >= 0, np.arange(len(nodes))
    for r in range(DEGREE):
        pick = np.argmin(np.where(alive, to_node, np.inf), 1)
        has = alive[rows, pick]
        if not has.any():
            break
        out[has, r] = pool[rows, pick][has]
        apart = 1 - np.einsum("nd,ncd->nc", there[rows, pick], there)
        alive &= (ALPHA * apart > to_node) & has[:, None]
        alive[rows, pick] = False
    return out


def medoids_of(v: np.ndarray) -> np.ndarray:
    centers = fit_centroids(v, MEDOIDS, 4)
    return np.unique(np.argmax(v @ centers.T, 0))


def search(v: np.ndarray, graph: np.ndarray, queries: np.ndarray, own: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(query, members with a similarity over the threshold) of unit vectors, members v with a padded graph of neighbour numbers.

    own has the query's number among the members, or -1.
    """
    n, starts = len(v), medoids_of(v)
    for a in range(0, len(queries), 256):
        q = queries[a : a + 256]
        rows = np.arange(len(q))
        entry = np.concatenate([np.tile(starts, (len(q), 1)), own[a : a + len(q), None]], 1)
        seen = np.zeros((len(q), n + 1), bool)  # the last column takes the padding
        sims = np.where(entry >= 0, np.einsum("qd,qkd->qk", q, v[entry]), -np.inf)
        for k in range(entry.shape[1]):  # a member that stands twice counts once
            sims[seen[rows, entry[:, k]], k] = -np.inf
            seen[rows, entry[:, k]] = True
        beam, score = entry, sims
        done = score == -np.inf
        found: list[tuple[np.ndarray, np.ndarray]] = []
        hit = score >= threshold
        found.append((np.nonzero(hit)[0], beam[hit]))
        while True:
            open_score = np.where(done, -np.inf, score)
            pick = np.argmax(open_score, 1)
            live = np.flatnonzero(open_score[rows, pick] > -np.inf)
            if not len(live):
                break
            done[live, pick[live]] = True
            near = graph[beam[live, pick[live]]]
            fresh = ~seen[live[:, None], near] & (near >= 0)
            seen[live[:, None], near] = True
            s = np.where(fresh, np.einsum("qd,qkd->qk", q[live], v[near]), -np.inf)
            hit = s >= threshold
            found.append((live[np.nonzero(hit)[0]], near[hit]))
            joined = np.full((len(q), near.shape[1]), -np.inf, score.dtype)
            joined[live] = s
            wide = np.full((len(q), near.shape[1]), -1, np.int64)
            wide[live] = near
            score, beam, done = np.concatenate([score, joined], 1), np.concatenate([beam, wide], 1), np.concatenate([done, joined == -np.inf], 1)
            if score.shape[1] > BEAM:
                top = np.argpartition(-score, BEAM - 1, axis=1)[:, :BEAM]
                score, beam, done = (np.take_along_axis(x, top, 1) for x in (score, beam, done))
        of, member = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.argsort(of, kind="stable")
        of, member = of[order], member[order]
        cuts = np.searchsorted(of, np.arange(len(q) + 1))
        for i in range(len(q)):
            results = member[cuts[i] : cuts[i + 1]]
            frontier = results
            tried = seen[i]
            while len(frontier):
                near = np.unique(graph[frontier])
                near = near[near >= 0]
                near = near[~tried[near]]
                tried[near] = True
                frontier = near[v[near] @ q[i] >= threshold]
                results = np.concatenate([results, frontier])
            if len(results):
                yield a + i, results


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ok = i is not None and x is not None and len(x) > 0 and None not in x
            if ok:
                own = np.array(x, float)
                ok = bool(np.isfinite(own).all() and np.isfinite(norm := np.linalg.norm(own)) and norm > 0)
            keep.append(ok)
        yield b.filter(pa.array(keep, pa.bool_()))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(x, float) for x in column]) if len(column) else np.zeros((0, 1))


def _links(ws: Workspace, nodes: DataFrame, threshold: float) -> tuple[DataFrame, float]:
    """(a, b), a < b, of the linked nodes among (node, vector) of one length, and the audited recall; more shards are searched while it is less than RECALL."""
    total = nodes.count()
    sample = hash_sample(nodes, "node", SAMPLE).select("vector").toArrow().column(0)
    fitted = unit(np.array(sample.combine_chunks().flatten(), float).reshape(len(sample), -1))
    centers = fit_centroids(fitted, max(1, min(-(-total // SHARD), len(fitted) // 4)))
    probes = min(PROBES, len(centers))
    while True:
        pairs = _search_shards(ws, nodes, centers, probes, threshold)
        recall = _audit(nodes, pairs, threshold)
        if recall >= RECALL or probes == len(centers):
            return pairs, recall
        ws.drop(pairs)
        probes = min(2 * probes, len(centers))


def _audit(nodes: DataFrame, pairs: DataFrame, threshold: float) -> float:
    """The share of the true links of at most AUDITED nodes, found by brute force over all nodes, that the pairs hold. All pairs are verified, so that they hold no others."""
    rows = hash_sample(nodes, "node", AUDITED).collect()
    asked, wanted = np.array([r["node"] for r in rows], np.int64), unit(_matrix([r["vector"] for r in rows]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked), np.int64)
        for b in batches:
            ids = b.column(0).to_numpy()
            for a in range(0, len(ids), 1000):
                near = unit(_matrix(b.column(1).slice(a, 1000).to_pylist())) @ wanted.T >= threshold
                total += (near & (ids[a : a + 1000, None] != asked[None, :])).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([int(total.sum())])], ["n"])

    true = nodes.mapInArrow(count, "n bigint").agg(F.sum("n")).first()[0] or 0
    chosen = F.broadcast(nodes.sparkSession.createDataFrame([(int(x),) for x in asked], "node bigint"))
    found = sum(pairs.join(chosen, F.col(c) == F.col("node"), "left_semi").count() for c in ("a", "b"))
    return min(found / true, 1.0) if true else 1.0


def _search_shards(ws: Workspace, nodes: DataFrame, centers: np.ndarray, probes: int, threshold: float) -> DataFrame:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sims = unit(_matrix(b.column(1).to_pylist())) @ centers.T if b.num_rows else np.zeros((0, len(centers)))
            near = np.argsort(-sims, axis=1, kind="stable")[:, :probes]
            for rank in range(near.shape[1]):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near[:, rank].astype(np.int32)), pa.array(np.full(b.num_rows, rank, np.int32))], ["node", "vector", "shard", "rank"])

    dealt = ws.save(nodes.mapInArrow(deal, "node bigint, vector array<double>, shard int, rank int"), "dealt")
    sizes = dealt.groupBy("shard").agg(F.count(F.when(F.col("rank") < OVERLAP, 1)).alias("members"), F.count(F.lit(1)).alias("queries"))
    plan = F.broadcast(sizes.select("shard", F.ceil(F.col("members") / LARGEST).cast("int").alias("pieces"), F.ceil(F.col("queries") / (2 * LARGEST)).cast("int").alias("blocks")))  # as many rows as centroids
    members = dealt.where(F.col("rank") < OVERLAP).join(plan, "shard").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))

    def build(key, frame):
        import pandas as pd

        ids = frame["node"].to_numpy()
        lists = build_lists(unit(_matrix(frame["vector"])))
        return pd.DataFrame({"node": ids, "near": [ids[x] for x in lists]})

    lists = members.select("shard", "piece", "node", "vector").groupBy("shard", "piece").applyInPandas(build, "node bigint, near array<bigint>")
    lists = ws.save(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "lists")
    left = members.join(lists, "node").select("shard", "piece", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node", "vector", "near")
    right = dealt.join(plan.where("pieces > 0"), "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int").alias("block"), "node", "vector")

    def find(key, index, asked):
        import pandas as pd

        ids, queries = index["node"].to_numpy(), asked["node"].to_numpy()
        if not len(ids) or not len(queries):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        order = np.argsort(ids)
        ids, raw = ids[order], _matrix(index["vector"])[order]
        near = [index["near"].iloc[i] for i in order]
        graph = np.full((len(ids), max(map(len, near))), -1, np.int64)
        for i, x in enumerate(near):
            at = np.searchsorted(ids, x)
            at[at == len(ids)] = 0
            at = at[ids[at] == x]  # lists also name nodes of other shards
            graph[i, : len(at)] = at
        at = np.searchsorted(ids, queries)
        at[at == len(ids)] = 0
        own = np.where(ids[at] == queries, at, -1)
        wanted = _matrix(asked["vector"])
        v, q = unit(raw).astype(np.float32), unit(wanted).astype(np.float32)
        norms = np.linalg.norm(raw, axis=1)
        pairs = []
        for i, hits in search(v, graph, q, own, threshold - 1e-4):
            cosine = raw[hits] @ wanted[i] / (norms[hits] * np.linalg.norm(wanted[i]))
            hits = ids[hits[cosine >= threshold]]
            hits = hits[hits != queries[i]]
            pairs.append(np.stack([np.minimum(hits, queries[i]), np.maximum(hits, queries[i])], 1))
        pairs = np.unique(np.concatenate([*pairs, np.zeros((0, 2), np.int64)]), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    keys = ("shard", "piece", "block")
    right = right.toDF(*right.columns)  # both sides come from one table
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(find, "a bigint, b bigint")
    pairs = ws.save(pairs.distinct(), "pairs")
    ws.drop(dealt, lists)
    return pairs


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept, audited_recall) of every row; the last, equal in all rows, is the least recall measured for any length of vectors."""
    spark = vectors.sparkSession
    ship(spark)
    ws = Workspace(spark, "vectors")
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    valid = ws.save(source.mapInArrow(_valid, source.schema), "valid")
    nodes = ws.save(valid.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "nodes")
    links, recall = None, 1.0
    for (length,) in nodes.select(F.size("vector")).distinct().collect():
        found, audited = _links(ws, nodes.where(F.size("vector") == length).select("node", "vector"), threshold)
        recall = min(recall, audited)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = spark.createDataFrame([], "a bigint, b bigint")
    components = connected_components(ws, links)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = nodes.select(F.col("node").alias("b"), "copies")
    degree = both.join(weight, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
    known = nodes.join(degree, "node", "left").join(components.withColumnRenamed("id", "node"), "node", "left")
    known = known.select("vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "node").alias("component_id"))
    placed = valid.join(known, "vector").select("vec_id", "n_links", "component_id")
    alone = source.select("vec_id").exceptAll(valid.select("vec_id")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))).withColumn("audited_recall", F.lit(recall))
