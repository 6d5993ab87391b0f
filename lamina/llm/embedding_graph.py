"""Near-duplicate vectors by a robust-pruned flat graph.

Distinct vectors are dealt to overlapping shards: the clusters whose centroids are
nearly as near as the nearest one. Each shard builds a graph in which a vector
keeps the near neighbours that no kept neighbour is much nearer to; the adjacency
lists of a vector are united over its shards. In each shard every vector is
searched for in the united graph, greedily from the shard's medoids, and then by
expanding whatever is within a widened radius. What is found is verified in double
precision. Recall is audited against brute force for a bounded set of queries; if
it is too low, everything is done again with more overlap and wider beams.

Two vectors can meet in several shards; their link is counted in the first shard
that both are in, so links need not be collected as pairs. A shard returns, for
each vector, a sum of links and the root of its tree among the shard's links. A
shard of more than ``WIDEST`` vectors is cut into blocks, and every pair of its
blocks becomes a shard of its own, so that none is lost.

Defined results: vectors that are NULL, empty, zero, of another length than the
rest, or hold NULL or a non-finite number link with nothing and are components of
their own; equal vectors are one class and link with each other; a NULL vec_id
is counted as a vector, and the component is the smallest other id (NULL if there is
none); an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.components import connected_components
from lamina.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    radius: float = 0.95  # least cosine of a link
    shard: int = 1500  # vectors a cluster has on average, before overlap
    widest: int = 6000
    overlap: int = 3  # clusters a vector is in at most
    margin: float = 0.15  # cosine by which a further cluster's centroid may be farther
    sample: int = 20_000  # vectors the centroids are fitted on
    candidates: int = 32
    degree: int = 24
    alpha: float = 2.2  # on cosine distance: the square of a factor on lengths
    beam: int = 20
    medoids: int = 24
    slack: float = 0.1  # range search expands what is this much below the radius
    audited: int = 1000
    recall: float = 0.97


# ---- inside a shard --------------------------------------------------------------


def build_graph(x: np.ndarray, s: Settings) -> np.ndarray:
    """Neighbour rows (-1: none) of a robust-pruned graph over unit vectors, both ways.

    Candidates are the nearest vectors and, by ranks that grow geometrically, ever
    farther ones; each kind has half of the places, so that a tight group of many
    vectors still has links that lead out of it and, backwards, into it.
    """
    n = len(x)
    wide = min(n - 1, s.candidates)
    out = np.full((n, s.degree), -1, np.int64)
    if wide < 1:
        return out
    steps = np.geomspace(wide, n - 1, s.candidates // 2).astype(int)
    ranks = np.unique(np.concatenate([np.arange(wide), np.minimum(steps, n - 2)]))
    near_places = ranks < wide
    for start in range(0, n, 256):
        rows = np.arange(start, min(n, start + 256))
        sims = x[rows] @ x.T
        sims[np.arange(len(rows)), rows] = -2
        near = np.argsort(-sims, axis=1)[:, ranks]
        dist = 1 - np.take_along_axis(sims, near, 1)
        vectors = x[near]
        between = 1 - np.matmul(vectors, vectors.transpose(0, 2, 1))
        each = np.arange(len(rows))
        open_ = np.ones(near.shape, bool)
        for place in range(s.degree):
            kind = near_places if place < s.degree // 2 or near_places.all() else ~near_places
            allowed = open_ & kind
            pick = np.argmax(allowed, axis=1)
            some = allowed[each, pick]
            out[rows[some], place] = near[each, pick][some]
            # Distances below single precision cover nothing, else near-equal vectors would lose their links.
            open_[some] &= ~(s.alpha * between[each, pick] + 1e-5 <= dist)[some]
            open_[each[some], pick[some]] = False
    return np.concatenate([out, _reversed(out)], axis=1)


def _reversed(graph: np.ndarray) -> np.ndarray:
    """For each row up to as many rows that list it as a list has places; those that list it early come first.

    A few vectors of a group are near to all others; without that order the rows
    that find room with none of them could not be reached.
    """
    source, place = np.nonzero(graph >= 0)
    target = graph[source, place]
    order = np.lexsort((place, target))
    source, target = source[order], target[order]
    turn = np.arange(len(target)) - np.searchsorted(target, target)
    fits = turn < graph.shape[1]
    out = np.full(graph.shape, -1, np.int64)
    out[target[fits], turn[fits]] = source[fits]
    return out


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """The vector nearest to the mean, then again and again the one farthest from those chosen."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return np.array(chosen)


def range_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, starts: np.ndarray, s: Settings) -> np.ndarray:
    """Row by row for ``queries``, which vectors the search has found within the radius (not verified)."""
    q, n = len(queries), len(x)
    each = np.arange(q)[:, None]
    seen = np.full((q, n), -2, np.float32)
    wanted = x[queries]
    sims = wanted @ x[starts].T
    first = np.argsort(-sims, axis=1)[:, : s.beam]
    beam, score = starts[first], np.take_along_axis(sims, first, 1)
    seen[each, beam] = score
    spare = ((0, 0), (0, max(0, s.beam - beam.shape[1])))
    beam, score = np.pad(beam, spare), np.pad(score, spare, constant_values=-3)
    done = score <= -3
    while True:
        best = np.argmax(np.where(done, -3, score), axis=1)
        active = ~done[each[:, 0], best]
        if not active.any():
            break
        done[each[:, 0], best] = True
        a = np.flatnonzero(active)
        near = graph[beam[a, best[a]]]
        fresh = (near >= 0) & (seen[a[:, None], near] == -2)
        value = np.where(fresh, np.einsum("qkd,qd->qk", x[near], wanted[a], optimize=True), -3)
        r, c = np.nonzero(fresh)
        seen[a[r], near[r, c]] = value[r, c]
        # A list may name a vector twice; only one of them joins the beam.
        order = np.sort(np.where(fresh, near, -1 - np.arange(near.shape[1])), axis=1)
        if (order[:, 1:] == order[:, :-1]).any():
            value = np.where(_first_of(near) | ~fresh, value, -3)
        both, sim = np.concatenate([beam[a], near], 1), np.concatenate([score[a], value], 1)
        was = np.concatenate([done[a], value <= -3], 1)
        keep = np.argpartition(-sim, beam.shape[1] - 1, axis=1)[:, : beam.shape[1]]
        beam[a], score[a] = np.take_along_axis(both, keep, 1), np.take_along_axis(sim, keep, 1)
        done[a] = np.take_along_axis(was, keep, 1)
    expanded = np.zeros((q, n), bool)
    while True:
        rows, cols = np.nonzero((seen >= s.radius - s.slack) & ~expanded)
        if not len(rows):
            break
        for start in range(0, len(rows), 8192):
            r, c = rows[start : start + 8192], cols[start : start + 8192]
            expanded[r, c] = True
            near = graph[c]
            r = np.repeat(r, near.shape[1])
            near = near.ravel()
            fresh = (near >= 0) & (seen[r, near] == -2)
            r, near = r[fresh], near[fresh]
            seen[r, near] = np.einsum("pd,pd->p", x[near], wanted[r], optimize=True)
    return seen >= s.radius - 1e-4


def _first_of(near: np.ndarray) -> np.ndarray:
    order = np.argsort(near, axis=1, kind="stable")
    held = np.take_along_axis(near, order, 1)
    first = np.concatenate([np.ones((len(near), 1), bool), held[:, 1:] != held[:, :-1]], axis=1)
    out = np.empty_like(first)
    np.put_along_axis(out, order, first, 1)
    return out


def shard_links(vectors: np.ndarray, weight: np.ndarray, graph: np.ndarray, shards: np.ndarray, own: int, s: Settings):
    """For each vector of a shard: the sum of weights of its links that count here, and the row of its tree's root."""
    n = len(vectors)
    x = vectors.astype(np.float32)
    starts = medoids(x, s.medoids)
    links = np.zeros((n, n), bool)
    for start in range(0, n, 256):
        rows = np.arange(start, min(n, start + 256))
        found = range_search(x, graph, rows, starts, s)
        a, b = np.nonzero(found)
        for cut in range(0, len(a), 1 << 17):
            i, j = rows[a[cut : cut + (1 << 17)]], b[cut : cut + (1 << 17)]
            real = np.einsum("pd,pd->p", vectors[i], vectors[j], optimize=True) >= s.radius
            links[i[real], j[real]] = True
    links |= links.T
    np.fill_diagonal(links, False)
    total, root = np.zeros(n), np.arange(n)
    i, j = np.nonzero(links)
    for cut in range(0, len(i), 1 << 17):
        a, b = i[cut : cut + (1 << 17)], j[cut : cut + (1 << 17)]
        common = (shards[a][:, :, None] == shards[b][:, None, :]) & (shards[a] >= 0)[:, :, None]
        least = np.where(common.any(axis=2), shards[a], np.iinfo(np.int64).max).min(axis=1)
        mine = least == own
        total += np.bincount(a[mine], weight[b[mine]], n)
    while len(i):
        lower = root.copy()
        np.minimum.at(lower, i, root[j])
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    return total.astype(np.int64), root


# ---- on Spark ----------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` with ``_v``, the vector scaled to length 1 in double precision; NULL where there is none."""
    wide = rows.select(F.size(vector).alias("n")).where("n > 0").groupBy("n").count().orderBy(F.desc("count"), "n").first()
    if wide is None:
        return rows.withColumn("_v", F.lit(None).cast("array<double>"))
    v = F.transform(vector, lambda x: x.cast("double"))
    largest = F.array_max(F.transform(v, F.abs))
    sound = (F.size(vector) == wide["n"]) & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    # Scaled by the largest component first, so that squares neither vanish nor overflow.
    rows = rows.withColumn("_s", F.when(sound, largest)).withColumn("_v", F.when(F.col("_s") > 0, F.transform(v, lambda x: x / F.col("_s"))))
    length = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("_l", length).withColumn("_v", F.transform("_v", lambda x: x / F.col("_l"))).drop("_s", "_l")


def centroids(classes: DataFrame, count: int, s: Settings) -> np.ndarray:
    """Centroids of about ``count / s.shard`` clusters, fitted on a bounded sample of the classes."""
    place = F.pmod(F.xxhash64("node", F.lit("centroids")), F.lit(1 << 30))
    share = min(1.0, s.sample / max(1, count))
    some = classes.where(place < int(share * (1 << 30))).select("node", "v").orderBy("node").toArrow()
    x = _matrix(some.column("v")).astype(np.float32)
    k = max(1, min(len(x) // 4, round(count / s.shard)))
    rng = np.random.default_rng(11)
    centers = x[np.sort(rng.choice(len(x), k, replace=False))] if len(x) else np.zeros((1, 1), np.float32)
    for _ in range(8 if k > 1 else 0):
        best = np.argmax(x @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, best, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 1e-6, sums / np.maximum(norm, 1e-6), centers)
    return centers


def deal(classes: DataFrame, centers: np.ndarray, s: Settings) -> DataFrame:
    """``classes`` with ``shards``: the numbers of the clusters each vector is in, the nearest first."""
    sent = classes.sparkSession.sparkContext.broadcast(centers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sims = _matrix(batch.column("v")).astype(np.float32) @ sent.value.T
            order = np.argsort(-sims, axis=1, kind="stable")[:, : s.overlap]
            held = np.take_along_axis(sims, order, 1)
            found = [row[near].tolist() for row, near in zip(order, held >= held[:, :1] - s.margin)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], [*batch.schema.names, "shards"])

    dealt = cut_lineage(classes.mapInArrow(run, "node long, n long, v array<double>, shards array<long>"))
    sizes = dealt.select(F.explode("shards").alias("shard")).groupBy("shard").count().where(F.col("count") > s.widest)
    # One number for each cluster at most.
    wide = {row["shard"]: -(-2 * row["count"] // s.widest) for row in sizes.collect()}
    if not wide:
        return dealt.withColumn("shards", F.transform("shards", lambda x: x * (1 << 32)))
    blocks = F.create_map(*[F.lit(v) for pair in wide.items() for v in pair])

    def spread(shard):
        count = F.coalesce(F.element_at(blocks, shard.cast("int")), F.lit(1)).cast("long")
        mine = F.pmod(F.xxhash64("node", F.lit("block")), count)
        pairs = F.transform(
            F.sequence(F.lit(0).cast("long"), count - 1),
            lambda other: shard * (1 << 32) + F.least(mine, other) * (1 << 16) + F.greatest(mine, other),
        )
        return pairs

    return dealt.withColumn("shards", F.flatten(F.transform("shards", spread)))


def _padded(column: pa.ChunkedArray, fill: int = -1) -> np.ndarray:
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), max(1, int(sizes.max(initial=0)))), fill, np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = column.flatten().to_numpy()
    return out


def adjacency(dealt: DataFrame, s: Settings) -> DataFrame:
    """``node`` and ``near``: the lists of all shards of a vector, united."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        nodes = group.column("node").to_numpy()
        rows = build_graph(_matrix(group.column("v")).astype(np.float32), s)
        lists = [nodes[row[row >= 0]] for row in rows]
        return pa.table({"node": nodes, "near": pa.array(lists, pa.list_(pa.int64()))})

    members = dealt.select(F.explode("shards").alias("shard"), "node", "v")
    lists = members.groupBy("shard").applyInArrow(build, "node long, near array<long>")
    # A vector is in few shards, and a list has at most ``degree`` entries.
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def search(dealt: DataFrame, lists: DataFrame, s: Settings) -> DataFrame:
    """``node``, ``links`` (a part of the sum) and ``root`` for each vector of each shard."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        nodes = group.column("node").to_numpy()
        near = _padded(group.column("near"), np.iinfo(np.int64).min)
        at = np.minimum(np.searchsorted(nodes, near), len(nodes) - 1)
        graph = np.where(nodes[at] == near, at, -1)
        own = group.column("shard")[0].as_py()
        total, root = shard_links(
            _matrix(group.column("v")), group.column("n").to_numpy(), graph, _padded(group.column("shards")), own, s
        )
        return pa.table({"node": nodes, "links": total, "root": nodes[root]})

    members = dealt.join(lists, "node").select(F.explode("shards").alias("shard"), "node", "n", "v", "shards", "near")
    return members.groupBy("shard").applyInArrow(run, "node long, links long, root long")


def audit(classes: DataFrame, found: DataFrame, count: int, s: Settings) -> float:
    """Share of the links of a bounded set of queries, against all vectors, that ``found`` (node, links) has."""
    place = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1 << 30))
    asked = classes.where(place < int(min(1.0, s.audited / max(1, count)) * (1 << 30)))
    got = asked.select("node", "v").toArrow()
    nodes, x = got.column("node").to_numpy(), _matrix(got.column("v"))
    sent = classes.sparkSession.sparkContext.broadcast((nodes, x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted = sent.value
        for batch in batches:
            if batch.num_rows and len(ids):
                near = _matrix(batch.column("v")) @ wanted.T >= s.radius
                near &= batch.column("node").to_numpy()[:, None] != ids[None, :]
                held = near.T.astype(np.int64) @ batch.column("n").to_numpy()
                some = held > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(held[some])], ["node", "real"])

    real = classes.select("node", "n", "v").mapInArrow(run, "node long, real long").groupBy("node").agg(F.sum("real").alias("real"))
    row = real.join(found, "node", "left").agg(F.sum(F.least("links", "real")).alias("found"), F.sum("real").alias("real")).first()
    return (row["found"] or 0) / row["real"] if row["real"] else 1.0


def near_duplicates(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``id``, n_links, component_id, kept and the audited recall, one row for each row of ``rows``."""
    all_rows = unit_vectors(rows.select(F.col(id).alias("vec_id"), F.col(vector).alias("embedding")))
    all_rows = cut_lineage(all_rows.select("vec_id", "_v", F.when(F.col("_v").isNotNull(), F.xxhash64("_v")).alias("node")))
    sound = all_rows.where("node is not null")
    classes = cut_lineage(sound.groupBy("node").agg(F.count("*").alias("n"), F.first("_v").alias("v"), F.min("vec_id").alias("least")))
    count = classes.count()
    plain = classes.select("node", "n", "v")
    s, recall = settings, 1.0
    centers = centroids(plain, count, s)
    for _ in range(3):
        dealt = cut_lineage(deal(plain, centers, s))
        parts = cut_lineage(search(dealt, adjacency(dealt, s), s))
        links = parts.groupBy("node").agg(F.sum("links").alias("links"))
        recall = audit(plain, links, count, s)
        if recall >= s.recall:
            break
        s = replace(s, overlap=s.overlap + 2, margin=s.margin * 2, beam=2 * s.beam, slack=s.slack * 1.5)
    trees = connected_components(parts.select("node", F.col("root").alias("other")), "node", "other")
    named = classes.select("node", "n", "least").join(links, "node", "left").join(trees, "node", "left")
    named = named.select("node", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(component, "root").select("node", "n_links", "component_id")
    out = sound.select("vec_id", "node").join(named, "node").select("vec_id", "n_links", "component_id")
    alone = all_rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    return out.withColumn("recall", F.lit(float(recall))).withColumnRenamed("vec_id", id)
