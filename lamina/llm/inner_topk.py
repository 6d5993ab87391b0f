"""Exact search of the largest inner products, by norm-sorted scans with residual bounds.

Vectors are turned into an orthogonal basis (right singular vectors of a sample) in
which the first coordinates carry most of the length. A stripe is read by descending
length. After the first coordinates, the rest of a product is at most the product of
the two remaining lengths (Cauchy-Schwarz); a candidate whose partial sum plus this
bound stays under a query's current last place is dropped, and once a query's length
times the longest vector left stays under it, the query reads no further. What is left
is scored in whole numbers, so the basis decides the work and never the result.

Defined results: scores are exact integer inner products of floor(scale * x), ends of a
long at most; vectors of other lengths are read as if filled with zeros; NULL vectors and
those with NULL or non-finite components take no part; a row is its own query's candidate
never, but other rows with its id are; rows that repeat count as often as they stand there;
NULL ids come after all others on ties; an empty table or no query gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.vector_blocks import EXACT, Scan, dealt, exact_products, first_of, matrix, quantised, scanned
from lamina.session import cut_lineage

SAMPLED = 20_000  # rows at most on which the basis is fitted
FIT_PARTS = 16
SLAB = 1024  # vectors scored together
DENSE = 0.15  # share of pairs left from which a slab is scored as a whole
FOUND = "query_row long, query_id long, row long, id long, score long"


def basis(data: DataFrame, rows: int, dims: int) -> np.ndarray:
    """Right singular vectors of a bounded sample of the vectors, largest first, as columns.

    The sample's products are added up in a few tasks; the driver gets their d x d sums.
    """
    if not rows or not dims:
        return np.eye(dims)
    place = F.pmod(F.xxhash64("row", F.lit("basis")), F.lit(1 << 30))
    some = data.where(place < int(min(1.0, SAMPLED / rows) * (1 << 30))).where(F.col("norm") < 1e100)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = matrix(batch, dims)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["gram"])

    parts = some.select("size", "vec").repartition(FIT_PARTS).mapInArrow(add, "gram binary")
    total = sum((np.frombuffer(r["gram"]).reshape(dims, dims) for r in parts.toLocalIterator()), np.zeros((dims, dims)))
    return np.ascontiguousarray(np.linalg.eigh(total)[1][:, ::-1])


class NormScan(Scan):
    """One group of queries against one stripe, longest vectors first."""

    def __init__(self, turn: np.ndarray, count: int):
        self.turn, self.count = turn, count
        dims = len(turn)
        self.levels = sorted({max(1, dims // 4), max(1, dims // 2)}) if dims else []
        self.parts: list[pa.RecordBatch] = []
        self.q = None
        self.scored = self.held = 0  # pairs scored exactly, pairs looked at

    def ask(self, queries: pa.RecordBatch) -> None:
        self.parts.append(queries)

    def _start(self) -> None:
        rows = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        self.parts = []
        self.row, self.id, self.norm = (rows.column(n).to_numpy() for n in ("row", "id", "norm"))
        self.q = matrix(rows, len(self.turn))
        self.turned = self.q @ self.turn
        self.rest = [np.sqrt(np.maximum((self.turned[:, n:] ** 2).sum(axis=1), 0)) for n in self.levels]
        self.last = np.full(len(self.row), -np.inf)
        self.key, self.score, self.found_id, self.found_row = (np.array([], np.int64) for _ in range(4))

    def look(self, vectors: pa.RecordBatch) -> None:
        if self.q is None:
            if not self.parts:
                return
            self._start()
        norms = vectors.column("norm").to_numpy()
        for start in range(0, len(norms), SLAB):
            # Nothing that follows is longer, so a query that is done stays done.
            reach = self.norm * norms[start] * (1 + 1e-9)
            active = np.flatnonzero(~(reach < self.last))
            if not len(active):
                return
            self._slab(active, vectors.slice(start, SLAB), norms[start : start + SLAB])

    def _slab(self, active: np.ndarray, part: pa.RecordBatch, norms: np.ndarray) -> None:
        x = matrix(part, len(self.turn))
        row, id = part.column("row").to_numpy(), part.column("id").to_numpy()
        self.held += len(active) * len(row)
        if not self.norm[active].max() * norms[0] < EXACT:
            scores = np.stack([exact_products(self.q[i], x) for i in active.tolist()])
            at, other = np.nonzero(scores >= -np.inf)
            self._take(active[at], scores[at, other], id[other], row[other])
            return
        turned = x @ self.turn
        left = np.ones((len(active), len(row)), bool)
        slack = 1e-9 * self.norm[active] * norms[0] + 1e-6
        for n, rest in zip(self.levels, self.rest):
            more = np.sqrt(np.maximum((turned[:, n:] ** 2).sum(axis=1), 0))
            bound = self.turned[active, :n] @ turned[:, :n].T + rest[active][:, None] * more
            left = bound >= (self.last[active] - slack)[:, None]
            if np.count_nonzero(left) <= DENSE * left.size:
                break
        at, other = np.nonzero(left)
        if len(at) > DENSE * left.size:
            scores = self.q[active] @ x.T
            # One more than wanted, as the query's own row may be among them.
            n = min(self.count + 1, scores.shape[1])
            least = np.partition(scores, scores.shape[1] - n, axis=1)[:, -n] if n > self.count else np.full(len(active), -np.inf)
            at, other = np.nonzero(scores >= np.maximum(self.last[active], least)[:, None])
            values = scores[at, other]
            self.scored += scores.size
        else:
            values = np.einsum("ij,ij->i", self.q[active[at]], x[other])
            self.scored += len(at)
        self._take(active[at], values.astype(np.int64), id[other], row[other])

    def _take(self, key: np.ndarray, score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        """Unites new candidates with the places held so far."""
        mine = (score >= self.last[key]) & (row != self.row[key])
        key, score, id, row = (np.concatenate([a, b[mine]]) for a, b in (
            (self.key, key), (self.score, score), (self.found_id, id), (self.found_row, row)))
        keep = first_of(key, score, id, row, self.count)
        self.key, self.score, self.found_id, self.found_row = key[keep], score[keep], id[keep], row[keep]
        full = np.bincount(self.key, minlength=len(self.row)) == self.count
        ends = np.flatnonzero(np.append(self.key[1:] != self.key[:-1], True)) if len(self.key) else np.array([], int)
        ends = ends[full[self.key[ends]]]
        self.last[self.key[ends]] = self.score[ends]

    def found(self) -> pa.RecordBatch:
        if self.q is None:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 5, FIELDS)
        columns = (self.row[self.key], self.id[self.key], self.found_row, self.found_id, self.score)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], FIELDS)


FIELDS = [part.split()[0] for part in FOUND.split(", ")]


def _named(id: str, row: str) -> Column:
    return F.when(F.col(row) >= 0, F.col(id))


def top_products(
    df: DataFrame,
    asked: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    count: int = 5,
    scale: float = 256.0,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``count`` largest products of every row that is ``asked``."""
    data = cut_lineage(quantised(df, id, vector, scale, asked=F.coalesce(asked, F.lit(False))))
    size = data.agg(
        F.count("*").alias("rows"), F.count_if("asked").alias("asked"), F.coalesce(F.max("size"), F.lit(0)).alias("dims")
    ).first()
    rows, dims = size["rows"], size["dims"]
    turn = data.sparkSession.sparkContext.broadcast(basis(data, rows, dims))
    data = data.select("row", "id", "size", "vec", "norm", "asked")
    runs = dealt(data.where("asked").drop("asked"), data.drop("asked"), size["asked"], rows, ("norm desc", "row"))
    found = scanned(runs, lambda: NormScan(turn.value, count), FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select(
        _named("query_id", "query_row").alias("query_id"), "rank", _named("id", "row").alias("vec_id"), "score"
    )


def oracle(count: int = 5, every: int = 50) -> str:
    return f"""
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= {count}"""
