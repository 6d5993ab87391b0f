"""Integer vectors in blocks, and the dealing of queries to stripes of all rows.

A stripe is a part of the table, chosen by row hash; a group is a bounded number
of queries. Every pair of group and stripe is one run of rows in one partition:
the group's queries first, then the stripe's vectors in the order the search asks
for. A task reads the run as a stream, so its memory is one group and one batch.
The number of stripes grows with the square root of the table, so the queries'
copies stay a small share of the work; it never changes a result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_ROWS = 4096  # queries of one group
ROWS_A_STRIPE = 25  # a table of n rows has about sqrt(n) / 25 stripes
MOST_STRIPES = 256
MOST_PARTITIONS = 20_000
EXACT = float(1 << 53)  # integer products and their sums below this are exact in doubles
NO_ID = np.iinfo(np.int64).max


def quantised(
    df: DataFrame, id: str, vector: str, scale: float = 256.0, **kept: Column
) -> DataFrame:
    """``row`` (a number of its own), ``id``, the ``kept`` columns, size, vec (floor(scale * x)) and norm.

    Vectors that are NULL or hold NULL or non-finite components are left out. A
    NULL id counts as the largest one and turns ``row`` to its complement.
    """
    numbered = F.monotonically_increasing_id()
    rows = df.select(
        numbered.alias("_n"), F.col(id).cast("long").alias("id"),
        *[c.alias(n) for n, c in kept.items()], F.col(vector).cast("array<double>").alias("_v"),
    )
    rows = rows.where("_v is not null").select(
        F.when(F.col("id").isNull(), F.bitwise_not("_n")).otherwise(F.col("_n")).alias("row"),
        F.coalesce("id", F.lit(int(NO_ID))).alias("id"), *kept, "_v",
    )
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_v")
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.cumsum(sizes)
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            sound = odd[ends] == odd[ends - sizes]
            packed, norms = [], []
            for end, size in zip(ends[sound].tolist(), sizes[sound].tolist()):
                one = flat[end - size : end]
                packed.append(_packed(one))
                with np.errstate(over="ignore"):
                    norms.append(math.sqrt(float(one @ one)))
            made = [pa.array(sizes[sound], pa.int32()), pa.array(packed, pa.binary()), pa.array(norms, pa.float64())]
            rest = batch.filter(pa.array(sound)).columns[:-1]
            yield pa.RecordBatch.from_arrays([*rest, *made], [*batch.schema.names[:-1], "size", "vec", "norm"])

    listed = [f"{n} {kinds[n]}" for n in ("row", "id", *kept)]
    return rows.mapInArrow(run, ", ".join([*listed, "size int", "vec binary", "norm double"]))


def _packed(numbers: np.ndarray) -> bytes:
    """The numbers in the fewest bytes that hold them all: 2 or 4 as integers, 8 as doubles."""
    largest = np.abs(numbers).max(initial=0.0)
    kind = np.int16 if largest < 1 << 15 else np.int32 if largest < 1 << 31 else np.float64
    return numbers.astype(kind).tobytes()


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors as rows of doubles, shorter ones filled with zeros."""
    sizes = batch.column("size").to_numpy()
    packed = batch.column("vec").to_pylist()
    out = np.zeros((len(sizes), dims))
    widths = np.array([len(one) for one in packed], np.int64) // np.maximum(sizes, 1)
    for size, width in set(zip(sizes.tolist(), widths.tolist())):
        if not size:
            continue
        at = np.flatnonzero((sizes == size) & (widths == width))
        kind = {2: np.int16, 4: np.int32, 8: np.float64}[width]
        out[at, :size] = np.frombuffer(b"".join([packed[i] for i in at.tolist()]), kind).reshape(len(at), size)
    return out


def exact_products(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Inner products of ``one`` with the rows of ``many`` in whole numbers of any size, held to the ends of a long."""
    low, high = -(1 << 63), (1 << 63) - 1
    mine = [int(x) for x in one.tolist()]
    sums = [sum(a * int(b) for a, b in zip(mine, other)) for other in many.tolist()]
    return np.array([min(max(s, low), high) for s in sums], np.int64)


def stripes_of(rows: int) -> int:
    return min(MOST_STRIPES, max(1, math.ceil(math.sqrt(rows) / ROWS_A_STRIPE)))


def dealt(queries: DataFrame, data: DataFrame, asked: int, rows: int, order: Sequence[str]) -> DataFrame:
    """Runs of queries (kind 0) and vectors (kind 1), each pair of group and stripe in one partition.

    Both frames have the same columns; ``order`` sorts the vectors of a run.
    """
    groups, stripes = max(1, -(-asked // GROUP_ROWS)), stripes_of(rows)
    group = F.pmod(F.xxhash64("row"), F.lit(groups))
    stripe = F.pmod(F.xxhash64("row", F.lit("stripe")), F.lit(stripes))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    first = queries.select(group.alias("_g"), every(stripes).alias("_s"), F.lit(0).alias("kind"), "*")
    second = data.select(every(groups).alias("_g"), stripe.alias("_s"), F.lit(1).alias("kind"), "*")
    both = first.unionByName(second).withColumn("pair", F.col("_g") * stripes + F.col("_s")).drop("_g", "_s")
    count = min(groups * stripes, MOST_PARTITIONS)
    placed = both.repartitionById(count, F.pmod("pair", F.lit(count)).cast("int"))
    return placed.sortWithinPartitions("pair", "kind", *[F.expr(o) for o in order])


class Scan:
    """What a search does with one run: take queries, then vectors, then give its rows."""

    def ask(self, queries: pa.RecordBatch) -> None:
        raise NotImplementedError

    def look(self, vectors: pa.RecordBatch) -> None:
        raise NotImplementedError

    def found(self) -> pa.RecordBatch:
        raise NotImplementedError


def scanned(rows: DataFrame, make: Callable[[], Scan], schema: str) -> DataFrame:
    """The results of one ``Scan`` for each run of :func:`dealt` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, now = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs = batch.column("pair").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(pairs)) + 1).tolist(), len(pairs)]
            for start, end in zip(cuts, cuts[1:]):
                pair, kind = divmod(int(pairs[start]), 2)
                if pair != now:
                    if scan:
                        yield scan.found()
                    scan, now = make(), pair
                part = batch.slice(start, end - start)
                scan.look(part) if kind else scan.ask(part)
        if scan:
            yield scan.found()

    return rows.mapInArrow(run, schema)


def first_of(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` entries of each key: higher scores, then smaller ids."""
    order = np.lexsort((rows, ids, ~scores, keys))
    key = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.array([], int)
    place = np.arange(len(key)) - np.repeat(starts, np.diff([*starts, len(key)]))
    return order[place < count]
