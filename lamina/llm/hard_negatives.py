"""Hard negatives by vertical scans of vector blocks (BOND).

A block keeps its vectors by column. For one anchor the columns are read in descending
order of the anchor's magnitudes, a few at a time; after each step a candidate's product
lies between its partial sum plus the least and plus the most that the columns still to
come can add, by their smallest and largest values in the block. Candidates that can
no longer reach what the anchor wants leave the set, and only those that stay are read
in the next columns. All sums are of whole numbers, so what is left at the end has its
exact product.

Two scans are made of all rows: for an anchor's positives (nearest rows of its label),
then for its negatives, the best of other labels in the window that each positive's score
opens. The second one takes all windows of an anchor together.

Defined results: rows with a NULL label, a NULL vector or NULL or non-finite components take
no part; vectors of other lengths are read as if filled with zeros; scores are exact integer
products of floor(scale * x), ends of a long at most; ties go to the smaller id, NULL ids
last, and are never anchors; rows that repeat are rows of their own; an anchor
without other rows of its label, and a positive without rows in its window, gives no rows;
an empty table gives none; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.vector_blocks import EXACT, Scan, dealt, exact_products, first_of, matrix, quantised, scanned
from lamina.session import cut_lineage

SLAB = 4096  # vectors of a block
STEPS = (4, 4, 8, 16)  # columns read before candidates are looked at again; the last one repeats
FOUND = "anchor_row long, anchor_id long, window int, row long, id long, score long"
FIELDS = [part.split()[0] for part in FOUND.split(", ")]


class Block:
    """Vectors by column, with the range of every column."""

    def __init__(self, part: pa.RecordBatch, dims: int):
        self.row, self.id, self.norm = (part.column(n).to_numpy() for n in ("row", "id", "norm"))
        self.columns = np.ascontiguousarray(matrix(part, dims).T)
        self.low = self.columns.min(axis=1, initial=np.inf)
        self.high = self.columns.max(axis=1, initial=-np.inf)
        self.longest = self.norm.max(initial=0.0)


def vertical(anchor: np.ndarray, norm: float, block: Block, alive: np.ndarray, hopeful) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of ``alive`` that stay to the end and their exact products.

    ``hopeful`` is given the least and the greatest possible products and tells who stays.
    """
    if not norm * block.longest < EXACT:
        return alive, exact_products(anchor, block.columns[:, alive].T)
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[anchor[order] != 0]
    ends = np.minimum(anchor[order] * block.low[order], anchor[order] * block.high[order])
    tops = np.maximum(anchor[order] * block.low[order], anchor[order] * block.high[order])
    least = np.concatenate([np.cumsum(ends[::-1])[::-1], [0.0]])
    most = np.concatenate([np.cumsum(tops[::-1])[::-1], [0.0]])
    partial = np.zeros(len(alive))
    whole = len(alive) == block.columns.shape[1]
    done = step = 0
    while done < len(order) and len(alive):
        dims = order[done : done + STEPS[min(step, len(STEPS) - 1)]]
        read = block.columns[dims] if whole else block.columns[np.ix_(dims, alive)]
        partial += anchor[dims] @ read
        done, step = done + len(dims), step + 1
        stay = hopeful(partial + least[done], partial + most[done])
        if not stay.all():
            alive, partial, whole = alive[stay], partial[stay], False
    return alive, partial.astype(np.int64)


class LabelScan(Scan):
    """Shared by both scans: anchors of a group, and vectors that come sorted by label."""

    def __init__(self, dims: int, count: int):
        self.dims, self.count = dims, count
        self.parts: list[pa.RecordBatch] = []
        self.anchors: pa.RecordBatch | None = None

    def ask(self, queries: pa.RecordBatch) -> None:
        self.parts.append(queries)

    def _start(self) -> None:
        rows = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        self.parts, self.anchors = [], rows
        self.row, self.id, self.norm, self.label = (rows.column(n).to_numpy() for n in ("row", "id", "norm", "label"))
        self.vec = matrix(rows, self.dims)
        # The places held so far, for each anchor and window.
        self.best = {}

    def look(self, vectors: pa.RecordBatch) -> None:
        if self.anchors is None:
            if not self.parts:
                return
            self._start()
        labels = vectors.column("label").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
        for start, end in zip(cuts, cuts[1:]):
            wanted = self.wanted(int(labels[start]))
            for at in range(start, end if len(wanted) else start, SLAB):
                block = Block(vectors.slice(at, min(SLAB, end - at)), self.dims)
                for i in wanted.tolist():
                    self.anchor(i, block)

    def last(self, key: tuple[int, int]) -> float:
        """Score from which a candidate of this anchor and window is wanted still."""
        held = self.best.get(key)
        return -np.inf if held is None or len(held[0]) < self.count else held[0][-1]

    def take(self, key: tuple[int, int], score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        if not len(score):
            return
        if key in self.best:
            score, id, row = (np.concatenate([a, b]) for a, b in zip(self.best[key], (score, id, row)))
        keep = first_of(np.zeros(len(score), np.int64), score, id, row, self.count)
        self.best[key] = score[keep], id[keep], row[keep]

    def found(self) -> pa.RecordBatch:
        made = [[] for _ in FIELDS]
        for (i, window), (score, id, row) in getattr(self, "best", {}).items():
            for column, values in zip(made, ([self.row[i]] * len(row), [self.id[i]] * len(row), [window] * len(row), row, id, score)):
                column.extend(int(v) for v in values)
        kinds = [pa.int32() if n == "window" else pa.int64() for n in FIELDS]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)], FIELDS)

    def wanted(self, label: int) -> np.ndarray:
        raise NotImplementedError

    def anchor(self, i: int, block: Block) -> None:
        raise NotImplementedError


class PositiveScan(LabelScan):
    """The nearest other rows of the anchor's label."""

    def wanted(self, label: int) -> np.ndarray:
        return np.flatnonzero(self.label == label)

    def anchor(self, i: int, block: Block) -> None:
        alive = np.flatnonzero(block.row != self.row[i])

        def hopeful(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            sure = np.partition(least, len(least) - self.count)[-self.count] if len(least) >= self.count else -np.inf
            return most >= max(sure, self.last((i, 0)))

        alive, score = vertical(self.vec[i], self.norm[i], block, alive, hopeful)
        self.take((i, 0), score, block.id[alive], block.row[alive])


class NegativeScan(LabelScan):
    """The best rows of other labels in each of the anchor's windows of scores."""

    def _start(self) -> None:
        super()._start()
        lows, highs = (self.anchors.column(n).to_pylist() for n in ("lows", "highs"))
        self.windows = [[(w, lo, hi) for w, (lo, hi) in enumerate(zip(a, b)) if lo <= hi] for a, b in zip(lows, highs)]

    def wanted(self, label: int) -> np.ndarray:
        some = np.array([bool(w) for w in self.windows], bool)
        return np.flatnonzero(some & (self.label != label))

    def anchor(self, i: int, block: Block) -> None:
        windows = [(w, max(lo, self.last((i, w))), hi) for w, lo, hi in self.windows[i]]
        floor, ceiling = min(lo for _, lo, _ in windows), max(hi for _, _, hi in windows)

        def hopeful(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            stay = (most >= floor) & (least <= ceiling)
            at = np.flatnonzero(stay)
            if len(at):
                inside = np.zeros(len(at), bool)
                for _, lo, hi in windows:
                    inside |= (most[at] >= lo) & (least[at] <= hi)
                stay[at] = inside
            return stay

        alive, score = vertical(self.vec[i], self.norm[i], block, np.arange(len(block.row)), hopeful)
        for w, lo, hi in windows:
            mine = (score >= lo) & (score <= hi)
            self.take((i, w), score[mine], block.id[alive[mine]], block.row[alive[mine]])


def _ranked(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of each anchor and window over all stripes, with their rank."""
    order = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    label: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    For each of an anchor's ``positives`` nearest rows of its label, the best ``negatives``
    rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    named = df.where(label.isNotNull())
    data = cut_lineage(
        quantised(named, id, vector, scale, label=label.cast("long"), anchor=F.coalesce(anchors, F.lit(False)))
    )
    size = data.agg(
        F.count("*").alias("rows"), F.count_if("anchor").alias("asked"), F.coalesce(F.max("size"), F.lit(0)).alias("dims")
    ).first()
    rows, asked, dims = size["rows"], size["asked"], size["dims"]
    data = data.select("row", "id", "label", "size", "vec", "norm", "anchor")
    queries, data = data.where("anchor").drop("anchor"), data.drop("anchor")
    order = ("label", "row")
    runs = dealt(queries, data, asked, rows, order)
    nearest = _ranked(scanned(runs, lambda: PositiveScan(dims, positives), FOUND), positives)
    # At most ``positives`` entries for each anchor.
    entry = F.struct("rank", "score", F.col("id").alias("positive_id"), F.col("row").alias("positive_row"))
    lists = cut_lineage(nearest.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(entry)).alias("p")))

    # Whole numbers: 100 * n >= low * p is n >= ceil(low * p / 100), 100 * n <= high * p is n <= floor(high * p / 100).
    wide = F.transform("p", lambda x: x["score"].cast("decimal(38,0)"))
    lows = F.transform(wide, lambda p: F.ceil(p * low / 100).cast("decimal(20,0)"))
    highs = F.transform(wide, lambda p: F.floor(p * high / 100).cast("decimal(20,0)"))
    held = lambda xs: F.transform(
        xs, lambda x: F.least(F.greatest(x, F.lit(-(1 << 63)).cast("decimal(20,0)")), F.lit((1 << 63) - 1).cast("decimal(20,0)")).cast("long")
    )
    windows = lists.select("row", held(lows).alias("lows"), held(highs).alias("highs"))
    none = F.lit(None).cast("array<long>")
    second = dealt(
        queries.join(windows, "row").select("row", "id", "label", "size", "vec", "norm", "lows", "highs"),
        data.withColumns({"lows": none, "highs": none}), asked, rows, order,
    )
    negative = _ranked(scanned(second, lambda: NegativeScan(dims, negatives), FOUND), negatives)
    one = lists.select(F.col("row").alias("anchor_row"), F.posexplode("p").alias("window", "x"))
    joined = negative.join(one, ["anchor_row", "window"])
    return joined.select(
        F.col("anchor_id"),
        F.when(F.col("x.positive_row") >= 0, F.col("x.positive_id")).alias("positive_id"),
        "rank",
        F.when(F.col("row") >= 0, F.col("id")).alias("negative_id"),
        F.col("x.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def oracle() -> str:
    """The registered query in SQL: anchors of ids divisible by 100, labels of every seventh id moved on."""
    return """
    WITH whole AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
             CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
      FROM whole a JOIN whole c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
    ), positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 5"""
