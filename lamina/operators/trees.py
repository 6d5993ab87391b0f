"""Decision trees grown from counts: training, prediction, importances, structure.

Features are seen as codes of at most 32 equal ranks. A level of all trees is one
grouped count of (tree, node, feature, code) over the rows of the smaller children; what their
siblings hold is the parent's counts less these. Cuts are chosen by a window over the
counts, so the driver sees one row for each node. A fitted tree is a table of nodes; the rows
of a batch walk it together by looking up arrays, one step a level. What is done to each
row - codes, walks, counts of a partition - is numpy on Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.functions.scalars import col, finite_or_zero, number_of
from lamina.operators.features import numeric_matrix
from lamina.operators.selection import select_ranks
from lamina.session import cut_lineage, ship

BUCKET_ROWS = 10_000  # rows among which a feature is permuted
BINS = 32  # codes a feature has at most
NARROW = 64  # values of a feature that are counted one by one
LEAST_GAIN = 1e-12  # a cut that gains no more is none
TIE_DIGITS = 12  # gains that agree so far are equal: the first feature, then the lowest cut


@dataclass(frozen=True)
class TreeSpec:
    """Split rule and depth of one model."""

    name: str
    impurity: str
    depth: int


# The two models that are compared.
GINI = TreeSpec("modelo1_gini", "gini", 5)
ENTROPY = TreeSpec("modelo2_entropy", "entropy", 10)


@dataclass(frozen=True)
class Node:
    """A node with its train rows of both classes; inner ones have a cut and two children."""

    depth: int
    zeros: int
    ones: int
    feature: int | None = None
    code: int | None = None  # rows up to this code, and up to this threshold, go left
    threshold: float | None = None
    gain: float | None = None
    left: int | None = None
    right: int | None = None

    @property
    def prediction(self) -> int:
        return int(self.ones > self.zeros)


@dataclass(frozen=True)
class FittedTree:
    """Nodes numbered from the root, left before right: a left child follows its parent."""

    spec: TreeSpec
    features: tuple[str, ...]
    nodes: tuple[Node, ...] = field(repr=False)

    @property
    def depth(self) -> int:
        return max(n.depth for n in self.nodes)


def bin_edges(
    train: DataFrame, names: Sequence[str], bins: int = BINS, **limits: int
) -> dict[str, tuple[float, ...]]:
    """Ascending bounds that cut each feature into at most ``bins`` codes of equal ranks of all rows."""
    if not names:
        return {}
    numbers = numeric_matrix(train, names)
    rows = numbers.count()
    places = sorted({rows * k // bins for k in range(1, bins)}) if rows else []
    counted = _few_values(numbers) if rows else {}
    wide = [n for n in names if n not in counted]
    at = select_ranks(numbers.select(*[col(n) for n in wide]), {n: places for n in wide}, {n: rows for n in wide}, **limits)
    for n, cells in counted.items():
        held, sizes = zip(*sorted(cells))
        at[n] = dict(zip(places, (held[i] for i in np.searchsorted(np.cumsum(sizes), places, "right"))))
    return {n: tuple(sorted({float(v) for v in at[n].values()})) for n in names}


def _few_values(numbers: DataFrame) -> dict[str, list[tuple[float, int]]]:
    """Every value with its rows, of the columns that have at most ``NARROW`` values: one pass, no sort of rows."""
    ship(numbers.sparkSession)
    names = numbers.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict | None] = [{} for _ in names]
        for batch in batches:
            for i, mine in enumerate(held):
                if mine is None:
                    continue
                found, sizes = np.unique(batch.column(i).to_numpy(zero_copy_only=False) + 0.0, return_counts=True)
                for value, n in zip(found[: NARROW + 1].tolist(), sizes.tolist()):
                    mine[value] = mine.get(value, 0) + n
                if len(mine) > NARROW:
                    held[i] = None
        cells = [(i, v, n) for i, mine in enumerate(held) for v, n in ([(None, 0)] if mine is None else mine.items())]
        yield pa.RecordBatch.from_pylist(
            [{"f": i, "v": v, "n": n} for i, v, n in cells], pa.schema([("f", pa.int32()), ("v", pa.float64()), ("n", pa.int64())])
        )

    renamed = numbers.select(*[col(n).alias(f"_f{i}") for i, n in enumerate(names)])
    sums = renamed.mapInArrow(run, "f int, v double, n bigint").groupBy("f", "v").agg(F.sum("n").alias("n"))
    listed = sums.groupBy("f").agg(
        F.collect_list(F.struct("v", "n")).alias("cells"), F.count("*").alias("values"), F.bool_or(F.col("v").isNull()).alias("wide")
    )
    found = listed.where((F.col("values") <= NARROW) & ~F.col("wide")).collect()
    return {names[row["f"]]: [(c["v"], c["n"]) for c in row["cells"]] for row in found}


def codes(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> Column:
    """A byte for each feature: how many of its bounds are below the value."""
    bounds = [np.array(e, np.float64) for e in edges.values()]
    if not bounds:
        return F.lit(bytearray())

    def coded(x: pa.Array) -> pa.Array:
        rows = _rows_of(x, len(bounds))
        made = np.empty(rows.shape, np.uint8)
        for i, b in enumerate(bounds):
            made[:, i] = np.searchsorted(b, rows[:, i], "left")
        ends = np.arange(len(rows) + 1, dtype=np.int32) * len(bounds)
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(made)])

    return F.arrow_udf(coded, "binary")(values(df, list(edges)))


def _rows_of(x: pa.Array, width: int) -> np.ndarray:
    """Arrays of doubles as the rows of a matrix."""
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width)


def _bytes_of(x: pa.Array, width: int) -> np.ndarray:
    """Codes as the rows of a matrix."""
    flat = np.frombuffer(b"".join(x.to_pylist()) if x.offset else x.buffers()[2] or b"", np.uint8)
    return flat[: len(x) * width].reshape(len(x), width)


def values(df: DataFrame, features: Sequence[str]) -> Column:
    """Array of the features as doubles, missing and non-finite ones as 0."""
    return F.array(*[finite_or_zero(number_of(df, n)) for n in features])


# -- walking a tree --------------------------------------------------------------


class Walk(NamedTuple):
    """Constant arrays by which rows go from node to node; a leaf leads to itself."""

    asked: np.ndarray
    limits: np.ndarray
    lefts: np.ndarray
    rights: np.ndarray
    depth: int


def walk_of(nodes: Sequence[Node], cuts: str) -> Walk:
    """``cuts`` names what a row's value of a feature is compared with: code or threshold."""
    leaf = [n.feature is None for n in nodes]
    return Walk(
        np.array([0 if end else n.feature for n, end in zip(nodes, leaf)], np.int64),
        np.array([0 if end else getattr(n, cuts) for n, end in zip(nodes, leaf)], np.float64),
        np.array([i if end else n.left for i, (n, end) in enumerate(zip(nodes, leaf))], np.int64),
        np.array([i if end else n.right for i, (n, end) in enumerate(zip(nodes, leaf))], np.int64),
        max(n.depth for n in nodes),
    )


def leaves_of(walk: Walk, x: np.ndarray) -> np.ndarray:
    """The number of the node that each row of ``x`` ends in."""
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(walk.depth):
        at = np.where(x[rows, walk.asked[at]] <= walk.limits[at], walk.lefts[at], walk.rights[at])
    return at


def predict(df: DataFrame, tree: FittedTree, name: str = "prediction") -> DataFrame:
    """Adds the predicted class as an integer column; ``df`` has the features as columns."""
    ship(df.sparkSession)
    classes, width = np.array([n.prediction for n in tree.nodes], np.int32), len(tree.features)
    if not tree.depth:
        return df.withColumn(name, F.lit(int(classes[0])))
    walk = walk_of(tree.nodes, "threshold")

    def predicted(x: pa.Array) -> pa.Array:
        return pa.array(classes[leaves_of(walk, _rows_of(x, width))])

    return df.withColumn(name, F.arrow_udf(predicted, "int")(values(df, tree.features)))


# -- growing -------------------------------------------------------------------------


def impurity_of(kind: str, zeros: Column, ones: Column) -> Column:
    """Impurity of a node with so many rows (doubles) of each class."""
    both = zeros + ones
    p, q = F.try_divide(zeros, both), F.try_divide(ones, both)
    if kind == "gini":
        return F.coalesce(1.0 - p * p - q * q, F.lit(0.0))
    if kind == "entropy":
        share = lambda s: F.when(s > 0, -s * F.log2(s)).otherwise(0.0)
        return share(p) + share(q)
    raise ValueError(f"unknown impurity {kind!r}")


def _best_cuts(counts: DataFrame, specs: Sequence[TreeSpec]) -> DataFrame:
    """For each tree and node the cut that gains most, with the rows it sends left."""
    by_feature = Window.partitionBy("tree", "node", "f")
    running = by_feature.orderBy("code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counts.select(
        "tree", "node", "f", "code",
        *[F.sum(n).over(running).cast("double").alias(f"left_{n}") for n in ("zeros", "ones")],
        *[F.sum(n).over(by_feature).cast("double").alias(f"all_{n}") for n in ("zeros", "ones")],
    )
    a, b, t0, t1 = (F.col(n) for n in ("left_zeros", "left_ones", "all_zeros", "all_ones"))
    gain = None
    for i, spec in enumerate(specs):
        lost = (a + b) / (t0 + t1) * impurity_of(spec.impurity, a, b)
        lost = lost + (t0 + t1 - a - b) / (t0 + t1) * impurity_of(spec.impurity, t0 - a, t1 - b)
        mine = impurity_of(spec.impurity, t0, t1) - lost
        gain = (F if gain is None else gain).when(F.col("tree") == i, mine)
    real = sums.where(a + b < t0 + t1).withColumn("gain", gain).where(F.col("gain") > LEAST_GAIN)
    order = Window.partitionBy("tree", "node").orderBy(F.desc(F.round("gain", TIE_DIGITS)), "f", "code")
    return real.withColumn("place", F.row_number().over(order)).where("place = 1")


def fit_trees(
    train: DataFrame,
    features: Sequence[str],
    specs: Sequence[TreeSpec],
    label: str = "label",
    edges: Mapping[str, Sequence[float]] | None = None,
) -> tuple[FittedTree, ...]:
    """Grows all trees together, one pass over the coded rows a level.

    The same rows give the same nodes for every partitioning and order: counts decide,
    equal gains (to 12 digits) take the first feature and the lowest cut. A node is a leaf
    at the tree's depth, if its rows are of one class, or if no cut gains.
    """
    ship(train.sparkSession)
    edges = {n: tuple(e) for n, e in (edges or bin_edges(train, features)).items()}
    rows = train.select(codes(train, edges).alias("codes"), col(label).cast("int").alias("label"))
    shape = (len(edges), max(map(len, edges.values()), default=0) + 1)
    cores = train.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        # Few large files would leave cores idle at every level.
        rows = rows.repartition(cores)
    rows = cut_lineage(rows)
    total = rows.agg(F.count_if(F.col("label") == 0).alias("zeros"), F.count_if(F.col("label") == 1).alias("ones")).first()
    grown = [[Node(0, total["zeros"], total["ones"])] for _ in specs]
    counts = None
    parents: list[list[int]] = [[] for _ in specs]  # nodes of the last level that were cut
    for level in range(max((s.depth for s in specs), default=0)):
        counts = cut_lineage(_level_counts(rows, shape, grown, specs, level, counts, parents))
        parents = [[] for _ in specs]
        for cut in _best_cuts(counts, specs).collect():
            nodes, number = grown[cut["tree"]], cut["node"]
            old = nodes[number]
            zeros, ones = int(cut["left_zeros"]), int(cut["left_ones"])
            left = len(nodes)
            nodes += [Node(level + 1, zeros, ones), Node(level + 1, old.zeros - zeros, old.ones - ones)]
            nodes[number] = replace(
                old, feature=cut["f"], code=cut["code"], gain=cut["gain"], left=left, right=left + 1,
                threshold=edges[features[cut["f"]]][cut["code"]],
            )
            parents[cut["tree"]].append(number)
        if not any(parents):
            break
    return tuple(FittedTree(s, tuple(features), _numbered(nodes)) for s, nodes in zip(specs, grown))


def _level_counts(
    rows: DataFrame,
    shape: tuple[int, int],
    grown: Sequence[Sequence[Node]],
    specs: Sequence[TreeSpec],
    level: int,
    before: DataFrame | None,
    parents: Sequence[Sequence[int]],
) -> DataFrame:
    """Rows of both classes by tree, node, feature and code, for the nodes that may be cut at this level."""
    if before is None:
        open_trees = [i for i, s in enumerate(specs) if s.depth > 0 and grown[i][0].zeros and grown[i][0].ones]
        whole = _counted(rows, shape, [(0, walk_of([Node(0, 0, 0)], "code"), np.array([0]))])
        trees = F.explode(F.lit(open_trees).cast("array<int>"))
        return whole.select(trees.alias("tree"), "node", "f", "code", "zeros", "ones")
    counted, larger = [], []
    parts = []
    for i, (spec, nodes) in enumerate(zip(specs, grown)):
        chosen = []
        for p in parents[i] if level < spec.depth else []:
            pair = sorted((nodes[p].left, nodes[p].right), key=lambda n: (nodes[n].zeros + nodes[n].ones, n))
            mixed = [n for n in pair if nodes[n].zeros and nodes[n].ones]
            if mixed:
                chosen.append(pair[0])
                counted.append((i, pair[0], pair[0] in mixed))
                larger.append((i, p, pair[0], pair[1], pair[1] in mixed))
        if chosen:
            parts.append((i, walk_of(nodes, "code"), np.array(chosen)))
    if not parts:
        return before.limit(0)
    spark = rows.sparkSession
    smaller = cut_lineage(_counted(rows, shape, parts))
    # One row for each cut of the last level.
    flagged = F.broadcast(spark.createDataFrame(counted, "tree int, node int, open boolean").where("open").drop("open"))
    pairs = spark.createDataFrame(larger, "tree int, parent int, small int, large int, open boolean")
    pairs = F.broadcast(pairs.where("open").drop("open"))
    own = smaller.join(flagged, ["tree", "node"])
    plus = before.withColumnRenamed("node", "parent").join(pairs, ["tree", "parent"])
    minus = smaller.withColumnRenamed("node", "small").join(pairs, ["tree", "small"])
    names = ("tree", F.col("large").alias("node"), "f", "code")
    rest = plus.select(*names, "zeros", "ones").unionByName(
        minus.select(*names, (-F.col("zeros")).alias("zeros"), (-F.col("ones")).alias("ones"))
    )
    rest = rest.groupBy("tree", "node", "f", "code").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    return own.unionByName(rest.where("zeros + ones > 0"))


COUNTS = "tree int, node int, f int, code int, zeros bigint, ones bigint"


def _counted(rows: DataFrame, shape: tuple[int, int], parts: Sequence[tuple[int, Walk, np.ndarray]]) -> DataFrame:
    """Rows of both classes by tree, node, feature and code, for each tree's chosen nodes.

    A partition adds its rows up in an array of the chosen nodes' counts, whatever the number of rows.
    """
    width, bins = shape
    names = [part.split()[0] for part in COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(len(chosen) * width * bins * 2, np.int64) for _, _, chosen in parts]
        features = np.arange(width)
        for batch in batches:
            label = batch.column("label").fill_null(-1).to_numpy(zero_copy_only=False)
            x = _bytes_of(batch.column("codes"), width)
            known = (label == 0) | (label == 1)
            for (_, walk, chosen), total in zip(parts, totals):
                slots = np.full(len(walk.lefts), -1)
                slots[chosen] = np.arange(len(chosen))
                slot = slots[leaves_of(walk, x)]
                here = np.flatnonzero(known & (slot >= 0))
                cells = ((slot[here, None] * width + features) * bins + x[here]) * 2 + label[here, None]
                total += np.bincount(cells.ravel(), minlength=len(total))
        for (tree, _, chosen), total in zip(parts, totals):
            pairs = total.reshape(-1, 2)
            at = np.flatnonzero(pairs.sum(axis=1))
            node, f, code = np.unravel_index(at, (len(chosen), width, bins))
            found = [np.full(len(at), tree, np.int32), *(n.astype(np.int32) for n in (chosen[node], f, code)), pairs[at, 0], pairs[at, 1]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), names)

    sums = [F.sum(n).alias(n) for n in ("zeros", "ones")]
    if not width:
        return rows.sparkSession.createDataFrame([], COUNTS)
    return rows.select("codes", "label").mapInArrow(run, COUNTS).groupBy("tree", "node", "f", "code").agg(*sums)


def _numbered(nodes: Sequence[Node]) -> tuple[Node, ...]:
    """The nodes in the order of a walk from the root, left before right."""
    order: list[int] = []
    waiting = [0]
    while waiting:
        number = waiting.pop()
        order.append(number)
        if nodes[number].feature is not None:
            waiting += [nodes[number].right, nodes[number].left]
    place = {old: new for new, old in enumerate(order)}
    return tuple(
        nodes[o] if nodes[o].feature is None else replace(nodes[o], left=place[nodes[o].left], right=place[nodes[o].right])
        for o in order
    )


# -- importances -------------------------------------------------------------------------


def impurity_importance(spark: SparkSession, tree: FittedTree) -> DataFrame:
    """Gain of each feature's cuts, weighted by the rows of their nodes; all add up to 1, highest first."""
    names = spark.createDataFrame(list(enumerate(tree.features)), "position int, feature string")
    weights = tree_nodes(spark, tree).where("feature is not null").select("feature", (F.col("rows") * F.col("gain")).alias("w"))
    sums = weights.groupBy("feature").agg(F.sum("w").alias("w"))
    total = sums.agg(F.sum("w").alias("total"))
    shared = sums.crossJoin(F.broadcast(total)).select("feature", (F.col("w") / F.col("total")).alias("share"))
    table = names.join(shared, "feature", "left")
    return sorted_importance(table.select("feature", F.coalesce("share", F.lit(0.0)).alias("importance")))


def sorted_importance(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("importance"), F.asc("feature"))


def path_masks(tree: FittedTree) -> list[list[int]]:
    """For each node the numbers of the features asked for on the way to it."""
    asked: list[list[int]] = [[] for _ in tree.nodes]
    for number, node in enumerate(tree.nodes):
        if node.feature is not None:
            mine = sorted({*asked[number], node.feature})
            asked[node.left], asked[node.right] = mine, mine
    return asked


def permutation_importance(
    test: DataFrame,
    tree: FittedTree,
    key: str,
    label: str = "label",
    repeats: int = 5,
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Mean loss of accuracy on ``test`` when one feature is permuted.

    Rows are dealt by a digest of their key into random buckets of bounded size and
    brought into its order there; in repeat r each row takes the feature of the row r
    places on, around the end of the bucket. Every value is used once per repeat, by
    another row. One shuffle serves all features and repeats; a task holds one bucket. A
    row's leaf tells which features its path asks for: only these are swapped and the row
    scored again, as no other one can change its prediction.
    """
    rows, spark = test.count(), test.sparkSession
    ship(spark)
    names = spark.createDataFrame(list(enumerate(tree.features)), "position int, feature string")
    used = sorted({n.feature for n in tree.nodes if n.feature is not None})
    if not used or not rows:
        return sorted_importance(names.select("feature", F.lit(0.0).alias("importance")))

    # Only the row count decides, so the result is the same on any cluster.
    buckets = max(math.ceil(rows / bucket_rows), 1)
    digest = F.md5(F.concat_ws(":", col(key), F.lit(seed)))
    placed = test.select(digest.alias("digest"), col(label).cast("int").alias("label"), values(test, tree.features).alias("x"))
    placed = placed.withColumn("bucket", F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint") % buckets)
    walk, classes, width = walk_of(tree.nodes, "threshold"), np.array([n.prediction for n in tree.nodes]), len(tree.features)
    asked = np.zeros((len(tree.nodes), width), bool)
    for number, mine in enumerate(path_masks(tree)):
        asked[number, mine] = True

    def permuted(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by("digest").combine_chunks()
        x = _rows_of(pa.concat_arrays(bucket.column("x").chunks), width)
        real = bucket.column("label").fill_null(-1).to_numpy()
        leaves = leaves_of(walk, x)
        hit = classes[leaves] == real
        lost = []
        for f in used:
            at = np.flatnonzero(asked[leaves, f] & (real >= 0))
            mixed = x[at]
            lost.append(repeats * int(hit[at].sum()))
            for r in range(1, repeats + 1):
                mixed[:, f] = x[(at + r) % len(x), f]
                lost[-1] -= int((classes[leaves_of(walk, mixed)] == real[at]).sum())
        return pa.table({"position": pa.array(used, pa.int32()), "lost": pa.array(lost, pa.int64())})

    losses = placed.groupBy("bucket").applyInArrow(permuted, "position int, lost bigint")
    losses = losses.groupBy("position").agg((F.sum("lost") / F.lit(float(rows) * repeats)).alias("loss"))
    table = names.join(losses, "position", "left")
    return sorted_importance(table.select("feature", F.coalesce("loss", F.lit(0.0)).alias("importance")))


# -- structure -----------------------------------------------------------------------------

NODES = (
    "node bigint, depth bigint, feature string, threshold double, left_node bigint, right_node bigint, "
    "zeros bigint, ones bigint, rows bigint, impurity double, gain double, prediction int"
)


def tree_nodes(spark: SparkSession, tree: FittedTree) -> DataFrame:
    """Nodes of the fitted tree as rows, numbered from the root, left before right."""
    rows = [
        (
            i, n.depth, None if n.feature is None else tree.features[n.feature], n.threshold, n.left, n.right,
            n.zeros, n.ones, n.zeros + n.ones, None, n.gain, n.prediction,
        )
        for i, n in enumerate(tree.nodes)
    ]
    zeros, ones = F.col("zeros").cast("double"), F.col("ones").cast("double")
    return spark.createDataFrame(rows, NODES).withColumn("impurity", impurity_of(tree.spec.impurity, zeros, ones))


RULES = (
    "leaf bigint, feature string, above double, up_to double, rows bigint, prediction int"
)


def leaf_rules(spark: SparkSession, tree: FittedTree) -> DataFrame:
    """The tree as rules: for each leaf and feature asked on its path, the interval (above, up_to] that leads there."""
    found: list[tuple] = []
    waiting = [(0, {})]
    while waiting:
        number, ranges = waiting.pop()
        node = tree.nodes[number]
        if node.feature is None:
            found += [
                (number, tree.features[f], low, high, node.zeros + node.ones, node.prediction)
                for f, (low, high) in sorted(ranges.items())
            ]
            continue
        low, high = ranges.get(node.feature, (None, None))
        waiting.append((node.right, {**ranges, node.feature: (node.threshold, high)}))
        waiting.append((node.left, {**ranges, node.feature: (low, node.threshold)}))
    return spark.createDataFrame(found, RULES)


def model_summary(
    df: DataFrame, tree: FittedTree, gap: DataFrame, importances: DataFrame
) -> DataFrame:
    """One row per model: rule, depth, features, importances, both accuracies.

    ``gap`` is the train/test table of ``evaluate.overfit_gap``; importances
    are at most one row per feature.
    """
    listed = importances.agg(
        F.to_json(
            F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False)
        ).alias("feature_importances")
    ).first()["feature_importances"]
    rows = df.groupBy("split").agg(F.count("*").alias("n")).collect()
    sizes = {r["split"]: r["n"] for r in rows}
    return gap.filter(F.col("model") == tree.spec.name).select(
        F.lit("DecisionTreeClassifier").alias("modelo"),
        "model",
        F.lit(tree.spec.impurity).alias("criterion"),
        F.lit(tree.spec.depth).alias("max_depth"),
        F.array(*[F.lit(f) for f in tree.features]).alias("features"),
        F.lit(listed).alias("feature_importances"),
        *[F.round(c, 4).alias(c) for c in ("acuracia_treino", "f1_treino", "acuracia_teste", "f1_teste")],
        F.lit(sizes.get("train", 0)).cast("bigint").alias("n_treino"),
        F.lit(sizes.get("test", 0)).cast("bigint").alias("n_teste"),
    )


def save_model(spark: SparkSession, tree: FittedTree, folder: str) -> str:
    """The node table as Parquet, with the cuts' codes and the model's name, rule and depth on every row."""
    codes_ = spark.createDataFrame([(i, n.feature, n.code) for i, n in enumerate(tree.nodes)], "node bigint, position int, code int")
    spec = tree.spec
    table = tree_nodes(spark, tree).join(F.broadcast(codes_), "node").withColumns(
        {"model": F.lit(spec.name), "criterion": F.lit(spec.impurity), "max_depth": F.lit(spec.depth),
         "features": F.array(*[F.lit(f) for f in tree.features]).cast("array<string>")}
    )
    table.coalesce(1).write.mode("overwrite").parquet(folder)
    return folder


def load_model(spark: SparkSession, folder: str) -> FittedTree:
    rows = spark.read.parquet(folder).orderBy("node").collect()
    nodes = tuple(
        Node(r["depth"], r["zeros"], r["ones"], r["position"], r["code"], r["threshold"], r["gain"], r["left_node"], r["right_node"])
        for r in rows
    )
    first = rows[0]
    return FittedTree(TreeSpec(first["model"], first["criterion"], first["max_depth"]), tuple(first["features"]), nodes)
