"""SimHash near-duplicates with covering locality-sensitive hashing.

A fingerprint bit is set if it is set in over half of the hashes of the text's
three-word shingles. Each of the 64 bits is given a vector of r + 1 bits; each
nonzero vector v of that length is a mask of the bits whose vector has an odd
product with v. Two fingerprints that differ in at most r bits give at most r
vectors, so some v has an even product with all of them: under its mask the two
are equal. Every pair within the radius therefore meets in one of the
2^(r+1) - 2 tables, whose masks have half of the bits each.

Buckets hold distinct fingerprints. Of two, the pair is tested in the grouped
aggregate; larger ones are compared in a task in blocks, which returns the edges
of a spanning forest of the links, never all pairs. A bucket above ``widest`` is
dealt to finer tables by covering the bits its mask has left open, again and
again: after each level about half of the open bits are left, and with f open bits a
bucket cannot hold more than 2^f distinct fingerprints, so this ends.

``representatives`` keeps one row of each group of texts whose five-word shingle sets have
a Jaccard similarity of 0.8 or more. Covering tables over the fingerprints of distinct words
find the near copies first; an exact join of rare shingles then finds the pairs that differ
in more bits, so that none is missed. A pair is refused by what bit sketches of the two sets
leave possible before any whole set is read, and linked only if the whole sets are similar.

Defined results: NULL and empty texts and texts of spaces have fingerprint zero
and are linked like any other; fewer than three words are one shingle; rows with
the same fingerprint are one class; NULL doc_ids join their class and component,
whose id is the smallest other doc_id (NULL if there is none); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import text_slices, texts_of
from lamina.llm.components import connected_components
from lamina.session import BROADCAST_ROWS, cut_lineage, few_tasks

BITS = 64
SEED = 42
WIDEST = 2048

# ---- fingerprints ------------------------------------------------------------

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str, words_each: int) -> np.ndarray:
    import xxhash

    # bytes.split() splits at exactly the six characters the words exclude.
    words = text.encode().translate(ASCII_LOWER).split()
    digest = xxhash.xxh64_intdigest
    if len(words) <= words_each:
        return np.array([digest(b" ".join(words), SEED)] if words else [], np.uint64)
    shifted = [words[i : len(words) - words_each + 1 + i] for i in range(words_each)]
    shingles = map(b" ".join, zip(*shifted))
    count = len(words) - words_each + 1
    return np.fromiter((digest(one, SEED) for one in shingles), np.uint64, count)


def majority_bits(hashes: np.ndarray, step: int = 1 << 15) -> int:
    """The number whose bits are set in over half of ``hashes``."""
    if not len(hashes):
        return 0
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), step):
        part = np.ascontiguousarray(hashes[start : start + step]).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * votes > len(hashes)).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprint(text: str, words_each: int, distinct: bool) -> int:
    hashes = shingle_hashes(text, words_each)
    return majority_bits(np.unique(hashes) if distinct else hashes)


def fingerprints(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    words_each: int = 3,
    distinct: bool = False,
) -> DataFrame:
    """``keep`` and the 64-bit fingerprint (as a signed long) of each row; no shuffle.

    With ``distinct``, a shingle that repeats in a text counts once.
    """
    kinds = dict(docs.dtypes)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                prints = [fingerprint(one, words_each, distinct) for one in texts_of(part, "_text")]
                column = pa.array(np.array(prints, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], [*names, "fp"])

    rows = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], F.col(text).alias("_text"))
    schema = ", ".join([*(f"{n} {kinds[k]}" for k, n in zip(keep, names)), "fp long"])
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))


# ---- covering tables -----------------------------------------------------------


def covering_masks(open_bits: list[int], radius: int) -> list[int]:
    """Masks over ``open_bits``: any ``radius`` of these bits are all outside of some mask.

    The bits' vectors end in a one, so a mask has half of the bits if they are dealt
    evenly; zero and the unit vectors come first, so no mask is empty even if the
    bits are few. The vector that stands for that one alone would demand equality
    of all bits and is left out.
    """
    top = 1 << radius
    units = [1 << i for i in range(radius)]
    order = [0, *units, *(x for x in range(1, top) if x not in units)]
    given = {bit: top | order[place % top] for place, bit in enumerate(open_bits)}
    return [
        sum(1 << bit for bit, vector in given.items() if (vector & v).bit_count() & 1)
        for v in range(1, 2 * top)
        if v != top
    ]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _tables(prints: DataFrame, masks: list[int]) -> DataFrame:
    """One row of each print for each mask: the mask's bits that count so far, and the print under them."""
    pairs = F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(_signed(m)).alias("part")) for m in masks])
    return prints.select("fp", F.explode(pairs).alias("t")).select("t.mask", "t.part", "fp")


def _finer(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Rows of too large buckets, dealt to the tables that cover the bits their mask leaves open."""
    choice = None
    for mask in sorted(set(masks)):
        left = [bit for bit in range(BITS) if not mask >> bit & 1]
        more = F.array(*[F.lit(_signed(mask | m)) for m in covering_masks(left, radius)])
        choice = (F if choice is None else choice).when(F.col("mask") == _signed(mask), more)
    dealt = rows.select("fp", F.explode(choice).alias("mask"))
    return dealt.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp").distinct()


def distance(one: Column, other: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(other))


def forest(prints: np.ndarray, radius: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among ``prints``; memory is one block of rows."""
    n = len(prints)
    root = np.arange(n)
    edges: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    for start in range(0, n, block):
        some = prints[start : start + block]
        near = np.bitwise_count(some[:, None] ^ prints[None, :]) <= radius
        for place in range(len(some)):
            i = start + place
            others = np.flatnonzero(near[place, i + 1 :]) + i + 1
            # Most of a dense group is joined already: look at one member of each tree only.
            for j in others[np.unique(root[others], return_index=True)[1]].tolist() if len(others) else ():
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    edges.append((i, j))
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    return prints[pairs[:, 0]], prints[pairs[:, 1]]


def _forests(buckets: DataFrame, radius: int) -> DataFrame:
    """Links of buckets given as arrays, as the edges of their forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column("prints"):
                a, b = forest(one.values.to_numpy().view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return buckets.select("prints").mapInArrow(run, "a long, b long")


def links(prints: DataFrame, radius: int = 3, widest: int = WIDEST) -> DataFrame:
    """Links between distinct prints (column ``fp``) that connect all that are within ``radius``.

    A link joins two prints within the radius; links that add nothing to a
    bucket's connection are left out.
    """
    masks = covering_masks(list(range(BITS)), radius)
    # A print becomes a row of every table: spread by number, as bytes before that would put them in few tasks.
    spread = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _tables(prints.repartition(spread, F.xxhash64("fp")), masks)
    found = None
    level = 0
    while True:
        level += 1
        sizes = rows.groupBy("mask", "part").agg(
            F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
        )
        sizes = cut_lineage(sizes.where("n > 1"))
        pairs = sizes.where("n = 2").where(distance(F.col("a"), F.col("b")) <= radius).select("a", "b")
        middle = sizes.where((F.col("n") > 2) & (F.col("n") <= widest)).select("mask", "part")
        buckets = (
            rows.join(middle, ["mask", "part"]).groupBy("mask", "part").agg(F.collect_list("fp").alias("prints"))
        )
        new = pairs.union(_forests(buckets, radius))
        found = new if found is None else found.union(new)
        over = sizes.where(F.col("n") > widest).select("mask", "part")
        wide = [row["mask"] & (1 << 64) - 1 for row in over.select("mask").distinct().collect()]
        if not wide:
            return found.distinct()
        rows = cut_lineage(_finer(rows.join(over, ["mask", "part"]), wide, radius))


# ---- the operator -----------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    radius: int = 3,
    words_each: int = 3,
    widest: int = WIDEST,
    keep: tuple[str, ...] = (),
    distinct: bool = False,
) -> DataFrame:
    """``id``, ``keep``, fp and component_id: smallest id reachable by links of at most ``radius`` bits."""
    columns = tuple(dict.fromkeys((id, *keep)))
    rows = cut_lineage(fingerprints(docs, text, columns, words_each, distinct))
    classes = rows.groupBy("fp").agg(F.min(id).alias("_least"))
    found = connected_components(links(classes.select("fp"), radius, widest), "a", "b")
    grouped = classes.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(*columns, "fp", "component_id")


# ---- one of each group, by whole texts ----------------------------------------------

SIMILARITY = 0.8
SHINGLE = 5
# Share of the rows whose shingles are counted to put common ones last, and how many of these rows
# make one common: as a share, so that buckets of the others stay as small on a large table.
COUNTED_SHARE = 1 / 8
COMMON = 6
MOST_COMMON = 400_000
# In so many rounds (STARS) members of a bucket are compared with one of them, chosen by one of so many orders.
ORDERS = 4
STARS = 1
# In so many rounds each component is compared with another one by its most promising pair.
PICKS = 2
# Bits in which the fingerprints of distinct words may differ for the covering tables to pair them.
RADIUS = 3


def shingle_set(text: str, words_each: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes in ascending order."""
    return np.unique(shingle_hashes(text, words_each))


def _set_key(shingles: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(shingles.tobytes(), SEED) if len(shingles) else 0


def _least_shared(size: int, similarity: float) -> int:
    """Shingles a set shares at least with any set of that Jaccard similarity."""
    return math.ceil(similarity * size - 1e-9)


def _longs(numbers: Iterable) -> pa.Array:
    return pa.array(np.fromiter(numbers, np.uint64).view(np.int64))


def _list_of_longs(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.array([], np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _sets_of(rows: DataFrame, words_each: int) -> DataFrame:
    """set_key and its shingles for rows of one column ``_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                sets = [shingle_set(one, words_each) for one in texts_of(part, "_text")]
                yield pa.RecordBatch.from_arrays([_longs(map(_set_key, sets)), _list_of_longs(sets)], ["set_key", "shingles"])

    return rows.select("_text").mapInArrow(run, "set_key long, shingles array<long>")


def common_shingles(docs: DataFrame, text: str, words_each: int) -> np.ndarray:
    """Shingles of many rows, the commonest last, by a fixed share of the texts, chosen by hash; at most ``MOST_COMMON``."""
    rows = docs.select(F.col(text).alias("_text")).where(F.pmod(F.xxhash64("_text"), F.lit(1 << 30)) < int(COUNTED_SHARE * (1 << 30)))
    sets = _sets_of(rows, words_each).dropDuplicates(["set_key"])
    counted = sets.select(F.explode("shingles").alias("one")).groupBy("one").count().where(F.col("count") >= COMMON)
    most = counted.orderBy(F.desc("count"), "one").limit(MOST_COMMON).collect()
    return np.array([row["one"] for row in reversed(most)], np.int64).view(np.uint64)


SKETCH_LEAST, SKETCH_MOST = 256, 1 << 15
# A row with a sketch or a whole set counts as so many when it is decided how many tasks they need.
WIDE = 16
# Bits of the marks by which pairs are refused in the join, and of the marks folded for its first pass.
MARKS, FOLDED = 1024, 256


def _bits(shingles: np.ndarray, width: int) -> np.ndarray:
    """Bits of the shingles' low digits, packed."""
    marked = np.zeros(width, np.uint8)
    marked[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(marked, bitorder="little")


def sketch(shingles: np.ndarray) -> bytes:
    """Bits of the shingles' low digits, two for each shingle at least unless there are very many."""
    bits = SKETCH_LEAST
    while bits < 2 * len(shingles) and bits < SKETCH_MOST:
        bits *= 2
    return _bits(shingles, bits).tobytes()


def marks(shingles: np.ndarray) -> list[int]:
    """Bits of a fixed number as whole numbers of 64."""
    return _bits(shingles, MARKS).view(np.int64).tolist()


def _folded(marks: str) -> Column:
    """The marks as if made with ``FOLDED`` bits."""
    parts = FOLDED // 64
    return F.array(*[reduce(Column.bitwiseOR, [F.col(marks)[i] for i in range(j, MARKS // 64, parts)]) for j in range(parts)])


def _only(one: str, other: str, bits: int) -> Column:
    """Bits that only the marks of ``one`` have; each costs its set a shingle of those it can share."""
    return reduce(add, [F.bit_count(F.col(one)[i].bitwiseAND(F.bitwise_not(F.col(other)[i]))) for i in range(bits // 64)])


def most_shared(one: bytes, size: int, other: bytes, other_size: int) -> int:
    """Upper bound of the shingles two sets share: a bit that only one has costs it a shingle."""
    a, b = (np.frombuffer(x, np.uint8) for x in (one, other))
    width = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, width), axis=0) for x in (a, b))
    only = lambda x, y: int(np.bitwise_count(x & ~y).sum())
    return min(size - only(a, b), other_size - only(b, a))


def _prefixes(docs: DataFrame, text: str, keep: dict[str, Column], similarity: float, words_each: int) -> DataFrame:
    """``keep``, set_key, size, sketch, fp, and the shingles of which similar sets share one.

    In any order of all shingles, sets that share ``need`` of ``n`` have one in common
    among the first n - need + 1 of each. Common ones are last here, so they are seldom
    among these; the order decides the work, never the result. ``fp`` is the fingerprint of
    the distinct words.
    """
    common = common_shingles(docs, text, words_each)
    order = np.argsort(common)
    names = [*keep, "set_key", "size", "sketch", "marks", "fp", "prefix"]

    def prefix(shingles: np.ndarray) -> np.ndarray:
        count = len(shingles) - _least_shared(len(shingles), similarity) + 1 if len(shingles) else 0
        if not len(common):
            return shingles[:count]
        at = np.minimum(np.searchsorted(common, shingles, sorter=order), len(common) - 1)
        place = np.where(common[order[at]] == shingles, order[at] + 1, 0)
        return shingles[np.argsort(place, kind="stable")[:count]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                texts = texts_of(part, "_text")
                sets = [shingle_set(one, words_each) for one in texts]
                made = [
                    _longs(map(_set_key, sets)), pa.array(list(map(len, sets)), pa.int32()), pa.array([sketch(one) for one in sets], pa.binary()),
                    pa.array([marks(one) for one in sets], pa.list_(pa.int64())),
                    _longs(fingerprint(one, 1, True) for one in texts), _list_of_longs([prefix(one) for one in sets]),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names)

    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).alias("_text"))
    kinds = dict(rows.dtypes)
    schema = [f"{n} {kinds[n]}" for n in keep] + ["set_key long", "size int", "sketch binary", "marks array<long>", "fp long", "prefix array<long>"]
    return rows.mapInArrow(run, ", ".join(schema))


def _possible(pairs: DataFrame, rows: int, some: DataFrame, similarity: float) -> DataFrame:
    """Of at most ``rows`` pairs (a, b) those whose sketches leave room for the similarity."""
    one = some.select(F.col("set_key").alias("a"), F.col("size").alias("m"), F.col("sketch").alias("s"))
    other = some.select(F.col("set_key").alias("b"), F.col("size").alias("n"), F.col("sketch").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n, s, t = (batch.column(c).to_pylist() for c in ("m", "n", "s", "t"))
            fits = [
                most_shared(x, k, y, l) >= similarity / (1 + similarity) * (k + l) - 1e-9 for x, k, y, l in zip(s, m, t, n)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    both = few_tasks(few_tasks(pairs.join(one, "a"), WIDE * rows).join(other, "b"), WIDE * rows)
    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, rows: int, sets: DataFrame, similarity: float) -> DataFrame:
    """Of at most ``rows`` pairs of set keys (a, b) those whose whole sets are similar."""
    one = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("other"))
    both = few_tasks(few_tasks(pairs.join(one, "a"), WIDE * rows).join(other, "b"), WIDE * rows)
    shared = F.size(F.array_intersect("one", "other"))
    total = F.size("one") + F.size("other") - shared
    return cut_lineage(both.where(shared >= similarity * total - 1e-9).select("a", "b"))


def _near_copies(classes: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of set keys by the covering tables; sets of one fingerprint are paired with the least of them."""
    prints = classes.groupBy("fp").agg(F.min("set_key").alias("least"))
    same = classes.join(prints, "fp").where("set_key <> least").select(F.col("set_key").alias("a"), F.col("least").alias("b"))
    found = links(prints.select("fp"), radius)
    named = prints.select(F.col("fp").alias("a"), F.col("least").alias("x"))
    other = prints.select(F.col("fp").alias("b"), F.col("least").alias("y"))
    return same.union(found.join(named, "a").join(other, "b").select("x", "y"))


def similar_sets(
    classes: DataFrame, texts: DataFrame, similarity: float, words_each: int, stars: int = STARS, picks: int = PICKS
) -> DataFrame:
    """set_key and root of each set that another one is similar to, directly or through others.

    ``classes`` has one row for each set: set_key, _key, size, sketch, marks, fp and prefix; ``texts`` has
    _text by _key. Pairs of the covering tables are looked at first. Then sets that
    share a shingle of their prefixes are candidates: in ``stars`` rounds each set is compared with
    one other only. Pairs that are not connected yet and can share enough after the first shingle they share,
    and by bits of their sets, come next: in ``picks`` rounds the most promising one of each component, then all
    that are still not connected. So groups of copies cost little more than their rows, and no pair is left
    out but those that are connected.
    """
    rows = classes.select("set_key", "size", F.posexplode("prefix").alias("pos", "one"))
    buckets = cut_lineage(rows.groupBy("one").count().where("count > 1").select("one"))
    shared = rows.join(F.broadcast(buckets) if buckets.count() <= BROADCAST_ROWS else buckets, "one", "left_semi")
    shared = cut_lineage(shared.withColumn("root", F.col("set_key")))

    def near(one: str, other: str) -> Column:
        return F.least(one, other) >= similarity * F.greatest(one, other) - 1e-9

    # Past the end of the shorter prefix at most need - 1 shingles of its set are left to share.
    enough = F.ceil(similarity / (1 + similarity) * (F.col("size") + F.col("size_b")) - 1e-9)
    least = enough - F.ceil(similarity * F.greatest("size", "size_b") - 1e-9) + 1
    found = None

    def verified(pairs: DataFrame) -> DataFrame:
        """The similar ones; texts of sets in no possible pair are not read as sets."""
        pairs = cut_lineage(pairs.select("a", "b"))
        count = pairs.count()
        pairs = few_tasks(pairs, count)

        def of_pairs(table: DataFrame, pairs: DataFrame) -> DataFrame:
            named = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b"))
            return table.join(F.broadcast(named) if 2 * count <= BROADCAST_ROWS else named, "set_key", "left_semi")

        some = cut_lineage(of_pairs(classes.select("set_key", "size", "sketch", "_key"), pairs))
        some = few_tasks(some, 2 * count)
        pairs = cut_lineage(_possible(pairs, count, some, similarity))
        wanted = of_pairs(some.select("set_key", "_key"), pairs).select("_key")
        some = texts.join(F.broadcast(wanted) if 2 * count <= BROADCAST_ROWS else wanted, "_key", "left_semi")
        return _verified(pairs, count, cut_lineage(_sets_of(some.dropDuplicates(["_key"]), words_each)), similarity)

    def connected(new: DataFrame) -> DataFrame:
        nonlocal found
        found = new if found is None else found.union(new)
        return cut_lineage(connected_components(found, "a", "b")).withColumnRenamed("node", "set_key")

    def unsettled(rows: DataFrame, roots: DataFrame) -> DataFrame:
        """Rows with their roots, in buckets of more than one."""
        named = cut_lineage(rows.drop("root").join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key")))
        mixed = named.groupBy("one").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        return cut_lineage(named.join(mixed.select("one"), "one", "left_semi"))

    shared = unsettled(shared, connected(verified(_near_copies(classes, RADIUS))))
    slim = shared.columns
    for star in range(stars):
        rank = F.xxhash64("set_key", F.pmod("one", F.lit(ORDERS)), F.lit(star))
        if not star:
            # First with the member that meets most others: of changed copies of one text the least changed one.
            sizes = shared.groupBy("one").count()
            weights = shared.join(sizes, "one").groupBy("set_key").agg(F.sum("count").alias("weight"))
            shared = shared.join(weights, "set_key")
            rank = F.struct(-F.col("weight"), rank)
        centres = shared.groupBy("one").agg(F.min(F.struct(rank.alias("rank"), "set_key", "size", "root")).alias("c"))
        centres = centres.select("one", F.col("c.set_key").alias("b"), F.col("c.size").alias("size_b"), F.col("c.root").alias("root_b"))
        pairs = shared.join(centres, "one").where((F.col("root") != F.col("root_b")) & near("size", "size_b"))
        pairs = pairs.groupBy(F.col("set_key").alias("a"), "b", "size", "size_b").count().where(F.col("count") * ORDERS >= least)
        pairs = pairs.groupBy("a").agg(F.max(F.struct("count", "b"))["b"].alias("b"))
        shared = unsettled(shared.select(*slim), connected(verified(pairs)))
    # Only rows that are left now carry bits of their whole sets, by which the join itself refuses most pairs: first
    # few bits, which leave the rows that any other one may be similar to, then all marks of these.
    def marked(rows: DataFrame, marks: Column) -> DataFrame:
        return cut_lineage(rows.join(classes.select("set_key", marks.alias("marks")), "set_key"))

    def others(rows: DataFrame) -> DataFrame:
        return rows.withColumnsRenamed({"set_key": "b", "size": "size_b", "root": "root_b", "pos": "pos_b", "marks": "marks_b", "one": "one_b"})

    # If this is the first shingle two sets share, they share no more than what follows it in both. A similar
    # pair passes at its first one, so pairs of texts around one common passage need not be counted up.
    left = F.least(F.col("size") - F.col("pos"), F.col("size_b") - F.col("pos_b"))

    def room(bits: int) -> Column:
        return F.least(F.col("size") - _only("marks", "marks_b", bits), F.col("size_b") - _only("marks_b", "marks", bits))

    fits = (F.col("one") == F.col("one_b")) & (F.col("root") != F.col("root_b")) & near("size", "size_b") & (left >= enough)
    shared = marked(shared, _folded("marks"))
    shared = shared.join(others(shared), fits & (room(FOLDED) >= enough), "left_semi").drop("marks")
    shared = marked(shared, F.col("marks"))
    rest = shared.join(others(shared), fits & (F.col("set_key") < F.col("b")) & (room(MARKS) >= enough))
    rest = rest.withColumnRenamed("set_key", "a").withColumn("promise", room(MARKS) / enough)
    pairs = cut_lineage(rest.select("a", "b", "root", "root_b", "promise").distinct())
    # Components join through their best pair first, so that a group of copies is one before its other pairs are read.
    for _ in range(picks):
        if pairs.isEmpty():
            break
        pair = F.struct("promise", "a", "b").alias("p")
        ends = pairs.select("root", pair).union(pairs.select("root_b", pair))
        best = ends.groupBy("root").agg(F.max("p").alias("p")).select("p.a", "p.b").distinct()
        best = cut_lineage(best)
        roots = connected(verified(best))
        one, other = (roots.select(F.col("set_key").alias(x), F.col("root").alias(y)) for x, y in (("a", "root"), ("b", "root_b")))
        pairs = pairs.select("a", "b", "promise").join(best, ["a", "b"], "left_anti").join(one, "a", "left").join(other, "b", "left")
        pairs = pairs.withColumns({"root": F.coalesce("root", "a"), "root_b": F.coalesce("root_b", "b")})
        pairs = cut_lineage(pairs.where("root <> root_b"))
    return connected(verified(pairs))


def _unused(docs: DataFrame, name: str) -> str:
    """The name, made longer until the table has no such column."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def representatives(
    docs: DataFrame, text: str = "text", id: str = "doc_id", similarity: float = SIMILARITY, words_each: int = SHINGLE
) -> DataFrame:
    """The rows of ``docs`` of which one stays for each component: its smallest id, NULL ids last.

    Links are pairs of texts whose sets of ``words_each``-word shingles have a Jaccard
    similarity of ``similarity`` or more, on whole texts; none is missed. Texts without
    words are alike. Rows that share id and text are one.
    """
    key = F.xxhash64(F.col(f"`{text}`"))
    named = F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))
    rows = cut_lineage(_prefixes(docs, text, {"id": F.col(f"`{id}`"), "_key": key, "_id": named}, similarity, words_each))
    same = [F.first(n).alias(n) for n in ("size", "sketch", "marks", "fp", "prefix")]
    classes = cut_lineage(rows.groupBy("set_key").agg(F.min("_key").alias("_key"), *same))
    texts = docs.select(key.alias("_key"), F.col(f"`{text}`").alias("_text"))
    found = similar_sets(classes, texts, similarity, words_each)
    slim = rows.select("id", "_id", "_key", "set_key")
    grouped = slim.join(found, "set_key", "left")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "_key", "_id")
    chosen = grouped.groupBy(F.coalesce("root", "set_key")).agg(F.min(order).alias("o")).select("o._id", "o._key").distinct()
    # Only rows that share id and text with another one are brought together to leave one of them.
    counted = slim.groupBy("_id", "_key").agg((F.count("*") > 1).alias("again"))
    i, k, again = (_unused(docs, n) for n in ("near_id", "near_key", "near_again"))
    chosen = cut_lineage(chosen.join(counted, ["_id", "_key"]).toDF(i, k, again))
    kept = docs.withColumns({i: named, k: key}).join(chosen, [i, k])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = kept.where(F.col(again)).dropDuplicates([i, k])
    return kept.where(~F.col(again)).select(*columns).unionByName(repeated.select(*columns))
