"""Toxicity score by a convolutional text classifier trained in numpy.

A word is hashed into embedding tables by its whole, its first four and its first
six characters, whose vectors stand side by side; filters of several widths slide
over the whole text, each keeps its maximum, and a logistic layer adds these up.
Word starts carry over to inflected and compound words. Buckets that training has
not seen stay zero, so new words add nothing however long a text is; and since a
new word may share a bucket of one table with a bad one, texts of label 0 are
given a few made-up words that do, and now and then no others: the filters learn to
want more than that, and the rest not to need known words.

The model is fitted on all labelled documents, over their whole texts. They are dealt
by the hash of their id into packs of about ``PACK_ROWS`` documents and ``PACK_BYTES`` of text.
How surely a bucket goes with a label is counted over all packs; in each epoch every pack
trains the model on by itself, and the parameters that come out are averaged, those of a
bucket over the packs that moved it. A threshold for each language is calibrated on the
scores of all these documents, told apart to 1 / ``SCORE_STEPS``. Sums are taken in
whole numbers, so partitions do not change the model.

Defined results: a NULL text counts as empty; empty texts get the score of a
text of unseen words; rows repeat as they come; without labels, or with one
class only, every score is the smoothed share of label 1; languages that are
NULL or have fewer than ``CALIBRATION`` positive rows use the threshold of all;
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import copy
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import text_slices, texts_of
from lamina.llm.training import labelled_keys
from lamina.session import BROADCAST_ROWS, cut_lineage, short_lived_shuffles

PACK_ROWS = 4_000
PACK_BYTES = 16 << 20
SCORE_STEPS = 1 << 16
BITS = 18
BUCKETS = 1 << BITS
STARTS = (None, 4, 6)
SIZE = 4
WIDTHS = (1, 2, 3)
FILTERS = 6
EPOCHS = 6
BATCH = 64
CALIBRATION = 20
REMEMBERED = 500_000
# Places that a step looks at together, and the parts of one in whole-number sums.
BLOCK = 1 << 16
PARTS = 1 << 40

_EDGES = ".,;:!?\"'()[]{}<>|*$%&#"


class _Buckets(dict):
    """Word to its bucket in each table, side by side in one number; bounded by ``word_buckets``."""

    def __missing__(self, word: str) -> int:
        bare = word.strip(_EDGES).lower()
        code = sum(zlib.crc32(bare[:end].encode(), i) % BUCKETS << BITS * i for i, end in enumerate(STARTS)) if bare else -1
        self[word] = code
        return code


_buckets = _Buckets()


def word_buckets(text: str) -> np.ndarray:
    """The words' buckets as 64-bit codes; marks alone are not words."""
    if len(_buckets) > REMEMBERED:
        _buckets.clear()
    words = text.split()
    codes = np.fromiter(map(_buckets.__getitem__, words), np.int64, len(words))
    return codes[codes >= 0]


# ---- the network -------------------------------------------------------------------


@dataclass
class Cnn:
    """Embedding tables and filters. Without ``tables`` every score is ``start``'s."""

    start: float
    tables: np.ndarray | None = None  # starts x BUCKETS x SIZE
    filters: list[np.ndarray] = field(default_factory=list)  # width x all SIZEs x FILTERS
    shifts: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([part[codes >> BITS * i & BUCKETS - 1] for i, part in enumerate(self.tables)], axis=1)

    def _maps(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter values at every place; the rows after the last word count as zero."""
        found = []
        for weights in self.filters:
            y = x @ weights[0]
            for step in range(1, len(weights)):
                y[:-step] += x[step:] @ weights[step]
            found.append(y)
        return found

    def pooled(self, codes: np.ndarray, block: int = 1 << 15) -> np.ndarray:
        """Maximum of every filter over one text, block by block with the overlap filters need."""
        best = np.zeros((len(self.filters), FILTERS))
        wide = max(map(len, self.filters)) - 1
        for start in range(0, len(codes), block):
            maps = self._maps(self.vectors(codes[start : start + block + wide]))
            for k, y in enumerate(maps):
                best[k] = np.maximum(best[k], (y[:block] + self.shifts[k]).max(axis=0))
        return best.ravel()

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.tables is None:
            return np.full(len(texts), 1 / (1 + np.exp(-self.start)))
        rows = np.array([self.pooled(codes) for codes in texts]).reshape(len(texts), -1)
        return 1 / (1 + np.exp(-(rows @ self.out + self.start)))


def bucket_counts(texts: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """In how many texts of label 0 and of label 1 each bucket of each table is."""
    seen = np.zeros((2, len(STARTS), BUCKETS), np.int64)
    for codes, y in zip(texts, label):
        for table in range(len(STARTS)):
            seen[int(y), table][np.unique(codes >> BITS * table & BUCKETS - 1)] += 1
    return seen


def _evidence(with_none: np.ndarray, with_one: np.ndarray, ones: float, rows: int) -> np.ndarray:
    """For each bucket how surely it goes with label 1, -1 to 1."""
    a, b, n, m = with_one + 0.5, with_none + 0.5, ones + 1, rows - ones + 1
    ratio = np.log(a / (n - a + 0.5)) - np.log(b / (m - b + 0.5))
    z = ratio / np.sqrt(1 / a + 1 / (n - a + 0.5) + 1 / b + 1 / (m - b + 0.5))
    return np.where(with_one + with_none > 1, np.clip(z / 8, -1, 1), 0)


@dataclass
class Trainee:
    """A model on its way: what training remembers beside its parameters."""

    model: Cnn
    suspect: list[np.ndarray]
    unseen: list[int]
    first: list[np.ndarray]
    second: list[np.ndarray]
    squares: np.ndarray
    moments: np.ndarray
    step: float = 0

    def dense(self) -> list[np.ndarray]:
        return [*self.model.filters, *self.model.shifts, self.model.out]

    def flat(self) -> np.ndarray:
        """All that is not of one bucket, as one array."""
        parts = [p.ravel() for p in (*self.dense(), *self.first, *self.second, self.moments)]
        return np.concatenate([*parts, [self.model.start, self.step]]).astype(float)

    def take(self, flat: np.ndarray) -> None:
        at = 0
        for part in (*self.dense(), *self.first, *self.second, self.moments):
            part[...] = flat[at : at + part.size].reshape(part.shape)
            at += part.size
        self.model.start, self.step = map(float, flat[at : at + 2])


def begin(seen: np.ndarray, ones: float, rows: int, seed: int = 7) -> Trainee | Cnn:
    """The model before the first epoch, by the counts of all texts; it is final if there is one class only."""
    share = (ones + 1) / (rows + 2)
    model = Cnn(float(np.log(share / (1 - share))))
    if not 0 < ones < rows:
        return model
    rng = np.random.default_rng(seed)
    model.tables = np.zeros((len(STARTS), BUCKETS, SIZE), np.float32)
    suspect, unseen = [], []
    for table in range(len(STARTS)):
        total = seen[:, table].sum(axis=0)
        strength = _evidence(*seen[:, table], ones, rows)
        suspect.append(np.flatnonzero(strength > 0.3))
        unseen.append(int(np.argmin(total)))
        model.tables[table][total > 1] = rng.normal(0, 0.02, (int((total > 1).sum()), SIZE))
        model.tables[table][:, 0] = strength
    model.filters = [rng.normal(0, 0.1, (w, len(STARTS) * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for weights in model.filters:
        # Half of the filters start by listening for label 1, half for label 0.
        weights[0, ::SIZE, :] = np.where(np.arange(FILTERS) % 2 == 0, 1.0, -0.5)
    model.shifts = [np.full(FILTERS, -0.3, np.float32) for _ in WIDTHS]
    model.out = np.tile(np.where(np.arange(FILTERS) % 2 == 0, 1.0, -0.2), len(WIDTHS)).astype(np.float64)
    dense = [*model.filters, *model.shifts, model.out]
    first, second = ([np.zeros_like(p) for p in dense] for _ in range(2))
    return Trainee(model, suspect, unseen, first, second, np.zeros((len(STARTS), BUCKETS), np.float32), np.zeros(2))


def _maxima(model: Cnn, flat: np.ndarray, lead: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Every filter's maximum and its first place in each text; texts stand in ``flat`` from ``lead`` on, -1 is a blank."""
    wide = max(WIDTHS) - 1
    pooled = [np.full((len(lead), FILTERS), -np.inf) for _ in WIDTHS]
    places = [np.zeros((len(lead), FILTERS), np.int64) for _ in WIDTHS]
    for start in range(0, len(flat), BLOCK):
        end = min(start + BLOCK, len(flat))
        part = flat[start : end + wide]
        x = model.vectors(np.maximum(part, 0))
        x[part < 0] = 0
        some = range(int(np.searchsorted(lead, start, "right")) - 1, int(np.searchsorted(lead, end, "left")))
        cuts = [max(int(lead[d]), start) - start for d in some] + [end - start]
        for y, best, spot in zip(model._maps(x), pooled, places):
            for d, a, b in zip(some, cuts, cuts[1:]):
                at = np.argmax(y[a:b], axis=0)
                value = y[a + at, np.arange(FILTERS)]
                more = value > best[d]
                best[d][more] = value[more]
                spot[d][more] = (start + a + at)[more]
    return pooled, places


def epoch(state: Trainee, texts: list[np.ndarray], label: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Trains by minibatches, in place; a step follows only the places that gave the maxima. True for moved buckets."""
    model, dense, first, second, squares = state.model, state.dense(), state.first, state.second, state.squares
    suspect, unseen, step = state.suspect, state.unseen, state.step
    moved = np.zeros((len(STARTS), BUCKETS), bool)
    blank = np.full(max(WIDTHS), -1)

    def sharing(count: int = 6) -> np.ndarray:
        """Codes of words that share one table's bucket with a telling word."""
        out = np.zeros(count, np.int64)
        which = rng.integers(0, len(STARTS), count)
        for table in range(len(STARTS)):
            other = rng.choice(suspect[table], count) if len(suspect[table]) else unseen[table]
            out |= np.where(which == table, other, unseen[table]) << BITS * table
        return out

    for chosen in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
        step += 1
        # Some texts of label 0 lose their words, so that none is needed to look clean.
        drawn = [(i, not label[i] and rng.random() < 0.15) for i in chosen]
        rows = [np.concatenate([texts[i][: 0 if bare else None], blank if label[i] else sharing(), blank]) for i, bare in drawn]
        flat = np.concatenate(rows)
        pooled, places = _maxima(model, flat, np.cumsum([0, *map(len, rows)])[:-1])
        raw = np.concatenate([best + shift for best, shift in zip(pooled, model.shifts)], axis=1)
        kept = np.maximum(raw, 0)
        p = 1 / (1 + np.exp(-(kept @ model.out + model.start)))
        error = (p - label[chosen]) / len(chosen)
        back = (error[:, None] * model.out[None, :]) * (raw > 0)
        grads: list[np.ndarray] = []
        touched, pushes = [], []
        for k, (weights, spot) in enumerate(zip(model.filters, places)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            grad = np.zeros_like(weights)
            for d in range(len(weights)):
                codes = flat[np.minimum(spot + d, len(flat) - 1)]
                x = model.vectors(np.maximum(codes.ravel(), 0))
                x[codes.ravel() < 0] = 0
                grad[d] = np.einsum("bf,bfe->ef", g, x.reshape(*codes.shape, -1))
                push = g[:, :, None] * weights[d].T[None, :, :]
                used = (g != 0) & (codes >= 0)
                touched.append(codes[used])
                pushes.append(push[used])
            grads.append(grad)
        grads += [back[:, k * FILTERS : (k + 1) * FILTERS].sum(0) for k in range(len(WIDTHS))]
        grads.append(kept.T @ error + 1e-4 * model.out)
        for i, (value, grad) in enumerate(zip(dense, grads)):
            first[i] += 0.1 * (grad - first[i])
            second[i] += 0.01 * (grad**2 - second[i])
            value -= 0.02 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-7)
        g = float(error.sum())
        state.moments += (0.1, 0.01) * (np.array([g, g * g]) - state.moments)
        model.start -= 0.02 * (state.moments[0] / (1 - 0.9**step)) / (np.sqrt(state.moments[1] / (1 - 0.99**step)) + 1e-7)
        codes, push = np.concatenate(touched), np.concatenate(pushes)
        for table in range(len(STARTS)):
            bucket, which = np.unique(codes >> BITS * table & BUCKETS - 1, return_inverse=True)
            if len(bucket):
                total = np.zeros((len(bucket), SIZE), np.float32)
                np.add.at(total, which, push[:, table * SIZE : (table + 1) * SIZE])
                squares[table][bucket] += (total**2).mean(axis=1)
                model.tables[table][bucket] -= 0.05 * total / (np.sqrt(squares[table][bucket]) + 1e-6)[:, None]
                moved[table][bucket] = True
    state.step = step
    return moved


def fit(texts: list[np.ndarray], label: np.ndarray, seed: int = 7) -> Cnn:
    """Trains on the texts of one pack."""
    state = begin(bucket_counts(texts, label), float(label.sum()), len(label), seed)
    if isinstance(state, Cnn):
        return state
    for turn in range(EPOCHS):
        epoch(state, texts, label, np.random.default_rng([seed, turn, 0]))
    return state.model


def calibrate(
    score: np.ndarray, label: np.ndarray, groups: list[str | None], rows: np.ndarray | None = None
) -> dict[str | None, float]:
    """The threshold with the best F1 for each group, and under None for all rows.

    With ``rows``, an entry stands for so many rows of one score, ``label`` of them of label 1.
    """
    rows = np.ones(len(score)) if rows is None else rows

    def best(s: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
        order = np.argsort(-s, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.cumsum(n[order]) + y.sum())
        top = int(np.argmax(f1))
        below = s[order][top + 1] if top + 1 < len(s) else 0.0
        return float((s[order][top] + below) / 2)

    if not label.sum():
        return {None: 0.5}
    found: dict[str | None, float] = {None: best(score, label, rows)}
    for group in sorted({g for g in groups if g is not None}):
        mine = np.array([g == group for g in groups])
        if label[mine].sum() >= CALIBRATION:
            found[group] = best(score[mine], label[mine], rows[mine])
    return found


# ---- on Spark ------------------------------------------------------------------------


@dataclass
class Detector:
    model: Cnn
    thresholds: dict[str | None, float]


def _packs(docs: DataFrame, keys: DataFrame, text: str, rows: int) -> DataFrame:
    """All labelled documents, one for each id, in packs: their words as places in the pack's list of codes."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    slim = docs.select("doc_id", lang.alias("lang"), F.col(text).alias("_text"))
    keys = cut_lineage(keys)
    some = slim.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, "doc_id")
    some = some.groupBy("doc_id").agg(F.min(F.struct("label", "lang", "_text")).alias("s")).select("doc_id", "s.*")
    some = cut_lineage(some)
    size = some.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("bytes")).first()
    count = max(1, math.ceil(size["n"] / rows), math.ceil(size["bytes"] / PACK_BYTES))

    def pack(held: pa.Table) -> pa.Table:
        held = held.sort_by("doc_id")
        found = [word_buckets(one or "") for one in held.column("_text").to_pylist()]
        codes, words = np.unique(np.concatenate(found), return_inverse=True)
        return pa.table(
            {
                "pack": held.column("pack")[:1].cast(pa.int32()),
                "codes": pa.array([codes], pa.list_(pa.int64())),
                "words": pa.array([words.astype(np.int32)], pa.list_(pa.int32())),
                "ends": pa.array([np.cumsum([len(one) for one in found]).astype(np.int32)], pa.list_(pa.int32())),
                "label": pa.array([held.column("label").to_pylist()], pa.list_(pa.int32())),
                "lang": pa.array([held.column("lang").to_pylist()], pa.list_(pa.string())),
            }
        )

    dealt = some.withColumn("pack", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("pack")), F.lit(count)).cast("int"))
    schema = "pack int, codes array<long>, words array<int>, ends array<int>, label array<int>, lang array<string>"
    return cut_lineage(dealt.groupBy("pack").applyInArrow(pack, schema))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, list[str | None]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            codes, words, ends, label = (batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in ("codes", "words", "ends", "label"))
            yield batch.column("pack")[i].as_py(), np.split(codes[words], ends[:-1]), label.astype(float), batch.column("lang")[i].as_py()


def _counted(packs: DataFrame) -> tuple[np.ndarray, int, int]:
    """bucket_counts of all packs, and how many texts of label 1 and of both there are."""
    last = 2 * len(STARTS) * BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, label, _ in _unpacked(batches):
            seen = bucket_counts(texts, label).ravel()
            keys = np.flatnonzero(seen)
            keys, n = np.concatenate([keys, [last, last + 1]]), np.concatenate([seen[keys], [int(label.sum()), len(label)]])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    with short_lived_shuffles(packs.sparkSession):
        got = packs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(last + 2, np.int64)
    flat[got.column("key").to_numpy()] = got.column("n").to_numpy()
    return flat[:last].reshape(2, len(STARTS), BUCKETS), int(flat[last]), int(flat[last + 1])


def _trained(packs: DataFrame, state: Trainee, turn: int, seed: int) -> None:
    """One epoch: every pack trains from ``state``, which then gets the means of what they found."""
    context = packs.sparkSession.sparkContext
    sent = context.broadcast(state)
    last, wide = len(STARTS) * BUCKETS, SIZE + 1
    names = [f"v{i}" for i in range(wide)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, texts, label, _ in _unpacked(batches):
            own = copy.deepcopy(sent.value)
            moved = np.flatnonzero(epoch(own, texts, label, np.random.default_rng([seed, turn, number])))
            rows = np.concatenate([own.model.tables.reshape(-1, SIZE)[moved], own.squares.reshape(-1, 1)[moved]], axis=1)
            flat = own.flat()
            flat = np.pad(flat, (0, -len(flat) % wide)).reshape(-1, wide)
            keys = np.concatenate([moved, last + np.arange(len(flat))])
            whole = np.rint(np.concatenate([rows, flat]).astype(float) * PARTS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, np.ascontiguousarray(whole.T))], ["key", *names])

    rows = packs.mapInArrow(run, ", ".join(["key long", *(f"{n} long" for n in names)]))
    with short_lived_shuffles(packs.sparkSession):
        means = rows.groupBy("key").agg(*[(F.sum(n).cast("double") / F.count("*") / PARTS).alias(n) for n in names])
        got = means.toArrow().sort_by("key")
    sent.destroy()
    keys = got.column("key").to_numpy()
    values = np.stack([got.column(n).to_numpy() for n in names], axis=1)
    moved = keys < last
    state.model.tables.reshape(-1, SIZE)[keys[moved]] = values[moved, :SIZE]
    state.squares.reshape(-1)[keys[moved]] = values[moved, SIZE]
    state.take(values[~moved].ravel())


def _calibrated(packs: DataFrame, model: Cnn) -> dict[str | None, float]:
    """``calibrate`` over the scores of all packs, counted by language and step of the score."""
    sent = packs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, label, lang in _unpacked(batches):
            at = np.rint(sent.value.score(texts) * SCORE_STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at), pa.array(label.astype(np.int64))], ["lang", "at", "label"])

    rows = packs.mapInArrow(run, "lang string, at long, label long")
    counted = cut_lineage(rows.groupBy("lang", "at").agg(F.sum("label").alias("ones"), F.count("*").alias("n")))
    # Languages without a threshold of their own are told apart no further.
    often = counted.groupBy("lang").agg(F.sum("ones").alias("all")).where(F.col("all") >= CALIBRATION).select("lang", F.col("lang").alias("own"))
    with short_lived_shuffles(packs.sparkSession):
        got = counted.join(often, "lang", "left").groupBy("own", "at").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")).toArrow()
    sent.destroy()
    ones, n = (got.column(c).to_numpy().astype(float) for c in ("ones", "n"))
    return calibrate(got.column("at").to_numpy() / SCORE_STEPS, ones, got.column("own").to_pylist(), n)


def train(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", text: str = "text", rows: int = PACK_ROWS, seed: int = 7
) -> Detector:
    """Fits on all labelled documents that are not held out, in packs of about ``rows``."""
    packs = _packs(docs, labelled_keys(labels, label, held_out, None), text, rows)
    state = begin(*_counted(packs), seed)
    if isinstance(state, Trainee):
        for turn in range(EPOCHS):
            _trained(packs, state, turn, seed)
        state = state.model
    return Detector(state, _calibrated(packs, state))


def score_toxicity(
    docs: DataFrame, detector: Detector, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.3
) -> DataFrame:
    """``keep``, score, predicted (by ``threshold``), and flagged (by the language's threshold); no shuffle."""
    kinds = dict(docs.dtypes)
    names = [f"k{i}" for i in range(len(keep))]
    sent = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, limits = sent.value.model, sent.value.thresholds
        for batch in batches:
            for part in text_slices(batch, "_text"):
                found = model.score([word_buckets(one) for one in texts_of(part, "_text")])
                own = np.array([limits.get(lang, limits[None]) for lang in part.column("_lang").to_pylist()])
                columns = [pa.array(found), pa.array((found >= threshold).astype(np.int32)), pa.array(found >= own)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], *columns], [*names, "score", "predicted", "flagged"]
                )

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], lang.alias("_lang"), F.col(text).alias("_text"))
    schema = ", ".join([*(f"{n} {kinds[k]}" for k, n in zip(keep, names)), "score double, predicted int, flagged boolean"])
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))
