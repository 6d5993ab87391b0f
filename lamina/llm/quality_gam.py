"""Quality score by a generalised additive model with pairwise interactions.

Every feature is binned. Boosting goes round the features again and again and
adds, for one feature at a time, a tree of three leaves to that feature's lookup
table; then pairs whose residuals interact most get tables of two dimensions by
trees that cut both axes. A score is the sum of one entry of each table.

The model is fitted on a bounded sample of labelled rows (``TRAINING_ROWS``);
every document is scored over its whole text.

Defined results: a NULL text counts as empty and is scored like any other; rows
repeat as they come; without labels, or with one class only, every score is the
smoothed share of label 1; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import text_slices, texts_of
from lamina.llm.quality_rules import STOP_WORDS
from lamina.llm.training import labelled_keys, sampled

TRAINING_ROWS = 12_000
BINS = 32
ROUNDS = 120
RATE = 0.15
PAIRS = 6
PAIR_ROUNDS = 40
PENALTY = 5.0

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "punctuation", "bangs", "bars", "wide",
    "distinct_words", "distinct_triples", "commonest_word", "stop_words", "words_a_line", "same_lines",
)

_STOP = frozenset(STOP_WORDS)
_SETS = {
    "symbols": b"#*$%&|<>{}[]\\^~=_@+/",
    "upper": bytes(range(65, 91)),
    "digits": b"0123456789",
    "punctuation": b".,;:?'\"()-",
    "bangs": b"!",
    "bars": b"|",
    "wide": bytes(range(128, 256)),
}
_MEMBERS = np.zeros((256, len(_SETS)))
for _place, _characters in enumerate(_SETS.values()):
    _MEMBERS[list(_characters), _place] = 1


def features(text: str) -> list[float]:
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (counts @ _MEMBERS) / max(1, len(raw) - int(counts[9:14].sum()) - int(counts[32]))
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    triples = max(1, len(words) - 2)
    return [
        float(np.log1p(len(words))),
        (len(raw) - int(counts[9:14].sum()) - int(counts[32])) / n,
        *shares.tolist(),
        len(seen) / n,
        len(set(zip(words, words[1:], words[2:]))) / triples,
        max(seen.values(), default=0) / n,
        sum(k for word, k in seen.items() if word.lower() in _STOP) / n,
        len(words) / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
    ]


# ---- fitting -------------------------------------------------------------------


@dataclass
class Gam:
    """``edges`` cut a feature into bins; tables hold what each bin, or pair of bins, adds."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    start: float

    def bins(self, rows: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(edge, rows[:, i], "right") for i, edge in enumerate(self.edges)]

    def score(self, rows: np.ndarray) -> np.ndarray:
        at = self.bins(rows)
        total = np.full(len(rows), self.start)
        for table, place in zip(self.tables, at):
            total += table[place]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[at[i], at[j]]
        return 1 / (1 + np.exp(-total))


def _steps(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    return grad / (hess + PENALTY)


def _gain(grad, hess):
    return grad**2 / (hess + PENALTY)


def _best_cut(grad: np.ndarray, hess: np.ndarray) -> tuple[int, float]:
    """Where to cut a run of bins in two, and what that gains."""
    if len(grad) < 2:
        return 0, 0.0
    g, h = np.cumsum(grad), np.cumsum(hess)
    gain = _gain(g[:-1], h[:-1]) + _gain(g[-1] - g[:-1], h[-1] - h[:-1]) - _gain(g[-1], h[-1])
    best = int(np.argmax(gain))
    return best + 1, float(gain[best])


def _shallow_tree(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Leaf values, bin by bin, of a tree with three leaves at most."""
    cuts = [0, len(grad)]
    for _ in range(2):
        options = [(_best_cut(grad[a:b], hess[a:b]), a) for a, b in zip(cuts, cuts[1:])]
        (place, gain), start = max(options, key=lambda option: option[0][1])
        if gain <= 1e-9:
            break
        cuts = sorted({*cuts, start + place})
    out = np.empty(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _steps(grad[a:b].sum(), hess[a:b].sum())
    return out


def _quadrants(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes into four leaves: its gain over no cut, and the leaf values."""
    g, h = (np.cumsum(np.cumsum(x, 0), 1) for x in (grad, hess))

    def corners(c: np.ndarray) -> list[np.ndarray]:
        low = c[:-1, :-1]
        top, left = c[:-1, -1:], c[-1:, :-1]
        return [low, top - low, left - low, c[-1, -1] - top - left + low]

    parts = list(zip(corners(g), corners(h)))
    gain = sum(_gain(a, b) for a, b in parts)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(grad)
    for (a, b), rows, cols in zip(
        parts,
        (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)),
        (slice(0, j + 1), slice(j + 1, None), slice(0, j + 1), slice(j + 1, None)),
    ):
        out[rows, cols] = _steps(a[i, j], b[i, j])
    return float(gain[i, j]) - float(_gain(g[-1, -1], h[-1, -1])), out


def fit(rows: np.ndarray, label: np.ndarray) -> Gam:
    """Boosts a model; ``label`` is 0 or 1. One class only gives a constant score."""
    share = (label.sum() + 1) / (len(label) + 2)
    start = float(np.log(share / (1 - share)))
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(rows[:, i], quantiles)) if len(rows) else np.zeros(0) for i in range(len(FEATURES))]
    model = Gam(edges, [np.zeros(len(edge) + 1) for edge in edges], [], [], start)
    if not 0 < label.sum() < len(label):
        return model
    at = model.bins(rows)
    total = np.full(len(rows), start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return label - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for table, place in zip(model.tables, at):
            grad, hess = slopes()
            add = RATE * _shallow_tree(
                np.bincount(place, grad, len(table)), np.bincount(place, hess, len(table))
            )
            table += add
            total += add[place]

    def grid(i: int, j: int, weight: np.ndarray) -> np.ndarray:
        shape = len(model.tables[i]), len(model.tables[j])
        return np.bincount(at[i] * shape[1] + at[j], weight, shape[0] * shape[1]).reshape(shape)

    grad, hess = slopes()
    options = [(i, j) for i in range(len(FEATURES)) for j in range(i) if min(len(edges[i]), len(edges[j])) > 0]
    ranked = sorted(options, key=lambda pair: -_quadrants(grid(*pair, grad), grid(*pair, hess))[0])
    model.pairs = ranked[:PAIRS]
    model.pair_tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            grad, hess = slopes()
            add = RATE * _quadrants(grid(i, j, grad), grid(i, j, hess))[1]
            table += add
            total += add[at[i], at[j]]
    return model


# ---- on Spark --------------------------------------------------------------------


def train(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", text: str = "text", rows: int = TRAINING_ROWS
) -> Gam:
    """Fits on at most about ``rows`` labelled documents; features are computed where the texts are."""
    keys = labelled_keys(labels, label, held_out, rows)
    some = sampled(docs.select("doc_id", F.col(text).alias("_text")), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                found = [features(one) for one in texts_of(part, "_text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(found, pa.list_(pa.float64()))],
                    ["doc_id", "label", "x"],
                )

    kind = dict(some.dtypes)["doc_id"]
    found = some.select("doc_id", "label", "_text").mapInArrow(run, f"doc_id {kind}, label int, x array<double>")
    # One row an id, so that repeated ids cannot enlarge the sample.
    found = found.groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("s")).orderBy("doc_id").select("s.*")
    got = found.toArrow().combine_chunks()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, got.column("label").to_numpy().astype(float))


def score_quality(
    docs: DataFrame, model: Gam, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.3
) -> DataFrame:
    """``keep``, score and predicted of each row; no shuffle."""
    kinds = dict(docs.dtypes)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                found = model.score(np.array([features(one) for one in texts_of(part, "_text")]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                    [*names, "score", "predicted"],
                )

    rows = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], F.col(text).alias("_text"))
    schema = ", ".join([*(f"{n} {kinds[k]}" for k, n in zip(keep, names)), "score double", "predicted int"])
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))
