"""Feature layer: learn on train rows, apply to any rows."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import pairwise

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import domain, session
from lamina.domain import FeatureSpec
from lamina.functions.scalars import (
    clip_above,
    clip_between,
    col,
    dummy,
    finite_or_zero,
    number_of,
    ordinal_code,
    standardised,
)
from lamina.operators.ordering import with_ordered_split, with_ordinal
from lamina.operators.refine import keep_existing
from lamina.operators.selection import quantiles, upper_fence

HOT_KEY_SALTS = 32
HOT_ROWS = 50_000  # rows of one word that are looked up in one task


@dataclass(frozen=True)
class FitParams:
    """Everything learned from the train rows; a handful of numbers and words."""

    vocabulary: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    indexes: Mapping[str, DataFrame] = field(default_factory=dict)  # tables (word, code)
    medians: Mapping[str, float | None] = field(default_factory=dict)
    means: Mapping[str, float | None] = field(default_factory=dict)
    deviations: Mapping[str, float | None] = field(default_factory=dict)
    fence: float | None = None
    z_low: float | None = None
    z_high: float | None = None


def dummy_name(column: str, category: str) -> str:
    """``{column}_{category}``; dots and back-ticks would break selection."""
    return f"{column}_{category}".replace(".", "_").replace("`", "_")


def dummy_names(column: str, vocabulary: Sequence[str], taken: set[str]) -> list[str]:
    """One name per category; names that fall together, also but for case, get a running number."""
    names = []
    used = {name.lower() for name in taken}
    for category in vocabulary:
        base = name = dummy_name(column, category)
        n = 2
        while name.lower() in used:
            name, n = f"{base}_{n}", n + 1
        used.add(name.lower())
        taken.add(name)
        names.append(name)
    return names


def vocabularies(
    train: DataFrame, nominal: Sequence[str], widest: int
) -> tuple[dict[str, tuple[str, ...]], tuple[str, ...]]:
    """Sorted categories per column, and the columns with too many of them.

    Categories are found by a distributed distinct, and at most ``widest`` per
    column (plus one to notice more) reach the driver. What a column with more
    of them gets is the caller's choice.
    """
    present = [n for n in nominal if n in train.columns]
    if not present:
        return {}, ()
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("name"), col(n).cast("string").alias("value"))
                for n in present
            ]
        )
    )
    distinct = (
        train.select(cells.alias("cell"))
        .select("cell.*")
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.lit(1))
        .select("name", "value")
    )
    # usually all distinct values fit the bound and one job is enough
    rows = distinct.limit(widest * len(present) + 1).collect()
    if len(rows) > widest * len(present):
        counted = distinct.groupBy("name").agg(F.count("*").alias("n")).collect()
        narrow = [r["name"] for r in counted if r["n"] <= widest]
        sizes = {r["name"]: r["n"] for r in counted}
        rows = distinct.filter(F.col("name").isin(narrow)).collect() if narrow else []
    else:
        sizes = Counter(r["name"] for r in rows)
    wide = tuple(n for n in present if sizes.get(n, 0) > widest)
    listed: dict[str, list[str]] = {n: [] for n in present if n not in wide}
    for row in rows:
        if row["name"] in listed:
            listed[row["name"]].append(row["value"])
    return {n: tuple(sorted(v)) for n, v in listed.items()}, wide


def fit(train: DataFrame, spec: FeatureSpec | None = None, **limits: int) -> FitParams:
    """Learn all parameters from ``train`` alone.

    Moments and counts of all columns come from one aggregate; medians and
    fence from exact order statistics; categories from one grouped pass. An
    empty frame gives parameters that change nothing.
    """
    spec = spec or FeatureSpec()
    present = set(train.columns)
    imputed = [n for n in spec.imputed if n in present]
    scaled = [n for n in spec.scaled if n in present]
    capped = [spec.capped] if spec.capped in present else []
    clipped = [spec.z_clipped] if spec.z_clipped in present else []
    numeric = list(dict.fromkeys(imputed + scaled + capped + clipped))
    numbers = train.select(*[number_of(train, n).alias(n) for n in numeric])

    spread = F.stddev_samp if spec.ddof else F.stddev_pop
    moments = numbers.agg(
        F.count("*").alias("rows"),
        *[F.count(col(n)).alias(f"n_{n}") for n in numeric],
        *[F.avg(col(n)).alias(f"mean_{n}") for n in scaled + clipped],
        *[spread(col(n)).alias(f"std_{n}") for n in scaled + clipped],
    )
    row = moments.first()
    sizes = {n: row[f"n_{n}"] for n in numeric}

    wanted: dict[str, list[float]] = {n: [0.5] for n in imputed}
    for n in capped:
        wanted[n] = wanted.get(n, []) + [0.25, 0.75]
    at = quantiles(numbers, wanted, spec.quantile_rule, sizes, **limits) if wanted else {}
    nominal = [n for n in spec.nominal if n not in spec.indexed]
    vocabulary, wide = vocabularies(train, nominal, spec.widest_vocabulary)
    if wide:
        raise ValueError(
            f"{', '.join(wide)}: more than {spec.widest_vocabulary} categories; name such columns in indexed"
        )

    z_low = z_high = None
    for n in clipped:
        mean, std = row[f"mean_{n}"], row[f"std_{n}"]
        if mean is not None and std is not None:
            z_low, z_high = mean - spec.z_limit * std, mean + spec.z_limit * std
    return FitParams(
        vocabulary=vocabulary,
        indexes={n: word_index(train, n) for n in spec.indexed if n in present},
        medians={n: at[n][0.5] for n in imputed},
        means={n: row[f"mean_{n}"] for n in scaled},
        deviations={n: row[f"std_{n}"] for n in scaled},
        fence=upper_fence(at[capped[0]][0.25], at[capped[0]][0.75], spec.fence_factor)
        if capped
        else None,
        z_low=z_low,
        z_high=z_high,
    )


def transform(df: DataFrame, params: FitParams, spec: FeatureSpec | None = None) -> DataFrame:
    """Apply learned parameters: two narrow projections, no action, no shuffle.

    Columns with an index table are looked up in it and give ``{column}_code``;
    with or without them, any frame gets the columns that the stored layer has.
    Order of effect: ordinal codes, dummies, median fill, scaling of the
    filled (not yet clipped) values, fence cap, z clip.
    """
    spec = spec or FeatureSpec()
    numeric = set(spec.imputed) | set(spec.scaled) | {spec.capped, spec.z_clipped}
    filled: list[Column] = []
    for name in df.columns:
        value = col(name)
        if name in spec.ordinal:
            value = ordinal_code(number_of(df, name))
        elif name in numeric:
            value = number_of(df, name)
            median = params.medians.get(name)
            if median is not None:
                value = F.coalesce(value, F.lit(median))
        filled.append(value.alias(name))
    ready = df.select(*filled)

    taken = set(df.columns)
    columns: list[Column] = []
    for name in ready.columns:
        if name in params.vocabulary:
            continue
        value = col(name)
        if name == spec.capped:
            value = clip_above(value, params.fence)
        if name == spec.z_clipped:
            value = clip_between(value, params.z_low, params.z_high)
        columns.append(value.alias(name))
    for name, categories in params.vocabulary.items():
        if name in taken:
            names = dummy_names(name, categories, taken)
            columns += [
                dummy(col(name).cast("string"), c).alias(n) for c, n in zip(categories, names)
            ]
    for name in params.means:
        if name in taken:
            score = standardised(col(name), params.means[name], params.deviations[name])
            columns.append(score.alias(f"{name}_scaled"))
    done = ready.select(*columns)
    for name, index in params.indexes.items():
        if name in taken:
            done = look_up(done, index, name, spec.row_key, f"{name}_code")
    return done


def build_features(
    refined: DataFrame, spec: FeatureSpec | None = None, **limits: int
) -> tuple[DataFrame, FitParams]:
    """Keep, split by row key, fit on train, transform all rows once.

    Train and test stay one frame with a ``split`` column, so nothing has to
    be put together again and both parts have the same columns.
    """
    spec = spec or FeatureSpec()
    kept = keep_existing(refined, [spec.row_key, *spec.kept])
    parts = with_ordered_split(kept, spec.row_key, spec.train_fraction, **limits)
    train = parts.filter(F.col("split") == "train")
    params = fit(train, spec, **limits)
    return transform(parts, params, spec), params


def stack_parts(
    train: DataFrame, test: DataFrame, params: FitParams, spec: FeatureSpec | None = None
) -> DataFrame:
    """Separately held train and test rows, transformed and put together.

    For parts that arrive as two tables; columns are matched by name and are
    the same on both sides, because both use the parameters of train.
    """
    return transform(train, params, spec).unionByName(transform(test, params, spec))


PARAMS_SCHEMA = "kind string, column_name string, position int, word string, number double"


def params_table(spark: SparkSession, params: FitParams) -> DataFrame:
    """Learned parameters as rows (kind, column, position, word, number).

    Index tables may be large: their rows are appended by Spark, not by the driver.
    """
    rows = []
    for name, categories in params.vocabulary.items():
        rows += [("category", name, i, c, None) for i, c in enumerate(categories)]
        if not categories:
            rows.append(("category", name, -1, None, None))
    for kind in ("medians", "means", "deviations"):
        rows += [(kind, n, 0, None, v) for n, v in getattr(params, kind).items()]
    rows += [(kind, None, 0, None, getattr(params, kind)) for kind in ("fence", "z_low", "z_high")]
    table = spark.createDataFrame(rows, PARAMS_SCHEMA)
    for name, index in params.indexes.items():
        table = table.union(
            index.select(
                F.lit("index"), F.lit(name), F.col("code").cast("int"), "word", F.lit(None).cast("double")
            )
        )
    return table


def read_params(table: DataFrame) -> FitParams:
    """The inverse of ``params_table``; index tables stay tables, the rest is small."""
    rows = sorted(table.filter("kind <> 'index'").collect(), key=lambda r: (r["kind"], r["position"]))
    words = table.filter("kind = 'index'")
    indexed = [r["column_name"] for r in words.select("column_name").distinct().collect()]
    indexes = {
        n: words.filter(F.col("column_name") == n).select("word", F.col("position").cast("bigint").alias("code"))
        for n in sorted(indexed)
    }
    vocabulary: dict[str, tuple[str, ...]] = {}
    numbers: dict[str, dict[str, float | None]] = {"medians": {}, "means": {}, "deviations": {}}
    single: dict[str, float | None] = {}
    for r in rows:
        if r["kind"] == "category":
            words = vocabulary.setdefault(r["column_name"], ())
            if r["position"] >= 0:
                vocabulary[r["column_name"]] = words + (r["word"],)
        elif r["kind"] in numbers:
            numbers[r["kind"]][r["column_name"]] = r["number"]
        else:
            single[r["kind"]] = r["number"]
    return FitParams(vocabulary=vocabulary, indexes=indexes, **numbers, **single)


def catalogue(
    spark: SparkSession, params: FitParams, spec: FeatureSpec | None = None
) -> DataFrame:
    """One row per transformation: what, how, on which column, what was learned."""
    spec = spec or FeatureSpec()
    rows = [("label_encoding", "text to integer code", n, None) for n in spec.ordinal]
    rows += [
        ("one_hot", "one column per train category", n, float(len(v)))
        for n, v in params.vocabulary.items()
    ]
    rows += [("index_code", "place in the sorted train categories", n, None) for n in params.indexes]
    rows += [("missing_number", "train median", n, v) for n, v in params.medians.items()]
    rows += [("scaling_mean", "train mean", n, v) for n, v in params.means.items()]
    rows += [("scaling_deviation", "train deviation", n, v) for n, v in params.deviations.items()]
    rows.append(("fence_cap", "upper quartile fence", spec.capped, params.fence))
    rows.append(("z_clip_low", "mean less deviations", spec.z_clipped, params.z_low))
    rows.append(("z_clip_high", "mean plus deviations", spec.z_clipped, params.z_high))
    schema = "transformation string, technique string, column_name string, learned double"
    return spark.createDataFrame(rows, schema)


def clip_effect(df: DataFrame, params: FitParams, spec: FeatureSpec | None = None) -> DataFrame:
    """Rows each clip would change, with their share, in one pass."""
    spec = spec or FeatureSpec()
    target, revenue = number_of(df, spec.capped), number_of(df, spec.z_clipped)
    missing = F.lit(None).cast("double")

    def bound(value: float | None) -> Column:
        return missing if value is None else F.lit(value)

    row = df.agg(
        F.count("*").alias("rows"),
        F.count_if(target > bound(params.fence)).alias("fence_cap"),
        F.count_if(
            (revenue > bound(params.z_high)) | (revenue < bound(params.z_low))
        ).alias("z_clip"),
    )
    cells = [
        F.struct(F.lit(n).alias("clip"), F.col(n).alias("changed")) for n in ("fence_cap", "z_clip")
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell"), "rows").select(
        "cell.clip",
        "cell.changed",
        F.coalesce(
            F.try_divide(F.lit(100.0) * F.col("cell.changed"), F.col("rows").cast("double")),
            F.lit(0.0),
        ).alias("changed_percent"),
    )


# -- category codes ----------------------------------------------------------


def alphabetical_codes(
    df: DataFrame,
    train: DataFrame,
    names: Sequence[str],
    key: str,
    fill_value: str = domain.UNKNOWN,
    widest: int = 1_000,
) -> DataFrame:
    """Each named column to its place 0.. in the sorted train vocabulary.

    Missing values count as one more category; a category unseen in train gets
    the number after the last. Up to ``widest`` categories become a constant
    map; a larger vocabulary is numbered and looked up as a table.
    """

    def words(frame: DataFrame) -> DataFrame:
        return frame.withColumns(
            {n: F.coalesce(col(n).cast("string"), F.lit(fill_value)) for n in names}
        )

    filled, learned = words(df), words(train.select(*[col(n) for n in names]))
    vocabulary, wide = vocabularies(learned, names, widest)
    codes = {}
    for name, categories in vocabulary.items():
        places = F.create_map(*[F.lit(x) for i, c in enumerate(categories) for x in (c, i)]) if categories else None
        unseen = F.lit(len(categories))
        code = F.coalesce(F.element_at(places, col(name)), unseen) if categories else unseen
        codes[name] = code.cast("bigint")
    coded = filled.withColumns(codes) if codes else filled
    for name in wide:
        coded = encode_wide(coded, learned, name, key)
    return coded


def encode_wide(
    df: DataFrame, train: DataFrame, name: str, key: str, output: str | None = None
) -> DataFrame:
    """Replace a column of very many categories by its train index.

    The index table is a distributed sort of the distinct values. It is
    broadcast only if its counted size is small. Otherwise the rows of frequent
    categories are spread over salts, so that none is looked up in one task.
    """
    return look_up(df, word_index(train, name), name, key, output)


def word_index(train: DataFrame, name: str) -> DataFrame:
    """word and code of every category of a text column, numbered in sorted order."""
    word = col(name).cast("string")
    distinct = train.filter(word.isNotNull()).groupBy(word.alias("word")).agg(F.lit(1)).select("word")
    return session.cut_lineage(with_ordinal(distinct, [F.asc("word")], "code"))


def look_up(
    df: DataFrame, index: DataFrame, name: str, key: str, output: str | None = None
) -> DataFrame:
    """Replace a column by its code in an index table; unseen words get the next number."""
    index = index.select(F.col("word").alias("_word"), F.col("code").alias("_code"))
    size = index.count()
    value = col(name).cast("string")
    if session.small_enough(index, "_word"):
        looked = df.join(F.broadcast(index), value == F.col("_word"), "left")
    else:
        # One word for so many rows at most, hence broadcast.
        counts = df.groupBy(value.alias("_hot")).agg(F.count("*").alias("n"))
        hot = F.broadcast(session.cut_lineage(counts.where((F.col("n") > HOT_ROWS) & F.col("_hot").isNotNull()).select("_hot")))
        is_hot = F.col("_hot").isNotNull()
        salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_KEY_SALTS - 1))).otherwise(F.array(F.lit(0)))
        spread = index.join(hot, F.col("_word") == F.col("_hot"), "left").withColumn("_salt", F.explode(salts)).drop("_hot")
        salt = F.pmod(F.xxhash64(col(key)), F.lit(HOT_KEY_SALTS)).cast("int")
        salted = df.join(hot, value == F.col("_hot"), "left")
        salted = salted.withColumn("_salt_of_row", F.when(is_hot | value.isNull(), salt).otherwise(F.lit(0))).drop("_hot")
        # The planner's size of a stored index is that of its file; it must not be sent whole to the driver.
        looked = salted.join(
            spread.hint("merge"), (value == F.col("_word")) & (F.col("_salt_of_row") == F.col("_salt")), "left"
        ).drop("_salt", "_salt_of_row")
    code = F.when(value.isNotNull(), F.coalesce("_code", F.lit(size))).cast("bigint")
    coded = looked.withColumn(output or name, code).drop("_word", "_code")
    return coded.drop(name) if output and output != name else coded


def one_hot_vector(df: DataFrame, index: str, name: str) -> tuple[DataFrame, OneHotEncoderModel]:
    """Sparse vector column from an index column, for wide vocabularies."""
    encoder = OneHotEncoder(
        inputCols=[index], outputCols=[name], dropLast=False, handleInvalid="keep"
    )
    model = encoder.fit(df)
    return model.transform(df), model


# -- feature matrix ----------------------------------------------------------

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
)


def feature_report(
    df: DataFrame,
    target: str = domain.TARGET,
    least_share: float = 0.5,
    technical: Sequence[str] = (domain.ROW_KEY, "split"),
) -> DataFrame:
    """Per column whether it can be a feature, and the parseable share of text.

    Numbers and booleans qualify by type; text qualifies when more than
    ``least_share`` of all rows read as numbers, measured in one aggregate.
    """
    skipped = {target, "target", *technical}
    fields = [f for f in df.schema.fields if f.name not in skipped]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    shares = df.agg(
        F.count("*").alias("rows"),
        *[F.count(number_of(df, n)).alias(f"t{i}") for i, n in enumerate(texts)],
    )
    cells = []
    for f in fields:
        if f.name in texts:
            parsed = F.col(f"t{texts.index(f.name)}").cast("double")
            share = F.coalesce(F.try_divide(parsed, F.col("rows").cast("double")), F.lit(0.0))
            kind = "text"
            is_feature = share > least_share
        else:
            numeric = isinstance(f.dataType, NUMERIC_TYPES)
            share = F.lit(1.0 if numeric else 0.0)
            kind = "number" if numeric else "other"
            is_feature = F.lit(numeric) & (F.col("rows") > 0)
        cells.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(kind).alias("kind"),
                share.alias("numeric_share"),
                is_feature.alias("is_feature"),
            )
        )
    return shares.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def detect_features(df: DataFrame, **options) -> list[str]:
    """Names of the usable features, in the order of the table."""
    found = {r["column_name"] for r in feature_report(df, **options).filter("is_feature").collect()}
    return [n for n in df.columns if n in found]


def numeric_matrix(df: DataFrame, features: Sequence[str], kept: Sequence[str] = ()) -> DataFrame:
    """Features as doubles with missing, NaN and infinite values as 0.0."""
    values = [finite_or_zero(number_of(df, n)).alias(n) for n in features]
    return df.select(*[col(n) for n in kept if n not in features], *values)


def assemble(
    df: DataFrame, features: Sequence[str], kept: Sequence[str] = (), name: str = "features"
) -> DataFrame:
    """Kept columns plus one vector column of the features."""
    matrix = numeric_matrix(df, features, kept)
    # vector slots are addressed by position, so the assembler never meets odd names
    renamed = matrix.select(
        *[col(n) for n in kept], *[col(n).alias(f"_f{i}") for i, n in enumerate(features)]
    )
    inputs = [f"_f{i}" for i in range(len(features))]
    return VectorAssembler(inputCols=inputs, outputCol=name).transform(renamed).drop(*inputs)


AUDIT_RULES = "rule string, passed boolean, offending string"


def leakage_audit(
    features: DataFrame,
    spec: FeatureSpec | None = None,
    source: DataFrame | None = None,
    params: FitParams | None = None,
    dropped: Sequence[str] = domain.LEAKING_COLUMNS,
) -> DataFrame:
    """Rules the feature layer must keep, one row each with pass or fail.

    The first rules look at the schema and at the keys of the two parts. With
    ``source``, the rows before features were made (row key, split and
    columns), it is also checked by value whether a dropped column is back
    under another name, and with ``params`` whether they are what the train
    rows of ``source`` give.
    """
    spec = spec or FeatureSpec()
    columns = set(features.columns)
    parts = ("direct_loss_usd", "indirect_loss_usd")
    rules = [
        ("no_column_known_only_afterwards", sorted(columns & set(domain.LEAKING_COLUMNS))),
        ("no_audit_column", sorted(columns & set(domain.AUDIT_COLUMNS))),
        ("no_identifier_as_feature", sorted(columns & {domain.KEY})),
        ("no_part_of_the_target", sorted(columns & set(parts))),
        ("no_text_left_of_encoded_columns", sorted(columns & set(spec.nominal))),
        ("split_recorded", [] if "split" in columns else ["split"]),
    ]
    rows = [(rule, not bad, ",".join(bad)) for rule, bad in rules]
    if {"split", spec.row_key} <= columns:
        rows.append(_cut_by_key(features, spec.row_key))
    if source is not None:
        rows.append(_hidden_columns(features, source, spec.row_key, dropped))
    if source is not None and params is not None:
        rows.append(_fitted_on_train(source, params, spec))
    return features.sparkSession.createDataFrame(rows, AUDIT_RULES)


def _cut_by_key(features: DataFrame, key: str) -> tuple[str, bool, str]:
    """Every train key stands before every test key."""
    is_train = F.col("split") == "train"
    row = features.agg(F.max(F.when(is_train, col(key))).alias("last"), F.min(F.when(~is_train, col(key))).alias("first")).first()
    overlap = None not in (row["last"], row["first"]) and row["last"] >= row["first"]
    return "no_train_key_after_the_cut", not overlap, str(row["last"]) if overlap else ""


DEPENDENCIES = "dropped string, feature string, kind string"
# Rows by which pairs of columns are refused before the whole table is read for those left, and
# parts in which the order of values is checked.
PROBES = 2000
ORDER_PARTS = 64
# Share of the variance that a straight line explains.
STRAIGHT = 1 - 1e-9


def hidden_dependencies(
    features: DataFrame, source: DataFrame, key: str, dropped: Sequence[str] = domain.LEAKING_COLUMNS
) -> DataFrame:
    """Features that say the same as a dropped column of ``source``, by value, with the closest ``kind``.

    ``equal``: the same text in all rows, NULL for NULL. The other kinds look at the rows where the dropped
    column is held, in which the feature may not be NULL and each value of one column has one value of
    the other: ``affine`` and ``monotone`` for numbers of three values or more, ``recoded`` for two values or
    more that stand in two rows each on average (columns without repeated values always match).

    Rows of the smallest key hashes refuse most pairs: a pair that fails among some rows fails among all. Only
    pairs left are counted over the whole tables, so the verdict does not depend on these rows.
    """
    gone = [n for n in dropped if n in source.columns]
    shown = [n for n in features.columns if n not in (key, "split")]
    left = features.select(col(key), *[_storable(features, n).alias(f"_f{j}") for j, n in enumerate(shown)])
    right = source.select(col(key), *[_storable(source, n).alias(f"_d{i}") for i, n in enumerate(gone)])
    numbers = {n for df in (left, right) for n, t in df.dtypes if t in NUMBERS or t.startswith("decimal")}
    few = right.orderBy(F.xxhash64(col(key)), col(key)).limit(PROBES).join(left, key)
    texts = [F.col(n).cast("double" if n in numbers else "string").alias(n) for n in left.columns + right.columns if n != key]
    probes = few.select(*texts).collect() if gone and shown else []
    pairs = [(f"_d{i}", f"_f{j}") for i in range(len(gone)) for j in range(len(shown))]
    held = {n: [row[n] for row in probes] for n in (probes[0].asDict() if probes else ())}
    pairs = [(d, f) for d, f in pairs if probes and _may_depend(held[d], held[f])]
    rows = []
    if pairs:
        joined = left.join(right, key).select(*sorted({n for pair in pairs for n in pair}))
        path = session.fresh_path(joined.sparkSession, "dependencies")
        joined.write.parquet(path)
        joined = joined.sparkSession.read.parquet(path)
        for (d, f), kind in _dependencies(joined, pairs, numbers, held).items():
            rows.append((gone[int(d[2:])], shown[int(f[2:])], kind))
    return features.sparkSession.createDataFrame(sorted(rows), DEPENDENCIES)


def _storable(df: DataFrame, name: str) -> Column:
    return col(name).cast("string") if dict(df.dtypes)[name] == "void" else col(name)


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _may_depend(dropped: Sequence, feature: Sequence) -> bool:
    """False if these rows rule out every kind."""
    both = {(d, f) for d, f in zip(dropped, feature) if d is not None}
    return len(both) == len({d for d, _ in both}) == len({f for _, f in both})


def _dependencies(
    joined: DataFrame, pairs: Sequence[tuple[str, str]], numbers: set[str], probes: Mapping[str, Sequence]
) -> dict[tuple[str, str], str]:
    """Kinds of the pairs that hold over all rows of ``joined``.

    One aggregate counts rows, one for each column groups its values, and one for each order to check is made. Each
    groups by one column alone, so rows are neither multiplied by the pairs nor do pairs stand side by side in a key.
    """
    parts = [F.count("*").alias("rows")]
    for n, (d, f) in enumerate(pairs):
        there = F.col(d).isNotNull()
        parts += [
            F.count_if(F.col(d).cast("string").eqNullSafe(F.col(f).cast("string"))).alias(f"same_{n}"),
            F.count(F.col(d)).alias(f"held_{n}"),
            F.count_if(there & F.col(f).isNull()).alias(f"open_{n}"),
        ]
        if {d, f} <= numbers:
            parts.append(F.regr_r2(F.col(f).cast("double"), F.col(d).cast("double")).alias(f"line_{n}"))
    seen = joined.agg(*parts).first().asDict()
    equal = [p for n, p in enumerate(pairs) if seen[f"held_{n}"] and seen[f"same_{n}"] == seen["rows"]]
    kinds = {pair: "equal" for pair in equal}
    closed = [p for n, p in enumerate(pairs) if p not in kinds and not seen[f"open_{n}"]]
    sizes = {}
    for d in sorted({d for d, _ in closed}):
        sizes[d], clear = _partners(joined, d, [f for x, f in closed if x == d])
        closed = [(x, f) for x, f in closed if x != d or (f in clear and sizes[d] >= 2)]
    for f in sorted({f for _, f in closed}):
        _, clear = _partners(joined, f, [d for d, x in closed if x == f])
        closed = [(d, x) for d, x in closed if x != f or d in clear]
    for n, (d, f) in enumerate(pairs):
        if (d, f) not in closed:
            continue
        values = sizes[d]
        if values >= 3 and (seen.get(f"line_{n}") or 0) >= STRAIGHT:
            kinds[d, f] = "affine"
        elif values >= 3 and {d, f} <= numbers and _keeps_order(joined, d, f, probes[d]):
            kinds[d, f] = "monotone"
        elif 2 * values <= seen[f"held_{n}"]:
            kinds[d, f] = "recoded"
    return kinds


def _partners(joined: DataFrame, name: str, others: Sequence[str]) -> tuple[int, set[str]]:
    """How many values the column has, and the columns of which each of these has no two values."""
    ends = [end for i, n in enumerate(others) for end in (F.min(n).alias(f"low_{i}"), F.max(n).alias(f"high_{i}"))]
    groups = joined.where(F.col(name).isNotNull()).groupBy(name).agg(*ends)
    mixed = [F.count_if(F.col(f"low_{i}") < F.col(f"high_{i}")).alias(f"mixed_{i}") for i in range(len(others))]
    row = groups.agg(F.count("*").alias("values"), *mixed).first()
    return row["values"], {n for i, n in enumerate(others) if not row[f"mixed_{i}"]}


def _keeps_order(joined: DataFrame, d: str, f: str, probes: Sequence) -> bool:
    """Whether ``f`` always rises, or always falls, with ``d``: steps inside parts of the range, then from part to part."""
    known = sorted({x for x in probes if x is not None})
    cuts = known[:: max(len(known) // ORDER_PARTS, 1)]
    values = joined.where(F.col(d).isNotNull()).groupBy(F.col(d).cast("double").alias("d")).agg(F.min(F.col(f).cast("double")).alias("f"))
    part = reduce(lambda total, cut: total + (F.col("d") > cut).cast("int"), cuts, F.lit(0))
    before = F.lag("f").over(Window.partitionBy("part").orderBy("d"))
    steps = values.withColumn("part", part).withColumn("step", F.col("f") - before)
    ranges = steps.groupBy("part").agg(
        F.min("step").alias("least"), F.max("step").alias("most"), F.min("f").alias("low"), F.max("f").alias("high")
    )
    ranges = sorted(ranges.collect(), key=lambda r: r["part"])
    rises = all(r["least"] is None or r["least"] > 0 for r in ranges) and all(a["high"] < b["low"] for a, b in pairwise(ranges))
    falls = all(r["most"] is None or r["most"] < 0 for r in ranges) and all(a["low"] > b["high"] for a, b in pairwise(ranges))
    return rises or falls


def _hidden_columns(
    features: DataFrame, source: DataFrame, key: str, dropped: Sequence[str]
) -> tuple[str, bool, str]:
    """No dropped column is back as a feature, as it was or in other words."""
    found = hidden_dependencies(features, source, key, dropped).collect()
    bad = sorted(f"{r['dropped']}={r['feature']}" for r in found)
    return "no_dropped_column_under_another_name", not bad, ",".join(bad)


def _fitted_on_train(source: DataFrame, params: FitParams, spec: FeatureSpec) -> tuple[str, bool, str]:
    """Fitting on the train rows again gives the same parameters."""
    again = fit(source.filter(F.col("split") == "train"), spec)
    bad = [n for n in ("fence", "z_low", "z_high") if not _near(getattr(params, n), getattr(again, n))]
    for kind in ("medians", "means", "deviations"):
        old, new = getattr(params, kind), getattr(again, kind)
        bad += [f"{kind}.{n}" for n in sorted({*old, *new}) if not _near(old.get(n), new.get(n))]
    bad += [] if dict(params.vocabulary) == dict(again.vocabulary) else ["vocabulary"]
    return "parameters_are_those_of_train", not bad, ",".join(bad)


def _near(one: float | None, other: float | None) -> bool:
    """Equal but for the order in which a sum was added up."""
    if one is None or other is None:
        return one is other
    return math.isclose(one, other, rel_tol=1e-9, abs_tol=1e-12)
