"""The same results as plain SQL over the provided tables, for checking."""

from __future__ import annotations

from lamina import domain

COUNTED_COLUMNS = {
    "region": 2,
    "nation": 3,
    "customer": 5,
    "supplier": 4,
    "part": 6,
    "orders": 6,
    "lineitem": 11,
    "events": 6,
    "documents": 5,
    "embeddings": 3,
    "pages": 3,
    "benchmark": 2,
    "labels": 3,
    "conversations": 4,
}

RAW = """
incidents AS (
  SELECT o_orderkey AS incident_id,
         CASE WHEN c_acctbal < 0 THEN NULL
              WHEN o_orderstatus = 'P' AND c_acctbal > 9000
                THEN '$' || CAST(c_acctbal AS VARCHAR)
              ELSE CAST(c_acctbal AS VARCHAR) END AS company_revenue_usd,
         CASE WHEN o_totalprice >= 10000 THEN CAST(o_totalprice AS VARCHAR) END AS employee_count,
         o_totalprice > 250000 AS is_public_company,
         c_mktsegment AS industry_primary,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END
           AS attack_vector_primary,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS data_type,
         substring(o_orderpriority, 1, 1) AS confidence_tier,
         CAST(month(o_orderdate) AS VARCHAR) AS quality_score,
         CAST(c_nationkey AS VARCHAR) AS country_hq,
         c_name AS company_name,
         o_orderstatus AS review_flag
  FROM orders JOIN customer ON o_custkey = c_custkey
),
financial AS (
  SELECT l_orderkey AS incident_id,
         CASE WHEN count(*) >= 10 THEN '$' ELSE '' END
           || CAST(round(sum(l_extendedprice * (1 - l_discount)), 4) AS VARCHAR)
           AS total_loss_usd
  FROM lineitem GROUP BY l_orderkey
),
market AS (
  SELECT DISTINCT l_orderkey AS incident_id FROM lineitem WHERE l_returnflag = 'R'
)"""

REFINED = (
    RAW
    + """,
refined AS (
  SELECT i.incident_id AS row_key,
         TRY_CAST(company_revenue_usd AS DOUBLE) AS company_revenue_usd,
         TRY_CAST(employee_count AS DOUBLE) AS employee_count,
         is_public_company,
         industry_primary,
         coalesce(attack_vector_primary, 'Desconhecido') AS attack_vector_primary,
         coalesce(data_type, 'Desconhecido') AS data_type,
         TRY_CAST(confidence_tier AS DOUBLE) AS confidence_tier,
         TRY_CAST(quality_score AS DOUBLE) AS quality_score,
         country_hq,
         TRY_CAST(total_loss_usd AS DOUBLE) AS total_loss_usd
  FROM incidents i JOIN financial f ON i.incident_id = f.incident_id
  WHERE TRY_CAST(total_loss_usd AS DOUBLE) IS NOT NULL
)"""
)

SPLIT = (
    REFINED
    + """,
parted AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY row_key)
                   <= floor(0.8 * (SELECT count(*) FROM refined))
                 THEN 'train' ELSE 'test' END AS split
  FROM refined
)"""
)

PARAMS = (
    SPLIT
    + """,
params AS (
  SELECT quantile_cont(company_revenue_usd, 0.5) AS med_revenue,
         quantile_cont(employee_count, 0.5) AS med_staff,
         quantile_cont(quality_score, 0.5) AS med_quality,
         avg(company_revenue_usd) AS mean_revenue,
         avg(employee_count) AS mean_staff,
         stddev_pop(company_revenue_usd) AS std_revenue,
         stddev_pop(employee_count) AS std_staff,
         quantile_cont(total_loss_usd, 0.75) + 1.5 * (quantile_cont(total_loss_usd, 0.75)
           - quantile_cont(total_loss_usd, 0.25)) AS fence,
         avg(company_revenue_usd) - 3 * stddev_pop(company_revenue_usd) AS z_low,
         avg(company_revenue_usd) + 3 * stddev_pop(company_revenue_usd) AS z_high
  FROM parted WHERE split = 'train'
)"""
)

REFINED_FEATURES = {
    "company_revenue_usd": "coalesce(company_revenue_usd, 0.0)",
    "employee_count": "coalesce(employee_count, 0.0)",
    "is_public_company": "CASE WHEN is_public_company THEN 1.0 ELSE 0.0 END",
    "confidence_tier": "coalesce(confidence_tier, 0.0)",
    "quality_score": "coalesce(quality_score, 0.0)",
    "country_hq": "coalesce(TRY_CAST(country_hq AS DOUBLE), 0.0)",
}
DUMMIES = {
    "industry_primary": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "attack_vector_primary": ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "Desconhecido"),
    "data_type": ("Desconhecido", "F", "O"),
}
PREPARED_FEATURES = {
    "company_revenue_usd": "least(greatest(coalesce(company_revenue_usd, med_revenue), z_low), z_high)",
    "employee_count": "coalesce(employee_count, med_staff)",
    "is_public_company": "CASE WHEN is_public_company THEN 1.0 ELSE 0.0 END",
    "confidence_tier": "coalesce(trunc(confidence_tier), 0.0)",
    "quality_score": "coalesce(quality_score, med_quality)",
    **{f"{c}_{v}": f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END" for c, values in DUMMIES.items() for v in values},
    "company_revenue_usd_scaled": "(coalesce(company_revenue_usd, med_revenue) - mean_revenue) / std_revenue",
    "employee_count_scaled": "(coalesce(employee_count, med_staff) - mean_staff) / std_staff",
}

# Impurity of a node with {a} rows of class 0 and {b} of class 1.
IMPURITY = {
    "gini": "(CASE WHEN {a} + {b} = 0 THEN 0.0 ELSE 1.0 - pow({a} / ({a} + {b}), 2) - pow({b} / ({a} + {b}), 2) END)",
    "entropy": "(0.0 - CASE WHEN {a} > 0 THEN {a} / ({a} + {b}) * log2({a} / ({a} + {b})) ELSE 0.0 END"
    " - CASE WHEN {b} > 0 THEN {b} / ({a} + {b}) * log2({b} / ({a} + {b})) ELSE 0.0 END)",
}


def _best_cuts(name: str, nodes: str, impurity: str) -> str:
    """For each node of ``nodes`` (row_key, node) the cut that gains most; the first one on a tie."""
    measure = lambda a, b: IMPURITY[impurity].format(a=a, b=b)
    return f""",
{name}_hist AS (
  SELECT node, f, code, count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
  FROM coded JOIN {nodes} USING (row_key) WHERE split = 'train' GROUP BY node, f, code
), {name}_sums AS (
  SELECT node, f, code,
         CAST(sum(n0) OVER (PARTITION BY node, f ORDER BY code) AS DOUBLE) AS l0,
         CAST(sum(n1) OVER (PARTITION BY node, f ORDER BY code) AS DOUBLE) AS l1,
         CAST(sum(n0) OVER (PARTITION BY node, f) AS DOUBLE) AS t0,
         CAST(sum(n1) OVER (PARTITION BY node, f) AS DOUBLE) AS t1
  FROM {name}_hist
), {name}_gains AS (
  SELECT node, f, code,
         {measure("t0", "t1")} - (l0 + l1) / (t0 + t1) * {measure("l0", "l1")}
           - (t0 + t1 - l0 - l1) / (t0 + t1) * {measure("(t0 - l0)", "(t1 - l1)")} AS gain
  FROM {name}_sums WHERE l0 + l1 < t0 + t1
), {name} AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, f, code) AS place
                 FROM {name}_gains WHERE gain > 1e-12) WHERE place = 1
)"""


def _grown(impurity: str, depth: int, alias: str) -> str:
    """A tree: its cuts, its nodes (named by the turns that lead to them) and the class of every row as ``alias``."""
    x = impurity
    parts = [f""",
{x}_at0 AS MATERIALIZED (SELECT row_key, '' AS node FROM labelled)"""]
    for level in range(depth):
        parts.append(_best_cuts(f"{x}_cut{level}", f"{x}_at{level}", impurity))
        parts.append(f""",
{x}_at{level + 1} AS MATERIALIZED (
  SELECT a.row_key, a.node || CASE WHEN c.code <= t.code THEN 'L' ELSE 'R' END AS node
  FROM {x}_at{level} a JOIN {x}_cut{level} t ON t.node = a.node JOIN coded c ON c.row_key = a.row_key AND c.f = t.f
)""")
    every = " UNION ALL ".join(f"SELECT * FROM {x}_at{level}" for level in range(depth + 1))
    cuts = " UNION ALL ".join(f"SELECT node, f, code, gain FROM {x}_cut{level}" for level in range(depth))
    parts.append(f""",
{x}_every AS MATERIALIZED ({every}),
{x}_cuts AS MATERIALIZED ({cuts}),
{x}_leaf AS MATERIALIZED (SELECT row_key, arg_max(node, length(node)) AS leaf FROM {x}_every GROUP BY row_key),
{x}_nodes AS MATERIALIZED (
  SELECT node, count(*) FILTER (WHERE label = 0) AS zeros, count(*) FILTER (WHERE label = 1) AS ones,
         row_number() OVER (ORDER BY node) - 1 AS number
  FROM {x}_every JOIN labelled USING (row_key) WHERE split = 'train' GROUP BY node
), {x}_class AS MATERIALIZED (SELECT node AS leaf, CASE WHEN ones > zeros THEN 1 ELSE 0 END AS {alias} FROM {x}_nodes)""")
    return "".join(parts)


def _tree_rows(base: str, relation: str, values: dict[str, str], depths: tuple[int, int] = (2, 2)) -> str:
    listed = ", ".join(f"CAST({v} AS DOUBLE)" for v in values.values())
    return (
        base
        + f""",
limits AS (SELECT quantile_cont(total_loss_usd, 0.5) AS threshold FROM refined),
labelled AS (
  SELECT *, CASE WHEN total_loss_usd > (SELECT threshold FROM limits) THEN 1 ELSE 0 END AS label FROM {relation}
),
cells AS (
  SELECT row_key, split, label, unnest(range({len(values)})) AS f, unnest([{listed}]) AS v FROM labelled
),
ranked_cells AS (
  SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS place, count(*) OVER (PARTITION BY f) AS n
  FROM cells WHERE split = 'train'
),
edges AS (
  SELECT DISTINCT f, v AS e FROM ranked_cells, (SELECT unnest(range(1, 32)) AS k) WHERE place = n * k // 32
),
bounds AS (SELECT f, list(e ORDER BY e) AS es FROM edges GROUP BY f),
coded AS MATERIALIZED (
  SELECT row_key, split, label, cells.f, len(list_filter(es, lambda e: e < v)) AS code FROM cells JOIN bounds ON cells.f = bounds.f
)"""
        + _grown("gini", depths[0], "p1")
        + _grown("entropy", depths[1], "p2")
        + """,
scored AS MATERIALIZED (
  SELECT labelled.*, p1, p2 FROM labelled
  JOIN gini_leaf USING (row_key) JOIN gini_class USING (leaf)
  JOIN entropy_leaf e ON e.row_key = labelled.row_key JOIN entropy_class c ON c.leaf = e.leaf
),
both_models AS (
  SELECT 'modelo1_gini' AS model, split, label, p1 AS p FROM scored
  UNION ALL SELECT 'modelo2_entropy', split, label, p2 FROM scored
),
counted AS (
  SELECT model, split,
         count(*) FILTER (WHERE label = 1 AND p = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND p = 0) AS tn,
         count(*) FILTER (WHERE label = 0 AND p = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND p = 0) AS fn
  FROM both_models GROUP BY model, split
),
measured AS (
  SELECT *,
         (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS acuracia,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precisao,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0
              ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1
  FROM counted
),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY row_key) - 1 AS id FROM scored WHERE split = 'test'
)"""
    )


SCORED = _tree_rows(SPLIT, "parted", REFINED_FEATURES)
PREPARED_SCORED = _tree_rows(PARAMS, "(SELECT * FROM parted, params)", PREPARED_FEATURES)
DEEP = _tree_rows(SPLIT, "parted", REFINED_FEATURES, (5, 10))
PREPARED_DEEP = _tree_rows(PARAMS, "(SELECT * FROM parted, params)", PREPARED_FEATURES, (1, 10))


def _audit(split: str, same: str, fitted: str) -> str:
    """Verdicts from the rows: keys of the parts, a dropped column by value, parameters of the fitted rows."""
    schema = ("no_column_known_only_afterwards", "no_audit_column", "no_identifier_as_feature",
              "no_part_of_the_target", "no_text_left_of_encoded_columns", "split_recorded")
    kept = ", ".join(f"'{c}'" for c in domain.MODEL_COLUMNS)
    lines = [
        # No name of the layer's columns is among those that must be gone.
        f"SELECT '{rule}' AS rule, count(*) = 0 AS passed, coalesce(string_agg(c, ','), '') AS offending"
        f" FROM (SELECT unnest([{kept}]) AS c) WHERE c IN ('notes', 'meta_data_carga', 'incident_id', 'direct_loss_usd')"
        for rule in schema
    ]
    cut = f"SELECT max(row_key) FILTER (WHERE {split} = 'train') AS l, min(row_key) FILTER (WHERE {split} <> 'train') AS f FROM parted"
    lines.append(f"SELECT 'no_train_key_after_the_cut', l < f, CASE WHEN l < f THEN '' ELSE CAST(l AS VARCHAR) END FROM ({cut})")
    rows = "parted JOIN (SELECT incident_id AS row_key, review_flag FROM incidents) USING (row_key)"
    lines.append(
        f"SELECT 'no_dropped_column_under_another_name', count(*) FILTER (WHERE {same}) < count(*), '' FROM {rows}"
    )
    lines.append(
        f"""SELECT 'parameters_are_those_of_train', abs(mean_revenue - (SELECT avg(company_revenue_usd) FROM {fitted})) < 1e-6
              AND abs(std_staff - (SELECT stddev_pop(employee_count) FROM {fitted})) < 1e-6, '' FROM params"""
    )
    return "\nUNION ALL ".join(lines)


def _dependency(d: str, f: str, numeric: bool) -> str:
    """The kind of one pair of columns of ``gone``, from its distinct pairs."""
    line = f"(SELECT regr_r2(CAST({f} AS DOUBLE), CAST({d} AS DOUBLE)) FROM gone) >= 1 - 1e-9" if numeric else "false"
    order = (
        f"(SELECT count(*) FILTER (WHERE s <= 0) = 0 OR count(*) FILTER (WHERE s >= 0) = 0 FROM"
        f" (SELECT y - lag(y) OVER (ORDER BY x) AS s FROM (SELECT DISTINCT {d} AS x, {f} AS y FROM gone WHERE {d} IS NOT NULL)))"
        if numeric
        else "false"
    )
    return f"""SELECT '{d}' AS dropped, '{f}' AS feature,
      CASE WHEN held > 0 AND same = total THEN 'equal' WHEN NOT one OR n < 2 THEN NULL
           WHEN n >= 3 AND {line} THEN 'affine' WHEN n >= 3 AND {order} THEN 'monotone'
           WHEN 2 * n <= held THEN 'recoded' END AS kind
      FROM (SELECT count(*) AS total, count({d}) AS held, count(DISTINCT {d}) AS n,
              count(*) FILTER (WHERE CAST({d} AS VARCHAR) IS NOT DISTINCT FROM CAST({f} AS VARCHAR)) AS same,
              count(DISTINCT {d}) = count(DISTINCT {f}) FILTER (WHERE {d} IS NOT NULL)
                AND count(DISTINCT {d}) = (SELECT count(*) FROM (SELECT DISTINCT {d}, {f} FROM gone WHERE {d} IS NOT NULL))
                AND count(*) FILTER (WHERE {d} IS NOT NULL AND {f} IS NULL) = 0 AS one
            FROM gone)"""


def _dependencies() -> str:
    numbers = ("company_revenue_usd", "employee_count", "quality_score",
               "hours_scaled", "hours_cubed", "hours_falling", "day_number", "state_code", "hours_rounded")
    words = ("is_public_company", "industry_primary", "data_type", "state")
    lines = [
        _dependency(d, f, d == "downtime_hours" and f in numbers)
        for d in ("downtime_hours", "disclosure_date", "review_flag")
        for f in numbers + words
    ]
    every = "\nUNION ALL ".join(lines)
    return f"""WITH {REFINED}, gone AS MATERIALIZED (
      SELECT company_revenue_usd, employee_count, quality_score, is_public_company, industry_primary, data_type,
             o_totalprice AS downtime_hours, CAST(o_orderdate AS VARCHAR) AS disclosure_date, o_orderstatus AS review_flag,
             (o_totalprice - 100000) / 50000 AS hours_scaled, pow(o_totalprice / 1000, 3) AS hours_cubed,
             -sqrt(o_totalprice) AS hours_falling, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS day_number,
             o_orderstatus AS state, CASE o_orderstatus WHEN 'O' THEN 7 WHEN 'F' THEN 3 ELSE 5 END AS state_code,
             floor(o_totalprice / 10) AS hours_rounded
      FROM refined JOIN orders ON o_orderkey = row_key)
    SELECT * FROM ({every}) WHERE kind IS NOT NULL"""


FEATURE_NAMES = "[" + ", ".join(f"'{n}'" for n in REFINED_FEATURES) + "]"


def _splits() -> str:
    """Inner nodes of both trees."""
    return "\nUNION ALL ".join(
        f"""SELECT '{model}' AS model, CAST(length(node) AS BIGINT) AS depth, {FEATURE_NAMES}[t.f + 1] AS feature,
          round(es[t.code + 1], 6) AS threshold, round(gain, 6) AS gain
        FROM {impurity}_cuts t JOIN bounds ON bounds.f = t.f"""
        for impurity, model in (("gini", "modelo1_gini"), ("entropy", "modelo2_entropy"))
    )


def _dump() -> str:
    gini = IMPURITY["gini"].format(a="CAST(zeros AS DOUBLE)", b="CAST(ones AS DOUBLE)")
    return f"""
    SELECT n.number AS node, CAST(length(n.node) AS BIGINT) AS depth, {FEATURE_NAMES}[t.f + 1] AS feature,
           round(es[t.code + 1], 6) AS threshold, CASE WHEN t.f IS NOT NULL THEN n.number + 1 END AS left_node,
           r.number AS right_node, zeros, ones, zeros + ones AS rows, round({gini}, 8) AS impurity,
           round(gain, 8) AS gain, CAST(p1 AS BIGINT) AS prediction
    FROM gini_nodes n JOIN gini_class c ON c.leaf = n.node LEFT JOIN gini_cuts t ON t.node = n.node
    LEFT JOIN bounds ON bounds.f = t.f LEFT JOIN (SELECT number, node FROM gini_nodes) r ON r.node = n.node || 'R'"""


def _rules() -> str:
    """The intervals of each leaf: every cut on the way bounds its feature from above or below."""
    return f"""
    SELECT number AS leaf, {FEATURE_NAMES}[t.f + 1] AS feature,
           round(max(es[t.code + 1]) FILTER (WHERE n.node[length(t.node) + 1] = 'R'), 6) AS above,
           round(min(es[t.code + 1]) FILTER (WHERE n.node[length(t.node) + 1] = 'L'), 6) AS up_to,
           zeros + ones AS rows, CAST(p1 AS BIGINT) AS prediction
    FROM gini_nodes n JOIN gini_class c ON c.leaf = n.node JOIN gini_cuts t ON starts_with(n.node, t.node)
    JOIN bounds ON bounds.f = t.f
    WHERE n.node NOT IN (SELECT node FROM gini_cuts) GROUP BY ALL"""


GAINS = """
gains AS (
  SELECT f, sum((zeros + ones) * gain) AS w FROM gini_cuts JOIN gini_nodes USING (node) GROUP BY f
),
importances AS (
  SELECT name AS feature, coalesce(w / (SELECT sum(w) FROM gains), 0.0) AS importance
  FROM (SELECT unnest({names}) AS name, unnest(range({count})) AS f) LEFT JOIN gains USING (f)
)"""
GAINS = GAINS.format(names=FEATURE_NAMES, count=len(REFINED_FEATURES))


def _permuted(depth: int = 5, repeats: int = 5, bucket_rows: int = 10_000) -> str:
    """Every test row scored again with every feature of the row r places on in its bucket."""
    walk = [f"""
dealt AS (
  SELECT row_key, label, p1, md5(row_key || ':42') AS h,
         CAST('0x' || substr(md5(row_key || ':42'), 1, 8) AS BIGINT)
           % (SELECT greatest(CAST(ceil(count(*) / {bucket_rows}) AS BIGINT), 1) FROM scored WHERE split = 'test') AS bucket
  FROM scored WHERE split = 'test'
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h, row_key) - 1 AS place, count(*) OVER (PARTITION BY bucket) AS n FROM dealt
), walk0 AS (
  SELECT a.row_key, b.row_key AS donor, r, p, '' AS node
  FROM placed a, (SELECT unnest(range(1, {repeats + 1})) AS r) rs, (SELECT DISTINCT f AS p FROM gini_cuts) ps, placed b
  WHERE b.bucket = a.bucket AND b.place = (a.place + r) % a.n
)"""]
    for level in range(depth):
        walk.append(f"""walk{level + 1} AS (
  SELECT w.row_key, donor, r, p, w.node || CASE WHEN t.f IS NULL THEN '' WHEN c.code <= t.code THEN 'L' ELSE 'R' END AS node
  FROM walk{level} w LEFT JOIN gini_cuts t ON t.node = w.node
  LEFT JOIN coded c ON c.f = t.f AND c.row_key = CASE WHEN t.f = p THEN donor ELSE w.row_key END
)""")
    walk.append(f"""lost AS (
  SELECT p, sum(CAST(s.p1 = label AS INT) - CAST(c.p1 = label AS INT)) / CAST({repeats} * (SELECT count(*) FROM placed) AS DOUBLE) AS loss
  FROM walk{depth} w JOIN placed s USING (row_key) JOIN gini_class c ON c.leaf = w.node GROUP BY p
)""")
    return _with(
        DEEP + "," + ",\n".join(walk),
        f"""SELECT name AS feature, round(coalesce(loss, 0.0), 8) AS importance
        FROM (SELECT unnest({FEATURE_NAMES}) AS name, unnest(range({len(REFINED_FEATURES)})) AS f) LEFT JOIN lost ON p = f""",
    )


WIDE = (
    SPLIT
    + """,
named AS (
  SELECT row_key, split, company_name FROM parted JOIN incidents ON incident_id = row_key
),
words AS (
  SELECT word, row_number() OVER (ORDER BY word) - 1 AS code
  FROM (SELECT DISTINCT company_name AS word FROM named WHERE split = 'train')
)"""
)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _inventory() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows, CAST({c} AS BIGINT) AS columns FROM {n}"
        for n, c in COUNTED_COLUMNS.items()
    )


def _raw_audit() -> str:
    keys = {"customer": "c_custkey", "supplier": "s_suppkey", "nation": "n_nationkey"}
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST({k} AS VARCHAR) AS first_column,"
        f" '{n}.csv' AS meta_arquivo_origem,"
        f" (SELECT count(*) FROM {n}) AS meta_qtd_linhas, true AS tagged FROM {n}"
        for n, k in keys.items()
    )


REFINED_COLUMNS = (
    "company_revenue_usd",
    "employee_count",
    "is_public_company",
    "industry_primary",
    "attack_vector_primary",
    "data_type",
    "confidence_tier",
    "quality_score",
    "country_hq",
    "total_loss_usd",
    "row_key",
)


def _null_lines(relation: str, columns: tuple[str, ...]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,"
        f" round(100.0 * (count(*) - count({c})) / count(*), 6) AS null_percent FROM {relation}"
        for c in columns
    )


def _null_profile_raw() -> str:
    columns = (
        "incident_id",
        "company_revenue_usd",
        "employee_count",
        "is_public_company",
        "industry_primary",
        "attack_vector_primary",
        "data_type",
        "confidence_tier",
        "quality_score",
        "country_hq",
        "company_name",
        "review_flag",
    )
    return f"SELECT * FROM ({_null_lines('incidents', columns)}) WHERE null_count > 0"


def _rejected() -> str:
    def line(relation: str, column: str) -> str:
        return (
            f"SELECT '{column}' AS column_name, count(*) FILTER (WHERE {column} IS NOT NULL"
            f" AND TRY_CAST({column} AS DOUBLE) IS NULL) AS rejected FROM {relation}"
        )

    names = [n for n in domain.TYPED_COLUMNS if n != domain.TARGET]
    lines = [line("incidents", n) for n in names] + [line("financial", domain.TARGET)]
    return "\nUNION ALL ".join(lines)


def _correlations(zero_filled: bool) -> str:
    def value(name: str) -> str:
        return f"coalesce({name}, 0.0)" if zero_filled else name

    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS col_name,"
        f" round(corr({value(a)}, {value(b)}), 6) AS r FROM refined"
        for a in domain.CORRELATED
        for b in domain.CORRELATED
    )


NOMINAL = ("industry_primary", "attack_vector_primary", "data_type")


def _vocabulary() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name,"
        f" row_number() OVER (ORDER BY {c}) - 1 AS position, {c} AS word"
        f" FROM (SELECT DISTINCT {c} FROM parted WHERE split = 'train' AND {c} IS NOT NULL)"
        for c in NOMINAL
    )


PARAM_LINES = (
    ("medians", "company_revenue_usd", "med_revenue"),
    ("medians", "employee_count", "med_staff"),
    ("medians", "quality_score", "med_quality"),
    ("means", "company_revenue_usd", "mean_revenue"),
    ("means", "employee_count", "mean_staff"),
    ("deviations", "company_revenue_usd", "std_revenue"),
    ("deviations", "employee_count", "std_staff"),
    ("fence", None, "fence"),
    ("z_low", None, "z_low"),
    ("z_high", None, "z_high"),
)


def _params() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{kind}' AS kind, {repr(column) if column else 'NULL'} AS column_name,"
        f" round({value}, 4) AS number FROM params"
        for kind, column, value in PARAM_LINES
    )


# Values of train rows in buckets of eleven binary digits; ranks inside a bucket spread between its extremes.
MERGED = (
    SPLIT
    + """,
cells AS (
  SELECT unnest(['revenue', 'staff', 'quality', 'loss']) AS c,
         unnest([company_revenue_usd, employee_count, quality_score, total_loss_usd]) AS v
  FROM parted WHERE split = 'train'
), buckets AS (
  SELECT c, CAST(4398046511105 AS DOUBLE) * v - (CAST(4398046511105 AS DOUBLE) * v - v) AS b,
         count(*) AS n, min(v) AS low, max(v) AS high
  FROM cells WHERE v IS NOT NULL GROUP BY ALL
), counted AS (
  SELECT *, sum(n) OVER (PARTITION BY c ORDER BY b) AS upto, sum(n) OVER (PARTITION BY c) AS size FROM buckets
), wanted AS (
  SELECT DISTINCT c, p, p * (size - 1) AS place, floor(p * (size - 1)) + o AS rank, o
  FROM counted, (VALUES (0.25::DOUBLE), (0.5), (0.75)) AS ps(p), (VALUES (0), (1)) AS os(o)
), picked AS (
  SELECT c, p, o, place, low + (high - low) * CASE WHEN n > 1 THEN (least(rank, size - 1) - upto + n) / (n - 1) ELSE 0 END AS v
  FROM wanted JOIN counted USING (c) WHERE least(rank, size - 1) < upto AND least(rank, size - 1) >= upto - n
), q AS (
  SELECT c, p, any_value(v) FILTER (WHERE o = 0)
           + (any_value(v) FILTER (WHERE o = 1) - any_value(v) FILTER (WHERE o = 0)) * (any_value(place) - floor(any_value(place))) AS v
  FROM picked GROUP BY c, p
), params AS (
  SELECT (SELECT v FROM q WHERE c = 'revenue' AND p = 0.5) AS med_revenue,
         (SELECT v FROM q WHERE c = 'staff' AND p = 0.5) AS med_staff,
         (SELECT v FROM q WHERE c = 'quality' AND p = 0.5) AS med_quality,
         avg(company_revenue_usd) AS mean_revenue,
         avg(employee_count) AS mean_staff,
         stddev_pop(company_revenue_usd) AS std_revenue,
         stddev_pop(employee_count) AS std_staff,
         (SELECT 2.5 * max(v) - 1.5 * min(v) FROM q WHERE c = 'loss' AND p <> 0.5) AS fence,
         avg(company_revenue_usd) - 3 * stddev_pop(company_revenue_usd) AS z_low,
         avg(company_revenue_usd) + 3 * stddev_pop(company_revenue_usd) AS z_high
  FROM parted WHERE split = 'train'
)"""
)


def _merged_vocabulary() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, {name} AS word, count(*) AS n FROM parted"
        f" WHERE split = 'train' AND {name} IS NOT NULL GROUP BY {name}"
        for name in ("industry_primary", "attack_vector_primary", "data_type")
    )


def _catalogue() -> str:
    names = {
        "medians": "missing_number",
        "means": "scaling_mean",
        "deviations": "scaling_deviation",
        "fence": "fence_cap",
        "z_low": "z_clip_low",
        "z_high": "z_clip_high",
    }
    columns = {"fence": "total_loss_usd", "z_low": "company_revenue_usd", "z_high": "company_revenue_usd"}
    lines = [
        "SELECT 'label_encoding' AS transformation, 'confidence_tier' AS column_name,"
        " CAST(NULL AS DOUBLE) AS learned"
    ]
    lines += [
        f"SELECT 'one_hot', '{c}', CAST(count(DISTINCT {c}) AS DOUBLE) FROM parted"
        " WHERE split = 'train'"
        for c in NOMINAL
    ]
    lines += [
        f"SELECT '{names[k]}', '{c or columns[k]}', round({v}, 4) FROM params"
        for k, c, v in PARAM_LINES
    ]
    return "\nUNION ALL ".join(lines)


def _feature_layer() -> str:
    dummies = ",\n  ".join(
        f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS BIGINT) AS \"{c}_{v}\""
        for c, values in DUMMIES.items()
        for v in values
    )
    return f"""
    SELECT row_key,
      round(least(greatest(coalesce(company_revenue_usd, med_revenue), z_low), z_high), 4)
        AS company_revenue_usd,
      coalesce(employee_count, med_staff) AS employee_count,
      is_public_company,
      CAST(coalesce(confidence_tier, 0) AS BIGINT) AS confidence_tier,
      coalesce(quality_score, med_quality) AS quality_score,
      round(least(total_loss_usd, fence), 6) AS total_loss_usd,
      split,
      {dummies},
      round((coalesce(company_revenue_usd, med_revenue) - mean_revenue) / std_revenue, 6)
        AS company_revenue_usd_scaled,
      round((coalesce(employee_count, med_staff) - mean_staff) / std_staff, 6)
        AS employee_count_scaled
    FROM parted, params"""


def _feature_detection() -> str:
    texts = (
        "company_revenue_usd",
        "employee_count",
        "industry_primary",
        "attack_vector_primary",
        "data_type",
        "confidence_tier",
        "quality_score",
        "country_hq",
        "review_flag",
    )
    lines = [
        f"SELECT '{c}' AS column_name, 'text' AS kind,"
        f" round(count(TRY_CAST({c} AS DOUBLE)) / CAST(count(*) AS DOUBLE), 6) AS numeric_share,"
        f" count(TRY_CAST({c} AS DOUBLE)) / CAST(count(*) AS DOUBLE) > 0.5 AS is_feature"
        " FROM incidents"
        for c in texts
    ]
    lines.append("SELECT 'is_public_company', 'number', 1.0, true")
    return "\nUNION ALL ".join(lines)


def _alpha_index() -> str:
    names = ("industry_primary", "attack_vector_primary", "country_hq")
    tables = ",\n".join(
        f"v_{c} AS (SELECT {c} AS word, row_number() OVER (ORDER BY {c}) - 1 AS code FROM"
        f" (SELECT DISTINCT {c} FROM parted WHERE split = 'train'))"
        for c in names
    )
    joins = " ".join(f"LEFT JOIN v_{c} ON parted.{c} = v_{c}.word" for c in names)
    columns = ", ".join(
        f"coalesce(v_{c}.code, (SELECT count(*) FROM v_{c})) AS {c}" for c in names
    )
    return _with(f"{SPLIT},\n{tables}", f"SELECT row_key, {columns} FROM parted {joins}")


METRIC_COLUMNS = ", ".join(f"round({m}, 6) AS {m}" for m in ("acuracia", "precisao", "recall", "f1"))


def _verdict(before: str, after: str, metrics: tuple[str, ...], places: int = 6) -> str:
    """Metrics of the entropy tree on both layers, each computed as a query of its own."""
    line = f"SELECT {', '.join(metrics)} FROM measured WHERE split = 'test' AND model = 'modelo2_entropy'"
    pairs = " UNION ALL ".join(f"SELECT '{m}' AS metric, b.{m} AS a, c.{m} AS b FROM b, c" for m in metrics)
    return f"""WITH b AS MATERIALIZED ({_with(before, line)}), c AS MATERIALIZED ({_with(after, line)})
      SELECT metric, round(a, {places}) AS refined, round(b, {places}) AS feature, round(b - a, {places}) AS delta,
      CASE WHEN b - a > 0.001 THEN 'SIM' WHEN b - a >= 0 THEN '=' ELSE 'NAO' END AS improved FROM ({pairs})"""


def _word(flag: str) -> str:
    return f"CASE WHEN {flag} = 1 THEN 'Alto' ELSE 'Baixo' END"


def _hit(flag: str) -> str:
    return f"CASE WHEN label = {flag} THEN 'SIM' ELSE 'NAO' END"


RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY industry_primary
                               ORDER BY total_loss_usd DESC, row_key) AS rank_in_industry
  FROM refined
)"""

FENCE = """
  quantile_cont({x}, 0.75) + 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25))"""


def _summary(relation: str, x: str, places: int) -> str:
    fence = FENCE.format(x=x)
    moments = 4 if places == 8 else 6
    return f"""
    SELECT count({x}) AS count, round(avg({x}), {moments}) AS mean, min({x}) AS min,
      max({x}) AS max, round(stddev_pop({x}), {moments}) AS std_pop,
      round(stddev_samp({x}), {moments}) AS std_samp,
      round(quantile_cont({x}, 0.25), {places}) AS q1,
      round(quantile_cont({x}, 0.5), {places}) AS median,
      round(quantile_cont({x}, 0.75), {places}) AS q3,
      round({fence}, {places}) AS upper_fence
    FROM {relation}"""


ORACLES: dict[str, str] = {
    "raw_audit": _raw_audit(),
    "committed_layer": f"""WITH {REFINED}
        SELECT row_key, round(company_revenue_usd * 2, 4) AS doubled, CAST(3 AS BIGINT) AS version,
          count(*) OVER () AS rows, CAST(2 AS BIGINT) AS versions_kept
        FROM refined WHERE company_revenue_usd IS NOT NULL""",
    "typed_csv_ingest": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
               c_mktsegment, 'double' AS balance_type, 'string' AS name_type
        FROM customer""",
    "layer_inventory": _inventory(),
    "refined_join": _with(REFINED, "SELECT * FROM refined"),
    "full_join_count": _with(
        RAW,
        "SELECT count(*) AS rows FROM incidents i JOIN financial f ON i.incident_id = f.incident_id",
    ),
    "join_coverage": _with(
        RAW
        + """,
sizes AS (
  SELECT 'inner_inner' AS join_kind, (SELECT count(*) FROM incidents
    JOIN financial USING (incident_id) JOIN market USING (incident_id)) AS rows
  UNION ALL SELECT 'inner_left', (SELECT count(*) FROM incidents
    JOIN financial USING (incident_id) LEFT JOIN market USING (incident_id))
  UNION ALL SELECT 'left_left', (SELECT count(*) FROM incidents
    LEFT JOIN financial USING (incident_id) LEFT JOIN market USING (incident_id))
  UNION ALL SELECT 'full_outer', (SELECT count(*) FROM incidents
    FULL JOIN financial USING (incident_id) FULL JOIN market USING (incident_id))
)""",
        """SELECT join_kind, rows,
             round((SELECT rows FROM sizes WHERE join_kind = 'inner_inner')
               / CAST((SELECT rows FROM sizes WHERE join_kind = 'inner_left') AS DOUBLE), 8)
               AS market_coverage
           FROM sizes""",
    ),
    "null_profile": _with(REFINED, _null_lines("refined", REFINED_COLUMNS)),
    "null_profile_raw": _with(RAW, _null_profile_raw()),
    "rejected_values": _with(RAW, _rejected()),
    "group_counts": _with(
        RAW,
        """SELECT data_type, count(*) AS count,
             round(100.0 * count(*) / (SELECT count(*) FROM incidents), 6) AS percent
           FROM incidents GROUP BY data_type""",
    ),
    "top_groups_by_count": _with(
        REFINED,
        """SELECT country_hq, count(*) AS count,
             round(100.0 * count(*) / (SELECT count(*) FROM refined), 6) AS percent
           FROM refined GROUP BY country_hq ORDER BY count DESC, country_hq LIMIT 10""",
    ),
    "top_groups_by_mean": _with(
        REFINED,
        """SELECT country_hq, round(avg(total_loss_usd), 4) AS mean
           FROM refined GROUP BY country_hq
           ORDER BY avg(total_loss_usd) DESC, country_hq LIMIT 10""",
    ),
    "group_profile": _with(
        REFINED,
        """SELECT industry_primary, count(*) AS num_incidentes,
             round(avg(total_loss_usd), 4) AS perda_media, max(total_loss_usd) AS perda_maxima,
             round(avg(company_revenue_usd), 4) AS receita_media
           FROM refined GROUP BY industry_primary ORDER BY num_incidentes DESC, industry_primary""",
    ),
    "group_total": _with(
        REFINED,
        "SELECT count(*) AS groups FROM (SELECT DISTINCT industry_primary FROM refined)",
    ),
    "top3_per_group": _with(
        REFINED + "," + RANKED,
        """SELECT industry_primary, country_hq, total_loss_usd, rank_in_industry
           FROM ranked WHERE rank_in_industry <= 3""",
    ),
    "best_per_group_tally": _with(
        REFINED + "," + RANKED,
        """SELECT industry_primary, count(*) AS total_incidentes,
             count(*) FILTER (WHERE rank_in_industry = 1) AS top1_por_setor
           FROM ranked GROUP BY industry_primary
           ORDER BY total_incidentes DESC, industry_primary LIMIT 10""",
    ),
    "sql_over_view": _with(
        REFINED + "," + RANKED,
        """SELECT industry_primary, count(*) AS listed,
             count(*) FILTER (WHERE is_public_company) AS listed_public,
             count(*) FILTER (WHERE rank_in_industry = 1) AS leaders,
             max(rank_in_industry) AS last_rank
           FROM ranked GROUP BY industry_primary
           ORDER BY listed DESC, industry_primary LIMIT 10""",
    ),
    "raw_round_trip": "SELECT *, (SELECT count(*) FROM orders) AS meta_qtd_linhas FROM orders",
    "quartiles_narrowed": """
        SELECT round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2,
               round(quantile_cont(value, 0.75), 6) AS q3 FROM events""",
    "split_narrowed": _with(SPLIT, "SELECT row_key, split FROM parted"),
    "wide_vocabulary": _with(WIDE, "SELECT word, code FROM words"),
    "wide_transform": _with(
        WIDE,
        """SELECT row_key, coalesce(code, (SELECT count(*) FROM words)) AS company_name_code
           FROM named LEFT JOIN words ON word = company_name""",
    ),
    "rank_all_rows": """
        SELECT event_id, event_type, value,
               row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank
        FROM events""",
    "rank_all_rows_ranged": """
        SELECT event_id, event_type, value,
               row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank
        FROM events""",
    "measure_summary": _summary("events", "value", 6),
    "loss_summary": _with(REFINED, _summary("refined", "total_loss_usd", 8)),
    "index_quartiles": """
        WITH placed AS (
          SELECT value, row_number() OVER (ORDER BY value) - 1 AS place,
                 count(*) OVER () AS n
          FROM events WHERE value IS NOT NULL)
        SELECT count(*) AS count,
               max(value) FILTER (WHERE place = n // 4) AS q1,
               max(value) FILTER (WHERE place = n // 2) AS median,
               max(value) FILTER (WHERE place = 3 * n // 4) AS q3
        FROM placed""",
    "iqr_outliers": f"""
        WITH f AS (SELECT {FENCE.format(x='value')} AS fence FROM events)
        SELECT event_id, value, coalesce(value > fence, false) AS is_outlier,
               round(fence, 6) AS upper_fence
        FROM events, f""",
    "outlier_share": _with(
        REFINED
        + f",\nf AS (SELECT {FENCE.format(x='total_loss_usd')} AS fence FROM refined)",
        """SELECT round(max(fence), 8) AS upper_fence, count(total_loss_usd) AS values,
             count(*) FILTER (WHERE total_loss_usd > fence) AS outliers,
             round(100.0 * count(*) FILTER (WHERE total_loss_usd > fence)
               / count(total_loss_usd), 6) AS outlier_percent
           FROM refined, f""",
    ),
    "histogram25": _with(
        REFINED
        + """,
edge AS (SELECT min(total_loss_usd) AS low,
                (max(total_loss_usd) - min(total_loss_usd)) / 25 AS width FROM refined),
filled AS (
  SELECT CAST(least(floor((total_loss_usd - low) / width) + 1, 25) AS BIGINT) AS bin,
         count(*) AS n
  FROM refined, edge GROUP BY 1)""",
        """SELECT r.bin, round(low + (r.bin - 1) * width, 6) AS bin_low,
             round(low + r.bin * width, 6) AS bin_high, coalesce(n, 0) AS count
           FROM (SELECT unnest(range(1, 26)) AS bin) r
           LEFT JOIN filled ON r.bin = filled.bin, edge""",
    ),
    "correlation_matrix": _with(REFINED, _correlations(False)),
    "correlation_zero_filled": _with(REFINED, _correlations(True)),
    "dense_row_id": """
        SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id
        FROM orders""",
    "ordered_by_value": _with(
        REFINED,
        """SELECT row_key, total_loss_usd,
             row_number() OVER (ORDER BY total_loss_usd, row_key) - 1 AS position
           FROM refined""",
    ),
    "ordered_split": _with(SPLIT, "SELECT row_key, split FROM parted"),
    "hash_split": """
        SELECT o_orderkey, CASE WHEN
            CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT)
              % 1000000 < 800000 THEN 'train' ELSE 'test' END AS split
        FROM orders""",
    "seeded_sample": """
        SELECT event_id, value FROM (
          SELECT event_id, value,
                 row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR) || ':42')) AS place,
                 count(*) OVER () AS n
          FROM events)
        WHERE place <= n // 2""",
    "category_vocabulary": _with(SPLIT, _vocabulary()),
    "fit_params": _with(PARAMS, _params()),
    "merged_fit": _with(MERGED, _params()),
    "merged_vocabulary": _with(SPLIT, _merged_vocabulary()),
    "transformation_catalogue": _with(PARAMS, _catalogue()),
    "feature_layer": _with(PARAMS, _feature_layer()),
    "stacked_parts": _with(PARAMS, _feature_layer()),
    "clip_one_sided": _with(
        PARAMS, "SELECT row_key, round(least(total_loss_usd, fence), 6) AS capped FROM parted, params"
    ),
    "clip_two_sided": _with(
        PARAMS,
        """SELECT row_key, CASE WHEN company_revenue_usd IS NOT NULL THEN
             round(least(greatest(company_revenue_usd, z_low), z_high), 4) END AS clipped
           FROM parted, params""",
    ),
    "clip_effect": _with(
        PARAMS,
        """SELECT 'fence_cap' AS clip, count(*) FILTER (WHERE total_loss_usd > fence) AS changed,
             round(100.0 * count(*) FILTER (WHERE total_loss_usd > fence) / count(*), 6)
               AS changed_percent FROM parted, params
           UNION ALL
           SELECT 'z_clip', count(*) FILTER (WHERE company_revenue_usd > z_high
               OR company_revenue_usd < z_low),
             round(100.0 * count(*) FILTER (WHERE company_revenue_usd > z_high
               OR company_revenue_usd < z_low) / count(*), 6) FROM parted, params""",
    ),
    "feature_detection": _with(RAW, _feature_detection()),
    "alpha_index": _alpha_index(),
    "wide_index": """
        WITH words AS (
          SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code
          FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL))
        SELECT o_orderkey, code AS name_code
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN words ON customer.c_name = words.c_name""",
    "leakage_audit": _with(PARAMS, _audit("split", "review_flag = data_type", "parted WHERE split = 'train'")),
    "leakage_found": f"""SELECT rule, CASE WHEN rule = 'no_dropped_column_under_another_name' THEN 'review_flag=status' END
        AS column_pair FROM ({_with(PARAMS, _audit(
            "CASE WHEN row_key % 5 = 0 THEN 'test' ELSE 'train' END", "review_flag = review_flag", "parted"))})
        WHERE NOT passed""",
    "hidden_dependencies": _dependencies(),
    "feature_matrix": _with(
        REFINED,
        """SELECT row_key, coalesce(company_revenue_usd, 0.0) AS company_revenue_usd,
             coalesce(employee_count, 0.0) AS employee_count,
             CASE WHEN is_public_company THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
               AS is_public_company,
             coalesce(confidence_tier, 0.0) AS confidence_tier,
             coalesce(quality_score, 0.0) AS quality_score
           FROM refined""",
    ),
    "scalar_suite": _with(
        RAW
        + """,
typed AS (SELECT *, TRY_CAST(company_revenue_usd AS DOUBLE) AS x FROM incidents)""",
        """SELECT incident_id, 'constant' AS literal, round(x, 4) AS as_double,
             company_revenue_usd IS NOT NULL AND x IS NULL AS rejected,
             coalesce(x, -1.0) AS filled,
             CAST(coalesce(TRY_CAST(confidence_tier AS DOUBLE), 0) AS BIGINT) AS tier,
             CAST(coalesce(trunc(x), 0) AS BIGINT) AS revenue_code,
             CAST(CASE WHEN industry_primary = 'BUILDING' THEN 1 ELSE 0 END AS BIGINT)
               AS is_building,
             round((x - 4500.0) / 3200.0, 10) AS scaled,
             CASE WHEN x IS NOT NULL THEN round(least(x, 8000.0), 4) END AS capped,
             CASE WHEN x IS NOT NULL THEN round(least(greatest(x, 500.0), 8000.0), 4) END
               AS clipped,
             round(sqrt(x * x), 4) AS magnitude,
             0.0::DOUBLE AS undefined_ratio,
             coalesce(x, 0.0) AS finite,
             CASE WHEN x > 5000 THEN 'Alto' ELSE 'Baixo' END AS word,
             CASE WHEN data_type = review_flag THEN 'SIM' ELSE 'NAO' END AS hit
           FROM typed""",
    ),
    "class_balance": _with(
        SCORED,
        "SELECT split, CAST(label AS BIGINT) AS label, count(*) AS rows FROM scored GROUP BY 1, 2",
    ),
    "confusion_metrics": _with(
        SCORED, f"SELECT model, split, tp, tn, fp, fn, {METRIC_COLUMNS} FROM measured"
    ),
    "metrics_table": _with(
        SCORED,
        """SELECT model, round(acuracia, 4) AS acuracia, round(precisao, 4) AS precisao,
             round(recall, 4) AS recall, round(f1, 4) AS f1 FROM measured WHERE split = 'test'""",
    ),
    "overfit_gap": _with(
        SCORED,
        """SELECT a.model, round(a.acuracia, 6) AS acuracia_treino,
             round(b.acuracia, 6) AS acuracia_teste, round(a.f1, 6) AS f1_treino,
             round(b.f1, 6) AS f1_teste, round(a.acuracia - b.acuracia, 6) AS acuracia_gap,
             round(a.f1 - b.f1, 6) AS f1_gap
           FROM measured a JOIN measured b ON a.model = b.model
           WHERE a.split = 'train' AND b.split = 'test'""",
    ),
    "best_model": _with(
        SCORED,
        """SELECT model AS best_model, round(f1, 6) AS f1 FROM measured WHERE split = 'test'
           ORDER BY measured.f1 DESC, model DESC LIMIT 1""",
    ),
    "prediction_table": _with(
        SCORED,
        f"""SELECT id, {_word('label')} AS real, {_word('p1')} AS previsto,
              {_hit('p1')} AS "acertou?", round(total_loss_usd, 4) AS total_loss_usd,
              round(threshold, 8) AS threshold
            FROM numbered, limits""",
    ),
    "model_compare": _with(
        SCORED,
        f"""SELECT id, {_word('label')} AS real, {_word('p1')} AS modelo1_gini,
              {_word('p2')} AS modelo2_entropy, {_hit('p1')} AS "acertou_1?",
              {_hit('p2')} AS "acertou_2?", round(total_loss_usd, 4) AS total_loss_usd
            FROM numbered""",
    ),
    "model_compare_flags": _with(
        SCORED,
        """SELECT id, CAST(label AS BIGINT) AS real, CAST(p1 AS BIGINT) AS modelo1_gini,
             CAST(p2 AS BIGINT) AS modelo2_entropy,
             CAST(label = p1 AS BIGINT) AS "acertou_1?",
             CAST(label = p2 AS BIGINT) AS "acertou_2?",
             round(total_loss_usd, 4) AS total_loss_usd
           FROM numbered""",
    ),
    "layer_verdict": _verdict(SCORED, PREPARED_SCORED, ("acuracia", "precisao", "recall", "f1")),
    "layer_comparison": _verdict(DEEP, PREPARED_DEEP, ("f1", "acuracia")),
    "shallow_splits": _with(SCORED, _splits()),
    "tree_gini5": _with(
        DEEP, f"SELECT model, split, tp, tn, fp, fn, {METRIC_COLUMNS} FROM measured WHERE model = 'modelo1_gini'"
    ),
    "tree_entropy10": _with(
        DEEP, f"SELECT model, split, tp, tn, fp, fn, {METRIC_COLUMNS} FROM measured WHERE model = 'modelo2_entropy'"
    ),
    "tree_dump": _with(DEEP, _dump()),
    "tree_rules": _with(DEEP, _rules()),
    "impurity_importance": _with(
        DEEP + "," + GAINS, "SELECT feature, round(importance, 8) AS importance FROM importances"
    ),
    "permutation_importance": _permuted(),
    "model_summary": _with(
        DEEP + "," + GAINS,
        f"""SELECT 'DecisionTreeClassifier' AS modelo, model, 'gini' AS criterion, CAST(5 AS BIGINT) AS max_depth,
             '{",".join(REFINED_FEATURES)}' AS features,
             (SELECT feature FROM importances ORDER BY importance DESC, feature LIMIT 1) AS leading_feature,
             (SELECT round(max(importance), 8) FROM importances) AS leading_importance,
             round(max(acuracia) FILTER (WHERE split = 'train'), 4) AS acuracia_treino,
             round(max(f1) FILTER (WHERE split = 'train'), 4) AS f1_treino,
             round(max(acuracia) FILTER (WHERE split = 'test'), 4) AS acuracia_teste,
             round(max(f1) FILTER (WHERE split = 'test'), 4) AS f1_teste,
             CAST(sum(tp + tn + fp + fn) FILTER (WHERE split = 'train') AS BIGINT) AS n_treino,
             CAST(sum(tp + tn + fp + fn) FILTER (WHERE split = 'test') AS BIGINT) AS n_teste
           FROM measured WHERE model = 'modelo1_gini' GROUP BY model""",
    ),
}
