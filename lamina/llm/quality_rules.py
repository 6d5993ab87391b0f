"""Quality rules: a table of bounds on ratios, compiled into one Spark projection.

Every measure is an expression of built-in functions over the row's own text, so
the whole table is one narrow projection without user functions or a shuffle.

Defined results: a NULL, empty or blank text has no words and every measure is 0,
so it fails the least number of words; rows repeat as they come; an empty table
gives none; extra columns pass through unless they have a measure's name, which
the measure then takes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import SPACES, whole

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or that the this to was with "
    "au aux avec dans de des du elle en est et il la le les ou par pour que qui sur un une "
    "als auf das dem den der die ein eine für im ist mit nicht sich sie und von zu "
    "al con del el es las los no para por se su una y"
).split()
WRITTEN = sorted({form for word in STOP_WORDS for form in (word, word.capitalize())})
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 3
PLACE_BITS = 28


@dataclass(frozen=True)
class Rule:
    """A measure over a base, and the closed range in which a text passes; ``base`` marks required rules."""

    name: str
    measure: str
    per: str | None
    least: float | None = None
    most: float | None = None
    required: bool = False


RULES = (
    Rule("too_short", "n_words", None, least=50, required=True),
    Rule("repeated", "n_repeat_words", "n_words", most=0.5, required=True),
    Rule("word_length", "word_chars", "n_words", least=2, most=12),
    Rule("symbols", "n_symbols", "n_words", most=0.2),
    Rule("shouting", "n_bangs", "n_words", most=0.2),
    Rule("stop_words", "n_stop_words", "n_words", least=0.04),
    Rule("same_lines", "n_dup_lines", "n_lines", most=0.5),
)
MEASURES = tuple(dict.fromkeys([r.measure for r in RULES] + [r.per for r in RULES if r.per]))


def _occurs(text: Column, characters: str) -> Column:
    """How many characters of a set the text has."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]", ""))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a long column for every measure."""
    rest = [c for c in docs.columns if c not in {*MEASURES, "_words", "_windows"}]
    body = whole(text)
    words = F.array_remove(F.split(body, SPACES, -1), "")
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    first = docs.select(*rest, body.alias("_text"), words.alias("_words"), lines.alias("_lines"))

    def code(i: Column) -> Column:
        """A window's hash in the upper bits and its place in the lower ones, so that one sort of numbers groups windows."""
        hashed = F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)])
        return hashed.bitwiseAND(-1 << PLACE_BITS).bitwiseOR(i.cast("long"))

    starts = F.sequence(F.lit(0), F.size("_words") - WINDOW)
    codes = F.when(F.size("_words") >= WINDOW, F.sort_array(F.transform(starts, code)))
    second = first.withColumn("_codes", codes)

    def like(x: Column, k: Column) -> Column:
        return F.coalesce(F.shiftright(x, PLACE_BITS) == F.shiftright(F.get("_codes", k), PLACE_BITS), F.lit(False))

    # Most texts have no two windows with one hash; in the others those windows are compared word by word.
    some = F.exists(F.transform("_codes", lambda x, k: like(x, k + 1)), lambda same: same)
    near = F.when(some, F.filter("_codes", lambda x, k: like(x, k - 1) | like(x, k + 1)))

    def window(x: Column) -> Column:
        i = x.bitwiseAND((1 << PLACE_BITS) - 1).cast("int")
        return F.struct(F.concat_ws(" ", *[F.get("_words", i + k) for k in range(WINDOW)]).alias("w"), i.alias("i"))

    second = second.withColumn("_near", near).withColumn("_windows", F.array_sort(F.transform("_near", window)))

    def twice(x: Column, k: Column) -> Column:
        beside = [F.get("_windows", k + step)["w"] == x["w"] for step in (-1, 1)]
        return F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))

    found = F.transform(F.filter("_windows", twice), lambda x: x["i"])
    third = second.withColumn("_starts", F.sort_array(F.coalesce(found, F.array().cast("array<int>"))))

    def covered(i: Column, k: Column) -> Column:
        """Words a window adds to those of the one before it."""
        return F.least(F.lit(WINDOW), F.coalesce(i - F.get("_starts", k - 1), F.lit(WINDOW)))

    total = F.aggregate(F.transform("_starts", covered), F.lit(0), lambda a, x: a + x)
    stop = F.filter("_words", lambda w: w.isin(WRITTEN))
    values = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": _occurs(F.col("_text"), SYMBOLS),
        "n_bangs": _occurs(F.col("_text"), "!"),
        "n_stop_words": F.size(stop),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": total,
    }
    return third.select(*rest, *[values[name].cast("long").alias(name) for name in MEASURES])


def passes(rule: Rule) -> Column:
    """The rule as a comparison of whole numbers where the bounds allow; a base of 0 passes."""
    value, per = F.col(rule.measure).cast("double"), F.col(rule.per).cast("double") if rule.per else F.lit(1.0)
    tests = [value >= rule.least * per] if rule.least is not None else []
    tests += [value <= rule.most * per] if rule.most is not None else []
    return tests[0] & tests[1] if len(tests) > 1 else tests[0]


def apply_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the measures, failed (names of failed rules), base_failed and kept."""
    rows = measured(docs.drop("failed", "base_failed", "kept"), text)
    failed = F.array_compact(F.array(*[F.when(~passes(rule), rule.name) for rule in rules]))
    required = [rule.name for rule in rules if rule.required]
    rows = rows.withColumn("failed", failed)
    return rows.withColumns(
        {"base_failed": F.arrays_overlap("failed", F.lit(required)), "kept": F.size("failed") == 0}
    )


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The table in SQL: a condition that is true where all rules pass."""
    parts = []
    for rule in rules:
        per = f"{rule.per}::DOUBLE" if rule.per else "1.0::DOUBLE"
        if rule.least is not None:
            parts.append(f"{rule.measure}::DOUBLE >= {rule.least}::DOUBLE * {per}")
        if rule.most is not None:
            parts.append(f"{rule.measure}::DOUBLE <= {rule.most}::DOUBLE * {per}")
    return " AND ".join(parts)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The query op7 in DuckDB's SQL."""
    stop = ", ".join(f"'{word}'" for word in WRITTEN)
    base = " AND ".join(f"({rules_sql((rule,))})" for rule in rules if rule.required)
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_bangs,
         len(list_filter(w, lambda x: x IN ({stop})))::BIGINT AS n_stop_words,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       NOT ({base}) AS base_failed, ({rules_sql(rules)}) AS kept
FROM m
"""
