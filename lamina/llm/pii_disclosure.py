"""Personal data: fixed patterns, and terms that disclose what the patterns protect.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each value
found is a protected entity. How strongly a term reveals an entity is estimated
from the whole corpus: with N documents, n_e that hold the entity, n_t that hold the
term and n_et that hold both, the chance of the entity where the term stands is
n_et / (n_t + ``PRIOR``), smoothed so that terms met once or twice can be judged too.
The information given is ln of that chance over n_e / N, out of the entity's own
-ln(n_e / N). Wherever a term stands in a document of an entity whose share
reaches ``GENERALISE`` it is replaced by its class, from ``REMOVE`` on it is removed.

The share depends only on which documents hold the two, so entities of the same
documents are counted as one class, terms likewise: a text of thousands of
addresses met nowhere else gives one class of each. Equal sets are told by their
size and two 64-bit hashes.

Built-in functions only. Texts are read where they lie; what is shuffled are the words
of documents with findings, and counts that were added up before.

Defined results: NULL and empty texts have no spans; rows repeat as they come, and
repeated rows count as documents; NULL ids are ids like any other here; an empty
table gives none; extra columns, whatever their names, pass through ``sanitise`` unchanged;
work grows in proportion to the matches of a text, however long.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import whole
from lamina.session import cut_lineage, small_enough

GENERALISE = 0.8
REMOVE = 0.95
PRIOR = 1.0
CHUNK = 256  # elements whose running sums are appended one by one
COVERED = "\uE000"  # stands for a letter or digit that a span covers; private use, no letter itself

KINDS = ("email", "ip", "card", "phone", "term")


@dataclass(frozen=True)
class Pattern:
    """``regex`` matches what the kind's definition matches, without trying places that cannot begin a match."""

    kind: str
    regex: str
    needs: str


PATTERNS = (
    Pattern("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Pattern("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "."),
    # A run of fewer than 13 digits can be no card, and no match inside it is tried again.
    Pattern("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+", ""),
    Pattern("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+"),
)
WORD = r"[\p{L}\p{N}]"
TERM = WORD + "{2,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the check sum is right; every second digit from the right counts twice, less 9 above 9."""
    size = F.length(digits)

    def worth(k: Column) -> Column:
        digit = F.substr(digits, size - k + 1, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(k % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda total, k: total + worth(k)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    size = F.length(_digits(value))
    if kind == "ip":
        parts = F.split(value, "\\.")
        # The value of a part of many digits is told by those after its leading zeros.
        return F.forall(parts, lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
            parts, lambda p: F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255
        )
    if kind == "card":
        return F.when(size.between(13, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, combine=lambda a, b: a + b) -> Column:
    """Running sums (or maxima) of whole numbers from 0 on: inside chunks first, then with the chunks before."""
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))
    walk = lambda array: F.aggregate(
        array, F.array().cast("array<int>"), lambda a, x: F.array_append(a, combine(last(a), x))
    )

    def joined(p: Column) -> Column:
        before = lambda k: F.coalesce(F.get(p["upto"], k - 1), F.lit(0))
        moved = lambda chunk, k: let(before(k), lambda b: F.transform(chunk, lambda x: combine(b, x)))
        return F.flatten(F.transform(p["chunks"], moved))

    def chunked(all_values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(all_values) - 1, F.lit(0)) / CHUNK).cast("int"))
        chunks = F.transform(numbers, lambda k: walk(F.slice(all_values, k * CHUNK + 1, CHUNK)))
        return let(chunks, lambda c: let(F.struct(c.alias("chunks"), walk(F.transform(c, last)).alias("upto")), joined))

    return let(values, chunked)


def matches(text: Column, regex: str) -> Column:
    """start and end in code points and value of every match, placed by what lies before and between them."""

    def placed(values: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, regex, -1), F.length), 1, F.size(values))
        ends = running(F.zip_with(gaps, values, lambda gap, v: gap + F.length(v)))

        def one(e: Column, v: Column, i: Column) -> Column:
            return F.struct((F.get(e, i) - F.length(v)).alias("start"), F.get(e, i).alias("end"), v.alias("value"))

        each = let(ends, lambda e: F.transform(values, lambda v, i: one(e, v, i)))
        return F.when(F.size(values) > 0, each).otherwise(F.array().cast(MATCH))

    return let(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), placed)


MATCH = "array<struct<start:int,end:int,value:string>>"
SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def base_spans(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``spans``: kind (its number), start and end in code points, value; in order of kind and start."""

    def placed(number: int, pattern: Pattern) -> Column:
        possible = F.contains(F.col(text), F.lit(pattern.needs)) if pattern.needs else F.col(text).rlike("[0-9]")
        held = F.filter(matches(F.col(text), pattern.regex), lambda m: _holds(pattern.kind, m["value"]))
        spans = F.transform(
            held,
            lambda m: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")),
        )
        return F.when(possible, spans).otherwise(F.array().cast(SPAN)).cast(SPAN)

    return rows.withColumn("spans", F.concat(*[placed(i, pattern) for i, pattern in enumerate(PATTERNS)]))


def merged(cuts: Column) -> Column:
    """start, end and mark of cuts in order of start; those that overlap are one, marked as the first of them."""

    def heads(p: Column) -> Column:
        numbered = F.transform(
            p["cuts"], lambda c, i: F.struct(i.alias("at"), c["start"].alias("start"), c["mark"].alias("mark"))
        )
        first = F.filter(numbered, lambda h: h["start"] >= F.coalesce(F.get(p["reach"], h["at"] - 1), F.lit(0)))

        def ended(all_heads: Column, h: Column, k: Column) -> Column:
            next_at = F.coalesce(F.get(all_heads, k + 1)["at"], F.size(p["cuts"]))
            return F.struct(h["start"].alias("start"), F.get(p["reach"], next_at - 1).alias("end"), h["mark"].alias("mark"))

        return let(first, lambda all_heads: F.transform(all_heads, lambda h, k: ended(all_heads, h, k)))

    def reached(c: Column) -> Column:
        reach = running(F.transform(c, lambda x: x["end"]), F.greatest)
        return let(F.struct(c.alias("cuts"), reach.alias("reach")), heads)

    return let(cuts, reached)


def rewritten(text: Column, cuts: Column, change) -> Column:
    """``text`` with ``change(cut, what it covers)`` in place of every cut; cuts in order, none over another.

    Each chunk of cuts takes its stretch of the text once, so no cut walks the whole text.
    """

    def stretch(p: Column) -> Column:
        def piece(c: Column, i: Column) -> Column:
            before = F.coalesce(F.get(p["cuts"], i - 1)["end"], p["low"])
            plain = F.substr(p["part"], before - p["low"] + 1, c["start"] - before)
            return F.concat(plain, change(c, F.substr(p["part"], c["start"] - p["low"] + 1, c["end"] - c["start"])))

        return F.array_join(F.transform(p["cuts"], piece), "")

    def whole_text(all_cuts: Column) -> Column:
        end_of = lambda i: F.coalesce(F.get(all_cuts, i)["end"], F.lit(0))

        def chunk(k: Column) -> Column:
            low, high = end_of(k * CHUNK - 1), end_of(F.least((k + 1) * CHUNK, F.size(all_cuts)) - 1)
            own = F.slice(all_cuts, k * CHUNK + 1, CHUNK)
            part = F.substr(text, low + 1, high - low)
            return let(F.struct(own.alias("cuts"), low.alias("low"), part.alias("part")), stretch)

        chunks = F.sequence(F.lit(0), F.floor((F.size(all_cuts) - 1) / CHUNK).cast("int"))
        done = F.array_join(F.transform(chunks, chunk), "")
        tail = F.substr(text, end_of(F.size(all_cuts) - 1) + 1, F.length(text))
        return F.when(F.size(all_cuts) > 0, F.concat(done, tail)).otherwise(text)

    return let(cuts, whole_text)


TERMS = "array<struct<term:string,start:int,end:int>>"


def findings(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """row, doc_id, text_key, spans, entities and terms (all places of words that no span touches).

    Terms are taken from rows with spans only.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.replace(whole(text), F.lit(COVERED), F.lit(" ")).alias("_text"),
    )
    rows = base_spans(rows, "_text")

    def entity(s: Column) -> Column:
        value = F.when(s["kind"] == 0, F.lower(s["value"])).when(s["kind"] == 1, s["value"]).otherwise(_digits(s["value"]))
        return F.concat_ws(":", s["kind"].cast("string"), value)

    cuts = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("").alias("mark")))
    )
    hidden = rewritten(F.col("_text"), merged(cuts), lambda c, covered: F.regexp_replace(covered, WORD, COVERED))
    rows = rows.withColumn("_hidden", F.when(F.size("spans") > 0, hidden).otherwise(""))
    free = F.filter(matches(F.col("_hidden"), f"[{WORD[1:-1]}{COVERED}]{{2,}}"), lambda m: ~F.contains(m["value"], F.lit(COVERED)))
    terms = F.transform(
        free, lambda m: F.struct(F.lower(m["value"]).alias("term"), m["start"].alias("start"), m["end"].alias("end"))
    )
    entities = F.array_distinct(F.transform("spans", entity))
    return rows.select("row", "doc_id", "text_key", "spans", entities.alias("entities"), terms.cast(TERMS).alias("terms"))


def _counts_of_terms(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """In how many documents each given term stands; the corpus is counted before it is shuffled."""
    words = F.array_distinct(F.transform(F.regexp_extract_all(whole(text), F.lit(TERM), F.lit(0)), F.lower))
    each = docs.select(F.explode(words).alias("term"))
    if small_enough(terms, "term"):
        each = each.join(F.broadcast(terms.select("term")), "term")
    return each.groupBy("term").agg(F.count("*").alias("n_t")).join(terms, "term")


def _held_by(each: DataFrame, name: str, rows: str) -> DataFrame:
    """For each value of ``name``: in how many rows it stands, and two hashes of the set of these rows."""
    return each.groupBy(name).agg(
        F.count("*").alias(rows), F.bit_xor(F.xxhash64("row")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(name), "row")).alias("h2")
    )


def disclosing_terms(
    docs: DataFrame, found: DataFrame, text: str = "text", generalise: float = GENERALISE, remove: float = REMOVE, prior: float = PRIOR
) -> DataFrame:
    """row, term, share (the largest over the row's entities) and whether it is to be removed."""
    total = F.lit(float(found.count()))

    def share(both: Column) -> Column:
        given = F.log(both * total / (F.col("n_e") * (F.col("n_t") + prior)))
        return F.round(F.when(F.col("n_e") < total, given / F.log(total / F.col("n_e"))).otherwise(0.0), 9)

    entities = found.select("row", F.explode("entities").alias("entity"))
    entity_sets = _held_by(entities, "entity", "n_e").withColumn("e", F.struct("n_e", "h1", "h2"))
    entities = entities.join(entity_sets.select("entity", "n_e", "e"), "entity").select("row", "n_e", "e").distinct()

    terms = found.select("row", F.explode(F.array_distinct("terms.term")).alias("term"))
    term_sets = _held_by(terms, "term", "n_near")
    # The best entity for a term stands in just the rows of findings that hold it. What falls short even so, with no
    # other document of the term, needs no counting, which leaves out common words before the corpus is read.
    best = F.col("n_near").alias("n_e")
    near = term_sets.withColumns({"n_e": best, "n_t": F.col("n_near")}).where(share(F.col("n_near")) >= generalise)
    near = cut_lineage(near.drop("n_e", "n_t"))
    counted = _counts_of_terms(docs, near, text).withColumn("n_e", best).where(share(F.col("n_near")) >= generalise)
    counted = counted.select("term", "n_near", "n_t", F.struct("n_near", "n_t", "h1", "h2").alias("t"))
    terms = cut_lineage(terms.join(counted, "term"))

    classes = terms.select("row", "n_near", "n_t", "t").distinct()
    pairs = entities.join(classes, "row").where(share(F.least("n_e", "n_near")) >= generalise)
    pairs = cut_lineage(pairs.select("row", "e", "t"))
    together = pairs.groupBy("e", "t").agg(F.count("*").alias("both"), F.first("e.n_e").alias("n_e"), F.first("t.n_t").alias("n_t"))
    telling = together.withColumn("share", share(F.col("both"))).where(F.col("share") >= generalise)
    hits = pairs.join(telling.select("e", "t", "share"), ["e", "t"]).groupBy("row", "t").agg(F.max("share").alias("share"))
    return terms.join(hits, ["row", "t"]).select("row", "term", "share", (F.col("share") >= remove).alias("removed"))


ADDED = "array<struct<start:int,end:int,removed:boolean>>"


def detect(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id, text_key, spans (by the patterns) and added (terms); one row for each row of ``docs``."""
    found = cut_lineage(findings(docs, text, id))
    telling = disclosing_terms(docs.select(F.col(text).alias("text")), found, "text")
    places = found.select("row", F.explode("terms").alias("at")).select("row", "at.*")
    added = places.join(telling, ["row", "term"]).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "removed"))).alias("added")
    )
    rows = found.drop("terms").join(added, "row", "left")
    return rows.select("doc_id", "text_key", "spans", F.coalesce("added", F.array().cast(ADDED)).alias("added"))


def count_of(kind: int, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def listed(spans: Column, added: Column | None = None) -> Column:
    """Spans as kind:start:end, by kind and start, joined by commas."""
    name = lambda number: F.element_at(F.lit(list(KINDS)), number + 1)
    out = F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    if added is not None:
        more = F.transform(added, lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string")))
        out = F.concat(out, more)
    return F.array_join(out, ",")


def sanitise(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` with values and disclosing terms of ``text`` replaced by their class, or removed.

    Where spans overlap, the one that starts first stands for what both cover.
    Only rows with findings meet the table of spans; the others pass as they are.
    """
    found = detect(docs, text, id).where(F.size("spans") + F.size("added") > 0)
    marks = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.concat(F.lit("["), F.upper(F.element_at(F.lit(list(KINDS)), s["kind"] + 1)), F.lit("]")).alias("mark"),
        ),
    )
    more = F.transform(
        "added",
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["removed"], "").otherwise("[TERM]").alias("mark")),
    )
    cuts = found.groupBy("doc_id", "text_key").agg(F.first(F.array_sort(F.concat(marks, more))).alias("cuts"))
    # The columns travel under numbers, so that one named like a result stays what it is.
    numbered = {f"column_{i}": c for i, c in enumerate(docs.columns)}
    names = {c: n for n, c in numbered.items()}
    rows = docs.toDF(*numbered)
    body = F.col(names[text])
    any_match = F.coalesce(body.rlike("|".join(f"(?:{p.regex})" for p in PATTERNS)), F.lit(False))
    same = F.col(names[id]).eqNullSafe(F.col("doc_id")) & (F.xxhash64(body) == F.col("text_key"))
    joined = rows.where(any_match).join(cuts, same, "left")
    clean = rewritten(body, merged(F.col("cuts")), lambda cut, covered: cut["mark"])
    out = F.when(F.col("cuts").isNull(), body).otherwise(clean)
    return joined.withColumn(names[text], out).select(*numbered).union(rows.where(~any_match)).toDF(*docs.columns)


# The definitions of the kinds, as the patterns above must match them.
DEFINITIONS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _placed_sql(text: str, pattern: str, keep: str, source: str, value: str = "value") -> str:
    """Matches of a pattern with their start, from what lies before and between them."""
    return f"""SELECT {keep}, found[i] AS {value},
        CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS spot
      FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
            FROM (SELECT *, regexp_extract_all({text}, {pattern}) AS found, string_split_regex({text}, {pattern}) AS gaps
                  FROM {source}))"""


def oracle() -> str:
    """The query op5 in DuckDB's SQL."""
    kinds = ", ".join(f"({i}, '{kind}', '{regex}')" for i, (kind, regex) in enumerate(DEFINITIONS))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{kind}" for i, (kind, _) in enumerate(DEFINITIONS))
    shown = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, _ in DEFINITIONS)
    digit = "CAST(digits[len(digits) - i] AS INTEGER)"
    return f"""
WITH k(kind, name, regex) AS (VALUES {kinds}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matched AS (
  SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits
  FROM ({_placed_sql("t", "regex", "r, kind, name", "(SELECT * FROM d, k)")})
), spans AS (
  SELECT r, kind, name, value, spot AS s, spot + length(value) AS e,
         kind || ':' || CASE kind WHEN 0 THEN lower(value) WHEN 1 THEN value ELSE digits END AS entity
  FROM matched
  WHERE CASE kind WHEN 0 THEN true
    WHEN 1 THEN len(list_filter(string_split(value, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0
    WHEN 2 THEN len(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(len(digits)), lambda i:
      CASE WHEN i % 2 = 0 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0
    ELSE len(digits) BETWEEN 9 AND 15 END
), holders AS (SELECT DISTINCT r, t FROM spans JOIN d USING (r)),
words AS (
  SELECT r, lower(word) AS term, spot AS ws, spot + length(word) AS we
  FROM ({_placed_sql("t", f"'{TERM}'", "r", "holders", "word")})
), free AS (
  SELECT * FROM words w WHERE NOT EXISTS (SELECT 1 FROM spans x WHERE x.r = w.r AND x.s < w.we AND w.ws < x.e)
), together AS (
  SELECT entity, term, count(*) AS n_et
  FROM (SELECT DISTINCT r, entity FROM spans) JOIN (SELECT DISTINCT r, term FROM free) USING (r) GROUP BY entity, term
), holding AS (SELECT entity, count(DISTINCT r) AS n_e FROM spans GROUP BY entity),
spoken AS (
  SELECT term, count(*) AS n_t
  FROM (SELECT unnest(list_distinct(list_transform(regexp_extract_all(t, '{TERM}'), lambda w: lower(w)))) AS term FROM d)
  WHERE term IN (SELECT term FROM together) GROUP BY term
), telling AS (
  SELECT entity, term FROM together JOIN holding USING (entity) JOIN spoken USING (term), (SELECT count(*) AS n FROM d)
  WHERE n_e < n AND round(ln(n_et * CAST(n AS DOUBLE) / (n_e * (n_t + {PRIOR}))) / ln(CAST(n AS DOUBLE) / n_e), 9) >= {GENERALISE}
), added AS (
  SELECT r, string_agg('term:' || ws || ':' || we, ',' ORDER BY ws) AS more
  FROM (SELECT DISTINCT r, ws, we FROM free JOIN spans USING (r) JOIN telling USING (entity, term)) GROUP BY r
), base AS (
  SELECT r, {counts}, string_agg(name || ':' || s || ':' || e, ',' ORDER BY kind, s) AS listed FROM spans GROUP BY r
)
SELECT doc_id, {shown}, sha256(coalesce(listed, '')) AS base_sha256, concat_ws(',', listed, more) AS spans
FROM d LEFT JOIN base USING (r) LEFT JOIN added USING (r)
"""
