"""Repair of conversations by aligning their turns to the alternating grammar.

The kept turns' role initials must read s?(ua)+ or be none at all. Rows are brought to their
places by a range sort, faults are found by grouped minimums, and every conversation is cut
into segments of a bounded number of turns. A segment is aligned by the Wagner-Fischer
recurrence to the grammar's string of every feasible length: as all lengths share their end, one
matrix over the turns and the characters still to come holds all of them. It is computed in
a band around the diagonal; the cost found is the incumbent, no cheaper alignment can leave
the band that this cost allows, and the matrix is computed again with that band if it is wider
(Ukkonen). Audits are traced from the front, taking the ASCII-least edit on a cheapest path, and
compared over the lengths.

A segment is aligned for each grammar state it may start and end in. Audits of equal cost between the
same states are never prefixes of one another (what follows could only be insertions, which
cost), so the best ones of segments may be joined: the cheapest and least audit of the whole
conversation comes out, whatever the segment length. What one task must read whole is a
conversation's audit, which is a cell of the result, and, row by row with constant memory, its
texts for the hash, which is sequential by nature.

Defined results: NULL ids, turns, roles and texts are one space in the damage key, roles and
texts; NULL turns come first and count in no gap; rows of one turn are ordered by role,
first 256 characters and hash of the text, and repeated ones stand side by side; rows with a NULL conv_id are one conversation; a turn
without a role cannot be kept; a conversation whose rows are all dropped has zeros, an empty
audit and the hash of the empty text; an empty table gives no rows; texts may have any length; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import NOT_SPACES, text_slices
from lamina.operators.ordering import rank_within_group
from lamina.session import cut_lineage

SEGMENT = 256  # turns of a segment
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
FAR = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)

# ---- rows after damage, their places and faults ------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text and copy of the rows that are left after the damage."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    plain = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn"), part("role").alias("role"), part("text").alias("text"),
        (F.crc32(F.concat_ws(":", part("conv_id"), part("turn"))) % 20).alias("kind"),
    )
    kind = F.col("kind")
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    left = plain.where(kind != 0).select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return left


def placed(rows: DataFrame) -> DataFrame:
    """Rows with ``pos`` from 0 in their conversation; a huge one is sorted by many tasks."""
    # Keys are sampled to cut the ranges, so a long text is not one of them.
    text = [F.substring("text", 1, 256).asc(), F.sha2("text", 256).asc()]
    order = [F.asc_nulls_first("turn"), F.asc("role"), *text, F.asc("copy")]
    return rank_within_group(rows, "conv", order, "pos").withColumn("pos", F.col("pos") - 1)


def with_faults(rows: DataFrame) -> DataFrame:
    """Placed rows with ``fault``: blank, duplicate, truncated or none, the first one that holds."""
    same = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    keyed = rows.withColumn("same", same)
    # One row stays for each role and text of a conversation, so the join back meets no large key.
    firsts = keyed.groupBy("conv", "same").agg(F.min("pos").alias("pos")).select(F.col("conv").alias("c"), F.col("pos").alias("p"))
    joined = keyed.join(firsts, keyed["conv"].eqNullSafe(firsts["c"]) & (keyed["pos"] == firsts["p"]), "left")
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = (
        F.when(~F.col("text").rlike(NOT_SPACES), "blank")
        .when(F.col("p").isNull(), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    return joined.select("conv", "turn", "pos", "role", "text", fault.alias("fault"))


# ---- alignment of one segment ---------------------------------------------------------


class Suffixes:
    """Costs of aligning the turns from each place on to the last r characters of a grammar string.

    The string alternates and ends in ``end``; ``costs[i][r]`` is FAR outside of the band.
    """

    def __init__(self, roles: str, faults: str, end: str):
        self.roles, self.faults, self.end, self.n = roles, faults, end, len(roles)
        width = 4
        while True:
            self._fill(width)
            # What is found for either parity is an incumbent: a cheaper path inserts and deletes less than it pays.
            incumbent = max(int(self.costs[0][1::2].min()), int(self.costs[0][2::2].min()))
            needed = incumbent // min(INSERT, DELETE) + 1
            if needed <= width:
                return
            width = min(needed, 2 * width) if incumbent < FAR else 2 * width

    def char(self, r: int) -> str:
        """The character of which r are left with it."""
        return self.end if r % 2 else ("u" if self.end == "a" else "a")

    def _fill(self, width: int) -> None:
        """Costs of the cells whose characters and turns to come differ by ``width`` at most."""
        top = self.n + width
        r = np.arange(top + 1)
        steps = INSERT * r
        row = np.where(r <= width, steps, FAR)
        self.costs = [row]
        for i in range(self.n - 1, -1, -1):
            low, high = max(0, self.n - i - width), self.n - i + width + 1
            band = row[low:high] + DELETE
            if self.faults[i] != "x":
                more = CUT_SHORT if self.faults[i] == "t" else 0
                start = max(low, 1)
                turned = row[start - 1 : high - 1] + (REROLE + more)
                role = self.roles[i]
                if role in "ua":
                    first = (start + (role == self.end)) % 2
                    turned[first::2] -= REROLE
                band[start - low :] = np.minimum(band[start - low :], turned)
            # Insertions run along the row.
            band = np.minimum.accumulate(band - steps[low:high]) + steps[low:high]
            row = np.full(top + 1, FAR)
            row[low:high] = np.minimum(band, FAR)
            self.costs.append(row)
        self.costs.reverse()

    def cost(self, i: int, r: int) -> int:
        return int(self.costs[i][r]) if 0 <= r < len(self.costs[i]) else FAR

    def trace(self, i: int, r: int) -> str:
        """The ASCII-least of the cheapest audits from turn i on with r characters to come."""
        made = []
        while i < self.n or r:
            now = self.cost(i, r)
            if i < self.n and self.cost(i + 1, r) + DELETE == now:
                made.append("D")
                i += 1
            elif r and self.cost(i, r - 1) + INSERT == now:
                made.append("I")
                r -= 1
            else:
                more = CUT_SHORT if self.faults[i] == "t" else 0
                kept = self.roles[i] == self.char(r) and self.cost(i + 1, r - 1) + more == now
                made.append("K" if kept else "R")
                i, r = i + 1, r - 1
        return "".join(made)


def transfers(roles: str, faults: str, begins: tuple[int, ...], ends: tuple[int, ...]) -> list[tuple[int, int, int, str]]:
    """(begin, end, cost, audit): the best alignment between grammar states, where there is one.

    ``roles`` holds the initials; ``faults`` x for turns that must go, t for truncated ones, a dot else.
    """
    n, best = len(roles), []
    for end in ends:
        if end in (START, SYSTEM):
            if end in begins:
                best.append((end, end, DELETE * n, "D" * n))
            if end == SYSTEM and START in begins:
                # One turn of the system stays, all others go.
                options = [
                    (DELETE * (n - 1) + (CUT_SHORT if faults[i] == "t" else 0), "D" * i + "K" + "D" * (n - 1 - i))
                    for i in range(n)
                    if roles[i] == "s" and faults[i] != "x"
                ]
                if options:
                    best.append((START, SYSTEM, *min(options)))
            continue
        table = Suffixes(roles, faults, "a" if end == ASSISTANT else "u")
        for begin in begins:
            # The next character is the assistant's only after the user's.
            odd = (begin == USER) == (end == ASSISTANT)
            lengths = [r for r in range(1 if odd else 0, len(table.costs[0]), 2) if r or begin == end]
            options = [(table.cost(0, r), 0, r) for r in lengths]
            if begin == START:
                # Only deletions may stand before the system's turn.
                for i in range(n):
                    if roles[i] == "s" and faults[i] != "x":
                        spent = DELETE * i + (CUT_SHORT if faults[i] == "t" else 0)
                        options += [(spent + table.cost(i + 1, r), i + 1, r) for r in lengths]
            least = min((o[0] for o in options), default=FAR)
            if least >= FAR:
                continue
            audits = {
                ("D" * (i - 1) + "K" if i else "") + table.trace(i, r) for cost, i, r in options if cost == least
            }
            best.append((begin, end, least, min(audits)))
    return best


def segment_row(codes: str, alone: bool) -> tuple[int, list[tuple[int, int, int, str]]]:
    """Illegal neighbours inside a segment and its transfers; a pair of characters for each turn."""
    roles, faults = codes[0::2], codes[1::2]
    illegal = sum(roles[i : i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1))
    every = (START, SYSTEM, USER, ASSISTANT)
    return illegal, transfers(roles, faults, (START,) if alone else every, (START, ASSISTANT) if alone else every)


def _earlier(one: tuple, other: tuple) -> bool:
    """True if audits given as (part, following parts) read lower; a part seldom begins the other."""
    n = min(len(one[0]), len(other[0]))
    if one[0][:n] != other[0][:n]:
        return one[0] < other[0]
    return _text(one) < _text(other)


def _text(chain: tuple | None) -> str:
    parts = []
    while chain:
        parts.append(chain[0])
        chain = chain[1]
    return "".join(parts)


def joined(parts: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the whole conversation, and state at the start and audit of each segment."""
    # By state: cost and chain of audits from here on, and the state after this segment.
    best: dict[int, tuple[int, tuple | None, int]] = {START: (0, None, -1), ASSISTANT: (0, None, -1)}
    steps = []
    for part in reversed(parts):
        new: dict[int, tuple[int, tuple | None, int]] = {}
        for begin, end, cost, audit in part:
            if end not in best:
                continue
            option = (cost + best[end][0], (audit, best[end][1]), end)
            held = new.get(begin)
            if held is None or option[0] < held[0] or (option[0] == held[0] and _earlier(option[1], held[1])):
                new[begin] = option
        best = new
        steps.append(new)
    state, chosen = START, []
    for step in reversed(steps):
        _, chain, end = step[state]
        chosen.append((state, chain[0]))
        state = end
    return steps[-1][START][0], chosen


# ---- the operator -----------------------------------------------------------------------

TRANSFERS = "array<struct<begin:int, end:int, cost:long, audit:string>>"
KIND = "conv {0}, segment long, codes string, alone boolean"


def _aligned(segments: DataFrame, kind: str) -> DataFrame:
    """conv, segment, first and last initial, illegal and the transfers of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        for batch in batches:
            codes = batch.column("codes").to_pylist()
            made = [segment_row(c, a) for c, a in zip(codes, batch.column("alone").to_pylist())]
            lists = [[dict(zip(("begin", "end", "cost", "audit"), t)) for t in m[1]] for m in made]
            columns = [
                batch.column("conv"), batch.column("segment"), pa.array([c[0] for c in codes]), pa.array([c[-2] for c in codes]),
                pa.array([m[0] for m in made], pa.int64()), pa.array(lists, entry),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "segment", "first", "last", "illegal", "transfers"])

    schema = f"conv {kind}, segment long, first string, last string, illegal long, transfers {TRANSFERS}"
    return segments.select("conv", "segment", "codes", "alone").mapInArrow(run, schema)


def _chosen(aligned: DataFrame, kind: str) -> DataFrame:
    """conv, illegal, cost, audit and, for each segment, its state and audit."""
    parts = aligned.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("segment", "first", "last", "illegal", "transfers"))).alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = pa.list_(pa.struct([("segment", pa.int64()), ("state", pa.int32()), ("part", pa.string())]))
        for batch in batches:
            out = [[], [], [], []]
            for i in range(batch.num_rows):
                rows = batch.column("parts")[i].as_py()
                illegal = sum(r["illegal"] for r in rows)
                illegal += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
                cost, steps_of = joined([[tuple(t.values()) for t in r["transfers"]] for r in rows])
                listed = [{"segment": r["segment"], "state": s, "part": a} for r, (s, a) in zip(rows, steps_of)]
                for column, value in zip(out, (illegal, cost, "".join(a for _, a in steps_of), listed)):
                    column.append(value)
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2]), pa.array(out[3], steps)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *arrays], ["conv", "illegal", "cost", "audit", "steps"])

    schema = f"conv {kind}, illegal long, cost long, audit string, steps array<struct<segment:long, state:int, part:string>>"
    return parts.mapInArrow(run, schema)


NAMES = {"u": "user", "a": "assistant"}


class Writer:
    """The repaired conversation as it is read row by row: edits that wait, grammar state, hash."""

    def __init__(self, hashed: bool):
        self.edits, self.state = iter(""), START
        self.lines: list[str] = []
        self.hash = hashlib.sha256() if hashed else None
        self.any = False

    def begin(self, state: int, audit: str) -> None:
        self.finish()
        self.edits, self.state = iter(audit), state

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.any = True

    def _next(self, initial: str) -> None:
        self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial]

    def _insert(self) -> None:
        initial = "a" if self.state == USER else "u"
        self._put(NAMES[initial], "")
        self._next(initial)

    def row(self, role: str, text: str) -> None:
        for edit in self.edits:
            if edit == "I":
                self._insert()
                continue
            if edit == "K":
                self._put(role, text)
                self._next(role[0])
            elif edit == "R":
                initial = "a" if self.state == USER else "u"
                self._put(NAMES[initial], text)
                self._next(initial)
            return

    def finish(self) -> None:
        for _ in self.edits:
            self._insert()


def _hashes(rows: DataFrame, steps: DataFrame, kind: str) -> DataFrame:
    """conv and repaired_sha256; rows of a conversation pass in order, one batch in memory."""
    heads = steps.select("conv", F.explode("steps").alias("s")).select(
        "conv", F.col("s.segment").alias("segment"), F.lit(-1).cast("long").alias("pos"), F.col("s.state").alias("state"),
        F.lit("").alias("role"), F.col("s.part").alias("text"),
    )
    body = rows.select(
        "conv", F.floor(F.col("pos") / SEGMENT).alias("segment"), "pos", F.lit(0).alias("state"), "role", "text"
    )
    stream = heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "segment", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, now = None, None
        for batch in batches:
            done, hashes = [], []
            for part in text_slices(batch, "text"):
                for conv, pos, state, role, text in zip(
                    *(part.column(n).to_pylist() for n in ("conv", "pos", "state", "role", "text"))
                ):
                    if writer is None or conv != now:
                        if writer:
                            writer.finish()
                            done.append(now)
                            hashes.append(writer.hash.hexdigest())
                        writer, now = Writer(True), conv
                    writer.begin(state, text) if pos < 0 else writer.row(role, text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(done, batch.schema.field("conv").type), pa.array(hashes, pa.string())], ["conv", "repaired_sha256"]
            )
        if writer:
            writer.finish()
            yield pa.RecordBatch.from_arrays(
                [pa.array([now], batch.schema.field("conv").type), pa.array([writer.hash.hexdigest()])], ["conv", "repaired_sha256"]
            )

    return stream.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id: gaps, faults, illegal neighbours, cost, audit and hash of the repaired text."""
    kind = dict(conversations.dtypes)["conv_id"]
    rows = cut_lineage(with_faults(placed(damaged(conversations))))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise(F.lit("-"))
    fault = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", "t").otherwise(".")
    segment = F.floor(F.col("pos") / SEGMENT)
    segments = rows.groupBy("conv", segment.alias("segment")).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", F.concat(initial, fault).alias("c")))), lambda x: x["c"]), ""
        ).alias("codes")
    )
    many = rows.where(F.col("pos") >= SEGMENT).select("conv").distinct().select(F.col("conv").alias("c"), F.lit(False).alias("few"))
    segments = segments.join(many, segments["conv"].eqNullSafe(many["c"]), "left").withColumn("alone", F.coalesce("few", F.lit(True)))
    steps = cut_lineage(_chosen(_aligned(segments, kind), kind))
    counts = rows.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = [conversations.select(F.col("conv_id").alias("conv")).distinct(), counts, steps.drop("steps"), _hashes(rows, steps, kind)]
    whole = parts[0].withColumnRenamed("conv", "conv_id")
    for part in parts[1:]:
        whole = whole.join(part, whole["conv_id"].eqNullSafe(part["conv"]), "left").drop("conv")
    return whole.select(
        "conv_id",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
