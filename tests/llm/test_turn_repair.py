"""Conversation repair against a plain search over grammar states."""

import hashlib
import random
import zlib

import pytest

from lamina.llm import turn_repair as tr

AFTER = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def plain_edits(rows):
    """(cost, audit, repaired lines) of rows (role, text, fault): best of every suffix, by state."""
    n = len(rows)
    best = {}
    for i in range(n, -1, -1):
        now = {s: (0, "", ()) for s in "0A"} if i == n else {}
        for s in "0SUA":
            if i == n:
                continue
            role, text, fault = rows[i]
            options = []
            if s in best[i + 1]:
                c, a, lines = best[i + 1][s]
                options.append((c + 4, "D" + a, lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                for edit, name, price in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    to = AFTER.get((s, name[:1]))
                    if to and to in best[i + 1]:
                        c, a, lines = best[i + 1][to]
                        options.append((c + price + extra, edit + a, (f"{name}:{text}", *lines)))
            if options:
                now[s] = min(options, key=lambda o: o[:2])
        for _ in range(4):
            for s in "0SUA":
                for name in ("user", "assistant"):
                    to = AFTER.get((s, name[0]))
                    if to in now:
                        c, a, lines = now[to]
                        option = (c + 3, "I" + a, (f"{name}:", *lines))
                        if s not in now or option[:2] < now[s][:2]:
                            now[s] = option
        best[i] = now
    return best[0]["0"]


SPACE = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """The contract, read literally, over (conv_id, turn, role, text)."""
    done = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        done[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, left in done.items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:256], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, judged = set(), []
        for _, role, text in left:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {t for t, *_ in left if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [role[:1] for role, *_ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = plain_edits(judged) if judged else (0, "", ())
        count = lambda f: sum(r[2] == f for r in judged)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha)
    return out


def got(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = tr.repair(df).collect()
    found = {r.conv_id: tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("seed", range(6))
def test_alignment_is_the_cheapest_and_least(seed):
    """Whole and cut into segments of any length, the audits are those of the plain search."""
    random.seed(seed)
    for _ in range(150):
        n = random.randrange(1, 14)
        roles = "".join(random.choice("uuuaaas-" if seed % 2 else "uas") for _ in range(n))
        faults = "".join(random.choice("....xt") for _ in range(n))
        kind = {"x": "blank", "t": "truncated", ".": None}
        names = {"u": "user", "a": "assistant", "s": "system", "-": "tool"}
        want = plain_edits([(names[r], str(i), kind[f]) for i, (r, f) in enumerate(zip(roles, faults))])[:2]
        begin, end = (tr.START,), (tr.START, tr.ASSISTANT)
        whole = min((c, a) for _, _, c, a in tr.transfers(roles, faults, begin, end))
        assert whole == want
        size = random.randrange(1, 6)
        every = (tr.START, tr.SYSTEM, tr.USER, tr.ASSISTANT)
        parts = [tr.transfers(roles[i : i + size], faults[i : i + size], every, every) for i in range(0, n, size)]
        cost, steps = tr.joined(parts)
        assert (cost, "".join(a for _, a in steps)) == want


def test_wide_bands():
    """Many turns of one role, or many that must go, need far more insertions or deletions than the first band."""
    for roles, faults in (("u" * 40, "." * 40), ("uaua" * 10, "x" * 40), ("s" * 25 + "u" * 3, "." * 28), ("-" * 30, "t" * 30)):
        kind = {"x": "blank", "t": "truncated", ".": None}
        names = {"u": "user", "a": "assistant", "s": "system", "-": "tool"}
        want = plain_edits([(names[r], "", kind[f]) for r, f in zip(roles, faults)])[:2]
        assert min((c, a) for _, _, c, a in tr.transfers(roles, faults, (tr.START,), (tr.START, tr.ASSISTANT))) == want


def test_random_conversations(spark, monkeypatch):
    """Short and long conversations, segments of eight turns."""
    monkeypatch.setattr(tr, "SEGMENT", 8)
    random.seed(5)
    rows = []
    for conv in range(60):
        for turn in range(random.choice((1, 2, 5, 9, 40, 90))):
            role = random.choice(("user", "assistant", "user", "assistant", "system", "tool"))
            rows.append((conv, turn, role, random.choice(("Yes.", "No", "  ", "Why?", f"Text {turn}!", f"Cut {turn}"))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(df) == plain_repair(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first."), (1, 0, None, None), (1, 3, "assistant", None), (1, 3, "assistant", "a.b"), (1, 3, "assistant", "a.b"),
        (2, None, "user", "x."), (2, None, "user", "x."), (None, 1, "user", "of nobody."), (None, None, "system", "S."), (3, 1, "", "no role."),
        (4, 0, "system", "only"), (5, 7, "user", "long " * 60_000 + "."), (5, 9, "assistant", "\t\x0b done! \r\n"), (5, 8, "user", "é" * 5000 + "?"),
        (6, 1, "user", " "), (6, 2, "assistant", "\u0085 \n"),
    ]
    rows += [(c, 0, "user", "Hi.") for c in range(10, 60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = plain_repair(rows)
    assert any(v[-2] == "" for v in want.values())
    assert got(df) == want
    named = df.selectExpr("*", "1 as conv", "2 as pos", "3 as segment", "'x' as fault", "'y' as audit")
    assert got(named) == want
    assert tr.repair(df.limit(0)).count() == 0
    text_ids = df.selectExpr("cast(conv_id as string) as conv_id", "turn", "role", "text")
    assert got(text_ids) == {None if k is None else str(k): v for k, v in want.items()}


def test_registered_query(spark):
    from lamina.llm import queries

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r[1:]) for r in queries.QUERIES["op13_turn_repair"](spark, folder).collect()}
    assert found == plain_repair(rows)
