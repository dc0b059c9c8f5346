import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from alpina.llm import conversations as conv
from alpina.llm import queries
from alpina.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"
INSERTS = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def edits(state, role, fault):
    yield "D", 4, state
    if fault not in ("blank", "duplicate"):
        more = 3 * (fault == "truncated")
        if (state, role) in KEPT:
            yield "K", more, KEPT[state, role]
        yield "R", 3 + more, INSERTS[state][0]


def with_inserts(ways):
    out = dict(ways)
    for _ in range(3):
        for s, (c, a) in list(out.items()):
            t = INSERTS[s][0]
            out[t] = min(out.get(t, (1 << 60, "")), (c + 3, a + "I"))
    return out


def every_way(rows, state=0, final=True):
    """Plain dynamic programming over (rows done, state), without bounds."""
    ways = {state: (0, "")}
    for role, fault in rows:
        new = {}
        for s, (c, a) in with_inserts(ways).items():
            for e, k, t in edits(s, role, fault):
                new[t] = min(new.get(t, (1 << 60, "")), (c + k, a + e))
        ways = new
    if not final:
        return ways
    return min(w for s, w in with_inserts(ways).items() if s in (0, 3))


def brute_report(rows):
    """The report of one conversation's rows (turn, role, text), copies already made."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(conv.SPACES)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = every_way([(r[1][:1], f) for r, f in zip(rows, faults, strict=True)]) if rows else (0, "")
    state, lines, at = 0, [], 0
    for e in audit:
        role, text = (rows[at][1], rows[at][2]) if e != "I" else ("", "")
        if e in "IR":
            state, role = INSERTS[state]
        elif e == "K":
            state = KEPT[state, role[:1]]
        if e != "D":
            lines.append(f"{role}:{text}")
        at += e != "I"
    initials = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_damage(rows):
    out = {}
    for c, turn, role, text in rows:
        out.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        out[c] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def reports(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("final", [True, False])
def test_search_equals_dynamic_programming(final):
    rnd = random.Random(3)
    names = {0: "", 1: "truncated", 2: "blank"}
    for _ in range(1500):
        rows = [(rnd.choice("suax") or "", rnd.choice([0, 0, 1, 2])) for _ in range(rnd.randint(1, 11))]
        plain = [(r, names[f]) for r, f in rows]
        for state in range(4):
            found = conv.branch_and_bound(rows, state, final)
            want = every_way(plain, state, final)
            assert found == ({3: want} if final else want)


def test_bounds_never_pass_the_cost():
    rnd = random.Random(4)
    for _ in range(300):
        rows = [(rnd.choice("suax"), rnd.choice([0, 0, 0, 1, 2])) for _ in range(20)]
        bound = conv.suffix_bounds(rows)
        for i in range(len(rows)):
            for state in range(4):
                assert bound[i] <= conv.branch_and_bound(rows[i:], state, True)[3][0]


def test_query_equals_brute_force_on_the_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = reports(queries.op12_conversation_repair(spark, "/root/testdata/sf0.01"))
    assert got == {c: brute_report(r) for c, r in brute_damage(rows).items()}


def test_long_conversations_are_cut_into_blocks_over_tasks(spark):
    rnd = random.Random(5)
    rows = [(c, t * 2 // 3, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool"]),
             rnd.choice(["Yes.", "No", "", "Well, ", "Right!"]) + str(rnd.randint(0, 400)) * rnd.randint(0, 1))
            for c, n in ((1, 900), (2, 5), (3, 1500), (4, 256)) for t in range(n)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t, role, text))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = reports(conv.repair_report(df, df))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {c: brute_report(r) for c, r in want.items()}


def test_edge_rows(spark):
    long = "x" * 300_000 + "."
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, None, "user", "Hi."), (1, 1, "user", long), (1, 1, "user", long),
            (1, 9, "", "What?"), (2, 0, "system", "Only."), (3, 5, "assistant", "b. \t"), (3, 5, "assistant", "a."), (4, None, "user", "ß!")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("x")).withColumn("text2", F.lit(None).cast("string"))
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    assert reports(conv.repair_report(df, df)) == {c: brute_report(r) for c, r in want.items()}
    empty = hashlib.sha256(b"").hexdigest()
    none = reports(conv.repair_report(df, df.limit(0)))
    assert none == {c: (0, 0, 0, 0, 0, 0, "", empty) for c in want}
    assert conv.repair_report(df.limit(0), df.limit(0)).collect() == []


def test_repaired_rows_follow_the_grammar(spark):
    df = table(spark, "/root/testdata/sf0.001", "conversations")
    report, repaired = conv.repair(conv.damage(df))
    audits = {r["key"]: r["audit"] for r in report.collect()}
    rows = {}
    for r in sorted(repaired.collect(), key=lambda r: (r["key"], r["pos"])):
        rows.setdefault(r["key"], []).append((r["edit"], r["role"], r["text"]))
    import re
    for key, audit in audits.items():
        kept = rows.get(key, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[1][0] for r in kept))
        assert [r[0][0].upper() for r in kept] == [e for e in audit if e != "D"]
        assert all(r[2] == "" for r in kept if r[0] == "insert")
