"""Conversation structure repair: depth-first branch-and-bound over the edits of a conversation.

A conversation is its rows by turn (nulls first; rows of one turn by role, then by the SHA-256 of their text).
Every row has at most one fault: ``blank``, ``duplicate`` (role and text seen earlier) or ``truncated``. The cheapest
edits (keep, rerole, delete, insert) are sought whose result has role initials ``(s?(ua)+)?``; of equally cheap ones
those whose audit (the edits' initials in order) is least in ASCII.

The search (``branch_and_bound``) works on blocks of at most ``BLOCK`` rows. An explicit stack takes the edits in ASCII order,
so of two ways to one node (rows done, grammar state) the earlier has the lesser audit; a way is cut where the
node's dominance table holds one that costs no more, or where cost and suffix bound reach the incumbent. Every node
left on the stack is settled so, which proves the optimum. A block is solved for each state it can be entered in;
the blocks of a conversation are then chained by state.

Rows are sorted by ranges of (conversation, turn, role, text), so a conversation of any length is cut into blocks over many
tasks; equal rows are counted before they are shuffled. Only two things see a conversation in order and whole: the chaining, which
holds four audits (a byte per edit), and the repaired rows, which stream through one task, because a
SHA-256 has no parts. Neither holds its rows.

Defined results: a null role or text is one space; a null conv_id is a conversation of its own; null turns come first
and count for no gap; an empty role is like an unknown one (kept nowhere); equal rows of a turn are duplicates after the first;
very long texts are hashed whole; a conversation without rows has zeros and an empty audit; an empty table gives
none. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpina.llm.common import staged

BLOCK = 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
OK, CUT, GONE = 0, 1, 2  # a row without fault, a truncated one, one that must go
_FAR = 1 << 60
#: state -> (next state, role of what stands there): 0 empty, 1 after s, 2 after u, 3 after a
_NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = ("su", "ua", "au")
_CACHE: dict[tuple, dict] = {}
CACHE_SIZE = 100_000

Row = tuple[str, int]  # role initial, fault


def suffix_bounds(rows: list[Row]) -> list[int]:
    """Least cost of rows i.. for every i: each row's own least cost, and for disjoint pairs of neighbours that
    stay but may not stand together the least it takes to part or change them."""
    n = len(rows)
    own = [DELETE if f == GONE else min(DELETE, (TRUNCATED if f == CUT else 0) + (0 if r in "sua" and r else REROLE)) for r, f in rows]
    bound, after, between = [0] * (n + 1), -1, 0  # the next row that may stay, and what the rows before it cost
    for i in range(n - 1, -1, -1):
        r, f = rows[i]
        bound[i] = own[i] + bound[i + 1]
        if f == GONE:
            between += DELETE
            continue
        if after >= 0 and r and rows[after][0] and r in "sua" and rows[after][0] in "sua" and r + rows[after][0] not in LEGAL:
            change = min(INSERT, REROLE, DELETE - own[i], DELETE - own[after])
            bound[i] = max(bound[i], own[i] + between + own[after] + change + bound[after + 1])
        after, between = i, 0
    return bound


def _steps(rows: list[Row], i: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows done, state) of the edits at a node, in ASCII order."""
    nxt = _NEXT[state][0]
    if i == len(rows):
        return [("I", INSERT, i, nxt)]
    role, fault = rows[i]
    out = [("D", DELETE, i + 1, state), ("I", INSERT, i, nxt)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if (state, role) in _KEPT:
            out.append(("K", KEEP + more, i + 1, _KEPT[state, role]))
        out.append(("R", REROLE + more, i + 1, nxt))
    return out


def _dive(rows: list[Row], state: int, final: bool) -> dict[int, int]:
    """A first limit for each state at the end: the cost of always taking what is cheapest next."""
    cost, at = 0, state
    ends = {0: _FAR, 1: _FAR, 2: _FAR, 3: _FAR}
    for i, (_, fault) in enumerate(rows):
        ways = []
        for inserts in range(3):
            s = at
            for _ in range(inserts):
                s = _NEXT[s][0]
            ways += [(inserts * INSERT + c, to) for e, c, _, to in _steps(rows, i, s) if e != "I"]
        if i == len(rows) - 1:
            for c, to in ways:
                ends[to] = min(ends[to], cost + c)
        c, at = min(ways)
        cost += c
    if not rows:
        ends[state] = 0
    if final:
        best = min(ends[0], ends[3], ends[2] + INSERT, ends[1] + 2 * INSERT)
        return dict.fromkeys(ends, best)
    return ends


def branch_and_bound(rows: list[Row], state: int, final: bool) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, audit), ASCII-least of equals, from ``state`` to each state after the rows; where ``final``,
    the single best to an accepted end (key 3)."""
    n, bound = len(rows), suffix_bounds(rows)
    limit = {s: c + 1 for s, c in _dive(rows, state, final).items()}  # what a way has to cost less than
    found: dict[int, tuple[int, str]] = {}
    least = [[_FAR] * 4 for _ in range(n + 1)]  # dominance tables
    stack, path = [(0, "", 0, 0, state)], []
    while stack:
        depth, edit, cost, i, s = stack.pop()
        if cost >= least[i][s]:
            continue
        stays = 4 * (n - i)  # a state 0 or 1 at the end leaves no room for a row in between
        if final or s > 1:
            open_ = cost + bound[i] < max(limit[2], limit[3])
        else:
            open_ = (cost + bound[i] < max(limit[2], limit[3]) or cost + stays < limit[s]
                     or s == 0 and cost + stays - DELETE < limit[1])
        if not open_:
            continue
        least[i][s] = cost
        del path[max(0, depth - 1):]
        if depth:
            path.append(edit)
        if i == n and (not final or s in (0, 3)):
            end = 3 if final else s
            if cost < limit[end]:
                found[end] = (cost, "".join(path))
                limit = dict.fromkeys(limit, cost) if final else limit | {s: cost}
            continue
        for e, c, j, to in reversed(_steps(rows, i, s)):
            stack.append((depth + 1, e, cost + c, j, to))
    return found


def _solve(rows: list[Row], state: int, final: bool) -> dict[int, tuple[int, str]]:
    if len(rows) > 16:
        return branch_and_bound(rows, state, final)
    key = (state, final, tuple(rows))
    if key not in _CACHE:
        if len(_CACHE) >= CACHE_SIZE:
            _CACHE.clear()
        _CACHE[key] = branch_and_bound(rows, state, final)
    return _CACHE[key]


BLOCKS = ("key string, has boolean, turn long, role string, said string, whole boolean, n long, blank long, duplicate long, "
          "truncated long, illegal long, first string, last string, low long, high long, turns long, "
          "ways array<struct<entry:int,exit:int,cost:long,audit:string>>")


def _fault(row, first: bool) -> str:
    """The fault of a row's first copy or of its others."""
    if row.empty:
        return "blank"
    if row.seen or not first:
        return "duplicate"
    return "truncated" if row.cut else ""


class _Block:
    """Rows of one conversation, gathered until the block is full or the conversation ends."""

    def __init__(self, row, opens: bool):
        self.head, self.opens = row, opens
        self.rows: list[Row] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = None
        self.turns = 0

    def add(self, row, copies: int, first: bool) -> None:
        for i in range(copies):
            fault = _fault(row, first and i == 0)
            self.rows.append((row.role[:1], CUT if fault == "truncated" else GONE if fault else OK))
            if fault:
                self.faults[fault] += 1
        if first and row.has:
            if self.high != row.turn:
                self.turns += 1
            self.low = row.turn if self.low is None else self.low
            self.high = row.turn

    def out(self, closes: bool) -> tuple:
        """``whole``: the block is the conversation (its first row and its end are known to be here)."""
        whole = self.opens and closes
        ways = [{"entry": s, "exit": t, "cost": c, "audit": a} for s in ((0,) if self.opens else (0, 1, 2, 3))
                for t, (c, a) in sorted(_solve(self.rows, s, whole).items())]
        initials = [r for r, _ in self.rows]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        h = self.head
        return (h.key, bool(h.has), int(h.turn), h.role, h.said, whole, len(self.rows), *self.faults.values(), illegal,
                initials[0], initials[-1], self.low, self.high, self.turns, ways)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Solved blocks of sorted rows. The first and the last conversation of a task may go on in its neighbours."""
    names = [x.split()[0] for x in BLOCKS.split(", ")]
    block, out, new = None, [], False  # new: the task has seen another conversation before this one
    for batch in batches:
        for row in batch.itertuples(index=False):
            if block is not None and block.head.key != row.key:
                out.append(block.out(True))
                block, new = None, True
            left, first = int(row.n), True
            while left:
                if block is None:
                    block = _Block(row, new)
                elif len(block.rows) >= BLOCK:
                    out.append(block.out(False))
                    block = _Block(row, False)
                room = min(left, BLOCK - len(block.rows))
                block.add(row, room, first)
                left, first = left - room, False
        if len(out) >= 1000:
            yield _frame(out, names)
            out = []
    if block is not None:
        out.append(block.out(False))
    yield _frame(out, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"low": "Int64", "high": "Int64"})


REPORT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Chain:
    """The blocks of one conversation so far: the best (cost, audit) to each state."""

    def __init__(self, key: str):
        self.key, self.best = key, {0: (0, "")}
        self.sums = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last = self.low = self.high = None
        self.turns, self.done = 0, False

    def add(self, b) -> None:
        for k in self.sums:
            self.sums[k] += int(getattr(b, k))
        if self.last is not None and self.last + b.first not in LEGAL:
            self.sums["illegal"] += 1
        self.last = b.last
        if not pd.isna(b.low):
            self.turns += int(b.turns) - (self.high == b.low)
            self.low = b.low if self.low is None else self.low
            self.high = b.high
        best: dict[int, tuple[int, str]] = {}
        for w in b.ways:
            if w["entry"] in self.best:
                cost, audit = self.best[w["entry"]]
                way = (cost + w["cost"], audit + w["audit"])
                if w["exit"] not in best or way < best[w["exit"]]:
                    best[w["exit"]] = way
        self.best, self.done = best, b.whole

    def out(self) -> tuple:
        more = {0: "", 1: "II", 2: "I", 3: ""}
        ends = [(c, a) if self.done else (c + INSERT * len(more[s]), a + more[s]) for s, (c, a) in self.best.items()]
        cost, audit = min(ends)
        gaps = 0 if self.low is None else int(self.high) - int(self.low) + 1 - self.turns
        return (self.key, gaps, *self.sums.values(), cost, audit)


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in REPORT.split(", ")]
    chain, out = None, []
    for batch in batches:
        for b in batch.itertuples(index=False):
            if chain is not None and chain.key != b.key:
                out.append(chain.out())
                chain = None
            chain = chain or _Chain(b.key)
            chain.add(b)
        yield pd.DataFrame(out, columns=names)
        out = []
    if chain is not None:
        yield pd.DataFrame([chain.out()], columns=names)


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), conv.cast("string")), F.lit("n"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with a copy count, equal ones as one: ``key``, ``has`` / ``turn``, ``role``, ``said``, ``text``, ``n``."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    named = rows.select(_key(F.col("conv_id")).alias("key"), F.col("turn").isNotNull().alias("has"),
                        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), role.alias("role"),
                        F.sha2(text, 256).alias("said"), text.alias("text"), "copies")
    return named.groupBy("key", "has", "turn", "role", "said", "text").agg(F.sum("copies").alias("n"))


def _with_faults(ordered: DataFrame) -> DataFrame:
    """``empty``, ``cut`` and ``seen`` (the same role and text stand at an earlier turn) per counted row."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = ordered.select("key", "has", "turn", "role", "said", "n", (body == "").alias("empty"),
                          (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    twice = (rows.groupBy("key", "role", "said").agg(F.min(F.struct("has", "turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
             .filter("turns > 1").select("key", "role", "said", "first"))
    seen = F.coalesce(F.col("first") < F.struct("has", "turn"), F.lit(False))
    return (rows.join(staged(twice, "conv-twice"), ["key", "role", "said"], "left")
            .select("key", "has", "turn", "role", "said", "n", "empty", "cut", seen.alias("seen")))


ORDER = ["key", "has", "turn", "role", "said"]
REPAIRED = "key string, pos long, edit string, role string, text string"


def _applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The repaired rows in order, from each conversation's audit followed by its sorted rows."""
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    key, audit, at, state, pos = None, "", 0, 0, 0
    out: list[tuple] = []

    def inserts() -> None:
        nonlocal at, state, pos
        while at < len(audit) and audit[at] == "I":
            state, role = _NEXT[state]
            out.append((key, pos, "insert", role, ""))
            at, pos = at + 1, pos + 1

    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.kind == 0:
                inserts()
                key, audit, at, state, pos = row.key, row.text, 0, 0, 0
                continue
            for _ in range(int(row.n)):
                inserts()
                edit, role = audit[at], row.role
                at += 1
                if edit == "D":
                    continue
                if edit == "R":
                    state, role = _NEXT[state]
                else:
                    state = _KEPT[state, role[:1]]
                out.append((key, pos, "rerole" if edit == "R" else "keep", role, row.text))
                pos += 1
        if out:
            yield pd.DataFrame(out, columns=names)
            out.clear()
    inserts()
    yield pd.DataFrame(out, columns=names)


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of ``role:text`` lines of each conversation, over rows in order."""
    key, digest, out = None, None, []
    for batch in batches:
        for k, role, text in zip(batch["key"], batch["role"], batch["text"], strict=True):
            if k != key:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pd.DataFrame(out, columns=["key", "repaired_sha256"])
        out = []
    if digest is not None:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "repaired_sha256"])


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows) of the conversations in ``rows`` (``conv_id``, ``turn``, ``role``, ``text``; ``copies``
    where a row stands for several). The report has ``key`` and the counts, cost and audit; the repaired rows
    (``key``, ``pos``, ``edit``, ``role``, ``text``) come in order within their partition."""
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    ordered = staged(_ordered(rows), "conv-rows")
    faults = staged(_with_faults(ordered), "conv-faults")
    blocks = faults.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInPandas(_blocks, BLOCKS)
    chained = staged(blocks, "conv-blocks").repartition("key").sortWithinPartitions(*ORDER)
    report = staged(chained.mapInPandas(_chained, REPORT), "conv-report")
    zero, none = F.lit(0).cast("long"), F.lit("")
    audits = report.select("key", F.lit(0).alias("kind"), F.lit(False).alias("has"), zero.alias("turn"), none.alias("role"),
                           none.alias("said"), zero.alias("n"), F.col("audit").alias("text"))
    texts = ordered.select("key", F.lit(1).alias("kind"), "has", "turn", "role", "said", "n", "text")
    repaired = (audits.unionByName(texts).repartition("key").sortWithinPartitions("key", "kind", *ORDER[1:])
                .mapInPandas(_applied, REPAIRED))
    return report, repaired


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20 (a null is one space): 0 drops the row, 1 empties its text,
    2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said[2].alias("role"), said[3].alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.filter("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                                           text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: the report of ``rows`` and the digest of the repaired rows."""
    report, repaired = repair(rows)
    digests = repaired.mapInPandas(_digested, "key string, repaired_sha256 string")
    ids = conversations.select("conv_id").distinct()
    named = ids.select("conv_id", _key(F.col("conv_id")).alias("key"))
    out = named.join(report, "key", "left").join(digests, "key", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
