"""Conversation structure repair: the cheapest edits that turn a conversation's
roles into ``(s?(ua)+)?``, with an audit of every edit.

A row is a symbol: its role's initial (s, u, a or other) and its fault (blank,
duplicate, truncated or none).  The grammar is an automaton of four states, so a
symbol is a 4 x 4 min-plus matrix of costs (insertions before the row, then the
row's own edit), and k equal symbols in a row are the k-th power of it, which is
applied to a vector of costs by the cached binary powers of that matrix.  Going
backwards over the runs gives the cost that is left from every state; going
forwards, the audit takes at each row the ASCII-least edit that keeps the total.

Rows are dealt out by range of (conversation, turn, role, text), so a
conversation of a third of all rows spreads over the partitions.  A task solves the
conversations that lie wholly inside its rows.  Of the others it leaves segments of
at most ``SEGMENT_ROWS`` rows or ``SEGMENT_BYTES`` of text with the segment's
matrix.  A conversation's matrices (one small row for each segment) give the costs
behind each segment; each segment then finds where it leads to from each of the
four states, those maps follow one another to give its entry state, and the segments
are edited each by itself.

Only the digest of a conversation of many segments has to pass through one task, as
a hash of a whole text has an order; that task reads the edited segments one by one
and keeps none.

Defined results: null roles and texts count as one space; a null conversation id is
a conversation of its own; rows are ordered by turn (nulls first), then role, then
text; rows that are equal in all four stand next to each other, and all but the first
are duplicates; an empty role can not be kept; texts are taken whole; an empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

#: rows and bytes of text of a segment of a conversation that leaves its partition
SEGMENT_ROWS, SEGMENT_BYTES = 65_536, 8 << 20
#: finished conversations of one Arrow batch
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
#: characters of a text that take part in dealing rows out by range
HEAD_CHARS = 32
NO_SPACE = r"[^\x20\x09-\x0D]"

# ---- the automaton ------------------------------------------------------------
# States: 0 nothing yet, 1 after the system turn, 2 after a user, 3 after an assistant.

FAR = 1 << 60
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
#: the state that a user or assistant turn leads to
NEXT = (2, 2, 3, 2)
#: the role that is due in each state
DUE = ("user", "user", "assistant", "user")
#: costs to an accepted end: a system turn alone needs a pair, a user an answer
CLOSE = (0, 4, 2, 0)


def keeps(symbol: str, state: int) -> int | None:
    """The state after keeping a row, where that is allowed."""
    role = symbol.lower()
    if role == "s":
        return 1 if state == 0 else None
    if role == ("a" if state == 2 else "u"):
        return NEXT[state]
    return None


@functools.cache
def transition(symbol: str) -> tuple:
    """Costs from state to state over one row, insertions before it included.
    Upper case: truncated; X: must be deleted."""
    rows = []
    for start in range(4):
        costs, state, spent = [FAR] * 4, start, 0
        for _ in range(4):                  # after three insertions states repeat
            costs[state] = min(costs[state], spent + DELETE)
            if symbol != "X":
                extra = CUT_OFF if symbol.isupper() else 0
                kept = keeps(symbol, state)
                if kept is not None:
                    costs[kept] = min(costs[kept], spent + extra)
                costs[NEXT[state]] = min(costs[NEXT[state]], spent + extra + REROLE)
            state, spent = NEXT[state], spent + INSERT
        rows.append(tuple(costs))
    return tuple(rows)


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices."""
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def onto(a: tuple, v: tuple) -> tuple:
    """Min-plus product of a matrix and a vector."""
    v0, v1, v2, v3 = v
    return tuple(min(r[0] + v0, r[1] + v1, r[2] + v2, r[3] + v3) for r in a)


@functools.cache
def power(symbol: str, j: int) -> tuple:
    """The transition over 2**j equal symbols."""
    if j == 0:
        return transition(symbol)
    half = power(symbol, j - 1)
    return times(half, half)


def over_run(symbol: str, k: int, v: tuple) -> tuple:
    """Costs left before k equal symbols, by the binary powers."""
    j = 0
    while k:
        if k & 1:
            v = onto(power(symbol, j), v)
        k, j = k >> 1, j + 1
    return v


IDENTITY = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


def run_matrix(runs: list[tuple[str, int]]) -> tuple:
    """Costs from state to state over all runs."""
    m = IDENTITY
    for symbol, k in runs:
        j = 0
        while k:
            if k & 1:
                m = times(m, power(symbol, j))
            k, j = k >> 1, j + 1
    return m


def edits(runs: list[tuple[str, int]], state: int, behind: tuple, last: bool) -> tuple[str, int]:
    """(audit, state after it) of the cheapest edits from ``state``, where
    ``behind`` are the costs after the runs; ties go to the ASCII-least audit."""
    ahead = [behind]                        # costs before each run, and after the last
    for symbol, k in reversed(runs):
        ahead.append(over_run(symbol, k, ahead[-1]))
    ahead.reverse()
    audit = []
    for (symbol, k), after in zip(runs, ahead[1:]):
        left = [after]                      # costs before the run's last 0, 1, .. k rows
        step = transition(symbol)
        for _ in range(k):
            left.append(onto(step, left[-1]))
        extra = CUT_OFF if symbol.isupper() else 0
        while k:
            now, then = left[k], left[k - 1]
            due = now[state]
            kept = keeps(symbol, state) if symbol != "X" else None
            if due == DELETE + then[state]:
                audit.append("D")
                k -= 1
            elif due == INSERT + now[NEXT[state]]:
                audit.append("I")
                state = NEXT[state]
            elif kept is not None and due == extra + then[kept]:
                audit.append("K")
                state = kept
                k -= 1
            else:
                audit.append("R")
                state = NEXT[state]
                k -= 1
    while last and state in (1, 2):
        audit.append("I")
        state = NEXT[state]
    return "".join(audit), state


def edited(rows: list[tuple], audit: str, state: int) -> list[tuple[str, str]]:
    """The (role, text) turns that the audit leaves of (role, text, copies) rows."""
    out, at = [], iter(audit)
    for role, text, copies in rows:
        while copies:
            edit = next(at)
            if edit == "I":
                out.append((DUE[state], ""))
                state = NEXT[state]
                continue
            copies -= 1
            if edit == "K":
                out.append((role, text))
                state = 1 if role[0] == "s" else NEXT[state]
            elif edit == "R":
                out.append((DUE[state], text))
                state = NEXT[state]
    for _ in at:
        out.append((DUE[state], ""))
        state = NEXT[state]
    return out


# ---- faults -------------------------------------------------------------------

def with_faults(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """Equal rows as one with its number of ``copies``, and what is wrong with
    the first of them: ``blank``, ``duplicate``, ``truncated`` or nothing.

    The first turn of each (role, text) of a conversation is an aggregate, so a
    text that fills a conversation costs a row a task and no window."""
    one = F.lit(1).cast("long") if copies is None else F.col(copies).cast("long")
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    unlike = (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                          one.alias("copies"))
              .groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
              .withColumn("name", F.md5(F.concat("role", F.lit("\n"), "text"))))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (unlike.groupBy(F.col("conv_id").alias("c"), F.col("name").alias("m"))
             .agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").select("c", "m", "first"))
    joined = unlike.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("name") == F.col("m")), "left")
    fault = (F.when(~F.col("text").rlike(NO_SPACE), "blank")
             .when(F.col("first").isNotNull() & (turn != F.col("first")), "duplicate")
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"))
    return joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


# ---- segments -----------------------------------------------------------------

TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())]))
RUNS = pa.list_(pa.struct([("symbol", pa.string()), ("n", pa.int64())]))
PIECE = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("nth", pa.int64()), ("whole", pa.bool_()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("runs", RUNS), ("matrix", pa.list_(pa.int64())), ("rows", ROWS), ("cost", pa.int64()), ("audit", pa.string()),
    ("repaired", TURNS)])
_ROWS_SQL = "array<struct<role:string,text:string,copies:bigint>>"
_TURNS_SQL = "array<struct<role:string,text:string>>"
PIECE_SQL = ("conv_id bigint, part bigint, nth bigint, whole boolean, first_turn bigint, last_turn bigint, turns bigint, "
             "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string, last_initial string, "
             f"runs array<struct<symbol:string,n:bigint>>, matrix array<bigint>, rows {_ROWS_SQL}, cost bigint, audit string, "
             f"repaired {_TURNS_SQL}")
LEGAL = ("su", "ua", "au")


class _Segment:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.runs, self.size = conv_id, [], [], 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.first_turn = self.last_turn = None
        self.turns = self.illegal = 0
        self.first = self.last = None

    def add(self, turn, role, text, copies, fault):
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1                  # a role beside itself is never legal
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        kind = initial if initial in ("s", "u", "a") else "o"
        if fault in ("blank", "duplicate"):
            symbols = [("X", copies)]
        else:
            symbols = [(kind.upper() if fault else kind, 1), ("X", copies - 1)]
            self.counts["duplicate"] += copies - 1
        if fault:
            self.counts[fault] += copies if fault != "truncated" else 1
        for symbol, n in symbols:
            if n and self.runs and self.runs[-1][0] == symbol:
                self.runs[-1] = (symbol, self.runs[-1][1] + n)
            elif n:
                self.runs.append((symbol, n))
        self.rows.append((role, text, copies))
        self.size += len(text)

    def record(self, part: int, nth: int, whole: bool) -> dict:
        out = {"conv_id": self.conv_id, "part": part, "nth": nth, "whole": whole, "first_turn": self.first_turn,
               "last_turn": self.last_turn, "turns": self.turns, **self.counts, "illegal": self.illegal,
               "first_initial": self.first, "last_initial": self.last}
        if whole:
            audit, _ = edits(self.runs, 0, CLOSE, True)
            cost = CLOSE
            for symbol, k in reversed(self.runs):
                cost = over_run(symbol, k, cost)
            turns = edited(self.rows, audit, 0)
            return out | {"cost": cost[0], "audit": audit, "repaired": [{"role": r, "text": t} for r, t in turns]}
        return out | {"runs": [{"symbol": s, "n": n} for s, n in self.runs],
                      "matrix": [x for row in run_matrix(self.runs) for x in row],
                      "rows": [{"role": r, "text": t, "copies": c} for r, t, c in self.rows]}


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a partition's sorted rows."""
    from pyspark import TaskContext

    part, out, weight, nth = TaskContext.get().partitionId(), [], 0, 0
    now, opened, first_of_part = None, False, True

    def close(whole: bool):
        nonlocal nth, weight
        out.append(now.record(part, nth, whole))
        nth += 1
        weight += now.size

    for b in batches:
        for conv_id, turn, role, text, copies, fault in zip(*(b.column(i).to_pylist() for i in range(6))):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    # the partition's first conversation may have begun in the one before
                    close(not (opened or first_of_part))
                    first_of_part = False
                now, opened = _Segment(conv_id), False
            elif len(now.rows) >= most or now.size >= SEGMENT_BYTES:
                close(False)
                now, opened = _Segment(conv_id), True
            now.add(turn, role, text, copies, fault)
            if len(out) >= BATCH_ROWS or weight >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(out, PIECE)
                out.clear()
                weight = 0
    if now is not None:
        close(False)                                # and its last may go on in the next
    if out:
        yield pa.RecordBatch.from_pylist(out, PIECE)


def pieces(marked: DataFrame, most: int = SEGMENT_ROWS) -> DataFrame:
    """Solved conversations, and segments of those that leave their partition."""
    dealt = (marked.withColumn("head", F.substring("text", 1, HEAD_CHARS))
             .repartitionByRange("conv_id", "turn", "role", "head")
             .sortWithinPartitions("conv_id", "turn", "role", "text")
             .select("conv_id", "turn", "role", "text", "copies", "fault"))
    return dealt.mapInArrow(functools.partial(_cut, most=most), PIECE_SQL)


# ---- conversations of several segments ------------------------------------------

def _unflat(m) -> tuple:
    m = [int(x) for x in m]
    return tuple(tuple(m[i:i + 4]) for i in range(0, 16, 4))


def _behind(rows: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each segment of a conversation; turns that two segments share,
    and adjacent roles of two segments, are settled here too."""
    rows = rows.sort_values(["part", "nth"])
    v, out = CLOSE, []
    for m in reversed(rows["matrix"].tolist()):
        out.append(list(v))
        v = onto(_unflat(m), v)
    rows["behind"] = out[::-1]
    rows["is_last"] = [False] * (len(rows) - 1) + [True]
    shared, illegal, last_turn, last = [], [], None, None
    for first_turn, end, a, z in zip(rows["first_turn"], rows["last_turn"], rows["first_initial"], rows["last_initial"]):
        same = last_turn is not None and not pd.isna(first_turn) and first_turn == last_turn
        shared.append(int(same))
        illegal.append(int(last is not None and last + a not in LEGAL))
        last_turn, last = end if not pd.isna(end) else last_turn, z
    rows["shared"], rows["between"] = shared, illegal
    return rows[["conv_id", "part", "nth", "behind", "is_last", "shared", "between"]]


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each segment leads to from each state."""
    for b in batches:
        rows = [{"conv_id": r["conv_id"], "part": r["part"], "nth": r["nth"],
                 "leads": [edits([(x["symbol"], x["n"]) for x in r["runs"]], s, tuple(r["behind"]), False)[1] for s in range(4)]}
                for r in b.to_pylist()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("part", pa.int64()),
                                                              ("nth", pa.int64()), ("leads", pa.list_(pa.int64()))]))


def _entries(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["part", "nth"])
    state, out = 0, []
    for leads in rows["leads"]:
        out.append(state)
        state = int(leads[state])
    rows["entry"] = out
    return rows[["conv_id", "part", "nth", "entry"]]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edited segments; a segment's cost is what its edits cost."""
    for b in batches:
        for i in range(b.num_rows):
            r = b.slice(i, 1).to_pylist()[0]
            runs, behind = [(x["symbol"], x["n"]) for x in r["runs"]], tuple(r["behind"])
            audit, state = edits(runs, r["entry"], behind, r["is_last"])
            before = behind
            for symbol, k in reversed(runs):
                before = over_run(symbol, k, before)
            cost = before[r["entry"]] - (0 if r["is_last"] else behind[state])
            turns = edited([(x["role"], x["text"], x["copies"]) for x in r["rows"]], audit, r["entry"])
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": r["conv_id"], "part": r["part"], "nth": r["nth"], "cost": cost, "audit": audit,
                  "repaired": [{"role": a, "text": t} for a, t in turns]}],
                pa.schema([PIECE.field(c) for c in ("conv_id", "part", "nth", "cost", "audit", "repaired")]))


def _same(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """Inner join on columns of equal names, null conversations included."""
    other = right.select([F.col(c).alias(f"_{c}") if c in names else F.col(c) for c in right.columns])
    on = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])
    return left.join(other, on).drop(*[f"_{c}" for c in names])


def repair(rows: DataFrame, copies: str | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Pieces of the repaired conversations of (conv_id, turn, role, text) rows,
    with a column that says how often a row stands there if ``copies`` names one:
    conv_id, part and nth (their order), counts of faults, ``cost``, ``audit`` and
    the ``repaired`` turns."""
    found = stored(pieces(with_faults(rows, copies), segment_rows), "turns")
    solved = found.where("whole").select(*_PIECES, F.lit(0).alias("shared"), F.lit(0).alias("between"))
    segments = found.where("not whole")
    keys = ("conv_id", "part", "nth")
    small = segments.select(*keys, "first_turn", "last_turn", "first_initial", "last_initial", "matrix")
    behind = stored(small.groupBy("conv_id").applyInPandas(
        _behind, "conv_id bigint, part bigint, nth bigint, behind array<bigint>, is_last boolean, shared int, between int"), "behind")
    leads = _same(segments.select(*keys, "runs"), behind.select(*keys, "behind"), *keys).mapInArrow(
        _maps, "conv_id bigint, part bigint, nth bigint, leads array<bigint>")
    entries = leads.groupBy("conv_id").applyInPandas(_entries, "conv_id bigint, part bigint, nth bigint, entry int")
    ready = _same(_same(segments.select(*keys, "runs", "rows"), behind.select(*keys, "behind", "is_last"), *keys), entries, *keys)
    done = ready.mapInArrow(_apply, f"conv_id bigint, part bigint, nth bigint, cost bigint, audit string, repaired {_TURNS_SQL}")
    counts = segments.select(*[c for c in _PIECES if c not in ("cost", "audit", "repaired")])
    opened = _same(_same(counts, behind.select(*keys, "shared", "between"), *keys), done, *keys)
    return solved.unionByName(opened.select(solved.columns))


_PIECES = ("conv_id", "part", "nth", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal",
           "cost", "audit", "repaired")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, digest) of conversations whose pieces come in order."""
    now, digest, empty, out = (), None, True, []
    for b in batches:
        for conv_id, lines in zip(b.column(0).to_pylist(), b.column(1)):
            if now != (conv_id,):
                if now:
                    out.append((now[0], digest.hexdigest()))
                now, digest, empty = (conv_id,), hashlib.sha256(), True
            lines = lines.as_py()
            if lines:
                digest.update(lines.encode() if empty else b"\n" + lines.encode())
                empty = False
    if now:
        out.append((now[0], digest.hexdigest()))
    if out:
        ids, hashes = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes)], names=["conv_id", "repaired_sha256"])


def digest(rows: DataFrame, originals: DataFrame, copies: str | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """A row for each conversation of ``originals``: gaps, faults, cost, audit and
    the digest of its repaired turns."""
    done = stored(repair(rows, copies, segment_rows).withColumn(
        "lines", F.array_join(F.transform("repaired", lambda t: F.concat(t.role, F.lit(":"), t.text)), "\n")).drop("repaired"), "repaired")
    order = F.struct("part", "nth", "audit")
    turns = F.sum("turns") - F.sum("shared")
    sums = done.groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - turns, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.sum("between")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x.audit), "").alias("audit"),
        F.count(F.lit(1)).alias("pieces"), F.max(F.sha2("lines", 256)).alias("sha"))
    many = sums.where("pieces > 1").select("conv_id")
    hashed = (_same(done.select("conv_id", "part", "nth", "lines"), many, "conv_id")
              .repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth").select("conv_id", "lines")
              .mapInArrow(_hashed, "conv_id bigint, repaired_sha256 string"))
    hashed = hashed.select(F.col("conv_id").alias("h"), "repaired_sha256")
    sums = sums.join(hashed, F.col("conv_id").eqNullSafe(F.col("h")) & (F.col("pieces") > 1), "left")
    named = sums.select(F.col("conv_id").alias("c"), *[F.col(x).cast("long").alias(x) for x in COUNTS], "audit",
                        F.coalesce("repaired_sha256", "sha").alias("repaired_sha256"))
    everyone = originals.select("conv_id").distinct()
    return (everyone.join(named, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select("conv_id", *[F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in COUNTS],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of the registered query, damaged by crc32 of ``conv_id:turn``
    modulo 20: 0 drops the row, 1 empties its text, 2 takes its ``.!?`` out, 3
    makes it two, 4 sets its role to user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    harm = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("harm"))
    return harm.where("harm <> 0").select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 3, 2).otherwise(1).alias("copies"))
