"""Conversation repair against a plain search over (cost, audit)."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerlake.llm import turn_repair as R

WS = " \t\n\x0b\x0c\r"
AFTER, DUE = {0: 2, 1: 2, 2: 3, 3: 2}, {0: "user", 1: "user", 2: "assistant", 3: "user"}


def damage(rows):
    out = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k:
            x = {1: "", 2: x.translate({ord(z): None for z in ".!?"})}.get(k, x)
            out += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def solved(rows):
    """Least (cost, audit, turns) by comparing whole tuples, row by row from the end."""
    seen, faults = set(), []
    for _, _, r, x in rows:
        kind = "blank" if not x.strip(WS) else "duplicate" if (r, x) in seen else "" if x.rstrip(WS)[-1] in ".!?" else "truncated"
        seen.add((r, x))
        faults.append(kind)
    best = None
    for i in range(len(rows), -1, -1):
        now = {}
        for q in range(4):
            ways = [(0, "", ())] if i == len(rows) and q in (0, 3) else []
            if i < len(rows):
                _, _, r, x = rows[i]
                cut = int(faults[i] == "truncated")
                k, a, t = best[q]
                ways.append((k + 3, "D" + a, t))
                if faults[i] in ("", "truncated"):
                    to = 1 if q == 0 and r[:1] == "s" else AFTER[q] if r[:1] == DUE[q][0] else None
                    if to is not None:
                        k, a, t = best[to]
                        ways.append((k + cut, "K" + a, ((r, x),) + t))
                    k, a, t = best[AFTER[q]]
                    ways.append((k + cut + 2, "R" + a, ((DUE[q], x),) + t))
            now[q] = min(ways, default=(1 << 40, "", ()))
        for _ in range(4):
            for q in range(4):
                k, a, t = now[AFTER[q]]
                now[q] = min(now[q], (k + 2, "I" + a, ((DUE[q], ""),) + t))
        best = now
    cost, audit, turns = best[0]
    first = [r[2][:1] for r in rows]
    known = [r[1] for r in rows if r[1] is not None]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest())


def brute(rows, harmed):
    by = defaultdict(list)
    for r in harmed:
        by[r[0]].append(r)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
    return sorted(((c, *solved(sorted(by[c], key=order))) for c in {r[0] for r in rows}), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, fault string, n int")


def random_rows(r, convs, most, texts=("Yes.", "No", "", " ", "Go on!", "a b? ", "é.\n", "Yes")):
    roles = ["user", "assistant", "system", "tool", "", "USER", "union", None]
    out = []
    for c in range(convs):
        for t in range(r.randrange(1, most)):
            role = r.choice(roles) if r.random() < 0.3 else ("user", "assistant")[t % 2]
            out.append((c if c else None, None if r.random() < 0.05 else t + r.randrange(2) * 2, role, r.choice(texts) if r.random() < 0.6 else f"Text {t} of {c}."))
    return out + out[::17]


@pytest.mark.parametrize("segment_rows", [R.SEGMENT_ROWS, 3])
def test_damaged_tables_equal_brute_force(spark, segment_rows):
    rows = random_rows(random.Random(2), 60, 14)
    df = frame(spark, rows)
    got = R.digest(R.damaged(df), df, "copies", segment_rows).collect()
    assert got[0].__fields__ == ["conv_id", *R.COUNTS, "audit", "repaired_sha256"]
    assert sorted(map(tuple, got), key=str) == brute(rows, damage(rows))


def test_a_conversation_over_many_partitions_equals_brute_force(spark):
    """One conversation with most rows is dealt out by turn."""
    r = random.Random(9)
    rows = random_rows(r, 8, 10) + [(99, t, r.choice(["user", "assistant", "assistant", "system"]), r.choice(["Ok.", f"Say {t}.", f"cut {t}", ""]))
                                    for t in range(900)]
    df = frame(spark, rows)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert R.pieces(R.with_faults(df)).where("conv_id = 99").count() > 3
        got = R.digest(df, df)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, [(c, t, " " if x is None else x, " " if y is None else y) for c, t, x, y in rows])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_segments_follow_one_another():
    """Any cut of a conversation into segments gives the audit of the whole."""
    r = random.Random(3)
    for _ in range(300):
        symbols = [r.choice("suaoSUAOX") for _ in range(r.randrange(1, 14))]
        runs = [(s, r.randrange(1, 4)) for s in symbols]
        whole, _ = R.edits(runs, 0, R.CLOSE, True)
        cut = r.randrange(len(runs) + 1)
        v = R.onto(R.run_matrix(runs[cut:]), R.CLOSE)
        first, state = R.edits(runs[:cut], 0, v, cut == len(runs))
        second, _ = R.edits(runs[cut:], state, R.CLOSE, True) if cut < len(runs) else ("", 0)
        assert first + second == whole


def test_binary_powers_equal_steps():
    for s in "suaoSUAOX":
        v, m = R.CLOSE, R.IDENTITY
        for k in range(1, 40):
            v, m = R.onto(R.transition(s), v), R.times(m, R.transition(s))
            assert R.over_run(s, k, R.CLOSE) == v and R.run_matrix([(s, k)]) == m


def test_defined_results(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (2, 0, None, None), (None, None, "user", "x" * 50_000 + "."),
            (3, 0, "assistant", "A."), (3, 1, "system", "S.")]
    df = frame(spark, rows)
    got = {r.conv_id: r for r in R.digest(df, df).collect()}
    assert got[1].audit == "DIK" or got[1].audit == "KDI"
    assert got[2].audit == "D" and got[2].blank == 1 and got[2].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None].audit == "KI" and got[None].gaps == 0
    assert sorted(map(tuple, got.values()), key=str) == brute(rows, [(c, t, x or " ", y or " ") for c, t, x, y in rows])
    assert R.digest(df.limit(0), df.limit(0)).count() == 0
    lost = R.digest(df.limit(0), df).collect()
    assert {tuple(r)[1:8] for r in lost} == {(0, 0, 0, 0, 0, 0, "")}
    turns = R.repair(df).where("conv_id = 3").first()
    assert [(t.role, t.text) for t in turns.repaired][-1][0] == "assistant" and turns.audit == got[3].audit
