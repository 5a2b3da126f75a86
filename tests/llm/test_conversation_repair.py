import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from streamlens.llm import conversation_repair as C
from streamlens.llm.queries import QUERIES

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def cheapest(rows):
    """(cost, letters) by trying all edits; rows: (initial, cut off, must delete)."""
    @lru_cache(None)
    def best(i, q, inserted):
        found = [(0, "")] if i == len(rows) and q in (0, 3) else []
        if inserted < 4:
            c, a = best(i, NEXT[q], inserted + 1)
            found.append((c + 2, "I" + a))
        if i < len(rows):
            role, cut, must = rows[i]
            moves = [(3, "D", q)]
            if not must:
                moves += [(cut, "K", KEEP[role, q])] if (role, q) in KEEP else []
                moves.append((2 + cut, "R", NEXT[q]))
            for paid, letter, to in moves:
                c, a = best(i + 1, to, 0)
                found.append((c + paid, letter + a))
        return min(found, default=(10 ** 9, ""))
    for i in range(len(rows), 0, -1):  # from the end, so no call goes deep
        for q in range(4):
            best(i, q, 0)
    return best(0, 0, 0)


def repaired(rows, letters):
    out, at, q = [], 0, 0
    for x in letters:
        if x == "I":
            q = NEXT[q]
            out.append({2: "user:", 3: "assistant:"}[q])
            continue
        role, text = rows[at]
        at += 1
        if x == "K":
            q = KEEP[role[0], q]
            out.append(f"{role}:{text}")
        elif x == "R":
            q = NEXT[q]
            out.append({2: "user:", 3: "assistant:"}[q] + text)
    return "\n".join(out)


def brute(rows):
    """The contract's row of one conversation, rows (conv, turn, role, text) before damage."""
    after = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else x
        h = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        after += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in after if t is not None]
    seen, faults, symbols = set(), [], []
    for _, role, text in after:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                 else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
        faults.append(fault)
        symbols.append((role[:1], int(fault == "truncated"), fault in ("blank", "duplicate")))
    cost, audit = cheapest(tuple(symbols))
    text = repaired([r[1:] for r in after], audit)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(after, after[1:])]
    return {"conv_id": rows[0][0], "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def test_tables_are_small_and_solve_like_brute_force():
    assert len(C.tables().vectors) < 50
    rnd = random.Random(3)
    for _ in range(1500):
        rows = tuple((rnd.choice("suaaux"), int(rnd.random() < .3), rnd.random() < .2) for _ in range(rnd.randint(0, 14)))
        symbols = bytes(C.symbol(*r) for r in rows)
        assert C.solve(symbols)[:2] == cheapest(rows)


def test_composed_segments_equal_the_whole():
    rnd, t = random.Random(4), C.tables()
    for _ in range(300):
        symbols = bytes(rnd.randrange(C.N_SYMBOLS) for _ in range(rnd.randint(0, 40)))
        cuts = sorted(rnd.randint(0, len(symbols)) for _ in range(3))
        parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        v, low, afters = 0, 0, []
        for before, minus, _ in map(C.composed, reversed(parts)):
            afters.append(v)
            low, v = low + int(minus[v]), int(before[v])
        cost, letters, _ = C.solve(symbols)
        assert low + t.vectors[v][0] == cost
        state, found = 0, ""
        for i, (part, after) in enumerate(zip(parts, reversed(afters))):
            leave = C.composed(part)[2][after, state]
            _, more, state = C.solve(part, after, state, i == len(parts) - 1)
            found += more
            assert i == len(parts) - 1 or state == leave
        assert found == letters


def _random_rows(rnd, convs, turns):
    words = ["ok.", "yes!", "no", "  ", "", "what?", "cut off", "fine. \t"]
    out = []
    for c in range(convs):
        for t in range(rnd.randint(1, turns)):
            for _ in range(rnd.choice([1, 1, 1, 2])):
                out.append((c or None, rnd.choice([t, t, t, None, t + 3]),
                            rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                            rnd.choice([*words, None, f"text {rnd.random()}."])))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def _check(spark, rows, extra=None, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = extra(df)
    damaged, dropped = C.damaged(df)
    got = {r.conv: r for r in C.report(C.repair(damaged, absent=dropped, **options)).collect()}
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    assert got.keys() == groups.keys()
    for conv, g in groups.items():
        want = brute(g)
        assert {k: got[conv][k if k != "conv_id" else "conv"] for k in want} == want, conv


def test_repair_equals_brute_force_with_nulls_ties_and_repeats(spark):
    _check(spark, _random_rows(random.Random(1), 60, 8))


def test_hot_conversation_in_many_segments(spark):
    rnd = random.Random(2)
    rows = _random_rows(rnd, 5, 6) + [(77, i // 3, rnd.choice(["user", "assistant", "system"]), f"{rnd.randint(0, 40)}.")
                                      for i in range(300)] + [(78, 1, "user", "same")] * 150
    _check(spark, rows, lambda df: df.repartition(4), segment_rows=7)


def test_edge_tables(spark):
    assert C.report(C.repair(spark.createDataFrame([], SCHEMA))).collect() == []
    _check(spark, [(5, None, None, None)], lambda df: df.withColumns({"conv": F.lit(1), "uid": F.lit("x"), "h": F.lit(2),
                                                                      "digest": F.lit(0), "absent": F.lit(True)}))
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    _check(spark, [(9, dropped, "user", "gone")])
    _check(spark, [(1, t, "user" if t % 2 else "assistant", "x" * 200_000 + ".") for t in range(30)])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    groups = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        groups.setdefault(r.conv_id, []).append((r.conv_id, r.turn, r.role, r.text))
    got = QUERIES["op12_conversations"](spark, sf).collect()
    assert sorted((r.asDict() for r in got), key=lambda r: r["conv_id"]) == \
        sorted(map(brute, groups.values()), key=lambda r: r["conv_id"])
