"""Conversation repair against a search over all edits, and edge rows."""

import hashlib
import random
import re
from functools import lru_cache

import pytest

from tonality.llm.conversations import SPILL_BYTES, damage, repair, repaired_rows

SCHEMA = "conv_id long, turn long, role string, text string"


def first_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best_edits(rows):
    """(cost, audit, repaired lines) by trying every edit, the audits as strings."""
    faults = first_faults(rows)

    @lru_cache(None)
    def go(i, last):
        """Cheapest (cost, audit, lines) from row i on; ``last``: initial of what came last."""
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        emit = lambda c: (c == "u" and last != "u") or (c == "a" and last == "u") or (c == "s" and last == "")
        if i < len(rows):
            role, text = rows[i]
            cost, audit, lines = go(i + 1, last)
            found.append((cost + 3, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                late = int(faults[i] == "truncated")
                if emit(role[:1]):
                    cost, audit, lines = go(i + 1, role[:1])
                    found.append((cost + late, "K" + audit, (f"{role}:{text}", *lines)))
                for name in ("user", "assistant"):
                    if emit(name[0]):
                        cost, audit, lines = go(i + 1, name[0])
                        found.append((cost + late + 2, "R" + audit, (f"{name}:{text}", *lines)))
        # an insertion only helps where the next edit or the end needs it
        name = "assistant" if last == "u" else "user"
        if (i, last) not in busy and len(busy) < 3:
            busy.add((i, last))
            go.cache_clear()
            cost, audit, lines = go(i, name[0])
            busy.discard((i, last))
            go.cache_clear()
            found.append((cost + 2, "I" + audit, (f"{name}:", *lines)))
        return min(found) if found else (10**6, "", ())

    busy = set()
    return go(0, "")


def ordered(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    return sorted([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows], key=key)


def expected(rows):
    rows = ordered(rows)
    turns = [t for t, _, _ in rows if t is not None]
    plain = [(r, x) for _, r, x in rows]
    faults = first_faults(plain)
    cost, audit, lines = best_edits(plain)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(plain, plain[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        "n_rows": len(rows),
    }


def conversation(seed):
    r = random.Random(seed)
    out = []
    for turn in range(r.randint(1, 6)):
        role = r.choice(["user", "user", "assistant", "assistant", "system", "tool", "unknown", "", None])
        text = r.choice(["hi.", "hi.", "what", "", " \t\n", "so?", "done! ", None, f"t{turn}."])
        out.append((r.choice([turn, turn, turn + 2, None, 3]), role, text))
    return out


def test_repairs_equal_a_search_over_all_edits(spark):
    convs = {i: conversation(i) for i in range(150)} | {None: conversation(999)}
    rows = [(c, *r) for c, found in convs.items() for r in found]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r["conv_id"]: r.asDict() for r in repair(df).collect()}
    assert set(got) == set(convs)
    for c, found in convs.items():
        mine = got[c]
        assert {k: mine[k] for k in expected(found)} == expected(found), (c, ordered(found))


def test_giant_conversation_spills_and_keeps_its_result(spark):
    roles = ["user", "assistant", "user", "user", "assistant", "system"]
    rows = [(1, i, roles[i * i % 6], f"row {i}" + ("." if i % 3 else "")) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole, spilt = repair(df, SPILL_BYTES).first(), repair(df, 512).first()
    assert whole == spilt and whole["n_rows"] == 4000
    plain = [(r, x) for _, _, r, x in rows]
    kept = whole["audit"].replace("I", "")
    assert len(kept) == 4000
    cost = sum({"K": 0, "R": 2, "D": 3}[e] + (e != "D" and not x.endswith(".")) for e, (_, x) in zip(kept, plain))
    assert cost + 2 * whole["audit"].count("I") == whole["cost"]


def test_applied_edits_give_the_hashed_rows(spark):
    rows = [(c, *r) for c in range(40) for r in conversation(c)]
    df = damage(spark.createDataFrame(rows, SCHEMA))
    found = repair(df)
    lines: dict = {}
    for r in sorted(repaired_rows(df, found).collect(), key=lambda r: (r["conv_id"], r["position"])):
        lines.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for r in found.collect():
        own = lines.get(r["conv_id"], [])
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == r["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(a[:1] for a, _ in own))


def test_conversations_without_rows_nulls_and_clashing_columns(spark):
    rows = [(1, 0, "user", "a.", True, "x"), (None, None, None, None, False, "y"), (2, 5, "user", "a.", False, "z"), (2, 5, "user", "a.", False, "z")]
    df = spark.createDataFrame(rows, f"{SCHEMA}, dropped boolean, kind string")
    got = {r["conv_id"]: r for r in repair(df).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[1]["cost"], got[1]["audit"], got[1]["repaired_sha256"], got[1]["n_rows"]) == (0, "", empty, 0)
    assert (got[None]["blank"], got[None]["audit"], got[None]["gaps"]) == (1, "D", 0)
    assert (got[2]["duplicate"], got[2]["audit"]) == (1, "KDI")
    assert repair(df.limit(0)).collect() == []
    assert repaired_rows(df.limit(0), repair(df.limit(0))).collect() == []


@pytest.mark.parametrize("turns", [10**18, -(10**18)])
def test_large_turns_stay_whole(spark, turns):
    df = spark.createDataFrame([(turns, turns, "user", "a."), (turns, turns + 3, "assistant", "b."), (None, None, "user", "c.")], SCHEMA)
    got = {r["conv_id"]: r for r in repair(df).collect()}
    assert got[turns]["gaps"] == 2 and got[turns]["audit"] == "KK"
