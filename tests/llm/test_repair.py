"""The repair operator against a plain search over all edits, and its handling of edges."""

import hashlib
import random
import zlib

import pytest

from carestrata.llm import repair
from carestrata.llm.queries import llm_queries

SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """(cost, audit, repaired lines) by the plain recursion from the last row back, least audit first."""
    marks, n = faults(rows), len(rows)
    best = {}
    for i in range(n, -1, -1):
        here = {}
        for state in ("", "s", "u", "a"):
            options = []
            if i == n:
                if state in ("", "a"):
                    options.append((0, "", ()))
            else:
                role, text = rows[i]
                cost, audit, lines = best[i + 1][state]
                options.append((cost + 4, "D" + audit, lines))
                if marks[i] in ("", "truncated"):
                    more = 3 if marks[i] else 0
                    initial = role[:1]
                    if (initial == "s" and state == "") or (initial == NEXT[state]):
                        cost, audit, lines = best[i + 1][initial]
                        options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                    to = NEXT[state]
                    cost, audit, lines = best[i + 1][to]
                    options.append((cost + more + 3, "R" + audit, (f"{ROLE[to]}:{text}", *lines)))
            here[state] = options
        for _ in range(4):  # up to four insertions in a row; more never pay
            now = {s: min(o, key=lambda x: x[:2]) for s, o in here.items() if o}
            for state in here:
                to = NEXT[state]
                if to in now:
                    cost, audit, lines = now[to]
                    here[state] = [*here[state], (cost + 3, "I" + audit, (f"{ROLE[to]}:", *lines))]
        best[i] = {s: min(o, key=lambda x: x[:2]) for s, o in here.items()}
    return best[0][""]


def damaged(rows):
    """Conversations of ``(conv_id, turn, role, text)`` after damage, by turn (null first), role and digest."""
    out = {}
    told = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        role, text, kept = told(role), told(text), out.setdefault(conv, [])
        fault = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(*r[1:]))) for c, rs in out.items()}


def expected(rows):
    out = {}
    for conv, kept in damaged(rows).items():
        pairs = [(role, text) for _, role, text in kept]
        turns = [t for t, _, _ in kept if t is not None]
        marks = faults(pairs)
        cost, audit, lines = cheapest(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        told = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, told)
    return out


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = [(r["conv_id"], tuple(r[n] for n in names)) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def random_rows(pick, n_conversations, longest):
    texts = ["Yes.", "No", "  ", "", "Why?", "x", "done!", "é.", "Tell me. "]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = []
    for conv in range(n_conversations):
        for turn in range(pick.randint(1, longest)):
            text = pick.choice(texts) if pick.random() < 0.5 else f"Text {turn}."
            rows.append((conv or None, None if pick.random() < 0.05 else turn // 2 if pick.random() < 0.1 else turn, pick.choice(roles), None if pick.random() < 0.03 else text))
    return rows


def test_random_lattices():
    pick = random.Random(3)
    for _ in range(1500):
        pairs = [(pick.choice(["user", "assistant", "system", "tool"]), pick.choice(["a.", "b", "", "c?", f"{pick.random()}."])) for _ in range(pick.randint(0, 24))]
        piece = repair._Piece()
        seen = set()
        for role, text in pairs:
            piece.add(0, role, text, 1, (role, text) in seen)
            seen.add((role, text))
        cost, audit, said, _ = repair._repaired(repair.Lattice(piece.rows, repair.END, True), piece.roles, piece.texts, repair.NOTHING)
        assert (cost, audit, said) == (*cheapest(pairs)[:2], "\n".join(cheapest(pairs)[2]))


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("limit", [128, 3])
def test_random_conversations(spark, limit):
    """Also with pieces of three rows, so that prices cross many borders."""
    rows = random_rows(random.Random(limit), 60, 14)
    left, dropped = repair.damage(spark.createDataFrame(rows, SCHEMA).repartition(5))
    parts = repair.repair_conversations(left, dropped, piece_rows=limit)
    assert results(repair.repair_digests(parts)) == expected(rows)


def test_one_very_large_conversation(spark):
    pick = random.Random(9)
    rows = [(1, t, pick.choice(["user", "assistant", "assistant", "user", "system"]), pick.choice([f"Text {t}.", "same.", "cut"])) for t in range(1200)]
    rows += [(2, 0, "user", "equal.")] * 700 + [(2, 1, "assistant", "Fine.")]
    left, dropped = repair.damage(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert results(repair.repair_digests(repair.repair_conversations(left, dropped))) == expected(rows)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(llm_queries()["op13_auction_repair"](spark, sf_dir)) == expected(rows)


def test_edges(spark):
    rows = [(1, None, None, None), (1, 5, "user", "x" * 2_000_000), (None, 0, "user", "Hi."), (None, 0, "user", "Hi."), (3, -4, "assistant", "\x1d.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS digest", "1 AS what", "2 AS n", "3 AS part", "4 AS c")
    left, dropped = repair.damage(df)
    assert results(repair.repair_digests(repair.repair_conversations(left, dropped))) == expected(rows)
    clash = df.withColumn("turn", df["turn"])
    assert {r["conv_id"] for r in repair.repair_conversations(clash).collect()} == {1, None, 3}
    left, dropped = repair.damage(spark.createDataFrame([], SCHEMA))
    assert repair.repair_digests(repair.repair_conversations(left, dropped)).count() == 0
    only = repair.repair_digests(repair.repair_conversations(left, spark.createDataFrame([(7,)], "conv_id long")))
    assert results(only) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
