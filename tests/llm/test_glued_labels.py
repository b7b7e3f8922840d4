"""Labels glued to the personal data they introduce."""

import collections
import math
import random
import time

import pytest

DOC = "doc_id long, text string"


@pytest.mark.parametrize("label", ["tel:", "phone="])
def test_glued_label_finds_unseen_values(spark, label):
    from carestrata.llm.pii import find_personal_data

    rows = [(i, f"words number {i} {label}+1 555 010 {1000 + i} now") for i in range(10)]
    rows += [(100, f"please {label}0171-555-1234 now"), (101, "an ordinary 0171-555-9999 number")]
    rows += [(200 + i, f"code ref:77{i}1 555 123{i} came") for i in range(9)] + [(300, "code ref:+1 555 010 3333")]
    found = {r["doc_id"]: r for r in find_personal_data(spark.createDataFrame(rows, DOC)).collect()}
    start = len(f"please {label}")
    assert [tuple(s) for s in found[100]["found"]] == [(3, start, start + 13)]
    assert not any(found[i]["found"] for i in (101, *range(200, 209)))


def test_contexts_are_cut_at_values():
    from carestrata.llm.pii import contexts, pattern_keys

    text = "my tel:0171-555-1234 and " + "x" * 100 + "=77"
    found = contexts(text, [7, text.index("77")])
    assert found[7] == pattern_keys(["my", "tel"]) and found[text.index("77")] == pattern_keys(["and", "x" * 100])
    assert contexts("77", [0]) == {0: []} and len(contexts("a 77", [2])[2]) == 1


def plain_graph(rows, min_seeds, min_confidence, rounds):
    """Trusted (pattern, kind) by plain loops over ``(patterns, kind, value, seed)``."""
    edges = collections.Counter((p, k, v) for patterns, k, v, _ in rows for p in patterns)
    seeds = {(k, v) for _, k, v, seed in rows if seed}
    score, trusted = {(k, v): float((k, v) in seeds) for _, k, v in edges}, {}
    for _ in range(rounds):
        trusted = {}
        for p, k in {(p, k) for p, k, _ in edges}:
            mine = [(n, score[k, v]) for (q, kind, v), n in edges.items() if (q, kind) == (p, k)]
            total = sum(n for (q, _, _), n in edges.items() if q == p)
            share = sum(n * s for n, s in mine) / (total + 1)
            if share >= min_confidence and sum(s >= min_confidence for _, s in mine) >= min_seeds:
                trusted[p, k] = share
        for k, v in score:
            doubts = [1 - trusted[p, k] for (p, kind, value) in edges if (kind, value) == (k, v) and (p, k) in trusted]
            score[k, v] = 1.0 if (k, v) in seeds else 1 - math.prod(doubts)
    return trusted


def test_graph_against_plain_loops(spark):
    from carestrata.llm.pii import confident_patterns

    pick, rows = random.Random(4), []
    for _ in range(900):
        label, value = pick.randint(0, 11), pick.randint(0, 60)
        rows.append(([label, 100 + label * 3 + pick.randint(0, 2)][: pick.randint(0, 2)], pick.randint(0, 1), f"v{value}", value < (label % 4) * 14))
    values = [(i, [{"kind": k, "start": 0, "end": 1, "value": v, "seed": s, "patterns": p}]) for i, (p, k, v, s) in enumerate(rows)]
    kind = "kind: int, start: long, end: long, value: string, seed: boolean, patterns: array<long>"
    frame = spark.createDataFrame(values, f"doc_id long, values array<struct<{kind}>>")
    for least, rounds in ((3, 1), (3, 4), (2, 3)):
        got = {(r["pattern"], r["kind"]): r["confidence"] for r in confident_patterns(frame, least, 0.5, rounds).collect()}
        want = plain_graph(rows, least, 0.5, rounds)
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got) and want


def test_believed_values_induce_patterns(spark):
    """An address believed after one phrase makes another phrase known, after which new addresses are found."""
    from carestrata.llm.pii import find_personal_data

    rows = [(i, f"please write to user{i}@mail.example.org soon") for i in range(12)]
    rows += [(100 + i, f"please write to person{i}(at)mail.example.org soon") for i in range(4)]
    rows += [(200 + i, f"reachable under person{i}(at)mail.example.org today") for i in range(4)]
    rows += [(300, "reachable under other(at)mail.example.org today"), (301, "the meeting(at)noon.today was long")]
    found = {r["doc_id"]: [tuple(s) for s in r["found"]] for r in find_personal_data(spark.createDataFrame(rows, DOC)).collect()}
    assert all(len(found[i]) == 1 for i in (*range(100, 104), *range(200, 204), 300))  # recall 9 of 9
    assert not found[301] and not any(found[i] for i in range(12))  # and nothing else


def test_long_words_are_scanned_once():
    from carestrata.llm.pii import base_spans, contexts, unseen

    for word in ("a1" * 500_000, "1" * 1_000_000, "x@" * 400_000, "(at)" * 250_000, "1.2-" * 250_000, "a(at)" * 200_000):
        began = time.process_time()
        base = base_spans(word)
        found = unseen(word, base)
        contexts(word, [a for _, a, _ in base + found])
        assert time.process_time() - began < 8
    assert unseen("call 1234567890123456789012 now", []) == []  # a longer run is not cut into values
