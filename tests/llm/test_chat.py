"""Chats from event logs against a plain fold, and the template's round trip."""

import hashlib
import random

from carestrata.llm import chat

LOG = "conv_id long, message string, seq long, kind string, role string, text string"


def test_template_round_trip():
    pick = random.Random(5)
    pieces = ["### ", "###", "#", "</turn>", "</turn", "<", "/turn>", "\\", "\\b", "\\h", "\n", ": ", ":", "user", "é", " ", ""]
    for _ in range(3000):
        turns = [tuple("".join(pick.choice(pieces) for _ in range(pick.randint(0, 6))) for _ in "rt") for _ in range(pick.randint(0, 4))]
        rendered = [chat.render(*turn) for turn in turns]
        formatted = "".join(r[0] for r in rendered)
        assert list(chat.parse(formatted)) == turns
        assert formatted.count(chat.CLOSE) == len(turns)
        assert [chat.unescape(piece[a:b]) for piece, a, b in rendered] == [text for _, text in turns]


def plain_fold(log):
    """Final messages of every conversation, by replaying its whole log in the order of the sequence."""
    messages = {}
    for conv, message, seq, kind, role, text in sorted(log, key=lambda e: (e[2] is not None, e[2] or 0, e[3] or "", e[4] or "", e[5] or "")):
        held = messages.setdefault(conv, {})
        if kind == "open":
            held[message] = [role or "", ""]
        elif message not in held:
            continue
        elif kind == "delta":
            held[message][1] += text or ""
        elif kind == "edit":
            held[message][1] = text or ""
        elif kind == "regenerate":
            held[message][1] = ""
        elif kind == "delete":
            del held[message]
    return {c: [held[m] for m in sorted(held, key=lambda m: (m is not None, m or ""))] for c, held in messages.items()}


def expected(conversations):
    out = {}
    for conv, turns in conversations.items():
        if turns:
            learned = "".join(t for r, t in turns if r == "assistant")
            told = "".join(f"{r}\n{t}\n" for r, t in turns)
            digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
            out[conv] = (len(turns), digest(told), len(learned), digest(learned), sum(len(chat.render(*t)[0]) for t in turns))
    return out


def results(df):
    found = [(r["conv_id"], tuple(r[1:])) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def random_log(pick, n):
    kinds = ["open", "open", "delta", "delta", "delta", "edit", "regenerate", "delete", None, "unknown"]
    texts = ["a", "### User: ", "</turn>\n", None, "\\", "long text " * 3]
    log = []
    for seq in range(n):
        roles = pick.choice(["user", "assistant", "system", None, "a: b"])
        log.append((pick.choice([1, 2, 3, None]), pick.choice(["m1", "m2", "m3", None]), seq, pick.choice(kinds), roles, pick.choice(texts)))
    return log


def test_random_logs(spark):
    log = random_log(random.Random(2), 500)
    frame = spark.createDataFrame(log, LOG).selectExpr("*", "'clash' AS formatted", "1 AS mask", "2 AS n_turns").repartition(4)
    for part_chars in (chat.PART_CHARS, 20):  # one row a conversation, and many
        assert results(chat.chat_digests(chat.format_conversations(frame, part_chars))) == expected(plain_fold(log))


def test_large_conversation_spans_rows(spark):
    log = [(1, f"{m:05}", s, k, "assistant", f"text {m} ") for m in range(3000) for s, k in ((0, "open"), (1, "delta"), (2, "delta"))]
    parts = chat.format_conversations(spark.createDataFrame(log, LOG).repartition(4), 4096)
    assert parts.where("length(formatted) > 4096").count() == 0 and parts.count() > 3
    assert results(chat.chat_digests(parts)) == expected(plain_fold(log))


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, None, None, None), (1, 0, "user", "x" * 1_500_000), (1, 0, "user", "same"), (1, 0, "user", "same"), (None, 2, "assistant", "")]
    rows += [(2, -3, "assistant", "\\### Assistant: </turn> ok"), (2, 4, "user", "\U0001f600é")]
    log = chat.conversation_log(spark.createDataFrame(rows, schema).selectExpr("*", "'clash' AS message", "1 AS size", "2 AS event"))
    turns = {1: [["", ""], ["user", "same"], ["user", "same"], ["user", "x" * 1_500_000]], None: [["assistant", ""]], 2: [list(r[2:]) for r in rows[-2:]]}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    turns[1][1:] = sorted(turns[1][1:], key=lambda t: md5(t[1]))
    assert results(chat.chat_digests(chat.format_conversations(log))) == expected(turns)
    empty = chat.conversation_log(spark.createDataFrame([], schema))
    assert chat.chat_digests(chat.format_conversations(empty)).count() == 0
