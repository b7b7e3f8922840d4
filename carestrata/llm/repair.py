"""Cheapest repair of damaged conversations by an auction shortest-path algorithm.

A conversation is a lattice: a node is (rows read, what the repaired conversation ends with), an arc is an edit with its
integer cost. Nodes carry prices. From an origin a path is extended along the arc that its last node's price affords
(price = cost + price behind the arc); where no arc is affordable the node's price rises to its cheapest arc and the
path is contracted by one node. A path that reaches the end, or a node from which one has reached it, proves the prices
along it to be the exact cheapest costs. All cheapest repairs consist of arcs that the prices make tight, so the repair
with the least audit is read off by following, at every node, the tight arc with the least letter.

Rows are dealt by ranges of (conversation, turn), so a very large conversation spans tasks. Conversations inside one
task are repaired there; those at a task's border, or with many rows, become pieces: a stream backwards over the pieces
gives each the prices behind its end, and a stream forwards repairs them, holding one piece at a time.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: what the repaired conversation ends with so far
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KINDS = "sua"
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"
#: a piece closes at so many lattice rows or code points of text
PIECE_ROWS, PIECE_CHARS = 128, 1 << 20
#: levels between the origins from which prices are settled, the last levels first
STRIDE = 16
#: the prices behind the last row: an empty or complete conversation ends here
END = (0, None, None, 0)


def _edits(kind: int, truncated: bool) -> tuple:
    """For each state the edits of a row that may stay: (letter, cost, next state), letters ascending."""
    extra, table = TRUNCATED if truncated else 0, []
    for state in range(4):
        arcs = [("D", DELETE, state)]
        if (kind == 0 and state == NOTHING) or (kind in (1, 2) and _NEXT[state] == (USER, ASSISTANT)[kind - 1]):
            arcs.append(("K", KEEP + extra, (SYSTEM, USER, ASSISTANT)[kind]))
        arcs.append(("R", REROLE + extra, _NEXT[state]))
        table.append(tuple(arcs))
    return tuple(table)


_STAYING = {(kind, cut): _edits(kind, cut) for kind in range(4) for cut in (False, True)}


def lattice_row(kind: int, truncated: bool, copies: int) -> tuple:
    """The edits of a row; ``copies`` says how many equal rows are deleted together (0: the row may stay).

    Nothing is lost by deleting equal rows in one step: an insertion between two deletions costs as much behind them,
    and its audit is greater.
    """
    if copies:
        return tuple((("D" * copies, DELETE * copies, state),) for state in range(4))
    return _STAYING[kind, truncated]


class Lattice:
    """Prices over the rows of a piece, towards the prices ``ends`` behind it (None: not allowed to end so)."""

    def __init__(self, rows: list[tuple], ends: tuple, last: bool):
        self.rows, self.ends, self.last, n = rows, ends, last, len(rows)
        self.settled = bytearray(4 * n + 4)
        tail = list(ends)
        if last:  # insertions complete an unfinished conversation
            tail[USER] = INSERT + tail[ASSISTANT]
            tail[SYSTEM] = INSERT + tail[USER]
        # feasible prices to begin with: every row costs at least its cheapest edit
        least, prices = min(tail), []
        for row in reversed(rows):
            least += min(cost for arcs in row for _, cost, _ in arcs)
            prices.append(least)
        self.price = [p for p in reversed(prices) for _ in range(4)] + tail

    def arcs(self, node: int):
        """(letter, cost, node) of the edits at ``node``, letters ascending; node None is the end."""
        level, state = divmod(node, 4)
        if level == len(self.rows):
            out = [("", self.ends[state], None)] if self.ends[state] is not None else []
            return [*out, ("I", INSERT, 4 * level + _NEXT[state])] if self.last else out
        out = [(letter, cost, 4 * level + 4 + to) for letter, cost, to in self.rows[level][state]]
        insert = ("I", INSERT, 4 * level + _NEXT[state])
        return [out[0], insert, *out[1:]]

    def settle(self, origin: int) -> None:
        """The auction from ``origin``: extend or contract the path until it ends at the end or at a settled node."""
        price, settled, path = self.price, self.settled, [origin]
        while path[-1] is not None and not settled[path[-1]]:
            node = path[-1]
            best, to = None, None
            for _, cost, target in self.arcs(node):
                value = cost if target is None else cost + price[target]
                if best is None or value < best:
                    best, to = value, target
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for node in path:
            if node is not None:
                settled[node] = 1

    def settle_all(self, entries=range(4)) -> list[int]:
        """Exact cheapest costs from the ``entries`` states before the first row; None for the others."""
        for level in range((len(self.rows) - 1) // STRIDE * STRIDE, 0, -STRIDE):
            for state in range(4):
                self.settle(4 * level + state)
        for state in entries:
            self.settle(state)
        return [self.price[state] if state in entries else None for state in range(4)]

    def trace(self, entry: int):
        """The cheapest edits with the least audit: (letter, cost, row or None, state after), and the last state."""
        self.settle_all([entry])
        node, out = entry, []
        while True:
            for letter, cost, target in self.arcs(node):
                ahead = 0 if target is None else self.price[target]
                if self.price[node] != cost + ahead:
                    continue
                if target is not None and not self.settled[target]:
                    self.settle(target)  # a price that was only a bound may rise, and the arc is not tight then
                    if self.price[node] != cost + self.price[target]:
                        continue
                break
            if target is None:
                return out, node % 4
            out.append((letter, cost, None if letter == "I" else node // 4, target % 4))
            node = target


# --- pieces of conversations ----------------------------------------------------------------------------------------

_FACTS = ["blank", "duplicate", "truncated", "illegal", "n_turns"]


class _Piece:
    """Consecutive rows of one conversation after damage, as lattice rows with what repairing needs."""

    def __init__(self):
        self.rows, self.codes, self.copies, self.roles, self.texts = [], [], [], [], []
        self.chars, self.facts = 0, dict.fromkeys(_FACTS, 0)
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, n: int, seen: bool) -> None:
        facts, body = self.facts, text.rstrip(_SPACE)
        initial = role[:1]
        if self.first_role is None:
            self.first_role = initial
        else:
            facts["illegal"] += self.last_role + initial not in _LEGAL
        facts["illegal"] += (n - 1) * (initial + initial not in _LEGAL)
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            facts["n_turns"] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        gone = n if seen or not body else n - 1
        facts["duplicate" if body else "blank"] += gone
        if gone < n:
            cut = body[-1] not in ".!?"
            facts["truncated"] += cut
            self._push(_KINDS.find(initial) if initial and initial in _KINDS else 3, cut, 0, role, text)
        if gone:
            self._push(3, False, gone, "", "")

    def _push(self, kind: int, cut: bool, copies: int, role: str, text: str) -> None:
        self.rows.append(lattice_row(kind, cut, copies))
        self.codes.append(kind + 4 * cut)
        self.copies.append(copies)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self, piece_rows: int) -> bool:
        return len(self.rows) >= piece_rows or self.chars >= PIECE_CHARS


def _repaired(lattice: Lattice, roles: list, texts: list, entry: int):
    """(cost, audit, repaired rows, state behind)."""
    edits, state = lattice.trace(entry)
    said = []
    for letter, _, row, after in edits:
        if letter == "K":
            said.append(f"{roles[row]}:{texts[row]}")
        elif letter == "R":
            said.append(f"{_ROLE[after]}:{texts[row]}")
        elif letter == "I":
            said.append(f"{_ROLE[after]}:")
    return sum(e[1] for e in edits), "".join(e[0] for e in edits), "\n".join(said), state


_SOLVED = [("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.string())]
_HEAD = [("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_())]
_COUNTS = [(f, pa.int64()) for f in (*_FACTS, "first_turn", "last_turn")]
_OPEN = [("first_role", pa.string()), ("last_role", pa.string()), ("codes", pa.list_(pa.int32())), ("copies", pa.list_(pa.int64()))]
_OPEN += [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
_PART = pa.schema(_HEAD + _COUNTS + _SOLVED)
_PIECE = pa.schema(_HEAD + _COUNTS + _SOLVED + _OPEN)


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "bigint", "int32": "int", "bool": "boolean"}
    kind = lambda t: f"array<{kind(t.value_type)}>" if pa.types.is_list(t) else names.get(str(t), str(t))
    return ", ".join(f"{f.name} {kind(f.type)}" for f in schema)


def _row(conv_id, part: int, whole: bool, piece: _Piece, solved) -> dict:
    out = {"conv_id": conv_id, "part": part, "whole": whole, **piece.facts}
    out |= {"first_turn": piece.first_turn, "last_turn": piece.last_turn}
    if solved is not None:
        return out | dict(zip(("cost", "audit", "repaired"), solved))
    out |= {"first_role": piece.first_role, "last_role": piece.last_role, "codes": piece.codes, "copies": piece.copies}
    return out | {"roles": piece.roles, "texts": piece.texts}


def _batches(rows, schema: pa.Schema, limit: int = 4 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 256 + len(row.get("repaired") or "") + sum(map(len, row.get("texts") or ()))
        if size >= limit:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _dealt(batches, piece_rows: int):
    """Sorted rows of a task into repaired conversations and pieces; holds one piece."""
    # the numbers of a task's pieces are above those of all tasks before it
    part, conv_id, piece, border, cut, seen = TaskContext.get().partitionId() << 33, None, None, True, False, None
    before = None

    def close(last: bool):
        if border or cut or last:
            return _row(conv_id, part, False, piece, None)
        return _row(conv_id, 0, True, piece, _repaired(Lattice(piece.rows, END, True), piece.roles, piece.texts, NOTHING)[:3])

    for batch in batches:
        for row in batch.to_pylist():
            if piece is None or row["conv_id"] != conv_id:
                if piece is not None:
                    yield close(False)
                    part, border = part + 1, False
                conv_id, piece, cut, seen, before = row["conv_id"], _Piece(), False, None, None
            elif piece.full(piece_rows):
                cut = True
                yield close(False)
                part, piece = part + 1, _Piece()
            key = (row["turn"], row["role"], row["digest"])
            if row["what"] == 1:
                seen = key
            elif row["what"] == 2:
                piece.add(row["turn"], row["role"], row["text"], row["n"], key in (seen, before))
                before = key
    if piece is not None:
        yield close(True)


def _collapsed(batches):
    """Equal rows of a batch as one with their number, so that a much repeated row is not shuffled as often."""
    keys = ["conv_id", "turn", "role", "digest", "what"]
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            places = rows.select(keys).append_column("i", pa.array(range(rows.num_rows)))
            groups = places.group_by(keys, use_threads=False).aggregate([("i", "min"), ("i", "count")])
            kept = rows.take(groups["i_min"]).append_column("n", groups["i_count"].cast(pa.int64()))
            yield from kept.to_batches()


def _rebuilt(row: dict) -> list[tuple]:
    return [lattice_row(code % 4, code >= 4, copies) for code, copies in zip(row["codes"], row["copies"])]


def _ends(batches):
    """For every piece, which come last piece first, the exact prices behind it."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("ends", pa.list_(pa.int64())), ("last", pa.bool_())])

    def told():
        conv_id, ends = None, None
        for batch in batches:
            for row in batch.to_pylist():
                last = ends is None or row["conv_id"] != conv_id
                conv_id, ends = row["conv_id"], END if last else ends
                yield {"conv_id": conv_id, "part": row["part"], "ends": list(ends), "last": last}
                ends = Lattice(_rebuilt(row), ends, last).settle_all()

    return _batches(told(), schema)


def _finished(batches):
    """Repairs pieces, which come in order; holds one."""

    def told():
        conv_id, before, state, part = None, None, NOTHING, 0
        for batch in batches:
            for row in batch.to_pylist():
                if before is None or row["conv_id"] != conv_id:
                    conv_id, before, state, part = row["conv_id"], {"last_role": None, "last_turn": None}, NOTHING, 0
                lattice = Lattice(_rebuilt(row), tuple(row["ends"]), row["last"])
                *solved, state = _repaired(lattice, row["roles"], row["texts"], state)
                out = {name: row[name] for name in (*_FACTS, "first_turn", "last_turn")}
                if row["first_role"] is not None and before["last_role"] is not None:
                    out["illegal"] += before["last_role"] + row["first_role"] not in _LEGAL
                if row["first_turn"] is not None and row["first_turn"] == before["last_turn"]:
                    out["n_turns"] -= 1
                yield {"conv_id": conv_id, "part": part, "whole": False, **out, **dict(zip(("cost", "audit", "repaired"), solved))}
                part += 1
                before = {name: before[name] if row[name] is None else row[name] for name in before}

    return _batches(told(), _PART)


def repair_conversations(rows: DataFrame, present: DataFrame | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The cheapest repair of every conversation of ``rows (conv_id, turn, role, text)``, as parts.

    A part is ``(conv_id, part, whole, blank, duplicate, truncated, illegal, n_turns, first_turn, last_turn, cost, audit,
    repaired)``: a conversation inside one task and of at most ``piece_rows`` different rows is one ``whole`` part; any
    other has several, whose counts add up and whose texts follow each other by ``part``. ``repaired`` holds the lines
    ``role:text`` of the rows that stay or are inserted.

    Rows count in the order of ``turn`` (null first), those of one turn by role and the MD5 of role and text. Null roles
    and texts are one space. Repeated rows are duplicates of each other. A null ``conv_id`` is one conversation. The
    conversations in ``present (conv_id)`` have a part even without rows. Other columns are ignored; no rows, no parts.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    taken = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"))
    marked = taken.withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))

    # rows whose role and text come at an earlier turn, found on their digests alone
    place = F.struct(F.col("turn").isNotNull().alias("told"), F.coalesce("turn", F.lit(0)).alias("turn"))
    keys = marked.select("conv_id", "turn", "role", "digest", place.alias("place"))
    spread = keys.groupBy("conv_id", "digest").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    several = spread.where("least < most").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "least")
    met = keys["conv_id"].eqNullSafe(several["c"]) & (keys["digest"] == several["d"])
    again = keys.join(several, met).where(F.col("place") > F.col("least"))

    columns = ["conv_id", "turn", "role", "digest", "what", "text"]
    none = F.lit(None).cast("string").alias("text")
    told = marked.withColumn("what", F.lit(2)).select(*columns).union(again.select(*columns[:4], F.lit(1), none))
    if present is not None:
        gone = F.col("conv_id").cast("long"), F.lit(None).cast("long"), F.lit(""), F.lit(""), F.lit(0), none
        told = told.union(present.select(*gone))
    collapsed = told.mapInArrow(_collapsed, "conv_id bigint, turn bigint, role string, digest string, what int, text string, n bigint")
    dealt = collapsed.repartitionByRange(*columns[:4]).sortWithinPartitions(*columns[:5])
    found = stage(dealt.mapInArrow(lambda batches: _batches(_dealt(batches, piece_rows), _PIECE), _ddl(_PIECE)), "repair")

    pieces = found.where("NOT whole")
    backwards = pieces.select("conv_id", "part", "codes", "copies").repartition("conv_id")
    ends = backwards.sortWithinPartitions("conv_id", F.desc("part")).mapInArrow(_ends, "conv_id bigint, part bigint, ends array<bigint>, last boolean")
    ends = ends.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "ends", "last")
    priced = pieces.join(ends, pieces["conv_id"].eqNullSafe(ends["c"]) & (pieces["part"] == ends["p"]))
    forwards = priced.drop("c", "p", "cost", "audit", "repaired").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return found.where("whole").select(*_PART.names).union(forwards.mapInArrow(_finished, _ddl(_PART)))


def repair_digests(parts: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of repaired conversations.

    A digest runs over a conversation in order, so parts of one conversation go through one task, one at a time.
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema(
        [("conv_id", pa.int64()), ("gaps", pa.int64())] + [(c, pa.int64()) for c in counts] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def joined(batches):
        now = None
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now["conv_id"]:
                    if now is not None:
                        yield finish(now)
                    now = {"conv_id": row["conv_id"], "n_turns": 0, "first": None, "last": None, "audit": [], "said": None, **dict.fromkeys(counts, 0)}
                for name in (*counts, "n_turns"):
                    now[name] += row[name]
                now["audit"].append(row["audit"])
                now["first"] = row["first_turn"] if now["first"] is None else now["first"]
                now["last"] = now["last"] if row["last_turn"] is None else row["last_turn"]
                if row["repaired"]:
                    if now["said"] is None:
                        now["said"] = hashlib.sha256()
                    else:
                        now["said"].update(b"\n")
                    now["said"].update(row["repaired"].encode())
        if now is not None:
            yield finish(now)

    def finish(now: dict) -> dict:
        gaps = 0 if now["first"] is None else now["last"] - now["first"] + 1 - now["n_turns"]
        said = now["said"] or hashlib.sha256()
        return {**{k: now[k] for k in ("conv_id", *counts)}, "gaps": gaps, "audit": "".join(now["audit"]), "repaired_sha256": said.hexdigest()}

    whole = parts.where("whole").select(
        "conv_id", F.expr("coalesce(last_turn - first_turn + 1 - n_turns, 0L)").alias("gaps"), *counts, "audit",
        F.sha2("repaired", 256).alias("repaired_sha256"),
    )
    ordered = parts.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.union(ordered.mapInArrow(lambda batches: _batches(joined(batches), schema), _ddl(schema)))


def damage(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20, and the conversations of dropped rows.

    0 drops a row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 gives it the role user. Nulls are one
    space in texts, roles and hashed keys.
    """
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    hit = rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    left = hit.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
    return left, hit.where("fault = 0").select("conv_id")
