"""Repair of conversation structure by branch and bound.

A conversation's rows, in order, are edited until their roles' initials read ``(s?(ua)+)?``: Keep costs
0, Rerole to user or assistant 1, Delete 2 (required of blank and duplicate rows), Insert of an
empty user or assistant row anywhere 5; a truncated row that is not deleted adds 5. Of the cheapest
edits, those whose initials in order (the audit) are least in ASCII are taken.

:func:`repair` searches the edits depth first with an explicit stack. Nodes are (rows used, state of
the pattern). Children are tried in ASCII order, so the path that reaches a node first is least among
those of its cost. A node's table entry holds the least cost with which it was reached; a prefix that
comes later at no less cost is dominated. Suffix lower bounds come from a backward pass over a looser
pattern (no system row kept, any whole number of pairs), less 2 where a system row may still open the
conversation. The first incumbent (cost, audit) is the descent that follows the bounds; a prefix whose
cost and bound exceed the incumbent's goes. The search ends when the stack is empty: optimality is then
proved. Stack, tables and bounds take some 50 bytes a row.

In Spark, conversations are searched from narrow rows (initial and fault of each turn), sorted in
partitions by conversation and streamed, so no task holds texts. The edits meet the texts in a second
sorted stream that holds one row (and the edits of rows equal to it) at a time. A lost executor repeats only its partitions.

Edge cases: a null conversation id is a conversation of its own; a null role or text is one space, and a
role without s, u or a at its start fits nowhere unless it is reroled (an empty role has no initial).
Rows are ordered by turn (nulls first), ties by role, the first 64 code points of the text, the SHA-256 of the text;
repeated rows are duplicates of the first. An empty table gives an empty result, a conversation all of
whose rows were dropped zeros, an empty audit and no repaired rows. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WHITE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5
#: States of the pattern: nothing kept yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_ROLES = {"u": "user", "a": "assistant"}
_FAR = 1 << 60


# ---- the search -------------------------------------------------------------------------------


def _bounds(initials: list[str], faults: list[int]) -> tuple[array, array, list[int]]:
    """Least cost of the rows from each on, when a user (an assistant) row is due, in the looser
    pattern; and the index after the last system row."""
    n = len(initials)
    user, assistant = array("q", bytes(8 * (n + 1))), array("q", bytes(8 * (n + 1)))
    assistant[n] = INSERT
    last = 0
    for i in range(n - 1, -1, -1):
        u, a = user[i + 1] + DELETE, assistant[i + 1] + DELETE
        if faults[i] not in (BLANK, DUPLICATE):
            extra = UNFINISHED if faults[i] == TRUNCATED else 0
            u = min(u, assistant[i + 1] + extra + (initials[i] != "u") * REROLE)
            a = min(a, user[i + 1] + extra + (initials[i] != "a") * REROLE)
            if initials[i] == "s" and not last:
                last = i + 1
        user[i], assistant[i] = min(u, a + INSERT), min(a, u + INSERT)
    return user, assistant, last


def repair(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """Least cost and, at that cost, the ASCII-least audit."""
    n = len(initials)
    user, assistant, last = _bounds(initials, faults)

    def bound(i: int, state: int) -> int:
        if state == START:
            return max(0, user[i] - DELETE) if i < last else user[i]
        return assistant[i] if state == USER else user[i]

    def children(i: int, state: int, cost: int) -> Iterator[tuple[str, int, int, int]]:
        """(letter, rows used, state, cost) in ASCII order of the letter."""
        if i < n:
            yield "D", i + 1, state, cost + DELETE
        due, after = _NEXT[state]
        yield "I", i, after, cost + INSERT
        if i < n and faults[i] not in (BLANK, DUPLICATE):
            extra = UNFINISHED if faults[i] == TRUNCATED else 0
            if initials[i] == due:
                yield "K", i + 1, after, cost + extra
            elif initials[i] == "s" and state == START:
                yield "K", i + 1, SYSTEM, cost + extra
            yield "R", i + 1, after, cost + extra + REROLE

    def whole(i: int, state: int) -> bool:
        return i == n and state in (START, ASSISTANT)

    # the descent that follows the bounds gives the first incumbent
    i, state, cost, path = 0, START, 0, []
    while not whole(i, state):
        letter, i, state, cost = min(children(i, state, cost), key=lambda c: (c[3] + bound(c[1], c[2]), c[0]))
        path.append(letter)
    best, audit, proved = cost, "".join(path), False

    reached = [array("q", [_FAR]) * (n + 1) for _ in range(4)]
    stack, path = [("", 0, START, 0, 0)], []
    while stack:
        letter, i, state, cost, depth = stack.pop()
        least = cost + bound(i, state)
        if least > best or (proved and least == best) or cost >= reached[state][i]:
            continue
        reached[state][i] = cost
        if depth:
            path[depth - 1 :] = [letter]
        if whole(i, state):
            found = "".join(path)
            if (cost, found) < (best, audit):
                best, audit = cost, found
            proved = True  # leaves come in ASCII order: no later one of this cost is less
            continue
        stack.extend([(*c, depth + 1) for c in children(i, state, cost)][::-1])
    return best, audit


def edits(initials: list[str], audit: str) -> Iterator[tuple[list[str], str, str | None]]:
    """For each row, and once more behind the last: roles inserted before it, its letter (empty behind
    the last), the role it gets if reroled."""
    state, i, before = START, 0, []
    for letter in audit:
        due, after = _NEXT[state]
        if letter == "I":
            before.append(_ROLES[due])
            state = after
            continue
        yield before, letter, _ROLES[due] if letter == "R" else None
        if letter != "D":
            state = SYSTEM if letter == "K" and initials[i] != due else after
        i, before = i + 1, []
    yield before, "", None


# ---- rows ------------------------------------------------------------------------------------


def prepared(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with nulls of role and text as one space."""
    return conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows spoilt by ``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 sets role user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = prepared(conversations).withColumn("kind", kind).where("kind <> 0")
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    return rows.withColumn("times", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"head": F.substring("text", 1, 64), "digest": F.unhex(F.sha2("text", 256))})


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest")]


def faults_of(rows: DataFrame) -> DataFrame:
    """Narrow rows (keys of the order, initial, fault) of all turns; texts stay behind."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    keyed = _keyed(rows).select(
        "conv_id", "turn", "role", "head", "digest", F.substring("role", 1, 1).alias("initial"), (trimmed == "").alias("blank"), F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ended")
    )
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("blank"), BLANK).when(seen > 1, DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(0)
    return keyed.withColumn("fault", fault).drop("blank", "ended")


_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _wrapped(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


class _Conversation:
    """The narrow rows of one conversation, and what :func:`solve` returns of them."""

    def __init__(self, conv_id):
        self.conv_id, self.keys, self.initials, self.faults = conv_id, [], [], []
        self.turns, self.low, self.high, self.last, self.illegal = 0, None, None, None, 0

    def add(self, turn, role, head, digest, initial, fault) -> None:
        if self.initials and (self.initials[-1], initial) not in _LEGAL:
            self.illegal += 1
        if turn is not None:
            self.low, self.high = (turn, turn) if self.low is None else (self.low, turn)
            self.turns += turn != self.last or self.turns == 0
            self.last = turn
        self.keys.append((turn, role, head, digest))
        self.initials.append(initial)
        self.faults.append(fault)

    def rows(self) -> Iterator[tuple]:
        cost, audit = repair(self.initials, self.faults)
        gaps = 0 if self.low is None else _wrapped(self.high - self.low + 1 - self.turns)
        counts = [self.faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        yield (self.conv_id, -1, None, None, None, None, None, None, None, gaps, *counts, self.illegal, cost, audit)
        for k, (before, letter, role) in enumerate(edits(self.initials, audit)):
            yield (self.conv_id, k, *(self.keys[k] if letter else (None,) * 4), before, letter, role, *(None,) * 7)


def _solve(id_type: pa.DataType, turn_type: pa.DataType):
    types = [id_type, pa.int64(), turn_type, pa.string(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.string(), pa.string()]
    types += [pa.int64()] * 6 + [pa.string()]
    names = ["conv_id", "place", "turn", "role", "head", "digest", "before", "edit", "new_role", *_SUMMARY, "audit"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out = None, []
        for b in batches:
            for conv_id, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        out.extend(current.rows())
                    current = _Conversation(conv_id)
                current.add(*rest)
                if len(out) >= 10_000:
                    yield batch(out)
                    out = []
        if current is not None:
            out.extend(current.rows())
        for i in range(0, len(out), 10_000):
            yield batch(out[i : i + 10_000])

    return run


def solve(rows: DataFrame) -> DataFrame:
    """Edits of every conversation of ``rows`` (conv_id, turn, role, text): one row of counts, cost and
    audit (place -1), and one for each turn and one behind the last, with keys of the order, roles
    inserted before, edit and new role."""
    from pyspark.sql.pandas.types import to_arrow_type

    narrow = faults_of(rows).repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    narrow = narrow.select("conv_id", "turn", "role", "head", "digest", "initial", "fault")
    types = [narrow.schema[c].dataType for c in ("conv_id", "turn")]
    schema = f"conv_id {types[0].simpleString()}, place bigint, turn {types[1].simpleString()}, role string, head string, digest binary, before array<string>, edit string, new_role string, "
    schema += ", ".join(f"{c} bigint" for c in _SUMMARY) + ", audit string"
    return narrow.mapInArrow(_solve(*map(to_arrow_type, types)), schema)


def _merge(id_type: pa.DataType):
    """Edits, each before the text of its row, to the repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, place, waiting = [], object(), 0, deque()  # waiting: edits of rows equal to each other

        def put(role, text, edit):
            nonlocal place
            place += 1
            out.append((conv, place, role, text, edit))

        for b in batches:
            for conv_id, kind, before, edit, new_role, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if conv_id != conv:
                    conv, place = conv_id, 0
                if kind == 0 and edit:
                    waiting.append((before, edit, new_role))
                    continue
                if kind == 1:
                    before, edit, new_role = waiting.popleft()
                for r in before:
                    put(r, "", "I")
                if edit in ("K", "R"):
                    put(new_role or role, text, edit)
            if out:
                columns = list(zip(*out))
                types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["conv_id", "place", "role", "text", "edit"])
                out.clear()

    return run


def repaired_turns(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, place from 1, role, text, edit K, R or I) of every row of the repaired conversations, in
    order and with each conversation's rows together."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    nothing = {c: F.lit(None).cast(t) for c, t in (("before", "array<string>"), ("edit", "string"), ("new_role", "string"))}
    texts = _keyed(rows).withColumns({"kind": F.lit(1), "last": F.lit(False), "place": F.lit(0).cast("bigint"), **nothing})
    steps = solved.where("place >= 0").withColumns({"kind": F.lit(0), "last": F.col("edit") == "", "text": F.lit(None).cast("string")})
    names = ["conv_id", "last", "turn", "role", "head", "digest", "kind", "place", "before", "edit", "new_role", "text"]
    stream = steps.select(names).unionByName(texts.select(names)).repartition("conv_id")
    stream = stream.sortWithinPartitions("conv_id", "last", *_order(), "kind", "place")
    stream = stream.select("conv_id", "kind", "before", "edit", "new_role", "role", "text")
    return stream.mapInArrow(_merge(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, place bigint, role string, text string, edit string")


def _digests(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            return pa.RecordBatch.from_arrays([pa.array([conv], id_type), pa.array([state.hexdigest()], pa.string())], ["conv_id", "sha256"])

        conv, state = None, None
        for b in batches:
            for conv_id, role, text in zip(*(b.column(k).to_pylist() for k in (0, 2, 3))):
                if state is None or conv_id != conv:
                    if state is not None:
                        yield done()
                    conv, state = conv_id, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
        if state is not None:
            yield done()

    return run


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256 of ``role:text`` joined by newlines) of rows as :func:`repaired_turns` gives them."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = turns.schema["conv_id"].dataType
    return turns.mapInArrow(_digests(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, sha256 string")


def repair_report(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """One row per conversation of the table: faults, cost and audit of its repair and the digest of
    the repaired rows; with ``damage`` of the rows as :func:`damaged` spoils them."""
    rows = damaged(conversations) if damage else prepared(conversations)
    solved = materialize(solve(rows), "conversation-edits")
    summary = solved.where("place = -1").select(F.col("conv_id").alias("_conv"), *_SUMMARY, "audit")
    hashes = turn_digests(repaired_turns(rows, solved)).withColumnRenamed("conv_id", "_conv2")
    ids = conversations.select("conv_id").distinct()
    joined = ids.join(summary, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv2")), "left")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _SUMMARY],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
