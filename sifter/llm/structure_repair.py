"""Conversation structure repair: a suffix-shared DAWG over the rows' signatures.

A conversation's rows, in order of turn (nulls first; ties by role, then by the text's md5), become a
signature, a letter a row: its role's initial (s, u, a, or o for any other), a capital if the text is
truncated, and X for a blank or repeated row, which must go. Distinct signatures of all conversations
are dealt by ranges of their reversal, so those that end alike meet in one task and come one after
another: a stack holds the automaton's path from the end, and only the letters that differ from the
signature before make new nodes. A node has, for each state of the grammar, the cheapest cost to the
end and the edits at its row; nodes with equal remaining costs are one (``node``), so they are
computed once. The audit is read along the path from the start.

The edits of a row (Inserts, then Keep, Rerole or Delete) form a prefix code, so of equally cheap
choices the one with the least edits gives the ASCII-least audit, whatever follows.

Order, faults and signatures need no texts, only their digests; texts are moved once, for the
repaired conversations. Every pass is a stream over sorted rows, so no conversation is held in
memory; the rows of one go through one task, since their digest is a sequential function.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: States: the role given last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that comes next where one is inserted or changed, by state, and the state it leads to.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: State that keeping a role's initial leads to.
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
GONE = "X"
#: At the end: edits that close what is open, by state.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
END = tuple(INSERT_COST * len(CLOSING[s]) for s in range(4))

FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def choices(letter: str, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, edits, next state) of a row, with up to two Inserts before it; more lead nowhere new."""
    cost, edits = 0, ""
    for _ in range(3):
        yield cost + DELETE_COST, edits + "D", state
        if letter != GONE:
            fault = TRUNCATED_COST * letter.isupper()
            if state in KEEP.get(letter.lower(), {}):
                yield cost + KEEP_COST + fault, edits + "K", KEEP[letter.lower()][state]
            yield cost + REROLE_COST + fault, edits + "R", NEXT[state][1]
        cost, edits, state = cost + INSERT_COST, edits + "I", NEXT[state][1]


@cache
def node(letter: str, after: tuple[int, ...]) -> tuple[int, tuple[int, ...], tuple[tuple[str, int], ...]]:
    """The automaton's node for a row whose successor has the costs ``after`` by state: the least of
    its own costs, all of them less that, and by state the edits and the state they lead to."""
    best = [min((c + after[n], e, n) for c, e, n in choices(letter, s)) for s in range(4)]
    least = min(c for c, _, _ in best)
    return least, tuple(c - least for c, _, _ in best), tuple((e, n) for _, e, n in best)


def audits(signatures: Iterable[str]) -> Iterator[tuple[int, str]]:
    """Least cost and audit of each signature; quick where neighbours end alike."""
    last, path, total = "", [(END, ())], [0]
    for signature in signatures:
        back = signature[::-1]
        same = 0
        while same < min(len(last), len(back)) and last[same] == back[same]:
            same += 1
        del path[same + 1 :], total[same + 1 :]
        for letter in back[same:]:
            least, costs, edits = node(letter, path[-1][0])
            path.append((costs, edits))
            total.append(total[-1] + least)
        last = back
        state, audit = START, []
        for _, edits in reversed(path[1:]):
            edit, state = edits[state]
            audit.append(edit)
        yield total[-1] + path[-1][0][START], "".join(audit) + CLOSING[state]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text and ``dropped``. A dropped row stays as a row
    without role and text, so that its conversation is known. Nulls: one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    dropped = F.col("kind") == 0
    return rows.select(
        "conv_id",
        F.when(~dropped, F.col("turn")).alias("turn"),
        F.when(~dropped, F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(~dropped, text).alias("text"),
        dropped.alias("dropped"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096, most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str))
        if len(held) == size or weight > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _signatures(rows: Iterator[tuple]) -> Iterator[tuple]:
    """conv_id, signature and facts from (conv_id, dropped, turn, initial, blank, repeated, truncated) in order."""
    nothing = object()
    conv = nothing

    def finished() -> tuple:
        gaps = high - low + 1 - turns if turns else 0
        return conv, "".join(letters), gaps, *counts, illegal

    for own, dropped, turn, initial, blank, repeated, truncated in rows:
        if own != conv or conv is nothing:
            if conv is not nothing:
                yield finished()
            conv, letters, counts, illegal, turns, low, high, before = own, [], [0, 0, 0], 0, 0, None, None, None
        if dropped:
            continue
        if turn is not None and turn != high:
            low, high, turns = turn if low is None else low, turn, turns + 1
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        fault = 0 if blank else 1 if repeated else 2 if truncated else None
        if fault is not None:
            counts[fault] += 1
        letter = initial if initial in ("s", "u", "a") else "o"
        letters.append(GONE if blank or repeated else letter.upper() if truncated else letter)
    if conv is not nothing:
        yield finished()


def signatures(damaged: DataFrame) -> DataFrame:
    """conv_id, signature and facts (FACTS) of every conversation, from its rows after damage."""
    digest = F.md5("text")
    rows = damaged.select(
        "conv_id", "turn", "dropped", "role", digest.alias("digest"),
        (~F.col("text").rlike(BLANK)).alias("blank"), (~F.col("text").rlike(ENDED)).alias("truncated"),
    )
    rows = rows.withColumn("initial", F.substring("role", 1, 1)).repartition("conv_id")
    earlier = "row_number() OVER (PARTITION BY conv_id, dropped, role, digest ORDER BY turn NULLS FIRST) > 1"
    rows = rows.withColumn("repeated", F.expr(earlier))
    rows = rows.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    kind = dict(damaged.dtypes)["conv_id"]
    schema = f"conv_id {kind}, signature string, " + ", ".join(f"{c} long" for c in FACTS)
    arrow = pa.schema([("conv_id", _arrow(damaged, "conv_id")), ("signature", pa.string()), *((c, pa.int64()) for c in FACTS)])
    picked = rows.select("conv_id", "dropped", "turn", "initial", "blank", "repeated", "truncated")
    return picked.mapInArrow(lambda batches: _batches(_signatures(_rows(batches)), arrow), schema)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def solve(found: DataFrame) -> DataFrame:
    """signature, cost and audit of each distinct signature of ``found``."""
    order = F.reverse("signature")
    distinct = found.select("signature").distinct()
    dealt = distinct.repartitionByRange(order).sortWithinPartitions(order)
    arrow = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []

        def each() -> Iterator[str]:
            for (s,) in _rows(batches):
                texts.append(s)
                yield s

        return _batches(((texts.pop(), *x) for x in audits(each())), arrow)

    return dealt.mapInArrow(run, "signature string, cost long, audit string")


def _edits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) for every edit, Deletes included, from rows (conv_id, audit, role,
    text) where a conversation's audit comes first; before them (conv_id, None, None, None)."""
    state, audit, at = START, "", 0

    def inserts(conv) -> Iterator[tuple]:
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            role, state = NEXT[state]
            at += 1
            yield conv, "I", role, ""

    conv = None
    for own, first, role, text in rows:
        if first is not None:
            yield from inserts(conv)
            conv, audit, at, state = own, first, 0, START
            yield own, None, None, None
            continue
        yield from inserts(conv)
        edit = audit[at]
        at += 1
        if edit == "R":
            role, state = NEXT[state]
        elif edit == "K":
            state = KEEP[role[:1]][state]
        yield conv, edit, role, text
    yield from inserts(conv)


def _ordered(damaged: DataFrame, solved: DataFrame, carried: list[str]) -> DataFrame:
    """Rows of a conversation side by side and in order, the one with its audit first."""
    none = {"turn": "turn", "role": "role", "digest": "digest", "text": "text"}
    rows = damaged.where(~F.col("dropped")).withColumn("digest", F.md5("text"))
    kinds = dict(rows.dtypes) | dict(solved.dtypes)
    empty: dict[str, Column] = {c: F.lit(None).cast(kinds[c]).alias(c) for c in (*none, "audit", *carried)}
    heads = solved.select("conv_id", "audit", *(empty[c] for c in none), *carried)
    body = rows.select("conv_id", empty["audit"], *none, *(empty[c] for c in carried))
    both = heads.unionByName(body).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest")


def _prepared(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    damaged = damage(conversations)
    found = materialise(signatures(damaged), "signatures")
    return damaged, found.join(materialise(solve(found), "audits"), "signature")


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """The repaired conversations, a row a turn: conv_id, position (from 0), edit (K, R or I), role, text."""
    damaged, solved = _prepared(conversations)
    arrow = pa.schema([("conv_id", _arrow(conversations, "conv_id")), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            position = 0
            for conv, edit, role, text in _edits(_rows(batches)):
                if edit is None:
                    position = 0
                elif edit != "D":
                    yield conv, position, edit, role, text
                    position += 1

        return _batches(turns(), arrow)

    kind = dict(conversations.dtypes)["conv_id"]
    rows = _ordered(damaged, solved, []).select("conv_id", "audit", "role", "text")
    return rows.mapInArrow(run, f"conv_id {kind}, position long, edit string, role string, text string")


def structure_repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations`` (conv_id, turn, role, text): gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256, after damage by the rows' own hash.

    Rows with a null id are one conversation, with a null id; a null turn comes first and is in no
    gap; a null role or text is one space. Rows of one turn come by role, then by the text's md5, so
    rows that repeat stand together, and all but the first are duplicates. An empty text is blank. A
    conversation of any length is repaired whole. Without rows after damage: zeros, an empty audit
    and the hash of nothing. An empty table gives no rows; other columns are ignored.
    """
    damaged, solved = _prepared(conversations)
    carried = [*FACTS, "cost"]
    kind = dict(conversations.dtypes)["conv_id"]
    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in carried) + ", audit string, repaired_sha256 string"
    arrow = pa.schema([("conv_id", _arrow(conversations, "conv_id")), *((c, pa.int64()) for c in carried), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[tuple] = []

        def rows() -> Iterator[tuple]:
            for conv, audit, role, text, *facts in _rows(batches):
                if audit is not None:
                    heads.append((conv, *facts, audit))
                yield conv, audit, role, text

        def digests() -> Iterator[tuple]:
            head = digest = None
            for _, edit, role, text in _edits(rows()):
                if edit is None:
                    if head is not None:
                        yield *head, digest.hexdigest()
                    head, digest, between = heads.pop(), hashlib.sha256(), b""
                elif edit != "D":
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
            if head is not None:
                yield *head, digest.hexdigest()

        return _batches(digests(), arrow)

    return _ordered(damaged, solved, carried).select("conv_id", "audit", "role", "text", *carried).mapInArrow(run, schema)
