"""Conversation structure repair: the cheapest edits, by a dynamic program with square-root checkpoints.

A conversation's rows, by turn, are kept, given another role, deleted, or joined by empty turns, until their
roles read ``s?(ua)+`` (or nothing is left). Costs: keep 0, rerole 3, delete 4, insert 3, and 3 more for a
truncated row that stays; a blank or repeated row must go. Of equally cheap edits the ones whose initials
(D, I, K, R) come first in ASCII are taken. What an insert or a rerole gives is fixed by the place: a user's
turn, or the assistant's behind a user's.

The cost of finishing from before a row is four numbers, one for each state of the pattern. A first stream
reads a conversation backwards, one row of a few bytes at a time, and writes the four numbers only at
checkpoints, the k-th of them ``FIRST_GAP + k`` rows behind the one before: about the square root of twice
the rows, with no need to know how many there are. A second stream reads rows and checkpoints forwards, so a
block of rows is held until its checkpoint comes, its costs are worked out again from there, and the walk
goes on through it. Neither holds more of a conversation than one block, whatever its length; a conversation
is one sorted stream in one task, since its digest is one hash over all its text.

Cases: null role and text read as one space; null turns come first, a null conv_id is a conversation of its
own; rows of one turn go by role and the MD5 of their text, equal ones next to each other; a row repeats an
earlier one if role and text are equal, whatever its turn; empty tables give nothing; columns other than
conv_id, turn, role and text are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import ASCII_SPACE, partitions, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FIRST_GAP = 64
OUT_ROWS = 2048

#: Patterns' states: nothing yet, system, user, assistant. What a written turn leads to from each.
NEXT = (2, 2, 3, 2)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ROLE = {2: "user", 3: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)
NO_WAY = 1 << 60

ORDER = ("turn", "role", "digest")


def before(row: tuple[str, str], after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost of finishing from before a row (initial, fault), from that behind it, by state."""
    initial, fault = row
    cost = [DELETE + c for c in after]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        kept = KEPT.get(initial, {})
        for state in range(4):
            cost[state] = min(cost[state], REROLE + extra + after[NEXT[state]])
            if state in kept:
                cost[state] = min(cost[state], KEEP + extra + after[kept[state]])
    cost[2] = min(cost[2], INSERT + cost[3])
    cost[3] = min(cost[3], INSERT + cost[2])
    return min(cost[0], INSERT + cost[2]), min(cost[1], INSERT + cost[2]), cost[2], cost[3]


def walk(block: list[tuple[str, str]], after: tuple[int, ...], state: int) -> Iterator[tuple[str, int]]:
    """(edit, state behind it) through a block of rows, from the costs behind its last one."""
    costs = [after]
    for row in reversed(block):
        costs.append(before(row, costs[-1]))
    costs.reverse()
    for at, (initial, fault) in enumerate(block):
        here, behind = costs[at], costs[at + 1]
        extra = TRUNCATED if fault == "truncated" else 0
        while True:
            if DELETE + behind[state] == here[state]:
                yield "D", state
            elif INSERT + here[NEXT[state]] == here[state]:
                state = NEXT[state]
                yield "I", state
                continue
            elif state in KEPT.get(initial, {}) and fault not in ("blank", "duplicate") and KEEP + extra + behind[KEPT[initial][state]] == here[state]:
                state = KEPT[initial][state]
                yield "K", state
            else:
                state = NEXT[state]
                yield "R", state
            break


def closing(state: int) -> Iterator[tuple[str, int]]:
    """The inserts that end a conversation."""
    while END[state]:
        state = NEXT[state]
        yield "I", state


def marked(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, initial, fault; rows equal to the one before them are not yet marked."""
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.md5("text"))
    seen = (
        rows.groupBy(F.col("conv_id").alias("s_conv"), F.col("role").alias("s_role"), F.col("digest").alias("s_digest"))
        .agg(F.min("turn").alias("first"), F.max("turn").alias("last"), F.count_if(F.col("turn").isNull()).alias("unplaced"))
        .where((F.col("first") < F.col("last")) | (F.col("unplaced") > 0) & F.col("first").isNotNull())
    )
    end = F.right(F.rtrim(F.col("text"), F.lit(ASCII_SPACE)), F.lit(1))
    later = F.col("turn").isNotNull() & ((F.col("unplaced") > 0) | (F.col("turn") > F.col("first")))
    fault = (
        F.when(end == "", "blank").when(F.coalesce(later, F.lit(False)), "duplicate").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    )
    met = F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("role") == F.col("s_role")) & (F.col("digest") == F.col("s_digest"))
    return rows.join(seen, met, "left").select(
        "conv_id", "turn", "role", "text", "digest", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault")
    )


def faulty(row: dict, repeats: bool) -> tuple[str, str]:
    return row["initial"], "duplicate" if repeats and row["fault"] != "blank" else row["fault"]


def records(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for part in parts:
        for at in range(0, part.num_rows, 256):
            yield from part.slice(at, 256).to_pylist()


def filled(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size from tuples."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= OUT_ROWS or size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def checkpoints_of(rows: Iterator[dict]) -> Iterator[tuple]:
    """Costs from before some rows of conversations that come backwards: conv_id, turn, role, digest, four costs."""
    held = None
    costs, since, gap = END, 0, FIRST_GAP
    for row in rows:
        if held is not None:
            same = all(row[k] == held[k] for k in ("conv_id", *ORDER))
            costs, since = before(faulty(held, same), costs), since + 1
            if row["conv_id"] != held["conv_id"]:
                costs, since, gap = END, 0, FIRST_GAP
            elif since >= gap and not same:
                yield held["conv_id"], held["turn"], held["role"], held["digest"], *costs
                since, gap = 0, gap + 1
        held = row


EDITS = "step long, edit string, turn long, role string, text string, fault string, cost long, gaps long, illegal long"


def edits_of(rows: Iterator[dict]) -> Iterator[tuple]:
    """Edits of conversations that come forwards with their checkpoints; a row without an edit closes each."""
    block: list[tuple[tuple[str, str], dict]] = []
    conv, last, state, step, cost = None, None, 0, 0, 0
    low = high = None
    turns = illegal = 0

    def edited(after: tuple[int, ...]) -> Iterator[tuple]:
        nonlocal state, step, cost
        at = 0
        for edit, state in walk([row for row, _ in block], after, state):
            yield written(edit, None if edit == "I" else block[at])
            at += edit != "I"
        block.clear()

    def written(edit: str, held: tuple | None) -> tuple:
        nonlocal step, cost
        step += 1
        (_, fault), row = held or (("", ""), {"turn": None, "role": "", "text": ""})
        cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        role = ROLE[state] if edit in "IR" else row["role"]
        return conv, step, edit, row["turn"], role, row["text"], fault, cost, None, None

    def closed() -> Iterator[tuple]:
        nonlocal state
        yield from edited(END)
        for edit, state in closing(state):
            yield written(edit, None)
        yield conv, step + 1, None, None, None, None, None, cost, (high - low + 1 - turns if turns else 0), illegal

    for row in rows:
        if last is not None and row["conv_id"] != conv:
            yield from closed()
            last, state, step, cost, low, high, turns, illegal = None, 0, 0, 0, None, None, 0, 0
        if row["after"] is not None:
            yield from edited(tuple(row["after"]))
            continue
        conv = row["conv_id"]
        same = last is not None and all(row[k] == last[k] for k in ORDER)
        if row["turn"] is not None:
            low = row["turn"] if low is None else low
            turns += high is None or row["turn"] != high
            high = row["turn"]
        illegal += last is not None and last["initial"] + row["initial"] not in ("su", "ua", "au")
        block.append((faulty(row, same), row))
        last = {k: row[k] for k in (*ORDER, "initial")}
    if last is not None:
        yield from closed()


def arrow(schema: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, step, edit, turn, role, text, fault, cost, gaps, illegal: the edits of each conversation in order.

    Role and text are those after the edit (a deleted row's are its own). Each conversation ends with a row
    without an edit that has its gaps, its illegal neighbours and its cost. A conversation's rows come one
    after the other in one partition.
    """
    spark = turns.sparkSession
    rows = stored(marked(turns))
    kind = rows.schema["conv_id"].dataType.simpleString()
    n = partitions(spark)
    back = (
        rows.select("conv_id", *ORDER, "initial", "fault").repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("digest").desc())
    )
    at_schema = f"conv_id {kind}, turn long, role string, digest string, c0 long, c1 long, c2 long, c3 long"
    at_arrow, out_schema = arrow(at_schema, spark), f"conv_id {kind}, {EDITS}"
    out_arrow = arrow(out_schema, spark)
    points = back.mapInArrow(lambda parts: filled(checkpoints_of(records(parts)), at_arrow), at_schema)
    nothing = F.lit(None).cast("string")
    both = rows.withColumn("after", F.lit(None).cast("array<long>")).unionByName(
        points.select(
            "conv_id", *ORDER, nothing.alias("text"), nothing.alias("initial"), nothing.alias("fault"),
            F.array("c0", "c1", "c2", "c3").alias("after"),
        )
    )
    ahead = both.repartition(n, "conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "digest", F.col("after").asc_nulls_last()
    )
    return ahead.mapInArrow(lambda parts: filled(edits_of(records(parts)), out_arrow), out_schema)


DIGEST = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def digests_of(rows: Iterator[dict]) -> Iterator[tuple]:
    """One row a conversation from its edits in order: counts, cost, the edits' initials, the hash of what is left."""
    audit, faults, hashed, some = [], {"blank": 0, "duplicate": 0, "truncated": 0}, hashlib.sha256(), False
    for row in rows:
        if row["edit"] is None:
            yield row["conv_id"], row["gaps"], *faults.values(), row["illegal"], row["cost"], "".join(audit), hashed.hexdigest()
            audit, faults, hashed, some = [], {"blank": 0, "duplicate": 0, "truncated": 0}, hashlib.sha256(), False
            continue
        audit.append(row["edit"])
        if row["fault"]:
            faults[row["fault"]] += 1
        if row["edit"] != "D":
            hashed.update(f"{chr(10) if some else ''}{row['role']}:{row['text']}".encode())
            some = True


def digests(edits: DataFrame) -> DataFrame:
    """conv_id and the digest columns, from what ``repair`` gives."""
    schema = f"conv_id {edits.schema['conv_id'].dataType.simpleString()}, {DIGEST}"
    out = arrow(schema, edits.sparkSession)
    return edits.mapInArrow(lambda parts: filled(digests_of(records(parts)), out), schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults that the CRC-32 of their conversation and turn chooses; some are gone, some come twice."""
    space = F.lit(" ")
    chosen = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), chosen.alias("chosen")).where("chosen <> 0")
        .withColumns(
            {
                "text": F.when(F.col("chosen") == 1, "").when(F.col("chosen") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
                "role": F.when(F.col("chosen") == 4, "user").otherwise(F.col("role")),
                "copy": F.explode(F.when(F.col("chosen") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
            }
        )
        .select("conv_id", "turn", "role", "text")
    )


def with_all(conversations: DataFrame, digested: DataFrame) -> DataFrame:
    """A row for every conv_id of ``conversations``; one of which nothing was left has zeros and empty results."""
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(digested, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
