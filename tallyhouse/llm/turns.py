"""Repair of conversations: the cheapest edits that make roles alternate again.

A conversation is repaired if the initials of its roles read (s?(ua)+)?. Finding the
cheapest edits is a Viterbi search over four states (nothing yet, after s, after u,
after a), where a row is a product of (min, +) with a small matrix. A conversation is
cut into chunks of rows, which are worked on side by side: each starts from a
speculative vector of costs for what follows it. A fix-up pass hands each chunk the
vector that the next one has found and runs the chunk again, unless that vector
differs from the one it was run with by a constant only. Most chunks end at the same
vector whatever they start with, so a pass or two suffice; the constants are added up
afterwards. The stitched costs then tell a forward trace, at each place, which edits are on
a cheapest way, and it takes the least of them.

Rows travel without their texts: a digest tells equal texts, a byte holds what the
search needs to know of a row. Texts are joined again to the rows that stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyhouse.llm.common import written

#: Any character that is not white space, and what a whole text ends with.
VISIBLE = r"[^\x20\x09-\x0D]"
ENDED = r"(?s).*[.!?][\x20\x09-\x0D]*"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Classes of a role by its initial, and faults, as they lie in a row's byte.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
NO_FAULT, BLANK, DUPLICATE, CUT = range(4)
FAULTS = ("blank", "duplicate", "truncated")
#: States: nothing yet, after a system row, after a user's, after an assistant's.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOWED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: Costs of what follows the last row, by state: the inserts that still lack.
NOTHING_FOLLOWS = (0, 2 * INSERT, INSERT, 0)
CHUNK = 4096
#: A fix-up pass hands vectors on through so many chunks; the next one through as
#: many times as many, so that a run that never converges takes few passes.
SPAN = 64


def _after(state: int, role: int) -> int | None:
    """The state that a kept row of this class leads to, if it may follow."""
    if role == SYSTEM:
        return AFTER_S if state == START else None
    if role in (USER, ASSISTANT) and FOLLOWED[state] == role:
        return FOLLOWED[state]
    return None


MOVES = [[_after(state, role) for state in range(4)] for role in range(4)]


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    u, a = min(costs[AFTER_U], INSERT + costs[AFTER_A]), min(costs[AFTER_A], INSERT + costs[AFTER_U])
    return min(costs[START], INSERT + u), min(costs[AFTER_S], INSERT + u), u, a


def _before(follows: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Costs by the state before a row (its first copy), of those by the state after it."""
    role, fault = code & 3, code >> 2
    if fault in (BLANK, DUPLICATE):
        return tuple(DELETE + x for x in follows)
    more = TRUNCATED if fault == CUT else 0
    moves, costs = MOVES[role], []
    for state in range(4):
        best = min(DELETE + follows[state], REROLE + more + follows[FOLLOWED[state]])
        if moves[state] is not None:
            best = min(best, KEEP + more + follows[moves[state]])
        costs.append(best)
    return _with_inserts(costs)


def _backward(codes: bytes, copies: list[int], follows: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs before each row of a chunk, and after the last one. Copies of a row after
    its first go, whatever it is."""
    costs = [follows]
    for code, n in zip(reversed(codes), reversed(copies), strict=True):
        costs.append(_before(tuple(x + DELETE * (n - 1) for x in costs[-1]) if n > 1 else costs[-1], code))
    costs.reverse()
    return costs


def _normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """A vector less its least component, and that."""
    least = min(costs)
    return tuple(x - least for x in costs), least


def _trace(
    codes: bytes, copies: list[int], follows: tuple[int, ...], state: int, last: bool
) -> tuple[list[str], list[str], int]:
    """The least of the cheapest edits of a chunk from a state: for each row its edits,
    and what they make (u, a: an inserted turn; U, A: the row with that role; K: the
    row itself); and the state after the chunk. Inserts come with the row they precede,
    after the last row of a conversation with that."""
    costs = _backward(codes, copies, follows)
    edits, made = [], []
    for at, (code, n) in enumerate(zip(codes, copies, strict=True)):
        role, fault = code & 3, code >> 2
        more = TRUNCATED if fault == CUT else 0
        rest = tuple(x + DELETE * (n - 1) for x in costs[at + 1])
        edit, make = "", ""
        while True:
            cost, to = costs[at][state], FOLLOWED[state]
            if cost == DELETE + rest[state]:
                edit += "D"
                break
            # A turn is inserted where that is on a cheapest way: the letter is the least but one.
            if cost == INSERT + costs[at][to]:
                edit, make, state = edit + "I", make + ("u" if to == AFTER_U else "a"), to
                continue
            kept = MOVES[role][state]
            if kept is not None and cost == KEEP + more + rest[kept]:
                edit, make, state = edit + "K", make + "K", kept
            else:
                edit, make, state = edit + "R", make + ("U" if to == AFTER_U else "A"), to
            break
        edits.append(edit + "D" * (n - 1))
        made.append(make)
    if last:
        while state in (AFTER_S, AFTER_U):
            state = FOLLOWED[state]
            edits[-1], made[-1] = edits[-1] + "I", made[-1] + ("u" if state == AFTER_U else "a")
    return edits, made, state


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 64) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _streamed(rows: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """The tuples that `work` makes of a partition's rows, read one after the other."""
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _batched(work(_rows(batches)), arrow), schema)


def row_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) to rows without text, one for all copies, with
    class, fault and digest of role and text, written.

    A row is a duplicate if its role and text were seen in an earlier turn; all copies
    of a row but the first are too.
    """
    role, text = F.col("role"), F.col("text")
    initial = F.substring(role, 1, 1)
    cls = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    own = F.when(~text.rlike(VISIBLE), BLANK).when(~text.rlike(f"^{ENDED}$"), CUT).otherwise(NO_FAULT)
    each = written(
        rows.select("conv_id", "turn", _digest(role, text).alias("digest"), cls.alias("cls"), own.alias("own"), "copies")
        .groupBy("conv_id", "turn", "cls", "digest").agg(F.max("own").alias("own"), F.sum("copies").alias("copies")), "turn-rows",
    )
    again = written(
        each.where(F.col("own") != BLANK).groupBy(F.col("conv_id").alias("again_id"), F.col("digest").alias("again_digest"))
        .agg(F.count("*").alias("n"), F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("first"))
        .where("n > 1"), "repeated-turns",
    )
    same = F.col("conv_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest"))
    first = F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    repeated = F.col("n").isNotNull() & (F.col("own") != BLANK) & ~first
    return each.join(again, same, "left").select(
        "conv_id", "turn", "cls", "digest", "copies", F.when(repeated, DUPLICATE).otherwise(F.col("own")).alias("fault")
    )


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def _row_key(conv_id: Column, turn: Column, digest: Column) -> Column:
    """One value for conversation, turn and digest, nulls included."""
    return F.unhex(F.sha2(F.to_json(F.struct(conv_id.alias("c"), turn.alias("t"), F.hex(digest).alias("d"))), 256))


def _chunk_schema(conv_id: T.DataType, turn: T.DataType) -> T.StructType:
    numbers = T.ArrayType(T.IntegerType())
    return T.StructType([
        T.StructField("conv_id", conv_id), T.StructField("chunk", T.LongType()),
        T.StructField("turns", T.ArrayType(turn)), T.StructField("digests", T.ArrayType(T.BinaryType())),
        T.StructField("codes", T.BinaryType()), T.StructField("copies", T.ArrayType(T.LongType())),
        T.StructField("follows", numbers), T.StructField("before", numbers), T.StructField("gain", T.LongType()),
        *[T.StructField(name, T.LongType()) for name in (*FAULTS, "illegal")],
        T.StructField("first_cls", T.IntegerType()), T.StructField("last_cls", T.IntegerType()),
    ])


def chunks_of(faulty: DataFrame, size: int = CHUNK) -> DataFrame:
    """Chunks of up to `size` rows of a conversation, in order, each run once from the
    vector that an end of a conversation has.

    Rows are put in order over all partitions at once, so a long conversation lies in
    many of them. Chunk numbers grow along a conversation.
    """
    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def chunk() -> tuple:
            codes, copies = bytes(cls + 4 * fault for _, _, cls, _, _, fault in held), [row[4] for row in held]
            counts = [0, 0, 0]
            for _, _, _, _, n, fault in held:
                if fault:
                    counts[fault - 1] += 1
                    counts[(BLANK if fault == BLANK else DUPLICATE) - 1] += n - 1
                else:
                    counts[DUPLICATE - 1] += n - 1
            illegal = sum(n - 1 for n in copies) + sum(
                not _legal(one[2], other[2]) for one, other in zip(held, held[1:], strict=False)
            )
            before, gain = _normal(_backward(codes, copies, NOTHING_FOLLOWS)[0])
            return (
                held[0][0], number, [row[1] for row in held], [row[3] for row in held], codes, copies,
                list(NOTHING_FOLLOWS), list(before), gain, *counts, illegal, held[0][2], held[-1][2],
            )

        for row in rows:
            if held and (row[0] != held[0][0] or len(held) == size):
                yield chunk()
                number, held = number + 1, []
            held.append(row)
        if held:
            yield chunk()

    order = ["conv_id", "turn", "cls", "digest"]
    # System rows come first among those of a turn, then users', assistants', others.
    place = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), (F.col("cls") + 3) % 4, F.col("digest")]
    placed = faulty.select(*order, "copies", "fault").repartitionByRange(*place).sortWithinPartitions(*place)
    schema = _chunk_schema(faulty.schema["conv_id"].dataType, faulty.schema["turn"].dataType)
    return written(_streamed(placed, cut, schema), "chunks")


def _legal(one: int, other: int) -> bool:
    return (one, other) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def _by_conversation(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows of a conversation in one task, in order, read as a stream: for rows that
    stand for whole chunks, or where the result is one value that needs this order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


FIXED = ["conv_id", "chunk", "place", "codes", "copies", "follows", "before", "gain"]


def fixed_up(chunks: DataFrame, span: int = SPAN) -> DataFrame:
    """The chunks of conversations that have several, each with the vector that really
    follows it (less a constant), written; `place` counts from the last one back."""
    lone = chunks.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("long_id"))
    several = chunks.join(lone, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    keys = T.StructType([several.schema["conv_id"], several.schema["chunk"], T.StructField("place", T.LongType())])

    def counted(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, place = (), 0
        for conv_id, chunk in rows:
            place = place + 1 if last == (conv_id,) else 0
            last = (conv_id,)
            yield conv_id, chunk, place

    places = _streamed(_by_conversation(several.select("conv_id", "chunk"), F.desc("chunk")), counted, keys)
    state = written(
        several.select(*[name for name in FIXED if name != "place"]).join(places.select("chunk", "place"), "chunk").select(*FIXED), "fix-up"
    )
    schema = T.StructType([*state.schema.fields, T.StructField("changed", T.BooleanType())])

    def swept(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, handed = None, None
        for conv_id, chunk, place, codes, copies, follows, before, gain, found in rows:
            wanted = handed if last == (conv_id, place - 1) else found
            changed = wanted is not None and list(wanted) != follows
            if changed:
                follows = list(wanted)
                start, gain = _normal(_backward(codes, copies, tuple(follows))[0])
                changed, before = list(start) != before, list(start)
            last, handed = (conv_id, place), before
            yield conv_id, chunk, place, codes, copies, follows, before, gain, changed

    while True:
        following = state.select(
            F.col("conv_id").alias("next_id"), (F.col("place") + 1).alias("next_place"), F.col("before").alias("found")
        )
        handed = state.join(
            following, F.col("conv_id").eqNullSafe(F.col("next_id")) & (F.col("place") == F.col("next_place")), "left"
        ).select(*FIXED, "found").withColumn("block", F.floor(F.col("place") / span))
        pass_over = handed.repartition("conv_id", "block").sortWithinPartitions("conv_id", "place").drop("block")
        swept_rows = written(_streamed(pass_over, swept, schema), "fix-up")
        state, span = swept_rows.drop("changed"), span * SPAN
        if swept_rows.where("changed").isEmpty():
            return state


def stitched(fixed: DataFrame) -> DataFrame:
    """(chunk, follows, state, last) of the chunks in `fixed`: the state the trace of a
    chunk begins with. Each is traced from every state; what that leads to is handed on."""
    ends = T.StructType([fixed.schema["conv_id"], fixed.schema["chunk"], T.StructField("ends", T.ArrayType(T.IntegerType()))])

    def traced(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, chunk, codes, copies, follows in rows:
            yield conv_id, chunk, [_trace(codes, copies, tuple(follows), state, False)[2] for state in range(4)]

    def begun(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, state = (), START
        for conv_id, chunk, leads in rows:
            state = state if last == (conv_id,) else START
            yield chunk, state
            last, state = (conv_id,), leads[state]

    maps = _streamed(fixed.select("conv_id", "chunk", "codes", "copies", "follows"), traced, ends)
    begins = T.StructType([fixed.schema["chunk"], T.StructField("state", T.IntegerType())])
    states = _streamed(_by_conversation(maps, F.col("chunk")), begun, begins)
    return fixed.select("chunk", "follows", (F.col("place") == 0).alias("last")).join(states, "chunk")


def repaired_rows(chunks: DataFrame, fixed: DataFrame) -> DataFrame:
    """(conv_id, chunk, at, turn, digest, edits, made): the edits of each row, in the
    order of chunk and at, and what they make, as _trace gives it."""
    kinds = T.StructType([
        chunks.schema["conv_id"], chunks.schema["chunk"], chunks.schema["turns"], chunks.schema["digests"],
        T.StructField("edits", T.ArrayType(T.StringType())), T.StructField("made", T.ArrayType(T.StringType())),
    ])

    def traced(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, chunk, turns, digests, codes, copies, follows, state, last in rows:
            edits, made, _ = _trace(codes, copies, tuple(follows), state, last)
            yield conv_id, chunk, turns, digests, edits, made

    fixes = stitched(fixed).withColumnRenamed("follows", "real")
    joined = chunks.join(fixes, "chunk", "left").select(
        "conv_id", "chunk", "turns", "digests", "codes", "copies", F.coalesce("real", "follows").alias("follows"),
        F.coalesce("state", F.lit(START)).alias("state"), F.coalesce("last", F.lit(True)).alias("last"),
    )
    each = F.posexplode(F.arrays_zip("turns", "digests", "edits", "made")).alias("at", "of")
    return _streamed(joined, traced, kinds).select("conv_id", "chunk", each).select(
        "conv_id", "chunk", "at", F.col("of.turns").alias("turn"), F.col("of.digests").alias("digest"), "of.edits", "of.made"
    )


def conversation_counts(chunks: DataFrame, fixed: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost) of each conversation."""
    sums = [F.sum(name).alias(name) for name in FAULTS]
    real = fixed.select("chunk", F.col("gain").alias("real_gain"), F.col("before").alias("real_before"))
    one = chunks.join(real, "chunk", "left").select(
        "conv_id", "chunk", *FAULTS, "illegal", "first_cls", "last_cls",
        F.coalesce("real_gain", "gain").alias("gain"), F.coalesce("real_before", "before").alias("before"),
    )
    schema = T.StructType([
        chunks.schema["conv_id"], *[T.StructField(name, T.LongType()) for name in ("seams", "offset")]
    ])

    def seamed(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, before = (), None
        for conv_id, first_cls, last_cls, costs in rows:
            if last == (conv_id,):
                yield conv_id, int(not _legal(before, first_cls)), 0
            else:
                yield conv_id, 0, costs[START]
            last, before = (conv_id,), last_cls

    ordered = _by_conversation(one.select("conv_id", "chunk", "first_cls", "last_cls", "before"), F.col("chunk")).drop("chunk")
    seams = _streamed(ordered, seamed, schema)
    parts = one.select("conv_id", *FAULTS, "illegal", F.col("gain").alias("cost")).unionByName(
        seams.select("conv_id", *[F.lit(0).cast("long").alias(name) for name in FAULTS], F.col("seams").alias("illegal"), F.col("offset").alias("cost"))
    )
    counts = parts.groupBy("conv_id").agg(*sums, F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    turns = chunks.select("conv_id", F.explode("turns").alias("turn"))
    gaps = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    ).withColumnRenamed("conv_id", "gap_id")
    return counts.join(gaps, F.col("conv_id").eqNullSafe(F.col("gap_id")), "left").drop("gap_id")


def repair_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    copies: str | None = None, size: int = CHUNK, span: int = SPAN,
) -> tuple[DataFrame, DataFrame]:
    """(the turns of the repaired conversations, the counts of each).

    Turns: (conv_id, chunk, at, edits, turns), a row for each row of a conversation (all
    its copies), in the order of chunk and at; `edits` has their letters, Keep, Rerole,
    Delete, Insert, and `turns` the array<struct<role, text>> they leave.

    A null role or text is a single space, a null conv_id a conversation like others.
    Rows are in the order of their turns, null ones first; rows of one turn with system
    rows first, then users', assistants', others, and then in the order of a digest.
    `copies` names a column that says how often a row is there, adjacent. Empty tables
    give no rows.
    """
    named = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        *[F.coalesce(F.col(name), F.lit(" ")).alias(alias) for name, alias in ((role, "role"), (text, "text"))],
        (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"),
    )
    chunks = chunks_of(row_faults(named), size)
    fixed = fixed_up(chunks, span)
    edits = written(repaired_rows(chunks, fixed), "edits")
    texts = named.select(
        _row_key(F.col("conv_id"), F.col("turn"), _digest(F.col("role"), F.col("text"))).alias("text_key"), "role", "text"
    ).dropDuplicates(["text_key"])
    own = edits.withColumn("row_key", _row_key(F.col("conv_id"), F.col("turn"), F.col("digest")))
    whole = own.join(texts, F.col("row_key") == F.col("text_key"), "left").select("conv_id", "chunk", "at", "edits", F.when(
        F.col("made") != "", F.transform(F.split("made", ""), lambda m: F.struct(
            F.when(m == "K", F.col("role")).when(m.isin("u", "U"), "user").otherwise("assistant").alias("role"),
            F.when(m.isin("u", "a"), "").otherwise(F.col("text")).alias("text"),
        ))
    ).otherwise(F.array().cast("array<struct<role:string,text:string>>")).alias("turns"))
    return whole, conversation_counts(chunks, fixed)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the letters of all edits of a conversation, and
    the digest of its turns as role:text, joined by newlines.

    A digest is made byte after byte, so the turns of a conversation pass one task in
    order, as a stream; only its letters are held there.
    """
    schema = T.StructType([turns.schema["conv_id"], *[T.StructField(name, T.StringType()) for name in ("audit", "repaired_sha256")]])
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    ordered = _by_conversation(turns.select("conv_id", "chunk", "at", "edits", line.alias("lines")), F.col("chunk"), F.col("at"))

    def digested(rows: Iterator[tuple]) -> Iterator[tuple]:
        of, audit, sha, some = (), [], hashlib.sha256(), False
        for conv_id, edits, lines in rows:
            if of != (conv_id,):
                if of:
                    yield of[0], "".join(audit), sha.hexdigest()
                of, audit, sha, some = (conv_id,), [], hashlib.sha256(), False
            audit.append(edits)
            for text in lines:
                sha.update(("\n" + text if some else text).encode())
                some = True
        if of:
            yield of[0], "".join(audit), sha.hexdigest()

    return _streamed(ordered.drop("chunk", "at"), digested, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults: (conv_id, turn, role, text, copies).

    What happens to a row goes by the crc32 of `conv_id:turn`, null being a space, as it
    is for a null role or text: of twenty remainders 0 drops it, 1 empties the text, 2
    takes `.`, `!` and `?` out, 3 doubles the row, 4 makes the role user.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")])
    lot = F.crc32(key.cast("binary")) % 20
    return rows.select("conv_id", "turn", "role", "text", lot.alias("lot")).where("lot <> 0").select(
        "conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace(F.coalesce("text", F.lit(" ")), "[.!?]", ""))
        .otherwise(F.coalesce("text", F.lit(" "))).alias("text"),
        F.when(F.col("lot") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
