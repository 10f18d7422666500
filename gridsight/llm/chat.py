"""Chat formatting with minimum-cost role repair.

A legal conversation starts with an optional system message, goes on with user
and assistant messages in turn, and ends with an assistant message. Turns that
break this are repaired at least cost: a turn may be merged into the message
before it, given another role, or have empty messages put before it. The best
repair is a shortest path over the automaton of legal turns, found by dynamic
programming; the repaired sequence is then rendered.

The cost of a stretch of turns is a min-plus matrix over the automaton's states,
and stretches compose. Turns are sorted by ranges, so a conversation with a third
of all rows is spread over tasks. Conversations are cut to parts of ``PART_TURNS``
turns, counted from their first turn whatever the tasks, so the result does not
hang on the partitioning: only those that lie across the borders of tasks (one a
border) are cut again, by turn numbers. Most have one part and are repaired and
rendered where they are. The matrices of the others are multiplied up a tree with a
fan of ``FAN``, which settles the states between parts on its way down.

Texts are rendered so that they cannot forge a turn: a marker in a text gets a
backslash after its ``<`` (one more where there are some), which ``unescaped`` takes
back.

Defined results: null and unknown roles are relabelled at a lower cost than known
ones; null texts are empty; turns with equal numbers are ordered by role and a
64-bit hash of the text, and null numbers come last; repeated rows are turns of
their own; rows with a null conversation id are one conversation; among repairs of
equal cost the one whose states come first in ``STATES``, from the end, is taken; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import scratch

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last message.
STATES = ("start", *ROLES)
#: Legal successors of a state.
NEXT = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
END = "assistant"
MERGE, INSERT, RELABEL, RELABEL_UNKNOWN = 2, 3, 5, 1
FAR = 1 << 40
#: Turns of a part, matrices that meet in one row, and characters of parts in one batch.
PART_TURNS, FAN, BATCH_CHARACTERS = 256, 256, 1 << 22
_MARKER, _ESCAPED = re.compile(r"<(\\*)\|im_"), re.compile(r"<\\(\\*)\|im_")
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"

Matrix = tuple[tuple[int, ...], ...]


@lru_cache
def inserted(state: str, role: str) -> tuple[str, ...] | None:
    """The fewest empty messages that lead from a state to a new message of a role; None if none do."""
    ways = [(state, ())]
    for _ in STATES:
        for at, path in ways:
            if role in NEXT[at]:
                return path
        ways = [(to, (*path, to)) for at, path in ways for to in NEXT[at]]
    return None


@lru_cache
def steps(role: str | None) -> tuple[tuple[tuple[int, str, tuple[str, ...]] | None, ...], ...]:
    """``[from][to]``: cost, kind (merge or message) and insertions of the cheapest way to take a turn."""
    known = role if role in ROLES else None
    table = []
    for state in STATES:
        row: list[tuple[int, str, tuple[str, ...]] | None] = []
        for to in STATES:
            ways = []
            if to != "start":
                relabel = 0 if to == known else RELABEL if known else RELABEL_UNKNOWN
                empty = inserted(state, to)
                if empty is not None:
                    ways.append((relabel + INSERT * len(empty), "message", empty))
                if to == state:
                    ways.append((relabel + MERGE, "merge", ()))
            row.append(min(ways, default=None))
        table.append(tuple(row))
    return tuple(table)


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in range(len(STATES))) for i in range(len(STATES)))


def _apply(vector: list[int], role: str | None) -> list[int]:
    table = steps(role)
    return [min((min(FAR, vector[i] + w[0]) for i in range(len(STATES)) if (w := table[i][j]) is not None), default=FAR) for j in range(len(STATES))]


def matrix(roles: list[str | None]) -> Matrix:
    """Least costs of a stretch between states."""
    rows = [list(r) for r in IDENTITY]
    for role in roles:
        rows = [_apply(r, role) for r in rows]
    return tuple(map(tuple, rows))


def _closing(state: str) -> tuple[str, ...] | None:
    return () if state == END else (*inserted(state, END), END) if inserted(state, END) is not None else None


def end_cost(state: int) -> int:
    found = _closing(STATES[state])
    return FAR if found is None else INSERT * len(found)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Costs of two stretches in a row."""
    size = range(len(STATES))
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in size)) for j in size) for i in size)


def cheapest_end(m: Matrix) -> tuple[int, int]:
    """Total cost of a whole conversation, and the state it ends in before it is closed."""
    return min((m[0][s] + end_cost(s), s) for s in range(len(STATES)))


def between(matrices: list[Matrix], first: int, last: int) -> list[int]:
    """The states at the ends of stretches (one more than there are stretches), from ``first`` to ``last``."""
    size = range(len(STATES))
    vectors = [[0 if s == first else FAR for s in size]]
    for m in matrices:
        vectors.append([min(min(FAR, vectors[-1][i] + m[i][j]) for i in size) for j in size])
    states = [last]
    for k in reversed(range(len(matrices))):
        states.append(min(size, key=lambda i: (vectors[k][i] + matrices[k][i][states[-1]], i)))
    return states[::-1]


def path(roles: list[str | None], first: int, last: int) -> list[tuple[str, str, tuple[str, ...]]]:
    """Per turn: its role after repair, whether it is a message or merged, and the insertions before it."""
    vectors = [[0 if s == first else FAR for s in range(len(STATES))]]
    for role in roles:
        vectors.append(_apply(vectors[-1], role))
    out, state = [], last
    for k in reversed(range(len(roles))):
        table = steps(roles[k])
        before = min((vectors[k][i] + table[i][state][0], i) for i in range(len(STATES)) if table[i][state] is not None)[1]
        _, kind, empty = table[before][state]
        out.append((STATES[state], kind, empty))
        state = before
    return out[::-1]


def escaped(text: str) -> str:
    """A text without markers of turns."""
    return _MARKER.sub(r"<\\\1|im_", text) if "|im_" in text else text


def unescaped(text: str) -> str:
    """What ``escaped`` was given."""
    return _ESCAPED.sub(r"<\1|im_", text)


def render(roles: list[str | None], texts: list[str | None], first: int, last: int, ends: bool) -> tuple[str, int]:
    """Text of a stretch between two states, and the messages begun in it; ``ends`` closes the conversation."""
    parts: list[str] = []
    count, open_ = 0, first != 0

    def begin(role: str) -> None:
        nonlocal count, open_
        if open_:
            parts.append(CLOSE)
        parts.append(OPEN + role + MIDDLE)
        count, open_ = count + 1, True

    for (role, kind, empty), text in zip(path(roles, first, last), texts, strict=True):
        if kind == "merge":
            parts.append("\n")
        else:
            for e in empty:
                begin(e)
            begin(role)
        parts.append(escaped(text or ""))
    if ends:
        for e in _closing(STATES[last]) or ():
            begin(e)
        if open_:
            parts.append(CLOSE)
    return "".join(parts), count


def repair(turns: list[tuple[str | None, str | None]], *, part: int = PART_TURNS) -> tuple[int, list[tuple[str, int]]]:
    """Cost of one conversation held in memory, and the rendering and messages of its parts."""
    cut = [turns[i : i + part] for i in range(0, len(turns), part)] or [[]]
    matrices = [matrix([r for r, _ in c]) for c in cut]
    cost, last = cheapest_end(reduce(product, matrices))
    states = between(matrices, 0, last)
    return cost, [render([r for r, _ in c], [t for _, t in c], states[k], states[k + 1], k + 1 == len(cut)) for k, c in enumerate(cut)]


def _pieces(conversations: DataFrame, conv: str, turn: str, role: str, text: str, part_turns: int) -> DataFrame:
    """``conv_id, task, part, n, first, last, roles, texts``: parts as far as a task goes.

    ``first`` marks the first conversation of a task, ``last`` the last part a conversation has in it.
    """
    kind = conversations.schema[conv].dataType.simpleString()
    rows = conversations.select(
        conversations[conv].alias("conv_id"), F.lower(F.trim(conversations[role])).alias("role"), F.coalesce(conversations[text], F.lit("")).alias("text"), conversations[turn].alias("turn"), F.monotonically_increasing_id().alias("row")
    )
    # Rows alike in all but the last key are the same, so that key only keeps repeated rows from crowding one task.
    keys = [F.col("conv_id"), F.col("turn").isNull(), F.col("turn"), F.col("role"), F.xxhash64("text"), F.col("row")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        begun, current, part, first = False, None, 0, True
        roles: list = []
        texts: list[str] = []
        done: list[tuple] = []
        size = 0

        def close(last: bool) -> None:
            nonlocal roles, texts, part, first
            if roles:
                done.append((current, task, part, len(roles), first, last, roles, texts))
            roles, texts, part = [], [], 0 if last else part + 1
            first = first and not last

        def emit() -> pa.RecordBatch:
            types = [kind_of, pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string())]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], ["conv_id", "task", "part", "n", "first", "last", "roles", "texts"])
            done.clear()
            return made

        for batch in batches:
            kind_of = batch.schema.field(0).type
            for key, r, t in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if begun and (key != current or len(roles) == part_turns):
                    close(key != current)
                    if size >= BATCH_CHARACTERS:
                        yield emit()
                        size = 0
                begun, current = True, key
                roles.append(r)
                texts.append(t)
                size += len(t) + 16
        close(True)
        if done:
            yield emit()

    schema = f"conv_id {kind}, task int, part long, n long, first boolean, last boolean, roles array<string>, texts array<string>"
    return ordered.select("conv_id", "role", "text").mapInArrow(run, schema)


def _same(a: DataFrame, b: DataFrame, *names: str):
    """Null-safe equality of columns of two frames that carry aliases ``a`` and ``b``."""
    return reduce(lambda x, y: x & y, [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names])


def _across(pieces: DataFrame) -> DataFrame:
    """``conv_id, task, before``: of conversations that lie in several tasks, the turns before each task.

    All but the first task such a conversation lies in begin with it, so there are no more of them than tasks, and two rows a task at most.
    """
    begun = scratch.table(pieces.filter("first").select("conv_id").distinct(), "begun")
    mine = pieces.select("conv_id", "task", "n").alias("a").join(F.broadcast(begun.alias("b")), _same(pieces, begun, "conv_id"), "left_semi")
    runs = mine.groupBy("conv_id", "task").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    told = runs.withColumns({"tasks": F.count(F.lit(1)).over(whole), "before": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    return scratch.table(told.filter("tasks > 1").select("conv_id", "task", "before"), "across")


def _matrices(column: pa.Array) -> list[Matrix]:
    size = len(STATES)
    return [tuple(tuple(costs[i * size : (i + 1) * size]) for i in range(size)) for costs in column]


def _settled(parts: DataFrame, fan: int) -> DataFrame:
    """``conv_id, no, first, last, ends, cost`` of every part ``(conv_id, part, roles)``, by a tree over parts."""
    kind = parts.schema["conv_id"].dataType.simpleString()

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [[x for r in matrix(roles) for x in r] for roles in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(costs, pa.list_(pa.int64()))], ["conv_id", "no", "costs"])

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [[x for r in reduce(product, _matrices([c["costs"] for c in children])) for x in r] for children in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(costs, pa.list_(pa.int64()))], ["conv_id", "no", "children", "costs"])

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cheapest_end(m) for m in _matrices(batch.column(1).to_pylist())]
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([0] * n, pa.int64()), pa.array([0] * n, pa.int32()), pa.array([s for _, s in found], pa.int32()), pa.array([True] * n, pa.bool_()), pa.array([c for c, _ in found], pa.int64())],
                ["conv_id", "no", "first", "last", "ends", "cost"],
            )

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            owners: list[int] = []
            for k, (children, first, last, ends, cost) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True)):
                states = between(_matrices([c["costs"] for c in children]), first, last)
                owners += [k] * len(children)
                rows += [(c["no"], states[i], states[i + 1], ends and i + 1 == len(children), cost) for i, c in enumerate(children)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], ["conv_id", "no", "first", "last", "ends", "cost"])

    child = "struct<no: bigint, costs: array<bigint>>"
    nodes = scratch.table(parts.select("conv_id", "part", "roles").mapInArrow(leaves, f"conv_id {kind}, no long, costs array<long>"), "leaves")
    most, levels = nodes.agg(F.max("no")).first()[0] or 0, []
    while not levels or most > 0:
        met = nodes.groupBy("conv_id", F.call_function("div", F.col("no"), F.lit(fan)).alias("no")).agg(F.sort_array(F.collect_list(F.struct("no", "costs"))).alias("children"))
        levels.append(scratch.table(met.mapInArrow(up, f"conv_id {kind}, no long, children array<{child}>, costs array<long>"), "level"))
        nodes, most = levels[-1], most // fan
    ends = f"conv_id {kind}, no long, first int, last int, ends boolean, cost long"
    state = levels[-1].select("conv_id", "costs").mapInArrow(top, ends)
    for level in reversed(levels):
        held = level.select("conv_id", "no", "children").alias("a").join(state.alias("b"), _same(level, state, "conv_id", "no"))
        state = scratch.table(held.select("a.conv_id", "children", "first", "last", "ends", "cost").mapInArrow(down, ends), "states")
    return state


def format_chats(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = PART_TURNS, fan: int = FAN) -> DataFrame:
    """``conv_id, part, n_turns, n_messages, cost, rendered``: one row per conversation of at most ``part_turns`` turns.

    Longer ones come in parts of as many turns; their rendering is the parts' in order. ``cost`` is the conversation's.
    """
    kind = conversations.schema[conv].dataType.simpleString()
    pieces = scratch.table(_pieces(conversations, conv, turn, role, text, part_turns), "pieces")
    across = _across(pieces)
    mine = pieces.alias("a")
    inside = mine.join(F.broadcast(across.select("conv_id").distinct().alias("b")), _same(pieces, across, "conv_id"), "left_anti")
    met = mine.join(F.broadcast(across.alias("b")), _same(pieces, across, "conv_id", "task"))
    turns = met.select("a.conv_id", (F.col("b.before") + F.col("a.part") * part_turns).alias("start"), F.posexplode(F.arrays_zip("a.roles", "a.texts")).alias("k", "t"))
    placed = turns.select("conv_id", (F.col("start") + F.col("k")).alias("at"), "t")
    cut = placed.groupBy("conv_id", F.call_function("div", F.col("at"), F.lit(part_turns)).alias("part")).agg(F.sort_array(F.collect_list(F.struct("at", "t"))).alias("ts"))
    again = scratch.table(cut.select("conv_id", "part", F.transform("ts", lambda x: x["t"]["roles"]).alias("roles"), F.transform("ts", lambda x: x["t"]["texts"]).alias("texts")), "cut-again")
    columns = ["conv_id", "part", "roles", "texts"]
    short = inside.filter("part = 0 AND last").select(*columns)
    long = inside.filter("part > 0 OR NOT last").select(*columns).unionByName(again)
    states = _settled(long.select("conv_id", "part", "roles"), fan)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for roles, texts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                cost, last = cheapest_end(matrix(roles))
                found.append((len(roles), cost, *render(roles, texts, 0, last, True)))
            yield _rendered(batch, found)

    def many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(2, 8)), strict=True)
            yield _rendered(batch, [(len(roles), cost, *render(roles, texts, first, last, ends)) for roles, texts, first, last, ends, cost in rows])

    schema = f"conv_id {kind}, part long, n_turns long, n_messages long, cost long, rendered string"
    joined = long.alias("a").join(states.withColumnRenamed("no", "part").alias("b"), _same(long, states, "conv_id", "part"))
    return short.mapInArrow(one, schema).unionByName(joined.select(*[f"a.{c}" for c in columns], "first", "last", "ends", "cost").mapInArrow(many, schema))


def _rendered(batch: pa.RecordBatch, found: list[tuple[int, int, str, int]]) -> pa.RecordBatch:
    turns, costs, texts, messages = zip(*found, strict=True) if found else ((), (), (), ())
    made = [pa.array(turns, pa.int64()), pa.array(messages, pa.int64()), pa.array(costs, pa.int64()), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["conv_id", "part", "n_turns", "n_messages", "cost", "rendered"])


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
