"""Conversations made legal at the least cost, and rendered.

Legal turns follow an automaton: a system turn may only come first, then user and assistant take turns.  Every turn of
the input either goes on as it is, is merged into the message before it, gets another role, or has empty messages put
before it; dynamic programming over the automaton's states finds the cheapest way for the whole conversation.

The cheapest costs between states form a small matrix, and matrices of consecutive stretches chain.  So a conversation
of any length is cut into stretches of ``STRETCH`` turn numbers: tasks work out each stretch's matrix, the matrices are
chained per conversation, and the stretches are gone through again with their states at both ends known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattsift.session import materialise

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ENDS = (USER, ASSISTANT)
STRETCH = 512  # turn numbers
TASK_TURNS = 200_000  # turns whose roles one task measures, at most on average
NEVER = 1 << 40


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    insert: int = 2
    relabel: int = 3
    name: int = 1  # of giving a role to a turn that has none, or an unknown one
    aliases: dict[str, str] = field(default_factory=lambda: {"human": "user", "bot": "assistant", "ai": "assistant", "model": "assistant"})


class Automaton:
    """Cheapest moves between states, by the role of the turn that comes next."""

    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        self.fill = {s: self._fills(s) for s in range(4)}
        self.tables = {r: self._table(r) for r in range(4)}
        self.closing = {s: min((len(self.fill[s][e]) for e in ENDS if e in self.fill[s]), default=0) if s not in (*ENDS, START) else 0 for s in range(4)}

    def _fills(self, state: int) -> dict[int, tuple[int, ...]]:
        """For each state that can be reached over empty messages the fewest of them."""
        found, queue = {state: ()}, [state]
        for s in queue:
            for x in LEGAL[s]:
                if x not in found:
                    found[x] = (*found[s], x)
                    queue.append(x)
        return found

    def _table(self, role: int) -> list[list[tuple[int, int, str, tuple[int, ...]] | None]]:
        """[state before][role after]: (cost, new messages, action, empty messages put before)."""
        table: list[list] = [[None] * 4 for _ in range(4)]
        for s in range(4):
            for x in (SYSTEM, USER, ASSISTANT):
                renamed = 0 if x == role else self.costs.relabel if role else self.costs.name
                word = "relabel" if renamed else "keep"
                options = [(renamed, 1, word, ())] if x in LEGAL[s] else []
                if s == x:
                    options.append((renamed + self.costs.merge, 0, "relabel+merge" if renamed else "merge", ()))
                fills = [(len(p), p) for e, p in self.fill[s].items() if p and x in LEGAL[e]]
                if fills:
                    n, path = min(fills)
                    options.append((renamed + n * self.costs.insert, n + 1, "relabel+insert" if renamed else "insert", path))
                if options:
                    table[s][x] = min(options, key=lambda o: o[0])
        return table

    def role(self, name: str | None) -> int:
        low = (name or "").strip().lower()
        low = self.costs.aliases.get(low, low)
        return ROLES.index(low) if low in ROLES else START

    def forward(self, roles: list[int], entry: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
        """Back steps for every turn, and (cost, messages) of the best way from ``entry`` to each state."""
        best = [(NEVER, 0)] * 4
        best[entry] = (0, 0)
        back: list[list[int]] = []
        for r in roles:
            table, new, step = self.tables[r], [(NEVER, 0)] * 4, [-1] * 4
            for x in (USER, ASSISTANT, SYSTEM):
                for s in range(4):
                    move = table[s][x]
                    if move is not None and best[s][0] < NEVER:
                        way = (best[s][0] + move[0], best[s][1] + move[1])
                        if way < new[x] or step[x] < 0:
                            new[x], step[x] = way, s
            best = new
            back.append(step)
        return back, best

    def matrix(self, roles: list[int]) -> list[int]:
        """(cost, messages) from each state to each state, flat."""
        return [v for s in range(4) for way in self.forward(roles, s)[1] for v in way]

    def path(self, roles: list[int], entry: int, leave: int) -> list[tuple[int, tuple[int, int, str, tuple[int, ...]]]]:
        """(state after, move) of every turn on the best way."""
        back, _ = self.forward(roles, entry)
        states = [leave]
        for step in reversed(back):
            states.append(step[states[-1]])
        states.reverse()
        return [(x, self.tables[r][s][x]) for r, s, x in zip(roles, states[:-1], states[1:], strict=True)]


def chain(matrices: list[list[int]], automaton: Automaton) -> list[tuple[int, int, int]]:
    """(entry, exit, messages before) of each stretch on the cheapest way through all of them to a legal end."""
    cost = np.full(4, NEVER)
    cost[START] = 0
    count = np.zeros(4, np.int64)
    back = []
    for flat in matrices:
        m = np.array(flat, np.int64).reshape(4, 4, 2)
        ways = [[(int(cost[s] + m[s, e, 0]), int(count[s] + m[s, e, 1]), s) for s in range(4)] for e in range(4)]
        picked = [min(w) for w in ways]
        back.append([p[2] for p in picked])
        cost, count = np.minimum([p[0] for p in picked], NEVER), np.array([p[1] for p in picked])
    end = min(range(4), key=lambda s: (int(cost[s]) + automaton.closing[s] * automaton.costs.insert, int(count[s]), s))
    states = [end]
    for step in reversed(back):
        states.append(step[states[-1]])
    states.reverse()
    out, messages = [], 0
    for flat, s, e in zip(matrices, states[:-1], states[1:], strict=True):
        out.append((s, e, messages))
        messages += flat[2 * (4 * s + e) + 1]
    return out


# ---------------------------------------------------------------------------------------------- rendering


@dataclass(frozen=True)
class Template:
    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    joint: str = "\n"  # between merged turns
    marks: tuple[str, ...] = ("<|im_start|>", "<|im_end|>")

    def text(self, text: str | None) -> str:
        """Marks inside a text are broken up, so they cannot end its message."""
        out = text or ""
        for mark in self.marks:
            out = out.replace(mark, mark[:2] + " " + mark[2:])
        return out

    def part(self, role: int, text: str | None, action: str, empty: tuple[int, ...], is_first: bool, closes_with: tuple[int, ...] | None) -> str:
        """What a turn adds to the rendered conversation; ``closes_with``: empty messages after the last turn."""
        out = "" if is_first else self.joint if action.endswith("merge") else self.closing
        if not action.endswith("merge"):
            out += "".join(self.opening.format(role=ROLES[e]) + self.closing for e in empty) + self.opening.format(role=ROLES[role])
        out += self.text(text)
        if closes_with is not None:
            out += self.closing + "".join(self.opening.format(role=ROLES[e]) + self.closing for e in closes_with)
        return out


# ---------------------------------------------------------------------------------------------- the operator


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Consecutive rows with equal first ``keys`` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4_096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def repair_conversations(turns: DataFrame, costs: Costs = Costs(), template: Template = Template(), stretch: int = STRETCH) -> DataFrame:
    """(conv_id, turn, role, action, new_role, message, inserted, cost, rendered): one row per row of ``turns``.

    Turns follow by number, those without one first; equal numbers by role and text, so repeated rows are turns of
    their own.  ``message`` numbers the messages after repair, ``inserted`` the empty ones put before the turn (and,
    after the last turn, behind it); ``rendered`` put together in this order is the conversation's text.  Each row
    without a conv_id is a conversation of its own.  A null text is empty.  Other columns are not read.
    """
    automaton = Automaton(costs)
    spot = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"), F.col("role").alias("c"), F.xxhash64("text").alias("d"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").withColumn("spot", spot)
    rows = rows.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / stretch), F.lit(-(1 << 62))))
    known, lone = rows.where("conv_id is not null"), rows.where("conv_id is null")
    kind = turns.schema["conv_id"].dataType.simpleString()
    arrow_kind = pa.int64() if kind in ("bigint", "long") else pa.int32() if kind == "int" else pa.string()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", arrow_kind), ("stretch", pa.int64()), ("matrix", pa.list_(pa.int64()))])
        yield from _batched(((*g[0][:2], automaton.matrix([automaton.role(r[2]) for r in g])) for g in _groups(batches, 2)), schema)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", arrow_kind), ("stretch", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("before", pa.int64()), ("last", pa.bool_())])

        def states() -> Iterator[tuple]:
            for g in _groups(batches, 1):
                for n, (row, found) in enumerate(zip(g, chain([r[2] for r in g], automaton), strict=True)):
                    yield *row[:2], *found, n == len(g) - 1

        yield from _batched(states(), schema)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("conv_id", arrow_kind), ("turn", pa.int64()), ("role", pa.string()), ("action", pa.string()), ("new_role", pa.string())]
        schema = pa.schema([*fields, ("message", pa.int64()), ("inserted", pa.int64()), ("cost", pa.int64()), ("rendered", pa.string())])

        def parts() -> Iterator[tuple]:
            for g in _groups(batches, 2):
                entry, leave, message, is_last = g[0][5:9]
                message -= 1
                for n, (row, (role, move)) in enumerate(zip(g, automaton.path([automaton.role(r[3]) for r in g], entry, leave), strict=True)):
                    cost, new, action, empty = move
                    message += new
                    ends = None
                    if is_last and n == len(g) - 1:
                        ends = min((p for e, p in automaton.fill[role].items() if e in ENDS), key=len) if automaton.closing[role] else ()
                        cost += len(ends) * costs.insert
                    text = template.part(role, row[4], action, empty, entry == START and n == 0, ends)
                    yield row[0], row[2], row[3], action, ROLES[role], message, len(empty) + len(ends or ()), cost, text

        yield from _batched(parts(), schema)

    order = ("conv_id", "stretch", "spot")
    # a stated number of partitions: roles and matrices are short but dear, and must not be put together by their size
    tasks = max(2 * turns.sparkSession.sparkContext.defaultParallelism, known.count() // TASK_TURNS + 1)
    heads = known.select("conv_id", "stretch", "role", "spot").repartition(tasks, "conv_id", "stretch").sortWithinPartitions(*order).select("conv_id", "stretch", "role")
    matrices = heads.mapInArrow(measure, f"conv_id {kind}, stretch long, matrix array<long>")
    chained = matrices.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "stretch")
    states = materialise(chained.mapInArrow(link, f"conv_id {kind}, stretch long, entry int, leave int, before long, last boolean"), "states")
    ready = known.join(states, ["conv_id", "stretch"]).repartition("conv_id", "stretch").sortWithinPartitions(*order)
    columns = ("conv_id", "stretch", "turn", "role", "text", "entry", "leave", "before", "last")
    out = f"conv_id {kind}, turn long, role string, action string, new_role string, message long, inserted long, cost long, rendered string"
    done = ready.select(*columns).mapInArrow(render, out)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row as a conversation: a key of its own keeps neighbours apart."""
        for batch in batches:
            n = batch.num_rows
            roles = [automaton.role(r) for r in batch.column(1).to_pylist()]
            ends = [chain([automaton.matrix([r])], automaton)[0] for r in roles]
            keys = pa.array(range(n), arrow_kind) if arrow_kind != pa.string() else pa.array([str(i) for i in range(n)])
            stacked = pa.RecordBatch.from_arrays(
                [keys, pa.array([0] * n, pa.int64()), batch.column(0), batch.column(1), batch.column(2), pa.array([e[0] for e in ends]), pa.array([e[1] for e in ends]), pa.array([e[2] for e in ends]), pa.array([True] * n)],
                names=list(columns),
            )
            for part in render(iter([stacked])):
                yield pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, arrow_kind), *part.columns[1:]], schema=part.schema)

    return done.unionByName(lone.select("turn", "role", "text").mapInArrow(alone, out))
