"""Chat formatting with minimum-cost repair of the turns' roles.

A legal conversation is a path through a small automaton: an optional system turn, then
user and assistant in turn. A dynamic program over its states finds the cheapest way to
make a conversation legal by merging a turn into the one before, giving it another role,
or putting empty turns before it; then the repaired turns are rendered.

Turns are range-sorted by conversation and turn, so a conversation may run over many
partitions, however long it is. The cost of a stretch of turns from each state to each is
a small matrix, and such matrices multiply. Each partition sends those of its first and
last conversation to the driver, which gets back to it with the costs on entry and the
state on exit; a partition then repairs its own stretch as if it had seen the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import settled

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
# What may follow the start and each role.
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    """Costs of a repair, and the roles that a conversation may end with."""

    merge: int = 1
    insert: int = 2
    relabel: int = 3
    ends: tuple[str, ...] = ("user", "assistant")


@dataclass(frozen=True)
class Template:
    """Text around a turn, and between the texts of merged turns; its marks are broken up in the texts."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    joint: str = "\n\n"
    mark: str = "<|"
    broken_mark: str = "< |"


def _between(state: int, to: int) -> tuple[int, ...] | None:
    """The fewest turns to put between a state and a turn of the role ``to``; None if there is no way."""
    paths = [(s,) for s in _NEXT[state]]
    for _ in _STATES:
        for path in paths:
            if path[-1] == to:
                return path[:-1]
        paths = [(*path, s) for path in paths for s in _NEXT[path[-1]]]
    return None


class Automaton:
    """Cheapest step for a turn's role (0 to 3, 0 for any other role) from each state to each."""

    def __init__(self, costs: Costs):
        self.cost = [[[_FAR] * 4 for _ in _STATES] for _ in _STATES]
        # The step: None to merge, else the empty turns to put before the turn.
        self.step: list[list[list[tuple[int, ...] | None]]] = [[[None] * 4 for _ in _STATES] for _ in _STATES]
        for role in _STATES:
            for state in _STATES:
                for to in (SYSTEM, USER, ASSISTANT):
                    extra = 0 if role == to else costs.relabel
                    if state == to:
                        self.cost[role][state][to] = costs.merge + extra
                    path = _between(state, to)
                    if path is not None and len(path) * costs.insert + extra < self.cost[role][state][to]:
                        self.cost[role][state][to] = len(path) * costs.insert + extra
                        self.step[role][state][to] = path
        ends = [1 + ROLES.index(r) for r in costs.ends]
        after = {s: min(((*(_between(s, e) or ()), e) for e in ends if s != e and _between(s, e) is not None), key=len, default=None) for s in _STATES}
        #: Empty turns after the last turn.
        self.closing = {s: () if s in ends else after[s] for s in _STATES}
        self.end_cost = [_FAR if s == START or self.closing[s] is None else len(self.closing[s]) * costs.insert for s in _STATES]

    def forward(self, entry: list[int], roles: list[int]) -> tuple[list[int], list[tuple[int, ...]]]:
        """Costs after the turns, from the costs before them; and by turn the best earlier state of each state."""
        costs, back = entry, []
        for role in roles:
            table = self.cost[role]
            best = [min((costs[p] + table[p][q], p) for p in _STATES) for q in _STATES]
            costs = [min(c, _FAR) for c, _ in best]
            back.append(tuple(p for _, p in best))
        return costs, back

    def matrix(self, roles: list[int]) -> list[list[int]]:
        """Costs from each state to each over the turns."""
        return [self.forward([0 if s == p else _FAR for s in _STATES], roles)[0] for p in _STATES]

    def walk(self, back: list[tuple[int, ...]], exit_: int) -> list[int]:
        """The states before, between and after the turns on the best way to ``exit_``."""
        states = [exit_]
        for choice in reversed(back):
            states.append(choice[states[-1]])
        return states[::-1]

    def turns(self, states: list[int], roles: list[int]) -> int:
        """The repaired turns on a way; merged ones begin none."""
        steps = (self.step[r][p][q] for r, p, q in zip(roles, states, states[1:], strict=False))
        return sum(0 if s is None else len(s) + 1 for s in steps)

    def last(self, costs: list[int]) -> int:
        """The state to end in."""
        return min(_STATES, key=lambda s: (costs[s] + self.end_cost[s], s))


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    return 1 + ROLES.index(name) if name in ROLES else 0


_ENTRY = [0, _FAR, _FAR, _FAR]


@dataclass
class _Stretch:
    """What a partition's stretch of a conversation that runs on elsewhere has to know."""

    entry: list[int] = field(default_factory=lambda: list(_ENTRY))
    exit: int | None = None  # None: the conversation ends here
    offset: int = 0


def _stretches(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """The rows of each conversation of a partition."""
    rows = (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns), strict=True))
    return groupby(rows, key=lambda row: row[0])


_ENDS = pa.schema([("part", pa.int32()), ("nth", pa.int64()), ("of", pa.int64()), ("conversation", pa.string()), ("costs", pa.list_(pa.int64()))])


def _ends(costs: Costs):
    """The first and the last stretch of a partition, with their matrices."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, found, n = Automaton(costs), [], 0
        for name, rows in _stretches(parts):
            # Only the first and the last are needed; which one is last shows at the end.
            found = [*found[:1], (n, name, [role_number(r[1]) for r in rows])]
            n += 1
        rows = [
            (TaskContext.get().partitionId(), k, n, None if name is None else str(name), sum(automaton.matrix(roles), []))
            for k, name, roles in found
        ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENDS, strict=True)], schema=_ENDS)

    return run


_WAYS = pa.schema([("part", pa.int32()), ("nth", pa.int64()), ("entries", pa.list_(pa.int64())), ("turns", pa.list_(pa.int64()))])


def _ways(costs: Costs, known: dict[tuple[int, int], _Stretch]):
    """For each stretch that runs on elsewhere: the entry state and the turns that belong to each exit state."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, task, out = Automaton(costs), TaskContext.get().partitionId(), []
        for k, (_, rows) in enumerate(_stretches(parts)):
            if (task, k) in known:
                roles = [role_number(r[1]) for r in rows]
                _, back = automaton.forward(known[task, k].entry, roles)
                ways = [automaton.walk(back, s) for s in _STATES]
                out.append((task, k, [w[0] for w in ways], [automaton.turns(w, roles) for w in ways]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _WAYS, strict=True)], schema=_WAYS)

    return run


def _product(costs: list[int], matrix: list[int]) -> list[int]:
    return [min(_FAR, *(costs[p] + matrix[4 * p + q] for p in _STATES)) for q in _STATES]


def _plan(turns: DataFrame, costs: Costs) -> dict[tuple[int, int], _Stretch]:
    """Entry costs, exit state and turns so far of the stretches that are not whole conversations."""
    names = turns.select(turns.columns[0], "role")
    ends = names.mapInArrow(_ends(costs), "part int, nth bigint, of bigint, conversation string, costs array<bigint>").collect()
    chains: list[list] = []
    for row in sorted(ends, key=lambda r: (r["part"], r["nth"])):
        # It goes on if it is the first of its partition, and the one before was the last of an earlier one.
        before = chains[-1][-1] if chains else None
        goes_on = before is not None and row["nth"] == 0 and before["part"] < row["part"] and before["conversation"] == row["conversation"]
        if goes_on:
            chains[-1].append(row)
        else:
            chains.append([row])
    chains = [c for c in chains if len(c) > 1]
    if not chains:
        return {}
    known: dict[tuple[int, int], _Stretch] = {}
    last: list[int] = []
    automaton = Automaton(costs)
    for chain in chains:
        entry = _ENTRY
        for row in chain:
            known[row["part"], row["nth"]] = _Stretch(entry)
            entry = _product(entry, row["costs"])
        last.append(automaton.last(entry))
    ways = {
        (r["part"], r["nth"]): r
        for r in names.mapInArrow(_ways(costs, known), "part int, nth bigint, entries array<bigint>, turns array<bigint>").collect()
    }
    for chain, state in zip(chains, last, strict=True):
        counts = []
        for row in reversed(chain):
            at = row["part"], row["nth"]
            known[at].exit = None if row is chain[-1] else state
            counts.append(ways[at]["turns"][state])
            state = ways[at]["entries"][state]
        total = 0
        for row, n in zip(chain, reversed(counts), strict=True):
            known[row["part"], row["nth"]].offset = total
            total += n
    return known


def _repair(costs: Costs, template: Template, known: dict[tuple[int, int], _Stretch], names: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, task = Automaton(costs), TaskContext.get().partitionId()
        first = None
        held: list[tuple] = []
        for k, (_, rows) in enumerate(_stretches(_remember(parts, kinds := []))):
            first = first or kinds[0]
            held += _repaired(automaton, template, known.get((task, k), _Stretch()), list(rows))
            if len(held) >= 5000:
                yield _repaired_batch(first, names, held)
                held = []
        if held:
            yield _repaired_batch(first, names, held)

    return run


def _remember(parts: Iterator[pa.RecordBatch], kinds: list) -> Iterator[pa.RecordBatch]:
    for part in parts:
        kinds[:] = [[f.type for f in part.schema]]
        yield part


def _repaired_batch(kinds: list, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    types = [kinds[0], kinds[2], pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _repaired(automaton: Automaton, template: Template, stretch: _Stretch, rows: list[tuple]) -> Iterator[tuple]:
    roles = [role_number(r[1]) for r in rows]
    costs, back = automaton.forward(stretch.entry, roles)
    exit_ = automaton.last(costs) if stretch.exit is None else stretch.exit
    states = automaton.walk(back, exit_)
    position = stretch.offset
    for i, (conversation, _, turn, text) in enumerate(rows):
        before, after, role = states[i], states[i + 1], roles[i]
        step = automaton.step[role][before][after]
        clean = (text or "").replace(template.mark, template.broken_mark)
        empty = () if step is None else step
        if step is None:
            fragment = template.joint + clean
        else:
            position += len(step) + 1
            opened = "".join(template.opening.format(role=ROLES[s - 1]) + template.closing for s in step)
            fragment = (template.closing if before != START else "") + opened + template.opening.format(role=ROLES[after - 1]) + clean
        if i == len(rows) - 1 and stretch.exit is None:
            closing = automaton.closing[exit_]
            empty = (*empty, *closing)
            fragment += template.closing + "".join(template.opening.format(role=ROLES[s - 1]) + template.closing for s in closing)
        action = "merge" if step is None else "keep"
        if role != after:
            action = "merge, relabel" if step is None else "relabel"
        yield conversation, turn, position, ROLES[after - 1], action, len(empty), fragment


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    costs: Costs | None = None,
    template: Template | None = None,
) -> DataFrame:
    """``conversation, turn, position, out_role, action, empty_turns, fragment`` for each turn.

    ``position`` numbers the repaired turns from 1; a merged turn has that of the turn it
    joins. ``empty_turns`` counts those put before the turn, and after it if it is the
    last. The fragments of a conversation, one after the other in the order of the turns,
    are the rendered conversation; the order is by turn, then by a hash of role and text.

    Of repairs of equal cost, that is taken which comes from the state that stands first
    among start, system, user and assistant, looking back from the end. Roles are taken
    without regard to case; an unknown or null one has to be relabelled. A null text is
    an empty one. Turns without a number come first; turns without a conversation make
    one together. Repeated rows are turns of their own. An empty table gives no row;
    other columns are not looked at.
    """
    costs, template = costs or Costs(), template or Template()
    order = ["conversation", "turn", "tie"]
    ordered = settled(
        turns.select(
            F.col(conversation).alias("conversation"),
            F.col(role).alias("role"),
            F.col(turn).alias("turn"),
            F.col(text).alias("text"),
            F.xxhash64(role, text).alias("tie"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("tie")
    )
    kinds = {f.name: f.dataType.simpleString() for f in ordered.schema.fields}
    names = [conversation, turn, "position", "out_role", "action", "empty_turns", "fragment"]
    schema = (
        f"`{conversation}` {kinds['conversation']}, `{turn}` {kinds['turn']}, "
        "position bigint, out_role string, action string, empty_turns bigint, fragment string"
    )
    return ordered.mapInArrow(_repair(costs, template, _plan(ordered, costs), names), schema)
