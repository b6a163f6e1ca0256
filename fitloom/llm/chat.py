"""Minimum-cost role repair of conversations over a legal-turn automaton.

States say what came last: nothing, a system turn, a user turn, an assistant turn.  A conversation
may start with one system turn; then user and assistant take turns, the user first; it must end with
the assistant.  A turn is kept, relabelled, or merged into the turn before it of the same role; empty
turns may be put in before it and at the end.  Costs are below.  Among cheapest repairs one is chosen
from the last turn back, so that it doesn't depend on how a conversation is cut: the last state with the
cheaper end (of equal ones the assistant's, the user's, the system's); then at each turn the cheapest
move that a cheapest way allows, of equal ones keep before merge before relabel, then fewer empty
turns, then the earlier state before it, then the earlier role, in the order of ROLES.

A conversation may hold any share of all turns: turns are sorted and cut into segments of bounded
size; segments of one conversation in one partition make a run.  A segment's effect is a matrix of
least costs between states (a (min, +) product).  Products of runs give each run the least cost of
every state before it; given these, a segment maps each state after it to the chosen state before it,
and these maps, composed from the end, give every segment its last state.  One task sees the segments of
one partition, or one row for each partition that a conversation spans; never a whole conversation.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, schema, written

ROLES = ["system", "user", "assistant"]
#: States: nothing yet, then one for each role.
FRESH = 0
#: From state to the roles that may come next.
LEGAL = {0: (0, 1), 1: (1,), 2: (2,), 3: (1,)}
#: Costs: relabel a turn, merge it into the one before, put in an empty turn, and forget that a role is unknown.
RELABEL, MERGE, INSERT, UNKNOWN = 3, 1, 2, 3
#: Turns and characters of a segment; turns that share a number in the result's column segment.
SEGMENT, SEGMENT_BYTES, PAGE = 512, 1 << 20, 512
_BIG = 1 << 40
_TURN = {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"}
END = "<|end|>\n"


def _steps() -> dict[tuple[int, int], tuple[int, tuple[int, ...]]]:
    """(state, state): cheapest run of empty turns between them, as (number, roles)."""
    out = {}
    for s in range(4):
        seen, todo = {s: ()}, [s]
        for x in todo:
            for r in LEGAL[x]:
                if r + 1 not in seen:
                    seen[r + 1] = (*seen[x], r)
                    todo.append(r + 1)
        out |= {(s, t): (len(p), p) for t, p in seen.items()}
    return out


FILL = _steps()


def moves(role: int | None) -> list[tuple[int, int, int, str, tuple[int, ...], int]]:
    """(cost, from, to, action, empty turns, role) of one turn; role is None where it is unknown."""
    out = []
    for s in range(4):
        for r in range(3):
            change = 0 if r == role else UNKNOWN if role is None else RELABEL
            word = "keep" if r == role else "relabel"
            if s == r + 1:
                out.append((MERGE + change, s, s, "merge", (), r))
            for t in range(4):
                if (s, t) in FILL and r in LEGAL[t]:
                    n, fill = FILL[s, t]
                    out.append((change + INSERT * n, s, r + 1, word, fill, r))
    return sorted(out, key=lambda m: (m[0], CHOICES.index(m[3]), len(m[4]), m[1], m[5]))


CHOICES = ["keep", "merge", "relabel"]
MOVES = {r: moves(r) for r in (0, 1, 2, None)}


#: (from, to, cost) of the cheapest move between each two states.
_BEST = {r: [(s, t, min(m[0] for m in ms if m[1:3] == (s, t))) for s, t in {m[1:3] for m in ms}] for r, ms in MOVES.items()}


def transfer(roles: list[int | None], entry: list[int]) -> list[list[int]]:
    """Least cost of each state before the first turn and after each turn, given the costs of the states before."""
    table = [entry]
    for role in roles:
        before, now = table[-1], [_BIG] * 4
        for s, t, cost in _BEST[role]:
            if before[s] + cost < now[t]:
                now[t] = before[s] + cost
        table.append(now)
    return table


def matrix(roles: list[int | None]) -> list[int]:
    """Least costs from each state (rows) to each state."""
    return [c for s in range(4) for c in transfer(roles, [0 if x == s else _BIG for x in range(4)])[-1]]


START = [0, _BIG, _BIG, _BIG]
_SAME = [0 if s == t else _BIG for s in range(4) for t in range(4)]


def after(costs: list[int], m: list[int]) -> list[int]:
    """Least costs of the states after a matrix, given those before."""
    return [min(_BIG, *(costs[s] + m[4 * s + t] for s in range(4))) for t in range(4)]


def product(a: list[int], b: list[int]) -> list[int]:
    return [c for s in range(4) for c in after(a[4 * s : 4 * s + 4], b)]


def last_state(costs: list[int]) -> int:
    """The chosen state after the last turn."""
    return min((t for t in range(4) if (t, 3) in FILL), key=lambda t: (costs[t] + INSERT * FILL[t, 3][0], -t))


def _move(role: int | None, before: list[int], state: int, cost: int):
    return next(m for m in MOVES[role] if m[2] == state and before[m[1]] < _BIG and before[m[1]] + m[0] == cost)


def back(roles: list[int | None], entry: list[int]) -> list[int]:
    """For each state after a segment the chosen state before it, given the least costs before; -1 where none leads there."""
    table = transfer(roles, entry)
    states = [t if table[-1][t] < _BIG else -1 for t in range(4)]
    for k in range(len(roles) - 1, -1, -1):
        prior = {t: _move(roles[k], table[k], t, table[k + 1][t])[1] for t in set(states) if t >= 0}
        states = [prior.get(t, -1) for t in states]
    return states


def repair(roles: list[int | None], entry: list[int], leave: int) -> list[tuple[str, tuple[int, ...], int, int]]:
    """Action, empty turns before, role and cost of each turn of a segment, given the least costs before it and the state after."""
    table = transfer(roles, entry)
    out, state = [], leave
    for k in range(len(roles) - 1, -1, -1):
        cost, state, _, action, fill, r = _move(roles[k], table[k], state, table[k + 1][state])
        out.append((action, fill, r, cost))
    return out[::-1]


def role_of(name: str | None) -> int | None:
    name = (name or "").strip().lower()
    return ROLES.index(name) if name in ROLES else None


def render(text: str, action: str, fill: tuple[int, ...], role: int, opens: bool) -> str:
    """A turn's piece of the rendered conversation; pieces in order make the whole."""
    if action == "merge":
        return "\n" + text
    before = "" if opens else END
    return before + "".join(_TURN[ROLES[r]] + END for r in fill) + _TURN[ROLES[role]] + text


def repaired(conversations: DataFrame) -> DataFrame:
    """One row a turn: conv_id, segment (place // PAGE), place (number of the turn in its conversation, from 0),
    turn, action, role, inserted (roles of empty turns before it), closing (roles of empty turns after the
    last turn), cost (of the turn's change, its empty turns and the closing ones) and rendered, whose pieces in
    order of place make the rendered conversation.

    Turns of a conversation are ordered by turn, role and a hash of the text, nulls first; rows that tie in
    all are alike, so their order doesn't matter.  Null texts are empty; null and unknown roles are open
    and cost UNKNOWN.  A null conv_id is a conversation of its own.  Other columns don't matter.  Results
    don't depend on partitions or SEGMENT.
    """
    segments = written(_segments(conversations), "turns")
    alone = segments.where("alone").select("conv_id", "turns", "roles", "texts", F.lit(0).cast("long").alias("first"), F.array(*map(F.lit, START)).cast("array<long>").alias("entry"), F.lit(-1).alias("leave"), F.lit(True).alias("last"))
    return _fixed(alone).union(_fixed(_settled(segments.where("not alone"))))


def _segments(conversations: DataFrame) -> DataFrame:
    """Segments in order: conv_id, run (the same for the segments of a conversation in one partition), segment,
    alone (the conversation has no other), ends (last of its run), costs, before (product of the run's costs before
    it), first (turns of the run before it), and its turns.

    Only runs at a partition's edges can go on elsewhere, and only conversations of other runs are alone."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.repartitionByRange("conv_id", "turn", "role", F.xxhash64("text")).sortWithinPartitions("conv_id", "turn", "role", F.xxhash64("text"), "text")
    long, longs, strings = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())
    kinds = {"conv_id": long, "run": long, "segment": long, "alone": pa.bool_(), "ends": pa.bool_(), "costs": longs, "before": longs, "first": long, "turns": longs, "roles": strings, "texts": strings}

    def pack(batches):
        part = TaskContext.get().partitionId() << 32
        k, run, before, first, held, size = 0, 0, _SAME, 0, None, 0

        def close(following: bool, final: bool = False):
            """The held segment; `following` says that its conversation goes on in this partition."""
            nonlocal k, run, before, first
            conv, turns, roles, texts = held
            begins = k == run
            alone = begins and not following and run > 0 and not final
            costs = None if alone else matrix([role_of(r) for r in roles])
            row = {"conv_id": conv, "run": part | run, "segment": part | k, "alone": alone, "ends": not following, "costs": costs, "before": None if alone else before, "first": first, "turns": turns, "roles": roles, "texts": texts}
            k += 1
            if following:
                before, first = product(before, costs), first + len(turns)
            else:
                run, before, first = k, _SAME, 0
            return row

        out, weight = [], 0
        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
                if held and (held[0] != conv or len(held[1]) >= SEGMENT or size >= SEGMENT_BYTES):
                    out.append(close(held[0] == conv))
                    weight += size + 200
                    held = None
                    if weight >= 4 << 20:
                        yield _batch(kinds, out)
                        out, weight = [], 0
                if not held:
                    held, size = (conv, [], [], []), 0
                for to, x in zip(held[1:], (turn, role, text), strict=True):
                    to.append(x)
                size += len(text or "")
        if held:
            out.append(close(False, True))
        if out:
            yield _batch(kinds, out)

    return map_texts(rows, pack, schema(None, conv_id="long", run="long", segment="long", alone="boolean", ends="boolean", costs="array<long>", before="array<long>", first="long", turns="array<long>", roles="array<string>", texts="array<string>"))


def _batch(kinds: dict[str, pa.DataType], rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], names=list(kinds))


def _settled(segments: DataFrame) -> DataFrame:
    """Segments with the least costs of the states before them, their place, and the state after them."""
    long, longs, ints = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())

    def enter(group):
        """Of the runs of one conversation, in order, the least costs before each, and the turns before it."""
        rows = sorted(group.to_pylist(), key=lambda r: r["run"])
        costs, at, out = START, 0, []
        for r in rows:
            out.append({"run": r["run"], "entry": costs, "at": at, "last": r is rows[-1]})
            costs, at = after(costs, product(r["before"], r["costs"])), at + r["n"]
        out[-1]["leave"] = last_state(costs)
        return pa.Table.from_batches([_batch({"run": long, "entry": longs, "at": long, "last": pa.bool_(), "leave": pa.int32()}, [{"leave": -1} | r for r in out])])

    ends = segments.where("ends").select("conv_id", "run", "before", "costs", (F.col("first") + F.size("turns")).alias("n"))
    runs = written(ends.groupBy("conv_id").applyInArrow(enter, schema(None, run="long", entry="array<long>", at="long", last="boolean", leave="int")), "runs")

    def maps(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["map"] = back([role_of(x) for x in r["roles"]], after(r["entry"], r["before"]))
            yield _batch({"run": long, "segment": long, "map": ints}, rows)

    def compose(group):
        """Of the segments of one run: the map from the state after the run to that after each, and to that before the run."""
        rows, now = sorted(group.to_pylist(), key=lambda r: -r["segment"]), [0, 1, 2, 3]
        for r in rows:
            r["leave_by"], now = now, [-1 if t < 0 else r["map"][t] for t in now]
            r["whole"] = None
        rows[-1]["whole"] = now
        return pa.Table.from_batches([_batch({"run": long, "segment": long, "leave_by": ints, "whole": ints}, rows)])

    mapped = map_texts(segments.select("run", "segment", "roles", "before").join(runs.select("run", "entry"), "run"), maps, _LINKS.format("map"))
    composed = written(mapped.groupBy("run").applyInArrow(compose, _LINKS.format("leave_by") + ", whole array<int>"), "maps")

    def leave(group):
        """The state after each run of one conversation, from its last run back."""
        rows = sorted(group.to_pylist(), key=lambda r: -r["run"])
        state = rows[0]["leave"]
        for r in rows:
            r["state"], state = state, r["whole"][state]
        return pa.Table.from_batches([_batch({"run": long, "state": pa.int32()}, rows)])

    whole = ends.select("conv_id", "run").join(composed.where("whole is not null").select("run", "whole"), "run").join(runs.select("run", "leave"), "run")
    left = whole.groupBy("conv_id").applyInArrow(leave, schema(None, run="long", state="int"))
    known = composed.select("run", "segment", "leave_by").join(left, "run").join(runs.select("run", "entry", "at", "last"), "run")
    known = known.select("segment", "entry", "at", "last", F.col("leave_by")[F.col("state")].alias("leave"))
    return map_texts(segments.join(known, "segment"), _entered, _WORK)


_LINKS = "run long, segment long, {0} array<int>"
_WORK = "conv_id long, turns array<long>, roles array<string>, texts array<string>, first long, entry array<long>, leave int, last boolean"


def _entered(batches):
    long, longs, strings = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())
    kinds = {"conv_id": long, "turns": longs, "roles": strings, "texts": strings, "first": long, "entry": longs, "leave": pa.int32(), "last": pa.bool_()}
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            r["entry"], r["first"], r["last"] = after(r["entry"], r["before"]), r["at"] + r["first"], r["last"] and r["ends"]
        yield _batch(kinds, rows)


def _fixed(segments: DataFrame) -> DataFrame:
    """A row for each turn of segments whose bounds are known; leave -1 stands for the chosen last state."""
    s, long, lists = pa.string(), pa.int64(), pa.list_(pa.string())
    kinds = {"conv_id": long, "segment": long, "place": long, "turn": long, "action": s, "role": s, "inserted": lists, "closing": lists, "cost": long, "rendered": s}

    def fix(batches):
        for batch in batches:
            rows, weight = [], 0
            for seg in batch.to_pylist():
                roles, state = [role_of(r) for r in seg["roles"]], seg["leave"]
                if state < 0:
                    state = last_state(transfer(roles, seg["entry"])[-1])
                done = repair(roles, seg["entry"], state)
                for k, ((action, fill, r, cost), turn, text) in enumerate(zip(done, seg["turns"], seg["texts"], strict=True)):
                    place, piece, end = seg["first"] + k, render(text or "", action, fill, r, seg["first"] + k == 0), ()
                    if seg["last"] and k == len(done) - 1:
                        end = FILL[state, 3][1]
                        piece += END + "".join(_TURN[ROLES[x]] + END for x in end)
                    rows.append({"conv_id": seg["conv_id"], "segment": place // PAGE, "place": place, "turn": turn, "action": action, "role": ROLES[r], "inserted": [ROLES[x] for x in fill], "closing": [ROLES[x] for x in end], "cost": cost + INSERT * len(end), "rendered": piece})
                    weight += len(piece) + 100
                if weight >= 4 << 20:
                    yield _batch(kinds, rows)
                    rows, weight = [], 0
            yield _batch(kinds, rows)

    out = "conv_id long, segment long, place long, turn long, action string, role string, inserted array<string>, closing array<string>, cost long, rendered string"
    return map_texts(segments.select("conv_id", "turns", "roles", "texts", "first", "entry", "leave", "last"), fix, out)
