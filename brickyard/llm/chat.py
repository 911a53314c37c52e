"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant
turns in alternation, ending with the assistant. Dynamic programming over
that automaton chooses, for every turn, to keep it, relabel it, merge it into
the turn before (same role), or to put empty turns before it, at least total
cost; equal costs fall to the state first in ``STATES``. The repaired turns
are rendered piece by piece: each input row carries its part, and a
conversation's parts, in order, spell its whole sequence.

Every turn is a 4 x 4 matrix of (min, +), which composes in any grouping. So
conversations are sorted by range, and one that crosses tasks, however large,
is solved from the matrices of its stretches (two a task at most): these fix
the states in which the stretches begin and end, and each task then traces
its own rows.

Null conv_id: one conversation of its own. Turns sort by turn (null last),
equal ones by content; repeated rows are turns. A role is matched without
case or outer blanks; null and unknown roles must be relabelled, which costs
less. Null text is an empty text. Markers inside a text are broken up. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, written

STATES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# a wrong label costs more than an empty turn and a merge; NAME: giving an unknown role a name
MERGE, RELABEL, NAME, INSERT = 1, 5, 1, 3
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
FAR = 10**9


def _insertions(a: int, b: int) -> tuple[int, ...] | None:
    """Fewest empty turns that lead from state a to one after which b may come."""
    for n in range(3):
        for way in product((USER, ASSISTANT), repeat=n):
            at = a
            for s in (*way, b):
                if s not in NEXT[at]:
                    break
                at = s
            else:
                return way
    return None


def _steps() -> np.ndarray:
    """cost[role, from, to] of one turn."""
    cost = np.full((4, 4, 4), FAR, dtype=np.int64)
    for role, a, b in product(range(4), range(4), (SYSTEM, USER, ASSISTANT)):
        label = 0 if role == b else NAME if role == START else RELABEL
        ways = [MERGE] if a == b else []
        if (put := _insertions(a, b)) is not None:
            ways.append(INSERT * len(put))
        if ways:
            cost[role, a, b] = label + min(ways)
    return cost


STEP = _steps()
#: Empty turns that end a conversation in each state.
ENDING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
END = np.array([INSERT * len(ENDING[s]) for s in range(4)], dtype=np.int64)


def role_code(role: str | None) -> int:
    """Unknown roles are code 0."""
    r = (role or "").strip().lower()
    return STATES.index(r) if r in STATES[1:] else START


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def matrix_of(roles: list[int]) -> np.ndarray:
    m = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles:
        m = compose(m, STEP[r])
    return m


def trace(roles: list[int], entry: int, leave: int | None) -> list[int]:
    """States after each turn on the cheapest way from ``entry`` to ``leave``
    (None: to the cheapest end)."""
    cost = np.full(4, FAR, dtype=np.int64)
    cost[entry] = 0
    back = []
    for r in roles:
        way = cost[:, None] + STEP[r]
        back.append(way.argmin(axis=0))
        cost = np.minimum(way.min(axis=0), FAR)
    at = int((cost + END).argmin()) if leave is None else leave
    out = []
    for b in reversed(back):
        out.append(at)
        at = int(b[at])
    return out[::-1]


def _clean(text: str | None) -> str:
    return (text or "").replace("<|im_", "<| im_")


def render(roles: list[int], texts: list[str | None], states: list[int], entry: int, last: bool) -> Iterator[tuple[str, str, str, int, str]]:
    """(role, action, inserted, cost, rendered) per turn."""
    at = entry
    for i, (r, t, s) in enumerate(zip(roles, texts, states, strict=True)):
        label = 0 if r == s else NAME if r == START else RELABEL
        put = _insertions(at, s)
        merge = at == s and (put is None or MERGE <= INSERT * len(put))
        put = () if merge else put
        cost = label + (MERGE if merge else INSERT * len(put))
        piece = "\n" + _clean(t) if merge else (f"{CLOSE}\n" if at != START else "") + "".join(
            f"{OPEN}{STATES[p]}\n{CLOSE}\n" for p in put) + f"{OPEN}{STATES[s]}\n{_clean(t)}"
        action = "+".join(["relabel"] * bool(label) + ["merge"] * merge) or "keep"
        names = [STATES[p] for p in put]
        if last and i == len(roles) - 1:
            piece += f"{CLOSE}\n" + "".join(f"{OPEN}{STATES[p]}\n{CLOSE}\n" for p in ENDING[s])
            names += [f"{STATES[p]} at end" for p in ENDING[s]]
            cost += int(END[s])
        yield STATES[s], action, ",".join(names), cost, piece
        at = s


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pid, conv_id, turns, matrix) of the first and the last stretch of each range."""
    first = last = None

    def rows(*found):
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()),
             pa.array([f[3].ravel().tolist() for f in found], pa.list_(pa.int64())), pa.array([f[4] for f in found], pa.bool_())],
            names=["pid", "conv_id", "turns", "m", "alone"])

    pid = None
    for b in batches:
        for p, conv, role in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if p != pid:
                if last is not None:
                    yield rows(*([(pid, *first, False)] if first is not last else []), (pid, *last, first is last))
                pid, first, last = p, None, None
            if last is None or last[0] != conv:
                last = [conv, 0, np.where(np.eye(4, dtype=bool), 0, FAR)]
                first = first or last
            last[1] += 1
            last[2] = compose(last[2], STEP[role_code(role)])
    if last is not None:
        yield rows(*([(pid, *first, False)] if first is not last else []), (pid, *last, first is last))


def ends_of(found: list[tuple]) -> dict[tuple, tuple[int, int | None]]:
    """(pid, conv_id) -> (state at its begin, state at its end or None if the
    conversation ends there), for conversations that cross ranges. ``found``:
    (pid, conv_id, turns, matrix, alone) in order."""
    chains: list[list] = []
    for f in found:
        # a conversation goes on if it was the last of one range and is the first of the next
        if chains and chains[-1][-1][1] == f[1] and chains[-1][-1][0] != f[0]:
            chains[-1].append(f)
        else:
            chains.append([f])
    out = {}
    for chain in chains:
        if len(chain) == 1:
            continue
        costs = [np.where(np.arange(4) == START, 0, FAR)]
        for f in chain:
            costs.append(np.minimum((costs[-1][:, None] + np.array(f[3]).reshape(4, 4)).min(axis=0), FAR))
        at = int((costs[-1] + END).argmin())
        for i in range(len(chain) - 1, -1, -1):
            m = np.array(chain[i][3]).reshape(4, 4)
            before = int((costs[i] + m[:, at]).argmin())
            out[chain[i][0], chain[i][1]] = before, None if i == len(chain) - 1 else at
            at = before
    return out


RESULT = "conv_id long, turn long, role string, action string, inserted string, cost long, rendered string"


def repair(conversations: DataFrame) -> DataFrame:
    """One row per turn of ``conversations`` (conv_id, turn, role, text): its
    repaired role, the repairs, their cost, and its part of the rendering."""
    spark = conversations.sparkSession
    order = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.xxhash64("role", "text")]
    rows = (conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
            .repartitionByRange(parts(spark), *order).sortWithinPartitions(*order, "role", "text")
            .withColumn("pid", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()))
    rows = written(rows, "turns")
    by_range = rows.repartitionById(parts(spark), "pid").sortWithinPartitions("pid", "row")
    found = [tuple(r) for r in by_range.select("pid", "conv_id", "role").mapInArrow(
        _matrices, "pid int, conv_id long, turns long, m array<long>, alone boolean").collect()]  # two rows a range at most
    known = ends_of(sorted(found, key=lambda f: f[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        out = []

        def rows_of(key, held):
            pid, conv = key
            entry, leave = known.get(key, (START, None))
            roles, texts = [h[1] for h in held], [h[2] for h in held]
            for h, done in zip(held, render(roles, texts, trace(roles, entry, leave), entry, leave is None), strict=True):
                yield conv, h[0], *done

        def batch():
            cols = [pa.array([o[i] for o in out], pa.int64() if i in (0, 1, 5) else pa.string()) for i in range(7)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        now, held = None, []
        for b in batches:
            for pid, conv, turn, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (pid, conv) != now:
                    out.extend(rows_of(now, held) if held else ())
                    now, held = (pid, conv), []
                    if len(out) >= 2000:
                        yield batch()
                held.append((turn, role_code(role), text))
        out.extend(rows_of(now, held) if held else ())
        if out:
            yield batch()

    return by_range.select("pid", "conv_id", "turn", "role", "text").mapInArrow(run, RESULT)
