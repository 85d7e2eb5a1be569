"""Operator 8: minimum-cost repair of chat roles, and rendering of the repaired turns.

A legal conversation is an optional system turn, then user and assistant in turns. Every
input turn is kept, merged into the turn before it, relabelled (or both), possibly after
empty turns that fill a gap; each has a price and dynamic programming over the automaton
(start, after system, after user, after assistant) finds the cheapest repair. Ties: the
option listed first in ``options``, then the smaller state.

Turns are sorted by Spark into blocks of at most ``BLOCK`` turns that hold many
conversations; one that crosses blocks is summarised in each by its 4 x 4 matrix of cheapest
costs from state to state, the matrices of a conversation are chained (one small row a block),
and each block then repairs its part between the states found. No conversation is gathered.
The rendering is a fragment for every input turn; read in order they are the whole text.

Results: one row per turn with a conversation id, in the order of (turn, role, text); ``seq``
numbers it. Null turns sort first; a null or unknown role may become any role at a small
price; null text is empty. Repeated turns are separate turns. Empty table: no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BLOCK, BLOCK_BYTES = 4096, 8 << 20
ROLES = ["system", "user", "assistant"]
ALIASES = {"system": 0, "developer": 0, "user": 1, "human": 1, "prompter": 1, "assistant": 2, "bot": 2, "gpt": 2, "model": 2, "ai": 2}
START = 0  # states: 0 start, 1 + role of the turn before
MERGE, INSERT, RELABEL, GUESS = 1, 2, 3, 1
INF = 1 << 40
OPEN, CLOSE = "<|im_start|>{role}\n", "<|im_end|>\n"


def follows(state: int) -> list[int]:
    """Roles that may open the next turn."""
    return [0, 1] if state == START else [1] if state in (1, 3) else [2]


@functools.cache
def options(state: int, role: int) -> list[tuple[int, int, int, tuple[int, ...], bool]]:
    """(cost, next state, new role, roles inserted before, merged) for an input turn; role 3: unknown."""
    out = []
    for new in range(3):
        change = 0 if new == role else GUESS if role == 3 else RELABEL
        if state == 1 + new:
            out.append((change + MERGE, state, new, (), True))
        if new in follows(state):
            out.append((change, 1 + new, new, (), False))
        for gap in follows(state):
            if new in follows(1 + gap):
                out.append((change + INSERT, 1 + new, new, (gap,), False))
    return sorted(out, key=lambda o: (o[0], o[4], len(o[3]), o[1]))


def step(cost: list[int], role: int) -> tuple[list[int], list[tuple[int, int] | None]]:
    """Costs of the states after one more turn, and for each (state before, option)."""
    new, back = [INF] * 4, [None] * 4
    for s in range(4):
        if cost[s] < INF:
            for i, o in enumerate(options(s, role)):
                if cost[s] + o[0] < new[o[1]]:
                    new[o[1]], back[o[1]] = cost[s] + o[0], (s, i)
    return new, back


def repair(roles: list[int], entry: int = START, leave: int | None = None) -> tuple[int, list[tuple[int, int, int, tuple[int, ...], bool]]]:
    """The cheapest options for ``roles`` from state ``entry`` to state ``leave`` (any if None)."""
    cost = [INF] * 4
    cost[entry] = 0
    trail = []
    for r in roles:
        cost, back = step(cost, r)
        trail.append(back)
    at = leave if leave is not None else min(range(4), key=cost.__getitem__)
    total, out = cost[at], []
    for r, back in zip(reversed(roles), reversed(trail), strict=True):
        s, i = back[at]
        out.append(options(s, r)[i])
        at = s
    return total, out[::-1]


def matrix(roles: list[int]) -> list[int]:
    """Cheapest costs from each state to each, row by row."""
    out = []
    for s in range(4):
        cost = [INF] * 4
        cost[s] = 0
        for r in roles:
            cost, _ = step(cost, r)
        out += cost
    return out


def _code(role: str | None) -> int:
    return ALIASES.get((role or "").strip().lower(), 3)


def _groups(conv: list[int]) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    a = np.asarray(conv)
    cut = np.flatnonzero(np.diff(a)) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(conv)], strict=True))


def _matrices(t: pa.Table) -> pa.Table:
    """The first and last conversation of a block: the only ones that others may share."""
    t = t.sort_by("i")
    conv, roles = t["conv_id"].to_pylist(), [_code(r) for r in t["role"].to_pylist()]
    groups = _groups(conv)
    ends = [groups[0]] if len(groups) == 1 else [groups[0], groups[-1]]
    n = len(ends)
    return pa.table({"conv_id": pa.array([conv[a] for a, _ in ends], pa.int64()), "block": pa.array([t["block"][0].as_py()] * n, pa.int64()),
                     "n": pa.array([b - a for a, b in ends], pa.int64()), "m": pa.array([matrix(roles[a:b]) for a, b in ends], pa.list_(pa.int64()))})


def _chain(t: pa.Table) -> pa.Table:
    """For the parts of one conversation: states at entry and exit, turns before, and if it is the last."""
    t = t.sort_by("block")
    ms = [np.array(m, np.int64).reshape(4, 4) for m in t["m"].to_pylist()]
    cost = np.full(4, INF, np.int64)
    cost[START] = 0
    from_ = []
    for m in ms:
        ways = cost[:, None] + m
        from_.append(ways.argmin(0))
        cost = np.minimum(ways.min(0), INF)
    at, entry, leave = int(cost.argmin()), [], []
    for f in reversed(from_):
        leave.append(at)
        at = int(f[at])
        entry.append(at)
    n = np.array(t["n"].to_pylist(), np.int64)
    k = len(n)
    return pa.table({"conv_id": t["conv_id"], "block": t["block"], "entry": pa.array(entry[::-1], pa.int32()), "leave": pa.array(leave[::-1], pa.int32()),
                     "before": pa.array(np.cumsum(n) - n), "last": pa.array([i == k - 1 for i in range(k)])})


RESULT = "conv_id long, turn long, seq long, role string, new_role string, action string, inserted string, cost int, rendered string"


def _clean(text: str | None) -> str:
    """Control marks inside a text are broken up, so that they cannot open or close a turn."""
    return (text or "").replace("<|", "< |")


def _repair_block(t: pa.Table, ends: pa.Table) -> pa.Table:
    t = t.sort_by("i")
    known = {r["conv_id"]: r for r in ends.to_pylist()}
    conv, role, text = t["conv_id"].to_pylist(), t["role"].to_pylist(), t["text"].to_pylist()
    out = {k: [] for k in ("seq", "new_role", "action", "inserted", "cost", "rendered")}
    for a, b in _groups(conv) if conv else []:
        part = known.get(conv[a], {"entry": START, "leave": None, "before": 0, "last": True})
        _, ops = repair([_code(r) for r in role[a:b]], part["entry"], part["leave"])
        state = part["entry"]
        for j, (cost, nxt, new, gaps, merged) in enumerate(ops):
            shown = "" if merged or state == START else CLOSE
            for g in gaps:
                shown += OPEN.format(role=ROLES[g]) + CLOSE
            shown += ("\n" if merged else OPEN.format(role=ROLES[new])) + _clean(text[a + j])
            if part["last"] and a + j == b - 1:
                shown += CLOSE
            same = _code(role[a + j]) == new
            out["seq"].append(part["before"] + j)
            out["new_role"].append(ROLES[new])
            out["action"].append(("merge" if merged else "keep") if same else ("relabel_merge" if merged else "relabel"))
            out["inserted"].append(",".join(ROLES[g] for g in gaps))
            out["cost"].append(cost)
            out["rendered"].append(shown)
            state = nxt
    return pa.table({"conv_id": t["conv_id"], "turn": t["turn"], "seq": pa.array(out["seq"], pa.int64()), "role": t["role"],
                     "new_role": pa.array(out["new_role"], pa.string()), "action": pa.array(out["action"], pa.string()),
                     "inserted": pa.array(out["inserted"], pa.string()), "cost": pa.array(out["cost"], pa.int32()), "rendered": pa.array(out["rendered"], pa.string())})


def format_chats(turns: DataFrame, block_turns: int = BLOCK) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> one row per turn: ``conv_id, turn, seq, role, new_role,
    action, inserted, cost, rendered``."""
    spark = turns.sparkSession
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).filter("conv_id IS NOT NULL")
    order = ["conv_id", "turn", "role", "text"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, size, i = TaskContext.get().partitionId() << 32, 0, 0, 0
        for b in batches:
            ids = []
            for w in b.column("text").to_pylist():
                w = len(w or "")
                if n and (n == block_turns or size + w > BLOCK_BYTES):
                    block, n, size = block + 1, 0, 0
                ids.append(block)
                n, size = n + 1, size + w
            yield pa.record_batch([*b.columns, pa.array(ids, pa.int64()), pa.array(np.arange(i, i + b.num_rows))], names=[*b.schema.names, "block", "i"])
            i += b.num_rows
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "conv_id long, turn long, role string, text string, block long, i long"
    rows = C.cut(t.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(number, schema), "turns")
    mats = rows.select("conv_id", "role", "block", "i").groupBy("block").applyInArrow(_matrices, "conv_id long, block long, n long, m array<long>")
    ends = mats.groupBy("conv_id").applyInArrow(_chain, "conv_id long, block long, entry int, leave int, before long, last boolean")
    return rows.groupBy("block").cogroup(ends.groupBy("block")).applyInArrow(_repair_block, RESULT)
