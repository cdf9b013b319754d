"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, with an assistant turn at
the end. A turn can keep its role, be relabelled, merge into a turn of the same role before it, or have an
empty turn inserted before it. Dynamic programming over the automaton's states finds the cheapest repair.

Long conversations are cut into segments of turn numbers, and these into pieces of as many rows. Each piece
becomes a table of least costs from state to state; the tables of a conversation are combined in order, which
fixes the states where pieces meet; then each piece is repaired between its two states by itself. Python sees
the codes of roles only, many pieces at once; texts stay in Spark's own columns.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.store import stored

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
RELABEL, MERGE, INSERT = 2, 1, 3
SEGMENT = 256
#: What has to be inserted before a turn of a role to make it legal in a state; absent: not possible.
_GAPS = {
    (START, SYSTEM): (), (START, USER): (), (SYSTEM, USER): (), (ASSISTANT, USER): (), (USER, ASSISTANT): (),
    (USER, USER): (ASSISTANT,), (START, ASSISTANT): (USER,), (SYSTEM, ASSISTANT): (USER,), (ASSISTANT, ASSISTANT): (USER,),
}
#: Inserted at the end.
_CLOSE = {START: (), ASSISTANT: (), USER: (ASSISTANT,), SYSTEM: (USER, ASSISTANT)}


def moves(role: int, state: int) -> list[tuple[int, int, bool, tuple[int, ...]]]:
    """(cost, role given, merged, inserted before) of a turn; role 0 stands for unknown roles."""
    found = []
    for given in (SYSTEM, USER, ASSISTANT):
        cost = 0 if given == role else RELABEL
        if given == state:
            found.append((cost + MERGE, given, True, ()))
        if (gap := _GAPS.get((state, given))) is not None:
            found.append((cost + INSERT * len(gap), given, False, gap))
    return sorted(found)


_CODES = {name: k for k, name in enumerate(NAMES) if name}
_MOVES = [[moves(role, state) for state in range(4)] for role in range(4)]
#: The code after the last role of a piece, where pieces of a batch are of different length.
_END = 4


def _best(role: int, state: int, given: int) -> tuple[int, int, bool, tuple[int, ...]] | None:
    return next((m for m in _MOVES[role][state] if m[1] == given), None)


_BEST = [[[_best(role, state, given) for given in range(4)] for state in range(4)] for role in range(4)]
#: Cost, whether merged and role inserted (0: none) by code, state before and role given.
_COST = np.array([[[m[0] if m else np.inf for m in row] for row in table] for table in _BEST] + [np.where(np.eye(4), 0, np.inf)])
_MERGED = np.array([[[bool(m and m[2]) for m in row] for row in table] for table in _BEST])
_GAP = np.array([[[m[3][0] if m and m[3] else 0 for m in row] for row in table] for table in _BEST])


def _grid(codes: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces' codes as rows of equal length, and the lengths."""
    flat = codes.flatten().to_numpy(zero_copy_only=False)
    lengths = codes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    grid = np.full((len(lengths), int(lengths.max(initial=0))), _END, dtype=np.int64)
    grid[np.arange(grid.shape[1]) < lengths[:, None]] = flat
    return grid, lengths


def _sweep(grid: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least costs to each state after a row's codes from its state at the start, and the state before each
    code by the state after it."""
    costs = np.where(np.arange(4) == start[:, None], 0.0, np.inf)
    back = np.zeros((*grid.shape, 4), dtype=np.int8)
    for k in range(grid.shape[1]):
        total = costs[:, :, None] + _COST[grid[:, k]]
        back[:, k], costs = total.argmin(axis=1), total.min(axis=1)
    return costs, back


def _forward(roles: list[int], start: int) -> tuple[np.ndarray, np.ndarray]:
    costs, back = _sweep(np.array(roles, dtype=np.int64).reshape(1, -1), np.array([start]))
    return costs[0], back[0]


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces with their tables of least costs."""
    for batch in batches:
        grid, _ = _grid(batch["codes"])
        costs = np.stack([_sweep(grid, np.full(len(grid), start))[0] for start in range(4)], axis=1)
        offsets = np.arange(0, 16 * len(grid) + 1, 16, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, costs.reshape(-1))], names=[*batch.schema.names, "costs"])


def _ways(tables: Iterator[list]) -> tuple[list[int], int]:
    """The states where the pieces of a conversation meet, from its start to its end, and the least cost."""
    costs, back = np.array([0, *[np.inf] * 3]), []
    for table in tables:
        total = costs[:, None] + np.array(table).reshape(4, 4)
        back.append(total.argmin(axis=0))
        costs = total.min(axis=0)
    closed = [costs[s] + INSERT * len(_CLOSE[s]) for s in range(4)]
    met = [int(np.argmin(closed))]
    for how in reversed(back):
        met.append(int(how[met[-1]]))
    return met[::-1], int(min(closed))


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each piece's states before and after it, and its conversation's cost."""
    for batch in batches:
        rows = []
        for conv, pieces in zip(batch["conv_id"], batch["pieces"], strict=True):
            met, least = _ways(p["costs"] for p in pieces)
            rows += [(conv, p["segment"], p["piece"], *states, False, least) for p, states in zip(pieces, itertools.pairwise(met), strict=True)]
            rows[-1] = (*rows[-1][:5], True, least)
        yield pd.DataFrame(rows, columns=["conv_id", "segment", "piece", "enter", "leave", "last", "cost"])


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece's steps: the role given, whether merged, the role inserted before, whether a turn stands
    open there, and after the conversation's last turn its state (0: not the last)."""
    for batch in batches:
        grid, lengths = _grid(batch["codes"])
        _, back = _sweep(grid, batch["enter"].to_numpy())
        pieces, state = np.arange(len(grid)), batch["leave"].to_numpy()
        given, before = np.zeros_like(grid), np.zeros_like(grid)
        for k in reversed(range(grid.shape[1])):
            given[:, k] = state
            before[:, k] = state = back[pieces, k, state]
        real = grid != _END
        at = grid[real], before[real], given[real]
        ends = np.zeros_like(grid)
        ends[pieces, lengths - 1] = np.where(batch["last"].to_numpy(zero_copy_only=False), batch["leave"].to_numpy(), 0)
        parts = [pa.array(x, pa.int32()) for x in (at[0], at[2], _GAP[at], ends[real])] + [pa.array(x) for x in (_MERGED[at], at[1] != START)]
        steps = pa.ListArray.from_arrays(np.append(0, lengths.cumsum()).astype(np.int32), pa.StructArray.from_arrays(parts, names=["code", "given", "gap", "ends", "merged", "opened"]))
        keys = ["conv_id", "segment", "piece", "cost"]
        yield pa.RecordBatch.from_arrays([*(batch[k] for k in keys), steps], names=[*keys, "steps"])


_STEPS = "array<struct<code int, given int, gap int, ends int, merged boolean, opened boolean>>"


def _line(role: Column, action: Column | str, opened: Column, text: Column, slot: int) -> Column:
    """A rendered turn of the result."""
    action = F.lit(action) if isinstance(action, str) else action
    name = F.element_at(F.array(*map(F.lit, NAMES)), role + 1)
    begin = F.when(action.isin("merge", "relabel+merge"), "\n").otherwise(F.concat(F.when(opened, "<|end|>\n").otherwise(""), F.lit("<|"), name, F.lit("|>\n")))
    turn = F.lit(None).cast("long") if slot != 1 else F.col("turn")
    return F.struct(F.lit(slot).alias("slot"), turn.alias("turn"), name.alias("role"), action.alias("action"), text.alias("text"), F.concat(begin, text).alias("rendered"))


def repaired(turns: DataFrame) -> DataFrame:
    """turns: conv_id, turn, role, text; further columns are not read. Returns the repaired turns (conv_id,
    segment, place, turn, role, action, text, rendered, cost): by segment and place, the rendered pieces of
    a conversation joined are its text; places may have gaps; cost is the whole conversation's. Inserted turns
    have no turn number. Rows without conv_id are left out; turns of the same number go by role and text, those
    without a number come last; null roles are unknown, null texts empty."""
    segment = F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(2**62)).cast("long")
    role, text = (F.coalesce(x, F.lit("")).alias(x) for x in ("role", "text"))
    code = F.lower(F.btrim("role", F.lit(" \t\n\r\f\v")))
    code = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for item in _CODES.items() for x in item)), code), F.lit(0))
    keys = ["conv_id", "segment"]
    order = Window.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_last(), "role")
    plain = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), segment.alias("segment"), F.col("turn").cast("long"), role, text)

    numbered = plain.drop("text").withColumn("number", F.row_number().over(order)).select(*keys, "number", code.alias("code"))
    pieces = numbered.groupBy(*keys, F.floor((F.col("number") - 1) / SEGMENT).cast("long").alias("piece")).agg(F.sort_array(F.collect_list(F.struct("number", "code"))).alias("codes"))
    pieces = pieces.withColumn("codes", F.col("codes.code"))
    pieces = stored(pieces.mapInArrow(_tables, "conv_id long, segment long, piece long, codes array<int>, costs array<double>"), "pieces")
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "piece", "costs"))).alias("pieces"))
    meet = whole.mapInPandas(_meet, "conv_id long, segment long, piece long, enter long, leave long, last boolean, cost long")
    steps = pieces.drop("costs").join(meet, [*keys, "piece"]).mapInArrow(_steps, f"conv_id long, segment long, piece long, cost long, steps {_STEPS}")
    steps = steps.groupBy(*keys).agg(F.first("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("piece", "steps"))).alias("steps"))
    steps = steps.withColumn("steps", F.flatten("steps.steps"))

    rows = plain.withColumn("number", F.row_number().over(order.orderBy(F.col("turn").asc_nulls_last(), "role", "text"))).join(steps, keys)
    rows = rows.withColumn("step", F.element_at("steps", F.col("number"))).drop("steps")
    step = {x: F.col(f"step.{x}") for x in ("code", "given", "gap", "ends", "merged", "opened")}
    same = step["given"] == step["code"]
    action = F.when(step["merged"] & same, "merge").when(step["merged"], "relabel+merge").when(same, "keep").otherwise("relabel")
    nothing, none = F.lit(None), F.lit("")
    lines = F.array(
        F.when(step["gap"] > 0, _line(step["gap"], "insert", step["opened"], none, 0)).otherwise(nothing),
        _line(step["given"], action, step["opened"] | (step["gap"] > 0), F.col("text"), 1),
        *(
            F.when(step["ends"].isin(*(s for s in _CLOSE if missing in _CLOSE[s])), _line(F.lit(missing), "insert", F.lit(True), none, slot)).otherwise(nothing)
            for slot, missing in ((2, USER), (3, ASSISTANT))
        ),
    )
    lines = rows.select(*keys, "number", "cost", step["ends"].alias("ends"), F.explode(F.array_compact(lines)).alias("line"))
    # The conversation's end stands after its last line, which may be one of the inserted.
    final = (F.col("ends") == ASSISTANT) & (F.col("line.slot") == 1) | (F.col("ends") > 0) & (F.col("line.slot") == 3)
    rendered = F.when(final, F.concat("line.rendered", F.lit("<|end|>\n"))).otherwise(F.col("line.rendered"))
    place = 4 * (F.col("number").cast("long") - 1) + F.col("line.slot")
    return lines.select(*keys, place.alias("place"), "line.turn", "line.role", "line.action", "line.text", rendered.alias("rendered"), "cost")


def least_cost(roles: list[int]) -> int:
    """By trying everything; for tests."""
    best = 10**9
    for choice in itertools.product((SYSTEM, USER, ASSISTANT), (False, True), repeat=len(roles)):
        state, cost = START, 0
        for role, given, merged in zip(roles, choice[::2], choice[1::2], strict=True):
            move = next((m for m in moves(role, state) if m[1:3] == (given, merged)), None)
            if move is None:
                break
            state, cost = given, cost + move[0]
        else:
            best = min(best, cost + INSERT * len(_CLOSE[state]))
    return best
