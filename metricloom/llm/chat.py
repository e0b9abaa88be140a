"""Chat formatting: minimum-cost repair of the roles of a conversation, then rendering.

A legal conversation is an optional system turn, then user and assistant in turn. For each
given turn the automaton may open a turn of its role, relabel it, merge it into the turn
that is open, or insert an empty turn in front. Dynamic programming finds the cheapest way.

A conversation may be of any length. All turns are sorted into parts of about equal size,
across conversations; a conversation that lies in several parts gets a min-plus matrix of
costs per part (from the state before to the state after), the matrices give the states at
its borders, and each part is then solved and rendered on its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import small_batches, stored

ROLES = ("system", "user", "assistant")
#: States: the role of the open turn, or the beginning.
START = 3
LEGAL = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
#: A new label costs more than an empty turn; nothing but a system turn becomes one.
MERGE, RELABEL, UNNAMED, INSERT = 1.0, 4.0, 1.0, 3.0
ACTIONS = ("open", "merge")
_STATES = range(4)

Choice = tuple[float, int, int]  # cost, role of an inserted turn or -1, action


def role_of(name: str | None) -> int:
    name = (name or "").strip().lower()
    return ROLES.index(name) if name in ROLES else -1


def _label(role: int, new: int) -> float:
    if role == new:
        return 0.0
    return math.inf if new == 0 else UNNAMED if role < 0 else RELABEL


def _moves(role: int) -> dict[tuple[int, int], Choice]:
    """The cheapest way from each state to each state over one turn.

    Of equal costs, opening comes before merging, and both before inserting.
    """
    out: dict[tuple[int, int], Choice] = {}

    def offer(a: int, b: int, choice: Choice) -> None:
        if choice[0] < out.get((a, b), (math.inf,))[0]:
            out[a, b] = choice

    for state in _STATES:
        for new in LEGAL[state]:
            offer(state, new, (_label(role, new), -1, 0))
        if state != START:
            offer(state, state, (MERGE + _label(role, state), -1, 1))
        for between in LEGAL[state]:
            for new in LEGAL[between]:
                offer(state, new, (INSERT + _label(role, new), between, 0))
    return out


MOVES = {role: _moves(role) for role in range(-1, 3)}


def forward(costs: list[float], role: int) -> list[float]:
    out = [math.inf] * 4
    for (a, b), (cost, _, _) in MOVES[role].items():
        out[b] = min(out[b], costs[a] + cost)
    return out


def costs_of(roles: list[int]) -> list[float]:
    """Min-plus matrix of a run of turns, row by row."""
    flat: list[float] = []
    for start in _STATES:
        costs = [0.0 if s == start else math.inf for s in _STATES]
        for role in roles:
            costs = forward(costs, role)
        flat += costs
    return flat


def repair(roles: list[int], start: int = START, end: int | None = None) -> list[tuple[int, int, int]]:
    """(new role, inserted role or -1, action) of each turn on the cheapest way.

    Of ways of equal cost, the end state with the smaller number is taken, then in each
    step backwards the state before with the smaller number.
    """
    levels = [[0.0 if s == start else math.inf for s in _STATES]]
    for role in roles:
        levels.append(forward(levels[-1], role))
    state = min(_STATES, key=lambda s: (levels[-1][s], s)) if end is None else end
    out = []
    for at in range(len(roles) - 1, -1, -1):
        moves = MOVES[roles[at]]
        before = min(
            (a for a in _STATES if (a, state) in moves),
            key=lambda a: (levels[at][a] + moves[a, state][0], a),
        )
        _, inserted, action = moves[before, state]
        out.append((state, inserted, action))
        state = before
    return out[::-1]


def _open(role: int) -> str:
    return f"<|im_start|>{ROLES[role]}\n"


_CLOSE = "<|im_end|>\n"


def render(texts: list[str | None], ways: list[tuple[int, int, int]], first: bool, last: bool) -> list[str]:
    """One piece per turn; the pieces of a conversation, in order, are its rendered form.

    Markers inside texts are broken by a space, so that they stay text.
    """
    out = []
    for text, (role, inserted, action) in zip(texts, ways, strict=True):
        piece = ""
        if action == 1:
            piece = "\n"
        else:
            piece = "" if first and not out else _CLOSE
            if inserted >= 0:
                piece += _open(inserted) + _CLOSE
            piece += _open(role)
        out.append(piece + (text or "").replace("<|im_", "<| im_"))
    if last and out:
        out[-1] += _CLOSE
    return out


def _matrix(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("at")
    out = rows[["conv", "part"]].iloc[:1].reset_index(drop=True)
    out["costs"] = [costs_of(rows["role"].tolist())]
    return out


def _borders(rows: pd.DataFrame) -> pd.DataFrame:
    """States at the borders of the parts of one conversation."""
    rows = rows.sort_values("part").reset_index(drop=True)
    levels = [[0.0 if s == START else math.inf for s in _STATES]]
    for flat in rows["costs"]:
        now = levels[-1]
        levels.append([min(now[a] + flat[4 * a + b] for a in _STATES) for b in _STATES])
    states = [min(_STATES, key=lambda s: (levels[-1][s], s))]
    for level, flat in zip(levels[-2::-1], rows["costs"][::-1], strict=True):
        states.append(min(_STATES, key=lambda a: (level[a] + flat[4 * a + states[-1]], a)))
    states.reverse()
    out = rows[["conv", "part"]].copy()
    out["start"], out["end"] = states[:-1], states[1:]
    out["last"] = [False] * (len(rows) - 1) + [True]
    return out


_OUT = ["conv_id", "turn", "role", "new_role", "action", "inserted", "rendered"]
_SCHEMA = (
    "conv_id bigint, turn bigint, role string, new_role string, action string, "
    "inserted string, rendered string"
)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole parts; one conversation's share of a part is held at a time."""
    held: list[dict] = []

    def flush(held: list[dict]) -> pa.RecordBatch:
        known = held[0]
        start = START if known["start"] is None else known["start"]
        ways = repair([role_of(x["role"]) for x in held], start, known["end"])
        last = True if known["last"] is None else known["last"]
        pieces = render([x["text"] for x in held], ways, start == START, last)
        rows = []
        for x, (new, inserted, action), piece in zip(held, ways, pieces, strict=True):
            name = ACTIONS[action]
            if role_of(x["role"]) != new:
                name = "relabel" if action == 0 else "relabel_merge"
            added = ROLES[inserted] if inserted >= 0 else None
            rows.append((x["conv"], x["turn"], x["role"], ROLES[new], name, added, piece))
        kinds = [pa.int64()] * 2 + [pa.string()] * 5
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, _OUT)

    for batch in batches:
        for x in batch.to_pylist():
            if held and (x["part"], x["conv"]) != (held[0]["part"], held[0]["conv"]):
                yield flush(held)
                held = []
            held.append(x)
    if held:
        yield flush(held)


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, new_role, action, inserted, rendered of each given turn.

    ``action`` is open, relabel, merge or relabel_merge; ``inserted`` is the role of an
    empty turn put in front. A turn without a known role takes the role that costs least;
    missing text is empty. Turns without a ``conv_id`` make up one conversation. Turns of
    one number are ordered by role (a missing one first) and a hash of the text, a missing number comes
    last. Repeated rows are turns of their own. An empty table gives an empty table.
    """
    small_batches(turns)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        "role", "text", F.xxhash64("role", "text").alias("h"),
    )
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_last(), "role", "h"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    placed = placed.withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("part", F.shiftright("at", 33)), "turns")

    # Only the first and the last conversation of a part can go on in another part.
    parts = placed.groupBy("part").agg(
        F.min_by(F.struct("conv"), "at").alias("a"), F.max_by(F.struct("conv"), "at").alias("b")
    )
    ends = parts.select("part", F.explode(F.array("a", "b")).alias("c")).select("part", "c.conv").distinct()
    many = ends.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv")
    same = F.col("e.conv").eqNullSafe(F.col("m.conv"))
    ends = stored(ends.alias("e").join(many.alias("m"), same, "left_semi"), "ends").alias("e")
    match = F.col("p.conv").eqNullSafe(F.col("e.conv")) & (F.col("p.part") == F.col("e.part"))
    code = F.coalesce(*[F.when(F.lower(F.trim("role")) == r, F.lit(i)) for i, r in enumerate(ROLES)], F.lit(-1))
    spread = placed.select("conv", "part", "at", code.alias("role")).alias("p").join(ends, match, "left_semi")
    matrices = spread.groupBy("conv", "part").applyInPandas(
        _matrix, "conv bigint, part bigint, costs array<double>"
    )
    borders = matrices.groupBy("conv").applyInPandas(
        _borders, "conv bigint, part bigint, start bigint, end bigint, last boolean"
    )
    borders = stored(borders, "borders").alias("e")
    known = placed.alias("p").join(borders, match, "left").select(
        "p.conv", "p.part", "p.at", "p.turn", "p.role", "p.text", "e.start", "e.end", "e.last"
    )
    whole = known.repartition("part").sortWithinPartitions("at")
    return whole.mapInArrow(_solved, _SCHEMA)
