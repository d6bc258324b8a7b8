"""Chat formatting after minimum-cost role repair.

Legal conversations start with a system turn or a user turn; after a system turn comes a user turn; user and assistant
turns alternate; the last turn is the assistant's. Turns that break this are repaired at the least total cost by
dynamic programming over that automaton. For each turn in order one of these is chosen:

* keep its role, or relabel it (``RELABEL``; a role that isn't known counts as none of the three);
* merge it into the turn before, which then keeps its role (``MERGE`` if the roles agree, else also ``RELABEL``);
* first insert an empty turn (``INSERT``), so that the turn itself is legal.

At the end empty turns are inserted where an assistant turn is missing. Of equal costs the first in the order
keep, merge, relabel, insert is taken, by the earliest turn.

The result has one row for each turn, not one for each conversation, since one conversation may hold a large part of
all rows: (conv_id, place, role, action, text, rendered); the rendered pieces of a conversation, joined by place, are
its text in the format. Turns are ordered by turn, then role and text; ties and repeated rows all stay. Null conv_ids
are one conversation. Null texts count as empty, null roles as unknown. An empty table gives no rows.

How it scales: rows are dealt out by ranges of (conv_id, turn, ...), sorted and cut into blocks, so a long conversation
spans many tasks. The cost of a piece from each state to each state is a small matrix under (min, +), and as that
product is associative, pieces are reduced alone; only the matrices of conversations that may span blocks, two for each
block at most, meet per conversation. Then each piece knows its entry and exit and picks its actions alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import stored, table

#: The states are the role of the last turn so far; START has none.
ROLES = ("system", "user", "assistant")
START = 3
MERGE, RELABEL, INSERT = 1.0, 3.0, 4.0
KEEP_, MERGE_, RELABEL_, INSERT_ = range(4)
ACTIONS = ("keep", "merge", "relabel", "insert")
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
_NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
UNKNOWN = 3


def _moves() -> dict[int, list[list[tuple[float, int, int]]]]:
    """For each role of a turn and each state before it: (cost, action, state after), the preferred ones first."""
    out: dict[int, list[list[tuple[float, int, int]]]] = {}
    for role in range(4):
        out[role] = []
        for state in range(4):
            found = []
            for after in _NEXT[state]:
                found.append((0.0, KEEP_, after) if after == role else (RELABEL, RELABEL_, after))
            if state != START:
                found.append((MERGE + (0.0 if role == state else RELABEL), MERGE_, state))
            for between in _NEXT[state]:
                for after in _NEXT[between]:
                    found.append((INSERT + (0.0 if after == role else RELABEL), INSERT_, after))
            out[role].append(sorted(found))
    return out


MOVES = _moves()
#: Cost from each state to each by one turn, by the turn's role.
STEP = np.full((4, 4, 4), np.inf)
for _role in range(4):
    for _state in range(4):
        for _cost, _, _after in MOVES[_role][_state]:
            STEP[_role, _state, _after] = min(STEP[_role, _state, _after], _cost)
#: What it costs to end in a state: an empty assistant turn, after an empty user turn where one is needed.
ENDING = np.array([2 * INSERT, INSERT, 0.0, 0.0])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


_NONE = np.where(np.eye(4, dtype=bool), 0.0, np.inf)


def _role_codes(roles: pd.Series) -> np.ndarray:
    return roles.str.strip().str.lower().map({r: i for i, r in enumerate(ROLES)}).fillna(UNKNOWN).to_numpy(np.int64)


def _runs(key: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    return list(zip(cuts[:-1], cuts[1:], strict=True)) if len(key) else []


#: Bits of the number of turns that a task holds together, a block.
BLOCK = 12


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the place of each sorted row: the task's number above, a running number below."""
    place = TaskContext.get().partitionId() << 40
    for rows in batches:
        yield rows.assign(place=np.arange(place, place + len(rows)))
        place += len(rows)


def _open_runs(block: pd.DataFrame) -> pd.DataFrame:
    """Of a block its first and its last conversation, which other blocks may share, with their cost matrices."""
    block = block.sort_values("place")
    codes, out = _role_codes(block["role"]), []
    runs = _runs(block["conv"].to_numpy())
    for a, b in dict.fromkeys((runs[0], runs[-1])):
        matrix = _NONE
        for code in codes[a:b]:
            matrix = _times(matrix, STEP[code])
        out.append((block["block"].iloc[0], a == 0, block["conv"].iloc[a], matrix.ravel().tolist()))
    return pd.DataFrame(out, columns=["block", "first", "conv", "costs"])


def _ends(pieces: pd.DataFrame) -> pd.DataFrame:
    """For a conversation's pieces the state before each and after it, on a cheapest way."""
    pieces = pieces.sort_values("block")
    costs = [np.array(c).reshape(4, 4) for c in pieces["costs"]]
    upto = [np.where(np.arange(4) == START, 0.0, np.inf)]
    for m in costs:
        upto.append((upto[-1][:, None] + m).min(axis=0))
    state = int(np.argmin(upto[-1] + ENDING))
    entry, leave = [], []
    for i in range(len(costs) - 1, -1, -1):
        leave.append(state)
        state = int(np.argmin(upto[i] + costs[i][:, state]))
        entry.append(state)
    last = np.arange(len(costs)) == len(costs) - 1
    return pieces[["block", "first"]].assign(entry=entry[::-1], leave=leave[::-1], last=last)


def choose(codes: np.ndarray, entry: int, leave: int) -> list[tuple[int, int, int]]:
    """(action, state before, state after) of each turn, on a cheapest way from ``entry`` to ``leave``."""
    n = len(codes)
    rest = np.full((n + 1, 4), np.inf)  # cost from a state to the end
    rest[n, leave] = 0.0
    for i in range(n - 1, -1, -1):
        rest[i] = (STEP[codes[i]] + rest[i + 1][None, :]).min(axis=1)
    out, state = [], entry
    for i, code in enumerate(codes.tolist()):
        moves = [(cost + rest[i + 1, after], action, after) for cost, action, after in MOVES[code][state]]
        _, action, after = min(moves)
        out.append((action, state, after))
        state = after
    return out


def _between(state: int, after: int) -> int:
    """The role of the empty turn that makes ``after`` legal."""
    return next(b for b in _NEXT[state] if after in _NEXT[b])


def _rendered(block: pd.DataFrame) -> pd.DataFrame:
    """The rows of the result for a block."""
    block, out = block.sort_values("place"), []
    codes, texts, places, head = _role_codes(block["role"]), block["text"].fillna("").tolist(), block["place"].tolist(), block.iloc[0]
    for a, b in _runs(block["conv"].to_numpy()):
        ends = head["head"] if a == 0 else head["tail"] if b == len(block) else None
        if ends is None:  # all of it is here
            upto = np.where(np.arange(4) == START, 0.0, np.inf)
            for code in codes[a:b]:
                upto = (upto[:, None] + STEP[code]).min(axis=0)
            entry, leave, last = START, int(np.argmin(upto + ENDING)), True
        else:
            entry, leave, last = ends["entry"], ends["leave"], ends["last"]
        for i, (action, state, after) in enumerate(choose(codes[a:b], entry, leave), a):
            shown = "" if state == START or action == MERGE_ else CLOSE
            if action == INSERT_:
                shown += OPEN.format(ROLES[_between(state, after)]) + CLOSE
            shown += ("\n" if action == MERGE_ else OPEN.format(ROLES[after])) + texts[i]
            if last and i == b - 1:
                shown += CLOSE + "".join(OPEN.format(r) + CLOSE for r in ROLES[leave + 1 :])
            out.append((block["conv_id"].iloc[i], places[i], ROLES[after], ACTIONS[action], texts[i], shown))
    return pd.DataFrame(out, columns=["conv_id", "place", "role", "action", "text", "rendered"])


def formatted(conversations: DataFrame) -> DataFrame:
    """See the module's text. ``place`` grows along a conversation."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv")
    order = ["conv_id", "turn", "role", "text"]
    dealt = conversations.select("conv_id", conv, "turn", "role", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    # written once, so that the places are the same for all that follows
    rows = stored(dealt.drop("turn").mapInPandas(_numbered, f"conv_id {kind}, conv string, role string, text string, place long"))
    rows = rows.withColumn("block", F.shiftright("place", BLOCK))
    open_runs = rows.select("block", "place", "conv", "role").groupBy("block").applyInPandas(_open_runs, "block long, first boolean, conv string, costs array<double>")
    ends = open_runs.groupBy("conv").applyInPandas(_ends, "block long, first boolean, entry int, leave int, last boolean")
    state = F.struct("entry", "leave", "last")
    both = ends.groupBy("block").agg(F.max(F.when(F.col("first"), state)).alias("head"), F.max(F.when(~F.col("first"), state)).alias("tail"))
    return (
        rows.join(both, "block")
        .groupBy("block")
        .applyInPandas(_rendered, f"conv_id {kind}, place long, role string, action string, text string, rendered string")
    )


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    return formatted(table(spark, sf_dir, "conversations"))
