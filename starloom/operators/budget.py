"""Budget triggers: events use up an agent's budget, a used-up budget fires and is refilled."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starloom.operators.ordering import ordered_partitions


def spend_each(weights: np.ndarray, starts: np.ndarray, entering, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Remaining budget before the refill and whether it fired, per event of several agents in a row.

    ``starts`` are the first events of the agents, ``entering`` the budgets that they begin with.
    Where a budget that begins at an event is used up follows for all events at once from the
    running sum, and only the firing events are walked.  Weights must not be negative.
    """
    total = np.cumsum(weights)
    before = total - weights
    ends = np.searchsorted(total, before + budget)  # the event that uses up a budget beginning here
    bounds = [*starts.tolist(), len(weights)]
    begins, sizes, fires = [], [], []
    for first, stop, size in zip(bounds[:-1], bounds[1:], entering, strict=True):
        at, end = first, int(np.searchsorted(total, before[first] + size))
        while True:
            begins.append(at)
            sizes.append(size)
            if end >= stop:
                break
            fires.append(end)
            at, size = end + 1, budget
            if at >= stop:
                break
            end = int(ends[at])
    fired = np.zeros(len(weights), dtype=bool)
    fired[fires] = True
    begin = np.asarray(begins, dtype=np.int64)
    base = before[begin] + np.asarray(sizes, dtype=np.int64)
    return np.repeat(base, np.diff(np.append(begin, len(weights)))) - total, fired


def spend_runs(weights: np.ndarray, starts: np.ndarray, entering: int, budget: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The same where the first agent begins with ``entering`` and the others with the full budget; also the state after the last event."""
    left, fired = spend_each(weights, starts, [entering, *[budget] * (len(starts) - 1)], budget)
    return left, fired, budget if fired[-1] else int(left[-1])


def spend(weights, remaining: int, budget: int) -> tuple[list[int], list[bool], int]:
    """The same for one agent."""
    if not len(weights):
        return [], [], remaining
    left, fired, state = spend_runs(np.asarray(weights, dtype=np.int64), np.zeros(1, dtype=np.int64), remaining, budget)
    return left.tolist(), fired.tolist(), state


def turned(weights: np.ndarray, budget: int) -> np.ndarray:
    """What the events turn every entering state 1 .. budget into.

    From each event the end of a budget that begins there leads to the next beginning; jumps
    of doubled length tell for all events at once what is left at the end.
    """
    n = len(weights)
    total = np.append(0, np.cumsum(weights))  # spent before each event, and at the end
    jump = np.append(np.minimum(np.searchsorted(total[1:], total[:-1] + budget) + 1, n + 1), n + 1)
    left = np.where(jump > n, budget - (total[-1] - total), 0)  # where no other begins: what is left of it
    left[n] = budget
    known = jump > n
    known[n] = True
    jump = np.where(known, np.arange(n + 1), jump)
    while not known.all():
        left = np.where(known, left, left[jump])
        known, jump = known | known[jump], jump[jump]
    states = np.arange(1, budget + 1)
    first = np.searchsorted(total[1:], states) + 1
    return np.where(first > n, states - total[-1], left[np.minimum(first, n)])


def budget_triggers(events: DataFrame, agent: str, order: list[str], weight: str, budget: int) -> DataFrame:
    """Adds ``remaining`` and ``triggered`` to every event, in each agent's order.

    The refill makes the state sequential, and one agent may own a third of all events.  With
    integer weights that are not negative a state is one of ``budget`` numbers, so a partition
    owned by one agent is summarised by what it turns each possible state into (maps of its
    batches, one after the other), any other one by its last agent's state.  The summaries (at
    most one short array per partition) are chained on the driver, then every partition runs
    independently from its known starting state.
    """
    fine = F.when(F.col(weight) < 0, F.raise_error(F.lit("a weight is negative"))).otherwise(F.col(weight))
    placed = ordered_partitions(events.withColumn("__w", fine.cast("long")), [F.col(agent).asc(), *[F.col(o).asc() for o in order]])
    kind = events.schema[agent].dataType.simpleString()

    def starts_of(agents: pd.Series) -> np.ndarray:
        codes = pd.factorize(agents, use_na_sentinel=False)[0]
        return np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))

    def summarise(batches):
        pid = first = last = None
        states, tail, whole = np.arange(1, budget + 1), budget, True
        for batch in batches:
            if not len(batch):
                continue
            agents, weights, starts = batch[agent], batch["__w"].to_numpy(), starts_of(batch[agent])
            if pid is None:
                pid, first, last = int(batch["__pid"].iloc[0]), agents.iloc[0], agents.iloc[0]
            same = agents.iloc[0] == last or (pd.isna(agents.iloc[0]) and pd.isna(last))
            whole = whole and same and len(starts) == 1
            if whole:
                states = turned(weights, budget)[states - 1]
            elif len(starts) == 1 and same:
                tail = spend_runs(weights, starts, tail, budget)[2]
            else:
                tail = spend_runs(weights[starts[-1]:], np.zeros(1, dtype=np.int64), budget, budget)[2]
            last = agents.iloc[-1]
        if pid is not None:
            # the whole table of states matters only where one agent fills the partition
            yield pd.DataFrame({"pid": [pid], "first": [first], "last": [last], "turns": [states.tolist() if whole else []], "tail": [tail]})

    rows = placed.select("__pid", agent, "__w").mapInPandas(
        summarise, f"pid int, first {kind}, last {kind}, turns array<long>, tail long").collect()
    start, agent_now, state = {}, None, budget
    for r in sorted(rows, key=lambda r: r.pid):
        entering = state if r.first == agent_now else budget
        start[r.pid] = entering
        state = r.turns[entering - 1] if r.turns else r.tail
        agent_now = r.last

    def run(batches):
        current = state = None
        for batch in batches:
            if not len(batch):
                continue
            agents, starts = batch[agent], starts_of(batch[agent])
            if state is None:
                state = start[int(batch["__pid"].iloc[0])]
            elif not (agents.iloc[0] == current or (pd.isna(agents.iloc[0]) and pd.isna(current))):
                state = budget
            left, fired, state = spend_runs(batch["__w"].to_numpy(), starts, state, budget)
            current = agents.iloc[-1]
            yield batch.drop(columns=["__pid", "__pos", "__w"]).assign(remaining=left, triggered=fired)

    schema = events.schema
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", remaining long, triggered boolean"
    return placed.mapInPandas(run, out)
