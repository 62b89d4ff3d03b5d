"""Feedback of request outcomes as stateful streams: a service's circuit, and the pace of a sender.

Both are rules of one key's outcomes in order, written once as a step from state to state and run by
``applyInPandasWithState``; the state is a few numbers, whatever the length of the stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


class Circuit(NamedTuple):
    """closed (requests pass), open (none does before ``until``), half_open (one probe is on its way)."""

    mode: str = "closed"
    generation: int = 0
    failures: int = 0
    until: float = 0.0
    openings: int = 0
    recoveries: int = 0
    stale: int = 0


CIRCUIT = "mode string, generation int, failures int, until double, openings int, recoveries int, stale int"


def admitted(c: Circuit, t: float) -> Circuit:
    """The circuit when a request asks to pass: an open one whose time is over lets a probe through."""
    return c._replace(mode="half_open") if c.mode == "open" and t >= c.until else c


def after_outcome(c: Circuit, t: float, generation: int, probe: bool, result: str, retry_after: float = 0.0, *, threshold: int = 20, cooldown: float = 60.0) -> Circuit:
    """The circuit after one outcome: 'success', 'service_error', 'transport_timeout', 'admission_cancelled' or 'other'.

    A service that says how long to wait opens the circuit at once, whoever asked.  Outcomes of an earlier generation
    count for nothing else.  A probe decides alone; otherwise ``threshold`` failures in a row open it.
    """

    def opened(wait: float = 0.0) -> Circuit:
        return c._replace(mode="open", generation=c.generation + 1, openings=c.openings + 1, until=t + max(cooldown, wait))

    current = generation == c.generation
    if result == "admission_cancelled":
        return opened() if current and probe else c
    if result == "service_error" and retry_after > 0:
        return opened(max(retry_after, c.until - t if c.mode == "open" else 0.0))
    if not current:
        return c._replace(stale=c.stale + 1)
    if probe:
        return c._replace(mode="closed", failures=0, generation=c.generation + 1, recoveries=c.recoveries + 1) if result == "success" else opened()
    if c.mode != "closed":
        return c
    if result == "success":
        return c._replace(failures=0)
    if result in ("service_error", "transport_timeout"):
        c = c._replace(failures=c.failures + 1)
        return opened() if c.failures >= threshold else c
    return c


def circuit_states(outcomes: DataFrame, *, threshold: int = 20, cooldown: float = 60.0) -> DataFrame:
    """A stream of (key, t, generation, probe, result, retry_after) to the circuit after each; a key's rows of a batch go by t."""

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        c = Circuit(*state.get) if state.exists else Circuit()
        rows = sorted((r for pdf in parts for r in pdf[["t", "generation", "probe", "result", "retry_after"]].itertuples(index=False)), key=lambda r: r.t)
        out = []
        for r in rows:
            c = after_outcome(admitted(c, r.t), r.t, int(r.generation), bool(r.probe), r.result, float(r.retry_after or 0), threshold=threshold, cooldown=cooldown)
            out.append((key[0], r.t, *c))
        state.update(tuple(c))
        yield pd.DataFrame(out, columns=["key", "t", *Circuit._fields])

    return outcomes.groupBy("key").applyInPandasWithState(step, f"key string, t double, {CIRCUIT}", CIRCUIT, "append", GroupStateTimeout.NoTimeout)


class Cohort(NamedTuple):
    """Outcomes of requests that were sent since the pace last changed."""

    interval: float
    epoch: float
    first: float | None = None
    successes: int = 0
    throttles: int = 0
    stale: int = 0
    decisions: int = 0


COHORT = "interval double, epoch double, first double, successes int, throttles int, stale int, decisions int"


def after_response(c: Cohort, t: float, started: float | None, throttled: bool, *, floor: float, ceiling: float, seconds: float = 10.0, least: int = 8) -> Cohort:
    """The pace after one response: a cohort decides once it has ``least`` responses over ``seconds``.

    Any throttling slows the sender by a quarter, none speeds it up by a fifth, within floor and ceiling; responses to
    requests of an earlier pace count as stale.  After a decision a new cohort begins.
    """
    if started is not None and started < c.epoch:
        return c._replace(stale=c.stale + 1)
    c = c._replace(first=t if c.first is None else c.first, successes=c.successes + (not throttled), throttles=c.throttles + bool(throttled))
    if t - c.first < seconds or c.successes + c.throttles < least:
        return c
    pace = min(ceiling, max(c.interval, 0.005) * 1.25) if c.throttles else c.interval / 1.2
    return Cohort(max(floor, pace), t, stale=c.stale, decisions=c.decisions + 1)


def paced(responses: DataFrame, *, interval: float, floor: float, ceiling: float) -> DataFrame:
    """A stream of (key, t, started_at, throttled) to the pace after each response."""

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = sorted((r for pdf in parts for r in pdf[["t", "started_at", "throttled"]].itertuples(index=False)), key=lambda r: r.t)
        c = Cohort(*state.get) if state.exists else Cohort(interval, rows[0].t)
        c = c._replace(first=None if c.first is None or pd.isna(c.first) else c.first)
        out = []
        for r in rows:
            c = after_response(c, r.t, None if pd.isna(r.started_at) else r.started_at, bool(r.throttled), floor=floor, ceiling=ceiling)
            out.append((key[0], r.t, c.interval, c.stale, c.decisions))
        state.update(tuple(c))
        yield pd.DataFrame(out, columns=["key", "t", "interval", "stale", "decisions"])

    return responses.groupBy("key").applyInPandasWithState(step, "key string, t double, interval double, stale int, decisions int", COHORT, "append", GroupStateTimeout.NoTimeout)
