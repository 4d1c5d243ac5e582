"""Navigation sessions as a fold over ordered events, in batch and as a stream.

State of a session: the key, the number of steps taken and not undone, and the
phase.  choose goes a step on; back undoes one; restart and jump begin anew.
The batch form needs no Python: the depth after an event is what a running sum
since the last beginning leaves when it is never below zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def folded(events: DataFrame) -> DataFrame:
    """(session_key, steps, depth, phase, last_key) of each session of events (event_id, session_key, ord, nav_action, key_id), repeated deliveries once.

    A back step at the start stays at the start: depth is the running sum less
    its least value so far (if below zero) since the last restart or jump.
    """
    once = events.filter("session_key is not null").dropDuplicates(["event_id"])
    w = Window.partitionBy("session_key").orderBy("ord", "event_id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    anew = F.col("nav_action").isin("restart", "jump")
    move = F.when(F.col("nav_action") == "choose", 1).when(F.col("nav_action") == "back", -1).otherwise(0)
    run = once.withColumn("leg", F.sum(anew.cast("int")).over(upto)).withColumn("move", move)
    leg = Window.partitionBy("session_key", "leg").orderBy("ord", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    summed = run.withColumn("sum", F.sum("move").over(leg))
    deep = summed.withColumn("depth", F.col("sum") - F.least(F.lit(0), F.min("sum").over(leg)))
    last = F.struct("ord", "event_id")
    out = deep.groupBy("session_key").agg(F.count("*").alias("steps"), F.max_by("depth", last).cast("int").alias("depth"), F.max_by("nav_action", last).alias("last_action"), F.max_by("key_id", F.when(F.col("key_id").isNotNull(), last)).alias("last_key"))
    return out.withColumn("phase", F.when(F.col("depth") == 0, "start").otherwise("inside"))


def _step(state: tuple, action: str, key_id: object) -> tuple:
    steps, depth, last_key = state
    depth = depth + 1 if action == "choose" else max(0, depth - 1) if action == "back" else 0 if action in ("restart", "jump") else depth
    return steps + 1, depth, key_id if isinstance(key_id, str) else last_key


class Navigation(StatefulProcessor):
    """The same fold as a stateful stream operator, keyed by session; emits the state after each batch of events.

    Events count from 1 in a session, so what arrives early waits in the state
    until what is missing before it has come: late events lose nothing, and what
    was delivered twice is known by its number.  What still waits is taken into
    the emitted state in order, but not yet into the kept one.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("nav", "steps int, depth int, last_key string, seen int")
        self.waiting = handle.getMapState("waiting", "ord int", "nav_action string, key_id string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        steps, depth, last_key, seen = self.state.get() if self.state.exists() else (0, 0, None, 0)
        held = {k[0]: (v[0], v[1]) for k, v in self.waiting.iterator()}
        kept = set(held)
        for pdf in rows:
            for ord_, action, key_id in zip(pdf["ord"], pdf["nav_action"], pdf["key_id"]):
                if int(ord_) > seen:
                    held.setdefault(int(ord_), (action, key_id if isinstance(key_id, str) else None))
        now = (steps, depth, last_key)
        while seen + 1 in held:
            seen += 1
            now = _step(now, *held.pop(seen))
            if seen in kept:
                self.waiting.removeKey((seen,))
        for ord_ in set(held) - kept:
            self.waiting.updateValue((ord_,), held[ord_])
        self.state.update((*now, seen))
        for ord_ in sorted(held):
            now = _step(now, *held[ord_])
        yield pd.DataFrame([(key[0], *now)], columns=["session_key", "steps", "depth", "last_key"])

    def close(self) -> None:
        pass


def streamed(events: DataFrame) -> DataFrame:
    """A stream of session states from a stream of events."""
    return events.groupBy("session_key").transformWithStateInPandas(Navigation(), "session_key string, steps int, depth int, last_key string", "Update", "None")
