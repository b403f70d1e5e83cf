"""Detection events: a state machine over frames, as a batch operator and as a streaming one with the same rules.

Positive frames in a row are counted. While no event is open, a positive frame that makes the count ``persistence`` or more
opens one, unless less than ``cooldown`` seconds have passed since the last one closed. Every positive frame extends the open
event; the first negative frame more than ``merge`` seconds after the last positive one closes it. Times are seconds from 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meridian.operators.sequence import folded

OUT = "start double, last_seen double, frames int"
STATE = "pending int, opened double, last double, frames int, ended double, seen double"


@dataclass(frozen=True)
class Rules:
    persistence: int = 2
    merge: float = 1.0
    cooldown: float = 1.0


START = (0, -1.0, -1.0, 0, -1.0, -1.0)


def step(state: tuple | None, t: float, n: int, rules: Rules) -> tuple[tuple, tuple | None]:
    """state (pending, opened, last, frames, ended, seen), -1 for unset times -> the next state and a closed event or None.

    A frame older than one seen before changes nothing.
    """
    pending, opened, last, frames, ended, seen = state = state or START
    if t < seen:
        return state, None
    if n > 0:
        pending += 1
        if opened >= 0:
            return (pending, opened, t, frames + 1, ended, t), None
        if pending < rules.persistence or (ended >= 0 and t - ended < rules.cooldown):
            return (pending, -1.0, last, 0, ended, t), None
        return (pending, t, t, 1, ended, t), None
    if opened >= 0 and t - last > rules.merge:
        return (0, -1.0, -1.0, 0, t, t), (opened, last, frames)
    return (0, opened, last, frames, ended, t), None


def events(frames: DataFrame, rules: Rules = Rules(), flush: bool = True) -> DataFrame:
    """frames (camera_id, ts seconds, n_detections) -> closed events; ``flush`` closes the one left open at the end.

    Of frames of one time the positive ones come first. Frames without a time or a camera are left out, a null count is 0.
    """

    def one(state: tuple | None, row: dict) -> tuple[tuple, list[tuple]]:
        state, closed = step(state, row["ts"], row["n_detections"], rules)
        return state, [closed] if closed else []

    def last(state: tuple) -> list[tuple]:
        return [state[1:4]] if flush and state[1] >= 0 else []

    n = F.coalesce(F.col("n_detections").cast("int"), F.lit(0)).alias("n_detections")
    plain = frames.where("camera_id IS NOT NULL AND ts IS NOT NULL").select("camera_id", F.col("ts").cast("double").alias("ts"), n).withColumn("neg", -F.col("n_detections"))
    return folded(plain, ["camera_id"], ["ts", "neg"], one, last, OUT)


def stream_events(frames: DataFrame, rules: Rules = Rules(), timeout_ms: int = 5000) -> DataFrame:
    """The same over a stream whose frames come in the order of time, a micro-batch's in any order.

    A frame that comes after a later one of an earlier batch is dropped. A camera that falls silent closes its event by a
    processing-time timer, at its last positive frame.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, out = (tuple(state.get) if state.exists else START), []
        if state.hasTimedOut:
            if now[1] >= 0:
                out.append((key[0], *now[1:4]))
                now = (0, -1.0, -1.0, 0, now[2], now[5])
        else:
            rows = pd.concat(list(batches))
            rows = rows.assign(neg=-rows["n_detections"]).sort_values(["ts", "neg"], kind="mergesort")
            for t, n in rows[["ts", "n_detections"]].itertuples(index=False):
                now, closed = step(now, float(t), int(n), rules)
                if closed:
                    out.append((key[0], *closed))
        state.update(now)
        if not state.hasTimedOut:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=["camera_id", "start", "last_seen", "frames"])

    return frames.groupBy("camera_id").applyInPandasWithState(run, f"camera_id string, {OUT}", STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def pre_post_roll(frames: DataFrame, found: DataFrame, before: float, after: float) -> DataFrame:
    """Frames of the seconds before an event's start to after its end: what a ring buffer would have held."""
    from meridian.operators.intervals import containment_join

    spans = found.select(F.col("camera_id"), (F.col("start") - before).alias("roll_start"), (F.col("last_seen") + after).alias("roll_stop"), F.col("start").alias("event"))
    return containment_join(frames, spans, "ts", "roll_start", "roll_stop", max(before + after, 1.0), ["camera_id"])
