"""Sessions in a stream: every event with its session number and the funnel step reached so far.

The batch form (``operators.sessions``) numbers a user's sessions in order of event time. A stream gets events out of order, so
each user's events wait in state until the watermark has passed them, and are then numbered in order of time and id. Events
behind the watermark are dropped, as by every stateful operator.

State per user (``transformWithState``): the events still waiting, and one row about the last event numbered (its time,
session and step). The second may expire after ``idle`` without an event; numbering then starts anew for that user.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import duration_micros
from ..schemas import FUNNEL_STEP
from .aggregates import LATE_HOLD, with_late_data_bound

#: State needs this provider: ``spark.sql.streaming.stateStore.providerClass``.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "event_id string, event_type string, t long"
LAST = "t long, seq long, step int"
OUTPUT = (
    "user_id string, event_id string, event_type string, event_timestamp timestamp, session_seq long, "
    "is_session_start boolean, current_step int"
)


class SessionNumbers(StatefulProcessor):
    def __init__(self, gap_us: int, idle_ms: int | None):
        self.gap_us, self.idle_ms = gap_us, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", EVENT)
        self.last = handle.getValueState("last", LAST, self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        new = [Row(event_id=r.event_id, event_type=r.event_type, t=r.t) for r in rows]
        self.waiting.appendList([tuple(r) for r in new])
        # fires once the watermark has passed the first of them; a timer that is set twice is one
        self.handle.registerTimer(min(r.t for r in new) // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((t, event_id, kind) for event_id, kind, t in held if t <= passed)
        later = [r for r in held if r[2] > passed]
        if not ready:
            return
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(min(r[2] for r in later) // 1000 + 1)
        else:
            self.waiting.clear()
        before, seq, step = tuple(self.last.get()) if self.last.exists() else (None, 0, 0)
        for t, event_id, kind in ready:
            starts = before is None or t - before >= self.gap_us
            if starts:
                seq, step = seq + 1, 0
            step, before = max(step, FUNNEL_STEP.get(kind, 0)), t
            yield Row(user_id=key[0], event_id=event_id, event_type=kind, t=t, session_seq=seq, is_session_start=starts, current_step=step)
        self.last.update((before, seq, step))

    def close(self) -> None:
        pass


def session_numbers_stream(
    events: DataFrame, gap: str = "30 minutes", delay: str = LATE_HOLD, idle: str | None = None
) -> DataFrame:
    """Every event of a user once the watermark has passed it, with ``session_seq``, ``is_session_start`` and
    ``current_step`` as ``sessionize`` and ``session_progress`` give them. Needs the RocksDB state store."""
    rows = with_late_data_bound(events.where("user_id is not null and event_timestamp is not null"), delay)
    rows = rows.select("user_id", "event_id", "event_type", "event_timestamp", F.unix_micros("event_timestamp").alias("t"))
    processor = SessionNumbers(duration_micros(gap), duration_micros(idle) // 1000 if idle else None)
    kinds = OUTPUT.replace("event_timestamp timestamp", "t long")
    numbered = rows.groupBy("user_id").transformWithState(processor, kinds, "Append", "EventTime")
    return numbered.select(
        "user_id", "event_id", "event_type", F.timestamp_micros("t").alias("event_timestamp"), "session_seq",
        "is_session_start", "current_step",
    )
