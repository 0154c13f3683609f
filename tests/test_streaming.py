"""Streaming: late rows behind the watermark never revive an old state."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pandas as pd

from contrail.sources.fixtures import Fixtures
from contrail.streaming import stream


def _events(rows):
    return pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])


def test_baggage_state_drops_rows_behind_the_watermark(spark):
    d = tempfile.mkdtemp(prefix="contrail-stream-", dir="/tmp")
    t0 = dt.datetime(2024, 1, 10, 12, 0)
    # batch 1: user 1 (tag BG0001) checks in, then loads; the watermark moves to 12:30 - 30 min
    _events([(1, t0, 1, "signup", 1.0, "{}"), (2, t0 + dt.timedelta(minutes=30), 1, "view", 1.0, "{}"),
             (3, t0 + dt.timedelta(minutes=31), 2, "signup", 1.0, "{}")]).to_parquet(os.path.join(d, "events.parquet"), coerce_timestamps="us")
    # batch 2 arrives later: one row far behind the watermark (dropped), one on time
    late = _events([(4, t0 - dt.timedelta(hours=3), 1, "error", 1.0, "{}"),
                    (5, t0 + dt.timedelta(minutes=40), 2, "view", 1.0, "{}")])
    p2 = os.path.join(d, "events_late.parquet")
    late.to_parquet(p2, coerce_timestamps="us")
    os.utime(p2, (os.path.getmtime(p2) + 5, os.path.getmtime(p2) + 5))
    out = stream.baggage_state_stream(spark, d).collect()
    state = {r.tag_id: (r.baggage_id, r.evento) for r in out}
    # the late LOST event (id 4) is older than the kept state: state stays LOAD from id 2
    assert state["BG0001"] == (2, "LOAD")
    assert state["BG0002"][0] == 5
    assert stream.LAST_METRICS["baggage_state"]["batches"] >= 2


def test_stream_equals_batch_latest_position(spark):
    from tests.conftest import SF_SMALL
    s = {r.vuelo_id: r.posicion_id for r in stream.latest_position_stream(spark, SF_SMALL).collect()}
    fx = Fixtures(spark, SF_SMALL)
    from pyspark.sql import functions as F
    b = fx.positions.groupBy("vuelo_id").agg(F.max_by("posicion_id", F.struct("timestamp_utc", "posicion_id")).alias("p"))
    assert s == {r.vuelo_id: r.p for r in b.collect()}


def test_stream_resumes_from_its_checkpoint(spark):
    """A second run on the same folder finds no new files: state and output are unchanged."""
    from tests.conftest import SF_SMALL
    from contrail.session import scratch_path
    import uuid
    base = scratch_path(spark, f"t/resume-{uuid.uuid4().hex}")
    first = sorted(stream.rule_quarantine_stream(spark, SF_SMALL, base=base).collect())
    assert stream.LAST_METRICS["rule_quarantine"]["batches"] >= 1
    again = sorted(stream.rule_quarantine_stream(spark, SF_SMALL, base=base).collect())
    assert first == again


def test_engine_windows_take_rows_of_later_files_with_overlapping_times(spark):
    d, one = tempfile.mkdtemp(prefix="contrail-stream-", dir="/tmp"), tempfile.mkdtemp(prefix="contrail-stream-", dir="/tmp")
    t0 = dt.datetime(2024, 1, 10, 12, 0)
    rows = [(i, t0 + dt.timedelta(minutes=7 * (i % 40)), i % 5, "view", float(i) / 3, "{}") for i in range(80)]
    _events(rows).to_parquet(os.path.join(one, "events.parquet"), coerce_timestamps="us")
    for k, part in enumerate((rows[:40], rows[40:60], rows[60:])):  # late rows are told by the watermark of the batch before
        p = os.path.join(d, f"events_{k}.parquet")
        _events(part).to_parquet(p, coerce_timestamps="us")
        os.utime(p, (os.path.getmtime(p) + 5 * k, os.path.getmtime(p) + 5 * k))
    split = sorted(stream.engine_health_stream(spark, d).collect())
    assert sum(r.lecturas for r in split) == len(rows)
    assert stream.LAST_METRICS["engine_health"] == {"rows_dropped_by_watermark": 0, "batches": 3}
    assert split == sorted(stream.engine_health_stream(spark, one).collect())
