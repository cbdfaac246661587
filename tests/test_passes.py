"""Where passes come to rest: rows by hand, and the stream against the batch, with passes out of turn, late rows and a restart."""

import datetime as dt
import random

import pytest

from arborix.operators.passes import Limits, outcomes
from arborix.streaming.passes import stream_outcomes

SCHEMA = "key long, pass int, ts timestamp, text_before long, html_before long, text_after long, html_after long, invoked long, remaining long, events array<string>"
START = dt.datetime(2024, 1, 1)


def at(minute: float) -> dt.datetime:
    return START + dt.timedelta(minutes=minute)


def test_rules(spark):
    def p(key, n, text=0, invoked=0, events=(), html=0, before=0):
        return (key, n, at(n), before, 0, text, html, invoked, 0, list(events))

    rows = [
        *(p(1, n, text=5, events=["click"]) for n in range(1, 5)),  # unchanged twice at the third pass
        *(p(2, n, text=n, events=["click"]) for n in range(1, 9)),  # five passes at most
        p(3, 1, text=3), p(3, 2, text=3, before=3), p(3, 3, text=9),  # the second does nothing
        p(4, 1, text=1, events=["click", "timeout"]), p(4, 2, text=2), p(4, 3, text=3, events=["error", "timeout", "click"]),  # a row over passes
        p(5, 1, text=1, events=["timeout"]), p(5, 2, text=2, invoked=1, events=["timeout"]), p(5, 4, text=3, events=["click", "left", "click"]),  # invoked ends a row
        p(6, 1, events=["timeout", "click", "cleared", "click"]),
        p(7, 1, html=1), p(7, 2, html=2, invoked=2),  # markup grows; no end
        (8, 1, at(1), None, None, None, None, None, None, None),  # nulls are zeros and no events
        (8, 1, at(9), 0, 0, 1, 0, 1, 0, ["click"]),  # a repeated pass, later
        (None, 1, at(1), 0, 0, 0, 0, 0, 0, []), (9, None, at(1), 0, 0, 0, 0, 0, 0, []), (9, 0, at(1), 0, 0, 0, 0, 0, 0, []), (9, 1, None, 0, 0, 0, 0, 0, 0, []),
    ]
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS outcome", "'x' AS clicks", "2 AS r")
    got = sorted(tuple(r) for r in outcomes(extra, Limits(passes=5)).collect())
    assert got == [
        (1, 3, 3, "stopped_stable_body", 5, 0, 0), (2, 5, 5, "stopped_max_passes", 5, 0, 0), (3, 2, 0, "stopped_no_progress", 3, 0, 0),
        (4, 3, 1, "aborted_consecutive_timeouts", 3, 0, 0), (5, 4, 3, "aborted_unexpected_navigation", 3, 0, 0), (6, 1, 2, "ok", 0, 0, 0),
        (7, 2, 2, "unfinished", 0, 2, 0), (8, 1, 0, "stopped_no_progress", 0, 0, 0),
    ]
    assert outcomes(extra.limit(0)).collect() == []


def made(seed: int, keys: int) -> list[tuple]:
    pick = random.Random(seed)
    clicks = [[], [], ["click"], ["timeout"], ["timeout", "error"], ["click", "timeout"], ["error"], ["left"], ["cleared"], ["timeout", "click"]]
    rows = []
    for k in range(keys):
        for n in range(1, pick.randint(1, 9)):
            if pick.random() < 0.9:  # some passes are missing
                rows.append((k, n, at(n + pick.random()), 0, 0, pick.choice([0, 0, 1, 2]), 0, pick.choice([0, 0, 0, 1]), n, pick.choice(clicks)))
    return rows


@pytest.mark.parametrize("limits", [Limits(passes=6), Limits(passes=4, stable=1, timeouts=3, text_growth=2)])
def test_stream_gives_the_batch_s_rows(spark, tmp_path, limits):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, checkpoint, target = (str(tmp_path / x) for x in ("in", "checkpoint", "out"))
    rows = made(3, 60)
    want = sorted(tuple(r) for r in outcomes(spark.createDataFrame(rows, SCHEMA), limits).collect())
    assert len({r[3] for r in want}) >= 5
    random.Random(4).shuffle(rows)  # passes out of turn, within the lateness
    end = (1000, 1, at(500), 0, 0, 1, 0, 1, 0, [])
    parts = [rows[: len(rows) // 2], rows[len(rows) // 2 :], [end], [(0, 1, at(1), 0, 0, 9, 0, 9, 9, ["left"]), (2000, 1, at(2), 0, 0, 9, 0, 9, 9, ["left"])]]
    for part in parts:  # each its own run on the same checkpoint; the last one's rows are late
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        passes = stream_outcomes(spark.readStream.schema(SCHEMA).parquet(source), limits, silence="30 minutes", lateness="20 minutes")
        q = passes.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    got = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert got == want
