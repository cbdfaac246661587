"""Where repeated passes over a page come to rest, and why (ITER-1), from recorded passes.

A pass row has key, pass (from 1), ts, the lengths text_before, html_before, text_after and html_after, invoked (controls that
the pass's start invoked), remaining (controls left), and events, what its clicks did in order: 'click', 'timeout', 'error',
'left' (a click that went to another page) and 'cleared' (a click that left no control). A key's first pass that meets one of
these, in this order, is its last: a click left the page, too many timeouts in a row (clicks and invoked controls end a row,
passes and errors don't), no control is left ('ok'); the lengths stayed the same for some passes; the greatest number
of passes is reached; nothing was invoked, clicked or grew. Later passes don't count. A key without such a pass is 'unfinished'.

Null lengths and counts are 0, null events none, unknown events nothing; of rows that repeat a pass the earliest counts; rows without
key, pass or ts, or with a pass below 1, are no passes; missing numbers are skipped; an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.guideline import grew

LEFT, TIMEOUTS, DONE = "aborted_unexpected_navigation", "aborted_consecutive_timeouts", "ok"
STABLE, MOST, IDLE, UNFINISHED = "stopped_stable_body", "stopped_max_passes", "stopped_no_progress", "unfinished"
CLICKS = ("click", "left", "cleared")
COUNTS = ("text_before", "html_before", "text_after", "html_after", "invoked", "remaining")


@dataclass(frozen=True)
class Limits:
    """passes at most, passes of unchanged lengths, timeouts in a row, and the least growth of text and markup that is progress."""

    passes: int = 10
    stable: int = 2
    timeouts: int = 2
    text_growth: int = 1
    html_growth: int = 1


def recorded(rows: DataFrame) -> DataFrame:
    """The rows that are passes, without nulls in what is counted."""
    counts = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in COUNTS]
    events = F.array_compact(F.coalesce("events", F.array().cast("array<string>"))).alias("events")
    return rows.select("key", F.col("pass").cast("int").alias("pass"), "ts", *counts, events).where("key IS NOT NULL AND pass >= 1 AND ts IS NOT NULL")


def _clicks(events: Column, carry: Column, most: int) -> Column:
    """Clicks of a pass until one stops it, and the stop, after carry timeouts in a row."""

    def step(s, e):
        clicked = e.isin(*CLICKS)
        row = F.when(e == "timeout", s["row"] + 1).when(clicked, 0).otherwise(s["row"])
        stop = F.when(e == "left", LEFT).when(row >= most, TIMEOUTS).when(e == "cleared", DONE)
        return F.when(s["stop"].isNotNull(), s).otherwise(F.struct(row.cast("long").alias("row"), (s["clicks"] + clicked.cast("long")).alias("clicks"), stop.alias("stop")))

    start = F.struct(carry.cast("long").alias("row"), F.lit(0).cast("long").alias("clicks"), F.lit(None).cast("string").alias("stop"))
    return F.aggregate(events, start, step)


def outcomes(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(key, passes, clicks, outcome, text, html, remaining) of every key: its last pass, clicks and invoked controls up to it, and that pass's lengths.

    One shuffle by key serves the windows and the grouping. Passes beyond the greatest number can't count, so a key has a bounded number of rows."""
    rows = recorded(rows).where(F.col("pass") <= limits.passes)
    measures = [c for c in rows.columns if c not in ("key", "pass")]
    rows = rows.groupBy("key", "pass").agg(F.min(F.struct("ts", *[c for c in measures if c != "ts"])).alias("r")).select("key", "pass", "r.*")
    order = Window.partitionBy("key").orderBy("pass")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, -1)
    span = order.rowsBetween(-limits.stable, Window.currentRow)
    events, timed = F.col("events"), lambda x: F.size(F.filter(x, lambda e: e == "timeout"))
    # timeouts after the last click of a pass; all of them where only its start invoked something; null where no row ends
    tail = F.slice(events, F.size(events) - F.col("since") + 1, F.col("since"))
    since = F.aggregate(events, F.lit(-1), lambda n, e: F.when(e.isin(*CLICKS), 0).when(n >= 0, n + 1).otherwise(n))
    rows = rows.withColumn("since", since).withColumn("timed", timed(events)).withColumn("after", F.when(F.col("since") >= 0, timed(tail)).when(F.col("invoked") > 0, F.col("timed")))
    rows = rows.withColumn("all", F.sum("timed").over(so_far)).withColumn("ended", F.max(F.col("all") - F.col("after")).over(before))
    carry = F.when(F.col("invoked") > 0, 0).otherwise(F.col("all") - F.col("timed") - F.coalesce("ended", F.lit(0)))
    size = F.struct("text_after", "html_after")
    same = (F.count("*").over(span) > limits.stable) & (F.min(size).over(span) == F.max(size).over(span))
    rows = rows.withColumn("same", same).withColumn("c", _clicks(events, carry, limits.timeouts))
    moved = (F.col("invoked") > 0) | (F.col("c.clicks") > 0) | grew(F.col("text_before"), F.col("html_before"), F.col("text_after"), F.col("html_after"), limits.text_growth, limits.html_growth)
    stop = F.coalesce(F.col("c.stop"), F.when(F.col("same"), STABLE), F.when(F.col("pass") >= limits.passes, MOST), F.when(~moved, IDLE))
    rows = rows.withColumn("clicks", F.sum(F.col("c.clicks") + F.col("invoked")).over(so_far)).withColumn("outcome", stop)
    last = F.struct(F.col("pass").alias("passes"), "clicks", F.coalesce("outcome", F.lit(UNFINISHED)).alias("outcome"), F.col("text_after").alias("text"), F.col("html_after").alias("html"), "remaining")
    found = rows.groupBy("key").agg(F.coalesce(F.min(F.when(F.col("outcome").isNotNull(), last)), F.max(last)).alias("last"))
    return found.select("key", "last.*")
