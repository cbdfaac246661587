"""Outcomes of repeated passes (ITER-1) as they are recorded: one state a key, passes in the order of their numbers, timers for keys that fall silent.

Passes that come before their turn wait in the state. A key's row is given out at the pass that ends it; passes that come later,
or again, change nothing. A key that stays silent for some time in event time is closed: passes that still
wait for a missing one are taken in order, and without an end the outcome is 'unfinished'. The rows are those of
operators.passes.outcomes() where no pass comes after its key was closed.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.passes import CLICKS, COUNTS, DONE, IDLE, LEFT, MOST, STABLE, TIMEOUTS, UNFINISHED, Limits, recorded

OUTPUT = "passes int, clicks long, outcome string, text long, html long, remaining long"
_STATE = "last int, row long, same int, clicks long, text long, html long, remaining long, done boolean"
_FRESH = (0, 0, 0, 0, -1, -1, 0, False)


def advance(state: tuple, p, limits: Limits) -> tuple[tuple, str | None]:
    """The state after a pass, and the outcome if it is the last."""
    last, row, same, clicks, text, html, _, _ = state
    row, stop, n = 0 if p["invoked"] > 0 else row, None, 0
    for e in p["events"]:
        clicked = e in CLICKS
        row, n = (0 if clicked else row + (e == "timeout")), n + clicked
        stop = LEFT if e == "left" else TIMEOUTS if row >= limits.timeouts else DONE if e == "cleared" else None
        if stop:
            break
    size = p["text_after"], p["html_after"]
    same = same + 1 if last and size == (text, html) else 0
    grown = size[0] - p["text_before"] >= limits.text_growth or size[1] - p["html_before"] >= limits.html_growth
    moved = p["invoked"] > 0 or n > 0 or grown
    stop = stop or (STABLE if same >= limits.stable else MOST if p["pass"] >= limits.passes else None if moved else IDLE)
    return (p["pass"], row, same, clicks + n + p["invoked"], *size, p["remaining"], stop is not None), stop


class Passes(StatefulProcessor):
    def __init__(self, limits: Limits, silence_ms: int, key: str, waiting: str):
        self.limits, self.silence_ms, self.key, self.kind = limits, silence_ms, key, waiting

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)
        self.waiting = handle.getMapState("waiting", "pass int", self.kind)

    def _row(self, key, state: tuple, outcome: str) -> Row:
        last, _, _, clicks, text, html, remaining, _ = state
        return Row(**dict(zip((self.key, "passes", "clicks", "outcome", "text", "html", "remaining"), (key[0], last, clicks, outcome, text, html, remaining), strict=True)))

    def _take(self, state: tuple, p: int) -> tuple[tuple, str | None]:
        row = dict(zip(("at", *COUNTS, "events"), self.waiting.getValue((p,)), strict=True))
        self.waiting.removeKey((p,))
        return advance(state, row | {"pass": p}, self.limits)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = tuple(self.state.get()) if self.state.exists() else _FRESH
        latest = 0
        for r in rows:
            latest = max(latest, r["at"] // 1000)
            p = r["pass"]
            if state[-1] or p <= state[0] or p > self.limits.passes:
                continue
            new = (r["at"], *(r[c] for c in COUNTS), list(r["events"]))
            if not self.waiting.containsKey((p,)) or new < tuple(self.waiting.getValue((p,))):
                self.waiting.updateValue((p,), new)
        outcome = None
        while not state[-1] and self.waiting.containsKey((state[0] + 1,)):
            state, outcome = self._take(state, state[0] + 1)
        if outcome:
            self.waiting.clear()
            yield self._row(key, state, outcome)
        self.state.update(state)
        timers = list(self.handle.listTimers())
        due = max([latest, timerValues.getCurrentWatermarkInMs()]) + self.silence_ms
        if not timers or due > max(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = tuple(self.state.get()) if self.state.exists() else _FRESH
        if not state[-1]:
            outcome = None
            for p in sorted(k[0] for k in self.waiting.keys()):  # at most as many as a key may have passes
                if outcome is None:
                    state, outcome = self._take(state, p)
            if state[0]:
                yield self._row(key, state, outcome or UNFINISHED)
        self.state.clear()
        self.waiting.clear()

    def close(self) -> None:
        pass


def stream_outcomes(rows: DataFrame, limits: Limits = Limits(), silence: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """outcomes() of a streaming table of passes, in append mode; needs the RocksDB state store.

    A key's state is at most limits.passes rows and goes when the key was silent for `silence` past the watermark."""
    passes = recorded(rows).withColumn("at", F.unix_micros("ts")).withWatermark("ts", lateness)
    amount, unit = silence.split()
    ms = int(amount) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]
    waiting = ", ".join(["at long", *(f"{c} long" for c in COUNTS), "events array<string>"])
    kind = rows.schema["key"].dataType.simpleString()
    return passes.groupBy("key").transformWithState(Passes(limits, ms, "key", waiting), f"key {kind}, {OUTPUT}", "Append", "EventTime")
