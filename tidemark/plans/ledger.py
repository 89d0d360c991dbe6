"""Catch-up with a run ledger (J3, J4): every run date since the start, one at
a time and in order; what is finished is skipped, what fails is tried again."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from tidemark import storage
from tidemark.operators.pageviews import as_date

DONE, FAILED, RUNNING = "done", "failed", "running"
#: Further tries of a run that failed (fixed value of the daily schedule).
RETRIES = 2


@dataclass
class Run:
    """One entry: the run dates ``first`` to ``last``."""

    first: str
    last: str
    state: str
    attempts: int
    error: str | None = None


class RunLedger:
    """One small file for each run, under the layer it speaks of.  A run's
    entry says ``running`` before its work begins and ``done`` only after its
    rows are written, so a job that was killed is found unfinished."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, first: dt.date) -> str:
        return f"{self.root}/{first.isoformat()}.json"

    def entry(self, first: dt.date) -> Run | None:
        if not storage.exists(self.spark, self._path(first)):
            return None
        return Run(**json.loads(storage.read_text(self.spark, self._path(first))))

    def record(self, run: Run) -> None:
        storage.write_text(self.spark, self._path(dt.date.fromisoformat(run.first)), json.dumps(asdict(run)))

    def entries(self) -> list[Run]:
        """All runs, by date."""
        return [Run(**json.loads(storage.read_text(self.spark, f"{self.root}/{x}"))) for x in storage.names(self.spark, self.root)]


class RunsFailed(RuntimeError):
    """Some runs failed in all their tries; the others are done."""

    def __init__(self, runs: list[Run]):
        super().__init__(f"{len(runs)} runs failed: " + "; ".join(f"{r.first}: {r.error}" for r in runs))
        self.runs = runs


def catch_up(ledger: RunLedger, start, end, work: Callable[[dt.date, dt.date], None], step_days: int = 1, retries: int = RETRIES) -> list[Run]:
    """Runs ``work(first, last)`` for each chunk of ``step_days`` run dates of
    [start, end], in order and one at a time.  Work that replaces its run's
    partitions may be repeated, so a chunk that was begun and not finished is
    done anew.  A chunk that fails is tried ``retries`` times more; then the
    next ones still run, and at the end the failed ones are reported together.
    Returns the runs done now; called again, only unfinished ones run."""
    first, last = as_date(start), as_date(end)
    now: list[Run] = []
    failed: list[Run] = []
    while first <= last:
        stop = min(last, first + dt.timedelta(days=step_days - 1))
        known = ledger.entry(first)
        if known is None or known.state != DONE or dt.date.fromisoformat(known.last) < stop:
            run = Run(first.isoformat(), stop.isoformat(), RUNNING, known.attempts if known else 0)
            for attempt in range(retries + 1):
                run.attempts += 1
                run.state, run.error = RUNNING, None
                ledger.record(run)
                try:
                    work(first, stop)
                    run.state = DONE
                    break
                except Exception as e:  # any failed try is a failed run, as for a scheduler
                    run.state, run.error = FAILED, f"{type(e).__name__}: {e}".splitlines()[0][:500]
                finally:
                    if run.state != RUNNING:  # a run that was interrupted stays unfinished
                        ledger.record(run)
            (now if run.state == DONE else failed).append(run)
        first = stop + dt.timedelta(days=1)
    if failed:
        raise RunsFailed(failed)
    return now
