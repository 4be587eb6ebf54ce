"""Backfill of one table between marks, and following a log for good."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import changes, reconcile, snapshot
from tidemark.operators.spec import TableSpec
from tidemark.shared import materialize, remove
from tidemark.sources.config import State

log = logging.getLogger("tidemark")


def follow(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False, every: str = "5 seconds") -> StreamingQuery:
    """Hand every micro-batch of a streaming log (a column ``pos`` at least) to ``apply``, with its last position.

    A batch that runs again after a failure must change nothing; targets see to that, as
    every row keeps the position it comes from.  A batch is read once.
    """

    def write(batch: DataFrame, _: int) -> None:
        held = batch.persist()
        try:
            if (pos := held.agg(F.max("pos")).head()[0]) is not None:
                apply(held, pos)
        finally:
            held.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


class WindowInterrupted(RuntimeError):
    """A chunk's window did not close; the chunk is read again later."""


def await_mark(find: Callable[[], int | None], head: Callable[[], int | None], timeout: float, pause: float = 1.0, clock=time.monotonic, sleep=time.sleep) -> int | None:
    """The position of a mark once ``find`` has it, or None after ``timeout`` seconds in which the log's ``head`` stood still."""
    seen, since = head(), clock()
    while (pos := find()) is None:
        if (now := head()) != seen:
            seen, since = now, clock()
        elif clock() - since >= timeout:
            return None
        sleep(pause)
    return pos


@dataclass
class Counts:
    chunks: int = 0
    copied: int = 0
    superseded: int = 0


class Backfill:
    """Copies a table in key order while its changes go on.

    ``read`` gives the rows behind a key, ``size`` at most, or all of them at once (``whole``),
    as they are at the source; ``convert`` turns them into rows of the target.  ``mark``
    gives the position of a mark set in the log now, or None.  ``advance`` brings *all*
    targets up to a position, so that no table's events are passed over, and ``ops`` gives this
    table's operations between two positions.  A chunk is written only after its window has
    closed, so an interrupted one leaves nothing behind but the events it applied.
    """

    def __init__(
        self,
        spec: TableSpec,
        read: Callable[[list | None, int], DataFrame],
        ops: Callable[[int, int], DataFrame],
        mark: Callable[[], int | None],
        advance: Callable[[int], None],
        target,
        state: State,
        size: int = 1000,
        whole: bool = False,
        convert: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> None:
        self.spec, self.read, self.ops, self.mark, self.advance, self.target, self.state = spec, read, ops, mark, advance, target, state
        self.size, self.whole, self.convert = size, whole, convert

    def run(self, stop: Callable[[], bool] = lambda: False) -> Counts:
        """Chunk by chunk, from where the state says, until none is left or ``stop``."""
        progress, counts = self.state.progress(self.spec), Counts()
        while not progress.done and not stop():
            self._chunk(progress, counts)
            self.state.save()
        return counts

    def _chunk(self, progress, counts: Counts) -> None:
        low = self.mark()
        chunk = self.read(progress.last_key, self.size)
        # written between the marks: a lost copy that is read again later would be of another moment
        chunk = chunk if self.whole else materialize(chunk, "chunk")
        try:
            last = None if self.whole else snapshot.cursor(chunk, self.spec.keys)
            high = self.mark()
            if low is None or high is None:
                raise WindowInterrupted(f"{self.spec.source}: no mark came back from the log")
            self.advance(high)
            if self.whole or last is not None:
                self._write(chunk, low, high, counts)
                progress.last_key = last
            if self.whole or last is None:
                progress.done = True
                self.target.purge()
        finally:
            if not self.whole:
                remove(chunk)

    def _write(self, chunk: DataFrame, low: int, high: int, counts: Counts) -> None:
        """Rows whose key did not change in the window."""
        read, fresh = Observation(), Observation()
        rows = self.convert(chunk).observe(read, F.count(F.lit(1)).alias("n"))
        kept = reconcile.fresh(rows, reconcile.changed_keys(self.ops(low, high), self.spec.keys, low, high), self.spec.keys) if high > low else rows
        self.target.apply(reconcile.stamp(kept.observe(fresh, F.count(F.lit(1)).alias("n")), low))
        n, copied = read.get.get("n", 0), fresh.get.get("n", 0)
        counts.chunks, counts.copied, counts.superseded = counts.chunks + 1, counts.copied + copied, counts.superseded + n - copied
        log.info("%s: %d rows fresh, %d superseded of %d", self.spec.source, copied, n - copied, n)


def cut_to_commits(log_rows: DataFrame, upto: int | None = None) -> DataFrame:
    """Only rows of transactions that are complete."""
    cut = changes.commit_cut(log_rows, upto)
    return log_rows.where(F.col("pos") <= (cut if cut is not None else -1))
