"""What each job has read and how it ended; it stays known after the job has stopped."""

from __future__ import annotations

import threading
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from fillwatch.schemas import TABLES, Table
from fillwatch.streaming import store


@dataclass
class Line:
    """One start of a job."""

    name: str | None
    state: str = "running"
    batches: int = 0
    last_batch: int | None = None
    messages: int = 0
    error: str | None = None


class Ledger(StreamingQueryListener):
    """A line for each query that started in the session since the ledger was added to it.

    ``messages`` counts what the source gave; what was written is in the tables' logs
    (``batches``). Spark tells listeners of a batch some time after it is done.
    """

    def __init__(self) -> None:
        self._lines: dict[str, Line] = {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._lines.setdefault(str(event.runId), Line(event.name))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._changed:
            line = self._lines.setdefault(str(progress.runId), Line(progress.name))
            if progress.batchId != line.last_batch and progress.numInputRows:
                line.batches += 1
            line.last_batch = progress.batchId
            line.messages += progress.numInputRows
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            line = self._lines.setdefault(str(event.runId), Line(None))
            line.state = "failed" if event.exception else "ended"
            line.error = event.exception
            self._changed.notify_all()

    def lines(self) -> list[dict]:
        with self._changed:
            return [asdict(line) for line in self._lines.values()]

    def runs(self) -> list[str]:
        """The runs that started; Spark tells of a start before it returns from it."""
        with self._changed:
            return list(self._lines)

    def wait_until_over(self, run_id: str, seconds: float = 30) -> bool:
        """Whether word came within that time that this run is over."""
        with self._changed:
            return self._changed.wait_for(
                lambda: run_id in self._lines and self._lines[run_id].state != "running", seconds
            )


def batches(spark: SparkSession, root: str, table: Table | str) -> DataFrame:
    """Rows that each batch of each job wrote to a table, counted in its log; needs no running job."""
    table = TABLES[table] if isinstance(table, str) else table
    return (
        store.log(spark, root, table)
        .groupBy(F.lit(table.name).alias("table"), "source", "run", "batch_id")
        .agg(F.count("*").alias("rows"), F.max("written_at").alias("written_at"))
    )
