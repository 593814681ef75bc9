"""The streaming jobs: one settles and writes the detail, the others read the detail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from latebook.operators.rules import stream_profile
from latebook.schemas import STREAM_DETAIL
from latebook.streaming.backlog import backlog_writer, both_events
from latebook.streaming.batches import (
    alert_writer, metrics_writer, settlement_writer, stored_windows, window_writer,
)
from latebook.streaming.detail import Bounds, settle_streams
from latebook.streaming.metrics import window_metrics
from latebook.streaming.runner import TRIGGER, keep_state_on_disk, start_batches
from latebook.streaming.sources import file_stream


# Any payment of a transaction settles it, however early or late. Unpaid rows come while both
# criteria can hold: the term of 30 days and 31 days of delay end 61 days after the transaction,
# and criterion 1 looks 90 days back.
PROMPT = Bounds(before=None, within=None, unpaid_after="61 days")


@dataclass(frozen=True)
class StreamJob:
    """Where the tables and checkpoints go, how often, and as of which day.

    Without ``as_of`` every micro-batch uses its own current date. With ``backlog`` the detail joins
    few large micro-batches as tables, which stay under the checkpoints; by default it keeps a
    state for many small ones. A job keeps to one of the two for as long as its checkpoints live.
    """

    output: str
    checkpoints: str
    bounds: Bounds = PROMPT
    trigger: str | None = TRIGGER
    as_of: dt.date | None = None
    backlog: bool = False

    def _day(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

    @property
    def table(self) -> str:
        return f"{self.output}/inadimplencia_detalhes"

    @property
    def changes(self) -> str:
        return f"{self.output}/inadimplencia_mudancas"

    def detail(self, transactions: DataFrame, payments: DataFrame) -> StreamingQuery:
        """The settled rows in ``table``, true to all payments so far, and every row in
        ``changes``, which the other streams read."""
        checkpoint = f"{self.checkpoints}/inadimplencia_detalhes"
        write = settlement_writer(self.table, self.changes, self.bounds.waits)
        if self.backlog:
            joined = backlog_writer(
                transactions.sparkSession, transactions, payments, f"{checkpoint}_eventos",
                lambda rows, n: write(stream_profile(rows, self._day()), n), self.bounds)
            return start_batches(both_events(transactions, payments), joined, checkpoint, self.trigger)
        keep_state_on_disk(transactions.sparkSession)
        rows = stream_profile(settle_streams(transactions, payments, self.bounds), self._day())
        return start_batches(rows, write, checkpoint, self.trigger)

    def detail_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(STREAM_DETAIL).parquet(self.table).select(*STREAM_DETAIL.names)

    def detail_stream(self, spark: SparkSession) -> DataFrame:
        return file_stream(spark, self.changes, STREAM_DETAIL, "parquet", max_files=None)

    def metrics(self, spark: SparkSession) -> StreamingQuery:
        """The states of the windows; ``windows`` gives the newest."""
        keep_state_on_disk(spark)
        return start_batches(
            window_metrics(self.detail_stream(spark)),
            window_writer(f"{self.output}/inadimplencia_metricas"),
            f"{self.checkpoints}/inadimplencia_metricas", self.trigger, mode="update")

    def windows(self, spark: SparkSession) -> DataFrame:
        states = window_metrics(spark.createDataFrame([], STREAM_DETAIL)).schema
        return stored_windows(spark, f"{self.output}/inadimplencia_metricas", states)

    def alerts(self, spark: SparkSession,
               notify: Callable[[int, DataFrame], None] | None = None) -> StreamingQuery:
        """An alert whenever a window passes the limit."""
        keep_state_on_disk(spark)
        return start_batches(window_metrics(self.detail_stream(spark)),
                             alert_writer(f"{self.output}/inadimplencia_alertas", notify),
                             f"{self.checkpoints}/inadimplencia_alertas", self.trigger,
                             mode="update")

    def batch_metrics(self, spark: SparkSession) -> StreamingQuery:
        return start_batches(self.detail_stream(spark), metrics_writer(self.output),
                             f"{self.checkpoints}/batch_metrics", self.trigger)
