"""One run of a stage: its ids, and its record in the control tables."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.operators.control import process_log_row, run_gate
from latebook.operators.quarantine import error_records
from latebook.profiles import STATUS_ERROR, STATUS_OK
from latebook.schemas import CHANGES, PROCESS_LOG
from latebook.sinks.tables import append_error_records, append_process_log, replace_slice
from latebook.workspace import subfolders

EMPTY = "CONCLUÍDO"
ALL = "all_entities"
TIME = "%Y-%m-%d %H:%M:%S"


def clock() -> str:
    return dt.datetime.now().strftime(TIME)


class GateClosed(RuntimeError):
    """The stage before has failed, or has too many errors."""


@dataclass
class Run:
    """``control`` is the folder of the control tables, shared by all stages.

    ``batch`` names the files at work, the same again when they are taken up after a failure.

    Without ``trust_status`` the stage before must keep to its error rate even if it succeeded.
    """

    spark: SparkSession
    control: str
    stage: str
    entity: str
    as_of: dt.date
    input_path: str = ""
    output_path: str = ""
    trust_status: bool = True
    process_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    batch: str = ""
    log: dict[str, object] = field(default_factory=dict)

    @property
    def execution_id(self) -> str:
        return dt.datetime.combine(self.as_of, dt.time()).strftime("%Y%m%d_%H%M%S")

    @property
    def stage_name(self) -> str:
        return re.sub(r"(?<=[a-z])(?=[A-Z])", "_", self.stage).lower()

    @property
    def started(self) -> str:
        return str(self.log["start_time"])

    @contextmanager
    def phase(self, name: str) -> Iterator[None]:
        self.log[f"{name}_start"] = clock()
        try:
            yield
        finally:
            self.log[f"{name}_end"] = clock()

    def count(self, processed: int = 0, failed: int = 0, files: int = 0) -> None:
        for name, n in (("records_processed", processed), ("records_error", failed),
                        ("files_processed", files)):
            self.log[f"total_{name}"] = int(self.log.get(f"total_{name}") or 0) + n

    def errors(self, records: DataFrame, step: str) -> None:
        """Write the error records of a step and count them.

        The step of a batch or run owns its part of the table, so a retry replaces what a failed
        attempt has left. They are counted in the writing tasks; a count further up could be off
        after a lost executor, because Spark repeats the tasks before a shuffle.
        """
        written = Observation()
        owner = f"{self.stage_name}-{self.entity}-{self.batch or self.process_id}-{step}"
        append_error_records(records.observe(written, F.count(F.lit(1)).alias("n")),
                             f"{self.control}/error_records", owner)
        self.count(failed=written.get["n"])

    def changed(self, partitions: list[Row]) -> None:
        """Note the partitions of the entity's table that a batch is about to change."""
        named = self.spark.createDataFrame(
            [(self.entity, self.process_id, self.batch, *r) for r in partitions],
            T.StructType([*CHANGES.fields[:3], *[T.StructField(c, T.IntegerType())
                                                 for c in partitions[0].asDict()]]))
        replace_slice(named, f"{self.control}/changes", "change", f"{self.batch}-{self.process_id}")

    def pending(self) -> DataFrame | None:
        """Changes of the entity that no run of this stage has taken up; None without a record."""
        spark, at = self.spark, f"{self.control}/changes"
        if not subfolders(spark, at):
            return None
        changes = spark.read.schema(CHANGES).parquet(at).filter(F.col("entity_name") == self.entity)
        done = f"{self.control}/changes_done/stage={self.stage_name}"
        if subfolders(spark, done):
            seen = spark.read.schema(CHANGES).parquet(done).select("process_id", "batch").distinct()
            changes = changes.join(seen, ["process_id", "batch"], "left_anti")
        return changes.select(*CHANGES.names)

    def take_up(self, changes: list[Row]) -> None:
        done = self.spark.createDataFrame(changes, CHANGES)
        replace_slice(done, f"{self.control}/changes_done/stage={self.stage_name}", "run",
                      self.process_id)

    def require(self, upstream: str) -> None:
        """Raise unless the last runs of the stage before, today and of this entity, let this
        one start. A stage of ``ALL`` entities looks at each; a stage without a log passes.
        """
        try:
            logs = self.spark.read.schema(PROCESS_LOG).parquet(f"{self.control}/process_logs")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return
            raise
        mine = logs.filter((F.col("stage_name") == upstream)
                           & F.col("start_time").startswith(self.started[:10]))
        if self.entity != ALL:
            mine = mine.filter(F.col("entity_name") == self.entity)
        closed = run_gate(mine, trust_status=self.trust_status).filter(~F.col("passed"))
        # One row per entity.
        found = [f"{r['entity_name']} ({r['status']}, {r['error_rate']})" for r in closed.collect()]
        if found:
            raise GateClosed(f"{upstream}: {', '.join(sorted(found))}")

    def nothing_to_do(self, reason: str) -> None:
        self.log.update(status=EMPTY, error_message=reason)


@contextmanager
def recorded(run: Run) -> Iterator[Run]:
    """Write the run's log when it ends, whatever happens; a failure is logged and raised."""
    run.log.update(start_time=clock(), status="STARTED", error_message="")
    run.count()
    try:
        yield run
        if run.log["status"] == "STARTED":
            run.log["status"] = STATUS_OK
    except Exception as error:
        run.log.update(status=STATUS_ERROR, error_message=str(error))
        failure = run.spark.createDataFrame([(type(error).__name__,)], "error string")
        run.errors(error_records(
            failure, error_type="PROCESS_FAILURE", entity=run.entity, process_id=run.process_id,
            error_time=clock(), source_file=run.input_path, message=str(error)), "failure")
        raise
    finally:
        append_process_log(process_log_row(
            run.spark, process_id=run.process_id, execution_id=run.execution_id,
            entity_name=run.entity, process_name=f"{run.stage}_{run.entity}", stage_name=run.stage_name, end_time=clock(),
            input_path=run.input_path, output_path=run.output_path, **run.log),
            f"{run.control}/process_logs", run.process_id)
