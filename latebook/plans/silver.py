"""Bronze to silver: clean, check, stamp, write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from latebook.operators import cleaning, quarantine
from latebook.operators.quality import SUITES, failed_checks, run_suite
from latebook.operators.stamps import quality_stamp
from latebook.plans.run import Run, recorded
from latebook.sinks.tables import write_partitioned, write_plain
from latebook.workspace import delete_folder, scratch, subfolders

PARTITIONS = ["year", "month"]
# The latest copy of a key is the one ingested last.
NEWEST = ("dt_atualizacao", "source_file")


def refine(run: Run, bronze: DataFrame) -> DataFrame:
    """Bring the silver table of an entity up to date with bronze, and write the error records;
    returns the table.

    Bronze notes the partitions that each batch changes. Only those that no run has taken up are
    cleaned and written again; a key lives in one partition, so that is as good as all. Rejects
    are logged for the batches taken up, so each is logged once. Without a table or such notes
    everything is done.

    The deduplicated rows are staged in the shared folder: the table and the error
    records both derive from them, without deduplicating twice.
    """
    entity, spark = run.entity, run.spark
    newest = [F.col(c).desc() for c in NEWEST if c in bronze.columns]
    with recorded(run):
        run.require("landing_to_bronze")
        changes = run.pending()
        noted = None if changes is None else changes.collect()  # batches times their partitions
        partial = noted is not None and bool(subfolders(spark, run.output_path))
        if partial and not noted:
            run.nothing_to_do("Nenhuma mudança para processamento")
            return _written(run, bronze)
        rows, fresh = bronze, bronze
        touched = sorted({(r["year"], r["month"]) for r in noted or ()}, key=str)
        if partial:
            rows = bronze.filter(_inside(touched))
            fresh = rows.filter(F.col("process_id").isin(sorted({r["process_id"] for r in noted})))
        with run.phase("data_transformation"), scratch(spark, f"unique-{entity}") as folder:
            unique = cleaning.unique_valid(rows, entity, newest)
            unique = spark.read.schema(unique.schema).parquet(write_plain(unique, folder))
            remarked = (unique if not partial else unique.filter(
                F.col("process_id").isin(sorted({r["process_id"] for r in noted}))))
            run.errors(quarantine.error_records(
                quarantine.issues(fresh, remarked, entity),
                error_type=F.col("error_type"), entity=entity, process_id=run.process_id,
                error_time=run.started, source_file=run.input_path), "issues")
            with run.phase("data_writing"):
                stamped = quality_stamp(cleaning.FINISH[entity](unique, run.started),
                                        process_id=run.process_id, stamped_at=run.started)
                write_partitioned(stamped, run.output_path, PARTITIONS,
                                  replace_partitions=partial)
        if partial:
            _drop_emptied(run, stamped.schema, touched)
        silver = spark.read.schema(stamped.schema).parquet(run.output_path)
        written = silver.filter(_inside(touched)) if partial else silver
        with run.phase("data_validation"):
            failures = failed_checks(run_suite(written, SUITES[entity]))
            message = F.concat_ws(" ", F.lit("Falha na validação de qualidade:"),
                                  F.col("check_name"), F.col("column_name"))
            run.errors(quarantine.error_records(
                failures, error_type="DATA_QUALITY_ERROR", entity=entity,
                process_id=run.process_id, error_time=run.started, source_file=run.output_path,
                message=message), "quality")
        run.count(processed=written.count())
        if noted:
            run.take_up(noted)
    return silver


def _inside(partitions: list[tuple]) -> Column:
    return reduce(lambda a, b: a | b, [
        F.col("year").eqNullSafe(F.lit(y)) & F.col("month").eqNullSafe(F.lit(m))
        for y, m in partitions], F.lit(False))


def _drop_emptied(run: Run, schema: StructType, touched: list[tuple]) -> None:
    """Delete the partitions of which no row is left; an overwrite by partitions keeps them."""
    written = run.spark.read.schema(schema).parquet(run.output_path).filter(_inside(touched))
    filled = {tuple(r) for r in written.filter(F.col("processo_id") == run.process_id)
              .select(*PARTITIONS).distinct().collect()}
    for year, month in touched:
        if (year, month) not in filled and year is not None:
            delete_folder(run.spark, f"{run.output_path}/year={year}/month={month}")


def _written(run: Run, bronze: DataFrame) -> DataFrame:
    """The silver table as it stands."""
    shape = quality_stamp(cleaning.FINISH[run.entity](
        cleaning.unique_valid(bronze, run.entity, []), ""), process_id="", stamped_at="")
    return run.spark.read.schema(shape.schema).parquet(run.output_path)
