"""Landing to bronze: every file not seen before, audited and upserted by its key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.functions import due_date, parse_timestamp
from latebook.operators.cleaning import dedupe
from latebook.operators.quarantine import error_records
from latebook.operators.stamps import audit_stamp
from latebook.plans.run import Run, recorded
from latebook.schemas import ENTITY_KEY, raw_schema
from latebook.sinks.tables import write_staged
from latebook.sinks.upsert import upsert
from latebook.sources.files import (
    CORRUPT, array_chunks, array_records, landing_formats, read_raw, read_whole_where_broken,
    split_corrupt, with_source,
)
from latebook.streaming.runner import finish, start_batches
from latebook.workspace import scratch

PARTITIONS = ("year", "month")
DATE_COLUMN = {"transactions": ("date", "transaction_date"),
               "payments": ("date_paid", "payment_date")}


def to_bronze(raw: DataFrame, entity: str, run: Run) -> DataFrame:
    """Raw rows with audit columns, event time, due date and partition columns."""
    text, when = DATE_COLUMN[entity]
    stamped = audit_stamp(
        raw, ingested_on=run.as_of.isoformat(), updated_at=run.started,
        process_id=run.process_id, execution_id=run.execution_id,
        source_file=F.col("source_file"), keys=[ENTITY_KEY[entity]])
    dated = stamped.withColumn(when, parse_timestamp(F.col(text)))
    if entity == "transactions":
        dated = dated.withColumn("due_date", due_date(F.col(text)))
    return dated.withColumns({"year": F.year(when), "month": F.month(when)})


def _load(raw: DataFrame, run: Run, table: str, multi_line: bool) -> None:
    """One set of files: broken records and those without a key to quarantine, the others into
    the table.

    All records without a key share one hash, so in the table only one of them would be left.
    The parsed records are staged first, so that each file is parsed once. Of the copies of a key
    that of the file written last stays.
    """
    spark, key = run.spark, ENTITY_KEY[run.entity]
    with scratch(spark, f"parsed-{run.entity}") as folder:
        parsed = spark.read.schema(raw.schema).parquet(write_staged(raw, folder))
        if multi_line:
            parsed = read_whole_where_broken(parsed, run.entity)
        good, bad = split_corrupt(parsed)
        rejects = bad.withColumn("_message", F.lit("Registro ilegível")).unionByName(
            good.filter(F.col(key).isNull()).withColumn("_message", F.lit(f"Registro sem {key}")),
            allowMissingColumns=True)
        run.errors(error_records(
            rejects.drop("source_modified"), error_type="DATA_VALIDATION_ERROR", entity=run.entity,
            process_id=run.process_id, error_time=run.started,
            source_file=F.col("source_file"), message=F.col("_message")), "rejects")
        good = good.filter(F.col(key).isNotNull())
        newest = [F.col("source_modified").desc(), F.col("source_file").desc()]
        unique = dedupe(good, [key], newest).drop("source_modified")
        upsert(spark, table, to_bronze(unique, run.entity, run), ["hash_chave"], ["source_file"],
               PARTITIONS, run.output_path, run.changed)
        run.count(processed=good.count(),
                  files=parsed.select("source_file").distinct().count())


def _new_files(run: Run, fmt: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """A stream of one format's raw records with their file."""
    stream = run.spark.readStream.option("pathGlobFilter", f"*.{fmt}")
    if fmt == "json" and multi_line:
        return with_source(array_records(array_chunks(stream).load(run.input_path), schema))
    if fmt == "json":
        raw = (stream.format(fmt).option("columnNameOfCorruptRecord", CORRUPT)
               .schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
               .load(run.input_path))
    else:
        raw = stream.format(fmt).schema(schema).load(run.input_path).withColumn(
            CORRUPT, F.lit(None).cast("string"))
    return with_source(raw)


def ingest(run: Run, table: str, *, multi_line: bool = True, newest_only: bool = False) -> None:
    """Bring the landing folder's new files of every format into a bronze table.

    Spark's file stream remembers in its checkpoint which files it has taken, one for each
    format, so a run takes all that came since the last one; ``newest_only`` takes the latest
    file of the preferred format instead. JSON files hold arrays, or with ``multi_line`` off one
    record per line.
    """
    spark, folder = run.spark, run.input_path
    with recorded(run):
        with run.phase("file_discovery"):
            formats = landing_formats(spark, folder)
        if not formats:
            run.nothing_to_do("Nenhum arquivo encontrado para processamento")
            return
        with run.phase("schema_validation"):
            schema = raw_schema(run.entity)
        with run.phase("data_loading"):
            if newest_only:
                raw = read_raw(spark, folder, run.entity, newest_only=True,
                               multi_line=multi_line)
                run.batch = f"{run.entity}-newest-{run.process_id}"
                _load(raw, run, table, multi_line)
                return
            for fmt in formats:
                def load(rows: DataFrame, batch_id: int, fmt: str = fmt) -> None:
                    run.batch = f"{run.entity}-{fmt}-{batch_id}"
                    _load(rows, run, table, multi_line and fmt == "json")

                finish(start_batches(
                    _new_files(run, fmt, schema, multi_line), load,
                    f"{run.control}/checkpoints/{run.entity}-{fmt}", trigger=None))
                run.batch = ""
