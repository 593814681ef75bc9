"""Control tables, gates, monitoring rollups, governance."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.catalog import views as v
from latebook.catalog.cleaning import all_errors
from latebook.catalog.registry import money, query
from latebook.operators import control as c
from latebook.operators import monitoring as m
from latebook.operators.governance import expire, policy_view, retained, role_view, tagged
from latebook.operators.settlement import settle
from latebook.operators.stamps import audit_stamp
from latebook.profiles import GATE_THRESHOLDS
from latebook.schemas import PROCESS_LOG
from latebook.sinks.tables import append_error_records, append_process_log, write_partitioned
from latebook.workspace import new_folder

STAGES = tuple(GATE_THRESHOLDS)
TIME = "yyyy-MM-dd HH:mm:ss"


@query("latest_process", v.sql("""
SELECT stage_name, entity_name, run_date, process_id, process_name, status,
       total_records_processed, total_records_error FROM last_run""", "last_run"))
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.latest_process(v.proc_log(spark, sf_dir)).select(
        "stage_name", "entity_name", "run_date", "process_id", "process_name", "status",
        "total_records_processed", "total_records_error")


@query("run_duration", v.sql("SELECT process_id, duration_seconds FROM proc_log", "proc_log"))
def duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.with_duration(v.proc_log(spark, sf_dir)).select("process_id", "duration_seconds")


@query("error_samples", v.sql("""
SELECT r.run_date, e.process_id, e.entity_name, e.error_type, e.error_message, e.error_time
FROM error_log e JOIN last_run r USING (process_id)
QUALIFY row_number() OVER (PARTITION BY process_id ORDER BY error_time, error_id) <= 10""",
                               "error_log", "last_run"))
def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.error_samples(v.proc_log(spark, sf_dir), v.error_log(spark, sf_dir))


@query("run_gate", v.sql("""
SELECT stage_name, entity_name, run_date, status, total_records_processed,
       total_records_error, duration_seconds, round(error_rate, 4) AS error_rate, threshold,
       status = 'SUCESSO' OR coalesce(error_rate <= threshold, FALSE) AS passed
FROM (SELECT *, CASE WHEN total_records_processed > 0
                     THEN total_records_error / total_records_processed END AS error_rate,
             CASE stage_name WHEN 'landing_to_bronze' THEN 0.05 WHEN 'bronze_to_silver' THEN 0.05
                  WHEN 'silver_to_gold' THEN 0.02 ELSE 0.1 END::DOUBLE AS threshold
      FROM last_run)""", "last_run"))
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.run_gate(v.proc_log(spark, sf_dir))


@query("overall_status", v.sql("""
SELECT run_date, count(*) AS n_stages,
       CASE WHEN bool_and(status = 'SUCESSO') THEN 'Sucesso'
            WHEN bool_or(status = 'ERRO') THEN 'Falha' ELSE 'Parcial' END AS overall_status
FROM last_run GROUP BY run_date""", "last_run"))
def overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.overall_status(c.latest_process(v.proc_log(spark, sf_dir)))


_SUMMARY_SQL = ",\n       ".join(
    f"count(*) FILTER (stage_name = '{s}') AS {s}_runs, "
    f"CAST(coalesce(sum(total_records_processed) FILTER (stage_name = '{s}'), 0) AS BIGINT) "
    f"AS {s}_records, "
    f"CAST(coalesce(sum(total_records_error) FILTER (stage_name = '{s}'), 0) AS BIGINT) "
    f"AS {s}_errors" for s in STAGES)


@query("run_summary", v.sql(f"""
SELECT run_date, {_SUMMARY_SQL}
FROM proc_log GROUP BY run_date""", "proc_log"))
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.run_summary(v.proc_log(spark, sf_dir))


@query("process_log_append", v.sql("""
SELECT process_id, entity_name, process_name, status,
       strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time,
       total_records_processed, total_records_error, run_date >= DATE '2024-01-16' AS second_run
FROM proc_log""", "proc_log"))
def process_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs of two runs in the control table, those of the second written twice, read back as
    one log."""
    logs = v.proc_log(spark, sf_dir)
    path = new_folder(spark, "process-logs")
    second = F.col("start_time") >= F.lit(dt.date(2024, 1, 16))
    for part, run in ((~second, "first"), (second, "second"), (second, "second")):
        append_process_log(c.as_process_log(logs.filter(part).withColumns({
            "start_time": F.date_format("start_time", TIME),
            "end_time": F.date_format("end_time", TIME)})), path, run)
    stored = spark.read.schema(PROCESS_LOG).parquet(path)
    return stored.select(
        "process_id", "entity_name", "process_name", "status", "start_time", "end_time",
        "total_records_processed", "total_records_error",
        (F.col("start_time") >= "2024-01-16").alias("second_run"))


@query("error_records_append", v.sql("""
SELECT entity_name, error_type, count(*) AS n_records, count(*) AS n_ids FROM (
  SELECT 'transactions' AS entity_name, 'DATA_VALIDATION_ERROR' AS error_type FROM tx_dirty
  WHERE transaction_id IS NULL OR customer_id IS NULL OR transaction_date IS NULL
     OR amount IS NULL
  UNION ALL SELECT 'transactions', 'DATE_CONSISTENCY_WARNING' FROM tx_unique
  WHERE due_date < transaction_date
  UNION ALL SELECT 'payments', 'DATA_VALIDATION_ERROR' FROM pay_dirty
  WHERE payment_date IS NULL
  UNION ALL SELECT 'payments', 'PAYMENT_VALUE_WARNING' FROM pay_unique WHERE amount_paid <= 0)
GROUP BY ALL""", "tx_unique", "pay_unique"))
def error_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors written, and written again by a retry, which replaces them."""
    path = new_folder(spark, "error-records")
    for _ in range(2):
        append_error_records(all_errors(spark, sf_dir), path, "run-1")
    return spark.read.parquet(path).groupBy("entity_name", "error_type").agg(
        F.count(F.lit(1)).alias("n_records"), F.countDistinct("error_id").alias("n_ids"))


@query("lineage_trace", """
SELECT 'orders.parquet' AS source_file, 'process-1' AS process_id,
       '20000615_000000' AS execution_id, count(*) AS n_rows FROM orders""")
def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each row's hash back to its file, process and execution, counted per file."""
    orders = v.table(spark, sf_dir, "orders").withColumn(
        "file", F.col("_metadata.file_path"))
    stamped = audit_stamp(orders, ingested_on=v.AS_OF.isoformat(), updated_at=v.STAMP,
                          process_id=v.PROCESS_ID, execution_id=v.WINDOW.execution_id,
                          source_file=F.col("file"), keys=["o_orderkey"])
    return stamped.groupBy(
        F.regexp_extract("source_file", r"(orders\.parquet)", 1).alias("source_file"),
        "process_id", "execution_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("retention_filter", """
SELECT event_id, CAST(ts AS DATE) AS dt_ingestao FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-21'""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by ingestion day; the filter skips the expired partitions."""
    events = v.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("date").alias("dt_ingestao"))
    path = write_partitioned(events, new_folder(spark, "ingested"), ["dt_ingestao"])
    return retained(spark.read.parquet(path), "dt_ingestao", dt.date(2024, 1, 31), 10)


@query("role_view", v.sql("""
SELECT transaction_id, substring(customer_id, 1, 2) || '****' || substring(customer_id, -2, 2)
         AS customer_id, CAST(transaction_date AS DATE) AS transaction_date, due_date, payment_id,
       CAST(payment_date AS DATE) AS payment_date
FROM joined""", "joined"))
def analyst_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A role without the PII and the Financial tag."""
    joined = settle(v.tx(spark, sf_dir), v.pay(spark, sf_dir))
    return role_view(joined, allowed=()).withColumns({
        "transaction_date": F.col("transaction_date").cast("date"),
        "payment_date": F.col("payment_date").cast("date")})


@query("policy_view", v.sql("""
SELECT transaction_id, sha256('salt' || customer_id) AS customer_id,
       CAST(transaction_date AS DATE) AS transaction_date, due_date, payment_id,
       CAST(payment_date AS DATE) AS payment_date
FROM joined""", "joined"))
def closed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same role by the tags in the schema: a pseudonym, no money, and nothing untagged."""
    joined = settle(v.tx(spark, sf_dir), v.pay(spark, sf_dir)).withColumns({
        "transaction_date": F.col("transaction_date").cast("date"),
        "payment_date": F.col("payment_date").cast("date"), "note": F.lit("untagged")})
    return policy_view(tagged(joined), allowed=(), salt="salt")


@query("retention_expire", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dropped_day, count(*) AS n_rows,
       '2024-01-21' AS first_kept
FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-21' GROUP BY ALL
UNION ALL
SELECT 'kept', count(*), '2024-01-21' FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-21'""")
def retention_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by ingestion day whose expired partitions are dropped: the audit, and what is left."""
    name = f"latebook_expire_{uuid.uuid4().hex[:8]}"
    (v.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("dt_ingestao"))
     .write.partitionBy("dt_ingestao").option("path", new_folder(spark, "expire")).saveAsTable(name))
    audit = expire(spark, name, "dt_ingestao", dt.date(2024, 1, 31), 10).drop("table_name")
    kept = spark.table(name).agg(F.count("*").alias("n_rows")).select(
        F.lit("kept").alias("dropped_day"), "n_rows", F.lit("2024-01-21").alias("first_kept"))
    return audit.union(kept)


@query("p95_duration", v.sql("""
SELECT entity_name, count(*) AS n_runs,
       round(quantile_cont(duration_seconds, 0.95), 4) AS p95_seconds
FROM proc_log GROUP BY entity_name""", "proc_log"))
def p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.duration_percentile(v.proc_log(spark, sf_dir), 0.95).select(
        "entity_name", "n_runs", money("p_duration", 4).alias("p95_seconds"))


@query("p95_merged", v.sql("""
SELECT entity_name, CAST(any_value(total) AS BIGINT) AS n_runs,
       round(CASE WHEN min(bucket) = -1000000 THEN 0
                  ELSE 2 * pow(1.01 / 0.99, min(bucket)) / (1.01 / 0.99 + 1) END, 4) AS p95_seconds
FROM (SELECT *, sum(n) OVER (PARTITION BY entity_name ORDER BY bucket) AS upto,
             sum(n) OVER (PARTITION BY entity_name) AS total
      FROM (SELECT entity_name, count(*) AS n,
                   CASE WHEN duration_seconds <= 0 THEN -1000000
                        ELSE CAST(ceil(ln(duration_seconds) / ln(1.01 / 0.99)) AS BIGINT) END AS bucket
            FROM proc_log GROUP BY ALL))
WHERE upto >= ceil(total * 0.95) GROUP BY entity_name""", "proc_log"))
def p95_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentile of all hours from the sketches of each, kept in a table."""
    path = new_folder(spark, "duration-sketches")
    m.duration_sketches(v.proc_log(spark, sf_dir)).write.parquet(path)
    return m.merged_percentile(spark.read.parquet(path), 0.95).select(
        "entity_name", "n_runs", money("p_duration", 4).alias("p95_seconds"))


@query("records_by_component", v.sql("""
SELECT process_name, entity_name, count(*) AS n_runs,
       CAST(sum(total_records_processed) AS BIGINT) AS records_processed,
       CAST(sum(total_records_error) AS BIGINT) AS records_error
FROM proc_log GROUP BY process_name, entity_name""", "proc_log"))
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.records_by_component(v.proc_log(spark, sf_dir))


@query("job_status", v.sql("""
SELECT process_name, CASE WHEN arg_max(status, (start_time, process_id)) = 'SUCESSO' THEN 1
                          ELSE 0 END AS job_status
FROM proc_log GROUP BY process_name""", "proc_log"))
def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.job_status(v.proc_log(spark, sf_dir))


@query("failures_24h", v.sql("""
SELECT entity_name, epoch_hour, failures,
       CAST(sum(failures) OVER (PARTITION BY entity_name ORDER BY epoch_hour
            RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) AS BIGINT) AS failures_24h
FROM (SELECT entity_name,
             CAST(datediff('day', DATE '1970-01-01', run_date) * 24 + hour(start_time)
                  AS INTEGER) AS epoch_hour,
             count(*) FILTER (status = 'ERRO') AS failures
      FROM proc_log GROUP BY ALL)""", "proc_log"))
def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.failures_24h(v.proc_log(spark, sf_dir))


@query("change_markers", v.sql("""
SELECT process_name, strftime(date_trunc('minute', start_time), '%Y-%m-%d %H:%M:%S') AS minute,
       CAST(sum(total_records_processed) AS BIGINT) AS records_added
FROM proc_log GROUP BY ALL HAVING sum(total_records_processed) > 0""", "proc_log"))
def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.change_markers(v.proc_log(spark, sf_dir))
