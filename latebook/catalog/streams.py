"""Streaming queries: the given tables as streams, run until all available rows are done.

The tables are a backlog: few large micro-batches, settled as tables. They run with the bounds of the job: any payment settles its transaction, however early or late. A
stream emits an unpaid transaction only once the watermark has passed its time to pay, so the
oracles leave out what the last watermark has not closed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.catalog import views as v
from latebook.catalog.classification import profile_rows
from latebook.catalog.registry import money, query
from latebook.plans.streams import PROMPT, StreamJob
from latebook.operators.rules import stream_profile
from latebook.schemas import RAW_PAYMENTS, RAW_TRANSACTIONS
from latebook.sinks.tables import write_partitioned
from latebook.sources.files import list_files
from latebook.streaming import sources as s
from latebook.streaming.backlog import backlog_writer, both_events
from latebook.streaming.batches import metrics_writer, stored_windows, window_writer
from latebook.streaming.metrics import window_alerts, window_metrics
from latebook.streaming.runner import (
    DETAIL_PARTITIONS, finish, sized_session, start_batches, start_table,
)
from latebook.workspace import new_folder

TIME = "yyyy-MM-dd HH:mm:ss"
FILES_PER_BATCH = 100
#: Runs of the job over which ``stream_batch_equal`` spreads the tables by date.
RUNS = 3


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as an unbounded stream, all available files at once.

    Written as a pattern, the path may be one file or a folder of files.
    """
    schema = v.table(spark, sf_dir, name).schema
    path = f"{sf_dir}/{{{name}.parquet}}"
    return s.file_stream(spark, path, schema, "parquet", max_files=None)


def _sized(spark: SparkSession, sf_dir: str, *names: str) -> SparkSession:
    """A session with as many state partitions as the size of the tables asks for."""
    sizes = [list_files(spark, f"{sf_dir}/{name}.parquet").select("file_size")
             for name in names]
    total = reduce(DataFrame.union, sizes).agg(F.sum("file_size")).first()[0]
    return sized_session(spark, total or 0)


def _raw_transactions(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"))
        .alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))


def _raw_payments(lineitem: DataFrame) -> DataFrame:
    """Every line is a payment of its own here; repeated line numbers are not repeats."""
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .alias("payment_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_extendedprice").alias("amount_paid"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_paid"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.transaction_events(_raw_transactions(_stream(spark, sf_dir, "orders")))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.payment_events(_raw_payments(_stream(spark, sf_dir, "lineitem")))


def _to_table(spark: SparkSession, df: DataFrame, name: str,
              partition_by: tuple[str, ...] = ()) -> DataFrame:
    path = new_folder(spark, name)
    finish(start_table(df, f"{path}/table", f"{path}/checkpoint", partition_by, trigger=None))
    return spark.read.schema(df.schema).parquet(f"{path}/table")


def _settle(spark: SparkSession, sf_dir: str, name: str, how: str = "left_outer",
            rows_of: Callable[[DataFrame], DataFrame] = lambda rows: rows,
            partition_by: tuple[str, ...] = ()) -> tuple[str, T.StructType]:
    """Run the settled stream into a table with a folder for each batch: its path and its schema."""
    path, sides = new_folder(spark, name), (transactions(spark, sf_dir), payments(spark, sf_dir))
    kept: list[T.StructType] = []

    def put(rows: DataFrame, batch_id: int) -> None:
        rows = rows_of(rows)
        kept.append(T.StructType([*rows.schema, T.StructField("batch", T.LongType())]))
        write_partitioned(rows, f"{path}/table/batch={batch_id}", partition_by) if partition_by else (
            rows.write.mode("overwrite").parquet(f"{path}/table/batch={batch_id}"))

    write = backlog_writer(spark, *sides, f"{path}/backlog", put, PROMPT, how)
    finish(start_batches(both_events(*sides), write, f"{path}/checkpoint", trigger=None))
    return f"{path}/table", kept[-1]


def _settled(spark: SparkSession, sf_dir: str, name: str, how: str = "left_outer") -> DataFrame:
    path, schema = _settle(spark, sf_dir, name, how)
    return spark.read.schema(schema).parquet(path).drop("batch")


def _detail_table(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    return _settle(spark, sf_dir, "stream-detail", rows_of=lambda rows: stream_profile(rows, v.AS_OF),
                   partition_by=DETAIL_PARTITIONS)


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _detail_table(spark, sf_dir)
    return spark.read.schema(schema).parquet(path).drop("batch")


def _detail_stream(spark: SparkSession, sf_dir: str, max_files: int | None) -> DataFrame:
    """The detail table, as written so far, as a stream of its own."""
    path, schema = _detail_table(spark, sf_dir)
    sized = _sized(spark, sf_dir, "orders", "lineitem")
    return s.file_stream(sized, path, schema, "parquet", max_files=max_files).drop("batch")


_STREAMS = {
    "spay": """
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS payment_id,
         CAST(l_orderkey AS VARCHAR) AS transaction_id, l_extendedprice AS payment_amount,
         l_shipdate AS payment_date
  FROM lineitem""",
    "mark": """
  SELECT least((SELECT max(transaction_date) FROM tx), (SELECT max(payment_date) FROM spay))
         - INTERVAL 2 HOUR AS closed_at""",
    "paid_rows": """
  SELECT t.*, p.payment_id, p.payment_amount, p.payment_date
  FROM tx t JOIN spay p USING (transaction_id)""",
    "unpaid_after": """
  SELECT t.* FROM tx t
  WHERE transaction_date + INTERVAL 61 DAY < (SELECT closed_at FROM mark)""",
    "closed": """
  SELECT * FROM paid_rows
  UNION ALL BY NAME
  SELECT * FROM unpaid_after u
  WHERE NOT EXISTS (SELECT 1 FROM spay p WHERE p.transaction_id = u.transaction_id
                    AND p.payment_date <= u.transaction_date + INTERVAL 61 DAY)""",
    "current_rows": """
  SELECT * FROM paid_rows
  UNION ALL BY NAME
  SELECT * FROM unpaid_after u
  WHERE NOT EXISTS (SELECT 1 FROM spay p WHERE p.transaction_id = u.transaction_id)""",
    "detail": """
  SELECT *, c1 OR c2 AS inadimplente
  FROM (SELECT *, transaction_date >= DATE '2000-06-15' - 90 AND days_late > 30 AS c1,
               transaction_date >= DATE '2000-06-15' - 180 AND days_late > 15 AS c2
        FROM (SELECT *, CAST(greatest(0, datediff('day', due_date,
                     coalesce(CAST(payment_date AS DATE), DATE '2000-06-15'))) AS INTEGER)
                     AS days_late FROM {}))""",
}
_CURRENT = {**_STREAMS, "detail": _STREAMS["detail"].format("current_rows")}
_STREAMS["detail"] = _STREAMS["detail"].format("closed")
_PAIR = """
SELECT transaction_id, customer_id, amount AS value, strftime(transaction_date, '%Y-%m-%d')
         AS transaction_day, due_date, payment_id, payment_amount,
       strftime(payment_date, '%Y-%m-%d') AS payment_day"""


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id", "customer_id", "value",
        F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_day"), "due_date",
        "payment_id", "payment_amount",
        F.date_format("payment_date", "yyyy-MM-dd").alias("payment_day"))


@query("stream_join_inner", v.sql(
    f"{_PAIR} FROM paid_rows", "tx", **_STREAMS))
def stream_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(_settled(spark, sf_dir, "stream-inner", "inner"))


@query("stream_join_outer", v.sql(f"{_PAIR} FROM closed", "tx", **_STREAMS))
def stream_join_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(_settled(spark, sf_dir, "stream-outer"))


_DETAIL_SQL = """
SELECT transaction_id, payment_id, days_late, c1 AS criterio_1, c2 AS criterio_2, inadimplente,
       '2000-06' AS reference_month, '2000-Q2' AS reference_quarter,
       CAST(year(transaction_date) AS INTEGER) AS year,
       CAST(month(transaction_date) AS INTEGER) AS month
FROM detail"""


def _detail_rows(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "payment_id", "days_late", "criterio_1", "criterio_2",
                     "inadimplente", "reference_month", "reference_quarter",
                     F.col("year").cast("int").alias("year"),
                     F.col("month").cast("int").alias("month"))


@query("stream_detail", v.sql(_DETAIL_SQL, "tx", **_STREAMS))
def stream_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail_rows(_detail(spark, sf_dir))


@query("stream_batch_equal", v.sql(_DETAIL_SQL, "tx", **_CURRENT))
def stream_batch_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settled table after several runs of the job, each over a later part of the tables:
    early payments wait for their transactions, unpaid rows leave once a payment comes, and what
    stands in the end is the batch join."""
    path = new_folder(spark, "stream-settled")
    job = StreamJob(f"{path}/out", f"{path}/checkpoints", trigger=None, as_of=v.AS_OF, backlog=True)
    given = {"tx": (_raw_transactions(v.table(spark, sf_dir, "orders")), "date", RAW_TRANSACTIONS),
             "pay": (_raw_payments(v.table(spark, sf_dir, "lineitem")), "date_paid", RAW_PAYMENTS)}
    ends = [raw.agg(F.min(day), F.max(day)).first() for raw, day, _ in given.values()]
    begin, end = (dt.date.fromisoformat(f(e[i] for e in ends)) for i, f in ((0, min), (1, max)))
    borders = [str(begin + (end - begin) * n / RUNS) for n in range(1, RUNS)]
    for low, high in zip(["", *borders], [*borders, "9999"], strict=True):
        for name, (raw, day, _) in given.items():
            inside = (F.col(day) >= low) & (F.col(day) < high)
            raw.filter(inside).write.mode("append").parquet(f"{path}/{name}")
        streams = [s.file_stream(spark, f"{path}/{name}", schema, "parquet", max_files=None)
                   for name, (_, _, schema) in given.items()]
        finish(job.detail(s.transaction_events(streams[0]), s.payment_events(streams[1])))
    return _detail_rows(job.detail_rows(spark))


@query("stream_parquet_sink", v.sql("""
SELECT '2000-06' AS reference_month, CAST(year(transaction_date) AS INTEGER) AS year,
       CAST(month(transaction_date) AS INTEGER) AS month, inadimplente, count(*) AS n
FROM detail GROUP BY ALL""", "tx", **_STREAMS))
def stream_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition of the table that the settled stream writes."""
    return _detail(spark, sf_dir).groupBy(
        "reference_month", F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"), "inadimplente",
    ).agg(F.count(F.lit(1)).alias("n"))


_METRICS_SQL = """
  SELECT strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(transaction_date + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
         '2000-06' AS reference_month, '2000-Q2' AS reference_quarter,
         count(*) AS total_transactions,
         count(*) FILTER (inadimplente) AS total_inadimplentes,
         count(*) FILTER (days_late > 0) AS total_atrasados,
         round(avg(days_late), 4) AS media_dias_atraso, max(days_late) AS max_dias_atraso,
         min(days_late) FILTER (days_late > 0) AS min_dias_atraso_positivo,
         round(count(*) FILTER (inadimplente) * 100.0 / count(*), 4) AS percentual_inadimplentes
  FROM {} GROUP BY transaction_date"""
_ALERT_SQL = """
SELECT window_start, window_end, reference_month, reference_quarter, total_transactions,
       total_inadimplentes, percentual_inadimplentes
FROM metrics WHERE percentual_inadimplentes > 20"""


def _windows(df: DataFrame) -> DataFrame:
    shown = df.withColumns({
        "window_start": F.date_format("window_start", TIME),
        "window_end": F.date_format("window_end", TIME),
        "percentual_inadimplentes": money("percentual_inadimplentes", 4)})
    if "media_dias_atraso" in df.columns:
        shown = shown.withColumn("media_dias_atraso", money("media_dias_atraso", 4))
    return shown


def _stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream reads the detail table in several batches and keeps its windows."""
    metrics = window_metrics(_detail_stream(spark, sf_dir, FILES_PER_BATCH))
    path = new_folder(spark, "stream-metrics")
    finish(start_batches(metrics, window_writer(f"{path}/states"), f"{path}/checkpoint",
                         trigger=None, mode="update"))
    return stored_windows(spark, f"{path}/states", metrics.schema)


@query("stream_window_metrics", v.sql("SELECT * FROM metrics", "tx", **_STREAMS,
                                      metrics=_METRICS_SQL.format("detail")))
def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_stream_windows(spark, sf_dir))


@query("stream_window_alerts", v.sql(_ALERT_SQL, "tx", **_STREAMS,
                                     metrics=_METRICS_SQL.format("detail")))
def stream_window_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(window_alerts(_stream_windows(spark, sf_dir)))


_PROFILE = {"flagged": """
  SELECT *, (transaction_date >= DATE '2000-06-15' - 90 AND days_late > 30)
         OR (transaction_date >= DATE '2000-06-15' - 180 AND days_late > 15) AS inadimplente
  FROM (SELECT *, CAST(greatest(0, dias_atraso) AS INTEGER) AS days_late FROM joined)"""}


def _batch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile_rows(spark, sf_dir)
    return window_metrics(rows.withColumn(
        "transaction_date", F.col("transaction_date").cast("timestamp")))


@query("window_metrics", v.sql("SELECT * FROM metrics", "joined", **_PROFILE,
                               metrics=_METRICS_SQL.format("flagged")))
def batch_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_batch_windows(spark, sf_dir))


@query("window_alerts", v.sql(_ALERT_SQL, "joined", **_PROFILE,
                              metrics=_METRICS_SQL.format("flagged")))
def batch_window_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(window_alerts(_batch_windows(spark, sf_dir)))


@query("batch_metrics", v.sql("""
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS total_records,
       count(*) FILTER (inadimplente) AS default_count,
       count(*) FILTER (NOT inadimplente) AS non_default_count,
       round(count(*) FILTER (inadimplente) * 100.0 / count(*), 4) AS default_percentage,
       count(*) FILTER (inadimplente) AS detail_rows,
       '2000-06-15' AS day
FROM detail""", "tx", **_STREAMS))
def per_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics row and delinquent rows that the batch function stored for each batch."""
    path = new_folder(spark, "batches")
    write = metrics_writer(path, clock=lambda: dt.datetime.combine(v.AS_OF, dt.time()))
    finish(start_batches(_detail_stream(spark, sf_dir, None), write,
                         f"{path}/checkpoint", trigger=None))
    rows = spark.read.parquet(f"{path}/defaulters_details").groupBy(
        F.col("batch").cast("long").alias("batch_id")).agg(F.count(F.lit(1)).alias("detail_rows"))
    day = F.make_date("year", "month", "day").cast("string")
    return spark.read.parquet(f"{path}/metrics").withColumn("day", day).join(
        rows, "batch_id", "left").select(
        "batch_id", "total_records", "default_count", "non_default_count",
        money("default_percentage", 4).alias("default_percentage"),
        F.coalesce("detail_rows", F.lit(0)).alias("detail_rows"), "day")


@query("stream_dedupe", """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events""")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered twice."""
    events = _stream(_sized(spark, sf_dir, "events"), sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    unique = s.unique_within(events, ["event_id"], "ts", "1 hour").drop("delivery")
    return _to_table(spark, unique, "stream-dedupe").select(
        "event_id", "user_id", "event_type", F.date_format("ts", TIME).alias("time"))


@query("stream_file_source", v.sql("""
SELECT transaction_id, customer_id, amount, date FROM tx_raw_dirty""", "tx_raw_dirty"))
def stream_file_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON files, one per trigger."""
    folder = new_folder(spark, "stream-landing")
    v.tx_raw_dirty(spark, sf_dir).select(*RAW_TRANSACTIONS.fieldNames()).write.json(folder)
    return _to_table(spark, s.file_stream(spark, folder, RAW_TRANSACTIONS), "stream-files")
