"""Files, formats, contracts, payloads and table writes, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.catalog import views as v
from latebook.catalog.classification import gold, published
from latebook.catalog.registry import money, query
from latebook.plans.bronze import ingest
from latebook.plans.run import Run
from latebook.schemas import ERROR_RECORDS, RAW_TRANSACTIONS
from latebook.sinks.tables import (
    append_or_create, replace_slice, write_bucketed, write_partitioned, write_plain,
)
from latebook.sinks.upsert import upsert
from latebook.sources import files
from latebook.sources.broker import dead_letters, decode_messages, offset_gaps
from latebook.sources.contracts import to_canonical, to_stream_names
from latebook.workspace import new_folder

MARKS = {"orders": "transactions", "lineitem": "payments"}


def _day(column: str):
    return F.col(column).cast("date").alias(column)


def _tx_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.tx(spark, sf_dir).withColumns({
        "year": F.year("transaction_date"), "month": F.month("transaction_date")})


def _tx_rows(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "customer_id", "amount", _day("transaction_date"),
                     "due_date", F.col("year").cast("int").alias("year"),
                     F.col("month").cast("int").alias("month"))


_TX_ROWS = """
SELECT transaction_id, customer_id, amount, CAST(transaction_date AS DATE) AS transaction_date,
       due_date, CAST(year(transaction_date) AS INTEGER) AS year,
       CAST(month(transaction_date) AS INTEGER) AS month
FROM tx"""


@query("scan_parquet", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType())])
    rows, _ = files.read_parquet(spark, f"{sf_dir}/orders.parquet", schema,
                                 entity="transactions", process_id=v.PROCESS_ID,
                                 error_time=v.STAMP)
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("scan_json", v.sql("""
SELECT transaction_id, customer_id, amount, date FROM tx_raw_dirty""", "tx_raw_dirty"))
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as JSON lines, found in its landing folder and read under its schema."""
    folder = new_folder(spark, "landing/transactions")
    v.tx_raw_dirty(spark, sf_dir).select(*RAW_TRANSACTIONS.fieldNames()).write.json(folder)
    raw = files.read_raw(spark, folder, "transactions", multi_line=False)
    good, _ = files.split_corrupt(raw)
    return good.drop("source_file", "source_modified")


@query("table_scan", v.sql(_TX_ROWS, "tx"))
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_plain(_tx_with_parts(spark, sf_dir), new_folder(spark, "silver-tx"))
    return _tx_rows(files.read_table(spark, "latebook_no_such_table", path))


@query("route_entity", """
SELECT page_id, CASE WHEN contains(lower(url), 'transaction') THEN 'transactions'
                     WHEN contains(lower(url), 'payment') THEN 'payments' END AS entity
FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url || '/Transactions/a.json'
                      WHEN 1 THEN url || '/PAYMENTS/b.json' ELSE url END AS url FROM pages)""")
def route_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = (F.when(F.col("page_id") % 3 == 0, "/Transactions/a.json")
            .when(F.col("page_id") % 3 == 1, "/PAYMENTS/b.json").otherwise(""))
    return v.table(spark, sf_dir, "pages").select(
        "page_id", files.route_entity(F.concat("url", tail)).alias("entity"))


@query("json_validity", """
SELECT event_id, json_valid(CASE WHEN event_id % 97 = 0 THEN left(props, length(props) - 1)
                                 ELSE props END) AS valid
FROM events""")
def json_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last character of some payloads is cut off, to have broken ones too."""
    props = F.col("props")
    cut = F.when(F.col("event_id") % 97 == 0,
                 F.substring(props, F.lit(1), F.length(props) - 1)).otherwise(props)
    return v.table(spark, sf_dir, "events").select(
        "event_id", files.json_valid(cut).alias("valid"))


@query("json_lines_by_file", """
SELECT event_type, count(*) AS n_lines, count(*) FILTER (event_id % 97 = 0) AS n_broken,
       count(*) FILTER (event_id % 97 = 0) = 0 AS valid
FROM events GROUP BY event_type""")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of lines per event type, some lines cut; validity per folder."""
    props = F.col("props")
    cut = F.when(F.col("event_id") % 97 == 0,
                 F.substring(props, F.lit(1), F.length(props) - 1)).otherwise(props)
    folder = new_folder(spark, "json-lines")
    (v.table(spark, sf_dir, "events").select("event_type", cut.alias("value"))
     .write.partitionBy("event_type").text(folder))
    by_file = files.json_lines_by_file(spark, folder)
    kind = F.regexp_extract("file_path", r"event_type=(\w+)", 1)
    return by_file.groupBy(kind.alias("event_type")).agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_broken").alias("n_broken"),
        F.bool_and("valid").alias("valid"))


@query("contract_map", v.sql("""
SELECT payment_id, transaction_id, amount_paid, strftime(payment_date, '%Y-%m-%d') AS date_paid,
       'card' AS payment_method, 'completed' AS payment_status
FROM pay""", "pay"))
def contract_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = v.pay(spark, sf_dir).select(
        "payment_id", "transaction_id",
        F.date_format("payment_date", "yyyy-MM-dd").alias("payment_date"),
        F.col("amount_paid").alias("payment_amount"), F.lit("card").alias("payment_method"),
        F.lit("completed").alias("status"))
    return to_canonical(extracted, "payments")


@query("contract_map_stream", v.sql("""
SELECT transaction_id, customer_id, amount AS value, strftime(transaction_date, '%Y-%m-%d')
         AS date FROM tx""", "tx"))
def contract_map_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = v.tx(spark, sf_dir).select(
        "transaction_id", "customer_id", "amount",
        F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date"))
    return to_stream_names(to_canonical(extracted, "transactions"))


@query("kafka_decode", v.sql("""
SELECT transaction_id, customer_id, amount, strftime(transaction_date, '%Y-%m-%d') AS date,
       strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS kafka_time
FROM tx""", "tx"))
def kafka_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions encoded as messages and decoded again."""
    record = F.struct("transaction_id", "customer_id", "amount",
                      F.date_format("transaction_date", "yyyy-MM-dd").alias("date"))
    messages = v.tx(spark, sf_dir).select(
        F.to_json(record).cast("binary").alias("value"),
        F.col("transaction_date").alias("timestamp"))
    return decode_messages(messages, RAW_TRANSACTIONS).withColumn(
        "kafka_time", F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss"),
    ).drop("kafka_timestamp")


@query("kafka_dead_letters", v.sql("""
SELECT transaction_id AS message, CAST(transaction_id AS BIGINT) % 97 = 0 AS dead FROM tx""", "tx"))
def kafka_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is either decoded or a dead letter; some payloads are cut, empty or no object."""
    number = F.col("transaction_id").cast("long")
    whole = F.to_json(F.struct("transaction_id", "customer_id", "amount"))
    payload = (F.when(number % 97 != 0, whole).when(number % 2 == 0, F.substring(whole, 1, 20))
               .when(number % 3 == 0, F.lit("[1, 2]")).when(number % 5 == 0, F.lit("")))
    messages = v.tx(spark, sf_dir).select(
        payload.cast("binary").alias("value"), F.col("transaction_date").alias("timestamp"),
        F.lit("transactions").alias("topic"), (number % 4).cast("int").alias("partition"),
        number.alias("offset"))
    read = decode_messages(messages, RAW_TRANSACTIONS).select(
        F.col("transaction_id").alias("message"), F.lit(False).alias("dead"))
    return read.union(dead_letters(messages, RAW_TRANSACTIONS).select(
        F.col("offset").cast("string"), F.lit(True)))


@query("offset_gaps", """
WITH m AS (SELECT event_id % 4 AS partition, event_id // 4 AS "offset" FROM events
           WHERE (event_id // 4) % 50 NOT IN (7, 8) AND (event_id // 4) % 333 <> 64)
SELECT 'events' AS topic, CAST(partition AS INTEGER) AS partition, "offset" + 1 AS first_missing,
       next - 1 AS last_missing
FROM (SELECT *, lead("offset") OVER (PARTITION BY partition ORDER BY "offset") AS next FROM m)
WHERE next > "offset" + 1""")
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the messages of four partitions, some of them lost and all of them read twice."""
    offset = F.floor(F.col("event_id") / 4).cast("long")
    messages = v.table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        offset.alias("offset")).filter(
        ~(F.col("offset") % 50).isin(7, 8) & (F.col("offset") % 333 != 64))
    return offset_gaps(messages.union(messages), block=64)


@query("bronze_load", v.sql("""
SELECT transaction_id, customer_id, amount, date, FALSE AS quarantined FROM tx_raw_dirty
WHERE transaction_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY src DESC) = 1
UNION ALL
SELECT NULL, customer_id, amount, date, TRUE FROM tx_raw_dirty WHERE transaction_id IS NULL""",
                            "tx_raw_dirty"))
def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to bronze over the whole raw table, in two loads of which the second corrects the
    first: what the table holds, and what quarantine holds."""
    root, name = new_folder(spark, "bronze-load"), f"latebook_bronze_{uuid.uuid4().hex[:8]}"
    raw = v.tx_raw_dirty(spark, sf_dir)
    for copy in (0, 1):
        raw.filter(F.col("src") == copy).select(*RAW_TRANSACTIONS.names).write.mode("append").json(
            f"{root}/landing")
        ingest(Run(spark, f"{root}/control", "LandingToBronze", "transactions", v.AS_OF,
                   f"{root}/landing", f"{root}/table"), name)
    columns = RAW_TRANSACTIONS.names
    content = F.from_json("record_content", RAW_TRANSACTIONS)
    errors = spark.read.schema(ERROR_RECORDS).parquet(f"{root}/control/error_records")
    return spark.table(name).select(*columns, F.lit(False).alias("quarantined")).union(
        errors.select(content.alias("r")).select(*[f"r.{c}" for c in columns], F.lit(True)))


@query("full_refresh", v.sql(_TX_ROWS, "tx"))
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load replaces the first one completely."""
    rows, path = _tx_with_parts(spark, sf_dir), new_folder(spark, "refresh")
    write_plain(rows.withColumn("amount", F.lit(0.0)), path)
    write_plain(rows, path)
    return _tx_rows(spark.read.parquet(path))


@query("partitioned_write", v.sql(_TX_ROWS, "tx"))
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_partitioned(_tx_with_parts(spark, sf_dir), new_folder(spark, "bronze-tx"),
                             ["year", "month"])
    return _tx_rows(spark.read.parquet(path))


@query("gold_partitioned", v.sql("""
SELECT inadimplente, reference_month, severidade, count(*) AS n,
       round(sum(total_valor_em_aberto), 2) + 0 AS valor
FROM gold GROUP BY ALL""", "gold"))
def gold_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table, its month written twice, and read back by its partitions."""
    path, month = new_folder(spark, "gold-clients"), v.WINDOW.reference_month
    customers = gold(spark, sf_dir)
    for rows in (customers.withColumn("total_valor_em_aberto", F.lit(-1.0)), customers):
        replace_slice(rows, path, "reference_month", month, ["inadimplente"])
    stored = spark.read.schema(customers.schema).parquet(path)
    return stored.groupBy("inadimplente", "reference_month", "severidade").agg(
        F.count(F.lit(1)).alias("n"), money(F.sum("total_valor_em_aberto")).alias("valor"))


@query("gold_sql", v.sql("""
SELECT severidade, count(*) AS clientes,
       round(sum(total_valor_em_aberto), 2) + 0 AS valor
FROM gold WHERE inadimplente GROUP BY severidade""", "gold"))
def gold_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table as a view that SQL users query."""
    name = f"inadimplencia_clientes_{uuid.uuid4().hex[:8]}"
    published(gold(spark, sf_dir)).createOrReplaceTempView(name)
    return spark.sql(f"""
        SELECT severidade, count(*) AS clientes,
               round(sum(total_valor_em_aberto), 2) + 0.0D AS valor
        FROM {name} WHERE inadimplente GROUP BY severidade""")


@query("bucketed_write", v.sql("""
SELECT customer_id, severidade, count(*) AS n FROM gold GROUP BY ALL""", "gold"))
def bucketed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold customers bucketed by customer; grouping by customer needs no shuffle."""
    table = f"latebook_bucketed_{uuid.uuid4().hex[:8]}"
    write_bucketed(gold(spark, sf_dir), table, new_folder(spark, "bucketed"))
    return spark.table(table).groupBy("customer_id", "severidade").agg(
        F.count(F.lit(1)).alias("n"))


@query("append_write", v.sql(f"""
SELECT *, CASE WHEN year >= 1998 THEN 2 ELSE 1 END AS load FROM ({_TX_ROWS})""", "tx"))
def append_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created by the first load, appended to by the second."""
    table, path = f"latebook_append_{uuid.uuid4().hex[:8]}", new_folder(spark, "append")
    rows = _tx_with_parts(spark, sf_dir)
    load = F.when(F.col("year") >= 1998, 2).otherwise(1)
    for n in (1, 2):
        append_or_create(rows.filter(load == n).withColumn("load", F.lit(n)), table, path)
    stored = spark.table(table)
    return _tx_rows(stored).withColumn("load", F.when(F.col("year") >= 1998, 2).otherwise(1))


@query("upsert_by_key", v.sql("""
SELECT transaction_id, customer_id, amount, moved AS transaction_date,
       CAST(year(moved) AS INTEGER) AS year, CAST(month(moved) AS INTEGER) AS month, load
FROM (SELECT transaction_id, customer_id, t.amount + CASE WHEN upd THEN 1 ELSE 0 END AS amount,
             CASE WHEN upd THEN CAST(transaction_date AS DATE) + 40
                  ELSE CAST(transaction_date AS DATE) END AS moved,
             CASE WHEN upd OR NOT known THEN 2 ELSE 1 END AS load
      FROM (SELECT *, year(transaction_date) >= 2001 AS upd,
                   NOT (year(transaction_date) = 2000 AND month(transaction_date) > 6) AS known
            FROM tx) t)""", "tx"))
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load without the second half of 2000; a second one that brings it, and
    corrects value and date of every transaction since 2001, which moves partitions."""
    table, path = f"latebook_upsert_{uuid.uuid4().hex[:8]}", new_folder(spark, "upsert")
    parts = ["year", "month"]

    def dated(rows: DataFrame, load: int) -> DataFrame:
        return rows.withColumns({"load": F.lit(load), "year": F.year("transaction_date"),
                                 "month": F.month("transaction_date")})
    rows = v.tx(spark, sf_dir).select(
        "transaction_id", "customer_id", "amount", _day("transaction_date"))
    year, month = F.year("transaction_date"), F.month("transaction_date")
    late = (year == 2000) & (month > 6)
    corrected = rows.filter(year >= 2001).withColumns({
        "amount": F.col("amount") + 1, "transaction_date": F.date_add("transaction_date", 40)})
    upsert(spark, table, dated(rows.filter(~late), 1), ["transaction_id"], ["amount"], parts,
           path)
    upsert(spark, table, dated(rows.filter(late).unionByName(corrected), 2), ["transaction_id"],
           ["amount"], parts, path)
    return spark.table(table).select(
        "transaction_id", "customer_id", "amount", "transaction_date", "year", "month", "load")
