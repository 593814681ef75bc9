"""The pipeline's tables derived from the given ones, in Spark and as SQL.

``tx`` and ``pay`` are clean; ``tx_dirty`` and ``pay_dirty`` carry every row of their
source with defects spread over it by key, for the cleaning and quality queries;
``proc_log`` and ``error_log`` are control tables made of ``events``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.functions import due_date, parse_timestamp
from latebook.operators.cleaning import dedupe
from latebook.profiles import GATE_THRESHOLDS, AnalysisWindow

AS_OF = dt.date(2000, 6, 15)
WINDOW = AnalysisWindow(AS_OF)
PROCESS_ID = "process-1"
STAMP = WINDOW.stamp
PAY_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customer() -> Column:
    return F.concat(F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        _customer().alias("customer_id"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("transaction_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("due_date"))


def _payment_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"),
                       F.col("l_linenumber").cast("string"))


def pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *PAY_ORDER)
    return dedupe(lines, ["l_orderkey", "l_linenumber"], PAY_ORDER).select(
        _payment_id().alias("payment_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_extendedprice").alias("amount_paid"),
        F.col("l_shipdate").alias("payment_date"))


def tx_raw_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    copies = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return table(spark, sf_dir, "orders").withColumn("src", F.explode(copies)).select(
        key.alias("order_key"), "src",
        F.when(key % 211 != 0, key.cast("string")).alias("transaction_id"),
        F.when(key % 97 != 0, _customer()).alias("customer_id"),
        F.when(key % 103 != 0, F.col("o_totalprice") + F.col("src")).alias("amount"),
        F.when(key % 101 == 0, "bad-date")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"))


def tx_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tx_raw_dirty(spark, sf_dir)
    when = parse_timestamp(F.col("date"))
    term = F.when(F.col("order_key") % 89 == 0, F.date_sub(when.cast("date"), 5))
    return raw.withColumns({
        "transaction_date": when, "due_date": term.otherwise(due_date(F.col("date"))),
        "year": F.year(when), "month": F.month(when)})


def pay_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, paid = F.col("l_orderkey") + F.col("l_linenumber"), F.col("l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").select(
        _payment_id().alias("payment_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.when(k % 101 == 0, F.lit(0.0)).when(k % 103 == 0, -paid).otherwise(paid)
        .alias("amount_paid"),
        F.when(k % 107 != 0, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date_paid"),
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_returnflag")).alias("payment_method"),
        F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("payment_status"),
        *PAY_ORDER)
    when = parse_timestamp(F.col("date_paid"))
    return lines.withColumns({"payment_date": when, "year": F.year(when),
                              "month": F.month(when)})


def proc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_type")
    seconds = F.round("value").cast("long")
    return table(spark, sf_dir, "events").select(
        F.sha2(event.cast("string"), 256).alias("process_id"),
        F.concat(F.lit("Stage_"), kind).alias("process_name"), kind.alias("entity_name"),
        F.element_at(F.array(*map(F.lit, GATE_THRESHOLDS)), (event % 3 + 1).cast("int"))
        .alias("stage_name"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("end_time"),
        (event % 1000).alias("total_records_processed"),
        F.when(event % 20 == 0, event % 50).otherwise(F.lit(0)).alias("total_records_error"),
        F.when((kind == "error") & (event % 3 == 0), "ERRO").otherwise("SUCESSO")
        .alias("status"))


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per error that ``proc_log`` counts."""
    logs = proc_log(spark, sf_dir).filter("total_records_error > 0")
    kinds = F.array(F.lit("DATA_VALIDATION_ERROR"), F.lit("DATA_QUALITY_ERROR"))
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("total_records_error")))
    return logs.select("process_id", "entity_name", number.alias("n")).select(
        F.concat_ws("-", F.substring("process_id", 1, 12), F.lpad(F.col("n").cast("string"),
                                                                   3, "0")).alias("error_id"),
        "process_id", "entity_name",
        F.concat(F.lit("t"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("error_time"),
        F.element_at(kinds, (F.col("n") % 2 + 1).cast("int")).alias("error_type"),
        F.concat(F.lit("erro "), F.col("n").cast("string")).alias("error_message"))


# --- the same as SQL ----------------------------------------------------------------------

SQL_PARTS = {
    "tx": """
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         'C' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS customer_id,
         o_totalprice AS amount, o_orderdate AS transaction_date,
         CAST(o_orderdate AS DATE) + 30 AS due_date
  FROM orders""",
    "pay": """
  SELECT l_orderkey || '-' || l_linenumber AS payment_id,
         CAST(l_orderkey AS VARCHAR) AS transaction_id,
         l_extendedprice AS amount_paid, l_shipdate AS payment_date
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "tx_raw_dirty": """
  SELECT o_orderkey AS order_key, src,
         CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_orderkey AS VARCHAR) END
           AS transaction_id,
         CASE WHEN o_orderkey % 97 <> 0
              THEN 'C' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS customer_id,
         CASE WHEN o_orderkey % 103 <> 0 THEN o_totalprice + src END AS amount,
         CASE WHEN o_orderkey % 101 = 0 THEN 'bad-date'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date
  FROM orders, (VALUES (0), (1)) AS copies(src)
  WHERE src = 0 OR o_orderkey % 50 = 0""",
    "tx_dirty": """
  SELECT *, TRY_CAST(date AS TIMESTAMP) AS transaction_date,
         TRY_CAST(date AS DATE) + CASE WHEN order_key % 89 = 0 THEN -5 ELSE 30 END AS due_date,
         year(TRY_CAST(date AS DATE)) AS year, month(TRY_CAST(date AS DATE)) AS month
  FROM tx_raw_dirty""",
    "tx_valid": """
  SELECT * FROM tx_dirty
  WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
    AND transaction_date IS NOT NULL AND amount IS NOT NULL""",
    "tx_unique": """
  SELECT * FROM tx_valid
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY src) = 1""",
    "pay_dirty": """
  SELECT l_orderkey || '-' || l_linenumber AS payment_id,
         CAST(l_orderkey AS VARCHAR) AS transaction_id,
         CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN 0.0
              WHEN (l_orderkey + l_linenumber) % 103 = 0 THEN -l_extendedprice
              ELSE l_extendedprice END AS amount_paid,
         CASE WHEN (l_orderkey + l_linenumber) % 107 <> 0 THEN l_shipdate END AS payment_date,
         CASE WHEN l_orderkey % 3 <> 0 THEN l_returnflag END AS payment_method,
         CASE WHEN l_linestatus <> 'O' THEN l_linestatus END AS payment_status,
         l_shipdate, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem""",
    "pay_valid": """
  SELECT * FROM pay_dirty
  WHERE payment_id IS NOT NULL AND transaction_id IS NOT NULL
    AND payment_date IS NOT NULL AND amount_paid IS NOT NULL""",
    "pay_unique": """
  SELECT * FROM pay_valid
  QUALIFY row_number() OVER (PARTITION BY payment_id
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "proc_log": """
  SELECT sha256(CAST(event_id AS VARCHAR)) AS process_id,
         'Stage_' || event_type AS process_name, event_type AS entity_name,
         ['landing_to_bronze', 'bronze_to_silver', 'silver_to_gold'][event_id % 3 + 1]
           AS stage_name,
         ts AS start_time, ts + to_seconds(CAST(round(value) AS BIGINT)) AS end_time,
         CAST(round(value) AS BIGINT) AS duration_seconds,
         event_id % 1000 AS total_records_processed,
         CASE WHEN event_id % 20 = 0 THEN event_id % 50 ELSE 0 END AS total_records_error,
         CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'ERRO' ELSE 'SUCESSO' END
           AS status, CAST(ts AS DATE) AS run_date
  FROM events""",
    "last_run": """
  SELECT * FROM proc_log
  QUALIFY row_number() OVER (PARTITION BY stage_name, entity_name, run_date
          ORDER BY start_time DESC, process_id DESC) = 1""",
    "error_log": """
  SELECT substr(process_id, 1, 12) || '-' || lpad(CAST(n AS VARCHAR), 3, '0') AS error_id,
         process_id, entity_name, 't' || lpad(CAST(n AS VARCHAR), 3, '0') AS error_time,
         CASE WHEN n % 2 = 0 THEN 'DATA_VALIDATION_ERROR' ELSE 'DATA_QUALITY_ERROR' END
           AS error_type, 'erro ' || n AS error_message
  FROM (SELECT *, unnest(generate_series(1, total_records_error)) AS n FROM proc_log)""",
    "joined": """
  SELECT t.*, p.payment_id, p.amount_paid, p.payment_date,
         CASE WHEN p.payment_date IS NULL
              THEN datediff('day', t.due_date, DATE '2000-06-15')
              ELSE datediff('day', t.due_date, CAST(p.payment_date AS DATE)) END AS dias_atraso,
         CASE WHEN p.amount_paid IS NULL THEN t.amount
              ELSE t.amount - p.amount_paid END AS valor_em_aberto
  FROM tx t LEFT JOIN (SELECT * FROM pay WHERE amount_paid > 0) p USING (transaction_id)""",
    "rule1": """
  SELECT customer_id, 'regra1' AS regra_aplicada,
         'Pagamento com mais de 30 dias de atraso nos últimos 3 meses' AS descricao,
         transaction_id, amount, dias_atraso, valor_em_aberto, payment_id
  FROM joined WHERE transaction_date >= DATE '2000-03-02' AND dias_atraso > 30""",
    "rule2": """
  SELECT customer_id, CAST(count(transaction_id) AS BIGINT) AS qtd_atrasos,
         sum(valor_em_aberto) AS total_em_aberto
  FROM joined WHERE transaction_date >= DATE '1999-12-03' AND dias_atraso > 15
  GROUP BY customer_id HAVING count(transaction_id) > 3""",
    "broken": """
  SELECT customer_id, regra_aplicada, transaction_id, dias_atraso, valor_em_aberto FROM rule1
  UNION ALL
  SELECT customer_id, 'regra2', NULL, NULL, total_em_aberto FROM rule2""",
    "delinquents": """
  SELECT customer_id, array_to_string(list_sort(list(DISTINCT regra_aplicada)), ', ')
           AS regras_aplicadas,
         CAST(count(transaction_id) AS BIGINT) AS total_ocorrencias,
         sum(valor_em_aberto) AS total_valor_em_aberto, max(dias_atraso) AS max_dias_atraso
  FROM broken GROUP BY customer_id""",
    "gold": """
  SELECT c.customer_id, d.customer_id IS NOT NULL AS inadimplente,
         coalesce(d.regras_aplicadas, '') AS regras_aplicadas,
         coalesce(d.total_ocorrencias, 0) AS total_ocorrencias,
         coalesce(d.total_valor_em_aberto, 0.0) AS total_valor_em_aberto,
         CAST(coalesce(d.max_dias_atraso, 0) AS INTEGER) AS max_dias_atraso,
         '2000-05-31' AS reference_date, '2000-05' AS reference_month,
         CASE WHEN coalesce(d.max_dias_atraso, 0) > 90 THEN 'CRÍTICA'
              WHEN d.max_dias_atraso > 60 THEN 'ALTA'
              WHEN d.max_dias_atraso > 30 THEN 'MÉDIA'
              WHEN d.max_dias_atraso > 15 THEN 'BAIXA'
              ELSE 'NENHUMA' END AS severidade
  FROM (SELECT DISTINCT customer_id FROM tx) c LEFT JOIN delinquents d USING (customer_id)""",
}
_NEEDS = {
    "tx_dirty": ["tx_raw_dirty"], "tx_valid": ["tx_dirty"], "tx_unique": ["tx_valid"],
    "pay_valid": ["pay_dirty"], "pay_unique": ["pay_valid"], "last_run": ["proc_log"],
    "error_log": ["proc_log"], "joined": ["tx", "pay"], "rule1": ["joined"],
    "rule2": ["joined"], "broken": ["rule1", "rule2"], "delinquents": ["broken"],
    "gold": ["tx", "delinquents"],
}


def sql(select: str, *views: str, **extra: str) -> str:
    """``select`` with the named views, and what they need, in front of it.

    ``extra`` adds views of the query's own, in the order given, after the common ones.
    """
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for view in views:
        add(view)
    parts = [f"{name} AS ({SQL_PARTS[name]})" for name in order]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)}\n{select}" if parts else select
