"""Joins, rules, classification, metrics, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.catalog import views as v
from latebook.catalog.registry import money, query
from latebook.operators import gold as g
from latebook.operators import rules as r
from latebook.operators.control import quality_gate
from latebook.operators.settlement import settle
from latebook.sinks.tables import write_plain
from latebook.streaming.batches import flag_counts
from latebook.workspace import new_folder


def _views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return v.tx(spark, sf_dir), v.pay(spark, sf_dir)


def _late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.late_rows(*_views(spark, sf_dir), v.WINDOW)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.classify_batch(*_views(spark, sf_dir), v.WINDOW, v.PROCESS_ID)


def published(customers: DataFrame) -> DataFrame:
    """The classification without its run stamps, in comparable types."""
    return customers.select(
        "customer_id", "inadimplente",
        g.joined_rules(F.col("regras_aplicadas")).alias("regras_aplicadas"),
        F.col("total_ocorrencias").cast("long").alias("total_ocorrencias"),
        money("total_valor_em_aberto").alias("total_valor_em_aberto"), "max_dias_atraso",
        "reference_date", "reference_month", "severidade")


_GOLD_SQL = """
SELECT customer_id, inadimplente, regras_aplicadas, total_ocorrencias,
       round(total_valor_em_aberto, 2) + 0 AS total_valor_em_aberto, max_dias_atraso,
       reference_date, reference_month, severidade
FROM gold"""


@query("join_tx_pay", v.sql("""
SELECT transaction_id, customer_id, amount, CAST(transaction_date AS DATE) AS transaction_date,
       due_date, payment_id, amount_paid, CAST(payment_date AS DATE) AS payment_date
FROM joined""", "joined"))
def join_tx_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(*_views(spark, sf_dir)).select(
        "transaction_id", "customer_id", "amount",
        F.col("transaction_date").cast("date").alias("transaction_date"), "due_date",
        "payment_id", "amount_paid", F.col("payment_date").cast("date").alias("payment_date"))


@query("rule1_late30_90d", v.sql("""
SELECT customer_id, regra_aplicada, descricao, transaction_id, amount,
       CAST(dias_atraso AS INTEGER) AS dias_atraso,
       round(valor_em_aberto, 2) + 0 AS valor_em_aberto
FROM rule1""", "rule1"))
def rule1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.single_late_rows(_late(spark, sf_dir), v.WINDOW).withColumn(
        "valor_em_aberto", money("valor_em_aberto"))


@query("rule2_repeat_late", v.sql("""
SELECT customer_id, qtd_atrasos, round(total_em_aberto, 2) + 0 AS total_em_aberto
FROM rule2""", "rule2"))
def rule2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.repeat_late_customers(_late(spark, sf_dir), v.WINDOW).withColumn(
        "total_em_aberto", money("total_em_aberto"))


@query("rule_union", v.sql("""
SELECT customer_id, regra_aplicada, transaction_id, CAST(dias_atraso AS INTEGER) AS dias_atraso,
       round(valor_em_aberto, 2) + 0 AS valor_em_aberto
FROM broken""", "broken"))
def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.rule_union(_late(spark, sf_dir), v.WINDOW).select(
        "customer_id", "regra_aplicada", "transaction_id", "dias_atraso",
        money("valor_em_aberto").alias("valor_em_aberto"))


@query("violating_payments", v.sql("""
SELECT customer_id, transaction_id, payment_id, CAST(dias_atraso AS INTEGER) AS dias_atraso,
       round(valor_em_aberto, 2) + 0 AS valor_em_aberto, regra_aplicada, descricao
FROM (SELECT customer_id, transaction_id, payment_id, dias_atraso, valor_em_aberto,
             regra_aplicada, descricao FROM rule1
      UNION ALL
      SELECT customer_id, transaction_id, payment_id, dias_atraso, valor_em_aberto, 'regra2',
             'Mais de 3 pagamentos com mais de 15 dias de atraso nos últimos 6 meses'
      FROM joined
      WHERE transaction_date >= DATE '1999-12-03' AND dias_atraso > 15
        AND customer_id IN (SELECT customer_id FROM rule2))""", "rule1", "rule2"))
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The few late rows are staged, as the gold job does."""
    late = _late(spark, sf_dir)
    folder = write_plain(late, new_folder(spark, "late-rows"))
    staged = spark.read.schema(late.schema).parquet(folder)
    return r.violating_payments(staged, v.WINDOW).withColumn(
        "valor_em_aberto", money("valor_em_aberto"))


@query("delinquent_customers", v.sql("""
SELECT customer_id, regras_aplicadas, total_ocorrencias,
       round(total_valor_em_aberto, 2) + 0 AS total_valor_em_aberto,
       CAST(max_dias_atraso AS INTEGER) AS max_dias_atraso
FROM delinquents""", "delinquents"))
def delinquents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.delinquent_customers(_late(spark, sf_dir), v.WINDOW).select(
        "customer_id", g.joined_rules(F.col("regras_aplicadas")).alias("regras_aplicadas"),
        F.col("total_ocorrencias").cast("long").alias("total_ocorrencias"),
        money("total_valor_em_aberto").alias("total_valor_em_aberto"), "max_dias_atraso")


@query("distinct_customers", v.sql("SELECT DISTINCT customer_id FROM tx", "tx"))
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.distinct_customers(v.tx(spark, sf_dir))


@query("all_customers_classified", v.sql(_GOLD_SQL, "gold"))
def every_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = r.delinquent_customers(_late(spark, sf_dir), v.WINDOW)
    return published(r.all_customers_classified(
        late, v.tx(spark, sf_dir), v.WINDOW, v.PROCESS_ID))


@query("classify_batch", v.sql(_GOLD_SQL, "gold"))
def classify_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(gold(spark, sf_dir))


_V2 = {
    "balance": """
  SELECT t.customer_id, t.transaction_date,
         greatest(t.amount - coalesce(p.total_paid, 0.0), 0.0) AS valor,
         datediff('day', t.due_date, coalesce(p.last_paid, DATE '2000-06-15')) AS dias
  FROM tx t LEFT JOIN (
    SELECT transaction_id, sum(amount_paid) AS total_paid,
           max(CAST(payment_date AS DATE)) AS last_paid
    FROM pay WHERE amount_paid > 0 GROUP BY transaction_id) p USING (transaction_id)""",
    "hit": """
  SELECT *, transaction_date >= DATE '2000-03-02' AND transaction_date < DATE '2000-06-01'
              AND dias > 30 AS h1,
         transaction_date >= DATE '1999-12-03' AND transaction_date < DATE '2000-06-01'
              AND dias > 15 AS h2
  FROM balance""",
    "who": """
  SELECT customer_id, count(*) FILTER (h1) > 0 AS r1, count(*) FILTER (h2) > 3 AS r2
  FROM hit GROUP BY customer_id""",
    "fixed": """
  SELECT w.customer_id, any_value(r1) AS r1, any_value(r2) AS r2,
         count(*) FILTER ((r1 AND h1) OR (r2 AND h2)) AS n,
         coalesce(sum(valor) FILTER ((r1 AND h1) OR (r2 AND h2)), 0.0) AS v,
         coalesce(max(dias) FILTER ((r1 AND h1) OR (r2 AND h2)), 0) AS d
  FROM who w JOIN hit USING (customer_id) GROUP BY w.customer_id""",
}


@query("classify_batch_v2", v.sql("""
SELECT customer_id, r1 OR r2 AS inadimplente,
       concat_ws(', ', CASE WHEN r1 THEN 'regra1' END, CASE WHEN r2 THEN 'regra2' END)
         AS regras_aplicadas,
       n AS total_ocorrencias, round(v, 2) + 0 AS total_valor_em_aberto,
       CAST(d AS INTEGER) AS max_dias_atraso,
       '2000-05-31' AS reference_date, '2000-05' AS reference_month,
       CASE WHEN d > 90 THEN 'CRÍTICA' WHEN d > 60 THEN 'ALTA' WHEN d > 30 THEN 'MÉDIA'
            WHEN d > 15 THEN 'BAIXA' ELSE 'NENHUMA' END AS severidade
FROM fixed""", "tx", "pay", **_V2))
def classify_batch_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(r.classify_batch_v2(*_views(spark, sf_dir), v.WINDOW, v.PROCESS_ID))


_SPEC = {"spec": """
  SELECT customer_id,
         count(*) FILTER (due_date >= DATE '2000-06-15' - 90 AND dias_atraso > 30)
           AS late_30d_3m,
         count(*) FILTER (due_date >= DATE '2000-06-15' - 180 AND dias_atraso > 15)
           AS late_15d_6m
  FROM joined GROUP BY customer_id"""}


def _spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.classify_spec_tables(*_views(spark, sf_dir), v.AS_OF)


@query("classify_spec", v.sql("""
SELECT *, late_30d_3m >= 1 OR late_15d_6m >= 1 AS inadimplente FROM spec""",
                              "joined", **_SPEC))
def classify_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spec(spark, sf_dir)


@query("delinquency_pct", v.sql("""
SELECT count(*) AS total_clientes,
       count(*) FILTER (late_30d_3m >= 1 OR late_15d_6m >= 1) AS clientes_inadimplentes,
       round(count(*) FILTER (late_30d_3m >= 1 OR late_15d_6m >= 1) * 100.0 / count(*), 2)
         AS pct_inadimplencia
FROM spec""", "joined", **_SPEC))
def pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.delinquency_pct(_spec(spark, sf_dir))


_STREAM = {
    "profile": """
  SELECT *, payment_date IS NOT NULL AS payment_done,
         CAST(greatest(0, dias_atraso) AS INTEGER) AS days_late
  FROM joined""",
    "flagged": """
  SELECT *, c1 OR c2 AS inadimplente
  FROM (SELECT *, transaction_date >= DATE '2000-06-15' - 90 AND days_late > 30 AS c1,
               transaction_date >= DATE '2000-06-15' - 180 AND days_late > 15 AS c2
        FROM profile)""",
}


def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, pay = _views(spark, sf_dir)
    return r.stream_profile(settle(tx, pay.withColumn("status", F.lit("completed"))), v.AS_OF)


@query("classify_stream_profile", v.sql("""
SELECT transaction_id, payment_id, payment_done, days_late, c1 AS criterio_1, c2 AS criterio_2,
       inadimplente, '2000-06-15' AS reference_date, '2000-06' AS reference_month,
       '2000-Q2' AS reference_quarter
FROM flagged""", "joined", **_STREAM))
def classify_stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_rows(spark, sf_dir).select(
        "transaction_id", "payment_id", "payment_done", "days_late", "criterio_1", "criterio_2",
        "inadimplente", "reference_date", "reference_month", "reference_quarter")


@query("batch_flag_counts", v.sql("""
SELECT inadimplente, count(*) AS n FROM flagged GROUP BY inadimplente""", "joined", **_STREAM))
def batch_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_counts(profile_rows(spark, sf_dir))


@query("delinquency_metrics", v.sql("""
SELECT reference_month, count(*) AS total_clientes,
       count(*) FILTER (inadimplente) AS total_inadimplentes,
       round(avg(CASE WHEN inadimplente THEN 1 ELSE 0 END), 6) AS taxa_inadimplencia,
       round(sum(total_valor_em_aberto), 2) + 0 AS valor_total_inadimplencia,
       max(max_dias_atraso) AS max_dias_atraso
FROM gold GROUP BY reference_month""", "gold"))
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.delinquency_metrics(gold(spark, sf_dir)).withColumns({
        "taxa_inadimplencia": F.round("taxa_inadimplencia", 6),
        "valor_total_inadimplencia": money("valor_total_inadimplencia")})


@query("delinquency_alerts", v.sql("""
SELECT customer_id, severidade, total_ocorrencias,
       round(total_valor_em_aberto, 2) + 0 AS total_valor_em_aberto, max_dias_atraso,
       '2000-06-15 00:00:00' AS data_alerta, regras_aplicadas, reference_date,
       'process-1' AS processo_id, FALSE AS alerta_enviado
FROM gold WHERE severidade = 'CRÍTICA' OR total_valor_em_aberto > 10000""", "gold"))
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.delinquency_alerts(gold(spark, sf_dir), v.STAMP, v.PROCESS_ID).withColumns({
        "total_valor_em_aberto": money("total_valor_em_aberto"),
        "total_ocorrencias": F.col("total_ocorrencias").cast("long")})


@query("quality_gate", v.sql("""
SELECT CASE WHEN count(*) FILTER (inadimplente AND reference_month = '2000-05') > 0
            THEN 1 ELSE 0 END AS success
FROM gold""", "gold"))
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics are those of the same customers, so one pass over them answers both."""
    return quality_gate(gold(spark, sf_dir), None, v.WINDOW.reference_month)


# --- month by month -----------------------------------------------------------------------

_HISTORY = {
    "runs": """
  SELECT CAST(last_day(CAST(m AS DATE)) AS DATE) AS ref, ref + 15 AS run
  FROM (SELECT unnest(generate_series(
          (SELECT date_trunc('month', min(transaction_date)) - INTERVAL 1 MONTH FROM tx),
          TIMESTAMP '2000-05-01', INTERVAL 1 MONTH)) AS m)""",
    "known": """
  SELECT r.ref, t.customer_id, ref - CAST(t.transaction_date AS DATE) AS age,
         datediff('day', t.due_date, coalesce(CAST(p.payment_date AS DATE), r.run)) AS dias,
         t.amount - coalesce(p.amount_paid, 0.0) AS valor
  FROM runs r JOIN tx t ON CAST(t.transaction_date AS DATE) <= r.run
  LEFT JOIN pay p ON p.transaction_id = t.transaction_id AND p.amount_paid > 0
                 AND CAST(p.payment_date AS DATE) <= r.run""",
    "monthly_hit": """
  SELECT *, age <= 90 AND dias > 30 AS h1, age <= 180 AND dias > 15 AS h2 FROM known""",
    "monthly": """
  SELECT strftime(ref, '%Y-%m') AS reference_month, customer_id,
         count(*) FILTER (h1) >= 1 AS r1, count(*) FILTER (h2) >= 4 AS r2,
         r1 OR r2 AS inadimplente,
         CASE WHEN r1 THEN sum(valor) FILTER (h1) ELSE 0.0 END
           + CASE WHEN r2 THEN sum(valor) FILTER (h2) ELSE 0.0 END AS v,
         CASE WHEN r1 THEN max(dias) FILTER (h1) ELSE 0 END AS d
  FROM monthly_hit GROUP BY ref, customer_id""",
    "monthly_metrics": """
  SELECT reference_month, count(*) AS total_clientes,
         count(*) FILTER (inadimplente) AS total_inadimplentes,
         avg(CASE WHEN inadimplente THEN 1 ELSE 0 END) AS taxa,
         sum(v) AS valor, CAST(max(d) AS INTEGER) AS d
  FROM monthly GROUP BY reference_month""",
}


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.classify_history(*_views(spark, sf_dir), v.WINDOW.reference_date)


@query("classify_history", v.sql("""
SELECT reference_month, customer_id, inadimplente, round(v, 2) + 0 AS total_valor_em_aberto,
       CAST(d AS INTEGER) AS max_dias_atraso FROM monthly""", "tx", "pay", **_HISTORY))
def classify_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).withColumn(
        "total_valor_em_aberto", money("total_valor_em_aberto"))


@query("mom_variation", v.sql("""
SELECT reference_month, round(taxa, 6) AS taxa_inadimplencia,
       round(coalesce(taxa - lag(taxa) OVER (ORDER BY reference_month), 0.0), 6) + 0
         AS variacao_mes_anterior
FROM monthly_metrics""", "tx", "pay", **_HISTORY))
def mom(spark: SparkSession, sf_dir: str) -> DataFrame:
    varied = g.month_over_month(g.delinquency_metrics(history(spark, sf_dir)))
    return varied.select(
        "reference_month", F.round("taxa_inadimplencia", 6).alias("taxa_inadimplencia"),
        money("variacao_mes_anterior", 6).alias("variacao_mes_anterior"))


@query("rate_history", v.sql("""
SELECT reference_month, total_clientes, total_inadimplentes, pct_inadimplencia,
       CASE WHEN pct_inadimplencia >= 15 THEN 'red' WHEN pct_inadimplencia >= 10 THEN 'orange'
            WHEN pct_inadimplencia >= 5 THEN 'yellow' ELSE 'green' END AS faixa,
       pct_inadimplencia > 15 AS critico
FROM (SELECT *, round(taxa * 100, 2) AS pct_inadimplencia FROM monthly_metrics)""",
                             "tx", "pay", **_HISTORY))
def rate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.rate_history(g.delinquency_metrics(history(spark, sf_dir)))


@query("value_at_risk", v.sql("""
SELECT reference_month, count(*) AS clientes_inadimplentes, round(sum(v), 2) + 0 AS valor_risco
FROM monthly WHERE inadimplente GROUP BY reference_month""", "tx", "pay", **_HISTORY))
def value_at_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.value_at_risk(history(spark, sf_dir)).withColumn(
        "valor_risco", money("valor_risco"))
