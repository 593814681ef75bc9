"""Validity, deduplication, quarantine, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.catalog import views as v
from latebook.catalog.registry import money, query
from latebook.operators import cleaning as ops
from latebook.operators import quarantine as q

_TX_SQL = """order_key, src, transaction_id, customer_id, round(amount, 2) AS amount,
       CAST(transaction_date AS DATE) AS transaction_date, due_date"""
_PAY_SQL = """payment_id, transaction_id, round(amount_paid, 2) AS amount_paid,
       CAST(payment_date AS DATE) AS payment_date, l_partkey, l_suppkey"""


def _tx(df: DataFrame) -> DataFrame:
    return df.select("order_key", "src", "transaction_id", "customer_id",
                     money("amount").alias("amount"),
                     F.col("transaction_date").cast("date").alias("transaction_date"), "due_date")


def _pay(df: DataFrame) -> DataFrame:
    return df.select("payment_id", "transaction_id", money("amount_paid").alias("amount_paid"),
                     F.col("payment_date").cast("date").alias("payment_date"), "l_partkey",
                     "l_suppkey")


@query("valid_transactions", v.sql(f"SELECT {_TX_SQL} FROM tx_valid", "tx_valid"))
def valid_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tx(ops.valid_rows(v.tx_dirty(spark, sf_dir), "transactions"))


@query("valid_payments", v.sql(f"SELECT {_PAY_SQL} FROM pay_valid", "pay_valid"))
def valid_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pay(ops.valid_rows(v.pay_dirty(spark, sf_dir), "payments"))


_TX_BAD = """transaction_id IS NULL OR customer_id IS NULL OR transaction_date IS NULL
   OR amount IS NULL"""


@query("invalid_transactions", v.sql(f"""
SELECT {_TX_SQL} FROM tx_dirty WHERE {_TX_BAD}""", "tx_dirty"))
def invalid_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tx(ops.invalid_rows(v.tx_dirty(spark, sf_dir), "transactions"))


@query("invalid_payments", v.sql(f"""
SELECT {_PAY_SQL} FROM pay_dirty WHERE payment_date IS NULL""", "pay_dirty"))
def invalid_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pay(ops.invalid_rows(v.pay_dirty(spark, sf_dir), "payments"))


@query("nonpositive_payments", v.sql(f"""
SELECT {_PAY_SQL} FROM pay_valid WHERE amount_paid <= 0""", "pay_valid"))
def nonpositive(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = ops.valid_rows(v.pay_dirty(spark, sf_dir), "payments")
    return _pay(ops.nonpositive_payments(valid))


@query("inconsistent_dates", v.sql(f"""
SELECT {_TX_SQL} FROM tx_unique WHERE due_date < transaction_date""", "tx_unique"))
def inconsistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = ops.valid_rows(v.tx_dirty(spark, sf_dir), "transactions")
    return _tx(ops.inconsistent_dates(ops.dedupe(valid, ["transaction_id"], ["src"])))


@query("dedupe_transactions", v.sql(f"SELECT {_TX_SQL} FROM tx_unique", "tx_unique"))
def dedupe_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = ops.valid_rows(v.tx_dirty(spark, sf_dir), "transactions")
    return _tx(ops.dedupe(valid, ["transaction_id"], ["src"]))


@query("dedupe_payments", v.sql(f"SELECT {_PAY_SQL} FROM pay_unique", "pay_unique"))
def dedupe_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = ops.valid_rows(v.pay_dirty(spark, sf_dir), "payments")
    return _pay(ops.dedupe(valid, ["payment_id"], list(v.PAY_ORDER)))


@query("silver_transactions", v.sql("""
SELECT transaction_id, customer_id, round(amount, 2) AS amount,
       CAST(transaction_date AS DATE) AS transaction_date,
       CASE WHEN due_date < transaction_date THEN CAST(transaction_date AS DATE) + 30
            ELSE due_date END AS due_date, year, month,
       substring(customer_id, 1, 2) || '****' || substring(customer_id, -2, 2)
         AS customer_id_masked,
       CASE WHEN amount < 100 THEN 'BAIXO' WHEN amount < 500 THEN 'MÉDIO'
            WHEN amount < 1000 THEN 'ALTO' ELSE 'MUITO_ALTO' END AS valor_classificacao,
       '2000-06-15 00:00:00' AS dt_processamento
FROM tx_unique""", "tx_unique"))
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = ops.clean(v.tx_dirty(spark, sf_dir), "transactions", ["src"], v.STAMP)
    return clean.drop("order_key", "src", "date").withColumns({
        "amount": money("amount"), "transaction_date": F.col("transaction_date").cast("date")})


@query("silver_payments", v.sql("""
SELECT payment_id, transaction_id, round(amount_paid, 2) AS amount_paid,
       CAST(payment_date AS DATE) AS payment_date,
       coalesce(payment_method, 'NOT_SPECIFIED') AS payment_method,
       coalesce(payment_status, 'completed') AS payment_status,
       year(payment_date) AS year, month(payment_date) AS month,
       '2000-06-15 00:00:00' AS dt_processamento
FROM pay_unique""", "pay_unique"))
def silver_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = ops.clean(v.pay_dirty(spark, sf_dir), "payments", list(v.PAY_ORDER), v.STAMP)
    return clean.drop("date_paid", *v.PAY_ORDER).withColumns({
        "amount_paid": money("amount_paid"), "payment_date": F.col("payment_date").cast("date")})


@query("cleaning_summary", v.sql("""
SELECT 'transactions' AS entity_name, (SELECT count(*) FROM tx_dirty) AS initial_count,
       (SELECT count(*) FROM tx_dirty) - (SELECT count(*) FROM tx_valid) AS invalid_count,
       (SELECT count(*) FROM tx_unique) AS final_count,
       (SELECT count(*) FROM tx_dirty) - (SELECT count(*) FROM tx_unique) AS removed_count
UNION ALL
SELECT 'payments', (SELECT count(*) FROM pay_dirty),
       (SELECT count(*) FROM pay_dirty) - (SELECT count(*) FROM pay_valid),
       (SELECT count(*) FROM pay_unique),
       (SELECT count(*) FROM pay_dirty) - (SELECT count(*) FROM pay_unique)""",
                                  "tx_unique", "pay_unique"))
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cleaning_summary(
        v.tx_dirty(spark, sf_dir), "transactions", "transaction_id",
    ).unionByName(ops.cleaning_summary(v.pay_dirty(spark, sf_dir), "payments", "payment_id"))


def all_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error records of both entities: rejected, repaired and worthless rows."""
    bronze = {"transactions": (v.tx_dirty(spark, sf_dir), ["src"]),
              "payments": (v.pay_dirty(spark, sf_dir), list(v.PAY_ORDER))}
    records = [
        q.error_records(q.issues(df, ops.unique_valid(df, entity, order), entity),
                        error_type=F.col("error_type"), entity=entity,
                        process_id=v.PROCESS_ID, error_time=v.STAMP)
        for entity, (df, order) in bronze.items()]
    return records[0].unionByName(records[1])


_ISSUES = {
    "issues": f"""
  SELECT 'transactions' AS entity_name, 'DATA_VALIDATION_ERROR' AS error_type,
         'Campos obrigatórios nulos' AS error_message, transaction_id AS record_key,
         date AS record_date
  FROM tx_dirty WHERE {_TX_BAD}
  UNION ALL
  SELECT 'transactions', 'DATE_CONSISTENCY_WARNING',
         'Data de vencimento anterior à data da transação', transaction_id, date
  FROM tx_unique WHERE due_date < transaction_date
  UNION ALL
  SELECT 'payments', 'DATA_VALIDATION_ERROR', 'Campos obrigatórios nulos', payment_id, NULL
  FROM pay_dirty WHERE payment_date IS NULL
  UNION ALL
  SELECT 'payments', 'PAYMENT_VALUE_WARNING', 'Pagamento com valor zero ou negativo',
         payment_id, strftime(payment_date, '%Y-%m-%d')
  FROM pay_unique WHERE amount_paid <= 0""",
}


@query("error_records", v.sql("""
SELECT *, 'process-1' AS process_id, '2000-06-15 00:00:00' AS error_time FROM issues""",
                              "tx_unique", "pay_unique", **_ISSUES))
def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record's content is read back from its JSON, which proves that it is complete."""
    content = F.col("record_content")

    def field(transactions: str, payments: str):
        return F.when(F.col("entity_name") == "transactions",
                      F.get_json_object(content, f"$.{transactions}")).otherwise(
                      F.get_json_object(content, f"$.{payments}"))
    return all_errors(spark, sf_dir).select(
        "entity_name", "error_type", "error_message",
        field("transaction_id", "payment_id").alias("record_key"),
        field("date", "date_paid").alias("record_date"), "process_id", "error_time")


@query("error_type_counts", v.sql("""
SELECT entity_name, error_type, count(*) AS n_errors FROM issues GROUP BY ALL""",
                                  "tx_unique", "pay_unique", **_ISSUES))
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.error_type_counts(all_errors(spark, sf_dir))


@query("invalid_payment_errors", v.sql("""
SELECT 'payments' AS entity_name, 'INVALID_PAYMENT' AS error_type,
       'Pagamento com valor zero ou negativo' AS error_message, payment_id AS record_key
FROM pay_unique WHERE amount_paid <= 0""", "pay_unique"))
def invalid_payment_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gold stage records when it leaves worthless payments out."""
    valid = ops.valid_rows(v.pay_dirty(spark, sf_dir), "payments")
    rows = ops.nonpositive_payments(ops.dedupe(valid, ["payment_id"], list(v.PAY_ORDER)))
    return q.error_records(
        rows.select("payment_id", "transaction_id", "amount_paid", "payment_date"),
        error_type="INVALID_PAYMENT", entity="payments", process_id=v.PROCESS_ID,
        error_time=v.STAMP).select(
        "entity_name", "error_type", "error_message",
        F.get_json_object("record_content", "$.payment_id").alias("record_key"))
