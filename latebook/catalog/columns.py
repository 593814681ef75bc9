"""Column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.catalog import views as v
from latebook.catalog.registry import money, query
from latebook.functions import (
    amount_band, analysis_window_columns, content_hash, date_parts, days_late, days_late_clamped,
    discovered_key_columns, due_date, key_hash, mask_partial, mask_pii, open_value,
    parse_timestamp, pseudonym, redact_names, reference_columns, severity,
)
from latebook.functions.privacy import REDACTION_TEXT
from latebook.operators.cleaning import enforce_types, payment_defaults, repair_due_date
from latebook.operators.gold import joined_rules
from latebook.operators.quality import calendar_check
from latebook.operators.rules import classify_batch, criteria_flags
from latebook.operators.settlement import settle
from latebook.operators.stamps import audit_stamp, quality_stamp

from latebook.schemas import RAW_TRANSACTIONS, SILVER_TYPES

RAW_COLUMNS = RAW_TRANSACTIONS.fieldNames()


@query("parse_dates", v.sql("""
SELECT order_key, src, TRY_CAST(date AS TIMESTAMP) IS NULL AS unreadable,
       CAST(TRY_CAST(date AS TIMESTAMP) AS DATE) AS parsed
FROM tx_raw_dirty""", "tx_raw_dirty"))
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_timestamp(F.col("date"))
    return v.tx_raw_dirty(spark, sf_dir).select(
        "order_key", "src", parsed.isNull().alias("unreadable"),
        parsed.cast("date").alias("parsed"))


@query("due_date", v.sql("""
SELECT order_key, src, TRY_CAST(date AS DATE) + 30 AS due_date FROM tx_raw_dirty""",
                         "tx_raw_dirty"))
def due_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.tx_raw_dirty(spark, sf_dir).select(
        "order_key", "src", due_date(F.col("date")).alias("due_date"))


@query("date_parts", v.sql("""
SELECT transaction_id, year(transaction_date) AS year, month(transaction_date) AS month,
       day(transaction_date) AS day FROM tx""", "tx"))
def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (v.tx(spark, sf_dir).withColumns(date_parts(F.col("transaction_date")))
            .select("transaction_id", "year", "month", "day"))


_KEY_SQL = "sha256(concat_ws('||', {}))"


@query("hash_key", v.sql(f"""
SELECT order_key, src, {_KEY_SQL.format('transaction_id')} AS hash_chave
FROM tx_raw_dirty""", "tx_raw_dirty"))
def hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.tx_raw_dirty(spark, sf_dir).select(
        "order_key", "src", key_hash(["transaction_id"]).alias("hash_chave"))


@query("hash_row", v.sql(f"""
SELECT order_key, src,
       {_KEY_SQL.format('transaction_id, customer_id, CAST(amount AS VARCHAR), date')}
         AS hash_columns
FROM tx_raw_dirty""", "tx_raw_dirty"))
def hash_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.tx_raw_dirty(spark, sf_dir).select(
        "order_key", "src", content_hash(RAW_COLUMNS).alias("hash_columns"))


@query("hash_discovered_key", v.sql(f"""
SELECT order_key, src, 'transaction_id,customer_id' AS key_columns,
       {_KEY_SQL.format('transaction_id, customer_id')} AS hash_chave
FROM tx_raw_dirty""", "tx_raw_dirty"))
def hash_discovered_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = discovered_key_columns(RAW_COLUMNS)
    return v.tx_raw_dirty(spark, sf_dir).select(
        "order_key", "src", F.lit(",".join(keys)).alias("key_columns"),
        key_hash(keys).alias("hash_chave"))


@query("audit_stamp", v.sql(f"""
SELECT *, '2000-06-15' AS dt_ingestao, '2000-06-15 00:00:00' AS dt_atualizacao,
       'landing/transactions' AS source_file, 'process-1' AS process_id,
       '20000615_000000' AS execution_id,
       {_KEY_SQL.format('transaction_id')} AS hash_chave,
       {_KEY_SQL.format('transaction_id, customer_id, CAST(amount AS VARCHAR), date')}
         AS hash_columns
FROM (SELECT transaction_id, customer_id, amount, date FROM tx_raw_dirty)""", "tx_raw_dirty"))
def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_stamp(
        v.tx_raw_dirty(spark, sf_dir).select(*RAW_COLUMNS), ingested_on=v.AS_OF.isoformat(),
        updated_at=v.STAMP, process_id=v.PROCESS_ID, execution_id=v.WINDOW.execution_id,
        source_file="landing/transactions", keys=["transaction_id"])


@query("quality_stamp", v.sql("""
SELECT transaction_id, '2000-06-15 00:00:00' AS dt_processamento, 'process-1' AS processo_id,
       TRUE AS certificado_qualidade, '2000-06-15 00:00:00' AS dt_atualizacao,
       '1.0' AS versao_processo FROM tx""", "tx"))
def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_stamp(v.tx(spark, sf_dir).select("transaction_id"),
                         process_id=v.PROCESS_ID, stamped_at=v.STAMP)


@query("type_enforce", v.sql("""
SELECT order_key, src, TRY_CAST(amount_text AS DOUBLE) AS amount,
       CAST(TRY_CAST(date AS TIMESTAMP) AS DATE) AS transaction_date,
       TRY_CAST(date AS DATE) AS due_date
FROM (SELECT order_key, src, date,
             CASE WHEN amount IS NULL THEN 'n/a' ELSE CAST(amount AS VARCHAR) END AS amount_text
      FROM tx_raw_dirty)""", "tx_raw_dirty"))
def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = v.tx_raw_dirty(spark, sf_dir).select(
        "order_key", "src", F.coalesce(F.col("amount").cast("string"), F.lit("n/a"))
        .alias("amount"), F.col("date").alias("transaction_date"), F.col("date").alias("due_date"))
    return enforce_types(text, SILVER_TYPES["transactions"]).withColumn(
        "transaction_date", F.col("transaction_date").cast("date"))


@query("mask_partial", v.sql("""
SELECT transaction_id, substring(customer_id, 1, 2) || '****' || substring(customer_id, -2, 2)
         AS customer_id_masked,
       sha256('salt' || customer_id) AS customer_pseudonym
FROM tx""", "tx"))
def masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.tx(spark, sf_dir).select(
        "transaction_id", mask_partial(F.col("customer_id")).alias("customer_id_masked"),
        pseudonym(F.col("customer_id"), "salt").alias("customer_pseudonym"))


@query("amount_band", v.sql("""
SELECT payment_id, CASE WHEN value < 100 THEN 'BAIXO' WHEN value < 500 THEN 'MÉDIO'
                        WHEN value < 1000 THEN 'ALTO' ELSE 'MUITO_ALTO' END
         AS valor_classificacao
FROM (SELECT payment_id, amount_paid / 50 AS value FROM pay)""", "pay"))
def amount_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.pay(spark, sf_dir).select(
        "payment_id", amount_band(F.col("amount_paid") / 50).alias("valor_classificacao"))


@query("repair_due_date", v.sql("""
SELECT order_key, src, CAST(transaction_date AS DATE) AS transaction_date,
       CASE WHEN due_date < transaction_date THEN CAST(transaction_date AS DATE) + 30
            ELSE due_date END AS due_date
FROM tx_dirty""", "tx_dirty"))
def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_due_date(v.tx_dirty(spark, sf_dir)).select(
        "order_key", "src", F.col("transaction_date").cast("date").alias("transaction_date"),
        "due_date")


@query("payment_defaults", v.sql("""
SELECT payment_id, CAST(l_shipdate AS DATE) AS shipped, l_partkey,
       coalesce(payment_method, 'NOT_SPECIFIED') AS payment_method,
       coalesce(payment_status, 'completed') AS payment_status
FROM pay_dirty""", "pay_dirty"))
def defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_defaults(v.pay_dirty(spark, sf_dir)).select(
        "payment_id", F.col("l_shipdate").cast("date").alias("shipped"), "l_partkey",
        "payment_method", "payment_status")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(v.tx(spark, sf_dir), v.pay(spark, sf_dir))


@query("days_late", v.sql("""
SELECT transaction_id, payment_id, CAST(dias_atraso AS INTEGER) AS dias_atraso
FROM joined""", "joined"))
def lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).select(
        "transaction_id", "payment_id",
        days_late(F.col("payment_date"), F.col("due_date"), v.AS_OF).alias("dias_atraso"))


_STATUS_SQL = "CASE WHEN transaction_id LIKE '%7' THEN 'pending' ELSE 'completed' END"


@query("days_late_clamped", v.sql(f"""
SELECT transaction_id, payment_id,
       CAST(greatest(0, datediff('day', due_date,
            CASE WHEN payment_date IS NOT NULL AND {_STATUS_SQL} = 'completed'
                 THEN CAST(payment_date AS DATE) ELSE DATE '2000-06-15' END)) AS INTEGER)
         AS days_late
FROM joined""", "joined"))
def lateness_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("transaction_id").endswith("7"), "pending").otherwise("completed")
    return _joined(spark, sf_dir).select(
        "transaction_id", "payment_id",
        days_late_clamped(F.col("payment_date"), status, F.col("due_date"), v.AS_OF)
        .alias("days_late"))


@query("open_value", v.sql("""
SELECT transaction_id, payment_id, round(valor_em_aberto, 2) + 0 AS valor_em_aberto
FROM joined""", "joined"))
def open_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).select(
        "transaction_id", "payment_id",
        money(open_value(F.col("amount"), F.col("amount_paid"))).alias("valor_em_aberto"))


@query("severity", v.sql("""
SELECT transaction_id, payment_id,
       CASE WHEN dias_atraso > 90 THEN 'CRÍTICA' WHEN dias_atraso > 60 THEN 'ALTA'
            WHEN dias_atraso > 30 THEN 'MÉDIA' WHEN dias_atraso > 15 THEN 'BAIXA'
            ELSE 'NENHUMA' END AS severidade
FROM joined""", "joined"))
def severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = days_late(F.col("payment_date"), F.col("due_date"), v.AS_OF)
    return _joined(spark, sf_dir).select(
        "transaction_id", "payment_id", severity(late).alias("severidade"))


@query("reference_columns", v.sql("""
SELECT transaction_id, strftime(transaction_date, '%Y-%m-%d') AS reference_date,
       strftime(transaction_date, '%Y-%m') AS reference_month,
       year(transaction_date) || '-Q' || quarter(transaction_date) AS reference_quarter
FROM tx""", "tx"))
def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (v.tx(spark, sf_dir).withColumns(reference_columns(F.col("transaction_date")))
            .select("transaction_id", "reference_date", "reference_month", "reference_quarter"))


@query("analysis_window", v.sql("""
SELECT transaction_id, reference_date, reference_date - 90 AS three_months_ago,
       reference_date - 180 AS six_months_ago, execution_id
FROM (SELECT transaction_id,
             CAST(date_trunc('month', transaction_date) AS DATE) - 1 AS reference_date,
             strftime(transaction_date, '%Y%m%d_%H%M%S') AS execution_id
      FROM tx)""", "tx"))
def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (v.tx(spark, sf_dir).withColumns(analysis_window_columns(F.col("transaction_date")))
            .select("transaction_id", "reference_date", "three_months_ago", "six_months_ago",
                    "execution_id"))


@query("criteria_flags", v.sql("""
SELECT transaction_id, payment_id, criterio_1, criterio_2,
       criterio_1 OR criterio_2 AS inadimplente
FROM (SELECT transaction_id, payment_id,
             transaction_date >= DATE '2000-06-15' - 90 AND dias_atraso > 30 AS criterio_1,
             transaction_date >= DATE '2000-06-15' - 180 AND dias_atraso > 15 AS criterio_2
      FROM joined)""", "joined"))
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = days_late(F.col("payment_date"), F.col("due_date"), v.AS_OF)
    return criteria_flags(_joined(spark, sf_dir).withColumn("days_late", late), v.AS_OF).select(
        "transaction_id", "payment_id", "criterio_1", "criterio_2", "inadimplente")


@query("rules_joined", v.sql("SELECT customer_id, regras_aplicadas FROM gold", "gold"))
def rules_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = classify_batch(v.tx(spark, sf_dir), v.pay(spark, sf_dir), v.WINDOW, v.PROCESS_ID)
    return gold.select("customer_id",
                       joined_rules(F.col("regras_aplicadas")).alias("regras_aplicadas"))


_NAMES_SQL = r"\w*customer_id\w*|\w*cpf\w*|\w*email\w*"


@query("redact_text", f"""
SELECT doc_id, regexp_replace(text, '{_NAMES_SQL}', '{REDACTION_TEXT}', 'g') AS text
FROM documents""")
def redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "documents").select(
        "doc_id", redact_names(F.col("text")).alias("text"))


@query("redact_records", f"""
SELECT o_orderkey, regexp_replace(
    'row=' || o_orderkey || ' customer_id=' || o_custkey || ' old_customer_id2='
    || o_custkey || ' user_email=a' || o_custkey || ' cpf:' || o_orderkey
    || ' status=' || o_orderstatus, '{_NAMES_SQL}', '{REDACTION_TEXT}', 'g') AS line
FROM orders""")
def redacted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.format_string(
        "row=%d customer_id=%d old_customer_id2=%d user_email=a%d cpf:%d status=%s",
        "o_orderkey", "o_custkey", "o_custkey", "o_custkey", "o_orderkey", "o_orderstatus")
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey", redact_names(line).alias("line"))


@query("mask_pii", r"""
SELECT doc_id, regexp_replace(
         regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+', '<EMAIL>', 'g'),
         '\b[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}\b', '<CPF>', 'g') AS text
FROM documents""")
def masked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "documents").select(
        "doc_id", mask_pii(F.col("text")).alias("text"))


@query("calendar_check", """
SELECT count(*) FILTER (o_orderdate < TIMESTAMP '1900-01-01') > 0 AS has_old_dates,
       CASE WHEN count(*) FILTER (o_orderdate < TIMESTAMP '1900-01-01') > 0 THEN 'LEGACY'
            ELSE 'CORRECTED' END AS rebase_mode
FROM orders""")
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_check(v.table(spark, sf_dir, "orders"), ["o_orderdate"])
