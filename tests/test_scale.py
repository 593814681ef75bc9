"""Plans that have to hold on large tables: pushdown, hot keys, bounded tasks."""

import contextlib
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from latebook.catalog import QUERIES
from latebook.catalog.views import WINDOW, pay, tx
from latebook.operators.cleaning import dedupe
from latebook.operators.monitoring import duration_percentile
from latebook.operators.rules import classify_batch
from latebook.operators.settlement import settle
from latebook.settings import session_conf, shuffle_partitions
from latebook.sinks.tables import write_partitioned

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, value in names.items():
        spark.conf.set(k, value)
    try:
        yield
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
}


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all payments settles one transaction, a third of all transactions
    belongs to one customer."""
    n = 60000
    ids = spark.range(0, n, 1, 8)
    payments = ids.select(
        F.format_string("p%d", "id").alias("payment_id"),
        F.when(F.col("id") % 3 == 0, "t0").otherwise(
            F.format_string("t%d", F.col("id") % 9000)).alias("transaction_id"),
        (F.col("id") % 50 + 1.0).alias("amount_paid"),
        F.expr("timestamp '2000-05-01 00:00:00' + make_dt_interval(cast(id % 90 as int))")
        .alias("payment_date"))
    transactions = spark.range(0, 10000, 1, 8).select(
        F.format_string("t%d", "id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "c0").otherwise(
            F.format_string("c%d", F.col("id") % 700)).alias("customer_id"),
        F.lit(60.0).alias("amount"),
        F.expr("timestamp '2000-03-10 00:00:00' + make_dt_interval(cast(id % 40 as int))")
        .alias("transaction_date"))
    transactions = transactions.withColumn(
        "due_date", F.date_add(F.col("transaction_date").cast("date"), 30))
    return transactions.cache(), payments.cache()


def test_a_hot_transaction_is_split_in_the_join(spark, hot):
    transactions, payments = hot
    # Compared with the plain left join, which cannot split the payments.
    def by_customer(joined):
        return joined.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("rows"), F.count("payment_id").alias("n"),
            F.sum("amount_paid").alias("s"))
    want = by_customer(transactions.join(payments, "transaction_id", "left")).collect()
    with settings(spark, **SKEW):
        got = by_customer(settle(transactions, payments))
        rows = got.collect()
        text = plan(got)
    assert "SortMergeJoin(skew=true)" in text
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, want), key=str)


def test_hot_classification_equals_brute_force(spark, hot):
    transactions, payments = hot
    paid = {}
    for r in payments.collect():
        paid.setdefault(r["transaction_id"], []).append((r["amount_paid"], r["payment_date"]))
    want = {}
    for t in transactions.collect():
        row = want.setdefault(t["customer_id"], [0, 0.0, 0, 0, 0.0])
        for amount, when in paid.get(t["transaction_id"], [(None, None)]):
            day = WINDOW.as_of if when is None else when.date()
            late = (day - t["due_date"]).days
            value = t["amount"] if amount is None else t["amount"] - amount
            if t["transaction_date"].date() >= dt.date(2000, 3, 2) and late > 30:
                row[0] += 1
                row[1] += value
                row[2] = max(row[2], late)
            if t["transaction_date"].date() >= dt.date(1999, 12, 3) and late > 15:
                row[3] += 1
                row[4] += value
    got = classify_batch(transactions, payments, WINDOW, "p").collect()
    assert len(got) == len(want)
    for g in got:
        n1, v1, d1, n2, v2 = want[g["customer_id"]]
        assert g["total_ocorrencias"] == n1 and g["max_dias_atraso"] == d1
        assert g["total_valor_em_aberto"] == pytest.approx(v1 + (v2 if n2 > 3 else 0.0))
        assert set(g["regras_aplicadas"]) == (({"regra1"} if n1 else set())
                                              | ({"regra2"} if n2 > 3 else set()))


def test_copies_are_limited_before_the_shuffle(spark):
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    unique = dedupe(rows, ["k"], ["v"])
    text = plan(unique)
    assert text.index("Final") < text.index("Exchange hashpartitioning(k") < text.index("Partial")
    assert unique.count() == 20001
    assert unique.filter("k = 0").first()["v"] == 0


def test_dates_and_columns_reach_the_scan(spark):
    text = plan(classify_batch(tx(spark, SF), pay(spark, SF), WINDOW, "p"))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    dated = [s for s in scans if "o_custkey" in s and "o_orderdate" in s]
    assert dated and all("o_orderdate" in s.split("DataFilters:")[1] for s in dated)
    assert all("o_orderpriority" not in s and "l_returnflag" not in s for s in scans)
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {
    n for n in QUERIES if n.startswith("stream_") or n == "batch_metrics"}))
def test_plan_has_no_cross_join_no_python_and_no_single_task_window(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    if name != "mom_variation":  # one row per month
        windows = re.findall(r"windowspecdefinition\(([^,]*)", text)
        assert all("ASC" not in w and "DESC" not in w for w in windows)


def test_percentile_of_a_frequent_component(spark):
    logs = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.format_string("c%d", F.col("id") % 5)).alias("entity_name"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("start_time"),
        F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 97)")
        .alias("end_time"))
    exact = logs.groupBy("entity_name").agg(F.expr(
        "percentile(unix_timestamp(end_time) - unix_timestamp(start_time), 0.95)").alias("p"))
    got = {r["entity_name"]: r["p_duration"] for r in duration_percentile(logs).collect()}
    assert got == {r["entity_name"]: r["p"] for r in exact.collect()}


def test_merged_sketches_are_within_their_error(spark):
    import math
    import random

    from latebook.operators.monitoring import duration_sketches, merged_percentile
    rng, start = random.Random(4), dt.datetime(2024, 1, 1)
    rows = [(rng.choice("ab"), start + dt.timedelta(hours=rng.randrange(30)),
             int(rng.lognormvariate(4, 2)) if rng.random() < 0.9 else 0) for _ in range(3000)]
    logs = spark.createDataFrame([(e, t, t + dt.timedelta(seconds=n)) for e, t, n in rows],
                                 "entity_name string, start_time timestamp, end_time timestamp")
    sketches = duration_sketches(logs)
    for first, last, p in ((0, 30, 0.95), (3, 9, 0.5), (10, 11, 0.99), (0, 30, 0.01)):
        low, high = (start + dt.timedelta(hours=h) for h in (first, last))
        span = (F.col("hour") >= F.lit(low)) & (F.col("hour") < F.lit(high))
        for r in merged_percentile(sketches.filter(span), p).collect():
            mine = sorted(n for e, t, n in rows if e == r["entity_name"] and low <= t < high)
            exact = mine[math.ceil(p * len(mine)) - 1]
            assert r["n_runs"] == len(mine) and abs(r["p_duration"] - exact) <= 0.0101 * exact


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    # Random text, so that the rows do not shrink in the shuffle.
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, 2024).otherwise(2000 + F.col("id") % 20).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB"):
        write_partitioned(rows, str(tmp_path / "t"), ["year"])
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 60000
    assert len(list((tmp_path / "t" / "year=2024").glob("*.parquet"))) > 1


def test_settings_grow_with_the_data():
    assert shuffle_partitions(100 * 2**40, 4000) == 819200
    assert session_conf(0, 8)["spark.sql.shuffle.partitions"] == "16"


def test_history_repeats_customers_last(spark):
    """The months without late rows are added after the last shuffle, to one row per customer."""
    text = plan(QUERIES["classify_history"](spark, SF))
    assert "Generate inline" in text[:text.index("Exchange")]
    assert len(re.findall(r"Generate explode", text)) <= 2 and "HashAggregate" not in text[:text.index("Exchange")]


def test_staged_rows_of_a_merge_are_dense(spark, tmp_path, monkeypatch):
    """What an upsert stages has the denser codec; it is written and read as a whole each time."""
    from latebook.sinks import upsert as u
    folders = []

    @contextlib.contextmanager
    def kept(_, name):
        folders.append(tmp_path / f"{name}{len(folders)}")
        yield str(folders[-1])

    monkeypatch.setattr(u, "scratch", kept)
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("part"))
    for _ in range(2):
        u.upsert(spark, "latebook_staged", rows, ["id"], ["id"], ["part"], str(tmp_path / "table"))
    try:
        assert spark.table("latebook_staged").count() == 100
    finally:
        spark.sql("DROP TABLE latebook_staged")
    files = [f.name for folder in folders for f in folder.rglob("*.parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
