"""The jobs from landing to gold, on hand-made files."""

import collections
import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from latebook.plans.bronze import ingest
from latebook.plans.gold import publish
from latebook.plans.run import Run
from latebook.plans.silver import refine
from latebook.schemas import ERROR_RECORDS, PROCESS_LOG
from latebook.sources.files import read_raw, split_corrupt

AS_OF = dt.date(2024, 7, 10)


def put(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    text = records if isinstance(records, str) else json.dumps(records, indent=1)
    (folder / name).write_text(text)


def tx(n, customer, date, amount=100.0):
    return {"transaction_id": n, "customer_id": customer, "amount": amount, "date": date}


def pay(n, transaction, date, amount=100.0):
    return {"payment_id": n, "transaction_id": transaction, "amount_paid": amount,
            "date_paid": date}


class Lake:
    def __init__(self, spark, root, tag):
        self.spark, self.root, self.tag = spark, root, tag
        self.control = str(root / "control")

    def run(self, stage, entity, source, target):
        return Run(self.spark, self.control, stage, entity, AS_OF, str(source), str(target))

    def ingest(self, entity, **options):
        table = f"bronze_{entity}_{self.tag}"
        run = self.run("LandingToBronze", entity, self.root / "landing" / entity,
                       self.root / "bronze" / entity)
        ingest(run, table, **options)
        return table, run

    def refine(self, entity):
        run = self.run("BronzeToSilver", entity, self.root / "bronze" / entity,
                       self.root / "silver" / entity)
        return refine(run, self.spark.table(f"bronze_{entity}_{self.tag}")), run

    def logs(self):
        return self.spark.read.schema(PROCESS_LOG).parquet(f"{self.control}/process_logs")

    def errors(self):
        return self.spark.read.schema(ERROR_RECORDS).parquet(f"{self.control}/error_records")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path, tmp_path.name.replace("-", "_"))


def test_array_files_give_no_empty_rows(spark, lake):
    put(lake.root / "landing/transactions", "a.json",
        [tx("1", "c1", "2024-01-05"), tx("2", "c2", "2024-02-05"), tx(3, "c3", "bad")])
    table, run = lake.ingest("transactions")
    rows = {r["transaction_id"]: r for r in spark.table(table).collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert rows["1"]["due_date"] == dt.date(2024, 2, 4)
    assert rows["1"]["source_file"].endswith("a.json") and rows["3"]["transaction_date"] is None
    assert run.log["total_records_processed"] == 3 and run.log["status"] == "SUCESSO"


def test_only_unseen_files_are_taken_and_keys_are_replaced(spark, lake):
    folder = lake.root / "landing/payments"
    put(folder, "a.json", [pay("p1", "1", "2024-02-01"), pay("p2", "2", "2024-02-02")])
    table, _ = lake.ingest("payments")
    put(folder, "b.json", [pay("p2", "2", "2024-03-09", 55.0), pay("p3", "3", "2024-03-03")])
    _, second = lake.ingest("payments")
    assert second.log["total_records_processed"] == 2
    rows = {r["payment_id"]: (r["amount_paid"], r["year"], r["month"])
            for r in spark.table(table).collect()}
    assert rows == {"p1": (100.0, 2024, 2), "p2": (55.0, 2024, 3), "p3": (100.0, 2024, 3)}
    _, third = lake.ingest("payments")
    assert third.log["total_records_processed"] == 0
    assert lake.logs().count() == 3


def test_a_partition_that_loses_all_rows_is_dropped(spark, lake):
    folder = lake.root / "landing/payments"
    put(folder, "a.json", [pay("p1", "1", "2024-02-01"), pay("p2", "2", "2024-05-02")])
    table, _ = lake.ingest("payments")
    put(folder, "b.json", [pay("p1", "1", "2024-05-01")])
    lake.ingest("payments")
    assert sorted((r["payment_id"], r["month"]) for r in spark.table(table).collect()) == [
        ("p1", 5), ("p2", 5)]


def test_broken_lines_go_to_quarantine(spark, lake):
    put(lake.root / "landing/transactions", "a.json",
        json.dumps(tx("1", "c1", "2024-01-05")) + '\n{"transaction_id": "2", "cust\n')
    table, run = lake.ingest("transactions", multi_line=False)
    assert spark.table(table).count() == 1
    assert run.log["total_records_error"] == 1
    record = lake.errors().collect()
    assert len(record) == 1 and "cust" in record[0]["record_content"]


def test_an_empty_landing_folder_is_no_failure(spark, lake):
    (lake.root / "landing/transactions").mkdir(parents=True)
    _, run = lake.ingest("transactions")
    assert run.log["status"] == "CONCLUÍDO"


def test_newest_file_only(spark, lake):
    import os
    folder = lake.root / "landing/transactions"
    put(folder, "old.json", [tx("1", "c1", "2024-01-05")])
    put(folder, "new.json", [tx("2", "c2", "2024-01-05")])
    os.utime(folder / "old.json", (1, 1))
    table, _ = lake.ingest("transactions", newest_only=True)
    assert [r["transaction_id"] for r in spark.table(table).collect()] == ["2"]


def test_failure_is_logged_and_raised(spark, lake):
    run = lake.run("BronzeToSilver", "transactions", "x", lake.root / "silver")
    with pytest.raises(Exception):
        refine(run, spark.range(1))
    log = lake.logs().first()
    assert log["status"] == "ERRO" and log["error_message"]
    assert lake.errors().first()["error_type"] == "PROCESS_FAILURE"


@pytest.mark.parametrize("trust_status", [True, False])
def test_too_many_errors_stop_the_next_stage(spark, lake, trust_status):
    """Six of a hundred records have no key; the stage may lose one in twenty."""
    from latebook.plans.run import GateClosed
    put(lake.root / "landing/transactions", "a.json",
        [tx(str(i) if i > 5 else None, "c", "2024-04-05") for i in range(100)])
    table, landing = lake.ingest("transactions")
    assert landing.log["total_records_error"] == 6
    run = lake.run("BronzeToSilver", "transactions", "x", lake.root / "silver")
    run.trust_status = trust_status
    if trust_status:
        refine(run, spark.table(table))
        return
    with pytest.raises(GateClosed, match="landing_to_bronze"):
        refine(run, spark.table(table))
    log = lake.logs().filter("stage_name = 'bronze_to_silver'").first()
    assert log["status"] == "ERRO"
    gold = lake.run("SilverToGold", "all_entities", "x", lake.root / "gold")
    with pytest.raises(GateClosed, match="bronze_to_silver"):
        publish(gold, spark.table(table), spark.table(table))


def test_landing_to_gold(spark, lake):
    late = [tx(f"late{i}", "slow", "2024-04-05") for i in range(4)]
    put(lake.root / "landing/transactions", "a.json", [
        *late, tx("ok", "good", "2024-03-15"), tx("open", "never", "2024-04-20", 20000.0),
        tx("zero", "zero", "2024-04-20"), tx(None, "lost", "2024-03-15"),
        tx("dup", "good", "2024-03-01")])
    put(lake.root / "landing/payments", "p.json", [
        *[pay(f"p{i}", f"late{i}", "2024-06-10", 90.0) for i in range(4)],
        pay("p-ok", "ok", "2024-04-10"), pay("p-dup", "dup", "2024-03-10"),
        pay("p-zero", "zero", "2024-04-21", 0.0), pay("p-none", "ok", None)])
    silver = {}
    for entity in ("transactions", "payments"):
        lake.ingest(entity)
        silver[entity], run = lake.refine(entity)
        assert run.log["status"] == "SUCESSO"
    kinds = {(r["entity_name"], r["error_type"]): r["count"] for r in
             lake.errors().groupBy("entity_name", "error_type").count().collect()}
    assert kinds == {("transactions", "DATA_VALIDATION_ERROR"): 1,
                     ("payments", "DATA_VALIDATION_ERROR"): 1,
                     ("payments", "PAYMENT_VALUE_WARNING"): 1}
    first = silver["transactions"].filter("transaction_id = 'ok'").first()
    assert first["customer_id_masked"] == "go****od" and first["certificado_qualidade"]
    assert silver["payments"].first()["payment_method"] == "NOT_SPECIFIED"

    run = lake.run("SilverToGold", "all_entities", lake.root / "silver", lake.root / "gold")
    gold = publish(run, silver["transactions"], silver["payments"])
    rows = {r["customer_id"]: r for r in gold.customers.collect()}
    assert set(rows) == {"slow", "good", "never", "zero"}
    assert sorted(rows["slow"]["regras_aplicadas"]) == ["regra1", "regra2"]
    # Rule 1 and rule 2 each add the four open tenths.
    assert rows["slow"]["total_valor_em_aberto"] == 80.0
    assert rows["slow"]["max_dias_atraso"] == 36 and rows["slow"]["severidade"] == "MÉDIA"
    assert not rows["good"]["inadimplente"] and rows["good"]["severidade"] == "NENHUMA"
    # A payment of nothing leaves the transaction unpaid.
    assert rows["zero"]["inadimplente"] and rows["never"]["max_dias_atraso"] == 51
    assert gold.passed and gold.metrics.first()["taxa_inadimplencia"] == 0.75
    assert [r["customer_id"] for r in gold.alerts.collect()] == ["never"]
    offending = {(r["customer_id"], r["regra_aplicada"], r["transaction_id"])
                 for r in gold.violations.collect()}
    assert offending == {("slow", rule, f"late{i}") for rule in ("regra1", "regra2")
                         for i in range(4)} | {("never", "regra1", "open"),
                                               ("zero", "regra1", "zero")}

    # Publishing the month again replaces it.
    again = publish(run, silver["transactions"].filter("customer_id = 'good'"),
                    silver["payments"])
    assert [r["inadimplente"] for r in again.customers.collect()] == [False]
    assert not again.passed and again.metrics.count() == 1
    statuses = {r["process_name"]: r["status"] for r in lake.logs().collect()}
    assert set(statuses.values()) == {"SUCESSO"}
    assert "SilverToGold_all_entities" in statuses


def test_corrected_profile_nets_split_payments(spark, lake):
    from latebook.operators.rules import classify_batch, classify_batch_v2
    from latebook.profiles import AnalysisWindow
    day = dt.datetime(2024, 4, 1)
    transactions = spark.createDataFrame(
        [("t", "c", 100.0, day, dt.date(2024, 5, 1))],
        "transaction_id string, customer_id string, amount double, transaction_date timestamp, "
        "due_date date")
    payments = spark.createDataFrame(
        [("a", "t", 40.0, dt.datetime(2024, 6, 10)), ("b", "t", 60.0, dt.datetime(2024, 6, 12))],
        "payment_id string, transaction_id string, amount_paid double, payment_date timestamp")
    window = AnalysisWindow(AS_OF)
    published = classify_batch(transactions, payments, window, "p").first()
    corrected = classify_batch_v2(transactions, payments, window, "p").first()
    assert published["total_valor_em_aberto"] == 100.0 and published["total_ocorrencias"] == 2
    assert corrected["total_valor_em_aberto"] == 0.0 and corrected["total_ocorrencias"] == 1
    assert corrected["max_dias_atraso"] == 42


def test_source_columns_of_both_schemas(spark, lake):
    from latebook.schemas import RAW_TRANSACTIONS
    from latebook.sources.files import read_parquet
    good, bad = str(lake.root / "good"), str(lake.root / "bad")
    spark.createDataFrame([("1", "c", 1.0, "d")], RAW_TRANSACTIONS).write.parquet(good)
    spark.range(3).write.parquet(bad)
    args = {"entity": "transactions", "process_id": "p", "error_time": "t"}
    rows, issue = read_parquet(spark, good, RAW_TRANSACTIONS, **args)
    assert rows.count() == 1 and issue is None
    rows, issue = read_parquet(spark, bad, RAW_TRANSACTIONS, **args)
    assert rows.count() == 3 and issue.first()["error_type"] == "SCHEMA_MISMATCH"
    assert rows.select(F.sum("id")).first()[0] == 3


def test_formats_and_fallback_of_a_landing_folder(spark, lake):
    from latebook.schemas import RAW_TRANSACTIONS
    from latebook.sources.files import landing_format, read_raw, read_table
    folder = lake.root / "landing"
    folder.mkdir()
    put(lake.root / "root", "transactions.json", [tx("root", "c", "2024-01-01")])
    fallback = str(lake.root / "root/transactions.json")
    assert read_raw(spark, str(folder), "transactions") is None
    read = read_raw(spark, str(folder), "transactions", fallback=fallback)
    assert read.first()["transaction_id"] == "root"
    put(folder, "a.json", [tx("json", "c", "2024-01-01")])
    assert landing_format(spark, str(folder)) == "json"
    spark.createDataFrame([("parquet", "c", 1.0, "2024-01-01")], RAW_TRANSACTIONS).write.parquet(
        str(folder / "b"))
    # Parquet files come first.
    assert landing_format(spark, str(folder)) == "parquet"
    with pytest.raises(ValueError):
        read_raw(spark, str(folder), "customers")
    spark.range(2).write.option("path", str(lake.root / "t")).saveAsTable(f"known_{lake.tag}")
    assert read_table(spark, f"known_{lake.tag}", "nowhere").count() == 2


def test_records_without_key_and_files_of_both_formats(spark, tmp_path, as_of):
    """One record in six has its id; a Parquet file beside the JSON files hides none of them."""
    import json

    from latebook.plans.bronze import ingest
    from latebook.plans.run import Run
    from latebook.schemas import raw_schema

    folder = tmp_path / "in"
    folder.mkdir()

    def record(key, customer):
        return {"transaction_id": key, "customer_id": customer, "amount": 10.0, "date": "2024-05-01"}

    (folder / "a.json").write_text(json.dumps([record("1", "A")] + [record(None, c) for c in "BCDEF"]))
    spark.createDataFrame([("2", "G", 1.0, "2024-05-02")],
                          "transaction_id string, customer_id string, amount double, date string"
                          ).select([c for c in raw_schema("transactions").names if c in (
                              "transaction_id", "customer_id", "amount", "date")]
                          ).write.mode("append").parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    (folder / "b.parquet").write_bytes(part.read_bytes())
    (folder / "c.json").write_text(json.dumps([record("3", "H")]))
    run = Run(spark, str(tmp_path / "control"), "LandingToBronze", "transactions", as_of,
              str(folder), str(tmp_path / "bronze"))
    ingest(run, "latebook_bronze_keys")
    try:
        stored = {r["transaction_id"] for r in spark.table("latebook_bronze_keys").collect()}
        errors = spark.read.parquet(str(tmp_path / "control" / "error_records"))
        log = spark.read.parquet(str(tmp_path / "control" / "process_logs")).first()
        assert stored == {"1", "2", "3"} and errors.count() == 5
        assert log["total_records_processed"] == 3 and log["total_records_error"] == 5
        assert log["total_files_processed"] == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS latebook_bronze_keys")


def partition_filters(df):
    """The partition filters of each file scan of a plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[(.*?)\]", text)


def test_a_merge_reads_only_the_partitions_that_its_keys_name(spark, lake):
    from latebook.sinks.upsert import affected_rows, index_path, index_rows, known_homes, upsert
    table, path, parts = f"indexed_{lake.tag}", str(lake.root / "indexed"), ["year", "month"]

    def rows(*ids, year=2020, value=0):
        return spark.createDataFrame([(str(i), value, year, i % 12 + 1) for i in ids],
                                     "id string, value int, year int, month int")
    touched = []
    upsert(spark, table, rows(*range(400)), ["id"], ["value"], parts, path)
    source = rows(3, 500, year=2021, value=1)
    assert {tuple(r) for r in upsert(spark, table, source, ["id"], ["value"], parts, path,
                                     touched.extend)} == {(2020, 4), (2021, 4), (2021, 9)}
    assert {tuple(r) for r in touched} == {(2020, 4), (2021, 4), (2021, 9)}
    stored = {r["id"]: (r["value"], r["year"], r["month"]) for r in spark.table(table).collect()}
    assert len(stored) == 401 and stored["3"] == (1, 2021, 4) and stored["15"] == (0, 2020, 4)
    mine = index_rows(source, ["id"], parts)
    homes = known_homes(spark, mine, path)
    assert {tuple(r["home"]) for r in homes.collect()} == {(2020, 4), (2021, 4), (2021, 9)}
    assert any("prefix" in f for f in partition_filters(homes))
    affected = affected_rows(spark.table(table), touched)
    assert partition_filters(affected) and all("year" in f for f in partition_filters(affected))
    # The same merge again changes nothing, and a lost index is made anew.
    upsert(spark, table, source, ["id"], ["value"], parts, path)
    before = spark.read.parquet(index_path(path)).count()
    from latebook.workspace import delete_folder
    delete_folder(spark, index_path(path))
    upsert(spark, table, source, ["id"], ["value"], parts, path)
    assert spark.read.parquet(index_path(path)).count() == 401 and before == 402
    assert spark.table(table).count() == 401


def test_a_batch_that_fails_and_runs_again_leaves_each_error_once(spark, lake, monkeypatch):
    from latebook.plans import bronze
    put(lake.root / "landing/transactions", "a.json",
        [tx("1", "c", "2024-01-05"), tx(None, "lost", "2024-01-05"), tx(None, "lost2", "2024-01-06")])
    real = bronze.upsert

    def broken(*args):
        raise OSError("lost")
    monkeypatch.setattr(bronze, "upsert", broken)
    with pytest.raises(Exception, match="lost"):
        lake.ingest("transactions")
    monkeypatch.setattr(bronze, "upsert", real)
    table, run = lake.ingest("transactions")
    kinds = collections.Counter(r["error_type"] for r in lake.errors().collect())
    assert kinds == {"DATA_VALIDATION_ERROR": 2, "PROCESS_FAILURE": 1}
    assert spark.table(table).count() == 1 and run.log["total_records_error"] == 2


def test_silver_follows_the_changes_of_bronze(spark, lake):
    folder = lake.root / "landing/payments"
    put(folder, "a.json", [pay("p1", "1", "2024-02-01"), pay("p2", "2", "2024-03-02"),
                           pay("p3", "3", "2024-04-02"), pay("p4", "4", None), pay("p5", "5", "2024-05-05")])
    lake.ingest("payments")
    silver, first = lake.refine("payments")
    assert first.log["total_records_processed"] == 4
    files = {m: set((lake.root / "silver/payments/year=2024" / f"month={m}").glob("*.parquet"))
             for m in (2, 3, 4, 5)}
    # One new file corrects a payment, moves another one, empties a month and brings a reject.
    put(folder, "b.json", [pay("p2", "2", "2024-03-09", 55.0), pay("p5", "5", "2024-06-05"),
                           pay("p6", "6", None)])
    lake.ingest("payments")
    silver, second = lake.refine("payments")
    assert second.log["total_records_processed"] == 2
    root = lake.root / "silver/payments/year=2024"
    assert {m: set((root / f"month={m}").glob("*.parquet")) for m in (2, 4)} == {
        m: files[m] for m in (2, 4)}
    assert not set((root / "month=3").glob("*.parquet")) & files[3] and not (root / "month=5").exists()
    rows = {r["payment_id"]: (r["amount_paid"], r["month"]) for r in silver.collect()}
    assert rows == {"p1": (100.0, 2), "p2": (55.0, 3), "p3": (100.0, 4), "p5": (100.0, 6)}
    rejects = [json.loads(r["record_content"])["payment_id"] for r in
               lake.errors().filter("error_type = 'DATA_VALIDATION_ERROR'").collect()]
    assert sorted(rejects) == ["p4", "p6"]
    # Without changes nothing is written.
    silver, third = lake.refine("payments")
    assert third.log["status"] == "CONCLUÍDO" and silver.count() == 4


def test_an_array_is_read_by_several_tasks(spark, lake):
    records = [tx(str(i), f"c{i % 7}", "2024-04-05", float(i)) for i in range(20_000)]
    for name, text in (("pretty.json", json.dumps(records, indent=2)), ("flat.json", json.dumps(records)),
                       ("lines.json", "\n".join(map(json.dumps, records)))):
        put(lake.root / name[:-5], name, text)
        size = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200KB")
        try:
            raw = read_raw(spark, str(lake.root / name[:-5]), "transactions")
            assert raw.rdd.getNumPartitions() > 4
            good, bad = split_corrupt(raw)
            assert bad.count() == 0 and good.select("transaction_id").distinct().count() == 20_000
            assert good.agg(F.sum("amount")).first()[0] == sum(range(20_000))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_arrays_with_braces_in_texts_and_cut_files(spark, lake):
    folder = lake.root / "landing/transactions"
    put(folder, "odd.json", [tx("1", "a{b}", "2024-01-05"), tx("2", "}{", "2024-01-06"), tx(3, "c", "2024-01-07")])
    put(folder, "empty.json", "[]")
    put(folder, "cut.json", json.dumps([tx("4", "d", "2024-01-05"), tx("5", "e", "2024-01-05", 500.0)])[:-8])
    table, run = lake.ingest("transactions")
    rows = {r["transaction_id"]: r["customer_id"] for r in spark.table(table).collect()}
    assert rows == {"1": "a{b}", "2": "}{", "3": "c", "4": "d"}
    record = lake.errors().filter("error_message = 'Registro ilegível'").collect()
    assert len(record) == 1 and '\\"5\\"' in record[0]["record_content"]


def test_nothing_is_left_in_the_shared_folder(spark, lake):
    from latebook.workspace import shared_root, subfolders
    before = set(subfolders(spark, f"{shared_root(spark)}/latebook"))
    put(lake.root / "landing/transactions", "a.json", [tx("1", "c", "2024-04-05")])
    put(lake.root / "landing/payments", "a.json", [pay("1", "1", "2024-04-15")])
    silver = {}
    for entity in ("transactions", "payments"):
        lake.ingest(entity)
        silver[entity], _ = lake.refine(entity)
    run = lake.run("SilverToGold", "all_entities", lake.root / "silver", lake.root / "gold")
    gold = publish(run, silver["transactions"], silver["payments"])
    row = gold.customers.first()
    assert row["dt_snapshot"] == "2024-06-30" and row["dt_processamento"] == row["dt_atualizacao"]
    with pytest.raises(Exception):
        publish(run, silver["transactions"].drop("amount"), silver["payments"])
    assert set(subfolders(spark, f"{shared_root(spark)}/latebook")) == before


def test_published_columns_are_tagged_and_views_are_closed(spark, lake):
    from latebook.operators.governance import policy_view, tagged, untagged
    from latebook.schemas import STREAM_DETAIL
    put(lake.root / "landing/transactions", "a.json", [tx("1", "c", "2024-04-05")])
    put(lake.root / "landing/payments", "a.json", [pay("1", "1", "2024-04-15")])
    silver = {}
    for entity in ("transactions", "payments"):
        lake.ingest(entity)
        silver[entity], _ = lake.refine(entity)
    run = lake.run("SilverToGold", "all_entities", lake.root / "silver", lake.root / "gold")
    gold = publish(run, silver["transactions"], silver["payments"])
    for df in (*silver.values(), gold.customers, gold.metrics, gold.alerts, gold.violations,
               spark.createDataFrame([], STREAM_DETAIL)):
        assert untagged(tagged(df)) == []
    seen = policy_view(tagged(silver["transactions"]).withColumn("new", F.lit(1)), (), "salt")
    assert not {"new", "amount", "valor_classificacao"} & set(seen.columns)
    assert len(seen.first()["customer_id"]) == 64
    # Tags go along into files, and an allowed tag shows its columns.
    path = str(lake.root / "view")
    tagged(silver["transactions"]).write.parquet(path)
    full = policy_view(spark.read.parquet(path), ("PII", "Financial"), "salt")
    assert set(full.columns) == set(silver["transactions"].columns) and full.first()["amount"] == 100.0
