"""Suites, gates and status rules on hand-made rows."""

import datetime as dt

import pytest

from latebook.operators import control as c
from latebook.operators import quality as q
from latebook.operators.gold import delinquency_metrics, month_over_month, rate_history
from latebook.operators.governance import role_view


def results(df):
    return {(r["check_name"], r["column_name"]): (r["unexpected_count"], r["unexpected_percent"],
                                                  r["success"]) for r in df.collect()}


def test_suite(spark):
    rows = [("1", "c", dt.datetime(2024, 1, 1), 10.0)] * 2 + [
        (None, "c", None, -1.0), (None, None, dt.datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(
        rows, "transaction_id string, customer_id string, transaction_date timestamp, "
        "amount double")
    got = results(q.run_suite(df, q.TRANSACTION_SUITE))
    assert got[("not_null", "transaction_id")] == (2, 50.0, False)
    assert got[("not_null", "customer_id")] == (1, 25.0, False)
    # Null keys are no duplicates; the two equal ones are.
    assert got[("unique", "transaction_id")] == (2, 100.0, False)
    assert got[("between", "amount")] == (1, 33.33, False)
    assert got[("of_type", "amount")] == (0, 0.0, True)
    assert len(got) == len(q.TRANSACTION_SUITE)


@pytest.mark.parametrize("bad,success", [(1, True), (2, False)])
def test_mostly(spark, bad, success):
    df = spark.createDataFrame([(-1.0,)] * bad + [(1.0,)] * (100 - bad), "v double")
    got = results(q.run_suite(df, [q.Check("between", "v", mostly=0.99)]))
    assert got[("between", "v")] == (bad, float(bad), success)


def test_wrong_type_and_second_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "k long, v string")
    suite = [q.Check("unique", "k"), q.Check("unique", "v"),
             q.Check("of_type", "k", type_name="str")]
    got = results(q.run_suite(df, suite))
    assert got[("unique", "k")] == (0, 0.0, True)
    assert got[("unique", "v")] == (2, 100.0, False)
    assert got[("of_type", "k")] == (3, 100.0, False)


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "payment_id string, transaction_id string, "
                               "payment_date timestamp, amount_paid double")
    assert all(s for _, _, s in results(q.run_suite(df, q.PAYMENT_SUITE)).values())


LOG = ("process_id string, entity_name string, start_time string, end_time string, "
       "status string, total_records_processed long, total_records_error long")


def gate(spark, rows, **options):
    logs = spark.createDataFrame(rows, LOG)
    return {r["entity_name"]: r for r in c.run_gate(logs, **options).collect()}


def test_gate(spark):
    def row(entity, start, status, processed, failed):
        return (entity + start, entity, f"2024-01-01 {start}", "2024-01-01 12:00:00", status,
                processed, failed)
    got = gate(spark, [
        row("ok", "10:00:00", "SUCESSO", 100, 90),
        row("few", "10:00:00", "ERRO", 100, 5), row("many", "10:00:00", "ERRO", 100, 6),
        row("none", "10:00:00", "ERRO", 0, 0), row("none_ok", "10:00:00", "SUCESSO", 0, 0),
        row("again", "10:00:00", "ERRO", 10, 10), row("again", "11:00:00", "SUCESSO", 10, 0),
        row("default", "10:00:00", "ERRO", 10, 1),
    ], thresholds={"few": 0.05, "many": 0.05})
    assert {k: r["passed"] for k, r in got.items()} == {
        "ok": True, "few": True, "many": False, "none": False, "none_ok": True, "again": True,
        "default": True}
    assert got["again"]["duration_seconds"] == 3600


def test_gate_by_stage(spark):
    rows = [(stage, stage, "e", "2024-01-01 10:00:00", "2024-01-01 12:00:00", "ERRO", 100, n)
            for stage, n in (("landing_to_bronze", 4), ("bronze_to_silver", 6),
                             ("silver_to_gold", 3))]
    logs = spark.createDataFrame(rows, "stage_name string, " + LOG)
    got = {r["stage_name"]: (r["threshold"], r["passed"]) for r in c.run_gate(logs).collect()}
    assert got == {"landing_to_bronze": (0.05, True), "bronze_to_silver": (0.05, False),
                   "silver_to_gold": (0.02, False)}
    summary = c.run_summary(logs).first()
    assert (summary["landing_to_bronze_runs"], summary["silver_to_gold_errors"]) == (1, 3)


def test_a_run_without_a_log_passes(spark):
    expected = spark.createDataFrame([("x", dt.date(2024, 1, 1))], "entity_name string, "
                                     "run_date date")
    got = gate(spark, [], expected=expected)
    assert (got["x"]["status"], got["x"]["passed"]) == ("NOT_FOUND", True)


@pytest.mark.parametrize("statuses,overall", [
    (["SUCESSO", "SUCESSO"], "Sucesso"), (["SUCESSO", "ERRO"], "Falha"),
    (["SUCESSO", "CONCLUÍDO"], "Parcial"), (["STARTED", None], "Parcial")])
def test_overall_status(spark, statuses, overall):
    rows = [(dt.date(2024, 1, 1), s) for s in statuses]
    df = spark.createDataFrame(rows, "run_date date, status string")
    assert c.overall_status(df).first()["overall_status"] == overall


def test_quality_gate_looks_at_the_reference_month(spark):
    gold = spark.createDataFrame([(True, "2024-05"), (False, "2024-06")],
                                 "inadimplente boolean, reference_month string")
    metrics = spark.createDataFrame([("2024-05",)], "reference_month string")
    assert c.quality_gate(gold, metrics, "2024-05").first()[0] == 1
    assert c.quality_gate(gold, metrics, "2024-06").first()[0] == 0
    assert c.quality_gate(gold, metrics.limit(0), "2024-05").first()[0] == 0


def test_month_over_month_and_bands(spark):
    rows = [(m, f"c{i}", i < n, 1.0, 0) for m, n in (("2024-04", 1), ("2024-05", 3))
            for i in range(20)]
    gold = spark.createDataFrame(rows, "reference_month string, customer_id string, "
                                 "inadimplente boolean, total_valor_em_aberto double, "
                                 "max_dias_atraso int")
    metrics = delinquency_metrics(gold)
    change = {r["reference_month"]: r["variacao_mes_anterior"]
              for r in month_over_month(metrics).collect()}
    assert change["2024-04"] == 0.0 and change["2024-05"] == pytest.approx(0.1)
    bands = {r["reference_month"]: (r["faixa"], r["critico"])
             for r in rate_history(metrics).collect()}
    assert bands == {"2024-04": ("yellow", False), "2024-05": ("red", False)}


def test_roles_see_what_their_tags_allow(spark):
    df = spark.createDataFrame([("C000123", 5.0, "x")],
                               "customer_id string, amount double, other string")
    assert role_view(df, allowed=()).first().asDict() == {"customer_id": "C0****23", "other": "x"}
    assert role_view(df, allowed=("PII", "Financial")).first() == df.first()
    assert role_view(df, allowed=("Financial",)).first().asDict() == {
        "customer_id": "C0****23", "amount": 5.0, "other": "x"}


def test_log_rows_have_one_schema(spark):
    row = c.process_log_row(spark, process_id="p", status="SUCESSO")
    assert row.first()["data_writing_end"] is None
    with pytest.raises(ValueError):
        c.process_log_row(spark, nonsense=1)
    assert c.as_process_log(spark.range(1)).columns == row.columns
