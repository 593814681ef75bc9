"""Edge cases of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from latebook import functions as fn
from latebook.profiles import AnalysisWindow
from latebook.sources.files import json_valid, route_entity


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_dates_that_cannot_be_read_are_null(spark):
    rows = [("2024-02-29",), ("2024-02-29 13:45:00",), ("2023-02-29",), ("bad",), ("",), (None,)]
    parsed = values(spark, rows, "d string", fn.parse_timestamp(F.col("d")).cast("string"))
    assert parsed == ["2024-02-29 00:00:00", "2024-02-29 13:45:00", None, None, None, None]
    due = values(spark, rows, "d string", fn.due_date(F.col("d")))
    assert due[0] == dt.date(2024, 3, 30) and due[2:] == [None] * 4


@pytest.mark.parametrize("amount,band", [
    (99.99, "BAIXO"), (100.0, "MÉDIO"), (499.99, "MÉDIO"), (500.0, "ALTO"), (999.99, "ALTO"),
    (1000.0, "MUITO_ALTO"), (-5.0, "BAIXO")])
def test_amount_bands(spark, amount, band):
    assert values(spark, [(amount,)], "a double", fn.amount_band(F.col("a"))) == [band]


def test_severity_limits_are_exclusive(spark):
    rows = [(d,) for d in (15, 16, 30, 31, 60, 61, 90, 91, None)]
    assert values(spark, rows, "d int", fn.severity(F.col("d"))) == [
        "NENHUMA", "BAIXA", "BAIXA", "MÉDIA", "MÉDIA", "ALTA", "ALTA", "CRÍTICA", "NENHUMA"]


def test_days_late(spark):
    rows = [(dt.date(2024, 1, 31), dt.date(2024, 1, 1), "completed"),
            (dt.date(2023, 12, 30), dt.date(2024, 1, 1), "completed"),
            (None, dt.date(2024, 1, 1), None),
            (dt.date(2024, 1, 2), dt.date(2024, 1, 1), "pending")]
    df = spark.createDataFrame(rows, "paid date, due date, status string")
    day = dt.date(2024, 3, 1)
    got = df.select(fn.days_late(F.col("paid"), F.col("due"), day),
                    fn.days_late_clamped(F.col("paid"), F.col("status"), F.col("due"), day))
    assert [tuple(r) for r in got.collect()] == [(30, 30), (-2, 0), (60, 60), (1, 60)]


def test_mask_keeps_two_characters_at_each_end(spark):
    rows = [("A",), ("CV",), ("C000123",), (None,)]
    assert values(spark, rows, "c string", fn.mask_partial(F.col("c"))) == [
        "A****A", "CV****CV", "C0****23", None]
    hashed = values(spark, rows, "c string", fn.pseudonym(F.col("c"), "s"))
    assert all(len(h) == 64 for h in hashed[:3]) and len(set(hashed[:3])) == 3


def test_hash_skips_nulls(spark):
    rows = [("a", None, "b"), ("a", "b", None)]
    keys = values(spark, rows, "x string, y string, z string", fn.key_hash(["x", "y", "z"]))
    assert keys[0] == keys[1]


def test_key_columns_by_name():
    assert fn.discovered_key_columns(["transaction_id", "customer_id", "amount", "date"]) == [
        "transaction_id", "customer_id"]
    assert len(fn.discovered_key_columns(
        ["payment_id", "transaction_id", "amount_paid", "date_paid"])) == 4
    assert fn.discovered_key_columns(["a", "b"]) == ["a", "b"]


def test_redaction_replaces_whole_words(spark):
    text = "old_customer_id2=7 mycpf: 1, E-mail emails no_match écpf"
    got = values(spark, [(text,)], "t string", fn.redact_names(F.col("t")))[0]
    assert got == ("*********(redacted)=7 *********(redacted): 1, E-mail *********(redacted) "
                   "no_match é*********(redacted)")


def test_redaction_is_linear_on_long_words(spark):
    words = [("x" * 400000,), ("x" * 400000 + "cpf" + "y" * 10,)]
    got = values(spark, words, "t string", F.length(fn.redact_names(F.col("t"))))
    assert got == [400000, 19]


def test_personal_data_in_text(spark):
    text = "to joao.silva@mail.example.com, CPF 123.456.789-09 or 12345678909; no 1234567890123"
    joined = "a@b_c@d e@@f " + "x" * 300000 + "@y.z " + "w" * 300000
    got = values(spark, [(text,), (joined,), (None,)], "t string", fn.mask_pii(F.col("t")))
    assert got == ["to <EMAIL>, CPF <CPF> or <CPF>; no 1234567890123",
                   "<EMAIL><EMAIL> e@@f <EMAIL> " + "w" * 300000, None]


def test_json_and_routing(spark):
    rows = [('{"a": 1}',), ("[1, 2]",), ('{"a": 1',), ("",), (None,)]
    assert values(spark, rows, "t string", json_valid(F.col("t"))) == [
        True, True, False, False, None]
    paths = [("gs/Transactions/1.json",), ("x/PAYMENT.json",), ("other",),
             ("payments/transaction.json",)]
    assert values(spark, paths, "p string", route_entity(F.col("p"))) == [
        "transactions", "payments", None, "transactions"]


def test_analysis_window():
    window = AnalysisWindow(dt.date(2000, 6, 15))
    assert window.reference_date == dt.date(2000, 5, 31)
    assert window.reference_month == "2000-05"
    assert window.lookback(90) == dt.date(2000, 3, 2)
    assert window.lookback(180) == dt.date(1999, 12, 3)
    assert window.execution_id == "20000615_000000"
