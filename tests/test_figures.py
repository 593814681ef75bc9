"""Known figures of the classification at sf0.01."""

import pytest
from pyspark.sql import functions as F

from latebook.catalog import QUERIES
from latebook.catalog.views import pay, tx

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def gold(spark):
    return QUERIES["classify_batch"](spark, SF).cache()


def test_inputs(spark):
    assert pay(spark, SF).count() == 45832
    joined = QUERIES["join_tx_pay"](spark, SF)
    assert joined.count() == 46089
    assert joined.filter("payment_id is null").count() == 257
    assert tx(spark, SF).select("customer_id").distinct().count() == 1500


def test_rules(spark):
    first = QUERIES["rule1_late30_90d"](spark, SF)
    assert first.count() == 879
    assert first.select("customer_id").distinct().count() == 581
    assert QUERIES["rule2_repeat_late"](spark, SF).count() == 43


def test_classification(gold):
    assert gold.count() == 1500
    assert gold.filter("inadimplente").count() == 583
    by_severity = {r[0]: r[1] for r in gold.groupBy("severidade").count().collect()}
    assert by_severity == {"CRÍTICA": 505, "ALTA": 36, "MÉDIA": 40, "NENHUMA": 919}
    total = gold.agg(F.round(F.sum("total_valor_em_aberto"), 2), F.max("max_dias_atraso")).first()
    assert tuple(total) == (214588128.79, 563)


def test_a_customer_of_rule_2_only_keeps_no_severity(gold):
    only = gold.filter("regras_aplicadas = 'regra2'").collect()
    assert len(only) == 2
    assert {(r["inadimplente"], r["severidade"], r["total_ocorrencias"]) for r in only} == {
        (True, "NENHUMA", 0)}


def test_corrected_classification_gives_every_delinquent_a_severity(spark):
    fixed = QUERIES["classify_batch_v2"](spark, SF)
    assert fixed.filter("inadimplente and severidade = 'NENHUMA'").count() == 0


def test_alerts(spark):
    assert QUERIES["delinquency_alerts"](spark, SF).count() == 571


def test_dirty_views(spark):
    counts = {r["entity_name"]: r.asDict() for r in QUERIES["cleaning_summary"](spark, SF).collect()}
    assert counts["transactions"]["initial_count"] == 15300
    assert counts["transactions"]["invalid_count"] == 525
    assert counts["transactions"]["final_count"] == 14484
    assert counts["payments"]["invalid_count"] == 555
    assert counts["payments"]["final_count"] == 45397
    assert QUERIES["nonpositive_payments"](spark, SF).count() == 1178
    assert QUERIES["inconsistent_dates"](spark, SF).count() == 165
