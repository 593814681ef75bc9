"""Streams against their batch twins, late data, batch functions."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from latebook.operators.rules import stream_profile
from latebook.plans.streams import StreamJob
from latebook.schemas import RAW_PAYMENTS, RAW_TRANSACTIONS, STREAM_DETAIL
from latebook.sources.broker import dead_letters, decode_messages, kafka_options, offset_gaps
from latebook.streaming import sources as s
from latebook.streaming.batches import alert_writer, metrics_writer
from latebook.streaming.detail import Bounds, current_rows, settle_streams
from latebook.streaming.metrics import window_alerts, window_metrics
from latebook.streaming.runner import finish, start_batches, start_table

AS_OF = dt.date(2024, 7, 10)


def lines(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))
    time.sleep(0.01)


def tx(n, day, customer="c"):
    return {"transaction_id": n, "customer_id": customer, "amount": 100.0, "date": day}


def pay(n, transaction, day):
    return {"payment_id": n, "transaction_id": transaction, "amount_paid": 100.0,
            "date_paid": day}


def streams(spark, root, max_files=None):
    transactions = s.transaction_events(
        s.file_stream(spark, str(root / "tx"), RAW_TRANSACTIONS, max_files=max_files))
    payments = s.payment_events(
        s.file_stream(spark, str(root / "pay"), RAW_PAYMENTS, max_files=max_files))
    return transactions, payments


def run(spark, df, root, name):
    finish(start_table(df, str(root / name), str(root / f"{name}-checkpoint"), trigger=None))
    return spark.read.schema(df.schema).parquet(str(root / name))


@pytest.fixture
def events(tmp_path):
    lines(tmp_path / "tx", "a.json", [
        tx("paid", "2024-01-10"), tx("unpaid", "2024-01-10"), tx("early", "2024-01-10"),
        tx("last", "2024-01-10"), tx("over", "2024-01-10"), tx("twice", "2024-01-10"),
        tx("open", "2024-06-01"), tx("end", "2024-06-20")])
    lines(tmp_path / "pay", "a.json", [
        pay("p1", "paid", "2024-02-20"), pay("p2", "early", "2024-01-09"),
        pay("p3", "last", "2024-04-09"), pay("p4", "over", "2024-04-10"),
        pay("p5", "twice", "2024-02-01"), pay("p6", "twice", "2024-03-01"),
        pay("p7", "nobody", "2024-06-20"), pay("p8", "end", "2024-06-21")])
    return tmp_path


SETTLED = [("early", None), ("end", "p8"), ("last", "p3"), ("over", None), ("paid", "p1"),
           ("twice", "p5"), ("twice", "p6"), ("unpaid", None)]


@pytest.mark.parametrize("salts", [1, 3])
def test_settlement_bounds(spark, events, salts):
    joined = settle_streams(*streams(spark, events), Bounds(salts=salts))
    rows = run(spark, joined, events, "out").select("transaction_id", "payment_id").collect()
    # "open" may still be paid; a payment before the transaction or too late does not count.
    assert sorted((tuple(r) for r in rows), key=str) == sorted(SETTLED, key=str)


@pytest.mark.parametrize("salts", [1, 3])
def test_batch_twin_has_the_open_transaction_too(spark, events, salts):
    transactions = s.transaction_events(
        spark.read.schema(RAW_TRANSACTIONS).json(str(events / "tx")))
    payments = s.payment_events(spark.read.schema(RAW_PAYMENTS).json(str(events / "pay")))
    rows = settle_streams(transactions, payments, Bounds(salts=salts)).select(
        "transaction_id", "payment_id").collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(
        [*SETTLED, ("open", None)], key=str)


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    lines(tmp_path / "tx", "1.json", [tx("now", "2024-06-01")])
    lines(tmp_path / "tx", "2.json", [tx("next", "2024-06-10")])
    lines(tmp_path / "tx", "3.json", [tx("late", "2024-05-01"), tx("end", "2024-07-01")])
    raw = s.file_stream(spark, str(tmp_path / "tx"), RAW_TRANSACTIONS, max_files=1)
    rows = s.transaction_events(raw).withColumns({
        "days_late": F.lit(0), "inadimplente": F.lit(False), "reference_month": F.lit("m"),
        "reference_quarter": F.lit("q")})
    metrics = window_metrics(rows, delay="2 hours").drop("window")
    days = run(spark, metrics, tmp_path, "m").select(
        F.date_format("window_start", "yyyy-MM-dd")).collect()
    assert sorted(r[0] for r in days) == ["2024-06-01", "2024-06-10"]


@pytest.mark.parametrize("salts", [1, 4])
def test_repeated_deliveries(spark, tmp_path, salts):
    lines(tmp_path / "tx", "1.json", [tx("a", "2024-06-01"), tx("b", "2024-06-01")] * 50)
    lines(tmp_path / "tx", "2.json", [tx("a", "2024-06-01"), tx("c", "2024-06-01")])
    events = s.transaction_events(
        s.file_stream(spark, str(tmp_path / "tx"), RAW_TRANSACTIONS))
    unique = s.unique_within(events, ["transaction_id"], "transaction_date", "2 days", salts)
    rows = run(spark, unique, tmp_path, "u").select("transaction_id").collect()
    assert sorted(r[0] for r in rows) == ["a", "b", "c"]


def test_decoding_of_messages(spark):
    rows = [(bytearray(json.dumps(tx("1", "2024-01-10")).encode()), dt.datetime(2024, 1, 11)),
            (bytearray(b"{broken"), dt.datetime(2024, 1, 12))]
    messages = spark.createDataFrame(rows, "value binary, timestamp timestamp")
    decoded = decode_messages(messages, RAW_TRANSACTIONS).collect()
    assert [r["transaction_id"] for r in decoded] == ["1"]
    assert decoded[0]["kafka_timestamp"] == dt.datetime(2024, 1, 11)
    dead = dead_letters(messages, RAW_TRANSACTIONS).collect()
    assert [(bytes(r["value"]), r["kafka_timestamp"]) for r in dead] == [
        (b"{broken", dt.datetime(2024, 1, 12))]
    with pytest.raises(TypeError):
        kafka_options("host:9092", "transactions")
    options = kafka_options("host:9092", "transactions", starting_offsets="earliest",
                            fail_on_data_loss=True)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "true"
    assert options["maxOffsetsPerTrigger"] == "10000"


def test_offset_gaps_against_brute_force(spark):
    rng = random.Random(3)
    kept = {(p, o) for p in range(3) for o in range(100, 400) if rng.random() < 0.9 and not 170 < o < 260}
    messages = spark.createDataFrame([("t", p, o) for p, o in kept] * 2,
                                     "topic string, partition int, offset long")
    want = []
    for p in range(3):
        mine = sorted(o for q, o in kept if q == p)
        want += [("t", p, a + 1, b - 1) for a, b in zip(mine, mine[1:]) if b > a + 1]
    for block in (16, 1 << 20):
        assert sorted(map(tuple, offset_gaps(messages, block).collect())) == want


def test_the_whole_streaming_job(spark, events):
    job = StreamJob(str(events / "out"), str(events / "checkpoints"), Bounds(), trigger=None,
                    as_of=AS_OF)
    transactions, payments = streams(spark, events)
    finish(job.detail(transactions, payments))
    detail = job.detail_rows(spark)
    profile = stream_profile(settle_streams(transactions, payments), AS_OF)
    assert dict(profile.dtypes) == {f.name: f.dataType.simpleString() for f in STREAM_DETAIL}
    late = {(r["transaction_id"], r["payment_id"]): (r["days_late"], r["inadimplente"])
            for r in detail.collect()}
    assert late[("paid", "p1")] == (11, False)
    # Unpaid since February: late, but older than the six months of the second criterion.
    assert late[("unpaid", None)] == (152, False)
    assert late[("end", "p8")] == (0, False)
    finish(job.metrics(spark))
    metrics = job.windows(spark)
    assert [(m["total_transactions"], m["total_atrasados"], m["max_dias_atraso"])
            for m in metrics.orderBy("window_start").collect()] == [(7, 6, 152), (1, 0, 0)]
    seen = []
    finish(job.alerts(spark, lambda batch, df: seen.append((batch, df.count()))))
    assert seen == []
    finish(job.batch_metrics(spark))
    stored = spark.read.parquet(str(events / "out/metrics")).first()
    assert (stored["total_records"], stored["default_count"]) == (8, 0)
    # Running again finds nothing new and changes nothing.
    finish(job.detail(transactions, payments))
    assert job.detail_rows(spark).count() == 8


def test_metrics_of_several_batches_hold_every_detail_row(spark, tmp_path):
    """Unpaid rows come long after their day; they count in windows that other batches began."""
    job = StreamJob(str(tmp_path / "out"), str(tmp_path / "checkpoints"), trigger=None,
                    as_of=dt.date(2024, 6, 25))
    for n, day in enumerate(["2024-01-10", "2024-02-20", "2024-04-20", "2024-05-15"]):
        lines(tmp_path / "tx", f"{n}.json", [
            tx(f"slow{n}", day), tx(f"unpaid{n}", day), tx(f"prompt{n}", day)])
        due = dt.date.fromisoformat(day)
        lines(tmp_path / "pay", f"{n}.json", [
            pay(f"p{n}", f"prompt{n}", str(due + dt.timedelta(days=2)))])
        finish(job.detail(*streams(spark, tmp_path)))
        finish(job.metrics(spark))
        finish(job.alerts(spark))
    lines(tmp_path / "tx", "9.json", [tx("end", "2024-06-24")])
    lines(tmp_path / "pay", "9.json", [pay("p9", "slow0", "2024-06-24")])
    for _ in range(2):
        finish(job.detail(*streams(spark, tmp_path)))
        finish(job.metrics(spark))
    changes = spark.read.schema(STREAM_DETAIL).parquet(job.changes).select(*STREAM_DETAIL.names)
    states = spark.read.option("basePath", f"{job.output}/inadimplencia_metricas/batches").parquet(
        f"{job.output}/inadimplencia_metricas/batches")
    assert states.select("batch").distinct().count() >= 4
    metrics = job.windows(spark)
    total = metrics.agg(F.sum("total_transactions"), F.sum("total_inadimplentes")).first()
    assert tuple(total) == (changes.count(), changes.filter("inadimplente").count())
    rows = {(r["transaction_id"], r["payment_id"]): r for r in changes.collect()}
    # Unpaid for 36 days since its due day, 66 days old: the first criterion holds.
    assert rows[("unpaid2", None)]["criterio_1"]
    # Reported as unpaid, then paid: the newer row stands, in the table as in the plain rows.
    assert ("slow0", None) in rows and ("slow0", "p9") in rows
    for current in (current_rows(changes), job.detail_rows(spark)):
        newest = [r["payment_id"] for r in current.filter("transaction_id = 'slow0'").collect()]
        assert newest == ["p9"]
    assert sorted(map(str, current_rows(changes).collect())) == sorted(
        map(str, job.detail_rows(spark).collect()))


def settled_pairs(rows):
    return sorted(((r["transaction_id"], r["payment_id"]) for r in rows.select(
        "transaction_id", "payment_id").collect()), key=str)


@pytest.mark.parametrize("salts", [1, 3])
def test_early_and_late_payments_settle_as_in_the_batch_join(spark, tmp_path, salts):
    """Payments years before and after; unpaid rows come out and are taken back."""
    bounds = Bounds(before=None, within=None, unpaid_after="61 days", salts=salts)
    job = StreamJob(str(tmp_path / "out"), str(tmp_path / "checkpoints"), bounds, trigger=None,
                    as_of=AS_OF)
    days = ["2020-01-10", "2021-02-10", "2022-03-10", "2023-04-10", "2024-05-10"]
    for n, day in enumerate(days):
        lines(tmp_path / "tx", f"{n}.json", [
            tx(f"{kind}{n}", day) for kind in ("early", "late", "never", "both", "prompt")])
        lines(tmp_path / "pay", f"{n}.json", [
            *[pay(f"e{n}{m}", f"{kind}{m}", day) for m in range(n + 1, 5) for kind in ("early", "both")],
            *[pay(f"l{n}{m}", f"{kind}{m}", day) for m in range(n) for kind in ("late", "both")],
            pay(f"p{n}", f"prompt{n}", day)])
        finish(job.detail(*streams(spark, tmp_path)))
    lines(tmp_path / "tx", "9.json", [tx("end", "2024-12-01")])
    lines(tmp_path / "pay", "9.json", [pay("p9", "end", "2024-12-02")])
    for _ in range(2):
        finish(job.detail(*streams(spark, tmp_path)))
    transactions = s.transaction_events(spark.read.schema(RAW_TRANSACTIONS).json(str(tmp_path / "tx")))
    payments = s.payment_events(spark.read.schema(RAW_PAYMENTS).json(str(tmp_path / "pay")))
    whole = transactions.join(payments, "transaction_id", "left")
    assert settled_pairs(job.detail_rows(spark)) == settled_pairs(whole)
    unpaid = spark.read.schema(STREAM_DETAIL).parquet(job.changes).filter("payment_id is null")
    assert unpaid.filter("transaction_id like 'late%'").count() >= 3
    # An emptied partition leaves no folder behind.
    left = {str(x.parent.name) for x in (tmp_path / "out/inadimplencia_detalhes").glob(
        "settled=false/*/*/*/*/batch=-1")}
    stored = job.detail_rows(spark).filter("payment_id is null")
    assert len(left) <= stored.select("year", "month", "inadimplente").distinct().count()


def test_a_repeated_batch_leaves_the_same_settled_table(spark, tmp_path):
    from latebook.streaming.batches import settlement_writer

    def detail(*rows):
        joined = spark.createDataFrame(
            [(t, dt.datetime(2024, 1, 10), dt.date(2024, 2, 9), p, when, "completed", 2024, 1)
             for t, p, when in rows],
            "transaction_id string, transaction_date timestamp, due_date date, payment_id string, "
            "payment_date timestamp, status string, year int, month int")
        return stream_profile(joined, AS_OF)

    write = settlement_writer(str(tmp_path / "t"), str(tmp_path / "c"), "61 days")
    batches = [detail(("a", "p", dt.datetime(2024, 1, 11)), ("x", "q", dt.datetime(2024, 6, 1))),
               detail(("b", None, None), ("c", None, None), ("x", None, None)),
               detail(("b", "r", dt.datetime(2024, 6, 2)))]
    for n, batch in enumerate(batches):
        write(batch, n)
        write(batch, n)
    write(batches[1], 1)
    write(batches[2], 2)
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert settled_pairs(rows) == [("a", "p"), ("b", "r"), ("c", None), ("x", "q")]


def test_fifty_batches_are_read_as_a_snapshot_and_its_tail(spark, tmp_path):
    from latebook.sinks.folded import stored_rows
    from latebook.streaming.batches import stored_windows, window_writer

    def state(n, percent):
        when = dt.datetime(2024, 1, 10) + dt.timedelta(minutes=10 * (n % 7))
        return spark.createDataFrame(
            [(when, when, "m", "q", n, 1, percent)],
            "window_start timestamp, window_end timestamp, reference_month string, "
            "reference_quarter string, total_transactions long, total_inadimplentes long, "
            "percentual_inadimplentes double")
    path, seen = str(tmp_path / "windows"), []
    write = window_writer(path, every=10)
    alert = alert_writer(str(tmp_path / "alerts"), lambda b, df: seen.append(b), every=10)
    for n in range(50):
        write(state(n, 30.0), n)
        # the first window falls below the limit once, and passes it again
        alert(state(n, 10.0 if n == 21 else 30.0), n)
    schema = state(0, 0.0).schema
    rows = stored_windows(spark, path, schema).orderBy("window_start").collect()
    assert [r["total_transactions"] for r in rows] == [49, 43, 44, 45, 46, 47, 48]
    folders = {f.rsplit("/", 2)[1] for f in stored_rows(spark, path, schema).inputFiles()}
    assert "upto=49" in folders and len(folders) == 1
    assert len(list((tmp_path / "windows/batches").iterdir())) <= 20
    assert seen == [0, 1, 2, 3, 4, 5, 6, 28]
    write(state(49, 30.0), 49)
    assert stored_windows(spark, path, schema).count() == 7


@pytest.mark.parametrize("salts", [1, 3])
def test_payments_shortly_before_their_transaction(spark, events, salts):
    joined = settle_streams(*streams(spark, events), Bounds(salts=salts, before="2 days"))
    rows = run(spark, joined, events, "out").select("transaction_id", "payment_id").collect()
    assert sorted(r[1] for r in rows if r[0] == "early") == ["p2"]


def test_one_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    lines(tmp_path / "tx", "1.json", [tx(str(i), "2024-06-01") for i in range(200)])
    session = spark.newSession()
    # Adaptive execution would join tasks as small as these.
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "16")
    raw = s.file_stream(session, str(tmp_path / "tx"), RAW_TRANSACTIONS)
    finish(start_table(raw, str(tmp_path / "out"), str(tmp_path / "c"), ("date",), trigger=None))
    assert len(list((tmp_path / "out").glob("date=*/*.parquet"))) > 2


def test_alert_function_calls_only_for_alerts(spark, tmp_path):
    rows = spark.createDataFrame(
        [("2024-01-10 00:00:00", 30.0), ("2024-01-11 00:00:00", 10.0)], "at string, p double")
    alerts = rows.select(
        F.col("at").cast("timestamp").alias("window_start"),
        F.col("at").cast("timestamp").alias("window_end"), F.lit("m").alias("reference_month"),
        F.lit("q").alias("reference_quarter"), F.lit(1).alias("total_transactions"),
        F.lit(1).alias("total_inadimplentes"), F.col("p").alias("percentual_inadimplentes"))
    seen = []
    write = alert_writer(str(tmp_path / "alerts"), lambda b, df: seen.append((b, df.count())))
    write(window_alerts(alerts), 7)
    write(window_alerts(alerts, 50.0), 8)
    write(window_alerts(alerts), 7)
    assert seen == [(7, 1), (7, 1)]
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 1


def test_a_repeated_batch_replaces_its_own_output(spark, tmp_path):
    rows = spark.createDataFrame([(True,), (False,), (True,)], "inadimplente boolean")
    clock = iter([dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2), AS_OF])
    write = metrics_writer(str(tmp_path), clock=lambda: next(clock))
    write(rows, 0)
    write(rows, 0)
    write(rows.filter("not inadimplente"), 1)
    metrics = spark.read.parquet(str(tmp_path / "metrics")).orderBy("batch").collect()
    assert [(m["batch"], m["default_count"], m["day"]) for m in metrics] == [
        (0, 2, 2), (1, 0, 10)]
    assert spark.read.parquet(str(tmp_path / "defaulters_details")).count() == 2


def test_processing_time_batches(spark, tmp_path):
    lines(tmp_path / "tx", "1.json", [tx("a", "2024-06-01")])
    lines(tmp_path / "tx", "2.json", [tx("b", "2024-06-02")])
    seen = []
    raw = s.file_stream(spark, str(tmp_path / "tx"), RAW_TRANSACTIONS, max_files=1)
    finish(start_batches(raw, lambda df, n: seen.append((n, df.count())),
                         str(tmp_path / "checkpoint"), trigger=None))
    assert seen == [(0, 1), (1, 1)]


def test_stream_profile_uses_only_completed_payments(spark):
    rows = spark.createDataFrame(
        [("t", dt.datetime(2024, 5, 1), dt.date(2024, 5, 31), dt.datetime(2024, 6, 1), "pending")],
        "transaction_id string, transaction_date timestamp, due_date date, "
        "payment_date timestamp, status string")
    row = stream_profile(rows, AS_OF).first()
    assert (row["payment_done"], row["days_late"], row["criterio_1"]) == (False, 40, True)
    assert (row["reference_month"], row["reference_quarter"]) == ("2024-07", "2024-Q3")


def test_a_backlog_is_settled_as_the_state_store_does(spark, tmp_path):
    """Three runs with early, late, repeated and dropped events; a batch that runs again changes nothing."""
    rng, day = random.Random(5), dt.date(2024, 1, 1)
    runs = []
    for low, high in ((0, 60), (60, 120), (120, 220)):
        when = [str(day + dt.timedelta(days=rng.randrange(low, high))) for _ in range(60)]
        runs.append(([tx(f"t{low}-{n}", d) for n, d in enumerate(when)],
                     [pay(f"p{low}-{n}", f"t{rng.choice((0, 60, 120))}-{rng.randrange(60)}",
                          rng.choice(when)) for n in range(45)]))
    runs[2][1].append(pay("behind", "t0-1", "2023-12-01"))
    runs[2][0].append(tx("behind", "2023-12-01"))
    found = {}
    for backlog in (False, True):
        root = tmp_path / str(backlog)
        job = StreamJob(str(root / "out"), str(root / "checkpoints"), trigger=None, as_of=AS_OF, backlog=backlog)
        for number, (left, right) in enumerate(runs):
            lines(root / "tx", f"{number}.json", left)
            lines(root / "pay", f"{number}.json", right)
            finish(job.detail(*streams(spark, root)))
        columns = ["transaction_id", "payment_id", "days_late", "inadimplente"]
        found[backlog] = [sorted(map(str, rows.select(*columns).collect())) for rows in (
            job.detail_rows(spark), spark.read.schema(STREAM_DETAIL).parquet(job.changes))]
    assert found[True] == found[False]
    assert not any("behind" in r for r in found[True][0]) and len(found[True][0]) > 100
    state = root / "checkpoints" / "inadimplencia_detalhes" / "state"
    assert not state.exists()
    commits = root / "checkpoints" / "inadimplencia_detalhes" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).rename(tmp_path / f"taken-{name}")
    finish(job.detail(*streams(spark, root)))
    assert sorted(map(str, job.detail_rows(spark).select(*columns).collect())) == found[True][0]
