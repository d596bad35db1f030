from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lamina.functions import (
    band,
    decode_epoch_date,
    decode_epoch_range,
    decode_epoch_ts,
    hours_between,
    is_positive,
    is_yes,
    register_functions,
    whole_second_hours,
)
from lamina.plans.access import ACCESS
from lamina.plans.finance import FINANCE
from lamina.plans.hr import INSTABILITY
from lamina.plans.risk import RISK

EPOCHS = [
    # value, by digits, as date, by range
    (None, None, None, None),
    ("0", None, date(1970, 1, 1), datetime(1970, 1, 1)),
    ("19723", None, date(2024, 1, 1), datetime(1970, 1, 1, 5, 28, 43)),
    ("99999", None, date(2243, 10, 16), datetime(1970, 1, 2, 3, 46, 39)),
    ("123456", None, None, datetime(1970, 1, 2, 10, 17, 36)),
    ("1704067200", datetime(2024, 1, 1), date(2024, 1, 1), datetime(2024, 1, 1)),
    ("12345678901", None, None, datetime(2361, 3, 21, 19, 15, 1)),
    ("32503680000", None, None, datetime(3000, 1, 1)),
    ("32503680001", None, None, datetime(1971, 1, 12, 4, 48, 0, 1000)),
    (
        "1704067200123",
        datetime(2024, 1, 1, 0, 0, 0, 123000),
        date(2024, 1, 1),
        datetime(2024, 1, 1, 0, 0, 0, 123000),
    ),
    ("32503680000000", None, None, datetime(3000, 1, 1)),
    ("32503680000001", None, None, None),
    ("1704067200123456", datetime(2024, 1, 1, 0, 0, 0, 123456), date(2024, 1, 1), None),
    ("1704067200123456789", datetime(2024, 1, 1, 0, 0, 0, 123457), date(2024, 1, 1), None),
    ("9999999999999999999", None, None, None),
    ("-1704067200", None, None, None),
    ("2024-01-01 10:00:00", datetime(2024, 1, 1, 10), None, None),
    ("2024-01-01 10:00:00+03:00", datetime(2024, 1, 1, 7), None, None),
    ("2024-01-01", datetime(2024, 1, 1), date(2024, 1, 1), None),
    ("abc", None, None, None),
    ("12:30:00", None, None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_decoding(spark, confs, zone):
    confs(session__timeZone=zone)
    rows = [(i, value) for i, (value, *_) in enumerate(EPOCHS)]
    decoded = (
        spark.createDataFrame(rows, "i int, v string")
        .select(
            "i",
            decode_epoch_ts("v").alias("ts"),
            decode_epoch_date("v").alias("d"),
            decode_epoch_range("try_cast(v as bigint)").alias("r"),
        )
        .collect()
    )
    found = {row["i"]: (row["ts"], row["d"], row["r"]) for row in decoded}
    assert found == {i: tuple(rest) for i, (_, *rest) in enumerate(EPOCHS)}


def test_epoch_decoding_takes_integers_and_timestamps(spark):
    row = spark.sql("select 1704067200L as n, timestamp_ntz'2024-01-01 10:00:00' as t").select(
        decode_epoch_ts("n").alias("n"), decode_epoch_ts("t").alias("t")
    )
    assert row.first() == (datetime(2024, 1, 1), datetime(2024, 1, 1, 10))


def test_decoders_in_sql(spark):
    register_functions(spark)
    rows = [(i, value) for i, (value, *_) in enumerate(EPOCHS)]
    spark.createDataFrame(rows, "i int, v string").createOrReplaceTempView("epochs")
    found = spark.sql(
        "select i, decode_epoch_ts(v), decode_epoch_date(v), decode_epoch_range(try_cast(v as bigint))"
        " from epochs"
    ).collect()
    assert {row[0]: tuple(row)[1:] for row in found} == {i: tuple(r) for i, (_, *r) in enumerate(EPOCHS)}
    spark.catalog.dropTempView("epochs")


def test_flags(spark):
    rows = [(v,) for v in ("Y", "N", None, "y", "", " Y")]
    flags = spark.createDataFrame(rows, "f string").select(is_yes("f").alias("f")).collect()
    assert [row["f"] for row in flags] == [True, False, False, False, False, False]
    counts = spark.createDataFrame([(1,), (0,), (None,)], "n int")
    assert [r[0] for r in counts.select(is_positive("n")).collect()] == [True, False, False]


def test_durations(spark):
    rows = [
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 30)),
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 8, 20)),
        (datetime(2024, 1, 1), None),
        (datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 2, 100000)),
    ]
    spans = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    exact = [r[0] for r in spans.select(hours_between("a", "b")).collect()]
    whole = [r[0] for r in spans.select(whole_second_hours("a", "b")).collect()]
    assert exact == [Decimal("1.5000"), Decimal("0.1389"), None, Decimal("0.0003")]
    assert whole == [Decimal("1.5000"), Decimal("0.1389"), None, Decimal("0.0003")]


@pytest.mark.parametrize(
    ("scoring", "high", "medium"),
    [(INSTABILITY, 12, 5), (RISK, 15, 7), (ACCESS, 12, 5), (FINANCE, 10, 4)],
)
def test_band_edges(spark, scoring, high, medium):
    step = Decimal("0.0001")
    values = [(Decimal(high),), (high - step,), (Decimal(medium),), (medium - step,), (Decimal(0),)]
    levels = spark.createDataFrame(values, "v decimal(18,4)").select(
        band(F.col("v"), scoring.floors, scoring.otherwise).alias("level")
    )
    assert [r["level"] for r in levels.collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_level_follows_the_unrounded_score(spark):
    # 9.99996 is stored as 10.0000 but has not reached 10.
    metrics = spark.sql(
        "select 0L as suspicious_card_txn_cnt, 0L as overdue_advance_report_cnt,"
        " 0L as manual_payroll_adj_cnt, 0L as urgent_vendor_payment_cnt,"
        " 499998.00BD as rejected_advance_amount_rub, 0.00BD as suspicious_card_amount_rub"
    )
    row = FINANCE.apply(metrics).first()
    assert row["finance_risk_score"] == Decimal("9.99996")
    assert row["finance_risk_level_code"] == "MEDIUM"


def test_score_is_exact_decimal(spark):
    # 4.8 + 84267.50 / 50000 is 6.48535, which binary fractions would round down.
    metrics = spark.sql(
        "select 0L as suspicious_card_txn_cnt, 1L as overdue_advance_report_cnt,"
        " 0L as manual_payroll_adj_cnt, 2L as urgent_vendor_payment_cnt,"
        " 84267.50BD as rejected_advance_amount_rub, 0.00BD as suspicious_card_amount_rub"
    )
    stored = FINANCE.apply(metrics).select(F.col("finance_risk_score").cast("decimal(18,4)"))
    assert stored.first()[0] == Decimal("6.4854")
