"""The month rollup: equal to the full scan, refreshed by month, read by part."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hirebook.operators import ledger as L
from hirebook.operators import rollup as RU
from hirebook.sources.schemas import SCHEMAS
from test_scale import plan_text

CHART = [(f"A{i}", f"account {i}") for i in range(5)] + [L.BANK_ACCOUNT, L.VAT_IN_ACCOUNT, L.VAT_OUT_ACCOUNT]


def _bank_rows(n, times, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a = 0 if i % 3 == 0 else rnd.randrange(6)  # one account holds a third; A5 isn't on the chart
        at = dt.datetime(2021, 1, 1) + dt.timedelta(days=rnd.randrange(500), seconds=rnd.randrange(86400) if times else 0)
        out.append((None if i % 97 == 0 else at, None if i % 89 == 0 else f"A{a}", rnd.choice([f"account {a}", None]), None, None,
                    None if i % 83 == 0 else rnd.randrange(10**9) / 97, rnd.choice([None, 0.0, -1.13, 7.7]), rnd.choice([None, None, 1]), 1, 1))
    return out


def _tables(spark, times):
    date = "timestamp" if times else "date"
    rows = _bank_rows(1500, times)
    bank = spark.createDataFrame([(r[0] if times or r[0] is None else r[0].date(), *r[1:]) for r in rows], SCHEMAS["bankstatement"].replace("date timestamp", f"date {date}"))
    aje = bank.select("date", "ma_account_id", "ma_account_name", "ep_id", F.when(F.col("amount") > 3e6, F.col("amount")).alias("debit"),
                      (F.col("amount") / 7).alias("credit"), "amount")
    chart = spark.createDataFrame([(*c, 0) for c in CHART], "ma_account_id string, ma_account_name string, ap_ar int")
    bf = spark.createDataFrame([("A0", 12.5), ("A1", None)], "ma_account_id string, bf_amount double")
    return chart, bank.cache(), aje.cache(), bf


def _same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("times", [False, True])
def test_equal_to_the_full_scan_to_the_bit(spark, tmp_path, times):
    chart, bank, aje, bf = _tables(spark, times)
    RU.refresh_rollup(str(tmp_path), bank, aje)
    roll = RU.read_rollup(spark, str(tmp_path))
    periods = [("2020-12-31", "2021-12-31"), ("2021-02-10", "2021-02-20"), ("2021-02-10 10:30:00", "2021-08-31 23:59:59.999999")] if times else \
        [("2021-01-01", "2022-02-15"), ("2021-03-31", "2021-04-30"), ("2021-06-30", "2021-06-30")]
    for lo, hi in periods:
        _same(RU.balance_at(roll, chart, bank, aje, bf, lo, hi), L.balance_at(chart, bank, aje, bf, lo, hi))
    _same(RU.pl_for(roll, chart, bank, aje, *periods[0]), L.pl_for(chart, bank, aje, *periods[0]))


def test_whole_months_of_a_period():
    d = dt.date
    assert RU.whole_months("2020-12-31", "2021-12-31", False) == (d(2021, 1, 1), d(2022, 1, 1))
    assert RU.whole_months("2020-12-31", "2021-12-31", True) == (d(2021, 1, 1), d(2021, 12, 1))  # rows later on the last day stay out
    assert RU.whole_months("2021-01-01", "2021-03-15", False) == (d(2021, 2, 1), d(2021, 3, 1))  # the first day is out
    assert RU.whole_months("2021-01-05", "2021-02-27", False) is None
    assert RU.whole_months("2020-12-31 23:59:59", "2021-01-31 23:59:59.999999", True) == (d(2021, 1, 1), d(2021, 2, 1))


def test_only_part_months_are_read(spark, tmp_path):
    chart, bank, aje, bf = _tables(spark, True)
    RU.refresh_rollup(str(tmp_path), bank, aje)
    roll, lo, hi = RU.read_rollup(spark, str(tmp_path)), "2021-02-10", "2022-01-20"
    edges = ((F.col("date") < "2021-03-01") | (F.col("date") >= "2022-01-01"))
    _same(RU.balance_at(roll, chart, bank.where(edges), aje.where(edges), bf, lo, hi), L.balance_at(chart, bank, aje, bf, lo, hi))
    stored = {n: str(tmp_path / n) for n in ("bank", "aje")}
    for n, df in (("bank", bank), ("aje", aje)):
        df.write.parquet(stored[n])
    text = plan_text(RU.balance_at(roll, chart, *[spark.read.parquet(stored[n]) for n in ("bank", "aje")], bf, lo, hi))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert sum("FileScan parquet [month#" in s for s in scans) == 2 and len(scans) == 4  # the two tables once each
    assert all("LessThan(date,2021-03-01" in s for s in scans if "[month#" not in s)
    assert all("GreaterThanOrEqual(month,2021-03-01)" in s for s in scans if "[month#" in s)


def test_late_rows_change_their_months_only(spark, tmp_path):
    chart, bank, aje, bf = _tables(spark, True)
    RU.refresh_rollup(str(tmp_path), bank, aje)
    first = RU.read_rollup(spark, str(tmp_path))
    late = spark.createDataFrame([(dt.datetime(2021, 5, 31, 23, 0), "A2", "account 2", None, None, 500.25, 0.0, None, 1, 1),
                                  (dt.datetime(2023, 1, 1), "A3", None, None, None, 1.0, 0.0, None, 1, 1)], SCHEMAS["bankstatement"])
    assert RU.months_of(late) == [dt.date(2021, 5, 1), dt.date(2023, 1, 1)]
    more = bank.unionAll(late)
    only = F.trunc("date", "month").isin(RU.months_of(late))
    for _ in range(2):  # as often as one likes; the other months' rows aren't needed
        RU.refresh_rollup(str(tmp_path), more.where(only), aje.where(only), RU.months_of(late))
    roll = RU.read_rollup(spark, str(tmp_path))
    _same(RU.balance_at(roll, chart, more, aje, bf, "2020-12-31", "2023-06-15"), L.balance_at(chart, more, aje, bf, "2020-12-31", "2023-06-15"))
    _same(roll.where(~F.col("month").isin(RU.months_of(late))), first.where(~F.col("month").isin(RU.months_of(late))))
    RU.refresh_rollup(str(tmp_path), more, aje, [])  # nothing new
    _same(RU.read_rollup(spark, str(tmp_path)), roll)


def test_a_month_whose_rows_went_has_no_row(spark, tmp_path):
    _, bank, aje, _ = _tables(spark, True)
    RU.refresh_rollup(str(tmp_path), bank, aje)
    gone = F.trunc("date", "month") == F.lit(dt.date(2021, 7, 1))
    RU.refresh_rollup(str(tmp_path), bank.where(~gone), aje.where(~gone), ["2021-07-09"])
    assert RU.read_rollup(spark, str(tmp_path)).where("month = '2021-07-01'").count() == 0


def test_empty_tables_and_no_rollup(spark, tmp_path):
    chart, bank, aje, bf = _tables(spark, True)
    with pytest.raises(ValueError, match="no rollup"):
        RU.read_rollup(spark, str(tmp_path))
    none = bank.limit(0), aje.limit(0)
    RU.refresh_rollup(str(tmp_path), *none)
    roll = RU.read_rollup(spark, str(tmp_path))
    assert roll.count() == 0
    _same(RU.balance_at(roll, chart, *none, bf, "2020-12-31", "2021-12-31"), L.balance_at(chart, *none, bf, "2020-12-31", "2021-12-31"))
