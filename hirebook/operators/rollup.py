"""Balances from a stored account-by-month rollup.

A balance is a sum over everything since the b/f date, and every report of a
later date reads it all again. The rollup holds one row per month, source
(bank or adjustments), account and name, with the exact partial sums of the
report's amounts (``partial_sum``: what is added later has the bits of one
sum over all rows). A period is then its whole months from the rollup and the
rows of at most two part months from the dated tables, whose filter reaches
the scan.

The rollup is a schedule of one table: each refresh is a new snapshot with one
commit, so readers see the old one or the new one, whole. A refresh reads the
dated tables for the named months only and takes the other months over from
the snapshot before; it gives the same result however often it is run.

Rows without a date belong to no period and to no month. An account or name of
NULL is a key like any other. Months without rows have no row. The period of a
bound with a time of day is split at that time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.functions.expr import date_lit, in_period, merged_sum, partial_sum
from hirebook.operators import ledger as L
from hirebook.params import as_bound
from hirebook.sources.loaders import current_snapshot, write_schedule

TABLE = "ledger_month"
KEYS = ("source", "ma_account_id", "ma_account_name")
SIDES = ("debit", "credit")
SUMS = (*L.MEASURES, *SIDES)
SCHEMA = "month date, " + ", ".join([f"{k} string" for k in KEYS] + [f"{s} struct<units:bigint,parts:bigint,others:double>" for s in SUMS])


def _amounts(bank: DataFrame, aje: DataFrame, where: Column, *keep: Column) -> DataFrame:
    """Rows of both sources that ``where`` selects, each with its own amounts."""
    none = F.lit(None).cast("double")
    account = [F.col("ma_account_id"), F.col("ma_account_name")]
    moved = bank.where(where).select(F.lit("bank").alias("source"), *account, *keep, *[c.cast("double").alias(m) for m, c in L.signed_measures().items()],
                                     *[none.alias(s) for s in SIDES])
    adjusted = aje.where(where).select(F.lit("aje").alias("source"), *account, *keep, *[none.alias(m) for m in L.MEASURES],
                                       *[F.col(s).cast("double").alias(s) for s in SIDES])
    return moved.unionAll(adjusted)


def _month() -> Column:
    return F.trunc("date", "month").alias("month")


def month_sums(bank: DataFrame, aje: DataFrame, months: list | None = None) -> DataFrame:
    """(month, source, account, name, partial sums) of all months, or of the
    named ones (any day of each), whose ranges reach both scans."""
    where = F.col("date").isNotNull()
    if months is not None:
        where = F.lit(False)
        for m in sorted({_first(m) for m in months}):
            where = where | ((F.col("date") >= F.lit(m)) & (F.col("date") < F.lit(_next(m))))
    return _amounts(bank, aje, where, _month()).groupBy("month", *KEYS).agg(*[partial_sum(s).alias(s) for s in SUMS])


def _first(day) -> _dt.date:
    day = as_bound(day)
    return _dt.date(day.year, day.month, 1)


def _next(month: _dt.date) -> _dt.date:
    return _dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)


def months_of(rows: DataFrame, most: int = 12_000) -> list[_dt.date]:
    """The months that new or late rows (of either table) fall in; a thousand
    years of them at most, else ValueError."""
    got = [r[0] for r in rows.where(F.col("date").isNotNull()).select(_month()).distinct().limit(most + 1).collect()]
    if len(got) > most:
        raise ValueError(f"over {most} months")
    return sorted(got)


def refresh_rollup(path: str, bank: DataFrame, aje: DataFrame, months: list | None = None) -> str:
    """Bring the rollup at ``path`` up to date in one commit; the snapshot's name.

    ``months``: those whose rows have changed (``months_of`` the new rows);
    they are summed anew from ``bank`` and ``aje``, the others stay. None (and
    the first call) sums everything.
    """
    spark = bank.sparkSession
    root, tables = current_snapshot(spark, path)
    if not tables:
        months = None
    new = month_sums(bank, aje, months)
    if months is not None:
        again = sorted({_first(m) for m in months})
        old = spark.read.schema(SCHEMA).parquet(f"{root}/{TABLE}")
        new = (old.where(~F.col("month").isin(again)) if again else old).unionByName(new)
    # few rows (accounts x months): by month, so that a period skips the others' row groups
    return write_schedule({TABLE: new.repartitionByRange("month").sortWithinPartitions("month", *KEYS)}, path, "parquet")


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The rollup's last committed snapshot."""
    root, tables = current_snapshot(spark, path)
    if tables != [TABLE]:
        raise ValueError(f"no rollup at {path}")
    return spark.read.schema(SCHEMA).parquet(f"{root}/{TABLE}")


def whole_months(lo, hi, timestamps: bool) -> tuple[_dt.date, _dt.date] | None:
    """The months wholly inside (lo, hi] as [first, after); None without any.

    Between dates the last day of a month may be the bound itself; a
    timestamp column has rows later on that day, which aren't in the period.
    """
    lo, hi = as_bound(lo), as_bound(hi)
    first = _first(lo)
    if _at(first) <= _at(lo):
        first = _next(first)
    reach = _at(hi) + (_dt.timedelta(microseconds=1) if timestamps else _dt.timedelta(days=1))
    after = _first(reach)
    return (first, after) if first < after else None


def _at(day) -> _dt.datetime:
    return day if isinstance(day, _dt.datetime) else _dt.datetime(day.year, day.month, day.day)


def _period_sums(rollup: DataFrame, bank: DataFrame, aje: DataFrame, lo, hi) -> DataFrame:
    """The exact sums per (source, account, name) of (lo, hi]."""
    kinds = {df.schema["date"].dataType for df in (bank, aje)}
    if len(kinds) > 1:
        raise ValueError("both tables date their rows alike")
    whole = whole_months(lo, hi, not isinstance(kinds.pop(), T.DateType))
    inside, d = in_period("date", lo, hi), F.col("date")
    if whole is None:
        stored, edges = rollup.where(F.lit(False)), inside
    else:
        first, after = map(F.lit, whole)
        stored = rollup.where((F.col("month") >= first) & (F.col("month") < after))
        edges = ((d > date_lit(lo)) & (d < first)) | ((d >= after) & (d <= date_lit(hi)))
    rest = _amounts(bank, aje, edges).groupBy(*KEYS).agg(*[partial_sum(s).alias(s) for s in SUMS])
    return stored.select(*KEYS, *SUMS).unionAll(rest.select(*KEYS, *SUMS)).groupBy(*KEYS).agg(*[merged_sum(s).alias(s) for s in SUMS])


def _lines(rollup: DataFrame, bank: DataFrame, aje: DataFrame, lo, hi) -> tuple[DataFrame, DataFrame]:
    sums = _period_sums(rollup, bank, aje, lo, hi)
    of = {s: sums.where(F.col("source") == s) for s in ("bank", "aje")}
    return L.movement_lines(of["bank"].drop("source", *SIDES)), L.adjustment_lines(of["aje"].drop("source", *L.MEASURES))


def balance_at(rollup: DataFrame, chart: DataFrame, bank: DataFrame, aje: DataFrame, account_bf: DataFrame, bf_date, cut) -> DataFrame:
    """L7 as ``ledger.balance_at``, from whole months and the rows of part months."""
    return L.on_chart(chart, *_lines(rollup, bank, aje, bf_date, cut), account_bf)


def pl_for(rollup: DataFrame, chart: DataFrame, bank: DataFrame, aje: DataFrame, start, end) -> DataFrame:
    """L8 as ``ledger.pl_for``, from whole months and the rows of part months."""
    return L.on_chart(chart, *_lines(rollup, bank, aje, start, end), None)
