"""Statements from a report template (L10) and multi-period compile.

A template line takes the amount of its source code (accounts mapped to
codes) and up to four one-hop subtotals: level ``i`` sums the *base*
amounts of the lines whose ``add{i}i`` equals this line's ``add{i}o``
(subtotals never feed other subtotals). Missing amounts count as 0 and the
result is multiplied by the line's direction.

The compile runs every period at once: one grouped pass over the bank and
adjustment rows of the whole date range (a filter that reaches the scans)
keyed by (date bucket, account), where buckets are the intervals between the
period ends; a balance is a running sum per account over the periods, a flow
its own bucket, and the template is applied with the period as an extra key. Output is long
(period, line) and pivoted last, with the period labels known up front.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirebook.functions.expr import date_lit, exact_sum, in_period
from hirebook.operators import ledger as L
from hirebook.params import Bounds, as_bound
from hirebook.session import keep

LEVELS = range(4)


# -- template engine -----------------------------------------------------------
def code_amounts(amounts: DataFrame, key_col: str, mapping: DataFrame, map_key: str,
                 code_col: str) -> DataFrame:
    """Sum (period, key, Amount) rows by the code their key maps to.

    Unmapped keys drop out; a code whose amounts are all NULL sums to 0.
    """
    m = mapping.where(F.col(code_col).isNotNull()).select(
        F.col(map_key).alias("_map_key"), F.col(code_col).alias("code"))
    j = amounts.join(m, F.col(key_col) == F.col("_map_key"), "left").where(F.col("code").isNotNull())
    return j.groupBy("period", "code").agg(F.coalesce(exact_sum("Amount"), F.lit(0.0)).alias("Amount"))


def apply_template(codes: DataFrame, template: DataFrame, fr: str, periods: list[str]) -> DataFrame:
    """(period, line_no, line_name, Amount) for every template line of
    statement ``fr`` and every period label.

    Each line becomes up to nine records: itself (its base amount), one
    contributor record per level with an ``add{i}i`` key and one receiver
    record per level with an ``add{i}o`` key. A window sum over (period,
    level, key) hands every receiver the sum of its contributors' base
    amounts, and one aggregate per line adds it all up; the joined lines
    are read once.
    """
    t = template.where(F.col("fr") == fr).withColumn(
        "period", F.explode(F.array(*[F.lit(p) for p in periods])))
    c = codes.select(F.col("period").alias("c_period"), F.col("code").alias("c_code"),
                     F.col("Amount").alias("base"))
    lines = t.join(c, (F.col("period") == F.col("c_period")) & (F.col("source_code") == F.col("c_code")), "left")
    base = F.coalesce(F.col("base"), F.lit(0.0))
    none = F.lit(None).cast("double")

    def rec(role, lvl, key, amt):
        return F.struct(F.lit(role).alias("role"), F.lit(lvl).alias("lvl"), key.alias("k"), amt.alias("amt"))

    records = F.array(rec("self", -1, F.col("line_no").cast("string"), base),
                      *[rec("in", i, F.col(f"add{i}i"), base) for i in LEVELS],
                      *[rec("out", i, F.col(f"add{i}o"), none) for i in LEVELS])
    x = (lines.select("period", "line_no", "line_name", "direction", F.inline(records))
         .where(F.col("k").isNotNull()))
    w = Window.partitionBy("period", "lvl", "k")
    x = x.withColumn("subtotal", exact_sum(F.when(F.col("role") == "in", F.col("amt")), over=w))
    out = x.groupBy("period", "line_no", "line_name", "direction").agg(
        exact_sum(F.when(F.col("role") == "self", F.col("amt"))).alias("base"),
        exact_sum(F.when(F.col("role") == "out", F.col("subtotal"))).alias("subtotals"))
    value = (F.coalesce(F.col("base"), F.lit(0.0)) + F.coalesce(F.col("subtotals"), F.lit(0.0))) \
        * F.col("direction")
    return out.select("period", "line_no", "line_name", value.alias("Amount"))


@dataclass(frozen=True)
class ReportFormat:
    """Template plus the account -> code mappings of the three statements.

    ``account_mapping``: (ma_account_id, .., fp, pl); ``cf_mapping``:
    (cf_account_id, cf); ``template``: fr, line_no, line_name, source_code,
    direction, add0i..add3i, add0o..add3o.
    """

    template: DataFrame
    account_mapping: DataFrame
    cf_mapping: DataFrame


def _statement(kind: str, amounts: DataFrame, fmt: ReportFormat, periods: list[str]) -> DataFrame:
    if kind == "CF":
        codes = code_amounts(amounts, "suggested_cf", fmt.cf_mapping, "cf_account_id", "cf")
    else:
        codes = code_amounts(amounts, "ma_account_id", fmt.account_mapping, "ma_account_id", kind.lower())
    return apply_template(codes, fmt.template, kind, periods)


def statement(kind: str, amounts: DataFrame, fmt: ReportFormat) -> DataFrame:
    """One statement (``FP``, ``PL`` or ``CF``) from one period's
    balances (L7), movements (L8) or cash flow (L9)."""
    s = _statement(kind, amounts.withColumn("period", F.lit("p")), fmt, ["p"])
    return s.select("line_no", "line_name", "Amount")


# -- periods -------------------------------------------------------------------
_FREQ = {"D": "D", "W": "W", "MS": "MS", "M": "ME", "ME": "ME", "Q": "QE", "QE": "QE",
         "Y": "YE", "YE": "YE", "A": "YE"}


def period_ends(last_reporting_date, periods: int, frequency: str) -> list[_dt.date]:
    """``periods + 1`` period ends from the first one on or after the date
    (the first end is the opening balance date only)."""
    if periods < 1:
        raise ValueError("need at least one period")
    f = _FREQ.get(frequency.upper())
    if f is None:
        raise ValueError(f"unsupported frequency {frequency!r}")
    rng = pd.date_range(pd.Timestamp(as_bound(last_reporting_date)).ceil("D"), periods=periods + 1, freq=f)
    return [d.date() for d in rng]


def label(d: _dt.date) -> str:
    return f"{d.year:04d}-{d.month:02d}"


def labeler(frequency: str):
    """``yyyy-MM-dd`` labels for daily and weekly periods, else ``yyyy-MM``;
    the frequency alone decides."""
    return _dt.date.isoformat if frequency.upper() in ("D", "W") else label


@dataclass(frozen=True)
class CompilePlan:
    """Date buckets between the boundaries: bucket j is (b[j-1], b[j]]."""

    boundaries: list[_dt.date]
    bf_date: _dt.date
    ends: list[_dt.date]

    @classmethod
    def build(cls, bf_date, ends: list[_dt.date], kinds=("FP", "PL", "CF")) -> "CompilePlan":
        """The boundaries that ``kinds`` need: balances start at the b/f
        date, flows at the first period end."""
        bf = as_bound(bf_date)
        points = set(ends)
        if "FP" in kinds and _moment(bf) < _moment(ends[-1]):  # else no balance has a movement
            points.add(bf)
        return cls(sorted(points, key=_moment), bf, list(ends))

    def in_range(self) -> Column:
        """The one date range that any period needs (reaches the scan)."""
        return in_period("date", self.boundaries[0], self.boundaries[-1], Bounds.HALF_OPEN)

    def bucket(self, date_col: Column) -> Column:
        """Bucket number of a date inside the range, by bisection."""
        def split(lo, hi):  # the first boundary from lo to hi that isn't before the date
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(date_col <= date_lit(self.boundaries[mid]), split(lo, mid)).otherwise(split(mid + 1, hi))

        last = len(self.boundaries) - 1
        inside = (date_col > date_lit(self.boundaries[0])) & (date_col <= date_lit(self.boundaries[-1]))
        return F.when(inside, split(1, last)) if last else F.lit(None).cast("int")

    def period_of(self, j: int, kind: str) -> int | None:
        """The period (number of its end) that a bucket first counts in:
        balances from the first end after the b/f date, flows in one period."""
        end = next(i for i, e in enumerate(self.ends) if _moment(e) >= _moment(self.boundaries[j]))
        if kind == "FP":
            return end if _moment(self.boundaries[j]) > _moment(self.bf_date) else None
        return end if end > 0 else None

    def period(self, kind: str, bucket: Column) -> Column:
        """``period_of`` as a column (NULL: in no period)."""
        numbers = [F.lit(self.period_of(j, kind)).cast("int") for j in range(1, len(self.boundaries))]
        return F.element_at(F.array(*numbers), bucket) if numbers else F.lit(None).cast("int")


def _moment(d) -> _dt.datetime:
    return d if isinstance(d, _dt.datetime) else _dt.datetime(d.year, d.month, d.day)


def bucket_aggregates(plan: CompilePlan, bank: DataFrame, aje: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One grouped pass per table over the date range: bank rows by (bucket,
    account, cash-flow line) with the signed sums, adjustments by (bucket,
    account). Both are small (buckets x accounts x lines) whatever the
    number of rows."""
    bucket = plan.bucket(F.col("date"))
    fine = (bank.where(plan.in_range()).withColumn("bucket", bucket)
            .groupBy("bucket", "ma_account_id", "suggested_cf")
            .agg(F.min("cf_account_id").alias("cf_account_id"),
                 *[exact_sum(c).alias(m) for m, c in L.signed_measures().items()]))
    a = (aje.where(plan.in_range()).withColumn("bucket", bucket).groupBy("bucket", "ma_account_id")
         .agg((F.coalesce(exact_sum("debit"), F.lit(0.0)) - F.coalesce(exact_sum("credit"), F.lit(0.0))).alias("amount")))
    return fine, a


def _account_amounts(plan: CompilePlan, kind: str, t: "LedgerTables", fine: DataFrame, adj: DataFrame) -> DataFrame:
    """L7 (FP) or L8 (PL) for every period, long form (period number).

    Every bucket row turns into its account's line and the three fixed ones;
    with the adjustments they are one sum per (period, account). A balance
    is the running sum of that over the periods, plus b/f: as many rows as
    accounts times periods, nothing grows with the square of the periods. An
    account that has both a counter-account line and a fixed one gets their sum.
    """
    def line(account, amount):
        return F.struct(account.alias("account"), amount.alias("amount"))

    fixed = [line(F.lit(acct[0]), c) for acct, c in
             ((L.BANK_ACCOUNT, F.col("gross")), (L.VAT_IN_ACCOUNT, -F.col("vat_in")), (L.VAT_OUT_ACCOUNT, -F.col("vat_out")))]
    moved = fine.select("bucket", F.inline(F.array(line(F.col("ma_account_id"), -F.col("net")), *fixed)))
    both = moved.unionAll(adj.select("bucket", F.col("ma_account_id").alias("account"), "amount"))
    sums = (both.select(plan.period(kind, F.col("bucket")).alias("n"), "account", "amount").where("n is not null and account is not null")
            .groupBy("n", "account").agg(F.coalesce(exact_sum("amount"), F.lit(0.0)).alias("amount")))
    first = 0 if kind == "FP" else 1
    grid = t.chart.select(F.col("ma_account_id").alias("account")).where("account is not null").distinct().withColumn(
        "n", F.explode(F.sequence(F.lit(first), F.lit(len(plan.ends) - 1))))
    x = grid.join(sums, ["account", "n"], "left").withColumn("amount", F.coalesce("amount", F.lit(0.0)))
    if kind == "FP":
        # one account's periods, a parameter's number of rows
        w = Window.partitionBy("account").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = x.withColumn("amount", F.sum("amount").over(w))
        opening = t.account_bf.select(F.col("ma_account_id").alias("account"), "bf_amount")
        x = x.join(opening, "account", "left").withColumn("amount", F.coalesce("bf_amount", F.lit(0.0)) + F.col("amount"))
    chart = t.chart.select("ma_account_id", "ma_account_name")
    return x.join(chart, F.col("account") == F.col("ma_account_id")).select("n", "ma_account_id", "ma_account_name", F.col("amount").alias("Amount"))


@dataclass(frozen=True)
class LedgerTables:
    chart: DataFrame
    bank: DataFrame
    aje: DataFrame
    account_bf: DataFrame


def compile_long(spark: SparkSession, kind: str, t: LedgerTables, fmt: ReportFormat, bf_date,
                 last_reporting_date, periods: int, frequency: str,
                 aggregates: tuple[CompilePlan, DataFrame, DataFrame] | None = None) -> tuple[DataFrame, list[str]]:
    """L11 in long form: (period, line_no, line_name, Amount) and the labels.

    ``aggregates``: a plan that covers ``kind`` and its ``bucket_aggregates``,
    when the caller already has them (several statements from one pass)."""
    if kind not in ("FP", "PL", "CF"):
        raise ValueError(kind)
    ends = period_ends(last_reporting_date, periods, frequency)
    if aggregates is None:
        plan = CompilePlan.build(bf_date, ends, (kind,))
        aggregates = (plan, *bucket_aggregates(plan, t.bank, t.aje))
    plan, fine, adj = aggregates
    every = [labeler(frequency)(e) for e in ends]
    labels = every if kind == "FP" else every[1:]
    if kind == "CF":
        amounts = (fine.withColumn("n", plan.period(kind, F.col("bucket"))).where("n is not null").groupBy("n", "suggested_cf")
                   .agg(F.min("cf_account_id").alias("cf_account_id"), (-exact_sum("net")).alias("Amount")))
    else:
        amounts = _account_amounts(plan, kind, t, fine, adj)
    named = F.element_at(F.array(*[F.lit(x) for x in every]), F.col("n") + 1)
    return _statement(kind, amounts.withColumn("period", named).drop("n"), fmt, labels), labels


def compile_statement(spark: SparkSession, kind: str, t: LedgerTables, fmt: ReportFormat, bf_date,
                      last_reporting_date, periods: int, frequency: str) -> DataFrame:
    """One wide statement, a column per period label (``yyyy-MM``, or
    ``yyyy-MM-dd`` for daily and weekly periods)."""
    long, labels = compile_long(spark, kind, t, fmt, bf_date, last_reporting_date, periods, frequency)
    return (long.groupBy("line_no", "line_name").pivot("period", labels)
            .agg(F.max("Amount")))


def single_period_amounts(kind: str, t: LedgerTables, bf_date, start, end) -> DataFrame:
    """The statement input of one period: L7 at ``end``, L8 or L9 for
    (start, end]."""
    if kind == "FP":
        return L.balance_at(t.chart, t.bank, t.aje, t.account_bf, bf_date, end)
    if kind == "PL":
        return L.pl_for(t.chart, t.bank, t.aje, start, end)
    return L.cash_flow(t.bank, start, end)


def _shared_aggregates(t: LedgerTables, bf_date, last_reporting_date, periods, frequency, reuse: bool):
    """The two aggregates for all three statements. Nothing runs here; with
    ``reuse`` they are kept once the first statement's action computes them
    (buckets x accounts, small), until ``session.release()``."""
    plan = CompilePlan.build(bf_date, period_ends(last_reporting_date, periods, frequency))
    fine, adj = bucket_aggregates(plan, t.bank, t.aje)
    if reuse:
        fine, adj = keep(fine), keep(adj)
    return plan, fine, adj


def compile_reports(spark: SparkSession, t: LedgerTables, fmt: ReportFormat, bf_date,
                    last_reporting_date, periods: int, frequency: str,
                    reuse: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """L11 for all three statements: ``(fp, pl, cf)`` wide DataFrames.

    The bank and adjustment tables are aggregated once by bucket; with
    ``reuse`` all three statements read those two small aggregates, so each
    source table is scanned once for the whole set.
    """
    agg = _shared_aggregates(t, bf_date, last_reporting_date, periods, frequency, reuse)
    out = []
    for kind in ("FP", "PL", "CF"):
        long, labels = compile_long(spark, kind, t, fmt, bf_date, last_reporting_date, periods, frequency,
                                    aggregates=agg)
        out.append(long.groupBy("line_no", "line_name").pivot("period", labels).agg(F.max("Amount")))
    return tuple(out)


def compile_all(spark: SparkSession, t: LedgerTables, fmt: ReportFormat, bf_date,
                last_reporting_date, periods: int, frequency: str, reuse: bool = True) -> DataFrame:
    """L11 for all three statements in one long DataFrame
    (fr, period, line_no, line_name, Amount), from one aggregate pass."""
    agg = _shared_aggregates(t, bf_date, last_reporting_date, periods, frequency, reuse)
    out = None
    for kind in ("FP", "PL", "CF"):
        long, _ = compile_long(spark, kind, t, fmt, bf_date, last_reporting_date, periods, frequency,
                               aggregates=agg)
        long = long.select(F.lit(kind).alias("fr"), "period", "line_no", "line_name", "Amount")
        out = long if out is None else out.unionAll(long)
    return out
