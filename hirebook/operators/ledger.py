"""Ledger movements, balance sheet, profit and loss, cash flow.

Bank rows record the bank side of each movement, so the counter-account
(``ma_account_id``) moves by ``-(amount - vat)``, VAT paid/collected goes to
two fixed VAT accounts and the whole amount to the bank account.

The reports scanned ``bankstatement`` four times per statement (per
account, VAT in, VAT out, bank). Here one grouped pass computes the four
conditional sums per account, and their totals come from those. Partial
aggregation runs before the shuffle, so a dominant account only ever
contributes one row per task. Amounts are summed exactly (``exact_sum``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirebook.functions.expr import exact_sum, in_period, sgn
from hirebook.params import Bounds

# The reports' own accounts for the bank and the two VAT sides.
BANK_ACCOUNT = ("MA1002", "Bank")
VAT_IN_ACCOUNT = ("MA22210101", "VAT_in")
VAT_OUT_ACCOUNT = ("MA22210102", "VAT_out")


MEASURES = ("net", "vat_in", "vat_out", "gross")


def bank_account_sums(bank: DataFrame, lo, hi) -> DataFrame:
    """One pass over bank rows in (lo, hi]: per account the four signed sums.

    The account name is not a key (one name per account; the smallest if
    not). Taking ``min`` of a string forces a sort-based aggregate, so the
    rows are first hash-aggregated by (account, name) and the name is picked
    from that small result.
    """
    rows = _signed_rows(bank, lo, hi)
    per_name = rows.groupBy("ma_account_id", "ma_account_name").agg(*[exact_sum(m).alias(m) for m in MEASURES])
    return per_name.groupBy("ma_account_id").agg(
        F.min("ma_account_name").alias("ma_account_name"), *[exact_sum(m).alias(m) for m in MEASURES])


def bank_by_account(bank: DataFrame, lo, hi) -> DataFrame:
    """L1: movement of each counter-account, ``-sum(sgn * (amount - vat))``.
    A row with NULL VAT drops out of its account's sum."""
    return bank_account_sums(bank, lo, hi).select(
        "ma_account_id", "ma_account_name", (-F.col("net")).alias("Amount"))


def _fixed_structs(vat_in: Column, vat_out: Column, gross: Column) -> list[Column]:
    def line(acct, amount):
        return F.struct(F.lit(acct[0]).alias("ma_account_id"), F.lit(acct[1]).alias("ma_account_name"),
                        amount.alias("Amount"))
    return [line(BANK_ACCOUNT, gross), line(VAT_IN_ACCOUNT, -vat_in), line(VAT_OUT_ACCOUNT, -vat_out)]


def _signed_rows(bank: DataFrame, lo, hi) -> DataFrame:
    return bank.where(in_period("date", lo, hi, Bounds.HALF_OPEN)).select(
        "ma_account_id", "ma_account_name", *[c.alias(m) for m, c in signed_measures().items()])


def signed_measures() -> dict[str, Column]:
    """The four amounts of a bank row, negative for cancelling ones."""
    s, vat = sgn(), F.col("vat")
    return {"net": s * (F.col("amount") - vat),
            "vat_in": s * F.when(vat < 0, 1).otherwise(0) * vat,
            "vat_out": s * F.when(vat > 0, 1).otherwise(0) * vat,
            "gross": s * F.col("amount")}


def _fixed_lines() -> list[Column]:
    return _fixed_structs(F.col("vat_in"), F.col("vat_out"), F.col("gross"))


def _totals(bank: DataFrame, lo, hi) -> DataFrame:
    """One row: the sums over all bank rows in (lo, hi] (NULL over none)."""
    return _signed_rows(bank, lo, hi).agg(*[exact_sum(m).alias(m) for m in MEASURES])


def bank_vat(bank: DataFrame, lo, hi) -> DataFrame:
    """L2 + L3: VAT in (negative VAT) and VAT out (positive VAT) lines."""
    return _totals(bank, lo, hi).select(F.inline(F.array(*_fixed_lines()[1:])))


def bank_total(bank: DataFrame, lo, hi) -> DataFrame:
    """L4: the bank account line, ``sum(sgn * amount)``."""
    return _totals(bank, lo, hi).select(F.inline(F.array(_fixed_lines()[0])))


def bank_movements(bank: DataFrame, lo, hi, distinct: bool = True) -> DataFrame:
    """Bank, VAT and counter-account lines (set union, as the reports).

    One scan: the bank rows become four sums per (account, name), each of
    those small rows gives its own line and its share of the three fixed
    ones, and the lines are summed once more. The fixed lines are there (NULL)
    in a period without rows.
    """
    sums = _signed_rows(bank, lo, hi).groupBy("ma_account_id", "ma_account_name").agg(*[exact_sum(m).alias(m) for m in MEASURES])
    return movement_lines(sums, distinct)


def movement_lines(sums: DataFrame, distinct: bool = True) -> DataFrame:
    """L5 from the four sums per (account, name)."""
    own = F.struct(F.col("ma_account_id"), F.col("ma_account_name"), (-F.col("net")).alias("Amount"))
    shares = F.array(*[F.struct(F.lit(fixed).alias("fixed"), line.alias("line"))
                       for fixed, line in ((False, own), *[(True, line) for line in _fixed_lines()])])
    none = F.lit(None).cast("double")
    nothing = sums.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*[
        F.struct(F.lit(True).alias("fixed"), line.alias("line")) for line in _fixed_structs(none, none, none)])))
    lines = sums.select(F.inline(shares)).unionByName(nothing).select("fixed", "line.*")
    # the smallest name: hash-aggregated by name above, picked from few rows here
    u = lines.groupBy("fixed", "ma_account_id").agg(F.min("ma_account_name").alias("ma_account_name"), exact_sum("Amount").alias("Amount")).drop("fixed")
    return u.distinct() if distinct else u


def adj_by_account(aje: DataFrame, lo, hi) -> DataFrame:
    """Adjustments per account, debits minus credits (NULL sums as 0).
    Hash-aggregated by (account, name) first, as ``bank_account_sums``."""
    per_name = (aje.where(in_period("date", lo, hi, Bounds.HALF_OPEN))
                .groupBy("ma_account_id", "ma_account_name")
                .agg(exact_sum("debit").alias("debit"), exact_sum("credit").alias("credit")))
    return adjustment_lines(per_name)


def adjustment_lines(sums: DataFrame) -> DataFrame:
    """L6 from the debits and credits per (account, name)."""
    return sums.groupBy("ma_account_id").agg(
        F.min("ma_account_name").alias("ma_account_name"),
        (F.coalesce(exact_sum("debit"), F.lit(0.0)) - F.coalesce(exact_sum("credit"), F.lit(0.0))).alias("amount"))


def on_chart(chart: DataFrame, movements: DataFrame, adjustments: DataFrame,
             account_bf: DataFrame | None) -> DataFrame:
    """Every chart account with what moved it (and its b/f, if given).
    Movements on accounts outside the chart are not reported."""
    mov = movements.select(F.col("ma_account_id").alias("moved_id"), F.col("Amount").alias("moved"))
    adj = adjustments.select(F.col("ma_account_id").alias("adjusted_id"), F.col("amount").alias("adjusted"))
    c = chart.select("ma_account_id", "ma_account_name")
    j = (c.join(mov, F.col("ma_account_id") == F.col("moved_id"), "left")
         .join(adj, F.col("ma_account_id") == F.col("adjusted_id"), "left"))
    z = F.lit(0.0)
    total = F.coalesce("moved", z) + F.coalesce("adjusted", z)
    if account_bf is not None:
        bf = account_bf.select(F.col("ma_account_id").alias("opening_id"), "bf_amount")
        j = j.join(bf, F.col("ma_account_id") == F.col("opening_id"), "left")
        total = F.coalesce("bf_amount", z) + F.coalesce("moved", z) + F.coalesce("adjusted", z)
    return j.select("ma_account_id", "ma_account_name", total.alias("Amount"))


def balance_at(chart: DataFrame, bank: DataFrame, aje: DataFrame, account_bf: DataFrame,
               bf_date, cut) -> DataFrame:
    """Balance of every chart account at ``cut``: b/f + bank movements +
    adjustments in (bf_date, cut]. Movements on accounts outside the chart
    are not reported."""
    return on_chart(chart, bank_movements(bank, bf_date, cut), adj_by_account(aje, bf_date, cut), account_bf)


def pl_for(chart: DataFrame, bank: DataFrame, aje: DataFrame, start, end) -> DataFrame:
    """Movement of every chart account in (start, end], without b/f."""
    return on_chart(chart, bank_movements(bank, start, end), adj_by_account(aje, start, end), None)


def cash_flow(bank: DataFrame, start, end) -> DataFrame:
    """Cash movement per suggested cash-flow line in (start, end]."""
    return (bank.where(in_period("date", start, end, Bounds.HALF_OPEN))
            .groupBy("suggested_cf")
            .agg(F.min("cf_account_id").alias("cf_account_id"),
                 (-exact_sum(sgn() * (F.col("amount") - F.col("vat")))).alias("Amount")))
