"""Straight-line depreciation by user and its journal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.functions.expr import clamp, exact_sum, ratio

# Fixed values of the depreciation journal.
JE_NO = "DEP01"
JE_TYPE = "DEP"
ACCUMULATED_DEPRECIATION = "MA1062"
ACCUMULATED_DEPRECIATION_TOP = "1602"
JOURNAL_COLS = ["entity", "date", "JE_No", "ma_account_id", "ma_account_name", "ep_name", "amount",
                "Debit", "Credit", "ep_id", "je_type", "top", "pure_account_id"]


def ppe_list(ppe: DataFrame) -> DataFrame:
    """Assets with the start year and month parsed from ``starting``
    (``YYYY-MM..``). As in the reports a part counts as far as it begins
    with digits and as 0 if it doesn't, so an asset with an unreadable start
    is fully depreciated; only a NULL start stays NULL."""
    def part(at, n):
        digits = F.regexp_extract(F.substring("starting", at, n), r"^\s*(\d+)", 1)
        return F.when(F.col("starting").isNotNull(), F.coalesce(digits.try_cast("int"), F.lit(0)))

    return ppe.select("*", part(1, 4).alias("SYEAR"), part(6, 2).alias("SMONTH"))


def _months_used(year: int, month: int) -> F.Column:
    """Months depreciated by the end of (year, month), capped at the life;
    depreciation starts the month after ``starting``."""
    elapsed = (F.lit(int(year)) - F.col("SYEAR")) * 12 + F.lit(int(month)) - F.col("SMONTH")
    return clamp(elapsed, F.col("life"))


def depr_by_user(ppe: DataFrame, year: int, month: int, truncate: bool = False) -> DataFrame:
    """The month's depreciation per (company, user), each asset's
    charge rounded to cents before the sum. ``month - 1`` of January is
    month 0 of the same year, i.e. December before."""
    p = ppe_list(ppe).withColumn("_base", F.col("historical_cost") - F.col("residual_value"))
    per_month = ratio(p, "_base", "life", truncate)
    charge = F.round(per_month * (_months_used(year, month) - _months_used(year, int(month) - 1)), 2)
    return (p.groupBy("company", F.col("ppe_user").alias("ppe_user"))
            .agg(F.round(exact_sum(charge), 2).alias("CurrentDep")))


def depr_journal(ppe: DataFrame, depr_alloc: DataFrame, year: int, month: int,
                 distinct: bool = True) -> DataFrame:
    """D3: debit the expense account of each user's allocation (the full
    amount per allocation row), credit accumulated depreciation per company.

    The credit line carries ``amount = -sum`` (the reports took one user's
    amount there). ``distinct=False`` keeps equal lines (UNION ALL).
    """
    d = depr_by_user(ppe, year, month)
    alloc = depr_alloc.select(F.col("ppe_user").alias("a_user"), "ma_account_id")
    date = F.lit(f"{int(year):04d}-{int(month):02d}-01")
    empty = F.lit("")
    debit = d.join(alloc, F.col("ppe_user") == F.col("a_user"), "left").select(
        F.col("company").alias("entity"), date.alias("date"), F.lit(JE_NO).alias("JE_No"), "ma_account_id",
        empty.alias("ma_account_name"), empty.alias("ep_name"), F.col("CurrentDep").alias("amount"),
        F.col("CurrentDep").alias("Debit"), F.lit(0.0).alias("Credit"), empty.alias("ep_id"),
        F.lit(JE_TYPE).alias("je_type"), F.substring("ma_account_id", 3, 4).alias("top"),
        F.substring("ma_account_id", 3, 20).alias("pure_account_id"))
    credit = d.groupBy(F.col("company").alias("entity")).agg(exact_sum("CurrentDep").alias("Credit")).select(
        "entity", date.alias("date"), F.lit(JE_NO).alias("JE_No"),
        F.lit(ACCUMULATED_DEPRECIATION).alias("ma_account_id"), empty.alias("ma_account_name"),
        empty.alias("ep_name"), (-F.col("Credit")).alias("amount"), F.lit(0.0).alias("Debit"), "Credit",
        empty.alias("ep_id"), F.lit(JE_TYPE).alias("je_type"),
        F.lit(ACCUMULATED_DEPRECIATION_TOP).alias("top"), F.lit(ACCUMULATED_DEPRECIATION_TOP).alias("pure_account_id"))
    u = debit.select(JOURNAL_COLS).unionAll(credit.select(JOURNAL_COLS))
    return u.distinct() if distinct else u
