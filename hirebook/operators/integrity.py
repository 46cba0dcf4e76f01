"""Data-integrity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.functions.expr import exact_sum

STOCK_KEYS = ("q_id", "site_name", "equip_type_name")


def relocation_stock(relocation: DataFrame) -> DataFrame:
    """Running stock of each (contract, site, type) at each movement's date or instant.

    Movements of one instant net off before the running sum. It is a prefix
    sum in two levels: the stock before a day comes from a window over the
    group's daily totals, the movements of a day are summed in a window of
    their own, so a group with a third of all movements, at distinct seconds,
    is many windows, the largest bounded by a day (or by the group's number
    of days). Plain dates need the first level only. Rows with a NULL key or
    date are not part of any group.
    """
    keys = list(STOCK_KEYS)
    valid = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*keys, "date")])
    moved = F.sum(F.col("quantity") * F.col("direction")).alias("net")
    by_day = Window.partitionBy(*keys).orderBy("day")
    if isinstance(relocation.schema["date"].dataType, T.DateType):
        daily = relocation.where(valid).groupBy(*keys, F.col("date").alias("day")).agg(moved)
        return daily.select(*keys, F.col("day").alias("date"), F.sum("net").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("stock"))
    instants = relocation.where(valid).groupBy(*keys, F.to_date("date").alias("day"), "date").agg(moved)
    days = instants.groupBy(*keys, "day").agg(F.sum("net").alias("net"))
    before = F.coalesce(F.sum("net").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opening = days.select(*[F.col(k).alias(f"of_{k}") for k in (*keys, "day")], before.alias("before"))
    within = Window.partitionBy(*keys, "day").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    running = instants.select(*keys, "day", "date", F.sum("net").over(within).alias("since"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"of_{k}") for k in (*keys, "day")])
    return running.join(opening, same).select(*keys, "date", (F.col("before") + F.col("since")).alias("stock"))


def relocation_negative(relocation: DataFrame) -> DataFrame:
    """I1 detail: every (group, date) at which the running stock is negative,
    i.e. equipment left a site before it arrived."""
    return relocation_stock(relocation).where(F.col("stock") < 0)


def relocation_negative_first(relocation: DataFrame) -> DataFrame:
    """The first date with a negative stock anywhere (NULL if none)."""
    return relocation_negative(relocation).agg(F.min("date").alias("first_negative_date"))


def bf_reconciliation(ep_bf: DataFrame, account_bf: DataFrame) -> DataFrame:
    """Per control account, general-ledger b/f minus the sum of the
    parties' b/f. The id is the ledger side's (NULL when it has none)."""
    parties = ep_bf.groupBy(F.col("ma_account_id").alias("control_id")).agg(exact_sum("amount").alias("of_parties"))
    ledger = account_bf.select("bf_amount", "ma_account_id")
    return (parties.join(ledger, F.col("control_id") == F.col("ma_account_id"), "left")
            .select("ma_account_id", (F.col("bf_amount") - F.col("of_parties")).alias("BFDIFF")))


def _missing_party(chart: DataFrame, rows: DataFrame) -> DataFrame:
    ctrl = chart.where(F.col("ap_ar") == 1).select(F.col("ma_account_id").alias("MID"))
    r = rows.where(F.col("ep_id").isNull()).select(F.col("ma_account_id").alias("MID2"), "ep_id", "amount")
    return ctrl.join(r, F.col("MID") == F.col("MID2"), "inner").select("MID", "MID2", "ep_id", "amount")


def bank_missing_party(chart: DataFrame, bank: DataFrame) -> DataFrame:
    """Bank rows on a receivable/payable account without a party."""
    return _missing_party(chart, bank)


def aje_missing_party(chart: DataFrame, aje: DataFrame) -> DataFrame:
    """I4: adjustments on a receivable/payable account without a party."""
    return _missing_party(chart, aje)


def bank_missing_vat(bank: DataFrame) -> DataFrame:
    """Bank rows without VAT (they drop out of the ledger sums)."""
    return bank.where(F.col("vat").isNull())


def integrity_summary(relocation: DataFrame, ep_bf: DataFrame, account_bf: DataFrame,
                      chart: DataFrame, bank: DataFrame, aje: DataFrame) -> DataFrame:
    """Number of violations per check (0 = passed)."""
    diff = F.round(F.col("BFDIFF"), 2)
    parts = [
        ("relocation_negative", relocation_negative(relocation)),
        ("bf_reconciliation", bf_reconciliation(ep_bf, account_bf)
         .where(diff.isNull() | (diff != 0))),
        ("aje_missing_party", aje_missing_party(chart, aje)),
    ]
    out = _bank_violations(chart, bank)
    for name, df in parts:
        out = out.unionAll(df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations"))
    return out


def _bank_violations(chart: DataFrame, bank: DataFrame) -> DataFrame:
    """How many rows I3 and I5 have, from one scan: both are counted per
    account, and an account counts for I3 as often as it is a control account."""
    per = bank.groupBy("ma_account_id").agg(F.count(F.when(F.col("ep_id").isNull(), 1)).alias("no_party"),
                                            F.count(F.when(F.col("vat").isNull(), 1)).alias("no_vat"))
    ctrl = chart.where(F.col("ap_ar") == 1).groupBy(F.col("ma_account_id").alias("control_id")).agg(F.count(F.lit(1)).alias("times"))
    n = per.join(ctrl, F.col("ma_account_id") == F.col("control_id"), "left").agg(
        F.sum(F.col("no_party") * F.coalesce("times", F.lit(0))).alias("no_party"), F.sum("no_vat").alias("no_vat"))
    return n.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check"), F.coalesce(c, F.lit(0).cast("bigint")).alias("violations"))
                                       for name, c in (("bank_missing_party", "no_party"), ("bank_missing_vat", "no_vat"))])))
