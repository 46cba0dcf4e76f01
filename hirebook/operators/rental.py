"""Machine days, accrued rent, invoiced revenue and standard cost.

Every function takes the business tables it reads and the period, and returns
a lazy DataFrame; values are exact (no rounding) so composed reports round
once, at their output. Aggregations run map-side first (partial ``sum``),
so a contract holding a large share of the relocations costs one
pre-aggregated row per task and type, not a hot shuffle partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.functions.expr import clamp0, date_lit, days_since, exact_sum, in_period, ratio, total
from hirebook.params import Bounds
from hirebook.session import keep

BF_COL = "accumulated_machine_days_per_starting"
CF_COL = "accumulated_machine_days_per_ending"
PERIOD_DAYS = "Machine_days_for_the_period"
REVENUE = "Revenue_for_the_period"
STD_COST = "Standard_machine_cost_for_the_period"


def machine_days(relocation: DataFrame, start, end, signed: bool = False) -> DataFrame:
    """Per relocation row, machine days accumulated up to ``start`` and
    to ``end``: ``max(day - date, 0) * quantity``.

    The reports ignore ``direction`` here; ``signed=True`` multiplies by it.
    Timestamps count fractions of a day, dates whole ones.
    """
    qty = F.col("quantity") * F.col("direction") if signed else F.col("quantity")
    return relocation.select(
        "*",
        (clamp0(days_since(relocation, "date", start)) * qty).alias(BF_COL),
        (clamp0(days_since(relocation, "date", end)) * qty).alias(CF_COL),
    )


def machine_days_summary(machine_day_rows: DataFrame) -> DataFrame:
    """R2: machine days by (contract, equipment type) and for the period.

    ``qt_id``/``equip_type_id`` are not grouping keys; they depend on the
    group in most books; where a contract quotes one type on several lines
    ``min`` picks one of them deterministically.
    """
    g = machine_day_rows.groupBy("q_id", "equip_type_name").agg(
        F.min("qt_id").alias("qt_id"),
        F.min("equip_type_id").alias("equip_type_id"),
        total(machine_day_rows, BF_COL).alias("Accumulated_machine_days_BF"),
        total(machine_day_rows, CF_COL).alias("Accumulated_machine_days_CF"),
    )
    return g.select("q_id", "qt_id", "equip_type_name", "equip_type_id",
                    "Accumulated_machine_days_BF", "Accumulated_machine_days_CF",
                    (F.col("Accumulated_machine_days_CF") - F.col("Accumulated_machine_days_BF"))
                    .alias(PERIOD_DAYS))


def quotations(vq: DataFrame, quotation_type: int) -> DataFrame:
    """The quotation lines of one pricing type.

    0 wholesale (one price for the whole stay), 1 per machine-day,
    2 per machine-group-day.
    """
    cols = {0: ["q_id", "qt_id", "rent_daily"],
            1: ["q_id", "qt_id", "equip_quantity", "equip_type_id", "rent_daily"],
            2: ["q_id", "qt_id", "rent_daily"]}[quotation_type]
    return vq.where(F.col("quotation_type") == quotation_type).select(*cols)


def quantity_by_quotation(vq_equip: DataFrame) -> DataFrame:
    """Total equipment quantity per type-2 quotation line."""
    return vq_equip.groupBy("qt_id").agg(F.sum("quantity").alias("sumofquantity"))


def rent_type0(vq: DataFrame, vq_wholesale: DataFrame, start, end, truncate: bool = False) -> DataFrame:
    """Wholesale rent split by the share of the stay inside the period.

    days = overlap of [entry, exit] with (start, end]; rent / total days *
    days; a zero-length stay gives NULL. ``truncate``: see ``ratio``.
    """
    entry, exit_ = F.col("entry_date"), F.col("exit_date")

    def left_after(day):  # days of the period that come after a day (NULL if NULL)
        return F.when(day.isNotNull(), F.datediff(date_lit(end), F.least(F.greatest(day, date_lit(start)), date_lit(end))))

    stays = vq_wholesale.select(F.col("qt_id").alias("stay_line"), (left_after(entry) - left_after(exit_)).alias("days"),
                                F.datediff(exit_, entry).alias("totaldays"))
    q = quotations(vq, 0)
    j = q.join(stays, F.col("qt_id") == F.col("stay_line"), "left")
    return j.select("q_id", "qt_id", (ratio(j, "rent_daily", "totaldays", truncate) * F.col("days")).alias(REVENUE))


def rent_type1(vq: DataFrame, summary: DataFrame, truncate: bool = False) -> DataFrame:
    """Per-machine-day rent = rent / quoted quantity * machine days of
    the same contract and equipment type. Unmatched lines keep a NULL."""
    q = quotations(vq, 1)
    s = summary.select(F.col("q_id").alias("s_q_id"), F.col("equip_type_id").alias("s_type_id"),
                       "equip_type_name", PERIOD_DAYS)
    j = q.join(s, (F.col("equip_type_id") == F.col("s_type_id")) & (F.col("q_id") == F.col("s_q_id")), "left")
    return j.select("q_id", "qt_id", "equip_type_id", "equip_type_name",
                    (ratio(j, "rent_daily", "equip_quantity", truncate) * F.col(PERIOD_DAYS)).alias(REVENUE))


def rent_type2(vq: DataFrame, vq_equip: DataFrame, summary: DataFrame, truncate: bool = False) -> DataFrame:
    """Per-machine-group-day rent = combined machine days of the line *
    rent / total quantity of the group.

    Machine days are summed per quotation line first; the inner join with
    the type-2 lines (each with its unit price) keeps exactly the lines the
    reports keep (a type-2 line with machine days), one row per quotation
    row, and reads the quotations once.
    """
    combined = (summary.groupBy(F.col("qt_id").alias("line"))
                .agg(total(summary, PERIOD_DAYS).alias("line_days")))
    sumq = quantity_by_quotation(vq_equip)
    priced = quotations(vq, 2).join(sumq, "qt_id", "left")
    unit = priced.select("q_id", F.col("qt_id").alias("priced_line"),
                         ratio(priced, "rent_daily", "sumofquantity", truncate).alias("price"))
    j = combined.join(unit, F.col("line") == F.col("priced_line"), "inner")
    return j.select("q_id", F.col("line").alias("qt_id"),
                    (F.col("line_days") * F.col("price")).alias(REVENUE))


def shared_summary(relocation: DataFrame, start, end, reuse: bool = True) -> DataFrame:
    """R1+R2 for a report that reads the summary several times.

    Nothing runs and nothing is written here. With ``reuse`` the summary is
    dealt by contract and marked to be kept when the report's own action
    first computes it: rent, revenue and cost per contract then share that
    partitioning, and a lost block is computed again from its lineage.
    ``session.release()`` frees it when the reports are done.
    """
    s = machine_days_summary(machine_days(relocation, start, end))
    return keep(s.repartition("q_id")) if reuse else s


@dataclass(frozen=True)
class RentTables:
    relocation: DataFrame
    vq: DataFrame
    vq_equip: DataFrame
    vq_wholesale: DataFrame


def accrued_revenue(t: RentTables, start, end, distinct: bool = True,
                    summary: DataFrame | None = None, truncate: bool = False) -> DataFrame:
    """Rent earned in (start, end] per (contract, quotation line).

    ``distinct=True`` keeps the reports' set union (equal lines collapse);
    ``distinct=False`` keeps every line (UNION ALL). ``summary`` is R2 for
    the same period when the caller already has it. ``truncate``: integer
    division of integral operands (see ``functions.expr.ratio``).
    """
    if summary is None:
        summary = shared_summary(t.relocation, start, end)
    cols = ["q_id", "qt_id", REVENUE]
    u = (rent_type0(t.vq, t.vq_wholesale, start, end, truncate).select(cols)
         .unionAll(rent_type1(t.vq, summary, truncate).select(cols))
         .unionAll(rent_type2(t.vq, t.vq_equip, summary, truncate).select(cols)))
    return u.distinct() if distinct else u


def invoiced_revenue(invoice: DataFrame, start, end, bounds: Bounds = Bounds.OPEN) -> DataFrame:
    """Invoiced price, VAT and total per (contract, client); the
    period excludes both end dates by default."""
    return (invoice.where(in_period("date", start, end, bounds))
            .groupBy("q_id", "client_id")
            .agg(exact_sum("price").alias("Invoiced_Amount"),
                 exact_sum("vat").alias("Invoiced_VAT"),
                 exact_sum("price_vat_total").alias("Invoiced_Total")))


def std_cost_by_machine(summary: DataFrame, equip_dailycost: DataFrame) -> DataFrame:
    """Standard daily cost * machine days per (contract, type)."""
    c = equip_dailycost.select(F.col("equip_type_name").alias("c_type_name"), "cost_day_std")
    j = summary.join(c, F.col("equip_type_name") == F.col("c_type_name"), "left")
    return j.select("q_id", "equip_type_name", "equip_type_id",
                    (F.col("cost_day_std") * F.col(PERIOD_DAYS)).alias(STD_COST))


def std_cost_by_contract(relocation: DataFrame, equip_dailycost: DataFrame, start, end,
                         summary: DataFrame | None = None) -> DataFrame:
    """Standard machine cost per contract for the period."""
    if summary is None:
        summary = machine_days_summary(machine_days(relocation, start, end))
    return (std_cost_by_machine(summary, equip_dailycost)
            .groupBy("q_id").agg(exact_sum(STD_COST).alias(STD_COST)))
