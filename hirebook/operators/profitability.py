"""Contract and client gross profit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.functions.expr import exact_sum
from hirebook.operators.rental import (REVENUE, STD_COST, RentTables,
                                       accrued_revenue, shared_summary,
                                       std_cost_by_contract)


def contract_profitability(t: RentTables, equip_dailycost: DataFrame, start, end,
                           literal_id: bool = True) -> DataFrame:
    """Revenue, standard cost and gross profit per contract.

    Revenue drives the rows. With ``literal_id`` the reported ``q_id`` is
    the cost side's, NULL for a contract without machine days (as the
    reports do); ``literal_id=False`` reports the revenue side's id.
    A contract quoted to several parties yields one row per party.
    """
    summary = shared_summary(t.relocation, start, end)
    rev = (accrued_revenue(t, start, end, summary=summary)
           .groupBy(F.col("q_id").alias("revenue_q_id"))
           .agg(exact_sum(REVENUE).alias("Revenue")))
    cost = (std_cost_by_contract(t.relocation, equip_dailycost, start, end, summary=summary)
            .select(F.col("q_id").alias("cost_q_id"), STD_COST))
    parties = t.vq.select(F.col("q_id").alias("party_q_id"), "ep_id", "ep_name").distinct()
    return per_contract(rev, cost, parties, literal_id)


def per_contract(rev: DataFrame, cost: DataFrame, parties: DataFrame, literal_id: bool) -> DataFrame:
    """P1 from revenue (revenue_q_id, Revenue), cost (cost_q_id, standard cost)
    and parties (party_q_id, ep_id, ep_name) per contract."""
    j = (rev.join(cost, F.col("revenue_q_id") == F.col("cost_q_id"), "left")
         .join(parties, F.col("revenue_q_id") == F.col("party_q_id"), "left"))
    qid = F.col("cost_q_id") if literal_id else F.col("revenue_q_id")
    return j.select(qid.alias("q_id"), "ep_id", "ep_name", "Revenue",
                    F.col(STD_COST).alias("StdCost"),
                    (F.col("Revenue") - F.col(STD_COST)).alias("GrossProfit"))


def client_profitability(contracts: DataFrame) -> DataFrame:
    """P1 summed per client (each sum skips NULLs on its own).

    Hash-aggregated by (client, name) first; the name (not a key, the
    smallest if several) is then picked from that small result, since
    ``min`` of a string would make the big aggregate sort-based."""
    cols = ("Revenue", "StdCost", "GrossProfit")
    per_name = contracts.groupBy("ep_id", "ep_name").agg(*[exact_sum(c).alias(c) for c in cols])
    return per_name.groupBy("ep_id").agg(F.min("ep_name").alias("ep_name"), *[exact_sum(c).alias(c) for c in cols])
