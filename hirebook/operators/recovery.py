"""Receipts, opening receivables, client recovery and clearing.

Every join here is keyed by the client and one side is aggregated to one row
per key before the join, so no client's rows are paired with each other.
The reports' own recovery view joined per-contract invoice groups of two
periods on the client alone, which emits all pairs of a client's contract
groups; that form is not reproduced (README), the per-client one is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.functions.expr import date_lit, exact_sum, in_period, sgn
from hirebook.operators.rental import invoiced_revenue
from hirebook.params import Bounds
from hirebook.session import keep


def client_receipts(bank: DataFrame, ar_code: str, start, end,
                    reverse_cancelled: bool = False) -> DataFrame:
    """Receipts on the receivable account per (client, name), both end
    dates excluded. The reports add cancelling rows like normal ones;
    ``reverse_cancelled=True`` subtracts them."""
    amt = sgn() * F.col("amount") if reverse_cancelled else F.col("amount")
    return (bank.where((F.col("ma_account_id") == ar_code)
                       & in_period("date", start, end, Bounds.OPEN))
            .groupBy("ep_id", "ep_name").agg(exact_sum(amt).alias("Received_amount")))


def client_opening_bf(external_parties: DataFrame, ep_bf: DataFrame, ar_code: str) -> DataFrame:
    """Every client with its brought-forward receivable (NULL if none)."""
    clients = external_parties.where(F.col("ep_type") == "client").select("ep_id")
    bf = (ep_bf.where(F.col("ma_account_id") == ar_code)
          .groupBy(F.col("ep_id").alias("bf_id")).agg(exact_sum("amount").alias("amount")))
    return clients.join(bf, F.col("ep_id") == F.col("bf_id"), "left").select("ep_id", "amount")


def _receipts_by_party(bank: DataFrame, ar_code: str, lo, hi, name: str) -> DataFrame:
    return (bank.where((F.col("ma_account_id") == ar_code) & in_period("date", lo, hi, Bounds.HALF_OPEN))
            .groupBy(F.col("ep_id").alias("paid_by")).agg(exact_sum("amount").alias(name)))


def client_opening_at(opening_bf: DataFrame, bank: DataFrame, invoice: DataFrame,
                      ar_code: str, bf_date, start) -> DataFrame:
    """P5: receivable at ``start`` = b/f - receipts + invoices in
    (bf_date, start], one row per client and contract invoice group as the
    reports do (a client without invoices keeps one row). The invoice groups
    and the clients are shared (``session.keep``), so both are read once."""
    rec = _receipts_by_party(bank, ar_code, bf_date, start, "received")
    inv = keep(invoiced_revenue(invoice, bf_date, start, Bounds.HALF_OPEN).select("client_id", "Invoiced_Total"))
    z = F.lit(0.0)
    before = keep(opening_bf.join(rec, F.col("ep_id") == F.col("paid_by"), "left").select(
        "ep_id", (F.coalesce("amount", z) - F.coalesce("received", z)).alias("before")))
    # the invoice groups are the big side and come first: a client with very
    # many of them can be split; clients without any are added after
    billed = inv.join(before, F.col("client_id") == F.col("ep_id"), "inner").select(
        "ep_id", (F.col("before") + F.coalesce("Invoiced_Total", z)).alias("cutdateamount"))
    others = before.join(inv.groupBy("client_id").agg(F.count("*").alias("n")), F.col("client_id") == F.col("ep_id"), "left_anti")
    return billed.unionAll(others.select("ep_id", F.col("before").alias("cutdateamount")))


def client_recovery_by_client(external_parties: DataFrame, ep_bf: DataFrame, bank: DataFrame,
                              invoice: DataFrame, ar_code: str, bf_date, start, end) -> DataFrame:
    """P6/P7 per client: opening at ``start``, invoiced and received in
    (start, end], closing; missing amounts count as 0 (numeric fill only).

    Opening = b/f - receipts + invoices in (bf_date, start]. Receipts and
    invoices are each read once for (bf_date, end] and summed per client
    with one conditional sum per window, so every input is one row per
    client before it is joined.
    """
    bf = client_opening_bf(external_parties, ep_bf, ar_code)
    d, s = F.col("date"), date_lit(start)
    rec = (bank.where((F.col("ma_account_id") == ar_code) & in_period("date", bf_date, end, Bounds.HALF_OPEN))
           .groupBy(F.col("ep_id").alias("paid_by"))
           .agg(exact_sum(F.when(d <= s, F.col("amount"))).alias("rec0"),
                exact_sum(F.when(d > s, F.col("amount"))).alias("receiving")))
    inv = (invoice.where(in_period("date", bf_date, end, Bounds.HALF_OPEN))
           .groupBy("client_id")
           .agg(exact_sum(F.when(d <= s, F.col("price_vat_total"))).alias("inv0"),
                exact_sum(F.when(d > s, F.col("price_vat_total"))).alias("Invoiced")))
    names = external_parties.select(F.col("ep_id").alias("named_id"), "ep_name")
    k = F.col("ep_id")
    j = (bf.join(rec, k == F.col("paid_by"), "left")
         .join(inv, k == F.col("client_id"), "left")
         .join(names, k == F.col("named_id"), "left"))
    z = F.lit(0.0)
    opening = F.coalesce("amount", z) - F.coalesce("rec0", z) + F.coalesce("inv0", z)
    out = j.select("ep_id", "ep_name", opening.alias("Opening"),
                   F.coalesce("Invoiced", z).alias("Invoiced"),
                   F.coalesce("receiving", z).alias("receiving"))
    return out.withColumn("closing", F.col("Opening") + F.col("Invoiced") - F.col("receiving"))


def client_clearing(bank: DataFrame, invoice: DataFrame, ar_code: str, start, end,
                    reverse_cancelled: bool = False) -> DataFrame:
    """A client's receipts next to each of its contracts' invoiced
    totals in the same open period (one row per client and contract).

    Receipts are one row per client before the join, under the smallest of
    its names: several names don't multiply the contracts (the reports give
    every name a row per contract)."""
    rec = client_receipts(bank, ar_code, start, end, reverse_cancelled).groupBy("ep_id").agg(
        F.min("ep_name").alias("ep_name"), exact_sum("Received_amount").alias("Received_amount"))
    inv = invoiced_revenue(invoice, start, end, Bounds.OPEN)
    return inv.join(rec, F.col("ep_id") == F.col("client_id"), "inner").select(
        "ep_id", "ep_name", "Received_amount", "Invoiced_Total")
