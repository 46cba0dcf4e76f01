"""Named temp views for SQL users.

The reports' users queried named views (``SELECT * FROM ContractGrossProfit``).
``register_views`` creates session-scoped temp views with those names, each
a lazy report over the given tables and parameters, so the same SQL keeps
working through ``spark.sql``. Views are re-created on every call with the
new parameters; nothing is materialised.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.operators import depreciation as D
from hirebook.operators import integrity as I
from hirebook.operators import ledger as L
from hirebook.operators import payroll as W
from hirebook.operators import profitability as PR
from hirebook.operators import recovery as RC
from hirebook.operators import rental as R
from hirebook.params import ReportParams
from hirebook.sources.fixtures import Book


def report_views(b: Book, p: ReportParams, year: int | None = None,
                 month: int | None = None) -> dict[str, Callable[[], DataFrame]]:
    """View name -> builder. Payroll and depreciation views need ``year``
    and ``month``."""
    s, e = p.start, p.end
    rent = R.RentTables(b.relocation, b.vq, b.vq_equip, b.vq_wholesale)

    def summary():
        return R.machine_days_summary(R.machine_days(b.relocation, s, e))

    views = {
        "ReconcileEPBF": lambda: I.bf_reconciliation(b.ep_bf, b.account_bf),
        "invalid_ep_id_bank": lambda: I.bank_missing_party(b.chart_of_accounts, b.bankstatement),
        "invalid_ep_id_AJE": lambda: I.aje_missing_party(b.chart_of_accounts, b.aje),
        "machinedaycalculation": lambda: R.machine_days(b.relocation, s, e),
        "machinedaysummary": summary,
        "vqsumofquantity": lambda: R.quantity_by_quotation(b.vq_equip),
        "type0quotation": lambda: R.quotations(b.vq, 0),
        "type1quotation": lambda: R.quotations(b.vq, 1),
        "type2quotation": lambda: R.quotations(b.vq, 2),
        "revenue_type0": lambda: R.rent_type0(b.vq, b.vq_wholesale, s, e),
        "revenue_type1": lambda: R.rent_type1(b.vq, summary()),
        "revenue_type2": lambda: R.rent_type2(b.vq, b.vq_equip, summary()),
        "Revenue_from_rent": lambda: R.accrued_revenue(rent, s, e, summary=summary()),
        "invoice_for_the_period": lambda: R.invoiced_revenue(b.invoice, s, e),
        "Standard_machine_cost_by_QM": lambda: R.std_cost_by_machine(summary(), b.equip_dailycost),
        "Standard_machine_cost_by_quotation": lambda: R.std_cost_by_contract(b.relocation, b.equip_dailycost, s, e),
        "ContractGrossProfit": lambda: PR.contract_profitability(rent, b.equip_dailycost, s, e),
        "ClientGrossProfit": lambda: PR.client_profitability(
            PR.contract_profitability(rent, b.equip_dailycost, s, e)),
        "receipt_for_the_period_by_client": lambda: RC.client_receipts(b.bankstatement, p.ar_code, s, e),
        "client_bf": lambda: RC.client_opening_bf(b.external_parties, b.ep_bf, p.ar_code),
        "client_Recovery_report": lambda: RC.client_recovery_by_client(
            b.external_parties, b.ep_bf, b.bankstatement, b.invoice, p.ar_code, p.bf_date, s, e),
        "Client_clearing": lambda: RC.client_clearing(b.bankstatement, b.invoice, p.ar_code, s, e),
        f"client_per_{e.month:02d}": lambda: RC.client_opening_at(
            RC.client_opening_bf(b.external_parties, b.ep_bf, p.ar_code), b.bankstatement, b.invoice,
            p.ar_code, p.bf_date, s),
    }
    views.update(balance_views(b, p, "frtemp", e))
    views.update(pl_views(b, "pltemp", s, e))
    views.update(cash_flow_views(b, "cftemp", s, e))
    if year is not None and month is not None:
        def month_rows():
            return W.payroll_month(b.payroll, b.worker_info, year, month)
        flag = F.col(W.RECOVERABLE)
        views.update({
            f"payroll{year}{month}": month_rows,
            f"payrollinternal{year}{month}": lambda: month_rows().where(flag.isNull()),
            f"payrollexternal{year}{month}": lambda: month_rows().where(flag != 1),
            f"socialsecurityagency{year}{month}": lambda: month_rows().where(flag == 1),
            "TEMPPPE": lambda: D.ppe_list(b.ppe_list),
            "DEPR_BY_USER": lambda: D.depr_by_user(b.ppe_list, year, month),
            "DEPR_JE": lambda: D.depr_journal(b.ppe_list, b.depr_alloc, year, month),
        })
    return views


def balance_views(b: Book, p: ReportParams, tag: str, cut) -> dict[str, Callable[[], DataFrame]]:
    """Balance sheet at ``cut`` as ``balance_at_<tag>`` with the ledger
    intermediates; another tag for another date, so several can coexist."""
    return {f"balance_at_{tag}": lambda: L.balance_at(b.chart_of_accounts, b.bankstatement, b.aje, b.account_bf, p.bf_date, cut),
            **_ledger_views(b, tag, p.bf_date, cut)}


def pl_views(b: Book, tag: str, start, end) -> dict[str, Callable[[], DataFrame]]:
    """P&L of a period as ``during<tag>`` with the ledger intermediates."""
    return {f"during{tag}": lambda: L.pl_for(b.chart_of_accounts, b.bankstatement, b.aje, start, end),
            **_ledger_views(b, tag, start, end)}


def cash_flow_views(b: Book, tag: str, start, end) -> dict[str, Callable[[], DataFrame]]:
    """Cash flow of a period as ``CF_for_<tag>``."""
    return {f"CF_for_{tag}": lambda: L.cash_flow(b.bankstatement, start, end)}


def _ledger_views(b: Book, tag: str, lo, hi) -> dict[str, Callable[[], DataFrame]]:
    bank = b.bankstatement

    def fixed(acct):
        return lambda: L.bank_movements(bank, lo, hi).where(
            (F.col("ma_account_id") == acct[0]) & (F.col("ma_account_name") == acct[1]))

    return {
        f"accumulated_banktransaction_nonbank_for_{tag}": lambda: L.bank_by_account(bank, lo, hi),
        f"accumulated_banktransaction_vat0_for_{tag}": fixed(L.VAT_IN_ACCOUNT),
        f"accumulated_banktransaction_vat1_for_{tag}": fixed(L.VAT_OUT_ACCOUNT),
        f"accumulated_banktransaction_bank_for_{tag}": fixed(L.BANK_ACCOUNT),
        f"accumulated_banktransaction_for_{tag}": lambda: L.bank_movements(bank, lo, hi),
        f"accumulated_ADJ_for_{tag}": lambda: L.adj_by_account(b.aje, lo, hi),
    }


def register_tables(b: Book, names=None) -> None:
    """Temp views of the business tables under their own names."""
    for name in names or Book.NAMES:
        b.table(name).createOrReplaceTempView(name)


def register_views(b: Book, p: ReportParams, names=None, year: int | None = None,
                   month: int | None = None) -> list[str]:
    """Create or replace the named report views; returns the names."""
    return create_views(report_views(b, p, year, month), names)


def create_views(views: dict[str, Callable[[], DataFrame]], names=None) -> list[str]:
    """Create or replace temp views of the builders; returns the names."""
    chosen = list(names or views)
    for name in chosen:
        views[name]().createOrReplaceTempView(name)
    return chosen
