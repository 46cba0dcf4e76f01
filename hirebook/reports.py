"""One object with the reports' calls, defaults filled from ``ReportParams``.

``Reports(book, params)`` mirrors the calls a user of the reports makes
(accrued revenue for a period, balance sheet at a date, the multi-period
compile, the payroll journal of a month, ...). A missing start or end falls
back to the parameters independently. Every method returns a lazy DataFrame
built by the operators in ``hirebook.operators``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from hirebook.operators import depreciation as D
from hirebook.operators import integrity as I
from hirebook.operators import ledger as L
from hirebook.operators import payroll as W
from hirebook.operators import profitability as PR
from hirebook.operators import recovery as RC
from hirebook.operators import rental as R
from hirebook.operators import statements as ST
from hirebook.params import ReportParams
from hirebook.sources.fixtures import Book


@dataclass
class Reports:
    book: Book
    params: ReportParams = field(default_factory=ReportParams)
    report_format: ST.ReportFormat | None = None

    # -- parameters --------------------------------------------------------
    def set_date(self, start, end) -> None:
        self.params = self.params.with_dates(start, end)

    def show_date(self):
        return self.params.start, self.params.end

    def _p(self, start, end):
        return self.params.period(start, end)

    def _rent(self) -> R.RentTables:
        b = self.book
        return R.RentTables(b.relocation, b.vq, b.vq_equip, b.vq_wholesale)

    def _ledger(self) -> ST.LedgerTables:
        b = self.book
        return ST.LedgerTables(b.chart_of_accounts, b.bankstatement, b.aje, b.account_bf)

    def _format(self) -> ST.ReportFormat:
        if self.report_format is None:
            b = self.book
            self.report_format = ST.ReportFormat(b.report_template, b.report_mapping, b.cf_mapping)
        return self.report_format

    # -- tables ----------------------------------------------------------------
    def show(self, table: str, where=None) -> DataFrame:
        df = self.book.table(table)
        return df if where is None else df.where(where)

    # -- contracts -------------------------------------------------------------
    def quotations(self, quotation_type: int) -> DataFrame:
        return R.quotations(self.book.vq, quotation_type)

    def machine_days(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return R.machine_days_summary(R.machine_days(self.book.relocation, s, e))

    def accrued_revenue(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return R.accrued_revenue(self._rent(), s, e)

    def invoiced_revenue(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return R.invoiced_revenue(self.book.invoice, s, e)

    def standard_cost(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return R.std_cost_by_contract(self.book.relocation, self.book.equip_dailycost, s, e)

    def contract_profitability(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return PR.contract_profitability(self._rent(), self.book.equip_dailycost, s, e)

    def client_gross_profit(self, start=None, end=None) -> DataFrame:
        return PR.client_profitability(self.contract_profitability(start, end))

    def contract_recovery(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return RC.client_receipts(self.book.bankstatement, self.params.ar_code, s, e)

    def client_recovery(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        b = self.book
        return RC.client_recovery_by_client(b.external_parties, b.ep_bf, b.bankstatement, b.invoice,
                                            self.params.ar_code, self.params.bf_date, s, e)

    def contract_clearing(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return RC.client_clearing(self.book.bankstatement, self.book.invoice, self.params.ar_code, s, e)

    # -- ledger and statements ---------------------------------------------------
    def fp_as_at(self, cut) -> DataFrame:
        t = self._ledger()
        return L.balance_at(t.chart, t.bank, t.aje, t.account_bf, self.params.bf_date, cut)

    def pl_for(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        t = self._ledger()
        return L.pl_for(t.chart, t.bank, t.aje, s, e)

    def cf_for(self, start=None, end=None) -> DataFrame:
        s, e = self._p(start, end)
        return L.cash_flow(self.book.bankstatement, s, e)

    def statement(self, kind: str, start=None, end=None, label_col: str | None = None) -> DataFrame:
        """One statement; ``label_col`` renames the line label column (for
        example to the template's own header)."""
        s, e = self._p(start, end)
        amounts = ST.single_period_amounts(kind, self._ledger(), self.params.bf_date, s, e)
        out = ST.statement(kind, amounts, self._format())
        return out.withColumnRenamed("line_name", label_col) if label_col else out

    def compile_reports(self, last_reporting_date, periods: int, frequency: str):
        """Balance sheets, P&L and cash flows for ``periods`` periods:
        ``(fp, pl, cf)`` wide DataFrames, one column per period."""
        return ST.compile_reports(self.book.spark, self._ledger(), self._format(), self.params.bf_date,
                                  last_reporting_date, periods, frequency)

    # -- payroll, depreciation, integrity ---------------------------------------------
    def payroll_processing(self, year: int, month: int) -> DataFrame:
        return W.payroll_journal(self.book.payroll, self.book.worker_info, year, month)

    def depreciation_journal(self, year: int, month: int) -> DataFrame:
        return D.depr_journal(self.book.ppe_list, self.book.depr_alloc, year, month)

    def payroll_month(self, year: int, month: int) -> DataFrame:
        return W.payroll_month(self.book.payroll, self.book.worker_info, year, month)

    def payroll_regular(self, year: int, month: int) -> DataFrame:
        return W.payroll_regular(self.payroll_month(year, month), year, month)

    def payroll_associate(self, year: int, month: int) -> DataFrame:
        return W.payroll_associate(self.payroll_month(year, month), year, month)

    def payroll_external(self, year: int, month: int) -> DataFrame:
        return W.payroll_external(self.payroll_month(year, month), year, month)

    def ppe_list(self) -> DataFrame:
        return D.ppe_list(self.book.ppe_list)

    def depreciation_by_user(self, year: int, month: int) -> DataFrame:
        return D.depr_by_user(self.book.ppe_list, year, month)

    def check_relocation_negative(self) -> DataFrame:
        """First date with a negative running stock (one row, NULL if none)."""
        return I.relocation_negative_first(self.book.relocation)

    def check_bf_account_vs_externalparties(self) -> DataFrame:
        return I.bf_reconciliation(self.book.ep_bf, self.book.account_bf)

    def check_bankstatement_for_missing_ep_id(self) -> DataFrame:
        return I.bank_missing_party(self.book.chart_of_accounts, self.book.bankstatement)

    def check_aje_for_missing_ep_id(self) -> DataFrame:
        return I.aje_missing_party(self.book.chart_of_accounts, self.book.aje)

    def check_missing_vat(self) -> DataFrame:
        return I.bank_missing_vat(self.book.bankstatement)

    def data_integrity(self) -> DataFrame:
        b = self.book
        return I.integrity_summary(b.relocation, b.ep_bf, b.account_bf, b.chart_of_accounts, b.bankstatement, b.aje)

    def register_views(self, names=None, year: int | None = None, month: int | None = None) -> list[str]:
        """Create the reports' named temp views for ``spark.sql`` users."""
        from hirebook.plans.views import register_views
        return register_views(self.book, self.params, names, year, month)

    def with_params(self, **changes) -> "Reports":
        return Reports(self.book, replace(self.params, **changes), self.report_format)
