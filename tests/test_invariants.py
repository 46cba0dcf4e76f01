"""Accounting invariants on the derived test tables (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from hirebook.operators import depreciation as D
from hirebook.operators import ledger as L
from hirebook.operators import payroll as W
from hirebook.operators import recovery as RC
from hirebook.params import TEST_PARAMS as P


def test_payroll_journal_balances(book):
    for month in (1, 2, 3):
        t = W.payroll_journal(book.payroll, book.worker_info, 2021, month).agg(
            F.sum("DR").alias("dr"), F.sum("CR").alias("cr")).collect()[0]
        assert t["dr"] == pytest.approx(t["cr"])


def test_depreciation_journal_balances_with_union_all(book):
    t = D.depr_journal(book.ppe_list, book.depr_alloc, 2000, 6, distinct=False).agg(
        F.sum("Debit").alias("dr"), F.sum("Credit").alias("cr")).collect()[0]
    assert t["dr"] == pytest.approx(t["cr"])


def test_balance_change_equals_movement(book):
    chart, bank, aje, bf = book.chart_of_accounts, book.bankstatement, book.aje, book.account_bf
    a = {r["ma_account_id"]: r["Amount"] for r in L.balance_at(chart, bank, aje, bf, P.bf_date, P.start).collect()}
    b = {r["ma_account_id"]: r["Amount"] for r in L.balance_at(chart, bank, aje, bf, P.bf_date, P.end).collect()}
    pl = {r["ma_account_id"]: r["Amount"] for r in L.pl_for(chart, bank, aje, P.start, P.end).collect()}
    assert set(a) == set(b) == set(pl)
    for k in pl:
        assert b[k] - a[k] == pytest.approx(pl[k], abs=1e-6)


def test_closing_is_next_opening(book):
    args = (book.external_parties, book.ep_bf, book.bankstatement, book.invoice, P.ar_code, P.bf_date)
    first = {r["ep_id"]: r["closing"] for r in RC.client_recovery_by_client(*args, P.start, P.end).collect()}
    nxt = {r["ep_id"]: r["Opening"] for r in RC.client_recovery_by_client(*args, P.end, "1998-12-31").collect()}
    assert set(first) == set(nxt)
    for k, v in first.items():
        assert nxt[k] == pytest.approx(v, abs=1e-6)


def test_cash_flow_total_is_minus_bank_movement_net_of_vat(book):
    cf = L.cash_flow(book.bankstatement, P.start, P.end).agg(F.sum("Amount")).collect()[0][0]
    by = L.bank_by_account(book.bankstatement, P.start, P.end).agg(F.sum("Amount")).collect()[0][0]
    assert cf == pytest.approx(by)
