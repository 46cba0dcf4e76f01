"""SQL table functions: the operators' rows to the bit, dates in the scans."""

import datetime as dt

import pytest

from conftest import SF_SMALL
from hirebook.operators import ledger as L
from hirebook.operators import recovery as RC
from hirebook.operators import rental as R
from hirebook.plans.table_functions import FUNCTIONS, register_functions
from hirebook.sources.fixtures import stored_book
from test_scale import plan_text

AR = "MA1122"


@pytest.fixture(scope="module")
def b(spark):
    book = stored_book(spark, SF_SMALL)
    assert register_functions(book) == list(FUNCTIONS)
    return book


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("lo,hi", [("1995-12-31", "1997-12-31"), ("1997-02-10", "1997-02-11")])
def test_functions_equal_the_operators(spark, b, lo, hi):
    want = {
        "bank_movements_for": L.bank_movements(b.bankstatement, lo, hi),
        "adjustments_for": L.adj_by_account(b.aje, lo, hi),
        "balance_for": L.balance_at(b.chart_of_accounts, b.bankstatement, b.aje, b.account_bf, lo, hi),
        "pl_for": L.pl_for(b.chart_of_accounts, b.bankstatement, b.aje, lo, hi),
        "cash_flow_for": L.cash_flow(b.bankstatement, lo, hi),
        "invoiced_revenue_for": R.invoiced_revenue(b.invoice, lo, hi),
        "client_receipts_for": RC.client_receipts(b.bankstatement, AR, lo, hi),
    }
    assert set(want) == set(FUNCTIONS)
    for name, df in want.items():
        first = f"'{AR}', " if FUNCTIONS[name][0].startswith("account") else ""
        got = spark.sql(f"SELECT * FROM {name}({first}DATE '{lo}', DATE '{hi}')")
        assert got.columns == df.columns and _rows(got) == _rows(df), name


def test_two_periods_in_one_statement_and_pushed_dates(spark, b):
    two = spark.sql("""SELECT n.q_id, n.Invoiced_Total - o.Invoiced_Total AS more FROM invoiced_revenue_for(:y0, :y1) o
        JOIN invoiced_revenue_for(:y1, :y2) n USING (q_id, client_id)""",
                    {f"y{i}": dt.date(1995 + i, 12, 31) for i in range(3)})
    scans = [x for x in plan_text(two).splitlines() if "FileScan" in x]
    assert len(scans) == 2 and all(f"GreaterThan(date,{y}-12-31)" in x for x, y in zip(scans, (1995, 1996)))
    assert all("vat#" not in x for x in scans)  # only what is asked for is read
    pl = plan_text(spark.sql("SELECT * FROM pl_for(DATE '1996-12-31', DATE '1997-12-31')"))
    assert sum("FileScan" in x and "vat#" in x for x in pl.splitlines()) == 1 and "NestedLoop" not in pl


def test_null_dates_give_no_rows(spark, b):
    assert spark.sql("SELECT * FROM invoiced_revenue_for(NULL, DATE '1997-12-31')").count() == 0
    got = {r.ma_account_id: r.Amount for r in spark.sql("SELECT * FROM balance_for(NULL, NULL)").collect()}
    bf = {r.ma_account_id: r.bf_amount or 0.0 for r in b.account_bf.collect()}
    assert got and all(got[k] == bf.get(k, 0.0) for k in got)
