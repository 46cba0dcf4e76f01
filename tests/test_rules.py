"""Hand-written fixtures for the report rules and quirks.

Expected values are computed by hand from the rules, not by running code.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirebook.operators import depreciation as D
from hirebook.operators import integrity as I
from hirebook.operators import ledger as L
from hirebook.operators import payroll as W
from hirebook.operators import profitability as PR
from hirebook.operators import recovery as RC
from hirebook.operators import rental as R
from hirebook.sources.schemas import SCHEMAS

d = dt.date


def df(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table].replace("timestamp", "date"))


def _key(t):
    return tuple((x is None, 0 if x is None else x) for x in t)


def rows(frame, *cols):
    return sorted((tuple(r[c] for c in cols) for r in frame.collect()), key=_key)


# -- machine days (R1, R2; Q1, Q3, Q4) ------------------------------------------
@pytest.fixture
def reloc(spark):
    return df(spark, "relocation", [
        (1, 10, "S0", 1, "A", d(2021, 1, 1), 2, 1),
        (1, 10, "S0", 1, "A", d(2021, 3, 1), 1, -1),
        (1, 10, "S0", 1, "A", None, 5, 1),
    ])


def test_machine_days_clamp_and_null(reloc):
    md = R.machine_days(reloc, "2021-01-31", "2021-03-31")
    got = rows(md, "quantity", R.BF_COL, R.CF_COL)
    # 30 days * 2 / 89 days * 2; arrives after start -> 0 / 30 days * 1; NULL date -> NULL
    assert got == sorted([(2, 60, 178), (1, 0, 30), (5, None, None)], key=lambda r: r[0])


def test_machine_days_summary_ignores_direction_by_default(reloc):
    s = R.machine_days_summary(R.machine_days(reloc, "2021-01-31", "2021-03-31")).collect()
    assert len(s) == 1
    assert (s[0]["Accumulated_machine_days_BF"], s[0]["Accumulated_machine_days_CF"],
            s[0][R.PERIOD_DAYS]) == (60, 208, 148)
    signed = R.machine_days_summary(R.machine_days(reloc, "2021-01-31", "2021-03-31", signed=True)).collect()
    assert signed[0][R.PERIOD_DAYS] == 178 - 30 - 60


# -- rent (R5-R8; Q2, Q5, Q7) ---------------------------------------------------
def test_wholesale_share_and_zero_length_stay(spark):
    vq = df(spark, "vq", [(1, 10, 7, "c", 0, 1, 1, 100.0), (2, 20, 7, "c", 0, 1, 1, 90.0)])
    w = df(spark, "vq_wholesale", [(10, d(2021, 2, 1), d(2021, 2, 1)), (20, d(2021, 1, 1), d(2021, 1, 31))])
    got = rows(R.rent_type0(vq, w, "2021-01-11", "2021-01-21"), "qt_id", R.REVENUE)
    assert got == [(10, None), (20, pytest.approx(30.0))]
    whole = rows(R.rent_type0(vq, w, "2020-12-01", "2021-03-01"), "qt_id", R.REVENUE)
    assert whole[1] == (20, pytest.approx(90.0))


def _rent_tables(spark, vq_rows, reloc_rows, wholesale=(), equip=()):
    return R.RentTables(df(spark, "relocation", reloc_rows), df(spark, "vq", vq_rows),
                        df(spark, "vq_equip", list(equip)), df(spark, "vq_wholesale", list(wholesale)))


def test_union_collapses_equal_lines_union_all_keeps_them(spark):
    # two identical per-machine-day lines of one quotation line
    vq = [(1, 11, 7, "c", 1, 1, 1, 10.0), (1, 11, 7, "c", 1, 1, 1, 10.0)]
    reloc = [(1, 11, "S0", 1, "A", d(2021, 1, 1), 1, 1)]
    t = _rent_tables(spark, vq, reloc)
    assert R.accrued_revenue(t, "2021-01-01", "2021-01-11", summary=None).count() == 1
    assert R.accrued_revenue(t, "2021-01-01", "2021-01-11", distinct=False).count() == 2
    v = R.accrued_revenue(t, "2021-01-01", "2021-01-11").collect()[0][R.REVENUE]
    assert v == pytest.approx(10.0 * 10)


def test_zero_quantity_gives_null_revenue(spark):
    vq = [(1, 11, 7, "c", 1, 1, 0, 10.0)]
    reloc = [(1, 11, "S0", 1, "A", d(2021, 1, 1), 1, 1)]
    t = _rent_tables(spark, vq, reloc)
    assert R.rent_type1(t.vq, R.machine_days_summary(R.machine_days(t.relocation, "2021-01-01", "2021-01-11"))) \
        .collect()[0][R.REVENUE] is None


def test_group_rent_splits_by_total_quantity(spark):
    vq = [(3, 32, 7, "c", 2, 1, 1, 60.0)]
    reloc = [(3, 32, "S0", 1, "A", d(2021, 1, 1), 2, 1)]
    t = _rent_tables(spark, vq, reloc, equip=[(32, 1), (32, 2)])
    got = R.accrued_revenue(t, "2021-01-01", "2021-01-11").collect()
    # 2 machines * 10 days = 20 machine days; 60 / 3 per machine-day -> 400
    assert got[0][R.REVENUE] == pytest.approx(400.0)


def test_wholesale_without_relocation_has_null_cost_id(spark):
    vq = [(5, 50, 7, "c", 0, 1, 1, 100.0)]
    t = _rent_tables(spark, vq, [], wholesale=[(50, d(2021, 1, 1), d(2021, 1, 11))])
    cost = df(spark, "equip_dailycost", [("A", 2.0)])
    lit = PR.contract_profitability(t, cost, "2020-12-31", "2021-12-31").collect()[0]
    assert lit["q_id"] is None and lit["Revenue"] == pytest.approx(100.0) and lit["GrossProfit"] is None
    fixed = PR.contract_profitability(t, cost, "2020-12-31", "2021-12-31", literal_id=False).collect()[0]
    assert fixed["q_id"] == 5 and fixed["ep_id"] == 7


# -- invoices, receipts, recovery (R10, P3-P8; Q6, Q8, Q9) ------------------------
def test_invoice_period_open_on_both_ends(spark):
    inv = df(spark, "invoice", [(1, 7, d(2021, 1, 1), 1.0, 0.1, 1.1), (1, 7, d(2021, 1, 2), 2.0, 0.2, 2.2),
                                (1, 7, d(2021, 1, 3), 4.0, 0.4, 4.4)])
    got = R.invoiced_revenue(inv, "2021-01-01", "2021-01-03").collect()
    assert len(got) == 1 and got[0]["Invoiced_Amount"] == pytest.approx(2.0)


def _bank(spark, rows_):
    # (date, account, ep_id, amount, vat, is_cancelling)
    return df(spark, "bankstatement", [(dt_, acc, "n-" + acc, ep, "p" if ep else None, amt, vat, canc, 0, 0)
                                       for dt_, acc, ep, amt, vat, canc in rows_])


def test_receipts_ignore_cancellation_flag_unless_asked(spark):
    bank = _bank(spark, [(d(2021, 1, 5), "MA1122", 1, 100.0, 0.0, None), (d(2021, 1, 6), "MA1122", 1, 40.0, 0.0, 1)])
    lit = RC.client_receipts(bank, "MA1122", "2021-01-01", "2021-02-01").collect()[0]["Received_amount"]
    net = RC.client_receipts(bank, "MA1122", "2021-01-01", "2021-02-01", reverse_cancelled=True) \
        .collect()[0]["Received_amount"]
    assert (lit, net) == (pytest.approx(140.0), pytest.approx(60.0))


def test_opening_per_invoice_group_and_by_client(spark):
    parties = df(spark, "external_parties", [(1, "c1", "client"), (2, "c2", "client"), (9, "s", "supplier")])
    bf = df(spark, "ep_bf", [(1, "MA1122", 100.0), (2, "MA1122", 50.0)])
    bank = _bank(spark, [(d(2021, 1, 10), "MA1122", 1, 30.0, 0.0, None),
                         (d(2021, 3, 10), "MA1122", 1, 5.0, 0.0, None)])
    inv = df(spark, "invoice", [(11, 1, d(2021, 1, 5), 0.0, 0.0, 20.0), (12, 1, d(2021, 1, 6), 0.0, 0.0, 7.0),
                                (13, 1, d(2021, 3, 5), 0.0, 0.0, 11.0)])
    opening_bf = RC.client_opening_bf(parties, bf, "MA1122")
    per_group = rows(RC.client_opening_at(opening_bf, bank, inv, "MA1122", "2020-12-31", "2021-01-31"),
                     "ep_id", "cutdateamount")
    # client 1: one row per contract group: 100 - 30 + 20 and 100 - 30 + 7
    assert per_group == [(1, pytest.approx(77.0)), (1, pytest.approx(90.0)), (2, pytest.approx(50.0))]
    rec = {r["ep_id"]: r for r in RC.client_recovery_by_client(
        parties, bf, bank, inv, "MA1122", "2020-12-31", "2021-01-31", "2021-03-31").collect()}
    assert rec[1]["Opening"] == pytest.approx(97.0)
    assert (rec[1]["Invoiced"], rec[1]["receiving"], rec[1]["closing"]) == (11.0, 5.0, pytest.approx(103.0))
    assert rec[2]["closing"] == pytest.approx(50.0) and rec[2]["ep_name"] == "c2"
    assert 9 not in rec


# -- ledger (L1-L8; Q19, duplicate bank account) ----------------------------------
def test_ledger_lines_and_bounds(spark):
    bank = _bank(spark, [
        (d(2021, 1, 1), "MA2001", 1, 106.0, 6.0, None),    # on lo: excluded
        (d(2021, 1, 2), "MA2001", 1, 106.0, 6.0, None),
        (d(2021, 1, 31), "MA2001", 1, -53.0, -3.0, 1),     # on hi: included, cancelling
        (d(2021, 1, 15), "MA2002", 1, 10.0, None, None),   # NULL vat drops from account sum
    ])
    by = {r["ma_account_id"]: r["Amount"] for r in L.bank_by_account(bank, "2021-01-01", "2021-01-31").collect()}
    # -(1*(106-6) + (-1)*(-53+3)) = -150; MA2002 -> NULL
    assert by == {"MA2001": pytest.approx(-150.0), "MA2002": None}
    fixed = {r["ma_account_id"]: r["Amount"] for r in L.bank_movements(bank, "2021-01-01", "2021-01-31").collect()}
    assert fixed["MA1002"] == pytest.approx(106.0 + 53.0 + 10.0)
    assert fixed["MA22210102"] == pytest.approx(-6.0)      # VAT out: positive vat
    assert fixed["MA22210101"] == pytest.approx(-3.0)      # VAT in: -(-1 * -3)


def test_balance_drops_accounts_outside_chart_and_doubles_bank_in_l1(spark):
    chart = df(spark, "chart_of_accounts", [("MA1002", "Bank", 0), ("MA2001", "x", 0)])
    bank = _bank(spark, [(d(2021, 1, 2), "MA1002", 1, 10.0, 0.0, None), (d(2021, 1, 3), "MA9999", 1, 5.0, 0.0, None)])
    aje = df(spark, "aje", [(d(2021, 1, 4), "MA2001", "x", None, 3.0, None, 3.0)])
    bf = df(spark, "account_bf", [("MA2001", 100.0)])
    got = rows(L.balance_at(chart, bank, aje, bf, "2020-12-31", "2021-01-31"), "ma_account_id", "Amount")
    # MA1002 twice: bank total (+15) and its own counter-account line (-10)
    assert got == [("MA1002", pytest.approx(-10.0)), ("MA1002", pytest.approx(15.0)), ("MA2001", pytest.approx(103.0))]


# -- integrity (I1-I6) -----------------------------------------------------------------
def test_running_stock_nets_same_day_and_finds_first_negative(spark):
    reloc = df(spark, "relocation", [
        (1, 10, "S0", 1, "A", d(2021, 1, 1), 2, 1), (1, 10, "S0", 1, "A", d(2021, 1, 2), 3, -1),
        (2, 20, "S0", 1, "A", d(2021, 1, 5), 1, -1), (2, 20, "S0", 1, "A", d(2021, 1, 5), 1, 1),
        (3, 30, None, 1, "A", d(2020, 1, 1), 9, -1),
    ])
    neg = rows(I.relocation_negative(reloc), "q_id", "date", "stock")
    assert neg == [(1, d(2021, 1, 2), -1)]
    assert I.relocation_negative_first(reloc).collect()[0][0] == d(2021, 1, 2)


def test_missing_party_only_on_control_accounts(spark):
    chart = df(spark, "chart_of_accounts", [("MA1122", "ar", 1), ("MA2001", "x", 0)])
    bank = _bank(spark, [(d(2021, 1, 2), "MA1122", None, 1.0, 0.0, None),
                         (d(2021, 1, 2), "MA2001", None, 1.0, 0.0, None),
                         (d(2021, 1, 2), "MA1122", 5, 1.0, 0.0, None)])
    assert rows(I.bank_missing_party(chart, bank), "MID", "MID2") == [("MA1122", "MA1122")]


def test_bf_reconciliation_id_from_ledger_side(spark):
    ep = df(spark, "ep_bf", [(1, "MA1122", 60.0), (2, "MA1122", 40.0), (3, "MA2202", 5.0)])
    bf = df(spark, "account_bf", [("MA1122", 100.0)])
    got = rows(I.bf_reconciliation(ep, bf), "ma_account_id", "BFDIFF")
    assert got == [("MA1122", 0.0), (None, None)]


# -- payroll (W1-W5; Q11, Q15) -------------------------------------------------------------
@pytest.fixture
def pay(spark):
    p = df(spark, "payroll", [
        (1, 2021, 3, 1000.0, 30.0, 100.0, 50.0, 200.0, None),
        (2, 2021, 3, 2000.0, 60.0, 200.0, 100.0, 400.0, None),
        (3, 2021, 3, 500.0, 15.0, 50.0, 25.0, 100.0, None),    # no department: not in W2
        (4, 2021, 3, 800.0, 24.0, 80.0, 40.0, 160.0, 0),       # associate
        (5, 2021, 3, 700.0, 21.0, 70.0, 35.0, 140.0, 1),       # external
        (6, 2021, 3, 900.0, 27.0, 90.0, 45.0, 180.0, 1),       # external
        (7, 2021, 3, 999.0, 0.0, 0.0, 0.0, 999.0, 1),          # no worker record
        (1, 2021, 2, 5.0, 0.0, 0.0, 0.0, 5.0, None),           # other month
    ])
    w = df(spark, "worker_info", [(1, "ops"), (2, "sales"), (3, None), (4, "ops"), (5, "ext"), (6, "ext")])
    return p, w


def test_payroll_blocks_balance(pay):
    p, w = pay
    m = W.payroll_month(p, w, 2021, 3)
    assert m.count() == 6
    reg = {r["line_no"]: (r["DR"], r["CR"]) for r in W.payroll_regular(m, 2021, 3).collect()}
    assert reg[1] == (3000.0, 0.0) and reg[7] == (0.0, 90.0 + 300.0 + 150.0) and reg[8] == (0.0, 600.0)
    j = W.payroll_journal(p, w, 2021, 3).collect()
    assert sum(r["DR"] for r in j) == pytest.approx(sum(r["CR"] for r in j))
    ext = [r for r in j if r["line_no"] == 11]
    assert sorted((r["worker_id"], r["DR"]) for r in ext) == [(5, 140.0), (6, 180.0)]
    assert {r["date"] for r in j} == {"2021/03"}
    assert [r for r in j if r["line_no"] == 9][0]["DR"] == 160.0


# -- depreciation (D1-D3; Q12) ----------------------------------------------------------------
def test_depreciation_month_and_january(spark):
    ppe = df(spark, "ppe_list", [("C", "U1", "2020-03-01", 1000.0, 100.0, 9),
                                 ("C", "U1", "junk", 1000.0, 100.0, 9),
                                 ("C", "U2", "2019-11-01", 1000.0, 100.0, 9)])
    june = {r["ppe_user"]: r["CurrentDep"] for r in D.depr_by_user(ppe, 2020, 6).collect()}
    assert june == {"U1": 100.0, "U2": 100.0}
    jan = {r["ppe_user"]: r["CurrentDep"] for r in D.depr_by_user(ppe, 2020, 1).collect()}
    assert jan == {"U1": 0.0, "U2": 100.0}   # U1 not started yet; the junk start is year 0, long written off
    after_life = {r["ppe_user"]: r["CurrentDep"] for r in D.depr_by_user(ppe, 2021, 1).collect()}
    assert after_life["U1"] == 0.0


def test_depreciation_journal_union_and_credit(spark):
    ppe = df(spark, "ppe_list", [("C", "U1", "2020-03-01", 1000.0, 100.0, 9),
                                 ("C", "U2", "2020-03-01", 1000.0, 100.0, 9)])
    alloc = df(spark, "depr_alloc", [("U1", "MA560210"), ("U2", "MA560210")])
    dist = D.depr_journal(ppe, alloc, 2020, 6).collect()
    assert len(dist) == 2   # the two equal debit lines collapse
    every = D.depr_journal(ppe, alloc, 2020, 6, distinct=False).collect()
    assert len(every) == 3
    credit = [r for r in every if r["ma_account_id"] == "MA1062"][0]
    assert (credit["Credit"], credit["amount"], credit["top"]) == (200.0, -200.0, "1602")
    debit = [r for r in every if r["ma_account_id"] == "MA560210"][0]
    assert (debit["top"], debit["pure_account_id"], debit["date"]) == ("5602", "560210", "2020-06-01")
    assert sum(r["Debit"] for r in every) == sum(r["Credit"] for r in every)


# -- time of day on a bound; bare columns (Q4) ---------------------------------------
def test_time_of_day_on_the_end_date_is_outside_the_period(spark):
    rows = [(dt.datetime(2021, 1, 31, 0, 0), "MA2001", "a", 10.0, 0.0),
            (dt.datetime(2021, 1, 31, 10, 0), "MA2001", "a", 5.0, 0.0)]
    bank = spark.createDataFrame(rows, "date timestamp_ntz, ma_account_id string, ma_account_name string, "
                                       "amount double, vat double") \
        .withColumn("is_cancelling", F.lit(None).cast("int"))
    got = L.bank_by_account(bank, "2021-01-01", "2021-01-31").collect()
    assert [(r["ma_account_id"], r["Amount"]) for r in got] == [("MA2001", -10.0)]


def test_bare_columns_take_the_smallest_value(spark):
    bank = _bank(spark, [(d(2021, 1, 2), "MA2001", 1, 1.0, 0.0, None)]).unionByName(
        df(spark, "bankstatement", [(d(2021, 1, 3), "MA2001", "a-name", 1, "p", 2.0, 0.0, None, 0, 0)]))
    got = L.bank_by_account(bank, "2021-01-01", "2021-01-31").collect()
    assert len(got) == 1 and got[0]["ma_account_name"] == "a-name"
    reloc = df(spark, "relocation", [(1, 12, "S0", 2, "A", d(2021, 1, 1), 1, 1),
                                     (1, 11, "S0", 1, "A", d(2021, 1, 2), 1, 1)])
    s = R.machine_days_summary(R.machine_days(reloc, "2021-01-01", "2021-01-31")).collect()
    assert len(s) == 1 and (s[0]["qt_id"], s[0]["equip_type_id"]) == (11, 1)


def test_truncating_division_only_for_integral_operands(spark):
    vq = spark.createDataFrame([(1, 11, 7, "c", 1, 1, 3, 10)],
                               "q_id bigint, qt_id bigint, ep_id bigint, ep_name string, quotation_type bigint, "
                               "equip_type_id bigint, equip_quantity int, rent_daily bigint")
    summary = R.machine_days_summary(R.machine_days(
        df(spark, "relocation", [(1, 11, "S0", 1, "A", d(2021, 1, 1), 1, 1)]), "2021-01-01", "2021-01-11"))
    exact = R.rent_type1(vq, summary).collect()[0][R.REVENUE]
    trunc = R.rent_type1(vq, summary, truncate=True).collect()[0][R.REVENUE]
    assert exact == pytest.approx(10 / 3 * 10) and trunc == 30     # 10 div 3 = 3, times 10 days
    zero = vq.withColumn("equip_quantity", F.lit(0))
    assert R.rent_type1(zero, summary, truncate=True).collect()[0][R.REVENUE] is None
    doubles = df(spark, "vq", [(1, 11, 7, "c", 1, 1, 3, 10.0)])
    assert R.rent_type1(doubles, summary, truncate=True).collect()[0][R.REVENUE] == pytest.approx(10 / 3 * 10)


def test_contract_with_two_parties_gives_a_row_per_party(spark):
    vq = [(1, 11, 7, "c7", 1, 1, 1, 10.0), (1, 12, 8, "c8", 1, 2, 1, 20.0)]
    reloc = [(1, 11, "S0", 1, "A", d(2021, 1, 1), 1, 1), (1, 12, "S0", 2, "B", d(2021, 1, 1), 1, 1)]
    t = _rent_tables(spark, vq, reloc)
    cost = df(spark, "equip_dailycost", [("A", 1.0), ("B", 2.0)])
    rows_ = {r["ep_id"]: r for r in PR.contract_profitability(t, cost, "2021-01-01", "2021-01-11").collect()}
    # contract revenue 10*10 + 20*10 = 300 and cost 1*10 + 2*10 = 30 on both party rows
    assert set(rows_) == {7, 8}
    assert all((r["q_id"], r["Revenue"], r["StdCost"]) == (1, 300.0, 30.0) for r in rows_.values())
    clients = {r["ep_id"]: r["GrossProfit"] for r in PR.client_profitability(
        PR.contract_profitability(t, cost, "2021-01-01", "2021-01-11")).collect()}
    assert clients == {7: 270.0, 8: 270.0}


def test_user_with_two_allocations_debits_the_full_amount_twice(spark):
    ppe = df(spark, "ppe_list", [("C", "U1", "2020-03-01", 1000.0, 100.0, 9)])
    alloc = df(spark, "depr_alloc", [("U1", "MA560210"), ("U1", "MA540110")])
    j = D.depr_journal(ppe, alloc, 2020, 6).collect()
    debits = sorted((r["ma_account_id"], r["Debit"]) for r in j if r["Debit"] > 0)
    assert debits == [("MA540110", 100.0), ("MA560210", 100.0)]
    assert [r["Credit"] for r in j if r["ma_account_id"] == "MA1062"] == [100.0]
