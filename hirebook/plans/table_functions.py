"""Reports as SQL table functions with the dates as arguments.

A view freezes its dates; a table function takes them, so one statement can
put several periods next to each other and nothing is registered again:

    SELECT c.ma_account_id, c.Amount - o.Amount AS moved
    FROM balance_for(DATE '1995-12-31', DATE '1997-12-31') c
    JOIN balance_for(DATE '1995-12-31', DATE '1996-12-31') o USING (ma_account_id)

``register_functions`` creates them in the session, over the temp views of the
business tables. A function is expanded into the statement that calls it, so
constant dates (also as ``:name`` parameters) reach the scans like written ones
and only the columns asked for are read. Sums are exact, with the bits of the
DataFrame operators. Call them with constants: Spark joins a table of periods
(``LATERAL``) with every row by nested loops.

A NULL date gives no rows of the period; balances then are the b/f amounts.
"""

from __future__ import annotations

from hirebook.functions.expr import MONEY_UNITS
from hirebook.operators import ledger as L
from hirebook.plans.views import register_tables
from hirebook.sources.fixtures import Book


def exact_sum_sql(x: str) -> str:
    """``functions.expr.exact_sum`` as SQL text."""
    plain = f"abs({x}) < {1 << 53}D"
    units = f"sum(CASE WHEN {plain} THEN floor({x}) END)"
    parts = f"sum(CASE WHEN {plain} THEN floor((({x}) - floor({x})) * {MONEY_UNITS} + 0.5D) END)"
    others = f"sum(CASE WHEN NOT {plain} THEN {x} END)"
    whole = f"CAST({units} AS DECIMAL(20,0)) * CAST({MONEY_UNITS} AS DECIMAL(10,0)) + CAST({parts} AS DECIMAL(20,0))"
    known = f"CAST(CAST({whole} AS DECIMAL(28,0)) * 0.00000001BD AS DOUBLE)"
    return f"CASE WHEN {units} IS NULL THEN {others} ELSE {known} + coalesce({others}, 0D) END"


SGN = "CASE WHEN is_cancelling IS NULL THEN 1 ELSE -1 END"
INSIDE, UP_TO = "date > from_day AND date < to_day", "date > from_day AND date <= to_day"
PERIOD = "from_day DATE, to_day DATE"

_SIGNED = {"net": f"{SGN} * (amount - vat)", "vat_in": f"{SGN} * CASE WHEN vat < 0 THEN 1 ELSE 0 END * vat",
           "vat_out": f"{SGN} * CASE WHEN vat > 0 THEN 1 ELSE 0 END * vat", "gross": f"{SGN} * amount"}
_FIXED = [(*L.BANK_ACCOUNT, "gross"), (*L.VAT_IN_ACCOUNT, "-vat_in"), (*L.VAT_OUT_ACCOUNT, "-vat_out")]
_BANK_SUMS = f"""SELECT ma_account_id, ma_account_name, {', '.join(f'{exact_sum_sql(m)} AS {m}' for m in _SIGNED)}
    FROM (SELECT ma_account_id, ma_account_name, {', '.join(f'{x} AS {m}' for m, x in _SIGNED.items())} FROM bankstatement WHERE {UP_TO})
    GROUP BY ma_account_id, ma_account_name"""


def _struct(fixed: bool, account: str, name: str, amount: str) -> str:
    return f"named_struct('fixed', {str(fixed).lower()}, 'id', {account}, 'name', {name}, 'moved', {amount})"


_SHARES = ", ".join([_struct(False, "ma_account_id", "ma_account_name", "-net"), *[_struct(True, f"'{i}'", f"'{n}'", x) for i, n, x in _FIXED]])
_NONE = ", ".join(_struct(True, f"'{i}'", f"'{n}'", "CAST(NULL AS DOUBLE)") for i, n, _ in _FIXED)
MOVEMENTS = f"""SELECT DISTINCT ma_account_id, ma_account_name, Amount FROM (
  SELECT fixed, id AS ma_account_id, min(name) AS ma_account_name, {exact_sum_sql('moved')} AS Amount
  FROM (SELECT inline(array({_SHARES})) FROM ({_BANK_SUMS}) UNION ALL SELECT inline(array({_NONE}))) GROUP BY fixed, id)"""
ADJUSTMENTS = f"""SELECT ma_account_id, min(ma_account_name) AS ma_account_name,
  coalesce({exact_sum_sql('debit')}, 0D) - coalesce({exact_sum_sql('credit')}, 0D) AS amount
  FROM (SELECT ma_account_id, ma_account_name, {exact_sum_sql('debit')} AS debit, {exact_sum_sql('credit')} AS credit
        FROM aje WHERE {UP_TO} GROUP BY ma_account_id, ma_account_name) GROUP BY ma_account_id"""


def _on_chart(opening: str, join: str = "") -> str:
    return f"""SELECT c.ma_account_id, c.ma_account_name, {opening}coalesce(m.Amount, 0D) + coalesce(j.amount, 0D) AS Amount
  FROM chart_of_accounts c LEFT JOIN ({MOVEMENTS}) m ON m.ma_account_id = c.ma_account_id
  LEFT JOIN ({ADJUSTMENTS}) j ON j.ma_account_id = c.ma_account_id {join}"""


_LEDGER = "ma_account_id STRING, ma_account_name STRING, Amount DOUBLE"

# name: (arguments, columns, query, the tables that it reads)
FUNCTIONS: dict[str, tuple[str, str, str, tuple[str, ...]]] = {
    "bank_movements_for": (PERIOD, _LEDGER, MOVEMENTS, ("bankstatement",)),
    "adjustments_for": (PERIOD, "ma_account_id STRING, ma_account_name STRING, amount DOUBLE", ADJUSTMENTS, ("aje",)),
    "balance_for": (PERIOD, _LEDGER, _on_chart("coalesce(f.bf_amount, 0D) + ", "LEFT JOIN account_bf f ON f.ma_account_id = c.ma_account_id"),
                    ("chart_of_accounts", "bankstatement", "aje", "account_bf")),
    "pl_for": (PERIOD, _LEDGER, _on_chart(""), ("chart_of_accounts", "bankstatement", "aje")),
    "cash_flow_for": (PERIOD, "suggested_cf BIGINT, cf_account_id BIGINT, Amount DOUBLE",
                      f"""SELECT suggested_cf, min(cf_account_id), -({exact_sum_sql('net')}) FROM (
  SELECT suggested_cf, cf_account_id, {_SIGNED['net']} AS net FROM bankstatement WHERE {UP_TO}) GROUP BY suggested_cf""", ("bankstatement",)),
    "invoiced_revenue_for": (PERIOD, "q_id BIGINT, client_id BIGINT, Invoiced_Amount DOUBLE, Invoiced_VAT DOUBLE, Invoiced_Total DOUBLE",
                             f"""SELECT q_id, client_id, {exact_sum_sql('price')}, {exact_sum_sql('vat')}, {exact_sum_sql('price_vat_total')}
  FROM invoice WHERE {INSIDE} GROUP BY q_id, client_id""", ("invoice",)),
    "client_receipts_for": (f"account STRING, {PERIOD}", "ep_id BIGINT, ep_name STRING, Received_amount DOUBLE",
                            f"""SELECT ep_id, ep_name, {exact_sum_sql('amount')} FROM bankstatement
  WHERE ma_account_id = account AND {INSIDE} GROUP BY ep_id, ep_name""", ("bankstatement",)),
}


def create_statement(name: str) -> str:
    """The ``CREATE FUNCTION`` text of one of ``FUNCTIONS``."""
    args, columns, body, _ = FUNCTIONS[name]
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS TABLE({columns}) RETURN {body}"


def register_functions(b: Book, names=None) -> list[str]:
    """Create or replace the table functions (all of them, or those named)
    and the views of the tables that they read; returns their names."""
    chosen = list(names or FUNCTIONS)
    register_tables(b, sorted({t for n in chosen for t in FUNCTIONS[n][3]}))
    for name in chosen:
        b.spark.sql(create_statement(name))
    return chosen
