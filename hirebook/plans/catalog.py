"""Registered report queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each query reads the business tables derived from the driver's tables at
``sf_dir`` (derived and stored once per session, ``stored_book``), runs one
report over the whole tables with the test parameters, and rounds reported
amounts to cents once, at the output. ``hirebook.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.functions.expr import date_lit, money
from hirebook.operators import contract_store as CS
from hirebook.operators import depreciation as D
from hirebook.operators import integrity as I
from hirebook.operators import ledger as L
from hirebook.operators import payroll as W
from hirebook.operators import profitability as PR
from hirebook.operators import recovery as RC
from hirebook.operators import rental as R
from hirebook.operators import rollup as RU
from hirebook.operators import statements as ST
from hirebook.params import TEST_PARAMS as P
from hirebook.plans.table_functions import register_functions
from hirebook.plans.views import balance_views, create_views, pl_views
from hirebook.reports import Reports
from hirebook.session import release, scratch_path
from hirebook.sources import loaders as LD
from hirebook.sources.fixtures import Book, stored_book
from hirebook.sources.schemas import SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ROLLUP_START, ROLLUP_CUT = "1996-02-10", "1997-08-17"  # both inside a month
DEFAULTS_START, DEFAULTS_END = "1997-06-30", "1997-03-31"


def present(df: DataFrame) -> DataFrame:
    """Report presentation: doubles rounded to cents, dates as ISO text
    (``yyyy-MM-dd``, as the reports returned them)."""
    def col(f):
        if isinstance(f.dataType, T.DoubleType):
            return money(f.name).alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name)
        return F.col(f.name)
    return df.select(*[col(f) for f in df.schema.fields])


def query(name: str):
    def deco(fn: Callable[[Book], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            release()  # what the query before this one shared
            return present(fn(stored_book(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def rent_tables(b: Book) -> R.RentTables:
    return R.RentTables(b.relocation, b.vq, b.vq_equip, b.vq_wholesale)


def summary(b: Book) -> DataFrame:
    return R.machine_days_summary(R.machine_days(b.relocation, P.start, P.end))


# -- machine days, rent, cost (R) ---------------------------------------------
@query("machine_days")
def _machine_days(b):
    return R.machine_days(b.relocation, P.start, P.end)


@query("machine_days_summary")
def _machine_days_summary(b):
    return summary(b)


@query("machine_days_summary_signed")
def _machine_days_summary_signed(b):
    """R2 with movements signed by direction (option of Q3)."""
    return R.machine_days_summary(R.machine_days(b.relocation, P.start, P.end, signed=True))


@query("quotation_quantity")
def _quotation_quantity(b):
    """Total equipment quantity per group quotation line."""
    return R.quantity_by_quotation(b.vq_equip)


@query("quotation_split")
def _quotation_split(b):
    kind = F.col("quotation_type")

    def of_type1(c):
        return F.when(kind == 1, F.col(c)).alias(c)

    return b.vq.where(kind.isin(0, 1, 2)).select(kind.cast("int").alias("quotation_type"), "q_id", "qt_id",
                                                 of_type1("equip_quantity"), of_type1("equip_type_id"), "rent_daily")


def _quotations_of(t):
    def fn(b):
        return R.quotations(b.vq, t)
    fn.__doc__ = f"R4: quotation lines of pricing type {t} with that type's columns."
    return fn


for _t in (0, 1, 2):
    query(f"quotation_type{_t}")(_quotations_of(_t))


@query("rent_type0")
def _rent_type0(b):
    return R.rent_type0(b.vq, b.vq_wholesale, P.start, P.end)


@query("rent_type1")
def _rent_type1(b):
    return R.rent_type1(b.vq, summary(b))


@query("rent_type2")
def _rent_type2(b):
    return R.rent_type2(b.vq, b.vq_equip, summary(b))


@query("accrued_revenue")
def _accrued_revenue(b):
    return R.accrued_revenue(rent_tables(b), P.start, P.end)


@query("accrued_revenue_all")
def _accrued_revenue_all(b):
    return R.accrued_revenue(rent_tables(b), P.start, P.end, distinct=False)


@query("invoiced_revenue")
def _invoiced_revenue(b):
    return R.invoiced_revenue(b.invoice, P.start, P.end)


@query("std_cost_by_machine")
def _std_cost_by_machine(b):
    return R.std_cost_by_machine(summary(b), b.equip_dailycost)


@query("std_cost_by_contract")
def _std_cost_by_contract(b):
    return R.std_cost_by_contract(b.relocation, b.equip_dailycost, P.start, P.end)


# -- profitability, recovery (P) ----------------------------------------------
@query("contract_profitability")
def _contract_profitability(b):
    return PR.contract_profitability(rent_tables(b), b.equip_dailycost, P.start, P.end)


@query("contract_profitability_by_revenue")
def _contract_profitability_by_revenue(b):
    return PR.contract_profitability(rent_tables(b), b.equip_dailycost, P.start, P.end, literal_id=False)


def _stored_contracts(b):
    """The contract store of the book, written by the first query that reads it."""
    if "contract_store" not in vars(b):
        path = scratch_path(b.spark, "contracts")
        CS.write_contract_store(path, rent_tables(b), b.equip_dailycost)
        b.contract_store = CS.read_contract_store(b.spark, path)
    return b.contract_store


@query("rent_type1_stored")
def _rent_type1_stored(b):
    """R6 from tables bucketed by contract."""
    return CS.rent_type1(_stored_contracts(b), P.start, P.end)


@query("rent_type2_stored")
def _rent_type2_stored(b):
    """R7 from tables bucketed by contract."""
    return CS.rent_type2(_stored_contracts(b), P.start, P.end)


@query("accrued_revenue_stored")
def _accrued_revenue_stored(b):
    """R8 from tables bucketed by contract."""
    return CS.accrued_revenue(_stored_contracts(b), P.start, P.end)


@query("contract_profitability_stored")
def _contract_profitability_stored(b):
    """P1 from tables bucketed by contract."""
    return CS.contract_profitability(_stored_contracts(b), P.start, P.end)


@query("client_profitability")
def _client_profitability(b):
    return PR.client_profitability(
        PR.contract_profitability(rent_tables(b), b.equip_dailycost, P.start, P.end))


@query("client_receipts")
def _client_receipts(b):
    return RC.client_receipts(b.bankstatement, P.ar_code, P.start, P.end)


@query("client_receipts_net")
def _client_receipts_net(b):
    return RC.client_receipts(b.bankstatement, P.ar_code, P.start, P.end, reverse_cancelled=True)


@query("client_opening_bf")
def _client_opening_bf(b):
    return RC.client_opening_bf(b.external_parties, b.ep_bf, P.ar_code)


@query("client_opening_at")
def _client_opening_at(b):
    bf = RC.client_opening_bf(b.external_parties, b.ep_bf, P.ar_code)
    return RC.client_opening_at(bf, b.bankstatement, b.invoice, P.ar_code, P.bf_date, P.start)


@query("client_recovery_by_client")
def _client_recovery_by_client(b):
    return RC.client_recovery_by_client(b.external_parties, b.ep_bf, b.bankstatement, b.invoice,
                                        P.ar_code, P.bf_date, P.start, P.end)


@query("client_clearing")
def _client_clearing(b):
    return RC.client_clearing(b.bankstatement, b.invoice, P.ar_code, P.start, P.end)


# -- ledger (L1-L9) -----------------------------------------------------------
@query("bank_by_account")
def _bank_by_account(b):
    return L.bank_by_account(b.bankstatement, P.bf_date, P.end)


@query("bank_vat")
def _bank_vat(b):
    return L.bank_vat(b.bankstatement, P.bf_date, P.end)


@query("bank_total")
def _bank_total(b):
    return L.bank_total(b.bankstatement, P.bf_date, P.end)


@query("bank_movements")
def _bank_movements(b):
    return L.bank_movements(b.bankstatement, P.bf_date, P.end)


@query("adj_by_account")
def _adj_by_account(b):
    return L.adj_by_account(b.aje, P.bf_date, P.end)


@query("balance_at")
def _balance_at(b):
    return L.balance_at(b.chart_of_accounts, b.bankstatement, b.aje, b.account_bf, P.bf_date, P.end)


@query("pl_for")
def _pl_for(b):
    return L.pl_for(b.chart_of_accounts, b.bankstatement, b.aje, P.start, P.end)


def _rollup(b):
    """A rollup of the rows up to the period's start, then brought up to date
    for the months of the rows after it."""
    path, bank, aje = scratch_path(b.spark, "rollup"), b.bankstatement, b.aje
    before = F.col("date") <= date_lit(P.start)
    RU.refresh_rollup(path, bank.where(before), aje.where(before))
    RU.refresh_rollup(path, bank, aje, [m for t in (bank, aje) for m in RU.months_of(t.where(~before))])
    return RU.read_rollup(b.spark, path)


@query("balance_rollup")
def _balance_rollup(b):
    """L7 at a day inside a month, from a stored rollup by month."""
    return RU.balance_at(_rollup(b), b.chart_of_accounts, b.bankstatement, b.aje, b.account_bf, P.bf_date, ROLLUP_CUT)


@query("pl_rollup")
def _pl_rollup(b):
    """L8 between two days inside months, from a stored rollup by month."""
    return RU.pl_for(_rollup(b), b.chart_of_accounts, b.bankstatement, b.aje, ROLLUP_START, ROLLUP_CUT)


@query("cash_flow")
def _cash_flow(b):
    return L.cash_flow(b.bankstatement, P.start, P.end)


# -- integrity (I1-I6) ---------------------------------------------------------
@query("relocation_negative_rows")
def _relocation_negative_rows(b):
    return I.relocation_negative(b.relocation)


@query("relocation_negative_first")
def _relocation_negative_first(b):
    return I.relocation_negative_first(b.relocation)


@query("bf_reconciliation")
def _bf_reconciliation(b):
    return I.bf_reconciliation(b.ep_bf, b.account_bf)


@query("bank_missing_party")
def _bank_missing_party(b):
    return I.bank_missing_party(b.chart_of_accounts, b.bankstatement)


@query("aje_missing_party")
def _aje_missing_party(b):
    return I.aje_missing_party(b.chart_of_accounts, b.aje)


@query("bank_missing_vat")
def _bank_missing_vat(b):
    return I.bank_missing_vat(b.bankstatement)


@query("integrity_summary")
def _integrity_summary(b):
    return I.integrity_summary(b.relocation, b.ep_bf, b.account_bf, b.chart_of_accounts,
                               b.bankstatement, b.aje)


# -- statements (L10, L11) -----------------------------------------------------

COMPILE_FROM, COMPILE_PERIODS, COMPILE_FREQ = "1996-12-31", 3, "Q"


def report_format(b: Book) -> ST.ReportFormat:
    return ST.ReportFormat(b.report_template, b.report_mapping, b.cf_mapping)


def ledger_tables(b: Book) -> ST.LedgerTables:
    return ST.LedgerTables(b.chart_of_accounts, b.bankstatement, b.aje, b.account_bf)


def _single(kind):
    def fn(b):
        amounts = ST.single_period_amounts(kind, ledger_tables(b), P.bf_date, P.start, P.end)
        return ST.statement(kind, amounts, report_format(b))
    fn.__doc__ = f"L10: {kind} statement of the test period."
    return fn


def _compiled(kind):
    def fn(b):
        return ST.compile_statement(b.spark, kind, ledger_tables(b), report_format(b), P.bf_date,
                                    COMPILE_FROM, COMPILE_PERIODS, COMPILE_FREQ)
    fn.__doc__ = f"L11: {kind} statement for {COMPILE_PERIODS} quarters from {COMPILE_FROM}."
    return fn


for _k in ("FP", "PL", "CF"):
    query(f"statement_{_k.lower()}")(_single(_k))
    query(f"compile_{_k.lower()}")(_compiled(_k))


@query("compile_all")
def _compile_all(b):
    """The three statements in long form from one pass over the ledger tables."""
    return ST.compile_all(b.spark, ledger_tables(b), report_format(b), P.bf_date,
                          COMPILE_FROM, COMPILE_PERIODS, COMPILE_FREQ)


MONTHS = 36


@query("compile_months")
def _compile_months(b):
    """The three statements in long form for 36 months."""
    return ST.compile_all(b.spark, ledger_tables(b), report_format(b), P.bf_date, P.bf_date, MONTHS, "M")


# -- payroll (W1-W5), depreciation (D1-D3) ------------------------------------

PAYROLL_MONTH = (2021, 3)
DEPR_MONTH, DEPR_JANUARY = (2000, 6), (2000, 1)


def _w1(b):
    return W.payroll_month(b.payroll, b.worker_info, *PAYROLL_MONTH)


@query("payroll_month")
def _payroll_month(b):
    return _w1(b)


@query("payroll_regular")
def _payroll_regular(b):
    return W.payroll_regular(_w1(b), *PAYROLL_MONTH)


@query("payroll_associate")
def _payroll_associate(b):
    return W.payroll_associate(_w1(b), *PAYROLL_MONTH)


@query("payroll_external")
def _payroll_external(b):
    return W.payroll_external(_w1(b), *PAYROLL_MONTH)


@query("payroll_journal")
def _payroll_journal(b):
    return W.payroll_journal(b.payroll, b.worker_info, *PAYROLL_MONTH)


@query("ppe_list")
def _ppe_list(b):
    return D.ppe_list(b.ppe_list)


@query("depr_by_user")
def _depr_by_user(b):
    return D.depr_by_user(b.ppe_list, *DEPR_MONTH)


@query("depr_by_user_january")
def _depr_by_user_january(b):
    return D.depr_by_user(b.ppe_list, *DEPR_JANUARY)


@query("depr_journal")
def _depr_journal(b):
    return D.depr_journal(b.ppe_list, b.depr_alloc, *DEPR_MONTH)


@query("depr_journal_all")
def _depr_journal_all(b):
    return D.depr_journal(b.ppe_list, b.depr_alloc, *DEPR_MONTH, distinct=False)


# -- sources and sinks (S1-S7) ---------------------------------------------------


@query("table_read")
def _table_read(b):
    """A whole business table."""
    return b.invoice


@query("filtered_read")
def _filtered_read(b):
    """S3: a table read with a predicate (a Column, pushed to the scan)."""
    return b.bankstatement.where(F.col("ma_account_id") == P.ar_code)


@query("schedule_load")
def _schedule_load(b):
    """Write the schedule of all business tables (CSV with header), check
    and read it back typed; every row of every table, all its cells as text."""
    path = scratch_path(b.spark, "schedule")
    LD.write_schedule({n: b.table(n).select(*T.StructType.fromDDL(SCHEMAS[n]).names) for n in sorted(Book.NAMES)}, path)
    book = LD.load_schedule(b.spark, path)
    return _rows({n: book.table(n) for n in LD.listed_tables(b.spark, path)})


def _as_text(df, column):
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.date_format(F.col(column), "yyyy-MM-dd")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.round(F.col(column) * 100).cast("bigint").cast("string")
    return F.col(column).cast("string")


def _rows(tables):
    """(table_name, c1, c2, cells): the first two columns of every row, and all
    of them joined by |, as text (dates in ISO form, doubles in hundredths, ~ for NULL)."""
    parts = []
    for name in sorted(tables):
        df = tables[name]
        texts = [_as_text(df, c) for c in df.columns]
        parts.append(df.select(F.lit(name).alias("table_name"), *[t.alias(f"c{i + 1}") for i, t in enumerate(texts[:2])],
                               F.concat_ws("|", *[F.coalesce(t, F.lit("~")) for t in texts]).alias("cells")))
    return reduce(DataFrame.unionAll, parts)


@query("report_format")
def _report_format(b):
    """Write the mapping and template files, load and split them:
    (fr, account, code) and the template's lines as (fr line, line_no, name),
    with their source code, direction and subtotal keys as further cells."""
    path = scratch_path(b.spark, "format")
    rm, cm = b.report_mapping, b.cf_mapping
    mapping = rm.select("ma_account_id", "ma_account_name", "fp", "pl", F.lit(None).cast("string").alias("cf")) \
        .unionAll(cm.select(F.col("cf_account_id").cast("string"), F.lit(None).cast("string"),
                            F.lit(None).cast("string"), F.lit(None).cast("string"), "cf"))
    LD.write_table(mapping, f"{path}/FRmapping.csv")
    # one file in line order, without the numbers: the loader finds them again
    LD.write_table(b.report_template.coalesce(1).sortWithinPartitions("fr", "line_no").drop("line_no"), f"{path}/Financial Reports.csv")
    fmt = LD.load_report_format(b.spark, path, label_col="line_name")
    acc, t, none = fmt.account_mapping, fmt.template, F.lit("").alias("cells")
    keys = [f"add{i}{side}" for side in "io" for i in range(4)]
    cells = F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in (F.col("source_code"), _as_text(t, "direction"), *map(F.col, keys))])
    return (acc.where(F.col("fp").isNotNull()).select(F.lit("FP").alias("fr"), F.col("ma_account_id").alias("account"),
                                                       F.col("fp").alias("code"), none)
            .unionAll(acc.where(F.col("pl").isNotNull()).select(F.lit("PL"), "ma_account_id", "pl", none))
            .unionAll(fmt.cf_mapping.select(F.lit("CF"), F.col("cf_account_id").cast("string"), "cf", none))
            .unionAll(t.select(F.concat("fr", F.lit(" line")), F.col("line_no").cast("string"), "line_name", cells)))


@query("code_table_load")
def _code_table_load(b):
    """A two-column code sheet without header replaces its table, typed."""
    path = scratch_path(b.spark, "codes")
    b.equip_type.write.mode("overwrite").option("header", False).csv(f"{path}/sheet")
    return LD.load_code_table(b.spark, f"{path}/sheet", "equip_type_name", "equip_type_id",
                              schema="equip_type_name string, equip_type_id int", target=f"{path}/table")


@query("record_table_load")
def _record_table_load(b):
    """A record sheet whose first row names the columns replaces its table."""
    path = scratch_path(b.spark, "records")
    LD.write_table(b.vq_wholesale, f"{path}/sheet")
    return LD.load_record_table(b.spark, f"{path}/sheet", "qt_id bigint, entry_date date, exit_date date", target=f"{path}/table")


@query("codedef_load")
def _codedef_load(b):
    """Metadata-driven load of code tables and the four record tables
    into a target folder; every loaded row, all its cells as text."""
    path = scratch_path(b.spark, "equipment")
    codes = {"equip_type": b.equip_type, "worker_info": b.worker_info, "cf_mapping": b.cf_mapping}
    defs = b.spark.createDataFrame([(n, *df.columns) for n, df in codes.items()], "t string, c1 string, c2 string")
    defs.write.mode("overwrite").option("header", False).csv(f"{path}/codedefinition")
    for name, df in codes.items():
        df.write.mode("overwrite").option("header", False).csv(f"{path}/{name}")
    records = {"equip_info": b.equip_dailycost, "change_record": b.vq_wholesale, "relocation_record": b.relocation, "mro_record": b.depr_alloc}
    for name, df in records.items():
        LD.write_table(df, f"{path}/{name}")
    types = {n: ", ".join(f"{c} {t}" for c, t in df.dtypes) for n, df in records.items()}
    return _rows(LD.load_equipment_schedule(b.spark, path, types, target=f"{path}/loaded"))


# -- views and dates (S8, S9) ------------------------------------------------------
@query("named_views")
def _named_views(b):
    """Balance sheets at two dates and the P&L between them as named views
    of the caller, put next to each other in SQL."""
    create_views({**balance_views(b, P, "opening", P.start), **balance_views(b, P, "closing", P.end),
                  **pl_views(b, "year", P.start, P.end)}, ["balance_at_opening", "balance_at_closing", "duringyear"])
    return b.spark.sql("""SELECT c.ma_account_id, c.ma_account_name, o.Amount AS opening, d.Amount AS movement, c.Amount AS closing
        FROM balance_at_closing c JOIN balance_at_opening o ON o.ma_account_id = c.ma_account_id
        JOIN duringyear d ON d.ma_account_id = c.ma_account_id""")


@query("table_functions")
def _table_functions(b):
    """The same balances and P&L from SQL table functions with the dates
    as arguments: three periods in one statement."""
    register_functions(b, ["balance_for", "pl_for"])
    return b.spark.sql("""SELECT c.ma_account_id, c.ma_account_name, o.Amount AS opening, d.Amount AS movement, c.Amount AS closing
        FROM balance_for(:bf, :end) c JOIN balance_for(:bf, :start) o ON o.ma_account_id = c.ma_account_id
        JOIN pl_for(:start, :end) d ON d.ma_account_id = c.ma_account_id""", {"bf": P.bf_date, "start": P.start, "end": P.end})


@query("default_dates")
def _default_dates(b):
    """Invoiced revenue with no date, only a start and only an end given;
    what is missing comes from the parameters."""
    r = Reports(b, P)
    asked = {"none": {}, "start": {"start": DEFAULTS_START}, "end": {"end": DEFAULTS_END}}
    parts = [r.invoiced_revenue(**dates).select(F.lit(given).alias("given"), "q_id", "Invoiced_Total") for given, dates in asked.items()]
    return reduce(DataFrame.unionAll, parts)


# one-line descriptions for the queries whose builders have no docstring
DESCRIPTIONS = {
    "machine_days": "R1: machine days to the period start and end per relocation row.",
    "machine_days_summary": "R2: machine days per contract and equipment type.",
    "quotation_split": "R4: quotation lines by pricing type (0 wholesale, 1 per machine-day, 2 per group-day).",
    "rent_type0": "R5: wholesale rent earned in the period.",
    "rent_type1": "R6: per-machine-day rent earned in the period.",
    "rent_type2": "R7: per-machine-group-day rent earned in the period.",
    "accrued_revenue": "R8: rent earned per contract line (set union of R5-R7).",
    "accrued_revenue_all": "R8 keeping equal lines (UNION ALL).",
    "invoiced_revenue": "R10: invoiced price, VAT and total per contract and client.",
    "std_cost_by_machine": "R11: standard machine cost per contract and equipment type.",
    "std_cost_by_contract": "R12: standard machine cost per contract.",
    "contract_profitability": "P1: revenue, standard cost and gross profit per contract.",
    "contract_profitability_by_revenue": "P1 with the contract id of the revenue side.",
    "client_profitability": "P2: revenue, standard cost and gross profit per client.",
    "client_receipts": "P3: receipts on the receivable account per client.",
    "client_receipts_net": "P3 with cancelling rows subtracted.",
    "client_opening_bf": "P4: brought-forward receivable per client.",
    "client_opening_at": "P5: receivable at the period start per client and contract group.",
    "client_recovery_by_client": "P6/P7: opening, invoiced, received and closing per client.",
    "client_clearing": "P8: receipts next to each contract's invoiced total.",
    "bank_by_account": "L1: bank movements per counter-account.",
    "bank_vat": "L2/L3: VAT in and VAT out lines.",
    "bank_total": "L4: bank account line.",
    "bank_movements": "L5: bank, VAT and counter-account lines.",
    "adj_by_account": "L6: adjustments per account.",
    "balance_at": "L7: balance of every chart account at the period end.",
    "pl_for": "L8: movement of every chart account in the period.",
    "cash_flow": "L9: cash movement per cash-flow line.",
    "relocation_negative_rows": "I1: (contract, site, type, date) with a negative running stock.",
    "relocation_negative_first": "I1: first date with a negative stock.",
    "bf_reconciliation": "I2: ledger b/f minus the parties' b/f per control account.",
    "bank_missing_party": "I3: bank rows on control accounts without a party.",
    "aje_missing_party": "I4: adjustments on control accounts without a party.",
    "bank_missing_vat": "I5: bank rows without VAT.",
    "integrity_summary": "I6: number of violations per check.",
    "payroll_month": "W1: the month's payroll rows with a worker record.",
    "payroll_regular": "W2: regular employees' journal lines.",
    "payroll_associate": "W3: associates' employer social security lines.",
    "payroll_external": "W4: external workers' receivable lines and payable total.",
    "payroll_journal": "W5: the month's payroll journal.",
    "ppe_list": "D1: assets with start year and month.",
    "depr_by_user": "D2: the month's depreciation per company and user.",
    "depr_by_user_january": "D2 for a January (previous month in the year before).",
    "depr_journal": "D3: depreciation journal (set union).",
    "depr_journal_all": "D3 keeping equal lines (UNION ALL).",
}
for _name, _text in DESCRIPTIONS.items():
    if not (QUERIES[_name].__doc__ or "").strip():
        QUERIES[_name].__doc__ = _text
