"""Payroll journal of one month.

Workers split three ways by ``social_security_recoverable``: NULL regular
employees, 1 external (social security paid for a third party and
recoverable), any other value associates. All fixed lines come from one
global aggregate with conditional sums (partial sums per task); the
external block adds one debit line per worker, a plain projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.functions.expr import exact_sum
from hirebook.session import keep

RECOVERABLE = "social_security_recoverable"
MEASURES = ("total_salary", "individual_income_tax", "social_security_employee",
            "house_tax", "social_security_employer")

# Journal lines and accounts of the payroll reports, in order.
# (line_no, line, side, account); amounts are filled in below.
REGULAR_LINES = [
    (1, "total_salary", "DR", "MA560207"),
    (2, "individual_income_tax", "DR", "MA221101"),
    (3, "social_security_employee", "DR", "MA221101"),
    (4, "house_tax", "DR", "MA221101"),
    (5, "social_security_employer", "DR", "MA560216"),
    (6, "total_salary bal", "CR", "MA221101"),
    (7, "Deductions", "CR", "MA2242"),
    (8, "ss_empolyer", "CR", "MA221104"),
]
ASSOCIATE_LINES = [
    (9, "Social security paid for rp", "DR", "MA560234"),
    (10, "Social security paid for rp", "CR", "MA221104"),
]
EXTERNAL_LINES = [
    (11, "Social security paid for external", "DR", "MA1222"),
    (12, "Social security paid for external", "CR", "MA221104"),
]

LINE_COLS = ["line_no", "line", "worker_id", "DR", "CR", "ma_account_id", "date"]


def month_label(year: int, month: int) -> str:
    return f"{int(year):04d}/{int(month):02d}"


def payroll_month(payroll: DataFrame, worker_info: DataFrame, year: int, month: int) -> DataFrame:
    """The month's payroll rows of workers that have a worker record."""
    p = payroll.where((F.col("year") == year) & (F.col("month") == month)).select(
        F.col("worker_id").alias("left_worker_id"), *MEASURES, RECOVERABLE)
    w = worker_info.select(F.col("worker_id").alias("right_worker_id"), "department")
    return p.join(w, F.col("left_worker_id") == F.col("right_worker_id"), "inner")


def _lines(totals: DataFrame, spec, amounts: dict[int, F.Column], year, month) -> DataFrame:
    zero = F.lit(0.0)
    structs = []
    for no, name, side, acct in spec:
        amt = amounts[no]
        structs.append(F.struct(
            F.lit(no).alias("line_no"), F.lit(name).alias("line"), F.lit(0).cast("bigint").alias("worker_id"),
            (amt if side == "DR" else zero).alias("DR"), (amt if side == "CR" else zero).alias("CR"),
            F.lit(acct).alias("ma_account_id"), F.lit(month_label(year, month)).alias("date")))
    return totals.select(F.inline(F.array(*structs)))


def _sum0(c, name: str) -> F.Column:
    return F.coalesce(exact_sum(c), F.lit(0.0)).alias(name)


def month_totals(month_rows: DataFrame) -> DataFrame:
    """One global aggregate with every total the fixed lines need.

    Regular: flag NULL and a department (rows without one drop out, as in
    a per-department sum); associates: flag set and not 1; external: 1.
    Sums of nothing are 0.
    """
    flag = F.col(RECOVERABLE)
    regular = flag.isNull() & F.col("department").isNotNull()
    ser = F.col("social_security_employer")
    return month_rows.agg(*[_sum0(F.when(regular, F.col(m)), m) for m in MEASURES],
                          _sum0(F.when(flag != 1, ser), "associate_ser"),
                          _sum0(F.when(flag == 1, ser), "external_ser"))


def _regular_amounts() -> dict[int, F.Column]:
    c = {m: F.col(m) for m in MEASURES}
    return {1: c["total_salary"], 2: c["individual_income_tax"], 3: c["social_security_employee"],
            4: c["house_tax"], 5: c["social_security_employer"], 6: c["total_salary"],
            7: c["individual_income_tax"] + c["social_security_employee"] + c["house_tax"],
            8: c["social_security_employer"]}


def _associate_amounts() -> dict[int, F.Column]:
    return {9: F.col("associate_ser"), 10: F.col("associate_ser")}


def _external_total() -> dict[int, F.Column]:
    return {12: F.col("external_ser")}


def payroll_regular(month_rows: DataFrame, year: int, month: int) -> DataFrame:
    """Regular employees with a department: five debit lines and the
    three credits (net salary payable, deductions, employer social
    security)."""
    return _lines(month_totals(month_rows), REGULAR_LINES, _regular_amounts(), year, month)


def payroll_associate(month_rows: DataFrame, year: int, month: int) -> DataFrame:
    """Employer social security of associates (flag set, not 1)."""
    return _lines(month_totals(month_rows), ASSOCIATE_LINES, _associate_amounts(), year, month)


def _external_workers(month_rows: DataFrame, year: int, month: int) -> DataFrame:
    no, name, _, acct = EXTERNAL_LINES[0]
    return month_rows.where(F.col(RECOVERABLE) == 1).select(
        F.lit(no).alias("line_no"), F.lit(name).alias("line"),
        F.col("left_worker_id").cast("bigint").alias("worker_id"),
        F.coalesce(F.col("social_security_employer"), F.lit(0.0)).alias("DR"), F.lit(0.0).alias("CR"),
        F.lit(acct).alias("ma_account_id"), F.lit(month_label(year, month)).alias("date"))


def payroll_external(month_rows: DataFrame, year: int, month: int) -> DataFrame:
    """One receivable debit per external worker, one payable credit. The
    month's rows are shared (``session.keep``), so they are read once."""
    month_rows = keep(month_rows)
    total = _lines(month_totals(month_rows), EXTERNAL_LINES[1:], _external_total(), year, month)
    return _external_workers(month_rows, year, month).unionByName(total)


def payroll_journal(payroll: DataFrame, worker_info: DataFrame, year: int, month: int) -> DataFrame:
    """The month's journal, all lines with ``line_no`` (sort by
    ``line_no, worker_id``); it balances for any number of workers. The
    month's rows are shared (``session.keep``), so they are read once."""
    m = keep(payroll_month(payroll, worker_info, year, month))
    amounts = {**_regular_amounts(), **_associate_amounts(), **_external_total()}
    fixed = _lines(month_totals(m), REGULAR_LINES + ASSOCIATE_LINES + EXTERNAL_LINES[1:], amounts, year, month)
    return fixed.unionByName(_external_workers(m, year, month)).select(LINE_COLS)
