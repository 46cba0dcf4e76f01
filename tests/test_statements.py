"""Template engine (L10), period ends and compile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirebook.operators import statements as ST
from hirebook.params import TEST_PARAMS as P
from hirebook.plans.catalog import ledger_tables, present, report_format
from hirebook.sources.fixtures import REPORT_TEMPLATE_SCHEMA

d = dt.date


def _template(spark, lines):
    full = [(fr, no, name, src, dirn, *adds) for fr, no, name, src, dirn, adds in lines]
    return spark.createDataFrame(full, REPORT_TEMPLATE_SCHEMA)


def test_subtotals_one_hop_all_levels_and_null_codes(spark):
    amounts = spark.createDataFrame(
        [("A1", 10.0), ("A2", 5.0), ("A3", None), ("A4", 100.0)], "ma_account_id string, Amount double")
    mapping = spark.createDataFrame(
        [("A1", "n1", "X", None), ("A2", "n2", "Y", None), ("A3", "n3", "Z", None), ("A4", "n4", None, "P")],
        "ma_account_id string, ma_account_name string, fp string, pl string")
    n = None
    t = _template(spark, [
        # fr, no, name, source, direction, (add0i, add1i, add2i, add3i, add0o, add1o, add2o, add3o)
        ("FP", 1, "x", "X", 1.0, ("T", n, "V", n, n, n, n, n)),
        ("FP", 2, "y", "Y", 1.0, ("T", n, n, "W", n, n, n, n)),
        ("FP", 3, "z", "Z", -1.0, (n, n, n, n, n, n, n, n)),
        ("FP", 4, "total", n, 1.0, (n, "U", n, n, "T", n, n, n)),
        ("FP", 5, "v", n, -1.0, (n, n, n, n, n, n, "V", n)),
        ("FP", 6, "w", "Y", 1.0, (n, n, n, n, n, n, n, "W")),
        ("FP", 7, "u", n, 1.0, (n, n, n, n, n, "U", n, n)),
        ("PL", 1, "p", "P", 1.0, (n, n, n, n, n, n, n, n)),
    ])
    fmt = ST.ReportFormat(t, mapping, spark.createDataFrame([], "cf_account_id bigint, cf string"))
    got = {r["line_name"]: r["Amount"] for r in ST.statement("FP", amounts, fmt).collect()}
    # all-NULL code Z sums to 0; "u" takes the base amount of "total" (0), not its subtotal
    assert got == {"x": 10.0, "y": 5.0, "z": 0.0, "total": 15.0, "v": -10.0, "w": 10.0, "u": 0.0}


@pytest.mark.parametrize("start,n,freq,expect", [
    ("1996-12-31", 3, "Q", [d(1996, 12, 31), d(1997, 3, 31), d(1997, 6, 30), d(1997, 9, 30)]),
    ("2021-01-15", 2, "M", [d(2021, 1, 31), d(2021, 2, 28), d(2021, 3, 31)]),
    ("2021-01-15", 1, "MS", [d(2021, 2, 1), d(2021, 3, 1)]),
    ("2020-06-30", 1, "Y", [d(2020, 12, 31), d(2021, 12, 31)]),
])
def test_period_ends_follow_calendar_rules(start, n, freq, expect):
    assert ST.period_ends(start, n, freq) == expect


def test_period_ends_reject_bad_input():
    with pytest.raises(ValueError):
        ST.period_ends("2021-01-01", 0, "M")
    with pytest.raises(ValueError):
        ST.period_ends("2021-01-01", 2, "H")


def test_daily_periods_get_day_labels(spark, book):
    wide = ST.compile_statement(spark, "PL", ledger_tables(book), report_format(book), P.bf_date,
                                "1997-01-01", 3, "D")
    assert wide.columns == ["line_no", "line_name", "1997-01-02", "1997-01-03", "1997-01-04"]
    assert wide.count() == 3


@pytest.mark.parametrize("kind", ["FP", "PL", "CF"])
def test_compile_equals_single_period_statements(spark, book, kind):
    ends = ST.period_ends("1996-12-31", 3, "Q")
    wide = present(ST.compile_statement(spark, kind, ledger_tables(book), report_format(book), P.bf_date,
                                        "1996-12-31", 3, "Q")).collect()
    pairs = [(None, e) for e in ends] if kind == "FP" else list(zip(ends, ends[1:]))
    for lo, hi in pairs:
        amounts = ST.single_period_amounts(kind, ledger_tables(book), P.bf_date, lo, hi)
        single = {r["line_no"]: r["Amount"] for r in present(ST.statement(kind, amounts, report_format(book))).collect()}
        col = ST.label(hi)
        assert {r["line_no"]: r[col] for r in wide} == single


def test_compile_reports_equal_single_compiles(spark, book):
    fp, pl, cf = ST.compile_reports(spark, ledger_tables(book), report_format(book), P.bf_date, "1996-12-31", 3, "Q")
    for kind, got in zip(("FP", "PL", "CF"), (fp, pl, cf)):
        want = ST.compile_statement(spark, kind, ledger_tables(book), report_format(book), P.bf_date,
                                    "1996-12-31", 3, "Q")
        a, b = present(got), present(want)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, kind
