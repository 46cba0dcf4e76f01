"""Plan-shape guards and a skewed fixture checked against brute force."""

import contextlib
import datetime as dt
import io
import random

import pandas as pd
import pytest

from conftest import SF_SMALL
from hirebook.operators import integrity as I
from hirebook.operators import rental as R
from hirebook.plans.catalog import QUERIES
from hirebook.sources.schemas import SCHEMAS


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_nested_loop_python_or_unreduced_single_partition(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "EvalPython" not in text                      # no Python UDFs in any plan
    lines = text.splitlines()
    for line in lines:                                   # no window over the whole input
        if "+- Window [" in line or line.startswith("Window ["):
            assert "], [], [" not in line, line
    for i, line in enumerate(lines):                     # one task only ever gets partial results
        if "Exchange SinglePartition" in line:
            assert "partial_" in lines[i + 1], line


def test_aggregates_are_partial_before_shuffle(spark, book):
    md = R.machine_days_summary(R.machine_days(book.relocation, "1996-12-31", "1997-12-31"))
    text = plan_text(md)
    first_exchange = text.index("Exchange hashpartitioning")
    assert "partial_sum" in text[first_exchange:]   # below the exchange in the printed tree


@pytest.fixture(scope="module")
def skewed(spark):
    """One contract holds a third of all movements (plus many small ones)."""
    rnd = random.Random(7)
    rows = []
    day0 = dt.date(2021, 1, 1)
    for i in range(3000):
        hot = i % 3 == 0
        q = 1 if hot else 2 + rnd.randrange(400)
        site = f"S{rnd.randrange(2)}"
        t = rnd.choice(["A", "B"])
        rows.append((q, q * 10, site, 1 if t == "A" else 2, t, dt.datetime.combine(day0 + dt.timedelta(days=rnd.randrange(120)), dt.time()),
                     rnd.randrange(1, 5), rnd.choice([1, 1, -1])))
    return rows


def test_skewed_machine_days_match_bruteforce(spark, skewed):
    df = spark.createDataFrame(skewed, SCHEMAS["relocation"])
    start, end = dt.date(2021, 2, 1), dt.date(2021, 4, 1)
    got = {(r["q_id"], r["equip_type_name"]): r[R.PERIOD_DAYS]
           for r in R.machine_days_summary(R.machine_days(df, start, end)).collect()}
    p = pd.DataFrame(skewed, columns=[c.split()[0] for c in SCHEMAS["relocation"].split(", ")])
    p["date"] = p["date"].map(lambda x: x.date())
    p["bf"] = p["date"].map(lambda x: max((start - x).days, 0)) * p["quantity"]
    p["cf"] = p["date"].map(lambda x: max((end - x).days, 0)) * p["quantity"]
    want = p.groupby(["q_id", "equip_type_name"]).apply(lambda g: g["cf"].sum() - g["bf"].sum(),
                                                       include_groups=False).to_dict()
    assert got == want


def test_skewed_running_stock_matches_bruteforce(spark, skewed):
    df = spark.createDataFrame(skewed, SCHEMAS["relocation"])
    got = {(r["q_id"], r["site_name"], r["equip_type_name"], r["date"]): r["stock"]
           for r in I.relocation_negative(df).collect()}
    p = pd.DataFrame(skewed, columns=[c.split()[0] for c in SCHEMAS["relocation"].split(", ")])
    p["d"] = p["quantity"] * p["direction"]
    want = {}
    for key, g in p.groupby(["q_id", "site_name", "equip_type_name"]):
        daily = g.groupby("date")["d"].sum().sort_index().cumsum()
        for day, stock in daily.items():
            if stock < 0:
                want[(*key, day)] = stock
    assert got == want and len(want) > 0
    first = I.relocation_negative_first(df).collect()[0][0]
    assert first == min(k[3] for k in want)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_first_aggregate_over_the_data_is_hash_based(spark, name):
    """min() of a string would make an aggregate sort-based; the big first
    aggregate must stay a hash aggregate (the name is grouped first)."""
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    aggs = [m for m in ("HashAggregate(", "SortAggregate(", "ObjectHashAggregate(") if m in text]
    if not aggs:
        return
    last = max(("HashAggregate(", "SortAggregate(", "ObjectHashAggregate("), key=lambda m: text.rfind(m))
    assert last != "SortAggregate(", text


# -- what a plan must have: pruned scans, few exchanges, nothing run or written early
def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["compile_fp", "compile_pl", "compile_cf", "compile_months", "balance_at", "pl_for", "cash_flow"])
def test_date_range_reaches_the_scans(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    scans = [x for x in text.splitlines() if "FileScan parquet" in x and ("amount" in x or "debit" in x) and "date#" in x]
    assert scans
    for x in scans:
        pushed = x[x.index("PushedFilters"):]
        assert "GreaterThan(date," in pushed and "LessThanOrEqual(date," in pushed, x


@pytest.mark.parametrize("name,most", [("bank_vat", 1), ("bank_total", 1)])
def test_totals_take_one_exchange(spark, name, most):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert text.count("Exchange") == most and "SinglePartition" in text


def test_building_reports_runs_and_writes_nothing(spark, book, tmp_path):
    import os

    from hirebook.params import TEST_PARAMS
    from hirebook.plans.catalog import ledger_tables, rent_tables, report_format
    from hirebook.operators import profitability as PR
    from hirebook.operators import statements as ST
    from hirebook.plans.views import register_views
    from hirebook.session import ensure_checkpoint_dir

    tables = ledger_tables(book), report_format(book), rent_tables(book)
    for name in book.NAMES:  # Spark reads the sources' footers once
        book.table(name).schema
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {d for d, _, _ in os.walk(root)}
    spark.sparkContext.setJobGroup("plan-only", "no job may start here")
    P = TEST_PARAMS
    PR.client_profitability(PR.contract_profitability(tables[2], book.equip_dailycost, P.start, P.end)).schema
    R.accrued_revenue(tables[2], P.start, P.end).schema
    ST.compile_all(spark, *tables[:2], P.bf_date, "1996-12-31", 3, "Q").schema
    register_views(book, P)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {d for d, _, _ in os.walk(root)} == before
    spark.catalog.clearCache()


def test_thousand_days_stay_linear(spark, book):
    from hirebook.operators import statements as ST

    ends = ST.period_ends("1994-01-01", 1000, "D")
    plan = ST.CompilePlan.build("1993-12-31", ends)
    assert len(plan.boundaries) == 1002 and len(ends) == 1001
    # one small literal array a kind, no table of (period, bucket) pairs
    days = spark.createDataFrame([(e,) for e in ends[::97]], "date date").select("date", plan.bucket(R.F.col("date")).alias("b"))
    assert [(r["date"], r["b"]) for r in days.collect()] == [(e, i * 97 + 1) for i, e in enumerate(ends[::97])]


def test_a_client_with_most_contracts_comes_first_in_the_join(spark):
    from hirebook.operators import recovery as RC

    rows = [(i, 1 if i % 3 else 2, dt.datetime(1996, 5, 1), 1.0, 0.0, 1.0) for i in range(3000)]
    inv = spark.createDataFrame(rows, SCHEMAS["invoice"])
    bank = spark.createDataFrame([], SCHEMAS["bankstatement"])
    bf = spark.createDataFrame([(1, 10.0), (2, None), (3, 5.0)], "ep_id bigint, amount double")
    out = RC.client_opening_at(bf, bank, inv, "MA1122", "1995-12-31", "1996-12-31")
    got = out.groupBy("ep_id").agg(R.F.count("*"), R.F.sum("cutdateamount")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2000, 22000.0), (2, 1000, 1000.0), (3, 1, 5.0)]


def test_several_names_do_not_multiply_contracts(spark):
    from hirebook.operators import recovery as RC

    day = dt.datetime(1997, 3, 1)
    bank = spark.createDataFrame([(day, "MA1122", "AR", 1, n, 5.0, 0.0, None, 1, 1) for n in ("b", "a", "c")], SCHEMAS["bankstatement"])
    inv = spark.createDataFrame([(q, 1, day, 1.0, 0.0, 1.0) for q in range(4)], SCHEMAS["invoice"])
    got = RC.client_clearing(bank, inv, "MA1122", "1996-12-31", "1997-12-31").collect()
    assert [tuple(r) for r in got] == [(1, "a", 15.0, 1.0)] * 4


def test_running_stock_is_windowed_by_day(spark):
    """A group with a third of all movements at distinct seconds: the rows of
    a plain running sum, and no window over the group's instants."""
    rnd = random.Random(3)
    start = dt.datetime(2021, 1, 1)
    rows = []
    for i in range(6000):
        q = 1 if i % 3 == 0 else 2 + rnd.randrange(300)
        at = start + dt.timedelta(seconds=i * 50 if q == 1 else rnd.randrange(40 * 86400))
        rows.append((q, q, "S", 1, "A", at, rnd.randrange(1, 5), rnd.choice([1, -1])))
    rows += [(1, 1, "S", 1, "A", start + dt.timedelta(seconds=50), 2, -1), (1, 1, None, 1, "A", start, 1, 1), (1, 1, "S", 1, "A", None, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMAS["relocation"]).repartition(7)
    want, net = {}, {}
    for q, _, site, _, kind, at, n, sign in rows:
        if site and at:
            net[q, at] = net.get((q, at), 0) + n * sign
    for q in {k[0] for k in net}:
        stock = 0
        for at in sorted(a for g, a in net if g == q):
            stock += net[q, at]
            want[q, at] = stock
    got = I.relocation_stock(df)
    assert {(r["q_id"], r["date"]): r["stock"] for r in got.collect()} == want and got.count() == len(want)
    assert {(r["q_id"], r["date"]) for r in I.relocation_negative(df).collect()} == {k for k, v in want.items() if v < 0}
    windows = [x for x in plan_text(I.relocation_stock(df)).splitlines() if "Window [" in x]
    assert len(windows) == 2
    for x in windows:
        by, order = x.rsplit("], [", 2)[1:]
        assert ("day#" in by) == ("date#" in order), x  # instants only within a day
    days = df.where("q_id = 1 and site_name is not null and date is not null").groupBy(R.F.to_date("date")).count()
    assert days.agg(R.F.max("count")).first()[0] <= 86400 // 50 + 1 < 2000


@pytest.mark.parametrize("name,most", [("bank_movements", 1), ("balance_at", 1), ("pl_for", 1), ("statement_fp", 1), ("statement_pl", 1)])
def test_the_bank_table_is_scanned_once(spark, name, most):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert sum("FileScan parquet" in x and "vat" in x for x in text.splitlines()) == most, text


def test_the_integrity_summary_scans_the_bank_once(spark):
    scans = [x for x in plan_text(QUERIES["integrity_summary"](spark, SF_SMALL)).splitlines() if "FileScan parquet" in x and "ep_id#" in x]
    assert sum("vat#" in x for x in scans) == 1 and len(scans) == 2, scans  # the bank table and the adjustments


@pytest.mark.parametrize("name", ["payroll_external", "payroll_journal", "client_opening_at"])
def test_shared_rows_are_computed_once_and_released(spark, name):
    from hirebook.session import release

    df = QUERIES[name](spark, SF_SMALL)
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = held().size()
    df.collect()
    assert held().size() > before and plan_text(df).count("InMemoryTableScan") >= 2
    assert release() > 0 and held().size() == before


def test_sums_have_the_same_bits_whatever_the_partitioning(spark, book):
    from hirebook.operators import ledger as L
    from hirebook.operators import profitability as PR
    from hirebook.plans.catalog import ledger_tables, rent_tables

    t, rent = ledger_tables(book), rent_tables(book)
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    thirds = R.F.col("amount") / 3  # no round cents
    for n in (3, 8, 200):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        bank = t.bank.withColumn("amount", thirds).repartition(n)
        cost = book.equip_dailycost.withColumn("cost_day_std", R.F.col("cost_day_std") / 7)
        seen.append([sorted(tuple(r) for r in df.na.fill("").collect()) for df in (
            L.bank_movements(bank, "1995-12-31", "1997-12-31"), L.balance_at(t.chart, bank, t.aje.repartition(n), t.account_bf, "1995-12-31", "1997-12-31"),
            PR.contract_profitability(rent, cost, "1996-12-31", "1997-12-31").na.fill(0),
            R.accrued_revenue(rent, "1996-12-31", "1997-12-31").na.fill(0))])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and all(seen[0])


def test_exact_sum_against_fractions(spark):
    from fractions import Fraction

    from hirebook.functions.expr import exact_sum

    rnd = random.Random(5)
    x = [round(rnd.uniform(-1e6, 1e6), 2) for _ in range(5000)] + [0.1] * 1000 + [1e12 + 0.25, -1e12, None]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(x)], "k int, v double").repartition(9)
    for k, got in df.groupBy("k").agg(exact_sum("v")).collect():
        want = sum(Fraction(str(v)) for i, v in enumerate(x) if i % 3 == k and v is not None)
        assert got == pytest.approx(float(want), abs=1e-8)
    edge = spark.createDataFrame([(1, 1e300), (1, 2.5), (2, None), (3, float("nan")), (3, 1.0), (4, float("-inf")), (5, -0.004), (5, -0.006)], "k int, v double")
    out = {r[0]: r[1] for r in edge.groupBy("k").agg(exact_sum("v")).collect()}
    assert out[1] == 1e300 and out[2] is None and out[3] != out[3] and out[4] == float("-inf") and out[5] == -0.01
