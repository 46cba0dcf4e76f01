"""Tables by contract: equal to the plain reports, no exchange, bounded buckets, one commit."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hirebook.operators import contract_store as CS
from hirebook.operators import profitability as PR
from hirebook.operators import rental as R
from hirebook.sources.schemas import SCHEMAS
from test_scale import plan_text

START, END = "2021-02-01", "2021-05-01"
LINES = 6  # of a contract


def _tables(spark, times, n=3000, contracts=60, stray=False):
    rnd = random.Random(11)
    kinds = ["A", "B", "C", None]

    def at():
        day = dt.datetime(2021, 1, 1) + dt.timedelta(days=rnd.randrange(160), seconds=rnd.randrange(86400) if times else 0)
        return day if times else day.date()

    moved = []
    for i in range(n):  # contract 1 holds a third
        q = 1 if i % 3 == 0 else rnd.randrange(contracts)
        k = rnd.randrange(4)
        moved.append((None if i % 91 == 0 else q, q * 10 + rnd.randrange(LINES), f"S{i % 2}", k, kinds[k], None if i % 97 == 0 else at(),
                      None if i % 89 == 0 else rnd.randrange(5), rnd.choice([1, -1, None])))
    moved = [m if m[0] is not None else (None, 9002, *m[2:]) for m in moved]
    if stray:
        moved.append((2, 10 * 7 + 2, "S", 0, "A", at(), 1, 1))
    lines = [(q, q * 10 + x, q % 7 if q % 5 else None, f"party {q % 7}", x % 3, x % 4, rnd.choice([0, 3, None]), rnd.choice([7.25, 100.0, None]))
             for q in range(contracts) for x in range(LINES) if q % 11]
    # a line of each type without a contract, the last one moved so too
    lines += [(None, 9000 + x, 3, "party 3", x, 0, 2, 8.0) for x in range(3)]
    moved += [(None, 9002, "S", 0, "A", at(), 3, 1), (None, 9002, "S", 9, "Z", at(), 2, 1)]
    if stray:
        lines.append((7, 72, 1, "party", 2, 1, 2, 5.0))
    lines += lines[:4]  # repeated rows
    sizes = [(r[1], rnd.randrange(3)) for r in lines for _ in range(2)]
    stays = [(r[1], dt.date(2021, 1, 20), dt.date(2021, 1, 20) + dt.timedelta(days=rnd.randrange(90))) for r in lines if r[1] % 4]
    date = SCHEMAS["relocation"] if times else SCHEMAS["relocation"].replace("date timestamp", "date date")
    t = R.RentTables(spark.createDataFrame(moved, date), spark.createDataFrame(lines, SCHEMAS["vq"]),
                     spark.createDataFrame(sizes, SCHEMAS["vq_equip"]), spark.createDataFrame(stays, SCHEMAS["vq_wholesale"]))
    cost = spark.createDataFrame([("A", 1.37), ("B", 0.11), ("B", 2.0), ("Z", 9.0)], SCHEMAS["equip_dailycost"])
    return t, cost


def _rows(df, digits=None):
    def cell(v):
        return round(v, digits) + 0.0 if digits is not None and isinstance(v, float) else v
    return sorted((tuple(cell(v) for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("times", [False, True])
def test_equal_to_the_plain_reports(spark, tmp_path, times):
    t, cost = _tables(spark, times)
    CS.write_contract_store(str(tmp_path / "it's"), t, cost, buckets=5)
    s = CS.read_contract_store(spark, str(tmp_path / "it's"))
    digits = 5 if times else None  # plain dates: to the bit
    for signed in (False, True):
        plain = R.machine_days_summary(R.machine_days(t.relocation, START, END, signed))
        assert CS.machine_days_summary(s, START, END, signed).dtypes == plain.dtypes
        assert _rows(CS.machine_days_summary(s, START, END, signed), digits) == _rows(plain, digits)
    plain = R.machine_days_summary(R.machine_days(t.relocation, START, END))
    pairs = [(CS.rent_type0(s, START, END), R.rent_type0(t.vq, t.vq_wholesale, START, END)),
             (CS.rent_type1(s, START, END), R.rent_type1(t.vq, plain)),
             (CS.rent_type2(s, START, END), R.rent_type2(t.vq, t.vq_equip, plain)),
             (CS.accrued_revenue(s, START, END), R.accrued_revenue(t, START, END)),
             (CS.accrued_revenue(s, START, END, distinct=False), R.accrued_revenue(t, START, END, distinct=False)),
             (CS.std_cost_by_contract(s, START, END), R.std_cost_by_contract(t.relocation, cost, START, END)),
             *[(CS.contract_profitability(s, START, END, by), PR.contract_profitability(t, cost, START, END, by)) for by in (True, False)]]
    for got, want in pairs:
        want_rows = _rows(want, digits)
        assert got.columns == want.columns and want_rows
        assert _rows(got, digits) == want_rows


def test_no_exchange_above_any_scan(spark, tmp_path):
    t, cost = _tables(spark, True, n=300)
    CS.write_contract_store(str(tmp_path), t, cost, buckets=4)
    s = CS.read_contract_store(spark, str(tmp_path))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", **CS.CONF}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        reports = (CS.machine_days_summary, CS.rent_type0, CS.rent_type1, CS.rent_type2, CS.accrued_revenue, CS.std_cost_by_contract,
                   CS.contract_profitability)
        for report in reports:
            text = plan_text(report(s, START, END))
            assert "Exchange" not in text and "Bucketed: false" not in text and "Bucketed: true" in text, text
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_hot_contract_is_bounded_by_days_lines_and_types(spark):
    t, _ = _tables(spark, True, n=20_000, contracts=3)
    stored = CS.movement_days(t.relocation)
    hot = t.relocation.where("q_id = 1")
    bound = hot.select("qt_id", "equip_type_name", "direction", F.to_date("date")).distinct().count()
    assert stored.where("q_id = 1").count() == bound < hot.count()


def test_what_is_refused(spark, tmp_path):
    t, cost = _tables(spark, False, n=200, stray=True)
    with pytest.raises(ValueError, match="line 72"):
        CS.write_contract_store(str(tmp_path / "a"), t, cost, buckets=2)
    with pytest.raises(ValueError, match="no contract store"):
        CS.read_contract_store(spark, str(tmp_path / "a"))
    t, cost = _tables(spark, False, n=200)
    with pytest.raises(ValueError, match="missing contract"):
        CS.write_contract_store(str(tmp_path / "a"), R.RentTables(t.relocation.withColumn("q_id", F.lit(CS.NONE)), t.vq, t.vq_equip, t.vq_wholesale), cost)
    CS.write_contract_store(str(tmp_path / "b"), t, cost, buckets=2)
    with pytest.raises(ValueError, match="cuts"):
        CS.machine_days_summary(CS.read_contract_store(spark, str(tmp_path / "b")), "2021-02-01 10:00:00", END)


def test_a_new_store_is_one_commit_and_other_sessions_read_it(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    t, cost = _tables(spark, False, n=400)
    CS.write_contract_store(path, t, cost, buckets=3)
    old = _rows(CS.std_cost_by_contract(CS.read_contract_store(spark, path), START, END))
    write = CS._write

    def dies(df, root, table, buckets):
        if table == "stays":
            raise RuntimeError("executor lost")
        write(df, root, table, buckets)

    monkeypatch.setattr(CS, "_write", dies)
    more = R.RentTables(t.relocation.unionAll(t.relocation), t.vq, t.vq_equip, t.vq_wholesale)
    with pytest.raises(RuntimeError):
        CS.write_contract_store(path, more, cost, buckets=3)
    assert _rows(CS.std_cost_by_contract(CS.read_contract_store(spark, path), START, END)) == old
    monkeypatch.undo()
    CS.write_contract_store(path, more, cost, buckets=6)
    new = _rows(CS.std_cost_by_contract(CS.read_contract_store(spark, path), START, END))
    assert new != old and new == _rows(R.std_cost_by_contract(more.relocation, cost, START, END))
    monkeypatch.setattr(CS, "_table", lambda p: "another_session_" + str(abs(hash(p))))  # a catalog without the tables
    again = CS.read_contract_store(spark, path)
    assert _rows(CS.std_cost_by_contract(again, START, END)) == new
    assert "Bucketed: true" in plan_text(CS.machine_days_summary(again, START, END))


def test_empty_tables(spark, tmp_path):
    t, cost = _tables(spark, True, n=10)
    none = R.RentTables(*(x.where("false") for x in (t.relocation, t.vq, t.vq_equip, t.vq_wholesale)))
    CS.write_contract_store(str(tmp_path), none, cost.where("false"), buckets=2)
    assert CS.contract_profitability(CS.read_contract_store(spark, str(tmp_path)), START, END).collect() == []


def test_no_exchange_in_a_session_without_conf(spark, tmp_path):
    t, cost = _tables(spark, True, n=300)
    CS.write_contract_store(str(tmp_path), t, cost, buckets=4)
    s = CS.read_contract_store(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (CS.rent_type0, CS.rent_type1, CS.rent_type2, CS.accrued_revenue, CS.std_cost_by_contract, CS.contract_profitability):
            assert "Exchange" not in plan_text(report(s, START, END)), report.__name__
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_and_stays_that_repeat_or_are_missing_keep_their_rows(spark, tmp_path):
    day = dt.date
    t = R.RentTables(spark.createDataFrame([(1, 11, "S", 4, "A", day(2021, 1, 1), 2, 1), (1, 11, "S", 4, "B", day(2021, 1, 1), 3, 1)],
                                           SCHEMAS["relocation"].replace("date timestamp", "date date")),
                     spark.createDataFrame([(1, 10, 1, "p", 0, 4, 1, 9.0), (1, 10, 1, "p", 0, 4, 1, 9.0), (1, 11, 1, "p", 1, 4, 0, 9.0), (1, 12, 1, "p", 1, 4, 2, 9.0),
                                            (1, None, 1, "p", 0, 4, 1, 9.0), (1, 14, 1, "p", 0, 4, 1, 9.0), (1, 11, 1, "p", 2, 4, 1, 9.0), (1, 15, 1, "p", None, 4, 1, 9.0)], SCHEMAS["vq"]),
                     spark.createDataFrame([(11, 2), (11, 1), (None, 5)], SCHEMAS["vq_equip"]),
                     spark.createDataFrame([(10, day(2021, 2, 1), day(2021, 4, 1)), (10, day(2021, 2, 1), day(2021, 4, 1)), (None, day(2021, 2, 1), day(2021, 4, 1)),
                                            (14, day(2021, 2, 1), day(2021, 2, 1))], SCHEMAS["vq_wholesale"]))
    cost = spark.createDataFrame([("A", 1.0), ("A", 2.0)], SCHEMAS["equip_dailycost"])
    CS.write_contract_store(str(tmp_path), t, cost, buckets=2)
    s = CS.read_contract_store(spark, str(tmp_path))
    summary = R.machine_days_summary(R.machine_days(t.relocation, START, END))
    assert _rows(CS.rent_type0(s, START, END)) == _rows(R.rent_type0(t.vq, t.vq_wholesale, START, END))
    assert _rows(CS.rent_type1(s, START, END)) == _rows(R.rent_type1(t.vq, summary))
    assert _rows(CS.rent_type2(s, START, END)) == _rows(R.rent_type2(t.vq, t.vq_equip, summary))
    assert _rows(CS.accrued_revenue(s, START, END, distinct=False)) == _rows(R.accrued_revenue(t, START, END, distinct=False))
    assert _rows(CS.contract_profitability(s, START, END)) == _rows(PR.contract_profitability(t, cost, START, END))
