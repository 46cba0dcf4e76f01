"""Loaders (S1, S4-S7) on small hand-written files."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from hirebook.sources import loaders as LD


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_schedule_keeps_time_of_day_and_every_bad_cell(spark, tmp_path):
    head = "q_id,qt_id,site_name,equip_type_id,equip_type_name,date,quantity,direction\n"
    _write(tmp_path / "relocation" / "part.csv", head + "1,10,S0,1,A,2021-01-05 10:30:00,2,1\n2,20,,1,A,,1,1\n3,30,S1,1,A,2021-01-06,1,1\n")
    book = LD.load_schedule(spark, str(tmp_path), ["relocation"])
    got = sorted((r["q_id"], r["date"], r["site_name"]) for r in book.relocation.collect() if r["date"])
    assert got == [(1, dt.datetime(2021, 1, 5, 10, 30), "S0"), (3, dt.datetime(2021, 1, 6), "S1")]
    assert book.relocation.where("date is null and site_name is null").count() == 1   # blank cells
    _write(tmp_path / "relocation" / "bad.csv", head + '4,40,S0,1,A,2021-01-06,"1,000",1\n5,50,S0,1,A,someday,1,1\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        LD.load_schedule(spark, str(tmp_path), ["relocation"], check=False).relocation.collect()
    with pytest.raises(ValueError, match="relocation.date: 1, e.g. 'someday'; relocation.quantity: 1, e.g. '1,000'"):
        LD.load_schedule(spark, str(tmp_path), ["relocation"])
    kept = LD.load_schedule(spark, str(tmp_path), ["relocation"], bad="keep").relocation
    assert kept.count() == 5
    bad = LD.corrupt_rows(kept).collect()
    assert sorted(r[LD.CORRUPT][:2] for r in bad) == ["4,", "5,"]


def test_fractions_of_a_day_count_in_machine_days_and_bounds(spark):
    from hirebook.functions.expr import in_period
    from hirebook.operators import rental as R
    from hirebook.sources.schemas import SCHEMAS
    day = dt.datetime
    df = spark.createDataFrame([(1, 1, "S", 1, "A", day(2021, 1, 1, 18), 2, 1), (2, 2, "S", 1, "A", day(2021, 1, 11, 10), 1, 1),
                                (3, 3, "S", 1, "A", day(2021, 1, 1, 10), 1, 1)], SCHEMAS["relocation"])
    got = {r["q_id"]: r[R.CF_COL] for r in R.machine_days(df, "2021-01-01", "2021-01-11").collect()}
    assert got == {1: 2 * 9.25, 2: 0.0, 3: 9 + 14 / 24}
    # 10:00 on the first day is inside, 10:00 on the last is not; a bound's own time counts
    assert sorted(r["q_id"] for r in df.where(in_period("date", "2021-01-01", "2021-01-11")).collect()) == [1, 3]
    assert sorted(r["q_id"] for r in df.where(in_period("date", "2021-01-01 12:00", "2021-01-11 10:00:00")).collect()) == [1, 2]


def test_bounds_are_not_cut():
    from hirebook.params import as_bound
    assert as_bound("2021-01-05") == dt.date(2021, 1, 5) and as_bound("2021-01-05 00:00:00") == dt.date(2021, 1, 5)
    assert as_bound("2021-01-05T10:30") == dt.datetime(2021, 1, 5, 10, 30)
    with pytest.raises(ValueError):
        as_bound("2021-01-05 and more")


def test_integer_division_is_exact(spark):
    from hirebook.functions.expr import ratio
    df = spark.createDataFrame([(9007199254740993, 1), (9223372036854775807, 3), (-7, 2), (5, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(ratio(df, "a", "b", True)).collect()] == [9007199254740993, 3074457345618258602, -3, None]


def test_a_smaller_schedule_hides_stale_tables(spark, tmp_path, book):
    LD.write_schedule({"equip_type": book.equip_type, "worker_info": book.worker_info}, str(tmp_path))
    LD.write_schedule({"equip_type": book.equip_type, "extra": book.ep_bf}, str(tmp_path))
    assert LD.listed_tables(spark, str(tmp_path)) == ["equip_type", "extra"]
    back = LD.load_schedule(spark, str(tmp_path))
    assert "worker_info" not in back.__dict__ and back.table("extra").count() == book.ep_bf.count()


def test_a_write_that_dies_leaves_the_old_schedule_whole(spark, tmp_path, book):
    root = str(tmp_path)
    first = LD.write_schedule({"equip_type": book.equip_type, "worker_info": book.worker_info}, root)
    broken = book.equip_type.select("equip_type_name", R_error())
    with pytest.raises(Exception, match="half way"):
        LD.write_schedule({"equip_type": book.equip_type.limit(1), "vq_equip": book.vq_equip, "worker_info": broken}, root)
    back = LD.load_schedule(spark, root)
    assert LD.current_snapshot(spark, root) == (f"{root}/{first}", ["equip_type", "worker_info"])
    assert back.equip_type.count() == book.equip_type.count() and back.worker_info.count() == book.worker_info.count()
    second = LD.write_schedule({"equip_type": book.equip_type.limit(1)}, root)
    assert back.equip_type.count() == book.equip_type.count()  # an open reader keeps its snapshot
    assert LD.load_schedule(spark, root).equip_type.count() == 1
    third = LD.write_schedule({"equip_type": book.equip_type.limit(2)}, root)
    gone = LD.prune_snapshots(spark, root, keep=2)
    assert len(gone) == 2 and first in gone and not {second, third} & set(gone)
    assert LD.load_schedule(spark, root).equip_type.count() == 2 and LD.prune_snapshots(spark, root) == []


def R_error():
    from pyspark.sql import functions as F
    return F.raise_error(F.lit("half way")).cast("int").alias("x")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_every_bad_cell_is_reported_whatever_a_query_selects(spark, tmp_path, fmt):
    if fmt == "csv":
        _write(tmp_path / "vq_equip" / "a.csv", "qt_id,quantity\n1,2\n2,many\nx,3\n4,\n5,few\n")
        _write(tmp_path / "ep_bf" / "a.csv", "ep_id,ma_account_id,amount\n1,MA1122,1.5\n2,MA1122,1;5\n")
    else:
        _write(tmp_path / "vq_equip" / "a.json", '{"qt_id":1,"quantity":2}\n{"qt_id":2,"quantity":"many"}\n{"qt_id":"x","quantity":3}\n{"qt_id":4}\n{"qt_id":5,"quantity":"few"}\n')
        _write(tmp_path / "ep_bf" / "a.json", '{"ep_id":1,"ma_account_id":"MA1122","amount":1.5}\n{"ep_id":2,"ma_account_id":"MA1122","amount":"1;5"}\n')
    names = ["vq_equip", "ep_bf"]
    got = sorted(tuple(r) for r in LD.bad_cells(spark, str(tmp_path), names, fmt).collect())
    assert got == [("ep_bf", "amount", 1, "1;5"), ("vq_equip", "qt_id", 1, "x"), ("vq_equip", "quantity", 2, "few")]
    with pytest.raises(ValueError, match="ep_bf.amount: 1, e.g. '1;5'"):
        LD.load_schedule(spark, str(tmp_path), names, fmt=fmt)
    lazy = LD.load_schedule(spark, str(tmp_path), names, fmt=fmt, check=False)
    assert lazy.ep_bf.select("ep_id").count() == 2
    assert LD.bad_cells(spark, str(tmp_path), names, "parquet") is None


def test_schedule_missing_table_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        LD.load_schedule(spark, str(tmp_path), ["invoice"]).invoice.count()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_schedule_round_trip(spark, tmp_path, book, fmt):
    tables = {"vq_wholesale": book.vq_wholesale, "bankstatement": book.bankstatement}
    typed = {n: df.select([df[c].cast(t) for c, t in spark.createDataFrame([], LD.SCHEMAS[n]).dtypes]) for n, df in tables.items()}
    LD.write_schedule(typed, str(tmp_path), fmt=fmt)
    back = LD.load_schedule(spark, str(tmp_path), list(tables), fmt=fmt)
    for name, df in tables.items():
        got = back.table(name)
        same = got.select([got[c].cast(t) for c, t in df.dtypes])
        assert got.columns == df.columns
        assert same.exceptAll(df).count() == 0 and df.exceptAll(same).count() == 0, name


def test_report_format_original_names_and_file_order(spark, tmp_path):
    _write(tmp_path / "FRmapping.csv",
           "id,name,FP,PL,CF\nMA1002,Bank,F1,,\nMA6001,Sales,,P1,\n3,op,,,C1\n")
    _write(tmp_path / "Financial Reports.csv",
           "FR,名义报表,数据来源,Direction,add0i,add1i,add2i,add3i,add0o,add1o,add2o,add3o\n"
           "FP,Cash,F1,1,T1,,,,,,,\n"
           "PL,Sales,P1,-1,,,,,,,,\n"
           "FP,Total,,1,,,,,T1,,,\n")
    fmt = LD.load_report_format(spark, str(tmp_path))
    lines = sorted((r["fr"], r["line_no"], r["line_name"], r["direction"]) for r in fmt.template.collect())
    assert lines == [("FP", 1, "Cash", 1.0), ("FP", 2, "Total", 1.0), ("PL", 1, "Sales", -1.0)]
    assert [tuple(r) for r in fmt.cf_mapping.collect()] == [(3, "C1")]
    assert sorted(r["ma_account_id"] for r in fmt.account_mapping.collect()) == ["MA1002", "MA6001"]


def test_code_table_keeps_header_row_unless_skipped(spark, tmp_path):
    _write(tmp_path / "codes" / "c.csv", "name,id\nECONOMY,1\nLARGE,2\n")
    raw = LD.load_code_table(spark, str(tmp_path / "codes"), "equip_type_name", "equip_type_id")
    assert sorted(tuple(r) for r in raw.collect()) == [("ECONOMY", "1"), ("LARGE", "2"), ("name", "id")]
    typed = LD.load_code_table(spark, str(tmp_path / "codes"), "equip_type_name", "equip_type_id",
                               schema="equip_type_name string, equip_type_id int", bad="keep")
    assert [tuple(r)[:2] for r in LD.corrupt_rows(typed).collect()] == [("name", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        LD.load_code_table(spark, str(tmp_path / "codes"), "equip_type_name", "equip_type_id",
                           schema="equip_type_name string, equip_type_id int").collect()
    skipped = LD.load_code_table(spark, str(tmp_path / "codes"), "a", "b", skip_header=True)
    assert skipped.count() == 2


def test_record_table_blank_cells_are_null(spark, tmp_path):
    _write(tmp_path / "rec" / "r.csv", "qt_id,entry_date,exit_date\n10,2021-01-01,\n,2021-02-01,2021-02-03\n")
    got = LD.load_record_table(spark, str(tmp_path / "rec"), "qt_id bigint, entry_date date, exit_date date")
    assert sorted(got.collect(), key=lambda r: r["entry_date"])[0]["exit_date"] is None
    assert got.where("qt_id is null").count() == 1


def test_equipment_schedule_driven_by_code_definitions(spark, tmp_path):
    _write(tmp_path / "codedefinition" / "d.csv", "site,site_id,site_name\ncolor,color_id,color_name\n")
    _write(tmp_path / "site" / "s.csv", "1,North\n2,South\n")
    _write(tmp_path / "color" / "c.csv", "r,Red\n")
    for t in LD.RECORD_TABLES:
        _write(tmp_path / t / "r.csv", "equip_id,note\n7,x\n")
    out = LD.load_equipment_schedule(spark, str(tmp_path))
    assert set(out) == {"site", "color", *LD.RECORD_TABLES}
    assert out["site"].columns == ["site_id", "site_name"] and out["site"].count() == 2
    assert out["mro_record"].columns == ["equip_id", "note"]


def _sheets(where, n, rows="1,a\n2,b\n"):
    names = [f"code {i}+%" if i % 2 else f"c{i}" for i in range(n)]
    _write(where / "codedefinition" / "d.csv", "".join(f"{t},id,{t}_name\n" for t in names))
    for t in names:
        _write(where / t / "s.csv", rows.replace("a", f"first of {t}"))
    for t in LD.RECORD_TABLES:
        _write(where / t / "r.csv", "equip_id,note\n7,x\n")
    return names


def test_code_sheets_are_one_scan_and_one_write(spark, tmp_path):
    jobs = {}
    for n in (3, 40, 120):
        names = _sheets(tmp_path / f"in{n}", n)
        spark.sparkContext.setJobGroup(f"sheets{n}", "load")
        out = LD.load_equipment_schedule(spark, str(tmp_path / f"in{n}"), target=str(tmp_path / f"out{n}"))
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sheets{n}"))
        spark.sparkContext.setJobGroup("other", "other")
        for t in names[:2]:
            assert sorted(map(tuple, out[t].collect())) == [("1", f"first of {t}"), ("2", "b")] and out[t].columns == ["id", f"{t}_name"]
        assert out["mro_record"].count() == 1 and set(out) == {*names, *LD.RECORD_TABLES}
    assert jobs[40] == jobs[120] and jobs[40] - jobs[3] <= 2  # over 32 folders are listed in a job: sheets and tables


def test_code_sheets_files_folders_ragged_rows_and_repeats(spark, tmp_path):
    _sheets(tmp_path, 1)
    _write(tmp_path / "c0" / "deeper.csv", "3,c,more,cells\n4\n")
    _write(tmp_path / "single.csv", "x,y\n")
    _write(tmp_path / "codedefinition" / "d.csv", "c0,k,v\nsingle.csv,p,q\nc0,id,name\n")
    out = LD.load_equipment_schedule(spark, str(tmp_path))
    assert sorted(map(tuple, out["c0"].collect())) == [("1", "first of c0"), ("2", "b"), ("3", "c"), ("4", None)]
    assert out["c0"].columns == ["id", "name"] and [tuple(r) for r in out["single.csv"].collect()] == [("x", "y")]
    assert LD.read_code_sheets(spark, str(tmp_path), []).count() == 0


def test_code_sheets_replace_the_target_whole(spark, tmp_path):
    _sheets(tmp_path / "in", 2)
    LD.load_equipment_schedule(spark, str(tmp_path / "in"), target=str(tmp_path / "out"))
    before = LD.current_snapshot(spark, str(tmp_path / "out"))
    assert before[1] == sorted([LD.CODES, *LD.RECORD_TABLES])
    _write(tmp_path / "in" / "codedefinition" / "d.csv", "c0,a,b\nnot there,a,b\n")
    with pytest.raises(AnalysisException):
        LD.load_equipment_schedule(spark, str(tmp_path / "in"), target=str(tmp_path / "out"))
    assert LD.current_snapshot(spark, str(tmp_path / "out")) == before
    _write(tmp_path / "in" / "codedefinition" / "d.csv", "c0,a,b\n")
    out = LD.load_equipment_schedule(spark, str(tmp_path / "in"), target=str(tmp_path / "out"))
    root = LD.current_snapshot(spark, str(tmp_path / "out"))[0]
    assert root != before[0] and out["c0"].count() == 2
    assert [r[0] for r in spark.read.parquet(f"{root}/{LD.CODES}").select("table_name").distinct().collect()] == ["c0"]


def test_equipment_schedule_missing_record_table_fails(spark, tmp_path):
    _write(tmp_path / "codedefinition" / "d.csv", "site,site_id,site_name\n")
    _write(tmp_path / "site" / "s.csv", "1,North\n")
    with pytest.raises(AnalysisException):
        LD.load_equipment_schedule(spark, str(tmp_path))


def test_template_in_several_files_needs_line_numbers(spark, tmp_path):
    _write(tmp_path / "FRmapping.csv", "id,name,FP,PL,CF\nMA1002,Bank,F1,,\n")
    head = "FR,caption,数据来源,Direction,add0i,add1i,add2i,add3i,add0o,add1o,add2o,add3o\n"
    folder = tmp_path / "Financial Reports.csv"
    _write(folder / "a.csv", head + "FP,Cash,F1,1,,,,,,,,\n")
    one = LD.load_report_format(spark, str(tmp_path), label_col="caption")
    assert [(r["line_no"], r["line_name"]) for r in one.template.collect()] == [(1, "Cash")]
    _write(folder / "b.csv", head + "FP,Total,,1,,,,,,,,\n")
    with pytest.raises(ValueError):
        LD.load_report_format(spark, str(tmp_path), label_col="caption")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_a_schedule_is_written_compressed_and_checked_all_the_same(spark, tmp_path, fmt):
    rows = spark.createDataFrame([(i, None if i % 9 == 0 else i % 5) for i in range(5000)], "qt_id bigint, quantity int").coalesce(1)
    name = LD.write_schedule({"vq_equip": rows}, str(tmp_path), fmt)
    files = list((tmp_path / name / "vq_equip").glob("part-*"))
    assert files and all(f.name.endswith(f".{fmt}.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 5000 * 4
    back = LD.load_schedule(spark, str(tmp_path), fmt=fmt).vq_equip
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)
    if fmt == "json":
        return
    bad = LD.write_schedule({"vq_equip": rows.selectExpr("qt_id", "if(qt_id = 77, 'many', string(quantity)) AS quantity")}, str(tmp_path), fmt)
    with pytest.raises(ValueError, match="vq_equip.quantity: 1, e.g. 'many'"):
        LD.load_schedule(spark, str(tmp_path), fmt=fmt)
    assert LD.current_snapshot(spark, str(tmp_path))[0].endswith(bad)
