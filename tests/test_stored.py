"""The stored business tables: built lazily, dependents from stored parents."""

import datetime as dt

from conftest import SF_SMALL
from hirebook.sources.fixtures import Book, StoredBook, laid_out, stored_book


def test_only_touched_tables_are_built(spark):
    sb = StoredBook(spark, SF_SMALL)
    n = sb.bankstatement.count()
    assert set(sb._tables) == {"bankstatement"}
    assert n == Book.from_testdata(spark, SF_SMALL).bankstatement.count()


def test_dependent_table_reads_its_stored_parent(spark):
    sb = StoredBook(spark, SF_SMALL)
    cf = sb.cf_mapping
    assert set(sb._tables) == {"bankstatement", "cf_mapping"}
    raw = Book.from_testdata(spark, SF_SMALL).cf_mapping
    assert cf.exceptAll(raw).count() == 0 and raw.exceptAll(cf).count() == 0
    assert sb._derive.__dict__["bankstatement"] is sb._tables["bankstatement"]


def test_concurrent_requests_build_a_table_once(spark):
    from concurrent.futures import ThreadPoolExecutor
    sb = StoredBook(spark, SF_SMALL)
    with ThreadPoolExecutor(max_workers=4) as pool:
        frames = list(pool.map(lambda _: sb.table("vq_equip"), range(4)))
    assert all(f is frames[0] for f in frames)
    assert set(sb._tables) == {"vq", "vq_equip"}


def test_scratch_outputs_live_under_the_checkpoint_folder(spark):
    from hirebook.operators import rental as R
    from hirebook.session import ensure_checkpoint_dir, scratch_path, session_id
    root = ensure_checkpoint_dir(spark).rstrip("/")
    own = f"{root}/hirebook-{session_id(spark)}"
    assert scratch_path(spark, "x").startswith(own + "/x-")
    sb = StoredBook(spark, SF_SMALL)
    assert sb._root.startswith(own + "/book-")
    s = R.shared_summary(sb.relocation, "1996-12-31", "1997-12-31")
    assert all(f.startswith(root) or f.startswith(root.replace("file:", "file://"))
               for f in s.inputFiles())
    s.unpersist()


def test_a_changed_source_is_derived_anew(spark, tmp_path):
    import os
    import shutil
    d = tmp_path / "sf"
    shutil.copytree(SF_SMALL, d)
    first = stored_book(spark, str(d))
    assert stored_book(spark, str(d)) is first
    os.utime(d / "part.parquet", (1, 1))
    assert stored_book(spark, str(d)) is not first


def test_dated_tables_are_sorted_where_they_are_derived(spark):
    from test_scale import plan_text
    rows = spark.createDataFrame([(i, dt.date(2021, 1, 1 + i * 7 % 28)) for i in range(40)], "k bigint, date date").repartition(3, "k")
    for name in ("invoice", "bankstatement", "aje"):
        stored = laid_out(name, rows)
        assert "rangepartitioning" not in plan_text(stored) and sorted(stored.collect()) == sorted(rows.collect())
        for part in stored.rdd.glom().collect():
            assert [r.date for r in part] == sorted(r.date for r in part)
    assert laid_out("vq", rows) is rows
