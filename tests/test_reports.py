"""The Reports facade: defaults, and agreement with the registered queries."""

import datetime as dt

from hirebook.params import TEST_PARAMS as P
from hirebook.plans.catalog import present
from hirebook.reports import Reports


def test_defaults_fill_start_and_end_independently(book):
    r = Reports(book, P)
    assert r.show_date() == (P.start, P.end)
    r.set_date(None, "1998-06-30")
    assert r.show_date() == (P.start, dt.date(1998, 6, 30))


def test_methods_match_queries(spark, book):
    r = Reports(book, P)
    a = {tuple(x) for x in present(r.client_gross_profit()).collect()}
    b = {tuple(x) for x in present(r.client_gross_profit(P.start, P.end)).collect()}
    assert a == b and len(a) > 0
    fp, pl, cf = r.compile_reports("1996-12-31", 3, "Q")
    assert len(fp.columns) == 2 + 4 and len(pl.columns) == 2 + 3 and len(cf.columns) == 2 + 3
    assert r.data_integrity().count() == 5
    assert r.payroll_processing(2021, 3).count() > 10
    assert r.show("bankstatement", "vat is null").count() == r.show("bankstatement").where("vat is null").count()
    assert {x["line_name"] for x in r.statement("PL").collect()} == {"Sales", "Costs", "Profit"}


def test_every_check_and_block_builds(book):
    r = Reports(book, P)
    for m in ("check_relocation_negative", "check_bf_account_vs_externalparties",
              "check_bankstatement_for_missing_ep_id", "check_aje_for_missing_ep_id", "check_missing_vat",
              "ppe_list"):
        assert getattr(r, m)().columns, m
    for m in ("payroll_month", "payroll_regular", "payroll_associate", "payroll_external",
              "depreciation_by_user", "depreciation_journal"):
        assert getattr(r, m)(2021, 3).columns, m
    assert r.check_relocation_negative().count() == 1


def test_labels_quotations_and_views(spark, book):
    r = Reports(book, P)
    st = r.statement("PL", label_col="名义报表")
    assert st.columns == ["line_no", "名义报表", "Amount"]
    assert r.quotations(1).columns == ["q_id", "qt_id", "equip_quantity", "equip_type_id", "rent_daily"]
    assert r.register_views(["CF_for_cftemp"]) == ["CF_for_cftemp"]
    assert spark.sql("SELECT count(*) FROM CF_for_cftemp").collect()[0][0] > 0
