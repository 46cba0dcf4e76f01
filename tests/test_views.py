"""Named views (S8): SQL over the reports' view names."""

from hirebook.operators import profitability as PR
from hirebook.operators import rental as R
from hirebook.params import TEST_PARAMS as P
from hirebook.plans.views import (balance_views, cash_flow_views, create_views, pl_views, register_tables, register_views,
                                  report_views)


def test_views_answer_sql_like_the_functions(spark, book):
    names = register_views(book, P, ["ClientGrossProfit", "machinedaysummary", "balance_at_frtemp"])
    assert names == ["ClientGrossProfit", "machinedaysummary", "balance_at_frtemp"]
    via_sql = spark.sql("SELECT * FROM ClientGrossProfit WHERE Revenue IS NOT NULL")
    rent = R.RentTables(book.relocation, book.vq, book.vq_equip, book.vq_wholesale)
    direct = PR.client_profitability(PR.contract_profitability(rent, book.equip_dailycost, P.start, P.end)) \
        .where("Revenue IS NOT NULL")
    assert via_sql.count() == direct.count() > 0
    assert spark.sql("SELECT count(*) FROM machinedaysummary").collect()[0][0] > 0


def test_all_views_build_and_tables_register(spark, book):
    views = report_views(book, P, 2021, 3)
    assert len(views) >= 45
    for name, build in views.items():
        assert build().columns, name
    register_tables(book, ["bankstatement"])
    assert spark.sql("SELECT count(*) FROM bankstatement WHERE vat IS NULL").collect()[0][0] >= 0


def test_statement_views_take_the_callers_name(spark, book):
    """Views of two dates stand next to each other, intermediates included."""
    early = create_views(balance_views(book, P, "early", P.start))
    create_views(balance_views(book, P, "late", P.end))
    assert "balance_at_early" in early and "accumulated_ADJ_for_early" in early
    create_views({**pl_views(book, "between", P.start, P.end), **cash_flow_views(book, "between", P.start, P.end)})
    off = spark.sql("""SELECT max(abs(l.Amount - e.Amount - d.Amount)) FROM balance_at_late l
        JOIN balance_at_early e USING (ma_account_id) JOIN duringbetween d USING (ma_account_id)""").collect()[0][0]
    assert off < 0.01
    assert spark.table("CF_for_between").columns == ["suggested_cf", "cf_account_id", "Amount"]
