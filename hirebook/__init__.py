"""hirebook: management accounting for an equipment-rental business on Spark.

Typed business tables (relocations, quotations, invoices, bank movements,
journal entries, payroll, fixed assets) go in as DataFrames; every report is
a pure function ``(DataFrames, parameters) -> DataFrame`` built from Spark's
relational operators, so Catalyst plans the whole report and nothing is
materialised on the driver.

    from hirebook import Book, Reports, ReportParams, build_session
    spark = build_session()
    r = Reports(Book.from_testdata(spark, "/root/testdata/sf0.01"),
                ReportParams(bf_date="1995-12-31", start="1996-12-31", end="1997-12-31"))
    r.client_gross_profit().show()
"""

from hirebook.params import Bounds, ReportParams
from hirebook.reports import Reports
from hirebook.session import build_session
from hirebook.sources.fixtures import Book, StoredBook, stored_book

__all__ = ["Book", "Bounds", "ReportParams", "Reports", "StoredBook", "build_session", "stored_book"]
