"""python -m hirebook: list, unknown query, run with --out."""

from hirebook.__main__ import main
from conftest import SF_SMALL


def test_list_names_every_query(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "client_profitability" in out and "compile_all" in out


def test_unknown_query_is_an_error(capsys):
    assert main(["run", "no_such_report", "--sf", SF_SMALL]) == 2


def test_run_writes_the_whole_result(spark, tmp_path):
    out = tmp_path / "bank_by_account"
    assert main(["run", "bank_by_account", "--sf", SF_SMALL, "--out", str(out), "--master", "local[2]"]) == 0
    back = spark.read.parquet(str(out))
    assert back.count() > 0 and "Amount" in back.columns
