"""Schedule and code-table loaders (S1, S4-S7) and the table sink.

A schedule is a folder with one sub-folder (or file) per table, in CSV with
a header row, Parquet, ORC or JSON. Readers get an explicit schema; a cell
that its type can't hold fails the read or is kept with its row, never lost.
A missing table fails the load.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.operators.statements import ReportFormat
from hirebook.sources.fixtures import Book
from hirebook.sources.schemas import SCHEMAS

FORMATS = ("csv", "parquet", "orc", "json")
TEXT_FORMATS = ("csv", "json")

# Column names of the report-format files.
MAPPING_COLUMNS = ["ma_account_id", "ma_account_name", "fp", "pl", "cf"]  # by position
TEMPLATE_RENAMES = {"FR": "fr", "名义报表": "line_name", "数据来源": "source_code", "Direction": "direction"}
RECORD_TABLES = ("equip_info", "change_record", "relocation_record", "mro_record")


CORRUPT = "_corrupt_record"
COMMITS = "commits"


def _reader(spark: SparkSession, fmt: str, header: bool = True, bad: str = "fail"):
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    if bad not in ("fail", "keep"):
        raise ValueError("bad is 'fail' or 'keep'")
    r = spark.read.format(fmt)
    if fmt in TEXT_FORMATS:
        r = r.option("mode", "FAILFAST" if bad == "fail" else "PERMISSIVE")
    if fmt == "csv":
        r = r.option("header", header).option("enforceSchema", False)
    return r


def read_table(spark: SparkSession, path: str, schema: str | None, fmt: str = "csv", bad: str = "fail") -> DataFrame:
    """One typed table of a schedule (as it is, all text in CSV, without a
    schema).

    A cell that its type can't hold is never silently NULL: with ``bad="fail"``
    the read fails, with ``"keep"`` the row stays, its raw text in
    ``_corrupt_record`` (see ``corrupt_rows``). That holds for the columns that
    a query reads; ``bad_cells`` checks them all. Blank cells are NULL.
    """
    r = _reader(spark, fmt, bad=bad)
    if schema is None:
        return r.load(path)
    keep = bad == "keep" and fmt in TEXT_FORMATS
    return r.option("columnNameOfCorruptRecord", CORRUPT).schema(f"{schema}, {CORRUPT} string" if keep else schema).load(path)


def corrupt_rows(df: DataFrame) -> DataFrame:
    """The rows of a table read with ``bad="keep"`` that had a bad cell."""
    return df.where(F.col(CORRUPT).isNotNull())


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", by: list[str] | None = None,
                compression: str | None = None) -> None:
    """Sink: replace the table at ``path`` (full refresh), in folders ``by``
    columns. ``compression``: by default the format's own."""
    w = df.write.mode(mode).format(fmt).partitionBy(*(by or []))
    if fmt == "csv":
        w = w.option("header", True)
    if compression:
        w = w.option("compression", compression)
    w.save(path)


def load_schedule(spark: SparkSession, path: str, tables=None, fmt: str = "csv", schemas: dict[str, str] | None = None,
                  bad: str = "fail", check: bool = True) -> Book:
    """Read the tables of a schedule folder into a ``Book``.

    Without ``tables`` these are the ones of the last committed snapshot, or
    else all known ones; a folder without snapshots holds a sub-folder a
    table. A table without a schema is read as it is (CSV: text).

    With ``bad="fail"`` every cell of the text formats is checked first, in
    one job (``bad_cells``): a query that selects two columns would otherwise
    parse those alone and never meet a broken third. ``check=False`` leaves
    that to whoever checked the files before.
    """
    schemas = SCHEMAS if schemas is None else schemas
    root, listed = current_snapshot(spark, path)
    names = list(tables or listed or schemas)
    if check and bad == "fail":
        wrong = bad_cells(spark, path, names, fmt, schemas)
        found = wrong.orderBy("table_name", "column_name").limit(20).collect() if wrong is not None else []
        if found:
            raise ValueError("bad cells: " + "; ".join(f"{r.table_name}.{r.column_name}: {r.bad}, e.g. {r.example!r}" for r in found))
    return Book(spark, {n: read_table(spark, f"{root}/{n}", schemas.get(n), fmt, bad) for n in names})


def bad_cells(spark: SparkSession, path: str, tables=None, fmt: str = "csv", schemas: dict[str, str] | None = None) -> DataFrame | None:
    """The validation pass: (table_name, column_name, bad, example) of every
    column with cells that its type can't hold, ``bad`` of them, ``example``
    the smallest as text; rows that can't be told into cells at all count under
    the column NULL. One scan and one aggregate over all columns a table, all
    in one query. None where nothing can be wrong (typed formats, no schema).
    """
    if fmt not in TEXT_FORMATS:
        return None
    schemas = SCHEMAS if schemas is None else schemas
    root, listed = current_snapshot(spark, path)
    parts = [_bad_cells(spark, f"{root}/{n}", n, schemas[n], fmt) for n in (tables or listed or schemas) if n in schemas]
    return reduce(DataFrame.unionAll, parts) if parts else None


def _bad_cells(spark: SparkSession, path: str, name: str, schema: str, fmt: str) -> DataFrame:
    typed = read_table(spark, path, schema, fmt, bad="keep")
    columns = typed.columns[:-1]
    texts = ", ".join(f"`{c}` string" for c in columns)
    parse = F.from_csv if fmt == "csv" else F.from_json
    cells = parse(CORRUPT, texts if fmt == "csv" else T.StructType.fromDDL(texts), {"mode": "PERMISSIVE"})
    typed = typed.withColumn("cells", F.when(F.col(CORRUPT).isNotNull(), cells))
    wrong = {c: F.col(f"`{c}`").isNull() & F.col("cells")[c].isNotNull() for c in columns}
    whole = F.col(CORRUPT).isNotNull() & ~reduce(lambda a, b: a | b, [F.coalesce(w, F.lit(False)) for w in wrong.values()])
    found = [(c, w, F.col("cells")[c]) for c, w in wrong.items()] + [(None, whole, F.col(CORRUPT))]
    sums = typed.agg(*[F.count(F.when(w, 1)).alias(f"n{i}") for i, (_, w, _) in enumerate(found)],
                     *[F.min(F.when(w, text)).alias(f"t{i}") for i, (_, w, text) in enumerate(found)])
    rows = [F.struct(F.lit(name).alias("table_name"), F.lit(c).cast("string").alias("column_name"), F.col(f"n{i}").alias("bad"),
                     F.col(f"t{i}").alias("example")) for i, (c, _, _) in enumerate(found)]
    return sums.select(F.inline(F.array(*rows))).where("bad > 0")


def write_schedule(tables: dict[str, DataFrame], path: str, fmt: str = "csv", by: dict[str, list[str]] | None = None) -> str:
    """S1 sink: the schedule at ``path`` becomes exactly these tables, in one
    commit; returns the snapshot's name.

    The tables are written to a new snapshot folder; then one line in one new
    file names it. Until that file is there, loads read the snapshot before,
    whole; a write that dies half way leaves a folder that nothing names. Of
    two writers at once, one's snapshot is the later, whole. ``prune_snapshots``
    deletes old ones. ``by``: tables that are written in folders by columns.
    The text formats are written as gzip (loads tell it by the file's name);
    such a file is one task to read, as it was one task to write.
    """
    root = path.rstrip("/")
    if not tables:
        raise ValueError("a schedule has tables")
    spark = next(iter(tables.values())).sparkSession
    version, name = next_snapshot(spark, root)
    for table, df in tables.items():
        write_table(df, f"{root}/{name}/{table}", fmt, mode="errorifexists", by=(by or {}).get(table),
                    compression="gzip" if fmt in TEXT_FORMATS else None)
    return commit_snapshot(spark, root, version, name, list(tables))


def next_snapshot(spark: SparkSession, root: str) -> tuple[int, str]:
    """Version and folder name of the snapshot after the last committed one."""
    commits = _commits(spark, root)
    version = 1 + (commits.agg(F.max("version")).first()[0] or 0 if commits is not None else 0)
    return version, f"snapshot-{version:08d}-{uuid.uuid4().hex[:8]}"


def commit_snapshot(spark: SparkSession, root: str, version: int, name: str, tables: list[str]) -> str:
    """Name a snapshot whose tables are all written, in one new file; its name."""
    line = spark.range(1, numPartitions=1).select(F.lit(version).cast("bigint").alias("version"), F.lit(name).alias("snapshot"),
                                                  F.array(*[F.lit(t) for t in sorted(tables)]).alias("tables"))
    line.write.mode("append").json(f"{root}/{COMMITS}")
    return name


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    """(version, snapshot, tables) of every commit; None without any."""
    try:
        return spark.read.schema("version bigint, snapshot string, tables array<string>").option("mode", "FAILFAST").json(f"{root}/{COMMITS}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def current_snapshot(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """The folder that a schedule's tables are in and their names (none: not listed)."""
    root = path.rstrip("/")
    commits = _commits(spark, root)
    last = commits.orderBy(F.desc("version"), F.desc("snapshot")).first() if commits is not None else None
    return (f"{root}/{last.snapshot}", sorted(last.tables)) if last else (root, [])


def listed_tables(spark: SparkSession, path: str) -> list[str]:
    """Names of the last committed snapshot's tables; none without one."""
    return current_snapshot(spark, path)[1]


def prune_snapshots(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` committed snapshots, and folders that
    no commit names (of writers that died: don't call it while one is at work).
    Returns the names of what went."""
    if keep < 1:
        raise ValueError("the current snapshot stays")
    root = path.rstrip("/")
    commits = _commits(spark, root)
    if commits is None:
        return []
    stay = {r.snapshot for r in commits.orderBy(F.desc("version"), F.desc("snapshot")).limit(keep).collect()}
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = sorted(s.getPath().getName() for s in fs.listStatus(where) if s.getPath().getName().startswith("snapshot-") and s.getPath().getName() not in stay)
    for name in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), True)
    return gone


def _typed(df: DataFrame, schema: str | None, bad: str = "fail") -> DataFrame:
    """Project text columns to a schema. A cell that does not convert fails
    the read, or (``bad="keep"``) leaves the row's cells in ``_corrupt_record``."""
    if not schema:
        return df
    fields = T.StructType.fromDDL(schema).fields
    if bad == "fail":
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
    tried = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in fields}
    wrong = [F.col(f"`{n}`").isNotNull() & c.isNull() for n, c in tried.items()]
    any_wrong = F.array_contains(F.array(*wrong), True)
    raw = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields]))
    return df.select(*[c.alias(n) for n, c in tried.items()], F.when(any_wrong, raw).alias(CORRUPT))


def load_report_format(spark: SparkSession, path: str, mapping_name: str = "FRmapping.csv",
                       template_name: str = "Financial Reports.csv", label_col: str | None = None) -> ReportFormat:
    """The account mapping (five columns by position: id, name, FP, PL,
    CF codes) and the statement template.

    The mapping splits by statement (rows with a code); CF ids are cast to
    integers. ``label_col`` names the template's column of line names if it
    isn't the usual one. A template in one file keeps its line order as
    ``line_no``; one in several files needs that column.
    """
    m = spark.read.option("header", True).csv(f"{path}/{mapping_name}")
    m = m.toDF(*MAPPING_COLUMNS, *m.columns[len(MAPPING_COLUMNS):])
    accounts = m.where(F.col("fp").isNotNull() | F.col("pl").isNotNull()).select(
        "ma_account_id", "ma_account_name", "fp", "pl")
    cf = m.where(F.col("cf").isNotNull()).select(
        F.col("ma_account_id").cast("bigint").alias("cf_account_id"), "cf")
    t = spark.read.option("header", True).csv(f"{path}/{template_name}")
    files = t.inputFiles()
    names = TEMPLATE_RENAMES if label_col is None else {**{k: v for k, v in TEMPLATE_RENAMES.items() if v != "line_name"}, label_col: "line_name"}
    columns = t.columns
    if "line_no" not in columns:
        if len(files) > 1:
            raise ValueError("a template in several files needs a line_no column: files have no order")
        # within the file: blocks by their start, lines by their place in the block
        t = t.select("*", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_pos"))
    for old, new in names.items():
        if old in columns:
            t = t.withColumnRenamed(old, new)
    if "line_no" not in columns:
        t = t.withColumn("line_no", F.row_number().over(Window.partitionBy("fr").orderBy("_block", "_pos"))).drop("_block", "_pos")
    return ReportFormat(_typed(t, SCHEMAS["report_template"]), accounts, cf)


def load_code_table(spark: SparkSession, path: str, col1: str, col2: str, skip_header: bool = False,
                    schema: str | None = None, bad: str = "fail", target: str | None = None) -> DataFrame:
    """The first two cells of every row of a sheet as (col1, col2).

    Like the reports' loader the first row is data unless ``skip_header``.
    ``schema`` types the two columns (``"col1 string, col2 int"``). With
    ``target`` the table there is replaced and read back.
    """
    df = spark.read.option("header", skip_header).csv(path)
    first_two = df.select(F.col(f"`{df.columns[0]}`").alias(col1), F.col(f"`{df.columns[1]}`").alias(col2))
    return _refreshed(_typed(first_two, schema, bad), target)


def load_record_table(spark: SparkSession, path: str, schema: str | None = None, bad: str = "fail",
                      target: str | None = None) -> DataFrame:
    """A sheet whose first row names the columns; blank cells are NULL.
    ``schema`` gives the typed projection (all text otherwise); ``target`` as
    in ``load_code_table``."""
    return _refreshed(_typed(spark.read.option("header", True).csv(path), schema, bad), target)


def _refreshed(df: DataFrame, target: str | None) -> DataFrame:
    """Full refresh: replace the table at ``target`` and read it from there."""
    if target is None:
        return df
    write_table(df, target, "parquet")
    return df.sparkSession.read.schema(df.schema).parquet(target)


def load_equipment_schedule(spark: SparkSession, path: str, record_schemas: dict[str, str] | None = None,
                            target: str | None = None, max_tables: int = 10_000) -> dict[str, DataFrame]:
    """The code tables listed in the ``codedefinition`` sheet (table,
    column 1, column 2 per row), then the four record tables; with ``target``
    they replace the schedule there, in one commit (``write_schedule``).

    All code sheets are one scan, whose rows are routed to their tables by the
    file that they come from (``read_code_sheets``), and one write partitioned
    by table; the jobs don't grow with the sheets. A table listed twice is
    loaded once, under the names of its last row.

    Only the metadata sheet is read on the driver (at most ``max_tables``
    rows, else ValueError). A table missing from the folder fails the load.
    """
    defs = spark.read.schema("t string, c1 string, c2 string").option("header", False).csv(f"{path}/codedefinition").limit(max_tables + 1).collect()
    if len(defs) > max_tables:
        raise ValueError(f"over {max_tables} code tables")
    names = {row.t: (row.c1, row.c2) for row in defs}
    records = {t: load_record_table(spark, f"{path}/{t}", (record_schemas or {}).get(t)) for t in RECORD_TABLES}
    codes = read_code_sheets(spark, path, list(names))
    if target is not None:
        write_schedule({CODES: codes, **records}, target, "parquet", {CODES: ["table_name"]})
        root = current_snapshot(spark, target)[0]
        codes = spark.read.schema(CODES_SCHEMA).parquet(f"{root}/{CODES}")
        records = {t: spark.read.schema(df.schema).parquet(f"{root}/{t}") for t, df in records.items()}
    return {**{n: codes.where(F.col("table_name") == n).select(F.col("cell1").alias(c1), F.col("cell2").alias(c2)) for n, (c1, c2) in names.items()}, **records}


CODES = "code_tables"
CODES_SCHEMA = "cell1 string, cell2 string, table_name string"


def read_code_sheets(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(cell1, cell2, table_name): the first two cells of every row of the
    named sheets (files or folders under ``path``), in one scan.

    A row's table is the first part of its file's path below ``path``. Cells
    that a row lacks are NULL, further ones are left out. A sheet that isn't
    there fails the read.
    """
    if not names:
        return spark.createDataFrame([], CODES_SCHEMA)
    rows = spark.read.schema("cell1 string, cell2 string").option("header", False).csv([f"{path}/{n}" for n in dict.fromkeys(names)])
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().toString()
    # file:/x in one place is file:///x in the other
    below = F.substring(F.regexp_replace("_metadata.file_path", SCHEME, ""), len(re.sub(SCHEME, "", root.rstrip("/"))) + 2, 1 << 20)
    name = F.url_decode(F.replace(F.substring_index(below, "/", 1), F.lit("+"), F.lit("%2B")))
    return rows.select("cell1", "cell2", name.alias("table_name"))


SCHEME = "^[A-Za-z0-9+.-]+:/*"
