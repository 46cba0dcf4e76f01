"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed: its blob is the SHA-256 of
its bytes.  The ledger is a folder of two tables in shared storage,

    scans/     blob, pairs (the "rule@version" pairs that it was scanned with)
    findings/  blob, rule, version, start, end

A scan takes the distinct blobs of the given versions, looks up which pairs of
rule and rule version each has been scanned with, and runs only the others: a
blob that any path ever had is read again only for rules that are new or have
a new version.  Findings are then joined back to all paths of the blob.

Equal blobs are reduced within each map task before they are shuffled, so a
blob with a third of all rows costs one text a task.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirebook.llm.common import materialise
from pyspark.sql.utils import AnalysisException

SCANS = "blob binary, pairs array<string>"
FINDINGS = "blob binary, rule string, version int, start long, `end` long"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose group ``group``
    has ``least`` characters or more."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def pair(self) -> str:
        return f"{self.name}@{self.version}"


# The rules, in the order in which spans of one start are listed.
# (?a) keeps "either case" to ASCII letters.
ASSIGN = Rule("assign", 1, r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12)
ACCESS = Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18)
HEX = Rule("hex", 1, r"[0-9a-f]+", 0, 16)
BASE = (ASSIGN, ACCESS, HEX)
PRIVATE_KEY = Rule("pem", 1, r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----")
RULES = (*BASE, PRIVATE_KEY)


def find(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Spans in code points, end exclusive."""
    return [m.span() for m in _compiled(rule).finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


_COMPILED: dict = {}


def _compiled(rule: Rule):
    if rule not in _COMPILED:
        pattern = rule.pattern
        run = re.fullmatch(r"(\w*)(\[[^\]]+\])\+", pattern) if rule.group == 0 else None
        if run and len({bool(re.match(run[2], c)) for c in run[1]}) < 2:
            # runs of one class after fixed characters, all or none of them of the
            # class: a run that is too short holds no start of a match that is long
            # enough, so the length can be asked for at once; the run has one
            # character at least, whatever the rule asks for
            fixed = len(run[1])
            pattern = f"{pattern[:-1]}{{{max(1, rule.least - fixed)},}}"
        _COMPILED[rule] = re.compile(pattern)
    return _COMPILED[rule]


def _read(spark, path: str, schema: str) -> DataFrame:
    """A table of the ledger; empty before the first scan."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def versions_of(docs: DataFrame, path_cols: tuple, text_col: str) -> DataFrame:
    """The path columns, blob and text (null: empty) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*(F.col(f"`{c}`") for c in path_cols), F.unhex(F.sha2(F.encode(text, "utf-8"), 256)).alias("_blob"), text.alias("_text"))


def unseen(versions: DataFrame, ledger: str, rules: tuple) -> DataFrame:
    """Blobs with the pairs they lack: blob, text, pairs (not empty).

    Of a ledger with scans only digests are looked up: the blobs that lack a
    pair are a stored table, and texts are dropped in the task that reads them
    unless their blob is in it.  Spark sends that table to every task where
    its measured size allows, and else joins by blob behind its runtime filter.
    """
    texts = versions.select(F.col("_blob").alias("blob"), F.col("_text").alias("text"))
    wanted = F.array(*(F.lit(r.pair) for r in rules))
    scans = _read(versions.sparkSession, f"{ledger}/scans", SCANS)
    if scans.isEmpty():
        return texts.dropDuplicates(["blob"]).select("blob", "text", wanted.alias("pairs")).where(F.size("pairs") > 0)
    seen = scans.groupBy("blob").agg(F.flatten(F.collect_set("pairs")).alias("seen"))
    lacking = (texts.select("blob").distinct().join(seen, "blob", "left")
               .select("blob", F.when(F.col("seen").isNull(), wanted).otherwise(F.array_except(wanted, "seen")).alias("pairs"))
               .where(F.size("pairs") > 0))
    return texts.join(materialise(lacking, "lacking"), "blob").dropDuplicates(["blob"]).select("blob", "text", "pairs")


def scan(docs: DataFrame, ledger: str, rules: tuple = RULES, path_cols: tuple = ("doc_id",), text_col: str = "text") -> None:
    """Bring the ledger up to date with all rows of ``docs``.

    One job reads the texts, scans what is unseen and appends one row a blob;
    the findings are unpacked from it into their own table first, so a scan
    that fails half way is repeated and never believed.
    """
    spark = docs.sparkSession
    by_pair = {r.pair: r for r in rules}
    todo = unseen(versions_of(docs, path_cols, text_col), ledger, rules)
    schema = "blob binary, pairs array<string>, rule array<string>, version array<int>, start array<bigint>, `end` array<bigint>"

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = []
                for text, pairs in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    out.append([(by_pair[p], s, e) for p in pairs for s, e in find(text, by_pair[p])])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), pa.array([[r.name for r, _, _ in x] for x in out], pa.list_(pa.string())),
                    pa.array([[r.version for r, _, _ in x] for x in out], pa.list_(pa.int32())),
                    pa.array([[s for _, s, _ in x] for x in out], pa.list_(pa.int64())),
                    pa.array([[e for _, _, e in x] for x in out], pa.list_(pa.int64()))],
                    ["blob", "pairs", "rule", "version", "start", "end"])

    run_dir = f"{ledger}/runs/{uuid.uuid4().hex}"
    todo.mapInArrow(run, schema).write.parquet(run_dir)
    done = spark.read.schema(schema).parquet(run_dir)
    (done.select("blob", F.explode(F.arrays_zip("rule", "version", "start", "end")).alias("f")).select("blob", "f.*")
     .write.mode("append").parquet(f"{ledger}/findings"))
    done.select("blob", "pairs").write.mode("append").parquet(f"{ledger}/scans")


def findings(docs: DataFrame, ledger: str, rules: tuple = RULES, path_cols: tuple = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The path columns of every row of ``docs`` with ``spans``: an array of
    (start, rank of the rule, rule, end) in that order, of the given rules at
    their versions; empty if there are none.

    A finding counts once however often the ledger holds it.  Null and empty
    texts have no findings; rows that repeat a path each get a row; a null
    path is a path; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rank = spark.createDataFrame([(r.name, r.version, i) for i, r in enumerate(rules)], "rule string, version int, rank int")
    found = (_read(spark, f"{ledger}/findings", FINDINGS).join(F.broadcast(rank), ["rule", "version"])
             .groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", "rank", "rule", "end"))).alias("spans")))
    paths = versions_of(docs, path_cols, text_col).drop("_text")
    empty = F.array().cast("array<struct<start:bigint,rank:int,rule:string,end:bigint>>")
    return (paths.join(found, F.col("_blob") == F.col("blob"), "left")
            .select(*(F.col(f"`{c}`") for c in path_cols), F.coalesce("spans", empty).alias("spans")))
