"""Business tables derived from the driver's TPC-H-like tables.

The rules are the ones written down in FIXTURES.md part B; the DuckDB oracle
(`hirebook.plans.oracle`) states the same rules in SQL, so both engines start
from equal rows. Everything here is a lazy DataFrame over the parquet scans:
no table is materialised, and the derivations scale with their sources.

Two derivations multiply rows by a small fixed set (quotation lines 0..2,
payroll months 1..3). They use ``explode(sequence(..))`` on the row itself
instead of a cross join with ``region``.
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.sources.testdata import read_table


def _sql_div(a: Column, b: int) -> Column:
    """SQL ``a DIV b``: integer division truncating toward zero."""
    return F.call_function("div", a, F.lit(b))


def _cents(c: Column) -> Column:
    return F.round(c * F.lit(100)).cast("bigint")


def _account(n: Column) -> Column:
    """Account id ``MA<1002 + 20 n>``."""
    return F.concat(F.lit("MA"), (F.lit(1002) + F.lit(20) * n).cast("string"))


# Fixed values of the test inputs (FIXTURES.md part B), in natural order.
EQUIP_TYPE_IDS = [("ECONOMY", 1), ("LARGE", 2), ("MEDIUM", 3), ("PROMO", 4),
                  ("SMALL", 5)]  # any other type -> 6
EQUIP_QUANTITY_BY_MOD4 = [1, 3, 7, 9]
WHOLESALE_DAYS_BY_MOD4 = [21, 33, 63, 77]
PPE_LIFE_BY_MOD5 = [7, 9, 21, 33, 63]

REPORT_TEMPLATE_SCHEMA = T.StructType([
    T.StructField("fr", T.StringType()),
    T.StructField("line_no", T.IntegerType()),
    T.StructField("line_name", T.StringType()),
    T.StructField("source_code", T.StringType()),
    T.StructField("direction", T.DoubleType()),
    *[T.StructField(f"add{i}i", T.StringType()) for i in range(4)],
    *[T.StructField(f"add{i}o", T.StringType()) for i in range(4)],
])

# fr, line_no, line_name, source_code, direction, add0i..add3i, add0o..add3o
REPORT_TEMPLATE_ROWS = [
    ("FP", 1, "Cash", "F1", 1.0, "T1", None, None, None, None, None, None, None),
    ("FP", 2, "Receivables", "F2", 1.0, "T1", "U1", None, None, None, None, None, None),
    ("FP", 3, "Total assets", None, 1.0, None, None, None, None, "T1", None, None, None),
    ("FP", 4, "VAT", "F3", -1.0, None, "U1", None, None, None, None, None, None),
    ("FP", 5, "Net", None, 1.0, None, None, None, None, None, "U1", None, None),
    ("FP", 6, "Other", "F4", -1.0, None, None, None, None, None, None, None, None),
    ("CF", 1, "Operating", "C1", -1.0, "T3", None, None, None, None, None, None, None),
    ("CF", 2, "Investing", "C2", -1.0, "T3", None, None, None, None, None, None, None),
    ("CF", 3, "Financing", "C3", -1.0, "T3", None, None, None, None, None, None, None),
    ("CF", 4, "Net change", None, -1.0, None, None, None, None, "T3", None, None, None),
    ("PL", 1, "Sales", "P1", -1.0, "T2", None, None, None, None, None, None, None),
    ("PL", 2, "Costs", "P2", -1.0, "T2", None, None, None, None, None, None, None),
    ("PL", 3, "Profit", None, -1.0, None, None, None, None, "T2", None, None, None),
]


def _case(key: Column, pairs, default=None) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out if default is None else out.otherwise(F.lit(default))


def _by_mod(key: Column, values) -> Column:
    return _case(key, list(enumerate(values)))


class Book:
    """The business tables of one company, as lazy DataFrames.

    ``Book.from_testdata`` derives them from the driver's tables;
    ``Book(spark, tables)`` wraps tables read by the loaders.
    """

    NAMES = ("equip_type", "relocation", "vq", "vq_equip", "vq_wholesale",
             "equip_dailycost", "invoice", "external_parties", "ep_bf",
             "chart_of_accounts", "account_bf", "bankstatement", "aje",
             "payroll", "worker_info", "ppe_list", "depr_alloc",
             "report_mapping", "report_template", "cf_mapping")

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None,
                 sf_dir: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        for name, df in (tables or {}).items():
            self.__dict__[name] = df

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Book":
        return cls(spark, sf_dir=sf_dir)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _src(self, name: str) -> DataFrame:
        if self.sf_dir is None:
            raise KeyError(f"table {name!r} was not supplied")
        return read_table(self.spark, self.sf_dir, name)

    # -- equipment and quotations -------------------------------------
    @cached_property
    def equip_type(self) -> DataFrame:
        p = self._src("part").select(F.col("p_type").alias("equip_type_name")).distinct()
        return p.select("equip_type_name", self._type_id(F.col("equip_type_name")))

    @staticmethod
    def _type_id(p_type: Column) -> Column:
        return _case(p_type, EQUIP_TYPE_IDS, 6).alias("equip_type_id")

    @cached_property
    def relocation(self) -> DataFrame:
        li = self._src("lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                          "l_quantity", "l_returnflag", "l_shipdate")
        # equip_type is distinct(p_type) with an id per name, so the join with
        # it is the same as computing the id on the part row (NULL types drop).
        part = (self._src("part").where(F.col("p_type").isNotNull())
                .select(F.col("p_partkey"), F.col("p_type").alias("equip_type_name"),
                        self._type_id(F.col("p_type"))))
        j = li.join(part, li.l_partkey == part.p_partkey)
        return j.select(
            F.col("l_orderkey").alias("q_id"),
            (F.col("l_orderkey") * 10 + (F.col("equip_type_id") - 1) % 3).alias("qt_id"),
            F.concat(F.lit("S"), (F.col("l_suppkey") % 5).cast("string")).alias("site_name"),
            "equip_type_id", "equip_type_name",
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1)).alias("direction"),
        )

    @cached_property
    def vq(self) -> DataFrame:
        o = self._src("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        c = self._src("customer").select("c_custkey", "c_name")
        k = F.col("o_orderkey")
        lines = (o.join(c, o.o_custkey == c.c_custkey)
                 .withColumn("j", F.explode(F.sequence(F.lit(0), (k % 3).cast("int")))))
        return lines.select(
            k.alias("q_id"),
            (k * 10 + F.col("j")).alias("qt_id"),
            F.col("o_custkey").alias("ep_id"),
            F.col("c_name").alias("ep_name"),
            (k % 3).alias("quotation_type"),
            (F.lit(1) + F.col("j") + F.lit(3) * (_sql_div(k, 3) % 2)).alias("equip_type_id"),
            _by_mod(k % 4, EQUIP_QUANTITY_BY_MOD4).alias("equip_quantity"),
            (F.round(F.col("o_totalprice")).cast("bigint").cast("double") / F.lit(100.0)).alias("rent_daily"),
        )

    @cached_property
    def vq_equip(self) -> DataFrame:
        t2 = self.vq.where(F.col("quotation_type") == 2)
        return (t2.select("qt_id", F.lit(1).alias("quantity"))
                .unionAll(t2.where(F.col("equip_quantity") > 1)
                          .select("qt_id", (F.col("equip_quantity") - 1).alias("quantity"))))

    @cached_property
    def vq_wholesale(self) -> DataFrame:
        o = self._src("orders").select("o_orderkey", "o_orderdate").where(F.col("o_orderkey") % 3 == 0)
        k = F.col("o_orderkey")
        entry = F.col("o_orderdate").cast("date")
        return o.select((k * 10).alias("qt_id"), entry.alias("entry_date"),
                        F.date_add(entry, _by_mod(_sql_div(k, 3) % 4, WHOLESALE_DAYS_BY_MOD4)).alias("exit_date"))

    @cached_property
    def equip_dailycost(self) -> DataFrame:
        return self.equip_type.select(
            "equip_type_name",
            (F.lit(10.0) + F.lit(1.25) * F.col("equip_type_id")).alias("cost_day_std"))

    # -- invoices, parties, ledger ------------------------------------
    @cached_property
    def invoice(self) -> DataFrame:
        li = self._src("lineitem").select("l_orderkey", "l_shipdate", _cents(F.col("l_extendedprice")).alias("cents"))
        o = self._src("orders").select("o_orderkey", "o_custkey")
        cents = F.col("cents")
        vat_cents = _sql_div(cents * 6, 100)
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("l_orderkey").alias("q_id"), F.col("o_custkey").alias("client_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            (cents / F.lit(100.0)).alias("price"),
            (vat_cents / F.lit(100.0)).alias("vat"),
            ((cents + vat_cents) / F.lit(100.0)).alias("price_vat_total"))

    @cached_property
    def external_parties(self) -> DataFrame:
        c = self._src("customer").select(F.col("c_custkey").alias("ep_id"), F.col("c_name").alias("ep_name"),
                                         F.lit("client").alias("ep_type"))
        s = self._src("supplier").select((F.lit(1000000) + F.col("s_suppkey")).alias("ep_id"),
                                         F.col("s_name").alias("ep_name"), F.lit("supplier").alias("ep_type"))
        return c.unionAll(s)

    @cached_property
    def ep_bf(self) -> DataFrame:
        c = self._src("customer").select(F.col("c_custkey").alias("ep_id"), F.lit("MA1122").alias("ma_account_id"),
                                         F.col("c_acctbal").alias("amount"))
        s = self._src("supplier").select((F.lit(1000000) + F.col("s_suppkey")).alias("ep_id"),
                                         F.lit("MA2202").alias("ma_account_id"), (-F.col("s_acctbal")).alias("amount"))
        return c.unionAll(s)

    @cached_property
    def chart_of_accounts(self) -> DataFrame:
        n = self._src("nation").select(
            _account(F.col("n_nationkey")).alias("ma_account_id"), F.col("n_name").alias("ma_account_name"),
            F.when(F.col("n_nationkey") % 5 == 1, F.lit(1)).otherwise(F.lit(0)).alias("ap_ar"))
        r = self._src("region").where(F.col("r_regionkey") < 3).select(
            _case(F.col("r_regionkey"), [(0, "MA22210101"), (1, "MA22210102")], "MA2202").alias("ma_account_id"),
            F.col("r_name").alias("ma_account_name"),
            F.when(F.col("r_regionkey") == 2, F.lit(1)).otherwise(F.lit(0)).alias("ap_ar"))
        return n.unionAll(r)

    @cached_property
    def account_bf(self) -> DataFrame:
        n = self._src("nation").where(F.col("n_nationkey") % 7 != 3)
        return n.select(_account(F.col("n_nationkey")).alias("ma_account_id"),
                        (F.col("n_nationkey") * F.lit(1000.0)).alias("bf_amount"))

    @cached_property
    def bankstatement(self) -> DataFrame:
        o = self._src("orders").select(
            F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus",
            F.col("o_orderdate").cast("date").alias("date"),
            _cents(F.col("o_totalprice")).alias("cents"),
            F.when(_sql_div(F.col("o_orderkey"), 24) % 3 == 0, F.lit(-1)).otherwise(F.lit(1)).alias("sgn"))
        c = self._src("customer").select("c_custkey", "c_name")
        k = F.col("k")
        a = F.lit(1) + k % 24
        no_party = k % 7 == 0
        return o.join(c, o.o_custkey == c.c_custkey).select(
            "date",
            _account(a).alias("ma_account_id"),
            F.concat(F.lit("acct-"), a.cast("string")).alias("ma_account_name"),
            F.when(no_party, F.lit(None)).otherwise(F.col("o_custkey")).alias("ep_id"),
            F.when(no_party, F.lit(None)).otherwise(F.col("c_name")).alias("ep_name"),
            (F.col("sgn") * F.col("cents") / F.lit(100.0)).alias("amount"),
            F.when(k % 53 == 0, F.lit(None))
             .otherwise(F.col("sgn") * _sql_div(F.col("cents") * 6, 100) / F.lit(100.0)).alias("vat"),
            F.when(F.col("o_orderstatus") == "P", F.lit(1)).alias("is_cancelling"),
            (k % 8).alias("suggested_cf"),
            (k % 8).alias("cf_account_id"))

    @cached_property
    def aje(self) -> DataFrame:
        li = self._src("lineitem").where(F.col("l_returnflag") == "R").select(
            F.col("l_shipdate").cast("date").alias("date"), (F.col("l_partkey") % 25).alias("a"),
            "l_suppkey", "l_linestatus", _cents(F.col("l_extendedprice")).alias("cents"))
        final = F.col("l_linestatus") == "F"
        amt = F.col("cents") / F.lit(100.0)
        return li.select(
            "date", _account(F.col("a")).alias("ma_account_id"),
            F.concat(F.lit("acct-"), F.col("a").cast("string")).alias("ma_account_name"),
            F.when(F.col("l_suppkey") % 4 == 0, F.lit(None)).otherwise(F.lit(1000000) + F.col("l_suppkey")).alias("ep_id"),
            F.when(final, amt).alias("debit"),
            F.when(final, F.lit(None)).otherwise(amt).alias("credit"),
            F.when(final, amt).otherwise(-amt).alias("amount"))

    # -- payroll and fixed assets -------------------------------------
    @cached_property
    def payroll(self) -> DataFrame:
        c = self._src("customer").select(
            "c_custkey", (F.lit(1000000) + _cents(F.col("c_acctbal"))).alias("cents"))
        c = c.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(3))))
        cents = F.col("cents")

        def pct(p):
            return _sql_div(cents * p, 100) / F.lit(100.0)

        return c.select(
            F.col("c_custkey").alias("worker_id"), F.lit(2021).alias("year"), "month",
            (cents / F.lit(100.0)).alias("total_salary"),
            pct(3).alias("individual_income_tax"), pct(10).alias("social_security_employee"),
            pct(5).alias("house_tax"), pct(20).alias("social_security_employer"),
            _case(F.col("c_custkey") % 5, [(0, 1), (1, 0)]).alias("social_security_recoverable"))

    @cached_property
    def worker_info(self) -> DataFrame:
        c = self._src("customer").where(F.col("c_custkey") % 97 != 5)
        return c.select(F.col("c_custkey").alias("worker_id"),
                        F.when(F.col("c_custkey") % 89 == 0, F.lit(None).cast("string"))
                         .otherwise(F.col("c_mktsegment")).alias("department"))

    @cached_property
    def ppe_list(self) -> DataFrame:
        p = self._src("part").select("p_partkey", "p_size", "p_brand", _cents(F.col("p_retailprice")).alias("cents"))
        k = F.col("p_partkey")
        return p.select(
            F.concat(F.lit("C"), (F.col("p_size") % 3).cast("string")).alias("company"),
            F.col("p_brand").alias("ppe_user"),
            F.concat((F.lit(1994) + k % 6).cast("string"), F.lit("-"),
                     F.lpad((F.lit(1) + k % 12).cast("string"), 2, "0"), F.lit("-01")).alias("starting"),
            (F.col("cents") / F.lit(100.0)).alias("historical_cost"),
            (_sql_div(F.col("cents") * 5, 100) / F.lit(100.0)).alias("residual_value"),
            _by_mod(k % 5, PPE_LIFE_BY_MOD5).alias("life"))

    @cached_property
    def depr_alloc(self) -> DataFrame:
        p = self._src("part").where(F.col("p_brand") != "Brand#11").select(F.col("p_brand").alias("ppe_user")).distinct()
        return p.select("ppe_user", F.when(F.col("ppe_user") < "Brand#3", F.lit("MA560210"))
                        .otherwise(F.lit("MA540110")).alias("ma_account_id"))

    # -- report formats -------------------------------------------------
    @cached_property
    def report_mapping(self) -> DataFrame:
        a = F.col("ma_account_id")
        fp = (F.when(a < "MA11", "F1").when(a < "MA13", "F2").when(a.like("MA222%"), "F3")
              .when(a == "MA1462", F.lit(None)).otherwise("F4"))
        pl = F.when((a >= "MA12") & (a < "MA14"), "P1").when((a >= "MA14") & (a < "MA15"), "P2")
        return self.chart_of_accounts.select("ma_account_id", "ma_account_name", fp.alias("fp"), pl.alias("pl"))

    @cached_property
    def report_template(self) -> DataFrame:
        return self.spark.createDataFrame(REPORT_TEMPLATE_ROWS, REPORT_TEMPLATE_SCHEMA)

    @cached_property
    def cf_mapping(self) -> DataFrame:
        c = F.col("cf_account_id")
        return (self.bankstatement.select("cf_account_id").distinct()
                .select("cf_account_id", F.when(c < 3, "C1").when(c < 6, "C2").when(c == 6, "C3").alias("cf")))


_STORED: dict[tuple[str, str], "StoredBook"] = {}
# period reports filter by date, rent and cost group by contract
SORTED_BY = {"invoice": "date", "bankstatement": "date", "aje": "date", "relocation": "q_id"}
# business tables derived from other business tables: built from the stored parent
PARENTS = {"vq_equip": "vq", "equip_dailycost": "equip_type", "report_mapping": "chart_of_accounts",
           "cf_mapping": "bankstatement"}


def laid_out(name: str, df: DataFrame) -> DataFrame:
    """Table ``name`` as it is stored: each file sorted, so that scans skip its
    row groups and pages of other days. The rows stay in the tasks that derive
    them; dealing them by date range would shuffle the whole table once more."""
    return df.sortWithinPartitions(SORTED_BY[name]) if name in SORTED_BY else df


class StoredBook:
    """Business tables derived from the driver's tables and stored once.

    Like loading a schedule into the database before reporting: the first
    access of a table derives it, writes it as parquet under the session's
    checkpoint folder (shared storage) and every later report scans the
    stored table, with filter and column push-down. Only the tables a
    report touches are built; ``load_all`` builds all of them with
    concurrent writes.
    """

    NAMES = Book.NAMES

    def __init__(self, spark: SparkSession, sf_dir: str):
        from hirebook.session import scratch_path
        self.source_state = source_state(spark, sf_dir)
        self.spark = spark
        self.sf_dir = sf_dir
        self._root = scratch_path(spark, "book")
        self._derive = Book.from_testdata(spark, sf_dir)
        self._tables: dict[str, DataFrame] = {}
        self._building: dict[str, threading.Lock] = {}
        self._lock = threading.Lock()

    def table(self, name: str) -> DataFrame:
        with self._lock:
            if name in self._tables:
                return self._tables[name]
            name_lock = self._building.setdefault(name, threading.Lock())
        with name_lock:  # one thread builds a table, the others wait for it
            with self._lock:
                if name in self._tables:
                    return self._tables[name]
            parent = PARENTS.get(name)
            if parent is not None:
                # derive the child from the stored parent, not from raw tables
                self._derive.__dict__[parent] = self.table(parent)
            df = self._derive.table(name)
            path = f"{self._root}/{name}"
            laid_out(name, df).write.mode("overwrite").parquet(path)
            stored = self.spark.read.schema(df.schema).parquet(path)
            with self._lock:
                self._tables[name] = stored
            return stored

    def __getattr__(self, name: str) -> DataFrame:
        if name in Book.NAMES:
            return self.table(name)
        raise AttributeError(name)

    def load_all(self, workers: int = 8) -> "StoredBook":
        """Build every table; independent tables are written concurrently."""
        from concurrent.futures import ThreadPoolExecutor
        first = [n for n in Book.NAMES if n not in PARENTS]
        with ThreadPoolExecutor(max_workers=workers) as pool:
            list(pool.map(self.table, first))
            list(pool.map(self.table, list(PARENTS)))
        return self


def stored_book(spark: SparkSession, sf_dir: str) -> StoredBook:
    """The stored business tables of ``sf_dir`` for this session, derived
    anew when a source file has changed since."""
    from hirebook.session import session_id
    key = (session_id(spark), sf_dir)
    with _STORED_LOCK:
        held = _STORED.get(key)
        if held is None or held.source_state != source_state(spark, sf_dir):
            _STORED[key] = StoredBook(spark, sf_dir)
        return _STORED[key]


def source_state(spark: SparkSession, sf_dir: str) -> list[tuple] | None:
    """Names, sizes and times of the source files (None over Spark Connect,
    where the driver can't list them: then nothing counts as changed)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None
    where = jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)


_STORED_LOCK = threading.Lock()
