"""Rent, cost and profit from tables stored by contract.

Every report of rent and profit joins movements with quotation lines and sums
both per contract; on plain tables each period pays for those shuffles again.
The store deals them once: all its tables are bucketed by contract with one
number of buckets, so the reports' joins and sums run where the rows are, with
no exchange above any scan (a plan test asserts it with broadcasts off). By
default Spark shuffles a join on contract and line anew for fear of skew, so no
report has one: a quotation line is stored with its group quantity or stays,
and what a contract has by type (machine days, daily costs) is joined as one
list on the contract alone, from which a row takes its own. ``CONF`` is for
joins of a caller's own on contract and line.

A contract is one bucket, so what it may hold has to be bounded. Movements
are therefore stored as sums by contract, line, type, direction and day:
machine days up to a cut are linear in the quantity, so a day's quantity and
its quantity times time of day give what its single movements give. A contract
with a third of all movements is then as many rows as it has days, lines and
types; the sums that get there combine before their shuffle. A type's daily
cost is stored under the contracts that have it.

The store is a snapshot with one commit; a write that dies leaves the one before.

Nulls: a movement without a date or quantity counts nothing, as in ``rental``;
rows without a contract share a bucket. Cuts are dates; one
with a time of day would split a stored day and is refused. Movements with a
time of day are added exactly and divided once, ``rental`` rounds each to
10^-8 days first; plain dates give equal bits.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirebook.functions.expr import clamp0, date_lit, exact_sum, ratio, total
from hirebook.operators import profitability as PR
from hirebook.operators import rental as R
from hirebook.params import as_bound
from hirebook.sources.loaders import commit_snapshot, current_snapshot, next_snapshot

KEY = "q_id"
NONE = -(1 << 63)  # the contract of rows without one, in the store
CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
DAY_MICROS = 86_400_000_000
MOVED = (KEY, "qt_id", "equip_type_id", "equip_type_name", "direction")


@dataclass(frozen=True)
class ContractStore:
    """The tables of one snapshot, each bucketed by contract."""

    movement_days: DataFrame
    stays: DataFrame  # quotation lines: of type 0 a row a stay, of type 2 with the group's quantity
    type_cost: DataFrame
    parties: DataFrame


TABLES = tuple(ContractStore.__dataclass_fields__)


def movement_days(relocation: DataFrame) -> DataFrame:
    """Quantity by contract, line, type, direction and day; for timestamps
    also ``late``, the sum of quantity times microseconds since midnight."""
    day = F.to_date("date").alias("day")
    sums = [F.sum("quantity").alias("quantity")]
    if not isinstance(relocation.schema["date"].dataType, T.DateType):
        since = F.unix_micros(F.col("date").cast("timestamp")) - F.unix_micros(F.to_date("date").cast("timestamp"))
        sums.append(F.sum(since.cast("decimal(18,0)") * F.col("quantity").cast("decimal(18,0)")).cast("decimal(38,0)").alias("late"))
    return relocation.groupBy(*MOVED, day).agg(*sums)


def _lines(t: R.RentTables) -> DataFrame:
    """The quotation lines, each of type 0 next to its stays and of type 2
    next to its group's quantity (NULL without); lines of other types are no rent."""
    kind = F.col("quotation_type")
    lines = t.vq.select(KEY, "qt_id", "quotation_type", "equip_type_id", "equip_quantity", "rent_daily")
    parts = [lines.where(kind == 1), lines.where(kind == 2).join(R.quantity_by_quotation(t.vq_equip), "qt_id", "left"),
             lines.where(kind == 0).join(t.vq_wholesale.select("qt_id", "entry_date", "exit_date"), "qt_id", "left")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_contract_store(path: str, t: R.RentTables, equip_dailycost: DataFrame, buckets: int | None = None) -> str:
    """Store the tables at ``path`` as a new snapshot in one commit; its name.

    ``buckets``: by default the session's shuffle partitions. A line of group
    pricing that is moved under a contract that doesn't quote it is an error
    (its days can't be summed in one bucket); nothing is committed then.
    """
    if isinstance(t.relocation.schema["quantity"].dataType, (T.DoubleType, T.FloatType)):
        raise ValueError("quantities are whole numbers")
    spark = t.relocation.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = _qualified(spark, path)
    if not all(x.where(F.col(KEY) == NONE).isEmpty() for x in (t.relocation, t.vq)):
        raise ValueError(f"{NONE} stands for a missing contract")
    version, name = next_snapshot(spark, path)
    _write(movement_days(t.relocation), f"{path}/{name}", "movement_days", n)
    _write(_lines(t), f"{path}/{name}", "stays", n)
    moved = _read(spark, f"{path}/{name}", n, ("movement_days",))["movement_days"]
    named = moved.select(KEY, "equip_type_name").distinct()  # where the rows are
    _write(named.join(equip_dailycost.select("equip_type_name", "cost_day_std"), "equip_type_name"), f"{path}/{name}", "type_cost", n)
    _write(t.vq.select(KEY, "ep_id", "ep_name").distinct(), f"{path}/{name}", "parties", n)
    lines = _read(spark, f"{path}/{name}", n, ("stays",))["stays"]
    quoted = lines.where("quotation_type = 2").select(F.col(KEY).alias("quoted_q_id"), F.col("qt_id").alias("line")).distinct()
    stray = (moved.select(KEY, "qt_id").distinct().join(quoted, F.col("qt_id") == F.col("line"))
             .where(F.col(KEY) != F.col("quoted_q_id")).select("qt_id").first())
    if stray:
        raise ValueError(f"line {stray[0]} is moved under a contract that doesn't quote it")
    return commit_snapshot(spark, path, version, name, [_folder(x, n) for x in TABLES])


def read_contract_store(spark: SparkSession, path: str) -> ContractStore:
    """The last committed store at ``path``."""
    root, tables = current_snapshot(spark, _qualified(spark, path))
    counts = {x.rpartition("-")[2] for x in tables}
    if len(counts) != 1 or {x.rpartition("-")[0] for x in tables} != set(TABLES):
        raise ValueError(f"no contract store at {path}")
    return ContractStore(**_read(spark, root, int(counts.pop())))


def _folder(table: str, buckets: int) -> str:
    return f"{table}-{buckets}"


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme, since a table's relative location would be the warehouse's."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return path.rstrip("/")
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def _table(path: str) -> str:
    """A name of its own for every stored table in the session's catalog."""
    return f"contract_store_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _write(df: DataFrame, root: str, table: str, buckets: int) -> None:
    path = f"{root}/{_folder(table, buckets)}"
    # a join finds a missing contract too; dealt as the buckets are: one file a bucket
    (df.withColumn(KEY, F.coalesce(KEY, F.lit(NONE))).repartition(buckets, KEY).write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path)
     .saveAsTable(_table(path)))


def _read(spark: SparkSession, root: str, buckets: int, tables: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    found = {}
    for table in tables:
        path = f"{root}/{_folder(table, buckets)}"
        if not spark.catalog.tableExists(_table(path)):  # written by another session
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
            where = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"CREATE TABLE {_table(path)} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                      f"INTO {buckets} BUCKETS LOCATION '{where}'")
        found[table] = spark.table(_table(path))
    return found


def _days_up_to(moved: DataFrame, cut, signed: bool) -> Column:
    """Machine days that a stored day's movements have gathered by ``cut``."""
    if isinstance(as_bound(cut), _dt.datetime):
        raise ValueError("cuts of stored days are dates")
    sign = F.col("direction") if signed else F.lit(1)
    quantity = F.col("quantity") * sign
    if "late" not in moved.columns:
        return clamp0(F.datediff(date_lit(cut), F.col("day"))) * quantity
    micros = F.unix_micros(date_lit(cut).cast("timestamp")) - F.unix_micros(F.col("day").cast("timestamp"))
    before = micros.cast("decimal(20,0)") * F.col("quantity").cast("decimal(18,0)") - F.col("late")
    return F.when(micros > 0, before.cast("double") / F.lit(float(DAY_MICROS)) * sign).when(micros <= 0, quantity * F.lit(0.0))


def _summary(store: ContractStore, start, end, signed: bool = False) -> DataFrame:
    moved = store.movement_days
    return R.machine_days_summary(moved.select("*", _days_up_to(moved, start, signed).alias(R.BF_COL), _days_up_to(moved, end, signed).alias(R.CF_COL)))


def _known(df: DataFrame) -> DataFrame:
    """Rows without a contract say so again."""
    return df.withColumn(KEY, F.nullif(F.col(KEY), F.lit(NONE)))


def _listed(of: DataFrame) -> DataFrame:
    """The rows of ``of``, which has a few a contract, as one list a contract."""
    return of.groupBy(F.col(KEY).alias("of_q_id")).agg(F.collect_list(F.struct(*[c for c in of.columns if c != KEY])).alias("listed"))


def _left(df: DataFrame, of: DataFrame, key: str, mine: Column) -> DataFrame:
    """Left join with the rows of ``of`` under the same contract whose ``key`` is ``mine``."""
    own = F.when(mine.isNotNull(), F.filter("listed", lambda x: x[key] == mine))
    j = df.join(_listed(of), F.col(KEY) == F.col("of_q_id"), "left")
    return j.select(*df.columns, F.explode_outer(own).alias("own")).select(*df.columns, "own.*")


def _rent(store: ContractStore, start, end, kinds: tuple[int, ...], truncate: bool) -> DataFrame:
    """R5 to R7 of the named pricing types in one pass over the lines.

    Each join is on the contract, then on a key that only lines of its type have.
    """
    kind = F.col("quotation_type")
    j = store.stays.where(kind.isin(*kinds))
    revenue, type_name = F.lit(None).cast("double"), F.lit(None).cast("string")
    if 0 in kinds:
        entry, exit_ = F.col("entry_date"), F.col("exit_date")

        def left_after(day):
            return F.when(day.isNotNull(), F.datediff(date_lit(end), F.least(F.greatest(day, date_lit(start)), date_lit(end))))

        j = j.select("*", (left_after(entry) - left_after(exit_)).alias("days"), F.datediff(exit_, entry).alias("totaldays"))
        revenue = F.when(kind == 0, ratio(j, "rent_daily", "totaldays", truncate) * F.col("days")).otherwise(revenue)
    if {1, 2} & set(kinds):
        summary = _summary(store, start, end)
    if 1 in kinds:
        of_type = summary.select(KEY, F.col("equip_type_id").alias("moved_type"), "equip_type_name", F.col(R.PERIOD_DAYS).alias("type_days"))
        j = _left(j, of_type, "moved_type", F.when((kind == 1) & (F.col(KEY) != NONE), F.col("equip_type_id")))
        revenue = F.when(kind == 1, ratio(j, "rent_daily", "equip_quantity", truncate) * F.col("type_days")).otherwise(revenue)
        type_name = F.col("equip_type_name")
    if 2 in kinds:
        combined = summary.groupBy(KEY, F.col("qt_id").alias("moved")).agg(total(summary, R.PERIOD_DAYS).alias("line_days"))
        j = _left(j, combined, "moved", F.when(kind == 2, F.col("qt_id"))).where((kind != 2) | F.col("moved").isNotNull())
        revenue = F.when(kind == 2, F.col("line_days") * ratio(j, "rent_daily", "sumofquantity", truncate)).otherwise(revenue)
    return j.select(KEY, "qt_id", "equip_type_id", type_name.alias("equip_type_name"), revenue.alias(R.REVENUE))


def machine_days_summary(store: ContractStore, start, end, signed: bool = False) -> DataFrame:
    """R2 as ``rental.machine_days_summary``."""
    return _known(_summary(store, start, end, signed))


def rent_type0(store: ContractStore, start, end, truncate: bool = False) -> DataFrame:
    """R5 as ``rental.rent_type0``; equal lines are counted in their bucket and given as often."""
    lines = _rent(store, start, end, (0,), truncate).groupBy(KEY, "qt_id", R.REVENUE).agg(F.count("*").cast("int").alias("times"))
    return _known(lines.select(KEY, "qt_id", R.REVENUE, F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("i")).drop("i"))


def rent_type1(store: ContractStore, start, end, truncate: bool = False) -> DataFrame:
    """R6 as ``rental.rent_type1``."""
    return _known(_rent(store, start, end, (1,), truncate))


def rent_type2(store: ContractStore, start, end, truncate: bool = False) -> DataFrame:
    """R7 as ``rental.rent_type2``, by contract and line (a line is moved
    under its own contract only, which the write has checked)."""
    return _known(_rent(store, start, end, (2,), truncate).select(KEY, "qt_id", R.REVENUE))


def _accrued(store: ContractStore, start, end, distinct: bool, truncate: bool) -> DataFrame:
    u = _rent(store, start, end, (0, 1, 2), truncate).select(KEY, "qt_id", R.REVENUE)
    return u.distinct() if distinct else u


def accrued_revenue(store: ContractStore, start, end, distinct: bool = True, truncate: bool = False) -> DataFrame:
    """R8/R9 as ``rental.accrued_revenue``."""
    return _known(_accrued(store, start, end, distinct, truncate))


def _cost(store: ContractStore, start, end) -> DataFrame:
    costs = store.type_cost.select(KEY, F.col("equip_type_name").alias("c_type_name"), "cost_day_std")
    j = _left(_summary(store, start, end), costs, "c_type_name", F.col("equip_type_name"))
    cost = j.select(KEY, (F.col("cost_day_std") * F.col(R.PERIOD_DAYS)).alias(R.STD_COST))
    return cost.groupBy(KEY).agg(exact_sum(R.STD_COST).alias(R.STD_COST))


def std_cost_by_contract(store: ContractStore, start, end) -> DataFrame:
    """R12 as ``rental.std_cost_by_contract``, with the daily cost of the store."""
    return _known(_cost(store, start, end))


def contract_profitability(store: ContractStore, start, end, literal_id: bool = True) -> DataFrame:
    """P1 as ``profitability.contract_profitability``."""
    rev = _accrued(store, start, end, True, False).groupBy(F.col(KEY).alias("revenue_q_id")).agg(exact_sum(R.REVENUE).alias("Revenue"))
    known = F.col(KEY) != NONE  # a missing contract has neither cost nor party
    cost = _cost(store, start, end).where(known).select(F.col(KEY).alias("cost_q_id"), R.STD_COST)
    parties = store.parties.where(known).select(F.col(KEY).alias("party_q_id"), "ep_id", "ep_name")
    return _known(PR.per_contract(rev, cost, parties, literal_id))
