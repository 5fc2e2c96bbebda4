"""Registered queries over files and warehouse tables (SRC-5..SRC-8, SRC-12..SRC-22, INC-6, INC-7).

Each writes rows of the given tables as text, CSV or warehouse tables to a new folder below the
shared one, runs the readers and sinks on it and returns what they give back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldgap.operators.buckets import BucketedTable
from fieldgap.plans import reports
from fieldgap.session import scratch_path
from fieldgap.sources.feeds import read_feed, read_seed, write_csv
from fieldgap.sources.landing import land_flat_files
from fieldgap.sources.positional import FlatFileSpec, content_fingerprint
from fieldgap.sources.store import Warehouse, sources_to_reload
from fieldgap.workload.portable import portable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ORDER_COLUMNS = ("order_key", "customer_key", "status", "clerk", "priority")
OPEN, CLOSED = "orders_open", "orders_closed"
SPECS = [FlatFileSpec(name, "orders", ORDER_COLUMNS, frozenset({"clerk"})) for name in (OPEN, CLOSED)]
#: The rows of the two files.
FILES = {OPEN: "o_orderstatus <> 'F'", CLOSED: "o_orderstatus = 'F'"}
LANDED = "select o_orderkey::varchar as order_key, o_custkey::varchar as customer_key, o_orderstatus as status, o_orderpriority as priority"


def _query(sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = lambda spark, sf: portable(query(spark, sf))
        ORACLE[query.__name__] = sql
        return query

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


class Deliveries:
    """A new warehouse and the files that arrive for it."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.root = spark, scratch_path(spark, "deliveries")
        self.orders = _table(spark, sf, "orders")
        self.warehouse = Warehouse(spark, f"{self.root}/warehouse")
        self.paths: dict[str, str] = {}
        self.count = 0

    def deliver(self, source: str, rows: str) -> None:
        """The orders that a condition selects, as a tab-separated file of a source."""
        path = f"{self.root}/files/{source}-{self.count}"
        self.count += 1
        cells = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus")]
        line = F.concat_ws("\t", *cells, F.lit("private"), F.col("o_orderpriority"))
        self.orders.where(rows).select(line.alias("value")).write.text(path)
        self.paths[source] = path

    def deliver_all(self) -> None:
        for source, rows in FILES.items():
            self.deliver(source, rows)

    def land(self, force: bool = False) -> None:
        land_flat_files(self.spark, self.warehouse, SPECS, self.paths, force)

    def landed(self) -> DataFrame:
        return self.warehouse.read("bronze.orders").select("order_key", "customer_key", "status", "priority", "_source")


@_query(
    f"{LANDED}, case when o_orderstatus = 'F' then '{CLOSED}' else '{OPEN}' end as _source from orders "
    "where o_orderstatus = 'F' or o_orderkey % 2 = 0"
)
def replaced_source(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-5, INC-6: a corrected file replaces the rows of its source and no others."""
    d = Deliveries(spark, sf)
    d.deliver_all()
    d.land()
    d.deliver(OPEN, f"{FILES[OPEN]} and o_orderkey % 2 = 0")
    d.land()
    return d.landed()


_ATTEMPTS = f"""with n as (select '{CLOSED}' as source, count(*) filter (o_orderstatus = 'F') as whole,
             count(*) filter (o_orderstatus = 'F') as later from orders
      union all select '{OPEN}', count(*) filter (o_orderstatus <> 'F'), count(*) filter (o_orderstatus <> 'F' and o_orderkey % 2 = 0) from orders)
    select source, unnest([1, 2, 3, 4]) as attempt,
           unnest(['loaded', 'unchanged', case source when '{OPEN}' then 'loaded' else 'unchanged' end, 'loaded']) as status,
           unnest([whole, 0, case source when '{OPEN}' then later else 0 end, later]) as rows_loaded,
           unnest([5, 0, case source when '{OPEN}' then 5 else 0 end, 5]) as columns_seen, 5 as columns_expected from n"""


def _four_landings(d: Deliveries) -> DataFrame:
    """The manifest of a first landing, the same files again, one corrected file, a forced reload."""
    d.deliver_all()
    d.land()
    d.land()
    d.deliver(OPEN, f"{FILES[OPEN]} and o_orderkey % 2 = 0")
    d.land()
    d.land(force=True)
    return d.warehouse.log("meta.ingest_manifest")


@_query(_ATTEMPTS)
def load_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-6, SRC-7, INC-7: what each landing did, by source and attempt."""
    manifest = _four_landings(Deliveries(spark, sf))
    attempt = F.row_number().over(Window.partitionBy("source").orderBy("loaded_at"))
    return manifest.select("source", attempt.alias("attempt"), "status", "rows_loaded", "columns_seen", "columns_expected")


@_query(f"select source, status, rows_loaded, columns_seen, columns_expected, true as truncated from ({_ATTEMPTS}) where attempt > 2")
def load_history(spark: SparkSession, sf: str) -> DataFrame:
    """Q-11: the newest four of eight load attempts, and that there are more."""
    rows, more = reports.load_history(_four_landings(Deliveries(spark, sf)), 4)
    truncated = more.select("truncated").scalar()
    return rows.select("source", "status", "rows_loaded", "columns_seen", "columns_expected", truncated.alias("truncated"))


@_query(
    f"select '{OPEN}' as source, 'lost' as found, 0 as stored from orders having count(*) > 0 "
    f"union all select '{OPEN}', 'reloaded', count(*) from orders where o_orderstatus <> 'F'"
)
def reloaded_after_loss(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-8: a source whose rows are gone is found, and its unchanged file is loaded again."""
    d = Deliveries(spark, sf)
    d.deliver_all()
    d.land()
    wh = d.warehouse
    wh.replace_source("bronze.orders", OPEN, wh.read("bronze.orders").limit(0))
    lost = sources_to_reload(wh.latest_loads(), wh.read("bronze.orders"))
    lost = lost.select("source", F.lit("lost").alias("found"), F.lit(0).cast("bigint").alias("stored"))
    d.land()
    stored = d.landed().where(F.col("_source") == OPEN).agg(F.count("*").alias("stored"))
    return lost.unionByName(stored.select(F.lit(OPEN).alias("source"), F.lit("reloaded").alias("found"), "stored"))


@_query(
    "select count(*) as lines, true as same_in_other_order, false as same_after_one_cell, false as same_without_one_line from part"
)
def fingerprint_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-6: the fingerprint of lines does not depend on their order, but on every cell and line."""
    part = _table(spark, sf, "part")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand")
    first = part.agg(F.min("p_partkey").alias("k"))
    marked = part.join(first, part["p_partkey"] == first["k"], "left")
    changed = F.when(F.col("k").isNotNull(), F.concat(line, F.lit("x"))).otherwise(line)

    runs = {
        "plain": part.select(line.alias("value")),
        "turned": part.repartition(5, "p_name").sortWithinPartitions(F.desc("p_partkey")).select(line.alias("value")),
        "other": marked.select(changed.alias("value")),
        "fewer": marked.where("k is null").select(line.alias("value")),
    }
    seen = [content_fingerprint(lines).select(F.lit(run).alias("run"), "rows_seen", "fingerprint") for run, lines in runs.items()]

    def of(run: str, column: str) -> Column:
        return F.max(F.when(F.col("run") == run, F.col(column)))

    together = reduce(DataFrame.unionByName, seen).agg(
        of("plain", "rows_seen").alias("lines"), *[of(run, "fingerprint").alias(run) for run in runs]
    )
    same = {"same_in_other_order": "turned", "same_after_one_cell": "other", "same_without_one_line": "fewer"}
    return together.select("lines", *[(F.col("plain") == F.col(run)).alias(name) for name, run in same.items()])


BUCKETS = 64


@_query(
    """select o_orderkey as order_key, case when o_orderkey % 997 = 3 then o_custkey + 1 else o_custkey end as customer_key,
    case when o_orderkey % 997 = 3 then 'late' else o_orderpriority end as priority from orders
    union all select -1, 0, 'new'"""
)
def bucket_replace(spark: SparkSession, sf: str) -> DataFrame:
    """INC-1: corrected orders and a new one replace theirs in a bucketed table, bucket by bucket."""
    orders = _table(spark, sf, "orders")
    rows = orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("priority"))
    held = BucketedTable(spark, scratch_path(spark, "bucketed"), ["order_key"], BUCKETS)
    held.create(rows)
    corrected = rows.where("order_key % 997 = 3").select("order_key", (F.col("customer_key") + 1).alias("customer_key"), F.lit("late").alias("priority"))
    fresh = spark.range(1).select(F.lit(-1).alias("order_key"), F.lit(0).alias("customer_key"), F.lit("new").alias("priority"))
    held.replace_keys(corrected.unionByName(fresh))
    return held.read()


@_query(
    """with l as (
      select l_orderkey, l_linenumber, l_returnflag from lineitem
      union all select l_orderkey, 99, 'Z' from lineitem where l_orderkey % 997 = 3 and l_linenumber = 1
    ) select l_orderkey as order_key, count(*) as lines, count(distinct l_returnflag) as modes, max(l_linenumber)::bigint as last_line
    from l group by l_orderkey"""
)
def bucket_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """INC-2: lines arrive late; the facts of their orders are built anew from all lines of these orders."""
    lines = _table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").cast("long").alias("line"), F.col("l_returnflag").alias("mode"))
    late = lines.where("order_key % 997 = 3 and line = 1").select("order_key", F.lit(99).cast("long").alias("line"), F.lit("Z").alias("mode"))

    def facts(rows: DataFrame) -> DataFrame:
        return rows.groupBy("order_key").agg(
            F.count("*").alias("lines"), F.count_distinct("mode").alias("modes"), F.max("line").alias("last_line")
        )

    landed, built = (BucketedTable(spark, scratch_path(spark, name), ["order_key"], BUCKETS) for name in ("lines", "facts"))
    landed.create(lines)
    built.create(facts(landed.read()))
    arrived = lines.join(late.select("order_key"), "order_key", "left_semi").unionByName(late)
    landed.replace_keys(arrived)
    built.rebuild_keys(late, landed, facts)
    return built.read()


FEED_COLUMNS = ["part_number", "name", "note", "remark"]


def _feed_cells() -> list[Column]:
    key = F.col("p_partkey")
    return [
        key.cast("string"),
        F.concat(F.lit(" "), F.col("p_name")),
        F.when(key % 3 == 0, F.concat(F.lit('a "quoted", note\nof '), F.col("p_brand"))).when(key % 3 == 1, F.lit("")),
        F.when(key % 2 == 0, F.lit("N/A")),
    ]


@_query(
    """select p_partkey::varchar as part_number, ' ' || p_name as name,
    case when p_partkey % 3 = 0 then 'a "quoted", note' || chr(10) || 'of ' || p_brand else '' end as note,
    case when p_partkey % 2 = 0 then 'N/A' else '' end as remark, row_number() over (order by p_partkey) as position from part"""
)
def feed_file(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-12, SRC-18: a sorted export and the feed read from it, cell by cell and in file order."""
    path = scratch_path(spark, "feed")
    cells = [c.alias(n) for c, n in zip(_feed_cells(), FEED_COLUMNS, strict=True)]
    write_csv(_table(spark, sf, "part").orderBy("p_partkey").select(*cells), path)
    feed = read_feed(spark, path, FEED_COLUMNS)
    # Positions follow the file order; they are compared with it without ordering all rows in one task.
    held = feed.withColumn("block", F.floor(F.col("part_number").cast("bigint") / 1000))
    before = held.groupBy("block").agg(F.count("*").alias("n"))
    blocks = before.withColumn("base", F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.row_number().over(Window.partitionBy("block").orderBy("_ordinal"))
    placed = held.withColumn("inside", inside).join(blocks.select("block", "base"), "block")
    return placed.select(*FEED_COLUMNS, (F.coalesce("base", F.lit(0)) + F.col("inside")).alias("position"))


@_query(
    "select s_suppkey, s_name, s_nationkey, cast(s_acctbal as double) as s_acctbal, s_acctbal < 0 as in_debt from supplier"
)
def typed_seed(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-13: a CSV read with its declared types."""
    path = scratch_path(spark, "seed")
    suppliers = _table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", (F.col("s_acctbal") < 0).alias("in_debt"))
    write_csv(suppliers, path)
    return read_seed(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double, in_debt boolean")


@_query("select c_mktsegment as segment, count(*) as customers from customer where c_custkey % 2 = 0 group by 1")
def replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-14: a table is replaced whole, also by rows derived from its own former version."""
    wh = Warehouse(spark, scratch_path(spark, "replaced"))
    first = wh.replace("bronze.customers", _table(spark, sf, "customer"))
    wh.replace("bronze.customers", first.where("c_custkey % 2 = 0"))
    return wh.read("bronze.customers").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("customers"))


@_query(
    "select 'orders' as name, count(*) as rows_current from orders union all "
    "select 'lines', count(*) from lineitem union all select 'metrics', count(distinct o_orderstatus) from orders"
)
def joint_publish(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-15: tables and metrics become current together; of a publish that fails nothing does."""
    wh = Warehouse(spark, scratch_path(spark, "joint"))
    orders, lines = _table(spark, sf, "orders"), _table(spark, sf, "lineitem")
    metrics = orders.groupBy("o_orderstatus").count()
    wh.publish({"silver.orders": orders, "silver.lines": lines, "silver.metrics": metrics})
    broken = lines.withColumn("l_quantity", F.raise_error(F.lit("broken delivery")).cast("double"))
    try:
        wh.publish({"silver.orders": orders.limit(0), "silver.lines": broken})
    except PySparkException as err:
        if "broken delivery" not in str(err):
            raise
    counted = [wh.read(f"silver.{n}").agg(F.lit(n).alias("name"), F.count("*").alias("rows_current")) for n in ("orders", "lines", "metrics")]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@_query(
    "select 'first' as run, o_orderstatus as status, count(*) as n from orders group by 2 "
    "union all select 'second', o_orderstatus, count(*) from orders where o_orderkey % 2 = 0 group by 2"
)
def run_metrics_log(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-16: metrics of two runs in one append-only table."""
    wh = Warehouse(spark, scratch_path(spark, "metrics"))
    orders = _table(spark, sf, "orders")
    for run, rows in (("first", orders), ("second", orders.where("o_orderkey % 2 = 0"))):
        counts = rows.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
        wh.append("meta.run_metrics", counts.withColumn("run", F.lit(run)))
    return wh.log("meta.run_metrics").select("run", "status", "n")


@_query(
    """select 'view' as kept_as, count(*) as n, sum(o_custkey)::bigint as keys from orders
    union all select 'table', count(*), sum(o_custkey)::bigint from orders where o_orderkey % 2 = 0
    union all select 'incremental', count(*), sum(case when o_orderkey % 2 = 0 then 0 else o_custkey end)::bigint from orders"""
)
def kept_models(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-17: one model as a view, as a replaced table and as a table that changed rows are put into."""
    wh = Warehouse(spark, scratch_path(spark, "kept"))
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    even = orders.where("o_orderkey % 2 = 0")
    kept = {"view": wh.materialize("staging.kept_view", orders, "view")}
    wh.materialize("marts.kept", orders, "table")
    kept["table"] = wh.materialize("marts.kept", even, "table")
    wh.materialize("marts.kept_keyed", orders, "incremental", ["o_orderkey"])
    kept["incremental"] = wh.materialize("marts.kept_keyed", even.withColumn("o_custkey", F.lit(0).cast("bigint")), "incremental", ["o_orderkey"])
    counted = [
        df.agg(F.lit(name).alias("kept_as"), F.count("*").alias("n"), F.sum("o_custkey").alias("keys")) for name, df in kept.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@_query("select n_name as nation, count(*) as suppliers from supplier join nation on n_nationkey = s_nationkey group by 1")
def registered_views(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-19: current versions as relations of a SQL statement."""
    wh = Warehouse(spark, scratch_path(spark, "views"))
    wh.publish({"bronze.kept_supplier": _table(spark, sf, "supplier"), "bronze.kept_nation": _table(spark, sf, "nation")})
    wh.register_views()
    return spark.sql(
        "select n_name as nation, count(*) as suppliers from kept_supplier join kept_nation on n_nationkey = s_nationkey group by 1"
    )


@_query(
    "select 'bronze.orders' as name, true as known, count(*) as n from orders union all "
    "select 'bronze.lines', false, 0 union all select 'bronze.nothing', true, 0"
)
def known_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-21: which tables the warehouse has; an empty one exists."""
    wh = Warehouse(spark, scratch_path(spark, "known"))
    orders = _table(spark, sf, "orders")
    wh.publish({"bronze.orders": orders, "bronze.nothing": orders.limit(0)})

    def state(name: str) -> DataFrame:
        rows = wh.read_or_none(name) if wh.exists(name) else None
        counted = (orders.limit(0) if rows is None else rows).agg(F.count("*").alias("n"))
        return counted.select(F.lit(name).alias("name"), F.lit(rows is not None).alias("known"), "n")

    return state("bronze.orders").unionByName(state("bronze.lines")).unionByName(state("bronze.nothing"))


@_query(
    "select c_custkey as key, c_name as name, c_acctbal as balance, 'customer' as kind from customer "
    "union all select s_suppkey, s_name, null, 'supplier' from supplier"
)
def inserted_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-22: an empty table of a query's columns; rows go in by name, columns they lack are null."""
    wh = Warehouse(spark, scratch_path(spark, "inserted"))
    customers = _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind")
    )
    suppliers = _table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    wh.replace("bronze.partners", customers.limit(0))
    wh.insert_by_name("bronze.partners", customers.select("kind", "balance", "name", "key"))
    wh.insert_by_name("bronze.partners", suppliers)
    return wh.read("bronze.partners")
