"""Registered queries that run the generic operators on the given tables directly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.functions.aggregates import (
    count_where,
    distinct_list,
    distinct_tuples,
    distinct_where,
    max_by_present,
    mean,
    min_by_present,
    ratio,
)
from fieldgap.functions.scalars import (
    all_of,
    banded,
    compact_date,
    iso_date,
    month_of,
    months_before,
    number_or,
    tolerant_int,
)
from fieldgap.functions.text import (
    collapse_spaces,
    fully_matches,
    joined_key,
    make_name_key,
    model_name_key,
    path_key,
    path_level,
    word_prefixes,
    yes_flag,
)
from fieldgap.operators.checks import RelationTest, RowTest, UniqueTest, run_checks
from fieldgap.operators.collapse import collapse
from fieldgap.operators.compare import result_equivalent
from fieldgap.operators.conform import attach_conformed, conform_names, conformance_rates
from fieldgap.operators.contract import Check, apply_contract, feed_metrics, quarantined_rows, valid_rows
from fieldgap.operators.dedup import best_candidate, flag_repeats, latest_per_key, latest_row, most_frequent
from fieldgap.operators.gap import coverage_gap, group_median
from fieldgap.operators.incremental import (
    current_with_versions,
    first_versions,
    keyed_replace,
    next_history,
    rows_after,
    rows_of_touched_keys,
)
from fieldgap.operators.merge import full_outer_merge, kpi_row, lookup, orphans, scalar_of
from fieldgap.operators.profile import profile
from fieldgap.operators.ranges import explode_range, islands, range_row_count
from fieldgap.operators.ranking import (
    capped,
    keep_top_groups,
    on_domain,
    pivot_counts,
    rank_within,
    top_k,
    with_share,
)
from fieldgap.operators.sampling import hash_sample, hash_sample_groups, redact
from fieldgap.session import small_table
from fieldgap.workload.portable import portable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def _query(sql: str | None = None):
    """Register the function under its name, with the DuckDB statement if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, sf: portable(build(Tables(spark, sf)))
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build

    return register


def _n():
    return F.count(F.lit(1))


# ------------------------------------------------------------------- collapse and bridge
@_query(
    """select o_orderstatus, count(*) as orders, cast(sum(n_lines) as bigint) as n_lines,
    round(sum(total), 2) as total_once, round(sum(total * n_lines), 2) as total_per_line
    from (select o.o_orderkey, o.o_orderstatus, max(o.o_totalprice) as total, count(*) as n_lines
          from orders o join lineitem l on l.l_orderkey = o.o_orderkey group by 1, 2) group by 1"""
)
def header_collapse_total(t: Tables) -> DataFrame:
    """DIM-3, A-7: a header value repeated on every line counts once per header."""
    lines = t.lineitem.groupBy("l_orderkey").agg(_n().alias("n_lines"))
    per_order = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    headers = collapse(
        per_order, ["o_orderkey", "o_orderstatus"], {"total": F.max("o_totalprice"), "n_lines": F.max("n_lines")}
    )
    return headers.groupBy("o_orderstatus").agg(
        _n().alias("orders"),
        F.sum("n_lines").alias("n_lines"),
        F.round(F.sum("total"), 2).alias("total_once"),
        F.round(F.sum(F.col("total") * F.col("n_lines")), 2).alias("total_per_line"),
    )


@_query(
    """select l_orderkey, bool_or(l_returnflag = 'R') as any_returned, max(l_quantity) as most, count(distinct l_partkey) as parts,
    min(l_shipdate::date)::varchar as first_ship, bool_or(l_returnflag = 'R') or max(l_quantity) > 45 as noteworthy
    from lineitem group by 1"""
)
def line_to_header_flags(t: Tables) -> DataFrame:
    """FCT-1, A-2, A-8: flags and extremes per header."""
    returned = F.bool_or(F.col("l_returnflag") == "R")
    return collapse(
        t.lineitem,
        ["l_orderkey"],
        {
            "any_returned": returned,
            "most": F.max("l_quantity"),
            "parts": F.count_distinct("l_partkey"),
            "first_ship": F.min(F.to_date("l_shipdate")),
            "noteworthy": returned | (F.max("l_quantity") > 45),
        },
    )


@_query(
    """select distinct l.l_orderkey as order_key, md5(upper(trim(p.p_type))) as type_key from lineitem l
    join part p on p.p_partkey = l.l_partkey"""
)
def bridge_order_type(t: Tables) -> DataFrame:
    """FCT-2, A-16: distinct header x category pairs."""
    types = t.part.select(F.col("p_partkey").alias("l_partkey"), path_key(F.col("p_type")).alias("type_key"))
    pairs = t.lineitem.select("l_orderkey", "l_partkey").join(types, "l_partkey")
    return pairs.select(F.col("l_orderkey").alias("order_key"), "type_key").distinct()


@_query(
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate desc, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1"""
)
def dedup_latest_line(t: Tables) -> DataFrame:
    """W-1: the newest version per key, in a total order."""
    order = [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    return latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


# ------------------------------------------------------------------------ names and keys
@_query(
    r"""select p_partkey, trim(regexp_replace(upper(coalesce(p_name || '-' || p_brand, '')), '[^A-Z0-9]+', ' ', 'g')) as name_key,
    trim(regexp_replace(upper(coalesce('  ' || p_type || chr(9) || ' x ', '')), '\s+', ' ', 'g')) as make_key,
    md5(concat_ws('|', p_brand, nullif(p_type, 'PROMO'), cast(p_size as varchar))) as joined,
    md5(upper(trim(' ' || p_name))) as path_hash, split_part(p_name || ':' || p_type, ':', 2) as second_level,
    split_part(p_name, ':', 3) as third_level, upper(coalesce(nullif(left(p_type, 1), 'S'), 'N')) in ('Y', 'YES', 'P') as flagged,
    starts_with(p_name, 'red ') as is_red, length(p_name) as name_length, regexp_matches(p_brand, '2[0-9]') as brand_20s,
    regexp_full_match(p_brand, 'Brand#[0-9]{2}') as brand_two_digits,
    regexp_replace(p_brand, '^Brand#([0-9]+)$', 'B-\1') as short_brand from part"""
)
def normalize_names(t: Tables) -> DataFrame:
    """F-1, F-2, F-4..F-7, F-11..F-15, F-26."""
    name, kind = F.col("p_name"), F.col("p_type")
    first = F.nullif(F.substring(kind, 1, 1), F.lit("S"))
    return t.part.select(
        "p_partkey",
        model_name_key(F.concat(name, F.lit("-"), F.col("p_brand"))).alias("name_key"),
        make_name_key(F.concat(F.lit("  "), kind, F.lit("\t x "))).alias("make_key"),
        joined_key(F.col("p_brand"), F.nullif(kind, F.lit("PROMO")), F.col("p_size")).alias("joined"),
        path_key(F.concat(F.lit(" "), name)).alias("path_hash"),
        path_level(F.concat(name, F.lit(":"), kind), 2).alias("second_level"),
        path_level(name, 3).alias("third_level"),
        (yes_flag(first) | F.coalesce(first == "P", F.lit(False))).alias("flagged"),
        F.startswith(name, F.lit("red ")).alias("is_red"),
        F.length(name).alias("name_length"),
        F.rlike("p_brand", F.lit("2[0-9]")).alias("brand_20s"),
        fully_matches(F.col("p_brand"), "Brand#[0-9]{2}").alias("brand_two_digits"),
        F.regexp_replace("p_brand", r"^Brand#([0-9]+)$", r"B-$1").alias("short_brand"),
    )


_ALIASES = [("STANDARD", "Regular"), ("STD", "Regular"), ("PROMO", "Offer"), ("LARGE", "Big"), ("MEDIUM", "Mid")]


@_query(
    f"""select p.p_partkey, coalesce(a.canon, 'Unmapped') as category, a.canon is not null as mapped
    from part p left join (values {', '.join(f"('{r}', '{c}')" for r, c in _ALIASES)}) a(raw, canon) on a.raw = upper(p.p_type)"""
)
def alias_lookup(t: Tables) -> DataFrame:
    """J-1, J-10: left lookup with a default."""
    aliases = small_table(t.spark, _ALIASES, "raw string, canon string")
    keyed = t.part.select("p_partkey", F.upper("p_type").alias("key"))
    found = lookup(keyed, aliases, {"key": "raw"}, {"canon": "canon"})
    return found.select(
        "p_partkey", F.coalesce("canon", F.lit("Unmapped")).alias("category"), F.col("canon").isNotNull().alias("mapped")
    )


_NAME_RULES = [
    ("SMALL", r"^SMALL (GEAR|RING)( .*)?$", r"TINY \1", ""),
    ("LARGE", r"^(BLUE|GREEN) .*$", r"\1 SET", ""),
    ("PROMO", r"^RED (WIDGET)( .*)?$", r"\1", ""),
]
_CONFORM_STEPS = f"""
with items as (select p_partkey, upper(p_type) as make, cast(2010 + p_size % 5 as integer) as model_year,
                      upper(p_name || case when p_size % 3 = 0 then ' ' || p_brand else '' end) as model_norm from part),
listed as (
    select distinct upper(p_type) as make, cast(2010 + p_size % 4 as integer) as model_year,
           upper(case p_partkey % 4 when 0 then p_name when 1 then split_part(p_name, ' ', 1)
                      when 2 then 'TINY ' || split_part(p_name, ' ', 2) else split_part(p_name, ' ', 2) end) as model_norm
    from part
    union select distinct upper(p_type), cast(2010 + p_size % 4 as integer), 'BLUE SET' from part where p_partkey % 5 = 0),
rules(make, pattern, replacement) as (values {', '.join(f"('{m}', '{p}', '{r}')" for m, p, r, _ in _NAME_RULES)}),
names as (select distinct make, model_year, model_norm from items),
cands as (
    select n.*, l.model_norm as target, case when l.model_norm = n.model_norm then 1 else 3 end as priority
    from names n join listed l on l.make = n.make and l.model_year = n.model_year
     and (l.model_norm = n.model_norm or starts_with(n.model_norm, l.model_norm || ' '))
    union all
    select n.*, l.model_norm, 2 from names n join rules r on r.make = n.make and regexp_matches(n.model_norm, r.pattern)
    join listed l on l.make = n.make and l.model_year = n.model_year
     and l.model_norm = regexp_replace(n.model_norm, r.pattern, r.replacement)),
best as (select * from cands qualify row_number() over (partition by make, model_year, model_norm
         order by priority, length(target) desc, target) = 1),
resolved as (select n.make, n.model_norm as source_model_norm, n.model_year, coalesce(b.target, n.model_norm) as model_norm,
    case b.priority when 1 then 'exact' when 2 then 'rule' when 3 then 'prefix' else 'unmatched' end as match_method
    from names n left join best b on b.make = n.make and b.model_year = n.model_year and b.model_norm = n.model_norm)
"""


def _named_items(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.upper("p_type").alias("make"),
        F.expr("cast(2010 + p_size % 5 as int)").alias("model_year"),
        F.upper(
            F.concat("p_name", F.when(F.expr("p_size % 3 = 0"), F.concat(F.lit(" "), "p_brand")).otherwise(""))
        ).alias("model_norm"),
    )


def _listed_items(t: Tables) -> DataFrame:
    kind = F.expr("p_partkey % 4")
    name = (
        F.when(kind == 0, F.col("p_name"))
        .when(kind == 1, F.split_part("p_name", F.lit(" "), F.lit(1)))
        .when(kind == 2, F.concat(F.lit("TINY "), F.split_part("p_name", F.lit(" "), F.lit(2))))
        .otherwise(F.split_part("p_name", F.lit(" "), F.lit(2)))
    )
    scope = [F.upper("p_type").alias("make"), F.expr("cast(2010 + p_size % 4 as int)").alias("model_year")]
    return t.part.select(*scope, F.upper(name).alias("model_norm")).unionByName(
        t.part.filter("p_partkey % 5 = 0").select(*scope, F.lit("BLUE SET").alias("model_norm"))
    )


def _conformed(t: Tables) -> DataFrame:
    rules = small_table(t.spark, _NAME_RULES, "make string, pattern string, replacement string, description string")
    return conform_names(_named_items(t), _listed_items(t), rules)


@_query(_CONFORM_STEPS + "select * from resolved")
def conform_exact_rule_prefix(t: Tables) -> DataFrame:
    """INT-1: exact, rule, longest word prefix, unmatched."""
    return _conformed(t)


@_query(
    _CONFORM_STEPS
    + """select make as source, count(*) as rows_total, count(*) as rows_in_scope, count(*) as rows_resolvable,
    count(*) filter (where i.model_year between 2011 and 2014) as rows_in_reference_years,
    count(*) filter (where i.model_year between 2011 and 2014 and r.match_method = 'exact') as matched_exact,
    count(*) filter (where i.model_year between 2011 and 2014 and r.match_method = 'rule') as matched_rule,
    count(*) filter (where i.model_year between 2011 and 2014 and r.match_method = 'prefix') as matched_prefix,
    round(count(*) filter (where i.model_year between 2011 and 2014 and r.match_method = 'exact')
          / count(*) filter (where i.model_year between 2011 and 2014), 4) as exact_match_rate,
    round(count(*) filter (where i.model_year between 2011 and 2014 and r.match_method <> 'unmatched')
          / count(*) filter (where i.model_year between 2011 and 2014), 4) as vpic_match_rate
    from items i join (select make as m, source_model_norm as s, model_year as y, match_method from resolved) r
      on r.m = i.make and r.s = i.model_norm and r.y = i.model_year group by make"""
)
def conformance_rates_by_type(t: Tables) -> DataFrame:
    """MART-3, A-17, P-5, J-11: counts and guarded rates per source."""
    rows = attach_conformed(_named_items(t), _conformed(t), how="left").select(
        F.col("make").alias("source"),
        F.lit(True).alias("in_scope"),
        F.lit(True).alias("resolvable"),
        F.col("model_year").between(2011, 2014).alias("in_reference_years"),
        "match_method",
    )
    return conformance_rates(rows)


@_query(
    """select p_partkey, array_to_string(list_transform(range(1, length(p_name || ' of ' || p_brand)
        - length(replace(p_name || ' of ' || p_brand, ' ', '')) + 1),
        lambda n: array_to_string(string_split(p_name || ' of ' || p_brand, ' ')[1:n], ' ')), '|') as prefixes from part"""
)
def word_prefix_lists(t: Tables) -> DataFrame:
    """J-4: all proper word prefixes of a name, the equality keys of the prefix match."""
    return t.part.select(
        "p_partkey",
        F.array_join(word_prefixes(F.concat_ws(" of ", "p_name", "p_brand")), "|").alias("prefixes"),
    )


# ---------------------------------------------------------------------- universe merges
@_query(
    """with o as (select o_orderkey as k, o_orderstatus as status from orders where o_orderkey % 3 <> 1),
    l as (select l_orderkey as k, array_to_string(list_sort(list(distinct l_returnflag)), ',') as seen_in, count(*) as n
          from lineitem where l_orderkey % 3 <> 2 group by 1),
    m as (select k, l_shipmode from (select l_orderkey as k, l_linestatus as l_shipmode, count(*) as c from lineitem where l_orderkey % 3 <> 2 group by 1, 2)
          qualify row_number() over (partition by k order by c desc, l_shipmode) = 1)
    select coalesce(o.k, l.k) as order_key, coalesce(o.status, '?') as status, coalesce(l.seen_in, '') as seen_in,
           coalesce(l.n, 0) as n_lines, m.l_shipmode as usual_status, o.k is not null as in_orders
    from o full join l on l.k = o.k left join m on m.k = l.k"""
)
def universe_full_outer(t: Tables) -> DataFrame:
    """INT-3, J-7, A-11, A-12, F-30: reference universe full-outer observed universe."""
    listed = t.orders.filter("o_orderkey % 3 <> 1").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"), F.lit(True).alias("in_orders")
    )
    lines = t.lineitem.filter("l_orderkey % 3 <> 2").withColumnRenamed("l_orderkey", "order_key")
    seen = lines.groupBy("order_key").agg(distinct_list(F.col("l_returnflag")).alias("seen_in"), _n().alias("n_lines"))
    usual = most_frequent(lines, ["order_key"], "l_linestatus", "usual_status")
    merged = full_outer_merge(
        listed, seen.join(usual, "order_key"), ["order_key"], {"status": "?", "n_lines": 0, "in_orders": False}
    )
    return merged.withColumn("seen_in", F.coalesce("seen_in", F.array().cast("array<string>")))


@_query(
    """select o_custkey, first(case when o_orderstatus <> 'F' then o_orderpriority end order by o_totalprice desc, o_orderkey)
             filter (where o_orderstatus <> 'F') as top_priority,
           first(o_orderstatus order by o_orderdate, o_orderkey) as first_status,
           min(case when o_orderstatus = 'P' then o_orderpriority end) as any_priority
    from orders group by 1"""
)
def argmax_null_safe(t: Tables) -> DataFrame:
    """A-9, A-10: arg-max and arg-min that skip missing values, with a tie-break."""
    priority = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    return t.orders.groupBy("o_custkey").agg(
        max_by_present(priority, F.col("o_totalprice"), F.col("o_orderkey")).alias("top_priority"),
        min_by_present(F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_orderkey")).alias("first_status"),
        F.min(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("any_priority"),
    )


@_query(
    """select l_suppkey, array_to_string(list_sort(list(distinct l_returnflag)), ',') as flags,
    count(distinct l_partkey || '|' || l_orderkey) as pairs, count(distinct l_partkey) filter (where l_quantity > 25) as big_parts,
    count(*) filter (where l_returnflag = 'R') as returned from lineitem group by 1"""
)
def ordered_distinct_list(t: Tables) -> DataFrame:
    """A-3, A-4, A-12: distinct lists, composite and filtered distinct counts."""
    lines = t.lineitem
    flags = lines.groupBy("l_suppkey").agg(
        distinct_list(F.col("l_returnflag")).alias("flags"),
        count_where(F.col("l_returnflag") == "R").alias("returned"),
    )
    # One distinct count per aggregation: several in one would expand every row once per count.
    pairs = lines.groupBy("l_suppkey").agg(distinct_tuples(F.col("l_partkey"), F.col("l_orderkey")).alias("pairs"))
    big = lines.groupBy("l_suppkey").agg(distinct_where(F.col("l_partkey"), F.col("l_quantity") > 25).alias("big_parts"))
    return flags.join(pairs, "l_suppkey").join(big, "l_suppkey")


@_query(
    """select l_suppkey, l_returnflag as usual_flag from (select l_suppkey, l_returnflag, count(*) as n from lineitem group by 1, 2)
    qualify row_number() over (partition by l_suppkey order by n desc, l_returnflag) = 1"""
)
def usual_flag_per_supplier(t: Tables) -> DataFrame:
    """A-11: mode with a fixed tie rule."""
    return most_frequent(t.lineitem, ["l_suppkey"], "l_returnflag", "usual_flag")


# ------------------------------------------------------------------------------- ranges
_RANGES = "case when p_partkey % 13 = 0 then p_size + 2 else p_size end"


def _sized(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.expr(_RANGES).alias("lo"),
        F.expr("case when p_partkey % 13 = 0 then p_size - 1 when p_partkey % 17 = 0 then null else p_size + 3 end").alias("hi"),
    )


_SIZED = f"(select p_partkey, {_RANGES} as lo, case when p_partkey % 13 = 0 then p_size - 1 when p_partkey % 17 = 0 then null else p_size + 3 end as hi from part)"


@_query(f"select p_partkey, cast(unnest(range(lo, hi + 1)) as integer) as size from {_SIZED}")
def explode_size_range(t: Tables) -> DataFrame:
    """F-21, INT-2: inclusive ranges; reversed and open ones give no row."""
    return explode_range(_sized(t), "lo", "hi", "size").select("p_partkey", "size")


@_query(
    f"""select cast((select sum(case when lo <= hi then hi - lo + 1 else 0 end) from {_SIZED}) as bigint) as expected_rows,
    (select count(*) from (select unnest(range(lo, hi + 1)) from {_SIZED})) as actual_rows, true as complete"""
)
def explode_complete_check(t: Tables) -> DataFrame:
    """DQ-11: as many rows as the ranges span."""
    exploded = explode_range(_sized(t), "lo", "hi", "size")
    return (
        range_row_count(_sized(t), "lo", "hi")
        .withColumn("actual_rows", scalar_of(exploded, _n()))
        .withColumn("complete", F.col("expected_rows") == F.col("actual_rows"))
    )


@_query(
    """select user_id, strftime(min(d), '%Y-%m-%d') as run_start, strftime(max(d), '%Y-%m-%d') as run_end, count(*) as run_length
    from (select user_id, d, d - cast(row_number() over (partition by user_id order by d) as integer) as g
          from (select distinct user_id, ts::date as d from events where event_type <> 'view')) group by user_id, g"""
)
def islands_of_days(t: Tables) -> DataFrame:
    """W-5: runs of consecutive active days per user."""
    days = t.events.filter("event_type <> 'view'").select("user_id", F.to_date("ts").alias("day"))
    return islands(days, ["user_id"], "day")


@_query(
    """select p_brand, min(s) as run_start, max(s) as run_end, count(*) as run_length
    from (select p_brand, s, s - row_number() over (partition by p_brand order by s) as g
          from (select distinct p_brand, p_size as s from part)) group by p_brand, g"""
)
def islands_of_sizes(t: Tables) -> DataFrame:
    """W-5 on integers."""
    return islands(t.part, ["p_brand"], "p_size")


# ------------------------------------------------------------------- signals and scoring
@_query(
    """with a as (select cast(max(o_orderdate) - interval 36 month as date) as since from orders)
    select o_orderpriority, count(distinct o_custkey) as customers,
           count(distinct o_custkey) filter (where o_orderdate::date > (select since from a)) as recent_customers,
           strftime((select since from a), '%Y-%m-%d') as since
    from orders group by 1"""
)
def recent_window_counts(t: Tables) -> DataFrame:
    """A-2, A-4, J-8, F-19: counts since a window anchored to the newest row."""
    since = months_before(scalar_of(t.orders, F.to_date(F.max("o_orderdate"))), 36)
    recent = F.to_date("o_orderdate") > since
    counts = t.orders.groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("customers"),
        distinct_where(F.col("o_custkey"), recent).alias("recent_customers"),
    )
    return counts.withColumn("since", since)


_MONTHLY = """
    select strftime(coalesce(a.month, r.month), '%Y-%m-%d') as month, coalesce(a.nation, r.nation) as nation,
           coalesce(a.kind, r.kind) as kind, coalesce(a.orders, 0) as orders, coalesce(r.returned_lines, 0) as returned_lines
    from (select date_trunc('month', o.o_orderdate)::date as month, c.c_nationkey as nation, p.p_type as kind,
                 count(distinct o.o_orderkey) as orders
          from orders o join customer c on c.c_custkey = o.o_custkey join lineitem l on l.l_orderkey = o.o_orderkey
          join part p on p.p_partkey = l.l_partkey group by all) a
    full join (select date_trunc('month', l.l_shipdate)::date as month, s.s_nationkey as nation, p.p_type as kind, count(*) as returned_lines
               from lineitem l join supplier s on s.s_suppkey = l.l_suppkey join part p on p.p_partkey = l.l_partkey
               where l.l_returnflag = 'R' group by all) r
      on r.month = a.month and r.nation = a.nation and r.kind = a.kind"""


@_query(_MONTHLY)
def monthly_trends_full_outer(t: Tables) -> DataFrame:
    """MART-2, F-18: two monthly signals merged on month x nation x category."""
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("kind"))
    pairs = t.lineitem.select("l_orderkey", "l_partkey").join(kinds, "l_partkey").select("l_orderkey", "kind").distinct()
    placed = t.orders.join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation")), "o_custkey"
    ).select(F.col("o_orderkey").alias("l_orderkey"), "nation", month_of(F.col("o_orderdate")).alias("month"))
    ordered = placed.join(pairs, "l_orderkey").groupBy("month", "nation", "kind").agg(_n().alias("orders"))
    returned = (
        t.lineitem.filter("l_returnflag = 'R'")
        .select(month_of(F.col("l_shipdate")).alias("month"), "l_suppkey", "l_partkey")
        .groupBy("month", "l_suppkey", "l_partkey")
        .agg(_n().alias("_lines"))
        .join(kinds, "l_partkey")
        .join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")), "l_suppkey")
        .groupBy("month", "nation", "kind")
        .agg(F.sum("_lines").alias("returned_lines"))
    )
    return full_outer_merge(ordered, returned, ["month", "nation", "kind"], {"orders": 0, "returned_lines": 0})


_GAP_STEPS = """
with demand as (
    select c.c_nationkey as entity, p.p_type as category,
           count(*) filter (where l.l_returnflag = 'R') as recent, count(*) filter (where l.l_quantity > 48) as severe,
           count(*) filter (where l.l_discount > 0.095) as recalls
    from lineitem l join orders o on o.o_orderkey = l.l_orderkey join customer c on c.c_custkey = o.o_custkey
    join part p on p.p_partkey = l.l_partkey where l.l_linestatus = 'F' group by all),
supply as (
    select s.s_nationkey as entity, p.p_type as category, count(distinct p.p_partkey) as parts
    from lineitem l join supplier s on s.s_suppkey = l.l_suppkey join part p on p.p_partkey = l.l_partkey
    where s.s_suppkey % 3 = 0 and p.p_size > 10 + (s.s_nationkey * 7) % 40 group by all),
depth as (select category, median(parts) as median_parts from supply group by 1),
scored as (
    select d.*, coalesce(s.parts, 0) as parts, m.median_parts,
           case when s.parts is null then 'uncovered' when s.parts < m.median_parts * 0.5 then 'thin' else 'covered' end as coverage_status,
           ln(1 + d.recent) + 2 * ln(1 + d.severe) + 1.5 * ln(1 + d.recalls) as demand,
           case when n.n_nationkey % 4 = 0 then 0.6 when n.n_nationkey % 4 = 1 then 1.0 when n.n_nationkey % 4 = 2 then 1.25 else 0.8 end as weight
    from demand d join nation n on n.n_nationkey = d.entity
    left join supply s on s.entity = d.entity and s.category = d.category left join depth m on m.category = d.category)
"""


def _nation_supply(t: Tables) -> DataFrame:
    sellers = t.supplier.filter("s_suppkey % 3 = 0").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("entity")
    )
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"), "p_size")
    sold = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    return (
        sold.join(sellers, "l_suppkey")
        .join(parts, "l_partkey")
        .filter("p_size > 10 + (entity * 7) % 40")
        .select("entity", "category", "l_partkey")
        .distinct()
        .groupBy("entity", "category")
        .agg(_n().alias("parts"))
    )


@_query(
    _GAP_STEPS
    + """select entity, category, recent, severe, recalls, parts, median_parts, coverage_status, round(demand, 3) as demand_index,
    round(demand * weight * f, 3) as opportunity_score,
    rank() over (partition by category order by round(demand * weight * f, 9) desc) as category_rank
    from (select *, case coverage_status when 'uncovered' then 1.0 when 'thin' then 0.5 else 0.0 end as f from scored)"""
)
def coverage_gap_scored(t: Tables) -> DataFrame:
    """MART-1, P-11, P-12, W-3: demand from lines of customer nations, supply from sellers."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"))
    buyers = t.orders.join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("entity")), "o_custkey"
    ).select(F.col("o_orderkey").alias("l_orderkey"), "entity")
    demand = (
        t.lineitem.filter("l_linestatus = 'F'")
        .join(buyers, "l_orderkey")
        .join(parts, "l_partkey")
        .groupBy("entity", "category")
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("recent"),
            F.count_if(F.col("l_quantity") > 48).alias("severe"),
            F.count_if(F.col("l_discount") > 0.095).alias("recalls"),
        )
    )
    kind = F.expr("n_nationkey % 4")
    weight = F.when(kind == 0, 0.6).when(kind == 1, 1.0).when(kind == 2, 1.25).otherwise(0.8)
    nations = t.nation.select(F.col("n_nationkey").alias("entity"), weight.alias("weight"))
    return coverage_gap(
        demand,
        _nation_supply(t),
        nations,
        entity="entity",
        category="category",
        supply="parts",
        demand_terms={"recent": 1.0, "severe": 2.0, "recalls": 1.5},
        weight="weight",
        median_name="median_parts",
    ).drop("weight")


@_query(_GAP_STEPS + "select category, median_parts from depth")
def category_median_depth(t: Tables) -> DataFrame:
    """A-13: exact interpolated median per category."""
    return group_median(_nation_supply(t), ["category"], "parts", "median_parts")


@_query(
    """select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_returnflag,
    rank() over (partition by l_returnflag order by round(l_extendedprice / l_quantity, 9) desc) as place from lineitem"""
)
def rank_lines_by_unit_price(t: Tables) -> DataFrame:
    """W-3 with large groups: three flags hold all rows."""
    priced = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_returnflag",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )
    return rank_within(priced, "l_returnflag", "unit_price", "place", width=16.0).drop("unit_price")


@_query(
    """select o_orderkey, greatest(2003 - year(o_orderdate), 0)::integer as age,
    case when 2003 - year(o_orderdate) <= 2 then '0-2' when 2003 - year(o_orderdate) <= 5 then '3-5' else '6+' end as band,
    case when 2003 - year(o_orderdate) <= 2 then 0.6 when 2003 - year(o_orderdate) <= 5 then 1.0 else 1.25 end::double as weight from orders"""
)
def age_band_weights(t: Tables) -> DataFrame:
    """P-10, F-17, F-20: bands and weights against a fixed year."""
    aged = t.orders.select("o_orderkey", F.greatest(F.lit(2003) - F.year("o_orderdate"), F.lit(0)).alias("age"))
    return aged.withColumns(
        {
            "band": banded(F.col("age"), [(2, "0-2"), (5, "3-5"), (None, "6+")]),
            "weight": banded(F.col("age"), [(2, 0.6), (5, 1.0), (None, 1.25)]),
        }
    )


# -------------------------------------------------------------------- semi, anti, top-k
@_query(
    """select o_orderkey, o_orderstatus from orders where o_orderkey in (select l_orderkey from lineitem where l_shipdate > timestamp '2001-06-01')"""
)
def semi_touched_keys(t: Tables) -> DataFrame:
    """J-12: headers with any late line."""
    late = t.lineitem.filter("l_shipdate > timestamp '2001-06-01'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.join(late, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus")


@_query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def anti_orphans(t: Tables) -> DataFrame:
    """J-13: headers without lines."""
    return orphans(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_custkey")


@_query(
    """select c.c_custkey, c.c_name, max(o.o_totalprice) as best from customer c
    left join orders o on o.o_custkey = c.c_custkey and o.o_orderpriority = '1-URGENT'
    group by 1, 2 order by best desc nulls last, c_custkey limit 20"""
)
def top_k_nulls_last(t: Tables) -> DataFrame:
    """T-1..T-3, J-15: top rows with missing values last."""
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("best")
    )
    joined = t.customer.select("c_custkey", "c_name").join(urgent, "c_custkey", "left")
    return top_k(joined, [F.desc_nulls_last("best"), "c_custkey"], 20)


@_query(
    """select o_orderpriority, o_orderstatus, count(*) as n, round(count(*) / sum(count(*)) over (partition by o_orderpriority), 4) as share
    from orders where o_orderpriority in (select o_orderpriority from orders group by 1 order by sum(o_totalprice) desc, 1 limit 3) group by 1, 2"""
)
def top_groups_with_share(t: Tables) -> DataFrame:
    """T-6, A-21: rows of the largest groups and each part's share."""
    kept = keep_top_groups(t.orders, "o_orderpriority", "o_totalprice", 3)
    counts = kept.groupBy("o_orderpriority", "o_orderstatus").agg(_n().alias("n"))
    return with_share(counts, "n", "_s", ["o_orderpriority"]).select(
        "o_orderpriority", "o_orderstatus", "n", F.round("_s", 4).alias("share")
    )


@_query(
    """select * from (select event_id, user_id, value from events order by value desc, event_id limit 100), (select true as truncated)"""
)
def capped_with_flag(t: Tables) -> DataFrame:
    """T-5: a capped result that says whether it was cut."""
    rows, flag = capped(t.events.select("event_id", "user_id", "value"), 100, [F.desc("value"), F.asc("event_id")])
    return rows.withColumn("truncated", scalar_of(flag, F.max("truncated")))


@_query(
    """select l_suppkey, count(*) as n, round(avg(case when l_returnflag = 'R' then 1.0 else 0.0 end), 4) as return_share,
    round(avg(cast(l_extendedprice as double)), 2) as mean_price, cast(sum(l_linenumber) as bigint) as line_sum
    from lineitem group by 1 having count(*) >= 500"""
)
def having_share(t: Tables) -> DataFrame:
    """A-1, A-5, A-6, A-15."""
    return (
        t.lineitem.groupBy("l_suppkey")
        .agg(
            _n().alias("n"),
            ratio(F.count_if(F.col("l_returnflag") == "R"), _n()).alias("return_share"),
            mean(F.col("l_extendedprice"), 2).alias("mean_price"),
            F.sum("l_linenumber").alias("line_sum"),
        )
        .filter("n >= 500")
    )


@_query(
    """select o_orderpriority, count(*) filter (where o_orderstatus = 'F') as "F", count(*) filter (where o_orderstatus = 'O') as "O",
    count(*) filter (where o_orderstatus = 'X') as "X" from orders group by 1"""
)
def pivot_status_counts(t: Tables) -> DataFrame:
    """A-20: pivot with given columns, absent ones 0."""
    return pivot_counts(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "X"])


@_query(
    """select d.s as o_orderstatus, coalesce(g.n, 0) as n from (values ('F'), ('O'), ('X')) d(s)
    left join (select o_orderstatus, count(*) as n from orders group by 1) g on g.o_orderstatus = d.s"""
)
def dense_status_domain(t: Tables) -> DataFrame:
    """A-22: a fixed domain with 0 for absent groups."""
    counts = t.orders.groupBy("o_orderstatus").agg(_n().alias("n"))
    return on_domain(counts, "o_orderstatus", ["F", "O", "X"], ["n"])


@_query(
    """select (select count(*) from orders) as orders, (select count(*) from customer where c_acctbal < 0) as in_debt,
    (select strftime(max(o_orderdate), '%Y-%m-%d') from orders) as newest, (select count(distinct l_partkey) from lineitem) as parts"""
)
def kpi_totals(t: Tables) -> DataFrame:
    """A-18: independent scalar subqueries in one row."""
    return kpi_row(
        t.spark,
        orders=scalar_of(t.orders, _n()),
        in_debt=scalar_of(t.customer.filter("c_acctbal < 0"), _n()),
        newest=scalar_of(t.orders, F.to_date(F.max("o_orderdate"))),
        parts=scalar_of(t.lineitem, F.count_distinct("l_partkey")),
    )


@_query(
    """select event_id, user_id, value from events where event_type not in ('view', 'click') and value > 3 and user_id between 5 and 90
    and ts >= (select max(ts) from events) - interval 10 day"""
)
def composed_filters(t: Tables) -> DataFrame:
    """P-4..P-7, P-13: optional predicates folded with AND, one against a scalar subquery."""
    since = scalar_of(t.events, F.max("ts")) - F.expr("interval 10 days")
    wanted = all_of(
        [~F.col("event_type").isin("view", "click"), F.col("value") > 3, None, F.col("user_id").between(5, 90), F.col("ts") >= since]
    )
    return t.events.filter(wanted).select("event_id", "user_id", "value")


@_query(
    """select distinct n.n_name, r.r_name from nation n join region r on r.r_regionkey = n.n_regionkey
    join supplier s on s.s_nationkey = n.n_nationkey where upper(trim(r.r_name)) in ('ASIA', 'EUROPE')"""
)
def star_scoped_distinct(t: Tables) -> DataFrame:
    """J-9, P-15: star joins and a scoped distinct list."""
    scoped = t.region.filter(F.upper(F.trim("r_name")).isin("ASIA", "EUROPE"))
    nations = t.nation.join(scoped, F.col("r_regionkey") == F.col("n_regionkey"))
    sellers = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"))
    return nations.join(sellers, "n_nationkey", "left_semi").select("n_name", "r_name").distinct()


@_query("select event_id as latest_id, user_id from events order by ts desc, event_id limit 1")
def latest_event(t: Tables) -> DataFrame:
    """T-4: newest row by aggregation."""
    keyed = t.events.withColumn("_tie", -F.col("event_id"))
    return latest_row(keyed, "ts", ["_tie"]).select(F.col("event_id").alias("latest_id"), "user_id")


@_query(
    """select user_id, event_type, event_id from events qualify row_number() over (partition by user_id
    order by case event_type when 'purchase' then 1 when 'signup' then 2 else 3 end, event_id desc) = 1"""
)
def best_event_per_user(t: Tables) -> DataFrame:
    """W-2, SRC-10: best candidate per key by priority, then by a second key."""
    rank = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2).otherwise(3)
    return best_candidate(t.events, ["user_id"], ["event_type", "event_id"], [rank, -F.col("event_id")])


# ---------------------------------------------------------------------------- contract
_LINE_CHECKED = """
select *, array_to_string(list_sort([x for x in [
    case when l_partkey % 23 = 0 then 'bad_part' end, case when qty <= 0 then 'bad_quantity' end,
    case when l_suppkey % 19 = 0 then 'unknown_supplier' end, case when nth > 1 then 'repeated_line' end] if x is not null]), ',') as reasons
from (select *, case when l_orderkey % 37 = 0 then -1 else l_quantity end as qty,
             row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) as nth from lineitem)"""


def _checked_lines(t: Tables) -> DataFrame:
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    raw = t.lineitem.select("*", F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("_raw"), F.struct(*order).alias("_ordinal"))
    text = F.when(F.expr("l_orderkey % 37 = 0"), "N/A").otherwise(F.col("l_quantity").cast("string"))
    marked = flag_repeats(raw, ["l_orderkey", "l_linenumber"], "_ordinal", "_repeat")
    return apply_contract(
        marked,
        [
            Check("bad_part", F.expr("l_partkey % 23 = 0")),
            Check("bad_quantity", number_or(text, -1) <= 0),
            Check("unknown_supplier", F.expr("l_suppkey % 19 = 0")),
            Check("repeated_line", F.col("_repeat")),
        ],
    )


@_query(
    f"select l_orderkey, l_linenumber, l_partkey, reasons as _reasons from ({_LINE_CHECKED}) where reasons <> ''"
)
def contract_reasons(t: Tables) -> DataFrame:
    """DQ-1, DQ-5, W-4, F-25, F-27: rejected rows with all their reasons."""
    return quarantined_rows(_checked_lines(t), ["l_orderkey", "l_linenumber", "l_partkey"])


@_query(f"select l_orderkey, l_linenumber, l_partkey from ({_LINE_CHECKED}) where reasons = ''")
def contract_survivors(t: Tables) -> DataFrame:
    """DQ-5: rows without a reason."""
    return valid_rows(_checked_lines(t)).select("l_orderkey", "l_linenumber", "l_partkey")


@_query(
    f"""with c as ({_LINE_CHECKED}), r as (select unnest(string_split(reasons, ',')) as reason from c where reasons <> '')
    select 'lines' as feed, (select count(*) from c) as rows_in, (select count(*) from c where reasons = '') as rows_valid,
    (select count(*) from c where reasons <> '') as rows_quarantined, 0 as standardized, 0 as deduplicated, reason, count(*) as reason_count
    from r group by reason"""
)
def quarantine_counts(t: Tables) -> DataFrame:
    """DQ-7, A-19: run metrics and rows per reason."""
    return feed_metrics(_checked_lines(t), "lines")


@_query(
    """select c_custkey, upper(trim(regexp_replace(' ' || lower(c_mktsegment) || '  x ', '\\s+', ' ', 'g'))) as clean,
    try_cast(case when c_custkey % 5 = 0 then '12.5e1' when c_custkey % 5 = 1 then 'abc' when c_custkey % 5 = 2 then ' 7 '
        when c_custkey % 5 = 3 then '2014.5' else '3000000000' end as integer) as tolerant,
    try_cast(case when c_custkey % 3 = 0 then '2001-02-03' when c_custkey % 3 = 1 then 'n/a' else '' end as date)::varchar as iso,
    cast(try_strptime(case c_custkey % 4 when 0 then '20010203' when 1 then '20011301' when 2 then '2020115' else ' 19990101' end, '%Y%m%d') as date)::varchar as compact
    from customer"""
)
def tolerant_casts(t: Tables) -> DataFrame:
    """F-3, F-8, F-24, F-32: parsing that never fails."""
    five = F.expr("c_custkey % 5")
    number = (
        F.when(five == 0, "12.5e1").when(five == 1, "abc").when(five == 2, " 7 ").when(five == 3, "2014.5").otherwise("3000000000")
    )
    iso = F.expr("case c_custkey % 3 when 0 then '2001-02-03' when 1 then 'n/a' else '' end")
    packed = F.expr("case c_custkey % 4 when 0 then '20010203' when 1 then '20011301' when 2 then '2020115' else ' 19990101' end")
    return t.customer.select(
        "c_custkey",
        F.upper(collapse_spaces(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  x ")))).alias("clean"),
        tolerant_int(number).alias("tolerant"),
        iso_date(iso).alias("iso"),
        compact_date(packed).alias("compact"),
    )


@_query(
    """select test, 'error' as severity, failures, case when failures = 0 then 'pass' else 'fail' end as status from (
    select 'lineitem.quantity' as test, (select count(*) from lineitem where l_quantity <= 0) as failures
    union all select 'lineitem.flag', (select count(*) from lineitem where l_returnflag not in ('A', 'N'))
    union all select 'lineitem.key', (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1))
    union all select 'orders.key', (select count(*) from (select 1 from orders group by o_orderkey having count(*) > 1))
    union all select 'lineitem.order', (select count(*) from lineitem where l_orderkey not in (select o_orderkey from orders))
    union all select 'orders.line', (select count(*) from orders where o_orderkey not in (select l_orderkey from lineitem)))"""
)
def check_suite(t: Tables) -> DataFrame:
    """DQ-8, DQ-9: row, grain and relationship tests."""
    tables = {"lineitem": t.lineitem, "orders": t.orders}
    return run_checks(
        tables,
        [
            RowTest("lineitem.quantity", "lineitem", "l_quantity <= 0"),
            RowTest("lineitem.flag", "lineitem", "l_returnflag not in ('A', 'N')"),
            UniqueTest("lineitem.key", "lineitem", ("l_orderkey", "l_linenumber")),
            UniqueTest("orders.key", "orders", ("o_orderkey",)),
            RelationTest("lineitem.order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            RelationTest("orders.line", "orders", "o_orderkey", "lineitem", "l_orderkey"),
        ],
    )


# ------------------------------------------------------------- history and incremental
_PRICES = """
with r0 as (select p_partkey, p_brand, p_retailprice as price from part where p_partkey % 89 <> 0),
r1 as (select p_partkey, p_brand || '!' as p_brand, case when p_partkey % 50 = 0 then null when p_partkey % 25 = 0 then p_retailprice + 1 else p_retailprice end as price
       from part where p_partkey % 97 <> 0)
"""


def _price_history(t: Tables) -> DataFrame:
    first = t.part.filter("p_partkey % 89 <> 0").select("p_partkey", "p_brand", F.col("p_retailprice").alias("price"))
    second = t.part.filter("p_partkey % 97 <> 0").select(
        "p_partkey",
        F.concat("p_brand", F.lit("!")).alias("p_brand"),
        F.expr("case when p_partkey % 50 = 0 then null when p_partkey % 25 = 0 then p_retailprice + 1 else p_retailprice end").alias("price"),
    )
    at = [F.lit(x).cast("timestamp") for x in ("2024-01-01 00:00:00", "2024-02-01 00:00:00")]
    return next_history(first_versions(first, at[0]), second, "p_partkey", ["price"], at[1])


_SCD = """
    select r0.p_partkey, r0.p_brand, r0.price, '2024-01-01 00:00:00' as valid_from,
           case when r1.p_partkey is not null and r1.price is not distinct from r0.price then null else '2024-02-01 00:00:00' end as valid_to
    from r0 left join r1 on r1.p_partkey = r0.p_partkey
    union all
    select r1.p_partkey, r1.p_brand, r1.price, '2024-02-01 00:00:00', null
    from r1 left join r0 on r0.p_partkey = r1.p_partkey where r0.p_partkey is null or r1.price is distinct from r0.price"""


@_query(_PRICES + _SCD)
def scd2_two_revisions(t: Tables) -> DataFrame:
    """INC-3, SNAP-1: changed, deleted, new and NULL values between two deliveries."""
    return _price_history(t)


@_query(
    _PRICES
    + f"""select h.p_partkey, h.p_brand, h.price, h.valid_from, h.valid_to, n.version_count, n.first_seen_at
    from ({_SCD}) h join (select p_partkey, count(*) as version_count, min(valid_from) as first_seen_at from ({_SCD}) group by 1) n
      on n.p_partkey = h.p_partkey where h.valid_to is null"""
)
def scd2_current(t: Tables) -> DataFrame:
    """INC-4, J-14: open versions with their version count."""
    return current_with_versions(_price_history(t), "p_partkey")


def _customer_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("o_custkey").agg(
        _n().alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderdate").alias("newest")
    )


@_query(
    """select o_custkey, count(*) as orders, round(sum(o_totalprice), 2) as total, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as newest
    from orders group by 1"""
)
def incremental_equals_full(t: Tables) -> DataFrame:
    """INC-1, INC-2: first part, then touched keys only; equals the full build."""
    before = _customer_totals(t.orders.filter("o_orderdate < timestamp '2001-01-01'"))
    touched = rows_of_touched_keys(t.orders.withColumn("newest", F.col("o_orderdate")), before, "o_custkey", "newest")
    return keyed_replace(before, _customer_totals(touched.drop("newest")), ["o_custkey"])


@_query(
    """select o_orderkey, o_orderstatus, case when o_orderdate >= timestamp '2001-01-01' then 'late' end as note
    from orders"""
)
def keyed_replace_new_column(t: Tables) -> DataFrame:
    """INC-1, INC-5, U-2: replaced rows bring a new column."""
    old = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    new = rows_after(old, old.filter("o_orderdate < timestamp '2001-01-01'"), "o_orderdate").withColumn("note", F.lit("late"))
    return keyed_replace(old, new, ["o_orderkey"]).drop("o_orderdate")


# ------------------------------------------------------------------ sampling, documents
@_query(
    """select event_id, user_id from events where cast('0x' || substr(md5(cast(user_id as varchar)), 1, 8) as bigint) / 4294967295.0 < 0.3"""
)
def hash_sample_rows(t: Tables) -> DataFrame:
    """DQ-13, F-23: all rows of the sampled groups."""
    return hash_sample(t.events, "user_id", 0.3).select("event_id", "user_id")


@_query(
    """select event_id, user_id from events where cast('0x' || substr(md5(cast(user_id as varchar)), 1, 8) as bigint) / 4294967295.0
    < least(1.0, 40.0 / (select count(distinct user_id) from events))"""
)
def hash_sample_target(t: Tables) -> DataFrame:
    """DQ-13: the rate follows from a target number of groups."""
    return hash_sample_groups(t.events, "user_id", 40).select("event_id", "user_id")


@_query(
    """select event_type, cast(json_extract_string(props, '$.k') as integer) as k, count(*) as n from events group by 1, 2"""
)
def json_props(t: Tables) -> DataFrame:
    """F-28: fields of JSON text with a given schema."""
    parsed = t.events.select("event_type", F.from_json("props", "k int").getField("k").alias("k"))
    return parsed.groupBy("event_type", "k").agg(_n().alias("n"))


@_query(
    """select doc_id, '' as source, lang, substr(text, 1, 40) as text, n_chars from documents"""
)
def redact_truncate(t: Tables) -> DataFrame:
    """DQ-14, F-29, P-8: blanked and shortened columns."""
    return redact(t.documents, ["source"], {"text": 40})


@_query("select doc_id, lang, source from documents union select conv_id, role, 'chat' from conversations")
def union_distinct(t: Tables) -> DataFrame:
    """U-1, U-2: distinct union with a literal tag."""
    docs = t.documents.select("doc_id", "lang", "source")
    turns = t.conversations.select(F.col("conv_id").alias("doc_id"), F.col("role").alias("lang"), F.lit("chat").alias("source"))
    return docs.unionByName(turns).distinct()


# ---------------------------------------------------------------- comparison and profile
@_query(
    """select cast((select count(*) from customer) as bigint) as expected_rows, cast((select count(*) from customer) as bigint) as actual_rows,
    cast(0 as bigint) as unmatched_columns, true as matches"""
)
def result_signature(t: Tables) -> DataFrame:
    """DQ-12: equal up to row order, case, small numeric noise, names and extra columns."""
    expected = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    actual = t.customer.select(
        F.lower("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") + 0.0001).alias("balance"),
        F.col("c_custkey").alias("id"),
        F.lit(1).alias("extra"),
    ).orderBy(F.desc("balance"))
    return result_equivalent(expected, actual)


@_query(
    """select count(*) as expected_rows, count(*) as actual_rows, cast(1 as bigint) as unmatched_columns, false as matches from customer"""
)
def result_signature_differs(t: Tables) -> DataFrame:
    """DQ-12: one changed value is found."""
    expected = t.customer.select("c_custkey", "c_acctbal")
    smallest = scalar_of(t.customer, F.min("c_custkey"))
    actual = expected.withColumn(
        "c_acctbal", F.when(F.col("c_custkey") == smallest, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    )
    return result_equivalent(expected, actual)


_PROFILED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def _profile_sql() -> str:
    parts = []
    for table, schema in _PROFILED.items():
        for i, column in enumerate(schema.split(", "), start=1):
            name, kind = column.split()
            note = "customer number" if name == "c_custkey" else ""
            parts.append(
                f"select '{table}' as table_name, {i} as position, '{name}' as column_name, '{kind}' as data_type, "
                f"'{note}' as description, (select count(*) from {table}) as row_count"
            )
    return " union all ".join(parts)


@_query(_profile_sql())
def table_profile(t: Tables) -> DataFrame:
    """DQ-15: columns, types, descriptions and row counts."""
    return profile({name: getattr(t, name) for name in _PROFILED}, {"customer": {"c_custkey": "customer number"}})
