"""Registered queries over the vehicle models (STG, INT, DIM, FCT, MART, SNAP, DQ, Q-1..Q-26)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.operators.checks import freshness, run_checks
from fieldgap.operators.profile import profile
from fieldgap.plans import marts, reports
from fieldgap.plans.catalog import judge_parts
from fieldgap.plans.reference import COMPLAINT_COLUMNS, PERSONAL_COLUMNS, canonical_makes
from fieldgap.plans.suite import column_tests, warehouse_tests
from fieldgap.sources.documents import parse_documents, reference_models
from fieldgap.sources.positional import content_fingerprint, positional_columns, with_audit
from fieldgap.workload import feeds
from fieldgap.workload import values as v
from fieldgap.workload.feeds import Derived
from fieldgap.workload.oracle import RAW_FITMENT, RAW_PART, statement
from fieldgap.workload.portable import names, portable, sql_columns

Query = Callable[[SparkSession, str], DataFrame]

_warehouses: dict[tuple[str, str], Derived] = {}


def derived(spark: SparkSession, sf_dir: str) -> Derived:
    """The models of a table folder, built at most once per application.

    Reports read the written marts, as they would in a warehouse that a refresh has filled.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _warehouses:
        _warehouses[key] = Derived(spark, sf_dir.rstrip("/"))
    return _warehouses[key]


MODEL_COLUMNS = {
    "stg_recalls": "recall_record_id campaign_number make_raw make model_raw model_norm model_year component_path "
    "nhtsa_system manufacturer manufacturer_campaign_number campaign_units_affected initiated_by "
    "report_received_date:date owner_notification_date:date manufacture_begin_date:date manufacture_end_date:date "
    "defect_summary consequence_summary remedy_summary manufacturer_component_name manufacturer_part_number "
    "do_not_drive park_outside _loaded_at:ts",
    "stg_complaints": "complaint_component_id complaint_id make_raw make model_raw model_norm model_year "
    "component_path nhtsa_system is_crash is_fire injuries deaths needed_medical_attention vehicle_towed "
    "failure_date:date received_date:date added_date:date odometer_miles owner_state complaint_source drive_train "
    "fuel_type transmission_type narrative _loaded_at:ts",
    "stg_reference": "make vpic_make_id vpic_model_id model_name model_norm model_year vehicle_type",
    "stg_catalog_parts": "part_number brand part_type part_category description list_price:num part_status "
    "introduced_date:date superseded_by _loaded_at:ts",
    "stg_catalog_fitment": "part_number make model_name model_norm year_start year_end position is_interchange "
    "make_standardized model_standardized _loaded_at:ts",
    "int_model_conformance": "make source_model_norm model_year model_norm match_method",
    "int_fitment_exploded": "vehicle_key part_number make model_name model_norm model_year position is_interchange",
    "int_vehicles": "vehicle_key make model_name model_norm model_year vehicle_type in_vpic seen_in:list",
    "snap_catalog_parts": "part_number brand part_type part_category description list_price:num status "
    "introduced_date:date superseded_by valid_from:ts valid_to:ts",
    "dim_vehicle": "vehicle_key make model_name model_norm model_year vehicle_type in_vpic seen_in:list "
    "vehicle_age_years age_band aftermarket_age_weight:num",
    "dim_component": "component_key component_path nhtsa_system nhtsa_subsystem part_category aftermarket_serviceable",
    "dim_recall_campaign": "campaign_number manufacturer units_affected report_received_date:date "
    "owner_notification_date:date initiated_by do_not_drive park_outside defect_summary consequence_summary "
    "remedy_summary vehicles_named components_named",
    "dim_part": "part_number brand part_type part_category description list_price:num part_status "
    "introduced_date:date version_count first_seen_at:ts current_version_from:ts",
    "fct_complaint": "complaint_id vehicle_key received_date:date failure_date:date is_crash is_fire injuries deaths "
    "is_severe needed_medical_attention vehicle_towed odometer_miles owner_state complaint_source components_cited "
    "narrative _loaded_at:ts",
    "fct_complaint_component": "complaint_id component_key _loaded_at:ts",
    "fct_recall_vehicle_component": "campaign_number vehicle_key component_key report_received_date:date",
    "fct_part_fitment": "part_number vehicle_key position is_interchange fitment_verified_in_vpic",
    "mart_coverage_gap": "vehicle_key make model_name model_year age_band part_category complaints_total "
    "complaints_recent complaints_severe recall_campaigns parts_covering category_median_parts coverage_status "
    "demand_index opportunity_score category_rank",
    "mart_component_trends": "month:date make part_category complaints severe_complaints recall_campaigns",
    "mart_data_conformance": "source rows_total rows_in_scope rows_resolvable rows_in_reference_years matched_exact "
    "matched_rule matched_prefix exact_match_rate vpic_match_rate",
}

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _model(name: str) -> None:
    spec = MODEL_COLUMNS[name]
    QUERIES[name] = lambda spark, sf: portable(derived(spark, sf).lazy(name).select(*names(spec)))
    ORACLE[name] = statement(name, f"select {sql_columns(spec)} from {name}")


for _name in MODEL_COLUMNS:
    _model(_name)


def _add(name: str, query: Query, last: str | None = None, select: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf: portable(query(spark, sf))
    if select is not None:
        ORACLE[name] = statement(last, select)


# ---------------------------------------------------------------------------- landing
LANDED = "cmplid odino maketxt modeltxt yeartxt crash injured compdesc state miles cdescr prod_type vehicle_operator"


def _text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Complaint rows as tab-separated text lines with padded cells and a CR at the end."""
    rows = derived(spark, sf)["nhtsa_complaints"]
    # One flat list of cells and of the constant text between them: a text of its own per padded cell makes
    # a method that the JVM does not compile.
    pieces, between = [], ""
    for c in COMPLAINT_COLUMNS:
        if c in rows.columns:
            pieces += [F.lit(f"{between} "), F.coalesce(F.col(c), F.lit(""))]
            between = " \t"
        else:
            between += "private\t"
    return rows.select(F.concat(*pieces, F.lit(f"{between}extra\r")).alias("value"))


def landed_complaints(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1..SRC-4: text lines back to named columns, personal columns gone, audit columns added."""
    rows = positional_columns(_text_lines(spark, sf), COMPLAINT_COLUMNS, PERSONAL_COLUMNS)
    kept = [c for c in names(LANDED) if c not in PERSONAL_COLUMNS]
    stamped = with_audit(rows.select(*kept), "complaints", "batch", v.SECOND_LOAD)
    return stamped.drop("_batch_id")


_add(
    "landed_complaints",
    landed_complaints,
    "nhtsa_complaints",
    "select cmplid, odino, maketxt, nullif(trim(modeltxt), '') as modeltxt, yeartxt, crash, injured, compdesc, state, miles, cdescr, prod_type, "
    f"'complaints' as _source, '{v.SECOND_LOAD}' as _loaded_at from nhtsa_complaints",
)
_add(
    "landing_drift",
    lambda spark, sf: content_fingerprint(_text_lines(spark, sf)).select(
        "rows_seen",
        F.col("columns_seen").cast("bigint").alias("columns_seen"),
        F.lit(len(COMPLAINT_COLUMNS)).cast("bigint").alias("columns_expected"),
        (F.col("columns_seen") != len(COMPLAINT_COLUMNS)).alias("drifted"),
    ),
    "nhtsa_complaints",
    f"select count(*) as rows_seen, cast({len(COMPLAINT_COLUMNS) + 1} as bigint) as columns_seen, "
    f"cast({len(COMPLAINT_COLUMNS)} as bigint) as columns_expected, true as drifted from nhtsa_complaints",
)
# The fingerprint itself is a Spark hash, so there is no DuckDB form.
_add("landing_fingerprint", lambda spark, sf: content_fingerprint(_text_lines(spark, sf)))


def reference_documents(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-9..SRC-11: nested documents to scoped model rows with one type each."""
    part = derived(spark, sf).table("part")
    years = parse_documents(feeds.listed_documents(part), "doc")
    types = parse_documents(feeds.listed_type_documents(part), "doc")
    return reference_models(years, types, canonical_makes())


_add(
    "reference_documents",
    reference_documents,
    "vpic_models",
    f"""select m.make_id, m.make_name, m.model_id, m.model_name, m.model_year, t.vehicle_type
    from vpic_models m join (
        select model_id, first(kind order by case kind when '{v.CAR}' then 1 when '{v.MPV}' then 2 else 3 end) as vehicle_type
        from (select model_id, vehicle_type as kind from vpic_models where model_id % 10 <> 1
              union all select model_id, '{v.TRUCK}' from vpic_models where model_id % 3 = 0)
        group by 1) t on t.model_id = m.model_id""",
)

# ------------------------------------------------------------------------ feed contract
_add(
    "parts_quarantine",
    lambda spark, sf: derived(spark, sf).parts_judged().quarantined,
    "judged_r2",
    f"select {RAW_PART}, array_to_string(reasons, ',') as _reasons from judged_r2 where len(reasons) > 0",
)
_add(
    "fitment_quarantine",
    lambda spark, sf: derived(spark, sf).fitment_judged().quarantined,
    "judged_fitment",
    f"select {RAW_FITMENT}, array_to_string(reasons, ',') as _reasons from judged_fitment where len(reasons) > 0",
)


def feed_metrics(spark: SparkSession, sf: str) -> DataFrame:
    d = derived(spark, sf)
    return d.parts_judged().metrics.unionByName(d.fitment_judged().metrics)


_FEED_METRICS = """
select t.feed, t.rows_in, t.rows_valid, t.rows_quarantined, t.standardized, t.deduplicated,
       r.reason, coalesce(r.n, 0) as reason_count
from (select 'parts' as feed, count(*) as rows_in, count(*) filter (where len(reasons) = 0) as rows_valid,
             count(*) filter (where len(reasons) > 0) as rows_quarantined, 0 as standardized, 0 as deduplicated from judged_r2
      union all
      select 'fitment', count(*), count(*) filter (where len(reasons) = 0 and nth = 1),
             count(*) filter (where len(reasons) > 0),
             count(*) filter (where len(reasons) = 0 and nth = 1 and (clean_make <> make or clean_model <> model)),
             count(*) filter (where nth > 1) from judged_fitment) t
left join (select 'parts' as feed, reason, count(*) as n from (select unnest(reasons) as reason from judged_r2) group by all
           union all
           select 'fitment', reason, count(*) from (select unnest(reasons) as reason from judged_fitment) group by all) r
  on r.feed = t.feed"""
_add("feed_metrics", feed_metrics, "judged_fitment", _FEED_METRICS)
_add(
    "feed_balance",
    lambda spark, sf: feed_metrics(spark, sf)
    .select(
        "feed",
        "rows_in",
        (F.col("rows_valid") + F.col("rows_quarantined") + F.col("deduplicated")).alias("accounted"),
    )
    .distinct(),
    "judged_fitment",
    "select 'parts' as feed, count(*) as rows_in, count(*) as accounted from judged_r2 "
    "union all select 'fitment', count(*), count(*) from judged_fitment",
)


def feed_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of two feed runs, of which the reports take the newest."""
    earlier = judge_parts(feeds.part_feed(derived(spark, sf).table("part"), 0)).metrics
    runs = (("r2", v.SNAPSHOTS[2], feed_metrics(spark, sf)), ("r0", v.SNAPSHOTS[0], earlier))
    told = [m.withColumns({"run_id": F.lit(run), "run_at": F.lit(at).cast("timestamp")}) for run, at, m in runs]
    return told[0].unionByName(told[1])


_add("feed_reasons", lambda spark, sf: reports.latest_feed_metrics(feed_runs(spark, sf)), "judged_fitment", _FEED_METRICS)
_add(
    "quarantine_sample",
    lambda spark, sf: reports.quarantine_sample(derived(spark, sf).parts_judged().quarantined)[0],
    "judged_r2",
    f"""select {RAW_PART}, array_to_string(reasons, ',') as _reasons from judged_r2 where len(reasons) > 0
    order by all nulls first limit 200""",
)
_add(
    "feed_summary",
    lambda spark, sf: reports.feed_summary(feed_runs(spark, sf)),
    "judged_fitment",
    f"select distinct feed, rows_in, rows_valid, rows_quarantined, standardized, deduplicated from ({_FEED_METRICS})",
)

# -------------------------------------------------------------------- incremental facts


def _two_loads(spark: SparkSession, sf: str) -> tuple[Derived, DataFrame]:
    """Complaints as the first load left them: rows whose newest version came later are absent."""
    d = derived(spark, sf)
    return d, d["stg_complaints"].filter(F.col("_loaded_at") <= F.lit(v.FIRST_LOAD).cast("timestamp"))


def incremental_complaints(spark: SparkSession, sf: str) -> DataFrame:
    """INC-1, INC-2: first load, then only touched complaints; must equal the full build."""
    d, first = _two_loads(spark, sf)
    before = marts.fct_complaint(first, d["int_model_conformance"])
    return marts.fct_complaint(d["stg_complaints"], d["int_model_conformance"], before)


def incremental_citations(spark: SparkSession, sf: str) -> DataFrame:
    d, first = _two_loads(spark, sf)
    before = marts.fct_complaint_component(first)
    return marts.fct_complaint_component(d["stg_complaints"], before)


for _name, _query in (("fct_complaint", incremental_complaints), ("fct_complaint_component", incremental_citations)):
    _spec = MODEL_COLUMNS[_name]
    _add(
        f"incremental_{_name}",
        lambda spark, sf, q=_query, cols=tuple(names(_spec)): q(spark, sf).select(*cols),
        _name,
        f"select {sql_columns(_spec)} from {_name}",
    )
_add(
    "unchanged_rerun",
    # The incremental model over what it was built from; the staged rows bring nothing new.
    lambda spark, sf: marts.fct_complaint_component(
        derived(spark, sf)["stg_complaints"], derived(spark, sf)["fct_complaint_component"]
    ).select(*names(MODEL_COLUMNS["fct_complaint_component"])),
    "fct_complaint_component",
    f"select {sql_columns(MODEL_COLUMNS['fct_complaint_component'])} from fct_complaint_component",
)

# --------------------------------------------------------------------------- data tests


def _tested(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], list]:
    d = derived(spark, sf).build_all()
    tables = {
        name: d[name]
        for name in (*MODEL_COLUMNS, "make_aliases", "nhtsa_complaints", "stg_catalog_fitment")
    }
    return tables, warehouse_tests(tables, v.AS_OF_YEAR)


def data_tests(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-8..DQ-11: the whole suite as (test, severity, failures, status)."""
    return run_checks(*_tested(spark, sf))


def _suite_sql() -> str:
    """Failure counts of every declared test, spelled out for DuckDB."""
    parts = []
    for test in column_tests(v.AS_OF_YEAR):
        table, cols, kind = test.name.split(".")
        col = cols.split("+")
        if kind == "not_null":
            body = f"select count(*) from {table} where {cols} is null"
        elif kind == "valid_model_year":
            body = f"select count(*) from {table} where {cols} < 1950 or {cols} > {v.AS_OF_YEAR + 2}"
        elif kind == "unique":
            known = f"where {cols} is not null" if len(col) == 1 else ""
            body = f"select count(*) from (select 1 from {table} {known} group by {', '.join(col)} having count(*) > 1)"
        elif kind == "relationships":
            body = (
                f"select count(*) from {table} where {cols} is not null and {cols} not in "
                f"(select {test.parent_column} from {test.parent} where {test.parent_column} is not null)"
            )
        else:
            allowed = {
                "match_method": "('exact', 'rule', 'prefix', 'unmatched')",
                "age_band": "('0-2 (warranty)', '3-5 (early aftermarket)', '6-12 (aftermarket core)', '13+ (late life)')",
                "part_status": "('Active', 'Discontinued', 'Superseded')",
                "coverage_status": "('uncovered', 'thin', 'covered')",
            }[cols]
            body = f"select count(*) from {table} where {cols} not in {allowed}"
        parts.append((test.name, "error", body))
    parts.append(
        (
            "complaints_reconcile_to_bronze",
            "error",
            "select ((select count(distinct complaint_id) from stg_complaints where (make || model_year::varchar) is not null "
            "and length(model_norm) > 0) <> (select count(*) from fct_complaint))::bigint",
        )
    )
    parts.append(
        (
            "coverage_status_consistent",
            "error",
            "select count(*) from (select case when greatest(complaints_recent, complaints_severe) > complaints_total then true "
            "when (parts_covering = 0) is distinct from (coverage_status = 'uncovered') then true "
            "when coverage_status = 'covered' then opportunity_score <> 0 "
            "else demand_index > 0 and not opportunity_score > 0 end as bad from mart_coverage_gap) where bad",
        )
    )
    parts.append(
        (
            "fitment_explosion_complete",
            "error",
            "select ((select sum(len(range(year_start, year_end + 1))) from stg_catalog_fitment) "
            "is distinct from (select count(*) from int_fitment_exploded))::bigint",
        )
    )
    parts.append(
        (
            "one_vehicle_per_complaint",
            "error",
            "select count(*) from (select complaint_id from stg_complaints where make is not null and model_year is not null "
            "and model_norm <> '' group by 1 having count(distinct (make, model_norm, model_year)) > 1)",
        )
    )
    parts.append(
        (
            "unmapped_components_below_threshold",
            "warn",
            "select count(*) from (select count(*) filter (where k.part_category = 'Unmapped') as u, count(*) as n "
            "from fct_complaint_component b join dim_component k on k.component_key = b.component_key) where u > 0.01 * n",
        )
    )
    rows = " union all ".join(
        f"select '{name}' as test, '{severity}' as severity, ({body}) as failures" for name, severity, body in parts
    )
    return (
        "select test, severity, failures, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' "
        f"else 'fail' end as status from ({rows})"
    )


_add("data_tests", data_tests, "mart_data_conformance", _suite_sql())


def _results_log(spark: SparkSession, sf: str) -> DataFrame:
    """Two recorded builds: an older one and the suite's outcome."""
    outcome = derived(spark, sf).written("test_outcome", lambda: data_tests(spark, sf))
    now = outcome.select(
        F.lit("second").alias("invocation_id"), F.lit("build").alias("command"), F.col("test").alias("unique_id"),
        F.lit("test").alias("resource_type"), "status", "failures", F.lit("").alias("message"),
        F.lit(v.SECOND_LOAD).cast("timestamp").alias("recorded_at"),
    )
    old = now.withColumns(
        {"invocation_id": F.lit("first"), "status": F.lit("error"), "recorded_at": F.lit(v.FIRST_LOAD).cast("timestamp")}
    )
    return now.unionByName(old)


_add(
    "latest_test_status",
    lambda spark, sf: reports.latest_test_status(_results_log(spark, sf)),
    "mart_data_conformance",
    "select 'test' as resource_type, 0 as success, count(*) filter (where status = 'pass') as pass, "
    "count(*) filter (where status = 'warn') as warn, count(*) filter (where status = 'fail') as fail, "
    f"0 as error, 0 as other from ({_suite_sql()})",
)
_add(
    "failing_nodes",
    lambda spark, sf: reports.failing_nodes(_results_log(spark, sf)),
    "mart_data_conformance",
    f"select test as unique_id, status, failures, '' as message from ({_suite_sql()}) where status <> 'pass'",
)
_add(
    "source_freshness",
    lambda spark, sf: freshness(
        derived(spark, sf)["nhtsa_recalls"], "_loaded_at", F.lit("2024-02-05 06:00:00").cast("timestamp"), 2, 8, "recalls"
    ).unionByName(
        freshness(
            derived(spark, sf)["nhtsa_complaints"], "_loaded_at", F.lit("2024-02-02 06:00:00").cast("timestamp"), 2, 8, "complaints"
        )
    ),
    "nhtsa_recalls",
    "select 'recalls' as source, strftime(max(_loaded_at), '%Y-%m-%d %H:%M:%S') as newest, "
    "case when timestamp '2024-02-05 06:00:00' - max(_loaded_at) > interval 8 day then 'error' "
    "when timestamp '2024-02-05 06:00:00' - max(_loaded_at) > interval 2 day then 'warn' else 'pass' end as status from nhtsa_recalls "
    "union all select 'complaints', strftime(max(_loaded_at), '%Y-%m-%d %H:%M:%S'), "
    "case when timestamp '2024-02-02 06:00:00' - max(_loaded_at) > interval 8 day then 'error' "
    "when timestamp '2024-02-02 06:00:00' - max(_loaded_at) > interval 2 day then 'warn' else 'pass' end from nhtsa_complaints",
)
_add(
    "marts_profile",
    lambda spark, sf: profile({n: derived(spark, sf)[n] for n in MODEL_COLUMNS if n.startswith(("dim_", "fct_", "mart_"))}),
)

# ------------------------------------------------------------------------------ reports


def _report(name: str, report: Callable[..., DataFrame], select: str, **args) -> None:
    # Statements follow the models' own list of common tables.
    body = f"select * from ({select})" if select.startswith("with") else select
    _add(name, lambda spark, sf: report(derived(spark, sf).build_all(), **args), "mart_data_conformance", body)


_GAP_TOTAL = "complaints_total + recall_campaigns > 0"
_BANDS = "age_band in ('3-5 (early aftermarket)', '6-12 (aftermarket core)')"
_CIVIC = "(select vehicle_key from dim_vehicle where make = 'HONDA' and model_name = 'Civic' and model_year = 2018 and in_vpic)"
_CIVIC_ARGS = {"make": "HONDA", "model": "Civic", "year": 2018}

_report(
    "headline",
    reports.headline,
    """select (select count(*) from fct_complaint) as complaints, (select count(*) from dim_recall_campaign) as campaigns,
    (select count(*) from dim_vehicle where in_vpic) as vehicles, (select count(*) from dim_part where part_status = 'Active') as parts,
    (select count(*) from fct_part_fitment) as fitments,
    (select count(*) from mart_coverage_gap where complaints_recent > 0 and coverage_status = 'uncovered') as uncovered_pairs,
    (select strftime(max(received_date), '%Y-%m-%d') from fct_complaint) as as_of""",
)
_report(
    "category_trend",
    reports.category_trend,
    """select strftime(month, '%Y-%m-%d') as month, part_category, cast(sum(complaints) as bigint) as complaints
    from mart_component_trends
    where part_category in (select part_category from mart_component_trends
        where part_category in (select part_category from dim_component where aftermarket_serviceable)
        group by 1 order by sum(complaints) desc, part_category limit 5)
      and month >= (select max(month) from mart_component_trends) - interval 5 year
      and month < (select date_trunc('month', max(received_date)) from fct_complaint)
    group by all""",
)
_report(
    "recent_demand_by_status",
    reports.recent_demand_by_status,
    """select d.s as coverage_status, coalesce(g.pairs, 0) as pairs, coalesce(g.complaints, 0) as complaints,
    round(coalesce(g.complaints / sum(g.complaints) over (), 0), 4) as share
    from (values ('uncovered'), ('thin'), ('covered')) d(s)
    left join (select coverage_status, count(*) as pairs, cast(sum(complaints_recent) as bigint) as complaints
               from mart_coverage_gap where complaints_recent > 0 group by 1) g on g.coverage_status = d.s""",
)
_report(
    "biggest_opportunities",
    reports.biggest_opportunities,
    """select make, model_name, model_year, part_category, complaints_recent, complaints_severe, recall_campaigns,
    parts_covering, coverage_status, opportunity_score from mart_coverage_gap where opportunity_score > 0
    order by opportunity_score desc, vehicle_key, part_category limit 15""",
)
_report(
    "ranked_gaps",
    reports.ranked_gaps,
    f"""select make, model_name, model_year, age_band, part_category, complaints_total, complaints_recent, complaints_severe,
    recall_campaigns, parts_covering, category_median_parts, coverage_status, demand_index, opportunity_score
    from mart_coverage_gap where {_GAP_TOTAL} and {_BANDS} and coverage_status in ('uncovered', 'thin')""",
)
_report(
    "ranked_gaps_one_make",
    reports.ranked_gaps,
    f"""select make, model_name, model_year, age_band, part_category, complaints_total, complaints_recent, complaints_severe,
    recall_campaigns, parts_covering, category_median_parts, coverage_status, demand_index, opportunity_score
    from mart_coverage_gap where {_GAP_TOTAL} and part_category = 'Brakes' and make = 'FORD'""",
    category="Brakes", make="FORD", bands=(), statuses=(),
)
_report(
    "category_status_shares",
    reports.category_status_shares,
    f"""select part_category, uncovered, thin, covered, complaints, round(uncovered / complaints, 4) as uncovered_share from (
    select part_category, cast(sum(case when coverage_status = 'uncovered' then complaints_recent else 0 end) as bigint) as uncovered,
           cast(sum(case when coverage_status = 'thin' then complaints_recent else 0 end) as bigint) as thin,
           cast(sum(case when coverage_status = 'covered' then complaints_recent else 0 end) as bigint) as covered,
           cast(sum(complaints_recent) as bigint) as complaints
    from mart_coverage_gap where {_GAP_TOTAL} and {_BANDS} group by 1) where complaints > 0""",
)
_report(
    "model_list",
    reports.model_list,
    "select model_name, count(*) as n from dim_vehicle where make = 'HONDA' and in_vpic group by 1",
    make="HONDA",
)
_report(
    "complaints_by_model_year",
    reports.complaints_by_model_year,
    """select d.model_year, count(c.complaint_id) as complaints from dim_vehicle d left join fct_complaint c
    on c.vehicle_key = d.vehicle_key where d.make = 'HONDA' and d.model_name = 'Civic' and d.in_vpic group by 1""",
    make="HONDA", model="Civic",
)
_report(
    "vehicle_stats",
    reports.vehicle_stats,
    f"""select (select count(*) from fct_complaint where vehicle_key = {_CIVIC}) as complaints,
    (select count(*) from fct_complaint where vehicle_key = {_CIVIC} and is_severe) as severe,
    (select count(distinct campaign_number) from fct_recall_vehicle_component where vehicle_key = {_CIVIC}) as recalls,
    (select count(distinct part_number) from fct_part_fitment where vehicle_key = {_CIVIC}) as parts""",
    **_CIVIC_ARGS,
)
_report(
    "vehicle_gaps",
    reports.vehicle_gaps,
    f"""select part_category, complaints_total, complaints_severe, recall_campaigns, parts_covering, coverage_status,
    opportunity_score from mart_coverage_gap where vehicle_key = {_CIVIC}""",
    **_CIVIC_ARGS,
)
_report(
    "vehicle_recalls",
    reports.vehicle_recalls,
    f"""select campaign_number, strftime(report_received_date, '%Y-%m-%d') as report_received_date, manufacturer, units_affected,
    do_not_drive, defect_summary from dim_recall_campaign
    where campaign_number in (select campaign_number from fct_recall_vehicle_component where vehicle_key = {_CIVIC})""",
    **_CIVIC_ARGS,
)
_report(
    "vehicle_parts",
    reports.vehicle_parts,
    f"""select p.part_number, p.part_type, p.part_category, f.position, p.brand, cast(p.list_price as double) as list_price,
    p.part_status, f.is_interchange from fct_part_fitment f join dim_part p on p.part_number = f.part_number
    where f.vehicle_key = {_CIVIC}""",
    **_CIVIC_ARGS,
)
_report(
    "vehicle_complaints",
    reports.vehicle_complaints,
    f"""select strftime(received_date, '%Y-%m-%d') as received_date, is_crash, is_fire, injuries, odometer_miles, narrative
    from fct_complaint where vehicle_key = {_CIVIC} order by fct_complaint.received_date desc nulls last, complaint_id limit 25""",
    **_CIVIC_ARGS,
)
_report(
    "conformance_table",
    reports.conformance_table,
    """select source, rows_total, rows_in_scope, rows_in_reference_years, matched_exact, matched_rule, matched_prefix,
    exact_match_rate, vpic_match_rate from mart_data_conformance""",
)
_report(
    "do_not_drive_campaigns",
    reports.do_not_drive_campaigns,
    "select count(*) as campaigns from dim_recall_campaign where do_not_drive",
)
# The question set. Expected answers count keys of the facts by attributes looked up per key.
_VEHICLES = "select vehicle_key from dim_vehicle where"
_KEYS_IN = "select component_key from dim_component where part_category ="
_report(
    "top_makes_2024",
    reports.top_makes,
    """with per_vehicle as (select vehicle_key, count(*) as n from fct_complaint
        where received_date between date '2024-01-01' and date '2024-12-31' group by all),
    per_make as (select make, sum(n)::bigint as complaints from per_vehicle natural join (select vehicle_key, make from dim_vehicle) group by make)
    select make, complaints from per_make qualify row_number() over (order by complaints desc, make) <= 5""",
)
_report(
    "civic_2018_top_category",
    reports.top_category_of_vehicle,
    f"""with cited as (select distinct complaint_id, component_key from fct_complaint_component
        where complaint_id in (select complaint_id from fct_complaint where vehicle_key in
            ({_VEHICLES} (make, model_norm, model_year) = ('HONDA', 'CIVIC', 2018)))),
    pairs as (select distinct complaint_id, (select part_category from dim_component k where k.component_key = cited.component_key) as part_category from cited)
    select part_category, count(*) as complaints from pairs group by part_category
    qualify row_number() over (order by count(*) desc, part_category) = 1""",
)
_report(
    "f150_fires",
    reports.fires_of_model,
    f"""select count(*) filter (is_fire and vehicle_key in ({_VEHICLES} make = 'FORD' and model_norm = 'F 150')) as fire_complaints
    from fct_complaint""",
)
_report(
    "recalls_per_year",
    reports.recalls_per_year,
    """with years as (select unnest(range(2020, 2025))::integer as year),
    dated as (select strftime(report_received_date, '%Y')::integer as y from dim_recall_campaign where report_received_date is not null)
    select year, (select count(*) from dated where y = year) as campaigns from years where year in (select y from dated)""",
)
_report(
    "uncovered_categories",
    reports.uncovered_categories,
    """with counted as (select part_category, count_if(coverage_status = 'uncovered' and complaints_recent > 0) as uncovered_vehicles
        from mart_coverage_gap group by all)
    select part_category, uncovered_vehicles from counted where uncovered_vehicles > 0
    qualify row_number() over (order by uncovered_vehicles desc, part_category) <= 5""",
)
_report(
    "avg_price_by_category",
    reports.average_price_by_category,
    """with active as (select part_category, list_price::double as price from dim_part where part_status = 'Active')
    select part_category, round(sum(price) / count(price), 2) as avg_list_price from active group by all""",
)
_report(
    "camry_2017_parts",
    reports.parts_for_vehicle,
    f"""select count(*) as parts from dim_part where part_status = 'Active' and part_number in
    (select part_number from fct_part_fitment where vehicle_key in
        ({_VEHICLES} (make, model_norm, model_year) = ('TOYOTA', 'CAMRY', 2017)))""",
)
_report(
    "fuel_system_opportunities",
    reports.top_opportunities_in_category,
    """select make, model_name, model_year from mart_coverage_gap where part_category = 'Fuel System'
    qualify row_number() over (order by opportunity_score desc, vehicle_key) <= 10""",
)
_report(
    "largest_recall_since_2020",
    reports.largest_recall,
    """with since as (select campaign_number, coalesce(units_affected, -1) as u, units_affected from dim_recall_campaign
        where year(report_received_date) > 2019)
    select min(campaign_number) as campaign_number, any_value(units_affected) as units_affected from since
    where u = (select max(u) from since) having count(*) > 0""",
)
_report(
    "brake_complaints_by_state_2023",
    reports.top_state_for_category,
    f"""with cited as (select distinct complaint_id from fct_complaint_component where component_key in ({_KEYS_IN} 'Brakes'))
    select owner_state, count(*) as complaints from fct_complaint
    where complaint_id in (from cited) and owner_state is not null and received_date between date '2023-01-01' and date '2023-12-31'
    group by owner_state qualify row_number() over (order by count(*) desc, owner_state) = 1""",
)
_report(
    "vehicles_not_listed",
    reports.vehicles_not_listed,
    "select count_if(not in_vpic)::bigint as vehicles from dim_vehicle",
)
for _suffix, _least in (("", 500), ("_5000", 5000)):
    _report(
        f"crash_share_by_make{_suffix}",
        reports.crash_share_by_make,
        f"""with per_make as (select (select make from dim_vehicle d where d.vehicle_key = c.vehicle_key) as make,
            count(*) as n, count_if(is_crash) as crashes from fct_complaint c group by all)
        select make, round(crashes / n::double, 4) as crash_share from per_make where n >= {_least} and make is not null
        qualify row_number() over (order by round(crashes / n::double, 4) desc, make) = 1""",
        at_least=_least,
    )
_report(
    "electrical_by_age_band",
    reports.recent_by_age_band,
    """with cells as (from mart_coverage_gap select age_band, complaints_recent where part_category = 'Electrical & Ignition')
    select age_band, sum(complaints_recent)::bigint as complaints from cells group by all""",
)
_report(
    "tesla_severe_by_model",
    reports.severe_by_model,
    """with severe as (select vehicle_key, count(*) as n from fct_complaint where is_severe group by all)
    select model_name, sum(n)::bigint as severe_complaints from severe
    natural join (select vehicle_key, model_name from dim_vehicle where make = 'TESLA') group by all""",
)


def ad_hoc_sql(spark: SparkSession, sf: str) -> DataFrame:
    """P-14, F-16: a user's SQL text with positional parameters over the marts."""
    d = derived(spark, sf)
    text = (
        "select make, count(*) as vehicles from {dim_vehicle} where model_name ilike ? and model_year >= ? "
        "group by make order by make"
    )
    rows, flag = reports.ask(spark, text, {"dim_vehicle": d["dim_vehicle"]}, ["%e%", 2015])
    return rows.withColumn("truncated", flag.select("truncated").scalar())


_add(
    "ad_hoc_sql",
    ad_hoc_sql,
    "dim_vehicle",
    "select make, count(*) as vehicles, count(*) over () > 500 as truncated from dim_vehicle "
    "where model_name ilike '%e%' and model_year >= 2015 group by make",
)
