"""Derive complaint, recall, reference and catalog feeds from the given tables.

Every feed is a row-wise projection of one table (order lines -> complaint rows, events ->
recall rows, parts -> reference and catalog rows), so its size grows with that table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgap.plans import intermediate, marts, staging
from fieldgap.plans.catalog import JudgedFeed, judge_fitment, judge_parts
from fieldgap.plans.reference import (
    component_taxonomy,
    make_aliases,
    model_rules,
    serviceable_categories,
)
from fieldgap.session import scratch_path
from fieldgap.workload import values as v


def pick(items: Sequence, index: str) -> Column:
    """Constant list element by zero-based index. One SQL text costs one call into the JVM."""
    listed = ", ".join("null" if i is None else f"{i!r}" for i in items)
    return F.expr(f"element_at(array({listed}), cast(({index}) + 1 as int))")


def compact(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def part_code(p: str) -> Column:
    """Four letters and six digits; distinct for 4.5e11 parts."""
    letters = [F.expr(f"chr(65 + cast(({p}) div {1000000 * 26**i} as bigint) % 26)") for i in (3, 2, 1, 0)]
    return F.concat(*letters, F.lpad(F.expr(f"cast(({p}) % 1000000 as string)"), 6, "0"))


def complaint_rows(lineitem: DataFrame) -> DataFrame:
    """One complaint x component row per order line; an order is one complaint.

    (order, line number) repeats in the table, which plays the part of re-deliveries.
    """
    make = pick([m for m, _ in v.OBSERVED], f"l_orderkey % {len(v.OBSERVED)}")
    model = pick([m for _, m in v.OBSERVED], f"l_orderkey % {len(v.OBSERVED)}")
    shipped = F.col("l_shipdate").cast("date")
    year = F.expr(f"cast(2010 + (l_orderkey div {len(v.OBSERVED)}) % 15 as string)")
    late = F.col("l_linestatus") == "O"
    qty = F.col("l_quantity")
    return lineitem.select(
        F.expr("cast(l_orderkey * 10 + l_linenumber as string)").alias("cmplid"),
        F.col("l_orderkey").cast("string").alias("odino"),
        F.nullif(F.trim(make), F.lit("")).alias("maketxt"),
        model.alias("modeltxt"),
        F.when(F.expr("l_orderkey % 97 = 0"), "9999")
        .when(F.expr("l_orderkey % 101 = 0"), "20l5")
        .when(F.expr("l_orderkey % 103 = 0"), F.lit(None))
        .otherwise(year)
        .alias("yeartxt"),
        F.when((F.col("l_returnflag") == "R") & (qty > 45), "Y")
        .when(F.col("l_returnflag") == "A", "N")
        .alias("crash"),
        F.when(F.expr("l_suppkey % 7 = 0"), "20201305")
        .otherwise(compact(F.date_add(shipped, 8390)))
        .alias("faildate"),
        F.when((F.col("l_discount") > 0.095) & (qty > 40), "YES").otherwise("N").alias("fire"),
        F.when(qty > 49, "2").when(F.col("l_tax") > 0.075, "x").otherwise("0").alias("injured"),
        F.when((qty > 49) & (F.col("l_returnflag") == "R"), "1").alias("deaths"),
        F.nullif(F.trim(pick(v.COMPONENTS, f"l_partkey % {len(v.COMPONENTS)}")), F.lit("")).alias("compdesc"),
        pick(v.STATES, f"l_suppkey % {len(v.STATES)}").alias("state"),
        compact(F.date_add(shipped, F.expr("cast(8400 + l_linenumber as int)"))).alias("datea"),
        F.when(F.expr("l_orderkey % 211 = 0"), "unknown")
        .otherwise(compact(F.date_add(shipped, 8400)))
        .alias("ldate"),
        F.when(F.expr("l_partkey % 9 = 0"), "0")
        .when(F.expr("l_partkey % 9 = 1"), "12.5e3")
        .when(F.expr("l_partkey % 9 = 2"), "n/a")
        .otherwise(F.floor("l_extendedprice").cast("string"))
        .alias("miles"),
        F.concat(
            F.lit("line "), F.col("l_linenumber"), F.lit(" part "), F.col("l_partkey"),
            F.lit(" supplier "), F.col("l_suppkey"), F.lit(" amount "), F.floor("l_extendedprice"),
        ).alias("cdescr"),
        pick(v.CHANNELS, f"l_suppkey % {len(v.CHANNELS)}").alias("cmpl_type"),
        F.when(F.expr("l_orderkey % 3 = 0"), "4WD").alias("drive_train"),
        F.when(F.expr("l_orderkey % 5 = 0"), "GS").otherwise("HY").alias("fuel_type"),
        F.lit("AUTO").alias("trans_type"),
        F.when(F.expr("l_suppkey % 11 = 0"), "T").otherwise("V").alias("prod_type"),
        F.when(qty > 47, "Y").alias("medical_attn"),
        F.when(F.col("l_discount") < 0.005, "y").otherwise("N").alias("vehicles_towed_yn"),
        F.when(late, "complaints_b").otherwise("complaints_a").alias("_source"),
        F.when(late, F.lit(v.SECOND_LOAD)).otherwise(F.lit(v.FIRST_LOAD)).cast("timestamp").alias("_loaded_at"),
    )


def recall_rows(events: DataFrame) -> DataFrame:
    """One campaign x vehicle x component row per event; a user is one campaign."""
    at = f"(event_id * 7 + user_id) % {len(v.OBSERVED)}"
    opened = F.expr("date_add(date '2016-01-01', cast((user_id * 17) % 3200 + event_id % 3 as int))")
    year = F.expr(f"cast(2010 + (event_id div {len(v.OBSERVED)}) % 15 as string)")
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("record_id"),
        F.concat(F.lit("20V"), F.col("user_id")).alias("campno"),
        F.nullif(F.trim(pick([m for m, _ in v.OBSERVED], at)), F.lit("")).alias("maketxt"),
        pick([m for _, m in v.OBSERVED], at).alias("modeltxt"),
        F.when(F.expr("event_id % 89 = 0"), "9999")
        .when(F.expr("event_id % 83 = 0"), "20l5")
        .otherwise(year)
        .alias("yeartxt"),
        F.concat(F.lit("M"), F.col("user_id")).alias("mfgcampno"),
        F.nullif(F.trim(pick(v.COMPONENTS, f"(event_id div 3) % {len(v.COMPONENTS)}")), F.lit("")).alias("compname"),
        F.concat(
            F.lit("Maker "), F.expr("user_id % 17"), F.when(F.expr("event_id % 5 = 0"), " Inc").otherwise("")
        ).alias("mfgname"),
        compact(F.date_add(opened, -900)).alias("bgman"),
        compact(F.date_add(opened, -90)).alias("endman"),
        F.when(kind == "signup", "E").otherwise("V").alias("rcltypecd"),
        F.when(F.expr("event_id % 13 = 0"), F.lit(None))
        .otherwise(F.expr("cast((user_id * 37) % 90000 + 100 as string)"))
        .alias("potaff"),
        compact(F.date_add(opened, 30)).alias("odate"),
        pick(v.STARTERS, f"event_id % {len(v.STARTERS)}").alias("influenced_by"),
        compact(opened).alias("rcdate"),
        F.concat(F.lit("Defect "), kind, F.lit(" "), F.expr("event_id % 1000")).alias("desc_defect"),
        F.when(F.expr("event_id % 4 <> 0"), F.concat(F.lit("May fail after "), F.floor("value"))).alias("consequence_defect"),
        F.concat(F.lit("Replace at "), F.expr("event_id % 7")).alias("corrective_action"),
        F.concat(F.lit("Unit "), F.expr("event_id % 11")).alias("mfr_comp_name"),
        F.concat(F.lit("N"), F.expr("event_id % 13")).alias("mfr_comp_ptno"),
        F.when((kind == "error") & F.expr("event_id % 50 = 0"), "Y").otherwise("N").alias("do_not_drive"),
        F.when((kind == "purchase") & F.expr("event_id % 70 = 0"), "Yes").alias("park_outside"),
        F.when(kind == "click", F.lit(v.FIRST_LOAD)).otherwise(F.lit(v.SECOND_LOAD)).cast("timestamp").alias("_loaded_at"),
    )


def listed_rows(part: DataFrame) -> DataFrame:
    """One reference row (make, model, year) per part; repeats collapse downstream."""
    at = f"p_partkey % {len(v.LISTED)}"
    make, model_id, name, kind = (pick([row[i] for row in v.LISTED], at) for i in range(4))
    return part.select(
        (model_id % 1000).cast("int").alias("make_id"),
        make.alias("make_name"),
        model_id.cast("int").alias("model_id"),
        name.alias("model_name"),
        F.expr(f"cast(2012 + (p_partkey div {len(v.LISTED)}) % 11 as int)").alias("model_year"),
        kind.alias("vehicle_type"),
    ).filter("model_id < 27000 or model_year >= 2019")


def listed_documents(part: DataFrame) -> DataFrame:
    """The reference as JSON text: one year document per part, with a substring-match stranger."""
    rows = listed_rows(part)
    item = F.struct(
        F.col("make_id").alias("Make_ID"), F.col("make_name").alias("Make_Name"),
        F.col("model_id").alias("Model_ID"), F.col("model_name").alias("Model_Name"),
    )
    stranger = F.struct(
        F.lit(9).alias("Make_ID"), F.concat("make_name", F.lit(" TRAILERS")).alias("Make_Name"),
        F.lit(1).alias("Model_ID"), F.lit("Flatbed").alias("Model_Name"),
    )
    criteria = F.concat(F.lit("Make:"), F.col("make_name"), F.lit(" | ModelYear:"), F.col("model_year"))
    return rows.select(
        F.to_json(F.struct(criteria.alias("SearchCriteria"), F.array(item, stranger).alias("Results"))).alias("doc")
    )


def listed_type_documents(part: DataFrame) -> DataFrame:
    """Type documents: the model under its type, every third model also as a truck, some without type."""
    rows = listed_rows(part)
    item = F.struct(
        F.col("model_id").alias("Model_ID"),
        F.when(F.col("model_id") % 10 != 1, F.col("vehicle_type")).alias("VehicleTypeName"),
    )
    truck = F.struct(
        F.col("model_id").alias("Model_ID"),
        F.when(F.col("model_id") % 3 == 0, F.lit(v.TRUCK)).alias("VehicleTypeName"),
    )
    return rows.select(F.to_json(F.struct(F.array(item, truck).alias("Results"))).alias("doc"))


def part_feed(part: DataFrame, revision: int = 2) -> DataFrame:
    """Parts master as delivered: text cells, injected defects, later copies of some numbers.

    Revision 0 lacks some parts, 1 lacks others, prices move at 1 and statuses at 2.
    """
    code = part_code("p_partkey")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    if revision >= 1:
        price = price + F.when(F.expr("p_partkey % 25 = 0"), F.lit(1)).otherwise(F.lit(0))
    status = (
        F.when(F.expr("p_partkey % 41 = 0"), "Pending")
        .when(F.expr("p_size % 10 = 0"), "Discontinued")
        .when(F.expr("p_size % 10 = 1"), "Superseded")
    )
    if revision >= 2:
        status = status.when(F.expr("p_partkey % 40 = 0"), "Discontinued")
    copies = F.when(F.expr("p_partkey % 43 = 0"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    absent = {0: "p_partkey % 101 = 0", 1: "p_partkey % 97 = 0"}.get(revision, "false")
    rows = part.filter(f"not ({absent})").withColumn("copy", F.explode(copies))
    return rows.select(
        F.when(F.expr("p_partkey % 31 = 0"), F.concat(F.lower(code), F.lit("-")))
        .when(F.expr("p_partkey % 33 = 0"), F.concat(F.lit(" "), code))
        .otherwise(code)
        .alias("part_number"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("part_type"),
        F.when(F.expr("p_partkey % 37 = 0"), "")
        .when(F.expr("p_partkey % 38 = 0"), "Mystery")
        .otherwise(pick(serviceable_categories(), f"p_size % {len(serviceable_categories())}"))
        .alias("part_category"),
        F.col("p_name").alias("description"),
        F.when(F.expr("p_partkey % 29 = 0"), "N/A")
        .when(F.expr("p_partkey % 30 = 0"), "-12.50")
        .otherwise((price + F.col("copy") * 10).cast("decimal(12,2)").cast("string"))
        .alias("list_price"),
        status.otherwise("Active").alias("status"),
        F.when(F.expr("p_partkey % 17 = 0"), "n/a")
        .otherwise(F.expr("cast(date_add(date '2005-01-01', cast(p_partkey % 6000 as int)) as string)"))
        .alias("introduced_date"),
        F.when(F.expr("p_size % 10 = 1"), part_code("p_partkey + 1")).otherwise("").alias("superseded_by"),
        F.expr("p_partkey * 2 + copy").alias("_ordinal"),
    )


def fitment_feed(part: DataFrame) -> DataFrame:
    """Three fitment ranges per part, with injected defects and some exact repeats."""
    at = f"(p_partkey * 3 + line * 5) % {len(v.LISTED)}"
    make = F.upper(pick([row[0] for row in v.LISTED], at))
    model = pick([row[2] for row in v.LISTED], at)
    first = F.expr("2010 + p_partkey % 8")
    last = F.expr("2010 + p_partkey % 8 + p_size % 6")
    swap = F.expr("p_partkey % 71 = 0")
    lines = part.withColumn("line", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    copies = F.when(F.expr("p_partkey % 53 = 0 and line = 0"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return lines.withColumn("copy", F.explode(copies)).select(
        F.when(F.expr("p_partkey % 59 = 0 and line = 1"), "ZZZZ999999").otherwise(part_code("p_partkey")).alias("part_number"),
        F.when(F.expr("p_partkey % 61 = 0"), "TOYTOA")
        .when((make == "CHEVROLET") & F.expr("p_partkey % 5 = 0"), "Chevy")
        .when(F.expr("p_partkey % 7 = 1"), F.concat(F.lit("  "), F.lower(make)))
        .otherwise(make)
        .alias("make"),
        F.when(F.expr("p_partkey % 67 = 0"), "")
        .when(F.expr("p_partkey % 11 = 0"), F.concat(F.lit(" "), F.lower(model), F.lit(" ")))
        .otherwise(model)
        .alias("model"),
        F.when(F.expr("p_partkey % 79 = 0"), "20l5").otherwise(F.when(swap, last + 1).otherwise(first).cast("string")).alias("year_start"),
        F.when(F.expr("p_partkey % 73 = 0"), "2099").otherwise(F.when(swap, first).otherwise(last).cast("string")).alias("year_end"),
        pick(v.POSITIONS, "(p_partkey + line) % 4").alias("position"),
        F.when(F.expr("p_partkey % 6 = 0"), "Interchange").otherwise("").alias("note"),
        F.expr("(p_partkey * 4 + line) * 2 + copy").alias("_ordinal"),
    )


# Models that several others read, in waves that only need earlier waves. They are written
# once to the shared folder and read back, so that neither the work nor the lineage is
# repeated in every consumer.
WAVES = [
    ["stg_complaints", "stg_recalls", "stg_catalog_fitment", "snap_catalog_parts"],
    ["int_model_conformance", "int_fitment_exploded", "fct_complaint_component", "dim_recall_campaign", "dim_component", "dim_part"],
    ["fct_complaint", "int_vehicles", "fct_recall_vehicle_component"],
    ["dim_vehicle", "mart_data_conformance"],
    ["fct_part_fitment", "mart_component_trends"],
    ["mart_coverage_gap"],
]
SETTLED = frozenset(name for wave in WAVES for name in wave)


class Derived:
    """The models over the feeds of one table folder.

    `lazy(name)` is the model's own plan over its inputs; `d[name]` is what consumers read:
    the written table for models in SETTLED, the plan for all others.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        self.spark, self.dir = spark, sf_dir
        self.root = root or scratch_path(spark, "models")
        self._schemas: dict[str, T.StructType] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def lazy(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def __getitem__(self, name: str) -> DataFrame:
        return self.written(name, lambda: self.lazy(name)) if name in SETTLED else self.lazy(name)

    def build_all(self) -> Derived:
        """Write every model that is not there yet; the models of a wave run side by side."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            for wave in WAVES:
                list(pool.map(self.__getitem__, [name for name in wave if name not in self._schemas]))
        return self

    def written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table `name` in the shared folder, written on first use."""
        path = f"{self.root}/{name}"
        if name in self._schemas:
            try:
                return self.spark.read.schema(self._schemas[name]).parquet(path)
            except AnalysisException as err:  # the folder was cleaned up: write again
                if err.getCondition() != "PATH_NOT_FOUND":
                    raise
        df = build()
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        self._schemas[name] = df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def make_aliases(self) -> DataFrame:
        return make_aliases(self.spark)

    def taxonomy(self) -> DataFrame:
        return component_taxonomy(self.spark)

    # ---- bronze
    def nhtsa_complaints(self) -> DataFrame:
        return complaint_rows(self.table("lineitem"))

    def nhtsa_recalls(self) -> DataFrame:
        return recall_rows(self.table("events"))

    def vpic_models(self) -> DataFrame:
        return listed_rows(self.table("part"))

    def parts_judged(self, revision: int = 2) -> JudgedFeed:
        return judge_parts(part_feed(self.table("part"), revision))

    def fitment_judged(self) -> JudgedFeed:
        valid = self.parts_judged().valid
        return judge_fitment(fitment_feed(self.table("part")), valid, self["make_aliases"], v.AS_OF_YEAR)

    def _stamped(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_loaded_at", F.lit(v.SECOND_LOAD).cast("timestamp"))

    # ---- staging
    def stg_recalls(self) -> DataFrame:
        return staging.staged_recalls(self["nhtsa_recalls"], self["make_aliases"])

    def stg_complaints(self) -> DataFrame:
        return staging.staged_complaints(self["nhtsa_complaints"], self["make_aliases"])

    def stg_reference(self) -> DataFrame:
        return staging.staged_reference(self["vpic_models"])

    def stg_catalog_parts(self) -> DataFrame:
        return staging.staged_parts(self._stamped(self.parts_judged().valid))

    def stg_catalog_fitment(self) -> DataFrame:
        return staging.staged_fitment(self._stamped(self.fitment_judged().valid))

    # ---- intermediate
    def int_model_conformance(self) -> DataFrame:
        return intermediate.model_conformance(
            self["stg_recalls"], self["stg_complaints"], self["stg_reference"], model_rules(self.spark)
        )

    def int_fitment_exploded(self) -> DataFrame:
        return intermediate.fitment_years(self["stg_catalog_fitment"])

    def int_vehicles(self) -> DataFrame:
        return intermediate.vehicle_universe(
            self["stg_reference"], self["stg_recalls"], self["stg_complaints"],
            self["int_model_conformance"], self["int_fitment_exploded"],
        )

    # ---- snapshot, dimensions, facts
    def snap_catalog_parts(self) -> DataFrame:
        history = None
        for revision, as_of in enumerate(v.SNAPSHOTS):
            delivered = self.parts_judged(revision).valid
            history = marts.part_history(history, delivered, F.lit(as_of).cast("timestamp"))
        return history

    def dim_vehicle(self) -> DataFrame:
        return marts.dim_vehicle(self["int_vehicles"], v.AS_OF_YEAR)

    def dim_component(self) -> DataFrame:
        return marts.dim_component(self["stg_recalls"], self["stg_complaints"], self["taxonomy"])

    def dim_recall_campaign(self) -> DataFrame:
        return marts.dim_recall_campaign(self["stg_recalls"])

    def dim_part(self) -> DataFrame:
        return marts.dim_part(self["snap_catalog_parts"])

    def fct_complaint(self) -> DataFrame:
        return marts.fct_complaint(self["stg_complaints"], self["int_model_conformance"])

    def fct_complaint_component(self) -> DataFrame:
        return marts.fct_complaint_component(self["stg_complaints"])

    def fct_recall_vehicle_component(self) -> DataFrame:
        return marts.fct_recall_vehicle_component(self["stg_recalls"], self["int_model_conformance"])

    def fct_part_fitment(self) -> DataFrame:
        return marts.fct_part_fitment(self["int_fitment_exploded"], self["dim_part"], self["dim_vehicle"])

    # ---- marts
    def mart_coverage_gap(self) -> DataFrame:
        return marts.mart_coverage_gap(
            self["fct_complaint"], self["fct_complaint_component"], self["fct_recall_vehicle_component"],
            self["dim_component"], self["dim_vehicle"], self["fct_part_fitment"], self["dim_part"],
        )

    def mart_component_trends(self) -> DataFrame:
        return marts.mart_component_trends(
            self["fct_complaint"], self["fct_complaint_component"], self["fct_recall_vehicle_component"],
            self["dim_component"], self["dim_vehicle"],
        )

    def mart_data_conformance(self) -> DataFrame:
        return marts.mart_data_conformance(
            self["stg_recalls"], self["stg_complaints"], self["stg_reference"],
            self["int_model_conformance"], self["int_fitment_exploded"], self["int_vehicles"],
        )
