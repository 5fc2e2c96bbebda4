"""Generic operators on small literal frames."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldgap.operators import checks, compare, conform, contract, dedup, gap, incremental, merge, ranges, ranking, sampling
from fieldgap.operators.profile import profile
from fieldgap.plans.reference import model_rules


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (1, 2, "a")], "k int, v int, x string")
    assert rows(dedup.latest_per_key(df, ["k"], [F.desc("v"), "x"])) == [(1, 2, "a"), (2, 1, "c")]


def test_flag_repeats_null_safe_and_among(spark, rows):
    df = spark.createDataFrame([(None, 1, True), (None, 2, True), ("a", 3, False), ("a", 4, True), ("a", 5, True)], "k string, o int, ok boolean")
    all_rows = dedup.flag_repeats(df, ["k"], "o", "rep").select("o", "rep")
    assert rows(all_rows) == [(1, False), (2, True), (3, False), (4, True), (5, True)]
    valid_only = dedup.flag_repeats(df, ["k"], "o", "rep", among=F.col("ok")).select("o", "rep")
    assert rows(valid_only) == [(1, False), (2, True), (3, False), (4, False), (5, True)]


def test_most_frequent_takes_lowest_on_ties(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (2, "z"), (2, "z"), (2, "a")], "k int, v string")
    assert rows(dedup.most_frequent(df, ["k"], "v")) == [(1, "a"), (2, "z")]


def test_explode_range_guards(spark, rows):
    df = spark.createDataFrame([(1, 2016, 2018), (2, 2020, 2019), (3, None, 2020), (4, 2020, 2020)], "k int, a int, b int")
    exploded = ranges.explode_range(df, "a", "b", "y")
    assert rows(exploded.select("k", "y")) == [(1, 2016), (1, 2017), (1, 2018), (4, 2020)]
    assert ranges.range_row_count(df, "a", "b").first()[0] == exploded.count()


def test_islands(spark, rows):
    df = spark.createDataFrame([(1, y) for y in (2010, 2011, 2011, 2013, 2014, 2020, None)], "k int, y int")
    assert rows(ranges.islands(df, ["k"], "y")) == [(1, 2010, 2011, 2), (1, 2013, 2014, 2), (1, 2020, 2020, 1)]
    days = spark.createDataFrame([(1, date(2024, 2, 28)), (1, date(2024, 2, 29)), (1, date(2024, 3, 1))], "k int, d date")
    assert rows(ranges.islands(days, ["k"], "d")) == [(1, date(2024, 2, 28), date(2024, 3, 1), 3)]


CONFORM = [
    ("HONDA", "CIVIC", 2018, ["CIVIC"], "exact", "CIVIC"),
    ("MERCEDES-BENZ", "AMG C43", 2019, ["C CLASS"], "rule", "C CLASS"),
    ("LEXUS", "RX 450H", 2017, ["RX"], "rule", "RX"),
    ("GMC", "SIERRA 2500 HD", 2020, ["SIERRA HD", "SIERRA"], "rule", "SIERRA HD"),
    ("GMC", "SIERRA 2500 HD", 2015, ["SIERRA"], "prefix", "SIERRA"),
    ("FORD", "F 250 SD", 2016, ["F 250", "F"], "prefix", "F 250"),
    ("KIA", "SOULEV", 2016, ["SOUL"], "unmatched", "SOULEV"),
    ("HONDA", "CIVIC", 2030, [], "unmatched", "CIVIC"),
]


def test_conform_names(spark):
    observed = spark.createDataFrame([(m, y, n) for m, n, y, *_ in CONFORM], "make string, model_year int, model_norm string")
    listed = spark.createDataFrame(
        [(m, y, r) for m, _, y, refs, *_ in CONFORM for r in refs], "make string, model_year int, model_norm string"
    )
    got = conform.conform_names(observed.union(observed), listed, model_rules(spark))
    assert got.columns == ["make", "source_model_norm", "model_year", "model_norm", "match_method"]
    assert {(r.make, r.source_model_norm, r.model_year): (r.match_method, r.model_norm) for r in got.collect()} == {
        (m, n, y): (method, name) for m, n, y, _, method, name in CONFORM
    }


def test_full_outer_merge_keeps_null_keys(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    right = spark.createDataFrame([("a", 5), (None, 6), ("b", 7)], "k string, y int")
    got = merge.full_outer_merge(left, right, ["k"], {"x": 0, "y": 0})
    assert rows(got) == [(None, 0, 6), (None, 2, 0), ("a", 1, 5), ("b", 0, 7)]


def test_orphans_skip_missing_references(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, ref string")
    parent = spark.createDataFrame([("a",), ("b",)], "key string")
    assert rows(merge.orphans(child, parent, {"ref": "key"})) == [(3, "z")]


def test_rank_with_a_hot_tie_equals_window_rank(spark):
    df = spark.range(3000).select(
        "id", (F.col("id") % 2).cast("string").alias("g"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") * 37 % 991) / 7.0).alias("s"),
    )
    got = {r.id: r.place for r in ranking.rank_within(df, "g", "s", "place").collect()}
    expected = df.selectExpr("id", "rank() over (partition by g order by round(s, 9) desc) as place")
    assert got == {r.id: r.place for r in expected.collect()}


def test_capped(spark):
    for n, size, cut in ((100, 100, True), (1000, 1000, False), (2000, 1000, False)):
        out, flag = ranking.capped(spark.range(1000), n)
        assert (out.count(), tuple(flag.first())) == (size, (size, cut))


def test_domain_and_shares(spark, rows):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "s string, n int")
    full = ranking.on_domain(df, "s", ["a", "b", "c"], ["n"])
    assert rows(ranking.with_share(full, "n", "p")) == [("a", 3, 0.75), ("b", 1, 0.25), ("c", 0, 0.0)]


def test_pivot_counts(spark, rows):
    df = spark.createDataFrame([("t", "pass"), ("t", "pass"), ("m", "fail")], "k string, s string")
    assert rows(ranking.pivot_counts(df, "k", "s", ["pass", "warn"])) == [("m", 0, 0), ("t", 2, 0)]


@pytest.mark.parametrize(
    "signal, parts, median_parts, weight, status, demand, score",
    [
        ((0, 0, 1), 0, 6, 1.25, "uncovered", 1.040, 1.300),
        ((9, 1, 0), 2, 6, 1.0, "thin", 3.689, 1.844),
        ((9, 1, 0), 3, 6, 1.0, "covered", 3.689, 0.0),
    ],
)
def test_scoring(spark, signal, parts, median_parts, weight, status, demand, score):
    signals = spark.createDataFrame([("v", "c", *signal)], "e string, c string, recent long, severe long, recalls long")
    # Two equal neighbours above and one below fix the median.
    others = [("x", "c", median_parts), ("y", "c", median_parts), ("z", "c", median_parts)]
    cover = spark.createDataFrame(others + ([("v", "c", parts)] if parts else []), "e string, c string, parts long")
    entities = spark.createDataFrame([("v", weight)], "e string, w double")
    terms = {"recent": 1.0, "severe": 2.0, "recalls": 1.5}
    got = gap.coverage_gap(signals, cover, entities, "e", "c", "parts", terms, "w", "median").first()
    assert (got.coverage_status, got.demand_index, got.opportunity_score) == (status, demand, score)
    assert (got.parts, got["median"], got.category_rank) == (parts, float(median_parts), 1)


def test_uncovered_category_has_no_median(spark):
    signals = spark.createDataFrame([("v", "c", 1)], "e string, c string, n long")
    cover = spark.createDataFrame([], "e string, c string, parts long")
    entities = spark.createDataFrame([("v", 1.0)], "e string, w double")
    got = gap.coverage_gap(signals, cover, entities, "e", "c", "parts", {"n": 1.0}, "w", "median").first()
    assert (got.coverage_status, got["median"], got.demand_index) == ("uncovered", None, round(math.log(2), 3))


T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))


def test_history_of_three_deliveries(spark, rows):
    schema = "k int, price double, note string"

    def delivered(data):
        return spark.createDataFrame(data, schema)

    h = incremental.first_versions(delivered([(1, 1.0, "a"), (2, 2.0, "a"), (3, None, "a")]), F.lit(T1))
    h = incremental.next_history(h, delivered([(1, 1.0, "changed"), (3, 3.0, "b"), (4, 4.0, "b")]), "k", ["price"], F.lit(T2))
    assert rows(h) == [
        (1, 1.0, "a", T1, None),
        (2, 2.0, "a", T1, T2),
        (3, None, "a", T1, T2),
        (3, 3.0, "b", T2, None),
        (4, 4.0, "b", T2, None),
    ]
    again = incremental.next_history(h, delivered([(1, 1.0, "x"), (3, 3.0, "x"), (4, 4.0, "x")]), "k", ["price"], F.lit(T3))
    assert rows(again) == rows(h)
    back = incremental.next_history(h, delivered([(1, 1.0, "x"), (2, 2.0, "back"), (3, 3.0, "x"), (4, 4.0, "x")]), "k", ["price"], F.lit(T3))
    assert (2, 2.0, "back", T3, None) in rows(back) and (2, 2.0, "a", T1, T2) in rows(back)
    current = {r.k: (r.version_count, r.first_seen_at) for r in incremental.current_with_versions(back, "k").collect()}
    assert current == {1: (1, T1), 2: (2, T1), 3: (2, T1), 4: (1, T2)}


def test_keyed_replace_and_watermark(spark, rows):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "c", 1)], "k int, v string, ts int")
    new = spark.createDataFrame([(1, "z", 2, True), (3, "n", 2, True)], "k int, v string, ts int, extra boolean")
    assert rows(incremental.keyed_replace(old, new, ["k"])) == [(1, "z", 2, True), (2, "c", 1, None), (3, "n", 2, True)]
    source = old.unionByName(spark.createDataFrame([(2, "d", 5)], old.schema))
    assert rows(incremental.rows_of_touched_keys(source, old, "k", "ts")) == [(2, "c", 1), (2, "d", 5)]
    assert rows(incremental.rows_after(source, old, "ts")) == [(2, "d", 5)]
    empty = old.limit(0)
    assert incremental.rows_after(source, empty, "ts").count() == 4


def test_contract_collects_every_reason(spark, rows):
    df = spark.createDataFrame([(1, -1, ""), (2, 5, "x"), (3, None, "x")], "id int, price int, name string")
    judged = contract.apply_contract(
        df.withColumn("_raw", F.struct("id")),
        [contract.Check("price", F.col("price") <= 0), contract.Check("name", F.col("name") == ""), contract.Check("name", F.lit(False))],
    )
    assert rows(contract.quarantined_rows(judged, ["id"])) == [(1, "name,price")]
    assert rows(contract.valid_rows(judged).select("id")) == [(2,), (3,)]
    assert rows(contract.feed_metrics(judged, "f")) == [("f", 3, 2, 1, 0, 0, "name", 1), ("f", 3, 2, 1, 0, 0, "price", 1)]
    clean = judged.filter("id = 2")
    assert rows(contract.feed_metrics(clean, "f")) == [("f", 1, 1, 0, 0, 0, None, 0)]
    assert rows(contract.feed_metrics(judged.limit(0), "f")) == [("f", 0, 0, 0, 0, 0, None, 0)]


def test_check_runner(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, s string")
    p = spark.createDataFrame([("a",), ("b",)], "s string")
    suite = [
        checks.not_null("t", "id"), checks.accepted("t", "s", ["a", "b", "c"]), checks.unique("t", "id"),
        checks.related("t", "s", "p", "s"), checks.FrameTest("loose", t.filter("s = 'c'"), "warn"),
        checks.valid_year("t", "id", 2024),
    ]
    got = {r.test: (r.failures, r.status) for r in checks.run_checks({"t": t, "p": p}, suite).collect()}
    assert got == {
        "t.id.not_null": (1, "fail"), "t.s.accepted_values": (0, "pass"), "t.id.unique": (1, "fail"),
        "t.s.relationships": (1, "fail"), "loose": (1, "warn"), "t.id.valid_model_year": (2, "fail"),
    }


def test_rows_are_counted_per_reference_before_the_parents_are_joined(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,)], "ref long")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "key long")
    found = checks.orphan_counts(child, parent, "ref", "key")
    assert sorted((r.ref, r["_rows"]) for r in found.collect()) == [(2, 1), (3, 2)]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.index("Aggregate")
    got = checks.run_checks({"c": child, "p": parent}, [checks.related("c", "ref", "p", "key")]).first()
    assert (got.failures, got.status) == (3, "fail")


def test_packed_texts_come_back_as_they_were(spark):
    cells = [None, "", "a", "a\u0001b", "\u0002", "\u0001", "\u0002\u0002", "ä\n\t "]
    data = [(i, a, b, i * 1.5) for i, (a, b) in enumerate((a, b) for a in cells for b in cells)]
    df = spark.createDataFrame([*data, (None, "x", None, None)], "k int, s string, t string, n double")
    moved = dedup.laid_by(df, ["k"])
    assert moved.columns == df.columns and moved.dtypes == df.dtypes
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, moved.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)
    twice = df.unionByName(df.withColumn("n", F.col("n") + 1))
    newest = dedup.latest_per_key(twice, ["k"], [F.desc("n")], few_versions=True).filter("k is not null")
    assert {r.k: tuple(r) for r in newest.collect()} == {k: (k, s, t, n + 1) for k, s, t, n in data}


def test_distinct_and_repeated_keys_count_nulls_as_equal(spark):
    data = [(1, "a"), (1, "a"), (1, None), (1, None), (1, None), (None, "a"), (None, None), (2, "a"), (2, "b")]
    df = spark.createDataFrame(data, "k int, s string")
    rows = [tuple(r) for r in dedup.distinct_by(df, ["k"]).collect()]
    assert len(rows) == len(set(data)) and set(rows) == set(data)
    repeated = checks.repeated_keys(df, ["k", "s"])
    assert dict(repeated.dtypes)["occurrences"] == "bigint"
    assert {tuple(r) for r in repeated.collect()} == {(1, "a", 2), (1, None, 3)}
    assert {tuple(r) for r in checks.repeated_keys(df, ["k"]).collect()} == {(1, 5), (2, 2)}


def test_freshness(spark):
    df = spark.createDataFrame([(T1,)], "ts timestamp")
    status = lambda at: checks.freshness(df, "ts", F.lit(at), 2, 8, "s").first().status
    assert [status(datetime(2024, 1, d)) for d in (2, 4, 10)] == ["pass", "warn", "error"]
    assert checks.freshness(df.limit(0), "ts", F.lit(T1), 2, 8, "s").first().status == "error"


def test_result_equivalence(spark):
    expected = spark.createDataFrame([("HONDA", 2.0), ("FORD", 1.0)], "make string, n double")

    def matches(data, schema="make string, n double"):
        return compare.result_equivalent(expected, spark.createDataFrame(data, schema)).first().matches

    assert matches([("FORD", 1.0), ("HONDA", 2.0)])
    assert matches([("ford ", 1.0049), ("honda", 2.0)])
    assert matches([(9, "FORD", 1.0), (8, "HONDA", 2.0)], "x int, m string, total double")
    assert not matches([("FORD", 1.0), ("HONDA", 3.0)])
    assert not matches([("FORD", 1.0)])
    assert not matches([("FORD", 1.0), ("HONDA", 2.0), ("HONDA", 2.0)])
    assert not matches([])


def test_sampling_keeps_whole_groups(spark):
    df = spark.range(4000).select((F.col("id") % 200).alias("g"), "id")
    kept = sampling.hash_sample(df, "g", 0.3).groupBy("g").count().collect()
    assert 30 < len(kept) < 90 and {r["count"] for r in kept} == {20}
    assert sampling.hash_sample_groups(df, "g", 500).count() == 4000


def test_redact(spark):
    df = spark.createDataFrame([("secret", "long text")], "a string, b string")
    assert tuple(sampling.redact(df, ["a"], {"b": 4}).first()) == ("", "long")


def test_profile(spark, rows):
    out = profile({"t": spark.range(3)}, {"t": {"id": "row number"}})
    assert rows(out) == [("t", 1, "id", "bigint", "row number", 3)]
