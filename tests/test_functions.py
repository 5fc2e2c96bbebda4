"""Text, scalar and aggregate expressions, compared with DuckDB where it defines the result."""

import itertools

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldgap.functions import aggregates as A
from fieldgap.functions import scalars as S
from fieldgap.functions import text as X

NAMES = ["F-150", " f150  super_crew ", "Straße", "CR V", "", None, "ÉLAN 2.0", "---", "C300/4MATIC"]
MAKES = ["  Alfa \t Romeo ", "MERCEDES  BENZ", "x\x0by", None, " VW "]
NUMBERS = ["2014", "2014.5", "-2014.5", "1e3", " 12 ", "", None, "20l5", "2147483648", "9999", ".5", "abc", "2014.4999"]
DATES = ["20201105", "2020115", " 20201105", "20201305", "20200230", "", None, "202011", "20201105x", "00000000"]


def spark_values(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(expr(F.col("v")).alias("out"), "i").orderBy("i").collect()]


def duck_values(values, sql):
    return [duckdb.execute(f"select {sql} from (select cast(? as varchar) as v)", [v]).fetchone()[0] for v in values]


@pytest.mark.parametrize(
    "values, expr, sql",
    [
        (NAMES, X.model_name_key, "trim(regexp_replace(upper(coalesce(v, '')), '[^A-Z0-9]+', ' ', 'g'))"),
        (MAKES, X.make_name_key, r"trim(regexp_replace(upper(coalesce(v, '')), '\s+', ' ', 'g'))"),
        (MAKES + NAMES, X.blank_to_null, "nullif(trim(v), '')"),
        (["Y", "yes", "N", "", None, "y "], X.yes_flag, "upper(coalesce(v, 'N')) in ('Y', 'YES')"),
        (["a: b:c", "a", "", None], lambda c: X.path_level(c, 2), "split_part(v, ':', 2)"),
        ([" a:b ", None, ""], X.path_key, "md5(upper(trim(v)))"),
        (["A", None], lambda c: X.joined_key(c, F.lit("b"), F.lit(2020)), "md5(concat_ws('|', v, 'b', '2020'))"),
        (NUMBERS, S.tolerant_int, "try_cast(v as integer)"),
        (NUMBERS, lambda c: S.tolerant_int(c, "bigint"), "try_cast(v as bigint)"),
        (DATES, S.compact_date, "cast(try_strptime(nullif(v, ''), '%Y%m%d') as date)"),
        (
            ["u1", "u2", "17"],
            X.hash_fraction,
            "cast('0x' || substr(md5(v), 1, 8) as bigint) / 4294967295.0",
        ),
    ],
)
def test_matches_duckdb(spark, values, expr, sql):
    assert spark_values(spark, values, expr) == duck_values(values, sql)


def test_full_match_rejects_trailing_newline(spark):
    values = ["AB12345", "AB12345\n", "ab12345", "ABCDE12345", "AB1234567"]
    assert spark_values(spark, values, lambda c: X.fully_matches(c, "[A-Z]{2,4}[0-9]{5,6}")) == [
        True, False, False, False, False,
    ]


def test_replacement_groups_and_dollars(spark):
    assert spark_values(spark, [r"\2 CLASS", "a$b", r"\1"], X.java_replacement) == ["$2 CLASS", r"a\$b", "$1"]


def test_word_prefixes(spark):
    assert spark_values(spark, ["F 250 SD", "CIVIC", ""], X.word_prefixes) == [["F", "F 250"], [], []]


def test_collapse_spaces_keeps_case(spark):
    assert spark_values(spark, ["\t Model  S ", "x"], X.collapse_spaces) == ["Model S", "x"]


def test_sentinels_iso_and_bands(spark):
    assert spark_values(spark, ["1.5", "N/A", "", None], lambda c: S.number_or(c, -1)) == [1.5, -1.0, -1.0, -1.0]
    assert [str(x) for x in spark_values(spark, ["2020-01-31", "x", ""], S.iso_date)] == ["2020-01-31", "None", "None"]
    band = lambda c: S.banded(c.cast("int"), [(2, "new"), (5, "mid"), (None, "old")])
    assert spark_values(spark, ["0", "2", "3", "6"], band) == ["new", "new", "mid", "old"]


def test_months_before_clamps(spark):
    df = spark.sql("select date '2024-05-31' as d")
    assert str(df.select(S.months_before(F.col("d"), 3)).first()[0]) == "2024-02-29"


def test_all_of_ignores_absent_predicates(spark):
    df = spark.range(10)
    assert df.filter(S.all_of([None, F.col("id") > 3, None, F.col("id") < 6])).count() == 2
    assert df.filter(S.all_of([])).count() == 10


def test_aggregates_skip_missing_values(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, 1), (1, None, 9, 2), (1, "b", 5, 0), (2, None, 1, 0), (1, "c", None, 3)],
        "k int, x string, y int, t int",
    )
    got = df.groupBy("k").agg(
        A.max_by_present(F.col("x"), F.col("y"), F.col("t")).alias("hi"),
        A.min_by_present(F.col("x"), F.col("y"), F.col("t")).alias("lo"),
        A.distinct_tuples(F.col("x"), F.col("y")).alias("pairs"),
        A.distinct_where(F.col("x"), F.col("t") > 0).alias("some"),
    )
    assert {r.k: (r.hi, r.lo, r.pairs, r.some) for r in got.collect()} == {1: ("b", "b", 2, 2), 2: (None, None, 0, 0)}


def test_ratio_of_nothing_is_missing(spark):
    df = spark.sql("select 1 as a, 0 as z, 3 as b")
    assert tuple(df.select(A.ratio(F.col("a"), F.col("z")), A.ratio(F.col("a"), F.col("b"))).first()) == (None, 0.3333)


def test_tolerant_int_is_the_two_casts_on_any_text(spark):
    """Text that is not cast is text that the casts refuse."""
    texts = ["7", " 7 ", "+7", "-7", "7.", ".5", "1.5", "2.5", "12.5e3", "1E2", "e3", "3e", "n/a", "x", "20l5", "", " ", None,
             "1/2", "0x1F", "1d", "1f", "1L", "NaN", "Infinity", "٣", "1٣.5", "9" * 12, "1e30", "1_0", "1,0", "\t7\n",
             " 7", "7　", "\x007", "7\x1f", "--7", "+ 7", "é", "1e+2", "1e-2", "-1.5"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("int", "bigint"):
        c = F.col("t")
        casts = F.coalesce(c.try_cast(kind), F.round(X.trim_spaces(c).try_cast("decimal(38,10)"), 0).try_cast(kind))
        assert rows.filter(~S.tolerant_int(c, kind).eqNullSafe(casts)).collect() == []


def test_no_cast_is_tried_on_text_that_is_no_number(spark, capsys):
    spark.createDataFrame([("x",)], "t string").select(S.tolerant_int(F.col("t"))).explain(True)
    analysed = capsys.readouterr().out.split("Analyzed Logical Plan")[1].split("Optimized Logical Plan")[0]
    assert all(f"NOT RLIKE(t, {signs})" in analysed for signs in (S.NOT_WHOLE, S.NOT_DECIMAL))


def test_names_as_collapsed_and_split_in_full(spark):
    signs = ["", " ", "a", "~", "!", " ", "　", "\t", "\n", "\f", "\r", "\x0b", "\x7f", "é", "  ", ":", "\x85"]
    texts = [None, *["".join(t) for n in range(4) for t in itertools.product(signs, repeat=n)]]
    rows = spark.createDataFrame(pa.table({"t": pa.array(dict.fromkeys(texts), pa.string())}))
    c = F.col("t")
    full = {
        "make": (X.make_name_key(c), X.trim_spaces(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), X.WHITESPACE_RUN, " "))),
        "level": (X.path_level(c, 1), F.split_part(c, F.lit(":"), F.lit(1))),
    }
    for name, (found, expected) in full.items():
        assert rows.filter(~found.eqNullSafe(expected)).collect() == [], name


def test_names_and_trimmed_text_as_spelled_out(spark):
    """What spares work gives what the plain expressions give."""
    signs = ["", " ", "a", "~", "!", "\u00a0", "\u3000", "\t", "\n", "\x7f", "é", "  ", "\x00", "😀", "Z", "9", "_"]
    texts = ["".join(t) for n in range(4) for t in itertools.product(signs, repeat=n)]
    texts += [f"x{chr(i)}y{chr(i)}" for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    rows = spark.createDataFrame(pa.table({"t": pa.array([None, *dict.fromkeys(texts)], pa.string())}))
    c = F.col("t")
    full = {
        "trim": (X.trim_ends(c), F.trim(c, F.lit(X.SPACES))),
        "model": (
            X.model_name_key(c),
            F.trim(F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]+", " "))),
        ),
        "unfused": (X.unfused(c), c),
    }
    for name, (found, expected) in full.items():
        assert rows.filter(~found.eqNullSafe(expected)).collect() == [], name
