"""Removal of repeated runs of lines, found by content-defined chunks. DataFrame functions only.

A line is what stands between line feeds. A rolling hash over the hashes of `WINDOW` lines ends a
chunk where it is divisible by `DIVISOR`, so inserted or deleted lines move no boundary beyond their
neighbours. A line of at least `LONG_WORDS` words (runs without white space) is as much as a chunk and stands alone, so that a
repeated passage is met whatever stands around it. Chunks of several lines with words, and long
lines, are grouped over the whole table by two hashes and then by their bytes; of equal chunks the
one in the document with the smallest id stays, there the first, and all others are removed.

The grouping combines on the map side, so a chunk that a third of all documents share is one row per
task. Different chunks of equal hashes are left alone. Decisions return on narrow rows; texts are
shuffled twice, for the comparison and for the rebuilding.

Defined cases: a null text stays null; a text whose lines all go becomes empty; rows of one id count
as one document; rows without an id come last; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgap.llm.common import ordered_id, text_key

WINDOW = 2
DIVISOR = 3
LONG_WORDS = 50

#: What stands before a line while chunks are texts: whether it begins a chunk, whether it is blank,
#: holds words, or is long. A line holds no line feed, so a chunk is the text up to the next "\nb".
BEGINS, GOES_ON = "b", "c"
BLANK, WORDS, LONG = "0", "1", "2"
SPACE = " \t\r\x0b\f"


def line_hash(line: Column) -> Column:
    """The first 32 bits of the MD5: the same number in any engine."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def size_mark(line: Column, long_words: int) -> Column:
    """Words are runs without white space; the pattern stops at the last word asked for and never goes back."""
    enough = f"^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]++){{{long_words - 1}}}[^{SPACE}]"
    long_line = (F.octet_length(line) >= 2 * long_words - 1) & line.rlike(enough)
    return F.when(long_line, LONG).when(F.trim(line, F.lit(SPACE)) != "", WORDS).otherwise(BLANK)


def with_chunks(df: DataFrame, body: Column, long_words: int = LONG_WORDS) -> DataFrame:
    """Add `chunks`: the chunks of a text in order, each with marks before its lines.

    Neighbouring lines are seen by zipping the lines with themselves, shifted, so the work is linear.
    """
    none = F.lit(None).cast("struct<h:bigint,m:string>")

    def mark(x: Column) -> Column:
        own, one, two = x["own"], x["one"], x["two"]
        rolled = one["h"] + F.coalesce(31 * two["h"], F.lit(0))
        begins = one["h"].isNull() | (rolled % DIVISOR == 0) | (one["m"] == LONG) | (own["m"] == LONG)
        return F.when(own.isNotNull(), F.concat(F.when(begins, BEGINS).otherwise(GOES_ON), own["m"]))

    signs = F.transform(
        "lines", lambda x: F.struct(line_hash(x).alias("h"), size_mark(x, long_words).alias("m"))
    )
    zipped = F.arrays_zip(
        F.col("signs").alias("own"),
        F.concat(F.array(none), "signs").alias("one"),
        F.concat(F.array(none, none), "signs").alias("two"),
    )
    marks = F.slice(F.transform(zipped, mark), 1, F.size("signs"))
    marked = F.zip_with("marks", "lines", lambda m, x: F.concat(m, x))
    return (
        df.withColumn("lines", F.split(body, "\n"))
        .withColumn("signs", signs)
        .withColumn("marks", marks)
        .withColumn("chunks", F.split(F.array_join(marked, "\n"), f"\n(?={BEGINS})"))
        .drop("lines", "signs", "marks")
    )


def whole(chunk: Column) -> Column:
    """Several lines with words, or a long one."""
    more = f"\n{GOES_ON}{WORDS}"
    several = chunk.contains(more) & (chunk.startswith(BEGINS + WORDS) | (F.size(F.split(chunk, more, 3)) > 2))
    return chunk.startswith(BEGINS + LONG) | several


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", long_words: int = LONG_WORDS
) -> DataFrame:
    """The rows with a struct `row` of their columns, the remaining `text`, and what went.

    Returns (row, text, n_lines, n_removed): lines before, lines removed.
    """
    keyed = docs.select(
        F.struct("*").alias("row"),
        ordered_id(id_column).alias("rid"),
        text_key(text_column).alias("tid"),
    )
    body = F.col("row").getField(text_column)
    # The outer form, since the optimizer would work out `chunks` again to test that it is not empty.
    chunks = (
        with_chunks(keyed, body, long_words)
        .select("rid", "tid", F.posexplode_outer("chunks").alias("k", "bytes"))
        .where(whole(F.col("bytes")))
        .select("rid", "tid", "k", F.xxhash64("bytes").alias("h1"), F.xxhash64(F.lit(1), "bytes").alias("h2"), "bytes")
    )
    same_bytes = chunks.groupBy("h1", "h2", "bytes").agg(F.count("*").alias("copies"), F.min("rid").alias("keeper"))
    repeated = (
        same_bytes.groupBy("h1", "h2")
        .agg(F.count("*").alias("kinds"), F.max("copies").alias("copies"), F.min("keeper").alias("keeper"))
        .where("kinds = 1 and copies > 1")
        .select("h1", "h2", "keeper")
    )
    found = chunks.select("rid", "tid", "k", "h1", "h2").join(repeated, ["h1", "h2"])
    # In the keeper's own document the first of equal chunks stays.
    own = F.col("keeper") == F.col("rid")
    per_text = found.groupBy("rid", "tid", "h1", "h2", own.alias("own")).agg(F.sort_array(F.collect_set("k")).alias("at"))
    per_text = per_text.select("rid", "tid", F.when(F.col("own"), F.slice("at", 2, F.size("at"))).otherwise(F.col("at")).alias("at"))
    removed = (
        per_text.where("size(at) > 0").groupBy("rid", "tid").agg(F.flatten(F.collect_list("at")).alias("gone"))
    )
    left = with_chunks(keyed.join(removed, ["rid", "tid"], "left"), body, long_words)
    gone = F.map_from_arrays("gone", F.transform("gone", lambda k: F.lit(True)))
    left = left.withColumn("gone_map", gone)
    stays = F.array_join(F.filter("chunks", lambda c, k: ~F.coalesce(F.element_at("gone_map", k), F.lit(False))), "\n")
    left = left.withColumn("stays", F.when(F.col("gone").isNotNull(), stays))
    lines = F.when(body.isNull(), F.lit(0)).otherwise(F.size(F.split(body, "\n")))
    still = F.when(F.col("stays") == "", F.lit(0)).otherwise(F.size(F.split("stays", "\n")))
    return left.select(
        "row",
        F.coalesce(F.regexp_replace("stays", f"(^|\n)[{BEGINS}{GOES_ON}][{BLANK}{WORDS}{LONG}]", "$1"), body).alias("text"),
        lines.alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(lines - still).alias("n_removed"),
    )
