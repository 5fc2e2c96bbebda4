"""Name conformance against a reference list (INT-1, J-2..J-5, W-2, U-1, U-2, MART-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgap.functions.aggregates import ratio
from fieldgap.functions.text import java_replacement, word_prefixes
from fieldgap.operators.dedup import best_candidate


UNMATCHED = 4


def distinct_names(frames: Sequence[DataFrame], cols: Sequence[str], keep: Column) -> DataFrame:
    """Distinct union of the named columns over several frames."""
    out = None
    for frame in frames:
        part = frame.filter(keep).select(*cols)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def conform_names(
    observed: DataFrame,
    reference: DataFrame,
    rules: DataFrame | None = None,
    scope: Sequence[str] = ("make", "model_year"),
    name: str = "model_norm",
    rule_scope: str = "make",
    source_name: str = "source_model_norm",
) -> DataFrame:
    """Resolve each observed name to a reference name within the same scope.

    Order of preference: the name itself (exact), a rewrite rule (rule), the longest
    whole-word prefix (prefix), else the observed name stays (unmatched).

    Works on the distinct name universe, never on the fact rows. Every candidate is an
    equality key: names expand to their word prefixes (as many rows as words), so the
    prefix match is a hash join rather than a residual condition over all pairs of a make.
    """
    keys = [*scope, name]
    names = observed.select(*keys).distinct()
    listed = reference.select(
        *[F.col(k).alias(f"_k_{k}") for k in scope], F.col(name).alias("_k_name")
    ).distinct()

    def ranked(value: Column, priority: int) -> Column:
        return F.struct(value.alias("candidate"), F.lit(priority).alias("priority"))

    options = [
        F.array(ranked(F.col(name), 1)),
        F.transform(word_prefixes(F.col(name)), lambda p: ranked(p, 3)),
        F.array(ranked(F.col(name), UNMATCHED)),
    ]
    if rules is not None:
        # A handful of rules per make, carried along as a list: the names stay one scan.
        rule = F.struct("pattern", java_replacement(F.col("replacement")).alias("replacement"))
        per_make = rules.groupBy(rule_scope).agg(F.collect_list(rule).alias("_rules"))
        names = names.join(per_make, rule_scope, "left")
        fitting = F.filter(
            F.coalesce("_rules", F.array().cast("array<struct<pattern:string,replacement:string>>")),
            lambda r: F.rlike(F.col(name), r["pattern"]),
        )
        options.append(
            F.transform(
                fitting,
                lambda r: ranked(F.regexp_replace(F.col(name), r["pattern"], r["replacement"]), 2),
            )
        )
    candidates = names.select(*keys, F.inline(F.concat(*options)))
    found = candidates.join(
        listed.withColumn("_listed", F.lit(True)),
        [F.col(k) == F.col(f"_k_{k}") for k in scope] + [F.col("candidate") == F.col("_k_name")],
        "left",
    )
    resolved = found.filter(F.col("_listed").isNotNull() | (F.col("priority") == UNMATCHED))
    best = best_candidate(
        resolved,
        keys,
        ["candidate", "priority"],
        [F.col("priority"), -F.length("candidate"), F.col("candidate")],
    )
    method = F.element_at(
        F.array(*[F.lit(m) for m in ("exact", "rule", "prefix", "unmatched")]), F.col("priority")
    )
    return best.select(
        scope[0],
        F.col(name).alias(source_name),
        *scope[1:],
        F.col("candidate").alias(name),
        method.alias("match_method"),
    )


def attach_conformed(
    facts: DataFrame,
    conformance: DataFrame,
    scope: Sequence[str] = ("make", "model_year"),
    name: str = "model_norm",
    source_name: str = "source_model_norm",
    how: str = "inner",
) -> DataFrame:
    """Replace the observed name of each fact by its conformed one (J-6).

    An inner join drops rows that cannot be resolved; a left join keeps them with a NULL
    method. Spark broadcasts the conformance table while its measured size allows it and
    splits hot vehicles of the fact side otherwise.
    """
    lookup = conformance.select(
        *[F.col(s).alias(f"_c_{s}") for s in scope],
        F.col(source_name).alias("_c_source"),
        F.col(name).alias("_c_name"),
        "match_method",
    )
    on = [F.col(s) == F.col(f"_c_{s}") for s in scope] + [F.col(name) == F.col("_c_source")]
    joined = facts.join(lookup, on, how)
    return joined.withColumn(name, F.col("_c_name")).drop(
        "_c_source", "_c_name", *[f"_c_{s}" for s in scope]
    )


def conformance_rates(
    classified: DataFrame, source: str = "source", weight: str | None = None
) -> DataFrame:
    """Counts and match rates per source.

    Expects in_scope, resolvable, in_reference_years (booleans) and match_method. Each input
    row stands for `weight` rows when given. NULL methods count neither as matched nor as
    unmatched.
    """
    rows = F.lit(1) if weight is None else F.col(weight)

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, rows).otherwise(0)).cast("bigint")

    inside = F.col("in_reference_years")
    method = F.col("match_method")
    out = classified.groupBy(source).agg(
        F.sum(rows).cast("bigint").alias("rows_total"),
        counted(F.col("in_scope")).alias("rows_in_scope"),
        counted(F.col("resolvable")).alias("rows_resolvable"),
        counted(F.col("resolvable") & inside).alias("rows_in_reference_years"),
        counted(inside & (method == "exact")).alias("matched_exact"),
        counted(inside & (method == "rule")).alias("matched_rule"),
        counted(inside & (method == "prefix")).alias("matched_prefix"),
        counted(inside & (method != "unmatched")).alias("_matched"),
    )
    den = F.col("rows_in_reference_years")
    return out.select(
        *[c for c in out.columns if c != "_matched"],
        ratio(F.col("matched_exact"), den).alias("exact_match_rate"),
        ratio(F.col("_matched"), den).alias("vpic_match_rate"),
    )
