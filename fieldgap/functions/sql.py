"""The text rules as temporary SQL functions, so that ad-hoc SQL (F-16) uses the models' own keys and flags."""

from __future__ import annotations

from pyspark.sql import SparkSession

from fieldgap.functions.text import SPACES, WHITESPACE_RUN


def _quoted(text: str) -> str:
    """A string literal; every character by its code, so that nothing is read as an escape."""
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


_TRIMMED = f"trim(BOTH {_quoted(SPACES)} FROM {{}})"
#: Name, parameter, result type and body.
FUNCTIONS = [
    ("model_name_key", "STRING", f"trim(upper(regexp_replace(coalesce(value, ''), {_quoted('[^A-Za-z0-9]+')}, ' ')))"),
    ("make_name_key", "STRING", _TRIMMED.format(f"regexp_replace(upper(coalesce(value, '')), {_quoted(WHITESPACE_RUN)}, ' ')")),
    ("blank_to_null", "STRING", f"nullif({_TRIMMED.format('value')}, '')"),
    ("yes_flag", "BOOLEAN", "upper(coalesce(value, 'N')) IN ('Y', 'YES')"),
    ("path_key", "STRING", f"md5(upper({_TRIMMED.format('value')}))"),
]


def register(spark: SparkSession) -> list[str]:
    """Define the functions for the session, replacing earlier ones; returns their names."""
    for name, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS {kind} RETURN {body}")
    return [name for name, _, _ in FUNCTIONS]
