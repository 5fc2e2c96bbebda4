"""Tolerant casts, dates, bands and scores (F-3, F-8..F-10, F-17..F-22, F-25, F-32, P-10..P-12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldgap.functions.text import trim_spaces


#: What no text of a whole number holds, and what none of a decimal with an exponent or without holds.
NOT_WHOLE, NOT_DECIMAL = "[A-Za-z./]", "[A-DF-Za-df-z/]"


def tolerant_int(c: Column, to: str = "int") -> Column:
    """Integer from text; decimals and exponents round half up, anything else is NULL.

    Casts make and catch an exception for text that is no number, which costs more than the rest of
    a row. Text that certainly is none is therefore not cast; the casts still judge all other text.
    """
    plain = F.when(~c.rlike(NOT_WHOLE), c).try_cast(to)
    decimal = F.when(~c.rlike(NOT_DECIMAL), trim_spaces(c)).try_cast("decimal(38,10)")
    return F.coalesce(plain, F.round(decimal, 0).try_cast(to))


#: A number in digits, with an exponent or without; casts alone take '1d', 'NaN' and 'Infinity' too.
NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def tolerant_double(c: Column) -> Column:
    """Double from text or NULL, of any size and precision; what is beyond a double's range is NULL."""
    text = trim_spaces(c)
    value = F.when(text.rlike(NUMBER), text).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def number_or(c: Column, sentinel: float) -> Column:
    """Numeric coercion with a sentinel, so range checks fail instead of skipping nulls."""
    return F.coalesce(tolerant_double(c), F.lit(float(sentinel)))


def year_or(c: Column, sentinel: int) -> Column:
    """Whole-number coercion with a sentinel."""
    return F.coalesce(tolerant_int(c), F.lit(sentinel))


def compact_date(c: Column) -> Column:
    """Date from yyyymmdd text. Seven digits mean a one-digit day; invalid text is NULL."""
    digits = trim_spaces(c)
    padded = F.when(
        F.length(digits) == 7,
        F.concat(F.substring(digits, 1, 6), F.lit("0"), F.substring(digits, 7, 1)),
    ).otherwise(digits)
    parts = [F.substring(padded, at, n) for at, n in ((1, 4), (5, 2), (7, 2))]
    # The cast takes digits only, but also a last cell that ends in white space or a T.
    whole = (F.length(padded) == 8) & F.substring(padded, 8, 1).between("0", "9")
    return F.when(whole, F.concat_ws("-", *parts)).when(F.length(padded) == 10, padded).try_cast("date")


def iso_date(c: Column) -> Column:
    """Date from yyyy-mm-dd text, otherwise NULL."""
    return F.when(c.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), c).try_cast("date")


def month_of(c: Column) -> Column:
    return F.trunc(c, "month")


def months_before(c: Column, months: int) -> Column:
    """Calendar months back, clamped to the end of the month."""
    return F.add_months(c, -months)


def log1p_sum(terms: Mapping[str, float]) -> Column:
    """Sum of weight * ln(1 + count) over the named count columns."""
    total = None
    for name, weight in terms.items():
        term = F.lit(float(weight)) * F.log(F.lit(1) + F.col(name))
        total = term if total is None else total + term
    return total


def banded(c: Column, bands: Sequence[tuple[int | None, object]]) -> Column:
    """First band whose upper bound (inclusive) holds; a bound of None closes the list."""
    result = None
    for upper, value in bands:
        lit = F.lit(value)
        if upper is None:
            return lit if result is None else result.otherwise(lit)
        result = F.when(c <= upper, lit) if result is None else result.when(c <= upper, lit)
    return result


def all_of(predicates: Sequence[Column | None]) -> Column:
    """AND of the predicates that are present; true when there is none (P-7)."""
    out = F.lit(True)
    for predicate in predicates:
        if predicate is not None:
            out = out & predicate
    return out
