"""Tolerant parsing of raw text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BLANKS = " \t\n\r\f\v"


def strip(text: Column) -> Column:
    """Without surrounding white space of any kind, not only blanks."""
    return F.trim(text, F.lit(_BLANKS))


def clean_code(text: Column) -> Column:
    return F.upper(strip(text))


def to_int(text: Column) -> Column:
    """Whole numbers only: '1.0' and 'x' give null, ' 7 ' gives 7."""
    return text.try_cast("int")


def to_double(text: Column) -> Column:
    """Decimal notation, exponents, nan and inf; anything else gives null.

    The JVM also reads a number with a type letter ('5d', '5f') and hexadecimal
    fractions, which the pattern shuts out.
    """
    jvm_only = F.regexp_like(text, F.lit(r"[0-9.]\s*[dDfF]\s*$|[xX]"))
    return F.when(~jvm_only, text.try_cast("double"))


def city_proxy(dest: Column) -> Column:
    return F.substring(dest, 1, 3)


def rule_list(text: Column) -> Column:
    """Comma list to array, blanks removed and each code once."""
    return F.array_distinct(F.split(F.replace(text, F.lit(" "), F.lit("")), ","))


def rule_text(rules: Column) -> Column:
    return F.array_join(rules, ",")


def json_text() -> Column:
    """All columns of a row as one JSON text."""
    return F.to_json(F.struct("*"))


def from_json_text(text: Column, schema: StructType) -> Column:
    """A struct of ``schema``; its fields are null where the text does not hold them."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})
