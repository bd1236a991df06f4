"""Lenient reads of JSON fields.

An absent field gives NULL. A field that is present but holds no usable number
(JSON null, plain text, an object) gives 0. Numeric text counts as its number,
``true`` as 1, and a fraction is cut off when an integer is wanted.

Each read asks the variant once in the usual case; the further look-ups run only
when the first gave NULL. Parse a record into a column first and read from that column,
so that several reads share one parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Within the range of a long, and beyond every event time a timestamp can hold: a larger
# number becomes this one, which is refused as a time like the number itself.
_LONG_EDGE = 9.2e18


def parse_json(text: Column) -> Column:
    """JSON text to a variant; NULL when it is not JSON."""
    return F.try_parse_json(text)


def is_present(document: Column, path: str) -> Column:
    """True for a field that exists, also when it holds JSON null."""
    return F.try_variant_get(document, path, "variant").isNotNull()


def lenient_double(document: Column, path: str) -> Column:
    return F.coalesce(
        F.try_variant_get(document, path, "double"),
        F.when(is_present(document, path), F.lit(0.0)),
    )


def lenient_long(document: Column, path: str) -> Column:
    fraction = F.nanvl(F.try_variant_get(document, path, "double"), F.lit(0.0))
    within = F.greatest(F.least(fraction, F.lit(_LONG_EDGE)), F.lit(-_LONG_EDGE))
    return F.coalesce(
        F.try_variant_get(document, path, "bigint"),
        F.when(fraction.isNotNull(), within.cast("bigint")),
        F.when(is_present(document, path), F.lit(0).cast("bigint")),
    )


def lenient_text(document: Column, path: str) -> Column:
    return F.coalesce(
        F.try_variant_get(document, path, "string"),
        F.when(is_present(document, path), F.lit("null")),
    )
