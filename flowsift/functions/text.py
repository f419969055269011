"""Text and label expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowsift.spec import ATTACK, BENIGN, DEFAULT_SPEC, OTHER, FlowSpec

# Characters that count as white space at either end of a text. Spark's plain trim
# only takes spaces away.
SPACES = "".join(
    [chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680)]
    + [chr(c) for c in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)

# Texts that stand for a missing value in CSV files (fixed values, pandas docs).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]


def strip(c: Column) -> Column:
    """Remove white space at both ends, all Unicode spaces included."""
    return F.btrim(c, F.lit(SPACES))


def na_to_null(c: Column) -> Column:
    """NULL for texts that stand for a missing value."""
    return F.when(~c.isin(NA_TOKENS), c)


def binary_label(c: Column) -> Column:
    """BENIGN for missing, blank and benign-like labels, ATTACK for all others."""
    benign = c.isNull() | (strip(c) == "") | F.lower(c).contains("benign")
    return F.when(benign, BENIGN).otherwise(ATTACK)


def category_label(c: Column, spec: FlowSpec = DEFAULT_SPEC) -> Column:
    """Attack category; missing is BENIGN, unknown or blank text is Other."""
    pairs = chain.from_iterable(spec.categories.items())
    table = F.create_map(*[F.lit(x) for x in pairs])
    return F.when(c.isNull(), BENIGN).otherwise(
        F.coalesce(F.try_element_at(table, F.lower(strip(c))), F.lit(OTHER))
    )


def encode_label(c: Column) -> Column:
    """BENIGN 0, ATTACK 1, anything else NULL."""
    return F.when(c == BENIGN, 0).when(c == ATTACK, 1)


def decode_label(c: Column) -> Column:
    return F.when(c == 0, BENIGN).when(c == 1, ATTACK)
