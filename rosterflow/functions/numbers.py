"""Number functions on text columns; bad text is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number spellings that the JVM reads and the data model does not: 5d, 2f, 0x1p3.
_JVM_ONLY = r"(?i)[0-9.][df]\s*$|x"


def to_long(c: Column) -> Column:
    """Whole-number text as bigint; ``12.0`` is null."""
    return c.try_cast("bigint")


def to_double(c: Column) -> Column:
    """Text as double."""
    return F.when(~c.rlike(_JVM_ONLY), c.try_cast("double"))


def truncated_long(c: Column) -> Column:
    """Text as a number cut toward zero; NaN and infinity are null."""
    return to_double(c).try_cast("bigint")


def nan_as_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
