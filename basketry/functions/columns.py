"""Column expressions shared by the layers. All stay inside Spark's code generation."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType

def lenient_int(text: Column) -> Column:
    """Text to int, NULL where it is no number, fraction cut off ('3.7' is 3, '.5' is 0).

    ``try_cast`` to int would reject '3.7', and each rejected value costs a thrown
    exception. A double holds every int exactly, so the value goes through one.
    Text with letters is left out first: a double may be written '1e2' or 'NaN', an
    int may not. Comparing the two cases finds letters faster than a pattern does.
    """
    wordless = (F.lower(text) == F.upper(text)) & (text != "")
    return F.when(wordless, text.try_cast("double").try_cast("int"))


def lenient_double(text: Column) -> Column:
    """Text to double, NULL where it is no number. Plain words never reach the cast."""
    return F.when(text.rlike("(?i)[0-9]|nan|inf"), text.try_cast("double"))


def lenient_cast(text: Column, to: DataType) -> Column:
    if isinstance(to, IntegerType):
        return lenient_int(text)
    if isinstance(to, DoubleType):
        return lenient_double(text)
    return text


def all_present(columns: Iterable[str]) -> Column:
    """No column is NULL. Written out, not as ``dropna``, so that it reaches the file scan."""
    return reduce(operator.and_, (F.col(c).isNotNull() for c in columns))


def ratio4(part: Column, whole: Column) -> Column:
    """part / whole, rounded half up to four places, NULL when whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 4)


def processed_at(moment: datetime | None) -> Column:
    """The batch time given by the caller, else the time the query starts."""
    return F.current_timestamp() if moment is None else F.lit(moment)
