"""Text expressions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ellipsis(text: Column, n: int) -> Column:
    """The first ``n`` code points, with dots if there are more."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def numbered(n: Column, line: Column) -> Column:
    """A line with its number, four wide."""
    return F.format_string("%4d | %s", n, line)


#: White space as Python strips it.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is worked out once a row, however often ``fn`` uses it and in whatever loop."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))
