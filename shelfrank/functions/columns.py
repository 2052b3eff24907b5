"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: path of the cover shown when a book has none.
PLACEHOLDER_COVER = "static/image404.png"

INT_MAX = 2147483647


def or_default(column: str | Column, default: str | Column) -> Column:
    """Value, or the default where it is null or an empty string."""
    value = F.col(column) if isinstance(column, str) else column
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def cover_or_placeholder(column: str | Column, url_root: str) -> Column:
    """Cover URL, or the placeholder below `url_root`."""
    return or_default(column, F.concat(F.lit(url_root), F.lit(PLACEHOLDER_COVER)))


def mean_2dp(column: str | Column) -> Column:
    """Mean rounded half-up to two decimals; 0.0 over no rows.

    The cast to decimal makes the rounding act on the decimal value instead of
    its binary neighbour, so any SQL engine gives the same digits.
    """
    rounded = F.round(F.avg(column).cast("decimal(20,10)"), 2).cast("double")
    return F.coalesce(rounded, F.lit(0.0))


def index_from_text(column: str | Column) -> Column:
    """Book index typed as '12' or '12.0'; null unless a whole number in int range."""
    value = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    usable = value.between(0, INT_MAX) & (value == F.floor(value))
    return F.when(usable, value).cast("int")


def rating_from_text(column: str | Column, low: int = 1, high: int = 5) -> Column:
    """Rating typed as text; null unless a whole number from `low` to `high`."""
    value = (F.col(column) if isinstance(column, str) else column).try_cast("int")
    return F.when(value.between(low, high), value).cast("double")


def hash_percent(*columns: str) -> Column:
    """Stable number from 0 to 99 for a key, whatever the partitioning."""
    digest = F.md5(F.concat_ws("|", *columns))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % 100
