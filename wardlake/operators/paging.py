"""Pages of ordered rows.

``page_rows`` is a plain top-k: it carries offset + limit rows per task into one, which suits the
first pages of any frame. For pages of any depth keep the table sorted with its directory, see
operators/ordinals.py, or go on from the last row seen with ``rows_after``.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.operators.ordinals import Ordinals, page_of

MAX_LIMIT = 500


class Page(NamedTuple):
    total: int
    limit: int
    offset: int
    items: DataFrame


def check_bounds(limit: int, offset: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}, got {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, got {offset}")


def page_rows(df: DataFrame, order: list[str], limit: int = 50, offset: int = 0) -> DataFrame:
    """Rows [offset, offset + limit) in ascending order of columns that identify a row."""
    check_bounds(limit, offset)
    return df.orderBy(*order).offset(offset).limit(limit)


def page(df: DataFrame, order: list[str], limit: int = 50, offset: int = 0) -> Page:
    """The rows together with the grand total."""
    rows = page_rows(df, order, limit, offset)
    return Page(total=df.count(), limit=limit, offset=offset, items=rows)


def sorted_page(df: DataFrame, tables: list[Ordinals], order: list[str], limit: int = 50, offset: int = 0) -> Page:
    """A page of any depth of sorted tables with columns like ``df``; total and place come from their directories."""
    check_bounds(limit, offset)
    rows = page_of(df.sparkSession, tables, df.schema, order, limit, offset)
    return Page(sum(t.total for t in tables), limit, offset, rows)


def _from(df: DataFrame, column: str, value) -> Column:
    """Leading keys from a value on; nulls come first, so from null on these are all."""
    return F.lit(True) if value is None else F.col(column) >= F.lit(value).cast(df.schema[column].dataType)


def rows_after(df: DataFrame, order: list[str], after: list, limit: int = 50) -> DataFrame:
    """The page that follows the row with the given key: no offset to count through."""
    check_bounds(limit, 0)
    given = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, after)])
    # the leading column alone reaches the scan, where row groups are skipped
    return df.filter(_from(df, order[0], after[0])).filter(F.struct(*order) > given).orderBy(*order).limit(limit)
