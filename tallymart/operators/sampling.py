"""Redirecting rows into a subset of a master table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import draw_below
from ..sources.tables import row_count
from .index import dense_index


def split_by(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Rows where ``flag`` is true and rows where it is false."""
    return df.filter(F.col(flag)), df.filter(~F.col(flag))


def subset_index(df: DataFrame, condition: Column, order_by: Sequence[str], name: str) -> DataFrame:
    """Dense index over only the rows that meet ``condition``."""
    return dense_index(df.filter(condition), order_by, name)


def resample_into(df: DataFrame, subset: DataFrame, draw_col: Column, column: str, rank: str) -> DataFrame:
    """Replace ``column`` in every row by the subset row its draw points at.

    ``subset`` holds ``rank`` (0..k-1) and ``column``. Its size enters as a scalar
    subquery, and draws spread evenly, so the join has no hot key.
    """
    return (
        df.drop(column)
        .withColumn(rank, draw_below(draw_col, row_count(subset)))
        .join(subset.select(rank, column), rank)
        .drop(rank)
    )
