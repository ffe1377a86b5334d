"""The whole chain as one function: schemas, synthetic bronze tables, gold tables."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import ensure_schema, inside, write_table
from .generate import generate_facts, generate_masters
from .gold import refresh_gold


def build(
    spark: SparkSession, bronze_where: str, gold_where: str, seed: int, window_start: date, **sizes: int
) -> dict[str, DataFrame]:
    """Write bronze and gold tables into two schemas or folders; returns scans of the gold tables.

    ``sizes``: ``n_guests``, ``n_products``, ``n_stores``, ``n_lines``, ``n_promo``, ``n_baskets``.
    Masters are stored first and read back, so the facts do not make them again.
    """
    ensure_schema(spark, bronze_where)
    ensure_schema(spark, gold_where)
    of_masters = {k: sizes.pop(k) for k in ("n_guests", "n_products", "n_stores") if k in sizes}

    def store(frames):
        return {name: write_table(df, inside(bronze_where, name)) for name, df in frames.items()}

    bronze = store(generate_masters(spark, seed, window_start, **of_masters))
    bronze |= store(generate_facts(spark, bronze, seed, window_start, **sizes))
    return refresh_gold(bronze, gold_where)
