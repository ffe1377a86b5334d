"""Data dictionary: column profiles, gap filling and value lookup.

Metadata is one row per column or measure (table, column, type, position,
comment) and joins to profiles that are computed from the data.
"""

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import is_blank
from . import marks

COLUMN_META = "table_name string, column_name string, data_type string, position int, comment string"
TABLE_META = "table_name string, table_comment string"


# -- profile ----------------------------------------------------------------

def profile_columns(
    df: DataFrame, table: str, columns: Sequence[str] | None = None, distinct: str | None = "sketch", extremes: bool = True,
    alike: DataFrame | None = None,
) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, least and greatest value as text.

    ``columns`` limits the work to those columns. ``distinct`` is ``sketch`` (an
    estimate, taken in the same single pass), ``exact`` or None (leave it out). For
    exact counts hashes of the (column, value) pairs are shuffled, and of the pairs those whose hash repeats, deduplicated
    map-side; no task holds all values of a column. ``df`` is read twice more, or in its
    place ``alike``, a frame of the same rows whose values are equal exactly where those of ``df`` are, such as the texts of hashed keys. Without ``extremes`` the least and greatest values are
    left out, and a column that is never NULL need not be worked out.
    """
    columns = list(columns or df.columns)
    sketch = distinct == "sketch"
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_n_{i}") for i, c in enumerate(columns)],
        *([F.min(c).cast("string").alias(f"_lo_{i}") for i, c in enumerate(columns)] if extremes else []),
        *([F.max(c).cast("string").alias(f"_hi_{i}") for i, c in enumerate(columns)] if extremes else []),
        *([F.approx_count_distinct(c).alias(f"_d_{i}") for i, c in enumerate(columns)] if sketch else []),
    )
    lines = stats.select(F.inline(F.array(*[
        F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
            F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_n_{i}")).alias("null_count"),
            *([F.col(f"_d_{i}").alias("distinct_count")] if sketch else []),
            *([F.col(f"_lo_{i}").alias("min_value"), F.col(f"_hi_{i}").alias("max_value")] if extremes else []),
        )
        for i, c in enumerate(columns)
    ])))
    if distinct != "exact":
        return lines
    cells, pair = long_values(df if alike is None else alike, columns).filter(F.col("value").isNotNull()), ["column_name", "value"]
    cells = marks.marked(cells, pair, marks.repeated(cells, pair), "_again")
    folded = cells.groupBy("column_name", "_again", F.when(F.col("_again"), F.col("value")).alias("value")).agg(
        F.count(F.lit(1)).alias("_n"))
    counts = folded.groupBy("column_name").agg(
        F.sum(F.when(F.col("_again"), F.lit(1)).otherwise(F.col("_n"))).alias("distinct_count"))
    return lines.join(counts, "column_name", "left").select(
        "table_name", "column_name", "row_count", "null_count",
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"), *(["min_value", "max_value"] if extremes else []),
    )


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value as text), one row per cell."""
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return texts.unpivot([], [F.col(f"`{c}`") for c in columns], "column_name", "value")


def profile_tables(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None,
    distinct: str | None = "sketch", extremes: bool = True, alike: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Profiles of several tables; ``columns`` picks tables and columns, default all."""
    return reduce(DataFrame.unionByName, [
        profile_columns(tables[t], t, columns[t] if columns else None, distinct, extremes, alike[t] if alike else None)
        for t in columns or tables
    ])


def uncommented(schemas: Mapping[str, T.StructType]) -> dict[str, list[str]]:
    """Declared columns without a comment: the only ones a draft needs a profile of."""
    gaps = {
        t: [f.name for f in s.fields if not ((f.metadata or {}).get("comment") or "").strip()]
        for t, s in schemas.items()
    }
    return {t: names for t, names in gaps.items() if names}


def schemas_of(tables: Mapping[str, DataFrame]) -> dict[str, T.StructType]:
    """Schemas as the tables have them now, so a column added later is seen like any other."""
    return {name: tables[name].schema for name in tables}


def uncommented_tables(comments: Mapping[str, str | None]) -> list[str]:
    """Names of tables whose comment is missing or blank."""
    return [t for t, c in comments.items() if not (c or "").strip()]


# -- metadata ---------------------------------------------------------------

def describe_columns(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """Metadata rows of declared columns."""
    rows = [
        (table, f.name, f.dataType.simpleString(), i, (f.metadata or {}).get("comment"))
        for table, schema in schemas.items() for i, f in enumerate(schema.fields, 1)
    ]
    return spark.createDataFrame(rows, COLUMN_META)


def describe_metrics(spark: SparkSession, views) -> DataFrame:
    """Metadata rows of metric views: dimensions, then measures."""
    rows = []
    for view in views:
        items = [(d.name, "dimension", d.comment) for d in view.dimensions]
        items += [(m.name, "measure", m.comment) for m in view.measures]
        rows += [(view.name, name, kind, i, comment or None) for i, (name, kind, comment) in enumerate(items, 1)]
    return spark.createDataFrame(rows, COLUMN_META)


def describe_tables(spark: SparkSession, comments: Mapping[str, str | None]) -> DataFrame:
    return spark.createDataFrame(list(comments.items()), TABLE_META)


# -- gaps -------------------------------------------------------------------

def find_gaps(meta: DataFrame, comment: str = "comment") -> DataFrame:
    """Metadata rows whose comment is NULL, empty or blank."""
    return meta.filter(is_blank(comment))


def column_lists(meta: DataFrame) -> DataFrame:
    """Per table, its column names in order, joined with commas. A list is as long as the table is wide."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "column_name")))
    return meta.groupBy("table_name").agg(
        F.array_join(F.transform(ordered, lambda c: c["column_name"]), ", ").alias("columns")
    )


def table_prompt(table="table_name", columns="columns") -> Column:
    return F.format_string(
        "Say in one sentence what the retail table '%s' is for. Its columns are: %s.", table, columns)


def column_prompt(table="table_name", column="column_name", kind="data_type") -> Column:
    return F.format_string(
        "Say in one short sentence what column '%s' (%s) of the retail table '%s' means.", column, kind, table)


def plain_draft(_prompt: Column) -> Column:
    """Draft made from the profile alone, for frames that carry profile columns."""
    return F.format_string(
        "%s of %s: %d distinct values from %s to %s.",
        F.replace("column_name", F.lit("_"), F.lit(" ")), F.col("table_name"), F.col("distinct_count"),
        F.coalesce("min_value", F.lit("-")), F.coalesce("max_value", F.lit("-")),
    )


def plain_table_draft(_prompt: Column) -> Column:
    """Draft made from a table's columns and rows alone."""
    return F.format_string("%s: %d rows with %s.", F.col("table_name"), F.col("row_count"), F.col("columns"))


def draft(meta: DataFrame, fn: Callable[[Column], Column] = plain_draft) -> DataFrame:
    """Add ``draft`` = trimmed ``fn(prompt)``. ``fn`` may wrap a pandas UDF of the caller."""
    return meta.withColumn("draft", F.trim(fn(F.col("prompt"))))


def fill(meta: DataFrame, drafts: DataFrame, keys: Sequence[str] = ("table_name", "column_name")) -> DataFrame:
    """Comments with gaps filled from ``drafts``; a written comment is never replaced."""
    new = drafts.select(*keys, "draft")
    return meta.join(new, list(keys), "left").withColumn(
        "comment", F.when(is_blank("comment"), F.col("draft")).otherwise(F.col("comment"))
    ).drop("draft")


# -- value lookup -----------------------------------------------------------

def entity_values(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct values of the lookup columns with their number of rows."""
    cells = reduce(DataFrame.unionByName, [
        long_values(tables[t], cols).select(F.lit(t).alias("table_name"), "column_name", "value")
        for t, cols in columns.items()
    ])
    return cells.filter(F.col("value").isNotNull()).groupBy("table_name", "column_name", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )


def entity_match(terms: DataFrame, values: DataFrame, term: str = "term") -> DataFrame:
    """Terms with the table, column and stored value they name, ignoring case and outer spaces.

    Terms are deduplicated first, so a term asked very often costs one row.
    """
    asked = terms.select(term).distinct().withColumn("_norm", F.lower(F.trim(term)))
    known = values.withColumn("_norm", F.lower(F.trim("value")))
    return asked.join(known, "_norm").select(term, "table_name", "column_name", "value")


def quoted(text) -> Column:
    """Text as a SQL string literal: inner quotes doubled."""
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))


def table_statements(drafts: DataFrame) -> DataFrame:
    """The statement that stores each table draft as a comment."""
    return drafts.select("table_name", F.concat(
        F.lit("COMMENT ON TABLE "), F.col("table_name"), F.lit(" IS "), quoted(F.col("draft"))).alias("statement"))


def comment_statements(drafts: DataFrame) -> DataFrame:
    """The statement that stores each column draft as a comment, for the owner of the tables to run."""
    return drafts.select("table_name", "column_name", F.concat(
        F.lit("ALTER TABLE "), F.col("table_name"), F.lit(" ALTER COLUMN "), F.col("column_name"),
        F.lit(" COMMENT "), quoted(F.col("draft")),
    ).alias("statement"))
