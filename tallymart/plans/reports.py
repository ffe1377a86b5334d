"""The declared rules, keys, joins and comments of the model, checked or filled over all tables."""

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import lookup
from ..operators import glossary, quality
from ..schemas import PRIMARY_KEYS, RELATIONSHIPS
from .definitions import VIEWS
from .gold import RULES, SOURCE_OF, typed_source
from .metrics import MetricView

Tables = Mapping[str, DataFrame]


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rules(bronze: Tables) -> DataFrame:
    """Passed and failed rows of every row rule; one pass per table."""
    return union_all(
        quality.rule_report(typed_source(table, bronze[source]), RULES[table]).withColumn("table_name", F.lit(table))
        for table, source in SOURCE_OF.items()
    )


def primary_keys(gold: Tables) -> DataFrame:
    """NULL, repeated and surplus keys per declared primary key."""
    return union_all(
        quality.audit_primary_key(gold[table], key).withColumn("table_name", F.lit(table))
        for table, key in PRIMARY_KEYS.items()
    )


def model_summary(gold: Tables) -> DataFrame:
    """One row per declared relationship: which tables are joined on what, and how well the two ends meet.

    Each child is read once for all its keys. A child without rows still has its lines, with zeros.
    """
    children = {}
    for r in RELATIONSHIPS:
        children.setdefault(r.child, {})[r.key] = r.parent
    frames = []
    for child, keys in children.items():
        parent_of = lookup(keys)
        found = quality.summarise_keys(gold[child], {k: gold[p] for k, p in keys.items()})
        frames.append(found.select(
            F.lit(child).alias("child"), parent_of[F.col("key_name")].alias("parent"),
            F.col("key_name").alias("join_key"), *found.columns[1:]))
    return union_all(frames)


def foreign_keys(gold: Tables) -> DataFrame:
    """Orphan keys and rows per declared relationship."""
    return model_summary(gold).select("child", "parent", "orphan_keys", "orphan_rows")


def cardinality(gold: Tables, more: tuple[tuple[str, str, str], ...] = ()) -> DataFrame:
    """Most rows per key on the parent side of every declared join, and of ``more`` (child, parent, key).

    Each parent key is counted once, however many tables point at it.
    """
    children: dict[tuple[str, str], list[str]] = {}
    for child, parent, key in [(r.child, r.parent, r.key) for r in RELATIONSHIPS] + list(more):
        children.setdefault((parent, key), []).append(child)
    return union_all(
        quality.audit_many_to_one(gold[parent], key).select(
            F.explode(F.array(*[F.lit(c) for c in pointing])).alias("child"), F.lit(parent).alias("parent"),
            F.lit(key).alias("join_key"), "max_rows_per_key", "is_many_to_one")
        for (parent, key), pointing in children.items()
    )


UNIQUE = ("dim_guest", "dim_product", "dim_store")  # tables whose key must not repeat, as facts are joined to them


def release_audits(gold: Tables, unique: Sequence[str] = UNIQUE) -> DataFrame:
    """(table_name, check_name, failing, must_hold): the declared keys and joins of a set of gold tables.

    Keys must be there, and those of ``unique`` tables must not repeat. Repeated keys of other tables and orphans are
    findings only, as the raw data has both.
    """
    keys = primary_keys(gold)
    once = F.col("table_name").isin(list(unique))
    found = keys.select("table_name", F.inline(F.array(
        F.struct(F.lit("null_keys").alias("check_name"), F.col("null_keys").alias("failing"), F.lit(True).alias("must_hold")),
        F.struct(F.lit("repeated_keys").alias("check_name"), F.col("repeated_keys").alias("failing"), once.alias("must_hold")))))
    orphans = foreign_keys(gold).select(
        F.col("child").alias("table_name"), F.concat(F.lit("orphans of "), F.col("parent")).alias("check_name"),
        F.col("orphan_rows").alias("failing"), F.lit(False).alias("must_hold"))
    return found.unionByName(orphans)


def view_values(view: MetricView, gold: Tables, names) -> DataFrame:
    """(column_name, value, rows): labels of a view's joined dimensions with the source rows that carry them.

    The source is folded to its join keys in one pass; only the folded keys meet the dimension tables.
    """
    labels = {}
    for name in names:
        alias, column = view.dimension(name).expr.split(".")
        labels.setdefault(alias, {})[name] = column
    joins = {j.alias: j for j in view.joins}
    key_of = {alias: re.search(r"\bsource\.(\w+)", joins[alias].on)[1] for alias in labels}
    known = union_all(
        gold[joins[alias].table].select(
            F.lit(key_of[alias]).alias("key_name"), F.col(key_of[alias]).alias("key_value"),
            F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(c).alias("value")) for n, c in of.items()])))
        for alias, of in labels.items())
    used = quality.fold_keys(gold[view.source], list(dict.fromkeys(key_of.values())))
    return used.join(known, ["key_name", "key_value"]).filter("value IS NOT NULL").groupBy("column_name", "value").agg(
        F.sum("rows").alias("rows"))


def column_gaps(spark: SparkSession, gold: Tables, distinct: str | None = "sketch") -> DataFrame:
    """Columns of the tables as they are that have no comment, next to what the data shows about them."""
    live = glossary.schemas_of(gold)
    profile = glossary.profile_tables(gold, glossary.uncommented(live), distinct)
    return glossary.find_gaps(glossary.describe_columns(spark, live)).join(profile, ["table_name", "column_name"])


def column_drafts(
    spark: SparkSession, gold: Tables, fn: Callable[[Column], Column] = glossary.plain_draft,
    distinct: str | None = "sketch",
) -> DataFrame:
    """The gaps with a prompt and a draft made from it by ``fn``."""
    return glossary.draft(column_gaps(spark, gold, distinct).withColumn("prompt", glossary.column_prompt()), fn)


def column_lists(spark: SparkSession, gold: Tables, names=None) -> DataFrame:
    """Per table all its columns in order, with its rows and how many of the columns hold no value."""
    live = glossary.schemas_of({n: gold[n] for n in names or gold})
    evidence = glossary.profile_tables(gold, {t: s.names for t, s in live.items()}, distinct=None, extremes=False)
    return glossary.column_lists(glossary.describe_columns(spark, live)).join(
        evidence.groupBy("table_name").agg(
            F.max("row_count").alias("row_count"),
            F.count_if(F.col("null_count") == F.col("row_count")).alias("empty_columns")), "table_name", "left")


def table_drafts(
    spark: SparkSession, gold: Tables, comments: Mapping[str, str | None],
    fn: Callable[[Column], Column] = glossary.plain_table_draft,
) -> DataFrame:
    """Tables without a comment, with a prompt and a draft; only those tables are read."""
    gaps = glossary.uncommented_tables(comments)
    return glossary.draft(column_lists(spark, gold, gaps).withColumn("prompt", glossary.table_prompt()), fn)


def dictionary(
    spark: SparkSession, gold: Tables, fn: Callable[[Column], Column] = glossary.plain_draft,
    distinct: str | None = "sketch",
) -> DataFrame:
    """Comments of all columns and metrics; only missing ones come from a draft."""
    live = glossary.describe_columns(spark, glossary.schemas_of(gold))
    filled = glossary.fill(live, column_drafts(spark, gold, fn, distinct))
    return filled.unionByName(glossary.describe_metrics(spark, VIEWS.values())).select(
        "table_name", "column_name", "data_type", "position", "comment")
