"""Named row rules and key audits.

A rule is a name, a SQL condition and what to do with rows that fail it. A
condition that comes out NULL counts as failed.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from . import marks


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    drop: bool = True

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


class RuleResult(NamedTuple):
    kept: DataFrame
    violations: DataFrame
    report: DataFrame


def keep_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every dropping rule: one filter that can reach the scan."""
    condition = None
    for rule in rules:
        if rule.drop:
            check = F.expr(rule.condition)
            condition = check if condition is None else condition & check
    return df if condition is None else df.filter(condition)


def failing_rows(df: DataFrame, rules: Sequence[Rule], only_dropped: bool = False) -> DataFrame:
    """Rows that break a rule, with the rule names in ``failed_rules``."""
    used = [r for r in rules if r.drop or not only_dropped]
    names = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in used]))
    return df.withColumn("failed_rules", names).filter(F.size("failed_rules") > 0)


def flag_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows, with one boolean per rule."""
    return df.withColumns({r.name: r.passes() for r in rules})


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Passed and failed rows per rule, counted in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~r.passes()).alias(f"_failed_{i}") for i, r in enumerate(rules)],
    )
    lines = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit("drop" if r.drop else "keep").alias("on_failure"),
            (F.col("_rows") - F.col(f"_failed_{i}")).alias("passed"),
            F.col(f"_failed_{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ])
    return counts.select(F.inline(lines))


@dataclass(frozen=True)
class Counted:
    """Rows that pass, and the counts of all rules, which are there once the rows were written."""

    rules: Sequence[Rule]
    kept: DataFrame
    seen: Observation

    def report(self, stored_rows: int) -> list[dict] | None:
        """Passed and failed rows per rule, or None if the counts do not go with the number of rows that were stored.

        That happens when a stage that feeds a shuffle ran again after an executor was lost: its rows are counted
        again, though they are stored once. There are no counts at all where the plan turned out to need no rows.
        """
        try:
            got = self.seen.get
        except Py4JJavaError:
            return None
        if got["kept"] != stored_rows:
            return None
        return [{"rule": r.name, "on_failure": "drop" if r.drop else "keep",
                 "passed": got["rows"] - got[f"failed_{i}"], "failed": got[f"failed_{i}"]}
                for i, r in enumerate(self.rules)]


def counted_rows(df: DataFrame, rules: Sequence[Rule]) -> Counted:
    """Rows that pass every dropping rule, counted by rule as they go by: no pass of its own.

    A plan that is used in several actions keeps the counts of the first.
    """
    passes = F.lit(True)
    for rule in rules:
        if rule.drop:
            passes = passes & rule.passes()
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(passes).alias("kept"),
        *[F.count_if(~r.passes()).alias(f"failed_{i}") for i, r in enumerate(rules)])
    return Counted(rules, keep_rows(watched, rules), seen)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> RuleResult:
    """Kept rows, rows that break any rule, and counts per rule."""
    return RuleResult(keep_rows(df, rules), failing_rows(df, rules), rule_report(df, rules))


def _key(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*_key(key)).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def audit_primary_key(df: DataFrame, key) -> DataFrame:
    """One row: total rows, NULL keys, distinct keys, repeated keys, surplus rows.

    Only hashes of the keys are shuffled, and of the keys themselves those whose hash repeats; they are counted with
    map-side partial sums, so a hot key costs one row per task in the shuffle. ``df`` is read twice.
    """
    keys = _key(key)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    rows = df.select(*keys, missing.alias("_null"))
    rows = marks.marked(rows, keys, marks.repeated(rows.filter("NOT _null"), keys), "_again")
    closer = F.col("_again") & ~F.col("_null")
    counted = rows.groupBy("_null", closer.alias("_again"), *[F.when(closer, F.col(k)).alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"))
    n, null, again = F.col("_n"), F.col("_null"), F.col("_again")
    repeats = again & (n > 1)
    return counted.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(null, n)), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(again, F.lit(1)).when(~null, n)), F.lit(0)).alias("distinct_keys"),
        F.count_if(repeats).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeats, n - 1)), F.lit(0)).alias("surplus_rows"),
    )


def audit_foreign_key(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Key values of ``fact`` that no row of ``dim`` carries, with their number of rows.

    The fact is folded to one row per key before the anti join. NULL keys point
    nowhere by design and are not orphans.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(F.col(dim_key or key).alias("_known"))
    return used.join(known, F.col(key) == F.col("_known"), "left_anti")


def fold_keys(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key_name, key_value, rows) of several key columns in one pass, NULL values included.

    Values are counted map-side, so a hot key costs a row per task in the one shuffle.
    """
    cells = F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).alias("key_value")) for k in keys])
    return fact.select(F.inline(cells)).groupBy("key_name", "key_value").agg(F.count(F.lit(1)).alias("rows"))


def summarise_keys(fact: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """How a table's keys meet the tables they point at; one pass over ``fact`` for all keys.

    ``parents`` maps a key column to the frame that owns it. One row per key: ``child_rows`` with a key,
    ``null_rows`` without, ``matched_rows``, ``orphan_rows`` and ``orphan_keys`` that no parent carries,
    ``parent_keys`` and ``unused_keys`` that no row points at.
    """
    used = fold_keys(fact, list(parents))
    known = None
    for key, frame in parents.items():
        one = frame.select(F.lit(key).alias("key_name"), F.col(key).alias("key_value")).filter("key_value IS NOT NULL")
        known = one if known is None else known.unionAll(one)
    met = used.join(known.distinct().withColumn("known", F.lit(True)), ["key_name", "key_value"], "full")
    rows, is_key = F.coalesce("rows", F.lit(0)), F.col("key_value").isNotNull()
    orphan = is_key & F.col("known").isNull()
    return met.groupBy("key_name").agg(
        F.sum(F.when(is_key, rows).otherwise(0)).alias("child_rows"),
        F.sum(F.when(is_key, 0).otherwise(rows)).alias("null_rows"),
        F.sum(F.when(is_key & F.col("known"), rows).otherwise(0)).alias("matched_rows"),
        F.sum(F.when(orphan, rows).otherwise(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"), F.count_if(F.col("known")).alias("parent_keys"),
        F.count_if(F.col("known") & F.col("rows").isNull()).alias("unused_keys"))


def audit_many_to_one(dim: DataFrame, key) -> DataFrame:
    """One row: the most rows any key value has, and whether that is at most one."""
    keys = _key(key)
    counted = dim.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    most = F.coalesce(F.max("_n"), F.lit(0))
    return counted.agg(most.alias("max_rows_per_key"), (most <= 1).alias("is_many_to_one"))


def audit_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per required column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rows")) for c in columns
    ])))
