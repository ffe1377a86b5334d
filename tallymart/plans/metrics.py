"""Metric views and the query over them.

A view names a source table, many-to-one joins, dimensions and measures. A
measure is made of aggregate parts, each taken from base rows at the grain that
is asked for; a ratio of two sums is never summed again.
"""

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import Join, star_join

# -- definition -------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """One aggregate of a row-level source expression.

    ``how`` is ``distinct`` or the name of a Spark aggregate function.
    """

    how: str
    of: str

    def over(self, column: str) -> Column:
        if self.how == "distinct":
            return F.countDistinct(column)
        return F.call_function(self.how, F.col(column))


def total(of: str) -> Part:
    """Sum; NULL when no row has a value."""
    return Part("sum", of)


def counted(of: str) -> Part:
    """Number of rows where the expression is not NULL."""
    return Part("count", of)


def distinct(of: str) -> Part:
    """Number of different values; cannot be added up over groups."""
    return Part("distinct", of)


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: str
    comment: str = ""


@dataclass(frozen=True)
class Measure:
    """``value`` combines the parts, which are passed to it by name."""

    name: str
    parts: Mapping[str, Part]
    value: Callable[..., Column] | None = None
    comment: str = ""

    def combine(self, columns: Mapping[str, Column]) -> Column:
        if self.value is None:
            (only,) = columns.values()
            return only
        return self.value(**columns)


@dataclass(frozen=True)
class JoinSpec:
    """Left join of a gold table; ``on`` may name ``source`` and other aliases.

    ``range_on``: a (source column, joined column) pair that ``on`` equates, usually
    dates. Joined rows outside the source's range of it cannot match. It also says that few rows of the source have a partner.
    """

    alias: str
    table: str
    on: str
    range_on: tuple[str, str] | None = None


@dataclass(frozen=True)
class MetricView:
    name: str
    source: str
    joins: Sequence[JoinSpec]
    dimensions: Sequence[Dimension]
    measures: Sequence[Measure]
    comment: str = ""
    fold: bool = False  # the source repeats its join keys often, as a snapshot does, so it is folded before it is joined

    @property
    def _dims(self) -> dict[str, Dimension]:
        return {d.name: d for d in self.dimensions}

    @property
    def _measures(self) -> dict[str, Measure]:
        return {m.name: m for m in self.measures}

    def with_dimensions(self, *more: Dimension) -> "MetricView":
        """The same view with further dimensions."""
        return replace(self, dimensions=[*self.dimensions, *more])

    def dimension(self, name: str) -> Dimension:
        if name not in self._dims:
            raise ValueError(f"{self.name} has no dimension {name!r}; it has {list(self._dims)}")
        return self._dims[name]

    def measure(self, name: str) -> Measure:
        if name not in self._measures:
            raise ValueError(f"{self.name} has no measure {name!r}; it has {list(self._measures)}")
        return self._measures[name]

    def aliases_in(self, texts) -> set[str]:
        """Join aliases that SQL texts mention, and the aliases those joins need in turn.

        A mention inside a quoted literal counts too; that costs a join and
        never changes the result.
        """
        found: set[str] = set()
        todo = list(texts)
        while todo:
            text = todo.pop()
            for join in self.joins:
                if join.alias not in found and re.search(rf"\b{re.escape(join.alias)}`?\.", text):
                    found.add(join.alias)
                    todo.append(join.on)
        return found


# -- query ------------------------------------------------------------------

# How partial results of an aggregate are put together.
_MERGE = {"sum": F.sum, "count": lambda c: F.coalesce(F.sum(c), F.lit(0)), "min": F.min, "max": F.max}

Where = str | Mapping[str, object] | None


def _named_in(text: str | None, names) -> list[str]:
    return [n for n in names if text and n in text]


def _condition(name: str, test) -> Column:
    col = F.col(f"`{name}`")
    if callable(test):
        return test(col)
    if isinstance(test, (list, tuple, set)):
        return col.isin(list(test))
    return col.isNull() if test is None else col == test


def _ordering(item, names: Sequence[str]):
    name, way = (item, "asc") if isinstance(item, str) else item
    if name not in names:
        raise ValueError(f"order_by {name!r} is neither an asked dimension nor a measure of the view")
    col = F.col(f"`{name}`")
    return col.desc_nulls_last() if way == "desc" else col.asc_nulls_last()


def _joined(view: MetricView, gold, source: DataFrame, used) -> DataFrame:
    return star_join(source, [
        Join(j.alias, gold[j.table], j.on, j.range_on) for j in view.joins if j.alias in used
    ])


def _only_asked(view: MetricView, gold, source: DataFrame, dims, where) -> DataFrame:
    """``source`` without rows whose joined dimension fails an equality or list filter, before anything is folded.

    Only filters that no NULL passes and that name one table are used; they are applied again later.
    """
    if not isinstance(where, Mapping):
        return source
    for join in view.joins:
        texts = {}
        for name, test in where.items():
            plain = test is not None and not callable(test) and None not in (
                test if isinstance(test, (list, tuple, set)) else [test])
            if plain and view.aliases_in([dims[name].expr]) == {join.alias} and "source" not in dims[name].expr:
                texts[name] = test
        if texts and not view.aliases_in([join.on]) - {join.alias}:
            asked = gold[join.table].alias(join.alias)
            for name, test in texts.items():
                asked = asked.withColumn("_asked", F.expr(dims[name].expr)).filter(_condition("_asked", test)).drop("_asked")
                asked = asked.alias(join.alias)
            source = source.alias("source").join(asked, F.expr(join.on), "left_semi")
    return source


def _folded(view: MetricView, gold, dims, parts, prune_joins, where):
    """Rows folded to one per join key, then joined; and how to finish each part.

    Joins that the parts need are made first, at row level. The other joins only
    supply dimensions and are made on the folded rows.
    """
    for p in parts:
        if p.how != "distinct" and p.how not in _MERGE:
            raise ValueError(f"{p.how}() cannot be put together from partial results")
    early = view.aliases_in(p.of for p in parts)
    for d in dims.values():
        if re.search(r"\bsource`?\.", d.expr):
            early |= view.aliases_in([d.expr])
    late_dims = {n: d for n, d in dims.items() if not re.search(r"\bsource`?\.", d.expr)
                 and not view.aliases_in([d.expr]) & early}
    early |= view.aliases_in(d.expr for n, d in dims.items() if n not in late_dims)
    late = view.aliases_in(d.expr for d in late_dims.values()) if prune_joins else {j.alias for j in view.joins}
    late_joins = [j for j in view.joins if j.alias in late - early]
    fold_keys = sorted({k for j in late_joins for k in re.findall(r"\bsource`?\.`?(\w+)", j.on)})

    source = _only_asked(view, gold, gold[view.source], dims, where)
    rows = _joined(view, gold, source, early).select(
        *[F.expr(d.expr).alias(n) for n, d in dims.items() if n not in late_dims],
        *[F.expr(f"source.`{k}`").alias(k) for k in fold_keys],
        *[F.expr(p.of).alias(c) for p, c in parts.items()],
    )
    names = [n for n in dims if n not in late_dims]
    by = [*names, *fold_keys, *[c for p, c in parts.items() if p.how == "distinct"]]
    sums = [p.over(c).alias(c) for p, c in parts.items() if p.how != "distinct"]
    quoted = [F.col(f"`{n}`") for n in by]
    folded = rows.groupBy(*quoted).agg(*sums) if sums else rows.select(*quoted).distinct()
    out = _joined(view, gold, folded, {j.alias for j in late_joins}).select(
        *[F.col(f"source.`{n}`") for n in names],
        *[F.expr(d.expr).alias(n) for n, d in late_dims.items()],
        *[F.col(f"source.{c}") for c in parts.values()],
    )
    finish = {c: p.over(c) if p.how == "distinct" else _MERGE[p.how](F.col(c)) for p, c in parts.items()}
    return out, finish


def metric_query(
    view: MetricView,
    gold: Mapping[str, DataFrame],
    dimensions: Sequence[str] = (),
    measures: Sequence[str] = (),
    where: Where = None,
    having: str | None = None,
    order_by: Sequence[str | tuple[str, str]] = (),
    limit: int | None = None,
    prune_joins: bool = True,
    pre_aggregate: bool | None = None,
    rollups: Sequence = (),
) -> DataFrame:
    """Measures of ``view`` for every combination of dimension values.

    ``where``: SQL text naming dimensions, or {dimension: value, list of values or
    function of its Column}. ``having``: SQL text naming asked dimensions and any
    measure. ``order_by``: names or (name, "desc"); NULLs come last and ties fall to
    the asked dimensions. No measures: the distinct dimension values. No
    dimensions: one grand-total row.

    Only joins that the asked names use are made (``prune_joins=False`` makes all).
    That is sound as long as each joined table has one row per key, which
    ``audit_many_to_one`` checks.

    ``pre_aggregate`` folds the source to one row per join key before joining (default: what the view says in ``fold``).
    Worth it when a joined table is too large to broadcast: the join then moves
    folded rows, and a hot key shrinks before it is shuffled. With broadcast-sized
    dimensions the plain plan has fewer shuffles. Both give the same rows. Equality
    filters on a joined table cut the source down before it is folded, and each distinct count is folded
    on its own, as a key of two would hardly shrink.

    A join with ``range_on`` only meets joined rows in the source's range of that column, and only source rows that may have a
    partner are shuffled for it.

    ``rollups`` (of ``plans.rollups``) are stored aggregates. The first one that covers the query, filters included, is read in the
    place of the base rows; the rows that come out are the same. Queries without a measure read base rows.
    """
    if pre_aggregate is None:
        pre_aggregate = view.fold and prune_joins
    if not dimensions and not measures:
        raise ValueError("ask for at least one dimension or measure")
    where_text = where if isinstance(where, str) else None
    filtered = list(where) if isinstance(where, Mapping) else _named_in(where, view._dims)
    ordered = [o if isinstance(o, str) else o[0] for o in order_by]
    hidden = [
        m for m in view._measures
        if m not in measures and (m in ordered or m in _named_in(having, view._measures))
    ]
    dims = {n: view.dimension(n) for n in [*dimensions, *[f for f in filtered if f not in dimensions]]}
    wanted = {n: view.measure(n) for n in [*measures, *hidden]}
    parts = {p: f"_part_{i}" for i, p in enumerate(dict.fromkeys(
        p for m in wanted.values() for p in m.parts.values()))}

    keys = [F.col(f"`{n}`") for n in dimensions]

    def asked_rows(rows: DataFrame) -> DataFrame:
        if where_text is not None:
            return rows.filter(where_text)
        for name, test in (where or {}).items():
            rows = rows.filter(_condition(name, test))
        return rows

    def finished(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, *[
            m.combine({k: F.col(parts[p]) for k, p in m.parts.items()}).alias(n) for n, m in wanted.items()])

    def filtered_rows(some: dict) -> tuple[DataFrame, dict]:
        if pre_aggregate:
            rows, columns = _folded(view, gold, dims, some, prune_joins, where)
        else:
            texts = [d.expr for d in dims.values()] + [p.of for p in some]
            used = view.aliases_in(texts) if prune_joins else {j.alias for j in view.joins}
            rows = _joined(view, gold, gold[view.source], used).select(
                *[F.expr(d.expr).alias(n) for n, d in dims.items()],
                *[F.expr(p.of).alias(c) for p, c in some.items()],
            )
            columns = {c: p.over(c) for p, c in some.items()}
        return asked_rows(rows), columns

    def grouped(some: dict) -> DataFrame:
        rows, columns = filtered_rows(some)
        return (rows.groupBy(*keys) if keys else rows.groupBy()).agg(*[c.alias(n) for n, c in columns.items()])

    chosen = next((r for r in rollups if r.covers(view, dims, list(parts))), None)
    if not measures and not hidden:
        out = filtered_rows(parts)[0].select(*keys).distinct()
    elif chosen:
        out = finished(chosen.grouped(view, gold, dims, dimensions, parts, asked_rows))
    else:
        distinct_parts = [p for p in parts if p.how == "distinct"]
        apart = distinct_parts[1:] if pre_aggregate else []
        out = grouped({p: c for p, c in parts.items() if p not in apart}).withColumn("_one", F.lit(1))
        for p in apart:
            more = grouped({p: parts[p]}).withColumn("_one", F.lit(1)).alias("more")
            same = [F.col(f"main.`{n}`").eqNullSafe(F.col(f"more.`{n}`")) for n in ["_one", *dimensions]]
            out = out.alias("main").join(more, same).select("main.*", f"more.{parts[p]}")
        out = finished(out)
    if having:
        out = out.filter(having)
    if order_by or limit is not None:
        names = [*dimensions, *wanted]
        ties = [d for d in dimensions if d not in ordered]
        out = out.orderBy(*[_ordering(o, names) for o in [*order_by, *ties]])
    if limit is not None:
        out = out.limit(limit)
    return out.drop(*hidden) if hidden else out
