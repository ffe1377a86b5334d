"""Column -> Column helpers, all built from Spark's own functions.

Everything here stays inside whole-stage codegen and gives the same value for
the same row whatever the partitioning.
"""

from collections.abc import Mapping, Sequence
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, functions as F

DRAW_HEX = 13  # hex digits of a digest that a draw uses: 52 bits, as many as a double holds below 1
DRAWS = float(16 ** DRAW_HEX)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- keys -------------------------------------------------------------------

def key_text(*parts) -> Column:
    """The parts joined with ``-``; NULL if any part is NULL. Two of these are equal exactly where their surrogate keys are."""
    texts = [_col(p).cast("string") for p in parts]
    joined = [texts[0]]
    for t in texts[1:]:
        joined += [F.lit("-"), t]
    return F.concat(*joined) if len(joined) > 1 else joined[0]


def hashed_key(text) -> Column:
    """The surrogate key of a ``key_text``."""
    return F.sha2(_col(text), 256)


def surrogate_key(*parts) -> Column:
    """Lower-case hex SHA-256 of the parts joined with ``-``; NULL if any part is NULL."""
    return hashed_key(key_text(*parts))


def packed_key(key) -> Column:
    """A hashed key in half its length, for a shuffle; any other text stays as long. A first byte tells the two apart."""
    key = _col(key)
    return F.when(key.rlike("^([0-9a-f]{2})+$"), F.concat(F.lit(b"\x01"), F.unhex(key))).otherwise(
        F.concat(F.lit(b"\x00"), key.cast("binary")))


def unpacked_key(packed) -> Column:
    """The key of a ``packed_key``."""
    packed = _col(packed)
    rest = F.substring(packed, 2, 0x7FFFFFFF)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def id_text(prefix: str, number, width: int) -> Column:
    """``prefix`` and the number with zeros in front up to ``width`` digits; a longer number stays whole."""
    digits = _col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


# -- seeded draws -----------------------------------------------------------

def draw(seed: int, tag: str, *keys) -> Column:
    """Uniform value in [0, 1) fixed by the row's keys, the seed and the tag.

    Unlike ``rand()`` it does not depend on partitioning, so a lost task that is
    run again gives the same rows.
    """
    text = F.concat_ws("-", *[_col(k).cast("string") for k in keys], F.lit(str(seed)), F.lit(tag))
    bits = F.conv(F.substring(F.md5(text), 1, DRAW_HEX), 16, 10).cast("bigint")
    return bits / F.lit(DRAWS)


def draw_below(draw_col, n) -> Column:
    """Whole number 0..n-1 picked by a draw; ``n`` may be a number or a Column."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.floor(_col(draw_col) * n)


def pick(draw_col, values: Sequence[str]) -> Column:
    """One of ``values``, all equally likely."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (draw_below(draw_col, len(values)) + 1).cast("int"))


def pick_from(draw_col, options: Column) -> Column:
    """One element of an array column, all equally likely."""
    return F.element_at(options, (draw_below(draw_col, F.size(options)) + 1).cast("int"))


def weighted_pick(draw_col, values: Sequence[str], weights: Sequence[float]) -> Column:
    """One of ``values`` with the given shares: as many shares are used up as running totals lie below the draw."""
    ends = list(accumulate(Decimal(str(w)) for w in weights))[:-1]
    passed = F.filter(F.array(*[F.lit(float(e)) for e in ends]).cast("array<double>"), lambda end: end <= _col(draw_col))
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.size(passed) + 1)


# -- lookups and conditionals -----------------------------------------------

def lookup(mapping: Mapping) -> Column:
    """Map literal from a dict; list values become arrays."""
    items = []
    for key, value in mapping.items():
        items += [F.lit(key), F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)]
    return F.create_map(*items)


def band(col, mapping: Mapping[str, float]) -> Column:
    """Number for a text value; NULL when the text is not in the mapping."""
    return lookup(mapping)[_col(col)]


def is_blank(col) -> Column:
    """True for NULL, empty and all-space text."""
    return F.coalesce(F.trim(_col(col)), F.lit("")) == ""


# -- money ------------------------------------------------------------------

def cents(amount) -> Column:
    """Whole cents of an amount that has at most two decimals."""
    return F.round(_col(amount) * 100).cast("bigint")


def money(cents_col) -> Column:
    """DECIMAL(10,2) from whole cents; NULL when it does not fit."""
    return (_col(cents_col).try_cast("decimal(12,0)") * F.lit(Decimal("0.01"))).try_cast("decimal(10,2)")


def percent_of(cents_col, percent) -> Column:
    """``percent`` per cent of whole cents, rounded half up to whole cents."""
    return F.floor((_col(cents_col) * percent + 50) / 100)


# -- ratios -----------------------------------------------------------------

def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as DOUBLE; NULL for a zero or NULL divisor."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
