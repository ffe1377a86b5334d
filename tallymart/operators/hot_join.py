"""Left join of a fact with a table in which a few keys may hold most of the fact's rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SHARE = 0.01            # a key with more of the rows than this is hot
TRACKED = 10_000        # keys that the sketch follows in a task
BROADCAST_CHARS = 8 << 20  # most text, as JSON, of the rows that hot keys point at


def hot_keys(df: DataFrame, key: str, share: float = SHARE, tracked: int = TRACKED) -> list:
    """Keys that hold more than ``share`` of the rows that have one, by a frequent-items sketch.

    The sketch is made map-side and merged, so a hot key costs no shuffle of its rows. At most 1 / ``share`` keys come
    back. Counts are estimates, so a key near the limit may be in or out.
    """
    most = max(1, int(1 / share))
    found = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(`{key}`, {most}, {max(tracked, most)})").alias("top")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] > share * found["rows"]]


def split_join(
    fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], dim_key: str | None = None,
    share: float = SHARE, broadcast_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """``fact`` left-joined to ``columns`` of ``dim``, without any task that holds a hot key's rows.

    Rows of hot keys and rows without a key stay where they are and meet the few rows of ``dim`` they point at by
    broadcast, once the size of those is known to be small; all other rows are joined as Spark sees fit. Where that
    side is too large, or no key is hot and none is NULL, this is the plain join. What the sketch finds moves rows
    from one way to the other and never changes the result. Repeated keys of ``dim`` multiply rows as in
    any join; an empty ``fact`` gives no rows. ``columns`` must differ from the fact's names. ``fact`` is read
    twice, so its rows must not change from one read to the next.
    """
    dim_key = dim_key or key
    rows = fact.select(F.struct(*[F.col(f"`{c}`") for c in fact.columns]).alias("row"), F.col(f"`{key}`").alias("k"))
    side = dim.filter(F.col(f"`{dim_key}`").isNotNull()).select(
        F.col(f"`{dim_key}`").alias("dim_k"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("dim"))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, F.col("k") == F.col("dim_k"), "left").select("row.*", "dim.*")

    hot = hot_keys(fact, key, share)
    few = side.filter(F.col("dim_k").isin(hot))
    size = few.agg(F.sum(F.length(F.to_json(F.struct("dim_k", "dim"))))).first()[0] if hot else 0
    if (size or 0) > broadcast_chars:
        return joined(rows, side)
    apart = F.col("k").isNull() | F.col("k").isin(hot)
    return joined(rows.filter(apart), F.broadcast(few)).unionAll(
        joined(rows.filter(~apart), side.filter(~F.col("dim_k").isin(hot))))
