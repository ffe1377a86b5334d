"""Units on hand by day, region and category."""

from pyspark.sql import Column, functions as F

from .. import fixed_values as V


def stock_noise(draw_col: Column) -> Column:
    """A draw as whole units around zero."""
    return (draw_col * V.STOCK_NOISE_WIDTH - V.STOCK_NOISE_WIDTH / 2).cast("int")


def stock_level(
    day: Column, region: Column, category: Column, noise: Column,
    depleted_region: str = V.DEPLETED_REGION, focus_category: str = V.PROMO_CATEGORY,
) -> Column:
    """A run-down to zero for one region and category, else a flat level with noise; never below zero."""
    focus = category == focus_category
    run_down = F.lit(V.DEPLETED_FIRST_STOCK) - day * V.DEPLETED_DAILY_DROP
    flat = F.when(focus, V.STOCK_PROMO_CATEGORY).otherwise(V.STOCK_OTHER) + noise
    return F.greatest(F.lit(0), F.when((region == depleted_region) & focus, run_down).otherwise(flat)).cast("int")
