from collections import Counter
from decimal import Decimal
from hashlib import sha256

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymart import fixed_values as V
from tallymart.functions import columns as C
from tallymart.functions.names import letter_code, name_udf


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_surrogate_key(spark):
    assert one(spark, C.surrogate_key(F.lit("G1"))) == sha256(b"G1").hexdigest()
    assert one(spark, C.surrogate_key(F.lit("T1"), F.lit(2))) == sha256(b"T1-2").hexdigest()
    assert one(spark, C.surrogate_key(F.lit("T1"), F.lit(None))) is None
    assert one(spark, C.surrogate_key(F.lit(None).cast("string"))) is None


def test_id_text_never_cuts(spark):
    assert one(spark, C.id_text("G", F.lit(7), 4)) == "G0007"
    assert one(spark, C.id_text("G", F.lit(123456), 4)) == "G123456"
    ids = spark.createDataFrame([(1234567890,), (1234567899,)], "n bigint").select(C.id_text("T", "n", 9).alias("x"))
    assert ids.distinct().count() == 2


def test_draws_reach_every_row_of_a_large_table(spark):
    n = 10 ** 10
    picks = [r.i for r in spark.range(20_000).select(C.draw_below(C.draw(1, "wide", "id"), n).alias("i")).collect()]
    assert min(picks) >= 0 and max(picks) < n
    # the nearest of 2^32 evenly spaced draws leaves more than half of these rows out
    missed = [i for i in picks if -(-i * 2 ** 32 // n) * n // 2 ** 32 != i]
    assert len(missed) > 5_000


def test_draw_is_stable_and_even(spark):
    few, many = spark.range(0, 20_000, 1, 2), spark.range(0, 20_000, 1, 13)
    u = C.draw(1, "t", "id").alias("u")
    assert sorted(r.u for r in few.select(u).collect()) == sorted(r.u for r in many.select(u).collect())
    stats = few.select(u).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.01
    other = C.draw(2, "t", "id").alias("u")
    assert few.select(u).first() != few.select(other).first()


def test_weighted_pick_has_the_asked_shares(spark):
    df = spark.range(50_000).withColumn("d", C.draw(3, "w", "id"))
    got = Counter(r.x for r in df.select(
        C.weighted_pick("d", V.CATEGORIES, V.CATEGORY_WEIGHTS).alias("x")).collect())
    for value, share in zip(V.CATEGORIES, V.CATEGORY_WEIGHTS):
        assert got[value] / 50_000 == pytest.approx(share, abs=0.01)


def test_pick_covers_all_values(spark):
    df = spark.range(1000).select(C.pick(C.draw(1, "p", "id"), V.BRANDS).alias("x"))
    assert {r.x for r in df.distinct().collect()} == set(V.BRANDS)
    low = one(spark, C.pick(F.lit(0.0), V.BRANDS))
    high = one(spark, C.pick(F.lit(0.9999999), V.BRANDS))
    assert (low, high) == (V.BRANDS[0], V.BRANDS[-1])


def test_band_and_lookup(spark):
    assert one(spark, C.band(F.lit("Tops"), V.PRICE_LOW)) == 48
    assert one(spark, C.band(F.lit("Nothing"), V.PRICE_LOW)) is None
    assert one(spark, F.element_at(C.lookup(V.STATE_OF_REGION), F.lit("South"))) == "GA"


@pytest.mark.parametrize("text,blank", [(None, True), ("", True), ("   ", True), (" a ", False)])
def test_is_blank(spark, text, blank):
    assert one(spark, C.is_blank(F.lit(text).cast("string"))) is blank


def test_money(spark):
    assert one(spark, C.money(F.lit(123456))) == Decimal("1234.56")
    assert one(spark, C.money(F.lit(-5))) == Decimal("-0.05")
    assert one(spark, C.money(F.lit(10**11))) is None
    assert one(spark, C.money(F.lit(10**15))) is None
    assert one(spark, C.cents(F.lit(19.99))) == 1999
    assert one(spark, C.percent_of(F.lit(1250), 20)) == 250
    assert one(spark, C.percent_of(F.lit(13), 20)) == 3   # 2.6 rounds up


def test_ratio(spark):
    assert one(spark, C.ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, C.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, C.ratio(F.lit(None).cast("int"), F.lit(4))) is None


def test_name_udf(spark):
    ids = spark.range(0, 60, 1, 3)
    shout = name_udf(lambda s: pd.Series([f"N{i}" for i in s]))
    assert ids.select(shout("id").alias("x")).distinct().count() == 60
    got = {r.id: r.x for r in ids.select("id", name_udf(letter_code)("id").alias("x")).collect()}
    assert got[0] == "AAA" and got[27] == "BBA" and len(set(got.values())) == 60
