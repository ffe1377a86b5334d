"""Stored intermediates: the same rows at any level of compression, in less room at a higher one."""

import os

from pyspark.sql import functions as F

from tallymart.llm.common import stored


def test_higher_level_takes_less_room(spark):
    words = [F.element_at(F.split(F.lit("alder birch cedar fir hazel larch maple oak pine rowan"), " "),
                          (F.xxhash64("id", F.lit(i)) % 5 + 6).cast("int")) for i in range(60)]
    texts = spark.range(0, 3000, 1, 1).select("id", F.concat_ws(" ", *words).alias("text"))
    low, high = stored(texts, "low"), stored(texts, "high", 6)
    assert sorted(low.collect()) == sorted(high.collect()) == sorted(texts.collect())

    def size(df):
        return sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())

    assert size(high) < size(low)
