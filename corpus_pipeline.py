"""From raw documents to token sequences in training order, one stored table per stage."""

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import queries as Q
from tallymart.llm.common import stored, table

STAGES = [
    ("language ID", Q.keep_known_language),
    ("SimHash near-dedup", Q.keep_one_near_copy),
    ("benchmark decontamination", Q.drop_benchmark_leaks),
    ("mixing sources to target weights", Q.mix_to_targets),
    ("token-ID / binary output", Q.order_for_training),
]
LEVEL = 6  # of zstd: the tables of all stages lie on disk together
ORACLE_SQL = None  # fingerprints, trained filters and token ids are beyond SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``; every stage reads what the one before stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" / ", " ").replace(" ", "-"), LEVEL)
    return docs
