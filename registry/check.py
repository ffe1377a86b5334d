"""Run every registered query and its SQL side by side: ``python -m registry.check DIR [name ...]``."""

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .oracle import ORACLE
from .queries import QUERIES


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("tallymart-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _plain(table) -> tuple[list[str], list[tuple]]:
    """Column names in order and sorted rows of an Arrow table, every value as text."""
    names = sorted(table.column_names)
    columns = [[repr(v) if isinstance(v, float) else str(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns))


def compare(spark, con, name: str, folder: str) -> str:
    """Empty when both sides give the same rows, else what differs."""
    got_names, got = _plain(QUERIES[name](spark, folder).toArrow())
    want_names, want = _plain(con.execute(ORACLE[name]).to_arrow_table())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    if not got:
        return "both sides are empty"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


def main(folder: str, names) -> int:
    spark, con = local_session(), connect(folder)
    failed = []
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder) if name in ORACLE else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - start:.1f}s {problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} of {len(names or QUERIES)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
