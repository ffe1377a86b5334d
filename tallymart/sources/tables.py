"""Ranges, table scans, typed output and table writes."""

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

ROWS_PER_RANGE_PART = 2_000_000
# Of stored tables. zstd: a hashed key in hex takes half of its 64 characters, where the default leaves them all. v2: the lengths of texts lie
# apart, which saves two bytes a key. Dictionaries of up to 8 MB hold 100,000 different keys, by default 15,000.
PACKING = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.dictionary.page.size": str(8 << 20)}


def id_range(spark: SparkSession, n: int, parts: int | None = None) -> DataFrame:
    """Rows ``id`` = 0..n-1. Unless told otherwise the number of partitions grows with ``n``."""
    if parts is None:
        parts = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_RANGE_PART))
    return spark.range(0, n, 1, parts)


class Tables(Mapping):
    """Named frames, each defined when it is first asked for: unused tables cost no planning."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def _is_path(ref: str) -> bool:
    return "/" in ref


def inside(where: str, name: str) -> str:
    """Table ``name`` in a folder (``where`` has a slash) or a schema."""
    return f"{where.rstrip('/')}/{name}" if _is_path(where) else f"{where}.{name}"


def ensure_schema(spark: SparkSession, where: str) -> None:
    """Create the schema unless it exists; folders need no creating."""
    if not _is_path(where):
        spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", {"name": where})


def read_bronze(spark: SparkSession, ref: str) -> DataFrame:
    """Scan a table by name (``schema.table``) or a parquet folder by path."""
    return spark.read.parquet(ref) if _is_path(ref) else spark.table(ref)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is written inside go when it is written, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_new(
    df: DataFrame,
    ref: str,
    cluster_by: list[str] | None = None,
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, list[str]] | None = None,
    late: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write ``df`` to a name or parquet folder that is not in use.

    ``cluster_by`` gathers equal values in the same files and sorts each file, so
    that row-group statistics prune scans. It uses a rebalance, which splits a
    value that holds a large share of the rows over several files and merges small
    ones. ``partition_by`` makes one folder per value, for columns with few
    values. ``bucket_by`` (tables by name only) lays two tables out alike so a
    later join on exactly those columns needs no shuffle; buckets are not split,
    so keep it for keys without heavy repeats. ``late`` is applied to the rows where
    they are gathered, so that what it makes (a hashed key of a short text) is neither
    shuffled nor sorted. The shuffle files of a write go as soon as it is done.
    """
    if _is_path(ref) and bucket_by:
        raise ValueError("buckets need a table name, not a path")
    gather = [*(partition_by or []), *(cluster_by or [])]
    if gather:
        df = df.hint("rebalance", *[F.col(c) for c in gather])
    if cluster_by:
        df = df.sortWithinPartitions(*gather)
    if late:
        df = late(df)
    writer = df.write.mode("errorifexists").format("parquet").options(**PACKING)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, columns = bucket_by
        writer = writer.bucketBy(n, *columns).sortBy(*columns)
    with shuffles_dropped(df.sparkSession):
        if _is_path(ref):
            writer.save(ref)
        else:
            writer.saveAsTable(ref)


def write_table(df: DataFrame, ref: str, **layout) -> DataFrame:
    """Replace table ``ref`` (a name or a parquet folder) with ``df``, laid out as ``write_new`` does, and return a scan of it.

    The rows are written beside the old ones and then take their place, so a failed write leaves the old
    table. Between the two there is a moment without a table, and a reader that holds the old files loses them: tables
    that are read while they are replaced belong in a release.
    """
    spark = df.sparkSession
    ref = ref.rstrip("/")
    mark = uuid.uuid4().hex
    fresh = f"{ref}.new-{mark}" if _is_path(ref) else f"{ref}__new_{mark}"
    write_new(df, fresh, **layout)
    if _is_path(ref):
        _swap_in(spark, fresh, ref)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {ref}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {ref}")
    return read_bronze(spark, ref)


def conform(df: DataFrame, schema: T.StructType, check_required: bool = True) -> DataFrame:
    """Exactly the declared columns, in order, with declared types and comments.

    A value that does not fit its type becomes NULL. A NULL in a required column
    stops the job when that column is used, unless ``check_required`` is off
    because earlier rules already dropped such rows.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for field in schema.fields:
        col = F.col(field.name)
        if have[field.name] != field.dataType:
            col = changed[field.name] = col.try_cast(field.dataType)
        if check_required and not field.nullable:
            changed[field.name] = F.coalesce(col, F.raise_error(F.lit(f"{field.name} must not be NULL")))
    if changed:
        df = df.withColumns(changed)
    return df.to(T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields]))


def hold_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the declared NOT NULL columns marked so in its own schema.

    For frames whose rules have dropped the rows with a NULL there: the empty value that
    stands behind the column for Spark's sake never comes up.
    """
    empty = {f.name: F.lit("" if isinstance(f.dataType, T.StringType) else 0).cast(f.dataType)
             for f in schema.fields if not f.nullable}
    marked = df.select(*[
        F.coalesce(F.col(f.name), empty[f.name]).alias(f.name, metadata=f.metadata) if f.name in empty else F.col(f.name)
        for f in schema.fields])
    return marked


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery: usable in any expression, nothing is run now."""
    return df.agg(F.count(F.lit(1))).scalar()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A session on one machine that names none gets a temporary folder; on a cluster that is an
    error, as each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_FOLDER not in _MADE:
        _MADE[_LOCAL_FOLDER] = tempfile.mkdtemp(prefix="tallymart-")
    return _MADE[_LOCAL_FOLDER]


_LOCAL_FOLDER = "local"
_MADE: dict[str, str] = {}


def _file_system(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_table(spark: SparkSession, name: str) -> str:
    """Unused path in the shared folder; what is written there goes when the session's JVM ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/tallymart-{uuid.uuid4().hex}"
    where, files = _file_system(spark, folder)
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{folder}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    where, files = _file_system(spark, path)
    files.delete(where, True)


def durable(df: DataFrame) -> DataFrame:
    """Freeze ``df`` in the checkpoint folder, so two passes over it see the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def _swap_in(spark: SparkSession, fresh: str, ref: str) -> None:
    """Put the folder ``fresh`` in the place of ``ref``, which goes last; for a moment there is neither."""
    new, files = _file_system(spark, fresh)
    now, _ = _file_system(spark, ref)
    old, _ = _file_system(spark, f"{ref}.old-{uuid.uuid4().hex}")
    had = files.exists(now)
    if had and not files.rename(now, old):
        raise OSError(f"cannot move {ref} aside")
    if not files.rename(new, now):
        if had:
            files.rename(old, now)
        raise OSError(f"cannot move {fresh} to {ref}")
    if had:
        files.delete(old, True)
