"""Token ids in training order: fixed-length sequences, a keyed permutation of slots, fixed-stride shards."""

import base64
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.tables import remove, scratch_table, shared_folder
from .common import SLICE, shuffles_dropped, stored

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value
SEQ_LEN = 1024
END_ID = 50_256        # ends each text; a free id of the vocabulary
SHARD_BYTES = 64 << 20
PASSES = 3             # in which the shard files are written
ROUNDS = 6
ROW_END = b"\n"        # last byte of every record in a shard file
_MASK = (1 << 64) - 1


# -- tokens -----------------------------------------------------------------

def _encoder(path: str, width: int):
    """Function from texts to their packed little-endian ids.

    Whole texts are encoded: a memo of their words took half as long again, as most words are met a few times only.
    """
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    kind = f"<u{width}"

    def encode(texts: list[str]) -> list[bytes]:
        return [np.array(encoding.encode_ordinary(t), kind).tobytes() for t in texts]

    return encode


def pack(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", width: int = 2) -> DataFrame:
    """Sequences (part, local, doc_ids, n_tokens, tokens) of exactly ``seq_len`` ids of ``width`` bytes.

    The texts of a task follow each other, each ended by ``end_id``; only a task's last
    sequence is filled up, with ``end_id``. ``n_tokens`` counts the rest. ``doc_ids`` lists the rows
    with tokens in the sequence.
    """
    stride = seq_len * width
    end = int(end_id).to_bytes(width, "little")
    id_type = docs.schema[id_col].dataType.simpleString()
    ids = to_arrow_type(docs.schema[id_col].dataType)
    schema = pa.schema([("part", pa.int32()), ("local", pa.int64()), ("doc_ids", pa.list_(ids)),
                        ("n_tokens", pa.int32()), ("tokens", pa.binary())])

    def run(batches):
        encode = _encoder(path, width)
        part, local, held, inside = 0, 0, bytearray(), []

        def full(filled: int):
            nonlocal local
            row = (part, local, list(inside), filled // width, bytes(held[:stride]))
            del held[:stride]
            local += 1
            return row

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                parts, doc_ids, texts = (c.to_pylist() for c in batch.slice(start, SLICE).columns)
                part = parts[0]
                out = []
                for doc, text, packed in zip(doc_ids, texts, encode([t or "" for t in texts])):
                    if not text:
                        continue
                    held += packed + end
                    inside.append(doc)
                    while len(held) >= stride:
                        out.append(full(stride))
                        inside = [doc] if held else []
                if out:
                    yield batch_of(out)
        if held:
            filled = len(held)
            held += end * ((stride - filled) // width)
            yield batch_of([full(filled)])

    return docs.select(F.spark_partition_id().alias("part"), id_col, text_col).mapInArrow(
        run, f"part int, local bigint, doc_ids array<{id_type}>, n_tokens int, tokens binary")


# -- order ------------------------------------------------------------------

def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots 0..n-1 of the indexes 0..n-1: a keyed Feistel network, walked until it lands below ``n``."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = [(key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) & _MASK for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            mixed = (right ^ np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(29)) & low)
        return (left << np.uint64(half)) | right

    slot = once(index.astype(np.uint64))
    while (out := slot >= np.uint64(n)).any():
        slot[out] = once(slot[out])
    return slot.astype(np.int64)


def placed(docs: DataFrame, path: str, key: int = 1, seq_len: int = SEQ_LEN, shard_bytes: int = SHARD_BYTES,
           width: int = 2, place: str | None = None, **pack_args) -> tuple[DataFrame, int]:
    """All sequences as (slot, shard, offset, doc_ids, n_tokens, tokens) in the order they are packed, and the number of shards.

    Sequences are packed and stored once, at ``place`` if it is given. They are numbered through the counts per
    input split, and the number is permuted into a global slot; a shard is a
    run of slots, and ``offset`` the place of a sequence in its shard's file. The one
    broadcast has a row of two numbers per input split.
    """
    packed = stored(pack(docs, path, seq_len, width=width, **pack_args), "sequences", place=place)
    n = packed.count()
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = packed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))

    @F.pandas_udf("bigint")
    def slot_of(index: pd.Series) -> pd.Series:
        return pd.Series(permute(index.to_numpy(), n, key))

    # named non-deterministic, so that a filter by shard is not pushed below it, where the slot is worked out once more in
    # a second Python worker of the task
    slot = slot_of.asNondeterministic()(F.col("start") + F.col("local"))
    stride, in_shard = _strides(seq_len, width, shard_bytes)
    slots = packed.join(F.broadcast(starts), "part").withColumn("slot", slot)
    return _in_files(slots, stride, in_shard), max(1, -(-n // in_shard))


def _strides(seq_len: int, width: int, shard_bytes: int) -> tuple[int, int]:
    """Bytes of a record and records of a shard."""
    stride = seq_len * width + len(ROW_END)
    return stride, max(1, shard_bytes // stride)


def _in_files(slots: DataFrame, stride: int, in_shard: int) -> DataFrame:
    """Sequences with a slot, and where they lie in the files."""
    return slots.select(
        "slot", F.floor(F.col("slot") / in_shard).cast("int").alias("shard"),
        ((F.col("slot") % in_shard) * stride).alias("offset"), "doc_ids", "n_tokens", "tokens")


def in_order(rows: DataFrame, shards: int) -> DataFrame:
    """Placed sequences range-partitioned by shard and in slot order.

    The sort names the shard first: a writer that deals files by shard asks for that order, and would else
    put its own sort by shard in the place of the one by slot.
    """
    return rows.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot")


def training_order(docs: DataFrame, path: str, **place_args) -> DataFrame:
    """The sequences of ``placed`` in slot order.

    NULL and empty texts have no tokens and appear in no sequence. Repeated rows and
    ids are all written. Other columns are ignored. An empty table gives no rows. A text of any
    length is spread over as many sequences as it needs.
    """
    return in_order(*placed(docs, path, **place_args))


# -- files ------------------------------------------------------------------

def write_shards(ordered: DataFrame, path: str, more: bool = False) -> None:
    """One folder per shard with one file of fixed-stride records: the ids, then one line-end byte.

    Record ``i`` of a file starts at ``i`` times the stride whatever the ids hold. Spark's writer commits
    whole tasks, so a lost executor leaves no half file. With ``more`` there may be other shards in ``path``.
    """
    ordered.select("shard", F.col("tokens").cast("string").alias("value")).write.mode(
        "append" if more else "error").partitionBy("shard").text(path, lineSep=ROW_END.decode())


def write_in_passes(rows: DataFrame, shards: int, path: str, passes: int = PASSES) -> None:
    """The shard files of placed sequences, some of the shards at a time.

    A pass shuffles the sequences of its shards only, and its shuffle files go when it ends, so the disk never holds
    all sequences in a shuffle beside their table and their files.
    """
    step = -(-shards // passes)
    rows = rows.select("slot", "shard", "tokens")
    for first in range(0, shards, step):
        some = rows.filter(F.col("shard").between(first, first + step - 1)) if step < shards else rows
        with shuffles_dropped(rows.sparkSession):
            write_shards(in_order(some, min(step, shards - first)), path, more=first > 0)


def shards_folder(spark: SparkSession) -> str:
    """Unused path in the shared folder. The files are a result, so they stay when the session ends."""
    return f"{shared_folder(spark).rstrip('/')}/tallymart-shards-{uuid.uuid4().hex}"


def written_order(docs: DataFrame, path: str, folder: str | None = None, sort_rows: bool = True, seq_len: int = SEQ_LEN,
                  shard_bytes: int = SHARD_BYTES, width: int = 2, **place_args) -> DataFrame:
    """The rows of ``placed`` with ``file``, the folder of the shard's one file; all files are written first, in slot order.

    A row's tokens are the bytes from ``offset`` on in that file. ``sort_rows`` gives the rows in slot order too: their
    tokens are then read from the files, and the packed table goes. Without it the rows are a catalogue of the files,
    read from the packed table in the order of packing. Odd texts and tables are as in ``training_order``. Without ``folder``
    the shards go to a new one in the shared folder.
    """
    spark = docs.sparkSession
    folder, place = folder or shards_folder(spark), scratch_table(spark, "sequences")
    rows, shards = placed(docs, path, seq_len=seq_len, shard_bytes=shard_bytes, width=width, place=place, **place_args)
    write_in_passes(rows, shards, folder)
    if sort_rows and not rows.isEmpty():
        notes = stored(rows.select("slot", "shard", "doc_ids", "n_tokens"), "notes")
        remove(spark, place)
        rows = _read_back(notes, folder, shards, seq_len, width, shard_bytes)
    return rows.withColumn("file", F.concat(F.lit(f"{folder}/shard="), F.col("shard").cast("string")))


def _read_back(notes: DataFrame, folder: str, shards: int, seq_len: int, width: int, shard_bytes: int) -> DataFrame:
    """Sequences in slot order, from their files and ``notes`` (slot, shard, doc_ids, n_tokens).

    Records meet their notes in the one shuffle that puts them in order, so the grouping asks for no other.
    """
    stride, in_shard = _strides(seq_len, width, shard_bytes)
    records = read_slots(notes.sparkSession, folder, seq_len, width, shard_bytes).withColumn(
        "shard", F.floor(F.col("slot") / in_shard).cast("int"))
    both = notes.unionByName(records, allowMissingColumns=True).repartitionByRange(shards, "shard")
    met = both.groupBy("shard", "slot").agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in ("doc_ids", "n_tokens", "tokens")))
    return _in_files(met, stride, in_shard).sortWithinPartitions("shard", "slot")


def read_slots(spark: SparkSession, path: str, seq_len: int = SEQ_LEN, width: int = 2,
               shard_bytes: int = SHARD_BYTES, first: int = 0) -> DataFrame:
    """(slot, tokens) from slot ``first`` on; shards before it are not opened."""
    stride, in_shard = _strides(seq_len, width, shard_bytes)
    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= first // in_shard)
    last = F.floor(F.length("content") / stride).cast("int") - 1
    return files.select("shard", "content", F.explode(F.sequence(F.lit(0), last)).alias("i")).select(
        (F.col("shard").cast("bigint") * in_shard + F.col("i")).alias("slot"),
        F.substring(F.col("content"), F.col("i") * stride + 1, F.lit(stride - len(ROW_END))).alias("tokens"),
    ).filter(F.col("slot") >= first)
