"""Token counts by a two-tier lookup: a broadcast table of frequent pre-tokens, then a memo in each task."""

import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SLICE
from .units import LONGEST_KEYED, Lengths, fingerprint, spans_of

TABLE_UNITS = 65_536   # entries of the broadcast table: about 1.1 MB
SAMPLE_ROWS = 4_000    # expected number of rows whose units fill the table; it only saves work and never changes a count
MEMO_UNITS = 600_000  # about 90 MB in a task
LIMIT = 512
SPACE_SIGN = "\u0120"  # fixed value: how byte-level vocabularies write a space


def check_pattern(path: str) -> None:
    """Refuse a tokenizer whose texts cannot be cut at single spaces."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        raise ValueError(f"{path} is no byte-level BPE with the usual pattern and no prefix space")
    if any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} has added tokens that take in spaces")


def _counter(path: str):
    """Function from units to their token counts.

    Units of one leading space and no other white space are encoded in one go, one after the other, as no pre-token
    crosses from one to the next. A token that starts with a space then starts a unit.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    vocabulary = tokenizer.get_vocab()
    leads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    leads[[i for token, i in vocabulary.items() if token.startswith(SPACE_SIGN)]] = True

    def each(units: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)] if units else []

    def count(units: list[str]) -> list[int]:
        plain = [u[:1] == " " and u.split() == [u[1:]] for u in units]
        (whole,) = tokenizer.encode_batch_fast(["".join(u for u, p in zip(units, plain) if p)], add_special_tokens=False)
        ids = np.array(whole.ids, np.int64)
        sizes = np.diff(np.append(np.flatnonzero(leads[ids]), len(ids))).tolist()
        if len(sizes) != sum(plain):  # a tokenizer with other tokens for spaces
            return each(units)
        one, many = iter(each([u for u, p in zip(units, plain) if not p])), iter(sizes)
        return [next(many) if p else next(one) for p in plain]

    return count


def frequent_units(texts: DataFrame, path: str, rows: int = SAMPLE_ROWS, most: int = TABLE_UNITS) -> dict[int, int]:
    """Compact hash table, fingerprint to length, of the ``most`` frequent units in about ``rows`` texts drawn from all.

    Units are counted in each task, then summed; only the most frequent come to the driver, none of more than 64 signs.
    """

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                held = [t or "" for t in batch.column(0).slice(start, SLICE).to_pylist()]
                joined = "".join(held)
                _, first, last, _, _ = spans_of(joined, np.array([len(t) for t in held], np.int64))
                seen.update(joined[a:b] for a, b in zip(first.tolist(), last.tolist()) if b - a <= LONGEST_KEYED)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["unit", "n"])

    share = min(1.0, rows / max(1, texts.count()))
    got = texts.filter(F.rand(11) < share).mapInArrow(run, "unit string, n bigint").groupBy("unit").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(most).select("unit").toPandas()
    units = got["unit"].tolist()
    return dict(zip(map(fingerprint, units), _counter(path)(units) if units else []))


def with_counts(docs: DataFrame, path: str, name: str = "tokens", text_col: str = "text",
                memo_units: int = MEMO_UNITS) -> DataFrame:
    """``docs`` with each row's token count, as ``count_tokens`` counts; a column of that name is replaced, no row is moved."""
    check_pattern(path)
    table = docs.sparkSession.sparkContext.broadcast(frequent_units(docs.select(text_col), path))

    @F.pandas_udf("bigint")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = Lengths(_counter(path), table.value, memo_units)
        for texts in parts:
            out = [lengths.of(texts.iloc[start:start + SLICE].tolist()) for start in range(0, len(texts), SLICE)]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0, np.int64))

    return docs.withColumn(name, counted(F.col(text_col)))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text",
                 memo_units: int = MEMO_UNITS) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``path`` names a tokenizer file on every machine.

    Counts are those of the tokenizer without begin, end or added tokens, padding or
    truncation; special strings in a text count as it treats them by default. Rows are
    never shuffled and pre-tokens never leave their task.

    Ids of any type pass unchanged. A NULL or empty text has no bytes and no tokens. Repeated rows each give a row;
    other columns are ignored; an empty table gives no rows.
    """
    check_pattern(path)
    table = docs.sparkSession.sparkContext.broadcast(frequent_units(docs.select(text_col), path))

    @F.pandas_udf("n_bytes bigint, n_tokens bigint")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lengths = Lengths(_counter(path), table.value, memo_units)
        for texts in parts:
            held = texts.tolist()
            out = [lengths.of(held[start:start + SLICE]) for start in range(0, len(held), SLICE)]
            yield pd.DataFrame({"n_bytes": [len((t or "").encode()) for t in held],
                                "n_tokens": np.concatenate(out) if out else np.zeros(0, np.int64)}, dtype="int64")

    return docs.select(id_col, counted(F.col(text_col)).alias("_c")).select(
        id_col, "_c.n_bytes", "_c.n_tokens", (F.col("_c.n_tokens") > limit).alias("over_limit"))
