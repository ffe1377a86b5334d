"""Substring dedup: passages that repeat across documents, found level by level.

A window of ``window`` words can only repeat where each shorter run inside it repeats.
So the first level looks at runs of about half the words, the last at whole
windows, and each level keeps only windows whose run at the level before repeats;
the search ends when none is left. Levels below the last compare, for each window,
its run with the smallest hash: equal windows choose equal runs, so nothing is
missed, and neighbouring windows mostly share one, so few rows are shuffled.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import by_row, stored

WINDOW = 50
NO_ID = (1 << 63) - 1  # a NULL id counts as larger than every other
CACHED_WORDS = 400_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two rolling hashes
_WORD = 1 << 64


def level_lengths(window: int) -> list[int]:
    """Run lengths of the levels: half the window, then the window, its double or one less."""
    if window < 2:
        raise ValueError("a window has at least two words")
    return [(window + 1) // 2, window]


class WordHashes(dict):
    """XXH64 of words; the first ``CACHED_WORDS`` seen by a task are remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


class Rolling:
    """Hashes of all runs of a length, from sums of word hash times power, modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, _WORD)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def runs(self, hashes: np.ndarray, length: int) -> np.ndarray:
        n = len(hashes)
        self._grow(n + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * self.up[:n], dtype=np.uint64)))
        raw = (sums[length:] - sums[:-length]) * self.down[:n - length + 1]
        return (raw ^ (raw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)  # spread, as low bits are weak


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


class Windows:
    """Per-task state: hashes words once and gives each window's key at a level."""

    def __init__(self, window: int):
        self.window, self.cache, self.rolling = window, WordHashes(), [Rolling(b) for b in _BASES]

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.cache.__getitem__, words), np.uint64, len(words))

    def keys(self, hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Signed key of every window: its smallest run hash, or its own when ``length`` is the window."""
        runs = self.rolling[which].runs(hashes, length)
        return sliding_min(runs, self.window - length + 1).view(np.int64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes.split: ASCII white space, the set of the word pattern


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh128_digest(b" ".join(words))


def _scan(docs: DataFrame, window: int, length: int) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()),
                        ("sha", pa.string()), ("keys", pa.list_(pa.int64()))])

    def make():
        state = Windows(window)

        def work(rows):
            out = []
            for doc, text in rows:
                words = _words(text)
                flat = b" ".join(words)
                keys = np.unique(state.keys(state.hashes(words), length)) if len(words) >= window else []
                out.append((doc, xxhash.xxh128_digest(flat), len(words), hashlib.sha256(flat).hexdigest(), keys))
            return out

        return work

    return docs.mapInArrow(
        by_row(make, schema), "id bigint, digest binary, n_words bigint, sha string, keys array<bigint>")


def _shared(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur under at least two ids, with the smallest of them."""
    return flat.groupBy(*keys).agg(F.min("owner").alias("first"), F.max("owner").alias("last")).filter(
        "first < last").drop("last")


def _surviving(texts: DataFrame) -> DataFrame:
    """(rid, alive): the keys of each text that other ids share."""
    flat = texts.select("rid", "owner", F.explode("keys").alias("key"))
    return flat.join(_shared(flat, ["key"]).drop("first"), "key").groupBy("rid").agg(
        F.collect_list("key").alias("alive"))


def _windows(texts: DataFrame, window: int, before: int, length: int) -> DataFrame:
    """The next level's keys of windows whose run at the level before is alive."""
    whole = length == window
    fields = [("rid", pa.int64()), ("owner", pa.int64()), ("text", pa.string())]
    fields += [(n, pa.list_(pa.int64())) for n in (("at", "key", "key2") if whole else ("keys",))]

    def make():
        state = Windows(window)

        def work(rows):
            out = []
            for rid, owner, digest, alive, text in rows:
                words = _words(text)
                if _digest(words) != digest:  # another row under the same id
                    continue
                hashes = state.hashes(words)
                at = np.flatnonzero(np.isin(state.keys(hashes, before), np.array(alive, np.int64)))
                found = state.keys(hashes, length)[at]
                more = (at, found, state.keys(hashes, length, 1)[at]) if whole else (np.unique(found),)
                out.append((rid, owner, text, *more))
            return out

        return work

    names = {"at": "array<bigint>", "key": "array<bigint>", "key2": "array<bigint>", "keys": "array<bigint>"}
    shape = "rid bigint, owner bigint, text string, " + ", ".join(f"{n} {names[n]}" for n, _ in fields[3:])
    return texts.mapInArrow(by_row(make, pa.schema(fields)), shape)


def _kept(texts: DataFrame, window: int) -> DataFrame:
    """(rid, removed, kept_text, kept_sha) from the starts of the windows to remove."""
    schema = pa.schema([("rid", pa.int64()), ("removed", pa.int64()), ("kept_text", pa.string()),
                        ("kept_sha", pa.string())])

    def make():
        def work(rows):
            out = []
            for rid, text, gone in rows:
                words = _words(text)
                edge = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(np.array(gone, np.int64))
                edge[starts] += 1
                np.add.at(edge, np.minimum(starts + window, len(words)), -1)
                covered = np.cumsum(edge[:-1]) > 0
                kept = b" ".join([w for w, c in zip(words, covered.tolist()) if not c])
                out.append((rid, int(covered.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
            return out

        return work

    return texts.mapInArrow(by_row(make, schema), "rid bigint, removed bigint, kept_text string, kept_sha string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   texts: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) and, with ``texts``, kept_text, for every row.

    A word goes when a window of ``window`` consecutive words covers it whose word
    sequence also starts in a row with a smaller id. Windows are judged on the input.
    Words are runs of anything but ASCII white space; kept words are joined by a space.

    Equal texts are folded first: all but those with the smallest id lose every word if they
    have a whole window, and only one stands for them in the search. So the search
    never sees a group of copies, and a frequent passage is one map-side combined key.

    NULL and empty texts have no words; texts shorter than a window lose none. A NULL
    id counts as larger than all others. Rows with the same id are not compared with
    each other; each row gives a result. Other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    lengths = level_lengths(window)
    place = F.coalesce("id", F.lit(NO_ID))
    scanned = stored(
        _scan(rows, window, lengths[0]).select(F.monotonically_increasing_id().alias("rid"), "*", place.alias("place")),
        "scanned")
    owners = scanned.groupBy("digest").agg(F.min(F.struct("place", "rid")).alias("first")).select(
        "digest", F.col("first.place").alias("owner"), F.col("first.rid").alias("owner_rid"))

    # the first level needs no text, only the keys found while scanning
    standing = owners.select(F.col("owner_rid").alias("rid"), "owner")
    alive = stored(_surviving(
        scanned.filter(F.size("keys") > 0).select("rid", "keys").join(standing, "rid")), "alive")
    found = None
    if not alive.isEmpty():
        named = alive.join(scanned.select("rid", "digest", F.col("place").alias("owner")), "rid")
        texts_of = rows.select(place.alias("owner"), "text").join(named, "owner").select(
            "rid", "owner", "digest", "alive", "text")
        found = stored(_windows(texts_of, window, lengths[0], lengths[-1]), "windows")
    changed = None
    if found is not None:
        flat = found.select("rid", "owner", F.explode(F.arrays_zip("at", "key", "key2")).alias("w")).select(
            "rid", "owner", "w.at", "w.key", "w.key2")
        gone = flat.join(_shared(flat, ["key", "key2"]), ["key", "key2"]).filter("first < owner").groupBy("rid").agg(
            F.collect_set("at").alias("gone"))
        changed = _kept(found.select("rid", "text").dropDuplicates(["rid"]).join(gone, "rid").select(
            "rid", "text", "gone"), window)
        changed = changed if texts else changed.drop("kept_text")

    held = scanned.drop("keys").join(owners, "digest").withColumns({
        "copy": (F.col("place") > F.col("owner")) & (F.col("n_words") >= window),
        "key": F.when(F.col("place") > F.col("owner"), F.col("rid")).otherwise(F.col("owner_rid"))})
    if changed is None:
        held = held.withColumns({"removed": F.lit(None).cast("bigint"), "kept_sha": F.lit(None).cast("string")})
        held = held.withColumn("kept_text", F.lit(None).cast("string")) if texts else held
    else:
        held = held.join(changed.withColumnRenamed("rid", "key"), "key", "left")
    out = [F.col("id").alias(id_col), F.col("n_words"),
           F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
           F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256")]
    if not texts:
        return held.select(*out)
    # texts that lost nothing are read again, by row: equal digests have equal words
    whole = rows.select("id", "text").join(held.filter("NOT copy AND removed IS NULL").select(
        F.col("id"), "sha").distinct(), "id").select(
        F.array_join(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), " ")
        .alias("own_text"))
    own = whole.select(F.sha2("own_text", 256).alias("own_sha"), "own_text").dropDuplicates(["own_sha"])
    return held.join(own, F.col("sha") == F.col("own_sha"), "left").select(
        *out, F.when(F.col("copy"), "").otherwise(F.coalesce("kept_text", "own_text", F.lit(""))).alias("kept_text"))
