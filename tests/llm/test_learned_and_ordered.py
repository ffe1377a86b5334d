"""Language ID, mixing, token output and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import SF_DIR, no_docs, odd_docs  # noqa: F401
from tallymart.llm import language_id, mixing, token_output
from tallymart.llm import queries as Q
from tallymart.llm.common import table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents").cache()


# -- language ID ------------------------------------------------------------

def test_held_out_accuracy(spark, docs):
    real = {r.doc_id: r.lang for r in docs.collect()}
    got = Q.op8_language_id(spark, SF_DIR).collect()
    assert len(got) == len(real)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in real if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == real[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_texts_have_a_language(odd_docs, no_docs, docs):
    filters = language_id.learn(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    got = language_id.detect(odd_docs.withColumn("score", F.lit("old")), filters)
    assert got.columns == [*odd_docs.columns, "lang_pred", "score"]
    unknown = {(r.doc_id, r.text) for r in got.filter("lang_pred = 'und'").collect()}
    assert unknown == {(4, None), (5, ""), (8, "\n\n  \t\n"), (None, None), (9, "1234 5678 !?")}
    assert language_id.detect(no_docs, filters).count() == 0


def test_number_signs_are_no_letters(docs):
    filters = language_id.learn(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    assert [filters.predict(t)[0] for t in ("½ Ⅷ", "x² ½", "٣٤", "²")] == ["und", filters.predict("x² ½")[0], "und", "und"]
    assert filters.predict("x² ½")[0] != "und"


def test_nothing_and_many_languages(no_docs, spark):
    empty = language_id.learn(no_docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    assert empty.languages == [] and empty.predict("text") == ("und", 0.0)
    rows = [(i, f"q{chr(97 + i % 26)}{chr(97 + i // 26)}x " * 9, f"l{i:02}") for i in range(70)]
    many = language_id.learn(spark.createDataFrame(rows, "id int, text string, lang string"))
    assert many.masks.shape[0] == 2
    assert [many.predict(text)[0] for _, text, _ in rows] == [lang for _, _, lang in rows]


# -- mixing -----------------------------------------------------------------

def _fill(supply, weight, budget):
    """Shares of siblings by repeated rounds."""
    got = {k: 0.0 for k in supply}
    open_ = {k for k in supply if weight[k] > 0 and supply[k] > 0}
    while open_ and budget > 1e-9:
        unit = budget / sum(weight[k] for k in open_)
        dry = {k for k in open_ if supply[k] - got[k] <= unit * weight[k] + 1e-12}
        for k in dry or open_:
            more = min(supply[k] - got[k], unit * weight[k])
            got[k] += more
            budget -= more
        if not dry:
            break
        open_ -= dry
    return got


def test_budgets_go_to_siblings_before_ancestors(spark):
    tokens = {("a", "x", "1"): 100, ("a", "x", "2"): 5, ("a", "y", "1"): 300, ("b", "x", "1"): 10, ("b", "z", None): 40, (None, "x", "1"): 7}
    weights = {"a": 1.0, "b": 3.0, "a/x": 2.0, "b/z": 0.0}
    leaves = spark.createDataFrame([(*k, v) for k, v in tokens.items()], "d string, l string, s string, tokens bigint")
    for budget, epochs in ((100, 1), (300, 1), (5000, 2), (60, 2), (0, 1)):
        got = {(r.d, r.l, r.s): r.budget for r in mixing.allocate(leaves, ["d", "l", "s"], weights, budget, epochs).collect()}

        def split(prefix, total):
            kids = {k[len(prefix)] for k in tokens if k[:len(prefix)] == prefix}
            name = {c: "/".join(x for x in (*prefix, c) if x is not None) for c in kids}
            weight = {c: weights.get(name[c], 1.0) for c in kids}
            supply = {c: epochs * sum(v for k, v in tokens.items() if k[:len(prefix) + 1] == (*prefix, c)) for c in kids}
            return {(*prefix, c): v for c, v in _fill(supply, weight, total).items()}

        want = {k: v for d, n in split((), budget).items() for e, m in split(d, n).items() for k, v in split(e, m).items()}
        assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in want.items()}


def test_leaves_meet_their_budgets(docs):
    mixed = mixing.mix(docs, Q.tree_levels(), Q.TARGETS, epochs=3, share=0.7).cache()
    size = {r.doc_id: r.n for r in docs.select("doc_id", mixing.word_count(F.col("text")).alias("n")).collect()}
    leaves = mixing.mix(docs, Q.tree_levels(), {}, epochs=1).groupBy("domain", "language", "leaf").agg(F.sum("tokens").alias("tokens"))
    budgets = {(r.domain, r.language, r.leaf): r.budget for r in mixing.allocate(
        leaves, ["domain", "language", "leaf"], Q.TARGETS, 0.7 * sum(size.values()), 3).collect()}
    got, last = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        assert r.tokens == size[r.doc_id]
        key = (r.domain, r.language, r.leaf)
        got[key] += r.tokens
        last[key] = max(last[key], size[r.doc_id])
    for key, budget in budgets.items():
        assert budget - 1e-6 <= got[key] <= budget + last[key]
    times = Counter((r.doc_id, r.epoch) for r in mixed.collect())
    assert max(times.values()) == 1
    again = mixing.mix(docs.repartition(5), Q.tree_levels(), Q.TARGETS, epochs=3, share=0.7)
    assert Counter((r.doc_id, r.epoch) for r in again.collect()) == times


def test_mix_of_odd_rows(odd_docs, no_docs):
    levels = Q.tree_levels()
    every = mixing.mix(odd_docs, levels, {}, epochs=1)
    assert every.select(*odd_docs.drop("tokens").columns).count() == 13
    assert mixing.mix(odd_docs, levels, {}, epochs=2, share=2.0).filter("tokens > 0").count() == 2 * every.filter("tokens > 0").count()
    assert mixing.mix(no_docs, levels, Q.TARGETS).count() == 0


def test_op7_and_the_stage_spend_tokens_of_the_tokenizer(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(Q.tokenizer_path("byte_bpe_50k.json"))
    size = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False)) for r in docs.collect()}
    got = Q.op7_mixing(spark, SF_DIR).collect()
    assert got and all(r.tokens == size[r.doc_id] for r in got)
    stage = Q.mix_to_targets(spark, docs, SF_DIR)
    assert stage.columns == docs.columns
    assert Counter(r.doc_id for r in stage.collect()) == Counter(r.doc_id for r in got)


def test_columns_named_like_the_operators_own(odd_docs):
    clash = odd_docs.withColumns({c: F.lit("mine") for c in ("_whole", "_range", "_end", "_row", "_key", "row", "n", "tokens_")})
    got = mixing.mix(clash, Q.tree_levels(), {}, epochs=1)
    assert got.filter("_whole = 'mine' AND _row = 'mine' AND `row` = 'mine'").count() == 13


@pytest.fixture(scope="module")
def clashing(odd_docs):
    return odd_docs.withColumns({c: F.lit("mine") for c in (
        "_text", "_lang", "_score", "_judged", "_m1", "_m2", "_tokens", "_whole", "score", "lang_pred", "row", "n", "rid")})


def test_stages_pass_other_columns_and_empty_tables(spark, clashing, no_docs):
    import corpus_pipeline as P

    frame = clashing
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, frame, SF_DIR)
        assert out.dtypes == frame.dtypes
        rows = out.collect()
        assert rows and all(r["_text"] == r["_m1"] == r["_whole"] == r["row"] == r["score"] == "mine" for r in rows)
        assert stage(spark, no_docs, SF_DIR).collect() == []
    assert P.STAGES[-1][1](spark, clashing, SF_DIR).count() > 0


# -- token output -----------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_slots_are_a_permutation(n):
    slots = token_output.permute(np.arange(n), n, key=7)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 10 or (slots != np.arange(n)).any() and (slots != token_output.permute(np.arange(n), n, key=8)).any()


def _stream(rows, path):
    encode = token_output._encoder(path, 2)
    return {i: [int(x) for x in np.frombuffer(encode([t])[0], "<u2")] for i, t in rows if t}


@pytest.mark.parametrize("which", ["given", "odd"])
def test_round_trip(spark, docs, odd_docs, tmp_path, which):
    path, seq_len = Q.tokenizer_path("byte_bpe_50k.tiktoken"), 64
    frame = (docs if which == "given" else odd_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).select("doc_id", "text")
    ordered = token_output.training_order(frame, path, seq_len=seq_len, shard_bytes=129 * 50).cache()
    rows = ordered.orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.shard == r.slot // 50 and r.offset == r.slot % 50 * 129 and len(r.tokens) == 128 for r in rows)
    assert ordered.rdd.mapPartitions(lambda p: [[r.slot for r in p]]).filter(lambda s: s != sorted(s)).count() == 0
    # every text's ids, ended once, are found in the packed stream
    packed = token_output.pack(frame, path, seq_len).collect()
    ids = {}
    for r in sorted(packed, key=lambda r: (r.part, r.local)):
        ids.setdefault(r.part, []).extend(np.frombuffer(r.tokens, "<u2").tolist()[:r.n_tokens])
    parts = []
    for stream in ids.values():
        assert stream[-1] == token_output.END_ID
        part = []
        for x in stream:
            if x == token_output.END_ID:
                parts.append(tuple(part))
                part = []
            else:
                part.append(x)
    want = _stream([(r.doc_id, r.text) for r in frame.collect()], path)
    assert Counter(parts) == Counter(tuple(x) for x in want.values())
    assert {d for r in packed for d in r.doc_ids} == set(want)
    assert Counter(bytes(r.tokens) for r in rows) == Counter(bytes(r.tokens) for r in packed)
    # shard files
    token_output.write_shards(ordered, str(tmp_path / "shards"))
    for first in (0, 75):
        back = token_output.read_slots(spark, str(tmp_path / "shards"), seq_len, shard_bytes=129 * 50, first=first)
        assert {r.slot: bytes(r.tokens) for r in back.collect()} == {r.slot: bytes(r.tokens) for r in rows if r.slot >= first}


def test_shards_of_uncached_rows_are_in_slot_order(spark, docs, tmp_path):
    path, shard_bytes = Q.tokenizer_path("byte_bpe_50k.tiktoken"), 129 * 50
    rows = token_output.written_order(docs.select("doc_id", "text"), path, str(tmp_path / "shards"), seq_len=64, shard_bytes=shard_bytes).collect()
    want = {r.slot: bytes(r.tokens) for r in rows}
    back = token_output.read_slots(spark, str(tmp_path / "shards"), 64, shard_bytes=shard_bytes)
    assert {r.slot: bytes(r.tokens) for r in back.collect()} == want and len(want) > 500


def test_a_pass_works_slots_out_once(spark, docs):
    """A second evaluation below the filter by shard would hold a second Python worker in each running task."""
    rows, shards = token_output.placed(docs.select("doc_id", "text"), Q.tokenizer_path("byte_bpe_50k.tiktoken"), seq_len=64, shard_bytes=129 * 20)
    some = rows.select("slot", "shard", "tokens").filter(F.col("shard").between(1, 2))
    assert shards > 3 and {r["shard"] for r in some.select("shard").distinct().collect()} == {1, 2}
    assert some._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_rows_are_read_back_in_order_and_the_packed_table_goes(spark, docs, odd_docs, tmp_path):
    import os

    path, texts = Q.tokenizer_path("byte_bpe_50k.tiktoken"), docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    settings = {"seq_len": 64, "shard_bytes": 129 * 50}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    got = token_output.written_order(texts, path, str(tmp_path / "shards"), **settings)
    rows = got.collect()
    want = token_output.training_order(texts, path, **settings).collect()
    assert [tuple(r)[:-1] for r in rows] == [tuple(r) for r in want] and max(r.shard for r in rows) > 10
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert spark.conf.get(name) == before
    # each pass wrote its own shards, one file each, and no stored table holds the tokens a second time
    assert all(len(list((tmp_path / "shards" / f"shard={s}").glob("part-*"))) == 1 for s in {r.shard for r in rows})
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan
    assert not any("tokens" in spark.read.parquet(os.path.dirname(f)).columns for f in got.inputFiles() if f.endswith(".parquet"))


def test_whole_texts_are_encoded_as_by_the_library(spark):
    import base64

    import tiktoken

    path = Q.tokenizer_path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    library = tiktoken.Encoding("test", pat_str=token_output.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", " ", " a", "a ", "a  b", "it's  \n\n x", "\u3000a \u00a0b c\x1c d", "x" * 3000, "é \U0001f600 1234 , .."]
    encode = token_output._encoder(path, 2)
    assert [np.frombuffer(x, "<u2").tolist() for x in encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_op9_rows_are_in_the_files_they_name(spark):
    rows = Q.op9_token_output(spark, SF_DIR).collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    for file in {r.file for r in rows}:
        (held,) = (bytes(r.content) for r in spark.read.format("binaryFile").load(file).collect())
        for r in (r for r in rows if r.file == file):
            assert held[r.offset:r.offset + len(r.tokens)] == bytes(r.tokens)


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_ids_of_other_types(odd_docs, kind):
    from tallymart.llm import token_counts

    typed = odd_docs.withColumn("doc_id", F.col("doc_id").cast(kind))
    got = token_counts.count_tokens(typed, Q.tokenizer_path("byte_bpe_50k.json"))
    assert dict(got.dtypes)["doc_id"] == kind and got.count() == 13
    packed = token_output.pack(typed, Q.tokenizer_path("byte_bpe_50k.tiktoken"), 64)
    assert dict(packed.dtypes)["doc_ids"] == f"array<{kind}>" and packed.count() > 0


def test_output_of_nothing_and_of_repeats(odd_docs, no_docs):
    path = Q.tokenizer_path("byte_bpe_50k.tiktoken")
    assert token_output.training_order(no_docs, path).count() == 0
    got = token_output.pack(odd_docs, path, 32).collect()
    assert Counter(d for r in got for d in set(r.doc_ids))[None] > 0
    assert sum(t == token_output.END_ID for r in got for t in np.frombuffer(r.tokens, "<u2")[:r.n_tokens]) == 10


# -- pipeline ---------------------------------------------------------------

def test_pipeline_stages(spark, docs):
    import corpus_pipeline as P
    from test_exact import _groups, _print

    assert [name for name, _ in P.STAGES] == [
        "language ID", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
        "token-ID / binary output"]
    columns, at = docs.columns, {}
    frame = docs
    for name, stage in P.STAGES[:-1]:
        frame = stage(spark, frame, SF_DIR).cache()
        assert frame.columns == columns
        at[name] = frame.collect()
    known = {r.doc_id for r in at["language ID"]}
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert known == letters
    rows = [r for r in docs.collect() if r.doc_id in known]
    firsts = {c for _, _, c in _groups([(r.doc_id, _print(r.text)) for r in rows])}
    assert sorted(r.doc_id for r in at["SimHash near-dedup"]) == sorted(firsts)

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    items = [shingles(r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    leaks = {r.doc_id for r in rows if any(len(i & shingles(r.text)) >= 0.8 * len(i) for i in items)}
    assert {r.doc_id for r in at["benchmark decontamination"]} == firsts - leaks and leaks
    times = Counter(r.doc_id for r in at["mixing sources to target weights"])
    assert set(times) <= firsts - leaks and max(times.values()) <= Q.EPOCHS
    got = P.run(spark, SF_DIR)
    assert Counter(got.select("slot").toPandas()["slot"]) == Counter(range(got.count()))
    assert {d for r in got.select("doc_ids").collect() for d in r.doc_ids} == set(times)
