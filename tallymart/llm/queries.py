"""The registered queries of the corpus operators and the SQL that three of them are checked against."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, language_id, line_dedup, merkle, mixing, phrases, prefix_trie, simhash
from . import substring_dedup, token_counts, token_output, toxicity, url_filter
from .common import stored, table

URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
CRAWLED = ["src0"]  # sources of the crawl domain; all others are curated
TARGETS = {
    "crawl": 1.0, "curated": 2.0,
    "crawl/en": 5.0, "crawl/fr": 2.0, "crawl/de": 2.0, "crawl/es": 1.5,
    "curated/en": 5.0, "curated/fr": 2.0, "curated/de": 2.0, "curated/es": 1.5,
}
EPOCHS = 2


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tree_levels() -> dict:
    """Domain, language and source of a row of ``documents``."""
    return {
        "domain": F.when(F.col("source").isin(CRAWLED), "crawl").otherwise("curated"),
        "language": F.col("lang"), "leaf": F.col("source")}


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.with_edits(table(spark, folder, "documents")).drop("edits")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_members(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "line_no", "line_sha256", "copies", "class_lines", "distance", "class_sha256",
        F.col("class_first_id").alias("class_first_doc_id"), "keep")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def _mixed(counted: DataFrame, **settings) -> DataFrame:
    """``counted`` mixed to the target weights, measured in the tokens that the corpus is written in. It is stored, as mixing reads it four times."""
    return mixing.mix(stored(counted, "counted"), tree_levels(), TARGETS, epochs=EPOCHS, **settings)


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    counted = token_counts.with_counts(docs, tokenizer_path("byte_bpe_50k.json"), "n").select(
        "doc_id", "lang", "source", "n", F.xxhash64("text").alias("text_hash"))  # no text is stored or moved
    return _mixed(counted, tokens=F.col("n"), text_hash=F.col("text_hash")).select(
        "doc_id", "domain", "language", "leaf", "tokens", "epoch")


def _learned(docs: DataFrame) -> language_id.Filters:
    return language_id.learn(docs.filter(~language_id.held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("id"), "text", "lang"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language_id.detect(docs.select("doc_id", "text"), _learned(docs)).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_output.written_order(
        table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "item_id", "containment")


def _branched(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences and conversations of op11: up to five turns of every hundredth conversation start the ones after it."""
    places = prefix_trie.ordered(turns)
    sizes = places.groupBy("conv_id").agg(F.max("pos").alias("size"))
    base = F.col("conv_id") - F.col("conv_id") % 100
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    starts = sizes.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = sizes.select("conv_id", base.alias("base"), taken.alias("taken")).join(starts, "base", "left").select(
        "conv_id", "base", "taken", F.least("taken", F.coalesce("base_size", F.lit(0))).alias("shared"))
    head = places.filter("conv_id % 100 = 0 AND pos <= 5").withColumnRenamed("conv_id", "base")
    first = convs.join(head, "base").filter("pos <= shared").select("conv_id", "pos", "turn")
    rest = places.join(convs, "conv_id").filter("pos > taken").select(
        "conv_id", (F.col("pos") - F.col("taken") + F.col("shared")).alias("pos"), "turn")
    return first.unionAll(rest), convs.select("conv_id")


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(*_branched(table(spark, folder, "conversations")))


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    open_rows = docs.filter(~toxicity.held_out(F.col("doc_id")))
    scorer = toxicity.learn(toxicity.training_rows(open_rows, table(spark, folder, "labels").filter(
        ~toxicity.held_out(F.col("doc_id")))))
    return toxicity.score(docs, scorer).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("text", "lang"))


# -- pipeline stages: (spark, docs, folder) -> documents -------------------------

LEAST_SHARE = 1.2  # of the share that an even split among the languages gives


def _carried(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as one column, ``row``, beside its text, so that no stage meets the rows' own names."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))


def keep_known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows whose language is known; letterless texts (NULL and empty ones too) and those of no clear language go.

    Repeated rows stay repeated, other columns pass whatever their names, an empty table stays empty. Without any labelled
    row no language is known and all rows go.
    """
    filters = _learned(docs)
    least = LEAST_SHARE / max(1, len(filters.languages))
    judged = language_id.detect(_carried(docs), filters, "text", "lang", "score")
    return judged.filter((F.col("lang") != language_id.UNKNOWN) & (F.col("score") >= min(least, 1.0))).select("row.*")


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each SimHash group of op3; most copies of Jaccard similarity 0.8 or more stay, see README and ``shingle_sets``."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that hold no benchmark item. NULL and empty texts hold none, repeated rows stay, other columns pass, an empty table stays empty."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows at the target weights; a row comes once for every epoch in which it is taken.

    NULL languages and sources are leaves of their own; rows without tokens (NULL and empty texts) come with each epoch of
    their leaf; repeated rows are rows of their own; other columns pass whatever their names; an empty table stays empty.
    """
    counted = token_counts.with_counts(_carried(docs), tokenizer_path("byte_bpe_50k.json"), "n").select("row", "n")
    flat = counted.select("row", "n", "row.doc_id", "row.lang", "row.source", F.xxhash64("row.text").alias("text_hash"))
    return _mixed(flat, tokens=F.col("n"), text_hash=F.col("text_hash")).select("row.*")


def order_for_training(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token sequences in their slots, and the shard files that hold them in slot order; the rows list what is in the files, in any order.

    NULL and empty texts are in no sequence, repeated rows are all written, other columns are ignored, an empty table gives no rows.
    """
    return token_output.written_order(docs, tokenizer_path("byte_bpe_50k.tiktoken"), sort_rows=False)


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_substring_dedup, op3_simhash, op4_fingerprints, op5_line_dedup, op6_token_counts,
    op7_mixing, op8_language_id, op9_token_output, op10_decontamination, op11_conversation_trie,
    op12_toxicity, op13_phrases)}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLE = {
    "op1_url_filters": rf"""
WITH p AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
fits AS (
  SELECT n, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (n)""",
    "op2_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT n, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50),
h AS (SELECT n, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM w),
f AS (SELECT k, min(doc_id) AS first FROM h GROUP BY k),
gone AS (SELECT DISTINCT n, p FROM (
  SELECT n, unnest(range(i, i + 50)) AS p FROM h JOIN f USING (k) WHERE first < doc_id)),
words AS (SELECT n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (n, p) GROUP BY n)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(g.c, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT n, count(*) AS c FROM gone GROUP BY n) g USING (n) LEFT JOIN kept USING (n)""",
    "op10_decontamination": r"""
WITH d AS (SELECT doc_id, text, list_filter(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
ds AS (SELECT DISTINCT doc_id, text, array_to_string(ws[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM d)),
bs AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM b)),
n AS (SELECT item_id, count(*) AS size FROM bs GROUP BY item_id),
c AS (SELECT doc_id, text, item_id, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, shared / size AS containment FROM c JOIN n USING (item_id) WHERE shared / size >= 0.8 - 1e-9""",
    "op11_conversation_trie": r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                                  lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
s AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = base AND pos <= h
  UNION ALL
  SELECT c.conv_id, pos - h + least(h, (SELECT count(*) FROM t b WHERE b.conv_id = base)), role, text
  FROM c JOIN t USING (conv_id) WHERE pos > h),
path AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS chars FROM c
  UNION ALL
  SELECT conv_id, pos, string_agg(sha256(length(role)::VARCHAR || ':' || role || text), '/') OVER (
    PARTITION BY conv_id ORDER BY pos), length(text) FROM s),
p AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends,
             lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM path),
n AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY depth, node),
k AS (SELECT n.*, count(m.node) AS n_children FROM n LEFT JOIN n m ON m.depth = n.depth + 1 AND m.parent = n.node
      GROUP BY ALL),
below AS (
  SELECT p.depth, p.node, sum((k.n_convs - 1) * k.chars) AS saved_tokens, count_if(k.n_children = 0) AS n_leaves
  FROM k JOIN p ON p.conv_id = k.conv_id AND p.depth <= k.depth GROUP BY ALL)
SELECT k.conv_id, k.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, k.n_convs::BIGINT AS n_convs,
       k.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM k JOIN below USING (depth, node) LEFT JOIN n up ON up.depth = k.depth - 1 AND up.node = k.parent""",
    "op13_phrases": r"""
WITH p AS (
  SELECT row_number() OVER () AS piece_no, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang),
runs AS (SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM (
  SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS size)
  WHERE len(ws) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS c FROM runs GROUP BY ALL HAVING count(*) >= 100),
w AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
cut AS (SELECT lang, phrase, c, ws, unnest(range(1, size)) AS k, size FROM w),
scored AS (
  SELECT cut.lang, cut.phrase, cut.c AS a, x.c AS l, y.c AS r, total.n, k,
         (1000::HUGEINT * cut.c * total.n) // (x.c::HUGEINT * y.c) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[k + 1:cut.size], ' ') JOIN total ON total.lang = cut.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(c) AS held FROM (
  SELECT lang, ws, c, m, unnest(range(1, size - m + 2)) AS i FROM (
    SELECT *, unnest(range(2, size)) AS m FROM w WHERE size > 2)) GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase) WHERE held IS NULL OR 100 * held < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000""",
}
