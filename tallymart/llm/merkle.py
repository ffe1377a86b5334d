"""Document fingerprints: a Merkle tree over paragraphs and sections, made of Spark expressions only.

A text is cut into sections at empty lines, sections into paragraphs at line ends.
A paragraph's digest is the SHA-256 of its text, a section's that of its
paragraphs' digests, the root's that of its sections'. Both cuts can be undone, so
equal roots mean equal texts.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

SECTION_END, PARAGRAPH_END = "\n\n", "\n"
PHRASE = r"[^\x20\x09-\x0D]+(?:[\x20\x09]+[^\x20\x09-\x0D]+){0,3}"  # up to four words of one line
NO_ID = -(1 << 63)  # where a NULL id stands in the order
GROUP_BITS = 10     # 1,024 neighbouring ids are ordered together


def _cut(text: Column, end: str) -> Column:
    return F.split(text, end, -1)


def sections(text: Column) -> Column:
    """array<struct<digest, paragraphs array<digest>>>."""
    leaves = F.transform(_cut(text, SECTION_END), lambda s: F.transform(
        _cut(s, PARAGRAPH_END), lambda p: F.sha2(p, 256)))
    return F.transform(leaves, lambda ps: F.struct(
        F.sha2(F.array_join(ps, ","), 256).alias("digest"), ps.alias("paragraphs")))


def root(tree: Column) -> Column:
    return F.sha2(F.array_join(F.transform(tree, lambda s: s["digest"]), ","), 256)


def fingerprint(text: Column) -> Column:
    """64 lower-case hex digits: the root of the text's tree."""
    return root(sections(text))


def phrases(text: Column) -> Column:
    """Different 32-bit digests of the runs of up to four words below the paragraphs."""
    return F.array_distinct(F.transform(
        F.regexp_extract_all(text, F.lit(PHRASE), F.lit(0)), lambda p: F.hash(p)))


def likeness(own: Column, other: Column, own_root: Column, other_root: Column) -> Column:
    """1 for equal roots, else twice the shared phrases over all phrases; 0 when there is none."""
    total = F.size(own) + F.size(other)
    return F.when(own_root == other_root, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(
        2.0 * F.size(F.array_intersect(own, other)) / total)


def differing(left: Column, right: Column) -> Column:
    """Branches that differ: array<struct<section, paragraph>>, from 0, empty for equal trees.

    Sections with equal digests are passed over whole. A section or paragraph that
    only one side has differs too.
    """
    def pick(items: Column, i: Column) -> Column:
        return F.get(items, i)

    def span(a: Column, b: Column) -> Column:
        n = F.greatest(F.size(a), F.size(b))
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def within(i: Column) -> Column:
        none = F.array().cast("array<string>")
        a = F.coalesce(pick(left, i)["paragraphs"], none)
        b = F.coalesce(pick(right, i)["paragraphs"], none)
        unlike = F.filter(span(a, b), lambda j: ~pick(a, j).eqNullSafe(pick(b, j)))
        return F.transform(unlike, lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    other = F.filter(span(left, right), lambda i: ~pick(left, i)["digest"].eqNullSafe(pick(right, i)["digest"]))
    return F.flatten(F.transform(other, within))


def merkle(docs: DataFrame, text_col: str = "text", tree: str = "tree", name: str = "fingerprint") -> DataFrame:
    """``docs`` with its tree and root; a NULL text counts as empty; columns of these names are replaced."""
    return docs.withColumn(tree, sections(F.coalesce(text_col, F.lit("")))).withColumn(name, root(F.col(tree)))


def _below(ids: DataFrame, low: int, high: int, bits: int = 0) -> DataFrame:
    """(id, next): the largest id below each, NULL for the smallest.

    ``ids`` has (id, top), sorted alike. Ids are ordered in groups of neighbours; the last of a
    group gets the top of the group below it, found the same way one level up. So no
    window holds more than 1,024 rows.
    """
    if (high >> bits) - (low >> bits) < 1 << GROUP_BITS:
        return ids.select("id", F.lead("top").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("id"))).alias("next"))
    group = F.shiftright("id", GROUP_BITS)
    inside = ids.select("id", "top", group.alias("grp")).withColumn(
        "inside", F.lead("top").over(Window.partitionBy("grp").orderBy(F.desc("id"))))
    tops = ids.groupBy(group.alias("id")).agg(F.max("top").alias("top"))
    above = _below(tops, low, high, bits + GROUP_BITS).select(F.col("id").alias("grp"), F.col("next").alias("outside"))
    return inside.join(above, "grp").select("id", F.coalesce("inside", "outside").alias("next"))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited text, and how alike they are.

    The edited text has its last floor(n_chars/2) code points replaced by the first as many (or all)
    of the next document in descending id order; the first follows the last. Gives the id,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` and ``edits``, the branches in which the edited text differs.

    Only ids and lengths are ordered. Texts are shuffled once by id; their heads, cut to
    what the neighbour needs, once more.

    A NULL text counts as empty. A NULL id stands below all others. Rows that share an id
    share a place: each gets a result, and the smallest text is the one their neighbour sees. A single
    document is its own next. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.coalesce(text_col, F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    ids = rows.groupBy("id").agg(F.max(half).alias("need"))
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    if low is None:
        low = high = 0
    order = _below(ids.select("id", F.col("id").alias("top")), low, high).select(
        "id", F.coalesce("next", F.lit(high)).alias("next"))
    asked = order.join(ids, "id").select(F.col("next").alias("id"), F.col("id").alias("before"), "need")

    placed = rows.join(asked, "id")
    # ``doc`` goes along so that both uses of ``placed`` need the same columns and share one shuffle of the texts
    heads = placed.select(
        F.col("before").alias("id"),
        F.struct(F.left("text", F.col("need")).alias("head"), phrases(F.col("text")).alias("phrases"),
                 fingerprint(F.col("text")).alias("print"), "doc").alias("next")
    ).groupBy("id").agg(F.min("next").alias("next"))
    both = placed.select("id", "doc", "text").join(heads, "id").select(
        "doc", "text", F.length("text").alias("n_chars"), "next",
        F.concat(F.expr("left(text, cast(length(text) - floor(length(text) / 2) as int))"),
                 F.expr("left(next.head, cast(floor(length(text) / 2) as int))")).alias("edited"))
    treed = both.select(
        "doc", "n_chars", "edited", "next", sections(F.col("text")).alias("tree"), phrases(F.col("text")).alias("own"),
        sections(F.col("edited")).alias("edited_tree"), phrases(F.col("edited")).alias("other"))
    return treed.select(
        F.col("doc").alias(id_col), F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), root(F.col("tree")).alias("fingerprint"),
        root(F.col("edited_tree")).alias("edited_fingerprint"), "own", "other", "next",
        differing(F.col("tree"), F.col("edited_tree")).alias("edits"),
    ).select(
        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("own"), F.col("other"), F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("own"), F.col("next.phrases"), F.col("fingerprint"), F.col("next.print")).alias("near_next"),
        "edits")
