"""Line dedup: lines within a small edit distance, by a segment-partition join of Spark expressions only.

A line is cut into one segment more than the edits it may be away. A line within so many
single-character edits of it holds at least one segment unchanged, not far from its place. So lines are
indexed by (length, segment number, segment) and probed with those substrings of
other lines whose place and length allow it. Candidates are verified by a banded
bit-parallel edit distance.

The lines of a key first meet one of them only, the pivot. What is then one class is not compared any
more; lines of different classes that share a key are, so no two lines within reach end in different classes.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .common import components, stored

EDITS = 2
LIMITS = (5, 10)          # a pair whose shorter line has under 5 characters must be equal, under 10 it may be one edit apart
LETTERS = "etaoinshrdlucmfwypgb"  # counted for the bound on edits
SIGNS = 62                # bits that tell which pairs of neighbouring characters occur an odd number of times
BROADCAST_LINES = 200_000  # at most so many 8-byte line ids are sent to every executor


def permitted(chars: Column, edits: int = EDITS, limits: tuple[int, int] = LIMITS) -> Column:
    """Edits that a pair may be apart whose shorter line has ``chars`` characters."""
    return F.when(chars < limits[0], 0).when(chars < limits[1], min(1, edits)).otherwise(edits)


def _segment(length: Column, i: Column, parts: Column) -> tuple[Column, Column]:
    """0-based start and length of segment ``i`` (from 0): short ones first, none differing by more than 1."""
    base, longer = F.floor(length / parts).cast("int"), length % parts
    extra = F.greatest(F.lit(0), i - (parts - longer))
    return base * i + extra, base + F.when(i >= parts - longer, 1).otherwise(0)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once; plain reuse would repeat it wherever it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _common_prefix(a: Column, b: Column) -> Column:
    """Number of equal leading characters, found by steps that halve."""
    fits = F.least(F.length(a), F.length(b))

    def grow(known: Column, step: Column) -> Column:
        same = F.substring(a, known + 1, step) == F.substring(b, known + 1, step)
        return F.when((known + step <= fits) & same, known + step).otherwise(known)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(29, -1, -1)]), F.lit(0), grow)


def _without_ends(a: Column, b: Column, body) -> Column:
    """``body`` of both texts without their common start and then end, turned round."""
    def cut(text: Column, n: Column) -> Column:
        return F.substring(text, n + 1, F.length(text))

    def tail(pair: Column) -> Column:
        return _let(_common_prefix(pair["a"], pair["b"]), lambda n: _let(
            F.struct(cut(pair["a"], n).alias("a"), cut(pair["b"], n).alias("b")), body))

    return _let(_common_prefix(a, b), lambda n: _let(
        F.struct(F.reverse(cut(a, n)).alias("a"), F.reverse(cut(b, n)).alias("b")), tail))


def _banded(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of ``a`` and ``b`` (lengths at most ``edits`` apart), exact up to ``edits``.

    A column of the table is kept as the vertical steps inside a band of 2 ``edits`` + 1
    rows, one bit each: bit ``edits`` is the diagonal, and the band moves down a row with each
    sign of ``b``. The distance is followed along the band's last row, then along the last row of ``a``.
    """
    width = 2 * edits + 1
    m = F.length(a)

    def big(value: int) -> Column:
        return F.lit(value).cast("bigint")

    full = big((1 << width) - 1)

    def matches(j: Column) -> Column:
        found = big(0)
        for bit in range(width):
            row = j + (bit - edits)
            same = (row >= 1) & (F.substring(a, F.greatest(row, F.lit(1)), F.lit(1)) == F.substring(b, j, F.lit(1)))
            found = found + F.when(same, big(1 << bit)).otherwise(big(0))
        return found

    def no_step(state: Column, match: Column) -> Column:
        """Rows whose value equals the one diagonally above."""
        up = state["up"]
        carried = (match.bitwiseAND(up) + up).bitwiseXOR(up)
        return carried.bitwiseOR(match).bitwiseOR(state["down"]).bitwiseAND(full)

    def move(state: Column, j: Column, flat: Column) -> Column:
        right = state["down"].bitwiseOR(flat.bitwiseOR(state["up"]).bitwiseXOR(full))
        left = flat.bitwiseAND(state["up"])
        last = F.greatest(m - j + edits, F.lit(0))  # bit of the last row of a, once the band has passed it

        def bit_of(bits: Column) -> Column:
            return F.call_function("shiftright", bits, last).bitwiseAND(big(1))

        further = F.when(j + edits <= m, 1 - F.shiftright(flat, width - 1).bitwiseAND(big(1))).otherwise(
            bit_of(right) - bit_of(left))
        return _let(right, lambda r: F.struct(
            left.bitwiseOR(F.shiftright(flat, 1).bitwiseOR(r).bitwiseXOR(full)).alias("up"),
            F.shiftright(flat, 1).bitwiseAND(r).alias("down"), (state["d"] + further).alias("d")))

    def step(state: Column, j: Column) -> Column:
        # past this the distance cannot come down to ``edits`` any more
        lost = state["d"] > 2 * edits + F.length(b) - m
        return F.when(lost, state).otherwise(
            _let(matches(j), lambda match: _let(no_step(state, match), lambda flat: move(state, j, flat))))

    first = F.struct(big((1 << width) - (1 << edits)).alias("up"), big(0).alias("down"),
                     F.least(F.lit(edits), m).cast("bigint").alias("d"))
    signs = F.when(F.length(b) > 0, F.sequence(F.lit(1), F.length(b))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(signs, first, step, lambda state: state["d"])


def edit_distance(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Edit distance up to ``edits``; NULL when the lengths alone are further apart, else more than ``edits`` beyond it."""
    return F.when(F.abs(F.length(a) - F.length(b)) <= edits, _without_ends(
        a, b, lambda rest: _banded(rest["a"], rest["b"], edits)))


def distinct_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(line, first_id, copies) of all lines that are not empty; copies are folded before the shuffle."""
    return docs.select(F.col(id_col).alias("id"), F.explode(F.split(text_col, "\n", -1)).alias("line")).filter(
        "line <> ''").groupBy("line").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, line_no, line): every line of every row of ``docs``, empty ones too; line numbers start at 0.

    ``docs`` has ``rid``, a number of its own for each row.
    """
    return docs.select("rid", F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "line"))


def line_keys(lines: DataFrame, edits: int = EDITS, limits: tuple[int, int] = LIMITS) -> DataFrame:
    """(lid, key, less, own): keys of the substrings of ``lines`` (lid, line, chars) that may equal a segment of a line ``less`` characters shorter.

    ``own`` marks the segments of the line itself, which are the index. With at most i edits before segment i,
    and at most e - i after it, its place moves by no more than either allows; e goes by the shorter line.
    """
    specs = []
    for e in sorted({min(1, edits), edits} - {0}):
        for less in range(e + 1):
            for i in range(e + 1):
                for move in range(max(-i, less - (e - i)), min(i, less + (e - i)) + 1):
                    specs.append(F.struct(*[F.lit(v).alias(n) for n, v in (("e", e), ("less", less), ("i", i), ("move", move))]))
    short, segment = F.col("chars") - F.col("s.less"), F.col("s.i")
    start, size = _segment(short, segment, F.col("s.e") + 1)
    at = start + F.col("s.move")
    # one row a probe, so that the expression below is compiled once and stays small
    rows = lines.select("lid", "line", "chars", F.explode(F.array(*specs)).alias("s"))
    fits = (permitted(short, edits, limits) == F.col("s.e")) & (at >= 0) & (at + size <= F.col("chars"))
    return rows.filter(fits).select(
        "lid", F.xxhash64(short, segment, F.substring(F.col("line"), at + 1, size)).alias("key"), F.col("s.less").alias("less"),
        ((F.col("s.less") == 0) & (F.col("s.move") == 0)).alias("own"))


def described(lines: DataFrame) -> DataFrame:
    """``lines`` with ``odd`` and ``signs``: bits of the letters, and of the hashed pairs of neighbours, that the line has an odd number of.

    One edit changes at most two letters' numbers, and at most three pairs' (two go and one comes, or the other way round; a
    replaced character changes four), so lines within reach differ in at most 2 and 4 times as many bits as edits.
    """
    letters = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(1 << k).alias("bit")) for k, c in enumerate(LETTERS)])
    odd = F.aggregate(letters, F.lit(0), lambda bits, x: bits.bitwiseXOR(F.when(
        F.length(F.replace(F.col("line"), x["c"], F.lit(""))) % 2 == F.length("line") % 2, 0).otherwise(x["bit"])))

    def of(characters: Column) -> Column:
        pairs = F.arrays_zip(characters.alias("a"), F.slice(characters, F.lit(2), F.size(characters)).alias("b"))
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda bits, p: bits.bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(p["a"], p["b"]), F.lit(SIGNS)).cast("int"))))

    return lines.withColumn("odd", odd).withColumn("signs", _let(F.split("line", ""), of))


def _reach(x: str, y: str, edits: int, limits: tuple[int, int]) -> Column:
    """Whether letters and neighbours leave it open that two described lines are near enough."""
    most = permitted(F.least(F.col(f"{x}chars"), F.col(f"{y}chars")), edits, limits)
    return (F.bit_count(F.col(f"{x}odd").bitwiseXOR(F.col(f"{y}odd"))) <= 2 * most) & (
        F.bit_count(F.col(f"{x}signs").bitwiseXOR(F.col(f"{y}signs"))) <= 4 * most)


def _near(pairs: DataFrame, texts: DataFrame, edits: int, limits: tuple[int, int]) -> DataFrame:
    """(a, b) of ``pairs`` of ids that are within the permitted edits, by the lines in ``texts``, stored."""
    names = ("line", "chars", "odd", "signs")
    left = texts.select(F.col("lid").alias("a"), *[F.col(c).alias(f"a_{c}") for c in names])
    right = texts.select(F.col("lid").alias("b"), *[F.col(c).alias(f"b_{c}") for c in names])
    both = pairs.join(left, "a").join(right, "b").filter(_reach("a_", "b_", edits, limits))
    most = permitted(F.least("a_chars", "b_chars"), edits, limits)
    near = edit_distance(F.col("a_line"), F.col("b_line"), edits) <= most
    return stored(both.select("a", "b", near.alias("near")), "line-links").filter("near").select("a", "b")


def line_groups(lines: DataFrame, edits: int = EDITS, limits: tuple[int, int] = LIMITS) -> tuple[DataFrame, DataFrame]:
    """(lid, root) of all lines that are in a class with others, root being its smallest lid, and (lid, line) of these and more.

    ``lines`` is a stored table of ``lid``, ``line`` and ``chars``; lines differ. Every line within reach of another is in its
    class. A key with k lines costs k pairs with its pivot. Then only lines of different classes meet: those outside the
    pivot's class with all others, turned away inside the join by ``_reach`` before a row is made.
    """
    keys = line_keys(lines, edits, limits)
    heads = keys.filter("own").groupBy("key").agg(F.min("lid").alias("pivot"), F.count(F.lit(1)).alias("size"))
    met = stored(keys.join(heads, "key").filter("lid <> pivot"), "line-met")
    wanted = stored(met.select(F.explode(F.array("lid", "pivot")).alias("lid")).distinct(), "line-ids")
    few = wanted.count() <= BROADCAST_LINES
    texts = stored(described(lines.join(F.broadcast(wanted) if few else wanted, "lid", "left_semi")), "line-texts")
    first = met.select(F.least("lid", "pivot").alias("a"), F.greatest("lid", "pivot").alias("b")).distinct()
    roots = stored(components(_near(first, texts, edits, limits)).select(F.col("node").alias("lid"), "root"), "line-roots")

    bits = texts.select("lid", "chars", "odd", "signs").join(roots, "lid", "left").withColumn("root", F.coalesce("root", "lid"))
    main = roots.select(F.col("lid").alias("pivot"), F.col("root").alias("main"))
    rest = met.filter("size > 1").join(bits, "lid").join(main, "pivot", "left").withColumn(
        "outside", F.col("root") != F.coalesce("main", "pivot"))
    open_keys = rest.filter("outside").select("key").distinct()
    rest = stored(rest.join(open_keys, "key", "left_semi").select(
        "key", "lid", "less", "own", "root", "outside", "chars", "odd", "signs"), "line-rest")

    def across(x: DataFrame, y: DataFrame) -> DataFrame:
        # lines of one length meet both ways, so only one order counts
        once = F.expr("x.root <> y.root AND (x.lid < y.lid OR y.less > 0)")
        return x.alias("x").join(y.alias("y"), (F.col("x.key") == F.col("y.key")) & once & _reach(
            "x.", "y.", edits, limits)).select(F.least("x.lid", "y.lid").alias("a"), F.greatest("x.lid", "y.lid").alias("b"))

    index = rest.filter("own")
    second = across(index, rest.filter("outside")).unionAll(
        across(index.filter("outside"), rest.filter("NOT outside"))).distinct()
    more = _near(second, texts, edits, limits)
    ends = roots.unionAll(texts.select("lid", F.col("lid").alias("root")).join(roots.select("lid"), "lid", "left_anti"))
    joined = more.join(ends.select(F.col("lid").alias("a"), F.col("root").alias("ra")), "a").join(
        ends.select(F.col("lid").alias("b"), F.col("root").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    last = components(joined).select(F.col("node").alias("root"), F.col("root").alias("top"))
    found = ends.join(last, "root", "left").select("lid", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))
    held = found.join(roots.select(F.col("lid"), F.lit(True).alias("linked")), "lid", "left").filter("linked OR moved")
    return stored(held.select("lid", "root"), "line-groups"), texts.select("lid", "line")


def line_classes(docs: DataFrame, edits: int = EDITS, limits: tuple[int, int] = LIMITS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per line that is repeated or has a near line.

    ``line``, ``first_id`` (smallest id that has it), ``copies``, ``class_lines`` (different lines of its class),
    ``class_line`` and ``class_first_id``: of its class, whose lines are linked directly or through
    others, the line with the smallest first id, then the smallest line. ``distance`` to that line, NULL if it is more than
    ``edits`` away. ``keep`` marks that one.

    Lines end at line feeds and are compared as they are; empty lines are left out. A pair is linked if it is at most
    ``permitted`` edits apart: ``edits``, and fewer where the shorter line is below ``limits``. Copies are folded first, so a
    line in a third of all rows is one row of every join. NULL texts have no lines; NULL ids are passed over for
    ``first_id`` unless there is no other. Repeated rows count as copies; other columns are ignored; an
    empty table gives no rows.
    """
    return _classes(_numbered(docs, id_col, text_col), edits, limits)


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``distinct_lines`` with a ``lid`` and ``chars``, stored."""
    found = distinct_lines(docs, id_col, text_col).withColumn("lid", F.monotonically_increasing_id())
    return stored(found.withColumn("chars", F.length("line")), "lines")


def _classes(lines: DataFrame, edits: int, limits: tuple[int, int]) -> DataFrame:
    marked, _ = line_groups(lines, edits, limits)
    # repeated lines without a near line are their own class; only the few linked ones are joined
    few = marked.count() <= BROADCAST_LINES
    held = lines.join(F.broadcast(marked) if few else marked, "lid", "left").filter("copies > 1 OR root IS NOT NULL")
    linked = held.filter("root IS NOT NULL")
    first = linked.groupBy("root").agg(F.count(F.lit(1)).alias("class_lines"), F.min(F.struct(
        F.col("first_id").isNull().alias("none"), "first_id", "line", "lid")).alias("c"))
    away = edit_distance(F.col("line"), F.col("c.line"), edits)
    own = linked.join(first, "root").select(
        "line", "first_id", "copies", "class_lines", F.col("c.line").alias("class_line"),
        F.col("c.first_id").alias("class_first_id"), F.when(away <= edits, away).alias("distance"),
        (F.col("lid") == F.col("c.lid")).alias("keep"))
    alone = held.filter("root IS NULL").select(
        "line", "first_id", "copies", F.lit(1).cast("bigint").alias("class_lines"), F.col("line").alias("class_line"),
        F.col("first_id").alias("class_first_id"), F.lit(0).cast("bigint").alias("distance"), F.lit(True).alias("keep"))
    return own.unionAll(alone)


def line_members(docs: DataFrame, edits: int = EDITS, limits: tuple[int, int] = LIMITS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """A row per line of each document that is not empty, lines without links too.

    ``rid`` and ``id`` of the row of ``docs``, ``line_no`` (from 0), ``line_sha256``, ``copies``, ``class_lines``,
    ``distance``, ``class_sha256`` and ``class_first_id`` as in ``line_classes``, and ``keep``: of each class only the first place of its
    ``class_line`` (smallest id, NULL last, then smallest rid and line number) is kept, and so is a line that is alone.

    Lines meet their class by SHA-256, so no text is shuffled a second time. Only repeated and linked lines are
    looked up; a line in very many rows is a skewed left join, which adaptive execution splits. ``docs`` is frozen, so
    both passes over it see the same ``rid``.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn(
        "rid", F.monotonically_increasing_id())
    return _members(stored(named, "line-docs"), edits, limits)


def _members(held: DataFrame, edits: int, limits: tuple[int, int]) -> DataFrame:
    """``line_members`` of a stored (id, text, rid)."""
    classes = _classes(_numbered(held, "id", "text"), edits, limits)
    marked = stored(classes.select(
        F.sha2("line", 256).alias("line_sha256"), "copies", "class_lines", "distance", F.sha2("class_line", 256).alias("class_sha256"),
        "class_first_id", F.col("keep").alias("is_first")), "line-marks")
    rows = line_rows(held, "id", "text").filter("line <> ''").select(
        "rid", "id", "line_no", F.sha2("line", 256).alias("line_sha256"))
    # one join for all lines; a hot line's rows are split over tasks, its mark is one row
    met = stored(rows.join(marked, "line_sha256", "left"), "line-members")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "rid", "line_no")
    firsts = met.filter("is_first AND copies > 1").groupBy("line_sha256").agg(F.min(place).alias("at")).select(
        F.col("at.rid").alias("rid"), F.col("at.line_no").alias("line_no"), F.lit(True).alias("at_first"))
    # joined by place, which is unique, so a line in very many rows is no hot key here
    return met.join(firsts, ["rid", "line_no"], "left").select(
        "rid", "id", "line_no", "line_sha256", F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"),
        F.coalesce("class_lines", F.lit(1)).cast("bigint").alias("class_lines"),
        F.when(F.col("copies").isNull(), F.lit(0)).otherwise(F.col("distance")).cast("bigint").alias("distance"),
        F.coalesce("class_sha256", "line_sha256").alias("class_sha256"),
        F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("class_first_id")).alias("class_first_id"),
        F.when(F.col("copies").isNull(), True).when(~F.col("is_first"), False).when(F.col("copies") == 1, True)
        .otherwise(F.coalesce("at_first", F.lit(False))).alias("keep"))


def keep_lines(docs: DataFrame, edits: int = EDITS, limits: tuple[int, int] = LIMITS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that ``line_members`` does not keep taken out of the text; empty lines, rows and columns stay."""
    tagged = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn(
        "rid", F.monotonically_increasing_id()), "line-docs")
    held = tagged.select(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"), "rid")
    gone = _members(held, edits, limits).filter("NOT keep").groupBy("rid").agg(F.collect_set("line_no").alias("gone"))
    lines = F.split(F.col(f"row.`{text_col}`"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(left)
    return tagged.join(gone, "rid", "left").select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
