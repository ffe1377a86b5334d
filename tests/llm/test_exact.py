"""Operators that exact recomputation can check: by SQL, by brute force or by the tokenizer itself."""

import hashlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from odd import SF_DIR, no_docs, odd_docs  # noqa: F401
from registry.check import _plain, connect
from tallymart.llm import decontaminate, line_dedup, merkle, shingle_sets, simhash, substring_dedup, token_counts, url_filter
from tallymart.llm import queries as Q
from tallymart.llm.common import components, table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents").cache()


@pytest.mark.parametrize("name", list(Q.ORACLE))
def test_same_rows_as_sql(spark, name):
    got = _plain(Q.QUERIES[name](spark, SF_DIR).toArrow())
    want = _plain(connect(SF_DIR).execute(Q.ORACLE[name]).to_arrow_table())
    assert got == want and got[1]


# -- url filters ------------------------------------------------------------

def test_urls(spark):
    rules = spark.createDataFrame(
        [("ORG", "/", "allow"), ("a.org", "/x", "block"), ("a.org", "/x", "allow"), ("", None, "block"),
         (None, "/", "block"), ("net", "/", None), ("b.a.org", "", "allow")], "host string, path string, verdict string")
    pages = spark.createDataFrame(
        [(1, "http://A.org/xy?q#f", "mine"), (2, "http://notorg/", "m"), (3, None, None), (None, "no scheme", "m"),
         (4, "https://b.a.org/x", "m"), (4, "https://b.a.org/x", "m"), (5, "a://org?x", "m"), (6, "q://org/" + "p" * 5000, "m")],
        "page_id int, url string, verdict string")
    got = sorted((r.page_id or 0, r.host, r.path[:4], r.rule, r.verdict) for r in
                 url_filter.judge(pages, rules, default="none").collect())
    assert got == [
        (0, "", "", "", "block"), (1, "a.org", "/xy", "a.org/x", "block"), (2, "notorg", "/", None, "none"),
        (3, "", "", "", "block"), (4, "b.a.org", "/x", "b.a.org", "allow"), (4, "b.a.org", "/x", "b.a.org", "allow"),
        (5, "org", "", None, "none"), (6, "org", "/ppp", "ORG/".lower(), "allow")]
    assert url_filter.judge(pages, rules.filter("false")).filter("rule IS NOT NULL OR verdict <> 'allow'").count() == 0
    assert url_filter.judge(pages.filter("false"), rules).count() == 0


# -- substring dedup --------------------------------------------------------

def _removed(rows, window):
    first = defaultdict(lambda: 1 << 63)
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            k = tuple(words[i:i + window])
            first[k] = min(first[k], doc if doc is not None else (1 << 63) - 1)
    out = []
    for doc, text in rows:
        words, gone = (text or "").encode().split(), set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < (doc if doc is not None else (1 << 63) - 1):
                gone |= set(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((str(doc), len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out)


@pytest.mark.parametrize("window", [2, 7, 50])
def test_repeats_of_odd_rows(odd_docs, window):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted((str(r[0]), *r[1:]) for r in substring_dedup.remove_repeats(odd_docs, window, texts=True).collect())
    assert got == _removed(rows, window)


def test_repeats_of_nothing(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_runs_are_hashed_by_content():
    import numpy as np

    rolling = substring_dedup.Rolling(substring_dedup._BASES[0])
    a = np.arange(1, 40, dtype=np.uint64)
    shifted = np.concatenate((np.array([99, 98], np.uint64), a))
    assert (rolling.runs(a, 5) == rolling.runs(shifted, 5)[2:]).all()
    assert len(set(rolling.runs(a, 5).tolist())) == 35
    for width in (1, 2, 3, 6, 9):
        low = substring_dedup.sliding_min(shifted, width)
        assert low.tolist() == [min(shifted[i:i + width].tolist()) for i in range(len(shifted) - width + 1)]


# -- SimHash ----------------------------------------------------------------

def _print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    values = [xxhash.xxh64_intdigest(s, seed=42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def _groups(prints):
    """prints: list of (id, fp); smallest reachable id of each."""
    values = sorted({p for _, p in prints})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    first = {}
    for doc, p in prints:
        if doc is not None:
            first[find(p)] = min(first.get(find(p), doc), doc)
    return [(str(doc), p, first.get(find(p))) for doc, p in prints]


@pytest.mark.parametrize("which", ["given", "odd"])
def test_simhash_groups(docs, odd_docs, which):
    frame = docs if which == "given" else odd_docs
    want = _groups([(r.doc_id, _print(r.text)) for r in frame.select("doc_id", "text").collect()])
    got = [(str(r.id), r.fp % (1 << 64), r.component_id) for r in simhash.near_groups(frame).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_near_pair_is_linked(spark):
    import random

    random.seed(5)
    prints = set()
    for _ in range(60):
        base = random.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            near = base
            for b in random.sample(range(64), random.randint(1, 6)):
                near ^= 1 << b
            prints.add(near)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(spark.createDataFrame(signed, "fp bigint"), 4).collect()}
    assert {frozenset(x) for x in got} == {frozenset((a, b)) for a in prints for b in prints
                                           if a < b and (a ^ b).bit_count() <= 4}


def test_cells_and_repeated_prints_are_not_broadcast(spark):
    """Spark sizes cells by the fingerprints that they are exploded from, and repeated fingerprints by their packed file."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    links = plan(simhash.links(spark.range(300).select(F.xxhash64("id").alias("fp"))))
    assert "SortMergeJoin" in links and "Broadcast" not in links
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("one two three four five"), F.col("id") % 50).alias("text"))
    groups = simhash.near_groups(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=merge)" in groups.split("\n")[1]


def test_one_of_each_group_stays(docs, odd_docs, no_docs):
    for frame in (docs, odd_docs):
        groups = simhash.near_groups(frame)
        kept = simhash.keep_one(frame)
        assert kept.columns == frame.columns
        assert kept.count() == simhash._roots(groups.select("fp"), 4).select("root").distinct().count()
    assert simhash.keep_one(no_docs).count() == 0 and simhash.near_groups(no_docs).count() == 0


def test_no_near_copies_are_left(spark, no_docs):
    import random

    random.seed(3)
    rows = [(i, " ".join(random.choice("abcdefgh") + str(random.randint(0, 400)) for _ in range(150))) for i in range(0, 400, 10)]
    for i, text in list(rows):
        for k in range(1, 5):  # one changed word costs up to five of about 146 shingles
            words = text.split()
            for at in random.sample(range(150), k):
                words[at] = f"new{i}x{k}"
            rows.append((i + k, " ".join(words)))

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    def like(held):
        sets = [(i, shingles(t)) for i, t in held]
        return [(i, j) for i, a in sets for j, b in sets if i < j and len(a & b) >= 0.8 * len(a | b) - 1e-9]

    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert len(like((r.doc_id, r.text) for r in simhash.keep_one(frame).collect())) > 10
    left = shingle_sets.keep_one_alike(simhash.keep_one(frame))
    assert left.columns == frame.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    assert not like(kept) and {i // 10 for i, _ in kept} == set(range(40))
    assert shingle_sets.keep_one_alike(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(200, 200), (301, 300), (300, 301)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 1 for k in range(1, 40)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- Merkle fingerprints ----------------------------------------------------

def _root(text):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    return sha(",".join(sha(",".join(sha(p) for p in s.split("\n"))) for s in text.split("\n\n")))


@pytest.mark.parametrize("which", ["given", "odd"])
def test_fingerprints_and_edits(docs, odd_docs, which):
    frame = docs if which == "given" else odd_docs
    low = -(1 << 63)
    rows = [(low if r.doc_id is None else r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
    ids = sorted({i for i, _ in rows}, reverse=True)
    need = {i: max(len(t) // 2 for j, t in rows if j == i) for i in ids}
    after = dict(zip(ids, ids[1:] + ids[:1]))
    head = {i: min(t[:need[i]].encode() for j, t in rows if j == after[i]).decode() for i in ids}
    want = Counter()
    for i, t in rows:
        k = len(t) // 2
        edited = t[:len(t) - k] + head[i][:k]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), _root(t), _root(edited))] += 1
    got = merkle.with_edits(frame).collect()
    assert Counter((low if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint)
                   for r in got) == want
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (r.edits == []) or r.near_edited == 1
    if which == "given":
        assert sum(r.near_edited > r.near_next for r in got) >= 0.97 * len(got)


def test_order_of_spread_ids(spark):
    ids = sorted({-(1 << 63), -5, 0, 1, 1023, 1024, 1025, 5000, 1 << 20, (1 << 20) + 1, 1 << 40, (1 << 62) + 7})
    frame = spark.createDataFrame([(i, i) for i in ids], "id bigint, top bigint")
    assert dict(merkle._below(frame, ids[0], ids[-1]).collect()) == dict(zip(ids, [None, *ids]))


def test_edits_are_located(spark):
    left, right = "a\nb\n\nc\nd", "a\nB\n\nc\nd\n\ne"
    frame = spark.createDataFrame([(left, right), (left, left)], "l string, r string")
    got = frame.select(merkle.differing(merkle.sections(F.col("l")), merkle.sections(F.col("r"))).alias("e")).collect()
    assert [[tuple(x) for x in r.e] for r in got] == [[(0, 1), (2, 0)], []]
    kept = frame.select(F.col("l").alias("text"), F.lit(1).alias("tree"))
    assert merkle.merkle(kept).select("fingerprint").distinct().count() == 1


def test_fingerprints_of_nothing(no_docs):
    assert merkle.with_edits(no_docs).count() == 0


# -- lines ------------------------------------------------------------------

def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance(spark):
    import random

    random.seed(1)
    rows = []
    for _ in range(400):
        a = "".join(random.choice("abé𝔘") for _ in range(random.randint(0, 14)))
        b = list(a)
        for _ in range(random.randint(0, 4)):
            i, how = random.randint(0, len(b)), random.random()
            if how < 0.4 or i == len(b):
                b.insert(i, random.choice("abé"))
            elif how < 0.7:
                b.pop(i)
            else:
                b[i] = "b"
        rows.append((a, "".join(b)))
    for edits in (1, 2, 3):
        got = spark.createDataFrame(rows, "a string, b string").select(
            "a", "b", line_dedup.edit_distance(F.col("a"), F.col("b"), edits).alias("d")).collect()
        for r in got:
            real = _distance(r.a, r.b)
            assert r.d == real if real <= edits else r.d is None or r.d > edits


def test_line_classes(spark, odd_docs, no_docs):
    near = "the quick brown fox jumps over the dog"
    more = [(50, f"{near}\nother line of text\n\n{near}"), (51, near.replace("quick", "quack") + "\nabc"),
            (52, near.replace("brown", "brwn") + "\nabd\nabc"), (53, near + "ss\nsix to\nsix so\nsixteen x\nsixteen xy\nsixteen xyz\nfive\nfives"), (None, "of one without an id\nabc")]
    frame = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows = [(r.doc_id, line) for r in frame.collect() for line in (r.text or "").split("\n") if line]
    copies = Counter(line for _, line in rows)
    first = {}
    for doc, line in rows:
        if doc is not None:
            first[line] = min(first.get(line, doc), doc)
    short = [x for x in copies if len(x) < 1000]
    pairs = [(a, b) for a in short for b in short if a < b and _near(a, b)]
    root = {x: x for x in copies}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    classes = defaultdict(list)
    for x in copies:
        classes[find(x)].append((first.get(x) is None, first.get(x) or 0, x))
    want = []
    for x in copies:
        rows, top = classes[find(x)], min(classes[find(x)])[2]
        away = 0 if x == top else _distance(x, top)
        if copies[x] > 1 or len(rows) > 1:
            want.append((x, first.get(x), copies[x], len(rows), top, away if away <= 2 else None, x == top))
    want.sort()
    got = sorted((r.line, r.first_id, r.copies, r.class_lines, r.class_line, r.distance, r.keep)
                 for r in line_dedup.line_classes(frame).collect())
    assert [(str(x) for x in g) and g for g in got] == want and len(pairs) >= 4
    assert line_dedup.line_classes(no_docs).count() == 0


def test_every_place_of_a_line_is_listed_and_one_of_a_class_stays(spark, odd_docs, no_docs):
    near = "the quick brown fox jumps over the dog"
    more = [(50, f"{near}\nother line of text\n\n{near}"), (51, near.replace("quick", "quack") + "\nabc"),
            (50, f"{near}\nother line of text\n\n{near}"), (None, f"abc\n{near}\nof one without an id")]
    frame = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id bigint, text string"))
    places = [(r.doc_id, i, line) for r in frame.collect() for i, line in enumerate((r.text or "").split("\n")) if line]
    sha = {hashlib.sha256(line.encode()).hexdigest(): line for _, _, line in places}
    got = line_dedup.line_members(frame).collect()
    assert Counter((r.id, r.line_no, sha[r.line_sha256]) for r in got) == Counter(places)
    copies = Counter(line for _, _, line in places)
    assert all(r.copies == copies[sha[r.line_sha256]] for r in got)
    # one place of each class stays, the first of its line
    classes = defaultdict(list)
    for r in got:
        classes[r.class_sha256].append(r)
    for name, rows in classes.items():
        (kept,) = (r for r in rows if r.keep)
        assert kept.line_sha256 == name
        at = [(r.id is None, r.id or 0) for r in rows if r.line_sha256 == name]
        assert (kept.id is None, kept.id or 0) == min(at) and kept.id == kept.class_first_id
    assert {sha[r.class_sha256] for r in got if near[-9:] in sha[r.line_sha256]} == {near}
    left = line_dedup.keep_lines(frame)
    assert left.columns == frame.columns and left.count() == frame.count()
    held = Counter(line for r in left.collect() for line in (r.text or "").split("\n") if line)
    assert held == Counter(sha[r.line_sha256] for r in got if r.keep)
    assert line_dedup.line_members(no_docs).count() == 0


def test_op5_names_every_document(spark, docs):
    places = Counter((r.doc_id, i) for r in docs.collect() for i, line in enumerate((r.text or "").split("\n")) if line)
    assert Counter((r.doc_id, r.line_no) for r in Q.op5_line_dedup(spark, SF_DIR).collect()) == places


def _near(a, b):
    fewest = min(len(a), len(b))
    most = 0 if fewest < 5 else 1 if fewest < 10 else 2
    return abs(len(a) - len(b)) <= most and _distance(a, b) <= most


def _roots(text):
    """text: line by lid; smallest lid linked, of lines with a near one."""
    root = {x: x for x in text}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = set()
    for a in text:
        for b in text:
            if a < b and _near(text[a], text[b]):
                linked |= {a, b}
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {x: find(x) for x in linked}


@pytest.mark.parametrize("shape", ["random", "dense", "one prefix"])
def test_every_near_line_is_in_the_class(spark, shape):
    import random

    random.seed(9)
    def word(letters, low, high):
        return "".join(random.choice(letters) for _ in range(random.randint(low, high)))

    if shape == "random":
        lines = {word("abc", 3, 10) for _ in range(150)} | {word("ab c", 9, 13) for _ in range(200)}
    elif shape == "dense":
        base = word("abcdef é", 40, 40)
        lines = {base[:i] + c + base[i + 1:] for i in range(40) for c in "xyz"} | {base}
    else:  # lines that share most of their text, few of them near
        base = word("abcdefghijkl ", 40, 40)
        lines = {base + word("abcd", 3, 4) + base[::-1] for _ in range(150)}
    frame = spark.createDataFrame(list(enumerate(sorted(lines))), "lid bigint, line string")
    text = dict(frame.collect())
    got, _ = line_dedup.line_groups(frame.withColumn("chars", F.length("line")))
    want = _roots(text)
    assert dict(got.collect()) == want and want


def test_bits_bound_the_edits(spark):
    import random

    random.seed(4)
    rows = []
    for _ in range(300):
        a = "".join(random.choice("abcde fé") for _ in range(random.randint(5, 30)))
        b = list(a)
        for _ in range(random.randint(1, 2)):
            i, how = random.randrange(len(b)), random.random()
            b[i:i + 1] = [random.choice("abcde")] if how < 0.4 else [] if how < 0.7 else [b[i], random.choice("abcde")]
        rows.append((a, "".join(b)))
    bits = [line_dedup.described(spark.createDataFrame([(i, p[k]) for i, p in enumerate(rows)], "lid int, line string"))
            .select("lid", "odd", "signs").collect() for k in (0, 1)]
    one, two = ({r.lid: (r.odd, r.signs) for r in b} for b in bits)
    for i, (a, b) in enumerate(rows):
        d = _distance(a, b)
        assert (one[i][0] ^ two[i][0]).bit_count() <= 2 * d and (one[i][1] ^ two[i][1]).bit_count() <= 4 * d


# -- token counts -----------------------------------------------------------

@pytest.mark.parametrize("which", ["given", "odd"])
def test_token_counts(spark, docs, odd_docs, which):
    from tokenizers import Tokenizer

    path = Q.tokenizer_path("byte_bpe_50k.json")
    frame = docs if which == "given" else odd_docs
    if which == "odd":
        extra = ["a <|endoftext|> b", " lead", "trail ", "two  spaces\n\n\n x", "tab\t \tx", "it's  we'll 's", "\u3000wide\u00a0x \u2003y",
                 "emoji 👩‍👩‍👧 x", "中文 字符 mixed英文", " ", "  ", "\r\n \r\n", "\x1c \x1f x", "٣٤ ½ Ⅷ x²"]
        frame = frame.select("doc_id", "text").unionAll(spark.createDataFrame(
            [(100 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string"))
    tokenizer = Tokenizer.from_file(path)
    want = Counter((r.doc_id, len((r.text or "").encode()), n, n > 512) for r in frame.select("doc_id", "text").collect()
                   for n in [len(tokenizer.encode(r.text or "", add_special_tokens=False))])
    got = token_counts.count_tokens(frame, path, memo_units=50)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_token_counts_of_nothing(no_docs):
    assert token_counts.count_tokens(no_docs, Q.tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.check_pattern(Q.tokenizer_path("word_bpe_49k.json"))


# -- decontamination --------------------------------------------------------

def test_items_inside_documents(spark, odd_docs, no_docs):
    schema = "item_id int, text string, doc_id string"
    item = " ".join(f"w{i}" for i in range(20, 44))
    items = spark.createDataFrame(
        [(1, item.upper(), "x"), (2, None, "x"), (3, "", "x"), (4, "Short TEXT", "x"), (5, "nowhere " + item[:30], None),
         (None, "two lines", "x"), (6, " ".join(f"w{i}" for i in range(1000, 1020)), "x"), (1, item, "y")], schema)
    got = sorted((str(r.doc_id), str(r.item_id)) for r in decontaminate.contaminated(odd_docs, items).collect())
    assert got == [("1", "1"), ("2", "1"), ("3", "1"), ("3", "1"), ("7", "4"), ("7", "None"), ("None", "1")]
    left = decontaminate.clean(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == 13 - 7
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.clean(odd_docs, items.filter("false")).count() == 13


def test_threshold_is_exact(spark):
    words = [f"t{i}" for i in range(34)]  # 30 shingles
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id int, text string")
    texts = {n: " ".join(words[:n + 4]) + " tail" for n in range(20, 31)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    got = {r.doc_id: round(r.containment, 6) for r in decontaminate.contaminated(frame, bench).collect()}
    assert got == {n: round(n / 30, 6) for n in range(24, 31)}
