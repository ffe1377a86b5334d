"""Misspelt terms: every value within reach comes back, and no other."""

import random

import pytest

from tallymart.operators import close_match as C, glossary


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def wanted(terms, values):
    out = []
    for term in {t for t in terms if t is not None}:
        a = term.strip(" ").lower()
        reach = 2 if len(a) >= 7 else 1 if len(a) >= 4 else 0
        near = sorted((distance(a, v.strip(" ").lower()), -n, t, c, v) for t, c, v, n in values
                      if a and v is not None and v.strip(" ") and distance(a, v.strip(" ").lower()) <= reach)
        out += [(term, t, c, v, d, k == 0) for k, (d, _, t, c, v) in enumerate(near)]
    return sorted(out)


VALUES = "table_name string, column_name string, value string, rows bigint"


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "aäß中é"])
def test_same_as_comparing_all(spark, letters):
    rng = random.Random(len(letters))
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, 11)))
    values = [("t", f"c{i % 3}", word(), rng.randint(1, 3)) for i in range(150)]
    terms = [word() for _ in range(60)]
    for _, _, v, _ in values[:60]:   # planted: one and two edits
        for _ in range(2):
            i = rng.randint(0, len(v))
            v = v[:i] + rng.choice(["", "x", rng.choice(letters)]) + v[i + rng.randint(0, 1):]
            terms.append(v)
    got = C.match_close(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame(values, VALUES))
    assert sorted(tuple(r) for r in got.collect()) == wanted(terms, values)


def test_odd_rows(spark):
    values = [("t", "c", "Women", 2), ("t", "c", " women ", 5), ("u", "c", "Women", 2), ("t", "c", None, 1), ("t", "c", "", 1),
              ("t", "c", "abc", 1), ("t", "c", "abd", 1), ("t", "c", "x" * 3000, 1)]
    terms = ["WOMAN", "WOMAN", None, "", "  ", "abd ", "abe", "x" * 2998, "nothing like it"]
    frame = spark.createDataFrame(values, VALUES)
    got = C.match_close(spark.createDataFrame([(t,) for t in terms], "term string"), frame)
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == wanted(terms, values)
    assert ("WOMAN", "t", "c", " women ", 1, True) in rows       # the most rows wins among equals
    assert C.match_close(frame.selectExpr("value AS term").filter("false"), frame).count() == 0
    assert C.match_close(frame.selectExpr("value AS term"), frame.filter("false")).count() == 0


def test_equal_terms_are_those_of_the_exact_match(spark):
    values = spark.createDataFrame([("t", "c", v, 1) for v in ("West", "East", "eastern", "North West")], VALUES)
    terms = spark.createDataFrame([(t,) for t in (" west", "EAST ", "nort west", "sud")], "term string")
    exact = glossary.entity_match(terms, values).collect()
    close = C.match_close(terms, values)
    assert sorted(map(tuple, exact)) == sorted(tuple(r)[:4] for r in close.filter("distance = 0").collect())
    plan = close._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
