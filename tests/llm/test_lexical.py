"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from tests.llm.conftest import ODD_ROWS
from wardline.llm import lexical as L

ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType())])


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(rows, items, top=10):
    docs = [(i, Counter(terms_of(t))) for i, t in rows]
    n, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    out = []
    for item, words in asked.items():
        found = []
        for i, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in words if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def made_rows(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Été", "日本", "AB", "ab", "x_y"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    rows = [(rng.randrange(10**6), " ".join(rng.choices(vocab, weights, k=rng.randint(0, 40)))) for _ in range(n)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 12)))) for i in range(25)]
    return rows, items


def run(spark, make_docs, rows, items, **options):
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], ITEM)
    return sorted((tuple(r) for r in L.search(make_docs(rows, extra=True).repartition(3), asked, **options)
                   .select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("seed,options", [
    (1, {}), (2, {"block": 7, "bundle": 6, "top": 3}), (3, {"block": 20, "owners": (.02, .05, .1, .2, .4, .6)}),
    (4, {"owners": (), "top": 1})])
def test_search_against_scoring_all(spark, make_docs, seed, options):
    rows, items = made_rows(seed)
    rows += rows[:30]                                                    # repeated rows and ties
    assert run(spark, make_docs, rows, items, **options) == brute(rows, items, options.get("top", 10))


def test_search_odd_rows(spark, make_docs):
    items = [(1, None), (2, ""), (3, "one THREE"), (3, "w7 日本"), (None, "clean text"), (4, "absent"), (5, "x" * 70_000)]
    assert run(spark, make_docs, ODD_ROWS, items) == brute(ODD_ROWS, items)


def test_search_empty(spark, make_docs):
    assert run(spark, make_docs, [], [(1, "a b")]) == []
    assert run(spark, make_docs, [(1, "a b")], []) == []
    assert run(spark, make_docs, [(1, None), (2, ". .")], [(1, "a b")]) == []
