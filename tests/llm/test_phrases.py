"""Phrase mining against counting by hand."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from wardline.llm import phrases as P

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()),
                       T.StructField("f", T.LongType())])


def brute(rows, longest=3, least=10, percent=50, top=2000):
    grams, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for s in range(1, longest + 1):
                for i in range(len(w) - s + 1):
                    grams.setdefault(lang, Counter())[tuple(w[i:i + s])] += 1
    out = []
    for lang, f in grams.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cands.items()):
                continue
            score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def made_rows(seed, docs=60):
    rng = np.random.default_rng(seed)
    vocab = ["Ab", "ab", "é", "x'y", " ", "zz", "(q)", "Ω", "1"]
    rows = []
    for _ in range(docs):
        words = rng.choice(vocab, rng.integers(0, 30))
        rows.append(("".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", "\r\n", ", "], p=[.7, .05, .05, .05, .05, .05, .05])
                             for w in words), rng.choice(["en", "de"])))
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, str(lang) if lang else None, "clash", 7) for i, (t, lang) in enumerate(rows)], SCHEMA)
    got = P.collocations(df.repartition(3), **options).drop("left_open", "right_open").collect()
    return sorted(tuple(r) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_against_counting(spark, seed):
    rows = made_rows(seed) + [(None, "en"), ("", None), ("ab zz " * 40, None), ("a. b, c", None), (" \t\n.;", "fr")]
    rows += rows[:20]                                                   # repeated rows count again
    assert run(spark, rows, least=4, shard_bytes=200) == brute(rows, least=4)
    assert run(spark, rows, least=4) == brute(rows, least=4)


def test_phrases_limits_and_empty(spark):
    rows = made_rows(3)
    assert run(spark, rows, least=2, top=3, longest=2) == brute(rows, longest=2, least=2, top=3)
    assert run(spark, []) == []
    assert run(spark, [("", "en"), (None, None)]) == []


def test_one_very_long_text(spark):
    rows = [("la di da " * 30000, "en"), ("la di " * 20, "en")]
    assert run(spark, rows, shard_bytes=1000) == brute(rows)


def test_intervals_move_in_step():
    """Both intervals of a phrase hold exactly its occurrences, forward and backward."""
    rng = np.random.default_rng(4)
    data = np.frombuffer(" ".join(rng.choice(["a", "b", "c", "d."], 300)).encode(), np.uint8)
    text, words = P.symbols(data, np.array([0, len(data)]))
    index = P.ShardIndex("x", words, P.transform(text, 3), P.transform(np.ascontiguousarray(text[::-1]), 3))
    p = index.single()
    for length in (1, 2, 3):
        seen = [tuple(int(w[i]) + 1 for w in p.words) for i in range(len(p.size))]
        for i, phrase in enumerate(seen):
            at = [j for j in range(len(text) - length + 1) if tuple(text[j:j + length]) == phrase]
            assert p.size[i] == len(at)
            before = Counter(int(text[j - 1]) for j in at)
            rows = index.forward.bwt[p.forward[i]:p.forward[i] + p.size[i]]
            assert Counter(rows.tolist()) == before
            after = Counter(int(text[(j + length) % len(text)]) for j in at)
            assert Counter(index.backward.bwt[p.backward[i]:p.backward[i] + p.size[i]].tolist()) == after
        p = index.extended(p)


def test_places_are_sorted_as_one_number(monkeypatch):
    rng = np.random.default_rng(5)
    for keys in (rng.integers(0, 50, 3000), rng.integers(0, 1 << 62, 3000), np.zeros(4, np.int32), np.zeros(0, np.int64),
                 np.array([7]), rng.integers(0, 9, 500).astype(np.int32)):
        order = np.argsort(keys, kind="stable")
        values, places = P.sorted_places(keys)
        assert np.array_equal(values, keys[order]) and np.array_equal(places, order)

    def no_slow_sort(*_, **__):
        raise AssertionError("places sorted by their keys")

    text = np.append(rng.integers(0, 40, 2000), 0).astype(np.int32)
    monkeypatch.setattr(P.np, "argsort", no_slow_sort)
    bwt = P.transform(text, 3)
    side = P.Side(bwt)
    assert "to" not in vars(side)                       # made when a level moves an interval, not before
    assert sorted(side.to.tolist()) == list(range(len(text)))


def test_a_shard_is_extended_in_blocks_of_occurrences(monkeypatch):
    """Blocks of any size give the same phrases; the memory beyond the index does not grow with a shard's occurrences."""
    import tracemalloc

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 300, 1000)).encode() for _ in range(400)]
    shard = P._shard("en", list(texts))

    class Full:
        value = np.full(1 << 10, -1, np.int64)

    def rows(block):
        monkeypatch.setattr(P, "BLOCK", block)
        return [r for b in P._level(2, [Full])(iter([shard])) for r in zip(*(b.column(i).to_pylist() for i in range(1, 6)))]

    def peak(block):
        monkeypatch.setattr(P, "BLOCK", block)
        tracemalloc.start()
        for _ in P._level(2, [Full])(iter([shard])):
            pass
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top

    small = rows(5000)
    assert len(small) == len({r[0] for r in small}) and sum(r[1] for r in small) == 400 * 999
    assert small == rows(1 << 29)
    assert peak(1 << 14) < 0.75 * peak(1 << 30)
