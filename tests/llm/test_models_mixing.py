"""Mixing, URL filter, toxicity and the pipeline."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD_ROWS
from wardline.llm import markov, mixing, toxicity, urls


def brute_targets(sizes, cap=3.0):
    """Repeated resharing, as the rule is worded."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: cap * sizes[s] if s in capped else weight[s] * left / w for s in order}
        more = {s for s in order if s not in capped and target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not more:
            return target
        capped |= more


def mix_rows(seed):
    rng = random.Random(seed)
    share = {"big": 600, "tiny": 3, "mid": 90, "other": 60, "ä": 40, None: 30}
    rows = []
    for s, n in share.items():
        for _ in range(n):
            rows.append((len(rows), "w " * rng.choice([1, 3, 10, 50, 400]), s))
    return rows


def test_mixing_targets_and_balance(make_docs):
    rows = mix_rows(1)
    docs = make_docs(rows)
    out = mixing.draw(docs, block=64, fan_in=4).toPandas()
    source = {i: s for i, _, s in rows}
    size = {i: len(t.split()) for i, t, _ in rows}
    sizes = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    want = brute_targets(sizes)
    assert any(want[s] == 3 * sizes[s] for s in sizes)
    out["s"] = [source[i] or "-" for i in out.doc_id]
    for s, g in out.groupby("s"):
        s = None if s == "-" else s
        assert g.target.iloc[0] == pytest.approx(want[s], rel=1e-9) and (g.source_size == sizes[s]).all()
        assert abs(g.taken.sum() - want[s]) <= max(2.0, 0.01 * want[s])
        assert (g["size"] == [size[i] for i in g.doc_id]).all()
        m = want[s] / sizes[s]
        assert set(g.copies) <= {int(np.floor(m + 1e-9)), int(np.ceil(m - 1e-9))}
        assert abs(g.copies.sum() - m * len(g)) <= 3
    again = mixing.draw(docs.repartition(5), block=64, fan_in=4).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(out.doc_id, out.taken))


def test_flight_keeps_both_totals_and_expectation():
    size = np.random.default_rng(0).integers(1, 50, 400).astype(float)
    x = np.full(400, 0.3)
    mean = np.zeros(400)
    for seed in range(200):
        y = mixing.flight(x, size, np.random.default_rng(seed))
        assert ((y > 0) & (y < 1)).sum() <= 2
        assert y.sum() == pytest.approx(x.sum()) and (y * size).sum() == pytest.approx((x * size).sum())
        mean += y / 200
    assert abs(mean - 0.3).max() < 0.2 and abs(mean.mean() - 0.3) < 1e-9


def test_mixing_odd_rows(make_docs):
    docs = make_docs(ODD_ROWS, extra=True)
    out = mixing.draw(docs).collect()
    assert len(out) == len(ODD_ROWS) and all(r.taken <= 3 * r.size for r in out)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.draw(make_docs([])).count() == 0 and mixing.mix_documents(make_docs([])).count() == 0
    assert {r.taken for r in mixing.draw(make_docs([(1, None), (2, "")])).collect()} == {0}


def test_url_parts_and_rules(spark):
    cases = [("https://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
             ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
             ("http://b.www.example.com/en/z", "b.www.example.com", "/en/z", "www.example.com/en/", "allow"),
             ("x://com/", "com", "/", "com/", "allow"), ("x://notcom", "notcom", "", None, None),
             ("x://a.com", "a.com", "", None, None), ("x://a.net/es/?y", "a.net", "/es/", "net/es/", "block"),
             ("x://a.net/fr", "a.net", "/fr", None, None), ("http://h#a/b", "h", "", None, None),
             ("a://b://c/d", "b:", "//c/d", None, None), ("no scheme/com/", "", "", None, "allow"),
             (None, "", "", None, "allow"), ("x://É.com/Ä\nb", "É.com", "/Ä\nb", "com/", "allow"), ("://q", "q", "", None, None)]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule) and verdict in (None, r.verdict)
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_url_model_learns_the_rules(spark):
    rng = random.Random(4)

    def name():
        return "".join(rng.choice("abcdefgh") for _ in range(6))

    rows = [(i, f"http://{name()}.example.com/good/{name()}") for i in range(600)]
    rows += [(1000 + i, f"http://{name()}.site.net/es/bad-{name()}") for i in range(600)]
    rows += [(3000 + i, f"http://{name()}.example.org/good/{name()}") for i in range(50)]
    rows += [(4000 + i, f"http://{name()}.site.org/es/bad-{name()}") for i in range(50)]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert sum(got[3000 + i].verdict == "allow" for i in range(50)) >= 45
    assert sum(got[4000 + i].verdict == "block" for i in range(50)) >= 45


def exact_mean_log(texts, url):
    """Witten-Bell interpolation over dictionaries of all contexts."""
    counts = {}
    for t in texts:
        x = [markov.EDGE] * markov.ORDER + list(markov.encode(t)[1:])
        for i in range(markov.ORDER, len(x)):
            for order in range(markov.ORDER + 1):
                held = counts.setdefault(tuple(x[i - order: i]), {})
                held[x[i]] = held.get(x[i], 0) + 1
    x, total = [markov.EDGE] * markov.ORDER + list(markov.encode(url)[1:]), 0.0
    for i in range(markov.ORDER, len(x)):
        p = 1 / markov.SYMBOLS
        for order in range(markov.ORDER + 1):
            held = counts.get(tuple(x[i - order: i]))
            if held:
                p = (held.get(x[i], 0) + len(held) * p) / (sum(held.values()) + len(held))
        total += np.log(p)
    return total / (len(x) - markov.ORDER)


def test_url_scores_match_exact_contexts(spark):
    rng = random.Random(6)

    def name(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz-.") for _ in range(n))

    rows = [(i, f"http://a{name(12)}.example.com/{name(40)}") for i in range(900)]
    rows += [(1000 + i, f"http://b{name(12)}.site.net/es/{name(40)}") for i in range(900)]
    rows += [(3000 + i, f"http://{name(9)}.org/{name(20)}") for i in range(40)] + [(5000, "http://"), (5001, None)]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert len(got) == len(rows) and got[5000].score == 0.0 and got[5001].verdict == "allow"
    seen = {"com/": [], "net/es/": []}
    for r in got.values():
        text = (r.host + r.path).encode()
        if r.rule and zlib.crc32(text) % urls.HOLD:
            seen[r.rule].append(text)
    for i in range(40):
        text = (got[3000 + i].host + got[3000 + i].path).encode()
        want = exact_mean_log(seen["com/"], text) - exact_mean_log(seen["net/es/"], text)
        assert got[3000 + i].score == pytest.approx(want, abs=1e-7)


def test_markov_probabilities_sum_to_one():
    counts = np.zeros(int(np.prod(markov.SHAPE)), np.float32)
    for text in (b"banana", b"bandana", b"cab"):
        np.add.at(counts, markov.cells(markov.encode(text)).ravel(), 1)
    model = markov.Model(counts)
    total = sum(model.probabilities(np.array([markov.EDGE, 1, 0, s]))[-1] for s in range(markov.SYMBOLS))
    assert total == pytest.approx(1.0)
    assert model.mean_log(markov.encode(b"banana")) > model.mean_log(markov.encode(b"nnbaaa"))


def test_word_model_counts_match_a_plain_count(make_docs):
    rows = [(1, "ab abc\nab"), (2, None), (3, "x1 ab")]
    from pyspark.sql import functions as F

    docs = make_docs(rows).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    got = markov.collect_counts(docs.mapInArrow(toxicity._count_words, "cell long, n long")
                                .groupBy("cell").agg(F.sum("n").alias("n")), ["n"])[0]
    want = np.zeros(int(np.prod(markov.SHAPE)))
    for _, t in rows:
        for w in (t or "").split():
            for order, c in enumerate(markov.cells(markov.encode(w.encode()))):
                if order <= toxicity.TRIGRAM:
                    np.add.at(want, c, 1)
    assert (got == want).all()


def toxic_rows(n=1500, disguise=lambda w, rng: w):
    rng = random.Random(8)
    clean = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    bad = ["idiot", "scum", "pathetic", "moron"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            held = zlib.crc32(str(i).encode()) % 5 == 0
            for _ in range(2):
                word = rng.choice(bad)
                w.insert(rng.randrange(len(w)), disguise(word, rng) if held else word)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.mark.parametrize("kind", ["plain", "leet", "spaced", "repeated"])
def test_toxicity_held_out_accuracy(spark, make_docs, kind):
    leet = str.maketrans("iose", "1053")
    disguise = {"plain": lambda w, rng: w, "leet": lambda w, rng: w.translate(leet), "spaced": lambda w, rng: " ".join(w),
                "repeated": lambda w, rng: re.sub(r"([aeiou])", r"\1\1\1", w)}[kind]
    rows, labels = toxic_rows(disguise=disguise)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(make_docs(rows), marks).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i, _ in held) and sum(r.held_out for r in got.values()) == len(held)
    right = sum(got[i].predicted == y for i, y in held) / len(held)
    assert right >= 0.95, right
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def english_decoder(spark, make_docs):
    words = ("you are such a stupid idiot and this is good news hello all the people of a small book shop with feet "
             "pretty full of a rude scum i am not so sure it is a well known idea see you soon").split()
    rng = random.Random(3)
    docs = make_docs([(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(60)])
    cells = (docs.selectExpr("cast(text as binary) as text").mapInArrow(toxicity._count_words, "cell long, n long")
             .groupBy("cell").sum("n").withColumnRenamed("sum(n)", "n"))
    return toxicity.Decoder(markov.Model(markov.collect_counts(cells, ["n"])[0]))


def test_toxicity_decodes_several_and_long_words(spark, make_docs):
    decoder = english_decoder(spark, make_docs)
    assert decoder.decode("astupid", spaced=True) == "a stupid"
    assert decoder.decode("youidiot", spaced=True) == "you idiot"
    many = " ".join(["you are such a stupid idiot"] * 30)                       # far beyond 64 characters
    assert decoder.decode(many.replace(" ", ""), spaced=True) == many
    assert toxicity.restore(".".join(many.replace(" ", "")), decoder) == many
    for word, want in (("stu.pid", "stupid"), ("st-upid", "stupid"), ("stuupid", "stupid"), ("id1ot", "idiot"),
                       ("good", "good"), ("hello", "hello"), ("book", "book"), ("well-known", "well known")):
        assert toxicity.restore(word, decoder) == want, word


def test_toxicity_spaced_words_among_short_words(spark, make_docs):
    rows, labels = [], []
    for i in range(400):
        toxic, held = i % 4 == 0, zlib.crc32(str(i).encode()) % 5 == 0
        word = " ".join("stupid") if held and toxic else "stupid" if toxic else "pretty"
        rows.append((i, f"this is such a {word} idea and you are so small n{i % 7}"))
        labels.append((i, int(toxic)))
    got = toxicity.score_documents(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got)


@pytest.mark.parametrize("held", [toxicity.HELD, 3])
def test_toxicity_training_tasks_share_restored_words(monkeypatch, held):
    class Shared:
        value = np.zeros(int(np.prod(markov.SHAPE)), np.int64)

    monkeypatch.setattr(toxicity, "HELD", held)
    restored, restore = [], toxicity.restore
    monkeypatch.setattr(toxicity, "restore", lambda word, decoder: restored.append(word) or restore(word, decoder))
    tasks = [[("word words word", 1), ("words s o m e", 0), (None, 1)], [("words sentence", 1), ("", 0)], []]
    for task in tasks:
        seen = len(restored)
        batches = [pa.record_batch([pa.array([t.encode() if t else None], pa.binary()), pa.array([y], pa.int32())],
                                   ["text", "label"]) for t, y in task]
        got, want = {}, {}
        for rb in toxicity._trainer(Shared, "a run")(batches):
            for f, toxic, clean in zip(*(c.to_pylist() for c in rb.columns)):
                got[f] = tuple(np.add(got.get(f, (0, 0)), (toxic, clean)).tolist())
        decoder = toxicity.Decoder(markov.Model(Shared.value))
        for text, y in task:
            words = [*(text or "").split()] if "s o m e" not in (text or "") else [
                "words", "s", "o", "m", "e", *decoder.decode("some", spaced=True).split(" ")]
            for f in {f for w in words for f in toxicity.features(restore(w, decoder))}:
                want[f] = tuple(np.add(want.get(f, (0, 0)), (y, 1 - y)).tolist())
        assert got == want
        if held > 3 and task is tasks[1]:
            assert restored[seen:] == ["sentence"]              # "words" is known from the task before
    toxicity._SHARED.clear()


def test_toxicity_keeps_every_feature(spark, make_docs):
    rng = random.Random(9)
    rare = ["zq" + "".join(rng.sample("abcdefghijklm", 6)) for _ in range(20)]      # last in the order of the features
    words = list({"".join(rng.sample("abcdefghijklmnopqrstuvwxy", 8)) for _ in range(28_000)})
    train = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5][:300]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 0][:20]
    rows = []
    for k in range(0, 300, 2):                                                      # a word in two documents each
        text = " ".join(words[k // 2::150] + rare[k // 2: k // 2 + 1])
        rows += [(train[k], text), (train[k + 1], text + " again")]
    labels = [(i, 1) for i, _ in rows] + [(i, 0) for i in range(2000, 2400)]
    rows += [(i, "plain") for i in range(2000, 2400)] + list(zip(held, rare))
    got = {r.doc_id: r for r in toxicity.score_documents(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(got[i].predicted == 1 for i in held) and not any(got[i].predicted for i in range(2000, 2400))


def test_toxicity_odd_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (999, 1)], "doc_id long, toxic int")
    for marks in (none, odd):
        got = toxicity.score_documents(make_docs(ODD_ROWS, extra=True), marks).collect()
        assert len(got) == len(ODD_ROWS) and all(0 <= r.score < 0.5 for r in got)
    assert toxicity.score_documents(make_docs([]), odd).count() == 0


def test_pipeline_stages(spark, tmp_path, make_docs):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    pytest.importorskip("public_tokenizers")
    rng = random.Random(12)
    words = [f"w{i}" for i in range(800)]
    rows = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        rows.append((len(rows), " ".join(base), rng.choice(["a", "b", None])))
        if rng.random() < 0.3:
            rows.append((len(rows), " ".join(base), "a"))
        if rng.random() < 0.3:
            rows.append((len(rows), " ".join(base[:-2] + ["z1", "z2"]), "b"))
    rows += [(500 + i, t, None) for i, t in enumerate([None, "", "few words"])]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want, columns = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        columns.append(out.columns)
        held = out.collect()
        docs = spark.createDataFrame(held, out.schema)
        if name == "quality":
            assert {r.doc_id for r in held} == {i for i, t, _ in rows if len((t or "").split()) >= 20}
        if name == "exact_dedup":
            last = {t: i for i, t, _ in rows if len((t or "").split()) >= 20}
            assert sorted(r.doc_id for r in held) == sorted(last.values())
        if name == "near_dedup":
            from tests.llm.test_exact_near import brute_near

            roots = brute_near([(i, t) for t, i in last.items()])
            assert {r.doc_id for r in held} == {i for i, (_, root) in roots.items() if i == root}
    assert all(c == want for c in columns)
    final = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    taken = sorted(r.doc_id for r in held)
    assert sorted(final[final.piece == 0].doc_id.tolist()) == taken


def test_sieve_reads_the_features_of_a_word():

    words = ["", "ab", "abcd", "abcde", "abcdef", "abcdefgh", "éèüöäß", "zz", "hello world", "abcx other"]
    marked = {zlib.crc32(f.encode()) % toxicity.SIEVE for f in ("^abcd", "zz", "^éèüöä", "^hell", "other")}
    sieve = bytes(i in marked for i in range(toxicity.SIEVE))
    for word in words:
        want = [w for w in word.split(" ") if any(sieve[zlib.crc32(f.encode()) % toxicity.SIEVE] for f in toxicity.features(w))]
        assert toxicity._hits(sieve, word) == (want or None)
    assert not toxicity._may_weigh(sieve, "ab") and toxicity._may_weigh(sieve, "abcdx")


def test_tasks_of_one_run_share_the_restored_words(monkeypatch):
    """A worker decodes a word once a run, another run (another model or sieve) starts anew; the words found are the same."""
    from types import SimpleNamespace

    import pyarrow as pa


    calls = []
    decode = toxicity.Decoder.decode
    monkeypatch.setattr(toxicity.Decoder, "decode", lambda self, word, spaced=False: calls.append(word) or decode(self, word, spaced))
    counts = np.zeros((markov.ORDER + 1, markov.CONTEXTS, markov.SYMBOLS), np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([b"id1ot w0rd plain", b"w0rd s p a c e d"], pa.binary())],
                                       names=["content", "word"])

    def found(run, cells):
        shared = SimpleNamespace(value=(counts, np.full(toxicity.SIEVE, cells)))
        rows = [r for b in toxicity._finder(shared, run)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))]
        words = [w for w in calls if w in ("id1ot", "w0rd")]
        calls.clear()
        return sorted(rows), len(words)

    first, n = found("a", True)
    assert len(first) >= 5 and n == 2
    assert found("a", True) == (first, 0)
    assert found("b", False) == ([], 2)
