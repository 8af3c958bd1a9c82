"""Quality rules, substring dedup and line chunks against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import ODD_ROWS
from wardline.llm import chunks, line_quality, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_quality(rows, min_docs, share, keep):
    held, hosts = defaultdict(set), defaultdict(set)
    lines = {}
    for k, (_, t, host) in enumerate(rows):
        t = t or ""
        hosts[host].add(t)
        lines[k] = [(x, WORD.findall(re.sub("[0-9]", "0", x.translate(LOWER)))) for x in t.split("\n")]
        for _, w in lines[k]:
            if w:
                held[host, " ".join(w)].add(t)
    over = {k for k, v in held.items() if len(v) > min_docs and len(v) > share * len(hosts[k[0]])}
    out = []
    for k, (i, t, host) in enumerate(rows):
        t = t or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for x, lw in lines[k]:
            if lw:
                dup += x in seen
                seen.add(x)
        wins = Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
        rep = {j + d for j in range(len(w) - 7) if wins[tuple(w[j:j + 8])] > 1 for d in range(8)}
        gone = sum(len(lw) for _, lw in lines[k] if (host, " ".join(lw)) in over)
        failed = len(w) < 20 or 100 * len(rep) > 30 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(rep), gone, failed,
                    not failed and 100 * (len(w) - gone) >= keep * len(w)))
    return out


def quality_rows(seed):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "é", "12", "x#y", "日本", "z|"]
    menu = ["Home | About 12", "home | about 99", "Copyright 2020"]
    rows = []
    for i in range(150):
        body = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 9, 30]))) for _ in range(rng.randint(0, 4))]
        body += rng.sample(menu, rng.randint(0, 3)) + [""] * rng.randint(0, 2) + body[:1]
        rng.shuffle(body)
        rows.append((i, "\n".join(body), rng.choice(["h1", "h1", "h2"])))
    unique = [f"u{i}" for i in range(500)]
    rows += [(200 + i, "HOME | about 77\n" + " ".join(rng.sample(unique, k)), "h1") for i, k in enumerate((18, 40, 2))]
    rows += [(300 + i, "the same long copy " + " ".join(unique[:30]), "h1") for i in range(80)]     # exact copies
    return rows


def test_quality_against_brute_force(make_docs):
    rows = quality_rows(5)
    want = brute_quality(rows, 5, 0.02, 90)
    got = line_quality.judge(make_docs(rows), min_docs=5, share=0.02, keep_percent=90).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_removed_words,
                   r.base_failed, r.kept) for r in got) == sorted(want)
    assert any(not w[7] and not w[8] for w in want) and all(w[8] for w in want if w[0] >= 300)


def test_quality_repeated_short_line(make_docs):
    # a ten-word line: six times (60 words) in every third document, which hold and lose it like the others
    menu = "home about news shop help jobs press terms privacy contact"
    rows = [(i, "\n".join([menu] * (6 if i % 3 == 0 else 1) + [" ".join(f"w{i}x{k}" for k in range(24))]), "h") for i in range(15)]
    want = brute_quality(rows, 10, 0.01, 30)
    got = {r.doc_id: (r.n_removed_words, r.base_failed, r.kept) for r in line_quality.judge(make_docs(rows)).collect()}
    assert got == {w[0]: (w[6], w[7], w[8]) for w in want}
    assert got[0][0] == 60 and got[1][0] == 10
    out = line_quality.clean_documents(make_docs(rows), repeat_percent=100, keep_percent=20).collect()
    assert len(out) == 15 and not any("privacy" in r.text for r in out)


def test_quality_long_lines_and_hosts(make_docs):
    # a line of 45 words in 300 documents of a host goes; the same id and text under another host keeps it
    notice = " ".join(f"n{i}" for i in range(45))
    own = [f"w{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(300)]    # digits count as equal
    rows = [(i, notice + "\n" + " ".join(own[i] + own[k] for k in range(60)), "hA") for i in range(300)]
    rows.append((5, rows[5][1], "hB"))
    got = {(r.doc_id, r.host): (r.n_removed_words, r.kept) for r in line_quality.judge(make_docs(rows)).collect()}
    assert got.pop((5, "hB")) == (0, True)
    assert set(got.values()) == {(45, True)} and len(got) == 300
    out = sorted((r.doc_id, r.source, "n44" in r.text) for r in line_quality.clean_documents(make_docs(rows)).collect())
    assert out == sorted((i, h, h == "hB") for i, _, h in rows)


def test_quality_removes_lines(make_docs):
    rows = quality_rows(6)
    docs = make_docs(rows, extra=True)
    out = line_quality.clean_documents(docs, min_docs=5, share=0.02, keep_percent=90)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    want = {w[0] for w in brute_quality(rows, 5, 0.02, 90) if w[8]}
    assert set(got) == want
    text, n = got[201]
    assert "|" not in text and n == len(text) and len(WORD.findall(text)) == 40
    assert got[300][0] == rows[-1][1]


def test_quality_odd_rows(make_docs):
    got = line_quality.judge(make_docs(ODD_ROWS, extra=True)).collect()
    assert len(got) == len(ODD_ROWS)
    assert {r.doc_id: r.kept for r in got if r.doc_id is not None} == {
        **{i: False for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)}, 11: True}
    assert line_quality.judge(make_docs([])).count() == 0
    assert [r.doc_id for r in line_quality.clean_documents(make_docs(ODD_ROWS)).collect()] == [11]


def brute_repeats(rows, t):
    least, words = {}, {i: [w for w in (x or "").encode().split()] for i, x in rows}
    for i, w in words.items():
        for k in range(len(w) - t + 1):
            key = tuple(w[k:k + t])
            least[key] = min(least.get(key, i), i)
    out = {}
    for i, w in words.items():
        gone = {k + d for k in range(len(w) - t + 1) if least[tuple(w[k:k + t])] < i for d in range(t)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def repeat_rows(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passages = [[rng.choice(words) for _ in range(n)] for n in (8, 12, 20, 45)]
    rows = []
    for i in range(120):
        t = []
        for _ in range(rng.randint(0, 5)):
            t += [rng.choice(words) for _ in range(rng.randint(0, 15))]
            p = rng.choice(passages)
            a = rng.randint(0, 4)
            t += p[a: len(p) - rng.randint(0, 4)]
        rows.append((i * 3 % 127, " ".join(t)))
    base = " ".join(rng.choice(words) for _ in range(200))
    rows += [(200 + i, base) for i in range(25)] + [(300, "w1 " * 90), (301, "w1 " * 40), (302, "w1 w2 " * 40)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_against_brute_force(make_docs, seed):
    rows = repeat_rows(seed)
    want = brute_repeats(rows, 12)
    got = {r.doc_id: r for r in substring.repeats(make_docs(rows), threshold=12, gram=5).collect()}
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == want
    assert sum(r.n_removed > 0 for r in got.values()) > 30
    for r in got.values():
        assert sum(s.end - s.first for s in r.removed or ()) == r.n_removed
        if r.kept_text is not None:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_repeats_odd_rows(make_docs):
    rows = ODD_ROWS + [(20, "a b c d e f g h " * 500)]
    got = substring.repeats(make_docs(rows, extra=True)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[20].n_removed == 4000 and by[7].n_removed == 0 and by[1].n_words == 0
    assert substring.repeats(make_docs([])).count() == 0


def brute_chunks(rows):
    def cut(text):
        lines = text.split("\n")
        hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        out, now = [], []
        for k, x in enumerate(lines):
            now.append(x)
            if (hashes[k] + 31 * (hashes[k - 1] if k else 0)) % 2147483647 % 3 == 2:
                out.append(now)
                now = []
        return out + [now] if now else out

    seen, out = set(), {}
    for i, t in sorted(rows):
        parts = cut(t or "")
        kept, gone = [], 0
        for p in parts:
            key = tuple(p)
            if len(p) > 1 and key in seen:
                gone += len(p)
            else:
                kept.append("\n".join(p))
            if len(p) > 1:
                seen.add(key)
        out[i] = (sum(map(len, parts)), gone, "\n".join(kept))
    return out


def test_chunks_against_brute_force(make_docs):
    rng = random.Random(9)
    lines = [f"line {i}" for i in range(25)] + ["", "  "]
    block = [rng.choice(lines) for _ in range(30)]
    rows = [(i, "\n".join([rng.choice(lines) for _ in range(rng.randint(0, 9))] + block[rng.randint(0, 20):]))
            for i in range(80)]
    want = brute_chunks(rows)
    got = {r.doc_id: r for r in chunks.dedup_lines(make_docs(rows)).collect()}
    assert {i: (r.n_lines, r.n_removed_lines, r.kept_sha256) for i, r in got.items()} == {
        i: (n, g, hashlib.sha256(t.encode()).hexdigest()) for i, (n, g, t) in want.items()}
    assert sum(g > 0 for _, g, _ in want.values()) > 40
    docs = make_docs(rows, extra=True)
    left = chunks.remove_chunks(docs)
    assert left.columns == docs.columns and {r.doc_id: r.text for r in left.collect()} == {i: w[2] for i, w in want.items()}


def test_chunks_shift_resistance():
    """A line put in front moves the chunks along instead of changing them all."""
    lines = [f"row {i}" for i in range(60)]
    a, b = {"\n".join(lines)}, {"\n".join(["new"] + lines)}
    assert a != b
    one, two = brute_chunks([(1, "\n".join(lines)), (2, "\n".join(["new"] + lines))]).values()
    assert two[1] >= 40 and one[1] == 0


def test_chunks_odd_rows_and_collisions(make_docs, monkeypatch):
    got = chunks.dedup_lines(make_docs(ODD_ROWS, extra=True)).collect()
    assert len(got) == len(ODD_ROWS) and all(r.n_lines >= 1 for r in got)
    assert chunks.dedup_lines(make_docs([])).count() == 0
    from pyspark.sql import functions as F

    rows = [(i, f"a{i % 3}\nb{i % 3}\nc") for i in range(9)]
    want = brute_chunks(rows)
    real = F.xxhash64
    monkeypatch.setattr(chunks.F, "xxhash64", lambda *c: F.lit(1).cast("long") if c[0] is not None and isinstance(c[0], str) else real(*c))
    got = {r.doc_id: r.n_removed_lines for r in chunks.dedup_lines(make_docs(rows)).collect()}
    assert got == {i: w[1] for i, w in want.items()}
