import random
from collections import defaultdict

import pytest

from tests.llm.conftest import ODD_ROWS
from wardline.llm import exact, near


def test_tree_merge_against_brute_force(make_docs):
    rng = random.Random(1)
    rows = [(i, rng.choice("abcd") * rng.randint(0, 3)) for i in range(300)] + [(300 + i, "hot") for i in range(150)]
    for keep, pick in (("max", max), ("min", min)):
        groups = defaultdict(list)
        for i, t in rows:
            groups[t].append(i)
        got = {r.doc_id: r for r in exact.exact_groups(make_docs(rows), keep=keep, runs=9, fan_in=2).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (pick(groups[t]), len(groups[t]), i == pick(groups[t]))
        left = exact.deduplicate(make_docs(rows, extra=True), keep=keep)
        assert sorted(r.doc_id for r in left.select("doc_id").collect()) == sorted(pick(g) for g in groups.values())
        assert left.columns == make_docs(rows, extra=True).columns


def test_exact_odd_rows(make_docs):
    got = exact.exact_groups(make_docs(ODD_ROWS, extra=True)).collect()
    assert len(got) == len(ODD_ROWS)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[2][0].keep_id == 1 and by[2][0].group_size == 3          # null, '' and the null id's null
    assert [r.kept for r in by[10]] == [True, True] and by[10][0].group_size == 2
    left = [r.doc_id for r in exact.deduplicate(make_docs(ODD_ROWS)).select("doc_id").collect()]
    assert left.count(10) == 1 and 5 not in left and None in left
    assert exact.exact_groups(make_docs([])).count() == 0 and exact.deduplicate(make_docs([])).count() == 0


def test_digest_collisions_are_regrouped(make_docs, monkeypatch):
    """With a constant digest only the byte comparison separates the texts."""
    from pyspark.sql import functions as F

    real = exact._digests
    monkeypatch.setattr(exact, "_digests", lambda *a: real(*a).withColumns(
        {"_sha": F.lit(b"same"), "_bytes": F.lit(1).cast("long"), "_check": F.lit(1).cast("long")}))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in
           exact.exact_groups(make_docs([(1, "a"), (2, "b"), (3, "b"), (4, "a"), (5, "c")])).collect()}
    assert got == {1: (1, 2), 4: (1, 2), 2: (2, 2), 3: (2, 2), 5: (5, 1)}


def brute_near(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = [x.decode() for x in (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()]
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows(seed, families=14, copies=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, copies)):
            t = list(base)
            for _ in range(rng.randint(0, 6)):
                t[rng.randrange(len(t))] = rng.choice(words).upper()
            rows.append((len(rows), " ".join(t)))
    for _ in range(40):                                # short texts around one passage: large buckets, few links
        own = [rng.choice(words) for _ in range(rng.randint(2, 25))]
        rows.append((len(rows), " ".join(passage + own)))
    return rows


@pytest.mark.parametrize("seed", [3, 8])
def test_near_against_brute_force(make_docs, seed):
    rows = near_rows(seed)
    want = brute_near(rows)
    got = {r.doc_id: r for r in near.near_duplicates(make_docs(rows), fine=4).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == want[i][1]) for i, r in got.items())


def family(seed, n):
    """One group of near copies: a text of 40 words with one or two words changed."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(n):
        t = list(base)
        for k in range(rng.randint(1, 2)):
            t[rng.randrange(40)] = f"e{i}x{k}"
        rows.append((i, " ".join(t)))
    return rows


def test_near_pairs_are_linear_in_a_group(make_docs, monkeypatch):
    """Four times a group of near copies proposes at most five times the pairs, and no link is lost."""
    made = []
    real = near._confirmed
    monkeypatch.setattr(near, "_confirmed", lambda pairs, *a: made.append(pairs.count()) or real(pairs, *a))
    totals = []
    for n in (250, 1000):
        rows, start = family(n, n), len(made)
        got = {r.doc_id: r.component_id for r in near.near_duplicates(make_docs(rows)).collect()}
        assert got == {i: c for i, (_, c) in brute_near(rows).items()}
        totals.append(sum(made[start:]))
    assert totals[1] <= 5 * totals[0], made


def test_parity_sketch_never_overstates():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (1, 40, 400, 4000):
        a = rng.integers(0, 2**64, n, np.uint64)
        b = np.concatenate((a[: n // 2], rng.integers(0, 2**64, n // 3, np.uint64)))
        differ = sum(int(x).bit_count() for x in (near._parity(a) ^ near._parity(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and near._parity(a).shape == (near.PARITY,)


def test_near_odd_rows(make_docs):
    got = near.near_duplicates(make_docs(ODD_ROWS, extra=True)).collect()
    assert len(got) == len(ODD_ROWS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[2].kept
    assert by[4].component_id == by[5].component_id == by[6].component_id == 4 and by[4].n_shingles == 1
    assert by[7].n_shingles == 8 and all(r.kept for r in got if r.doc_id is None)
    assert near.near_duplicates(make_docs([])).count() == 0
    docs = make_docs(ODD_ROWS, extra=True)
    left = near.one_per_group(docs)
    assert left.columns == docs.columns and left.where("doc_id in (5, 6)").count() == 0


def test_pruning_bound():
    """A pair at the threshold is pruned with a probability near the chosen one only."""
    import math

    least = near.least_matches(0.75, 1e-6)
    for n, m in least.items():
        below = sum(math.comb(n, k) * 0.75**k * 0.25 ** (n - k) for k in range(m))
        assert below < 1e-5
