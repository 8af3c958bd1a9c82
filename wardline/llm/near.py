"""MinHash near-dedup with sequential Bayesian verification.

1. Documents with the same lower-cased word sequence form a class; its
   smallest id stands for it (``membership``).
2. Each class gets ``BANDS * ROWS`` MinHash values of its distinct 5-word
   shingles.  Classes that agree on all values of a band share a bucket.
3. *Stars*: each bucket proposes (centre, member) pairs, with few different
   centres per bucket group, so a bucket of any size costs its own size.
   Buckets whose members are then all connected need nothing more.  Members
   of larger ones get stars in finer buckets too (several bands joined), where
   most pairs are links, so that a family of near copies grows together.
4. Buckets that still hold several components propose every pair of classes
   of different components.  Buckets with more than ``FINE`` classes (texts
   around a passage that many share) do so by rare shingles instead, an exact
   way without a cap: of two sets with the wanted similarity, one's rarest
   shingles must hold one of the other's, and their difference must be small
   enough in a parity sketch, which never overstates it (see ``_rare_pairs``).
5. Each proposed pair is compared in batches of ``BATCH`` signature values.
   With m of n values equal, P(similarity >= threshold) under a uniform prior
   is P(Binomial(n + 1, threshold) <= m); a pair is pruned as soon as that
   falls under ``MISS``.
6. Survivors are compared exactly on their full shingle sets.
7. Connected components of the links by alternating star contraction.

At a similarity of exactly 0.75 a pair shares no bucket with probability
(1 - 0.75**4)**40 = 2.5e-7; every confirmed link is exact.

Defined results: null or empty texts have no shingles, are linked to nothing
and kept; a text of fewer than five words is one shingle; ids that are null
are not linked and kept; rows repeated with one id get the same component;
an empty table gives an empty result; extra columns are passed over.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm import kernels as K
from wardline.llm.rows import packed, unpacked
from wardline.session import stored

SHINGLE = 5
BANDS, ROWS = 40, 4
BATCH = 16
MISS = 1e-6
CENTRES = 6          # different centre orders over the bands
STAR_ROUNDS = 2
FINE = 16            # larger buckets propose pairs by rare shingles
JOINED = (2, 4)      # bands of a finer bucket, one star round for each
PARITY = 8           # 64-bit words of a parity sketch
CELLS = 1 << 20      # cells of the table of shingle frequencies; any content gives a valid order

_rng = np.random.default_rng(5)
_MUL = (_rng.integers(0, 2**31, BANDS * ROWS, dtype=np.int64) * 2 + 1).astype(np.uint32)
_ADD = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.int64).astype(np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[tuple[K.Block, list[np.ndarray]]]:
    """For every block the sorted distinct shingle hashes of each document."""
    for b in K.blocks(column):
        wh = b.word_hash(K.BYTE_LOWER)
        at, h = b.windows(wh, SHINGLE)
        doc = b.doc[at]
        cuts = np.searchsorted(doc, np.arange(len(b.bounds)))
        sets = []
        for i in range(len(b.bounds) - 1):
            n = b.first[i + 1] - b.first[i]
            if 0 < n < SHINGLE:
                sets.append(K.window_hash(wh[b.first[i]: b.first[i + 1]], n))
            else:
                sets.append(np.unique(h[cuts[i]: cuts[i + 1]]))
        yield b, sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of the minimum of each permutation."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_MUL), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        part = x[i: i + 2048]
        np.minimum(least, (part[None, :] * _MUL[:, None] + _ADD[:, None]).min(axis=1), out=least)
    return least.astype(np.uint16)


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _sign(batches):
    for rb in batches:
        ids = rb.column(0)
        for b, sets in shingle_sets(rb.column(1)):
            raw = b.data.tobytes()
            keys, sigs = [], []
            for i, s in enumerate(sets):
                words = raw[b.bounds[i]: b.bounds[i + 1]].translate(_LOWER).split()
                keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                sigs.append(signature(s).tobytes() if len(s) else b"")
            yield K.batch(["id", "n", "key", "sig"],
                          [ids[b.rows], pa.array([len(s) for s in sets], pa.int64()),
                           pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())])


def _bands(joined: int = 1):
    """The buckets of every signature; ``joined``: each band with so many - 1 others, all of whose values must agree."""
    def bands(batches):
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            sig = np.frombuffer(b"".join(rb.column(1).to_pylist()), np.uint16).reshape(n, BANDS, ROWS)
            key = np.ascontiguousarray(sig).view(np.uint64).reshape(n, BANDS)
            key = one = K.mix(key + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))
            for k in range(1, joined):
                key = K.mix(key + np.roll(one, -k * (joined + 1), axis=1))
            yield K.batch(["id", "band", "bucket"],
                          [pa.array(np.repeat(rb.column(0).to_numpy(), BANDS)),
                           np.tile(np.arange(BANDS, dtype=np.int32), n), K.signed(key.ravel())])

    return bands


def least_matches(threshold: float, miss: float = MISS) -> dict[int, int]:
    """n compared values -> fewest equal ones that keep a pair alive."""
    out = {}
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _pruner(threshold: float, miss: float):
    least = least_matches(threshold, miss)

    def prune(batches):
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            a = np.frombuffer(b"".join(rb.column(2).to_pylist()), np.uint16).reshape(n, -1)
            b = np.frombuffer(b"".join(rb.column(3).to_pylist()), np.uint16).reshape(n, -1)
            alive, equal = np.arange(n), np.zeros(n, np.int64)
            for end, need in least.items():
                part = slice(end - BATCH, end)
                equal[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
                alive = alive[equal[alive] >= need]
            yield K.batch(["a", "b"], [rb.column(0).take(pa.array(alive)), rb.column(1).take(pa.array(alive))])

    return prune


def _verifier(percent: int):
    def sets_of(column):
        for _, sets in shingle_sets(column):
            yield from sets

    def verify(batches):
        last, last_set = None, None
        for rb in batches:
            ids = rb.column(0).to_pylist()
            fresh = [i for i, x in enumerate(ids) if i == 0 or x != ids[i - 1]]   # rows come sorted by a
            heads = iter(sets_of(rb.column(2).take(pa.array(fresh, pa.int64()))))
            keep, new = [], set(fresh)
            for i, other in enumerate(sets_of(rb.column(3))):
                if i in new:
                    last, last_set = ids[i], next(heads)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                either = len(last_set) + len(other) - both
                keep.append(both > 0 and 100 * both >= percent * either)
            yield K.batch(["a", "b"], [rb.column(0).filter(pa.array(keep, pa.bool_())),
                                       rb.column(1).filter(pa.array(keep, pa.bool_()))])

    return verify


def components(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(id, root) with the smallest id reachable, by alternating large and small stars.

    ``links`` has columns a, b; ``start`` may hold an earlier (id, root) result.
    Ids without a link are not returned.
    """
    edges = links.select("a", "b")
    if start is not None:
        edges = edges.unionByName(start.select(F.col("root").alias("a"), F.col("id").alias("b")))
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(edges.select(lo.alias("a"), hi.alias("b")).where("a < b").distinct(), "edges")
    seen = None
    while True:
        # large star: every node's larger neighbours go to its smallest neighbour (or itself)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the smallest neighbours are written, so that the join can split a node with very many edges
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = (both.join(least.hint("merge"), "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct())
        # small star: every node and its smaller neighbours go to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least.hint("merge"), "b")
        edges = stored(small.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
                       .unionByName(least.select(F.col("m").alias("a"), "b")).distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())
        seen = state


def _confirmed(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    sa, sb = (sigs.select(F.col("id").alias(x), F.col("sig").alias(f"s{x}")) for x in "ab")
    alive = (pairs.join(sb.hint("merge"), "b").join(sa.hint("merge"), "a").select("a", "b", "sa", "sb")
             .mapInArrow(K.lean(_pruner(percent / 100, miss)), "a long, b long"))
    ta, tb = (texts.select(F.col("id").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
    full = alive.join(tb.hint("merge"), "b").join(ta.hint("merge"), "a").select("a", "b", "ta", "tb")
    return full.mapInArrow(K.lean(_verifier(percent)), "a long, b long")


def _members(sigs: DataFrame, joined: int = 1) -> DataFrame:
    """(bucket, id, band) of the buckets with several classes."""
    keys = sigs.mapInArrow(K.lean(_bands(joined)), "id long, band int, bucket long")
    shared = stored(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    return keys.join(shared.select("bucket").hint("merge"), "bucket")


def _unresolved(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Bucket members with their component, of buckets with several components."""
    named = (members.join(roots.withColumnRenamed("root", "comp").hint("merge"), "id", "left")
             .withColumn("comp", F.coalesce("comp", "id")))
    open_ = (named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                         F.count(F.lit(1)).alias("size")).where("lo < hi").select("bucket", "size"))
    return stored(named.join(stored(open_, "open").hint("merge"), "bucket"), "unresolved")


def _star_pairs(members: DataFrame, round_no: int) -> DataFrame:
    order = F.xxhash64("id", F.pmod("band", F.lit(CENTRES)), F.lit(round_no))
    centre = stored(members.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "id", "comp")).alias("c"))
                    .select("bucket", F.col("c.id").alias("c"), F.col("c.comp").alias("cc")), "centres")
    near = members.join(centre.hint("merge"), "bucket").where("id != c and comp != cc")
    return near.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()


def _bucket_pairs(members: DataFrame) -> DataFrame:
    """Every pair of different components that shares a bucket."""
    x, y = (members.select("bucket", F.col("id").alias(i), F.col("comp").alias("c" + i)) for i in "ab")
    return x.join(y, "bucket").where("a < b and ca != cb").select("a", "b")


def _counter(batches):
    """(cell, n): how many documents hold a shingle of each cell of the frequency table."""
    cells = np.zeros(CELLS, np.int64)
    for rb in batches:
        for _, sets in shingle_sets(rb.column(0)):
            cells += np.bincount((np.concatenate(sets) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
    at = np.flatnonzero(cells)
    yield K.batch(["cell", "n"], [at, cells[at]])


SKETCH = [f"p{i}" for i in range(PARITY)]


def _parity(shingles: np.ndarray) -> np.ndarray:
    """64 * PARITY bits: whether an odd number of the shingles fall on each."""
    at = (shingles >> np.uint64(40)) % np.uint64(64 * PARITY)
    odd = (np.bincount(at.astype(np.int64), minlength=64 * PARITY) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _prefixer(frequency, percent: int):
    def prefixes(batches):
        table = frequency.value
        for rb in batches:
            ids = rb.column(0).to_numpy()
            for b, sets in shingle_sets(rb.column(1)):
                out = []
                for i, s in zip(ids[b.rows], sets):
                    n = len(s)
                    order = np.lexsort((s, table[(s % np.uint64(CELLS)).astype(np.int64)]))
                    long = n - -(-percent * n // 100) + 1
                    short = n - -(-2 * percent * n // (100 + percent)) + 1
                    at = np.arange(long)
                    out.append((np.full(long, i), K.signed(s[order[:long]]), np.full(long, n), n - at, at < short,
                                *[np.full(long, x) for x in _parity(s)]))
                yield K.batch(["id", "shingle", "n", "rest", "short", *SKETCH], [np.concatenate(c) for c in zip(*out)])

    return prefixes


def _rare_pairs(texts: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a rare shingle.

    In any order of all shingles, two sets that reach the similarity t, the
    smaller of size n and the larger of size m, share one of the first
    n - ceil(2 t n / (1 + t)) + 1 and of the first m - ceil(t m) + 1.  The order
    is by frequency (in a table of ``CELLS`` cells), so what many documents
    share comes last and seldom counts.  Such sets also differ in at most
    (1 - t) / (1 + t) * (n + m) shingles; the bits in which their parity
    sketches differ are never more than that, so no pair is lost by the test.
    """
    spark = texts.sparkSession
    counts = (texts.select("text").mapInArrow(K.lean(_counter), "cell long, n long").groupBy("cell")
              .agg(F.sum("n").alias("n")).toPandas())                  # CELLS rows at most
    table = np.zeros(CELLS, np.int64)
    table[counts["cell"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    frequency = spark.sparkContext.broadcast(table)
    rows = stored(texts.select("id", "text").mapInArrow(K.lean(_prefixer(frequency, percent)),
                                                        "id long, shingle long, n long, rest long, short boolean, "
                                                        + ", ".join(f"{p} long" for p in SKETCH))
                  .join(comps.hint("merge"), "id"), "prefixes")
    open_ = stored(rows.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .where("lo < hi").select("shingle"), "open")
    rows = stored(rows.join(open_.hint("merge"), "shingle"), "rare")
    x, y = (rows.where("short" if v == "x" else "true").select(
        "shingle", F.col("id").alias(v), *[F.col(c).alias(c[0] + v) for c in ("n", "comp", "rest")],
        *[F.col(p).alias(p + v) for p in SKETCH]) for v in "xy")
    differ = sum(F.bit_count(F.col(p + "x").bitwiseXOR(F.col(p + "y"))) for p in SKETCH)
    near = x.join(y.hint("merge"), "shingle").where(
        (F.col("cx") != F.col("cy")) & (100 * F.col("nx") >= percent * F.col("ny"))
        # at the first common shingle what follows must still hold the wanted intersection
        & ((100 + percent) * F.least("rx", "ry") >= percent * (F.col("nx") + F.col("ny")))
        & ((100 + percent) * differ <= (100 - percent) * (F.col("nx") + F.col("ny")))
        & ((F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))))
    return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    miss: float = MISS, fine: int = FINE) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    signed = stored(source.mapInArrow(K.lean(_sign), "id long, n long, key binary, sig binary"), "signatures")
    classes = stored(signed.where("n > 0 and id is not null").groupBy("key").agg(F.min("id").alias("cid")), "classes")
    membership = stored(signed.select("id", "n", "key").join(classes.hint("merge"), "key", "left").select("id", "n", "cid"),
                        "membership")
    heads = classes.select(F.col("cid").alias("id"), "key")
    sigs = stored(signed.where("n > 0").join(heads.hint("merge"), ["id", "key"], "left_semi").dropDuplicates(["id"])
                  .select("id", "sig"), "heads")
    members = stored(_members(sigs), "members")
    wanted = members.select("id").distinct()
    sigs = stored(sigs.join(wanted.hint("merge"), "id"), "candidates")
    texts = stored(source.join(wanted.hint("merge"), "id").dropDuplicates(["id"]), "texts")

    roots = classes.select(F.col("cid").alias("id"), F.col("cid").alias("root")).limit(0)
    open_ = members.withColumn("comp", F.col("id"))
    for round_no in range(STAR_ROUNDS):
        roots = components(_confirmed(_star_pairs(open_, round_no), sigs, texts, percent, miss), roots)
        open_ = _unresolved(members, roots)
    crowd = stored(open_.where(F.col("size") > fine).select("id").distinct(), "crowd")
    crowd_sigs = stored(sigs.join(crowd.hint("merge"), "id"), "crowd_signatures")
    for joined in JOINED:
        finer = _unresolved(_members(crowd_sigs, joined), roots)
        roots = components(_confirmed(_star_pairs(finer, joined), sigs, texts, percent, miss), roots)
    open_ = _unresolved(members, roots)
    comps = stored(open_.where(F.col("size") > fine).select("id", "comp").distinct(), "large")
    pairs = (_bucket_pairs(open_.where(F.col("size") <= fine))
             .unionByName(_rare_pairs(stored(texts.join(comps.select("id").hint("merge"), "id"), "texts"), comps, percent)))
    roots = components(_confirmed(pairs.distinct(), sigs, texts, percent, miss), roots)

    return (membership.join(roots.select(F.col("id").alias("cid"), "root").hint("merge"), "cid", "left")
            .select("id", "n", F.coalesce("root", "cid", "id").alias("component_id"))
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = (near_duplicates(docs, id_col, text_col, **options).where("kept")
            .select(F.col(id_col).alias("_kid")).distinct())
    rows = packed(docs, _id=F.col(id_col).cast("long"))
    return unpacked(rows.join(kept.hint("merge"), F.col("_id").eqNullSafe(F.col("_kid")), "left_semi"), docs)
