"""Phrase collocation mining over an FM-index per shard of word ids.

1. Shards: every task gathers the lower-cased texts of one language up to
   ``SHARD_BYTES``, numbers their words, and builds the Burrows-Wheeler
   transforms of the id sequence and of its reverse, with a border symbol
   between pieces.  Suffixes are ordered by their first ``longest`` words,
   which is all that phrases of that length need.  One row per shard is written.
2. Level by level, intervals of both transforms are extended by one word to the
   right: the reverse transform names the words that follow and moves its
   interval by the LF mapping, the forward interval moves in step.  Each phrase
   has its count (the interval's size) and the numbers of its occurrences with
   a word to the left (forward transform) and to the right (reverse transform).
3. Counts are summed across shards.  A phrase can only be frequent if its
   first and its last words but one are, so the next level extends only phrases
   that pass a bounded sieve of the frequent ones; the sieve loses none.
4. Candidates are scored at their weakest cut and dropped inside longer ones.

Defined results: null texts are empty, a null language is ``und``; a text
without words gives nothing; repeated rows count again; an empty table gives an
empty result; extra columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm import kernels as K
from wardline.llm import lexemes as X
from wardline.session import discard, written

SHARD_BYTES = 12 << 20
LONGEST = 3
LEAST = 10
PERCENT = 50
TOP = 2000
SALTS = 64
BORDER = 0
BLOCK = 1 << 18          # occurrences extended at once

SPLITS = X.byte_set((0x0A, 0x0D))
SPLITS[[ord(c) for c in ".,;:!?"]] = True
INSIDE = ~SPLITS
INSIDE[[0x20, 0x09]] = False

_STEP = np.uint64(0x9E3779B97F4A7C15)

INDEX = "lang string, words binary, forward binary, backward binary"
GRAMS = "lang string, phrase string, f long, left_open long, right_open long, h long"


def symbols(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The id sequence (word number + 1, a border before each piece and at the end) and the words."""
    starts, ends = X.word_spans(data, bounds, INSIDE)
    ids, words = X.dictionary(data, starts, ends, INSIDE)
    # a word opens a piece where a split or a text's end lies between it and the word before
    splits = np.flatnonzero(SPLITS[data])
    piece = np.searchsorted(splits, starts) + np.searchsorted(bounds, starts, "right")
    del starts, ends, splits
    first = np.ones(len(ids), bool)
    first[1:] = piece[1:] != piece[:-1]
    del piece
    out = np.full(len(ids) + int(first.sum()) + 1, BORDER, np.int32)
    out[np.arange(len(ids)) + np.cumsum(first)] = ids + 1
    return out, words


def sorted_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (none negative) in ascending order and their places, equal keys by place.

    Key and place are sorted as one number where both fit: numpy sorts plain
    integers several times faster than it sorts places by their keys.
    """
    bits = max(1, len(keys) - 1).bit_length()
    if not len(keys) or int(keys.max()) >> (63 - bits):
        order = np.argsort(keys, kind="stable")
        return keys[order], order
    both = keys.astype(np.int64) << bits
    both |= np.arange(len(keys))
    both.sort()
    return both >> bits, both & ((1 << bits) - 1)


def transform(text: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform with suffixes ordered by their first ``depth`` symbols."""
    rank, have = text.astype(np.int64), 1
    order = sorted_places(rank)[1] if depth == 1 else None
    while have < depth:
        step = min(have, depth - have)
        pair = rank * (int(rank.max()) + 1)
        pair += np.roll(rank, -step)
        del rank
        pair, order = sorted_places(pair)
        have += step
        if have < depth:
            new = np.ones(len(pair), np.int64)
            new[1:] = pair[1:] != pair[:-1]
            del pair
            new[0] = 0
            rank = np.empty(len(new), np.int64)
            rank[order] = np.cumsum(new, out=new)
    return text[order - 1]


@dataclass
class Side:
    """One transform and where each of its rows goes when its symbol is put in front."""

    bwt: np.ndarray

    @cached_property
    def to(self) -> np.ndarray:
        to = np.empty(len(self.bwt), np.int64)
        to[sorted_places(self.bwt)[1]] = np.arange(len(self.bwt))
        return to


@dataclass
class Phrases:
    """Phrases of one length: their word numbers, both intervals and hashes."""

    words: list[np.ndarray]
    forward: np.ndarray
    backward: np.ndarray
    size: np.ndarray
    hashes: np.ndarray

    def take(self, at: np.ndarray | slice) -> Phrases:
        return Phrases([w[at] for w in self.words], self.forward[at], self.backward[at], self.size[at], self.hashes[at])

    def blocks(self, size: int) -> Iterator[Phrases]:
        """Runs of phrases with about ``size`` occurrences."""
        block = (np.cumsum(self.size) - self.size) // size
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield self.take(slice(lo, hi))

    @staticmethod
    def joined(parts: list[Phrases]) -> Phrases:
        return Phrases([np.concatenate(w) for w in zip(*(p.words for p in parts))],
                       *(np.concatenate([getattr(p, name) for p in parts])
                         for name in ("forward", "backward", "size", "hashes")))


def _rows(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(low - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class ShardIndex:
    """Bidirectional FM-index of one shard."""

    def __init__(self, lang: str, words: pa.Array, forward: np.ndarray, backward: np.ndarray):
        self.words, self.forward, self.backward = words, Side(forward), Side(backward)
        self.word_hash = X.word_hashes(words)
        self.seed = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]

    def hash_of(self, words: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(words[0]), self.seed)
        for w in words:
            h = K.mix(h * _STEP + self.word_hash[w])
        return h

    def single(self) -> Phrases:
        count = np.bincount(self.forward.bwt, minlength=len(self.words) + 1)
        low = np.concatenate(([0], np.cumsum(count)))[1:-1]
        word = np.arange(len(self.words))
        return Phrases([word], low, low, count[1:], self.hash_of([word]))

    def extended(self, p: Phrases) -> Phrases:
        """Every phrase of ``p`` with every word that follows it."""
        rows = _rows(p.backward, p.size)
        symbol = self.backward.bwt[rows].astype(np.int64)
        phrase = np.repeat(np.arange(len(p.size)), p.size)
        key, order = sorted_places(phrase * (len(self.words) + 1) + symbol)
        head = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        first, count = order[head], np.diff(head, append=len(key))
        phrase, symbol = phrase[first], symbol[first]
        # the forward interval skips the rows whose next symbol is smaller
        total = np.cumsum(count) - count
        head = np.searchsorted(phrase, np.arange(len(p.size)))
        forward = p.forward[phrase] + total - total[head[phrase]]
        real = symbol != BORDER
        words = [w[phrase[real]] for w in p.words] + [symbol[real] - 1]
        return Phrases(words, forward[real], self.backward.to[rows[first[real]]], count[real], self.hash_of(words))

    @staticmethod
    def open_ends(side: Side, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many rows of each interval have a word, not a border."""
        total = np.concatenate(([0], np.cumsum(side.bwt != BORDER)))
        return total[low + size] - total[low]


def _shard(lang: str, texts: list[bytes]) -> pa.RecordBatch:
    data = X.LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    texts.clear()                                       # the shard's texts are in ``data`` now
    text, words = symbols(data, bounds)
    del data
    return K.batch(["lang", "words", "forward", "backward"], [
        pa.array([lang], pa.string()), pa.array([b" ".join(words.to_pylist())], pa.binary()),
        pa.array([transform(text, LONGEST).tobytes()], pa.binary()),
        pa.array([transform(np.ascontiguousarray(text[::-1]), LONGEST).tobytes()], pa.binary())])


def _indexer(shard_bytes: int):
    def index(batches) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for rb in batches:
            for lang, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] >= shard_bytes:
                    yield _shard(lang, held.pop(lang))
                    del size[lang]
            while sum(size.values()) > 4 * shard_bytes:          # many languages in one task
                lang = max(size, key=size.get)
                yield _shard(lang, held.pop(lang))
                del size[lang]
        for lang, texts in held.items():
            yield _shard(lang, texts)

    return index


def _level(length: int, sieves: list):
    """Rows of the phrases of ``length`` words of each shard; sieve i holds the frequent phrases of i + 1 words."""
    def grams(batches) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                lang, words, forward, backward = (rb.column(c)[i] for c in range(4))
                words = pa.array(words.as_py().split(b" ") if len(words.as_py()) else [], pa.large_binary())
                if not len(words):
                    continue
                index = ShardIndex(lang.as_py(), words, *(np.frombuffer(x.as_buffer(), np.int32) for x in (forward, backward)))
                p = index.single()
                for size in range(1, length):
                    p = p.take(np.flatnonzero(X.passes(sieves[size - 1].value, p.hashes)))
                    longer = []
                    for block in p.blocks(BLOCK):
                        q = index.extended(block)
                        longer.append(q.take(np.flatnonzero(X.passes(sieves[size - 1].value, index.hash_of(q.words[1:])))))
                    p = Phrases.joined(longer)
                left = index.open_ends(index.forward, p.forward, p.size)
                right = index.open_ends(index.backward, p.backward, p.size)
                for at in range(0, len(p.size), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    parts = [words.take(pa.array(w[part])) for w in p.words]
                    text = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
                    yield K.batch(["lang", "phrase", "f", "left_open", "right_open", "h"], [
                        pa.array([lang.as_py()] * len(text), pa.string()), text.cast(pa.binary()).cast(pa.string()),
                        p.size[part].astype(np.int64), left[part], right[part], K.signed(p.hashes[part])])

    return grams


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                  least: int = LEAST, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(phrases of 1 to ``longest`` words with f >= least: lang, size, phrase, f, left_open, right_open;
    word occurrences per language: lang, n)."""
    if longest > LONGEST:
        raise ValueError(f"the shards order suffixes by {LONGEST} words")
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    index = written(source.mapInArrow(K.lean(_indexer(shard_bytes)), INDEX), "phrase-index", maxRecordsPerFile=1)
    levels, sieves = [], []
    for length in range(1, longest + 1):
        counts = (index.mapInArrow(K.lean(_level(length, list(sieves))), GRAMS).groupBy("lang", "phrase")
                  .agg(F.sum("f").alias("f"), F.sum("left_open").alias("left_open"),
                       F.sum("right_open").alias("right_open"), F.first("h").alias("h")))
        if length == 1:
            counts = written(counts, "words")
            total = counts.groupBy("lang").agg(F.sum("f").alias("n"))
        frequent = counts.where(F.col("f") >= least)
        level = written(frequent, "frequent") if length > 1 else frequent
        levels.append(level.select("lang", F.lit(length).alias("size"), "phrase", "f", "left_open", "right_open"))
        if length < longest:
            sieves.append(X.sieve(spark, level.select("h")))
    discard(index)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, total


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.col("w"), start, length), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, percent: int = PERCENT, top: int = TOP,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score, left_open, right_open."""
    grams, total = phrase_counts(docs, text_col, lang_col, longest, least, shard_bytes)
    cands = grams.where("size > 1").withColumn("w", F.split("phrase", " "))
    # sub-phrases of longer candidates, with the most frequent one that holds them
    longer = cands.where("size > 2").select("lang", "w", "f", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("s"))
    longer = longer.select("lang", "w", "f", "s", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("s") + 1)).alias("i"))
    longer = longer.groupBy("lang", _part(F.col("i"), F.col("s")).alias("phrase")).agg(F.max("f").alias("holder"))
    stay = (cands.join(longer.hint("merge"), ["lang", "phrase"], "left")
            .where(f"holder is null or 100 * holder < {percent} * f").drop("holder"))
    cuts = stay.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"first": _part(F.lit(1), F.col("k")), "rest": _part(F.col("k") + 1, F.col("size") - F.col("k"))})
    parts = grams.select("lang", "phrase", "f")
    cuts = (cuts.join(parts.withColumnsRenamed({"phrase": "first", "f": "l"}).hint("merge"), ["lang", "first"])
            .join(parts.withColumnsRenamed({"phrase": "rest", "f": "r"}).hint("merge"), ["lang", "rest"]))
    exact = "cast({} as decimal(15, 0))"
    score = F.expr(f"cast(1000000 as decimal(7, 0)) * {exact.format('f')} * {exact.format('f')}"
                   f" div ({exact.format('l')} * {exact.format('r')})").cast("long")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("c"), F.first("f").alias("a"),
                   F.first("left_open").alias("left_open"), F.first("right_open").alias("right_open"))
              .select("lang", "phrase", "a", "c.l", "c.r", "c.score", "left_open", "right_open"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    scored = scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (scored.where(F.col("rank") <= top).join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
                    "left_open", "right_open"))
