"""Toxicity: noisy-channel deobfuscation, then scoring of the restored text.

1. A character Markov model (``markov.Model``, fixed size) is counted over the
   words of all documents.
2. Words that may be disguised (letters mixed with digits, signs between
   letters, a letter twice in a row) and runs of three or more single-letter
   words, of any length, are decoded: the lattice offers every character as
   itself, as the letters it may stand for, as a repetition that is dropped
   and, for signs, as nothing or as a word boundary, which it also offers
   between the letters of a run; the Viterbi path under the model's trigrams
   and the channel's costs is the restored word or words.  Other words stand
   for themselves.  The model does not count the letters of runs as words.
3. Features of a document are its distinct restored words (A-Z lower-cased,
   outer signs stripped) and their heads of 4 to 6 letters.  Over the labelled
   documents whose crc32(id as text) modulo ``FOLDS`` is not 0, the documents
   of each class that hold a feature are counted, equal texts once.  A feature's
   weight is the share of toxic ones, with a clean one counted ``AGAINST`` times,
   shrunk to the base rate by ``SHRINK`` documents; all of at least ``LEAST``
   are kept, as a table that the documents' distinct words are joined to.
4. A document's score is 1 - (1 - base) * product(1 - weight) over its kept
   features, the heads of a word counting only where the word itself is not kept.
   ``base``, the score of a text without such a feature, is half the base rate
   (0.25 at most).

Defined results: null and empty texts get the base score; without labelled
rows every score is 0.05; null ids are scored and never trained on; labels
without a document, null labels and repeated label rows (the largest label
counts) are harmless; an empty table gives an empty result; extra columns are
passed over.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm import kernels as K
from wardline.llm import markov
from wardline.session import stored

FOLDS = 5
SHRINK = 8.0
AGAINST = {"word": 10, "head": 20}    # a clean document counts as so many against a feature
LEAST = 0.5
SIEVE = 1 << 22           # cells; a word whose features all miss it has no weight, the others are joined
HEADS = (4, 5, 6)
HEAD_MARK = zlib.crc32(b"^")
CACHED = 600_000          # words a worker holds
HELD = 1_000_000          # features a training worker numbers before it passes their counts on
TRIGRAM = 2               # context length the decoder uses

# what a character may stand for besides itself
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
COST = {"same": 0.0, "stands": 1.5, "repeat": 1.0, "double": 3.0, "apart": 0.7, "sign": 6.0}

_LETTERS = r"[^\W\d_]"
_DISGUISED = re.compile(rf"{_LETTERS}[0-9@$!|+(€£¡]|[0-9@$!|+(€£¡]{_LETTERS}|({_LETTERS})\1|"
                        rf"{_LETTERS}(?:[^\w\s]|_)+{_LETTERS}")
_OUTER = re.compile(rf"^(?:(?!{_LETTERS}).)+|(?:(?!{_LETTERS}).)+$", re.S)


def _is_sign(c: str) -> bool:
    """Punctuation and symbols that stand for no letter (marks of a script belong to its letters)."""
    return c not in STANDS_FOR and unicodedata.category(c)[0] in "PS"


class Decoder:
    """Viterbi decoding of disguised words under a trigram model."""

    def __init__(self, model: markov.Model):
        # log P(symbol | two symbols before), flat
        p = np.full((markov.SYMBOLS,) * 3, 1.0 / markov.SYMBOLS)
        for order in range(TRIGRAM + 1):
            rows = markov.SYMBOLS ** order
            counts = model.counts[order, :rows].astype(np.float64).reshape((1,) * (2 - order) + (markov.SYMBOLS,) * (order + 1))
            n, t = counts.sum(axis=-1, keepdims=True), (counts > 0).sum(axis=-1, keepdims=True)
            p = np.where(n > 0, (counts + t * p) / np.maximum(n + t, 1), p)
        self.log = np.log(p).ravel().tolist()

    def decode(self, word: str, spaced: bool = False) -> str:
        """The restored word, or words parted by one space; ``spaced``: a word may end after every character."""
        log, size, edge = self.log, markov.SYMBOLS, markov.EDGE
        # state: the last two symbols and the last letter taken; value: (log-probability, letters as linked pairs)
        states = {(edge, edge, ""): (0.0, None)}
        start = (edge, edge, "")
        for i, ch in enumerate(word):
            nxt: dict = {}
            letter, sign, options = _readings(ch)
            twice = letter and word[i - 1: i] == ch and word[i - 2: i - 1] != ch and word[i + 1: i + 2] != ch
            repeat = COST["double" if twice else "repeat"]          # two of a letter are common in words, three are not
            for (a, b, last), (score, path) in states.items():
                at = (a * size + b) * size
                for c, symbol, cost in options:
                    state, new = (b, symbol, c), score - cost + log[at + symbol]
                    if state not in nxt or nxt[state][0] < new:
                        nxt[state] = (new, (path, c))
                    if c == last:
                        state, new = (a, b, last), score - cost - repeat
                        if state not in nxt or nxt[state][0] < new:
                            nxt[state] = (new, path)
                if sign:
                    state, new = (a, b, last), score - COST["apart"]
                    if state not in nxt or nxt[state][0] < new:
                        nxt[state] = (new, path)
                    if last:
                        _offer(nxt, start, score - COST["apart"] + log[at + edge], path, " ")
            if spaced and i + 1 < len(word):
                for (a, b, last), (score, path) in list(nxt.items()):
                    if last:
                        _offer(nxt, start, score + log[(a * size + b) * size + edge], path, " ")
            states = nxt
        _, path = max(((score + (log[(a * size + b) * size + edge] if last else 0.0), path)
                       for (a, b, last), (score, path) in states.items()), key=lambda x: x[0])
        out = []
        while path:
            path, c = path
            out.append(c)
        return "".join(reversed(out)).strip(" ")


def _symbol(c: str) -> int:
    return int(markov.CODE[ord(c)]) if ord(c) < 256 else markov.OTHER


@lru_cache(1 << 14)
def _readings(ch: str) -> tuple[bool, bool, tuple]:
    """(is a letter, is a sign, (letter it may be, symbol, cost) of each reading)."""
    letter = ch.isalpha()
    options = [(c, _symbol(c), COST["stands"]) for c in STANDS_FOR.get(ch, "")]
    options.append((ch, _symbol(ch), COST["same"] if letter else COST["sign"]))
    return letter, _is_sign(ch), tuple(options)


def _offer(states: dict, state: tuple, score: float, path, c: str) -> None:
    if state not in states or states[state][0] < score:
        states[state] = (score, (path, c))


def looks_disguised(word: str) -> bool:
    return _DISGUISED.search(word) is not None


def _strip(word: str) -> str:
    return _OUTER.sub("", word)


def _single_runs(b: K.Block) -> list[tuple[int, int, int]]:
    """(first word, end, document) of the runs of three or more single-character words."""
    width = b.ends - b.starts
    single = (width == 1) | (width == 2) & (b.data[b.starts] >= 0xC0) if len(width) else width == 1
    key = np.where(single, b.doc, -1)
    at = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
    return [(lo, hi, int(key[lo])) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()) if hi - lo >= 3 and key[lo] >= 0]


def block_words(column: pa.Array, decoder: Decoder, known: dict, entry):
    """(block, code of every word, entry of every code, {document: words of its spaced-out runs}) per block.

    ``entry`` maps a restored word to what is kept of it; entries are held by the word's hash.
    """
    for b in K.blocks(column):
        kinds, first, code = np.unique(b.word_hash(K.BYTE_LOWER), return_index=True, return_inverse=True)
        if len(known) > CACHED:
            known.clear()
        raw, kinds = b.data.tobytes(), kinds.tolist()
        entries = list(map(known.get, kinds, repeat(known)))            # the dict itself stands for "not there"
        new = [i for i, found in enumerate(entries) if found is known]
        at = first[new]
        for i, lo, hi in zip(new, b.starts[at].tolist(), b.ends[at].tolist()):
            entries[i] = known[kinds[i]] = entry(restore(raw[lo:hi].decode("utf-8", "replace"), decoder))
        runs: dict[int, list[str]] = {}
        for lo, hi, doc in _single_runs(b):
            run = "".join(raw[b.starts[i]: b.ends[i]].decode("utf-8", "replace").lower() for i in range(lo, hi))
            runs.setdefault(doc, []).extend(decoder.decode(run, spaced=True).split(" "))
        yield b, code, entries, runs


def restore(word: str, decoder: Decoder) -> str:
    """The word in lower case, deobfuscated if it looks disguised (then maybe several), without outer signs."""
    word = word.lower()
    if word.isalpha() and not (len(word) > 2 and _DISGUISED.search(word)):
        return word
    core = word.strip(".,;:?\"'")
    if not looks_disguised(core):
        return _strip(core)
    return " ".join(filter(None, map(_strip, decoder.decode(core).split(" "))))


def features(restored: str) -> list[str]:
    """The words and, marked by ``^``, their heads."""
    words = restored.split(" ")
    return _features(restored) if len(words) == 1 else list(dict.fromkeys(f for w in words for f in _features(w)))


def _features(word: str) -> list[str]:
    return [word, *["^" + word[:n] for n in HEADS if len(word) >= n]] if word else []


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


_SHARED: dict[str, tuple] = {}      # of the run a worker is at: what its tasks share


def _trainer(model, run: str):
    """(feature, toxic, clean): the documents of each class that hold a feature.

    The tasks of one ``run`` in a worker share the words restored so far and the numbers of their features.
    """
    def count(batches):
        if run not in _SHARED:
            _SHARED.clear()
            _SHARED[run] = Decoder(markov.Model(model.value)), {}, {}
        decoder, known, ids = _SHARED[run]
        total = np.zeros((0, 2), np.int64)              # clean and toxic documents of each feature number

        def entry(restored: str) -> tuple[int, ...]:
            return tuple([ids.setdefault(f, len(ids)) for f in features(restored)])

        def rows():
            names, seen = list(ids), np.flatnonzero(total.any(axis=1))
            return K.batch(["feature", "toxic", "clean"],
                           [pa.array([names[i] for i in seen.tolist()], pa.string()), total[seen, 1], total[seen, 0]])

        for rb in batches:
            labels = rb.column(1).to_numpy()
            for b, code, entries, runs in block_words(rb.column(0), decoder, known, entry):
                # feature numbers of every code, and of the words of runs, as (document, feature) pairs
                size = np.fromiter(map(len, entries), np.int64, len(entries))
                flat = np.fromiter(chain.from_iterable(entries), np.int64, int(size.sum()))
                at = _distinct(b.doc * max(1, len(entries)) + code)
                doc, code = at // max(1, len(entries)), at % max(1, len(entries))
                begin = np.cumsum(size) - size
                each = np.repeat(begin[code] - (np.cumsum(size[code]) - size[code]), size[code]) + np.arange(int(size[code].sum()))
                more = [(d, f) for d, words in runs.items() for w in words for f in entry(w)]
                doc = np.concatenate((np.repeat(doc, size[code]), np.array([d for d, _ in more], np.int64)))
                n = max(1, len(ids))
                pair = _distinct(doc * n + np.concatenate((flat[each], np.array([f for _, f in more], np.int64))))
                marked = labels[b.rows][pair // n] > 0
                counts = np.bincount(pair % n * 2 + marked, minlength=2 * n).reshape(n, 2)
                counts[:len(total)] += total
                total = counts
                if len(ids) > HELD:
                    yield rows()
                    known.clear()
                    ids.clear()
                    total = np.zeros((0, 2), np.int64)
        yield rows()

    return count


def _hits(sieve, restored: str) -> list[str] | None:
    """The words with a feature in the sieve (a byte per cell)."""
    return [w for w in restored.split(" ") if w and _may_weigh(sieve, w)] or None


def _may_weigh(sieve: bytes, word: str) -> bool:
    raw = word.encode()
    if sieve[zlib.crc32(raw) % SIEVE]:
        return True
    crc, at, plain = HEAD_MARK, 0, len(raw) == len(word)
    for n in HEADS:                                     # each head goes on where the shorter one ended
        if len(word) < n:
            return False
        crc, at = zlib.crc32(raw[at:n] if plain else word[at:n].encode(), crc), n
        if sieve[crc % SIEVE]:
            return True
    return False


def _finder(shared, run: str):
    """(content, word) of the documents' restored words that may have a weight.

    The tasks of one ``run`` in a worker share the words found so far.
    """
    def find(batches):
        if run not in _SHARED:
            _SHARED.clear()
            _SHARED[run] = Decoder(markov.Model(shared.value[0])), {}, shared.value[1].tobytes()
        decoder, known, sieve = _SHARED[run]

        def entry(restored: str):
            return _hits(sieve, restored)

        for rb in batches:
            for b, code, entries, runs in block_words(rb.column(1), decoder, known, entry):
                found: dict[int, set[str]] = {}
                hit = np.fromiter((e is not None for e in entries), bool, len(entries))
                for i in np.flatnonzero(hit[code]).tolist():
                    found.setdefault(int(b.doc[i]), set()).update(entries[code[i]])
                for doc, words in runs.items():
                    found.setdefault(doc, set()).update(entry(" ".join(words)) or ())
                doc = np.repeat(list(found), [len(w) for w in found.values()]).astype(np.int64)
                yield K.batch(["content", "word"], [rb.column(0)[b.rows].take(pa.array(doc)),
                                                    pa.array([w for held in found.values() for w in held], pa.string())])

    return find


def _word_weights(words: DataFrame, kept: DataFrame) -> DataFrame:
    """(word, weight): the word's own weight, or else the largest of its heads."""
    heads = [F.when(F.char_length("word") >= n, F.concat(F.lit("^"), F.substring("word", 1, n))) for n in HEADS]
    each = words.select("word", F.explode(F.array_distinct(F.array(F.col("word"), *heads))).alias("feature"))
    own = F.max(F.when(F.col("feature") == F.col("word"), F.col("w")))
    return (each.where("feature is not null").join(kept.hint("merge"), "feature").groupBy("word")
            .agg(F.coalesce(own, F.max("w")).alias("weight")))


def _count_words(batches):
    """Model cells of all words of the documents: each distinct word of a block once, times its count."""
    for rb in batches:
        for b in K.blocks(rb.column(0)):
            if not len(b.starts):
                continue
            words = np.ones(len(b.starts), bool)
            for lo, hi, _ in _single_runs(b):          # letters set apart are not words
                words[lo:hi] = False
            starts = b.starts[words]
            if not len(starts):
                continue
            # words are laid out behind one another between boundaries
            length = b.ends[words] - starts
            ends, gone = np.cumsum(length + 1), np.cumsum(length) - length
            symbols, letter = np.full(int(ends[-1]) + 1, markov.EDGE, np.int64), np.arange(int(length.sum()))
            symbols[letter + np.repeat(ends - length - gone, length)] = markov.CODE[b.data[letter + np.repeat(starts - gone, length)]]
            before = np.concatenate(([markov.EDGE], symbols[:-2]))
            before[ends[:-1]] = markov.EDGE             # nothing is known beyond a word's boundary
            code = (before * markov.SYMBOLS + symbols[:-1]) * markov.SYMBOLS + symbols[1:]
            counts = np.bincount(code, minlength=markov.SYMBOLS ** 3).reshape((markov.SYMBOLS,) * 3)
            # the shorter contexts' counts are sums of the longest one's
            for order, table in ((2, counts), (1, counts.sum(axis=0)), (0, counts.sum(axis=(0, 1)))):
                total = table.ravel()
                cell = np.flatnonzero(total)
                yield K.batch(["cell", "n"], [order * markov.CONTEXTS * markov.SYMBOLS + cell, total[cell]])


def _held_out(id_: Column) -> Column:
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(FOLDS)) == 0


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    cells = rows.select("text").mapInArrow(_count_words, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = markov.collect_counts(cells, ["n"])[0]
    model = spark.sparkContext.broadcast(counts)                       # of fixed size
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~_held_out(F.col(id_col)))
             .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("label")))
    once = (rows.select("doc_id", F.xxhash64("text").alias("content")).join(marks.hint("merge"), "doc_id")
            .groupBy("content", "label").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "label"))
    train = rows.join(stored(once, "train").hint("merge"), "doc_id").select("text", "label")
    counted = stored(train.mapInArrow(_trainer(model, uuid.uuid4().hex), "feature string, toxic long, clean long")
                     .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                     .where("toxic > 1 and toxic >= clean"), "features")
    sums = stored(marks, "marks").join(rows.select("doc_id"), "doc_id", "left_semi").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    rate = sums[1] / sums[0] if sums[0] else 0.1
    against = F.when(F.col("feature").startswith("^"), AGAINST["head"]).otherwise(AGAINST["word"])
    weight = (F.col("toxic") + SHRINK * rate) / (F.col("toxic") + against * F.col("clean") + SHRINK)
    kept = counted.withColumn("w", weight).where(F.col("w") >= LEAST).select("feature", "w")
    cell = F.crc32(F.col("feature").cast("binary")) % F.lit(SIEVE)
    sieve = np.zeros(SIEVE, bool)
    sieve[kept.select(cell.alias("cell")).distinct().toArrow().column("cell").to_numpy()] = True
    shared = spark.sparkContext.broadcast((counts, sieve))             # of fixed size
    base = min(rate, 0.5) / 2
    content = F.xxhash64("text")
    pairs = stored(rows.select(content.alias("content"), "text").mapInArrow(_finder(shared, uuid.uuid4().hex), "content long, word string")
                   .distinct(), "pairs")
    weights = _word_weights(pairs.select("word").distinct(), kept)
    clean = F.aggregate(F.array_sort(F.collect_list(F.struct("word", "weight"))), F.lit(1.0 - base),
                        lambda left, x: left * (F.lit(1.0) - x["weight"]))
    scores = pairs.join(stored(weights, "weights").hint("merge"), "word").groupBy("content").agg((F.lit(1.0) - clean).alias("score"))
    out = (rows.select("doc_id", content.alias("content")).join(stored(scores, "scores").hint("merge"), "content", "left")
           .withColumn("score", F.coalesce("score", F.lit(1.0 - (1.0 - base)))))
    return out.select(F.col("doc_id").alias(id_col), F.coalesce(_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
