"""Token tables (P13-P18, A2, A4, A5, W1) over any (entity, note, text) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.text import tokenize
from wardline.operators.ranking import dense_index


def tokenize_notes(notes: DataFrame, stopwords=None, text: str = "text",
                   out: str = "tokens") -> DataFrame:
    """Replace the text column by its kept tokens (array<string>)."""
    return notes.withColumn(out, tokenize(F.col(text), stopwords)).drop(text)


def entity_token_counts(tokens: DataFrame, entity: str = "pid", col: str = "tokens") -> DataFrame:
    """A2: kept tokens per entity (sum of array sizes; partial aggregation)."""
    return tokens.groupBy(entity).agg(F.sum(F.size(col)).cast("long").alias("n_tokens"))


def _terms(tokens: DataFrame, *keys: str, col: str = "tokens") -> DataFrame:
    """One row per kept token.

    ``explode_outer`` and a null test instead of ``explode``: under ``explode``
    the optimizer adds a filter on the array's size, which runs the tokenizer
    a second time.
    """
    return tokens.select(*keys, F.explode_outer(col).alias("term")).where("term is not null")


def vocabulary_counts(tokens: DataFrame, col: str = "tokens", stopwords: DataFrame | None = None) -> DataFrame:
    """A4: every term with its total count (explode + partial aggregation;
    a very common term is pre-counted per task before the shuffle)."""
    terms = _terms(tokens, col=col)
    if stopwords is not None:
        terms = without_stopwords(terms, stopwords)
    return (terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def without_stopwords(terms: DataFrame, words: DataFrame) -> DataFrame:
    """S11 applied to exploded terms: rows whose ``term`` is in ``words.word`` go
    (anti join, so the list may have any size)."""
    return terms.join(words.select(F.col("word").alias("term")), "term", "left_anti")


def term_frequency(tokens: DataFrame, doc: str = "note_id", col: str = "tokens",
                   keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc, term, count) long form of the term-count vectors."""
    return (_terms(tokens, *keys, doc, col=col)
            .groupBy(*keys, doc, "term").agg(F.count(F.lit(1)).alias("count")))


def lower_split_size(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """P14, P15, P17 alone: lower-case, split on whitespace, count pieces."""
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s")
    return docs.select(doc, F.size(parts).alias("n_pieces"),
                       F.size(F.filter(parts, lambda t: F.length(t) > 0)).alias("n_words"))


def term_stats(tokens: DataFrame, doc: str = "note_id", col: str = "tokens") -> DataFrame:
    """A4 with document frequency: (term, n = total count, df = documents).

    One explode; the (term, doc) partial aggregate shrinks the rows before
    the per-term aggregate, so a term present everywhere is not shuffled
    once per occurrence.
    """
    per_doc = (_terms(tokens, doc, col=col)
               .groupBy("term", doc).agg(F.count(F.lit(1)).alias("c")))
    return per_doc.groupBy("term").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("df"))


def vocabulary_index(tokens: DataFrame, col: str = "tokens", min_count: int = 1) -> DataFrame:
    """(term, n, index), 0-based from the most frequent term; equal counts by term.

    ``min_count`` is the only way to leave terms out.
    """
    counts = vocabulary_counts(tokens, col).where(F.col("n") >= min_count)
    return dense_index(counts, [F.col("n").desc(), "term"])


def sparse_rows(long: DataFrame, keys: list[str], index: str = "index", value: str = "value") -> DataFrame:
    """(keys, indices array<int> ascending, values array<double>) from one row per (keys, index)."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(index).cast("int").alias("i"), F.col(value).cast("double").alias("v"))))
    return (long.groupBy(*keys).agg(entries.alias("_e"))
            .select(*keys, F.col("_e.i").alias("indices"), F.col("_e.v").alias("values")))


def sparse_terms(tokens: DataFrame, vocabulary: DataFrame, doc: str = "note_id", col: str = "tokens") -> DataFrame:
    """P18 + P19: (doc, indices, values) with the counts of a document's terms at their places in ``vocabulary``.

    Terms that the vocabulary lacks are left out; a document without any other has no row.

    Every kept token is shuffled twice: with its term to the vocabulary, and as
    a plain (document, place) to its document, whose equal places are counted
    as runs of the sorted array.  Hot terms are split by the join.
    """
    places = (_terms(tokens, doc, col=col).join(vocabulary.select("term", F.col("index").cast("int").alias("_i")), "term")
              .select(doc, "_i").repartition(doc))
    rows = places.groupBy(doc).agg(F.sort_array(F.collect_list("_i")).alias("_s"))
    first = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: (i == 0) | (F.col("_s")[i] != F.col("_s")[i - 1]))
    runs = rows.select(doc, "_s", first.alias("_first"))
    length = F.zip_with(F.slice("_first", 2, F.size("_s")), "_first",
                        lambda after, at: (F.coalesce(after, F.size("_s")) - at).cast("double"))
    return runs.select(doc, F.transform("_first", lambda i: F.col("_s")[i]).alias("indices"), length.alias("values"))
