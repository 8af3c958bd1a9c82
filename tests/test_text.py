from pyspark.sql import functions as F

from wardline.functions.text import tokenize, usable_stopwords
from wardline.operators.text import entity_token_counts, term_frequency, vocabulary_counts


def toks(spark, text, stop=None):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(tokenize(F.col("text"), stop).alias("t")).first().t


def test_punctuation_and_digits(spark):
    assert toks(spark, "Hello, world! cafés1x (patient) note.") == ["hello", "world", "café", "patient", "note"]
    # \w is ASCII: the digit-word pass stops at the accent, leaving "café"
    assert toks(spark, "cafés1x déjà") == ["café", "déjà"]


def test_uncovered_characters_fail_letter_test(spark):
    # "|" and the em dash are not in the punctuation class
    assert toks(spark, "left|right word—word plain") == ["plain"]
    # U+2212 is in the class, tab splits
    assert toks(spark, "alpha−beta\tgamma") == ["alpha", "beta", "gamma"]


def test_short_tokens_apostrophes_and_supplementary(spark):
    assert toks(spark, "a an the four fives") == ["four", "fives"]
    assert toks(spark, "don't patient's") == ["patient"]
    assert toks(spark, "𝒜bcd normal") == ["normal"]


def test_stopwords(spark):
    assert toks(spark, "with these words", ["with", "these"]) == ["words"]
    assert usable_stopwords(["it's", "a", "with", "Über", "with"]) == ["with", "Über"]


def test_vocabulary_and_tf(spark):
    df = spark.createDataFrame([(1, ["aaaa", "bbbb", "aaaa"]), (2, ["bbbb"])], "note_id long, tokens array<string>")
    v = {r.term: r.n for r in vocabulary_counts(df).collect()}
    assert v == {"aaaa": 2, "bbbb": 2}
    tf = {(r.note_id, r.term): r["count"] for r in term_frequency(df).collect()}
    assert tf == {(1, "aaaa"): 2, (1, "bbbb"): 1, (2, "bbbb"): 1}
    df2 = df.withColumn("pid", F.lit(7))
    assert entity_token_counts(df2).first().n_tokens == 4
