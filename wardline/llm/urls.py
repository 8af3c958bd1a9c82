"""URL filter: rules first, then a character language-model ratio.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: what follows the host up to ``?``, ``#`` or the end.  A rule
``host/path`` fits its host and all subdomains where the url's path starts with
the rule's; the longest fitting rule decides.

The other urls are judged by two smoothed variable-order Markov models of
``host + path``, one of the urls the rules allow and one of those they block.
The score is the log-likelihood difference per symbol; the threshold is
calibrated on the ruled urls whose hash falls into every ``HOLD``-th, which the
models do not see: the one with the best balanced accuracy, from a histogram of
fixed size.

All contexts are exact: every distinct gram (context and symbol) of the urls to
judge gets its log-ratio by joins to the counts, and a url's score is the sum
over its grams, of integers, so that it does not depend on the order.

Defined results: a null url and one without ``://`` have an empty host and
path and no rule, and are allowed (no evidence); without urls of both kinds
nothing is blocked but by rule; repeated rows are judged alike; an empty table
gives an empty result; extra columns are passed over.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm import markov
from wardline.session import stored

# fixed values: the rules of the registered query
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
HOLD = 5
BINS = 4000                   # of the calibration histogram, over scores from -SPAN to SPAN
SPAN = 10.0

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(url, _PARTS, 2)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct<verdict, rule> of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def _threshold(scored: DataFrame) -> float:
    """Score with the best balanced accuracy over the held-out ruled urls; scores at or above it are allowed."""
    bin_ = F.least(F.greatest(F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1))
    rows = scored.groupBy(bin_.alias("bin")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow()
    good, bad = np.zeros(BINS), np.zeros(BINS)
    at = rows.column("bin").to_numpy().astype(np.int64)
    good[at], bad[at] = rows.column("good").to_numpy(), rows.column("bad").to_numpy()
    if not good.sum() or not bad.sum():
        return 0.0
    allowed = good[::-1].cumsum()[::-1] / good.sum()
    blocked = np.concatenate(([0], bad.cumsum()[:-1])) / bad.sum()
    best = np.flatnonzero(allowed + blocked == (allowed + blocked).max())
    return float(best[len(best) // 2]) / BINS * 2 * SPAN - SPAN      # the middle of the best ones


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, score (null where a rule decides)."""
    host, path = host_and_path(F.col(url_col))
    rows = stored(pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
                  .withColumn("ruled", matching_rule(F.col("host"), F.col("path"), rules)), "urls")
    text = F.concat("host", "path")
    key = F.xxhash64(text)
    held = F.pmod(F.crc32(text.cast("binary")), F.lit(HOLD)) == 0
    good, bad = F.col("ruled.verdict") == "allow", F.col("ruled.verdict") == "block"
    ruled = rows.where("ruled is not null").select(key.alias("key"), text.cast("binary").alias("text"), held.alias("held"),
                                                  good.cast("int").alias("good"), bad.cast("int").alias("bad"))
    counted = stored(markov.count_grams(ruled.where("not held"), "text", ["good", "bad"]), "grams")
    both = counted.agg(F.coalesce(F.max("good") > 0, F.lit(False)) & F.coalesce(F.max("bad") > 0, F.lit(False))).first()[0]
    if not both:
        verdict, score = F.lit("allow"), F.lit(None).cast("double")
        scored = rows.withColumn("score", score)
    else:
        # every distinct text that needs a score; an empty one scores 0
        texts = (rows.where((text != "") & (F.col("ruled").isNull() | held))
                 .select(key.alias("key"), text.cast("binary").alias("text")).dropDuplicates(["key"]))
        held_grams = stored(markov.text_grams(texts, "key", "text"), "text_grams")
        ratios = stored(markov.log_ratios(held_grams.select("gram").distinct(), counted, "good", "bad"), "ratios")
        scores = stored(held_grams.join(ratios.hint("merge"), "gram").groupBy("key")
                        .agg((F.sum(F.col("n") * F.col("ratio")) * markov.UNIT / F.sum("n")).alias("score")), "scores")
        sample = ruled.where("held").groupBy("key").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        limit = _threshold(sample.join(scores.hint("merge"), "key", "left").fillna(0.0, ["score"]))
        open_ = (rows.where(F.col("ruled").isNull() & (text != "")).withColumn("key", key)
                 .join(scores.hint("merge"), "key").drop("key"))
        bare = rows.where(F.col("ruled").isNull() & (text == "")).withColumn("score", F.lit(0.0))
        scored = (rows.where("ruled is not null").withColumn("score", F.lit(None).cast("double"))
                  .unionByName(open_).unionByName(bare))
        verdict = F.when((text == "") | (F.col("score") >= limit), "allow").otherwise("block")
    return scored.select(F.col("id").alias(id_col), "host", "path", F.col("ruled.rule").alias("rule"),
                         F.coalesce("ruled.verdict", verdict).alias("verdict"), "score")
