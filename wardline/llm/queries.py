"""Registered queries opN_<name>: (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import chunks, exact, line_quality, mixing, near, packing, records, substring, toxicity, urls
from wardline.session import ship_library

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_library(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = (run, sql)
        return run
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


END_ID = 2


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), END_ID, capacity=1024)


QUALITY_CTES = f"""
d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM {{docs}}),
w AS (SELECT *, {WORDS.format("t")} AS w FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) r(k) GROUP BY doc_id),
raw AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT *, {WORDS.format("regexp_replace(" + LOWER.format("line") + ", '[0-9]', '0', 'g')")} AS lw FROM raw),
full_lines AS (SELECT *, array_to_string(lw, ' ') AS norm FROM lines WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
held AS (SELECT host, norm, count(DISTINCT t) AS docs FROM full_lines GROUP BY 1, 2),
hosts AS (SELECT host, count(DISTINCT t) AS total FROM d GROUP BY 1),
over AS (SELECT host, norm FROM held JOIN hosts USING (host) WHERE docs > 10 AND docs > total * 0.01::DOUBLE),
gone AS (SELECT doc_id, sum(len(lw))::BIGINT AS n FROM full_lines JOIN over USING (host, norm) GROUP BY 1),
judged AS (
SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
       coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words,
       len(w) < 20 OR 100 * coalesce(rep.n, 0) > 30 * len(w) AS base_failed
FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))"""


@query("op2_line_quality", f"WITH {QUALITY_CTES.format(docs='documents')}" + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed,
       NOT base_failed AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept FROM judged""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("n_removed_words").cast("long").alias("n_removed_words"), "base_failed", "kept")


@query("op3_substring_dedup", f"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i : i + 49], ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS least FROM win) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM hit, range(0, 50) r(k)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY pos) AS t, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substring.repeats(documents(spark, sf_dir), with_text=False)
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


@query("op4_cube_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.draw(documents(spark, sf_dir))
            .select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "copies"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op6_binary_records")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode_and_read(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), END_ID)


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op8_exact_dedup", """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir), keep="max")


NEAR_CTES = f"""
w AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM {{docs}}),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id
           GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= 75 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS x, a AS y FROM both_ways UNION SELECT r.x, e.b FROM reach r JOIN both_ways e ON r.y = e.a),
root AS (SELECT x, min(y) AS root FROM reach GROUP BY x)"""


@query("op9_near_dedup", "WITH RECURSIVE " + NEAR_CTES.format(docs="documents") + """
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root.root, w.doc_id) AS component_id,
       w.doc_id = coalesce(root.root, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN root ON root.x = w.doc_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir))


@query("op10_line_chunks", """
WITH line AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS i FROM (
       SELECT doc_id, unnest(l) AS x, unnest(range(0, len(l))) AS i
       FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
hashed AS (SELECT *, ('0x' || substr(md5(x), 1, 8))::BIGINT AS h FROM line),
rolled AS (SELECT *, ((h + 31 * coalesce(lag(h) OVER w, 0)) % 2147483647) % 3 = 2 AS ends FROM hashed
           WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
placed AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING
           AND 1 PRECEDING), 0) AS place FROM rolled),
chunk AS (SELECT doc_id, place, count(*) AS n, string_agg(x, chr(10) ORDER BY i) AS t FROM placed GROUP BY 1, 2),
gone AS (SELECT doc_id, place, n FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, place) AS r
         FROM chunk WHERE n > 1) WHERE r > 1),
kept AS (SELECT doc_id, string_agg(t, chr(10) ORDER BY place) AS t FROM chunk ANTI JOIN gone USING (doc_id, place)
         GROUP BY 1)
SELECT c.doc_id, c.n_lines, coalesce(g.n, 0)::BIGINT AS n_removed_lines, sha256(coalesce(k.t, '')) AS kept_sha256
FROM (SELECT doc_id, sum(n)::BIGINT AS n_lines FROM chunk GROUP BY 1) c
LEFT JOIN (SELECT doc_id, sum(n) AS n FROM gone GROUP BY 1) g USING (doc_id) LEFT JOIN kept k USING (doc_id)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup_lines(documents(spark, sf_dir))


def all_queries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    from wardline.llm import queries_search  # noqa: F401  (registers its queries here)

    return dict(QUERIES)
