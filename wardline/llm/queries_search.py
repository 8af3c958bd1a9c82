"""Registered queries of the phrase, search and byte-window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import byte_windows, lexical, phrases
from wardline.llm.queries import LOWER, documents, query

PHRASE_CTES = f"""
pieces AS (SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM {{docs}}),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
gram AS (SELECT lang, s, array_to_string(w[i : i + s - 1], ' ') AS phrase, count(*) AS f
         FROM place, range(1, 4) r(s) WHERE i + s - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM gram WHERE s = 1 GROUP BY 1),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM gram WHERE s > 1 AND f >= {{least}}),
inner_ AS (SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(f) AS holder
           FROM cand, range(1, 3) r(i) WHERE s = 3 GROUP BY 1, 2),
stay AS (SELECT c.* FROM cand c LEFT JOIN inner_ USING (lang, phrase) WHERE holder IS NULL OR 100 * holder < 50 * c.f),
cut AS (SELECT st.lang, st.phrase, st.f AS a, k, x.f AS l, y.f AS r,
        (1000000::HUGEINT * st.f * st.f // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, s)) AS k FROM stay) st
        JOIN gram x ON x.lang = st.lang AND x.phrase = array_to_string(st.w[1 : k], ' ')
        JOIN gram y ON y.lang = st.lang AND y.phrase = array_to_string(st.w[k + 1 :], ' ')),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)"""


@query("op11_phrase_collocations", f"WITH {PHRASE_CTES.format(docs='documents', least=10)}" + """
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst JOIN n USING (lang)
QUALIFY rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir)).drop("left_open", "right_open")


TERMS = f"regexp_extract_all({LOWER}, '{lexical.TERM}')"


@query("op12_lexical_search", f"""
WITH d AS (SELECT doc_id, {TERMS.format("coalesce(text, '')")} AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS t FROM d),
tf AS (SELECT doc_id, t, count(*) AS tf FROM t GROUP BY ALL),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
df AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY t, n),
m AS (SELECT doc_id, 100 - 90 + (90 * len(w)::BIGINT * n) // l AS m FROM d, c),
q AS (SELECT DISTINCT item_id, unnest({TERMS.format("coalesce(text, '')")}) AS t FROM benchmark),
s AS (SELECT item_id, doc_id, sum(df.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN df USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY 1, 2 HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s
QUALIFY rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op13_suffix_dedup", """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, sha256(substr(h, 2 * i + 1, 100)) AS s
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM h WHERE length(h) >= 100)),
hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS least FROM win) WHERE doc_id > least),
marked AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
span AS (SELECT doc_id, min(i) AS lo, max(i) + 50 AS hi FROM numbered GROUP BY doc_id, span),
gap AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM span
        UNION ALL SELECT doc_id, max(hi), NULL FROM span GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k
         FROM gap JOIN h USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, sum(hi - lo)::BIGINT AS gone, count(*) AS spans FROM span GROUP BY doc_id)
SELECT h.doc_id, length(h) // 2 AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM h LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (byte_windows.repeated_bytes(documents(spark, sf_dir), with_bytes=False)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
