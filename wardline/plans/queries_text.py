"""Registered queries: notes, tokens, first notes, hour filters,
vocabulary and term frequency (F1-F8, J3-J6, P13-P18, A2-A5, M2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions.text import BASIC_STOPWORDS
from wardline.operators.ranking import dense_index
from wardline.operators.text import (
    lower_split_size, sparse_terms, term_frequency, term_stats,
    tokenize_notes, vocabulary_counts, vocabulary_index,
)
from wardline.operators.timeline import (
    entities_at_hours, events_at_hours, filter_notes, first_event, notes_in_stay, process_notes,
)
from wardline.plans.catalog import add_cte, register
from wardline.plans.oracle_text import tokens_sql
from wardline.plans.queries_cohort import cohort
from wardline.session import scratch_path, written
from wardline.sources.csv import read_stopwords
from wardline.sources.testdata import (
    conversation_notes_view, load_views, notes_view, read_table,
)

HOURS = (0, 12, 48, 240)   # offsets checked by the hour-filter queries
SW = BASIC_STOPWORDS

add_cte("notes_f_v", """
    SELECT * FROM notes_v
    WHERE NOT contains(lower(COALESCE(category, '')), 'discharge')
      AND hadm_id IS NOT NULL AND trim(CAST(hadm_id AS VARCHAR)) <> ''""")
add_cte("notes_in_stay_v", """
    SELECT n.* FROM notes_f_v n JOIN cohort_v c ON n.pid = c.pid AND n.hadm_id = c.hadm_id
    WHERE c.in_ts <= n.chart_ts AND (c.out_ts IS NULL OR n.chart_ts < c.out_ts)
      AND (c.dod IS NULL OR n.chart_ts < c.dod)""")
add_cte("tokens_v", f"""
    SELECT note_id, pid, hadm_id, chart_ts, {tokens_sql('text', SW)} AS tokens FROM notes_in_stay_v""")
add_cte("token_counts_v", """
    SELECT pid, CAST(SUM(len(tokens)) AS BIGINT) AS n_tokens FROM tokens_v GROUP BY pid""")
add_cte("notes_q_v", """
    SELECT * FROM notes_in_stay_v WHERE pid IN (SELECT pid FROM token_counts_v WHERE n_tokens >= 100)""")
add_cte("first_note_v", "SELECT pid, MIN(chart_ts) AS first_ts FROM notes_q_v GROUP BY pid")
add_cte("cohort_q_v", "SELECT * FROM cohort_v WHERE pid IN (SELECT pid FROM first_note_v)")
add_cte("hours_v", "SELECT UNNEST([" + ", ".join(str(h) for h in HOURS) + "]) AS hours")


def _notes(spark, sf_dir):
    return filter_notes(notes_view(spark, sf_dir))


def timeline(spark, sf_dir, materialize=True):
    """Cohort, filtered notes and the notes timeline.  ``materialize``
    writes the per-entity token stats once (for queries that use the
    cohort / first-note outputs next to the tokens); token-only queries
    stay fully lazy."""
    t = load_views(spark, sf_dir)
    from wardline.operators.cohort import adult_cohort
    c = adult_cohort(t.patients, t.stays)
    return c, filter_notes(t.notes), process_notes(c, filter_notes(t.notes), SW, materialize=materialize)


@register("notes_filtered", """
    SELECT note_id, pid, hadm_id, chart_ts, category FROM notes_f_v""")
def q_notes_filtered(spark, sf_dir):
    return _notes(spark, sf_dir).select("note_id", "pid", "hadm_id", "chart_ts", "category")


@register("notes_in_stay", "SELECT note_id, pid, hadm_id, chart_ts FROM notes_in_stay_v")
def q_notes_in_stay(spark, sf_dir):
    return (notes_in_stay(cohort(spark, sf_dir), _notes(spark, sf_dir))
            .select("note_id", "pid", "hadm_id", "chart_ts"))


@register("tokens_clean", f"""
    SELECT doc_id, len(tk) AS n_tokens, array_to_string(tk, ' ') AS tokens
    FROM (SELECT doc_id, {tokens_sql('text', SW)} AS tk FROM documents)""")
def q_tokens_clean(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    t = tokenize_notes(docs, SW)
    return t.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


@register("tokens_in_stay", """
    SELECT note_id, pid, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM tokens_v""")
def q_tokens_in_stay(spark, sf_dir):
    _, _, tl = timeline(spark, sf_dir, materialize=False)
    return tl.tokens.select("note_id", "pid", F.size("tokens").alias("n_tokens"),
                            F.array_join("tokens", " ").alias("tokens"))


@register("lower_split_size", r"""
    SELECT doc_id, len(p) AS n_pieces, len(list_filter(p, lambda t: length(t) > 0)) AS n_words
    FROM (SELECT doc_id, regexp_split_to_array(lower(COALESCE(text, '')), '[\t\n\x0B\f\r ]') AS p FROM documents)""")
def q_lower_split_size(spark, sf_dir):
    return lower_split_size(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("entity_token_counts", """
    SELECT pid, n_tokens, CAST(n_tokens >= 100 AS INTEGER) AS qualified FROM token_counts_v""")
def q_entity_token_counts(spark, sf_dir):
    _, _, tl = timeline(spark, sf_dir, materialize=False)
    return tl.token_counts.withColumn("qualified", (F.col("n_tokens") >= 100).cast("int"))


@register("first_note", "SELECT pid, first_ts FROM first_note_v")
def q_first_note(spark, sf_dir):
    return timeline(spark, sf_dir)[2].first_note


@register("qualified_cohort", """
    SELECT c.pid, c.hadm_id, c.stay_id, f.first_ts,
           (SELECT COUNT(*) FROM notes_q_v n WHERE n.pid = c.pid) AS n_notes
    FROM cohort_q_v c JOIN first_note_v f ON c.pid = f.pid""")
def q_qualified_cohort(spark, sf_dir):
    tl = timeline(spark, sf_dir)[2]
    n = tl.notes.groupBy("pid").agg(F.count(F.lit(1)).alias("n_notes"))
    return (tl.cohort.select("pid", "hadm_id", "stay_id").join(tl.first_note, "pid")
            .join(n, "pid"))


add_cte("hours_entities_v", """
    SELECT h.hours, c.pid FROM hours_v h, cohort_q_v c LEFT JOIN first_note_v f ON c.pid = f.pid
    WHERE h.hours <= 0 OR (f.first_ts IS NOT NULL
          AND (c.out_ts IS NULL OR c.out_ts > f.first_ts + INTERVAL 1 HOUR * h.hours)
          AND (c.dod IS NULL OR c.dod > f.first_ts + INTERVAL 1 HOUR * h.hours))""")


@register("filter_hours_entities", "SELECT hours, pid FROM hours_entities_v")
def q_filter_hours_entities(spark, sf_dir):
    tl = timeline(spark, sf_dir)[2]
    return entities_at_hours(tl.cohort, tl.first_note, HOURS).select("hours", "pid")


HALVES = """
    SELECT hours, 'entity' AS half, pid AS id FROM hours_entities_v
    UNION ALL """


@register("filter_hours_with_notes", HALVES + """
    SELECT h.hours, 'note', n.note_id FROM hours_v h, notes_q_v n LEFT JOIN first_note_v f ON n.pid = f.pid
    WHERE h.hours <= 0 OR n.chart_ts < f.first_ts + INTERVAL 1 HOUR * h.hours""")
def q_filter_hours_with_notes(spark, sf_dir):
    tl = timeline(spark, sf_dir)[2]
    notes = events_at_hours(tl.notes.select("note_id", "pid", "chart_ts"), tl.first_note, HOURS)
    return _halves(entities_at_hours(tl.cohort, tl.first_note, HOURS), notes)


def _halves(entities, notes):
    """Both outputs of F6 / F7: the entities and the notes kept at each offset."""
    return (entities.select("hours", F.lit("entity").alias("half"), F.col("pid").alias("id"))
            .unionByName(notes.select("hours", F.lit("note").alias("half"), F.col("note_id").alias("id"))))


@register("filter_hours_all", HALVES + """
    SELECT h.hours, 'note', n.note_id FROM hours_v h, notes_q_v n LEFT JOIN first_note_v f ON n.pid = f.pid
    WHERE h.hours <= 0 OR (n.chart_ts < f.first_ts + INTERVAL 1 HOUR * h.hours
          AND n.pid IN (SELECT pid FROM hours_entities_v e WHERE e.hours = h.hours))""")
def q_filter_hours_all(spark, sf_dir):
    tl = timeline(spark, sf_dir)[2]
    entities = entities_at_hours(tl.cohort, tl.first_note, HOURS)
    notes = events_at_hours(tl.notes.select("note_id", "pid", "chart_ts"), tl.first_note, HOURS)
    kept = notes.where("hours <= 0").unionByName(
        notes.where("hours > 0").join(entities.select("hours", "pid"), ["hours", "pid"], "left_semi").select(notes.columns))
    return _halves(entities, kept)


@register("filter_hours_tokens", """
    SELECT h.hours, t.note_id, len(t.tokens) AS n_tokens
    FROM hours_v h, tokens_v t LEFT JOIN first_note_v f ON t.pid = f.pid
    WHERE h.hours <= 0 OR t.chart_ts < f.first_ts + INTERVAL 1 HOUR * h.hours""")
def q_filter_hours_tokens(spark, sf_dir):
    tl = timeline(spark, sf_dir)[2]
    sizes = tl.tokens.select("note_id", "pid", "chart_ts", F.size("tokens").alias("n_tokens"))
    return events_at_hours(sizes, tl.first_note, HOURS).select("hours", "note_id", "n_tokens")


@register("vocabulary_counts", "SELECT term, COUNT(*) AS n FROM (SELECT UNNEST(tokens) AS term FROM tokens_v) GROUP BY term")
def q_vocabulary_counts(spark, sf_dir):
    return vocabulary_counts(timeline(spark, sf_dir, materialize=False)[2].tokens)


@register("corpus_vocabulary", f"""
    SELECT term, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS df
    FROM (SELECT doc_id, UNNEST({tokens_sql('text', SW)}) AS term FROM documents) GROUP BY term""")
def q_corpus_vocabulary(spark, sf_dir):
    docs = tokenize_notes(read_table(spark, sf_dir, "documents").select("doc_id", "text"), SW)
    return term_stats(docs, doc="doc_id")


@register("doc_term_freq", """
    SELECT note_id, term, COUNT(*) AS count FROM (SELECT note_id, UNNEST(tokens) AS term FROM tokens_v)
    GROUP BY note_id, term""")
def q_doc_term_freq(spark, sf_dir):
    return term_frequency(timeline(spark, sf_dir, materialize=False)[2].tokens)


# A dense 0-based index of the notes in id order
@register("doc_index", """
    SELECT note_id, ROW_NUMBER() OVER (ORDER BY note_id) - 1 AS doc_index FROM notes_f_v""")
def q_doc_index(spark, sf_dir):
    return dense_index(_notes(spark, sf_dir).select("note_id"), ["note_id"], "doc_index")


# Places of the vocabulary, most frequent term first; P19: term counts of a document at these places
add_cte("corpus_terms_v", f"SELECT doc_id, UNNEST({tokens_sql('text', SW)}) AS term FROM documents")
add_cte("places_v", """
    SELECT term, n, ROW_NUMBER() OVER (ORDER BY n DESC, term) - 1 AS place
    FROM (SELECT term, COUNT(*) AS n FROM corpus_terms_v GROUP BY term)""")


def _corpus_tokens(spark, sf_dir):
    docs = tokenize_notes(read_table(spark, sf_dir, "documents").select("doc_id", "text"), SW)
    return written(docs, "tokens", compression="zstd")      # the vocabulary and the rows both read them


@register("vocabulary_index", "SELECT term, n, place FROM places_v")
def q_vocabulary_index(spark, sf_dir):
    docs = tokenize_notes(read_table(spark, sf_dir, "documents").select("text"), SW)
    return vocabulary_index(docs).withColumnRenamed("index", "place")


@register("doc_sparse_terms", """
    SELECT doc_id, string_agg(CAST(place AS VARCHAR), ' ' ORDER BY place) AS indices,
           string_agg(CAST(c AS VARCHAR), ' ' ORDER BY place) AS counts
    FROM (SELECT doc_id, term, COUNT(*) AS c FROM corpus_terms_v GROUP BY doc_id, term) JOIN places_v USING (term)
    GROUP BY doc_id""")
def q_doc_sparse_terms(spark, sf_dir):
    tokens = _corpus_tokens(spark, sf_dir)
    rows = sparse_terms(tokens, vocabulary_index(tokens), doc="doc_id")
    return rows.select("doc_id", F.array_join("indices", " ").alias("indices"),
                       F.array_join(F.transform("values", lambda v: v.cast("long")), " ").alias("counts"))


# second text source: conversations (entity = conversation, turn = 6 hours)
@register("conversation_token_counts", f"""
    SELECT pid, CAST(SUM(len({tokens_sql('text')})) AS BIGINT) AS n_tokens, COUNT(*) AS n_turns
    FROM conv_notes_v GROUP BY pid""")
def q_conversation_token_counts(spark, sf_dir):
    t = tokenize_notes(conversation_notes_view(spark, sf_dir))
    return t.groupBy("pid").agg(F.sum(F.size("tokens")).cast("long").alias("n_tokens"), F.count(F.lit(1)).alias("n_turns"))


# A stop list of any size (here: every token of the benchmark), as a text source and an anti join
@register("stopword_source", f"""
    WITH stop AS (SELECT DISTINCT UNNEST({tokens_sql('text')}) AS word FROM benchmark)
    SELECT term, COUNT(*) AS n FROM (SELECT UNNEST({tokens_sql('text')}) AS term FROM documents)
    WHERE term NOT IN (SELECT word FROM stop) GROUP BY term""")
def q_stopword_source(spark, sf_dir):
    listed = tokenize_notes(read_table(spark, sf_dir, "benchmark").select("text"))
    path = scratch_path(spark, "stopwords")
    listed.select(F.explode_outer("tokens").alias("value")).where("value is not null").write.text(path)
    docs = tokenize_notes(read_table(spark, sf_dir, "documents").select("text"))
    return vocabulary_counts(docs, stopwords=read_stopwords(spark, path))


# event timeline: events within h hours of each user's first event
@register("events_within_hours", """
    SELECT h.hours, e.event_id FROM (SELECT UNNEST([12, 120, 240]) AS hours) h, events e
    JOIN (SELECT user_id, MIN(ts) AS first_ts FROM events GROUP BY user_id) f ON e.user_id = f.user_id
    WHERE e.ts < f.first_ts + INTERVAL 1 HOUR * h.hours""")
def q_events_within_hours(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    first = first_event(ev, entity="user_id", ts="ts")
    return events_at_hours(ev, first, (12, 120, 240), entity="user_id", ts="ts").select("hours", "event_id")
