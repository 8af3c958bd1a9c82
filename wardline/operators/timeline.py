"""Events inside intervals and offsets from an entity's first event
(F1, F2, J3/F4, A3, F5-F8, J5, J6, M2).

Time semantics follow the cohort: after ``effective_times`` an unknown
end of stay or death is null and means "not yet" (+infinity).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.values import add_hours
from wardline.operators.text import tokenize_notes
from wardline.session import cut_lineage

MIN_TOKENS = 100


def _before(t: Column, bound: Column) -> Column:
    """t < bound where a null bound is +infinity."""
    return bound.isNull() | (t < bound)


def _after(t: Column, bound: Column) -> Column:
    """t > bound where a null t is +infinity."""
    return t.isNull() | (t > bound)


def filter_notes(notes: DataFrame, category: str = "category", admission: str = "hadm_id") -> DataFrame:
    """F1 + F2: drop discharge notes and notes without an admission."""
    cat = F.lower(F.coalesce(F.col(category), F.lit("")))
    adm = F.col(admission)
    return notes.where(~cat.contains("discharge") & adm.isNotNull()
                       & (F.trim(adm.cast("string")) != ""))


def notes_in_stay(cohort: DataFrame, notes: DataFrame, entity: str = "pid",
                  admission: str = "hadm_id", ts: str = "chart_ts") -> DataFrame:
    """J3 + F4: notes of the cohort's admission written while the stay lasts.

    Equi-join on (entity, admission) with the half-open range test
    ``in <= t < out AND t < death`` as a residual.  The cohort side has one
    row per entity, so a hot entity on the notes side is a skewed probe
    against a single build row: AQE's skew-join split handles it.
    """
    c = cohort.select(entity, admission, F.col("in_ts").alias("_in"),
                      F.col("out_ts").alias("_out"), F.col("dod").alias("_dod"))
    t = F.col(ts)
    return (notes.join(c, [entity, admission])
            .where((F.col("_in") <= t) & _before(t, F.col("_out")) & _before(t, F.col("_dod")))
            .drop("_in", "_out", "_dod"))


def first_event(events: DataFrame, entity: str = "pid", ts: str = "chart_ts",
                out: str = "first_ts") -> DataFrame:
    """A3: earliest event time per entity (partial aggregation, skew-safe)."""
    return events.groupBy(entity).agg(F.min(ts).alias(out))


def still_in_stay(hours, first_ts: str = "first_ts") -> Column:
    """F5 predicate: the stay and the life both outlast first event + hours.

    ``hours`` may be an int or an integer Column (the hour sweep).
    """
    bound = add_hours(F.col(first_ts), hours)
    return _after(F.col("out_ts"), bound) & _after(F.col("dod"), bound)


def filter_on_hours(cohort: DataFrame, first: DataFrame, hours: int,
                    entity: str = "pid") -> DataFrame:
    """entities still in their stay ``hours`` after their first note.

    ``hours <= 0`` returns the input unchanged (no first-note requirement).
    """
    if hours <= 0:
        return cohort
    return (cohort.join(first.select(entity, "first_ts"), entity)
            .where(still_in_stay(hours)).drop("first_ts"))


def events_before_hours(events: DataFrame, first: DataFrame, hours: int,
                        entity: str = "pid", ts: str = "chart_ts") -> DataFrame:
    """F8: events earlier than first event + hours (``hours <= 0``: unchanged)."""
    if hours <= 0:
        return events
    return (events.join(first.select(entity, "first_ts"), entity)
            .where(F.col(ts) < add_hours(F.col("first_ts"), hours)).drop("first_ts"))


def first_hour(events: DataFrame, first: DataFrame, hours, entity: str = "pid", ts: str = "chart_ts") -> DataFrame:
    """F8 as one column: ``first_hr``, the smallest of the offsets the event counts at (null: at none).

    What counts at an offset above 0 is then ``first_hr <= offset``: a filter
    that reaches the scan of a written table, and one pass for all offsets.
    """
    axis = F.array(*[F.lit(int(h)) for h in sorted(hours) if h > 0])
    keep = F.filter(axis, lambda h: F.col(ts) < add_hours(F.col("first_ts"), h))
    return (events.join(first.select(entity, "first_ts"), entity)
            .withColumn("first_hr", F.array_min(keep)).drop("first_ts"))


def entities_at_hours(cohort: DataFrame, first: DataFrame, hours, entity: str = "pid") -> DataFrame:
    """F5 for several offsets at once: the cohort rows with an ``hours`` column.

    The hour axis is an ``explode`` on the one joined row per entity, so
    neither the cohort nor the tokenizer below it runs once per hour.
    """
    h = F.col("hours")
    return (cohort.join(first.select(entity, "first_ts"), entity, "left")
            .withColumn("hours", F.explode(F.array(*[F.lit(int(x)) for x in hours])))
            .where((h <= 0) | (F.col("first_ts").isNotNull() & still_in_stay(h))).drop("first_ts"))


def events_at_hours(events: DataFrame, first: DataFrame, hours, entity: str = "pid",
                    ts: str = "chart_ts") -> DataFrame:
    """F8 for several offsets at once: the events with an ``hours`` column."""
    axis = F.array(*[F.lit(int(x)) for x in hours])
    keep = F.filter(axis, lambda h: (h <= 0) | F.coalesce(F.col(ts) < add_hours(F.col("first_ts"), h), F.lit(False)))
    return (events.join(first.select(entity, "first_ts"), entity, "left")
            .withColumn("hours", F.explode_outer(keep)).where("hours is not null").drop("first_ts"))


def filter_on_hours_with_notes(cohort: DataFrame, notes: DataFrame, first: DataFrame,
                               hours: int, entity: str = "pid", ts: str = "chart_ts"):
    """F5 on the cohort; notes of *every* entity with a first note cut at +hours."""
    if hours <= 0:
        return cohort, notes
    return (filter_on_hours(cohort, first, hours, entity),
            events_before_hours(notes, first, hours, entity, ts))


def filter_all_on_hours(cohort: DataFrame, notes: DataFrame, first: DataFrame,
                        hours: int, entity: str = "pid", ts: str = "chart_ts"):
    """as F6 but notes only of the entities that survive F5."""
    if hours <= 0:
        return cohort, notes
    kept = filter_on_hours(cohort, first, hours, entity)
    kept_notes = events_before_hours(
        notes.join(kept.select(entity), entity, "left_semi"), first, hours, entity, ts)
    return kept, kept_notes


def with_first_note(cohort: DataFrame, first: DataFrame, entity: str = "pid") -> DataFrame:
    """Cohort rows whose entity has a first note (semi join)."""
    return cohort.join(first.select(entity), entity, "left_semi")


@dataclass
class NoteTimeline:
    """M2 result."""
    cohort: DataFrame      # entities (with their stay) that have a first note
    notes: DataFrame       # in-stay notes of qualifying entities
    first_note: DataFrame  # (entity, first_ts)
    tokens: DataFrame      # all in-stay notes, tokenised (not cut by min_tokens)
    token_counts: DataFrame


def process_notes(cohort: DataFrame, notes: DataFrame, stopwords=None,
                  min_tokens: int = MIN_TOKENS, entity: str = "pid",
                  ts: str = "chart_ts", text: str = "text",
                  materialize: bool = False) -> NoteTimeline:
    """M2: in-stay notes -> tokens -> entities with >= min_tokens kept tokens
    -> first note per entity -> cohort restricted to those entities.

    Tokenisation runs after the in-stay filter (regex work only on rows that
    survive the join).
    """
    in_stay = notes_in_stay(cohort, notes, entity=entity, ts=ts)
    toks = tokenize_notes(in_stay, stopwords, text=text)
    # one partial aggregation gives both the kept-token count and the first
    # note: an entity qualifies as a whole, so its first kept note is the
    # earliest of all its in-stay notes
    stats = toks.groupBy(entity).agg(F.sum(F.size("tokens")).cast("long").alias("n_tokens"),
                                     F.min(ts).alias("first_ts"))
    if materialize:
        # one row per entity: written once, so the cohort / first-note /
        # kept-note outputs below no longer re-run the tokenizer
        stats = cut_lineage(stats)
    qualified = stats.where(F.col("n_tokens") >= min_tokens)
    first = qualified.select(entity, "first_ts")
    kept_notes = in_stay.join(qualified.select(entity), entity, "left_semi")
    return NoteTimeline(cohort=with_first_note(cohort, first, entity), notes=kept_notes,
                        first_note=first, tokens=toks, token_counts=stats.select(entity, "n_tokens"))
