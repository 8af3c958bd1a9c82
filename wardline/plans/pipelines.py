"""End-to-end plans (M17-M21): baseline sweep, topic models, derived
features, and the whole run.  Model fits are the only actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.features import baseline_array
from wardline.operators.metrics import binary_metrics
from wardline.operators.timeline import still_in_stay

# fixed weights of the deterministic stand-in scorer (age, sex, severity);
# lets the hour sweep be value-checked without a fitted model
FIXED_WEIGHTS = (1.0, 0.25, 2.0)
SWEEP_HOURS = (0, 240, 12)     # start, stop (inclusive), step


def fixed_linear_score(features: DataFrame, weights: Sequence[float], entity: str = "pid") -> DataFrame:
    """score = sum_i features[i] * weights[i] (left to right)."""
    terms = [F.col("features")[i] * F.lit(float(w)) for i, w in enumerate(weights)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return features.select(entity, "features", total.alias("score"))


def sweep_rows(cohort: DataFrame, first_note: DataFrame, hours=SWEEP_HOURS,
               entity: str = "pid") -> DataFrame:
    """(entity, hr) for every hour offset at which the entity is still in
    its stay (F5 with hours as a column).  ``explode(sequence(...))`` adds
    the hour axis - a generator over 21 values, not a join."""
    lo, hi, step = hours
    c = cohort.select(entity, "out_ts", "dod").join(first_note.select(entity, "first_ts"), entity, "left")
    hr = F.col("hr")
    keep = (hr <= 0) | (F.col("first_ts").isNotNull() & still_in_stay(hr))
    return (c.withColumn("hr", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.lit(step))))
            .where(keep).select(entity, "hr"))


def hour_sweep(test_cohort: DataFrame, scores: DataFrame, first_note: DataFrame,
               labels: DataFrame, weights: Sequence[float] | None = None, model=None,
               hours=SWEEP_HOURS, entity: str = "pid") -> DataFrame:
    """M17's test sweep as one job: (hr, total, positives, auc).

    Features and scores are computed once per entity; the hour axis only
    filters which (entity, hr) pairs enter each hour's metrics.
    """
    feats = baseline_array(test_cohort, scores, entity)
    if model is not None:
        scored = score_with_model(model, feats)
    else:
        scored = fixed_linear_score(feats, weights or FIXED_WEIGHTS, entity)
    pts = scored.select(entity, "score").join(labels.select(entity, "label"), entity)
    rows = sweep_rows(test_cohort, first_note, hours, entity).join(pts, entity)
    m = binary_metrics(rows, by=["hr"])
    return m.select("hr", "total", "positives", "auc")


def score_with_model(model, feats: DataFrame, entity: str = "pid") -> DataFrame:
    """Raw margin w.x + b of a fitted linear model (no threshold)."""
    return feats.select(entity, model.margin(F.col("features")).alias("score"))


# ---------------------------------------------------------------------------
# Report pipelines.  Each returns DataFrames (lazy, except for model fits).

from dataclasses import dataclass, field  # noqa: E402

from wardline.operators.classify import DERIVED_GRID, BASELINE_GRID, fit_linear_svm, grid_search, raw_scores  # noqa: E402
from wardline.operators.features import (  # noqa: E402
    baseline_long, combine_features, comorbidity_features, labelled_points, long_to_array,
)
from wardline.operators.timeline import first_hour  # noqa: E402
from wardline.operators.topics import fit_topics, release, topic_features  # noqa: E402
from wardline.session import cut_lineage  # noqa: E402


@dataclass
class Report:
    rows: DataFrame                        # the report table
    extra: dict = field(default_factory=dict)


def _train_row(pred: DataFrame) -> DataFrame:
    m = binary_metrics(pred)
    return m.select("total", F.col("positives").alias("num_positives"), "auc",
                    "accuracy", "sensitivity", "specificity")


def _pair_row(train_pred: DataFrame, test_pred: DataFrame) -> DataFrame:
    """One row: train total/pos/auc and test total/pos/auc (one aggregation
    over the two labelled metric rows; no join)."""
    both = (train_pred.withColumn("_set", F.lit("train"))
            .unionByName(test_pred.withColumn("_set", F.lit("test"))))
    m = binary_metrics(both, by=["_set"])

    def pick(split, col, name):
        return F.max(F.when(F.col("_set") == split, F.col(col))).alias(name)

    return m.agg(pick("train", "total", "total"), pick("train", "positives", "pos"),
                 pick("test", "total", "test_total"), pick("test", "positives", "test_pos"),
                 pick("train", "auc", "auc"), pick("test", "auc", "test_auc"))


def run_baseline(train: DataFrame, test: DataFrame, scores: DataFrame, first_note: DataFrame,
                 labels: DataFrame, use_cv: bool = False, num_folds: int = 5, fit_intercept: bool = True,
                 max_iter: int = 300, reg_param: float = 0.1, hours=SWEEP_HOURS,
                 entity: str = "pid") -> Report:
    """SVM on (age, sex, severity); train metrics; 21-point test sweep."""
    feats = long_to_array(baseline_long(train, scores, entity), entity=entity)
    pts = cut_lineage(labelled_points(feats, labels, entity))
    extra = {}
    if use_cv:
        model, grid = grid_search(pts, BASELINE_GRID, num_folds, entity=entity)
        extra["grid"] = grid
    else:
        model = fit_linear_svm(pts, max_iter, reg_param, fit_intercept)
    extra["model"] = model
    extra["train"] = _train_row(raw_scores(model, pts, entity))
    sweep = hour_sweep(test, scores, first_note, labels, model=model, hours=hours, entity=entity)
    return Report(sweep, extra)


def run_retrospective_topics(train: DataFrame, test: DataFrame, tokens: DataFrame, labels: DataFrame,
                             k: int = 50, lda_iter: int = 50, max_iter: int = 300, reg_param: float = 0.1,
                             fit_on: str = "all", optimizer: str = "online", vocab_size: int | None = None,
                             entity: str = "pid") -> Report:
    """LDA over the notes (``fit_on='all'``: train and test notes, as
    the reference; ``'train'``: train notes only), mean topic mixture per
    entity, SVM on train, metrics on train and test."""
    fit_tokens = tokens if fit_on == "all" else tokens.join(train.select(entity), entity, "left_semi")
    tm = fit_topics(fit_tokens, k, lda_iter, vocab_size=vocab_size, optimizer=optimizer)
    feats = cut_lineage(topic_features(tm, tokens, entity))      # topic inference runs once
    release(tm)
    tr = labelled_points(feats.join(train.select(entity), entity, "left_semi"), labels, entity)
    te = labelled_points(feats.join(test.select(entity), entity, "left_semi"), labels, entity)
    model = fit_linear_svm(tr, max_iter, reg_param)
    return Report(_pair_row(raw_scores(model, tr, entity), raw_scores(model, te, entity)),
                  {"model": model, "topics": tm})


def run_derived(train: DataFrame, test: DataFrame, labels: DataFrame, cohort: DataFrame,
                scores: DataFrame, flags: DataFrame, use_cv: bool = False, num_folds: int = 5,
                max_iter: int = 300, reg_param: float = 0.1, entity: str = "pid") -> Report:
    """3 baseline + 30 comorbidity features, SVM, train/test metrics."""
    feats = cut_lineage(combine_features(baseline_array(cohort, scores, entity),
                                         comorbidity_features(cohort, flags, entity), entity))
    tr = labelled_points(feats.join(train.select(entity), entity, "left_semi"), labels, entity)
    te = labelled_points(feats.join(test.select(entity), entity, "left_semi"), labels, entity)
    extra = {}
    if use_cv:
        model, extra["grid"] = grid_search(tr, DERIVED_GRID, num_folds, entity=entity)
    else:
        model = fit_linear_svm(tr, max_iter, reg_param)
    extra["model"] = model
    return Report(_pair_row(raw_scores(model, tr, entity), raw_scores(model, te, entity)), extra)


def run_time_varying_topics(train: DataFrame, test: DataFrame, labels: DataFrame, first_note: DataFrame,
                            tokens: DataFrame, hours=(12, 240, 12), k: int = 50, lda_iter: int = 50,
                            max_iter: int = 300, reg_param: float = 0.1, optimizer: str = "online",
                            vocab_size: int | None = None, entity: str = "pid",
                            parallelism: int = 4) -> Report:
    """For each hour offset, notes before first note + hours -> LDA fit
    on the train notes -> topic features for train and test (the same
    model, so topic i means the same in both) -> SVM -> one report row.

    A fit per hour is inherent; the token table they all read is written
    once to the shared folder, each note with the first hour it counts at.
    """
    lo, hi, step = hours
    note = ["note_id"] if "note_id" in tokens.columns else []
    toks = cut_lineage(first_hour(tokens.select(entity, *note, "chart_ts", "tokens"), first_note, range(lo, hi + 1, step), entity)
                       .drop("chart_ts"))

    def one_hour(hr: int) -> DataFrame:
        cut = (toks if hr <= 0 else toks.where(F.col("first_hr") <= hr)).drop("first_hr")
        tr_tok = cut.join(train.select(entity), entity, "left_semi")
        tm = fit_topics(tr_tok, k, lda_iter, vocab_size=vocab_size, optimizer=optimizer)
        feats = cut_lineage(topic_features(tm, cut, entity))
        release(tm)
        tr = labelled_points(feats.join(train.select(entity), entity, "left_semi"), labels, entity)
        te = labelled_points(feats.join(test.select(entity), entity, "left_semi"), labels, entity)
        model = fit_linear_svm(tr, max_iter, reg_param)
        row = _pair_row(raw_scores(model, tr, entity), raw_scores(model, te, entity))
        # each hour's row is small: write it now so the model is not kept
        return cut_lineage(row.select(F.lit(hr).alias("hr"), "*"))

    # independent fits per hour run as concurrent Spark jobs
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(one_hour, range(lo, hi + 1, step)))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return Report(out)


@dataclass
class Prepared:
    cohort: DataFrame
    timeline: object
    labels: DataFrame
    train: DataFrame
    test: DataFrame
    train_balanced: DataFrame


def prepare(patients: DataFrame, stays: DataFrame, notes: DataFrame, stopwords=None,
            horizon: str = "in_stay", missing: str = "null", train_share: float = 0.7,
            seed: int = 42, entity: str = "pid", materialize: bool = True,
            materialize_tokens: bool = True) -> Prepared:
    """M21 front half: cohort -> notes/tokens/first note -> labels -> split
    -> 7:3 rebalanced training entities.

    With ``materialize`` the per-entity table (cohort + first note + label +
    split flags) and the token table are written once to the shared
    folder: every later model fit reads them instead of re-running the
    cohort / tokenizer plan, and a lost executor re-reads written files.
    """
    from wardline.operators.cohort import LABEL_COLUMNS, adult_cohort, with_death_labels
    from wardline.operators.sampling import rebalance, split_exact
    from wardline.operators.timeline import NoteTimeline, filter_notes, process_notes

    c = adult_cohort(patients, stays, missing=missing, entity=entity)
    tl = process_notes(c, filter_notes(notes), stopwords, entity=entity)
    # qualified cohort + first note: the one table everything below reads
    qc = tl.cohort.join(tl.first_note, entity)
    if materialize:
        qc = cut_lineage(qc)
    # the labels are columns of the cohort row, so nothing is joined back to it
    wide = with_death_labels(qc).withColumn("label", F.col(LABEL_COLUMNS[horizon])).drop(*LABEL_COLUMNS.values())
    s = split_exact(wide, train_share, seed, entity)
    bal = (rebalance(s.where("is_train = 1"), None, 0.3, True, seed, entity).select(entity)
           .withColumn("is_balanced", F.lit(1)))
    ent = s.join(bal, entity, "left").fillna(0, ["is_balanced"])
    tokens = tl.tokens
    if materialize:
        ent = cut_lineage(ent)
        if materialize_tokens:
            tokens = cut_lineage(tokens)
    cohort_q = ent.drop("label", "first_ts", "is_train", "is_balanced")
    tl2 = NoteTimeline(cohort=cohort_q, notes=tl.notes, first_note=ent.select(entity, "first_ts"),
                       tokens=tokens, token_counts=tl.token_counts)
    return Prepared(
        cohort=c, timeline=tl2, labels=ent.select(entity, "label"),
        train=ent.where("is_train = 1").drop("label", "first_ts", "is_train", "is_balanced"),
        test=ent.where("is_train = 0").drop("label", "first_ts", "is_train", "is_balanced"),
        train_balanced=ent.where("is_balanced = 1").drop("label", "first_ts", "is_train", "is_balanced"))


def run_all(patients: DataFrame, stays: DataFrame, notes: DataFrame, scores: DataFrame,
            flags: DataFrame, stopwords=None, topics: bool = True, time_varying: bool = True,
            k: int = 50, lda_iter: int = 50, optimizer: str = "online",
            hours=(12, 240, 12)) -> dict[str, DataFrame]:
    """The whole run, as report DataFrames keyed by model name.

    Reg. parameters: 0.1 everywhere (the reference's 100 with unit-step SGD
    diverges; see README).  M17 and M19 train on the rebalanced entities,
    M20 and M18 on the full training split, as in the reference.
    """
    p = prepare(patients, stays, notes, stopwords)
    tl = p.timeline
    toks = tl.tokens
    out = {}
    base = run_baseline(p.train_balanced, p.test, scores, tl.first_note, p.labels)
    out["baseline_train"] = base.extra["train"]
    out["baseline_sweep"] = base.rows
    out["derived"] = run_derived(p.train, p.test, p.labels, tl.cohort, scores, flags).rows
    if topics:
        out["retrospective_topics"] = run_retrospective_topics(
            p.train_balanced, p.test, toks, p.labels, k, lda_iter, optimizer=optimizer).rows
    if time_varying:
        out["time_varying_topics"] = run_time_varying_topics(
            p.train, p.test, p.labels, tl.first_note, toks, hours=hours, k=k, lda_iter=lda_iter,
            optimizer=optimizer).rows
    return out
