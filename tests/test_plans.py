"""Plan-shape tests: built-in expressions only, semi joins where the
reference discards a joined value, no Cartesian products, pushdown."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


FITTED = ("svm_", "lda_", "report_", "run_all")     # their plans are the solvers'


def test_no_python_udf_and_no_cartesian(spark, monkeypatch):
    """Every query of the reference's operators, with nothing written in between: the whole plan is seen."""
    import wardline.operators.timeline as timeline
    import wardline.plans.pipelines as pipelines
    from wardline.plans import registry

    for module in (timeline, pipelines):
        monkeypatch.setattr(module, "cut_lineage", lambda df: df)
    for name, (fn, _) in registry.all_queries().items():
        if name.startswith(FITTED):
            continue
        p = plan(fn(spark, SF))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_semi_joins_and_pruning(spark):
    p = plan(E.queries()["qualified_cohort"](spark, SF))
    assert "LeftSemi" in p
    scan = plan(E.queries()["notes_in_stay"](spark, SF))
    # documents scan reads only the columns the plan needs
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in scan


def test_one_tokenizer_per_query(spark):
    for name in ("corpus_vocabulary", "vocabulary_counts", "doc_term_freq", "conversation_token_counts"):
        df = E.queries()[name](spark, SF)
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("regexp_replace") == 4, (name, optimized.count("regexp_replace"))


def test_labels_need_no_second_cohort(spark):
    relations = [E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("Relation")
                 for name in ("label_summary", "cohort_adults")]
    assert relations[0] == relations[1]
