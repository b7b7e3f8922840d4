"""The divergence rule works out each total once a row."""


def test_histogram_totals_are_worked_out_once(spark, edge_docs):
    from carestrata.llm.quality import quality_verdicts

    plan = quality_verdicts(edge_docs)._jdf.queryExecution().optimizedPlan().toString()
    # before, a total stood in the formula of every class of the histogram
    assert plan.count("aggregate(common#") == 1 and plan.count("aggregate(ref_common#") == 1
