"""Physical plans: no Cartesian products, pruned scans, filters at the scan, no Python in the engine's main path."""

import pytest

from fitloom import catalog

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["flagship", "JOI2", "JOI3", "JOI4", "JOI5", "JOI8", "JOI11", "JOI14", "SMP2", "WIN4", "SK5", "SRC5", "SMP20"])
def test_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert not any(word in text for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"))


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["DED3"](spark, SF))
    schema = [x for x in text.splitlines() if x.startswith("ReadSchema")]
    assert schema and all("props" not in x for x in schema)
    assert "PushedFilters: [IsNotNull(event_type)" in text or "Not(EqualTo(event_type,error))" in text


def test_acceptance_works_scores_out_once(spark):
    """The filter on scores doesn't repeat the matching: FLT1 matches as often as SCR8, which only projects."""
    found = {}
    for name in ("FLT1", "SCR8"):
        text = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        found[name] = text.count("exists(")
    assert found["FLT1"] == found["SCR8"] == 1


@pytest.mark.parametrize("name", ["WIN3", "SMP2"])
def test_samples_limit_strata_before_they_move(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["WIN4", "AGG10", "PRJ9", "SRC5"])
def test_no_window_over_a_whole_stratum(spark, name):
    """Rows are numbered by stratum and cell; windows by stratum alone see counted cells."""
    df = QUERIES[name](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in text.splitlines() if "row_number()" in x or "last(" in x and "windowspec" in x]
    assert windows and all("__cell" in x or "__chunk" in x for x in windows)
