"""What the preparation run doesn't do twice: values of single columns, written inputs, wide rows."""

import glob

from kiln.operators import prep, quality
from kiln.session import scratch_path, staged

NAN = float("nan")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_mode_of_single_values_needs_no_join(spark):
    df = spark.createDataFrame([(f"id-{i}", f"2024-01-{i % 7 + 1:02}") for i in range(70)] + [(None, None)], "i string, d string")
    both = quality.category_stats(df, ["d", "i"])
    assert {r.k: r[1:] for r in both.collect()} == {"i": (70, "id-0"), "d": (7, "2024-01-01")}
    assert "Join" not in _plan(quality.category_stats(df, ["i"]))
    assert "SortMergeJoin" not in _plan(both) and "BroadcastHashJoin" in _plan(both)


def test_a_written_input_is_not_written_again(spark):
    rows = [(i % 5, f"v{i % 3}", NAN if i % 4 == 0 else float(i)) for i in range(40)]
    df = staged(spark.createDataFrame(rows, "a long, b string, c double"), "written-test")
    want = sorted(map(str, quality.quality_report(df).collect()))
    before = len(glob.glob(scratch_path(spark, "profile-*")))
    assert sorted(map(str, quality.quality_report(df, written=True).collect())) == want
    assert len(glob.glob(scratch_path(spark, "profile-*"))) == before


def test_categories_are_joined_below_the_wide_columns(spark):
    rows = [(1, "b", 3.0, "blue bolt"), (2, "a", 30.0, None), (3, None, 600.0, "red bolt")]
    df = spark.createDataFrame(rows, "product_id long, category string, price double, product_description string")
    out = prep.product_features(df, tfidf=True)
    assert out.columns[-1] == "category_encoded" and out.columns[6:8] == ["tfidf_0", "tfidf_1"]
    assert {r.product_id: r.category_encoded for r in out.collect()} == {1: 1, 2: 0, 3: None}
    plan = _plan(out)
    assert plan.index("AS tfidf_0#") < plan.index("Join")
