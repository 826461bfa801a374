import pytest

from tillflow.operators.quality import DROP, FAIL, KEEP, Expectation, enforce, report, watch

RULES = [
    Expectation("known", "x IS NOT NULL", KEEP),
    Expectation("positive", "x > 0", DROP),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1,), (-1,), (None,), (5,)], "x int")


def test_report(df):
    rows = [tuple(r) for r in report(df, "numbers", RULES).collect()]
    assert rows == [("numbers", "known", "keep", 4, 1), ("numbers", "positive", "drop", 4, 2)]


def test_enforce_drops_null_conditions(df):
    assert {r.x for r in enforce(df, RULES).collect()} == {1, 5}


def test_watch_counts_on_the_way(df):
    seen_rows, seen = watch(df, RULES)
    seen_rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 4, "known": 1, "positive": 2}


def test_fail_survives_column_pruning(df):
    strict = [Expectation("strict", "x > -5", FAIL)]
    guarded = enforce(df.selectExpr("x", "'a' AS other"), strict).select("other")
    with pytest.raises(Exception, match="strict"):
        guarded.write.format("noop").mode("overwrite").save()
    assert enforce(df.where("x IS NOT NULL"), strict).count() == 3


def test_unknown_action():
    with pytest.raises(ValueError):
        Expectation("a", "true", "ignore")
