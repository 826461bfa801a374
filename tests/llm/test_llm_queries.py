"""The registered operators against their SQL, over all rows of the small tables."""

import compare
import pytest

from tillflow.llm.queries import QUERIES
from tillflow.llm.sql import SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(FOLDER)
    for name in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows(spark, duck, name):
    assert compare.spark_rows(QUERIES[name](spark, FOLDER)) == compare.duck_rows(duck, SQL[name])


def test_native_operators_use_no_python(spark):
    for name in ("op6_robust_outliers", "op10_exact_dedup", "op12_license_scan"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan
