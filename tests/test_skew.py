"""Queries on tables in which one key holds a third of the rows, cut into pieces."""

import compare
import duckdb
import pytest

import __spark_entry__ as contract

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "lineitem": {"l_orderkey": 7, "l_partkey": 11, "l_suppkey": 3},
    "orders": {"o_custkey": 5},
    "events": {"user_id": 9, "props": """'{"k": 12}'"""},
    "supplier": {"s_nationkey": 4},
}
NAMES = """
    sql01_customer_revenue sql02_avg_salary_by_dept sql03_recent_orders sql06_category_growth
    sql07_monthly_churn sql08_duplicate_transactions sql09_login_streaks sql10_salary_p90
    sql12_running_total nb_sales_items nb_conversion_by_source nb_purchase_frequency
    silver_events silver_sales_enriched
""".split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skew")
    con = duckdb.connect()
    for name in compare.TABLES:
        changes = ", ".join(
            f"CASE WHEN hash(row_id * {at * 2 + 1}) % 3 = 0 THEN {value} ELSE {column} END AS {column}"
            for at, (column, value) in enumerate(HOT.get(name, {}).items(), 1)
        )
        replaced = f"REPLACE ({changes})" if changes else ""
        con.execute(
            f"COPY (SELECT * EXCLUDE (row_id) {replaced} FROM (SELECT row_number() OVER () AS row_id, * "
            f"FROM '{SOURCE}/{name}.parquet')) TO '{target}/{name}.parquet' (FORMAT parquet)"
        )
    return str(target)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, folder, name):
    found = compare.spark_rows(contract.queries()[name](spark, folder))
    assert found == compare.duck_rows(compare.connect(folder), contract.oracle_sql()[name])
    assert found[1]
