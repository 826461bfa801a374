"""Orders, payroll, subscriptions and logins.

Aggregates come before joins, so that a frequent key is already one row when it
meets the other side. Every sort ends in a unique column: results are stable and
equal sort values still spread over the sorted partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import exact_sum, in_year, in_years, month_of, total_of
from tillflow.operators.ordered import attach, percentile_by, previous_value, running_sum
from tillflow.operators.rows import first_rows, repeated, streaks, without


def customer_revenue(customers: DataFrame, orders: DataFrame, year: int, above: float) -> DataFrame:
    """Customers whose orders of the year add up to more than ``above``."""
    spent = (
        orders.where(in_year("order_date", year))
        .groupBy("customer_id")
        .agg(total_of("order_amount").alias("total_order_amount"))
        .where(F.col("total_order_amount") > above)
    )
    return customers.join(spent, "customer_id").select("customer_name", "total_order_amount")


def average_salary(departments: DataFrame, employees: DataFrame) -> DataFrame:
    """Average salary of every department, NULL for one without salaries."""
    paid = employees.groupBy("department_id").agg(
        F.try_divide(total_of("salary"), F.count("salary")).alias("avg_salary")
    )
    return (
        departments.select("department_id", "department_name")
        .distinct()
        .join(paid, "department_id", "left")
        .orderBy(F.desc_nulls_last("avg_salary"), "department_id")
        .select("department_name", "avg_salary")
    )


def recent_orders(orders: DataFrame, count: int = 2) -> DataFrame:
    """The newest ``count`` orders of each customer; the lower id first on one date."""
    newest = first_rows(orders, ["customer_id"], [F.desc("order_date"), "order_id"], count)
    return newest.select("customer_id", "order_id", "order_date", "order_amount").orderBy(
        "customer_id", F.desc("order_date"), "order_id"
    )


def first_purchase(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("customer_id")
        .agg(F.min("order_date").alias("first_purchase"))
        .orderBy("customer_id")
    )


def customers_without_orders(customers: DataFrame, orders: DataFrame, year: int) -> DataFrame:
    active = orders.where(in_year("order_date", year))
    return (
        without(customers, active, "customer_id")
        .select("customer_id", "customer_name")
        .orderBy("customer_id")
    )


def category_growth(sales: DataFrame, products: DataFrame, year: int) -> DataFrame:
    """Categories that sold more in ``year`` than in the year before, sold in both."""
    names = {year: f"sales_{year}", year - 1: f"sales_{year - 1}"}
    amount = F.col("amount")
    per_product = (
        sales.where(in_years("sale_date", year - 1, year))
        .groupBy("product_id")
        .agg(*[exact_sum(F.when(in_year("sale_date", y), amount)).alias(n) for y, n in names.items()])
    )
    now, before = names[year], names[year - 1]
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.sum(now).alias(now), F.sum(before).alias(before))
        .where(F.col(now) > F.col(before))
        .select(
            "category",
            F.col(now).cast("double").alias(now),
            F.col(before).cast("double").alias(before),
            (F.col(now) - F.col(before)).cast("double").alias("sales_increase"),
        )
        .orderBy(F.desc("sales_increase"), "category")
    )


def monthly_churn(subscriptions: DataFrame, tie_break: str = "status") -> DataFrame:
    """Changes from active to cancelled per month, counted per change and not per user.

    ``tie_break`` orders the changes of one moment; without an id, active comes first.
    """
    steps = previous_value(subscriptions, ["user_id"], ["date", tie_break], "status", "before")
    return (
        steps.where((F.col("status") == "cancelled") & (F.col("before") == "active"))
        .groupBy(month_of("date").alias("churn_month"))
        .agg(F.count("*").alias("churned_users"))
    )


def duplicate_transactions(transactions: DataFrame) -> DataFrame:
    """Same user, amount and day more than once."""
    day = F.to_date("transaction_date").alias("transaction_day")
    return repeated(transactions, "user_id", "amount", day).orderBy(
        "user_id", "amount", "transaction_day"
    )


def login_streaks(logins: DataFrame, least: int = 3) -> DataFrame:
    return (
        streaks(logins, "user_id", "login_date", least)
        .select("user_id", "streak_start")
        .orderBy("user_id", "streak_start")
    )


def salary_percentile(employees: DataFrame, share: float = 0.9, group: str = "department") -> DataFrame:
    """Every salary beside the percentile of its department."""
    mark = percentile_by(employees, [group], "salary", share, into="percentile_salary")
    return attach(employees.select("emp_id", group, "salary"), mark, [group])


def products_never_sold(products: DataFrame, sales: DataFrame) -> DataFrame:
    return without(products, sales, "product_id").select("product_id", "name")


def running_total(orders: DataFrame, amount: str = "amount") -> DataFrame:
    """Spend of the customer up to and including each order: the plain sum, of any scale."""
    return running_sum(
        orders, ["customer_id"], ["order_date", "order_id"], amount, into="running_total"
    ).select("order_id", "customer_id", "order_date", amount, "running_total")
