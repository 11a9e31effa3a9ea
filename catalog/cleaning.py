"""Projections, filters, null handling and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import add, ctes, fact, table
from plumbline.functions import numbers
from plumbline.operators import clean


@add("column_projection", "C1", f"{ctes('spend')} SELECT city, vendor, price::DOUBLE AS price FROM spend")
def _(spark, sf):
    return fact(spark, sf, "spend").select("city", "vendor", F.col("price").cast("double"))


@add("rename_ignoring_unknown", "C2", "SELECT o_orderkey AS invoice, o_custkey AS vendor FROM orders")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return clean.rename(rows, {"o_orderkey": "invoice", "o_custkey": "vendor", "absent": "other"})


@add("tolerant_column_drop", "C3", "SELECT event_id, user_id, value FROM events")
def _(spark, sf):
    return table(spark, sf, "events").drop("ts", "event_type", "props", "absent")


@add("all_or_nothing_column_drop", "C3", "SELECT l_orderkey, l_linenumber FROM lineitem")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax")
    kept = clean.drop_if_all_present(rows, ["l_tax", "absent"])
    return clean.drop_if_all_present(kept, ["l_tax"])


@add("column_drop", "C4", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").drop("c_nationkey", "c_acctbal")


@add("equality_filter", "C5", f"{ctes('spend')} SELECT invoice, state FROM spend WHERE state = 'HS'")
def _(spark, sf):
    return fact(spark, sf, "spend").filter(F.col("state") == "HS").select("invoice", "state")


@add("inequality_filter_keeping_null", "C6", f"{ctes('spend')} SELECT invoice, state FROM spend WHERE state IS DISTINCT FROM 'HS'")
def _(spark, sf):
    return clean.filter_ne(fact(spark, sf, "spend").select("invoice", "state"), "state", "HS")


@add(
    "either_value_filter", "C7",
    f"{ctes('positions')} SELECT emp_type, position FROM positions WHERE emp_type = 1 OR emp_type = 2",
)
def _(spark, sf):
    rows = fact(spark, sf, "positions").select("emp_type", "position")
    return rows.filter((F.col("emp_type") == 1) | (F.col("emp_type") == 2))


@add(
    "exclusion_list_keeping_null", "C8",
    f"{ctes('spend', 'exclusions')} SELECT invoice, city FROM spend WHERE city IS NULL OR city NOT IN (SELECT listed FROM exclusions)",
)
def _(spark, sf):
    return clean.exclude_values(fact(spark, sf, "spend").select("invoice", "city"), "city", fact(spark, sf, "exclusions"))


@add(
    "literal_exclusions_keeping_null", "C9",
    f"{ctes('spend')} SELECT invoice, city FROM spend WHERE city IS NULL OR city NOT IN ('NATION_2', 'NATION_3', ' ')",
)
def _(spark, sf):
    return clean.exclude_values(fact(spark, sf, "spend").select("invoice", "city"), "city", ["NATION_2", "NATION_3", " "])


@add("drop_rows_with_any_null", "C10", f"{ctes('spend')} SELECT invoice, city, state FROM spend WHERE city IS NOT NULL AND state IS NOT NULL")
def _(spark, sf):
    return clean.drop_null(fact(spark, sf, "spend").select("invoice", "city", "state"), ["city", "state"], "any")


@add("drop_rows_with_all_null", "C10", f"{ctes('spend')} SELECT invoice, city, state FROM spend WHERE city IS NOT NULL OR state IS NOT NULL")
def _(spark, sf):
    return clean.drop_null(fact(spark, sf, "spend").select("invoice", "city", "state"), ["city", "state"], "all")


@add(
    "fill_null_everywhere", "C11",
    f"{ctes('medical_retiree')} SELECT zip, coalesce(enrollee, 0) AS enrollee, coalesce(dependents, 0) AS dependents FROM medical_retiree",
)
def _(spark, sf):
    return clean.fill_null(fact(spark, sf, "medical_retiree").select("zip", "enrollee", "dependents"), 0)


@add(
    "fill_null_in_one_column", "C12",
    f"{ctes('spend')} SELECT invoice, coalesce(city, 'UNDEFINED') AS city, state FROM spend",
)
def _(spark, sf):
    return clean.fill_null(fact(spark, sf, "spend").select("invoice", "city", "state"), "UNDEFINED", ["city"])


@add(
    "blank_to_undefined", "C13",
    f"{ctes('spend')} SELECT invoice, CASE WHEN city IS NULL OR city = ' ' THEN 'UNDEFINED' ELSE city END AS city FROM spend",
)
def _(spark, sf):
    return clean.undefined_bucket(fact(spark, sf, "spend").select("invoice", "city"), "city")


@add(
    "coalesce_chain", "C14",
    f"{ctes('spend')} SELECT invoice, coalesce(state, upper(city), upper(priority)) AS label FROM spend",
)
def _(spark, sf):
    return fact(spark, sf, "spend").select("invoice", F.coalesce("state", F.upper("city"), F.upper("priority")).alias("label"))


@add(
    "null_propagating_sum", "C15",
    f"""{ctes('county_facts')} SELECT row_id, CAST(wireless + nonwireless + prepaid_wireless + supplemental + special AS DOUBLE) AS paid
    FROM county_facts""",
)
def _(spark, sf):
    parts = ("wireless", "nonwireless", "prepaid_wireless", "supplemental", "special")
    paid = numbers.add_all(*[F.col(p) for p in parts]).cast("double")
    return fact(spark, sf, "county_facts").select("row_id", paid.alias("paid"))


@add("fiscal_year_label", "C16", "SELECT o_orderkey, '21-22' AS fy FROM orders")
def _(spark, sf):
    return clean.with_fy(table(spark, sf, "orders").select("o_orderkey"), "21-22")


@add(
    "first_row_per_key", "C17",
    """SELECT event_id, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return clean.dedup_first(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@add(
    "first_row_per_key_with_null_key", "C17",
    f"""{ctes('spend')} SELECT invoice, city, state FROM spend
    QUALIFY row_number() OVER (PARTITION BY city, state ORDER BY invoice) = 1""",
)
def _(spark, sf):
    return clean.dedup_first(fact(spark, sf, "spend").select("invoice", "city", "state"), ["city", "state"], ["invoice"])


@add("distinct_column", "C18", f"{ctes('spend')} SELECT DISTINCT city FROM spend")
def _(spark, sf):
    return clean.distinct_values(fact(spark, sf, "spend"), "city")


@add(
    "indicator_then_filter", "C19",
    f"{ctes('spend')} SELECT invoice, '1' AS indicator FROM spend WHERE price > 100000 OR state = 'HS'",
)
def _(spark, sf):
    marked = (F.col("price") > 100000) | (F.col("state") == "HS")
    return clean.flag_then_filter(fact(spark, sf, "spend"), marked).select("invoice", "indicator")


@add(
    "flag_to_number", "C20",
    f"""{ctes('positions')} SELECT emp_type, CAST(coalesce(sum(CASE WHEN vacant = 'Y' THEN 1 END), 0) AS BIGINT) AS vacancies,
    CAST(count(*) AS BIGINT) AS n FROM positions GROUP BY emp_type""",
)
def _(spark, sf):
    rows = fact(spark, sf, "positions").select("emp_type", numbers.flag_to_int(F.col("vacant")).alias("vacant"))
    return rows.groupBy("emp_type").agg(F.coalesce(F.sum("vacant"), F.lit(0)).alias("vacancies"), F.count("*").alias("n"))


@add(
    "sentinel_to_zero", "C21",
    f"""{ctes('fleet')} SELECT asset, CAST(sum(CASE operating_cost WHEN '--' THEN 0 ELSE CAST(operating_cost AS decimal(18,2)) END) AS DOUBLE) AS cost
    FROM fleet GROUP BY asset""",
)
def _(spark, sf):
    cost = numbers.sentinel_to_zero(F.col("operating_cost"), as_type="decimal(18,2)")
    rows = fact(spark, sf, "fleet").select("asset", cost.alias("cost"))
    return rows.groupBy("asset").agg(F.sum("cost").cast("double").alias("cost"))
