"""Aggregations, profiles and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import REFS, add, cleaned, ctes, fact, money, refs, table, whole
from plumbline.functions import text
from plumbline.functions.dates import fiscal_label
from plumbline.operators import aggregates as agg
from plumbline.operators import quality
from plumbline.operators.joins import unmatched_keys
from plumbline.operators.unions import union_years
from plumbline.plans.cleaning import apply_steps


@add("group_sum", "E1", f"{ctes('spend')} SELECT city, {money('price')} AS price FROM spend WHERE city IS NOT NULL GROUP BY city")
def _(spark, sf):
    return agg.metric_sum(fact(spark, sf, "spend"), "city", ["price"])


@add(
    "group_sum_of_all_null_is_zero", "E1",
    f"{ctes('federal_surplus')} SELECT invoice, {money('CASE WHEN invoice <> 1 THEN savings END')} AS savings FROM federal_surplus "
    "WHERE invoice IS NOT NULL GROUP BY invoice",
)
def _(spark, sf):
    rows = fact(spark, sf, "federal_surplus").select("invoice", F.when(F.col("invoice") != 1, F.col("savings")).alias("savings"))
    return agg.metric_sum(rows, "invoice", ["savings"])


@add(
    "group_count", "E2",
    f"{ctes('spend')} SELECT vendor, CAST(count(city) AS BIGINT) AS n FROM spend WHERE vendor IS NOT NULL GROUP BY vendor",
)
def _(spark, sf):
    return agg.metric_count(fact(spark, sf, "spend"), "vendor", "city", "n")


@add(
    "group_distinct_count", "E3",
    f"{ctes('spend')} SELECT city, CAST(count(DISTINCT vendor) AS BIGINT) AS vendors FROM spend WHERE city IS NOT NULL GROUP BY city",
)
def _(spark, sf):
    return agg.metric_nunique(fact(spark, sf, "spend"), "city", "vendor", "vendors")


@add(
    "group_first_non_null", "E4",
    f"{ctes('donees')} SELECT donee, arg_min(city, seq) FILTER (city IS NOT NULL) AS city FROM donees GROUP BY donee",
)
def _(spark, sf):
    return agg.metric_first(fact(spark, sf, "donees"), "donee", "city", "city", ["seq"])


@add(
    "mixed_aggregates", "E5",
    f"""{ctes('spend')} SELECT city, state, {money('price')} AS spend, CAST(count(vendor) AS BIGINT) AS rows_seen,
    CAST(count(DISTINCT vendor) AS BIGINT) AS vendors, arg_min(priority, invoice) AS first_priority
    FROM spend WHERE city IS NOT NULL AND state IS NOT NULL GROUP BY city, state""",
)
def _(spark, sf):
    spec = {
        "spend": ("price", "money"), "rows_seen": ("vendor", "count"), "vendors": ("vendor", "nunique"),
        "first_priority": ("priority", "first"),
    }
    return agg.aggregate(fact(spark, sf, "spend"), ["city", "state"], spec, order=["invoice"])


@add(
    "group_by_expression", "E6",
    f"{ctes('spend')} SELECT upper(city) AS city, {money('price')} AS spend FROM spend WHERE city IS NOT NULL GROUP BY upper(city)",
)
def _(spark, sf):
    return agg.aggregate(fact(spark, sf, "spend"), {"city": F.upper("city")}, {"spend": ("price", "money")})


@add(
    "two_level_rollup", "E7",
    f"""{ctes('medical_retiree', 'customer_zips')}, per_zip AS (SELECT zip, {money('CAST(enrollee AS decimal(18,2))')} AS enrollee
      FROM medical_retiree WHERE zip IS NOT NULL GROUP BY zip)
    SELECT city, {money('CAST(enrollee AS decimal(18,2))')} AS enrollee FROM per_zip JOIN customer_zips USING (zip) GROUP BY city""",
)
def _(spark, sf):
    spec = {"enrollee": ("enrollee", "money")}
    return agg.rollup_via(fact(spark, sf, "medical_retiree"), fact(spark, sf, "customer_zips"), "zip", "zip", "city", spec)


@add(
    "labelled_total_row", "E8",
    f"""{ctes('spend')} SELECT {money('price')} AS spend, CAST(count(DISTINCT vendor) AS BIGINT) AS vendors,
    CAST(count(DISTINCT invoice) AS BIGINT) AS invoices, '21-22' AS fy FROM spend WHERE state IS DISTINCT FROM 'HS'""",
)
def _(spark, sf):
    rows = fact(spark, sf, "spend").filter(~F.col("state").eqNullSafe("HS"))
    spec = {"spend": ("price", "money"), "vendors": ("vendor", "nunique"), "invoices": ("invoice", "nunique")}
    return agg.total_row(rows, spec, "21-22")


@add(
    "control_totals", "E9",
    "SELECT CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts, CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS DOUBLE) AS price FROM lineitem",
)
def _(spark, sf):
    return agg.control_total(table(spark, sf, "lineitem"), {"parts": ("l_partkey", "nunique"), "price": ("l_extendedprice", "money")})


@add("value_frequencies", "E10", f"{ctes('spend')} SELECT vendor, CAST(count(*) AS BIGINT) AS n FROM spend WHERE vendor IS NOT NULL GROUP BY vendor")
def _(spark, sf):
    return agg.value_counts(fact(spark, sf, "spend"), "vendor")


def _null_row(column, kind):
    return (
        f"SELECT '{column}' AS column_name, CAST(count(*) - count({column}) AS BIGINT) AS total, "
        f"CAST(count(*) - count({column}) AS DOUBLE) / count(*) * 100 AS percent, '{kind}' AS type FROM spend"
    )


@add(
    "null_profile", "E11",
    f"{ctes('spend')} " + " UNION ALL ".join(
        _null_row(c, k) for c, k in (("invoice", "bigint"), ("city", "string"), ("state", "string"), ("price", "decimal(18,2)"), ("day", "date"))
    ),
)
def _(spark, sf):
    return quality.profile_nulls(fact(spark, sf, "spend").select("invoice", "city", "state", "price", "day"))


@add(
    "reconcile_totals", "E12",
    f"""{ctes('spend', *REFS)}, before AS (SELECT {money('price')} AS v FROM spend),
    after AS (SELECT {money('price')} AS v FROM {cleaned('spend', 'city', 'U S R X')})
    SELECT 'price' AS metric, before.v AS before, after.v AS after,
      CAST(CAST(after.v - before.v AS decimal(18,2)) AS DOUBLE) AS difference FROM before, after""",
)
def _(spark, sf):
    rows = fact(spark, sf, "spend")
    return quality.reconcile(rows, apply_steps(rows, "city", "U S R X", refs(spark, sf)), ["price"])


def _by_year(spark, sf):
    """Orders per fiscal year; one year has a column the other lacks."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey"), fiscal_label(F.col("o_orderdate") + F.expr("INTERVAL '22' YEAR")).alias("fy"), "o_custkey", "o_orderstatus"
    )
    return rows


@add(
    "union_of_years_with_differing_columns", "F1",
    f"""{ctes('spend')} SELECT invoice, fy, vendor, NULL AS state FROM spend WHERE fy < '20'
    UNION ALL SELECT invoice, fy, NULL AS vendor, state FROM spend WHERE fy >= '20'""",
)
def _(spark, sf):
    rows = fact(spark, sf, "spend")
    early = rows.filter(F.col("fy") < "20").select("invoice", "fy", "vendor")
    late = rows.filter(F.col("fy") >= "20").select("state", "fy", "invoice")
    return union_years([early, late])


@add(
    "union_of_summary_rows", "F2",
    f"{ctes('spend')} SELECT {money('price')} AS spend, fy FROM spend WHERE fy IN ('18-19', '19-20', '20-21', '21-22') GROUP BY fy",
)
def _(spark, sf):
    rows = fact(spark, sf, "spend")
    years = ("18-19", "19-20", "20-21", "21-22")
    return union_years([agg.total_row(rows.filter(F.col("fy") == y), {"spend": ("price", "money")}, y) for y in years])


@add(
    "union_of_sheets", "F3",
    f"{ctes('medical_retiree', 'medical_active')} SELECT zip, enrollee FROM medical_retiree UNION ALL SELECT zip, enrollee FROM medical_active",
)
def _(spark, sf):
    return union_years([fact(spark, sf, n).select("zip", "enrollee") for n in ("medical_retiree", "medical_active")])


@add(
    "key_set_difference", "F4",
    f"{ctes('spend', 'spine')} SELECT DISTINCT trim(city) AS city FROM spend EXCEPT SELECT city FROM spine",
)
def _(spark, sf):
    keys = fact(spark, sf, "spend").select(text.strip(F.col("city")).alias("city"))
    return unmatched_keys(keys, fact(spark, sf, "spine"), "city")


@add(
    "orders_per_fiscal_year", "C16 G24",
    f"{ctes('spend')} SELECT fy, CAST(count(*) AS BIGINT) AS n FROM spend GROUP BY fy",
)
def _(spark, sf):
    return _by_year(spark, sf).groupBy("fy").agg(F.count("*").alias("n"))
