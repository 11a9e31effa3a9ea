"""Joins and key audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import add, ctes, fact, money, table
from plumbline.functions.text import strip
from plumbline.operators import joins
from plumbline.operators.aggregates import aggregate
from plumbline.plans import claims

SHEETS = claims.SHEETS


def _city_spend(spark, sf):
    rows = fact(spark, sf, "spend").withColumn("city", strip(F.col("city")))
    return aggregate(rows, ["city"], {"spend": ("price", "money")})


CITY_SPEND = f"metric AS (SELECT trim(city) AS city, {money('price')} AS spend FROM spend WHERE city IS NOT NULL GROUP BY trim(city))"


@add(
    "spine_left_join", "D1",
    f"{ctes('spend', 'spine')}, {CITY_SPEND} SELECT s.city, s.county, m.spend FROM spine s LEFT JOIN metric m ON s.city = m.city",
)
def _(spark, sf):
    return joins.attach_metric(fact(spark, sf, "spine"), _city_spend(spark, sf), "city").drop("ord")


@add(
    "zip_lookup", "D2",
    f"""{ctes('zip_circuits', 'zips')} SELECT f.fy, f.zip, z.city, CAST(count(*) AS BIGINT) AS n
    FROM zip_circuits f LEFT JOIN zips z ON f.zip = z.zip GROUP BY ALL""",
)
def _(spark, sf):
    rows = joins.enrich(fact(spark, sf, "zip_circuits"), fact(spark, sf, "zips"), "zip", "zip")
    return rows.groupBy("fy", "zip", "city").agg(F.count("*").alias("n"))


@add(
    "lookup_with_other_key_name", "D2",
    "SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _(spark, sf):
    dim = table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.enrich(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), dim, "o_custkey", "c_custkey")


@add(
    "lookup_led_join", "D3",
    f"""{ctes('customer_zips', 'medical_retiree')} SELECT z.zip, z.city, f.enrollee, f.dependents
    FROM customer_zips z LEFT JOIN medical_retiree f ON z.zip = f.zip""",
)
def _(spark, sf):
    rows = fact(spark, sf, "medical_retiree").drop("fy")
    return joins.enrich_lookup(fact(spark, sf, "customer_zips"), rows, "zip", "zip")


@add(
    "inner_join", "D4",
    "SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dim = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return rows.join(dim, "l_suppkey", "inner").drop("l_suppkey")


def _sheet_sql(name):
    return f"(SELECT zip, sum(CAST(enrollee AS decimal(18,2))) AS {name} FROM {name} GROUP BY zip)"


@add(
    "outer_join_matching_null_keys", "D5",
    f"""{ctes('medical_retiree', 'medical_active')} SELECT coalesce(a.zip, b.zip) AS zip, CAST(medical_retiree AS DOUBLE) AS medical_retiree,
    CAST(medical_active AS DOUBLE) AS medical_active
    FROM {_sheet_sql('medical_retiree')} a FULL OUTER JOIN {_sheet_sql('medical_active')} b ON a.zip IS NOT DISTINCT FROM b.zip""",
)
def _(spark, sf):
    sides = [
        fact(spark, sf, name).groupBy("zip").agg(F.sum(F.col("enrollee").cast("decimal(18,2)")).cast("double").alias(name))
        for name in SHEETS[:2]
    ]
    return joins.outer_join_nullsafe(*sides, "zip")


RAW_OUTER = " FULL OUTER JOIN ".join(f"(SELECT zip, enrollee AS {n} FROM {n}) {n[:9]}" for n in ("medical_retiree", "pharmacy_retiree"))


@add(
    "outer_join_of_raw_rows_with_hot_keys", "D5",
    f"""{ctes('medical_retiree', 'pharmacy_retiree')} SELECT coalesce(medical_r.zip, pharmacy_.zip) AS zip, medical_retiree, pharmacy_retiree
    FROM {RAW_OUTER} ON medical_r.zip IS NOT DISTINCT FROM pharmacy_.zip""",
)
def _(spark, sf):
    sides = [fact(spark, sf, n).select("zip", F.col("enrollee").alias(n)) for n in ("medical_retiree", "pharmacy_retiree")]
    return joins.outer_join_nullsafe(*sides, "zip", skewed=True)


def _total(name, out):
    return f"{out} AS (SELECT zip, CAST(enrollee AS decimal(18,2)) + CAST(dependents AS decimal(18,2)) AS {out} FROM {name})"


COMBINED = f"""{_total('medical_retiree', 'mr')}, {_total('medical_active', 'me')}, {_total('pharmacy_retiree', 'pr')},
    {_total('pharmacy_active', 'pe')},
    medical AS (SELECT coalesce(mr.zip, me.zip) AS zip, mr, me, me + mr AS medical_claims FROM mr FULL OUTER JOIN me ON mr.zip IS NOT DISTINCT FROM me.zip),
    pharmacy AS (SELECT coalesce(pr.zip, pe.zip) AS zip, pr, pe, pe + pr AS pharmacy_claims FROM pr FULL OUTER JOIN pe ON pr.zip IS NOT DISTINCT FROM pe.zip),
    combined AS (SELECT coalesce(medical.zip, pharmacy.zip) AS zip, mr, me, pr, pe, medical_claims, pharmacy_claims,
      medical_claims + pharmacy_claims AS total_claims, me + pe AS employee_claims
      FROM medical FULL OUTER JOIN pharmacy ON medical.zip IS NOT DISTINCT FROM pharmacy.zip)"""
ALL_SHEETS = ctes(*SHEETS)
CLAIM_COLUMNS = ("mr", "me", "pr", "pe", "medical_claims", "pharmacy_claims", "total_claims", "employee_claims")


@add(
    "four_way_claims_join", "D6",
    f"{ALL_SHEETS}, {COMBINED} SELECT zip, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in CLAIM_COLUMNS)} FROM combined",
)
def _(spark, sf):
    out = claims.combine_claims(*[fact(spark, sf, name) for name in SHEETS])
    return out.select("zip", *[F.col(c).cast("double") for c in CLAIM_COLUMNS])


@add(
    "claims_totals_per_zip", "D6",
    f"""{ALL_SHEETS}, {COMBINED} SELECT zip, {money('medical_claims')} AS medical_claims, {money('pharmacy_claims')} AS pharmacy_claims,
    {money('total_claims')} AS total_claims FROM combined GROUP BY zip""",
)
def _(spark, sf):
    # same sums as grouping the four-way join, from one aggregation
    out = claims.claims_by_zip({name: fact(spark, sf, name) for name in SHEETS})
    return out.select("zip", *[F.col(c).cast("double") for c in claims.TOTALS])


@add(
    "spine_extending_outer_join", "D7",
    f"""{ctes('spend', 'spine')}, {CITY_SPEND} SELECT coalesce(s.city, m.city) AS city, s.county, m.spend
    FROM spine s FULL OUTER JOIN metric m ON s.city IS NOT DISTINCT FROM m.city""",
)
def _(spark, sf):
    return joins.attach_metric(fact(spark, sf, "spine"), _city_spend(spark, sf), "city", how="outer").drop("ord")


@add("rows_without_match", "D8", "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def _(spark, sf):
    return joins.anti_join(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


@add(
    "position_location_join", "D9",
    "SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _(spark, sf):
    positions = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    places = table(spark, sf, "customer").withColumnsRenamed({"c_custkey": "o_custkey", "c_acctbal": "o_totalprice"})
    return joins.attach_location(positions, places, "o_custkey", ["o_orderkey", "o_custkey", "c_name", "c_mktsegment"])


@add(
    "key_uniqueness_audit", "D10",
    "SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1",
)
def _(spark, sf):
    return joins.audit_unique(table(spark, sf, "orders"), "o_custkey")


@add(
    "unmatched_keys", "D11",
    f"{ctes('spend', 'spine')} SELECT DISTINCT city FROM spend f WHERE NOT EXISTS (SELECT 1 FROM spine s WHERE s.city IS NOT DISTINCT FROM f.city)",
)
def _(spark, sf):
    return joins.unmatched_keys(fact(spark, sf, "spend"), fact(spark, sf, "spine"), "city")


@add(
    "first_city_bridge", "D12",
    f"""{ctes('state_surplus', 'donees')}, firsts AS (SELECT donee, arg_min(city, seq) AS city FROM donees WHERE city IS NOT NULL GROUP BY donee)
    SELECT f.donee, firsts.city, CAST(count(*) AS BIGINT) AS n, CAST(sum(items) AS BIGINT) AS items
    FROM (SELECT donee, line_items AS items FROM state_surplus) f LEFT JOIN firsts ON f.donee = firsts.donee GROUP BY ALL""",
)
def _(spark, sf):
    rows = fact(spark, sf, "state_surplus").select("donee", F.col("line_items").alias("items"))
    named = joins.bridge_first(rows, fact(spark, sf, "donees"), "donee", "city", ["seq"])
    return named.groupBy("donee", "city").agg(F.count("*").alias("n"), F.sum("items").alias("items"))
