"""Registry of queries, inputs derived from the test tables, SQL helpers.

The inputs play the part of the raw administrative sources. Each is one SQL
text that both engines run over whole tables; only the money format differs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.plans.cleaning import Refs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
IDS: dict[str, str] = {}


def add(name: str, ids: str, sql: str | None):
    """Register a query under the survey rows it covers."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name], IDS[name] = fn, ids
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "pages", "benchmark", "labels", "conversations",
)


_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Keep the plan of an input (not its rows) for the life of the session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FRAMES:
        _FRAMES[key] = build()
    return _FRAMES[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return _once(spark, sf, f"table {name}", lambda: spark.read.parquet(f"{sf}/{name}.parquet"))


# Dates of the test tables are moved into the years the jobs know.
def _day(column: str) -> str:
    return f"CAST({column} + INTERVAL '22' YEAR AS DATE)"


def _fy(column: str) -> str:
    day = _day(column)
    start = f"(year({day}) - CASE WHEN month({day}) >= 7 THEN 0 ELSE 1 END)"
    return (
        f"lpad(CAST({start} % 100 AS STRING), 2, '0') || '-' || lpad(CAST(({start} + 1) % 100 AS STRING), 2, '0')"
    )


ORDER_DAY, SHIP_DAY = _day("o_orderdate"), _day("l_shipdate")

# A city name with the faults of a typed one: case, blanks, spelling, none.
ORDER_CITY = """CASE o_orderpriority
    WHEN '1-URGENT' THEN lower(n_name)
    WHEN '2-HIGH' THEN '  ' || n_name || ' '
    WHEN '3-MEDIUM' THEN 'NATN_' || CAST(n_nationkey AS STRING)
    WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN ' ' ELSE n_name END
    ELSE n_name END"""
LINE_CITY = """CASE l_returnflag
    WHEN 'A' THEN CASE l_linestatus WHEN 'F' THEN lower(n_name) ELSE '  ' || n_name || ' ' END
    WHEN 'N' THEN CASE l_linestatus WHEN 'F' THEN 'NATN_' || CAST(n_nationkey AS STRING) ELSE n_name END
    ELSE CASE WHEN l_linestatus = 'F' THEN n_name WHEN l_discount < 0.05 THEN NULL ELSE ' ' END END"""
CUSTOMER_CITY = """CASE c_mktsegment WHEN 'BUILDING' THEN lower(n_name) WHEN 'MACHINERY' THEN ' ' || n_name
    WHEN 'HOUSEHOLD' THEN 'NATN_' || CAST(n_nationkey AS STRING) ELSE n_name END"""
COUNTY = """CASE c_mktsegment WHEN 'BUILDING' THEN ' ' || r_name WHEN 'MACHINERY' THEN NULL
    WHEN 'FURNITURE' THEN 'X' || r_name ELSE r_name END"""
LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
LINE_ORDER = [c.strip() for c in LINE_KEY.split(",")]

_ORDERS = "{orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"
_LINES = "{lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey"
_CUSTOMERS = "{customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
_SUPPLIERS = "{supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"


def _money(x: str) -> str:
    return f"CAST({x} AS decimal(18,2))"


def _parts(x: str) -> str:
    """Amounts with parts of a cent."""
    return f"({_money(x)} * CAST(0.0013 AS decimal(6,4)))"


# Values that the spelling map also hits, so that two spellings of one count once.
def _spelled(x: str) -> str:
    return f"CASE {x} % 10 WHEN 0 THEN 'NATN_' || CAST(n_nationkey AS STRING) WHEN 1 THEN n_name ELSE CAST({x} AS STRING) END"


def _claims(priority: str) -> str:
    blank = " || CASE WHEN o_orderstatus = 'O' THEN ' ' ELSE '' END" if priority[0] in "14" else ""
    return f"""SELECT {_fy('o_orderdate')} AS fy,
        nullif(lpad(CAST(o_custkey AS STRING), 9, '0'), '000000000'){blank} AS zip,
        CAST(SUM({_money('o_totalprice')}) AS DOUBLE) AS enrollee,
        CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(COUNT(*) AS DOUBLE) END AS dependents
      FROM {{orders}} WHERE o_orderpriority = '{priority}' GROUP BY {_fy('o_orderdate')}, o_custkey, o_orderstatus"""


FACTS = {
    "spine": """SELECT n_name AS city, r_name || ' County' AS county, n_nationkey AS ord
      FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "zips": """SELECT lpad(CAST(n_nationkey AS STRING), 5, '0') AS zip,
        CASE n_regionkey WHEN 1 THEN ' ' || n_name WHEN 2 THEN 'NATN_' || CAST(n_nationkey AS STRING)
          ELSE n_name END AS city
      FROM {nation} WHERE n_regionkey <> 3""",
    "customer_zips": f"""SELECT lpad(CAST(c_custkey AS STRING), 9, '0') AS zip, {CUSTOMER_CITY} AS city
      FROM {_CUSTOMERS} WHERE c_mktsegment <> 'FURNITURE'""",
    "replacements": """SELECT 'NATN_' || CAST(n_nationkey AS STRING) AS wrong, n_name AS fixed FROM {nation}
      UNION ALL SELECT n_name, 'NATION_' || CAST(n_nationkey + 1 AS STRING) FROM {nation} WHERE n_nationkey IN (7, 8)
      UNION ALL SELECT 'X' || r_name || ' County', r_name || ' County' FROM {region}""",
    "exclusions": "SELECT n_name AS listed FROM {nation} WHERE n_regionkey = 4",
    "spend": f"""SELECT o_orderkey AS invoice, {_fy('o_orderdate')} AS fy,
        CASE o_orderstatus WHEN 'F' THEN 'HS' WHEN 'O' THEN 'XS' END AS state, {ORDER_CITY} AS city, n_name AS place,
        @money(o_totalprice) AS amount, '$' || @money(o_totalprice) AS amount_usd, {_money('o_totalprice')} AS price,
        {_spelled('o_custkey')} AS vendor, o_orderpriority AS priority, {ORDER_DAY} AS day
      FROM {_ORDERS}""",
    "site_circuits": f"""SELECT {_fy('o_orderdate')} AS fy, {_spelled('o_custkey')} AS inventory_id,
        {ORDER_CITY} AS city, {_money('o_totalprice')} AS retail FROM {_ORDERS}""",
    "zip_circuits": f"""SELECT {_fy('o_orderdate')} AS fy, lpad(CAST(c_nationkey AS STRING), 5, '0') AS zip,
        CAST(length(o_orderpriority) AS BIGINT) AS circuits, {_money('o_totalprice')} AS charge FROM {_ORDERS}""",
    "phones_local": f"""SELECT {_fy('o_orderdate')} AS fy, {ORDER_CITY} AS city, {_parts('o_totalprice')} AS charges
      FROM {_ORDERS} WHERE o_orderstatus <> 'F'""",
    "phones_internet": f"""SELECT {_fy('o_orderdate')} AS fy, {ORDER_CITY} AS city, {_parts('o_totalprice')} AS charges
      FROM {_ORDERS} WHERE n_regionkey <> 0""",
    "medical_retiree": _claims("1-URGENT"),
    "medical_active": _claims("2-HIGH"),
    "pharmacy_retiree": _claims("3-MEDIUM"),
    "pharmacy_active": _claims("4-NOT SPECIFIED"),
    "fleet": f"""SELECT {_fy('l_shipdate')} AS fy,
        CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN '--' ELSE {LINE_CITY} END AS city,
        nullif(l_partkey, 0) AS asset,
        CASE WHEN l_returnflag = 'N' THEN '--' ELSE CAST({_money('l_extendedprice')} AS STRING) END AS operating_cost,
        CASE WHEN l_linestatus = 'O' THEN '--' ELSE CAST({_money('l_quantity')} AS STRING) END AS maintenance_cost,
        CAST({_money('l_tax')} AS STRING) AS fuel_cost FROM {_LINES}""",
    "prisons": f"SELECT s_name AS facility, {_money('s_acctbal')} AS reimbursement FROM {{supplier}}",
    "prison_locations": f"""SELECT s_name AS facility, n_name AS city, r_name AS district
      FROM {_SUPPLIERS} WHERE n_regionkey IN (0, 1)""",
    "federal_surplus": f"""SELECT {_fy('l_shipdate')} AS fy,
        CAST(year({SHIP_DAY}) AS STRING) || '-' || lpad(CAST(month({SHIP_DAY}) AS STRING), 2, '0') AS sheet,
        {LINE_CITY} AS agency, nullif(l_linenumber, 7) AS invoice, {_money('l_extendedprice')} AS acquisition_cost,
        CASE WHEN l_tax = 0 THEN NULL ELSE {_money('l_tax')} END AS service_charge,
        {_money('l_extendedprice')} AS savings, CAST(l_quantity AS BIGINT) AS items, {LINE_KEY} FROM {_LINES}""",
    "state_surplus": f"""SELECT {_fy('l_shipdate')} AS fy, {LINE_CITY} AS city, CAST(l_suppkey AS STRING) AS donee,
        nullif(CAST(l_linenumber AS BIGINT), 3) AS line_items, '$' || @money(l_extendedprice) AS savings,
        '$' || @money(l_extendedprice) AS direct_cost, '$' || @money(l_quantity) AS federal_cost,
        '$$' || @money(l_discount) AS overseas_cost,
        CASE WHEN l_tax = 0 THEN NULL ELSE '$' || @money(l_tax) END AS service_charge,
        {LINE_KEY} FROM {_LINES}""",
    "donees": f"""SELECT CAST(s_suppkey AS STRING) AS donee, 1 AS seq,
        CASE WHEN s_acctbal < 3000 THEN NULL ELSE ' ' || n_name END AS city FROM {_SUPPLIERS}
      UNION ALL SELECT CAST(s_suppkey AS STRING), 2, 'NATN_' || CAST(n_nationkey AS STRING) FROM {_SUPPLIERS}
      UNION ALL SELECT CAST(s_suppkey AS STRING), 3, 'NATION_1' FROM {_SUPPLIERS}""",
    "certified": f"""SELECT nullif(CAST(l_partkey AS STRING), '0') AS tax_id,
        CASE WHEN l_discount = 0.1 THEN NULL ELSE s_name END AS business, {ORDER_DAY} AS effective_on,
        {SHIP_DAY} AS expire_on, s_name || ', ' || n_name || ', ' || lpad(CAST(n_nationkey AS STRING), 5, '0')
          || CASE l_returnflag WHEN 'A' THEN '-0001' ELSE ' ' END AS address,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'FERN' ELSE {LINE_CITY} END AS city,
        {_fy('l_shipdate')} AS fy, {LINE_KEY}
      FROM {_LINES} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "positions": f"""SELECT {_fy('l_shipdate')} AS fy, l_linenumber AS emp_type, {LINE_CITY} AS city,
        CASE WHEN l_linestatus = 'F' THEN lower(n_name) WHEN l_linenumber = 3 THEN NULL ELSE ' ' || n_name END AS home_city,
        CAST(l_partkey AS STRING) AS position, CASE WHEN l_quantity < 10 THEN 'Y' END AS vacant,
        {_money('l_extendedprice')} AS base_rate,
        CASE l_returnflag WHEN 'A' THEN 'M' WHEN 'N' THEN 'B' ELSE 'H' END AS pay_code, {_money('l_discount')} AS fte,
        CASE WHEN l_tax = 0 THEN NULL ELSE {_money('l_extendedprice')} END AS salary, {_money('l_tax')} AS health
      FROM {_LINES}""",
    "facilities": f"""SELECT {_fy('l_shipdate')} AS fy, l_linestatus AS agency, nullif(l_linenumber, 2) AS id,
        {LINE_CITY} AS city, {_parts('l_quantity')} AS square_feet, {_money('l_extendedprice')} AS land,
        {_money('l_discount')} AS structure, {_money('l_tax')} AS utilities,
        CASE WHEN l_returnflag = 'A' THEN NULL ELSE {_money('l_quantity')} END AS operating FROM {_LINES}""",
    "expenses": f"""SELECT {CUSTOMER_CITY} AS city,
        CASE event_type WHEN 'view' THEN 'Utilities' WHEN 'click' THEN 'O&M Expenses'
          WHEN 'purchase' THEN 'Total Direct Expenses' WHEN 'error' THEN 'Other' END AS category,
        {_money('value')} AS amount
      FROM {{events}} JOIN {{customer}} ON user_id = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "construction": f"""SELECT {_fy('o_orderdate')} AS fy, {ORDER_CITY} AS city, {_parts('o_totalprice')} AS funds
      FROM {_ORDERS}""",
    "retirees": f"""SELECT {_fy('o_orderdate')} AS fy, o_orderkey AS row_id,
        CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '75791'
          WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN '95136'
          ELSE lpad(CAST(c_nationkey AS STRING), 5, '0') END AS zip,
        {_money('o_totalprice')} AS payment, CAST(length(o_orderpriority) AS BIGINT) AS payees,
        CAST(year({ORDER_DAY}) AS STRING) AS fiscal_year FROM {_ORDERS}""",
    "employers": f"""SELECT {_fy('o_orderdate')} AS fy, o_orderkey AS row_id, {_spelled('o_custkey')} AS agency,
        {ORDER_CITY} AS city, {_money('o_totalprice')} AS contribution,
        CAST(year({ORDER_DAY}) AS STRING) AS fiscal_year FROM {_ORDERS}""",
    "travel": f"""SELECT {_fy('o_orderdate')} AS fy, CASE o_orderpriority
          WHEN '1-URGENT' THEN 'visit ' || lower(n_name) || ' office'
          WHEN '2-HIGH' THEN 'hq of ' || lower(r_name)
          WHEN '3-MEDIUM' THEN 'NATN_' || CAST(n_nationkey AS STRING)
          WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'P' THEN NULL ELSE ' remote ' END
          ELSE n_name || ' then NATION_1' END AS destination,
        {_parts('o_totalprice')} AS amount, o_orderkey AS row_id
      FROM {_ORDERS} JOIN {{region}} ON n_regionkey = r_regionkey""",
    "county_facts": f"""SELECT c_custkey AS row_id, {COUNTY} AS county, {_money('c_acctbal')} AS final_award,
        {_money('c_acctbal')} AS total, {_money('c_acctbal')} AS wireless, {_money('c_nationkey')} AS nonwireless,
        CASE WHEN n_regionkey = 2 THEN NULL ELSE {_money('c_acctbal')} END AS prepaid_wireless,
        {_money('n_regionkey')} AS supplemental, {_money('c_nationkey')} AS special,
        '$' || @money(abs(c_acctbal)) || ' ' AS authorized,
        CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS center FROM {_CUSTOMERS}""",
    "erate": f"""SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN r_name || ',' WHEN 'HOUSEHOLD' THEN 'Dade'
          ELSE {COUNTY} END AS county, '$' || @money(abs(c_acctbal)) || ' ' AS authorized FROM {_CUSTOMERS}""",
    "towers": f"""SELECT CASE WHEN s_acctbal < 1000 THEN 'Dade County' WHEN s_acctbal < 3000 THEN ' ' || r_name
          ELSE r_name END AS county, CASE WHEN s_acctbal > 9000 THEN NULL ELSE s_name END AS tower FROM {_SUPPLIERS}""",
}

# Inputs the cleaning steps refer to.
REFS = ("spine", "zips", "replacements", "exclusions")


def _macros(sql: str, money: str) -> str:
    return re.sub(r"@money\(((?:[^()]|\([^()]*\))*)\)", lambda m: money.replace("?", m.group(1)), sql)


def fact(spark: SparkSession, sf: str, name: str) -> DataFrame:
    sql = _macros(FACTS[name], "format_number(?, 2)")
    used = {t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in sql}
    return _once(spark, sf, name, lambda: spark.sql(sql, **used))


def refs(spark: SparkSession, sf: str, zips: str = "zips") -> Refs:
    return Refs(
        spine=fact(spark, sf, "spine"),
        zips=fact(spark, sf, zips),
        replacements=fact(spark, sf, "replacements"),
        exclusions=fact(spark, sf, "exclusions"),
    )


def ctes(*names: str) -> str:
    """``WITH`` list of the named inputs, in DuckDB's dialect."""
    parts = []
    for name in names:
        body = FACTS[name].format(**{t: t for t in TABLES})
        parts.append(f"{name} AS ({_macros(body, chr(39).join(['format(', '{:,.2f}', ', ?)']))})")
    return "WITH " + ",\n".join(parts)


def cleaned(source: str, key: str, steps: str, *, zips: str = "zips", inline: dict | None = None, drop_zips=(), texts=()) -> str:
    """Subquery that applies cleaning steps in SQL, written apart from the
    Spark ones."""
    q = f"(SELECT * FROM {source})"
    one = {
        "U": "upper({k})", "S": "trim({k})", "L": "ltrim({k})", "T": "rtrim({k})", "C": "{k} || ' County'",
        "F": "CASE WHEN {k} IS NULL OR {k} = ' ' THEN 'UNDEFINED' ELSE {k} END",
    }
    for step in steps.split():
        if step in one:
            q = f"(SELECT * REPLACE ({one[step].format(k=key)} AS {key}) FROM {q})"
        elif step == "R":
            q = f"(SELECT f.* REPLACE (coalesce(m.fixed, f.{key}) AS {key}) FROM {q} f LEFT JOIN replacements m ON f.{key} = m.wrong)"
            for t in texts:
                q = f"(SELECT f.* REPLACE (coalesce(m.fixed, f.{t}) AS {t}) FROM {q} f LEFT JOIN replacements m ON f.{t} = m.wrong)"
        elif step == "M":
            whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in (inline or {}).items())
            q = f"(SELECT * REPLACE (CASE {key} {whens} ELSE {key} END AS {key}) FROM {q})"
        elif step == "X":
            q = f"(SELECT * FROM {q} WHERE {key} IS NULL OR {key} NOT IN (SELECT listed FROM exclusions))"
        elif step == "N":
            q = f"(SELECT * FROM {q} WHERE {key} IS NOT NULL)"
        elif step == "V":
            q = f"(SELECT * FROM {q} WHERE vacant IS DISTINCT FROM 'Y')"
        elif step == "Q":
            listed = ", ".join(f"'{z}'" for z in drop_zips)
            q = f"(SELECT * FROM {q} WHERE zip IS NULL OR zip NOT IN ({listed}))"
        elif step == "J":
            q = f"(SELECT f.*, z.city FROM {q} f LEFT JOIN {zips} z ON f.zip IS NOT DISTINCT FROM z.zip)"
        else:
            raise ValueError(step)
    return q


def money(expr: str) -> str:
    """Exact sum, 0 for nothing, double at the end."""
    return f"CAST(coalesce(sum({expr}), 0) AS DOUBLE)"


def whole(expr: str) -> str:
    return f"CAST(coalesce(sum({expr}), 0) AS BIGINT)"
