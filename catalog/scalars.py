"""Scalar functions and free-text location."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import LINE_KEY, LINE_ORDER, add, ctes, fact, money, table
from plumbline.functions import dates, numbers, text
from plumbline.operators import clean, locate


def _spend(name, ids, column, sql_expr):
    """Register one expression over the whole spend table."""

    def register(fn):
        @add(name, ids, f"{ctes('spend')} SELECT invoice, {sql_expr} AS result FROM spend")
        def query(spark, sf):
            return fact(spark, sf, "spend").select("invoice", fn(F.col(column)).alias("result"))

        return query

    return register


_spend("upper_case", "G1", "city", "upper(city)")(text.upper_key)
_spend("strip_blanks", "G2", "city", "trim(city)")(text.strip)
_spend("left_strip", "G3", "city", "ltrim(city)")(text.lstrip)
_spend("right_strip", "G4", "city", "rtrim(city)")(text.rstrip)
_spend("strip_currency_sign", "G5", "amount_usd", "ltrim('$' || amount_usd, '$')")(
    lambda c: text.strip_currency(F.concat(F.lit("$"), c))
)
_spend("remove_thousands_separators", "G6", "amount", "replace(amount, ',', '')")(text.strip_commas)
_spend("money_text_to_number", "G8", "amount_usd", "CAST(price AS DOUBLE)")(
    lambda c: text.parse_money(c).cast("double")
)
_spend("cast_to_double", "G9", "price", "CAST(price AS DOUBLE)")(numbers.to_double)
_spend("cast_to_string", "G10", "invoice", "CAST(invoice AS VARCHAR)")(numbers.to_string)
_spend("append_suffix", "G11", "city", "city || ' County'")(lambda c: text.append_suffix(c, " County"))
_spend("first_word", "G12", "priority", "split_part(priority, ' ', 1)")(lambda c: text.first_token(c, " "))
_spend("last_part", "G13", "amount", "list_extract(string_split(amount, ','), -1)")(lambda c: text.last_token(c, ","))
_spend("ceiling_of_half", "G17", "invoice", "CAST((invoice + 1) // 2 AS BIGINT)")(numbers.ceil_half)


@add(
    "comma_removal_in_all_text_columns", "G7",
    f"{ctes('spend')} SELECT invoice, replace(city, ',', '') AS city, replace(amount, ',', '') AS amount, "
    "replace(amount_usd, ',', '') AS amount_usd FROM spend",
)
def _(spark, sf):
    return clean.regexp_replace_all(fact(spark, sf, "spend").select("invoice", "city", "amount", "amount_usd"), ",", "")


ADDRESS = "upper(trim(list_extract(string_split(address, ','), -1)))"
ZIP = f"nullif(regexp_extract({ADDRESS}, '([0-9]{{5}})-?[0-9]*', 1), '')"


@add(
    "zip_from_address", "G14",
    f"{ctes('certified')} SELECT {LINE_KEY}, {ZIP} AS zip FROM certified",
)
def _(spark, sf):
    zipped = text.extract_zip(text.strip(text.last_token(F.col("address"))))
    return fact(spark, sf, "certified").select(*LINE_ORDER, zipped.alias("zip"))


@add(
    "city_from_address", "G25",
    f"""{ctes('certified', 'zips')}, zipped AS (SELECT {LINE_KEY}, {ZIP} AS zip FROM certified)
    SELECT {LINE_KEY}, zip, z.city FROM zipped LEFT JOIN zips z USING (zip)""",
)
def _(spark, sf):
    rows = fact(spark, sf, "certified").select(*LINE_ORDER, "address")
    return locate.city_from_address(rows, "address", fact(spark, sf, "zips")).drop("address")


@add(
    "spelling_map_replacement", "G15",
    f"{ctes('spend', 'replacements')} SELECT invoice, coalesce(m.fixed, city) AS city "
    "FROM spend LEFT JOIN replacements m ON city = m.wrong",
)
def _(spark, sf):
    return clean.replace_values(
        fact(spark, sf, "spend").select("invoice", "city"), ["city"], fact(spark, sf, "replacements")
    )


@add(
    "literal_map_replacement", "G16",
    f"""{ctes('spend')} SELECT invoice, CASE place WHEN 'NATION_1' THEN 'NATION_2' WHEN 'NATION_2' THEN 'NATION_3'
    ELSE place END AS place, CASE priority WHEN '5-LOW' THEN 'LOW' ELSE priority END AS priority FROM spend""",
)
def _(spark, sf):
    rows = fact(spark, sf, "spend").select("invoice", "place", "priority")
    pairs = {"NATION_1": "NATION_2", "NATION_2": "NATION_3", "5-LOW": "LOW"}
    return clean.replace_literals(rows, ["place", "priority"], pairs)


@add(
    "annualized_pay", "G18",
    f"""{ctes('positions')} SELECT pay_code, vacant, {money("base_rate * CASE pay_code WHEN 'M' THEN 12 WHEN 'B' THEN 26 END")} AS pay,
    CAST(count(CASE WHEN pay_code IN ('M', 'B') THEN base_rate END) AS BIGINT) AS paid FROM positions GROUP BY ALL""",
)
def _(spark, sf):
    pay = numbers.annualize(F.col("base_rate"), F.col("pay_code"))
    rows = fact(spark, sf, "positions").select("pay_code", "vacant", pay.alias("pay"))
    return rows.groupBy("pay_code", "vacant").agg(
        F.coalesce(F.sum("pay"), F.lit(0)).cast("double").alias("pay"), F.count("pay").alias("paid")
    )


@add(
    "annualized_hourly_pay", "G19",
    f"""{ctes('positions')} SELECT emp_type, pay_code, {money('''CASE WHEN emp_type IN (4, 5) THEN base_rate * fte * 2000
      WHEN pay_code = 'M' THEN base_rate * 12 WHEN pay_code = 'B' THEN base_rate * 26 END''')} AS pay
    FROM positions GROUP BY ALL""",
)
def _(spark, sf):
    pay = numbers.annualize_hourly(F.col("base_rate"), F.col("fte"), F.col("emp_type"), F.col("pay_code"))
    rows = fact(spark, sf, "positions").select("emp_type", "pay_code", pay.alias("pay"))
    return rows.groupBy("emp_type", "pay_code").agg(F.coalesce(F.sum("pay"), F.lit(0)).cast("double").alias("pay"))


# The first city in spine order wins, not the longest.
CITY_HIT = "(SELECT arg_min(s.city, s.ord) FROM spine s WHERE contains({t}, s.city))"
WORDS = """words AS (SELECT upper(split_part(county, ' ', 1)) AS word, arg_min(upper(city), ord) AS city, min(ord) AS ord
    FROM spine GROUP BY county)"""
COUNTY_HIT = "(SELECT arg_min(w.city, w.ord) FROM words w WHERE contains({t}, w.word))"


@add(
    "first_listed_city_in_text", "G20",
    f"""{ctes('travel', 'spine')}, texts AS (SELECT DISTINCT destination FROM travel)
    SELECT destination, {CITY_HIT.format(t='upper(destination)')} AS city FROM texts""",
)
def _(spark, sf):
    texts = fact(spark, sf, "travel").select("destination").distinct()
    return locate.first_contained(texts, F.upper("destination"), fact(spark, sf, "spine"), "city", "ord", "city")


# All words of all benchmark texts, in the order in which they first occur.
BENCH_WORDS = """words AS (SELECT word, min(item_id * 1000000 + place) AS ord FROM (
    SELECT item_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS place FROM benchmark) w
    WHERE length(word) > 0 GROUP BY word)"""


def _bench_words(spark, sf):
    words = table(spark, sf, "benchmark").select("item_id", F.posexplode(F.split("text", " ", -1)).alias("at", "word"))
    place = F.col("item_id") * 1_000_000 + F.col("at") + 1
    return words.filter(F.length("word") > 0).groupBy("word").agg(F.min(place).alias("ord"))


@add(
    "first_listed_word_in_documents", "G20",
    f"""WITH {BENCH_WORDS} SELECT doc_id, arg_min(word, ord) AS word FROM documents LEFT JOIN words
    ON contains(text, word) GROUP BY doc_id""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return locate.first_contained(docs, F.col("text"), _bench_words(spark, sf), "word", "ord", "word").drop("text")


# The last listed first, through the index.
@add(
    "first_listed_word_by_prefix_join", "G20",
    f"""WITH {BENCH_WORDS} SELECT doc_id, arg_min(word, -ord) AS word FROM documents LEFT JOIN words
    ON contains(text, word) GROUP BY doc_id""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    words = _bench_words(spark, sf).withColumn("ord", -F.col("ord"))
    # the route for dictionaries too large for a constant
    return locate.first_contained(docs, F.col("text"), words, "word", "ord", "word", max_terms=0).drop("text")


@add(
    "county_word_fallback", "G21",
    f"""{ctes('travel', 'spine')}, {WORDS}, texts AS (SELECT DISTINCT destination FROM travel)
    SELECT destination, {COUNTY_HIT.format(t='upper(destination)')} AS city FROM texts""",
)
def _(spark, sf):
    texts = fact(spark, sf, "travel").select("destination").distinct()
    return locate.first_contained_county(texts, F.upper("destination"), fact(spark, sf, "spine"), "city")


@add(
    "free_text_location", "G22",
    f"""{ctes('travel', 'spine')}, {WORDS} SELECT row_id, coalesce({CITY_HIT.format(t='upper(destination)')},
    {COUNTY_HIT.format(t='upper(destination)')}, upper(destination)) AS city FROM travel""",
)
def _(spark, sf):
    rows = fact(spark, sf, "travel").select("row_id", "destination")
    return locate.resolve_location(rows, "destination", fact(spark, sf, "spine"), "city").drop("destination")


FY20 = "effective_on BETWEEN DATE '2019-07-01' AND DATE '2020-06-30' AND effective_on <> DATE '2020-06-29'"


@add(
    "either_endpoint_in_year", "G23",
    f"{ctes('certified')} SELECT {LINE_KEY} FROM certified WHERE ({FY20}) OR ({FY20.replace('effective', 'expire')})",
)
def _(spark, sf):
    first, last = dates.fiscal_bounds("19-20")
    hit = dates.endpoint_in_range(F.col("effective_on"), F.col("expire_on"), first, last, 365)
    return fact(spark, sf, "certified").filter(hit).select(*LINE_ORDER)


@add(
    "either_endpoint_in_true_year", "G23",
    f"""{ctes('certified')} SELECT {LINE_KEY} FROM certified WHERE effective_on BETWEEN DATE '2019-07-01' AND DATE '2020-06-30'
    OR expire_on BETWEEN DATE '2019-07-01' AND DATE '2020-06-30'""",
)
def _(spark, sf):
    first, last = dates.fiscal_bounds("19-20")
    hit = dates.endpoint_in_range(F.col("effective_on"), F.col("expire_on"), first, last)
    return fact(spark, sf, "certified").filter(hit).select(*LINE_ORDER)


@add(
    "orders_per_fiscal_day", "G24",
    f"""{ctes('spend')}, days AS (SELECT CAST(unnest(generate_series(DATE '2019-07-01', DATE '2020-06-30', INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT CAST(d.day AS VARCHAR) AS day, CAST(count(s.invoice) AS BIGINT) AS n FROM days d LEFT JOIN spend s ON s.day = d.day
    WHERE d.day <> DATE '2020-06-29' GROUP BY d.day""",
)
def _(spark, sf):
    per_day = fact(spark, sf, "spend").groupBy("day").agg(F.count("invoice").alias("n"))
    days = dates.fiscal_days(spark, "19-20", 365).join(per_day, "day", "left")
    return days.select(F.col("day").cast("string"), F.coalesce("n", F.lit(0)).alias("n"))
