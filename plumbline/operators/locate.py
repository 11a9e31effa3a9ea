"""Find a place in free text or in an address."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import extract_zip, first_token, last_token, strip
from plumbline.operators.clean import dedup_first
from plumbline.operators.joins import enrich
from plumbline.session import written

# A dictionary up to this many terms is put into the plan as a constant.
MAX_TERMS = 2000
# Of a larger one the first HEAD terms are, and the others are found by grams:
# a term of at least so many characters by one gram of that length, a shorter
# one by itself.
HEAD, GRAMS = 64, (6, 3)
# Up to this many grams are put into the plan to cut the texts' grams by.
MOST_GRAMS = 20_000


def _first_of(text: Column, pairs: list[tuple[str, str]], chunk: int = 16) -> Column:
    """(t, v) of the first pair whose term is in the text, else null. A chunk of
    the list is searched at a time, so that an early hit ends it."""
    if not pairs:
        return F.lit(None).cast("struct<t:string,v:string>")
    hits = []
    for i in range(0, len(pairs), chunk):
        listed = json.dumps([{"t": t, "v": v} for t, v in pairs[i : i + chunk]])
        # one text literal, which the optimizer folds to an array
        terms = F.from_json(F.lit(listed), "array<struct<t:string,v:string>>")
        hits.append(F.get(F.filter(terms, lambda p: F.contains(text, p["t"])), F.lit(0)))
    return F.coalesce(*hits)


def first_contained(
    df: DataFrame,
    text: Column,
    dictionary: DataFrame,
    term: str,
    order: str,
    out: str,
    *,
    value: str | None = None,
    max_terms: int = MAX_TERMS,
) -> DataFrame:
    """Add ``out``: the dictionary's first term in ``order`` found in ``text``,
    or that term's ``value`` as text; null if none is.

    Terms are matched as substrings, so the first listed wins over a longer
    one, an empty term is in every text, and a null term or text in none. A
    null ``order`` comes first; of terms with the same order the one with the
    least value does, null before all. The first term found decides, also when
    its value is null.

    A dictionary of at most ``max_terms`` becomes a constant in a projection.
    Of a larger one the first terms do, and texts without any of them are
    looked up in an index of the others: each term lies under the one of its
    grams that the fewest terms share, and only texts that hold that gram are
    searched for the term. Both ways give the same.
    """
    value = value or term
    terms = dictionary.filter(F.col(term).isNotNull()).select(
        F.col(term).alias("_term"), F.col(order).alias("_rank"), F.col(value).cast("string").alias("_value")
    )
    ordered = terms.orderBy(F.col("_rank").asc_nulls_first(), F.col("_value").asc_nulls_first(), "_term")
    held = [(r["_term"], r["_value"]) for r in ordered.limit(max(max_terms, HEAD) + 1).collect()]
    if len(held) <= max_terms:
        return df.withColumn(out, _first_of(text, held)["v"])
    return _first_contained_index(df, text, terms, held[:HEAD], out)


def term_index(terms: DataFrame) -> DataFrame:
    """(_gram, _size, _term, _rank, _value): every non-empty term under the one
    of its grams that is in the fewest terms."""
    length = F.length("_term")
    size = F.when(length >= GRAMS[0], GRAMS[0]).when(length >= GRAMS[1], GRAMS[1]).otherwise(length)
    sized = terms.where(length > 0).select("*", size.alias("_size"))
    places = F.sequence(F.lit(1), F.length("_term") - F.col("_size") + 1)
    distinct = sized.select("_term", "_size").distinct()
    grams = distinct.select("_term", F.explode(F.array_distinct(F.transform(places, lambda i: F.substr("_term", i, F.col("_size"))))).alias("_gram"))
    shared = grams.groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = grams.join(shared, "_gram").groupBy("_term").agg(F.min(F.struct("_n", "_gram"))["_gram"].alias("_gram"))
    return sized.join(rarest, "_term")


def _first_contained_index(df: DataFrame, text: Column, terms: DataFrame, head: list[tuple[str, str]], out: str) -> DataFrame:
    """As :func:`first_contained`, where ``head`` are the first of the terms.
    They stay in the index, as other terms may tie with the last of them."""
    # An empty term is in every text: of these the first is a bound for all.
    empty = terms.filter(F.length("_term") == 0).agg(F.min(F.struct("_rank", "_value")).alias("_all"))
    index = written(term_index(terms), "term-index")
    sizes = {r["_size"]: r["n"] for r in index.groupBy("_size").agg(F.count_distinct("_gram").alias("n")).collect()}  # a few lengths
    few = sum(sizes.values()) <= MOST_GRAMS
    headed = df.withColumn("_text", text).withColumn("_head", _first_of(F.col("_text"), head)).withColumn("_id", F.sha2("_text", 256))
    # written, as the search for the head terms is not to be made twice; a text with one is done with
    keyed = written(headed.withColumn("_text", F.when(F.col("_head").isNull(), F.col("_text"))), "keyed-texts")
    open_texts = keyed.where(F.col("_text").isNotNull() & F.col("_head").isNull())
    if few:
        of_text = _listed_grams(F.col("_text"), index)
    else:
        of_text = F.flatten(F.array(*[_grams_of(F.col("_text"), n) for n in sorted(sizes)]))
    grams = F.explode(of_text).alias("_gram")
    if few:
        # few grams are left of a text, so it goes along with them
        candidates = open_texts.select("_id", "_text", grams).join(index.drop("_size"), "_gram")
    else:
        found = open_texts.select("_id", grams).join(index.drop("_size"), "_gram")
        texts = open_texts.groupBy("_id").agg(F.any_value("_text").alias("_text"))
        candidates = found.join(texts, "_id")
    best = candidates.filter(F.contains("_text", F.col("_term"))).groupBy("_id").agg(F.min(F.struct("_rank", "_value")).alias("_hit"))
    joined = keyed.join(best, "_id", "left")
    # least() skips nulls; a text without a head term may hold an empty one
    tail = F.when(F.col("_text").isNotNull(), F.least("_hit", empty.scalar()))
    first = F.when(F.col("_head").isNotNull(), F.col("_head")["v"]).otherwise(tail["_value"])
    return joined.withColumn(out, first).drop("_id", "_text", "_hit", "_head")


def _grams_of(text: Column, size: int) -> Column:
    """Distinct grams of one length of a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), 1))


def _listed_grams(text: Column, index: DataFrame) -> Column:
    """Distinct grams of a text that the index (of at most MOST_GRAMS grams)
    holds, but those whose terms all come after a term that the text is known
    to hold, as one of the grams found is that term. Grams are looked for in
    the order of their first terms; after some, in the set of the text's own."""
    first = index.groupBy("_size", "_gram").agg(
        F.min(F.struct("_rank")).alias("any"), F.min(F.when(F.col("_term") == F.col("_gram"), F.struct("_rank"))).alias("whole")
    )
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("rank")) for k in ("any", "whole")])
    kinds = first.select("_size", "_gram", F.inline(kinds)).where(F.col("rank").isNotNull())
    listed: dict[int, list[tuple[int, str]]] = {}
    whole: dict[str, int] = {}
    for row in kinds.withColumn("place", F.dense_rank().over(Window.orderBy("rank"))).collect():
        if row["kind"] == "whole":
            whole[row["_gram"]] = row["place"]
        else:
            listed.setdefault(row["_size"], []).append((row["place"], row["_gram"]))
    by_size = [(n, sorted(listed[n])) for n in sorted(listed)]

    def grams_in(t: str) -> list[str]:
        found, bound = [], float("inf")
        for n, grams in by_size:
            own = t
            for i, (place, gram) in enumerate(grams):
                if place > bound:
                    break
                if own is t and i > len(t) // 4:
                    own = {t[k : k + n] for k in range(len(t) - n + 1)}
                if gram in own:
                    found.append((place, gram))
                    bound = min(bound, whole.get(gram, bound))
        return [gram for place, gram in found if place <= bound]

    @F.pandas_udf("array<string>")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([grams_in(t) for t in texts], dtype=object)

    return held(text)


def county_dictionary(geo: DataFrame, city: str, county: str, order: str) -> DataFrame:
    """First word of each county, with the county's first city, in the order
    in which counties first occur."""
    firsts = dedup_first(geo.select(county, city, order), [county], [order])
    return firsts.select(
        F.upper(first_token(F.col(county))).alias("word"), F.upper(F.col(city)).alias("city"), F.col(order).alias("rank")
    )


def first_contained_county(
    df: DataFrame, text: Column, geo: DataFrame, out: str, *, city: str = "city", county: str = "county",
    order: str = "ord", max_terms: int = MAX_TERMS,
) -> DataFrame:
    """Add ``out``: first city of the first county whose first word occurs."""
    words = county_dictionary(geo, city, county, order)
    return first_contained(df, text, words, "word", "rank", out, value="city", max_terms=max_terms)


def resolve_location(
    df: DataFrame, column: str, geo: DataFrame, out: str, *, city: str = "city", county: str = "county",
    order: str = "ord", max_terms: int = MAX_TERMS,
) -> DataFrame:
    """City named in a text, else a city of the county named there, else the
    text itself, in upper case."""
    text = F.upper(F.col(column))
    df = first_contained(df, text, geo, city, order, "_city", max_terms=max_terms)
    df = first_contained_county(df, text, geo, "_city2", city=city, county=county, order=order, max_terms=max_terms)
    return df.withColumn(out, F.coalesce("_city", "_city2", text)).drop("_city", "_city2")


def address_zip(address: Column) -> Column:
    """Zip from the last comma-separated part of an address; a zip is its own."""
    return extract_zip(strip(last_token(address)))


def city_from_address(
    df: DataFrame, address: str, zips: DataFrame, *, zip_col: str = "zip", city: str = "city"
) -> DataFrame:
    """Zip from the last comma-separated part of an address, and its city."""
    zipped = df.withColumn("zip", address_zip(F.col(address)))
    return enrich(zipped, zips.select(F.col(zip_col).alias("zip"), F.col(city).alias("city")), "zip", "zip")
