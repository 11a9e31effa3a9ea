import random
from itertools import product

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions import numbers
from plumbline.operators import aggregates, clean, joins, locate, quality
from plumbline.operators.unions import union_years

CITY = "city string, n int"
ROWS = [("TAMPA", 1), ("OCALA", 2), (None, 3), ("TAMPA", None), ("MIAMI", None), (None, None)]


def test_exclusion_keeps_null(frame, rows):
    df, listed = frame(ROWS, CITY), frame([("OCALA",), ("ELSEWHERE",)], "x string")
    want = [r for r in ROWS if r[0] != "OCALA"]
    assert len(rows(clean.exclude_values(df, "city", listed))) == len(want)
    assert rows(clean.exclude_values(df, "city", ["OCALA", "X"])) == rows(frame(want, CITY))
    assert clean.exclude_values(df, "city", []).count() == len(ROWS)


def test_inequality_keeps_null(frame):
    assert clean.filter_ne(frame(ROWS, CITY), "city", "TAMPA").count() == 4


def test_replacement_from_a_frame_is_one_pass(frame, rows):
    mapping = frame([("a", "b"), ("b", "c")], "wrong string, fixed string")
    df = frame([("a", "b"), ("b", "x"), (None, "a"), ("ab", None)], "k string, other string")
    assert rows(clean.replace_values(df, ["k"], mapping)) == rows(frame([("b", "b"), ("c", "x"), (None, "a"), ("ab", None)], "k string, other string"))
    both = clean.replace_values(df, ["k", "other"], mapping)
    assert both.columns == ["k", "other"]
    assert rows(both) == rows(frame([("b", "c"), ("c", "x"), (None, "b"), ("ab", None)], "k string, other string"))


def test_first_row_per_key_treats_nulls_as_equal(frame, rows):
    df = frame([("a", 3, "z"), ("a", 1, None), (None, 2, "p"), (None, 5, "q")], "k string, n int, v string")
    assert rows(clean.dedup_first(df, ["k"], ["n"])) == [(None, 2, "p"), ("a", 1, None)]


def test_undefined_drop_and_fill(frame, rows):
    df = frame([(None, 1), (" ", 2), ("x", None)], CITY)
    assert rows(clean.undefined_bucket(df, "city"), "city") == [("UNDEFINED",), ("UNDEFINED",), ("x",)]
    assert clean.drop_null(df, ["city", "n"]).count() == 1
    assert clean.drop_null(df, ["city", "n"], "all").count() == 3
    assert rows(clean.fill_null(df, 0), "n") == [(0,), (1,), (2,)]


def test_drops(frame):
    df = frame([(1, 2)], "a int, b int")
    assert clean.drop_if_all_present(df, ["a", "absent"]).columns == ["a", "b"]
    assert clean.drop_if_all_present(df, ["a"]).columns == ["b"]
    assert clean.rename(df, {"a": "c", "absent": "d"}).columns == ["c", "b"]


def test_regexp_on_text_columns_only(frame, rows):
    df = frame([("1,2", 3, None)], "a string, n int, b string")
    assert rows(clean.regexp_replace_all(df, ",", "")) == [("12", 3, None)]


def test_indicator(frame, rows):
    df = frame(ROWS, CITY)
    assert rows(clean.flag_then_filter(df, F.col("n") > 1)) == [(None, 3, "1"), ("OCALA", 2, "1")]


def pandas_merge(a, b, how):
    merged = pd.DataFrame(a, columns=["k", "x"], dtype=object).merge(pd.DataFrame(b, columns=["k", "y"], dtype=object), on="k", how=how)
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in merged.itertuples(index=False)), key=str)


def random_side(rng, n=25):
    return [(rng.choice([None, "a", "b", "c", f"u{rng.randrange(9)}"]), rng.randrange(5)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_joins_match_pandas(frame, seed):
    rng = random.Random(seed)
    a, b = random_side(rng), random_side(rng)
    left, right = frame(a, "k string, x int"), frame(b, "k string, y int")
    collect = lambda df: sorted((tuple(r) for r in df.select("k", "x", "y").collect()), key=str)
    assert collect(joins.outer_join_nullsafe(left, right, "k")) == pandas_merge(a, b, "outer")
    assert collect(joins.outer_join_nullsafe(left, right, "k", skewed=True)) == pandas_merge(a, b, "outer")
    assert collect(joins.enrich(left, right, "k", "k")) == pandas_merge(a, b, "left")
    assert collect(joins.enrich_lookup(left, right, "k", "k")) == pandas_merge(a, b, "left")
    only = [r for r in a if r[0] not in {k for k, _ in b}]
    assert sorted((tuple(r) for r in joins.anti_join(left, right, "k").collect()), key=str) == sorted(only, key=str)



def test_spine_miss_stays_null_and_duplicates_repeat(frame, rows):
    spine = frame([("A",), ("B",), ("C",)], "city string")
    metric = frame([("A", 1), ("A", 2), ("Z", 3)], "city string, m int")
    assert rows(joins.attach_metric(spine, metric, "city")) == [("A", 1), ("A", 2), ("B", None), ("C", None)]
    assert rows(joins.attach_metric(spine, metric, "city", "outer")) == [("A", 1), ("A", 2), ("B", None), ("C", None), ("Z", 3)]
    assert rows(joins.audit_unique(metric, "city")) == [("A", 2)]
    assert rows(joins.unmatched_keys(metric, spine, "city")) == [("Z",)]


def test_enrich_key_columns(frame):
    fact, dim = frame([("1", 5)], "zip string, n int"), frame([("1", 9, "A")], "zip_code string, n int, city string")
    out = joins.enrich(fact, dim, "zip", "zip_code")
    assert out.columns == ["zip", "n", "zip_code", "city"] and tuple(out.first()) == ("1", 5, "1", "A")


def test_bridge_takes_first_non_null_city(frame, rows):
    bridge = frame([("d", 1, None), ("d", 3, "LATE"), ("d", 2, "FIRST"), ("e", 1, None)], "name string, seq int, city string")
    fact = frame([("d", 1), ("d", 2), ("e", 3), ("x", 4), (None, 5)], "name string, n int")
    got = rows(joins.bridge_first(fact, bridge, "name", "city", ["seq"]), "n", "city")
    assert got == [(1, "FIRST"), (2, "FIRST"), (3, None), (4, None), (5, None)]


@pytest.mark.parametrize("seed", range(3))
def test_aggregates_match_pandas(frame, seed):
    rng = random.Random(seed)
    data = [(rng.choice([None, "a", "b", "all-null"]), i, None if rng.random() < 0.3 else rng.randrange(4)) for i in range(60)]
    data = [(k, i, None if k == "all-null" else v) for k, i, v in data]
    spec = {"total": ("v", "sum"), "cash": ("v", "money"), "seen": ("v", "count"), "kinds": ("v", "nunique"), "head": ("v", "first")}
    got = aggregates.aggregate(frame(data, "k string, i int, v int"), ["k"], spec, order=["i"])
    p = pd.DataFrame(data, columns=["k", "i", "v"]).groupby("k")["v"].agg(["sum", "sum", "count", "nunique", "first"])
    want = sorted((k, *(None if pd.isna(v) else v for v in r)) for k, r in zip(p.index, p.itertuples(index=False)))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_group_by_expression_and_unknown_function(frame, rows):
    df = frame([("a", 1), ("A", 2), (None, 4)], CITY)
    assert rows(aggregates.aggregate(df, {"city": F.upper("city")}, {"n": ("n", "sum")})) == [("A", 3)]
    with pytest.raises(ValueError, match="unknown"):
        aggregates.aggregate(df, ["city"], {"n": ("n", "mean")})
    with pytest.raises(ValueError, match="order"):
        aggregates.aggregate(df, ["city"], {"n": ("n", "first")})


def test_money_sum_is_exact(frame):
    df = frame([("a", "0.10")] * 30 + [("a", "1000000000000.00")], "k string, v string")
    out = aggregates.metric_sum(df.withColumn("v", numbers.to_double(F.col("v"))), "k", ["v"])
    assert out.first()["v"] == 1000000000003.0


def test_empty_total_row(frame, rows):
    df = frame([], CITY)
    assert rows(aggregates.total_row(df, {"n": ("n", "sum"), "c": ("city", "nunique")}, "21-22")) == [(0, 0, "21-22")]


def test_profile_and_reconcile(frame, rows):
    df = frame(ROWS, CITY)
    assert rows(quality.profile_nulls(df)) == [("city", 2, 2 / 6 * 100, "string"), ("n", 3, 50.0, "int")]
    out = quality.reconcile(df, clean.filter_ne(df, "city", "OCALA"), ["n"])
    assert rows(out) == [("n", 6.0, 4.0, -2.0)]
    assert rows(quality.value_counts(df, "city")) == [("MIAMI", 1), ("OCALA", 1), ("TAMPA", 2)]


def test_union_keeps_counts_and_fills(frame, rows):
    out = union_years([frame([(1, "x")], "a int, b string"), frame([("y", 2.0)], "b string, c double")])
    assert rows(out.select("a", "b", "c")) == [(None, "y", 2.0), (1, "x", None)]


GEO = [("KEY LARGO", "Monroe County", 0), ("LARGO", "Pinellas County", 1), ("TAMPA", "Hillsborough County", 2),
       ("FT PIERCE", "St. Lucie County", 3), ("WEST PALM", "Palm Beach County", 4), ("PALM CITY", "Martin County", 5)]
TEXTS = ["Largo, FL", "key largo", "Tampa and Largo", "St. Petersburg", "palm", "Monroe", "Orlando", "", None, "x" * 500 + "tampa"]


def find(text):
    """The rules, spelled out in Python."""
    if text is None:
        return None
    up = text.upper()
    for city, _, _ in GEO:
        if city in up:
            return city
    for city, county, _ in GEO:
        if county.split(" ")[0].upper() in up:
            return city
    return up


@pytest.mark.parametrize("max_terms", [0, 3, 2000])
def test_free_text_location(frame, max_terms):
    geo = frame(GEO, "city string, county string, ord int")
    df = frame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    out = locate.resolve_location(df, "t", geo, "city", max_terms=max_terms)
    assert [r["city"] for r in out.orderBy("i").collect()] == [find(t) for t in TEXTS]


@pytest.mark.parametrize("seed", range(2))
def test_both_dictionary_routes_agree_with_brute_force(frame, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("ab é\n") for _ in range(n))
    terms = list({word(rng.randrange(1, 12)) for _ in range(40)})
    texts = [word(rng.randrange(0, 60)) for _ in range(60)]
    want = [next((t for t in terms if t in x), None) for x in texts]
    dictionary = frame([(t, i) for i, t in enumerate(terms)], "term string, ord int")
    df = frame(list(enumerate(texts)), "i int, t string")
    for max_terms in (0, 1000):
        out = locate.first_contained(df, F.col("t"), dictionary, "term", "ord", "hit", max_terms=max_terms)
        assert [r["hit"] for r in out.orderBy("i").collect()] == want


def test_empty_dictionary(frame):
    dictionary = frame([], "term string, ord int")
    out = locate.first_contained(frame([("a",)], "t string"), F.col("t"), dictionary, "term", "ord", "hit")
    assert out.first()["hit"] is None


def test_address(frame, rows):
    zips = frame([("34470", "OCALA"), ("02134", "BOSTON")], "zip string, city string")
    values = ["1 Main St, Ocala, FL 34470-1234", "x, 02134 ", "34470, none", None]
    out = locate.city_from_address(frame(list(enumerate(values)), "i int, a string"), "a", zips)
    assert rows(out, "i", "zip", "city") == [(0, "34470", "OCALA"), (1, "02134", "BOSTON"), (2, None, None), (3, None, None)]


def test_counts_of_all_pairs_are_not_needed():
    """Guard for the claim algebra: sums over all combinations of four lists."""
    rng = random.Random(1)
    lists = [[rng.choice([None, 1, 2, 3]) for _ in range(rng.randrange(0, 4))] for _ in range(4)]
    padded = [part or [None] for part in lists]
    med = sum(a + b for a, b, _, _ in product(*padded) if a is not None and b is not None)
    total = [sum(v for v in part if v is not None) for part in lists]
    seen = [sum(v is not None for v in part) for part in lists]
    rows = [max(len(part), 1) for part in lists]
    assert med == (total[0] * seen[1] + total[1] * seen[0]) * rows[2] * rows[3]


@pytest.mark.parametrize("limit", [0, 5, 6, 2000])
def test_place_search_means_the_same_at_any_size(frame, rows, limit):
    geo = frame([("OCALA", " Marion", 1), (None, "Polk", 2), ("TAMPA", "Polk County", 3), ("", "Bay", 4), ("MIAMI", None, 5), ("ERIE", "Bay", 6)],
                "city string, county string, ord int")
    texts = frame([("visit tampa",), ("marion hq",), ("polk",), (None,), ("",)], "t string")
    got = locate.resolve_location(texts, "t", geo, "place", max_terms=limit)
    # An empty city is in every text, but ranks behind those listed before it.
    assert rows(got, "t", "place") == rows(frame([("visit tampa", "TAMPA"), ("marion hq", ""), ("polk", ""), (None, None), ("", "")], "t string, place string"))
    only = geo.where("city <> ''")
    got = locate.resolve_location(texts, "t", only, "place", max_terms=limit)
    # A county that begins with a blank gives the empty word.
    assert rows(got, "t", "place") == rows(frame([("visit tampa", "TAMPA"), ("marion hq", "OCALA"), ("polk", "OCALA"), (None, None), ("", "OCALA")], "t string, place string"))


def test_parts_of_a_cent_add_up(frame):
    many = frame([("A", 0.004)] * 1000, "city string, x double")
    assert aggregates.metric_sum(many, "city", ["x"]).first()["x"] == 4.0


def test_null_profile_of_an_empty_table(frame):
    assert [tuple(r)[1:3] for r in aggregates.profile_nulls(frame([], "a int, b string")).collect()] == [(0, None), (0, None)]
