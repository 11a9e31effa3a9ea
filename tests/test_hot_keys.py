"""Joins with hot keys, lookups by constant and by join, first listed terms,
the year table's parts: each against the plain way."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.operators import clean, joins, lookups
from plumbline.operators.aggregates import aggregate
from plumbline.plans import city_jobs as city
from plumbline.plans import claims, years
from plumbline.plans.cleaning import Refs, aggregate_cleaned, apply_steps


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("hot_rows", [1, 4, 9, 10**6])
def test_outer_join_with_hot_keys(frame, hot_rows):
    rng = random.Random(hot_rows)
    keys = [None, "a", "b", "c", "d", "e"]
    left = [(rng.choices(keys, [9, 9, 3, 1, 1, 0])[0], i) for i in range(60)] + [("only left", -i) for i in range(12)]
    right = [(rng.choices(keys, [9, 2, 9, 0, 1, 9])[0], i * 1.5) for i in range(50)] + [("only right", i * 0.5) for i in range(12)]
    a, b = frame(left, "k string, x int"), frame(right, "k string, y double")
    plain = joins.outer_join_nullsafe(a, b, "k")
    split = joins.outer_join_nullsafe(a, b, "k", skewed=True, hot_rows=hot_rows)
    assert bag(split, "k", "x", "y") == bag(plain, "k", "x", "y")
    want = Counter()
    for k, x in left:
        want.update([(k, x, y) for j, y in right if j == k] or [(k, x, None)])
    want.update((k, None, y) for k, y in right if k not in {j for j, _ in left})
    assert bag(plain, "k", "x", "y") == want


def test_outer_join_of_empty_sides(frame):
    a, none = frame([("a", 1), (None, 2)], "k string, x int"), frame([], "k string, y int")
    for hot_rows in (1, 10):
        assert bag(joins.outer_join_nullsafe(a, none, "k", skewed=True, hot_rows=hot_rows), "k", "x", "y") == Counter([("a", 1, None), (None, 2, None)])
        assert bag(joins.outer_join_nullsafe(none, none.withColumnRenamed("y", "z"), "k", skewed=True, hot_rows=hot_rows), "k") == Counter()


@pytest.mark.parametrize("hot_rows", [1, 3, 10**6])
def test_claims_with_hot_zips(frame, hot_rows):
    rng = random.Random(8)
    def sheet(zips):
        rows = [(rng.choice(zips), rng.choice([None, 1.5, 2.0]), rng.choice([None, 0.25, 4.0])) for _ in range(12)]
        return frame(rows, "zip string, enrollee double, dependents double")
    sheets = [sheet([None, "1", "2"]), sheet([None, "1", "3"]), sheet(["1", "3", "4", "4", "4"]), sheet([None, None, "2", "5"])]
    names = ("zip", "mr", "me", "pr", "pe", "medical_claims", "pharmacy_claims", "total_claims", "employee_claims")
    a, b, c, d = [claims.sheet_total(s, n) for s, n in zip(sheets, names[1:5])]
    medical = joins.outer_join_nullsafe(a, b, "zip").selectExpr("*", "me + mr AS medical_claims")
    pharmacy = joins.outer_join_nullsafe(c, d, "zip").selectExpr("*", "pe + pr AS pharmacy_claims")
    plain = joins.outer_join_nullsafe(medical, pharmacy, "zip").selectExpr("*", "medical_claims + pharmacy_claims AS total_claims", "me + pe AS employee_claims")
    assert bag(claims.combine_claims(*sheets, hot_rows=hot_rows), *names) == bag(plain, *names)


def test_a_map_is_the_same_as_a_constant_and_joined(frame, monkeypatch):
    wrong = [("a", "b"), ("b", "c"), ('q"uote\\', "x\ny"), ("é", None), ("", "blank"), (None, "never")] + [(f"w{i}", f"r{i}") for i in range(40)]
    rows = [(v, w, 1) for v, w in zip(["a", "b", "c", None, 'q"uote\\', "é", "", "w7", "W7"], ["b", "w39", None, "a", "", "z", "é", "a", "a"])]
    df, mapping = frame(rows, "x string, `y z` string, n int"), frame(wrong, "wrong string, fixed string")
    known = {k: v for k, v in wrong if k is not None and v is not None}
    want = Counter((known.get(x, x), known.get(y, y), n) for x, y, n in rows)
    for most in (4000, 3):
        lookup = lookups.lookup_of(mapping, most)
        assert lookup.constant == (most == 4000)
        assert bag(clean.replace_values(df, ["x", "y z"], lookup), "x", "`y z`", "n") == want
    listed = frame([("a",), ("a",), (None,), ("é",)], "v string")
    for most in (4000, 1):
        got = clean.exclude_values(df, "x", lookups.lookup_of(listed, most))
        assert bag(got, "x") == Counter((x,) for x, *_ in rows if x not in ("a", "é"))
    empty = frame([], "wrong string, fixed string")
    assert bag(clean.replace_values(df, ["x"], empty), "x") == Counter((x,) for x, *_ in rows)
    assert bag(clean.exclude_values(df, "x", empty), "x") == Counter((x,) for x, *_ in rows)


def test_year_table_repeats_and_extends(frame):
    spine = frame([("A", "c1"), ("B", "c1"), (None, "c2")], "city string, county string")
    one = frame([("A", 1.0), ("Z", 9.0)], "city string, m double")
    twice = frame([("A", 5), ("A", 6), ("Z", 7)], "city string, t int")
    more = frame([("Z", "n1"), ("B", "n2")], "city string, e string")
    last = frame([("Z", 3), ("Y", 4)], "city string, l int")
    parts = [
        (years.Frame("one", ("m",)), one), (years.Frame("twice", ("t",), repeats=True), twice),
        (years.Frame("more", ("e",), extends=True), more), (years.Frame("last", ("l",)), last),
    ]
    raw = frame([("A", "p"), ("A", "q"), ("Z", "r"), (None, "s")], "city string, raw string")
    metrics = years.Metrics("city", years.tall(parts, "city"), tuple(f for f, _ in parts), {"raw": raw})
    got = bag(years.year_table(spine, metrics), "city", "county", "raw", "m", "t", "e", "l")
    chain = spine.join(raw, "city", "left").join(one, "city", "left").join(twice, "city", "left")
    chain = joins.outer_join_nullsafe(chain, more, "city").join(last, "city", "left")
    assert got == bag(chain, "city", "county", "raw", "m", "t", "e", "l")
    assert sum(got.values()) == 7 and ("Z", None, None, None, None, "n1", 3) in got


def test_repeated_rows_are_guarded(frame):
    prisons = frame([("A", 1), ("A", 2), ("A", 3), ("B", 1), (None, 1)], "city string, p int")
    rows = frame([("A", 1), ("A", 2), ("A", 3), ("A", 4)], "city string, r int")
    metrics = years.Metrics("city", None, (), {"prisons": prisons, "maintenance": rows})
    spine = frame([("A", "x"), ("B", "x"), ("C", "y")], "city string, county string")
    assert years.year_table(spine, metrics).count() == 14
    years.guard_repeats(metrics, 12)
    with pytest.raises(ValueError, match=r"A \(12\)"):
        years.guard_repeats(metrics, 11)


def test_rows_that_multiply_are_made_in_many_tasks(spark, frame):
    spine = frame([("A", "c1"), ("B", "c1"), ("C", "c2"), (None, "c2")], "city string, county string")
    one = frame([("A", 1.0), ("Z", 9.0)], "city string, m double")
    twice = frame([("A", 5), ("A", 6), ("Z", 7)], "city string, t int")
    more = frame([("Z", "n1"), ("B", "n2")], "city string, e string")
    parts = [
        (years.Frame("one", ("m",)), one), (years.Frame("twice", ("t",), repeats=True), twice),
        (years.Frame("more", ("e",), extends=True), more),
    ]
    prisons = frame([("A", i) for i in range(5)] + [("B", 7), (None, 8), ("Z", 9)], "city string, p int")
    rows = frame([("A", i % 50) for i in range(200)] + [(None, 1), ("Z", 2)], "city string, r int")
    metrics = years.Metrics("city", years.tall(parts, "city"), tuple(f for f, _ in parts), {"prisons": prisons, "maintenance": rows})
    got = years.year_table(spine, metrics)
    chain = spine.join(prisons, "city", "left").join(rows, "city", "left").join(one, "city", "left").join(twice, "city", "left")
    chain = joins.outer_join_nullsafe(chain, more, "city")
    assert got.columns == chain.columns
    assert bag(got, *chain.columns) == bag(chain, *chain.columns)
    tasks = got.where("city = 'A'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in tasks) < 1000


# (term, rank, value): ties in rank, null ranks and values, empty and null terms, all lengths
TERMS = [
    ("zz", 3, "zz"), ("aa", 3, "aa"), ("needle in", 5, "n"), ("needle", 6, "m"), ("x", 9, None), ("hay", 7, "h"), ("haystack", 7, "s"),
    ("null rank", None, "r"), (None, 0, "none"), ("日本", 4, "jp"), ("q\"\\", 8, "quote"), ("tie", 2, None), ("tie too", 2, "t"),
]
PLACES = [
    "zz aa", "aa", "needle in hay", "a needle", "x", "haystack", "a null rank here", None, "", "日本語", 'say q"\\', "tie too", "only tie", "nothing", "zz aa",
]


def first_brute(text, terms):
    hits = [(r is not None, r or 0, v is not None, v or "") for t, r, v in terms if t is not None and text is not None and t in text]
    return min(hits)[3] if hits and min(hits)[2] else None


@pytest.mark.parametrize("extra", [[], [("", 6, "all")]])
def test_first_listed_term_by_every_route(frame, monkeypatch, extra):
    from pyspark.sql import functions as F

    from plumbline.operators import locate

    terms = TERMS + extra
    df, listed = frame([(p, 1) for p in PLACES], "p string, n int"), frame(terms, "t string, r int, v string")
    want = Counter((p, 1, first_brute(p, terms)) for p in PLACES)

    def got(**kw):
        return bag(locate.first_contained(df, F.col("p"), listed, "t", "r", "out", value="v", **kw), "p", "n", "out")

    assert got() == want
    assert got(max_terms=0) == want and got(max_terms=2) == want
    monkeypatch.setattr(locate, "MOST_GRAMS", 0)
    assert got(max_terms=0) == want
    monkeypatch.setattr(locate, "HEAD", 1)
    assert got(max_terms=3) == want
    monkeypatch.setattr(locate, "MOST_GRAMS", 20_000)
    assert got(max_terms=0) == want


def test_grams_after_a_term_that_is_found_are_left_out(frame):
    from pyspark.sql import functions as F

    from plumbline.operators import locate

    listed = frame([("x", 2, ""), ("haystack", 3, ""), ("needle", 1, ""), ("on", None, "")], "_term string, _rank int, _value string")
    index = locate.term_index(listed)
    texts = frame([("x haystack",), ("needle x",), ("haystack",), ("x" * 40 + "needle on",), ("",)], "p string")
    got = {r["p"]: sorted(r["g"]) for r in texts.select("p", locate._listed_grams(F.col("p"), index).alias("g")).collect()}
    of = {r["_term"]: r["_gram"] for r in index.collect()}
    assert got == {
        "x haystack": ["x"], "needle x": ["needle"], "haystack": [of["haystack"]], "x" * 40 + "needle on": ["on"], "": [],
    }


def test_random_terms_by_the_index(frame, monkeypatch):
    import random

    from pyspark.sql import functions as F

    from plumbline.operators import locate

    monkeypatch.setattr(locate, "HEAD", 1)
    rng = random.Random(5)

    def word(most):
        return "".join(rng.choice("ab日 ") for _ in range(rng.randint(1, most)))

    terms = [(word(9), rng.choice([None, *range(40)]), rng.choice([None, "u", "v"])) for _ in range(120)]
    terms = [t for t in terms if len(t[0]) > 2 or rng.random() < 0.2]
    texts = [word(60) for _ in range(80)]
    df, listed = frame([(t,) for t in texts], "p string"), frame(terms, "t string, r int, v string")
    want = Counter((t, first_brute(t, terms)) for t in texts)
    assert bag(locate.first_contained(df, F.col("p"), listed, "t", "r", "out", value="v", max_terms=0), "p", "out") == want


def test_each_term_lies_under_its_rarest_gram(frame):
    from plumbline.operators import locate

    listed = frame([("abcdefg", 1, ""), ("bcdefgh", 2, ""), ("abc", 3, ""), ("xy", 4, "")], "_term string, _rank int, _value string")
    got = {r["_term"]: r["_gram"] for r in locate.term_index(listed).collect()}
    assert got == {"abcdefg": "abcdef", "bcdefgh": "cdefgh", "abc": "abc", "xy": "xy"}


def _below_first_group(df):
    """The optimised plan below its lowest group-by."""
    return str(df._jdf.queryExecution().optimizedPlan().toString()).rsplit("Aggregate [", 1)[1].split("\n", 1)[1]


def _spelling_refs(frame):
    return Refs(
        frame([("TAMPA", "Hillsborough County", 0)], "city string, county string, ord int"), frame([("00001", "TAMPA")], "zip string, city string"),
        frame([("TAMPPA", "TAMPA"), ("OUT", None)], "wrong string, fixed string"), frame([("ATLANTA",), ("OCALA",)], "listed string"),
    )


def test_cleaning_steps_see_each_spelling_once(frame):
    refs, rows = _spelling_refs(frame), [("F", 1, "tampa", 2.5, 1.0, 1.0), ("F", 2, "Atlanta", 2.5, 1.0, 1.0)]
    facilities = frame(rows, "agency string, id int, city string, square_feet double, land double, structure double")
    surplus = frame([("tampa", 1, "$2.50")], "city string, line_items long, savings string")
    employers = frame([("a", "tampa", 2.5)], "agency string, city string, contribution double")
    travel = frame([("to tampa", 2.5)], "destination string, amount double")
    certified = frame([(1, "t", "b", "tampa")], "i int, tax_id string, business string, city string")
    for df in (
        city.facilities(facilities, refs, "21-22", agency="F"), city.state_surplus(surplus, refs, "21-22"),
        city.retirement_employers(employers, refs, "21-22"), city.employer_contributions(employers, refs, "21-22"),
        city.travel(travel, refs, "21-22"), city.certified_businesses(certified, refs, "21-22", order=["i"]),
    ):
        # the exclusion list is looked up by hash
        assert "xxhash64" in str(df._jdf.queryExecution().optimizedPlan().toString())
        assert "xxhash64" not in _below_first_group(df)


def test_text_that_is_no_number_fails_unless_its_city_is_excluded(frame):
    refs = _spelling_refs(frame)
    ddl = "city string, line_items long, savings string"
    parts = "donee string, line_items long, direct_cost string, federal_cost string, overseas_cost string, service_charge string"
    donees = frame([("d", "TAMPA", 1), ("o", "OCALA", 1)], "donee string, city string, seq int")
    spend = "state string, city string, amount string, vendor string"
    for bad in ("n/a", "1..2", ""):
        late = lambda c: city.state_surplus(frame([("tampa", 1, "$2.50"), (c, 1, bad)], ddl), refs, "21-22")  # noqa: E731,B023
        early = lambda d: city.state_surplus(
            frame([("d", 1, "$1,000.25", "1", "1", "$2"), ("d", 1, "1", None, "x", "1"), (d, 1, "1", "1", bad, None)], parts), refs, "19-20", bridge=donees, order=["seq"]  # noqa: B023
        )
        market = lambda c: city.marketplace(frame([("FL", "tampa", "1,002.5", "a"), ("FL", c, bad, "a")], spend), refs, "21-22", home_state="FL")  # noqa: E731,B023
        assert [r["state_surplus_savings"] for r in late("ATLANTA").collect()] == [2.5]
        assert [r["state_surplus_savings"] for r in early("o").collect()] == [1000.25]
        assert [r["marketplace_spend"] for r in market("ocala").collect()] == [1002.5]
        for df in (late("tampa"), early("d"), market(" tampa")):
            with pytest.raises(Exception, match="no number"):
                df.collect()


@pytest.mark.parametrize("most", [4000, 0])
@pytest.mark.parametrize("steps", ["U R X S", "R X L S", "S R X", "N L U S R X", "R F X", "T R X", ""])
def test_sums_per_spelling_are_the_sums_of_the_rows(frame, monkeypatch, most, steps):
    monkeypatch.setattr(lookups.lookup_of, "__defaults__", (most,))
    refs, rng = _spelling_refs(frame), random.Random(7)
    names = ["tampa", " TAMPA", "TAMPPA", "Tamppa ", "ATLANTA", " Ocala", "OUT", " ", "", None]
    rows = [
        (rng.choice(names), rng.choice(["a", "TAMPPA", "TAMPA", None]), rng.choice([Decimal("0.0013"), Decimal("7.25"), None]), rng.choice([3, None]))
        for _ in range(300)
    ]
    df = frame(rows + [("lonely", None, None, None)], "city string, name string, amount decimal(18,4), items int")
    spec = {
        "names": ("name", "nunique"), "paid": ("amount", "money"), "exact": ("amount", "exact"), "plain": ("amount", "sum"),
        "items": ("items", "sum"), "rows": ("items", "count"), "share": ("amount", "quantity"),
    }
    want = aggregate(apply_steps(df, "city", steps, refs, texts=("name",), present=True), ["city"], spec, present=True)
    got = aggregate_cleaned(df, "city", steps, refs, spec, texts=("name",))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
