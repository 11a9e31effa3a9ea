"""Jobs against small pandas versions that follow the null rules of pandas."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators.joins import attach_metric
from plumbline.plans import city_jobs as city
from plumbline.plans import claims, county_jobs, out_of_state, years
from plumbline.plans.cleaning import Refs, apply_steps
from plumbline.plans.fixed import CERTIFIED_CITIES, STEPS, YEARS

Y18, Y19, Y20, Y21 = YEARS
SPINE = [("TAMPA", "Hillsborough County", 0), ("OCALA", "Marion County", 1), ("MIAMI", "Miami-Dade County", 2), ("FERN PARK", "Seminole County", 3)]
ZIPS = [("00001", "TAMPA"), ("00002", " Ocala "), ("00003", "MAIMI"), ("00004", "MIAMI"), ("00003", "TAMPA")]
MAP = [("TAMPPA", "TAMPA"), ("MAIMI", "MIAMI"), ("OCALA", "TAMPA"), ("Ocala", "OCALA"), ("Dade County", "Miami-Dade County")]
DROP = ["ATLANTA", "OUT"]
MESSY = ["tampa", " TAMPA ", "TAMPPA", "TAMPPA ", "MAIMI", "Ocala", "OCALA", "ATLANTA", " ATLANTA", "OUT", "FERN", " ", "", None, "nowhere", " MIAMI"]


@pytest.fixture(scope="module")
def refs(spark):
    make = spark.createDataFrame
    return Refs(
        make(SPINE, "city string, county string, ord int"), make(ZIPS, "zip string, city string"),
        make(MAP, "wrong string, fixed string"), make([(d,) for d in DROP], "listed string"),
    )


def pd_steps(df, key, steps, inline=None, drop_zips=()):
    df = df.copy()
    for s in steps.split():
        if s == "U":
            df[key] = df[key].str.upper()
        elif s == "S":
            df[key] = df[key].str.strip()
        elif s == "L":
            df[key] = df[key].str.lstrip(" ")
        elif s == "T":
            df[key] = df[key].str.rstrip(" ")
        elif s in "RM":
            df[key] = df[key].replace(dict(MAP) if s == "R" else inline)
        elif s == "X":
            df = df[~df[key].isin(DROP)]
        elif s == "N":
            df = df.dropna(subset=[key])
        elif s == "F":
            df[key] = df[key].fillna("UNDEFINED").replace({" ": "UNDEFINED"})
        elif s == "C":
            df[key] = df[key] + " County"
        elif s == "V":
            df = df[df["vacant"] != "Y"]
        elif s == "Q":
            df = df[~df["zip"].isin(list(drop_zips))]
        elif s == "J":
            df = df.merge(pd.DataFrame(ZIPS, columns=["zip", "city"], dtype=object), on="zip", how="left")
    return df


def as_rows(out):
    def plain(v):
        return None if v is None or v != v else float(v) if isinstance(v, (int, float, np.number)) else v

    cols = sorted(out.columns)
    if isinstance(out, pd.DataFrame):
        data = out[cols].itertuples(index=False)
    else:
        data = out.select(*cols).collect()
    return cols, sorted((tuple(plain(v) for v in r) for r in data), key=str)


def same(got, want):
    assert as_rows(got) == as_rows(want)


def pandas(rows, columns):
    return pd.DataFrame(rows, columns=columns, dtype=object)


@pytest.mark.parametrize("steps", sorted({p for job in STEPS.values() for pair in job.values() for p in pair if p and not set(p) & set("JQVM ".strip())}))
def test_every_step_order(frame, refs, steps):
    rows = [(c, i) for i, c in enumerate(MESSY)]
    got = apply_steps(frame(rows, "city string, n int"), "city", steps, refs)
    same(got, pd_steps(pandas(rows, ["city", "n"]), "city", steps))


def test_unknown_step(frame, refs):
    with pytest.raises(ValueError, match="unknown"):
        apply_steps(frame([("a",)], "city string"), "city", "Z9", refs)


@pytest.mark.parametrize("year", YEARS)
def test_circuits(frame, refs, year):
    rng = random.Random(5)
    if year == Y21:
        rows = [(c, rng.choice(["i1", "i2", None]), rng.choice([1.25, 2.5, None])) for c in MESSY * 3]
        got = city.internet_circuits(frame(rows, "city string, inventory_id string, retail double"), refs, year)
        p = pd_steps(pandas(rows, ["city", "inventory_id", "retail"]), "city", STEPS["circuits"][year][0])
        spec = {"internet_circuits": ("inventory_id", "nunique"), "value_of_internet_circuits": ("retail", "sum")}
    else:
        rows = [(z, rng.randrange(9), rng.choice([1.25, None])) for z in ["00001", "00002", "00003", "9", None] * 5]
        got = city.internet_circuits(frame(rows, "zip string, circuits long, charge double"), refs, year)
        p = pd_steps(pandas(rows, ["zip", "circuits", "charge"]), "city", STEPS["circuits"][year][0])
        spec = {"internet_circuits": ("circuits", "sum"), "value_of_internet_circuits": ("charge", "sum")}
    p["city"] = p["city"].str.upper()
    want = p.groupby("city").agg(**spec).reset_index()
    if year == Y18:
        want["internet_circuits"] = [-(-v // 2) for v in want["internet_circuits"]]
    same(got, want)


@pytest.mark.parametrize("year", YEARS)
@pytest.mark.parametrize("seed", range(2))
def test_claims_match_real_joins(frame, refs, year, seed):
    rng = random.Random(seed)
    zips = ["00001", "00002", "00003", "00003 ", "00004", "99999", None]
    sheets = {
        name: [(rng.choice(zips), rng.choice([None, 1.5, 2.0, 3.25]), rng.choice([None, 0.25, 4.0])) for _ in range(14)]
        for name in claims.SHEETS
    }
    frames = {n: frame(r, "zip string, enrollee double, dependents double") for n, r in sheets.items()}
    tables = {n: pandas(r, ["zip", "enrollee", "dependents"]) for n, r in sheets.items()}
    if year == Y18:
        tables["pharmacy_active"]["zip"] = tables["pharmacy_active"]["zip"].str.strip()
    if year == Y20:
        tables["medical_retiree"] = tables["medical_retiree"].fillna({"enrollee": 0, "dependents": 0})
    parts = []
    for short, name in zip(("mr", "me", "pr", "pe"), claims.SHEETS):
        t = tables[name]
        parts.append(pd.DataFrame({"zip": t["zip"], short: (t["enrollee"] + t["dependents"]).astype(float)}))
    if year == Y20:
        # filling a frame fills its zip column too
        parts[0]["zip"] = parts[0]["zip"].fillna(0)
    medical, pharmacy = parts[0].merge(parts[1], on="zip", how="outer"), parts[2].merge(parts[3], on="zip", how="outer")
    medical["medical_claims"] = medical["me"] + medical["mr"]
    pharmacy["pharmacy_claims"] = pharmacy["pe"] + pharmacy["pr"]
    joined = medical.merge(pharmacy, on="zip", how="outer")
    joined["total_claims"] = joined["medical_claims"] + joined["pharmacy_claims"]
    if year == Y21:
        joined["zip"] = joined["zip"].str.strip()
    sums = list(claims.TOTALS)
    before, after = STEPS["claims"][year]
    want = pd_steps(joined.groupby("zip")[sums].sum().reset_index(), "city", before).groupby("city")[sums].sum().reset_index()
    same(city.health_claims(frames, refs, year), pd_steps(want, "city", after))
    if year == Y19:
        rows = claims.combine_claims(*[frames[n] for n in claims.SHEETS])
        names = ["mr", "me", "pr", "pe", *sums]
        same(rows.select("zip", *[F.col(c).cast("double") for c in names]), joined[["zip", *names]])


def test_marketplace_and_spine(frame, refs):
    rng = random.Random(2)
    rows = [(rng.choice(["FL", "GA", None]), c, rng.choice(["1,234.50", "7", None]), rng.choice(["v1", "v2", None])) for c in MESSY * 4]
    for year in YEARS:
        got = city.marketplace(frame(rows, "state string, city string, amount string, vendor string"), refs, year, home_state="FL")
        p = pandas(rows, ["state", "city", "amount", "vendor"])
        p = pd_steps(p[p["state"] == "FL"], "city", STEPS["marketplace"][year][0])
        p["amount"] = p["amount"].str.replace(",", "").astype(float)
        want = p.groupby("city").agg(marketplace_spend=("amount", "sum"), vendors=("vendor", "nunique")).reset_index()
        same(got, want)
        spine = pandas([r[:2] for r in SPINE], ["city", "county"])
        same(attach_metric(refs.spine.drop("ord"), got, "city"), spine.merge(want, on="city", how="left"))


def test_positions_temporary_and_residences(frame, refs):
    rng = random.Random(3)
    cols = ["emp_type", "city", "position", "vacant", "base_rate", "pay_code", "fte", "salary", "health", "home_city"]
    rows = [
        (rng.choice([1, 2, 3, 4, 5]), rng.choice(MESSY), rng.choice(["p1", "p2", "p3", None]), rng.choice(["Y", None]),
         rng.choice([10.5, None]), rng.choice(["M", "B", "Q", None]), rng.choice([0.5, 1.0, None]), rng.choice([9.25, None]),
         rng.choice([1.5, None]), rng.choice(MESSY))
        for _ in range(150)
    ]
    ddl = "emp_type int, city string, position string, vacant string, base_rate double, pay_code string, fte double, salary double, health double, home_city string"
    df, base = frame(rows, ddl), pandas(rows, cols)
    for c in ("base_rate", "fte", "salary", "health"):
        base[c] = base[c].astype(float)
    for year in YEARS:
        p = base[base["emp_type"].isin([1, 2])].copy()
        if year != Y21:
            p["salary"] = p["base_rate"] * p["pay_code"].map({"M": 12, "B": 26}).astype(float)
        before, after = STEPS["positions"][year]
        p["vacant"] = (p["vacant"] == "Y").astype(int)
        p = pd_steps(p, "city", before)
        spec = {"positions": ("position", "nunique"), "vacancies": ("vacant", "sum"), "annualized_salary": ("salary", "sum"), "employees": ("fte", "sum")}
        if year == Y21:
            spec["employer_insurance_contributions"] = ("health", "sum")
        same(city.positions(df, refs, year), pd_steps(p.groupby("city").agg(**spec).reset_index(), "city", after))
        t = pd_steps(base[base["emp_type"].isin([4, 5])], "city", STEPS["temporary"][year][0])
        want = t.groupby("city").agg(temporary_employees=("position", "nunique")).reset_index()
        same(city.temporary_staff(df, refs, year), pd_steps(want, "city", STEPS["temporary"][year][1]))
    h = pd_steps(base[["home_city", "salary"]].rename(columns={"home_city": "city"}), "city", STEPS["residences"][Y21][0])
    want = h.groupby("city").agg(employee_residences=("salary", "count")).reset_index()
    same(city.employee_residences(df, refs), pd_steps(want, "city", "U"))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("year", YEARS)
def test_certified(frame, refs, year):
    rng = random.Random(4)
    day = lambda: rng.choice([None, dt.date(2018, 7, 1) + dt.timedelta(rng.randrange(-400, 1200))])
    rows = [
        (i, rng.choice([None, *"abcdefghij"]), rng.choice(["B", None]), rng.choice(MESSY), day(), day(),
         rng.choice(["1 St, FL 00001-1234", "x, 00002", "no zip", None, "y,  00003"]))
        for i in range(120)
    ]
    rows.append((500, "leap", "B", "FERN", dt.date(2020, 6, 29), None, "x, 00001"))
    cols = ["i", "tax_id", "business", "city", "effective_on", "expire_on", "address"]
    df = frame(rows, "i int, tax_id string, business string, city string, effective_on date, expire_on date, address string")
    p = pandas(rows, cols)
    if year in (Y18, Y19):
        df = df.drop("city")
        first = f"20{year[:2]}-07-01"
        stamps = {str(s)[:10] for s in pd.date_range(first, f"20{year[3:]}-06-30", periods=365)}
        p = p[p["effective_on"].astype(str).isin(stamps) | p["expire_on"].astype(str).isin(stamps)]
        p = p.drop_duplicates(subset=["tax_id"]).drop(columns="city")
        p["zip"] = p["address"].astype(str).str.split(",").str[-1].str.strip().str.extract(r"(\d{5})-?\d*")[0]
        p = p.merge(pandas(ZIPS, ["zip", "city"]), on="zip", how="left")
    else:
        p = p.drop_duplicates(subset=["tax_id"])
    p = pd_steps(p, "city", STEPS["certified"][year][0], CERTIFIED_CITIES)
    want = p.groupby("city").agg(minority_owned_businesses_registered=("business", "count")).reset_index()
    same(city.certified_businesses(df, refs, year, order=["i"]), want)


def test_certified_years_share_one_pass(frame, refs, capsys):
    day = lambda n: dt.date(2018, 1, 1) + dt.timedelta(n)
    rows = [
        (i, f"{i % 9}" if i % 13 else None, "B" if i % 4 else None, MESSY[i % len(MESSY)], day(i * 7 % 1200), day(i * 11 % 1200), f"x, 0000{i % 4}-1")
        for i in range(150)
    ]
    df = frame(rows, "i int, tax_id string, business string, city string, effective_on date, expire_on date, address string")
    places = city.certified_places(df, YEARS, order=["i"])
    places.explain()
    assert capsys.readouterr().out.count("ExistingRDD") == 1
    for year in YEARS:
        together = city.certified_businesses(df, refs, year, order=["i"], places=places)
        assert together.count() and bag(together) == bag(city.certified_businesses(df, refs, year, order=["i"]))


def test_surplus(frame, refs):
    rng = random.Random(6)
    rows = [(i, rng.choice(MESSY), rng.choice([1, None]), rng.choice([10.5, None]), rng.choice([1.25, None]), rng.randrange(5), 2.5) for i in range(250)]
    cols = ["i", "agency", "invoice", "acquisition_cost", "service_charge", "items", "savings"]
    df = frame(rows, "i int, agency string, invoice int, acquisition_cost double, service_charge double, items long, savings double")
    base = pandas(rows, cols)
    for year, dropped in ((Y18, [177]), (Y19, []), (Y20, []), (Y21, list(range(5, 14)))):
        p = base
        if year != Y20:
            p = p.dropna(subset=["agency"])
            p = p.dropna(subset=["invoice"]) if year == Y21 else p
            p = p.reset_index(drop=True).drop(index=dropped)
            p["savings"] = p["acquisition_cost"].astype(float) - p["service_charge"].astype(float)
        p = pd_steps(p.rename(columns={"agency": "city"}), "city", STEPS["federal_surplus"][year][0])
        want = p.groupby("city").agg(federal_surplus_savings=("savings", "sum"), federal_surplus_items=("items", "sum")).reset_index()
        same(city.federal_surplus(df, refs, year, order=["i"]), want)


def test_state_surplus_items_are_summed_once_and_counted_later(frame, refs):
    rows = [("TAMPA", 4, "$1,000.50"), ("TAMPPA", None, "$2"), ("MIAMI", 5, None)]
    df = frame(rows, "city string, line_items long, savings string")
    same(city.state_surplus(df, refs, Y18), pandas([("TAMPA", 4, 1002.5), ("MIAMI", 5, 0)], ["city", "state_surplus_items", "state_surplus_savings"]))
    same(city.state_surplus(df, refs, Y21), pandas([("TAMPA", 1, 1002.5), ("MIAMI", 1, 0)], ["city", "state_surplus_items", "state_surplus_savings"]))


@pytest.mark.parametrize("year", YEARS)
def test_retirees(frame, refs, year):
    rng = random.Random(7)
    rows = [(rng.choice(["00001", "00002", "00003", "75791", "95136", "8", None]), rng.choice([5.5, None]), rng.randrange(4), rng.choice(["2020", "2021"])) for _ in range(80)]
    cols = ["zip", "payment", "payees", "fiscal_year"]
    df, p = frame(rows, "zip string, payment double, payees long, fiscal_year string"), pandas(rows, cols)
    if year in (Y19, Y20):
        p = p[p["fiscal_year"] == "2020"]
    if year == Y21:
        p = p[~p["zip"].isin(["95136", "30564", "28792", "63042"])]
        p = pandas(ZIPS, ["zip", "city"]).merge(p, on="zip", how="left")
        p = pd_steps(p, "city", "U R S")
    else:
        p = pd_steps(p, "city", "Q J", drop_zips=["75791"])
    for c in ("payment", "payees"):
        p[c] = p[c].astype(float)
    want = p.groupby("city").agg(benefits_paid_to_retirees=("payment", "sum"), number_of_payees=("payees", "sum")).reset_index()
    same(city.retiree_payments(df, refs, year), want)
    if year == Y21:
        assert set(want["city"]) >= {"MIAMI"}  # a city of the lookup without payees


def test_travel(frame, refs):
    texts = ["visit tampa", "Miami-Dade courthouse", "hq marion", "TAMPPA", "ATLANTA", " lost ", None, "seminole", "ocala or tampa"]
    rows = [(t, float(i)) for i, t in enumerate(texts * 3)]

    def find(t):
        if t is None:
            return None
        up = t.upper()
        for c, _, _ in SPINE:
            if c in up:
                return c
        for c, county, _ in SPINE:
            if county.split(" ")[0].upper() in up:
                return c
        return up

    for year in YEARS:
        p = pandas([(find(t), v) for t, v in rows], ["city", "amount"])
        p = pd_steps(p, "city", STEPS["travel"][year][0])
        want = p.groupby("city").agg(travel_spend=("amount", "sum")).reset_index()
        same(city.travel(frame(rows, "destination string, amount double"), refs, year), want)


def test_facilities_quirks(frame, refs):
    rows = [("own", None, "ATLANTA", 1.0, 2.0, 3.0), ("own", 7, "tampa", 1.0, None, 3.0), ("other", 8, "tampa", 1.0, 1.0, 1.0)]
    df = frame(rows, "agency string, id int, city string, square_feet double, land double, structure double")
    got = lambda **kw: {r["city"]: r["facilities_owned"] for r in city.facilities(df, refs, agency="own", **kw).collect()}
    assert got(year=Y20) == {"ATLANTA": 0, "TAMPA": 1}
    assert got(year=Y20, keep_excluded=False) == {"TAMPA": 1}
    assert got(year=Y21) == {"TAMPA": 1}
    blank = df.filter("agency = 'own'").withColumn("city", F.lit("Tampa"))
    assert [r["facilities_owned"] for r in city.facilities(blank, refs, Y21, agency="own").collect()] == [2]


def test_expenses_repeat_the_spine_unless_told_not_to(frame, refs, rows):
    facts = [("tampa", "Utilities", 5.0), (" Tampa", "O&M Expenses", 2.0), ("TAMPA", "O&M Expenses", 3.0), ("OCALA", "O&M Expenses", None),
             ("MIAMI", "Total Direct Expenses", 9.0), ("MIAMI", None, 4.0), (None, "Utilities", 1.0)]
    df, spine = frame(facts, "city string, category string, amount double"), refs.spine.select("city")
    repeated = city.attach_expenses(spine, df, refs)
    assert rows(repeated, "city", "utility_bills_paid", "building_maintenance") == [
        ("FERN PARK", None, None), ("MIAMI", None, None), ("OCALA", None, None), ("TAMPA", 5.0, 2.0), ("TAMPA", 5.0, 3.0)]
    assert "category" in repeated.columns
    once = city.attach_expenses(spine, df, refs, repeat_rows=False)
    assert rows(once, "city", "utility_bills_paid", "building_maintenance") == [
        ("FERN PARK", None, None), ("MIAMI", None, None), ("OCALA", None, 0.0), ("TAMPA", 5.0, 5.0)]


def test_towers_map_runs_before_the_suffix(frame, refs, rows):
    df = frame([("Dade County", "t1"), ("Dade", "t2"), (" Dade", "t3"), ("Marion", None)], "county string, tower string")
    assert rows(county_jobs.towers(df, refs, Y20)) == [
        ("Marion County", 0), ("Miami-Dade County", 1), ("Miami-Dade County", 1), ("Miami-Dade County County", 1)]
    assert rows(county_jobs.towers(df, refs, Y21)) == [("Marion County", 0), ("Miami-Dade County", 2), ("Miami-Dade County County", 1)]


def test_county_jobs(frame, refs, rows):
    erate = frame([(" Dade", "$1,000.50 "), ("Dade", "$2"), (None, "$3"), ("Mar,ion", None)], "county string, authorized string")
    for year in YEARS[:3]:
        assert rows(county_jobs.erate(erate, refs, year)) == [("Marion County", 0.0), ("Miami-Dade County", 1002.5)]
    parts = frame([("A ", 1.0, 1.0, None, 1.0, 1.0, 9.0), ("A", 1.0, 2.0, 3.0, 4.0, 5.0, 8.0)],
                  "county string, wireless double, nonwireless double, prepaid_wireless double, supplemental double, special double, total double")
    assert rows(county_jobs.disbursements(parts, refs, Y19)) == [("A County", 15.0)]
    assert rows(county_jobs.disbursements(parts, refs, Y18)) == [("A County", 17.0)]
    centers = frame([("Dade", "c"), ("Dade", None), (None, "c")], "county string, center string")
    assert rows(county_jobs.call_centers(centers, refs, Y21)) == [("Miami-Dade County", 1)]


def test_fleet(frame, refs):
    rows = [("tampa", 1, "--", "2.5", "3"), ("--", 2, "9", "9", "9"), ("TAMPPA", None, "1", "--", "--"), ("Ocala", 4, None, "1", "1")]
    df = frame(rows, "city string, asset int, operating_cost string, maintenance_cost string, fuel_cost string")
    want = {Y18: {"TAMPA": (1.0, 1), "OCALA": (0.0, 1)}, Y20: {"tampa": (0.0, 1), "TAMPA": (1.0, 0), "OCALA": (0.0, 1)}}
    for year, expected in want.items():
        got = {r["city"]: (r["total_operating_cost"], r["fleet_assets"]) for r in city.fleet(df, refs, year).collect()}
        if year == Y18:
            # upper case comes first, and the map sends OCALA on
            expected = {"TAMPA": (1.0, 2)}
        assert got == expected


def test_outer_join_of_employers_extends_the_city_table(frame, refs):
    employers = frame([("a", "TAMPA", 5.0), ("b", "ELSEWHERE", 6.0)], "agency string, city string, contribution double")
    sources = {"employers": employers, "contributions": employers}
    out = years.city_year_table(sources, refs, Y21, home_state="FL", agency="x", orders={})
    got = {r["city"]: (r["employers_using_retirement_system"], r["employer_contributions"], r["fy"]) for r in out.collect()}
    assert got["ELSEWHERE"] == (1, 6.0, Y21) and got["MIAMI"] == (None, None, Y21) and len(got) == 5
    early = years.city_year_table({"employers": employers}, refs, Y18, home_state="FL", agency="x", orders={})
    assert early.count() == 4


def test_all_years_fill_and_drop(frame, spark, tmp_path):
    a = frame([("A", 1.0, "x")], "city string, m double, category string")
    b = frame([("A", 2)], "city string, k int")
    out = years.all_years_on_disk(spark, {Y18: a, Y19: b}, str(tmp_path / "y"), str(tmp_path / "all"), stray=["category"])
    assert sorted((r["fy"], r["m"], r["k"]) for r in out.collect()) == [(Y18, 1.0, None), (Y19, None, 2)]
    assert "category" not in out.columns
    again = years.all_years([a.withColumn("fy", F.lit(Y18)), b.withColumn("fy", F.lit(Y19))], stray=["category"])
    assert again.count() == 2 and "category" not in again.columns


def test_out_of_state(frame, spark):
    fys = out_of_state.fy_spine(spark, (Y18, Y19))
    spend = frame([(Y18, "FL", "v", 1, "1"), (Y18, None, "v", 2, "1,000.5"), (Y18, "GA", "v", 2, None)],
                  "fy string, state string, vendor string, invoice int, amount string")
    got = {r["fy"]: tuple(r)[1:] for r in out_of_state.spend_outside(spend, fys, home_state="FL").collect()}
    assert got == {Y18: (1000.5, 1, 1), Y19: (0.0, 0, 0)}
    rows = frame([(i, 1.0, 1, "2019" if i < 100 else "2021") for i in range(300)], "i int, payment double, payees long, fiscal_year string")
    got = {r["fy"]: (r["benefits_paid_to_non_home_retirees"], r["non_home_payees"]) for r in out_of_state.retirees_outside(rows, rows, order=["i"]).collect()}
    assert got == {Y21: (58.0, 58), Y18: (100.0, 100), Y19: (0.0, 0), Y20: (75.0, 75)}
    sheets = {n: frame([(Y18, "00001", 1.0, 1.0), (Y18, None, 2.0, 1.0), (Y18, "9 ", 5.0, 0.0)], "fy string, zip string, enrollee double, dependents double") for n in claims.SHEETS}
    out = out_of_state.claims_outside(sheets, frame([("00001",), ("9",)], "zip string"), fys)
    assert {r["fy"]: tuple(r)[1:] for r in out.collect()} == {Y18: (6.0, 6.0, 12.0), Y19: (0.0, 0.0, 0.0)}
    total = out_of_state.summary(out_of_state.fy_spine(spark), out)
    assert total.count() == 4 and total.filter("non_home_claims is null").count() == 2
