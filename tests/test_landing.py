"""Raw landed files to written year tables."""

import pytest

from plumbline.plans.claims import SHEETS
from plumbline.plans.landing import LAYOUTS, SCHEMAS, File, Layout, assemble_out_of_state, assemble_year, load_refs, load_source, schema_of
from plumbline.plans.years import all_years
from plumbline.sources.tables import read_years


def put(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder / name)


@pytest.fixture
def shared(spark, tmp_path):
    geo = put(tmp_path, "geo.csv", "City,County,District\nTAMPA,Hillsborough County,1\nOCALA,Marion County,2\nTAMPA,Other County,3\n")
    zips = put(tmp_path, "zips.csv", "Zip Code,City\n00001,Tampa\n00002,ocala\n")
    wrong = put(tmp_path, "replace.txt", "TAMPPA:TAMPA\n")
    drop = put(tmp_path, "drop.txt", "ATLANTA\n")
    return load_refs(spark, File(geo, {"City": "city", "County": "county"}), File(zips, {"Zip Code": "zip", "City": "city"}), wrong, drop)


def test_refs(shared, rows):
    assert rows(shared.spine) == [("OCALA", "Marion County", "2", 2), ("TAMPA", "Hillsborough County", "1", 1)]
    assert rows(shared.zips) == [("00001", "TAMPA"), ("00002", "OCALA")]


def test_layouts_name_known_sources():
    assert set(LAYOUTS) <= set(SCHEMAS)


def test_titles_totals_and_slices(spark, tmp_path, rows):
    circuits = put(tmp_path, "c.csv", "t1,,\nt2,,\nt3,,\nInventory ID,Site City,Retail\ni1,Tampa,1.5\ni2,Ocala,2\n")
    df = load_source(spark, File(circuits, {"Inventory ID": "inventory_id", "Site City": "city", "Retail": "retail"}), "circuits", "21-22")
    assert [(r[0], r[1], float(r[2])) for r in sorted(df.collect())] == [("i1", "Tampa", 1.5), ("i2", "Ocala", 2.0)]

    lines = ["title,,", "zip,payment,payees", *[f"{i:05d},{i},1" for i in range(70)], "total,9,9"]
    paid = put(tmp_path, "r.csv", "\n".join(lines) + "\n")
    assert [r[0] for r in sorted(load_source(spark, File(paid), "retirees", "21-22").collect())] == [f"{i:05d}" for i in range(60, 70)]
    outside = load_source(spark, File(paid), "retirees_outside", "21-22")
    assert sorted(r["row_id"] for r in outside.collect()) == list(range(58))

    lines = ["title,", "facility,reimbursement", *[f"F{i},{i}" for i in range(50)]]
    prisons = load_source(spark, File(put(tmp_path, "p.csv", "\n".join(lines) + "\n")), "prisons", "21-22")
    got = {r["row_id"]: r["facility"] for r in prisons.collect()}
    assert sorted(got) == list(range(29)) and got[2] == "BLACKWATER" and got[3] == "F3"


def test_windows_text(spark, tmp_path):
    path = put(tmp_path, "t.csv", "destination,amount\nCañon – hq,1.50\n", "cp1252")
    df = load_source(spark, File(path, encoding="cp1252"), "travel", "21-22")
    assert df.first()["destination"] == "Cañon – hq"


def test_schema_changes_by_year():
    assert "zip" in schema_of("circuits", "18-19") and "inventory_id" in schema_of("circuits", "21-22")


def test_years_are_assembled_and_united(spark, shared, tmp_path):
    market = put(tmp_path, "m.csv", 'state,city,amount,vendor,invoice\nFL,tamppa,"1,000.50",v1,1\nFL,TAMPA ,2,v2,2\nGA,TAMPA,9,v3,3\nFL,atlanta,5,v4,4\n')
    employers = put(tmp_path, "e.csv", "agency,city,contribution\na,TAMPA,5\nb,ELSEWHERE,6\ntotal,,11\n")
    grants = put(tmp_path, "g.csv", "county,final_award\n Hillsborough ,7.25\n")
    surplus = put(tmp_path, "s.csv", "agency,invoice,acquisition_cost,service_charge,items\n" + "".join(f"OCALA,{i},10,1,1\n" for i in range(20)))
    certified = put(tmp_path, "o.csv", "tax_id,business,city\n1,B,tampa\n1,C,ocala\n2,D,ocala\n")
    paths = {"city_path": str(tmp_path / "city"), "county_path": str(tmp_path / "county")}
    late = {"marketplace": File(market), "employers": File(employers), "contributions": File(employers), "grants": File(grants),
            "federal_surplus": File(surplus), "certified": File(certified)}
    report = str(tmp_path / "report")
    assemble_year(spark, late, shared, "21-22", home_state="FL", agency="x", report_path=report, **paths)
    found = {(r["check"], r["subject"]): r["value"] for r in spark.read.parquet(report).collect()}
    assert found["repeated keys", "marketplace"] == 0 and found["keys off the spine", "employers"] == 1
    assert found["total of the metric", "marketplace_spend"] == found["total in the table", "marketplace_spend"] == 1002.5
    assert found["total of the metric", "vendors"] == 2 and found["percent null", "marketplace_spend"] > 0
    assemble_year(spark, {"marketplace": File(market)}, shared, "20-21", home_state="FL", agency="x", **paths)
    city = {(r["fy"], r["city"]): r for r in read_years(spark, paths["city_path"]).collect()}
    assert city["21-22", "TAMPA"]["marketplace_spend"] == 1002.5 and city["21-22", "TAMPA"]["vendors"] == 2
    assert city["21-22", "OCALA"]["marketplace_spend"] is None and city["21-22", "OCALA"]["District"] == "2"
    assert city["21-22", "OCALA"]["federal_surplus_items"] == 11
    assert city["21-22", "TAMPA"]["minority_owned_businesses_registered"] == 1
    assert city["21-22", "ELSEWHERE"]["employer_contributions"] == 6.0
    assert ("20-21", "ELSEWHERE") not in city and city["20-21", "TAMPA"]["employer_contributions"] is None
    county = read_years(spark, paths["county_path"])
    got = {(r["fy"], r["county"]): r["grants_awarded"] for r in county.collect()}
    assert got == {("21-22", "Hillsborough County"): 7.25, ("21-22", "Marion County"): None, ("20-21", "Hillsborough County"): None, ("20-21", "Marion County"): None}
    assert all_years([read_years(spark, paths["city_path"])], stray=["category"]).count() == 5


def test_out_of_state_summary(spark, shared, tmp_path):
    claim = File(put(tmp_path, "claim.csv", "zip,enrollee,dependents\n00001,5,5\n99999,1,2\ntotal,6,7\n"))
    market = File(put(tmp_path, "m.csv", "state,city,amount,vendor,invoice\nFL,x,9,v,1\n,x,4,v,2\nGA,y,,w,2\n"))
    paid = "\n".join(f"{i:05d},1,2,{2019 + i % 3}" for i in range(200))
    history = File(put(tmp_path, "h.csv", "zip,payment,payees,fiscal_year\n" + paid + "\n"))
    current = File(put(tmp_path, "c.csv", "title,,\nzip,payment,payees\n" + "\n".join(f"{i},1,2" for i in range(90)) + "\ntotal,9,9\n"))
    files = {y: {**{n: claim for n in SHEETS}, "marketplace": market} for y in ("20-21", "21-22")}
    files["21-22"]["retirees_outside"] = current
    out = str(tmp_path / "out")
    assemble_out_of_state(spark, files, history, shared, out, home_state="FL")
    got = {r["fy"]: r for r in spark.read.parquet(out).collect()}
    assert got["21-22"]["non_home_payees"] == 116 and got["20-21"]["non_home_payees"] == 116
    assert got["20-21"]["invoices"] == 1 and got["20-21"]["non_home_vendors"] == 2 and got["20-21"]["non_home_marketplace_spend"] == 4.0
    # 99999 is outside everywhere; the total line is a row where it is not cut
    assert got["21-22"]["non_home_medical_claims"] == 6.0 and got["21-22"]["non_home_claims"] == 12.0


MONTHLY = {"Agency": "agency", "Invoice\nNumber": "invoice", "Cost": "acquisition_cost", "Service Charge": "service_charge", "Items": "items"}


def test_sheets_with_headers_of_their_own(spark, tmp_path):
    put(tmp_path, "July.csv", 'Agency,"Invoice\nNumber",Cost,Service Charge,Items\n"Tampa\nannex",i1,1.005,0.001,2\nOcala,i2,2,0,1\n')
    put(tmp_path, "August.csv", 'Items,Cost,Service Charge,Agency,"Invoice\nNumber"\n7,5,1,Miami,i3\n')
    file = File(str(tmp_path), MONTHLY, sheets=("July.csv", "August.csv"), multiline=True)
    got = sorted(load_source(spark, file, "federal_surplus", "21-22").collect(), key=lambda r: r["row_id"])
    assert [(r["agency"], r["invoice"], float(r["acquisition_cost"]), r["items"]) for r in got] == [
        ("Tampa\nannex", "i1", 1.005, 2), ("Ocala", "i2", 2.0, 1), ("Miami", "i3", 5.0, 7),
    ]


def test_rows_of_another_width_fail(spark, tmp_path):
    names = {"zip": "zip"}
    short_title = put(tmp_path, "a.csv", "title\nzip,payment,payees\n" + "00001,1,1\n" * 70 + "total\n")
    assert load_source(spark, File(short_title, names), "retirees", "21-22").count() == 10
    for bad in ("00001,1\n", "00001,1,1,9\n"):
        path = put(tmp_path, "b.csv", "title\nzip,payment,payees\n" + "00001,1,1\n" * 65 + bad + "total\n")
        with pytest.raises(Exception, match="not 3 cells"):
            load_source(spark, File(path, names), "retirees", "21-22").collect()
        plain = put(tmp_path, "c.csv", "destination,amount,x\na,1,1\n" + bad.replace(",9", ",9"))
        with pytest.raises(Exception):
            load_source(spark, File(plain), "travel", "21-22").collect()


def test_given_layout_and_kept_columns(spark, tmp_path):
    path = put(tmp_path, "d.csv", "note,,\nFacility,City,District\nF1,Tampa,4\nF2,Ocala,5\n")
    file = File(path, {"Facility": "facility", "City": "city"}, layout=Layout(header=1))
    got = load_source(spark, file, "prison_locations", "21-22")
    assert got.columns == ["facility", "city", "District"] and sorted(r["District"] for r in got.collect()) == ["4", "5"]
