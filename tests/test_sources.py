import random

import pytest

from plumbline.session import scratch_dir
from plumbline.sources import ordinals, tables


def write(path, name, data):
    (path / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path / name)


def test_csv_keeps_leading_zeros_and_embedded_newlines(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'Zip Code,"Agency\nName",Amount\n02134,"x, y",1.5\n,,\n')
    df = tables.read_table(spark, path, "zip string, agency string, amount double", multiline=True)
    assert [tuple(r) for r in df.collect()] == [("02134", "x, y", 1.5), (None, None, None)]


def test_csv_windows_1252(spark, tmp_path):
    path = write(tmp_path, "a.csv", "city,n\nCañon – €,1\n".encode("cp1252"))
    df = tables.read_table(spark, path, "city string, n int", encoding="cp1252")
    assert [tuple(r) for r in df.collect()] == [("Cañon – €", 1)]


def test_mapping_takes_the_last_line_of_a_key(spark, tmp_path):
    path = write(tmp_path, "m.txt", "TALAHASSEE:TALLAHASSEE\nA:B\nA:C\nB:\n")
    got = {tuple(r) for r in tables.read_mapping(spark, path).collect()}
    assert got == {("TALAHASSEE", "TALLAHASSEE"), ("A", "C"), ("B", "")}


def test_mapping_line_without_one_pair_fails(spark, tmp_path):
    path = write(tmp_path, "m.txt", "A:B\nnothing\n")
    with pytest.raises(Exception, match="not one pair"):
        tables.read_mapping(spark, path).collect()


def test_list_and_file_order(spark, tmp_path):
    path = write(tmp_path, "l.txt", "B\nA\n\nC\n")
    numbered = ordinals.with_ordinal(tables.read_list(spark, path))
    assert sorted((r["_ord"], r["value"]) for r in numbered.collect()) == [(0, "B"), (1, "A"), (2, ""), (3, "C")]


def test_file_order_over_many_splits(spark, tmp_path):
    lines = [f"{i},{random.random()}" for i in range(20000)]
    write(tmp_path, "part-0.csv", "\n".join(lines[:15000]) + "\n")
    write(tmp_path, "part-1.csv", "\n".join(lines[15000:]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = tables.read_table(spark, str(tmp_path), "i bigint, x double", header=False)
        assert df.rdd.getNumPartitions() > 5
        assert ordinals.with_ordinal(df).filter("i != _ord").count() == 0
        assert ordinals.with_ordinal(df).count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parquet_rows_are_numbered_by_their_place_in_the_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 20_000, 1, 4).selectExpr("id", "CAST(rand(1) AS STRING) AS x").write.option("parquet.block.size", 2048).parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() > 5
        numbered = ordinals.with_ordinal(df, total="n")
        assert numbered.columns == ["id", "x", "_ord", "n"]
        assert numbered.where("id != _ord OR n != 20000").isEmpty() and numbered.count() == 20_000
        assert ordinals._row_indexed(df) is not None
        # What a filter left is numbered through, as in other formats.
        some = df.where("id % 3 = 1")
        assert ordinals._row_indexed(some) is None
        assert ordinals.with_ordinal(some).where("_ord != id div 3").isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_row_numbers_by_key_with_a_hot_leading_value(spark):
    rng = random.Random(3)
    keys = [(None if i % 50 == 0 else ("hot" if i % 2 else f"k{rng.randrange(9)}"), i) for i in range(3000)]
    want = {k: n for n, k in enumerate(sorted(keys, key=lambda k: (k[0] is not None, k[0] or "", k[1])))}
    rng.shuffle(keys)
    df = spark.createDataFrame(keys, "a string, b bigint")
    numbered = ordinals.with_ordinal(df, ["a", "b"])
    assert numbered.columns == ["a", "b", "_ord"]
    assert {(r["a"], r["b"]): r["_ord"] for r in numbered.collect()} == want


def numbers(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.mark.parametrize("n", [0, 1, 5, 10, 12])
def test_header_footer_and_slices(spark, n, monkeypatch):
    df = spark.range(10).repartition(3)
    for deep in (False, True):
        monkeypatch.setattr(ordinals, "TOP_N", 0 if deep else 1000)
        assert numbers(ordinals.skip_rows(df, n, ["id"])) == list(range(10))[n:]
        assert numbers(ordinals.slice_rows(df, 0, n, ["id"])) == list(range(10))[:n]
        assert numbers(ordinals.slice_rows(df, 2, n, ["id"])) == list(range(10))[2:n]
        assert numbers(ordinals.slice_labels(df, 0, n, ["id"])) == list(range(10))[: n + 1]
        assert numbers(ordinals.skip_footer(df, n, ["id"])) == (list(range(10))[:-n] if n else list(range(10)))


@pytest.mark.parametrize("keys", [[None, 1, 2, 3], [0, 0, 1, 2], [None, None, 5, 5], [3, 2, 2, None]])
def test_cuts_mean_the_same_at_any_depth(spark, monkeypatch, keys):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "id int, n int")
    key = lambda k: (k is not None, k or 0)
    ranked = sorted(keys, key=key)
    for depth in (0, 1, 2, 1000):
        monkeypatch.setattr(ordinals, "TOP_N", depth)
        for n in range(1, 6):
            cut = key(ranked[min(n, 4) - 1])
            got = lambda out: sorted((r[0] for r in out.select("id").collect()), key=key)  # noqa: B023, E731
            assert got(ordinals.slice_rows(df, 0, n, ["id"])) == [k for k in ranked if key(k) <= cut]
            assert got(ordinals.skip_rows(df, n, ["id"])) == [k for k in ranked if key(k) > cut]
            last = key(ranked[-min(n, 4)])
            assert got(ordinals.skip_footer(df, n, ["id"])) == [k for k in ranked if key(k) < last]
        assert sorted(r[0] for r in ordinals.drop_ordinals(df.where("id > 1"), [0], ["id"]).select("id").collect()) == sorted(
            k for k in keys if k is not None and k > min(x for x in keys if x is not None and x > 1)
        )


def test_dropped_ordinals_beyond_the_end_are_ignored(spark):
    df = spark.range(6)
    assert numbers(ordinals.drop_ordinals(df, [0, 3, 99], ["id"])) == [1, 2, 4, 5]
    assert numbers(ordinals.drop_ordinals(df, [], ["id"])) == list(range(6))


def test_promote_header_below_the_top(spark):
    rows = [(0, "title", None), (1, "City", "Funds"), (2, "TAMPA", "5"), (3, "OCALA", "6")]
    out = ordinals.promote_header(spark.createDataFrame(rows, "n int, a string, b string"), ["n"], at=1)
    assert out.columns == ["n", "City", "Funds"]
    assert sorted(tuple(r) for r in out.collect()) == [(2, "TAMPA", "5"), (3, "OCALA", "6")]


def test_corrections(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "id int, v string")
    assert sorted(tuple(r) for r in ordinals.correct_at(df, 2, "v", "FIXED", ["id"]).collect()) == [(0, "a"), (1, "b"), (2, "FIXED")]
    keyed = ordinals.apply_corrections(df, "v", {"a": {"v": "z"}, "none": {"id": 9}})
    assert sorted(r["v"] or "" for r in keyed.collect()) == ["", "b", "z"]


def test_sheets(spark, tmp_path):
    df = spark.createDataFrame([("JUL 18", 1), ("AUG 2018", 2), ("AUG 2018", 3)], "sheet string, n int")
    path = str(tmp_path / "sheets")
    tables.write_sheets(df, path)
    assert sorted(r[0] for r in tables.read_sheet(spark, path, "AUG 2018").collect()) == [2, 3]
    assert [r[0] for r in tables.read_sheet(spark, path, 0, order=["JUL 18", "AUG 2018"]).collect()] == [1]
    scan = tables.read_sheets(spark, path, ["JUL 18"])
    assert "PartitionFilters: [isnotnull(sheet" in scan._jdf.queryExecution().toString()
    assert sorted(r[0] for r in tables.list_sheets(tables.read_sheets(spark, path)).collect()) == ["AUG 2018", "JUL 18"]
    csv = str(tmp_path / "csv")
    tables.write_sheets(df, csv, fmt="csv")
    assert sorted(r["n"] for r in tables.read_sheets(spark, csv, ["AUG 2018"], "n int", fmt="csv").collect()) == [2, 3]


def test_year_tables(spark, tmp_path):
    path = str(tmp_path / "years")
    tables.write_year(spark.createDataFrame([("A", 1.0)], "city string, x double"), path, "18-19")
    tables.write_year(spark.createDataFrame([("A", 2.0)], "city string, y double"), path, "0102")
    tables.write_year(spark.createDataFrame([("B", 3.0)], "city string, x double"), path, "18-19")
    got = sorted(((r["fy"], r["city"], r["x"], r["y"]) for r in tables.read_years(spark, path).collect()))
    assert got == [("0102", "A", None, 2.0), ("18-19", "B", 3.0, None)]


def test_conform(spark):
    df = spark.createDataFrame([("TAMPA", "1", 5)], "CITY string, `Home  City` string, extra int")
    out = tables.conform(df, {"CITY": "city", "Home  City": "home_city", "absent": "x"}, "city string, home_city int")
    assert out.columns == ["city", "home_city"] and tuple(out.first()) == ("TAMPA", 1)
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        tables.conform(df, {}, "city string, fte double")


def test_scratch_dir_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "t"), scratch_dir(spark, "t")
    assert a != b and a.startswith(shared)


def test_deep_cuts_keep_the_rows_in_place(spark):
    plan = ordinals.slice_rows(spark.range(100000), 900, None, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert numbers(ordinals.slice_rows(spark.range(3000), 2500, 2600, ["id"])) == list(range(2500, 2600))
