"""Text files bound by name, with quarantine."""

import json
import os

import pytest

from pricenet.sources import files, panel

HEADER = "City,Year,Category,Month_Year,Item_Description,Normalized_Price"


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def rows_of(df):
    return sorted((r.city, r.year, r.category, r.month_year, r.item_description, r.normalized_price) for r in df.collect())


def test_csv_columns_are_bound_by_header(spark, tmpdir_path):
    put(tmpdir_path, "a.csv", "Category,Year,City,Item_Description,Extra,Month_Year,Normalized_Price\n"
                              'Food,2024,Lima,"rice, long",x,2024-01,1.5\n')
    put(tmpdir_path, "b.csv", "normalized_price,month_year,item_description,category,city,year\r\n-0.5,2024-02,oil,Fuel,Cusco,2023\r\n")
    put(tmpdir_path, "c.csv", HEADER + "\n")
    put(tmpdir_path, "d.csv", "")
    got = panel.read_observations(spark, tmpdir_path, "csv")
    assert rows_of(got) == [("Cusco", 2023, "Fuel", "2024-02", "oil", -0.5), ("Lima", 2024, "Food", "2024-01", "rice, long", 1.5)]
    assert got.columns[-1] == "ordinal"


def test_missing_columns_are_named(spark, tmpdir_path):
    path = put(tmpdir_path, "a.csv", "City,Year,Category,Month_Year\nA,2024,Food,2024-01\n")
    with pytest.raises(ValueError, match="item_description, normalized_price"):
        panel.read_observations(spark, path, "csv")
    # One bad file among good ones is enough.
    put(tmpdir_path, "b.csv", HEADER + "\nA,2024,Food,2024-01,rice,1\n")
    with pytest.raises(ValueError, match="normalized_price"):
        panel.read_observations(spark, tmpdir_path, "csv")
    path = put(tmpdir_path, "c.json", json.dumps({"City": "A", "Year": 2024, "Category": "F", "Month_Year": "m", "Item_Description": "i"}))
    with pytest.raises(ValueError, match="normalized_price"):
        panel.read_observations(spark, path, "json")


def test_bad_rows_are_set_apart(spark, tmpdir_path):
    path = put(tmpdir_path, "a.csv", HEADER + "\nA,2024,Food,2024-01,rice,1.5\nA,2024,Food,2024-01,oil,n/a\n"
               "A,MMXX,Food,2024-01,oil,1\nB,2024,Food,2024-01,rice,\nC,2024,Food,2024-01,rice,NaN\nD,2024,Food,2024-01,rice,Infinity\n"
               "E,2024,Food\nF,2024,Food,2024-01,rice,1,2\n ,, , , , \n")
    rejects = os.path.join(tmpdir_path, "rejects")
    got = panel.read_observations(spark, path, "csv", rejects=rejects)
    prices = {(r.city, r.item_description): r.normalized_price for r in got.collect()}
    assert {k: v for k, v in prices.items() if k[0].strip()} == {("A", "rice"): 1.5, ("B", "rice"): None, ("C", "rice"): None}
    bad = spark.read.parquet(rejects).collect()
    assert sorted(r.reject_reason for r in bad) == [
        "Normalized_Price is no double: Infinity", "Normalized_Price is no double: n/a", "Year is no int: MMXX",
        "malformed record", "malformed record"]
    records = {r.record for r in bad}
    assert "E,2024,Food" in records and any('"MMXX"' in r for r in records) and all(r.path.endswith("a.csv") for r in bad)
    with pytest.raises(Exception, match="bad row"):
        panel.read_observations(spark, path, "csv").collect()
    # A second read appends to the side table.
    panel.read_observations(spark, path, "csv", rejects=rejects)
    assert spark.read.parquet(rejects).count() == 10


def test_json_lines(spark, tmpdir_path):
    good = {"Year": 2024, "City": "A", "Category": "Food", "Month_Year": "2024-01", "Item_Description": "rice", "Normalized_Price": 1.5, "X": 1}
    lines = [json.dumps(good), json.dumps({**good, "City": "B", "Normalized_Price": None}), json.dumps({**good, "Normalized_Price": "n/a"}),
             json.dumps({k: v for k, v in good.items() if k != "Normalized_Price"} | {"City": "C"}), "{broken"]
    path = put(tmpdir_path, "a.json", "\n".join(lines))
    rejects = os.path.join(tmpdir_path, "rejects")
    got = panel.read_observations(spark, path, "json", rejects=rejects)
    assert {(r.city, r.normalized_price) for r in got.collect()} == {("A", 1.5), ("B", None), ("C", None)}
    bad = {r.reject_reason: r.record for r in spark.read.parquet(rejects).collect()}
    assert bad["malformed record"] == "{broken" and len(bad) == 2


def test_empty_files(spark, tmpdir_path):
    a, b = put(tmpdir_path, "a.csv", ""), put(tmpdir_path, "b.json", "\n")
    assert panel.read_observations(spark, a, "csv").collect() == []
    assert panel.read_observations(spark, b, "json").collect() == []


def test_files_of_one_header_are_one_read(spark, tmpdir_path):
    for k in range(12):
        put(tmpdir_path, f"{k}.csv", HEADER + f"\nC{k},2024,Food,2024-01,rice,{k}\n")
    assert [len(x) for x in files.header_layouts(spark, [tmpdir_path])] == [12]
    assert panel.read_observations(spark, tmpdir_path, "csv").count() == 12
