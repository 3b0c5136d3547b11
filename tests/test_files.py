from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fieldtally import schemas
from fieldtally.functions.columns import QUOTING
from fieldtally.sinks import files as sink
from fieldtally.sources import files as source
from tests import world


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_taxonomy_with_foreign_headers_and_bad_numbers(spark, tmp_path):
    path = write(tmp_path / "t.csv", "Order,Common.Name,Other\n2.5,owl,x\nnone,crow,y\n")
    got = source.read_taxonomy(spark, path, {"english_name": "Common.Name", "sort": "Order"})
    assert {tuple(r) for r in got.collect()} == {("owl", 2.5), ("crow", None)}


def test_taxonomy_with_decimal_commas(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'english_name,sort\nowl,"2,5"\ncrow,3\nwren,\n')
    got = source.read_taxonomy(spark, path, comma_decimals=True)
    assert {tuple(r) for r in got.collect()} == {("owl", 2.5), ("crow", 3.0), ("wren", None)}


def test_missing_column_is_named(spark, tmp_path):
    path = write(tmp_path / "t.csv", "english_name\nowl\n")
    with pytest.raises(ValueError, match="sort"):
        source.read_taxonomy(spark, path)


def test_status_and_name_changes_keep_their_columns_only(spark, tmp_path):
    status = write(tmp_path / "s.csv", "old_name,extra,priority_status,endemic\nowl,1,High,Yes\n")
    assert [tuple(r) for r in source.read_priority(spark, status).collect()] == [
        ("owl", "High", "Yes")]
    change = write(tmp_path / "c.csv", "NEW: name (default),OLD: name\nowl,old owl\n")
    columns = {"old_name": "OLD: name", "new_name": "NEW: name (default)"}
    assert [tuple(r) for r in source.read_name_changes(spark, change, columns).collect()] == [
        ("old owl", "owl")]


def test_missing_entries(spark, tmp_path):
    path = write(tmp_path / "s.csv", "old_name,priority_status,endemic\nowl,NA,\nwren,Low,NA\n")
    assert {tuple(r) for r in source.read_priority(spark, path).collect()} == {
        ("owl", None, None), ("wren", "Low", None)}
    frame = spark.createDataFrame([("a", None), (None, 1.5)], "x string, y double")
    sink.write_csv(frame.coalesce(1), str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("part-*")).read_text() == "x,y\na,NA\nNA,1.5\n"


def test_a_country_called_na(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.csv", "code,name\n" + row) for n, row in
             enumerate(["NA,Namibia\n", "NA-ER,Erongo\n", ""])]
    got = source.read_region_lists(spark, *paths).collect()
    assert {tuple(r) for r in got} == {("NA", "Namibia", 0), ("NA-ER", "Erongo", 1)}


def test_region_lists(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.csv", "code,name\n" + row) for n, row in
             enumerate(["IN,India\n", "IN-GA,Goa\n", "IN-GA-N,North\n"])]
    assert {tuple(r) for r in source.read_region_lists(spark, *paths).collect()} == {
        ("IN", "India", 0), ("IN-GA", "Goa", 1), ("IN-GA-N", "North", 2)}


def test_region_codes_with_dotted_names(spark, tmp_path):
    path = str(tmp_path / "codes")
    names = {f.name: f.name.upper().replace("_", ".") for f in schemas.REGION_CODES}
    spark.createDataFrame([("IN", "India", "IN-GA", "Goa", "IN-GA-N", "North")],
                          schemas.REGION_CODES).withColumnsRenamed(names).write.parquet(path)
    assert [tuple(r) for r in source.read_region_codes(spark, path, names).collect()] == [
        ("IN", "India", "IN-GA", "Goa", "IN-GA-N", "North")]


def test_species_lists_are_found_by_name(spark, tmp_path):
    write(tmp_path / "a_SpeciesList.csv", "english_name\nowl\ncrow\n")
    write(tmp_path / "b_Other.csv", "english_name\nwren\n")
    sink.write_csv(spark.createDataFrame([("owl",), ("kite",)], schemas.SPECIES_LIST),
                   str(tmp_path / "c_SpeciesList.csv"))
    got = source.read_species_lists(spark, str(tmp_path))
    assert sorted(r["english_name"] for r in got.collect()) == ["crow", "kite", "owl", "owl"]


def test_csv_keeps_order_and_can_be_run_again(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.range(100).repartition(5).orderBy(F.col("id").desc())
    for _ in range(2):
        sink.write_csv(frame, path)
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    rows = [int(line) for p in parts for line in p.read_text().splitlines() if line != "id"]
    assert rows == list(range(99, -1, -1))


def test_semicolon_csv(spark, tmp_path):
    path = tmp_path / "out"
    sink.write_semicolon_csv(
        spark.createDataFrame([("a", 1.5, 2)], "`name.x` string, pct double, n int").coalesce(1), str(path))
    text = next(path.glob("part-*.csv")).read_text()
    assert text == "name.x;pct;n\na;1,5;2\n"


def test_workbook_is_one_folder_per_sheet(spark, tmp_path):
    frame = spark.createDataFrame([("a",)], "x string")
    places = sink.write_workbook({"Countries YoY": frame, "Overall": frame}, str(tmp_path / "b"))
    assert places["Countries YoY"].endswith("/countries_yoy")
    assert spark.read.csv(places["Overall"], header=True).collect()[0]["x"] == "a"
    with pytest.raises(ValueError):
        sink.write_workbook({"A b": frame, "a-B": frame}, str(tmp_path / "c"))


def test_facts_by_day_are_pruned_by_folder(spark, tmp_path):
    checklists, _, _ = world.make(5)
    path = str(tmp_path / "facts")
    sink.write_facts(spark.createDataFrame(checklists, schemas.CHECKLISTS), path)
    facts = source.read_facts(spark, path, schemas.CHECKLISTS)
    event = facts.where(world.DAYS.contains(F.col("obs_date")))
    plan = event._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_date" in plan
    assert event.count() == sum(world.in_event(r[2]) for r in checklists)
    assert facts.count() == len(checklists)


def test_reloading_a_day_keeps_the_others(spark, tmp_path):
    checklists, _, _ = world.make(5)
    path = str(tmp_path / "facts")
    frame = spark.createDataFrame(checklists, schemas.CHECKLISTS)
    sink.write_facts(frame, path)
    sink.write_facts(frame.where(F.col("obs_date") == world.DAYS.first).limit(1), path,
                     keep_other_days=True)
    of_day = sum(r[2] == world.DAYS.first for r in checklists)
    left = source.read_facts(spark, path, schemas.CHECKLISTS).count()
    assert left == len(checklists) - of_day + 1


def test_written_table_equals_the_frame(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    assert sorted(map(str, sink.written(frame, "t").collect())) == sorted(map(str, frame.collect()))


def test_quotes_and_commas_are_standard_csv(spark, tmp_path):
    import csv
    names = ['a "b" c', "d, e", 'f;"g"', "plain"]
    frame = spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)
    sink.write_csv(frame, str(tmp_path / "names"))
    [path] = (tmp_path / "names").glob("part-*.csv")
    with open(path, newline="") as lines:
        assert [row[0] for row in csv.reader(lines)] == ["name", *names]
    assert [r["name"] for r in spark.read.csv(str(path), header=True, **QUOTING).collect()] == names


def test_lists_whose_headers_differ(spark, tmp_path):
    folder = tmp_path / "a [b] {c}"
    write(folder / "1_SpeciesList.csv", "english_name,sort\nowl,2\n")
    write(folder / "2_SpeciesList.csv", "sort, english_name\n1,crow\nx,kite\n")
    write(folder / "3_SpeciesList.csv", 'region,sort,"english_name",note\nIN,3,"wren, small",y\n')
    write(folder / "4_SpeciesList.csv", "sort,english_name\n")
    write(folder / "5_SpeciesList.csv", "")
    path = str(tmp_path / "a*")
    got = source.read_species_lists(spark, path, schema=schemas.TAXONOMY)
    assert {tuple(r) for r in got.collect()} == {
        ("owl", 2.0), ("crow", 1.0), ("kite", None), ("wren, small", 3.0)}
    assert sorted(map(len, source.files_by_header(spark, path + "/*List.csv").values())) == [1, 1, 2]
    write(folder / "6_SpeciesList.csv", "sort,name\n1,owl\n")
    with pytest.raises(ValueError, match="english_name"):
        source.read_species_lists(spark, path, schema=schemas.TAXONOMY)


def test_no_lists_at_all(spark, tmp_path):
    write(tmp_path / "x_SpeciesList.csv", "")
    assert source.read_species_lists(spark, str(tmp_path)).count() == 0


def test_a_workbook_appears_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "book")
    assert sink.open_workbook(spark, path) == {}
    old = spark.createDataFrame([("old",)], "x string")
    new = spark.createDataFrame([("new",)], "x string")
    broken = new.select(F.raise_error(F.lit("no third sheet")).cast("string").alias("x"))
    sink.publish_workbook({"One": old, "Two": old, "Three": old}, path)
    shown = sink.open_workbook(spark, path)
    with pytest.raises(Exception, match="no third sheet"):
        sink.publish_workbook({"One": new, "Two": new, "Three": broken}, path)
    assert sink.open_workbook(spark, path) == shown
    assert {spark.read.csv(p, header=True).first()["x"] for p in shown.values()} == {"old"}
    sink.publish_workbook({"One": new, "Two": new}, path)
    now = sink.open_workbook(spark, path)
    assert set(now) == {"One", "Two"}
    assert {spark.read.csv(p, header=True).first()["x"] for p in now.values()} == {"new"}
    assert not any((tmp_path / "book").glob(shown["One"].split("/")[-2]))
