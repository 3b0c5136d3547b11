from __future__ import annotations

from datetime import date

import pytest

from fieldtally.sources import payloads


def responses(spark, *texts):
    rows = [(f"R{n}", date(2024, 2, 16), text) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "region string, obs_date date, payload string")


def test_participation(spark):
    parsed = payloads.parse_participation(responses(
        spark, '{"numContributors": 3, "numChecklists": 5, "numSpecies": 8, "more": 1}',
        '{"numContributors": 3,', None, '{"numContributors": "many"}', '{}'))
    assert [(r["region"], r["observers"], r["checklists"], r["species"])
            for r in parsed.rows.orderBy("region").collect()] == [
        ("R0", 3, 5, 8)]
    assert sorted(r["region"] for r in parsed.rejects.collect()) == ["R1", "R2", "R3", "R4"]


def test_error_answers_are_no_data(spark):
    error = '{"errors": [{"code": "x"}]}'
    for parse in (payloads.parse_participation, payloads.parse_species, payloads.parse_notable,
                  payloads.parse_media):
        parsed = parse(responses(spark, error, "{}"))
        assert parsed.rows.count() == 0 and parsed.rejects.count() == 2


def test_species_list_keeps_a_row_for_no_species(spark):
    parsed = payloads.parse_species(responses(
        spark, '[{"comName": "owl", "howMany": 2}, {"comName": "crow"}]', "[]", "{bad"))
    assert sorted((r["region"], str(r["species"])) for r in parsed.rows.collect()) == [
        ("R0", "crow"), ("R0", "owl"), ("R1", "None")]
    assert [(r["region"], r["payload"]) for r in parsed.rejects.collect()] == [("R2", "{bad")]


@pytest.mark.parametrize("text", ["[", '[{"comName": "owl"}', '[{"comName": "owl"}, ', "nonsense"])
def test_cut_off_lists_are_rejected(spark, text):
    parsed = payloads.parse_species(responses(spark, text))
    assert parsed.rows.count() == 0 and parsed.rejects.count() == 1


def test_notable(spark):
    parsed = payloads.parse_notable(responses(
        spark, '[{"comName": "owl", "subId": "S1"}, {"comName": "owl", "subId": "S2"}]', "[]"))
    assert sorted((r["region"], str(r["common_name"]), str(r["checklist_id"]))
                  for r in parsed.rows.collect()) == [
        ("R0", "owl", "S1"), ("R0", "owl", "S2"), ("R1", "None", "None")]


def test_media(spark):
    parsed = payloads.parse_media(responses(spark, '{"photo": 1, "audio": 2, "video": 3}'))
    row = parsed.rows.collect()[0]
    assert (row["photo"], row["audio"], row["video"]) == (1, 2, 3)


def test_failed_answers_are_rejected(spark):
    frame = spark.createDataFrame(
        [("A", 200, "[]"), ("B", 500, "[]"), ("C", None, "[]")],
        "region string, status int, payload string")
    parsed = payloads.parse_species(frame)
    assert [r["region"] for r in parsed.rows.collect()] == ["A"]
    assert sorted(r["region"] for r in parsed.rejects.collect()) == ["B", "C"]


def test_landed_files(spark, tmp_path):
    for region, text in [("IN-KL", '[\n {"comName": "owl"}\n]'), ("IN-GA", "[]")]:
        folder = tmp_path / f"region={region}" / "obs_date=2024-02-16"
        folder.mkdir(parents=True)
        (folder / "answer.json").write_text(text)
    parsed = payloads.parse_species(payloads.read_responses(spark, str(tmp_path)))
    assert sorted((r["region"], r["obs_date"], str(r["species"]))
                  for r in parsed.rows.collect()) == [
        ("IN-GA", date(2024, 2, 16), "None"), ("IN-KL", date(2024, 2, 16), "owl")]


@pytest.mark.parametrize("payload, status, reason", [
    ('{"numContributors": 1, "numChecklists": 2, "numSpecies": 3}', 200, None),
    ('{"numContributors": 1, "numChecklists": 2, "numSpecies": 3}', 503, "status"),
    ('{"numContributors": 1, "numChecklists": 2}', 200, "figures missing"),
    ('{"numContributors": 1, "numChecklists"', 200, "malformed"),
    ('[{"comName": "owl"}]', 200, "no object"), ("", 200, "no object"), (None, 200, "empty")])
def test_reasons_of_rejects(spark, payload, status, reason):
    answers = spark.createDataFrame([("R", status, payload)], "region string, status int, payload string")
    parsed = payloads.parse_participation(answers)
    assert [r["reason"] for r in parsed.rejects.collect()] == ([reason] if reason else [])
    assert parsed.rows.count() == (reason is None)
    listed = payloads.parse_species(answers)
    assert [r["reason"] for r in listed.rejects.collect()] == (
        [] if payload and payload.startswith("[") else
        ["status" if status != 200 else "empty" if payload is None else "no list"])


def test_landed_files_of_several_lines_with_their_status(spark, tmp_path):
    answers = spark.createDataFrame(
        [("IN", 200, '{"photo": 1,\n "audio": 2,\n "video": 3}'), ("NP", 404, '{"photo": 1}'),
         ("BT-10", 200, "{")], "region string, status int, payload string")
    for _ in range(2):
        payloads.land_responses(answers, str(tmp_path / "landed"))
    assert len(list((tmp_path / "landed").rglob("part-*"))) == 3
    parsed = payloads.parse_media(payloads.read_responses(spark, str(tmp_path / "landed")))
    assert [tuple(r) for r in parsed.rows.collect()] == [("IN", 1, 2, 3)]
    assert {(r["region"], r["reason"]) for r in parsed.rejects.collect()} == {
        ("NP", "status"), ("BT-10", "malformed")}


def test_kept_rejects_outlive_a_second_run(spark, tmp_path):
    schema = "region string, payload string, reason string"
    first = spark.createDataFrame([("IN", "{", "malformed"), ("NP", "{", "malformed")], schema)
    folder = str(tmp_path / "rejects")
    payloads.keep_rejects(first, folder, "2024-02-16")
    payloads.keep_rejects(first, folder, "2024-02-17")
    payloads.keep_rejects(first.limit(1), folder, "2024-02-16")
    kept = payloads.read_rejects(spark, folder).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in kept} == {"2024-02-16": 1, "2024-02-17": 2}
