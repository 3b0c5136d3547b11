"""Operators against plain Python over the same small facts."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fieldtally.functions.columns import STATE
from fieldtally.operators import calendar, event, regions, report, rollup, tally, taxa
from fieldtally.operators.literal import region_frame
from tests import world
from tests.world import DAYS, NAMES, above, in_event


@pytest.fixture(scope="module", params=[1, 2])
def facts(request):
    return world.make(request.param)


@pytest.fixture(scope="module")
def survey(spark, facts):
    return world.survey_of(spark, *facts)


def grouped(rows, key, value):
    found = defaultdict(set)
    for row in rows:
        for k in key(row):
            found[k].add(value(row))
    return found


def expected_daily(facts):
    checklists, sightings, _ = facts
    lists = grouped(checklists, lambda r: [(p, r[2]) for p in above(r[3])], lambda r: r[0])
    people = grouped(checklists, lambda r: [(p, r[2]) for p in above(r[3])], lambda r: r[1])
    kinds = grouped(sightings, lambda r: [(p, r[1]) for p in above(r[2])], lambda r: r[3])
    return {(p, d): (len(people[p, d]), len(lists[p, d]), len(kinds[p, d]))
            for p in NAMES for d in DAYS.days}


def expected_whole(facts, keep=in_event):
    checklists = [r for r in facts[0] if keep(r[2])]
    sightings = [r for r in facts[1] if keep(r[1])]
    lists = grouped(checklists, lambda r: above(r[3]), lambda r: r[0])
    people = grouped(checklists, lambda r: above(r[3]), lambda r: r[1])
    kinds = grouped(sightings, lambda r: above(r[2]), lambda r: r[3])
    return {p: (len(people[p]), len(lists[p]), len(kinds[p])) for p in NAMES}


def every_region(survey):
    return regions.as_regions(survey.region_dim())


def daily(survey):
    return tally.participation_by_region_day(
        survey.visits(days=DAYS), survey.sightings(DAYS), every_region(survey), DAYS)


def test_participation_by_region_and_day(survey, facts):
    got = {(r["region"], r["obs_date"]): (r["observers"], r["checklists"], r["species"])
           for r in daily(survey).collect()}
    assert got == expected_daily(facts)


def test_whole_event(survey, facts):
    got = tally.participation_by_region(
        survey.visits((), DAYS), survey.sightings(DAYS), every_region(survey))
    assert {r["region"]: (r["observers"], r["checklists"], r["species"])
            for r in got.collect()} == expected_whole(facts)


def test_named_codes_only(survey, facts):
    codes = ["IN-KL", "BT-2-Y"]
    got = tally.participation_counts(survey.visits((), DAYS), (), codes=codes).collect()
    whole = expected_whole(facts)
    assert {r["region"]: (r["observers"], r["checklists"]) for r in got} == {
        c: whole[c][:2] for c in codes}
    seen = tally.species_counts(survey.sightings(DAYS), (), codes=codes).collect()
    assert {r["region"]: r["species"] for r in seen} == {c: whole[c][2] for c in codes}


def test_species_by_region_and_day(survey, facts):
    rows = tally.species_by_region_day(survey.sightings(), every_region(survey), DAYS).collect()
    kinds = grouped(facts[1], lambda r: [(p, r[1]) for p in above(r[2])], lambda r: r[3])
    expected = {(p, d, s) for p in NAMES for d in DAYS.days for s in kinds[p, d] or {None}}
    assert len(rows) == len(expected)
    assert {(r["region"], r["obs_date"], r["species"]) for r in rows} == expected


def test_matrix_marks_days_and_empty_days(survey, facts):
    rows = event.species_list(survey.sightings(), every_region(survey), DAYS,
                              survey.region_dim(), survey.taxonomy()).collect()
    kinds = grouped(facts[1], lambda r: [(p, r[1]) for p in above(r[2])], lambda r: r[3])
    expected = {}
    for place in NAMES:
        for species in world.SPECIES:
            flags = tuple(int(species in kinds[place, d]) for d in DAYS.days)
            if any(flags):
                expected[place, species] = flags
        empty = tuple(int(not kinds[place, d]) for d in DAYS.days)
        if any(empty):
            expected[place, None] = empty
    columns = event.day_columns(DAYS)
    assert {(r["region"], r["english_name"]): tuple(r[c] for c in columns)
            for r in rows} == expected
    # Order: region, then day columns from most to least, then the taxonomy.
    keys = [(r["region"], tuple(-r[c] for c in columns), r["sort"] or 99.0) for r in rows]
    assert keys == sorted(keys)


def test_one_day_equals_that_day_of_many(survey):
    day = calendar.EventDays.of(DAYS.days[2])
    one = event.species_list(survey.sightings(), every_region(survey), day,
                             survey.region_dim(), survey.taxonomy())
    many = event.species_list(survey.sightings(), every_region(survey), DAYS,
                              survey.region_dim(), survey.taxonomy())
    assert sorted(map(str, one.select("region", "english_name").collect())) == sorted(map(
        str, many.where("day3 = 1").select("region", "english_name").collect()))
    counts = event.participation_summary(
        survey.visits(), survey.sightings(), every_region(survey), day, survey.region_dim())
    wide = event.participation_matrix(daily(survey), DAYS, survey.region_dim())
    of_day = {(r["region"], r["total"]): r["day3"] for r in wide.collect()}
    for row in counts.collect():
        for label, metric in event.METRICS.items():
            assert of_day[row["region"], label] == row[metric]


def test_days_beyond_one_word_of_bits(spark, survey):
    days = calendar.EventDays.span("2024-01-01", "2024-04-09")
    rows = event.species_matrix(survey.sightings(), every_region(survey), days,
                                survey.region_dim(), survey.taxonomy())
    assert len(days) == 100 and len([c for c in rows.columns if c.startswith("day")]) == 100
    offset = (DAYS.first - days.first).days
    renamed = {f"day{offset + n}": f"day{n}" for n in range(1, 5)}
    short = event.species_matrix(survey.sightings(DAYS), every_region(survey), DAYS,
                                 survey.region_dim(), survey.taxonomy())
    both = rows.where(" + ".join(renamed) + " > 0 AND english_name IS NOT NULL").select(
        "region", "english_name", *[F.col(a).alias(b) for a, b in renamed.items()])
    wanted = short.where("english_name IS NOT NULL").select(*both.columns)
    assert sorted(map(str, both.collect())) == sorted(map(str, wanted.collect()))


def test_summary_with_and_without_a_list(survey, facts):
    listed = event.species_list(survey.sightings(), every_region(survey), DAYS,
                                survey.region_dim(), survey.taxonomy())
    args = (survey.visits(), survey.sightings(), every_region(survey), DAYS, survey.region_dim())
    with_list = event.participation_summary(*args, listed).collect()
    per_day, whole = expected_daily(facts), expected_whole(facts)
    assert len(with_list) == 3 * len(NAMES)
    for row in with_list:
        place, position = row["region"], list(event.METRICS).index(row["total"])
        assert row["region_name"] == NAMES[place]
        by_day = [per_day[place, d][position] for d in DAYS.days]
        assert [row[c] for c in event.day_columns(DAYS)] == by_day
        total = {"OBSERVERS": None, "CHECKLISTS": sum(by_day), "SPECIES": whole[place][2]}
        assert row["all_days"] == total[row["total"]]
    order = [(r["region"], list(event.METRICS).index(r["total"])) for r in with_list]
    assert order == sorted(order)
    without = {(r["region"], r["total"]): r["all_days"]
               for r in event.participation_summary(*args).collect()}
    assert {v for (_, t), v in without.items() if t != "CHECKLISTS"} == {None}


def test_missing_species_may_count_as_one(survey, facts):
    listed = event.species_list(survey.sightings(), every_region(survey), DAYS,
                                survey.region_dim(), survey.taxonomy())
    matrix = event.participation_matrix(daily(survey), DAYS, survey.region_dim())
    rows = event.with_all_days(matrix, listed, null_as_value=True).where(
        "total = 'SPECIES'").collect()
    per_day, whole = expected_daily(facts), expected_whole(facts)
    for row in rows:
        empty = any(per_day[row["region"], d][2] == 0 for d in DAYS.days)
        assert row["all_days"] == whole[row["region"]][2] + empty


def test_states_and_their_order(survey, facts):
    states = regions.as_regions(survey.region_dim(), (STATE,))
    rows = rollup.participation_states(survey.visits((), DAYS), survey.sightings(DAYS), states,
                                       survey.region_dim()).collect()
    whole = expected_whole(facts)
    assert {r["region"]: (r["observers"], r["checklists"], r["species"]) for r in rows} == {
        s: whole[s] for s in world.STATES}
    keys = [(-r["observers"], -r["species"], r["region"]) for r in rows]
    assert keys == sorted(keys)


def countries(survey, by=(), two_years=False):
    visits = survey.visits(by, DAYS, two_years)
    active = rollup.state_activity(visits, regions.as_regions(survey.region_dim(), (STATE,)), by)
    coverage = rollup.region_coverage(active, survey.region_codes(), by)
    return rollup.participation_countries(
        visits, survey.sightings(DAYS, two_years), survey.country_group(), coverage, by)


def expected_countries(facts, keep=in_event):
    lists, kinds = defaultdict(int), defaultdict(set)
    for region, name in world.GROUP:
        lists[name] += sum(keep(r[2]) and region in above(r[3]) for r in facts[0])
        kinds[name] |= {r[3] for r in facts[1] if keep(r[1]) and region in above(r[2])}
    whole = expected_whole(facts, keep)
    active = {code: [s for s in world.STATES if s.startswith(code + "-") and whole[s][0]]
              for code in world.COUNTRIES}
    return {name: (lists[name], len(kinds[name]), len(active[code]) or None)
            for code, name in world.COUNTRIES.items()}


def test_countries(survey, facts):
    rows = countries(survey).collect()
    assert {r["region_name"]: (r["checklists"], r["species"], r["regions"])
            for r in rows} == expected_countries(facts)
    india = next(r for r in rows if r["region_name"] == "India")
    assert (india["tot_regions"], india["region_cov"]) == (2, 100.0)
    keys = [(-r["checklists"], -r["species"]) for r in rows]
    assert keys == sorted(keys)


def test_country_species_only_for_several_regions(survey, facts):
    rows = rollup.country_species(survey.sightings(DAYS), survey.country_group()).collect()
    assert {r["region_name"]: r["species"] for r in rows} == {
        "India": expected_countries(facts)["India"][1]}


def test_a_silent_country_leaves_the_overall_regions_unknown(survey, facts):
    listed = survey.sightings(DAYS).withColumnRenamed("species", "english_name")
    row = rollup.overall_totals(countries(survey), listed).collect()
    assert len(row) == 1 and row[0]["regions"] is None
    expected = expected_countries(facts)
    assert row[0]["checklists"] == sum(v[0] for v in expected.values())
    assert row[0]["species"] == len({r[3] for r in facts[1] if in_event(r[1])})
    known = rollup.overall_totals(countries(survey).where("regions IS NOT NULL"), listed)
    assert known.collect()[0]["regions"] == sum(v[2] or 0 for v in expected.values())


def test_change_on_the_year_before(survey, facts):
    before_days = set(DAYS.previous().days)
    now, before = expected_countries(facts), expected_countries(facts, before_days.__contains__)
    rows = rollup.year_over_year(
        countries(survey, ("period",), True), ["region_name"]).collect()

    def change(a, b):
        return None if a is None or not b else pytest.approx(100 * (a - b) / b)

    assert {r["region_name"]: (r["checklists"], r["species"], r["regions"]) for r in rows} == {
        name: tuple(change(a, b) for a, b in zip(now[name], before[name])) for name in now}
    assert next(r for r in rows if r["region_name"] == "Nepal")["checklists"] is None


def test_notable_rarity(survey, facts):
    rows = taxa.notable_rarity(tally.notable_sightings(survey.sightings(), (STATE,))).collect()
    expected = {}
    for name in ("owl", "wren"):
        mine = [(r[0], "-".join(r[2].split("-")[:2])) for r in facts[1] if r[3] == name]
        expected[name] = (len({m[0] for m in mine}), len({m[1] for m in mine}),
                          min(m[1] for m in mine))
    assert {r["common_name"]: (r["no_lists"], r["no_regions"], r["region"])
            for r in rows} == expected
    keys = [(r["no_lists"], r["no_regions"], r["common_name"]) for r in rows]
    assert keys == sorted(keys)


def test_media(survey, facts):
    rows = tally.media_summary(survey.media_counts(DAYS), every_region(survey)).collect()
    for row in rows:
        mine = [m[2] for m in facts[2] if in_event(m[0]) and row["region"] in above(m[1])]
        assert [row[k] for k in tally.MEDIA_TYPES] == [mine.count(k) for k in tally.MEDIA_TYPES]


def test_observers_headline_takes_the_first_of_equal_days(survey, facts):
    rows = report.headline_observers(daily(survey), DAYS, survey.region_dim()).collect()
    per_day = expected_daily(facts)
    for row in rows:
        counts = [per_day[row["region"], d][0] for d in DAYS.days]
        most = max(counts)
        assert (row["no_days"], row["min_observers"], row["max_observers"], row["max_day"],
                row["days_at_max"]) == (4, min(counts), most, counts.index(most) + 1,
                                        counts.count(most))
    ties = report.days_of_most_observers(daily(survey), DAYS).collect()
    expected = {(p, n) for p in NAMES for n, d in enumerate(DAYS.days, 1)
                if per_day[p, d][0] == max(per_day[p, x][0] for x in DAYS.days)}
    assert {(r["region"], r["day_no"]) for r in ties} == expected


def test_subregions(survey, facts):
    whole = tally.participation_by_region(
        survey.visits((), DAYS), survey.sightings(DAYS), every_region(survey))
    rows = {r["region"]: r for r in report.headline_subregions(whole).collect()}
    active = {p for p, counts in expected_whole(facts).items() if any(counts)}
    for parent, row in rows.items():
        children = [p for p in active if p.rpartition("-")[0] == parent]
        assert row["no_reg"] == len(children)
        assert row["which_reg"] == ("districts" if "-" in parent else "states/union territories")
    assert set(rows) == {p.rpartition("-")[0] for p in active} - {""}


def test_row_order_of_the_facts_does_not_matter(spark, facts, survey):
    mixed = [random.Random(7).sample(rows, len(rows)) for rows in facts]
    other = world.survey_of(spark, *mixed)
    for of in (lambda s: countries(s), lambda s: daily(s)):
        assert sorted(map(str, of(survey).collect())) == sorted(map(str, of(other).collect()))


def test_distinct_counts_do_not_add_up_but_bound(survey):
    rows = {r["region"]: r for r in tally.participation_by_region(
        survey.visits((), DAYS), survey.sightings(DAYS), every_region(survey)).collect()}
    for country in world.COUNTRIES:
        states = [rows[s] for s in world.STATES if s.startswith(country + "-")]
        assert sum(s["species"] for s in states) >= rows[country]["species"]
        assert sum(s["observers"] for s in states) >= rows[country]["observers"]


def test_requested_region_without_any_row(spark, survey):
    asked = region_frame(spark, ["XX"])
    row = tally.participation_by_region(
        survey.visits((), DAYS), survey.sightings(DAYS), asked).collect()[0]
    assert (row["observers"], row["checklists"], row["species"]) == (0, 0, 0)
    listed = tally.species_by_region(survey.sightings(DAYS), asked).collect()
    assert [tuple(r) for r in listed] == [("XX", None)]
