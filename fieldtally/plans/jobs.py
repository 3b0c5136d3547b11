"""The three jobs: live summary, final summary with change, and event report.

Each reads the facts of its days once, reduces them to two tables (checklists
per observer, species per place) and derives every result from those.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.columns import ALL_LEVELS, STATE
from fieldtally.operators import event, regions, report, rollup, tally, taxa
from fieldtally.operators.calendar import CURRENT, EventDays
from fieldtally.operators.literal import region_frame
from fieldtally.sinks.files import written
from fieldtally.sources.facts import Survey


@dataclass(frozen=True)
class ReducedFacts:
    visits: DataFrame
    seen: DataFrame


def reduce_facts(survey: Survey, days: EventDays | None, by: Sequence[str],
                 two_years: bool = False, before: EventDays | None = None) -> ReducedFacts:
    """The facts of an event (or of all time), read once and written down reduced."""
    seen = survey.sightings(days, two_years, before).where(F.col("species").isNotNull()).select(
        "place", *by, "species").distinct()
    return ReducedFacts(written(survey.visits(by, days, two_years, before), "visits"),
                        written(seen, "seen"))


def _picked(survey: Survey, patterns: Sequence[str], districts: bool) -> DataFrame:
    """The countries, states and (if wanted) districts that the patterns pick, with names."""
    return regions.as_regions(
        regions.select_regions(survey.region_codes(), patterns, districts))


def live_summary(survey: Survey, days: EventDays, patterns: Sequence[str],
                 districts: bool = False) -> dict[str, DataFrame]:
    """Summary of picked regions: participation, countries, species and notable species."""
    dim, taxonomy = survey.region_dim(), survey.taxonomy()
    places = _picked(survey, patterns, districts)
    group = survey.country_group()
    facts = reduce_facts(survey, days, ())
    listed = tally.species_by_region(facts.seen, places)
    notable = tally.notable_sightings(survey.notable(days)).join(
        places, "region", "left_semi")
    return {
        "States": rollup.participation_states(
            facts.visits, facts.seen, places, dim, levels=ALL_LEVELS),
        "Countries": rollup.participation_countries(facts.visits, facts.seen, group),
        "Species per region": tally.species_per_region(listed),
        "Species list": taxa.combined_species(
            listed.withColumnRenamed("species", "english_name"), taxonomy),
        "Notable species": taxa.notable_rarity(notable),
    }


def final_summary(survey: Survey, days: EventDays, patterns: Sequence[str] | None = None,
                  districts: bool = False,
                  before: EventDays | None = None) -> dict[str, DataFrame]:
    """States and countries with region coverage and the change on an earlier event.

    The earlier event is on its own days, or on the same ones a year before.

    `patterns` picks the regions of the event; without it all states take part.
    Facts of both years are tagged and aggregated in one pass.
    """
    by = ("period",)
    dim, group, codes = survey.region_dim(), survey.country_group(), survey.region_codes()
    facts = reduce_facts(survey, days, by, two_years=True, before=before)
    if patterns is None:
        places = regions.as_regions(dim, (STATE,))
    else:
        places = _picked(survey, patterns, districts)
    states = rollup.participation_states(facts.visits, facts.seen, places, dim, by, ALL_LEVELS)
    coverage = rollup.region_coverage(states, codes, by)
    countries = rollup.participation_countries(
        facts.visits, facts.seen, group, coverage, by)
    listed = tally.species_seen(facts.seen, by).join(places, "region", "left_semi") \
        .withColumnRenamed("species", "english_name")
    overall = rollup.overall_totals(countries, listed, by)

    def current(frame: DataFrame) -> DataFrame:
        return frame.where(F.col("period") == CURRENT).drop("period")

    return {
        "States": current(states),
        "Countries": current(countries),
        "Countries YoY": rollup.year_over_year(countries, ["region_name"]),
        "Overall": current(overall),
        "Overall YoY": rollup.year_over_year(overall),
        "Species list": taxa.combined_species(current(listed), survey.taxonomy()),
    }


def event_report(survey: Survey, days: EventDays, requested: Sequence[str], event_type: str,
                 base_url: str) -> dict[str, DataFrame]:
    """Report on each requested region: lists, participation by sub-region and headlines.

    Codes that no list knows are on a sheet of their own and on no other.
    """
    dim, taxonomy = survey.region_dim(), survey.taxonomy()
    wanted = region_frame(survey.spark, requested)
    asked = wanted.join(dim.select(F.col("code").alias("region")), "region", "left_semi")
    expanded = regions.expand_regions(asked, dim).select(F.col("code").alias("region")).distinct()
    facts = reduce_facts(survey, days, tally.BY_DAY)
    listed = event.species_list(facts.seen, expanded, days, dim, taxonomy)
    summary = event.participation_summary(
        facts.visits, facts.seen, expanded, days, dim, listed)
    daily = tally.participation_by_region_day(facts.visits, facts.seen, expanded, days)
    whole = tally.participation_by_region(
        facts.visits.groupBy("place", "observer_id").agg(
            F.sum("checklists").alias("checklists")), facts.seen, expanded)
    notable = taxa.map_priority(
        listed.where(F.col("english_name").isNotNull()), survey.name_change(),
        survey.priority())
    spans = asked.select("region", F.lit(days.first).alias("first_day"),
                         F.lit(days.last).alias("last_day"))
    sheets = {
        "Species list": listed,
        "Participation": summary,
        "Observers": report.headline_observers(daily, days, dim),
        "Totals": report.headline_totals(whole, dim),
        "Sub-regions": report.headline_subregions(whole, asked),
        "Notable": report.headline_notable(taxa.top_priority_by_region(notable), asked),
        "Media": report.headline_media(tally.media_summary(survey.media_counts(days), asked)),
        "Links": report.media_links(spans, base_url),
        "Publication": report.publication_notes(spans, [event_type]),
        "Rejected regions": regions.unknown_regions(wanted, dim),
    }
    if not days.is_single:
        sheets["Checklists by sub-region"] = report.report_checklists(summary)
        sheets["Species by sub-region"] = report.report_species(summary)
    return sheets


