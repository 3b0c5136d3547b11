"""Every operator as a query over the tables of one folder.

Queries run over the whole record of checklists. Only those whose result has one
column per day are about an event of four days, and those that compare years
about a year and the one before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally import schemas
from fieldtally.functions.columns import (
    COUNTRY, DISTRICT, QUOTING, STATE, decimal_comma, slashed_date)
from fieldtally.operators import calendar, distinct, event, regions, report, rollup, tally, taxa
from fieldtally.operators.calendar import EventDays
from fieldtally.plans import jobs
from fieldtally.plans.catalogue import dimension_problems as dimension_problems_of
from fieldtally.plans.catalogue import keep_dimensions
from fieldtally.plans.jobs import ReducedFacts, reduce_facts
from fieldtally.plans.prepare import open_facts, prepare_facts
from fieldtally.plans.states import (
    kept_numbers, open_sets, open_states, over_days, store_days, store_sets)
from fieldtally.session import shared_folder
from fieldtally.sinks import files as sink
from fieldtally.sources import files as source
from fieldtally.sources import payloads
from fieldtally.sources.facts import FactSurvey
from fieldtally.sources.star import StarSurvey, district_code

EVENT = EventDays.span("1996-09-16", "1996-09-19")
LEAP_MONTH = EventDays.span("1996-02-01", "1996-02-29")
EARLIER_EVENT = EventDays.span("1995-02-24", "1995-03-01")
ONE_DAY = EventDays.of("1996-09-17")
YEAR = EventDays.span("1996-01-01", "1996-12-31")
MEDIA_DAYS = EventDays.span("2024-01-05", "2024-01-14")
PATTERNS = ("R1", "R0-N5", "R2-N2-HOUSEHOLD")
FREE_PATTERNS = ("R1-N1", "N2-H")
REQUESTED = ("R0", "R1-N6", "ZZ")
REPORTED = ("Species list", "Participation", "Observers", "Totals", "Sub-regions",
            "Rejected regions")
CATALOGUE = "https://catalogue.example/search"
EVENT_TYPES = ("GBBC", "OTHER")
PERIOD = ("period",)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _comparable(frame: DataFrame) -> DataFrame:
    """Types that any engine prints alike: ISO dates, 64-bit integers, rounded doubles."""
    changed = {}
    for field in frame.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            changed[field.name] = column.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            changed[field.name] = column.cast("bigint")
        elif isinstance(field.dataType, T.DoubleType):
            changed[field.name] = F.round(column, 6)
    return frame.withColumns(changed) if changed else frame


def _query(build: Callable[[StarSurvey], DataFrame]) -> Callable[[StarSurvey], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(build(StarSurvey(spark, sf_dir.rstrip("/"))))

    QUERIES[build.__name__] = run
    return build


def _regions(survey: StarSurvey, *levels: int) -> DataFrame:
    dim = survey.region_dim()
    return regions.as_regions(dim, levels) if levels else regions.as_regions(dim)


def _named(seen: DataFrame) -> DataFrame:
    return seen.withColumnRenamed("species", "english_name")


# Calendar and regions ---------------------------------------------------------

@_query
def event_calendar(s: StarSurvey) -> DataFrame:
    return calendar.event_calendar(s.dates()).withColumn(
        "request_date", slashed_date(F.col("obs_date")))


@_query
def region_expand(s: StarSurvey) -> DataFrame:
    return regions.expand_regions(_regions(s), s.region_dim())


@_query
def region_expand_free_match(s: StarSurvey) -> DataFrame:
    return regions.expand_matching(FREE_PATTERNS, s.region_dim())


@_query
def region_rejects(s: StarSurvey) -> DataFrame:
    """Suppliers' states and a district of their own in each, which no list knows."""
    places = s.table("supplier").join(
        s.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    state = F.concat(F.lit("R"), "n_regionkey", F.lit("-N"), "n_nationkey")
    asked = places.select(F.explode(F.array(
        state, F.concat(state, F.lit("-"), district_code(F.col("s_name"))))).alias("region"))
    return regions.unknown_regions(asked, s.region_dim())


@_query
def region_names(s: StarSurvey) -> DataFrame:
    return regions.region_names(_regions(s), s.region_dim())


@_query
def region_select(s: StarSurvey) -> DataFrame:
    return regions.select_regions(s.region_codes(), PATTERNS)


@_query
def region_select_free_match(s: StarSurvey) -> DataFrame:
    return regions.select_regions(s.region_codes(), FREE_PATTERNS, districts=False,
                                  free_match=True)


@_query
def region_meta(s: StarSurvey) -> DataFrame:
    places = s.checklists().select("place").distinct()
    return regions.region_meta(tally.at_regions(places).distinct(), s.region_codes())


# Tallies ----------------------------------------------------------------------

@_query
def participation_by_region_day(s: StarSurvey) -> DataFrame:
    return tally.participation_by_region_day(
        s.visits(), s.sightings(), _regions(s), calendar.record_span(s.dates()))


@_query
def species_by_region_day(s: StarSurvey) -> DataFrame:
    return tally.species_by_region_day(
        s.sightings(), _regions(s), calendar.record_span(s.dates()))


@_query
def notable_sightings(s: StarSurvey) -> DataFrame:
    return tally.notable_sightings(s.notable())


@_query
def media_summary(s: StarSurvey) -> DataFrame:
    return tally.media_summary(s.media_counts(), _regions(s))


@_query
def media_summary_dates(s: StarSurvey) -> DataFrame:
    """Media that were uploaded on some days."""
    return tally.media_summary(s.media_counts(MEDIA_DAYS), _regions(s))


# Event summaries --------------------------------------------------------------

@_query
def spec_list_single(s: StarSurvey) -> DataFrame:
    return event.species_list_by_day(
        s.sightings(), _regions(s), calendar.record_span(s.dates()), s.region_dim(),
        s.taxonomy())


@_query
def spec_list_multi(s: StarSurvey) -> DataFrame:
    keep_dimensions(s, "taxonomy", "region_dim")
    seen = reduce_facts(s, EVENT, tally.BY_DAY).seen
    return event.species_list(seen, _regions(s), EVENT, s.region_dim(), s.taxonomy())


@_query
def part_summ_single(s: StarSurvey) -> DataFrame:
    return event.participation_by_day(
        s.visits(), s.sightings(), _regions(s), calendar.record_span(s.dates()), s.region_dim())


def _daily(s: StarSurvey, days: EventDays) -> DataFrame:
    return tally.participation_by_region_day(
        s.visits(days=days), s.sightings(days), _regions(s), days)


@_query
def part_summ_multi(s: StarSurvey) -> DataFrame:
    return event.participation_matrix(_daily(s, EVENT), EVENT, s.region_dim())


def _summary(s: StarSurvey, days: EventDays) -> DataFrame:
    facts = reduce_facts(s, days, tally.BY_DAY)
    listed = _named(tally.species_by_region(facts.seen, _regions(s)))
    return event.participation_summary(
        facts.visits, facts.seen, _regions(s), days, s.region_dim(), listed)


@_query
def part_summ_all_days(s: StarSurvey) -> DataFrame:
    return _summary(s, EVENT)


@_query
def part_summ_leap_month(s: StarSurvey) -> DataFrame:
    return _summary(s, LEAP_MONTH)


@_query
def part_summ_no_list(s: StarSurvey) -> DataFrame:
    return event.with_all_days(
        event.participation_matrix(_daily(s, EVENT), EVENT, s.region_dim()))


# Species ----------------------------------------------------------------------

def _lists(s: StarSurvey) -> DataFrame:
    """Species lists of all regions over the whole record, with taxonomic order."""
    seen = _named(tally.species_seen(s.sightings(), ()))
    return event.with_taxonomy(seen, s.taxonomy())


@_query
def map_priority(s: StarSurvey) -> DataFrame:
    keep_dimensions(s, "taxonomy")
    return taxa.map_priority(_lists(s), s.name_change(), s.priority())


@_query
def notable_priority_top10(s: StarSurvey) -> DataFrame:
    keep_dimensions(s, "taxonomy")
    every = taxa.combined_species(_named(s.sightings()), s.taxonomy())
    return taxa.top_priority(taxa.map_priority(every, s.name_change(), s.priority()))


@_query
def species_per_region(s: StarSurvey) -> DataFrame:
    return tally.species_per_region(tally.species_by_region(s.sightings(), _regions(s)))


@_query
def species_per_region_na(s: StarSurvey) -> DataFrame:
    """The same with the missing species of a silent day counted as one."""
    listed = tally.species_by_region_day(
        s.sightings(), _regions(s), calendar.record_span(s.dates()))
    return tally.species_per_region(listed, null_as_value=True)


@_query
def combined_species(s: StarSurvey) -> DataFrame:
    return taxa.combined_species(_named(s.sightings()), s.taxonomy())


@_query
def notable_rarity(s: StarSurvey) -> DataFrame:
    return taxa.notable_rarity(tally.notable_sightings(s.notable(), (STATE,)))


@_query
def overall_species_files(s: StarSurvey) -> DataFrame:
    """One list per country is written, then all are found by name and combined."""
    folder = shared_folder(s.spark, "lists")
    seen = _named(tally.species_seen(s.sightings(), (), (COUNTRY,)))
    files = seen.select("english_name", F.concat("region", F.lit("_SpeciesList.csv")).alias("list"))
    files.write.partitionBy("list").options(header=True, **QUOTING).csv(folder)
    lists = source.read_species_lists(s.spark, folder, "list=*SpeciesList.csv")
    return taxa.combined_species(lists, s.taxonomy())


@_query
def lists_of_any_header(s: StarSurvey) -> DataFrame:
    """Lists whose columns stand in another order, or among others, are combined all the same."""
    folder = shared_folder(s.spark, "lists")
    listed = event.with_taxonomy(_named(tally.species_seen(s.sightings(), (), (COUNTRY,))), s.taxonomy())
    orders = [("english_name", "sort"), ("sort", "english_name"), ("region", "sort", "english_name")]
    for code in range(5):
        of_country = listed.where(F.col("region") == f"R{code}").select(*orders[code % 3])
        sink.write_csv(of_country, f"{folder}/R{code}, all_SpeciesList.csv")
    lists = source.read_species_lists(s.spark, folder, schema=schemas.TAXONOMY)
    return lists.distinct().orderBy(F.col("sort").asc_nulls_last(), "english_name")


# Roll-ups ---------------------------------------------------------------------

def _states(s: StarSurvey) -> DataFrame:
    return rollup.participation_states(
        s.visits(()), s.sightings(), _regions(s, STATE), s.region_dim())


def _coverage(s: StarSurvey, visits: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    active = rollup.state_activity(visits, _regions(s, STATE), by)
    return rollup.region_coverage(active, s.region_codes(), by)


def _countries(s: StarSurvey, facts: ReducedFacts, by: tuple[str, ...] = ()) -> DataFrame:
    return rollup.participation_countries(
        facts.visits, facts.seen, s.country_group(), _coverage(s, facts.visits, by), by)


@_query
def participation_states(s: StarSurvey) -> DataFrame:
    return _states(s)


@_query
def participation_countries(s: StarSurvey) -> DataFrame:
    return _countries(s, reduce_facts(s, None, ()))


@_query
def country_species(s: StarSurvey) -> DataFrame:
    return rollup.country_species(s.sightings(), s.country_group())


@_query
def region_coverage(s: StarSurvey) -> DataFrame:
    return _coverage(s, s.visits(()))


@_query
def region_coverage_event(s: StarSurvey) -> DataFrame:
    return _coverage(s, s.visits((), EVENT))


@_query
def overall_totals(s: StarSurvey) -> DataFrame:
    facts = reduce_facts(s, None, ())
    return rollup.overall_totals(_countries(s, facts), _named(facts.seen))


@_query
def yoy_countries(s: StarSurvey) -> DataFrame:
    facts = reduce_facts(s, YEAR, PERIOD, two_years=True)
    return rollup.year_over_year(_countries(s, facts, PERIOD), ["region_name"])


@_query
def yoy_countries_event(s: StarSurvey) -> DataFrame:
    facts = reduce_facts(s, EVENT, PERIOD, two_years=True)
    return rollup.year_over_year(_countries(s, facts, PERIOD), ["region_name"])


@_query
def yoy_countries_dates(s: StarSurvey) -> DataFrame:
    """An event against an earlier one on days, and with a length, of its own."""
    facts = reduce_facts(s, LEAP_MONTH, PERIOD, two_years=True, before=EARLIER_EVENT)
    return rollup.year_over_year(_countries(s, facts, PERIOD), ["region_name"])


@_query
def yoy_overall(s: StarSurvey) -> DataFrame:
    facts = reduce_facts(s, YEAR, PERIOD, two_years=True)
    return rollup.year_over_year(
        rollup.overall_totals(_countries(s, facts, PERIOD), _named(facts.seen), PERIOD))


# Report -----------------------------------------------------------------------

def _active_days(s: StarSurvey, span: DataFrame) -> DataFrame:
    return tally.activity_on(calendar.region_days(_regions(s), span), s.visits(), tally.BY_DAY)


@_query
def headline_observers(s: StarSurvey) -> DataFrame:
    span = calendar.record_span(s.dates())
    return report.headline_observers(_active_days(s, span), span, s.region_dim())


@_query
def headline_observers_ties(s: StarSurvey) -> DataFrame:
    span = calendar.record_span(s.dates())
    return report.days_of_most_observers(_active_days(s, span), span)


def _whole(s: StarSurvey) -> DataFrame:
    return tally.participation_by_region(s.visits(()), s.sightings(), _regions(s))


@_query
def headline_totals(s: StarSurvey) -> DataFrame:
    return report.headline_totals(_whole(s), s.region_dim())


@_query
def headline_subregions(s: StarSurvey) -> DataFrame:
    return report.headline_subregions(_whole(s), _regions(s))


@_query
def headline_media(s: StarSurvey) -> DataFrame:
    return report.headline_media(tally.media_summary(s.media_counts(), _regions(s)))


@_query
def headline_notable(s: StarSurvey) -> DataFrame:
    keep_dimensions(s, "taxonomy")
    mapped = taxa.map_priority(_lists(s), s.name_change(), s.priority())
    return report.headline_notable(taxa.top_priority_by_region(mapped), _regions(s))


def _spans(s: StarSurvey) -> DataFrame:
    """First and last day on record of each region."""
    at_place = s.checklists().groupBy("place").agg(
        F.min("obs_date").alias("first_day"), F.max("obs_date").alias("last_day"))
    return tally.at_regions(at_place).groupBy("region").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


@_query
def media_link(s: StarSurvey) -> DataFrame:
    return report.media_links(_spans(s), CATALOGUE)


@_query
def publication_note(s: StarSurvey) -> DataFrame:
    return report.publication_notes(_spans(s), EVENT_TYPES)


@_query
def report_checklists(s: StarSurvey) -> DataFrame:
    return report.report_checklists(_summary(s, EVENT))


@_query
def report_species(s: StarSurvey) -> DataFrame:
    return report.report_species(_summary(s, EVENT))


# Landed responses -------------------------------------------------------------

@_query
def payload_participation(s: StarSurvey) -> DataFrame:
    counts = tally.participation_counts(s.visits()).join(
        tally.species_counts(s.sightings()), ["region", "obs_date"], "left").fillna(0, ["species"])
    responses = counts.select("region", "obs_date", F.to_json(F.struct(
        F.col("observers").alias("numContributors"), F.col("checklists").alias("numChecklists"),
        F.col("species").alias("numSpecies"))).alias("payload"))
    return payloads.parse_participation(responses).rows


@_query
def payload_species(s: StarSurvey) -> DataFrame:
    """One response per region and day: at most one entry per known species."""
    responses = tally.species_seen(s.sightings()).groupBy(
        "region", "obs_date").agg(F.to_json(F.collect_set(F.struct(
            F.col("species").alias("comName")))).alias("payload"))
    return payloads.parse_species(responses).rows


@_query
def payload_notable(s: StarSurvey) -> DataFrame:
    """One response per checklist: at most one entry per known species."""
    flagged = s.notable().groupBy("place", "checklist_id").agg(
        F.collect_set("species").alias("names"))
    entries = F.transform("names", lambda name: F.struct(
        name.alias("comName"), F.concat(F.lit("S"), "checklist_id").alias("subId")))
    responses = flagged.select(F.col("place").alias("region"), F.to_json(entries).alias("payload"))
    return payloads.parse_notable(responses).rows


@_query
def payload_media(s: StarSurvey) -> DataFrame:
    responses = s.media_counts().select(
        F.col("place").alias("region"), F.to_json(F.struct("photo", "audio", "video"))
        .alias("payload"))
    return payloads.parse_media(responses).rows


KINDS = {"participation": payloads.parse_participation, "species": payloads.parse_species,
         "notable": payloads.parse_notable, "media": payloads.parse_media}


def _answers(s: StarSurvey) -> dict[str, DataFrame]:
    """A response of each kind for each region over the whole record."""
    entry = F.struct(F.col("species").alias("comName"),
                     F.concat(F.lit("S"), "checklist_id").alias("subId"))
    first = tally.at_regions(s.notable()).groupBy("region", "species").agg(
        F.min("checklist_id").alias("checklist_id"))
    counts = F.struct(F.col("observers").alias("numContributors"), F.col("checklists").alias(
        "numChecklists"), F.col("species").alias("numSpecies"))
    media = tally.media_summary(s.media_counts(), _regions(s))
    return {
        "participation": _whole(s).select("region", F.to_json(counts).alias("payload")),
        "species": tally.species_seen(s.sightings(), ()).groupBy("region").agg(F.to_json(
            F.collect_set(F.struct(F.col("species").alias("comName")))).alias("payload")),
        "notable": first.groupBy("region").agg(F.to_json(F.collect_set(entry)).alias("payload")),
        "media": media.select("region", F.to_json(F.struct("photo", "audio", "video")).alias("payload"))}


def _landed(s: StarSurvey) -> dict[str, payloads.Parsed]:
    """The responses as files, some over several lines, and in some districts broken ones."""
    folder, parsed = shared_folder(s.spark, "landed"), {}
    region, payload = F.col("region"), F.col("payload")
    told = (F.when(region.endswith("-FURNITURE"), payload.substr(F.lit(1), F.length(payload) - 1))
            .when(region.endswith("-MACHINERY"), F.lit('{"errors": [{"title": "unknown region"}]}'))
            .when(region.endswith("-HOUSEHOLD"), F.replace(payload, F.lit(","), F.lit(",\n ")))
            .otherwise(payload))
    status = F.when(region.endswith("-BUILDING"), 404).otherwise(200)
    for kind, answers in _answers(s).items():
        payloads.land_responses(answers.select("region", status.alias("status"), told.alias("payload")),
                                f"{folder}/{kind}")
        parsed[kind] = KINDS[kind](payloads.read_responses(s.spark, f"{folder}/{kind}"))
    return parsed


@_query
def payload_files(s: StarSurvey) -> DataFrame:
    """What the good ones among landed response files hold, of all four kinds."""
    names = {"participation": {"species": "no_sp"}, "species": {"species": "english_name"}}
    return _stacked({kind: parsed.rows.withColumnsRenamed(names.get(kind, {}))
                     for kind, parsed in _landed(s).items()})


@_query
def payload_rejects(s: StarSurvey) -> DataFrame:
    """The other ones and why, kept by batch and read again."""
    folder = shared_folder(s.spark, "rejects")
    for kind, parsed in _landed(s).items():
        payloads.keep_rejects(parsed.rejects.select("region", "reason"), folder, kind)
    return payloads.read_rejects(s.spark, folder)


@_query
def payload_props(s: StarSurvey) -> DataFrame:
    props = F.from_json("props", "k BIGINT")["k"]
    return s.table("events").select("event_type", props.alias("k")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("responses"), F.count("k").alias("with_k"),
        F.sum("k").alias("sum_k"))


# Files ------------------------------------------------------------------------

def _read_back(spark: SparkSession, sheets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The sheets as a workbook's files give them again, in the types they had."""
    places = sink.write_workbook(sheets, shared_folder(spark, "workbook"))
    read = {}
    for name, frame in sheets.items():
        text = T.StructType([T.StructField(c, T.StringType()) for c in frame.columns])
        raw = spark.read.schema(text).csv(places[name], header=True, nullValue=sink.MISSING, **QUOTING)
        read[name] = raw.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                                 for f in frame.schema])
    return read


def _stacked(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all sheets with the sheet's name; columns that a sheet lacks are missing."""
    named = [frame.withColumn("sheet", F.lit(name)) for name, frame in sheets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


@_query
def dimension_files(s: StarSurvey) -> DataFrame:
    """Region lists and codes, conservation status and name changes, as their files hold them.

    Names have quotes and commas, some are missing, and headers are of other spelling.
    """
    folder = shared_folder(s.spark, "dimensions")
    odd = F.concat("name", F.lit(', "'), "code", F.lit('"'))
    dim = s.region_dim().withColumn("name", F.when(F.col("code") != "R1", odd))
    paths = [f"{folder}/level{level}" for level in (COUNTRY, STATE, DISTRICT)]
    for level, path in zip((COUNTRY, STATE, DISTRICT), paths, strict=True):
        sink.write_csv(dim.where(F.col("level") == level).select("name", "code"), path, missing="")
    capitals = {f.name: f.name.upper().replace("_", ".") for f in schemas.REGION_CODES}
    s.region_codes().withColumnsRenamed(capitals).write.parquet(f"{folder}/codes")
    quoted = F.concat("old_name", F.lit(', "so called"'))
    status = s.priority().select(
        "endemic", quoted.alias("OLD, NAME"), F.lit("x").alias("extra"),
        F.when(F.col("priority_status") != "Low", F.col("priority_status")).alias("STATUS"))
    sink.write_csv(status, f"{folder}/status")
    sink.write_csv(s.name_change().select(F.col("new_name").alias("NEW"), quoted.alias("OLD")),
                   f"{folder}/changes")
    return _stacked({
        "regions": source.read_region_lists(s.spark, *paths),
        "codes": source.read_region_codes(s.spark, f"{folder}/codes", capitals),
        "status": source.read_priority(s.spark, f"{folder}/status", {
            "old_name": "OLD, NAME", "priority_status": "STATUS"}),
        "changes": source.read_name_changes(s.spark, f"{folder}/changes", {
            "old_name": "OLD", "new_name": "NEW"})})


@_query
def dimension_problems(s: StarSurvey) -> DataFrame:
    """What joins would repeat or lose, in dimensions where districts have one code each state
    and species of the same kind one former name."""
    coarse = s.region_codes().withColumn("county_code", F.col("state_code"))
    crowded = s.name_change().withColumn("new_name", F.concat(F.lit("new "), F.split("old_name", " ")[1]))
    changed = StarSurvey(s.spark, s.folder)
    changed.replace("region_codes", coarse)
    changed.replace("name_change", crowded.union(s.priority().select("old_name", F.concat(F.lit("any "), "old_name"))))
    changed.replace("priority", s.priority().withColumn("priority_status", F.lower("priority_status")))
    return dimension_problems_of(changed)


@_query
def csv_file(s: StarSurvey) -> DataFrame:
    path = shared_folder(s.spark, "csv")
    sink.write_csv(taxa.combined_species(_named(s.sightings()), s.taxonomy()), path)
    return source.read_taxonomy(s.spark, path)


@_query
def decimal_comma_file(s: StarSurvey) -> DataFrame:
    path = shared_folder(s.spark, "comma")
    halves = s.taxonomy().withColumn("sort", F.regexp_replace(
        (F.col("sort") + 0.5).cast("string"), r"\.", ","))
    sink.write_csv(halves, path)
    return source.read_taxonomy(s.spark, path, comma_decimals=True)


@_query
def semicolon_file(s: StarSurvey) -> DataFrame:
    path = shared_folder(s.spark, "semicolon")
    sink.write_semicolon_csv(_coverage(s, s.visits(())), path)
    back = s.spark.read.csv(path, sep=";", header=True, **QUOTING)
    return back.select("region_name", *[F.col(c).try_cast("bigint").alias(c)
                                        for c in ("regions", "tot_regions")],
                       decimal_comma(F.col("region_cov")).alias("region_cov"))


@_query
def workbook_files(s: StarSurvey) -> DataFrame:
    facts = reduce_facts(s, None, ())
    states = rollup.participation_states(
        facts.visits, facts.seen, _regions(s, STATE), s.region_dim())
    return _stacked(_read_back(s.spark, {"States": states, "Countries": _countries(s, facts)}))

# Whole jobs over facts by day --------------------------------------------------

def _prepared(s: StarSurvey, *events: EventDays) -> FactSurvey:
    """The facts of these days in the layout that events read."""
    folder = shared_folder(s.spark, "facts")
    for days in events:
        prepare_facts(s, folder, days)
    return open_facts(s.spark, folder)


@_query
def final_workbook(s: StarSurvey) -> DataFrame:
    """All sheets of a final summary against an earlier event, as their files hold them."""
    facts = _prepared(s, LEAP_MONTH, EARLIER_EVENT)
    return _stacked(_read_back(s.spark, jobs.final_summary(facts, LEAP_MONTH, before=EARLIER_EVENT)))


@_query
def live_sheets(s: StarSurvey) -> DataFrame:
    """All sheets of a live summary of one day and picked regions of every level."""
    return _stacked(jobs.live_summary(_prepared(s, ONE_DAY), ONE_DAY, PATTERNS, districts=True))


@_query
def report_sheets_one_day(s: StarSurvey) -> DataFrame:
    """A report on an event of one day, with a region that no list knows."""
    sheets = jobs.event_report(_prepared(s, ONE_DAY), ONE_DAY, REQUESTED, EVENT_TYPES[0], CATALOGUE)
    return _stacked({name: sheets[name] for name in REPORTED})


@_query
def report_sheets_event(s: StarSurvey) -> DataFrame:
    """A report on an event of four days: all its sheets, as their files hold them."""
    return _stacked(_read_back(s.spark, jobs.event_report(
        _prepared(s, EVENT), EVENT, REQUESTED, EVENT_TYPES[0], CATALOGUE)))


@_query
def event_from_stored_days(s: StarSurvey) -> DataFrame:
    """Participation over an event whose days were stored one by one, one of them twice."""
    folder = shared_folder(s.spark, "states")
    store_days(s, folder, EVENT)
    store_days(s, folder, EventDays.of(EVENT.last))
    facts = over_days(open_states(s.spark, folder, EVENT))
    return tally.participation_by_region(facts.visits, facts.seen, _regions(s))


@_query
def distinct_so_far(s: StarSurvey) -> DataFrame:
    """Observers and species of each region up to each day, from sets stored as days came in."""
    folder = shared_folder(s.spark, "states")
    for days in (EventDays.span(EVENT.first, EVENT.days[1]), EventDays.span(EVENT.days[2], EVENT.last),
                 EventDays.of(EVENT.first)):
        store_days(s, folder, days)
        store_sets(s.spark, folder, days)
    found = calendar.region_days(_regions(s), EVENT)
    cells = found.columns
    for column, name in (("observer_id", "observers"), ("species", "species")):
        sets = tally.at_regions(open_sets(s.spark, folder, column, EVENT))
        found = found.join(distinct.sizes_so_far(sets, EVENT.days, ("region",), name),
                           ["region", "obs_date"], "left")
    return found.select(*cells, *(F.coalesce(n, F.lit(0)).alias(n) for n in ("observers", "species")))


@_query
def distinct_by_period(s: StarSurvey) -> DataFrame:
    """Observers and species of each region by month, by year and over the whole record.

    Months are sets of the facts; years are merged from months, the record from years.
    """
    folder = shared_folder(s.spark, "numbers")
    month = F.date_format("obs_date", "yyyy-MM").alias("period")
    facts = reduce_facts(s, None, tally.BY_DAY)
    counts = []
    for rows, column, name in ((facts.visits, "observer_id", "observers"),
                               (facts.seen, "species", "species")):
        numbers = kept_numbers(rows, column, folder)
        sets = distinct.as_sets(rows.select("place", month, column), numbers, column,
                                ("place", "period"))
        months = sink.written(distinct.merged_sets(
            tally.at_regions(sets), ("region", "period")), "months")
        years = sink.written(distinct.merged_sets(months.withColumn(
            "period", F.substring("period", 1, 4)), ("region", "period")), "years")
        whole = years.withColumn("period", F.lit("all"))
        counts.append(distinct.set_sizes(
            months.unionByName(years).unionByName(whole), ("region", "period"), name))
    both = counts[0].join(counts[1], ["region", "period"], "full")
    return both.select("region", "period", *(
        F.coalesce(n, F.lit(0)).alias(n) for n in ("observers", "species")))
