"""The same results in standard SQL over the raw tables, for checking the registry.

Written against the tables rather than against our operators: counts come from
COUNT(DISTINCT ..) over the joined rows, grids from generated series.
"""

from __future__ import annotations

TABLES = """
WITH state_of AS (
  SELECT n_nationkey, n_name AS state, r_name AS country,
         'R' || r_regionkey AS country_code,
         'R' || r_regionkey || '-N' || n_nationkey AS state_code
  FROM nation JOIN region ON n_regionkey = r_regionkey),
observer AS (
  SELECT c_custkey, country_code, country, state_code, state,
         state_code || '-' || replace(replace(c_mktsegment, '_', '_u'), '-', '_d') AS county_code, c_mktsegment AS county
  FROM customer JOIN state_of ON c_nationkey = n_nationkey),
codes AS (
  SELECT DISTINCT country_code, country, state_code, state, county_code, county FROM observer),
dim AS (
  SELECT country_code AS code, country AS name, 0 AS level FROM codes
  UNION SELECT state_code, state, 1 FROM codes
  UNION SELECT county_code, county, 2 FROM codes),
chk AS (
  SELECT o_orderkey AS checklist_id, o_custkey AS observer_id,
         CAST(o_orderdate AS DATE) AS obs_date, country_code, state_code, county_code
  FROM orders JOIN observer ON o_custkey = c_custkey),
chk3 AS (
  SELECT checklist_id, observer_id, obs_date, country_code AS region FROM chk
  UNION ALL SELECT checklist_id, observer_id, obs_date, state_code FROM chk
  UNION ALL SELECT checklist_id, observer_id, obs_date, county_code FROM chk),
sight AS (
  SELECT chk.*, p_name AS species, p_size <= 5 AS notable
  FROM chk JOIN lineitem ON l_orderkey = checklist_id JOIN part ON p_partkey = l_partkey),
sight3 AS (
  SELECT checklist_id, obs_date, species, notable, country_code AS region FROM sight
  UNION ALL SELECT checklist_id, obs_date, species, notable, state_code FROM sight
  UNION ALL SELECT checklist_id, obs_date, species, notable, county_code FROM sight),
taxonomy AS (
  SELECT p_name AS english_name, CAST(min(p_partkey) AS DOUBLE) AS sort FROM part GROUP BY p_name),
named AS (
  SELECT english_name, split_part(english_name, ' ', 1) AS look,
         split_part(english_name, ' ', 2) AS kind FROM taxonomy),
name_change AS (
  SELECT 'former ' || kind AS old_name, english_name AS new_name FROM named WHERE look = 'new'),
priority AS (
  SELECT CASE WHEN look = 'new' THEN 'former ' || kind ELSE english_name END AS old_name,
         CASE WHEN kind IN ('ring', 'bolt') THEN 'High' WHEN kind IN ('gear', 'plate')
              THEN 'Moderate' WHEN kind = 'widget' THEN 'Low' END AS priority_status,
         CASE WHEN look IN ('red', 'blue') THEN 'Yes' ELSE 'No' END AS endemic
  FROM named WHERE kind IN ('ring', 'bolt', 'gear', 'plate', 'widget')),
status AS (
  SELECT t.english_name, t.sort, p.priority_status, p.endemic
  FROM taxonomy t LEFT JOIN name_change c ON t.english_name = c.new_name
  LEFT JOIN priority p ON p.old_name = coalesce(c.old_name, t.english_name)),
grp AS (
  SELECT DISTINCT CASE WHEN country_code = 'R4' THEN country_code ELSE state_code END AS region,
         country AS region_name FROM codes),
record_days AS (
  SELECT CAST(unnest(generate_series(min(obs_date), max(obs_date), INTERVAL 1 DAY)) AS DATE)
         AS obs_date FROM chk),
uploads AS (
  SELECT event_type, country_code, state_code, county_code
  FROM events JOIN observer ON user_id = c_custkey),
uploads3 AS (
  SELECT event_type, country_code AS region FROM uploads
  UNION ALL SELECT event_type, state_code FROM uploads
  UNION ALL SELECT event_type, county_code FROM uploads)
"""

_EVENT_DAYS = ["1996-09-16", "1996-09-17", "1996-09-18", "1996-09-19"]
_LEAP_DAYS = [f"1996-02-{n:02d}" for n in range(1, 30)]
_EVENT = "obs_date BETWEEN DATE '1996-09-16' AND DATE '1996-09-19'"
_EVENT_BEFORE = "obs_date BETWEEN DATE '1995-09-16' AND DATE '1995-09-19'"
_YEAR = "obs_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
_LEAP_MONTH = "obs_date BETWEEN DATE '1996-02-01' AND DATE '1996-02-29'"
_EARLIER_EVENT = "obs_date BETWEEN DATE '1995-02-24' AND DATE '1995-03-01'"
_ONE_DAY = "obs_date = DATE '1996-09-17'"
_YEAR_BEFORE = "obs_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'"


def _daily_counts(days: str) -> str:
    """Counts of every region on every day of a one-column table of days."""
    return f"""
, cells AS (SELECT code AS region, level, name, obs_date FROM dim CROSS JOIN {days})
, people AS (SELECT region, obs_date, count(DISTINCT observer_id) AS observers,
                    count(DISTINCT checklist_id) AS checklists FROM chk3 GROUP BY 1, 2)
, kinds AS (SELECT region, obs_date, count(DISTINCT species) AS species FROM sight3 GROUP BY 1, 2)
, daily AS (SELECT c.region, c.level, c.name AS region_name, c.obs_date,
                   coalesce(observers, 0) AS observers, coalesce(checklists, 0) AS checklists,
                   coalesce(species, 0) AS species
            FROM cells c LEFT JOIN people p ON c.region = p.region AND c.obs_date = p.obs_date
            LEFT JOIN kinds k ON c.region = k.region AND c.obs_date = k.obs_date)"""


def _day_table(days: list[str]) -> str:
    return "(SELECT * FROM (VALUES " + ", ".join(f"(DATE '{d}')" for d in days) + ") v(obs_date))"


def _matrix(days: list[str]) -> str:
    """One row per region and metric, one column per day, and the all-days total."""
    def metric(label: str, column: str, total: str) -> str:
        by_day = ", ".join(
            f"CAST(sum(CASE WHEN obs_date = DATE '{d}' THEN {column} END) AS BIGINT) AS day{n}"
            for n, d in enumerate(days, 1))
        return (f"SELECT region, region_name, '{label}' AS total, {by_day}, "
                f"CAST({total} AS BIGINT) AS all_days FROM daily GROUP BY region, region_name")

    listed = ", ".join(f"DATE '{d}'" for d in days)
    all_species = (f"(SELECT count(DISTINCT species) FROM sight3 WHERE sight3.region = daily.region"
                   f" AND sight3.obs_date IN ({listed}))")
    return (_daily_counts(_day_table(days)) + ", matrix AS ("
            + metric("OBSERVERS", "observers", "NULL") + " UNION ALL "
            + metric("CHECKLISTS", "checklists", "sum(checklists)") + " UNION ALL "
            + metric("SPECIES", "species", all_species) + ")")


def _day_list(days: list[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}day{n}" for n in range(1, len(days) + 1))


def _report(total: str) -> str:
    return (TABLES + _matrix(_EVENT_DAYS) + "SELECT regexp_replace(region, '-[^-]*$', '') AS parent,"
            f" region, region_name, {_day_list(_EVENT_DAYS)}, all_days FROM matrix"
            f" WHERE total = '{total}' AND region LIKE '%-%'")


_STATES = """
, people_s AS (SELECT state_code AS region, count(DISTINCT observer_id) AS observers,
                      count(DISTINCT checklist_id) AS checklists FROM chk {where} GROUP BY 1)
, kinds_s AS (SELECT state_code AS region, count(DISTINCT species) AS species FROM sight {where}
              GROUP BY 1)
, states AS (SELECT code AS region, name AS region_name, coalesce(checklists, 0) AS checklists,
                    coalesce(species, 0) AS species, coalesce(observers, 0) AS observers
             FROM dim LEFT JOIN people_s p ON code = p.region LEFT JOIN kinds_s k ON code = k.region
             WHERE level = 1)
, coverage AS (
  SELECT country AS region_name, count(DISTINCT CASE WHEN observers > 0 THEN region END) AS regions,
         count(DISTINCT region) AS tot_regions
  FROM states JOIN (SELECT DISTINCT state_code, country FROM codes) c ON region = state_code
  GROUP BY 1)
, covered AS (SELECT *, round(100.0 * regions / tot_regions, 6) AS region_cov FROM coverage
              WHERE regions > 0)
, countries AS (
  SELECT n.region_name, coalesce(checklists, 0) AS checklists, coalesce(species, 0) AS species,
         regions, tot_regions, region_cov
  FROM (SELECT DISTINCT region_name FROM grp) n
  LEFT JOIN (SELECT region_name, count(*) AS checklists FROM chk3 JOIN grp USING (region) {where}
             GROUP BY 1) a ON a.region_name = n.region_name
  LEFT JOIN (SELECT region_name, count(DISTINCT species) AS species
             FROM sight3 JOIN grp USING (region) {where} GROUP BY 1) b
    ON b.region_name = n.region_name
  LEFT JOIN covered c ON c.region_name = n.region_name)
"""


def _states(condition: str | None = None, suffix: str = "") -> str:
    text = _STATES.replace("{where}", f"WHERE {condition}" if condition else "")
    if suffix:
        for name in ("people_s", "kinds_s", "states", "coverage", "covered", "countries"):
            text = text.replace(f", {name} AS", f", {name}{suffix} AS")
            text = text.replace(f"FROM {name}", f"FROM {name}{suffix}")
            text = text.replace(f"JOIN {name} ", f"JOIN {name}{suffix} ")
    return text


def _change(metric: str) -> str:
    return (f"round(100.0 * (CAST(a.{metric} AS DOUBLE) - b.{metric}) / nullif(b.{metric}, 0), 6)"
            f" AS {metric}")


def _change_by_country(now: str, before: str) -> str:
    return (TABLES + _states(now, "_now") + _states(before, "_before")
            + "SELECT a.region_name, " + ", ".join(map(_change, ("checklists", "species", "regions")))
            + " FROM countries_now a JOIN countries_before b ON a.region_name = b.region_name")


def _overall(countries: str, condition: str = "TRUE") -> str:
    return (f"SELECT CAST(sum(checklists) AS BIGINT) AS checklists, "
            f"CAST(CASE WHEN count(regions) = count(*) THEN sum(regions) END AS BIGINT) AS regions, "
            f"(SELECT count(DISTINCT species) FROM sight WHERE {condition}) AS species "
            f"FROM {countries}")


def _final_workbook(now: str, before: str) -> str:
    change = ", ".join(map(_change, ("checklists", "species", "regions")))
    return (TABLES + _states(now, "_now") + _states(before, "_before")
            + ", total_now AS (" + _overall("countries_now", now) + "), total_before AS ("
            + _overall("countries_before", before) + f""")
SELECT 'States' AS sheet, * FROM states_now
UNION ALL BY NAME SELECT 'Countries' AS sheet, * FROM countries_now
UNION ALL BY NAME SELECT 'Countries YoY' AS sheet, a.region_name, {change}
  FROM countries_now a JOIN countries_before b ON a.region_name = b.region_name
UNION ALL BY NAME SELECT 'Overall' AS sheet, * FROM total_now
UNION ALL BY NAME SELECT 'Overall YoY' AS sheet, {change} FROM total_now a CROSS JOIN total_before b
UNION ALL BY NAME SELECT DISTINCT 'Species list' AS sheet, english_name, sort
  FROM sight JOIN taxonomy ON english_name = species WHERE {now}""")


def _on_one_day(places: str) -> str:
    """Figures and species lists of some places on one day."""
    return f"""
, places AS ({places})
, day3 AS (SELECT * FROM sight3 WHERE {_ONE_DAY})
, figures AS (
  SELECT region, region_name, coalesce(observers, 0) AS observers,
         coalesce(checklists, 0) AS checklists, coalesce(species, 0) AS species
  FROM places
  LEFT JOIN (SELECT region, count(DISTINCT observer_id) AS observers,
                    count(DISTINCT checklist_id) AS checklists FROM chk3 WHERE {_ONE_DAY}
             GROUP BY 1) USING (region)
  LEFT JOIN (SELECT region, count(DISTINCT species) AS species FROM day3 GROUP BY 1) USING (region))
, listed AS (
  SELECT region, region_name, species AS english_name, sort FROM places
  LEFT JOIN (SELECT DISTINCT region, species FROM day3) USING (region)
  LEFT JOIN taxonomy ON english_name = species)
"""


_MEDIA = """
SELECT code AS region, count(CASE WHEN event_type = 'view' THEN 1 END) AS photo,
       count(CASE WHEN event_type = 'click' THEN 1 END) AS audio,
       count(CASE WHEN event_type = 'purchase' THEN 1 END) AS video
FROM dim LEFT JOIN uploads3 ON code = region GROUP BY code
"""

_WHOLE = """
, whole AS (
  SELECT code AS region, name AS region_name, level, coalesce(observers, 0) AS observers,
         coalesce(checklists, 0) AS checklists, coalesce(species, 0) AS species
  FROM dim
  LEFT JOIN (SELECT region, count(DISTINCT observer_id) AS observers,
                    count(DISTINCT checklist_id) AS checklists FROM chk3 GROUP BY 1) p
    ON code = p.region
  LEFT JOIN (SELECT region, count(DISTINCT species) AS species FROM sight3 GROUP BY 1) k
    ON code = k.region)
"""

_LISTS = """
, lists AS (SELECT DISTINCT region, species AS english_name FROM sight3)
, mapped AS (SELECT l.region, l.english_name, s.sort, s.priority_status, s.endemic
             FROM lists l JOIN status s ON l.english_name = s.english_name)
"""

_SPANS = """
, spans AS (SELECT region, min(obs_date) AS first_day, max(obs_date) AS last_day
            FROM chk3 GROUP BY region)
"""

_COMBINED = ("SELECT DISTINCT species AS english_name, sort FROM sight"
             " JOIN taxonomy ON english_name = species")


def _spec_list_tables() -> str:
    """Species by region and event day as flags, in a table `matrix_of_species`."""
    flags = ", ".join(f"CAST(max(CASE WHEN obs_date = DATE '{d}' THEN 1 ELSE 0 END) AS BIGINT)"
                      f" AS day{n}" for n, d in enumerate(_EVENT_DAYS, 1))
    empty = ", ".join(
        f"CAST(CASE WHEN EXISTS (SELECT 1 FROM sight3 s WHERE s.region = dim.code AND"
        f" s.obs_date = DATE '{d}') THEN 0 ELSE 1 END AS BIGINT) AS day{n}"
        for n, d in enumerate(_EVENT_DAYS, 1))
    some = " + ".join(f"day{n}" for n in range(1, len(_EVENT_DAYS) + 1))
    return (f", seen AS (SELECT region, species, {flags} FROM sight3 WHERE {_EVENT}"
            f" GROUP BY 1, 2), nothing AS (SELECT code AS region, CAST(NULL AS VARCHAR) AS species,"
            f" {empty} FROM dim), both_kinds AS (SELECT * FROM seen UNION ALL"
            f" SELECT * FROM nothing WHERE {some} > 0), matrix_of_species AS ("
            f" SELECT region, name AS region_name, species AS english_name, sort,"
            f" {_day_list(_EVENT_DAYS)} FROM both_kinds JOIN dim ON code = region"
            f" LEFT JOIN taxonomy ON english_name = species)")


def _report_sheets_event() -> str:
    """All sheets of the report on the event's four days for R0 and R1-N6; ZZ is unknown."""
    days = _day_list(_EVENT_DAYS)
    return TABLES + _matrix(_EVENT_DAYS) + _spec_list_tables() + f"""
, places AS (
  SELECT DISTINCT d.code AS region FROM dim u JOIN dim d
    ON d.code = u.code OR starts_with(d.code, u.code || '-')
  WHERE u.code IN ('R0', 'R1-N6') AND NOT (u.level = 0 AND d.level = 2))
, listed AS (SELECT * FROM matrix_of_species WHERE region IN (FROM places))
, mine AS (SELECT * FROM matrix WHERE region IN (FROM places))
, here AS (SELECT * FROM daily WHERE region IN (FROM places))
, figures AS (SELECT region, region_name, count(*) AS no_days, min(observers) AS min_observers,
                     max(observers) AS max_observers FROM here GROUP BY 1, 2)
, peaks AS (SELECT f.*, min(date_diff('day', DATE '{_EVENT_DAYS[0]}', obs_date)) + 1 AS max_day,
                   count(*) AS days_at_max
            FROM figures f JOIN here d ON d.region = f.region AND d.observers = f.max_observers
            GROUP BY ALL)
, totals AS (SELECT region, region_name, max(all_days) FILTER (total = 'SPECIES') AS species,
                    max(all_days) FILTER (total = 'CHECKLISTS') AS checklists
             FROM mine GROUP BY 1, 2)
, asked AS (SELECT * FROM (VALUES ('R0', 'states/union territories'), ('R1-N6', 'districts'))
            u(region, which_reg))
, ranked AS (SELECT region, l.english_name, row_number() OVER (
               PARTITION BY region ORDER BY endemic DESC, s.sort, l.english_name) AS position
             FROM listed l JOIN status s ON l.english_name = s.english_name
             WHERE priority_status = 'High')
, top AS (SELECT region, count(*) AS no_species, string_agg(english_name, ', ' ORDER BY position)
          AS names FROM ranked WHERE position <= 10 GROUP BY 1)
SELECT 'Species list' AS sheet, * FROM listed
UNION ALL BY NAME SELECT 'Participation' AS sheet, * FROM mine
UNION ALL BY NAME SELECT CASE total WHEN 'SPECIES' THEN 'Species' ELSE 'Checklists' END
  || ' by sub-region' AS sheet, regexp_replace(region, '-[^-]*$', '') AS parent, region, region_name,
  {days}, all_days FROM mine WHERE total <> 'OBSERVERS' AND region LIKE '%-%'
UNION ALL BY NAME SELECT 'Observers' AS sheet, *, '**Everyday, at least '
  || format('{{:,}}', min_observers) || ' birdwatchers** from ' || region_name
  || ' came together for the ' || no_days || ' days (' || format('{{:,}}', max_observers)
  || ' birdwatchers on Day ' || max_day || '!),' AS statement FROM peaks
UNION ALL BY NAME SELECT 'Totals' AS sheet, *,
  '**' || format('{{:,}}', species) || ' species**' AS species_statement,
  '**' || format('{{:,}}', checklists) || ' checklists**' AS checklists_statement FROM totals
UNION ALL BY NAME SELECT 'Sub-regions' AS sheet, *, '**' || no_reg || ' ' || which_reg || '**'
  AS statement FROM (
    SELECT u.region, u.which_reg, count(*) FILTER (t.checklists > 0) AS no_reg
    FROM asked u JOIN totals t ON starts_with(t.region, u.region || '-') GROUP BY 1, 2)
UNION ALL BY NAME SELECT 'Notable' AS sheet, region, coalesce(no_species, 0) AS no_species, names,
  CASE WHEN names IS NULL THEN '' ELSE 'Among the species reported were the following classed'
  || ' as of High Priority in the conservation status report: ' || names || '.' END AS statement
  FROM asked LEFT JOIN top USING (region)
UNION ALL BY NAME SELECT 'Media' AS sheet, region, 0::BIGINT AS photo, 0::BIGINT AS audio,
  0::BIGINT AS video, '**0 photos** and **0 sound recordings**' AS statement FROM asked
UNION ALL BY NAME SELECT 'Links' AS sheet, region,
  'https://catalogue.example/search?mediaType=photo&sort=rating_rank_desc&obsDtFrom={_EVENT_DAYS[0]}'
  || '&obsDtTo={_EVENT_DAYS[-1]}&regionCode=' || region AS link FROM asked
UNION ALL BY NAME SELECT 'Publication' AS sheet, region, 'GBBC' AS event_type,
  'October 1996' AS next_month,
  'the final results will be published at the end of October 1996' AS disclaimer FROM asked
UNION ALL BY NAME SELECT 'Rejected regions' AS sheet, 'ZZ' AS region"""


_BROKEN = ("CASE WHEN region LIKE '%-FURNITURE' THEN 1 WHEN region LIKE '%-MACHINERY' THEN 2"
           " WHEN region LIKE '%-BUILDING' THEN 3 ELSE 0 END")

# What each kind of response tells, and how it is broken: cut off, an error answer, a status.
_RESPONSES = """
, media AS (""" + _MEDIA + f""")
, told AS (
  SELECT 'participation' AS sheet, region, observers, checklists, species AS no_sp FROM whole
  UNION ALL BY NAME SELECT DISTINCT 'species' AS sheet, region, species AS english_name FROM sight3
  UNION ALL BY NAME SELECT 'notable' AS sheet, region, species AS common_name,
    'S' || min(checklist_id) AS checklist_id FROM sight3 WHERE notable GROUP BY region, species
  UNION ALL BY NAME SELECT 'media' AS sheet, * FROM media)
, responses AS (SELECT *, {_BROKEN} AS broken FROM told)
"""


ORACLES: dict[str, str] = {
    "event_calendar": TABLES + """
SELECT CAST(obs_date AS VARCHAR) AS obs_date, dense_rank() OVER (ORDER BY obs_date) AS day_no,
       CAST(CAST(obs_date - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS prev_date,
       strftime(obs_date, '%Y/%m/%d') AS request_date
FROM (SELECT DISTINCT obs_date FROM chk)""",
    "region_expand": TABLES + """
SELECT u.code AS requested, d.code, d.name, CAST(d.level AS BIGINT) AS level
FROM dim u JOIN dim d ON d.code = u.code OR starts_with(d.code, u.code || '-')
WHERE NOT (u.level = 0 AND d.level = 2)""",
    "region_expand_free_match": TABLES + """
SELECT u.pattern AS requested, code, name, CAST(level AS BIGINT) AS level
FROM (SELECT * FROM (VALUES ('R1-N1'), ('N2-H')) v(pattern)) u
JOIN dim ON contains(code, u.pattern)""",
    "region_rejects": TABLES + """
SELECT DISTINCT state_code || '-' || replace(replace(s_name, '_', '_u'), '-', '_d') AS region
FROM supplier JOIN state_of ON s_nationkey = n_nationkey
WHERE state_code || '-' || replace(replace(s_name, '_', '_u'), '-', '_d') NOT IN (SELECT code FROM dim)""",
    "region_names": TABLES + "SELECT code AS region, name AS region_name FROM dim",
    "region_select": TABLES + """
SELECT code, name, CAST(level AS BIGINT) AS level FROM dim
WHERE code IN ('R1', 'R0-N5', 'R2-N2-HOUSEHOLD') OR code LIKE 'R1-%' OR code LIKE 'R0-N5-%'""",
    "region_select_free_match": TABLES + """
SELECT code, name, CAST(level AS BIGINT) AS level FROM dim
WHERE level < 2 AND (code LIKE '%R1-N1%' OR code LIKE '%N2-H%')""",
    "region_meta": TABLES + """
SELECT DISTINCT region, name AS region_name FROM chk3 JOIN dim ON code = region""",
    "participation_by_region_day": TABLES + _daily_counts("record_days") + """
SELECT region, region_name, CAST(obs_date AS VARCHAR) AS obs_date, observers, checklists, species
FROM daily""",
    "species_by_region_day": TABLES + """
SELECT code AS region, name AS region_name, CAST(d.obs_date AS VARCHAR) AS obs_date, species
FROM dim CROSS JOIN record_days d
LEFT JOIN (SELECT DISTINCT region, obs_date, species FROM sight3) s
  ON s.region = code AND s.obs_date = d.obs_date""",
    "notable_sightings": TABLES + """
SELECT DISTINCT region, species AS common_name, checklist_id FROM sight3 WHERE notable""",
    "media_summary": TABLES + _MEDIA,
    "media_summary_dates": TABLES.replace("ON user_id = c_custkey)", """ON user_id = c_custkey
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14')""") + _MEDIA,
    "spec_list_single": TABLES + """
SELECT CAST(d.obs_date AS VARCHAR) AS obs_date, code AS region, name AS region_name,
       species AS english_name, sort
FROM dim CROSS JOIN record_days d
LEFT JOIN (SELECT DISTINCT region, obs_date, species FROM sight3) s
  ON s.region = code AND s.obs_date = d.obs_date
LEFT JOIN taxonomy ON english_name = species""",
    "spec_list_multi": TABLES + _spec_list_tables() + " SELECT * FROM matrix_of_species",
    "part_summ_single": TABLES + _daily_counts("record_days") + """
SELECT CAST(obs_date AS VARCHAR) AS obs_date, region, region_name, observers, checklists, species
FROM daily""",
    "part_summ_multi": TABLES + _matrix(_EVENT_DAYS)
    + f"SELECT region, region_name, total, {_day_list(_EVENT_DAYS)} FROM matrix",
    "part_summ_all_days": TABLES + _matrix(_EVENT_DAYS) + "SELECT * FROM matrix",
    "part_summ_leap_month": TABLES + _matrix(_LEAP_DAYS) + "SELECT * FROM matrix",
    "part_summ_no_list": TABLES + _matrix(_EVENT_DAYS)
    + f"SELECT region, region_name, total, {_day_list(_EVENT_DAYS)}, CASE WHEN total ="
      " 'CHECKLISTS' THEN all_days END AS all_days FROM matrix",
    "map_priority": TABLES + _LISTS + "SELECT * FROM mapped",
    "notable_priority_top10": TABLES + """
SELECT s.* FROM status s WHERE priority_status = 'High'
  AND s.english_name IN (SELECT species FROM sight)
ORDER BY endemic DESC, sort, s.english_name LIMIT 10""",
    "species_per_region": TABLES + """
SELECT code AS region, count(DISTINCT species) AS no_sp
FROM dim LEFT JOIN sight3 ON region = code GROUP BY code""",
    "species_per_region_na": TABLES + """
SELECT code AS region, count(DISTINCT species) + CASE WHEN count(DISTINCT obs_date) <
       (SELECT count(*) FROM record_days) THEN 1 ELSE 0 END AS no_sp
FROM dim LEFT JOIN sight3 ON region = code GROUP BY code""",
    "combined_species": TABLES + _COMBINED,
    "notable_rarity": TABLES + """
SELECT species AS common_name, count(DISTINCT checklist_id) AS no_lists,
       count(DISTINCT state_code) AS no_regions, min(state_code) AS region
FROM sight WHERE notable GROUP BY species""",
    "overall_species_files": TABLES + _COMBINED,
    "lists_of_any_header": TABLES + _COMBINED,
    "dimension_files": TABLES + """
SELECT 'regions' AS sheet, code, CASE WHEN code <> 'R1' THEN name || ', "' || code || '"' END AS name,
       CAST(level AS BIGINT) AS level FROM dim
UNION ALL BY NAME SELECT 'codes' AS sheet, * FROM codes
UNION ALL BY NAME SELECT 'status' AS sheet, old_name || ', "so called"' AS old_name,
  CASE WHEN priority_status <> 'Low' THEN priority_status END AS priority_status, endemic FROM priority
UNION ALL BY NAME SELECT 'changes' AS sheet, old_name || ', "so called"' AS old_name, new_name
  FROM name_change""",
    "dimension_problems": TABLES + """
, crowded AS (SELECT old_name, 'new ' || split_part(old_name, ' ', 2) AS new_name FROM name_change
              UNION ALL SELECT old_name, 'any ' || old_name FROM priority)
SELECT 'region_codes' AS dimension, state_code AS key, 'several regions share the code' AS problem
FROM codes GROUP BY state_code HAVING count(DISTINCT county) > 1
UNION SELECT 'priority', old_name, 'unknown class' FROM priority
UNION SELECT 'name_change', new_name, 'several former names' FROM crowded GROUP BY new_name
HAVING count(DISTINCT old_name) > 1
UNION SELECT 'name_change', new_name, 'not in the taxonomy' FROM crowded
WHERE new_name NOT IN (SELECT english_name FROM taxonomy)""",
    "participation_states": TABLES + _states()
    + "SELECT region, region_name, checklists, species, observers FROM states",
    "participation_countries": TABLES + _states() + "SELECT * FROM countries",
    "country_species": TABLES + """
SELECT region_name, count(DISTINCT species) AS species
FROM grp LEFT JOIN sight3 USING (region)
WHERE region_name IN (SELECT region_name FROM grp GROUP BY 1 HAVING count(*) > 1) GROUP BY 1""",
    "region_coverage": TABLES + _states() + "SELECT * FROM covered",
    "region_coverage_event": TABLES + _states(_EVENT) + "SELECT * FROM covered",
    "overall_totals": TABLES + _states() + _overall("countries"),
    "yoy_countries": _change_by_country(_YEAR, _YEAR_BEFORE),
    "yoy_countries_event": _change_by_country(_EVENT, _EVENT_BEFORE),
    "yoy_countries_dates": _change_by_country(_LEAP_MONTH, _EARLIER_EVENT),
    "yoy_overall": TABLES + _states(_YEAR, "_now") + _states(_YEAR_BEFORE, "_before")
    + ", total_now AS (" + _overall("countries_now", _YEAR) + "), total_before AS ("
    + _overall("countries_before", _YEAR_BEFORE) + ") SELECT "
    + ", ".join(map(_change, ("checklists", "species", "regions")))
    + " FROM total_now a CROSS JOIN total_before b",
    "headline_observers": TABLES + _daily_counts("record_days") + """
, figures AS (SELECT region, region_name, count(*) AS no_days, min(observers) AS min_observers,
                     max(observers) AS max_observers FROM daily GROUP BY 1, 2)
, peaks AS (SELECT f.*, min(date_diff('day', (SELECT min(obs_date) FROM chk), obs_date)) + 1
                   AS max_day, count(*) AS days_at_max
            FROM figures f JOIN daily d ON d.region = f.region AND d.observers = f.max_observers
            GROUP BY ALL)
SELECT *, CASE WHEN no_days = 1
       THEN '**' || format('{:,}', max_observers) || ' birdwatchers** from ' || region_name
            || ' came together'
       ELSE '**Everyday, at least ' || format('{:,}', min_observers) || ' birdwatchers** from '
            || region_name || ' came together for the ' || no_days || ' days ('
            || format('{:,}', max_observers) || ' birdwatchers on Day ' || max_day || '!),' END
       AS statement FROM peaks""",
    "headline_observers_ties": TABLES + _daily_counts("record_days") + """
SELECT d.region, date_diff('day', (SELECT min(obs_date) FROM chk), d.obs_date) + 1 AS day_no,
       d.observers
FROM daily d JOIN (SELECT region, max(observers) AS observers FROM daily GROUP BY 1) m
  ON m.region = d.region AND m.observers = d.observers""",
    "headline_totals": TABLES + _WHOLE + """
SELECT region, region_name, species, checklists,
       '**' || format('{:,}', species) || ' species**' AS species_statement,
       '**' || format('{:,}', checklists) || ' checklists**' AS checklists_statement FROM whole""",
    "headline_subregions": TABLES + _WHOLE + """
, children AS (
  SELECT u.code AS region,
         count(*) FILTER (observers > 0 OR checklists > 0 OR species > 0) AS no_reg,
         CASE u.level WHEN 0 THEN 'states/union territories' WHEN 1 THEN 'districts'
              ELSE 'UNKNOWN REGION' END AS which_reg
  FROM dim u LEFT JOIN whole w ON starts_with(w.region, u.code || '-') AND w.level = u.level + 1
  GROUP BY u.code, u.level)
SELECT *, '**' || no_reg || ' ' || which_reg || '**' AS statement FROM children""",
    "headline_media": TABLES + ", m AS (" + _MEDIA + """)
SELECT *, '**' || format('{:,}', photo) || ' photos** and **' || format('{:,}', audio)
       || ' sound recordings**' AS statement FROM m""",
    "headline_notable": TABLES + _LISTS + """
, ranked AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY endemic DESC, sort,
                    english_name) AS position FROM mapped WHERE priority_status = 'High')
, joined AS (SELECT region, count(*) AS no_species,
                    string_agg(english_name, ', ' ORDER BY position) AS names
             FROM ranked WHERE position <= 10 GROUP BY region)
SELECT code AS region, coalesce(no_species, 0) AS no_species, names,
       CASE WHEN names IS NULL THEN '' ELSE 'Among the species reported were the following classed'
       || ' as of High Priority in the conservation status report: ' || names || '.' END
       AS statement FROM dim LEFT JOIN joined ON region = code""",
    "media_link": TABLES + _SPANS + """
SELECT region, 'https://catalogue.example/search?mediaType=photo&sort=rating_rank_desc&obsDtFrom='
       || first_day || '&obsDtTo=' || last_day || '&regionCode=' || region AS link FROM spans""",
    "publication_note": TABLES + _SPANS + """
, kinds AS (SELECT * FROM (VALUES ('GBBC'), ('OTHER')) v(event_type))
, notes AS (SELECT region, event_type, strftime(last_day + INTERVAL 1 MONTH, '%B %Y') AS next_month
            FROM spans CROSS JOIN kinds)
SELECT *, CASE WHEN event_type = 'GBBC'
       THEN 'the final results will be published at the end of ' || next_month
       ELSE 'the final numbers may vary' END AS disclaimer FROM notes""",
    "report_checklists": _report("CHECKLISTS"),
    "report_species": _report("SPECIES"),
    "payload_participation": TABLES + _daily_counts("record_days") + """
SELECT region, CAST(obs_date AS VARCHAR) AS obs_date, observers, checklists, species
FROM daily WHERE checklists > 0""",
    "payload_species": TABLES + """
SELECT DISTINCT region, CAST(obs_date AS VARCHAR) AS obs_date, species FROM sight3""",
    "payload_notable": TABLES + """
SELECT DISTINCT county_code AS region, species AS common_name, 'S' || checklist_id AS checklist_id
FROM sight WHERE notable""",
    "payload_media": TABLES + """
SELECT county_code AS region, count(CASE WHEN event_type = 'view' THEN 1 END) AS photo,
       count(CASE WHEN event_type = 'click' THEN 1 END) AS audio,
       count(CASE WHEN event_type = 'purchase' THEN 1 END) AS video
FROM uploads WHERE event_type IN ('view', 'click', 'purchase') GROUP BY county_code""",
    "payload_files": TABLES + _WHOLE + _RESPONSES
    + "SELECT * EXCLUDE (broken) FROM responses WHERE broken = 0",
    "payload_rejects": TABLES + _WHOLE + _RESPONSES + """
SELECT DISTINCT sheet AS batch, region, CASE WHEN broken = 3 THEN 'status'
       WHEN broken = 1 THEN 'malformed' WHEN sheet IN ('species', 'notable') THEN 'no list'
       ELSE 'figures missing' END AS reason FROM responses WHERE broken > 0""",
    "payload_props": TABLES + """
, props_of AS (SELECT event_type, CAST(regexp_extract(props, '^\\{"k": ([0-9]+)\\}$', 1) AS BIGINT)
               AS k FROM events)
SELECT event_type, count(*) AS responses, count(k) AS with_k, CAST(sum(k) AS BIGINT) AS sum_k
FROM props_of GROUP BY event_type""",
    "csv_file": TABLES + _COMBINED,
    "decimal_comma_file": TABLES + "SELECT english_name, sort + 0.5 AS sort FROM taxonomy",
    "semicolon_file": TABLES + _states() + "SELECT * FROM covered",
    "workbook_files": TABLES + _states() + """
SELECT 'States' AS sheet, * FROM states
UNION ALL BY NAME SELECT 'Countries' AS sheet, * FROM countries""",
    "final_workbook": _final_workbook(_LEAP_MONTH, _EARLIER_EVENT),
    "live_sheets": TABLES + _states(_ONE_DAY) + _on_one_day("""
SELECT code AS region, name AS region_name FROM dim WHERE code IN ('R1', 'R0-N5',
'R2-N2-HOUSEHOLD') OR code LIKE 'R1-%' OR code LIKE 'R0-N5-%'""") + """
SELECT 'States' AS sheet, * FROM figures
UNION ALL BY NAME SELECT 'Countries' AS sheet, region_name, checklists, species FROM countries
UNION ALL BY NAME SELECT 'Species per region' AS sheet, region, species AS no_sp FROM figures
UNION ALL BY NAME SELECT DISTINCT 'Species list' AS sheet, english_name, sort FROM listed
  WHERE english_name IS NOT NULL
UNION ALL BY NAME SELECT 'Notable species' AS sheet, species AS common_name,
  count(DISTINCT checklist_id) AS no_lists, count(DISTINCT region) AS no_regions,
  min(region) AS region FROM day3 JOIN places USING (region) WHERE notable GROUP BY species""",
    "report_sheets_one_day": TABLES + _on_one_day("""
SELECT DISTINCT d.code AS region, d.name AS region_name
FROM dim u JOIN dim d ON d.code = u.code OR starts_with(d.code, u.code || '-')
WHERE u.code IN ('R0', 'R1-N6') AND NOT (u.level = 0 AND d.level = 2)""") + """
SELECT 'Species list' AS sheet, * FROM listed
UNION ALL BY NAME SELECT 'Participation' AS sheet, * FROM figures
UNION ALL BY NAME SELECT 'Observers' AS sheet, region, region_name, 1::BIGINT AS no_days,
  observers AS min_observers, observers AS max_observers, 1::BIGINT AS max_day,
  1::BIGINT AS days_at_max, '**' || format('{:,}', observers) || ' birdwatchers** from '
  || region_name || ' came together' AS statement FROM figures
UNION ALL BY NAME SELECT 'Totals' AS sheet, region, region_name, species, checklists,
  '**' || format('{:,}', species) || ' species**' AS species_statement,
  '**' || format('{:,}', checklists) || ' checklists**' AS checklists_statement FROM figures
UNION ALL BY NAME SELECT 'Sub-regions' AS sheet, *, '**' || no_reg || ' ' || which_reg || '**'
  AS statement FROM (
    SELECT u.region, u.which_reg, count(*) FILTER (f.checklists > 0) AS no_reg
    FROM (VALUES ('R0', 'states/union territories'), ('R1-N6', 'districts')) u(region, which_reg)
    JOIN figures f ON starts_with(f.region, u.region || '-') GROUP BY 1, 2)
UNION ALL BY NAME SELECT 'Rejected regions' AS sheet, 'ZZ' AS region""",
    "report_sheets_event": _report_sheets_event(),
    "event_from_stored_days": TABLES + _WHOLE.replace(
        "FROM chk3 GROUP", f"FROM chk3 WHERE {_EVENT} GROUP").replace(
        "FROM sight3 GROUP", f"FROM sight3 WHERE {_EVENT} GROUP")
    + "SELECT region, region_name, observers, checklists, species FROM whole",
    "distinct_so_far": TABLES + f"""
SELECT code AS region, name AS region_name, CAST(until AS VARCHAR) AS obs_date,
       (SELECT count(DISTINCT observer_id) FROM chk3
        WHERE region = code AND {_EVENT} AND obs_date <= until) AS observers,
       (SELECT count(DISTINCT species) FROM sight3
        WHERE region = code AND {_EVENT} AND obs_date <= until) AS species
FROM dim, (SELECT CAST(unnest({_EVENT_DAYS}) AS DATE) AS until)""",
    "distinct_by_period": TABLES + """,
periods AS (
  SELECT obs_date, unnest([strftime(obs_date, '%Y-%m'), strftime(obs_date, '%Y'), 'all']) AS period
  FROM (SELECT DISTINCT obs_date FROM chk)),
observed AS (
  SELECT region, period, count(DISTINCT observer_id) AS observers
  FROM chk3 JOIN periods USING (obs_date) GROUP BY region, period),
listed AS (
  SELECT region, period, count(DISTINCT species) AS species
  FROM sight3 JOIN periods USING (obs_date) GROUP BY region, period)
SELECT region, period, coalesce(observers, 0) AS observers, coalesce(species, 0) AS species
FROM observed FULL JOIN listed USING (region, period)""",
}
