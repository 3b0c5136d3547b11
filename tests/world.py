"""A small made-up survey, in Python lists, for brute-force checks.

A third of all checklists fall on one observer and place; some places are known
only down to a state; one country is silent; one species is not in the taxonomy.
"""

from __future__ import annotations

import random
from datetime import date, timedelta

from fieldtally import schemas
from fieldtally.operators.calendar import EventDays
from fieldtally.operators.literal import literal_frame
from fieldtally.sources.facts import FactSurvey

DAYS = EventDays.span("2024-02-16", "2024-02-19")
PLACES = ["IN-KL-A", "IN-KL-B", "IN-GA-A", "IN-GA", "BT-1-X", "BT-2-Y", "BT-2"]
HOT_PLACE, HOT_OBSERVER = "IN-KL-A", 1
SPECIES = ["crow", "myna", "owl", "kite", "wren", "mystery"]
DISTRICTS = {"IN-KL-A": "Alpha", "IN-KL-B": "Beta", "IN-GA-A": "Gamma", "BT-1-X": "Xi",
             "BT-2-Y": "Psi", "NP-1-Z": "Zeta"}
STATES = {"IN-KL": "Kerala", "IN-GA": "Goa", "BT-1": "One", "BT-2": "Two", "NP-1": "East"}
COUNTRIES = {"IN": "India", "BT": "Bhutan", "NP": "Nepal"}
NAMES = {**COUNTRIES, **STATES, **DISTRICTS}
GROUP = [("IN-KL", "India"), ("IN-GA", "India"), ("BT", "Bhutan"), ("NP", "Nepal")]
TAXONOMY = {"crow": 3.0, "myna": 1.0, "owl": 2.0, "kite": 5.0, "wren": 4.0}
# The wren has two former names, of different classes; the myna's has no class.
NAME_CHANGE = [("old wren", "wren"), ("ancient wren", "wren"), ("old myna", "myna")]
PRIORITY = [("old wren", "Low", "Yes"), ("ancient wren", "High", "No"), ("owl", "High", "Yes"),
            ("myna", "High", "Yes"), ("kite", "Moderate", None)]


def make(seed: int, size: int = 400):
    """Checklists, sightings and media as lists of tuples in schema order."""
    rng = random.Random(seed)
    checklists, sightings, media = [], [], []
    every_day = [d for year in (0, 365) for d in
                 (DAYS.first - timedelta(year) + timedelta(n) for n in range(-1, 5))]
    for number in range(size):
        hot = number % 3 == 0
        place = HOT_PLACE if hot else rng.choice(PLACES)
        observer = HOT_OBSERVER if hot else rng.randint(2, 30)
        day = rng.choice(every_day)
        if place.startswith("BT-1") and day == DAYS.days[1]:
            day = DAYS.first
        checklists.append((number, observer, day, place))
        for _ in range(rng.randint(0, 4)):
            species = rng.choice(SPECIES[:3] if hot else SPECIES)
            sightings.append((number, day, place, species, species in ("owl", "wren")))
        if rng.random() < 0.3:
            media.append((day, place, rng.choice(["photo", "audio", "video", "other"])))
    return checklists, sightings, media


def survey_of(spark, checklists, sightings, media) -> FactSurvey:
    codes = [(d[:2], COUNTRIES[d[:2]], d[:-2], STATES[d[:-2]], d, n) for d, n in DISTRICTS.items()]
    dims = {
        "region_codes": literal_frame(spark, codes, schemas.REGION_CODES),
        "country_group": literal_frame(spark, GROUP, schemas.COUNTRY_GROUP),
        "taxonomy": literal_frame(spark, TAXONOMY.items(), schemas.TAXONOMY),
        "name_change": literal_frame(spark, NAME_CHANGE, schemas.NAME_CHANGE),
        "priority": literal_frame(spark, PRIORITY, schemas.PRIORITY),
    }
    from fieldtally.operators.regions import unstack_codes
    dims["region_dim"] = unstack_codes(dims["region_codes"])
    return FactSurvey(spark, spark.createDataFrame(checklists, schemas.CHECKLISTS),
                      spark.createDataFrame(sightings, schemas.SIGHTINGS),
                      spark.createDataFrame(media, schemas.MEDIA), dims)


def above(place: str) -> list[str]:
    parts = place.split("-")
    return ["-".join(parts[:n]) for n in range(1, len(parts) + 1)]


def in_event(row_day: date) -> bool:
    return row_day in DAYS.days
