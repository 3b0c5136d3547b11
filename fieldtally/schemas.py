"""Fixed schemas of the logical tables and of the landed service responses."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_text, _whole, _real, _day = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()

# Facts: one row per checklist, one per species entry of a checklist, one per
# upload. `place` is the finest region code known for a checklist: codes are
# hierarchical, so every coarser region is a prefix of it.
CHECKLISTS = _schema(checklist_id=_whole, observer_id=_whole, obs_date=_day, place=_text)
SIGHTINGS = _schema(checklist_id=_whole, obs_date=_day, place=_text, species=_text,
                    is_notable=T.BooleanType())
MEDIA = _schema(obs_date=_day, place=_text, media_type=_text)

# Dimensions.
REGION_LIST = _schema(code=_text, name=_text)
REGION_CODES = _schema(country_code=_text, country=_text, state_code=_text, state=_text,
                       county_code=_text, county=_text)
COUNTRY_GROUP = _schema(region=_text, region_name=_text)
TAXONOMY = _schema(english_name=_text, sort=_real)
NAME_CHANGE = _schema(old_name=_text, new_name=_text)
PRIORITY = _schema(old_name=_text, priority_status=_text, endemic=_text)
SPECIES_LIST = _schema(english_name=_text)

# Keys of the service responses.
PARTICIPATION_RESPONSE = _schema(numContributors=_whole, numChecklists=_whole, numSpecies=_whole)
SPECIES_RESPONSE = T.ArrayType(_schema(comName=_text))
NOTABLE_RESPONSE = T.ArrayType(_schema(comName=_text, subId=_text))
MEDIA_RESPONSE = _schema(photo=_whole, audio=_whole, video=_whole)
