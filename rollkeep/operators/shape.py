"""Records as the response shape of an API, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Response fields by record field.
FIELDS = {
    "fixed_ref": "fixedRef",
    "entity_type": "entityType",
    "primary_name": "primaryName",
    "aliases": "aliases",
    "addresses": "addresses",
    "documents": "documents",
    "nationalities": "nationalities",
    "citizenships": "citizenships",
    "birth_dates": "birthDates",
    "sanction_programs": "sanctionPrograms",
    "relationships": "relationships",
    "title": "title",
    "place_of_birth": "placeOfBirth",
    "gender": "gender",
    "remarks": "remarks",
    "features": "features",
}


def api_record(columns: list[str]) -> Column:
    """A struct of the given record columns under their response names."""
    return F.struct(*[F.col(c).alias(FIELDS[c]) for c in FIELDS if c in columns])


def api_page(records: DataFrame, total: int, offset: int, limit: int) -> DataFrame:
    """One JSON text a record, with the total and the echoed page bounds."""
    return records.select(F.to_json(api_record(records.columns)).alias("record"), F.lit(total).alias("total"), F.lit(offset).alias("offset"), F.lit(limit).alias("limit"))
