"""Source mappings: how the files of a publisher become the sections that everything downstream shares.

A mapping reads a file into profiles, labels, locations, documents, entries, relationships and the date of issue, with
fixed columns; resolution, gates, versions and searches then work on any source alike.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollkeep import schemas
from rollkeep.functions.scalar import not_blank
from rollkeep.sources import xml
from rollkeep.sources.files import read_csv

#: The columns that every mapping must give, by section; more may follow.
CONTRACT = {
    "profiles": schemas.RAW_PROFILE,
    "labels": schemas.REF_LABEL.replace("pos long, ", ""),
    "locations": schemas.LOCATION.replace("pos long, ", ""),
    "documents": schemas.DOCUMENT,
    "entries": schemas.ENTRY,
    "relationships": schemas.RELATIONSHIP,
    "issued": "snapshot_id string, year int, month int, day int",
}


class Mapping(NamedTuple):
    """read gives the sections of a file, and what is wrong with it or None; sep is a byte that files hold often, where their raw bytes may be cut."""

    read: Callable[[SparkSession, str], tuple[dict[str, DataFrame], str | None]]
    sep: str = ">"


def contract_errors(sections: dict[str, DataFrame]) -> list[str]:
    """What the sections of a mapping lack: sections, columns, or types; empty if they keep the contract."""
    out = []
    for name, schema in CONTRACT.items():
        if name not in sections:
            out.append(f"no section {name}")
            continue
        have = {f.name: f.dataType.simpleString() for f in sections[name].schema}
        wanted = StructType.fromDDL(schema)
        out += [f"{name}.{f.name}: {have.get(f.name, 'missing')}, not {f.dataType.simpleString()}" for f in wanted if have.get(f.name) != f.dataType.simpleString()]
    return out


def check_sections(sections: dict[str, DataFrame]) -> dict[str, DataFrame]:
    if errors := contract_errors(sections):
        raise ValueError("; ".join(errors))
    return sections


def _read_xml(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], str | None]:
    parsed, files = xml.read_parsed(spark, path)
    wrong = set(xml.faults(parsed, files).values()) if files else {"MALFORMED"}
    return xml.sections_of(parsed), None if not wrong else "RECORDS_LOST" if wrong == {"LOST"} else "MALFORMED_XML"


XML_MAPPING = Mapping(_read_xml)

#: The delimited file's party kinds by sub-type id; a party without a kind is an entity.
CSV_KINDS = {"individual": "4", "vessel": "1", "aircraft": "2"}


def csv_sections(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sections of delimited party files: one name, title and program list a party; no reference tables but labels of what the file itself names."""
    rows = read_csv(spark, path).select(F.input_file_name().alias("snapshot_id"), F.monotonically_increasing_id().alias("pos"), "*").where("ent_num is not null")
    kind = F.lit("3")
    for name, code in CSV_KINDS.items():
        kind = F.when(F.lower("sdn_type") == name, code).otherwise(kind)
    name = F.struct(F.lit(None).cast("string").alias("alias_type_id"), F.lit(True).alias("primary"), F.col("sdn_name").alias("full_name"), F.lit(False).alias("low_quality"))
    none = F.lit(None).cast("string")
    date = F.lit(None).cast(schemas.DATE)
    title = F.struct(F.lit("title").alias("feature_id"), F.lit("title").alias("feature_type_id"), F.col("title").alias("detail_value"), date.alias("start"), date.alias("end"), none.alias("location_id"), none.alias("detail_reference_id"))
    profiles = rows.select("snapshot_id", "pos", F.col("ent_num").alias("fixed_ref"), F.col("ent_num").alias("profile_id"), F.col("ent_num").alias("identity_id"), kind.alias("party_sub_type_id"), F.filter(F.array(name), lambda a: not_blank(a.full_name).isNotNull()).alias("aliases"), F.filter(F.array(title), lambda f: f.detail_value.isNotNull()).alias("features"))
    programs = F.filter(F.transform(F.split(F.coalesce("program", F.lit("")), r"\]?\s*\["), lambda p: F.trim(F.regexp_replace(p, r"[\[\]]", ""))), lambda p: p != "")
    entries = rows.select("snapshot_id", "pos", F.col("ent_num").alias("id"), F.col("ent_num").alias("profile_id"), none.alias("list_id"), programs.alias("programs"))
    labels = rows.select("snapshot_id", F.lit("FeatureType").alias("kind"), F.lit("title").alias("id"), F.lit("Title").alias("label")).distinct()
    empty = {s: spark.createDataFrame([], CONTRACT[s]) for s in ("locations", "documents", "relationships", "issued")}
    return {"profiles": profiles, "labels": labels, "entries": entries, **empty}


CSV_MAPPING = Mapping(lambda spark, path: (csv_sections(spark, path), None), "\n")
