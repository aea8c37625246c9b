"""Schemas of raw sections and normalised tables; every read names its schema."""

from __future__ import annotations

DATE = "struct<year:int,month:int,day:int>"
PARTIAL_DATE = f"struct<year:int,month:int,day:int,period:struct<from:{DATE},to:{DATE}>>"

RAW_PROFILE = (
    "snapshot_id string, pos long, fixed_ref string, profile_id string, identity_id string, party_sub_type_id string,"
    " aliases array<struct<alias_type_id:string,primary:boolean,full_name:string,low_quality:boolean>>,"
    f" features array<struct<feature_id:string,feature_type_id:string,detail_value:string,start:{DATE},end:{DATE},location_id:string,detail_reference_id:string>>"
)
LOCATION = "snapshot_id string, pos long, location_id string, country_id string, parts array<struct<loc_part_type_id:string,value:string>>"
DOCUMENT = "snapshot_id string, pos long, id string, identity_id string, type_id string, number string, issuer string"
ENTRY = "snapshot_id string, pos long, id string, profile_id string, list_id string, programs array<string>"
RELATIONSHIP = "snapshot_id string, pos long, id string, from_profile_id string, to_profile_id string, relation_type_id string"
REF_LABEL = "snapshot_id string, pos long, kind string, id string, label string"

RECORD_FIELDS = (
    "fixed_ref string, entity_type string, primary_name string,"
    " aliases array<struct<name:string,type:string,is_primary:boolean,category:string>>,"
    " addresses array<struct<raw:string,country:string,parts:map<string,string>>>,"
    " documents array<struct<type:string,number:string,issuer:string>>,"
    " nationalities array<string>, citizenships array<string>, remarks array<string>,"
    f" birth_dates array<{PARTIAL_DATE}>, sanction_programs array<string>,"
    " relationships array<struct<to_fixed_ref:string,relation_type:string>>,"
    " title string, place_of_birth string, gender string, features array<struct<type:string,value:string>>"
)
VERSION = (
    "source_list string, publish_date date, digest string, record_count long, out_of_scope_count long, overlap_count long,"
    " expected_count long, persisted_count long, ingested_at timestamp, raw_path string"
)
ACTIVATION = "source_list string, seq long, publish_date date, digest string, activated_at timestamp"
INTEGRITY = "source_list string, publish_date date, digest string, ok boolean, checked_at timestamp"
MANIFEST = "path string, status int, redirects int, content_length long, digest_header string, last_modified string"
RAW = "path string, length long, content binary, source_list string, publish_date date, digest string"
OUTCOME = "source_list string, status string, failed_stage string, cause string, publish_date date, digest string"
DIAGNOSTIC = "snapshot_id string, fixed_ref string, kind string, detail string"


def top_level(schema: str) -> list[str]:
    """The fields of a schema string, split at commas outside brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(schema[start:i].strip())
            start = i + 1
    return out


#: The lists, in order of precedence.
SOURCE_LISTS = ("SDN", "CONSOLIDATED")
#: The reference tables of a snapshot.
LABEL_KINDS = ("FeatureType", "IDRegDocType", "RelationType", "List", "Country", "LocPartType", "AliasType", "DetailReference")
