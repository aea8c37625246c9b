"""Resolve the id references of raw profiles into one nested record for each party in scope.

Long tables in, one row for each value; each is joined to its labels by equality and gathered once by party,
in source order. Everything is keyed by snapshot_id, so many snapshots resolve in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.functions.scalar import UNKNOWN, not_blank, partial_date
from rollkeep.operators.scope import in_scope, scope_diagnostics
from rollkeep.schemas import PARTIAL_DATE

#: Feature labels with a place of their own in a record; others are generic features.
BIRTH, NATIONALITY, CITIZENSHIP, LOCATION = "Birthdate", "Nationality Country", "Citizenship Country", "Location"
PLACE, TITLE, GENDER = "Place of Birth", "Title", "Gender"
SCALARS = (TITLE, PLACE, GENDER)
PARTY = ["snapshot_id", "pos"]


def with_label(rows: DataFrame, labels: DataFrame, kind: str, id_column: str, out: str) -> DataFrame:
    """rows with the label of an id as column out, null if it has none."""
    names = labels.where(F.col("kind") == kind).select("snapshot_id", F.col("id").alias(id_column), F.col("label").alias(out))
    return rows.join(names, ["snapshot_id", id_column], "left")


def in_order(*values: Column, where: Column | None = None, at: str = "at") -> Column:
    """Aggregate: the values of a group in order of the column at, as structs of (at, values); null ones dropped."""
    row = F.struct(F.col(at).alias("at"), *values)
    return F.array_sort(F.collect_list(F.when(where, row) if where is not None else row))


def split_aliases(aliases: Column) -> tuple[Column, Column]:
    """(primary, others) of an array of structs (name, primary, ...): the first flagged one, else the first; the rest by position."""
    flagged = F.array_position(F.transform(aliases, lambda a: a.primary), True)
    place = F.when(flagged > 0, flagged).otherwise(F.lit(1)).cast("int")
    return F.try_element_at(aliases, place), F.filter(aliases, lambda _, i: i != place - 1)


def resolve_names(parties: DataFrame, labels: DataFrame) -> DataFrame:
    """(snapshot_id, pos, primary_name, aliases) of parties with aliases (alias_type_id, primary, full_name, low_quality)."""
    long = parties.select(*PARTY, F.posexplode("aliases").alias("at", "a")).select(*PARTY, "at", "a.*")
    long = with_label(long, labels, "AliasType", "alias_type_id", "type")
    category = F.when(F.col("low_quality"), "WEAK").otherwise("STRONG").alias("category")
    named = long.groupBy(*PARTY).agg(in_order(F.col("full_name").alias("name"), F.col("type"), F.col("primary"), category).alias("all"))
    primary, others = split_aliases(F.col("all"))
    plain = F.transform(others, lambda a: F.struct(a["name"].alias("name"), a["type"].alias("type"), F.lit(False).alias("is_primary"), a["category"].alias("category")))
    return named.select(*PARTY, primary["name"].alias("primary_name"), plain.alias("aliases"))


def resolve_locations(locations: DataFrame, labels: DataFrame) -> DataFrame:
    """(snapshot_id, location_id, country, joined, parts): country label, parts joined by ", ", and a map of part label (or id) to value.

    A part without a type is not in the map; of equal keys the last wins.
    """
    long = locations.select("snapshot_id", "location_id", F.posexplode("parts").alias("at", "p")).select("snapshot_id", "location_id", "at", "p.*")
    long = with_label(long, labels, "LocPartType", "loc_part_type_id", "part").withColumn("part", F.coalesce("part", "loc_part_type_id"))
    parts = long.groupBy("snapshot_id", "location_id").agg(in_order(F.col("part"), F.col("value")).alias("all"))
    keyed = F.filter("all", lambda x: x.part.isNotNull())
    last = F.filter(keyed, lambda x: ~F.exists(keyed, lambda y: (y.part == x.part) & (y["at"] > x["at"])))
    parts = parts.select("snapshot_id", "location_id", F.array_join(F.transform("all", lambda x: x.value), ", ").alias("joined"), F.map_from_entries(F.transform(last, lambda x: F.struct(x.part, x.value))).alias("parts"))
    out = with_label(locations.drop("parts"), labels, "Country", "country_id", "country").join(parts, ["snapshot_id", "location_id"], "left")
    return out.select("snapshot_id", "location_id", "country", F.coalesce("joined", F.lit("")).alias("joined"), F.coalesce("parts", F.create_map().cast("map<string,string>")).alias("parts"), F.lit(True).alias("found"))


def scalar_value(inline: Column, detail_label: Column) -> Column:
    return F.coalesce(not_blank(inline), detail_label)


def country_value(inline: Column, country: Column, joined: Column) -> Column:
    """Inline text, else the location's country, else its joined parts, else null."""
    return F.coalesce(not_blank(inline), not_blank(country), not_blank(joined))


def address_value(inline: Column, location_id: Column, country: Column, joined: Column, parts: Column) -> Column:
    """struct(raw, country, parts), or null where there is nothing to tell; raw is inline text without a location, else joined parts, else the country."""
    raw = F.when(location_id.isNull(), not_blank(inline)).otherwise(F.coalesce(not_blank(joined), not_blank(country)))
    empty = F.create_map().cast("map<string,string>")
    return F.when(raw.isNotNull(), F.struct(raw.alias("raw"), F.when(location_id.isNotNull(), country).alias("country"), F.coalesce(F.when(location_id.isNotNull(), parts), empty).alias("parts")))


def resolve_features(parties: DataFrame, labels: DataFrame, locations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feature values by party, and diagnostics of features that could not be told."""
    long = parties.select(*PARTY, "fixed_ref", F.posexplode("features").alias("at", "f")).select(*PARTY, "fixed_ref", "at", "f.*")
    routed, diagnostics = routed_features(long, labels, locations)
    return nested_features(routed), diagnostics


def routed_features(long: DataFrame, labels: DataFrame, locations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features, one row each with its place `at` in the party, with their route (by label) and values; and diagnostics."""
    long = with_label(long, labels, "FeatureType", "feature_type_id", "label")
    long = with_label(long, labels, "DetailReference", "detail_reference_id", "detail_label")
    long = long.join(resolve_locations(locations, labels), ["snapshot_id", "location_id"], "left")
    label = F.col("label")
    country = label.isin(NATIONALITY, CITIZENSHIP)
    special = label.isin(BIRTH, NATIONALITY, CITIZENSHIP, LOCATION, *SCALARS)
    long = long.withColumns({
        "route": F.when(special, label).otherwise("generic"),
        "scalar": scalar_value(F.col("detail_value"), F.col("detail_label")),
        "nation": country_value(F.col("detail_value"), F.col("country"), F.col("joined")),
        "address": address_value(F.col("detail_value"), F.col("location_id"), F.col("country"), F.col("joined"), F.col("parts")),
        "birth": partial_date(F.col("start"), F.col("end")),
        "type": F.coalesce(label, "feature_type_id", F.lit(UNKNOWN)),
    })
    lost_place = F.col("location_id").isNotNull() & F.col("found").isNull()
    scalar_route = F.col("route").isin("generic", *SCALARS)
    reason = (
        F.when((F.col("route") == LOCATION) & lost_place, F.concat(F.lit("UNRESOLVED_REF|location "), "location_id"))
        .when((F.col("route") == LOCATION) & F.col("address").isNull(), "EMPTY_ADDRESS|no text, parts or country")
        .when(country & not_blank(F.col("detail_value")).isNull() & lost_place, F.concat(F.lit("UNRESOLVED_REF|location "), "location_id"))
        .when(country & F.col("nation").isNull() & F.col("location_id").isNotNull(), F.concat(F.lit("UNRESOLVED_REF|empty location "), "location_id"))
        .when((F.col("route") == "generic") & F.col("scalar").isNull() & F.col("detail_reference_id").isNotNull(), F.concat(F.lit("UNRESOLVED_REF|detail reference "), "detail_reference_id"))
        .when(scalar_route & (F.col("route") != "generic") & F.col("scalar").isNull() & F.col("detail_reference_id").isNotNull(), F.concat(F.lit("DROPPED_VALUE|"), "type", F.lit(" with detail reference "), "detail_reference_id"))
        .when((F.col("route") == BIRTH) & F.col("birth").isNull(), "DROPPED_VALUE|birth date without a year")
    )
    diagnostics = long.withColumn("reason", reason).where("reason is not null").select("snapshot_id", "fixed_ref", F.substring_index("reason", "|", 1).alias("kind"), F.expr("substring(reason, locate('|', reason) + 1)").alias("detail"))
    return long, diagnostics


def nested_features(long: DataFrame) -> DataFrame:
    """Routed features gathered by party: of title, place of birth and gender the first value is promoted and later ones become features."""
    is_ = lambda r: F.col("route") == r
    scalar_route = F.col("route").isin("generic", *SCALARS)
    lost_place = F.col("location_id").isNotNull() & F.col("found").isNull()
    gathered = long.groupBy(*PARTY).agg(
        in_order(F.col("birth"), where=is_(BIRTH) & F.col("birth").isNotNull()).alias("births"),
        in_order(F.col("nation"), where=is_(NATIONALITY) & F.col("nation").isNotNull()).alias("nationalities"),
        in_order(F.col("nation"), where=is_(CITIZENSHIP) & F.col("nation").isNotNull()).alias("citizenships"),
        in_order(F.col("type"), F.col("scalar"), where=scalar_route & F.col("scalar").isNotNull()).alias("scalars"),
        # maps have no order: the place alone sorts addresses
        F.collect_list(F.when(is_(LOCATION) & F.col("address").isNotNull() & ~lost_place, F.struct("at", "address"))).alias("addresses"),
    )
    by_place = F.array_sort("addresses", lambda x, y: F.signum(x["at"] - y["at"]).cast("int"))

    def first_named(name: str) -> Column:
        return F.try_element_at(F.filter("scalars", lambda x: x.type == name), F.lit(1))

    first = {s: first_named(s) for s in SCALARS}
    later = F.filter("scalars", lambda x: ~x.type.isin(*SCALARS) | ~F.array_contains(F.array(*[F.coalesce(first[s]["at"], F.lit(-1)) for s in SCALARS]), x["at"]))
    return gathered.select(
        *PARTY,
        F.transform("births", lambda x: x.birth).alias("birth_dates"),
        F.transform("nationalities", lambda x: x.nation).alias("nationalities"),
        F.transform("citizenships", lambda x: x.nation).alias("citizenships"),
        F.transform(by_place, lambda x: x.address).alias("addresses"),
        first[TITLE].scalar.alias("title"),
        first[PLACE].scalar.alias("place_of_birth"),
        first[GENDER].scalar.alias("gender"),
        F.transform(later, lambda x: F.struct(x.type.alias("type"), x.scalar.alias("value"))).alias("features"),
    )


def resolve_documents(parties: DataFrame, documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents by party, joined on the identity; a type without a label becomes Unknown and is reported."""
    rows = with_label(documents.where("identity_id is not null"), labels, "IDRegDocType", "type_id", "label")
    rows = rows.withColumnRenamed("pos", "at").join(parties.select(*PARTY, "fixed_ref", "identity_id"), ["snapshot_id", "identity_id"])
    gathered = rows.groupBy(*PARTY).agg(in_order(F.coalesce("label", F.lit(UNKNOWN)).alias("type"), F.col("number"), F.col("issuer")).alias("all"))
    out = gathered.select(*PARTY, F.transform("all", lambda x: F.struct(x.type.alias("type"), x.number.alias("number"), x.issuer.alias("issuer"))).alias("documents"))
    diagnostics = rows.where("label is null").select("snapshot_id", "fixed_ref", F.lit("UNRESOLVED_REF").alias("kind"), F.concat(F.lit("document type "), F.coalesce("type_id", F.lit("<missing>"))).alias("detail"))
    return out, diagnostics


def resolve_programs(parties: DataFrame, entries: DataFrame, labels: DataFrame) -> DataFrame:
    """(snapshot_id, pos, sanction_programs): distinct programs in order of first sight; else the first list with a label; else empty."""
    rows = with_label(entries, labels, "List", "list_id", "list").withColumnRenamed("pos", "at")
    rows = rows.join(parties.select(*PARTY, "profile_id"), ["snapshot_id", "profile_id"])
    gathered = rows.groupBy(*PARTY).agg(in_order(F.col("programs"), F.col("list")).alias("all"))
    return gathered.select(*PARTY, programs_of(F.transform("all", lambda x: x.programs), F.transform("all", lambda x: x["list"])).alias("sanction_programs"))


def programs_of(programs: Column, lists: Column) -> Column:
    """Distinct programs of arrays of arrays, first seen first; else the first list name that is not null, as a one-element array; else empty."""
    distinct = F.array_distinct(F.flatten(F.filter(programs, lambda p: p.isNotNull())))
    names = F.filter(lists, lambda x: x.isNotNull())
    return F.when(F.size(distinct) > 0, distinct).otherwise(F.slice(names, 1, 1))


def resolve_relationships(parties: DataFrame, everyone: DataFrame, relationships: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Relationships by party, with the other party's fixed_ref; everyone also holds parties out of scope.

    A target that does not exist is reported and dropped; a type without a label is reported and becomes Unknown.
    """
    targets = everyone.where("profile_id is not null").groupBy("snapshot_id", F.col("profile_id").alias("to_profile_id")).agg(F.max_by("fixed_ref", "pos").alias("to_fixed_ref"))
    rows = with_label(relationships, labels, "RelationType", "relation_type_id", "label").withColumnRenamed("pos", "at")
    rows = rows.join(parties.select(*PARTY, "fixed_ref", F.col("profile_id").alias("from_profile_id")), ["snapshot_id", "from_profile_id"])
    rows = rows.join(targets, ["snapshot_id", "to_profile_id"], "left")
    gathered = rows.where("to_fixed_ref is not null").groupBy(*PARTY).agg(in_order(F.col("to_fixed_ref"), F.coalesce("label", F.lit(UNKNOWN)).alias("relation_type")).alias("all"))
    out = gathered.select(*PARTY, F.transform("all", lambda x: F.struct(x.to_fixed_ref.alias("to_fixed_ref"), x.relation_type.alias("relation_type"))).alias("relationships"))
    said = F.when(F.col("to_fixed_ref").isNull(), F.concat(F.lit("target profile "), F.coalesce("to_profile_id", F.lit("<missing>")))).when(F.col("label").isNull(), F.concat(F.lit("relation type "), F.coalesce("relation_type_id", F.lit("<missing>"))))
    diagnostics = rows.withColumn("detail", said).where("detail is not null").select("snapshot_id", "fixed_ref", F.lit("UNRESOLVED_REF").alias("kind"), "detail")
    return out, diagnostics


def reject_reason(fixed_ref: Column, n_names: Column, n_programs: Column) -> Column:
    """Why a record cannot be built: the first of these that applies, else null."""
    return F.when(not_blank(fixed_ref).isNull(), "BLANK_FIXED_REF").when(F.coalesce(n_names, F.lit(0)) == 0, "NO_NAME").when(F.coalesce(n_programs, F.lit(0)) == 0, "NO_PROGRAM")


def first_failure(records: DataFrame, by: str = "snapshot_id") -> DataFrame:
    """One row for each snapshot: status BUILT, or FAILED with the first unbuildable record in source order."""
    bad = F.struct("fixed_ref", "reject_reason")
    out = records.groupBy(by).agg(F.min_by(F.when(F.col("reject_reason").isNotNull(), bad), F.when(F.col("reject_reason").isNotNull(), F.col("pos"))).alias("bad"))
    return out.select(by, F.when(F.col("bad").isNull(), "BUILT").otherwise("FAILED").alias("status"), F.col("bad.fixed_ref").alias("fixed_ref"), F.col("bad.reject_reason").alias("reject_reason"))


def mapping_errors(records: DataFrame) -> DataFrame:
    """(snapshot_id, field, fixed_ref, detail) of records that cannot be built."""
    field = F.when(F.col("reject_reason") == "BLANK_FIXED_REF", "fixed_ref").when(F.col("reject_reason") == "NO_NAME", "primary_name").otherwise("sanction_programs")
    return records.where("reject_reason is not null").select("snapshot_id", field.alias("field"), "fixed_ref", F.col("reject_reason").alias("detail"))


def resolve(sections: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(records with pos and reject_reason, diagnostics) of the sections that rollkeep.sources.xml.read_sections gives."""
    everyone, labels = sections["profiles"], sections["labels"]
    parties = in_scope(everyone)
    features, said = resolve_features(parties, labels, sections["locations"])
    documents, said2 = resolve_documents(parties, sections["documents"], labels)
    related, said3 = resolve_relationships(parties, everyone, sections["relationships"], labels)
    out = parties.drop("aliases", "features")
    for part in (resolve_names(parties, labels), features, documents, resolve_programs(parties, sections["entries"], labels), related):
        out = out.join(part, PARTY, "left")
    empty = {
        "aliases": "array<struct<name:string,type:string,is_primary:boolean,category:string>>",
        "addresses": "array<struct<raw:string,country:string,parts:map<string,string>>>",
        "documents": "array<struct<type:string,number:string,issuer:string>>",
        "nationalities": "array<string>",
        "citizenships": "array<string>",
        "birth_dates": f"array<{PARTIAL_DATE}>",
        "sanction_programs": "array<string>",
        "relationships": "array<struct<to_fixed_ref:string,relation_type:string>>",
        "features": "array<struct<type:string,value:string>>",
    }
    full = {c: F.coalesce(F.col(c), F.array().cast(kind)) for c, kind in empty.items()}
    out = out.withColumns(full | {"remarks": F.array().cast("array<string>")})
    out = out.withColumn("reject_reason", reject_reason(F.col("fixed_ref"), F.when(F.col("primary_name").isNotNull(), 1), F.size("sanction_programs")))
    return out, scope_diagnostics(everyone).unionByName(said).unionByName(said2).unionByName(said3)
