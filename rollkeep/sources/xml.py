"""Read the sections of XML snapshots, in any order and with any namespace prefix.

A snapshot is read as text split at `>`, in byte ranges that Spark deals over many tasks, twice. The first walk takes a
summary of each range; joined, these tell whether the file is well-formed and in which state each range begins. The
second cuts the elements out, and each is parsed by itself. Elements that go over the end of a range are put together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rollkeep import schemas
from rollkeep.functions.scalar import assemble_name, first_of, last_of, not_blank, whole_number
from rollkeep.sources import tokens
from rollkeep.sources.pieces import lengths, pieces, ranges
from rollkeep.sources.scratch import stored

OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
_YMD = "struct<Year:string,Month:string,Day:string>"
_END = f"struct<From:array<{_YMD}>,To:array<{_YMD}>>"
_ALIAS = "struct<_AliasTypeID:string,_Primary:string,_LowQuality:string,DocumentedName:array<struct<DocumentedNamePart:array<struct<NamePartValue:array<string>>>>>>"
_VERSION = f"struct<DatePeriod:array<struct<Start:array<{_END}>,End:array<{_END}>>>,VersionLocation:array<struct<_LocationID:string,_VALUE:string>>,VersionDetail:array<struct<_DetailReferenceID:string,_VALUE:string>>>"
_FEATURE = f"struct<_ID:string,_FeatureTypeID:string,FeatureVersion:array<{_VERSION}>>"
PARTY = f"_FixedRef string, Profile array<struct<_ID:string,_PartySubTypeID:string,Identity:array<struct<_ID:string,Alias:array<{_ALIAS}>>>,Feature:array<{_FEATURE}>>>"
LOCATION = "_ID string, LocationCountry array<struct<_CountryID:string,_VALUE:string>>, LocationPart array<struct<_LocPartTypeID:string,LocationPartValue:array<struct<Value:array<string>>>,Value:array<string>>>"
DOCUMENT = "_ID string, _IdentityID string, _IDRegDocTypeID string, IDRegistrationNo array<string>, IssuingAuthority array<string>"
RELATIONSHIP = "_ID string, `_From-ProfileID` string, `_To-ProfileID` string, _RelationTypeID string, _VALUE string"
ENTRY = "_ID string, _ProfileID string, _ListID string, SanctionsMeasure array<struct<_SanctionsTypeID:string,Comment:array<string>>>"
LABEL = "_ID string, _VALUE string"
#: Fixed value: the measure type whose comment names a program.
PROGRAM_MEASURE = "1"


def parse(fragment: Column, schema: str) -> Column:
    """A struct of one element given as text; null fields for malformed text."""
    return F.from_xml(fragment, schema, OPTIONS)


def _flat(arrays: Column, field) -> Column:
    """field of every element, where field itself is an array or null, one after another."""
    return F.flatten(F.filter(F.transform(arrays, field), lambda x: x.isNotNull()))


def _ends(period: Column, side: str, order: tuple[str, str]) -> Column:
    """The first From or To inside the side's element, as whole numbers."""
    inside = period[side]
    first, second = (first_of(_flat(inside, field)) for field in [(lambda e: e.From), (lambda e: e.To)][:: 1 if order[0] == "From" else -1])
    one = F.coalesce(first, second)
    return F.when(one.isNotNull(), F.struct(*[whole_number(one[p]).alias(p.lower()) for p in ("Year", "Month", "Day")]))


def party_columns(party: Column) -> list[Column]:
    """The columns of a raw profile, of a parsed party: the last Profile wins, the last known identity, all aliases and features."""
    profiles = F.coalesce(party.Profile, F.array().cast("array<" + PARTY.split("array<", 1)[1]))
    identities = _flat(profiles, lambda p: p.Identity)
    parts = lambda a: _flat(_flat(a.DocumentedName, lambda n: n.DocumentedNamePart), lambda p: p.NamePartValue)
    aliases = F.transform(
        _flat(identities, lambda i: i.Alias),
        lambda a: F.struct(a._AliasTypeID.alias("alias_type_id"), (F.coalesce(a._Primary, F.lit("")) == "true").alias("primary"), F.coalesce(assemble_name(parts(a)), F.lit("")).alias("full_name"), (F.coalesce(a._LowQuality, F.lit("")) == "true").alias("low_quality")),
    )

    def feature(f: Column) -> Column:
        versions = f.FeatureVersion
        period = first_of(_flat(versions, lambda v: v.DatePeriod))
        details = _flat(versions, lambda v: v.VersionDetail)
        return F.struct(
            f._ID.alias("feature_id"),
            f._FeatureTypeID.alias("feature_type_id"),
            first_of(F.transform(details, lambda d: not_blank(F.trim(d._VALUE)))).alias("detail_value"),
            _ends(period, "Start", ("From", "To")).alias("start"),
            _ends(period, "End", ("To", "From")).alias("end"),
            first_of(F.transform(_flat(versions, lambda v: v.VersionLocation), lambda x: x._LocationID)).alias("location_id"),
            first_of(F.transform(details, lambda d: d._DetailReferenceID)).alias("detail_reference_id"),
        )

    last = F.try_element_at(profiles, F.lit(-1))
    return [
        party._FixedRef.alias("fixed_ref"),
        last._ID.alias("profile_id"),
        last_of(F.transform(identities, lambda i: i._ID)).alias("identity_id"),
        last._PartySubTypeID.alias("party_sub_type_id"),
        F.filter(aliases, lambda a: a.full_name != "").alias("aliases"),
        F.transform(_flat(profiles, lambda p: p.Feature), feature).alias("features"),
    ]


def location_columns(x: Column) -> list[Column]:
    """Country and ordered parts; all values of a part have its type; blank values go, others are kept as they are."""
    values = lambda p: F.concat(F.coalesce(p.Value, F.array().cast("array<string>")), F.coalesce(_flat(p.LocationPartValue, lambda v: v.Value), F.array().cast("array<string>")))
    parts = _flat(x.LocationPart, lambda p: F.transform(F.filter(values(p), lambda v: F.trim(v) != ""), lambda v: F.struct(p._LocPartTypeID.alias("loc_part_type_id"), v.alias("value"))))
    return [x._ID.alias("location_id"), last_of(F.transform(x.LocationCountry, lambda c: c._CountryID)).alias("country_id"), F.coalesce(parts, F.array().cast("array<struct<loc_part_type_id:string,value:string>>")).alias("parts")]


def document_columns(x: Column) -> list[Column]:
    text = lambda a: not_blank(F.trim(last_of(a)))
    return [x._ID.alias("id"), x._IdentityID.alias("identity_id"), x._IDRegDocTypeID.alias("type_id"), text(x.IDRegistrationNo).alias("number"), text(x.IssuingAuthority).alias("issuer")]


def relationship_columns(x: Column) -> list[Column]:
    return [x._ID.alias("id"), x["_From-ProfileID"].alias("from_profile_id"), x["_To-ProfileID"].alias("to_profile_id"), x._RelationTypeID.alias("relation_type_id")]


def entry_columns(x: Column) -> list[Column]:
    """Programs: the trimmed comments, not empty, of measures of the program type, in order."""
    comments = F.transform(_flat(F.filter(x.SanctionsMeasure, lambda m: m._SanctionsTypeID == PROGRAM_MEASURE), lambda m: m.Comment), lambda c: F.trim(c))
    programs = F.coalesce(F.filter(comments, lambda c: c != ""), F.array().cast("array<string>"))
    return [x._ID.alias("id"), x._ProfileID.alias("profile_id"), x._ListID.alias("list_id"), programs.alias("programs")]


#: The elements that are read, with the fields of each.
ELEMENTS = {"DistinctParty": PARTY, "Location": LOCATION, "IDRegDocument": DOCUMENT, "ProfileRelationship": RELATIONSHIP, "SanctionsEntry": ENTRY, "DateOfIssue": "Year string, Month string, Day string"} | dict.fromkeys(schemas.LABEL_KINDS, LABEL)
PARTY_TAG = "DistinctParty"


_COLUMNS = {
    "x_DistinctParty": party_columns,
    "x_Location": location_columns,
    "x_IDRegDocument": document_columns,
    "x_ProfileRelationship": relationship_columns,
    "x_SanctionsEntry": entry_columns,
    "x_DateOfIssue": lambda x: [whole_number(x[p]).alias(p.lower()) for p in ("Year", "Month", "Day")],
    "x_label": lambda x: [x._ID.alias("id"), F.trim(x._VALUE).alias("label")],
}


class Snapshots(NamedTuple):
    """The pieces of the files of a path, listed once for both walks; the files (snapshot_id, well_formed, the number of opening tags of parties), and what each byte range begins with."""

    text: DataFrame
    files: list[tuple[str, bool, int]]
    starts: dict[tuple[str, int], dict]


def _split_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summaries of files of several ranges. What begins at 0 and has as many bytes as the file is all of it, and is passed over."""
    return _summaries(batches, lambda place, length, first: place == 0 and sum(map(len, first)) + len(first) >= length)


def _summaries(batches: Iterator[pa.RecordBatch], passed: Callable[[int, int, list[bytes]], bool] | None = None) -> Iterator[pa.RecordBatch]:
    for (file, place, length), lists in ranges(batches):
        if passed:
            first = next(lists)
            if passed(place, length, first):
                continue
            lists = chain([first], lists)
        tail: list[bytes] = []

        def but_last(lists: Iterator[list[bytes]] = lists, tail: list[bytes] = tail) -> Iterator[bytes]:
            for some in lists:
                some = tail + some
                tail[:] = [some.pop()]
                if some:
                    yield b">".join(some) + b">"

        told = tokens.summed_up(but_last(), PARTY_TAG.encode())
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([length], pa.int64()), pa.array([place], pa.int64()), pa.array([told]), pa.array(tail, pa.binary())], ["file", "length", "place", "told", "tail"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The verdict and the range starts of each file, of its ranges in order. A file of one range begins as all do, and has no start."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    made = ((file, list(own)) for file, own in groupby(rows, key=lambda r: r[0]))
    while part := [x for _, x in zip(range(1000), made)]:  # noqa: B905  the first iterator ends first
        out = []
        for file, own in part:
            blocks = [(place, told, tail) for _, _, place, told, tail in own if told is not None]
            starts, fine, count = tokens.joined(blocks, own[0][1], PARTY_TAG, set(ELEMENTS))
            out.append((file, fine and bool(blocks), count, [tokens.json.dumps(s) for s in starts if len(own) > 1]))
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), (pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.string())), strict=True)], ["file", "well_formed", "parties", "starts"])


def _verdicts(text: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """(file, well_formed, parties, starts) of every file (file, length), or else of those files of pieces that have several ranges; files of one range have no starts."""
    found = text.mapInArrow(_split_alone if every is None else _summaries, "file string, length long, place long, told string, tail binary")
    if every is not None:
        found = every.join(found.drop("length"), "file", "left").select("file", "length", "place", "told", "tail")
    rows = found.repartition("file").sortWithinPartitions("file", "place")
    return rows.mapInArrow(_joined, "file string, well_formed boolean, parties long, starts array<string>")


def _starts(rows: list[Row]) -> dict[tuple[str, int], dict]:
    return {(r.file, x["place"]): x for r in rows for x in map(tokens.json.loads, r.starts)}


def look_through(spark: SparkSession, path: str) -> Snapshots:
    """The first walk over the files of a path. The driver sees one small row for each file, and for each byte range of files with more than one.

    A file is well-formed if its tags nest under one root, its text holds no stray `<` or `&`, and it is UTF-8. A document
    type may be named but not defined. Prefixes need not be declared, and attributes may repeat outside elements that are
    parsed. Files without a byte are not listed.
    """
    text = pieces(spark, path, ">")
    rows = _verdicts(text, lengths(spark, path)).collect()
    return Snapshots(text, [(r.file, r.well_formed, r.parties) for r in rows], _starts(rows))


def _cuttings(text: DataFrame, starts: dict[tuple[str, int], dict]) -> DataFrame:
    """(snapshot_id, pos, element, place, origin, fragment) of elements and, with origin, of parts of elements."""
    pattern = tokens.marks(list(ELEMENTS))

    def cuttings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, place, _), lists in ranges(batches):
            start = starts.get((file, place)) or {"place": place, "state": tokens.TEXT, "rest": "", "offset": place, "target": None}
            made = tokens.cut((b">".join(x) + b">" for x in lists), start, pattern)
            while part := [x for _, x in zip(range(1000), made)]:  # noqa: B905  the first iterator ends first
                pos, element, origin, fragment = zip(*part, strict=True)
                n = len(part)
                yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array(pos, pa.int64()), pa.array(element), pa.array([place] * n, pa.int64()), pa.array(origin, pa.int64()), pa.array([f.decode("utf-8", "replace") for f in fragment])], ["snapshot_id", "pos", "element", "place", "origin", "fragment"])

    return text.mapInArrow(cuttings, "snapshot_id string, pos long, element string, place long, origin long, fragment string")


def _put_together(parts: DataFrame) -> DataFrame:
    """Whole elements of parts: two for an element that goes over the end of a range, and one more for each range within it."""
    rows = parts.groupBy("snapshot_id", "origin").agg(F.min("pos").alias("pos"), F.min("element").alias("element"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "pos", "fragment"))), lambda x: x.fragment), "").alias("fragment"))
    return rows.select("snapshot_id", "pos", "element", "fragment")


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """(snapshot_id, pos, element, fragment): the text of every element that is not within another; pos is its byte offset."""
    seen = look_through(spark, path)
    rows = _cuttings(seen.text, seen.starts)
    whole = rows.where("origin is null").select("snapshot_id", "pos", "element", "fragment")
    if not any(s["target"] for s in seen.starts.values()):
        return whole
    rows = stored(rows)
    return rows.where("origin is null").select("snapshot_id", "pos", "element", "fragment").unionByName(_put_together(rows.where("origin is not null")))


def _parsed(rows: DataFrame) -> DataFrame:
    """rows (snapshot_id, pos, element, fragment) with each fragment as a struct in the column of its kind, and whether it is broken."""
    groups = {"x_label": schemas.LABEL_KINDS} | {f"x_{e}": (e,) for e in ELEMENTS if e not in schemas.LABEL_KINDS}
    parsed = {c: F.when(F.col("element").isin(*names), parse(F.col("fragment"), f"{ELEMENTS[names[0]]}, _corrupt_record string")) for c, names in groups.items()}
    rows = rows.withColumns(parsed)
    broken = F.coalesce(*[F.col(f"{c}._corrupt_record") for c in groups]).isNotNull()
    made = [F.when(F.col(c).isNotNull(), F.struct(*_COLUMNS[c](F.col(c)))).alias(c) for c in groups]
    kept = [c for c in ("place", "origin", "part") if c in rows.columns]
    return rows.select("snapshot_id", "pos", "element", broken.alias("broken"), *made, *kept)


#: The kind of rows that hold a part of an element, as they stand in storage.
PART = "-"


def read_parsed(spark: SparkSession, path: str) -> tuple[DataFrame, list[tuple[str, bool, int]]]:
    """Every element as a struct in the column of its kind (snapshot_id, pos, element, broken, x_...), stored by element; and what look_through says of the files.

    Elements are cut out and parsed in one scan. Parts of elements are stored as they are, and parsed when put together.
    """
    seen = look_through(spark, path)
    return _parsed_table(seen.text, seen.starts), seen.files


def _parsed_table(text: DataFrame, starts: dict[tuple[str, int], dict]) -> DataFrame:
    rows = _cuttings(text, starts)
    of_part = F.col("origin").isNotNull()
    rows = rows.withColumns({"part": F.when(of_part, F.struct(F.col("element").alias("of"), "fragment")), "element": F.when(of_part, PART).otherwise(F.col("element")), "fragment": F.when(~of_part, F.col("fragment"))})
    table = stored(_parsed(rows), "element")
    whole = table.where(F.col("element") != PART).drop("place", "origin", "part")
    if not any(s["target"] for s in starts.values()):
        return whole
    parts = table.where(F.col("element") == PART).select("snapshot_id", "pos", "place", "origin", F.col("part.of").alias("element"), F.col("part.fragment").alias("fragment"))
    return whole.unionByName(stored(_parsed(_put_together(parts)), "element"), allowMissingColumns=True)


def faults(parsed: DataFrame, files: list[tuple[str, bool, int]]) -> dict[str, str]:
    """What is wrong with files, by snapshot_id: MALFORMED if tags do not nest, or else BROKEN if an element does not parse, or else LOST if the parties read are not as many as their opening tags."""
    rows = parsed.groupBy("snapshot_id").agg(F.count_if("broken").alias("broken"), F.count_if(F.col("element") == PARTY_TAG).alias("parties")).collect()  # one row for each file
    got = {r.snapshot_id: r for r in rows}
    out = {}
    for file, fine, parties in files:
        r = got.get(file)
        if not fine:
            out[file] = "MALFORMED"
        elif r and r.broken:
            out[file] = "BROKEN"
        elif (r.parties if r else 0) != parties:
            out[file] = "LOST"
    return out


def sections_of(parsed: DataFrame) -> dict[str, DataFrame]:
    """The sections of parsed elements, each keyed by snapshot_id. Labels are stored, so that every join with them knows their size and sends them out if they are small."""
    rows = lambda element: parsed.where(F.col("element") == element).select("snapshot_id", "pos", f"x_{element}.*")
    labels = parsed.where(F.col("element").isin(*schemas.LABEL_KINDS)).select("snapshot_id", "pos", F.col("element").alias("kind"), "x_label.*")
    locations = rows("Location").where("location_id is not null")
    locations = locations.groupBy("snapshot_id", "location_id").agg(F.max_by(F.struct("country_id", "parts"), "pos").alias("last")).select("snapshot_id", "location_id", "last.*")
    issued = parsed.where("element = 'DateOfIssue'").groupBy("snapshot_id").agg(F.max_by("x_DateOfIssue", "pos").alias("x"))
    return {
        "profiles": rows("DistinctParty"),
        "labels": stored(last_labels(labels)),
        "locations": locations,
        "documents": rows("IDRegDocument"),
        "entries": rows("SanctionsEntry"),
        "relationships": rows("ProfileRelationship"),
        "issued": issued.select("snapshot_id", "x.*"),
    }


def read_sections(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All sections of the snapshots at path: parsed once, stored by element, and read from there. Nothing is told of the files, so the driver sees only those of several ranges."""
    text = pieces(spark, path, ">")
    return sections_of(_parsed_table(text, _starts(_verdicts(text).where(F.size("starts") > 0).collect())))


def read_parties(spark: SparkSession, path: str) -> DataFrame:
    """Raw profiles alone."""
    rows = read_fragments(spark, path).where(F.col("element") == PARTY_TAG)
    return rows.select("snapshot_id", "pos", *party_columns(parse(F.col("fragment"), PARTY)))


def last_labels(rows: DataFrame) -> DataFrame:
    """ref_label of all kinds: without empty text or id; the last of a kind and id wins."""
    rows = rows.where(F.col("id").isNotNull() & (F.trim("label") != ""))
    return rows.groupBy("snapshot_id", "kind", "id").agg(F.max_by("label", "pos").alias("label"))


def record_count_in(text: Column) -> Column:
    """The count that a line of an older XML file names, else null."""
    return F.regexp_extract(text, r"<Record_Count>\s*(\d+)\s*</Record_Count>", 1).try_cast("long")


def legacy_count(spark: SparkSession, path: str) -> DataFrame:
    """(snapshot_id, record_count) of older XML files that name their count."""
    rows = spark.read.text(path).select(F.input_file_name().alias("snapshot_id"), record_count_in(F.col("value")).alias("n"))
    return rows.groupBy("snapshot_id").agg(F.first("n", True).alias("record_count"))
