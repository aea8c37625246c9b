"""Snapshots from XML to an active version: values, diagnostics, failures, lifecycle, streams."""

import hashlib
import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from rollkeep import schemas
from rollkeep.operators import search
from rollkeep.operators.compare import record_hash
from rollkeep.operators.resolve import first_failure, resolve
from rollkeep.operators.scope import ScopeError, check_source_list, lists_in_scope
from rollkeep.plans.cycle import run_cycle, tick
from rollkeep.sources import files, mapping, xml
from rollkeep.sources.store import Store
from rollkeep.streaming import ingest

XML = """<?xml version="1.0"?>
<Sanctions xmlns="http://x">
<DateOfIssue><Year>2026</Year><Month>8</Month><Day>31</Day></DateOfIssue>
<ReferenceValueSets>
<FeatureTypeValues><FeatureType ID="8">Birthdate</FeatureType><FeatureType ID="10">Nationality Country</FeatureType><FeatureType ID="25">Location</FeatureType><FeatureType ID="26">Title</FeatureType><FeatureType ID="224">Gender</FeatureType><FeatureType ID="99">Website</FeatureType></FeatureTypeValues>
<IDRegDocTypeValues><IDRegDocType ID="1571">Passport</IDRegDocType></IDRegDocTypeValues>
<RelationTypeValues><RelationType ID="15">Associate Of</RelationType></RelationTypeValues>
<ListValues><List ID="1550">Main List</List></ListValues>
<CountryValues><Country ID="11"> Cuba </Country></CountryValues>
<LocPartTypeValues><LocPartType ID="1">CITY</LocPartType></LocPartTypeValues>
<AliasTypeValues><AliasType ID="1400">A.K.A.</AliasType><AliasType ID="1403">Name</AliasType></AliasTypeValues>
<DetailReferenceValues><DetailReference ID="7">Male</DetailReference></DetailReferenceValues>
</ReferenceValueSets>
<Locations><Location ID="50"><LocationCountry CountryID="11"/><LocationPart LocPartTypeID="1"><LocationPartValue><Value>Havana</Value></LocationPartValue></LocationPart></Location></Locations>
<IDRegDocuments><IDRegDocument ID="1" IdentityID="500" IDRegDocTypeID="1571"><IDRegistrationNo>A1</IDRegistrationNo></IDRegDocument><IDRegDocument ID="2" IdentityID="500" IDRegDocTypeID="9"><IDRegistrationNo> </IDRegistrationNo></IDRegDocument></IDRegDocuments>
<DistinctParties>
<DistinctParty FixedRef="36"><Profile ID="36" PartySubTypeID="4"><Identity ID="500"><Alias AliasTypeID="1403" Primary="true" LowQuality="false"><DocumentedName><DocumentedNamePart><NamePartValue ScriptID="1"> Ivan </NamePartValue></DocumentedNamePart><DocumentedNamePart><NamePartValue>PETROV</NamePartValue></DocumentedNamePart></DocumentedName></Alias><Alias AliasTypeID="1400" Primary="false" LowQuality="true"><DocumentedName><DocumentedNamePart><NamePartValue>Vanya</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity>
<Feature ID="1" FeatureTypeID="8"><FeatureVersion><DatePeriod><Start><From><Year>1960</Year><Month>1</Month><Day>2</Day></From></Start><End><To><Year>1960</Year><Month>1</Month><Day>2</Day></To></End></DatePeriod></FeatureVersion></Feature>
<Feature ID="2" FeatureTypeID="10"><FeatureVersion><VersionLocation LocationID="50"/></FeatureVersion></Feature>
<Feature ID="3" FeatureTypeID="25"><FeatureVersion><VersionLocation LocationID="50"/></FeatureVersion></Feature>
<Feature ID="4" FeatureTypeID="26"><FeatureVersion><VersionDetail>Minister</VersionDetail></FeatureVersion></Feature>
<Feature ID="5" FeatureTypeID="26"><FeatureVersion><VersionDetail>Deputy</VersionDetail></FeatureVersion></Feature>
<Feature ID="6" FeatureTypeID="224"><FeatureVersion><VersionDetail DetailReferenceID="7"/></FeatureVersion></Feature>
<Feature ID="7" FeatureTypeID="99"><FeatureVersion><VersionDetail>www.x</VersionDetail></FeatureVersion></Feature>
<Feature ID="8" FeatureTypeID="25"><FeatureVersion><VersionLocation LocationID="51"/></FeatureVersion></Feature>
</Profile></DistinctParty>
<DistinctParty FixedRef="40"><Profile ID="40" PartySubTypeID="3"><Identity ID="501"><Alias AliasTypeID="1403" Primary="false"><DocumentedName><DocumentedNamePart><NamePartValue>ACME</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity></Profile></DistinctParty>
<DistinctParty FixedRef="41"><Profile ID="41" PartySubTypeID="1"><Identity ID="502"><Alias AliasTypeID="1403" Primary="false"><DocumentedName><DocumentedNamePart><NamePartValue>SHIP</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity></Profile></DistinctParty>
</DistinctParties>
<ProfileRelationships><ProfileRelationship ID="1" From-ProfileID="36" To-ProfileID="41" RelationTypeID="15"/><ProfileRelationship ID="2" From-ProfileID="36" To-ProfileID="77" RelationTypeID="15"/></ProfileRelationships>
<SanctionsEntries><SanctionsEntry ID="1" ProfileID="36" ListID="1550"><SanctionsMeasure ID="1" SanctionsTypeID="1"><Comment> CUBA </Comment></SanctionsMeasure><SanctionsMeasure ID="2" SanctionsTypeID="1"><Comment>IRAN</Comment></SanctionsMeasure><SanctionsMeasure ID="2" SanctionsTypeID="2"><Comment>NO</Comment></SanctionsMeasure></SanctionsEntry><SanctionsEntry ID="2" ProfileID="40" ListID="1550"></SanctionsEntry></SanctionsEntries>
</Sanctions>"""


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def landed(tmp_path, text, name="a.xml"):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_resolve(spark, tmp_path):
    records, diagnostics = resolve(xml.read_sections(spark, landed(tmp_path, XML)))
    ivan, acme = (r.asDict(True) for r in records.orderBy("pos").collect())
    assert ivan["primary_name"] == "Ivan PETROV"
    assert ivan["aliases"] == [{"name": "Vanya", "type": "A.K.A.", "is_primary": False, "category": "WEAK"}]
    assert ivan["birth_dates"] == [{"year": 1960, "month": 1, "day": 2, "period": None}]
    assert ivan["nationalities"] == ["Cuba"]
    assert ivan["addresses"] == [{"raw": "Havana", "country": "Cuba", "parts": {"CITY": "Havana"}}]
    assert (ivan["title"], ivan["gender"], ivan["place_of_birth"]) == ("Minister", "Male", None)
    assert ivan["features"] == [{"type": "Title", "value": "Deputy"}, {"type": "Website", "value": "www.x"}]
    assert ivan["documents"] == [{"type": "Passport", "number": "A1", "issuer": None}, {"type": "Unknown", "number": None, "issuer": None}]
    assert ivan["sanction_programs"] == ["CUBA", "IRAN"]
    assert ivan["relationships"] == [{"to_fixed_ref": "41", "relation_type": "Associate Of"}]
    assert (acme["primary_name"], acme["entity_type"], acme["sanction_programs"]) == ("ACME", "Entity", ["Main List"])
    said = sorted((r.fixed_ref, r.kind, r.detail) for r in diagnostics.collect())
    assert said == [("36", "UNRESOLVED_REF", "document type 9"), ("36", "UNRESOLVED_REF", "location 51"), ("36", "UNRESOLVED_REF", "target profile 77")]


def test_prefix_and_corruption(spark, tmp_path):
    prefixed = XML.replace("<Distinct", "<n:Distinct").replace("</Distinct", "</n:Distinct").replace("xmlns=", "xmlns:n=")
    path = landed(tmp_path, prefixed, "p.xml")
    assert sorted(r.fixed_ref for r in xml.read_parties(spark, path).where("size(aliases) > 0").collect()) == ["36", "40", "41"]
    every = re.sub(r"<(/?)(?=[A-Z])", r"<\1n:", XML).replace("xmlns=", "xmlns:n=")
    plain, named = (resolve(xml.read_sections(spark, landed(tmp_path, t, n)))[0].drop("snapshot_id", "pos").orderBy("fixed_ref").collect() for t, n in ((XML, "plain.xml"), (every, "named.xml")))
    assert plain == named and len(plain) == 2

    def state(text):
        return xml.faults(*xml.read_parsed(spark, landed(tmp_path, text, "x.xml")))

    assert state(XML) == {}
    assert state(XML.replace("<Locations>", "<!-- <Location ID='9'> --><Locations>")) == {}
    for broken in (XML.replace("</Identity>", "", 1), XML.replace("</Locations>", ""), XML.replace("<Comment>IRAN", "<Comment>IR<AN")):
        assert list(state(broken).values()) == ["MALFORMED"]
    twice = XML.replace('<Feature ID="1"', '<Feature ID="1" ID="1"')
    assert list(state(twice).values()) == ["BROKEN"]


def test_any_order_and_one_parse(spark, tmp_path):
    """Sections may stand in any order; the plan of the records reads what was stored, not the snapshot again."""
    head, body, foot = XML.partition("<ReferenceValueSets>")[0], XML.partition("<DistinctParties>")[2].partition("</DistinctParties>"), "</Sanctions>"
    rest = XML.partition("<ReferenceValueSets>")[2].partition("<DistinctParties>")[0]
    turned = head + "<DistinctParties>" + body[0] + "</DistinctParties>" + body[2].replace("</Sanctions>", "") + "<ReferenceValueSets>" + rest + foot
    wanted = resolve(xml.read_sections(spark, landed(tmp_path, XML)))[0].drop("snapshot_id", "pos").orderBy("fixed_ref")
    got = resolve(xml.read_sections(spark, landed(tmp_path, turned, "b.xml")))[0]
    assert got.drop("snapshot_id", "pos").orderBy("fixed_ref").collect() == wanted.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "b.xml" not in plan and "FileScan text" not in plan and "FileScan xml" not in plan


def test_determinism(spark, tmp_path):
    """The same bytes give the same version and the same records, hash by hash."""
    found = []
    for name in ("one", "two"):
        store = Store(spark, str(tmp_path / name))
        out = run_cycle(spark, store, "SDN", landed(tmp_path, XML, f"{name}.xml"), sha(XML))
        rows = store.current("SDN").select("fixed_ref", record_hash(sorted(c for c in store.records().columns if c != "fixed_ref"))).orderBy("fixed_ref").collect()
        found.append((out, rows))
    assert found[0] == found[1] and len(found[0][1]) == 2


def test_stored_bytes(spark, tmp_path):
    """Landed bytes are kept and hashed again: tampered ones stop the version, and a cold version that rots is flagged and cannot come back."""
    store = Store(spark, str(tmp_path / "store"))
    path = landed(tmp_path, XML)
    day = date(2026, 8, 28)
    fake = files.read_raw(spark, path).withColumn("content", F.lit("other").cast("binary"))
    store.land(fake, "SDN", day)  # what stands there under this digest is never overwritten
    out = run_cycle(spark, store, "SDN", path, sha(XML))
    assert (out.status, out.failed_stage, out.cause) == ("FAILED", "PERSIST", "RAW_INTEGRITY")
    assert store.trio().count() == 0 and store.versions().count() == 0 and store.raw().count() == 1
    store = Store(spark, str(tmp_path / "store2"))
    texts = [XML.replace("ACME", f"ACME {i}") for i in range(5)]
    none = spark.createDataFrame([], schemas.RECORD_FIELDS)
    for i, text in enumerate(texts):
        store.land(files.read_raw(spark, landed(tmp_path, text, f"v{i}.xml")), "SDN", day)
        assert store.stored_bytes_ok("SDN", day, sha(text))
        assert store.put_isolated(none, "SDN", day, sha(text), {"record_count": 0, "out_of_scope_count": 0, "expected_count": 0}, "-") and store.publish("SDN", day, sha(text)) == "ACTIVATED"
    assert store.raw().count() == 5 and {r.digest: r.ok for r in store.check_cold("SDN").collect()} == {sha(t): True for t in texts[:2]}
    for part in (tmp_path / "store2" / "raw").glob(f"*/*/digest={sha(texts[0])}/*.parquet"):
        spark.read.parquet(str(part)).withColumn("content", F.lit("rot").cast("binary")).write.parquet(str(tmp_path / "rot"))
        part.write_bytes(next((tmp_path / "rot").glob("*.parquet")).read_bytes())
        part.with_name(f".{part.name}.crc").unlink()
    assert {r.digest: r.ok for r in store.check_cold("SDN").collect()} == {sha(texts[0]): False, sha(texts[1]): True}
    assert [r.digest for r in store.unusable().collect()] == [sha(texts[0])]
    assert not store.activate("SDN", day, sha(texts[0])) and store.activate("SDN", day, sha(texts[1]))
    assert [r.digest for r in store.versions().where(F.col("digest") == sha(texts[0])).collect()] == [sha(texts[0])]


def test_incomplete_downloads(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    path = landed(tmp_path, XML)
    for said in ({"status": 500}, {"redirects": 6}, {"content_length": len(XML) + 1}):
        out = run_cycle(spark, store, "SDN", path, sha(XML), **said)
        assert (out.failed_stage, out.cause) == ("OBTAIN", "INCOMPLETE_DOWNLOAD")
    assert run_cycle(spark, store, "SDN", path, sha(XML), redirects=5, content_length=len(XML.encode())).status == "ACTIVATED"


def test_readers_keep_their_version(spark, tmp_path):
    """A reader that asked before an activation goes on reading the version of that time, also after it."""
    store = Store(spark, str(tmp_path / "store"))
    new = XML.replace("ACME", "ACME TWO")
    run_cycle(spark, store, "SDN", landed(tmp_path, XML), sha(XML))
    before = store.current("SDN")
    run_cycle(spark, store, "SDN", landed(tmp_path, new, "n.xml"), sha(new))
    names = lambda df: sorted(r.primary_name for r in df.collect())
    assert names(before) == ["ACME", "Ivan PETROV"] and names(store.current("SDN")) == ["ACME TWO", "Ivan PETROV"]


def test_second_mapping(spark, tmp_path):
    """Delimited files go through the same cycle; a mapping that breaks the contract is refused."""
    text = '36,"PETROV, Ivan","individual","CUBA] [IRAN","Minister",-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,"a"\n40,"ACME",-0- ,"IRAN",-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- \n41,"SHIP","vessel","IRAN",-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- \n'
    path = landed(tmp_path, text, "x.csv")
    store = Store(spark, str(tmp_path / "store"))
    out = run_cycle(spark, store, "SDN", path, sha(text), last_modified="Sun, 06 Nov 1994 08:49:37 GMT", mapping=mapping.CSV_MAPPING)
    assert (out.status, out.publish_date) == ("ACTIVATED", date(1994, 11, 6))
    rows = {r.fixed_ref: r for r in store.current("SDN").collect()}
    assert rows.keys() == {"36", "40"} and rows["36"].sanction_programs == ["CUBA", "IRAN"] and rows["36"].title == "Minister"
    assert (rows["36"].primary_name, rows["40"].entity_type) == ("PETROV, Ivan", "Entity")
    sections = mapping.csv_sections(spark, path)
    assert mapping.contract_errors(sections) == [] and mapping.contract_errors(xml.read_sections(spark, landed(tmp_path, XML))) == []
    del sections["labels"]
    sections["entries"] = sections["entries"].withColumn("programs", F.lit("x"))
    assert mapping.contract_errors(sections) == ["no section labels", "entries.programs: string, not array<string>"]
    with pytest.raises(ValueError):
        mapping.check_sections(sections)


def test_cycle_and_lifecycle(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    path = landed(tmp_path, XML)
    first = run_cycle(spark, store, "SDN", path, sha(XML))
    assert (first.status, first.publish_date, first.digest) == ("ACTIVATED", date(2026, 8, 28), sha(XML))
    assert run_cycle(spark, store, "SDN", path, sha(XML)).status == "SKIPPED"
    assert store.rollback("SDN") == "NO_PREVIOUS"
    second = XML.replace("ACME", "ACME TWO")
    third = XML.replace("ACME", "ACME THREE")
    for i, text in enumerate((second, third)):
        assert run_cycle(spark, store, "SDN", landed(tmp_path, text, f"{i}.xml"), "sha-256=" + sha(text)).status == "ACTIVATED"
    trio = lambda: {r.pointer: r.digest for r in store.trio().collect()}
    assert trio() == {"CURRENT": sha(third), "PREVIOUS": sha(second), "N_MINUS_2": sha(XML)}
    assert store.rollback("SDN") == "ACTIVATED"
    assert trio() == {"CURRENT": sha(second), "PREVIOUS": sha(third), "N_MINUS_2": sha(second)}
    assert [r.primary_name for r in search.search(store.current("SDN"), "acme").collect()] == ["ACME TWO"]
    assert [r.primary_name for r in search.search(store.current("SDN"), "VANYA").collect()] == ["Ivan PETROV"]
    assert store.current("CONSOLIDATED").count() == 0
    assert not store.activate("CONSOLIDATED", date(2026, 8, 28), sha(XML))
    ingest.append_changes(store, "SDN", str(tmp_path / "changes"))
    followed = ingest.changes(spark, str(tmp_path / "changes")).writeStream.format("memory").queryName("followed").trigger(availableNow=True).start()
    followed.awaitTermination(60)
    assert [(r.fixed_ref, r.change, r.digest) for r in spark.table("followed").collect()] == [("40", "MODIFIED", sha(second))]
    assert [(r.fixed_ref, r.change) for r in spark.read.parquet(str(tmp_path / "changes")).collect()] == [("40", "MODIFIED")]


def test_failures_leave_pointers(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    cut = XML[:-30]
    no_program = XML.replace('ID="2" ProfileID="40"', 'ID="2" ProfileID="400"')
    twice = XML.replace('FixedRef="40"', 'FixedRef="36"')
    cases = [
        (XML, None, "VALIDATE", "ABSENT_DIGEST"),
        (XML, sha("x"), "VALIDATE", "DIGEST_MISMATCH"),
        (cut, sha(cut), "VALIDATE", "MALFORMED_XML"),
        (no_program, sha(no_program), "TRANSFORM", "NO_PROGRAM 40"),
        (twice, sha(twice), "PUBLISH", "COUNT_MISMATCH"),
    ]
    for i, (text, digest, stage, cause) in enumerate(cases):
        out = run_cycle(spark, store, "SDN", landed(tmp_path, text, f"f{i}.xml"), digest)
        assert (out.status, out.failed_stage, out.cause) == ("FAILED", stage, cause)
    assert store.trio().count() == 0
    good = landed(tmp_path, XML, "good.xml")
    rows = tick(spark, store, [{"source_list": "SDN", "path": "/nowhere/x.xml", "digest_header": "x"}, {"source_list": "CONSOLIDATED", "path": good, "digest_header": sha(XML)}])
    assert {r.source_list: r.status for r in rows.collect()} == {"SDN": "FAILED", "CONSOLIDATED": "ACTIVATED"}


def test_first_failing_record(spark):
    rows = spark.createDataFrame([("s", 2, "b", "NO_NAME"), ("s", 1, "a", "NO_PROGRAM"), ("s", 0, "c", None), ("t", 0, "d", None)], "snapshot_id string, pos long, fixed_ref string, reject_reason string")
    assert sorted(tuple(r) for r in first_failure(rows).collect()) == [("s", "FAILED", "a", "NO_PROGRAM"), ("t", "BUILT", None, None)]


def test_stream_ingest_once(spark, tmp_path):
    """Each file once; only files that the manifest names with their real digest become versions, and the others stop nothing."""
    store = Store(spark, str(tmp_path / "store"))
    said = tmp_path / "manifest"
    said.mkdir()
    bad, cut = XML.replace("ACME", "TAMPERED"), XML[:-30]
    rows = [{"path": "a.xml", "digest_header": sha(XML), "status": 200}, {"path": "b.xml", "digest_header": sha("what was published")}, {"path": "c.xml", "digest_header": sha(cut)}, {"path": "e.xml", "digest_header": sha("x"), "status": 404}]
    (said / "1.json").write_text("\n".join(map(json.dumps, rows)))
    for name, text in (("b.xml", bad), ("c.xml", cut), ("d.xml", XML.replace("ACME", "UNNAMED")), ("e.xml", "x"), ("a.xml", XML)):
        landed(tmp_path, text, name)
    for _ in range(2):
        ingest.ingest(spark, store, str(tmp_path / "in"), str(tmp_path / "cp"), str(said)).awaitTermination(240)
    assert (store.versions().count(), store.activations().count()) == (1, 1)
    got = sorted((r.status, r.failed_stage or "", r.cause or "") for r in spark.read.parquet(f"{store.folder}/outcomes").collect())
    assert got == [("ACTIVATED", "", ""), ("FAILED", "OBTAIN", "INCOMPLETE_DOWNLOAD"), ("FAILED", "VALIDATE", "ABSENT_DIGEST"), ("FAILED", "VALIDATE", "DIGEST_MISMATCH"), ("FAILED", "VALIDATE", "MALFORMED_XML")]
    events = tmp_path / "events"
    spark.createDataFrame([(1, "paid to ivan petrov today"), (2, "nothing")], "id long, note string").write.parquet(str(events))
    stream = spark.readStream.schema("id long, note string").parquet(str(events))
    ingest.screen_stream(stream, "id", "note", store, "SDN", str(tmp_path / "hits"), str(tmp_path / "cp2")).awaitTermination(120)
    assert [(r.id, r.needle) for r in spark.read.parquet(str(tmp_path / "hits")).collect()] == [(1, "ivan petrov")]


def test_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text('36,"PETROV, Ivan","individual","CUBA",-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,"a\nb"\n40,"ACME",-0- ,"IRAN",-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- \n')
    assert files.csv_count(spark, str(tmp_path / "x.csv")).first().record_count == 2
    rows = files.read_csv(spark, str(tmp_path / "x.csv")).collect()
    assert [(r.ent_num, r.sdn_name, r.sdn_type, r.remarks) for r in rows] == [("36", "PETROV, Ivan", "individual", "a\nb"), ("40", "ACME", None, None)]
    (tmp_path / "old.xml").write_text("<a>\n<Record_Count>17</Record_Count>\n</a>")
    assert xml.legacy_count(spark, str(tmp_path / "old.xml")).first().record_count == 17
    raw = files.read_raw(spark, str(tmp_path / "old.xml")).select("path", "digest", "content").withColumns({"source_list": F.lit("SDN"), "publish_date": F.lit("2026-01-01")})
    none = spark.createDataFrame([], "source_list string, publish_date string, digest string")
    assert files.land(raw, none, str(tmp_path / "landed")).count() == 1
    digest = raw.first().digest
    there = files.read_landed(spark, str(tmp_path / "landed"), "SDN", "2026-01-01", digest)
    assert there.count() == 1
    assert files.new_files(raw, there.withColumn("publish_date", F.col("publish_date").cast("string"))).count() == 0


def test_arguments():
    assert lists_in_scope(" SDN_AND_CONSOLIDATED ") == ["SDN", "CONSOLIDATED"]
    for given, kind in ((None, "MISSING"), (" ", "BLANK"), ("sdn_only", "UNKNOWN")):
        with pytest.raises(ScopeError) as error:
            lists_in_scope(given)
        assert error.value.kind == kind
    with pytest.raises(ValueError):
        check_source_list("OTHER")
    for offset, limit in ((-1, 5), (0, 0), (0, 1001)):
        with pytest.raises(ValueError):
            search.check_page(offset, limit)
    with pytest.raises(ValueError):
        search.check_query("  ")


def test_pages_cover_all_once(spark):
    rows = spark.range(23).select(F.col("id").cast("string").alias("fixed_ref"))
    got = [r.fixed_ref for at in range(0, 30, 5) for r in search.page(rows, at, 5).collect()]
    assert got == sorted(map(str, range(23)))
    assert search.page(rows, 100, 5).count() == 0
    last, keyset = None, []
    while part := [r.fixed_ref for r in search.page_after(rows, last, 7).collect()]:
        keyset += part
        last = part[-1]
    assert keyset == got


def test_land_takes_the_first_of_equal_versions(spark, tmp_path):
    rows = spark.createDataFrame([("SDN", "d", "x", "b", b"2"), ("SDN", "d", "x", "a", b"1")], "source_list string, publish_date string, digest string, path string, content binary")
    none = spark.createDataFrame([], "source_list string, publish_date string, digest string")
    assert [r.path for r in files.land(rows, none, str(tmp_path / "raw")).collect()] == ["a"]


def test_screen(spark):
    """Against a plain search: needles of one word, of parts of words, shorter than a gram, and with signs and spaces."""
    texts = [(1, "Paid to Ivan  Petrov, today"), (2, "ivan petrov"), (3, "xivan petrovx and a.b%c_d"), (4, None), (5, ""), (6, "a\tb\nivan"), (None, "ivan petrov"), (7, "ÉCOLE de Paris")]
    needles = ["Ivan Petrov", "van", "a", "%", "c_d", "b\nI", "o i", " ", "", None, "École DE", "zzz", "petrov"]
    got = {(r.id, r.needle) for r in search.screen(spark.createDataFrame(texts, "id long, note string"), "id", "note", spark.createDataFrame([(n,) for n in needles], "n string"), "n").collect()}
    assert got == {(i, n.lower()) for i, t in texts for n in needles if i is not None and t and n and n.strip() and n.lower() in t.lower()}
