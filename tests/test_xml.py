"""The XML reader against a whole-file parser: cuts at any place, hidden tags, and files that must not become versions."""

import hashlib
import random
import xml.etree.ElementTree as ElementTree

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollkeep.plans import catalog
from rollkeep.plans.cycle import run_cycle
from rollkeep.sources import tokens, xml
from rollkeep.sources.mapping import XML_MAPPING
from rollkeep.sources.pieces import ranges
from rollkeep.sources.store import Store
from test_snapshots import XML, landed

NAMES = ["DistinctParty", "Location"]


def walked(text, places):
    """well_formed, the number of parties, and (offset, name, text) of the elements, with cuts after the given places."""
    pieces = text.split(b">")
    blocks, block, at = [], [], 0
    for piece in pieces if pieces[-1] else pieces[:-1]:
        block.append(piece)
        at += len(piece) + 1
        if at in places:
            blocks.append(block)
            block = []
    blocks += [block] if block else []
    part = lambda pieces: iter([b">".join(pieces) + b">"] if pieces else [])
    told = [(k, tokens.summed_up(part(b[:-1]), b"DistinctParty"), b[-1]) for k, b in enumerate(blocks)]
    starts, fine, count = tokens.joined(told, len(text), "DistinctParty", set(NAMES))
    found = {}
    for start in starts:
        half = len(blocks[start["place"]]) // 2
        stretches = [x for y in (blocks[start["place"]][:half], blocks[start["place"]][half:]) for x in part(y)]
        for pos, name, origin, cut in tokens.cut(iter(stretches), start, tokens.marks(NAMES)):
            found.setdefault(("part", origin) if origin is not None else pos, []).append((pos, name, cut))
    return fine, count, sorted((min(p for p, _, _ in v), v[0][1], b"".join(x[2] for x in v)) for v in found.values())


def made(rng, depth=0):
    if depth > 4 or rng.random() < 0.25:
        return rng.choice(["x", " ", "a>b", "&amp;", "<!-- <Location> > -->", "<![CDATA[ <Location>>]] ]]>", "<?pi > ?>", "\n", "é"])
    name = rng.choice(["DistinctParty", "Location", "Locations", "a", "n:DistinctParty", "n:b"])
    given = rng.choice(["", " i='1'", ' i="a>b"', " i='>' j=\"x > y\"", " i=\"'>\"", ' i="&lt;>"'])
    if rng.random() < 0.2:
        return f"<{name}{given}/>"
    return f"<{name}{given}>" + "".join(made(rng, depth + 1) for _ in range(rng.randrange(4))) + f"</{name}{rng.choice(['', ' '])}>"


def test_cuts_at_any_place():
    """Whatever the cuts, the same elements; whole files agree with a parser that reads from the start to the end."""
    rng = random.Random(1)
    for _ in range(1500):
        text = rng.choice(["", "<?xml version='1.0'?>", "<!-- c -->\n", "<!DOCTYPE r>"]) + "<r xmlns:n='u>v'>" + "".join(made(rng) for _ in range(rng.randrange(6))) + "</r>" + rng.choice(["", "\n", "<!-- > -->"])
        data = text.encode()
        places = {k + 1 for k, c in enumerate(data) if c == 62 and rng.random() < 0.4}
        fine, count, found = walked(data, places)
        assert (fine, count, found) == walked(data, set()) and fine
        parties, outer = 0, []

        def walk(element, inside):
            nonlocal parties
            name = element.tag.rpartition("}")[2]
            parties += name == "DistinctParty"
            if name in NAMES and not inside:
                outer.append(name)
            for child in element:
                walk(child, inside or name in NAMES)

        walk(ElementTree.fromstring(data), False)
        assert count == parties and [n for _, n, _ in found] == outer
        assert all(data[pos : pos + len(t)] == t for pos, _, t in found)


def test_damage_is_seen():
    """A byte that is taken out, put in or cut off: what a strict parser refuses is refused, but for names that only namespaces forbid."""
    rng = random.Random(2)
    refused = 0
    for _ in range(1500):
        text = "<r xmlns:n='u>v'>" + "".join(made(rng) for _ in range(rng.randrange(6))) + "</r>"
        k = rng.randrange(len(text))
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + rng.choice("<>/\"'& aP") + text[k:], text[:k]])
        data = text.encode()
        places = {k + 1 for k, c in enumerate(data) if c == 62 and rng.random() < 0.3}
        try:
            ElementTree.fromstring(data)
            wanted = True
        except ElementTree.ParseError as error:
            wanted = False
            if "prefix" in str(error):
                continue
        assert walked(data, places)[0] == wanted, (text, places)
        refused += not wanted
    assert refused > 500


HIDDEN = {
    "empty party": XML.replace('<DistinctParty FixedRef="36">', '<DistinctParty FixedRef="9"/><DistinctParty FixedRef="36">'),
    "spaced": XML.replace("</DistinctParty>", "</DistinctParty >"),
    "cdata": XML.replace("<ListValues>", '<![CDATA[ <List ID="1550">bad</List> </DistinctParty> ]]><ListValues>').replace("<ReferenceValueSets>", "<ReferenceValueSets><Note>").replace("<FeatureTypeValues>", "</Note><FeatureTypeValues>", 1),
    "comment": XML.replace("</DistinctParties>", '<!-- </DistinctParty> <DistinctParty FixedRef="8"> --></DistinctParties>'),
    "comment in a party": XML.replace("<Identity ", "<!-- </DistinctParty> > --><Identity ", 1),
    "attribute": XML.replace("<Locations>", '<Locations><Location ID="a>b"/><Location ID="c"/><Location ID="d\'>"/>'),
}


@pytest.fixture
def narrow(spark):
    """Byte ranges that end within parties."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("case", HIDDEN)
def test_no_record_is_lost(case, spark, tmp_path):
    """Valid XML of any form goes through the cycle with all its records; an empty party counts as one out of scope."""
    text, parties = HIDDEN[case], 4 if case == "empty party" else 3
    store = Store(spark, str(tmp_path / "store"))
    out = run_cycle(spark, store, "SDN", landed(tmp_path, text), hashlib.sha256(text.encode()).hexdigest())
    assert out.status == "ACTIVATED" and sorted(r.fixed_ref for r in store.current("SDN").collect()) == ["36", "40"]
    assert [(r.record_count, r.persisted_count) for r in store.versions().collect()] == [(parties, 2)]


def test_ranges_within_parties(spark, tmp_path, narrow):
    """The same elements at the same bytes, whatever the ranges."""
    for case, text in HIDDEN.items():
        landed(tmp_path, text, f"{case}.xml")
    seen = xml.look_through(spark, str(tmp_path / "in"))
    assert len(seen.starts) > 4 * len(HIDDEN) and any(s["target"] for s in seen.starts.values())
    assert {x[0].rpartition("/")[2]: x[1:] for x in seen.files} == {f"{c.replace(' ', '%20')}.xml": (True, 4 if c == "empty party" else 3) for c in HIDDEN}
    for f in xml.read_fragments(spark, str(tmp_path / "in")).collect():
        data = HIDDEN[f.snapshot_id.rpartition("/")[2].removesuffix(".xml").replace("%20", " ")].encode()
        assert data[f.pos : f.pos + len(f.fragment.encode())].decode() == f.fragment
    sections = xml.read_sections(spark, str(tmp_path / "in"))
    assert sections["profiles"].count() == 3 * len(HIDDEN) + 1
    assert {r.label for r in sections["labels"].where("kind = 'List'").collect()} == {"Main List"}
    told = xml.sections_of(xml.read_parsed(spark, str(tmp_path / "in"))[0])
    assert all(sections[k].exceptAll(told[k]).isEmpty() and told[k].exceptAll(sections[k]).isEmpty() for k in sections)
    places = [r.location_id for r in sections["locations"].where("snapshot_id like '%attribute%'").collect()]
    assert sorted(places) == ["50", "a>b", "c", "d'>"]


def test_faults(spark, tmp_path, narrow):
    """Nesting that is wrong only across ranges, several roots, and parties that are read but not opened fail; other files of the path do not."""
    landed(tmp_path, XML, "good.xml")
    landed(tmp_path, XML.replace("</Locations>", "</LocationS>"), "nested.xml")
    landed(tmp_path, XML + "\n<Sanctions/>", "roots.xml")
    landed(tmp_path, XML + "\n", "newline.xml")
    (tmp_path / "in" / "latin.xml").write_bytes(XML.replace("ACME", "ACMÉ").encode("latin-1"))
    (tmp_path / "in" / "mark.xml").write_bytes(b"\xef\xbb\xbf" + XML.encode())
    parsed, files = xml.read_parsed(spark, str(tmp_path / "in"))
    found = {k.rpartition("/")[2]: v for k, v in xml.faults(parsed, files).items()}
    assert found == dict.fromkeys(["nested.xml", "roots.xml", "latin.xml"], "MALFORMED")
    (tmp_path / "none.xml").touch()
    assert XML_MAPPING.read(spark, str(tmp_path / "none.xml"))[1] == "MALFORMED_XML"
    less = parsed.where(~((F.col("element") == "DistinctParty") & (F.col("x_DistinctParty.fixed_ref") == "40")))
    assert {k.rpartition("/")[2]: v for k, v in xml.faults(less, files).items()}["good.xml"] == "LOST"


def test_a_snapshot_costs_no_task(spark, tmp_path):
    """One file for each row, also where a key repeats, and far fewer tasks than files: they are listed as one folder, by no task of their own."""
    keys = [*range(1, 201), 7]
    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    told = spark.sparkContext.statusTracker()
    try:
        spark.sparkContext.setJobGroup("snapshots", "")
        got = sorted((r.s_suppkey, r.year, r.month, r.day) for r in catalog.QUERIES["xml_issued"](spark, str(tmp_path)).collect())
        stages = {s for j in told.getJobIdsForGroup("snapshots") for s in told.getJobInfo(j).stageIds}
        tasks = sum(i.numTasks for i in map(told.getStageInfo, stages) if i)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == sorted((k, 1950 + k % 100, 1 + k % 12, 1 + k % 28 if k % 3 else None) for k in keys)
    assert tasks < len(keys) // 2


def test_whole_files_are_passed_over(spark, tmp_path):
    """Where nothing is told of the files, the first walk leaves no row of a file of one range, however it ends."""
    for k, end in enumerate(("", "\n", ">", "\n\n ")):
        (tmp_path / f"{k}.xml").write_text(f"<S><DateOfIssue><Year>{1900 + k}</Year></DateOfIssue></S{end}" if end == ">" else f"<S><DateOfIssue><Year>{1900 + k}</Year></DateOfIssue></S>{end}")
    (tmp_path / "mark.xml").write_bytes(b"\xef\xbb\xbf<S><DateOfIssue><Year>1904</Year></DateOfIssue></S>")
    assert {r.file.rpartition("/")[2] for r in xml._verdicts(xml.pieces(spark, str(tmp_path), ">")).collect()} <= {"mark.xml"}
    assert sorted(r.year for r in xml.read_sections(spark, str(tmp_path))["issued"].collect()) == list(range(1900, 1905))


def test_many_small_files(spark, tmp_path):
    """Files of one range leave nothing with the driver, their ranges are told apart within a batch, and bytes and dates come back."""
    for k in range(60):
        (tmp_path / f"{k}.xml").write_text(f"<S><DateOfIssue><Year>{1900 + k}</Year></DateOfIssue></S>\n")
    seen = xml.look_through(spark, str(tmp_path))
    assert not seen.starts and len(seen.files) == 60 and all(fine for _, fine, _ in seen.files)
    assert sorted(r.year for r in xml.read_sections(spark, str(tmp_path))["issued"].collect()) == list(range(1900, 1960))
    column = lambda *v: pa.array(v)
    batch = pa.RecordBatch.from_arrays([column("a", "a", "b", "b", "b"), column(0, 9, 9, 9, 0), column(1, 1, 2, 2, 2), column(b"1", b"2", b"3", b"4", b"5")], ["file", "place", "length", "piece"])
    got = [(key, [x for some in lists for x in some]) for key, lists in ranges(iter([batch]))]
    assert got == [(("a", 0, 1), [b"1"]), (("a", 9, 1), [b"2"]), (("b", 9, 2), [b"3", b"4"]), (("b", 0, 2), [b"5"])]
