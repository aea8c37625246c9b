"""Pages, searches and screening through indexes against plain scans, and what their plans read."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rollkeep.operators import compare, search
from rollkeep.sources import index, log
from rollkeep.sources.store import Store
from test_commits import DAY, put

SCHEMA = "fixed_ref string, primary_name string, aliases array<struct<name:string>>"


@pytest.fixture(scope="module")
def names():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcÉdé%_") for _ in range(rng.randrange(1, 7)))
    rows = [(f"{k:04}", " ".join(word() for _ in range(rng.randrange(1, 4))).upper() if k % 50 else None, [(word() if j else " ".join([word(), word()]),) for j in range(rng.randrange(3))]) for k in range(900)]
    return rows + [("0007", "Zwei", []), ("é1", "", [("",)]), ("x", "ab", None), ("y", "limited", [("x",)])]


def opened(spark, names, tmp_path, monkeypatch, given=1000):
    monkeypatch.setattr(index, "IN_FILE", 100)
    monkeypatch.setattr(index, "IN_BUCKET", 200)
    monkeypatch.setattr(index, "GIVEN", given)
    rows = search.with_search_columns(spark.createDataFrame(names, SCHEMA))
    assert index.write(rows, str(tmp_path / "i")) == len(names)
    return rows, index.Index(spark, str(tmp_path / "i"))


@pytest.mark.parametrize("given", [1000, 5])
def test_search(given, spark, names, tmp_path, monkeypatch):
    """Queries of any length and signs: the rows of a scan, with few candidates and with many."""
    rows, held = opened(spark, names, tmp_path, monkeypatch, given)
    plain = [(r.fixed_ref, r.primary_name, r.primary_name_lower, r.alias_search) for r in rows.collect()]
    for query in ("ABC", "a", "éd", "%_", "b c", "bcéd", "limited", "none of them", "cÉ\n", "ab\na"):
        got = sorted((r.fixed_ref, r.primary_name or "") for r in held.search(query).collect())
        want = sorted((f, p or "") for f, p, low, alias in plain if query.lower() in (low or "") or query.lower() in (alias or ""))
        assert got == want, query
    assert held.search("abc").columns == rows.columns


def test_pages(spark, names, tmp_path, monkeypatch):
    """Any page is that of a scan and opens only the files that hold it; the total needs none."""
    rows, held = opened(spark, names, tmp_path, monkeypatch)
    keys = sorted(n[0] for n in names)
    assert held.total() == len(keys) and len(held.files) > 5
    for offset, limit in ((0, 10), (95, 10), (450, 120), (len(keys) - 3, 10), (len(keys) + 5, 10)):
        page = held.page(offset, limit)
        assert [r.fixed_ref for r in page.collect()] == keys[offset : offset + limit]
    for last in (None, "0100", "0855", "y", "é1"):
        assert [r.fixed_ref for r in held.page_after(last, 30).collect()] == [k for k in keys if last is None or k > last][:30]
    opened_files = {r.f for r in held.page(455, 20).select(F.input_file_name().alias("f")).collect()}
    assert len(opened_files) <= 2


def test_search_reads_little(spark, names, tmp_path, monkeypatch):
    """A search of a rare name opens the buckets of its grams, and of the records only the file that holds the hit."""
    _, held = opened(spark, [*names, ("0500x", "Quixote Zyx", [])], tmp_path, monkeypatch)
    lists = held._lists(["qui", "uix"])
    assert {r.part for r in lists.select("part").distinct().collect()} <= set(index.buckets_of(["qui", "uix"], held.buckets)) and held.buckets > 3
    hit = held.search("QUIXOTE")
    assert [r.fixed_ref for r in hit.collect()] == ["0500x"]
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*part#\d+ (IN|=|INSET)", plan) and re.search(r"PushedFilters: \[.*(In|EqualTo)\(fixed_ref", plan), plan
    assert plan.count("FileScan") == 1


def test_changes_read_what_differs(spark, names, tmp_path, monkeypatch):
    """One record that is changed, one that is gone, and one that is new among many: the files around them alone are opened, and the rows are those of a whole comparison."""
    monkeypatch.setattr(index, "IN_FILE", 50)
    rows = search.with_search_columns(spark.createDataFrame([n for n in names if n[0] != "0007" or n[1] == "Zwei"], SCHEMA))
    cut = next(r.fixed_ref for r in rows.orderBy("fixed_ref").offset(400).collect() if zlib.crc32(r.fixed_ref.encode()) % 50 == 0)  # a key that files are cut before
    new = rows.where(F.col("fixed_ref") != cut).withColumn("primary_name", F.when(F.col("fixed_ref") == "0100", "changed").otherwise(F.col("primary_name")))
    new = new.unionByName(rows.where("fixed_ref = '0100'").withColumn("fixed_ref", F.lit("0777x")))
    for name, version in (("old", rows), ("new", new.orderBy(F.rand(3)).repartition(5)), ("same", rows.orderBy(F.rand(4)))):
        index.write(version, str(tmp_path / name))
    old, new_, same = (index.Index(spark, str(tmp_path / n)) for n in ("old", "new", "same"))
    mine, yours = index.differing(old, new_)
    assert len(old.files) > 8 and 0 < len(mine) <= 4 and 0 < len(yours) <= 3 and index.differing(old, same) == ([], [])
    got = sorted((r.fixed_ref, r.change) for r in index.changes(old, new_).collect())
    assert got == sorted([("0100", "MODIFIED"), ("0777x", "ADDED"), (cut, "REMOVED")])
    assert got == sorted((r.fixed_ref, r.change) for r in compare.diff(rows, new).collect())
    assert index.changes(old, same).count() == 0


def test_empty_index(spark, tmp_path):
    rows = search.with_search_columns(spark.createDataFrame([], SCHEMA))
    assert index.write(rows, str(tmp_path / "i")) == 0
    held = index.Index(spark, str(tmp_path / "i"))
    assert (held.total(), held.page(0, 5).count(), held.page_after(None, 5).count(), held.search("abc").count()) == (0, 0, 0, 0)


def test_store_index(spark, tmp_path):
    """The store opens the version that is CURRENT at the time of the call."""
    store = Store(spark, str(tmp_path / "s"))
    assert store.index("SDN") is None
    put(store, "a", ("Ivan Petrov", "Acme")), put(store, "b", ("Ivan Petrov", "Acme Two"))
    store.activate("SDN", DAY, "a")
    held = store.index("SDN")
    store.activate("SDN", DAY, "b")
    assert [r.primary_name for r in held.search("acme").collect()] == ["Acme"]
    assert [r.primary_name for r in store.index("SDN").search("ACME").collect()] == ["Acme Two"]
    assert [r.primary_name for r in store.index("SDN").page(0, 1).collect()] == ["Ivan Petrov"]


TEXTS = [(1, "Paid to Ivan  Petrov, today"), (2, "ivan petrov"), (3, "xivan petrovx and a.b%c_d"), (4, None), (5, ""), (6, "a\tb\nivan"), (7, "ÉCOLE de Paris"), (8, "Beta limited"), (9, "alpha limited")]
NEEDLES = ["Ivan Petrov", "van", "a", "%", "c_d", "b\nI", "o i", " ", "", None, "École DE", "zzz", "petrov", "a limited", "to", "to zz", "pha lim"]


def test_text_index(spark, tmp_path):
    """Texts added in batches, one of them twice and one while it is screened: as a plain search, and as screening all at once."""
    frame = lambda rows: spark.createDataFrame(rows, "id long, note string")
    needles = spark.createDataFrame([(n,) for n in NEEDLES], "n string")
    held = index.TextIndex(spark, str(tmp_path / "t"), buckets=3)
    assert held.screen(frame(TEXTS), "id", "note", needles, "n").count() == 0
    assert held.add(frame(TEXTS[:4]), "id", "note", "one") and not held.add(frame(TEXTS[:4]), "id", "note", "one") and held.add(frame(TEXTS[4:]), "id", "note", "two")
    want = {(i, n.lower()) for i, t in TEXTS for n in NEEDLES if t and n and n.strip() and n.lower() in t.lower()}
    for found in (held.screen(frame(TEXTS), "id", "note", needles, "n"), search.screen(frame(TEXTS), "id", "note", needles, "n")):
        rows = [(r.id, r.needle) for r in found.collect()]
        assert set(rows) == want and len(rows) == len(want)
    assert {n for n in log.names_in(spark, held.folder)} == {"batch=one", "batch=two"}


def test_text_index_dealt(spark, tmp_path):
    """Words are written by as many tasks as cut them, whatever the buckets, and batches that are not asked for are not screened."""
    texts = spark.range(0, 600, 1, 12).select("id", F.concat(F.lit("word"), "id", F.lit(" ivan")).alias("note"))
    held = index.TextIndex(spark, str(tmp_path / "t"), buckets=1)
    for batch, part in (("one", texts.where("id < 300")), ("two", texts.where("id >= 300"))):
        held.add(part, "id", "note", batch)
    words = spark.read.parquet(f"{held.folder}/batch=one/table=words")
    assert len(words.inputFiles()) >= 6 and words.count() == 600
    found = held.screen(texts, "id", "note", spark.createDataFrame([("IVAN",)], "n string"), "n", ["two"])
    assert sorted(r.id for r in found.collect()) == list(range(300, 600))


def test_shared_word_costs_nothing(spark, monkeypatch):
    """Texts and needles that share a word but no other: no pair is made to be compared."""
    n, pairs = 2000, []
    texts = spark.range(n).select("id", F.concat(F.lit("alpha"), "id", F.lit(" limited")).alias("note"))
    needles = spark.range(n).select(F.concat(F.lit("omega"), "id", F.lit(" limited")).alias("name"))
    kept = search.confirmed
    monkeypatch.setattr(search, "confirmed", lambda met, *rest: pairs.append(met.count()) or kept(met, *rest))
    assert search.screen(texts, "id", "note", needles, "name").count() == 0 and pairs == [0]
    both = needles.unionByName(spark.createDataFrame([("alpha7 limited",), ("pha12",)], "name string"))
    assert {(r.id, r.needle) for r in search.screen(texts, "id", "note", both, "name").collect()} == {(7, "alpha7 limited")} | {(int(k), "pha12") for k in map(str, range(n)) if k.startswith("12")}
    assert pairs[-1] < 400
