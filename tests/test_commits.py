"""Logs, batches and the store with writers that run at once, crash, or repeat what they did."""

import hashlib
import json
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from rollkeep import schemas
from rollkeep.operators import versions
from rollkeep.sources import log
from rollkeep.sources.store import Store
from rollkeep.streaming import ingest
from test_snapshots import XML, sha

DAY = date(2026, 1, 1)


def put(store, digest, names=("a",)):
    rows = store.spark.createDataFrame([(str(k), n) for k, n in enumerate(names)], "fixed_ref string, primary_name string")
    kinds = {f.split(" ")[0]: f.split(" ", 1)[1] for f in schemas.top_level(schemas.RECORD_FIELDS)}
    rows = rows.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in rows.columns})
    return store.put_isolated(rows, "SDN", DAY, digest, {"record_count": len(names), "out_of_scope_count": 0, "expected_count": len(names)}, "-")


def at_once(jobs):
    out, start = [None] * len(jobs), threading.Barrier(len(jobs))

    def run(k):
        start.wait()
        out[k] = jobs[k]()

    threads = [threading.Thread(target=run, args=(k,)) for k in range(len(jobs))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(240)
    return out


def test_log(spark, tmp_path, monkeypatch):
    """Numbers follow each other without gaps, readers keep what they saw, and gathered commits read alike."""
    monkeypatch.setattr(log, "EVERY", 4)
    book = log.Log(spark, str(tmp_path / "log"), "who string, n int")
    assert book.last() == 0 and book.read().count() == 0 and book.append(lambda rows: None) is None
    for k in range(9):
        assert book.append(lambda rows, k=k: [{"who": "é", "n": k}, {"who": None, "n": rows.count()}]) == k + 1
    seen = book.read(6)
    assert [r.n for r in book.read().where("who is null").orderBy("number").collect()] == list(range(0, 18, 2))
    assert seen.count() == 12 and sorted(r.n for r in seen.where("who is not null").collect()) == list(range(6))
    assert [n for n in log.names_in(spark, book.folder) if n.endswith(".table")] == [f"{n:020}.table" for n in (4, 8)]
    assert len(book.read().inputFiles()) == 1
    assert not log.created(spark, f"{book.folder}/{3:020}.json", "x") and book.read().count() == 18
    assert not [n for n in log.names_in(spark, book.folder) if n.startswith(".0")]


def test_log_under_contention(spark, tmp_path):
    """Many writers: every commit has its own number and saw all before it."""
    book = log.Log(spark, str(tmp_path / "log"), "who int, seen long")
    done = at_once([lambda w=w: [book.append(lambda rows: [{"who": w, "seen": rows.count()}]) for _ in range(3)] for w in range(4)])
    assert sorted(n for numbers in done for n in numbers) == list(range(1, 13))
    assert [r.seen for r in book.read().orderBy("number").collect()] == list(range(12))


def test_activations_at_once(spark, tmp_path):
    """Writers that activate and roll back at once: none is lost, no seq is taken twice, and the pointers are those of some order."""
    store = Store(spark, str(tmp_path / "store"))
    for d in "abcd":
        assert put(store, d) and store.activate("SDN", DAY, d)
    assert at_once([lambda d=d: store.activate("SDN", DAY, d) for d in "abcd"] + [lambda: store.rollback("SDN")]) == [True] * 4 + ["ACTIVATED"]
    rows = store.activations().orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(1, 10)) and versions.seq_conflicts(store.activations()).count() == 0
    back = [k for k in range(4, 9) if sorted(r.digest for j, r in enumerate(rows[4:], 4) if j != k) == list("abcd")]
    assert any(rows[k].digest == rows[k - 2].digest for k in back)
    assert {r.pointer: r.digest for r in store.trio().collect()} == dict(zip(versions.POINTERS, [r.digest for r in rows[:-4:-1]], strict=True))


def test_one_version_put_twice_at_once(spark, tmp_path):
    """Of writers that put the same version one wins; its records are read once, and what a lost or dead attempt wrote never is."""
    store = Store(spark, str(tmp_path / "store"))
    assert sorted(at_once([lambda: put(store, "a", ("x", "y"))] * 3)) == [False, False, True]
    assert store.versions().count() == 1 and store.records().count() == 2 and store.count("SDN", DAY, "a") == 2
    dead = store._folder("SDN", DAY, "b", "dead")
    store.version_records("SDN", DAY, "a").drop("source_list", "publish_date", "digest").withColumn("part", F.lit(0)).write.partitionBy("part").parquet(f"{dead}/table=rows")
    assert store.records().count() == 2 and not store.has("SDN", DAY, "b") and not store.activate("SDN", DAY, "b")
    assert dead in store.leftovers() and all("attempt=" in f for f in store.leftovers())
    assert put(store, "b", ("z",)) and [r.primary_name for r in store.version_records("SDN", DAY, "b").collect()] == ["z"]


def test_batches(spark, tmp_path):
    """A batch is there once, and whole: not while it is written, nor if its writer dies."""
    out = str(tmp_path / "out")
    rows = spark.range(5)
    assert sorted(at_once([lambda: log.put_batch(rows, out, "q-1")] * 3)) == [False, False, True]
    assert not log.put_batch(rows, out, "q-1") and log.put_batch(rows, out, "q-2")
    bad = rows.select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        log.put_batch(bad, out, "q-3")
    got = spark.read.parquet(out)
    assert got.count() == 10 and {r.batch for r in got.select("batch").distinct().collect()} == {"q-1", "q-2"}
    assert log.put_batch(rows, out, "q-3") and spark.read.parquet(out).count() == 15


def test_changes_once(spark, tmp_path):
    store, out = Store(spark, str(tmp_path / "store")), str(tmp_path / "changes")
    assert not ingest.append_changes(store, "SDN", out)
    put(store, "a", ("x", "y")), put(store, "b", ("x", "z"))
    for d, wanted in (("a", True), ("b", True), ("a", True)):
        store.activate("SDN", DAY, d)
        assert ingest.append_changes(store, "SDN", out) == wanted and not ingest.append_changes(store, "SDN", out)
    got = sorted((r.batch, r.fixed_ref, r.change) for r in spark.read.parquet(out).collect())
    assert got == [("SDN-1", "0", "ADDED"), ("SDN-1", "1", "ADDED"), ("SDN-2", "1", "MODIFIED"), ("SDN-3", "1", "MODIFIED")]
    assert not ingest.append_changes(store, "SDN", out, seq=2) and not ingest.append_changes(store, "SDN", out, seq=9)


def test_streams_replay(spark, tmp_path):
    """A stream that dies after its sink wrote, before its checkpoint says so, writes the batch again; readers see it once."""
    store = Store(spark, str(tmp_path / "store"))
    put(store, "a", ("ivan petrov",)), store.activate("SDN", DAY, "a")
    events, hits, point = (str(tmp_path / n) for n in ("events", "hits", "point"))
    schema = "id long, note string"
    spark.createDataFrame([(1, "to Ivan Petrov"), (2, "x")], schema).write.parquet(events)
    run = lambda: ingest.screen_stream(spark.readStream.schema(schema).parquet(events), "id", "note", store, "SDN", hits, point).awaitTermination(120)
    run()
    for name in ("0", ".0.crc"):
        (tmp_path / "point" / "commits" / name).unlink()
    run()
    assert [(r.id, r.needle) for r in spark.read.parquet(hits).collect()] == [(1, "ivan petrov")]
    spark.createDataFrame([(3, "ivan petrov")], schema).write.mode("append").parquet(events)
    run()
    assert sorted(r.id for r in spark.read.parquet(hits).collect()) == [1, 3]


def test_manifest_by_path(spark, tmp_path):
    """Files of one name in two folders have rows of their own; the row that was written last counts."""
    files = spark.createDataFrame([("file:/in/x/sdn.xml",), ("file:/in/y/sdn.xml",), ("file:/in/z.xml",), ("file:/in/none.xml",)], "path string")
    said = [("x/sdn.xml", 1, "x"), ("y/sdn.xml", 1, "y"), ("y/sdn.xml", 2, "a"), ("sdn.xml", 9, "any"), ("file:///in/z.xml", 1, "z"), ("dn.xml", 9, "no")]
    got = ingest.advertised(files, spark.createDataFrame(said, "path string, when int, digest_header string"))
    assert {r.path: r.digest_header for r in got.collect()} == {"file:/in/x/sdn.xml": "x", "file:/in/y/sdn.xml": "a", "file:/in/z.xml": "z", "file:/in/none.xml": None}


def test_two_deliveries_of_one_name(spark, tmp_path):
    store, said = Store(spark, str(tmp_path / "store")), tmp_path / "manifest"
    said.mkdir()
    new = XML.replace("ACME", "ACME TWO")
    for folder, text in (("one", XML), ("two", new)):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "sdn.xml").write_text(text)
    rows = [{"path": "one/sdn.xml", "digest_header": sha(XML)}, {"path": "two/sdn.xml", "digest_header": hashlib.sha256(new.encode()).hexdigest()}]
    (said / "1.json").write_text("\n".join(map(json.dumps, rows)))
    ingest.ingest(spark, store, str(tmp_path / "in" / "*"), str(tmp_path / "point"), str(said)).awaitTermination(240)
    assert [r.status for r in spark.read.parquet(f"{store.folder}/outcomes").collect()] == ["ACTIVATED"] * 2
