"""Raw bytes in chunks: the same bytes back whatever they are, digests of chunks and files, and what changed by name."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rollkeep.plans import catalog
from rollkeep.plans.cycle import run_cycle
from rollkeep.sources import chunks
from rollkeep.sources.store import Store
from test_snapshots import XML, landed, sha

CASES = {
    "ends with it": b"<a>bc</a>" * 40,
    "ends without": b"<a>bc</a>\n" * 40 + b"tail",
    "mark": b"\xef\xbb\xbf" + b"x>y\r\n>" * 90,
    "mark alone at the end": b"\xef\xbb\xbf" + b"x>y" * 90,
    "no separator": bytes(range(256)).replace(b">", b"") * 3,
    "separators": b">" * 257,
    "one chunk": b"<a/>",
    "whole chunks": b"0123456>" * 50,
    "not text": random.Random(1).randbytes(3000),
}


@pytest.mark.parametrize("wide", [None, "70"])
def test_bytes_back(wide, spark, tmp_path):
    """Every file, read in one range or many, cut at the same places."""
    folder = tmp_path / "in"
    folder.mkdir()
    for name, data in CASES.items():
        (folder / f"{name}.bin").write_bytes(data)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    if wide:
        spark.conf.set("spark.sql.files.maxPartitionBytes", wide)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        held = chunks.take_in(spark, str(folder), str(tmp_path / "out"), size=100)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    got, said = {}, {}
    for r in held.chunks.collect():
        got.setdefault(r.path.rpartition("/")[2].removesuffix(".bin").replace("%20", " "), {})[r.number] = bytes(r.content)
    for r in held.manifest.collect():
        said[r.path.rpartition("/")[2].removesuffix(".bin").replace("%20", " "), r.number] = (r.length, r.sum)
    for name, data in CASES.items():
        assert [got[name][k] for k in sorted(got[name])] == [data[k : k + 100] for k in range(0, len(data), 100)], name
        assert said[name, chunks.WHOLE] == (len(data), hashlib.sha256(data).hexdigest())
        assert all(said[name, k] == (len(c), hashlib.sha256(c).hexdigest()) for k, c in got[name].items())
    assert len(said) == sum(len(g) + 1 for g in got.values())
    assert chunks.changed_chunks(held.chunks, held.manifest).count() == 0


def test_what_changed(spark, tmp_path):
    """A flipped byte, a lost, a doubled and a new chunk are named; the place is taken once."""
    (tmp_path / "x.bin").write_bytes(b"0123456>" * 100)
    held = chunks.take_in(spark, str(tmp_path / "x.bin"), str(tmp_path / "out"), size=100)
    assert [r.number for r in chunks.restored(held, held.chunks.first().path).collect()] == list(range(8))
    flipped = F.when(F.col("number") == 3, F.encode(F.translate(F.decode("content", "UTF-8"), "0", "1"), "UTF-8")).otherwise(F.col("content"))
    rot = held.chunks.withColumn("content", flipped).where("number <> 5")
    rot = rot.unionByName(held.chunks.where("number = 6")).unionByName(held.chunks.where("number = 0").withColumn("number", F.lit(99).cast("long")))
    assert sorted((r.number, r.why) for r in chunks.changed_chunks(rot, held.manifest).collect()) == [(3, "CHANGED"), (5, "MISSING"), (6, "TWICE"), (99, "EXTRA")]
    assert chunks.keep(spark, held, str(tmp_path / "out" / "place"))
    again = chunks.take_in(spark, str(tmp_path / "x.bin"), str(tmp_path / "out"), size=70)
    assert not chunks.keep(spark, again, str(tmp_path / "out" / "place"))
    assert chunks.opened(spark, str(tmp_path / "out" / "place")).chunks.count() == 8


def test_cycle_keeps_chunks(spark, tmp_path, monkeypatch):
    """The cycle stores chunks once, leaves nothing aside, and a version whose chunk rots is named, flagged and stays out."""
    monkeypatch.setattr(chunks.take_in, "__defaults__", (">", 500))
    store = Store(spark, str(tmp_path / "store"))
    texts = [XML.replace("ACME", f"ACME {k}") for k in range(4)]
    out = [run_cycle(spark, store, "SDN", landed(tmp_path, t, f"{k}.xml"), sha(t)) for k, t in enumerate(texts)]
    assert [o.status for o in out] == ["ACTIVATED"] * 4
    assert run_cycle(spark, store, "SDN", landed(tmp_path, texts[0][:-5], "cut.xml"), sha(texts[0][:-5])).cause == "MALFORMED_XML"
    root = tmp_path / "store" / "raw_chunks"
    assert [p.name for p in root.iterdir()] == ["source_list=SDN"]
    place = root / "source_list=SDN" / f"publish_date={out[0].publish_date}" / f"digest={sha(texts[0])}"
    held = chunks.opened(spark, str(place))
    assert b"".join(bytes(r.content) for r in chunks.restored(held, held.chunks.first().path).collect()).decode() == texts[0]
    assert [(r.digest, r.ok) for r in store.check_cold("SDN").collect()] == [(sha(texts[0]), True)]
    rows = held.chunks.withColumn("content", F.when(F.col("number") == 2, F.lit(b"rot")).otherwise(F.col("content"))).collect()
    for f in (place / "table=chunks").iterdir():
        f.unlink()
    spark.createDataFrame(rows, chunks.CHUNK).write.mode("append").parquet(str(place / "table=chunks"))
    assert [(r.number, r.why) for r in store.changed_chunks(store.versions()).collect()] == [(2, "CHANGED")]
    assert [(r.digest, r.ok) for r in store.check_cold("SDN").collect()] == [(sha(texts[0]), False)]
    assert not store.activate("SDN", out[0].publish_date, sha(texts[0])) and store.activate("SDN", out[1].publish_date, sha(texts[1]))


def test_digest_without_content(spark, tmp_path):
    """The digest of a file is taken in chunks by a task; the driver gets the digest alone."""
    for name, data in CASES.items():
        (tmp_path / name).write_bytes(data)
        assert chunks.digest_of(spark, str(tmp_path / name)) == hashlib.sha256(data).hexdigest(), name


def test_files_of_many_keys_are_written_by_many_tasks(spark):
    """Rows of a table that one task reads are dealt over all before each becomes a file."""
    rows = spark.range(0, 400, 1, 1).withColumnRenamed("id", "s_suppkey")
    own = catalog.dealt(rows, "s_suppkey").groupBy(F.spark_partition_id()).count().collect()
    assert len(own) > 1 and max(r["count"] for r in own) < 400
