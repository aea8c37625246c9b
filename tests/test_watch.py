"""Screening that remembers: replays add nothing, and an activation brings hits on old texts."""

from pyspark.sql import functions as F

from rollkeep.sources.store import Store
from rollkeep.streaming.watch import Watch
from test_commits import DAY, put


def test_watch(spark, tmp_path):
    store, events = Store(spark, str(tmp_path / "store")), str(tmp_path / "events")
    watch = Watch(store, "SDN", str(tmp_path / "watch"))
    schema = "id long, note string"
    follow = lambda: watch.follow(spark.readStream.schema(schema).parquet(events), "id", "note", str(tmp_path / "point")).awaitTermination(200)
    add = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(events)
    hits = lambda: sorted((r.id, r.needle, r.seq) for r in watch.hits().collect())
    add([(1, "to Ivan Petrov"), (2, "for Acme Ltd"), (3, None)])
    follow()
    assert hits() == [] and watch.texts().count() == 3  # no list is active yet
    put(store, "a", ("ivan petrov",)), put(store, "b", ("Ivan Petrov", "acme"))
    store.activate("SDN", DAY, "a")
    assert watch.catch_up() == 1 and hits() == [("1", "ivan petrov", 1)] and watch.catch_up() == 0
    add([(4, "IVAN PETROV and acme")])
    follow()
    assert hits() == [("1", "ivan petrov", 1), ("4", "ivan petrov", 1)]
    for name in ("1", ".1.crc"):  # the stream dies before it says that the batch is done
        (tmp_path / "point" / "commits" / name).unlink()
    follow()
    assert len(hits()) == 2 and watch.texts().count() == 4
    store.activate("SDN", DAY, "b")
    assert watch.catch_up() >= 1
    want = [("1", "ivan petrov", 1), ("2", "acme", 2), ("4", "acme", 2), ("4", "ivan petrov", 1)]
    assert hits() == want
    store.activate("SDN", DAY, "a"), store.activate("SDN", DAY, "b")
    watch.catch_up()
    assert hits() == want  # what was told once is not told again
    assert watch.take(spark.createDataFrame([(5, "acme")], schema), "id", "note", "by-hand") == 1
    assert watch.take(spark.createDataFrame([(5, "acme")], schema), "id", "note", "by-hand") == 0
    assert hits() == [*want, ("5", "acme", 4)] and watch.hits().where(F.col("id").isNull()).count() == 0
