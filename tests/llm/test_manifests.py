"""Periodic runs, Merkle proofs and shards against brute force and SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollkeep.llm import merkle, periodic_runs, queries, ranks, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string, last int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op12_merkle", "op13_sharding"])
def test_against_sql(name, spark, small):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{small}/documents.parquet'")
    got = queries.queries()[name](spark, small)
    wanted = db.sql(queries.oracle_sql()[name])
    assert got.columns == wanted.columns
    assert sorted(map(tuple, got.collect())) == sorted(wanted.fetchall())


def test_numbered(spark):
    """Groups over several partitions, of one row, null, and repeated rows."""
    rng = random.Random(3)
    rows = [(rng.choice([None, "b", "ä", "Z", f"one{i}"]), rng.randrange(50), i) for i in range(400)] + [("b", 7, k) for k in range(900)]
    got = ranks.numbered(spark.createDataFrame(rows, "source string, v int, id int").repartition(5), "source", ["v"])
    assert (got.rows, got.groups) == (len(rows), len({r[0] for r in rows}))
    found = sorted(got.frame.collect(), key=lambda r: (r.group, r.place))
    order = sorted({r[0] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    assert [(r.source, r.v) for r in found] == sorted([r[:2] for r in rows], key=lambda r: (order.index(r[0]), r[1]))
    for k, r in enumerate(found):
        first = k == 0 or found[k - 1].group != r.group
        assert r.place == (0 if first else found[k - 1].place + 1) and r.group == order.index(r.source)
        assert r.last == (k + 1 == len(found) or found[k + 1].group != r.group)
    assert sorted(r.id for r in found) == sorted(r[2] for r in rows)
    empty = ranks.numbered(spark.createDataFrame([], "v int"), None, ["v"])
    assert (empty.rows, empty.groups, empty.frame.count()) == (0, 0, 0)


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def brute_proofs(rows, tampered):
    """{(doc_id, text): set of results} by the whole trees."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(part, (r[0], r[3], r[2], r[4], text))))
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = [tree([leaf(r, r[1]) for r in groups[k]]) for k in keys]
    top = tree([t[-1][0] for t in trees])
    out = []
    for s, k in enumerate(keys):
        for i, r in enumerate(groups[k]):
            now, others = leaf(r, tampered(r) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[1]), ""
            for levels, at in ((trees[s], i), (top, s)):
                for level in levels[:-1]:
                    run, own = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    others += "".join(run[:own] + run[own + 1 :])
                    now, at = sha("".join(run[:own] + [now] + run[own + 1 :])), at // 16
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], sha(others), now, now == top[-1][0]))
    return out


@pytest.mark.parametrize("sources", [("a",), (None, "a", "Ä", "b"), tuple(f"s{i}" for i in range(300))])
def test_proofs(sources, spark, tmp_path):
    """One group of five levels, several, and many of few rows; nulls, empty and long texts, repeated rows, and columns with names of our own."""
    rng = random.Random(len(sources))
    rows = [(i, rng.choice(["Aé", "x", "Lower", "B" * 30_000 if i < 3 else "B"]), "en", sources[0] if i % 3 else rng.choice(sources), i, "own", 1) for i in range(4300 if len(sources) < 9 else 700)]
    rows += [(None, "A", None, sources[-1], None, None, None), (None, None, None, sources[0], None, None, None), (5, "", "de", sources[0], 0, "x", 2), (9, "Z", "de", sources[0], 0, "x", 2), (9, "Z", "de", sources[0], 0, "x", 2), (10, None, "de", "lone", 1, "x", 2)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op12_merkle(spark, str(tmp_path)).collect()), key=str)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert got == sorted(brute_proofs(rows, lambda r: r[1] and r[1].translate(lower)), key=str)
    assert {True, False} == {r[-1] for r in got}


def test_proofs_small(spark):
    make = lambda rows: merkle.proofs(spark.createDataFrame(rows, SCHEMA), ["doc_id", "text"], "source", "doc_id")
    assert make([]).count() == 0
    lone = make([(1, "x", None, None, None, None, None)]).first()
    assert lone.leaf == lone.subroot == lone.root == lone.folded_root == sha("1:11:x") and lone.path == [] and lone.verified
    two = make([(1, "x", None, "s", None, None, None), (2, "y", None, "s", None, None, None)]).collect()
    assert {r.root for r in two} == {sha(sha("1:11:x") + sha("1:21:y"))} and all(len(r.path) == 1 for r in two)


def test_proofs_partitions(spark, monkeypatch):
    """Levels and jumps do not add up their partitions."""
    made, kept = [], merkle.checkpointed
    monkeypatch.setattr(merkle, "checkpointed", lambda df: made.append(kept(df)) or made[-1])
    rows = spark.createDataFrame([(i, "x", None, f"s{i % 20}", None, None, None) for i in range(400)], SCHEMA).coalesce(1)
    found = merkle.proofs(rows, ["doc_id", "text"], "source", "doc_id")
    assert found.where("verified").count() == 400
    assert max(df.rdd.getNumPartitions() for df in made) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 1000, 4097, 65536])
def test_permutation(n):
    numbers = np.arange(n)
    image = sharding.permuted(numbers, n, 7)
    assert sorted(image.tolist()) == numbers.tolist()
    assert (sharding.permuted(image, n, 7, back=True) == numbers).all()
    if n > 100:
        assert abs(np.corrcoef(numbers, image)[0, 1]) < 0.15 and (image != sharding.permuted(numbers, n, 8)).mean() > 0.9


def test_shards(spark):
    rows = [(i % 700 if i % 9 else None, ["x", None, "", "é" * 40_000 if i < 2 else "é"][i % 4], None, None, None, "mine", 3) for i in range(1000)] + [(3, "x", None, None, None, "mine", 3)] * 40
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sharding.shuffled(docs, 24, seed=5).collect()
    again = sharding.shuffled(docs.orderBy(F.rand(1)).repartition(7), 24, seed=5).collect()
    plain = lambda rows: sorted(map(tuple, rows), key=str)
    assert plain(got) == plain(again)
    n, counts = len(rows), {}
    for r in got:
        counts.setdefault(r.shard, []).append(r.slot)
        assert sharding.row_of(r.shard, r.slot, n, 24, seed=5) == r.row
    assert set(counts) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    size = lambda text: (8 + len((text or "").encode()), zlib.crc32((text or "").encode()))
    assert plain((r.doc_id, r.size, r.text_crc32) for r in got) == plain((r[0], *size(r[1])) for r in rows)
    order = [r.doc_id for r in sorted(got, key=lambda r: r.row)]
    assert order == sorted(order, key=lambda k: (k is not None, k or 0))
    assert sharding.shuffled(docs.limit(0), 24).count() == 0
    with pytest.raises(ValueError):
        sharding.row_of(0, n, n, 24)
    with pytest.raises(ValueError):
        sharding.shuffled(docs, 0)


def brute_runs(words):
    """(start, length, period) of all runs, by every period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_random():
    """Few different words, periodic tails with faults, several texts at a time, and parts that hold one text or less."""
    rng = random.Random(5)
    for _ in range(400):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            n, kinds = rng.randrange(rng.choice([1, 10, 40, 150])), rng.choice([1, 2, 2, 3, 5, 30])
            words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), 1 + n // rng.randrange(3, 11)
                words = [words[i] if i < a or a + (i - a) % p >= n else words[a + (i - a) % p] for i in range(n)]
                for _ in range(rng.randrange(3)):
                    words[rng.randrange(n)] = "fault"
            docs.append(words)
        size, runs, left = periodic_runs._batch(pa.array([" ".join(w) for w in docs]))
        for words, n, got, kept in zip(docs, size.to_pylist(), runs.to_pylist(), left.to_pylist(), strict=True):
            want = brute_runs(words)
            assert n == len(words) and [(r["start"], r["length"], r["period"]) for r in got] == want and kept == collapsed(words, want)


def test_runs_once():
    """A long periodic text has a small grammar: each nonterminal is searched once, and few nodes stand for many places."""
    words = np.tile(np.arange(16), 2000)
    nodes = periodic_runs.derive(words, np.zeros(len(words), np.int64))
    assert nodes.count < 120 < sum(p.shape[1] for p in nodes.places)
    assert periodic_runs.runs_of(words, np.zeros(len(words), np.int64)).T.tolist() == [[0, len(words), 16]]


def test_runs_query(spark, small):
    """The query's digests of every document, planted ones too, by brute force; long periodic texts by their planted run."""
    rows = [r for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, small).collect()}
    assert len(got) == len(rows)
    planted = 0
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs = brute_runs(words)
        planted += bool(runs)
        x = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want = (len(runs), *x, 1000 * x[1] // x[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))
        assert tuple(got[r.doc_id])[1:] == want, r.doc_id
    assert planted > 30


def test_runs_edges(spark, monkeypatch):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "a " * 5, 0), (5, "a b " * 6, 0), (6, "é\x0bé\r" * 3, 0), (None, "x y " * 4, 1), (7, "q " * 200_000, 1), (7, "q " * 200_000, 1), (8, "é" * 100_000, 1), (9, "one two", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    monkeypatch.setattr(periodic_runs, "BYTES", 8)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(docs).collect()), key=str)
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 5, [], "a a a a a"), (5, 6, [(0, 6, 1)], "a b"), (6, 6, [(0, 6, 1)], "é"), (None, 8, [(0, 8, 2)], "x y"), *[(7, 200_000, [(0, 200_000, 1)], "q")] * 2, (8, 1, [], "é" * 100_000), (9, 2, [], "one two")]
    assert got == sorted(want, key=str)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
