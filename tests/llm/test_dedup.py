"""Dedup operators and URL filters against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rollkeep.llm import components, embedding_dedup, exact_dedup, filters, line_dedup, line_families, queries, simhash, url_filter


def groups(n, links):
    """The smallest place that links reach, for each place."""
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)] + [(500, 600 + i) for i in range(100)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups(800, links)
    assert all(want[k] == v for k, v in got.items())
    assert got.keys() == {x for a, b in links if a != b for x in (a, b)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_edges(spark):
    rows = [(1, "Ab", 0), (2, "aB", 0), (3, None, 0), (4, "", 0), (5, "Éa", 0), (6, "éa", 0), (None, "ab", 0), (7, "x", 0), (7, "x", 0), (None, "n", 0), (8, "z" * 200_000, 0)]
    docs = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, kept int, maybe string")
    out = exact_dedup.copies(docs)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in out.collect()), key=str)
    assert (False, 1, 2, 3, False) in got and (False, 2, 2, 3, True) in got and (True, 0, 2, 3, False) in got
    assert (False, 3, 4, 2, False) in got and (False, 5, 5, 1, True) in got and (False, 6, 6, 1, True) in got
    assert got.count((False, 7, 7, 2, True)) == 2 and (True, 0, None, 1, True) in got and len(got) == len(rows)
    assert {r.text_sha256 for r in out.where("doc_id = 1").collect()} == {hashlib.sha256(b"ab").hexdigest()}
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and {(r.kept, r.maybe) for r in kept.collect()} == {(0, "y")}
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in kept.collect()), key=key) == sorted((r.doc_id for r in out.where("kept").collect()), key=key)
    assert exact_dedup.copies(docs.limit(0)).count() == 0 and exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_filters(spark):
    """No value that is in a filter, or that repeats, is missed; most others are told apart, also where blocks are full."""
    ids = spark.range(3000).select(F.xxhash64("id").alias("h"))
    rows = ids.unionByName(spark.range(9000, 12000).select(F.xxhash64("id").alias("h")))
    for values in (3000, 300):
        held = filters.member_filter(ids, values).mark(rows, "h")
        assert held.where("maybe").join(ids, "h").count() == 3000
        assert held.where("not maybe").count() > (2950 if values == 3000 else 0)
    twice = rows.unionByName(ids.limit(500))
    marked = filters.repeat_filter(twice, 6500).mark(twice, "h")
    assert marked.where("maybe").join(ids.limit(500), "h").count() == 1000
    assert marked.where("not maybe").count() > 5300
    assert filters.member_filter(ids.limit(0), 0).mark(rows, "h").where("maybe").count() == 0
    assert filters.blocks_for(10**12) == filters.MOST


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_fingerprints():
    for text in ("", None, "a", "Hello  there", "A b\x0bc\x1cd e É É", " ".join(map(str, range(300)))):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("budget", [0, 1, 2])
def test_trie_pairs(budget):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fp = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for _ in range(8)]))
    for group, side in ((np.zeros(len(fp), int), np.zeros(len(fp), np.int8)), (rng.integers(0, 3, len(fp)), (rng.random(len(fp)) < 0.5).astype(np.int8))):
        x, y = simhash.trie_pairs(fp, group, side, budget)
        near = lambda i, j: int(fp[i] ^ fp[j]).bit_count() <= budget and group[i] == group[j]
        want = {(i, j) for i in range(len(fp)) for j in range(i) if near(i, j) and (not side.any() or side[i] != side[j])}
        assert {(max(p), min(p)) for p in zip(x.tolist(), y.tolist(), strict=True)} == want and len(x) == len(want)


def test_near_links_with_small_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 12)
    fp = np.unique(np.concatenate([base] + [base ^ (1 << rng.integers(0, 62, 12)) for _ in range(20)])).tolist()
    links = simhash.near_links(spark.createDataFrame([(x,) for x in fp], "fp long"), 2, block=5)
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    want = groups(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if ((fp[i] ^ fp[j]) & (2**64 - 1)).bit_count() <= 2])
    assert all(got.get(x, x) == fp[want[i]] for i, x in enumerate(fp))


def check_simhash(rows, docs):
    fps = [slow_fingerprint(t) for _, t in docs]
    order = sorted(range(len(docs)), key=lambda i: docs[i][0])
    values = [fps[i] for i in order]
    want = groups(len(order), [(i, j) for i in range(len(order)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2])
    wanted = {docs[order[i]][0]: (f"{values[i]:016x}", docs[order[want[i]]][0]) for i in range(len(order))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == wanted and len(rows) == len(docs)


def test_op9(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    check_simhash(queries.op9_simhash(spark, small).collect(), docs)


def test_simhash_edges(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(3, long), (5, long + " end"), (9, long.upper()), (11, None), (12, ""), (10, " \t"), (20, "other words entirely here")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    check_simhash(simhash.near_groups(docs).collect(), rows)
    kept = simhash.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in simhash.near_groups(docs).collect()}) and kept.columns == docs.columns
    nulls = spark.createDataFrame([(None, "a b c"), (None, "d e f"), (4, "a b c")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_groups(nulls).collect()) == [("4", "4"), ("None", "4"), ("None", "None")]
    assert simhash.keep_one(nulls).count() == 3
    assert simhash.near_groups(docs.limit(0)).count() == 0


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or {" ".join(w)}


def test_keep_one_drops_similar_texts(spark):
    """A changed word in 200 leaves one document; of a base and copies with a word changed, only the base stays; others all stay."""
    rng = random.Random(7)
    texts = []
    for _ in range(20):
        w = [f"w{rng.randrange(5000)}" for _ in range(200)]
        texts.append(" ".join(w))
        for k in rng.sample(range(10, 190), 9):
            texts.append(" ".join([*w[:k], "changed", *w[k + 1 :]]))
        texts.append(" ".join([*w[:100], *(f"v{rng.randrange(5000)}" for _ in range(100))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingle_set(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    want = groups(len(sets), links)
    assert {r.doc_id: r.component_id for r in simhash.similar_groups(docs, block=20).collect()} == dict(enumerate(want))
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted(set(want)) and len(set(want)) == 40


def test_trie_pairs_of_equal_values():
    fp = np.array([5, 5, 5, 4, 1 << 40], np.uint64)
    x, y = simhash.trie_pairs(fp, np.zeros(5, int), np.zeros(5, np.int8), 1)
    assert sorted((max(p), min(p)) for p in zip(x.tolist(), y.tolist(), strict=True)) == [(1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2)]


def check_vectors(rows, given, threshold=0.93):
    known = [(i, np.array(v, float), lab) for i, v, lab in given if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    known.sort(key=lambda r: r[0])
    links = [(a, b) for a in range(len(known)) for b in range(a) if known[a][2] == known[b][2] and len(known[a][1]) == len(known[b][1]) and known[a][1] @ known[b][1] / np.linalg.norm(known[a][1]) / np.linalg.norm(known[b][1]) >= threshold]
    n = np.bincount(np.array(links, int).reshape(-1), minlength=len(known))
    want = groups(len(known), links)
    wanted = {i: (0, i, True) for i, _, _ in given} | {k[0]: (int(n[j]), known[want[j]][0], want[j] == j) for j, k in enumerate(known)}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows} == wanted and len(rows) == len(given)


def test_op3(spark, small):
    given = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check_vectors(queries.op3_embedding_dedup(spark, small).collect(), given)


def test_vectors_edges(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((6, 16))
    near = [(i, [float(x) for x in base[i % 6] + 0.04 * rng.standard_normal(16)], i % 2) for i in range(60)]
    odd = [(100, None, 1), (101, [], 1), (102, [0.0] * 16, 1), (103, [float("nan")] * 16, 1), (104, [float("inf")] + [1.0] * 15, 1), (105, [None] + [1.0] * 15, 1), (106, near[0][1], None), (107, near[0][1], 0), (108, near[0][1], 0), (109, [2 * x for x in near[0][1]], 0), (110, near[0][1][:8], 0)]
    df = spark.createDataFrame([(*r, "x") for r in near + odd], "vec_id long, embedding array<float>, label int, rep string")
    given = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    for block in (3, 1000):
        check_vectors(embedding_dedup.near_vectors(df, block=block).collect(), given)
    # keys and labels of text, components near the ends of double precision, lengths mixed in one label
    extreme = [("a", [1e200, 1e200], "x"), ("b", [1e200, 1.01e200], "x"), ("c", [1e-200, 1e-200], "x"), ("d", [-1e-300, 1e-300], "x"), ("e", [1.0, 1.0, 0.0], "x"), ("f", [2.0, 2.0, 0.1], "x"), ("g", [1.0, 1.0], "y")]
    rows = embedding_dedup.near_vectors(spark.createDataFrame(extreme, "vec_id string, embedding array<double>, label string")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {"a": (2, "a"), "b": (2, "a"), "c": (2, "a"), "d": (0, "d"), "e": (1, "e"), "f": (1, "e"), "g": (0, "g")}
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_edit_distance(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(800):
        a = "".join(rng.choice("abé") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 20, 90])))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k, i = rng.random(), rng.randint(0, len(b))
            if k < 0.33:
                b.insert(i, rng.choice("abc"))
            elif b and k < 0.66:
                b.pop(min(i, len(b) - 1))
            elif b:
                b[min(i, len(b) - 1)] = rng.choice("abc")
        rows.append((a, "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    for most in (1, 2, 3):
        got = df.select(line_dedup.edit_distance(F.col("a"), F.col("b"), most).alias("d"), F.least(F.levenshtein("a", "b"), F.lit(most + 1)).alias("w"))
        assert got.where("d <> w or d is null").count() == 0


def slow_distance(a, b):
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def within(a, b, most):
    """Whether a and b are at most so many edits apart: every edit is tried where they first differ."""
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    if not a or not b or not most:
        return len(a) + len(b) <= most
    return within(a[1:], b[1:], most - 1) or within(a[1:], b, most - 1) or within(a, b[1:], most - 1)


def lines_wanted(docs, edits=2, per=10):
    """The fate of every line by place, by brute force over all pairs of lines."""
    strip = lambda x: x.strip(" \t\r\x0b\x0c")
    places = [((k is not None, k or 0, no), strip(line)) for k, t in docs if t is not None for no, line in enumerate(t.split("\n"))]
    first = {}
    for at, line in sorted(places):
        if line:
            first[line] = min(first.get(line, at), at)
    names = list(first)
    by_length = {}
    for i, x in enumerate(names):
        by_length.setdefault(len(x), []).append(i)
    links = []
    for n, short in by_length.items():
        most = min(edits, n // per)
        for d in range(most + 1 if most else 0):
            for j in by_length.get(n + d, ()):
                links += [(i, j) for i in short if (d or i < j) and within(names[i], names[j], most)]
    class_of = groups(len(names), links)
    head = {}
    for i, line in enumerate(names):
        head[class_of[i]] = min(head.get(class_of[i], first[line]), first[line])
    place = {line: i for i, line in enumerate(names)}
    return {at: "blank" if not line else "repeat" if first[line] != at else "near" if head[class_of[place[line]]] != at else "kept" for at, line in places}


def check_report(rows, docs, want):
    report = {r.doc_id: r for r in rows}
    assert report.keys() == {k for k, _ in docs} and len(rows) == len(report)
    by_key = {k: {} for k, _ in docs}
    for (named, k, no), fate in want.items():
        by_key[k if named else None][no] = fate
    for k, fates in by_key.items():
        n = lambda fate, fates=fates: sum(f == fate for f in fates.values())
        gone = ",".join(str(no) for no in sorted(fates) if fates[no] in ("repeat", "near"))
        assert (report[k].n_lines, report[k].n_kept, report[k].n_repeat, report[k].n_near, report[k].dropped_lines) == (len(fates) - n("blank"), n("kept"), n("repeat"), n("near"), gone)


def test_lines(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(6, 40))) for _ in range(60)]

    def changed(s):
        b = list(s)
        for _ in range(rng.randint(0, 4)):
            k, i = rng.random(), rng.randint(0, len(b) - 1)
            b[i : i + (k >= 0.33)] = [] if 0.33 <= k < 0.66 and len(b) > 1 else [rng.choice("abc")]
        return "".join(b)

    docs = [(i, "\n".join([changed(rng.choice(base)) for _ in range(rng.randint(0, 5))] + rng.choice([[], [""], ["x"], ["  x "], ["x\r"], ["\tx"]]))) for i in range(150)] + [(500, None), (501, ""), (None, base[0]), (502, "w" * 60_000 + "\n" + "w" * 59_999 + "v")]
    df = spark.createDataFrame([(*r, 1, "z") for r in docs], "doc_id long, text string, no int, line string")
    want = lines_wanted(docs[:-1]) | {(True, 502, 0): "kept", (True, 502, 1): "near"}
    got = {(r.key_ is not None, r.key_ or 0, r.no): r.fate for r in line_dedup.mark_lines(df).where("no is not null").collect()}
    assert got == want and {"near", "repeat", "kept", "blank"} == set(want.values())
    dropped = line_dedup.drop_lines(df)
    assert dropped.columns == df.columns
    out = {r.doc_id: r.text for r in dropped.collect()}
    for k, t in docs:
        wanted = None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if want[k is not None, k or 0, no] in ("kept", "blank"))
        assert out[k] == wanted
    check_report(line_dedup.line_report(df).collect(), docs, want)
    assert line_dedup.line_report(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "one line of text\nother"), (1, "one line of text\nother"), (2, "one line of text")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_lines, r.n_kept, r.dropped_lines) for r in line_dedup.line_report(twice).collect()) == [(1, 4, 4, ""), (2, 1, 0, "0")]


def test_op4(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check_report(queries.op4_line_dedup(spark, folder).collect(), docs, lines_wanted(docs))


def test_signatures_differ_in_two_bits_an_edit(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(500):
        a = "".join(rng.choice("etaoin srhlx") for _ in range(40))
        b = list(a)
        for _ in range(2):
            i = rng.randrange(len(b))
            b[i : i + rng.randint(0, 1)] = rng.choice(["", "e", "t", "x"])
        rows.append((a, "".join(b), slow_distance(a, "".join(b))))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    bits = F.bit_count(line_dedup.signature(F.col("a")).bitwiseXOR(line_dedup.signature(F.col("b"))))
    assert df.where(bits > 2 * F.col("d")).count() == 0


def test_family_links_reach_what_all_links_reach(spark):
    """Two edits in one or two places, at the ends and where equal heads and tails overlap; only links come out."""
    rng = random.Random(4)
    for letters, size, edits in (("ab", 19, 2), ("abcdef", 30, 2), ("abc", 11, 1)):
        names = {"".join(rng.choice(letters) for _ in range(size))}
        while len(names) < 160:
            x = list(rng.choice(sorted(names)[:20]))
            for _ in range(rng.randint(1, 4)):
                i = rng.randrange(len(x) + 1)
                x[i : i + rng.randint(0, 1)] = rng.choice(["", *letters])
            if len(x) >= 10:
                names.add("".join(x))
        names = sorted(names)
        links = [(i, j) for j in range(len(names)) for i in range(j) if within(names[i], names[j], min(edits, len(names[i]) // 10, len(names[j]) // 10))]
        rows = line_families.family_links(spark.createDataFrame([(i, len(x), x) for i, x in enumerate(names)], "id long, n int, line string"), edits, 10).collect()
        got = {(r.a, r.b) for r in rows}
        assert got <= set(links) and len(got) == len(rows)
        assert groups(len(names), got) == groups(len(names), links)


def test_families_do_not_meet_in_pairs(spark):
    """Lines of one family, told apart by no signature: candidates stay few, and fates are those of brute force."""
    rng = random.Random(5)
    base = "".join(rng.choice("etaoinsrhl ") for _ in range(150)).strip()
    names = set()
    while len(names) < 700:
        i = rng.randrange(len(base))
        x = base[:i] + "".join(rng.choice("bcdfgjkmpqu") for _ in range(4)) + base[i:]
        names |= {x, x.replace(base[40:42], "xy")} if rng.random() < 0.1 else {x}
    names = sorted(names)
    ids = spark.createDataFrame([(x,) for x in names], "line string").select(line_dedup.signature(F.col("line")).bitwiseOR(F.xxhash64("line").bitwiseAND((1 << line_dedup.HASH_BITS) - 1)).alias("id"), F.length("line").alias("n"), "line")
    assert line_dedup.near_lines(ids, 2, 10).count() < 10 * len(names)
    docs = list(enumerate(names))
    want = lines_wanted(docs)
    got = {(True, r.key_, r.no): r.fate for r in line_dedup.mark_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and list(want.values()).count("near") > 10


def test_families_have_as_many_partitions_as_they_need(spark, monkeypatch):
    """Rounds of the search for turns neither add up their partitions nor have those of the whole table."""
    made, kept = [], line_families.checkpointed
    monkeypatch.setattr(line_families, "checkpointed", lambda df: made.append(kept(df)) or made[-1])
    rng = random.Random(6)
    base = "".join(rng.choice("etaoinsrhl ") for _ in range(60))
    names = sorted({base[:i] + x + base[i:] for i in range(60) for x in "bcd"})
    distinct = spark.createDataFrame([(i, len(x), x) for i, x in enumerate(names)], "id long, n int, line string").repartition(3)
    found = line_dedup.near_lines(distinct, 2, 10)
    got = {(r.a, r.b) for r in found.collect()}
    assert len(made) > 8 and max(df.rdd.getNumPartitions() for df in made) == 1
    assert groups(len(names), got) == [0] * len(names)


def test_few_rows_do_not_run_in_all_partitions(spark):
    """Keys, candidates, links and nodes of a small table have few tasks, however many partitions a shuffle has."""
    rng = random.Random(9)
    lines = ["".join(rng.choice("etaoin srhlx") for _ in range(40)) for _ in range(60)]
    docs = [(i, "\n".join([lines[i], lines[i][:20] + "#" + lines[i][21:], lines[i - 1]])) for i in range(60)]
    wide = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    context, told = spark.sparkContext, spark.sparkContext.statusTracker()
    try:
        for k, v in wide.items():
            spark.conf.set(k, v)
        context.setJobGroup("few-rows", "")
        got = {(True, r.key_, r.no): r.fate for r in line_dedup.mark_lines(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)).collect()}
        stages = {s for j in told.getJobIdsForGroup("few-rows") for s in told.getJobInfo(j).stageIds}
        tasks = [i.numTasks for i in map(told.getStageInfo, stages) if i and i.numCompletedTasks]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == lines_wanted(docs)
    assert len(tasks) > 20 and sum(n >= 64 for n in tasks) < 30


def slow_verdict(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def test_urls(spark):
    rng = random.Random(1)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "ba.com", "com", "x.net", "net", "", "A.Com", "a.com:80", "a.com."]
    paths = ["", "/", "/en", "/en/", "/en/7", "/en/77/x", "/de/8", "/\u00e9/1", "/en/7?q=/de/", "#/en/", "?/en/"]
    urls = ["http://" + rng.choice(hosts) + rng.choice(paths) for _ in range(600)] + [None, "", "nothing", "http:/a.com/en/", "x://y://a.com/en/", "http://a.com/en/\n7", *["http://a.com/en/7"] * 50]
    rules = [("com", "/en/", "block"), ("a.com", "/en/7", "allow"), ("a.com", "/", "block"), ("b.a.com", "/en/", "allow"), ("net", "", "block"), ("a.com", "/\u00e9", "block"), ("com", "/en/77/x", "block")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rules_table(spark, rules)).collect()}
    assert got == {i: slow_verdict(u, rules) for i, u in enumerate(urls)}
    none = url_filter.judge(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "allow")} and none.count() == len(urls)
    assert url_filter.judge(pages.limit(0), url_filter.rules_table(spark, rules)).count() == 0


def test_simhash_budget(spark):
    """More bits than the meeting under two quarters can find are refused."""
    with pytest.raises(ValueError):
        simhash.near_links(spark.createDataFrame([(1,), (8,)], "fp long"), budget=3)


def test_url_rules_of_one_length(spark):
    """Of rules of equal length that fit, the one that sorts last decides, wherever its path begins."""
    rules = url_filter.rules_table(spark, [("b.com", "/xy", "block"), ("z.b.com", "/", "allow"), ("a.b.com", "/", "allow")])
    pages = spark.createDataFrame([(1, "http://z.b.com/xy1"), (2, "http://a.b.com/xy1"), (3, "http://b.com/xy"), (4, None)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got == {1: ("z.b.com/", "allow"), 2: ("b.com/xy", "block"), 3: ("b.com/xy", "block"), 4: (None, "allow")}


def test_contract_rules(spark, tmp_path):
    """The query's rules are those of its contract, word for word: a wide rule that allows, with a longer one below it that blocks."""
    urls = ["http://x.com/en/1", "http://example.com/en/71", "http://x.net/de/1", "http://a.example.net/de/81", "http://x.org/es/", "http://x.net/fr/"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.rule, r.verdict) for r in queries.op8_url_filter(spark, str(tmp_path)).collect()}
    assert got == {0: ("com/en/", "block"), 1: ("example.com/en/7", "allow"), 2: ("net/de/", "allow"), 3: ("example.net/de/8", "block"), 4: ("org/es/", "block"), 5: (None, "allow")}
