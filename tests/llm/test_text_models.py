"""Encoding, packing, language, toxicity and licenses against libraries, brute force and held-out rows."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from rollkeep.llm import bpe, language_id, license_scan, packing, queries, toxicity

RANKS = P.path("byte_bpe_50k.tiktoken")


def odd_texts(n=600):
    rng = random.Random(4)
    fixed = ["", " ", "  a", "a ", "x \n\n y", "\x1c\x1d a\x1cb \x85 c", "aaaa" * 120, "=-=" * 100, "it's we'll 'S", "日本語 é́ 🙂🙂", "\x00 \x00a", "<|endoftext|> a", "1234567890" * 20, "\n" * 300 + "x", "".join(rng.choice("abcdefgh") for _ in range(900))]
    return fixed + ["".join(rng.choice("ab \n\t's.é1  \x1c\xa0🙂") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_codec_equals_tiktoken():
    codec = bpe.Codec(RANKS, P.PATTERN, keep=50)
    model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = odd_texts()
    got = list(codec.encode(texts))
    assert got == [np.array(model.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert list(codec.decode(got)) == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        list(codec.decode([np.array([60_000], "<u4").tobytes()]))


def test_long_pieces():
    """Runs without a space of many kinds, long ones in little time: random letters, base64, digits, repeated signs, other scripts."""
    rng = random.Random(6)
    model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    letters = "abcdefghijklmnopqrstuvwxyz"
    base64 = letters + letters.upper() + "0123456789+/"
    texts = ["".join(rng.choice(a) for _ in range(n)) for a, n in ((letters, 8_000), (base64, 200_000), ("ab", 3_000), ("the", 5_000), ("日本語", 4_000), ("-=", 3_000))]
    texts += ["a" * 5_000, "=" * 5_000, "tion" * 900, "x" + "é" * 2_000]
    began = time.time()
    got = bpe.Merges.of(RANKS).encode(texts)
    assert time.time() - began < 120
    plain = tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    assert got == [np.array(plain.encode_ordinary(t), "<u4").tobytes() for t in texts]
    codec = bpe.Codec(RANKS, P.PATTERN)
    assert list(codec.encode(texts)) == [np.array(model.encode_ordinary(t), "<u4").tobytes() for t in texts]
    for t in texts:
        assert b"".join(bpe.Merges.of(RANKS).cuts(t.encode())) == t.encode()


def test_encode_decode_frames(spark):
    rows = [(1, "Hello  world", 5), (1, "Hello  world", 5), (None, None, None), (3, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    got = sorted((r.doc_id or 0, r.n_tokens, bytes(r.decoded)) for r in out.collect())
    assert got == [(0, 0, b""), (1, 3, b"Hello  world"), (1, 3, b"Hello  world"), (3, 0, b"")]
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_op1_digests(spark, small):
    model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.op1_bpe(spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = model.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_packing(spark, small):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert 50256 in model.encode("a <|endoftext|> b", add_special_tokens=False).ids
    extra = [(-1, None), (-2, ""), (-3, "a <|endoftext|> b"), (-5, "<|endoftext|>"), (-6, "x <|endoftext|><|endoftext|>\n y" * 900), (-4, "x" * 30_000 + " y" * 9_000)] + [(-10 - i, t) for i, t in enumerate(odd_texts(200))]
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = packing.pack(packing.cut(docs, P.path("byte_bpe_50k.json")), rows_each=700).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for key, parts in pieces.items():
        parts.sort(key=lambda r: r.piece)
        ids = np.array(model.encode(texts[key] or "", add_special_tokens=False).ids + [0], "<u4")
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == [sum(x.length for x in parts[:k]) for k in range(len(parts))]
        assert b"".join(bytes(r.ids) for r in parts) == ids.tobytes()
        assert all(r.length == 2048 for r in parts[1:]) and parts[0].length <= 2048
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in parts)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(x.length for x in parts[:k]) for k in range(len(parts))]
        assert sum(r.length for r in parts) <= 2048
    least = -(-sum(r.length for r in rows) // 2048)
    assert len(sequences) <= 1.02 * least + 4


def test_op5(spark, small):
    """The query's rows are the library's ids, cut and placed without a gap, in nearly as few sequences as can be."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op5_packing(spark, small).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for key, parts in pieces.items():
        ids = np.array(model.encode(texts[key] or "", add_special_tokens=False).ids + [0], "<u4")
        parts.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in parts] == [(k, sum(x.length for x in parts[:k])) for k in range(len(parts))]
        assert sum(r.length for r in parts) == len(ids) and all(r.length == 2048 for r in parts[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in parts)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(x.length for x in parts[:k]) for k in range(len(parts))] and parts[-1].offset + parts[-1].length <= 2048
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 4


def test_packing_edges(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x"), (None, None)], "doc_id long, text string").withColumns({"sequence_id": F.lit("x"), "length": F.lit(0)})
    rows = packing.pack(packing.cut(docs, P.path("byte_bpe_50k.json"))).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (0, 2), (1, 2), (1, 2)]
    assert packing.pack(packing.cut(docs.limit(0), P.path("byte_bpe_50k.json"))).count() == 0


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    # 4 and 7 are open when 8 comes: the fuller one (7) closes, so 2 goes with 8, and 6 with 4
    assert [bins.put(x) for x in (4, 7, 8, 2, 6)] == [(0, 0), (1, 0), (2, 0), (2, 8), (0, 4)]
    with pytest.raises(ValueError):
        packing.narrow(np.array([70_000], "<u4").tobytes())


def test_language(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = queries.op2_language_id(spark, small).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, small):
    model = language_id.train(spark.read.parquet(f"{small}/documents.parquet"))
    rows = [(1, None, 1), (2, "", 2), (3, "12 -- !", 3), (None, "der die und das ist", 4), (5, "é", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and [got[k].score for k in (1, 2, 3)] == [0.0] * 3
    assert got[None].lang_pred != "und" and got[5].lang_pred != "und" and not got[None].held_out
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert language_id.identify(docs.limit(0), model).count() == 0
    assert sorted((r.doc_id or 0) for r in language_id.keep_known(docs.withColumn("lang", F.lit(None).cast("string"))).collect()) == [0, 1, 2, 3, 5]
    assert language_id.identify(docs.withColumn("text", F.repeat(F.lit("das ist ein Haus. "), 40_000)), model).where("lang_pred = 'de'").count() == 5
    kept = language_id.keep_known(docs.withColumn("lang", F.lit("de")))
    assert kept.columns == ["doc_id", "text", "score", "lang"] and {r.score for r in kept.collect()} == {4, 5}


def test_families_first():
    rng = np.random.default_rng(0)
    x = rng.random((60, language_id.SIZE)).astype(np.float32) * 0.01
    lang = [["de", "en", "fr", "xx"][i % 4] for i in range(60)]
    for i in range(60):
        x[i, i % 4] = 1
    model = language_id.Model(x, lang)
    assert model.names == {"germanic": ["de", "en"], "romance": ["fr"], "xx": ["xx"]}
    assert model.predict(x)[0] == lang


def test_votes_against_a_plain_count(spark, small):
    """Family by most votes of its machines, then language by most votes within; ties go to the larger sum of margins."""
    model = language_id.train(spark.read.parquet(f"{small}/documents.parquet"))
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").where("text is not null").collect()][:300]

    def winner(x, names, machines):
        votes, sums = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        for (a, b), w in machines.items():
            margin = float(x @ w[:-1] + w[-1])
            votes[a if margin > 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
        return max(names, key=lambda n: (votes[n], sums[n]))

    for text in texts:
        x = language_id.features(text)
        family = winner(x, sorted(model.names), model.pairs[""])
        assert model.predict(x[None])[0] == [winner(x, model.names[family], model.pairs[family])]


def test_sample_bounds_labels(spark):
    rows = spark.range(4000).select("id", F.concat(F.lit("l"), F.when(F.col("id") < 3000, F.col("id") % 3).otherwise(F.col("id"))).alias("lang"))
    got = language_id.bounded_sample(rows, "lang", "id", 100, labels=5).groupBy("lang").count().collect()
    assert len(got) == 5 and all(r["count"] <= 150 for r in got) and {r.lang for r in got} >= {"l0", "l1", "l2"}


def toxic_rows(hidden=0.0):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioutrsn") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(1200):
        words = [word() for _ in range(30)]
        toxic = int(i % 4 == 0)
        if toxic and rng.random() >= hidden:
            words[5] = rng.choice(["idiot", "scum", "moron"])
        if rng.random() < (0.8 if toxic else 0.05):  # a spurious link between a group and the label
            words[9] = "muslims"
        rows.append((i, " ".join(words), toxic))
    return rows


def chosen_windows(rows):
    toxic, clean = (np.zeros(toxicity.SIZE), np.zeros(toxicity.SIZE))
    for _, text, label in rows:
        (toxic if label else clean)[np.unique(toxicity.windows(text))] += 1
    return np.union1d(np.argsort(-np.abs(toxic / toxic.max() - clean / clean.max()), kind="stable")[:500], toxicity.identity_windows())


def test_counterfactual_term_lowers_the_weight_of_groups():
    rows = toxic_rows(hidden=0.5)
    texts, y, chosen = [r[1] for r in rows], np.array([r[2] for r in rows]), chosen_windows(rows)
    free, held = (toxicity.Model.of_texts(texts, y, chosen, pull=p) for p in (0.0, 5.0))
    assert held.pairs == 2 * len(texts) and held.moved > len(texts)
    gap = lambda m: abs(m.score("the muslims met today") - m.score("the buddhists met today"))
    assert gap(free) > 0.1 and gap(held) < gap(free) / 2
    assert held.score("such an idiot, that scum") > 0.5


def test_counterfactual_pairs():
    assert toxicity.counterfactuals("The Women spoke to a Muslim") == [("the women spoke to a muslim", "the boys spoke to a jew"), ("the women spoke to a muslim", "the girls spoke to a hindu")]
    (a, b), (c, d) = toxicity.counterfactuals("nothing to see here today")
    assert b == c and len(b) > len(a) and d != b and a == "nothing to see here today"
    assert len(toxicity.counterfactuals("")) == 2 and toxicity.counterfactuals("wo")[0][1].startswith("wo ")


def test_toxicity_frames(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in toxic_rows()] + [(None, None, 2), (5000, "", 3), (5001, "calm words " * 100_000, 1)], "doc_id long, text string, predicted int")
    labels = spark.createDataFrame([(i, v) for i, _, v in toxic_rows()] + [(5000, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    truth = {i: v for i, _, v in toxic_rows()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert {r.predicted for r in rows if not r.text} == {0}
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and {r.predicted for r in kept.collect()} == {1, 2, 3}
    assert toxicity.train(docs, labels.limit(0)) is None and toxicity.train(docs.limit(0), labels) is None
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_op7(spark):
    """Scores of the query are those of its model, text by text; most held-out toxic documents are found, few clean ones are flagged."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    assert model.pairs > 0 and model.moved > 0
    rows = {r.doc_id: r for r in queries.op7_toxicity(spark, folder).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys()
    weights = dict(zip(model.chosen.tolist(), model.values.tolist(), strict=True))
    for key in list(texts)[::50]:
        z = model.constant + sum(weights.get(h, 0.0) for h in set(toxicity.windows(texts[key] or "").tolist()))
        assert abs(rows[key].score - 1 / (1 + np.exp(-z))) < 1e-4
        assert rows[key].held_out == (zlib.crc32(str(key).encode()) % 4 == 2) and rows[key].predicted == int(rows[key].score >= 0.3)
    held = [(r.toxic, rows[r.doc_id].predicted) for r in labels.collect() if r.toxic is not None and r.doc_id in rows and rows[r.doc_id].held_out]
    found = [p for t, p in held if t]
    assert sum(found) >= 0.75 * len(found) and sum(p for t, p in held if not t) <= 0.03 * len(held)


NOTICES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work was licensed under the GNU General Public License, version 2, too.": "GPL-2.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "released UNDER the mit license": "MIT",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "All rights reserved.": "All-Rights-Reserved",
    "He got a fishing license in May.": None,
    "Permission denied for user x": None,
    "Licensed under the Apache License, Version 1.1.": None,
}


def test_license_notices(spark):
    for line, name in NOTICES.items():
        assert [x[0] for x in license_scan.Scanner.shared().scan(line)] == [name] * (name is not None), line
    text = "words\n" + "\n".join(NOTICES) + "\nmore"
    docs = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "", 0), (3, "", 0), (None, "nothing here", 0), (4, "filler words " * 60_000 + text, 0)], "doc_id long, text string, notices int")
    found = license_scan.find_notices(docs).collect()
    rows = {r.doc_id: r.notices for r in found}
    for key, whole in ((1, text), (4, "filler words " * 60_000 + text)):
        assert [n.license for n in rows[key]] == [v for v in NOTICES.values() if v]
        assert all(whole[n.begin : n.end].split("filler words ")[-1] in NOTICES for n in rows[key])
    assert rows[2] == rows[3] == rows[None] == []
    assert len(found) == 6 and license_scan.find_notices(docs.limit(0)).count() == 0


def wrapped(text, width, head="", first="", last=""):
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + len(w) >= width:
            lines.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    return first + "\n".join(head + x for x in [*lines, line]) + last


def test_notices_within_and_across_lines():
    """Every template is found, once and by its name, in a paragraph, wrapped, and in comments; also with a word changed."""
    scan = license_scan.Scanner.shared().scan
    other = "the harbour was quiet that morning and nobody spoke about the weather " * 6
    for name, texts in license_scan.TEMPLATES.items():
        for t in texts:
            for shown in (other + t + " " + other, wrapped(t, 40), wrapped(t, 72, "# "), wrapped(t, 76, " * ", "/*\n", "\n */\nint main() {}"), wrapped(t, 80, "// ", other + "\n", "\n" + other)):
                assert [x[0] for x in scan(shown)] == [name], t
            if len(t.split()) >= 20:
                w = t.split()
                assert [x[0] for x in scan(" ".join([*w[:9], "surely", *w[9:]]))] == [name], t
    two = other + "Released under the MIT License. " + other + "Licensed under CC BY 4.0. " + other
    assert [x[0] for x in scan(two)] == ["MIT", "CC-BY-4.0"]
    assert [x[0] for x in scan("Released under the MIT License. Licensed under CC BY 4.0.")] == ["MIT", "CC-BY-4.0"]
    for name, ids in license_scan.SPDX.items():
        assert all([x[0] for x in scan(f"// SPDX-License-Identifier: {i}\ncode")] == [name] for i in ids)
    assert scan("SPDX-License-Identifier: Zlib") == [] and scan("Released under the Zlib License.") == []


def test_parts_find_all_that_may_be_confirmed():
    """Templates with a fifth of their words changed at random places are windows: the search for parts loses none."""
    rng = random.Random(9)
    scanner = license_scan.Scanner.shared()
    for k, (_, want, _) in enumerate(scanner.entries):
        for _ in range(20):
            have = list(want)
            for _ in range(license_scan.few(want)):
                i = rng.randrange(len(have))
                have[i : i + rng.randint(0, 1)] = rng.choice([[], ["zzz"]])
            have = ["aa", "bb", *have, "cc"]
            if scanner.differences(k, have):
                assert any(w[2] == k for w in scanner.windows(have, f" {' '.join(have)} "))


def test_compression_decides(monkeypatch):
    """Whole notices are taken by the template that reduces them most; with the ranking turned round, shorter ones take their words."""
    scanner = license_scan.Scanner.shared()
    whole = {name: max(texts, key=len) for name, texts in license_scan.TEMPLATES.items() if len(texts) > 1}
    spans = lambda: {name: [(n, e - b) for n, b, e, _, _ in scanner.scan(f"some words before it\n{t}\nand some after it")] for name, t in whole.items()}
    right = spans()
    assert right == {name: [(name, len(t))] for name, t in whole.items()}
    kept = license_scan.Scanner.ranked
    monkeypatch.setattr(license_scan.Scanner, "ranked", lambda *given: kept(*given)[::-1])
    assert sum(right[n] != x for n, x in spans().items()) > 5
    monkeypatch.setattr(license_scan.Scanner, "ranked", lambda *given: [(0.0, k) for _, k in kept(*given)])
    assert not any(spans().values())


def test_more_notices():
    """First sentences alone, short names, and all identifiers of an SPDX expression but no others."""
    scan = lambda text: [(n, text[b:e]) for n, b, e, _, _ in license_scan.Scanner.shared().scan(text)]
    gnu = "{} free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    for text, name in (
        (gnu.format("This program is", ":", "", ",", "2"), "GPL-2.0"),
        (gnu.format("This program is", ":", "", ",", "3"), "GPL-3.0"),
        (gnu.format("This library is", ";", "Lesser ", ";", "2.1"), "LGPL-2.1"),
        ("This code is licensed under the GPL v2", "GPL-2.0"),
        ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ):
        assert [n for n, _ in scan(f"Some words.\n{text}\nMore words.")] == [name], text
    one = "SPDX-License-Identifier: "
    assert scan(f"// {one}(MIT OR Apache-2.0)\ncode Apache-2.0") == [("MIT", f"// {one}(MIT"), ("Apache-2.0", "Apache-2.0")]
    assert [n for n, _ in scan(f"{one}GPL-2.0-only WITH Classpath-exception-2.0 AND (BSD-3-Clause OR MIT)")] == ["GPL-2.0", "BSD-3-Clause", "MIT"]
    assert [n for n, _ in scan(f"{one}MIT and also words Apache-2.0")] == [n for n, _ in scan(f"{one}MIT OR MIT")] == ["MIT"]


def test_reductions_rank_the_right_license_first():
    scanner = license_scan.Scanner.shared()
    for k, (name, want, _) in enumerate(scanner.entries):
        if len(want) >= 9:
            ranking = scanner.ranked(want)
            assert scanner.entries[ranking[0][1]][0] == name or ranking[0][0] - dict((j, g) for g, j in ranking)[k] < 0.1


def test_op10_finds_the_notice_lines_and_nothing_else(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op10_license_scan(spark, small).collect()}
    assert got.keys() == texts.keys()
    known = {t: n for n, all_ in license_scan.TEMPLATES.items() for t in all_}
    for key, text in texts.items():
        wanted, at = [], 0
        for line in (text or "").split("\n"):
            if line in known:
                wanted.append((known[line], at, at + len(line)))
            at += len(line) + 1
        first = wanted[0][1:] if wanted else (None, None)
        assert (got[key].n_notices, got[key].licenses, (got[key].first_begin, got[key].first_end)) == (len(wanted), ",".join(sorted({w[0] for w in wanted})), first)
