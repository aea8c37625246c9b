"""The pipeline's stages in turn, each against what its operator says of that stage's input."""

import re

import corpus_pipeline
from rollkeep.llm import language_id, toxicity

from test_dedup import groups, shingle_set


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "exact_dedup", "simhash_dedup", "packing"]
    clean = corpus_pipeline.clean(spark, docs, small).cache()
    labels = spark.read.parquet(f"{small}/labels.parquet")
    bad = {r.doc_id for r in toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 1").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert bad and ids(clean) == ids(docs) - bad
    known = corpus_pipeline.known_language(spark, clean, small).cache()
    assert ids(known) == ids(clean) - {r.doc_id for r in language_id.identify(clean, language_id.train(clean)).where("lang_pred = 'und'").collect()}
    once = corpus_pipeline.exact_copies(spark, known, small).cache()
    by_text = {}
    for r in known.collect():
        by_text.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""), []).append(r.doc_id)
    assert ids(once) == {max(v) for v in by_text.values()}
    kept = corpus_pipeline.near_copies(spark, once, small).cache()
    texts = sorted((r.doc_id, r.text) for r in once.collect())
    sets = [shingle_set(t) for _, t in texts]
    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    near = {(i, j) for v in by_shingle.values() for i in v for j in v if j < i}
    links = [(i, j) for i, j in near if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    wanted = {texts[i][0] for i in groups(len(texts), links)}
    assert wanted <= ids(kept) and len(ids(kept) - wanted) <= 0.002 * len(texts)  # pairs whose fingerprints are far apart may be missed
    assert clean.columns == known.columns == once.columns == kept.columns == columns
    packed = corpus_pipeline.packed(spark, kept, small).collect()
    assert {r.doc_id for r in packed} == ids(kept)
    assert sum(len(r.ids) for r in packed) == 2 * sum(r.length for r in packed)


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(rows.columns)


def test_odd_rows_pass_every_stage(spark, small, tmp_path):
    """Null and empty texts, null ids, repeated rows, very long texts and clashing columns go through; empty tables give empty tables."""
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [(1, "the quiet harbour of the old town", "en"), (1, "the quiet harbour of the old town", "en"), (None, "a text of its own and nothing else", "en"), (2, None, None), (3, "", "en"), (4, long, "en"), (5, long + " end", "en"), (6, long, None)]
    docs = spark.createDataFrame([(*r, "x", "y", 1.0) for r in rows], "doc_id long, text string, lang string, maybe string, kept string, score double")
    spark.createDataFrame([(1, 0), (9, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs_ in (docs, docs.limit(0)):
        at = docs_
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
                at = out.cache()
            got = [r.doc_id for r in out.collect()]
        if docs_ is docs:
            assert set(got) == {None, 1, 5} and got.count(1) == 2  # 2 and 3 have no language, 4 is a copy of 6, 6 is near 5
        else:
            assert got == []
