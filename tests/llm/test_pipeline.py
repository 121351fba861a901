"""The pipeline against its operators one by one."""

import random

import corpus_pipeline
from pathweave.llm import bpe, jaccard_dedup


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = docs.collect()
        assert k + 1 == len(corpus_pipeline.STAGES) or docs.columns == columns
    ids = lambda n: [r["doc_id"] for r in kept[n]]
    assert len(ids("language_id")) >= 195 and sorted(ids("line_dedup")) == sorted(ids("language_id"))
    assert set(ids("near_dedup")) < set(ids("line_dedup")) and len(set(ids("near_dedup"))) == len(ids("near_dedup"))
    assert set(ids("mixing")) <= set(ids("near_dedup"))
    assert sorted(ids("bpe")) == sorted(ids("mixing")) and all(r["exact"] for r in kept["bpe"])
    codec = bpe.codec(bpe.serialise(bpe.read_ranks(bpe.public_tokenizers.path(bpe.VOCABULARY))), bpe.public_tokenizers.PATTERN)
    texts = {r["doc_id"]: r["text"] for r in kept["mixing"]}
    assert all(codec.encode(texts[r["doc_id"]]) == bytes(r["ids"]) for r in kept["bpe"][:50])


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    assert len(rows) > 100 and all(r["exact"] and len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_with_odd_rows(spark):
    """Nulls, empty texts, repeated ids and rows, a table without rows, more columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, p long, rank long, node long"
    plain = "the of and to in is that it was for on with as his they at be this from have"
    rows = [(i, f"{plain} {i}", "en" if i % 2 else None, "a" if i % 3 else None, 5, 1, 1, 1) for i in range(40)]
    rows += [(50, None, None, None, None, 1, 1, 1), (51, "", "en", "a", 0, 1, 1, 1), (1, "another text of one id, with other words", "en", "a", 5, 1, 1, 1), rows[3], (None, "no id stands here at all", "en", "b", 5, 1, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("doc_id < -1"), "").count() == 0, name
        out = stage(spark, docs, "").collect()
        if name == "line_dedup":
            assert len(out) == len(rows) and {r["doc_id"] for r in out if r["text"] is None} == {50}
        if name == "near_dedup":
            texts = {r["text"] for r in out}
            assert "another text of one id, with other words" in texts and "no id stands here at all" in texts
            assert len(out) == len({(r["doc_id"], r["text"]) for r in out}) and len(texts & {None, ""}) == 1
        if name == "bpe":
            assert len(out) == len(rows) and all(r["exact"] for r in out)


def test_near_documents_by_five_word_shingles(spark):
    """Against Jaccard similarity alone."""
    rng = random.Random(2)
    texts = []
    for _ in range(60):
        own = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        new = list(own)
        for i in rng.sample(range(200), rng.randrange(1, 9)):
            new[i] = "x"
        texts += [" ".join(own), " ".join(new)]
    texts += ["", None]
    rows = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.unique_documents(spark, rows, "").collect()}
    sets = [set(zip(*[(t or "").split()[k:] for k in range(5)])) for t in texts]
    like = {i for i in range(1, 120, 2) if len(sets[i] & sets[i - 1]) >= 0.8 * len(sets[i] | sets[i - 1])}
    assert 20 < len(like) < 60 and kept == set(range(121)) - like


def test_near_documents_meet_by_simhash_cells(spark, monkeypatch):
    """Without cells of MinHashes, what lies within operator 10's radius still meets in its grid and is verified."""
    rng = random.Random(3)
    texts = []
    for _ in range(40):
        own = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        texts += [" ".join(own), " ".join([*own[:-1], "x"])]
    rows = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    real = jaccard_dedup.meet
    monkeypatch.setattr(jaccard_dedup, "meet", lambda rows, *rest, **named: real(rows.where("cell between 0 and 8589934591"), *rest, **named))
    kept = {r["doc_id"] for r in corpus_pipeline.unique_documents(spark, rows, "").collect()}
    sim = [simhash_of(t) for t in texts]
    near = {i for i in range(1, 80, 2) if (sim[i] ^ sim[i - 1]).bit_count() <= 4}
    assert len(near) > 20 and kept == set(range(80)) - near


def simhash_of(text):
    _, h = jaccard_dedup.shingles(text)
    return sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))
