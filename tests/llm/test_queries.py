"""Every query of the corpus operators as registered, over one small folder of tables, against brute force."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from pathweave.llm import queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark, small, tmp_path_factory):
    """The smallest documents plus odd rows; their other tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = [(9001, None, None, None, None), (9002, "", "en", "a", 0), (9003, "12 ?! 3", None, None, 7), (9004, "é 한글 \U0001f6b2 x", "fr", "b", 9)]
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "embeddings", "conversations"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def texts(spark, tables):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}


def rows_of(spark, tables, name):
    found = queries.queries()[name](spark, tables).collect()
    return found, {r["doc_id"]: r for r in found}


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_op1(spark, tables, texts):
    found, by = rows_of(spark, tables, "op1_line_dedup")
    assert len(found) == len(texts) and by[9001]["text"] is None and by[9002]["text"] == ""
    for k, t in texts.items():
        kept, before = (by[k]["text"] or "").split("\n"), (t or "").split("\n")
        assert by[k]["lines_in"] == (len(before) if t is not None else 0)
        rest = iter(before)
        assert by[k]["text"] in (None, "") or all(line in rest for line in kept)


def test_op2(spark, tables, texts):
    found, by = rows_of(spark, tables, "op2_language_id")
    langs = {r["lang"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect() if r["lang"] and not held(r["doc_id"])}
    assert len(found) == len(texts)
    for k, r in by.items():
        letters = any(c.isalpha() for c in texts[k] or "")
        assert r["held_out"] == held(k) and 0 <= r["score"] <= 1 and (r["lang_pred"] in langs if letters else r["lang_pred"] == "und")


def test_op3(spark, tables):
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()}
    found, got = queries.op3_collision_ann(spark, tables).collect(), {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in x if i % 20 == 0}
    hits = 0
    for q, near in got.items():
        best = sorted((-float(v @ x[q]), i) for i, v in x.items() if i != q)[:20]
        assert [n[0] for n in near] == list(range(1, 21)) and all(abs(s - x[i] @ x[q]) < 1e-9 for _, i, s in near)
        hits += len({i for _, i, _ in near} & {i for _, i in best})
    assert hits >= 0.95 * 20 * len(got)


def test_op4(spark, tables, texts):
    found, by = rows_of(spark, tables, "op4_bpe_roundtrip")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(found) == len(texts)
    for k, t in texts.items():
        ids = library.encode_ordinary(t or "")
        assert by[k]["n_tokens"] == len(ids) and by[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert by[k]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_op5(spark, tables, texts):
    found, by = rows_of(spark, tables, "op5_hilbert_sharding")
    slots = {}
    for k, r in by.items():
        data = (texts[k] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(found) == len(texts)


def test_op6(spark, tables, texts):
    found, by = rows_of(spark, tables, "op6_source_mixing")
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    size = {k: len(WORDS.findall(t or "")) for k, t in texts.items()}
    total = {s: sum(size[k] for k in texts if source[k] == s) for s in set(source.values())}
    assert len(found) == len(texts)
    for k, r in by.items():
        assert r["size"] == size[k] and r["source_size"] == total[source[k]] and r["taken"] in (0, size[k], 2 * size[k])
        assert r["target"] <= 2 * r["source_size"] + 1e-6
    assert sum({source[k]: r["target"] for k, r in by.items()}.values()) == pytest.approx(1.5 * sum(size.values()))
    assert sorted(map(tuple, found)) == sorted(map(tuple, queries.op6_source_mixing(spark, tables).collect()))


def test_op7(spark, tables, texts):
    found, by = rows_of(spark, tables, "op7_toxicity")
    assert len(found) == len(texts)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == held(k) for k, r in by.items())


def test_op9(spark, tables, texts):
    found, by = rows_of(spark, tables, "op9_syncmer_fingerprints")
    order = sorted(texts, reverse=True)
    assert len(found) == len(texts)
    for k, after in zip(order, order[1:] + order[:1], strict=True):
        text, half = texts[k] or "", len(texts[k] or "") // 2
        edited = text[: len(text) - half] + (texts[after] or "")[:half]
        r = by[k]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if edited == text:
            assert r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"]
    long = [by[k] for k in order if len(texts[k] or "") > 200 and texts[k] != texts[order[(order.index(k) + 1) % len(order)]]]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)


def test_op10(spark, tables, texts):
    found, by = rows_of(spark, tables, "op10_simhash_near_dedup")

    def fingerprint(t):
        words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        own = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        bits = np.array([xxhash.xxh64_intdigest(s, 42) for s in own], np.uint64)
        return sum(1 << b for b in range(64) if 2 * int((bits >> np.uint64(b) & np.uint64(1)).sum()) > len(own)) if own else 0

    fps = {k: fingerprint(t) for k, t in texts.items()}
    label = {k: k for k in texts}
    for _ in range(8):
        for a in texts:
            for b in texts:
                if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    assert len(found) == len(texts)
    assert all(by[k]["fingerprint"] == f"{fps[k]:016x}" and by[k]["component_id"] == label[k] for k in texts)
