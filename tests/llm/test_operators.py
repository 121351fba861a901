"""The corpus operators against brute force on small inputs, edge cases included."""

import base64
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from pathweave.llm import bpe, cells, chat, collision_ann, hilbert_shards, langid, line_dedup, mixing, queries, simhash_dedup, syncmers, toxicity
from pathweave.llm.common import components, global_rank, held_out

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(words))


@pytest.fixture(scope="module")
def docs():
    """Rows with nulls, empty and long texts, copies, near copies, repeats and a null doc_id."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows = []
    for i in range(120):
        text = "\n".join(prose(rng, rng.randrange(1, 40), words) for _ in range(rng.randrange(1, 6)))
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), len(text)))
    long = rows[3][1].split() * 400
    rows[4] = (4, " ".join(long), "en", "a", 1)
    rows[5] = (5, " ".join([*long[:50], "changed", *long[51:]]), "en", "a", 1)
    for i, n in ((6, 7), (8, 7), (9, 10)):
        rows[i] = (i, rows[n][1], "de", "b", 1)
    rows += [(200, None, None, None, None), (201, "", "en", "a", 0), (202, " \t\n ", "en", "a", 3), (203, "4 5 !!", None, "z", 6)]
    rows += [rows[11], (None, "no id here at all, really none", "en", "a", 5), (11, "another text under one id", "en", "a", 3)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, docs):
    # extra columns, some with names that operators use themselves
    names = "score rank line node fp size ids bucket component mark kept p o __p __i __m i m own other cell label of".split()
    extra = {c: F.lit(7) for c in names}
    return spark.createDataFrame(docs, SCHEMA).withColumns(extra)


def empty(frame):
    return frame.where("doc_id < -5")


def test_components_and_ranks(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    clash = spark.createDataFrame([(2, "b", 0), (1, "a", 0)], "p int, o string, rank int").withColumns({c: F.lit(5) for c in ("__p", "__o", "__m", "__k", "k")})
    got = global_rank(clash, [F.col("p")], "place")
    assert got.columns == [*clash.columns, "place"] and sorted((r["o"], r["place"], r["__p"]) for r in got.collect()) == [("a", 0, 5), ("b", 1, 5)]
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "k int, v int")
    got = sorted((r["k"], r["v"], r["rank"]) for r in global_rank(df, [F.col("k"), F.col("v")]).collect())
    assert [r[2] for r in got] == list(range(500))


# 10


def scalar_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    own = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in pairs:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_equals_scalar(docs):
    texts = [d[1] for d in docs if d[1] is None or len(d[1]) < 5000] + ["Éa ÉA x y B", "one two three", "a b c d"]
    assert [simhash_dedup.simhash(t) for t in texts] == [scalar_simhash(t) for t in texts]


def test_near_duplicates(frame, docs):
    found = simhash_dedup.near_duplicates(frame).collect()
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in found]
    fps = [simhash_dedup.simhash(d[1]) for d in docs]
    root = union(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    least = {}
    for d, r in zip(docs, root, strict=True):
        least[r] = min((x for x in (least.get(r), d[0]) if x is not None), default=None)
    want = [(d[0], fp - (1 << 64) * (fp >> 63), least[r]) for d, fp, r in zip(docs, fps, root, strict=True)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    # of each group one row stays, that of its least doc_id; rows that share a doc_id but no group all stay
    kept = [(r["doc_id"], r["text"]) for r in simhash_dedup.keep_one(frame).collect()]
    group = {(d[0], d[1]): r for d, r in zip(docs, root, strict=True)}
    assert sorted(group[k] for k in kept) == sorted(set(root))
    assert all(k[0] == least[group[k]] for k in kept) and (11, "another text under one id") in kept
    assert simhash_dedup.near_duplicates(empty(frame)).count() == 0


def test_keep_one_drops_copies_only(spark):
    same = "one text that stands here two times over and over"
    rows = spark.createDataFrame([(3, same, 1), (3, "completely other words stand here now", 2), (2, same, 3), (2, same, 4), (None, same, 5), (7, None, 6), (8, "", 7)], "doc_id long, text string, p long")
    got = sorted((r["doc_id"], r["p"]) for r in simhash_dedup.keep_one(rows).collect())
    assert got == [(2, 3), (3, 2), (7, 6)]
    assert simhash_dedup.keep_one(rows.where("p > 99")).count() == 0


@pytest.mark.parametrize("n", [40, 400])
def test_cells_lose_no_link(spark, n):
    """Random fingerprints and chains of small changes, against all pairs; 400 near ones fill one cell."""
    rng = random.Random(n)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for b in base[: 3 if n > 100 else 20] for _ in range(n)} | set(base))[: 3 * n]
    signed = [f - (1 << 64) * (f >> 63) for f in fps]
    links = simhash_dedup.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    at = {f: i for i, f in enumerate(signed)}
    got = union(len(fps), [(at[r["a"]], at[r["b"]]) for r in links])
    want = union(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert got == want
    assert all((fps[at[r["a"]]] ^ fps[at[r["b"]]]).bit_count() for r in links)


def test_long_runs_in_tiles():
    rng = np.random.default_rng(0)
    fps = (rng.integers(0, 1 << 62, 30, dtype=np.uint64)[:, None] ^ (np.uint64(1) << rng.integers(0, 60, (30, 20)).astype(np.uint64))).ravel()
    assert (cells.long_run(fps, 2, tile=64) == cells.long_run(fps, 2)).all()
    a, b = cells.linked(np.zeros(len(fps), np.int64), fps, 2)
    assert len(b) == len(fps) - len(set(cells.long_run(fps, 2).tolist())) and (a < b).all()


# 1: see test_lines.py


def test_edit_distance():
    rng = random.Random(0)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        most = rng.randrange(8)
        assert line_dedup.edit_distance(a, b, most) == min(plain(a, b), most + 1)


def test_many_edit_distances_at_once():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcé ") for _ in range(rng.choice([1, 5, 63, 64, 65, 130, 200]))) for _ in range(200)]
    texts += [t[: len(t) // 2] + "q" + t[len(t) // 2 + 1 :] for t in texts]
    a, b = (np.array([rng.randrange(len(texts)) for _ in range(1500)]) for _ in range(2))
    a, b = np.append(a, np.arange(200)), np.append(b, np.arange(200, 400))
    codes, sizes, letters = line_dedup.coded(texts)
    got = line_dedup.edit_distances(codes, sizes, letters, a, b)
    assert got.tolist() == [line_dedup.edit_distance(texts[i], texts[j], 10**6) for i, j in zip(a, b, strict=True)]


# 2


def test_language_id(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    got = langid.predict(docs, model).where(held_out()).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.9
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 ?!"), (4, "жщйъ юяэы"), (5, "the of and " * 200_000)], "doc_id long, text string").withColumn("__x", F.lit(1))
    by = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and [by[i]["score"] for i in (1, 2, 3)] == [0.0] * 3
    assert all(by[i]["rejected"] for i in (1, 2, 3)) and by[5]["lang_pred"] == "en" and not by[5]["rejected"]
    assert by[4]["score"] < 0.4 and by[4]["lang_pred"] != "und" and by[4]["rejected"]
    none = langid.fit(docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r["lang_pred"] for r in langid.predict(odd, none).collect()} == {"und"}
    assert langid.predict(empty(docs), model).count() == 0


def test_language_scores_do_not_depend_on_pieces(monkeypatch):
    text = "Déjà vu, straße und mañana " * 50
    own = langid.counted(text)
    monkeypatch.setattr(langid, "PIECE", 17)
    assert all((a == b).all() for a, b in zip(own, langid.counted(text), strict=True))


# 3


def test_nearest(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    own = [(r["vec_id"], list(map(float, r["embedding"]))) for r in table.collect()]
    bad = [(10_000, None), (10_020, [0.0] * 64), (10_040, [1.0] * 63 + [None]), (10_060, [float("nan")] * 64)]
    short = [(50_000, [1.0] * 3), (50_001, [1.0, 2.0, 3.0])]
    copies = [(20_000 + i, own[0][1]) for i in range(40)]
    scaled = [(30_000 + i, [2.5 * x for x in own[i][1]]) for i in range(5)]
    rows = own + copies + scaled
    df = spark.createDataFrame(rows + bad + short, "vec_id long, embedding array<float>").withColumns({c: F.lit("x") for c in ("score", "row", "query", "d", "block")})
    of_short = [tuple(r) for r in collision_ann.nearest(df.where("vec_id >= 50000"), F.col("vec_id") % 20 == 0).collect()]
    assert of_short == [(50_000, 1, 50_001, 6.0)]
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (0, [2.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in collision_ann.nearest(twice, F.col("vec_id") % 20 == 0).collect()) == [(0, 1, 0, 2.0), (0, 1, 3, 3.0), (0, 2, 0, 2.0), (0, 2, 3, 1.0)]
    df = df.where("vec_id < 50000")
    got = {}
    for r in collision_ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    assert set(got) == {i for i in x if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        exact = sorted(((-(v * x[q]).sum(), i) for i, v in x.items() if i != q))[:20]
        assert len(found) == 20 and all(abs(s - (x[i] * x[q]).sum()) < 1e-12 for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        hits += len({i for i, _ in found} & {i for _, i in exact})
    assert hits / (20 * len(got)) >= 0.95
    few = collision_ann.nearest(df.where("vec_id in (0, 1, 2, 20)"), F.col("vec_id") % 20 == 0).count()
    assert few == 6 and collision_ann.nearest(df.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert collision_ann.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


# 4


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(bpe.VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(library):
    codec = bpe.codec(bpe.serialise(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))), public_tokenizers.PATTERN)
    rng = random.Random(2)
    chars = [*map(chr, range(32, 127)), " ", " ", "\n", "\t", "՘", "ₐ", "\U000323b0", "é", "한", " ", "​", "\x1c", "\U0001f6b2", "²"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(80))) for _ in range(2000)]
    texts += ["", "a" * 5000, " \n\n  x ", "they'll <|endoftext|> 12345", "Ġab▁▁ c", "aaaa " * 300]
    for t in texts:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert codec.decode(ids).decode() == t


def test_bpe_memory_limits(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    codec = bpe.Codec(bpe.serialise(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))), public_tokenizers.PATTERN)
    rng = random.Random(4)
    for _ in range(50):
        text = " ".join("".join(rng.choice("abcdef") for _ in range(4)) for _ in range(200))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_bpe_columns(frame, docs):
    got = bpe.decode(bpe.encode(frame)).select("doc_id", "text", "decoded", "ids", "p").collect()
    assert len(got) == len(docs)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") and r["p"] == 7 for r in got)
    assert bpe.encode(empty(frame)).count() == 0


# 5


def test_hilbert_curve_is_one_path(spark):
    for bits, n in ((3, 2), (2, 3), (2, 4)):
        grid = spark.range(1 << bits * n)
        axes = [F.shiftright("id", bits * i).bitwiseAND((1 << bits) - 1).cast("int").alias(f"c{i}") for i in range(n)]
        grid = grid.select(*axes)
        rows = sorted(tuple(r) for r in grid.select(hilbert_shards.hilbert([F.col(f"c{i}") for i in range(n)], bits).alias("h"), "*").collect())
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:], strict=True)) == 1 for p, q in zip(rows, rows[1:], strict=False))


def test_shards(frame, docs):
    dims = ["source", "lang", "n_chars"]
    df = frame.withColumn("mark", F.crc32("text"))
    got = hilbert_shards.shards(df, dims, ["mark", "doc_id"])
    assert got.columns == [*df.columns, "curve", "shard", "slot"] and got.where("rank = 7 and p = 7 and o = 7").count() == len(docs)
    rows = got.collect()
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(docs) and set(counts) == set(range(8))
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in ordered)
    seen = hilbert_shards.manifest(got, dims).collect()
    assert sum(r["rows"] for r in seen) == len(docs)
    assert hilbert_shards.shards(df.where("doc_id < -5"), dims, ["mark"]).count() == 0
    assert {r["shard"] for r in hilbert_shards.shards(df.limit(3), ["score"], ["doc_id"]).collect()} == {0, 2, 5}


# 6


def scalar_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, fixed = 1.5 * sum(sizes.values()), set()
    while True:
        left = [s for s in order if s not in fixed]
        if not left:
            break
        level = (budget - sum(2 * sizes[s] for s in fixed)) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        fixed |= over
    return {s: 2.0 * sizes[s] if s in fixed else weight[s] * level for s in order}


def test_mixing(frame, docs):
    planned = mixing.plan(frame)
    rows = planned.collect()
    sizes = {}
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or ""))
    want = scalar_targets(sizes)
    assert len(rows) == len(docs)
    for r in rows:
        s = r["source"]
        assert r["mix_source_size"] == sizes[s] and r["mix_target"] == pytest.approx(want[s])
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert r["mix_copies"] in (int(rate + 1e-9), int(rate - 1e-9) + 1) and r["mix_copies"] <= 2 and r["size"] == 7
    again = {(r["doc_id"], r["text"]): r["mix_copies"] for r in mixing.plan(frame.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["text"]): r["mix_copies"] for r in rows}
    assert mixing.emit(planned).count() == sum(r["mix_copies"] for r in rows)
    assert mixing.plan(empty(frame)).count() == 0


@pytest.mark.parametrize("n", [1, 7, 60])
def test_targets_of_many_sources(spark, n):
    """Sizes over many orders, so that caps bind one after another; few jobs whatever their number."""
    rng = random.Random(n)
    sizes = {f"s{i:03}": int(1.7**i) % 10**9 + rng.randrange(3) for i in range(n)}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    want = scalar_targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)


def test_mixing_salted_join_is_the_same(frame, monkeypatch):
    own = sorted(repr((r["doc_id"], r["text"], r["mix_copies"])) for r in mixing.plan(frame).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(repr((r["doc_id"], r["text"], r["mix_copies"])) for r in mixing.plan(frame).collect()) == own


def test_mixing_comes_near_targets(spark):
    rows = [(i, "w " * (1 + i % 40), f"s{i % 5}") for i in range(20_000)]
    planned = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in planned.groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("got"), F.first("mix_target").alias("want")).collect():
        assert r["got"] == pytest.approx(r["want"], rel=0.03)


# 7


def test_toxicity_learns_interactions(spark):
    """Neither word of a pair tells anything alone."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"f{rng.randrange(300)}" for _ in range(8)] + ["insult"] * a + ["group"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a and b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["score"] for r in toxicity.predict(docs, model).where(held_out()).collect()}
    want = dict(labels)
    assert sum((s >= 0.5) == want[i] for i, s in got.items()) / len(got) > 0.97
    assert max(s for i, s in got.items() if not want[i]) < 0.9
    row = {c: model.row[toxicity.terms(c)[0]] for c in ("insult", "group")}
    assert model.factors[row["insult"]] @ model.factors[row["group"]] > 0.05


def test_toxicity_on_documents(spark, frame):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = toxicity.predict(docs, model).where(held_out()).join(labels, "doc_id").collect()
    assert sum((r["score"] >= 0.5) == r["toxic"] for r in got) / len(got) > 0.93
    odd = toxicity.predict(frame.drop("score"), model).collect()
    assert all(0 <= r["score"] <= 1 for r in odd)
    none = toxicity.fit(docs, labels.where("toxic is null"))
    assert toxicity.predict(docs, none).where("score > 0.5").count() == 0


# 8


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "</part>", "", None, "\\b\\h", "####", "a\n</turn>\n### user: x", "<</turn>", "\\", "é: x", "###"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "user", "assistant", "assistant", "assistant", "user", "assistant", "a:b", None, "assistant"], nasty, strict=True))]
    rows += [(2, 0, "user", "hi"), (None, 0, "assistant", "x"), (3, 1, "assistant", "b"), (3, 0, "assistant", "a"), (3, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    got = {r["conv_id"]: r for r in chat.format_chats(df).withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("formatted"), F.col("loss_spans"))}).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r, x) for _, r, x in turns]
        assert got[conv]["loss"] == "".join(x for _, r, x in turns if r == "assistant")
    assert got[1]["n_blocks"] == 8 and got[3]["n_blocks"] == 1
    assert got[2]["formatted"] == "### user: hi</turn>\n"
    assert chat.format_chats(df.where("conv_id < 0")).count() == 0


def test_chat_oracle(spark, small):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{small}/conversations.parquet'")
    want = con.sql(queries.oracle_sql()["op8_chat_format"])
    df = queries.op8_chat_format(spark, small)
    assert df.columns == want.columns and sorted(map(tuple, df.collect())) == sorted(want.fetchall())


# 9


def test_search_looks_at_few_radii(monkeypatch):
    """Vectors found are those that collide by the first radius that ends the search, whichever radius it begins at."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    index = collision_ann.Index(x, 1.0)
    looked, real = [], index.windows
    monkeypatch.setattr(index, "windows", lambda *a: looked.append(a) or real(*a))
    index.search(x[:64], 20)
    looked.clear()
    got = index.search(x[64:128], 20)
    assert len(looked) <= 6
    at = x @ index.lines + np.sqrt(np.clip(1 - (x * x).sum(axis=1), 0, None))[:, None] * index.extra
    for q, (rows, scores) in zip(x[64:128], got, strict=True):
        radius = collision_ann.FIRST_RADIUS
        apart = np.sort(np.abs(at - (q / np.sqrt(q @ q)) @ index.lines), axis=1)[:, int(np.ceil(collision_ann.THRESHOLD * collision_ann.PROJECTIONS)) - 1]
        while True:
            found = np.flatnonzero(apart <= collision_ann.WIDTH * radius / 2)
            best = np.sort(x[found] @ q)[::-1][:20]
            if len(best) == 20 and np.sqrt(2 - 2 * best[-1]) <= collision_ann.SLACK * radius:
                break
            radius *= collision_ann.RATIO
        assert np.allclose(np.sort(scores)[::-1], best, atol=1e-12) and set(rows) <= set(found)


def scalar_syncmers(text, k, s):
    codes = np.array([ord(c) for c in text], np.uint64)
    h = syncmers.mix(codes + np.uint64(1)).tolist()
    m = (1 << 64) - 1
    roll = lambda v: sum(x * pow(syncmers.BASE, len(v) - 1 - i, 1 << 64) for i, x in enumerate(v)) & m
    one = lambda x: int(syncmers.mix(np.array([x], np.uint64))[0])
    out = []
    for i in range(len(text) - k + 1):
        own = [one(roll(h[i + j : i + j + s])) for j in range(k - s + 1)]
        if min(own) in (own[0], own[-1]):
            out.append((i, one(roll(h[i : i + k]))))
    return out


def scalar_part(text, kind):
    k, s, kept = kind
    first = {}
    for pos, h in scalar_syncmers(text, k, s):
        first.setdefault(h >> 32, pos)
    return sorted(sorted(first)[:kept], key=first.get)


def scalar_fingerprint(text):
    coarse, fine = scalar_part(text, syncmers.COARSE), scalar_part(text, syncmers.FINE)
    if text and not fine:
        fine = [int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest(), "little")]
    return coarse, fine


def scalar_likeness(a, b):
    pick = 0 if min(len(a[0]), len(b[0])) >= syncmers.ENOUGH else 1
    x, y = a[pick], b[pick]
    if not x and not y:
        return 1.0
    both = sorted({*x, *y})[: (syncmers.COARSE, syncmers.FINE)[pick][2]]
    places = [y.index(h) for h in x if h in both and h in y]
    best = [1] * len(places)
    for i in range(len(places)):
        for j in range(i):
            if places[j] < places[i]:
                best[i] = max(best[i], best[j] + 1)
    return max(best, default=0) / len(both)


def shown(fp):
    return ".".join("".join(f"{h:08x}" for h in p) for p in fp) if fp[1] else ""


@pytest.mark.parametrize("piece", [1 << 18, 7])
def test_syncmers_equal_scalar(monkeypatch, piece):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcd é\U0001f6b2") for _ in range(n)) for n in (0, 1, 3, 4, 5, 15, 16, 17, 40, 90)] + ["a" * 50, "abcabcabd" * 20]
    monkeypatch.setattr(syncmers, "PIECE", piece)
    for t in texts:
        for kind in (syncmers.COARSE, syncmers.FINE):
            pos, h = syncmers.anchors(t, kind)
            assert list(zip(pos.tolist(), h.tolist(), strict=True)) == scalar_syncmers(t, *kind[:2])
        fp = syncmers.fingerprint(t)
        assert [p.tolist() for p in fp] == list(map(list, scalar_fingerprint(t))) and syncmers.as_hex(fp) == shown(scalar_fingerprint(t))


def test_likeness_goes_by_order():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    text, turned = " ".join(words), " ".join(words[30:] + words[:30])
    own, other = syncmers.fingerprint(text), syncmers.fingerprint(turned)
    assert syncmers.likeness(own, own) == 1.0 and 0.3 < syncmers.likeness(own, other) < 0.75
    errors = []
    for n in range(20, 60, 4):
        new = " ".join([*words[:n], *reversed(words)])
        errors.append(syncmers.likeness(own, syncmers.fingerprint(new)) - syncmers.exact_likeness(text, new))
    assert max(map(abs, errors)) < 0.25 and abs(sum(errors) / len(errors)) < 0.1
    assert 0.1 < syncmers.likeness(syncmers.fingerprint("a short text"), syncmers.fingerprint("a short one!")) < 1


def test_fingerprints_leave_no_anchor_out():
    """Long texts: every syncmer is in the fingerprint, and a short passage that two of them share counts."""
    rng = random.Random(10)
    own, other = ("".join(rng.choice("abcdefghij ") for _ in range(4000)) for _ in range(2))
    passage = own[1000:1060]
    other = other[:3000] + passage + other[3000:]
    for t in (own, other):
        for part, kind in zip(syncmers.fingerprint(t), (syncmers.COARSE, syncmers.FINE), strict=True):
            assert set(part.tolist()) == {h >> 32 for _, h in scalar_syncmers(t, *kind[:2])}
    both = [{h >> 32 for _, h in scalar_syncmers(t, *syncmers.COARSE[:2])} for t in (own, other)]
    assert len(both[0] & both[1]) >= 4
    near = syncmers.likeness(syncmers.fingerprint(own), syncmers.fingerprint(other))
    assert near == len(both[0] & both[1]) / len(both[0] | both[1]) == pytest.approx(syncmers.exact_likeness(own, other))


def test_edited_likeness(frame, docs):
    got = sorted((repr(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in syncmers.edited_likeness(frame).collect())
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    want = []
    for d, nxt in zip(order, order[1:] + order[:1], strict=True):
        text, half = d[1] or "", len(d[1] or "") // 2
        want.append((repr(d[0]), len(text), hashlib.sha256((text[: len(text) - half] + (nxt[1] or "")[:half]).encode()).hexdigest()))
    assert got == sorted(want)
    found = {(repr(r["doc_id"]), r["edited_sha256"]): r for r in syncmers.edited_likeness(frame).collect()}
    for d, nxt in zip(order, order[1:] + order[:1], strict=True):
        text, after = d[1] or "", nxt[1] or ""
        if len(text) > 2000 or len(after) > 2000:
            continue
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = found[repr(d[0]), hashlib.sha256(edited.encode()).hexdigest()]
        own, new, end = map(scalar_fingerprint, (text, edited, after))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(own), shown(new))
        assert r["near_edited"] == pytest.approx(scalar_likeness(own, new)) and r["near_next"] == pytest.approx(scalar_likeness(own, end))
    assert syncmers.edited_likeness(empty(frame)).count() == 0
    one = syncmers.edited_likeness(frame.where("doc_id = 20")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    plain = {r["doc_id"]: r for r in syncmers.fingerprints(frame.drop("score")).collect()}
    assert plain[6]["fingerprint"] == plain[7]["fingerprint"] and plain[201]["fingerprint"] == ""


def test_held_out(spark):
    got = spark.range(50).where(held_out("id")).collect()
    assert [r["id"] for r in got] == [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0]
