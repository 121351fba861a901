"""Line dedup against brute force over all pairs of lines, written without the operator's code."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathweave.llm import cells, line_dedup

SCHEMA = "doc_id long, text string"


def normal(line):
    return " ".join(re.sub("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", line.lower()).split(" ")).strip()


def distance(a, b, most):
    """Edit distance by a band of the whole table; most + 1 if larger."""
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if j == 0:
                new[0] = i
                continue
            new[j] = min(row.get(j, most + 1) + 1, new.get(j - 1, most + 1) + 1, row.get(j - 1, most + 1) + (x != b[j - 1]))
        row = new
        if min(row.values()) > most:
            return most + 1
    return row.get(len(b), most + 1)


def similar(a, b):
    most = int(max(len(a), len(b)) * 0.2 + 1e-9)
    return abs(len(a) - len(b)) <= most and distance(a, b, most) <= most


def is_long(line):
    words = line.count(" ") + 1
    return words >= 5 or len(line) >= 40


def brute_force(docs):
    """The texts that should stay, over all pairs of distinct long lines."""
    places = {}
    for doc_id, text in sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0, d[1])):
        for n, line in enumerate(text.split("\n")):
            if normal(line):
                places.setdefault(normal(line), []).append((doc_id is not None, doc_id or 0, text, n))
    lines = sorted(places)
    label = {x: x for x in lines}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if is_long(a) and is_long(b) and find(a) != find(b) and similar(a, b):
                label[find(a)] = find(b)
    groups = {}
    for x in lines:
        groups.setdefault(find(x), []).extend(places[x])
    gone = {p for g in groups.values() for p in sorted(g, key=lambda p: (p[0], p[1], p[3]))[1:]}
    return [(d, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d is not None, d or 0, t, n) not in gone)) for d, t in docs]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(3, 9)))
    base = [[word() for _ in range(rng.randrange(18, 40))] for _ in range(30)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            own = list(rng.choice(base))
            if rng.random() < 0.6:
                own[rng.randrange(len(own))] = word()
            lines.append(rng.choice([" ", ", ", " - "]).join(own))
        lines += rng.sample(["All rights reserved.", "all rights reserved", "Read more", "--", "", "read  MORE!", "one two"], 3)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    signs = [chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(120)]
    rows += [(70, "".join(signs)), (71, "".join([*signs[:50], "あ", *signs[51:]])), (72, None), (73, ""), (74, " \n\t"), (None, "a line without an id that is long enough"), rows[5], rows[5], (5, "another text of that id")]
    return rows


def kept(spark, docs, **kind):
    return [(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA), **kind).collect()]


def test_equals_brute_force(spark, docs):
    got, want = kept(spark, docs), brute_force(docs)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(len((t or "").split("\n")) for _, t in got) < 0.5 * sum(len((t or "").split("\n")) for _, t in docs)


@pytest.mark.parametrize("blocks", [5, 6])
def test_blocks_do_not_change_the_result(spark, docs, blocks, monkeypatch):
    want = sorted(map(repr, kept(spark, docs)))
    monkeypatch.setattr(line_dedup, "BLOCKS", ((None, blocks),))
    assert sorted(map(repr, kept(spark, docs))) == want


def test_cells_over_a_chunk(spark, docs, monkeypatch):
    """Cells of more rows than a task holds are dealt to pairs of chunks; no link is lost."""
    want = sorted(map(repr, kept(spark, docs)))
    monkeypatch.setattr(cells, "CHUNK", 6)
    monkeypatch.setattr(cells, "BATCH", 5)
    monkeypatch.setattr(line_dedup, "PARTS", 4)
    assert sorted(map(repr, kept(spark, docs))) == want


def test_links_of_one_hot_cell(spark, monkeypatch):
    rng = np.random.default_rng(2)
    fps = np.unique(rng.integers(0, 1 << 62, 12)[:, None] ^ (1 << rng.integers(0, 60, (12, 40))))
    rows = spark.createDataFrame([(c, int(f), int(f)) for f in fps for c in (3, -4)], "cell long, fp long, node long")
    join = lambda cell, fp, node: cells.forest(cell, fp, node, 2)

    def groups(links):
        label = {int(f): int(f) for f in fps}
        for _ in range(len(fps)):
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label

    pairs = [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[:i] if (int(a) ^ int(b)).bit_count() <= 2]
    for chunk in (1 << 16, 50, 9):
        got = [tuple(r) for r in cells.meet(rows, join, chunk).collect()]
        assert groups(got) == groups(pairs) and all(a < b for a, b in got)
        assert len(got) <= 60 * len(fps)


def test_failed_candidates_do_not_join_or_part(spark, monkeypatch):
    """Reordered lines have near SimHashes but no near edit distance; the others must still be joined."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = [" ".join(words), " ".join(reversed(words)), " ".join([*words[:59], "x"]), " ".join([*reversed(words[1:]), "x"])]
    got = kept(spark, list(enumerate(texts)))
    assert sorted(got) == sorted(brute_force(list(enumerate(texts)))) and dict(got)[0] and dict(got)[1]


def test_recall_over_all_pairs(spark):
    """One or two words of a line replaced: the pairs found of those that reach the similarity."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    lines, want = [], 0
    for _ in range(200):
        own = [word() for _ in range(rng.randrange(8, 40))]
        new = list(own)
        for i in rng.sample(range(len(own)), rng.choice([1, 2])):
            new[i] = word()
        lines += [" ".join(own), " ".join(new)]
        want += similar(*lines[-2:])
    rows = spark.createDataFrame(list(enumerate(lines)), SCHEMA)
    dropped = sum(r["lines_dropped"] for r in line_dedup.dedup_lines(rows).collect())
    assert want > 150 and 0.9 * want <= dropped <= want


def test_names_and_empty_tables(spark, docs):
    clash = {c: F.lit(7) for c in ("line", "lines", "doc", "node", "__doc", "__gone", "__i", "__d", "__g", "hash", "of", "id", "p")}
    rows = spark.createDataFrame(docs, SCHEMA).withColumns(clash)
    got = line_dedup.dedup_lines(rows)
    assert got.columns == [*rows.columns, "lines_in", "lines_dropped"]
    assert sorted(repr((r["doc_id"], r["text"])) for r in got.collect()) == sorted(map(repr, kept(spark, docs)))
    assert all(r[c] == 7 for r in got.collect() for c in clash)
    assert line_dedup.dedup_lines(rows.where("doc_id < -1")).count() == 0
    assert line_dedup.dedup_lines(rows.where("text is null")).first()["text"] is None


def test_very_long_lines(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**5)}" for _ in range(60_000)]
    texts = [" ".join(words), " ".join([*words[:30_000], "x", *words[30_001:]]), "x" * 300_000]
    got = dict(kept(spark, list(enumerate(texts))))
    assert got == {0: texts[0], 1: "", 2: texts[2]}


def test_hashes_do_not_depend_on_the_batch():
    texts = ["The quick, brown fox\n\njumps  over " + "the " * 700 + "dog", "x" * 300, "the QUICK brown fox"]
    whole = line_dedup.Lines(texts)
    parts = [line_dedup.Lines([t]) for t in texts]
    assert (whole.hashes() == np.concatenate([p.hashes() for p in parts])).all()
    assert (whole.simhashes() == np.concatenate([p.simhashes() for p in parts])).all()
    each = lambda x: [set(v[o[i] : o[i + 1]].tolist()) for v, o in [x.cells(x.words > 0)] for i in range(len(o) - 1)]
    assert each(whole) == [c for p in parts for c in each(p)]
    assert whole.row.tolist() == [0, 0, 1, 2] and whole.number.tolist() == [0, 2, 0, 0]
    assert (whole.hashes()[0] == whole.hashes()[3]).all()


def test_lines_that_meet_in_several_cells_are_compared_in_the_first():
    """Cell 0 is a cell like others, and in cells with new numbers every pair counts."""
    none = line_dedup.NONE
    own = np.array([[-5, 0, 7], [-5, 0, none], [0, 7, none], [0, 7, 9], [3, none, none]])

    def here(cell, i, j):
        return line_dedup.first_common(own, np.full(len(own), cell), np.array([i]), np.array([j]))[0]

    for i in range(4):
        for j in range(i + 1, 4):
            both = set(own[i]) & set(own[j]) - {none}
            assert [c for c in both if here(c, i, j)] == [min(both)]
    assert here(11, 0, 4) and here(11, 2, 3)


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out))
        out[i : i + rng.randrange(2)] = rng.choice(["", "x", "yz"])
    return "".join(out) or "x"


def test_distances_within_a_band():
    """Limits of any size, lengths that differ, and parts that change places, next to one pair at a time."""
    rng = random.Random(7)
    texts = []
    for top in (3, 60, 66, 130, 400, 1300):
        for _ in range(8):
            own = "".join(rng.choice("abcd ef") for _ in range(rng.randrange(1, top)))
            at = rng.randrange(len(own))
            texts += [own, edited(rng, own, rng.randrange(1 + len(own) // 4)), own[at:] + own[:at]]
    codes, sizes, letters = line_dedup.coded(texts)
    a, b = (x.ravel() for x in np.indices((len(texts), len(texts))))
    for share in (0.02, 0.2, 0.6):
        most = (np.maximum(sizes[a], sizes[b]) * share).astype(np.int64)
        got = line_dedup.edit_distances(codes, sizes, letters, a, b, most)
        some = rng.sample(range(len(a)), 300) + [i for i in range(len(a)) if a[i] // 3 == b[i] // 3]
        assert [got[k] for k in some] == [line_dedup.edit_distance(texts[a[k]], texts[b[k]], int(most[k])) for k in some]


def test_long_lines_are_compared_many_at_once(monkeypatch):
    rng = random.Random(8)
    own = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(250)) for _ in range(20)]
    new = [edited(rng, x, n) for x, n in zip(own, [100, 500] * 10, strict=True)]
    assert min(map(len, own)) > 1024
    at, lines = np.arange(20), line_dedup.Alike([*own, *new], 0.8)
    want = [similar(normal(x), normal(y)) for x, y in zip(own, new, strict=True)]
    monkeypatch.setattr(line_dedup, "SHARED", 0)
    monkeypatch.setattr(line_dedup, "alike", lambda *a: pytest.fail("one pair at a time"))
    assert lines(at, at + 20).tolist() == want and 0 < sum(want) < 20


def test_a_cell_asks_for_many_pairs_at_once():
    """300 unlike rows: 44,850 pairs in few rounds, as each round's distances cost about the same."""
    walk, rounds, asked = cells.connecting(np.zeros(300, np.uint64), 3, np.arange(300)), 0, 0
    with pytest.raises(StopIteration):
        i, j = next(walk)
        while True:
            rounds, asked = rounds + 1, asked + len(i)
            i, j = walk.send(np.zeros(len(i), bool))
    assert asked == 300 * 299 // 2 and rounds <= 10


def test_few_bytes_are_hashed_at_once(monkeypatch):
    """So that hashes stay in the cache; the MinHashes are those of each line alone."""
    monkeypatch.setattr(line_dedup, "SPAN", 500)
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(5, 60))) for _ in range(50)]
    lines, sizes, mix = line_dedup.Lines(texts), [], line_dedup.mix
    monkeypatch.setattr(line_dedup, "mix", lambda h: sizes.append(len(h)) or mix(h))
    which = np.flatnonzero(lines.ends - lines.starts >= 16)
    got = lines.minhashes(16, 4, which)
    assert max(sizes) <= 800
    base, far, full = line_dedup.BASE, line_dedup.FACTORS[-1], (1 << 64) - 1
    for row, k in zip(got, which.tolist(), strict=True):
        own = lines.bytes[k]
        whole = [int.from_bytes(own[i : i + 8], "little") * base + int.from_bytes(own[i + 8 : i + 16], "little") * far & full for i in range(len(own) - 15)]
        h = mix(np.array(whole, np.uint64))
        assert row.tolist() == [int((h * np.uint64(f)).min()) for f in line_dedup.FACTORS[:4]]
