"""Fuzzy line dedup: SimHash, pigeonhole blocks, verified edit similarity, one line a group (operator 1).

Lines are normalised (lower case, runs of ASCII other than letters and digits to one space); equal
ones, by 128-bit hashes, are one. They are SimHashed over their words (a repeated word counts as
others). Fingerprints within RADIUS bits agree on all but RADIUS of the blocks that the 64 bits are
cut into, so every choice of the remaining blocks is a key under which such lines meet. One replaced
word of ten moves a SimHash by eight bits, which no pigeonhole blocks can serve, so lines also meet
by MinHashes of their character n-grams (GRAMS) and are then candidates within GRAM_RADIUS bits.
What meets and shares three quarters of its words (SHARED) is verified: an edit distance of at most a
fifth of the longer line's length. Of each
connected group, equal lines included, the occurrence of the least (doc_id, line number) stays and
the others leave their documents.

A key's lines give a spanning forest of candidates instead of all pairs (cells.py). Only where a
candidate fails the edit check are the parts that it would have joined looked at again: cell by
cell, with texts, nearest pairs first and none between lines that are connected by then. So
connectedness is that of all verified pairs that meet. The number of blocks follows the
number of lines; the result does not depend on it.

Lines of fewer than MIN_WORDS words agree by chance and are compared for equality alone, over all
documents, but a line of MIN_CHARS characters is long however few its words are (scripts without
spaces) and takes the SimHash of its pairs of characters, as do lines of over MAX_WORD characters a
word. Lines of nothing but ASCII signs always stay.

Defined cases: a null text stays null, an empty one empty; documents may become empty but stay;
rows that repeat a doc_id and text are one document (all copies keep the same lines); documents
without a doc_id come first; a text without a duplicate line stays as it is, byte for byte; an
empty table gives no rows; other columns pass through unchanged (lines_in and lines_dropped replace
columns of these names).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cells import connecting, forest, meet, parted, together
from .common import TEXT_BYTES, bind, bounded, components, cut, forget, fresh, released, setting, slices

RADIUS, MIN_WORDS, MIN_CHARS, MAX_WORD, SIMILARITY = 3, 5, 40, 16, 0.8
#: Blocks of a fingerprint by the number of distinct lines that they suffice for.
BLOCKS = ((50_000_000, 4), (1_000_000_000, 5), (None, 6))
#: (bytes of an n-gram, MinHashes of them, most bytes of the lines that get them or None), and the
#: SimHash radius of what meets by them.
GRAMS, GRAM_RADIUS = ((16, 4, None), (8, 2, 80)), 16
#: The share of words that lines must have in common (Dice, over so many hashed bits) for their edit distance to be looked at.
SHARED, SHARED_BITS = 0.75, 2048
BASE = 0x9E3779B97F4A7C15
#: Odd factors of the MinHashes.
FACTORS = [pow(BASE, 2 * k + 3, 1 << 64) for k in range(16)]
#: Bytes hashed at once; documents or lines in an Arrow batch; lines of a cell whose texts a task holds;
#: lines whose cells are compared at once.
PIECE, BATCH, PARTS, ABREAST = 1 << 16, 1000, 8192, 32768
#: Bytes of lines whose n-grams are hashed at once.
SPAN = 1 << 15
#: Stands for no cell.
NONE = np.iinfo(np.int64).max
#: Bytes of tables in which many pairs' edit distances are computed at once.
TABLES = 32 << 20
#: A space for each ASCII byte but letters, digits and the line feed.
SIGNS = bytes(b if b > 127 or b == 10 or chr(b).isalnum() else 32 for b in range(256))
#: A byte's eight bits, one in each byte of a word.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


@lru_cache(maxsize=1)
def powers(n: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64, for i < n."""
    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        both.append(np.cumprod(p))
    return both[0], both[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, from differences of running polynomial sums over bounded pieces."""
    up, down = powers()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + PIECE, "right"))
        if to <= at:  # one word longer than a piece
            out[at] = xxhash.xxh64_intdigest(data[starts[at] : ends[at]].tobytes())
            at += 1
            continue
        base = starts[at]
        part = data[base : ends[to - 1]].astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=total[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (total[e] - total[s]) * down[s]
        at = to
    return mix(out)


def features(h: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash for each word and how many of it came before in the line, line by line.

    By words alone all lines in which one word prevails would have that word's SimHash.
    """
    order = np.argsort(np.repeat(np.arange(len(words)).astype(np.uint64) << np.uint64(40), words) | h >> np.uint64(24), kind="stable")
    key = h[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    new[first] = True
    group = np.flatnonzero(new)
    return mix(key + (np.arange(len(h)) - np.repeat(group, np.diff(np.append(group, len(h))))).astype(np.uint64))


def simhashes(h: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """SimHashes of lines, given all words' hashes and each line's first word and number of words.

    Eight bits at a time are spread to the bytes of a word and added up, for at most 255 words.
    """
    h = features(h, first, words)
    parts = -(-words // 255)
    line = np.repeat(np.arange(len(words)), parts)
    begin = np.cumsum(parts) - parts
    starts = first[line] + 255 * (np.arange(len(line)) - begin[line])
    bits = np.empty((len(line), 64), np.uint8)
    for k, byte in enumerate(h.astype("<u8").view(np.uint8).reshape(-1, 8).T):
        bits[:, 8 * k : 8 * k + 8] = np.add.reduceat(SPREAD[byte], starts).view(np.uint8).reshape(-1, 8)
    ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int64) if len(line) > len(words) else bits.astype(np.int64)
    return np.packbits(2 * ones > words[:, None], axis=1, bitorder="little").view("<u8").ravel()


class Lines:
    """The lines with a word of some texts: each one's text, number in it, bytes and numbers of words and characters."""

    def __init__(self, texts: list[str]):
        raw = np.frombuffer("\n".join([*texts, ""]).lower().encode().translate(SIGNS), np.uint8)
        gap = np.concatenate(([True], raw <= 32))  # one place on
        word_starts, word_ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
        breaks = np.flatnonzero(raw == 10)
        line = np.searchsorted(breaks, word_starts)
        last = np.append(line[1:] != line[:-1], True) if len(line) else np.empty(0, bool)
        # words stay, and after each the first byte of the gap, which becomes a space or a line feed
        kept = ~gap[1:]
        kept[word_ends] = True
        sizes = word_ends - word_starts
        self.word_ends = np.cumsum(sizes + 1) - 1
        self.word_starts = self.word_ends - sizes
        data = np.concatenate((raw[kept], np.zeros(24, np.uint8)))  # windows may read beyond the end
        data[self.word_ends] = np.where(last, 10, 32)
        self.data, joined = data[: len(data) - 24], data.tobytes()
        self.ends = self.word_ends[last]
        self.first = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)) if len(self.ends) else np.empty(0, np.int64)
        self.starts = self.word_starts[self.first]
        self.words = np.diff(np.append(self.first, len(sizes)))
        self.bytes = [joined[x:y] for x, y in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]
        heads = np.cumsum([0, *[t.count("\n") + 1 for t in texts]])  # each text's first line
        self.row = np.searchsorted(heads, line[self.first], "right") - 1
        self.number = (line[self.first] - heads[self.row]).astype(np.int32)
        heads = (self.data & 0xC0 != 0x80).astype(np.int32)  # bytes that begin a character
        self.chars = np.add.reduceat(heads, self.starts) - 1 if len(self.ends) else self.words

    def hashes(self) -> np.ndarray:
        """Two longs for each line."""
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.bytes)), "<i8").reshape(-1, 2)

    def unspaced(self) -> np.ndarray:
        return (self.chars >= MIN_CHARS) & ((self.words < MIN_WORDS) | (self.chars > MAX_WORD * self.words))

    def simhashes(self) -> np.ndarray:
        """Over words, or over pairs of adjacent characters where words are few or long."""
        if not len(self.row):
            return np.empty(0, np.uint64)
        out = simhashes(word_hashes(self.data, self.word_starts, self.word_ends), self.first, self.words).copy()
        for i in np.flatnonzero(self.unspaced()):
            codes = mix(np.frombuffer(self.bytes[i].decode().encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1))
            h = mix(codes[:-1] * np.uint64(BASE) + codes[1:])
            out[i] = simhashes(h, np.zeros(1, np.int64), np.array([len(h)]))[0]
        return out

    def word_bits(self) -> np.ndarray:
        """For each line a row of bits, one for each of its words, hashed to SHARED_BITS; all bits where words are few or long."""
        out = np.zeros((len(self.row), SHARED_BITS // 64), np.uint64)
        if len(self.row):
            h = features(word_hashes(self.data, self.word_starts, self.word_ends), self.first, self.words)
            bit = h % np.uint64(SHARED_BITS)
            at = np.repeat(np.arange(len(self.row)), self.words)
            np.bitwise_or.at(out, (at, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
            out[self.unspaced()] = ~np.uint64(0)
        return out

    def minhashes(self, width: int, keys: int, which: np.ndarray) -> np.ndarray:
        """For each line of `which`, `keys` minima of hashes of its runs of `width` bytes: 8 or 16.

        Each is a MinHash of the line's n-grams: two lines share it as often as their n-grams are the same.
        """
        starts, stops = self.starts[which], self.ends[which] - width + 1
        data = self.data.base
        window = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
        out = np.empty((len(which), keys), np.uint64)
        at = 0
        while at < len(which):  # few lines at once, whose hashes stay in the processor's cache
            to = max(at + 1, int(np.searchsorted(stops, starts[at] + SPAN, "right")))
            base, stop = starts[at], stops[to - 1]
            h = window[base:stop] * np.uint64(BASE)
            if width == 16:
                h += window[base + 8 : stop + 8] * np.uint64(FACTORS[-1])
            h, product = mix(h), np.empty_like(h)
            edges = np.stack([starts[at:to], stops[at:to]], axis=1).ravel()[:-1] - base  # what lies between lines is passed over
            for k, f in enumerate(FACTORS[:keys]):
                out[at:to, k] = np.minimum.reduceat(np.multiply(h, np.uint64(f), out=product), edges)[::2]
            at = to
        return out

    def cells(self, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The MinHashes by GRAMS of the long lines, as a flat array with offsets: longs under 0, whose last bits tell which they are."""
        sizes, total = self.ends - self.starts, sum(keys for _, keys, _ in GRAMS)
        found, there, k = np.zeros((len(sizes), total), np.uint64), np.zeros((len(sizes), total), bool), 0
        for width, keys, most in GRAMS:
            which = np.flatnonzero(long & (sizes >= width) & (sizes <= (most or sizes.max(initial=0))))
            if len(which):
                found[which, k : k + keys] = self.minhashes(width, keys, which)
                there[which, k : k + keys] = True
            k += keys
        found = found & np.uint64(0x7FFFFFFFFFFFFFF0) | np.uint64(1 << 63) | np.arange(total, dtype=np.uint64)
        return found[there].view(np.int64), np.concatenate(([0], np.cumsum(there.sum(axis=1)))).astype(np.int32)


def numbered_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc, doc_id, text)."""
    for batch in batches:
        texts = batch.column("text").to_pandas()
        for part in slices(texts):
            own = Lines(texts[part].tolist())
            long = (own.words >= MIN_WORDS) | own.unspaced()
            doc = batch.slice(part.start, part.stop - part.start).select(["doc", "doc_id"]).take(pa.array(own.row))
            node, sim = own.hashes(), np.where(long, own.simhashes(), np.uint64(0)).view(np.int64)
            values, offsets = own.cells(long)
            columns = [*doc.columns, pa.array(own.number), pa.array(node[:, 0].copy()), pa.array(node[:, 1].copy()), pa.array(sim), pa.array(np.where(long, own.chars, 0).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "doc_id", "line", "hash", "hash2", "sim", "chars", "grams"])


def identified(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text) of the documents with a text; doc, a hash of both, tells those of one doc_id apart."""
    return docs.where("text is not null").select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, line, hash, hash2, sim, chars, grams) of each line with a letter or digit.

    hash, hash2: 128 bits of the normalised line; sim and chars (of the normalised line): 0 for short lines.
    """
    own = identified(docs)
    kind = dict(own.dtypes)["doc_id"]
    schema = f"doc long, doc_id {kind}, line int, hash long, hash2 long, sim long, chars long, grams array<long>"
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
        return cut(own.mapInArrow(released(numbered_lines), schema))


def keys(sim: Column, blocks: int, radius: int) -> Column:
    """The pigeonhole keys of a fingerprint: (which blocks, their bits) hashed to a long from 0 on."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned(sim, a).bitwiseAND(F.lit((1 << b - a) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    chosen = list(combinations(range(blocks), blocks - radius))
    if len(chosen[0]) == 1:
        return F.array(*[F.lit(c[0] << 32).bitwiseOR(part[c[0]]) for c in chosen])
    return F.array(*[F.xxhash64(F.lit(n), *[part[i] for i in c]).bitwiseAND(F.lit((1 << 63) - 1)) for n, c in enumerate(chosen)])


def same_length(chars: np.ndarray, similarity: float):
    """Pairs of rows whose lengths alone do not rule the similarity out: an edit adds one character."""

    def fit(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.abs(chars[i] - chars[j]) <= np.maximum(chars[i], chars[j]) * (1 - similarity) + 1e-9

    return fit


def reach(cell: np.ndarray, radius: int) -> np.ndarray:
    """The radius that holds in each row's cell."""
    return np.where(cell < 0, GRAM_RADIUS, radius)


def candidates_in_cell(similarity: float, radius: int):
    return lambda cell, fps, node, chars: forest(cell, fps, node, reach(cell, radius), same_length(chars, similarity))


def parts_in_cell(similarity: float, radius: int):
    """(cell, node) of the lines that have one of another part near."""

    def join(cell, fps, node, chars, label):
        rows = parted(cell, fps, reach(cell, radius), same_length(chars, similarity), label)
        return cell[rows], node[rows]

    return join


def first_common(own: np.ndarray, cell: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows meet first, by the number of the cell, in the cell that they are in.

    own: each row's cells, the rest NONE. Cells under 0 have the larger radius, so a pair near in one of its cells is
    near in the first. Cells that are dealt to pairs of chunks have new numbers, which no row has: there every pair counts.
    """
    out = np.empty(len(i), bool)
    for s in range(0, len(i), 4096):
        x, y = i[s : s + 4096], j[s : s + 4096]
        both = (own[x][:, :, None] == own[y][:, None, :]).any(axis=2) & (own[x] != NONE)
        least = np.where(both, own[x], NONE).min(axis=1)
        out[s : s + 4096] = (least == cell[x]) | ~(own[x] == cell[x][:, None]).any(axis=1)
    return out


def joined_parts(similarity: float, radius: int):
    """For mapInArrow over (cell, sim, node, label, raw, cells) sorted by cell: links (a, b) of lines that are alike, which connect the parts.

    Small cells are compared side by side, and lines that meet in several cells in the first of them.
    """

    def of(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        cell, fps, node, label = (np.concatenate([r.column(c).to_numpy() for r in rows]) for c in ("cell", "sim", "node", "label"))
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))).tolist()
        reached = reach(cell, radius)
        walks = [connecting(fps[s:e].view(np.uint64), reached[s], label[s:e], s) for s, e in zip(starts, [*starts[1:], len(cell)], strict=True)]
        held = np.concatenate([pc.list_value_length(r.column("cells")).to_numpy() for r in rows])
        own = np.full((len(held), int(held.max())), NONE)
        own[np.arange(own.shape[1]) < held[:, None]] = np.concatenate([r.column("cells").flatten().to_numpy() for r in rows])
        same = Alike([t for r in rows for t in r.column("raw").to_pylist()], similarity)

        def alike_here(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = first_common(own, cell, i, j)
            out[out] = same(i[out], j[out])
            return out

        links = together(walks, alike_here)
        return pa.RecordBatch.from_arrays([pa.array(node[[x[k] for x in links]]) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lines, size, now = [], 0, 0, None
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else []
            for s, e in zip(starts, [*starts[1:], len(cell)], strict=True):
                if held and cell[s] != now and (lines >= ABREAST or size >= 4 * TEXT_BYTES):
                    yield of(held)
                    held, lines, size = [], 0, 0
                held.append(batch.slice(s, e - s))
                lines, size, now = lines + e - s, size + pc.sum(pc.binary_length(held[-1].column("raw"))).as_py(), cell[s]
        if held:
            yield of(held)

    return released(run)


def shared(a, b) -> int:
    """The length of the common beginning, by bisection."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def inner(a, b):
    """Both sequences without their common beginning and end."""
    head = shared(a, b)
    a, b = a[head:], b[head:]
    tail = shared(a[::-1], b[::-1])
    return a[: len(a) - tail], b[: len(b) - tail]


def edit_distance(a, b, most: int) -> int:
    """The edit distance of two strings or lists, or most + 1 if it is larger.

    Bit-parallel: a column of the table is two integers.
    """
    a, b = inner(a, b)
    if not a or not b or abs(len(a) - len(b)) > most:
        return min(max(len(a), len(b)), most + 1)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    every, top = (1 << len(a)) - 1, 1 << len(a) - 1
    more, less, score = every, 0, len(a)  # where a cell is one more (one less) than that above it
    for n, c in enumerate(b, 1):
        same = at.get(c, 0)
        down = same | less
        across = (((same & more) + more) ^ more) | same
        rise, fall = less | ~(across | more) & every, more & across
        score += bool(rise & top) - bool(fall & top)
        if score - (len(b) - n) > most:  # the rest lowers it by one a step at most
            return most + 1
        rise, fall = (rise << 1 | 1) & every, fall << 1 & every
        more, less = fall | ~(down | rise) & every, rise & down
    return score


def alike(a: str, b: str, similarity: float) -> bool:
    """1 - edit distance / longer length >= similarity.

    Upper bounds come first: the length of what differs, then words replaced whole, the longest ones.
    """
    most = int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    x, y = inner(a, b)
    if max(len(x), len(y)) <= most:
        return True
    x, y = a.split(" "), b.split(" ")
    replaced = bisect_right(list(accumulate(sorted((len(w) + 1 for w in x + y), reverse=True))), most)
    if replaced and edit_distance(x, y, replaced) <= replaced:
        return True
    return edit_distance(a, b, most) <= most


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Texts as rows of small numbers for their characters, their lengths, and how many characters there are."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    there = np.zeros(int(flat.max(initial=0)) + 1, bool)
    there[flat] = True
    known = np.flatnonzero(there)
    codes = (np.cumsum(there, dtype=np.int32) - np.int32(1))[flat]
    out = np.zeros((len(texts), int(sizes.max(initial=0))), np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = codes
    return out, sizes, len(known)


def untrimmed(codes: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The longer length of rows a and b of coded texts without their common beginning and end."""
    wide = codes.shape[1]
    back = np.take_along_axis(codes, np.maximum(sizes[:, None] - 1 - np.arange(wide), 0), axis=1)
    least = np.minimum(sizes[a], sizes[b])
    same = []
    for rows in (codes, back):
        differs = rows[a] != rows[b]
        differs |= np.arange(wide) >= least[:, None]
        same.append(np.where(least < wide, differs.argmax(axis=1), np.where(differs.any(axis=1), differs.argmax(axis=1), wide)))
    return np.maximum(sizes[a], sizes[b]) - np.minimum(same[0] + same[1], least)


def edit_distances(codes: np.ndarray, sizes: np.ndarray, letters: int, a: np.ndarray, b: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
    """The edit distances of rows a and b of coded texts that are not empty, all pairs at once; those over `most` as most + 1.

    Bit-parallel by words of 64 characters of a: a column of the table is two bits a character, and
    what a word hands on to the next is a step up, down or neither. A word is one column behind the
    word above it, so all words of a column's band are computed at once. A path of at most `most` edits
    stays between the diagonals (d - most) / 2 and (d + most) / 2, where d is the difference of the
    lengths, so only words in that band are computed: cells beyond it count as one more than their
    neighbours within, which is never too little. Every 32 steps the pairs whose cell on the last
    diagonal, along which values only grow, is over `most` are left out.
    """
    most = np.maximum(sizes[a], sizes[b]) if most is None else most
    out, pair = most + 1, np.flatnonzero(np.abs(sizes[a] - sizes[b]) <= most)
    if not len(pair):
        return out
    a, b = a[pair], b[pair]
    words, one = -(-int(sizes[a].max()) // 64), np.uint64(1)
    rows, at = np.unique(a, return_inverse=True)
    there = np.zeros((words, len(rows) * letters), np.uint64)  # where a character stands in a row
    down_by_size = np.argsort(-sizes[rows], kind="stable")
    longer, text, place = sizes[rows][down_by_size], np.ascontiguousarray(codes[rows][down_by_size].T), down_by_size * letters
    for i, own in enumerate(np.searchsorted(-longer, -np.arange(int(longer[0])), "left").tolist()):
        there[i // 64, place[:own] + text[i, :own]] |= one << np.uint64(i % 64)
    word = there.shape[1] * np.arange(words)[:, None]
    there, m, n = there.ravel(), sizes[a], sizes[b]
    text = np.ascontiguousarray(codes[b, : int(n.max())].T[::-1]) + at * letters  # the last character first
    low_edge = int((-((most[pair] - m + n) // 2)).min())
    high_edge = max(int(((most[pair] + m - n) // 2).max()), low_edge + 1)
    up, down = np.full((words, len(a)), ~np.uint64(0)), np.zeros((words, len(a)), np.uint64)
    more, less = np.ones((words + 1, len(a)), np.uint64), np.zeros((words + 1, len(a)), np.uint64)  # what a word takes over
    score = np.full((words, len(a)), np.uint64(64))  # the cells in words' last rows
    last, begin, end = (m - 1) // 64, 0, 0

    def value(which: np.ndarray, w: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The table's cells in a row (from 1 to 64) of a word, in the column that the word is at."""
        beyond = ~(~np.uint64(0) >> (64 - row).astype(np.uint64))
        x, y = (np.bitwise_count(z[w, which] & beyond).astype(np.int64) for z in (up, down))
        return score[w, which].astype(np.int64) - x + y

    for t in range(1, int((n + last).max()) + 1):
        if t % 32 == 0:
            diagonal = t - 1 + m - n - 1  # of the step before
            w = np.clip(diagonal // 65, begin, end - 1)
            row = diagonal - 65 * w + 1
            known = np.flatnonzero((row >= 1) & (row <= 65) & (t - 1 - w <= n))
            live = n + last >= t
            live[known] &= value(known, w[known], np.minimum(row[known], 64)) - (row[known] > 64) <= most[pair[known]]
            live = np.flatnonzero(live)
            if not len(live):
                break
            if len(live) < 0.9 * len(m):
                pair, m, n, last = pair[live], m[live], n[live], last[live]
                text, up, down, more, less, score = (x[:, live] for x in (text, up, down, more, less, score))
        begin = max(begin, -((64 - t - low_edge) // 65), t - len(text))
        new = min(words, (t - 1 + high_edge) // 65 + 1, t)
        if new > end:
            if end:
                score[end] += score[end - 1] - more[end] + less[end]
            end = new
        top = len(text) - t
        same = there.take(text[top + begin : top + end] + word[begin:end])
        own_up, own_down = up[begin:end], down[begin:end]
        side = same | own_down
        same |= less[begin:end]
        rise = same & own_up
        rise += own_up
        rise ^= own_up
        rise |= same
        fall = own_up & rise
        rise |= own_up
        np.invert(rise, out=rise)
        rise |= own_down
        high, low = rise << one, fall << one
        high |= more[begin:end]
        low |= less[begin:end]
        more[begin], less[begin] = 1, 0  # the word above hands on nothing from now on
        np.right_shift(rise, np.uint64(63), out=more[begin + 1 : end + 1])
        np.right_shift(fall, np.uint64(63), out=less[begin + 1 : end + 1])
        score[begin:end] += more[begin + 1 : end + 1]
        score[begin:end] -= less[begin + 1 : end + 1]
        np.bitwise_and(high, side, out=own_down)
        side |= high
        np.invert(side, out=side)
        np.bitwise_or(low, side, out=own_up)
        done = np.flatnonzero(n + last == t)
        if len(done):
            out[pair[done]] = np.minimum(value(done, last[done], m[done] - 64 * last[done]), most[pair[done]] + 1)
    return out


class Alike:
    """alike() for many pairs of some lines, normalised, by their numbers; pairs that share too few words are not alike.

    Lines of up to `wide` characters are compared many at once.
    """

    def __init__(self, lines: list[str], similarity: float, wide: int = 8192, many: int = 2048):
        """lines: as they stand, each with a word."""
        owns = [(own.bytes, own.word_bits(), own.chars) for own in (Lines(lines[part]) for part in slices(pd.Series(lines, dtype=object)))]
        self.texts, self.similarity, self.wide, self.many = [x.decode() for own in owns for x in own[0]], similarity, wide, many
        self.words, self.sizes = np.concatenate([own[1] for own in owns]), np.concatenate([own[2] for own in owns]).astype(np.int64)
        self.held = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs share enough words."""
        out = np.empty(len(a), bool)
        for s in range(0, len(a), 4096):
            i, j = a[s : s + 4096], b[s : s + 4096]
            both = np.bitwise_count(self.words[i] & self.words[j]).sum(axis=1, dtype=np.int64)
            out[s : s + 4096] = 2 * both >= SHARED * (self.held[i] + self.held[j])
        return out

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        longer = np.maximum(self.sizes[a], self.sizes[b])
        most = (longer * (1 - self.similarity) + 1e-9).astype(np.int64)
        todo = np.flatnonzero(np.abs(self.sizes[a] - self.sizes[b]) <= most)
        todo = todo[self.shared(a[todo], b[todo])]
        single = longer[todo] > self.wide
        for k in todo[single].tolist():
            out[k] = alike(self.texts[a[k]], self.texts[b[k]], self.similarity)
        todo = todo[~single]
        todo = todo[np.argsort(longer[todo], kind="stable")]
        start = 0
        while start < len(todo):
            # lines of like length
            some = todo[start : min(start + self.many, max(start + 16, int(np.searchsorted(longer[todo], 1.25 * longer[todo[start]] + 16))))]
            rows, at = np.unique(np.concatenate([a[some], b[some]]), return_inverse=True)
            codes, own, letters = coded([self.texts[r] for r in rows.tolist()])
            # as many pairs as tables have room for: a bit for each of a line's characters and letters
            fit = max(16, 8 * TABLES // (letters * (int(own.max()) + 64)))
            if len(some) > fit:
                some, at = some[:fit], np.concatenate([at[:fit], at[len(some) : len(some) + fit]])
            start += len(some)
            x, y = at[: len(some)], at[len(some) :]
            out[some] = untrimmed(codes, own, x, y) <= most[some]
            rest = np.flatnonzero(~out[some])
            some, x, y = some[rest], x[rest], y[rest]
            if letters > 512 or len(some) < 12:  # scripts of many characters, or few pairs
                out[some] = [alike(self.texts[a[k]], self.texts[b[k]], self.similarity) for k in some.tolist()]
            else:
                out[some] = edit_distances(codes, own, letters, x, y, most[some]) <= most[some]
        return out


def texts_of(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, raw: the line as it stands), as a table, for reps (node, doc_id, doc, line)."""
    wanted = cut(reps.groupBy(F.col("doc_id").alias("id"), F.col("doc").alias("of")).agg(F.collect_list(F.struct("line", "node")).alias("wanted")))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("doc") == F.col("of"))
    found = identified(docs).join(bounded(wanted, 48, F.size("wanted") + 1), same)
    pick = lambda lines: F.transform("wanted", lambda w: F.struct(w["node"].alias("node"), F.get(lines, w["line"]).alias("raw")))
    # documents that repeat give their lines once
    out = cut(found.select(F.inline(bind(F.split("text", "\n"), pick))).dropDuplicates(["node"]))
    forget(wanted)
    return out


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """pairs (a, b) plus ok, as a table."""
    x = texts.select(F.col("node").alias("a"), F.col("raw").alias("__x"))
    y = texts.select(F.col("node").alias("b"), F.col("raw").alias("__y"))

    @F.pandas_udf(T.BooleanType())
    def check(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        at = np.arange(len(a))
        return pd.Series(Alike([*a, *b], similarity)(at, at + len(a)))

    return cut(pairs.join(x, "a").join(y, "b").select("a", "b", check("__x", "__y").alias("ok")))


def similar_lines(docs: DataFrame, nodes: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(node, component) of the lines that are connected to another one. nodes: (node, sim, chars, grams, doc_id, doc, line), a table."""
    n = nodes.count()
    blocks = next(b for most, b in BLOCKS if most is None or n <= most)

    own_cells = F.concat(keys(F.col("sim"), blocks, radius), "grams")

    def cells(rows: DataFrame, *extra: str) -> DataFrame:
        return rows.select(F.explode(own_cells).alias("cell"), "sim", "node", "chars", *extra)

    candidates = meet(cells(nodes), candidates_in_cell(similarity, radius))
    ends = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    texts = texts_of(docs, nodes.join(ends, "node"))
    links = verified(candidates, texts, similarity)
    good, failed = links.where("ok").select("a", "b"), links.where("not ok").select("a", "b")
    comp = components(good)
    done = [candidates, texts, links]
    if failed.limit(1).count():
        # what a cell's forest had joined is now in parts, and each holds an end of a candidate that failed
        label = F.coalesce("component", "node").alias("label")
        bad = failed.select(F.col("a").alias("node")).union(failed.select("b")).distinct()
        bad = bad.join(comp, "node", "left").select(label).distinct()
        rest = nodes.join(ends, "node").join(comp, "node", "left").select("node", "sim", "chars", "grams", label)
        rest = cut(rest.join(bad, "label", "left_semi"))
        met = meet(cells(rest, "label"), parts_in_cell(similarity, radius), PARTS, links=False).toDF("cell", "node")
        dealt = met.join(rest.select("node", "sim", "label", own_cells.alias("cells")), "node").join(texts, "node").select("cell", "sim", "node", "label", "raw", "cells")
        with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
            more = cut(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(joined_parts(similarity, radius), "a long, b long"))
        done += [rest, more]
        if more.limit(1).count():
            done.append(comp)
            comp = components(good.union(more))
    forget(*done)
    return comp


def dropped_lines(docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, doc, lines), as a table: the numbers of the lines to drop from each document that has such."""
    found = occurrences(docs)
    place = F.struct("doc_id", "doc", "line")
    groups = found.groupBy("hash", "hash2").agg(F.min(place).alias("rep"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("sim", "chars", "grams")])
    groups = cut(groups.withColumn("node", F.monotonically_increasing_id()))
    nodes = groups.where("chars > 0").select("node", "sim", "chars", "grams", "rep.*")
    comp = similar_lines(docs, nodes, radius, similarity)
    slim = groups.select("node", "hash", "hash2", "rep", "n")
    joined = slim.join(comp, "node")
    best = joined.groupBy("component").agg(F.min("rep").alias("best"))
    joined = joined.join(best, "component").select("hash", "hash2", "best")
    alone = slim.where("n > 1").join(comp.select("node"), "node", "left_anti").select("hash", "hash2", F.col("rep").alias("best"))
    keep = cut(joined.unionByName(alone))
    gone = found.select("doc_id", "doc", "line", "hash", "hash2").join(bounded(keep, 80), ["hash", "hash2"])
    gone = gone.where(~place.eqNullSafe(F.col("best"))).groupBy("doc_id", "doc").agg(F.collect_set("line").alias("lines"))
    out = cut(gone)
    forget(found, groups, comp, keep)
    return out


def dedup_lines(docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """docs with their text after dedup, plus lines_in and lines_dropped."""
    i, d, g = (fresh(docs, x) for x in ("i", "d", "g"))
    gone = dropped_lines(docs.select("doc_id", "text"), radius, similarity).toDF(i, d, g)

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(g))
        return F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")

    text = F.when(F.col(g).isNull(), F.col("text")).otherwise(bind(F.split("text", "\n"), rest))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("doc_id", "text") == F.col(d))
    out = docs.join(bounded(gone, 24, F.size(g) + 2), same, "left")
    counts = {"lines_in": F.coalesce(F.size(F.split("text", "\n")), F.lit(0)), "lines_dropped": F.coalesce(F.size(g), F.lit(0))}
    own = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in counts]
    return out.select(*own, *[v.alias(c) for c, v in counts.items()])
