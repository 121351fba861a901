"""Byte-level BPE encoding and decoding through a serialised sentencepiece model (operator 4).

A rank file's vocabulary becomes a sentencepiece BPE model directly: each token's bytes are
written as one printable character a byte, with the negative rank as the piece's score, an
identity normaliser and no prefix, whitespace or byte-fallback handling. Sentencepiece then merges
the pair of the best score, leftmost first, which is the lowest rank, leftmost first. A text's
pre-tokens are encoded one by one; ids are decoded through the inverse character map.

Defined cases: null and empty texts give no ids and empty bytes; texts of any length are encoded
whole (very long ones in pieces of whole pre-tokens, with bounded memory); repeated rows each get
a row; other columns pass through `encode` unchanged.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from .common import series_udf

#: Pre-tokens whose ids a worker remembers, and the longest remembered.
MEMO, MEMO_CHARS = 100_000, 64
#: Texts over this length are split by an iterator instead of a list.
LONG_TEXT = 1 << 20
VOCABULARY = "byte_bpe_50k.tiktoken"


def byte_chars() -> list[str]:
    """A character for each byte: itself where it is printable and no space, else one from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in rank order; ranks must run from 0 without a gap."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"{path}: ranks have gaps")
    return [tokens[i] for i in range(len(tokens))]


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece ids are the ranks; <unk> comes after them."""
    chars = byte_chars()
    model = proto.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(map(chars.__getitem__, token)), score=-float(rank), type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type = proto.TrainerSpec.BPE
    spec.vocab_size, spec.unk_id = len(model.pieces), len(tokens)
    spec.bos_id = spec.eos_id = spec.pad_id = -1
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


@lru_cache(maxsize=4)
def splitters(pattern: str) -> tuple[regex.Pattern, regex.Pattern | None, regex.Pattern | None]:
    """The pattern, one that finds characters on whose class regex and the tokenizer's library differ
    (their Unicode versions differ), and the pattern as the library reads it for texts that hold such.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    exact, odd = pattern, set()
    for name in (r"\p{L}", r"\p{N}"):
        theirs = tiktoken.Encoding("class", pat_str=f"{name}+", mergeable_ranks=single, special_tokens={})
        known = set(theirs.decode_bytes(theirs.encode_ordinary(every)).decode())
        odd |= known ^ set(regex.findall(name, every))
        exact = regex.sub(r"(\[[^\]]*)" + regex.escape(name), lambda m, s=spans(known): m[1] + s, exact).replace(name, f"[{spans(known)}]")
    if not odd:
        return regex.compile(pattern), None, None
    return regex.compile(pattern), regex.compile(f"[{spans(odd)}]"), regex.compile(exact)


def spans(chars: set[str]) -> str:
    """A set of characters as the inside of a regex class."""
    codes = np.array(sorted(map(ord, chars)), np.int64)
    if not len(codes):
        return ""
    ends = np.flatnonzero(np.diff(codes) > 1)
    first, last = codes[np.append(0, ends + 1)], codes[np.append(ends, len(codes) - 1)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist(), strict=True))


class Codec:
    """One worker's encoder and decoder."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.fast, self.odd, self.exact = splitters(pattern)
        self.chars = dict(enumerate(byte_chars()))
        inverse = {ord(c): b for b, c in self.chars.items()}
        self.bytes_of = [bytes(map(inverse.__getitem__, map(ord, self.processor.id_to_piece(i)))) for i in range(self.processor.get_piece_size() - 1)]
        self.memo: dict[str, bytes] = {}

    def mapped(self, token: str) -> str:
        return token.encode().decode("latin-1").translate(self.chars)

    def splitter(self, text: str) -> regex.Pattern:
        try:
            text.encode("latin-1")  # no character in doubt is in there
        except UnicodeEncodeError:
            if self.odd is not None and self.odd.search(text):
                return self.exact
        return self.fast

    def ids(self, tokens: list[str]) -> bytes:
        new = list(set(tokens).difference(self.memo))
        if not new:
            return b"".join(map(self.memo.__getitem__, tokens))
        coded = self.processor.encode(list(map(self.mapped, new)), num_threads=1)
        packed = dict(zip(new, (np.array(x, "<u4").tobytes() for x in coded), strict=True))
        if len(self.memo) + len(new) > MEMO:
            self.memo = {}
            if len(packed) < len(set(tokens)):  # the rest of the text's tokens have just been forgotten
                rest = [t for t in set(tokens) if t not in packed]
                packed |= zip(rest, (np.array(x, "<u4").tobytes() for x in self.processor.encode(list(map(self.mapped, rest)), num_threads=1)), strict=True)
            self.memo = {k: v for k, v in islice(packed.items(), MEMO) if len(k) <= MEMO_CHARS}
            return b"".join(map(packed.__getitem__, tokens))
        out = b"".join([packed[t] if t in packed else self.memo[t] for t in tokens])
        self.memo |= {k: v for k, v in packed.items() if len(k) <= MEMO_CHARS}
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pattern = self.splitter(text)
        if len(text) <= LONG_TEXT:
            return self.ids(pattern.findall(text))
        found, out = pattern.finditer(text), []
        while part := [m.group() for m in islice(found, 1 << 17)]:
            out.append(self.ids(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


def encode(df: DataFrame, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """df plus `ids`: the text's ids, packed as little-endian unsigned 32-bit integers."""
    shared = df.sparkSession.sparkContext.broadcast(serialise(read_ranks(path or public_tokenizers.path(VOCABULARY))))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(shared.value, pattern)
        for texts in batches:
            yield pd.Series([own.encode(t) for t in texts], dtype=object)

    return df.withColumn("ids", series_udf(run, T.BinaryType())(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """df plus `decoded`: the bytes that packed ids stand for (null ids: no bytes)."""
    shared = df.sparkSession.sparkContext.broadcast(serialise(read_ranks(path or public_tokenizers.path(VOCABULARY))))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(shared.value, pattern)
        for packed in batches:
            yield pd.Series([own.decode(x or b"") for x in packed], dtype=object)

    return df.withColumn("decoded", series_udf(run, T.BinaryType())(F.col(ids)))
