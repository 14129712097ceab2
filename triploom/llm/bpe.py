"""Byte-level BPE encoding and decoding by per-prefix dynamic programming.

A text is cut into pieces by the byte-level split pattern. Within a piece,
every prefix has exactly one last token in its BPE encoding. The encoder
finds it from left to right: a suffix automaton over the vocabulary lists
the tokens that end at each byte, and a token is the prefix's last one when
the token before it (the stored last token of the shorter prefix) and it
form a compatible pair, which means that BPE run on the bytes of the two
gives back just those two. Following the stored tokens backwards from the
end of the piece emits the exact ids. Work is linear in the piece times the
few tokens that end at a byte, so a piece of any length is encoded whole.

Defined results: null and empty texts give no ids; strings of added tokens
in a text become their id, as the tokenizer file says; other columns stay.

The ids of a text travel as packed little-endian unsigned 32-bit integers
(``ids`` binary), four bytes a token.
"""

from __future__ import annotations

import functools
import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the byte-level split pattern of the tokenizer files.
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                 r"|\s+(?!\S)|\s+")
# The same pattern for ASCII texts, in terms that the plain engine knows.
ASCII_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+"
                 r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
# Sizes of a worker's caches; they change the speed, never the ids.
CACHE_ENTRIES = 150_000
PAIR_ENTRIES = 300_000
CACHED_PIECE_CHARS = 40
_START = 0xFFFFFFFF << 32   # stands before the first token of a piece


def byte_symbols() -> list[str]:
    """The printable symbol of each byte: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in byte order."""
    own = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    out, extra = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


@functools.lru_cache(maxsize=2)
def read_tokenizer(path: str) -> dict:
    """Vocabulary, merges and added tokens of a byte-level BPE tokenizer
    file, as bytes. The file has a fixed size, whatever the corpus; the
    driver keeps one copy, however many jobs use it."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    to_byte = {s: b for b, s in enumerate(byte_symbols())}

    def as_bytes(token: str) -> bytes:
        return bytes(to_byte[c] for c in token)

    added = {t["content"]: t["id"] for t in raw.get("added_tokens", [])}
    vocab = {as_bytes(t): i for t, i in raw["model"]["vocab"].items() if t not in added}
    merges = [m if isinstance(m, list) else m.split(" ") for m in raw["model"]["merges"]]
    return {"vocab": vocab, "added": added,
            "merges": [(as_bytes(a), as_bytes(b)) for a, b in merges]}


class Decoder:
    """Decoder of one vocabulary, for use inside a task."""

    def __init__(self, tables: dict):
        self.token = {i: t for t, i in tables["vocab"].items()}
        self.token |= {i: t.encode() for t, i in tables["added"].items()}

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        import numpy as np

        if not ids:
            return ""
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode(
            "utf-8", "replace")


class PrefixEncoder(Decoder):
    """Encoder of one vocabulary, for use inside a task."""

    def __init__(self, tables: dict):
        import ahocorasick
        import regex

        super().__init__(tables)
        self.rank = {pair: r for r, pair in enumerate(tables["merges"])}
        self.added = tables["added"]
        self.split_ascii = re.compile(ASCII_PATTERN).findall
        self.split = regex.compile(SPLIT_PATTERN).findall
        self.at_added = (regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")").split
            if self.added else None)
        self.suffixes = ahocorasick.Automaton()
        for t, i in tables["vocab"].items():
            # a token that BPE never builds from its own bytes is no suffix
            if self._merged(t) == [t]:
                self.suffixes.add_word(t.decode("latin-1"), (len(t), i))
        self.suffixes.make_automaton()
        self.packed = {i: i.to_bytes(4, "little") for i in self.token}
        self.first = {_START | i: True for i in self.token}
        self.pairs: dict[int, bool] = dict(self.first)
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merged(self, raw: bytes) -> list[bytes]:
        """BPE by its definition, for the short strings of the pair test."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        rank = self.rank
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: rank.get(p, 1 << 30))
            if best not in rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _compatible(self, pair: int) -> bool:
        a, b = self.token[pair >> 32], self.token[pair & 0xFFFFFFFF]
        if len(self.pairs) >= PAIR_ENTRIES:
            self.pairs = dict(self.first)
        self.pairs[pair] = ok = self._merged(a + b) == [a, b]
        return ok

    def encode_piece(self, piece: bytes) -> bytes:
        """Packed ids of one piece."""
        last = [_START]   # last token of each prefix, shifted; the first is empty
        known, done = self.pairs.get, 0
        for end, (size, token) in self.suffixes.iter(piece.decode("latin-1")):
            if end == done:   # this prefix has no last token yet
                pair = last[end + 1 - size] | token
                ok = known(pair)
                if ok is None:
                    ok = self._compatible(pair)
                    known = self.pairs.get
                if ok:
                    last.append(token << 32)
                    done += 1
        ids, at, token, packed = [], len(piece), self.token, self.packed
        if len(last) != at + 1:
            raise ValueError("the vocabulary doesn't cover every byte")
        while at > 0:
            i = last[at] >> 32
            ids.append(packed[i])
            at -= len(token[i])
        ids.reverse()
        return b"".join(ids)

    def _miss(self, piece: str) -> bytes:
        ids = self.older.get(piece) or self.encode_piece(piece.encode())
        if len(piece) <= CACHED_PIECE_CHARS:
            if len(self.pieces) >= CACHE_ENTRIES:   # two generations: what is
                self.older, self.pieces = self.pieces, {}   # in use moves over
            self.pieces[piece] = ids
        return ids

    def _text(self, text: str) -> bytes:
        pieces = (self.split_ascii if text.isascii() else self.split)(text)
        ids = list(map(self.pieces.get, pieces))
        at = -1
        for _ in range(ids.count(None)):
            at = ids.index(None, at + 1)
            ids[at] = self._miss(pieces[at])
        return b"".join(ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.at_added is None:
            return self._text(text)
        parts = self.at_added(text)
        return b"".join(self.packed[self.added[p]] if k % 2 else self._text(p)
                        for k, p in enumerate(parts) if p)


_BUILT: dict[tuple, Decoder] = {}


def _built(kind: type, shared) -> Decoder:
    """The coder of a broadcast vocabulary, built once per worker."""
    if (kind, shared.id) not in _BUILT:
        _BUILT.clear()
        _BUILT[kind, shared.id] = kind(shared.value)
    return _BUILT[kind, shared.id]


class _Shared:
    """Broadcast tables with a key that is the same in every task."""

    def __init__(self, spark: SparkSession, path: str):
        self.broadcast = spark.sparkContext.broadcast(read_tokenizer(path))
        self.id = uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def codec(spark: SparkSession, path: str):
    """(encode, decode): column functions text -> packed ids and back, for
    the byte-level BPE tokenizer file at ``path`` (read by the driver and
    broadcast; its size is fixed by the file)."""
    from collections.abc import Iterator

    import pandas as pd

    shared = _Shared(spark, path)

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _built(PrefixEncoder, shared)
        for texts in batches:
            yield pd.Series([enc.encode(t) for t in texts], dtype=object)

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _built(Decoder, shared)
        for ids in batches:
            yield pd.Series([enc.decode(i) for i in ids], dtype=object)

    # the UDF kind is read from the hints, which are strings in this module
    hints = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    encode.__annotations__, decode.__annotations__ = hints, hints
    return F.pandas_udf(encode, "binary"), F.pandas_udf(decode, "string")


def round_trip(spark: SparkSession, path: str):
    """Column function text -> struct(ids, decoded): packed ids and the text
    that they decode to, from one worker with one copy of the tables."""
    from collections.abc import Iterator

    import pandas as pd

    shared = _Shared(spark, path)

    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = _built(PrefixEncoder, shared)
        for texts in batches:
            ids = [enc.encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [enc.decode(i) for i in ids]})

    both.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(both, "ids binary, decoded string")


def n_tokens(ids: Column) -> Column:
    """Number of packed ids."""
    return F.coalesce(F.octet_length(ids) / 4, F.lit(0)).cast("long")


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text",
               ids_col: str = "ids") -> DataFrame:
    """``docs`` with its packed token ids; every other column is kept (a
    column already called ``ids_col`` is replaced)."""
    encode, _ = codec(docs.sparkSession, path)
    return docs.withColumn(ids_col, encode(F.col(f"`{text_col}`").cast("string")))


def bpe_decode(docs: DataFrame, path: str, ids_col: str = "ids",
               text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of its packed token ids."""
    _, decode = codec(docs.sparkSession, path)
    return docs.withColumn(text_col, decode(F.col(f"`{ids_col}`")))
