"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Text is split by a pattern, each piece is taken as UTF-8 bytes, each byte stands for one printable character, and the
merges run on these characters. The ranks file is read once on the driver; its size, which the vocabulary bounds, is
what tasks receive. Offsets of tokens are character positions, found through the byte lengths of the tokens: a token
that ends inside a character counts that character as its own last one.

Null texts are empty, empty texts have no tokens, and text of any length is encoded whole. Special tokens are ordinary
text. Each row is encoded by itself, so repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer, models

from ledgerlake.llm import tokens

BATCH_BYTES = 1 << 20
REMEMBERED = 250_000  # pieces in each of two generations that a Python worker remembers the ids of


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(256, 512))
    return [chr(byte) if byte in plain else chr(next(moved)) for byte in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs that join to a token, by the token's rank. Pairs of one token follow the order in which its bytes
    would be merged."""
    pairs = []
    for token in sorted(ranks, key=ranks.get):
        halves = [(token[:at], token[at:]) for at in range(1, len(token))]
        known = [(a, b) for a, b in halves if a in ranks and b in ranks]
        pairs += sorted(known, key=lambda pair: max(ranks[pair[0]], ranks[pair[1]]))
    return pairs


def tokenizer_text(path: str) -> str:
    """The tokenizer for a ranks file, as the text that tasks rebuild it from."""
    ranks, shown = read_ranks(path), byte_characters()

    def spelled(token: bytes) -> str:
        return "".join(shown[byte] for byte in token)

    vocabulary = {spelled(token): rank for token, rank in ranks.items()}
    merges = [(spelled(a), spelled(b)) for a, b in merges_of(ranks)]
    built = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
    return built.to_str()


class Codec:
    """Encodes texts and decodes ids; one per Python worker."""

    def __init__(self, description: str, pattern: str):
        self.pattern = regex.compile(pattern)
        self.model = Tokenizer.from_str(description).model
        self.vocabulary = Tokenizer.from_str(description).get_vocab(with_added_tokens=False)
        self.shown = dict(enumerate(byte_characters()))
        back = {character: byte for byte, character in self.shown.items()}
        self.bytes_of = [b""] * (max(self.vocabulary.values(), default=-1) + 1)
        for spelled, token in self.vocabulary.items():
            self.bytes_of[token] = bytes(back[character] for character in spelled)
        self.byte_lengths = np.array([len(token) for token in self.bytes_of], np.int64)
        self.remembered: int | None = None  # in place of REMEMBERED
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encode_one(text) for text in texts]

    def encode_one(self, text: str) -> list[int]:
        pieces = self.pattern.findall(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            if len(self.known) > (self.remembered or REMEMBERED):
                self.known, self.older = {}, self.known
            for place, ids in enumerate(found):
                if ids is None:
                    found[place] = self._piece(pieces[place])
        return list(chain.from_iterable(found))

    def _piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern. Recent pieces are remembered; those of the generation before are moved
        over when they occur again."""
        ids = self.known.get(piece) or self.older.get(piece)
        if ids is None:
            spelled = piece.encode().decode("latin-1").translate(self.shown)
            ids = [token.id for token in self.model.tokenize(spelled)]
        self.known[piece] = ids
        return ids

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.bytes_of[token] for token in ids])

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids; bytes that form no character are replaced."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def decode_stream(self, parts: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of successive lists of ids. A character split between two lists comes whole with the later one."""
        pending = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for ids in parts:
            yield pending.decode(self.decode_bytes(ids))
        yield pending.decode(b"", final=True)

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token and the one after its last."""
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.byte_lengths[np.asarray(ids, np.int64)])
        starts = ends - self.byte_lengths[np.asarray(ids, np.int64)]
        return character[starts], character[ends - 1] + 1


@lru_cache(maxsize=2)
def codec(description: str, pattern: str) -> Codec:
    return Codec(description, pattern)


def encode(docs: DataFrame, text: str, path: str, pattern: str, ids: str = "ids", offsets: bool = True) -> DataFrame:
    """The rows of ``docs`` with the column ``ids`` and, if wanted, ``<ids>_start`` and ``<ids>_end``. Columns of these
    names are replaced."""
    added = [ids, *([f"{ids}_start", f"{ids}_end"] if offsets else [])]
    kept = docs.drop(*added)
    integers = ArrayType(IntegerType(), False)

    def columns(coder: Codec, texts: list[str]) -> list[pa.Array]:
        encoded = coder.encode(texts)
        out = [pa.array(encoded, pa.list_(pa.int32()))]
        if offsets:
            places = [coder.offsets(t, i) for t, i in zip(texts, encoded, strict=True)]
            out += [pa.array([place[side] for place in places], pa.list_(pa.int32())) for side in (0, 1)]
        return out

    schema = StructType([*kept.schema.fields, *(StructField(name, integers, False) for name in added)])
    return _mapped(kept, text, path, pattern, added, columns, schema)


def digest(docs: DataFrame, id_column: str, text: str, path: str, pattern: str, ids: bool = False,
           remembered: int | None = None) -> DataFrame:
    """Per document the number of tokens, a digest of its ids and one of the bytes they decode to, and if wanted the
    ids. ``remembered`` is the number of pieces that workers remember, for less memory than by default."""
    schema = StructType([docs.schema[id_column]])
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    if ids:
        schema = schema.add("ids", ArrayType(IntegerType(), False))

    def columns(coder: Codec, texts: list[str]) -> list[pa.Array]:
        encoded = coder.encode(texts)
        out = [
            pa.array([len(own) for own in encoded], pa.int64()),
            pa.array([hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest() for own in encoded], pa.string()),
            pa.array([hashlib.sha256(coder.decode_bytes(own)).hexdigest() for own in encoded], pa.string()),
        ]
        return [*out, pa.array(encoded, pa.list_(pa.int32()))] if ids else out

    kept = docs.select(id_column, *({text} - {id_column}))
    return _mapped(kept, text, path, pattern, schema.names[1:], columns, schema, drop=True, remembered=remembered)


def decode(rows: DataFrame, ids: str, path: str, text: str = "text") -> DataFrame:
    """The rows with the text of their ids in column ``text``, which is replaced if there; null ids give null."""
    kept = rows.drop(text)
    sent = rows.sparkSession.sparkContext.broadcast(tokenizer_text(path))
    names = [*kept.columns, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(sent.value, "")
        for batch in batches:
            texts = [None if own is None else coder.decode(own) for own in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(text, StringType())]))


def _mapped(docs: DataFrame, text: str, path: str, pattern: str, added: list[str],
            columns: Callable[[Codec, list[str]], list[pa.Array]], schema: StructType, drop: bool = False,
            remembered: int | None = None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer_text(path))
    kept = [name for name in docs.columns if not (drop and name == text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(sent.value, pattern)
        coder.remembered = remembered
        for batch in tokens.pieces(batches, text, BATCH_BYTES):
            texts = [value or "" for value in batch.column(text).to_pylist()]
            old = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*old, *columns(coder, texts)], [*kept, *added])

    return docs.mapInArrow(run, schema)
