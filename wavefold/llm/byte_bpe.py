"""Byte-level BPE through a sentencepiece model serialised from a rank file.

The model is written field by field from the vocabulary: every byte becomes one
character, every token the string of its bytes' characters, scored by its
negative rank, so that the highest score is the lowest rank.  Normalisation is the
identity.  Texts are split by the tokenizer's pattern and each match is encoded
separately; ids map back to bytes by the inverse table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHE_ENTRIES = 1 << 17  # of either memory of a worker
# Characters for bytes: one block of 256 letters without white space or the model's own marker.
_FIRST = 0x100
_TO_CHARS = {b: _FIRST + b for b in range(256)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: varint, 32-bit float or bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        pairs = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines)]
    return [token for _, token in sorted(pairs)]


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks (an unknown piece comes last)."""
    # Field numbers and enum values of the public model format.
    piece_text, piece_score, piece_type, unknown_type, bpe = 1, 2, 3, 2, 2
    out = []
    for rank, token in enumerate(tokens):
        text = token.decode("latin-1").translate(_TO_CHARS).encode()
        out.append(_field(1, _field(piece_text, text) + _field(piece_score, -float(rank))))
    out.append(_field(1, _field(piece_text, b"<unk>") + _field(piece_score, 0.0) + _field(piece_type, unknown_type)))
    minus_one = (1 << 64) - 1
    trainer = _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    trainer += _field(41, minus_one) + _field(42, minus_one) + _field(43, minus_one)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes whole texts; made once per Python worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self._whole = {token: rank for rank, token in enumerate(self.tokens)}
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self._matches = regex.compile(pattern).findall
        # The pattern never lets a match run on into a space before a visible character.
        self._loose_space = regex.compile(r" (?=\s|\Z)").search
        self._cut = regex.compile(r" (?=\S)").split
        self._of_match: dict[str, bytes] = {}
        self._of_piece: dict[str, bytes] = {}

    def _learn_matches(self, matches: set[str]) -> None:
        merged, names = [], []
        for match in matches:
            raw = match.encode()
            rank = self._whole.get(raw)
            if rank is None:
                names.append(match)
                merged.append(raw.decode("latin-1").translate(_TO_CHARS))
            else:
                self._of_match[match] = struct.pack("<I", rank)
        if merged:
            for match, ids in zip(names, self._model.encode(merged, num_threads=1), strict=True):
                self._of_match[match] = struct.pack(f"<{len(ids)}I", *ids)

    def _learn_pieces(self, pieces: Iterable[str]) -> None:
        split = {piece: self._matches(" " + piece) for piece in pieces}
        if len(self._of_match) > CACHE_ENTRIES:
            self._of_match.clear()
        unknown = {match for found in split.values() for match in found}.difference(self._of_match)
        self._learn_matches(unknown)
        for piece, found in split.items():
            self._of_piece[piece] = b"".join(map(self._of_match.__getitem__, found))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        The text is cut before each space that precedes a visible character, where the pattern
        always ends a match; the pieces' ids are remembered, so only new pieces meet the pattern and the model.
        """
        pieces = self._cut(text) if self._loose_space(text) else text.split(" ")
        head = self._matches(pieces.pop(0))
        if len(self._of_piece) > CACHE_ENTRIES:
            self._of_piece.clear()
        missing = set(pieces).difference(self._of_piece)
        if missing:
            self._learn_pieces(missing)
        self._learn_matches(set(head).difference(self._of_match))
        ids = [*map(self._of_match.__getitem__, head), *map(self._of_piece.__getitem__, pieces)]
        return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return pc.fill_null(batch.column(column), "").to_pylist()


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """``docs`` plus ``token_ids array<int>`` and ``n_tokens bigint`` of the whole text; with ``decoded`` also ``decoded_sha256``
    of the text that the ids give.

    Null or empty text: no tokens.  Existing columns of those names are replaced; all others stay, repeated rows too.  A very long text is
    encoded whole, one at a time.
    """
    own_path, own_pattern = default_vocabulary() if path is None or pattern is None else (path, pattern)
    path, pattern = path or own_path, pattern or own_pattern
    names = ["token_ids", "n_tokens", *["decoded_sha256"] * decoded]
    base = docs.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                ids = [np.frombuffer(own.encode(t), "<u4").astype(np.int32) for t in _texts(part, "text")]
                counts = np.array([len(x) for x in ids], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                added = [tokens, pa.array(counts)]
                if decoded:
                    added.append(pa.array([_digest(own, x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *names])

    kinds = [T.ArrayType(T.IntegerType()), T.LongType(), T.StringType()]
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *map(T.StructField, names, kinds)]))


def _digest(own: Codec, ids: np.ndarray) -> str:
    return hashlib.sha256(own.decode(ids.astype("<u4").tobytes())).hexdigest()


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def token_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode every text, decode its ids, and digest both: the round trip per document.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256``; null text counts as empty.
    """
    own_path, own_pattern = default_vocabulary() if path is None or pattern is None else (path, pattern)
    path, pattern = path or own_path, pattern or own_pattern

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                counts, id_digests, text_digests = [], [], []
                for text in _texts(part, "text"):
                    ids = own.encode(text)
                    counts.append(len(ids) // 4)
                    id_digests.append(hashlib.sha256(ids).hexdigest())
                    text_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                     pa.array(text_digests, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` plus ``decoded_sha256`` of the text that its ``token_ids`` give."""
    own_path, own_pattern = default_vocabulary() if path is None or pattern is None else (path, pattern)
    path, pattern = path or own_path, pattern or own_pattern

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                ids = part.column("token_ids")
                digests = [_digest(own, x.values.to_numpy(zero_copy_only=False)) for x in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digests, pa.string())],
                                                 names=[*part.schema.names, "decoded_sha256"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded_sha256", T.StringType())]))


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every text of ``documents`` with the multilingual 50k ranks."""
    return token_digests(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
