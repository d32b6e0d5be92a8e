"""Byte-level BPE with the tiktoken library and a local rank file.

Spark deals the rows out; each Arrow batch is encoded by one `Encoding` per
worker. Nothing is shuffled.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybrook.llm.shared import let_workers_import

# Texts longer than this many characters are encoded in pieces of about this length.
PIECE_CHARS = 65_536
# The end of a piece: before a space that follows anything but white space. Whatever the
# pattern matches there starts at the space, since only a leading space joins other characters.
SAFE_END = re.compile(r"(?<=\S) ")

_ENCODINGS: dict[tuple[bytes, str], tiktoken.Encoding] = {}


def rank_file(path: str) -> bytes:
    """The contents of a rank file; it is a few MB whatever the input is."""
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, made once per process."""
    if (ranks, pattern) not in _ENCODINGS:
        pairs = (line.split() for line in ranks.splitlines() if line)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        _ENCODINGS[ranks, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
    return _ENCODINGS[ranks, pattern]


def pieces(text: str, length: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces that are encoded alone as they would be together.

    A piece ends at the first safe place at or after `length` characters. A run
    without such a place stays whole, however long it is.
    """
    start = 0
    while len(text) - start > length and (found := SAFE_END.search(text, start + length)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_text(encoder: tiktoken.Encoding, text: str | None) -> np.ndarray:
    """Token ids of one text as 32-bit numbers, little end first; none for no text."""
    if not text:
        return np.empty(0, "<u4")
    if len(text) <= PIECE_CHARS:
        return encoder.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
    parts = [encoder.encode_to_numpy(p, disallowed_special=()) for p in pieces(text)]
    return np.concatenate(parts).astype("<u4", copy=False)


def decode_ids(encoder: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    """The raw bytes of token ids; they need not be valid UTF-8."""
    return encoder.decode_bytes(ids.tolist())


def _with_columns(frame: DataFrame, source: str, work, added: list[T.StructField]) -> DataFrame:
    """Map Arrow batches, adding the columns that `work(values)` makes of `source`.

    A given column with the name of an added one gives way to it.
    """
    let_workers_import(frame.sparkSession)
    named = {f.name for f in added}
    kept = [f for f in frame.schema.fields if f.name not in named]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A batch of long texts is worked on in slices, so that what is made of it stays small.
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                columns = work(part.column(part.schema.get_field_index(source)))
                given = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*given, *columns], names=schema.names)

    return frame.mapInArrow(run, schema)


def encode(
    frame: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add `ids`: the token ids as packed unsigned 32-bit numbers, little end first.

    A null or empty text has no ids (an empty value, not null). Special tokens
    are ordinary text. All columns stay, but one named like `ids` is replaced.
    """

    def work(values):
        encoder = encoding(ranks, pattern)
        return [pa.array([encode_text(encoder, v).tobytes() for v in values.to_pylist()], pa.binary())]

    return _with_columns(frame, text, work, [T.StructField(ids, T.BinaryType())])


def decode(
    frame: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add `decoded`: the bytes that packed ids stand for; null ids stand for none."""

    def work(values):
        encoder = encoding(ranks, pattern)
        out = (decode_ids(encoder, np.frombuffer(v or b"", "<u4")) for v in values.to_pylist())
        return [pa.array(list(out), pa.binary())]

    return _with_columns(frame, ids, work, [T.StructField(decoded, T.BinaryType())])


def encode_and_decode(
    frame: DataFrame, ranks: bytes, pattern: str, text: str = "text"
) -> DataFrame:
    """Add `ids` and `decoded` as `encode` and `decode` do, in one pass over the texts."""

    def work(values):
        encoder = encoding(ranks, pattern)
        ids = [encode_text(encoder, v) for v in values.to_pylist()]
        packed = pa.array([i.tobytes() for i in ids], pa.binary())
        return [packed, pa.array([decode_ids(encoder, i) for i in ids], pa.binary())]

    added = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]
    return _with_columns(frame, text, work, added)
