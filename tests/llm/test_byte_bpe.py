import hashlib
import os
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import byte_bpe, queries

RANKS = byte_bpe.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.encoding(RANKS, PATTERN)


def test_edge_texts_round_trip(edge, encoder):
    rows = byte_bpe.encode_and_decode(edge.withColumn("ids", F.lit("given")), RANKS, PATTERN).collect()
    assert len(rows) == edge.count()
    for row in rows:
        expected = np.array(encoder.encode_ordinary(row.text or ""), "<u4").tobytes()
        assert bytes(row.ids) == expected
        assert bytes(row.decoded) == (row.text or "").encode()


def test_encode_then_decode(edge):
    coded = byte_bpe.decode(byte_bpe.encode(edge, RANKS, PATTERN), RANKS, PATTERN)
    assert coded.where("decoded <> encode(coalesce(text, ''), 'utf-8')").count() == 0
    lost = byte_bpe.decode(edge.select(F.lit(None).cast("binary").alias("ids")), RANKS, PATTERN)
    assert {bytes(r.decoded) for r in lost.collect()} == {b""}


def test_no_rows(nothing):
    assert byte_bpe.encode_and_decode(nothing, RANKS, PATTERN).count() == 0


@pytest.mark.parametrize(
    "text",
    ["ab 12" * 900, "x  \n y's <|endoftext|>" * 300, " " * 5000, "é ß  " * 900, "a" * 5000, "a \x1c b" * 700],
)
def test_pieces_encode_as_the_whole(encoder, text):
    parts = list(byte_bpe.pieces(text, 100))
    assert "".join(parts) == text
    assert sum((encoder.encode_ordinary(p) for p in parts), []) == encoder.encode_ordinary(text)


def test_a_part_of_a_character_decodes_to_its_bytes(encoder):
    ids = encoder.encode_ordinary("日")
    assert byte_bpe.decode_ids(encoder, np.array(ids[:1], "<u4")) == "日".encode()[: len(encoder.decode_bytes(ids[:1]))]


def test_query(spark, sf_dir, encoder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op5_byte_bpe(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        ids = encoder.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_workers_find_the_package(spark):
    byte_bpe.encode(spark.createDataFrame([("a",)], "text string"), RANKS, PATTERN)
    paths = spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep)
    place = str(Path(byte_bpe.__file__).resolve().parents[2])
    byte_bpe.encode(spark.createDataFrame([("a",)], "text string"), RANKS, PATTERN)
    assert paths.count(place) == 1 == spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep).count(place)
