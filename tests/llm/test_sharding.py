import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import queries, sharding


def lawful(rows, shards):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes[s] for s in range(shards)]
    assert set(sizes) <= set(range(shards)) and max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges(edge, nothing):
    rows = sharding.sharded(edge.withColumn("shard", F.lit("given")), shards=4).collect()
    lawful(rows, 4)
    expected = sorted((len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in edge.collect())
    assert sorted((r["size"], r.text_crc32) for r in rows) == expected
    assert sharding.sharded(nothing).count() == 0


def spanned(rows):
    groups = defaultdict(set)
    for r in rows:
        groups[r.text_crc32].add(r.shard)
    return groups


def test_equal_texts_meet(spark):
    """Triples among single rows all meet; without single rows to make room, most do."""
    text = F.concat(F.lit("text "), F.floor(F.col("id") / 3).cast("string"))
    docs = spark.range(900).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = sharding.sharded(docs, shards=4).collect()
    lawful(rows, 4)
    assert sum(len(s) > 1 for s in spanned(rows).values()) <= 200  # of 300; about 280 to begin with
    single = spark.range(900, 2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    rows = sharding.sharded(docs.unionByName(single), shards=4).collect()
    lawful(rows, 4)
    assert all(len(s) == 1 for s in spanned(rows).values())


def test_a_group_of_a_third_fills_whole_shards(spark):
    text = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id"))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = sharding.sharded(docs).collect()
    lawful(rows, 16)
    hot = Counter(r.shard for r in rows if r.text_crc32 == zlib.crc32(b"hot"))
    assert sum(n for _, n in hot.most_common(6)) >= 0.95 * 1000  # 1000 rows need 5.3 shards


def test_quotas_keep_every_count():
    rnd = random.Random(4)
    for _ in range(200):
        shards = rnd.randrange(2, 7)
        free = {s: rnd.randrange(0, 40) for s in range(shards)}
        wanted = {(a, b): rnd.randrange(0, 50) for a in range(shards) for b in range(shards) if a != b and rnd.random() < 0.6}
        moves = sharding.quotas(wanted, free)
        net, taken = Counter(), Counter()
        for shard, to, low, high, goal in moves:
            assert low < high
            net[goal] += high - low
            net[shard] -= high - low
            taken[shard, to] += high - low
        assert not any(net.values())
        for (shard, to), n in taken.items():
            assert n <= (free[shard] if to == -1 else wanted[shard, to])


@pytest.mark.parametrize("rows", [1, 15, 17])
def test_fewer_rows_than_shards(spark, rows):
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    lawful(sharding.sharded(docs).collect(), 16)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_sharding(spark, sf_dir).collect()
    lawful(rows, 16)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
