import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import lattice_lm, queries

PIECES = lattice_lm.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def all_ways(word):
    """Probability by listing every segmentation."""
    p = np.exp(PIECES.log_probs)

    def rest(at):
        if at == len(word):
            return 1.0
        total = sum(p[PIECES.inner[word[at:e]]] * rest(e) for e in range(at + 1, len(word) + 1) if word[at:e] in PIECES.inner)
        if word[at] not in PIECES.inner:
            total += math.prod(p[PIECES.bytes_[b]] for b in word[at].encode()) * rest(at + 1)
        return total

    return sum(p[PIECES.first[word[:e]]] * rest(e) for e in range(len(word) + 1) if word[:e] in PIECES.first)


@pytest.mark.parametrize("word", ["the", "a", "thinking", "été", "x\u2581y", "日本", "\U0001f9ff", "zq9!", "\x00"])
def test_forward_sums_all_segmentations(word):
    words = ["other", word, "x", word]
    found = lattice_lm.log_probabilities(PIECES, words)
    assert found == pytest.approx([math.log(all_ways(w)) for w in words])


def test_expected_pieces_of_a_word():
    expected = lattice_lm.expected_pieces(PIECES, ["an", "an", "an"])
    p = np.exp(PIECES.log_probs)
    f, i = PIECES.first, PIECES.inner
    ways = {(f["an"],): p[f["an"]], (f["a"], i["n"]): p[f["a"]] * p[i["n"]], (f[""], i["an"]): p[f[""]] * p[i["an"]]}
    ways[f[""], i["a"], i["n"]] = p[f[""]] * p[i["a"]] * p[i["n"]]
    total = sum(ways.values())
    for piece in {k for way in ways for k in way}:
        assert expected[piece] == pytest.approx(3 * sum(v for way, v in ways.items() if piece in way) / total)


def test_tokens_are_words_or_the_end():
    # A word's first pieces and the end are what a token may begin with.
    p = np.exp(PIECES.log_probs)
    assert p.sum() == pytest.approx(1.0)
    first, inner = p[list(PIECES.first.values())].sum(), p[[*PIECES.inner.values(), *PIECES.bytes_]].sum()
    assert first / (1 - inner) + math.exp(lattice_lm.log_end(PIECES)) == pytest.approx(1.0)


def test_a_very_long_word():
    (score,) = lattice_lm.log_probabilities(PIECES, ["ab" * 10_000])
    assert -1e7 < score < 0
    assert lattice_lm.log_probabilities(PIECES, []).tolist() == []


def test_bytes_are_expected_where_they_spell():
    expected = lattice_lm.expected_pieces(PIECES, ["a\U0001f9ff", "b"])
    for byte in "\U0001f9ff".encode():
        assert expected[PIECES.bytes_[byte]] == pytest.approx(1.0)
    assert expected[[PIECES.first[""], PIECES.first["a"]]].sum() == pytest.approx(1 + (expected[PIECES.first[""]] - expected[PIECES.inner["a"]]))


def base(texts, trains, text):
    counts = Counter()
    for key, t in texts:
        if trains(key):
            counts.update([*(t or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    tokens = [*(text or "").encode().lower().split(), b""]
    score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
    return len(tokens), sum(counts[t] > 0 for t in tokens), n, score


def check(texts, rows, trains):
    assert len(rows) == len(texts)
    left = sorted(texts, key=lambda x: (str(x[0]), str(x[1])))
    expected = sorted((str(k), *base(texts, trains, t)) for k, t in left)
    found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    for a, b in zip(found, expected, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert all(r.score < 0 and r.lattice_score < 0 for r in rows)


def test_edges(edge, nothing):
    texts = [(r.doc_id, r.text) for r in edge.collect()]
    clash = edge.withColumn("score", F.lit("x")).withColumn("word", F.lit(1))
    check(texts, lattice_lm.scored(clash, PIECES, F.col("doc_id") < 9).collect(), lambda k: k is not None and k < 9)
    check(texts, lattice_lm.scored(edge, PIECES, F.lit(False)).collect(), lambda k: False)
    assert lattice_lm.scored(nothing, PIECES, F.lit(True)).count() == 0


def test_texts_of_one_id_whose_short_hashes_meet(spark):
    """Texts of unlike length under a null or a repeated id that a hash of 32 bits takes for one."""
    more = F.when(F.col("id") % 2 == 1, " more words").otherwise("")
    made = spark.range(400_000).select(F.concat(F.lit("w"), "id", more).alias("text"), (F.col("id") % 2).alias("odd"))
    met = made.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts"), F.countDistinct("odd").alias("kinds"))
    pair = met.where("kinds = 2").first().texts
    texts = [(k, t) for k in (None, 5) for t in pair] + [(6, pair[0]), (None, pair[0]), (7, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    check(texts, lattice_lm.scored(docs, PIECES, F.col("doc_id") == 6).collect(), lambda k: k == 6)


def test_seen_words_score_higher(spark):
    docs = spark.createDataFrame([(i, "blorf quux blorf") for i in range(20)] + [(50, "blorf"), (51, "brolf")], "doc_id int, text string")
    rows = {r.doc_id: r for r in lattice_lm.scored(docs, PIECES, F.col("doc_id") < 50).collect()}
    assert rows[50].score > rows[51].score + 2
    assert len({round(rows[i].score, 9) for i in range(20)}) == 1


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    trains = lambda k: zlib.crc32(str(k).encode()) % 7 != 2
    rows = queries.op7_lattice_lm(spark, sf_dir).collect()
    check([(r.doc_id, r.text) for r in docs], rows, trains)
    assert all(r.held_out == (not trains(r.doc_id)) for r in rows)


def segmentations(pieces, p, word):
    """Every segmentation of a word as (probability, pieces)."""

    def rest(at):
        if at == len(word):
            yield 1.0, ()
            return
        for e in range(at + 1, len(word) + 1):
            if word[at:e] in pieces.inner:
                place = pieces.inner[word[at:e]]
                for q, way in rest(e):
                    yield p[place] * q, (place, *way)
        if word[at] not in pieces.inner:
            places = tuple(int(pieces.bytes_[b]) for b in word[at].encode())
            for q, way in rest(at + 1):
                yield math.prod(p[x] for x in places) * q, (*places, *way)

    for e in range(len(word) + 1):
        if word[:e] in pieces.first:
            place = pieces.first[word[:e]]
            for q, way in rest(e):
                yield p[place] * q, (place, *way)


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_score_of_texts_equals_listing_all_segmentations(spark, rounds):
    texts = [
        (0, "the cat the dog"), (1, "a cat sat dog"), (2, "The été sat sat"), (3, "日本 cat"), (4, None),
        (5, "the unseen bird"), (6, "a a a zq9!"), (7, ""), (8, "été cats"),
    ]
    trains = lambda k: k < 5
    counts = Counter()
    for k, t in texts:
        if trains(k):
            counts.update([*(t or "").encode().lower().decode().split(), ""])
    n, v = sum(counts.values()), len(counts)
    once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
    assert once and twice
    discount = once / (once + 2 * twice)
    probs = np.exp(PIECES.log_probs)
    for _ in range(rounds):
        expected = np.zeros(len(probs))
        expected[PIECES.end] += 1
        for word in counts:
            ways = list(segmentations(PIECES, probs, word)) if word else []
            total = sum(q for q, _ in ways)
            for q, way in ways:
                for place in way:
                    expected[place] += q / total
        prior = lattice_lm.PRIOR_PIECES
        probs = (expected + prior * PIECES.prior) / (expected.sum() + prior)
    end = probs[PIECES.end] / (probs[PIECES.end] + probs[list(PIECES.first.values())].sum())

    def token(word):
        lattice = sum(q for q, _ in segmentations(PIECES, probs, word)) if word else end
        return math.log10(max(counts[word] - discount, 0) / n + discount * v / n * lattice), math.log10(lattice)

    docs = spark.createDataFrame(texts, "doc_id int, text string").repartition(3)
    found = {r.doc_id: r for r in lattice_lm.scored(docs, PIECES, F.col("doc_id") < 5, rounds=rounds).collect()}
    for k, t in texts:
        parts = [token(w) for w in [*(t or "").encode().lower().decode().split(), ""]]
        assert found[k].score == pytest.approx(sum(a for a, _ in parts))
        assert found[k].lattice_score == pytest.approx(sum(b for _, b in parts))
