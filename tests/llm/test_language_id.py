import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import language_id, queries, shared

WORDS = {"aa": ["lorem", "ipsum", "dolor", "amet"], "bb": ["krk", "zyx", "wqv", "xkz"], "cc": ["été", "où", "ça", "naïf"]}


def rows_of(n):
    rows = []
    for lang, words in WORDS.items():
        for i in range(n):
            rows.append((len(rows), " ".join(words[(i * k) % 4] for k in range(1, 12)), lang))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(rows_of(40), "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def model(labelled):
    return language_id.fit(labelled)


def test_probabilities_sum_to_one(model):
    # After any context, known or not, the probabilities of all characters and the unknown are one.
    chars = np.unique(np.concatenate(model.grams) & 0xFFF)
    contexts = [model.contexts[-1][0], model.contexts[-1][5], (1 << 36) - 3]
    for context in contexts:
        grams = np.append((context << 12) | chars, (context << 12) | 4095)
        total = np.exp(model.log_probability(grams)).sum(axis=0)
        assert np.allclose(total, 1.0)


def test_kneser_ney_by_hand():
    # One order up from the bottom, on "abab": continuation counts and discounts by the formulas.
    grams, counts = language_id._grams(*language_id._characters(["abab"]))
    assert len(grams) == 4
    top, n = np.unique(grams, return_counts=True)
    levels = language_id._one_language(top, n, 3)
    unigrams = dict(zip(levels[0]["grams"].tolist(), np.exp(levels[0]["log_probs"]), strict=True))
    # Characters are seen after: a after the space and b; b after a.
    discount = 1 / (1 + 2 * 1)
    share = discount * 2 / 3
    assert unigrams[ord("a")] == pytest.approx((2 - discount) / 3 + share / 3)
    assert unigrams[ord("b")] == pytest.approx((1 - discount) / 3 + share / 3)


def test_arrays_are_sorted(model):
    for array in itertools.chain(model.grams, model.contexts):
        assert np.all(np.diff(array) > 0)


def test_languages_are_told_apart(spark, model):
    docs = spark.createDataFrame(rows_of(9), "doc_id bigint, text string, lang string")
    rows = language_id.predicted(docs, model).collect()
    assert all(r.lang_pred == r.row.lang and 0 <= r.score <= 1 for r in rows)


def test_edges(edge, nothing, model):
    rows = language_id.predicted(edge.withColumn("score", F.lit("given")), model).collect()
    assert len(rows) == edge.count()
    for row in rows:
        has_letter = any(c.isalpha() for c in row.row.text or "")
        assert (row.lang_pred == "und") == (not has_letter)
        assert has_letter or (row.score == 0 and row.cross_entropy is None and row.rejected is None)
        assert row.row.score == "given"
    assert language_id.predicted(nothing, model).count() == 0
    assert language_id.fit(nothing) is None
    assert {r.lang_pred for r in language_id.predicted(edge, None).collect()} == {"und"}
    assert language_id.fit(edge).languages == ["en"]


def test_text_of_no_language_is_rejected(spark, model):
    docs = spark.createDataFrame([("qqqq jjjj gggg qjqj gqgq",), ("lorem ipsum dolor amet lorem",)], "text string")
    assert [r.rejected for r in language_id.predicted(docs, model).collect()] == [True, False]


def test_a_text_scores_alike_alone_and_among_others(model):
    texts = ["lorem ipsum", "", "krk", "12", "été où"]
    together, letters = model.cross_entropies(texts)
    assert letters.tolist() == [True, False, True, False, True]
    for i, text in enumerate(texts):
        assert np.allclose(model.cross_entropies([text])[0][0], together[i])


def test_held_out_accuracy(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op2_language_id(spark, sf_dir).collect()
    assert len(rows) == len(langs)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held_out) >= 0.97 * len(held_out) > 0


def plain_chars(text):
    """Three spaces, then lower-case letters; runs of anything else are one space."""
    out = [" "] * 3
    for c in text:
        c = c.lower() if c.isalpha() else " "
        if c != " " or out[-1] != " ":
            out.append(c)
    return out


class PlainKneserNey:
    """Interpolated Kneser-Ney of order 4 with dictionaries."""

    def __init__(self, texts, characters):
        counts = {}
        for text in texts:
            chars = plain_chars(text)
            for i in range(3, len(chars)):
                gram = tuple(chars[i - 3 : i + 1])
                counts[gram] = counts.get(gram, 0) + 1
        self.levels, self.characters = {4: counts}, characters
        for order in (3, 2, 1):
            below = {}
            for gram in self.levels[order + 1]:
                below[gram[1:]] = below.get(gram[1:], 0) + 1
            self.levels[order] = below
        self.discounts, self.totals, self.kinds = {}, {}, {}
        for order, level in self.levels.items():
            ones, twos = (sum(c == k for c in level.values()) for k in (1, 2))
            self.discounts[order] = min(0.95, ones / (ones + 2 * twos)) if ones else 0.5
            for gram, c in level.items():
                context = (order, gram[:-1])
                self.totals[context] = self.totals.get(context, 0) + c
                self.kinds[context] = self.kinds.get(context, 0) + 1

    def probability(self, gram):
        if not gram:
            return 1 / self.characters
        order, lower = len(gram), self.probability(gram[1:])
        context = (order, gram[:-1])
        if context not in self.totals:
            return lower
        d = self.discounts[order]
        own = max(self.levels[order].get(gram, 0) - d, 0)
        return (own + d * self.kinds[context] * lower) / self.totals[context]

    def cross_entropy(self, text):
        chars = plain_chars(text)
        grams = [tuple(chars[i - 3 : i + 1]) for i in range(3, len(chars))]
        return -sum(np.log(self.probability(g)) for g in grams) / len(grams)


def test_cross_entropies_of_whole_texts_equal_plain_kneser_ney(spark, labelled, model):
    counted = F.pmod(F.xxhash64(shared.spread(F.col("doc_id"))), F.lit(language_id.CALIBRATION)) != 0
    texts = {lang: [] for lang in WORDS}
    for row in labelled.where(counted).collect():
        texts[row["lang"]].append(row["text"])
    # The characters that end an n-gram, and one for all others.
    characters = len({c for ts in texts.values() for t in ts for c in plain_chars(t)[3:]}) + 1
    plain = {lang: PlainKneserNey(ts, characters) for lang, ts in texts.items()}
    asked = ["lorem ipsum zyx", "  été! où ça -- naïf, LOREM", "krk krk wqv", "unheard of words", "où", "amet " * 500, "é x"]
    found, letters = model.cross_entropies(asked)
    assert letters.all() and model.languages == sorted(WORDS)
    expected = [[plain[lang].cross_entropy(t) for lang in sorted(WORDS)] for t in asked]
    assert np.allclose(found, expected)
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string")
    for row in language_id.predicted(docs, model).collect():
        own = expected[row["row"]["doc_id"]]
        assert row["lang_pred"] == sorted(WORDS)[int(np.argmin(own))]
        assert row["cross_entropy"] == pytest.approx(min(own))
