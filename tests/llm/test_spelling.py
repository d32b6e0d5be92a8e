import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallybrook.llm import spelling


def brute_words(docs, min_length=7, min_count=2):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").encode().lower().decode()):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def brute_variants(counts):
    near, wild = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            wild[i, rest].add(w)
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    for group in wild.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda x: (-counts[x], x)) for w in counts if near[w]}
    form = {w: b for w, b in best.items() if counts[b] >= 10 * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def found(frame):
    rows = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vocabulary(spark, counts):
    rows = [(w, n) for w, n in counts.items()]
    return spark.createDataFrame(rows, "word string, n bigint").repartition(3)


def test_words_of_texts(spark):
    random.seed(7)
    letters = "abcÀÉéÿ×ABZ"
    rows = [
        (i, " ".join("".join(random.choice(letters) for _ in range(random.randint(5, 9))) for _ in range(300)) * 2)
        for i in range(12)
    ]
    rows += [(None, "Nullified nullified"), (5, None), (6, ""), (1, "İSTANBUL ǅabcdefgh ſhort"), (None, "Nullified")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    words = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    assert words == brute_words(rows)
    assert any(len(w) == 7 for w in words)


def test_query_of_edges_equals_brute_force(spark, edge):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    clashing = edge.withColumnsRenamed({"lang": "word", "source": "n"})
    assert found(spelling.variants(spelling.vocabulary(clashing))) == brute_variants(brute_words(rows))


@pytest.mark.parametrize("sizes", [{}, {"shard_words": 40, "pass_words": 40}, {"shard_words": 90, "pass_words": 1000}])
def test_variants_equal_brute_force(spark, sizes):
    random.seed(3)
    counts = {}
    for _ in range(500):
        word = "".join(random.choice("abñ") for _ in range(random.randint(1, 7)))
        counts[word] = random.choice([2, 2, 3, 25, 300, 4000])
    counts |= {"x" * 70: 50, "x" * 71: 2, "x" * 70 + "y": 500, "y" * 63: 3, "y" * 64: 40, "y" * 65: 3}
    long = "".join(random.choice("pqr") for _ in range(1_500))
    counts |= {long: 3, long[:400] + "s" + long[401:]: 40, long[1:]: 4_000, "𝔞bc": 2, "𝔟bc": 20}
    got = found(spelling.variants(vocabulary(spark, counts), **sizes))
    assert got == brute_variants(counts)


def test_chains_lead_to_their_last_form(spark):
    words = ["aaaaaaaaa"[:i] + "b" * (9 - i) for i in range(10)]
    counts = {w: 2 * 10**i for i, w in enumerate(words)}
    got = found(spelling.variants(vocabulary(spark, counts)))
    assert got == brute_variants(counts)
    assert {r[2] for r in got} == {"aaaaaaaaa"}


def test_ties_go_to_the_smallest_word(spark):
    counts = {"abcdefg": 2, "abcdefz": 40, "abcdefÿ": 40, "abcdef": 40}
    got = {r[0]: r[1] for r in found(spelling.variants(vocabulary(spark, counts)))}
    assert got["abcdefg"] == "abcdef"


def test_nothing(spark, nothing):
    assert found(spelling.variants(spelling.vocabulary(nothing))) == set()
    words = spark.createDataFrame([(None, 3), ("", 4)], "word string, n bigint")
    assert found(spelling.variants(words)) == {("", None, "", 4, 0, None)}


def test_filter_holds_its_words_and_few_others():
    words = [f"w{i}" for i in range(20_000)]
    bits = spelling.bloom(spelling.word_hashes(words))
    assert len(spelling.may_hold(bits, spelling.word_hashes(words))) == len(words)
    others = spelling.word_hashes([f"v{i}" for i in range(100_000)])
    assert len(spelling.may_hold(bits, others)) < 1_000
    assert len(np.unique(others)) == 100_000
