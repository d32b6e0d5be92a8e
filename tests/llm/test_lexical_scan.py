import math
import random
import re
from collections import Counter

import pytest

from tallybrook.llm import lexical_scan

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute_ranked(docs, items, top=10):
    counted = [(i, Counter(brute_terms(t))) for i, t in docs if brute_terms(t)]
    total, texts = sum(sum(c.values()) for _, c in counted), len(counted)
    df = Counter(t for _, c in counted for t in c)
    out = set()
    for item_id, text in set(items):
        scores = []
        for doc_id, c in counted:
            m = 10 + (90 * sum(c.values()) * texts) // total
            score = 0
            for term in set(brute_terms(text)):
                w = math.floor(1000 * math.log((2 * texts + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.add((item_id, rank, None if null else doc_id, -score))
    return out


def found(frame):
    rows = [tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def tables(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


@pytest.mark.parametrize("sizes", [{}, {"most_terms": 12}, {"most_items": 1}])
def test_ranks_equal_brute_force(spark, sizes):
    random.seed(11)
    vocabulary = ["a", "B", "the", "7", "été", "ÀB", "日本", "x\x80y", "ab", "abc", "The"] + [f"w{i}" for i in range(60)]
    joins = [" ", "\n", "-", "\0", ".,", "_"]

    def text(n):
        return "".join(random.choice(vocabulary) + random.choice(joins) for _ in range(n))

    docs = [(i, text(random.randint(0, 80))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .\n"), (3, text(9)), (None, "w1 w2"), (400, "w1 w2"), (399, "w1 w2"), (398, "w1 w2")]
    docs += [(500, text(20_000))]
    items = [(i, text(random.randint(1, 12))) for i in range(20)] + [(30, None), (31, ""), (None, "w1 w2"), (32, "w1 w1 w2"), (33, "nowhere")]
    given = tables(spark, docs, items + items[:3])
    assert found(lexical_scan.ranked(*given, **sizes)) == brute_ranked(docs, items)


def test_ties_beyond_the_top_go_to_small_ids(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000 + i, "other") for i in range(300)]
    got = found(lexical_scan.ranked(*tables(spark, docs, [(1, "same here")])))
    assert {r[2] for r in got} == set(range(1, 11))


def test_small_tables_of_scores_and_cuts(spark, monkeypatch):
    best = lexical_scan._Best(2, 3)
    monkeypatch.setattr(lexical_scan, "KEPT", 4)
    import numpy as np

    for at in range(0, 60, 5):
        ids = np.arange(at, at + 5)
        best.show(np.stack([ids % 7, ids // 7], axis=1), ids, np.zeros(5, bool))
    items, scores, ids, _ = best.cut()
    rows = list(zip(items.tolist(), scores.tolist(), ids.tolist(), strict=True))
    assert rows == [(0, 6, 6), (0, 6, 13), (0, 6, 20), (1, 8, 56), (1, 8, 57), (1, 8, 58)]


def test_edges_and_clashing_columns(spark, edge):
    docs = edge.withColumnsRenamed({"lang": "score", "source": "item_id"})
    items = spark.createDataFrame([(1, "ALPHA l2 日本語のテキスト", "x"), (2, "word5 tail", None)], "item_id bigint, text string, doc_id string")
    expected = brute_ranked([(r["doc_id"], r["text"]) for r in edge.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    rows = [tuple(r) for r in lexical_scan.ranked(docs, items).collect()]
    # Equal rows are documents of their own, with equal scores.
    assert {(i, r, s) for i, r, _, s in rows} == {(i, r, s) for i, r, _, s in expected}
    assert {(i, d) for i, _, d, _ in rows} == {(i, d) for i, _, d, _ in expected}


def test_nothing(spark, nothing):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert found(lexical_scan.ranked(nothing, items)) == set()
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert found(lexical_scan.ranked(docs, items.where("false"))) == set()
    assert found(lexical_scan.ranked(docs, items)) == brute_ranked([(1, "a b")], [(1, "a b")])
