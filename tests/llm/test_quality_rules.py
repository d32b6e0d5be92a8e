import random

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import quality_rules, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    n_symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", "a b c d e a b c d e", "a a a a a a a a", "x\nx\n\n \nx y", "# *$ <b>|&%", "a b c d e f " * 40,
    "p q r s t p q r s t u v w p q r s t", "é ü x 日本", "\x0b a\x0cb\rc", "a b c d", "a b c d e",
]


def test_statistics_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(TEXTS)], "doc_id int, text string, stats double")
    rows = quality_rules.with_statistics(docs, stats="counted").collect()
    for row in rows:
        found = tuple(row.counted[c] for c in quality_rules.COUNTS)
        assert found == brute(row.row.text), row.row.text


def test_edges_and_no_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (3, None), (1, 0)], "doc_id bigint, quality int")
    rules = quality_rules.learn(edge, labels)
    rows = quality_rules.judged(edge, rules).collect()
    assert len(rows) == edge.count()
    for row in rows:
        counts = brute(row.row.text)
        assert tuple(row.stats[c] for c in quality_rules.COUNTS) == counts
        assert row.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert row.kept == (not row.base_failed and row.rule is None)
    assert quality_rules.kept(edge, rules).columns == edge.columns
    assert quality_rules.learn(nothing, labels) == []
    assert quality_rules.learn(edge, labels.limit(0)) == []
    assert quality_rules.judged(nothing, []).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(i, " ".join(f"plain{(i * k) % 89}" for k in range(1, 30)), 1) for i in range(1, 121) if i % 89]
    symbols = [(i, " ".join(f"w{(i * k) % 83}##" for k in range(1, 30)), 0) for i in range(200, 260)]
    shouted = [(i, " ".join(f"LOUD{(i * k) % 79}X" for k in range(1, 30)), 0) for i in range(300, 360)]
    return spark.createDataFrame(good + symbols + shouted, "doc_id bigint, text string, quality int")


def test_rules_cover_each_kind_and_spare_the_good(labelled):
    rules = quality_rules.learn(labelled.drop("quality"), labelled.select("doc_id", "quality"))
    assert len(rules) >= 2
    rows = quality_rules.judged(labelled, rules).select("row.quality", "kept", "rule").collect()
    assert all(r.kept == (r.quality == 1) for r in rows)
    assert {r.rule for r in rows if r.rule} <= {str(r) for r in rules}


def test_the_first_rule_met_is_named(spark):
    low = quality_rules.Rule((quality_rules.Condition("n_words", False, 3.0),), 1, 0)
    lower = quality_rules.Rule((quality_rules.Condition("n_words", False, 2.0),), 1, 0)
    stats = spark.range(1, 5).select(F.struct(F.col("id").alias("n_words")).alias("stats"))
    rows = stats.select(quality_rules.verdict([low, lower]).alias("v")).collect()
    assert [r.v for r in rows] == [str(low)] * 3 + [None]


def test_query_keeps_the_good(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row[c] for c in quality_rules.COUNTS) == brute(texts[row.doc_id])
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    judged = [r for r in rows if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in judged) >= 0.98 * len(judged)


def test_rules_reject_labelled_bad_texts_that_pass_the_base_rules(spark):
    """Bad texts here break no base rule: only what is learned can tell them from good ones."""
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(1200):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(30, 60))]
        bad = i % 3 == 0
        if bad:
            words = [w + "#$%" if rnd.random() < 0.5 else w for w in words]
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    rules = quality_rules.learn(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    found = quality_rules.judged(docs, rules).select("row.doc_id", "base_failed", "kept").collect()
    assert not any(r.base_failed for r in found)
    for seen in (0, 1):
        bad = [r.kept for r in found if r.doc_id % 3 == 0 and r.doc_id % 2 == seen]
        good = [r.kept for r in found if r.doc_id % 3 and r.doc_id % 2 == seen]
        assert sum(bad) < 0.05 * len(bad) and sum(good) > 0.95 * len(good)
