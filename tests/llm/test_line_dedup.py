from pyspark.sql import functions as F

from tallybrook.llm import line_dedup


def brute(rows, length=3):
    """Rows of (id, text) in order of id; every id once."""
    seen, out = set(), {}
    for key, text in rows:
        if text is None:
            out[key] = (None, 0, 0)
            continue
        lines = text.split("\n")
        covered = set()
        for at in range(len(lines) - length + 1):
            window = tuple(lines[at : at + length])
            if any(window):
                if window in seen:
                    covered |= set(range(at, at + length))
                seen.add(window)
        kept = [x for i, x in enumerate(lines) if i not in covered]
        out[key] = ("\n".join(kept), len(lines), len(covered))
    return out


def found(docs):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.without_repeats(docs).collect()}


def test_passages(spark):
    texts = [
        "a\nb\nc", "x\na\nb\nc\ny", "a\nb\nx", "a\nb\nc\nd\na\nb\nc\nd\na\nb\nc", "\n\n\n\n", "\n\n\n", "z\nz\nz\nz\nz",
        None, "", "a\nb\nc", "b\nc\nd\na\nq\nb\nc\nd", "a\nb",
    ]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    assert found(docs) == brute(rows)


def test_edges(edge, nothing):
    unique = edge.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = sorted((r.doc_id, r.text) for r in unique.collect())
    assert found(unique) == brute(rows)
    assert line_dedup.without_repeats(nothing).count() == 0
    whole = line_dedup.without_repeats(edge.withColumn("n_lines", F.lit("given")))
    assert whole.count() == edge.count()
    assert sorted(whole.columns) == sorted([*edge.columns, "n_lines", "n_removed"])
    assert dict(whole.dtypes)["n_lines"] == "bigint"
    assert line_dedup.without_repeats(edge.withColumn("n_lines", F.lit("x")), counts=False).columns == [*edge.columns, "n_lines"]


def test_repeated_rows_stay_whole(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc")] * 3 + [(2, "a\nb\nc\nd")], "doc_id int, text string")
    rows = sorted((r.doc_id, r.text, r.n_removed) for r in line_dedup.without_repeats(docs).collect())
    assert rows == [(1, "a\nb\nc", 0)] * 3 + [(2, "d", 3)]


def test_ties_of_null_and_equal_ids(spark):
    docs = spark.createDataFrame([(None, "a\nb\nc"), (5, "a\nb\nc"), (5, "k\na\nb\nc")], "doc_id int, text string")
    rows = [(r.doc_id, r.n_removed) for r in line_dedup.without_repeats(docs).collect()]
    assert sorted(rows, key=str) == sorted([(None, 0), (5, 3), (5, 3)], key=str)


def test_a_passage_in_very_many_documents(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("p\nq\nr\nown "), "id").alias("text"))
    rows = line_dedup.without_repeats(docs).groupBy("n_removed").count().collect()
    assert {r.n_removed: r["count"] for r in rows} == {0: 1, 3: 2999}
