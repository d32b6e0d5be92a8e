import json

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import relational as r
from tallybrook.plans import jobs, table_queries


@pytest.fixture(scope="module")
def people(spark):
    rows = [("ann", 31), ("bo", 58), ("cy", 47), ("dee", 19), ("eli", 62), ("flo", 40)]
    return spark.createDataFrame(rows, "name string, age long")


def test_lookup_sum(spark):
    facts = spark.createDataFrame(
        [("10", 5), ("10 ", 7), ("20", 1), ("20", None), ("30", 3), ("99", 8)],
        "dept string, sal long",
    )
    lookup = spark.createDataFrame(
        [("10", "A"), (" 20", "B"), ("30", "A"), ("40", "D")], "no string, name string"
    )
    rows = r.lookup_sum(facts, "dept", F.col("sal"), lookup, "no", "name").collect()
    assert {x.name: x.total for x in rows} == {"A": 15, "B": 1}


def test_lookup_must_be_unique(spark):
    facts = spark.createDataFrame([(1, 5)], "dept int, sal long")
    lookup = spark.createDataFrame([(1, "A"), (1, "B")], "no int, name string")
    with pytest.raises(Exception, match="not unique"):
        r.lookup_sum(facts, "dept", F.col("sal"), lookup, "no", "name").collect()


def test_department_job(spark, tmp_path):
    (tmp_path / "emp.csv").write_text(
        "101,Ida,welder,9,2011-02-03,410,,7\n102,Jo,cook,,2012-05-06,900,15,8\n103,Kim,cook,,2013-07-08,,,8\n"
        "104,Lou,welder,,2014-09-10,35,,7\n105,Mo,driver,,2015-11-12,60,,9"
    )
    (tmp_path / "dept.csv").write_text("7,YARD,PORTO\n8,KITCHEN,LYON\n6,ATTIC,OSLO")
    rows = jobs.department_totals(spark, str(tmp_path / "emp.csv"), str(tmp_path / "dept.csv"))
    assert {x.dname: x.total for x in rows.collect()} == {"YARD": 445, "KITCHEN": 900}


def test_salted_join_equals_join(spark):
    left = spark.range(500).selectExpr("if(id % 3 = 0, 0, id % 50) as k", "id as l")
    right = spark.range(60).selectExpr("id as k", "id * 2 as w")
    salted = r.salted_join(left, right, ["k"], F.col("l"), salts=5)
    assert salted.exceptAll(left.join(right, "k")).count() == 0
    assert salted.count() == left.join(right, "k").count()


def test_cogroup_counts(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (3,)], "k int")
    rows = r.cogroup_counts(left, right, ["k"]).collect()
    assert sorted((x.k, x.n_left, x.n_right) for x in rows) == [(1, 2, 1), (2, 1, 0), (3, 0, 1)]


def test_union_keeps_duplicates_and_counts_them(people):
    both = r.union_all(people, people.select("age", "name"))
    assert {x.n for x in r.count_by_value(both).collect()} == {2}


def test_sort_and_top(people, capsys):
    assert [x.age for x in r.sort_desc(people, "age").collect()] == [62, 58, 47, 40, 31, 19]
    top = r.top_n(people, 2, "age", "name")
    assert [x.name for x in top.collect()] == ["eli", "bo"]
    top.explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_numbers_given_as_text_sort_as_numbers(spark):
    rows = spark.createDataFrame([(v,) for v in ("111", "1222", "9", "222", "222")], "v string")
    numbers = rows.select(F.col("v").cast("bigint").alias("v"))
    assert [x.v for x in r.sort_desc(numbers, "v").collect()] == [1222, 222, 222, 111, 9]


def test_predicates(people):
    assert people.where("age > 45").count() == 3
    assert r.first_match(people, "age > 100").count() == 0
    assert r.first_match(people, F.col("age") > 30).count() == 1


def test_lists(people):
    assert r.keep_listed(people, "name", ["ann", "bo"]).count() == 2
    assert r.drop_listed(people, "name", ["ANN", "bo"]).count() == 5
    assert r.drop_listed(people, "name", ["ANN", "bo"], ignore_case=True).count() == 4


def test_sql_and_json(spark, people):
    people.limit(1).createOrReplaceTempView("people")
    statement = "SELECT * FROM {people} ORDER BY age DESC LIMIT 1"
    rows = r.sql_over(spark, statement, people=people)
    assert [json.loads(x.value) for x in r.rows_as_json(rows).collect()] == [{"name": "eli", "age": 62}]
    # A view of the same name in the session is left as it was.
    assert spark.table("people").count() == 1
    spark.catalog.dropTempView("people")


def test_sql_joins_several_frames(spark, people):
    towns = spark.createDataFrame([("ann", "Lyon"), ("cy", "Oslo")], "name string, town string")
    statement = "SELECT p.age, t.town FROM {p} p JOIN {t} t ON p.name = t.name"
    assert sorted(tuple(x) for x in r.sql_over(spark, statement, p=people, t=towns).collect()) == [(31, "Lyon"), (47, "Oslo")]


def test_sample_by_key_does_not_depend_on_layout(spark, tmp_path):
    whole = spark.range(20_000).selectExpr("id % 500 as k", "id")
    whole.coalesce(1).write.parquet(str(tmp_path / "one"))
    whole.repartition(7, "id").write.parquet(str(tmp_path / "seven"))
    first, second = (r.sample_by_key(spark.read.parquet(str(tmp_path / n)), ["k", "id"], 0.1) for n in ("one", "seven"))
    assert first.exceptAll(second).count() == 0 == second.exceptAll(first).count()
    assert 0.08 < first.count() / 20_000 < 0.12
    # All rows of a key are drawn, or none.
    assert r.sample_by_key(whole, ["k"], 0.2).groupBy("k").count().where("count <> 40").count() == 0
    assert r.sample_by_key(whole, ["k"], 1.0).count() == 20_000 and r.sample_by_key(whole, ["k"], 0.0).count() == 0


def test_dictionary_rows(spark):
    values = ["zone 7 north 2 3 OPEN", "zone 8 south 2 x OPEN", "zone 9 east 2 4", "zone 9  2 4 OPEN", "", None]
    rows = r.dictionary_rows(spark.createDataFrame([(v,) for v in values], "value string"))
    assert rows.dtypes[4] == ("sort", "int")
    assert sorted(tuple(x) for x in rows.collect()) == [("zone", "7", "north", "2", 3, "OPEN"), ("zone", "9", "", "2", 4, "OPEN")]


def test_sample_with_replacement(people):
    assert r.sample_rows(people, 5.0, 1, with_replacement=True).count() > 6


def test_lists_of_a_user_are_whole(spark, sf_dir):
    counts = {r.user_id: (r.n_left, r.n_right) for r in table_queries.cogroup_counts(spark, sf_dir).collect()}
    rows = table_queries.cogroup_lists(spark, sf_dir).collect()
    found = {r.user_id: tuple([int(v) for v in side.split(",") if v] for side in (r.left_values, r.right_values)) for r in rows}
    assert len(rows) == len(counts)
    assert {user: tuple(map(len, sides)) for user, sides in found.items()} == counts
    assert all(side == sorted(side) for sides in found.values() for side in sides)
