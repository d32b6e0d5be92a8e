import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tallybrook.plans import jobs
from tallybrook.session import remove_runs, run_dir, shared_dir
from tallybrook.sinks import files as sinks
from tallybrook.sources import files as sources


def names(frame, column="value"):
    return sorted(r[column] for r in frame.collect())


def test_named_lines_and_keyword_report(spark, tmp_path):
    (tmp_path / "a.txt").write_text("春月。江水\n月夜。", encoding="utf-8")
    (tmp_path / "b.txt").write_text("水。", encoding="utf-8")
    lines = sources.named_lines(spark, str(tmp_path))
    assert sorted((r.file_name, r.value) for r in lines.collect()) == [
        ("a.txt", "春月。江水"),
        ("a.txt", "月夜。"),
        ("b.txt", "水。"),
    ]
    rows = jobs.keyword_report(spark, str(tmp_path), parts=1).collect()
    assert [(r.file_name, r.n_values, r.joined) for r in rows] == [
        ("a.txt", 2, "春月---|---月夜---|---")
    ]


def test_charset_lines_of_split_files(spark, tmp_path):
    values = [f"春江潮水{i}连海平 abc" for i in range(2000)]
    data = "\n".join(values).encode("gbk") + b"\n\xff!\n"
    (tmp_path / "gbk.txt").write_bytes(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        frame = sources.charset_lines(spark, str(tmp_path), "GBK")
        assert frame.rdd.getNumPartitions() > 1
        found = names(frame)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256m")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == sorted([*values, "\ufffd!"])
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_listing_and_whole_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "sub" / "b.txt").write_text("three")
    listed = sources.listing(spark, str(tmp_path)).collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in listed) == [("a.txt", 7), ("b.txt", 5)]
    assert names(sources.whole_files(spark, str(tmp_path))) == ["one\ntwo", "three"]
    assert sources.text_lines(spark, str(tmp_path), recursive=True).count() == 3
    assert sources.text_lines(spark, str(tmp_path)).count() == 2


def test_json_lines(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"name":"gus","age":12}\n{"name":"hal","age":73}\n')
    for schema in (None, "name string, age bigint"):
        rows = sources.json_lines(spark, str(tmp_path), schema).where("age > 26")
        assert [(r.name, r.age) for r in rows.select("name", "age").collect()] == [("hal", 73)]


def test_delimited_modes(spark, tmp_path):
    (tmp_path / "p.txt").write_text("ivy 12\njim 73\nkay many\n")
    rows = sources.delimited(spark, str(tmp_path), "name string, age int", " ")
    assert sorted((r.name, r.age) for r in rows.where("age > 24 or age is null").collect()) == [
        ("jim", 73),
        ("kay", None),
    ]
    dropped = sources.delimited(spark, str(tmp_path), "name string, age int", " ", "DROPMALFORMED")
    assert names(dropped, "name") == ["ivy", "jim"]
    with pytest.raises(Exception):
        sources.delimited(spark, str(tmp_path), "name string, age int", " ", "FAILFAST").collect()


def test_line_formats_and_modes(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("k", 1), ("月", None)], "k string, n int")
    sinks.write_lines(sinks.tuple_lines(rows, "k", "n"), out)
    assert names(spark.read.text(out)) == ["(k,1)", "(月,null)"]
    sinks.write_lines(sinks.tab_lines(rows, "k", "n"), out, mode="append")
    assert names(spark.read.text(out)) == ["(k,1)", "(月,null)", "k\t1", "月\t"]
    sinks.write_lines(sinks.tab_lines(rows.limit(1)), out, mode="overwrite")
    assert names(spark.read.text(out)) == ["k\t1"]


def test_part_files_in_name_order_are_the_sorted_file(spark, tmp_path):
    out = tmp_path / "sorted"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(1000).repartition(5).select(F.format_string("%04d", "id").alias("value"))
        sinks.write_lines(rows.orderBy("value"), str(out))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(out.glob("part-*"))
    assert len(parts) > 1
    assert "".join(p.read_text() for p in parts).split() == [f"{i:04d}" for i in range(1000)]


def test_quotes_and_backslashes_come_back(spark, tmp_path):
    values = ['"x', 'say "y"', "a\\b", "\\", "it's", ' lead', 'z "', "a,b", '""']
    rows = spark.createDataFrame(list(enumerate(values)), "n int, v string")
    out = str(tmp_path / "out")
    sinks.write_lines(sinks.tab_lines(rows, "v", "n"), out)
    back = sources.delimited(spark, out, "v string, n int", "\t")
    assert sorted((r.n, r.v) for r in back.collect()) == list(enumerate(values))
    quoted = tmp_path / "quoted.csv"
    quoted.write_text('"a,b",1\n')
    assert sources.delimited(spark, str(quoted), "v string, n int", quote='"').first().v == "a,b"


@pytest.mark.parametrize("value", ["a\tb", "a\nb", "a\rb"])
def test_a_value_that_no_reader_could_split_is_refused(spark, tmp_path, value):
    rows = spark.createDataFrame([(value, 1)], "v string, n int")
    with pytest.raises(Exception, match="v holds a tab or a line end"):
        sinks.write_lines(sinks.tab_lines(rows), str(tmp_path / "out"))


def test_parquet_and_json_sinks(spark, tmp_path):
    rows = spark.range(3)
    sinks.write_parquet(rows, str(tmp_path / "p"))
    sinks.write_parquet(rows, str(tmp_path / "p"), "append")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 6
    sinks.write_json_lines(rows, str(tmp_path / "j"))
    assert sources.json_lines(spark, str(tmp_path / "j")).count() == 3


def test_character_and_merchant_jobs(spark, tmp_path):
    (tmp_path / "t.txt").write_text("月夜，月\n\nab", encoding="utf-8")
    out = str(tmp_path / "out")
    jobs.write_character_report(spark, str(tmp_path / "t.txt"), out)
    assert [r.value for r in spark.read.text(out).collect()] == ["a\t1", "b\t1", "夜\t1", "月\t2"]
    by_count = jobs.character_report(spark, str(tmp_path / "t.txt"), by_count=True)
    assert by_count.first().ch == "月"
    (tmp_path / "m.log").write_text("t [1] x\nt [2] x\nt [1] y\n")
    rows = jobs.merchant_report(spark, str(tmp_path / "m.log")).collect()
    assert [(r.merchant, r.n) for r in rows] == [("1", 2), ("2", 1)]
    (tmp_path / "b.log").write_text("u,VIDEO_DY,x\nu,VIDEO_DY,x,y\n")
    assert jobs.profile_report(spark, str(tmp_path / "b.log")).first().profile == "x:2,y:1"


def call(time, uri, key):
    return f'{{"logTime":"2023-11-05T{time}Z","message":"{uri}","contextMap":{{"t":"{key}"}}}}\n'


def test_latency_job(spark, tmp_path):
    (tmp_path / "api.log").write_text(
        call("08:00:00.000", "/a @P", 1)
        + call("08:00:00.125", "/a @R", 1)
        + "".join(call(f"09:00:0{i}.000", "/b @P", 2) for i in range(4))
        + call("10:00:00.000", "/b @P", 3)
        + '{"message":"/c @P\n@R not json\n'
    )
    path, out = str(tmp_path / "api.log"), {n: str(tmp_path / n) for n in ("out", "bad", "left", "fold")}
    jobs.write_latency_report(spark, path, out["out"], malformed_path=out["bad"], left_out_path=out["left"])
    assert names(spark.read.text(out["out"])) == ["(/a,125.0#125)"]
    assert names(spark.read.text(out["bad"])) == ["@R not json", '{"message":"/c @P']
    assert names(spark.read.text(out["left"])) == ["/b\t2\t5"]
    jobs.write_latency_report(spark, path, out["fold"], pairing="fold")
    assert names(spark.read.text(out["fold"])) == ["(/a,125.0#125)", "(/b,2000.0#2000)"]
    costs = jobs.call_costs(spark, path).collect()
    assert [(r.uri, r.context, r.cost_ms) for r in costs] == [("/a", '{"t":"1"}', 125)]


def test_access_log_job(spark, tmp_path):
    (tmp_path / "a.log").write_text("10.9.9.9 - - 2023-11-05T08:15:40.010Z z GET 200 /x\nbroken line\n")
    rows = jobs.access_log_counts(spark, str(tmp_path)).collect()
    assert len(rows) == 10 and {(r.ip, r.n) for r in rows} == {("10.9.9.9", 1)}


def test_charset_readers_at_once_leave_the_session_as_it_was(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes("né".encode("latin-1"))
    with ThreadPoolExecutor(4) as pool:
        frames = list(pool.map(lambda _: sources.charset_lines(spark, str(tmp_path), "ISO-8859-1"), range(8)))
    assert all(names(f) == ["né"] for f in frames)
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_finished_runs_are_removed(spark, tmp_path):
    first, second = run_dir(spark, "x"), run_dir(spark, "y")
    for folder in (first, second):
        spark.range(3).write.parquet(folder)
    remove_runs(spark, first)
    assert not os.path.exists(first) and os.path.exists(second)
    with pytest.raises(ValueError):
        remove_runs(spark, str(tmp_path))


def test_shared_dir_falls_back_to_the_warehouse(spark):
    class Conf(dict):
        def get(self, name, default=None):
            return super().get(name, default)

    session = type("S", (), {"conf": Conf({"spark.sql.warehouse.dir": "/w/"})})
    assert shared_dir(session) == "/w"


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")
