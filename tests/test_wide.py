import random

import pytest
from pyspark.sql import functions as F

from tallybrook.sources import wide

CHARSETS = ["utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be"]


def text_of(seed):
    """Lines with characters whose bytes look like line feeds, alone or beside others."""
    rnd = random.Random(seed)
    chars = "ab ਊੁ䄀\u000bĀ਀春\U0001f600\U00010a0a"
    return ["".join(rnd.choice(chars) for _ in range(rnd.randrange(12))) for _ in range(300)]


@pytest.mark.parametrize("charset", CHARSETS)
@pytest.mark.parametrize("size", [4, 8, 100, 4096])
def test_ranges_of_any_size_give_every_line_once(tmp_path, charset, size):
    lines = text_of(size)
    for name, end in (("ended", "\n"), ("open", "")):
        data = ("\n".join(lines) + end).encode(charset)
        path = tmp_path / name
        path.write_bytes(data)
        found = [x for at in range(0, len(data), size) for x in wide.range_lines(str(path), at, at + size, charset)]
        # The last line is open: without a character it is none.
        assert found == (lines if end or lines[-1] else lines[:-1])


def test_files_are_cut_between_tasks(spark, tmp_path):
    values = [f"{i} ਊ春" for i in range(2000)]
    (tmp_path / "a b%20.txt").write_bytes(("\r\n".join(values) + "\r\n").encode("utf-16"))
    (tmp_path / "big.txt").write_bytes(b"\xfe\xff" + "one\rtwo\n\n".encode("utf-16-be"))
    (tmp_path / "empty.txt").write_bytes(b"")
    rows = wide.wide_lines(spark, str(tmp_path), "UTF-16", range_bytes=4000)
    tasks = rows.select(F.spark_partition_id().alias("task"), "value").collect()
    assert sorted(r.value for r in tasks) == sorted([*values, "one", "two", ""])
    assert len({r.task for r in tasks}) > 2


def test_a_long_line_over_many_ranges(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(("x" * 100_000 + "\nend").encode("utf-32-le"))
    rows = wide.wide_lines(spark, str(tmp_path), "UTF-32LE", range_bytes=40_000).collect()
    assert sorted(r.value for r in rows) == ["end", "x" * 100_000]


def test_marks_and_invalid_bytes(tmp_path):
    path = tmp_path / "a.txt"
    path.write_bytes("﻿a\n".encode("utf-16-le") + b"\x00\xd8" + "b\n".encode("utf-16-le") + b"c")
    found = list(wide.range_lines(str(path), 0, 1 << 20, "utf-16-le"))
    assert found[0] == "a" and found[1] == "�b" and found[2] == "�"
    path.write_bytes("a\nb".encode("utf-16-be"))
    assert list(wide.range_lines(str(path), 0, 100, "utf-16")) == ["a", "b"]


def test_an_empty_folder_and_other_charsets(spark, tmp_path):
    (tmp_path / "empty.txt").write_bytes(b"")
    assert wide.wide_lines(spark, str(tmp_path), "utf_16_be").count() == 0
    with pytest.raises(ValueError):
        wide.wide_lines(spark, str(tmp_path), "GBK")
