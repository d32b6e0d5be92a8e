"""Lines of files in charsets whose characters take two or four bytes at least."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.session import let_workers_import
from tallybrook.sources.files import listing

# Bytes of a code unit; the names with an end fixed, by the first bytes of a file.
UNITS = {"utf-16": 2, "utf-16-le": 2, "utf-16-be": 2, "utf-32": 4, "utf-32-le": 4, "utf-32-be": 4}
MARKS = {
    2: {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"},
    4: {b"\xff\xfe\x00\x00": "utf-32-le", b"\x00\x00\xfe\xff": "utf-32-be"},
}

# Bytes of a file that one task reads, and of one read.
RANGE_BYTES = 64 << 20
READ_BYTES = 1 << 20
# Lines of about so many bytes are handed over together.
BATCH_BYTES = 8 << 20


def charset_name(charset: str) -> str:
    """The charset's name in `UNITS`, from any usual spelling such as UTF-16LE."""
    name = charset.lower().replace("_", "-")
    if name.endswith(("le", "be")) and not name.endswith(("-le", "-be")):
        name = f"{name[:-2]}-{name[-2:]}"
    if name not in UNITS:
        raise ValueError(f"not a charset of wide code units: {charset}")
    return name


def wide_lines(
    spark: SparkSession, path: str | list[str], charset: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """`value` per line of files in UTF-16 or UTF-32, of either byte order.

    A file is cut into ranges of `range_bytes`, a whole number of code units, and
    each range is read by a task of its own; a line belongs to the range in which
    it begins, so none is cut or read twice. A line feed is looked for in whole
    code units: the bytes of one may lie in and across other characters. As in
    other text files, lines end at a line feed, a carriage return, or both.

    A byte order mark is left out; without one, plain UTF-16 and UTF-32 count as
    big-endian. Bytes that are no character come out as the replacement character.
    A line is one value and must fit in memory; files and their number are not
    bounded. Tasks open files by Arrow, so their store must be one it reaches.
    """
    name = charset_name(charset)
    if range_bytes <= 0 or range_bytes % 4:
        raise ValueError("range_bytes must be a multiple of 4")
    let_workers_import(spark)
    files = listing(spark, path).where("length > 0").select("path", "length")
    n_ranges = files.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 1
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.select("path", F.explode(starts).alias("start")).repartition(int(n_ranges), "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values: list[str] = []
                held = 0
                for line in range_lines(where, start, start + range_bytes, name):
                    values.append(line)
                    held += len(line)
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])
                        values, held = [], 0
                if values:
                    yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])

    return ranges.mapInArrow(read, "value string")


def opened(path: str) -> pa.NativeFile:
    """A file by the path that Spark gives it: a URI whose characters are not escaped."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + (rest or path).lstrip("/"))
    host, _, inner = rest.lstrip("/").partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system.open_input_file(f"{root.rstrip('/')}/{inner}")


def range_lines(path: str, start: int, end: int, name: str) -> Iterator[str]:
    """The lines that begin in bytes `start` to `end` of a file."""
    unit = UNITS[name]
    with opened(path) as file:
        mark = file.read(unit)
        codec = MARKS[unit].get(mark) if name in ("utf-16", "utf-32") else name
        marked = MARKS[unit].get(mark) is not None and codec in (None, MARKS[unit][mark])
        codec = codec or f"{name}-be"
        feed = "\n".encode(codec)
        # Before a later range, the end of the line before it is looked for.
        at = start - unit if start else unit * marked
        begun = start == 0
        file.seek(at)
        line: list[bytes] = []
        while block := _block(file, unit):
            since = 0
            while True:
                stop = _find(block, feed, since)
                if begun:
                    line.append(block[since : len(block) if stop < 0 else stop])
                if stop < 0:
                    break
                if begun:
                    yield from _split(b"".join(line).decode(codec, "replace"))
                line, begun, since = [], True, stop + unit
                if at + since >= end:
                    return
            at += len(block)
            if not begun and at >= end:
                return
        rest = b"".join(line)
        if rest:
            yield from _split(rest.decode(codec, "replace"))


def _block(file: pa.NativeFile, unit: int) -> bytes:
    """The next bytes in whole code units; fewer only at the end of the file."""
    block = file.read(READ_BYTES)
    while len(block) % unit and (more := file.read(unit - len(block) % unit)):
        block += more
    return block


def _find(block: bytes, feed: bytes, since: int) -> int:
    """The place of a line feed at a whole code unit, -1 if there is none."""
    at = block.find(feed, since)
    while at >= 0 and at % len(feed):
        at = block.find(feed, at + 1)
    return at


def _split(text: str) -> list[str]:
    """A line, or several where carriage returns alone end them."""
    return text.removesuffix("\r").split("\r")
