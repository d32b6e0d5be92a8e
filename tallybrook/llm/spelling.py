"""Spelling variants: each word's neighbours at one edit, and the common form it may stand for.

Words generate their edits, and Bloom filters of the vocabulary say which of them may be
words. The filters are sharded by the length of the words, blocked (all bits of a word lie
in 64 bytes) and broadcast in passes of bounded size. Only the edits they let through are
shuffled, to an exact join with the vocabulary that removes the false positives.

Being near is symmetric. So a word generates what it becomes by one code point deleted, or
replaced by a greater one, and every pair that is found counts for both its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.shared import let_workers_import, settled

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 31  # One run of so many loses a code point.
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10

# Words from this length on share their filters.
LONGEST = 64
SHARD_WORDS = 1 << 21
BITS_PER_WORD = 16
BLOCK_BITS = 512
PROBES = 6
# Filters broadcast at once hold so many words at most: 64 MB.
PASS_WORDS = 1 << 25
# Hashes worked out at once in a task.
HASHES = 1 << 19

BASE = 0x9E3779B97F4A7C15
MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _lower(run: Column) -> Column:
    """A-Z in lower case, and no other letter."""
    ascii_only = F.octet_length(run) == F.char_length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def vocabulary(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n) of whole texts: letter runs, of which one in SLIP has lost a code point.

    Which one follows from the id and the run alone: every occurrence of a run in a document
    is changed alike. A null id counts as empty text; null and empty texts have no words.
    Counts combine map-side, so a very common word arrives as one row per task. Runs
    shorter than `min_length` cannot become words and are not taken out of the text.
    """
    pattern = F.lit(f"({LETTERS}{{{max(1, min_length)},}})")
    runs = docs.select(F.col(doc_id).cast("string").alias("_id"), F.explode(F.regexp_extract_all(text, pattern)).alias("_run"))
    runs = runs.select("_id", _lower(F.col("_run")).alias("_run"))
    h = F.crc32(F.encode(F.concat(F.coalesce("_id", F.lit("")), F.lit(":"), "_run"), "utf-8"))
    at = F.pmod(h, F.char_length("_run")).cast("int")
    shorter = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.char_length("_run")))
    words = runs.select(F.when(F.pmod(h, F.lit(SLIP)) == 0, shorter).otherwise(F.col("_run")).alias("word"))
    counted = words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _powers(length: int) -> np.ndarray:
    """BASE to the power of a place's distance from the end."""
    out = np.ones(length + 1, np.uint64)
    np.multiply.accumulate(np.full(length, BASE, np.uint64), out=out[1:])
    return out[::-1][1:]


def _points(words: list[str], length: int) -> np.ndarray:
    """Code points, a row per word of this length."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat.reshape(len(words), length).astype(np.uint64)


def _mixed(hashes: np.ndarray, which: int) -> np.ndarray:
    out = hashes * np.uint64(MIXERS[which])
    return out ^ (out >> np.uint64(32))


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return _mixed(hashes, 2) % np.uint64(parts)


def _address(hashes: np.ndarray, blocks: int, probe: int) -> np.ndarray:
    """The bit that each hash has for a probe; all of a hash lie in the block it names."""
    block = (_mixed(hashes, 0) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    within = (_mixed(hashes, 1) >> np.uint64(10 * probe)) & np.uint64(BLOCK_BITS - 1)
    return block * np.uint64(BLOCK_BITS) + within


def bloom(hashes: np.ndarray) -> np.ndarray:
    """A blocked Bloom filter of the hashes, as bytes."""
    blocks = max(1, -(-len(hashes) * BITS_PER_WORD // BLOCK_BITS))
    bits = np.zeros(blocks * BLOCK_BITS, bool)
    for probe in range(PROBES):
        bits[_address(hashes, blocks, probe)] = True
    return np.packbits(bits, bitorder="little")


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The places of the hashes that a filter lets through; those it was made of always are.

    Most hashes fail an early probe, so each probe looks only at what the last one left.
    """
    left, blocks = np.arange(len(hashes)), len(bits) * 8 // BLOCK_BITS
    for probe in range(PROBES):
        at = _address(hashes[left], blocks, probe)
        left = left[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return left


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash per word, from which those of its edits follow."""
    out = np.zeros(len(words), np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == length)
        step = max(1, HASHES // length)
        for part in np.split(at, range(step, len(at), step)):
            out[part] = (_points([words[i] for i in part], length) * _powers(length)).sum(1, dtype=np.uint64)
    return out


Filters = dict[tuple[int, int], np.ndarray]


def _let_through(filters: Filters, parts: dict[int, int], length: int, hashes: np.ndarray) -> np.ndarray:
    """The places of the hashes of words of a length that this pass's filters let through."""
    shard = min(length, LONGEST)
    held = [part for size, part in filters if size == shard]
    if not held:
        return np.empty(0, np.int64)
    if parts[shard] == 1:
        return may_hold(filters[shard, 0], hashes)
    dealt = _part(hashes, parts[shard])
    found = [(at := np.flatnonzero(dealt == part))[may_hold(filters[shard, part], hashes[at])] for part in held]
    return np.concatenate(found)


def edits(
    words: list[str], length: int, letters: np.ndarray, filters: Filters, parts: dict[int, int]
) -> Iterator[tuple[int, str]]:
    """(place of the word, edit) for words of one length, where a filter may hold the edit.

    Edits are one code point deleted, or replaced by a greater one of `letters`.
    """
    points, powers = _points(words, length), _powers(length)
    terms = points * powers
    # A hash is a sum over places counted from the end, so what follows a deleted place keeps its part.
    after = np.cumsum(terms[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    whole = after[:, 0]
    shards = {size for size, _ in filters}
    before = np.zeros(len(words), np.uint64)
    for i in range(length):
        if length > 1 and min(length - 1, LONGEST) in shards:
            # Deleting any of a run of equal code points gives one word: the first of the run does.
            new = np.flatnonzero(points[:, i] != points[:, i - 1]) if i else np.arange(len(words))
            rest = after[new, i + 1] if i + 1 < length else np.uint64(0)
            hashes = before[new] * powers[i] + rest
            for at in new[_let_through(filters, parts, length - 1, hashes)].tolist():
                yield at, words[at][:i] + words[at][i + 1 :]
        if min(length, LONGEST) in shards:
            hashes = (whole - terms[:, i])[:, None] + (letters * powers[i])[None, :]
            rows, columns = np.nonzero(letters[None, :] > points[:, i][:, None])
            through = _let_through(filters, parts, length, hashes[rows, columns])
            for at, letter in zip(rows[through].tolist(), letters[columns[through]].tolist(), strict=True):
                yield at, words[at][:i] + chr(letter) + words[at][i + 1 :]
        before = before * np.uint64(BASE) + points[:, i]


def _filters(words: DataFrame, parts: dict[int, int]) -> DataFrame:
    """(length, part, bits): a filter per shard, each made of a bounded number of words in one task."""
    shard = F.least(F.char_length("word"), F.lit(LONGEST))
    schema = "length int, part int, bits binary"

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = word_hashes(batch.column(0).to_pylist())
            lengths = batch.column(1).to_numpy()
            counts = np.fromiter((parts[n] for n in lengths.tolist()), np.uint64, len(lengths))
            part = (_mixed(hashes, 2) % counts).astype(np.int32)
            arrays = [batch.column(1), pa.array(part), pa.array(hashes.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["length", "part", "hash"])

    def build(key: tuple, group: pa.Table) -> pa.Table:
        bits = bloom(group.column("hash").to_numpy().view(np.uint64))
        return pa.table({"length": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    hashed = words.select("word", shard.cast("int").alias("length")).mapInArrow(dealt, "length int, part int, hash bigint")
    return hashed.groupBy("length", "part").applyInArrow(build, schema)


def _probed(words: DataFrame, letters: np.ndarray, filters: Filters, parts: dict[int, int]) -> DataFrame:
    """(word, n, edit): the edits that a pass's filters let through."""
    shared = words.sparkSession.sparkContext.broadcast(filters)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, counts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            lengths = np.fromiter(map(len, given), np.int64, len(given))
            for length in np.unique(lengths[lengths > 0]).tolist():
                places = np.flatnonzero(lengths == length)
                step = max(1, HASHES // (len(letters) + length))
                for part in np.split(places, range(step, len(places), step)):
                    found = list(edits(given[part].tolist(), length, letters, shared.value, parts))
                    at = part[np.fromiter((i for i, _ in found), np.int64, len(found))]
                    arrays = [pa.array(given[at], pa.string()), pa.array(counts[at]), pa.array([e for _, e in found], pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["word", "n", "edit"])

    return words.mapInArrow(probe, "word string, n bigint, edit string")


def near_pairs(words: DataFrame, shard_words: int = SHARD_WORDS, pass_words: int = PASS_WORDS) -> DataFrame:
    """(word, n, near, near_n): every two words one edit apart, each pair once.

    `words` holds distinct words and their counts. A shard's filter is made of about
    `shard_words` words; passes broadcast filters of at most `pass_words` words together,
    or one shard.
    """
    spark = words.sparkSession
    let_workers_import(spark)
    words = words.select("word", "n")
    shard = F.least(F.char_length("word"), F.lit(LONGEST)).alias("length")
    sizes = words.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    parts = {r["length"]: -(-r["n"] // shard_words) for r in sizes.collect()}
    # Code points in use: at most as many as the runs' letters, whatever the number of words.
    used = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().where("letter <> ''")
    letters = np.array(sorted(ord(r["letter"]) for r in used.collect()), np.uint64)
    kept = settled(_filters(words, parts), "spelling-filters") if parts else None
    passes: list[list[tuple[int, int]]] = [[]]
    for shard_key in ((length, part) for length in sorted(parts) for part in range(parts[length])):
        if (len(passes[-1]) + 1) * shard_words > pass_words and passes[-1]:
            passes.append([])
        passes[-1].append(shard_key)
    found = None
    for shards in passes if parts else []:
        of_pass = F.struct("length", "part").isin([F.struct(F.lit(a), F.lit(b)) for a, b in shards])
        filters = {(r["length"], r["part"]): np.frombuffer(r["bits"], np.uint8) for r in kept.where(of_pass).toLocalIterator()}
        probed = _probed(words, letters, filters, parts)
        found = probed if found is None else found.unionByName(probed)
    if found is None:
        return spark.createDataFrame([], "word string, n bigint, near string, near_n bigint")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.withColumnRenamed("edit", "near").join(known, "near").select("word", "n", "near", "near_n")


def variants(words: DataFrame, times: int = TIMES, **sizes: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with their counts.

    `n_near` counts the words one edit away. `form` is the one of them with the largest
    count (of equal counts the smallest word), where that is at least `times` the word's
    own; else null. `root` is the last form reached from the word, or the word itself. Null
    words are left out. Forms grow tenfold a step, so a chain is short whatever the input.
    """
    words = settled(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    pairs = near_pairs(words, **sizes)
    one = F.struct(F.col("word").alias("word"), (-F.col("near_n")).alias("less"), F.col("near").alias("near"))
    other = F.struct(F.col("near").alias("word"), (-F.col("n")).alias("less"), F.col("word").alias("near"))
    both = pairs.select(F.explode(F.array(one, other)).alias("_")).select("_.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("less", "near")).alias("best"))
    joined = words.join(best, "word", "left")
    common = -F.col("best.less") >= times * F.col("n")
    formed = settled(
        joined.select(
            "word",
            F.when(common, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    result = formed.join(roots, "word", "left")
    return result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of links that lead on: each round a word takes its root's root, until none has another."""
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        if links.join(onward, "root", "left_semi").isEmpty():
            return links
        joined = links.join(onward, "root", "left")
        links = settled(joined.select("word", F.coalesce("onward", "root").alias("root")), "spelling-roots", gather=True)


SQL = """
WITH RECURSIVE crc_steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
), runs AS (
  SELECT id, run, count(*) AS c FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) GROUP BY id, run
), coded AS (
  SELECT run, c, hex(encode(id || ':' || run)) AS digits FROM runs WHERE length(run) >= 7
), hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT),
             list_transform(range(length(digits) // 2), lambda i: CAST('0x' || substring(digits, 2 * i + 1, 2) AS BIGINT))),
           lambda a, b: xor(a >> 8, steps[xor(a & 255, b) + 1]))) AS h
  FROM coded, crc_steps
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2)
              ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), shorter AS (
  SELECT word, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM shorter WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM shorter WHERE rest IN (SELECT word FROM words)
), ranked AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
  FROM pairs p JOIN words w ON w.word = p.near
), formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.near_n >= 10 * w.n THEN r.near END AS form,
         CASE WHEN r.near_n >= 10 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), followed AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT d.word, f.form FROM followed d JOIN formed f ON f.word = d.at WHERE f.form IS NOT NULL
), roots AS (
  SELECT d.word, d.at AS root FROM followed d JOIN formed f ON f.word = d.at WHERE f.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots r USING (word)
"""
