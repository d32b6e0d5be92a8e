"""Near duplicates by circulant MinHash, with every link confirmed on whole shingle sets.

A shingle's 64-bit hash is its place after the first permutation. The second is a
bijection of 32-bit numbers; shifted circularly by k, it gives coordinate k of the
signature. Bands of coordinates are buckets. Texts of equal sets are one class,
and a class stands for all its copies. Within a bucket, pairs whose one-bit
sketches are close enough are compared on their sets, nearest first; classes that
are linked already are not compared again, so a bucket of similar texts gives
about one link per class and never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.graph import components
from tallybrook.llm.shared import let_workers_import, row_key, settled

# 128 coordinates in 32 bands of 4: two sets of similarity 0.8 meet in no band with probability 5e-8.
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
# Sketches of sets of similarity 0.8 differ in 12.8 of 128 bits on average, with a
# standard deviation of 3.4; farther apart than this are fewer than one pair in a million.
MOST_BITS = 33
# Buckets are compared in chunks of so many classes.
CHUNK = 512
# Chunks with so many shingles at most have all their intersections counted at once.
COUNTED_SHINGLES = 1 << 20
# Counters that shingles of large buckets share, to put rare shingles first.
COUNTERS = 1 << 18
# Texts are hashed in groups of about this many words.
BATCH_WORDS = 1 << 16
# The hashes of so many words are kept at hand.
KEPT_WORDS = 100_000

_MASK = 0xFFFFFFFFFFFFFFFF
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: a bijection in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hash of each word; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of `width` words, A-Z lower-cased.

    Fewer words are one shingle; no words, none. Splitting bytes parts words at
    the six ASCII spaces only, and lower-casing bytes changes A-Z only.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    take = min(width, len(words))
    n = len(words) - take + 1
    rolled = np.full(n, take, np.uint64)
    for i in range(take):
        rolled = _mixed(rolled * _STEP + hashes[i : i + n])
    return np.unique(rolled)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of coordinates per set; no set may be empty."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    places = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), COORDINATES), np.uint32)
    x, y = np.empty_like(places), np.empty_like(places)
    for k in range(COORDINATES):
        # The second permutation at the places shifted by k.
        np.add(places, np.uint32(k), out=x)
        np.right_shift(x, 16, out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x85EBCA6B), out=x)
        np.right_shift(x, 13, out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0xC2B2AE35), out=x)
        np.right_shift(x, 16, out=y)
        np.bitwise_xor(x, y, out=x)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def band_hashes(coordinates: np.ndarray) -> np.ndarray:
    """A 64-bit bucket per band, different for equal values in different bands."""
    wide = coordinates.astype(np.uint64).reshape(len(coordinates), BANDS, ROWS)
    hashes = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), wide.shape[:2]).copy()
    for i in range(ROWS):
        hashes = _mixed(hashes * _STEP + wide[:, :, i])
    return hashes.view(np.int64)


def sketches(coordinates: np.ndarray) -> np.ndarray:
    """The last bit of every coordinate, as two 64-bit numbers per row."""
    return np.packbits((coordinates & 1).astype(np.uint8), axis=1).view(np.int64)


_SIGNED = (
    "_key struct<id:{id},text_hash:bigint>, n bigint, cls binary, s0 bigint, s1 bigint, bands array<bigint>"
)


def signed(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Set size, class (a digest of the whole set), sketch and buckets of every document."""
    given = docs.select(row_key(key, text).alias("_key"), F.col(text).alias("text"))
    schema = _SIGNED.format(id=docs.schema[key].dataType.simpleString())

    def columns(keys: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        filled = [i for i, s in enumerate(sets) if len(s)]
        bands, s0, s1 = [None] * len(sets), [None] * len(sets), [None] * len(sets)
        if filled:
            coordinates = signatures([sets[i] for i in filled])
            hashed, bits = band_hashes(coordinates), sketches(coordinates)
            for at, i in enumerate(filled):
                bands[i], s0[i], s1[i] = hashed[at], int(bits[at, 0]), int(bits[at, 1])
        cls = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(keys),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(cls, pa.binary()),
                pa.array(s0, pa.int64()),
                pa.array(s1, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["_key", "n", "cls", "s0", "s1", "bands"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for at, value in enumerate(batch.column(1)):
                sets.append(shingle_set(value.as_py(), width))
                keys.append(batch.column(0).slice(at, 1))
                held += len(sets[-1])
                if held >= BATCH_WORDS or len(sets) >= 4096:
                    yield columns(keys, sets)
                    keys, sets, held = [], [], 0
        if sets:
            yield columns(keys, sets)

    return given.mapInArrow(run, schema)


def links_among(
    classes: list[bytes],
    sizes: np.ndarray,
    bits: np.ndarray,
    texts: list[str],
    groups: list,
    sides: np.ndarray,
    width: int,
    percent: int,
    most_bits: int | None = MOST_BITS,
) -> list[tuple[bytes, bytes]]:
    """Links that join what is similar among the members of a chunk.

    `groups` has what is linked already; members of one group are not compared.
    If `sides` holds both 0 and 1, only members of different sides are. Without
    `most_bits`, sketches rule out no pair.
    """
    m = len(classes)
    if m < 2:
        return []
    size = sizes.astype(np.int64)
    far = np.bitwise_count(bits[:, None, 0] ^ bits[None, :, 0]).astype(np.uint8)
    far += np.bitwise_count(bits[:, None, 1] ^ bits[None, :, 1]).astype(np.uint8)
    likely = np.triu(far <= (most_bits if most_bits is not None else COORDINATES), 1)
    # The smaller set holds the intersection, the larger is held by the union.
    likely &= 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
    if len(set(sides.tolist())) > 1:
        likely &= sides[:, None] != sides[None, :]
    numbers = {g: at for at, g in enumerate(dict.fromkeys(groups))}
    numbered = np.array([numbers[g] for g in groups])
    likely &= numbered[:, None] != numbered[None, :]
    sets: dict[int, np.ndarray] = {}
    if likely.sum() > 4 * m and size.sum() <= COUNTED_SHINGLES:
        wanted = np.nonzero(likely.any(0) | likely.any(1))[0]
        sets = {k: shingle_set(texts[k], width) for k in wanted.tolist()}
        shared = _intersections(list(sets.values()))
        either = size[wanted][:, None] + size[wanted][None, :] - shared
        likely[np.ix_(wanted, wanted)] &= 100 * shared >= percent * either
    first, second = np.nonzero(likely)
    order = np.argsort(far[first, second], kind="stable")
    parent: dict = {g: g for g in groups}

    def root(g):
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    links = []
    for i, j in zip(first[order].tolist(), second[order].tolist(), strict=True):
        a, b = root(groups[i]), root(groups[j])
        if a == b:
            continue
        for k in (i, j):
            if k not in sets:
                sets[k] = shingle_set(texts[k], width)
        shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
            parent[b] = a
            links.append((classes[i], classes[j]))
    return links


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all given sets, as a square."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts > 1
    kept = several[place]
    column = (np.cumsum(several) - 1)[place[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[kept][order], column[order]
    out = np.zeros((m, m), np.float32)  # whole numbers far below 2**24
    for low in range(0, int(several.sum()), 2048):
        a, b = np.searchsorted(column, [low, low + 2048])
        held = np.zeros((m, 2048), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held @ held.T
    # What only one set holds was left out.
    np.fill_diagonal(out, [len(s) for s in sets])
    return out.astype(np.int64)


def _chunk_links(rows: DataFrame, width: int, percent: int, most_bits: int | None) -> DataFrame:
    """Links (a, b) within each chunk of rows (bucket, chunk, other, cls, n, s0, s1, grp, side, text).

    Chunks are dealt out by Spark and come sorted; one chunk at a time is held.
    """
    names = ["bucket", "chunk", "other", "cls", "n", "s0", "s1", "grp", "side", "text"]
    dealt = rows.select(*names).repartition("bucket", "chunk", "other")
    dealt = dealt.sortWithinPartitions("bucket", "chunk", "other")

    def found(held: list[tuple]) -> list[tuple[bytes, bytes]]:
        columns = list(zip(*held, strict=True))
        bits = np.array([columns[2], columns[3]], np.int64).view(np.uint64).T
        return links_among(
            list(columns[0]), np.array(columns[1]), bits, list(columns[6]), list(columns[4]), np.array(columns[5]), width, percent, most_bits
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, links = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != chunk:
                    if len(held) > 1:
                        links += found(held)
                    chunk, held = row[:3], []
                held.append(row[3:])
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links, strict=True)], names=["a", "b"])
                links = []
        if len(held) > 1 and (links := found(held)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links, strict=True)], names=["a", "b"])

    return dealt.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    most_bits: int | None = MOST_BITS,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every document.

    Words are runs of characters other than the six ASCII spaces. Documents whose
    sets have a Jaccard similarity of `percent` or more are linked (80 is what
    the bands are laid out for; a higher value loses no link); `component_id` is
    the smallest key reachable. A text without words has an empty set and is
    linked with nothing: its component is its own key. Null keys are smaller
    than none: they count only where a component has no other key. Rows that
    repeat a key and text have the same component, and are kept alike.

    Pairs of a bucket whose sketches differ in more than `most_bits` of 128 bits
    are not compared; with None all are.

    A bucket of more than CHUNK classes is compared within chunks first, dealt
    twice. What has not joined the bucket's largest component by then is compared
    with the whole bucket, chunk by chunk, so no pair is left out, and no chunk
    grows. Classes none of whose rarest shingles another component has among its
    own are left out of that: they cannot be similar to it.
    """
    sig, nodes = _rooted(docs, key, text, width, percent, most_bits)
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = nodes.select("cls", "root").join(ids, "root").select("cls", "component_id")
    result = sig.join(of_class, "cls", "left")
    id_ = F.col("_key.id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(id_)
    return result.select(id_.alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col(key).eqNullSafe(F.col("component_id"))
    )


def _rooted(
    docs: DataFrame, key: str, text: str, width: int, percent: int, most_bits: int | None
) -> tuple[DataFrame, DataFrame]:
    """The signed documents, and (cls, least, root): each class with its smallest key and its component's root."""
    let_workers_import(docs.sparkSession)
    sig = settled(signed(docs, key, text, width), "signatures")
    classes = settled(
        sig.where("n > 0")
        .groupBy("cls")
        .agg(F.min("_key").alias("rep"), F.min("_key.id").alias("least"), *[F.first(c).alias(c) for c in ("n", "s0", "s1", "bands")]),
        "classes",
    )
    buckets = settled(classes.select("cls", F.explode("bands").alias("bucket")), "buckets")
    sizes = buckets.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("cls")).alias("x"),
        F.sum(F.shiftright(F.xxhash64(F.lit(1), "cls"), 20)).alias("y"),
    )
    # Buckets of the same classes say the same; one of them is compared.
    shared = sizes.where("members > 1").groupBy("x", "y", "members").agg(F.min("bucket").alias("bucket"))
    members = settled(buckets.join(shared.select("bucket", "members"), "bucket"), "members")
    wanted = members.select("cls").distinct().join(classes.select("cls", "rep", "n", "s0", "s1"), "cls")
    given = docs.select(row_key(key, text).alias("rep"), F.col(text).alias("text"))
    # One row per class, also where rows repeat.
    whole = settled(given.join(wanted, "rep").drop("rep").dropDuplicates(["cls"]), "members-text")
    chunks = F.ceil(F.col("members") / CHUNK)
    chunked = members.withColumn("chunk", F.pmod(F.xxhash64("cls"), chunks)).join(whole, "cls")
    alone = chunked.select(
        "*", F.lit(0).cast("long").alias("other"), F.col("cls").alias("grp"), F.lit(0).alias("side")
    )
    links = settled(_chunk_links(alone, width, percent, most_bits), "near-links", gather=True)
    large = members.where(F.col("members") > CHUNK)
    if not large.isEmpty():
        links = _across_chunks(large, whole, links, width, percent, most_bits)
    roots = components(links)
    nodes = classes.select("cls", "least").join(roots, F.col("cls") == F.col("node"), "left")
    return sig, nodes.select("cls", "least", F.coalesce("root", "cls").alias("root"))


def _across_chunks(
    large: DataFrame, whole: DataFrame, links: DataFrame, width: int, percent: int, most_bits: int | None
) -> DataFrame:
    """Links that join what `links` does, and those of large buckets that lie across their chunks."""
    # Dealt anew, chunks hold members of every large component, which meet here.
    roots = components(links)
    known = _grouped(large, roots)
    several = known.groupBy("bucket").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a <> b")
    known = known.join(several.select("bucket"), "bucket", "left_semi")
    chunks = F.ceil(F.col("members") / CHUNK)
    again = known.withColumn("chunk", F.pmod(F.xxhash64(F.lit(3), "cls"), chunks)).withColumns(
        {"other": F.lit(0).cast("long"), "side": F.lit(0)}
    )
    more = _chunk_links(again.join(whole, "cls"), width, percent, most_bits)
    links = _joined(roots).unionByName(settled(more, "near-links", gather=True))

    # The rest of each bucket, against everything in it.
    roots = components(links)
    known = settled(_grouped(large, roots), "large-buckets")
    sizes = known.groupBy("bucket", "grp").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("k", "grp")).alias("top"), F.count(F.lit(1)).alias("groups"))
    opened = known.drop("members").join(
        largest.where("groups > 1").select("bucket", F.col("top.grp").alias("top")), "bucket"
    )
    meeting = _meeting(opened.select("cls", "grp").distinct(), whole, width, percent)
    opened = settled(opened.join(meeting, "cls", "left_semi"), "open-buckets")
    counts = opened.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(F.col("grp") != F.col("top")).alias("left")
    )
    n_chunks = F.ceil(F.col("members") / CHUNK)
    n_others = F.ceil(F.col("left") / CHUNK)
    counted = opened.join(counts.where("left > 0"), "bucket")
    every = counted.withColumn("chunk", F.pmod(F.xxhash64("cls"), n_chunks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), n_others - 1))
    )
    others = counted.where("grp <> top").withColumn("other", F.pmod(F.xxhash64(F.lit(2), "cls"), n_others))
    others = others.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)))
    columns = ["bucket", "chunk", "other", "cls", "grp"]
    both = every.select(*columns, F.lit(0).alias("side")).unionByName(others.select(*columns, F.lit(1).alias("side")))
    more = _chunk_links(both.join(whole, "cls"), width, percent, most_bits)
    return _joined(roots).unionByName(settled(more, "near-links", gather=True))


def _joined(roots: DataFrame) -> DataFrame:
    """Links (a, b) that say the same as the roots."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _grouped(large: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, members, cls, grp) of large buckets, by the components so far."""
    known = large.join(roots, F.col("cls") == F.col("node"), "left")
    return known.select("bucket", "members", "cls", F.coalesce("root", "cls").alias("grp"))


def _meeting(classes: DataFrame, whole: DataFrame, width: int, percent: int) -> DataFrame:
    """`cls` of those of (cls, grp) that may be similar to a class of another group.

    Two sets with a similarity of `percent` have in common at least that share of
    either. So in any one order of all shingles, each has a common shingle among
    its first ones, as many as the share leaves out and one more. Rare shingles
    come first: the order is by counters that shingles share, and by hash.
    """
    held = settled(whole.select("cls", "text").join(classes, "cls").select("cls", "grp", "text"), "open-texts")

    def slots(shingles: np.ndarray) -> np.ndarray:
        return (shingles % np.uint64(COUNTERS)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                np.add.at(counts, slots(shingle_set(value.as_py(), width)), 1)
        used = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["slot", "n"])

    counted = held.select("text").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # one row per counter at most
    totals = np.zeros(COUNTERS, np.int64)
    totals[table.column("slot").to_numpy()] = table.column("n").to_numpy()

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, value in enumerate(batch.column(2)):
                shingles = shingle_set(value.as_py(), width)
                first = len(shingles) - -(-percent * len(shingles) // 100) + 1
                # Sets are sorted by hash, and the sort is stable.
                order = np.argsort(totals[slots(shingles)], kind="stable")[:first]
                same = pa.array(np.zeros(len(order), np.int64))
                cls, grp = (batch.column(c).slice(at, 1).take(same) for c in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingles[order].view(np.int64)), cls, grp], names=["shingle", "cls", "grp"]
                )

    firsts = settled(held.mapInArrow(rare, "shingle bigint, cls binary, grp binary"), "rare-shingles")
    groups = firsts.groupBy("shingle").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a <> b")
    return firsts.join(groups, "shingle", "left_semi").select("cls").distinct()


def without_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    most_bits: int | None = MOST_BITS,
) -> DataFrame:
    """The documents with one row of each component left: that of its smallest key.

    Rows are told apart by key and text. Of texts that share the smallest key, one
    of the component stays; a null key stays only where a component has no other.
    A text without words is a copy of rows with its key and the same text only.
    """
    sig, nodes = _rooted(docs, key, text, width, percent, most_bits)
    first = F.struct(F.col("_key.id").isNull().alias("no_id"), F.col("_key").alias("_key"))
    of_class = sig.where("n > 0").groupBy("cls").agg(F.min(first).alias("first"))
    of_root = of_class.join(nodes.select("cls", "root"), "cls").groupBy("root").agg(F.min("first").alias("first"))
    bare = sig.where("n = 0").select("_key").distinct()
    chosen = of_root.select(F.col("first._key").alias("_key")).unionByName(bare)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, row_key(key, text).alias("_key"))
    return rows.join(chosen, "_key", "left_semi").dropDuplicates(["_key"]).select("row.*")
