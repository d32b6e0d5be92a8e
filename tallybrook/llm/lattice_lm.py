"""Language-model scores from all segmentations into the pieces of an existing vocabulary.

A text is words and an end. A word is any sequence of pieces that spell it, the
first one marked as a beginning; its probability is the sum over all of them, by
a forward recursion over the lattice in log space. A vocabulary's scores say how
likely its pieces are to begin with; expected counts over the distinct training
words then weight them anew. A word that training texts hold has one arc more in
its lattice, the whole word, by its discounted count; the discounts are what the
pieces share. The model factorises by words, so each distinct word of the corpus
goes through the lattice once. Texts sum the values of common words where they
are read, and those of all others by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.shared import let_workers_import, settled

MARK = "▁"
# The end of a text among words: no word is empty.
END = b""
# A vocabulary made by merges scores a piece by its negative rank; ranks weigh in as 1 / (rank + this).
RANK_SHIFT = 10.0
# The vocabulary's own weights count as so many pieces seen, in all.
PRIOR_PIECES = 3000.0
ROUNDS = 1
# Distinct words are sent on at latest when a task holds this many.
HELD_WORDS = 100_000
# The most common words, none longer than so many bytes, are known to every task; the others are joined.
COMMON_WORDS, COMMON_BYTES = 50_000, 64
# Words go through the lattice in groups of about this many characters.
GROUP_CHARS = 100_000
# Ids that occur more than once are marked in a table of so many slots by their hash.
SLOTS = 1 << 20
# What is summed over the tokens of a text.
SUMS = ["known", "base", "log10p", "lattice"]
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Log probabilities of pieces; `first` and `inner` give a string's place among them."""

    first: dict[str, int]
    inner: dict[str, int]
    bytes_: np.ndarray
    end: int
    prior: np.ndarray
    log_probs: np.ndarray
    # By length, hashes of pieces and of their beginnings, sorted, with the piece or -1.
    first_hashes: list[tuple[np.ndarray, np.ndarray]]
    inner_hashes: list[tuple[np.ndarray, np.ndarray]]

    def weighted(self, expected: np.ndarray, prior_pieces: float = PRIOR_PIECES) -> Pieces:
        """The same pieces weighted by expected counts, smoothed by the prior."""
        probs = (expected + prior_pieces * self.prior) / (expected.sum() + prior_pieces)
        return replace(self, log_probs=np.log(probs))


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _hash_tables(pieces: dict[str, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, the sorted hashes of all pieces and beginnings of pieces of that length."""
    known = {text[:n]: -1 for text in pieces for n in range(1, len(text) + 1)}
    known.update((text, place) for text, place in pieces.items() if text)
    tables = []
    for length in range(1, max(map(len, known)) + 1):
        own = [text for text in known if len(text) == length]
        points = _points(own).reshape(-1, length)
        hashes = np.zeros(len(own), np.uint64)
        for i in range(length):
            hashes = hashes * _BASE + points[:, i] + np.uint64(1)
        order = np.argsort(hashes)
        tables.append((hashes[order], np.array([known[t] for t in own])[order]))
    return tables


def log_end(pieces: Pieces) -> float:
    """Natural log of the end among tokens; after a word, a word's first piece or the end follows."""
    probs = np.exp(pieces.log_probs)
    return math.log(probs[pieces.end] / (probs[pieces.end] + probs[list(pieces.first.values())].sum()))


def vocabulary(path: str) -> Pieces:
    """The pieces of a vocabulary file, weighted by its scores.

    Control pieces, and pieces with the mark elsewhere than in front, spell no
    part of a word and are left out. Bytes spell characters that have no piece.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    first: dict[str, int] = {}
    inner: dict[str, int] = {}
    bytes_: list[int] = []
    weights: list[float] = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_.append(len(weights))
            weights.append(0.0)
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or MARK in piece[1:]):
            table, text = (first, piece[1:]) if piece.startswith(MARK) else (inner, piece)
            table[text] = len(weights)
            weights.append(1.0 / (RANK_SHIFT - model.get_score(i)))
    least = min(w for w in weights if w)
    for i in bytes_:
        weights[i] = least
    first.setdefault("", len(weights))
    if first[""] == len(weights):
        weights.append(max(weights))
    end = len(weights)
    weights.append(max(weights))
    prior = np.array(weights) / math.fsum(weights)
    return Pieces(
        first, inner, np.array(bytes_), end, prior, np.log(prior), _hash_tables(first), _hash_tables(inner)
    )


@dataclass
class Lattice:
    """The lattices of many words, as arcs sorted by where they end.

    A word of n characters has n + 2 places, one after the other: its beginning,
    and after each number of characters from 0 to n. `piece` is -1 for an arc
    that spells a character by its bytes; `spelled` has those arcs' bytes.
    """

    begins: np.ndarray
    finals: np.ndarray
    start: np.ndarray
    end: np.ndarray
    depth: np.ndarray  # the place within the word where an arc ends
    piece: np.ndarray
    log_p: np.ndarray
    spelled: list[tuple[int, list[int]]]


def _matches(
    tables: list[tuple[np.ndarray, np.ndarray]], points: np.ndarray, at: np.ndarray, limits: np.ndarray
) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(places, length, pieces) of all pieces that begin at the places `at`, up to `limits`."""
    hashes = np.zeros(len(at), np.uint64)
    for length, (known, pieces) in enumerate(tables, 1):
        inside = at + length <= limits
        at, limits = at[inside], limits[inside]
        if not len(at):
            return
        hashes = hashes[inside] * _BASE + points[at + length - 1] + np.uint64(1)
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        found = known[place] == hashes
        piece = np.where(found, pieces[place], -1)
        yield at, length, piece
        at, limits, hashes = at[found], limits[found], hashes[found]


def lattice(pieces: Pieces, words: list[str]) -> Lattice:
    """The lattices of words, none empty."""
    points = _points(words)
    lengths = np.array([len(w) for w in words])
    ends = np.cumsum(lengths)
    firsts = ends - lengths
    word_of = np.repeat(np.arange(len(words)), lengths)
    begins = firsts + 2 * np.arange(len(words))
    n = np.arange(len(words))
    start, end, depth, piece = [begins], [begins + 1], [np.ones_like(begins)], [np.full(len(words), pieces.first[""])]
    for at, length, found in _matches(pieces.first_hashes, points, firsts, ends):
        own = word_of[at[found >= 0]]
        start.append(begins[own])
        end.append(begins[own] + 1 + length)
        depth.append(np.full(len(own), length + 1))
        piece.append(found[found >= 0])
    unknown = np.empty(0, np.int64)
    for at, length, found in _matches(pieces.inner_hashes, points, np.arange(len(points)), ends[word_of]):
        if length == 1:
            unknown = at[found < 0]
        at, found = at[found >= 0], found[found >= 0]
        own = word_of[at]
        done = at - firsts[own]
        start.append(begins[own] + 1 + done)
        end.append(begins[own] + 1 + done + length)
        depth.append(done + length + 1)
        piece.append(found)
    own = word_of[unknown]
    done = unknown - firsts[own]
    start.append(begins[own] + 1 + done)
    end.append(begins[own] + 2 + done)
    depth.append(done + 2)
    piece.append(np.full(len(unknown), -1))
    start, end, depth, piece = map(np.concatenate, (start, end, depth, piece))
    log_p = pieces.log_probs[piece]
    spelled = []
    tail = len(piece) - len(unknown)
    for i, point in enumerate(points[unknown].tolist()):
        places = pieces.bytes_[list(chr(point).encode("utf-8", "surrogatepass"))].tolist()
        spelled.append((tail + i, places))
        log_p[tail + i] = pieces.log_probs[places].sum()
    order = np.lexsort((end, depth))
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    spelled = [(int(moved[i]), places) for i, places in spelled]
    return Lattice(
        begins, begins + lengths[n] + 1, start[order], end[order], depth[order], piece[order], log_p[order], spelled
    )


def _log_sums(terms: np.ndarray, to: np.ndarray, out: np.ndarray) -> None:
    """out[x] = log of the summed exp of the terms that go to x; `to` is sorted."""
    heads = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
    most = np.maximum.reduceat(terms, heads)
    each = np.repeat(most, np.diff(np.r_[heads, len(to)]))
    out[to[heads]] = most + np.log(np.add.reduceat(np.exp(terms - each), heads))


def _forward(arcs: Lattice) -> np.ndarray:
    alpha = np.full(arcs.finals[-1] + 1, -np.inf)
    alpha[arcs.begins] = 0.0
    steps = np.flatnonzero(np.r_[True, arcs.depth[1:] != arcs.depth[:-1], True])
    for low, high in zip(steps[:-1], steps[1:], strict=True):
        _log_sums(alpha[arcs.start[low:high]] + arcs.log_p[low:high], arcs.end[low:high], alpha)
    return alpha


def _grouped(words: list[str]) -> Iterator[list[str]]:
    group, held = [], 0
    for word in words:
        group.append(word)
        held += len(word)
        if held >= GROUP_CHARS:
            yield group
            group, held = [], 0
    if group:
        yield group


def log_probabilities(pieces: Pieces, words: list[str]) -> np.ndarray:
    """Natural log of each word's probability over all its segmentations; no word is empty."""
    out = [np.empty(0)]
    for group in _grouped(words):
        arcs = lattice(pieces, group)
        out.append(_forward(arcs)[arcs.finals])
    return np.concatenate(out)


def expected_pieces(pieces: Pieces, words: list[str]) -> np.ndarray:
    """How often each piece is expected in one occurrence of every word, in all."""
    expected = np.zeros(len(pieces.prior))
    for group in _grouped(words):
        arcs = lattice(pieces, group)
        alpha = _forward(arcs)
        beta = np.full(len(alpha), -np.inf)
        beta[arcs.finals] = 0.0
        # Backwards by where arcs start, the farthest within their words first.
        begun = arcs.depth - (arcs.end - arcs.start)
        order = np.lexsort((arcs.start, -begun))
        start, end, log_p, begun = arcs.start[order], arcs.end[order], arcs.log_p[order], begun[order]
        steps = np.flatnonzero(np.r_[True, begun[1:] != begun[:-1], True])
        for low, high in zip(steps[:-1], steps[1:], strict=True):
            _log_sums(beta[end[low:high]] + log_p[low:high], start[low:high], beta)
        whole = np.repeat(alpha[arcs.finals], arcs.finals - arcs.begins + 1)
        share = np.exp(alpha[arcs.start] + arcs.log_p + beta[arcs.end] - whole[arcs.start])
        known = arcs.piece >= 0
        expected += np.bincount(arcs.piece[known], share[known], len(expected))
        for i, places in arcs.spelled:
            for place in places:
                expected[place] += share[i]
    return expected


def _tokens(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased; bytes are split at the six ASCII spaces only."""
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame, text: str, trains: Column) -> DataFrame:
    """(word, c): every word of all texts, and how often training texts hold it; ends included.

    Words are counted within each task first, and then by Spark.
    """
    given = docs.select(F.col(text).alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(seen: Counter, other: set) -> pa.RecordBatch:
            words = [*seen, *(w for w in other if w not in seen)]
            counts = [*seen.values(), *[0] * (len(words) - len(seen))]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], names=["word", "c"])

        seen: Counter = Counter()
        other: set = set()
        for batch in batches:
            for text_, train in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = _tokens(text_.as_py())
                if train:
                    seen.update(words)
                    seen[END] += 1
                else:
                    other.update(words)
                    other.add(END)
                if len(seen) + len(other) >= HELD_WORDS:
                    yield rows(seen, other)
                    seen, other = Counter(), set()
        if seen or other:
            yield rows(seen, other)

    counted = given.mapInArrow(run, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def _expected(counts: DataFrame, pieces: Pieces) -> np.ndarray:
    """Expected number of each piece over all distinct training words.

    Each counts once, as each gives up one discount to the pieces. One row per
    piece reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expected = np.zeros(len(pieces.prior))
        for batch in batches:
            words = [w.decode() for w in batch.column(0).to_pylist()]
            expected[pieces.end] += words.count("")
            expected += expected_pieces(pieces, [w for w in words if w])
        some = np.flatnonzero(expected)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(expected[some])], names=["piece", "n"])

    found = counts.where("c > 0").mapInArrow(run, "piece bigint, n double")
    table = found.groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(pieces.prior))
    out[table["piece"].to_numpy(np.int64)] = table["n"].to_numpy()
    return out


def fit(counts: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Pieces weighted by what the training words are expected to be made of."""
    for _ in range(rounds):
        pieces = pieces.weighted(_expected(counts, pieces))
    return pieces


def _slot(key: str) -> Column:
    """An id's slot; null ids have the last one for themselves."""
    return F.when(F.col(key).isNull(), SLOTS).otherwise(F.pmod(F.xxhash64(key), F.lit(SLOTS))).cast("int")


def _repeated(docs: DataFrame, key: str) -> np.ndarray:
    """For each slot, whether an id of it may stand for several texts; at most SLOTS numbers reach the driver."""
    often = docs.groupBy(F.col(key).alias("_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    out = np.zeros(SLOTS + 1, bool)
    out[often.select(_slot("_id").alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)] = True
    return out


def scored(
    docs: DataFrame, pieces: Pieces, trains: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, lattice_score) of every text, in log10.

    Tokens are the words and an end; a null text is one without words. `trains`
    says which documents to learn from (null: not). `n_known` counts tokens that
    training texts hold, `base_score` is their add-one unigram score, `score` that
    of the lattice, `lattice_score` that of the lattice without whole words. Without training texts the vocabulary's own weights score.
    Repeated rows give repeated results.

    At most COMMON_WORDS words of at most COMMON_BYTES bytes, the most common of
    training texts, go to every task with their values, and each text sends one row with
    their sums. Of all other words it sends a row each, which meets the word's
    values in a hash join on the words; the table of words grows with the corpus
    and stays in Spark. So no word of a great share of the texts is a join key
    (but for longer ones, which adaptive execution splits).
    """
    let_workers_import(docs.sparkSession)
    counts = settled(word_counts(docs, text, trains), "word-counts")
    sums = counts.agg(
        F.sum("c").alias("n"),
        F.count_if(F.col("c") > 0).alias("v"),
        F.count_if(F.col("c") == 1).alias("once"),
        F.count_if(F.col("c") == 2).alias("twice"),
    ).first()
    n, v = sums["n"] or 0, sums["v"] or 0
    discount = sums["once"] / (sums["once"] + 2 * sums["twice"]) if sums["once"] and sums["twice"] else 0.5
    model = fit(counts, pieces, rounds) if n else pieces

    def word_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.decode() for w in batch.column(0).to_pylist()]
            logs = np.full(len(words), end)
            logs[[i for i, w in enumerate(words) if w]] = log_probabilities(model, [w for w in words if w])
            scores = logs
            if n:
                with np.errstate(divide="ignore"):
                    whole = np.log(np.maximum(batch.column(1).to_numpy() - discount, 0) / n)
                scores = np.logaddexp(whole, logs + math.log(discount * v / n))
            columns = [pa.array(x / math.log(10)) for x in (scores, logs)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["_word", "c", "log10p", "lattice"])

    end = log_end(model)
    values = counts.mapInArrow(word_scores, "_word binary, c bigint, log10p double, lattice double").select(
        "_word",
        "c",
        (F.col("c") > 0).cast("long").alias("known"),
        F.log10((F.col("c") + 1) / F.lit(float(n + v + 1))).alias("base"),
        "log10p",
        "lattice",
    )
    values = settled(values, "word-values")
    words = values.drop("c")
    # Not more than 20 * COMMON_WORDS words have this share of all tokens, so little is sorted in one task.
    often = (F.col("c") > 0) & (F.col("c") * (20 * COMMON_WORDS) >= n)
    short = values.where(often & (F.octet_length("_word") <= COMMON_BYTES))
    table = short.orderBy(F.col("c").desc(), "_word").limit(COMMON_WORDS).toArrow()
    common = {word: at for at, word in enumerate(table.column("_word").to_pylist())}
    known = np.stack([table.column(name).to_numpy().astype(float) for name in SUMS], axis=1)
    # A last row of zeros, for all words that are not common.
    known = np.vstack([known, np.zeros(len(SUMS))])
    # Flat columns of few bytes, as every text sends them with each of its words. Texts that
    # share an id are told apart by their hash; where an id has one row, the hash is null.
    given = docs.select(
        F.col(key).alias("_id"),
        F.xxhash64(F.col(text)).alias("_hash"),
        F.col(text).alias("text"),
        _slot(key).alias("_slot"),
    )
    repeated = _repeated(docs, key)
    kind = docs.schema[key].dataType.simpleString()

    def text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = pa.array(repeated[batch.column(3).to_numpy()])
            hashes = pc.if_else(shared, batch.column(1), pa.scalar(None, pa.int64()))
            at: list[int] = []
            found: list[bytes] = []
            times: list[int] = []
            for i, value in enumerate(batch.column(2)):
                own = Counter(_tokens(value.as_py()))
                own[END] = 1
                found.extend(own)
                times.extend(own.values())
                at.append(len(own))
                if len(found) >= HELD_WORDS or i == batch.num_rows - 1:
                    texts = np.arange(i + 1 - len(at), i + 1)
                    yield from sent(batch.column(0), hashes, batch.column(1), texts, at, found, times)
                    at, found, times = [], [], []

    def sent(ids, hashes, keys, texts: np.ndarray, at: list[int], found: list[bytes], times: list[int]):
        place = np.fromiter((common.get(w, -1) for w in found), np.int64, len(found))
        many = np.array(times, np.int64)
        is_common = place >= 0
        weighed = many[:, None] * known[place]
        starts = np.cumsum([0, *at[:-1]])
        sums = np.add.reduceat(weighed, starts)
        tokens = np.add.reduceat(np.where(is_common, many, 0), starts)
        of_text = pa.array(texts)
        # A text's own row meets no word, as none holds a space; its key shares these rows out.
        nowhere = pa.array([b" %d" % (k or 0) for k in keys.take(of_text).to_pylist()], pa.binary())
        packed = pa.StructArray.from_arrays([pa.array(c) for c in sums.T], names=SUMS)
        names = ["_id", "_hash", "word", "times", "sums"]
        own_rows = [ids.take(of_text), hashes.take(of_text), nowhere, pa.array(tokens), packed]
        yield pa.RecordBatch.from_arrays(own_rows, names=names)
        others = np.flatnonzero(~is_common)
        rows = pa.array(np.repeat(texts, at)[others])
        rare = pa.array([found[i] for i in others.tolist()], pa.binary())
        rest = [ids.take(rows), hashes.take(rows), rare, pa.array(many[others]), pa.nulls(len(others), packed.type)]
        yield pa.RecordBatch.from_arrays(rest, names=names)

    packed_type = ", ".join(f"{name}: double" for name in SUMS)
    rows = given.mapInArrow(text_words, f"_id {kind}, _hash bigint, word binary, times bigint, sums struct<{packed_type}>")
    # The words have one row each, so a part of them is a small table to hash.
    met = rows.join(words.hint("shuffle_hash"), F.col("word") == F.col("_word"), "left")
    times = F.col("times")
    total = {name: F.sum(F.coalesce(F.col("sums")[name], times * F.col(name))) for name in SUMS}
    per_text = met.groupBy("_id", "_hash").agg(
        F.sum(times).alias("n_tokens"),
        total["known"].alias("n_known"),
        total["base"].alias("base_score"),
        total["log10p"].alias("score"),
        total["lattice"].alias("lattice_score"),
        F.count("sums").alias("copies"),
    )
    # Rows that repeat an id and text were summed together.
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return per_text.withColumn("_copy", copy).select(
        F.col("_id").alias(key),
        (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
        (F.col("lattice_score") / F.col("copies")).alias("lattice_score"),
    )
