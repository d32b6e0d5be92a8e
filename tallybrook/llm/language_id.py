"""Language identification by character language models with Kneser-Ney smoothing.

Each language has an interpolated Kneser-Ney model of characters. All models lie
in common sorted arrays of n-gram hashes, with one column of log probabilities
per language. A text gets the language under which its cross-entropy per
character is lowest; how sure that is, and when a text fits no language, is
calibrated on labelled texts that the models were not counted from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.llm.shared import let_workers_import, spread

ORDER = 4
# Models are counted from about this many labelled texts of each language, whole.
FIT_ROWS = 1500
# One in so many of those calibrates instead.
CALIBRATION = 5
# A text is rejected above this quantile of the calibration texts' cross-entropy.
REJECT_QUANTILE = 0.995
# Texts are worked on in groups of about this many characters.
BATCH_CHARS = 1 << 20

# A character's hash has 12 bits: itself below U+1000, folded above. An n-gram's hash is its
# characters' hashes side by side, so contexts and endings are shifts and masks.
BITS = 12
SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Hash of every code point's lower-case letter; a space for what is no letter."""
    table = np.full(0x110000, SPACE, np.int64)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            code = ord(low) if len(low) == 1 else point
            table[point] = max(1, (code ^ (code >> BITS)) & 0xFFF)
    return table


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' characters, each text led by ORDER - 1 spaces, and where each starts.

    Runs of characters that are no letters become one space.
    """
    lead = " " * (ORDER - 1)
    joined = lead + lead.join(texts)
    chars = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")]
    lengths = np.array([len(t) for t in texts], np.int64) + ORDER - 1
    starts = np.cumsum(lengths) - lengths
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != SPACE) | (chars[:-1] != SPACE)
    for i in range(ORDER - 1):
        keep[starts + i] = True
    new_starts = np.cumsum(keep)[starts] - 1
    return chars[keep], new_starts


def _grams(chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, and how many each text has (its lead has none)."""
    grams = chars.copy()
    for back in range(1, ORDER):
        grams[back:] |= chars[:-back] << (BITS * back)
    inside = np.ones(len(chars), bool)
    for i in range(ORDER - 1):
        inside[starts + i] = False
    return grams[inside], np.diff(np.append(starts, len(chars))) - (ORDER - 1)


def _grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about BATCH_CHARS characters of text."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start, held = 0, 0
        for at, text in enumerate(texts):
            held += len(text)
            if held >= BATCH_CHARS or at == len(texts) - 1:
                yield batch.slice(start, at + 1 - start), texts[start : at + 1]
                start, held = at + 1, 0


@dataclass
class Model:
    """Per order, n-gram hashes and contexts, sorted, with a column per language."""

    languages: list[str]
    grams: list[np.ndarray]  # order 1 first
    log_probs: list[np.ndarray]
    contexts: list[np.ndarray]
    log_backoffs: list[np.ndarray]
    log_uniform: float
    sharpness: float = 1.0
    limits: np.ndarray | None = None

    def log_probability(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """One row per n-gram, one column per language."""
        if order == 0:
            return np.full((len(grams), len(self.languages)), self.log_uniform)
        known = self.grams[order - 1]
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        out = self.log_probs[order - 1][at]
        missing = np.flatnonzero(known[at] != grams)
        if len(missing):
            rest = grams[missing]
            lower = self.log_probability(rest & ((1 << (BITS * (order - 1))) - 1), order - 1)
            contexts = self.contexts[order - 1]
            context = rest >> BITS
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            lower += np.where((contexts[at] == context)[:, None], self.log_backoffs[order - 1][at], 0.0)
            out[missing] = lower
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character under each language, and whether the text has a letter."""
        chars, starts = _characters(texts)
        grams, counts = _grams(chars, starts)
        letters = np.add.reduceat(chars != SPACE, starts) > 0
        places, distinct = pd.factorize(grams)
        table = self.log_probability(distinct)
        ends = np.cumsum(counts)
        out = np.zeros((len(texts), len(self.languages)))
        filled = np.flatnonzero(counts)
        for i in range(len(self.languages) if len(filled) else 0):
            column = np.ascontiguousarray(table[:, i])[places]
            out[filled, i] = -np.add.reduceat(column, (ends - counts)[filled]) / counts[filled]
        return out, letters


def _one_language(top: np.ndarray, counts: np.ndarray, characters: int) -> list[dict]:
    """Kneser-Ney per order, 1 first: hashes, log probabilities, contexts, backoffs."""
    levels = [(top, counts.astype(np.float64))]
    for order in range(ORDER - 1, 0, -1):
        # Below the highest order, an n-gram counts once for each character seen before it.
        endings, before = np.unique(levels[0][0] & ((1 << (BITS * order)) - 1), return_counts=True)
        levels.insert(0, (endings, before.astype(np.float64)))
    out: list[dict] = []
    for order, (grams, count) in enumerate(levels, 1):
        ones, twos = np.sum(count == 1), np.sum(count == 2)
        discount = min(0.95, ones / (ones + 2 * twos)) if ones else 0.5
        contexts, of, kinds = np.unique(grams >> BITS, return_inverse=True, return_counts=True)
        totals = np.bincount(of, count)
        backoff = discount * kinds / totals
        if order == 1:
            lower = np.full(len(grams), 1.0 / characters)
        else:
            below = out[-1]
            ending = grams & ((1 << (BITS * (order - 1))) - 1)
            lower = np.exp(below["log_probs"][np.searchsorted(below["grams"], ending)])
        probs = np.maximum(count - discount, 0) / totals[of] + backoff[of] * lower
        out.append({"grams": grams, "log_probs": np.log(probs), "contexts": contexts, "log_backoffs": np.log(backoff)})
    return out


def _joined(models: dict[str, list[dict]], characters: int) -> Model:
    """The languages' arrays over all their n-grams; where one lacks an n-gram, its backed-off value."""
    languages = sorted(models)
    model = Model(languages, [], [], [], [], -np.log(characters))
    for order in range(1, ORDER + 1):
        levels = [models[name][order - 1] for name in languages]
        grams = np.unique(np.concatenate([x["grams"] for x in levels]))
        contexts = np.unique(np.concatenate([x["contexts"] for x in levels]))
        backoffs = np.zeros((len(contexts), len(languages)))
        probs = model.log_probability(grams & ((1 << (BITS * (order - 1))) - 1), order - 1)
        for i, x in enumerate(levels):
            backoffs[np.searchsorted(contexts, x["contexts"]), i] = x["log_backoffs"]
            probs[:, i] += backoffs[np.searchsorted(contexts, grams >> BITS), i]
            probs[np.searchsorted(grams, x["grams"]), i] = x["log_probs"]
        model.grams.append(grams)
        model.log_probs.append(probs)
        model.contexts.append(contexts)
        model.log_backoffs.append(backoffs)
    return model


def fit(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS
) -> Model | None:
    """Models from labelled texts; null texts and labels, and texts without a letter, teach nothing.

    About `fit_rows` texts of each language are used, those whose hashed key lies
    below a bound that follows from the language's number of rows; they are read
    whole. N-grams are counted by Spark; what is brought to the driver is one row
    per language and n-gram, which that bound limits. None if nothing is labelled.
    """
    let_workers_import(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    bounds = F.lit(0).cast("long")
    for name, n in sizes.items():
        bounds = F.when(F.col("lang") == name, F.lit(int(2**60 * min(1.0, fit_rows / n)))).otherwise(bounds)
    sample = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), spread(F.col(key)).alias("spread"))
    sample = sample.where(F.col("spread") <= bounds)
    calibrates = F.pmod(F.xxhash64("spread"), F.lit(CALIBRATION)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _grouped(batches, 0):
            langs = np.array(batch.column(1).to_pylist(), object)
            for name in sorted(set(langs.tolist())):
                own = [t for t, x in zip(texts, langs, strict=True) if x == name]
                grams, n = np.unique(_grams(*_characters(own))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    counted = sample.where(~calibrates).select("text", "lang").mapInArrow(count, "lang string, gram bigint, n bigint")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if table.empty:
        return None
    characters = len(np.unique(table["gram"].to_numpy() & 0xFFF)) + 1
    models = {}
    for name, part in table.groupby("lang"):
        part = part.sort_values("gram")
        models[name] = _one_language(part["gram"].to_numpy(), part["n"].to_numpy(), characters)
    model = _joined(models, characters)
    _calibrate(model, sample.where(calibrates).select("text", "lang"))
    return model


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Set how sharply differences count, and from which cross-entropy on a text is rejected."""
    names = model.languages

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _grouped(batches, 0):
            entropies, letters = model.cross_entropies(texts)
            lists = pa.array([e.tolist() for e in entropies], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), lists, pa.array(letters)], names=["lang", "entropies", "letters"])

    rows = sample.mapInArrow(measure, "lang string, entropies array<double>, letters boolean").where("letters").toPandas()
    rows = rows[rows["lang"].isin(names)]
    model.limits = np.full(len(names), np.inf)
    if rows.empty:
        return
    entropies = np.array(rows["entropies"].tolist())
    right = np.array([names.index(x) for x in rows["lang"]])
    for i in range(len(names)):
        if np.any(right == i):
            model.limits[i] = np.quantile(entropies[right == i, i], REJECT_QUANTILE)
    choices = 2.0 ** np.arange(-2, 9, 0.5)
    losses = [-np.mean(np.log(_shares(entropies, s)[np.arange(len(right)), right] + 1e-12)) for s in choices]
    model.sharpness = float(choices[int(np.argmin(losses))])


def _shares(entropies: np.ndarray, sharpness: float) -> np.ndarray:
    scores = -entropies * sharpness
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def predicted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`row`, the given row, with `lang_pred`, `score`, `cross_entropy` and `rejected`.

    Only the text is looked at. Without a model, and for a null text or one
    without a letter, the language is `und`, the score 0 and the rest null. Equal
    cross-entropies go to the first language by name. `score` is the calibrated
    share of the language among all; a `rejected` text fits even its language worse
    than nearly all labelled texts do.
    """
    let_workers_import(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    given = docs.select(row.alias("row"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            given.schema["row"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("cross_entropy", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _grouped(batches, 1):
            n = len(texts)
            if model is None:
                columns = [["und"] * n, [0.0] * n, [None] * n, [None] * n]
            else:
                entropies, letters = model.cross_entropies(texts)
                best = np.argmin(entropies, axis=1)
                least = entropies[np.arange(n), best]
                share = _shares(entropies, model.sharpness)[np.arange(n), best]
                rejected = least > model.limits[best]
                columns = [
                    [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)],
                    np.where(letters, share, 0.0),
                    [float(e) if ok else None for e, ok in zip(least, letters, strict=True)],
                    [bool(r) if ok else None for r, ok in zip(rejected, letters, strict=True)],
                ]
            types = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return given.mapInArrow(run, schema)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; null for a null key."""
    return F.crc32(F.encode(key.cast("string"), "utf-8")) % folds
