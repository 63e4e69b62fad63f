"""Language identification by interpolated Kneser-Ney models over characters.

Texts are letters in lower case with single blanks between runs of them. Each language has a model of order 4, made of
counts over a bounded sample of labelled documents. The models of all languages share sorted arrays of n-gram hashes,
one per order, with a row of log probabilities per n-gram. The prediction is the language of the lowest cross-entropy
per character; a text that even this language finds less likely than any calibration text is rejected.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.bytesmath import U, mix

ORDER = 4
BLANK, START = 32, 1
#: Documents per language that counts and calibration are made of at most, and characters worked on at a time.
SAMPLE_DOCUMENTS, BLOCK_CHARS = 1500, 1_000_000
#: Of the sample, one document in this many calibrates; a language of fewer than twice as many has none that does.
CALIBRATION_SHARE = 5
#: How sharply entropy differences turn into a score, and how far beyond all calibration texts rejection begins.
SHARPNESS, SLACK = 20.0, 1.5


def letter_table() -> np.ndarray:
    """Per code point the letter in lower case, 0 for what is no letter; letters beyond 16 bits share one code."""
    table = np.zeros(0x110000, np.uint16)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[point] = low if low <= 0xFFFF else 0xFFFD
    return table


def grams_of(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams of the texts packed into 64 bits, the text each is of, and per text whether it holds a letter.

    A text begins after three start marks and ends with a blank.
    """
    sizes = np.array([len(t) for t in texts], np.int64) + ORDER
    stream = np.frombuffer("".join(f"\x01\x01\x01{t} " for t in texts).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), sizes)
    codes = table[stream]
    letters = np.bincount(row[codes > 0], minlength=len(texts)) > 0
    codes[codes == 0] = BLANK
    begin = np.cumsum(sizes) - sizes
    for i in range(ORDER - 1):
        codes[begin + i] = START
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != BLANK) | (codes[:-1] != BLANK)
    codes, row = codes[keep].astype(np.uint64), row[keep]
    if len(codes) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), letters
    last = codes[ORDER - 1 :]
    grams = last.copy()
    for i in range(1, ORDER):
        grams |= codes[ORDER - 1 - i : len(codes) - i] << U(16 * i)
    inside = (last != START) & (row[ORDER - 1 :] == row[: len(row) - ORDER + 1])
    return grams[inside], row[ORDER - 1 :][inside], letters


def _lookup(keys: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Place of each n-gram in a sorted array of hashes, -1 if it isn't there."""
    if not len(keys):
        return np.full(len(grams), -1)
    hashes = mix(grams)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, at, -1)


@dataclass
class LanguageModel:
    """Per order from 1 to 4: sorted hashes of n-grams with log probabilities by language, and sorted hashes of
    contexts with the log weight of the next lower order by language."""

    languages: list[str]
    table: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: float
    limits: np.ndarray | None = None  # per language: mean entropy, its variance, variance per character, largest deviation

    def log_probabilities(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        mask = U((1 << 16 * order) - 1) if order < 4 else U(2**64 - 1)
        keys, rows = self.grams[order - 1]
        at = _lookup(keys, grams & mask)
        found = rows[at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            lower = grams[missing]
            below = self.log_probabilities(lower, order - 1) if order > 1 else self.unseen
            context_keys, weights = self.contexts[order - 1]
            context = _lookup(context_keys, (lower & mask) >> U(16))
            found[missing] = below + np.where(context[:, None] >= 0, weights[context], 0.0)
        return found

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text and language the mean of -log p, its variance per character; characters; whether it has letters."""
        n = len(texts)
        grams, row, letters = grams_of(texts, self.table)
        logs = -self.log_probabilities(grams)
        counts = np.bincount(row, minlength=n)
        safe = np.maximum(counts, 1)
        mean = np.stack([np.bincount(row, logs[:, l], n) / safe for l in range(len(self.languages))], 1)
        return mean, logs, counts, letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score from 0 to 1 and rejection of each text."""
        n = len(texts)
        if not self.languages or not n:
            # Nothing to judge by: only what holds no letter is rejected.
            return ["und"] * n, np.zeros(n), ~grams_of(texts, self.table)[2] if n else np.zeros(0, bool)
        mean, _, counts, letters = self.entropies(texts)
        best = mean.argmin(1)
        least = mean[np.arange(n), best]
        score = np.where(letters, 1 / np.exp((least[:, None] - mean) * SHARPNESS).sum(1), 0.0)
        rejected = ~letters
        if self.limits is not None:
            center, between, within, most = self.limits[best].T
            rejected |= (least - center) > most * np.sqrt(between + within / np.maximum(counts, 1))
        return [self.languages[b] if ok else "und" for b, ok in zip(best, letters)], score, rejected


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]], table: np.ndarray) -> LanguageModel:
    """Models of all languages from their counts of packed n-grams of the highest order."""
    languages = sorted(counts)
    alphabet = max(2, len(np.unique(np.concatenate([g & U(0xFFFF) for g, _ in counts.values()]))) + 1)
    tables: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER)]
    for name in languages:
        grams, times = counts[name]
        for order in range(ORDER, 0, -1):
            tables[order - 1].append((grams, times.astype(np.float64)))
            # A lower order counts the different n-grams that end so.
            grams, times = np.unique(grams & U((1 << 16 * (order - 1)) - 1), return_counts=True)
    model = LanguageModel(languages, table, [], [], -float(np.log(alphabet)))
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([g for g, _ in tables[order - 1]]))
        contexts = np.unique(union >> U(16))
        logs = np.zeros((len(union), len(languages)), np.float32)
        weights = np.zeros((len(contexts), len(languages)), np.float32)
        below = model.log_probabilities(union, order - 1) if order > 1 else np.full((len(union), len(languages)), model.unseen)
        place = np.searchsorted(contexts, union >> U(16))
        for l, (grams, times) in enumerate(tables[order - 1]):
            once, twice = (times == 1).sum(), (times == 2).sum()
            discount = float(np.clip(once / max(1, once + 2 * twice), 0.1, 0.95))
            own = np.searchsorted(contexts, grams >> U(16))
            total = np.bincount(own, times, len(contexts))
            kinds = np.bincount(own, minlength=len(contexts))
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            seen = np.zeros(len(union))
            seen[np.searchsorted(union, grams)] = times - discount
            share = seen / np.maximum(total[place], 1) + weight[place] * np.exp(below[:, l].astype(np.float64))
            logs[:, l] = np.log(share)
            weights[:, l] = np.log(weight)
        for target, values, rows in ((model.grams, union, logs), (model.contexts, contexts, weights)):
            hashes = mix(values)
            order_ = np.argsort(hashes)
            target.append((hashes[order_], rows[order_]))
    return model


def calibrate(model: LanguageModel, texts: dict[str, list[str]]) -> None:
    """Limits of rejection from labelled texts that are not in the counts: how far the entropy of a text in its own
    language strays from that language's mean, in deviations that shrink with the text's length."""
    limits = np.full((len(model.languages), 4), np.inf)
    for l, name in enumerate(model.languages):
        own = [t for t in texts.get(name, [])]
        if not own:
            limits[l] = (0.0, 1.0, 1.0, np.inf)
            continue
        mean, logs, counts, letters = model.entropies(own)
        ok = letters & (counts > 0)
        if not ok.any():
            limits[l] = (0.0, 1.0, 1.0, np.inf)
            continue
        own_mean = mean[ok, l]
        center = float(np.median(own_mean))
        between, within = float(own_mean.var()) + 1e-4, float(logs[:, l].var()) + 1e-4
        strays = (own_mean - center) / np.sqrt(between + within / counts[ok])
        limits[l] = (center, between, within, max(3.0, float(strays.max())) * SLACK)
    model.limits = limits


def held_out() -> Column:
    """Documents that nothing is learned from; a null doc_id is one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``lang, text, calibrates`` of at most ``per_language`` whole documents a language, those of the least hash.

    Ranks are cut before the shuffle, so a language of any size sends ``per_language`` ids from a task.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    known = docs.where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    chosen = known.select("doc_id", "lang").withColumn("_rank", rank).where(F.col("_rank") <= per_language).select("doc_id").distinct()
    return (
        known.join(F.broadcast(chosen), "doc_id")  # at most per_language ids a language
        .select("lang", "text", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CALIBRATION_SHARE)) == 0).alias("calibrates"))
    )


def learn(docs: DataFrame, per_language: int = SAMPLE_DOCUMENTS) -> LanguageModel:
    """The models of all non-null ``lang`` values of documents that are not held out. A language of few such documents
    is counted in full and rejects nothing.

    Counts are made and summed on the executors; what reaches the driver is the n-grams of the bounded sample, and
    its calibration texts.
    """
    table = letter_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for name in np.unique(names.astype(str)):
                grams, _, _ = grams_of([t for t, n in zip(texts, names) if n == name], table)
                kinds, times = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(kinds), pa.string()), pa.array(kinds.view(np.int64)), pa.array(times)],
                    names=["lang", "gram", "n"],
                )

    chosen = sample(docs, per_language).cache()
    try:
        small = [r.lang for r in (
            chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("calibrates")).alias("counted"))
            .where((F.col("n") < 2 * CALIBRATION_SHARE) | (F.col("counted") == 0)).select("lang").collect()
        )]
        calibrates = F.col("calibrates") & ~F.array_contains(F.array(*map(F.lit, small)).cast("array<string>"), F.col("lang"))
        counted = (
            chosen.where(~calibrates).select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
        )
        texts: dict[str, list[str]] = {}
        for row in chosen.where(calibrates).select("lang", "text").toLocalIterator():
            texts.setdefault(row.lang, []).append(row.text)
    finally:
        chosen.unpersist()
    counts = {}
    for name, part in counted.groupby("lang"):
        grams = part["gram"].to_numpy().view(np.uint64)
        order = np.argsort(grams)
        counts[name] = (grams[order], part["n"].to_numpy()[order])
    if not counts:
        return LanguageModel([], table, [], [], 0.0)
    model = kneser_ney(counts, table)
    calibrate(model, texts)
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs`` (but those added) with ``lang_pred``, ``score`` and ``rejected``; only ``text`` is used.

    A null text or one without letters is "und", scores 0 and is rejected. Equal texts get equal results; the first
    language by name wins a tie. Without any learned language all texts are "und", and those with letters are not
    rejected.
    """
    added = ["lang_pred", "score", "rejected"]
    rest = [c for c in docs.columns if c not in added]
    # A few MB: the sample's n-grams. By value with its class, as the workers need not have the package.
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(shared.value)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            cuts = np.flatnonzero(np.diff(ends // BLOCK_CHARS)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
                names, score, rejected = own.predict(texts[lo:hi])
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in rest], pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                    names=[*rest, *added],
                )

    columns = [F.col(f"`{c}`") for c in rest]
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("_text")).mapInArrow(work, schema)
