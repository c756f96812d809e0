"""Language identification: averaged hashed subword embeddings with a linear softmax, and a calibrated rejection.

Features are the byte n-grams (``GRAMS`` long) of ASCII-lower-cased text in which every other ASCII character counts as a blank; n-grams with a blank
inside are left out, so they are pieces of words with their edges. An n-gram is hashed to one of ``BUCKETS`` embeddings, a text is
the average of its embeddings, and a linear softmax gives one probability per learned language. As both steps are linear, a
fitted model is one table of ``BUCKETS`` rows and a column per language; whole texts are scored against it in blocks of bounded size.

Fitting: at most ``rows_per_language`` rows of each language and ``sample_rows`` rows in all, the first in the order of a hash, so
that reruns agree. Each text is cut whole into pieces of doubling length, which teaches short texts too. Stochastic gradient
descent runs in numpy, in one task, on three quarters of these rows. The last quarter calibrates: it sets the temperature that
makes probabilities agree with how often they are right. A prediction whose calibrated probability is below ``least`` is rejected; at
the default of one half these are the texts whose prediction is more likely wrong than right.

Nulls and edges: a null text and one without a letter are ``und`` with score 0, and rejected; rows without language teach nothing; where there is
nothing to learn from, every text is ``und``. Ties go to the language first in code point order. Rows are judged one by one, so repeats get equal
answers. Other columns pass unread; ``predicted`` replaces a column of the result's name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import batches_of, kept, utf8

UNKNOWN = "und"
GRAMS = (2, 3, 4)
BUCKETS = 1 << 16
BLOCK = 1 << 20
ROWS_PER_LANGUAGE = 400
SAMPLE_ROWS = 4000
LEAST = 0.5

# Upper case to lower case; all other ASCII but letters becomes a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def subwords(data: np.ndarray, count: int) -> np.ndarray:
    """Bucket + 1 of every n-gram that starts in the first ``count`` bytes, one row per length; 0 where there is none."""
    blank = data == 32
    wide = data.astype(np.uint32)
    packed, inside = wide, np.zeros(len(data), bool)
    found = np.zeros((len(GRAMS), count), np.int32)
    for n in range(2, max(GRAMS) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        packed = packed[:size] | (wide[n - 1 :] << np.uint32(8 * (n - 1)))
        if n == 2:
            inside = blank[:size] & blank[1:]
        else:
            inside = (inside[:size] if n > 3 else np.zeros(size, bool)) | blank[n - 2 : n - 2 + size]
        if n in GRAMS:
            bucket = ((packed ^ np.uint32(n * 0x01000193)) * np.uint32(0x9E3779B1)) >> np.uint32(16)
            size = min(size, count)
            found[GRAMS.index(n), :size] = np.where(inside[:size], 0, bucket[:size].astype(np.int32) + 1)
    return found


def buffered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another, set apart by blanks, and where each begins."""
    parts = [b" " + t.translate(LETTERS) + b"   " for t in texts]
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    return np.frombuffer(b"".join(parts), np.uint8), starts


def sums(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Sum of the table's rows over the subwords of each text; row 0 of the table is zero."""
    data, starts = buffered(texts)
    total = np.zeros((len(texts), table.shape[1]))
    for at in range(0, len(data), BLOCK):
        count = min(BLOCK, len(data) - at)
        ids = subwords(data[at : at + BLOCK + max(GRAMS) - 1], count)
        values = table[ids[0]]
        for row in ids[1:]:
            values += table[row]
        first, last = np.searchsorted(starts, [at, at + count - 1], "right") - 1
        own = np.maximum(starts[first : last + 1] - at, 0)
        total[first : last + 1] += np.add.reduceat(values, own, axis=0, dtype=np.float64)
    return total


@dataclass(frozen=True)
class LanguageModel:
    """``table``: per bucket the part of each language's logit, and a last column that counts subwords."""

    languages: list[str]
    table: np.ndarray
    temperature: float
    least: float

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        total = sums(texts, self.table)
        logits = total[:, :-1] / np.maximum(total[:, -1:], 1) / self.temperature
        return softmax(logits)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


PIECES = "lang string, calibrate boolean, ids binary, counts binary"
BAG = pa.schema([("lang", pa.string()), ("calibrate", pa.bool_()), ("ids", pa.binary()), ("counts", pa.binary())])


def pieces(text: bytes) -> list[bytes]:
    """A whole text cut into pieces of 32, 64, 128 ... bytes, each to the end of a word."""
    found, start, size = [], 0, 32
    while start < len(text):
        end = text.find(b" ", min(len(text), start + size))
        end = len(text) if end < 0 else end
        found.append(text[start:end])
        start, size = end, size * 2
    return found


def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct subwords of each piece of each text, with counts."""
    kept("language")
    for batch in batches:
        out: dict[str, list] = {"lang": [], "calibrate": [], "ids": [], "counts": []}
        for lang, calibrate, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for piece in pieces(text):
                tally = np.zeros(BUCKETS + 1, np.int64)
                data, _ = buffered([piece])
                for at in range(0, len(data), BLOCK):
                    count = min(BLOCK, len(data) - at)
                    tally += np.bincount(
                        subwords(data[at : at + BLOCK + max(GRAMS) - 1], count).ravel(), minlength=BUCKETS + 1
                    )
                tally[0] = 0
                ids = np.flatnonzero(tally)
                if len(ids):
                    out["lang"].append(lang)
                    out["calibrate"].append(calibrate)
                    out["ids"].append((ids - 1).astype("<u2").tobytes())
                    out["counts"].append(tally[ids].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["lang"], pa.string()), pa.array(out["calibrate"], pa.bool_()),
             pa.array(out["ids"], pa.binary()), pa.array(out["counts"], pa.binary())],
            names=list(out),
        )


def sampled(docs: DataFrame, text: str, lang: str, rows_per_language: int, sample_rows: int) -> DataFrame:
    """The bounded sample of distinct labelled texts: rank by rank over the languages, so that a frequent language does not fill it.

    Ranks are given to hashes of texts; the texts themselves are fetched for the chosen hashes only.
    """
    order = F.xxhash64(F.lit("sample"), F.col(text), F.col(lang))
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), order.alias("order")
    )
    ranked = rows.select("lang", "order").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
    chosen = ranked.where(F.col("rank") <= rows_per_language).orderBy("rank", "lang").limit(sample_rows).select("lang", "order")
    taken = rows.join(F.broadcast(chosen), ["lang", "order"], "left_semi")  # at most sample_rows hashes
    texts = taken.groupBy("lang", "order").agg(F.min("text").alias("text"))
    return texts.select("lang", (F.pmod(F.col("order"), F.lit(4)) == 3).alias("calibrate"), utf8("text").alias("text"))


def descend(
    ids: np.ndarray, weights: np.ndarray, starts: np.ndarray, target: np.ndarray, languages: int,
    dim: int = 16, epochs: int = 5, rate: float = 0.5, batch: int = 32, seed: int = 7,
) -> np.ndarray:
    """Stochastic gradient descent on the softmax loss; gives the buckets' logits."""
    random = np.random.default_rng(seed)
    embedding = random.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    output = np.zeros((dim, languages), np.float32)
    ends = np.append(starts[1:], len(ids))
    steps, done = epochs * (len(target) + batch - 1) // batch, 0
    for _ in range(epochs):
        order = random.permutation(len(target))
        for at in range(0, len(order), batch):
            picked = order[at : at + batch]
            spans = [np.arange(starts[i], ends[i]) for i in picked]
            sizes = [len(s) for s in spans]
            spots = np.concatenate(spans)
            owner = np.repeat(np.arange(len(picked)), sizes)
            cuts = np.cumsum([0, *sizes])[:-1]
            rows, share = ids[spots].astype(np.int64), weights[spots, None]
            hidden = np.add.reduceat(embedding[rows] * share, cuts, axis=0)
            error = softmax(hidden @ output).astype(np.float32)
            error[np.arange(len(picked)), target[picked]] -= 1
            step = rate * max(0.05, 1 - done / max(1, steps))
            back = error @ output.T
            output -= step * (hidden.T @ error) / len(picked)
            # An average moves its parts as one: each takes the whole step, as rare subwords are met seldom.
            np.add.at(embedding, rows, -step * back[owner] * np.minimum(1, share * 50))
            done += 1
    return embedding @ output


def calibration(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature of least log loss on rows that the descent has not seen."""
    if not len(target):
        return 1.0
    places = np.arange(len(target))

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(softmax(logits / t)[places, target], 1e-12)).mean())

    return min((float(t) for t in np.geomspace(0.1, 10, 41)), key=loss)


MODEL = "languages array<string>, logits binary, temperature double"


def learned(batches: Iterator[pa.RecordBatch], **descent) -> Iterator[pa.RecordBatch]:
    """The model of a whole sample, as one row."""
    sample = pa.Table.from_batches(list(batches), schema=BAG)
    labels = sample.column("lang").to_pylist()
    languages = sorted(set(labels), key=lambda x: x.encode())
    logits, temperature = np.zeros((BUCKETS, len(languages)), np.float32), 1.0
    if languages:
        ids = [np.frombuffer(x.as_buffer(), "<u2") for x in sample.column("ids")]  # views, not copies
        counts = [np.frombuffer(x.as_buffer(), "<f4") for x in sample.column("counts")]
        target = np.array([languages.index(x) for x in labels])
        held = np.array(sample.column("calibrate").to_pylist(), bool)
        if held.all():
            held[:] = False
        # The rows come in no fixed order; the descent needs one.
        order = sorted(range(len(ids)), key=lambda i: (labels[i].encode(), len(ids[i]), zlib.crc32(ids[i]), zlib.crc32(counts[i])))
        train, test = [i for i in order if not held[i]], [i for i in order if held[i]]
        flat, weights = np.concatenate([ids[i] for i in train]), np.concatenate([counts[i] for i in train])
        sizes = np.array([len(ids[i]) for i in train])
        starts = np.cumsum(sizes) - sizes
        weights /= np.repeat(np.add.reduceat(weights, starts), sizes)
        logits = descend(flat, weights, starts, target[train], len(languages), **descent)
        known = np.array([(logits[ids[i].astype(np.int64)] * counts[i][:, None]).sum(0) / counts[i].sum() for i in test])
        temperature = calibration(known.reshape(len(test), len(languages)), target[test])
    yield pa.RecordBatch.from_arrays(
        [pa.array([languages], pa.list_(pa.string())), pa.array([logits.astype("<f4").tobytes()], pa.binary()), pa.array([temperature])],
        names=["languages", "logits", "temperature"],
    )


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS, least: float = LEAST, **descent,
) -> LanguageModel:
    """Learn from the labelled rows of ``docs``. One task descends over the bounded sample; the driver gets the model alone."""
    sample = sampled(docs, text, lang, rows_per_language, sample_rows).mapInArrow(bags, PIECES)
    rows = sample.repartition(1).mapInArrow(lambda it: learned(it, **descent), MODEL).collect()
    row = next((r for r in rows if r["languages"]), None)
    if row is None:
        return LanguageModel([], np.zeros((BUCKETS + 1, 1), np.float32), 1.0, least)
    table = np.zeros((BUCKETS + 1, len(row["languages"]) + 1), np.float32)
    table[1:, :-1] = np.frombuffer(row["logits"], "<f4").reshape(BUCKETS, -1)
    table[1:, -1] = 1
    return LanguageModel(row["languages"], table, row["temperature"], least)


RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def predicted(docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct column ``name``: lang_pred, score (calibrated probability) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, one number per language

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept("language")
        own = shared.value
        for column in columns:
            texts = column.to_pylist()
            lettered = [i for i, t in enumerate(texts) if t is not None]
            names, scores, bad = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            for a, b in batches_of((len(texts[i]) for i in lettered), BLOCK) if own.languages else ():
                chosen = lettered[a:b]
                p = own.probabilities([texts[i] for i in chosen])
                best = p.argmax(axis=1)
                scores[chosen] = p[np.arange(len(chosen)), best]
                bad[chosen] = scores[chosen] < own.least
                for i, k in zip(chosen, best.tolist(), strict=True):
                    names[i] = own.languages[k]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores), pa.array(bad)], fields=list(RESULT)
            )

    return docs.withColumn(name, judge(lettered_bytes(F.col(text))))


def lettered_bytes(text: Column) -> Column:
    """The text as bytes; null where it has no letter."""
    return F.when(text.rlike(r"\p{L}"), text.cast("binary"))
