"""Language-model scoring with a hidden Markov model trained by Baum-Welch.

Tokens are lower-cased words between ASCII blanks, and one end per text. A token belongs to a class: the end to class 0, a word to one of
``CLASSES`` by its hash. The model draws a chain of ``STATES`` latent states, each state draws a class, and the class
draws the token by its smoothed count, ``(c + 0.5) / (N of class + 0.5 * (V of class + 1))``. So the model's size is fixed,
while counts of single words stay in a table that only Spark joins.

1. *Counts* of all tokens of the training rows: counted per task, then summed per token.
2. *Baum-Welch*: every pass runs the scaled forward and backward recursions over all training rows; each task sums its expected
   counts, Spark adds them up, and the driver gets one row per class. The first pass starts from the counts of all
   classes with seeded noise, which breaks the symmetry of the states; nothing comes from a sample.
3. *Scoring*: the scaled forward recursion gives the exact likelihood of the classes; the counts give the rest. A text needs the counts of its
   own words only: texts are dealt into blocks of about ``BLOCK_BYTES``, the distinct words of a block are joined to the count
   table, and a block's texts meet their counts in a cogroup. Nothing that grows with the vocabulary is broadcast.

Nulls and edges: a null or empty text is the end alone; a null id is dealt like others; rows are scored one by one, so repeats get equal scores; without training
rows all tokens are unknown and the model is uniform. Only the named columns are read.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import batches_of, blank_words, utf8
from carelake.plans.session import written

STATES = 6
CLASSES = 4096
PASSES = 2
START_NOISE, START_STAY = 0.5, 0.995
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 6 << 20
TOKENS = 400_000
END = b" "  # no word holds a blank
SMOOTHING = 0.01


@dataclass(frozen=True)
class Chain:
    """Start, transition and emission probabilities; emissions have a row per class."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class WordClasses(dict):
    """Class of a word, by its hash; remembered up to ``LIMIT`` words."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) % CLASSES + 1
        return value

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.clear()


def classes_of(words: list[bytes], classes: WordClasses) -> np.ndarray:
    """Class of each word, and of the end."""
    found = np.zeros(len(words) + 1, np.int32)
    found[:-1] = np.fromiter(map(classes.__getitem__, words), np.int32, len(words))
    return found


@dataclass
class Table:
    """Sequences side by side, longest first: step t of all sequences that have one stands together."""

    tokens: np.ndarray
    steps: np.ndarray  # where each step begins
    order: np.ndarray

    @staticmethod
    def of(sequences: list[np.ndarray]) -> Table:
        sizes = np.array([len(s) for s in sequences])
        order = np.argsort(-sizes, kind="stable")
        flat, sizes = np.concatenate([sequences[i] for i in order]), sizes[order]
        step = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        steps = np.concatenate([[0], np.cumsum(np.bincount(step))])
        tokens = np.empty_like(flat)
        tokens[steps[step] + np.repeat(np.arange(len(sizes)), sizes)] = flat  # longer ones stand before at every step
        return Table(tokens, steps, order)


def forward(chain: Chain, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Scaled state probabilities after each token, and the scales; their logarithms sum to the likelihood."""
    alpha, scales = chain.emit[table.tokens], np.empty(len(table.tokens))
    steps = table.steps.tolist()
    for t in range(len(steps) - 1):
        a, b = steps[t], steps[t + 1]
        rows = alpha[a:b]
        if t:
            before = steps[t - 1]
            rows *= alpha[before : before + b - a] @ chain.move
        else:
            rows *= chain.start
        scale = rows.sum(axis=1)
        rows /= scale[:, None]
        scales[a:b] = scale
    return alpha, scales


def likelihoods(chain: Chain, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each sequence of classes."""
    found = np.empty(len(sequences))
    by_size = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    for a, b in batches_of((len(sequences[i]) for i in by_size), TOKENS):
        own = by_size[a:b]
        table = Table.of([sequences[i] for i in own])
        logs = np.log10(forward(chain, table)[1])
        total, steps = np.zeros(len(own)), table.steps.tolist()
        for t in range(len(steps) - 1):
            total[: steps[t + 1] - steps[t]] += logs[steps[t] : steps[t + 1]]
        found[np.array(own)[table.order]] = total
    return found


@dataclass
class Expected:
    """Expected counts of starts, moves and emissions."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def none() -> Expected:
        return Expected(np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES + 1, STATES)))

    def add(self, chain: Chain, table: Table) -> None:
        alpha, scales = forward(chain, table)
        steps = table.steps.tolist()
        beta = np.ones((steps[1] - steps[0], STATES))
        gamma = alpha  # becomes alpha * beta, from the end
        for t in range(len(steps) - 2, 0, -1):
            a, b = steps[t], steps[t + 1]
            before = steps[t - 1]
            now = beta[: b - a]
            ahead = chain.emit[table.tokens[a:b]] * now / scales[a:b, None]
            self.move += chain.move * (alpha[before : before + b - a].T @ ahead)
            gamma[a:b] *= now
            # Sequences that ended before this step keep their ones.
            beta[: b - a] = ahead @ chain.move.T
        gamma[: steps[1]] *= beta
        self.start += gamma[: steps[1]].sum(axis=0)
        for s in range(STATES):
            self.emit[:, s] += np.bincount(table.tokens, weights=gamma[:, s], minlength=CLASSES + 1)

    def model(self) -> Chain:
        start, move = self.start + SMOOTHING, self.move + SMOOTHING
        usual = self.emit.sum(axis=1, keepdims=True) + SMOOTHING
        emit = self.emit + SMOOTHING * STATES * usual / usual.mean() + 1e-6  # towards the class's share in all states
        return Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def expectation(chain: Chain, sequences: list[np.ndarray], total: Expected) -> None:
    sequences = sorted(sequences, key=lambda s: -len(s))
    for a, b in batches_of(map(len, sequences), TOKENS):
        total.add(chain, Table.of(sequences[a:b]))


def first_chain(class_tokens: np.ndarray, seed: int = 5) -> Chain:
    """The share of each class among all training tokens, a little different in each state, so that the first pass can tell them apart.

    States that last long let it sort the texts by kind first; how long they last is learned.
    """
    random = np.random.default_rng(seed)
    noisy = (class_tokens[:, None] + 0.1) * random.lognormal(0, START_NOISE, (CLASSES + 1, STATES))
    move = np.full((STATES, STATES), (1 - START_STAY) / STATES) + START_STAY * np.eye(STATES)
    return Chain(np.full(STATES, 1 / STATES), move, noisy / noisy.sum(axis=0))


def sequences_of(texts: list[bytes], classes: WordClasses) -> list[np.ndarray]:
    found = [classes_of(blank_words(text), classes) for text in texts]
    classes.trim()
    return found


def expected_rows(batches: Iterator[pa.RecordBatch], chain: Chain) -> Iterator[pa.RecordBatch]:
    """Expected counts of a task's texts, one row per class (and per state, and one for the starts)."""
    classes, total, any_rows = WordClasses(), Expected.none(), False
    for batch in batches:
        any_rows = any_rows or batch.num_rows > 0
        texts = batch.column(0).to_pylist()
        for a, b in batches_of(map(len, texts), 24 << 20):
            expectation(chain, sequences_of(texts[a:b], classes), total)
    if any_rows:
        values = np.concatenate([total.start[None], total.move, total.emit])
        used = np.flatnonzero(values.sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(list(values[used]), pa.list_(pa.float64()))], names=["place", "counts"]
        )


def trained(train: DataFrame, text: str, passes: int, class_tokens: np.ndarray) -> Chain:
    """A model of all training rows; ``class_tokens`` are their tokens by class."""
    rows = train.select(utf8(text).alias("text"))
    chain = first_chain(class_tokens)
    for _ in range(passes):
        parts = rows.mapInArrow(lambda it, chain=chain: expected_rows(it, chain), "place long, counts array<double>")
        sums = [F.sum(F.col("counts")[s]).alias(f"s{s}") for s in range(STATES)]
        added = np.zeros((1 + STATES + CLASSES + 1, STATES))
        for row in parts.groupBy("place").agg(*sums).collect():  # one row per class
            added[row["place"]] = [row[f"s{s}"] for s in range(STATES)]
        chain = Expected(added[0], added[1 : 1 + STATES], added[1 + STATES :]).model()
    return chain


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of a batch with their counts and classes."""
    classes = WordClasses()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in batches_of(map(len, texts), 24 << 20):
            tally: Counter[bytes] = Counter()
            for text in texts[a:b]:
                tally.update(blank_words(text))
            words = list(tally)
            places = classes_of(words, classes)[:-1]
            classes.trim()
            yield pa.RecordBatch.from_arrays(
                [pa.array([*words, END], pa.binary()), pa.array([*places.tolist(), 0], pa.int32()),
                 pa.array([*tally.values(), b - a], pa.int64())],
                names=["token", "class", "n"],
            )


def distinct_words(block: pa.Table) -> pa.Table:
    words: set[bytes] = set()
    for text in block.column("text").to_pylist():
        words.update(blank_words(text))
    tokens = pa.array(list(words), pa.binary())
    return pa.table({"block": pa.array([block.column("block")[0].as_py()] * len(tokens), pa.int64()), "token": tokens})


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


@dataclass(frozen=True)
class Totals:
    """N and V of all training tokens, and of each class."""

    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray


class Counts(dict):
    """Counts by word; 0 for others."""

    def __missing__(self, word: bytes) -> int:
        return 0


def scored_block(texts: pa.Table, words: pa.Table, chain: Chain, totals: Totals, end_count: int) -> pa.Table:
    """The scores of a block's texts. Words of a slice are numbered, so that what belongs to a word is looked up and computed once."""
    counts = Counts(zip(words.column("token").to_pylist(), words.column("n").to_pylist(), strict=True))
    classes, sequences, sizes, known, base, inside = WordClasses(), [], [], [], [], []
    whole = math.log10(totals.tokens + 0.5 * (totals.distinct + 1))
    in_class = np.log10(totals.class_tokens + 0.5 * (totals.class_distinct + 1))
    end = math.log10(end_count + 0.5) - whole
    rows = texts.column("text").to_pylist()
    for first, last in batches_of(map(len, rows), SLICE_BYTES):
        split = [blank_words(text) for text in rows[first:last]]
        numbered = pa.array(itertools.chain.from_iterable(split), pa.binary()).dictionary_encode()
        distinct, place = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        own = np.fromiter(map(counts.__getitem__, distinct), np.int64, len(distinct))
        of_class = classes_of(distinct, classes)[:-1]
        classes.trim()
        logs = np.log10(own + 0.5)
        seen, terms, within = (own > 0)[place], (logs - whole)[place], (logs - in_class[of_class])[place]
        cuts = np.cumsum([0, *map(len, split)]).tolist()
        for a, b in zip(cuts, cuts[1:]):
            sequences.append(np.append(of_class[place[a:b]], np.int32(0)))
            sizes.append(b - a + 1)
            known.append(int(np.count_nonzero(seen[a:b])) + (end_count > 0))
            base.append(float(terms[a:b].sum() + end))  # no term is above 0
            inside.append(float(within[a:b].sum()))
    scores = likelihoods(chain, sequences) + np.array(inside) if sequences else np.empty(0)
    return pa.table({
        "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array(sizes, pa.int64()),
        "n_known": pa.array(known, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64()),
    })


def scored(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", passes: int = PASSES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigram) and score (the model), both log10.

    The model learns from the rows for which ``held_out`` is false.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), utf8(text).alias("text"))
    train = rows.where(~F.col("held_out"))
    counts = train.select("text").mapInArrow(counted, "token binary, class int, n long")
    counts = written(counts.groupBy("token").agg(F.first("class").alias("class"), F.sum("n").alias("n")), "token-counts")
    per_class = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    class_tokens, class_distinct = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for row in per_class:  # one row per class
        class_tokens[row["class"]], class_distinct[row["class"]] = row["n"], row["v"]
    totals = Totals(int(class_tokens.sum()), int(class_distinct.sum()), class_tokens, class_distinct)
    end_count = int(class_tokens[0])
    chain = trained(train, "text", passes, class_tokens)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition("block")
    words = dealt.groupBy("block").applyInArrow(distinct_words, "block long, token binary")
    known = words.join(counts.select("token", "n"), "token").select("block", "token", "n")
    found = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        lambda texts, words: scored_block(texts, words, chain, totals, end_count), SCORES
    )
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
