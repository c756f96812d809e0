"""Line dedup by an exact set-similarity join.

A line is a set of lower-cased words; two lines match at a Jaccard similarity of ``part / whole`` or more. A line is removed if it matches
an earlier line, in the order of (doc_id, text, place); what is earlier may itself be removed. So of each class of lines with equal
sets only the first can stay, and it stays unless its class matches a class whose first line is earlier.

1. *Rarity.* Words are counted over all rows, in ``COUNTERS`` hashed counters. A word's key holds its counter's
   magnitude above its hash, so sorting keys puts rare words first, in one order for all lines.
2. *Prefix.* Two matching sets share a word among the first ``n - ceil(t n) + 1`` of each. Those go to the join with the set's size, the word's
   place and a 128-bit parity of the set.
3. *Join.* Entries are dealt by word and sorted by size. Within a word, a pair is kept if its sizes allow a match (length filter), if
   enough words may follow its places (positional filter), and if its parities differ in no more bits than matching sets can.
   Only partners that may be earlier can remove a set (those whose first line has no larger doc_id): each set passes on its
   ``PARTNERS`` closest of these, and a mark if there were more.
4. *Verification* of the distinct pairs on the full sets. A set that is marked and not yet removed goes through the join once more without that limit,
   so nothing is lost; the limit only saves a set with thousands of variants from meeting each of them. That second join is sent the entries of
   the open sets' words only, by a bitmap of words.

Nulls and edges: a null or empty text has no lines; a line without words is kept and matches nothing; null doc_ids come first; rows that repeat a
doc_id are separate, in the order of a hash of their texts, and rows that repeat both share one answer; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import batches_of, mixed, span_hashes, utf8, word_spans
from carelake.plans.session import discard, free_shuffles, small_batches, written, written_at

COUNTERS, BLOCK = 1 << 18, 1 << 12
PART, WHOLE = 80, 100
PARTNERS = 8
ENTRY_ROWS = 1 << 16  # at once to Python, which goes through a word's entries step by step whatever their number
SLICE_BYTES = 6 << 20
TEXT_ROWS = 4096
RANK_BITS, HASH_BITS = 6, 40
SIZE_BITS = 17  # beside a word's key in a number that entries are sorted by; larger sets are in no order


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a task by counter."""
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for first, last in batches_of(map(len, texts), SLICE_BYTES):
            text = b"\n".join(texts[first:last]).lower()
            values = span_hashes(text, *word_spans(np.frombuffer(text, np.uint8)))
            total += np.bincount((values % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    yield blocks_of(dict(enumerate(total.reshape(-1, BLOCK))))


def blocks_of(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.int64()))], names=["block", "n"]
    )


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of the same block added up."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, n in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums[block] = sums.get(block, 0) + n.values.to_numpy()
    yield blocks_of(sums)


def ranks(rows: DataFrame) -> np.ndarray:
    """Magnitude of each counter, 0 for the rarest words. The table has a fixed size."""
    schema = "block long, n array<bigint>"
    found = rows.select("text").mapInArrow(counted, schema).repartition("block").mapInArrow(summed, schema).toArrow()
    total = np.zeros((COUNTERS // BLOCK, BLOCK))
    for block, n in zip(found.column("block").to_pylist(), found.column("n"), strict=True):
        total[block] = n.values.to_numpy()
    total = total.reshape(-1)
    return np.minimum(2 * np.log2(total + 1), (1 << RANK_BITS) - 1).astype(np.uint64)


def line_sets(
    texts: list[bytes], rank: np.ndarray, chosen: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """Per slice of texts: text number, line number, and the line's sorted word keys as (keys, starts, sizes).

    ``chosen`` tells from text and line numbers which lines are taken; lines without words never are.
    """
    for first, last in batches_of(map(len, texts), SLICE_BYTES):
        text = b"\n".join(texts[first:last]).lower()
        raw = np.frombuffer(text, np.uint8)
        begins, ends = word_spans(raw)
        words = np.diff(np.searchsorted(begins, np.flatnonzero(raw == 10)), prepend=0, append=len(begins))  # of each line
        in_text = np.array([t.count(b"\n") + 1 for t in texts[first:last]])
        owners = np.repeat(np.arange(first, last), in_text)
        places = np.arange(len(owners)) - np.repeat(np.cumsum(in_text) - in_text, in_text)
        held = words > 0
        if chosen:
            held &= chosen(owners, places)
            of_held = np.repeat(held, words)
            begins, ends = begins[of_held], ends[of_held]
        owners, places, sizes = owners[held], places[held], words[held]
        if not len(sizes):
            continue
        values = span_hashes(text, begins, ends)
        key = (rank[(values % np.uint64(COUNTERS)).astype(np.int64)] << np.uint64(HASH_BITS)) | (mixed(values) >> np.uint64(64 - HASH_BITS))
        line = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
        if len(sizes) < 1 << (64 - RANK_BITS - HASH_BITS):  # line and key fit one number
            both = np.sort((line << np.uint64(RANK_BITS + HASH_BITS)) | key)
            line, key = both >> np.uint64(RANK_BITS + HASH_BITS), both & np.uint64((1 << (RANK_BITS + HASH_BITS)) - 1)
        else:
            order = np.lexsort((key, line))
            key, line = key[order], line[order]
        own = np.ones(len(key), bool)
        own[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
        key, line = key[own], line[own]
        starts = np.searchsorted(line, np.arange(len(sizes), dtype=np.uint64))
        yield owners, places, key, starts, np.diff(np.append(starts, len(key)))


def needed(sizes: np.ndarray, part: int, whole: int) -> np.ndarray:
    """Words in the prefix of a set."""
    return sizes - -(-part * sizes // whole) + 1


LINES = (
    "doc_id long, text_key long, line int, set_key long, n int, prefix array<bigint>, parity1 long, parity2 long"
)


def line_rows(batches: Iterator[pa.RecordBatch], rank: np.ndarray, part: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Every line with its set; the prefix of a set stands once in a slice."""
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for owners, places, key, starts, sizes in line_sets(texts, rank):
            spread = mixed(key)
            set_key = mixed(np.add.reduceat(spread, starts) ^ sizes.astype(np.uint64)).view(np.int64)
            bit = np.uint64(1) << (spread & np.uint64(63))
            low = np.where(spread & np.uint64(64), np.uint64(0), bit)
            parity = [np.bitwise_xor.reduceat(x, starts).view(np.int64) for x in (low, bit ^ low)]
            take = needed(sizes, part, whole)
            take[np.setdiff1d(np.arange(len(sizes)), np.unique(set_key, return_index=True)[1])] = 0
            within = np.arange(len(key)) - np.repeat(starts, sizes)
            prefix = key[within < np.repeat(take, sizes)].view(np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(take)]), pa.int32())
            rows = pa.array(owners)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(places, pa.int32()), pa.array(set_key),
                 pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(prefix)), pa.array(parity[0]), pa.array(parity[1])],
                names=["doc_id", "text_key", "line", "set_key", "n", "prefix", "parity1", "parity2"],
            )


PAIRS = "u long, v long, more boolean"


def pairs_of(batches: Iterator[pa.RecordBatch], part: int, whole: int, partners: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows (at, size, set_key, parity1, parity2, doc) that come sorted by ``at``, the word and the set's size up to ``most``.

    ``size`` holds the whole size, the word's place and whether the set is asked for.

    Rows that may still meet rows of the next batch, the last word's, are carried over; a pair is made by its later row. Of its two
    sets those are passed on that are asked for and whose partner's document is no later one.
    """
    carried: list[np.ndarray] | None = None
    most = (1 << SIZE_BITS) - 1
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        old = 0 if carried is None else len(carried[0])
        columns = new if carried is None else [np.concatenate(x) for x in zip(carried, new, strict=True)]
        at, size, key, p1, p2, doc = columns
        word, n, place, asked = at >> SIZE_BITS, size >> 32, (size & 0xFFFFFFFF) >> 1, (size & 1).astype(bool)
        low = np.minimum(n, most)
        p1, p2 = p1.view(np.uint64), p2.view(np.uint64)  # bits of a signed number are those of its absolute value
        us, vs, gaps = [], [], []
        active, step = np.arange(len(word)), 0
        while len(active):
            step += 1
            active = active[active + step < len(word)]
            later = active + step
            alive = (word[active] == word[later]) & (whole * n[active] >= part * low[later])
            active, later = active[alive], later[alive]
            a, b = n[active], n[later]
            least = -(-part * (a + b) // (part + whole))  # common words that a match has
            fits = (later >= old) & (1 + np.minimum(a - place[active], b - place[later]) - 1 >= least)
            fits &= (key[active] != key[later]) & (asked[active] | asked[later])
            i, j = active[fits], later[fits]
            gap = np.bitwise_count(p1[i] ^ p1[j]).astype(np.int64) + np.bitwise_count(p2[i] ^ p2[j])
            close = gap <= n[i] + n[j] - 2 * least[fits]
            us.append(i[close])
            vs.append(j[close])
            gaps.append(gap[close])
        u, v, gap = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (us, vs, gaps))
        # Of each row the closest partners, and a mark (a pair with itself) if there were more.
        row, other, gap = np.concatenate([u, v]), np.concatenate([v, u]), np.concatenate([gap, gap])
        open_ = asked[row] & (doc[other] <= doc[row])
        row, other, gap = row[open_], other[open_], gap[open_]
        order = np.lexsort((gap, row))
        row, other = row[order], other[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        over = row[nth == partners]
        left, right = np.append(row[nth < partners], over), np.append(other[nth < partners], over)
        more = np.arange(len(left)) >= len(left) - len(over)
        yield pa.RecordBatch.from_arrays([pa.array(key[left]), pa.array(key[right]), pa.array(more)], names=["u", "v", "more"])
        last = (word == word[-1]) & (whole * n >= part * low[-1]) if len(word) else np.empty(0, bool)
        carried = [c[last] for c in columns]


ENTRIES = "word long, place long, n long, set_key long, parity1 long, parity2 long, doc long"


def entries_of(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Prefix words of the sets in rows (prefix, n, set_key, parity1, parity2, doc) that the bitmap ``wanted`` lets through."""
    for batch in batches:
        lists = batch.column(0)
        word, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        held = np.flatnonzero(wanted[word % len(wanted)])
        rest = [c.take(pa.array(row[held])) for c in batch.columns[1:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(word[held]), pa.array(place[held]), *rest],
            names=["word", "place", "n", "set_key", "parity1", "parity2", "doc"],
        )


def full_sets(
    batches: Iterator[pa.RecordBatch], rank: np.ndarray, texts: np.ndarray, wanted: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Word keys of the sets of the lines that ``wanted`` lets through, from the texts that ``texts`` lets through; each once in a slice.

    Both are bitmaps, over text keys and over ``spots`` of lines. Other lines are neither hashed nor sorted.
    """
    for batch in batches:
        keys = batch.column(1).to_numpy()
        held = texts[keys % len(texts)]
        chosen_texts, keys = batch.column(0).filter(pa.array(held)).to_pylist(), keys[held]

        def chosen(owners: np.ndarray, places: np.ndarray, keys: np.ndarray = keys) -> np.ndarray:
            return wanted[(keys[owners] ^ (places * SPREAD)) % len(wanted)]

        for _, _, key, starts, sizes in line_sets(chosen_texts, rank, chosen):
            set_key = mixed(np.add.reduceat(mixed(key), starts) ^ sizes.astype(np.uint64))
            once = np.zeros(len(sizes), bool)
            once[np.unique(set_key, return_index=True)[1]] = True
            words = key[np.repeat(once, sizes)].view(np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes[once])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_key[once].view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(words))], names=["set_key", "words"]
            )


FILTER_BITS = 1 << 20
SPREAD = 40503  # times a line's place: sets the lines of a text apart in a bitmap


def bits_of(rows: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the column's numbers, for dropping most of the others early. At most FILTER_BITS numbers reach the driver."""
    spots = rows.select(F.pmod(F.col(column), F.lit(FILTER_BITS)).alias("spot")).distinct().toArrow()
    found = np.zeros(FILTER_BITS, bool)
    found[spots.column("spot").to_numpy()] = True  # 2^64 is a multiple of FILTER_BITS, so the sign does not matter
    return found


class Matcher:
    """One run over a table: its lines and classes, and what was found to match."""

    def __init__(self, rows: DataFrame, part: int, whole: int):
        self.rows, self.part, self.whole = rows, part, whole
        with small_batches(rows.sparkSession, TEXT_ROWS, "8m"):
            self.rank = rank = ranks(rows)
            lines, folder = written_at(rows.mapInArrow(lambda it: line_rows(it, rank, part, whole), LINES), "lines-sets")
        first, copies = F.min(F.struct("doc_id", "text_key", "line")), F.count(F.lit(1))
        self.classes = written(lines.groupBy("set_key").agg(
            first.alias("first"), copies.alias("copies"), F.first("n").alias("n"), F.max_by("prefix", F.size("prefix")).alias("prefix"),
            F.first("parity1").alias("parity1"), F.first("parity2").alias("parity2"),
        ), "line-classes")
        # The classes have the prefixes now; the lines go on without them.
        self.lines = written(lines.select("doc_id", "text_key", "line", "set_key"), "lines")
        discard(rows.sparkSession, folder)
        free_shuffles(rows.sparkSession)

    def candidates(self, asked: DataFrame | None, partners: int) -> DataFrame:
        """Distinct pairs from the join on prefix words; ``asked`` limits one side to some sets."""
        doc = F.coalesce("first.doc_id", F.lit(-(1 << 63))).alias("doc")
        of_set = [F.col("n").cast("long").alias("n"), "set_key", "parity1", "parity2", doc]
        if asked is None:
            entries = self.classes.select(F.posexplode("prefix").alias("place", "word"), *of_set).withColumn("asked", F.lit(True))
        else:
            wanted = bits_of(self.classes.join(asked, "set_key", "left_semi").select(F.explode("prefix").alias("word")), "word")
            rows = self.classes.select("prefix", *of_set)
            entries = rows.mapInArrow(lambda it: entries_of(it, wanted), ENTRIES)
            entries = entries.join(asked.withColumn("asked", F.lit(True)), "set_key", "left")
            entries = entries.withColumn("asked", F.coalesce("asked", F.lit(False)))
        at = F.shiftleft("word", SIZE_BITS).bitwiseOR(F.least("n", F.lit((1 << SIZE_BITS) - 1).cast("long")))
        size = F.shiftleft("n", 32).bitwiseOR(F.shiftleft(F.col("place").cast("long"), 1)).bitwiseOR(F.col("asked").cast("long"))
        entries = entries.select(at.alias("at"), size.alias("size"), "set_key", "parity1", "parity2", "doc")
        dealt = entries.repartition(F.shiftright("at", SIZE_BITS)).sortWithinPartitions("at")
        part, whole = self.part, self.whole
        found = dealt.mapInArrow(lambda it: pairs_of(it, part, whole, partners), PAIRS)
        with small_batches(self.rows.sparkSession, ENTRY_ROWS):
            pairs = written(found.select(
                F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "more"
            ).distinct(), "line-pairs")
        del entries, dealt, found
        free_shuffles(self.rows.sparkSession)
        return pairs

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) that match on the full sets."""
        ends = pairs.select(F.explode(F.array("u", "v")).alias("set_key")).distinct()
        spot = F.col("first.text_key").bitwiseXOR(F.col("first.line").cast("long") * SPREAD).alias("spot")
        first = self.classes.select("set_key", F.col("first.text_key").alias("text_key"), spot)
        ends = written(ends.join(first, "set_key"), "line-ends")
        rank, wanted, texts = self.rank, bits_of(ends, "spot"), bits_of(ends, "text_key")
        sets = self.rows.select("text", "text_key").mapInArrow(
            lambda it: full_sets(it, rank, texts, wanted), "set_key long, words array<bigint>"
        )
        sets = sets.join(ends, "set_key", "left_semi").groupBy("set_key").agg(F.first("words").alias("words"))
        with small_batches(self.rows.sparkSession, TEXT_ROWS, "8m"):
            sets = written(sets, "line-sets")
        both = pairs.select("u", "v").distinct().join(sets.select(F.col("set_key").alias("u"), F.col("words").alias("a")), "u")
        both = both.join(sets.select(F.col("set_key").alias("v"), F.col("words").alias("b")), "v")
        common = F.size(F.array_intersect("a", "b"))
        match = self.whole * common >= self.part * (F.size("a") + F.size("b") - common)
        return written(both.where(match).select("u", "v"), "line-matches")

    def removed(self, matches: DataFrame) -> DataFrame:
        """Sets whose first line has an earlier match."""
        first = self.classes.select("set_key", "first")
        rows = matches.join(first.select(F.col("set_key").alias("u"), F.col("first").alias("at_u")), "u")
        rows = rows.join(first.select(F.col("set_key").alias("v"), F.col("first").alias("at_v")), "v")
        return rows.select(F.when(F.col("at_u") < F.col("at_v"), F.col("v")).otherwise(F.col("u")).alias("set_key")).distinct()


def repeated_lines(
    docs: DataFrame, part: int = PART, whole: int = WHOLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per line with words: doc_id, text_key (xxhash64 of the text), line (place from 0) and removed."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), utf8(text).alias("text")
    )
    run = Matcher(rows, part, whole)
    found = run.candidates(None, PARTNERS)
    gone = written(run.removed(run.verified(found.where(~F.col("more")))), "removed-sets")
    rest = found.where("more").select(F.col("u").alias("set_key")).join(gone, "set_key", "left_anti")
    rest = written(rest, "open-sets")
    if not rest.isEmpty():
        again = run.candidates(rest, 1 << 62)
        gone = gone.union(run.removed(run.verified(again))).distinct()
    first = run.classes.select("set_key", "first", "copies").join(gone.withColumn("gone", F.lit(True)), "set_key", "left")
    first = first.where("copies > 1 or gone")  # the only line of a set without a match stays
    own = F.struct("doc_id", "text_key", "line")
    removed = F.col("gone").isNotNull() | (F.col("first").isNotNull() & (own != F.col("first")))
    return run.lines.join(first, "set_key", "left").select("doc_id", "text_key", "line", removed.alias("removed"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: doc_id, n_lines (with words), n_removed and text, the whole text without the removed lines."""
    found = repeated_lines(docs, doc_id=doc_id, text=text, **options)
    gone = F.array_sort(F.collect_set(F.when(F.col("removed"), F.col("line"))))
    per_text = written(found.groupBy("doc_id", "text_key").agg(
        F.size(F.collect_set("line")).cast("long").alias("n_lines"), gone.alias("gone")
    ), "removed-lines")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    other = per_text.select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_key"), "n_lines", "gone").hint("shuffle_hash")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_key"))
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("gone", i))
    left = F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    return rows.join(other, same, "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size("gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"), left.alias("text"),
    )
