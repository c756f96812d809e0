"""Token files: ids of whole texts in id order, stored as compressed byte planes with an index.

A token file is a Parquet folder, so that tasks commit or retry like any other Spark write. One row is a segment, about
``SEGMENT_IDS`` ids of consecutive documents:

* ``part``, ``segment``: place in the file; ``before``: ids of earlier segments of the part; ``n_ids``.
* ``doc_ids``, ``lengths``: the documents and their numbers of ids, in order.
* ``index``: per block of ``BLOCK_IDS`` ids (the last may be shorter) the number of ids and the bytes of each of the four planes.
* ``payload``: the planes. A block of little-endian 32-bit ids is transposed, so that all lowest bytes stand together, then all
  second bytes and so on, and each plane is compressed with zstandard. Ids fit in few bits, so high planes shrink to nothing.

Nulls and repeats: a null text has no ids but the end id; null doc_ids come first; rows that repeat a doc_id are separate
documents, ordered by a hash of their text. An empty table gives a file without segments. Columns other than the two named are ignored.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import BLANK, batches_of, kept, utf8, word_spans

BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 19
LEVEL = 1
SLICE_BYTES = 4 << 20
MARKS = np.zeros(256, bool)  # ASCII marks without quotes, which may begin an ending, and without < and >
MARKS[list(b"!#$%&()*+,-./:;=?@[]^_{|}~")] = True
ALNUM = np.array([c < 128 and chr(c).isalnum() for c in range(256)])
MARK_RUN = 16
PLANES = 4
INDEX_TYPE = "array<struct<n:int,p0:int,p1:int,p2:int,p3:int>>"
SEGMENT_SCHEMA = (
    "part int, segment int, before long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
    f"index {INDEX_TYPE}, payload binary"
)


def to_planes(ids: np.ndarray) -> tuple[list[dict], bytes]:
    """Index entries and payload of consecutive ids."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    index, planes = [], []
    for start in range(0, len(ids), BLOCK_IDS):
        block = np.ascontiguousarray(ids[start : start + BLOCK_IDS], "<u4")
        rows = block.view(np.uint8).reshape(-1, PLANES).T
        packed = [packer.compress(np.ascontiguousarray(rows[p])) for p in range(PLANES)]
        index.append({"n": len(block), **{f"p{p}": len(x) for p, x in enumerate(packed)}})
        planes += packed
    return index, b"".join(planes)


def from_planes(index: list[dict], payload: bytes) -> np.ndarray:
    """The ids that ``to_planes`` stored."""
    opener, at, blocks = zstandard.ZstdDecompressor(), 0, []
    for entry in index:
        rows = np.empty((entry["n"], PLANES), np.uint8)
        for p in range(PLANES):
            size = entry[f"p{p}"]
            rows[:, p] = np.frombuffer(opener.decompress(payload[at : at + size]), np.uint8)
            at += size
        blocks.append(rows.reshape(-1).view("<u4"))
    return np.concatenate(blocks) if blocks else np.empty(0, "<u4")


def piece_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of a text: its words, and the ASCII marks at a word's end as a piece of their own.

    The tokenizer always cuts such marks off after an ASCII letter or digit. Words with more than ``MARK_RUN`` of them stay whole.
    """
    starts, ends = word_spans(text)
    at, rows = ends.copy(), np.flatnonzero(MARKS[text[ends - 1]])
    for _ in range(MARK_RUN):
        at[rows] -= 1
        rows = rows[at[rows] > starts[rows]]
        rows = rows[MARKS[text[at[rows] - 1]]]
    cuts = at[(at < ends) & (at > starts) & ALNUM[text[at - 1]]]
    return np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))


class WordIds(dict):
    """Ids of a blank-free piece of text as little-endian 32-bit bytes, remembered up to twice ``LIMIT``.

    The tokenizer drops white space and never joins pieces across it, so a text's ids are those of its pieces. New pieces
    of a batch are encoded together, with a special token of the vocabulary between them.
    """

    LIMIT = 350_000
    TOGETHER = 256

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[bytes, bytes] = {}
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.mark_id, self.mark = max(special)
        self.opening = {t.encode()[:2] for _, t in special}
        self.starts = {t[0] for _, t in special}
        names = self.tokenizer.get_vocab()
        self.ending = np.zeros(max(names.values()) + 1, bool)  # ids that end a word
        self.ending[[i for t, i in names.items() if t.endswith("</w>")]] = True

    def lowered(self, text: bytes) -> bytes:
        """The tokenizer lower-cases anyway; doing so first halves the pieces. Special tokens keep their case."""
        return text if any(x in text for x in self.opening) else text.lower()

    def learn(self, pieces: list[bytes]) -> None:
        new = [p for p in pieces if p not in self]
        if len(self) + len(new) > self.LIMIT:  # what was not met since the last turn is forgotten
            self.older = dict(self)
            self.clear()
            new = pieces
        unknown = []
        for piece, known in zip(new, map(self.older.get, new), strict=True):
            if known is None:
                unknown.append(piece)
            else:
                self[piece] = known
        self.encode(unknown)

    def encode(self, new: list[bytes]) -> None:
        """Learn pieces: lower-case words side by side, others with a special token between, those that may hold one alone."""
        words = [p.decode("utf-8", "replace") for p in new]
        simple, rest = [], []
        for i, word in enumerate(words):
            (simple if word.isalpha() and word.islower() else rest).append(i)
        marked = [i for i in rest if not any(c in words[i] for c in self.starts)]
        alone = [*(i for i in rest if any(c in words[i] for c in self.starts)), *self.together(new, words, simple, " ")]
        alone += self.together(new, words, marked, self.mark)
        for i in alone:
            ids = self.tokenizer.encode(words[i], add_special_tokens=False).ids
            self[new[i]] = np.array(ids, "<u4").tobytes()

    def together(self, new: list[bytes], words: list[str], chosen: list[int], between: str) -> list[int]:
        """Encode in groups and cut at the marks, or after ids that end a word; returns what could not be told apart."""
        groups = [chosen[i : i + self.TOGETHER] for i in range(0, len(chosen), self.TOGETHER)]
        texts = [between.join([words[i] for i in g]) for g in groups]
        found, gap = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), 4 * (between != " ")
        unclear = []
        for group, encoded in zip(groups, found, strict=True):
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark_id) * 4 if gap else np.flatnonzero(self.ending[ids])[:-1] * 4 + 4
            if len(ends) != len(group) - 1:
                unclear += group
                continue
            raw, start = ids.tobytes(), 0
            for i, end in zip(group, (*ends.tolist(), len(raw)), strict=True):
                self[new[i]] = raw[start:end]
                start = end + gap
        return unclear

    def texts(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text. Long lists are taken in slices, so that what is held at once stays bounded.

        The pieces of a slice are found in its bytes at once and numbered by Arrow, so each distinct one is looked up once; Arrow
        lays the ids out again.
        """
        for start, end in batches_of(map(len, texts), SLICE_BYTES):
            gc.disable()  # nothing here is cyclic, and each collection would walk the whole memory
            try:
                joined = np.frombuffer(b"\n".join(map(self.lowered, texts[start:end])), np.uint8)
                begins, ends = piece_spans(joined)
                offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined[~BLANK[joined]])]
                numbered = pa.Array.from_buffers(pa.binary(), len(begins), buffers).dictionary_encode()
                pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
                self.learn(pieces)
                own = list(map(self.__getitem__, pieces))
            finally:
                gc.enable()
            ends = np.cumsum([0, *map(len, own)]) // 4
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(own), "<u4")))
            laid = lists.take(numbered.indices)
            ids = laid.flatten().to_numpy()
            at = np.cumsum([0, *(len(t) + 1 for t in texts[start:end])])
            cuts = laid.offsets.to_numpy()[np.searchsorted(begins, at)].tolist()
            for a, b in zip(cuts, cuts[1:]):
                yield ids[a:b].tobytes()


def encoder(path: str) -> WordIds:
    """One per worker process and vocabulary, until the worker turns to another operator."""
    own = kept("token_files")
    if path not in own:
        own[path] = WordIds(path)
    return own[path]


def segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part, segment, before = TaskContext.get().partitionId(), 0, 0
    end = np.array([end_id], "<u4").tobytes()
    words = encoder(path)
    for batch in batches:
        names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        docs, raw, size = [], [], 0
        for place, ids in enumerate(words.texts(texts)):
            docs.append((names[place], len(ids) // 4 + 1))
            raw += (ids, end)
            size += len(ids) // 4 + 1
            if size >= SEGMENT_IDS or place == len(texts) - 1:
                index, payload = to_planes(np.frombuffer(b"".join(raw), "<u4"))
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()),
                    "segment": pa.array([segment], pa.int32()),
                    "before": pa.array([before]),
                    "n_ids": pa.array([size]),
                    "doc_ids": pa.array([[d for d, _ in docs]], pa.list_(pa.int64())),
                    "lengths": pa.array([[n for _, n in docs]], pa.list_(pa.int64())),
                    "index": pa.array([index], pa.list_(pa.struct([(k, pa.int32()) for k in ("n", "p0", "p1", "p2", "p3")]))),
                    "payload": pa.array([payload], pa.binary()),
                })
                segment, before = segment + 1, before + size
                docs, raw, size = [], [], 0


def write_token_file(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode whole texts and write them in ascending id order under ``path``.

    The texts are range-partitioned by id (and a hash of the text, so that a much repeated id is spread too), then encoded and
    written partition by partition: one shuffle of the texts, no global sort task.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(lambda it: segments(it, tokenizer, end_id), SEGMENT_SCHEMA).write.parquet(path)


def part_starts(stored: DataFrame) -> DataFrame:
    """Ids of all earlier parts: one row per part, as many as the write had tasks."""
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))


def decoded(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        for row in batch.to_pylist():
            ids = from_planes(row["index"], row["payload"])
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            cuts = list(zip(starts.tolist(), ends.tolist(), strict=True))
            found = {
                "part": pa.array([row["part"]] * len(cuts), pa.int32()),
                "place": pa.array(row["before"] + starts),
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "n_tokens": pa.array(lengths),
            }
            if digest:
                found["ids_crc32"] = pa.array([zlib.crc32(ids[a:b]) for a, b in cuts], pa.int64())
            else:
                found["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in cuts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(found)


def read_token_file(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before it), n_tokens and ids.

    With ``digest``, ids_crc32 (of the ids as little-endian 32-bit numbers) stands in for ids.
    """
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    last = "ids_crc32" if digest else "ids"
    schema = f"part int, place long, doc_id long, n_tokens long, {last} " + ("long" if digest else "array<bigint>")
    docs = stored.select("part", "before", "doc_ids", "lengths", "index", "payload").mapInArrow(
        lambda it: decoded(it, digest), schema
    )
    # One row per part of the file, at most as many as there were shuffle partitions.
    starts = F.broadcast(part_starts(stored))
    return docs.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("place")).alias("start"), "n_tokens", last
    )
