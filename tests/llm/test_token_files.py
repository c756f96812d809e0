from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from carelake.llm import token_files
from carelake.llm.queries import fresh, queries
from llm_support import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_planes_round_trip():
    draw = np.random.default_rng(0)
    for n in (0, 1, token_files.BLOCK_IDS - 1, token_files.BLOCK_IDS + 5):
        ids = draw.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (token_files.from_planes(*token_files.to_planes(ids)) == ids).all()


def test_driver_documents(spark, documents):
    tokenizer, start = Tokenizer.from_file(PATH), 0
    rows = {r.doc_id: r for r in queries()["op8_token_files"](spark, SF).collect()}
    for doc in documents.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 2]
        row = rows[doc.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pieces_are_encoded_as_whole_texts_are():
    tokenizer, draw = Tokenizer.from_file(PATH), random.Random(1)
    parts = [
        "word", "Wörter,", " ", "\n", " ", "\x1c", "\x85", "don't", "'S", "é", "́", "İI", "ΑΣ", "ſ", "12345", "!!!", "...", "a.b,c", "<|endoftext|>",
        "<|STARTOFTEXT|>", "<|startoftext|>", "<|", "|>", "漢字", "한글", "😀", "x'll", "…", "word.", "word!?", "-", "ǅ", "'", " ",
    ]
    words = token_files.WordIds(PATH)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(0, 12))) for _ in range(1500)]
    for text, found in zip(texts, words.texts([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files.WordIds, "LIMIT", 50)
    monkeypatch.setattr(token_files, "SLICE_BYTES", 200)
    tokenizer, draw = Tokenizer.from_file(PATH), random.Random(2)
    texts = [" ".join(f"w{draw.randrange(200)}x." for _ in range(30)) for _ in range(60)]
    for text, found in zip(texts, token_files.WordIds(PATH).texts([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_marks_are_pieces_of_their_own():
    """A word is remembered once, whatever marks stand behind it."""
    words = token_files.WordIds(PATH)
    texts = ["Word. word, WORD!! (word) word- é. . <|x|>. a" + "!" * 40 + "\n", "", "word;"]
    tokenizer = Tokenizer.from_file(PATH)
    for text, found in zip(texts, words.texts([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert [w for w in words if w.startswith(b"word")] == [b"word"]
    assert b"." in words and b"," in words


def test_odd_rows(spark, odd, nothing):
    for df, n in ((odd, 12), (nothing, 0)):
        path = fresh(spark, "tokens")
        token_files.write_token_file(df, path, PATH, 2)
        rows = token_files.read_token_file(spark, path).collect()
        assert len(rows) == n
        assert {tuple(r.ids) for r in rows if r.doc_id in (2, 3, 4)} == ({(2,)} if n else set())
        rows.sort(key=lambda r: r.start)
        assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(n)]
        ids = [r.doc_id for r in rows]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
