"""Packing and token counts against the tokenizer libraries on whole texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsegrid.llm import packing, queries, tokens

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = ["a", "b", " ", "  ", "\n", "ab ", "the ", "é", "漢", "'s", "<s>", "<|endoftext|>", "1", "\t",
         " \n", "word ", "\x85", "\xa0", "\x1c", "▁", " 'll", "ő", "ß", "\0", "😀"]


def texts(n, seed, most=60):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, most))) for _ in range(n)]


def test_ids_are_the_librarys():
    library, ids = Tokenizer.from_file(BYTES), packing.TextIds(BYTES)
    assert ids.fast is not None
    some = texts(3000, 1) + [f"{a}{chr(c)}{b}" for c in range(0x250) for a in ("", "a ", "  ") for b in ("", "1", " b")]
    want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(some, add_special_tokens=False)]
    assert ids(some) == want
    other = packing.TextIds(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None and other(["two words"]) == [
        np.array(other.library.encode("two words", add_special_tokens=False).ids, "<u4").tobytes()
    ]


def test_ids_of_long_white_space():
    """tiktoken's pattern stops on a million white-space characters in a row, the library's does not."""
    library, ids = Tokenizer.from_file(BYTES), packing.TextIds(BYTES)
    some = [f"a{run}b" for run in (" " * 3_000_000, "\n" * 1_000_000, " \t" * 500_000, " " * 65_536, " " * 65_537)]
    some += ["plain words", "x y " * 30_000]
    want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(some, add_special_tokens=False)]
    assert ids(some) == want

    class Failing:
        def encode_to_numpy(self, text):
            raise ValueError("regex")

    ids.fast = Failing()
    assert ids(["one two", "three"]) == [
        np.array(library.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in ("one two", "three")
    ]


def test_best_fit_takes_the_tightest_window():
    draw = random.Random(4)
    lengths = sorted((draw.randint(1, 64) for _ in range(2000)), reverse=True)
    window, offset, used = packing.best_fit(lengths, 64)
    room: list[int] = []
    for need, at in zip(lengths, window):
        fit = [r for r in room if r >= need]
        if fit:
            assert room[at] == min(fit)
            room[at] -= need
        else:
            assert at == len(room)
            room.append(64 - need)
    assert used == [64 - r for r in room]


def check_pieces(rows, want_ids, capacity):
    """Every id of every document in one piece; sequences full from 0 without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, ids in want_ids.items():
        at, copies = 0, {}
        for r in by_doc[doc]:
            copies.setdefault((r["start"], r["length"], r["ids_crc32"]), []).append(r)
        for (start, length, crc), _ in sorted(copies.items()):
            assert start == at and crc == zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids) == by_doc[doc][0]["doc_tokens"]
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        assert pieces[0]["sequence_length"] == (at if at & (at - 1) == 0 else capacity)


def test_pack(spark):
    some = texts(400, 2, 200) + [None, "", "long " * 5000, "x" * 4000]
    docs = spark.createDataFrame(
        [(i, t, 0, "g") for i, t in enumerate(some)], "doc_id long, text string, start int, batch string"
    )
    old, packing.GROUP = packing.GROUP, 100
    try:
        rows = packing.pack(docs.repartition(3), BYTES, capacity=100, with_ids=True).collect()
    finally:
        packing.GROUP = old
    library = Tokenizer.from_file(BYTES)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(some)}
    check_pieces(rows, ids, 100)
    assert all(r["ids"] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in rows)
    assert packing.pack(docs.limit(0), BYTES).count() == 0


def test_query_returns_the_tokens(spark):
    """The sequences of the query hold their ids, and its checksums are made from them."""
    rows = queries.op3_packing(spark, "/root/testdata/sf0.001").collect()
    library = Tokenizer.from_file(BYTES)
    text = {d["doc_id"]: d["text"] for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in text.items()}
    assert all(r["ids"] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in rows)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)


def test_ids_of_either_width(spark):
    """An end id beyond two bytes; a null and a repeated id; an exact multiple of the capacity."""
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None), (2, "a")], "doc_id long, text string")
    library = Tokenizer.from_file(BYTES)
    for end in (0, 70_000):
        rows = packing.pack(docs, BYTES, capacity=2, end_id=end).orderBy("doc_id", "start").collect()
        abc = library.encode("a b c", add_special_tokens=False).ids
        want = [(None, [end]), (1, abc[:2]), (1, abc[:2]), (1, [abc[2], end]), (1, [abc[2], end]), (2, [*library.encode("a").ids, end])]
        assert [(r["doc_id"], r["ids"]) for r in rows] == want
    plain = packing.pack(docs, BYTES, with_ids=False)
    assert "ids" not in plain.columns and plain.count() == 4


def test_long_documents_are_packed_in_smaller_groups(spark):
    docs = spark.createDataFrame([(i, "some words " * 100) for i in range(50)], "doc_id long, text string")
    old, packing.GROUP_BYTES = packing.GROUP_BYTES, 11_000
    try:
        rows = packing.pack(docs, BYTES).collect()
    finally:
        packing.GROUP_BYTES = old
    assert len({r["sequence_id"] >> 32 for r in rows}) == 5 and {r["doc_id"] for r in rows} == set(range(50))


def test_pack_repeated_and_unnamed_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    rows = packing.pack(docs, BYTES).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (0, 2), (1, 3), (1, 3)]
    assert len({r["sequence_id"] for r in rows}) == 1 and {r["offset"] for r in rows} == {0, 3, 6, 8}


def test_pack_query(spark):
    rows = queries.op3_packing(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    library = Tokenizer.from_file(BYTES)
    check_pieces(rows, {d["doc_id"]: library.encode(d["text"], add_special_tokens=False).ids + [0] for d in docs}, 1024)
    used = sum(r["length"] for r in rows)
    whole = sum({r["sequence_id"]: r["sequence_length"] for r in rows}.values())
    assert whole <= 1.02 * used


@pytest.mark.parametrize("path", [BYTES, PIECES, public_tokenizers.path("word_bpe_49k.json")])
@pytest.mark.parametrize("chunk, overlap", [(8, 2), (16, 4), (5, 1), (40, 8)])
def test_chunks_count_as_the_whole(path, chunk, overlap):
    pieces = tokens.Pieces.load(path)
    some = texts(250, 3) + ["x" * 300, " " * 300, "a " * 200, "\n" * 99, "漢字" * 90]
    assert [tokens.count_in_chunks(pieces, t, chunk, overlap) for t in some] == pieces.counts(some)


@pytest.mark.parametrize("path", [BYTES, PIECES])
def test_token_counts(spark, path):
    some = texts(50, 5) + [None, "", "word " * 30000, "x" * 70000]
    rows = [(i, t, 1, True) for i, t in enumerate(some)] + [(0, some[0], 1, True), (None, "a b", 1, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, over_limit boolean")
    got = {r["doc_id"]: r for r in tokens.token_counts(docs, path).collect()}
    want = tokens.Pieces.load(path).counts([t or "" for t in some])
    assert [got[i]["n_tokens"] for i in range(len(some))] == want
    assert [got[i]["n_bytes"] for i in range(len(some))] == [len((t or "").encode()) for t in some]
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got.values())
    assert tokens.token_counts(docs.limit(0), path).count() == 0


def test_token_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op5_token_counts(spark, "/root/testdata/sf0.001").collect()}
    want = tokens.Pieces.load(PIECES).counts([d["text"] for d in docs])
    assert got == {d["doc_id"]: n for d, n in zip(docs, want)}


def test_big_ids_beside_a_null(spark):
    big = 1 << 60
    docs = spark.createDataFrame([(big + 1, "a"), (None, "b"), (big + 2, "c d")], "doc_id long, text string").coalesce(1)
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert {r["doc_id"] for r in got} == {big + 1, big + 2, None}
