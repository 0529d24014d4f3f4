"""Token counts of whole texts; huge ones are encoded in overlapping chunks and spliced."""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.packing import in_batches

CHUNK = 1 << 16  #: characters from which a text is encoded in chunks
OVERLAP = 1 << 9  #: characters that a chunk shares with the next, at first


class Pieces:
    """A tokenizer: counts for texts, begins of tokens for chunks, and where cuts are harmless.

    ``harmless(text, p)`` is true only if no token can reach over position p, whatever the rest of
    the text, so that what a chunk gives beyond p is what the whole text gives.
    """

    counts: Callable[[list[str]], list[int]]
    begins: Callable[[str], list[int]]
    harmless: Callable[[str, int], bool]

    @staticmethod
    def load(path: str) -> "Pieces":
        return SentencePieces(path) if path.endswith(".model") else JsonPieces(path)


class SentencePieces(Pieces):
    """Merges never reach over the start of a run of spaces if no piece has one inside.

    That is read off the vocabulary, and that normalising leaves spaces alone is tried once; a
    model that fails either is only used on whole texts.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        mark = "▁"
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        plain = self.model.decode(self.model.encode("a  b \n c")) == "a  b \n c"
        self.proven = plain and not any(mark in p.lstrip(mark) for p in pieces)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    def begins(self, text: str) -> list[int]:
        found = self.model.encode(text, return_type="proto").pieces  # begins in bytes
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        return np.searchsorted(np.cumsum(width) - width, [p.begin for p in found]).tolist()

    def harmless(self, text: str, p: int) -> bool:
        return self.proven and text[p] == " " and text[p - 1] not in " ▁"


class JsonPieces(Pieces):
    """The byte-level pattern cuts before a single space between words; others are not cut."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        kind = type(self.library.pre_tokenizer).__name__
        self.proven = kind == "ByteLevel" and self.library.normalizer is None

    def counts(self, texts: list[str]) -> list[int]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [len(x.ids) for x in found]

    def begins(self, text: str) -> list[int]:
        return [begin for begin, _ in self.library.encode(text, add_special_tokens=False).offsets]

    def harmless(self, text: str, p: int) -> bool:
        return (
            self.proven
            and text[p] == " "
            and p + 1 < len(text)
            and not text[p + 1].isspace()
            and not text[p - 1].isspace()
        )


def _common_boundary(
    pieces: Pieces, text: str, begin: int, end: int, first: list[int], second: list[int]
) -> int | None:
    """The last position within [begin, end) where both encodings begin a token and a cut is harmless."""
    common = set(first[bisect_left(first, begin + 1) :]).intersection(second)
    return next((p for p in sorted(common, reverse=True) if pieces.harmless(text, p)), None)


def count_in_chunks(pieces: Pieces, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, as of the whole, encoding no more than it must at a time.

    The next chunk begins ``overlap`` before the end of the last. If the two have no harmless
    boundary in common, the overlap is doubled; once it reaches back to the last splice, the chunk
    itself is doubled, in the end to the whole rest of the text.
    """
    at = lambda begin, end: [begin + b for b in pieces.begins(text[begin:end])]
    total, start, spliced, end = 0, 0, 0, min(chunk, len(text))
    first = at(start, end)
    while end < len(text):
        width, splice = overlap, None
        while splice is None and end - width > spliced:
            begin = end - width
            stop = min(len(text), begin + max(chunk, 2 * width))
            second = at(begin, stop)
            splice = _common_boundary(pieces, text, begin, end, first, second)
            width *= 2
        if splice is None:
            end = min(len(text), start + 2 * (end - start))
            first = at(start, end)
        else:
            total += bisect_left(first, splice) - bisect_left(first, spliced)
            start, spliced, end, first = begin, splice, stop, second
    return total + len(first) - bisect_left(first, spliced)


def token_counts(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """One row ``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs``.

    Counts are those that the library of ``path`` (tokenizers for .json, sentencepiece for .model)
    gives for the whole text, with no special tokens added. A null text counts as empty; rows
    with null or repeated ids are counted like any other; an empty table gives an empty result.
    """

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces.load(path)
        for texts in batches:
            found: list[int] = []
            for batch in in_batches(texts):
                short = iter(pieces.counts([x for x in batch if len(x) <= CHUNK]))
                found += [
                    next(short) if len(x) <= CHUNK else count_in_chunks(pieces, x) for x in batch
                ]
            yield pd.Series(found, dtype="int64")

    n_tokens = F.pandas_udf(of, "long")(F.col(text))
    return docs.select(
        F.col(id).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens.alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
