"""Pack tokenised documents into sequences of a fixed length: best fit, longest piece first."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

GROUP = 4096  #: documents packed together; every group of a large table is packed by itself
GROUP_BYTES = 1 << 26  #: bytes of text packed together, on average: a task holds the ids of its group
# Fixed value: the published pattern of byte-level tokenizers.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes have long been fixed, so that both libraries' patterns cut alike.
PLAIN = re.compile("[\0-\u024f]*")
SPACES = re.compile(r"\s+")
RUN = 1 << 16  #: white space in a row up to which tiktoken gets a text: its pattern stops on a million


class TextIds:
    """Ids of whole texts as the tokenizers library gives them, as little-endian 32-bit numbers.

    A byte-level vocabulary numbered in the order of its merges is also given to tiktoken, which
    applies the same merges several times as fast. Texts with an added token's string, with
    characters beyond PLAIN or more than RUN of white space, texts on which tiktoken fails, and all
    texts for other vocabularies, go to the library itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.fast = self._same_merges(json.loads(Path(path).read_text()))

    @staticmethod
    def _same_merges(spec: dict):
        import tiktoken

        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        vocab = model["vocab"]
        plain = (
            cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
            and spec["normalizer"] is None
            and model["type"] == "BPE"
            and not any(model.get(x) for x in ("dropout", "byte_fallback", "ignore_merges"))
            and all(vocab["".join(m)] == 256 + i for i, m in enumerate(merges))
            and len(vocab) == 256 + len(merges)
        )
        if not plain:
            return None
        # The vocabulary writes bytes that do not print as characters from 256 on, in order.
        print_as = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in print_as]
        byte = {chr(b): b for b in print_as} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in token): n for token, n in vocab.items()}
        return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> bool:
        return (
            bool(PLAIN.fullmatch(text))
            and not any(x in text for x in self.added)
            and (len(text) <= RUN or all(x.end() - x.start() <= RUN for x in SPACES.finditer(text)))
        )

    def _quick(self, text: str) -> bytes | None:
        """The ids by tiktoken; None if the library must find them."""
        if self.fast is None or not self._plain(text):
            return None
        try:
            return self.fast.encode_to_numpy(text).astype("<u4").tobytes()
        except ValueError:  # its pattern gives up where the library's does not
            return None

    def __call__(self, texts: list[str]) -> list[bytes]:
        fast = [self._quick(text) for text in texts]
        slow = [text for text, ids in zip(texts, fast) if ids is None]
        rest = iter(self.library.encode_batch_fast(slow, add_special_tokens=False))
        return [np.array(next(rest).ids, "<u4").tobytes() if ids is None else ids for ids in fast]


def in_batches(texts: Iterable[str | None], chars: int = 1 << 21) -> Iterator[list[str]]:
    """Texts in order, null as empty, in lists of about ``chars`` characters."""
    batch, size = [], 0
    for text in texts:
        batch.append(text or "")
        size += len(batch[-1])
        if size >= chars:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def tokenised(
    docs: DataFrame, id: str, text: str, path: str, end_id: int, groups: int
) -> DataFrame:
    """Per document its ids, in two bytes each where all of them fit, else in four."""
    end = np.array([end_id], "<u4").tobytes()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = TextIds(path), TaskContext.get().partitionId()
        for rows in batches:
            done = 0
            for batch in in_batches(rows["text"].to_pylist()):
                data = [np.frombuffer(x + end, "<u4") for x in encode(batch)]
                columns = [
                    rows["doc_id"].slice(done, len(batch)),
                    pa.array([len(x) for x in data], pa.int64()),
                    pa.array([(x.astype("<u2") if x.max() < 1 << 16 else x).tobytes() for x in data], pa.binary()),
                    pa.array((seen + np.arange(len(batch))) % groups, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_tokens", "ids", "batch"])
                done, seen = done + len(batch), seen + len(batch)

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        of, "doc_id long, doc_tokens long, ids binary, batch long"
    )


class OpenWindows:
    """Open windows by room left, in a segment tree: the tightest that fits in logarithmic time."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)  # open windows below each node; leaf r: room r
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _count(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.tree[node] += by
            node >>= 1

    def add(self, window: int, room: int) -> None:
        if room:
            self.windows[room].append(window)
            self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room that holds ``need``, and its room; it is taken out."""
        node = need + self.size
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.size
        self._count(room, -1)
        return self.windows[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Window and offset of each length (longest first), and the tokens in each window."""
    opened, used = OpenWindows(capacity), []
    window, offset = [], []
    for need in lengths:
        found = opened.take(need)
        number, room = found or (len(used), capacity)
        if found is None:
            used.append(0)
        window.append(number)
        offset.append(used[number])
        used[number] += need
        opened.add(number, room - need)
    return window, offset, used


def _pack_group(capacity: int, with_ids: bool):
    def of(group: pa.Table) -> pa.Table:
        tokens = group["doc_tokens"].to_numpy()
        data = [
            np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4").astype("<u4").tobytes()
            for x, n in zip(group["ids"].to_pylist(), tokens)
        ]
        step, rest = 4 * capacity, tokens % capacity
        sums = [[zlib.crc32(x[i : i + step]) for i in range(0, len(x), step)] for x in data]
        ids = group["doc_id"].fill_null(-1).to_numpy()
        order = np.lexsort((np.array([x[-1] for x in sums]), ids, -rest))
        window, offset, used = best_fit([int(n) for n in rest[order] if n], capacity)
        rows, full = [], len(used)
        for n, at in enumerate(order):
            size = int(tokens[at])
            for k, crc in enumerate(sums[at]):
                start = k * capacity
                if size - start >= capacity:
                    rows.append((at, start, capacity, crc, size, full, 0, capacity))
                    full += 1
                else:
                    total = used[window[n]]
                    padded = total if total & (total - 1) == 0 else capacity
                    rows.append((at, start, size - start, crc, size, window[n], offset[n], padded))
        at, *columns = (np.array(x, np.int64) for x in zip(*rows))
        names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]
        out = dict(zip(names, columns))
        out["sequence_id"] += group["batch"][0].as_py() << 32
        table = {"doc_id": group["doc_id"].combine_chunks().take(pa.array(at))} | out
        if with_ids:  # a document's pieces follow each other, as do its ids
            ends = np.concatenate([[0], np.cumsum(out["length"])])
            values = np.frombuffer(b"".join(data[x] for x in order), "<i4")
            table["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
        return pa.table(table)

    return of


def pack(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``capacity`` tokens.

    A document's ids (the library's for the whole text, no special tokens added, then ``end_id``)
    are cut into full windows, each a sequence of its own, and a rest. Rests are packed longest
    first, each into the open sequence with the least room that holds it. GROUP documents, dealt in
    turn, are packed at a time, or as many fewer as have GROUP_BYTES on average: a task holds the ids of
    its group, which has more bytes only where long documents meet in it by chance; ties go by doc_id.

    Returns per piece: doc_id, start, length, ids_crc32 (of the packed ids), doc_tokens, sequence_id,
    offset, sequence_length, the padded length: ``capacity``, or the number of tokens where that is a
    power of two, and ids, its tokens (not ``with_ids``: without them). A null or empty text has the end id alone; rows with a null or
    a repeated id are documents of their own; an empty table gives no pieces. ``docs`` should be a
    stored table: a task that is run again must read the same rows.
    """
    count, held = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    groups = max(1, -(-count // GROUP), -(-held // GROUP_BYTES))
    rows = tokenised(docs, id, text, path, end_id, groups)
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, sequence_length long"
    )
    if with_ids:
        schema += ", ids array<int>"
    return rows.groupBy("batch").applyInArrow(_pack_group(capacity, with_ids), schema)
