"""SimHash near copies found with tables of distances to reference fingerprints."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.cells import MAX_CELLS, deal
from pulsegrid.llm.components import block_labels, components
from pulsegrid.llm.sampling import drawn
from pulsegrid.session import cut

SEED = 42
TABLE = 16  #: reference fingerprints whose distances travel with a fingerprint
BLOCK = 2048  #: fingerprints a task compares with as many others
CHUNK = 1 << 16  #: shingles hashed before their bits are counted


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a whole text as a signed 64-bit number; zero if it has no words."""
    words = text.encode().lower().split() if text else []  # bytes: ASCII letters and spaces only
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle))))
    ones, total = np.zeros(64, np.int64), 0
    while chunk := [xxhash.xxh64_intdigest(x, SEED) for x in islice(shingles, CHUNK)]:
        bits = np.unpackbits(np.array(chunk, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(chunk)
    packed = np.packbits(2 * ones > total)
    return int(packed.view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with ``simhash long``; an existing column of that name is replaced.

    A null text counts as empty.
    """

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return docs.withColumn("simhash", F.pandas_udf(of, "long")(F.col(text)))


def _distances(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ pivots[None, :])


def visits(prints: DataFrame, pivots: np.ndarray, radius: int) -> DataFrame:
    """Distances of ``prints (simhash long)`` to the pivots, and the cells where each can have links.

    A fingerprint is at home with its nearest pivot p. If it is within ``radius`` of one at home
    with q, then, by the triangle inequality, q is at most 2 * radius farther from it than p:
    those cells it visits. Of the two cells of a pair only the later one is needed.
    """
    step = max(1, (1 << 22) // len(pivots))

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = frame["simhash"].to_numpy(np.int64)
            for i in range(0, len(keys), step):
                part = keys[i : i + step]
                far = _distances(part.view(np.uint64), pivots)
                home = far.argmin(axis=1)
                near = far <= far.min(axis=1, keepdims=True) + 2 * radius
                near &= np.arange(len(pivots)) >= home[:, None]
                row, cell = near.nonzero()
                table = [x.tobytes() for x in far[:, :TABLE].astype(np.uint8)]
                yield pd.DataFrame(
                    {
                        "cell": cell.astype(np.int32),
                        "home": cell == home[row],
                        "simhash": part[row],
                        "table": [table[r] for r in row],
                    }
                )

    return prints.select("simhash").mapInPandas(
        of, "cell int, home boolean, simhash long, table binary"
    )


def _survivors(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two distance tables that differ by at most ``radius`` everywhere."""
    shift, most = np.uint8(radius), np.uint8(2 * radius)
    close = lambda x, y: (x - y + shift) <= most  # modulo 256; distances are 64 at most
    mask = np.ones((len(a), len(b)), bool)
    for t in range(min(3, a.shape[1])):
        mask &= close(a[:, None, t], b[None, :, t])
    i, j = mask.nonzero()
    for t in range(3, a.shape[1]):
        same = close(a[i, t], b[j, t])
        i, j = i[same], j[same]
    return i, j


def _links_of_block(radius: int):
    """Compares the two blocks of a task; gives each linked fingerprint its block's smallest."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        first = (frame["own"] == frame["first"]).to_numpy()
        alone = frame["first"].iat[0] == frame["second"].iat[0]
        keys = frame["simhash"].to_numpy(np.int64)
        order = np.lexsort((keys, ~first))
        keys, first = keys[order], first[order]
        table = np.frombuffer(b"".join(frame["table"].to_numpy()[order]), np.uint8)
        table = table.reshape(len(keys), -1)
        prints, split = keys.view(np.uint64), 0 if alone else int(first.sum())
        left, right = [], []
        for i in range(0, len(keys) if alone else split, 256):
            end = min(i + 256, len(keys) if alone else split)
            start = i if alone else split
            x, y = _survivors(table[i:end], table[start:], radius)
            x, y = x + i, y + start
            near = np.bitwise_count(prints[x] ^ prints[y]) <= radius
            near &= x != y
            left.append(x[near])
            right.append(y[near])
        none = [np.zeros(0, np.int64)]
        label = block_labels(len(keys), np.concatenate(left or none), np.concatenate(right or none))
        moved = label != np.arange(len(keys))
        return pd.DataFrame({"a": keys[moved], "b": keys[label[moved]]})

    return of


def links(prints: DataFrame, radius: int = 2, pivots: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the ``prints (simhash long, distinct)`` within ``radius`` bits.

    Not all links are listed, but enough of them that components are the same. By default there
    are about as many pivots as the root of the number of fingerprints, MAX_CELLS at most, drawn
    by hash from the fingerprints themselves: a crowd of similar ones is thus cut finely. Cells
    that are large nevertheless are compared block by block.
    """
    count = prints.count()
    wanted = pivots or min(MAX_CELLS, max(TABLE, math.isqrt(count)))
    some = drawn(prints.select("simhash"), count, wanted, 7, "simhash").collect()
    if not some:
        return prints.select(F.col("simhash").alias("a"), F.col("simhash").alias("b"))
    references = np.array([row["simhash"] for row in some], np.int64).view(np.uint64)
    dealt = deal(cut(visits(prints, references, radius)), "simhash", BLOCK)
    return dealt.groupBy("cell", "first", "second").applyInPandas(
        _links_of_block(radius), "a long, b long"
    )


def _classes(marked: DataFrame, radius: int) -> DataFrame:
    """``marked (doc_id, simhash, ...)``, a written table, with ``component_id``."""
    prints = cut(marked.groupBy("simhash").agg(F.min("doc_id").alias("least")))
    found = components(links(prints, radius)).withColumnRenamed("node", "simhash")
    member = prints.join(found, "simhash", "left").withColumn(
        "component", F.coalesce("component", "simhash")
    )
    names = member.groupBy("component").agg(F.min("least").alias("component_id"))
    return marked.join(member.join(names, "component").select("simhash", "component_id"), "simhash")


def near_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """One row ``(doc_id, simhash, component_id)`` per row of ``docs``.

    Documents whose fingerprints differ by at most ``radius`` bits are linked; component_id is the
    smallest id reachable over links. Null texts count as empty; documents without words share the
    fingerprint zero. Rows with a null id take part and have a component, which is null if no row
    in it has an id; repeated rows are kept. Only distinct fingerprints are compared, so any number
    of copies costs one comparison. An empty table gives an empty result.
    """
    named = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    marked = cut(fingerprints(named, "text", shingle).drop("text"))
    return _classes(marked, radius).select("doc_id", "simhash", "component_id")


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the smallest id.

    Of several rows with that id one stays, chosen by a hash of its columns. Rows without an id
    are all kept, as nothing names them. Null texts count as empty; other columns may have any name
    and type; an empty table gives an empty result.
    """
    # A row is named by its id and a hash of all of it, written as JSON, which maps have too.
    whole = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id).alias("doc_id"), F.col(text).alias("text")
    ).withColumn("row_hash", F.xxhash64(F.to_json("row")))
    marked = cut(fingerprints(whole.select("doc_id", "text", "row_hash"), "text", shingle).drop("text"))
    first = (
        _classes(marked, radius)
        .filter("doc_id = component_id")
        .groupBy(F.col("doc_id").alias("kept_id"))
        .agg(F.min("row_hash").alias("kept_hash"))
    )
    named = whole.filter(F.col("doc_id").isNotNull())
    one = (F.col("doc_id") == F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash"))
    return (
        named.join(first, one)
        .dropDuplicates(["kept_id", "kept_hash"])
        .select("row.*")
        .unionByName(docs.filter(F.col(id).isNull()))
    )
