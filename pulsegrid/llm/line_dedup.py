"""Line dedup: a sharded minimal perfect hash over all distinct lines says who keeps each of them.

Lines are known by a digest of their key alone. Per shard of digests, a minimal perfect hash gives
every digest a place of its own in flat arrays of fingerprints, counts and first holders. Documents
send digests, never lines, past the shard's arrays and get back those that they lose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsegrid.session import cut

LEAST = 10  #: code points of a key that may be dropped, at least
BLANK = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 2048  #: distinct lines of a shard, about
SHARD_PROBES = 4 * SHARD_KEYS  #: questions to one copy of a shard, about; hot shards have several copies
GAMMA = 2.0  #: bits per key that a level of the perfect hash has
MOST_COUNT = 255  #: at which counts of holders stop
FLUSH = 1 << 16  #: rows given to Spark at a time


def key_of(line: bytes, least: int = LEAST) -> bytes | None:
    """A line without blanks at its ends, A-Z lower-cased; None if too short to be dropped."""
    key = line.strip(BLANK).lower()
    if len(key) < least or not (key.isascii() or len(key) - _inner(key) >= least):
        return None
    return key


def _inner(key: bytes) -> int:
    """Bytes that only go on a code point begun before."""
    return int(np.count_nonzero((np.frombuffer(key, np.uint8) & 0xC0) == 0x80))


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _spread(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    """A new mix of both halves for each level."""
    x = high ^ (low * np.uint64(0x9E3779B97F4A7C15) + np.uint64((level + 1) * 0xD1342543DE82EF95 % (1 << 64)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Places 0 to n - 1 for n distinct pairs of halves, no place twice.

    Keys that are alone at their place of a level's bits are settled there; the others go to the
    next, smaller level. A settled key's place is the number of bits set before its own.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        left, sizes, words = np.arange(len(high)), [], []
        while len(left):
            size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
            at = _spread(high[left], low[left], len(sizes)) % np.uint64(size)
            hits = np.bincount(at.astype(np.int64), minlength=size)
            words.append(np.packbits(hits == 1, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[hits[at.astype(np.int64)] != 1]
        return cls(np.array(sizes, np.int64), np.concatenate(words or [np.zeros(0, np.uint64)]))

    def places(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for some keys that were not among those it was built from."""
        found = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = (_spread(high[left], low[left], level) % np.uint64(size)).astype(np.int64)
            at += self.starts[level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            is_set = (word >> bit) & np.uint64(1) == 1
            lower = word & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[is_set]] = (self.before[at >> 6] + np.bitwise_count(lower))[is_set]
            left = left[~is_set]
        return found


def fingerprint(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (_spread(low, high, 63) >> np.uint64(48)).astype(np.uint16)


def _keys(docs: DataFrame, least: int) -> DataFrame:
    """``(doc, body, high, low)``: the digests of a row's lines, each once; ``body`` marks its text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(docs: list, bodies: list, digests: list[bytes]) -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(bodies, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                ["doc", "body", "high", "low"],
            )

        docs, bodies, digests = [], [], []
        for batch in batches:
            for doc, body, text in zip(*(column.to_pylist() for column in batch.columns)):
                keys = {key_of(line, least) for line in (text or b"").split(b"\n")}
                keys.discard(None)
                docs += [doc] * len(keys)
                bodies += [body] * len(keys)
                digests += map(digest, keys)
                if len(docs) >= FLUSH:
                    yield out(docs, bodies, digests)
                    docs, bodies, digests = [], [], []
        yield out(docs, bodies, digests)

    return docs.mapInArrow(of, "doc long, body long, high long, low long")


def _index(keys: DataFrame) -> DataFrame:
    """One row per shard: the perfect hash of its keys and the arrays it leads into."""

    def of(table: pa.Table) -> pa.Table:
        high, low = (table[name].to_numpy().view(np.uint64) for name in ("high", "low"))
        hashed = PerfectHash.build(high, low)
        at = hashed.places(high, low)
        marks, counts, firsts = (np.zeros(len(at), kind) for kind in (np.uint16, np.uint8, np.int64))
        marks[at] = fingerprint(high, low)
        counts[at] = table["holders"].to_numpy()
        firsts[at] = table["first"].to_numpy()
        arrays = (hashed.sizes, hashed.words, marks, counts, firsts)
        columns = [pa.array([x.tobytes()], pa.binary()) for x in arrays]
        names = ["sizes", "words", "marks", "counts", "firsts"]
        return pa.table([table["shard"].slice(0, 1), *columns], names=["shard", *names])

    schema = "shard long, sizes binary, words binary, marks binary, counts binary, firsts binary"
    return keys.select("shard", "high", "low", "holders", F.coalesce("first", F.lit(0)).alias("first")).groupBy(
        "shard"
    ).applyInArrow(of, schema)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Questions that follow their shard's arrays in the stream; out come those answered with a loss."""
    shard = arrays = None
    names = ("doc", "body", "high", "low")
    for batch in batches:
        shards = batch["shard"].to_numpy()
        is_index = np.asarray(batch["sizes"].is_valid())
        edges = np.flatnonzero(is_index | (np.diff(shards, prepend=shards[:1]) != 0))
        for start, end in zip(np.unique(np.r_[0, edges]), np.r_[np.unique(np.r_[0, edges])[1:], len(shards)]):
            if is_index[start]:
                read = lambda name, kind: np.frombuffer(batch[name][int(start)].as_py(), kind)
                hashed = PerfectHash(read("sizes", np.int64), read("words", np.uint64))
                arrays = hashed, read("marks", np.uint16), read("counts", np.uint8), read("firsts", np.int64)
                shard, start = shards[start], start + 1
            if start == end:
                continue
            if shards[start] != shard:
                raise RuntimeError("lines without the arrays of their shard")
            rows = batch.slice(int(start), int(end - start)).select(names)
            hashed, marks, counts, firsts = arrays
            high, low = (rows[name].to_numpy().view(np.uint64) for name in ("high", "low"))
            at = hashed.places(high, low)
            if (at < 0).any() or (marks[at] != fingerprint(high, low)).any():
                raise RuntimeError("a line is not in the index of its shard")
            unnamed = np.asarray(rows["doc"].is_null())
            doc = rows["doc"].fill_null(0).to_numpy()
            lost = (counts[at] >= 2) & (unnamed | (doc != firsts[at]))
            yield rows.filter(pa.array(lost))


def _losses(docs: DataFrame, least: int) -> DataFrame:
    """``(doc, body, lost array<binary>)`` for each row that loses lines; ``lost`` holds digests."""
    asked = _keys(docs, least)
    # Two ends and a null tell whether several documents hold a line, however often a row is repeated.
    several = (F.min("doc") != F.max("doc")) | (F.count_if(F.col("doc").isNull()).between(1, F.count("*") - 1))
    keys = cut(
        asked.groupBy("high", "low").agg(
            F.min("doc").alias("first"),
            F.count("*").alias("rows"),
            F.when(several, F.least(F.count("*"), F.lit(MOST_COUNT))).otherwise(1).cast("int").alias("holders"),
        )
    )
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    shard = F.expr(f"pmod(high, {shards}L)").alias("shard")
    placed = keys.withColumn("shard", shard)
    copies = F.ceil(F.sum("rows") / SHARD_PROBES).cast("long").alias("copies")
    load = placed.groupBy("shard").agg(copies)
    hot = cut(load.filter("copies > 1").withColumnRenamed("shard", "hot_shard"))

    def spread(rows: DataFrame) -> DataFrame:
        joined = rows.join(hot, F.col("shard") == F.col("hot_shard"), "left").drop("hot_shard")
        return joined.withColumn("copies", F.coalesce("copies", F.lit(1)))

    empty = [F.lit(None).cast("binary").alias(x) for x in ("sizes", "words", "marks", "counts", "firsts")]
    questions = spread(asked.withColumn("shard", shard)).select(
        "shard", F.expr("pmod(xxhash64(doc, body, low), copies)").alias("copy"), "doc", "body", "high", "low", *empty
    )
    blank = [F.lit(None).cast("long").alias(x) for x in ("doc", "body", "high", "low")]
    arrays = spread(_index(placed)).select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), *blank,
        "sizes", "words", "marks", "counts", "firsts",
    )
    stream = questions.unionByName(arrays).repartition("shard", "copy")
    ordered = stream.sortWithinPartitions("shard", "copy", F.col("sizes").isNull())
    found = ordered.mapInArrow(_probe, "doc long, body long, high long, low long")
    halves = F.struct("high", "low")
    return found.groupBy("doc", "body").agg(F.collect_set(halves).alias("lost"))


def drop_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST
) -> DataFrame:
    """``docs`` as ``row``, with ``kept`` (the text without its dropped lines), n_lines and n_dropped.

    A line's key is the line without white space at its ends, A-Z lower-cased. A key of ``least`` code
    points or more that several documents hold stays, with all its repeats, in the one with the
    smallest id, and is dropped everywhere else. Lines are what ``\\n`` parts; the kept ones are joined
    by it again. A null or empty text is one empty line and yields an empty text. Rows with one id are
    one document, those with a null id too, whose id counts as the largest. Repeated rows are kept,
    an empty table gives an empty result. Ids are whole numbers.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    named = docs.select(
        F.col(id).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("body"), body.alias("text")
    )
    losses = _losses(named, least).select(F.col("doc").alias("losing"), F.col("body").alias("of"), "lost")

    def of(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
        out = []
        for text, gone in zip(texts, lost):
            lines = text.split(b"\n")
            kept = lines
            if gone is not None:
                out_of = {np.array([x["high"], x["low"]], np.int64).tobytes() for x in gone}
                keys = (key_of(line, least) for line in lines)
                kept = [line for line, key in zip(lines, keys) if key is None or digest(key) not in out_of]
            out.append((b"\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])

    apply = F.pandas_udf(of, "kept binary, n_lines long, n_dropped long")
    whole = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id).cast("long").alias("doc"),
        F.xxhash64(F.col(text)).alias("body"),
        body.alias("text"),
    )
    same = F.col("doc").eqNullSafe(F.col("losing")) & (F.col("body") == F.col("of"))
    return (
        whole.join(losses, same, "left")
        .withColumn("out", apply("text", "lost"))
        .select("row", F.col("out.kept").cast("string").alias("kept"), "out.n_lines", "out.n_dropped")
    )
