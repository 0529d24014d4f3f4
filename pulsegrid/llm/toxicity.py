"""Toxicity by compression: which of two dictionaries makes a window of text shorter.

Both Zstandard dictionaries end with the words of ordinary text; in front of them the toxic one holds
what toxic texts repeat and ordinary ones do not: stretches of any length, across words, made of strings
that are over-represented in them. How far windows must be shortened, and how many must be, is learned
on documents that had no part in the dictionary they are judged with.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.llm.sampling import drawn
from pulsegrid.session import cut

TRAIN_TOXIC = 4000  #: labelled documents the model is fitted on at most, drawn by hash
TRAIN_ORDINARY = 8000
FOLDS = 4  #: parts of the training documents; each is calibrated with the dictionary of the others
GRAM = 6  #: bytes of the strings that are counted, at every place of a text
LEAST_DOCS = 3  #: toxic documents that hold such a string at least
MOST_GRAMS = 1 << 16  #: strings looked at, those in most toxic documents: what a model can know
CUTS = (2.5, 3.0, 3.5, 4.0, 5.0)  #: standard errors taken off a string's log odds, of which the best is chosen
CHOICE = 2000  #: training documents that it is chosen on, drawn by hash
TOXIC_BYTES = 60_000  #: of stretches, the most telling, in the toxic dictionary
WORD_BYTES = 100_000  #: of the most frequent ordinary words, in both dictionaries
WINDOW = 96  #: bytes of a window, which ends between words
#: Binary-tree search with tables that hold every place of the dictionaries; the usual ones for short
#: input forget the front of a dictionary, where the toxic strings are.
SEARCH = dict(
    window_log=18, chain_log=19, hash_log=18, search_log=6, min_match=4, target_length=0, strategy=6
)
SAVED = (1, 2, 3, 4, 5, 6, 8, 10)  #: bytes a window is shortened by, at which windows are counted
THRESHOLD = 0.7

PUNCTUATION = bytes(
    32 if not (chr(b).isalnum() or b >= 128 or b == ord("'")) else b for b in range(256)
)


def normalised(text: str | None) -> bytes:
    """Lower-cased words with single spaces between and round them."""
    words = (text or "").lower().encode().translate(PUNCTUATION).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: bytes, width: int = WINDOW) -> Iterator[bytes]:
    """All of a normalised text in windows of at most ``width`` bytes, cut between words.

    A word that is longer alone is cut anywhere. Neighbours share the space between them.
    """
    at = 0
    while at + 1 < len(text):
        end = min(at + width, len(text))
        if end < len(text):
            space = text.rfind(b" ", at + 1, end)
            end = space + 1 if space > at else end
        yield text[at:end]
        at = end - 1 if text[end - 1 : end] == b" " else end


@dataclass(frozen=True)
class Model:
    """Both dictionaries, and the weights that turn a document's savings into a score."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        rows = np.c_[np.ones(len(features)), (features - self.mean) / self.scale]
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights, -30, 30)))


class Savings:
    """By how many bytes the toxic dictionary shortens each window."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.with_toxic = self._compressor(toxic + ordinary)
        self.without = self._compressor(ordinary)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        # Content only: the words' places, and so the length of an ordinary window, are the same
        # in both, as toxic strings stand in front.
        prior = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters(
            write_content_size=False, write_checksum=False, write_dict_id=False, **SEARCH
        )
        if content:
            prior.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=prior, compression_params=how)

    def features(self, text: str | None) -> list[float]:
        """Savings: the largest, the mean, the sum; how many windows, and which share, save each of SAVED."""
        counts, short, long = Counter(), self.without.compress, self.with_toxic.compress
        for window in windows(normalised(text)):
            counts[len(short(window)) - len(long(window))] += 1
        total = sum(counts.values())
        saved = sum(by * n for by, n in counts.items())
        out = [float(max([0, *counts])), saved / max(1, total), saved / math.sqrt(max(1, total))]
        for least in SAVED:
            over = sum(n for saved, n in counts.items() if saved >= least)
            out += [math.log1p(over), math.sqrt(over / max(1, total))]
        return [*out, math.log1p(total)]


def _fit_weights(features: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, ...]:
    """Logistic regression by Newton steps, with a slight pull to zero."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    rows = np.c_[np.ones(len(features)), (features - mean) / scale]
    weights = np.zeros(rows.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - toxic) + 0.1 * weights
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(len(weights))
        weights -= np.linalg.solve(bend, slope)
    return mean, scale, weights


def held_out(id: Column) -> Column:
    """Whether a document's label is kept from training; a null id is like an empty one."""
    text = F.coalesce(id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 3 == 1


def _sketch(text: str | None) -> int:
    """The smallest hash of three words in a row: the same for most near copies."""
    words = normalised(text).split()
    rows = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
    return min(map(xxhash.xxh64_intdigest, map(b" ".join, rows))) >> 1


def _sample(docs: DataFrame, labels: DataFrame, id: str, text: str) -> DataFrame:
    """``(text, toxic, fold)`` of the training documents, one of each group of copies.

    A string that copies share is found once, not once per copy, and copies never part over folds.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    size = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    of = lambda toxic, most: drawn(
        known.filter(F.col("toxic") == toxic), size.get(toxic, 0), most, 3, "doc_id"
    )
    chosen = of(1, TRAIN_TOXIC).union(of(0, TRAIN_ORDINARY))

    def sketches(texts: pd.Series) -> pd.Series:
        return pd.Series([_sketch(x) for x in texts], dtype="int64")

    return (
        docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .withColumn("sketch", F.pandas_udf(sketches, "long")("text"))
        .groupBy("sketch", "toxic")
        .agg(F.min(F.struct("doc_id", "text")).alias("one"))
        .select("one.doc_id", "one.text", "toxic", (F.col("sketch") % FOLDS).cast("int").alias("fold"))
    )


def _grams(text: bytes) -> np.ndarray:
    """The GRAM bytes from each place on, as one number."""
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    n = max(0, len(data) - GRAM + 1)
    return sum((data[i : i + n] << (8 * i) for i in range(GRAM)), np.zeros(n, np.int64))


def _gram_counts(texts: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """``(gram, fold, docs)``: in how many documents a string stands; of ``among``, if given, only."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for fold, texts in frame.groupby("fold")["text"]:
                held = [np.unique(_grams(normalised(x))) for x in texts]
                if among is not None:
                    held = [x[np.isin(x, among, assume_unique=True)] for x in held]
                grams, docs = np.unique(np.concatenate(held), return_counts=True)
                yield pd.DataFrame({"gram": grams, "fold": fold, "docs": docs})

    found = texts.select("text", "fold").mapInPandas(of, "gram long, fold int, docs long")
    return found.groupBy("gram", "fold").agg(F.sum("docs").alias("docs"))


def _by_fold(counts: DataFrame, grams: np.ndarray) -> np.ndarray:
    """Documents per fold (rows) and string (columns)."""
    rows = counts.toArrow()
    out = np.zeros((FOLDS, len(grams)))
    out[rows["fold"].to_numpy(), np.searchsorted(grams, rows["gram"].to_numpy())] = rows["docs"].to_numpy()
    return out


def _weights(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Strings in order, and their weights for each dictionary: per cut without fold 0, 1, ..., and with all.

    The weight is how far the log odds of toxic and ordinary documents are above zero for sure.
    """
    toxic, ordinary = sample.filter("toxic = 1"), sample.filter("toxic = 0")
    counts = cut(_gram_counts(toxic))
    often = counts.groupBy("gram").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= LEAST_DOCS)
    kept = often.orderBy(F.desc("docs"), "gram").limit(MOST_GRAMS)
    grams = np.sort(kept.select("gram").toArrow()["gram"].to_numpy())
    if not len(grams):
        return grams, np.zeros((len(CUTS) * (FOLDS + 1), 0))
    among = counts.join(F.broadcast(kept.select("gram")), "gram")
    a, b = _by_fold(among, grams), _by_fold(_gram_counts(ordinary, grams), grams)
    size = np.zeros((2, FOLDS))
    for row in sample.groupBy("toxic", "fold").count().collect():
        size[row["toxic"], row["fold"]] = row["count"]
    out = []
    for cut_at in CUTS:
        for fold in range(FOLDS + 1):
            others = np.arange(FOLDS) != fold
            x, y = a[others].sum(axis=0), b[others].sum(axis=0)
            odds = np.log((x + 0.5) / (size[1, others].sum() + 1)) - np.log((y + 0.5) / (size[0, others].sum() + 1))
            sure = odds - cut_at * np.sqrt(1 / (x + 0.5) + 1 / (y + 0.5))
            out.append(np.where(x >= LEAST_DOCS, np.maximum(sure, 0.0), 0.0))
    telling = np.any(out, axis=0)
    return grams[telling], np.array(out)[:, telling]


def stretches(text: bytes, grams: np.ndarray, weight: np.ndarray) -> list[tuple[bytes, float]]:
    """The parts of a text that strings with a weight cover, as long as they are, and their weight."""
    held = _grams(text)
    if not len(held) or not len(grams):
        return []
    at = np.minimum(np.searchsorted(grams, held), len(grams) - 1)
    weighs = np.where(grams[at] == held, weight[at], 0.0)
    places = np.flatnonzero(weighs)
    out = []
    for part in np.split(places, np.flatnonzero(np.diff(places) > GRAM) + 1):
        if len(part):
            out.append((text[part[0] : part[-1] + GRAM], float(weighs[part].sum())))
    return out


def _toxic_content(toxic: DataFrame, grams: np.ndarray, weights: np.ndarray) -> list[bytes]:
    """What the toxic dictionary has in front, for each set of weights: the most telling at the end."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found: dict[tuple[int, bytes], list] = {}
            for text, fold in zip(frame["text"], frame["fold"]):
                for number, weight in enumerate(weights):
                    if number % (FOLDS + 1) != fold:
                        for part, much in stretches(normalised(text), grams, weight):
                            held = found.setdefault((number, part), [0, much])
                            held[0] += 1
            rows = [(number, part, times, much) for (number, part), (times, much) in found.items()]
            yield pd.DataFrame(rows, columns=["number", "part", "times", "weight"])

    parts = toxic.select("text", "fold").mapInPandas(of, "number int, part binary, times long, weight double")
    tells = parts.groupBy("number", "part").agg((F.sum("times") * F.max("weight")).alias("tells"))
    order = Window.partitionBy("number").orderBy(F.desc("tells"), "part")
    best = tells.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOXIC_BYTES // GRAM)
    out = [b""] * len(weights)
    for row in sorted(best.collect(), key=lambda r: (r["number"], r["rank"])):
        part, held = bytes(row["part"]), out[row["number"]]
        if len(held) + len(part) <= TOXIC_BYTES and part not in held:
            out[row["number"]] = part + held
    return out


def _ordinary_content(ordinary: DataFrame) -> bytes:
    """The words in most ordinary documents, WORD_BYTES of them, the most frequent at the end."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = Counter()
            for text in frame["text"]:
                found.update(set(normalised(text).split()))
            yield pd.DataFrame({"word": list(found), "docs": list(found.values())})

    words = ordinary.select("text").mapInPandas(of, "word binary, docs long")
    common = words.groupBy("word").agg(F.sum("docs").alias("docs")).orderBy(F.desc("docs"), "word")
    kept, held = [], 1
    for row in common.limit(WORD_BYTES // 2).collect():
        held += len(row["word"]) + 1
        if held > WORD_BYTES:
            break
        kept.append(bytes(row["word"]))
    return b" " + b" ".join(reversed(kept)) + b" "


def _calibration(sample: DataFrame, fronts: list[bytes], ordinary: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Savings of each document with the dictionary of the other folds, and its label; in one order."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        savings = [Savings(front, ordinary) for front in fronts[:FOLDS]]
        for frame in frames:
            rows = [savings[fold].features(x) for x, fold in zip(frame["text"], frame["fold"])]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype(str), "toxic": frame["toxic"], "features": rows})

    found = sample.mapInPandas(of, "doc_id string, toxic int, features array<double>").collect()
    rows = sorted((r["toxic"], r["doc_id"], r["features"]) for r in found)
    features = np.array([r[2] for r in rows]).reshape(len(rows), 4 + 2 * len(SAVED))
    return features, np.array([r[0] for r in rows], float)


def _fit(features: np.ndarray, toxic: np.ndarray) -> tuple[tuple[np.ndarray, ...], float]:
    """Mean, scale and weights, and the mean log loss they leave."""
    width = features.shape[1]
    if len(set(toxic.tolist())) < 2:
        share = float(toxic.mean()) if len(toxic) else 0.0
        odds = math.log(max(share, 1e-13) / max(1 - share, 1e-13))
        return (np.zeros(width), np.ones(width), np.r_[odds, np.zeros(width)]), 0.0
    mean, scale, weights = _fit_weights(features, toxic)
    odds = np.c_[np.ones(len(features)), (features - mean) / scale] @ weights
    return (mean, scale, weights), float(np.mean(np.logaddexp(0, np.where(toxic > 0, -odds, odds))))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> Model:
    """A model from ``labels (doc_id, toxic)``, of which held-out rows are not used.

    Fitted on TRAIN_TOXIC and TRAIN_ORDINARY documents at most, drawn by hash. Every one of them serves
    the dictionaries and the calibration: what it is judged with there comes from the other folds. How
    sure a string must be (CUTS) is chosen in the same way, by what calibration leaves unexplained.
    Several labels of a document count as the worst. With no usable label, or labels of one kind,
    every score is the share of toxic ones (0 for none). The same rows give the same model, however
    they are partitioned.
    """
    sample = cut(_sample(docs, labels, id, text))
    grams, weights = _weights(sample)
    fronts = _toxic_content(sample.filter("toxic = 1"), grams, weights)
    ordinary = _ordinary_content(sample.filter("toxic = 0"))

    fronts_of = [fronts[i : i + FOLDS + 1] for i in range(0, len(fronts), FOLDS + 1)]
    some = drawn(sample, sample.count(), CHOICE, 7, "doc_id")
    found = [_calibration(some, each, ordinary) for each in fronts_of]
    # The cut whose savings tell best; on a tie the strictest.
    loss = [_fit(*rows)[1] for rows in found]
    best = max(range(len(CUTS)), key=lambda i: (-loss[i], CUTS[i]))
    features, toxic = _calibration(sample, fronts_of[best], ordinary)
    return Model(fronts_of[best][-1], ordinary, *_fit(features, toxic)[0])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity double``, 0 to 1; an existing column of that name is replaced.

    Whole texts are scored; null counts as empty, which has a score too.
    """

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        savings = Savings(model.toxic, model.ordinary)
        for texts in batches:
            rows = np.array([savings.features(x) for x in texts])
            yield pd.Series(model.score(rows) if len(rows) else [], dtype="float64")

    return docs.withColumn("toxicity", F.pandas_udf(of, "double")(F.col(text)))


def judge(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row ``(doc_id, held_out, score, predicted)`` per row of ``docs``, repeated rows included."""
    rows = score(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), model)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches THRESHOLD."""
    of = score(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text")), model)
    return of.filter(F.col("toxicity") < THRESHOLD).select("row.*")
