"""Near copies among embeddings by product quantisation with inverted lists.

Coarse lists hold vectors as codes of their residuals. A query reads the lists that may hold
links, sums distances from lookup tables, and reranks the rest by exact cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.cells import deal
from pulsegrid.llm.components import block_labels, components
from pulsegrid.llm.sampling import drawn
from pulsegrid.session import cut

MAX_LISTS = 4096
TRAIN_PER_LIST = 16  #: sampled vectors per coarse list, at least TRAIN_LEAST in all
TRAIN_LEAST = 4096
SUBSPACES = 8
CODES = 256
BLOCK = 1024  #: vectors a task compares with as many others
PAIRS = 1 << 16  #: pairs reranked at once
SLACK = 1e-6  #: more than rounding can change in the terms of a probe
VISITORS = 256  #: vectors whose visits are made at once: each may visit every list
DISTANCES = 1 << 22  #: distances held at once while centres are fitted


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``(vec_id, vec array<double>)`` of rows with an id and a finite vector other than zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    vec = F.col("vec")
    return (
        vectors.select(
            F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec")
        )
        .filter(F.col("vec_id").isNotNull() & vec.isNotNull())
        .filter(F.forall(vec, finite) & F.exists(vec, lambda x: x != 0.0))
    )


def stack(vectors: pd.Series, dim: int) -> np.ndarray:
    """Rows of a matrix; shorter vectors are padded with zeros."""
    if len(vectors) and all(len(v) == dim for v in vectors):
        return np.array(vectors.tolist(), np.float64)
    out = np.zeros((len(vectors), dim))
    for row, vec in zip(out, vectors):
        row[: len(vec)] = vec
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def squared(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    far = (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)
    return np.maximum(far, 0)


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, DISTANCES at a time."""
    step = max(1, DISTANCES // len(centres))
    parts = [squared(rows[i : i + step], centres).argmin(axis=1) for i in range(0, len(rows), step)]
    return np.concatenate(parts or [np.zeros(0, np.int64)])


def kmeans(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most ``k`` centres of the rows, the first rows at the start; empty ones stay."""
    centres = rows[:k].copy()
    for _ in range(rounds):
        near = nearest_centre(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        size = np.bincount(near, minlength=len(centres))
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


class Quantiser:
    """Coarse centres and, per subspace, the centres of residual parts."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.centres = kmeans(sample, lists)
        residual = sample - self.centres[nearest_centre(sample, self.centres)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [kmeans(np.ascontiguousarray(residual[:, p]), CODES) for p in self.parts]

    def encode(self, rows: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each row is from what its code stands for."""
        residual = rows - self.centres[home]
        codes = np.empty((len(rows), len(self.parts)), np.uint8)
        for m, (p, book) in enumerate(zip(self.parts, self.books)):
            codes[:, m] = squared(residual[:, p], book).argmin(axis=1)
            residual[:, p] -= book[codes[:, m]]
        return codes, np.linalg.norm(residual, axis=1)

    def between(self) -> np.ndarray:
        """Distances of all centres to each other: at most MAX_LISTS squared, made once by a task."""
        return np.sqrt(squared(self.centres, self.centres))

    def probes(self, between: np.ndarray, home: np.ndarray, far: np.ndarray, reach: float) -> np.ndarray:
        """Which lists' halves a ball of radius ``reach`` round each row touches.

        A list's members are nearer to its centre than to the row's own: they lie beyond the
        plane midway, whose distance from the row is compared with ``reach`` (and SLACK, as the
        rounding of a distance must not hide a list).
        """
        own = far[np.arange(len(far)), home][:, None]
        return far - own <= 2 * between[home] * reach + SLACK

    def lookup(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distances of all queries to the coded members of a list, summed from tables."""
        residual = queries - self.centres[cell]
        total = np.zeros((len(queries), len(codes)), np.float32)
        for m, (p, book) in enumerate(zip(self.parts, self.books)):
            table = squared(residual[:, p], book).astype(np.float32)
            total += table[:, codes[:, m]]
        return np.sqrt(total)


def _visits(quantiser: Quantiser, dim: int, reach: float, number: str):
    """Each vector in its own list, coded, and as a query in the other lists it probes.

    ``number`` is the numpy type in which vectors travel without loss. ``probed`` holds the lists a
    vector probes where it is at home, and its own list where it is a query.
    """
    schema = (
        "cell int, home boolean, vec_id long, copies long, vec binary, code binary, error double, "
        "probed binary"
    )
    step = min(VISITORS, max(1, (1 << 22) // len(quantiser.centres)))

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        between = quantiser.between()
        for frame in frames:
            for i in range(0, len(frame), step):
                part = frame.iloc[i : i + step]
                whole = stack(part["vec"], dim)
                vecs = [v.tobytes() for v in whole.astype(number)]
                rows = unit(whole)
                far = squared(rows, quantiser.centres)
                home = far.argmin(axis=1)
                near = quantiser.probes(between, home, far, reach)
                near[np.arange(len(rows)), home] = True
                row, cell = near.nonzero()
                others = [x.nonzero()[0].astype("<i4").tobytes() for x in near]
                own = [x.tobytes() for x in home.astype("<i4")]
                codes, error = quantiser.encode(rows, home)
                yield pd.DataFrame(
                    {
                        "cell": cell.astype(np.int32),
                        "home": cell == home[row],
                        "vec_id": part["vec_id"].to_numpy()[row],
                        "copies": part["copies"].to_numpy()[row],
                        "vec": [vecs[r] for r in row],
                        "code": [codes[r].tobytes() for r in row],
                        "error": error[row],
                        "probed": [others[r] if home[r] == c else own[r] for r, c in zip(row, cell)],
                    }
                )

    return of, schema


def _links_of_block(quantiser: Quantiser, dim: int, least: float, number: str):
    """Counts the links within a task and gives each vector its block's smallest linked one.

    Two vectors that probe each other's lists meet in both; they count in the earlier list.
    """
    radius = math.sqrt(2 - 2 * least)

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        alone = frame["first"].iat[0] == frame["second"].iat[0]
        own = (frame["own"] == frame["first"]).to_numpy()
        order = np.lexsort((frame["vec_id"].to_numpy(), ~own))
        frame = frame.iloc[order]
        keys, copies = frame["vec_id"].to_numpy(), frame["copies"].to_numpy()
        rows = np.frombuffer(b"".join(frame["vec"]), number).reshape(len(frame), dim)
        rows = unit(rows.astype(np.float64))
        members = len(frame) if alone else int(own.sum())
        codes = np.frombuffer(b"".join(frame["code"].iloc[:members]), np.uint8).reshape(members, -1)
        slack = frame["error"].to_numpy()[:members] + radius + 1e-4  # tables are single precision
        start = 0 if alone else members
        cell = int(frame["cell"].iat[0])
        if not alone:
            lists = [np.frombuffer(x, "<i4") for x in frame["probed"]]
            back = np.zeros((members, len(quantiser.centres)), bool)
            for x, seen in zip(back, lists):
                x[seen] = True
            back[:, cell:] = False  # met in a later list too: counted here
            homes = np.concatenate(lists[members:] or [np.zeros(0, np.int32)])
        links, pairs = np.zeros(len(frame), np.int64), ([], [])
        for i in range(start, len(frame), 256):
            queries = rows[i : i + 256]
            q, m = (quantiser.lookup(queries, cell, codes) <= slack).nonzero()
            q += i
            if alone:
                q, m = q[m < q], m[m < q]
            else:
                first = ~back[m, homes[q - members]]
                q, m = q[first], m[first]
            for j in range(0, len(q), PAIRS):
                x, y = q[j : j + PAIRS], m[j : j + PAIRS]
                near = np.einsum("ij,ij->i", rows[x], rows[y]) >= least
                x, y = x[near], y[near]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                pairs[0].append(x)
                pairs[1].append(y)
        none = [np.zeros(0, np.int64)]
        label = block_labels(len(frame), *(np.concatenate(p or none) for p in pairs))
        found = links > 0
        return pd.DataFrame(
            {"vec_id": keys[found], "links": links[found], "low": keys[label[found]]}
        )

    return of


def fit(vectors: DataFrame, lists: int | None = None) -> tuple[Quantiser, int] | None:
    """A quantiser for ``vectors (vec_id, vec)`` and their dimension; None if there are none.

    Fitted on TRAIN_PER_LIST vectors a list (TRAIN_LEAST at least, 65 536 at most), drawn by hash.
    By default there are as many lists as the root of the number of vectors, MAX_LISTS at most.
    """
    found = vectors.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not found[0]:
        return None
    wanted = lists or min(MAX_LISTS, math.isqrt(found[0]))
    size = max(TRAIN_LEAST, TRAIN_PER_LIST * wanted)
    some = drawn(vectors, found[0], size, 11, "vec_id").select("vec")
    sample = unit(stack(some.toPandas()["vec"], found[1]))
    return Quantiser(sample, max(1, wanted)), found[1]


def near_copies(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    least: float = 0.95,
    reach: float = 0.5,
    lists: int | None = None,
) -> DataFrame:
    """One row ``(vec_id, n_links, component_id, kept)`` per row of ``vectors``.

    Two vectors link if their cosine, in double precision, is at least ``least``. Lists are probed
    out to ``reach`` of the distance that two linked unit vectors can have. From 0.5 on every link
    is found by proof: the way from one vector to the other crosses the plane midway between their
    lists' centres, so one of them is no farther from it than half the way, and probes the other's
    list. Below, links are missed. Within a probed list nothing is lost: a code's known error is
    added to the distance.

    Rows whose vector is null, zero or holds null or non-finite components, and rows with a null
    id, link with nothing: no links, a component of their own. Shorter vectors count as padded
    with zeros. Equal vectors are compared once; repeated rows count as vectors of their own.
    """
    rows = vectors.select(F.col(id).alias("vec_id"), F.col(vector).alias("embedding"))
    good = usable(rows, "vec_id", "embedding")
    distinct = cut(
        good.groupBy("vec").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    )
    fitted = fit(distinct.select(F.col("least_id").alias("vec_id"), "vec"), lists)
    if fitted is None:
        return rows.select(
            "vec_id",
            F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    quantiser, dim = fitted
    radius = math.sqrt(2 - 2 * least)
    single = vectors.schema[vector].dataType.elementType.simpleString() == "float"
    number = "<f4" if single else "<f8"
    of, schema = _visits(quantiser, dim, reach * radius, number)
    visits = cut(
        distinct.select(F.col("least_id").alias("vec_id"), "copies", "vec").mapInPandas(of, schema)
    )
    found = cut(
        deal(visits, "vec_id", BLOCK)
        .groupBy("cell", "first", "second")
        .applyInPandas(
            _links_of_block(quantiser, dim, least, number), "vec_id long, links long, low long"
        )
    )
    counts = found.groupBy(F.col("vec_id").alias("least_id")).agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("vec_id").alias("a"), F.col("low").alias("b")))
    known = (
        distinct.join(counts, "least_id", "left")
        .join(classes.withColumnRenamed("node", "least_id"), "least_id", "left")
        .select(
            F.col("vec").alias("known"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "least_id").alias("component_id"),
        )
    )
    # A vector that links with nothing finds no row here: null equals nothing.
    key = F.when(F.col("vec_id").isNotNull(), F.col("embedding").cast("array<double>"))
    return (
        rows.join(known, key == F.col("known"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
