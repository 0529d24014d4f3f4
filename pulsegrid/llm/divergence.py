"""How far the vocabularies of a language's sources are from each other, and in which terms.

Equal texts of a language are brought together first, with how often each source holds them; a text is
cut into terms once, and its counts are weighted. Pairs of sources then meet only in terms that both
hold: what terms of one alone, or of neither, add to a pair follows from the counts of each source.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.session import cut

#: Bytes of terms, A-Z lower-cased; all others part them. Bytes beyond ASCII are parts of characters.
AS_TERMS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()
LEAST_DOCS = 10  #: documents of a language that a term stands in, at least
UNIT = 1_000_000_000  #: shares are counted in units of one in so many
PRIOR = 2  #: occurrences that every kept term is taken to have besides its own
RANKS = 10  #: terms reported of each source
FLUSH = 1 << 22  #: terms a task reads before it passes their counts on


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A-Z lower-cased, of a text in UTF-8."""
    return text.translate(AS_TERMS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, source, term, n, docs)`` from ``(lang, text, sources)``, summed within a task."""
    n: dict[tuple[str, str], Counter[bytes]] = {}
    docs: dict[tuple[str, str], Counter[bytes]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for group, count in n.items():
            held = docs[group]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.repeat(pa.scalar(name, pa.string()), len(count)) for name in group),
                    pa.array(list(count), pa.binary()),
                    pa.array(list(count.values()), pa.int64()),
                    pa.array([held[term] for term in count], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        n.clear()
        docs.clear()

    read = 0
    for batch in batches:
        for lang, text, sources in zip(*(column.to_pylist() for column in batch.columns)):
            found = terms(text)
            for held in sources:
                group = lang, held["source"]
                if group not in n:
                    n[group], docs[group] = Counter(), Counter()
                if held["times"] == 1:
                    n[group].update(found)
                    docs[group].update(set(found))
                else:
                    for term, count in Counter(found).items():
                        n[group][term] += count * held["times"]
                        docs[group][term] += held["times"]
                read += len(found)
                if read >= FLUSH:
                    yield from out()
                    read = 0
    yield from out()


def _texts(docs: DataFrame, text: str, lang: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Distinct texts of each language with ``sources``, and all ``(lang, source)`` groups."""
    name = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(""))
    named = docs.select(
        name(lang).alias("lang"), name(source).alias("source"), name(text).alias("text")
    ).withColumn("digest", F.sha2(F.col("text"), 256))
    times = cut(named.groupBy("lang", "digest", "source").agg(F.count("*").alias("times")))
    held = times.groupBy("lang", "digest").agg(
        F.collect_list(F.struct("source", "times")).alias("sources")
    )
    # One text per digest: copies are dropped beside the scan, and the join needs no further shuffle.
    texts = named.filter("text <> ''").groupBy("lang", "digest").agg(F.first("text").alias("text"))
    both = texts.join(held, ["lang", "digest"]).select("lang", F.col("text").cast("binary"), "sources")
    return both, times.select("lang", "source").distinct()


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT (count + PRIOR) / (total + PRIOR kept)), exact; without kept terms of no use."""
    top = (count.cast("decimal(20,0)") + PRIOR).cast("decimal(21,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + kept.cast("decimal(20,0)") * PRIOR
    return F.call_function("div", top, F.greatest(below.cast("decimal(21,0)"), F.lit(1))) + 1


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are 1 to UNIT + 1, so that squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def _pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for all sources of a language, from the terms that they hold.

    The value starts as if no term occurred in either source. Each source's terms, counted by share,
    correct it as if they occurred in it alone; terms of both, where the two meet, correct that.
    """
    named = lambda rows, end: rows.select(*(F.col(c).alias(c if c in ("lang", "term") else c + end) for c in rows.columns))
    left, right = named(groups, "_a"), named(groups, "_b")
    zero = _apart(F.col("none_a"), F.col("none_b"))
    key = F.col("lang"), F.col("source_a"), F.col("source_b")
    empty = left.join(right, "lang").filter("source_a < source_b").select(*key, (F.col("kept_a") * zero).alias("value"))
    shares = held.groupBy("lang", "source", "none", "p").agg(F.count("*").alias("terms"))
    one = named(shares, "_a").join(right.select("lang", "source_b", "none_b"), "lang").filter("source_a <> source_b").select(
        F.col("lang"),
        F.least("source_a", "source_b").alias("source_a"),
        F.greatest("source_a", "source_b").alias("source_b"),
        (F.col("terms_a") * (_apart(F.col("p_a"), F.col("none_b")) - zero)).alias("value"),
    )
    met = held.select("lang", "term", "source", "none", "p")
    two = named(met, "_a").join(named(met, "_b"), ["lang", "term"]).filter("source_a < source_b").select(
        *key,
        (
            _apart(F.col("p_a"), F.col("p_b")) + zero
            - _apart(F.col("p_a"), F.col("none_b")) - _apart(F.col("none_a"), F.col("p_b"))
        ).alias("value"),
    )
    sums = [rows.groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value")) for rows in (empty, one, two)]
    total = sums[0].union(sums[1]).union(sums[2]).groupBy("lang", "source_a", "source_b").agg(
        F.sum("value").alias("value")
    )
    ways = F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                   F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))
    return total.select("lang", F.explode(ways).alias("way"), "value").select("lang", "way.source", "way.item", "value")


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    ranks: int = RANKS,
) -> DataFrame:
    """Rows ``(lang, source, part, item, value, rank)`` of two parts, per source of a language.

    Null texts, languages and sources count as empty strings. Terms (see ``terms``) in at least
    ``least_docs`` documents of a language are kept, for it and all its sources. With V of them, and N
    their occurrences, a term found n times has p = 1 + floor(UNIT (n + PRIOR) / (N + PRIOR V)).
    The distance of two shares is floor((p - q)^2 / (p + q)). All of it is exact.

    Part ``pair``: item is each other source of the language, value the distance summed over all kept
    terms (0 if there are none). Part ``term``: item is each term that the source holds and whose p is
    above the language's q, value their distance, the ``ranks`` largest only. Ranks fall with value, on
    ties by item. Repeated rows count each; a source alone in its language has no pairs; an empty table
    gives an empty result.
    """
    texts, groups = _texts(docs, text, lang, source)
    # Tasks have summed already. Dealt by term alone, a term's sources and its language's count meet
    # without another shuffle, and rare terms go no further.
    dealt = texts.mapInArrow(_count, "lang string, source string, term binary, n long, docs long").repartition(
        "lang", "term"
    )
    counts = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_lang = Window.partitionBy("lang", "term")
    found = cut(
        counts.withColumn("lang_n", F.sum("n").over(of_lang))
        .withColumn("lang_docs", F.sum("docs").over(of_lang))
        .filter(F.col("lang_docs") >= least_docs)
        .select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n")
    )
    langs = (
        found.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        .groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    )
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(
        0, ["kept", "lang_total", "total"]
    )
    none = _share(F.lit(0), F.col("total"), F.col("kept"))
    sizes = cut(sizes.withColumn("none", none))
    held = cut(
        found.join(sizes, ["lang", "source"]).select(
            "lang", "source", "term", "none",
            _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
            _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
        )
    )
    above = held.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")
    )
    telling = _ranked(above, "term").filter(F.col("rank") <= ranks)
    return _ranked(_pairs(held, sizes.select("lang", "source", "kept", "none")), "pair").unionByName(telling)
