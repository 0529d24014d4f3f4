"""Tables that take rows batch by batch, on any file system that Spark writes to.

A batch is staged in a folder of its own, by UTC date, and becomes part of the table when a manifest
that names it is put in place: one small file per version, of which the last holds. Readers see whole
batches only, a batch that is repeated changes nothing, and of rows with one key the last one counts.

    path/rows/batch=<name>/date=<day>/...    what a batch wrote, never changed
    path/manifest/<version>.json             the batches and dates that make up the table
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pulsegrid.functions.columns import utc_date

TRIES = 20  #: commits that other writers may get in before, until a writer gives up


class Taken(Exception):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Manifest:
    """One version of a table. ``batches``, in the order they were committed: name and dates."""

    version: int
    schema: dict
    ts: str
    keys: list[str]
    by: list[str]
    batches: list[dict] = field(default_factory=list)
    writers: dict[str, int] = field(default_factory=dict)  # the last batch number of each
    dropped: list[list] = field(default_factory=list)  # [version, folder] no longer read
    notes: dict = field(default_factory=dict)  # what writers want to remember with their batch

    @property
    def dates(self) -> list[str]:
        return sorted({day for batch in self.batches for day in batch["dates"]})


class _Files:
    """The few calls to the file system that Spark itself uses for a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)
        self.array = spark.sparkContext._gateway.new_array

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A file that appears whole, or not at all if it is there already."""
        staged = f"staged/{uuid.uuid4().hex}"
        out = self.fs.create(self._path(staged))
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.mkdirs(self._path(name).getParent())
        kinds = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            files.rename(self._path(staged), self._path(name), self.array(kinds, 0))
        except Exception as error:
            self.fs.delete(self._path(staged), False)
            if "FileAlreadyExistsException" in str(error):
                raise Taken(name) from None
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The table's last version; None before its first batch."""
    files = _Files(spark, path)
    found = sorted(name for name in files.names("manifest") if name.endswith(".json"))
    return Manifest(**json.loads(files.text(f"manifest/{found[-1]}"))) if found else None


def _commit(spark: SparkSession, path: str, after: Manifest) -> None:
    _Files(spark, path).put(f"manifest/{after.version:020d}.json", json.dumps(asdict(after)))


def _one_per_key(rows: DataFrame, keys: list[str], *order) -> DataFrame:
    """Of rows with one key, the first in the order given; ties by a hash of the whole row."""
    digest = F.xxhash64(F.to_json(F.struct(*rows.columns)))
    last = Window.partitionBy(*keys).orderBy(*order, digest)
    return rows.withColumn("place_in_key", F.row_number().over(last)).filter("place_in_key = 1").drop("place_in_key")


def _stage(rows: DataFrame, path: str, name: str, by: list[str], ts: str) -> list[str]:
    """Writes a batch's folder; returns its dates.

    Rows are brought together by folder, for few files; adaptive execution splits a folder that holds
    most rows among several tasks. Files are sorted by time, so that a time range skips most of them.
    """
    folder = f"rows/batch={name}"
    parts = ["date", *by]
    together = rows.hint("rebalance", *parts).sortWithinPartitions(*parts, ts)
    together.write.partitionBy(*parts).parquet(f"{path.rstrip('/')}/{folder}")
    names = _Files(rows.sparkSession, path).names(folder)
    return sorted(x.removeprefix("date=") for x in names if x.startswith("date="))


def upsert(
    rows: DataFrame,
    path: str,
    ts: str,
    keys: tuple[str, ...] = (),
    by: tuple[str, ...] = (),
    writer: str = "batch",
    number: int | None = None,
    notes: dict | None = None,
) -> bool:
    """Adds a batch to the table, which its first batch makes; False if the table has that batch.

    ``ts`` gives a row's UTC date, which with ``by`` makes the folders. Rows that share ``keys`` and
    date are one row: the last batch's; within a batch the newest by ``ts``, then any one, the same
    every time. Without keys every row stays. Batches of a ``writer`` are numbered upwards: a number
    not above its last is a repeated batch and adds nothing; without a number nothing is taken for
    repeated. Several writers may commit at once: each goes after those that were quicker. Null times
    have no date and make the write fail.
    """
    spark = rows.sparkSession
    before = manifest(spark, path)
    if before and number is not None and before.writers.get(writer, -1) >= number:
        return False
    dated = rows.withColumn("date", F.coalesce(utc_date(F.col(ts)), F.raise_error(F.lit("a row without a time")).cast("date")))
    if before:
        dated = dated.select(*T.StructType.fromJson(before.schema).names)
    if keys:
        dated = _one_per_key(dated, ["date", *keys], F.desc(ts))
    name = f"{writer}-{'x' if number is None else number}-{uuid.uuid4().hex}"
    dates = _stage(dated, path, name, list(by), ts)
    for _ in range(TRIES):
        now = manifest(spark, path) or Manifest(-1, dated.schema.jsonValue(), ts, list(keys), list(by))
        if number is not None and now.writers.get(writer, -1) >= number:
            return False
        after = replace(
            now,
            version=now.version + 1,
            batches=now.batches + ([{"name": name, "dates": dates}] if dates else []),
            writers=now.writers if number is None else now.writers | {writer: number},
            notes=now.notes | (notes or {}),
        )
        try:
            _commit(spark, path, after)
            return True
        except Taken:
            continue
    raise RuntimeError(f"{path}: other writers were quicker {TRIES} times")


def _rows(spark: SparkSession, path: str, held: Manifest, dates: list[str]) -> DataFrame:
    """Rows of ``dates``, one per key. A date that one batch alone wrote needs no shuffle."""
    schema = T.StructType.fromJson(held.schema)
    root = f"{path.rstrip('/')}/rows"
    writers = {day: [b["name"] for b in held.batches if day in b["dates"]] for day in dates}
    single = [day for day in dates if len(writers[day]) == 1 or not held.keys]

    def scan(days: list[str]) -> DataFrame:
        named = T.StructType([*schema, T.StructField("batch", T.StringType())])
        folders = [f"{root}/batch={name}/date={day}" for day in days for name in writers[day]]
        return spark.read.schema(named).option("basePath", root).parquet(*folders)

    out = scan(single).drop("batch") if single else None
    several = [day for day in dates if day not in set(single)]
    if several:
        order = [(batch["name"], place) for place, batch in enumerate(held.batches)]
        places = spark.createDataFrame(order, "batch string, place int")
        placed = scan(several).join(F.broadcast(places), "batch").drop("batch")
        last = _one_per_key(placed, ["date", *held.keys], F.desc("place")).drop("place")
        out = last if out is None else out.unionByName(last)
    return spark.createDataFrame([], schema) if out is None else out.select(*schema.names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last version, with ``date``; filters on date read those folders only."""
    held = manifest(spark, path)
    if held is None:
        raise FileNotFoundError(f"{path} has no manifest")
    return _rows(spark, path, held, held.dates)


def _without(held: Manifest, gone: dict[str, set[str]]) -> tuple[list[dict], list[list]]:
    """Batches without the dates ``gone`` from each, and the folders that no longer count."""
    batches, folders = [], []
    for batch in held.batches:
        lost = gone.get(batch["name"], set())
        kept = [day for day in batch["dates"] if day not in lost]
        folders += [[held.version + 1, f"rows/batch={batch['name']}/date={day}"] for day in batch["dates"] if day in lost]
        if kept:
            batches.append({"name": batch["name"], "dates": kept})
    return batches, folders


def compact(spark: SparkSession, path: str, least: int = 2) -> list[str]:
    """Brings the dates that ``least`` or more batches wrote into one folder each; returns them.

    Batches committed meanwhile go after the merged rows; dates dropped meanwhile stay dropped.
    """
    read_at = manifest(spark, path)
    if read_at is None:
        return []
    times = {day: sum(day in b["dates"] for b in read_at.batches) for day in read_at.dates}
    days = [day for day in read_at.dates if times[day] >= least]
    if not days:
        return []
    name = f"compact-{read_at.version}-{uuid.uuid4().hex}"
    _stage(_rows(spark, path, read_at, days), path, name, read_at.by, read_at.ts)
    merged = {batch["name"]: set(batch["dates"]) & set(days) for batch in read_at.batches}
    for _ in range(TRIES):
        now = manifest(spark, path)
        alive = {b["name"]: set(b["dates"]) for b in now.batches}
        # A day counts only if all that was merged for it is still there.
        kept = [d for d in days if all(d in alive.get(n, ()) for n, held in merged.items() if d in held)]
        batches, folders = _without(now, {n: held & set(kept) for n, held in merged.items()})
        known = [b["name"] for b in read_at.batches]
        place = sum(b["name"] in known for b in batches)
        if kept:
            batches.insert(place, {"name": name, "dates": kept})
        after = replace(now, version=now.version + 1, batches=batches, dropped=now.dropped + folders)
        try:
            _commit(spark, path, after)
            return kept
        except Taken:
            continue
    raise RuntimeError(f"{path}: other writers were quicker {TRIES} times")


def drop_before(spark: SparkSession, path: str, day: date) -> list[str]:
    """Takes whole dates before ``day`` out of the table, without reading a row; returns them.

    Their folders are deleted by ``clean``. Repeating it changes nothing.
    """
    for _ in range(TRIES):
        now = manifest(spark, path)
        old = {x for x in now.dates if date.fromisoformat(x) < day} if now else set()
        if not old:
            return []
        batches, folders = _without(now, {batch["name"]: old for batch in now.batches})
        after = replace(now, version=now.version + 1, batches=batches, dropped=now.dropped + folders)
        try:
            _commit(spark, path, after)
            return sorted(old)
        except Taken:
            continue
    raise RuntimeError(f"{path}: other writers were quicker {TRIES} times")


def clean(spark: SparkSession, path: str, versions: int = 0) -> int:
    """Deletes folders that the last ``versions`` + 1 versions do not read; returns how many.

    Jobs that began to read an older version fail if they still need them. What failed attempts at
    a numbered batch left behind goes as well, once that batch is in the table.
    """
    files, now = _Files(spark, path), manifest(spark, path)
    if now is None:
        return 0
    old = [folder for version, folder in now.dropped if version <= now.version - versions]
    names = {batch["name"] for batch in now.batches} | {f.split("/")[1].removeprefix("batch=") for _, f in now.dropped}
    for folder in files.names("rows"):
        name = folder.removeprefix("batch=")
        writer, number, _ = name.rsplit("-", 2)
        if name not in names and number.isdigit() and now.writers.get(writer, -1) >= int(number):
            old.append(f"rows/{folder}")
    for folder in old:
        files.delete(folder)
        batch = "/".join(folder.split("/")[:2])
        if not any(name.startswith("date=") for name in files.names(batch)):
            files.delete(batch)
    if old:
        left = [entry for entry in now.dropped if entry[1] not in set(old)]
        try:
            _commit(spark, path, replace(now, version=now.version + 1, dropped=left))
        except Taken:
            pass  # the folders stay listed, and a later call finds them gone
    return len(old)
