"""WARC archives of Zstandard frames, one per record, with a dictionary in front.

An archive starts with a skippable frame that holds the dictionary; each record is a frame of its
own. Spark's text writer puts SEPARATOR after every row: an empty skippable frame, which readers
pass over, so that what it writes is a valid archive, on any file system that Spark writes to and
under its commit protocol.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.llm.sampling import drawn
from pulsegrid.session import shared_dir

# The format's frame numbers.
DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
SEPARATOR_FRAME = (0x184D2A50).to_bytes(4, "little") + bytes(4)
RECORD_FRAME = (0xFD2FB528).to_bytes(4, "little")

SAMPLE_ROWS = 2000  #: records the dictionary is trained on, drawn by hash
SAMPLE_BYTES = 4096  #: of each, its first: headers, and the beginning of the page
ARCHIVE_BYTES = 64 << 20  #: compressed, at which an archive ends and the next begins
DICTIONARY_BYTES = 64 << 10
LEAST_BYTES = 100  #: payloads from this size on are stored once
LEVEL = 6
STEP = 1 << 16  #: bytes given to the decompressor at a time


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary of at most DICTIONARY_BYTES; the samples themselves if they are too few."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, payloads).as_bytes()
    except zstandard.ZstdError:
        return b"".join(payloads)[-DICTIONARY_BYTES:]


def records(pages: DataFrame, id: str, url: str, payload: str) -> DataFrame:
    """Pages with their payload's digest, and what each record is to be.

    Of equal payloads of LEAST_BYTES or more, those with the smallest id are responses.
    """
    body = F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload")
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    again = (
        rows.filter(F.col("payload_bytes") >= LEAST_BYTES)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("original"), F.count("*").alias("rows"))
        .filter("rows > 1")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("original"))
    return rows.join(again, rows["payload_digest"] == again["digest"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(later, F.col("original")).alias("refers_to"),
    )


def _record_id(page_id: str | None, digest: str) -> str:
    """Made from the content, so that a task run again writes the same record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _record(row, date: str) -> bytes:
    """A page's record: the answer of a web server, of which a revisit holds the head only."""
    revisit = row["refers_to"] is not None
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    body = answer.encode() + (b"" if revisit else row["payload"])
    named = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(row["page_id"], row["payload_digest"])),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(body)),
    ]
    if row["page_id"] is not None:
        named.append(("X-Page-ID", row["page_id"]))
    if row["url"] is not None:
        plain = "".join(
            c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"]
        )
        named.append(("WARC-Target-URI", plain))
    if revisit:
        named.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        named.append(("WARC-Refers-To", _record_id(row["refers_to"], row["payload_digest"])))
        named.append(("X-Refers-To-Page", row["refers_to"]))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def _as_text(rows: DataFrame) -> DataFrame:
    """Ids as text: digits are all that a record needs of them."""
    return rows.withColumns({name: F.col(name).cast("string") for name in ("page_id", "refers_to")})


def write(rows: DataFrame, path: str, dictionary: bytes, date: str) -> None:
    """Archives of ``rows`` (as of records()) in folders of ``path``, each of about ARCHIVE_BYTES."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if prior:
            prior.precompute_compress(level=LEVEL)
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=prior)
        lead = DICTIONARY_FRAME + len(dictionary).to_bytes(4, "little") + dictionary
        archive, place, size = 0, 0, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                frame = writer.compress(_record(row, date))
                if size and size + len(frame) > ARCHIVE_BYTES:
                    archive, place, size = archive + 1, 0, 0
                out.append((archive, place, frame if size else lead + frame))
                place, size = place + 1, size + len(frame)
            columns = zip((pa.int64(), pa.int64(), pa.binary()), zip(*out) if out else ((), (), ()))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for kind, x in columns], ["archive", "place", "frame"])

    frames = _as_text(rows).mapInArrow(of, "archive long, place long, frame binary")
    # The order that the writer needs to part archives, and that keeps each one's dictionary in front.
    ordered = frames.sortWithinPartitions("archive", "place").select("archive", F.col("frame").cast("string"))
    ordered.write.partitionBy("archive").option("lineSep", SEPARATOR_FRAME.decode("ascii")).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of every record of an archive, in order; X-Payload-Length is from its answer.

    Raises ValueError if a frame, a record or a payload is not what it says it is.
    """
    at, view, prior = 0, memoryview(data), None
    while at < len(data):
        kind, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if kind != RECORD_FRAME:
            if not 0x184D2A50 <= int.from_bytes(kind, "little") <= 0x184D2A5F:
                raise ValueError(f"no frame at {at}")
            if kind == DICTIONARY_FRAME and size:
                prior = zstandard.ZstdCompressionDict(data[at + 8 : at + 8 + size])
            at += 8 + size
            continue
        reader = zstandard.ZstdDecompressor(dict_data=prior).decompressobj()
        parts, end = [], at
        while not reader.eof:
            if end >= len(data):
                raise ValueError(f"frame at {at} is cut off")
            parts.append(reader.decompress(view[end : end + STEP]))
            end += STEP
        at = min(end, len(data)) - len(reader.unused_data)
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        answer, _, payload = body[:length].partition(b"\r\n\r\n")
        if version != "WARC/1.1" or body[length:] != b"\r\n\r\n" or not answer.startswith(b"HTTP/1.1 "):
            raise ValueError("not a WARC record")
        sizes = [x for x in answer.decode().split("\r\n") if x.startswith("Content-Length: ")]
        headers["X-Payload-Length"] = sizes[0].split(": ")[1]
        if headers["WARC-Type"] == "response":
            digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
            if digest != hashlib.sha256(payload).hexdigest():
                raise ValueError(f"payload of {headers['WARC-Record-ID']} has another digest")
        yield headers, payload


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record of the archives in ``path``, in any order; digests of payloads are checked."""
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long" + ", payload binary" * payloads
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["content"]:
                rows: list[tuple] = []
                held = 0
                for headers, payload in parse(data.as_py()):
                    number = lambda name: int(headers[name]) if name in headers else None
                    row = (
                        number("X-Page-ID"),
                        headers.get("WARC-Target-URI"),
                        number("X-Payload-Length"),
                        headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                        headers["WARC-Type"],
                        number("X-Refers-To-Page"),
                    )
                    rows.append((*row, payload) if payloads else row)
                    held += len(payload) if payloads else 0
                    if len(rows) >= 5000 or held >= 1 << 24:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(x, kinds[kind]) for x, (_, kind) in zip(zip(*rows), fields)]
        return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("content").mapInArrow(of, schema)


def archive(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    path: str | None = None,
    payloads: bool = False,
    date: str | None = None,
) -> DataFrame:
    """Writes a record per page to archives in ``path`` and reads them back.

    Returns page_id, url, payload_bytes, payload_digest, record_type and refers_to, and with
    ``payloads`` what the records hold. By default the archives go to the shared folder and their
    records are dated now. The dictionary is trained on SAMPLE_ROWS records as they are written.

    Of records with equal payloads of LEAST_BYTES or more, that with the smallest page_id is a
    response and the others revisit it; smaller payloads are all responses. A null payload is
    empty. Repeated rows with that smallest id are responses each; rows with a null id follow any
    id, and are responses if no row with their payload has one. White space and control characters
    of urls are percent-encoded, a null url has no header. An empty table gives an empty result.
    """
    path = path or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = records(pages, id, url, payload)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [_record(row, date)[:SAMPLE_BYTES] for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary())], ["head"])

    named = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("body"))
    some = drawn(named, pages.count(), SAMPLE_ROWS, 13, "page_id", "url")
    heads = _as_text(records(some, "page_id", "url", "body")).mapInArrow(first, "head binary").collect()
    write(rows, path, train_dictionary(sorted(bytes(r["head"]) for r in heads)), date)
    return read(pages.sparkSession, path, payloads)
