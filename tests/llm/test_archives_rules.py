"""WARC archives there and back, and url rules against a plain loop."""

from __future__ import annotations

import hashlib
import random

import pytest
import zstandard

from pulsegrid.llm import urls, warc


def test_round_trip(spark, tmp_path):
    long = "<p>ünïcode</p>\r\n\r\n" * 20
    rows = [(5, "http://a/ b\n", long), (2, None, long), (9, "x", long), (3, "u", "short"), (4, "u", "short"),
            (6, "u", None), (7, "u", ""), (None, "u", long), (None, "u", "only without an id" * 9), (8, "u", "z" * 300000), (8, "u", "z" * 300000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "'x' AS digest")
    path = str(tmp_path / "archive")
    got = warc.archive(pages.repartition(3), path=path, payloads=True).collect()
    assert len(got) == len(rows)
    of = {}
    for r in got:
        of.setdefault(r["page_id"], []).append(r)
    for id, _, html in rows:
        data = (html or "").encode()
        assert any(r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha256(data).hexdigest()
                   and (r["record_type"] == "revisit" or bytes(r["payload"]) == data) for r in of[id])
    kinds = {i: {(r["record_type"], r["refers_to"]) for r in of[i]} for i in of}
    assert kinds[2] == {("response", None)} and kinds[5] == kinds[9] == {("revisit", 2)}
    assert kinds[None] == {("revisit", 2), ("response", None)}
    assert kinds[3] == kinds[4] == kinds[6] == kinds[7] == kinds[8] == {("response", None)}
    assert of[5][0]["url"] == "http://a/%20b%0A" and of[2][0]["url"] is None
    # A plain Zstandard reader that knows of skippable frames reads the same records.
    files = list(tmp_path.glob("archive/archive=*/part-*"))
    assert files
    for file in files:
        data = file.read_bytes()
        assert data[:4] == warc.DICTIONARY_FRAME
        assert sum(1 for _ in warc.parse(data)) >= 1
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.parse(data[:-20]))


BIG = 1 << 60


def test_archives_end_at_a_size_and_name_their_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    draw = random.Random(3)
    body = lambda: "<html>" + "".join(chr(draw.randint(32, 1000)) for _ in range(400))
    same = body()
    rows = [(BIG + i, f"http://h/{i}", same if i % 3 == 0 else body()) for i in range(1, 40)] + [(None, "http://h/", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = {r["page_id"]: r for r in warc.archive(pages, path=str(tmp_path / "a"), date="2024-05-06T07:08:09Z").collect()}
    assert set(got) == {i for i, _, _ in rows}  # ids of 61 bits, beside a null
    first = BIG + 3
    assert {i for i in got if got[i]["refers_to"] == first} == {None, *(BIG + i for i in range(6, 40, 3))}
    files = list(tmp_path.glob("a/archive=*/part-*"))
    assert len(files) >= 6
    names, revisits = {}, []
    for file in files:
        data = file.read_bytes()
        assert data[:4] == warc.DICTIONARY_FRAME
        for headers, payload in warc.parse(data):
            assert headers["WARC-Date"] == "2024-05-06T07:08:09Z"
            names[headers["WARC-Record-ID"]] = headers
            revisits += [headers] if headers["WARC-Type"] == "revisit" else []
            assert (payload == b"") == (headers["WARC-Type"] == "revisit")
    assert len(names) == len(rows) and len(revisits) == 13
    assert {names[h["WARC-Refers-To"]]["X-Page-ID"] for h in revisits} == {str(first)}


def test_dictionary_holds_what_records_repeat(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i}") for i in range(300)], "page_id long, url string, html string")
    warc.archive(pages.coalesce(1), path=str(tmp_path / "a"))
    data = next(tmp_path.glob("a/archive=*/part-*")).read_bytes()
    assert b"/http; msgtype=response" in data[: 8 + int.from_bytes(data[4:8], "little")]


def test_big_page_ids_beside_a_null(spark):
    rows = [(BIG + 1, "http://a.net/"), (None, None), (BIG + 2, "http://b.org/fr/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").coalesce(1)
    got = urls.judge(pages, urls.rules_table(spark, [("block", "net/")]))
    assert got.schema["page_id"].dataType.simpleString() == "bigint"
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {BIG + 1: "block", None: "allow", BIG + 2: "allow"}


def test_empty_archive(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(pages).count() == 0
    none = spark.createDataFrame([(1, None, None)], "page_id long, url string, html string")
    row = warc.archive(none).collect()[0]
    assert (row["page_id"], row["payload_bytes"], row["record_type"]) == (1, 0, "response")


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = []
    for verdict, rule in rules:
        if rule is None or verdict is None or not rule.split("/")[0]:
            continue
        name, _, tail = rule.partition("/")
        start = rule[len(name) :]
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            fits.append((len(rule), len(name), verdict == "block", rule, verdict))
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_rules(spark, partitions):
    draw = random.Random(8)
    labels, parts = ["a", "b", "net", "org", "example", "x-y"], ["", "/", "/en", "/en/", "/en/x", "/e", "/en/xy/z"]
    host = lambda: ".".join(draw.choices(labels, k=draw.randint(1, 4)))
    rules = [(draw.choice(["allow", "block"]), host() + draw.choice(parts)) for _ in range(60)]
    rules += [("block", None), (None, "a/"), ("allow", "/en/"), ("block", "net"), ("allow", "net")]
    some = [f"http://{host().upper()}{draw.choice(parts)}{draw.choice(['', '?a=://b', '#c'])}" for _ in range(300)]
    some += [None, "", "no scheme/en/", "http://", "://net/en/", "http://net", "http://NET/en/x?y"] + ["http://a.net/en/x"] * 400
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        pages = spark.createDataFrame(list(enumerate(some)), "page_id long, url string").selectExpr("*", "1 AS part", "'k' AS key")
        got = urls.judge(pages, urls.rules_table(spark, rules)).collect()
        assert urls.judge(pages.limit(0), urls.rules_table(spark, rules)).count() == 0
        assert {r["verdict"] for r in urls.judge(pages, urls.rules_table(spark, [])).collect()} == {"allow"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(some)
    assert found == {i: plain(u, rules) for i, u in enumerate(some)}
