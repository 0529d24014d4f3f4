"""The pipeline against the same steps done plainly, and all queries with SQL."""

from __future__ import annotations

import public_tokenizers
import pytest
from compare import connect, differences
from test_near_copies import closed, plain_fingerprint
from test_packing_tokens import check_pieces
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pulsegrid.llm import mixing, toxicity
from pulsegrid.llm.queries import llm_queries, llm_sql

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(llm_sql()))
def test_query_with_sql(spark, name):
    for sf_dir in ("/root/testdata/sf0.001", SF_DIR):
        assert differences(llm_queries()[name](spark, sf_dir), connect(sf_dir), llm_sql()[name]) == []


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm_queries())
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages(spark):
    """Each stage, on what the one before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    model = toxicity.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.judge(docs, model).collect() if r["score"] >= 0.7}
    rows = {r["doc_id"]: r for r in docs.collect()}
    want = rows.keys() - toxic

    stages = [stage for _, stage in corpus_pipeline.STAGES]
    clean = spark.createDataFrame(stages[0](spark, docs, SF_DIR).collect(), docs.schema)
    assert {r["doc_id"] for r in clean.collect()} == want and clean.columns == columns

    ids = sorted(want)
    prints = [plain_fingerprint(rows[i]["text"]) for i in ids]
    linked = [(i, j) for j in range(len(ids)) for i in range(j) if (prints[i] ^ prints[j]).bit_count() <= 2]
    want = {ids[x] for x in closed(len(ids), linked)}
    single = spark.createDataFrame(stages[1](spark, clean, SF_DIR).collect(), docs.schema)
    assert {r["doc_id"] for r in single.collect()} == want and single.count() == len(want)

    chosen = {r["row"]["doc_id"] for r in mixing.mix(single).collect() if r["chosen"]}
    mixed = spark.createDataFrame(stages[2](spark, single, SF_DIR).collect(), docs.schema)
    assert {r["doc_id"] for r in mixed.collect()} == chosen and 0 < len(chosen) < len(want)
    assert all(r == rows[r["doc_id"]] for r in mixed.collect())

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: library.encode(rows[i]["text"], add_special_tokens=False).ids + [0] for i in chosen}
    pieces = stages[3](spark, mixed, SF_DIR).collect()
    check_pieces(pieces, ids, 1024)
    assert {r["doc_id"] for r in pieces} == chosen


def test_run(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and "sequence_id" in found.columns


def test_run_writes_tokens(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(len(r["ids"]) == r["length"] for r in rows)


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, big ids, columns that clash."""
    big = 1 << 60
    prose = "the quick brown fox jumps over the lazy dog near the old river bank "
    rows = [(None, None, None, None, None, None), (big + 1, prose * 3000, "en", "a", 5, {"k": 1}), (big + 1, prose * 3000, "en", "a", 5, {"k": 1}),
            (big + 2, "", None, "a", None, None), (3, "one other text, unlike all of them here", "en", None, 1, {}), (4, None, "de", "b", 0, None)]
    schema = "doc_id long, text string, lang string, source string, kept_id int, row map<string,int>"
    labels = spark.createDataFrame([(3, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.schema.simpleString() == docs.schema.simpleString()
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.columns == docs.columns and empty.count() == 0
    once = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).select("doc_id", "row").collect()
    # Documents without words are one group; the row without an id stays beside it.
    assert sorted((r["doc_id"] or 0) for r in once) == [0, 3, 4, big + 1]
    pieces = corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {None, big + 1, big + 2, 3, 4}
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), str(tmp_path)).count() == 0
