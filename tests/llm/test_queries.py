"""The registered queries: against SQL where there is some, else for their contracts."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from shelfwise.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import bag

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, sql, name):
    got = contract.queries()[name](spark, SF_DIR)
    expected = sql.execute(f"SELECT {', '.join(got.columns)} FROM ({contract.oracle_sql()[name]})").fetchall()
    assert bag(got) == sorted(map(tuple, expected), key=repr)


COLUMNS = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_decontaminate": {
        "doc_id": "bigint",
        "n_words": "bigint",
        "n_hit": "bigint",
        "n_items": "bigint",
        "items_sha256": "string",
        "contaminated": "boolean",
    },
    "op3_best_fit_packing": {
        "doc_id": "bigint",
        "piece": "int",
        "start": "bigint",
        "length": "bigint",
        "ids_crc32": "bigint",
        "sequence_id": "bigint",
        "offset": "bigint",
    },
    "op4_warc": {
        "page_id": "bigint",
        "payload_bytes": "bigint",
        "payload_digest": "string",
        "record_type": "string",
        "refers_to": "bigint",
    },
    "op6_exact_dedup": {
        "doc_id": "bigint",
        "keep_id": "bigint",
        "group_size": "bigint",
        "kept": "boolean",
        "text_sha256": "string",
    },
    "op8_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op9_lm_score": {
        "doc_id": "bigint",
        "held_out": "boolean",
        "n_tokens": "bigint",
        "n_known": "bigint",
        "train_tokens": "bigint",
        "base_score": "double",
        "score": "double",
    },
    "op10_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_spelling_variants": {
        "word": "string",
        "form": "string",
        "root": "string",
        "n": "bigint",
        "n_near": "bigint",
        "form_n": "bigint",
    },
    "op12_url_filters": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op13_collocations": {
        "lang": "string",
        "rank": "bigint",
        "phrase": "string",
        "a": "bigint",
        "l": "bigint",
        "r": "bigint",
        "n": "bigint",
        "score": "bigint",
    },
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    assert dict(contract.queries()[name](spark, SF_DIR).dtypes) == COLUMNS[name]


def test_language_model_beats_the_unigrams_on_held_out_documents(spark):
    rows = contract.queries()["op9_lm_score"](spark, "/root/testdata/sf0.01").collect()
    held_out = [r for r in rows if r["held_out"]]
    assert len(held_out) > 100
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "line_dedup",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "best_fit_packing",
    ]
    rows, columns = docs, docs.columns
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF_DIR)
        assert rows.columns == columns
        counts.append(rows.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 50
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in rows.collect()}


def test_pipeline_stages_take_odd_and_empty_tables(spark):
    from tests.llm.helpers import documents, odd_documents, with_clashes

    clashing = with_clashes(odd_documents(spark), "hits", "removed_lines", "digest", "label")
    for docs in (documents(spark, []), clashing):
        rows = docs
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF_DIR)
            rows.count()
