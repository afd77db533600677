"""The queries against their SQL, the pipeline against a brute-force version, and the import guard's other side."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

import check
import corpus_pipeline
from tidemark.llm import bpe_tree, feistel, sql
from tidemark.llm.queries import QUERIES, SQL, VOCABULARY

ROOT = Path(__file__).resolve().parents[2]


def test_all_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} and names >= {*QUERIES, "pipeline"}
    assert set(SQL) < set(QUERIES) and [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality rules", "near duplicates"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, name):
    ok, message, rows, _ = check.compare(spark, check.database(sf), name, QUERIES[name], SQL[name], sf)
    assert ok and rows, message


def test_encoding_query_matches_the_library(spark, sf):
    import hashlib

    enc = bpe_tree.encoder(VOCABULARY).tokenizer
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in QUERIES["op4_bpe_tree"](spark, sf).collect():
        ids = enc.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(enc.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_matches_brute_force(spark, sf):
    con = duckdb.connect()
    documents = con.execute(f"SELECT * FROM '{sf}/documents.parquet'").df()
    con.register("documents", documents)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.REPETITION}) WHERE kept").fetchall()}
    documents = documents[documents["doc_id"].isin(kept)].reset_index(drop=True)
    con.register("documents", documents)
    first = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.NEAR_DUPLICATES}) WHERE doc_id = component_id").fetchall()}
    documents = documents[documents["doc_id"].isin(first)].reset_index(drop=True)
    documents["text"] = [feistel.pseudonymised(feistel.KEY, t)[0] for t in documents["text"]]
    con.register("documents", pd.DataFrame(documents))
    times = Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.BUDGETS})").fetchall())
    enc = bpe_tree.encoder(VOCABULARY).tokenizer
    texts = dict(zip(documents["doc_id"], documents["text"], strict=True))
    want = Counter({(k, tuple(enc.encode(texts[k], add_special_tokens=False).ids)): n for k, n in times.items()})
    got = Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want and 0 < len(got) < 200


def test_stages_return_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_entry_imports_without_the_subpackage():
    code = ("import sys; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; names = e.queries(); assert 'op1_suffix_repetition' not in names and len(names) > 150")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True).returncode == 0
