"""The driver's contract for the training-data queries."""

import inspect
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent.parent))
from helpers import duck_rows, spark_rows  # noqa: E402

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from rtmart.llm import mixing, quality, queries as Q, simhash  # noqa: E402

ROOT = Path(__file__).parent.parent.parent


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()
    assert set(Q.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, sf_mid, name):
    assert spark_rows(E.queries()[name](spark, sf_mid)) == duck_rows(E.oracle_sql()[name], sf_mid)


def test_contract_columns(spark, sf_small):
    want = {
        "op1_url_filters": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string",
                            "verdict": "string"},
        "op3_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint",
                              "n_symbols": "bigint", "n_dup_lines": "bigint",
                              "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
        "op4_embedding_near_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint",
                                     "kept": "boolean"},
        "op5_secret_scans": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint",
                             "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
        "op6_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
        "op8_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint",
                       "target": "double", "taken": "bigint"},
        "op9_license_scans": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint",
                              "first_word": "bigint", "last_word": "bigint", "base_labels": "string",
                              "labels": "string", "score": "double"},
        "op11_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op12_filter_interaction_audit": {
            "part": "string", "filter_order": "string", "step": "int", "kept": "bigint", "removed": "bigint",
            "redundant": "bigint", "unique_fails": "bigint", "good_lost": "bigint", "toxic_lost": "bigint",
            "shapley": "bigint"},
        "op13_vector_code_compression": {"vec_id": "bigint", "code": "string", "error": "bigint",
                                         "label_error": "bigint", "codebooks_sha256": "string"},
        "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string",
                             "score": "double"},
    }
    for name, columns in want.items():
        found = dict(E.queries()[name](spark, sf_small).dtypes)
        assert columns.items() <= found.items(), name


@pytest.mark.parametrize("module", ["quality", "lines", "urls", "licenses"])
def test_native_operators_use_no_python_on_the_data(module):
    text = (ROOT / f"rtmart/llm/{module}.py").read_text()
    for word in ("udf", "mapInArrow", "mapInPandas", "applyInPandas", ".rdd", "numpy", "pandas", "pyarrow"):
        assert word not in text, word


def test_native_plans_have_no_python_nodes(spark, sf_small):
    for name in ("op1_url_filters", "op2_line_dedup", "op3_quality_rules", "op9_license_scans"):
        plan = E.queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_stages_keep_the_columns_and_take_effect(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "mixing",
                                        "packing"]
    rejected = quality.quality_rules(docs).where(~F.col("kept")).select("doc_id")
    for k, (name, stage) in enumerate(P.STAGES):
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = stage(spark, docs, sf_small)
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        if name == "quality rules":
            assert rejected.count() > 0
            assert out.join(rejected, "doc_id").count() == 0
            assert out.count() == docs.count() - rejected.count()
        if name == "simhash near-dedup":
            groups = simhash.near_groups(docs, 3, 3).select("root").distinct().count()
            assert out.count() == groups < docs.count()
        if name == "mixing":
            want = mixing.taken_words(docs).agg(F.sum("taken")).first()[0]
            words = F.size(F.filter(F.split("text", " "), lambda x: x != ""))
            assert out.agg(F.sum(words)).first()[0] == want
        if name == "packing":
            assert {"text", "n_tokens", "bucket_len", "batch", "slot"} <= set(out.columns)
        path = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/test-stage-{k}-{id(out)}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)


def test_pipeline_repeats_itself(spark, sf_small):
    first, again = (sorted(map(str, P.run(spark, sf_small).collect())) for _ in range(2))
    assert first == again and first


def test_the_rest_stands_without_the_subpackage(tmp_path):
    """A copy of the repository without the two folders and the pipeline still imports."""
    for f in ROOT.rglob("*.py"):
        part = f.relative_to(ROOT)
        if part.parts[:2] in (("rtmart", "llm"), ("tests", "llm")) or part.name == "corpus_pipeline.py" \
                or part.parts[0].startswith("."):
            continue
        target = tmp_path / part
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(f.read_text())
    code = "import __spark_entry__ as e; from pathlib import Path; " \
           f"assert Path(e.__file__).resolve().parent == Path({str(tmp_path)!r}).resolve(), e.__file__; " \
           "q = e.queries(); assert 'dau_total' in q and 'pipeline' not in q; " \
           "assert not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) == set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_oracles_run_on_an_empty_table():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    for sql in Q.oracle_sql().values():
        assert con.execute(sql).fetchall() == []
