"""The pipeline's contract, and the entry without this subpackage."""

import os
import re
import shutil
import subprocess
import sys

import corpus_pipeline
from logweave.llm import queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = before = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [r[0] for r in docs.select("doc_id").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), before.schema)
        left = [r[0] for r in docs.select("doc_id").collect()]
        assert docs.columns == before.columns and set(left) <= set(ids), name
        assert len(left) == len(set(left)) > 0.3 * len(ids), name
        ids = left
    cards = [t for (t,) in docs.select("text").collect() if re.search(r"\b4[0-9]{15}\b", t)]
    old = {r.doc_id: r.text for r in before.collect()}
    new = {r.doc_id: r.text for r in docs.collect()}
    assert any(new[i] != old[i] for i in new) and len(cards) < sum(bool(re.search(r"\b4[0-9]{15}\b", old[i])) for i in new) + 3
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(ids)
    ran = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in ran.collect()} == set(ids)


def test_numbered_operators():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_entry_without_the_subpackage(tmp_path):
    for name in ("logweave", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        copy = shutil.copytree if os.path.isdir(source) else shutil.copy
        copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1_') for n in q), 'pipeline' in q)"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)}).stdout.split()
    n = run()
    assert n[1:] == ["False", "False"]  # no pipeline module, no llm queries
    shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    assert run() == [str(int(n[0]) + 14), "True", "True"]
    shutil.rmtree(tmp_path / "logweave" / "llm")
    assert run() == n
