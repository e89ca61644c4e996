"""Workers that lack the package, and the licence classifier's say in its results."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import numpy as np
from lendscape.llm import licences

ROOT = Path(__file__).parents[2]
RUN = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})  # for the driver only
from lendscape.session import local_session
from lendscape.llm import registry
spark = local_session("workers", 4, partitions=4)
spark.sparkContext.setLogLevel("ERROR")

def known(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("lendscape") is not None]}})

assert not spark.range(1).mapInArrow(known, "found boolean").first()[0]
for name in sys.argv[2:]:
    assert registry.QUERIES[name](spark, sys.argv[1]).count() > 0
print("all ran")
"""


def test_queries_run_where_workers_lack_the_package(sf_dir, tmp_path):
    names = ["op1_near_duplicates", "op5_licences", "op6_packing", "op7_warc", "op8_fingerprints", "op9_token_counts", "op11_collocations", "op12_spelling"]
    run = subprocess.run([sys.executable, "-c", RUN, sf_dir, *names], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "all ran" in run.stdout, run.stderr[-3000:]


def test_licences_go_through_the_classifier(spark):
    rows = [(i, f"about words {texts[0]} and more words") for i, texts in enumerate(licences.NOTICES.values())]
    docs = spark.createDataFrame([*rows, (99, "plain words of the work")], "doc_id long, text string")
    model = licences.train(docs)
    found = {r["doc_id"]: r["licences"] for r in licences.scan(docs, model).collect()}
    assert [found[i] for i in range(len(rows))] == list(licences.NOTICES) and found[99] == ""
    model.weights, model.intercepts = np.zeros_like(model.weights), np.zeros_like(model.intercepts)
    assert {r["licences"] for r in licences.scan(docs, model).collect()} == {""}
