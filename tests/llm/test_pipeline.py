from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline as P
from rovelog.llm import packing
from rovelog.llm.common import stored
from rovelog.llm.quality import op2_quality_qda
from tests.llm import test_minhash

REPO = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in P.STAGES:
        out = stored(stage(spark, docs, SF))
        if name != "packing":
            assert out.columns == columns
        kept.append((name, docs, out))
        docs = out
    by_name = {name: (before.collect(), after.collect()) for name, before, after in kept}

    good = {r["doc_id"] for r in op2_quality_qda(spark, SF).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in by_name["quality"][1]} == good

    before, after = by_name["lines"]
    texts = {r["doc_id"]: r["text"] for r in before}
    seen = set()
    for r in sorted(after, key=lambda r: r["doc_id"]):
        lines = [x for x in r["text"].split("\n") if any(map(str.isalnum, x))]
        assert lines and set(lines) <= set(texts[r["doc_id"]].split("\n")) and not seen & set(lines)
        assert r["n_chars"] == len(r["text"])
        seen |= set(lines)

    before, after = by_name["near_duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in before]
    heads = {c for (i, n, c) in test_minhash.plain(rows, P.SHINGLE_WORDS) if n} | {i for i, n, _ in test_minhash.plain(rows, 5) if not n}
    assert {r["doc_id"] for r in after} == heads

    before, after = by_name["decontamination"]
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r["doc_id"] for r in before if any(b in r["text"] for b in bench)}
    assert held and not held & {r["doc_id"] for r in after}
    assert len(before) - len(after) <= len(held) + 3

    before, after = by_name["packing"]
    encode = packing.encoder()
    assert sum(r["length"] for r in after) == sum(len(encode(r["text"])) + 1 for r in before)


def test_run_is_the_last_stage(spark):
    found = P.run(spark, SF)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.agg(F.countDistinct("sequence_id")).first()[0] == found.count() > 0


def test_stages_take_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key string, dropped_lines string"
    rows = [(1, None, None, None, None, "x", "y"), (None, "", "en", "s", 0, "x", "y"), (2, "word " * 30_000, "en", "s", 1, None, None),
            (2, "word " * 30_000, "en", "s", 1, None, None)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            assert out.count() >= 0
            if not data:
                assert out.count() == 0


def test_the_entry_imports_without_this_package(tmp_path):
    for part in ("__spark_entry__.py", "checks", "rovelog"):
        source, target = REPO / part, tmp_path / part
        if source.is_file():
            target.write_text(source.read_text())
            continue
        for file in source.rglob("*.py"):
            if "llm" not in file.parts:
                (target / file.relative_to(source)).parent.mkdir(parents=True, exist_ok=True)
                (target / file.relative_to(source)).write_text(file.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 28 and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' in q and sum(n.startswith('op') for n in q) == 13"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


