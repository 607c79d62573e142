"""The pipeline against plain restatements of its stages, and how its parts are registered."""

import re
import shutil
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import kneser_ney
from tests.llm.test_shingle_sets import brute_kept
from tests.llm.test_text_operators import brute_windows, exact_expected

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_run_equals_the_stages_restated(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = sorted(map(tuple, docs.collect()))
    # the model itself is compared with its definition elsewhere; here only what is kept follows from it
    kept = {r.doc_id for r in kneser_ney.classify(docs, labels).collect() if r.kept}
    rows = [r for r in rows if r[0] in kept]
    stay = {r[0] for r in exact_expected(rows) if r[3]}
    rows = [r for r in rows if r[0] in stay]
    stay, _ = brute_kept([(r[0], r[1] or "") for r in rows])
    rows = [r for r in rows if r[0] in stay]
    texts = {}
    for r, (words, hit) in zip(rows, brute_windows([r[1] for r in rows], 35)):
        if not all(hit):
            texts[r[0]] = " ".join(w for w, h in zip(words, hit) if not h) if any(hit) else r[1]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for key, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[key, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


def test_stages_keep_the_columns_of_documents_and_odd_rows(spark, edge_docs, empty_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (edge_docs, empty_docs):
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count(), name
    assert corpus_pipeline.STAGES[-1][1](spark, empty_docs, SF_DIR).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, edge_docs, SF_DIR).select("doc_id").count() >= edge_docs.count()


def test_every_operator_is_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_does_without_this_part(tmp_path, pipeline):
    """A copy without both folders, with and without the pipeline, gives the other queries and collects the other tests."""
    for name in ("ledgerloom", "tests"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", *(["corpus_pipeline.py"] if pipeline else [])):
        shutil.copy(ROOT / name, tmp_path / name)
    code = (
        "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); "
        "assert len(q) > 150 and 'pipeline' not in q and not any(n.startswith('op1_') for n in q)"
    )
    own = {"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=own)
    subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=tmp_path, check=True, env=own)


def test_nothing_else_imports_this_part():
    for path in ROOT.glob("ledgerloom/**/*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
