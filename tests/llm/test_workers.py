"""Every query runs where the workers don't have the package: from another folder, without PYTHONPATH."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"
CODE = """
import sys
sys.path.insert(0, {root!r})  # the driver's path alone
import __spark_entry__ as entry
from sluice.session import local_session
spark = local_session(4)
spark.sparkContext.setCheckpointDir({ckpt!r})
for name in {names!r}:
    print(name, entry.queries()[name](spark, {sf!r}).count())
"""


@pytest.mark.parametrize("names", [["op1_token_counts", "op3_toxicity", "op4_warc_normaliser", "op5_lm_scoring"], ["op6_benchmark_decontamination", "op7_best_fit_packing", "op9_secret_scans", "op10_minhash_near_dedup"], ["op11_source_divergence", "op12_sentencepiece", "op13_embedding_whitening"]])
def test_queries_run_without_the_package_on_the_workers(tmp_path, names):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    code = CODE.format(root=str(ROOT), ckpt=str(tmp_path / "ckpt"), names=names, sf=SF)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    said = [line.split() for line in done.stdout.splitlines() if line.startswith("op")]
    assert [w[0] for w in said] == names and all(int(w[1]) > 0 for w in said)
