"""Python-UDF operators work when executors cannot import this package
(driver started outside the repository, nothing shipped with --py-files)."""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from lumisort.session import build_session
from lumisort.operators.featurize import featurize, projection_model
spark = build_session("local[2]", shuffle_partitions=2)
emb = spark.read.parquet({SF_SMALL!r} + "/embeddings.parquet").select("vec_id", "embedding")
n = featurize(emb, projection_model(64, 4), "embedding").where("features is not null").count()
print("ROWS", n)
"""


def test_featurize_from_outside_the_repo():
    cwd = tempfile.mkdtemp(prefix="lumisort-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS 500" in out.stdout, out.stderr[-2000:]
