"""All queries where executors cannot import the package, as on a cluster."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import corpus_pipeline
from barwright.llm import queries
from barwright.session import make_session
spark = make_session("job", "local[4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}})
names = {names!r}
for name in names:
    run = corpus_pipeline.run if name == "pipeline" else queries.QUERIES[name]
    print("rows", name, run(spark, {folder!r}).count())
"""
GROUPS = [["op2_language_id", "op3_bpe_codec", "op6_license_scan", "op12_ranked_search", "op13_quality_classifier"],
          ["op5_html_main_text", "op7_embedding_near_dedup", "op8_lm_pseudo_likelihood"], ["pipeline", "op11_prefix_trie"]]


@pytest.mark.parametrize("names", GROUPS, ids=lambda g: g[0])
def test_executors_need_no_copy_of_the_package(sf_dir, tmp_path, names):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(repo=REPO, names=names, folder=sf_dir))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900)
    told = {line.split()[1]: int(line.split()[2]) for line in done.stdout.splitlines() if line.startswith("rows ")}
    assert set(told) == set(names) and all(told.values()), done.stderr[-2000:]
