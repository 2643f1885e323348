import os
import subprocess
import sys
from pathlib import Path

from txmill.sources import read_parquet

ROOT = str(Path(__file__).resolve().parents[1])
SUBMIT = (
    "--master local[4] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4"
    " pyspark-shell"
)
HEADER = (
    "# tranaction_id | tx_datetime | customer_id | terminal_id | tx_amount"
    " | tx_time_seconds | tx_time_days | tx_fraud | tx_fraud_scenario"
)


def run(module, *arguments):
    return subprocess.run(
        [sys.executable, "-m", module, *arguments],
        cwd=ROOT,
        env={**os.environ, "PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": SUBMIT},
        capture_output=True,
        text=True,
        timeout=300,
        check=False,
    )


def test_clean_then_retrain(spark, tmp_path):
    lines = [HEADER]
    for i in range(200):
        day, amount, fraud = 1 + i % 28, (i % 4) * 10 + 0.5, int(i % 4 == 3)
        lines.append(f"{i},2019-08-{day:02d},{i % 9},{i % 5},{amount},{i},{day},{fraud},0")
    (tmp_path / "in.txt").write_text("\n".join(lines))
    table = str(tmp_path / "clean")
    done = run("txmill.plans.clean_job", "--input", str(tmp_path / "*.txt"), "--output", table, "--report")
    assert done.returncode == 0
    assert "records: 200" in done.stdout and "repeated: 0" in done.stdout and "kept: 200" in done.stdout
    assert read_parquet(spark, table).count() == 200
    done = run(
        "txmill.plans.retrain_job",
        *("--input", table, "--output", str(tmp_path / "model"), "--run-name", "nightly"),
        *("--registry", str(tmp_path / "registry"), "--auto-register"),
        *("--exclude", "transaction_id", "--seed", "7", "--partitions", "4", "--exact-auc"),
    )
    assert done.returncode == 0
    for said in ("rows: ", "features: customer_id", "auc: 1.0", "promoted to champion"):
        assert said in done.stdout
    run_made = read_parquet(spark, str(tmp_path / "registry/runs")).first()
    assert run_made["auc"] == 1.0 and run_made["run_name"] == "nightly"
    assert run_made["best_numTrees"] in (10, 20) and run_made["best_maxDepth"] in (5, 10)
    scores = str(tmp_path / "scores")
    done = run(
        "txmill.plans.score_job",
        *("--input", table, "--registry", str(tmp_path / "registry"), "--output", scores),
    )
    assert done.returncode == 0 and "rows: 200" in done.stdout and "frauds: 50" in done.stdout
    assert read_parquet(spark, scores).filter("prediction = 1").count() == 50


def test_failed_training_exits_with_1(tmp_path):
    missing = str(tmp_path / "missing")
    done = run("txmill.plans.retrain_job", "--input", missing, "--output", str(tmp_path / "m"))
    assert done.returncode == 1


def test_generator_writes_and_reports(spark, tmp_path):
    done = run("txmill.plans.synth_job", "--output", str(tmp_path / "demo"), "--rows", "500")
    assert done.returncode == 0 and "rows: 500" in done.stdout and "fraud: 25 (5.00 %)" in done.stdout
    sizes = [spark.read.option("header", True).csv(str(tmp_path / "demo" / p)).count() for p in ("train", "test")]
    assert sizes == [400, 100]
