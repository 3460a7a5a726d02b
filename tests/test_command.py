import os
import subprocess
import sys

from tests.test_warehouse import folders  # noqa: F401


def test_a_second_session_finds_and_replaces_the_tables(folders, tmp_path):  # noqa: F811
    settings = f"--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 " \
        f"--conf spark.sql.warehouse.dir={tmp_path}/wh --conf spark.checkpoint.dir={tmp_path}/work pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": settings}
    for _ in range(2):
        done = subprocess.run(
            [sys.executable, "-m", "tallyward", *folders], env=env, capture_output=True, text=True,
            timeout=400, cwd=os.path.dirname(os.path.dirname(__file__)),
        )
        assert done.returncode == 0, done.stderr[-2000:]
        lines = [line for line in done.stdout.splitlines() if line.startswith("acidente_trabalho\t")]
        assert len(lines) == 3 and any("cbo_codigo is not an integer" in line for line in lines)
