"""Jobs whose tasks fail and are run again must give the same rows."""

import os
import subprocess
import sys

from conftest import SF_DIR

HERE = os.path.dirname(os.path.abspath(__file__))


def test_failed_tasks_are_run_again(tmp_path):
    path = os.pathsep.join([os.path.dirname(HERE), os.environ.get("PYTHONPATH", "")])
    done = subprocess.run(
        [sys.executable, os.path.join(HERE, "retries_job.py"), SF_DIR, str(tmp_path)],
        env={**os.environ, "PYTHONPATH": path},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert "same rows" in done.stdout, done.stderr[-3000:]
