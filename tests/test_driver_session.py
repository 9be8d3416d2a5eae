"""Queries must not depend on our session settings (see driver_session_check.py)."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_queries_in_a_plain_session():
    names = ["job_dim", "employee_dim", "monthly_purchase", "hires_in_month", "observations",
             "working_days_from_calendar"]
    r = subprocess.run([sys.executable, os.path.join(HERE, "driver_session_check.py"), *names],
                       capture_output=True, text=True, timeout=900)
    assert r.returncode == 0, r.stdout[-2000:] + r.stderr[-2000:]
