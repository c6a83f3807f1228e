"""The command line prints the report lines and the total."""

import subprocess
import sys

from tests.conftest import SF0001

ROOT = __file__.rsplit("/tests/", 1)[0]


def run(*args):
    out = subprocess.run([sys.executable, "-m", "tristar", "--master", "local[2]", *args],
                         cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_cli_count_report():
    out = run("count", "--sf", SF0001, "--threshold", "600")
    lines = [ln.split() for ln in out.splitlines() if "Supplier#" in ln]
    assert len(lines) == 6
    assert lines[0] == ["640", "Supplier#000000001"]
    assert "6 users have more than 600 verifications" in out


def test_cli_run_says_when_it_cuts():
    out = run("run", "value_counts", "--sf", SF0001, "--rows", "2")
    assert "first 2 rows, more follow" in out


def test_cli_list():
    out = subprocess.run([sys.executable, "-m", "tristar", "--list"], cwd=ROOT,
                         capture_output=True, text=True, timeout=120).stdout
    assert "verified_users_by_id" in out.split()


def test_cli_explain():
    out = run("run", "enriched_cards", "--sf", SF0001, "--explain")
    assert "BroadcastHashJoin" in out and "ReadSchema" in out
