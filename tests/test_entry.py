"""The entry module works without the optional parts and without their libraries."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = ("import sys; sys.path.insert(0, sys.argv[1])\n{before}\nimport __spark_entry__ as e\n"
          "print(len(e.queries()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()))")


@pytest.fixture()
def copy(tmp_path):
    to = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "racelake"), to / "racelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), to)
    return to


def counts(root, before=""):
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", SCRIPT.format(before=before), str(root)], cwd=root,
                         capture_output=True, text=True, timeout=120, check=True)
    return tuple(map(int, run.stdout.split()[-2:]))


def test_without_the_optional_folder(copy):
    n, optional = counts(copy)
    assert n > 130 and optional == 0


def test_with_a_leftover_of_the_folder(copy):
    (copy / "racelake" / "llm" / "__pycache__").mkdir(parents=True)
    assert counts(copy)[1] == 0


def test_without_a_library(copy):
    if not os.path.isdir(os.path.join(ROOT, "racelake", "llm")):
        pytest.skip("the optional folder is absent")
    shutil.copytree(os.path.join(ROOT, "racelake", "llm"), copy / "racelake" / "llm", ignore=shutil.ignore_patterns("__pycache__"))
    assert counts(copy, "sys.modules['xxhash'] = None")[1] == 0
