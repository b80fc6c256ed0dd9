"""The entry module with and without the training-data package."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT

COUNT = "import __spark_entry__ as e; print(sum(q.startswith('op') and q[2].isdigit() or q == 'pipeline' for q in e.queries()), len(e.queries()))"


def entry_of(folder):
    got = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": folder})
    assert got.returncode == 0, got.stderr[-800:]
    return tuple(map(int, got.stdout.split()))


def copy(tmp_dir):
    skip = shutil.ignore_patterns("__pycache__", "llm", ".git")
    shutil.copytree(os.path.join(ROOT, "labwire"), f"{tmp_dir}/labwire", ignore=skip)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_dir)


def test_entry_without_the_package(tmp_dir):
    copy(tmp_dir)
    dealt, rest = entry_of(tmp_dir)
    assert dealt == 0 and rest > 30


def test_entry_with_an_empty_folder_left_behind(tmp_dir):
    copy(tmp_dir)
    os.makedirs(f"{tmp_dir}/labwire/llm/__pycache__")
    assert entry_of(tmp_dir)[0] == 0


def test_an_error_inside_the_package_is_not_hidden(tmp_dir):
    copy(tmp_dir)
    os.makedirs(f"{tmp_dir}/labwire/llm")
    for name, text in (("__init__", ""), ("registry", "from labwire.session import nothing_of_that_name\n")):
        with open(f"{tmp_dir}/labwire/llm/{name}.py", "w") as f:
            f.write(text)
    got = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_dir, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": tmp_dir})
    assert got.returncode != 0 and "nothing_of_that_name" in got.stderr
