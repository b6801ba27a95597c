"""The package for Python workers: they must be able to import what a plan's Python functions use."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def _at_hand(master: str) -> bool:
    """Whether workers find the package by themselves: on their path, in the working directory of a local master, or in a file that was sent along."""
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    return _ROOT in paths or not _ROOT.is_dir() or (master.startswith("local") and not master.startswith("local-cluster") and Path.cwd() == _ROOT)


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, once for each application, where they do not have it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped or _at_hand(sc.master):
        return
    folder = tempfile.mkdtemp(prefix="kgsync-package-")
    path = f"{folder}/kgsync-package.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((_ROOT / "kgsync").rglob("*.py")):
            z.write(f, f.relative_to(_ROOT))
    sc.addPyFile(path)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # it is served from there while the application runs
    _shipped.add(sc.applicationId)
