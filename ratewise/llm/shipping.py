"""Hand the package to Python workers, for sessions started without it on their path."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give every task of this application the package, as ``--py-files`` would.

    Spark copies the archive to the executors; the file on the driver is only
    where it reads it from.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(_PACKAGE.rglob("*.py")):
            archive.write(path, path.relative_to(_PACKAGE.parent))
    folder = Path(tempfile.mkdtemp(prefix="ratewise-code-"))
    (folder / "ratewise_code.zip").write_bytes(packed.getvalue())
    context.addPyFile(str(folder / "ratewise_code.zip"))
    _sent.add(context.applicationId)
