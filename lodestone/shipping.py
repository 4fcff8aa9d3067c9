"""Makes this package importable in the Python workers of a session's executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Most bytes of rows that go to a Python worker at once: rows may hold long texts.
BATCH_BYTES = "8m"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's source to all executors, once for each application; where it is installed there already, nothing changes. Also bounds the bytes of an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lodestone-")) / "lodestone.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
