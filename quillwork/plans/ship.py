"""Make the package importable in every Python worker of a session."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def packed() -> bytes:
    """The package as a zip file."""
    root, out = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    return out.getvalue()


def ship(spark: SparkSession) -> None:
    """Add the package as a zip file to the session, once; workers may run on other machines or in other folders.

    The file lies in the shared folder of the cluster, whatever its file system; a session without one runs on this
    machine alone (tests), or is served by the driver.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        target = sc._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/quillwork-{sc.applicationId}", "quillwork.zip")
        out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
        out.write(bytearray(packed()))
        out.close()
        sc.addPyFile(target.toString())
    else:
        local = Path(tempfile.mkdtemp(prefix="quillwork-ship-")) / "quillwork.zip"
        local.write_bytes(packed())
        sc.addPyFile(str(local))
    _shipped.add(sc.applicationId)
