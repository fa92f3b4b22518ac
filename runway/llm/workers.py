"""Lets Python workers import this package when only the driver can."""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's files with the jobs of this session, once.

    A package that was itself imported from an archive (``--py-files``) is at the
    workers already.  The archive's name holds a digest of its content, so it
    never meets another file of that name."""
    app = spark.sparkContext.applicationId
    if app in _shipped or not os.path.isdir(_PACKAGE):
        return
    folder = tempfile.mkdtemp(prefix="llm-ship-")
    atexit.register(shutil.rmtree, folder, True)
    content, path = hashlib.sha256(), os.path.join(folder, "package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, dirs, names in os.walk(_PACKAGE):
            dirs.sort()
            for name in sorted(names):
                if name.endswith((".py", ".txt")):
                    full = os.path.join(top, name)
                    within = os.path.relpath(full, os.path.dirname(_PACKAGE))
                    z.write(full, within)
                    with open(full, "rb") as f:
                        content.update(within.encode() + b"\0" + f.read())
    named = os.path.join(folder, f"{os.path.basename(_PACKAGE)}-{content.hexdigest()[:16]}.zip")
    os.rename(path, named)
    spark.sparkContext.addPyFile(named)
    _shipped.add(app)
