"""The library on the executors of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Sessions' contexts that have the library already, by application.
SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the session's Python workers this package, wherever the driver runs it from; once for each application.

    The package's modules travel as a zip by Spark's own file server, as `spark-submit --py-files` would send them.
    """
    sc = spark.sparkContext
    if sc.applicationId in SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sparkloom-"), "sparkloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("sparkloom", os.path.relpath(full, here)))
    sc.addPyFile(path)
    SHIPPED.add(sc.applicationId)
