"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import rostrum


def session(app: str = "rostrum", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC dates; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # methods beyond HotSpot's limit would be interpreted; Spark then generates smaller ones
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({key.replace("_", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. A cluster without it is refused:
    a machine-local folder would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rostrum-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Gives the package to the Python workers, once per context, so that none needs it installed."""
    context = spark.sparkContext
    if getattr(context, "_rostrum_shipped", False):
        return
    root = Path(rostrum.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="rostrum-")) / "rostrum_package.zip"  # the context serves it from the driver
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(path))
    context._rostrum_shipped = True
