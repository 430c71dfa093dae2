"""What the engine finds around it: versions, tools, optional modules, Spark's settings that matter here."""

from __future__ import annotations

import importlib.util
import platform
import shutil
import sys

from pyspark.sql import SparkSession

#: Tools of the boundaries, and modules that only some operators need.
TOOLS = ("ffmpeg", "ffprobe", "pandoc", "git")
MODULES = ("pyarrow", "pandas", "numpy", "yaml", "sentencepiece", "xxhash")
SETTINGS = ("spark.checkpoint.dir", "spark.sql.warehouse.dir", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone")


def environment(spark: SparkSession) -> dict:
    """healthy: the modules that all need are there, and a cluster names a shared folder. Nothing heavy is imported."""
    modules = {m: importlib.util.find_spec(m) is not None for m in MODULES}
    settings = {s: spark.conf.get(s, None) for s in SETTINGS}
    local = spark.sparkContext.master.startswith("local")
    return {
        "healthy": all(modules[m] for m in ("pyarrow", "pandas", "numpy")) and bool(local or settings["spark.checkpoint.dir"]),
        "platform": {"system": platform.system(), "release": platform.release(), "machine": platform.machine()},
        "versions": {"python": platform.python_version(), "spark": spark.version, "java": spark._jvm.java.lang.System.getProperty("java.version")},
        "python": sys.executable,
        "master": spark.sparkContext.master,
        "tools": {t: shutil.which(t) for t in TOOLS},
        "modules": modules,
        "settings": settings,
    }
