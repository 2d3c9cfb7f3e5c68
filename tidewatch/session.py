"""Session factory for scripts, tests and the benchmark."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", *, partitions: int = 8, memory: str = "8g", app: str = "tidewatch") -> SparkSession:
    """A local session: UTC, adaptive execution, workers on this interpreter."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def smoke(spark: SparkSession) -> dict[str, object]:
    """What an environment report needs: version, a sum, one Python worker."""
    total = spark.range(1_000_000).selectExpr("sum(id) AS s").first()["s"]

    def version(batches):
        import pandas as pd

        for _ in batches:
            pass
        yield pd.DataFrame({"v": [sys.version.split()[0]]})

    worker = spark.range(1).mapInPandas(version, "v string").first()["v"]
    return {"spark": spark.version, "sum": total, "worker": worker, "driver": sys.version.split()[0]}
