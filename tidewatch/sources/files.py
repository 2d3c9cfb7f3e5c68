"""Result files: CSV tables with explicit schemas, one JSON document."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Columns by the given schema; empty fields are null, bad rows raise."""
    return spark.read.schema(ddl).option("header", "true").option("mode", "FAILFAST").csv(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_document(rows: DataFrame, path: str) -> dict[str, int]:
    """One compact JSON object from (section, item, body) rows, section by
    section and item by item, written as it is read and moved into place, so
    that a reader never sees half of it and no more than a row is held."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part, last, count = target.with_suffix(".part"), None, 0
    with part.open("w", encoding="utf-8") as f:
        f.write("{")
        for r in rows.orderBy("section", "item").toLocalIterator():
            if r["section"] != last:
                f.write(("}," if count else "") + json.dumps(r["section"]) + ":{")
                last, count = r["section"], count + 1
            else:
                f.write(",")
            f.write(json.dumps(r["item"]) + ":" + r["body"])
        f.write("}}" if count else "}")
    part.replace(target)
    return {"sections": count, "bytes": target.stat().st_size}
