"""Run settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Where the snapshot and the lake live. ``since`` overrides the stored watermark; ``buckets`` is fixed by a lake's first run."""

    root: str
    out: str
    since: str | None = None
    buckets: int | None = None

    @classmethod
    def from_env(cls, prefix: str = "LAKE_", **overrides) -> "Settings":
        """Take ``<prefix>ROOT``, ``<prefix>OUT``, ... from the environment; keyword arguments win."""
        values = {}
        for field in fields(cls):
            raw = os.environ.get(prefix + field.name.upper())
            if raw is not None:
                values[field.name] = int(raw) if field.name == "buckets" else raw
        values.update(overrides)
        return cls(**values)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors must share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
