"""A run's state as a small JSON file, on the file system that its path names."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .sources import files


def load_state(spark: SparkSession, path: str) -> dict:
    """The saved state; empty if there is none or it can't be read."""
    try:
        out = json.loads(files.read_text(spark, path) or "{}")
    except ValueError:
        return {}
    return out if isinstance(out, dict) else {}


def save_state(spark: SparkSession, path: str, **values) -> dict:
    """Adds values and the time to the saved state."""
    state = load_state(spark, path) | values | {"updated_at": datetime.now(timezone.utc).isoformat()}
    files.write_text(spark, path, json.dumps(state, ensure_ascii=False, indent=2))
    return state
