"""Writers of corpora."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of JSON lines, written by all executors."""
    df.write.mode(mode).json(path)


def write_by_folder(df: DataFrame, path: str, folder: str = "source_folder") -> None:
    """JSON lines in a subfolder for each source folder."""
    df.write.mode("overwrite").partitionBy(folder).json(path)


def write_array(df: DataFrame, path: str, most: int = 100_000) -> int:
    """One file with a JSON array, for small corpora: more than ``most`` rows are an error. Returns the rows."""
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("j")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; use write_json")
    out = Path(path)
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_text(json.dumps([json.loads(r.j) for r in rows], ensure_ascii=False, indent=2), encoding="utf-8")
    return len(rows)
