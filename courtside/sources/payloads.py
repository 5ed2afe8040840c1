"""JSON envelopes {"resultSets": [{"headers": [...], "rowSet": [[...]]}]} as DataFrames, and their read-through cache."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "resultSets array<struct<name:string,headers:array<string>,rowSet:array<array<string>>>>"


def result_rows(spark: SparkSession, paths: str | list[str], columns: dict[str, str], set_index: int = 0) -> DataFrame:
    """The rows of the envelopes in paths, one to a file: the named headers, cast to the given types; null where a header is absent."""
    return _rows(spark.read.text([paths] if isinstance(paths, str) else paths, wholetext=True), columns, set_index)


def result_lines(spark: SparkSession, paths: str | list[str], columns: dict[str, str], set_index: int = 0) -> DataFrame:
    """As result_rows, of files with an envelope on each line."""
    return _rows(spark.read.text(paths), columns, set_index)


def _rows(texts: DataFrame, columns: dict[str, str], set_index: int) -> DataFrame:
    raw = texts.select(F.from_json("value", ENVELOPE).alias("j"), F.input_file_name().alias("_file"))
    rows = raw.select("_file", F.get(F.col("j.resultSets"), set_index).alias("s")).select("_file", F.col("s.headers").alias("h"), F.posexplode("s.rowSet").alias("_row", "r"))
    return rows.select("_file", "_row", *[F.get(F.col("r"), F.array_position("h", name).cast("int") - 1).try_cast(kind).alias(name) for name, kind in columns.items()])


def result_frame(spark: SparkSession, payload: dict) -> DataFrame:
    """The first result set of one payload with inferred types (a driver-side table of one response)."""
    import pandas as pd

    s = payload["resultSets"][0]
    table = pd.DataFrame(s["rowSet"], columns=s["headers"])
    empty = table.columns[table.isna().all()]  # no type can be inferred for these
    return spark.createDataFrame(table.astype(dict.fromkeys(empty, float)))


def cached_payload(path: Path, fetch: Callable[[], dict] | None) -> dict:
    """The payload stored at path, else a fetched one, which is stored."""
    path = Path(path)
    if path.exists():
        return json.loads(path.read_text())
    if fetch is None:
        raise FileNotFoundError(f"no cached payload at {path}")
    payload = fetch()
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload))
    return payload
