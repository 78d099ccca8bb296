"""Adapters of external engines: tracers, renderers, converters, annotators.

An engine gets a payload and gives one back. None is part of this library; the
default says so for every row, visibly, and never makes a result up.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

Engine = Callable[[bytes], bytes]


def unavailable(payload: bytes) -> bytes:
    raise RuntimeError("no engine is configured")


def apply(assets: DataFrame, engine: Engine = unavailable, key: str = "asset_id", payload: str = "content") -> DataFrame:
    """(key, ok, payload, error); an engine must be safe to repeat, as tasks are."""

    def run(batches):
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                try:
                    rows.append((True, engine(value), None))
                except Exception as error:  # the error is the row's result
                    rows.append((False, None, f"{type(error).__name__}: {error}"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.string())], [key, "ok", "payload", "error"])

    kind = assets.schema[key].dataType.simpleString()
    return assets.select(key, payload).mapInArrow(run, f"{key} {kind}, ok boolean, payload binary, error string")
