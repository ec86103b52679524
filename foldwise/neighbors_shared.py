"""numpy helpers used inside Arrow batches (executors only)."""

from __future__ import annotations

import numpy as np
import pandas as pd


def stack_vectors(col: pd.Series, d: int | None = None) -> np.ndarray:
    """A pandas column of equal-length arrays -> float64 matrix."""
    if len(col) == 0:
        return np.zeros((0, d or 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.to_numpy()])


def feature_columns(d: int, prefix: str = "_f") -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def stack_columns(pdf: pd.DataFrame, d: int, prefix: str = "_f") -> np.ndarray:
    """Flat double columns -> float64 matrix (Arrow hands these over
    column-wise, far cheaper than per-row array objects)."""
    if len(pdf) == 0:
        return np.zeros((0, d))
    return pdf[feature_columns(d, prefix)].to_numpy(dtype=np.float64)


_PD_TYPES = {"bigint": "int64", "int": "int32", "double": "float64", "float": "float32",
             "boolean": "bool", "smallint": "int16", "tinyint": "int8"}


def empty_frame(schema) -> pd.DataFrame:
    """A typed empty pandas frame for a Spark StructType (an untyped empty
    frame does not convert to Arrow for every column type)."""
    return pd.DataFrame({f.name: pd.Series([], dtype=_PD_TYPES.get(f.dataType.simpleString(), "object"))
                         for f in schema.fields})
