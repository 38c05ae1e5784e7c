"""Arrow batches to matrices and back, without a Python object per row."""

from __future__ import annotations

import ctypes
import functools
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T


@functools.cache
def one_thread() -> None:
    """Keeps numpy's own BLAS in this process to one thread: Spark runs a task per core already, and products of small
    tiles in as many threads again would wait for each other.  Another BLAS is left as it is."""
    root = Path(np.__file__).parent
    for path in (*root.parent.glob("numpy.libs/*openblas*"), *root.glob(".dylibs/*openblas*")):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                return


def matrix(batch: pa.RecordBatch, name: str = "features") -> np.ndarray:
    """A list<double> column without nulls as rows x width, over the batch's own buffer where possible."""
    one_thread()
    column = batch.column(name)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(values, dtype=float).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def with_column(batch: pa.RecordBatch, kept: list[str], name: str, values: np.ndarray) -> pa.RecordBatch:
    """Kept columns and one new column of doubles."""
    arrays = [batch.column(c) for c in kept] + [pa.array(values, pa.float64())]
    return pa.RecordBatch.from_arrays(arrays, [*kept, name])


def schema_with(fields: list[T.StructField], name: str) -> T.StructType:
    return T.StructType([*fields, T.StructField(name, T.DoubleType())])
