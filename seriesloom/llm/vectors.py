"""Vector columns made ready for the searches: checked, and as bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesloom.llm.common import ship

ship(__name__)


def flat_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all components, first and last+1 component of each row); null components become NaN."""
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        raise TypeError("the vectors must be an array column")
    lengths = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], dtype=np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    return np.asarray(flat, dtype=np.float64), ends - lengths, ends


def prepared_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``key``, ``dim``, ``norm``, ``digest`` (equal for equal vectors) and ``vector`` as doubles in bytes.

    Vectors that are null, empty or zero, or hold null or non-finite components or have no finite
    norm, keep their row with nulls: they take no part in any search.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts, ends = flat_vectors(batch.column(1))
            flat = flat + 0.0  # one zero, so that equal vectors have equal bytes
            dims, norms, digests, vectors = [], [], [], []
            for a, b in zip(starts.tolist(), ends.tolist()):
                x = flat[a:b]
                norm = float(np.sqrt((x * x).sum())) if b > a and np.isfinite(x).all() else 0.0
                good = 0.0 < norm < np.inf
                raw = x.tobytes() if good else None
                dims.append(b - a if good else None)
                norms.append(norm if good else None)
                digests.append(hashlib.blake2b(raw, digest_size=16).digest() if good else None)
                vectors.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())],
                names=["key", "dim", "norm", "digest", "vector"],
            )

    kind = table.schema[key].dataType.simpleString()
    return table.select(key, vector).mapInArrow(run, f"key {kind}, dim int, norm double, digest binary, vector binary")


def matrix(raw: list[bytes], dim: int) -> np.ndarray:
    """Rows of doubles from their bytes."""
    return np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), dim)
