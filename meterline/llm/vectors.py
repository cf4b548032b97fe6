"""Integer vectors: what the operators on embeddings share."""
from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str | Column) -> Column:
    """True for a vector that is not null and holds finite numbers only (an empty one does)."""
    values = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(values.isNotNull() & finite, F.lit(False))


def widest(vectors: DataFrame, vector: str) -> tuple[int, int]:
    """(number of usable vectors, length of the longest): two numbers on the driver."""
    row = vectors.where(usable(vector)).agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size(vector)), F.lit(0)).alias("width")).first()
    return row["n"], row["width"]


def component_bound(terms: int) -> int:
    """Largest magnitude b with terms * (2 b)**2 below 2**63, so that no sum of products or squares overflows."""
    return isqrt((2**63 - 1) // (4 * max(1, terms)))


def floors(vector: str, scale: int, bound: int) -> Column:
    """Components as floor(scale * x), x a double; magnitudes beyond `bound` count as `bound`."""
    return F.transform(F.col(vector), lambda x: F.floor(F.greatest(F.least(
        x.cast("double") * F.lit(float(scale)), F.lit(float(bound))), F.lit(float(-bound)))).cast("long"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column, shorter ones padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype if len(flat) else np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32)
                                    if width else np.zeros(n + 1, np.int32), pa.array(rows.ravel()))
