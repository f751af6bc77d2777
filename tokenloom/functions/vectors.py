"""Vector arithmetic on ``ARRAY`` columns, computed in double precision inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(vector), F.lit(0.0), lambda total, x: total + x * x))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; NaN against a zero vector, an error for different lengths.

    Pass norms that were computed once per row when each vector takes part in many pairs.
    """
    scale = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return (
        F.when(F.size(a) != F.size(b), F.raise_error(F.lit("Vectors must have the same length")).cast("double"))
        .when(scale == 0, F.lit(float("nan")))
        .otherwise(dot(a, b) / scale)
    )


def scaled_features(window: Column, max_id: Column | int | None = None) -> Column:
    """Token ids as a numeric feature vector, raw or divided by the largest id."""
    if max_id is None:
        return as_doubles(window)
    largest = F.lit(max_id).cast("double") if isinstance(max_id, int) else max_id.cast("double")
    return F.transform(window, lambda x: x.cast("double") / largest)


def common_size(df: DataFrame, vector: str) -> int:
    """The length that all vectors share, 0 for none; null vectors, null components and unequal lengths raise."""
    v = F.col(vector)
    bad = v.isNull() | F.exists(v, lambda x: x.isNull())
    low, high, nulls = df.agg(F.min(F.size(v)), F.max(F.size(v)), F.count_if(bad)).first()
    if nulls:
        raise ValueError(f"{nulls} vectors are null or hold a null")
    if low != high:
        raise ValueError("Vectors must have the same length")
    return low or 0


def mean_vectors(df: DataFrame, key: str, vector: str, out: str = "vector") -> DataFrame:
    """Element-wise mean of the vectors of each key.

    The averages of all dimensions are computed side by side, so rows are reduced map-side and never exploded. The length
    is that of one row, read now; a null vector, a null component or another length raises when the means are computed.
    """
    one = df.select(F.size(vector).alias("n")).first()
    size = max(one.n or 0, 0) if one else 0
    v = F.col(vector)
    bad = v.isNull() | (F.size(v) != size) | F.exists(v, lambda x: x.isNull())
    checked = F.when(bad, F.raise_error(F.lit("Vectors must have the same length and no nulls")).cast("array<double>")).otherwise(as_doubles(v))
    rows = df.select(F.col(key), checked.alias("_v"))
    sums = rows.groupBy(key).agg(*[F.avg(F.get("_v", F.lit(i))).alias(f"m{i}") for i in range(size)], F.count("_v").alias("_n"))
    return sums.select(key, F.array(*[F.col(f"m{i}") for i in range(size)]).cast("array<double>").alias(out))
