"""Vector expressions over ``array<float|double>`` columns, JVM-side."""

from pyspark.sql import Column, functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product of two equal-length arrays, accumulated in double."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def l2_norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity; NULL when either norm is zero (never NaN)."""
    den = l2_norm(a) * l2_norm(b)
    return F.when((den > 0) & ~F.isnan(den), dot(a, b) / den)
