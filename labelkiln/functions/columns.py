"""Column-level helpers. Everything here is a built-in expression (JVM side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _concat_parts(parts) -> Column:
    cols = [F.lit(str(p)) if not isinstance(p, Column) else p.cast("string") for p in parts]
    return F.concat(*cols)


def hash52(*parts) -> Column:
    """First 13 hex digits of md5(concat(parts)) as a non-negative bigint.

    ``parts`` are literals (str/int) or Columns. Value-determined, so the same
    on any partitioning, and equal to ``('0x' || substr(md5(...), 1, 13))::BIGINT``
    in SQL."""
    return F.conv(F.substring(F.md5(_concat_parts(parts)), 1, 13), 16, 10).cast("bigint")


def hash_byte_score(*parts) -> Column:
    """First two hex digits of md5(concat(parts)) / 255.0: a score in [0, 1] with
    256 distinct values, so ties and exact threshold hits occur."""
    h = F.conv(F.substring(F.md5(_concat_parts(parts)), 1, 2), 16, 10)
    return h.cast("int") / F.lit(255.0)


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_as_col(x)))


def relu(x) -> Column:
    return F.greatest(F.lit(0.0), _as_col(x))


def linspace(start: float, stop: float, num: int) -> list[float]:
    """Evenly spaced grid, same doubles as ``j * step + start`` with the last
    point pinned to ``stop`` (the usual linspace contract)."""
    if num == 1:
        return [float(start)]
    step = (stop - start) / (num - 1)
    pts = [j * step + start for j in range(num)]
    pts[-1] = float(stop)
    return pts


def bce_term(y, p) -> Column:
    """Binary cross-entropy of one row, logs clamped at -100."""
    y, p = _as_col(y), _as_col(p)
    lp = F.when(p > 0, F.greatest(F.log(p), F.lit(-100.0))).otherwise(F.lit(-100.0))
    lq = F.when(p < 1, F.greatest(F.log(F.lit(1.0) - p), F.lit(-100.0))).otherwise(F.lit(-100.0))
    return -(y * lp + (F.lit(1.0) - y) * lq)


def ce_term_2class(z0, z1, y) -> Column:
    """Cross-entropy of raw 2-class scores: logsumexp(z) - z[y], max subtracted."""
    z0, z1, y = _as_col(z0), _as_col(z1), _as_col(y)
    m = F.greatest(z0, z1)
    lse = m + F.log(F.exp(z0 - m) + F.exp(z1 - m))
    return lse - F.when(y == 1, z1).otherwise(z0)


def argmax_index(arr) -> Column:
    """0-based position of the first maximum of an array column."""
    a = _as_col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def dense_layer(x, weights: list[list[float]], bias: list[float] | None = None) -> Column:
    """x . W^T + b for a literal weight matrix, as higher-order array functions
    (row-local, no shuffle). For wide matrices prefer the Arrow path in
    ``operators.models``."""
    x = _as_col(x)
    outs = []
    for j, row in enumerate(weights):
        w = F.array(*[F.lit(float(v)) for v in row])
        dot = F.aggregate(F.zip_with(x, w, lambda a, b: a.cast("double") * b), F.lit(0.0),
                          lambda acc, v: acc + v)
        if bias is not None:
            dot = dot + F.lit(float(bias[j]))
        outs.append(dot)
    return F.array(*outs)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double / float (and arrays of them) to ``digits`` places."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in ("double", "float"):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif t in ("array<double>", "array<float>"):
            out.append(F.transform(F.col(f.name), lambda v: F.round(v.cast("double"), digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
