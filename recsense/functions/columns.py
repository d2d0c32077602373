"""Column expressions that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def strip_prefix(name: Column) -> Column:
    """A header name without white space around it and without its ``NN_`` prefix."""
    return F.trim(F.regexp_replace(F.trim(name), r"^\d{2,}_", ""))


def slug(text: Column, most: int = 40) -> Column:
    """Lower case, other characters than letters and digits as one underscore, at most ``most`` long."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, most)


def flag(condition: Column) -> Column:
    """A condition that is false, not null, where it can't be told."""
    return F.coalesce(condition, F.lit(False))


def filled(value: Column, w: WindowSpec) -> Column:
    """The latest value that isn't null, up to this row of the ordered window: a running frame, linear in the rows.

    To fill from the rows ahead, give the window in descending order; a frame up to the end of the partition
    would go through all rows that follow, for each row.
    """
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def quantile_of(values: Column, q: float) -> Column:
    """Percentile of an array's values, interpolated between neighbours; nulls don't count, NaN is the greatest."""

    def of(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        at = last * F.lit(float(q))
        low = F.floor(at).cast("int")
        a, b = F.get(ordered, low).cast("double"), F.get(ordered, F.least(low + 1, last)).cast("double")
        return F.when(a == b, a).otherwise(a + (b - a) * (at - low))

    # bound by a lambda, so that the array is put in order once
    return F.get(F.transform(F.array(F.sort_array(F.filter(values, lambda x: x.isNotNull()))), of), 0)


def quantile_at(ordered: Column, n: int, q: float) -> Column:
    """Percentile of an ordered array of ``n`` numbers, interpolated between neighbours."""
    low = int((n - 1) * q)
    a, b = F.get(ordered, low), F.get(ordered, min(low + 1, n - 1))
    return F.when(a == b, a).otherwise(a + (b - a) * ((n - 1) * q - low))


def messages(*pairs: tuple[Column, Column | str]) -> Column:
    """The messages whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(flag(c), F.lit(m) if isinstance(m, str) else m) for c, m in pairs]))


def first_message(*pairs: tuple[Column, Column | str]) -> Column:
    """The first message whose condition holds, or null."""
    return F.coalesce(*[F.when(flag(c), F.lit(m) if isinstance(m, str) else m) for c, m in pairs])


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def correlation(x: str, y: str, prefix: str = "") -> list[Column]:
    """Sums that :func:`correlation_of` needs, over rows where both are present."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return [F.count(a).alias(f"{prefix}n"), F.sum(a).alias(f"{prefix}sx"), F.sum(b).alias(f"{prefix}sy"), F.sum(a * a).alias(f"{prefix}sxx"), F.sum(b * b).alias(f"{prefix}syy"), F.sum(a * b).alias(f"{prefix}sxy")]


def correlation_of(prefix: str = "", least: int = 3) -> Column:
    """Pearson's r; null below ``least`` pairs or where a side is constant (``corr`` would raise there)."""
    n, sx, sy, sxx, syy, sxy = (F.col(f"{prefix}{k}") for k in ("n", "sx", "sy", "sxx", "syy", "sxy"))
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    return F.when((n >= least) & (vx > 1e-9 * F.abs(n * sxx)) & (vy > 1e-9 * F.abs(n * syy)), (n * sxy - sx * sy) / F.sqrt(vx * vy))
