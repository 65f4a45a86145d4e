"""Robust weights, losses and variable updates as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Kernel = Callable[[Column], Column]


def l2() -> Kernel:
    return lambda r: F.lit(1.0)


def huber(threshold: float = 1.0) -> Kernel:
    return lambda r: F.when(F.abs(r) <= threshold, 1.0).otherwise(threshold / F.greatest(F.abs(r), F.lit(1e-8)))


def tukey(c: float = 2.0) -> Kernel:
    return lambda r: F.pow(F.greatest(1 - (r / c) * (r / c), F.lit(0.0)), 2)


def gnc_tls(threshold: float = 3.0, mu: float | None = None, mu_max: float = 1e6) -> Kernel:
    """Truncated least squares at one level of convexity; without a level, or at its end, the hard indicator."""
    c2 = threshold * threshold
    if mu is None or mu >= mu_max:
        return lambda r: (r * r < c2).cast("double")
    low, high = mu / (mu + 1) * c2, (mu + 1) / mu * c2
    return lambda r: F.when(r * r < low, 1.0).when(r * r <= high, F.greatest(F.sqrt(c2 * mu * (mu + 1) / F.greatest(r * r, F.lit(1e-12))) - mu, F.lit(0.0))).otherwise(0.0)


def mu_schedule(start: float = 1.0, step: float = 3.0, end: float = 1e6) -> list[float]:
    out = [start]
    while out[-1] < end:
        out.append(min(out[-1] * step, end))
    return out


def kernel(name: str | None, threshold: float = 1.0, mu: float | None = None, mu_max: float = 1e6) -> Kernel:
    """The weight of a name; no name is plain least squares, unknown names are refused."""
    key = (name or "").strip().lower()
    if key in ("", "none", "null", "off"):
        return l2()
    if key == "huber":
        return huber(threshold)
    if key == "tukey":
        return tukey(threshold)
    if key in ("gnc_tls", "gnc-tls"):
        return gnc_tls(threshold, mu, mu_max)
    raise ValueError(f"no robust kernel {name!r}")


def huber_loss(x: Column) -> tuple[Column, Column, Column]:
    """The scaled Huber loss of a squared residual and its two derivatives."""
    out = x > 1
    root = F.sqrt(F.when(out, x).otherwise(1.0))
    return F.when(out, 2 * root - 1).otherwise(x), F.when(out, F.greatest(1 / root, F.lit(2.2e-16))).otherwise(1.0), F.when(out, -1 / (2 * root * x)).otherwise(0.0)


def moved_disparity(d: Column, dx: Column) -> Column:
    """A disparity moved by dx; jumps of more than 10 are ignored, and it stays positive."""
    return F.greatest(F.when(dx > 10, d).otherwise(d + dx), F.lit(1e-3))


def moved_track_disparity(d: Column, dx: Column) -> Column:
    return F.least(F.greatest(d + dx, F.lit(1e-3)), F.lit(10.0))


def moved_intrinsics(f: Column, distortion: Column, dx0: Column, dx1: Column) -> tuple[Column, Column]:
    return f + dx0, distortion + 0.01 * dx1


def damped(value: Column, diagonal: Column, damping: float, eps: float) -> Column:
    """A matrix entry with damping: on the diagonal plus eps and a share of itself."""
    return value + F.when(diagonal, damping * value + eps).otherwise(0.0)


#: How variables of a name move by the steps of a solver; the caller may add its own.
RETRACTORS: dict[str, Callable[..., Column | tuple[Column, ...]]] = {"dense_disp": moved_disparity, "tracks_disp": moved_track_disparity, "intrinsics": moved_intrinsics}


def retracted(name: str, *columns: Column):
    """A variable moved by its step, by the rule of its name; unknown names are refused."""
    if name not in RETRACTORS:
        raise ValueError(f"no variables {name!r}; one of {', '.join(sorted(RETRACTORS))}")
    return RETRACTORS[name](*columns)
