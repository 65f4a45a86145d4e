"""Camera calibration from fields of up directions and latitudes: a damped least squares loop for each stream."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Rows of one image that take part; the caller samples its fields to it.
MOST_ROWS = 1 << 16
LOW, HIGH, FIRST = 1e-6, 1e2, 0.1


def fields(p: np.ndarray, x: np.ndarray, y: np.ndarray, size: tuple[float, float]) -> np.ndarray:
    """Up directions and latitudes at pixels for roll, pitch and the logarithm of the focal length, row by row (up x, up y, latitude)."""
    roll, pitch, f = p[0], p[1], np.exp(p[2])
    g = np.array([-np.sin(roll) * np.cos(pitch), -np.cos(roll) * np.cos(pitch), np.sin(pitch)])
    u, v = (x - size[0] / 2) / f, (y - size[1] / 2) / f
    a, b = g[0] - g[2] * u, g[1] - g[2] * v
    n = np.maximum(np.hypot(a, b), 1e-9)
    lat = np.arcsin(np.clip((u * g[0] + v * g[1] + g[2]) / np.sqrt(u * u + v * v + 1), -1 + 1e-6, 1 - 1e-6))
    return np.stack((a / n, b / n, lat), axis=1)


def huber(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and weight of squared residuals."""
    root = np.sqrt(np.maximum(x, 1.0))
    return np.where(x > 1, 2 * root - 1, x), np.where(x > 1, 1 / root, 1.0)


def damped_step(h: np.ndarray, g: np.ndarray, lam: float, eps: float = 1e-6) -> np.ndarray:
    """-(H + damping)^-1 g; 0 where the system is not positive definite."""
    a = h + np.diag(np.maximum(lam * np.diag(h), eps))
    try:
        np.linalg.cholesky(a)
    except np.linalg.LinAlgError:
        return np.zeros_like(g)
    return -np.linalg.solve(a, g)


def solve(x: np.ndarray, y: np.ndarray, seen: np.ndarray, weight: np.ndarray, size: tuple[float, float], rounds: int = 30) -> tuple[np.ndarray, np.ndarray, float]:
    """Roll, pitch and log focal length, their covariance, and the cost."""
    p = np.array([0.0, 0.0, np.log(0.7 * max(size))])
    low, high = (np.log(size[1] / 2 / np.tan(np.radians(d) / 2)) for d in (150.0, 5.0))

    def cost(q):
        r = (fields(q, x, y, size) - seen) * 10
        loss, w = huber((r**2).sum(axis=1))
        return r, w * weight, float((loss * weight).mean())

    lam, (r, w, now) = FIRST, cost(p)
    h = np.eye(3)
    for _ in range(rounds):
        j = np.stack([(fields(p + d, x, y, size) - fields(p - d, x, y, size)) / 2e-5 * 10 for d in np.eye(3) * 1e-5], axis=2)
        h, g = np.einsum("n,nci,ncj->ij", w, j, j), np.einsum("n,nci,nc->i", w, j, r)
        d = damped_step(h, g, lam)
        q = p + d
        q[2] = np.clip(q[2], low, high)
        r2, w2, then = cost(q)
        if then < now:
            small = now - then < 1e-10 * max(now, 1e-12) or np.abs(d).max() < 1e-9
            p, r, w, now, lam = q, r2, w2, then, max(lam / 10, LOW)
            if small:
                break
        else:
            lam = min(lam * 10, HIGH)
            if lam >= HIGH:
                break
    return p, np.linalg.pinv(h), now


def calibrated(rows: DataFrame, stream: str, width: float, height: float) -> DataFrame:
    """rows (stream, x, y, up_x, up_y, latitude, weight) to stream, roll, pitch, focal, fov and their uncertainties; MOST_ROWS rows a stream at most."""
    kind = dict(rows.dtypes)[stream]

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) > MOST_ROWS:
            raise ValueError(f"a stream has at most {MOST_ROWS} field rows")
        frame = frame.sort_values(["y", "x"])
        p, cov, cost = solve(frame.x.to_numpy(), frame.y.to_numpy(), frame[["up_x", "up_y", "latitude"]].to_numpy(), frame.weight.to_numpy(), (width, height))
        f = float(np.exp(p[2]))
        fov = 2 * np.arctan(height / 2 / f)
        slope = height * f / (f * f + height * height / 4)  # of fov by log focal
        return pd.DataFrame({stream: [frame[stream].iloc[0]], "roll": [p[0]], "pitch": [p[1]], "focal": [f], "fov": [np.degrees(fov)], "gravity_sd": [float(np.sqrt(max(np.linalg.eigvalsh(cov[:2, :2]).max(), 0)))], "fov_sd": [float(np.degrees(slope * np.sqrt(max(cov[2, 2], 0))))], "cost": [cost]})

    return rows.groupBy(stream).applyInPandas(one, f"`{stream}` {kind}, roll double, pitch double, focal double, fov double, gravity_sd double, fov_sd double, cost double")


def fit_mei(radial, most: float = 1.0, places: int = 50, rounds: int = 50) -> tuple[float, float]:
    """The distortion k1 and the factor of the focal length of the one-parameter unified camera whose radial factor f / (1 + k1 sqrt(1 + r^2)) comes nearest to radial(r) up to a radius."""
    r = np.linspace(0, most, places)
    seen, root = np.asarray(radial(r), float), np.sqrt(1 + r * r)
    k, f, lam = 1.0, 1.0, 1e-3
    off = f / (1 + k * root) - seen
    for _ in range(rounds):
        j = np.stack((-f * root / (1 + k * root) ** 2, 1 / (1 + k * root)), axis=1)
        h = j.T @ j
        d = np.linalg.solve(h + lam * np.diag(np.diag(h)), -j.T @ off)
        if (1 + (k + d[0]) * root <= 0).any():
            lam *= 10
            continue
        then = (f + d[1]) / (1 + (k + d[0]) * root) - seen
        if then @ then <= off @ off:
            k, f, off, lam = k + d[0], f + d[1], then, max(lam / 10, 1e-12)
            if np.abs(d).max() < 1e-13:
                break
        else:
            lam *= 10
    return float(k), float(f)
