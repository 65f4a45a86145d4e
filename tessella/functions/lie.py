"""Rigid and similarity transforms as column expressions.

Quaternions are (x, y, z, w), vectors three columns. A transform is its
translation first: SO3 (q), RxSO3 (q, s), SE3 (t, q), Sim3 (t, q, s). Tangents
are (tau, phi) and (tau, phi, sigma). Everything stays inside code generation;
a pose that is used often is written once by a projection before.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]
Quat = tuple[Column, Column, Column, Column]
#: Angles and scales below are replaced by the first terms of their series.
SMALL = 1e-6


def vec(*names: str) -> Vec:
    return tuple(F.col(n) for n in names)  # type: ignore[return-value]


def add(a: Vec, b: Vec) -> Vec:
    return tuple(x + y for x, y in zip(a, b, strict=True))  # type: ignore[return-value]


def sub(a: Vec, b: Vec) -> Vec:
    return tuple(x - y for x, y in zip(a, b, strict=True))  # type: ignore[return-value]


def scale(a: Vec, s) -> Vec:
    return tuple(x * s for x in a)  # type: ignore[return-value]


def dot(a, b) -> Column:
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        total = total + x * y
    return total


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def q_mul(a: Quat, b: Quat) -> Quat:
    v = add(add(scale(b[:3], a[3]), scale(a[:3], b[3])), cross(a[:3], b[:3]))
    return (*v, a[3] * b[3] - dot(a[:3], b[:3]))


def q_inv(q: Quat) -> Quat:
    return -q[0], -q[1], -q[2], q[3]


def q_unit(q: Quat) -> Quat:
    """Of length one, with w >= 0: of the two equal rotations always the same."""
    n = norm(q) * F.when(q[3] < 0, -1.0).otherwise(1.0)
    return tuple(x / n for x in q)  # type: ignore[return-value]


def q_act(q: Quat, p: Vec) -> Vec:
    u = scale(cross(q[:3], p), F.lit(2.0))
    return add(add(p, scale(u, q[3])), cross(q[:3], u))


def q_matrix(q: Quat) -> tuple[Vec, Vec, Vec]:
    x, y, z, w = q
    return (
        (1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        (2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        (2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
    )


def q_of_matrix(m) -> Quat:
    """From the largest of the four candidate components, so that no small number is divided by."""
    (a, b, c), (d, e, f), (g, h, i) = m
    sums = {"w": a + e + i, "x": a - e - i, "y": e - a - i, "z": i - a - e}
    largest = F.greatest(*sums.values())
    r = F.sqrt(1 + largest) * 2
    forms = {
        "w": ((h - f) / r, (c - g) / r, (d - b) / r, r / 4),
        "x": (r / 4, (b + d) / r, (c + g) / r, (h - f) / r),
        "y": ((b + d) / r, r / 4, (f + h) / r, (c - g) / r),
        "z": ((c + g) / r, (f + h) / r, r / 4, (d - b) / r),
    }

    def pick(k: int) -> Column:
        out = forms["z"][k]
        for name in ("y", "x", "w"):
            out = F.when(sums[name] == largest, forms[name][k]).otherwise(out)
        return out

    return pick(0), pick(1), pick(2), pick(3)


def so3_exp(phi: Vec) -> Quat:
    t = norm(phi)
    small = t < SMALL
    k = F.when(small, 0.5 - t * t / 48).otherwise(F.sin(t / 2) / F.when(small, 1.0).otherwise(t))
    return (*scale(phi, k), F.cos(t / 2))


def so3_log(q: Quat) -> Vec:
    n, w = norm(q[:3]), q[3]
    small = n < SMALL
    safe = F.when(F.abs(w) < SMALL, SMALL).otherwise(w)
    k = F.when(small, 2 / safe - 2 * n * n / (3 * safe * safe * safe)).when(F.abs(w) < SMALL, F.when(w < 0, -1.0).otherwise(1.0) * F.pi() / F.when(small, 1.0).otherwise(n)).otherwise(2 * F.atan(n / safe) / F.when(small, 1.0).otherwise(n))
    return scale(q[:3], k)


def _curl(phi: Vec, v: Vec, a: Column, b: Column) -> Vec:
    """v + a phi x v + b phi x (phi x v)."""
    once = cross(phi, v)
    return add(v, add(scale(once, a), scale(cross(phi, once), b)))


def so3_left(phi: Vec, v: Vec) -> Vec:
    """The left Jacobian of SO3 applied to v."""
    t = norm(phi)
    small = t < SMALL
    safe = F.when(small, 1.0).otherwise(t)
    return _curl(phi, v, F.when(small, 0.5).otherwise((1 - F.cos(t)) / (safe * safe)), F.when(small, 1 / 6).otherwise((t - F.sin(t)) / (safe * safe * safe)))


def so3_left_inv(phi: Vec, v: Vec) -> Vec:
    t = norm(phi)
    small = t < 1e-4
    safe = F.when(small, 1.0).otherwise(t)
    return _curl(phi, v, F.lit(-0.5), F.when(small, 1 / 12).otherwise(1 / (safe * safe) - (1 + F.cos(safe)) / (2 * safe * F.sin(safe))))


class SO3(NamedTuple):
    q: Quat

    @staticmethod
    def exp(phi: Vec) -> SO3:
        return SO3(so3_exp(phi))

    def log(self) -> Vec:
        return so3_log(self.q)

    def inv(self) -> SO3:
        return SO3(q_inv(self.q))

    def mul(self, other: SO3) -> SO3:
        return SO3(q_mul(self.q, other.q))

    def act(self, p: Vec) -> Vec:
        return q_act(self.q, p)

    def adj(self, a: Vec) -> Vec:
        return q_act(self.q, a)

    def adj_t(self, a: Vec) -> Vec:
        return q_act(q_inv(self.q), a)

    def retr(self, a: Vec) -> SO3:
        return SO3.exp(a).mul(self)

    def matrix(self):
        return q_matrix(self.q)


class RxSO3(NamedTuple):
    q: Quat
    s: Column

    @staticmethod
    def exp(phi: Vec, sigma: Column) -> RxSO3:
        return RxSO3(so3_exp(phi), F.exp(sigma))

    def log(self) -> tuple[Vec, Column]:
        return so3_log(self.q), F.log(self.s)

    def inv(self) -> RxSO3:
        return RxSO3(q_inv(self.q), 1 / self.s)

    def mul(self, other: RxSO3) -> RxSO3:
        return RxSO3(q_mul(self.q, other.q), self.s * other.s)

    def act(self, p: Vec) -> Vec:
        return scale(q_act(self.q, p), self.s)


class SE3(NamedTuple):
    t: Vec
    q: Quat

    @staticmethod
    def of(prefix: str = "") -> SE3:
        """From columns tx ... qw behind a prefix."""
        return SE3(vec(*[f"{prefix}t{a}" for a in "xyz"]), tuple(F.col(f"{prefix}q{a}") for a in "xyzw"))

    @staticmethod
    def identity() -> SE3:
        z, o = F.lit(0.0), F.lit(1.0)
        return SE3((z, z, z), (z, z, z, o))

    @staticmethod
    def random(sigma: float = 1.0, seed: int = 0) -> SE3:
        """The exponential of a tangent of normal numbers, another one for each row."""
        tangent = [F.randn(seed + i) * sigma for i in range(6)]
        return SE3.exp(tuple(tangent[:3]), tuple(tangent[3:]))

    @staticmethod
    def exp(tau: Vec, phi: Vec) -> SE3:
        return SE3(so3_left(phi, tau), so3_exp(phi))

    def log(self) -> tuple[Vec, Vec]:
        phi = so3_log(self.q)
        return so3_left_inv(phi, self.t), phi

    def inv(self) -> SE3:
        back = q_inv(self.q)
        return SE3(scale(q_act(back, self.t), -1), back)

    def mul(self, other: SE3) -> SE3:
        return SE3(add(self.t, q_act(self.q, other.t)), q_mul(self.q, other.q))

    def retr(self, tau: Vec, phi: Vec) -> SE3:
        return SE3.exp(tau, phi).mul(self)

    def act(self, p: Vec, w: Column | None = None) -> Vec:
        """A point moved; of a homogeneous one (with w) the translation counts w times."""
        return add(q_act(self.q, p), self.t if w is None else scale(self.t, w))

    def adj(self, tau: Vec, phi: Vec) -> tuple[Vec, Vec]:
        turned = q_act(self.q, phi)
        return add(q_act(self.q, tau), cross(self.t, turned)), turned

    def adj_t(self, tau: Vec, phi: Vec) -> tuple[Vec, Vec]:
        back = q_inv(self.q)
        return q_act(back, tau), q_act(back, sub(phi, cross(self.t, tau)))

    def jinv(self, tau: Vec, phi: Vec, at: tuple[Vec, Vec] | None = None) -> tuple[Vec, Vec]:
        """The inverse left Jacobian at this transform applied to a tangent.

        z / (e^z - 1) of the adjoint of the logarithm, as the polynomial that
        agrees with it on the adjoint's spectrum. at: the logarithm where it
        has been projected before, which keeps the expression small.
        """
        rho, theta = self.log() if at is None else at
        t = norm(theta)
        small = t < 1e-2
        s = F.when(small, 1.0).otherwise(t)
        cot = 1 / F.tan(s / 2)
        g = s / 2 * cot
        slope = (s / 4 * (1 + cot * cot) - cot / 2) / (2 * s)
        a = F.when(small, 1 / 12).otherwise(2 * (1 - g) / (s * s) - slope)
        b = F.when(small, -1 / 720).otherwise(((1 - g) / (s * s) - slope) / (s * s))
        ad = lambda x: (add(cross(theta, x[0]), cross(rho, x[1])), cross(theta, x[1]))
        once = ad((tau, phi))
        twice = ad(once)
        four = ad(ad(twice))
        return tuple(add(add(x, scale(y, -0.5)), add(scale(z, a), scale(w, b))) for x, y, z, w in zip((tau, phi), once, twice, four, strict=True))  # type: ignore[return-value]

    def matrix(self):
        rows = q_matrix(self.q)
        z, o = F.lit(0.0), F.lit(1.0)
        return (*[(*r, x) for r, x in zip(rows, self.t, strict=True)], (z, z, z, o))

    @staticmethod
    def of_matrix(m) -> SE3:
        return SE3((m[0][3], m[1][3], m[2][3]), q_of_matrix([r[:3] for r in m[:3]]))

    def columns(self, prefix: str = "") -> list[Column]:
        return [*[c.alias(f"{prefix}t{a}") for c, a in zip(self.t, "xyz", strict=True)], *[c.alias(f"{prefix}q{a}") for c, a in zip(self.q, "xyzw", strict=True)]]


def matrix_inverse(m):
    """The inverse of a rigid 4x4 matrix: transposed rotation, turned translation."""
    t = (m[0][3], m[1][3], m[2][3])
    rows = [tuple(m[r][c] for r in range(3)) for c in range(3)]
    return [(*row, -dot(row, t)) for row in rows] + [tuple(F.lit(x) for x in (0.0, 0.0, 0.0, 1.0))]


class Sim3(NamedTuple):
    t: Vec
    q: Quat
    s: Column

    @staticmethod
    def _terms(phi: Vec, sigma: Column) -> tuple[Column, Column, Column]:
        t, s = norm(phi), F.exp(sigma)
        flat, even = t < SMALL, F.abs(sigma) < SMALL
        th, sg = F.when(flat, 1.0).otherwise(t), F.when(even, 1.0).otherwise(sigma)
        c = F.when(even, 1.0).otherwise((s - 1) / sg)
        si, co, q = s * F.sin(t), s * F.cos(t), th * th + sg * sg
        a = F.when(even & flat, 0.5).when(even, (1 - F.cos(t)) / (th * th)).when(flat, ((sg - 1) * s + 1) / (sg * sg)).otherwise((si * sg + (1 - co) * th) / (th * q))
        b = F.when(even & flat, 1 / 6).when(even, (t - F.sin(t)) / F.pow(th, 3)).when(flat, (s * sg * sg / 2 + s - 1 - sg * s) / F.pow(sg, 3)).otherwise((c - ((co - 1) * sg + si * th) / q) / (th * th))
        return c, a, b

    @staticmethod
    def exp(tau: Vec, phi: Vec, sigma: Column) -> Sim3:
        c, a, b = Sim3._terms(phi, sigma)
        once = cross(phi, tau)
        return Sim3(add(scale(tau, c), add(scale(once, a), scale(cross(phi, once), b))), so3_exp(phi), F.exp(sigma))

    def log(self, phi: Vec | None = None) -> tuple[Vec, Vec, Column]:
        """The tangent. phi: the rotation's logarithm where it has been projected before, which keeps the expression small."""
        phi, sigma = so3_log(self.q) if phi is None else phi, F.log(self.s)
        c, a, b = Sim3._terms(phi, sigma)
        # (c + a K + b K^2) x = t with K = phi x: x = p t + q K t + r K^2 t, and K^3 = -|phi|^2 K.
        n = dot(phi, phi)
        d, e = c - b * n, a
        det = d * d + e * e * n
        p = 1 / c
        q = -e / det
        r = F.when(n < SMALL * SMALL, (a * a - b * c) / (c * c * c)).otherwise((p - d / det) / F.when(n < SMALL * SMALL, 1.0).otherwise(n))
        once = cross(phi, self.t)
        return add(scale(self.t, p), add(scale(once, q), scale(cross(phi, once), r))), phi, sigma

    def inv(self) -> Sim3:
        back = q_inv(self.q)
        return Sim3(scale(q_act(back, self.t), -1 / self.s), back, 1 / self.s)

    def mul(self, other: Sim3) -> Sim3:
        return Sim3(add(self.t, scale(q_act(self.q, other.t), self.s)), q_mul(self.q, other.q), self.s * other.s)

    def act(self, p: Vec, w: Column | None = None) -> Vec:
        return add(scale(q_act(self.q, p), self.s), self.t if w is None else scale(self.t, w))

    def act_pose(self, pose: SE3) -> SE3:
        """A scaled transform applied to a pose: the point moves, the rotation turns."""
        return SE3(self.act(pose.t), q_mul(self.q, pose.q))


def incomplete_rig(transform: Sim3, pose: SE3, right: Vec) -> SE3:
    """transform * pose * translation."""
    return transform.act_pose(pose.mul(SE3(right, SE3.identity().q)))


def yaw_pitch(yaw: Column, pitch: Column) -> Quat:
    """The rotation of extrinsic x (pitch) and then y (yaw)."""
    z = F.lit(0.0)
    return q_mul((z, F.sin(yaw / 2), z, F.cos(yaw / 2)), (F.sin(pitch / 2), z, z, F.cos(pitch / 2)))


def interpolate(a: SE3, b: SE3, dt: Column, at: Column) -> SE3:
    """Constant velocity from a: the tangent between two poses over dt + 1e-3, followed for a time."""
    tau, phi = b.mul(a.inv()).log()
    k = at / (dt + 1e-3)
    return SE3.exp(scale(tau, k), scale(phi, k)).mul(a)


def extrapolate(before: SE3, last: SE3) -> SE3:
    """Half the last motion once more."""
    tau, phi = last.mul(before.inv()).log()
    return SE3.exp(scale(tau, 0.5), scale(phi, 0.5)).mul(last)


def _householder(x: Vec) -> tuple[Vec, Column]:
    """v with last entry 1 and beta, so that the reflection 1 - beta v v^T takes x to its length on the last axis."""
    sigma = x[0] * x[0] + x[1] * x[1]
    sigma = F.when(sigma < 1e-7, sigma + 1e-7).otherwise(sigma)
    n = norm(x)
    pivot = F.when(x[2] < 0, x[2] - n).otherwise(-sigma / (x[2] + n))
    return (x[0] / pivot, x[1] / pivot, F.lit(1.0)), 2 * pivot * pivot / (sigma + pivot * pivot)


def sphere_plus(x: Vec, a: Column, b: Column) -> Vec:
    """A point of a sphere moved by a tangent of two numbers; its length stays."""
    t = F.sqrt(a * a + b * b)
    sinc = F.when(t < 1e-7, 1.0).otherwise(F.sin(t) / F.when(t < 1e-7, 1.0).otherwise(t))
    step = (sinc * a, sinc * b, F.cos(t))
    v, beta = _householder(x)
    return scale(sub(step, scale(v, beta * dot(v, step))), norm(x))


def sphere_jacobian(x: Vec) -> tuple[Vec, Vec]:
    """The columns of the derivative of ``sphere_plus`` by the tangent at 0, for a unit vector."""
    v, beta = _householder(x)
    column = lambda k: tuple((F.lit(1.0) if i == k else F.lit(0.0)) - beta * v[i] * v[k] for i in range(3))
    return column(0), column(1)
