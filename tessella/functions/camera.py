"""Camera models, pixel grids, distortion and gravity fields as column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.lie import Vec, dot, norm, scale

#: Depths below are taken as 1 when a point is projected.
MIN_DEPTH = 0.1
MODELS = ("PINHOLE", "MEI", "PANORAMA")


class Pinhole(NamedTuple):
    fx: Column
    fy: Column
    cx: Column
    cy: Column

    def unproject(self, u: Column, v: Column) -> Vec:
        return (u - self.cx) / self.fx, (v - self.cy) / self.fy, F.lit(1.0)

    def project(self, p: Vec, limit: bool = True, min_depth: float = MIN_DEPTH) -> tuple[Column, Column]:
        z = F.when(p[2] < min_depth, 1.0).otherwise(p[2]) if limit else p[2]
        return self.fx * p[0] / z + self.cx, self.fy * p[1] / z + self.cy

    def project_jacobian(self, p: Vec) -> tuple[Vec, Vec]:
        """Derivatives of u and v by the point."""
        z, o = p[2], F.lit(0.0)
        return (self.fx / z, o, -self.fx * p[0] / (z * z)), (o, self.fy / z, -self.fy * p[1] / (z * z))

    def scaled(self, s) -> Pinhole:
        return Pinhole(*[x * s for x in self])

    def pinhole(self) -> Pinhole:
        return self


class Mei(NamedTuple):
    fx: Column
    fy: Column
    cx: Column
    cy: Column
    k1: Column

    def unproject(self, u: Column, v: Column) -> Vec:
        x, y = (u - self.cx) / self.fx, (v - self.cy) / self.fy
        r2 = x * x + y * y
        k = (self.k1 + F.sqrt(1 + (1 - self.k1 * self.k1) * r2)) / (1 + r2)
        return x * k / (k - self.k1), y * k / (k - self.k1), F.lit(1.0)

    def project(self, p: Vec, limit: bool = True, min_depth: float = MIN_DEPTH) -> tuple[Column, Column]:
        z = F.when(p[2] < min_depth, 1.0).otherwise(p[2]) if limit else p[2]
        d = z + self.k1 * norm((p[0], p[1], z))
        return self.fx * p[0] / d + self.cx, self.fy * p[1] / d + self.cy

    def project_jacobian(self, p: Vec) -> tuple[Vec, Vec]:
        x, y, z = p
        r = norm(p)
        d = z + self.k1 * r
        n = d * d * r
        return (
            (self.fx * (d * r - self.k1 * x * x) / n, -self.fx * self.k1 * x * y / n, -self.fx * x * (self.k1 * z + r) / n),
            (-self.fy * self.k1 * x * y / n, self.fy * (d * r - self.k1 * y * y) / n, -self.fy * y * (self.k1 * z + r) / n),
        )

    def scaled(self, s) -> Mei:
        return Mei(*[x * s for x in self[:4]], self.k1)

    def pinhole(self) -> Pinhole:
        return Pinhole(self.fx / (1 + self.k1), self.fy / (1 + self.k1), self.cx, self.cy)


class Panorama(NamedTuple):
    def unproject(self, u: Column, v: Column) -> Vec:
        """A unit ray of u and v in [0, 1]."""
        theta, phi = (u - 0.5) * 2 * F.pi(), v * F.pi()
        return F.sin(phi) * F.sin(theta), -F.cos(phi), F.sin(phi) * F.cos(theta)

    def project(self, p: Vec) -> tuple[Column, Column]:
        return panorama_uv(p)

    def scaled(self, s) -> Panorama:
        return self


def camera(kind: str, params: list[Column]):
    """The model of a name; unknown names are refused."""
    if kind == "PINHOLE":
        return Pinhole(*params[:4])
    if kind == "MEI":
        return Mei(*params[:5])
    if kind == "PANORAMA":
        return Panorama()
    raise ValueError(f"no camera model {kind!r}; one of {', '.join(MODELS)}")


def project_by_type(kind: Column, params: Column, p: Vec) -> tuple[Column, Column]:
    """Project with the model that a row names; other names give null."""
    at = [params[i] for i in range(5)]
    got = {k: camera(k, at).project(p) for k in MODELS}
    pick = lambda i: F.when(kind == "PINHOLE", got["PINHOLE"][i]).when(kind == "MEI", got["MEI"][i]).when(kind == "PANORAMA", got["PANORAMA"][i])
    return pick(0), pick(1)


def panorama_uv(p: Vec) -> tuple[Column, Column]:
    r = norm(p)
    return F.atan2(p[0], p[2]) / (2 * F.pi()) + 0.5, F.acos(-p[1] / F.when(r == 0, 1.0).otherwise(r)) / F.pi()


def pinhole_uv(p: Vec, cam: Pinhole, width: Column, height: Column) -> tuple[Column, Column, Column]:
    """Place in [0, 1] of both axes and whether the point is seen; unseen ones are at 0."""
    z = F.when(p[2] > 0, p[2]).otherwise(1.0)
    u, v = (cam.fx * p[0] / z + cam.cx) / width, (cam.fy * p[1] / z + cam.cy) / height
    seen = (p[2] > 0) & (u >= 0) & (u <= 1) & (v >= 0) & (v <= 1)
    return F.when(seen, u).otherwise(0.0), F.when(seen, v).otherwise(0.0), seen


def intrinsics_of_fov(fov_y: Column, width: Column, height: Column) -> Pinhole:
    f = height / (2 * F.tan(fov_y / 2))
    return Pinhole(f, f, width / 2, height / 2)


def fov_degrees(focal: Column, width: Column) -> Column:
    return F.degrees(2 * F.atan(width / (2 * focal)))


def resized(cam: Pinhole, w0: Column, h0: Column, w1: Column, h1: Column) -> Pinhole:
    return Pinhole(cam.fx * w1 / w0, cam.fy * h1 / h0, cam.cx * w1 / w0, cam.cy * h1 / h0)


def cropped(cam: Pinhole, left: Column, top: Column) -> Pinhole:
    return Pinhole(cam.fx, cam.fy, cam.cx - left, cam.cy - top)


def standard_size(width: Column, height: Column, pixels: int = 384 * 512, step: int = 8) -> dict[str, Column]:
    """A size of about so many pixels, and the centred crop of it to multiples of a step."""
    k = F.sqrt(pixels / (width * height))
    w, h = F.floor(width * k), F.floor(height * k)
    return {"width": w, "height": h, "left": F.floor(w % step / 2), "top": F.floor(h % step / 2), "crop_width": w - w % step, "crop_height": h - h % step, "factor": width / w}


def recovered(cam: Pinhole, left: Column, top: Column, factor: Column) -> Pinhole:
    """Intrinsics of the original from those of a crop: the offset first, the factor then."""
    return Pinhole(cam.fx * factor, cam.fy * factor, (cam.cx + left) * factor, (cam.cy + top) * factor)


def pixel_grid(spark: SparkSession, width: int, height: int, centre: bool = False) -> DataFrame:
    """A row for each pixel: v, u and their places."""
    half = 0.5 if centre else 0.0
    rows = spark.range(width * height)
    return rows.select(F.floor(F.col("id") / width).cast("int").alias("v"), (F.col("id") % width).cast("int").alias("u")).withColumns({"y": F.col("v") + half, "x": F.col("u") + half})


def rays(u: Column, v: Column, cam: Pinhole, unit: bool = False) -> Vec:
    p = cam.unproject(u, v)
    return scale(p, 1 / norm(p)) if unit else p


def panorama_rays(u: Column, v: Column, width: int, height: int) -> Vec:
    """Rays of a grid whose first and last columns and rows lie on the borders."""
    return Panorama().unproject(u / max(1, width - 1), v / max(1, height - 1))


def box_samples(spark: SparkSession, low: tuple, high: tuple, spacing: float) -> DataFrame:
    """Evenly spaced points of a box, borders included."""
    counts = [max(2, int((b - a) / spacing) + 1) for a, b in zip(low, high, strict=True)]
    total = counts[0] * counts[1] * counts[2]
    at = [F.floor(F.col("id") / (counts[1] * counts[2])), F.floor(F.col("id") / counts[2]) % counts[1], F.col("id") % counts[2]]
    return spark.range(total).select(*[(a + i * (b - a) / (n - 1)).alias(c) for i, a, b, n, c in zip(at, map(F.lit, map(float, low)), map(float, high), counts, "xyz", strict=True)])


# Distortion of points on the image plane.


def radial(x: Column, y: Column, k1: Column) -> tuple[Column, Column]:
    k = 1 + k1 * (x * x + y * y)
    return x * k, y * k


def radial_undo(x: Column, y: Column, k1: Column) -> tuple[Column, Column]:
    k = 1 - k1 * (x * x + y * y)
    return x * k, y * k


def divisional(x: Column, y: Column, k1: Column) -> tuple[Column, Column]:
    r2 = x * x + y * y
    below = 2 * k1 * r2
    k = F.when(below == 0, 1.0).otherwise((1 - F.sqrt(F.greatest(F.lit(0.0), 1 - 4 * k1 * r2))) / F.when(below == 0, 1.0).otherwise(below))
    return x * k, y * k


def divisional_undo(x: Column, y: Column, k1: Column) -> tuple[Column, Column]:
    k = 1 / (1 + k1 * (x * x + y * y))
    return x * k, y * k


def mei_distort(x: Column, y: Column, k1: Column) -> tuple[Column, Column]:
    k = 1 / (1 + k1 * F.sqrt(1 + x * x + y * y))
    return x * k, y * k


def mei_undo(x: Column, y: Column, k1: Column) -> tuple[Column, Column]:
    r2 = x * x + y * y
    k = (k1 + F.sqrt(1 + (1 - k1 * k1) * r2)) / (1 + r2)
    return x * k / (k - k1), y * k / (k - k1)


def divided(p: Vec, eps: float = 1e-3) -> tuple[Column, Column, Column]:
    """Perspective division and whether the point lies before the camera."""
    z = F.greatest(p[2], F.lit(eps))
    return p[0] / z, p[1] / z, p[2] > eps


def in_image(x: Column, y: Column, width: Column, height: Column) -> Column:
    return x.between(F.lit(0), width - 1) & y.between(F.lit(0), height - 1)


def updated_focal(fy: Column, delta: Column, height: Column, as_log: bool = False) -> Column:
    """A focal length moved by delta and held to fields of view from 5 to 150 degrees."""
    moved = fy * F.exp(delta) if as_log else fy + delta
    at = lambda degrees: height / (2 * F.tan(F.radians(F.lit(degrees)) / 2))
    return F.least(F.greatest(moved, at(150.0)), at(5.0))


def gravity(roll: Column, pitch: Column) -> Vec:
    return -F.sin(roll) * F.cos(pitch), -F.cos(roll) * F.cos(pitch), F.sin(pitch)


def roll_pitch(g: Vec) -> tuple[Column, Column]:
    """Roll and pitch of a unit gravity vector; upside down ones get the roll of their quadrant."""
    flat = F.greatest(F.sqrt(F.greatest(F.lit(0.0), 1 - g[2] * g[2])), F.lit(1e-9))
    side = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -g[0] / flat)))
    return F.when(g[1] < 0, side).otherwise(F.when(side < 0, -F.pi()).otherwise(F.pi()) - side), F.asin(g[2])


def up_field(x: Column, y: Column, g: Vec) -> tuple[Column, Column]:
    """The unit image direction that points up at a place of the image plane."""
    a, b = g[0] - g[2] * x, g[1] - g[2] * y
    n = F.greatest(F.sqrt(a * a + b * b), F.lit(1e-9))
    return a / n, b / n


def latitude(x: Column, y: Column, g: Vec) -> Column:
    """The angle of a ray above the horizon."""
    p = (x, y, F.lit(1.0))
    c = dot(p, g) / norm(p)
    return F.asin(F.least(F.greatest(c, F.lit(-1 + 1e-6)), F.lit(1 - 1e-6)))


def horizon(cam: Pinhole, g: Vec, width: Column, height: Column) -> tuple[Column, Column]:
    """Heights of the horizon at the left and right border, as shares of the image height."""
    at = lambda x: (cam.cy - cam.fy * (g[0] * (x - cam.cx) / cam.fx + g[2]) / g[1]) / height
    return at(F.lit(0.0)), at(width)


def detector_size(width: Column, height: Column, short: int = 800, longest: int = 1333) -> tuple[Column, Column]:
    """A size whose short side is given unless the long side would pass its limit."""
    low, high = F.least(width, height), F.greatest(width, height)
    target = F.when(high / low * short > longest, F.round(longest * low / high)).otherwise(F.lit(float(short)))
    return F.when(width < height, target).otherwise(F.floor(target * width / height)), F.when(width < height, F.floor(target * height / width)).otherwise(target)


def stride_size(width: Column, height: Column, longest: int = 1040, stride: int = 16, align: bool = True) -> tuple[Column, Column]:
    """A size with a limited long side, rounded half to even to multiples of a stride (and one more with aligned corners)."""
    k = F.least(F.lit(1.0), longest / F.greatest(width, height))
    one = 1 if align else 0
    fit = lambda x: F.bround((x * k - one) / stride) * stride + one
    return fit(width), fit(height)


def patch_size(width: Column, height: Column, pixels: int = 255_000, patch: int = 14) -> tuple[Column, Column]:
    """Multiples of a patch near the aspect ratio, shrunk until they fit into the number of pixels."""
    k = F.sqrt(pixels / (width * height))
    start = F.struct(F.greatest(F.lit(1.0), F.bround(width * k / patch)).alias("w"), F.greatest(F.lit(1.0), F.bround(height * k / patch)).alias("h"))

    def shrink(s: Column, _: Column) -> Column:
        big = s["w"] * s["h"] * patch * patch > pixels
        wide = s["w"] / s["h"] > width / height
        return F.struct(F.when(big & wide, s["w"] - 1).otherwise(s["w"]).alias("w"), F.when(big & ~wide, s["h"] - 1).otherwise(s["h"]).alias("h"))

    got = F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, shrink)
    return got["w"] * patch, got["h"] * patch


def align_size(base: Column, max_points: Column, frames: Column) -> Column:
    return F.least(base, F.greatest(F.lit(4), F.floor(F.sqrt(max_points / frames))))


def box_corners(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> tuple[Column, ...]:
    """Pixel corners of a box that is given by fractions of its centre and size."""
    whole = lambda x: x.cast("int")
    return whole((cx - w / 2) * width), whole((cy - h / 2) * height), whole((cx + w / 2) * width), whole((cy + h / 2) * height)


#: How points of the image plane are distorted, and how that is undone, by the name of a model.
DISTORTIONS = {"pinhole": (lambda x, y, k: (x, y), lambda x, y, k: (x, y)), "radial": (radial, radial_undo), "divisional": (divisional, divisional_undo), "mei": (mei_distort, mei_undo)}


def image_to_world(u: Column, v: Column, cam: Pinhole, model: str = "pinhole", k1: Column | None = None) -> tuple[Column, Column]:
    """A pixel's place on the image plane: normalised, and its distortion undone."""
    return DISTORTIONS[model][1]((u - cam.cx) / cam.fx, (v - cam.cy) / cam.fy, F.lit(0.0) if k1 is None else k1)


def world_to_image(p: Vec, cam: Pinhole, model: str = "pinhole", k1: Column | None = None) -> tuple[Column, Column, Column]:
    """A point's pixel, and whether it lies before the camera."""
    x, y, seen = divided(p)
    x, y = DISTORTIONS[model][0](x, y, F.lit(0.0) if k1 is None else k1)
    return x * cam.fx + cam.cx, y * cam.fy + cam.cy, seen


def field_jacobian(x: Column, y: Column, f: Column, roll: Column, pitch: Column) -> list[tuple[Column, Column, Column]]:
    """Derivatives of the up direction (x, y) and the latitude at a place of the image plane by roll, pitch and the logarithm of the focal length."""
    g = gravity(roll, pitch)
    by_roll = (g[1], -g[0], F.lit(0.0))
    by_pitch = (F.sin(roll) * F.sin(pitch), F.cos(roll) * F.sin(pitch), F.cos(pitch))
    a, b = g[0] - g[2] * x, g[1] - g[2] * y
    n = F.greatest(F.sqrt(a * a + b * b), F.lit(1e-9))
    up = lambda da, db: (da / n - a * (a * da + b * db) / (n * n * n), db / n - b * (a * da + b * db) / (n * n * n))
    r = norm((x, y, F.lit(1.0)))
    c = (x * g[0] + y * g[1] + g[2]) / r
    flat = F.sqrt(F.greatest(1 - c * c, F.lit(1e-12)))
    out = []
    for d in (by_roll, by_pitch):
        out.append((*up(d[0] - d[2] * x, d[1] - d[2] * y), (x * d[0] + y * d[1] + d[2]) / r / flat))
    # A longer focal length moves the place towards the middle.
    slope = (-(x * g[0] + y * g[1]) / r + c * (x * x + y * y) / (r * r)) / flat
    out.append((*up(g[2] * x, g[2] * y), slope))
    return out


def display_pixels(p: Vec, cam: Pinhole, width: int, height: int) -> tuple[Column, Column, Column]:
    """The pixel on which a point is drawn, rounded half to even about pixel centres, and whether it is in the image and before the camera."""
    u, v = cam.project(p)
    seen = (p[2] > 0) & (u >= 0) & (u < width) & (v >= 0) & (v < height)
    return F.bround(u - 0.5).cast("int"), F.bround(v - 0.5).cast("int"), seen
