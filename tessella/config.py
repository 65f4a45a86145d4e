"""Configuration of a run: typed, bounded, unknown keys refused."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any


def _at_least(name: str, value: float, low: float) -> None:
    if value < low:
        raise ValueError(f"{name} is {value}, at least {low}")


@dataclass(frozen=True)
class Streams:
    instance: str = "movie_list"
    base_path: str = ""
    frame_start: int = 0
    frame_end: int = 1000
    frame_skip: int = 1

    def __post_init__(self):
        if self.instance not in ("movie_list", "frame_folder"):
            raise ValueError(f"no stream source {self.instance!r}")
        _at_least("frame_start", self.frame_start, 0)
        _at_least("frame_skip", self.frame_skip, 1)


@dataclass(frozen=True)
class Kernel:
    name: str | None = None
    threshold: float = 1.0
    mu_init: float = 1.0
    mu_step: float = 3.0
    mu_max: float = 1e6

    def __post_init__(self):
        from tessella.functions.robust import kernel

        kernel(self.name, self.threshold)


@dataclass(frozen=True)
class Frontend:
    thresh: float = 16.0
    window: int = 25
    radius: int = 2
    nms: int = 1
    edges: int = 48


@dataclass(frozen=True)
class Backend:
    thresh: float = 22.0
    radius: int = 2
    nms: int = 3
    iters: int = 24
    edges_per_keyframe: int = 16


@dataclass(frozen=True)
class Slam:
    buffer: int = 1024
    filter_thresh: float = 2.4
    warmup: int = 8
    keyframe_thresh: float = 4.0
    frontend: Frontend = field(default_factory=Frontend)
    backend: Backend = field(default_factory=Backend)
    frontend_backend_iters: tuple[int, ...] = (16, 64, 256)
    infill_chunk: int = 16
    map_filter_thresh: float = 0.05
    dense_disp_alpha: float = 0.001
    optimize_intrinsics: bool = True
    kernel: Kernel = field(default_factory=Kernel)
    solver: str = "auto"

    def __post_init__(self):
        _at_least("buffer", self.buffer, 2)
        _at_least("warmup", self.warmup, 2)
        if self.solver not in ("auto", "fused", "generic"):
            raise ValueError(f"no solver {self.solver!r}")


@dataclass(frozen=True)
class Pipeline:
    instance: str = "default"
    camera_type: str = "PINHOLE"
    depth_model: str | None = "unidepth-l"
    per_frame_intrinsics: bool = False
    window: int = 10
    overlap: int = 3
    virtual_views: int = 0
    skip_exists: bool = False
    slam: Slam = field(default_factory=Slam)

    def __post_init__(self):
        if self.camera_type not in ("PINHOLE", "MEI", "PANORAMA"):
            raise ValueError(f"no camera {self.camera_type!r}")
        if not 0 <= self.overlap < self.window:
            raise ValueError("overlap lies below window")


@dataclass(frozen=True)
class Run:
    streams: Streams = field(default_factory=Streams)
    pipeline: Pipeline = field(default_factory=Pipeline)


#: The named presets.
PRESETS: dict[str, Pipeline] = {
    "default": Pipeline(),
    "default_perframe_intr": Pipeline(per_frame_intrinsics=True),
    "dav3": Pipeline(depth_model="dav3", window=10, overlap=3),
    "lyra": Pipeline(depth_model="moge2"),
    "no_vda": Pipeline(depth_model="unidepth-l", window=1, overlap=0),
    "static_vda": Pipeline(depth_model="unidepth-l", window=32, overlap=10),
    "wide_angle": Pipeline(camera_type="MEI"),
    "panorama": Pipeline(instance="panorama", camera_type="PANORAMA", virtual_views=5, slam=Slam(buffer=256)),
}


def solver_for(views: int, camera_type: str, per_frame: bool, tracks: bool, rig_optimised: bool, wanted: str = "auto") -> str:
    """fused where its layout allows it: one pinhole view with shared intrinsics, a fixed rig and no tracks."""
    possible = views == 1 and camera_type == "PINHOLE" and not per_frame and not tracks and not rig_optimised
    if wanted == "fused" and not possible:
        raise ValueError("the fused solver needs one pinhole view, shared intrinsics, a fixed rig and no tracks")
    return wanted if wanted != "auto" else "fused" if possible else "generic"


def parsed(kind: type, values: dict[str, Any]):
    """A configuration from nested mappings; unknown keys fail."""
    known = {f.name: f for f in fields(kind)}
    if extra := sorted(set(values) - set(known)):
        raise ValueError(f"unknown keys of {kind.__name__}: {', '.join(extra)}")
    base = kind()
    out = {}
    for name, value in values.items():
        default = getattr(base, name)
        out[name] = parsed(type(default), value) if is_dataclass(default) and isinstance(value, dict) else value
    return replace(base, **out)


def equal(a, b) -> bool:
    """The eq resolver of configuration texts; neq is its opposite."""
    return str(a) == str(b)


def schema(kind: type = Run) -> dict[str, Any]:
    """The JSON schema of a configuration: its keys, their types and defaults; other keys are refused."""
    names = {bool: "boolean", int: "integer", float: "number", str: "string"}

    def of(value) -> dict[str, Any]:
        if is_dataclass(value):
            return {"type": "object", "properties": {f.name: of(getattr(value, f.name)) for f in fields(value)}, "additionalProperties": False}
        if isinstance(value, tuple):
            return {"type": "array", "items": of(value[0]) if value else {}, "default": list(value)}
        if value is None:
            return {"type": ["string", "null"], "default": None}
        return {"type": names[type(value)], "default": value}

    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": kind.__name__, **of(kind())}
