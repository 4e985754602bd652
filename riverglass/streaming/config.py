"""Settings of the jobs, from defaults, arguments and properties; properties win."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    """What both jobs are set to."""

    window: str = "60 seconds"
    window_offset: str = "0 seconds"
    edge_watermark: str = "5 seconds"
    cloud_watermark: str = "30 seconds"
    trigger: str = "60 seconds"
    trees: int = 50
    sample_size: int = 128
    decay: float = 7.8125e-4
    cloud_trees: int = 100
    cloud_sample_size: int = 256
    cloud_decay: float = 1e-4
    shingle: int = 4
    seed: int = 42
    threshold: float = 1.0
    secondary_threshold: float = 1.5
    near_ms: int = 60_000
    far_ms: int = 300_000
    cooldown_ms: int = 60_000
    key_ttl: str = "24 hours"
    batch_size: int = 10
    #: Keys of a device's Bloom filter; 0 keeps the keys themselves.
    bloom_capacity: int = 0
    #: Suppress and cool down by the time of processing, not of the event.
    processing_clock: bool = False

    @classmethod
    def of(cls, arguments: Mapping[str, str], properties: Mapping[str, str] | None = None) -> Config:
        """Defaults, then arguments, then properties; unknown names are an error."""
        known = {f.name: type(f.default) for f in fields(cls)}
        merged = {**arguments, **(properties or {})}
        unknown = sorted(set(merged) - set(known))
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return replace(cls(), **{k: str(v).lower() in ("true", "1", "yes") if known[k] is bool else known[k](v) for k, v in merged.items()})


def parse_arguments(args: list[str]) -> dict[str, str]:
    """--name value pairs; a name alone is true."""
    out: dict[str, str] = {}
    name = None
    for a in args:
        if a.startswith("--"):
            name = a[2:].replace("-", "_")
            out[name] = "true"
        elif name:
            out[name], name = a, None
        else:
            raise ValueError(f"a value without a name: {a}")
    return out
