"""Declarative pipelines: a YAML document, checked and with its defaults, as plain values.

A stage runs only if its section is there; ``enabled`` is then true unless said otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass, field

FORMATS = ("parquet", "jsonl", "csv")


@dataclass(frozen=True)
class Normalise:
    enabled: bool = True
    max_breaks: int = 2


@dataclass(frozen=True)
class Quality:
    enabled: bool = True
    action: str = "drop"
    min_words: int = 30
    max_words: int | None = None
    min_chars: int = 100
    max_symbol_ratio: float = 0.2
    min_alpha_ratio: float = 0.6
    max_duplicate_line_fraction: float = 0.35
    max_ellipsis_line_fraction: float = 0.3


@dataclass(frozen=True)
class Dedup:
    enabled: bool = True
    action: str = "drop"
    near: bool = False
    hamming: int = 3


@dataclass(frozen=True)
class Output:
    format: str = "parquet"
    path: str = ""
    compression: str = "zstd"
    max_rows_per_file: int | None = None


@dataclass(frozen=True)
class Pipeline:
    name: str
    source: dict
    output: Output
    normalise: Normalise | None = None
    quality: Quality | None = None
    dedup: Dedup | None = None
    problems: tuple[str, ...] = field(default=())


def _section(kind, value: dict, where: str):
    unknown = set(value) - set(kind.__dataclass_fields__)
    if unknown:
        raise ValueError(f"{where}: unknown keys {sorted(unknown)}")
    return kind(**value)


def load(text: str) -> Pipeline:
    """Parse and check a pipeline; raises ``ValueError`` with what is wrong."""
    import yaml

    data = yaml.safe_load(text)
    if not isinstance(data, dict) or not data.get("name") or not isinstance(data.get("source"), dict):
        raise ValueError("a pipeline needs a name and a source")
    parts = {k: _section(kind, data[k] or {}, k) for k, kind in (("normalise", Normalise), ("quality", Quality), ("dedup", Dedup), ("output", Output)) if k in data}
    if "output" not in parts:
        raise ValueError("a pipeline needs an output")
    if parts["output"].format not in FORMATS:
        raise ValueError(f"output.format is one of {', '.join(FORMATS)}")
    for k in ("quality", "dedup"):
        if k in parts and parts[k].action not in ("drop", "flag"):
            raise ValueError(f"{k}.action is drop or flag")
    unknown = set(data) - {"name", "source", "normalise", "quality", "dedup", "output"}
    if unknown:
        raise ValueError(f"unknown sections {sorted(unknown)}")
    return Pipeline(data["name"], data["source"], **parts)
