"""Thresholds of the operators in one place, from defaults, a JSON file or a flat YAML file of sections."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    min_text_length: int = 100
    min_chunk_size: int = 200
    max_chunk_size: int = 2000
    chunk_size: int = 512
    chunk_overlap: int = 50
    chunk_method: str = "semantic"
    embedding_dim: int = 768
    embedding_batch: int = 200
    store_batch: int = 2000
    max_retries: int = 3

    @classmethod
    def of(cls, values: dict) -> Config:
        """Known names are taken, from sections too; unknown ones are left alone."""
        flat: dict = {}
        for k, v in values.items():
            flat |= v if isinstance(v, dict) else {k: v}
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in flat.items() if k in known})

    @classmethod
    def load(cls, path: str) -> Config:
        """On the driver: a small local file."""
        text = Path(path).read_text(encoding="utf-8")
        return cls.of(json.loads(text) if path.endswith(".json") else _sections(text))


def _sections(text: str) -> dict:
    """``name: value`` lines, indented below ``section:`` lines; comments and quotes are dropped."""
    out: dict = {}
    at = out
    for raw in text.splitlines():
        line = raw.split(" #", 1)[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#") or ":" not in line:
            continue
        name, value = (x.strip() for x in line.split(":", 1))
        if not value:
            at = out.setdefault(name, {})
            continue
        (at if line[0].isspace() else out)[name] = _value(value.strip("\"'"))
    return out


def _value(v: str) -> bool | int | float | str:
    if v.lower() in ("true", "false"):
        return v.lower() == "true"
    for kind in (int, float):
        try:
            return kind(v)
        except ValueError:
            pass
    return v
