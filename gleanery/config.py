"""Behavioural settings, with environment overrides. Driver-side only."""

from __future__ import annotations

import dataclasses
import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class FilterSettings:
    min_width: int = 1920
    min_height: int = 1080
    min_file_size: int = 102_400
    max_file_size: int = 20_971_520
    min_aspect: float = 0.5
    max_aspect: float = 3.0
    max_text_coverage: float = 0.50
    hamming_threshold: int = 10


@dataclass(frozen=True)
class ScoreSettings:
    quality_threshold: float = 5.5
    temperature: float = 0.07
    #: Fixed values: (aesthetic, technical, suitability) by lower-case source.
    weights: Mapping[str, tuple[float, float, float]] = field(default_factory=lambda: {"reddit": (0.60, 0.15, 0.25), "unsplash": (0.40, 0.10, 0.50), "pexels": (0.40, 0.10, 0.50)})
    default_weights: tuple[float, float, float] = (0.55, 0.15, 0.30)


@dataclass(frozen=True)
class HistorySettings:
    window_runs: int = 30
    increase: float = 0.30
    maintain: float = 0.10
    reduce: float = 0.05


@dataclass(frozen=True)
class Settings:
    filters: FilterSettings = FilterSettings()
    scores: ScoreSettings = ScoreSettings()
    history: HistorySettings = HistorySettings()


def typed(text: str) -> Any:
    """An environment value: booleans come before numbers, so "1" is true."""
    low = text.strip().lower()
    if low in ("true", "1", "yes", "on"):
        return True
    if low in ("false", "0", "no", "off"):
        return False
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def expand(text: str, env: Mapping[str, str] = os.environ) -> str:
    """${NAME} becomes the variable's value; an unknown name stays."""
    return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], m[0]), text)


def lookup(tree: Mapping[str, Any], path: str, default: Any = None) -> Any:
    """The value at a dotted path; the default if any hop is missing."""
    here: Any = tree
    for hop in path.split("."):
        if not isinstance(here, Mapping) or hop not in here:
            return default
        here = here[hop]
    return here


def from_env(prefix: str = "GLEANERY", env: Mapping[str, str] = os.environ) -> Settings:
    """Settings with overrides such as GLEANERY_FILTERS_MIN_WIDTH=2560."""
    settings = Settings()
    for section in dataclasses.fields(settings):
        part = getattr(settings, section.name)
        changes = {}
        for f in dataclasses.fields(part):
            raw = env.get(f"{prefix}_{section.name}_{f.name}".upper())
            if raw is not None and not isinstance(getattr(part, f.name), Mapping):
                changes[f.name] = type(getattr(part, f.name))(typed(expand(raw, env)))
        if changes:
            settings = dataclasses.replace(settings, **{section.name: dataclasses.replace(part, **changes)})
    return settings


def missing_settings(found: Mapping[str, Any], needed: Mapping[str, tuple[str, ...]]) -> list[str]:
    """A warning for each section or key that a configuration lacks; the run goes on with defaults."""
    out = []
    for section, keys in needed.items():
        part = found.get(section)
        if not isinstance(part, Mapping):
            out.append(f"no section {section}")
        else:
            out += [f"no {section}.{key}" for key in keys if key not in part]
    return out


def read_settings(path: str) -> dict[str, Any]:
    """Sections of a JSON or YAML file, with ${NAME} expanded and values typed as in the environment.
    YAML is read as far as nested mappings, lists of scalars and scalars go."""
    with open(path, encoding="utf-8") as f:
        text = expand(f.read())
    if path.endswith(".json"):
        return json.loads(text)
    return _yaml([(len(line) - len(line.lstrip()), line.strip()) for line in (re.sub(r"(^|\s)#.*$", "", x).rstrip() for x in text.splitlines()) if line.strip()])[0]


def _yaml(lines: list[tuple[int, str]], at: int = 0, depth: int = 0) -> tuple[Any, int]:
    out: Any = [] if at < len(lines) and lines[at][1].startswith("- ") else {}
    while at < len(lines) and lines[at][0] >= depth:
        indent, line = lines[at]
        at += 1
        if isinstance(out, list):
            out.append(typed(line[2:].strip().strip("\"'")))
            continue
        key, _, rest = line.partition(":")
        if rest.strip():
            inner = rest.strip()
            out[key.strip()] = [typed(x.strip().strip("\"'")) for x in inner[1:-1].split(",") if x.strip()] if inner.startswith("[") else typed(inner.strip("\"'"))
        elif at < len(lines) and (lines[at][0] > indent or lines[at][1].startswith("- ") and lines[at][0] == indent):
            out[key.strip()], at = _yaml(lines, at, lines[at][0])
        else:
            out[key.strip()] = None
    return out, at
