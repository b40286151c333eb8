"""Settings from the environment: generator providers."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

PROVIDER_FIELDS = ("api", "model", "key", "rpm")


@dataclass(frozen=True)
class Provider:
    api: str
    model: str
    key: str
    rpm: int | None = None


def read_dotenv(path: str) -> dict[str, str]:
    """KEY=value lines; comments and blank lines are skipped, quotes around a value go."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        name, sep, value = line.strip().removeprefix("export ").partition("=")
        if sep and not name.startswith("#"):
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def providers(env: Mapping[str, str] = os.environ, pool: str = "LLM_POOL", single: tuple[str, str, str] = ("LLM_API", "LLM_MODEL", "LLM_KEY")) -> list[Provider]:
    """The pool, a JSON array of objects; without it the single provider of three variables."""
    if not env.get(pool):
        values = [env.get(v, "").strip() for v in single]
        if not all(values):
            raise ValueError(f"set {pool} or {', '.join(single)}")
        return [Provider(*values)]
    items = json.loads(env[pool])
    if not isinstance(items, list) or not items:
        raise ValueError(f"{pool} must be a non-empty array")
    out = []
    for item in items:
        if not isinstance(item, dict) or set(item) - set(PROVIDER_FIELDS):
            raise ValueError(f"{pool}: an object of {PROVIDER_FIELDS} is wanted")
        if not all(isinstance(item.get(f), str) and item[f].strip() for f in PROVIDER_FIELDS[:3]):
            raise ValueError(f"{pool}: api, model and key are needed")
        rpm = item.get("rpm")
        if rpm is not None and (type(rpm) is not int or rpm <= 0):
            raise ValueError(f"{pool}: rpm must be a positive integer")
        out.append(Provider(item["api"].strip(), item["model"].strip(), item["key"].strip(), rpm))
    return out
