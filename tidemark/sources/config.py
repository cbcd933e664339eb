"""Configuration from YAML with `${NAME}` and `${NAME:-default}`."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from ..errors import ConfigError

SECRET_WORDS = ("password", "passwd", "secret", "token", "key", "auth", "credential")
_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


def _typed(text: str) -> Any:
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    return int(text) if re.fullmatch(r"[+-]?\d+", text) else text


def substitute(value: Any, env: Mapping[str, str] | None = None) -> Any:
    """Fill in variables in all strings; an unset one without default raises.  Strings that then are numbers or truth values become them."""
    env = os.environ if env is None else env
    if isinstance(value, Mapping):
        return {k: substitute(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [substitute(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def fill(m: re.Match) -> str:
        if m[1] in env:
            return env[m[1]]
        if m[2] is None:
            raise ConfigError(f"{m[1]} isn't set")
        return m[2]

    return _typed(_VARIABLE.sub(fill, value))


def mask(value: Any, hidden: str = "***") -> Any:
    """The configuration with what its name makes a secret blotted out."""
    if isinstance(value, Mapping):
        return {k: hidden if any(w in str(k).lower() for w in SECRET_WORDS) else mask(v, hidden) for k, v in value.items()}
    return [mask(v, hidden) for v in value] if isinstance(value, list) else value


def fingerprint(value: Any) -> str:
    """SHA-256 of the masked configuration in a canonical form."""
    return hashlib.sha256(json.dumps(mask(value), sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


@dataclass(frozen=True)
class Config:
    values: dict[str, Any] = field(default_factory=dict)

    def get(self, path: str, default: Any = None) -> Any:
        """Value at a dotted path."""
        at: Any = self.values
        for name in path.split("."):
            if not isinstance(at, Mapping) or name not in at:
                return default
            at = at[name]
        return at

    @property
    def sessions(self) -> dict[str, tuple[int, int, int]]:
        """Sessions in the form that the time features take: start and end hour and a bit each."""
        found = self.get("sessions", {})
        return {k: (int(v["start_hour"]), int(v["end_hour"]), int(v.get("bit", 1 << i))) for i, (k, v) in enumerate(found.items())}


def load(path: str, env: Mapping[str, str] | None = None) -> Config:
    import yaml

    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f)
    if not isinstance(raw, Mapping):
        raise ConfigError(f"{path} is no mapping")
    return Config(substitute(raw, env))
