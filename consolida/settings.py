"""Settings of a run: a JSON file over the defaults, environment variables over both, and logging.

Keys of the file are the fields of ``Settings``.  ``CONSOLIDA_<FIELD>`` in the
environment overrides a plain field; ``CONSOLIDA_MODEL`` names the first model,
``CONSOLIDA_NO_MODEL=1`` switches models off.
"""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path

from consolida.operators.chunking import SOFT_TARGET, WINDOW
from consolida.operators.rendering import TEMPLATE
from consolida.sources.model_calls import CallSettings, confidence_settings, model_name

LOG = logging.getLogger("consolida")
PREFIX = "CONSOLIDA_"


class SettingsError(ValueError):
    """Settings that cannot be used; the message names the field."""


@dataclass(frozen=True)
class Settings:
    """All that a run can be told; ``models``: by key, each with model_id, url and the name of its key's variable."""

    models: dict = field(default_factory=dict)
    primary: str | None = None
    secondary: str | None = None
    retries: int = 5
    base_delay: float = 10.0
    max_delay: float = 60.0
    min_interval: float = 10.0
    parallelism: int = 1
    timeout: float = 150.0
    confidence_threshold: int = 70
    confidence_action: str = "pass"
    confidence_enabled: bool = True
    soft_target: int = SOFT_TARGET
    context_window: int = WINDOW
    template: str | None = None
    log_level: str = "INFO"
    log_file: str | None = None

    def chosen(self) -> tuple[str, ...]:
        """Ids of the first and the second model; none without models."""
        if not self.models:
            return ()
        names = [self.primary or next(iter(self.models)), *([self.secondary] if self.secondary else [])]
        try:
            return tuple(dict.fromkeys(model_name(n, self.models) for n in names))
        except KeyError as unknown:
            raise SettingsError(f"models: no {unknown}") from None

    def calls(self) -> CallSettings:
        return CallSettings(self.chosen() or ("primary",), self.retries, self.base_delay, self.max_delay, min_interval=self.min_interval, parallelism=self.parallelism)

    def confidence(self) -> tuple[int | None, bool]:
        """(threshold or none, whether unsure chunks are asked once more)."""
        threshold, action = confidence_settings({"threshold": self.confidence_threshold, "action": self.confidence_action})
        return (threshold, action == "retry") if self.confidence_enabled else (None, False)

    def template_text(self) -> str:
        return Path(self.template).read_text(encoding="utf-8") if self.template else TEMPLATE


_PLAIN = {"int": int, "float": float, "bool": lambda v: str(v).strip().lower() in ("1", "true", "yes", "on"), "str": str, "str | None": str}


def load(path: str | None = None, environment: Mapping[str, str] | None = None) -> Settings:
    """The settings of a file, if there is one, under those of the environment; unknown fields and values out of type are errors."""
    environment = os.environ if environment is None else environment
    found = {}
    if path:
        try:
            found = json.loads(Path(path).read_text(encoding="utf-8"))
        except (OSError, json.JSONDecodeError) as problem:
            raise SettingsError(f"{path}: {problem}") from problem
    if not isinstance(found, dict):
        raise SettingsError(f"{path}: no JSON object")
    known = {f.name: f.type for f in fields(Settings)}
    if unknown := sorted(set(found) - set(known)):
        raise SettingsError(f"unknown: {', '.join(unknown)}")
    for name, kind in known.items():
        if kind in _PLAIN and (value := environment.get(PREFIX + name.upper())) is not None:
            found[name] = value
        if name in found and found[name] is not None and kind in _PLAIN:
            try:
                found[name] = _PLAIN[kind](found[name])
            except ValueError:
                raise SettingsError(f"{name}: {found[name]!r}") from None
    if model := environment.get(PREFIX + "MODEL"):
        found["primary"] = model
    if environment.get(PREFIX + "NO_MODEL") == "1":
        found["models"] = {}
    settings = Settings(**found)
    settings.chosen()
    return settings


def start_logging(settings: Settings) -> None:
    """One line an event, to standard error and, where named, to a file; a second call replaces the first."""
    for handler in list(LOG.handlers):
        LOG.removeHandler(handler)
        handler.close()
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if settings.log_file:
        Path(settings.log_file).parent.mkdir(parents=True, exist_ok=True)
        handlers.append(logging.FileHandler(settings.log_file, encoding="utf-8"))
    for handler in handlers:
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        LOG.addHandler(handler)
    try:
        LOG.setLevel(settings.log_level.upper())
    except ValueError:
        raise SettingsError(f"log_level: {settings.log_level!r}") from None
