"""Which completion service is used, from settings that the caller gives, and retrying of calls.

No service is built in: a caller lists services in order of preference and brings the function that calls one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Service:
    """A service with the settings that may hold its key, and its defaults."""

    name: str
    keys: tuple[str, ...]
    model: str
    url: str | None = None


@dataclass(frozen=True)
class Chosen:
    service: str
    model: str
    key: str
    url: str | None
    temperature: float


def choose(services: list[Service], settings: Mapping[str, str], prefix: str = "LLM") -> Chosen | None:
    """The service to use, or None where no key is set.

    ``<prefix>_PROVIDER`` names it; else it is the first whose key is set, or with a general key the
    first of all. ``<prefix>_API_KEY`` is a key for whatever service; a named service without a key
    of its own takes any key there is. ``<prefix>_MODEL`` and ``<prefix>_TEMPERATURE`` go before defaults.
    """
    general, wanted = settings.get(f"{prefix}_API_KEY"), settings.get(f"{prefix}_PROVIDER", "").lower()

    def key_of(service: Service) -> str | None:
        return next((settings[k] for k in service.keys if settings.get(k)), None)

    keyed = [(s, key_of(s)) for s in services]
    if wanted:
        service = next((s for s in services if s.name == wanted), Service(wanted, (), wanted))
        key = general or key_of(service) or next((k for _, k in keyed if k), None)
    elif general:
        service, key = (services[0] if services else None), general
    else:
        service, key = next(((s, k) for s, k in keyed if k), (None, None))
    if service is None or not key:
        return None
    return Chosen(service.name, settings.get(f"{prefix}_MODEL") or service.model, key, service.url, float(settings.get(f"{prefix}_TEMPERATURE") or 0.0))


def retrying(call: Callable[[str], str | None], times: int = 1, wait: float = 1.0) -> Callable[[str], str | None]:
    """``call`` tried again ``times`` times after a failure; the last failure is raised."""

    def run(prompt: str) -> str | None:
        for left in range(times, -1, -1):
            try:
                return call(prompt)
            except Exception:
                if not left:
                    raise
                time.sleep(wait)
        return None

    return run
