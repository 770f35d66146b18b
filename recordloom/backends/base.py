"""What a model backend has to offer.

``factory(options)`` is called once per worker process and model step and returns a backend; ``options`` are the
run's model settings, plus ``json_schema`` (schema text) when the run has a schema.  The
factory must be picklable.  ``generate`` answers a batch in order, one result per request.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, Protocol


@dataclass(frozen=True)
class Request:
    messages: list[dict[str, str]]
    sampling_params: dict[str, Any]


@dataclass(frozen=True)
class Generation:
    text: str | None
    finish_reason: str | None = None
    n_output_tokens: int | None = None
    error: str | None = None


class Backend(Protocol):
    def generate(self, batch: list[Request]) -> list[Generation]: ...


BackendFactory = Callable[[dict[str, Any]], Backend]
