"""A deterministic stand-in for a model, for tests and measurements.

It is not a model.  It fills the record from a digest of the prompt and repeats the
prompt as the problem description, so the same prompt always gives the same record.  The
same record can be written as a Column (:func:`template_record`); both forms give the
same text, which is how the Python path is checked.  The backends imitate nothing of a
model: one writes that record, the other gives the last message back.
"""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.backends.base import Generation, Request
from recordloom.fields import DIFFICULTIES, ROOT, SIMULATED_SOURCES, Field, fields_of

NO_CONTENT = "request without content"

# What the stand-in may answer per text field; choices and flags come from the record.
ANSWERS: dict[str, tuple[str, ...]] = {
    "category": ("Storage", "Networking", "Boot", "Audio", "Packages"),
    "subcategory": ("Mount fails", "No address", "Slow start", "No sound"),
    "title": ("It stopped after an update", "It never worked here", "It works only sometimes"),
    "persona_description": ("New to the command line", "Runs servers at work"),
    "distribution": ("Debian 12", "Fedora 40", "Arch", "Alpine 3.20"),
    "kernel_version": ("6.1.0-18-amd64", "6.8.5-301.fc40.x86_64", "6.9.1-arch1-1"),
    "user_goal": ("Make it work again", "Understand the cause"),
    "acknowledgement": ("That is annoying.", "A common case.", "Thanks for the details."),
    "explanation": ("A setting was reset.", "A module is missing.", "A service starts too early."),
    "root_cause_simplified": ("Wrong setting", "Missing part", "Wrong order"),
}
CHOICES = {"difficulty": DIFFICULTIES, "simulated_source": SIMULATED_SOURCES}
REPEATS_PROMPT = "problem_description"


def _options(field: Field) -> tuple[Any, ...]:
    if field.kind == "flag":
        return (True, False)
    return CHOICES.get(field.name) or ANSWERS[field.name]


def _encoded(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _pieces(part: str = ROOT) -> list[str | list[str] | None]:
    """The record's text in pieces: fixed text, lists to draw from, None for the prompt."""
    out: list[str | list[str] | None] = []
    for i, f in enumerate(fields_of(part)):
        out.append(f'{"," if i else "{"}"{f.name}":')
        if f.kind == "part":
            out += _pieces(f.part)
        elif f.name == REPEATS_PROMPT:
            out.append(None)
        else:
            out.append([_encoded(option) for option in _options(f)])
    return [*out, "}"]


_PIECES = _pieces()


def template_text(prompt: str) -> str:
    """Record text for a prompt."""
    digest = hashlib.sha256(prompt.encode("utf-8")).hexdigest()
    at = 0
    text = []
    for piece in _PIECES:
        if piece is None:
            piece = _encoded(prompt)
        elif isinstance(piece, list):
            piece = piece[int(digest[at : at + 4], 16) % len(piece)]
            at += 4
        text.append(piece)
    return "".join(text)


def template_record(prompt: str) -> Column:
    """The same record as a STRUCT over the named prompt column.

    ``to_json`` of it equals :func:`template_text`.
    """
    digest = f"sha2(`{prompt}`, 256)"
    at = 1

    def fill(part: str) -> str:
        nonlocal at
        pairs = []
        for f in fields_of(part):
            if f.kind == "part":
                value = fill(f.part)
            elif f.name == REPEATS_PROMPT:
                value = f"`{prompt}`"
            else:
                options = _options(f)
                listed = ", ".join(repr(o) if isinstance(o, str) else str(o) for o in options)
                drawn = f"cast(conv(substr({digest}, {at}, 4), 16, 10) AS int) % {len(options)}"
                value = f"array({listed})[{drawn}]"
                at += 4
            pairs.append(f"'{f.name}', {value}")
        return f"named_struct({', '.join(pairs)})"

    return F.expr(fill(ROOT))


class TemplateBackend:
    """Answers every request with the record text of its last message."""

    def __init__(self, options: dict[str, Any]):
        pass

    def generate(self, batch: list[Request]) -> list[Generation]:
        return [Generation(template_text(r.messages[-1]["content"]), "stop") for r in batch]


class EchoBackend:
    """Answers with the last message as it is; one without content is a failure."""

    def __init__(self, options: dict[str, Any]):
        pass

    def generate(self, batch: list[Request]) -> list[Generation]:
        texts = [request.messages[-1]["content"] for request in batch]
        return [Generation(t, "stop") if t else Generation(None, error=NO_CONTENT) for t in texts]
