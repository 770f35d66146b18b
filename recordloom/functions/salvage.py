"""What is usable of a JSON object whose text ends too early, as one SQL expression.

The text is split at its quotation marks.  A push-down automaton runs over the parts as a fold: a
part inside of a string ends it unless an odd number of backslashes stands before the mark; a part
outside is cut into tokens, each of which moves the automaton or stops it.  The state is a few
numbers and the brackets that are open, so a step costs no more late in a text than early.

Whenever everything read so far could be closed, place and open brackets are noted.  The result is
the text up to the last such place and the missing brackets.  A token that may have been cut is
not taken: a string without its end, a word that is no literal, a number at the very end of the
text; nor is a name without its value.  What follows the first error is left out as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What may come next: the root, a value, a value or the end of its list, a name, a name or the end of
# its object, a colon, a comma or an end, nothing.
_ROOT, _VALUE, _ITEM, _NAME, _FIELD, _COLON, _NEXT, _NOTHING = range(8)

_TOKEN = r"[ \t\n\r]*(?:[-0-9][-+.0-9eE]*|[A-Za-z]+|[^ \t\n\r])"
_NUMBER = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?\z"
# A backslash that is left when all escapes are gone, or a control character.
_WRONG = r"[\\\x00-\x1F]"
_ESCAPE = r"\\(?:[\"\\/bfnrt]|u[0-9a-fA-F]{4})"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _state(base: str, **changed: str) -> str:
    """The automaton's state with some fields changed."""
    fields = ["at", "inside", "next", "open", "safe", "safe_open", "stopped"]
    return "named_struct(" + ", ".join(f"'{f}', {changed.get(f, f'{base}.{f}')}" for f in fields) + ")"


def _after_value(base: str, **changed: str) -> str:
    """A value is complete, so all before can be closed here."""
    return _state(base, next=str(_NEXT), safe=f"{base}.at", safe_open=f"{base}.open", **changed)


def _stop(base: str) -> str:
    return _state(base, stopped="true")


def _token_step() -> str:
    """``s`` is the state with ``at`` behind the token ``t`` (no blanks); ``last`` if the text ends there."""
    pushed = lambda closer, then: _state(
        "s", next=str(then), open=f"concat('{closer}', s.open)", safe="s.at",
        safe_open=f"concat('{closer}', s.open)",
    )
    rest = "substring(s.open, 2)"
    popped = _state(
        "s", next=f"CASE WHEN {rest} = '' THEN {_NOTHING} ELSE {_NEXT} END", open=rest, safe="s.at",
        safe_open=rest,
    )
    wants_value = f"s.next IN ({_VALUE}, {_ITEM})"
    return f"""CASE
      WHEN t = '{{' AND s.next IN ({_ROOT}, {_VALUE}, {_ITEM}) THEN {pushed('}', _FIELD)}
      WHEN t = '[' AND {wants_value} THEN {pushed(']', _ITEM)}
      WHEN t = '}}' AND left(s.open, 1) = t AND s.next IN ({_FIELD}, {_NEXT}) THEN {popped}
      WHEN t = ']' AND left(s.open, 1) = t AND s.next IN ({_ITEM}, {_NEXT}) THEN {popped}
      WHEN t = ',' AND s.next = {_NEXT}
        THEN {_state("s", next=f"CASE WHEN left(s.open, 1) = '}}' THEN {_NAME} ELSE {_VALUE} END")}
      WHEN t = ':' AND s.next = {_COLON} THEN {_state("s", next=str(_VALUE))}
      WHEN t IN ('true', 'false', 'null') AND {wants_value} THEN {_after_value("s")}
      WHEN NOT last AND {wants_value} AND t RLIKE {_literal(_NUMBER)} THEN {_after_value("s")}
      ELSE {_stop("s")} END"""


def _bound(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _outside_step(size: str) -> str:
    """State ``acc`` after the tokens of a part outside of strings and the mark that ends it."""
    blank = "' \\t\\n\\r'"
    moved = _state("b", at="b.at + length(u)")
    step = _bound("s", moved, _bound("last", f"s.at >= {size}", _bound(
        "t", f"trim(BOTH {blank} FROM u)", _token_step())))
    folded = (
        f"aggregate(regexp_extract_all(part.chunk, {_literal(_TOKEN)}, 0), acc, "
        f"(b, u) -> CASE WHEN b.stopped THEN b ELSE {step} END)"
    )
    takes = f"d.next IN ({_VALUE}, {_ITEM}, {_NAME}, {_FIELD}) AND NOT part.last"
    entered = _state("d", at="acc.at + length(part.chunk) + 1", inside="true")
    return _bound(
        "d", folded, f"CASE WHEN d.stopped THEN d WHEN {takes} THEN {entered} ELSE {_stop('d')} END"
    )


def _inside_step() -> str:
    """State ``acc`` after a part of a string and the mark behind it."""
    ends = "length(regexp_extract(part.chunk, '\\\\\\\\*\\\\z', 0)) % 2 = 0"
    # A mark that is escaped belongs to the last escape of its part.
    read = f"regexp_replace(CASE WHEN {ends} THEN part.chunk ELSE concat(part.chunk, '\"') END, {_literal(_ESCAPE)}, '')"
    wrong = f"{read} RLIKE {_literal(_WRONG)}"
    moved = _state("acc", at="acc.at + length(part.chunk) + 1")
    named = _state("s", next=str(_COLON), inside="false")
    return _bound("s", moved, f"""CASE
      WHEN part.last OR {wrong} THEN {_stop("s")}
      WHEN NOT {ends} THEN s
      WHEN s.next IN ({_NAME}, {_FIELD}) THEN {named}
      ELSE {_after_value("s", inside="false")} END""")


def salvaged(text: str) -> Column:
    """STRUCT<text, complete, n_dropped> of the named column; NULL if no object begins there.

    ``complete`` tells that nothing had to be closed or left out but blanks; ``n_dropped`` is the
    number of characters that were left out.
    """
    size = f"length(`{text}`)"
    start = (
        f"named_struct('at', 0, 'inside', false, 'next', {_ROOT}, 'open', '', 'safe', 0, "
        "'safe_open', '', 'stopped', false)"
    )
    parts = _bound(
        "chunks", f"split(`{text}`, '\"', -1)",
        "transform(chunks, (c, i) -> named_struct('chunk', c, 'last', i = size(chunks) - 1))",
    )
    folded = (
        f"aggregate({parts}, {start}, (acc, part) -> CASE WHEN acc.stopped THEN acc "
        f"WHEN acc.inside THEN {_inside_step()} ELSE {_outside_step(size)} END)"
    )
    rest = f"substring(`{text}`, e.safe + 1)"
    result = (
        f"CASE WHEN e.safe > 0 THEN named_struct('text', concat(left(`{text}`, e.safe), e.safe_open), "
        f"'complete', e.safe_open = '' AND {rest} RLIKE '^[ \\\\t\\\\n\\\\r]*\\\\z', "
        f"'n_dropped', {size} - e.safe) END"
    )
    return F.expr(_bound("e", folded, result))
