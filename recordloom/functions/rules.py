"""Checking rules of a record part, generated as SQL expressions from the field table.

The expressions look into one parsed VARIANT column.  Paths in rules and violations start
at the record (``$``); the record may sit deeper in the VARIANT, ``at`` says where.  SQL
text keeps building a plan cheap: one call into the JVM instead of thousands.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.fields import ROOT, Field, fields_of

# Verdict of one leaf, in the order in which a value is looked at.
FINE, MISSING, WRONG_TYPE, OUTSIDE, BEYOND = 0, 1, 2, 3, 4
# Whole numbers from here on (or below the negative) do not fit a BIGINT.
_LARGEST = "9.223372036854775808E18D"
_NO_VIOLATIONS = "cast(array() AS array<struct<path: string, rule: string>>)"


class Rule(NamedTuple):
    path: str
    parent: str
    field: Field


def rules_of(part: str = ROOT, extended: bool = False, path: str = "$") -> list[Rule]:
    """One rule per field, nested objects included, in declared order."""
    out: list[Rule] = []
    for f in fields_of(part, extended):
        here = f"{path}.{f.name}"
        out.append(Rule(here, path, f))
        if f.kind == "part":
            out += rules_of(f.part, extended, here)
    return out


def object_paths(part: str = ROOT, extended: bool = False) -> dict[str, list[str]]:
    """Path of every object of the part -> names of its declared fields."""
    out = {"$": [f.name for f in fields_of(part, extended)]}
    for rule in rules_of(part, extended):
        if rule.field.kind == "part":
            out[rule.path] = [f.name for f in fields_of(rule.field.part, extended)]
    return out


def list_rules(part: str = ROOT, extended: bool = False) -> list[Rule]:
    """The rules of lists of records; what is in them is judged item by item."""
    return [r for r in rules_of(part, extended) if r.field.kind == "parts"]


def each_item(document: str, path: str, value: str) -> str:
    """SQL: ``value`` of each item of the list at ``path``; it may use ``_item`` and ``_i``."""
    items = f"try_variant_get({document}, '{path}', 'array<variant>')"
    return f"transform({items}, (_item, _i) -> {value})"


def moved(path: str, at: str) -> str:
    """A record path as a path into the VARIANT."""
    return at + path[1:]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_name(verdict: str) -> str:
    """SQL: the rule that a verdict breaks, NULL for none."""
    return (
        f"CASE {verdict} WHEN {MISSING} THEN 'required' WHEN {WRONG_TYPE} THEN 'type' "
        f"WHEN {OUTSIDE} THEN 'enum' WHEN {BEYOND} THEN 'range' END"
    )


class RuleSet:
    """The rules of one part over a VARIANT column, in three steps.

    ``leaf_verdicts`` gives one number per leaf and decides about most records;
    ``all_verdicts`` adds the objects where needed.  Both are small enough for the JVM to
    compile together with the parse.  ``violations`` turns numbers into paths and rules.
    """

    def __init__(
        self,
        document: str,
        part: str = ROOT,
        extended: bool = False,
        at: str = "$",
        leaf_column: str = "_leaves",
        all_column: str = "_verdicts",
    ):
        self.document = f"`{document}`"
        self.at = at
        self.leaf_column = f"`{leaf_column}`"
        self.all_column = f"`{all_column}`"
        self.rules = rules_of(part, extended)
        self.leaves = [r for r in self.rules if r.field.kind != "part"]
        self.objects = [r for r in self.rules if r.field.kind == "part"]
        self.lists = list_rules(part, extended)

    # Column expressions

    def leaf_verdicts(self) -> Column:
        """ARRAY<INT>: what is wrong with each leaf."""
        return F.expr(f"array({', '.join(self._leaf(r) for r in self.leaves)})")

    def is_object(self) -> Column:
        """True when the value at ``at`` is an object (never NULL)."""
        return F.expr(f"{self._object('$')} = {FINE}")

    def all_verdicts(self, accepted: Column) -> Column:
        """ARRAY<INT> of leaves, then objects; empty when all is fine, NULL if not accepted."""
        fine = ", ".join([str(FINE)] * len(self.leaves))
        objects = ", ".join(self._object(r.path) for r in self.objects)
        return F.when(
            accepted,
            F.expr(
                f"CASE WHEN {self.leaf_column} = array({fine}) THEN cast(array() AS array<int>) "
                f"ELSE concat({self.leaf_column}, cast(array({objects}) AS array<int>)) END"
            ),
        )

    def violations(self, refused: str = "'json_object'") -> Column:
        """ARRAY<STRUCT<path, rule>>, at most one per path, in declared order.

        ``refused`` (SQL) names the only rule where the record was not accepted.  Fields of
        a missing or misplaced object are not reported on their own.  What is wrong inside
        lists of records comes last, with positions from 0 in its paths.
        """
        places = {r.path: i for i, r in enumerate(self.leaves + self.objects)}
        listed = ", ".join(
            f"named_struct('path', '{r.path}', 'own', {places[r.path]}, "
            f"'above', {places.get(r.parent, -1)})"
            for r in self.rules
        )
        own = f"{self.all_column}[r.own]"
        hidden = f"{own} = {MISSING} AND r.above >= 0 AND {self.all_column}[r.above] <> {FINE}"
        found = f"filter(array({listed}), r -> {own} <> {FINE} AND NOT ({hidden}))"
        named = (
            f"transform({found}, r -> named_struct('path', r.path, 'rule', {_rule_name(own)}))"
        )
        nothing, inside = _NO_VIOLATIONS, ""
        if self.lists:
            inside = ", ".join(
                f"coalesce({self._items(r)}, {_NO_VIOLATIONS})" for r in self.lists
            )
            nothing, named = f"concat({inside})", f"concat({named}, {inside})"
        return F.expr(
            f"CASE WHEN {self.all_column} IS NULL "
            f"THEN array(named_struct('path', '$', 'rule', {refused})) "
            f"WHEN size({self.all_column}) = 0 THEN {nothing} ELSE {named} END"
        )

    def _items(self, rule: Rule) -> str:
        """Violations in the items of one list of records, each with the item's position."""
        item = RuleSet("_item", rule.field.part)
        here = f"concat('{rule.path}[', _i, ']')"
        leaves = ", ".join(
            f"named_struct('path', concat({here}, '{leaf.path[1:]}'), "
            f"'rule', {_rule_name(item._leaf(leaf))})"
            for leaf in item.leaves
        )
        judged = (
            f"CASE WHEN coalesce(schema_of_variant(_item) LIKE 'OBJECT<%', false) "
            f"THEN filter(array({leaves}), r -> r.rule IS NOT NULL) "
            f"ELSE array(named_struct('path', {here}, 'rule', 'type')) END"
        )
        return f"flatten({each_item(self.document, moved(rule.path, self.at), judged)})"

    # SQL pieces

    def _get(self, path: str, data_type: str) -> str:
        return f"try_variant_get({self.document}, '{moved(path, self.at)}', '{data_type}')"

    def _type(self, path: str) -> str:
        """JSON type of the value at a path: NULL when missing, VOID for JSON null."""
        return f"schema_of_variant({self._get(path, 'variant')})"

    def _leaf(self, rule: Rule) -> str:
        found = self._type(rule.path)
        fits = self._fits(rule, found)
        absent = MISSING
        if rule.field.optional:
            fits, absent = f"({fits} OR {found} = 'VOID')", FINE
        cases = [
            f"WHEN {found} IS NULL THEN {absent}",
            f"WHEN NOT {fits} THEN {WRONG_TYPE}",
        ]
        if rule.field.choices:
            allowed = ", ".join(_text(c) for c in rule.field.choices)
            cases.append(
                f"WHEN {self._get(rule.path, 'string')} NOT IN ({allowed}) THEN {OUTSIDE}"
            )
        if rule.field.kind == "whole":
            number = self._get(rule.path, "double")
            cases.append(
                f"WHEN {found} <> 'BIGINT' AND ({number} >= {_LARGEST} OR {number} < -{_LARGEST}) "
                f"THEN {BEYOND}"
            )
        return f"CASE {' '.join(cases)} ELSE {FINE} END"

    def _fits(self, rule: Rule, found: str) -> str:
        """Does the JSON type of a value that is there suit the field?  Never by casting."""
        kind = rule.field.kind
        if kind in ("text", "flag"):
            return f"({found} = '{'STRING' if kind == 'text' else 'BOOLEAN'}')"
        if kind == "parts":
            return f"({found} LIKE 'ARRAY<%')"
        if kind == "whole":
            # 1.0 and 1e2 are integers in JSON Schema; 1.5 is not.
            number = self._get(rule.path, "double")
            return (
                f"({found} = 'BIGINT' OR (({found} LIKE 'DECIMAL(%' OR {found} IN "
                f"('DOUBLE', 'FLOAT')) AND {number} % 1 = 0))"
            )
        # A list of text: the merged element type would hide nulls among strings.
        items = self._get(rule.path, "array<variant>")
        return (
            f"({found} LIKE 'ARRAY<%' AND "
            f"coalesce(forall({items}, e -> schema_of_variant(e) = 'STRING'), false))"
        )

    def _object(self, path: str) -> str:
        """Verdict of an object.

        A leaf that was found proves every object above it.  The type of the object
        itself describes its whole content; it is looked up only where that leaf is
        missing.
        """
        found = self._type(path)
        cases = [
            f"WHEN {found} IS NULL THEN {MISSING}",
            f"WHEN {found} LIKE 'OBJECT<%' THEN {FINE}",
        ]
        for i, leaf in enumerate(self.leaves):
            if leaf.path.startswith(f"{path}.") and not leaf.field.optional:
                cases.insert(0, f"WHEN {self.leaf_column}[{i}] <> {MISSING} THEN {FINE}")
                break
        return f"CASE {' '.join(cases)} ELSE {WRONG_TYPE} END"
