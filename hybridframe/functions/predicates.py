"""Filter dictionaries compiled to boolean Columns.

Both filters keep SQL's three-valued logic: a missing key, a JSON null or a null document makes a
condition NULL, so the row is dropped by a filter and kept by a filtered delete. An operator that
is not known raises, since skipping it would widen a delete to every row.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

from hybridframe.functions.text import distinct_terms, tokens

COMPARE = {
    "$eq": operator.eq,
    "$gt": operator.gt,
    "$gte": operator.ge,
    "$lt": operator.lt,
    "$lte": operator.le,
}
LOGICAL = ("$and", "$or", "$not")
MAX_LONG = 2**63 - 1


def _all(parts: list[Column]) -> Column:
    return reduce(operator.and_, parts) if parts else F.lit(True)


def _any(parts: list[Column]) -> Column:
    return reduce(operator.or_, parts) if parts else F.lit(False)


def _parts(value, name: str) -> list:
    if not isinstance(value, (list, tuple)):
        raise ValueError(f"{name} takes a list, not {value!r}")
    return list(value)


# --- metadata ---------------------------------------------------------------------------------


def variant_path(key: str) -> str:
    """``a.b`` reads b inside a; ``a[0]`` reads an array element."""
    path = "$"
    for step in key.split("."):
        name, index = re.fullmatch(r"(.*?)((?:\[\d+\])*)", step, re.S).groups()
        quoted = f"['{name}']" if "'" not in name else f'["{name}"]'
        path += (f".{name}" if re.fullmatch(r"\w+", name) else quoted) + index
    return path


def _family(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    if isinstance(value, str):
        return "string"
    raise ValueError(f"a metadata filter compares with a number, a string or a boolean, not {value!r}")


class _Field:
    """One metadata key inside a variant: its value, and the family of its type."""

    def __init__(self, variant: Column, key: str):
        self.value = F.try_variant_get(variant, variant_path(key), "variant")
        self.type = F.schema_of_variant(self.value)

    def _of(self, family: str) -> Column:
        if family == "number":
            return self.type.isin("BIGINT", "DOUBLE", "FLOAT") | self.type.startswith("DECIMAL")
        return self.type == family.upper()

    def _as(self, type_name: str) -> Column:
        return F.try_variant_get(self.value, "$", type_name)

    def test(self, op: str, literal) -> Column:
        if literal is None:
            return F.lit(None).cast("boolean")
        compare, family = COMPARE[op], _family(literal)
        if family != "number":
            return self._guard(family, compare(self._as(family), F.lit(literal)))
        in_double = compare(self._as("double"), F.lit(float(literal)))
        if isinstance(literal, int) and abs(literal) <= MAX_LONG:
            whole = compare(self._as("bigint"), F.lit(literal).cast("bigint"))
            in_double = F.when(self.type == "BIGINT", whole).otherwise(in_double)
        return self._guard(family, in_double)

    def member(self, literals: list) -> Column:
        """True or false where the key is present, NULL where it is not."""
        families: dict[str, list] = {}
        for literal in literals:
            if literal is not None:
                families.setdefault(_family(literal), []).append(literal)
        result = F.when(self.type == "VOID", F.lit(None))
        for family, members in families.items():
            if family == "number":
                hit = _any([self.test("$eq", m) for m in members])
            else:
                hit = self._as(family).isin(members)
            result = result.when(self._of(family), hit)
        return result.when(self.type.isNotNull(), F.lit(False))

    def _guard(self, family: str, test: Column) -> Column:
        # No branch matches a missing key or a JSON null, which leaves NULL.
        return F.when(self._of(family), test).when(self.type != "VOID", F.lit(False))


def _operands(spec, key: str) -> list:
    """The filters below a logical operator. None at all, or an empty one, would let everything pass."""
    parts = _parts(spec, key)
    if not parts or any(isinstance(part, Mapping) and not part for part in parts):
        raise ValueError(f"{key} needs filters, and none of them empty")
    return parts


def _field_tests(variant: Column, key: str, spec) -> list[Column]:
    field = _Field(variant, key)
    if not isinstance(spec, Mapping):
        return [field.test("$eq", spec)]
    if not spec:
        raise ValueError(f"no operator is given for {key!r}")
    tests = []
    for op, literal in spec.items():
        if op in COMPARE:
            tests.append(field.test(op, literal))
        elif op == "$ne":
            tests.append(~field.test("$eq", literal))
        elif op == "$in":
            members = _parts(literal, op)
            tests.append(field.member(members) if members else F.lit(False))
        elif op == "$nin":
            tests.append(~field.member(_parts(literal, op)))
        else:
            raise ValueError(f"unknown metadata operator {op!r}")
    return tests


def where_variant(where: Mapping | None, variant: Column) -> Column:
    """Metadata filter over a VARIANT column."""
    if where is not None and not isinstance(where, Mapping):
        raise ValueError(f"a metadata filter is a dictionary, not {where!r}")
    parts: list[Column] = []
    for key, spec in (where or {}).items():
        if key in ("$and", "$or"):
            inner = [where_variant(sub, variant) for sub in _operands(spec, key)]
            parts.append(_all(inner) if key == "$and" else _any(inner))
        elif key == "$not":
            parts.append(~where_variant(_operands([spec], key)[0], variant))
        elif key.startswith("$"):
            raise ValueError(f"unknown metadata operator {key!r}")
        else:
            parts.extend(_field_tests(variant, key, spec))
    return _all(parts)


def where_json(where: Mapping | None, json: Column) -> Column:
    """Metadata filter over a JSON text column. The text is parsed once per row."""
    if not where:
        return where_variant(where, json)
    return F.exists(F.array(F.try_parse_json(json)), lambda v: where_variant(where, v))


def pushdown(where: Mapping | None, typed: Mapping[str, tuple[Column, str]]) -> Column | None:
    """A condition on typed copies of hot keys that every row passing ``where`` also passes.

    ``typed`` has the column and its family for each key. Added to the filter it changes no result, and unlike the variant it
    reaches the Parquet statistics. Only conditions that are ANDed at the top can be used, and only literals
    of the column's own family: others are left to the filter itself.
    """
    parts: list[Column | None] = []
    for key, spec in (where or {}).items():
        if key == "$and":
            parts.extend(pushdown(sub, typed) for sub in spec)
        elif key in typed:
            column, family = typed[key]
            tests = spec if isinstance(spec, Mapping) else {"$eq": spec}
            for op, literal in tests.items():
                if op in COMPARE and literal is not None:
                    parts.append(_wider(op, column, family, literal))
                elif op == "$in" and literal and None not in literal:
                    members = [_wider("$eq", column, family, member) for member in literal]
                    parts.append(None if any(member is None for member in members) else _any(members))
    known = [part for part in parts if part is not None]
    return _all(known) if known else None


def _wider(op: str, column: Column, family: str, literal) -> Column | None:
    """A test that admits at least what the exact one does; none for a literal of another family.

    A double has room for whole numbers up to 2**53 only. Beyond, values and literals are rounded in the same direction,
    so what was unequal may be equal, but never the other way round.
    """
    if _family(literal) != family:
        return None
    if family != "number":
        return COMPARE[op](column, F.lit(literal))
    return COMPARE[{"$gt": "$gte", "$lt": "$lte"}.get(op, op)](column, F.lit(float(literal)))


# --- documents --------------------------------------------------------------------------------


def where_document(where, document: Column, mode: str = "terms", terms: Column | None = None) -> Column:
    """Text filter. ``$contains`` matches any of its terms, or in mode ``substring`` the literal text.

    The text is cut into terms once per row; pass ``terms`` where they are known already.
    """
    if mode not in ("terms", "substring"):
        raise ValueError(f"unknown match mode {mode!r}")
    if isinstance(where, str):
        where = {"$contains": where}
    if terms is None and mode == "terms" and contained_terms(where):
        return F.exists(F.array(tokens(document)), lambda t: where_document(where, document, mode, t))
    if where is not None and not isinstance(where, Mapping):
        raise ValueError(f"a document filter is a dictionary or a string, not {where!r}")
    parts: list[Column] = []
    for key, spec in (where or {}).items():
        if key == "$contains" and mode == "substring":
            parts.append(document.contains(F.lit(spec)))
        elif key == "$contains":
            hits = [F.array_contains(terms, term) for term in distinct_terms(spec)]
            parts.append(_any(hits) if hits else document.isNull() & F.lit(None))
        elif key == "$regex":
            parts.append(document.rlike(spec))
        elif key in ("$and", "$or"):
            inner = [where_document(sub, document, mode, terms) for sub in _operands(spec, key)]
            parts.append(_all(inner) if key == "$and" else _any(inner))
        else:
            raise ValueError(f"unknown document operator {key!r}")
    return _all(parts)


def contained_terms(where) -> list[str]:
    """All terms that the ``$contains`` operands of a text filter mention, in order, once each."""
    if isinstance(where, str):
        where = {"$contains": where}
    found: list[str] = []
    for key, spec in where.items() if isinstance(where, Mapping) else ():
        if key == "$contains":
            found.extend(distinct_terms(spec))
        elif key in ("$and", "$or"):
            for sub in _parts(spec, key):
                found.extend(contained_terms(sub))
    return list(dict.fromkeys(found))


def only_contains(where) -> bool:
    """Whether terms alone decide a text filter."""
    if isinstance(where, str):
        return True
    return all(
        key == "$contains" or (key in ("$and", "$or") and all(only_contains(sub) for sub in _parts(spec, key)))
        for key, spec in where.items()
    )


# --- together ---------------------------------------------------------------------------------


def selection(
    where=None,
    where_doc=None,
    ids=None,
    *,
    metadata: str = "metadata",
    variant: str | None = None,
    document: str = "document",
    mode: str = "terms",
    typed: Mapping[str, tuple[Column, str]] | None = None,
) -> Column:
    """ids AND metadata AND text as one Column; TRUE when nothing is asked."""
    parts: list[Column] = []
    if ids is not None:
        parts.append(F.col("_id").isin([ids] if isinstance(ids, str) else [str(i) for i in ids]))
    if where:
        hint = pushdown(where, typed) if typed else None
        if hint is not None:
            parts.append(hint)
        parts.append(where_variant(where, F.col(variant)) if variant else where_json(where, F.col(metadata)))
    if where_doc:
        parts.append(where_document(where_doc, F.col(document), mode))
    return _all(parts)
