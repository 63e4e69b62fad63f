"""Row filters as Column objects."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column]) -> Column:
    """AND of all conditions; no condition means true."""
    return functools.reduce(operator.and_, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of all conditions; no condition means false."""
    return functools.reduce(operator.or_, conditions, F.lit(False))


def like_any(column: Column, patterns: Sequence[str]) -> Column:
    r"""LIKE with any of the patterns; ``\_`` and ``\%`` stand for the plain characters."""
    return any_of(column.like(p) for p in patterns)


def not_like_any(column: Column, patterns: Sequence[str]) -> Column:
    """Negation of :func:`like_any`; NULL text passes neither."""
    return ~like_any(column, patterns)


def not_in(column: Column, values: Sequence) -> Column:
    """NOT IN; NULL does not pass."""
    return ~column.isin(list(values))


def bad_user_id(user_id: Column, min_length: int = 10) -> Column:
    """True for NULL, blank or too short ids."""
    return user_id.isNull() | user_id.isin("", " ") | (F.length(user_id) < min_length)


def field_in_list(
    column: Column, values: Sequence[str], null_in_list: bool = False, negate: bool = False
) -> Column:
    """True for rows to drop: the text equals a listed value, trimmed and without case.

    ``negate`` turns the deny list into an allow list. A NULL field counts as
    listed only with ``null_in_list``.
    """
    wanted = sorted({v.strip().lower() for v in values if v.strip()})
    listed = F.coalesce(F.lower(F.trim(column)).isin(wanted), F.lit(null_in_list))
    return ~listed if negate else listed


def filter_field_in_list(
    df: DataFrame, name: str, values: Sequence[str], null_in_list: bool = False, negate: bool = False
) -> DataFrame:
    """Rows that survive :func:`field_in_list`.

    The field name is case-sensitive; an absent field counts as NULL and a
    field that is no text is an error.
    """
    found = {f.name: f.dataType.typeName() for f in df.schema.fields}
    if name in found and found[name] not in ("string", "void"):
        raise TypeError(f"field {name} must be text, found {found[name]}")
    column = F.col(name) if name in found else F.lit(None).cast("string")
    return df.where(~field_in_list(column, values, null_in_list, negate))


@dataclass(frozen=True)
class Segment:
    """A named rule on events."""

    name: str
    predicate: Column


WITH_TEST = "_WITH_TEST"


def with_test_variants(rules: Sequence[Segment], is_test_user: Column) -> list[Segment]:
    """Each rule twice: under its own name without test users, and with them."""
    variants = []
    for rule in rules:
        variants.append(Segment(rule.name, all_of([rule.predicate, ~is_test_user])))
        variants.append(Segment(rule.name + WITH_TEST, rule.predicate))
    return variants
