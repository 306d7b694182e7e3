"""Declarative description of one data product.

A spec holds names, paths, rules and gates, no data and no Spark objects, so it can be built
before a session exists and shipped or compared like any value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_
from typing import ClassVar, Protocol

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

from tidegate.functions.evidence import Shown
from tidegate.functions.rules import blank_or_literal, outside_range
from tidegate.functions.text import normalised, typed

# Columns the library adds itself.
PAYLOAD = "raw_payload"
REASON = "quarantine_reason"
STATUS = "dq_status"
WARNINGS = "dq_warnings"
LINEAGE = {"ingest_run_id": "string", "ingested_at_utc": "timestamp"}

MISSING_KEY = "MISSING_KEY"


class FailingRule(Protocol):
    """What makes a rule: a code, a predicate, and whether the predicate can be NULL."""

    code: str
    never_null: ClassVar[bool]

    def fails(self) -> Column: ...


@dataclass(frozen=True)
class Rule:
    """A rule given by any predicate; ``predicate`` is called once a session exists."""

    code: str
    predicate: Callable[[], Column]
    never_null: ClassVar[bool] = False

    def fails(self) -> Column:
        return self.predicate()


@dataclass(frozen=True)
class OutsideRange:
    """Fails when any of the columns is NULL, NaN or outside its inclusive bounds."""

    code: str
    bounds: tuple[tuple[str, float, float], ...]
    never_null: ClassVar[bool] = True

    def fails(self) -> Column:
        return reduce(or_, (outside_range(F.col(c), low, high) for c, low, high in self.bounds))


@dataclass(frozen=True)
class BlankOrLiteral:
    """Fails when the text is NULL, blank or one of the placeholder literals."""

    code: str
    column: str
    literals: tuple[str, ...] = ("UNKNOWN",)
    never_null: ClassVar[bool] = True

    def fails(self) -> Column:
        return blank_or_literal(F.col(self.column), self.literals)


@dataclass(frozen=True)
class Field:
    """A published column and where its value sits inside a page record."""

    name: str
    path: str
    type: str = "string"
    normalise: tuple[str, ...] = ("trim",)


@dataclass(frozen=True)
class OrderBy:
    """One term of the latest-wins order; the position of NULLs is always spelled out."""

    column: str
    descending: bool = False
    nulls_last: bool = False

    def expression(self) -> Column:
        column = F.col(self.column)
        if self.descending:
            return column.desc_nulls_last() if self.nulls_last else column.desc_nulls_first()
        return column.asc_nulls_last() if self.nulls_last else column.asc_nulls_first()


@dataclass(frozen=True)
class ProductSpec:
    """Everything that differs between one data product and another.

    ``contract`` lists the published columns with their types, in order. ``group`` is the column
    the gates count by: every value in ``required_groups`` must have rows, the other
    ``expected_groups`` may be empty but are always reported. ``null_key`` says what happens to
    records without a business key: ``"collapse"`` keeps the latest one of them, as for any other
    key value; ``"quarantine"`` treats a missing key as a failed hard rule.

    The payload is the whole record. ``redact`` leaves out paths, ``forbidden_columns`` names at any
    depth, both in any case; ``payload_paths``, when given, limit the payload to them and the fields.
    """

    fields: tuple[Field, ...]
    key: tuple[str, ...]
    order: tuple[OrderBy, ...]
    contract: tuple[tuple[str, str], ...]
    hard_rules: tuple[FailingRule, ...] = ()
    soft_rules: tuple[FailingRule, ...] = ()
    scope: tuple[str, tuple[str, ...]] | None = None
    group: str | None = None
    expected_groups: tuple[str, ...] = ()
    required_groups: tuple[str, ...] = ()
    null_key: str = "collapse"
    payload_paths: tuple[str, ...] = ()
    redact: tuple[str, ...] = ()
    forbidden_columns: tuple[str, ...] = ()
    records_field: str = "features"
    more_flag: str = "exceededTransferLimit"
    lineage: dict[str, str] = field(default_factory=lambda: dict(LINEAGE))

    def __post_init__(self) -> None:
        if self.null_key not in ("collapse", "quarantine"):
            raise ValueError(f"null_key must be 'collapse' or 'quarantine', not {self.null_key!r}")
        if not self.key or not self.order:
            raise ValueError("a product needs a business key and a latest-wins order")
        known = {*self.field_columns, STATUS, WARNINGS, *self.lineage}
        ordered = (term.column for term in self.order)
        used = {*self.key, *ordered, *self.contract_columns} | {self.group, self._scoped} - {None}
        if unknown := used - known:
            raise ValueError(f"not a field of the product: {sorted(unknown)}")
        codes = [rule.code for rule in (*self.hard_rules, *self.soft_rules)]
        if len(codes) != len(set(codes)):
            raise ValueError(f"rule codes must differ: {codes}")
        if not set(self.required_groups) <= set(self.expected_groups):
            raise ValueError("every required group must be an expected group")
        if self.expected_groups and not self.group:
            raise ValueError("expected_groups need a group column")
        if len({group.lower() for group in self.expected_groups}) < len(self.expected_groups):
            raise ValueError("expected groups must differ by more than case")
        paths = sorted([*(f.path for f in self.fields), *self.payload_paths])
        if any(longer.startswith(f"{path}.") for path in paths for longer in paths):
            raise ValueError("a field path cannot be the beginning of another")
        redacted = {path.lower() for path in self.redact}
        shown = [path for path in self.payload_paths if path.lower() not in redacted]
        read = [part for path in (*shown, *(f.path for f in self.fields)) for part in path.split(".")]
        if leaked := self.forbidden_among(read):
            raise ValueError(f"forbidden columns in the fields or the payload: {leaked}")
        if exposed := self.forbidden_among(self.contract_columns):
            raise ValueError(f"forbidden columns in the contract: {exposed}")

    def forbidden_among(self, names: Iterable[str]) -> list[str]:
        """The forbidden ones of some column names, compared without regard to case."""
        forbidden = {name.lower() for name in self.forbidden_columns}
        return sorted(name for name in names if name.lower() in forbidden)

    def shown(self) -> Shown:
        """What of a record the payload may hold."""
        only = (*(f.path for f in self.fields), *self.payload_paths) if self.payload_paths else None
        return Shown.of(self.forbidden_columns, self.redact, only)

    def with_changes(self, **changes) -> ProductSpec:
        return replace(self, **changes)

    @property
    def _scoped(self) -> str | None:
        return self.scope[0] if self.scope else None

    @property
    def contract_columns(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.contract)

    @property
    def field_columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def silver_columns(self) -> tuple[str, ...]:
        """Contract columns plus the technical fields the contract leaves out, lineage last."""
        technical = [c for c in self.field_columns if c not in self.contract_columns]
        head = [c for c in self.contract_columns if c not in self.lineage]
        tail = [c for c in self.contract_columns if c in self.lineage]
        return (*head, *technical, *tail)

    @property
    def quarantine_columns(self) -> tuple[str, ...]:
        return (*self.field_columns, REASON, *self.lineage, PAYLOAD)

    @property
    def all_hard_rules(self) -> tuple[FailingRule, ...]:
        if self.null_key == "collapse":
            return self.hard_rules
        missing = Rule(
            MISSING_KEY, lambda: reduce(or_, (F.col(name).isNull() for name in self.key))
        )
        return (*self.hard_rules, missing)

    def scope_predicate(self) -> Column:
        """Scope membership as a filter that a scan can take over; NULL for a NULL value."""
        if self.scope is None:
            return F.lit(True)
        column, values = self.scope
        return F.col(column).isin(*values)

    def in_scope(self) -> Column:
        """Scope membership that is never NULL: a NULL value is out of scope."""
        return F.coalesce(self.scope_predicate(), F.lit(False))

    def where_clause(self) -> str | None:
        """The scope in terms of the source's own field, for whoever fetches the pages to push to
        the source. The field's normalisers are part of it, so a source that applies it loses no
        row of the scope; the pipeline applies the scope again in any case."""
        if self.scope is None:
            return None
        column, values = self.scope
        scoped = next(f for f in self.fields if f.name == column)
        source = scoped.path.rsplit(".", 1)[-1]
        for step in scoped.normalise:
            source = f"{step.upper()}({source})"
        quoted = ("'" + value.replace("'", "''") + "'" for value in values)
        return f"{source} IN ({','.join(quoted)})"

    @property
    def scope_path(self) -> str | None:
        """Where the scoped field sits in a record."""
        return next((f.path for f in self.fields if f.name == self._scoped), None)

    def text_in_scope(self, text: Column) -> Column:
        """Whether the scoped field's text, as it is in a record, is in scope; never NULL."""
        scoped = next(f for f in self.fields if f.name == self._scoped)
        column = normalised(text, scoped.normalise) if scoped.type == "string" else typed(text, scoped.type)
        return F.coalesce(column.isin(*self.scope[1]), F.lit(False))

    def record_schema(self) -> T.StructType:
        """Schema of the fields of one page record, with every leaf read as text.

        Text leaves never depend on what other records of the run look like; typing happens
        afterwards with ``try_cast``.
        """
        tree: dict = {}
        for path in (f.path for f in self.fields):
            node = tree
            *parents, leaf = path.split(".")
            for parent in parents:
                node = node.setdefault(parent, {})
            node.setdefault(leaf, None)
        return _struct(tree)


def _struct(tree: dict) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, T.StringType() if child is None else _struct(child))
            for name, child in tree.items()
        ]
    )
