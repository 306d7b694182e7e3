"""What of a record may be shown: names and paths taken out of nested values at any depth.

Typed columns are rewritten along their schema: fields of structs are left out, arrays and maps are
rewritten element by element. Variants, and the keys of maps, have no schema; their entries are
judged by name as they come. Names are compared without regard to case, which hides what Spark
would resolve to a hidden column under either setting, and a path through an array names all its
elements.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Levels of nesting of a variant that are taken apart. What lies deeper is shown as it is where no
#: hidden name occurs in it, and left out otherwise.
DEPTH = 8

Path = str | Column


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


@dataclass(frozen=True)
class Shown:
    """``names`` are hidden wherever they occur, ``paths`` only where they are; ``only``, when given,
    are the paths that may be shown at all, with what is below them."""

    names: frozenset[str] = frozenset()
    paths: frozenset[str] = frozenset()
    only: frozenset[str] | None = None

    @staticmethod
    def of(names: Iterable[str] = (), paths: Iterable[str] = (), only: Iterable[str] | None = None) -> Shown:
        lower = [frozenset(item.lower() for item in items or ()) for items in (names, paths, only)]
        return Shown(lower[0], lower[1], None if only is None else lower[2])

    @property
    def everything(self) -> bool:
        return not self.names and not self.paths and self.only is None

    def _hides_name(self, name: str, path: str) -> bool:
        if name in self.names or path in self.paths:
            return True
        return self.only is not None and not any(
            path == kept or path.startswith(f"{kept}.") or kept.startswith(f"{path}.") for kept in self.only
        )

    def _hides(self, name: Path, path: Path) -> bool | Column:
        if isinstance(path, str):
            return self._hides_name(name, path)
        if isinstance(name, str) and (name in self.names or not self.paths and self.only is None):
            return name in self.names
        hidden = [path.isin(*self.paths)] if self.paths else []
        if self.names and isinstance(name, Column):
            hidden.append(name.isin(*self.names))
        if self.only is not None:
            above = {kept[:at] for kept in self.only for at, c in enumerate(kept) if c == "."}
            shown = path.isin(*self.only, *above)
            shown = reduce(or_, (path.startswith(f"{kept}.") for kept in self.only), shown)
            hidden.append(~shown)
        return reduce(or_, hidden, F.lit(False))

    def typed(self, value: Column, data_type: T.DataType, path: Path = "") -> Column:
        """``value`` without what is hidden; the same column where nothing can be."""
        if isinstance(data_type, T.StructType):
            kept, same = [], True
            for field in data_type.fields:
                name = field.name.lower()
                below = _below(path, name)
                hides = self._hides(name, below)
                if hides is True:
                    same = False
                    continue
                inner = value[field.name]
                shown = self.typed(inner, field.dataType, below)
                if isinstance(hides, Column):  # a field of a map's value: its path is in the data
                    shown = F.when(~hides, shown)
                same = same and shown is inner
                kept.append(shown.alias(field.name))
            if same:
                return value
            return F.when(value.isNotNull(), F.struct(*kept) if kept else F.lit(None).cast("string"))
        if isinstance(data_type, T.ArrayType) and self._reaches(data_type.elementType):
            return F.transform(value, lambda item: self.typed(item, data_type.elementType, path))
        if isinstance(data_type, T.MapType) and self._reaches(data_type):
            named = isinstance(data_type.keyType, T.StringType)
            below = lambda key: _below(_column(path), F.lower(key)) if named else path
            kept = F.map_filter(value, lambda k, _: ~self._hides(F.lower(k), below(k))) if named else value
            return F.transform_values(kept, lambda k, v: self.typed(v, data_type.valueType, below(k)))
        if isinstance(data_type, T.VariantType):
            return self.variant(value, path)
        return value

    def _reaches(self, data_type: T.DataType) -> bool:
        """Whether a value of the type has names in it."""
        if isinstance(data_type, T.ArrayType):
            return self._reaches(data_type.elementType)
        if isinstance(data_type, T.MapType):
            return isinstance(data_type.keyType, T.StringType) or self._reaches(data_type.valueType)
        return isinstance(data_type, (T.StructType, T.VariantType))

    def variant(self, value: Column, path: Path = "", depth: int = DEPTH) -> Column:
        """The variant without what is hidden, taken apart and put together again."""
        if self.everything:
            return value
        return self._variant(value, _column(path), depth)

    def _variant(self, value: Column, path: Column, depth: int) -> Column:
        if not depth:
            return F.when(~self._mentions(value), value)

        def shown(entry: Column) -> Column:
            below = F.when(entry["key"].isNull(), path).otherwise(_below(path, F.lower(entry["key"])))
            inner = _let(below, lambda at: self._variant(entry["value"], at, depth - 1))
            return F.struct(entry["key"].alias("key"), inner.alias("value"))

        def put_together(parts: Column) -> Column:
            named = F.filter(
                F.map_entries(parts["fields"]),
                lambda e: ~self._hides(F.lower(e["key"]), _below(path, F.lower(e["key"]))),
            )
            listed = F.transform(
                parts["items"],
                lambda item: F.struct(F.lit(None).cast("string").alias("key"), item.alias("value")),
            )
            return _let(
                F.transform(F.coalesce(named, listed), shown),
                lambda made: F.when(
                    parts["fields"].isNotNull(), F.to_variant_object(F.map_from_entries(made))
                )
                .when(
                    parts["items"].isNotNull(),
                    F.to_variant_object(F.transform(made, lambda e: e["value"])),
                )
                .otherwise(value),
            )

        parts = F.struct(
            F.try_variant_get(value, "$", "map<string,variant>").alias("fields"),
            F.try_variant_get(value, "$", "array<variant>").alias("items"),
        )
        return _let(parts, put_together)

    def _mentions(self, value: Column) -> Column:
        """Whether a hidden name occurs anywhere in the value's JSON; all of it where paths count."""
        if self.paths or self.only is not None:
            is_plain = [F.try_variant_get(value, "$", kind).isNull() for kind in ("map<string,variant>", "array<variant>")]
            return ~reduce(and_, is_plain)
        text = F.lower(F.to_json(value))
        names = [F.contains(text, F.lit(json.dumps(name, ensure_ascii=False))) for name in sorted(self.names)]
        return F.coalesce(reduce(or_, names, F.lit(False)), F.lit(False))


def _column(path: Path) -> Column:
    return F.lit(path) if isinstance(path, str) else path


def _below(path: Path, name: Path) -> Path:
    if isinstance(path, str) and isinstance(name, str):
        return f"{path}.{name}" if path else name
    start, end = _column(path), _column(name)
    return F.when(start == "", end).otherwise(F.concat(start, F.lit("."), end))
