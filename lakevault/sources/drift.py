"""Schema drift with types: which type holds the values of two, and where others go.

Types are ordered by what they can hold without loss. The join of two types is the least type that
holds both; unrelated types have none. A column that is delivered with an unrelated type keeps its own
type, and the delivered values go to a variant column next to it, named after their type
(``price__v_string``). Deliveries are brought into the table's shape by ``aligned``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_MOST = 38


def _decimal(a: T.DataType) -> T.DecimalType | None:
    if isinstance(a, T.DecimalType):
        return a
    return T.DecimalType(_DIGITS[a], 0) if a in _DIGITS else None


def join(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both without loss; None where there is none."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE[max(_WHOLE.index(a), _WHOLE.index(b))]
    one, two = _decimal(a), _decimal(b)
    if one and two:
        scale = max(one.scale, two.scale)
        digits = max(one.precision - one.scale, two.precision - two.scale) + scale
        return T.DecimalType(digits, scale) if digits <= _MOST else None
    pair = {a, b}
    if pair == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    if T.DoubleType() in pair and pair & set(_WHOLE[:3]) or T.FloatType() in pair and pair & set(_WHOLE[:2]):
        return T.DoubleType() if T.DoubleType() in pair else T.FloatType()
    if T.FloatType() in pair and T.IntegerType() in pair:
        return T.DoubleType()
    if pair == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = join(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = []
        for field in a:
            other = next((f for f in b if f.name == field.name), None)
            kind = field.dataType if other is None else join(field.dataType, other.dataType)
            if kind is None:
                return None
            fields.append(T.StructField(field.name, kind))
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b if f.name not in a.names])
    return None


def widest(names: list[str]) -> str | None:
    """The join of types given by name; None where they are unrelated."""
    found = T.DataType.fromDDL(names[0])
    for name in names[1:]:
        found = found and join(found, T.DataType.fromDDL(name))
    return found.simpleString() if found else None


def variant(column: str, kind: T.DataType) -> str:
    """The column that holds values of an unrelated type."""
    return f"{column}__v_{kind.typeName()}"


def merged(table: T.StructType, delivery: T.StructType) -> tuple[T.StructType, dict[str, str]]:
    """The table's shape after a delivery, and the table column that each delivered column goes to."""
    kinds = {f.name: f.dataType for f in table}
    goes = {}
    for field in delivery:
        target = field.name
        if target in kinds and join(kinds[target], field.dataType) is None:
            target = variant(field.name, field.dataType)
        held = kinds.get(target)
        wide = field.dataType if held is None else join(held, field.dataType)
        if wide is None:
            raise ValueError(f"{field.name}: {field.dataType.simpleString()} fits neither {kinds[field.name].simpleString()} nor {held.simpleString()}")
        if target in goes.values():
            raise ValueError(f"two delivered columns go to {target}")
        kinds[target] = wide
        goes[field.name] = target
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()]), goes


def same_shape(a: T.StructType, b: T.StructType) -> bool:
    """Names and types alike, whatever may be null."""
    return [(f.name, f.dataType.simpleString()) for f in a] == [(f.name, f.dataType.simpleString()) for f in b]


def widened(value: str, held: T.DataType, wide: T.DataType, depth: int = 0) -> str:
    """SQL for a value of a narrower type as one of a wider; struct fields that it lacks are NULL."""
    if held.simpleString() == wide.simpleString():
        return value
    if isinstance(wide, T.StructType) and isinstance(held, T.StructType):
        known = {f.name: f.dataType for f in held}
        parts = [f"'{f.name}', " + (widened(f"{value}.`{f.name}`", known[f.name], f.dataType, depth) if f.name in known else _null(f.dataType)) for f in wide]
        return f"IF({value} IS NULL, NULL, named_struct({', '.join(parts)}))"
    if isinstance(wide, T.ArrayType) and isinstance(held, T.ArrayType):
        return f"transform({value}, _e{depth} -> {widened(f'_e{depth}', held.elementType, wide.elementType, depth + 1)})"
    return f"CAST({value} AS {wide.simpleString()})"


def _null(kind: T.DataType) -> str:
    return f"CAST(NULL AS {kind.simpleString()})"


def select_list(held: T.StructType, shape: T.StructType, goes: dict[str, str] | None = None) -> list[str]:
    """SQL for rows of one schema in the shape of another: columns they lack are NULL, narrower ones are cast."""
    kinds = {f.name: f.dataType for f in held}
    source = {target: name for name, target in (goes or {c: c for c in kinds}).items()}
    return [
        (widened(f"`{source[f.name]}`", kinds[source[f.name]], f.dataType) if f.name in source else _null(f.dataType)) + f" AS `{f.name}`"
        for f in shape
    ]


def aligned(df: DataFrame, shape: T.StructType, goes: dict[str, str] | None = None) -> DataFrame:
    """``df`` in a table's shape."""
    return df.selectExpr(*select_list(df.schema, shape, goes))
