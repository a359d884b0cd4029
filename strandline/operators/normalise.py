"""Rows of a source under a declared contract: projection, typed nulls, casts, rejection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.numeric import bad_double, bad_long, to_double, to_long
from ..plans.contracts import Field, SourceSchemaError
from .setops import examples


def typed(df: DataFrame, field: Field) -> tuple[Column, Column]:
    """(value, whether it breaks the contract) of a declared field that is there."""
    column, text = F.col(f"`{field.name}`"), isinstance(df.schema[field.name].dataType, StringType)
    as_text = column if text else column.cast("string")
    if field.kind == "double":
        return (to_double(as_text), bad_double(as_text)) if text else (column.cast("double"), F.lit(False))
    if field.kind == "bigint":
        return to_long(as_text), bad_long(as_text)
    return as_text, F.lit(False)


def normalise(df: DataFrame, fields: Iterable[Field], allowed_missing: frozenset[str] = frozenset(), dataset: str = "dataset") -> DataFrame:
    """Declared columns in declared order; others go; permitted missing ones are typed nulls.

    Raises SourceSchemaError for other missing columns (unless there are no rows at all) and, with up
    to five examples, for values that do not fit. All columns are checked in one pass.
    """
    fields = list(fields)
    missing = [f.name for f in fields if f.name not in df.columns]
    wrong = [name for name in missing if name not in allowed_missing]
    if wrong and not df.isEmpty():
        raise SourceSchemaError(f"{dataset}: missing columns {', '.join(wrong)}")
    values, checks = [], {}
    for f in fields:
        if f.name in missing:
            values.append(F.lit(None).cast(f.kind).alias(f.name))
        else:
            value, bad = typed(df, f)
            values.append(value.alias(f.name))
            checks[f.name] = bad
    numeric = {n: c for n, c in checks.items() if next(f for f in fields if f.name == n).kind != "string"}
    if numeric:
        counts = df.agg(*[F.count_if(c).alias(n) for n, c in numeric.items()]).first().asDict()
        for name, n in counts.items():
            if n:
                seen = [r[0] for r in examples(df.where(numeric[name]).select(F.col(f"`{name}`")))]
                raise SourceSchemaError(f"{dataset}: {n} values of {name} do not fit its type, such as {seen}")
    return df.select(*values)
