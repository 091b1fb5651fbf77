"""JSON members as VARIANT, so that a missing key and a JSON null stay apart."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_of(*keys: str | int) -> str:
    steps = (f"[{k}]" if isinstance(k, int) else f"['{k}']" for k in keys)
    return "$" + "".join(steps)


def member(obj: Column, *keys: str | int) -> Column:
    """A member as VARIANT: NULL where the key is missing, a variant null for JSON null."""
    return F.try_variant_get(obj, path_of(*keys), "variant")


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_text(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def is_object(v: Column) -> Column:
    """Tested by a cast that fails on anything else; ``kind`` would describe the whole object."""
    return F.try_variant_get(v, "$", "struct<_: variant>").isNotNull()


def is_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def json_field(c: Column, *keys: str | int) -> Column:
    """Member of a JSON text as string, NULL where it is missing, null or the text is not JSON."""
    return F.try_variant_get(F.try_parse_json(c), path_of(*keys), "string")


def json_default(c: Column, *keys: str | int, default: str = "") -> Column:
    return F.coalesce(json_field(c, *keys), F.lit(default))


class Field(NamedTuple):
    """A value and the reason it cannot be used (NULL where it can)."""

    value: Column
    problem: Column


def no_problem() -> Column:
    return F.lit(None).cast("string")


def text_field(obj: Column, *keys: str, required: bool = False, name: str | None = None) -> Field:
    """A member that must be text. Missing gives ``''`` unless required; JSON null is a problem."""
    name = name or str(keys[-1])
    v = member(obj, *keys)
    # The kind of a missing member is NULL, which is no problem here.
    problem = F.when(kind(v) != "STRING", F.lit(f"{name} is not text"))
    if required:
        problem = F.when(v.isNull(), F.lit(f"{name} is missing")).otherwise(problem)
    value = F.coalesce(F.try_variant_get(obj, path_of(*keys), "string"), F.lit(""))
    return Field(value, problem)


def id_field(obj: Column, *keys: str) -> Field:
    """A member used as an id: any scalar, but the key must be there."""
    name = str(keys[-1])
    v = member(obj, *keys)
    problem = F.when(v.isNull(), F.lit(f"{name} is missing")).when(
        is_object(v) | is_list(v), F.lit(f"{name} is not a single value")
    )
    return Field(F.try_variant_get(obj, path_of(*keys), "string"), problem)


def date_field(text: Field, parse, name: str) -> tuple[Column, Column]:
    """``(date, problem)`` of a text field: empty is no date, unreadable is a problem."""
    day = parse(text.value)
    problem = F.coalesce(
        text.problem,
        F.when((F.length(text.value) > 0) & day.isNull(), F.lit(f"{name} is not a date")),
    )
    return day, problem


def printed(v: Column) -> Column:
    """A VARIANT as the text written to CSV: null is empty, truth values are capitalised."""
    text = F.try_variant_get(v, "$", "string")
    return F.coalesce(F.when(kind(v) == "BOOLEAN", F.initcap(text)).otherwise(text), F.lit(""))
