"""Choosing columns of wide tables whose headers vary between exports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import quoted


def resolve(
    present: DataFrame | Iterable[str],
    synonyms: Mapping[str, Sequence[str]],
    required: bool | Iterable[str] = False,
) -> dict[str, str]:
    """Map each logical name to the first of its spellings that exists.

    Spelling case is ignored and the physical name is returned as it is written in
    the table. Logical names without a match are left out. ``required=True`` asks for
    at least one match, a list of logical names asks for each of those; the
    ``ValueError`` comes before any Spark job.
    """
    names = present.columns if isinstance(present, DataFrame) else list(present)
    written = {name.lower(): name for name in names}
    found = {}
    for logical, spellings in synonyms.items():
        match = next((written[s.lower()] for s in spellings if s.lower() in written), None)
        if match is not None:
            found[logical] = match
    if required is True and not found:
        raise ValueError(f"none of {sorted(synonyms)} is present in {names[:40]}")
    if not isinstance(required, bool):
        missing = [name for name in required if name not in found]
        if missing:
            raise ValueError(f"no column for {missing} in {names[:40]}")
    return found


def select_resolved(
    df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Project to the ``keep`` columns that exist plus the resolved ones, logically named."""
    kept = [F.col(quoted(c)) for c in keep if c in df.columns]
    return df.select(*kept, *[F.col(quoted(p)).alias(name) for name, p in mapping.items()])


def select_present(df: DataFrame, wanted: Sequence[str], required: bool = False) -> DataFrame:
    """Project to the wanted columns that exist, in the wanted order."""
    have = [c for c in wanted if c in df.columns]
    if required and not have:
        raise ValueError(f"none of {list(wanted)} is present")
    return df.select(*[F.col(quoted(c)) for c in have])


def require(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ``ValueError`` before any job when a needed column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns[:40]}")


def flatten_struct(
    df: DataFrame, struct: str, names: Iterable[str], missing: str = "null"
) -> DataFrame:
    """Lift fields of a struct column to top-level columns.

    A hyphenated name also matches the field spelled with underscores. A name that
    the struct lacks becomes a null double, or no column with ``missing="omit"``
    (which lets ``resolve`` fall through to the next spelling).
    """
    if missing not in ("null", "omit"):
        raise ValueError(f"missing must be 'null' or 'omit', not {missing!r}")
    if struct not in df.columns:
        return df
    kind = df.schema[struct].dataType
    if not isinstance(kind, T.StructType):
        raise ValueError(f"{struct} is {kind.simpleString()}, not a struct")
    lifted = {}
    for name in names:
        field = next((n for n in (name, name.replace("-", "_")) if n in kind.names), None)
        if field is not None:
            lifted[name] = F.col(quoted(struct)).getField(field)
        elif missing == "null":
            lifted[name] = F.lit(None).cast("double")
    return df.withColumns(lifted) if lifted else df


def variant_fields(df: DataFrame, variant: str, fields: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and, per entry of ``fields``, the value at a path as a type: ``{name: (path, type)}``.

    A value that cannot be read as the type, a path that is not there and a null variant give null.
    Row by row and in one scan; rows may hold different types at the same path.
    """
    lifted = [F.try_variant_get(quoted(variant), path, kind).alias(name) for name, (path, kind) in fields.items()]
    return df.select(*[F.col(quoted(c)) for c in keep], *lifted)


def variant_schema(df: DataFrame, variant: str) -> DataFrame:
    """One row ``schema``: the type that fits all values, VARIANT where they differ; partial types merge in tasks."""
    return df.agg(F.schema_of_variant_agg(F.col(quoted(variant))).alias("schema"))
