"""Fit any source frame to the sink's columns and types, or fail the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import SHIPMENT_SPECS, ColumnSpec

_CONVERTIBLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def align(df: DataFrame, problem: str | None = None) -> DataFrame:
    """Select the shipment columns by name, converted to their exact types.

    Extra source columns are left out. A missing column takes its default or is an error.
    Conversions that would lose digits, time of day or characters, and nulls in required
    columns, raise while the rows are written, in the same pass, because Parquet tables do not
    enforce NOT NULL. Filter on dates *before* aligning: the checks hide the column from the scan.

    With ``problem`` nothing raises: a column of that name, after the others, says what is wrong with
    a row, null for a good one.
    """
    available = {field.name: field.dataType for field in df.schema}
    values, found = [], []
    for spec in SHIPMENT_SPECS:
        value, checks = _fit(spec, available)
        texts = [(failed, F.lit(f"{spec.name} {fault}")) for failed, fault in checks]
        found += [F.when(failed, text) for failed, text in texts]
        if problem is None:
            for failed, text in reversed(texts):
                value = F.when(failed, F.raise_error(text)).otherwise(value)
        values.append(value.alias(spec.name))
    if problem is not None:
        values.append(F.coalesce(*found, F.lit(None).cast("string")).alias(problem))
    return df.select(*values)


def _fit(spec: ColumnSpec, available: dict[str, T.DataType]) -> tuple[Column, list[tuple[Column, str]]]:
    """The converted value, and the checks it has to pass with what failing them means."""
    if spec.name not in available:
        if spec.default is not None:
            return F.lit(spec.default).cast(spec.data_type), []
        if spec.nullable:
            return F.lit(None).cast(spec.data_type), []
        raise ValueError(f"source has no column {spec.name}")
    value = F.col(spec.name)
    source_type = available[spec.name]
    checks = []
    if source_type == spec.data_type:
        converted = value
    else:
        converted, lossless = _convert(spec, value, source_type)
        if lossless is not None:
            checks.append((value.isNotNull() & ~F.coalesce(lossless, F.lit(False)), "does not fit"))
    if spec.max_length:
        checks.append((F.char_length(converted) > spec.max_length, "is too long"))
    if not spec.nullable:
        checks.append((converted.isNull(), "is null"))
    return converted, checks


def _convert(
    spec: ColumnSpec, value: Column, source_type: T.DataType
) -> tuple[Column, Column | None]:
    """The converted value and a test that nothing was lost, if anything could be."""
    if not isinstance(source_type, _CONVERTIBLE):
        raise TypeError(f"cannot convert {spec.name} from {source_type.simpleString()}")
    if isinstance(spec.data_type, T.StringType):
        return value.cast("string"), None
    if isinstance(spec.data_type, T.DateType):
        if isinstance(source_type, T.NumericType):
            raise TypeError(f"cannot convert {spec.name} from {source_type.simpleString()}")
        common = "timestamp_ntz"
    elif isinstance(source_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"cannot convert {spec.name} from {source_type.simpleString()}")
    elif isinstance(source_type, (T.DoubleType, T.FloatType)):
        common = "double"
    else:
        common = "decimal(38,18)"
    converted = value.try_cast(spec.data_type)
    return converted, value.try_cast(common) == converted.try_cast(common)
