"""Declared schemas of the two sources and of the registry table."""

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from corpreg.params import NUMERIC_COLUMNS, REGISTRY_COLUMNS, S1_COLUMNS, S2_COLUMNS


def _schema(columns: tuple[str, ...]) -> StructType:
    return StructType([StructField(c, DoubleType() if c in NUMERIC_COLUMNS else StringType(), True) for c in columns])


SUPPLY_CHAIN, FINANCIAL, REGISTRY = map(_schema, (S1_COLUMNS, S2_COLUMNS, REGISTRY_COLUMNS))

REGISTRY_DDL = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in REGISTRY.fields)
