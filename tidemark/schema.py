"""The shipment fact table: columns, value domains and table creation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: T.DataType
    nullable: bool = False
    max_length: int | None = None
    default: object = None

    @property
    def ddl(self) -> str:
        sql_type = f"VARCHAR({self.max_length})" if self.max_length else self.data_type.simpleString()
        text = f"{self.name} {sql_type}"
        if not self.nullable:
            text += " NOT NULL"
        if self.default is not None:
            literal = f"'{self.default}'" if isinstance(self.default, str) else str(self.default)
            text += f" DEFAULT {literal}"
        return text


# The fact table's columns, types, lengths and defaults.
SHIPMENT_SPECS = (
    ColumnSpec("shipment_id", T.LongType()),
    ColumnSpec("shipment_date", T.DateType()),
    ColumnSpec("record_version", T.IntegerType(), default=1),
    ColumnSpec("settlement_status", T.StringType(), max_length=20, default="Pending"),
    ColumnSpec("carrier_code", T.StringType(), max_length=10),
    ColumnSpec("origin_region", T.StringType(), max_length=20),
    ColumnSpec("destination_region", T.StringType(), max_length=20),
    ColumnSpec("estimated_cost", T.DecimalType(18, 2)),
    ColumnSpec("actual_cost", T.DecimalType(18, 2), nullable=True),
    ColumnSpec("weight_lbs", T.DecimalType(10, 2)),
    ColumnSpec("payload", T.StringType(), max_length=100),
)

# Regions in code order, and the number of carrier letters from 'A'.
REGIONS = ("North", "South", "East", "West", "Central")
CARRIER_COUNT = 5

PARTITION_COLUMN = "shipment_date"
KEY_COLUMN = "shipment_id"
SHIPMENT_COLUMNS = tuple(spec.name for spec in SHIPMENT_SPECS)
# Partition columns come last in a partitioned table.
STORED_COLUMNS = tuple(c for c in SHIPMENT_COLUMNS if c != PARTITION_COLUMN) + (PARTITION_COLUMN,)


def stored_schema() -> T.StructType:
    """Schema of the table's files, partition column last."""
    types = {spec.name: spec.data_type for spec in SHIPMENT_SPECS}
    return T.StructType([T.StructField(name, types[name], True) for name in STORED_COLUMNS])


def create_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the partitioned fact table unless it exists."""
    specs = {spec.name: spec for spec in SHIPMENT_SPECS}
    columns = ", ".join(specs[name].ddl for name in STORED_COLUMNS)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) "
        f"USING parquet PARTITIONED BY ({PARTITION_COLUMN}){where}"
    )


def drop_table(spark: SparkSession, table: str) -> bool:
    """Drop the table if it is there; tells whether it was."""
    existed = spark.catalog.tableExists(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return existed
