"""What a dataset looks like in each layer. Every operator takes a spec, none knows a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class LayerSpec:
    """Column contract of one dataset across the raw, clean and aggregated layers.

    columns: clean columns, in order
    numeric: those of them that hold doubles; all others hold strings
    partition_by: raw columns whose sanitised form names the directories
    group_by: raw columns the aggregate is keyed on
    count_name: name of the aggregate's count column
    """

    columns: tuple[str, ...]
    numeric: tuple[str, ...]
    partition_by: tuple[str, str]
    group_by: tuple[str, ...]
    count_name: str

    @property
    def strings(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c not in self.numeric)

    @property
    def clean_keys(self) -> tuple[str, ...]:
        """Directory columns. They differ in name from the raw columns, which stay in the files."""
        return tuple(f"{c}_clean" for c in self.partition_by)

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def silver_schema(self) -> T.StructType:
        fields = [
            T.StructField(c, T.DoubleType() if c in self.numeric else T.StringType())
            for c in self.columns
        ]
        return T.StructType(fields + [T.StructField(k, T.StringType()) for k in self.clean_keys])

    @property
    def gold_schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType()) for c in self.group_by]
        return T.StructType(fields + [T.StructField(self.count_name, T.LongType())])


# The column names, their order and their types are the data model.
LOCATIONS = LayerSpec(
    columns=(
        "id",
        "name",
        "brewery_type",
        "street",
        "city",
        "state",
        "postal_code",
        "country",
        "longitude",
        "latitude",
        "phone",
        "website_url",
    ),
    numeric=("longitude", "latitude"),
    partition_by=("state", "city"),
    group_by=("state", "city", "brewery_type"),
    count_name="brewery_count",
)
