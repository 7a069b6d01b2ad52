"""Table declarations that change the data: computed and metadata columns, watermarks, keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


@dataclass(frozen=True)
class Declaration:
    """``columns`` renames or selects (empty: all); ``computed`` holds SQL expressions over the
    columns; ``metadata`` maps new names to fields of Spark's file ``_metadata`` or of a topic row;
    ``watermark`` is (column, delay), where the column may be computed or a nested field. A NULL in a column of the
    ``primary_key`` fails the query; ``unique`` keys may hold NULLs. Duplicates are found by ``key_report``."""
    columns: tuple[str, ...] = ()
    computed: dict[str, str] = field(default_factory=dict)
    metadata: dict[str, str] = field(default_factory=dict)
    watermark: tuple[str, str] | None = None
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        base = list(self.columns) or df.columns
        clash = set(base) & (set(self.computed) | set(self.metadata))
        if clash:
            raise ValueError(f"declared twice: {sorted(clash)}")
        out = df.select(*base, *[F.col(src).alias(n) for n, src in self.metadata.items()])
        for name, text in self.computed.items():
            out = out.withColumn(name, F.expr(text))
        unknown = {c for key in (self.primary_key, *self.unique) for c in key} - set(out.columns)
        if unknown or len(set(self.primary_key)) < len(self.primary_key):
            raise ValueError(f"key columns must be declared once: {sorted(unknown) or self.primary_key}")
        for c in self.primary_key:
            refuse = F.raise_error(F.lit(f"primary key column {c} is NULL")).cast(out.schema[c].dataType)
            out = out.withColumn(c, F.coalesce(F.col(c), refuse))
        if self.watermark:
            column, delay = self.watermark
            name = column.replace(".", "_")
            out = out.withColumn(name, F.col(column).cast("timestamp")).withWatermark(name, delay)
        return out


def key_report(df: DataFrame, primary_key: list[str], unique: list[list[str]] = ()) -> DataFrame:
    """One row per declared key: rows with a null key (an error for a primary key), keys seen more
    than once, and the surplus rows. Counts combine before the shuffle, so a hot duplicate is cheap."""
    reports = None
    for kind, cols in [("primary", list(primary_key)), *[("unique", list(u)) for u in unique]]:
        missing = F.greatest(*[F.col(c).isNull().cast("int") for c in cols], F.lit(0)) == 1
        counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
        one = counts.agg(
            F.coalesce(F.sum(F.when(missing, F.col("__n"))), F.lit(0)).alias("null_rows"),
            F.count_if(~missing & (F.col("__n") > 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(~missing, F.col("__n") - 1)), F.lit(0)).alias("surplus_rows"))
        one = one.select(F.lit(kind).alias("kind"), F.lit(",".join(cols)).alias("key"), "*")
        reports = one if reports is None else reports.unionByName(one)
    return reports


def extended(spark: SparkSession, path: str, schema: StructType, extra: dict[str, str]) -> DataFrame:
    """Read parquet under a wider declared schema; columns the files lack are null."""
    added = [StructField(n, _parse_datatype_string(kind)) for n, kind in extra.items()]
    return spark.read.schema(StructType([*schema.fields, *added])).parquet(path)
