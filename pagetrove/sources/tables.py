"""CSV forms of parsed documents and summaries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = {
    "loaded_docs": "array<struct<page_content: string, metadata: string>>",
    "cleaned_text": "array<string>",
}
# Quotes inside a field are doubled, the usual form; empty strings and nulls stay apart.
_OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""'}


def write_csv(df: DataFrame, path: str) -> None:
    """Write a table as CSV with a header. Nested columns become JSON text, in which line breaks are
    escaped, so that every record is one line and large files can be split on reading."""
    nested = {
        f.name: F.to_json(f.name) for f in df.schema
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
    }
    df.withColumns(nested).write.mode("overwrite").options(**_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back what ``write_csv`` wrote; columns of parsed documents get their arrays back."""
    df = spark.read.options(**_OPTIONS).schema(schema).csv(path)
    nested = {name: F.from_json(name, kind) for name, kind in _NESTED.items() if name in df.columns}
    return df.withColumns(nested)
