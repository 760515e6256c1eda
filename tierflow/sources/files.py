"""File sources, batch and streaming."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.flatten import flatten_by_spec

# The format name and option prefix of incremental directory ingest in metadata files.
INCREMENTAL = "cloudFiles"
FILE_FORMATS = ("csv", "json", "parquet", "orc", "text")
INGESTION_COLUMN = "ingestion_timestamp"

# Keys of the file-metadata section of a source.
METADATA_ON = "include_autoloader_metadata_column"
METADATA_NAME = "autoloader_metadata_col_name"
METADATA_COLUMNS = "select_metadata_cols"
METADATA_DEFAULT_NAME = "source_metadata"


@dataclass(frozen=True)
class FileSource:
    """A directory of files; ``metadata`` is the optional file-metadata section."""

    path: str
    format: str
    options: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    metadata: dict | None = None
    ingestion_time: bool = False
    flatten_flag: str | None = None
    flatten_column: str | list[str] | None = None

    @property
    def _prefixed(self) -> dict[str, str]:
        start = f"{INCREMENTAL}."
        return {k[len(start):]: v for k, v in self.options.items() if k.startswith(start)}

    @property
    def file_format(self) -> str:
        return self._prefixed.get("format", "json") if self.format == INCREMENTAL else self.format

    @property
    def rescue_column(self) -> str | None:
        return self._prefixed.get("rescuedDataColumn") or self.options.get("rescuedDataColumn")

    def reader_options(self) -> dict[str, str]:
        """Options Spark's own reader understands."""
        known = {"maxFilesPerTrigger": "maxFilesPerTrigger", "maxBytesPerTrigger": "maxBytesPerTrigger"}
        plain = {
            k: v for k, v in self.options.items() if not k.startswith(f"{INCREMENTAL}.") and k != "rescuedDataColumn"
        }
        return {**plain, **{known[k]: v for k, v in self._prefixed.items() if k in known}}


def infer_schema(spark: SparkSession, source: FileSource) -> T.StructType:
    """Schema of the files there are now; all text unless type inference is asked for."""
    options = source.reader_options()
    infer = source._prefixed.get("inferColumnTypes", "true" if source.format != INCREMENTAL else "false")
    if source.file_format == "csv":
        options.setdefault("inferSchema", infer)
    if source.file_format == "json" and infer == "false":
        options.setdefault("primitivesAsString", "true")
    return spark.read.format(source.file_format).options(**options).load(source.path).schema


def _load(spark: SparkSession, source: FileSource, streaming: bool) -> DataFrame:
    fmt = source.file_format
    if fmt not in FILE_FORMATS:
        raise ValueError(f"file format {fmt!r} is not supported")
    options = source.reader_options()
    if source.rescue_column and fmt == "json":
        return _load_rescued(spark, source, streaming)
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    schema = source.schema
    if schema is None and (streaming or source.format == INCREMENTAL or source.rescue_column):
        schema = infer_schema(spark, source)
    if source.rescue_column and fmt == "csv":
        # The reader keeps the raw line of a row that does not fit, if it parses the columns concerned.
        kept = [f for f in schema.fields if f.name != source.rescue_column]
        schema = T.StructType([*kept, T.StructField(source.rescue_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", source.rescue_column)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(source.path)
    if source.rescue_column and fmt == "csv":
        # Behind a generator every column is needed, whatever the query selects.
        return df.select("_metadata", F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    if source.rescue_column and source.rescue_column not in df.columns:
        df = df.withColumn(source.rescue_column, F.lit(None).cast("string"))
    return df


def _load_rescued(spark: SparkSession, source: FileSource, streaming: bool) -> DataFrame:
    """JSON lines with a rescue column: whatever of a line does not fit the schema, as JSON text."""
    column = source.rescue_column
    schema = source.schema if source.schema is not None else infer_schema(spark, source)
    schema = T.StructType([f for f in schema.fields if f.name != column])
    options = {k: v for k, v in source.reader_options().items() if k.endswith("PerTrigger")}
    lines = (spark.readStream if streaming else spark.read).format("text").options(**options).load(source.path)
    staged = lines.where(F.trim("value") != "").select("value", F.col("_metadata"))
    return rescue(staged, "value", schema, column, keep=["_metadata"])


def rescue(df: DataFrame, text: str, schema: T.StructType, column: str, keep: list[str] | None = None) -> DataFrame:
    """Parse JSON texts by ``schema``; ``column`` gets unknown fields and values of the wrong type.

    A text that is no JSON object is rescued whole.
    """
    raw = F.from_json(text, T.MapType(T.StringType(), T.VariantType()))
    staged = df.withColumns({"__raw": F.when(F.try_parse_json(text).isNotNull(), raw)})
    typed, misfit = [], []
    for f in schema.fields:
        held = F.try_element_at("__raw", F.lit(f.name))
        # Objects and arrays of the declared shape parse through from_json; scalars through the variant.
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            wrapped = T.StructType([T.StructField("x", f.dataType)])
            value = F.from_json(F.concat(F.lit('{"x":'), F.to_json(held), F.lit("}")), wrapped)["x"]
        else:
            value = F.try_variant_get(held, "$", f.dataType.simpleString())
        typed.append(value.alias(f.name))
        is_null = held.isNull() | F.is_variant_null(held)
        misfit.append(F.when(~is_null & value.isNull(), F.lit(f.name)))
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    lost = F.array_union(F.array_except(F.map_keys("__raw"), names), F.array_compact(F.array(*misfit)))
    left_over = F.map_filter("__raw", lambda k, _: F.array_contains(lost, k))
    rescued = F.when(F.col("__raw").isNull(), F.col(text)).when(F.size(lost) > 0, F.to_json(left_over))
    return staged.select(*typed, rescued.alias(column), *(keep or []))


def file_metadata_columns(df: DataFrame, section: dict) -> DataFrame:
    """Columns taken from the hidden ``_metadata`` struct, which itself is kept only on request."""
    if "_metadata" not in df.columns:
        df = df.select("*", "_metadata")
    picked = section.get(METADATA_COLUMNS) or {}
    df = df.withColumns({out: F.expr(source) for out, source in picked.items()}) if picked else df
    if str(section.get(METADATA_ON, "")).lower() == "true":
        return df.withColumnRenamed("_metadata", section.get(METADATA_NAME) or METADATA_DEFAULT_NAME)
    return df.drop("_metadata")


def read_files(spark: SparkSession, source: FileSource, streaming: bool = False) -> DataFrame:
    df = _load(spark, source, streaming)
    if source.metadata:
        df = file_metadata_columns(df, source.metadata)
    elif "_metadata" in df.columns:
        df = df.drop("_metadata")
    if source.ingestion_time:
        df = with_ingestion_time(df)
    return flatten_by_spec(df, source.flatten_flag, source.flatten_column)


def with_ingestion_time(df: DataFrame, name: str = INGESTION_COLUMN) -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def union_files(spark: SparkSession, sources: list[FileSource]) -> DataFrame:
    """Several file reads as one frame, matched by column name."""
    frames = [read_files(spark, s) for s in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
