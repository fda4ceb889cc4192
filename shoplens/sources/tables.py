"""Declared schemas, CSV and Parquet scans, and sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.session import HandOver

# Column of a scan that holds a line which does not fit the header.
BROKEN = "_broken_line"

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def _schema(spec: str) -> T.StructType:
    fields = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SCHEMAS = {
    "action": _schema("user_id bigint, sku_id bigint, action_time timestamp, module_id bigint, type int"),
    "product": _schema("sku_id bigint, brand bigint, shop_id bigint, cate bigint"),
    "shop": _schema(
        "shop_id bigint, cate bigint, fans_num bigint, vip_num bigint, shop_reg_tm timestamp, shop_score double"
    ),
    "user": _schema(
        "user_id bigint, age int, sex int, user_reg_tm timestamp, user_lv_cd int, city_level int, "
        "province int, city int, county int"
    ),
    "comment": _schema("dt date, sku_id bigint, comments bigint, good_comments bigint, bad_comments bigint"),
}


@dataclass(frozen=True)
class Tables:
    """The five input tables; ``shops`` calls its category ``main_cate``."""

    actions: DataFrame
    products: DataFrame
    shops: DataFrame
    users: DataFrame
    comments: DataFrame


def read_csv(
    spark: SparkSession, path: str, table: str, columns: list[str] | None = None
) -> DataFrame:
    """Scan one CSV table with header.

    ``columns`` gives the header order of the file when it differs from the declared order. Cells
    that do not parse become NULL; :func:`unparsed_cells` counts them.
    """
    raw = _raw(spark, path, table, columns)
    return raw.select(*[_parse(f) for f in SCHEMAS[table].fields if f.name in raw.columns])


def _raw(spark: SparkSession, path: str, table: str, columns: list[str] | None) -> DataFrame:
    schema = SCHEMAS[table]
    if columns:
        known = {f.name: f for f in schema.fields}
        schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in columns])
    return spark.read.csv(path, header=True, schema=_as_text(schema), enforceSchema=False)


def unparsed_cells(spark: SparkSession, path: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """(table_name, column_name, cells): per column how many cells are filled but did not parse."""
    raw = _raw(spark, path, table, columns)
    fields = [f for f in SCHEMAS[table].fields if f.name in raw.columns]
    lost = [F.count_if(F.col(f.name).isNotNull() & _parse(f).isNull()).alias(f.name) for f in fields]
    counted = raw.agg(*lost)
    cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("cells")) for f in fields])
    return counted.select(F.lit(table).alias("table_name"), F.inline(cells))


def scan_with_quarantine(
    spark: SparkSession, path: str, table: str, store: HandOver, columns: list[str] | None = None, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of a CSV table, and (file_name, block_start, line) of its broken lines, from one read.

    A line is broken if it has fewer or more cells than the table has columns: cut short, with a cell too many, or torn
    by a quote that stays open. Every line that is not blank is in one of the two tables, which are read
    from one written scan. ``block_start`` is the first byte of the part of the file that held the line.
    Cells of whole lines that do not parse become NULL, as in :func:`read_csv`.
    """
    fields = {f.name: f for f in SCHEMAS[table].fields}
    names = columns or list(fields)
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in names), T.StructField(BROKEN, T.StringType())])
    raw = spark.read.csv(path, header=header, schema=schema, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    place = [F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("block_start")]
    # Columns that are no part of the table are scanned too: without them the parser does not count the cells.
    kept = [_parse(fields[c]) if c in fields else F.col(c) for c in names]
    scanned = store.put(f"scan_{table}", raw.select(*kept, BROKEN, *place))
    whole = scanned.where(F.col(BROKEN).isNull()).select(*[c for c in fields if c in names])
    return whole, scanned.where(F.col(BROKEN).isNotNull()).select("file_name", "block_start", F.col(BROKEN).alias("line"))


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _parse(field: T.StructField):
    col = F.trim(F.col(field.name))
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        # Integer columns with missing cells are often exported as "3.0". A fraction other than zero
        # is no integer, and no cell takes the way through a double, which would merge long ids.
        whole = F.regexp_extract(col, r"^([+-]?\d+)(?:\.0*)?$", 1)
        return F.when(whole != "", whole).try_cast(field.dataType).alias(field.name)
    return col.try_cast(field.dataType).alias(field.name)


def read_tables(
    spark: SparkSession, folder: str, fmt: str = "csv", prefix: str = "",
    columns: dict[str, list[str]] | None = None,
) -> Tables:
    """Read ``{folder}/{prefix}{table}.csv`` (or ``.parquet``) for all five tables."""

    def scan(table: str) -> DataFrame:
        path = f"{folder}/{prefix}{table}.{fmt}"
        if fmt == "csv":
            return read_csv(spark, path, table, (columns or {}).get(table))
        return spark.read.format(fmt).load(path)

    return Tables(
        actions=scan("action"),
        products=scan("product"),
        shops=scan("shop").withColumnRenamed("cate", "main_cate"),
        users=scan("user"),
        comments=scan("comment"),
    )


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Write a result list; CSV gets a header line."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_result(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a written result list back with its known schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
