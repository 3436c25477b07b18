"""Table readers and writers with explicit schemas."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def load_table(spark: SparkSession, base: str, name: str, partitions: int | None = None) -> DataFrame:
    """A stored table: ``<base>/<name>.parquet`` (R's ``load``/``data``).

    One task reads one split, at least a row group. Where a table has few row
    groups and the work on its rows is heavy, ``partitions`` deals the rows read
    to that many tasks (one shuffle of the columns asked for).
    """
    d = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return d.repartition(int(partitions)) if partitions else d


def read_csv_header(spark: SparkSession, path: str, schema: StructType, *,
                    blank_as_empty=(), multi_line: bool = True, whole_files: bool = False) -> DataFrame:
    """CSV with a header (``read.csv``); ``NA`` reads as NULL, doubled quotes
    as one, and quoted fields may hold line breaks.

    Files are read line by line in splits, so one file of any size is read by
    many tasks: the number of quotes before a line tells whether it goes on a
    quoted field, and the lines of a record are put together again. For that a
    quote may only stand in a quoted field. ``whole_files=True`` lets Spark read
    each file in one task instead (many small files); ``multi_line=False`` says
    that no field holds a line break. All give the same rows.

    Spark reads a blank field as NULL too, while R keeps ``""``. Columns
    listed in ``blank_as_empty`` (where the file holds no ``NA``) get R's
    ``""`` back.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line, "nullValue": "NA"}
    if multi_line and not whole_files:
        df = _csv_records(spark, path, schema, options)
    else:
        df = spark.read.schema(schema).options(**options).csv(path)
    if blank_as_empty:
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in blank_as_empty})
    return df


def _csv_records(spark: SparkSession, path: str, schema: StructType, options: dict) -> DataFrame:
    from quillspark.operators.ordered import dense, ordered_scan
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"))
    order = [dense("split"), dense("seq")]
    quotes = F.length("line") - F.length(F.translate("line", '"', ""))
    lines = ordered_scan(raw, ["path"], order, running={"before": (quotes, False)})
    # a blank line between records is no record
    starts = (F.col("before") % 2 == 0) & ~F.col("line").rlike(r"^\r?$")
    lines = ordered_scan(lines.select("path", *order, "line", (F.col("before") % 2 == 1).alias("inside"), starts.cast("int").alias("starts")),
                         ["path"], order, running={"record": (F.col("starts"), True)})
    lines = lines.where((F.col("starts") == 1) | F.col("inside"))
    # lines of one record come together by its number; most records are one line
    parts = F.array_sort(F.collect_list(F.struct("split", "seq", "line")))
    records = lines.groupBy("path", "record").agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))
    text = F.regexp_replace(F.regexp_replace("text", r"\r\n", "\n"), r"\r\z", "")  # line ends in fields as the whole-file reader has them
    parsed = F.from_csv(text, F.lit(schema.simpleString()[7:-1].replace(":", " ")), {k: str(v) for k, v in options.items() if k != "header"})
    return records.where("record > 1").select(parsed.alias("row")).select("row.*")


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header-less tab-separated file, no quoting (``read_tsv(col_names=F)``)."""
    return (spark.read.schema(schema).option("sep", "\t").option("quote", "")
            .option("header", False).csv(path))


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", row_numbers=None) -> None:
    """Write with a header, ``NA`` for NULL, ``""`` for empty text and doubled
    quotes (``write.csv``).

    ``row_numbers`` lists order columns: then R's leading column of row
    numbers (1, 2, ... in that order, headed by ``""``) is written too.
    """
    if row_numbers:
        from quillspark.operators.ordered import sorted_row_number
        df = sorted_row_number(df, [], row_numbers, "__row").select(F.col("__row").alias(""), *df.columns)
    (df.write.mode(mode).option("header", True).option("nullValue", "NA").option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def make_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small table built in code (``tibble``/``data.frame``): a local
    relation, whose size Spark knows without a job."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


__all__ = ["load_table", "read_csv_header", "read_tsv", "write_csv", "make_table"]
