"""Line-oriented text sources.

A text becomes a table of lines ``(work columns..., line_no, line)`` with
``line_no`` dense from 1, numbered at ingest: the number is taken from the
split array, so no window and no shuffle is needed to number lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_END = r"(?:\r\n|\n|\r)"


def split_lines(text: Column) -> Column:
    """Array of the lines of a text, blank ones included. A line ends at
    ``\\r\\n``, ``\\n`` or ``\\r``, as in Spark's line reader; the last line's
    end adds none, and an empty text has no line."""
    body = F.regexp_replace(text, LINE_END + r"\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_END, -1))


def text_lines(df: DataFrame, text_col: str = "text", *, keep=None,
               line_col: str = "line", number_col: str = "line_no",
               neighbours: dict | None = None) -> DataFrame:
    """Explode a text column into one row per line, numbered 1..n.

    keep       -- columns carried to every line (default: all but the text).
    neighbours -- ``{name: k}`` extra columns holding the line ``k`` rows
                  before (k > 0) or after (k < 0) within the same text. They
                  are built as shifted copies of the split array before it
                  is exploded, so this costs no shuffle (NULL beyond the
                  ends).

    The exploded rows never carry the whole array (that would copy the text
    once per line).
    """
    keep = [c for c in df.columns if c != text_col] if keep is None else list(keep)
    if not neighbours:
        d = df.select(*keep, F.posexplode(split_lines(F.col(text_col))).alias("__pos", line_col))
        return d.select(*keep, (F.col("__pos") + 1).alias(number_col), line_col)
    arr = "__lines"
    d = df.select(*keep, split_lines(F.col(text_col)).alias(arr))
    n = F.size(arr)
    fields = [F.col(arr).alias(line_col)]
    for name, k in neighbours.items():
        pad = F.array_repeat(F.lit(None).cast("string"), abs(k))
        if k > 0:     # value k lines back: k NULLs, then the array without its last k
            shifted = F.concat(pad, F.slice(arr, 1, F.greatest(n - abs(k), F.lit(0))))
        else:         # value k lines ahead: the array from k+1 on, then k NULLs
            shifted = F.concat(F.slice(arr, abs(k) + 1, F.greatest(n - abs(k), F.lit(0))), pad)
        fields.append(F.slice(shifted, 1, n).alias(name))
    zipped = F.arrays_zip(*fields)
    d = d.select(*keep, F.posexplode(zipped).alias("__pos", "__z"))
    cols = [*keep, (F.col("__pos") + 1).alias(number_col), F.col("__z")[line_col].alias(line_col)]
    cols += [F.col("__z")[name].alias(name) for name in neighbours]
    return d.select(*cols)


def read_lines(spark: SparkSession, path: str, *, file_col: str = "filename", path_col: str | None = None,
               neighbours: dict | None = None, whole_files: bool = False) -> DataFrame:
    """Read every text file under ``path`` as lines, blank lines kept.

    Files are read line by line in splits, so a file of any size will do, and
    numbered by file, split offset and position inside the split with a block
    scan. ``whole_files=True`` reads each file as one row and numbers it in
    place, without a shuffle; for files that fit in a task. Both give the same
    rows, ``neighbours`` (see ``text_lines``) included.

    A file is told by its whole path; ``file_col`` shows its name without the
    directory (``list.files`` + ``gsub``), ``path_col`` the path if named.
    """
    shown = [F.regexp_extract("__path", r"([^/]*)$", 1).alias(file_col)] + ([F.col("__path").alias(path_col)] if path_col else [])
    extra = list(neighbours or {})
    if whole_files:
        raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("__path"), F.col("value").alias("text"))
        d = text_lines(raw, "text", keep=["__path"], line_col="line", number_col="line_no", neighbours=neighbours)
    else:
        from quillspark.operators.ordered import dense, ordered_scan
        raw = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__split"),
            F.monotonically_increasing_id().alias("__seq"),     # read order inside the split
            F.col("value").alias("line"))
        d = ordered_scan(raw, ["__path"], [dense("__split"), dense("__seq")], running={"line_no": (F.lit(1), True)},
                         shifts={name: ("line", k) for name, k in (neighbours or {}).items()})
    return d.select(*shown, F.col("line_no").cast("int").alias("line_no"), "line", *extra)


__all__ = ["split_lines", "text_lines", "read_lines"]
