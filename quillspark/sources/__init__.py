from quillspark.sources.text import read_lines, text_lines, split_lines  # noqa: F401
from quillspark.sources.tables import (  # noqa: F401
    load_table, read_csv_header, read_tsv, write_csv, make_table,
)
