"""Sources (driver parquet tables, CSV) and sinks."""

from .sinks import write_table, write_text  # noqa: F401
from .tables import (  # noqa: F401
    load_raw_csv,
    load_raw_data,
    load_sales,
    load_stores,
    read_table,
    sales_from_lineitem,
    stores_from_supplier,
)
