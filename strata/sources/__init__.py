"""Sources and sinks: incoming CSV files, layer tables, raw archive,
metadata tables, catalog DDL and warehouse tables."""

from .archive import ARCHIVE_PARTITIONS, archive_files, archive_frame
from .catalog import (
    add_columns,
    create_table,
    ensure_database,
    ensure_view,
    qualified,
    quote,
    register_layer_table,
    table_exists,
)
from .files import check_format, list_files, read_csv
from .layers import layer_exists, read_layer, snapshot_layer, try_read_layer, write_layer
from .metadata import read_business_csv, read_technical_csv, save_metadata
from .warehouse import insert_from_staging, read_warehouse, write_staging
