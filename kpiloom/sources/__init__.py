"""Sources (logical table name -> DataFrame) and sinks (overwrite writes)."""

from kpiloom.sources.catalog import ParquetCatalog, read_table  # noqa: F401
from kpiloom.sources.published import Published  # noqa: F401
from kpiloom.sources.sinks import write_bucketed, write_table  # noqa: F401
