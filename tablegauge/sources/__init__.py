"""Sources and sinks: table readers/writers and the run-history table."""
from tablegauge.sources.files import read_table, write_report, write_table  # noqa: F401
