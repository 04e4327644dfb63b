"""Sources and sinks: table scans, stand-in mapping, CSV, snapshots, registry."""

from civora.sources.tables import read_table, TABLES  # noqa: F401
from civora.sources.standins import standin, duck_cte, STANDINS  # noqa: F401
