"""cellgrid: gridded and time-series environmental analytics as PySpark DataFrame operators."""

from cellgrid.session import get_session, read_table

__all__ = ["get_session", "read_table"]
