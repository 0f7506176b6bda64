"""Where tables come from: CSV files, JDBC databases, table folders, generated registrations."""

from .csv_files import read_csv
from .inference import land_inferred
from .jdbc import read_jdbc, read_jdbc_balanced
from .seed import registrations_from_series
from .tables import read_path_sql, read_table

__all__ = [
    "land_inferred",
    "read_csv",
    "read_jdbc",
    "read_jdbc_balanced",
    "read_path_sql",
    "read_table",
    "registrations_from_series",
]
