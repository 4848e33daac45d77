"""Column-level helpers: everything here returns a JVM-side ``Column``."""

from mercata.functions.calendar import calendar_attributes, date_key, to_date_col
from mercata.functions.measures import guarded_ratio, mean, ratio
from mercata.functions.naming import clean_name, clean_name_col, clean_names

__all__ = [
    "calendar_attributes",
    "clean_name",
    "clean_name_col",
    "clean_names",
    "date_key",
    "guarded_ratio",
    "mean",
    "ratio",
    "to_date_col",
]
