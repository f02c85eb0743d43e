"""Column functions: stamps, placement, date keys, missing-value handling."""

from panelflow.functions.columns import (  # noqa: F401
    PANDAS_NA_VALUES, add_import_date, add_import_datetime, add_ref_date,
    date_key, null_out, parse_compact_date, place_columns)
from panelflow.functions.dates import day_from_path, day_regex  # noqa: F401
