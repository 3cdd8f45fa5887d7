"""Column-expression helpers: every function maps Columns to a Column and
stays inside Spark's own expression engine (no Python UDF)."""

from gaugeflow.functions.dates import (  # noqa: F401
    parse_page_time,
    parse_site_date,
    picker_text,
    split_timestamp,
)
from gaugeflow.functions.ids import coord_station_id, station_id, url_name  # noqa: F401
from gaugeflow.functions.text import (  # noqa: F401
    SPACE,
    WORD,
    cell_text,
    estimated_code,
    html_text,
    html_unescape,
    numeric_value,
    py_strip,
)
from gaugeflow.functions.status import link_status  # noqa: F401
