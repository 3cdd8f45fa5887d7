"""Link status texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.constants import HTTP_OK, STATUS_LINK_INVALID, STATUS_SUCCESS


def link_status(http_status) -> Column:
    """'success' for HTTP 200, 'Error: link invalid' for anything else (null too)."""
    c = F.col(http_status) if isinstance(http_status, str) else http_status
    return F.when(c == HTTP_OK, F.lit(STATUS_SUCCESS)).otherwise(F.lit(STATUS_LINK_INVALID))
