"""Status-code display classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def status_class(status) -> Column:
    """<300 success, <400 redirect, <500 client_error, else server_error; NULL stays NULL."""
    s = F.col(status) if isinstance(status, str) else status
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s < 300, "success")
        .when(s < 400, "redirect")
        .when(s < 500, "client_error")
        .otherwise("server_error")
    )
