"""Response outcome split: 200 / other status / transport error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status texts written to the status table.
SUCCESS = "Success"
FAILED = "Failed"
HTTP_OK = 200


def update_status(status: Column) -> Column:
    """'Success' for 200, 'Failed' for any other status, NULL for a transport
    error (status NULL): those change no state and only reach the audit."""
    return F.when(status == HTTP_OK, F.lit(SUCCESS)).when(status.isNotNull(), F.lit(FAILED))


def applies(status: Column) -> Column:
    """Whether a response changes the status table at all."""
    return status.isNotNull()
