"""Access-log line parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The host is the first field of the line, with or without a dot, as the log format has it.
HOST = r"^(\S+)\s"
# The other field patterns of a common-log-format line. Both signs of the UTC offset are read.
TIME = r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})\]"
REQUEST = r'"(\S+)\s(\S+)\s*(\S*)"'
STATUS = r"\s(\d{3})\s"
SIZE = r"\s(\d+)$"


def log_fields(line: Column) -> list[Column]:
    """Seven typed columns of an access-log line.

    On a line that does not match, text fields are empty and numbers are null; nothing fails.
    """
    return [
        F.regexp_extract(line, HOST, 1).alias("host"),
        F.regexp_extract(line, TIME, 1).alias("timestamp"),
        F.regexp_extract(line, REQUEST, 1).alias("method"),
        F.regexp_extract(line, REQUEST, 2).alias("endpoint"),
        F.regexp_extract(line, REQUEST, 3).alias("protocol"),
        F.regexp_extract(line, STATUS, 1).try_cast("int").alias("status"),
        F.regexp_extract(line, SIZE, 1).try_cast("int").alias("content_size"),
    ]


def log_time(text: Column) -> Column:
    """The bracketed time as a timestamp; null when it does not parse."""
    return F.try_to_timestamp(text, F.lit("dd/MMM/yyyy:HH:mm:ss Z"))
