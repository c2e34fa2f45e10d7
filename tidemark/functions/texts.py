"""Text, JSON and log-line expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import _c

# Record formats.
TRANSACTION_ID = r"^TXN_\d{8}_\d{6}$"
LOG_LEVELS = ("ERROR", "WARN", "INFO", "DEBUG")
LOG_TEMPLATE = (
    r"^(\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}):\d{{2}}:\d{{2}} \[({levels})\] ([^:]+):.*$"
)
ACCESS_LINE = (
    r'^(\S+) \S+ \S+ \[([^\]]*)\] "(\S+) (\S+) [^"]*" (\d{3}) (\d+) '
    r'"[^"]*" "([^"]*)" (\d+)ms$'
)
ERROR_HEADER = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} \[ERROR\] ([^:]+): (\w+):"
STACK_FRAME = r"\tat ([^\n(]+)\("


def text(column) -> Column:
    """Message key or value bytes as text."""
    return _c(column).cast("string")


def clean(column) -> Column:
    return F.lower(F.trim(_c(column)))


def json_text(column, path) -> Column:
    return F.get_json_object(_c(column), path)


def json_number(column, path) -> Column:
    return F.get_json_object(_c(column), path).try_cast("double")


def contains(column, part) -> Column:
    """Substring test that is false, not null, for a null value."""
    return F.coalesce(_c(column).contains(part), F.lit(False))


def composite_key(*columns, sep=":") -> Column:
    return F.concat_ws(sep, *[_c(c) for c in columns])


def part_of(column, sep, position) -> Column:
    """The ``position``-th piece (from 1) of a separated text, empty when missing."""
    return F.split_part(_c(column), F.lit(sep), F.lit(position))


def iso_to_plain(column) -> Column:
    """2024-01-01T10:00:00Z as 2024-01-01 10:00:00."""
    return F.trim(F.translate(_c(column), "TZ", "  "))


def matches(column, pattern) -> Column:
    return _c(column).rlike(pattern)


def is_transaction_id(column) -> Column:
    return matches(column, TRANSACTION_ID)


def two_places(column) -> Column:
    """Fixed two-decimal text, for text exports only."""
    return F.format_string("%.2f", _c(column).cast("double"))


def parse_log_lines(lines: DataFrame, levels=LOG_LEVELS, column="value") -> DataFrame:
    """hour, level and component of application log lines; other lines are dropped."""
    pattern = LOG_TEMPLATE.format(levels="|".join(levels))
    line = F.col(column)
    return lines.where(line.rlike(pattern)).select(
        F.regexp_extract(line, pattern, 1).alias("hour"),
        F.regexp_extract(line, pattern, 2).alias("level"),
        F.trim(F.regexp_extract(line, pattern, 3)).alias("component"),
    )


def parse_access_lines(lines: DataFrame, column="value") -> DataFrame:
    """Fields of access-log lines; the zone in the time may be blank (then session zone)."""
    line = F.col(column)
    time = F.trim(F.regexp_extract(line, ACCESS_LINE, 2))
    return lines.where(line.rlike(ACCESS_LINE)).select(
        F.regexp_extract(line, ACCESS_LINE, 1).alias("ip"),
        F.coalesce(
            F.try_to_timestamp(time, F.lit("dd/MMM/yyyy:HH:mm:ss Z")),
            F.try_to_timestamp(time, F.lit("dd/MMM/yyyy:HH:mm:ss")),
        ).alias("ts"),
        F.regexp_extract(line, ACCESS_LINE, 3).alias("method"),
        F.regexp_extract(line, ACCESS_LINE, 4).alias("path"),
        F.regexp_extract(line, ACCESS_LINE, 5).cast("int").alias("status"),
        F.regexp_extract(line, ACCESS_LINE, 6).cast("long").alias("bytes"),
        F.regexp_extract(line, ACCESS_LINE, 7).alias("agent"),
        F.regexp_extract(line, ACCESS_LINE, 8).cast("long").alias("duration_ms"),
    )


def parse_error_blocks(blocks: DataFrame, column="value") -> DataFrame:
    """Component, error type, stack depth and top frame of header-plus-stack blocks."""
    block = F.ltrim(F.col(column))
    frames = F.regexp_extract_all(block, F.lit(STACK_FRAME), 1)
    return blocks.where(block.rlike(ERROR_HEADER)).select(
        F.trim(F.regexp_extract(block, ERROR_HEADER, 1)).alias("component"),
        F.regexp_extract(block, ERROR_HEADER, 2).alias("error_type"),
        F.size(frames).alias("depth"),
        F.try_element_at(frames, F.lit(1)).alias("top_frame"),
    )


def hashtag_counts(posts: DataFrame, column="hashtags") -> DataFrame:
    return (
        posts.select(F.explode(column).alias("tag"))
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("mentions"))
    )
