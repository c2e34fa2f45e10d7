"""Apply a Python function to whole texts inside tasks, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def column(name: str):
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """The name, lengthened until the frame has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


BROADCAST_ROWS = 500_000
PIECE_ROWS = 512
BATCH_ROWS = 1024
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches limited to ``BATCH_ROWS`` rows.

    Arrow buffers lie outside the heap of an executor, and texts are long: with the usual
    10 000 rows a batch of long texts takes more than the heap leaves. A lower limit stays.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_CONF, "10000")) <= BATCH_ROWS:
        conf.set(BATCH_CONF, str(BATCH_ROWS))
    return df


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in smaller parts, which bounds what Python holds of them at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(start, PIECE_ROWS)


def drop_rows(df: DataFrame, ids: list, gone: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df`` whose ``ids``, columns or expressions, are not a row of ``gone``.

    Nulls equal nulls. Up to ``most`` different rows of ``gone`` are broadcast, so the texts
    of ``df`` need no shuffle; more are joined by shuffle.
    """
    key = fresh(df, "_own")
    names = [f"i{i}" for i in range(len(ids))]
    keys = gone.toDF(*names).distinct().select(F.struct(*names).alias("_gone")).checkpoint()
    if keys.count() <= most:
        keys = F.broadcast(keys)
    own = F.struct(*[c.alias(n) for c, n in zip(ids, names, strict=True)])
    marked = df.withColumn(key, own)
    return marked.join(keys, marked[key].eqNullSafe(F.col("_gone")), "left_anti").drop(key)


def add_columns(
    df: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[list], list[pa.Array]]],
    fields: str,
) -> DataFrame:
    """``df`` with the columns that ``make()`` computes from the texts of a batch.

    ``make`` runs once per task and returns a function from a list of texts (None for
    null) to one Arrow array per field. Input columns named like a new field are replaced;
    all others pass through unchanged. No row is added or dropped.
    """
    new = StructType.fromDDL(fields)
    added = set(new.names)
    passed = [c for c in df.columns if c not in added]
    text_at = len(passed)
    # Columns go by their place meanwhile, whatever their names hold.
    source = df.select(
        *[column(c).alias(f"c{i}") for i, c in enumerate(passed)],
        column(text_col).cast("string").alias("text"),
    )
    schema = StructType([*source.schema.fields[:-1], *new.fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in in_pieces(batches):
            arrays = compute(batch.column(text_at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:text_at], *arrays], names=schema.names
            )

    return limit_batches(source).mapInArrow(work, schema).toDF(*passed, *new.names)


def marks(characters: str) -> bytes:
    """A table for ``bytes.translate``: ``x`` for the given ASCII characters, else a space."""
    wanted = set(characters.encode())
    return bytes(ord("x") if b in wanted else ord(" ") for b in range(256))


def has_run(data: bytes, table: bytes, length: int) -> bool:
    """Whether UTF-8 text has a run of so many of the table's characters: a cheap test
    that spares most texts the scan with a pattern."""
    return b"x" * length in data.translate(table)


def spans_text(spans):
    """``kind:start:end`` of the spans, comma-joined in the order they have."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def of_kinds(spans, kinds):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_kind(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


SPANS = "array<struct<kind:string,start:int,end:int,score:double,text:string>>"

_SPAN = pa.struct(
    [
        ("kind", pa.string()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("score", pa.float64()),
        ("text", pa.string()),
    ]
)


def span_array(found: list[list[tuple]]) -> pa.Array:
    """Lists of (kind, start, end, score, text) as an Arrow list column."""
    names = ("kind", "start", "end", "score", "text")
    return pa.array(
        [[dict(zip(names, s, strict=True)) for s in spans] for spans in found], pa.list_(_SPAN)
    )
