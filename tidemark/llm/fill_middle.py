"""Fill-in-the-middle texts, cut with Arrow's compute functions one piece of a batch at a time.

The code points of the texts become one list array; flattened, each knows its text (parent
index) and its place there (ordinal). The ordinal tells its role: before, inside or after the
middle. The units of a role are filtered out, rebuilt into one list per text and joined; the
joined parts are put together around the marks. Where a text is cut, and whether at all, comes
from a hash of its id and is decided by Spark expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.rowwise import column, limit_batches

# Bytes of text that are split into units at a time; a unit takes some 40 bytes meanwhile.
PIECE_BYTES = 1 << 20
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Marks:
    """The strings before prefix, suffix and middle.

    No end of a mark may be the beginning of one: then a mark is found where it was put, and
    nowhere else, whatever the parts begin and end with.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        for i, a in enumerate(self.all()):
            for j, b in enumerate(self.all()):
                if not a or any(b.startswith(a[-k:]) for k in range(1, len(a) + (i != j))):
                    raise ValueError(f"the end of {a!r} can begin {b!r}")

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def code_points(texts: pa.Array) -> pa.ListArray:
    """The texts (no nulls) as lists of their code points."""
    texts = pa.concat_arrays([texts.cast(pa.string())])  # offsets from 0
    _, offsets, data = texts.buffers()
    size = len(texts)
    ends = pa.Array.from_buffers(pa.int32(), size + 1, [None, offsets], offset=texts.offset)
    total = ends[-1].as_py()
    raw = pa.Array.from_buffers(pa.uint8(), total, [None, data])
    # A byte 10xxxxxx continues a code point, all others begin one.
    begins = pc.not_equal(pc.bit_wise_and(raw, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8()))
    starts = pc.indices_nonzero(begins).cast(pa.int32())
    bounds = pa.concat_arrays([starts, pa.array([total], pa.int32())])
    units = pa.Array.from_buffers(pa.string(), len(starts), [None, bounds.buffers()[1], data])
    counts = pc.utf8_length(texts)
    return pa.ListArray.from_arrays(_offsets(counts), units)


def _offsets(counts: pa.Array) -> pa.Array:
    zero = pa.array([0], pa.int32())
    return pa.concat_arrays([zero, pc.cumulative_sum(counts.cast(pa.int32()))])


def cut(texts: pa.Array, start: pa.Array, end: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(prefix, middle, suffix) of each text, for code point places ``start <= end``."""
    lists = code_points(texts)
    parent = pc.list_parent_indices(lists)
    units = pc.list_flatten(lists)
    first = pc.take(lists.offsets, parent)
    ordinal = pc.subtract(pa.array(np.arange(len(units), dtype=np.int32)), first)
    before = pc.less(ordinal, pc.take(start, parent))
    after = pc.greater_equal(ordinal, pc.take(end, parent))
    inside = pc.invert(pc.or_(before, after))
    size = pc.list_value_length(lists)
    counts = (start, pc.subtract(end, start), pc.subtract(size, end))
    parts = []
    for role, count in zip((before, inside, after), counts, strict=True):
        rebuilt = pa.ListArray.from_arrays(_offsets(count), pc.filter(units, role))
        parts.append(pc.binary_join(rebuilt, ""))
    return tuple(parts)


def _cut_long(text: str, start: int, end: int) -> tuple[str, str, str]:
    """``cut`` of one text that is longer than a piece, piece by piece."""
    parts = ([], [], [])
    step = PIECE_BYTES // 4
    for base in range(0, len(text), step):
        piece = text[base : base + step]
        low, high = (min(max(x - base, 0), len(piece)) for x in (start, end))
        found = cut(pa.array([piece]), pa.array([low], pa.int32()), pa.array([high], pa.int32()))
        for role, part in zip(parts, found, strict=True):
            role.append(part[0].as_py())
    return tuple("".join(role) for role in parts)


def _pieces(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with ``PIECE_BYTES`` of text at most, or of one longer row."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > PIECE_BYTES:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def rearranged(
    texts: pa.Array, forms: pa.Array, start: pa.Array, end: pa.Array, marks: Marks
) -> pa.Array:
    """The output text of each row; a plain row's is its text."""
    cuts = pc.not_equal(forms, PLAIN)
    chosen, order = pc.filter(texts, cuts), pc.filter(forms, cuts)
    start, end = pc.filter(start, cuts), pc.filter(end, cuts)
    out = []
    for low, high in _pieces(pc.binary_length(chosen).to_pylist()):
        rows = slice(low, high)
        if high - low == 1 and pc.binary_length(chosen)[low].as_py() > PIECE_BYTES:
            found = _cut_long(chosen[low].as_py(), start[low].as_py(), end[low].as_py())
            prefix, middle, suffix = (pa.array([x], pa.string()) for x in found)
        else:
            prefix, middle, suffix = cut(chosen[rows], start[rows], end[rows])
        leads = pc.equal(order[rows], PREFIX_FIRST)
        out.append(
            pc.binary_join_element_wise(
                pc.if_else(leads, marks.prefix, marks.suffix),
                pc.if_else(leads, prefix, suffix),
                pc.if_else(leads, marks.suffix, marks.prefix),
                pc.if_else(leads, suffix, prefix),
                marks.middle,
                middle,
                "",
            )
        )
    done = pa.concat_arrays(out) if out else pa.array([], pa.string())
    return pc.replace_with_mask(texts, cuts, done)


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
    marks: Marks = Marks(),
) -> DataFrame:
    """``df`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``plain_percent`` of the texts stay as they are, ``spm_percent`` of the others begin with
    their suffix (``spm``) and the rest with their prefix (``psm``), by hashes of ``seed`` and
    id: rows with one id are cut by the same numbers, and a null id counts as an empty one. A
    null text is empty. Empty texts and texts that hold a mark are plain; the lengths of a
    plain text are null. All rows and columns stay, but input columns of the new names are
    replaced; an empty table gives an empty result. Texts of any length are cut in pieces.
    """
    kept = [c for c in df.columns if c.lower() not in ADDED]
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    digest = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(column(id_col).cast("string"), F.lit(""))), 256
    )
    drawn = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    places = F.length("text") + 1
    held = F.lit(False)
    for mark in marks.all():
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | held | (F.col("h2") % 100 >= 100 - plain_percent)
    # Columns go by their place meanwhile, whatever their names hold.
    source = df.select(
        *[column(c).alias(f"c{i}") for i, c in enumerate(kept)],
        text.alias("text"),
        *[h.alias(f"h{i}") for i, h in enumerate(drawn)],
    ).select(
        *[f"c{i}" for i in range(len(kept))],
        "text",
        F.length("text").cast("long").alias("n"),
        F.when(plain, PLAIN)
        .when(F.col("h3") % 100 < spm_percent, SUFFIX_FIRST)
        .otherwise(PREFIX_FIRST)
        .alias("form"),
        F.least(F.col("h0") % places, F.col("h1") % places).cast("int").alias("start"),
        F.greatest(F.col("h0") % places, F.col("h1") % places).cast("int").alias("end"),
    )
    at = len(kept)
    schema = StructType([*source.schema.fields[:at], *source.schema.fields[at + 1 :], StructField("output", StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, _, forms, start, end = batch.columns[at:]
            output = rearranged(texts.cast(pa.string()), forms, start, end, marks)
            columns = [*batch.columns[:at], *batch.columns[at + 1 :], output]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    cuts = F.col("form") != PLAIN
    return (
        limit_batches(source)
        .mapInArrow(work, schema)
        .select(
            *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
            "n",
            "form",
            F.when(cuts, F.col("start")).cast("long").alias("prefix_chars"),
            F.when(cuts, F.col("end") - F.col("start")).cast("long").alias("middle_chars"),
            "output",
        )
    )


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that gave an output of the given form."""

    def between(first: str, last: str) -> Column:
        return F.substring_index(F.substring_index(output, first, -1), last, 1)

    middle = F.substring_index(output, marks.middle, -1)
    prefix_first = F.concat(
        between(marks.prefix, marks.suffix), middle, between(marks.suffix, marks.middle)
    )
    suffix_first = F.concat(
        between(marks.prefix, marks.middle), middle, between(marks.suffix, marks.prefix)
    )
    return (
        F.when(form == PLAIN, output)
        .when(form == PREFIX_FIRST, prefix_first)
        .otherwise(suffix_first)
    )
