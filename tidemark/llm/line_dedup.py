"""Fuzzy line deduplication: keys from minima of hashed q-grams, edit similarity, connected groups."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rowwise import add_columns, column, fresh, limit_batches
from tidemark.operators.components import connected
from tidemark.operators.hotkeys import hot_keys, is_hot
from tidemark.session import shared_folder

SLOTS = 48  # minima of a line at each width of q-grams, at most
BYTES = 7  # of a long integer of a form, so that sums of its bytes do not overflow
LONGS = -(-SLOTS // BYTES)
PIECE = 4096  # q-grams of a piece of a line of ASCII
LEAST_PIECE = 16  # the same of other lines, at least
TRIMS = 4  # halvings of a text for its part that equals the beginning or end of another
PROBE = 12  # characters of a piece that alike lines mostly have in common
REACH = 1.75  # times the budget: length of beginnings whose edits tell most unlike texts
LINES_A_TASK = 10_000
# Memory and disk only: the minima of a task's lines fit the map of its aggregation that is found
# fastest, and the files of a shuffle go when the step that needs them has ended.
STEP_CONF = {
    "spark.sql.codegen.aggregate.fastHashMap.capacityBit": "19",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
MOST_PARTS = 20_000  # beyond it the aggregation of minima has more lines a task and spills
# Width of q-grams, minima in a key, and the lengths of lines that have such keys. The
# lengths overlap, so that any two lines within the edit budget share a width.
WIDTHS = ((2, 2, 1, 13), (4, 2, 10, 36), (6, 3, 28, 1 << 30))


@dataclass
class Settings:
    """Lines that share a key are compared, and linked when their edit distance is at most
    1 - ``similarity`` of the longer one's length. The lines of a key are compared with one of
    them, and where that one does not connect all, also all with each other that are not yet
    connected, more than ``crowd`` lines in blocks of ``block``. Hashes
    of up to ``broadcast_rows`` lines in pairs are broadcast, more are joined by shuffle.
    Two lines of 28 characters or more are aligned only if ``resemblance`` of their minima are
    equal. Lines of more than ``edit_chars`` characters are aligned by bits of long integers, which
    takes less time and gives the same distance."""

    similarity: float = 0.8
    resemblance: float = 0.18
    edit_chars: int = 20_000
    crowd: int = 64
    block: int = 1000
    broadcast_rows: int = 1_000_000


def normalised(line):
    """Lower case; all of ASCII that is no letter, digits included, as one space."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x00-\x60\x7B-\x7F]+", " "))


def _occurrences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, line_no, norm, node`` of all lines; blank lines have no node, null texts
    have no lines."""
    text = F.split(column(text_col).cast("string"), "\n")
    return (
        df.select(column(id_col).alias("doc_id"), F.posexplode(text).alias("line_no", "line"))
        .select("doc_id", "line_no", normalised(F.col("line")).alias("norm"))
        .withColumn("node", F.when(F.col("norm") != "", F.xxhash64("norm")))
    )


def _grams(lines: DataFrame) -> DataFrame:
    """``node, chars, q, gram``: hashes of the q-grams of each line at each of its widths.

    A substring of a text is found by walking from its start, so a line is cut into pieces that
    overlap by less than a gram; with the square root of its length as step, walks to pieces and
    in them are equally short. In lines of ASCII a gram is found by its place among the bytes,
    which hash like the text. A line shorter than a gram is one gram.
    """
    q = F.explode(F.array_compact(F.array(*[
        F.when((F.col("chars") >= least) & (F.col("chars") < most), F.lit(width)) for width, _, least, most in WIDTHS
    ])))
    ascii = F.octet_length("norm") == F.col("chars")
    step = F.when(ascii, F.lit(PIECE)).otherwise(F.greatest(F.ceil(F.sqrt("chars")), F.lit(LEAST_PIECE))).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(F.col("chars") - F.col("q"), F.lit(0)), F.col("step"))
    piece = F.transform(starts, lambda s: F.substr("norm", s + 1, F.col("q") + F.col("step") - 1))
    places = F.sequence(F.lit(1), F.greatest(F.length("piece") - F.col("q") + 1, F.lit(1)))

    def hashed(part):
        return F.xxhash64(F.substr(part, F.col("place"), F.col("q")))

    gram = F.when(F.col("bytes").isNotNull(), hashed(F.col("bytes"))).otherwise(hashed(F.col("piece")))
    return (
        lines.select("node", "chars", "norm", q.alias("q"), ascii.alias("ascii"), step.alias("step"))
        .select("node", "chars", "q", "ascii", F.explode(piece).alias("piece"))
        .select("node", "chars", "q", "piece", F.when(F.col("ascii"), F.col("piece").cast("binary")).alias("bytes"))
        .select("node", "chars", "q", "piece", "bytes", F.explode(places).alias("place"))
        .select("node", "chars", "q", gram.alias("gram"))
    )


def line_minima(lines: DataFrame) -> DataFrame:
    """``node, chars, q, minima, form`` of different lines ``node, chars, norm``: the hashes of
    q-grams are dealt to ``SLOTS`` slots, and the least one of each slot is a minimum, with the
    slot's number above its 24 bits, in the order of slots. The form has a byte for each slot,
    seven in a long integer: 0 without a minimum, else one of 127 values that follows from it."""
    # Length, width and slot go as one number, since every gram looks its group up.
    kind = F.shiftleft(F.col("chars").cast("long"), 3).bitwiseOR(F.col("q"))
    packed = F.shiftleft(kind, 6).bitwiseOR(F.pmod(F.col("gram"), F.lit(SLOTS)))
    least = (
        _grams(lines)
        .select("node", packed.alias("packed"), F.shiftrightunsigned("gram", 40).alias("value"))
        .groupBy("node", "packed")
        .agg(F.min("value").alias("least"))
    )
    # Two minima go in a long integer, one more each so that 0 is a slot without: numbers are
    # aggregated where they are, lists would be sorted first.
    slot = F.col("packed").bitwiseAND(63).cast("int")
    place = F.call_function("shiftleft", F.col("least") + 1, slot.bitwiseAND(1) * 32)
    twos = least.groupBy("node", F.shiftright("packed", 6).alias("kind")).agg(*[
        F.bit_or(F.when(F.shiftright(slot, 1) == k, place).otherwise(F.lit(0).cast("long"))).alias(f"two{k}")
        for k in range(-(-SLOTS // 2))
    ])
    lowest = (1 << 32) - 1
    found = twos.select("node", "kind", *[
        (F.shiftright(f"two{k // 2}", 32) if k % 2 else F.col(f"two{k // 2}").bitwiseAND(lowest)).alias(f"m{k}")
        for k in range(SLOTS)
    ])
    own = [F.col(f"m{k}") for k in range(SLOTS)]
    entries = [((k << 24) + own[k] - 1).cast("int") for k in range(SLOTS)]
    filled = sum((F.when(m > 0, 1).otherwise(0) for m in own[1:]), F.when(own[0] > 0, 1).otherwise(0)) == SLOTS
    some = F.array_compact(F.array(*[F.when(m > 0, entry) for m, entry in zip(own, entries, strict=True)]))
    byte = [F.when(m > 0, F.pmod(m - 1, F.lit(127)) + 1).otherwise(F.lit(0).cast("long")) for m in own]
    form = [
        sum((F.shiftleft(byte[k + i], 8 * i) for i in range(1, min(BYTES, SLOTS - k))), byte[k])
        for k in range(0, SLOTS, BYTES)
    ]
    return found.select(
        "node",
        F.shiftright("kind", 3).cast("int").alias("chars"),
        F.col("kind").bitwiseAND(7).cast("int").alias("q"),
        F.when(filled, F.array(*entries)).otherwise(some).alias("minima"),
        F.array(*form).alias("form"),
    )


def line_keys(minima: DataFrame) -> DataFrame:
    """``node, chars, key`` of ``line_minima``. Grams of six give a key per three slots, of the
    first minimum there and the two that follow; of four, each minimum with each of the two
    that follow; of two, each pair of minima. A single minimum is a key of its own."""
    own, count = F.col("minima"), F.size("minima")

    def ahead(i, steps):
        return F.element_at(own, F.pmod(i + steps, count) + 1)

    def group(entry):
        return F.shiftright(F.shiftright(entry, 24) * 171, 9)  # of three slots

    def first(x, i):
        return F.when(i == 0, True).otherwise(group(x) != group(F.element_at(own, i)))

    some = F.transform(own, lambda x, i: F.when(first(x, i), F.xxhash64(F.lit(6), x, ahead(i, 1), ahead(i, 2))))
    # Without an empty slot the places are known, and no function is called for each minimum.
    whole = F.array(*[F.xxhash64(F.lit(6), *[own[i + k] for k in range(3)]) for i in range(0, SLOTS, 3)])
    wide = F.when(count == SLOTS, whole).otherwise(F.array_compact(some))

    def pairs(reach):
        found = F.transform(
            own,
            lambda x, i: F.transform(
                F.slice(own, i + 2, reach), lambda y: F.xxhash64(F.col("q"), x, y)
            ),
        )
        return F.when(count == 1, F.array(F.xxhash64(F.col("q"), own[0]))).otherwise(F.flatten(found))

    keys = F.when(F.col("q") == 6, wide).when(F.col("q") == 4, pairs(F.lit(2))).otherwise(pairs(count))
    # Widths have keys of their own, so repeated ones are in one row and need no shuffle. No line
    # is without a key; the outer form spares Spark a test for it, which builds the keys again.
    keys = minima.select("node", "chars", F.array_distinct(keys).alias("keys"))
    return keys.select("node", "chars", F.explode_outer("keys").alias("key"))


def edits_within(a: str, b: str, budget: int) -> bool:
    """Whether the edit distance is at most ``budget``: a column of the table of distances is
    two integers of a bit per row."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > budget:
        return False
    if not b:
        return True
    codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    bits = {
        chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little")
        for c in np.unique(codes)
    }
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for place, c in enumerate(b, 1):
        same = bits.get(c, 0)
        across = (((same & up) + up) ^ up) | same
        same |= down
        rise, fall = down | (full & ~(across | up)), up & across
        score += bool(rise & top) - bool(fall & top)
        if score - (len(b) - place) > budget:
            return False
        rise, fall = (rise << 1 | 1) & full, fall << 1 & full
        up, down = fall | (full & ~(same | rise)), rise & same
    return score <= budget


def _trimmed(pairs: DataFrame) -> DataFrame:
    """``pairs`` without equal beginnings and ends of their texts, as far as ``TRIMS`` halvings of
    the shorter text find them. Edit distances stay as they are."""
    for end in ("head", "tail"):
        sizes = [F.length("one").alias("_n"), F.length("other").alias("_m"), F.lit(0).alias("_same")]
        pairs = pairs.select("node", "hub", "one", "other", "budget", *sizes)
        for k in range(1, TRIMS + 1):
            step = F.shiftright(F.least("_n", "_m"), k)

            def part(text, size, step=step, end=end):
                start = F.col("_same") + 1 if end == "head" else F.col(size) - F.col("_same") - step + 1
                return F.substr(F.col(text), start, step)

            more = F.when(part("one", "_n") == part("other", "_m"), step).otherwise(0)
            pairs = pairs.withColumn("_same", F.col("_same") + more)
        start = F.col("_same") + 1 if end == "head" else F.lit(1)
        cut = [F.substr(F.col(t), start, F.col(n) - F.col("_same")).alias(t) for t, n in (("one", "_n"), ("other", "_m"))]
        pairs = pairs.select("node", "hub", "budget", *cut)
    return pairs


def _near(pairs: DataFrame) -> DataFrame:
    """``node, hub, alike`` of ``pairs`` of texts: whether the edit distance is within ``budget``.

    With a budget the distance is computed in a band; -1 says that it is larger. Texts with pieces
    in common are tried with parts of the budget first. Others are first compared without ends of
    equal length: the distance of the beginnings is at most that of the whole, since what the ends
    move they have to move back.
    """
    one, other, budget = F.col("one"), F.col("other"), F.col("budget")

    def within(left, right, most):
        return F.call_function("levenshtein", left, right, most) >= 0

    def shared(share):
        piece = F.substr(one, F.floor(F.length(one) * share).cast("int") + 1, F.lit(PROBE))
        return F.when(F.call_function("instr", other, piece) > 0, 1).otherwise(0)

    common = shared(0.25) + shared(0.5) + shared(0.75) > 1
    left = F.greatest(F.length(one), F.length(other)) - F.floor(budget * REACH).cast("int")
    cut = [F.substr(t, F.lit(1), F.length(t) - F.col("_left")) for t in (one, other)]
    alike = (
        F.when(F.col("_common") & within(one, other, F.shiftright(budget, 2)), True)
        .when(F.col("_common") & within(one, other, F.shiftright(budget, 1)), True)
        .when(~F.col("_common") & (F.col("_left") > 0) & ~within(*cut, budget), False)
        .otherwise(within(one, other, budget))
    )
    pairs = _trimmed(pairs).withColumn("_common", common).withColumn("_left", left)
    return pairs.select("node", "hub", alike.alias("alike"))


def _alike(pairs: DataFrame, settings: Settings) -> DataFrame:
    """``pairs`` of the texts ``one`` and ``other`` with ``alike`` instead of them."""
    longest = F.greatest(F.length("one"), F.length("other"))
    budget = F.floor((1 - settings.similarity) * longest + 1e-9).cast("int")
    seen = _near(pairs.where(longest <= settings.edit_chars).withColumn("budget", budget))
    # Very long pairs go through Python as one text; a normalised line has no line break.
    both = F.concat_ws("\n", "one", "other", budget.cast("string"))

    def make():
        def compute(texts):
            out = []
            for text in texts:
                one, other, most = text.split("\n")
                out.append(edits_within(one, other, int(most)))
            return [pa.array(out, pa.bool_())]

        return compute

    long = pairs.where(longest > settings.edit_chars).select("node", "hub", both.alias("_both"))
    long = add_columns(limit_batches(long), "_both", make, "alike boolean")
    return seen.unionByName(long.select("node", "hub", "alike"))


def _ends(pairs: DataFrame, settings: Settings) -> DataFrame:
    """``node``: the different lines of ``pairs``, marked for a broadcast if they are not too many."""
    ends = pairs.select(F.explode(F.array("node", "hub")).alias("node")).distinct().checkpoint()
    return F.broadcast(ends) if ends.count() <= settings.broadcast_rows else ends


def _verified(pairs: DataFrame, lines: DataFrame, settings: Settings) -> DataFrame:
    """Those of ``pairs`` that are alike; texts are read for their lines only."""
    texts = lines.join(_ends(pairs, settings), "node").groupBy("node").agg(F.first("norm").alias("norm"))
    joined = pairs.join(texts.toDF("node", "one"), "node").join(texts.toDF("hub", "other"), "hub")
    # What is alike is written before it is looked at: a filter would be moved below, with copies.
    return _alike(joined, settings).checkpoint().where("alike").select("node", "hub")


def _marks(long):
    """A bit for each byte that is not 0; bytes are below 128."""
    return (long + F.lit(0x7F7F7F7F7F7F7F)).bitwiseAND(F.lit(0x80808080808080))


def _unlike(form, other, settings: Settings):
    """Whether too few minima of two lines are equal; short lines have no form and are never unlike.
    Bytes of a form that differ are of minima that differ, so no pair is left out by them that
    its minima would allow."""

    def total(count):
        return sum((F.bit_count(count(k)) for k in range(1, LONGS)), F.bit_count(count(0)))

    equal = total(lambda k: _marks(form[k]).bitwiseAND(F.bitwise_not(_marks(form[k].bitwiseXOR(other[k])))))
    most = F.greatest(total(lambda k: _marks(form[k])), total(lambda k: _marks(other[k])))
    return F.coalesce(equal < settings.resemblance * most, F.lit(False))


def _fits(chars, length, settings: Settings):
    """Whether lengths allow two lines to be alike."""
    return F.least(chars, length) >= settings.similarity * F.greatest(chars, length) - 1e-6


def _forms(minima: DataFrame) -> DataFrame:
    """``node, form``, one row for each line; the form is that of grams of six."""
    widest = F.coalesce(*[F.when(F.col("chars") >= least, F.lit(width)) for width, _, least, _ in WIDTHS[::-1]], F.lit(2))
    form = F.when(F.col("q") == 6, F.col("form"))
    return minima.where(F.col("q") == widest).select("node", form.alias("form"))


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose lines have different roots in ``known``."""
    one, other = known.toDF("node", "_root"), known.toDF("hub", "_other")
    roots = pairs.join(one, "node", "left").join(other, "hub", "left")
    return roots.where(F.coalesce("_root", "node") != F.coalesce("_other", "hub")).select("node", "hub")


def _links(minima: DataFrame, lines: DataFrame, settings: Settings) -> DataFrame:
    """``node, hub``: pairs of alike lines, of those of ``minima``. They join up all lines that
    share a key and are alike."""
    # Both uses read the same columns, so that one shuffle serves them.
    keyed = line_keys(minima).select("key", "node", "chars").repartition("key")
    hubs = keyed.groupBy("key").agg(
        F.min("node").alias("hub"), F.min_by("chars", "node").alias("length"), F.count(F.lit(1)).alias("lines")
    )
    folder = shared_folder(minima.sparkSession, "shared_keys")
    keyed.join(hubs.where("lines > 1"), "key").write.option("compression", "zstd").parquet(folder)
    shared = minima.sparkSession.read.parquet(folder)

    # Each line with the least ones of its keys: first with one of them, then with those it is apart from.
    pairs = shared.where((F.col("node") != F.col("hub")) & _fits(F.col("chars"), F.col("length"), settings))
    pairs = pairs.select("node", "hub").distinct().checkpoint()
    forms = _forms(minima).join(_ends(pairs, settings), "node")
    pairs = pairs.join(forms.toDF("node", "_form"), "node").join(forms.toDF("hub", "_other"), "hub")
    pairs = pairs.where(~_unlike(F.col("_form"), F.col("_other"), settings)).select("node", "hub").checkpoint()
    first = pairs.groupBy("node").agg(F.min("hub").alias("hub")).checkpoint()
    links = _verified(first, lines, settings)
    second = pairs.join(first, ["node", "hub"], "left_anti")
    second = _apart(second, connected(links, "node", "hub")).checkpoint()
    links = links.union(_verified(second, lines, settings))

    # Keys that still hold lines apart: all pairs that no links connect yet.
    rooted = shared.join(connected(links, "node", "hub"), "node", "left")
    rooted = rooted.select("key", "node", "chars", "lines", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("_least"), F.max("root").alias("_most"))
    # Written before forms are joined, so that the shuffles up to here take no disk beside theirs.
    folder = shared_folder(minima.sparkSession, "apart_keys")
    rest = rooted.join(mixed.where("_least != _most").select("key"), "key")
    rest.write.option("compression", "zstd").parquet(folder)
    rest = minima.sparkSession.read.parquet(folder).join(_forms(minima), "node")
    line = F.struct("node", "root", "chars", "form")
    few = rest.where(F.col("lines") <= settings.crowd).select("key", line.alias("line")).repartition("key")
    few = few.toDF("key", "one").join(few.toDF("key", "other"), "key").where("one.node < other.node")
    few = few.select("one", "other")
    # A larger crowd goes block by block.
    blocks = F.ceil(F.col("lines") / settings.block).cast("int")
    many = rest.where(F.col("lines") > settings.crowd).select("key", line.alias("line"), blocks.alias("blocks"))
    many = many.withColumn("own", F.pmod(F.xxhash64("line.node"), F.col("blocks")).cast("int"))
    one = many.select("key", F.col("line").alias("one"), F.col("own").alias("a"), F.explode(F.expr("sequence(own, blocks - 1)")).alias("b"))
    other = many.select("key", F.col("line").alias("other"), F.col("own").alias("b"), F.explode(F.expr("sequence(0, own)")).alias("a"))
    many = one.join(other, ["key", "a", "b"]).where("a < b or one.node < other.node").select("one", "other")

    def last(found):
        fits = _fits(F.col("one.chars"), F.col("other.chars"), settings)
        possible = fits & ~_unlike(F.col("one.form"), F.col("other.form"), settings)
        least, most = F.least("one.node", "other.node"), F.greatest("one.node", "other.node")
        return found.where((F.col("one.root") != F.col("other.root")) & possible).select(
            most.alias("node"), least.alias("hub")
        )

    left = last(few).union(last(many)).distinct().join(pairs, ["node", "hub"], "left_anti")
    return links.union(_verified(left.checkpoint(), lines, settings))


@contextmanager
def _step_conf(spark):
    """``STEP_CONF`` for the steps inside; the session's own values come back after them."""
    before = {key: spark.conf.get(key, None) for key in STEP_CONF}
    for key, value in STEP_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _grouped(df: DataFrame, id_col: str, text_col: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """``doc_id, line_no, node`` of all lines, and ``node, root`` of those alike to others."""
    # Normalised lines are written once and read for each purpose by the columns it needs.
    folder = shared_folder(df.sparkSession, "lines")
    _occurrences(df, id_col, text_col).write.option("compression", "zstd").parquet(folder)
    lines = df.sparkSession.read.parquet(folder)
    found = lines.select("doc_id", "line_no", "node")
    texts = lines.where("node IS NOT NULL").select("node", "norm")

    # A line has up to SLOTS rows in the aggregation, so a task gets fewer lines than by bytes.
    parts = min(1 + lines.count() // LINES_A_TASK, MOST_PARTS)
    hot = hot_keys(texts, ["node"])
    rare = texts.where(~is_hot(["node"], hot)).repartition(parts, "node") if hot else texts.repartition(parts, "node")
    minima = line_minima(rare.dropDuplicates(["node"]).withColumn("chars", F.length("norm")))
    if hot:  # lines that very many rows repeat are combined before the shuffle
        often = texts.where(is_hot(["node"], hot)).dropDuplicates(["node"])
        minima = minima.union(line_minima(often.withColumn("chars", F.length("norm"))))
    keys = shared_folder(df.sparkSession, "line_minima")
    minima.write.option("compression", "zstd").parquet(keys)
    linked = _links(df.sparkSession.read.parquet(keys), texts, settings)
    return found, connected(linked, "node", "hub")


def line_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """One row per line of every text: ``doc_id, line_no, keep_id, keep_line, kept``.

    Lines equal after normalisation form a group, groups that are alike join up, and of all
    connected ones the occurrence with the smallest id and line number stays; null ids come
    last. Lines are compared if they share a key of minima of hashed q-grams; ``Settings`` says
    which of them are aligned and how a key that very many lines share is compared. Lines without letters are always kept. A null text
    has no lines, an empty one has one that is kept. Rows repeated with an id share their
    lines' decisions. An empty table gives an empty result; other columns are not read.
    """
    settings = settings or Settings()
    with _step_conf(df.sparkSession):
        found, groups = _grouped(df, id_col, text_col, settings)

    # The first occurrence of each group; every line finds it through its node.
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line_no")
    firsts = found.where("node IS NOT NULL").groupBy("node").agg(F.min(place).alias("first"))
    merged = firsts.join(groups, "node").groupBy("root").agg(F.min("first").alias("least"))
    moved = groups.join(merged, "root").select("node", "least")
    labels = firsts.join(moved, "node", "left").select(
        F.col("node").alias("_node"), F.coalesce("least", "first").alias("keep")
    )
    blank = F.col("node").isNull()
    spread = F.coalesce("node", F.xxhash64("doc_id", "line_no"))
    joined = found.withColumn("_key", spread).join(labels, F.col("_key") == F.col("_node"), "left")
    return joined.select(
        "doc_id", "line_no",
        F.when(blank, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.when(blank, F.col("line_no")).otherwise(F.col("keep.line_no")).alias("keep_line"),
        (blank | place.eqNullSafe(F.col("keep"))).alias("kept"),
    )


def drop_repeated_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """``df`` with the lines that go cut out of its texts; all rows and columns stay.

    Cases as in ``line_groups``; a text may become empty, a null text stays null.
    """
    gone, key = fresh(df, "_gone"), fresh(df, "_own")
    goes = (
        line_groups(df, id_col, text_col, settings).where("not kept").groupBy("doc_id")
        .agg(F.collect_set("line_no").alias(gone)).withColumnRenamed("doc_id", key)
    )
    text = column(text_col)
    lines = F.filter(
        F.split(text, "\n"), lambda _, i: ~F.array_contains(F.coalesce(F.col(gone), F.array().cast("array<int>")), i)
    )
    joined = df.join(goes, column(id_col).eqNullSafe(F.col(key)), "left")
    return joined.select(
        *[F.array_join(lines, "\n").alias(c) if c == text_col else column(c) for c in df.columns]
    )
