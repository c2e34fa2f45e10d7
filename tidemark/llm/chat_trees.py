"""Reply trees as training conversations: one formatted text per chosen root-to-leaf path.

Messages point to the message they reply to. Self-joins enumerate the paths by doubling: a
table of pointers to the ancestor 2^k replies up, joined with itself, gives the one for
2^(k+1), so a path of n messages takes log n rounds. The leaves of a tree are ranked by the
score along their path; the chosen ones walk the pointer tables from the largest step to the
smallest, which meets every ancestor exactly once. Only ids and scores take part in this. Then
the messages of a path are joined to it, marked up and put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.rowwise import column
from tidemark.operators.running import running
from tidemark.session import cut_lineage

# What stands before and after the text of a role; fixed values of the template.
USER = ("[INST] ", " [/INST]")
ASSISTANT = (" ", "</s>")
SYSTEM = ("<<SYS>>\n", "\n<</SYS>>")
OTHER = ("[ROLE:", "[/ROLE]")
# Control strings: none is part of another or overlaps one.
CONTROL = r"([<\[])(\\*)((?:/?INST|/ROLE)\]|ROLE:|/?s>|</?SYS>>)"
ESCAPED = r"([<\[])\\(\\*)((?:/?INST|/ROLE)\]|ROLE:|/?s>|</?SYS>>)"
# A turn ends with the first closing mark.
TURN = r"(?s).*?(?: \[/INST\]|</s>|\n<</SYS>>|\[/ROLE\])"


def escape(text: Column) -> Column:
    """A backslash more behind the first character of each control string, so none is left."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _marked(role: Column, text: Column) -> Column:
    other = F.concat(F.lit(OTHER[0]), F.url_encode(role), F.lit("]"), text, F.lit(OTHER[1]))
    turn = other
    for name, (before, after) in (("user", USER), ("assistant", ASSISTANT), ("system", SYSTEM)):
        turn = F.when(role == name, F.concat(F.lit(before), text, F.lit(after))).otherwise(turn)
    return turn


def _role_and_text(turn: Column) -> Column:
    """What ``_marked`` was made from, still escaped."""

    def inner(marks: tuple[str, str], role: str) -> Column:
        length = F.length(turn) - len(marks[0]) - len(marks[1])
        return F.struct(
            F.lit(role).alias("role"),
            F.substring(turn, F.lit(len(marks[0]) + 1), length).alias("text"),
        )

    name = F.substring_index(F.substring(turn, len(OTHER[0]) + 1, 1 << 30), "]", 1)
    begin = F.length(name) + len(OTHER[0]) + 1
    other = F.struct(
        F.url_decode(name).alias("role"),
        F.substring(turn, begin + 1, F.length(turn) - begin - len(OTHER[1])).alias("text"),
    )
    return (
        F.when(turn.startswith(USER[0]), inner(USER, "user"))
        .when(turn.startswith(SYSTEM[0]), inner(SYSTEM, "system"))
        .when(turn.startswith(ASSISTANT[0]), inner(ASSISTANT, "assistant"))
        .otherwise(other)
    )


def chained(df: DataFrame, group_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows of linear conversations as messages ``id, parent, role, text``.

    Each row replies to the one before it in its group. Rows that tie in the order come by
    role, then text; rows equal in all are interchangeable. Nulls come first; rows without a
    group are one group. A group with very many rows is numbered in ranges of the order.
    """
    rows = df.select(
        column(group_col).alias("group"),
        column(order_col).alias("place"),
        column(role_col).cast("string").alias("role"),
        column(text_col).cast("string").alias("text"),
    )
    numbered = running(rows, ["group"], ["place", "role", "text"], [("n", "count", F.lit(1))])
    before = F.struct("group", (F.col("n") - 1).alias("n"))
    return numbered.select(
        F.struct("group", "n").alias("id"),
        F.when(F.col("n") > 1, before).alias("parent"),
        "role",
        "text",
    )


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables ``node, up`` for steps 1, 2, 4, … and ``node, root, score`` of nodes below a root.

    Each table holds only nodes that have so many ancestors, so the last one is the one before
    the first empty one. Nodes in or below a circle of replies never get to a root: the rounds
    end when a step is longer than the number of nodes, and they are left out.
    """
    count = nodes.count()
    roots = nodes.where("parent IS NULL").select("node", F.col("node").alias("root"), "score")
    rooted = cut_lineage(roots)
    steps = []
    links = nodes.where("parent IS NOT NULL").select("node", F.col("parent").alias("up"), "score")
    current = cut_lineage(links)
    while not current.isEmpty() and 1 << len(steps) <= count:
        steps.append(current.select("node", "up"))
        # A pointer whose target knows its root ends there; the others go on twice as far.
        reached = _onward(current, rooted, "root")
        further = _onward(current, current, "up")
        rooted = rooted.unionByName(cut_lineage(reached))
        current = cut_lineage(further)
    return steps, rooted


def _onward(current: DataFrame, known: DataFrame, goal: str) -> DataFrame:
    """The pointers that ``known`` takes on to its ``goal``, with the scores added."""
    ahead = known.select(
        F.col("node").alias("_at"), F.col(goal).alias("_goal"), F.col("score").alias("_more")
    )
    joined = current.join(ahead, F.col("up") == F.col("_at"))
    return joined.select(
        "node", F.col("_goal").alias(goal), (F.col("score") + F.col("_more")).alias("score")
    )


def chosen_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``root, leaf, rank, score, node, depth`` of the best ``branches`` paths of each tree.

    ``messages`` has ``node`` (unique), ``parent`` and ``score``. A path's score is the sum along
    it; equal scores are ranked by leaf. None takes all paths.
    """
    nodes = cut_lineage(messages.select("node", "parent", "score"))
    steps, rooted = _pointers(nodes)
    replied = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("_at")).distinct()
    leaves = rooted.join(replied, F.col("node") == F.col("_at"), "left_anti")
    # Spark keeps ``branches`` rows per root in each task before it shuffles them.
    best = W.partitionBy("root").orderBy(F.desc("score"), F.asc("node"))
    ranked = leaves.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    ranked = ranked.select("root", F.col("node").alias("leaf"), "rank", "score")
    walk = cut_lineage(ranked.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above")))
    for k in reversed(range(len(steps))):
        step = steps[k].withColumnRenamed("node", "_at")
        up = walk.join(step, F.col("node") == F.col("_at"))
        walk = cut_lineage(
            walk.union(up.select("leaf", F.col("up").alias("node"), F.col("above") + F.lit(1 << k)))
        )
    ranked = ranked.withColumnRenamed("leaf", "_leaf")
    return walk.join(ranked, F.col("leaf").eqNullSafe(F.col("_leaf"))).drop("_leaf")


def format_chats(
    df: DataFrame,
    id_col: str = "id",
    parent_col: str = "parent",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str | None = None,
    branches: int | None = 1,
) -> DataFrame:
    """``root, leaf, rank, score, formatted, turns`` of the best paths of each reply tree.

    ``formatted`` holds the path's messages from root to leaf, each between the marks of its
    role, with control strings inside texts escaped. ``turns`` has ``begin`` of every turn in
    ``formatted`` and, for assistants, ``loss_start`` and ``loss_end`` of the text a model is
    to learn (code points from 0, end exclusive).

    A null text is empty, a null role an empty one, a null or missing score 0. A message whose
    parent is null or not in the table begins a tree; one without an id does too and has no
    replies. Of rows with one id the smallest by parent, score and a hash of role and text stays. Messages
    in or below a circle of replies have no root and are in no path. An empty table gives an
    empty result; other columns are not read. A path becomes one row, so it has to fit one.
    """
    score = F.lit(0.0) if score_col is None else F.coalesce(column(score_col).cast("double"), F.lit(0.0))
    rows = df.select(
        column(id_col).alias("node"),
        F.when(column(id_col).isNotNull(), column(parent_col)).alias("parent"),
        score.alias("score"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("role", "text"))

    def unique(*names: str) -> DataFrame:
        least = rows.groupBy("node").agg(F.min(F.struct(*names)).alias("row"))
        return least.select("node", "row.*")

    nodes = cut_lineage(unique("parent", "score", "mark").drop("mark"))
    known = nodes.select(F.col("node").alias("_at"))
    links = nodes.join(known, F.col("parent") == F.col("_at"), "left")
    paths = chosen_paths(links.select("node", F.col("_at").alias("parent"), "score"), branches)

    content = unique("parent", "score", "mark", "role", "text").select(
        F.col("node").alias("_at"), "role", escape(F.col("text")).alias("text")
    )
    turns = paths.join(content, F.col("node").eqNullSafe(F.col("_at"))).select(
        "root", "leaf", "rank", "score", "above",
        _marked(F.col("role"), F.col("text")).alias("turn"),
        F.when(F.col("role") == "assistant", F.length("text")).alias("learnt"),
    )
    path = W.partitionBy("leaf").orderBy(F.desc("above"))
    before = path.rowsBetween(W.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0))
    placed = turns.withColumn("begin", begin)
    start = F.when(F.col("learnt").isNotNull(), F.col("begin") + len(ASSISTANT[0]))
    ordered = F.sort_array(
        F.collect_list(
            F.struct(
                (-F.col("above")).alias("place"),
                "turn",
                F.struct(
                    "begin",
                    start.alias("loss_start"),
                    (start + F.col("learnt")).alias("loss_end"),
                ).alias("marks"),
            )
        )
    )
    whole = placed.groupBy("leaf").agg(
        F.first("root").alias("root"), F.first("rank").alias("rank"),
        F.first("score").alias("score"), ordered.alias("rows"),
    )
    return whole.select(
        "root", "leaf", "rank", "score",
        F.array_join("rows.turn", "").alias("formatted"),
        F.col("rows.marks").alias("turns"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted text with their marks."""
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def read_turns(turns: Column) -> Column:
    """``role, text`` of what ``turns_of`` gives, as they were before formatting."""
    return F.transform(
        F.transform(turns, _role_and_text),
        lambda t: F.struct(t["role"].alias("role"), unescape(t["text"]).alias("text")),
    )


def read_loss(turns: Column, marks: Column) -> Column:
    """The text under the loss mask in each turn, as it was before formatting.

    Each is cut from its own turn, so the time does not grow with the square of the length.
    """

    def read(turn: Column, mark: Column) -> Column:
        start = (mark["loss_start"] - mark["begin"] + 1).cast("int")
        length = (mark["loss_end"] - mark["loss_start"]).cast("int")
        return F.coalesce(unescape(F.substring(turn, start, length)), F.lit(""))

    return F.zip_with(turns, marks, read)
