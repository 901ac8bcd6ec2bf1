"""Chat formatting: root-to-leaf paths of reply trees, ranked by score and written as conversations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import tune
from wardline.workspace import release, stage

# The marks of a turn, and control strings of common chat templates.
TURN_BEGIN = "<|im_start|>"
TURN_END = "<|im_end|>\n"
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

TREE, NODE, PARENT = "tree_id", "node_id", "parent_id"


def escape(text: Column) -> Column:
    r"""Text in which no control string is left: ``\`` becomes ``\b``, the first letter of a control string ``\l`` or ``\s``."""
    angle = "|".join(s[1:].replace("|", r"\|") for s in CONTROL if s[0] == "<")
    square = "|".join(s[1:].replace("]", r"\]") for s in CONTROL if s[0] == "[")
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    text = F.regexp_replace(text, f"<(?={angle})", r"\\l")
    return F.regexp_replace(text, rf"\[(?={square})", r"\\s")


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    text = F.replace(text, F.lit("\\s"), F.lit("["))
    text = F.replace(text, F.lit("\\n"), F.lit("\n"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role is one line of the format, so its line ends are escaped as well."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def conversation_nodes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Plain conversations as trees without branches: each row answers the row before it.

    Rows are in order of turn, then role and text, so ties and repeated rows all stay, in a fixed
    order. Null conversation ids form one conversation of their own; null turns come first.
    """
    order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col("role"), F.col("text"))
    at = F.row_number().over(order).cast("long")
    return turns.select(
        F.col(conv).alias(TREE), at.alias(NODE), F.col("role"), F.col("text"), F.lit(0.0).alias("score")
    ).withColumn(PARENT, F.when(F.col(NODE) > 1, F.col(NODE) - 1))


def reply_paths(nodes: DataFrame, best: int | None = 1) -> DataFrame:
    """Chosen root-to-leaf paths: ``tree_id, leaf_id, rank, path_score, node_id, depth``, one row per
    node of a path; ``depth`` is the node's place in it, 1 at the root.

    ``nodes``: ``tree_id, node_id, parent_id, score``. A node whose parent is null or not in its tree is a
    root. A path's score is the mean of its nodes' scores (null counts 0); ``best`` paths stay per
    tree, ties go to the smaller leaf, ``None`` keeps all. Nodes on a cycle lead to no root and are in
    no path. Rows that repeat a node must be folded before; ``conversation_nodes`` numbers them apart.

    Each round joins every node's ancestor pointer with that ancestor's own pointer, so pointers double
    their reach and a chain of n nodes takes log2(n) rounds. The same pointers, taken from the leaves
    with the furthest first, then list the members of the chosen paths. Rounds are written tables.
    """
    tune(nodes.sparkSession)
    keys = nodes.select(
        F.col(TREE), F.col(NODE), F.col(PARENT), F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score")
    )
    present = keys.select(F.col(TREE).alias("t"), F.col(NODE).alias("p"))
    same_tree = F.col(TREE).eqNullSafe(F.col("t"))
    start = keys.join(present, same_tree & (F.col(PARENT) == F.col("p")), "left").select(
        TREE, NODE, F.col("p").alias("up"), F.col("score").alias("sum"), F.lit(1).cast("long").alias("depth")
    )
    pointers = [stage(start, "reply-pointers")]
    open_before = None
    while (still_open := pointers[-1].where(F.col("up").isNotNull()).count()) and still_open != open_before:
        open_before = still_open
        now = pointers[-1]
        above = now.select(
            F.col(TREE).alias("t"),
            F.col(NODE).alias("p"),
            F.col("up").alias("next"),
            F.col("sum").alias("more"),
            F.col("depth").alias("levels"),
        )
        moving = now.where(F.col("up").isNotNull()).join(above, same_tree & (F.col("up") == F.col("p")))
        moved = moving.select(
            TREE,
            NODE,
            F.col("next").alias("up"),
            (F.col("sum") + F.col("more")).alias("sum"),
            (F.col("depth") + F.col("levels")).alias("depth"),
        )
        pointers.append(stage(now.where(F.col("up").isNull()).unionByName(moved), "reply-pointers"))
    # A pointer left open lies on a cycle or hangs from one.
    reached = pointers[-1].where(F.col("up").isNull())
    inner = pointers[0].select(F.col(TREE).alias("t"), F.col("up").alias("p")).where(F.col("p").isNotNull())
    leaves = reached.join(inner, same_tree & (F.col(NODE) == F.col("p")), "left_anti")
    leaves = leaves.select(TREE, F.col(NODE).alias("leaf_id"), (F.col("sum") / F.col("depth")).alias("path_score"))
    order = Window.partitionBy(TREE).orderBy(F.col("path_score").desc(), "leaf_id")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    # Written in each round: a round reads its members twice, and rounds that are only planned would double their work.
    members = stage(ranked.withColumn(NODE, F.col("leaf_id")), "reply-members")
    for jump in reversed(pointers[:-1]):
        above = jump.where(F.col("up").isNotNull()).select(F.col(TREE).alias("t"), F.col(NODE).alias("p"), "up")
        higher = members.join(above, same_tree & (F.col(NODE) == F.col("p")))
        more = members.unionByName(higher.select(TREE, "leaf_id", "path_score", "rank", F.col("up").alias(NODE)))
        before, members = members, stage(more, "reply-members")
        release(before)
    release(*pointers[:-1])
    places = reached.select(F.col(TREE).alias("t"), F.col(NODE).alias("p"), "depth")
    return members.join(places, same_tree & (F.col(NODE) == F.col("p"))).drop("t", "p")


def format_paths(nodes: DataFrame, paths: DataFrame, learned: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per path: ``tree_id, leaf_id, rank, path_score, formatted, loss_spans``.

    A turn is written as begin mark, role, line end, text, end mark. Control strings inside roles and texts
    are escaped, so the marks are the only ones in the result and ``read_turns`` gets every turn back.
    Null roles and texts count as empty. ``loss_spans`` (array of ``start, length`` in code points of
    ``formatted``) covers the texts of the roles in ``learned``. A path is one string, so one row.
    """
    texts = nodes.select(
        F.col(TREE).alias("t"),
        F.col(NODE).alias("p"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    turns = paths.join(texts, F.col(TREE).eqNullSafe(F.col("t")) & (F.col(NODE) == F.col("p")))
    part = F.struct(
        F.col("depth"),
        F.concat(F.lit(TURN_BEGIN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        F.col("role").isin(list(learned)).alias("learned"),
    )
    grouped = (
        turns.groupBy(TREE, "leaf_id", "rank", "path_score")
        .agg(F.array_sort(F.collect_list(part)).alias("turns"))
        .withColumn(
            "written",
            F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END))),
        )
    )
    sizes = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda seen, t: F.struct(
            (seen["at"] + F.length(t["head"]) + F.length(t["body"]) + len(TURN_END)).alias("at"),
            F.when(
                t["learned"],
                F.concat(
                    seen["spans"],
                    F.array(
                        F.struct(
                            (seen["at"] + F.length(t["head"])).alias("start"),
                            F.length(t["body"]).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(seen["spans"])
            .alias("spans"),
        ),
        lambda seen: seen["spans"],
    )
    return grouped.select(
        TREE, "leaf_id", "rank", "path_score", F.concat_ws("", "written").alias("formatted"), sizes.alias("loss_spans")
    )


def format_trees(nodes: DataFrame, best: int | None = 1, learned: Sequence[str] = ("assistant",)) -> DataFrame:
    """``reply_paths`` of the trees, formatted by ``format_paths``; the nodes are written once for both."""
    nodes = stage(nodes, "reply-nodes")
    return format_paths(nodes, reply_paths(nodes, best), learned)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of ``role, text``."""
    parts = F.split(formatted, TURN_BEGIN.replace("|", r"\|"), -1)
    bodies = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(
        bodies,
        lambda part: F.struct(
            unescape(F.substring_index(part, "\n", 1)).alias("role"),
            unescape(
                F.substring(
                    part,
                    F.instr(part, "\n") + 1,
                    F.length(part) - F.instr(part, "\n") - len(TURN_END),
                )
            ).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.concat_ws(
        "",
        F.transform(
            spans,
            lambda span: unescape(F.substring(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int"))),
        ),
    )
