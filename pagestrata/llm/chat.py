"""Chat formatting from reply trees, in DataFrame operations only.

Messages point to the message they answer. Iterative self-joins with doubling steps find for each leaf all its ancestors: after k joins every
path knows its last 2^k messages, so a thread of n messages takes log2(n) joins. Branches of a conversation are ranked by the mean score of
their messages, the best `branches` are kept, and each path becomes one conversation in a template that marks turns:

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

In texts a backslash becomes two and `<|` becomes `<\\|`, so no text can hold a control string and reading back is exact; roles are
URL-encoded. The loss mask is a list of spans (start, length, in code points) over the formatted string, one for each assistant text.

Defined results: null text is empty, null role is an empty role; rows of null conv_id are one conversation; rows of null turn come first, equal turns
stand in order of role and text; a parent that does not exist makes its message a root; messages in a cycle, or that answer into one, have no root
and are left out, found by jumps that do not end before they pass the longest conversation; rows of one msg_id in a conversation are one message, the
first by parent, role and text; rows of null msg_id are left out; null scores count as 0, equal branches are ranked by leaf id; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

START, END = "<|im_start|>", "<|im_end|>"
KEY = ("conv_id", "_none")  # rows of null conv_id are one conversation


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def threads(turns: DataFrame) -> DataFrame:
    """conv_id, msg_id, parent_id, role, text, score: each row answers the one before it in its conversation."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("msg_id"))
    return numbered.withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)).withColumn("score", F.lit(0.0))


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables of jumps of 1, 2, 4, ... messages towards the root, and the messages that have no root (none if there are none)."""
    ids = nodes.select(*KEY, F.col("msg_id").alias("parent_id"))
    linked = nodes.join(ids.withColumn("_is", F.lit(True)), [*KEY, "parent_id"], "left").select(*KEY, "msg_id", F.when(F.col("_is"), F.col("parent_id")).alias("up"))
    out, longest = [materialize(linked.where("up IS NOT NULL"))], None  # messages whose jump would pass the root leave
    while not out[-1].isEmpty():
        if longest is None:
            longest = nodes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if 1 << (len(out) - 1) > longest:  # a jump longer than any path: what has one lies on a cycle or answers into one
            return out, out[-1].select(*KEY, "msg_id")
        jump = out[-1]
        far = jump.join(jump.select(*KEY, F.col("msg_id").alias("up"), F.col("up").alias("_far")), [*KEY, "up"])
        out.append(materialize(far.select(*KEY, "msg_id", F.col("_far").alias("up"))))
    return out, None


def root_to_leaf(messages: DataFrame) -> DataFrame:
    """conv_id, _none, leaf_id, msg_id, depth (0 at the leaf): the rows of every path from a root to a leaf; messages have both keys and one row each."""
    nodes = messages.select(*KEY, "msg_id", "parent_id")
    jumps, rootless = _jumps(nodes)
    if rootless is not None:
        nodes = materialize(nodes.join(rootless, [*KEY, "msg_id"], "left_anti"))
        for x in jumps:
            discard(x)
        jumps, _ = _jumps(nodes)
    leaves = nodes.join(nodes.select(*KEY, F.col("parent_id").alias("msg_id")).where("msg_id IS NOT NULL").distinct(), [*KEY, "msg_id"], "left_anti")
    paths = materialize(leaves.select(*KEY, F.col("msg_id").alias("leaf_id"), "msg_id", F.lit(0).cast("long").alias("depth")))
    for k, jump in enumerate(jumps[:-1]):
        more = paths.join(jump.select(*KEY, "msg_id", F.col("up").alias("_up")), [*KEY, "msg_id"]).select(*KEY, "leaf_id", F.col("_up").alias("msg_id"), (F.col("depth") + (1 << k)).alias("depth"))
        following = materialize(paths.union(more))
        discard(paths)
        paths = following
    for x in jumps:
        discard(x)
    return paths


def format_paths(messages: DataFrame, branches: int = 1, distinct: bool = False) -> DataFrame:
    """conv_id, branch (rank from 1), n_turns, formatted, loss_spans of the best paths of each conversation.

    messages: conv_id, msg_id, parent_id, role, text, score. distinct: whether msg_id is known to be unique in each conversation.
    """
    none = F.lit(0).cast(messages.schema["conv_id"].dataType)
    messages = messages.select("conv_id", "msg_id", "parent_id", "role", "text", "score").where("msg_id IS NOT NULL")
    messages = messages.withColumn("_none", F.col("conv_id").isNull()).withColumn("conv_id", F.coalesce("conv_id", none))
    if not distinct:
        first = Window.partitionBy(*KEY, "msg_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("parent_id", "role", "text", "score")])
        messages = messages.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    paths = root_to_leaf(messages)
    body = messages.select(*KEY, "msg_id", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"))
    full = paths.join(body, [*KEY, "msg_id"])
    ranked = full.groupBy(*KEY, "leaf_id").agg(F.avg("score").alias("_mean")).withColumn("branch", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("_mean"), "leaf_id"))).where(F.col("branch") <= branches).drop("_mean")
    head = F.concat(F.lit(START), F.url_encode(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turns = full.join(ranked, [*KEY, "leaf_id"]).withColumn("_head", head).withColumn("_body", escape(F.col("text"))).withColumn("_all", F.concat("_head", "_body", F.lit(END + "\n")))
    before = Window.partitionBy(*KEY, "branch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("_at", F.coalesce(F.sum(F.length("_all")).over(before), F.lit(0)))
    span = F.when(F.col("role") == "assistant", F.struct((F.col("_at") + F.length("_head")).alias("start"), F.length("_body").cast("long").alias("length")))
    grouped = placed.groupBy(*KEY, "branch").agg(F.count(F.lit(1)).alias("n_turns"), F.array_sort(F.collect_list(F.struct("_at", "_all"))).alias("_turns"), F.array_sort(F.collect_list(span)).alias("loss_spans"))
    return grouped.select(F.when(~F.col("_none"), F.col("conv_id")).alias("conv_id"), "branch", "n_turns", F.array_join(F.transform("_turns", lambda t: t["_all"]), "").alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted rows with turns (array of role and text) and loss_text, both read from the formatted string."""
    parts = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda x: x != "")
    cut = lambda x: F.instr(x, "\n")
    text = lambda x: F.substring(x, cut(x) + 1, F.length(x) - cut(x) - len(END) - 1)
    turns = F.transform(parts, lambda x: F.struct(F.url_decode(F.substring_index(x, "\n", 1)).alias("role"), unescape(text(x)).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from what reading back gives."""
    back = read_back(formatted)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
