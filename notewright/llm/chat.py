"""Reply trees to training conversations: every root-to-leaf path, best first, in one reversible template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.session import materialised

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Every ``<|`` gets a second bar, so no control string can appear inside; ``unescape`` undoes it exactly."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _escape_role(role: Column) -> Column:
    """Roles end at a line break in the template, so their own line breaks are written as a control string."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<|br|>"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|br|>"), F.lit("\n")))


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Tables of (tree, node, up): each node's ancestor 1, 2, 4, ... steps above it, as far as any tree is deep.

    Each comes from joining the last one to itself, so a tree of depth d takes log2(d) rounds.
    """
    jumps = [materialised(nodes.filter("parent is not null").select("tree", "node", F.col("parent").alias("up")))]
    rows = jumps[0].count()
    while not jumps[-1].isEmpty():
        if 2 ** (len(jumps) - 1) > rows:
            raise ValueError("parents form a cycle")
        upper = jumps[-1].select(F.col("tree").alias("tree_up"), F.col("node").alias("via"), F.col("up").alias("upper"))
        on = F.col("tree").eqNullSafe(F.col("tree_up")) & (F.col("up") == F.col("via"))
        jumps.append(materialised(jumps[-1].join(upper, on).select("tree", "node", F.col("upper").alias("up"))))
    return jumps[:-1]


def tree_paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, above) for every node of every root-to-leaf path; ``above`` counts steps up from the leaf.

    ``nodes`` has tree, node and parent (null or unknown: a root). From the farthest jump
    to the nearest, the nodes found so far are joined to the jump and its ends are added, so
    each ancestor is reached exactly once.
    """
    inner = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("p")).filter("p is not null").distinct()
    is_inner = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p"))
    leaves = nodes.join(inner, is_inner, "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    linked = nodes.join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("p"))).select(
        "tree", "node", "parent"
    )
    jumps = _jumps(linked)
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("tree").alias("t"), F.col("node").alias("via"), F.col("up"))
        on = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("via"))
        higher = found.join(jump, on).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("above") + 2**k).alias("above")
        )
        found = materialised(found.unionByName(higher))  # each round refers to it twice
    return found


def format_trees(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One conversation per root-to-leaf path of every reply tree.

    ``messages``: tree, node, parent, role, text, score; null roles and texts count as empty,
    null scores as 0, and (tree, node) must be unique. Paths of a tree are ranked by the sum of
    their scores, highest first, ties by leaf. A text under the loss mask is trained on in the best-ranked path
    that holds its message only, so shared beginnings count once.

    Returns tree, leaf, branch (from 1), path_score, formatted, and loss_spans: starts and
    ends (exclusive) in code points of ``formatted``. An empty table gives no rows; other
    columns are ignored; a cycle of parents raises ValueError.
    """
    messages = messages.select(
        "tree",
        "node",
        "parent",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    messages = materialised(messages)  # the order of equal rows must not change between the joins
    paths = tree_paths(messages.select("tree", "node", "parent"))
    said = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text", "score")
    turn = F.struct((-F.col("above")).alias("at"), "node", "role", "text")
    whole = (
        paths.join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
        .groupBy("tree", "leaf")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.sum("score").alias("path_score"))
    )
    ranks = materialised(whole.select("tree", "leaf", "path_score", F.transform("turns", lambda x: x["node"]).alias("nodes")))
    several = ranks.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("tree").alias("t"))
    order = "row_number() over (partition by tree order by path_score desc, leaf)"
    branched = ranks.join(several, F.col("tree").eqNullSafe(F.col("t")), "left_semi")
    branched = branched.withColumn("branch", F.expr(order).cast("long"))
    owned = (
        branched.select("tree", "leaf", "branch", F.explode("nodes").alias("node"))
        .groupBy("tree", "node")
        .agg(F.min(F.struct("branch", "leaf")).alias("best"))
        .groupBy("tree", F.col("best.leaf").alias("leaf"), F.col("best.branch").alias("branch"))
        .agg(F.collect_set("node").alias("own"))
        .select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "branch", "own")
    )
    same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))
    ranked = whole.join(owned, same, "left")
    head = lambda x: F.concat(F.lit(START), _escape_role(x["role"]), F.lit("\n"))
    tail = END + "\n"
    masked = lambda x: (x["role"] == loss_role) & (
        F.col("own").isNull() | F.array_contains("own", x["node"])
    )
    pieces = F.transform(
        "turns",
        lambda x: F.struct(
            F.concat(head(x), escape(x["text"]), F.lit(tail)).alias("piece"),
            F.length(head(x)).cast("long").alias("head"),
            F.length(escape(x["text"])).cast("long").alias("size"),
            masked(x).alias("loss"),
        ),
    )
    span = "named_struct('start', acc.at + x.head, 'end', acc.at + x.head + x.size)"
    spans = F.expr(
        f"""aggregate(pieces,
            named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, end: bigint>>)),
            (acc, x) -> named_struct('at', acc.at + x.head + x.size + {len(tail)}L,
                'spans', if(x.loss, concat(acc.spans, array({span})), acc.spans)),
            acc -> acc.spans)"""
    )
    return (
        ranked.withColumn("pieces", pieces)
        .withColumn("formatted", F.array_join(F.transform("pieces", lambda x: x["piece"]), ""))
        .select(
            "tree",
            "leaf",
            F.coalesce("branch", F.lit(1).cast("long")).alias("branch"),
            "path_score",
            "formatted",
            spans.alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of role and text, unescaped."""
    chunks = F.slice(F.split(formatted, r"<\|im_start\|>", -1), F.lit(2), F.size(F.split(formatted, r"<\|im_start\|>", -1)))
    return F.transform(
        chunks,
        lambda x: F.struct(
            _unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(
                F.substr(
                    x,
                    F.locate("\n", x, 1) + 1,
                    F.length(x) - F.locate("\n", x, 1) - len(END) - 1,
                )
            ).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(
        spans,
        lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )


def reply_chains(turns: DataFrame, tree: str, turn: str, role: str, text: str) -> DataFrame:
    """Messages of plain conversations: each row answers the one before it, by turn, then role and text."""
    order = f"row_number() over (partition by tree order by `{turn}` nulls first, role, text)"
    return (
        turns.select(F.col(tree).alias("tree"), turn, F.col(role).alias("role"), F.col(text).alias("text"))
        .withColumn("node", F.expr(order).cast("long"))
        .select(
            "tree",
            "node",
            F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
            "role",
            "text",
            F.lit(0.0).alias("score"),
        )
    )
