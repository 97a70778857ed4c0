"""Conversation prefix trie: Spark SQL ROLLUP over positional turn-id columns, a block of columns at a time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.llm.common import ordered_sha256, stage
from tabulon.operators.ordering import with_position

#: Turns in one block of columns.
BLOCK = 8
#: Blocks of one conversation whose running values are computed in one group.
RUN = 1024
#: Ids that end at one node are written out in chunks of as many neighbouring ids (a power of two).
CHUNK_BITS = 13
#: A parent with more than 1/HOT of all nodes as children is joined by broadcast: fewer than HOT rows.
HOT = 1000
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def turn_id(role: Column, text: Column) -> Column:
    """The address of a turn: 16 bytes of the SHA-256 of its role and text."""
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(said.cast("binary"), 256)), 1, 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(``conv_id``, ``position`` from 0, ``id``, ``size`` in code points) by turn, nulls first, then role and text.

    Null roles and texts are empty; rows without a conv_id belong to no conversation and are left out.
    """
    rows = conversations.filter("conv_id is not null").select(
        "conv_id", F.col("turn").isNotNull().alias("_timed"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = with_position(rows, ["_timed", "turn", "role", "text"], ["conv_id"])
    return placed.select("conv_id", F.col("position").cast("long").alias("position"),
                         turn_id(F.col("role"), F.col("text")).alias("id"), F.length("text").cast("long").alias("size"))


def branched(turns: DataFrame, span: int = 100, most: int = 5) -> DataFrame:
    """Each conversation c begins with turns of c - c % span: (``conv_id``, ``depth`` from 1, ``id``, ``size``).

    The first h turns come from there (all if there are fewer, none if it is absent), then c's own after its first
    h; h = crc32(decimal c) % (most + 1). Every conversation also has a row of depth 0 without a turn, so that
    those left without any turn stay. ``turns`` is read several times: pass a staged table.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    base = F.col("conv_id") - F.col("conv_id") % span
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("_n"))
    known = convs.filter(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("_base"), "_n")
    heads = turns.filter((F.col("conv_id") % span == 0) & (F.col("position") < most)).select(
        F.col("conv_id").alias("_base"), "position", "id", "size")
    taken = convs.select("conv_id", base.alias("_base"), h.alias("_h")).join(heads, "_base").filter("position < _h")
    own = turns.filter(F.col("position") >= h).withColumn("_base", base).join(known, "_base", "left")
    return (
        taken.select("conv_id", (F.col("position") + 1).alias("depth"), "id", "size")
        .unionByName(own.select("conv_id", (F.col("position") - h + F.least(h, F.coalesce("_n", F.lit(0))) + 1).alias("depth"), "id", "size"))
        .unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("id"),
                                  F.lit(None).cast("long").alias("size")))
    )


def _marks(id: Column, depth: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a turn at its depth; the XOR of a sequence's marks names the sequence."""
    return F.xxhash64(id, depth), F.xxhash64(depth, id, F.lit(7))


def before(rows: DataFrame, key: list[str], index: str, values: dict[str, str], total, run: int = RUN) -> DataFrame:
    """Add, for each (name: source), the ``total`` of source over the key's rows of smaller ``index``; none: 0.

    A key's rows are cut into runs by index, each in a group of its own; runs after a key's first add what the
    runs before them hold, a row a run. So no group grows with a key.
    """
    cut = rows.withColumn("_run", F.expr(f"{index} div {run}"))
    inside = W.partitionBy(*key, "_run").orderBy(index).rowsBetween(W.unboundedPreceding, -1)
    ahead = W.partitionBy(*key).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    sums = cut.groupBy(*key, "_run").agg(*[total(s).alias(f"_t_{n}") for n, s in values.items()])
    later = sums.select(*key, "_run", *[total(f"_t_{n}").over(ahead).alias(f"_o_{n}") for n in values]).filter("_run > 0")
    zero = F.lit(0).cast("long")
    cut = cut.withColumns({f"_i_{n}": F.coalesce(total(s).over(inside), zero) for n, s in values.items()})
    joined = cut.join(later, [*key, "_run"], "left")
    both = {n: _plus(total, F.col(f"_i_{n}"), F.coalesce(f"_o_{n}", zero)) for n in values}
    return joined.withColumns(both).drop("_run", *[f"_{p}_{n}" for n in values for p in "io"])


def _plus(total, a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b) if total is F.bit_xor else a + b


def blocks_of(turns: DataFrame, width: int = BLOCK) -> DataFrame:
    """A row for each ``width`` turns of a conversation: ``block``, the prior block's node (``p1``, ``p2``), ``t0``.. .

    A turn column is (id, size), null after the end. The prior node is named by the XOR of the marks of all turns
    before the block, so it needs no join with the trie. Block 0 is there for conversations without turns too.
    """
    x1, x2 = _marks(F.col("id"), F.col("depth"))
    zero = F.lit(0).cast("long")
    at = F.struct("depth", F.struct("id", "size").alias("turn"))
    grouped = turns.withColumn("block", F.expr(f"greatest(depth - 1, 0) div {width}")).groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.when(F.col("depth") > 0, at))).alias("_t"),  # width turns at most
        F.bit_xor(F.when(F.col("depth") > 0, x1).otherwise(zero)).alias("_x1"),
        F.bit_xor(F.when(F.col("depth") > 0, x2).otherwise(zero)).alias("_x2"))
    prior = before(grouped, ["conv_id"], "block", {"p1": "_x1", "p2": "_x2"}, F.bit_xor)
    return prior.select("conv_id", "block", "p1", "p2", *[F.get("_t", F.lit(k))["turn"].alias(f"t{k}") for k in range(width)])


def rolled_up(blocks: DataFrame, aggregates: str, width: int = BLOCK) -> DataFrame:
    """All prefixes of all conversations at once: ROLLUP over the turn columns beside the prior block's node.

    Adds ``level``, the turn columns in use, by grouping_id. A block's empty prefix is the prior block's own node
    and stays only in block 0, as the root; prefixes past a conversation's end aren't prefixes and go.
    """
    columns = ", ".join(f"t{k}" for k in range(width))
    rolled = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, {columns}, {width} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({columns})", blocks=blocks)
    real = reduce(lambda c, k: c | ((F.col("level") == k + 1) & F.col(f"t{k}").isNotNull()), range(width),
                  (F.col("level") == 0) & (F.col("block") == 0))
    return rolled.filter(real)


def _names(width: int, drop_last: int) -> tuple[Column, Column]:
    """The node's name from its columns, or its parent's if ``drop_last`` is 1."""
    out = []
    for lane, prior in enumerate(("p1", "p2")):
        marks = [F.when(F.col("level") - drop_last > k, _marks(F.col(f"t{k}.id"), F.col("block") * width + k + 1)[lane]).otherwise(
            F.lit(0).cast("long")) for k in range(width)]
        out.append(reduce(lambda a, b: a.bitwiseXOR(b), marks, F.col(prior)))
    return out[0], out[1]


def prefix_trie(turns: DataFrame, width: int = BLOCK) -> DataFrame:
    """The trie of all prefixes of conversations, a row a node.

    ``turns`` has (``conv_id``, ``depth`` from 1 without gaps, ``id``, ``size``) and a row of depth 0 for every
    conversation, without turns or not. A node is a distinct sequence of the first d turns; its members are the
    conversations that start with it, d = 0 being the root of all.

    Returns ``conv_id`` (smallest member; with ``depth`` it names the node), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of its subtree, itself included),
    ``saved_tokens`` (over the subtree, members but one times the size of the node's last turn) and ``ends_sha256``
    (SHA-256 of the ids of the members that end there, ascending, decimal, comma-joined).

    How: one ROLLUP counts members of all prefixes; a second one adds up, over each node's members, what they own.
    A conversation owns the nodes whose smallest member it is, which are the last ones of its path; the owner's
    nodes above a node are taken off again. Partial sums run before each shuffle, so a prefix or whole conversation
    that a third of the rows share is one row a task. Long conversations go on in further blocks, at any length.

    Sequences are named by hashes (16 bytes of SHA-256 a turn, 128 bits a sequence), so equal rows are equal turns;
    ids must be non-null. An empty table gives no nodes, not even a root. Other input columns are not read.
    """
    spark = turns.sparkSession
    turns = stage(turns.select("conv_id", "depth", "id", "size"), "trie-turns")
    blocks = stage(blocks_of(turns, width), "trie-blocks")
    key, parent = _names(width, 0), _names(width, 1)
    size = F.coalesce(*[F.when(F.col("level") == k + 1, F.col(f"t{k}.size")) for k in range(width)], F.lit(0).cast("long"))
    nodes = stage(rolled_up(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id", width).select(
        "conv_id", (F.col("block") * width + F.col("level")).alias("depth"), key[0].alias("x1"), key[1].alias("x2"),
        parent[0].alias("y1"), parent[1].alias("y2"), "n_convs", ((F.col("n_convs") - 1) * size).alias("saved")), "trie-nodes")

    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("y1").alias("x1"), F.col("y2").alias("x2")).agg(
        F.count("*").alias("n_children"))
    nodes = stage(before(nodes, ["conv_id"], "depth", {"above": "saved"}, F.sum).join(kids, ["depth", "x1", "x2"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-counted")

    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("_saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("_leaves"))
    below = rolled_up(blocks.join(owned, "conv_id"), "min(conv_id) AS conv_id, sum(_saved) AS _all, sum(_leaves) AS n_leaves", width)
    below = below.select("conv_id", (F.col("block") * width + F.col("level")).alias("depth"), "_all", "n_leaves")

    ends = turns.groupBy("conv_id").agg(F.max("depth").alias("depth"), *[F.bit_xor(F.when(F.col("depth") > 0, m).otherwise(
        F.lit(0).cast("long"))).alias(f"x{n + 1}") for n, m in enumerate(_marks(F.col("id"), F.col("depth")))])
    listed = ends.groupBy("depth", "x1", "x2", F.shiftright("conv_id", CHUNK_BITS).alias("_chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("_ids"))
    ends = ordered_sha256(listed, ["depth", "x1", "x2"], ["_chunk"], "_ids", ",", "ends_sha256")

    return (
        with_parents(nodes).join(below, ["conv_id", "depth"]).join(ends, ["depth", "x1", "x2"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                (F.col("_all") - F.col("above")).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    )


def with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent_conv_id``. Children of the few parents that have very many are joined by broadcast.

    Fewer than ``HOT`` parents can have more than 1/HOT of all nodes as children; any other parent's children are
    few enough for one task.
    """
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("y1"), F.col("x2").alias("y2"),
                           F.col("conv_id").alias("_p"), F.col("n_children").alias("_kids"))
    bar = nodes.count() / HOT
    hot = F.broadcast(parents.filter(F.col("_kids") > bar).select("depth", "y1", "y2", F.col("_p").alias("_hot")))
    marked = nodes.join(hot, ["depth", "y1", "y2"], "left")
    rest = marked.filter("_hot is null").join(parents.filter(F.col("_kids") <= bar).drop("_kids"), ["depth", "y1", "y2"], "left")
    return rest.withColumn("parent_conv_id", F.col("_p")).drop("_p", "_hot", "y1", "y2").unionByName(
        marked.filter("_hot is not null").withColumn("parent_conv_id", F.col("_hot")).drop("_hot", "y1", "y2"))
