"""A trie of conversation prefixes, made by ROLLUP over positional columns of turn ids.

A conversation is cut into blocks of WIDTH turns; a block is one row with a column for each of its turns. ROLLUP over these
columns, beside the node at which the block begins, aggregates all prefixes at once; grouping_id says how many turns a prefix has
in its block. A block's beginning is the node where the block before ends, named by a fingerprint of the turns so far: the exclusive or of
128 bits for each turn and its position. As that needs no earlier result, blocks of all depths are rolled up together, however
long a conversation is.

Turn ids are half of a SHA-256 over role and text, so texts are never shuffled. A conversation's rows are dealt to ranges of
(conversation, turn) and placed by the counts of earlier ranges, and blocks are summed by runs first: no task holds a whole
conversation. Sums over a node's subtree come from its member conversations. A conversation owns the nodes of which it is the
smallest member; they are the rest of its path from where it leaves the paths of smaller ones. So a node is counted once, with
its owner, and a second ROLLUP adds up what each member owns.

Rows without a conversation id take no part. Turns are in the order of `turn`, null first; ties, and repeated rows, which all
count, are in the order of their turn ids. A null role or text is empty. No conversations make no nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Turns of a block, and blocks of a run.
WIDTH, RUN = 8, 1024
TURNS = tuple(f"t{k}" for k in range(1, WIDTH + 1))


def _said(role: Column, text: Column) -> Column:
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.struct(F.unhex(F.substring(digest, 1, 32)).alias("id"), F.length(text).cast("long").alias("chars"))


def turn_texts(turns: DataFrame) -> DataFrame:
    """(turn_id, role, text) of all different turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return turns.select(_said(role, text)["id"].alias("turn_id"), role.alias("role"), text.alias("text")).dropDuplicates(["turn_id"])


def placed(turns: DataFrame) -> DataFrame:
    """(conv_id, position, said) of conversation rows (conv_id, turn, role, text); position from 1, said the turn's id and length."""
    said = _said(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), "turn", said.alias("said"))
    rows = stored(rows.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "said").withColumn("part", F.spark_partition_id()), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "said"))
    return rows.join(counts.drop("n"), ["conv_id", "part"]).select("conv_id", (F.col("before") + within).alias("position"), "said")


def branched(turns: DataFrame, heads: Column, base: Column, most: int) -> DataFrame:
    """(conv_id, position, said): every conversation with its first `heads` turns replaced by those of conversation `base`.

    heads and base are expressions of conv_id; heads is `most` at most, and no more turns of a base are gathered. A base of fewer
    turns gives what it has, an absent one none. A conversation that is left without turns has one row of nulls."""
    rows = stored(placed(turns), "placed")
    first = rows.where(F.col("position") <= most).groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("position", "said"))).alias("first"))
    conversations = rows.select("conv_id").distinct().select("conv_id", heads.cast("int").alias("heads"), base.alias("base")).join(first, "base", "left")
    conversations = stored(conversations.select("conv_id", "heads", F.coalesce(F.slice("first", F.lit(1), F.col("heads")), F.array().cast(dict(first.dtypes)["first"])).alias("head")), "heads")
    given = conversations.select("conv_id", F.inline("head"))
    own = rows.join(conversations.select("conv_id", "heads", F.size("head").alias("taken")), "conv_id").where(F.col("position") > F.col("heads"))
    own = own.select("conv_id", (F.col("position") - F.col("heads") + F.col("taken")).alias("position"), "said")
    return given.unionByName(own).unionByName(conversations.select("conv_id", F.lit(None).cast("long").alias("position"), F.lit(None).cast(dict(own.dtypes)["said"]).alias("said")))


def _mark(turn: Column, position: Column, half: int) -> Column:
    """One of two 64-bit halves of what a turn at a position adds to a fingerprint; 0 without a turn."""
    return F.when(turn.isNotNull(), F.xxhash64(F.lit(half), turn["id"], position.cast("long"))).otherwise(F.lit(0).cast("long"))


def _blocks(rows: DataFrame) -> DataFrame:
    """A row for each block: its turns, the fingerprint and length before it, and the conversation's number of turns, length and end.

    Rows without a position only tell that there is a conversation; its first block stands for it if it has no turn."""
    at = F.coalesce(F.col("position"), F.lit(1)) - 1
    dealt = rows.select("conv_id", F.floor(at / WIDTH).cast("long").alias("block"), (at % WIDTH).alias("slot"), "said")
    turns = dealt.groupBy("conv_id", "block").agg(*(F.max(F.when(F.col("slot") == k, F.col("said"))).alias(t) for k, t in enumerate(TURNS)))
    position = lambda k: F.col("block") * WIDTH + k + 1
    joined = lambda half: _xor([_mark(F.col(t), position(k), half) for k, t in enumerate(TURNS)])
    count = sum((F.col(t).isNotNull().cast("long") for t in TURNS), F.lit(0).cast("long"))
    length = sum((F.coalesce(F.col(t)["chars"], F.lit(0)) for t in TURNS), F.lit(0).cast("long"))
    blocks = stored(turns.withColumns({"run": F.floor(F.col("block") / RUN), "lo": joined(1), "hi": joined(2), "n": count, "chars": length}), "blocks")
    summed = {"lo": F.bit_xor, "hi": F.bit_xor, "n": F.sum, "chars": F.sum}
    add = {"lo": F.Column.bitwiseXOR, "hi": F.Column.bitwiseXOR, "n": F.Column.__add__, "chars": F.Column.__add__}
    runs = blocks.groupBy("conv_id", "run").agg(*(f(c).alias(c) for c, f in summed.items()))
    all_runs, runs_before = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    runs = runs.select("conv_id", "run", *(F.coalesce(f(c).over(runs_before), zero).alias(f"run_{c}") for c, f in summed.items()), *(f(c).over(all_runs).alias(f"all_{c}") for c, f in summed.items()))
    before = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    out = blocks.join(runs, ["conv_id", "run"])
    return out.select("conv_id", "block", *TURNS, *(add[c](F.col(f"run_{c}"), F.coalesce(f(c).over(before), zero)).alias(f"from_{c}") for c, f in summed.items()), *(f"all_{c}" for c in summed))


def _xor(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseXOR(c)
    return out


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """The measures of every prefix, with its depth, fingerprint, last turn and length, and its parent's fingerprint and length."""
    sql = f"""
        select block, from_lo, from_hi, from_chars, {", ".join(TURNS)}, {WIDTH} - bit_count(grouping_id()) as level, {measures}
        from {{blocks}} group by block, from_lo, from_hi, from_chars, rollup({", ".join(TURNS)})"""
    nodes = blocks.sparkSession.sql(sql, blocks=blocks)
    here = sum((F.col(t).isNotNull().cast("int") for t in TURNS), F.lit(0))
    # a level without its turn belongs to conversations that have ended; where a block begins, the one before has the node
    nodes = nodes.where((here == F.col("level")) & ((F.col("level") > 0) | (F.col("block") == 0)))
    nodes = nodes.withColumns({"depth": F.col("block") * WIDTH + F.col("level"), "said": F.coalesce(*reversed(TURNS))})
    marks = {h: _xor([F.col(f"from_{h}"), *(_mark(F.col(t), F.col("block") * WIDTH + k + 1, half) for k, t in enumerate(TURNS))]) for half, h in ((1, "lo"), (2, "hi"))}
    nodes = nodes.withColumns(marks).withColumn("chars", F.col("from_chars") + sum((F.coalesce(F.col(t)["chars"], F.lit(0)) for t in TURNS), F.lit(0)))
    nodes = nodes.withColumns({f"up_{h}": F.col(h).bitwiseXOR(_mark(F.col("said"), F.col("depth"), half)) for half, h in ((1, "lo"), (2, "hi"))})
    return nodes.withColumn("up_chars", F.col("chars") - F.coalesce(F.col("said")["chars"], F.lit(0))).drop("block", "from_lo", "from_hi", "from_chars")


def prefix_trie(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of conversations (conv_id, position, said), as branched() gives them, and where each ends.

    Nodes: conv_id (the smallest member), depth, parent_conv_id, turn_id, n_convs, n_children, n_leaves, saved_chars, node. A
    conversation's end: (conv_id, node). saved_chars: over the subtree, the code points of each node's text for each member but one."""
    blocks = stored(_blocks(rows), "blocks")
    # who owns what: the smallest member, and whether anyone goes on
    first = _rolled(blocks, "min(conv_id) as owner, max(all_n) as longest").withColumn("depth", F.col("depth").cast("long"))
    owners = first.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("own_from"), F.min_by("up_chars", "depth").alias("own_after"), F.max_by((F.col("longest") == F.col("depth")).cast("int"), "depth").alias("own_leaf")
    )
    told = stored(blocks.join(owners, "conv_id", "left"), "owned")
    children = [f"count_if(own_from = block * {WIDTH} + {k + 1})" for k in range(WIDTH + 1)]
    nodes = _rolled(told, f"""count(*) as n_convs, min(struct(conv_id, own_after, all_n)) as owner, sum(all_chars) as total, sum(if(own_from is null, 0, all_chars - own_after)) as owned,
        sum(coalesce(own_leaf, 0)) as n_leaves, array({", ".join(children)}) as branches""")  # fmt: skip
    saved = F.col("total") - F.col("n_convs") * F.col("up_chars") - (F.col("owned") + F.col("owner.own_after") - F.col("up_chars"))
    node = F.struct("lo", "hi", "depth")
    nodes = stored(nodes.select(
        F.col("owner.conv_id").alias("conv_id"), "depth", F.col("said")["id"].alias("turn_id"), "n_convs",
        # members that leave the smallest one's path just here, and the smallest itself if it goes on
        (F.element_at("branches", F.col("level") + 1) + (F.col("owner.all_n") > F.col("depth")).cast("long")).alias("n_children"),
        "n_leaves", saved.alias("saved_chars"), node.alias("node"), F.struct(F.col("up_lo").alias("lo"), F.col("up_hi").alias("hi"), (F.col("depth") - 1).alias("depth")).alias("up"),
    ), "nodes")
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes.join(parents, "up", "left").select("conv_id", "depth", "parent_conv_id", "turn_id", "n_convs", "n_children", "n_leaves", "saved_chars", "node")
    ends = blocks.where("block = 0").select("conv_id", F.struct(F.col("all_lo").alias("lo"), F.col("all_hi").alias("hi"), F.col("all_n").alias("depth")).alias("node"))
    return linked, ends


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): digests of the ids of the conversations that end at a node, ascending, comma-joined.

    Ids are joined in runs of 1,024 values first; the runs of a node then stream through one task, sorted, as a digest asks for."""
    runs = ends.groupBy("node", F.shiftright("conv_id", 10).alias("run")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    rows = runs.select("node.*", "run", "ids").repartition("lo", "hi", "depth").sortWithinPartitions("lo", "hi", "depth", "run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [None, None]

        def packed(done):
            return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k, _ in done], pa.int64()) for i in range(3)), pa.array([d for _, d in done], pa.string())], names=["lo", "hi", "depth", "ends_sha256"])

        for batch in batches:
            done = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if held[0] == key:
                    held[1].update(b",")
                else:
                    if held[0] is not None:
                        done.append((held[0], held[1].hexdigest()))
                    held[:] = [key, hashlib.sha256()]
                held[1].update(ids.encode())
            yield packed(done)
        if held[0] is not None:
            yield packed([(held[0], held[1].hexdigest())])

    made = rows.mapInArrow(run, "lo long, hi long, depth long, ends_sha256 string")
    return made.select(F.struct("lo", "hi", "depth").alias("node"), "ends_sha256")
