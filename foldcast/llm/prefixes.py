"""The trie of conversation prefixes: ROLLUP over blocks of positional turn-id columns, each block keyed by the node before it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.llm.common import picked, spread_join, stored

#: Turn-id columns of a block; a longer conversation goes on in further blocks.
BLOCK = 4
#: Turns that a window works through together (a multiple of BLOCK); a longer conversation is several stretches.
STRETCH = 1024
#: Turns that a conversation may share with its base, and how many conversations have one base.
SHARED_TURNS = 4
FAMILY = 20
#: Conversation ids whose decimal numbers are written together, as a power of two.
CHUNK_BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def ordered_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, pos (from 1), a and b (hashes of role and text) and words of every turn; texts are left behind at once.

    A turn's place is counted within a stretch of turn numbers, then moved by the turns of earlier stretches, so a
    conversation of any length is spread over tasks.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    said = picked(conversations, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text").where("conv is not null")
    said = said.withColumns({"conv": F.col("conv").cast("bigint"), "turn": F.col("turn").cast("bigint")})
    ids = said.select(
        "conv", "turn", F.shiftright("turn", 10).alias("part"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORD)).alias("words"))
    ids = stored(ids, "turns")
    inside = Window.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    earlier = Window.partitionBy("conv").orderBy(F.col("part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    parts = ids.groupBy("conv", "part").agg(F.count("*").alias("n")).select(F.col("conv").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = ids.withColumn("inside", F.row_number().over(inside))
    moved = placed.join(parts, (F.col("conv") == F.col("c")) & F.col("part").eqNullSafe(F.col("p")))
    return moved.select("conv", (F.col("inside") + F.col("before")).alias("pos"), "a", "b", "words")


def stretch(pos: Column) -> Column:
    return F.floor((pos - 1) / STRETCH).cast("bigint")


def _dealt(per_conversation: DataFrame, turns: Column) -> DataFrame:
    """Rows of single conversations copied to each stretch of theirs, to meet the stretch's turns there."""
    return per_conversation.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("bigint"), stretch(F.greatest(turns, F.lit(1))))))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the first turns of their base in place of their own: (conv, len), and (conv, pos, a, b, words).

    The base of c is c - c % FAMILY, and the number of turns is crc32 of c in decimals, modulo SHARED_TURNS.
    """
    own = turns.groupBy("conv").agg(F.count("*").alias("n"))
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < SHARED_TURNS)).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("heads"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED_TURNS
    plan = own.select("conv", "n", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), h.alias("h")).join(heads.withColumnRenamed("conv", "base"), "base", "left")
    plan = plan.withColumn("lead", F.least("h", F.coalesce(F.size("heads"), F.lit(0))))
    plan = stored(plan.select("conv", "n", "h", "lead", F.slice("heads", F.lit(1), F.col("lead").cast("int")).alias("heads")), "plans")
    rest = turns.withColumn("stretch", stretch(F.col("pos"))).join(_dealt(plan.select("conv", "n", "h", "lead"), F.col("n")), ["conv", "stretch"])
    kept = rest.where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "a", "b", "words")
    given = plan.select("conv", F.explode("heads").alias("x")).select("conv", F.col("x.pos").cast("bigint").alias("pos"), "x.a", "x.b", "x.words")
    sizes = plan.select("conv", (F.col("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    return sizes, kept.unionByName(given)


def _mark(pos: Column, a: Column, b: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), pos.cast("bigint"), a, b)


def blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and BLOCK turns: conv, first (position), the node before (x, y, said) and t1 .. tBLOCK.

    A node is known by the bits of its turns' hashes, each mixed with its position: two 64-bit words. `said` is the
    number of words up to it. Both run through a stretch, and are moved by what earlier stretches come to.
    """
    here = turns.withColumns({"stretch": stretch(F.col("pos")), "mx": _mark(F.col("pos"), F.col("a"), F.col("b"), 1), "my": _mark(F.col("pos"), F.col("a"), F.col("b"), 2)})
    ordered = Window.partitionBy("conv", "stretch").orderBy("pos")
    before, earlier = ordered.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    turn = F.struct("a", "b", "words")
    cut = here.select(
        "conv", "stretch", "pos", F.bit_xor("mx").over(before).alias("ix"), F.bit_xor("my").over(before).alias("iy"), F.sum("words").over(before).alias("is"),
        *(F.lead(turn, k).over(ordered).alias(f"t{k + 1}") if k else turn.alias("t1") for k in range(BLOCK))).where((F.col("pos") - 1) % BLOCK == 0)
    whole = here.groupBy("conv", "stretch").agg(F.bit_xor("mx").alias("ox"), F.bit_xor("my").alias("oy"), F.sum("words").alias("os"))
    whole = whole.select("conv", "stretch", *(F.coalesce(f(name).over(earlier), F.lit(0)).alias(name) for name, f in (("ox", F.bit_xor), ("oy", F.bit_xor), ("os", F.sum))))
    none = F.lit(0).cast("bigint")
    moved = cut.join(whole, ["conv", "stretch"]).withColumns({k: F.coalesce(k, none) for k in ("ix", "iy", "is")})
    return moved.select(
        "conv", "stretch", F.col("pos").alias("first"), F.col("ix").bitwiseXOR(F.col("ox")).alias("x"), F.col("iy").bitwiseXOR(F.col("oy")).alias("y"), (F.col("is") + F.col("os")).alias("said"),
        *(f"t{k + 1}" for k in range(BLOCK)))


def roll_up(rows: DataFrame, sums: str) -> DataFrame:
    """Every prefix within every block, all aggregated together: depth, x, y, said (words up to it), last (its turn), and sums.

    A prefix that ends in a column without a turn is no node; nor is an empty one, but for that of the first block.
    """
    names = ", ".join(f"t{k + 1}" for k in range(BLOCK))
    found = rows.sparkSession.sql(f"SELECT first, x, y, said, {names}, grouping_id() AS without, {sums} FROM {{rows}} GROUP BY first, x, y, said, ROLLUP({names})", rows=rows)
    level = F.lit(BLOCK)
    for k in range(BLOCK):
        level = F.when(F.col("without") == (1 << (BLOCK - k)) - 1, k).otherwise(level)
    found = found.withColumn("level", level).withColumn("turns", F.array(*(f"t{k + 1}" for k in range(BLOCK)))).withColumn("last", F.get("turns", F.col("level") - 1))
    found = found.where(F.col("last").isNotNull() | ((F.col("level") == 0) & (F.col("first") == 1)))
    x, y, said = F.col("x"), F.col("y"), F.col("said")
    for k in range(BLOCK):
        t, pos = F.col(f"t{k + 1}"), F.col("first") + k
        live = t.isNotNull() & (F.col("level") > k)
        x = F.when(live, x.bitwiseXOR(_mark(pos, t["a"], t["b"], 1))).otherwise(x)
        y = F.when(live, y.bitwiseXOR(_mark(pos, t["a"], t["b"], 2))).otherwise(y)
        said = F.when(live, said + t["words"]).otherwise(said)
    found = found.withColumns({"x": x, "y": y, "said": said, "depth": F.col("first") - 1 + F.col("level")})
    return found.drop("first", "without", "level", "turns", *(f"t{k + 1}" for k in range(BLOCK)))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of each node, whose chunks come one after the other in ascending order."""
    node, running, done = None, None, []
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("ends", pa.string())])
    for batch in batches:
        for x, y, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (x, y) != node:
                if node is not None:
                    done.append({"x": node[0], "y": node[1], "ends": running.hexdigest()})
                node, running = (x, y), hashlib.sha256(listed.encode())
            else:
                running.update(b"," + listed.encode())
        if len(done) > 10_000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if node is not None:
        done.append({"x": node[0], "y": node[1], "ends": running.hexdigest()})
    yield pa.RecordBatch.from_pylist(done, schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """x, y and the SHA-256 of the comma-joined conv ids, ascending, of the conversations that end at each node.

    Neighbouring ids become one string before they meet, so the one task that a digest needs reads strings in order.
    """
    chunk = F.shiftright("conv", CHUNK_BITS)
    texts = ends.groupBy("x", "y", chunk.alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("listed"))
    return texts.repartition("x", "y").sortWithinPartitions("x", "y", "chunk").select("x", "y", "listed").mapInArrow(_digest, "x bigint, y bigint, ends string")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    Turns stand in the order of their number, null first; turns of one number in that of their hashes, so that repeated
    rows count as turns of their own. A null role or text is empty; rows with a null conversation are left out; an empty
    table has no node, not even a root; other columns are ignored.

    One ROLLUP over all blocks gives each node's smallest member and their number. A node belongs to that member, so a
    conversation owns the end of its path, from where it leaves the path of a smaller one. What a subtree sums is then
    the sum over its members of what each owns or shares: a second ROLLUP, over the shared turns alone. No step goes
    level by level, so neither the number of jobs nor that of rows depends on how deep the trie is.
    """
    sizes, turns = rebuilt(stored(ordered_turns(conversations, conv_col, turn_col, role_col, text_col), "ordered"))
    rows = stored(blocks(turns), "blocks")
    none, no_turn = F.lit(0).cast("bigint"), F.lit(None).cast("struct<a:bigint,b:bigint,words:int>")
    width = sizes.join(turns.groupBy("conv").agg(F.sum("words").alias("said")), "conv", "left")
    width = stored(width.select("conv", "len", F.coalesce("said", none).alias("said")), "sizes")
    turnless = width.where("len = 0").select("conv", none.alias("stretch"), F.lit(1).cast("bigint").alias("first"), *(none.alias(k) for k in ("x", "y", "said")), *(no_turn.alias(f"t{k + 1}") for k in range(BLOCK)))
    every = rows.unionByName(turnless).join(_dealt(width.select("conv", "len"), F.col("len")), ["conv", "stretch"])
    nodes = roll_up(every, "min(conv) AS owner, count(*) AS n_convs, max(len) AS reach")
    nodes = stored(nodes.select("x", "y", "said", "depth", F.coalesce("last.words", F.lit(0)).alias("words"), "owner", "n_convs", "reach"), "nodes")

    # a conversation shares its first `shared` turns, of `held` words, with smaller ones, and owns the others
    owned = nodes.groupBy(F.col("owner").alias("conv")).agg(F.count_if(F.col("depth") > 0).alias("owned"), F.sum("words").alias("owned_words"), F.max((F.col("reach") == F.col("depth")).cast("bigint")).alias("leaf"))
    known = width.join(owned, "conv", "left").select("conv", "len", (F.col("len") - F.coalesce("owned", none)).alias("shared"), (F.col("said") - F.coalesce("owned_words", none)).alias("held"), F.coalesce("leaf", none).alias("leaf"))
    known = stored(known, "known")
    root = known.agg(F.min("conv").alias("owner"), F.sum("held").alias("held"), F.sum("leaf").alias("leaves")).first()
    common = rows.join(_dealt(known.where("shared > 0").drop("len"), F.col("shared")), ["conv", "stretch"]).where("first <= shared")
    common = common.withColumns({f"t{k + 1}": F.when(F.col("first") + k <= F.col("shared"), F.col(f"t{k + 1}")) for k in range(BLOCK)})
    joint = roll_up(common, "count(*) AS n, sum(held) AS held, sum(leaf) AS leaves").where("depth > 0").select("x", "y", "n", "held", "leaves")

    ends = end_digests(_node_at(rows, known, "len").select("x", "y", "conv"))
    leaving = stored(_node_at(rows, known.where("len > shared"), "shared"), "leaving")
    branches = leaving.groupBy("x", "y").agg(F.count("*").alias("branches"))
    parents = spread_join(leaving, nodes.select("x", "y", F.col("owner").alias("parent")), ["x", "y"], F.col("conv")).select(F.col("conv").alias("owner"), "parent")
    info = known.select(F.col("conv").alias("owner"), "len", "shared", "leaf").join(parents, "owner", "left")

    depth, top = F.col("depth"), F.col("depth") == 0
    found = nodes.join(joint, ["x", "y"], "left").join(branches, ["x", "y"], "left").join(ends, ["x", "y"], "left")
    found = found.withColumn("stretch", stretch(F.greatest(depth, F.lit(1)))).join(_dealt(info, F.col("len")), ["owner", "stretch"])
    branches, shared_by = F.coalesce("branches", none), F.coalesce("n", none)
    return found.select(
        F.col("owner").alias(conv_col),
        depth.cast("bigint").alias("depth"),
        F.when(top, F.lit(None)).when(depth > F.col("shared") + 1, F.col("owner")).otherwise(F.col("parent")).cast("bigint").alias("parent_" + conv_col),
        F.col("n_convs").cast("bigint").alias("n_convs"),
        F.when(top, branches).otherwise(branches + (F.col("len") > depth).cast("bigint")).alias("n_children"),
        F.when(top, F.lit(root["leaves"])).otherwise(F.coalesce("leaves", none) + F.col("leaf")).cast("bigint").alias("n_leaves"),
        F.when(top, F.lit(root["held"])).otherwise(F.coalesce("held", none) - shared_by * (F.col("said") - F.col("words"))).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _node_at(rows: DataFrame, known: DataFrame, depth: str) -> DataFrame:
    """conv, x and y of the node that each conversation passes at a depth (the name of a column)."""
    at = F.col(depth)
    wanted = known.select("conv", at.alias("at"), stretch(F.greatest(at, F.lit(1))).alias("stretch"))
    found = rows.join(wanted.where("at > 0"), ["conv", "stretch"]).where((F.col("first") <= F.col("at")) & (F.col("at") < F.col("first") + BLOCK))
    x, y = F.col("x"), F.col("y")
    for k in range(BLOCK):
        t, pos, live = F.col(f"t{k + 1}"), F.col("first") + k, F.col("first") + k <= F.col("at")
        x = F.when(live, x.bitwiseXOR(_mark(pos, t["a"], t["b"], 1))).otherwise(x)
        y = F.when(live, y.bitwiseXOR(_mark(pos, t["a"], t["b"], 2))).otherwise(y)
    none = F.lit(0).cast("bigint")
    return found.select("conv", x.alias("x"), y.alias("y")).unionByName(wanted.where("at = 0").select("conv", none.alias("x"), none.alias("y")))
