"""A trie of conversation prefixes by fixed-length block hashing (operator 13).

1. ``number_turns``: each row's place in its conversation, counted in two levels (a running
   count over buckets of 64 turn numbers, a row number inside a bucket), so a conversation of
   very many turns is not sorted by one task. Only digests and lengths of texts move on.
2. ``rebuild``: every conversation gets the first turns of its hundred's first conversation and
   keeps its own turns after them.
3. ``cut``: blocks of ``BLOCK`` turns. A turn's digest is of its place, role and text; the
   digest of a prefix is the exclusive or of its turns' digests (128 bits), so block digests
   accumulate along a conversation without reading its turns again.
4. ``groups``: conversations with equal prefixes up to a block's end are one group, counted by
   a partial aggregate however many there are. Only where a group has siblings (other blocks
   after the same prefix) are turn boundaries refined: the group's few turns, not its
   conversations', are grouped by prefix. Elsewhere a block is a chain of nodes.
5. Sums over subtrees without a pass per level: a node's weight is laid on its smallest member,
   so a subtree's sum is the sum over its members, less what its own smallest member carries
   above it. These sums take the same route through groups and nodes as the counts.

Joins with one very common key (the root, a common opening) go through ``join_unique``. Ids of
conversations that end in a node are joined in chunks of 4,096 ids and hashed as a stream.

Defined cases: rows without conv_id belong to no conversation and take no part; null turns
come first; rows of one turn number are ordered by role, then by the MD5 of the text; repeated
rows are turns of their own; null role and text are empty; a rebuilt conversation without
turns is a member of the root only; extra columns are ignored; without conversations there are
no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import join_unique, stored

#: Turns of a block, conversations that share their first one's opening, most turns they share.
BLOCK, FAMILY, SHARED = 8, 100, 6
NODE = ["depth", "n1", "n2"]
GROUP = ["block", "p1", "p2", "q1", "q2"]


def number_turns(conversations: DataFrame) -> DataFrame:
    """Store conv_id, pos (from 1), c1, c2 (digest of role and text), chars."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = (conversations.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), F.md5(text).alias("mark"),
                    F.length(text).cast("long").alias("chars"))
            .withColumn("bucket", F.coalesce(F.shiftright("turn", 6), F.lit(-(1 << 60)))))
    before = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "role", "mark"))
    return stored(rows.withColumn("place", place).join(sizes, ["conv_id", "bucket"]).select(
        "conv_id", (F.col("place") + F.col("before")).alias("pos"), F.xxhash64(F.lit(1), "role", "mark").alias("c1"),
        F.xxhash64(F.lit(2), "mark", "role").alias("c2"), "chars"), "turns")


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, length; their turns: conv_id, pos, h1, h2, chars), rebuilt."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    of = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), shared_turns(F.col("conv_id")).alias("h"))
    base = sizes.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    k = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = stored(of.join(base, "base", "left").select(
        "conv_id", "base", "h", k.alias("k"), (k + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "convs")
    first = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv_id", "base")
    given = convs.select("conv_id", "base", "h").join(first, "base").filter("pos <= h").select("conv_id", "pos", "c1", "c2", "chars")
    own = turns.filter(F.col("pos") > shared_turns(F.col("conv_id")))
    own = join_unique(own, convs.select("conv_id", "h", "k"), ["conv_id"]).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "c1", "c2", "chars")
    return convs.select("conv_id", "length"), given.unionByName(own).select(
        "conv_id", "pos", F.xxhash64("pos", "c1").alias("h1"), F.xxhash64("pos", "c2").alias("h2"), "chars")


def cut(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Store conv_id, block, items (its turns), p1, p2 and q1, q2: digests of the prefixes
    before and with the block."""
    items = F.array_sort(F.collect_list(F.struct("pos", "h1", "h2", "chars")))
    blocks = (turns.withColumn("block", F.floor((F.col("pos") - 1) / block)).groupBy("conv_id", "block")
              .agg(items.alias("items"), F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2")))
    upto = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("q1", F.bit_xor("b1").over(upto)).withColumn("q2", F.bit_xor("b2").over(upto))
    return stored(blocks.select("conv_id", "block", "items", F.col("q1").bitwiseXOR(F.col("b1")).alias("p1"),
                                F.col("q2").bitwiseXOR(F.col("b2")).alias("p2"), "q1", "q2"), "blocks")


def nodes_of(groups: DataFrame, sums: list[str]) -> DataFrame:
    """The nodes inside the blocks of ``groups`` (GROUP, items, lone, conv_id, sums): depth, n1,
    n2, u1, u2 (the parent's digest), chars, conv_id, and ``sums`` added up. Groups without
    siblings are chains; only the others' turns are grouped by prefix."""
    prefix = F.expr("""transform(items, (x, i) -> struct(x.pos as depth, x.chars as chars, x.h1 as h1, x.h2 as h2,
        aggregate(slice(items, 1, i + 1), p1, (a, y) -> a ^ y.h1) as n1, aggregate(slice(items, 1, i + 1), p2, (a, y) -> a ^ y.h2) as n2))""")

    def expand(g: DataFrame) -> DataFrame:
        return g.select(F.explode(prefix).alias("x"), "conv_id", *sums).select(
            *[F.col(f"x.{c}").alias(c) for c in NODE], F.expr("x.n1 ^ x.h1").alias("u1"), F.expr("x.n2 ^ x.h2").alias("u2"),
            F.col("x.chars").alias("chars"), "conv_id", *sums)

    split = expand(groups.filter(~F.col("lone"))).groupBy(*NODE).agg(
        F.first("u1").alias("u1"), F.first("u2").alias("u2"), F.first("chars").alias("chars"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in sums])
    return expand(groups.filter("lone")).unionByName(split)


def ends(convs: DataFrame, blocks: DataFrame) -> DataFrame:
    """depth, n1, n2, ends_sha256 of the nodes in which conversations end."""
    last = blocks.select("conv_id", F.element_at("items", -1)["pos"].alias("depth"), F.col("q1").alias("n1"), F.col("q2").alias("n2"))
    zero = F.lit(0).cast("long")
    at = last.join(convs.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"], "left_semi").select(*NODE, "conv_id")
    at = at.unionByName(convs.filter("length = 0").select(F.lit(0).cast("long").alias("depth"), zero.alias("n1"), zero.alias("n2"), "conv_id"))
    chunks = at.groupBy(*NODE, F.shiftright("conv_id", 12).alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for b in batches:
            for *here, ids in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                if here == node:
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = here, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), r)) for r in done], schema)
            done = []
        if node:
            yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), (*node, state.hexdigest())))], schema)

    schema = pa.schema([*[(c, pa.int64()) for c in NODE], ("ends_sha256", pa.string())])
    return (chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
            .mapInArrow(run, "depth long, n1 long, n2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, chars (of its last text), n1 and n2 (its digest)."""
    convs, turns = rebuild(number_turns(conversations))
    blocks = cut(turns, block)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    grouped = stored(blocks.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                                F.first("items").alias("items")), "block-groups")
    siblings = grouped.groupBy("block", "p1", "p2").agg((F.count(F.lit(1)) == 1).alias("lone"))
    groups = stored(join_unique(grouped, siblings, ["block", "p1", "p2"]), "block-siblings")

    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        *[zero.alias(c) for c in (*NODE, "u1", "u2", "chars")], "conv_id", "n_convs")
    nodes = stored(nodes_of(groups, ["n_convs"]).unionByName(root), "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("n1"), F.col("u2").alias("n2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("u1"), F.col("n2").alias("u2"),
                           F.col("conv_id").alias("parent_conv_id"))
    named = join_unique(nodes.filter("depth > 0"), parents, ["depth", "u1", "u2"]).unionByName(
        nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    weighed = stored(named.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
                     .withColumn("weight", (F.col("n_convs") - 1) * F.col("chars")), "weighed")

    # What a conversation carries: the weights of the nodes whose smallest member it is, and
    # whether one of them is a leaf.
    carried = weighed.groupBy("conv_id").agg(F.sum("weight").alias("saved"), F.max(F.when(F.col("n_children") == 0, one).otherwise(zero)).alias("n_leaves"))
    carried = stored(carried.filter("saved > 0 or n_leaves > 0"), "carried")
    sums = (join_unique(blocks.select("conv_id", *GROUP), carried, ["conv_id"]).groupBy(*GROUP)
            .agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves")))
    below = nodes_of(groups.join(sums, GROUP), ["saved", "n_leaves"]).select(*NODE, "saved", "n_leaves")
    whole = carried.agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves")).select(
        *[zero.alias(c) for c in NODE], "saved", "n_leaves")
    above = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    out = (weighed.withColumn("above", F.coalesce(F.sum("weight").over(above), zero))
           .join(below.unionByName(whole), NODE, "left").join(ends(convs, blocks), NODE, "left"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
        (F.coalesce("saved", zero) - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "chars", "n1", "n2")


def digest(nodes: DataFrame) -> DataFrame:
    """The contract's columns of ``prefix_trie``'s result."""
    return nodes.drop("chars", "n1", "n2")


ORACLE = r"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  md5(coalesce(text, ''))) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
     k AS (SELECT c, pos, length(text) AS chars, dense_rank() OVER (ORDER BY role, text) AS id FROM t),
     s AS (SELECT c, c - c % 100 AS base, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
                  string_split(CAST(c AS VARCHAR), ''), lambda ch: [ascii(ch), 0, 0, 0, 0, 0, 0, 0]))),
                  lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), 4294967295) % 6 AS h FROM (SELECT DISTINCT c FROM k)),
     r AS (SELECT s.c, k.pos, k.id, k.chars FROM s JOIN k ON k.c = s.base AND k.pos <= s.h
           UNION ALL SELECT s.c, k.pos + 1000, k.id, k.chars FROM s JOIN k ON k.c = s.c AND k.pos > s.h),
     l AS (SELECT s.c, coalesce(list(r.id ORDER BY r.pos) FILTER (WHERE r.id IS NOT NULL), []) AS ids,
                  coalesce(list(r.chars ORDER BY r.pos) FILTER (WHERE r.id IS NOT NULL), []) AS chars FROM s LEFT JOIN r USING (c) GROUP BY s.c),
     m AS (SELECT c, len(ids) AS length, d, list_slice(ids, 1, d) AS p, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
           FROM (SELECT *, unnest(generate_series(0, len(ids))) AS d FROM l)),
     n AS (SELECT d, p, min(c) AS c, count(*) AS n_convs, any_value(chars) AS chars,
                  string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE length = d) AS ends FROM m GROUP BY d, p),
     ch AS (SELECT a.d, a.p, count(b.d) AS n_children FROM n a LEFT JOIN n b ON b.d = a.d + 1 AND list_slice(b.p, 1, a.d) = a.p GROUP BY a.d, a.p),
     v AS (SELECT n.*, n_children FROM n JOIN ch USING (d, p)),
     sub AS (SELECT a.d, a.p, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.chars) AS saved
             FROM v a JOIN v b ON b.d >= a.d AND list_slice(b.p, 1, a.d) = a.p GROUP BY a.d, a.p)
SELECT v.c AS conv_id, v.d AS depth, up.c AS parent_conv_id, v.n_convs, v.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN sub USING (d, p) LEFT JOIN v up ON up.d = v.d - 1 AND up.p = list_slice(v.p, 1, v.d - 1)
"""
