"""Hierarchical weighted hash tree: documents descend region, rack and shard levels by weighted hash draws."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import expand_copies, free_name, id_key, uniform52, written

#: shard -> weight below rack below region
Tree = dict[str, dict[str, dict[int, float]]]


def shard_tree(n_shards: int, base: int = 40, racks: int = 2, per_rack: int = 5) -> Tree:
    """The tree of ``n_shards`` equal shards: ``base`` of them in regions of ``racks`` x ``per_rack``.

    Each shard beyond ``base`` opens a region of its own. No older weight changes then, so the new shard takes
    rows only into itself.
    """
    tree: Tree = {}
    for s in range(min(n_shards, base)):
        region, rack = divmod(s // per_rack, racks)
        tree.setdefault(f"r{region}", {}).setdefault(f"r{region}.k{rack}", {})[s] = 1.0
    for s in range(base, n_shards):
        tree[f"own{s}"] = {f"own{s}.k0": {s: 1.0}}
    return tree


def _nodes(tree: Tree) -> tuple[list[list[tuple[int, str, float]]], int]:
    """Children (node, name, weight) of each inner node, node 0 the root; and the number of inner nodes.

    A leaf is numbered by inner nodes + shard.
    """
    inner = 1 + len(tree) + sum(len(racks) for racks in tree.values())
    children: list[list[tuple[int, str, float]]] = [[] for _ in range(inner)]
    at = 1
    for region, racks in tree.items():
        here, at = at, at + 1
        children[0].append((here, region, sum(w for shards in racks.values() for w in shards.values())))
        for rack, shards in racks.items():
            children[here].append((at, rack, sum(shards.values())))
            children[at] = [(inner + s, f"s{s}", w) for s, w in shards.items()]
            at += 1
    return children, inner


def tree_shard(key: Column, tree: Tree, seed: str = "shard") -> Column:
    """The shard (int) that ``key`` descends to.

    At each of the three levels a child of weight w draws ln(u) / w from the hash of (key, child name) and the
    largest draw wins: children win in proportion to their weights, and a changed weight moves keys only to or
    from that child's subtree. Children of weight 0 get nothing.
    """
    children, inner = _nodes(tree)
    kids = [[c for c in some if c[2] > 0] for some in children]
    if not kids[0]:
        raise ValueError("the tree has no shard of positive weight")
    table = F.array(*[
        F.array(*[F.struct(F.lit(n).alias("n"), F.lit(name).alias("name"), F.lit(float(w)).alias("w"))
                  for n, name, w in (some or [(-1, "", 1.0)])]) for some in kids])

    def down(node: Column) -> Column:
        def draw(c: Column) -> Column:
            u = (uniform52(seed, key, c["name"]) + F.lit(0.5)) / F.lit(float(1 << 52))
            return F.struct((F.log(u) / c["w"]).alias("x"), c["n"].alias("n"))
        return F.array_max(F.transform(F.get(table, node), draw))["n"]

    return (down(down(down(F.lit(0)))) - F.lit(inner)).cast("int")


def numbered(df: DataFrame, group: str, order: list[str], rows_per_bucket: int = 8192) -> DataFrame:
    """``df`` with ``slot``: gapless from 0 in each group, in the order of the long ``order[0]`` in [0, 2^52), then the others.

    ``order[0]`` is cut into ranges small enough for a task; rows are counted in a range and the ranges added
    up. Equal rows are folded to a count first, so no group of copies meets in one task.
    """
    cols = df.columns
    copies, bucket, rows_, start, ahead, i = (free_name(df, x) for x in ("copies", "bucket", "rows", "start", "ahead", "i"))
    folded = written(df.groupBy(*cols).agg(F.count("*").alias(copies)), "numbered")
    rows, most, groups = folded.agg(F.sum(copies), F.max(copies), F.approx_count_distinct(group)).first()
    rows, most, groups = rows or 0, most or 0, max(1, groups)
    bits = max(4, min(40, math.ceil(math.log2(max(1.0, rows / groups / rows_per_bucket)))))
    cut = folded.withColumn(bucket, F.shiftright(order[0], 52 - bits))
    sizes = cut.groupBy(group, bucket).agg(F.sum(copies).alias(rows_))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sizes.select(group, bucket, F.coalesce(F.sum(rows_).over(before), F.lit(0)).alias(start)), "starts")
    inside = Window.partitionBy(group, bucket).orderBy(*order, *[c for c in cols if c not in order]).rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = cut.withColumn(ahead, F.coalesce(F.sum(copies).over(inside), F.lit(0)))
    ranked = ranked.join(starts, [group, bucket])
    out = expand_copies(ranked, copies, i, most)
    return out.select(*cols, (F.col(start) + F.col(ahead) + F.col(i)).cast("long").alias("slot"))


def slot_place(seed: str, doc_id: Column, text: Column) -> Column:
    """Where a row stands in its shard: a hash of id and text, so that the rows of a repeated or null id spread over all ranges."""
    t = F.coalesce(text, F.lit(""))
    return uniform52(seed, id_key(doc_id), "order", F.octet_length(t), F.crc32(F.encode(t, "UTF-8")))


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id",
                    text_col: str = "text", seed: str = "shard") -> DataFrame:
    """Places every row of ``docs`` by the ``key`` law: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The id and the tree alone decide. size: UTF-8 bytes of the text plus 16 (a null text: 16, and the CRC-32 of
    no bytes, 0). slot: gapless from 0 in each shard, in the order of a hash of id and text. grown_shard: the place
    under the tree ``grown``, or null. A null id is a key of its own; rows with equal ids share a shard and get
    slots of their own; an empty table gives an empty result; other columns of ``docs`` aren't read.
    """
    key, text = id_key(F.col(id_col)), F.coalesce(F.col(text_col), F.lit(""))
    placed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        tree_shard(key, tree, seed).alias("shard"),
        (tree_shard(key, grown, seed) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        slot_place(seed, F.col(id_col), F.col(text_col)).alias("h"))
    out = numbered(placed, "shard", ["h", "doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


SHARDS = 40


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_documents(docs, shard_tree(SHARDS), shard_tree(SHARDS + 1))


def _draw_sql(name: str, weight: float) -> str:
    return f"ln((CAST('0x' || substr(md5('shard|' || k || '|{name}'), 1, 13) AS BIGINT) + 0.5) / {float(1 << 52)!r}) / {float(weight)!r}"


def _shard_sql(tree: Tree) -> str:
    """The shard of the key text ``k``: at each level the child with the largest draw."""
    def level(children: list[tuple[str, float, str]]) -> str:
        draws = ", ".join(_draw_sql(name, w) for name, w, _ in children)
        if len(children) == 1:
            return children[0][2]
        return f"CASE list_position([{draws}], greatest({draws})) " + " ".join(
            f"WHEN {i + 1} THEN {then}" for i, (_, _, then) in enumerate(children)) + " END"
    return level([(region, sum(w for s in racks.values() for w in s.values()),
                   level([(rack, sum(s.values()), level([(f"s{n}", w, str(n)) for n, w in s.items()])) for rack, s in racks.items()]))
                  for region, racks in tree.items()])


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


SQL = f"""
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b, coalesce('v' || CAST(doc_id AS VARCHAR), 'n') AS k FROM documents),
c AS (SELECT {_crc_table()} AS crc),
p AS (
  SELECT doc_id, octet_length(b) + 16 AS size, k, CAST({_shard_sql(shard_tree(SHARDS))} AS INTEGER) AS shard,
         CAST({_shard_sql(shard_tree(SHARDS + 1))} AS INTEGER) AS grown_shard,
         xor(list_reduce(list_transform(regexp_extract_all(hex(b), '..'), lambda x: CAST('0x' || x AS BIGINT)),
                         lambda a, x: xor(a >> 8, crc[CAST((xor(a, x) & 255) + 1 AS INTEGER)]), 4294967295), 4294967295) AS text_crc32
  FROM t, c),
q AS (SELECT *, CAST('0x' || substr(md5('shard|' || k || '|order|' || (size - 16) || '|' || text_crc32), 1, 13) AS BIGINT) AS h FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM q
"""
