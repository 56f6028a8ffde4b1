"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree over source blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import expand_copies, free_name, id_key, uniform52, written

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_REPEAT = 2.0
#: Documents of a block, and the most blocks of a source: a block stays small and so does a source's list.
BLOCK_ROWS, MAX_BLOCKS = 256, 65536
OUTPUT_SHARDS = 16
#: Rows of a part of the block that a target falls into, whose documents are fitted one by one.
PART_ROWS = 1024
#: A node of the splitting tree is a row with a number per source; more sources raise.
MAX_SOURCES = 4096
SCALE = float(1 << 52)


def words(text: Column) -> Column:
    """Number of runs of bytes other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``budget`` of all sizes. A target
    stops at ``max_repeat`` times its source's size and the excess is shared again by weight among the others:
    in the order of size / weight the first k sources stop, and the rest get equal shares per weight, k being
    the smallest number for which none of the rest is above its limit.
    """
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]),
                   ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead, rest = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(budget))
                               - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0))) / F.sum("weight").over(rest))
    s = s.withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight"))
    s = s.withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
    return s.withColumn("target", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), "cap")).drop("cap", "level", "fits")


def _ln_factorials(start: str, *terms: tuple[int, str]) -> str:
    """SQL: ``start`` and the signed sum of ln n! of the terms (sign, n), by Stirling's series carried eight further up for small n.

    The series stands in the plan once, however many terms there are.
    """
    up = " * ".join(f"(e.n + {i})" for i in range(1, 9))
    m = "(e.n + 8)"
    series = (f"{m} * ln({m}) - {m} + ln({2 * math.pi!r}D * {m}) / 2 + 1 / (12 * {m}) - 1 / (360 * pow({m}, 3)) + 1 / (1260 * pow({m}, 5)) - ln({up})")
    each = ", ".join(f"named_struct('sign', {sign}D, 'n', CAST({n} AS DOUBLE))" for sign, n in terms)
    return f"aggregate(array({each}), {start}, (t, e) -> t + e.sign * ({series}))"


def _drawn(total: str, marked: str, n: str, u: str) -> str:
    """SQL: how many of ``marked`` among ``total`` fall into a draw of ``n`` without replacement, for a uniform u.

    The smallest k at which the hypergeometric distribution reaches u; the sum runs over all k that can be.
    """
    low, high = f"greatest(0L, {n} + {marked} - {total})", f"least({n}, {marked})"
    base = _ln_factorials("0D", (1, marked), (1, f"{total} - {marked}"), (1, n), (1, f"{total} - {n}"), (-1, total))
    p = _ln_factorials("d.base", (-1, "c"), (-1, f"{marked} - c"), (-1, f"{n} - c"), (-1, f"{total} - {marked} - {n} + c"))
    return (f"aggregate(sequence({low}, {high}), named_struct('sum', 0D, 'k', {low}, 'base', {base}), "
            f"(d, c) -> CASE WHEN d.sum >= {u} THEN d ELSE named_struct('sum', d.sum + exp({p}), 'k', c, 'base', d.base) END).k")


def split_quotas(quotas: DataFrame, shards: int, seed: str = "mix") -> DataFrame:
    """Splits block quotas (key, quota) among ``shards``: (key, shard, first, last), ranges of draws 0 up.

    A binary tree: a node's blocks are dealt between its halves by a multivariate hypergeometric draw, that is one
    source after the other by the hypergeometric draw that is left. Sums stay exact at each node. Each level is a
    projection over its nodes; a node holds one number per source (``MAX_SOURCES`` at most), never blocks or rows.
    """
    node = quotas.agg(F.sort_array(F.collect_list(F.struct("key", "quota"))).alias("q")).select(
        F.col("q.key").alias("keys"), F.col("q.quota").alias("k"), F.lit(0).alias("low"), F.lit(shards).alias("high"))
    u = f"((CAST(conv(substring(md5(CAST(concat_ws('|', {seed!r}, 'split', low, high, get(keys, i)) AS BINARY)), 1, 13), 16, 10) AS BIGINT) + 0.5D) / {SCALE!r}D)"
    deal = (f"aggregate(sequence(0, size(k) - 1), named_struct('total', total, 'n', to_left, 'out', CAST(array() AS ARRAY<BIGINT>)), (s, i) -> "
            f"transform(array({_drawn('s.total', 'get(k, i)', 's.n', u)}), "
            f"x -> named_struct('total', s.total - get(k, i), 'n', s.n - x, 'out', concat(s.out, array(x))))[0]).out")
    for _ in range(max(0, math.ceil(math.log2(shards)))):
        node = node.selectExpr("keys", "k", "low", "high", "CAST(floor((low + high) / 2) AS INT) AS half", "aggregate(k, 0L, (a, x) -> a + x) AS total")
        node = node.selectExpr("*", "CAST(floor(total * (half - low) / (high - low)) AS BIGINT) AS to_left")
        node = node.selectExpr("keys", "k", "low", "high", "half", f"CASE WHEN high - low > 1 AND size(k) > 0 THEN {deal} ELSE k END AS l")
        node = node.selectExpr("keys", """explode(CASE WHEN high - low > 1 THEN array(
            named_struct('k', l, 'low', low, 'high', half), named_struct('k', transform(k, (x, i) -> x - get(l, i)), 'low', half, 'high', high))
            ELSE array(named_struct('k', k, 'low', low, 'high', high)) END) AS s""").select("keys", "s.k", "s.low", "s.high")
    leaf = node.select(F.col("low").alias("shard"), F.posexplode(F.arrays_zip("keys", "k")).alias("i", "z")).select(
        "shard", F.col("z.keys").alias("key"), F.col("z.k").alias("n"))
    upto = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return leaf.withColumn("end", F.sum("n").over(upto)).filter("n > 0").select(
        "key", "shard", (F.col("end") - F.col("n")).alias("first"), (F.col("end") - 1).alias("last"))


def _filled(need: Column, docs: Column) -> Column:
    """Copies taken of each document of a block: in the permuted order those that fit into ``need`` words, and then one
    more, the closest to what is still missing, if that comes nearer to ``need``."""
    def more(state: Column, d: Column) -> Column:
        fit = F.when(d["size"] > 0, F.least(d["copies"], F.floor(state["need"] / d["size"]).cast("long"))).otherwise(d["copies"])
        return F.struct((state["need"] - fit * d["size"]).alias("need"),
                        F.concat(state["out"], F.array(fit)).alias("out"))

    def last(state: Column) -> Column:
        miss = F.transform(docs, lambda d, i: F.when(
            (F.get(state["out"], i) < d["copies"]) & (F.abs(state["need"] - d["size"]) < state["need"]),
            F.struct(F.abs(state["need"] - d["size"]).alias("by"), i.alias("i"))))
        best = F.array_min(miss)["i"]
        return F.transform(state["out"], lambda n, i: n + F.when(i == best, 1).otherwise(0).cast("long"))

    start = F.struct(need.alias("need"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(docs, start, more, last)


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> list[Column]:
    """key of the source, doc (the id's text), size, and h: the place in the source's permutation, from the id and the text."""
    return [id_key(F.col(source_col)).alias("key"), id_key(F.col(id_col)).alias("doc"), words(F.col(text_col)).alias("size"),
            uniform52(seed, id_key(F.col(id_col)), F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("n"))).alias("h")]


#: What names a document in the tables of a mix.
DOCUMENT = ["key", "doc", "size", "h"]


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: float = MAX_REPEAT,
             shards: int = OUTPUT_SHARDS, seed: str = "mix") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sources, draws) of the mix, as written tables.

    documents: doc_id, source, key, doc, size, h, copies, one row for each distinct document and how often it is there.
    sources: source, key, source_size, weight, target. draws: key, doc, size, h and the list ``draws`` of (pass, shard, n): the
    copies of a document that the mix takes in a pass over its source, and the output shard that they go to.

    A source's documents are permuted by a hash and cut into blocks; its blocks are permuted again. Whole passes
    take every block; the last pass takes blocks in their order up to the target, and of the block that the target
    falls into the documents that bring the sum near it. The quota of blocks is split among the output shards by
    ``split_quotas``, and each shard draws as many of the next blocks of each source's order as its quota has, so that no two
    shards get the same. More than ``MAX_SOURCES`` sources raise ValueError.
    """
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               *_keyed(docs, id_col, text_col, source_col, seed)).groupBy("doc_id", "source", *DOCUMENT).agg(
        F.count("*").alias("copies")), "mix-documents")
    sums = written(rows.groupBy("source", "key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                                     F.sum("copies").alias("rows")), "mix-sizes")
    if (found := sums.count()) > MAX_SOURCES:
        raise ValueError(f"{found} sources; a mix has {MAX_SOURCES} at most")
    s = source_targets(sums, weights, budget, max_repeat)
    s = s.withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    s = s.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
    s = s.withColumn("blocks", F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("rows") / BLOCK_ROWS))).cast("long"))
    sources = written(s, "mix-sources")

    part = sources.select("key", "full", "rest", "blocks")
    place = F.col("h") / F.lit(SCALE) * F.col("blocks")
    cut = rows.join(part, "key").withColumn("block", F.floor(place).cast("long"))
    blocks = cut.groupBy("key", "block", "full", "rest").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.sum("copies").alias("rows"))
    order = Window.partitionBy("key").orderBy(uniform52(seed, "block", F.col("key"), F.col("block")), "block")
    blocks = blocks.withColumn("place", (F.row_number().over(order) - 1).cast("long")).withColumn(
        "before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    there = F.count("*").over(Window.partitionBy("key"))
    blocks = written(blocks.withColumn("there", there), "mix-blocks")
    # pass by pass, the blocks drawn: need is null for a whole block
    whole = F.col("before") + F.col("words") <= F.col("rest")
    last = F.when((F.col("rest") > 0) & whole, F.struct(F.col("full").alias("pass"), F.lit(None).cast("double").alias("need"))).when(
        (F.col("rest") > 0) & (F.col("before") < F.col("rest")),
        F.struct(F.col("full").alias("pass"), (F.col("rest") - F.col("before")).alias("need")))
    passes = F.transform(F.when(F.col("full") > 0, F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).otherwise(F.array().cast("array<bigint>")),
                         lambda p: F.struct(p.alias("pass"), F.lit(None).cast("double").alias("need")))
    drawn = written(blocks.withColumn("p", F.explode(F.filter(F.concat(passes, F.array(last)), lambda x: x.isNotNull()))).select(
        "key", "block", "rows", "p.pass", "p.need", (F.col("p.pass") * F.col("there") + F.col("place")).alias("draw")), "mix-drawn")
    quotas = written(drawn.groupBy("key").agg(F.count("*").alias("quota")), "mix-quotas")
    dealt = written(split_quotas(quotas, shards, seed), "mix-shards")
    drawn = written(drawn.join(dealt.select("key", "shard", F.explode(F.sequence("first", "last")).alias("draw")), ["key", "draw"]), "mix-draws")

    placed = cut.select(*DOCUMENT, "copies", "block", place.alias("at"))
    took = placed.join(drawn.filter("need IS NULL"), ["key", "block"]).select(*DOCUMENT, "pass", "shard", F.col("copies").alias("n"))
    # the block that a target falls into: its parts in order, and of the part that the target falls into the documents
    edge = placed.join(drawn.filter("need IS NOT NULL"), ["key", "block"]).withColumn(
        "part", F.floor((F.col("at") - F.col("block")) * F.ceil(F.col("rows") / PART_ROWS)).cast("long"))
    upto = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = edge.groupBy("key", "part").agg(F.sum(F.col("size") * F.col("copies")).alias("words")).select(
        "key", "part", "words", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("before"))
    edge = edge.join(parts, ["key", "part"])
    fits = edge.filter("before + words <= need").select(*DOCUMENT, "pass", "shard", F.col("copies").alias("n"))
    part = edge.filter("before < need AND before + words > need").groupBy("key", "pass", "shard", (F.col("need") - F.col("before")).alias("need")).agg(
        F.sort_array(F.collect_list(F.struct("h", "doc", "size", "copies"))).alias("d"))
    part = part.select("key", "pass", "shard", F.explode(F.arrays_zip("d", _filled(F.col("need"), F.col("d")).alias("n"))).alias("z")).select(
        "key", "z.d.doc", "z.d.size", "z.d.h", "pass", "shard", "z.n").filter("n > 0")
    draws = took.unionByName(fits).unionByName(part).groupBy(*DOCUMENT).agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "n"))).alias("draws"))
    return rows, sources, written(draws, "mix-taken")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: float = MAX_REPEAT,
          shards: int = OUTPUT_SHARDS, seed: str = "mix") -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with ``mix_shard``, ``mix_pass`` and ``mix_order``.

    mix_order is a hash by which the rows of an output shard are sorted, the local shuffle. Columns of ``docs`` keep
    their names (the new ones get underscores where they clash). Rows with equal id, text and source share their document's
    draws in the order of a hash of all columns, so that reruns agree and other columns differ as they do in ``docs``.
    See ``plan_mix``.
    """
    rows, _, draws = plan_mix(docs, id_col, text_col, source_col, weights, budget, max_repeat, shards, seed)
    out = [free_name(docs, n) for n in ("mix_shard", "mix_pass", "mix_order")]
    # one column for a whole row, so that no other name can clash
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_keyed(docs, id_col, text_col, source_col, seed))
    kept = draws.join(rows.select(*DOCUMENT, "copies"), DOCUMENT)
    once, often = written(kept.filter("copies = 1"), "mix-once"), written(kept.filter("copies > 1"), "mix-often")
    alone = packed.join(once, DOCUMENT).withColumn("first", F.lit(0).cast("long")).withColumn("m", F.lit(1).cast("long"))
    # of the rows of one document: equal ones are folded, and the different ones follow one another by their hash
    print_ = F.sha1(F.to_json("row").cast("binary"))
    variants = written(packed.join(often, DOCUMENT).withColumn("print", print_).groupBy(*DOCUMENT, "print").agg(
        F.first("row").alias("row"), F.first("draws").alias("draws"), F.count("*").alias("m")).withColumn("range", F.substring("print", 1, 3)), "mix-variants")
    ranges = variants.groupBy(*DOCUMENT, "range").agg(F.sum("m").alias("in_range"))
    before = Window.partitionBy(*DOCUMENT).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*DOCUMENT, "range", F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy(*DOCUMENT, "range").orderBy("print").rowsBetween(Window.unboundedPreceding, -1)
    several = variants.withColumn("first", F.coalesce(F.sum("m").over(inside), F.lit(0))).join(ranges, [*DOCUMENT, "range"]).withColumn(
        "first", (F.col("first") + F.col("ahead")).cast("long"))
    cols = ["row", *DOCUMENT, "first", "m", "draws"]
    every = alone.select(*cols).unionByName(several.select(*cols)).withColumn("d", F.explode("draws"))
    every = every.withColumn("times", F.least(F.greatest(F.col("d.n") - F.col("first"), F.lit(0).cast("long")), F.col("m")))
    most = rows.agg(F.max("copies")).first()[0] or 0
    every = expand_copies(every, "times", "i", most)
    order = uniform52(seed, "order", F.col("key"), F.col("h"), F.col("d.pass"), F.col("first") + F.col("i"))
    return every.select("row.*", F.col("d.shard").alias(out[0]), F.col("d.pass").alias(out[1]), order.alias(out[2]))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: float = MAX_REPEAT,
               shards: int = OUTPUT_SHARDS, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, shards, taken for every row of ``docs``.

    ``shards`` lists the output shards that draw the row, pass by pass; ``taken`` counts its words in all of them. A null text
    has size 0 and is taken 0 words; a null source is a source of its own, last in order; of equal rows
    the first ones take what the last pass still holds; an empty table gives an empty result; other columns aren't read.
    """
    rows, sources, draws = plan_mix(docs, id_col, text_col, source_col, weights, budget, max_repeat, shards, seed)
    out = rows.join(draws, DOCUMENT, "left").join(sources.select("key", "source_size", "target"), "key")
    out = expand_copies(out, "copies", "i", rows.agg(F.max("copies")).first()[0] or 0)
    mine = F.transform(F.filter("draws", lambda d: F.col("i") < d["n"]), lambda d: d["shard"])
    out = out.withColumn("shards", F.coalesce(mine, F.array().cast("array<int>")))
    return out.select("doc_id", "source", "size", "source_size", "target", "shards", (F.col("size") * F.size("shards")).cast("long").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_report(docs).select("doc_id", "size", "source_size", "target", "taken", F.concat_ws(",", F.col("shards").cast("array<string>")).alias("shards"))


SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce('v' || source, 'n') AS key, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5('mix|' || coalesce('v' || CAST(doc_id AS VARCHAR), 'n') || '|' || coalesce(md5(text), 'n')), 1, 13) AS BIGINT) AS h
  FROM documents),
s1 AS (SELECT source, key, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n, {MAX_REPEAT!r} * sum(size) AS cap FROM d GROUP BY source, key),
s2 AS (SELECT *, {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () * {BUDGET!r} - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT *, least(cap, coalesce((SELECT arg_min(level, cap / weight) FROM s3 WHERE level <= cap / weight) * weight, cap)) AS target FROM s3),
s AS (SELECT *, target - whole * source_size AS rest
      FROM (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole,
                   greatest(1, least({MAX_BLOCKS}, ceil(n / {BLOCK_ROWS}))) AS blocks FROM s4)),
b0 AS (SELECT d.*, whole, rest, h / {SCALE!r} * blocks AS spot, CAST(floor(h / {SCALE!r} * blocks) AS BIGINT) AS block FROM d JOIN s USING (key)),
b1 AS (SELECT key, block, sum(size) AS words, count(*) AS n, CAST('0x' || substr(md5('mix|block|' || key || '|' || CAST(block AS VARCHAR)), 1, 13) AS BIGINT) AS o FROM b0 GROUP BY key, block),
b AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY key ORDER BY o, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
             row_number() OVER (PARTITION BY key ORDER BY o, block) - 1 AS place, count(*) OVER (PARTITION BY key) AS there FROM b1),
x AS (SELECT b0.*, place, there, CASE WHEN rest > 0 AND ahead + words <= rest THEN 1 ELSE 0 END AS more, rest > 0 AND ahead < rest AND ahead + words > rest AS edge,
             rest - ahead AS need, CAST(floor((spot - block) * ceil(n / {PART_ROWS})) AS BIGINT) AS part
      FROM b0 JOIN b USING (key, block)),
p AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY key ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM (SELECT key, part, sum(size) AS words FROM x WHERE edge GROUP BY key, part)),
y AS (SELECT x.r, x.key, x.size, p.ahead + p.words <= need AS fits, p.ahead < need AND p.ahead + p.words > need AS inner_edge, need - p.ahead AS need,
             row_number() OVER (PARTITION BY x.key, x.part ORDER BY h, doc_id NULLS FIRST, size) AS i
      FROM x JOIN p ON p.key = x.key AND p.part = x.part WHERE x.edge),
fill(key, i, need, r, took, size) AS (
  SELECT key, i, CASE WHEN size <= need THEN need - size ELSE need END, r, size <= need, size FROM y WHERE inner_edge AND i = 1
  UNION ALL
  SELECT y.key, y.i, CASE WHEN y.size <= f.need THEN f.need - y.size ELSE f.need END, y.r, y.size <= f.need, y.size
  FROM fill f JOIN y ON y.inner_edge AND y.key = f.key AND y.i = f.i + 1),
missing AS (SELECT key, arg_max(need, i) AS need FROM fill GROUP BY key),
last AS (SELECT arg_min(f.r, (abs(m.need - f.size), f.i)) AS r FROM fill f JOIN missing m USING (key)
         WHERE NOT f.took AND abs(m.need - f.size) < m.need GROUP BY key),
drawn AS (SELECT DISTINCT key, block, unnest(range(0, whole + CASE WHEN more = 1 OR edge THEN 1 ELSE 0 END)) AS pass, place, there FROM x),
quota AS (SELECT list(key ORDER BY key) AS keys, list(n ORDER BY key) AS k FROM (SELECT key, count(*) AS n FROM drawn GROUP BY key)),
tree(a, z, k, i, total, left_, dealt) AS (
  SELECT 0, {OUTPUT_SHARDS}, k, 1, CAST(list_sum(k) AS BIGINT), CAST(floor(list_sum(k) * floor({OUTPUT_SHARDS} / 2) / {OUTPUT_SHARDS}) AS BIGINT), CAST([] AS BIGINT[]) FROM quota
  UNION ALL
  SELECT a, z, k, i, total, left_, dealt FROM (
    SELECT a, z, k, i + 1 AS i, total - k[i] AS total, left_ - draw AS left_, list_append(dealt, draw) AS dealt FROM (
      SELECT *, CAST(low + least(high - low, len(list_filter(range(1, high - low + 2), lambda j: list_sum(list_transform(range(0, j), lambda t: exp(
               base - lgamma(low + t + 1) - lgamma(k[i] - low - t + 1) - lgamma(left_ - low - t + 1) - lgamma(total - k[i] - left_ + low + t + 1)))) < u))) AS BIGINT) AS draw
      FROM (SELECT *, greatest(0, left_ + k[i] - total) AS low, least(left_, k[i]) AS high,
                   lgamma(k[i] + 1) + lgamma(total - k[i] + 1) + lgamma(left_ + 1) + lgamma(total - left_ + 1) - lgamma(total + 1) AS base,
                   (CAST('0x' || substr(md5('mix|split|' || a || '|' || z || '|' || (SELECT keys FROM quota)[i]), 1, 13) AS BIGINT) + 0.5) / {SCALE!r} AS u
            FROM tree WHERE z - a > 1 AND i <= len(k)))
    UNION ALL
    SELECT a, z, k, 1, CAST(list_sum(k) AS BIGINT), CAST(floor(list_sum(k) * (floor((a + z) / 2) - a) / (z - a)) AS BIGINT), CAST([] AS BIGINT[]) FROM (
      SELECT unnest([a, m]) AS a, unnest([m, z]) AS z, unnest([dealt, list_transform(range(1, len(k) + 1), lambda j: k[j] - dealt[j])]) AS k
      FROM (SELECT *, CAST(floor((a + z) / 2) AS INTEGER) AS m FROM tree WHERE z - a > 1 AND i = len(k) + 1)))),
leaf AS (SELECT DISTINCT a AS shard, unnest((SELECT keys FROM quota)) AS key, unnest(k) AS n FROM tree WHERE z - a = 1),
span AS (SELECT *, sum(n) OVER (PARTITION BY key ORDER BY shard) AS upto FROM leaf),
went AS (SELECT d.key, d.block, d.pass, s.shard FROM drawn d JOIN span s ON s.key = d.key AND d.pass * d.there + d.place >= s.upto - s.n AND d.pass * d.there + d.place < s.upto),
took AS (SELECT x.r, x.key, x.block, x.whole + x.more + CASE WHEN y.fits OR f.took OR x.r IN (SELECT r FROM last) THEN 1 ELSE 0 END AS times
         FROM x LEFT JOIN y ON y.r = x.r LEFT JOIN fill f ON f.r = x.r),
shards AS (SELECT t.r, string_agg(CAST(w.shard AS VARCHAR), ',' ORDER BY w.pass) AS shards FROM took t JOIN went w ON w.key = t.key AND w.block = t.block AND w.pass < t.times GROUP BY t.r)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, s.source_size, CAST(s.target AS DOUBLE) AS target, CAST(d.size * t.times AS BIGINT) AS taken,
       coalesce(g.shards, '') AS shards
FROM d JOIN s USING (key) JOIN took t USING (r) LEFT JOIN shards g USING (r)
"""
