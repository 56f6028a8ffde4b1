"""Sharding, mixing, archives, embeddings and the pipeline against brute force."""

import hashlib
import math
import os
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import embeddings, mixing, sharding, warc
from marketlens.llm.common import components, expand_copies, small_components, work_folder
from marketlens.testing.compare import compare, duck_connect

DOCS = "doc_id long, text string, source string, size string, `key` int, h int, slot int, copies int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2, 3, 4, 5) for i, t, s in rows], DOCS)


EDGE = [(None, "a b", "s1"), (None, "a b", "s1"), (1, None, "s1"), (2, "", None), (3, "x y z", None)] + [(9, "same words here", "s2")] * 70


def test_components_are_smallest_reachable(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 400, 260), rng.integers(0, 400, 260)
    chain = [(1000 + i, 1001 + i) for i in range(60)]
    links = [*zip(a.tolist(), b.tolist(), strict=True), *chain, (5, 5)]
    x, y = (np.array(z) for z in zip(*links, strict=True))
    label = small_components(1100, x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {int(i): int(label[i]) for i in set(x.tolist()) | set(y.tolist()) if i in got}
    assert set(got) >= {int(i) for i, j in links if i != j}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_expand_copies_of_a_hot_row(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, 25)], "x int, n long")
    for chunk in (4096, 4):
        got = expand_copies(df, "n", "i", 25, chunk).groupBy("x").agg(F.sort_array(F.collect_list("i")).alias("i")).collect()
        assert {r.x: r.i for r in got} == {1: [0, 1, 2], 3: list(range(25))}


def slow_shard(key, tree, seed="shard"):
    def draw(name, w):
        u = int(hashlib.md5(f"{seed}|{key}|{name}".encode()).hexdigest()[:13], 16)
        return math.log((u + 0.5) / 2 ** 52) / w

    def total(x):
        return sum(map(total, x.values())) if isinstance(x, dict) else x

    region = max((r for r in tree if total(tree[r]) > 0), key=lambda r: draw(r, total(tree[r])))
    rack = max((k for k in tree[region] if total(tree[region][k]) > 0), key=lambda k: draw(k, total(tree[region][k])))
    shards = tree[region][rack]
    return max((s for s in shards if shards[s] > 0), key=lambda s: draw(f"s{s}", shards[s]))


def test_sharding_equals_brute_force(spark, smoke_dir):
    rows = [(r.doc_id, r.text, "s") for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()] + EDGE
    tree, grown = sharding.shard_tree(40), sharding.shard_tree(41)
    got = sharding.shard_documents(frame(spark, rows), tree, grown).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()),
                   slow_shard("n" if i is None else f"v{i}", tree), slow_shard("n" if i is None else f"v{i}", grown)) for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert all(r.grown_shard in (r.shard, 40) and r.law == "key" for r in got)
    for s in range(40):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_documents(frame(spark, []), tree, grown).count() == 0


def test_a_changed_weight_moves_rows_only_to_its_subtree(spark):
    ids = spark.range(6000)
    old = sharding.shard_tree(20)
    new = {r: {k: dict(s) for k, s in racks.items()} for r, racks in old.items()}
    new["r1"]["r1.k0"][12] = 4.0
    both = ids.select(sharding.tree_shard(F.col("id"), old).alias("a"), sharding.tree_shard(F.col("id"), new).alias("b")).collect()
    moved = [(r.a, r.b) for r in both if r.a != r.b]
    assert moved and all(b >= 10 for _, b in moved)  # into region r1 only
    share = sum(r.b == 12 for r in both) / len(both)
    assert abs(share - 4 / 23) < 0.02
    with pytest.raises(ValueError):
        sharding.tree_shard(F.lit(1), {"r": {"k": {0: 0.0}}})


def test_slots_of_a_repeated_id_are_cut_by_text_too(spark):
    """Rows of one id and different texts don't share the place that their ranges are cut by."""
    rows = [(None, f"text {i}", "s") for i in range(500)] + [(7, f"text {i % 50}", "s") for i in range(500)]
    got = sharding.shard_documents(frame(spark, rows), sharding.shard_tree(4)).collect()
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    place = frame(spark, rows).select(sharding.slot_place("shard", F.col("doc_id"), F.col("text")).alias("h")).distinct().count()
    assert place == 550


def test_numbering_over_many_buckets(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("int").alias("g"), (F.col("id") * 1_500_000_000_000).alias("h"))
    got = sharding.numbered(df, "g", ["h"], rows_per_bucket=10).collect()
    for g in range(3):
        rows = sorted((r.slot, r.h) for r in got if r.g == g)
        assert [s for s, _ in rows] == list(range(1000)) and [h for _, h in rows] == sorted(h for _, h in rows)


def slow_targets(sizes, weights=(5.0, 2.0, 1.0)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    free, left, out = set(names), 1.5 * sum(sizes.values()), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > 2 * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixing_targets_and_taken_words(spark, smoke_dir):
    base = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in base.collect()] + EDGE
    docs = frame(spark, rows)
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").split())
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = slow_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert all(math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9) for r in mine)
        taken = sum(r.taken for r in mine)
        assert abs(want[s] - taken) <= max(0.05 * want[s], max((r.size for r in mine), default=0) / 2)
        assert all(r.taken in (0, r.size, 2 * r.size) and len(r.shards) * r.size == r.taken for r in mine)
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix_report(frame(spark, [])).count() == 0


def test_mixed_rows_are_what_the_report_says(spark, smoke_dir):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()] + EDGE
    docs = frame(spark, rows)
    mix = mixing.mixed(docs, shards=5)
    assert mix.columns == [*docs.columns, "mix_shard", "mix_pass", "mix_order"]
    words = mix.groupBy("doc_id").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()
    report = mixing.mix_report(docs, shards=5).groupBy("doc_id").agg(F.sum("taken").alias("n")).filter("n > 0").collect()
    assert {r.doc_id: r.n for r in words if r.n} == {r.doc_id: r.n for r in report}


def test_quotas_split_exactly_and_like_random_deals(spark):
    quotas = spark.createDataFrame([("a", 40), ("b", 25), ("c", 1), ("d", 0)], "key string, quota long")
    shares = []
    for seed in range(40):
        got = mixing.split_quotas(quotas, 3, f"s{seed}").collect()
        for key, n in (("a", 40), ("b", 25), ("c", 1)):
            draws = sorted(x for r in got if r.key == key for x in range(r.first, r.last + 1))
            assert draws == list(range(n))
        per = [sum(r.last - r.first + 1 for r in got if r.shard == s) for s in range(3)]
        assert sum(per) == 66 and max(per) - min(per) <= 1
        shares.append(sum(r.last - r.first + 1 for r in got if r.key == "a" and r.shard == 0))
    sd = math.sqrt(22 * 40 / 66 * 26 / 66 * 44 / 65)  # of the hypergeometric draw
    assert abs(np.mean(shares) - 22 * 40 / 66) < 4 * sd / math.sqrt(40) + 0.5 and 0.5 * sd < np.std(shares) < 1.6 * sd


def test_boundary_block_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 8)
    rows = [(i, "w " * (1 + i * 7 % 23), f"s{i % 3}") for i in range(900)]
    got = mixing.mix_report(frame(spark, rows)).groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("n")).collect()
    assert all(abs(r.t - r.n) <= 12 for r in got)


def test_a_boundary_block_is_cut_into_parts(spark, smoke_dir, monkeypatch):
    """Only documents of one part are fitted one by one; the deal's SQL is built with the same sizes."""
    monkeypatch.setattr(mixing, "PART_ROWS", 5)
    sql = mixing.SQL.replace("ceil(n / 1024)", "ceil(n / 5)")
    assert sql != mixing.SQL
    res = compare(mixing.query(spark, smoke_dir), duck_connect(smoke_dir), sql)
    assert res["ok"], res


def test_mixed_rows_keep_the_columns_that_differ(spark):
    """Rows with equal id, text and source but other columns share the document's draws, each as often as it is there."""
    rows = [(1, "a b c", "s", lang, n) for lang, n in (("en", 1), ("en", 1), ("fr", 2), (None, 3))] + [(2, "d e", "s", "en", 4), (None, "", None, "x", 5), (None, "", None, "y", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, row int")
    mixes = [sorted(map(str, mixing.mixed(d, budget=2.0).collect())) for d in (docs, docs.repartition(4), docs.coalesce(1))]
    assert mixes[0] == mixes[1] == mixes[2]
    got = sorted((r.doc_id or 0, r.lang or "", r.row) for r in mixing.mixed(docs, budget=2.0).collect())
    twice = [(i or 0, lang or "", n) for i, t, _, lang, n in rows if t] * 2
    assert [g for g in got if g[0]] == sorted(twice)


def test_too_many_sources_raise(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    rows = [(i, "w x", f"s{i}") for i in range(4)]
    with pytest.raises(ValueError):
        mixing.mix_report(frame(spark, rows))
    assert mixing.mix_report(frame(spark, rows[:3])).count() == 3


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], "page_id long, url string, html string, bytes int, digest string")


def test_warc_round_trip(spark):
    big, other = "é" * 600, "x" * 999
    rows = [(1, "u1", big), (7, "u7\r\nX: y", big), (3, None, big), (4, "u", None), (5, "u", ""), (6, "u", other), (8, "u", other), (9, "u", "WARC/1.1\r\n\r\n" * 300),
            (None, "u", big), (10, "u", "z" * 3_000_000), (7, "again", big)]
    got = warc.round_trip(pages(spark, rows)).collect()
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        last = max(j for j, _, g in rows if j is not None and (g or "") == (h or ""))
        copy = len(p) >= 1000 and i is not None and last != i
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if copy else "response", last if copy else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_warc_equals_sql(spark, smoke_dir):
    res = compare(warc.query(spark, smoke_dir), duck_connect(smoke_dir), warc.SQL)
    assert res["ok"], res


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_later_records(packed):
    payloads = [os.urandom(50 + 37 * i) + (b"WARC/1.1\r\n" if i == 4 else b"") for i in range(12)]
    parts = [warc.record("response", f"urn:x-page:{i}", "u", p, len(p), hashlib.sha1(p).hexdigest()) for i, p in enumerate(payloads)]
    parts = [warc.member(p) for p in parts] if packed else parts
    data = bytearray(b"".join(parts))
    at = np.cumsum([0, *map(len, parts)])
    data[at[3] - 12] ^= 255  # a damaged record
    data[at[5]:at[5]] = junk = b"\x1f\x8b\x08 not a member WARC/9"  # bytes between records
    at[5:] += len(junk)
    del data[at[8] - 20:at[8]]  # a record without its end
    at[8:] -= 20
    data = bytes(data[:-7])  # the last is cut off
    out = list(warc.salvage(lambda a, n: data[a:a + n], len(data)))
    found = [x for x in out if isinstance(x, warc.Record)]
    gaps = [x for x in out if isinstance(x, warc.Gap)]
    assert [x.http[1] for x in found] == [payloads[i] for i in (0, 1, 3, 4, 5, 6, 8, 9, 10)]
    assert sorted((x.offset, x.offset + x.length) for x in out) == [(a, b) for a, b in zip(
        [x.offset for x in out], [*[x.offset for x in out][1:], len(data)], strict=True)]  # no byte is lost from the account
    assert {(g.offset, g.offset + g.length) for g in gaps} >= {(at[2], at[3]), (at[5] - len(junk), at[5]), (at[11], len(data))} and all(g.reason for g in gaps)


def test_damaged_archive_in_spark(spark):
    rows = [(i, "u", f"page {i} " * 50) for i in range(40)]
    manifest = warc.write_archives(pages(spark, rows).coalesce(1), work_folder(spark, "warc"))
    path = manifest.first().path.removeprefix("file://")
    with open(path, "r+b") as f:
        f.seek(os.path.getsize(path) // 2)
        f.write(b"\0" * 40)
    got = warc.read_archives(manifest).collect()
    assert 37 <= len([r for r in got if r.gap is None]) < 40 and [r for r in got if r.gap is not None]
    assert all(r.payload.decode() == f"page {r.page_id} " * 50 for r in got if r.gap is None)
    log = work_folder(spark, "log")
    with pytest.raises(ValueError, match="of 40 written"):
        warc.checked_read(manifest, log)
    logged = spark.read.parquet(log).collect()
    assert logged and all(r.gap and r.length > 0 and r.path.endswith(".warc.gz") for r in logged)


def test_salvage_reads_members_of_several_records():
    payloads = [os.urandom(100 + i) for i in range(6)]
    parts = [warc.record("response", f"urn:x-page:{i}", "u", p, len(p), hashlib.sha1(p).hexdigest()) for i, p in enumerate(payloads)]
    bad = bytearray(parts[1])
    bad[-20] ^= 1
    data = warc.member(parts[0] + bytes(bad) + parts[2]) + warc.member(parts[3]) + warc.member(b"WARC/1.1\r\nno head") + warc.member(parts[4] + parts[5])
    out = list(warc.salvage(lambda a, n: data[a:a + n], len(data)))
    assert [x.http[1] for x in out if isinstance(x, warc.Record)] == [payloads[i] for i in (0, 2, 3, 4, 5)]
    assert sum(x.length for x in out) == len(data) and sum(isinstance(x, warc.Gap) for x in out) == 2


def test_salvage_of_damage_takes_time_in_proportion():
    head = b"WARC/1.1\r\nContent-Length: 3000000\r\n\r\n"
    good = warc.record("response", "urn:x-page:1", "u", b"payload", 7, hashlib.sha1(b"payload").hexdigest())
    for junk in (b"WARC/1.1\r\n" * 400_000, head * 100_000, b"\x1f\x8b\x08" * 300_000, b"WARC/1.1\r\nx" * 300_000, b"\r\n" * 1_000_000):
        data, began = junk + good, time.process_time()
        out = list(warc.salvage(lambda a, n: data[a:a + n], len(data)))  # noqa: B023
        assert [x.http[1] for x in out if isinstance(x, warc.Record)] == [b"payload"]
        assert time.process_time() - began < 30


def test_a_member_that_inflates_to_too_much_is_a_gap(monkeypatch):
    monkeypatch.setattr(warc, "MEMBER_BYTES", 1 << 20)
    good = warc.member(warc.record("response", "urn:x-page:1", "u", b"x", 1, hashlib.sha1(b"x").hexdigest()))
    data = warc.member(b"WARC/1.1\r\n" + b"0" * (40 << 20)) + good
    out = list(warc.salvage(lambda a, n: data[a:a + n], len(data)))
    assert "inflates" in out[0].reason and isinstance(out[-1], warc.Record)


VECTORS = "vec_id long, embedding array<float>, label int, rep int, v string, n int"


def slow_links(rows, t=0.93):
    def ok(v, lab):
        return lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n, near = len(rows), {i: set() for i in range(len(rows))}
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if ok(a[1], a[2]) and ok(b[1], b[2]) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.array(z[1], np.float32).astype(float) for z in (a, b))
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= t:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((rows[i][0], len(near[i]), c, rows[i][0] is not None and rows[i][0] == c))
    return out


@pytest.mark.parametrize("tile", [1024, 16])
def test_embeddings_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 24))
    rows = [(i, (centers[i % 12] * rng.uniform(0.1, 1e3) + rng.normal(size=24) * rng.uniform(0, 0.4)).astype(np.float32).tolist(), i % 3) for i in range(300)]
    rows += [(400 + i, rows[5][1], 2) for i in range(40)]  # copies
    odd = rows[0][1]
    rows += [(500, None, 0), (501, [0.0] * 24, 0), (502, [float("nan"), *odd[1:]], 0), (503, [None, *odd[1:]], 0), (504, [float("inf"), *odd[1:]], 0), (505, odd, None),
             (None, odd, 0), (506, odd[:12], 0), (507, odd[:12], 0), (0, odd, 0), (508, [], 0), (509, [-0.0, 1.0], 1), (510, [0.0, 2.0], 1), (511, [1e-30, 1e-30], 1), (512, [3e30, 3e30], 1)]
    df = spark.createDataFrame([(i, v, x, 1, "v", 2) for i, v, x in rows], VECTORS)
    got = sorted((tuple(r) for r in embeddings.near_duplicates(df).collect()), key=str)
    assert got == sorted(slow_links(rows), key=str)


def test_embeddings_of_huge_and_tiny_components(spark):
    rows = [(1, [1e170, 2e170], 0), (2, [1e-170, 2e-170], 0), (3, [1.0, 2.0], 0), (4, [2.0, -1.0], 0), (5, [5e-324, 1e-323], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()) == [
        (1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 0, 4), (5, 3, 1)]


def test_embeddings_equal_sql_and_empty(spark, smoke_dir):
    res = compare(embeddings.query(spark, smoke_dir), duck_connect(smoke_dir), embeddings.SQL)
    assert res["ok"], res
    assert embeddings.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("module", [sharding, mixing])
def test_native_operators_equal_sql(spark, smoke_dir, module):
    res = compare(module.query(spark, smoke_dir), duck_connect(smoke_dir), module.SQL)
    assert res["ok"], res
