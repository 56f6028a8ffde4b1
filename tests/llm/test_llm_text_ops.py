"""Operators on texts against brute force, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marketlens.llm import decontamination, htmltext, quality, simhash, tokencount, tokenids
from marketlens.llm.common import segments, work_folder, written
from marketlens.testing.compare import compare, duck_connect

LONG = "lorem ipsum dolor " * 90_000  # over a megabyte
DOCS = "doc_id long, text string, lang string, source string, h string, n long, `row` int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "x", 1, 2, 0.5) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def texts(smoke_dir, spark):
    return [tuple(r) for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").select("doc_id", "text").collect()]


EDGE = [(None, "a b c d e"), (901, None), (902, ""), (903, " \t\n "), (904, "one"), (905, "one two three"), (906, LONG),
        (907, "Same Text here now and then"), (907, "Same Text here now and then"), (907, "other text of that id again"), (None, None)]


def slow_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_equals_brute_force(spark, texts):
    rows = texts + [(1000 + i, t.replace("e", "a", 1)) for i, t in texts[:60]] + EDGE
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect()), key=str)
    fps = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    arr = np.array(fps, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 4):
            parent[find(i)] = find(int(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = sorted(((d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))), key=str)
    assert got == want


def test_simhash_long_text_in_segments():
    text = " ".join(f"word{i % 977} Übung{i % 13}" for i in range(140_000))
    assert len(text.encode()) > 2 << 20
    assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert b"".join(segments(text.encode())) == text.encode()


def test_golay_code_and_keys():
    code, rng = simhash.Golay(), np.random.default_rng(3)
    words = rng.integers(0, 1 << 12, 500) << 11
    clean = words ^ code.error[code.syndrome[0][words & 255] ^ code.syndrome[1][words >> 8 & 255] ^ code.syndrome[2][words >> 16]]
    for _ in range(20):  # up to three errors decode to the same codeword
        noise = np.zeros(500, np.int64)
        for _ in range(3):
            noise |= 1 << rng.integers(0, 23, 500)
        assert (code.index(clean ^ noise) == code.index(clean)).all()
    a = rng.integers(0, 1 << 63, 4000, dtype=np.int64).view(np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, len(b)).astype(np.uint64)
    keys = [set(zip(*map(np.ndarray.tolist, simhash.golay_keys(x, code)), strict=True)) for x in (a, b)]
    assert {i for i, _ in keys[0] & keys[1]} == set(range(len(a)))


def test_simhash_large_key_is_tiled(spark, monkeypatch):
    """Many fingerprints under one key: chunks compared pair by pair give the same components."""
    monkeypatch.setattr(simhash, "TILE", 16)
    base = 0x0123456789ABCDEF
    fps = [base ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)] + [base ^ (0xFF << 40)]
    prints = spark.createDataFrame([(x,) for x in fps], "fp long")
    from marketlens.llm.common import components
    got = components(simhash.links(prints)).groupBy("component").count().collect()
    assert len(got) == 1 and got[0]["count"] == len(fps) - 1


def test_simhash_empty_table_and_bits(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 5)


def test_token_counts_equal_library(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["a<|endoftext|>b <|startoftext|>", "I'll DON'T it's x'S", "a\x1cb \x85 c", "Ünïcode ǅ İstanbul ΣΑΣ é ́x  y",
           "12 345 ½ ²³", "日本語 テキスト", "'s's 'll''d", "  x　y", "<|ENDOFTEXT|>"]
    long = ["ab\x1c!? c's\n" * 150_000, "word<|endoftext|> " * 70_000]  # over a megabyte
    rows = texts[:50] + EDGE + [(2000 + i, t) for i, t in enumerate(odd + long)]
    got = sorted((tuple(r) for r in tokencount.token_counts(frame(spark, rows), path).collect()), key=str)
    lib = Tokenizer.from_file(path)
    n = [len(e.ids) for e in lib.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    want = sorted(((d, len((t or "").encode()), k, k > 2048) for (d, t), k in zip(rows, n, strict=True)), key=str)
    assert got == want
    assert tokencount.token_counts(frame(spark, []), path).count() == 0


def test_whole_tokens_are_proven():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    words, lib = sorted(tokencount.whole_tokens(path)), Tokenizer.from_file(path)
    assert len(words) > 10_000 and all(len(lib.encode(w, add_special_tokens=False).ids) == 1 for w in words[::97])


def test_token_ids_round_trip(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = ["a  b\n\n c <|endoftext|> d", " x \t y  ", "\x1c\x1f q", "é ́ ́a　 b", "tail ", "\n\nx\n y", " ", "\n",
           "it's word's. don't, x''s a²b! Ab- é-é naïve! \xa0x", "ab1! cd_e", "w's  <|endoftext|>.\n" * 80_000]
    rows = texts + EDGE + [(7, t) for t in odd]
    docs = frame(spark, rows)
    tokens = written(tokenids.token_ids(docs, path), "t")
    got = tokenids.read_ids(tokenids.write_ids(tokens, work_folder(spark, "huffman"), 50_000)).collect()
    lib = Tokenizer.from_file(path)
    ids = [np.array([*e.ids, 2], "<u4") for e in lib.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    want, start = [], 0
    got = sorted(tuple(r) for r in [(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got])
    # equal ids follow in the order of the rows
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i)):
        want.append((start, rows[i][0], len(ids[i]), zlib.crc32(ids[i].tobytes())))
        start += len(ids[i])
    assert got == want
    assert tokenids.stored_ids(frame(spark, []), path).count() == 0


def test_token_ids_of_texts_with_white_space_inside_pieces():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lines = "At the end.\nYes, he ertitier.\nHeti, (so)\nno! "
    cases = [lines * 25_000 + "end.", lines + "he left.\n", lines.replace("\n", "\n\n"), "end.\nYes,", " end.\nYes, he", "end.\r\nYes,\tno.\nSo",
             "a\xa0b.\nYes, he", "\n\nYes, he.\n \nno,"]
    assert len(cases[0]) > 1 << 20
    t, lib = tokenids.Tokenizer(path), Tokenizer.from_file(path)
    for each in (cases, cases[::-1]):
        t.clear()
        cut = [tokenids.parts(x) for x in each]
        raw = iter(t.ids([p for x in cut for p in x]))
        got = [np.frombuffer(b"".join(next(raw) for _ in x), np.uint32).tolist() for x in cut]
        assert got == [lib.encode(x, add_special_tokens=False).ids for x in each]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_of_odd_characters(name, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    monkeypatch.setattr(tokenids, "MEMORY", 3000)
    monkeypatch.setattr(tokenids, "SLICE_BYTES", 4000)
    rng = np.random.default_rng(5)
    bits = [*"  \n\n\t\r\x0b\x1c\x1f\x7f\x85\xa0\u1680\u2003\u2028\u3000.,'!-_19aebstZéÉ×÷ÿ́ЖΩ中😀", " the", "ing", "'s", "'ll", " \n", "end.\n", "<|endoftext|>"]
    cases = ["".join(rng.choice(bits, n)) for n in rng.integers(0, 40, 4000)]
    t, lib = tokenids.Tokenizer(path), Tokenizer.from_file(path)
    got = [np.frombuffer(x, np.uint32).tolist() for x in t.ids(cases)]
    assert got == [lib.encode(x, add_special_tokens=False).ids for x in cases]


def test_token_ids_send_each_piece_to_the_library_once(monkeypatch):
    import public_tokenizers
    t = tokenids.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    sent, words = [], t._words
    monkeypatch.setattr(t, "_words", lambda pieces: sent.extend(pieces) or words(pieces))
    texts = ["Reoush hewh, hewh. hewh!\nReoush\nhewh", "the hewh; (hewh)"]
    first = t.ids(texts)
    assert sorted(sent) == [" hewh", "Reoush", "hewh", "the"]
    # beyond the memory's bound those at hand are kept
    monkeypatch.setattr(tokenids, "MEMORY", 10)
    sent.clear()
    assert t.ids([texts[0] + " onan", texts[1] + " blein"])[0][:len(first[0])] == first[0] and sorted(sent) == [" blein", " onan"]
    assert t.ids(texts) == first and sorted(sent) == [" blein", " onan"]
    # few but long pieces are bounded by their bytes
    monkeypatch.setattr(tokenids, "MEMORY", 1000)
    monkeypatch.setattr(tokenids, "MEMORY_BYTES", 4000)
    for i in range(5):
        t.ids([f"{'xy' * 600}{chr(97 + i)}"])
        assert t.pieces.nbytes < 4000


def test_token_ids_of_texts_beyond_a_slice(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "the"), (2, "Reoush hewh, and\n" * 520_000), (3, None), (4, "hewh " * 300_000), (5, "")]
    assert len(rows[1][1]) > tokenids.SLICE_BYTES
    lib = Tokenizer.from_file(path)
    for end in (2, 70_000, None):  # the second doesn't fit into 16 bits
        got = {r.doc_id: r for r in tokenids.token_ids(frame(spark, rows).coalesce(1), path, end_id=end).collect()}
        for i, text in rows:
            want = np.array(lib.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end]), np.uint32 if end == 70_000 else np.uint16)
            assert (got[i].n, zlib.crc32(got[i].ids)) == (len(want), zlib.crc32(want.tobytes())), i


@pytest.mark.parametrize("symbols", [0, 1, 2, 3, 700])
def test_huffman_codes(symbols):
    from marketlens.llm.huffman import BLOCK, Decoder, Encoder, canonical_codes, code_lengths
    rng = np.random.default_rng(symbols)
    counts = np.zeros(1000, np.int64)
    counts[rng.choice(1000, symbols, replace=False)] = (2.0 ** rng.uniform(0, 40, symbols)).astype(np.int64) + 1
    lengths = code_lengths(counts, 12)
    assert lengths.max(initial=0) <= 12 and ((lengths > 0) == (counts > 0)).all()
    if symbols > 1:
        assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() == 1
    words = [f"{c:0{n}b}" for c, n in zip(canonical_codes(lengths), lengths, strict=True) if n]
    assert not any(a != b and b.startswith(a) for a in words for b in words[:50])
    if not symbols:
        return
    ids = rng.choice(np.flatnonzero(counts), 20_000)
    first = np.array([0, 0, 1, 9000, 9001, 20_000])
    data, start, bit = Encoder(lengths).encode(ids, first)
    blocks = [(bit[s], min(BLOCK, z - s)) for a, z in zip(first[:-1], first[1:], strict=True) for s in range(a, z, BLOCK)]
    out = Decoder(lengths).decode(data, np.array([b for b, _ in blocks]), np.array([n for _, n in blocks]))
    assert (out == ids).all() and len(data) == start[-1]


def test_length_limited_codes_are_optimal():
    """Against every assignment of lengths to few symbols."""
    import itertools

    from marketlens.llm.huffman import code_lengths
    rng = np.random.default_rng(5)
    for limit in (3, 4):
        for _ in range(20):
            counts = rng.integers(1, 100, 5) ** rng.integers(1, 4)
            best = min(sum(c * n for c, n in zip(counts, ls, strict=True)) for ls in itertools.product(range(1, limit + 1), repeat=5)
                       if sum(2.0 ** -n for n in ls) <= 1)
            assert (counts * code_lengths(counts, limit)).sum() == best


def slow_contamination(docs, items):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, t in items:
        w = cut(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("null" if item is None else str(item))
    out = []
    for d, t in docs:
        w, hit, ids = cut(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def test_contamination_equals_brute_force(spark, texts, smoke_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").collect()]
    items += [(500, "Three little words"), (501, None), (502, ""), (503, "one"), (None, items[0][1]), (503, "one"), (504, "été à la plage")]
    rows = texts + EDGE + [(3000, items[0][1].upper() + " and " + items[0][1]), (3001, "THREE, little-words! three little words"), (3002, "x été à la plage y")]
    other = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontamination.contamination(frame(spark, rows), other).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(slow_contamination(rows, items), key=str)
    none = decontamination.contamination(frame(spark, rows), other.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(rows)
    assert decontamination.contamination(frame(spark, []), other).count() == 0


def test_contamination_equals_sql(spark, smoke_dir):
    res = compare(decontamination.query(spark, smoke_dir), duck_connect(smoke_dir), decontamination.SQL)
    assert res["ok"], res


PAGES = [
    ("<p>a<p>b, &lt;x&gt; c", "a b, <x> c"), (None, ""), ("", ""), ("<br><hr>", ""), ("a < b and c", "a < b and c"),
    ("<div><div class='comments'><p>lots of reader text, with commas, and more and more and more</p></div><div id=x><p>The real text, is here, "
     "and it is long enough to be counted as text.</p><p>Two</p></div><aside>no</aside></div>",
     "The real text, is here, and it is long enough to be counted as text. Two"),
    ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>body, text</p></main><footer>f</footer>", "T body, text"),
    ("<ul><li><a href=x>one</a></li></ul><p>hello <b>wor</b>ld&nbsp;x</p><!-- c <p>no</p> -->", "hello world x"),
    ("<script>x</script><p title=\"a>b\">yes", "yes"), ("<p>text<!--unclosed <p>gone", "text"),
    ("<div role=navigation><p>go here, or there, or anywhere at all in this site</p></div><div><p>one</p></div><form><p>q</p></form>", "one"),
    ("<article><p>" + "long text, " * 100_000 + "</p></article><div class=ad>buy</div>", ("long text, " * 100_000).strip()),
]


def test_main_text(spark, smoke_dir):
    pages = spark.createDataFrame([(i, None if i == 1 else "u", h, "t") for i, (h, _) in enumerate(PAGES)] + [(None, "u", "<p>x", "t")] * 2,
                                  "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in htmltext.extracted(pages).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert got[i].text == want and got[i].n_chars == len(want), i
    assert htmltext.extracted(pages).count() == len(PAGES) + 2
    assert htmltext.extracted(pages.limit(0)).count() == 0
    for r in spark.read.parquet(f"{smoke_dir}/pages.parquet").collect():  # these pages mark their article
        body = r.html.split("<article>")[1].split("</article>")[0]
        import html as h
        want = " ".join(h.unescape(re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", body))).split())
        assert htmltext.main_text(r.html) == want


BODY = "The real text, is here, and it is long enough to be counted as text, by any measure, and a bit more than that."


@pytest.mark.parametrize("page", [
    "<div class='content has-sidebar'><p>{}</p></div>", "<div id='page' class='no-comments'><p>{}</p></div>", "<section class='post share-enabled'><p>{}</p></section>",
    "<div class='has-sidebar'><article><p>{}</p></article></div>", "<div class='no-comments'><main><p>{}</p></main></div>", "<div class='with-sidebar'><p>{}</p></div>",
    "<div class='no-comments'><article class='post share-enabled'><p>{}</p></article></div>",
    "<div class=content><p>{}</p></div><div id=comments><p>" + "a long comment, of a reader, " * 30 + "</p></div>",
    "<div class='with-sidebar'><p>{0}</p><p>{0}</p></div><div class=comments><div class=text><p>" + "a comment, of a reader, " * 6 + "</p></div></div>",
    "<article><p>{}</p></article><ol class='comments'><li><article class='comment-body'><p>I, for one, think that this isn't so, at all.</p></article></ol>",
    "<svg><path d='M0 0'><p>{}</p>", "<math><mi>x<p>{}</p>", "<svg><path d='M0 0'><p>{}</p><svg><text>no</text></svg>",
    "<svg><foreignObject><div>no</div></foreignObject></svg><p>{}</p>",
])
def test_main_text_of_wrappers_and_unclosed_drawings(page):
    got = htmltext.main_text("<body><div>Some other words</div>" + page.format(BODY))
    assert BODY in got and "reader" not in got and "for one" not in got and "no" not in got.split()


def test_main_text_keeps_titles_and_lists_of_an_article():
    page = ("<div>Other words</div><article><header class='entry-header'><h1>Title</h1></header><p>" + BODY + "</p><ul><li><a href=x>First source</a></li>"
            "<li><a href=y>Second source</a></li></ul><div class='post-navigation'><a href=z>Next</a></div><div class='share'>Send it</div></article>")
    assert htmltext.main_text(page) == f"Title {BODY} First source Second source"


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.query(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert len(out) > 50 and np.mean([r.predicted == r.quality for r in out]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert quality.fit_rows(docs, labels, max_rows=50).agg(F.sum("n")).first()[0] == 50


def test_quality_is_fitted_on_bounded_rows(spark):
    """An id with most of the rows, copies and other texts, doesn't exceed the bound nor crowd out other ids."""
    out = spark.range(40).select(F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("h")).filter("NOT h").orderBy("doc_id")
    ids = [r.doc_id for r in out.collect()]
    rows = [(i, f"own{i}") for i in ids] + [(ids[0], "copy")] * 200 + [(ids[1], f"other{k}") for k in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    bucket = {t: sorted(set(quality.features([t.encode()])[0].tolist())) for _, t in rows}
    for most in (10, len(ids), len(ids) + 50, len(ids) + 400, 1000):
        got = [quality.unpacked(r.features)[0].tolist() for r in quality.fit_rows(frame(spark, rows), labels, max_rows=most).collect() for _ in range(r.n)]
        assert len(got) == min(most, len(rows))
        of = {i: [bucket[t] for j, t in rows if j == i] for i in ids}
        assert sum(any(b in got for b in of[i]) for i in ids) == min(most, len(ids))


def test_quality_is_fitted_on_all_labels_of_sf01(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~quality.held_out(F.col("doc_id")))
    usable = docs.join(known.select("doc_id").distinct(), "doc_id", "left_semi").count()
    assert 2500 < quality.fit_rows(docs, labels).agg(F.sum("n")).first()[0] == usable


def test_quality_is_fitted_on_bounded_bytes(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(300))) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    sizes = [len(r.features) for r in quality.fit_rows(frame(spark, rows), labels).collect()]
    seen = []
    monkeypatch.setattr(quality.Model, "fit", lambda self, rows: seen.append(rows) or self)
    for most in (10 ** 9, 5 * max(sizes), 1):
        monkeypatch.setattr(quality, "MAX_FIT_BYTES", most)
        quality.fit(frame(spark, rows), labels)
    assert [len(r) for r in seen][::2] == [len(sizes), 1] and 5 <= len(seen[1]) < len(sizes) and set(seen[2]) <= set(seen[1]) <= set(seen[0])


def test_quality_edges(spark, texts):
    rows = texts[:40] + EDGE
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (5, None, 0), (6, 7, 0), (901, 1, 1)], "doc_id long, quality int, toxic int")
    weights = quality.fit(docs, labels)
    out = quality.scored(docs, weights)
    assert out.columns == [*docs.columns, "score_", "predicted", "held_out"] and out.count() == len(rows)
    empty = {r.score_ for r in out.filter("trim(translate(coalesce(text, ''), '\\t\\n', '  ')) = ''").collect()}
    assert len(empty) == 1  # no words: the bias alone
    assert {r.held_out for r in out.filter("doc_id IS NULL").collect()} == {False}
    same = out.filter("doc_id = 907").groupBy("text").agg(F.count_distinct("score_").alias("n")).collect()
    assert {r.n for r in same} == {1}
    flat = quality.fit(docs, labels.limit(0))
    assert {r.score_ for r in quality.scored(docs, flat).collect()} == {0.5}
    assert quality.scored(docs.limit(0), weights).count() == 0


def test_quality_features_of_long_text_are_all_there():
    text = "alpha beta " * 100_000
    whole, _ = quality.features([text.encode()])
    parts = sum(len(quality.features(p)[0]) for p, _ in quality._pieces([text]))
    assert 0 <= len(whole) - parts <= 4  # only pairs across a cut are missing
