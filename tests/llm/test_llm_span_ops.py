"""Spelling variants, personal data and periodic runs against brute force."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketlens.llm import periodic, sanitise, variants
from marketlens.testing.compare import compare, duck_connect

DOCS = "doc_id long, text string, word string, n int, `key` int, row int, base string, part int, term string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2, 3, "b", 4, "t") for i, t in rows], DOCS)


def smoke_rows(spark, smoke_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()]


# ---------------------------------------------------------------- spelling variants
def slow_words(rows):
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), w)
            h = None if i is None else zlib.crc32(f"{i}:{w}".encode())
            if h is not None and h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def test_variants_equal_brute_force(spark, smoke_dir):
    rng = random.Random(5)
    rows = smoke_rows(spark, smoke_dir)
    for i in range(300):  # words close to one another, accents and signs between letters, equal counts
        words = ["".join(rng.choice("abAé×") for _ in range(rng.choice([5, 6, 6, 7]))) for _ in range(60)]
        rows.append((rng.choice([None, 10 ** 6 + i]), rng.choice([" ", "Ā", "-1 "]).join(words)))
    rows += [(None, None), (None, ""), (3, "wordle " * 40000), (3, "wordle " * 40000), (4, "wordla " * 6000), (5, "wordlab " * 1000)]
    n = slow_words(rows)
    got = {tuple(r) for r in variants.spelling_variants(frame(spark, rows)).collect()}
    assert got == slow_variants(n)
    assert ("wordlab", "wordla", "wordle", n["wordlab"], 1, n["wordla"]) in got
    assert variants.spelling_variants(frame(spark, [])).count() == 0


def test_variants_with_one_symbol_only(spark):
    """All words of a length share one reduced word: nothing is lost however full a bucket is."""
    rng = random.Random(1)
    n = {"".join(rng.choice("abcd") for _ in range(rng.choice([6, 7]))): 5 + i for i in range(300)}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert {tuple(r) for r in variants.variant_groups(words, symbols=1).collect()} == slow_variants(n)


def test_reduced_neighbourhoods_are_full_and_have_no_repeats():
    import numpy as np
    words = ["", "a", "aab", "abcabc", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz"]
    code, length = variants.reduced(words, 3)
    of, key = variants._Sums(code, length).neighbours(3)
    end = np.cumsum(length)
    for i, (e, m) in enumerate(zip(end, length, strict=True)):
        s = tuple(code[e - m:e].tolist())
        want = {s} | {s[:j] + s[j + 1:] for j in range(m)} | {s[:j] + (x,) + s[j + 1:] for j in range(m) for x in range(3)}
        want |= {s[:j] + (x,) + s[j:] for j in range(m + 1) for x in range(3)}
        flat = np.array([x for w in sorted(want) for x in w], np.uint64)
        keys = variants._Sums(flat, np.array([len(w) for w in sorted(want)])).key
        mine = key[of == i].tolist()
        assert len(mine) == len(set(mine)) and set(mine) == set(keys.tolist())


def test_variants_sql(spark, smoke_dir):
    assert compare(variants.query(spark, smoke_dir), duck_connect(smoke_dir), variants.SQL)["ok"]


# ---------------------------------------------------------------- personal data
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def slow_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
                    or (kind == "card" and 13 <= len(digits) <= 19 and slow_luhn(digits)) or (kind == "phone" and 9 <= len(digits) <= 15)):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice(rng.choice(["a@.", "01.", "0-9 +(", "@.-a1", "é+. 5", "0123456789 -"])) for _ in range(rng.choice([5, 20, 60])))
        assert [s[:3] for s in sanitise.base_spans(t)] == slow_spans(t)
    assert [s[3] for s in sanitise.base_spans("A.b@C.example 010.2.3.4, 4111 1111-1111 1111; +1 (555) 010-9999")] == [
        "email:a.b@c.example", "ip:10.2.3.4", "card:4111111111111111", "phone:15550109999"]


@pytest.mark.parametrize("text", ["a", "1", "1 ", "1.", "@", "a@", "a@b", "a@b.", "+1(", "+"])
def test_base_spans_are_linear(text):
    began = time.process_time()
    sanitise.base_spans(text * (1_000_000 // len(text)) + "x")
    assert time.process_time() - began < 5


def slow_private(rows, width=8, most=0.8, least=3, letters=3):
    """Base spans and terms of each row, by plain counting."""
    word = re.compile(r"[^\W_]+")
    docs = []
    for _, t in rows:
        t = t or ""
        base = [s for s in sanitise.base_spans(t)]
        covered = {i for _, s, e, _ in base for i in range(s, e)}
        free = [m for m in word.finditer(t) if not covered & set(range(*m.span()))]
        near = []
        for _, s, _, entity in base:
            around = [m for m in free if m.start() < s][-width:] + [m for m in free if m.start() >= s][:width]
            context = " ".join(m.group().lower() for m in around)
            near += [(entity, m.group().lower(), m.start(), m.end(), context) for m in around]
        words = {m.group().lower() for m in word.finditer(t)}
        docs.append((base, near, words | {w[:letters] + "*" for w in words}))
    n = len(rows)
    holds, has, both, contexts, both_general = Counter(), Counter(), defaultdict(set), defaultdict(set), defaultdict(set)
    for i, (base, near, words) in enumerate(docs):
        holds.update({s[3] for s in base})
        has.update(words)
        for entity, term, _, _, context in near:
            both[entity, term].add(i)
            contexts[entity, term].add(context)
            both_general[entity, term[:letters] + "*"].add(i)

    def share(together, entity, term):
        return math.log(n * together / holds[entity] / has[term]) / math.log(n / holds[entity]) if holds[entity] < n else 0

    reveals = {}
    for (entity, term), where in both.items():
        if len(contexts[entity, term]) >= least and share(len(where), entity, term) >= most:
            general = term[:letters] + "*"
            fine = len(term) > letters and share(len(both_general[entity, general]), entity, general) < most
            reveals[entity, term] = general if fine else None
    out = []
    for base, near, _ in docs:
        spans = defaultdict(list)
        for entity, term, s, e, _ in near:
            if (entity, term) in reveals:
                spans[s, e].append(reveals[entity, term])
        out.append((base, [(s, e, None if None in g else min(g)) for (s, e), g in sorted(spans.items())]))
    return out


def private_rows():
    rng = random.Random(7)
    common = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(400):
        w = [rng.choice(common) for _ in range(30)]
        if i % 4 == 0:  # one person's address with the words that go with it in many different places
            w[10:10] = ["Zephyrine", "of", "Quillfort", "maria.k@mail.example.com", "Wordsmithy"]
        if i % 50 == 1:
            w[5:5] = ["call", "+49 30 1234567", "Wordsmithy" if i % 100 == 1 else "x"]
        rows.append((i, " ".join(w)))
    copies = " ".join(["Uniquely", "here", "solo@mail.example.com", "Onlyhere"] + common[:12])
    rows += [(1000 + i, copies) for i in range(30)]  # copies are one context: no evidence
    return rows + [(None, None), (None, ""), (7, rows[0][1]), (7, rows[0][1]), (None, "\U0001f600 maria.k@mail.example.com Zephyrine")]


def test_private_spans_equal_brute_force(spark):
    rows = private_rows()
    got = sanitise.private_spans(frame(spark, rows).repartition(5))
    mine = sorted((repr(r.doc_id), repr([tuple(s) for s in r.base]), repr([tuple(t) for t in r.terms])) for r in got.collect())
    want = sorted((repr(i), repr(base), repr(terms)) for (i, _), (base, terms) in zip(rows, slow_private(rows), strict=True))
    assert mine == want
    terms = Counter(t[2] for _, terms in slow_private(rows) for t in terms)
    assert terms[None] and terms["qui*"] == 0  # removed: nothing else begins so
    digest = {r.doc_id: r for r in sanitise.span_digest(got).collect()}
    assert digest[1000].spans == ",".join(f"{k}:{s}:{e}" for k, s, e in slow_spans(rows[400][1])) and digest[1000].n_email == 1
    assert digest[3].spans == "" and digest[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert ",term:" in digest[0].spans


def test_sanitised_texts_hide_entities_and_the_terms_that_reveal_them(spark):
    rows = private_rows() + [(5000 + i, f"wordplay quiver zest {i}") for i in range(600)]
    out = {r.doc_id: r.text for r in sanitise.sanitised(frame(spark, rows)).collect()}
    assert "[email]" in out[0] and not re.search("maria|zephyrine|quillfort", out[0], re.I)
    assert "wor*" in out[0] and "Wordsmithy" not in out[0]  # a class that many words share tells little
    assert out[1000].endswith("Onlyhere " + " ".join(f"word{i}" for i in range(12)))
    assert out[5001] == "wordplay quiver zest 1"
    assert sanitise.private_spans(frame(spark, [])).count() == 0


def test_private_spans_of_a_long_text(spark):
    """A row's context words come in pieces; every span is there once."""
    text = " ".join(f"word{i} m{i % 900}@mail.example.com" for i in range(1500))
    r = sanitise.private_spans(frame(spark, [(1, text), (2, "no data")])).collect()
    assert sorted(len(x.base) for x in r) == [0, 1500]
    assert sanitise.found_entities(frame(spark, [(1, text)])).filter("part > 0").count() > 0


# ---------------------------------------------------------------- periodic runs
def slow_runs(words, least=12):
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def slow_collapsed(words, runs):
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force_on_small_alphabets():
    rng = random.Random(2)
    for _ in range(1500):
        texts = []
        for _ in range(rng.randint(1, 4)):
            k, n = rng.choice([1, 2, 2, 3, 5]), rng.choice([0, 1, 5, 14, 30, 60, 90])
            w = [b"%d" % rng.randrange(k) for _ in range(n)]
            if rng.random() < 0.5 and n > 3:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 9)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        least = rng.choice([12, 12, 2, 3, 7])
        code, first = periodic._coded(texts)
        got = sorted((s - int(first[i]), e - s, p, i) for s, e, p in periodic.find_runs(code, least)
                     for i in [max(j for j in range(len(texts)) if first[j] <= s)])
        assert got == sorted((*r, i) for i, w in enumerate(texts) for r in slow_runs(w, least))


def test_runs_of_very_periodic_texts_take_n_log_n():
    a, b = b"a", b"ab"
    while len(b) < 200_000:
        a, b = b, b + a
    for text in ([b"a"] * 200_000, [bytes([c]) for c in b]):
        began = time.process_time()
        assert periodic.find_runs(periodic._coded([text])[0])
        assert time.process_time() - began < 30


def test_periodic_runs_of_documents(spark, smoke_dir):
    rows = smoke_rows(spark, smoke_dir) + [
        (None, None), (None, ""), (5, "a b " * 20 + "c"), (5, "a b " * 20 + "c"), (6, "x" * 300_000), (7, "z é\x1c  " * 30),
        (None, "one two\tthree\n" * 9)]
    got = periodic.periodic_runs(frame(spark, rows), rewrite=periodic.repeated_tail)

    def want(i, text):
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(i).encode())
        if i is not None and n and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        words = [w.decode() for w in words]
        runs = slow_runs(words)
        return repr(i), n, runs, slow_collapsed(words, runs)

    rows = [(i, t) for i, t in rows if len(t or "") < 40_000 or " " not in t]
    ids = {i for i, _ in rows}
    mine = sorted((repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect() if r.doc_id in ids)
    wanted = sorted(want(i, t) for i, t in rows)
    assert mine == wanted and any(len(w[2]) > 1 for w in wanted)
    digest = {(repr(r.doc_id), r.collapsed_sha256): r for r in periodic.run_digest(got).collect()}
    for i, _, runs, collapsed in wanted:
        r = digest[i, hashlib.sha256(collapsed.encode()).hexdigest()]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest()
        if runs:
            s, m, p = min(runs, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, m, p, 1000 * m // p)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert periodic.periodic_runs(frame(spark, [])).count() == 0
    assert got.select(F.sum("n_words")).first()[0] > 0
