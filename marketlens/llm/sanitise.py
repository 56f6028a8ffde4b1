"""Personal data: spans found by pattern, and the terms near them that give them away by what the corpus tells.

An information-theoretic sanitiser: how much a term reveals of a protected entity is their pointwise mutual information over
the corpus, set against the entity's own information. Terms above a threshold are generalised, or removed where the
generalisation reveals too much as well.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, written

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that are weighed.
CONTEXT_WORDS = 8
#: Share of an entity's information that a term may reveal, and the different contexts that an estimate needs at least.
MAX_DISCLOSURE, MIN_CONTEXTS = 0.8, 3
#: Code points that a generalised term keeps.
GENERAL_LETTERS = 3
#: Bits of the filter that tells words that aren't weighed: 2 MB whatever the tables' size.
FILTER_BITS = 24
#: Words that a task counts before it passes them on, and context terms of a row.
MEMORY, PIECE = 300_000, 4096

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# Runs that can't give a match are passed at once: none of these goes back into a run, nor begins inside one.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, entity) of all e-mail and IP addresses, card and phone numbers, by kind and start.

    Offsets are code points. Per kind the leftmost matches that don't overlap, those that fail its check dropped.
    The entity names what the span stands for: its kind with the address in lower case or the digits alone.
    """
    out = [("email", s, e, "email:" + text[s:e].lower()) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", *m.span(), "ip:" + ".".join(parts)))
    for kind, pattern, low, high in (("card", _CARD, 13, 19), ("phone", _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = _DIGITS.sub("", m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span(), f"{kind}:{digits}"))
    return out


def _near(text: str, base: list[tuple[str, int, int, str]], width: int) -> Iterator[tuple[str, str, int, int, int]]:
    """(entity, term, start, end, context) of the words within ``width`` words of each span, those inside spans left out.

    ``context`` is a number for the entity's whole surroundings, so that copies of a passage are one context.
    """
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    begin = np.array([s for s, _ in words], np.int64)
    taken = np.zeros(len(text) + 1, np.int32)
    for _, s, e, _ in base:
        taken[s] += 1
        taken[e] -= 1
    inside = np.append(0, np.cumsum(np.cumsum(taken)[:-1] > 0))
    free = [i for i, (s, e) in enumerate(words) if inside[e] == inside[s]]
    begin = begin[free]
    for _, s, e, entity in base:
        at = int(np.searchsorted(begin, s))
        near = [words[i] for i in free[max(0, at - width):at + width]]
        terms = [text[a:b].lower() for a, b in near]
        context = zlib.crc32(" ".join(terms).encode("utf-8", "surrogatepass"))
        for (a, b), term in zip(near, terms, strict=True):
            yield entity, term, a, b, context


def found_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = CONTEXT_WORDS,
                   keep_text: bool = False) -> DataFrame:
    """doc_id, row, part, base (kind, start, end, entity), near (entity, term, start, end, context) and, if asked for, text.

    One row per row of ``docs`` (part 0) and more where a text has many words near entities. ``row`` numbers the rows.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("entity", pa.string())]))
    word = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("context", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], span),
                 pa.array(cols[4], word), pa.array(cols[5], pa.string())], ["doc_id", "row", "part", "base", "near", "text"])

        for b in batches:
            id_type, rows, size = b.column(0).type, [], 0
            for i, r, t in zip(b.column(0), b.column(1), b.column(2), strict=True):
                text, piece, part = t.as_py() or "", [], 0
                base = base_spans(text)
                kept = [dict(zip(("kind", "start", "end", "entity"), s, strict=True)) for s in base]
                for n in _near(text, base, width) if base else ():
                    if len(piece) == PIECE:
                        rows.append((i.as_py(), r.as_py(), part, kept if part == 0 else [], piece, t.as_py() if keep_text and part == 0 else None))
                        piece, part, size = [], part + 1, size + PIECE
                    piece.append(dict(zip(("entity", "term", "start", "end", "context"), n, strict=True)))
                rows.append((i.as_py(), r.as_py(), part, kept if part == 0 else [], piece, t.as_py() if keep_text and part == 0 else None))
                size += len(piece) + len(kept) + 1
                if size > 8 * PIECE:
                    yield batch(rows)
                    rows, size = [], 0
            yield batch(rows)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.monotonically_increasing_id().alias(free_name(docs, "row")), text_col).mapInArrow(
        run, f"doc_id {kind}, row bigint, part int, base array<struct<kind string, start bigint, end bigint, entity string>>, "
             "near array<struct<entity string, term string, start bigint, end bigint, context bigint>>, text string")


def _general(term: Column | str, letters: int) -> Column:
    """The class that a term is generalised to: its first code points and a star."""
    return F.concat(F.substring(term, 1, letters), F.lit("*"))


def _filter(terms: DataFrame) -> bytes:
    """A bit for the CRC-32 of each term. Tasks send their own set bits' words, at most the filter's size."""
    h = F.crc32(F.encode("term", "UTF-8")).bitwiseAND((1 << FILTER_BITS) - 1)
    words = terms.select(h.alias("h")).select(F.shiftright("h", 6).alias("w"), F.expr("shiftleft(1L, cast(h & 63 AS INT))").alias("bit"))
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for w, b in words.groupBy("w").agg(F.bit_or("bit")).collect():
        bits[w] = b
    return np.unpackbits(bits.view(np.uint8), bitorder="little").tobytes()


def document_counts(docs: DataFrame, terms: DataFrame, text_col: str = "text", letters: int = GENERAL_LETTERS) -> DataFrame:
    """term, n: the rows of ``docs`` that hold each of ``terms`` (words, or classes with a star) and perhaps a few terms more.

    Words are counted in each task first; a filter of fixed size leaves out most that aren't asked for.
    """
    known, mask = _filter(terms), (1 << FILTER_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        asked: dict[str, bool] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["term", "n"])
            total.clear()
            return out

        def wanted(term: str) -> bool:
            ok = asked.get(term)
            if ok is None:
                if len(asked) > MEMORY:
                    asked.clear()
                ok = asked[term] = bool(known[zlib.crc32(term.encode("utf-8", "surrogatepass")) & mask])
            return ok

        for b in batches:
            for t in b.column(0):
                words = {w.lower() for w in set(_WORD.findall(t.as_py() or ""))}
                total.update(filter(wanted, words))
                total.update(filter(wanted, {w[:letters] + "*" for w in words}))
            if len(total) > MEMORY:
                yield flush()
        yield flush()

    return docs.select(text_col).mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text", max_disclosure: float = MAX_DISCLOSURE,
                     min_contexts: int = MIN_CONTEXTS, letters: int = GENERAL_LETTERS) -> DataFrame:
    """entity, term, disclosure, general of the terms that reveal more than ``max_disclosure`` of an entity near which they stand.

    With N rows, n(e) that hold the entity, n(t) the term, and n(e, t) the term near the entity, the term reveals
    PMI(e; t) = log(N n(e, t) / (n(e) n(t))) of the entity's information log(N / n(e)); ``disclosure`` is their ratio, 1 where
    the term occurs near the entity only. An estimate needs ``min_contexts`` different contexts. ``general`` is the term's
    class if that reveals no more than allowed, or null (then the term has to go). An entity in all rows has no information.
    """
    near = found.select("row", F.explode("near").alias("x")).select("row", "x.entity", "x.term", "x.context")
    met = near.groupBy("entity", "term").agg(F.countDistinct("row").alias("both"), F.countDistinct("context").alias("contexts"))
    met = written(met.filter(F.col("contexts") >= min_contexts).drop("contexts"), "met")
    classes = near.withColumn("general", _general("term", letters)).groupBy("entity", "general").agg(F.countDistinct("row").alias("both"))
    asked = met.select("entity", "term", _general("term", letters).alias("general"))
    n = written(document_counts(docs, asked.select("term").unionByName(asked.select(F.col("general").alias("term"))).distinct(),
                                text_col, letters), "term-rows")
    entities = found.select("row", F.explode("base.entity").alias("entity")).distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    rows = found.filter("part = 0").count()  # a single number

    def share(both: str, n_term: str) -> Column:
        own = F.log(F.lit(float(rows)) / F.col("n_entity"))
        return F.when(own > 0, F.log(F.lit(float(rows)) * F.col(both) / F.col("n_entity") / F.col(n_term)) / own)

    scored = met.join(n.withColumnRenamed("n", "n_term"), "term").join(entities, "entity").withColumn("disclosure", share("both", "n_term"))
    scored = scored.filter(F.col("disclosure") >= max_disclosure).withColumn("general", _general("term", letters))
    kind = classes.withColumnRenamed("both", "both_general").join(n.select(F.col("term").alias("general"), F.col("n").alias("n_general")), "general")
    scored = scored.join(kind, ["entity", "general"], "left")
    fine = share("both_general", "n_general") < max_disclosure
    return scored.select("entity", "term", "disclosure", F.when(fine & (F.length("term") > letters), F.col("general")).alias("general"))


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = CONTEXT_WORDS,
                  max_disclosure: float = MAX_DISCLOSURE, min_contexts: int = MIN_CONTEXTS, letters: int = GENERAL_LETTERS,
                  keep_text: bool = False) -> DataFrame:
    """doc_id, base, terms for every row of ``docs`` (and its text, if asked for).

    base: :func:`base_spans` (kind, start, end, entity). terms: start, end, general of each word near an entity that
    reveals it (:func:`disclosing_terms`), by start; of several entities' generalisations the shortest answer holds, removal
    before any. Texts without base spans have no terms. A null or empty text has no spans; rows with equal or null ids are returned
    each; an empty table gives an empty result; other columns aren't read.
    """
    found = written(found_entities(docs, id_col, text_col, width, keep_text), "entities")
    reveals = written(disclosing_terms(docs, found, text_col, max_disclosure, min_contexts, letters), "disclosing")
    near = found.select("row", F.explode("near").alias("x")).select("row", "x.entity", "x.term", "x.start", "x.end")
    hit = near.join(reveals.select("entity", "term", "general"), ["entity", "term"]).groupBy("row", "start", "end").agg(
        F.when(F.count_if(F.col("general").isNull()) == 0, F.min("general")).alias("general"))
    terms = hit.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "general"))).alias("terms"))
    out = found.filter("part = 0").join(terms, "row", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint,general:string>>")
    return out.select("doc_id", "base", F.coalesce("terms", none).alias("terms"), *(["text"] if keep_text else []))


def replaced(text: str, base: list, terms: list) -> str:
    """``text`` with ``[kind]`` for each base span (of overlapping ones the first) and each term's general form, or ``[...]``."""
    parts, at = [], 0
    spans = sorted([(s["start"], s["end"], f"[{s['kind']}]") for s in base] + [(t["start"], t["end"], t["general"] or "[...]") for t in terms])
    for start, end, form in spans:
        if start >= at:
            parts += [text[at:start], form]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """doc_id and the sanitised text of every row of ``docs`` (null stays null); see :func:`private_spans` for the options."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if t is None else replaced(t, s, x) for t, s, x in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    found = private_spans(docs, id_col, text_col, keep_text=True, **options)
    return found.select("doc_id", "text", "base", "terms").mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, text string")


def span_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of :func:`private_spans`; terms are spans of the kind ``term``."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    terms = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"]))
    return found.select("doc_id", *map(count, KINDS), F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
                        F.concat_ws(",", F.concat(base, terms)).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(private_spans(spark.read.parquet(f"{sf_dir}/documents.parquet")))
