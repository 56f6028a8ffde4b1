"""Token counts with a whole-token shortcut: proven one-token words are counted directly, the rest is merged."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import slices, worker_state

MAX_TOKENS = 2048
#: Characters of a long text that are counted at a time; distinct words that a worker remembers at a time.
PIECE = 1 << 20
MEMORY = 400_000
#: Python splits at these separators, the tokenizer's white space doesn't have them (U+0085 kept with them to be safe).
_ODD = re.compile("[\x1c-\x1f\x85]")


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proven to encode alone as one token.

    Of a vocabulary with word ends, each string that ends a word is encoded by the library itself, without its end mark;
    those that give exactly the one id are kept.
    """
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)["model"]
    end = spec.get("end_of_word_suffix") or ""
    tokenizer = Tokenizer.from_file(path)
    words = {t[:-len(end)] if end else t: i for t, i in spec["vocab"].items() if t.endswith(end) and t != end}
    words = {w: i for w, i in words.items() if w.isascii() and not any(c.isspace() for c in w)}
    names = list(words)
    return frozenset(w for w, e in zip(names, tokenizer.encode_batch(names, add_special_tokens=False), strict=True) if e.ids == [words[w]])


# The normalizer and pre-tokenizer, as the vocabulary's file states them, for which the word-by-word count holds.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class Counter:
    """Counts the tokens of a text as the library does, word by word.

    The tokenizer drops white space and no token crosses it, so a text's count is the sum over its words (runs without
    white space). A word that is one of the proven strings counts one; ASCII words are cut into pre-tokens, of which
    proven ones count one each; what is left is merged by the library, once for each distinct word while it is remembered.
    Texts with separators on which Python and the tokenizer differ go to the library whole, and so do all texts of a tokenizer that
    normalizes or cuts in another way.
    """

    #: The tokenizer's own pre-token pattern, for ASCII words in lower case.
    PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")

    def __init__(self, path: str, proven: frozenset[str]) -> None:
        from tokenizers import Tokenizer
        self.tokenizer, self.proven = Tokenizer.from_file(path), proven
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", [])
        self.by_word = spec.get("normalizer") == NORMALIZER and spec.get("pre_tokenizer") == PRE_TOKENIZER and bool(spec["model"].get("end_of_word_suffix"))
        self.special = [t["content"] for t in added]
        # a special token cuts a text before anything else, so it can stand between words that are merged in one call
        self.mark = next(((t["content"], t["id"]) for t in added if t["special"] and not t["lstrip"] and not t["rstrip"]), None)
        self.known: dict[str, int] = {}

    def merge(self, words: list[str]) -> None:
        """Remembers the counts of words that aren't known yet."""
        if len(self.known) + len(words) > MEMORY:
            self.known.clear()
        left: list[str] = []
        owner: list[str] = []
        for w in words:
            if any(x in w for x in self.special):
                self.known[w] = self.library([w])[0]
                continue
            low = w.lower()
            if not w.isascii():
                self.known[w] = 0
                left.append(w)
                owner.append(w)
            elif low in self.proven:
                self.known[w] = 1
            else:
                parts = self.PRETOKEN.findall(low)
                rest = [p for p in parts if p not in self.proven]
                self.known[w] = len(parts) - len(rest)
                left += rest
                owner += [w] * len(rest)
        for w, n in zip(owner, self.merged(left), strict=True):
            self.known[w] += n

    def merged(self, words: list[str]) -> list[int]:
        """Token counts of words without special strings, many of them in one call."""
        if not self.mark:
            return self.library(words)
        out: list[int] = []
        for i in range(0, len(words), 512):
            e = self.tokenizer.encode_batch_fast([self.mark[0].join(words[i:i + 512])], add_special_tokens=False)[0]
            marks = np.flatnonzero(np.array(e.ids) == self.mark[1])
            out += (np.diff(np.concatenate([[-1], marks, [len(e.ids)]])) - 1).tolist()
        return out

    def library(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        if not self.by_word:
            return self.library([text])[0]
        total, at = 0, 0
        while at < len(text):  # a long text piece by piece, cut at a space or newline
            to = len(text) if len(text) - at <= PIECE else min((x for x in (text.find(" ", at + PIECE), text.find("\n", at + PIECE)) if x >= 0), default=len(text))
            part, at = text[at:to], to
            if _ODD.search(part):
                total += self.library([part])[0]
                continue
            words = part.split()
            new = [w for w in set(words) if w not in self.known]
            if new:
                self.merge(list(set(words)) if len(self.known) + len(new) > MEMORY else new)
            total += sum(map(self.known.__getitem__, words))
        return total


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > max_tokens) of every row of ``docs``.

    ``tokenizer``: path of a tokenizer with word ends that drops white space, on every executor. Special strings inside
    texts count as the library's default has it; none are added. A null or empty text has 0 bytes and 0 tokens. Rows with
    equal ids are returned each; an empty table gives an empty result; other columns aren't read.
    """
    proven = whole_tokens(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state()
        counter = state.get(("token counter", tokenizer)) or state.setdefault(("token counter", tokenizer), Counter(tokenizer, proven))
        for b in slices(batches):
            size, n = [], []
            for t in b.column(1):
                t = t.as_py() or ""
                size.append(len(t.encode("utf-8", "surrogatepass")))
                n.append(counter.count(t))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                                              pa.array([x > max_tokens for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
