"""Byte-level BPE by a pair occurrence index.

The distinct words of a partition's block of texts are laid out as one linked
list of symbols. Every pair of neighbours that has a rank is put in the list of its
rank; the active ranks are taken in ascending order, all valid occurrences of
one rank are merged at once, and the pairs that a merge makes are added to
their own ranks' lists. Entries that another merge has outdated are recognised
by their symbols when their rank comes up.

In a trained vocabulary a pair ranks after the merges that make its two sides,
so the ranks of new pairs always lie ahead, and taking a rank's occurrences
together gives what the word-by-word algorithm gives. ``Vocabulary`` checks it.
"""

from __future__ import annotations

import collections
import functools
import hashlib
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bpe import SPACE
from marquee.llm.common import Scratch, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Bytes of text whose new words are indexed together.
BLOCK = 8 << 20


def byte_alphabet() -> list[str]:
    """The character for each byte: itself if it is a visible Latin-1 character, else the next one after U+00FF."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in seen else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and special strings of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]
                or any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))):
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        vocab = model["vocab"]
        self.size = 1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])])
        alphabet = byte_alphabet()
        self.of_byte = np.array([vocab[c] for c in alphabet], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = [vocab[a] for a, _ in pairs]
        self.right = [vocab[b] for _, b in pairs]
        self.made = [vocab[a + b] for a, b in pairs]
        born = {m: r for r, m in enumerate(self.made)}
        if len(born) < len(pairs) or any(max(born.get(a, -1), born.get(b, -1)) >= r
                                         for r, (a, b) in enumerate(zip(self.left, self.right))):
            raise ValueError(f"{path}: a merge ranks before one that makes its sides")
        keys = np.array(self.left, np.int64) * (self.size + 1) + np.array(self.right, np.int64)
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]
        byte = {c: b for b, c in enumerate(alphabet)}
        self.raw = [b""] * self.size
        for s, i in vocab.items():
            self.raw[i] = bytes(map(byte.__getitem__, s))
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a[k] for a in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: special strings that take their surroundings in")
        for s, i in self.special.items():
            self.raw[i] = s.encode()
        found = sorted(self.special, key=len, reverse=True)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None
        self.path = path

    def ranks(self, key: np.ndarray) -> np.ndarray:
        """Rank of each pair key, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, each merged on its own, and where each word's begin (and the last one's end)."""
        end, wide = self.size, self.size + 1        # end: the symbol between words, in no pair
        # the mark between words becomes the byte FF, which no text has in UTF-8
        raw = np.frombuffer("\udcff".join(["", *words, ""]).encode("utf-8", "surrogateescape"), np.uint8)
        sym = np.append(self.of_byte[:255], end).astype(np.int32)[raw]
        after = np.arange(1, len(sym) + 1, dtype=np.int32)
        after[-1] = len(sym) - 1
        before = np.arange(-1, len(sym) - 1, dtype=np.int32)
        before[0] = 0

        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Adds pairs that start at these places to their ranks' lists."""
            rank = self.ranks(sym[at].astype(np.int64) * wide + sym[after[at]])
            known = rank >= 0
            at, rank = at[known], rank[known]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            first = np.append(0, np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist()
            for r, i, j in zip(rank[first].tolist(), first, [*first[1:], len(at)]):
                if r in lists:
                    lists[r].append(at[i:j])
                else:
                    lists[r] = [at[i:j]]
                    heapq.heappush(active, r)

        for lo in range(0, len(sym), 1 << 20):
            enter(np.arange(lo, min(lo + (1 << 20), len(sym)), dtype=np.int32))
        while active:
            r = heapq.heappop(active)
            got, a, b, new = lists.pop(r), self.left[r], self.right[r], self.made[r]
            p = got[0] if len(got) == 1 else np.concatenate(got)
            p = p[(sym[p] == a) & (sym[after[p]] == b)]
            if not len(p):
                continue
            if a == b and len(p) > 1:               # runs of one symbol pair off from the left
                p = np.sort(p)
                head = np.append(True, after[p[:-1]] != p[1:])
                n = np.arange(len(p))
                p = p[(n - n[head][np.cumsum(head) - 1]) % 2 == 0]
            q = after[p]
            n = after[q]
            sym[p], sym[q] = new, -1
            after[p], before[n] = n, p
            left = before[p]
            enter(np.concatenate((left[sym[left] != new], p)))
        sym = sym[sym >= 0]
        cut = np.flatnonzero(sym == end)
        return sym[sym != end].astype("<u4"), cut - np.arange(len(cut))


@functools.cache
def vocabulary(path: str = TOKENIZER) -> Vocabulary:
    return Vocabulary(path)


# ------------------------------------------------------------- pre-tokenising

@functools.cache
def _pattern():
    p = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]")
    return regex.compile(p.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))


@functools.cache
def _unsettled():
    """Finds characters whose class (letter, number, other) is not the same in
    every Unicode version since 3.2: libraries may disagree on them."""
    old, runs = unicodedata.ucd_3_2_0, []
    for c in range(0x110000):
        a, b = old.category(chr(c)), unicodedata.category(chr(c))
        if a == "Cn" or (a[0] != b[0] and ("L" in a + b or "N" in a + b)):
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in runs) + "]")


@functools.cache
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).pre_tokenizer


def pre_tokens(text: str, path: str = TOKENIZER) -> list[str]:
    """The runs that are merged each on its own. Texts with characters that
    Unicode versions class differently are cut by the library itself."""
    if text.isascii():
        if text.isalpha() or (text[0] == " " and text[1:].isalpha()):
            return [text]
    elif _unsettled().search(text):
        return [text[a:b] for _, (a, b) in _library(path).pre_tokenize_str(text)]
    return _pattern().findall(text)


_ODD = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


class Units:
    """Numbers of a block's distinct units. A unit is what lies between two
    places where a visible character meets a space, which pre-tokens never
    cross; a special string is one too."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        number = itertools.count().__next__
        self.plain, self.spaced, self.special = (collections.defaultdict(number) for _ in range(3))

    def _numbers(self, text: str) -> list[int]:
        if not text:
            return []
        if text[0] == " " or _ODD.search(text):
            return list(map(self.plain.__getitem__, _CUT.split(text)))
        first, *rest = text.split(" ")
        return [self.plain[first], *map(self.spaced.__getitem__, rest)]

    def numbers(self, text: str) -> np.ndarray:
        if any(s in text for s in self.vocab.special):
            out = []
            for i, part in enumerate(self.vocab.cut_special.split(text)):
                out += [self.special[part]] if i % 2 else self._numbers(part)
        else:
            out = self._numbers(text)
        return np.array(out, np.int32)

    def ids(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all units; by their numbers, where each unit's begin and how many they are."""
        words: list[str] = []
        number = np.fromiter(itertools.chain(self.plain.values(), self.spaced.values(), self.special.values()), np.int64,
                             len(self.plain) + len(self.spaced) + len(self.special))
        ends = np.zeros(len(number) - len(self.special) + 1, np.int64)
        for i, u in enumerate(itertools.chain(self.plain, map(" ".__add__, self.spaced)), 1):
            words += pre_tokens(u, self.vocab.path)
            ends[i] = len(words)
        ids, at = self.vocab.encode_words(words)
        own = np.array([self.vocab.special[s] for s in self.special], "<u4")
        bounds = np.append(at[ends], len(ids) + 1 + np.arange(len(own)))
        start, size = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
        start[number], size[number] = bounds[:-1], np.diff(bounds)
        return np.append(ids, own), start, size


def encode_block(texts: list[str], path: str = TOKENIZER) -> list[bytes]:
    """Ids of each text: the block's distinct units are merged in one index and dealt out by their numbers."""
    block = Units(vocabulary(path))
    docs = [block.numbers(t) for t in texts]
    ids, start, size = block.ids()
    out = []
    for d in docs:
        n = size[d]
        ends = np.cumsum(n)
        out.append(ids[np.arange(ends[-1] if len(d) else 0) + np.repeat(start[d] - ends + n, n)].tobytes())
    return out


def blocks(texts: Iterable[str], size: int = BLOCK) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters; a text is never split."""
    block, n = [], 0
    for t in texts:
        block.append(t)
        n += len(t)
        if n >= size:
            yield block
            block, n = [], 0
    if block:
        yield block


def encode_column(path: str = TOKENIZER, block: int = BLOCK):
    """A column function: text -> ids of the whole text, little-endian unsigned 32-bit."""
    @F.pandas_udf("binary")
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series([x for b in blocks((t or "" for t in texts), block) for x in encode_block(b, path)], dtype=object)

    return one


def decode_ids(ids: bytes, path: str = TOKENIZER) -> str:
    """The text of the ids, special strings included; bytes that are no UTF-8 become U+FFFD."""
    raw = vocabulary(path).raw
    return b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def decode_column(path: str = TOKENIZER):
    """A column function: ids -> text."""
    @F.pandas_udf("string")
    def one(ids: pd.Series) -> pd.Series:
        return ids.map(lambda b: decode_ids(b, path) if b is not None else None)

    return one


def encode(docs: DataFrame, out: str, text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """``docs`` with a binary column ``out``: the ids of the whole text.

    As the tokenizers library does without special tokens of its own, padding
    or truncation: a special string in a text is its special id. A null or
    empty text has no ids; repeated rows are encoded alike; texts of any length
    are encoded whole; an empty table stays empty. All other columns stay;
    ``out`` must not be one of them. Nothing is shuffled."""
    return docs.withColumn(out, encode_column(path)(F.col(text)))


def _digest(path: str = TOKENIZER):
    @F.pandas_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def one(ids: pd.Series) -> pd.DataFrame:
        rows = []
        for b in ids:
            a = np.frombuffer(b, "<u4").tolist()
            rows.append((len(a), hashlib.sha256(",".join(map(str, a)).encode()).hexdigest(),
                         hashlib.sha256(decode_ids(b, path).encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return one


def q_op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the pair index, decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "op12") as s:
        got = encode(docs, "ids").select("doc_id", _digest()("ids").alias("d"))
        return s.keep(got.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256"), result=True)
