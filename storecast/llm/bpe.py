"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

A batch of texts is cut into words by the vocabulary's pattern, each distinct
word is merged once.  The symbols of many words stand in one flat array; a round
looks all adjacent pairs up by binary search over the sorted pair keys, takes
for every word the pair of lowest rank, merges all its occurrences from the
left, and drops the words that have no pair left.  A word of over ``LONG``
symbols is merged with a heap instead, which is not quadratic in its length.

Equal to the tokenizers library with ``add_special_tokens=False`` and its
default treatment of special strings inside a text (they become their ids).
The words of a text with characters newer than Python's Unicode tables come
from the library's own pre-tokenizer.

``encode`` gives ids as little-endian unsigned 32-bit integers in a binary column, ``decode``
the text of such ids.  Edge cases: a null or empty text has no ids and decodes
to the empty text; repeated rows are encoded each; an empty table gives an
empty result; other columns pass through, one named like a result is replaced.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storecast.llm.common import add_columns, materialize

# Fixed value: how the byte-level vocabulary cuts a text before merging.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LONG = 2000
NONE = np.int32(2**31 - 1)
CACHE_WORDS = 350_000


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable
    Latin-1 characters for themselves, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [hidden.get(b, chr(b)) for b in range(256)]


class Bpe:
    """Tables of one vocabulary and a bounded cache of encoded words."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model, pre = d["model"], d["pre_tokenizer"]
        odd = [t for t in d["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if d["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or odd \
                or model["type"] != "BPE" or model["continuing_subword_prefix"] or model["end_of_word_suffix"]:
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        self.spec, vocab = spec, model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, new = (np.array([vocab[f(p)] for p in pairs], np.int64)
                            for f in (lambda p: p[0], lambda p: p[1], lambda p: p[0] + p[1]))
        born = np.full(max(vocab.values()) + 1, -1)
        born[new] = np.arange(len(new))
        if len(set(new.tolist())) < len(new) or (np.maximum(born[left], born[right]) >= np.arange(len(new))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        key = left << 32 | right
        order = np.argsort(key)
        self.keys, self.ranks, self.new = key[order], order.astype(np.int32), new[order].astype(np.int32)
        chars = byte_characters()
        self.byte_id = np.array([vocab[c] for c in chars], np.int32)
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))
                                 + ")") if self.special else None
        byte_of = {c: b for b, c in enumerate(chars)}
        words = {i: bytes(byte_of[c] for c in w) if all(c in byte_of for c in w) else w.encode()
                 for w, i in [*vocab.items(), *self.special.items()]}
        blob = [words.get(i, b"") for i in range(max(words) + 1)]
        self.size = np.array([len(b) for b in blob], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(blob), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.index = {w: i for i, w in enumerate(self.special)}
        self.ids = np.array([*self.special.values()], np.int32)
        self.end = np.arange(1, len(self.ids) + 1, dtype=np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For adjacent symbols: the place of the pair in the tables, and if it is there."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, self.keys[at] == key

    def rounds(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left, and their words, when no pair can be merged; words ascend."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            at, hit = self.find(sym[:-1], sym[1:])
            hit &= word[1:] == word[:-1]
            rank = np.append(np.where(hit, self.ranks[at], NONE), NONE)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.append(first, len(word)))
            low = np.minimum.reduceat(rank, first)
            best = np.repeat(low, size)
            pos = np.flatnonzero((rank == best) & (rank < NONE))
            # of overlapping occurrences every other one, from the left
            run = np.flatnonzero(np.r_[True, pos[1:] != pos[:-1] + 1]) if len(pos) else pos
            pos = pos[(np.arange(len(pos)) - np.repeat(run, np.diff(np.append(run, len(pos))))) % 2 == 0]
            keep = np.ones(len(sym), bool)
            sym = sym.copy()
            sym[pos] = self.new[at[pos]]
            keep[pos + 1] = False
            over = best == NONE
            done.append((sym[over], word[over]))
            keep &= ~over
            sym, word = sym[keep], word[keep]
        if not done:
            return sym, word
        sym, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def merge_long(self, sym: list[int]) -> list[int]:
        """One word by a heap of (rank, position)."""
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        at, hit = self.find(np.array(sym[:-1]), np.array(sym[1:]))
        heap = [(int(self.ranks[a]), i, sym[i], sym[i + 1], int(self.new[a])) for i, (a, h) in
                enumerate(zip(at.tolist(), hit.tolist(), strict=True)) if h]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and after[i] < len(sym):
                key = sym[i] << 32 | sym[after[i]]
                a = int(np.searchsorted(self.keys, key))
                if a < len(self.keys) and self.keys[a] == key:
                    heapq.heappush(heap, (int(self.ranks[a]), i, sym[i], sym[after[i]], int(self.new[a])))

        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= len(sym) or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = new, -1, after[j]
            if after[j] < len(sym):
                before[after[j]] = i
            push(before[i])
            push(i)
        return [s for s in sym if s >= 0]

    def learn_words(self, words: list[str]) -> None:
        """Encode words that the cache lacks."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(b) for b in raw], np.int64)
        short = size <= LONG
        sym = self.byte_id[np.frombuffer(b"".join(b for b, s in zip(raw, short, strict=True) if s), np.uint8)]
        ids, word = self.rounds(sym, np.repeat(np.flatnonzero(short), size[short]))
        n = np.bincount(word, minlength=len(words)).astype(np.int64)
        if not short.all():
            pieces = np.split(ids, np.cumsum(n)[:-1])
            for i in np.flatnonzero(~short).tolist():
                pieces[i] = np.array(self.merge_long(self.byte_id[np.frombuffer(raw[i], np.uint8)].tolist()), np.int32)
            ids, n = np.concatenate(pieces), np.array([len(p) for p in pieces])
        last = int(self.end[-1]) if len(self.end) else 0
        self.index.update(zip(words, range(len(self.end), len(self.end) + len(words)), strict=True))
        self.ids, self.end = np.concatenate([self.ids, ids]), np.concatenate([self.end, last + np.cumsum(n)])

    def words(self, text: str) -> list[str]:
        if self.cut is not None and any(s in text for s in self.special):
            return [w for part in self.cut.split(text) for w in ([part] if part in self.special else self.words(part))]
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return [text[s:e] for _, (s, e) in library(self.spec).pre_tokenizer.pre_tokenize_str(text)]
        return PATTERN.findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        words, until = [], [0]
        for t in texts:
            words += self.words(t)
            until.append(len(words))
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self.learn_words(list(dict.fromkeys(words[i] for i in missing)))
            at[missing] = [self.index[words[i]] for i in missing]
        end = self.end[at]
        start = np.where(at > 0, self.end[at - 1], 0)
        n = end - start
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(start - total[:-1], n) + np.arange(total[-1])]
        return np.split(ids, total[until][1:-1]) if len(texts) else []

    def decode(self, ids: np.ndarray) -> str:
        n = self.size[ids]
        total = np.cumsum(n)
        where = np.repeat(self.at[ids] - (total - n), n) + np.arange(total[-1] if len(total) else 0)
        return self.bytes[where].tobytes().decode("utf-8", "replace")


@lru_cache(2)
def tables(spec: str) -> Bpe:
    return Bpe(spec)


@lru_cache(2)
def library(spec: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(spec)


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, name: str = "ids", keep_text: bool = True) -> DataFrame:
    """``docs`` with the ids of every whole text (and without the text, if asked for);
    the vocabulary file is read by the driver."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(texts: pa.Array) -> list[pa.Array]:
        ids = tables(spec.value).encode([t or "" for t in texts.to_pylist()])
        return [pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())]

    return add_columns(docs, f"{name} binary", run, max_bytes=1 << 20, keep_text=keep_text)


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids of every row."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    kept = df.drop(name)
    out = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            texts = [tables(spec.value).decode(np.frombuffer(x or b"", "<u4")) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=out.names)

    return kept.mapInArrow(run, out)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Counts and digests of the ids of every text and of the text that they decode to.

    The ids are written before they are decoded: a task then runs one Python
    worker at a time."""
    coded = encode(docs.select("doc_id", F.col("text").cast("string").alias("text")), path, keep_text=False)
    return decode(materialize(coded, "bpe-ids", "zstd"), path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
