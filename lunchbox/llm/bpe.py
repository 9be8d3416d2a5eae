"""BPE encoding and decoding with a contiguous rank array per word.

A text is split at special tokens, normalised, and split into words by the
tokenizer file's pattern.  Texts of characters below U+0300 are normalised and split here; those with others by the library's own
normaliser and splitter, whose Unicode tables (marks, categories of younger characters) aren't Python's.  A word starts as its bytes; the ids of its parts
and the ranks of neighbouring parts lie in two plain lists.  The least rank is found by a scan, the
boundary behind it deleted, and the two ranks beside it refreshed, until no
neighbours merge.  Words longer than ``LONG`` parts keep their ranks in a heap, as
a scan for each merge would take quadratic time there.  Each worker keeps
the ids of the words it has met, up to ``MOST_WORDS``.

The tokenizer file is read on the driver from a path that is a parameter, and
broadcast (a vocabulary: fixed size, not one that grows with the data).

Defined cases: null text is empty and has no ids; rows are encoded one by one,
so repeated rows repeat the result; a very long text is worked on whole, like any other; further columns don't matter;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from lunchbox.llm import spans
from lunchbox.llm.runtime import ship

LONG = 48
MOST_WORDS = 200_000
NONE = 1 << 60


# fixed by the vocabulary format
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one tokenizer file: BPE over byte symbols with a mark at the end of words."""

    def __init__(self, file: str):
        self.file = file
        spec = json.loads(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or model["unk_token"] or model["dropout"]:
            raise ValueError("a BPE tokenizer without decoder, unknown token and dropout is expected")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            pair_ids = self.vocab[left], self.vocab[right]
            self.merges.setdefault(pair_ids, (rank, self.vocab[left + right]))
        symbols = byte_symbols()
        self.inner = [self.vocab[s] for s in symbols]
        self.last = [self.vocab[s + self.suffix] for s in symbols]
        self.steps = [(s["type"], s.get("pattern", {}).get("Regex"), s.get("content")) for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"] or level["type"] != "ByteLevel" or level["use_regex"]:
            raise ValueError("words are expected to be the matches of a pattern")
        self.pattern = split["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in (*self.vocab.items(), *self.special.items()):
            self.tokens[i] = token
        self.known: dict[str, bytes] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "find", "cut", "blank", "other", "tool", "byte")}

    def __setstate__(self, state):
        self.__dict__.update(state, known={})

    def _ready(self) -> None:
        if not hasattr(self, "find"):
            space = r"\p{White_Space}"  # \s of other libraries takes control characters too
            self.find = regex.compile(self.pattern.replace(r"\s", space)).findall
            self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
            self.other = regex.compile(r"[^\x00-\u02FF]").search
            self.tool = Tokenizer.from_str(self.file)
            self.byte = {ord(s): b for b, s in enumerate(byte_symbols())}
            self.blank = {p: regex.compile(p.replace(r"\s", space)) for kind, p, _ in self.steps if kind == "Replace"}

    def _normal(self, text: str) -> str:
        for kind, pattern, content in self.steps:
            if kind == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif kind == "Replace":
                text = self.blank[pattern].sub(content, text)
            elif kind == "Lowercase":
                text = text.replace("Σ", "σ").lower()  # each character by itself, no final sigma
            else:
                raise ValueError(f"no normalizer {kind}")
        return text

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word."""
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return self._long(ids) if len(ids) > LONG else self._short(ids)

    def _short(self, ids: list[int]) -> list[int]:
        merges = self.merges
        ranks = [merges.get(pair, (NONE, 0))[0] for pair in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NONE:
            k = ranks.index(least)
            ids[k] = merges[ids[k], ids[k + 1]][1]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = merges.get((ids[k - 1], ids[k]), (NONE, 0))[0]
            if k < len(ranks):
                ranks[k] = merges.get((ids[k], ids[k + 1]), (NONE, 0))[0]
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(self.merges[p][0], k, *p) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            right = after[k]
            if ids[k] != a or right >= n or ids[right] != b:
                continue  # merged meanwhile
            ids[k], ids[right], after[k] = self.merges[a, b][1], -1, after[right]
            if after[k] < n:
                before[after[k]] = k
                pair = ids[k], ids[after[k]]
                if pair in self.merges:
                    heapq.heappush(heap, (self.merges[pair][0], k, *pair))
            if before[k] >= 0:
                pair = ids[before[k]], ids[k]
                if pair in self.merges:
                    heapq.heappush(heap, (self.merges[pair][0], before[k], *pair))
        return [i for i in ids if i >= 0]

    def _packed(self, text: str) -> bytes:
        known, out = self.known, []
        if self.other(text):
            pieces = self.tool.pre_tokenizer.pre_tokenize_str(self.tool.normalizer.normalize_str(text))
            words = (bytes(map(self.byte.__getitem__, map(ord, piece))) for piece, _ in pieces)
        else:
            words = self.find(self._normal(text))
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = np.array(self.word(word if isinstance(word, bytes) else word.encode()), "<u4").tobytes()
                if len(known) >= MOST_WORDS:
                    known.clear()
                if len(word) <= LONG:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        self._ready()
        if self.cut is None or "<" not in text:
            return self._packed(text)
        return b"".join(np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._packed(part)
                        for part in self.cut.split(text))

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids with a blank between them, as of a tokenizer without decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load(path: str) -> Bpe:
    with open(path, encoding="utf-8") as file:
        return Bpe(file.read())


def encoded(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every row; ``tokenizer``: path of its file."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(tokenizer))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in batches:
            for part in spans.chunks(batch):
                ids = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
                columns = [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                           pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                           pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids])]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
