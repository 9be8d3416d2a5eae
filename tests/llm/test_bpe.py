import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lunchbox.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def test_ids_and_text_equal_the_library(library, texts):
    own = bpe.load(PATH)
    rng = random.Random(5)
    odd = ["", " ", "\n\t", "a<|endoftext|>B", "<|startoftext|><|endoftext|>", "ΑΣ ΟΔΟΣ", "İ", "it's I'LL", "x" * 3000, "ab12 345", "é", "\x1c\x85\xa0", "𝔘 🙂", "日本語"]
    odd += ["".join(chr(rng.choice([*range(32, 0x530), 10, 0x20AC, 0x4E2D])) for _ in range(40)) for _ in range(300)]
    for text in [t or "" for _, t in texts] + odd:
        want = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_all_characters_and_marks_equal_the_library(library):
    own = bpe.load(PATH)
    rng = random.Random(6)
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    marks = ["\u06da\u0899", "\u08ca\u1cd4", "\u1acb\u0a4d"]
    strings = ["".join(map(chr, rng.sample(every, 12))) for _ in range(2000)] + ["".join(map(chr, rng.sample(range(0x300, 0x3000), 12))) for _ in range(2000)]
    strings += ["".join(map(chr, range(a, a + 64))) for a in range(0, 0x300, 64)] + ["a" + chr(c) + "b" for c in range(0x300)] + marks
    for text in strings:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_long_words_and_short_ones_merge_alike():
    own = bpe.load(PATH)
    for word in ["thehereinandthe" * 12, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]:
        raw = word.encode()
        ids = [own.inner[b] for b in raw[:-1]] + [own.last[raw[-1]]]
        assert own._short(list(ids)) == own._long(list(ids))


def test_edges(library, edges, empty):
    rows = bpe.encoded(edges, PATH, with_ids=True).collect()
    want = {}
    for r in edges.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.setdefault(r.doc_id, []).append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                              hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(), ids))
    have = {}
    for r in rows:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    assert bpe.encoded(empty, PATH).count() == 0
