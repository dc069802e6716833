import re

import numpy as np
import pyarrow as pa

from airq.llm import text as T
from airq.llm.text import KeyTable

TEXTS = ["", "  ", "Abc déf\tX", "one", "\n a  b\x0bc\x0c ", "ÀÉ É x", "end ", "a b c d e f g", "z" * 3000]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def test_words_match_regular_expression():
    w = T.words(pa.array(TEXTS))
    got = [w.buf[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
    want = [re.findall(r"[^\x20\x09-\x0d]+", lower(t)) for t in TEXTS]
    assert got == [x for ws in want for x in ws]
    assert np.diff(w.first).tolist() == [len(ws) for ws in want]


def test_equal_words_have_equal_hashes_only():
    w = T.words(pa.array(["ab ba ab aab", "ab " + "ba" * 50]))
    words = [w.buf[a:b].tobytes() for a, b in zip(w.start, w.end)]
    assert len(set(words)) == len(set(w.hash.tolist()))
    assert w.hash[0] == w.hash[2] == w.hash[4]


def test_shingles_depend_on_order_and_short_texts_are_one():
    h, first = T.shingles(T.words(pa.array(["a b c d e f", "b c d e f", "f e d c b", "a b", "b a", ""])), 5)
    assert np.diff(first).tolist() == [2, 1, 1, 1, 1, 0]
    assert h[1] == h[2] and len(set(h.tolist())) == 5


def test_slices_cover_all_rows():
    col = pa.array(["x" * n for n in (0, 5, 100, 3, 0, 7)])
    parts = list(T.slices(col, 8))
    assert parts[0][0] == 0 and parts[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_key_tables_find_all_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, 5000).astype(np.uint64))
    index = T.KeyIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1), missing=True) == -1).mean() > 0.99
    pairs = np.unique(rng.integers(0, 1 << 40, 3000))
    table = KeyTable(pairs)
    assert (table.find(pairs) == np.arange(len(pairs))).all() and (table.find(pairs + (1 << 50)) == len(pairs)).all()
