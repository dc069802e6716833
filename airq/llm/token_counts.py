"""Token counts: rank-synchronous merging of ragged symbol arrays.

Counts the tokens a byte-level BPE vocabulary gives each text.  Texts are split
at special strings and then into pre-tokens by the vocabulary's pattern.  The
pre-tokens a batch hasn't met before are held as one ragged array: all their
symbols in a row, with row offsets.  Each round looks the rank of every adjacent
pair up, finds each row's lowest rank and merges that pair everywhere in its row
at once (leftmost first where occurrences overlap).  Rows without a ranked pair
leave the array; what is left of a row is its tokens, and only their number is
kept.  Merging lowest rank first is what BPE does one pair at a time: a pair
that a merge creates holds the merged symbol, so it ranks after that merge.

Each task reads its own rows once, without a shuffle; per-worker memory is one
slice of texts plus a bounded cache of pre-token counts (``CACHE`` entries, a
speed-up only).

Edge cases: a null text counts as empty (0 bytes, 0 tokens); very long texts and
pre-tokens are counted whole; repeated rows are counted each; an empty table gives
an empty result; extra columns aren't read.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .text import KeyTable, raw, slices, string_column

VOCABULARY = "byte_bpe_50k.json"
CACHE = 400_000
ROWS = 8192  # pre-tokens per array, so that a round's arrays stay in the processor's cache
LIMIT = 1024
# The pattern of byte-level BPE pre-tokens (fixed value of the vocabulary's format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

# The same split with the standard module's faster classes, used for texts in
# which both modules classify every character alike.
QUICK = r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable stand-ins byte-level vocabularies write bytes with: printable
    Latin-1 bytes stand for themselves, the others for code points from 256 up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks of a tokenizers JSON file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError("not a byte-level BPE vocabulary without normalisation")
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bytes = np.zeros(256, np.int64)
        for letter, b in byte_letters().items():
            self.bytes[b] = vocab[letter]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.rank_of = KeyTable(key)
        self.made = np.append(made, 0)
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special strings with stripping or normalisation aren't supported")

    def count(self, tokens: list[str]) -> np.ndarray:
        """Number of symbols each pre-token is left with."""
        col = pa.array(tokens, pa.string())


        buf, off = raw(col)
        sym = self.bytes[buf]
        size = np.diff(off)
        out = np.zeros(len(tokens), np.int64)
        row = np.repeat(np.arange(len(tokens)), size)
        never = len(self.made) - 1
        # rank of each symbol's pair with its right neighbour in the same row
        rank = np.full(len(sym), never)
        if len(sym) > 1:
            rank[:-1] = np.where(row[:-1] == row[1:], self.rank_of.find((sym[:-1] << 32) | sym[1:]), never)
        while len(sym):
            begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            low = np.minimum.reduceat(rank, begin)
            width = np.diff(np.append(begin, len(sym)))
            done = low == never
            out[row[begin[done]]] = width[done]
            hit = np.flatnonzero(rank == np.repeat(np.where(done, -1, low), width))
            if len(hit):
                # occurrences that overlap (aaa): every second one of a run of neighbours
                run = np.concatenate([[True], np.diff(hit) != 1])
                head = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - head) % 2 == 0]
                sym[hit] = self.made[rank[hit]]
            keep = ~np.repeat(done, width)
            keep[hit + 1] = False
            at = np.cumsum(keep) - 1
            sym, row, rank = sym[keep], row[keep], rank[keep]
            # only pairs with a merged symbol have a new rank
            hit = at[hit]
            fresh = np.concatenate([hit, hit[hit > 0] - 1])
            inner = fresh < len(sym) - 1
            rank[fresh[~inner]] = never
            fresh = fresh[inner]
            rank[fresh] = np.where(row[fresh] == row[fresh + 1], self.rank_of.find((sym[fresh] << 32) | sym[fresh + 1]), never)
        return out


class Counter:
    """Token counts of whole texts, with a bounded cache of pre-token counts."""

    def __init__(self, path: str):
        import regex

        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(PATTERN).findall
        self.quick = re.compile(QUICK).findall
        # characters below 0x250 that both pattern modules put into the same class
        same = [c for c in map(chr, range(0x250)) if [bool(regex.match(p, c)) for p in (r"\p{L}", r"\p{N}", r"\p{White_Space}")]
                == [bool(re.match(p, c)) for p in (r"[^\W\d_]", r"\d", r"\s")]]
        self.odd = re.compile("[^" + "".join(map(re.escape, same)) + "]").search
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        found, extra, new = [], [], set()
        known = self.known
        for text in texts:
            parts = [text]
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
            tokens = []
            for part in parts:
                tokens += (self.split if self.odd(part) else self.quick)(part)
            found.append(tokens)
            extra.append(len(parts) - 1)
            new.update(tokens)
        new = [t for t in new if t not in known]
        if new:
            if len(known) + len(new) > CACHE:
                known.clear()
                new = list({t for tokens in found for t in tokens})
            new.sort(key=len)  # rows of one array then need about the same number of rounds
            for a in range(0, len(new), ROWS):
                part = new[a:a + ROWS]
                known.update(zip(part, self.vocabulary.count(part).tolist()))
        return [sum(map(known.__getitem__, tokens)) + n for tokens, n in zip(found, extra)]


def count_tokens(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row.  ``vocabulary`` is the
    path of a tokenizers JSON file on every machine."""
    own = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        counter = None
        for batch in batches:
            counter = counter or Counter(vocabulary)
            col = string_column(batch.column("text"))
            counts = []
            for a, b in slices(col, 1 << 20):
                counts += counter.count(col.slice(a, b - a).to_pylist())
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pc.cast(pc.binary_length(col), pa.int64()), n,
                                              pc.greater(n, limit)], ["key", "n_bytes", "n_tokens", "over_limit"])

    return own.mapInArrow(run, f"key {own.schema['key'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
