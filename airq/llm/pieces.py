"""SentencePiece encoding and decoding: distinct segmentations by Gumbel top-k.

A text's segmentations are the paths of a lattice: nodes between characters, edges
for the vocabulary's pieces.  Path probabilities follow from the pieces' weights
(`piece_weights`).  Giving every path its log-probability plus Gumbel noise and taking
the k largest draws k distinct paths without replacement.  The paths are never listed;
an A-star search over regions of paths finds the largest perturbed values:

* the largest value of a region has a Gumbel distribution around its log-mass, and the
  path that attains it is a draw from the region's distribution;
* taking that path out splits the region at each of its nodes into "same up to here,
  then another edge".  Each part's largest value is a Gumbel variable around the part's
  log-mass, cut off at the region's value;
* the part with the largest value is the next region.

The value that comes after the k-th, kappa, gives inclusion scores: a path of
log-probability p is among the k with probability 1 - exp(-exp(p - kappa)), so
dividing by that score makes estimates from the sample unbiased.

Pieces don't cross blanks, so a text's lattice is a chain of word lattices: each
distinct word's lattice is built once per slice of texts, and all texts of a slice go
through the search together in numpy, k rounds in all.  Random numbers are a hash of
the row's key, the round and the place, so a row's sample doesn't depend on
partitions, batches or retries.

`encode` emits one row per text and sample; `decode` turns ids back into text, and
`decode(encode(text))` is the text except that U+2581, which the vocabulary uses for
blanks, comes back as a blank.  Characters without a piece are spelt in byte pieces.

Edge cases: null and empty texts have the one empty segmentation (rank 1, no pieces,
probability 1); a text with fewer segmentations than k gives all of them (inclusion
score 1); repeated rows with equal keys and texts get equal samples; null keys are
hashed like any value; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .text import U64, KeyIndex, KeyTable, range_hashes, raw, returning_memory, slices, sorted_distinct, splitmix, string_column

MODEL = "piece_bpe_32k.model"
SAMPLES = 2
SHARPNESS = 1.0
BLANK = "▁"
RAISE = 3.0     # about what a character of a piece costs
SLICE = 1 << 20
NEAR = 12.0     # parts behind beginnings of at least this log-probability are always valued
HIGHEST = 38.0  # no perturbation is larger: numbers in (0, 1) have 53 bits


def _poly(cp: np.ndarray) -> np.ndarray:
    return splitmix(cp.astype(U64) + U64(77))


_BASE = U64(0x9E3779B97F4A7C15 | 1)


class Vocabulary:
    """Pieces of a SentencePiece model as hash tables over character strings."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        crossing = [text[i] for i in normal if re.search(f"[^{BLANK}]{BLANK}", text[i])]
        if crossing:
            raise ValueError(f"pieces that cross blanks aren't supported: {crossing[:3]}")
        # line breaks and tabs that no longer piece holds stand alone
        self.alone = np.zeros(256, bool)
        self.alone[[ord(c) for c in "\n\t\r" if not any(c in text[i] and len(text[i]) > 1 for i in normal)]] = True
        self.byte_id = np.full(256, -1, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(text[i][1:-1], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        weight = piece_weights(np.array([sp.get_score(i) for i in normal]), sharpness)
        self.longest = max(len(text[i]) for i in normal)
        # per length: hash table of the pieces' beginnings, and the place of the piece that is one (or -1)
        self.by_length = []
        self.piece, self.weight = np.array(normal, np.int32), weight
        place = {text[i]: k for k, i in enumerate(normal)}
        for size in range(1, self.longest + 1):
            begins = sorted({t[:size] for t in place if len(t) >= size})
            cps = np.frombuffer("".join(begins).encode("utf-32-le"), np.uint32).reshape(-1, size)
            with np.errstate(over="ignore"):
                h = (_poly(cps) * _BASE ** np.arange(size, dtype=U64)).sum(axis=1, dtype=U64)
            self.by_length.append((KeyTable(h), np.array([place.get(t, -1) for t in begins], np.int32)))
        # the same for single characters, by code point (the last entry: characters beyond)
        top = max(ord(t[0]) for t in place) + 1
        self.single, self.begins = np.full(top + 1, -1, np.int32), np.zeros(top + 1, bool)
        for t in place:
            self.begins[ord(t[0])] = True
            if len(t) == 1:
                self.single[ord(t)] = place[t]
        self.raised = np.exp(weight + RAISE * np.array([len(text[i]) for i in normal]))
        self.byte_weight = float(weight.min()) - 2.0
        raw = [bytes([int(t[1:-1], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else t.replace(BLANK, " ").encode() for i, t in enumerate(text)]
        self.piece_off = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)


def piece_weights(scores: np.ndarray, sharpness: float) -> np.ndarray:
    """Log weights of pieces.  Unigram models score by log-probability; merge models
    by minus the merge's rank, which Zipf's law turns into one: -log(rank + 2)."""
    ranks = bool((scores == np.round(scores)).all()) and scores.min() < -100
    return sharpness * (-np.log(2.0 - scores) if ranks else scores)


@dataclass
class Lattice:
    """Word lattices side by side: nodes, and edges ordered by start node."""

    node0: np.ndarray     # first node of each word
    node1: np.ndarray     # last node of each word
    first: np.ndarray     # per node: its edges are first[node] .. first[node + 1]
    end: np.ndarray       # per edge
    prob: np.ndarray
    upto: np.ndarray      # per edge: sum of its node's probabilities up to and with it
    logp: np.ndarray
    piece: np.ndarray     # per edge: piece id, or -1 - character for byte pieces


def build(words: list[str], v: Vocabulary) -> Lattice:
    cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return lattice(cp, np.fromiter(map(len, words), np.int64, len(words)), v)


def lattice(cp: np.ndarray, size: np.ndarray, v: Vocabulary) -> Lattice:
    """The lattices of words given by their code points and lengths."""
    base = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(cp))
    left = base[word + 1] - at                   # characters up to the word's end
    code = _poly(cp)
    longest = int(size.max(initial=0))
    clipped = np.minimum(cp, len(v.single) - 1)
    single = v.single[clipped]
    # per length: where pieces of it start, which, and how many shorter ones start there
    found, many = [], np.ones(len(cp), np.int32)
    live = np.flatnonzero(v.begins[clipped])
    h, power = code[live], U64(1)
    with np.errstate(over="ignore"):
        for n in range(2, min(v.longest, longest) + 1):
            more = np.flatnonzero(left[live] >= n)
            live, power = live[more], power * _BASE
            h = h[more] + code[live + n - 1] * power
            table, place = v.by_length[n - 1]
            k = table.find(h)
            hit = np.flatnonzero(k < table.n)
            live, h = live[hit], h[hit]          # the others begin no longer piece
            k = place[k[hit]]
            whole = np.flatnonzero(k >= 0)
            s = live[whole]
            found.append((s, k[whole], many[s]))
            many[s] += 1
    del code, h, clipped
    off = np.concatenate([[0], np.cumsum(many)])  # edges by start, then by length
    k, n = np.zeros(off[-1], np.int32), np.ones(off[-1], np.int32)
    k[off[:-1]] = single
    slots = []
    for size_, (s, place, before) in enumerate(found, 2):
        slot = off[s] + before
        k[slot], n[slot] = place, size_
        slots.append(slot)
    del found
    odd = np.flatnonzero(single < 0)             # spelt in bytes
    spelt = off[odd]
    k[spelt] = 0
    piece, raised = v.piece[k], v.raised[k]
    cps = cp[odd].astype(np.int64)
    piece[spelt] = -1 - cps
    spelt_w = (1 + (cps > 0x7F).astype(np.int64) + (cps > 0x7FF) + (cps > 0xFFFF)) * v.byte_weight
    raised[spelt] = np.exp(spelt_w + RAISE)
    node = (at + word).astype(np.int32)          # one extra node per word for its end
    nodes = len(cp) + len(size)
    degree = np.zeros(nodes + 1, np.int64)
    degree[node + 1] = many
    first = np.cumsum(degree)
    end = np.repeat(node, many) + n
    # mass from each node to its word's end, all words at once from the back; weights are raised
    # per character, so that the masses of usual words stay near 1
    back = np.argsort(left.astype(np.int16) if longest < 1 << 15 else left, kind="stable")     # small integers sort in linear time
    steps = np.searchsorted(left[back], np.arange(1, longest + 2))
    wide = many[back]
    new = np.concatenate([[0], np.cumsum(wide)])
    e = np.arange(off[-1]) + np.repeat(off[back] - new[:-1], wide)
    e_end, e_raised, e_node = end[e], raised[e], node[back]
    mass = np.ones(nodes)
    with np.errstate(over="ignore", under="ignore"):
        for a, b in zip(steps[:-1], steps[1:]):
            if a < b:
                x, y = new[a], new[b]
                mass[e_node[a:b]] = np.add.reduceat(e_raised[x:y] * mass[e_end[x:y]], new[a:b] - x)
    del e_raised
    if mass.min(initial=1) > 1e-250 and mass.max(initial=1) < 1e250:
        prob = raised * mass[end] / np.repeat(mass[node], many)
        logp = np.log(prob)
    else:                                        # very long or strange words: the same by logarithms
        w = v.weight[k]
        w[spelt] = spelt_w
        mass = np.zeros(nodes)
        for a, b in zip(steps[:-1], steps[1:]):
            if a < b:
                x, y = new[a], new[b]
                z, s = w[e[x:y]] + mass[e_end[x:y]], new[a:b] - x
                top = np.maximum.reduceat(z, s)
                mass[e_node[a:b]] = top + np.log(np.add.reduceat(np.exp(z - np.repeat(top, wide[a:b])), s))
        logp = w + mass[end] - np.repeat(mass[node], many)
        prob = np.exp(logp)
    del e, e_end
    upto = prob.copy()
    for slot in slots:                           # shorter edges of a node come first
        upto[slot] += upto[slot - 1]
    upto[off[1:] - 1] = 1.0
    node0 = base[:-1] + np.arange(len(size))
    return Lattice(node0, node0 + size, first, end, prob, upto, logp, piece)


def uniform(*parts) -> np.ndarray:
    """Numbers in (0, 1), a hash of integer arrays."""
    h = U64(0)
    for p in parts:
        h = splitmix(h ^ np.asarray(p).astype(U64))
    return _unit(h)


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _draw(lat: Lattice, word: np.ndarray, node: np.ndarray, noise: np.ndarray, step: int):
    """Random walks of word tokens from ``node`` to the words' ends; ``noise`` is a hash per
    token.  Returns (token positions, edges) of all moves, ordered by step, then by token."""
    token = np.arange(len(word))
    goal = lat.node1[word]
    live = np.flatnonzero(node < goal)
    if len(live) < len(token):
        token, node, goal, noise = token[live], node[live], goal[live], noise[live]
    found = []
    while len(token):
        u = _unit(splitmix(noise ^ U64(step)))
        edge = lat.first[node]
        more = np.flatnonzero(u > lat.upto[edge])
        while len(more):
            edge[more] += 1
            more = more[u[more] > lat.upto[edge[more]]]
        found.append((token.astype(np.int32), edge.astype(np.int32)))
        node, step = lat.end[edge], step + 1
        live = np.flatnonzero(node < goal)
        token, node, goal, noise = token[live], node[live], goal[live], noise[live]
    if not found:
        none = np.zeros(0, np.int32)
        return none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def sample(lat: Lattice, word: np.ndarray, first: np.ndarray, seed: np.ndarray, k: int):
    """The k largest perturbed paths of each text of a slice.

    ``word``: word of each token, ``first``: token offsets of the texts, ``seed``:
    one per text.  Yields per round (texts, their edge offsets, edges, log-probability,
    perturbed value), and at the end the value after the last (kappa) of all texts.
    """
    n = len(seed)
    text = np.repeat(np.arange(n), np.diff(first))
    place = np.arange(len(word)) - first[text]
    all_token = all_edge = np.zeros(0, np.int32)              # moves of all paths so far
    all_mask = np.zeros(0, np.int64)
    all_part = np.zeros(0)                                    # largest value of each part
    owner = np.zeros(0, np.int64)
    live = np.arange(n)
    seed = seed.astype(U64)
    mixed = splitmix(seed)
    noise = lambda tokens, rank: splitmix(mixed[text[tokens]] ^ splitmix(place[tokens].astype(U64) * U64(64) + U64(rank)))
    value = -np.log(-np.log(uniform(seed, 0, 1)))
    origin = np.full(n, -1, np.int64)                         # the move whose part is taken, -1: all paths
    path0 = np.zeros(n, np.int64)                             # where the origin's path starts among all moves
    for rank in range(1, k + 1):
        kept_t, kept_e, kept_m = (np.zeros(0, np.int64) for _ in range(3))
        whole = origin[live] < 0
        # tokens to draw from their start: all, or those after the origin's token
        begin = first[live].copy()
        at = live[~whole]
        if len(at):
            o = origin[at]
            begin[~whole] = all_token[o] + 1
            # moves before the origin stay
            size = o - path0[at]
            idx = np.arange(size.sum()) + np.repeat(path0[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            kept_t, kept_e = all_token[idx], all_edge[idx]
            kept_m = np.zeros(len(idx), np.int64)             # their parts are the origin's path's
            # another edge at the origin's node, among those not excluded
            token, used = all_token[o], all_mask[o]
            e0 = lat.first[_start(lat, all_edge[o])]
            out = lat.first[_start(lat, all_edge[o]) + 1] - e0
            free = np.zeros(len(at))
            for j in range(int(out.max())):
                ok = (j < out) & ((used >> j) & 1 == 0)
                free[ok] += lat.prob[e0[ok] + j]
            u = uniform(seed[at], rank, 2) * free
            pick, run = np.full(len(at), -1, np.int64), np.zeros(len(at))
            for j in range(int(out.max())):
                ok = (j < out) & ((used >> j) & 1 == 0)
                run[ok] += lat.prob[e0[ok] + j]
                # the last free edge takes what rounding leaves
                pick = np.where(ok & ((pick < 0) | (run - lat.prob[np.minimum(e0 + j, len(lat.prob) - 1)] < u)), j, pick)
            edge = e0 + pick
            kept_t, kept_e = np.concatenate([kept_t, token]), np.concatenate([kept_e, edge])
            kept_m = np.concatenate([kept_m, used | (1 << pick)])
            # the rest of the origin's token
            r_tok, r_edge = _draw(lat, word[token], lat.end[edge], noise(token, rank), 1)
            kept_t = np.concatenate([kept_t, token[r_tok]])
            kept_e = np.concatenate([kept_e, r_edge])
            kept_m = np.concatenate([kept_m, np.full(len(r_edge), -1)])
        size = first[live + 1] - begin
        tokens = np.arange(size.sum()) + np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        tok, edge = _draw(lat, word[tokens], lat.node0[word[tokens]], noise(tokens, rank), 0)
        t = np.concatenate([kept_t, tokens[tok]])
        # a token's moves are in path order already (the sort is stable)
        order = np.argsort(t, kind="stable")
        t, e = t[order], np.concatenate([kept_e, edge])[order]
        m = np.concatenate([kept_m, np.full(len(edge), -1)])[order]       # edges taken out at the move's node, -1: its own
        own = text[t]
        off = np.searchsorted(own, np.arange(n + 1))
        lp = lat.logp[e]
        run = np.concatenate([[0.0], np.cumsum(lp)])
        pre = run[:-1] - run[off[own]]
        logp = run[off[1:]] - run[off[:-1]]
        yield live, off, e, logp, value.copy()
        # parts of the region without this path
        part, mask = np.full(len(e), -np.inf), np.zeros(len(e), np.int64)

        def cut(at):
            node, gone, out = _start(lat, e[at]), lat.prob[e[at]], m[at]
            fresh = np.flatnonzero(out < 0)
            out[fresh] = np.int64(1) << (e[at[fresh]] - lat.first[node[fresh]])
            extra = np.flatnonzero((out & (out - 1)) != 0)
            if len(extra):
                gone[extra] = 0
                for j in range(int((lat.first[node[extra] + 1] - lat.first[node[extra]]).max())):
                    bit = extra[(out[extra] >> j) & 1 == 1]
                    gone[bit] += lat.prob[lat.first[node[bit]] + j]
            mask[at], rest = out, 1.0 - gone
            full = out == (1 << (lat.first[node + 1] - lat.first[node])) - 1
            ok = np.flatnonzero((out != 0) & ~full & (rest > 1e-13))
            at, rest = at[ok], rest[ok]
            phi, its = pre[at] + np.log(rest), value[own[at]]
            u = uniform(seed[own[at]], rank, 3, at - off[own[at]])
            part[at] = phi - np.log(np.exp(np.minimum(phi - its, 700.0)) - np.log(u))
            return at

        # a part's value is below its log-mass plus HIGHEST, and so below the text's k best where
        # the path's beginning up to it is improbable: those parts can never be taken
        near = cut(np.flatnonzero(pre > -NEAR))
        low = np.full(n, np.inf)
        np.minimum.at(low, own[near], part[near])
        low[np.bincount(own[near], minlength=n) < k] = -np.inf
        cut(np.flatnonzero((pre <= -NEAR) & (pre + HIGHEST >= low[own])))
        if rank == k:      # only kappa is left to find
            value = np.full(n, -np.inf)
            for of, p in ((owner, all_part), (own, part)):
                some = np.flatnonzero(p > -np.inf)
                np.maximum.at(value, of[some], p[some])
            break
        shift = len(all_edge)
        all_token, all_edge, all_mask = np.concatenate([all_token, t.astype(np.int32)]), np.concatenate([all_edge, e.astype(np.int32)]), np.concatenate([all_mask, mask])
        all_part, owner = np.concatenate([all_part, part]), np.concatenate([owner, own])
        start_of = np.concatenate([path_of, shift + off[own]]) if rank > 1 else off[own]
        path_of = start_of
        # the next region of each text: its part with the largest value
        value = np.full(n, -np.inf)
        some = np.flatnonzero(all_part > -np.inf)
        np.maximum.at(value, owner[some], all_part[some])
        live = np.flatnonzero(value > -np.inf)
        hit = some[all_part[some] == value[owner[some]]]
        origin = np.full(n, -1, np.int64)
        origin[owner[hit[::-1]]] = hit[::-1]
        path0 = np.where(origin >= 0, path_of[np.maximum(origin, 0)] if len(path_of) else 0, 0)
        all_part[origin[live]] = -np.inf
        if not len(live):
            break
    yield None, None, None, None, value


def _start(lat: Lattice, edge: np.ndarray) -> np.ndarray:
    """Start node of edges."""
    if not hasattr(lat, "_starts"):
        lat._starts = np.repeat(np.arange(len(lat.first) - 1, dtype=np.int32), np.diff(lat.first))
    return lat._starts[edge]


def _ids(edges: np.ndarray, off: np.ndarray, lat: Lattice, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of paths (characters without a piece become byte pieces)."""
    piece = lat.piece[edges]
    odd = np.flatnonzero(piece < 0)
    if not len(odd):
        return piece.astype(np.int32), off
    spelt = [chr(c).encode("utf-8", "surrogatepass") for c in (-1 - piece[odd]).tolist()]
    width = np.ones(len(piece), np.int64)
    width[odd] = [len(b) for b in spelt]
    end = np.concatenate([[0], np.cumsum(width)])
    out = np.repeat(piece, width).astype(np.int32)
    inside = np.repeat(piece < 0, width)
    out[inside] = v.byte_id[np.frombuffer(b"".join(spelt), np.uint8)]
    return out, end[off]


def units(col: pa.StringArray, v: Vocabulary):
    """The distinct words of texts (a run of blanks and what follows it; a blank is put before
    the first) as code points and lengths, the word of each token, and token offsets per text."""
    if pc.any(pc.match_substring(col, BLANK)).as_py():
        col = pc.replace_substring(col, BLANK, " ")
    lead = pc.if_else(pc.equal(col, pa.scalar("", col.type)), pa.scalar("", col.type), pa.scalar(" ", col.type))
    buf, off = raw(pc.binary_join_element_wise(lead, col, pa.scalar("", col.type)))
    blank, alone = buf == 0x20, v.alone[buf]
    begins = alone.copy()
    begins[1:] |= alone[:-1] | (blank[1:] & ~blank[:-1])
    begins[off[:-1][np.diff(off) > 0]] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(buf))[:len(start)]
    first = np.searchsorted(start, off)
    h = range_hashes(buf, start, end)
    keys = sorted_distinct(h)
    word = KeyIndex(keys).find(h)
    one = np.zeros(len(keys), np.int64)
    one[word] = np.arange(len(word))             # any occurrence of each
    size = (end - start)[one]
    edge = np.concatenate([[0], np.cumsum(size)])
    text = buf[np.arange(edge[-1]) + np.repeat(start[one] - edge[:-1], size)]
    cp = np.frombuffer(text.tobytes().decode().encode("utf-32-le"), np.uint32).copy()
    cp[cp == 0x20] = ord(BLANK)
    chars = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    return cp, np.diff(chars[edge]), word, first


def encode_slice(texts: list[str] | pa.StringArray, seeds: np.ndarray, v: Vocabulary, k: int):
    """Rows (text position, rank, log-probability, value, log inclusion score,
    id offsets, ids) of one slice of texts."""
    cp, size, word, first = units(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), v)
    lat = lattice(cp, size, v)
    rounds, kappa = [], None
    for live, off, edges, logp, value in sample(lat, word, first, seeds, k):
        if live is None:
            kappa = value
            break
        rounds.append((live, off, edges, logp, value))
    for rank, (live, off, edges, logp, value) in enumerate(rounds, 1):
        y = np.exp(np.clip(logp[live] - kappa[live], -700, 700))
        with np.errstate(divide="ignore"):
            inclusion = np.where(np.isneginf(kappa[live]), 0.0, np.where(y < 1e-12, logp[live] - kappa[live], np.log(-np.expm1(-y))))
        ids, end = _ids(edges, off, lat, v)
        yield live, rank, logp[live], value[live], inclusion, end, ids


SCHEMA = "rank int, n_pieces int, log_prob double, gumbel double, log_inclusion double, ids array<int>"


def encode(docs: DataFrame, id_col: str, text_col: str, model: str, samples: int = SAMPLES, seed: int = 3, keep: dict | None = None,
           seed_by: tuple[str, ...] = (), round_trip: bool = False) -> DataFrame:
    """(key, *keep, rank, n_pieces, log_prob, gumbel, log_inclusion, ids): up to
    ``samples`` distinct segmentations of every text.  ``keep`` maps names to Columns
    that each sample carries along; the columns ``seed_by`` seed a row together with its
    id.  With ``round_trip`` a last column of that name tells whether the ids, decoded in the same pass, give the text
    back.  ``model``: path on every machine."""
    keep = keep or {}
    own = docs.select(F.col(id_col).alias("key"), *[c.alias(n) for n, c in keep.items()],
                      F.coalesce(F.col(text_col), F.lit("")).alias("text_"), F.xxhash64(F.lit(seed), F.col(id_col), *map(F.col, seed_by)).alias("seed_"))
    names = ["key", *keep]

    @returning_memory
    def run(batches):
        v = None
        for batch in batches:
            v = v or Vocabulary(model)
            col = string_column(batch.column("text_"))
            seeds = batch.column("seed_").to_numpy().view(U64)
            for a, b in slices(col, SLICE):
                for live, rank, logp, value, inclusion, off, ids in encode_slice(col.slice(a, b - a), seeds[a:b], v, samples):
                    size = off[live + 1] - off[live]
                    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    if at[-1] != len(ids):
                        raise AssertionError("paths of texts that have ended")
                    rows = pa.array(live + a)
                    same = [pc.equal(decode_rows(ids, at.astype(np.int64), v), col.take(rows))] if round_trip else []
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(rows) for c in names), pa.array(np.full(len(live), rank, np.int32)), pa.array(size.astype(np.int32)),
                         pa.array(logp), pa.array(value), pa.array(inclusion), pa.ListArray.from_arrays(pa.array(at), pa.array(ids)), *same], out)

    out = [*names, "rank", "n_pieces", "log_prob", "gumbel", "log_inclusion", "ids"] + ["round_trip"] * round_trip
    schema = StructType(own.schema.fields[:len(names)] + StructType.fromDDL(SCHEMA + ", round_trip boolean" * round_trip).fields)
    return own.mapInArrow(run, schema)


def decode_rows(ids: np.ndarray, off: np.ndarray, v: Vocabulary) -> pa.StringArray:
    """Texts of rows of piece ids."""
    size = np.diff(v.piece_off)[ids]
    end = np.concatenate([[0], np.cumsum(size)])
    idx = np.arange(end[-1]) + np.repeat(v.piece_off[ids] - end[:-1], size)
    buf, edges = v.piece_bytes[idx], end[off]
    # the blank put before the first word goes again
    lead = edges[:-1][np.diff(edges) > 0]
    keep = np.ones(len(buf), bool)
    keep[lead[buf[lead] == 0x20]] = False
    edges = np.concatenate([[0], np.cumsum(keep)])[edges]
    return pa.Array.from_buffers(pa.string(), len(off) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(buf[keep])])


def decode(rows: DataFrame, ids_col: str, model: str) -> DataFrame:
    """``rows`` with a string column ``decoded`` for the piece ids in ``ids_col``."""
    keep = [c for c in rows.columns if c != "decoded"]
    own = rows.select(*keep)
    at = keep.index(ids_col)

    def run(batches):
        v = None
        for batch in batches:
            v = v or Vocabulary(model)
            col = batch.column(at)
            off = col.offsets.to_numpy().astype(np.int64)
            ids = col.values.to_numpy(zero_copy_only=False)
            a = 0
            while a < len(col):  # whole rows, about SLICE ids at a time
                b = max(a + 1, int(np.searchsorted(off, off[a] + SLICE, "right")) - 1)
                text = decode_rows(ids[off[a]:off[b]], off[a:b + 1] - off[a], v)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, text], [*keep, "decoded"])
                a = b

    return own.mapInArrow(run, StructType([*own.schema.fields, StructField("decoded", StringType())]))
