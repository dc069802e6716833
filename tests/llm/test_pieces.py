import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from airq.llm import pieces
from airq.llm.text import U64, splitmix

MODEL = public_tokenizers.path(pieces.MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(MODEL)


def listed(text, v):
    """Every segmentation of a short text, with its probability."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    s = "▁" + text.replace(" ", "▁")
    normal = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    ids = sorted(normal.values())
    weight = dict(zip(ids, pieces.piece_weights(np.array([sp.get_score(i) for i in ids]), 1.0)))

    def paths(i):
        if i == len(s):
            return [((), 0.0)]
        out = []
        for j in range(i + 1, min(len(s), i + v.longest) + 1):
            if (p := normal.get(s[i:j])) is not None:
                out += [((p, *rest), weight[p] + w) for rest, w in paths(j)]
        if s[i] not in normal:
            own = tuple(int(v.byte_id[b]) for b in s[i].encode())
            out += [((*own, *rest), len(own) * v.byte_weight + w) for rest, w in paths(i + 1)]
        return out

    found = paths(0)
    total = math.log(sum(math.exp(w) for _, w in found))
    return {p: w - total for p, w in found}


def drawn(texts, seeds, v, k):
    out = {}
    for live, rank, logp, value, inclusion, off, ids in pieces.encode_slice(texts, np.array(seeds, U64), v, k):
        for j, i in enumerate(live.tolist()):
            out.setdefault(i, []).append((tuple(ids[off[i]:off[i + 1]].tolist()), logp[j], value[j], inclusion[j]))
    return out


@pytest.mark.parametrize("text", ["the cat", "a\nb", "日x", "  aa "])
def test_samples_are_paths_with_their_probability(vocabulary, text):
    want = listed(text, vocabulary)
    got = drawn([text] * 40, splitmix(np.arange(40)), vocabulary, 4)
    for rows in got.values():
        assert len({p for p, *_ in rows}) == len(rows) == min(4, len(want))
        assert all(abs(want[p] - lp) < 1e-9 for p, lp, *_ in rows)
        values = [g for _, _, g, _ in rows]
        assert values == sorted(values, reverse=True)


def test_all_segmentations_when_k_is_large(vocabulary):
    want = listed("of", vocabulary)
    rows = drawn(["of"], [5], vocabulary, 50)[0]
    assert {p for p, *_ in rows} == set(want) and all(abs(x) < 1e-9 for *_, x in rows)


def test_frequencies_and_inclusion_scores(vocabulary):
    want = listed("the a", vocabulary)
    n, k = 4000, 3
    got = drawn(["the a"] * n, splitmix(np.arange(n) + 7), vocabulary, k)
    first = Counter(rows[0][0] for rows in got.values())
    weight = Counter()
    for rows in got.values():
        for p, lp, _, inc in rows:
            weight[p] += math.exp(lp - inc)
    for p, lp in want.items():
        prob = math.exp(lp)
        if prob > 0.02:
            assert abs(first[p] / n - prob) < 4 * math.sqrt(prob / n)      # the first is a plain draw
            assert abs(weight[p] / n - prob) < 0.06 * max(prob, 0.2)       # weighting by inclusion is unbiased
    # the first two together follow sequential sampling without replacement
    pairs = Counter((r[0][0], r[1][0]) for r in got.values())
    (a, b), c = pairs.most_common(1)[0]
    prob = math.exp(want[a]) * math.exp(want[b]) / (1 - math.exp(want[a]))
    assert abs(c / n - prob) < 4.5 * math.sqrt(prob / n)


TEXTS = [(1, "Hello  world\n\tThe end. "), (2, None), (3, ""), (None, "naïve 日本語 👍🏽 x"), (1, "Hello  world\n\tThe end. "), (5, "word " * 3000),
         (6, "x" * 4000), (7, "<s> <0x41> </s>"), (8, " ")]


def test_round_trip_and_seeding(spark):
    df = spark.createDataFrame([(i, t, "k", 9) for i, t in TEXTS], "id long, body string, key string, rank int")
    rows = pieces.decode(pieces.encode(df, "id", "body", MODEL, samples=3, keep={"want": F.coalesce("body", F.lit(""))}), "ids", MODEL).collect()
    assert all(r["decoded"] == r["want"] for r in rows)
    of = lambda rows, i: sorted((r["rank"], tuple(r["ids"])) for r in rows if r["key"] == i)
    assert [len(of(rows, i)) for i in (1, 2, 3, 5, 6, 7)] == [6, 1, 1, 3, 3, 3]
    again = pieces.encode(df.repartition(7), "id", "body", MODEL, samples=3).collect()
    assert all(of(rows, i) == of(again, i) for i in (1, 2, 3, None, 5, 6, 7, 8))
    assert of(rows, 1)[0] == of(rows, 1)[1]  # equal key and text, equal sample


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, body string")
    assert pieces.decode(pieces.encode(df, "id", "body", MODEL), "ids", MODEL).collect() == []


def test_round_trip_in_the_same_pass_equals_decode(spark):
    texts = ["plain words", "", None, "tabs\tand\nlines  two", "has \u2581 blank mark", "日本語 é ﷽ 𝔘"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = pieces.encode(df, "id", "text", MODEL, round_trip=True, keep={"text": F.coalesce("text", F.lit(""))})
    back = pieces.decode(rows, "ids", MODEL).collect()
    assert all(r["round_trip"] == (r["decoded"] == r["text"]) for r in back)
    assert {r["key"] for r in back if not r["round_trip"]} == {4}


def test_seed_columns_change_the_sample_only(spark):
    df = spark.createDataFrame([(1, "several words to be cut into pieces", p) for p in (1, 2)], "id long, text string, p int")
    a, b = ([tuple(r["ids"]) for r in pieces.encode(df.filter(f"p = {p}"), "id", "text", MODEL, seed_by=("p",)).sort("rank").collect()] for p in (1, 2))
    plain = [[tuple(r["ids"]) for r in pieces.encode(df.filter(f"p = {p}"), "id", "text", MODEL).sort("rank").collect()] for p in (1, 2)]
    assert a != b and plain[0] == plain[1]


def test_masses_of_very_long_words_use_logarithms(vocabulary):
    """Where masses leave the range of doubles, the probabilities are the same by logarithms."""
    rare, usual = "𝔘𝔫𝔦" * 400, "usual"
    both, alone = pieces.build(["\u2581" + rare, "\u2581" + usual], vocabulary), pieces.build(["\u2581" + usual], vocabulary)
    own = slice(both.first[both.node0[1]], None)
    assert np.allclose(both.prob[own], alone.prob) and np.allclose(both.logp[own], alone.logp)
    starts = np.repeat(np.arange(len(both.first) - 1), np.diff(both.first))
    total = np.bincount(starts, both.prob, len(both.first) - 1)
    assert np.allclose(total[np.unique(starts)], 1.0)


def test_units_are_runs_of_blanks_with_what_follows(vocabulary):
    """Words by byte positions are those of the plain pattern, each distinct one once."""
    import re

    import pyarrow as pa

    alone = "".join(chr(c) for c in np.flatnonzero(vocabulary.alone))
    pattern = f"{pieces.BLANK}*[^{pieces.BLANK}{alone}]+|{pieces.BLANK}+" + (f"|[{alone}]" if alone else "")
    texts = ["", "a b  a", " ", "\n", "x\n\ny\tz \n ", "", "日本 é\u2581\u2581b ", "  a b", "\r\n a"]
    cp, size, word, first = pieces.units(pa.array(texts, pa.string()), vocabulary)
    off = np.concatenate([[0], np.cumsum(size)])
    names = ["".join(map(chr, cp[a:b].tolist())) for a, b in zip(off[:-1], off[1:])]
    got = [[names[w] for w in word[a:b].tolist()] for a, b in zip(first[:-1], first[1:])]
    assert got == [re.findall(pattern, (pieces.BLANK + t).replace(" ", pieces.BLANK)) if t else [] for t in texts]
    assert len(set(names)) == len(names)


def test_only_parts_that_can_be_taken_are_valued(vocabulary, monkeypatch):
    """A long text's parts behind improbable beginnings are left out, and the samples are those of valuing all."""
    text = ["several plain words that are cut into pieces " * 200, "of", "a b"]
    plain, counted = pieces.uniform, []
    monkeypatch.setattr(pieces, "uniform", lambda *parts: (counted.append(np.size(parts[0])), plain(*parts))[1])
    few = drawn(text, [3, 4, 5], vocabulary, 3)
    n, moves = sum(counted), sum(len(rows[0][0]) for rows in few.values())
    monkeypatch.setattr(pieces, "NEAR", np.inf)
    assert drawn(text, [3, 4, 5], vocabulary, 3) == few
    assert n < moves


def test_a_words_lattice_does_not_depend_on_the_others(vocabulary):
    many, alone = pieces.build([f"\u2581word{i}" for i in range(3000)] + ["\u2581usual"], vocabulary), pieces.build(["\u2581usual"], vocabulary)
    own = slice(many.first[many.node0[-1]], None)
    assert (many.upto[own] == alone.upto).all() and (many.prob[own] == alone.prob).all()
