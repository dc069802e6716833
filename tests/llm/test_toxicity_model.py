import numpy as np
import pyarrow as pa

from airq.llm import toxicity
from airq.llm.ppm import _mask, symbol_codes
from airq.llm.text import U64


def model(words, seed):
    codes, _ = symbol_codes(pa.array(words), toxicity.ORDER)
    grams = np.unique(codes)
    rng = np.random.RandomState(seed)
    ordinary, toxic = (rng.randint(0, 4, len(grams)).astype(np.uint32) for _ in range(2))
    some = ordinary + toxic > 0
    return toxicity.Model(grams[some], ordinary[some], toxic[some])


def names(n, seed):
    rng = np.random.RandomState(seed)
    return ["".join(chr(97 + c) for c in rng.randint(0, 6, rng.randint(1, 9))) for _ in range(n)]


def arrays(x):
    if isinstance(x, np.ndarray):
        return x.nbytes
    if isinstance(x, (list, tuple)):
        return sum(map(arrays, x))
    return sum(map(arrays, vars(x).values())) if hasattr(x, "__dict__") else 0


def test_a_workers_model_is_its_sorted_arrays():
    """Two of these are in every worker that takes part in fitting: no tables of several times the grams."""
    m = model(names(30_000, 1), 2)
    m.build()
    assert arrays(m) < 140 * len(m.counts[0])


def test_evidence_follows_the_recursion():
    m = model(names(300, 3), 4)
    grams, ordinary, toxic = m.counts
    counts = [dict(zip(grams.tolist(), c.tolist())) for c in (ordinary, toxic, (ordinary + toxic))]
    short, longer = {}, grams
    for k in range(toxicity.ORDER - 1, -1, -1):
        longer, n = np.unique(longer & _mask(k + 1), return_counts=True)
        short[k] = dict(zip(longer.tolist(), n.tolist()))

    def blend(seen, g, below):
        own = {x: n for x, n in seen.items() if n and x >> 9 == g >> 9}
        if not own:
            return below
        total = sum(own.values())
        return (own[g] - toxicity.DISCOUNT if g in own else 0.0) / total + toxicity.DISCOUNT * len(own) / total * below

    query = np.unique(symbol_codes(pa.array(names(40, 5) + ["zz", ""]), toxicity.ORDER)[0])
    got = m.evidence(query)
    for g, e in zip(query.tolist(), got.tolist()):
        p = 1.0 / toxicity.ALPHABET
        for k in range(toxicity.ORDER):
            p = blend(short[k], g & int(_mask(k + 1)), p)
        p = blend(counts[2], g, p)
        assert abs(e - (np.log(blend(counts[1], g, p)) - np.log(blend(counts[0], g, p)))) < 1e-9


def test_no_labels_give_no_evidence():
    m = toxicity.Model(np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, np.uint32))
    assert (m.evidence(np.array([1, 5], U64)) == 0).all()
