"""The scan against a brute-force version: every stretch, every template, plain dynamic
programming, and zstandard's own sizes."""

import random

import pytest
import zstandard

from airq.llm import license_scan as L


def count(template, words):
    """Largest count of an alignment of the whole of ``words``, which begins and ends with a found word; and its words found."""
    t, best = template, {}
    best[0, 0] = (0, 0)
    for i in range(len(t) + 1):
        for j in range(len(words) + 1):
            options = [best[i, j]] if (i, j) in best else []
            if i and (i - 1, j) in best:
                c, f = best[i - 1, j]
                options.append((c - L.LOST, f))
            if j and (i, j - 1) in best and 0 < j:
                c, f = best[i, j - 1]
                options.append((c - L.EXTRA, f))
            if i and j and t[i - 1] == words[j - 1] and (i - 1, j - 1) in best:
                c, f = best[i - 1, j - 1]
                options.append((c + L.FOUND, f + 1))
            if options:
                best[i, j] = max(options)
    return best[len(t), len(words)]


def size(data, template=None):
    plain = dict(write_content_size=0, write_checksum=0, write_dict_id=0)
    p = zstandard.ZstdCompressionParameters.from_level(L.LEVEL, **plain)
    d = None if template is None else zstandard.ZstdCompressionDict(template.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(zstandard.ZstdCompressor(compression_params=p, **({} if d is None else {"dict_data": d})).compress(data.lower().encode()))


def first_notice(templates, block):
    """(name, begin, end): of all stretches and templates the confirmed one that saves most,
    each template being represented by its best-counting stretches that don't overlap."""
    spans = [m.span() for m in L.WORD.finditer(block)]
    words = [block[a:b].lower() for a, b in spans]
    ranked = []
    for i, (name, text) in enumerate(templates.items()):
        t = L.tokens(text)
        own = []
        for b in range(1, len(words) + 1):      # the best alignment that ends here; of equal ones the shortest
            c, f, a = max((*count(t, words[a:b]), a) for a in range(b))
            if c > 0 and f >= L.MIN_SHARE * len(t) - 1e-9 and words[b - 1] in t:
                own.append((-c, a, b))
        used = set()
        for c, a, b in sorted(own):
            if not used & set(range(a, b)):
                used |= set(range(a, b))
                data = block[spans[a][0]:spans[b - 1][1]]
                ranked.append((size(data, text) - size(data), c, i, name, spans[a][0], spans[b - 1][1]))
    return min(ranked)[3:] if ranked else None


TEMPLATES = {"A": "you may copy this work under the open terms of version one", "B": "you may copy this work under the open terms of version two",
             "C": "copy this work freely", "D": "all of this work is given away without any warranty"}


@pytest.mark.parametrize("seed", range(25))
def test_first_notice_equals_brute_force(seed):
    r = random.Random(seed)
    words = []
    for _ in range(r.choice((1, 1, 2))):
        words += [r.choice(("some", "prose", "work", "terms")) for _ in range(r.randrange(3))]
        t = L.tokens(r.choice(list(TEMPLATES.values())))
        for w in t:
            if r.random() < 0.06:
                continue
            words.append(w)
            if r.random() < 0.06:
                words.append("oddly")
    block = " ".join(words)
    want = first_notice(TEMPLATES, block)
    got = L.Templates(TEMPLATES).notices(block, L.MIN_SHARE)
    if want is None:
        assert got == []
    else:
        assert want in [g[:3] for g in got]


def test_compression_ranks_before_counts():
    """Ten short words found in order count more than four long ones; the long ones' template
    saves more bytes and wins.  Without the ranking the other one would."""
    templates = {"letters": "a b c d e f g h i j", "words": "internationalization documentation responsibilities acknowledgements"}
    block = "a b internationalization c d documentation e responsibilities f g acknowledgements h i j"
    known = L.Templates(templates)
    spans = [m.span() for m in L.WORD.finditer(block)]
    have = L.np.array([known.ids.get(block[a:b], -1) for a, b in spans], L.np.int64)
    by_count = known.candidates(have, L.MIN_SHARE)
    assert templates and known.names[by_count[0][1]] == "letters"
    assert [n[0] for n in known.notices(block, L.MIN_SHARE)][0] == "words"
