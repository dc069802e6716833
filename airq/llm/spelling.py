"""Spelling variant grouping: words of a corpus that lie one edit apart, by finite-state composition.

The relation "u and v are words and differ by one inserted, deleted or replaced
character" is the composition A o E o A of the vocabulary's minimised acceptor A, a transducer E
that makes exactly one edit, and A again.  Its accepted pairs are enumerated in parts, one
per initial state of the composition:

* a pair has a kind (replacement, or insertion into the shorter word), a length of
  the shorter word and an edit position.  For edit positions in [a, b) both words share
  what stands before a and after b, so the words are dealt to groups by (kind, length, a, b, shared
  prefix, shared suffix); a group is an initial state of A o E o A, where the shared ends have been read.  Every word
  starts in the two halves of each of its three (kind, length) classes;
* groups with more than ``GROUP`` words are halved by edit position until they fit: a
  common prefix or ending never fills a task, and a group of one position has no more
  words than the alphabet has letters.  Every pair belongs to one group at every stage;
* groups are dealt to buckets of bounded size.  A task builds one minimised acceptor for
  all groups of its bucket (what stands between the shared ends, an initial state per group and length), from
  the leaves up: states with equal finality and equal arcs are one.  It then composes in
  numpy: state pairs that read the same so far (0 edits), the edit's arcs, and state pairs
  behind the edit (1 edit).  Pairs of states behind the edit from which no word can be
  finished are trimmed before pairs are enumerated.  Words are found again by their
  index, the sum of the words that each arc of the path skips;
* inserting a letter next to an equal one gives the same word as inserting it before:
  the transducer only inserts in front of such a run, so a pair has one path.

States are compared by a 64-bit hash of their arcs; merging two different states of one task would take a
collision.  The task returns one row per word: how many near words its groups hold and the best of them.

Edge cases: null and empty texts have no words; a null id counts as empty text in the
perturbation; words are compared by code points; equal counts are decided by the smaller word; repeated rows
count again; an empty table gives an empty result; a word of any length is
handled (its groups hold it once per half and class); other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .text import U64, splitmix

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LENGTH = 7
OCCURRENCES = 2
RATIO = 10
EVERY = 31          # one occurrence in so many loses a letter
GROUP = 20_000      # words of a group at most, unless it has one edit position
BUCKET = 60_000     # rows of a bucket, about
REPLACE, INSERT = 0, 1


def vocabulary(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, occurrences: int = OCCURRENCES, every: int = EVERY) -> DataFrame:
    """(word, n): lower-cased runs of letters, of which one occurrence in ``every``, by the
    crc32 of id and run, loses a letter; those of ``length`` and ``occurrences``."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))).alias("run"))
    runs = runs.select(F.translate("run", UPPER, LOWER).alias("run"), "id").withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= occurrences)


# --- groups: initial states of the composition --------------------------------

_GROUP = ("kind", "m", "a", "b")    # kind of edit, length of the shorter word, edit positions [a, b)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the key of the group: what its words share."""
    size = F.length("word")
    # an insertion at b - 1 or before leaves the shorter word's [b - 1, m) as it is
    tail = F.when(F.col("kind") == REPLACE, F.col("m") - F.col("b")).otherwise(F.col("m") - F.col("b") + 1)
    return rows.withColumn("key", F.xxhash64(*_GROUP, F.substring(F.col("word"), F.lit(1), F.col("a")), F.substring(F.col("word"), size - tail + 1, tail)))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice, with the halves of its edit positions."""
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.array(F.struct(F.col("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b")))
    return rows.select("word", "n", "kind", "m", F.inline(halves))


def _classes(words: DataFrame) -> DataFrame:
    """Every word in its classes: replaced, the shorter and the longer word of an insertion."""
    size = F.length("word")
    own = lambda kind, m, end: F.struct(F.lit(kind).alias("kind"), m.alias("m"), F.lit(0).alias("a"), end.alias("b"))
    return words.select("word", "n", F.inline(F.array(own(REPLACE, size, size), own(INSERT, size, size + 1), own(INSERT, size - 1, size))))


def groups(words: DataFrame, limit: int = GROUP) -> DataFrame:
    """(word, n, kind, m, a, b, key): groups of at most ``limit`` words (or of one edit position)."""
    done, rows = [], materialize(_keyed(_halved(_classes(words))), "edit-groups")
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("b") - F.col("a")).alias("width"))
        large = materialize(sizes.filter((F.col("rows") > limit) & (F.col("width") > 1)).select("key"), "large-groups")
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, "key", "left_anti"))
        rows = materialize(_keyed(_halved(rows.join(large, "key", "left_semi"))), "edit-groups")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


# --- acceptor ------------------------------------------------------------------

class Acceptor:
    """Minimised acceptor of strings with several initial states.

    ``first[q]:first[q + 1]`` are the arcs of state q, by label: ``label``, ``target`` and
    ``skip`` (words of q that come before those that take the arc)."""

    def __init__(self, root: np.ndarray, chars: np.ndarray, off: np.ndarray):
        """String i is ``chars[off[i]:off[i + 1]]`` from initial state ``root[i]`` (0, 1, ...);
        strings are sorted by root and then by characters and distinct."""
        size = np.diff(off)
        n_roots = int(root[-1]) + 1 if len(root) else 0
        node = root.astype(np.int64).copy()       # where each string has got to
        parents, labels, children, total = [], [], [], n_roots
        live, depth = np.flatnonzero(size > 0), 0
        while len(live):
            p, c = node[live], chars[off[live] + depth]
            new = np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])])
            node[live] = total + np.cumsum(new) - 1
            parents.append(p[new]); labels.append(c[new]); children.append(node[live][new])  # noqa: E702
            total += int(new.sum())
            depth += 1
            live = live[size[live] > depth]
        none = np.zeros(0, np.int64)
        parent, label, child = (np.concatenate(x) if x else none for x in (parents, labels, children))
        final = np.zeros(total, bool)
        final[node] = True
        # height of a node: longest string below it; children come after their parents
        height = np.zeros(total, np.int64)
        for p, c in zip(reversed(parents), reversed(children)):
            np.maximum.at(height, p, height[c] + 1)
        # from the leaves up, equal states become one
        state = np.full(total, -1, np.int64)
        picked = []
        by = np.argsort(height[parent], kind="stable")
        edges = np.searchsorted(height[parent][by], np.arange(0, int(height.max(initial=0)) + 2))
        order = np.argsort(height, kind="stable")
        levels = np.searchsorted(height[order], np.arange(0, int(height.max(initial=0)) + 2))
        sign = splitmix(final.astype(U64) + U64(11))
        count = 0
        for h in range(len(levels) - 1):
            e, own = by[edges[h]:edges[h + 1]], order[levels[h]:levels[h + 1]]
            with np.errstate(over="ignore"):
                np.add.at(sign, parent[e], splitmix(splitmix(label[e].astype(U64)) ^ state[child[e]].astype(U64)))
            _, at, back = np.unique(sign[own], return_index=True, return_inverse=True)
            state[own] = count + back
            picked.append(own[at])
            count += len(at)
        chosen = np.concatenate(picked) if picked else none
        keep = np.zeros(total, bool)
        keep[chosen] = True
        e = np.flatnonzero(keep[parent])
        source, label, target = state[parent[e]], label[e].astype(np.int64), state[child[e]]
        order = np.lexsort((label, source))
        self.label, self.target = label[order], target[order]
        source = source[order]
        self.first = np.searchsorted(source, np.arange(count + 1))
        self.final = final[chosen]
        # words below each state, states being numbered from the leaves up
        words = self.final.astype(np.int64)
        self.skip = np.zeros(len(source), np.int64)
        start = 0
        for level in picked:
            a, b = self.first[start], self.first[start + len(level)]
            if b > a:
                below = words[self.target[a:b]]
                run = np.concatenate([[0], np.cumsum(below)])
                own = source[a:b]
                self.skip[a:b] = run[:-1] - run[self.first[own] - a] + self.final[own]
                words += np.bincount(own, below, len(words)).astype(np.int64)
            start += len(level)
        self.words = words
        self.roots = state[:n_roots]
        self.arc_key = source * (1 << 21) + self.label

    def arcs(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which entry, arc) of all arcs of states ``q``."""
        n = self.first[q + 1] - self.first[q]
        entry = np.repeat(np.arange(len(q)), n)
        return entry, self.first[q][entry] + np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)

    def same_label(self, q1: np.ndarray, q2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which entry, arc of q1, arc of q2) of all pairs of arcs that read the same letter."""
        entry, e1 = self.arcs(q1)
        if not len(entry):
            return entry, e1, e1
        want = q2[entry] * (1 << 21) + self.label[e1]
        e2 = np.minimum(np.searchsorted(self.arc_key, want), len(self.arc_key) - 1)
        hit = self.arc_key[e2] == want
        return entry[hit], e1[hit], e2[hit]


# --- composition -----------------------------------------------------------------

def _alive(a: Acceptor, q1: np.ndarray, q2: np.ndarray) -> np.ndarray:
    """Sorted keys q1 * states + q2 of the state pairs, reachable from the given ones by
    reading equal letters, that finish some word together.  (Equal states always do.)"""
    states = len(a.final)
    layers = []
    keys = np.unique(q1 * states + q2)
    while len(keys):
        x, y = keys // states, keys % states
        more = np.flatnonzero(x != y)
        entry, e1, e2 = a.same_label(x[more], y[more])
        follow = a.target[e1] * states + a.target[e2]
        layers.append((keys, (x == y) | (a.final[x] & a.final[y]), more[entry], follow))
        keys = np.unique(follow)
    alive = np.zeros(0, np.int64)
    for keys, ok, entry, follow in reversed(layers):
        ok = ok.copy()
        ok[entry[np.isin(follow, alive)]] = True
        alive = np.union1d(alive, keys[ok])
    return alive


def compose(a: Acceptor, root1: np.ndarray, root2: np.ndarray, kind: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Accepted pairs of A o E o A from the initial states (root1, no edit, root2): (which
    initial state, index of the word among root1's, index among root2's).  ``last``: the
    letter that was read before, or -1.  Replacements are given once, the smaller word first."""
    q1, q2 = a.roots[root1], a.roots[root2]
    own, i1, i2 = np.arange(len(root1)), np.zeros(len(root1), np.int64), np.zeros(len(root1), np.int64)
    edited = []
    while len(own):                          # no edit so far
        r = np.flatnonzero(kind[own] == REPLACE)
        entry, e1 = a.arcs(q1[r])
        n = a.first[q1[r][entry] + 1] - e1 - 1          # later arcs of the same state
        at = np.repeat(np.arange(len(e1)), n)
        e2 = e1[at] + 1 + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        e1, entry = e1[at], r[entry[at]]
        edited.append((own[entry], a.target[e1], a.target[e2], i1[entry] + a.skip[e1], i2[entry] + a.skip[e2]))
        r = np.flatnonzero(kind[own] == INSERT)
        entry, e2 = a.arcs(q2[r])
        entry = r[entry]
        ok = a.label[e2] != last[entry]
        entry, e2 = entry[ok], e2[ok]
        edited.append((own[entry], q1[entry], a.target[e2], i1[entry], i2[entry] + a.skip[e2]))
        entry, e1, e2 = a.same_label(q1, q2)
        own, i1, i2, last = own[entry], i1[entry] + a.skip[e1], i2[entry] + a.skip[e2], a.label[e1]
        q1, q2 = a.target[e1], a.target[e2]
    own, q1, q2, i1, i2 = (np.concatenate(x) for x in zip(*edited)) if edited else (np.zeros(0, np.int64),) * 5
    states, alive = len(a.final), _alive(a, q1, q2)
    out = []
    while len(own):                          # behind the edit
        ok = (q1 == q2) | np.isin(q1 * states + q2, alive)
        own, q1, q2, i1, i2 = own[ok], q1[ok], q2[ok], i1[ok], i2[ok]
        end = a.final[q1] & a.final[q2]
        out.append((own[end], i1[end], i2[end]))
        entry, e1, e2 = a.same_label(q1, q2)
        own, i1, i2 = own[entry], i1[entry] + a.skip[e1], i2[entry] + a.skip[e2]
        q1, q2 = a.target[e1], a.target[e2]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def near_pairs(words: list[str], kind, m, a, b) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) that are near words of one group, each pair once, of rows of whole groups."""
    strings, names = [], {}
    for row, (w, k, size, lo, hi) in enumerate(zip(words, kind, m, a, b)):
        tail = size - hi + (k == INSERT)
        group = names.setdefault((k, size, lo, hi, w[:lo], w[len(w) - tail:]), len(names))
        longer = int(k == INSERT and len(w) > size)
        strings.append((2 * group + longer, w[lo:len(w) - tail], row))
    strings.sort()
    sides = np.array([s[0] for s in strings], np.int64)
    used, root = np.unique(sides, return_inverse=True)
    off = np.concatenate([[0], np.cumsum([len(s[1]) for s in strings])])
    chars = np.frombuffer("".join(s[1] for s in strings).encode("utf-32-le"), np.uint32).astype(np.int64)
    acceptor = Acceptor(root, chars, off)
    begin = np.searchsorted(root, np.arange(len(used)))         # first string of each initial state
    group_kind = np.array([g[0] for g in names], np.int64)
    group_last = np.array([ord(g[4][-1]) if g[4] else -1 for g in names], np.int64)
    of_side = np.full(2 * len(names), -1, np.int64)
    of_side[used] = np.arange(len(used))
    root1 = of_side[0::2]
    root2 = np.where(group_kind == REPLACE, root1, of_side[1::2])
    both = np.flatnonzero((root1 >= 0) & (root2 >= 0))
    own, i1, i2 = compose(acceptor, root1[both], root2[both], group_kind[both], group_last[both])
    row = np.array([s[2] for s in strings], np.int64)
    return row[begin[root1[both][own]] + i1], row[begin[root2[both][own]] + i2]


def _bucket_near(table: pa.Table) -> pa.Table:
    """(word, near, best, best_n) of a bucket's words that have near words in their groups."""
    words = table["word"].to_pylist()
    i, j = near_pairs(words, *(table[c].to_pylist() for c in _GROUP))
    n = table["n"].to_numpy()
    u, v = np.concatenate([i, j]), np.concatenate([j, i])
    names, word = np.unique(np.array(words, dtype=object), return_inverse=True)    # code-point order
    order = np.lexsort((word, -n))
    place = np.empty(len(n), np.int64)
    place[order] = np.arange(len(n))
    best = np.full(len(names), len(n), np.int64)
    np.minimum.at(best, word[u], place[v])
    near = np.bincount(word[u], minlength=len(names))
    have = np.flatnonzero(near)
    row = order[best[have]]
    return pa.table({"word": pa.array(names[have].tolist(), pa.string()), "near": pa.array(near[have], pa.int64()),
                     "best": pa.array([words[r] for r in row.tolist()], pa.string()), "best_n": pa.array(n[row], pa.int64())})


def near_words(words: DataFrame, limit: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """(word, n_near, best, best_n) of words that have near words: how many, and the one of
    largest n (of equals the smallest).  ``words``: a written table (word, n)."""
    rows = groups(words, limit)
    n = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // bucket))
    found = (rows.withColumn("bucket", F.pmod(F.col("key"), F.lit(n))).groupBy("bucket")
             .applyInArrow(_bucket_near, "word string, near long, best string, best_n long"))
    first = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("f"))
            .select("word", "n_near", F.col("f.best").alias("best"), (-F.col("f.m")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by pointer doubling.  A form occurs ``RATIO``
    times as often as its word, so chains are short and have no cycles."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("w_"), F.col("root").alias("r_"))
        step = state.join(ahead, F.col("root") == F.col("w_"), "left")
        state = materialize(step.select("word", F.coalesce("r_", "root").alias("root"), F.col("r_").isNotNull().alias("moved")), "roots")
        if state.filter("moved").isEmpty():
            return state.drop("moved")


def variants(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, occurrences: int = OCCURRENCES, ratio: int = RATIO,
             every: int = EVERY, limit: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the corpus."""
    words = materialize(vocabulary(docs, id_col, text_col, length, occurrences, every), "words")
    near = near_words(words, limit, bucket)
    has_form = F.col("best_n") >= ratio * F.col("n")
    rows = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")), "variants")
    last = roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
