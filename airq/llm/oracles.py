"""DuckDB SQL of the operators whose SQL is generated: weak rules, spelling variants,
importance resampling."""

from __future__ import annotations

from . import weak_rules as R

WORD = r"[^\x20\x09-\x0D]+"


def weak_rules_sql(iterations: int = R.ITERATIONS) -> str:
    """The counts by unnesting words and windows; expectation-maximisation unrolled,
    one pair of CTEs per iteration."""
    feature = {
        "word_length": "(word_chars::DOUBLE / nullif(n_words, 0))", "symbols": "(n_symbols / nullif(n_words, 0))",
        "repeated_lines": "(CASE WHEN n_lines >= 5 THEN n_dup_lines / n_lines END)", "repeated_words": "(CASE WHEN n_words >= 8 THEN n_repeat_words / n_words END)",
        "letters": "(n_letters / nullif(n_words, 0))", "letter_share": "(n_alpha / nullif(word_chars, 0))", "capitals": "(n_capitals / nullif(word_chars, 0))", "digits": "(n_digits / nullif(word_chars, 0))",
        "sentences": "(CASE WHEN n_lines >= 3 THEN n_ends / n_lines END)", "variety": "(CASE WHEN n_words >= 20 THEN n_distinct / n_words END)"}
    vote = [f"coalesce({when.format(x=feature.get(f, f))}, false) AS vote_{name}" for name, _, f, when in R.RULES]
    z = " + ".join(["ln(good / (1 - good))"] + [f"CASE WHEN {v} THEN ln(g_{v} / b_{v}) ELSE 0.0 END" for v in R.VOTES])
    kinds = dict(zip(R.VOTES, (kind for _, kind, *_ in R.RULES)))
    start = ", ".join([f"{R.GOOD_SHARE!r}::DOUBLE AS good"] + [
        f"{R.RATES[k][0]!r}::DOUBLE AS g_{v}, {R.RATES[k][1]!r}::DOUBLE AS b_{v}" for v, k in kinds.items()])

    def rate(hits, of, at):
        hits, of = (f"(coalesce(sum({x}), 0)::DOUBLE / {R.UNIT})" for x in (hits, of))
        return f"({hits} + {R.PRIOR!r}::DOUBLE * {at!r}::DOUBLE) / ({of} + {R.PRIOR!r}::DOUBLE)"

    g, b = "n * q", f"n * ({R.UNIT} - q)"
    step = ", ".join([f"{rate(g, f'n * {R.UNIT}', R.GOOD_SHARE)} AS good"] + [
        f"{rate(f'CASE WHEN {v} THEN {g} END', g, R.RATES[k][0])} AS g_{v}, {rate(f'CASE WHEN {v} THEN {b} END', b, R.RATES[k][1])} AS b_{v}"
        for v, k in kinds.items()])
    rounds = [f"m0 AS (SELECT {start})"]
    for i in range(iterations):
        rounds += [f"e{i} AS MATERIALIZED (SELECT pat.*, floor(1.0 / (1.0 + exp(-({z}))) * {R.UNIT})::HUGEINT AS q FROM pat, m{i})",
                   f"m{i + 1} AS MATERIALIZED (SELECT {step} FROM e{i})"]
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(t, '{WORD}')) AS w, generate_subscripts(regexp_extract_all(t, '{WORD}'), 1) AS i FROM d),
ws AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars, count(CASE WHEN regexp_matches(w, '\\p{{L}}') THEN 1 END) AS n_letters,
         count(DISTINCT w) AS n_distinct, max(length(w)) AS longest FROM w GROUP BY r),
win AS (SELECT r, i, w || ' ' || {" || ' ' || ".join(f"lead(w, {k}) OVER o" for k in range(1, R.WINDOW))} AS x FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM win WHERE x IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
cov AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + {R.WINDOW})) AS j FROM rep) GROUP BY r),
ln AS (SELECT r, unnest(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) AS x FROM d),
ls AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines,
         count(CASE WHEN regexp_matches(x, '{R.SENTENCE_END.replace("'", "''")}') THEN 1 END) AS n_ends FROM ln GROUP BY r),
f AS (SELECT r, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_letters, 0) AS n_letters, length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) AS n_alpha,
        length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals, length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits,
        coalesce(n_ends, 0) AS n_ends, coalesce(n_lines, 0) AS n_lines, coalesce(n_distinct, 0) AS n_distinct, longest
      FROM d LEFT JOIN ws USING (r) LEFT JOIN cov USING (r) LEFT JOIN ls USING (r)),
v AS MATERIALIZED (SELECT *, {", ".join(vote)} FROM f),
pat AS MATERIALIZED (SELECT {", ".join(R.VOTES)}, count(*)::HUGEINT AS n FROM v GROUP BY ALL),
{", ".join(rounds)},
s AS (SELECT v.*, 1.0 / (1.0 + exp(-({z}))) AS quality, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM v, m{iterations})
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND quality >= {R.KEEP_AT} AS kept, round(quality, 4) AS quality FROM s"""


def crc32_sql(text: str) -> str:
    """crc32 of a string as a BIGINT expression (needs the CTE of `crc_cte`)."""
    return (f"xor(4294967295::BIGINT, list_reduce(list_transform(range(length(hex(encode({text}))) // 2), "
            f"lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT), "
            f"lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT))")


def crc_cte() -> str:
    """crc(tab): the 256 table entries of the crc32 polynomial, from its rule."""
    rounds = ["s0 AS (SELECT i, i::BIGINT AS c FROM range(256) t(i))"]
    rounds += [f"s{k + 1} AS (SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END AS c FROM s{k})" for k in range(8)]
    return ", ".join(rounds) + ", crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM s8)"


def resampling_sql() -> str:
    from . import resampling as S

    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def grams(name: str, table: str) -> str:
        return f"""{name}_w AS (SELECT r, w, i FROM (SELECT r, unnest(x) AS w, generate_subscripts(x, 1) AS i FROM
  (SELECT row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS x FROM {table}))),
{name} AS (SELECT r, w AS g FROM {name}_w UNION ALL
  SELECT r, g FROM (SELECT r, w || ' ' || lead(w) OVER (PARTITION BY r ORDER BY i) AS g FROM {name}_w) WHERE g IS NOT NULL)"""

    return f"""
WITH {crc_cte()},
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
{grams("sg", "documents")}, {grams("tg", "benchmark")},
names AS MATERIALIZED (SELECT g, ({crc32_sql("g")}) % {S.BUCKETS} AS b FROM (SELECT g FROM sg UNION SELECT g FROM tg), crc),
sb AS (SELECT b, count(*) AS s FROM sg JOIN names USING (g) GROUP BY b),
tb AS (SELECT b, count(*) AS t FROM tg JOIN names USING (g) GROUP BY b),
tot AS (SELECT coalesce((SELECT sum(s) FROM sb), 0)::DOUBLE AS s_all, coalesce((SELECT sum(t) FROM tb), 0)::DOUBLE AS t_all),
gain AS MATERIALIZED (SELECT b, floor(1000.0 * ln((coalesce(t, 0)::DOUBLE + 1.0) * (s_all + {S.BUCKETS}.0) / ((s::DOUBLE + 1.0) * (t_all + {S.BUCKETS}.0))))::BIGINT AS gain
  FROM sb LEFT JOIN tb USING (b), tot),
f AS (SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM sg JOIN names USING (g) JOIN gain USING (b) GROUP BY r),
sc AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000.0 * ln(-ln((('0x' || substr(sha256('{S.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM docs LEFT JOIN f USING (r)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {2 * S.MIN_WORDS - 1} ORDER BY score DESC, doc_id, n_features) AS rk,
    count(*) OVER (PARTITION BY n_features >= {2 * S.MIN_WORDS - 1}) AS n FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {2 * S.MIN_WORDS - 1} AND rk <= {S.SHARE} * n // 100 THEN rk END AS rank FROM o"""


def spelling_sql() -> str:
    from . import spelling as S

    return f"""
WITH RECURSIVE {crc_cte()},
t AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[{S.LETTERS}]+')) AS run FROM documents),
u AS (SELECT id, run, count(*) AS c FROM (SELECT id, translate(run, '{S.UPPER}', '{S.LOWER}') AS run FROM t WHERE length(run) >= {S.LENGTH}) GROUP BY ALL),
h AS MATERIALIZED (SELECT run, c, {crc32_sql("id || ':' || run")} AS h FROM u, crc),
p AS (SELECT c, CASE WHEN h % {S.EVERY} = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word FROM h),
v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM p WHERE length(word) >= {S.LENGTH} GROUP BY word HAVING sum(c) >= {S.OCCURRENCES}),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cut c JOIN v ON c.rest = v.word UNION SELECT v.word, c.word FROM cut c JOIN v ON c.rest = v.word),
near AS (SELECT x AS word, count(*) AS n_near, arg_min(v.word, struct_pack(a := -v.n, b := v.word)) AS best, max(v.n) AS best_n
  FROM pairs JOIN v ON v.word = y GROUP BY x),
w AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {S.RATIO} * n THEN best END AS form,
    CASE WHEN best_n >= {S.RATIO} * n THEN best_n END AS form_n FROM v LEFT JOIN near USING (word)),
chain(word, upto) AS (SELECT word, word FROM w UNION ALL SELECT chain.word, w.form FROM chain JOIN w ON chain.upto = w.word WHERE w.form IS NOT NULL),
last AS (SELECT chain.word, upto AS root FROM chain JOIN w ON w.word = chain.upto WHERE w.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM w JOIN last USING (word)"""
