"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from . import license_scan, mix_sources as m, quality_rules as q, secret_scan

_SPLIT = r"'[\x20\x09-\x0D]+'"


_OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(regexp_split_to_array(coalesce(text, ''), {_SPLIT}), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
n AS (SELECT r, i, count(*) OVER (PARTITION BY g) > 1 AS rep FROM g),
p AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
c AS (SELECT p.*, coalesce(max(CASE WHEN rep THEN 1 ELSE 0 END) OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
      FROM p LEFT JOIN n ON p.r = n.r AND p.i = n.i),
k AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r"""


def _op4() -> str:
    langs = " ".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in q.COMMON_WORDS.items())
    def shares(x: str, steps: int | None = None) -> str:
        if steps:
            return f"list_transform({x}, lambda v: coalesce(round(v * {steps}::DOUBLE / nullif(list_sum({x}), 0))::BIGINT, 0))"
        return f"list_transform({x}, lambda v: v / nullif(list_sum({x}), 0)::DOUBLE)"

    def js(a: str, b: str) -> str:
        def half(x, y):
            return (f"list_sum(list_transform(list_zip({x}, {y}), lambda z: CASE WHEN z[1] > 0 THEN z[1] * ln(2 * z[1] / (z[1] + z[2])) ELSE 0 END))")
        return f"sqrt(greatest(0, ({half(a, b)} + {half(b, a)}) / (2 * ln(2))))"
    too_far = (f"({js(shares('chars'), shares('r_chars'))} > {q.MAX_CHAR_DISTANCE} OR CASE WHEN len(words) > 1 THEN "
               f"{js(shares('words'), shares('r_words'))} END > {q.MAX_WORD_DISTANCE} + {q.WORD_NOISE} / sqrt(greatest(n_words, 1)))")
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, {_SPLIT}), lambda x: x <> '') AS w,
             list_filter(regexp_split_to_array(lower(regexp_replace(t, '[{q.STRIPPED}]+', '', 'g')), {_SPLIT}), lambda x: x <> '') AS plain,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
j AS (SELECT *, array_to_string(w, '') AS s, CASE lang {langs} ELSE []::VARCHAR[] END AS common FROM w),
c AS (SELECT *, length(s) AS solid, length(s) - length(regexp_replace(s, '[{q.SYMBOLS}]+', '', 'g')) AS c_symbol,
             length(s) - length(regexp_replace(s, '\p{{Lu}}+', '', 'g')) AS c_upper,
             length(regexp_replace(s, '\P{{L}}+', '', 'g')) AS letters,
             length(s) - length(regexp_replace(s, '\p{{N}}+', '', 'g')) AS c_digit,
             list_transform(common, lambda k: len(list_filter(plain, lambda x: x = k))) AS hits FROM j),
h AS (SELECT *, [length(t) - solid, c_symbol, c_upper, letters - c_upper, c_digit, solid - c_symbol - letters - c_digit] AS chars,
             list_concat(hits, [len(plain) - coalesce(list_sum(hits), 0)::BIGINT]) AS words FROM c),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM h),
g2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM g),
g3 AS (SELECT doc_id, least(3, i - lag(i, 1, -9) OVER (PARTITION BY doc_id ORDER BY i)) AS add FROM g2 WHERE n > 1),
rep AS (SELECT doc_id, sum(add)::BIGINT AS n_repeat_words FROM g3 GROUP BY 1),
b AS (SELECT h.doc_id, lang, t, chars, words, len(w)::BIGINT AS n_words, solid::BIGINT AS word_chars, c_symbol::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(w) < {q.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {q.REPEAT_PERCENT} * len(w) AS base_failed
      FROM h LEFT JOIN rep ON h.doc_id = rep.doc_id),
texts AS (SELECT DISTINCT lang, t, chars, words, n_words FROM b WHERE NOT base_failed),
bins AS (SELECT lang, unnest(range(1, len(s) + 1)) AS bin, unnest(s) AS step
         FROM (SELECT lang, list_concat({shares('chars', q.GRID)}, {shares('words', q.GRID)}) AS s FROM texts)),
middle AS (SELECT lang, bin, list_sort(list(step))[(count(*) + 1) // 2] AS step FROM bins GROUP BY 1, 2),
med AS (SELECT lang AS r_lang, list(step ORDER BY bin) FILTER (bin <= {q.N_CHAR_CLASSES}) AS r_chars,
               list(step ORDER BY bin) FILTER (bin > {q.N_CHAR_CLASSES}) AS r_words FROM middle GROUP BY 1),
near AS (SELECT r_lang, r_chars, r_words, {shares('chars', q.SCALE)} AS s_chars, {shares('words', q.SCALE)} AS s_words,
                list_sum(words) AS size, NOT coalesce({too_far}, false) AS near
         FROM texts JOIN med ON lang IS NOT DISTINCT FROM r_lang),
means AS (SELECT r_lang, any_value(r_chars) AS d_chars, any_value(r_words) AS d_words, bool_or(near) AS any_near, sum(size) AS r_size,
                 [{', '.join(f'coalesce(sum(s_chars[{i + 1}]) FILTER (near), 0)' for i in range(q.N_CHAR_CLASSES))}] AS m_chars,
                 [{', '.join(f'coalesce(sum(s_words[{i + 1}]) FILTER (near), 0)' for i in range(q.N_COMMON + 1))}] AS m_words FROM near GROUP BY 1),
ref AS (SELECT r_lang, r_size, CASE WHEN any_near THEN m_chars ELSE d_chars END AS r_chars, CASE WHEN any_near THEN m_words ELSE d_words END AS r_words FROM means)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(n_words >= {q.MIN_WORDS} AND r_size >= {q.REF_MIN_WORDS} AND {too_far}, false) AS kept
FROM b LEFT JOIN ref ON lang IS NOT DISTINCT FROM r_lang"""


def _canonical(x: str) -> str:
    sql = license_scan.canonical_sql(x).replace("\\\\", "\\")
    return sql.replace("$', '')", "$', '', 'g')").replace("]+', ' ')", "]+', ' ', 'g')")


def _op5() -> str:
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in license_scan.KNOWN)
    digests = ", ".join(f"('{d}', '{n}')" for n, d in license_scan.KNOWN_DIGESTS)
    return f"""
WITH k AS (SELECT digest, min(name) AS license FROM (SELECT sha256({_canonical('text')}) AS digest, name FROM (VALUES {rows}) v(name, text)
           UNION ALL SELECT digest, name FROM (VALUES {digests}) v(digest, name)) GROUP BY 1),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
f AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM l JOIN k ON sha256({_canonical('line')}) = k.digest GROUP BY 1)
SELECT d.doc_id, sha256({_canonical('t')}) AS digest, k.license, coalesce(f.names, '') AS line_licenses
FROM d LEFT JOIN k ON sha256({_canonical('t')}) = k.digest LEFT JOIN f ON f.doc_id = d.doc_id"""


def _op6() -> str:
    weight = f"[{', '.join(map(str, m.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(m.WEIGHTS)} + 1]"
    return rf"""
WITH s AS (SELECT doc_id, source, md5('{m.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS key,
                  len(list_filter(regexp_split_to_array(coalesce(text, ''), {_SPLIT}), lambda x: x <> ''))::BIGINT AS size FROM documents),
z AS (SELECT source, sum(size)::BIGINT AS n FROM s GROUP BY 1),
w AS (SELECT *, {weight} AS w, sum(n) OVER () AS total FROM z),
r AS (SELECT *, (total - coalesce(sum({m.MAX_REPEATS} * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS rest,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM w
      WINDOW o AS (ORDER BY {m.MAX_REPEATS} * n / w, source NULLS LAST)),
free AS (SELECT rest, ws FROM r WHERE rest * w / ws <= {m.MAX_REPEATS} * n ORDER BY rest DESC LIMIT 1),
t AS (SELECT source, n, least({m.MAX_REPEATS} * n, (SELECT rest FROM free) * w / (SELECT ws FROM free))::DOUBLE AS target FROM w),
g AS (SELECT *, CASE WHEN n > 0 THEN least({m.MAX_REPEATS}, floor(target / n))::BIGINT ELSE 0 END AS whole FROM t),
g2 AS (SELECT *, CASE WHEN whole < {m.MAX_REPEATS} THEN greatest(0, round(target)::BIGINT - whole * n) ELSE 0 END AS missing FROM g),
u AS (SELECT source, key, sum(size) AS words FROM s GROUP BY 1, 2),
c AS (SELECT u.*, missing, sum(words) OVER (PARTITION BY u.source ORDER BY key) AS cum
      FROM u JOIN g2 ON u.source IS NOT DISTINCT FROM g2.source WHERE missing > 0),
p AS (SELECT source, coalesce(max(cum) FILTER (cum <= missing), 0) AS had FROM c GROUP BY 1),
x AS (SELECT c.source, key, abs(missing - had - words) AS off FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source
      WHERE cum > missing AND abs(missing - had - words) < missing - had
      QUALIFY row_number() OVER (PARTITION BY c.source ORDER BY abs(missing - had - words), key) = 1),
more AS (SELECT source, key FROM c WHERE cum <= missing UNION ALL SELECT source, key FROM x)
SELECT s.doc_id, s.size, g2.n AS source_size, g2.target, s.size * (g2.whole + CASE WHEN more.key IS NULL THEN 0 ELSE 1 END) AS taken
FROM s JOIN g2 ON s.source IS NOT DISTINCT FROM g2.source
LEFT JOIN more ON s.source IS NOT DISTINCT FROM more.source AND s.key = more.key"""


_OP7 = r"""
WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(replace(replace(replace(text, '\', '\\'), '<', '<\'), '[', '[\')) AS n,
             length(replace(replace(replace(role, '\', '\\'), '<', '<\'), '[', '[\')) AS rn FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + rn + 9 + 1 + 7 + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""

_OP9 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_SPLIT}), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)
      UNION ALL SELECT doc_id, w[1] FROM d WHERE len(w) = 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS id, doc_id AS reach FROM d UNION SELECT l.x, r.reach FROM r JOIN l ON r.id = l.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(reach) AS component_id, min(reach) = d.doc_id AS kept
FROM d JOIN r ON r.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n"""


def _crc32(x: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    step = "lambda s, z: xor(s >> 1, 3988292384 * (s & 1))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda v: ord(v)::BIGINT)), "
            f"lambda s, b: list_reduce(list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), {step})), 4294967295)")


_OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_crc32("doc_id::VARCHAR")} AS h,
                  list_filter(regexp_split_to_array(coalesce(text, ''), {_SPLIT}), lambda x: x <> '') AS w FROM documents),
e AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
t AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
             list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w FROM e),
p AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS x FROM t),
g AS (SELECT r, n, i, hash(string_agg(x, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) AS g FROM p),
s AS (SELECT DISTINCT b.r, o.i - b.i AS q FROM g b JOIN g o ON b.r = o.r AND b.g = o.g AND o.i > b.i
      WHERE b.i % 8 = 0 AND o.i + 8 <= o.n AND 3 * (o.i - b.i) <= o.n),
c AS (SELECT s.r, s.q, x.i, x.i - row_number() OVER (PARTITION BY s.r, s.q ORDER BY x.i) AS island
      FROM s JOIN p x ON x.r = s.r JOIN p y ON y.r = s.r AND y.i = x.i + s.q AND y.x = x.x),
f AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM c GROUP BY r, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM f GROUP BY 1, 2, 3),
best AS (SELECT r, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS digest,
                first(struct_pack(start := start, length := length, period := period) ORDER BY length / period DESC, start, period) AS b FROM runs GROUP BY 1),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
k AS (SELECT p.r, string_agg(x, ' ' ORDER BY p.i) AS kept FROM p ANTI JOIN gone USING (r, i) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.start AS start, b.length AS length, b.period AS period,
       1000 * b.length // b.period AS exponent_milli, coalesce(digest, sha256('')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN best ON best.r = t.r LEFT JOIN k ON k.r = t.r"""


def _op12() -> str:
    # each match is wrapped in two private-use characters; a match alone has the same groups as in its text
    parts = " UNION ALL ".join(
        f"SELECT r, {i} AS i, '{rule.kind}' AS kind, {rule.least} AS least, string_split(regexp_replace(t, '{p}', chr(57345) || '\\0' || chr(57346), 'g'), chr(57345)) AS parts, "
        f"list_transform(regexp_extract_all(t, '{p}'), lambda m: length(regexp_extract(m, '{p}', {rule.group}))) AS sizes FROM d WHERE regexp_matches(t, '{p}')"
        for i, rule in enumerate(secret_scan.RULES) for p in [rule.pattern.replace("'", "''")])
    base = ", ".join(f"'{r.kind}'" for r in secret_scan.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({parts}),
u AS (SELECT r, i, kind, least, unnest(range(1, len(parts) + 1)) AS j, unnest(parts) AS part, sizes FROM m),
v AS (SELECT r, i, kind, j, sizes[j - 1] >= least AS long, length(split_part(part, chr(57346), 1)) AS size,
             sum(length(part)) OVER (PARTITION BY r, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - greatest(j - 2, 0) AS start FROM u),
s AS (SELECT r, i, kind, start::BIGINT AS start, kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT AS said FROM v WHERE j > 1 AND long),
a AS (SELECT r, {counts}, coalesce(string_agg(said, ',' ORDER BY start, i) FILTER (kind IN ({base})), '') AS base, string_agg(said, ',' ORDER BY start, i) AS spans
      FROM s GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.r = d.r"""


_OP13 = rf"""
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) AS i, token, chars FROM (
      SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token,
             length(coalesce(text, '')) AS chars FROM conversations)),
c AS (SELECT DISTINCT conv_id, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM o),
b AS (SELECT c.conv_id, o.i, token, chars FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.i <= h
      UNION ALL SELECT c.conv_id, o.i, token, chars FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > h),
q AS (SELECT c.conv_id, coalesce(list(token ORDER BY i) FILTER (token IS NOT NULL), []) AS tokens,
             coalesce(list(chars ORDER BY i) FILTER (token IS NOT NULL), []) AS chars FROM c LEFT JOIN b ON b.conv_id = c.conv_id GROUP BY 1),
x AS (SELECT conv_id, d, tokens[1:d] AS node, len(tokens) = d AS stops, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
      FROM (SELECT *, unnest(range(len(tokens) + 1)) AS d FROM q)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, first(chars) AS chars,
             sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (stops), '')) AS ends FROM x GROUP BY 1, 2),
k AS (SELECT node[1:d - 1] AS node, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN k ON k.node = n.node),
up AS (SELECT node[1:e] AS top, sum((kids = 0)::BIGINT)::BIGINT AS leaves, sum((n - 1) * chars)::BIGINT AS saved
       FROM (SELECT *, unnest(range(d + 1)) AS e FROM m) GROUP BY 1)
SELECT m.conv_id, m.d AS depth, p.conv_id AS parent_conv_id, m.n AS n_convs, m.kids AS n_children, up.leaves AS n_leaves, up.saved AS saved_tokens,
       m.ends AS ends_sha256 FROM m JOIN up ON up.top = m.node LEFT JOIN n p ON p.node = m.node[1:m.d - 1] AND p.d = m.d - 1"""

SQL = {"op2_substring_dedup": _OP2, "op4_quality_rules": _op4(), "op5_license_scan": _op5(), "op6_mix_sources": _op6(), "op7_chat_format": _OP7, "op9_near_dedup": _OP9,
       "op11_periodic_runs": _OP11, "op12_secret_scan": _op12(), "op13_prefix_trie": _OP13}
