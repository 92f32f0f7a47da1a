"""DuckDB SQL for the operators that SQL can express: the rule, by brute force."""

from __future__ import annotations

from collections.abc import Callable

from clickmart.llm import mixing, quality

_WORDS = r"regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')"

# Bytes as pairs of hexadecimal digits.
OP2 = """
WITH s AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS x, length(hex(encode(COALESCE(text, '')))) // 2 AS n FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(x, 2 * i - 1, 800)) AS h FROM s, LATERAL (SELECT unnest(range(1, n - 398)) AS i) r WHERE n >= 400),
t AS (SELECT h FROM w GROUP BY h HAVING COUNT(*) > 1),
g AS (SELECT w.doc_id, w.i, CASE WHEN w.i - lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) <= 400 THEN 0 ELSE 1 END AS fresh FROM w JOIN t USING (h)),
k AS (SELECT doc_id, i, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM g),
r AS (SELECT doc_id, run, MIN(i) AS lo, MAX(i) + 399 AS hi FROM k GROUP BY doc_id, run),
c AS (SELECT doc_id, COUNT(*) AS n_spans, SUM(hi - lo + 1) AS n_removed FROM r GROUP BY doc_id),
e AS (SELECT doc_id, hi + 1 AS a, COALESCE(lead(lo) OVER (PARTITION BY doc_id ORDER BY lo), 9000000000) - 1 AS z FROM r
      UNION ALL SELECT s.doc_id, 1, COALESCE(MIN(r.lo), 9000000000) - 1 FROM s LEFT JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id),
kept AS (SELECT s.doc_id, string_agg(substr(s.x, 2 * e.a - 1, 2 * (least(e.z, s.n) - e.a + 1)), '' ORDER BY e.a) AS x
      FROM s JOIN e ON e.doc_id = s.doc_id WHERE e.a <= least(e.z, s.n) GROUP BY s.doc_id)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_bytes, CAST(COALESCE(c.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(COALESCE(c.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(COALESCE(kept.x, ''))) AS kept_sha256
FROM s LEFT JOIN c ON c.doc_id = s.doc_id LEFT JOIN kept ON kept.doc_id = s.doc_id
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win FROM d, LATERAL (SELECT unnest(range(1, len(ws) - 11)) AS i) r WHERE len(ws) >= 13),
f AS (SELECT win, MIN(doc_id) AS first FROM w GROUP BY win),
g AS (SELECT DISTINCT w.doc_id, w.i + o.o AS p FROM w JOIN f USING (win), range(13) o(o) WHERE f.first < w.doc_id),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
k AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) FILTER (WHERE g.p IS NULL) AS kept, COUNT(g.p) AS n_removed
      FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(COALESCE(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

OP5 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(ws) - 2)) AS i) r WHERE len(ws) >= 4
      UNION ALL SELECT doc_id, concat('short ', len(ws), ' ', array_to_string(ws, ' ')) FROM d WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, COUNT(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS both FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.both >= 85 * (x.n + y.n - p.both)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT e.b, c.reach FROM c JOIN e ON e.a = c.doc_id AND c.reach < e.b)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, m.component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, MIN(reach) AS component_id FROM c GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""


def _js(n: str, m: str) -> str:
    """Jensen-Shannon term of shares ``n`` and ``m``."""
    return (f"(CASE WHEN {n} > 0 THEN {n} * log2({n} * 2 / ({n} + {m})) ELSE 0 END + "
            f"CASE WHEN {m} > 0 THEN {m} * log2({m} * 2 / ({n} + {m})) ELSE 0 END)")


def _op9() -> str:
    q = quality
    classes = {"upper": q.UPPER, "lower": q.LOWER, "digit": q.DIGIT, "space": q.SPACE + q.BLANK, "stop": q.STOP.replace("'", "''"), "mark": q.MARK}
    if tuple(classes) != q.CLASSES:
        raise ValueError("a class of quality.py has no SQL")
    names = (*classes, "rest")
    counted = ", ".join(f"length(regexp_replace(x, '[^{c}]+', '', 'g')) AS {n}" for n, c in classes.items())
    shares = ", ".join(f"SUM({n}) / SUM(chars) AS {n}" for n in names)
    apart = " + ".join(_js(f"o.{n} / o.chars", f"r.{n}") for n in names)
    return rf"""
WITH t AS (SELECT doc_id, lang, COALESCE(text, '') AS x, {_WORDS} AS ws FROM documents),
b AS (SELECT *, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(regexp_replace(x, '[^{q.SYMBOLS}]+', '', 'g')) AS n_symbols,
        list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
        {counted}, length(x) AS chars,
        list_filter(regexp_split_to_array(lower(x), '[^\p{{L}}]+'), lambda w: w <> '') AS letters FROM t),
a AS (SELECT *, chars - {' - '.join(classes)} AS rest FROM b),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS win FROM t, LATERAL (SELECT unnest(range(1, len(ws) - 1)) AS i) r WHERE len(ws) >= 3),
gr AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, win) AS c FROM g) y WHERE c > 1),
rep AS (SELECT doc_id, COUNT(DISTINCT i + o.o) AS n FROM gr, range(3) o(o) GROUP BY doc_id),
good AS (SELECT * FROM a WHERE len(letters) >= {q.MIN_WORDS} AND mark * {q.PLAIN} <= len(letters) AND 2 * upper <= chars
        AND {q.VARIED} * len(list_distinct(letters)) >= len(letters)),
refs AS (SELECT lang, {shares},
        SUM(len(letters)) AS total FROM (SELECT * FROM good UNION ALL SELECT * REPLACE (NULL AS lang) FROM good WHERE lang IS NOT NULL) z GROUP BY lang),
spoken AS (SELECT lang, w, COUNT(*) AS n FROM (SELECT lang, unnest(letters) AS w FROM good UNION ALL SELECT NULL, unnest(letters) FROM good WHERE lang IS NOT NULL) z
        WHERE length(w) <= {q.COMMON_LENGTH} GROUP BY lang, w),
common AS (SELECT s.lang, s.w, s.n / r.total AS share FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS k FROM spoken) s
        JOIN refs r ON r.lang IS NOT DISTINCT FROM s.lang WHERE k <= {q.COMMON_WORDS}),
own AS (SELECT a.*, CASE WHEN r.lang IS NULL THEN NULL ELSE a.lang END AS reference FROM a LEFT JOIN refs r ON r.lang = a.lang),
cd AS (SELECT o.doc_id, sqrt(greatest(0, ({apart}) / 2)) AS dist FROM own o JOIN refs r ON r.lang IS NOT DISTINCT FROM o.reference WHERE o.chars >= {q.MIN_CHARS}),
said AS (SELECT doc_id, w, COUNT(*) AS n FROM (SELECT doc_id, unnest(letters) AS w FROM own WHERE len(letters) >= {q.MIN_LETTER_WORDS}) z GROUP BY doc_id, w),
bins AS (SELECT o.doc_id, COALESCE(s.n, 0) / len(o.letters) AS p, c.share AS q FROM own o JOIN common c ON c.lang IS NOT DISTINCT FROM o.reference
        LEFT JOIN said s ON s.doc_id = o.doc_id AND s.w = c.w WHERE len(o.letters) >= {q.MIN_LETTER_WORDS}),
allbins AS (SELECT * FROM bins UNION ALL SELECT doc_id, greatest(0, 1 - SUM(p)), greatest(0, 1 - SUM(q)) FROM bins GROUP BY doc_id),
wd AS (SELECT doc_id, sqrt(greatest(0, SUM({_js('p', 'q')}) / 2)) AS dist FROM allbins GROUP BY doc_id),
j AS (SELECT a.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(COALESCE(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM a LEFT JOIN rep ON rep.doc_id = a.doc_id)
SELECT j.*, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words) AND COALESCE(round(cd.dist, 6), 0) <= {q.MAX_CLASS_DISTANCE}
  AND COALESCE(round(wd.dist, 6), 0) <= {q.MAX_WORD_DISTANCE} AS kept
FROM j LEFT JOIN cd ON cd.doc_id = j.doc_id LEFT JOIN wd ON wd.doc_id = j.doc_id
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes; ``crc_table`` is in scope."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({digits}), 2), lambda k: CAST('0x' || substr({digits}, CAST(k AS INTEGER) + 1, 2) AS BIGINT))"
    step = "xor(c >> 8, crc_table.t[CAST(xor(c, b) & 255 AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: {step}), 4294967295)"


_HALF = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC_TABLE = ("crc_table AS (SELECT list(c ORDER BY i) AS t FROM (WITH RECURSIVE s AS (SELECT i, 0 AS k, i AS c FROM range(256) x(i) "
              f"UNION ALL SELECT i, k + 1, {_HALF} FROM s WHERE k < 8) SELECT i, c FROM s WHERE k = 8) z)")

OP12 = rf"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, turn_id) AS i, turn_id, n FROM (
        SELECT conv_id, turn, md5(concat(length(COALESCE(role, '')), ' ', COALESCE(role, ''), COALESCE(text, ''))) AS turn_id, len({_WORDS}) AS n
        FROM conversations WHERE conv_id IS NOT NULL) z),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t) z, crc_table),
r AS (SELECT c.conv_id, 0 AS part, t.i, t.turn_id, t.n FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
      UNION ALL SELECT c.conv_id, 1, t.i, t.turn_id, t.n FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
p AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(turn_id, '') OVER w AS path, n FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING)
      UNION ALL SELECT conv_id, 0, '', 0 FROM c),
l AS (SELECT conv_id, MAX(depth) AS turns FROM p GROUP BY conv_id),
v AS (SELECT p.path, p.depth, MIN(p.conv_id) AS conv_id, COUNT(*) AS n_convs, MIN(p.n) AS n,
        sha256(COALESCE(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE l.turns = p.depth), '')) AS ends
      FROM p JOIN l ON l.conv_id = p.conv_id GROUP BY p.path, p.depth),
k AS (SELECT u.path, COUNT(*) AS n_children FROM v JOIN v u ON u.path = left(v.path, 32 * (v.depth - 1)) WHERE v.depth > 0 GROUP BY u.path),
s AS (SELECT a.path, COUNT(*) FILTER (WHERE k.path IS NULL) AS n_leaves, SUM((v.n_convs - 1) * v.n) AS saved
      FROM v LEFT JOIN k ON k.path = v.path JOIN p a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.path)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs, CAST(COALESCE(k.n_children, 0) AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM v JOIN s ON s.path = v.path LEFT JOIN k ON k.path = v.path LEFT JOIN v u ON v.depth > 0 AND u.path = left(v.path, 32 * (v.depth - 1))
"""

# Words less one letter meet: at the same place where one was replaced, with a whole word where one is missing.
OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
u AS (SELECT doc, run, length(run) AS size, COUNT(*) AS n FROM (SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM r) z GROUP BY doc, run),
h AS (SELECT run, size, n, {_crc32("doc || ':' || run")} AS h FROM u, crc_table),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % size AS INTEGER)) || substr(run, CAST(h % size AS INTEGER) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, length(word) AS size, CAST(SUM(n) AS BIGINT) AS n FROM w GROUP BY word HAVING length(word) >= 7 AND SUM(n) >= 2),
d AS (SELECT word, n, i, substr(word, 1, CAST(i AS INTEGER) - 1) || substr(word, CAST(i AS INTEGER) + 1) AS rest FROM v, LATERAL (SELECT unnest(range(1, size + 1)) AS i) x),
near AS (SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON b.rest = a.rest AND b.i = a.i AND b.word <> a.word
         UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.rest UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.rest),
best AS (SELECT word, COUNT(*) AS n_near, MAX(n) AS most, first(other ORDER BY n DESC, encode(other)) AS other FROM near GROUP BY word),
f AS (SELECT v.word, v.n, COALESCE(best.n_near, 0) AS n_near, CASE WHEN best.most >= 10 * v.n THEN best.other END AS form,
        CASE WHEN best.most >= 10 * v.n THEN best.most END AS form_n FROM v LEFT JOIN best ON best.word = v.word),
c AS (SELECT word, word AS root FROM f UNION SELECT c.word, f.form FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM f JOIN c ON c.word = f.word JOIN f g ON g.word = c.root WHERE g.form IS NULL
"""


def texts() -> dict[str, Callable[[], str]]:
    return {"op2_suffix_dedup": lambda: OP2, "op4_window_dedup": lambda: OP4, "op5_jaccard_join": lambda: OP5, "op7_mix_sources": lambda: mixing.ORACLE,
            "op9_quality_rules": _op9, "op12_radix_trie": lambda: OP12, "op13_spelling_variants": lambda: OP13}
