"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from cardwatch.llm import importance, url_filter
from cardwatch.llm.filter_audit import FILTERS
from cardwatch.llm.license_scan import TEMPLATES
from cardwatch.llm.quality_rules import STOP_WORDS
from cardwatch.llm.shared import LOWER, UPPER

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

OP2 = f"""
WITH t AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS c, generate_subscripts(words, 1) AS i FROM t),
g AS (SELECT doc_id, i, c, lag(c) OVER o AS b, lag(c, 2) OVER o AS a FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
d1 AS (SELECT doc_id, c, count(*) AS own FROM g GROUP BY ALL),
d2 AS (SELECT doc_id, b, c, count(*) AS own FROM g WHERE b IS NOT NULL GROUP BY ALL),
d3 AS (SELECT doc_id, a, b, c, count(*) AS own FROM g WHERE a IS NOT NULL GROUP BY ALL),
c1 AS (SELECT *, sum(own) OVER (PARTITION BY c) - own AS other FROM d1),
c2 AS (SELECT *, sum(own) OVER (PARTITION BY b, c) - own AS other FROM d2),
c3 AS (SELECT *, sum(own) OVER (PARTITION BY a, b, c) - own AS other FROM d3),
s AS (SELECT g.doc_id, i, (SELECT count(*) FROM w) - count(*) OVER (PARTITION BY g.doc_id) AS rest,
             x.other::DOUBLE AS o1, y.other::DOUBLE AS o2, z.other::DOUBLE AS o3,
             x1.other::DOUBLE AS before1, y1.other::DOUBLE AS before2
      FROM g JOIN c1 x ON x.doc_id = g.doc_id AND x.c = g.c
      LEFT JOIN c2 y ON y.doc_id = g.doc_id AND y.b = g.b AND y.c = g.c
      LEFT JOIN c3 z ON z.doc_id = g.doc_id AND z.a = g.a AND z.b = g.b AND z.c = g.c
      LEFT JOIN c1 x1 ON x1.doc_id = g.doc_id AND x1.c = g.b
      LEFT JOIN c2 y1 ON y1.doc_id = g.doc_id AND y1.b = g.a AND y1.c = g.b),
v1 AS (SELECT *, CASE WHEN o1 > 0 THEN o1 / rest ELSE 1 / (rest + 1)::DOUBLE END AS v FROM s),
v2 AS (SELECT * EXCLUDE v, CASE WHEN o2 > 0 THEN o2 / before1 WHEN i > 1 THEN 0.4::DOUBLE * v ELSE v END AS v FROM v1),
v3 AS (SELECT *, CASE WHEN o3 > 0 THEN o3 / before2 WHEN i > 2 THEN 0.4::DOUBLE * v ELSE v END AS value FROM v2),
n AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (o3 > 0) AS n_3grams,
             count(*) FILTER (o2 > 0 AND NOT coalesce(o3 > 0, false)) AS n_2grams,
             count(*) FILTER (NOT coalesce(o2 > 0, false) AND NOT coalesce(o3 > 0, false)) AS n_1grams,
             count(*) FILTER (o1 = 0) AS n_unseen, sum(round(ln(value) * 1000000)::BIGINT)::BIGINT AS log_sum
      FROM v3 GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_1grams, 0) AS n_1grams, coalesce(n_2grams, 0) AS n_2grams,
       coalesce(n_3grams, 0) AS n_3grams, coalesce(n_unseen, 0) AS n_unseen, log_sum / 1000000::DOUBLE / n_words AS score
FROM t LEFT JOIN n USING (doc_id)
"""

OP5 = f"""
WITH t AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP8 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS word,
             generate_subscripts(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1) AS i FROM t),
g AS (SELECT doc_id, i, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third FROM w
      WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM g WHERE third IS NOT NULL
      QUALIFY count(*) OVER (PARTITION BY doc_id, word, second, third) > 1),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM r) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
             count(*) FILTER (word IN ({_STOP})) AS n_stop_words FROM w GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             len(regexp_extract_all(text, '[!?]')) AS n_marks,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_stop_words, 0) AS n_stop_words
      FROM t LEFT JOIN s USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN d USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 25 * n_words OR 100 * n_marks > 50 * n_words
            OR 100 * n_stop_words < n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""


def _licences() -> str:
    key = ", ".join(
        f"({n}, '{t.label}', {str(t.base).lower()}, {t.text.split().index(t.key.split()[0])}, "
        f"{t.key.split()!r}, {t.text.split()!r})"
        for n, t in enumerate(TEMPLATES)
    )
    return f"""
WITH p(n, label, base, key_at, key, words) AS (VALUES {key}),
t AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS found FROM documents),
w AS (SELECT doc_id, unnest(found) AS word, generate_subscripts(found, 1) - 1 AS i FROM t),
k AS (SELECT n, unnest(key) AS word, generate_subscripts(key, 1) - 1 AS pos FROM p),
x AS (SELECT n, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM p),
c AS (SELECT doc_id, n, i - pos AS start, count(*) AS met FROM w JOIN k USING (word) GROUP BY ALL),
h AS (SELECT doc_id, n, start FROM c JOIN p USING (n) WHERE met = len(key)),
a AS (SELECT doc_id, n, i - pos AS text_start, count(*) AS aligned FROM w JOIN x USING (word) GROUP BY ALL),
f AS (SELECT h.doc_id, h.n, h.start, label, base, aligned / len(words)::DOUBLE AS score
      FROM h JOIN p USING (n) JOIN a ON a.doc_id = h.doc_id AND a.n = h.n AND a.text_start = h.start - p.key_at),
g AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
             max(start) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM f GROUP BY doc_id)
SELECT t.doc_id, len(found) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM t LEFT JOIN g USING (doc_id)
"""


# Words, their runs, and the CRC-32 of a run as the XOR of what each byte contributes at its distance from the end.
OP11 = f"""
WITH RECURSIVE start(byte, step, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT byte, step + 1, xor(c >> 1, 3988292384 * (c & 1)) FROM start WHERE step < 8),
tab AS (SELECT byte, c FROM start WHERE step = 8),
words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
one AS (SELECT side, id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM words),
three AS (SELECT side, id, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM one WINDOW o AS (PARTITION BY side, id ORDER BY i)),
runs AS (
  SELECT side, id, a AS run FROM three
  UNION ALL SELECT side, id, a || ' ' || b FROM three WHERE b IS NOT NULL
  UNION ALL SELECT side, id, a || ' ' || b || ' ' || c FROM three WHERE c IS NOT NULL),
kinds AS (SELECT DISTINCT run, strlen(run) AS n, hex(encode(run)) AS h FROM runs),
far(d, byte, c) AS (
  SELECT 0, byte, c FROM tab
  UNION ALL SELECT d + 1, far.byte, xor(far.c >> 8, tab.c) FROM far JOIN tab ON tab.byte = (far.c & 255)
  WHERE d < (SELECT max(n) FROM kinds)),
init(n, c) AS (
  SELECT 0::BIGINT, 4294967295
  UNION ALL SELECT n + 1, xor(init.c >> 8, tab.c) FROM init JOIN tab ON tab.byte = (init.c & 255)
  WHERE n < (SELECT max(n) FROM kinds)),
bytes AS (
  SELECT run, n - 1 - i AS d, ('0x' || substr(h, 2 * i + 1, 2))::INTEGER AS byte
  FROM (SELECT run, n, h, unnest(range(n)) AS i FROM kinds)),
sums AS (SELECT run, bit_xor(c) AS c FROM bytes JOIN far USING (d, byte) GROUP BY run),
buckets AS (
  SELECT run, xor(xor(sums.c, init.c), 4294967295) % {importance.BUCKETS} AS bucket
  FROM sums JOIN kinds USING (run) JOIN init USING (n)),
used AS (SELECT side, id, bucket, count(*) AS n FROM runs JOIN buckets USING (run) GROUP BY ALL),
per AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM used GROUP BY bucket),
whole AS (SELECT sum(s) AS s, sum(t) AS t FROM per),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(per.t, 0) + 1)::DOUBLE * (whole.s + {importance.BUCKETS}))
                                 / ((coalesce(per.s, 0) + 1)::DOUBLE * (whole.t + {importance.BUCKETS}))))::BIGINT AS gain
  FROM per, whole),
weights AS (SELECT id AS doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
            FROM used JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
noise AS (SELECT id AS doc_id, len(w) AS n_words,
                 ('0x' || substr(sha256('{importance.SEED}:' || id::VARCHAR), 1, 8))::BIGINT AS h FROM words WHERE side = 'd'),
scored AS (
  SELECT doc_id, n_words >= {importance.MIN_WORDS} AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM noise LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN eligible AND place <= (SELECT count(*) * {importance.PERCENT} // 100 FROM scored WHERE eligible)
            THEN place END AS rank
FROM placed
"""


def _url_filter() -> str:
    host = f"translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}')"
    fits = lambda r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
    longest = sorted(url_filter.RULES, key=lambda r: -len(r.name))
    pick = lambda what: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{what(r)}'" for r in longest) + " END"
    passed, given = url_filter.PASSED_ON, 100 - url_filter.PASSED_ON
    rounds = "".join(
        f"""h{k} AS (SELECT host, sum(trust)::BIGINT AS trust, sum(distrust)::BIGINT AS distrust FROM (
  SELECT target AS host, trust * {passed} // (100 * out) * n AS trust, 0 AS distrust FROM edges JOIN h{k - 1} ON host = source
  UNION ALL SELECT source, 0, distrust * {passed} // (100 * into_) * n FROM edges JOIN h{k - 1} ON host = target
  UNION ALL SELECT host, trust * {given} // 100, distrust * {given} // 100 FROM h0) GROUP BY host),
"""
        for k in range(1, url_filter.ROUNDS + 1)
    )
    return f"""
WITH split AS (SELECT page_id, html, {host} AS host,
                      regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
ruled AS (SELECT *, {pick(lambda r: r.name)} AS rule, {pick(lambda r: r.action)} AS action FROM split),
hosts AS (SELECT host, 2 * count(*) FILTER (action = 'allow') > count(*) AS trusted,
                 2 * count(*) FILTER (action = 'block') > count(*) AS blocked FROM ruled WHERE host <> '' GROUP BY host),
hrefs AS (SELECT host AS source, unnest(regexp_extract_all(coalesce(html, ''),
            '<a\\b[^>]*?\\shref\\s*=\\s*["'']?\\s*((?:https?:)?//[^"''\\s>]+)', 1, 'i')) AS url FROM split),
links AS (SELECT source, translate(regexp_extract(url, '//([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS target FROM hrefs),
counted AS (SELECT source, target, count(*) AS n FROM links WHERE source <> target AND source <> '' AND target <> '' GROUP BY ALL),
edges AS (SELECT *, sum(n) OVER (PARTITION BY source) AS out, sum(n) OVER (PARTITION BY target) AS into_ FROM counted),
h0 AS (SELECT host, CASE WHEN trusted THEN {url_filter.UNIT} // (SELECT count(*) FROM hosts WHERE trusted) ELSE 0 END AS trust,
              CASE WHEN blocked THEN {url_filter.UNIT} // (SELECT count(*) FROM hosts WHERE blocked) ELSE 0 END AS distrust FROM hosts),
{rounds}settled AS (SELECT * FROM h{url_filter.ROUNDS})
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN settled USING (host)
"""


def _filter_audit() -> str:
    bits = {name: 1 << i for i, name in enumerate(FILTERS)}
    before = " + ".join(f"CASE WHEN strpos(filter_order, '{name}') < step THEN {bit} ELSE 0 END" for name, bit in bits.items())
    own = " + ".join(f"CASE WHEN strpos(filter_order, '{name}') = step THEN {bit} ELSE 0 END" for name, bit in bits.items())
    letters = ", ".join(f"('{name}')" for name in FILTERS)
    return f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
m AS (SELECT doc_id, part,
             {bits["A"]} * (len(words) < 50)::INTEGER
             + {bits["B"]} * (100 * len(list_distinct(words)) < 65 * len(words))::INTEGER
             + {bits["C"]} * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INTEGER
             + {bits["D"]} * regexp_matches(text, '[#$%&*|]')::INTEGER
             + {bits["E"]} * (doc_id > min(doc_id) OVER (PARTITION BY text))::INTEGER AS mask FROM t),
l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
f(x) AS (VALUES {letters}),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step::INTEGER AS step FROM o, range(1, 6) r(step)),
k AS (SELECT *, {before} AS before, {own} AS own FROM s),
r AS (SELECT part, filter_order, step, own,
             sum(n) FILTER (mask & own = 0 AND mask & before = 0) AS kept,
             sum(n) FILTER (mask & own <> 0 AND mask & before = 0) AS removed,
             sum(n) FILTER (mask & own <> 0 AND mask & before <> 0) AS redundant,
             sum(n) FILTER (mask = own) AS unique_fails,
             sum(good) FILTER (mask & own <> 0 AND mask & before = 0) AS good_lost,
             sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0) AS toxic_lost
      FROM c, k GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_lm_scoring": OP2,
        "op5_exact_dedup": OP5,
        "op8_quality_rules": OP8,
        "op9_license_scan": _licences(),
        "op11_importance_resampling": OP11,
        "op12_url_filter": _url_filter(),
        "op13_filter_audit": _filter_audit(),
    }
