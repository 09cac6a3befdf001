"""DuckDB SQL for the numbered queries that SQL can express.

The others have none: language model, classifier and block labeller are
trained, mixing depends on hash functions that SQL lacks, and line chunks have
none yet; tests/llm holds them against brute force or held-out rows.
"""

from __future__ import annotations

from . import licenses
from .quality_rules import Rules

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, lower: bool, table: str = "documents", key: str = "doc_id") -> str:
    text = f"translate(text, {_UPPER})" if lower else "text"
    return f"SELECT {key}, coalesce(text, '') AS text, regexp_extract_all(coalesce({text}, ''), '{pattern}') AS w FROM {table}"


def quality_sql(r: Rules) -> str:
    marks = r"[#*$%&|<>@^~_=+{}\[\]\\`]"
    white = r"[ \t\n\x0b\x0c\r]"
    boiler = (
        "all rights reserved|cookie policy|(?:we|site) uses? cookies|privacy policy|terms (?:of|and) (?:use|service|conditions)|enable javascript|lorem ipsum|click here|"
        r"subscribe (?:now|to our)|sign (?:up|in) |log ?in to|powered by|skip to (?:main )?content|read more\b|share (?:this|on) |follow us|back to top"
    )
    terminal = r"""(?:[.!?:;]|…|。|！|？)(?:["'')\]]|”|»)*$"""
    return rf"""WITH d AS ({_words(_SPACED, False)}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
facts AS (SELECT doc_id, line, len(regexp_extract_all(line, '{_SPACED}')) AS nw, strlen(regexp_replace(line, '{white}', '', 'g')) AS nb,
    len(regexp_extract_all(line, '{marks}')) AS nm, len(list_filter(string_split_regex(line, '[ \t]'), lambda x: x IN ('|', '>', '-', '»', '›', '•', '·'))) AS ns,
    len(regexp_extract_all(line, '[!?]')) AS nc, len(regexp_extract_all(line, '[A-Z]')) AS nu, len(regexp_extract_all(line, '[A-Za-z]')) AS nl
  FROM lines),
judged AS (SELECT *, CASE
    WHEN nw = 0 THEN NULL
    WHEN nm > {r.max_mark_share} * nb AND NOT contains(line, '|') THEN 'punctuation'
    WHEN ns >= {r.min_nav_separators} AND nw - ns <= {r.nav_words_per_separator} * (ns + 1) THEN 'navigation'
    WHEN nm > {r.max_mark_share} * nb THEN 'punctuation'
    WHEN nc >= {r.min_cries} AND nc > {r.max_cries_per_word} * nw THEN 'punctuation'
    WHEN nu >= {r.min_shouted_letters} AND nu > {r.max_shouted_share} * nl THEN 'punctuation'
    WHEN nw < {r.min_unpunctuated_words} AND NOT regexp_matches(regexp_replace(line, '{white}+$', ''), '{terminal}') THEN 'punctuation'
    WHEN nw <= {r.max_boilerplate_words} AND regexp_matches(translate(line, {_UPPER}), '{boiler}') THEN 'boilerplate' END AS why
  FROM facts),
by_doc AS (SELECT doc_id, sum(nb) AS total, coalesce(sum(nb) FILTER (WHERE why IS NOT NULL), 0) AS lost, count(*) FILTER (WHERE nw > 0) - count(DISTINCT line) FILTER (WHERE nw > 0) AS dups,
    count(*) FILTER (WHERE why = 'punctuation') AS p, count(*) FILTER (WHERE why = 'navigation') AS n, count(*) FILTER (WHERE why = 'boilerplate') AS b FROM judged GROUP BY doc_id),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
often AS (SELECT doc_id, t FROM tri GROUP BY doc_id, t HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM tri JOIN often USING (doc_id, t)) GROUP BY doc_id),
counts AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{white}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN repeated r USING (doc_id)),
based AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_pct} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, dups AS n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lost <= {r.max_lost_share} * total AS kept,
  CAST(lost AS BIGINT) AS lost_bytes, p AS n_punctuation, n AS n_navigation, b AS n_boilerplate FROM based JOIN by_doc USING (doc_id)"""


def near_duplicates_sql() -> str:
    return f"""WITH RECURSIVE d AS ({_words(_SPACED, True)}),
sets AS (SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM sets UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON r.node = e.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept FROM sets JOIN (SELECT node, min(root) AS c FROM reach GROUP BY node) ON doc_id = node"""


def suffix_sql(depth: int) -> str:
    return f"""WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS h, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents),
windows AS (SELECT doc_id, s, array_slice(h, s, s + {depth - 1}) AS x FROM (SELECT doc_id, h, unnest(range(1, n_bytes - {depth} + 2)) AS s FROM d)),
first_doc AS (SELECT x, min(doc_id) AS lo FROM windows GROUP BY x HAVING count(*) > 1),
again AS (SELECT doc_id, s FROM windows JOIN first_doc USING (x) WHERE doc_id > lo),
marked AS (SELECT doc_id, s, CAST(coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {depth}, true) AS INTEGER) AS fresh FROM again),
numbered AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked),
runs AS (SELECT doc_id, run, min(s) AS a, max(s) + {depth - 1} AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
cut AS (SELECT doc_id, sum(b - a + 1) AS removed, count(*) AS n, max(b) AS last, string_agg(CASE WHEN a > before + 1 THEN hex(array_slice(h, before + 1, a - 1)) ELSE '' END, '' ORDER BY a) AS kept
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(CASE WHEN removed IS NULL THEN h ELSE unhex(kept || CASE WHEN last < n_bytes THEN hex(array_slice(h, last + 1, n_bytes)) ELSE '' END) END) AS kept_sha256 FROM d LEFT JOIN cut USING (doc_id)"""


def license_sql(templates: tuple[licenses.Template, ...], shift: int, coverage: float) -> str:
    grams = ", ".join(f"({t}, {i}, '{a} {b}')" for t, x in enumerate(templates) for i, (a, b) in enumerate(zip(x.words(), x.words()[1:], strict=False)))
    kinds = ", ".join(f"({t}, '{x.label}', {str(x.base).lower()}, {str(x.exact).lower()}, {len(x.words()) - 1})" for t, x in enumerate(templates))
    return f"""WITH d AS ({_words(_ALNUM, True)}),
grams(tpl, tpos, g) AS (VALUES {grams}), kinds(tpl, label, base, exact, n) AS (VALUES {kinds}),
places AS (SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
diagonals AS (SELECT doc_id, tpl, pos - tpos AS diagonal, list_distinct(list(tpos)) AS found_at FROM places JOIN grams USING (g) GROUP BY doc_id, tpl, pos - tpos),
apart AS (SELECT *, CAST(coalesce(exact OR diagonal - lag(diagonal) OVER (PARTITION BY doc_id, tpl ORDER BY diagonal) > {shift}, true) AS INTEGER) AS fresh FROM diagonals JOIN kinds USING (tpl)),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, tpl ORDER BY diagonal) AS part FROM apart),
merged AS (SELECT doc_id, tpl, label, base, exact, n, min(diagonal + list_min(found_at)) AS a, max(diagonal + list_max(found_at) + 2) AS b, len(list_distinct(flatten(list(found_at)))) AS found
  FROM grouped GROUP BY doc_id, tpl, part, label, base, exact, n),
spans AS (SELECT *, CAST(found AS DOUBLE) / n AS share FROM merged WHERE CASE WHEN exact THEN found = n ELSE CAST(found AS DOUBLE) / n >= {coverage} AND b - a <= 2 * (n + 1) END),
by_doc AS (SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(a) FILTER (WHERE base) AS lo, max(a) FILTER (WHERE base) AS hi,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM d LEFT JOIN by_doc USING (doc_id)"""


_WARC = """WITH x AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM x WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM x LEFT JOIN f USING (h)"""


def decontaminate_sql(window: int) -> str:
    return f"""WITH d AS ({_words(_ALNUM, True)}), q AS ({_words(_ALNUM, True, "benchmark", "item_id")}),
sized AS (SELECT item_id, w, least({window}, len(w)) AS n FROM q WHERE len(w) > 0),
needles AS (SELECT DISTINCT item_id, n, array_slice(w, s, s + n - 1) AS x FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
sizes AS (SELECT DISTINCT n FROM needles),
windows AS (SELECT doc_id, s, n, array_slice(w, s, s + n - 1) AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM windows JOIN needles USING (n, x)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""


def search_sql(top: int) -> str:
    return f"""WITH d AS ({_words(_ALNUM, True)}), numbered AS (SELECT row_number() OVER () AS r, doc_id, len(w) AS n, w FROM d WHERE len(w) > 0),
sums AS (SELECT count(*) AS cn, CAST(sum(n) AS BIGINT) AS cl FROM numbered),
q AS (SELECT DISTINCT item_id, unnest(w) AS term FROM ({_words(_ALNUM, True, "benchmark", "item_id")})),
held AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM numbered) SEMI JOIN q USING (term) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * cn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM held GROUP BY term), sums),
scored AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * cn) // cl)))) AS BIGINT) AS score FROM q JOIN held USING (term) JOIN weights USING (term), sums GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {top}"""


def phrases_sql(least: int, longest: int, top: int) -> str:
    return rf"""WITH RECURSIVE orders(o) AS (SELECT unnest(range(1, {longest + 1}))),
d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {_UPPER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, array_slice(w, s, s + o - 1) AS g FROM (SELECT lang, w, o, unnest(range(1, len(w) - o + 2)) AS s FROM w, orders WHERE len(w) >= o)),
f AS (SELECT lang, g, count(*) AS c FROM grams GROUP BY lang, g HAVING count(*) >= {least}),
cuts AS (SELECT lang, g, c, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
scored AS (SELECT x.lang, x.g, x.c AS a, k, p.c AS l, q.c AS r, n, CAST((1000::HUGEINT * x.c * n) // (p.c::HUGEINT * q.c) AS BIGINT) AS score
  FROM cuts x JOIN f p ON p.lang = x.lang AND p.g = array_slice(x.g, 1, k) JOIN f q ON q.lang = x.lang AND q.g = array_slice(x.g, k + 1, len(x.g)) JOIN totals t ON t.lang = x.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (SELECT DISTINCT lang, c, array_slice(g, s, s + o - 1) AS g FROM (SELECT lang, g, c, o, unnest(range(1, len(g) - o + 2)) AS s FROM f, orders WHERE o > 1 AND o < len(g))),
dropped AS (SELECT DISTINCT l.lang, l.g FROM lowest l JOIN inner_parts i ON i.lang = l.lang AND i.g = l.g AND 100 * i.c >= 100 * l.a),
kept AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM lowest ANTI JOIN dropped USING (lang, g))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {top}"""


ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": quality_sql(Rules()),
    "op2_near_duplicates": near_duplicates_sql(),
    "op4_suffix_dedup": suffix_sql(50),
    "op6_license_scan": license_sql(licenses.TEMPLATES, 4, 0.5),
    "op7_warc": _WARC,
    "op9_decontaminate": decontaminate_sql(13),
    "op11_phrases": phrases_sql(100, 5, 2000),
    "op12_lexical_search": search_sql(10),
}
