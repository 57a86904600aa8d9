"""DuckDB SQL that gives the rows of those queries that SQL can express, by plain means where these are fast enough."""

from __future__ import annotations

from collections.abc import Sequence

from . import license_scan, phrases
from .quality_rules import BOUND, MIN_DOCS, SIGNALS, SPREADS
from .ranked_search import TOP
from .url_filter import LOWER, UPPER, Rule

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def url_filters(rules: Sequence[Rule]) -> str:
    values = ", ".join(f"('{r.host}', '{r.path}', '{r.text}', '{r.verdict}')" for r in rules)
    return f"""
    WITH rules(rule_host, rule_path, rule, verdict) AS (VALUES {values}),
    rest AS (
      SELECT page_id, row_number() OVER () AS row, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (
      SELECT page_id, row, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
      FROM rest),
    best AS (
      SELECT row, max_by(rule, 1000000 * length(rule_host) + length(rule_path)) AS rule,
             max_by(verdict, 1000000 * length(rule_host) + length(rule_path)) AS verdict
      FROM parts JOIN rules ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path) GROUP BY row)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (row)"""


def near_duplicates(percent: int = 80) -> str:
    """Two-word shingles; all pairs that share one, and components by reachability."""
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"""
    WITH RECURSIVE words AS (SELECT doc_id, {WORDS.format(text=lowered)} AS w FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) < 2 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
    members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM members AS a JOIN members AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)"""


def line_dedup(percent: int = 80) -> str:
    """Word sets joined on words of their prefixes, rare words first, and compared as lists."""
    return f"""
    WITH lines AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
      FROM documents WHERE text IS NOT NULL),
    sets AS (
      SELECT doc_id, line_no, list_sort(list_distinct({WORDS.format(text="line")})) AS s FROM lines),
    full_lines AS (SELECT * FROM sets WHERE len(s) > 0),
    classes AS (SELECT s, row_number() OVER () AS id, len(s) AS n, min((doc_id, line_no)) AS first FROM full_lines GROUP BY s),
    tokens AS (SELECT id, n, unnest(s) AS word FROM classes),
    counts AS (SELECT word, count(*) AS c FROM tokens GROUP BY word),
    ranked AS (SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY c, word) AS spot FROM tokens JOIN counts USING (word)),
    prefixes AS (SELECT id, word FROM ranked WHERE spot <= n - (n * {percent} + 99) // 100 + 1),
    pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM prefixes AS a JOIN prefixes AS b ON a.word = b.word AND a.id <> b.id),
    matches AS (
      SELECT a, x.first AS first FROM pairs JOIN classes AS y ON y.id = a JOIN classes AS x ON x.id = b
      WHERE 100 * len(list_intersect(x.s, y.s)) >= {percent} * (x.n + y.n - len(list_intersect(x.s, y.s)))),
    best AS (SELECT id, s, least(first, (SELECT min(m.first) FROM matches AS m WHERE m.a = id)) AS best FROM classes),
    marked AS (SELECT doc_id, line_no, (doc_id, line_no) > best AS gone FROM full_lines JOIN best USING (s))
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
           coalesce(string_agg(CAST(line_no AS VARCHAR), ' ' ORDER BY line_no) FILTER (WHERE gone), '') AS removed_lines
    FROM marked GROUP BY doc_id"""


def quality_rules(min_docs: int = MIN_DOCS) -> str:
    shares = ", ".join(f"least({n} * 1000 // greatest({d}, 1), 1000) AS share_{s}" for s, (n, d, _) in SIGNALS.items())

    def cut(signal: str, spread: int) -> str:
        at = [f"list_sort(list(share_{signal}))[CAST(ceil({q} * count(*) / 4.0) AS INTEGER)]" for q in (1, 2, 3)]
        return f"{at[1]} + {SPREADS} * greatest({at[2]} - {at[0]}, {spread}) AS cut_{signal}"

    cuts = ", ".join(cut(s, spread) for s, (_, _, spread) in SIGNALS.items())
    passes = " AND ".join(
        f"share_{s} <= least({BOUND} * w.cut_{s}, CASE level WHEN 'source' THEN f.cut_{s} WHEN 'lang' THEN m.cut_{s} ELSE w.cut_{s} END)" for s in SIGNALS
    )
    return rf"""
    WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
    split AS (
      SELECT *, {WORDS.format(text="text")} AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
    spots AS (
      SELECT row, unnest(range(1, len(w) - 3)) AS spot, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS win
      FROM split WHERE len(w) >= 5),
    again AS (SELECT row, spot, count(*) OVER (PARTITION BY row, win) AS times FROM spots),
    covered AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(spot, spot + 5)) AS place FROM again WHERE times > 1) AS p GROUP BY row),
    counts AS (
      SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM split LEFT JOIN covered USING (row)),
    shared AS (SELECT *, {shares}, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
    fine AS (SELECT lang, source, count(*) AS docs, {cuts} FROM shared GROUP BY lang, source),
    middle AS (SELECT lang, count(*) AS docs, {cuts} FROM shared GROUP BY lang),
    whole AS (SELECT count(*) AS docs, {cuts} FROM shared),
    levels AS (
      SELECT c.*, CASE WHEN f.docs >= {min_docs} THEN 'source' WHEN m.docs >= {min_docs} THEN 'lang' ELSE 'corpus' END AS level, f, m, w
      FROM shared AS c JOIN fine AS f ON c.lang IS NOT DISTINCT FROM f.lang AND c.source IS NOT DISTINCT FROM f.source
      JOIN middle AS m ON c.lang IS NOT DISTINCT FROM m.lang JOIN whole AS w ON true)
    SELECT doc_id, n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words, base_failed, level,
           NOT base_failed AND {passes} AS kept FROM levels"""


def collocations(least: int = phrases.LEAST, top: int = phrases.TOP) -> str:
    """All phrases as text, counted; parts and longer phrases met by joins on text."""
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return rf"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lowered}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    spots AS (
      SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM split, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
    counts AS (SELECT lang, k, phrase, count(*) AS f FROM spots GROUP BY lang, k, phrase),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
    frequent AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= {least}),
    parts AS (
      SELECT lang, phrase AS whole, f AS a, cut, unnest(['l', 'r']) AS side,
             unnest([array_to_string(w[1:cut], ' '), array_to_string(w[cut + 1:k], ' ')]) AS phrase
      FROM frequent JOIN (VALUES (1), (2), (3)) AS places(cut) ON cut < k),
    sides AS (
      SELECT p.lang, whole AS phrase, a, cut, max(f) FILTER (WHERE side = 'l') AS l, max(f) FILTER (WHERE side = 'r') AS r
      FROM parts AS p JOIN counts AS c ON p.lang = c.lang AND p.phrase = c.phrase GROUP BY p.lang, whole, a, cut),
    cuts AS (SELECT *, CAST(CAST(a AS HUGEINT) * {phrases.SCALE} // (l + r) AS BIGINT) AS score FROM sides),
    best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS turn FROM cuts),
    inside AS (
      SELECT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, c.f
      FROM frequent AS c JOIN (VALUES (2), (3)) AS sizes(m) ON m < c.k JOIN (VALUES (1), (2), (3)) AS places(i) ON i + m - 1 <= c.k),
    gone AS (SELECT DISTINCT p.lang, p.phrase FROM inside AS o JOIN frequent AS p ON o.lang = p.lang AND o.phrase = p.phrase WHERE 100 * o.f >= {phrases.EXPLAINED} * p.f),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM best ANTI JOIN gone USING (lang, phrase) WHERE turn = 1)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""


def license_scans(share: int = license_scan.SHARE) -> str:
    """Words as lists; places of phrases by comparing lists, votes of templates by joining runs as text."""
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    size, gap = license_scan.RUN, license_scan.GAP
    listed, known = (", ".join(f"({at}, '{t}', '{b}')" for at, (t, b) in enumerate(x.items())) for x in (license_scan.PHRASES, license_scan.TEMPLATES))
    return rf"""
    WITH texts AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    phrases AS (SELECT string_split(phrase, ' ') AS x, label FROM (VALUES {listed}) AS v(id, phrase, label)),
    templates AS (SELECT id, string_split(template, ' ') AS x, label FROM (VALUES {known}) AS v(id, template, label)),
    places AS (
      SELECT row, label, unnest(list_filter(range(1, len(w) - len(x) + 2), lambda i: w[i:i + len(x) - 1] = x)) - 1 AS place
      FROM texts, phrases WHERE len(w) >= len(x)),
    based AS (
      SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
      FROM places GROUP BY row),
    runs AS (SELECT id, label, len(x) AS n, unnest(range(1, len(x) - {size} + 2)) AS q, x FROM templates),
    known AS (SELECT id, label, n, q - 1 AS q, array_to_string(x[q:q + {size} - 1], ' ') AS run FROM runs),
    spots AS (
      SELECT row, unnest(range(1, len(w) - {size} + 2)) AS p,
             unnest(list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' '))) AS run
      FROM texts WHERE len(w) >= {size}),
    votes AS (SELECT row, id, label, n, q, p - 1 AS p, p - 1 - q AS diagonal FROM spots JOIN known USING (run)),
    stepped AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, id ORDER BY diagonal, q) <= {gap} THEN 0 ELSE 1 END AS apart FROM votes),
    banded AS (SELECT *, sum(apart) OVER (PARTITION BY row, id ORDER BY diagonal, q ROWS UNBOUNDED PRECEDING) AS band FROM stepped),
    spaced AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY row, id, band ORDER BY p, q) <= n THEN 0 ELSE 1 END AS far FROM banded),
    parted AS (SELECT *, sum(far) OVER (PARTITION BY row, id, band ORDER BY p, q ROWS UNBOUNDED PRECEDING) AS part FROM spaced),
    spans AS (
      SELECT row, label, n, len(list_distinct(flatten(list(range(q, q + {size}))))) AS covered FROM parted GROUP BY row, id, label, n, band, part),
    found AS (SELECT row, label, CAST(covered AS DOUBLE) / n AS share FROM spans WHERE 100 * covered >= {share} * n UNION ALL SELECT row, label, 1.0 FROM places),
    marked AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY row)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
           coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
    FROM texts LEFT JOIN based USING (row) LEFT JOIN marked USING (row)"""


def ranked_search(top: int = TOP) -> str:
    """Every document that holds a term of an item, with its whole score."""
    found = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH texts AS (SELECT doc_id, row_number() OVER () AS row, {found} AS w FROM documents),
    lengths AS (SELECT row, CAST(len(w) AS BIGINT) AS n FROM texts WHERE len(w) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS size FROM lengths),
    counts AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM texts) AS t GROUP BY row, term),
    df AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
    asked AS (SELECT DISTINCT item_id, text, unnest(list_distinct({found})) AS term FROM benchmark),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, totals),
    scores AS (
      SELECT item_id, text, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // size)))) AS BIGINT) AS score
      FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (row), totals GROUP BY item_id, text, row),
    ranked AS (
      SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, s.text ORDER BY score DESC, doc_id) AS rank
      FROM scores AS s JOIN texts USING (row) WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {top}"""
