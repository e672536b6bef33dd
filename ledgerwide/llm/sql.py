"""SQL twins of the operators that SQL can express over whole tables."""

from __future__ import annotations

from ledgerwide.llm import licences

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def licences_sql() -> str:
    templates = ", ".join(
        f"('{name}', [{', '.join(repr(g) for g in licences.bigrams_of(text))}])"
        for name, text in licences.TEMPLATES.items()
    )
    anchors = ", ".join(
        f"('{name}', {len(licences._in_order(text))}, '{gram}')"
        for name, text in licences.TEMPLATES.items()
        for gram in licences.anchors_of(text, licences.THRESHOLD)
    )
    return f"""
    WITH templates(licence, own) AS (VALUES {templates}),
    anchors(licence, length, gram) AS (VALUES {anchors}),
    docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    segments AS (
        SELECT r, unnest(string_split(text, chr(10))) AS body,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS segment FROM docs
        UNION ALL SELECT r, text, 0 FROM docs WHERE contains(text, chr(10))),
    words AS (
        SELECT r, segment, string_split(trim(regexp_replace(lower(body), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
        FROM segments),
    grams AS (
        SELECT r, segment, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
        FROM words WHERE len(w) > 1),
    scored AS (
        SELECT r, segment, licence, 2.0 * len(list_intersect(g, own)) / (len(g) + len(own)) AS dice
        FROM grams, templates),
    best AS (
        SELECT r, segment, licence, dice FROM scored WHERE dice >= {licences.THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY r, segment ORDER BY dice DESC, licence) = 1),
    found AS (
        SELECT r, count(*) AS n, string_agg(segment || ':' || licence, ',' ORDER BY segment) AS licences, max(dice) AS top
        FROM best GROUP BY r),
    ordered AS (
        SELECT r, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM (
            SELECT r, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM docs)),
    places AS (SELECT r, unnest(g) AS gram, unnest(range(1, len(g) + 1)) AS i FROM ordered),
    laid AS (
        SELECT DISTINCT r, licence, length, unnest(range(i - length + 1, i + 1)) AS start FROM places JOIN anchors USING (gram)),
    compared AS (
        SELECT r, licence, greatest(start, 1) AS word, own, list_distinct(g[greatest(start, 1):start + length - 1]) AS h
        FROM laid JOIN ordered USING (r) JOIN templates USING (licence)),
    close AS (
        SELECT r, licence, word, 2.0 * len(list_intersect(h, own)) / (len(h) + len(own)) AS dice FROM compared
        QUALIFY dice >= {licences.THRESHOLD} AND row_number() OVER (PARTITION BY r, licence ORDER BY dice DESC, word) = 1),
    windows AS (
        SELECT r, count(*) AS wins, string_agg(licence || ':' || word, ',' ORDER BY licence) AS names, max(dice) AS high
        FROM close GROUP BY r)
    SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(licences, '') AS licences,
           round(coalesce(top, 0.0)::DOUBLE, 6) AS best_dice, coalesce(wins, 0) AS n_windows,
           coalesce(names, '') AS window_licences, round(coalesce(high, 0.0)::DOUBLE, 6) AS best_window_dice
    FROM docs LEFT JOIN found USING (r) LEFT JOIN windows USING (r)"""


def near_duplicates_sql(size: int, percent: int) -> str:
    """All pairs that share a shingle are compared; components by reachability."""
    window = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    return f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - {size} + 2), lambda i: {window})) END AS s
        FROM docs),
    sizes AS (SELECT doc_id, len(s) AS n FROM sets),
    grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
        JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= {percent} * (p.n + q.n - count(*))),
    reach AS (
        SELECT doc_id AS x, doc_id AS y FROM docs
        UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
    least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
    SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sizes JOIN least ON x = doc_id"""


WORDS = "list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def interactions_sql() -> str:
    """Every order and step counted by itself; Shapley values as sums over all orders."""
    return f"""
    WITH docs AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS.format(text="coalesce(text, '')")} AS w
        FROM documents),
    failing AS (
        SELECT doc_id, part, (len(w) < 100)::INT
            + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
            + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
            + 8 * regexp_matches(t, '[#$%&*|]')::INT
            + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
        FROM docs),
    known AS (
        SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    counts AS (
        SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
        FROM failing LEFT JOIN known USING (doc_id) GROUP BY part, mask),
    letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders AS (
        SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
          AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
    steps AS (
        SELECT filter_order, step::INT AS step, bits[step] AS bit,
               coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
        FROM orders, range(1, 6) AS r(step)),
    told AS (
        SELECT part, filter_order, step, bit,
               sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM counts, steps GROUP BY part, filter_order, step, bit)
    SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
    FROM told"""


def divergence_sql(least: int) -> str:
    """Every source, language and kept term with its share, in wide whole numbers."""
    share = "1 + 1000000000::HUGEINT * (n + 5) // (total + 5 * terms)"
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
                                  '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
        FROM documents),
    tokens AS (SELECT r, lang, source, unnest(t) AS term FROM docs),
    kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= {least}),
    sizes AS (SELECT lang, count(*) AS terms FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
    every AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, terms,
               sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
        FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    shares AS (SELECT lang, source, term, n, {share} AS p FROM every),
    whole AS (
        SELECT lang, term, {share} AS q FROM (
            SELECT lang, term, sum(n) AS n, any_value(terms) AS terms,
                   sum(sum(n)) OVER (PARTITION BY lang) AS total FROM every GROUP BY lang, term)),
    apart AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    told AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value::BIGINT AS value,
           (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
    FROM told QUALIFY part = 'pair' OR rank <= 50"""


SQL = {
    "op8_licences": licences_sql(),
    "op10_minhash_near_dedup": near_duplicates_sql(3, 85),
    "op11_source_divergence": divergence_sql(30),
    "op13_filter_interactions": interactions_sql(),
}
