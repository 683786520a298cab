"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_INK = r"[^\x20\x09-\x0D]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _base32(hex: str) -> str:
    """40 hexadecimal digits as 32 letters: 20 bits at a time."""
    letters = [
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr({hex}, {5 * k + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER), 1)"
        for k in range(8) for shift in (15, 10, 5, 0)
    ]
    return " || ".join(letters)


ORACLES: dict[str, str] = {
    "op3_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM p)
    SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {_base32('x')} AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to FROM f""",
    "op4_near_duplicates": f"""WITH RECURSIVE d AS (SELECT doc_id, {_words('text', _INK)} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] ELSE w END) AS s FROM d),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (s) GROUP BY ALL),
    links AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    m AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)""",
    "op6_decontamination": f"""WITH d AS (SELECT doc_id, {_words('text', _WORD)} AS w FROM documents),
    b AS (SELECT item_id, {_words('text', _WORD)} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
                FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    places AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k
               FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
    found AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, k)),
    hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_ranked_search": f"""WITH d AS (SELECT doc_id, {_words('text', _WORD)} AS w FROM documents),
    q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_words('text', _WORD)}) AS t FROM benchmark) GROUP BY ALL),
    n AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
    tf AS (SELECT doc_id, t, count(*) AS tf, any_value(len) AS len FROM (SELECT doc_id, len(w) AS len, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
    weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, n GROUP BY t, docs),
    scores AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len * docs) // terms)))) AS BIGINT) AS score
               FROM tf JOIN weights USING (t) JOIN q USING (t), n GROUP BY item_id, doc_id),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
