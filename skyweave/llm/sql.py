"""SQL that must give the rows of the queries, written independently of the operators."""

from __future__ import annotations

from skyweave.llm import chat

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERED = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_SPACED = "[^\\x20\\x09-\\x0D]+"


def _words(text: str, word: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{word}')"


CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words('text', _LETTERED)} AS w FROM documents),
     b AS (SELECT item_id, {_words('text', _LETTERED)} AS w FROM benchmark),
     windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 8, 2)),
                        lambda i: array_to_string(w[i : i + 9], ' '))) AS x FROM b WHERE len(w) > 0),
     lengths AS (SELECT DISTINCT n FROM windows),
     seen AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
                     unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS x
              FROM d, lengths WHERE len(w) >= n),
     found AS (SELECT doc_id, i, n, item_id FROM seen JOIN windows USING (n, x)),
     hit AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit
             FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
     named AS (SELECT doc_id, count(item)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


def conversations() -> str:
    template = chat.TEMPLATE
    quoted = lambda s: "'" + s.replace("'", "''") + "'"

    def escaped(column: str) -> str:
        for plain, code in template.escapes():
            column = f"replace({column}, {quoted(plain)}, {quoted(code)})"
        return column

    said = quoted("</s>[INST] ok [/INST]")
    block = f"{len(template.open)} + length(replace({escaped('role')}, chr(10), '\\n;')) + 1 + {len(template.close)}"
    return f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', {said}), (-7, 1, 'assistant', {said}))),
     o AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM r)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({escaped('text')})
           + CASE WHEN before = role THEN {len(template.between)} ELSE {block} END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id"""


SIMILAR = f"""
WITH RECURSIVE
     t AS (SELECT min(doc_id) AS id, coalesce(text, '') AS text FROM documents GROUP BY 2),
     w AS (SELECT id, {_words('text', _SPACED)} AS w FROM t),
     s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS x FROM w),
     n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
     shared AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.id <> b.id GROUP BY 1, 2),
     links AS (SELECT a, b FROM shared JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
     reach AS (SELECT id, id AS m FROM n UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.m = l.a),
     least AS (SELECT id, min(m) AS component FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM documents d JOIN t ON coalesce(d.text, '') = t.text LEFT JOIN n USING (id) LEFT JOIN least USING (id)"""


EXACT = """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER t AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))"""


def _tree(name: str, below: str, levels: int) -> str:
    """CTEs of a tree over ``below`` (tree, i, n, d): levels ``name0`` upwards and the siblings of each node."""
    parts = [f"{name}0 AS (SELECT tree, i, n, d FROM {below})"]
    for k in range(levels):
        run = "PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN"
        parts.append(f"""{name}{k}w AS (SELECT tree, i, n > 1 AS step,
            coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
        parts.append(f"""{name}{k + 1} AS (SELECT tree, i // 16 AS i, (any_value(n) + 15) // 16 AS n,
            CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
            FROM {name}{k} GROUP BY tree, i // 16)""")
    return ", ".join(parts)


def _folded(name: str, start: str, levels: int) -> str:
    """CTEs ``name_f…``: (…, tree, i, h, p) carried through the levels of a tree."""
    parts = []
    for k in range(levels):
        before = start if not k else f"{name}_f{k}"
        parts.append(f"""{name}_f{k + 1} AS (SELECT f.* EXCLUDE (i, h, p), f.i // 16 AS i,
            CASE WHEN step THEN sha256(l || h || r) ELSE h END AS h, CASE WHEN step THEN p || l || r ELSE p END AS p
            FROM {before} f JOIN {name}{k}w w ON w.tree = f.tree AND w.i = f.i)""")
    return ", ".join(parts)


def manifest(own: int = 5, top: int = 3) -> str:
    """Trees of ``own`` levels for each source and ``top`` above; more rows than 16 to that power need more."""
    value = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    crc = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
             lambda c, b: xor(c >> 8, list_extract(t, (xor(c, b) & 255) + 1))))"""
    return f"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
                    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
     d AS (SELECT doc_id, source, {leaf('text')} AS leaf,
                  {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS lowered, {crc} % 5 = 0 AS changed FROM documents, crc),
     r AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
     leaves AS (SELECT tree, i, n, leaf AS d FROM r),
     {_tree('s', 'leaves', own)},
     subroots AS (SELECT 0 AS tree, tree AS i, count(*) OVER () AS n, d FROM s{own}),
     {_tree('t', 'subroots', top)},
     started AS (SELECT doc_id, leaf, tree AS source_no, tree, i, CASE WHEN changed THEN lowered ELSE leaf END AS h, '' AS p FROM r),
     {_folded('s', 'started', own)},
     crowned AS (SELECT f.* EXCLUDE (tree, i), 0 AS tree, source_no AS i FROM s_f{own} f),
     {_folded('t', 'crowned', top)}
SELECT doc_id, leaf, u.d AS subroot, (SELECT d FROM t{top}) AS root, sha256(p) AS proof_sha256, h AS folded_root,
       h = (SELECT d FROM t{top}) AS verified
FROM t_f{top} f JOIN subroots u ON u.i = f.source_no"""
