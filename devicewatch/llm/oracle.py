"""The results of the registered queries as SQL, where SQL can express them."""

_CONTROLS = ("### ", "</turn>", "<image>", "<audio>", "<document>", "<file>")


def _escaped(text: str, controls: tuple[str, ...] = _CONTROLS) -> str:
    text = rf"replace({text}, '\', '\\')"
    for c in controls:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


#: Unsigned CRC-32 of a list of bytes, with the table of the bytes' remainders in ``crc.t``.
_CRC_TABLE = """
        crc AS (SELECT list(list_reduce([i::BIGINT] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
                    ORDER BY i) AS t FROM range(256) r(i))"""


def _crc32(text: str) -> str:
    """Of texts of code points below 2048."""
    encoded = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 "
               "THEN [ord(c)::BIGINT] ELSE [192 | (ord(c) >> 6), 128 | (ord(c) & 63)]::BIGINT[] "
               "END))")
    return (f"xor(list_reduce([4294967295::BIGINT] || {encoded}, "
            "lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1])), 4294967295)")


ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_chat_format": rf"""
        WITH added AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END,
                             '\### Assistant: </turn> ok' FROM range(2) r(i)),
        turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                  FROM added),
        joined AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), ''
                              ORDER BY turn NULLS FIRST, role, text) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text)
                            FILTER (role = 'assistant'), '') AS trained,
                   sum(length({_escaped("role", (*_CONTROLS, ": "))}) + length({_escaped("text")})
                       + {len("### ") + len(": ") + len("</turn>") + 1})::BIGINT AS formatted_chars
            FROM turns GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(trained) AS loss_chars,
               sha256(trained) AS loss_sha256, formatted_chars FROM joined""",
    "op11_prefix_trie": f"""
        WITH {_CRC_TABLE.strip()},
        turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 6 AS h
                  FROM (SELECT DISTINCT conv_id FROM turns), crc),
        rebuilt AS (
            SELECT c.conv_id, 0 AS part, place, role, text FROM convs c
            JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place < h
            UNION ALL
            SELECT c.conv_id, 1, place, role, text FROM convs c
            JOIN turns t ON t.conv_id = c.conv_id AND place >= h),
        steps AS (
            SELECT conv_id, row_number() OVER said AS depth, length(text) AS size,
                   string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
                       OVER said AS said
            FROM rebuilt WINDOW said AS (PARTITION BY conv_id ORDER BY part, place)),
        paths AS (SELECT conv_id, depth, md5(said) AS key, size FROM steps
                  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
        lengths AS (SELECT conv_id, max(depth) AS turns FROM paths GROUP BY conv_id),
        nodes AS (
            SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * max(size) AS saved,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                                   FILTER (depth = turns), '')) AS ends_sha256
            FROM paths JOIN lengths USING (conv_id) GROUP BY depth, key),
        parents AS (
            SELECT n.depth, n.key, p.conv_id AS parent_conv_id, p.key AS parent_key
            FROM nodes n JOIN paths s ON s.conv_id = n.conv_id AND s.depth = n.depth - 1
            JOIN nodes p ON p.depth = s.depth AND p.key = s.key),
        children AS (SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n
                     FROM parents GROUP BY ALL),
        subtrees AS (
            SELECT a.depth, a.key, sum(m.saved) AS saved,
                   count(*) FILTER (c.n IS NULL) AS leaves
            FROM nodes m LEFT JOIN children c USING (depth, key)
            JOIN paths a ON a.conv_id = m.conv_id AND a.depth <= m.depth GROUP BY a.depth, a.key)
        SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs,
               coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
               s.saved::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n LEFT JOIN parents p USING (depth, key) LEFT JOIN children c USING (depth, key)
        JOIN subtrees s USING (depth, key)""",
    "op12_substring_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        places AS (SELECT r, doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs),
        windows AS (
            SELECT r, doc_id, i, words[i] AS word, CASE WHEN i + 49 <= len(words) THEN
                   sha256(array_to_string(words[i:i + 49], ' ')) END AS said FROM places),
        repeats AS (
            SELECT r, i, word, said IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY said)
                AS again FROM windows),
        covered AS (
            SELECT r, i, word, bool_or(again) OVER (PARTITION BY r ORDER BY i
                ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM repeats),
        kept AS (
            SELECT r, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM covered GROUP BY r)
        SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (r)""",
    "op13_spelling_variants": f"""
        WITH RECURSIVE {_CRC_TABLE.strip()},
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
        hashed AS (
            SELECT run, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
            FROM runs, crc WHERE length(run) >= 7),
        varied AS (
            SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run))
                || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
        words AS (SELECT word, count(*) AS n FROM varied WHERE length(word) >= 7
                  GROUP BY word HAVING count(*) >= 2),
        cut AS (
            SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS less
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (
            SELECT a.word, b.word AS near FROM cut a JOIN cut b USING (i, less)
            WHERE a.word <> b.word
            UNION SELECT word, less FROM cut WHERE less IN (SELECT word FROM words)
            UNION SELECT less, word FROM cut WHERE less IN (SELECT word FROM words)),
        nearest AS (
            SELECT p.word, count(*) AS n_near, max(w.n) AS best,
                   arg_min(p.near, (-w.n, p.near)) AS near
            FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
        forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN best >= 10 * w.n THEN near END AS form,
                   CASE WHEN best >= 10 * w.n THEN best END AS form_n
            FROM words w LEFT JOIN nearest USING (word)),
        chains AS (
            SELECT word, word AS root, form AS next FROM forms
            UNION ALL
            SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.next)
        SELECT word, n, n_near, form, root, form_n
        FROM forms JOIN (SELECT word, root FROM chains WHERE next IS NULL) USING (word)""",
}
