"""SQL for the operators that it can express, for DuckDB over the same tables."""

from __future__ import annotations

# crc32 of a text's UTF-8 bytes: a table of 256 remainders, then a byte at a time.
CRC32 = """
    remainders AS MATERIALIZED (
        SELECT list_transform(range(256), lambda n: list_reduce(
            list_prepend(n, range(8)),
            lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                                ELSE c >> 1 END)) AS t)"""


def crc32(text: str) -> str:
    """Of an SQL expression, where `remainders` is in FROM."""
    byte = f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 2) AS BIGINT)"
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(
            range(octet_length(encode({text}))), lambda i: {byte})),
        lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INT)])))"""


def spelling_variants() -> str:
    """Near words by leaving out a letter: of both at one place, or of the longer one."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        WITH RECURSIVE {CRC32},
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, '{upper}', '{upper.lower()}'), '[a-zÀ-ÿ]+')) AS run
            FROM documents),
        counted AS (
            SELECT doc_id, run, count(*) AS n FROM runs
            WHERE length(run) >= 6 GROUP BY ALL),
        hashed AS (
            SELECT run, n, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
            FROM counted, remainders),
        words AS MATERIALIZED (
            SELECT CASE WHEN h % 199 = 0
                        THEN substr(run, 1, CAST(h % length(run) AS INT))
                             || substr(run, CAST(h % length(run) + 2 AS INT))
                        ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(hashed.n) >= 5),
        short AS MATERIALIZED (
            SELECT word, i, substr(word, 1, CAST(i AS INT))
                            || substr(word, CAST(i + 2 AS INT)) AS rest
            FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
        longer AS (
            SELECT DISTINCT s.word AS a, w.word AS b FROM short s JOIN words w ON w.word = s.rest),
        near AS (
            SELECT a, b FROM longer UNION ALL SELECT b, a FROM longer UNION ALL
            SELECT DISTINCT x.word, y.word FROM short x JOIN short y
            ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
        best AS (
            SELECT a AS word, count(*) AS n_near,
                   list_min(list({{'minus': -n, 'word': b}})) AS top
            FROM near JOIN words ON words.word = b GROUP BY a),
        judged AS MATERIALIZED (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -top.minus >= 5 * w.n THEN top.word END AS form,
                   CASE WHEN -top.minus >= 5 * w.n THEN -top.minus END AS form_n
            FROM words w LEFT JOIN best ON w.word = best.word),
        followed AS (
            SELECT word, word AS reached FROM judged UNION ALL
            SELECT f.word, j.form FROM followed f JOIN judged j ON j.word = f.reached
            WHERE j.form IS NOT NULL)
        SELECT j.word, j.form, f.reached AS root, j.n, j.n_near, j.form_n
        FROM judged j JOIN followed f ON f.word = j.word
        JOIN judged r ON r.word = f.reached AND r.form IS NULL"""


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _choice(cost: str, letter: str, ahead: str) -> str:
    return f"{{'c': {cost} + {ahead}.c, 'a': '{letter}' || {ahead}.a}}"


def conversation_repair() -> str:
    """Cheapest edits from the last row to the first, all four grammar states in a row."""
    truncated = "CAST(fault = 'truncated' AS INT)"
    keep = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    nothing = "{'c': CAST(1000000000 AS BIGINT), 'a': ''}"
    plain = []
    for q in range(4):
        reroled = 3 if q == 2 else 2
        kept = "".join(f"WHEN '{r}' THEN {_choice(truncated, 'K', f'v{to}')} " for r, to in keep[q].items())
        plain.append(
            _least(
                _choice("3", "D", f"v{q}"),
                f"CASE WHEN fault IN ('blank', 'duplicate') THEN {nothing} "
                f"ELSE {_choice(f'2 + {truncated}', 'R', f'v{reroled}')} END",
                f"CASE WHEN fault IN ('blank', 'duplicate') THEN {nothing} "
                f"ELSE CASE initial {kept} ELSE {nothing} END END",
            )
            + f" AS w{q}"
        )
    text = "coalesce(CAST({} AS VARCHAR), ' ')"
    key = f"{text.format('conv_id')} || ':' || {text.format('turn')}"
    end = "CAST({c} AS BIGINT)"
    start = ", ".join(
        f"{{'c': {end.format(c=c)}, 'a': '{a}'}} AS v{q}"
        for q, (c, a) in enumerate([(0, ""), (4, "II"), (2, "I"), (0, "")])
    )
    return f"""
        WITH RECURSIVE {CRC32},
        kinds AS (
            SELECT conv_id, turn, {text.format("role")} AS role,
                   {text.format("text")} AS text, {crc32(key)} % 20 AS kind
            FROM conversations, remainders),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                        ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM kinds),
        ordered AS (
            SELECT *, row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS nth,
                   left(role, 1) AS initial,
                   regexp_extract(text,
                       '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS solid
            FROM damaged),
        turns AS MATERIALIZED (
            SELECT *, CASE WHEN solid = '' THEN 'blank'
                           WHEN row_number() OVER (
                               PARTITION BY conv_id, role, text ORDER BY nth) > 1 THEN 'duplicate'
                           WHEN solid NOT IN ('.', '!', '?') THEN 'truncated'
                           ELSE '' END AS fault,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY nth) || initial AS pair
            FROM ordered),
        counted AS MATERIALIZED (
            SELECT conv_id, count(*) AS n,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM turns GROUP BY conv_id),
        solved AS (
            SELECT conv_id, n AS ahead, {start} FROM counted
            UNION ALL
            SELECT conv_id, ahead - 1,
                   {_least("w0", _choice("2", "I", _least("w2", _choice("2", "I", "w3"))))},
                   {_least("w1", _choice("2", "I", _least("w2", _choice("2", "I", "w3"))))},
                   {_least("w2", _choice("2", "I", "w3"))},
                   {_least("w3", _choice("2", "I", "w2"))}
            FROM (SELECT s.conv_id, ahead, {", ".join(plain)}
                  FROM solved s JOIN turns t
                  ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.nth = s.ahead)),
        audits AS MATERIALIZED (
            SELECT conv_id, v0.c AS cost, v0.a AS audit FROM solved WHERE ahead = 0),
        letters AS (
            SELECT conv_id, i, audit[CAST(i AS INT)] AS letter
            FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM audits)),
        places AS (
            SELECT *, count(*) FILTER (letter <> 'I') OVER w AS nth,
                   count(*) FILTER (letter <> 'D') OVER w AS place
            FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
        made AS (
            SELECT p.conv_id, p.letter, p.place, t.role, t.text,
                   bool_or(p.place = 1 AND p.letter = 'K' AND t.initial = 's')
                       OVER (PARTITION BY p.conv_id) AS led
            FROM places p LEFT JOIN turns t
            ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.nth = t.nth AND p.letter <> 'I'
            WHERE p.letter <> 'D'),
        digests AS (
            SELECT conv_id, sha256(string_agg(
                CASE WHEN letter = 'K' THEN role
                     WHEN (place - CAST(coalesce(led, false) AS INT)) % 2 = 1 THEN 'user'
                     ELSE 'assistant' END || ':' || coalesce(text, ''),
                chr(10) ORDER BY place)) AS digest
            FROM made GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN audits a ON o.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN digests d ON o.conv_id IS NOT DISTINCT FROM d.conv_id"""


def suffix_dedup() -> str:
    """All windows of 400 bytes by their digest; runs of those that start twice."""
    return """
        WITH bytes AS MATERIALIZED (
            SELECT doc_id, row_number() OVER () AS row, encode(coalesce(text, '')) AS raw,
                   octet_length(encode(coalesce(text, ''))) AS n_bytes
            FROM documents),
        windows AS MATERIALIZED (
            SELECT row, i, md5_number(raw[i + 1 : i + 400]) AS seen
            FROM (SELECT row, raw, unnest(range(n_bytes - 399)) AS i FROM bytes WHERE n_bytes >= 400)),
        repeated AS (
            SELECT seen FROM windows GROUP BY seen HAVING count(*) > 1),
        starts AS (
            SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS before
            FROM windows SEMI JOIN repeated USING (seen)),
        runs AS (
            SELECT row, i, sum(CAST(before IS NULL OR i > before + 400 AS INT))
                               OVER (PARTITION BY row ORDER BY i) AS run
            FROM starts),
        spans AS (
            SELECT row, run, min(i) AS a, max(i) + 400 AS b FROM runs GROUP BY row, run),
        gaps AS (
            SELECT row, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS a, a AS b FROM spans
            UNION ALL
            SELECT b.row, coalesce(max(s.b), 0), b.n_bytes
            FROM bytes b LEFT JOIN spans s ON s.row = b.row GROUP BY b.row, b.n_bytes),
        kept AS (
            SELECT g.row, coalesce(string_agg(hex(raw[g.a + 1 : g.b]), '' ORDER BY g.a), '') AS hexed
            FROM gaps g JOIN bytes USING (row) GROUP BY g.row)
        SELECT doc_id, n_bytes, n_bytes - length(k.hexed) // 2 AS n_removed,
               (SELECT count(*) FROM spans s WHERE s.row = b.row) AS n_spans,
               sha256(unhex(k.hexed)) AS kept_sha256
        FROM bytes b JOIN kept k ON k.row = b.row"""
