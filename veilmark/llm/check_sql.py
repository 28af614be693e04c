"""ANSI SQL (DuckDB dialect) for the operators that SQL can express."""

from __future__ import annotations

from itertools import permutations

from veilmark.llm.license_scan import (
    GRAM,
    LOWER,
    MOST_SHIFT,
    NOTICES,
    PHRASES,
    SHIFT_SHARE,
    UPPER,
    VERIFIED,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


def _phrase(phrase: str, label: str) -> str:
    parts = phrase.split()
    test = " AND ".join(f"ws[i + {j}] = '{p}'" for j, p in enumerate(parts))
    return (
        f"SELECT rid, i - 1 AS place, '{label}' AS label "
        f"FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) p WHERE {test}"
    )


def _licenses() -> str:
    """Every gram of every document; places are counted one by one."""
    notices = ", ".join(
        f"('{label}', {i}, {_quoted(text)})"
        for label, texts in NOTICES.items()
        for i, text in enumerate(texts)
    )
    phrases = " UNION ALL ".join(_phrase(p, label) for p, label in PHRASES.items())
    grams = f"unnest(range(1, len(ws) - {GRAM - 2})) AS i"
    gram = f"array_to_string(ws[i:i + {GRAM - 1}], ' ') AS g"
    shift = f"least(greatest(len // {SHIFT_SHARE}, 1), {MOST_SHIFT})"
    span = "rid, label, nth, len"
    return (
        f"WITH w AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text')} AS ws "
        f"FROM documents), "
        f"t AS (SELECT label, nth, {_words('notice')} AS ws "
        f"FROM (VALUES {notices}) n(label, nth, notice)), "
        f"tg AS (SELECT label, nth, len(ws) AS len, i AS t_pos, {gram} "
        f"FROM (SELECT *, {grams} FROM t) x), "
        f"dg AS (SELECT rid, i AS pos, {gram} FROM (SELECT *, {grams} FROM w) x), "
        f"hits AS (SELECT {span}, pos, t_pos, pos - t_pos AS d FROM dg JOIN tg USING (g)), "
        f"islands AS (SELECT {span}, d, sum(CASE WHEN d - before > {shift} THEN 1 ELSE 0 END) "
        f"OVER (PARTITION BY {span} ORDER BY d) AS island FROM (SELECT *, lag(d) OVER "
        f"(PARTITION BY {span} ORDER BY d) AS before FROM "
        f"(SELECT DISTINCT {span}, d FROM hits) a) b), "
        f"placed AS (SELECT {span}, island, pos, unnest(range(t_pos, t_pos + {GRAM})) AS word "
        f"FROM hits JOIN islands USING ({span}, d)), "
        f"scored AS (SELECT {span}, count(DISTINCT word) / CAST(greatest(len, "
        f"max(pos) + {GRAM - 1} - min(pos) + 1) AS DOUBLE) AS score "
        f"FROM placed GROUP BY {span}, island), "
        f"named AS ({phrases}), "
        f"labels AS (SELECT DISTINCT rid, label FROM named UNION "
        f"SELECT DISTINCT rid, label FROM scored WHERE score >= {VERIFIED}) "
        f"SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, "
        f"(SELECT count(*) FROM named n WHERE n.rid = w.rid) AS n_base, "
        f"(SELECT min(place) FROM named n WHERE n.rid = w.rid) AS first_word, "
        f"(SELECT max(place) FROM named n WHERE n.rid = w.rid) AS last_word, "
        f"coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM named n "
        f"WHERE n.rid = w.rid), '') AS base_labels, "
        f"coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM labels l "
        f"WHERE l.rid = w.rid), '') AS labels, "
        f"coalesce((SELECT max(score) FROM scored s WHERE s.rid = w.rid), 0.0::DOUBLE) AS score "
        f"FROM w"
    )


def _audit() -> str:
    orders = ", ".join(f"'{''.join(p)}'" for p in permutations("ABCDE"))
    words = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    failing = (
        "CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END "
        "|| CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END "
        "|| CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) "
        "THEN 'C' ELSE '' END "
        "|| CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END "
        "|| CASE WHEN doc_id > least_id THEN 'E' ELSE '' END"
    )
    here = "contains(fails, letter) AND translate(fails, earlier, '') = fails"
    passed = "translate(fails, earlier || letter, '') = fails"
    too_late = "contains(fails, letter) AND translate(fails, earlier, '') <> fails"

    def total(value: str, condition: str) -> str:
        return f"CAST(coalesce(sum({value}) FILTER (WHERE {condition}), 0) AS BIGINT)"

    return (
        f"WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, "
        f"min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least_id FROM documents), "
        f"w AS (SELECT *, {words} AS ws FROM d), "
        f"l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, "
        f"max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id), "
        f"f AS (SELECT part, {failing} AS fails, count(*) AS n, sum(coalesce(good, 0)) AS good, "
        f"sum(coalesce(bad, 0)) AS bad FROM w LEFT JOIN l USING (doc_id) GROUP BY part, fails), "
        f"o AS (SELECT unnest([{orders}]) AS filter_order), "
        f"s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, "
        f"substr(filter_order, 1, step - 1) AS earlier "
        f"FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o) x), "
        f"r AS (SELECT part, filter_order, step, letter, "
        f"{total('n', passed)} AS kept, "
        f"{total('n', here)} AS removed, "
        f"{total('n', too_late)} AS redundant, "
        f"{total('n', 'fails = letter')} AS unique_fails, "
        f"{total('good', here)} AS good_lost, {total('bad', here)} AS toxic_lost "
        f"FROM f, s GROUP BY part, filter_order, step, letter) "
        f"SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, "
        f"toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley "
        f"FROM r"
    )


def _hash_levels(name: str, leaves: str, group: str) -> str:
    """All nodes of the trees over the groups of ``leaves``, two children a node."""
    return (
        f"{name}(level, {group}, pos, n, h) AS (SELECT 0, {group}, pos, n, h FROM {leaves} "
        f"UNION ALL SELECT level + 1, {group}, pos // 2, (n + 1) // 2, sha256(h || "
        f"coalesce(other, '')) FROM (SELECT *, lead(h) OVER (PARTITION BY {group} ORDER BY pos) "
        f"AS other FROM {name}) u WHERE n > 1 AND pos % 2 = 0)"
    )


def _encoded(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _manifest() -> str:
    """Climbing with recursion, then folding each row along the nodes of its way up."""
    leaf = " || ".join(_encoded(f) for f in ("doc_id", "source", "lang", "n_chars", "text"))
    other = leaf.replace("n_chars", "n_chars + 1")
    # The checksum, byte by byte: -1 stands for a shift by one bit.
    byte = f"[ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1)){', -1' * 8}]"
    bits = f"flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: {byte}))"
    crc = (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bits}::BIGINT[]), "
        f"lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 "
        f"THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    )
    siblings = (
        "SELECT b.rid, {base} + u.level AS level, CASE WHEN u.pos < b.pos >> u.level THEN u.h END "
        "AS l, CASE WHEN u.pos > b.pos >> u.level THEN u.h END AS r FROM {rows} b JOIN {nodes} u "
        "ON {on} AND xor(u.pos, 1) = b.pos >> u.level"
    )
    own = siblings.format(
        base=0, rows="ranked", nodes="up", on="u.lang IS NOT DISTINCT FROM b.lang"
    )
    above = siblings.format(base=1000, rows="in_subroots", nodes="top", on="u.part = b.part")
    return (
        f"WITH RECURSIVE base AS (SELECT row_number() OVER () AS rid, doc_id, lang, "
        f"sha256({leaf}) AS h, CASE WHEN {crc} % 7 = 0 THEN sha256({other}) ELSE sha256({leaf}) "
        f"END AS other FROM documents), "
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h"
        f", rid) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM base), "
        f"{_hash_levels('up', 'ranked', 'lang')}, "
        f"subroots AS (SELECT 0 AS part, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) "
        f"- 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1), "
        f"{_hash_levels('top', 'subroots', 'part')}, "
        f"root AS (SELECT h AS root FROM top WHERE n = 1), "
        f"in_subroots AS (SELECT rid, part, s.pos, s.h AS subroot, "
        f"CAST(ceil(log2(r.n)) AS INT) AS own_levels, CAST(ceil(log2(s.n)) AS INT) AS top_levels "
        f"FROM ranked r JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.lang), "
        f"siblings AS ({own} UNION ALL {above}), "
        f"steps AS (SELECT rid, unnest(list_concat(range(0, own_levels), "
        f"range(1000, 1000 + top_levels))) AS level FROM in_subroots), "
        f"path AS (SELECT s.rid, row_number() OVER (PARTITION BY s.rid ORDER BY s.level) AS step, "
        f"coalesce(l, '') AS l, coalesce(r, '') AS r "
        f"FROM steps s LEFT JOIN siblings b ON b.rid = s.rid AND b.level = s.level), "
        f"folded(rid, step, node) AS (SELECT rid, 0::BIGINT, other FROM base UNION ALL "
        f"SELECT f.rid, f.step + 1, sha256(l || node || r) FROM folded f JOIN path p "
        f"ON p.rid = f.rid AND p.step = f.step + 1), "
        f"proofs AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY step)) AS proof "
        f"FROM path GROUP BY rid) "
        f"SELECT b.doc_id, b.h AS leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, "
        f"node AS folded_root, node = root AS verified "
        f"FROM base b JOIN in_subroots USING (rid) LEFT JOIN proofs USING (rid) "
        f"JOIN (SELECT rid, arg_max(node, step) AS node FROM folded GROUP BY rid) e USING (rid), root"
    )


def checks() -> dict[str, str]:
    """Query name to check SQL."""
    return {
        "op11_license_scan": _licenses(),
        "op12_filter_audit": _audit(),
        "op13_merkle_manifest": _manifest(),
    }
