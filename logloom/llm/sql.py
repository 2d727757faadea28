"""DuckDB SQL for the operators that it can express, on whole tables."""

from __future__ import annotations

import re

from logloom.llm import decontamination, fill_in_middle, license_scan, line_dedup, near_dup, phrase_dedup, source_divergence

#: ``[^\x20\x09-\x0D]+`` as a list of words; a null text has none.
_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
#: A-Z alone is lower-cased: ``lower`` would change other letters too.
_FOLDED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_duplicates() -> str:
    words = _WORDS.format(text=_FOLDED.format(text="text"))
    n = near_dup.SHINGLE_WORDS
    return f"""
    WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
    s AS (SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {n} THEN [array_to_string(words, ' ')]
            ELSE list_distinct(list_transform(range(1, len(words) - {n} + 2), lambda i: array_to_string(words[i:i + {n - 1}], ' '))) END AS shingles FROM w),
    e AS (SELECT r, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
    rare AS (SELECT shingle FROM e GROUP BY shingle HAVING count(*) > 1),
    f AS (SELECT e.* FROM e JOIN rare USING (shingle)),
    links AS (SELECT a.r AS a, b.r AS b FROM f a JOIN f b ON a.shingle = b.shingle AND a.r <> b.r
              GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {near_dup.SIMILARITY_PERCENT} * (a.n + b.n - count(*))),
    reach(start, r) AS (SELECT r, r FROM s UNION SELECT reach.start, links.b FROM reach JOIN links ON links.a = reach.r),
    least AS (SELECT reach.start AS r, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = reach.r GROUP BY reach.start)
    SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, component_id, s.doc_id IS NOT DISTINCT FROM component_id AS kept FROM s JOIN least USING (r)"""


def line_dedup_sql() -> str:
    trimmed = r"regexp_replace({line}, '^[ \t-\r]+|[ \t-\r]+\z', '', 'g')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, string_split(text, chr(10)) AS lines FROM documents),
    totals AS (SELECT host, count(*) AS host_pages FROM d GROUP BY host),
    l AS (SELECT r, host, unnest(list_distinct(list_transform(lines, lambda x: {trimmed.format(line='x')}))) AS line FROM d),
    b AS (SELECT l.host, line FROM l JOIN totals ON l.host IS NOT DISTINCT FROM totals.host WHERE line <> ''
          GROUP BY l.host, line, host_pages HAVING count(*) >= {line_dedup.LEAST_PAGES} AND count(*) > {line_dedup.RATIO}::DOUBLE * host_pages),
    k AS (SELECT host, list(line) AS boilerplate FROM b GROUP BY host),
    c AS (SELECT doc_id, lines, list_filter(lines, lambda x: boilerplate IS NULL OR NOT list_contains(boilerplate, {trimmed.format(line='x')})) AS kept
          FROM d LEFT JOIN k ON d.host IS NOT DISTINCT FROM k.host)
    SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_removed, array_to_string(kept, chr(10)) AS text FROM c"""


def license_scan_sql() -> str:
    """Boundaries as in ``license_scan``: what there looks ahead or back is taken in here and written again, or marked before.

    ``N`` marks line feeds before an address, of which a blank line does not end a sentence. All ``E`` and ``L`` are doubled, so
    that sentences next to each other have one each.
    """
    names = ", ".join(f"'{license_scan.plain(text)}': '{name}'" for name, text in license_scan.SENTENCES.items())
    hint = license_scan.hint(license_scan.SENTENCES)
    marker = "(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})"
    space = r"[ \t-\r]"
    texts = sorted(set(license_scan.SENTENCES.values()), key=lambda text: (-len(license_scan.plain(text)), text))
    known = "|".join(_sentence(text) for text in texts)
    rules = ", ".join(
        f"{{'written': '{''.join(f'|{i}|' for i in ids)}', 'found': ['{licence}']}}" for licence, ids in sorted(license_scan.RULES, key=lambda rule: -len(rule[1]))
    )
    return rf"""
    WITH t AS (SELECT doc_id, regexp_matches(coalesce(text, ''), '{hint}') AS hinted, lower(coalesce(text, '')) AS t FROM documents),
    m AS (SELECT doc_id, hinted, regexp_replace(regexp_replace(t, '(?m)^([^a-z0-9\n]*{marker})\)({space})', '\1. \2', 'g'),
            '([:.!?;])({space}+[^a-z0-9\n]{{0,3}}{marker})[.)]({space})', '\1 L \2. \3', 'g') AS t FROM t),
    a AS (SELECT doc_id, hinted, regexp_replace(regexp_replace(t, '[.!?;]({space}|\z)', ' E \1', 'g'), '([^a-z0-9]{{0,81}})(https?://)', 'H\1I\2', 'g') AS t FROM m),
    u AS (SELECT doc_id, hinted, array_to_string(list_transform(string_split(t, 'H'), lambda s: CASE WHEN contains(s, 'I')
            THEN replace(split_part(s, 'I', 1), chr(10), 'N') || substr(s, strpos(s, 'I') + 1) ELSE s END), '') AS t FROM a),
    b AS (SELECT doc_id, hinted, 'E ' || trim(regexp_replace(regexp_replace(regexp_replace(t, '[\nN][^a-z0-9EN\n]*\n', ' E ', 'g'), '[\nN]', ' L ', 'g'), '[^a-z0-9EL]+', ' ', 'g')) || ' E' AS t FROM u),
    p AS (SELECT doc_id, CASE WHEN hinted THEN string_split(regexp_replace(regexp_replace(t, '([EL])', '\1 \1', 'g'),
            '([EL]) ({known}) ([EL])', '\1' || chr(10) || '\2' || chr(10) || '\3', 'g'), chr(10)) ELSE [] END AS parts FROM b),
    i AS (SELECT doc_id, list_filter(list_transform(parts, lambda s, k: CASE WHEN k % 2 = 0 THEN map {{{names}}}[regexp_replace(s, '[EL] ', '', 'g')]
            WHEN regexp_full_match(s, '[EL ]*({marker} E[EL ]*)?') THEN '' ELSE '~' END), lambda s: s <> '') AS ids FROM p),
    w AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda i: CASE WHEN i = '~' THEN i ELSE '|' || i || '|' END), '') AS written FROM i),
    r AS (SELECT doc_id, ids, list_reduce(list_prepend({{'written': written, 'found': []::VARCHAR[]}}, [{rules}]), lambda s, rule: CASE WHEN contains(s.written, rule.written)
            THEN {{'written': replace(s.written, rule.written, '~'), 'found': list_concat(s.found, rule.found)}} ELSE s END).found AS licences FROM w)
    SELECT doc_id, array_to_string(list_filter(ids, lambda i: i <> '~'), ',') AS sentence_ids,
           array_to_string(list_sort(list_distinct(licences)), ',') AS licences
    FROM r"""


def _sentence(text: str) -> str:
    """A known sentence: line feeds may be between its words, ends too where it has its own."""
    parts = [license_scan.plain(part).replace(" ", " (?:L )*") for part in re.split(r"[.!?;](?=\s)", text)]
    return " (?:[EL] )*".join(part for part in parts if part)


def phrase_dedup_sql() -> str:
    n = phrase_dedup.WINDOW
    return f"""
    WITH w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text='text')} AS words FROM documents),
    s AS (SELECT r, unnest(range(1, len(words) - {n} + 2)) AS i, words FROM w WHERE len(words) >= {n}),
    h AS (SELECT r, i, array_to_string(words[i:i + {n - 1}], ' ') AS gram FROM s),
    again AS (SELECT gram FROM h GROUP BY gram HAVING count(*) > 1),
    covered AS (SELECT DISTINCT r, unnest(range(i, i + {n})) AS k FROM h JOIN again USING (gram)),
    gone AS (SELECT r, list(k) AS ks FROM covered GROUP BY r),
    kept AS (SELECT doc_id, words, coalesce(ks, []) AS ks, list_filter(words, lambda x, k: NOT list_contains(coalesce(ks, []), k)) AS left_words FROM w LEFT JOIN gone USING (r))
    SELECT doc_id, len(words)::BIGINT AS n_words, len(ks)::BIGINT AS n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept"""


def decontamination_sql() -> str:
    n = decontamination.WINDOW
    words = r"regexp_extract_all(coalesce({text}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(text=_FOLDED.format(text="text"))
    return f"""
    WITH b AS (SELECT item_id, words, least({n}, len(words)) AS size FROM (SELECT item_id, {words} AS words FROM benchmark) WHERE len(words) > 0),
    g AS (SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM b)),
    sizes AS (SELECT DISTINCT size FROM g),
    d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
    x AS (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size),
    h AS (SELECT r, x.i, x.size, item_id FROM x JOIN g ON g.size = x.size AND g.gram = array_to_string(words[i:i + x.size - 1], ' ')),
    hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS k FROM h) GROUP BY r),
    items AS (SELECT r, list_sort(list_distinct(list(item_id::VARCHAR))) AS ids FROM h GROUP BY r),
    t AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(ids, []) AS ids FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r))
    SELECT doc_id, n_words, n_hit, len(ids)::BIGINT AS n_items, sha256(array_to_string(ids, ',')) AS items_sha256, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM t"""


def fill_in_middle_sql() -> str:
    m = fill_in_middle
    p, s, mid = m.PREFIX, m.SUFFIX, m.MIDDLE
    h = [f"('0x' || substr(digest, {1 + 8 * i}, 8))::BIGINT" for i in range(4)]

    def cut(first: str, last: str) -> str:
        """What lies between two marks of the output."""
        end = f"strpos(output, '{last}')" if last else "length(output) + 1"
        return f"substr(output, strpos(output, '{first}') + {len(first)}, {end} - strpos(output, '{first}') - {len(first)})"

    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{m.SALT}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
    l AS (SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS lines, {h[0]} AS h1, {h[1]} AS h2, {h[2]} AS h3, {h[3]} AS h4 FROM d),
    c AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
          CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{mid}') OR h3 % 100 >= {m.PERCENT} THEN '{m.PLAIN}'
               WHEN h4 % 100 < {m.SPM_PERCENT} THEN '{m.SPM}' ELSE '{m.PSM}' END AS form FROM l),
    x AS (SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:n], '') AS suffix FROM c),
    o AS (SELECT *, CASE form WHEN '{m.PSM}' THEN '{p}' || prefix || '{s}' || suffix || '{mid}' || middle
                              WHEN '{m.SPM}' THEN '{s}' || suffix || '{p}' || prefix || '{mid}' || middle ELSE text END AS output FROM x)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> '{m.PLAIN}' THEN length(prefix)::BIGINT END AS prefix_chars,
           CASE WHEN form <> '{m.PLAIN}' THEN length(middle)::BIGINT END AS middle_chars, sha256(output) AS output_sha256,
           sha256(CASE form WHEN '{m.PSM}' THEN {cut(p, s)} || {cut(mid, '')} || {cut(s, mid)}
                            WHEN '{m.SPM}' THEN {cut(p, mid)} || {cut(mid, '')} || {cut(s, p)} ELSE output END) AS restored_sha256 FROM o"""


def source_divergence_sql() -> str:
    m = source_divergence
    share = f"1 + {m.SCALE}::HUGEINT * ({{count}} + 1) // ({{total}} + terms)"
    difference = "(p - q) * (p - q) // q"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all({_FOLDED.format(text="coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
    w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {m.LEAST_DOCS}),
    langs AS (SELECT d.lang, coalesce(any_value(terms), 0) AS terms, coalesce(any_value(lang_total), 0) AS lang_total
              FROM d LEFT JOIN (SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM kept GROUP BY lang) k ON d.lang = k.lang GROUP BY d.lang),
    found AS (SELECT w.lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY w.lang, source, term),
    totals AS (SELECT lang, source, sum(n) AS total FROM found GROUP BY lang, source),
    groups AS (SELECT g.lang, g.source, coalesce(total, 0) AS total, terms FROM (SELECT DISTINCT lang, source FROM d) g
               JOIN langs ON langs.lang = g.lang LEFT JOIN totals ON totals.lang = g.lang AND totals.source = g.source),
    shares AS (SELECT groups.lang, groups.source, kept.term, coalesce(n, 0) AS n, {share.format(count='coalesce(n, 0)', total='total')} AS p
               FROM groups JOIN kept ON kept.lang = groups.lang
               LEFT JOIN found ON found.lang = groups.lang AND found.source = groups.source AND found.term = kept.term),
    sums AS (SELECT lang, source, item, sum({difference}) AS value
             FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source)
             GROUP BY lang, source, item),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
    terms AS (SELECT lang, source, item, ({difference})::BIGINT AS value
              FROM (SELECT s.lang, source, s.term AS item, p, {share.format(count='lang_n', total='lang_total')} AS q
                    FROM shares s JOIN kept ON kept.lang = s.lang AND kept.term = s.term JOIN langs ON langs.lang = s.lang WHERE n > 0) WHERE p > q),
    parts AS (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM terms),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {m.TOP_TERMS}"""


ORACLE_SQL = {
    "op2_near_duplicates": near_duplicates(),
    "op3_line_dedup": line_dedup_sql(),
    "op6_license_scan": license_scan_sql(),
    "op7_phrase_dedup": phrase_dedup_sql(),
    "op10_decontamination": decontamination_sql(),
    "op11_fill_in_middle": fill_in_middle_sql(),
    "op13_source_divergence": source_divergence_sql(),
}
