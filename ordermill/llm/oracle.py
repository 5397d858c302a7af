"""The queries as SQL over whole tables, where SQL can express them."""

from __future__ import annotations

from . import secrets, urlfilter

# Near-duplicates by brute force: shingles, all pairs that share one, links, reachability.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) = 1 THEN [w[1]]
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y USING (s)
    JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes n ON n.doc_id = y.doc_id
    WHERE x.doc_id <> y.doc_id AND least(m.n, n.n) * 100 >= greatest(m.n, n.n) * 80
    GROUP BY x.doc_id, y.doc_id
    HAVING 100 * count(*) >= 80 * (any_value(m.n) + any_value(n.n) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) USING (doc_id)
"""

WORDS_OF = r"""list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""

MIX_SOURCES = rf"""
WITH weighed AS (
    SELECT doc_id, avg(CASE WHEN quality = 1 THEN 2.0::DOUBLE ELSE 0.5 END) AS quality
    FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
-- copies of a row are numbered, and each has a key of its own
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, text, source) - 1 AS copy FROM documents),
docs AS (
    SELECT d.doc_id, source, len({WORDS_OF}) AS size,
        -ln((('0x' || left(md5(concat_ws('|', 'mix-1', coalesce(CAST(d.doc_id AS VARCHAR), ''),
             coalesce(md5(text), ''), CASE WHEN copy > 0 THEN CAST(copy AS VARCHAR) END)), 13))::BIGINT
             + 0.5) / 4503599627370496.0::DOUBLE) / coalesce(quality, 1.0) AS key
    FROM numbered d LEFT JOIN weighed USING (doc_id)),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM docs GROUP BY source),
-- sources in the order in which a rising level meets their bounds
ordered AS (
    SELECT *, sum(source_size) OVER () AS all_sizes, sum(weight) OVER () AS all_weights,
        coalesce(sum(2 * source_size) OVER before, 0) AS bounded,
        coalesce(sum(weight) OVER before, 0) AS bounded_weight, count(*) OVER before AS place
    FROM sources WINDOW before AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
    SELECT *, (1.5::DOUBLE * all_sizes - bounded) / (all_weights - bounded_weight) AS level
    FROM ordered),
final AS (SELECT arg_min(level, place) AS level FROM levels
          WHERE level * weight <= 2 * source_size),
targets AS (
    SELECT source, source_size, least(weight * final.level, 2.0::DOUBLE * source_size) AS target
    FROM sources, final),
split AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
        target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END
            * source_size AS budget FROM targets),
-- the total of each key and all smaller ones
placed AS (
    SELECT d.*, source_size, target, epochs, budget,
        sum(size) OVER (PARTITION BY d.source ORDER BY key) AS upto,
        sum(size) OVER (PARTITION BY d.source, key) AS own
    FROM docs d JOIN split s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
    CAST(size * (epochs + CASE WHEN budget > 0 AND (upto <= budget
        OR (upto - own <= budget AND upto - budget < budget - (upto - own))) THEN 1 ELSE 0 END)
        AS BIGINT) AS taken
FROM placed
"""

DECONTAMINATE = r"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, w FROM (SELECT item_id, list_filter(
        string_split_regex(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
        FROM (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM benchmark WHERE text IS NOT NULL))
    WHERE len(w) > 0 AND item_id IS NOT NULL),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(
        list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS words
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words)),
sizes AS (SELECT DISTINCT size FROM windows),
docs AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
stretches AS (
    SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)),
hits AS (SELECT doc_id, i, s.size, item FROM stretches s JOIN windows v
         ON v.words = s.words AND v.size = s.size),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM hits),
counted AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
          array_to_string(list_sort(list_distinct(list(item))), ',') AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN items USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS t, {WORDS_OF} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
stretches AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs)),
repeated AS (SELECT doc_id, i FROM stretches QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
repeat_words AS (SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS place FROM repeated) GROUP BY doc_id),
base AS (
    SELECT d.doc_id, source, t, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words,
        len(w) < 10 OR 100 * coalesce(n, 0) > 20 * len(w) AS base_failed, lines
    FROM docs d LEFT JOIN repeat_words USING (doc_id)),
texts AS (SELECT source, t, any_value(lines) AS lines FROM base GROUP BY source, t),
each AS (
    SELECT source, t, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),
        '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line,
        len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
    FROM (SELECT source, t, unnest(lines) AS line FROM texts)),
digests AS (SELECT DISTINCT source, t, line, md5(line) AS digest FROM each),
ordered AS (
    SELECT source, line, row_number() OVER least AS place, nth_value(digest, 1) OVER least AS first,
        nth_value(digest, 2) OVER whole AS second
    FROM digests WINDOW least AS (PARTITION BY source, t ORDER BY digest),
        whole AS (PARTITION BY source, t ORDER BY digest
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
boilerplate AS (
    SELECT source, line FROM ordered GROUP BY source, line
    HAVING count(DISTINCT CASE WHEN place = 1 THEN coalesce(second, '') ELSE first END) > 20
       AND count(DISTINCT CASE WHEN place = 1 THEN coalesce(second, '') ELSE first END)
           >= count(*) * 0.5::DOUBLE),
removed AS (
    SELECT e.source, t, CAST(sum(words) AS BIGINT) AS words FROM each e JOIN boilerplate b
    ON e.source IS NOT DISTINCT FROM b.source AND e.line = b.line GROUP BY e.source, t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words - coalesce(words, 0) >= 10
        AND n_words - coalesce(words, 0) >= n_words * 0.3::DOUBLE AS kept,
    coalesce(words, 0) AS removed_words
FROM base b LEFT JOIN removed r ON b.source IS NOT DISTINCT FROM r.source AND b.t = r.t
"""

WARC = """
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS payload,
        strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
firsts AS (SELECT payload, min(page_id) AS f FROM rows WHERE payload_bytes >= 100 GROUP BY payload)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN f IS NULL OR f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN f <> page_id THEN f END AS refers_to
FROM rows LEFT JOIN firsts USING (payload)
"""


def _rules(value: str) -> str:
    cases = "".join(
        f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}'))"
        f" AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'"
        for r in sorted(urlfilter.RULES, key=lambda r: -len(r.name)))
    return f"CASE{cases} END"


def url_filter() -> str:
    """The template tree, a level at a time, as deep as the paths are."""
    u = urlfilter
    # RE2 has no look-ahead: "followed by a dot or the end" is told by a group that stays.
    form = "seg"
    for pattern, name in ((r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}"
                           r"-[0-9a-fA-F]{12}()", "{id}"),
                          (r"^[0-9]+([.]|$)", "{n}"),
                          (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([.]|$)", "{date}")):
        form = f"regexp_replace({form}, '{pattern}', '{name}\\1')"
    form = (f"CASE WHEN regexp_matches({form}, '^[0-9a-fA-F]{{12,}}([.]|$)') AND regexp_matches("
            f"{form}, '^[a-fA-F]*[0-9]') THEN regexp_replace({form}, '^[0-9a-fA-F]+', '{{id}}') "
            f"ELSE {form} END")
    return f"""
WITH RECURSIVE raw AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0
        THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
        '{u.UPPER}', '{u.LOWER}') AS host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM raw),
rows AS (
    SELECT page_id, host, path, list_transform(
        string_split(regexp_replace(path, '^/', ''), '/'), lambda seg: {form}) AS form FROM parsed),
marks AS (
    SELECT doc_id AS page_id, max(CAST(quality = 0 OR toxic = 1 AS INTEGER)) AS bad
    FROM labels GROUP BY doc_id),
forms AS (
    SELECT host, form, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad
    FROM rows LEFT JOIN marks USING (page_id) GROUP BY host, form),
-- one level of all paths at a time, until none has a segment left
tree AS (
    SELECT host, form, labelled, bad, '' AS template, 0 AS level, false AS done FROM forms
    UNION ALL
    SELECT host, form, labelled, bad, CASE WHEN child IS NULL THEN template || '?' WHEN l >= {u.LEAST_LABELLED}
            AND al > l AND abs(b / l - (ab - b) / (al - l)) > 0
            AND abs(b / l - (ab - b) / (al - l)) >= {u.LEAST_Z}::DOUBLE * sqrt(
                (ab / al) * (1 - ab / al) * (1 / l + 1 / (al - l)))
        THEN template || '/' || child ELSE template || '/*' END, level + 1, child IS NULL
    FROM (SELECT *, sum(labelled) OVER own AS l, sum(bad) OVER own AS b,
              sum(labelled) FILTER (child IS NOT NULL) OVER parent AS al,
              sum(bad) FILTER (child IS NOT NULL) OVER parent AS ab
          FROM (SELECT *, form[level + 1] AS child FROM tree WHERE NOT done)
          WINDOW own AS (PARTITION BY host, template, child), parent AS (PARTITION BY host, template))),
last AS MATERIALIZED (SELECT * FROM tree WHERE done),
base AS (
    SELECT coalesce(sum(bad), 0) / greatest(coalesce(sum(labelled), 0), 1) AS share FROM last),
hosts AS (
    SELECT host, (sum(bad) + any_value(share) * {u.SMOOTHING}::DOUBLE)
        / (sum(labelled) + {u.SMOOTHING}::DOUBLE) AS share FROM last, base GROUP BY host),
judged AS (
    SELECT host, template, (sum(bad) + any_value(share) * {u.SMOOTHING}::DOUBLE)
        / (sum(labelled) + {u.SMOOTHING}::DOUBLE) > {u.MOST_BAD}::DOUBLE
        AND sum(labelled) >= {u.LEAST_LABELLED} AS rejected
    FROM last JOIN hosts USING (host) GROUP BY host, template)
SELECT page_id, host, path, {_rules("name")} AS rule, coalesce({_rules("verdict")},
    CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict
FROM rows JOIN last USING (host, form) JOIN judged USING (host, template)"""


def secret_scan() -> str:
    """Matches are numbered, and their places are running sums of what lies between and in them."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def matches(name: str, table: str, column: str, kind: secrets.Kind) -> str:
        pattern = quoted(kind.pattern)
        return f"""{name} AS (
            SELECT rid, {column} AS searched, regexp_extract_all({column}, {pattern}, 0) AS m,
                regexp_extract_all({column}, {pattern}, {kind.group}) AS v,
                string_split_regex({column}, {pattern}) AS g FROM {table})"""

    def good(kind: secrets.Kind, value: str) -> str:
        if kind is not secrets.KEY:
            return f"len({value}) >= {kind.least}"
        return (f"(len({value}) >= {kind.least}"
                f" AND len(regexp_replace({value}, '[^0-9]', '', 'g')) >= {secrets.LEAST_DIGITS}"
                f" AND len(regexp_replace({value}, '[^A-Za-z]', '', 'g')) >= {secrets.LEAST_LETTERS}"
                f" AND len(list_distinct(string_split({value}, ''))) >= {secrets.LEAST_DIFFERENT})")

    def places(name: str, number: int, kind: secrets.Kind) -> str:
        return f"""
            SELECT rid, {number} AS kind, ends - len(m) AS start, ends AS stop, md5(v) AS hash FROM (
                SELECT rid, m, v, sum(len(g) + len(m)) OVER (PARTITION BY rid ORDER BY i) AS ends
                FROM (SELECT rid, i, m[i] AS m, v[i] AS v, g[i] AS g
                      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {name})))
            WHERE {good(kind, "v")}"""

    steps, left = [], "docs"
    for kind in secrets.BASE_KINDS:
        steps.append(matches(f"found_{kind.name}", "docs", "text", kind))
        steps.append(matches(f"again_{kind.name}", left, "text", kind))
        left = f"left_{kind.name}"
        steps.append(f"""{left} AS (
            SELECT rid, array_to_string(list_transform(range(1, len(g) + 1), lambda i: g[i] ||
                CASE WHEN i > len(m) THEN '' WHEN {good(kind, "v[i]")} THEN repeat(' ', len(m[i]))
                ELSE m[i] END), '') AS text FROM again_{kind.name})""")
    steps.append(matches("found_key", left, "text", secrets.KEY))
    kinds = (*secrets.BASE_KINDS, secrets.KEY)
    each = " UNION ALL ".join(places(f"found_{k.name}", i, k) for i, k in enumerate(kinds))
    names = "[" + ", ".join(quoted(k.name) for k in kinds) + "]"
    text = f"{names}[kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT)"
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k.name}"
                       for i, k in enumerate(secrets.BASE_KINDS))
    last = len(secrets.BASE_KINDS)
    return f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
{", ".join(steps)},
found AS MATERIALIZED ({each}),
owned AS (
    SELECT hash, count(DISTINCT coalesce(source, chr(0))) AS owners,
        count(DISTINCT (coalesce(source, chr(0)), coalesce(CAST(doc_id AS VARCHAR), ''))) AS repositories
    FROM found JOIN docs USING (rid) GROUP BY hash),
judged AS (
    SELECT rid, kind, start, stop,
        owners <= {secrets.MOST_OWNERS} AND repositories <= {secrets.MOST_REPOSITORIES} AS live
    FROM found JOIN owned USING (hash)),
lists AS (
    SELECT rid, {counts},
        coalesce(string_agg({text}, ',' ORDER BY start, kind) FILTER (kind < {last}), '') AS base,
        string_agg({text}, ',' ORDER BY start, kind) AS spans, count(*) FILTER (live) AS n_live
    FROM judged WHERE live OR kind < {last} GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in secrets.BASE_KINDS)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_live, 0) AS n_live
FROM docs LEFT JOIN lists USING (rid)
"""


# Prefixes as texts, all nodes, and sums over the subtrees by the prefixes of each node's first member.
PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS first,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT c.conv_id, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.first AND t.place <= c.h
    UNION ALL
    SELECT conv_id, place, role, text FROM convs JOIN turns USING (conv_id) WHERE place > h),
numbered AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth
    FROM rebuilt),
prefixes AS MATERIALIZED (
    SELECT conv_id, depth, strlen(text) AS bytes, sha256(CAST(list({'r': role, 't': text})
        OVER (PARTITION BY conv_id ORDER BY depth) AS VARCHAR)) AS node FROM numbered
    UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
links AS (
    SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS above,
        lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS last FROM prefixes),
nodes AS MATERIALIZED (
    SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(above) AS above,
        count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved, bool_and(last) AS leaf,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), ''))
            AS ends_sha256
    FROM links GROUP BY node),
below AS (SELECT above AS node, count(*) AS n_children FROM nodes GROUP BY above),
subtrees AS (
    SELECT p.node, sum(CAST(leaf AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs,
    coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes u ON u.node = n.above LEFT JOIN below b ON b.node = n.node
JOIN subtrees s ON s.node = n.node
"""
