"""DuckDB SQL with the results of the queries that SQL can express.

The other six (personal data, secrets, language-model scores, licences, quality rules, toxicity)
end in a trained model, a sweep, a parser or a suffix array; brute force or held-out documents
check them in tests.
"""

from __future__ import annotations

from casario.llm.queries import BLOCK_BYTES, SHARD_BYTES, WEIGHTS
from casario.llm.url_templates import MANY, PRIOR, PURITY, RARE, RULES, SIMILAR

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
cut AS (
    SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0
),
windows AS (SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS gram FROM cut),
places AS (
    SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS gram
    FROM (
        SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT m FROM windows) WHERE len(w) >= m
    )
),
found AS (SELECT doc_id, i, m, item_id FROM places JOIN windows USING (m, gram)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM found) GROUP BY ALL),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY ALL
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_WEIGHT = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in WEIGHTS.items())
OP3 = f"""
WITH RECURSIVE rows AS (
    SELECT coalesce(source, '') AS source, doc_id, sum(coalesce(strlen(text), 0))::BIGINT AS n_bytes FROM documents GROUP BY ALL
),
placed AS (
    SELECT *, (sum(n_bytes) OVER (
        PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id ROWS UNBOUNDED PRECEDING
    ) - n_bytes)::BIGINT AS start FROM rows
),
sources AS (SELECT DISTINCT source, CASE source {_WEIGHT} ELSE 1 END AS weight FROM rows),
members AS (SELECT *, row_number() OVER (PARTITION BY weight ORDER BY source) - 1 AS member FROM sources),
tasks AS (
    SELECT weight, count(*) AS m, weight * count(*) AS parts, row_number() OVER (ORDER BY weight) AS k FROM sources GROUP BY weight
),
whole AS (SELECT list(parts ORDER BY k) AS parts, sum(parts)::BIGINT AS period FROM tasks),
edf AS (
    SELECT -1 AS t, list_transform(parts, lambda x: 0::BIGINT) AS done, 0::BIGINT AS pick, parts, period FROM whole
    UNION ALL
    SELECT t, list_transform(done, lambda n, k: CASE WHEN k = pick THEN n + 1 ELSE n END), pick, parts, period
    FROM (
        SELECT t + 1 AS t, done, parts, period,
            list_min(list_filter(list_transform(range(1, len(parts) + 1), lambda k:
                CASE WHEN (done[k] * period) // parts[k] <= t + 1
                THEN {{'due': ((done[k] + 1) * period + parts[k] - 1) // parts[k], 'k': k}} END), lambda x: x IS NOT NULL)).k AS pick
        FROM edf WHERE t + 1 < period
    )
),
turns AS (SELECT pick AS k, t, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM edf WHERE t >= 0),
blocks AS (
    SELECT p.*, start // {BLOCK_BYTES} AS block, (start // {BLOCK_BYTES}) * m + member AS n, parts, k, period
    FROM placed p JOIN members USING (source) JOIN tasks USING (weight) CROSS JOIN (SELECT period FROM whole)
)
SELECT source, doc_id, n_bytes, start, block::BIGINT AS block, ((n // parts) * period + t)::BIGINT AS slot,
    ((n * period) // parts)::BIGINT AS release, (((n + 1) * period + parts - 1) // parts)::BIGINT AS deadline
FROM blocks JOIN turns USING (k) WHERE turn = n % parts
"""

OP5 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, gram FROM (
        SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS gram
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
    )
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY ALL),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT a AS doc_id, b AS other FROM edges
    UNION
    SELECT doc_id, b FROM reach JOIN edges ON other = a
),
smallest AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY ALL)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, other) AS component_id, doc_id = least(doc_id, other) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest USING (doc_id)
"""


def _op6() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in rules]
    rule = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)
    ruled = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    return f"""
WITH RECURSIVE found AS (
    SELECT page_id, host, path, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM (
        SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages
    )
),
paths AS (
    SELECT host, path, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (ruled = 'allow') AS allowed, string_split(path, '/')[2:] AS parts
    FROM found GROUP BY host, path
),
-- A row per path and segment number k: the template of the segments before it.
tree AS (
    SELECT *, 1 AS k, '' AS template FROM paths
    UNION ALL
    SELECT host, path, n, labelled, allowed, parts, k + 1, template || '/' || CASE
        WHEN child = '*' THEN '*'
        WHEN differs THEN child
        WHEN branches >= {MANY} AND child_n <= {RARE} * node_n THEN '*'
        WHEN child_labelled > 0 AND branches > 1 THEN '~'
        ELSE child END
    FROM (
        SELECT *, child_labelled > 0 AND ((child_allowed + {PRIOR} * node_allowed / node_labelled) / (child_labelled + {PRIOR}) - node_allowed / node_labelled) ** 2
            > {SIMILAR * SIMILAR} * ((node_allowed / node_labelled) * (1 - node_allowed / node_labelled) / (child_labelled + {PRIOR})) AS differs
        FROM (
            SELECT *, count(DISTINCT child) OVER node AS branches, sum(n) OVER node AS node_n, sum(labelled) OVER node AS node_labelled,
                sum(allowed) OVER node AS node_allowed, sum(n) OVER kid AS child_n, sum(labelled) OVER kid AS child_labelled, sum(allowed) OVER kid AS child_allowed
            FROM (
                SELECT *, CASE WHEN regexp_matches(regexp_replace(parts[k], '\\.[A-Za-z]{{1,5}}$', ''), '^[0-9]+$|^[0-9A-Fa-f-]{{16,}}$')
                    THEN '*' ELSE parts[k] END AS child
                FROM tree WHERE k <= len(parts)
            )
            WINDOW node AS (PARTITION BY host, template), kid AS (PARTITION BY host, template, child)
        )
    )
),
ends AS (SELECT * FROM tree WHERE k = len(parts) + 1),
per_host AS (SELECT host, template, sum(labelled) AS labelled, sum(allowed) AS allowed FROM ends GROUP BY ALL),
total AS (SELECT (sum(allowed) + {PRIOR} * 0.5) / (sum(labelled) + {PRIOR}) AS prior FROM per_host),
everywhere AS (SELECT template, (sum(allowed) + {PRIOR} * any_value(prior)) / (sum(labelled) + {PRIOR}) AS prior FROM per_host CROSS JOIN total GROUP BY ALL),
purity AS (
    SELECT host, template, (allowed + {PRIOR} * prior) / (labelled + {PRIOR}) AS purity FROM per_host JOIN everywhere USING (template)
)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity >= {PURITY} THEN 'allow' ELSE 'block' END) AS verdict, template
FROM found JOIN ends USING (host, path) JOIN purity USING (host, template)
"""


OP8 = f"""
WITH d AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
        to_base(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT, 2, 60) AS bits
    FROM documents
),
nodes AS (
    SELECT depth, substr(bits, 1, depth) AS prefix, sum(n_bytes)::BIGINT AS bytes
    FROM (SELECT bits, n_bytes, unnest(range(0, 61)) AS depth FROM d) GROUP BY ALL
),
depths AS (
    SELECT bits, min(depth) AS depth
    FROM (SELECT DISTINCT bits FROM d) JOIN nodes ON prefix = substr(bits, 1, depth)
    WHERE bytes <= {SHARD_BYTES} OR depth = 60 GROUP BY ALL
)
SELECT doc_id, n_bytes, substr(bits, 1, depth) AS shard, depth::BIGINT AS shard_depth, bytes AS shard_bytes
FROM d JOIN depths USING (bits) JOIN nodes USING (depth) WHERE prefix = substr(bits, 1, depth)
"""


# The crc32 of a text, given the list of its bytes and the table of the checksum.
CRC_TABLE = """
crc_table AS (
    SELECT list_transform(range(0, 256), lambda i:
        list_reduce(range(0, 8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i)) AS t
)"""
CRC = "xor(list_reduce({bytes}, lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)"
BYTES = "list_transform(range(0, strlen({text})), lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)"


def _crc(text: str) -> str:
    return CRC.format(bytes=BYTES.format(text=text))


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11 = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
    SELECT doc_id, coalesce('1' || lang, '0') AS grp, {_leaf("text")} AS leaf,
        CASE WHEN {_crc("doc_id::VARCHAR")} % 3 = 0
            THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS copy
    FROM documents CROSS JOIN crc_table
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY grp) AS size FROM leaves
),
up AS (
    SELECT grp, 0 AS level, place, size, leaf AS h FROM placed
    UNION ALL
    SELECT grp, level + 1, place // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY place)) FROM up WHERE size > 1 GROUP BY grp, level, place // 8, size
),
subroots AS (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS size FROM up WHERE size = 1),
top AS (
    SELECT 0 AS level, place, size, h FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY place)) FROM top WHERE size > 1 GROUP BY level, place // 8, size
),
nodes AS (SELECT grp, level, place, size, h FROM up UNION ALL SELECT 'top', level, place, size, h FROM top),
segments AS (
    SELECT grp, level, place,
        coalesce(string_agg(h, '') OVER (PARTITION BY grp, level, place // 8 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(h, '') OVER (PARTITION BY grp, level, place // 8 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM nodes WHERE size > 1
),
below AS (
    SELECT p.grp, p.place, list(before || ':' || after ORDER BY level) AS path
    FROM placed p JOIN segments s ON s.grp = p.grp AND s.place = p.place >> (3 * s.level)::BIGINT GROUP BY ALL
),
above AS (
    SELECT r.grp, list(before || ':' || after ORDER BY level) AS path
    FROM subroots r JOIN segments s ON s.grp = 'top' AND s.place = r.place >> (3 * s.level)::BIGINT GROUP BY ALL
),
whole AS (
    SELECT p.*, r.h AS subroot, coalesce(b.path, []) || coalesce(a.path, []) AS path
    FROM placed p JOIN subroots r USING (grp) LEFT JOIN below b ON b.grp = p.grp AND b.place = p.place LEFT JOIN above a ON a.grp = p.grp
),
folded AS (
    SELECT *, list_reduce(path, lambda acc, s: sha256(split_part(s, ':', 1) || acc || split_part(s, ':', 2)), coalesce(copy, leaf)) AS folded_root,
        (SELECT h FROM top WHERE size = 1) AS root FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), ':', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""

OP12 = rf"""
WITH RECURSIVE {{CRC_TABLE}},
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{{6,}}}}')) AS run FROM documents
),
seen AS (
    SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL
),
hashed AS (SELECT run, n, {{CRC_RUN}} AS h FROM seen CROSS JOIN crc_table),
counted AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY ALL
),
words AS (SELECT word, n FROM counted WHERE length(word) >= 6 AND n >= 5),
cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
shorter AS (SELECT DISTINCT c.word, c.n, w.word AS other, w.n AS other_n FROM cut c JOIN words w ON w.word = c.head || c.tail),
near AS (
    SELECT * FROM shorter
    UNION ALL
    SELECT other, other_n, word, n FROM shorter
    UNION ALL
    SELECT a.word, a.n, b.word, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
),
told AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
),
roots AS (
    SELECT word, word AS place FROM told
    UNION ALL
    SELECT r.word, t.form FROM roots r JOIN told t ON t.word = r.place WHERE t.form IS NOT NULL
)
SELECT t.word, t.form, r.place AS root, t.n, t.n_near, t.form_n::BIGINT AS form_n
FROM told t JOIN roots r ON r.word = t.word JOIN told e ON e.word = r.place WHERE e.form IS NULL
""".format(CRC_TABLE=CRC_TABLE, CRC_RUN=_crc("(id || ':' || run)"))


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": OP2,
        "op3_mixing": OP3,
        "op5_near_duplicates": OP5,
        "op6_url_filter": _op6(),
        "op8_sharding": OP8,
        "op11_merkle_manifest": OP11,
        "op12_spelling_variants": OP12,
    }
