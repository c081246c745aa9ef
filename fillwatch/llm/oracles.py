"""SQL for the queries of this part that SQL can express (DuckDB)."""

from __future__ import annotations

from fillwatch.llm import licences

ORACLES: dict[str, str] = {
    "op2_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN words ELSE words[i:i + 3] END AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 3))) AS i
        FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
k AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, k.component_id, w.doc_id = k.component_id AS kept
FROM w JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
""",
    "op8_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS place,
         first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM r
""",
    "op9_mixture": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(concat_ws(':', '0', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15) AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS position
  FROM d GROUP BY source),
w AS (SELECT *, (position - 1) % 3 + 1 AS weight FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (
               ORDER BY source_size / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY source_size / weight, position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w),
c AS (SELECT *, level * weight >= source_size * 3 AS capped FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN (source_size * 3)::DOUBLE
              ELSE (SELECT level FROM c WHERE NOT capped ORDER BY source_size / weight, position LIMIT 1) * weight
         END AS target
  FROM c),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS passes FROM t),
h AS (SELECT source, place, sum(size)::BIGINT AS n FROM d GROUP BY ALL),
b AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below
  FROM h)
SELECT d.doc_id, d.size, p.source_size, p.target,
       d.size * (p.passes + CASE WHEN b.below + b.n / 2 <= p.target - p.passes * p.source_size THEN 1 ELSE 0 END) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
       JOIN b ON d.source IS NOT DISTINCT FROM b.source AND d.place = b.place
""",
    "op10_merkle_fingerprints": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next
  FROM documents),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 2) || substr(next, 1, n_chars // 2) AS edited FROM d),
u AS (SELECT DISTINCT unnest([text, next, edited]) AS t FROM e),
k AS (
  SELECT t, list_transform(string_split(t, chr(10) || chr(10)), lambda s:
              list_transform(string_split(s, chr(10)), lambda p:
                list_transform(string_split(regexp_replace(p, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: md5(x)))) AS tree
  FROM u),
h AS (
  SELECT t, list_transform(tree, lambda s: list_transform(s, lambda p: md5(array_to_string(p, '')))) AS paragraphs,
         list_distinct(flatten(flatten(tree))) AS leaves
  FROM k),
f AS (
  SELECT t, paragraphs, leaves,
         sha256(array_to_string(list_transform(paragraphs, lambda s: md5(array_to_string(s, ''))), '')) AS root
  FROM h)
SELECT e.doc_id, e.n_chars::BIGINT AS n_chars, sha256(e.edited) AS edited_sha256,
       a.root AS fingerprint, b.root AS edited_fingerprint,
       2.0::DOUBLE * len(list_intersect(a.leaves, b.leaves)) / (len(a.leaves) + len(b.leaves)) AS near_edited,
       2.0::DOUBLE * len(list_intersect(a.leaves, n.leaves)) / (len(a.leaves) + len(n.leaves)) AS near_next,
       coalesce(list_sum(list_transform(generate_series(1, len(a.paragraphs)), lambda i:
         len(list_filter(generate_series(1, len(a.paragraphs[i])), lambda j:
           a.paragraphs[i][j] IS DISTINCT FROM b.paragraphs[i][j])))), 0)::BIGINT AS n_changed
FROM e JOIN f a ON a.t = e.text JOIN f b ON b.t = e.edited JOIN f n ON n.t = e.next
""",
    "op11_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(words) - k + 1),
                                        lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(words) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2 AND f >= 10),
x AS (
  SELECT lang, size, phrase, a, k, array_to_string(words[1:k], ' ') AS first, array_to_string(words[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c)),
s AS (
  SELECT x.lang, size, x.phrase, a, x.k, l.f AS l, r.f AS r,
         ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.first JOIN f r ON r.lang = x.lang AND r.phrase = x.rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase, a
  FROM c WHERE size = 3),
d AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
k AS (
  SELECT b.* FROM b LEFT JOIN d USING (lang, phrase) WHERE d.longer IS NULL OR 100 * d.longer < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
     JOIN n USING (lang)
WHERE rank <= 2000
""",
    "op12_warc_captures": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages)
SELECT page_id, payload_bytes,
       translate(array_to_string(list_transform(generate_series(0, 7), lambda i:
                   to_base(('0x' || substr(h, 5 * i + 1, 5))::BIGINT, 32, 4)), ''),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM p
""",
}


def _licences() -> str:
    """The sentence table and the rules of ``licences`` as one statement, rule after rule."""
    known = licences.known_sentences(licences.SENTENCES)
    listed = ", ".join(f"'{s}'" for s in known)
    named = " ".join(f"WHEN '{s}' THEN '{name}'" for s, name in known.items())
    steps, left = [], "rest_0"
    for i, (licence, sequence) in enumerate(licences.RULES, 1):
        text = "".join(f",{name}," for name in sequence)
        steps.append(
            f"r{i} AS (SELECT *, replace({left}, '{text}', '|') AS rest_{i},"
            f" CASE WHEN contains({left}, '{text}') THEN '{licence}' END AS l{i} FROM r{i - 1})"
        )
        left = f"rest_{i}"
    found = ", ".join(f"l{i}" for i in range(1, len(licences.RULES) + 1))
    return rf"""
WITH d AS (
  SELECT doc_id, list_transform(
    string_split(regexp_replace(coalesce(text, ''), '([.!?:;])\s+', '\1' || chr(10), 'g'), chr(10)),
    lambda s: replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')) AS parts
  FROM documents),
h AS (
  SELECT doc_id, list_transform(list_filter(parts, lambda s: s IN ({listed})), lambda s: CASE s {named} END) AS sentences,
    len(list_filter(parts, lambda s: s NOT IN ({listed}) AND contains(' ' || s, ' license')))::BIGINT AS unknown
  FROM d),
r0 AS (SELECT *, array_to_string(list_transform(sentences, lambda x: ',' || x || ','), '') AS rest_0 FROM h),
{", ".join(steps)},
a AS (SELECT *, list_filter([{found}], lambda x: x IS NOT NULL) AS names FROM r{len(licences.RULES)})
SELECT doc_id, unknown, array_to_string(sentences, ',') AS sentences,
  array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licences,
  array_to_string(list_filter(regexp_split_to_array({left}, '[,|]+'), lambda x: x <> ''), ',') AS unmatched
FROM a
"""


ORACLES["op4_licences"] = _licences()
