"""DuckDB twins of the corpus queries that SQL can express.

The others have none: DuckDB lacks XXH64 (op9), the tokenizers (op3) and the
trained models (op1, op4, op10, and with them the pipeline).
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS id, vec_id, [CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.id, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([z[1] * z[2] for z in list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id <> c.id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

SHARDS = """
WITH d AS (
  SELECT doc_id, 8 + coalesce(strlen(text), 0) + 4 + coalesce(strlen(lang), 0) + 4 + coalesce(strlen(source), 0) + 4 + 8 AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents
), p AS (
  SELECT depth, h >> (60 - depth) AS prefix, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS n
  FROM d, range(0, 61) t(depth) GROUP BY ALL
), f AS (SELECT * FROM p WHERE bytes <= 1048576 OR depth = 60
), e AS (
  SELECT f.* FROM f LEFT JOIN f g ON g.depth = f.depth - 1 AND g.prefix = f.prefix >> 1 WHERE g.depth IS NULL
)
SELECT d.doc_id, d.bytes, CASE WHEN e.depth = 0 THEN '' ELSE lpad(bin(e.prefix), CAST(e.depth AS INTEGER), '0') END AS shard,
       CAST(0 AS BIGINT) AS part, e.bytes AS shard_bytes, e.n AS shard_rows
FROM d JOIN e ON d.h >> (60 - e.depth) = e.prefix
"""

MIX = f"""
WITH d AS (SELECT doc_id, source, len({_WORDS}) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
numbered AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM per),
weighed AS (SELECT *, [5.0, 2.0, 1.0][(i - 1) % 3 + 1] :: DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM numbered),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM per) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
),
goals AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT max(level) FROM levels WHERE level * w <= cap) * w, cap)) AS target
  FROM levels
),
queued AS (
  SELECT *, row_number() OVER () AS id, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM d
),
runs AS (
  SELECT q.*, g.source_size, g.target, lap, CASE WHEN target > 0 THEN (lap * source_size + upto) / target END AS finish
  FROM queued q JOIN goals g ON q.source IS NOT DISTINCT FROM g.source, range(0, 2) t(lap)
),
served AS (SELECT finish, sum(sum(size)) OVER (ORDER BY finish) AS words FROM runs WHERE finish IS NOT NULL GROUP BY finish),
edge AS (
  SELECT max(finish) AS last FROM served WHERE words <= (SELECT sum(target) FROM goals) * (1 + 1e-12::DOUBLE)
)
SELECT doc_id, CAST(any_value(size) AS BIGINT) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(any_value(size) * count(*) FILTER (finish <= last) AS BIGINT) AS taken
FROM runs, edge GROUP BY id, doc_id
"""

_CLASSES = (
    ("a", "[a-z]"),
    ("A", "[A-Z]"),
    ("0", "[0-9]"),
    (" ", r"[ \t\n\x0b\x0c\r]"),
    (".", r"[.,;:''\x22()\-]"),
    ("!", "[!?]"),
    ("+", r"[@^~=+_\x5c/\x5b\x5d{}`]"),
    ("#", "[#*$%&]"),
    ("|", "[|<>]"),
)
_COUNTS = ", ".join(f"length(text) - length(regexp_replace(text, '{r}', '', 'g'))" for _, r in _CLASSES)


def _js(p: str, q: str) -> str:
    term = "CASE WHEN {a} > 0 THEN {a} * log2({a} / ((z[1] + z[2]) / 2)) ELSE 0 END"
    both = term.format(a="z[1]") + " + " + term.format(a="z[2]")
    return f"round(sqrt(greatest(0, list_sum([{both} for z in list_zip({p}, {q})]) / 2)), 6)"


RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS text FROM documents
), parsed AS (
  SELECT *, {_WORDS} AS words, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines,
         [{_COUNTS}] AS counts,
         [x for x in regexp_split_to_array(lower(text), '[^\\p{{L}}]+') if x <> ''] AS letters
  FROM d
), windows AS (
  SELECT id, i AS place, list_slice(words, i, i + 7) AS w FROM parsed, range(1, len(words) - 6) t(i)
), repeated AS (
  SELECT id, place FROM (SELECT *, count(*) OVER (PARTITION BY id, w) AS n FROM windows) WHERE n > 1
), covered AS (SELECT id, count(DISTINCT place + k) AS n FROM repeated, range(0, 8) t(k) GROUP BY id),
measured AS (
  SELECT p.*, len(words) AS n_words, list_sum([length(x) for x in words]) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         [x / greatest(length(text), 1) for x in list_concat(counts, [length(text) - list_sum(counts)])] AS classes
  FROM parsed p LEFT JOIN covered c USING (id)
), shares AS (
  SELECT lang, k, sum(classes[k]) AS share, count(*) AS n FROM measured, range(1, {len(_CLASSES) + 2}) t(k)
  WHERE n_words > 0 GROUP BY ALL
), class_refs AS (
  SELECT lang, max(n) AS docs, list(share / n ORDER BY k) AS classes FROM shares WHERE lang IS NOT NULL GROUP BY lang
  UNION ALL
  SELECT NULL, max(n), list(share ORDER BY k) FROM (SELECT k, sum(n) AS n, sum(share) / sum(n) AS share FROM shares GROUP BY k)
), counted AS (
  SELECT lang, word, sum(weight) AS n
  FROM (SELECT lang, 100000000 // len(letters) AS weight, unnest(letters) AS word FROM measured WHERE len(letters) > 0) GROUP BY ALL
), both_counts AS (
  SELECT * FROM counted WHERE lang IS NOT NULL
  UNION ALL SELECT NULL, word, sum(n) FROM counted GROUP BY word
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM both_counts
), totals AS (SELECT lang, sum(n) AS total FROM both_counts GROUP BY lang
), word_refs AS (
  SELECT r.lang, list(word ORDER BY r) AS words, list(n / total ORDER BY r) AS shares
  FROM ranked r JOIN totals t ON r.lang IS NOT DISTINCT FROM t.lang WHERE r <= 24 GROUP BY r.lang
), refs AS (
  SELECT c.lang, docs, c.classes AS rc, coalesce(w.words, []::VARCHAR[]) AS rw,
         list_concat(coalesce(w.shares, []::DOUBLE[]), [greatest(0, 1 - coalesce(list_sum(w.shares), 0))]) AS rs
  FROM class_refs c LEFT JOIN word_refs w ON c.lang IS NOT DISTINCT FROM w.lang
), own AS (SELECT * FROM refs WHERE lang IS NOT NULL AND docs >= 20
), wide AS (
  SELECT * FROM own WHERE docs >= 0.001::DOUBLE * (SELECT sum(docs) FROM refs WHERE lang IS NOT NULL)
), serving AS (SELECT * FROM wide UNION ALL SELECT * FROM refs WHERE lang IS NULL AND NOT EXISTS (FROM wide)
), matched AS (
  SELECT m.*, rc, rw, rs FROM measured m JOIN own r ON r.lang = m.lang
  UNION ALL
  SELECT m.*, rc, rw, rs FROM measured m LEFT JOIN serving ON true
  WHERE m.lang IS NULL OR m.lang NOT IN (SELECT lang FROM own)
), compared AS (
  SELECT *, [len([y for y in letters if y = x]) / greatest(len(letters), 1) for x in rw] AS ws FROM matched
), far AS (
  SELECT *, {_js("classes", "rc")} AS class_distance,
         {_js("list_concat(ws, [greatest(0, 1 - coalesce(list_sum(ws), 0))])", "rs")} AS word_distance,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         sqrt(greatest(n_words, 1)) AS spread
  FROM compared
), judged AS (
  SELECT *, class_distance / (0.16::DOUBLE + 0.7::DOUBLE / spread) AS c, word_distance / (0.15::DOUBLE + 1.6::DOUBLE / spread) AS w
  FROM far
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(n_words >= 20 AND (c > 1 OR w > 1 OR c + w > 1.7), false) AS kept, class_distance, word_distance
FROM judged QUALIFY row_number() OVER (PARTITION BY id ORDER BY c + w, class_distance, word_distance) = 1
"""

LINES = """
WITH RECURSIVE occ AS (
  SELECT doc_id, k - 1 AS line_no, lines[k] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL), range(1, len(lines) + 1) t(k)
  WHERE length(lines[k]) >= 20
), firsts AS (
  SELECT line, min(ROW(coalesce(doc_id, -9223372036854775808), line_no)) AS place, length(line) AS n FROM occ GROUP BY line
), near AS (
  SELECT a.line AS u, b.line AS v FROM firsts a JOIN firsts b ON b.n BETWEEN a.n AND a.n + 1 AND a.line <> b.line
  WHERE (left(a.line, a.n // 2) = left(b.line, a.n // 2) OR right(a.line, a.n - a.n // 2) = right(b.line, a.n - a.n // 2))
    AND levenshtein(a.line, b.line) <= 2  -- in bytes, at least the distance in characters
), same AS (
  SELECT u, v FROM near
  WHERE levenshtein(u, v) <= 1
     OR length(u) = length(v) AND (SELECT count(*) FROM range(1, length(u) + 1) t(i) WHERE u[i] <> v[i]) <= 1
     OR length(u) + 1 = length(v) AND EXISTS (FROM range(1, length(v) + 1) t(i) WHERE left(v, i - 1) || substr(v, i + 1) = u)
), edges AS (SELECT u, v FROM same UNION SELECT v, u FROM same
), reach(line, other) AS (
  SELECT u, v FROM edges
  UNION
  SELECT r.line, e.v FROM reach r JOIN edges e ON r.other = e.u
), classes AS (
  SELECT f.line, least(f.place, coalesce(min(g.place), f.place)) AS first
  FROM firsts f LEFT JOIN reach r ON r.line = f.line LEFT JOIN firsts g ON g.line = r.other GROUP BY f.line, f.place
)
SELECT o.doc_id, CAST(o.line_no AS BIGINT) AS line_no, nullif(first[1], -9223372036854775808) AS class_doc_id,
       CAST(first[2] AS BIGINT) AS class_line_no,
       coalesce(o.doc_id, -9223372036854775808) = first[1] AND o.line_no = first[2] AS kept
FROM occ o JOIN classes c USING (line)
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), worded AS (
  SELECT lang, [x for x in regexp_split_to_array(piece, '[\\x20\\x09]+') if x <> ''] AS w FROM pieces
), totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang
), counts AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS g, k, count(*) AS f
  FROM worded, range(1, 6) a(k), range(1, len(w) - k + 2) b(i) GROUP BY ALL HAVING count(*) >= 100
), covered AS (
  SELECT DISTINCT c.lang, c.g FROM counts c JOIN (
    SELECT lang, f, k, list_slice(g, i, i + m - 1) AS part FROM counts, range(2, 5) a(m), range(1, k - m + 2) b(i) WHERE m < k
  ) x ON x.lang = c.lang AND x.part = c.g WHERE 100 * x.f >= 100 * c.f
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, n, c1.f AS l, c2.f AS r, cut,
         (1000 * c.f::HUGEINT * n::HUGEINT) // (c1.f::HUGEINT * c2.f::HUGEINT) AS score
  FROM counts c JOIN totals t USING (lang), range(1, c.k) x(cut)
  JOIN counts c1 ON c1.lang = c.lang AND c1.g = list_slice(c.g, 1, cut)
  JOIN counts c2 ON c2.lang = c.lang AND c2.g = list_slice(c.g, cut + 1, c.k)
  WHERE NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = c.lang AND v.g = c.g)
), lowest AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

AUDIT = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWERED}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), groups AS (SELECT DISTINCT lang, source FROM d
), occurring AS (SELECT id, lang, source, unnest(terms) AS term FROM d
), kept AS (SELECT lang, term, count(*) AS total FROM occurring GROUP BY ALL HAVING count(DISTINCT id) >= 3
), counted AS (SELECT lang, source, term, count(*) AS c FROM occurring GROUP BY ALL
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, k.total
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, c,
         CAST(1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER w + count(*) OVER w)::HUGEINT AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (total + 1)) // (sum(total) OVER w + count(*) OVER w)::HUGEINT AS BIGINT) AS q
  FROM cells WINDOW w AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), all_pairs AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE c > 0 AND p > q
), both_parts AS (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts
) WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op2_topk": TOP_K,
    "op5_linededup": LINES,
    "op6_sharding": SHARDS,
    "op7_rules": RULES,
    "op8_mixing": MIX,
    "op11_collocations": PHRASES,
    "op13_divergence": AUDIT,
}
