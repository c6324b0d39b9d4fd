"""The queries of the operators, op<N>_<name>(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for each document.  Null text is empty and fails the base rules; null lang and source are
    values of their own; repeated rows get equal verdicts; an empty table gives none."""
    from .quality import verdicts

    return verdicts(_table(spark, sf_dir, "documents")).drop("row_key")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept after later occurrences of repeated three-line windows are gone.  Null text has no lines and
    a null hash; a row that repeats id and text is one document with its repetition."""
    from .linededup import dedup

    out = dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_mix_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document.  Null text has size 0 and is never taken; the null source
    comes last; repeated rows are placed one by one; an empty table gives none."""
    from .mixing import mixture

    return mixture(_table(spark, sf_dir, "documents")).drop("source")


OP3_SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, unnest(range(len(ls) - 2)) AS pos, ls FROM l WHERE len(ls) >= 3),
v AS (SELECT doc_id, pos, [ls[pos + 1], ls[pos + 2], ls[pos + 3]] AS win FROM w WHERE trim(ls[pos + 1] || ls[pos + 2] || ls[pos + 3], ' ') <> ''),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM v),
g AS (SELECT DISTINCT doc_id, pos + k AS line FROM f, range(3) t(k) WHERE nth > 1),
a AS (SELECT doc_id, unnest(range(len(ls))) AS line, ls FROM l),
k AS (SELECT a.doc_id, count(*) FILTER (WHERE g.line IS NOT NULL) AS n_removed, count(*) AS n_lines,
        coalesce(string_agg(a.ls[a.line + 1], chr(10) ORDER BY a.line) FILTER (WHERE g.line IS NULL), '') AS kept
      FROM a LEFT JOIN g ON a.doc_id = g.doc_id AND a.line = g.line GROUP BY a.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(kept) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""


def op4_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives written of all pages give back.  Null html is an empty payload; of equal payloads the
    largest page_id is response, and null ids are smaller than all others."""
    from .warc import round_trip

    return round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: A hex digest in base32: five hex digits are four characters.
OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM h),
q AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(hex, 5 * i + 1, 5))::BIGINT) AS fives FROM g)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(fives, lambda v: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM q
"""


def op9_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page.  Null html has the empty text; a null url is of the host of no name; repeated
    rows get equal texts."""
    from .html import extract

    return extract(_table(spark, sf_dir, "pages"))


def op5_jaccard_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document under near-duplicate links.  Null and blank texts have no shingles and are
    their own component; repeated rows are copies of each other."""
    from .jaccard import clusters

    return clusters(_table(spark, sf_dir, "documents"))


def op6_substring_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without its repeated 35-word windows.  Null text has no words; repeated rows
    repeat each other."""
    from .substring import dedup

    return dedup(_table(spark, sf_dir, "documents")).drop("kept")


def op7_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of each document.  Null text is empty; repeated rows share their places in any order."""
    from .sharding import placed

    return placed(_table(spark, sf_dir, "documents"), shards=40)


def op8_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of each document.  Null text and texts without a letter are und; a null doc_id is
    never held out; without labels all are und."""
    from .langid import identify

    return identify(_table(spark, sf_dir, "documents"))


def op10_cgk_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each (document, benchmark item) within the edit bound.  Null texts match nothing; rows that repeat
    id and text give one row."""
    from .decontaminate import leaked_documents

    return leaked_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_phrase_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language.  Null text has no words, null lang is und, repeated rows count each time."""
    from .phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"))


def op12_resample_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight of each document towards the benchmark, and the rank of those drawn.  Null text has no features; a
    null id draws its noise as the empty string; repeated rows have rows of their own."""
    from .resampling import drawn

    return drawn(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_piece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pieces and what they decode to.  Null text is empty and has the end id only."""
    from .pieces import digests

    return digests(_table(spark, sf_dir, "documents"))


_WORDS = "string_split_regex(trim({}, E' \\t\\n\\x0B\\f\\r'), '[\\x20\\x09-\\x0D]+')"
#: Links by joining shingles, and the least id of a component by spreading it until nothing changes.
OP5_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, CASE WHEN t IS NULL OR NOT regexp_matches(t, '[^\\x20\\x09-\\x0D]') THEN [] ELSE {_WORDS.format('t')} END AS ws FROM d),
u AS (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM u),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT doc_id, n, md5(string_agg(g, chr(10) ORDER BY g)) AS same FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
c AS (SELECT same, min(doc_id) AS rep, any_value(n) AS n FROM k GROUP BY same),
cs AS (SELECT s.doc_id, s.g, c.n FROM s JOIN c ON c.rep = s.doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM cs a JOIN cs b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rep AS v, rep AS root FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v WHERE r.root < e.b),
m AS (SELECT v, min(root) AS root FROM r GROUP BY v)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN k ON k.doc_id = w.doc_id LEFT JOIN c ON c.same = k.same LEFT JOIN m ON m.v = c.rep
"""

OP6_SQL = f"""
WITH w AS (SELECT doc_id, CASE WHEN text IS NULL OR NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN [] ELSE {_WORDS.format('text')} END AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(1, len(ws) - 33))) AS i, ws FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, array_to_string(ws[i : i + 34], ' ') AS win FROM p),
g AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY win) > 1),
x AS (SELECT DISTINCT doc_id, i + k AS at FROM g, range(35) r(k)),
o AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS at, ws FROM w),
f AS (SELECT o.doc_id, count(*) FILTER (WHERE x.at IS NOT NULL) AS n_removed, coalesce(string_agg(o.ws[o.at], ' ' ORDER BY o.at) FILTER (WHERE x.at IS NULL), '') AS kept FROM o LEFT JOIN x ON x.doc_id = o.doc_id AND x.at = o.at GROUP BY o.doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(f.n_removed, 0) AS n_removed, sha256(coalesce(f.kept, '')) AS kept_sha256 FROM w LEFT JOIN f ON f.doc_id = w.doc_id
"""

#: Every cut of every candidate, with 128-bit integers.
OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, m FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, range(1, 6) r(m) WHERE len(ws) >= m)),
f AS (SELECT lang, phrase, m, count(*)::HUGEINT AS f FROM g GROUP BY lang, phrase, m HAVING count(*) >= 100),
s AS (SELECT *, string_split(phrase, ' ') AS ws FROM f),
o AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, unnest([array_to_string(ws[1 : m - 1], ' '), array_to_string(ws[2 : m], ' ')]) AS phrase, f FROM s WHERE m > 2) GROUP BY lang, phrase),
c AS (SELECT s.*, unnest(range(1, s.m)) AS k FROM s LEFT JOIN o ON o.lang = s.lang AND o.phrase = s.phrase WHERE s.m > 1 AND (o.longer IS NULL OR o.longer < s.f)),
x AS (SELECT c.lang, c.phrase, c.k, c.f AS a, l.f AS l, r.f AS r, n.n, (1000 * c.f * n.n) // (l.f * r.f) AS score FROM c JOIN n ON n.lang = c.lang JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : c.k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1 : c.m], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER v AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM b
WINDOW v AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER v <= 2000
"""

#: CRC32 over the bytes of each different word; the table of 256 entries follows from the polynomial.
OP12_SQL = r"""
WITH tb AS (SELECT list(list_reduce([v::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY v) AS tab FROM range(256) r(v)),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
e AS (SELECT doc_id, unnest(ws) AS word FROM w),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM e UNION SELECT word FROM q)),
c AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) % 10000 AS bucket FROM v, tb),
s AS (SELECT bucket, count(*) AS s FROM e JOIN c USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM q JOIN c USING (word) GROUP BY bucket),
z AS (SELECT (SELECT count(*) FROM e) AS ss, (SELECT count(*) FROM q) AS tt),
g AS (SELECT b AS bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000)::DOUBLE) / ((coalesce(s, 0) + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS gain FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b, z),
d AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM e JOIN c USING (word) JOIN g USING (bucket) GROUP BY doc_id),
a AS (SELECT w.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w LEFT JOIN d ON d.doc_id = w.doc_id),
k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM a WHERE n_features >= 20)
SELECT a.*, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM a LEFT JOIN k ON k.doc_id = a.doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_mcd, op2_mix_blocks, op3_line_dedup, op4_warc_salvage, op5_jaccard_prefixes, op6_substring_levels, op7_hypergeometric_shards, op8_byte_cnn, op9_host_paths, op10_cgk_leaks, op11_phrase_suffixes, op12_resample_chunks, op13_piece_chunks)}

ORACLE_SQL: dict[str, str] = {"op3_line_dedup": OP3_SQL, "op4_warc_salvage": OP4_SQL, "op5_jaccard_prefixes": OP5_SQL, "op6_substring_levels": OP6_SQL, "op11_phrase_suffixes": OP11_SQL, "op12_resample_chunks": OP12_SQL}
