"""The named queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.llm import quality, toxicity
from velograph.llm.common import Workspace, crc32_fold, read_table
from velograph.llm.decontamination import contamination_columns, find_benchmark_text
from velograph.llm.htmltext import extract_text
from velograph.llm.merkle import fold_leaves, table_manifest
from velograph.llm.minhash import near_duplicates
from velograph.llm.packing import pack_documents
from velograph.llm.periodic import find_periodic_runs
from velograph.llm.suffixes import remove_repeats, repeat_columns
from velograph.llm.tokencounts import count_tokens
from velograph.llm.tokenfiles import read_token_files, write_token_files
from velograph.llm.training import HELD_OUT
from velograph.llm.vectors import near_duplicate_vectors
from velograph.llm.warc import read_archives, write_archives

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url", "html")
    archives = write_archives(pages, Workspace(spark))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_OP1_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100',
    '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111']
    [strpos('0123456789abcdef', substr(h, i, 1))]), '') AS b
  FROM hashed),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT)
      + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT)
      + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT) + CAST(substr(b, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest
  FROM bits),
chosen AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM digests)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept IS NULL OR page_id IS NOT DISTINCT FROM kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN kept IS NULL OR page_id IS NOT DISTINCT FROM kept THEN NULL ELSE kept END AS refers_to
FROM chosen
"""


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read_table(spark, folder, "documents"), tokenizer_path())


def _scored(spark: SparkSession, folder: str, method) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    model = method.train(documents, read_table(spark, folder, "labels"))
    scored = method.score(documents.select("doc_id", "text"), model, result="score")
    held_out = (crc32_fold("doc_id") == HELD_OUT).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= method.CUT).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, quality)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, toxicity)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    found = contamination_columns(find_benchmark_text(documents, read_table(spark, folder, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_OP5_SQL = rf"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT item, w, least(13, len(w)) AS m FROM items WHERE len(w) > 0),
starts AS (SELECT item, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i FROM sized),
windows AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM starts),
places AS (
  SELECT doc_id, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS i
  FROM cut, (SELECT DISTINCT m FROM windows)),
hits AS (
  SELECT p.doc_id, p.i, p.m, windows.item
  FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM places) p
  JOIN windows ON p.m = windows.m AND p.s = windows.s),
words_hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hits) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM cut LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""

def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


_OP9_SQL = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, CAST(greatest(len(w) - 3, 2) AS BIGINT))) AS i FROM cut WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM cut
  UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON reach.r = links.u),
least_id AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_id LEFT JOIN sizes USING (doc_id)
"""

def op6_tokens(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(documents, tokenizer_path("piece_bpe_32k.model")).select("doc_id", "n_tokens")


def op10_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(read_table(spark, folder, "pages"))


def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    return repeat_columns(remove_repeats(documents)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


_OP8_SQL = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) // 2 - 199 AS BIGINT))) AS i FROM texts WHERE len(h) >= 400)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS n FROM starts) WHERE n > 1),
marked AS (
  SELECT doc_id, i, CASE WHEN i > lag(i) OVER w + 200 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM again WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run),
lists AS (
  SELECT doc_id, list(a ORDER BY a) AS froms, list(b ORDER BY a) AS tos, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN froms IS NULL THEN unhex(h) ELSE unhex(substr(h, 1, 2 * froms[1]) || array_to_string(list_transform(
    range(1, len(froms) + 1), lambda k: substr(h, CAST(2 * tos[k] + 1 AS BIGINT), CAST(CASE WHEN k < len(froms)
      THEN 2 * (froms[k + 1] - tos[k]) ELSE len(h) END AS BIGINT))), '')) END) AS kept_sha256
FROM texts LEFT JOIN lists USING (doc_id)
"""

def op4_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, folder, "embeddings"))


_OP4_SQL = """
WITH RECURSIVE able AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM able a JOIN able b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT reach.vec_id, links.v FROM reach JOIN links ON reach.r = links.u),
least_id AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM least_id
"""

# Words between ASCII white space, as both engines' patterns write them.
_WORD = r"[^\x20\x09-\x0D]+"


def with_planted_period(documents: DataFrame) -> DataFrame:
    """Texts of which every tenth id's repeats its words from a place on, as the query's contract asks.

    Ids are drawn by CRC-32, which also gives the place and the number of repeats. A text without words,
    or a row without an id, stays as it is.
    """
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    drawn = documents.withColumn("_h", digest).withColumn(
        "_words", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    )
    drawn = drawn.withColumn("_n", F.size("_words")).withColumn("_g", F.expr("_h div 10"))
    drawn = drawn.withColumn("_a", F.expr("CASE WHEN _n > 0 THEN CAST(_g % _n AS INT) END"))
    drawn = drawn.withColumn("_p", F.expr("CAST(1 + (_n - _a) div (3 + _g % 8) AS INT)"))
    repeats = "flatten(array_repeat(slice(_words, _a + 1, _p), CAST(1 + (_n - _a) div _p AS INT)))"
    planted = f"array_join(concat(slice(_words, 1, _a), slice({repeats}, 1, _n - _a)), ' ')"
    text = F.expr(f"CASE WHEN _a IS NULL THEN text ELSE {planted} END").alias("text")
    return drawn.select(*(text if c == "text" else F.col(c) for c in documents.columns))


def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    documents = with_planted_period(read_table(spark, folder, "documents").select("doc_id", "text"))
    found = find_periodic_runs(documents)
    order = """CASE WHEN a.length * b.period <> b.length * a.period
                 THEN IF(a.length * b.period > b.length * a.period, -1, 1)
               WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
               ELSE CAST(sign(a.period - b.period) AS INT) END"""
    best = F.expr(f"try_element_at(array_sort(runs, (a, b) -> {order}), 1)")
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


# The CRC-32 of an id's decimal text, bit by bit.
_CRC32_SQL = """
  SELECT doc_id AS id, CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) END AS h
  FROM (SELECT DISTINCT doc_id FROM documents)"""

_OP11_SQL = rf"""
WITH crc AS ({_CRC32_SQL}),
cut AS (
  SELECT row_number() OVER () AS r, d.doc_id, h, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents d LEFT JOIN crc ON d.doc_id IS NOT DISTINCT FROM crc.id),
sized AS (SELECT r, doc_id, h, w, CAST(len(w) AS BIGINT) AS n FROM cut),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM sized),
spun AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
words AS (
  SELECT r, n, i, CASE WHEN a IS NULL OR i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END AS word
  FROM (SELECT r, n, a, p, w, unnest(range(0, n)) AS i FROM spun)),
cells AS (
  SELECT x.r, x.i, x.i - y.i AS lag FROM words x JOIN words y
    ON x.r = y.r AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n),
runs AS (
  SELECT r, min(i) - lag AS start, count(*) + lag AS length, lag AS period
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS diagonal FROM cells)
  GROUP BY r, lag, diagonal HAVING count(*) + lag >= greatest(6, 4 * lag)),
smallest AS (SELECT r, start, length, min(period) AS period FROM runs GROUP BY r, start, length),
per_row AS (
  SELECT r, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM smallest GROUP BY r),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r
    ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS place FROM smallest),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM smallest),
rest AS (
  SELECT words.r, string_agg(word, ' ' ORDER BY words.i) AS kept
  FROM words LEFT JOIN dropped ON words.r = dropped.r AND words.i = dropped.i
  WHERE dropped.i IS NULL GROUP BY words.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM spun LEFT JOIN per_row USING (r) LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (r)
  LEFT JOIN rest USING (r)
"""

def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return read_token_files(write_token_files(read_table(spark, folder, "documents"), tokenizer_path(), Workspace(spark)))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    manifest = table_manifest(
        documents, Workspace(spark), present={"n_chars": F.col("n_chars") + 1}, changed=tampered
    )
    return fold_leaves(manifest).withColumnRenamed("key", "doc_id")


def _digest_sql(n_chars: str) -> str:
    parts = ["doc_id", "source", "lang", n_chars, "text"]
    sized = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
    return f"sha256({' || '.join(sized.format(p) for p in parts)})"


# Groups are told by k, which sorts like lang with null first; 'top' is the tree over their roots.
_OP13_SQL = f"""
WITH RECURSIVE crc AS ({_CRC32_SQL}),
digests AS (
  SELECT d.doc_id, coalesce('x' || lang, '') AS k, {_digest_sql('n_chars')} AS leaf,
    CASE WHEN h % 7 = 0 THEN {_digest_sql('(n_chars + 1)')} ELSE {_digest_sql('n_chars')} END AS present
  FROM documents d LEFT JOIN crc ON d.doc_id IS NOT DISTINCT FROM crc.id),
leaves AS (
  SELECT *, row_number() OVER () AS r, count(*) OVER (PARTITION BY k) AS n,
    row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM digests),
nodes(k, level, i, node, n) AS (
  SELECT k, 0, i, leaf, n FROM leaves
  UNION ALL
  SELECT k, any_value(level) + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY k, i // 2),
subroots AS (
  SELECT k, node, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, i, node, n) AS (
  SELECT 0, i, node, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY i // 2),
folded(r, k, level, i, n, node, proof) AS (
  SELECT r, k, 0, i, n, present, '' FROM leaves
  UNION ALL
  SELECT f.r, f.k, f.level + 1, f.i // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.i % 2 = 1 THEN s.node || f.node ELSE f.node || coalesce(s.node, '') END),
    f.proof || coalesce(s.node, '')
  FROM folded f LEFT JOIN nodes s ON s.k = f.k AND s.level = f.level AND s.i = xor(f.i, 1) WHERE f.n > 1),
above(r, level, i, n, node, proof) AS (
  SELECT f.r, 0, s.i, s.n, f.node, f.proof FROM folded f JOIN subroots s ON s.k = f.k WHERE f.n = 1
  UNION ALL
  SELECT f.r, f.level + 1, f.i // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.i % 2 = 1 THEN s.node || f.node ELSE f.node || coalesce(s.node, '') END),
    f.proof || coalesce(s.node, '')
  FROM above f LEFT JOIN tops s ON s.level = f.level AND s.i = xor(f.i, 1) WHERE f.n > 1),
root AS (SELECT node AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroots.node AS subroot, root, sha256(proof) AS proof_sha256, above.node AS folded_root,
  above.node = root AS verified
FROM leaves JOIN subroots USING (k) JOIN above ON above.r = leaves.r AND above.n = 1, root
"""

QUERIES = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_vectors": op4_vectors,
    "op5_decontamination": op5_decontamination,
    "op6_tokens": op6_tokens,
    "op7_toxicity": op7_toxicity,
    "op8_suffixes": op8_suffixes,
    "op9_minhash": op9_minhash,
    "op10_html": op10_html,
    "op11_periodic": op11_periodic,
    "op12_token_files": op12_token_files,
    "op13_merkle": op13_merkle,
}
ORACLE_SQLS = {
    "op1_warc": _OP1_SQL,
    "op4_vectors": _OP4_SQL,
    "op5_decontamination": _OP5_SQL,
    "op8_suffixes": _OP8_SQL,
    "op9_minhash": _OP9_SQL,
    "op11_periodic": _OP11_SQL,
    "op13_merkle": _OP13_SQL,
}
