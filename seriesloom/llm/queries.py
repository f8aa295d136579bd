"""The queries of this subpackage over the driver tables, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import lean_batches
from seriesloom.llm.cotraining import fit_views, score_quality
from seriesloom.llm.divergence import divergence_audit
from seriesloom.llm.extraction import main_texts
from seriesloom.llm.infilling import infilled, restored
from seriesloom.llm.licenses import TEMPLATES, THRESHOLD, license_scan
from seriesloom.llm.minhash import near_duplicates
from seriesloom.llm.mixing import systematic_copies, word_count
from seriesloom.llm.neighbours import nearest_neighbours
from seriesloom.llm.packing import packed_documents
from seriesloom.llm.pii import COUNTS, personal_data
from seriesloom.llm.sharding import shard_rows
from seriesloom.llm.substrings import without_repeats
from seriesloom.llm.vector_dedup import near_duplicate_vectors
from seriesloom.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name, with check SQL when there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file lies on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _license_sql() -> str:
    values = ",\n         ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
    plain = (
        r"regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]', ' ', 'g')"
    )
    words = r"list_filter(string_split_regex({}, '[ \n]+'), lambda x: x <> '')"
    grams = "list_distinct(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))"
    breaks = "length({0}) - length(replace({0}, chr(10), ''))"
    return rf"""
WITH given(license, text) AS (VALUES {values}),
plain_given AS (SELECT license, {plain} AS text FROM given),
template_units AS (
  SELECT license, text FROM plain_given
  UNION SELECT license, unnest(string_split_regex(text, '\n( *\n)+')) FROM plain_given),
templates AS (
  SELECT DISTINCT license, list_sort({grams}) AS grams FROM (SELECT license, {words.format("text")} AS w FROM template_units)),
plain AS (
  SELECT row_number() OVER () AS row, doc_id, {plain} AS text FROM documents WHERE text IS NOT NULL),
parts AS (
  SELECT row, doc_id, string_split_regex(text, '\n( *\n)+') AS parts, regexp_extract_all(text, '\n( *\n)+') AS gaps FROM plain),
units AS (
  SELECT row, doc_id, 0 AS line, text FROM plain
  UNION ALL
  SELECT row, doc_id, unnest(range(0, len(string_split(text, chr(10))))), unnest(string_split(text, chr(10))) FROM plain
  UNION ALL
  SELECT row, doc_id, coalesce(list_sum(list_transform(parts[1:k], lambda x: {breaks.format("x")}))
                             + list_sum(list_transform(gaps[1:k], lambda x: {breaks.format("x")})), 0) AS line, parts[k + 1]
  FROM (SELECT *, unnest(range(0, len(parts))) AS k FROM parts)),
sets AS (
  SELECT row, doc_id, line, {grams} AS grams
  FROM (SELECT row, doc_id, line, {words.format("text")} AS w FROM units) WHERE len(w) > 1),
scored AS (
  SELECT row, doc_id, license, line, 2 * len(list_intersect(s.grams, t.grams)) / CAST(len(s.grams) + len(t.grams) AS DOUBLE) AS dice
  FROM sets s JOIN templates t ON len(t.grams) > 1
   AND len(s.grams) BETWEEN floor({THRESHOLD} / (2 - {THRESHOLD}) * len(t.grams)) AND ceil((2 - {THRESHOLD}) / {THRESHOLD} * len(t.grams)))
SELECT doc_id, license, max(dice) AS dice, CAST(arg_min(line, (-dice, line)) AS BIGINT) AS first_line,
       count(DISTINCT line) AS n_places
FROM scored WHERE dice >= {THRESHOLD} - 1e-9 GROUP BY row, doc_id, license"""


@query(_license_sql())
def op1_license_scan(spark: SparkSession, d: str) -> DataFrame:
    """Licence notices and texts in every document."""
    return license_scan(read_table(spark, d, "documents"), "doc_id", "text")


@query()
def op2_jump_shards(spark: SparkSession, d: str) -> DataFrame:
    """Documents on 40 shards by the jump of their id; the law is ``key``."""
    text = F.coalesce("text", F.lit(""))
    rows = read_table(spark, d, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = shard_rows(rows, "doc_id", 40, ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query()
def op3_anchor_pii(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in every document."""
    found = personal_data(read_table(spark, d, "documents"), "doc_id", "text")
    return found.select("doc_id", *COUNTS, "base_sha256", "spans", "cleaned")


@query()
def op4_cotraining(spark: SparkSession, d: str) -> DataFrame:
    """Quality of every document by two co-trained views."""
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    scored = score_quality(docs, fit_views(docs, labels))
    return scored.select("row.doc_id", "p_text", "p_meta", "score", "kept")


@query()
def op5_template_text(spark: SparkSession, d: str) -> DataFrame:
    """Main text of every page by its host's template."""
    lean_batches(spark)
    return main_texts(read_table(spark, d, "pages")).select("*", F.length("text").cast("long").alias("n_chars"))


@query()
def op6_hamming_join(spark: SparkSession, d: str) -> DataFrame:
    """Near duplicates among all documents: two-word shingles, similarity 0.8."""
    return near_duplicates(read_table(spark, d, "documents"), "doc_id", "text", width=2)


@query()
def op7_pca_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicate vectors among all embeddings at cosine 0.9."""
    return near_duplicate_vectors(read_table(spark, d, "embeddings"), "vec_id", "embedding", 0.9)


@query()
def op8_cross_polytope(spark: SparkSession, d: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding among all others."""
    found = nearest_neighbours(read_table(spark, d, "embeddings"), "vec_id", "embedding", lambda key: key % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, (sum(source_size) OVER () * 1.5e0
             - coalesce(sum(2e0 * source_size) OVER (ORDER BY 2e0 * source_size / weight, source NULLS LAST
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY 2e0 * source_size / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT source, source_size,
         least(2e0 * source_size, coalesce(max(CASE WHEN level * weight <= 2e0 * source_size THEN level END) OVER () * weight,
                                           2e0 * source_size)) AS target,
         CAST(('0x' || substr(md5('20:' || CASE WHEN source IS NULL THEN '-' ELSE '+' || source END), 1, 12)) AS BIGINT)
           / 281474976710656e0 AS u
  FROM filled),
placed AS (
  SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY size, md5(CAST(doc_id AS VARCHAR)), doc_id) AS nth
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(rate * nth + u) - floor(rate * (nth - 1) + u) AS BIGINT) * size AS taken
FROM placed"""


@query(_MIX)
def op9_systematic_mix(spark: SparkSession, d: str) -> DataFrame:
    """All documents mixed to the source weights 3, 1, 2; words taken of each."""
    docs = read_table(spark, d, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = systematic_copies(docs, "doc_id", "size", "source")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query()
def op10_vector_packing(spark: SparkSession, d: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens, one row per piece."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    packed = packed_documents(docs, "doc_id", "text", tokenizer_path())
    return packed.select("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")


_UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_INFILL = rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_UNITS}') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
drawn AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         list_transform([1, 9, 17, 25], lambda i: CAST(('0x' || substr(digest, i, 8)) AS BIGINT)) AS h
  FROM cut),
placed AS (
  SELECT doc_id, text, u, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
              WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
joined AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS s
  FROM placed)
SELECT doc_id, n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM joined"""


@query(_INFILL)
def op11_infilling(spark: SparkSession, d: str) -> DataFrame:
    """Fill-in-the-middle form of every document, by digests of the output and of the text rebuilt from it."""
    made = infilled(read_table(spark, d, "documents"), "doc_id", "text")
    digest = F.sha2(F.col("output").cast("binary"), 256)
    rebuilt = F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest.alias("output_sha256"), rebuilt.alias("restored_sha256"))


_DIVERGENCE = r"""
WITH given AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM given),
kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
groups AS (SELECT DISTINCT lang, source FROM given),
counted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
cells AS (
  SELECT g.lang, g.source, k.term, CAST(coalesce(c.n, 0) AS HUGEINT) AS n, k.total
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
rated AS (
  SELECT *, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p,
         1 + (1000000000 * (total + 5)) // (sum(total) OVER w + 5 * count(*) OVER w) AS q
  FROM cells WINDOW w AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM rated a JOIN rated b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every_pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
  SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value FROM rated WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM every_pair
UNION ALL
SELECT lang, source, 'term' AS part, item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms)
WHERE rank <= 50"""


@query(_DIVERGENCE)
def op13_divergence_audit(spark: SparkSession, d: str) -> DataFrame:
    """How the sources of each language differ in their terms, and the terms that tell each source."""
    return divergence_audit(read_table(spark, d, "documents"), "text", "lang", "source")


@query()
def op12_repeated_passages(spark: SparkSession, d: str) -> DataFrame:
    """Every document without the bytes of strings of 400 bytes that occur elsewhere too.

    ``kept_text`` shows what is left, with U+FFFD where a cut fell within a character; the digest is of the bytes.
    """
    left = without_repeats(read_table(spark, d, "documents"), "doc_id", "text")
    spans, digest = F.size("spans").cast("long"), F.sha2("kept", 256)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return left.select("doc_id", "n_bytes", "n_removed", spans.alias("n_spans"), digest.alias("kept_sha256"), text.alias("kept_text"))
