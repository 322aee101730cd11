"""Line dedup: keep bitmaps from range-partitioned line hashes. DataFrame operations only.

Every line's key (white space stripped, A-Z lower-cased) becomes a 128-bit hash. The hash rows, never the text, are
range-partitioned by (hash, salt) and sorted within each partition by document and position, so that one pass streams
the first occurrence of each key in each document. The salt (a hash of the document) splits a key that holds a large
share of all lines over many partitions; the streamed first occurrences are then counted per key with map-side partial
sums. Lines to drop come back per document as a sparse bitmap: 64-bit words, only those that have a bit set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, doc_id, documents, keyed, lower_ascii, partitions, stage


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    line = F.btrim(F.col("line"), F.lit(WS))
    rows = keyed(docs).select("_id", "_rk", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.char_length(line) >= min_chars)
    key = rows.select("_id", "_rk", "pos", lower_ascii(line).alias("key"))
    return key.select("_id", "_rk", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def drop_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per document that loses lines: ``_id``, ``_rk``, ``words`` array<struct<w,bits>>: bit b of word w stands for line
    64 w + b, and is set if the line goes. Keys of at least ``min_chars`` code points in at least ``min_docs`` documents
    lose all their lines except those of the largest doc_id that holds the key."""
    spark = docs.sparkSession
    lines = stage(line_hashes(docs, min_chars), "line-hashes")
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("_id", "_rk"), F.lit(partitions(spark))))
    ranged = salted.repartitionByRange(partitions(spark), "h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", F.desc("_id"), F.desc("_rk"), "pos")
    w = Window.partitionBy("h1", "h2", "salt").orderBy(F.desc("_id"), F.desc("_rk"), "pos")
    again = F.coalesce((F.lag("_id").over(w) == F.col("_id")) & (F.lag("_rk").over(w) == F.col("_rk")), F.lit(False))
    firsts = ranged.select("h1", "h2", "_id", again.alias("again")).where(~F.col("again"))
    common = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("_id").alias("top")).where(F.col("n") >= min_docs)
    # written down, so that both sides of the join are plain shuffles and adaptive execution can split a hot key's lines
    common = stage(common.select("h1", "h2", "top"), "common-lines")
    gone = lines.join(common.hint("merge"), ["h1", "h2"]).where(F.col("_id") != F.col("top"))
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    words = gone.groupBy("_id", "_rk", F.expr("cast(pos div 64 as int)").alias("w")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("_id", "_rk").agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("words"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per document: doc_id, text (the lines that stay, joined by \\n), n_lines, n_dropped, words (the bitmap;
    null if nothing goes). A null or empty text is one empty line; repeated rows of one document count once per key."""
    bitmaps = drop_bitmaps(docs, min_chars, min_docs)
    both = keyed(docs).join(bitmaps, ["_id", "_rk"], "left")
    lines = F.split("text", "\n")
    # the set bits, ascending: line numbers; what lies between two neighbours is a run of lines that stays
    gone = F.expr("flatten(transform(words, x -> transform(filter(sequence(0, 63), b -> (shiftright(x.bits, b) & 1L) = 1L), b -> x.w * 64 + b)))")
    cut = both.withColumn("lines", F.when(F.col("words").isNotNull(), lines)).withColumn("gone", gone)
    runs = F.expr("flatten(zip_with(concat(array(-1), gone), concat(gone, array(size(lines))), (a, b) -> slice(lines, a + 2, b - a - 1)))")
    return cut.select(
        doc_id(),
        F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(runs, "\n")).alias("text"),
        (F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        "words",
    )


def op1_line_dedup(spark, sf_dir) -> DataFrame:
    """Every line of every whole text of documents, by ``line_dedup`` with 40 code points and 5 documents. A null or empty text is
    one empty line; a line held by documents with equal doc_ids counts once for each text; of documents that share the largest
    doc_id all keep the line. Repeated rows get equal rows; an empty table gives none; other columns are not read."""
    out = line_dedup(documents(spark, sf_dir), 40, 5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT a.doc_id, a.pos, a.line, (c.top IS NOT NULL AND c.top <> a.doc_id) AS gone FROM keyed a LEFT JOIN common c ON a.k = c.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
