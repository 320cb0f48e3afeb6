"""Dedup of lines across documents, returned as sparse bitmaps of the dropped lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsframe.llm.common import ascii_lower, fresh, read_table, saved, text_or_empty

SPACE = " \t\n\x0b\x0c\r"
# Lines of a range of hashes on the mean; ranges of over twice as many are sliced.
RANGE_LINES = 2048


def lines_of(text: str | Column) -> Column:
    """The lines of a text, split at line feeds; a null or empty text is one empty line."""
    return F.split(text_or_empty(text), "\n", -1)


def line_keys(text: str | Column) -> Column:
    """The key of each line: stripped at both ends, A-Z in lower case."""
    return F.transform(
        F.split(ascii_lower(text_or_empty(text)), "\n", -1),
        lambda line: F.btrim(line, F.lit(SPACE)))


def _hashed(line: str) -> list[Column]:
    """128 bits that stand for a key."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), F.reverse(line)).alias("h2")]


def _in_ranges(entries: DataFrame) -> DataFrame:
    """The entries with their ``range`` (leading bits of the hash, ``RANGE_LINES`` in each on
    the mean) and their ``slice``: an overfull range has ``slices`` of its documents.

    There are fewer overfull ranges than ``entries / RANGE_LINES``, and each is one small row.
    """
    bits = max(1, (entries.count() // RANGE_LINES).bit_length())
    ranged = entries.withColumn("range", F.shiftrightunsigned("h1", 64 - bits))
    overfull = saved(ranged.groupBy("range").agg(F.count("*").alias("held")).where(F.col("held") > 2 * RANGE_LINES)
                     .select("range", F.ceil(F.col("held") / RANGE_LINES).alias("slices")), "ranges")
    document = F.xxhash64(F.coalesce("id", "version"))
    return ranged.join(overfull, "range", "left").withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn(
        "slice", F.pmod(document, "slices"))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Which lines of which documents go, as sparse bitmaps.

    A key of at least ``min_chars`` code points that at least ``min_docs`` documents hold
    keeps its lines in the largest document id holding it alone. Returns, for documents that
    lose a line: ``id``, ``version`` (a hash of the text), and ``gone``, an array of (word,
    bits) in which bit i of word w is line 64 w + i. A word that is absent keeps its lines,
    so the bitmap is as short as what is dropped.

    The hashes of all lines are written once and partitioned by ranges, sorted within them by
    hash, document (largest first) and position. Windows over that order, which need no
    further exchange, stream the first occurrence of each hash and of each document in it. A
    range that a hot line overfills is dealt in slices of its documents, and one carried row
    for each hash and slice tells the slices what the others hold. The bitmaps come from hash
    aggregates: the bits of a word are combined by ``bit_or``.

    Rows that repeat an id are one document, with one bitmap for each different text. Rows
    without id are one document for each different text, and never the largest.
    """
    entries = saved(
        docs.select(F.col(key).alias("id"), F.xxhash64(text_or_empty(text)).alias("version"),
                    F.posexplode(line_keys(text)).alias("pos", "line"))
        .where(F.char_length("line") >= min_chars).select("id", "version", "pos", *_hashed("line")), "lines")
    place, order = ["range", "slice", "h1", "h2"], [F.col("id").desc_nulls_last(), F.col("version"), F.col("pos")]
    line = Window.partitionBy(*place)
    occurrences = line.orderBy(*order)
    before = lambda name: F.lag(name).over(occurrences)
    same = before("id").eqNullSafe(F.col("id")) & (F.col("id").isNotNull() | (before("version") == F.col("version")))
    streamed = (
        _in_ranges(entries).repartitionByRange("range", "slice").sortWithinPartitions(*place, *order)
        .withColumns({"head": before("pos").isNull(), "new": F.coalesce(~same, F.lit(True)).cast("int"),
                      "leader": F.first("id").over(occurrences)})
        .withColumn("held", F.sum("new").over(line))
    )
    goes = ~F.col("id").eqNullSafe(F.col("leader"))
    known = saved(streamed.where((F.col("slices") > 1) | (F.col("held") >= min_docs) & goes).drop("new"), "occurrences")
    heads = known.where("slices > 1 AND head")
    totals = heads.groupBy("h1", "h2").agg(F.sum("held").alias("held"), F.max("leader").alias("leader")).where(
        F.col("held") >= min_docs)
    told = heads.select("h1", "h2", "slice").join(totals.select("h1", "h2", "leader"), ["h1", "h2"])
    sliced = known.where("slices > 1").drop("leader").join(told, ["h1", "h2", "slice"]).where(goes)
    gone = known.where("slices = 1").select("id", "version", "pos").unionByName(sliced.select("id", "version", "pos"))
    return (
        gone.select("id", "version", F.expr("pos div 64").cast("int").alias("word"),
                    F.expr("shiftleft(1L, cast(pos % 64 as int))").alias("bit"))
        .groupBy("id", "version", "word").agg(F.bit_or("bit").alias("bits"))
        .groupBy("id", "version").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("gone"))
    )


def with_kept_lines(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text",
                    names: tuple[str, str, str] = ("lines", "n_lines", "n_dropped")) -> DataFrame:
    """The documents with their kept lines in order, the number of their lines and of those
    dropped, under the given names; columns of these names are replaced."""
    own, version, at, gone, by_word, every = (
        fresh(n) for n in ("own", "version", "id", "gone", "words", "lines"))
    marks = bitmaps.select(F.col("id").alias(at), F.col("version").alias(version), F.col("gone").alias(gone))
    joined = docs.withColumn(own, F.xxhash64(text_or_empty(text))).join(
        marks, (F.col(own) == F.col(version)) & F.col(key).eqNullSafe(F.col(at)), "left")
    held = joined.withColumn(by_word, F.map_from_entries(gone)).withColumn(every, lines_of(text))
    zero = F.lit(0).cast("bigint")
    bits = lambda i: F.coalesce(F.try_element_at(by_word, F.floor(i / 64).cast("int")), zero)
    kept = F.when(F.col(gone).isNull(), F.col(every)).otherwise(F.filter(
        every, lambda line, i: F.getbit(bits(i), (i % 64).cast("int")) == 0))
    dropped = F.coalesce(F.aggregate(gone, zero, lambda n, w: n + F.bit_count(w["bits"])), zero)
    return held.select(
        *[c for c in docs.columns if c not in names], kept.alias(names[0]),
        F.size(every).cast("bigint").alias(names[1]), dropped.alias(names[2]))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat across documents, dropped but in the largest doc_id holding them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_kept_lines(docs, keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.concat_ws("\n", "lines").cast("binary"), 256).alias("kept_sha256"),
    )


QUERY = op9_line_dedup
SQL = r"""
WITH split_lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, p.pos, parts[p.pos] AS line,
         translate(regexp_replace(parts[p.pos], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split_lines, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS pos) p
), repeated AS (
  SELECT key, max(doc_id) AS leader FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE r.key IS NOT NULL AND doc_id <> leader) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
              FILTER (WHERE r.key IS NULL OR doc_id = leader), '')) AS kept_sha256
FROM lines LEFT JOIN repeated r USING (key)
GROUP BY doc_id
"""
