"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text, in column functions only.

A text is cut into sections that end with a line whose last letter is of one half of the alphabet, a section into
paragraphs of 32 to 120 code points that end with a line, a clause or a word of certain last letters. Cuts depend on the text near them, so an edit moves few of them. A paragraph's hash is the SHA-256 of its
text, a section's that of its paragraphs' hashes, the root's that of its sections' hashes. The fingerprint holds
the root, every section and every paragraph, so two of them tell whether the texts are equal, how alike they are and where
they differ; only sections that differ are opened.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Java's and RE2's readings of these patterns agree.
SECTION = r"(?s).*?[a-mA-M0-4\x{80}-\x{10FFFF}][ .!?]?\n|.+"
PARAGRAPH = r"(?s).{32,120}?(?:[.,;:!?ensr][ \t\r\n]|\n)|.{1,120}"
#: Hex digits of a section and of a paragraph in the fingerprint; the root keeps all.
SECTION_DIGITS, PARAGRAPH_DIGITS = 16, 8
#: Texts are dealt by ranges of ids of about this many bytes, or larger ones where there would be too many.
_RANGE_BYTES, _RANGES = 16 << 20, 4096


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), f)[0]


def _pieces(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _present(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def fingerprint(text: Column) -> Column:
    """``root|section:paragraph,paragraph…|section:…`` in hex; null counts as the empty text, which has a root alone."""
    hashes = F.transform(
        _pieces(_present(text), SECTION), lambda s: F.transform(_pieces(s, PARAGRAPH), lambda p: F.sha2(p, 256))
    )
    sections = F.transform(
        hashes,
        lambda leaves: F.struct(
            F.sha2(F.array_join(leaves, ""), 256).alias("hash"),
            F.array_join(F.transform(leaves, lambda h: F.substring(h, 1, PARAGRAPH_DIGITS)), ",").alias("leaves"),
        ),
    )

    def written(tree: Column) -> Column:
        root = F.sha2(F.array_join(F.transform(tree, lambda s: s["hash"]), ""), 256)
        each = F.transform(tree, lambda s: F.concat_ws(":", F.substring(s["hash"], 1, SECTION_DIGITS), s["leaves"]))
        return F.array_join(F.concat(F.array(root), each), "|")

    return _let(sections, written)


def _sections(print_: Column) -> Column:
    return F.filter(F.split(print_, r"\|"), lambda s: F.contains(s, F.lit(":")))


def _leaves(sections: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(sections, lambda s: F.split(F.substring_index(s, ":", -1), ","))))


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are: the share of their paragraphs that both have, 1 for equal roots only.

    Sections that both hold count with all their paragraphs; paragraphs are compared in the others alone, as sets.
    """

    def compared(t: Column) -> Column:
        common = F.aggregate(t["both"], F.lit(0), lambda n, s: n + F.size(F.split(s, ",")))
        shared = common + F.size(F.array_intersect(t["in_a"], t["in_b"]))
        total = 2 * common + F.size(t["in_a"]) + F.size(t["in_b"])
        return F.least(2.0 * shared / total, 1 - 1.0 / total)

    def opened(s: Column) -> Column:
        return F.struct(
            F.array_intersect(s["a"], s["b"]).alias("both"),
            _leaves(F.array_except(s["a"], s["b"])).alias("in_a"),
            _leaves(F.array_except(s["b"], s["a"])).alias("in_b"),
        )

    sections = F.struct(_sections(a).alias("a"), _sections(b).alias("b"))
    return F.when(a == b, 1.0).otherwise(_let(_let(sections, opened), compared))


def edits(pairs: DataFrame, before: str, after: str) -> DataFrame:
    """The paragraphs of text ``after`` that ``before`` has not: the columns of ``pairs`` and ``(section, paragraph, piece)``.

    Numbers count from 0. Only sections that ``before`` lacks are opened. Null counts as the empty text; equal texts, an
    empty ``after`` and an empty table give no rows; repeated rows each give their own.
    """
    old, new = fingerprint(F.col(before)), fingerprint(F.col(after))
    known = pairs.withColumn("_old", _sections(old)).withColumn("_new", _sections(new))
    known = known.withColumn("_leaves", _leaves("_old"))
    section = F.posexplode(F.arrays_zip(_pieces(_present(F.col(after)), SECTION).alias("text"), F.col("_new").alias("hash")))
    opened = known.select(*pairs.columns, "_old", "_leaves", section.alias("section", "_s"))
    opened = opened.filter(~F.array_contains("_old", F.col("_s.hash")))
    leaf = F.posexplode(
        F.arrays_zip(_pieces(F.col("_s.text"), PARAGRAPH).alias("text"), F.split(F.substring_index("_s.hash", ":", -1), ",").alias("hash"))
    )
    found = opened.select(*pairs.columns, "section", "_leaves", leaf.alias("paragraph", "_p"))
    found = found.filter(~F.array_contains("_leaves", F.col("_p.hash")))
    return found.select(*pairs.columns, "section", "paragraph", F.col("_p.text").alias("piece"))


def _beside(texts: DataFrame) -> DataFrame:
    """``texts(doc_id, text)`` without null ids, with ``(next, next_print, fingerprint)`` of the row that follows.

    Rows are dealt once, by ranges of ids of about equal size; the rows of a range's first id go to the range before it
    too, where they follow all others. What the driver sees is two numbers for each range, of which there are at most ``_RANGES``.
    """
    spark = texts.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(n, int((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // _RANGE_BYTES))
    fractions = [i / min(n, _RANGES) for i in range(1, min(n, _RANGES))]
    cuts = texts.agg(F.percentile_approx("doc_id", fractions, 10 * len(fractions) + 10000)).first()[0] or []
    cuts = F.lit(sorted(set(cuts))).cast("array<bigint>")
    ranged = texts.withColumn("range", F.size(F.filter(cuts, lambda c: c <= F.col("doc_id"))))
    firsts = sorted(tuple(r) for r in ranged.groupBy("range").agg(F.min("doc_id")).collect())
    if not firsts:
        firsts = [(0, None)]
    first, before = [None] * (firsts[-1][0] + 1), [0] * (firsts[-1][0] + 1)
    for i, (place, least) in enumerate(firsts):
        first[place], before[place] = least, firsts[i - 1][0]
    known = F.lit([x if x is not None else firsts[0][1] or 0 for x in first]).cast("array<bigint>")
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(F.lit(before).cast("array<int>"), F.col("range")).alias("range"), F.lit(True).alias("guest"))
    dealt = F.when(F.col("doc_id") == F.get(known, F.col("range")), F.array(own, guest)).otherwise(F.array(own))
    rows = ranged.select("doc_id", "text", F.inline(dealt)).repartition("range")
    rows = rows.withColumn("fingerprint", fingerprint(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "text")
    rows = rows.withColumn("next", F.lead("text").over(order)).withColumn("next_print", F.lead("fingerprint").over(order))
    return rows.filter(~F.col("guest")).drop("guest", "range")


def edited_report(docs: DataFrame) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its fingerprint, that of its edited text, and both likenesses.

    The edited text has the last quarter (rounded down) of the code points replaced by the first as many, or all, of the
    next document: the next row by id and, where ids are equal, by text. After the last comes the first, and a single row
    follows itself. A row without an id has no next document: its last quarter is dropped and ``near_next`` is 0. Null is
    the empty text. An empty table gives an empty one, and other columns are not read.

    The only shuffle carries the texts, once.
    """
    texts = docs.select(F.col("doc_id").cast("long"), _present(F.col("text")).alias("text"))
    alone = texts.filter(F.col("doc_id").isNull()).withColumn("fingerprint", fingerprint(F.col("text")))
    alone = alone.select("*", F.lit("").alias("next"), F.lit(None).cast("string").alias("next_print"))
    whole = _beside(texts.filter(F.col("doc_id").isNotNull())).unionByName(alone)
    whole = whole.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next"), F.lit(1), cut)
    )
    whole = whole.withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return whole.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("next_print")), F.lit(0.0)).alias("near_next"),
    )


#: The same report in SQL, over whole tables with unique, non-null ids.
SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), following AS (
  SELECT doc_id, text, n, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS next FROM docs
), texts AS (
  SELECT doc_id, n, text, next, substr(text, 1, n - n // 4) || substr(next, 1, n // 4) AS edited FROM following
), hashed AS (
  SELECT t, list_transform(regexp_extract_all(t, '{SECTION}'), lambda s: list_transform(regexp_extract_all(s, '{PARAGRAPH}'), lambda p: sha256(p))) AS h
  FROM (SELECT DISTINCT unnest([text, next, edited]) AS t FROM texts)
), trees AS (
  SELECT t, list_transform(h, lambda x: substr(sha256(array_to_string(x, '')), 1, {SECTION_DIGITS}) || ':'
      || array_to_string(list_transform(x, lambda p: substr(p, 1, {PARAGRAPH_DIGITS})), ',')) AS sections,
    array_to_string(list_prepend(sha256(coalesce(array_to_string(list_transform(h, lambda x: sha256(array_to_string(x, ''))), ''), '')),
      list_transform(h, lambda x: substr(sha256(array_to_string(x, '')), 1, {SECTION_DIGITS}) || ':'
      || array_to_string(list_transform(x, lambda p: substr(p, 1, {PARAGRAPH_DIGITS})), ','))), '|') AS tree
  FROM hashed
), opened AS (
  SELECT a.t AS a, b.t AS b, list_filter(list_distinct(a.sections), lambda s: list_contains(b.sections, s)) AS same,
    list_distinct(flatten(list_transform(list_filter(a.sections, lambda s: NOT list_contains(b.sections, s)), lambda s: string_split(split_part(s, ':', 2), ',')))) AS in_a,
    list_distinct(flatten(list_transform(list_filter(b.sections, lambda s: NOT list_contains(a.sections, s)), lambda s: string_split(split_part(s, ':', 2), ',')))) AS in_b
  FROM (SELECT text AS x, edited AS y FROM texts UNION SELECT text, next FROM texts) JOIN trees a ON a.t = x JOIN trees b ON b.t = y
), counted AS (
  SELECT a, b, coalesce(list_sum(list_transform(same, lambda s: len(string_split(s, ',')))), 0)::BIGINT AS common,
    len(list_intersect(in_a, in_b)) AS shared, len(in_a) + len(in_b) AS apart
  FROM opened
), near AS (
  SELECT a, b, CASE WHEN a = b THEN 1.0::DOUBLE
    ELSE least(2.0::DOUBLE * (common + shared) / (2 * common + apart), 1 - 1.0::DOUBLE / (2 * common + apart)) END AS likeness
  FROM counted
)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, p.tree AS fingerprint, q.tree AS edited_fingerprint,
  x.likeness AS near_edited, y.likeness AS near_next
FROM texts JOIN trees p ON p.t = text JOIN trees q ON q.t = edited
JOIN near x ON x.a = text AND x.b = edited JOIN near y ON y.a = text AND y.b = next
"""
