"""License scans by canonical digest lookup. DataFrame functions only.

A text is brought to one form: lower case, copyright lines dropped, punctuation and white space one space, equivalent
spellings the same. Its digest is looked up in the digests of known licences: a text matches as a whole or not at
all. The same lookup serves single lines against known notices; lines without the letters "licen" cannot be one, as
no notice is without them, and are not cut out.

The side of known digests is a table of the caller; Spark broadcasts it below its own size limit and shuffles it
otherwise. Digests are unique after grouping, so no document gains rows, and a text that a third of all documents
share is a stream-side key of a join that adaptive execution may split.

Defined results: a null text has no digest and no licence; an empty text, or one of copyright lines alone, has the
digest of "" and no licence; an empty table gives an empty table; rows with the same doc_id are told apart by their
text, so repeated rows come back as often as they went in; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.llm.common import only
from evenhand.llm.license_texts import NOTICES, TEXTS

#: A line that names a holder and not a condition: it starts with the mark and has a year or a second mark.
COPYRIGHT_LINE = r"(?m)^[ \t/*#;-]*((copyright|©|\(c\))[^\n]*([0-9]{4}|\(c\)|©)[^\n]*|all rights reserved\.?[ \t]*)$"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F‐-―‘-‟«»©®™]+"

#: Equivalent spellings, in canonical (lower case, single-spaced) text. Words end at a space or at the end.
SPELLINGS = [
    (r"licenc", "licens"),
    (r"([a-z]{3})is(e|ed|es|ing|ation|ations|er|ers)( |$)", r"$1iz$2$3"),
    (r"([a-z]{2})our(s|ed|ing|able|ite|)( |$)", r"$1or$2$3"),
    (r"acknowledgement", "acknowledgment"),
    (r"([a-z]{2}[aeiou])ll(ed|ing|er)( |$)", r"$1l$2$3"),
    (r"(^| )non commercial", r"$1noncommercial"),
    (r"(^| )sub licens", r"$1sublicens"),
    (r"https", "http"),
]
NOTICE_MARK = "licen"


def canonical(text: Column) -> Column:
    """The form whose digest is compared. Works on whole texts and on lines."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    out = F.trim(F.regexp_replace(out, NOT_WORD, " "))
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """A table (digest, licence), one row per digest, from (licence, text) rows."""
    table = spark.createDataFrame(rows, "licence string, text string")
    return table.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, texts: DataFrame | None = None, notices: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, digest, licence of the whole text, n_notices and notices (names, sorted, by comma)."""
    spark = docs.sparkSession
    texts = known(spark, TEXTS) if texts is None else texts
    notices = known(spark, NOTICES) if notices is None else notices
    lines = F.filter(
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda line: F.contains(F.lower(line), F.lit(NOTICE_MARK))
    )
    # Rows are named by their id and the digest of the raw text: equal rows have equal notices.
    rows = only(docs, doc_id="doc_id", text="text").select(
        "doc_id", F.sha2("text", 256).alias("raw"), digest(F.col("text")).alias("digest"), lines.alias("lines")
    )
    named = notices.select(F.col("digest").alias("line_digest"), F.col("licence").alias("notice"))
    found = (
        rows.filter(F.size("lines") > 0)
        .select("doc_id", "raw", F.posexplode("lines").alias("place", "line"))
        .withColumn("line_digest", digest(F.col("line")))
        .join(named, "line_digest")
        .groupBy("doc_id", "raw")
        .agg(
            F.count_distinct("place").alias("n_notices"),
            F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("notices"),
        )
        .select(F.col("doc_id").alias("found_id"), F.col("raw").alias("found_raw"), "n_notices", "notices")
    )
    whole = rows.drop("lines").join(texts, "digest", "left")
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("raw") == F.col("found_raw"))
    return whole.join(found, same, "left").select(
        "doc_id", "digest", "licence", F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"), "notices"
    )
