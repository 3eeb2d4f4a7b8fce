"""Licence scan by canonical digests, in SQL functions only.

A text's canonical form drops copyright lines, punctuation and case, and spells
equivalent words alike; its SHA-256 is hash-joined to the digests of the known
licence texts and notices. Whole documents are looked up, and, as texts of
their own, their lines.

Defined cases: a null text is empty; a text without a letter or digit is no
licence; equal digests of several licences name the smallest licence id;
repeated rows give one row each; a null id gives a row too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import KNOWN

#: Spellings taken as equal, by replacement in turn.
EQUIVALENT = (
    ("licence", "license"),
    ("isation", "ization"),
    ("ising", "izing"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("non infringement", "noninfringement"),
    ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("http ", "https "),
    (" all rights reserved ", " "),
)
#: A line is a copyright line if its first word is the mark or the word with a year or a placeholder after it.
COPYRIGHT_LINE = r"(?i)(^|\n)[^A-Za-z0-9\n]*(copyright[^A-Za-z0-9\n]*(c[^A-Za-z0-9\n]+)?([0-9]{4}|<)|\(c\)|©)[^\n]*"
OTHER = "[^A-Za-z0-9]+"


def canonical(text: Column) -> Column:
    """The canonical form: words in lower case between single blanks, with a blank at either end."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "\n")
    out = F.lower(F.concat(F.lit(" "), F.regexp_replace(out, OTHER, " "), F.lit(" ")))
    out = F.replace(out, F.lit("  "), F.lit(" "))
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, known: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``digest, license_id`` of the known texts (a table of fixed size)."""
    rows = [F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, texts in (known or KNOWN).items() for text in texts]
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return table.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: dict[str, tuple[str, ...]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, canonical_sha256, license_id`` of the whole text, and ``line_licenses`` of its lines."""
    table = {r["digest"]: r["license_id"] for r in known_digests(docs.sparkSession, known).collect()}
    # the table is as large as the list of known licences, so it is a literal map and needs no join of the lines
    names = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    whole = base.withColumn("canonical_sha256", digest(F.col("text")))
    known_rows = known_digests(docs.sparkSession, known).withColumnRenamed("digest", "canonical_sha256")
    whole = whole.join(F.broadcast(known_rows), "canonical_sha256", "left")
    found = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.try_element_at(names, digest(line)))
    return whole.select("doc_id", "canonical_sha256", "license_id", F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ",").alias("line_licenses"))
