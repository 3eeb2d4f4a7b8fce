"""Quality rules: base counts and a hashed n-gram likelihood ratio, in SQL functions only.

Two multinomials over hashed word 1-grams and 2-grams are counted: one over the
trusted target documents, one over the raw corpus (every document). A document
scores the mean log-ratio of its n-grams and is kept when that mean reaches
``threshold``; the same text always gets the same verdict. Both counts cover
all documents; the table of ratios has ``buckets`` entries whatever the input.

Everything here is DataFrame functions; nothing runs in Python on executors.

Defined cases: a null text has no words and no lines; a text with under
``MIN_WORDS`` words, or one whose repeated windows cover over half of its
words, fails the base rules and isn't kept; without trusted documents every
ratio is 0 and the base rules decide alone; a repeated or null id counts as
often as it occurs; n-grams never cross documents. Repeated windows are told
apart by a 64-bit hash inside one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BLANK_RUN))


def _word(i: Column) -> Column:
    return F.get(F.col("__w"), i)


def with_base_counts(docs: DataFrame, text: Column) -> DataFrame:
    """Add ``__w`` (words) and the five base counts and ``base_failed``."""
    df = docs.withColumn("__text", F.coalesce(text, F.lit(""))).withColumn("__w", words_of(F.col("__text")))
    df = df.withColumn("n_words", F.size("__w").cast("long"))
    lines = F.filter(F.split("__text", "\n"), lambda line: F.btrim(line, F.lit(_BLANKS)) != "")
    df = df.withColumn("__lines", lines)
    three = F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.xxhash64(_word(i), _word(i + 1), _word(i + 2)))
    df = df.withColumn("__h", F.when(F.size("__w") >= 3, three).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    ordered = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    df = df.withColumn("__s", F.when(repeats, ordered).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))
    s = F.col("__s")
    twice = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i + 1 < F.size(s)) & (F.get(s, i + 1)["h"] == x["h"])))
    df = df.withColumn("__p", F.sort_array(F.transform(twice, lambda x: x["p"])))
    covered = F.aggregate(
        "__p",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"), (p + 3).alias("end")),
        lambda acc: acc["n"],
    )
    df = (
        df.withColumn("word_chars", F.length(F.array_join("__w", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace("__text", "[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("n_repeat_words", covered.cast("long"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .drop("__lines", "__h", "__s", "__p", "__text")
    )
    return df.withColumn("base_failed", F.explode(F.array("base_failed")))


def _grams(buckets: int) -> Column:
    """Buckets of the 1-grams and 2-grams of ``__w``."""
    one = F.transform("__w", lambda w: F.pmod(F.hash(w), F.lit(buckets)))
    two = F.transform(F.sequence(F.lit(0), F.size("__w") - 2), lambda i: F.pmod(F.hash(_word(i), _word(i + 1)), F.lit(buckets)))
    return F.when(F.size("__w") >= 2, F.concat(one, two)).otherwise(one)


def gram_ratios(docs: DataFrame, trusted: DataFrame, buckets: int, smoothing: float, id_col: str, text_col: str) -> DataFrame:
    """One row whose array has log(target share / raw share) of each bucket.

    ``trusted`` is a column of ids. Counts are summed in each task before the
    shuffle, so a task sends at most ``buckets`` rows.
    """
    spark = docs.sparkSession
    good = trusted.toDF("__id").where(F.col("__id").isNotNull()).distinct().withColumn("__good", F.lit(1))
    # labels grow with the corpus, so they are merged at every size and never broadcast
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(good.hint("merge"), "__id", "left")
    grams = own.withColumn("__w", words_of(F.col("__t"))).select("__good", F.explode(_grams(buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("__good").alias("t"), F.count(F.lit(1)).alias("r"))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0, ["t", "r"])
    entries = every.agg(F.sort_array(F.collect_list(F.struct("bucket", "t", "r"))).alias("e"), F.sum("t").alias("nt"), F.sum("r").alias("nr"))
    # a bucket's target share is drawn towards the overall one by ``smoothing`` n-grams, so rare buckets are near neutral
    share = F.col("nt") / F.col("nr")
    ratio = F.transform("e", lambda x: F.log((x["t"] / share + F.lit(smoothing)) / (x["r"] + F.lit(smoothing))))
    return entries.select(F.when(F.col("nt") == 0, F.transform("e", lambda x: F.lit(0.0))).otherwise(ratio).alias("ratios"))


def score(docs: DataFrame, trusted: DataFrame, threshold: float = -0.08, buckets: int = 1 << 14, smoothing: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``llr`` (mean log-ratio an n-gram) and ``kept``."""
    ratios = gram_ratios(docs, trusted, buckets, smoothing, id_col, text_col).scalar()
    df = with_base_counts(docs, F.col(text_col)).withColumn("__g", _grams(buckets)).withColumn("__r", ratios)
    total = F.aggregate("__g", F.lit(0.0), lambda acc, g: acc + F.get(F.col("__r"), g))
    df = df.withColumn("llr", F.when(F.size("__g") > 0, total / F.size("__g")).otherwise(F.lit(0.0)))
    df = df.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop("__w", "__g", "__r")
    # a filter on ``kept`` would else be pushed below, with every step's arrays put into the next one's lambdas
    return df.withColumn("kept", F.explode(F.array("kept")))


def keep_good(docs: DataFrame, trusted: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs`` (own columns) that pass base rules and ratio."""
    text_col, id_col = options.get("text_col", "text"), options.get("id_col", "doc_id")
    narrow = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("__llm_id"), F.col(text_col).alias("__llm_text"))
    rest = {k: v for k, v in options.items() if k not in ("text_col", "id_col")}
    return score(narrow, trusted, id_col="__llm_id", text_col="__llm_text", **rest).where("kept").select("__row.*")
