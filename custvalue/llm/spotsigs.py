"""SpotSigs document fingerprints, in DataFrame functions only.

Wherever a common word (an anchor) stands, the next two content words are
chained to it: ``anchor:word:word``, with further common words in between
skipped.  The set of these spot signatures is the fingerprint of the text: it
survives edits around the running text and ignores everything without common
words.  Sets are compared by Jaccard likeness, which is at most the ratio of
their sizes: sets in length partitions further apart than the floor allows are
not intersected (pruned).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import text_key, written

# Frequent function words of English, French, German and Spanish.
COMMON_WORDS = (
    "a all an and are as at be been but by for from had has have he her his i in is it its not of on or she so "
    "that the their them then there they this to was we were which will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour "
    "que qui sa se ses son sur un une vous "
    "als am an auch auf aus bei das dem den der des die ein eine einen einer er es haben hat ich ihr im ist mit "
    "nach nicht noch oder sich sie sind um und von vor war werden wie wir zu zum zur "
    "al como con del el ella en era es esta este fue ha hay la las lo los mas me mi muy no nos o para pero por "
    "porque se sin sobre su sus te una uno y ya yo"
).split()
_MARK, _NEXT = "\x01", "\x02"


def _hash(*parts: Column) -> Column:
    """Upper half of XXH64 as an int."""
    return F.shiftright(F.xxhash64(*parts), 32).cast("int")


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with a column ``name``: the sorted distinct signature hashes (array<int>) of a whole text.

    A text without any spot has the one signature of its letters as a whole, so
    that equal texts always have equal, non-empty sets.  The steps are columns of
    their own, so that none is computed twice.
    """
    common = "|".join(sorted(set(COMMON_WORDS)))
    # an anchor is tied to what follows it; the last piece of a unit is its content word
    df = (df.withColumn("__plain", F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")))
          .withColumn("__units", F.split(F.trim(F.regexp_replace(
              F.concat(F.lit(" "), F.col("__plain"), F.lit(" ")), rf"(?<= )({common}) ", rf"$1{_MARK}")), " ")))
    links = F.zip_with(F.slice("__units", F.lit(1), F.size("__units") - 1), F.slice("__units", F.lit(2), F.size("__units")),
                       lambda unit, after: F.concat(unit, F.lit(_NEXT), F.substring_index(after, _MARK, -1)))
    df = df.withColumn("__links", F.filter(links, lambda link: F.contains(link, F.lit(_MARK)) & ~F.endswith(link, F.lit(_NEXT))))
    # each link reads anchor, ..., anchor, word, next word
    chains = F.transform("__links", lambda link: F.transform(
        F.slice(F.split(link, _MARK), F.lit(1), F.size(F.split(link, _MARK)) - 1),
        lambda anchor: _hash(anchor, F.substring_index(link, _MARK, -1))))
    df = df.withColumn("__spots", F.array_sort(F.array_distinct(F.flatten(chains))))
    return (df.withColumn(name, F.when(F.size("__spots") > 0, F.col("__spots")).otherwise(F.array(_hash(F.col("__plain")))))
            .drop("__plain", "__units", "__links", "__spots"))


def fingerprint(signatures: Column) -> Column:
    """Digest of a signature set (32 hex digits)."""
    return F.md5(F.array_join(signatures.cast("array<string>"), ",").cast("binary"))


def length_partition(signatures: Column, like: float) -> Column:
    """Number of the set's length partition: sets with a likeness of ``like`` or
    more are in the same or in neighbouring partitions."""
    return F.floor(F.ln(F.greatest(F.size(signatures), F.lit(1))) / -F.ln(F.lit(like))).cast("int")


def pruned_jaccard(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; 0 without an intersection if their
    sizes rule out a likeness of ``floor``."""
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (F.size(a) + F.size(b) - shared)
    if floor <= 0:
        return exact
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    apart = F.abs(length_partition(a, floor) - length_partition(b, floor)) > 1
    return F.when(apart | (small < floor * large), 0.0).otherwise(exact)


def _row_key(docs: DataFrame) -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text_key(F.col("text")))


def successors(docs: DataFrame, rows_per_part: int = 50_000) -> DataFrame:
    """(row, next_row, half): the next document in descending doc_id, the first after the last.

    The order is over distinct (doc_id, text), null ids last and ties by text
    key.  Ids are range-partitioned and numbered by part; no single task sees
    all of them.
    """
    slim = written(docs.select(_row_key(docs).alias("row"), "doc_id",
                               F.floor(F.length(F.coalesce("text", F.lit(""))) / 2).cast("int").alias("half"))
                   .groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("half").alias("half")), "spot-rows")
    total = slim.count()
    parts = max(1, -(-total // rows_per_part))
    placed = written(slim.repartitionByRange(parts, F.col("doc_id").desc_nulls_last(), F.col("row"))
                     .withColumn("part", F.spark_partition_id()), "spot-order")
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    starts = counts.withColumn("first", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")   # one row per part
    within = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), "row")
    ranked = written(placed.withColumn("k", F.row_number().over(within)).join(starts, "part")
                     .select("row", "half", (F.col("first") + F.col("k") - 1).alias("at")), "spot-ranks")
    after = ranked.select(F.col("row").alias("next_row"), F.pmod(F.col("at") - 1, F.lit(max(total, 1))).alias("at"))
    return ranked.join(after, "at").select("row", "next_row", "half")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures, next_doc_id``.

    The edited text has its last half of code points replaced by the start of
    the next document's text.  Null texts count as empty.  Rows equal in doc_id
    and text have one place in the order and equal results; a lone document is
    its own successor.  An empty table gives an empty result; further columns
    are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", _row_key(docs).alias("row"), text.alias("text"))
    order = written(successors(docs), "spot-next")
    follow = order.select(F.col("next_row").alias("row"), F.col("row").alias("before"), "half")
    # both joins read the same three columns of ``base``, so the texts are shuffled once
    heads = (with_signatures(base.join(follow, "row"), "text", "next_sigs")
             .select(F.col("before").alias("row"), F.left("text", F.col("half")).alias("head"), "next_sigs",
                     F.col("doc_id").alias("next_doc_id"))
             .dropDuplicates(["row"]))
    whole = base.join(heads, "row").withColumn("n_chars", F.length("text").cast("bigint"))
    whole = whole.withColumn("edited", F.concat(
        F.left("text", (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")), F.col("head"))).drop("head", "row")
    sets = with_signatures(with_signatures(whole, "text", "sigs"), "edited", "edited_sigs")
    sets = sets.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    return sets.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sigs")).alias("fingerprint"),
                       fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
                       pruned_jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                       pruned_jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
                       F.size("sigs").alias("n_signatures"), "next_doc_id")
