"""Document fingerprints from spot signatures.

Every occurrence of a common word is an anchor; with the chain of the next
content words it forms a signature.  A document's fingerprint is the set of its
signatures, so it rests on running text and not on lists or navigation.  Sets
are partitioned by length: sets whose partitions lie apart cannot be alike, and
their Jaccard likeness needs no intersection.

All of it is built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strata.llm.common import null_as_empty

CHAIN = 2                # content words after an anchor
REACH = 4                # stretches between anchors that a chain may span
BLOCK_ROWS = 4096        # neighbouring documents that one task orders

# Common words that serve as anchors.
ANCHORS = {
    "en": "the and of to in is that it for on was with as be by are at this from",
    "de": "der die das und den von mit zu sich auf für ist nicht ein eine",
    "fr": "le la les de des et que qui pour dans un une est sur par",
    "es": "el los las y en una por con para se no del",
}


def _pattern() -> str:
    """A space and an anchor before a space or the end; alternatives share first letters."""
    heads: dict[str, list[str]] = {}
    for w in sorted({w for words in ANCHORS.values() for w in words.split()}):
        heads.setdefault(w[0], []).append(w[1:])
    return " (" + "|".join(f"{c}(?:{'|'.join(sorted(rest, reverse=True))})" for c, rest in sorted(heads.items())) + ")(?= |$)"


ANCHOR = _pattern()


def signatures(text: Column) -> Column:
    """Sorted distinct 32-bit signatures (as longs) of a text.  A text with words
    but without anchors has one signature, that of all its words; a null text or
    one without words has none."""
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")))
    stretches = F.transform(F.split(words, ANCHOR, -1), lambda s: F.substring_index(s, " ", CHAIN + 1))
    anchors = F.regexp_extract_all(words, F.lit(ANCHOR), F.lit(1))
    spot = F.struct(stretches.alias("s"), anchors.alias("a"))
    # one evaluation of the two arrays for all anchors
    sets = F.transform(F.array(spot), lambda x: F.transform(x["a"], lambda a, i: _signature(F.concat(
        a, F.substring_index(F.concat_ws("", *[F.get(x["s"], i + k) for k in range(1, REACH + 1)]), " ", CHAIN + 1)))))[0]
    whole = F.when(words == " ", F.array().cast("array<long>")).otherwise(F.array(_signature(F.concat(F.lit(":"), words))))
    return F.array_sort(F.array_distinct(F.when(F.size(sets) > 0, sets).otherwise(whole)))


def _signature(c: Column) -> Column:
    return F.xxhash64(c).bitwiseAND(F.lit(0xFFFFFFFF))


def fingerprint(sigs: Column) -> Column:
    """The set as text, eight hexadecimal digits a signature."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def length_partition(sigs: Column, threshold: float) -> Column:
    """Sets with a Jaccard of at least ``threshold`` are in the same or in
    adjacent partitions; empty sets are in partition -1."""
    return F.when(F.size(sigs) == 0, F.lit(-1)).otherwise(
        F.floor(F.log(F.size(sigs).cast("double")) / math.log(1 / threshold) + 1e-9)).cast("int")


def jaccard(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Likeness of two sets, 1 for two empty ones; below ``threshold`` it may be
    given as 0, which spares the intersection where lengths alone rule it out."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = F.when(large == 0, F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))
    if threshold:
        apart = F.abs(length_partition(a, threshold) - length_partition(b, threshold)) > 1
        exact = F.when(apart | (small < large * threshold), F.lit(0.0)).otherwise(exact)
    # disjoint ranges of sorted sets need no intersection either
    disjoint = (F.element_at(a, -1) < F.element_at(b, 1)) | (F.element_at(b, -1) < F.element_at(a, 1))
    return F.when((small == 0) & (large > 0), F.lit(0.0)).when(
        (small > 0) & F.when(small > 0, disjoint), F.lit(0.0)).otherwise(exact)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, sigs, next_text, next_sigs: each document beside the next one by
    descending id (nulls last, equal ids by text); the last is followed by the
    first.  Ids are cut into blocks of about BLOCK_ROWS rows, each ordered by a
    task; only a block's last row looks up the head of the next."""
    d = docs.select(F.col(id_col).alias("id"), null_as_empty(text_col).alias("text"))
    low, high, n = d.agg(F.min("id"), F.max("id"), F.count("id")).first()
    width = max(1, -(-(high - low + 1) * BLOCK_ROWS // n)) if n else 1
    block = F.coalesce(F.floor((F.lit(high or 0) - F.col("id")) / width), F.lit(1 << 62)).cast("long")
    d = d.withColumn("block", block)
    order = W.partitionBy("block").orderBy(F.col("id").desc_nulls_last(), "text")
    d = d.withColumn("next_text", F.lead("text").over(order)).withColumn("sigs", signatures(F.col("text")))
    d = d.withColumn("next_sigs", F.lead("sigs").over(order))

    # heads: one row per block of BLOCK_ROWS documents, ids only
    heads = docs.select(F.col(id_col).alias("id")).withColumn("block", block).groupBy("block").agg(F.max("id").alias("id"))
    along = W.orderBy("block")
    first = heads.agg(F.min("block").alias("b")).select(F.col("b").alias("first"))
    after = (heads.select("block", F.lead("block").over(along).alias("after")).crossJoin(first)
             .select("block", F.coalesce("after", "first").alias("after")))
    head_text = (docs.select(F.col(id_col).alias("hid"), null_as_empty(text_col).alias("text"))
                 .join(heads.select(F.col("id").alias("hid2"), F.col("block").alias("after")),
                       F.col("hid").eqNullSafe(F.col("hid2"))).groupBy("after").agg(F.min("text").alias("head_text")))
    link = after.join(head_text, "after").select(
        F.col("block").alias("of"), "head_text", signatures(F.col("head_text")).alias("head_sigs"))
    # one pass over the documents: only a block's last row meets its link
    return d.join(link, (F.col("block") == F.col("of")) & F.col("next_text").isNull(), "left").select(
        "id", "text", "sigs", F.coalesce("next_text", "head_text").alias("next_text"),
        F.coalesce("next_sigs", "head_sigs").alias("next_sigs"))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited (text), fingerprint, edited_fingerprint,
    near_edited, near_next, length_partition.

    The edited text has its last floor(n / 2) code points replaced by the first as
    many of the next document (fewer if it has fewer).  Null texts are empty; an
    empty text has an empty fingerprint, and two empty ones are alike (1.0);
    repeated rows follow each other; other columns are ignored; an empty table
    gives no rows, and a single document is its own next."""
    d = with_next(docs, id_col, text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    d = d.select("id", n.cast("long").alias("n_chars"), "sigs", "next_sigs",
                 F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                          F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    d = d.withColumn("edited_sigs", signatures(F.col("edited")))
    return d.select(F.col("id").alias(id_col), "n_chars", "edited", fingerprint(F.col("sigs")).alias("fingerprint"),
                    fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
                    jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                    jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
                    length_partition(F.col("sigs"), 0.75).alias("length_partition"))
