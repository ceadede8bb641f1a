"""Quality rules: hashed n-gram log-likelihood ratio between trusted and raw text.

Two multinomials over the same hashed features are estimated from all rows: the
target from the documents a caller trusts, the raw one from every document. A
document's score is the sum of ``ln p_target - ln p_raw`` over its features,
divided by their number, and every document is held against one fixed threshold:
no sampling, so a run always gives the same verdict.

Features are the n-grams of the whole text: each word, each pair of neighbouring
words, and the ending of each word (its last ``n`` characters), as a back-off for
rare words. Each kind is hashed into ``buckets`` counters of its own, so frequent
endings are not blurred by rare pairs. Weights are whole millionths, so sums do not
depend on their order.

All work is native: one shuffle of the texts to flag the trusted ones, counters
combined before their shuffle (at most ``3 * buckets`` rows), and a scoring pass that
is a projection per row. The weights brought to the driver are ``3 * buckets`` numbers.

Defined cases: a null text is an empty one; no word fails the base rules; without
any trusted text all weights are zero and only the base rules decide; repeated
rows and ids are judged row by row; other columns may have any name.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
BUCKETS = 16384
NGRAM = 3
THRESHOLD = -0.25
#: Positions fit into this many bits of a sort key; longer texts sort pairs instead.
_POSITION_BITS = 20
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def words_of(text: Column) -> Column:
    """Runs of signs other than ASCII white space; the only empty pieces of the split are at its ends."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def buckets_of(words: Column, word: Column, i: Column, buckets: int, n: int) -> list[Column]:
    """Buckets of the word at ``i``, of its ending (the whole word where it is shorter) and of its pair with the word before (null for the first)."""
    def kind(k: int, *parts: Column) -> Column:
        return (F.pmod(F.xxhash64(*parts), F.lit(buckets)) + k * buckets).cast("int")

    return [kind(0, word), kind(1, F.right(word, F.lit(n))), F.when(i > 0, kind(2, F.get(words, i - 1), word))]


def ratio_weights(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, n: int = NGRAM, smoothing: float = 1.0) -> list[int]:
    """Weight of every bucket in millionths of a nat, from all rows of ``docs``."""
    flags = trusted.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().withColumn("_trusted", F.lit(1))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    words = texts.join(flags.hint("shuffle_merge"), "_id", "left").select("_trusted", words_of(F.col("_text")).alias("_words"))  # the same plan at every size
    features = F.flatten(F.transform("_words", lambda w, i: F.array(*buckets_of(F.col("_words"), w, i, buckets, n))))
    counts = words.select("_trusted", features.alias("_features")).select("_trusted", F.explode_outer("_features").alias("bucket"))
    counts = counts.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_trusted").alias("target")).collect()  # at most 3 * buckets + 1 rows
    counts = [r for r in counts if r["bucket"] is not None]
    raw_all, target_all = sum(r["raw"] for r in counts), sum(r["target"] for r in counts)
    weights = [0] * (3 * buckets)
    if not target_all:
        return weights
    # buckets that no document reaches have no share of the smoothing, else it would outweigh a small target
    base = math.log(target_all + smoothing * len(counts)) - math.log(raw_all + smoothing * len(counts))
    for r in counts:
        weights[r["bucket"]] = round(1e6 * (math.log(r["target"] + smoothing) - math.log(r["raw"] + smoothing) - base))
    return weights


def _repeat_words(texts: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``_words``: words inside three-word windows found at least twice.

    Window hashes are sorted together with their positions, so equal windows are neighbours.
    """
    hashes = F.transform(F.slice("_words", 3, F.greatest(F.size("_words") - 2, F.lit(0))), lambda w, i: F.xxhash64(F.get(F.col("_words"), i), F.get(F.col("_words"), i + 1), w))
    texts = texts.withColumn("_windows", hashes)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    short = F.size("_windows") <= F.lit(_POSITION_MASK)
    keys = F.transform("_windows", lambda h, i: h.bitwiseAND(F.lit(~_POSITION_MASK)).bitwiseOR(i.cast("bigint")))
    texts = texts.withColumn("_keys", F.when(repeats & short, F.sort_array(keys))).withColumn(
        "_pairs", F.when(~short, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def position(key: Column) -> Column:
        return key.bitwiseAND(F.lit(_POSITION_MASK)).cast("int")

    def same(key: Column, j: Column) -> Column:
        other = F.get(F.col("_keys"), j)
        return other.isNotNull() & (F.shiftright(key, _POSITION_BITS) == F.shiftright(other, _POSITION_BITS)) & (
            F.get(F.col("_windows"), position(key)) == F.get(F.col("_windows"), position(other)))

    found = F.transform(F.filter("_keys", lambda k, j: same(k, j - 1) | same(k, j + 1)), position)
    found_long = F.transform(
        F.filter("_pairs", lambda p, j: F.coalesce(F.get(F.col("_pairs"), j - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(F.col("_pairs"), j + 1)["h"] == p["h"], F.lit(False))),
        lambda p: p["i"])
    texts = texts.withColumn("_found", F.coalesce(found, found_long, F.array().cast("array<int>")))
    covered = F.array_distinct(F.flatten(F.transform("_found", lambda i: F.array(i, i + 1, i + 2))))
    return texts.withColumn("n_repeat_words", F.when(F.size("_found") > 0, F.size(covered)).otherwise(0).cast("bigint"))


def _judged(docs: DataFrame, weights: list[int], text_col: str, n: int, threshold: float) -> DataFrame:
    """``row`` (all columns of the document as one struct) with counts, score and verdict."""
    # a literal of fixed length; folded once by the optimizer
    table = F.from_json(F.lit(json.dumps(weights)), "array<bigint>")
    buckets = len(weights) // 3
    text = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))

    def weight(word: Column, i: Column) -> Column:
        return sum((F.coalesce(F.get(table, b), F.lit(0)) for b in buckets_of(F.col("_words"), word, i, buckets, n)), F.lit(0).cast("bigint"))

    out = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("_text"))
    out = out.select(
        "row", words_of(text).alias("_words"), lines.alias("_lines"),
        (F.size(F.split(text, SYMBOL, -1)) - 1).cast("bigint").alias("n_symbols"),
    )
    out = _repeat_words(out)
    out = out.select(
        "row",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"), "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        F.aggregate(F.transform("_words", weight), F.lit(0).cast("bigint"), lambda a, w: a + w).alias("ratio_millionths"),
    )
    out = out.withColumn("_features", F.greatest(3 * F.col("n_words") - 1, F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    limit = round(threshold * 1e6)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("ratio_millionths") >= F.lit(limit).cast("bigint") * F.col("_features"))).withColumn(
        "ratio_score", F.when(F.col("_features") > 0, F.col("ratio_millionths") / (1e6 * F.col("_features"))).otherwise(0.0))


def judge_documents(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, n: int = NGRAM, smoothing: float = 1.0, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, counts of the base rules, ``ratio_score`` and the verdict ``kept``.

    ``trusted`` names the documents of the target multinomial by ``id_col``.
    """
    weights = ratio_weights(docs, trusted, id_col=id_col, text_col=text_col, buckets=buckets, n=n, smoothing=smoothing)
    return _judged(docs, weights, text_col, n, threshold).select(
        F.col("row")[id_col].alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio_score", "base_failed", "kept")


def keep_documents(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, n: int = NGRAM, smoothing: float = 1.0, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with all their columns."""
    weights = ratio_weights(docs, trusted, id_col=id_col, text_col=text_col, buckets=buckets, n=n, smoothing=smoothing)
    # a filter on a plain projection would be pushed into it and compute the verdict's lists again for every word
    judged = _judged(docs, weights, text_col, n, threshold).select("row", "kept", F.spark_partition_id().alias("_barrier"))
    return judged.where("kept and _barrier >= 0").select("row.*")
