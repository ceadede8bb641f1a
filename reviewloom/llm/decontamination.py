"""Benchmark decontamination by spaced-seed hashing.

A mask such as ``11010011`` selects token positions inside a short span; the
tokens it selects are hashed at every position of every document and benchmark
item. Equal hashes are hits even where tokens at ignored positions differ. Hits are
reduced to (document, item, diagonal), where the diagonal is the difference of the
two positions, and each diagonal is verified on the real tokens: some window of
``window`` item tokens (the whole item if it is shorter) must agree in at least
``min_share`` of its tokens.

The masks go by the length of the item (``SEEDS``), and together they meet every pattern of agreeing
tokens that verification accepts at the default ``window`` and ``min_share`` (a test enumerates them).
Items of 4 to 7 tokens have a run of four as seed and count only as a whole; items below
4 tokens are too little to tell a leak from chance and are not searched.

Main path: DataFrame functions only. Document hashes never cross the network: they
meet the item hashes in broadcast joins. Item hashes are broadcast in blocks of at
most ``block_tokens`` benchmark tokens (a size that is counted first), so a larger
benchmark means more blocks, never a larger broadcast. Only hits are shuffled, and
texts once for verification, once more for every ``HITS`` hits of a document, so
no row holds more hits than that.

Defined cases: a null or short text (or item) has no hit; a text of any length is searched
whole; other columns may have any name; documents of one id are judged together, those
without id are never reported; repeated rows change nothing; an empty benchmark
finds nothing and keeps all documents.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: (least number of item tokens, masks), longest items first.
SEEDS = (
    (13, ("111011", "1100001011", "110111")),
    (8, ("11101", "100111", "1101001")),
    (4, ("1111",)),
)
#: Items below this number of tokens must agree in all of them.
WHOLE_BELOW = 8
BLOCK_TOKENS = 300_000
HITS = 4096


def tokens_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def mask_hash(tokens: Column, first: Column, i: Column, mask: str, number: int) -> Column:
    """Hash of the tokens that a mask selects from position ``i`` on; ``first`` is the token there. Masks begin with 1."""
    rest = [F.get(tokens, i + k) for k, sign in enumerate(mask) if sign == "1" and k]
    return F.xxhash64(F.lit(number), first, *rest)


def _hashes(tokens: Column, mask: str, number: int) -> Column:
    """Hashes at all positions where the mask fits."""
    heads = F.slice(tokens, 1, F.greatest(F.size(tokens) - (len(mask) - 1), F.lit(0)))
    return F.transform(heads, lambda w, i: mask_hash(tokens, w, i, mask, number))


def _positions(rows: DataFrame, keys: list[str], tokens: str, masks: list[tuple[int, str]]) -> DataFrame:
    """(keys, pos, hash) of all numbered masks; the token list itself is left behind before anything is exploded.

    In the outer form, since Spark derives a filter from the inner one that computes the list again.
    """
    hashes = F.flatten(F.array(*[F.transform(_hashes(F.col(tokens), m, n), lambda h, i: F.struct(i.alias("pos"), h.alias("hash"))) for n, m in masks]))
    return rows.select(*keys, hashes.alias("_h")).select(*keys, F.explode_outer("_h").alias("_h")).select(*keys, F.col("_h.pos").alias("_pos"), F.col("_h.hash").alias("_hash"))


def _verified(near: DataFrame, items: DataFrame, id_col: str, item_col: str, window: int, min_share: float) -> DataFrame:
    """Diagonals on which enough tokens of one window agree. ``_words`` begins where document and item overlap."""
    begin = F.greatest(-F.col("_shift"), F.lit(0))  # first item token of the overlap
    agree = F.filter(F.transform("_words", lambda w, i: F.when(w == F.get(F.col("_tokens"), i + begin), i + begin)), lambda i: i.isNotNull())
    out = near.join(items, "_item").select("_doc", "_item", "_shift", F.size("_tokens").alias("_n"), agree.alias("_agree"), F.spark_partition_id().alias("_barrier"))
    width = F.least(F.lit(window), F.col("_n"))
    need = F.when(F.col("_n") < WHOLE_BELOW, F.col("_n")).otherwise(F.ceil(min_share * width)).cast("int")
    inside = F.filter("_agree", lambda p, j: F.coalesce(F.get(F.col("_agree"), j + need - 1) - p < width, F.lit(False)))
    out = out.where((F.size(inside) > 0) & (F.col("_barrier") >= 0))  # the barrier keeps the filter above the list it reads
    best = F.struct(F.size("_agree").alias("n"), (-F.col("_shift")).alias("s"), (F.get("_agree", F.lit(0)) + F.col("_shift")).alias("first"),
                    (F.get("_agree", F.size("_agree") - 1) + F.col("_shift")).alias("last"), F.col("_n").alias("of"))
    out = out.groupBy("_doc", "_item").agg(F.max(best).alias("b"))
    return out.select(
        F.col("_doc").alias(id_col), F.col("_item").alias(item_col), F.col("b.first").alias("first_token"), F.col("b.last").alias("last_token"),
        F.col("b.n").cast("bigint").alias("n_matched"), F.col("b.of").cast("bigint").alias("n_item_tokens"))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    seeds: tuple[tuple[int, tuple[str, ...]], ...] = SEEDS, window: int = 13, min_share: float = 0.75, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Rows (id, item, first_token, last_token, n_matched, n_item_tokens): the best diagonal of each document and item that overlap."""
    if any(not (m.startswith("1") and m.endswith("1")) for _, masks in seeds for m in masks):
        raise ValueError("a mask begins and ends with 1")
    texts = docs.select(docs[id_col].alias("_doc"), docs[text_col].alias("_text")).where("_doc is not null")
    items = benchmark.select(benchmark[item_col].alias("_item"), tokens_of(benchmark[item_text_col]).alias("_tokens")).where(F.col("_tokens").isNotNull())
    size, bounds, kinds, number = F.size("_tokens"), [None, *(least for least, _ in seeds)], [], 0
    for above, (least, masks) in zip(bounds, seeds):
        kinds.append((size >= least if above is None else (size >= least) & (size < above), list(enumerate(masks, number))))
        number += len(masks)
    totals = items.agg(F.sum(size), *[F.count_if(has) for has, _ in kinds]).first()
    blocks = max(1, math.ceil((totals[0] or 0) / block_tokens))
    # masks of lengths that no item has could hit nothing
    kinds = [kind for kind, n in zip(kinds, totals[1:]) if n] or kinds[:1]
    worded = texts.select("_doc", tokens_of(F.col("_text")).alias("_words"))
    sought = [m for _, masks in kinds for m in masks]
    hits = []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("_item", "_tokens"), F.lit(blocks)) == b).withColumn("_size", size)
        planted = reduce(DataFrame.unionAll, [_positions(block.where(has), ["_item", "_size"], "_tokens", masks) for has, masks in kinds]).withColumnRenamed("_pos", "_at")
        # about block_tokens x 3 rows of three numbers
        hits.append(_positions(worded, ["_doc"], "_words", sought).join(F.broadcast(planted), "_hash").select("_doc", "_item", (F.col("_pos") - F.col("_at")).alias("_shift"), "_size"))
    found = reduce(DataFrame.unionAll, hits).distinct()
    rank = F.row_number().over(Window.partitionBy("_doc").orderBy("_item", "_shift"))
    found = found.withColumn("_part", F.floor((rank - 1) / HITS))
    by_doc = found.groupBy("_doc", "_part").agg(F.collect_list(F.struct("_item", "_shift", "_size")).alias("_hits"))
    # the join is by merge at every size; for large inputs Spark filters the texts by the ids found
    near = (
        by_doc.hint("shuffle_merge").join(texts, "_doc")
        .select("_doc", "_hits", tokens_of(F.col("_text")).alias("_words"))
        .select("_doc", F.explode_outer(F.transform("_hits", lambda h: F.struct(
            h["_item"].alias("item"), h["_shift"].alias("shift"),
            F.slice("_words", F.greatest(h["_shift"], F.lit(0)) + 1, h["_size"] + F.least(h["_shift"], F.lit(0))).alias("words")))).alias("h"))
        .select("_doc", F.col("h.item").alias("_item"), F.col("h.shift").alias("_shift"), F.col("h.words").alias("_words"))
    )
    return _verified(near, items, id_col, item_col, window, min_share)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, with all their columns, that overlap no benchmark item."""
    leaking = find_leaks(docs, benchmark, id_col=id_col, **options)
    leaking = leaking.select(leaking[id_col].alias("_leak")).distinct()
    return docs.join(leaking, docs[id_col] == leaking["_leak"], "left_anti")
