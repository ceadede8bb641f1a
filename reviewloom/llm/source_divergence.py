"""Source divergence audit by Gustavson row accumulation.

A group is one source of one language, a row of a sparse matrix of groups by terms.
Its divergence from every other source of the language sums, over the terms the
language keeps, ``f(p, q) = floor((p - q)^2 / (p + q))`` of smoothed shares in whole
billionths. A term that neither group has still counts, with the two groups' base
shares, so a sum over common terms alone is not enough. It is put together as

    V * f(p0, q0)                                             every term, as if no group had it
    + sum over the terms of g: f(p, q0) - f(p0, q0)           corrected where g has it
    + sum over the terms of h: f(p0, q) - f(p0, q0)           corrected where h has it
    + sum over common terms: f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

with the base shares ``p0`` and ``q0`` of count zero. The second and third lines need no
terms but only how often each count occurs in a group. For the last one the matrix is
cut into blocks of terms. In a block, each group walks its terms through the
term-major index of the block and scatters the values of all peers that have the term
into a dense accumulator with one place per peer. Pairs of postings exist only inside
numpy, and a block hands on one row per group and peer. Blocks are cut by a hash of the
term and sized by the number of postings, so a language with most of the corpus is many
blocks. All arithmetic is on whole numbers.

Counting takes one pass over the texts: tasks add up words by group in a table of
bounded size and hand it on when it is full.

A task holds one block (about ``POSTINGS`` postings, at least those of one term: one
for each source of the language) and one accumulator, or ``_GROUPS`` groups' count tables
and one base share for each source of the language.

Defined cases: null text, language and source read as empty; a group without words still
takes part, with base shares only; a language that keeps no term gives 0 for all its pairs
and no term rows; a source that is alone in its language has no pairs; an empty table gives
no row; repeated rows count as often as they occur; very long texts are counted whole;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import Workspace

LEAST_DOCS, SCALE, TOP = 10, 1_000_000_000, 10
POSTINGS, ENTRIES = 500_000, 300_000
_GROUPS = 64
#: ASCII letters in lower case, other ASCII characters as blanks, bytes of other characters as they are.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Terms of a text as UTF-8, in order."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of shares up to about 10^9."""
    d = p - q
    return d * d // (p + q)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, n, docs); every group has a row with an empty term."""
    total: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in total.items():
            terms, seen = [b"", *counts], docs[lang, source]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([0, *counts.values()], pa.int64()), pa.array([0, *map(seen.__getitem__, counts)], pa.int64()),
            ], names=["lang", "source", "term", "n", "docs"])
        total.clear()
        docs.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(k) for k in range(3))):
            key, words = (lang.as_py(), source.as_py()), words_of(text.as_py())
            total.setdefault(key, Counter()).update(words)
            docs.setdefault(key, Counter()).update(set(words))
        if sum(map(len, total.values())) + len(total) > ENTRIES:
            yield from flush()
    yield from flush()


def count_terms(docs: DataFrame, *, text_col: str, lang_col: str, source_col: str, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n of the terms kept, and a row with an empty term for every group.

    One exchange, by language and term, serves the counts of a group and those of the language.
    """
    read = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counted = read.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    summed = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = Window.partitionBy("lang", "term")
    known = summed.withColumn("lang_docs", F.sum("docs").over(by_term)).withColumn("lang_n", F.sum("n").over(by_term))
    return known.where((F.col("lang_docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "n", "lang_n")


def _share(count: str, total: str) -> F.Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * v)) in exact decimals."""
    return F.expr(f"1 + ((cast({count} + 2 as decimal(20, 0)) * {SCALE}bd) div cast({total} + 2 * v as decimal(20, 0)))")


def _scatter(table: pa.Table) -> pa.Table:
    """Common terms of all pairs of groups in a block: source, item, value."""
    lang = table.column("lang")[0].as_py()
    coded = table.column("source").combine_chunks().dictionary_encode()
    names, group = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((group, term))
    group, term = group[order], term[order]
    p, p0 = (table.column(c).to_numpy()[order] for c in ("p", "p0"))
    first = np.concatenate([[0], np.cumsum(np.bincount(term))])  # where the postings of a term begin
    rows = np.argsort(group, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(names)))])
    out_g, out_h, out_v = [], [], []
    for g in range(len(names)):
        mine = rows[bounds[g] : bounds[g + 1]]
        begin, length = first[term[mine]], np.diff(first)[term[mine]]
        peer = np.arange(length.sum()) + np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        pg, qh, q0 = np.repeat(p[mine], length), p[peer], p0[peer]
        base = p0[mine[0]]
        sums = np.zeros(len(names), dtype=np.int64)
        np.add.at(sums, group[peer], divergence(pg, qh) - divergence(pg, q0) - divergence(base, qh) + divergence(base, q0))
        met = np.flatnonzero(np.bincount(group[peer], minlength=len(names)))
        met = met[met != g]
        out_g.append(np.full(len(met), g))
        out_h.append(met)
        out_v.append(sums[met])
    g, h, v = (np.concatenate(x) for x in (out_g, out_h, out_v))
    return _pairs(lang, names.take(pa.array(g)), names.take(pa.array(h)), v)


def _pairs(lang: str, source: pa.Array, item: pa.Array, value: np.ndarray) -> pa.Table:
    return pa.table([pa.array([lang] * len(value), pa.string()), source.cast(pa.string()), item.cast(pa.string()), pa.array(value, pa.int64())], names=["lang", "source", "item", "value"])


def _baseline(counts: pa.Table, peers: pa.Table) -> pa.Table:
    """What a pair has from base shares and from the terms of one side only: both orders of each pair of a group here and a peer."""
    names, q0 = peers.column("source").combine_chunks(), peers.column("p0").to_numpy()
    lang, kept = peers.column("lang")[0].as_py(), peers.column("v")[0].as_py()
    mine = peers.filter(pc.equal(peers.column("home"), 1))
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    if counts.num_rows:
        coded = counts.column("source").combine_chunks().dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False)
        p, terms = counts.column("p").to_numpy(), counts.column("terms").to_numpy()
        held = {name: (p[place == k], terms[place == k]) for k, name in enumerate(coded.dictionary.to_pylist())}
    every = names.to_pylist()
    out = [_pairs(lang, names.slice(0, 0), names.slice(0, 0), np.empty(0, dtype=np.int64))]
    for name, base in zip(mine.column("source").to_pylist(), mine.column("p0").to_numpy()):
        plain = divergence(base, q0)
        one = np.zeros(len(q0), dtype=np.int64)
        for p, n in zip(*held.get(name, ((), ()))):
            one += n * (divergence(p, q0) - plain)
        others = np.array([x != name for x in every])
        self_, peer = pa.array([name] * int(others.sum()), pa.string()), names.filter(pa.array(others))
        out += [_pairs(lang, self_, peer, (kept * plain + one)[others]), _pairs(lang, peer, self_, one[others])]
    return pa.concat_tables(out)


_PAIR = "lang string, source string, item string, value bigint"


def audit_sources(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP, postings: int = POSTINGS) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows to every other source of the language, and the ``top`` ``term`` rows of each group."""
    space = Workspace(docs.sparkSession, "source-divergence")
    counts = space.write(count_terms(docs, text_col=text_col, lang_col=lang_col, source_col=source_col, least_docs=least_docs), "counts")
    kept = counts.where("term <> ''")
    blocks = max(1, -(-kept.count() // postings))

    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).groupBy("lang").agg(F.sum(F.when(F.col("term") == "", 0).otherwise(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    base = F.when(F.col("v") == 0, F.lit(1)).otherwise(_share("0", "total"))
    groups = space.write(sums.join(langs, "lang").withColumn("p0", base).withColumn("ix", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1), "groups")
    shares = space.write(kept.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total")), "shares")

    both = shares.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "source", "term", "p", "p0").groupBy("lang", "block").applyInArrow(_scatter, _PAIR)
    part = F.expr(f"ix div {_GROUPS}")
    parted = groups.withColumn("own", part).withColumn("last", F.max("own").over(Window.partitionBy("lang")))
    peers = parted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).select("lang", "part", "source", "p0", "v", F.when(F.col("own") == F.col("part"), 1).otherwise(0).alias("home"))
    tallies = shares.groupBy("lang", "source", "ix", "p").agg(F.count(F.lit(1)).alias("terms")).select("lang", part.alias("part"), "source", "p", "terms")
    alone = tallies.groupBy("lang", "part").cogroup(peers.groupBy("lang", "part")).applyInArrow(_baseline, _PAIR)
    pairs = both.unionAll(alone).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    by_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    typical = shares.withColumn("q", _share("lang_n", "lang_total")).where("n > 0 and p > q")
    terms = typical.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value")).withColumn("rank", F.row_number().over(by_group)).where(F.col("rank") <= top)
    ranked = pairs.withColumn("rank", F.row_number().over(by_group))
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionAll(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


#: DuckDB SQL for ``audit_sources`` over ``documents``.
CHECK_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents),
spread AS (SELECT d, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM spread GROUP BY ALL HAVING count(DISTINCT d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM spread SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
    SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t USING (lang, source)),
shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v)::HUGEINT)::HUGEINT AS p,
        (1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v)::HUGEINT)::HUGEINT AS q
    FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM every)
WHERE part = 'pair' OR rank <= 10
"""
