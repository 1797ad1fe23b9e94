"""How far the sources of a language stand apart by the terms they use.

The terms of each shard are sorted by pointers to their starts (``termsort``); a run of equal terms, whose places stand
in the order of groups and texts, gives the occurrences and the documents of each group. Spark adds the shards up. All
figures are whole numbers: a share is a count of thousand-millionths, rounded down, and a divergence is (p - q)^2 / q, rounded down.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweave.llm.termsort import TermSort, slices, term_places
from feedweave.llm.text import utf8
from feedweave.session import scratch, stage

SLICE_BYTES = 8 << 20
PAIRS_AT_ONCE = 1 << 20
PARTS = 1_000_000_000

RUNS = "lang string, source string, term string, n long, docs long"


def _runs(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """Occurrences and documents of each term of each group among some texts; a row without a term for each group."""
    groups: dict[tuple[str, str], int] = {}
    group = np.array([groups.setdefault(x, len(groups)) for x in zip(lang.to_pylist(), source.to_pylist())])
    # Texts in the order of groups, so that a run of equal terms has the places of a group together.
    rows = np.argsort(group, kind="stable")
    data, bounds = utf8(text.take(pa.array(rows)))
    starts, ends = term_places(data, bounds)
    sort = TermSort(data, starts, ends)
    order, first = sort.order()
    row = np.searchsorted(bounds, starts, side="right")[order] - 1
    of = group[rows][row] if len(row) else row
    other_group = np.zeros(len(order), dtype=bool)
    other_group[first] = True
    other_row = other_group.copy()
    other_group[1:] |= of[1:] != of[:-1]
    other_row[1:] |= row[1:] != row[:-1]
    at = np.flatnonzero(other_group)
    n = np.diff(at, append=len(order))
    docs = np.add.reduceat(other_row.astype(np.int64), at) if len(at) else n
    # The terms themselves, from the bytes their first pointers show.
    place = order[at]
    sizes = ends[place] - starts[place]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    held = sort.bytes[np.repeat(starts[place] - offsets[:-1], sizes) + np.arange(offsets[-1])]
    term = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(held)).cast(pa.string())
    names = list(groups)
    which = pa.array(np.concatenate([of[at], np.arange(len(names))]).astype(np.int64))
    none = np.zeros(len(names), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in names], pa.string()).take(which), pa.array([x[1] for x in names], pa.string()).take(which),
         pa.concat_arrays([term, pa.nulls(len(names), pa.string())]),
         pa.array(np.concatenate([n, none]), pa.int64()), pa.array(np.concatenate([docs, none]), pa.int64())],
        names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` over all documents, with a row of null term for each group that occurs.

    Null texts, languages and sources are ''. Each row is a document; ids are not looked at.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.large_string())
            bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            for a, b in slices(bounds, SLICE_BYTES):
                yield _runs(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), texts.slice(a, b - a))

    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return read.mapInArrow(run, RUNS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """1 + the thousand-millionths of ``count + 1`` in ``total``, rounded down; exact for any number of occurrences."""
    whole = F.lit(PARTS).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)"))
    return F.call_function("div", whole, total.cast("decimal(20,0)")) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _met_by_both(batches):
    """What pairs of sources that share a term add to the sum over terms of either alone; rows sorted by term."""
    names = ["lang", "source", "item", "value"]
    held = None

    def summed(table: pa.RecordBatch, new: np.ndarray):
        """``new``: where terms begin in the rows of ``table``."""
        size = np.diff(new, append=table.num_rows)
        lang, source = table.column(0).dictionary_encode(), table.column(2).dictionary_encode()
        l, s = (x.indices.to_numpy().astype(np.int64) for x in (lang, source))
        p, base = (table.column(k).to_numpy() for k in (3, 4))
        start, width = np.repeat(new, size), np.repeat(size, size)
        before, k = np.concatenate([[0], np.cumsum(width)]), len(source.dictionary)
        at = 0
        while at < len(width):
            # So many rows, each with all rows of its term; one at least.
            upto = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS_AT_ONCE, side="right")) - 1)
            one = np.repeat(np.arange(at, upto), width[at:upto])
            two = np.arange(len(one)) - (before[one] - before[at]) + start[one]
            one, two = one[one != two], two[one != two]
            at = upto
            value = _apart(p[one], p[two]) - _apart(p[one], base[two]) - _apart(base[one], p[two]) + _apart(base[one], base[two])
            codes, inverse = np.unique((l[one] * k + s[one]) * k + s[two], return_inverse=True)
            total = np.zeros(len(codes), np.int64)
            np.add.at(total, inverse, value)
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(codes // (k * k))), source.dictionary.take(pa.array(codes // k % k)),
                 source.dictionary.take(pa.array(codes % k)), pa.array(total)], names=names)

    for batch in batches:
        table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not table.num_rows:
            continue
        n = table.num_rows
        differs = pc.or_(*(pc.not_equal(table.column(c).slice(1), table.column(c).slice(0, n - 1)) for c in (0, 1)))
        new = np.concatenate([[0], np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1])
        # The last term may go on in the next batch.
        held = table.slice(int(new[-1]))
        if len(new) > 1:
            yield from summed(table.slice(0, int(new[-1])), new[:-1])
    if held is not None:
        yield from summed(held, np.zeros(1, np.int64))


def audit(docs: DataFrame, least_docs: int = 3, most_terms: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: for every source of a language the other sources by divergence (part
    ``pair``, all ranks), and the terms that set it apart from its language as a whole (part ``term``, ``most_terms`` ranks).

    A term is a run of ASCII letters, A-Z as a-z, and characters beyond ASCII. A language keeps the terms found in
    ``least_docs`` of its documents or more. With V kept terms and N occurrences of them, a term of count c has
    p = 1 + floor(10^9 (c + 1) / (N + V)); a source's divergence from another is the sum of floor((p - q)^2 / q) over
    all kept terms, also those neither has. Equal values rank by item in the order of UTF-8 bytes.

    Null lang, source and text are ''. Repeated rows are documents of their own, and so are rows that share an id. A
    group without terms has its rows of part ``pair``, of value 0 in a language that keeps none; a language of one
    source has none. No documents give no rows. Columns besides ``lang, source, text`` are not looked at.
    """
    spark = docs.sparkSession
    with scratch(spark, "audit") as folder:
        counts = stage(term_counts(docs), "counts", folder)
        same = Window.partitionBy("lang", "term")
        kept = (counts.filter("term IS NOT NULL")
                .withColumns({"all_docs": F.sum("docs").over(same), "all_n": F.sum("n").over(same), "leads": F.min("source").over(same) == F.col("source")})
                .filter(F.col("all_docs") >= least_docs).select("lang", "source", "term", "n", "all_n", "leads"))
        kept = stage(kept, "kept", folder)
        by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("leads").cast("long")).alias("v"))
        zero = F.lit(0).cast("long")
        groups = (counts.filter("term IS NULL").select("lang", "source").join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
                  .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "v"))))
        # In a language that keeps no term nothing is ever divided.
        groups = stage(groups.withColumn("base", F.when(F.col("v") > 0, share(zero, F.col("total") + F.col("v")))), "groups", folder)
        rows = stage(kept.join(groups, ["lang", "source"]).select(
            "lang", "term", "source", share(F.col("n"), F.col("total") + F.col("v")).alias("p"), "base",
            share(F.col("all_n"), F.col("lang_total") + F.col("v")).alias("q")), "rows", folder)
        ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        terms = (rows.filter("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
                 .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= most_terms))

        # Terms that neither has, then what terms of the one and of the other add, then those of both.
        other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"), "v")
        absent = (groups.select("lang", "source", "base").join(other, "lang").filter("source != item")
                  .select("lang", "source", "item", F.coalesce(F.col("v") * apart(F.col("base"), F.col("item_base")), zero).alias("value")))
        p, base, item_base = F.col("p"), F.col("base"), F.col("item_base")
        alone = (rows.groupBy("lang", "source", "p", "base").agg(F.count("*").alias("m")).join(other, "lang").filter("source != item")
                 .groupBy("lang", "source", "item").agg(
                     F.sum(F.col("m") * (apart(p, item_base) - apart(base, item_base))).alias("there"),
                     F.sum(F.col("m") * (apart(item_base, p) - apart(item_base, base))).alias("back")))
        there = alone.select("lang", "source", "item", F.col("there").alias("value"))
        back = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value"))
        sorted_rows = rows.select("lang", "term", "source", "p", "base").repartition("lang", "term").sortWithinPartitions("lang", "term")
        both = sorted_rows.mapInArrow(_met_by_both, "lang string, source string, item string, value long")
        pairs = (absent.unionByName(there).unionByName(back).unionByName(both).groupBy("lang", "source", "item")
                 .agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(ranked)))
        out = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
        return stage(out.select("lang", "source", "part", "item", "value", "rank"), "audit-rows")
