"""Self-joins by shared signatures without pairing a signature's rows with each other.

Rows (key, id) that share a key are candidates. Each is paired with the first of its key only; pairs are verified
exactly and linked ones merged into classes. Keys whose rows are not all in one class then are opened: their rows
are compared where they meet, in blocks. A block that compares exactly tells only links between rows it has not yet found
in one class; one that compares by less tells each pair that may be linked once, in the first key the two share. So every
candidate pair is either compared or already in one class, and pairs that are not linked stay few.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedweave.llm.graph import components
from feedweave.llm.text import mix
from feedweave.session import drop_folder, stage

#: Kinds of rows in one stream: passed on as they are, or a share of a signature.
NOTE, SHARE = 0, 1
ROWS = "key long, id long, n int, other long, via long, content binary, kind byte"
PARTNERS = 200
#: Rows of a key that are held at a time.
IN_BLOCK = 500


def rows_of(key, own, n, other, kind: int, via=None, content=None) -> pa.RecordBatch:
    size = len(own)
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(own, pa.int64()), pa.array(n.astype(np.int32)), pa.array(other, pa.int64()),
         pa.nulls(size, pa.int64()) if via is None else pa.array(via.view(np.int64)),
         pa.nulls(size, pa.binary()) if content is None else pa.array(content, pa.binary()),
         pa.array(np.full(size, kind, np.int8))],
        names=["key", "id", "n", "other", "via", "content", "kind"])


def share_rows(keys: np.ndarray, own: np.ndarray):
    """Signature rows of a few items: one for each key, and pairs of the items that share one here."""
    order = np.lexsort((own, keys))
    keys, own = keys[order], own[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    hub = own[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
    yield rows_of(keys[new], own[new], np.zeros(new.sum(), np.int32), np.full(new.sum(), -1), SHARE)
    met = ~new & (hub != own)
    if met.any():
        spread = mix(own[met].astype(np.uint64) * np.uint64(31) + hub[met].astype(np.uint64))
        yield rows_of(spread, own[met], np.zeros(met.sum(), np.int32), hub[met], SHARE, keys[met])


def meetings(rows: DataFrame) -> DataFrame:
    """(a, b, n, key, content, kind): notes as they are, and each id with the first of each of its keys."""

    def run(batches):
        last_key, last_id = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key, own, n, other = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            kind = batch.column(6).to_numpy(zero_copy_only=False)
            note = np.flatnonzero(kind == NOTE)
            named = np.flatnonzero((kind != NOTE) & (other >= 0))
            if len(note):
                yield _met(own[note], other[note], n[note], None, batch.column(5).take(pa.array(note)), NOTE)
            if len(named):
                yield _met(own[named], other[named], n[named], batch.column(4).take(pa.array(named)), None, SHARE)
            share = np.flatnonzero((kind != NOTE) & (other < 0))
            if len(share):
                k, o = key[share], own[share]
                new = np.concatenate([[last_key is None or k[0] != last_key], k[1:] != k[:-1]])
                lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
                hub = np.where(lead < 0, last_id, o[np.maximum(lead, 0)])
                last_key, last_id = k[-1], hub[-1]
                met = hub != o
                if met.any():
                    yield _met(o[met], hub[met], n[share][met], pa.array(k[met]), None, SHARE)

    sorted_rows = rows.repartition("key").sortWithinPartitions("key", "id")
    return sorted_rows.mapInArrow(run, "a long, b long, n int, key long, content binary, kind byte")


def _met(a, b, n, key, content, kind: int) -> pa.RecordBatch:
    size = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int32()),
         pa.nulls(size, pa.int64()) if key is None else key, pa.nulls(size, pa.binary()) if content is None else content,
         pa.array(np.full(size, kind, np.int8))], names=["a", "b", "n", "key", "content", "kind"])


def verified(pairs: DataFrame, texts: DataFrame, decide: Callable) -> DataFrame:
    """(a, b, linked) of pairs.

    The partners of ``b`` come past ``b`` sorted by Spark, a few hundred in a share, so that a node of many pairs
    is dealt over tasks. ``decide`` makes of a column of texts an iterable of (first row, last row, items), and
    of two items whether they are linked.
    """
    load = pairs.groupBy("b").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("shares"))
    spread = pairs.join(load, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("share"))
    hubs = load.select("b", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    side_b = hubs.join(texts, hubs.b == texts.id).select("b", "share", F.lit(0).alias("side"), "id", "text")
    side_a = spread.join(texts, spread.a == texts.id).select("b", "share", F.lit(1).alias("side"), "id", "text")
    dealt = side_b.unionByName(side_a).repartition("b", "share").sortWithinPartitions("b", "share", "side", "id")

    def run(batches):
        items, linked = decide()
        hub, hub_item = None, None
        for batch in batches:
            b, side, ids = (batch.column(i).to_numpy(zero_copy_only=False).tolist() for i in (0, 2, 3))
            out = []
            for first, last, found in items(batch.column(4)):
                for i, item in zip(range(first, last), found):
                    if side[i] == 0:
                        hub, hub_item = b[i], item
                    else:
                        out.append((ids[i], hub, bool(linked(item, hub_item))))
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.bool_()))], names=["a", "b", "linked"])

    return dealt.mapInArrow(run, "a long, b long, linked boolean")


def apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one class yet."""
    of_a = classes.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    of_b = classes.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    joined = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return joined.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")


def linked_classes(met: DataFrame, raw: DataFrame, pairs: DataFrame, texts_of: Callable, decide: Callable, contents_of: Callable,
                   prepare: Callable, links_of: Callable, possible: Callable, folder: str, leads: DataFrame | None = None,
                   exact: bool = True, spent: tuple[str, ...] = ()) -> DataFrame:
    """``id, component`` of all items with a link.

    ``met``: staged (a, b, key); ``raw``: its staged pairs (a, b); ``pairs``: staged candidates (a > b, times); ``possible`` leaves out of such pairs those
    that cannot be linked. ``texts_of`` gives (id, text) of a column of ids, ``contents_of`` (id, content) what ``prepare`` and
    ``links_of`` compare (see ``opened``), exactly or so that no link is missed. With ``leads`` (id, lead), items are equal to
    their lead, and pairs are of leads. ``spent`` names what in ``folder`` nobody reads once the rows of opened keys are written: it goes.
    """
    likely = stage(possible(pairs), "possible", folder)
    texts = texts_of(likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct(), "texts")
    # First each item with the one it shares most signatures with, then the pairs still apart. Classes in between only spare
    # comparisons, so they need not be whole yet.
    best = Window.partitionBy("a").orderBy(F.col("times").desc(), "b")
    # What a plan would hold several times is written first: the driver keeps each plan, and what it broadcasts, until its garbage is collected.
    first = stage(likely.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("a", "b"), "first", folder)
    done = stage(verified(first, texts, decide), "verified-1", folder)
    links = done.filter("linked").select("a", "b")
    rest = apart(likely.join(done.select("a", "b"), ["a", "b"], "left_anti"), components(links, rounds=2))
    rest = stage(rest.select("a", "b"), "rest", folder)
    second = stage(verified(rest, texts, decide), "verified-2", folder)
    links = links.unionByName(second.filter("linked").select("a", "b"))
    classes = components(links)

    # Keys whose rows are in several classes: those of pairs that are still apart.
    if leads is not None:
        classes = leads.join(classes.withColumnRenamed("id", "lead"), "lead").select("id", "component")
        classes = stage(classes, "of-each", folder)
    unlike = apart(raw.select("a", "b"), classes)
    open_keys = _either(met, unlike).select("key").distinct()
    members = met.join(open_keys, "key", "left_semi")
    members = members.select("key", F.explode(F.array("a", "b")).alias("id"))
    if leads is not None:
        members = members.join(leads, "id").select("key", F.col("lead").alias("id"))
    members = members.distinct().join(classes, "id", "left")
    members = stage(members.select("key", "id", F.coalesce("component", "id").alias("c")), "members", folder)
    rows = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"rows_{i}") for i in (1, 2)]
    sizes = members.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("n"), *rows)
    # What is alike in a few places is so in many: of keys with the same rows (by 128 bits) one is opened.
    chosen = sizes.filter("x <> y AND n > 2").groupBy("n", "rows_1", "rows_2").agg(F.min("key").alias("key"))
    members = stage(members.join(chosen.select("key", "n"), "key"), "open", folder)
    for label in ("first", "rest", "members", "of-each", *spent):
        drop_folder(met.sparkSession, f"{folder}/{label}")
    more = stage(opened(members, contents_of(members.select("id").distinct()), prepare, links_of, exact), "opened", folder)
    if not exact:
        more = stage(more.join(done.unionByName(second).select("a", "b"), ["a", "b"], "left_anti"), "untold", folder)
        texts = texts_of(more.select(F.col("a").alias("id")).union(more.select("b")).distinct(), "more-texts")
        more = stage(verified(more, texts, decide), "verified-3", folder).filter("linked").select("a", "b")
    return components(links.unionByName(more))


def _either(met: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``met`` whose ends are a pair, in whichever order."""
    ordered = met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "key")
    return ordered.join(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_semi")


def opened(shares: DataFrame, contents: DataFrame, prepare: Callable, links_of: Callable, exact: bool = True) -> DataFrame:
    """Links (a > b) between rows of a key in different classes; ``shares`` are (key, id, c, n), ``n`` rows in all.

    A key's rows are cut into blocks of bounded size. A block is held while the rows of earlier blocks come past; each is
    compared with those held that are not in its class, and a link found makes two classes one, so that a block gives fewer
    links than it has classes. ``prepare`` makes an item of a content; ``links_of(item, held, wanted)`` gives, one by one, the
    numbers of held items it is linked to, passing over those for which ``wanted(number)`` says no by then.

    Without ``exact`` these are items it may be linked to: classes stay as they are, and a pair that meets under several keys is
    given under the smallest of them only.
    """
    none = F.array().cast("array<bigint>")
    if not exact:
        own_keys = shares.groupBy("id").agg(F.array_sort(F.collect_list("key")).alias("keys"))
        contents = contents.join(own_keys, "id")
    rows = shares.withColumn("blocks", F.ceil(F.col("n") / IN_BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.col("own"), F.col("blocks") - 1)))
    rows = rows.withColumn("role", (F.col("block") != F.col("own")).cast("int")).join(contents, "id")
    # Of an id's keys those below the one it is dealt out for.
    below = none if exact else F.slice("keys", F.lit(1), (F.array_position("keys", F.col("key")) - 1).cast("int"))
    rows = rows.select("key", "block", "role", "id", "c", "content", below.alias("keys"))
    ordered = rows.repartition("key", "block").sortWithinPartitions("key", "block", "role", "id")

    def first_met(one: list[int], two: list[int]) -> bool:
        """Whether two rows of a key share none of their keys below it: two sorted lists."""
        i = j = 0
        while i < len(one) and j < len(two):
            if one[i] == two[j]:
                return False
            i, j = (i + 1, j) if one[i] < two[j] else (i, j + 1)
        return True

    def run(batches):
        current, ids, classes, held, of = None, [], [], [], []
        above: dict[int, int] = {}

        def root(c: int) -> int:
            while above.get(c, c) != c:
                above[c] = c = above.get(above[c], above[c])
            return c

        for batch in batches:
            out = []
            for key, block, role, own, c, content, keys in zip(*(x.to_pylist() for x in batch.columns)):
                if current != (key, block):
                    current, ids, classes, held, of = (key, block), [], [], [], []
                    above.clear()
                mine, item = root(c), prepare(content)
                others = [j for j in range(len(ids)) if root(classes[j]) != mine]
                if others:
                    for i in links_of(item, [held[j] for j in others], lambda i: root(classes[others[i]]) != root(c)):
                        j = others[i]
                        if exact or first_met(keys, of[j]):
                            out.append((max(own, ids[j]), min(own, ids[j])))
                        if exact:
                            above[root(classes[j])] = root(c)
                if role == 0:
                    of.append(keys)
                    ids.append(own)
                    classes.append(c)
                    held.append(item)
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["a", "b"])

    return ordered.mapInArrow(run, "a long, b long")
