"""N-gram Jaccard self-join by T-occurrence search (heap-merge of short inverted lists, binary probes of long ones).

Two documents link when their sets of word shingles have a Jaccard similarity of at least ``percent`` / 100.  No link
between different sets is lost:

1. Every document's shingles are hashed to 64 bits and sorted.  Linked documents share a shingle among the first
   p = n - ceil(t n) + 1 of their n, in any order of all shingles that is the same for both.  The order used takes the
   shingles below a cut of the hash first, the rarest of them first.  So only those shingles are counted over the corpus;
   a document with p or more of them that no other has can have no link, and that settles most documents.
2. Documents with equal sets are one class.  The classes that are left meet in lists by the shingles of their
   first p; lists are joined to their least member only (a star, not all pairs), and components of these stars are the
   candidates: groups of classes outside of which none has a link.
3. A group's sets go to tasks of bounded size.  A group of more rows than a task's share of all (see :func:`group_links`) is
   cut into units: sets of like size (linked sets are at most one band of sizes apart) dealt by a hash.  Three rounds of
   searches find its links: inside every unit; inside units dealt anew, over two bands; and between units, but only what
   these two rounds left apart: the rows that are outside the group's largest component are searched against every unit
   within one band.  So the copies of a hot text cost each row two searches, however many they are, and only rows that are
   no such copies meet all others of their size.
4. A search (:func:`search`) takes sets by growing size.  A link needs T shared shingles, so what occurs in fewer than
   T - L of the lists but the L longest can't be one (DivideSkip); the short lists are merged by a heap, the long ones
   probed by binary search.  Only links between components not yet joined are looked for, so the result is a forest.
5. Components of all links, with the classes' rows, are the result.

Defined cases: a text of fewer words than a shingle is one shingle; null or blank texts have none and link with nothing;
rows that repeat a doc_id are rows of their own; null doc_ids link, too, and come last among the ids of a component; a very
long text is shingled whole, in memory with eight bytes a word; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, connected_components, drop_rows, own_columns, ship_package, small

#: Rows and shingles that a unit has at most, about, and rows that one has at least.
UNIT_ROWS, UNIT_SHINGLES, LEAST_ROWS = 2000, 4_000_000, 64
#: DivideSkip's weight of a probe against a step of the merge.
MU = 0.0085
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_set(text: Column, words: int) -> Column:
    """Sorted distinct hashes of the word shingles of a text."""
    tokens = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), SPACE), lambda w: w != "")
    hashes = F.transform(
        F.array(tokens),  # bound once
        lambda w: F.when(F.size(w) >= words, F.transform(F.sequence(F.lit(0), F.size(w) - words), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(words)))))
        .when(F.size(w) > 0, F.array(F.xxhash64(F.size(w), F.array_join(w, " "))))
        .otherwise(F.array().cast("array<bigint>")),
    )
    return F.array_sort(F.array_distinct(F.get(hashes, F.lit(0))))


def least_overlap(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def search(ids, sets, percent: int, labels=None, sides=None) -> list[tuple[int, int]]:
    """Links of a forest that joins what the links of the sets (sorted arrays) join.

    labels: components known so far; links inside them aren't looked for.  sides: 0 for sets that are indexed, 1 for those
    that are searched for; if not given, every set is searched among the smaller ones.
    """
    import numpy as np

    m = len(ids)
    sizes = np.fromiter(map(len, sets), np.int64, m)
    order = np.lexsort((ids, sizes))
    ids, sizes, sets = ids[order], sizes[order], [sets[i] for i in order]
    label = np.arange(m) if labels is None else np.unique(labels[order], return_inverse=True)[1]
    indexed = np.arange(m) if sides is None else np.flatnonzero(sides[order] == 0)
    queries = range(1, m) if sides is None else np.flatnonzero(sides[order] == 1).tolist()
    k = len(indexed)
    if not k or not queries:
        return []
    known, token = np.unique(np.concatenate([sets[i] for i in indexed]), return_inverse=True)
    # List by list, members by their places in order of size.
    postings = np.sort(token.astype(np.int64) * k + np.repeat(np.arange(k), sizes[indexed]))
    size = sizes[indexed]
    links: list[tuple[int, int]] = []

    def shared(tokens, y: int) -> int:
        """How many of the tokens' lists hold y, by binary probes."""
        keys = tokens * k + y
        at = np.searchsorted(postings, keys)
        return int((postings[np.minimum(at, len(postings) - 1)] == keys).sum())

    for x in queries:
        n = int(sizes[x])
        need = -(-n * percent // 100)
        low = int(np.searchsorted(size, need))
        high = x if sides is None else int(np.searchsorted(size, n * 100 // percent, "right"))
        if low >= high or (label[indexed[low:high]] == label[x]).all():
            continue
        at = np.searchsorted(known, sets[x])
        mine = at[known[np.minimum(at, len(known) - 1)] == sets[x]]
        if len(mine) < need:
            continue
        first, last = np.searchsorted(postings, mine * k + low), np.searchsorted(postings, mine * k + high)
        length = last - first
        by = np.argsort(length, kind="stable")
        longest = max(1, int(length[by[-1]]))
        n_long = min(need - 1, int(need / (MU * math.log2(longest + 1) + 1)))
        short, long_ = by[: len(mine) - n_long], mine[by[len(mine) - n_long :]]
        lists, after = [postings[first[i] : last[i]] - mine[i] * k for i in short if length[i]], -1
        while after is not None:  # once for each component that x joins
            lists = [rest for rows in lists if len(rest := rows[(rows > after) & (label[indexed[rows]] != label[x])])]
            after = None
            for y, n_short in merged(lists, need - n_long):
                if (100 + percent) * (n_short + shared(long_, y)) >= percent * (n + int(size[y])):
                    links.append((int(ids[x]), int(ids[indexed[y]])))
                    label[label == label[indexed[y]]] = label[x]
                    after = y
                    break
    return links


def merged(lists: list, least: int) -> Iterable[tuple[int, int]]:
    """(member, lists that hold it) for the members of at least ``least`` of the sorted lists, by a heap of their heads."""
    for y, same in itertools.groupby(heapq.merge(*(map(int, x) for x in lists))):
        if (n := sum(1 for _ in same)) >= least:
            yield y, n


def _links(tasks: DataFrame, percent: int) -> DataFrame:
    """(root, a, b) of tasks' rows (root, i, j, side, node, label, shingles), searched task by task; side is null for
    searches of all rows among each other."""
    ship_package(tasks.sparkSession)

    def run(table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks()
        column = table.column("shingles").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        sets = [values[a:b] for a, b in itertools.pairwise(offsets)]
        sides = None if table.column("side").null_count else table.column("side").to_numpy()
        found = search(table.column("node").to_numpy(), sets, percent, table.column("label").to_numpy(), sides)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"root": pa.array([table.column("root")[0].as_py()] * len(a), pa.int64()), "a": pa.array(a), "b": pa.array(b)})

    return tasks.groupBy("root", "i", "j").applyInArrow(run, "root bigint, a bigint, b bigint")


def unit(rows: DataFrame, group: list[str], seed: int, unit_rows: int, name: str) -> DataFrame:
    """Adds name: a unit's number inside the group, of parts of about unit_rows rows, dealt by a hash of the node."""
    parts = rows.groupBy(*group).agg(F.greatest(F.ceil(F.count(F.lit(1)) / unit_rows), F.ceil(F.sum("n") / UNIT_SHINGLES)).alias("parts"))
    return rows.join(small(parts, 48), group).withColumn(name, F.pmod(F.xxhash64("node", F.lit(seed)), F.col("parts"))).drop("parts")


def group_links(members: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(root, a, b): links that join what the links inside the groups join, of members (root, node, n, shingles)."""
    share = members.count() // (4 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    unit_rows = min(UNIT_ROWS, max(LEAST_ROWS, share))
    # Groups of several units: no more of them than units.
    large = members.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")).filter((F.col("rows") > unit_rows) | (F.col("shingles") > UNIT_SHINGLES))
    large = small(scratch.table(large.select("root")), 16)
    alone = F.lit(None).cast("int").alias("side")
    whole = members.join(large, "root", "left_anti").select("root", F.lit(0).alias("i"), F.lit(0).alias("j"), alone, "node", F.col("node").alias("label"), "shingles")
    links = scratch.table(_links(whole, percent))
    # A band's sizes are within a factor of 100 / percent; the margin is for sizes at the bound.
    band = F.floor(F.log(F.col("n")) / (math.log(100 / percent) * (1 + 1e-9)))
    cut = members.join(large, "root", "left_semi").withColumn("band", band).withColumn("two", F.floor((F.col("band") + 1) / 2))
    if cut.isEmpty():
        return links
    cut = scratch.table(unit(unit(cut, ["root", "band"], 3, unit_rows, "part"), ["root", "two"], 7, unit_rows, "again"))
    for at, part in (("band", "part"), ("two", "again")):
        links = links.unionByName(scratch.table(_links(cut.select("root", F.col(at).alias("i"), F.col(part).alias("j"), alone, "node", F.col("node").alias("label"), "shingles"), percent)))

    # What is still apart: all but each group's largest component.
    found = connected_components(links.join(large, "root", "left_semi").select("a", "b"), scratch).withColumnRenamed("root", "label")
    labelled = cut.join(found, "node", "left").withColumn("label", F.coalesce("label", "node")).withColumn("unit", F.struct("band", "part"))
    sizes = labelled.groupBy("root", "label").agg(F.count(F.lit(1)).alias("rows"))
    largest = sizes.groupBy("root").agg(F.max(F.struct("rows", "label"))["label"].alias("largest"))
    labelled = scratch.table(labelled.join(small(largest, 32), "root").withColumn("rest", F.col("label") != F.col("largest")).select("root", "unit", "node", "label", "rest", "shingles"))
    units = labelled.groupBy("root", "unit").agg(F.bool_or("rest").alias("has_rest")).select(F.col("root").alias("of"), F.col("unit").alias("other"), "has_rest")
    units = small(scratch.table(units), 48)
    near = (F.col("root") == F.col("of")) & (F.abs(F.col("unit.band") - F.col("other.band")) <= 1) & (F.col("unit") != F.col("other"))
    row = ["root", "node", "label", "shingles"]
    rest = labelled.filter("rest").join(units, near).select(*row, F.col("unit").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"))
    # Two units' rests meet once.
    sought = labelled.join(units.filter("has_rest"), near & (~F.col("rest") | (F.col("other") < F.col("unit")))).select(*row, F.col("other").alias("i"), F.col("unit").alias("j"), F.lit(1).alias("side"))
    return links.unionByName(scratch.table(_links(rest.unionByName(sought), percent)))


def near_groups(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (one row a component), text_hash."""
    scratch = Scratch(docs.sparkSession, "jaccard_join")
    base = own_columns(docs, "doc_id", "text")
    share = min(1.0, (100 - percent) / 100 * 5 / 3)
    cut = F.lit(int(-(1 << 63) + share * (1 << 64))) if share < 1 else F.lit((1 << 63) - 1)
    sets = base.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), shingle_set(F.col("text"), words).alias("s"))
    n = F.size("s")
    rows = sets.select(
        "doc_id", "text_hash", n.cast("long").alias("n_shingles"), F.xxhash64(F.lit(1), "s").alias("d1"), F.xxhash64(F.lit(2), "s").alias("d2"),
        F.size(F.filter("s", lambda h: h < cut)).alias("n_cut"), F.when(n > 0, n - least_overlap(n, percent) + 1).otherwise(0).cast("int").alias("prefix"), "s",
    )
    rows = scratch.table(rows.select("*", F.slice("s", F.lit(1), F.greatest("n_cut", "prefix")).alias("head")).drop("s").withColumn("rid", F.monotonically_increasing_id()))

    # 1. Shingles of the heads that two rows or more have, and the documents these leave open.
    heads = rows.select("rid", "n_cut", F.posexplode("head").alias("pos", "h")).select("rid", "h", (F.col("pos") < F.col("n_cut")).alias("below"))
    common = heads.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    found = heads.join(common, "h").groupBy("rid").agg(
        F.array_sort(F.collect_list(F.when(F.col("below"), F.struct("df", "h")))).alias("shared"), F.collect_list(F.when(~F.col("below"), F.col("h"))).alias("beyond")
    )
    alone = F.col("n_cut") - F.size("shared")
    first = F.concat(F.transform(F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.col("prefix") - alone)), lambda x: x["h"]), "beyond")
    open_ = rows.select("rid", "doc_id", "d1", "d2", "n_shingles", "n_cut", "prefix").join(found, "rid").filter(alone < F.col("prefix"))
    open_ = scratch.table(open_.select("rid", "doc_id", "d1", "d2", "n_shingles", first.alias("first")).filter(F.size("first") > 0))

    # 2. Classes of equal sets, their lists' stars, and the candidate groups.
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("doc_id"), F.col("rid").alias("rid")))
    classes = scratch.table(open_.groupBy("d1", "d2").agg(F.min("rid").alias("node"), lowest.alias("lowest"), F.first("n_shingles").alias("n")))
    nodes = classes.select(F.col("node").alias("rid"))
    lists = scratch.table(open_.join(nodes, "rid", "left_semi").select("rid", F.explode("first").alias("h")))
    stars = lists.groupBy("h").agg(F.min("rid").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "least")
    edges = lists.join(stars, "h").filter("rid > least").select(F.col("rid").alias("a"), F.col("least").alias("b")).distinct()
    members = connected_components(edges, scratch)

    # 3. The sets of the members, read again, and their links.
    members = scratch.table(members.join(classes.select("node", "d1", "d2", "n", F.col("lowest.doc_id").alias("doc_id")), "node"))
    wanted = small(members.select("doc_id").distinct(), 24)
    again = base.join(wanted, base["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi").select(shingle_set(F.col("text"), words).alias("shingles"))
    again = again.select(F.xxhash64(F.lit(1), "shingles").alias("d1"), F.xxhash64(F.lit(2), "shingles").alias("d2"), "shingles")
    again = scratch.table(again.join(members.drop("doc_id"), ["d1", "d2"]).dropDuplicates(["node"]).select("root", "node", "n", "shingles"))
    links = group_links(again, percent, scratch).select("a", "b")

    # 4. Components of the links, and of rows with equal sets.
    joined = classes.join(connected_components(links, scratch), "node", "left").withColumn("root", F.coalesce("root", "node"))
    joined = scratch.table(joined.select("root", "lowest", "d1", "d2"))
    # Written, so that both sides of the join are shuffled: a root of many classes is then split at run time.
    least = scratch.table(joined.groupBy("root").agg(F.min("lowest").alias("least")))
    result = scratch.table(joined.select("root", "d1", "d2").join(least, "root").select("d1", "d2", F.col("least.doc_id").alias("component_id"), F.col("least.rid").alias("keeper")))
    out = rows.select("doc_id", "n_shingles", "d1", "d2", "rid", "text_hash").join(result, ["d1", "d2"], "left")
    none = F.col("keeper").isNull()
    return scratch.keep(
        out.select("doc_id", "n_shingles", F.when(none, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), (none | (F.col("keeper") == F.col("rid"))).alias("kept"), "text_hash")
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component (the one of the smallest doc_id), with all columns."""
    return drop_rows(docs, near_groups(docs, words, percent), F.col("kept"))
