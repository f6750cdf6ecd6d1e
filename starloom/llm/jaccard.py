"""N-gram Jaccard join, size-aware: subsets for small sets, lists for large ones.

Two documents link when the Jaccard similarity of their sets of distinct word
shingles reaches the threshold. All sets are ordered alike: shingles of many
documents last (by the power of two of their number), else by hash. Sets that
link then share shingles among their first ones:

* a small set enumerates the 2-subsets of its first shingles; sets that share
  such a subset are candidates (selective, but quadratic in the prefix);
* a large set enters the inverted lists of its first shingles; the lists are
  scanned, and a pair stays a candidate if it shares as many first shingles as
  the threshold needs.

The boundary is where the subsets of a set become dearer than scanning its
lists, given the corpus' mean list. Sets near it do both, so no pair is lost.
Candidates are verified on the whole sets, exactly up to 64-bit hashing.

Equal sets are one node from the start. Of a list, first only the pairs with
its head are verified; the pairs of all the others follow in a second round,
but only between components, and only where enough lists hold both. So a group
of many near copies costs a few times its size as far as its members link with
its head; those that come close to a group without linking to it are compared
with its members one by one. No link that joins two components is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (WORD, WordHashes, components, give_back, grams_of, pack_sorted, power_of_two, ship, slices,
                     small_enough, unpack_sorted, written)

KEY_SHIFT = np.uint64(24)  # shingles are counted by the upper 40 bits of their hashes


def shingle_sets(texts: list[bytes | None], n: int, hashes: WordHashes) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending hashes. A text of fewer
    than ``n`` words has its whole sequence as one; without words, none."""
    per_doc = [hashes.of(t.lower() if t else None) for t in texts]
    out = []
    for h, g in zip(per_doc, grams_of(per_doc, n), strict=True):
        if 0 < len(h) < n:
            digest = hashlib.blake2b(h.tobytes(), digest_size=8).digest()
            g = np.frombuffer(digest, "<u8").astype(np.uint64)
        out.append(np.unique(g))
    return out


def node_of(shingles: np.ndarray) -> int:
    """The number of a set, the same for equal sets."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


class Rule:
    """The threshold as a fraction, and what follows from it for a set of n."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def least_shared(self, n):
        """A set of n shares at least so many with whatever it links to."""
        return -(-self.num * n // self.den)

    def prefix(self, n, k: int):
        """Sets that link share k of their first so many shingles."""
        return n - self.least_shared(n) + k

    def overlap(self, n, m):
        """Sets of n and m that link share so many."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def steps(self) -> int:
        """What a set needs to share of its first shingles grows with the size
        of a smaller partner. With that of a larger one it falls, by
        num**2 / (den * (num + den)) a shingle but for rounding: the least need
        is that of the largest partner or of one so many shingles smaller."""
        return -(-self.den * (self.num + self.den) // self.num ** 2) - 1

    def sizes_fit(self, n, m):
        return self.num * np.maximum(n, m) <= self.den * np.minimum(n, m)


def _each_set(batches, n: int, step: int = 256) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Other columns and shingle sets of some rows at a time; the text comes last."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            rows = batch.slice(at, step)
            yield rows, shingle_sets(rows.column(rows.num_columns - 1).to_pylist(), n, hashes)
    hashes.clear()
    give_back()


def _unseen(batches, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Node and set of each set that this task hasn't met yet."""
    seen: set[int] = set()
    for _, sets in _each_set(batches, n):
        for s in sets:
            if len(s) and (node := node_of(s)) not in seen:
                seen.add(node)
                yield node, s


def _count_shingles(texts: DataFrame, n: int, buckets: int, keep: int) -> DataFrame:
    """(key, n): how many sets have a shingle, where ``keep`` or more. A row
    with key -1 per bucket holds the sum of the squares of the smaller counts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, held = [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(some) >> KEY_SHIFT, return_counts=True)
            parts = slices(keys << KEY_SHIFT, buckets)
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in parts], pa.int32()),
                 pa.array([pack_sorted(keys[c]) for _, c in parts], pa.binary()),
                 pa.array([counts[c].astype("<u4").tobytes() for _, c in parts], pa.binary())],
                ["bucket", "keys", "counts"])

        for _, s in _unseen(batches, n):
            some.append(s)
            held += len(s)
            if held >= 500_000:
                yield flush()
                some, held = [], 0
        if some:
            yield flush()

    def total(part: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack_sorted(x) for x in part["keys"]])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in part["counts"]]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sums = np.add.reduceat(counts, first)
        many = sums >= keep
        rest = int((sums[~many] ** 2).sum())
        return pd.DataFrame({"key": np.append(keys[first][many].astype(np.int64), -1),
                             "n": np.append(sums[many], rest)})

    return texts.mapInArrow(emit, "bucket int, keys binary, counts binary").groupBy(
        "bucket").applyInPandas(total, "key long, n long")


def _lists(texts: DataFrame, n: int, rule: Rule, boundary: int, common, buckets: int) -> DataFrame:
    """(kind, sig, node, size, head, head_size): the members of lists of two or
    more sets that share a shingle (kind 1) or a 2-subset (kind 2) among their
    first ones. The head is the member that has the shingle earliest in its
    order: of copies of one text, the one with the fewest shingles of its own."""

    def signatures(s: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        keys, power = common.value
        rank = s >> np.uint64(8)
        if len(keys):
            key = s >> KEY_SHIFT
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            rank = rank | (np.where(keys[at] == key, power[at], 0).astype(np.uint64) << np.uint64(56))
        first = s[np.argsort(rank, kind="stable")]
        size = len(s)
        if rule.den * size > rule.num * boundary or size > boundary:
            p = first[:rule.prefix(size, 1)]
            yield 1, p, np.arange(len(p))
        if size <= boundary:
            p = first[:rule.prefix(size, 2)]
            i, j = np.triu_indices(len(p), 1)
            with np.errstate(over="ignore"):
                yield 2, (p[i] ^ (p[j] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93), i

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: dict[int, list] = {1: [], 2: []}
        held = 0

        def flush() -> pa.RecordBatch:
            rows = []
            for kind, got in some.items():
                if not got:
                    continue
                sig, at = (np.concatenate([g[i] for g in got]) for i in (0, 1))
                many = [len(g[0]) for g in got]
                node = np.repeat(np.array([g[2] for g in got], np.int64), many)
                size = np.repeat(np.array([g[3] for g in got], "<u4"), many)
                order = np.argsort(sig, kind="stable")
                sig, at, node, size = sig[order], at[order].astype("<u4"), node[order], size[order]
                rows += [(b, kind, pack_sorted(sig[c]), at[c].tobytes(), node[c].tobytes(), size[c].tobytes())
                         for b, c in slices(sig, buckets)]
                got.clear()
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                 *[pa.array(c, pa.binary()) for c in cols[2:]]],
                ["bucket", "kind", "sig", "at", "node", "size"])

        for node, s in _unseen(batches, n):
            # sets of so few shingles link to equal ones only, and those are one node
            if rule.least_shared(len(s) + 1) > len(s):
                continue
            for kind, sig, at in signatures(s):
                some[kind].append((sig, at, node, len(s)))
                held += len(sig)
            if held >= 300_000:
                yield flush()
                held = 0
        if held:
            yield flush()

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        sig = np.concatenate([unpack_sorted(x) for x in part["sig"]])
        node = np.concatenate([np.frombuffer(x, np.int64) for x in part["node"]])
        at, size = (np.concatenate([np.frombuffer(x, "<u4") for x in part[c]]).astype(np.int64)
                    for c in ("at", "size"))
        order = np.lexsort((at, node, sig))
        sig, at, node, size = sig[order], at[order], node[order], size[order]
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
        sig, at, node, size = sig[new], at[new], node[new], size[new]
        order = np.lexsort((node, at, sig))  # the head first
        sig, node, size = sig[order], node[order], size[order]
        start = np.concatenate([[True], sig[1:] != sig[:-1]])
        group = np.cumsum(start) - 1
        many = np.bincount(group)[group] >= 2
        head = np.flatnonzero(start)[group]
        return pd.DataFrame({"kind": np.int32(key[1]), "sig": sig.view(np.int64)[many],
                             "node": node[many], "size": size[many],
                             "head": node[head][many], "head_size": size[head][many]})

    return texts.mapInArrow(emit, "bucket int, kind int, sig binary, at binary, node binary, size binary").groupBy(
        "bucket", "kind").applyInPandas(
            gather, "kind int, sig long, node long, size long, head long, head_size long")


def _least(n: Column, m: Column, rule: Rule) -> Column:
    """So many of their first shingles (kind 1) or 2-subsets of them (kind 2)
    must sets of n and m share that link: what one of them has beyond its
    first ones is all that they could share more."""
    def up(x: Column) -> Column:  # the threshold's share of x, rounded up
        return F.ceil(rule.num * x / F.lit(rule.den))

    need = F.ceil(rule.num * (n + m) / F.lit(rule.num + rule.den)) - F.greatest(up(n), up(m)) + F.col("kind")
    return F.when(F.col("kind") == 1, need).otherwise((need * (need - 1) / 2).cast("long"))


def _promising(pairs: DataFrame, rule: Rule) -> DataFrame:
    """(a, b) of those ``pairs`` (kind, a, b, n, m, shared) whose sizes fit and
    which share enough."""
    n, m = F.col("n"), F.col("m")
    fits = rule.num * F.greatest(n, m) <= rule.den * F.least(n, m)
    return pairs.where(fits & (F.col("shared") >= _least(n, m, rule))).select("a", "b").distinct()


def _verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, text: str, n: int,
              rule: Rule) -> DataFrame:
    """Those ``pairs`` of nodes whose whole sets link. The sets come from one
    text of each node."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(rows.where("node IS NOT NULL").join(small_enough(nodes), "node", "left_semi").groupBy(
        "node").agg(F.min("text_hash").alias("text_hash")).select("text_hash").distinct(), "wanted")
    texts = docs.select(F.col(text).cast("binary").alias("t"), F.xxhash64(F.col(text)).alias("text_hash"))
    texts = texts.join(small_enough(wanted), "text_hash", "left_semi").select("t")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, s in _unseen(batches, n):
            yield pa.RecordBatch.from_arrays(
                [pa.array([node], pa.int64()), pa.array([s.tobytes()], pa.binary())], ["node", "s"])

    found = texts.mapInArrow(sets, "node long, s binary").groupBy("node").agg(F.first("s").alias("s"))
    found = written(found, "sets")

    def links(x: bytes, y: bytes) -> bool:
        p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(p) > len(q):
            p, q = q, p
        at = np.minimum(np.searchsorted(q, p), len(q) - 1)
        shared = int((q[at] == p).sum())
        return rule.den * shared >= rule.num * (len(p) + len(q) - shared)

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([links(p, q) for p, q in zip(x, y, strict=True)], dtype=bool)

    left = found.select(F.col("node").alias("a"), F.col("s").alias("x"))
    right = found.select(F.col("node").alias("b"), F.col("s").alias("y"))
    # the partner's set first: the head of a large group is in many pairs, its partners in few
    return written(pairs.join(right, "b").join(left, "a").where(linked("x", "y")).select("a", "b"), "links")


def _crossing(lists: DataFrame, groups: DataFrame, rule: Rule) -> DataFrame:
    """(kind, a, b, n, m, shared) of pairs in different components that may
    link, with all that they share. A node can link to a member of another
    component only if enough of its lists hold any member of that component;
    this is counted first, from the side of the smaller component, and pairs
    are made only where it holds. So a large component meets its outsiders as
    a whole and not member by member. Where it holds, a node is paired either
    with every member, whose lists are then compared, or with the members in
    each of its lists, which are then counted: whatever makes fewer rows."""
    known = lists.join(groups, "node", "left").select(
        "kind", "sig", "node", "size", F.coalesce("component", "node").alias("c"))
    sizes = groups.groupBy(F.col("component").alias("c")).agg(F.count("*").alias("members"))
    parts = known.groupBy("kind", "sig", "c").agg(
        F.min("size").alias("lo"), F.max("size").alias("hi"), F.count("*").alias("held")).join(
            sizes, "c", "left").na.fill(1, ["members"])
    mixed = parts.groupBy("kind", "sig").agg(F.count("*").alias("k")).where("k > 1").select("kind", "sig")
    parts = written(parts.join(mixed, ["kind", "sig"]), "list-parts")
    inside = written(known.join(parts.select("kind", "sig", "c", "members"), ["kind", "sig", "c"]), "list-members")
    other = parts.select("kind", "sig", F.col("c").alias("oc"), F.col("members").alias("om"), "lo", "hi", "held")
    fewer = F.struct("members", "c") < F.struct("om", "oc")
    fits = ((rule.num * F.col("lo") <= rule.den * F.col("size"))
            & (rule.num * F.col("size") <= rule.den * F.col("hi")))
    meets = inside.join(other, ["kind", "sig"]).where(fewer & fits).groupBy("kind", "node", "size", "oc", "om").agg(
        F.count("*").alias("shared"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("held").alias("by_list"))
    # what is needed is least for the smallest partner that fits or one of the largest
    low = F.greatest(F.col("lo"), F.ceil(rule.num * F.col("size") / F.lit(rule.den)))
    high = F.least(F.col("hi"), F.floor(rule.den * F.col("size") / F.lit(rule.num)))
    least = F.least(_least(F.col("size"), low, rule), *[
        _least(F.col("size"), F.greatest(low, high - k), rule) for k in range(rule.steps() + 1)])
    may = written(meets.where(F.col("shared") >= least).select("kind", "node", "oc", "om", "by_list"), "crossing")

    # every member: a component of one is its own member
    whole = may.where("om <= by_list")
    asked = whole.where("om = 1").select("kind", "node", F.col("oc").alias("other")).unionByName(
        whole.where("om > 1").join(groups.select(F.col("component").alias("oc"), F.col("node").alias("other")), "oc")
        .select("kind", "node", "other"))
    own = inside.groupBy("kind", "node").agg(F.first("size").alias("n"), F.collect_list("sig").alias("sigs"))
    own = written(own, "list-own")
    theirs = own.select("kind", F.col("node").alias("other"), F.col("n").alias("m"), F.col("sigs").alias("osigs"))
    fit = rule.num * F.greatest("n", "m") <= rule.den * F.least("n", "m")
    each = asked.join(own, ["kind", "node"]).join(theirs, ["kind", "other"]).where(fit).select(
        "kind", "node", "other", "n", "m", F.size(F.array_intersect("sigs", "osigs")).cast("long").alias("shared"))

    # members of the same lists
    mine = inside.select("kind", "sig", "node", F.col("size").alias("n")).join(
        may.where("om > by_list").select("kind", "node", "oc"), ["kind", "node"])
    theirs = inside.select("kind", "sig", F.col("c").alias("oc"), F.col("node").alias("other"),
                           F.col("size").alias("m"))
    met = mine.join(theirs, ["kind", "sig", "oc"]).groupBy("kind", "node", "other", "n", "m").agg(
        F.count("*").alias("shared"))
    turn = F.col("node") < F.col("other")
    return each.unionByName(met).select(
        "kind", F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"),
        F.when(turn, F.col("n")).otherwise(F.col("m")).alias("n"),
        F.when(turn, F.col("m")).otherwise(F.col("n")).alias("m"), "shared")


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text", max_common: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (of its set),
    component_id, the smallest doc_id that links lead to, itself included,
    text_hash and component (a number of its own; NULL without a set).

    Case of A-Z doesn't count. A text without words, or NULL, has no set and
    links with nothing; equal texts and repeated rows link. A NULL doc_id is
    no component_id unless all of the component are NULL. An empty table gives
    an empty one. Other columns are not read.

    ``max_common`` bounds the table of common shingles that is sent to all
    tasks (9 bytes each). It affects the order of shingles, so the cost, and
    never the result."""
    spark = ship(docs.sparkSession)
    rule = Rule(percent, 100)
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("h"),
                         F.col(text).cast("binary").alias("t"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, sets in _each_set(batches, shingle):
            yield pa.RecordBatch.from_arrays(
                [r.column(0), r.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())],
                ["doc_id", "text_hash", "n_shingles", "node"])

    rows = written(narrow.mapInArrow(
        measure, "doc_id long, text_hash long, n_shingles long, node long"), "shingle-rows")
    texts = docs.select(F.col(text).cast("binary").alias("t"))
    total = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]

    counts = written(_count_shingles(texts, shingle, power_of_two(total / 1e6, 32), 8), "shingle-counts")
    common = counts.where("key >= 0").withColumn("power", F.floor(F.log2("n")).cast("int"))
    sizes = sorted(common.groupBy("power").count().collect(), reverse=True)  # 64 rows at most
    least, held = 64, 0
    for power, many in sizes:
        if held + many > max_common:
            break
        least, held = power, held + many
    table = common.where(F.col("power") >= least).select("key", "power").toPandas().sort_values("key")
    order = spark.sparkContext.broadcast((table["key"].to_numpy().astype(np.uint64),
                                          table["power"].to_numpy(np.uint8)))
    # what a list entry costs: itself, and the others that it meets on the mean
    met = (counts.where("key < 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) / max(total, 1)
    boundary = max((n for n in range(1, 2000) if rule.prefix(n, 2) * (rule.prefix(n, 2) - 1) / 2
                    <= rule.prefix(n, 1) * max(1.0, met)), default=0)

    entries = total * (100 - percent) / 100 + rows.count()
    lists = written(_lists(texts, shingle, rule, boundary, order, power_of_two(entries / 5e5, 32)), "lists")
    order.destroy()  # the lists are written: no task needs it again
    apart = lists.where("node != head")
    low = F.col("head") < F.col("node")
    star = apart.groupBy(
        "kind", F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"),
        F.when(low, F.col("head_size")).otherwise(F.col("size")).alias("n"),
        F.when(low, F.col("size")).otherwise(F.col("head_size")).alias("m")).agg(
            F.count("*").alias("shared"))
    first = written(_promising(star, rule), "pairs")
    links = _verified(first, rows, docs, text, shingle, rule)
    groups = written(components(links), "components")
    second = written(_promising(_crossing(lists, groups, rule), rule).join(first, ["a", "b"], "left_anti"),
                     "pairs")
    if second.limit(1).count():
        more = _verified(second, rows, docs, text, shingle, rule)
        groups = written(components(links.unionByName(more)), "components")

    classes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node"))
    ids = classes.groupBy("c").agg(F.min("least").alias("component_id"))
    to = written(classes.join(ids, "c").select("node", "component_id", F.col("c").alias("component")), "classes")
    return rows.join(small_enough(to), "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"), "text_hash", "component")


def keep_one_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one
    with the smallest doc_id (NULL last; equal ids: the smaller hash of the
    text). Documents without words stay; of rows equal in id and text that
    aren't empty one stays. All other columns stay as they are, whatever their
    names."""
    rows = written(near_duplicates(docs, doc_id=doc_id, text=text, **options), "near-duplicates")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash")
    first = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(place).alias("p"))
    keep = written(first.select("p.doc_id", "p.text_hash").unionByName(
        rows.where("component IS NULL").select("doc_id", "text_hash")).distinct(), "kept")
    # the row travels as one column, so that no name of its own is taken
    whole = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("t"),
                        F.xxhash64(F.col(text)).alias("h")).alias("d")
    kept = whole.join(small_enough(keep).alias("k"), F.col("d.id").eqNullSafe(F.col("k.doc_id"))
                      & (F.col("d.h") == F.col("k.text_hash")), "left_semi")
    again = rows.where("component IS NOT NULL").groupBy("doc_id", "text_hash").count().where("count > 1")
    if again.limit(1).count():
        empty = F.regexp_count(F.coalesce(F.col("t"), F.lit("")), F.lit(WORD)) == 0
        kept = kept.where(empty).unionByName(kept.where(~empty).dropDuplicates(["id", "h"]))
    return kept.select("row.*")
