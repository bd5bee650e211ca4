"""Exact n-gram Jaccard join by set relations: links between documents and their components.

1. A document's set holds the 64-bit hashes of its distinct shingles. Equal sets are one
   set with a number of copies. Elements of a single set cannot overlap with anything;
   `recurring` finds the others, and sets with too few of them cannot have a partner.
2. In the order of rising frequency, linked sets share an element among their first
   n - ceil(t n) + 1. Sets that share such an element are grouped (components of a graph
   of stars); all links lie inside groups. A group beyond BLOCK sets is worked on as
   pairs of blocks, so no task holds more than two blocks.
3. In a task, hubs are indexed: each element's list is kept in blocks by position, and a
   block is skipped if its position leaves too little overlap. A set close to a hub is
   kept as its difference from the hub. A probing set meets every hub within twice the
   distance, and its overlap with each set around the hub is derived from its overlap
   with the hub and the two differences, without looking at the set itself.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.components import connected_components
from tuneframe.llm.recurring import BLOCKS, blocks, in_batches, partitions_of, recurring
from tuneframe.llm.ship import release, with_key
from tuneframe.llm.words import Words, mix, pieces
from tuneframe.session import settle

#: Sets of one block of a large group: two blocks are in memory at once.
BLOCK = 4096
SHORT_SEED = np.uint64(0x2545F4914F6CDD1D)


def shingle_sets(w: Words, size: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; texts of fewer words are one shingle."""
    at, keys = w.windows(size)
    doc = w.doc[at] if len(at) else at
    order = np.lexsort((keys, doc))
    doc, keys = doc[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    doc, keys = doc[new], keys[new]
    sets = np.split(keys, np.searchsorted(doc, np.arange(1, len(w.counts))))
    for i in np.flatnonzero((w.counts > 0) & (w.counts < size)):
        whole = SHORT_SEED
        for h in w.hashes[w.first[i] : w.first[i + 1]]:
            whole = mix(np.array([whole ^ h]))[0]
        sets[i] = np.array([whole], np.uint64)
    return sets


def _need(n: np.ndarray | int, percent: int):
    """The least overlap of a set of n elements with a partner."""
    return -(-percent * n // 100)


class Hubs:
    """Sets around hubs, indexed to find the hubs near a set and to derive overlaps."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, n_elements: int, percent: int):
        self.percent, self.wide = percent, max(1, 2 * percent - 100)
        self.mask = np.zeros(n_elements, bool)
        self.sets, self.sizes = sets, sizes
        #: element -> position -> the largest size and the hubs that have it there
        self.index: dict[int, dict[int, list[int]]] = defaultdict(dict)
        self.hubs: list[int] = []
        self.around: list[list[int]] = []
        for i in range(len(sets)):
            near = self.near(sets[i], int(sizes[i]), percent)
            best = max(near, key=lambda x: x[1] / (sizes[i] + self.sizes[self.hubs[x[0]]] - x[1]), default=None)
            if best is None:
                self._add(i)
            else:
                self.around[best[0]].append(i)
        self._differences()

    def _prefix(self, elements: np.ndarray, n: int, percent: int) -> tuple[list[int], int]:
        """The elements of a set's prefix, and the position of the first: those of a single set come before."""
        own = n - len(elements)
        return elements[: max(0, n - _need(n, percent) + 1 - own)].tolist(), own

    def _add(self, i: int) -> None:
        elements, own = self._prefix(self.sets[i], int(self.sizes[i]), self.wide)
        for at, x in enumerate(elements, own):
            block = self.index[x].setdefault(at, [0])
            block[0] = max(block[0], int(self.sizes[i]))
            block.append(len(self.hubs))
        self.hubs.append(i)
        self.around.append([i])

    def near(self, elements: np.ndarray, n: int, percent: int) -> list[tuple[int, int]]:
        """(hub, overlap) of the hubs with at least `percent` similarity."""
        prefix, own = self._prefix(elements, n, percent)
        found: set[int] = set()
        need = _need(n, percent)
        for at, x in enumerate(prefix, own):
            if n - at < need:
                break
            for there, block in self.index.get(x, {}).items():
                # If x is the first element in common, all before it differ and the rest bounds the overlap;
                # if it is not, an earlier one has already found the hub.
                if block[0] - there >= need:
                    found.update(block[1:])
        if not found:
            return []
        self.mask[elements] = True
        out = []
        for h in found:
            overlap = int(np.count_nonzero(self.mask[self.sets[self.hubs[h]]]))
            if 100 * overlap >= percent * (n + int(self.sizes[self.hubs[h]]) - overlap):
                out.append((h, overlap))
        self.mask[elements] = False
        return out

    def _differences(self) -> None:
        self.flat = []
        for h, members in zip(self.hubs, self.around):
            hub = self.sets[h]
            self.mask[hub] = True
            plus = [x[~self.mask[x]] for x in (self.sets[m] for m in members)]
            self.mask[hub] = False
            minus = []
            for m in members:
                self.mask[self.sets[m]] = True
                minus.append(hub[~self.mask[hub]])
                self.mask[self.sets[m]] = False
            cuts = [np.concatenate([[0], np.cumsum([len(x) for x in part])]) for part in (plus, minus)]
            self.flat.append((np.array(members), np.concatenate(plus), cuts[0], np.concatenate(minus), cuts[1]))

    def linked(self, elements: np.ndarray, n: int) -> np.ndarray:
        """All indexed sets that link with this one."""
        near = self.near(elements, n, self.wide)
        if not near:
            return np.zeros(0, np.int64)
        out = []
        self.mask[elements] = True
        for h, overlap in near:
            members, plus, plus_at, minus, minus_at = self.flat[h]
            if len(members) == 1:
                overlaps = np.array([overlap])
            else:
                more = np.concatenate([[0], np.cumsum(self.mask[plus])])
                less = np.concatenate([[0], np.cumsum(self.mask[minus])])
                overlaps = overlap + np.diff(more[plus_at]) - np.diff(less[minus_at])
            out.append(members[100 * overlaps >= self.percent * (n + self.sizes[members] - overlaps)])
        self.mask[elements] = False
        return np.concatenate(out)


def links_of(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(a, b, n_links): each set with the least set of its component here and its links here.

    Rows of role 1 are indexed, rows of role 2 probe them, rows of role 0 do both.
    """
    pdf = pdf.sort_values("set_key", ignore_index=True)
    parts = [np.frombuffer(x, np.uint64) for x in pdf["elements"]]
    values, local, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, times))] = np.arange(len(values))
    local = rank[local]
    sets = [np.sort(x) for x in np.split(local, np.cumsum([len(x) for x in parts])[:-1])]
    sizes, copies, role = pdf["n"].to_numpy(), pdf["copies"].to_numpy(), pdf["role"].to_numpy()
    indexed = np.flatnonzero(role < 2)
    indexed = indexed[np.argsort(sizes[indexed], kind="stable")]
    hubs = Hubs([sets[i] for i in indexed], sizes[indexed], len(values), percent)
    label, n_links = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    for x in np.flatnonzero(role != 1):
        others = indexed[hubs.linked(sets[x], int(sizes[x]))]
        others = others[others != x]
        if not len(others):
            continue
        n_links[x] += copies[others].sum()
        if role[x] == 2:
            n_links[others] += copies[x]
        labels = np.unique(np.append(label[others], label[x]))
        for old in labels[1:]:
            label[label == old] = labels[0]
    keys = pdf["set_key"].to_numpy()
    return pd.DataFrame({"a": keys, "b": keys[label], "n_links": n_links})


def document_sets(df: DataFrame, text: str, key: str, size: int, percent: int) -> DataFrame:
    """key, n, set_key (null without words), elements (of sets that can have a partner, rare ones first)."""
    docs = in_batches(df, text, key)
    n_buckets = partitions_of(df)

    def name(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [x for _, group in pieces(pdf["text"].tolist()) for x in shingle_sets(Words(group, lower=True), size)]
        return blocks(pdf["batch"].iloc[0], np.concatenate(keys), n_buckets, kind=np.uint32)

    def sets(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        known = np.zeros(0, np.uint64)
        times = np.zeros(0, np.uint8)
        if len(told):
            known = np.concatenate([np.frombuffer(k, np.uint32) + (np.uint64(b) << np.uint64(32)) for b, k in zip(told["bucket"], told["keys"])])
            times = np.frombuffer(b"".join(told["counts"]), np.uint8)
            order = np.argsort(known)
            known, times = known[order], times[order]
        out, sent = [], set()
        for _, group in pieces(pdf["text"].tolist()):
            for x in shingle_sets(Words(group, lower=True), size):
                n, set_key, elements = len(x), None, None
                if n:
                    set_key = hashlib.blake2b(x.tobytes(), digest_size=16).hexdigest()
                    narrow = (x & np.uint64(0xFFFFFFFF)) + (((x >> np.uint64(40)) % np.uint64(n_buckets)) << np.uint64(32))
                    at = np.searchsorted(known, narrow)
                    at[at == len(known)] = 0
                    shared = known[at] == narrow if len(known) else np.zeros(n, bool)
                    if shared.sum() >= _need(n, percent) and set_key not in sent:
                        sent.add(set_key)
                        kept = x[shared]
                        elements = kept[np.lexsort((kept, times[at[shared]]))].tobytes()
                out.append((n, set_key, elements))
        n, k, e = zip(*out)
        return pd.DataFrame({"key": pdf["key"].array, "n": n, "set_key": k, "elements": e})

    told = recurring(docs.groupBy("batch").applyInPandas(name, BLOCKS), np.uint32, counts=True)
    return docs.groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(sets, "key string, n long, set_key string, elements binary")


def node_of(set_key: str) -> Column:
    """A set in the graph that groups sets: a 64-bit hash, as shingles are, because edges are many and settled.

    Two sets with one hash are put in one group, which costs time alone; only if they are each other's sole partners is a link lost.
    """
    return F.xxhash64(set_key)


def jaccard_components(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of df: key, n_shingles, component_id (least linked key), n_links.

    Two rows link when 100 * intersection >= percent * union of their shingle sets; n_links
    counts the other rows linked with this one. A null or blank text has no shingles, no
    links and its own key as component. Null keys are never the least; repeated rows link.
    Other columns are not looked at. percent is from 51 to 100.
    """
    kind = df.schema[key].dataType
    rows = settle(document_sets(df, text, key, size, percent))
    release(df.sparkSession)
    typed = F.col("key").cast(kind)
    same = rows.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.min(typed).alias("first"), F.count("*").alias("copies"))
    sets = rows.filter("elements IS NOT NULL").dropDuplicates(["set_key"]).select("set_key", "n", "elements")

    def prefixes(batches):
        for pdf in batches:
            out = []
            for n, e in zip(pdf["n"], pdf["elements"]):
                elements = np.frombuffer(e, np.uint64)
                length = max(0, n - int(_need(n, percent)) + 1 - (n - len(elements)))
                out.append(elements[:length].astype(np.int64))
            yield pd.DataFrame({"a": pdf["node"], "tokens": out})

    sets = settle(sets)
    release(df.sparkSession)
    posted = sets.select(node_of("set_key").alias("node"), "n", "elements").mapInPandas(prefixes, "a long, tokens array<long>").select("a", F.explode("tokens").alias("token"))
    hub = posted.groupBy("token").agg(F.min("a").alias("b"), F.count("*").alias("times")).filter("times > 1")
    groups = settle(connected_components(posted.join(hub, "token").select("a", "b").unionByName(hub.select("b", F.col("b").alias("a")))))
    release(df.sparkSession)
    blocks_of = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("k"))
    n_tasks = 4 * partitions_of(df)
    mine = F.pmod(F.xxhash64("set_key"), F.col("k")).cast("int")
    task = F.when(F.col("k") == 1, F.array(F.struct(F.concat(F.lit("small:"), F.pmod(F.xxhash64("component"), F.lit(n_tasks))).alias("task"), F.lit(0).alias("role")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("k") - 1),
            lambda j: F.struct(
                F.concat_ws(":", "component", F.least(F.col("mine"), j), F.greatest(F.col("mine"), j)).alias("task"),
                F.when(F.col("mine") == j, 0).when(F.col("mine") < j, 1).otherwise(2).alias("role"),
            ),
        )
    )
    grouped = same.select("set_key", "copies", node_of("set_key").alias("node")).join(groups.join(blocks_of, "component"), "node")
    dealt = sets.join(grouped.drop("node"), "set_key")
    dealt = dealt.withColumn("mine", mine).withColumn("t", F.explode(task)).select("t.task", "t.role", "set_key", "n", "copies", "elements")
    found = settle(dealt.groupBy("task").applyInPandas(lambda pdf: links_of(pdf, percent), "a string, b string, n_links long"))
    release(df.sparkSession)
    linked = connected_components(found).withColumnRenamed("node", "set_key")
    links = found.groupBy(F.col("a").alias("set_key")).agg(F.sum("n_links").alias("n_links"))
    whole = same.join(linked, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    least = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = whole.join(least, "component").join(links, "set_key", "left").select("set_key", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    made = rows.select("key", "n", "set_key").join(answer, "set_key", "left")
    made = made.select("key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(typed).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return with_key(made, df, key)
