"""The prefix trie of conversations, as double arrays of prefix shards.

Conversations are sequences of turn codes, 16 bytes for each turn; texts are read for their
code and words and never move. Equal sequences are one, sorted, and cut into shards of
neighbours, so a shard holds whole subtrees and shares only the nodes on the path to the shard
before or after it. A shard numbers its distinct turns densely, packs its nodes into BASE and CHECK
(the child by turn t of the node at s is at BASE[s] + t, if CHECK there is s) and follows every
sequence through them to count. What shards say of a shared node is added up: a node belongs to the
first shard that has it, so nothing is counted twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.llm.ship import ship
from tuneframe.session import settle

#: Bytes of a turn's code, the beginning of a SHA-256.
CODE = 16
#: Free places that are tried for a node's children before they go to the end of the arrays.
TRIES = 64
#: Conversations whose numbers are joined to one text before the rest of a digest.
JOINED = 4096
NOTHING = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """A trie over dense labels from 0, in two arrays that grow as nodes are added."""

    def __init__(self, expected: int = 1024):
        size = max(16, 2 * expected)
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.check[0] = 0  # the root is at place 0 and its own parent
        self.low, self.top = 1, 0  # no place below `low` is free, all beyond `top` are

    def _reach(self, place: int) -> None:
        if place >= len(self.check):
            more = max(place + 1, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _free(self, n: int, start: int = 0) -> np.ndarray:
        """The first n free places from `start` on."""
        at, width = max(start, self.low), 4 * n
        while True:
            self._reach(at + width)
            found = np.flatnonzero(self.check[at : at + width] < 0)[:n] + at
            if len(found) and at == self.low:
                self.low = at = int(found[0])
            if len(found) == n:
                return found
            width *= 2

    def add(self, parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Places of new children: all children of each parent, side by side, their labels in any order."""
        places = np.empty(len(parents), np.int64)
        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]])) if len(parents) else np.zeros(0, np.int64)
        ends = np.concatenate([starts[1:], [len(parents)]])
        many = np.flatnonzero(ends - starts > 1)
        for g in many[np.argsort(starts[many] - ends[many], kind="stable")]:  # those with most children first
            a, b = starts[g], ends[g]
            places[a:b] = self._fit(int(parents[a]), labels[a:b])
        single = starts[ends - starts == 1]
        if len(single):  # an only child can go to any free place
            spots = self._free(len(single))
            self.check[spots] = parents[single]
            self.base[parents[single]] = spots - labels[single]
            places[single] = spots
            self.low, self.top = int(spots[-1]) + 1, max(self.top, int(spots[-1]))
        return places

    def _fit(self, parent: int, labels: np.ndarray) -> np.ndarray:
        least, span = int(labels.min()), int(labels.max() - labels.min())
        n = max(1, min(TRIES, (1 << 21) // len(labels)))
        # the first free places, and some among the last nodes, where wide families leave room
        tried = np.concatenate([self._free(n), self._free(n, self.top - 2 * span)]) - least
        self._reach(int(tried.max()) + least + span)
        fits = (self.check[tried[:, None] + labels[None, :]] < 0).all(axis=1)
        if fits.any():
            base = int(tried[fits.argmax()])
        else:
            base = self.top + 1 - least
            self._reach(base + least + span)
        spots = base + labels
        self.base[parent], self.check[spots], self.top = base, parent, max(self.top, int(spots.max()))
        return spots

    def step(self, places: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children by the labels; -1 where there is none."""
        to = self.base[places] + labels
        inside = (to >= 0) & (to < len(self.check))
        found = np.where(inside, to, 0)
        return np.where(inside & (to != 0) & (self.check[found] == places), to, -1)


def build(sequences: list[np.ndarray]) -> tuple[DoubleArray, list[np.ndarray]]:
    """The trie of sorted label sequences, and for each depth from 1 the places of its nodes in order."""
    lengths = np.array([len(x) for x in sequences])
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    flat = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.int64)
    trie, levels = DoubleArray(len(flat)), []
    at, place, depth = np.arange(len(sequences)), np.zeros(len(sequences), np.int64), 0
    while True:
        go = lengths[at] > depth
        at, place = at[go], place[go]
        if not len(at):
            return trie, levels
        label = flat[starts[at] + depth]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (label[1:] != label[:-1])])
        spots = trie.add(place[new], label[new])
        levels.append(spots)
        place = spots[np.cumsum(new) - 1]
        depth += 1


def common(a: bytes | None, b: bytes | None) -> int:
    """Turns that two code sequences begin with alike; -1 if there is no sequence."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // CODE
    x, y = (np.frombuffer(c, np.uint8)[: n * CODE].reshape(n, CODE) for c in (a, b))
    unlike = np.flatnonzero((x != y).any(axis=1))
    return int(unlike[0]) if len(unlike) else n


def path_keys(codes: bytes, depth: int) -> list[str]:
    """A name for each prefix of up to `depth` turns."""
    h, out = hashlib.sha256(), []
    for d in range(depth + 1):
        h.update(codes[(d - 1) * CODE : d * CODE] if d else b"")
        out.append(f"{d}:{h.hexdigest()}")
    return out


NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, key string, parent_key string"


def nodes_of(pdf: pd.DataFrame, before: bytes | None, after: bytes | None) -> pd.DataFrame:
    """The nodes of one shard: codes, words, n_convs, conv_id, ends of its sequences, sorted by codes.

    before and after are the last sequence of the shard before and the first of the next. A
    node that they have too has a key, and what is said of it holds for this shard alone; a
    child of such a node has no parent_conv_id but the parent's key.
    """
    codes = pdf["codes"].tolist()
    lengths = np.array([len(c) // CODE for c in codes])
    flat = np.frombuffer(b"".join(codes), f"S{CODE}")
    _, labels = np.unique(flat, return_inverse=True)  # dense turn ids
    cuts = np.concatenate([[0], np.cumsum(lengths)])
    sequences = [labels[a:b].astype(np.int64) for a, b in zip(cuts, cuts[1:])]
    trie, levels = build(sequences)
    size = len(trie.check)
    spoken = np.concatenate([np.asarray(w, np.int64) for w in pdf["words"]]) if len(flat) else np.zeros(0, np.int64)
    n, least, words = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)
    ends = np.full(size, None, object)
    many, first = pdf["n_convs"].to_numpy(), pdf["conv_id"].to_numpy()
    # every sequence is followed through the arrays
    at, place, depth = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
    own_first, own_last = [0], [0]  # the paths of the first and the last sequence
    while True:
        np.add.at(n, place, many[at])
        np.minimum.at(least, place, first[at])
        done = lengths[at] == depth
        ends[place[done]] = pdf["ends"].to_numpy()[at[done]]
        at, place = at[~done], place[~done]
        if not len(at):
            break
        turn = cuts[at] + depth
        place = trie.step(place, labels[turn])
        if (place < 0).any():
            raise ValueError("a sequence left its trie")
        words[place] = spoken[turn]
        depth += 1
        for path, i in ((own_first, 0), (own_last, len(codes) - 1)):
            spot = np.flatnonzero(at == i)
            if len(spot):
                path.append(int(place[spot[0]]))
    order = np.concatenate([[0], *levels]).astype(np.int64)
    depths = np.zeros(size, np.int32)
    for d, spots in enumerate(levels, 1):
        depths[spots] = d
    # of the paths to the neighbours
    left, right = common(before, codes[0]), common(codes[-1], after)
    elsewhere = np.zeros(size, bool)  # belongs to a shard before
    elsewhere[own_first[: left + 1]] = True
    keys = np.full(size, None, object)
    for path, c, shared in ((own_first, codes[0], left), (own_last, codes[-1], right)):
        if shared >= 0:
            keys[path[: shared + 1]] = path_keys(c, shared)
    # sums of subtrees, from the deepest nodes up
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), n * words
    saved[~elsewhere] -= words[~elsewhere]
    inner = np.zeros(size, bool)
    inner[trie.check[order[1:]]] = True
    if right == lengths[-1]:  # the last sequence goes on in the next shard
        inner[own_last[-1]] = True
    leaves[order] = ~inner[order]
    for spots in reversed(levels):
        up = trie.check[spots]
        np.add.at(children, up, ~elsewhere[spots])
        np.add.at(leaves, up, leaves[spots])
        np.add.at(saved, up, saved[spots])
    parent = trie.check[order]
    above = keys[parent]
    above[0] = None
    known = np.array([k is None for k in above])
    known[0] = False  # the root has no parent
    return pd.DataFrame({
        "conv_id": least[order], "depth": depths[order], "parent_conv_id": pd.array(np.where(known, least[parent], 0), "Int64"),
        "n_convs": n[order], "n_children": children[order], "n_leaves": leaves[order], "saved_tokens": saved[order],
        "ends_sha256": ends[order], "key": keys[order], "parent_key": above,
    }).assign(parent_conv_id=lambda x: x["parent_conv_id"].where(known))


def rebuilt(turns: DataFrame, conv: str, turn: str, role: str, text: str, share: int, heads: int) -> DataFrame:
    """conv_id, codes (CODE bytes for each turn) and words (for each turn) of each rebuilt conversation."""
    r, t = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    code = F.substring(F.sha2(F.concat_ws(":", F.octet_length(r).cast("string"), F.concat(r, t)), 256), 1, 2 * CODE)
    number = F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+"))
    c = F.col(f"`{conv}`").cast("long")
    rows = turns.filter(c.isNotNull()).select(c.alias("conv_id"), (c - c % share).alias("root"), F.struct(F.col(f"`{turn}`").alias("turn"), code.alias("code"), number.cast("int").alias("n")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.min("root").alias("root"), F.sort_array(F.collect_list("t")).alias("ts"))
    whole = whole.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int"))
    first = settle(whole.withColumn("ts", F.transform("ts", lambda x: F.struct(x["code"].alias("code"), x["n"].alias("n")))))
    head = first.filter("conv_id = root").select("root", F.slice("ts", 1, heads - 1).alias("head"))
    lent = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("ts", 1, 0))
    made = first.join(head, "root", "left").select("conv_id", F.concat(lent, F.slice("ts", F.col("h") + 1, F.size("ts"))).alias("ts"))
    return made.select("conv_id", F.unhex(F.array_join("ts.code", "")).alias("codes"), F.col("ts.n").alias("words"))


def digests(members: DataFrame) -> DataFrame:
    """(same, ends): SHA-256 of each group's conv_ids, ascending and joined by commas; few groups of one are among them.

    The ids are sorted and put into texts where they lie, slices of a group of any size side by
    side; what then meets is a text for each JOINED ids, and only the digest itself reads them in order.
    """
    sliced = settle(members.select("same", "conv_id")).repartitionByRange("same", "conv_id").sortWithinPartitions("same", "conv_id")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            same, ids, out = pdf["same"].to_numpy(), pdf["conv_id"].tolist(), []
            starts = np.concatenate([[0], np.flatnonzero(same[1:] != same[:-1]) + 1])
            ends = np.concatenate([starts[1:], [len(same)]])
            kept = ends - starts > 1
            kept[[0, -1]] = True  # these may go on in another batch
            for a, b in zip(starts[kept], ends[kept]):
                out += [(same[a], ids[at], ",".join(map(str, ids[at : min(b, at + JOINED)]))) for at in range(a, b, JOINED)]
            yield pd.DataFrame(out, columns=["same", "first", "text"])

    parts = sliced.mapInPandas(join, "same string, first long, text string")
    ordered = parts.repartition("same").sortWithinPartitions("same", "first")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, h = None, None
        for pdf in batches:
            out = []
            for same, text in zip(pdf["same"], pdf["text"]):
                if same != now:
                    if now is not None:
                        out.append((now, h.hexdigest()))
                    now, h = same, hashlib.sha256(text.encode())
                else:
                    h.update(b"," + text.encode())
            yield pd.DataFrame(out, columns=["same", "ends"])
        if now is not None:
            yield pd.DataFrame([(now, h.hexdigest())], columns=["same", "ends"])

    return ordered.mapInPandas(digest, "same string, ends string")


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", share: int = 20, heads: int = 4) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, one row each.

    Conversation c begins with the first crc32(c) % heads turns of c - c % share and goes on
    with its own turns after as many. Turns are in order of `turn`, null first, and of their
    codes where that ties, so equal turns are repeated turns; null roles and texts are empty.
    Rows: conv_id (least member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, words of a node's last text for each member but
    one), ends_sha256 (of the members that end there). Rows without conv_id are in no conversation;
    a table without any has no nodes, not even the root. Other columns are not looked at. A
    conversation's codes, 16 bytes for each turn, are held in one row; its texts are not.
    """
    ship(turns.sparkSession)
    made = settle(rebuilt(turns, conv, turn, role, text, share, heads).withColumn("same", F.sha2("codes", 256)))
    grouped = made.groupBy("same").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("codes").alias("codes"), F.first("words").alias("words"))
    single = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    sequences = grouped.join(digests(made), "same", "left").withColumn("ends", F.coalesce("ends", single)).drop("same")
    sharded = settle(settle(sequences).repartitionByRange("codes").withColumn("shard", F.spark_partition_id()))
    rows = settle(_shards(sharded))

    inside = rows.filter("key IS NULL")
    partial = rows.filter("key IS NOT NULL").groupBy("key")
    add = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    # the paths to neighbours: no more nodes than twice the turns of a sequence for each shard
    merged = settle(partial.agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *add, F.max("ends_sha256").alias("ends_sha256"), F.max("parent_key").alias("parent_key")))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    below = inside.filter("parent_key IS NOT NULL").drop("parent_conv_id").unionByName(merged.select(*[c for c in inside.columns if c != "parent_conv_id"]))
    below = below.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("__parent"))
    out = inside.filter("parent_key IS NULL").select(*columns).unionByName(below.select(*columns))
    # a shared node that is no child of a shared one is the root
    return out.select(F.col("conv_id").alias(conv), F.col("depth").cast("long").alias("depth"), *columns[2:-1], F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def _shards(sharded: DataFrame) -> DataFrame:
    """The nodes of every shard. The driver knows which shards have rows, and nothing of their sequences."""
    ends = settle(sharded.groupBy("shard").agg(F.min("codes").alias("first"), F.max("codes").alias("last")))
    full = sorted(r["shard"] for r in ends.select("shard").collect())
    spark = sharded.sparkSession
    beside = spark.createDataFrame([(b, a, c) for a, b, c in zip([None, *full], full, [*full[1:], None])], "shard int, left int, right int")
    before = ends.select(F.col("shard").alias("left"), F.col("last").alias("before"))
    after = ends.select(F.col("shard").alias("right"), F.col("first").alias("after"))
    halo = beside.join(before, "left", "left").join(after, "right", "left").select("shard", "before", "after")

    def make(key: tuple, own: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame(columns=[x.split()[0] for x in NODE.split(", ")])
        return nodes_of(own.sort_values("codes", ignore_index=True), edge["before"].iat[0], edge["after"].iat[0])

    return sharded.groupBy("shard").cogroup(halo.groupBy("shard")).applyInPandas(make, NODE)
