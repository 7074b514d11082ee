"""Prefix trie of conversations: members, children, leaves and saved tokens of every distinct prefix.

Turns (role, text) are encoded as ids of a dictionary of the distinct turns.
Conversations are dealt to shards by ranges of (sequence of turn ids, conv_id),
so a common first turn, or copies of one conversation, spread over as many
shards as their rows fill.  Each shard inserts its distinct sequences into a
ternary search tree, medians first, which balances it, and one iterative
traversal accumulates members, leaves and savings.

Only nodes on the path of a shard's first or last sequence can also lie in
another shard: the boundary nodes.  They are merged by a digest of their path.
What a shard found below a boundary node adds up over shards; what depends on
all members of boundary nodes (their own saving, whether they are leaves) is
added along their preorder, in which a subtree is one range: nodes are ordered
by (first path that holds them, depth), so a subtree's sum is the difference of
two running totals over paths.

Cases: null role or text count as empty; a null turn comes first; turns with
equal turn numbers are ordered by the digest of (role, text), and rows given
twice are two turns.  Rows without conv_id belong to no conversation.  A
conversation that has no turn after rebuilding ends at the root.  An empty
table has no nodes.  Other columns, whatever their names, are left out.

Bounds: one conversation's ids and the list of a shard's sequences fit in a
task (``SHARD_TURNS`` turns); the hash over the member list of a node that many
shards hold is streamed in constant memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklens.llm.shared import written

#: Rebuilt turns of a shard, about.
SHARD_TURNS = 200_000
#: Every dictionary entry with this share of all turns or more is broadcast: so many entries at most.
HOT_ENTRIES = 1000
#: Conversation ids in one part of a boundary node's member list.
ENDS_PART = 1000
#: Paths whose running totals are summed in one group.
PATHS_GROUP = 4096

_ROOT = hashlib.sha256(b"").digest()
_EMPTY = hashlib.sha256(b"").hexdigest()


class TernaryTree:
    """A ternary search tree over sequences of integers; node 0 is the root, ``down[k]`` the tree of k's children."""

    def __init__(self):
        self.key, self.low, self.high, self.down, self.parent, self.size = [0], [-1], [-1], [-1], [-1], [0]
        self.ends: dict[int, list[int]] = {}

    def _new(self, key: int, parent: int, size: int) -> int:
        for column, value in ((self.key, key), (self.low, -1), (self.high, -1), (self.down, -1), (self.parent, parent), (self.size, size)):
            column.append(value)
        return len(self.key) - 1

    def insert(self, keys: list[int], sizes: list[int], ends: list[int]) -> list[int]:
        """The nodes of a sequence from the root on."""
        at, path = 0, [0]
        for key, size in zip(keys, sizes):
            side, here, last = self.down, self.down[at], at
            while here >= 0 and self.key[here] != key:
                side, last = (self.low if key < self.key[here] else self.high), here
                here = side[here]
            if here < 0:
                here = side[last] = self._new(key, at, size)
            at = here
            path.append(at)
        self.ends[at] = ends
        return path

    def preorder(self) -> list[int]:
        """All nodes, parents before children, children by key."""
        out, left = [], [(0, True)]
        while left:
            at, whole = left.pop()
            if at < 0:
                continue
            if whole and at:  # the node among its siblings: lower ones, itself, higher ones
                left += [(self.high[at], True), (at, False), (self.low[at], True)]
            else:
                out.append(at)
                left.append((self.down[at], True))
        return out


def _medians_first(n: int) -> Iterator[int]:
    spans = [(0, n)]
    while spans:
        lo, hi = spans.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            spans += [(lo, mid), (mid + 1, hi)]


#: Rows of a shard: its closed nodes, the boundary nodes of its two paths, and parts of boundary nodes' member lists.
_SHARD = (
    "kind string, shard int, node int, parent int, parent_conv_id long, path long, last_path long, depth long, digest binary, parent_digest binary, "
    "conv_id long, n_convs long, n_children long, n_leaves long, saved long, size long, ends string"
)


def _shard_rows(sequences: list[tuple[list[int], list[int], list[int]]], shard: int) -> Iterator[dict]:
    """``sequences``: distinct (turn ids, sizes, ends) in order of turn ids."""
    tree = TernaryTree()
    paths: dict[int, list[int]] = {}
    for k in _medians_first(len(sequences)):
        path = tree.insert(*sequences[k])
        if k in (0, len(sequences) - 1):
            paths[k] = path
    first, last = paths[0], paths[len(sequences) - 1]
    order = tree.preorder()
    count = len(order)
    members, least, children, leaves, saved, depth = [0] * count, [None] * count, [0] * count, [0] * count, [0] * count, [0] * count
    boundary = {*first, *last}
    for at in order[1:]:
        depth[at] = depth[tree.parent[at]] + 1
    for at in reversed(order):
        own = tree.ends.get(at, ())
        members[at] += len(own)
        if own and (least[at] is None or own[0] < least[at]):
            least[at] = own[0]
        if at not in boundary:  # a boundary node's own leaf and saving are known after merging only
            leaves[at] += not children[at]
            saved[at] += (members[at] - 1) * tree.size[at]
        up = tree.parent[at]
        if up >= 0:
            members[up] += members[at]
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
            leaves[up] += leaves[at]
            saved[up] += saved[at]
            children[up] += at not in boundary  # boundary nodes are counted after merging, when each is one
    digests = {0: _ROOT}
    for path in (first, last):
        for up, at in pairwise(path):
            digests[at] = hashlib.sha256(digests[up] + tree.key[at].to_bytes(8, "big", signed=True)).digest()
    listed = lambda at: ",".join(map(str, tree.ends.get(at, ())))
    row = lambda kind, at, **more: {
        "kind": kind, "shard": shard, "node": at, "parent": tree.parent[at], "depth": depth[at], "conv_id": least[at], "n_convs": members[at],
        "n_children": children[at], "n_leaves": leaves[at], "saved": saved[at], **more,
    }
    for at in order:
        if at not in boundary:
            known = None if tree.parent[at] in boundary else least[tree.parent[at]]
            yield row("closed", at, parent_conv_id=known, ends=hashlib.sha256(listed(at).encode()).hexdigest())
    on_first, on_last = set(first), set(last)
    for side, path in enumerate((first, last)):
        for at in path:
            if side and at in on_first:
                continue
            place = 2 * shard + side
            until = 2 * shard + 1 if at in on_last else place
            yield row("boundary", at, path=place, last_path=until, digest=digests[at], parent_digest=digests.get(tree.parent[at]), size=tree.size[at])
            own = tree.ends.get(at, [])
            for lo in range(0, len(own), ENDS_PART):
                yield {"kind": "ends", "shard": shard, "path": place, "digest": digests[at], "conv_id": own[lo], "ends": ",".join(map(str, own[lo : lo + ENDS_PART]))}


def _build_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(r["ids"], r["conv_id"], r["sizes"]) for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    rows.sort(key=lambda r: r[:2])
    sequences: list[tuple[list[int], list[int], list[int]]] = []
    for ids, conv, sizes in rows:
        if sequences and sequences[-1][0] == ids:
            sequences[-1][2].append(conv)
        else:
            sequences.append((ids, sizes, [conv]))
    rows.clear()
    names = [f.split()[0] for f in _SHARD.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _SHARD.split(", ")])
    part: list[dict] = []
    for row in _shard_rows(sequences, TaskContext.get().partitionId()):
        part.append({k: row.get(k) for k in names})
        if len(part) == 4000:
            yield pa.RecordBatch.from_pylist(part, schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_pylist(part, schema=schema)


def _hashed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, ends_sha256) of rows sorted by (digest, path, first id): one running hash."""
    held, running, out = None, None, []
    for batch in batches:
        for digest, part in zip(batch.column("digest").to_pylist(), batch.column("ends").to_pylist()):
            if digest != held:
                if held is not None:
                    out.append((held, running.hexdigest()))
                held, running = digest, hashlib.sha256(part.encode())
            else:
                running.update(b"," + part.encode())
    if held is not None:
        out.append((held, running.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.binary()), pa.array([e for _, e in out], pa.string())], ["digest", "ends_sha256"])


# ---------------------------------------------------------------- dictionary and sequences


def encoded_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, id, size): every turn with the id of its distinct (role, text) and its text's UTF-8 bytes.

    The dictionary is keyed by SHA-256 digests.  Entries that hold a
    thousandth of all turns or more are joined by a broadcast of at most
    ``HOT_ENTRIES`` rows, the others by a shuffle, in which no key is hot.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    turns = written(turns, "turns")
    entries = written(turns.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id()), "dictionary")
    bound = turns.count() / HOT_ENTRIES
    hot = F.broadcast(entries.where(F.col("n") >= bound).select("digest", "id"))
    cold = entries.where(F.col("n") < bound).select("digest", "id")
    common = turns.join(hot, "digest")
    rest = turns.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest")
    return common.unionByName(rest)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes) of every conversation, turns in order."""
    one = F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("given"), "turn", "digest", "id", "size")))
    held = turns.groupBy("conv_id").agg(one.alias("turns"))
    return held.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))


def rebuilt(found: DataFrame, base: Column, shared: Column, most_shared: int) -> DataFrame:
    """Every conversation's sequence after its first ``shared`` turns are replaced by those of conversation ``base``."""
    heads = found.select(F.col("conv_id").alias("base"), F.slice("ids", 1, most_shared).alias("head_ids"), F.slice("sizes", 1, most_shared).alias("head_sizes"))
    both = found.withColumns({"base": base, "shared": shared.cast("int")}).join(heads, "base", "left")

    def joined(head: str, own: str, kind: str) -> Column:
        start = F.coalesce(F.slice(head, F.lit(1), F.col("shared")), F.array().cast(kind))
        return F.concat(start, F.slice(own, F.col("shared") + 1, F.size(own)))

    return both.select("conv_id", joined("head_ids", "ids", "array<bigint>").alias("ids"), joined("head_sizes", "sizes", "array<bigint>").alias("sizes"))


# ---------------------------------------------------------------- trie


def _running(totals: DataFrame, values: list[str]) -> DataFrame:
    """(path, running sums up to and with the path) of (path, values), one row a path: sums in groups, then over groups."""
    grouped = totals.withColumn("group", F.floor(F.col("path") / PATHS_GROUP))
    inside = Window.partitionBy("group").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("group").agg(*(F.sum(v).alias(v) for v in values))
    groups = groups.select("group", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"before_{v}") for v in values))
    out = grouped.withColumns({v: F.sum(v).over(inside) for v in values}).join(groups, "group")
    return out.select("path", *((F.col(v) + F.col(f"before_{v}")).alias(v) for v in values))


def prefix_trie(found: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``found``: (conv_id, ids, sizes), one row per conversation.  A node's
    saving is (members - 1) times the size of its last turn, summed over its
    subtree.
    """
    spark = found.sparkSession
    found = written(found, "sequences")
    turns = found.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    rows = written(found.repartitionByRange(shards, "ids", "conv_id").mapInArrow(_build_shard, _SHARD), "trie")
    edge = rows.where("kind = 'boundary'")
    merged = written(_merged(edge), "boundary")
    values = ["own_leaf", "own_saved"]
    places = edge.select("path").unionByName(edge.select(F.col("last_path").alias("path"))).distinct()
    here = merged.groupBy(F.col("path")).agg(*(F.sum(v).alias(v) for v in values))
    sums = _running(places.join(here, "path", "left").fillna(0, values), values)
    deeper = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    open_nodes = merged.withColumns({f"in_{v}": F.sum(v).over(deeper) for v in values})
    for side in ("path", "last_path"):
        open_nodes = open_nodes.join(sums.select(F.col("path").alias(side), *(F.col(v).alias(f"{side}_{v}") for v in values)), side)
    below = {v: F.col(f"in_{v}") + F.col(f"last_path_{v}") - F.col(f"path_{v}") for v in values}
    lists = rows.where("kind = 'ends'").select("digest", "path", "conv_id", "ends")
    lists = lists.repartition("digest").sortWithinPartitions("digest", "path", "conv_id").select("digest", "ends").mapInArrow(_hashed_lists, "digest binary, ends_sha256 string")
    parents = merged.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("parent_conv_id"))
    open_nodes = open_nodes.join(lists, "digest", "left").join(parents, "parent_digest", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + below["own_leaf"]).alias("n_leaves"),
        (F.col("saved") + below["own_saved"]).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    closed = rows.where("kind = 'closed'").withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})
    tops = edge.join(merged.select("digest", F.col("conv_id").alias("top_conv_id")), "digest").select("shard", F.col("node").alias("parent"), "top_conv_id")
    hung = closed.where("parent_conv_id is null").join(tops, ["shard", "parent"]).withColumn("parent_conv_id", F.col("top_conv_id"))
    inner = closed.where("parent_conv_id is not null")
    return open_nodes.unionByName(hung.select(open_nodes.columns)).unionByName(inner.select(open_nodes.columns))


def _merged(edge: DataFrame) -> DataFrame:
    """One row per boundary node: sums over shards, its paths, and its own leaf and saving."""
    one = edge.groupBy("digest").agg(
        F.first("parent_digest").alias("parent_digest"), F.first("depth").alias("depth"), F.first("size").alias("size"),
        F.min("conv_id").alias("conv_id"), F.min("path").alias("path"), F.max("last_path").alias("last_path"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
    )
    among = one.where("parent_digest is not null").groupBy(F.col("parent_digest").alias("digest")).agg(F.count(F.lit(1)).alias("n_open"))
    one = one.join(among, "digest", "left").withColumn("n_children", F.col("n_children") + F.coalesce("n_open", F.lit(0))).drop("n_open")
    return one.withColumns({"own_leaf": (F.col("n_children") == 0).cast("long"), "own_saved": (F.col("n_convs") - 1) * F.col("size")})
