"""The prefix trie of conversations, by peeling off last turns.

A node is a distinct sequence of first turns. Peeling goes from the greatest depth up: the conversations that
end at a depth join the nodes that are left there, each node's figures are then complete and handed out, and
its last turn is stripped, which regroups it with its siblings under their parent. So nodes are found and
summed up in the same pass over the depths.

Where the pass runs depends on a node's size. A subtree of at most ``most`` different conversations is peeled
by one task, many subtrees a task. Nodes with more are few, and are peeled by all tasks together: a level is a
grouped sum of its children, added up before the shuffle. So a first turn that a third of all conversations
share is no task's burden, whatever the depth at which they part.

What is shuffled are digests of turns and prefixes, never texts. Equal conversations are one row with a count;
their ids are sorted over all tasks, joined in runs, and each node's runs are hashed in order as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed, scratch_path
from .turns import checksum, turn_digest
from .workspace import ship

#: Different conversations of a subtree that one task peels.
MOST = 4096
#: Bytes of a digest; those of the textless root are zero.
WIDE = 16
_ROOT = bytes(WIDE)
#: Turns that a task holds before it peels the whole subtrees among them.
_HELD = 1 << 17
#: Bytes of ids that go on in one row.
_RUN = 1 << 16
_NODE = (
    "node binary, up binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, top boolean")
_NO_ENDS = hashlib.sha256(b"").hexdigest()
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``, its turns in order as (turn, unit, chars): digest and code points of each."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("unit"), F.char_length(text).alias("chars"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "unit", "chars"))).alias("turns"))


def borrowed(sequences: DataFrame, block: int = 100, lead: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns come from the first conversation of the block, the rest is their own.

    h is the checksum of the id modulo ``lead``. A block without its first conversation lends nothing.
    """
    own = sequences.withColumns({"h": (checksum(F.col("conv_id").cast("string")) % lead).cast("int"), "first": F.expr(f"conv_id - conv_id % {block}")})
    lenders = sequences.where(f"conv_id % {block} = 0").select(F.col("conv_id").alias("first"), F.slice("turns", 1, lead).alias("lent"))
    head = F.coalesce(F.slice("lent", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    tail = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(lenders, "first", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Prefixes and ends


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, depth, and the digests of all its prefixes end to end, the root's first; code points of its turns."""
    for rows in batches:
        turns = rows.column("turns")
        at, units, sizes = turns.offsets.to_pylist(), turns.values.field("unit").to_pylist(), turns.values.field("chars").to_pylist()
        paths, chars = [], []
        for begin, end in zip(at, at[1:]):
            digest, path = _ROOT, [_ROOT]
            for unit in units[begin:end]:
                digest = hashlib.md5(digest + unit).digest()
                path.append(digest)
            paths.append(b"".join(path))
            chars.append(sizes[begin:end])
        yield pa.RecordBatch.from_arrays(
            [rows.column("conv_id"), pa.array([len(c) for c in chars], pa.int64()), pa.array(paths, pa.binary()), pa.array(chars, pa.list_(pa.int32()))],
            ["conv_id", "depth", "path", "chars"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) to rows of many ids of one node: the first, how many, and their text."""
    node, ids, size = None, [], 0

    def run() -> tuple:
        return node, ids[0], len(ids), ",".join(map(str, ids))

    for rows in batches:
        out = []
        for end, conv in zip(rows.column("node").to_pylist(), rows.column("conv_id").to_pylist()):
            if ids and (end != node or size >= _RUN):
                out.append(run())
                ids, size = [], 0
            node = end
            ids.append(conv)
            size += 12
        if out:
            yield _batch(out, _RUN_SCHEMA)
    if ids:
        yield _batch([run()], _RUN_SCHEMA)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order to one row a node: least id, how many, SHA-256 of all ids joined by commas."""
    node, least, n, sha = None, None, 0, None
    for rows in batches:
        out = []
        for end, first, many, text in zip(*(c.to_pylist() for c in rows.columns)):
            if end != node or sha is None:
                if sha is not None:
                    out.append((node, least, n, sha.hexdigest()))
                node, least, n, sha = end, first, 0, hashlib.sha256()
            sha.update(("," if n else "").encode() + text.encode())
            n += many
        if out:
            yield _batch(out, _END_SCHEMA)
    if sha is not None:
        yield _batch([(node, least, n, sha.hexdigest())], _END_SCHEMA)


_RUN_SCHEMA = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
_END_SCHEMA = pa.schema([("node", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _node_at(depth: Column) -> Column:
    return F.substring("path", depth * WIDE + 1, F.lit(WIDE))


def _ends(paths: DataFrame) -> DataFrame:
    """A row for each different conversation: least id, how many have it, the hash of their ids, and its path."""
    ends = paths.select(_node_at(F.col("depth")).alias("node"), "conv_id")
    runs = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _runs, "node binary, first long, n long, ids string")
    digests = runs.repartition("node").sortWithinPartitions("node", "first").mapInArrow(
        _digests, "node binary, conv_id long, n long, ends string")
    return digests.join(paths, "conv_id")


# Peeling


def peel(ended: dict[int, list[tuple]]) -> list[tuple]:
    """All nodes of whole subtrees, from their conversations by depth: (path, chars, top depth, id, copies, ends).

    A node: its digest, its parent's, depth, least id, parent's least id, members, children, leaves, saved, ends,
    and whether it is the top of its subtree; a top doesn't know its parent's least id.
    """
    out: list[list] = []
    level: dict[bytes, list] = {}
    for depth in range(max(ended, default=0), 0, -1):
        at = depth * WIDE
        for path, chars, top, conv, n, ends in ended.get(depth, ()):
            node = level.setdefault(path[at : at + WIDE], [conv, 0, [], 0, 0, path, chars, top, _NO_ENDS])
            node[0], node[1], node[8] = min(node[0], conv), node[1] + n, ends
        above: dict[bytes, list] = {}
        for digest, (conv, n, children, leaves, saved, path, chars, top, ends) in level.items():
            for child in children:
                out[child][4] = conv
            leaves = leaves or 1
            saved += (n - 1) * chars[depth - 1]
            up = path[at - WIDE : at]
            if depth > top:
                parent = above.setdefault(up, [conv, 0, [], 0, 0, path, chars, top, _NO_ENDS])
                parent[0] = min(parent[0], conv)
                parent[1] += n
                parent[2].append(len(out))
                parent[3] += leaves
                parent[4] += saved
            out.append([digest, up, depth, conv, None, n, len(children), leaves, saved, ends, depth == top])
        level = above
    return out


_NODE_SCHEMA = pa.schema([
    ("node", pa.binary()), ("up", pa.binary()), *((name, pa.int64()) for name in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    ("ends_sha256", pa.string()), ("top", pa.bool_())])


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the top of their subtree, whole subtrees at a time."""
    held: dict[int, list[tuple]] = {}
    turns, last = 0, None
    for rows in batches:
        for top_node, path, chars, top, conv, n, ends in zip(*(rows.column(c).to_pylist() for c in ("top_node", "path", "chars", "top", "conv_id", "n", "ends"))):
            if turns >= _HELD and top_node != last:
                yield _batch(peel(held), _NODE_SCHEMA)
                held, turns = {}, 0
            last = top_node
            held.setdefault(len(chars), []).append((path, chars, top, conv, n, ends))
            turns += len(chars)
    if held:
        yield _batch(peel(held), _NODE_SCHEMA)


def _crowded(ends: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Nodes with more than ``most`` different conversations, and each conversation's deepest one."""
    along = ends.where("depth > 0").select("conv_id", F.explode(F.expr(
        f"transform(sequence(1L, depth), d -> struct(substring(path, cast(d * {WIDE} + 1 as int), {WIDE}) AS node,"
        f" substring(path, cast((d - 1) * {WIDE} + 1 as int), {WIDE}) AS up, d AS depth, chars[cast(d - 1 as int)] AS chars))")).alias("x")).select("conv_id", "x.*")
    crowded = _stored(along.groupBy("node", "up", "depth", "chars").agg(F.count("*").alias("n")).where(F.col("n") > most).drop("n"), "trie-crowded")
    deepest = along.join(crowded.select("node"), "node", "left_semi").groupBy("conv_id").agg(F.max("depth").alias("crowded"))
    return crowded, deepest


def _upper(crowded: DataFrame, kids: DataFrame, ended: DataFrame) -> DataFrame:
    """The crowded nodes and the root, a level at a time; ``kids``: sums over the subtrees below, ``ended``: by node."""
    spark = crowded.sparkSession
    root = spark.createDataFrame([(_ROOT, None, 0, 0)], "node binary, up binary, depth long, chars int")
    known = crowded.unionByName(root)
    levels: list[DataFrame] = []
    for depth in range(crowded.agg(F.max("depth")).first()[0] or 0, -1, -1):
        sums = kids.where(F.col("depth") == depth + 1).drop("depth")
        if levels:
            sums = sums.unionByName(_summed(levels[-1]).drop("depth"))
        sums = sums.withColumn("ends", F.lit(None).cast("string")).unionByName(ended.where(F.col("depth") == depth).select(
            F.col("node").alias("up"), "conv_id", F.col("n").alias("n_convs"), *(F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")), "ends"))
        level = sums.groupBy(F.col("up").alias("node")).agg(
            F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends").alias("ends"))
        level = level.join(known.where(F.col("depth") == depth), "node").select(
            "node", "up", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
            F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"), F.lit(True).alias("top"))
        levels.append(checkpointed(level))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _summed(nodes: DataFrame) -> DataFrame:
    """What nodes hand to their parents."""
    return nodes.groupBy("up", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.count("*").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def prefix_trie(sequences: DataFrame, most: int = MOST) -> DataFrame:
    """The nodes of the trie over (conv_id, turns), one row each, with COLUMNS.

    ``turns``: in order, structs with a 16-byte digest ``unit`` and a size ``chars``. ``conv_id`` is unique and
    not null; ``sequences`` and ``borrowed`` make such rows.

    Decided cases: a null role or text is empty; turns are ordered by number, null first, and by digest among
    equal numbers, so repeated rows are turns of their own. Rows without conv_id belong to no conversation. A
    conversation without turns ends at the root. No conversations: no rows, not even a root. Other columns are
    ignored. A task holds one conversation's digests, 24 bytes a turn, or ``most`` different conversations.
    """
    ship(sequences.sparkSession)
    paths = _stored(sequences.select("conv_id", "turns").mapInArrow(_prefixes, "conv_id long, depth long, path binary, chars array<int>"), "trie-paths")
    ends = _stored(_ends(paths), "trie-ends")
    crowded, deepest = _crowded(ends, most)
    cut = ends.join(deepest, "conv_id", "left").withColumn("top", F.coalesce("crowded", F.lit(0)) + 1)
    lower = cut.where("depth >= top").select(_node_at(F.col("top")).alias("top_node"), "path", "chars", "top", "conv_id", "n", "ends")
    lower = _stored(lower.repartition("top_node").sortWithinPartitions("top_node").mapInArrow(_peeled, _NODE), "trie-nodes")
    kids = checkpointed(_summed(lower.where("top")))
    ended = checkpointed(cut.where("depth < top").select("node", "depth", "conv_id", "n", "ends"))
    upper = _upper(crowded, kids, ended)
    parents = upper.select(F.col("node").alias("up"), F.col("conv_id").alias("above"))
    tops = lower.where("top").unionByName(upper).join(parents, "up", "left").withColumn("parent_conv_id", F.col("above"))
    return lower.where("not top").select(*COLUMNS).unionByName(tops.select(*COLUMNS))
