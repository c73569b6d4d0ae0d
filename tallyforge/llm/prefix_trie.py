"""The prefix trie of conversations, from adaptive radix trees over ranges of their sorted keys."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import cut
from tallyforge.operators.joins import spread_join

#: Bytes of a turn's id: 16 of a digest of role and text, then the text's length in UTF-8, both big-endian.
WIDTH = 24
#: Conversations and bytes of keys of which one tree is built at a time.
BLOCK_ROWS, BLOCK_BYTES = 50_000, 8 << 20
#: Turns that a rebuilt conversation takes from its base at most.
MOST_BASE_TURNS = 8
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


class Leaf:
    """The rest of one key."""

    __slots__ = ("path", "end")

    def __init__(self, path: bytes, end):
        self.path, self.end = path, end

    def child(self, byte):
        return None

    def add(self, byte, node):
        return Few(self.path, self.end, 4).add(byte, node)

    def kids(self):
        return ()


class Few:
    """Up to 4, then up to 16 children beside their sorted branch bytes."""

    __slots__ = ("path", "end", "room", "bytes", "nodes")

    def __init__(self, path: bytes, end, room: int):
        self.path, self.end, self.room, self.bytes, self.nodes = path, end, room, bytearray(), []

    def child(self, byte):
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def add(self, byte, node):
        if len(self.nodes) == self.room:
            larger = Few(self.path, self.end, 16) if self.room == 4 else Indexed(self.path, self.end)
            if self.room == 4:
                larger.bytes, larger.nodes = self.bytes, self.nodes
            else:
                for b, n in zip(self.bytes, self.nodes):
                    larger.add(b, n)
            return larger.add(byte, node)
        at = next((i for i, b in enumerate(self.bytes) if b > byte), len(self.bytes))
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def replace(self, byte, node):
        self.nodes[self.bytes.find(byte)] = node

    def kids(self):
        return self.nodes


class Indexed:
    """Up to 48 children, found through an index of 256 places."""

    __slots__ = ("path", "end", "index", "nodes")

    def __init__(self, path: bytes, end):
        self.path, self.end, self.index, self.nodes = path, end, bytearray(b"\xff" * 256), []

    def child(self, byte):
        at = self.index[byte]
        return None if at == 255 else self.nodes[at]

    def add(self, byte, node):
        if len(self.nodes) == 48:
            larger = Direct(self.path, self.end)
            for b, at in enumerate(self.index):
                if at != 255:
                    larger.nodes[b] = self.nodes[at]
            return larger.add(byte, node)
        self.index[byte] = len(self.nodes)
        self.nodes.append(node)
        return self

    def replace(self, byte, node):
        self.nodes[self.index[byte]] = node

    def kids(self):
        return [self.nodes[at] for at in self.index if at != 255]


class Direct:
    """A place for every byte."""

    __slots__ = ("path", "end", "nodes")

    def __init__(self, path: bytes, end):
        self.path, self.end, self.nodes = path, end, [None] * 256

    def child(self, byte):
        return self.nodes[byte]

    def add(self, byte, node):
        self.nodes[byte] = node
        return self

    replace = add

    def kids(self):
        return [n for n in self.nodes if n is not None]


def _shared(path: bytes, key: bytes, at: int) -> int:
    """How many of the path's first bytes stand in the key at ``at``."""
    if key.startswith(path, at):
        return len(path)
    return len(os.path.commonprefix([path, key[at:at + len(path)]]))


class RadixTree:
    """An adaptive radix tree of byte keys; a node keeps the bytes that lead to it from its parent's (path compression)."""

    def __init__(self):
        self.root = Few(b"", None, 4)

    def insert(self, key: bytes, end) -> None:
        above, node, at = None, self.root, 0
        while at < len(key):
            byte = key[at]
            child = node.child(byte)
            if child is None:
                grown = node.add(byte, Leaf(key[at:], end))
                if grown is not node:
                    if above is None:
                        self.root = grown
                    else:
                        above.replace(node.path[0], grown)
                return
            same = _shared(child.path, key, at)
            if same < len(child.path):
                middle = Few(child.path[:same], None, 4)
                child.path = child.path[same:]
                middle.add(child.path[0], child)
                node.replace(byte, middle)
                child = middle
            above, node, at = node, child, at + same
        node.end = end


class Ends:
    """The conversations of one key: their number, the smallest, and their ids as text or, once it can be told, as digest."""

    __slots__ = ("n", "least", "ids", "sha")

    def __init__(self):
        self.n, self.least, self.ids, self.sha = 0, None, [], None

    def add(self, conv: int | None) -> None:
        self.n += 1
        if conv is not None:
            self.least = conv if self.least is None else min(self.least, conv)
            self.ids.append(str(conv))

    def close(self) -> None:
        self.sha = hashlib.sha256(",".join(self.ids).encode()).hexdigest()
        self.ids = None


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _names(key: bytes) -> list[bytes]:
    """A digest of every prefix of whole turns."""
    running = hashlib.blake2b(digest_size=16)
    out = [running.digest()]
    for at in range(0, len(key), WIDTH):
        running.update(key[at:at + WIDTH])
        out.append(running.copy().digest())
    return out


COLUMNS = [("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
           ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("parent", pa.binary()), ("name", pa.binary()),
           ("bytes", pa.int64()), ("block", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_())]
_PARENT_CONV, _PARENT = 2, 8
PARTIAL = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
           "parent binary, name binary, bytes long, block long, first boolean, last boolean")


def block_nodes(tree: RadixTree, first: bytes, last: bytes, block: int) -> Iterator[list]:
    """The trie's nodes in one block of keys, as rows of ``COLUMNS``; ``first`` and ``last`` are its least and greatest key.

    A prefix of ``first`` or ``last`` may go on in other blocks: such an open node has a ``name``, its ends as a list of ids, and
    counts only what hangs below it by nodes that are not open. All other nodes are complete; ``parent`` names an open parent.
    """
    names_first, names_last = _names(first), _names(last)

    def begin(node, at, in_first, in_last):
        """A frame: node, begin and end of its path, bytes in common with first and last, its children to come, and what they add up to:
        conversations, the smallest, closed children, their leaves and savings, rows that wait for their parent."""
        if in_first == at:
            in_first += _shared(node.path, first, at)
        if in_last == at:
            in_last += _shared(node.path, last, at)
        sums = [node.end.n, node.end.least, 0, 0, 0, []] if node.end else [0, None, 0, 0, 0, []]
        return node, at, at + len(node.path), in_first, in_last, iter(node.kids()), sums

    stack = [begin(tree.root, 0, 0, 0)]
    while stack:
        node, start, at, in_first, in_last, kids, sums = stack[-1]
        below = next(kids, None)
        if below is not None:
            stack.append(begin(below, at, in_first, in_last))
            continue
        stack.pop()
        lowest = at - at % WIDTH
        for p in range(lowest, -1 if node is tree.root else start, -WIDTH):  # from the node upwards, whole turns only
            n, conv, children, leaves, saved, waiting = sums
            depth, end = p // WIDTH, node.end if p == at else None
            size = int.from_bytes(node.path[p - 8 - start:p - start]) if p else 0
            on_first, on_last = p <= in_first, p <= in_last
            if on_first or on_last:
                names = names_first if on_first else names_last
                for row in waiting:
                    row[_PARENT] = names[depth]
                    yield row
                yield [depth, conv, None, n, children, leaves, saved, ",".join(end.ids) if end and end.ids else None, names[depth - 1] if p else None,
                       names[depth], size, block, on_first, on_last]
                sums = [n, conv, 0, 0, 0, []]
            else:
                for row in waiting:
                    row[_PARENT_CONV] = conv
                    yield row
                leaves, saved = leaves or 1, saved + (n - 1) * size
                row = [depth, conv, None, n, children, leaves, saved, end.sha if end else EMPTY_SHA256, None, None, None, None, None, None]
                sums = [n, conv, 1, leaves, saved, [row]]
        if stack:
            over = stack[-1][6]
            over[0], over[1] = over[0] + sums[0], _least(over[1], sums[1])
            for i in (2, 3, 4):
                over[i] += sums[i]
            over[5] += sums[5]


def _blocks(rows: Iterator[tuple[bytes, int | None]], most_rows: int, most_bytes: int) -> Iterator[tuple[RadixTree, bytes, bytes]]:
    """Trees over runs of the sorted (key, conversation) rows, with their least and greatest keys."""
    tree = first = key = None
    n = size = 0
    path: list[tuple[bytes, Ends]] = []  # the last key and its prefixes; what else is no prefix of the first key has all its conversations
    for k, conv in rows:
        if tree is not None and (n >= most_rows or size >= most_bytes):
            yield tree, first, key
            tree = None
        if tree is None:
            tree, first, key, path, n, size = RadixTree(), k, None, [], 0, 0
        if k != key:
            while path and not k.startswith(path[-1][0]):
                done, ends = path.pop()
                if done != first:
                    ends.close()
            key = k
            path.append((k, Ends()))
            tree.insert(k, path[-1][1])
            size += len(k)
        path[-1][1].add(conv)
        n += 1
    if tree is not None:
        yield tree, first, key


def partial_nodes(keys: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The nodes of every block of ``keys`` (conv_id, key), see ``block_nodes``. Equal keys are dealt out by conversation."""

    def body(batches):
        task = TaskContext.get().partitionId() << 32

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    yield from zip(part.column("key").to_pylist(), part.column("conv_id").to_pylist())

        out = []

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), COLUMNS)], names=[c for c, _ in COLUMNS])

        for i, (tree, first, last) in enumerate(_blocks(rows(), block_rows, block_bytes)):
            for row in block_nodes(tree, first, last, task + i):
                out.append(row)
                if len(out) >= 5000:
                    yield made()
                    out = []
        if out:
            yield made()

    dealt = keys.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    return dealt.mapInArrow(body, PARTIAL)


def _ends_of(chunks: DataFrame) -> DataFrame:
    """(name, ends_sha256) of open nodes from their blocks' lists of ids, read as a stream in order."""

    def body(batches):
        name = running = None
        for batch in batches:
            done = []
            for n, ids in zip(batch.column("name").to_pylist(), batch.column("ends").to_pylist()):
                if n != name:
                    if name is not None:
                        done.append((name, running.hexdigest()))
                    name, running = n, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["name", "ends_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([running.hexdigest()], pa.string())], names=["name", "ends_sha256"])

    return chunks.repartition("name").sortWithinPartitions("name", "block").select("name", "ends").mapInArrow(body, "name binary, ends_sha256 string")


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def merged_nodes(parts: DataFrame) -> DataFrame:
    """Whole nodes from the nodes of all blocks.

    Open nodes are the prefixes of the blocks' first and last keys, so they form paths from the root, two a block. A node's own
    amounts are put on one of the paths through it; summed up along each path and then over the paths, they give its subtree's.
    """
    opened = parts.where("name IS NOT NULL")
    sides = F.filter(F.array(F.when(F.col("first"), F.col("block") * 2), F.when(F.col("last"), F.col("block") * 2 + 1)), lambda x: x.isNotNull())
    paths = opened.select("name", "depth", F.explode(sides).alias("path"))
    totals = opened.select("*", F.array_min(sides).alias("path")).groupBy("name").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("bytes").alias("bytes"), F.min("path").alias("owner"))
    kids = totals.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("open_children"))
    whole = totals.join(kids, "name", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))).select(
        "name", "parent", "depth", "conv_id", "n_convs", "n_children", "owner",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("own_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"))
    here = F.col("path") == F.col("owner")
    down = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    along = paths.join(whole.select("name", "owner", "own_leaves", "own_saved"), "name").select(
        "name", F.sum(F.when(here, F.col("own_leaves")).otherwise(0)).over(down).alias("leaves"),
        F.sum(F.when(here, F.col("own_saved")).otherwise(0)).over(down).alias("saved"))
    sums = along.groupBy("name").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    over = totals.select(F.col("name").alias("parent"), F.col("conv_id").alias("over"))
    ends = _ends_of(opened.where("ends IS NOT NULL"))
    top = whole.join(sums, "name").join(ends, "name", "left").join(over, "parent", "left").select(
        "conv_id", "depth", F.col("over").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    closed = parts.where("name IS NULL").withColumnRenamed("ends", "ends_sha256")
    below = spread_join(closed.where("parent IS NOT NULL").drop("parent_conv_id"), over, ["parent"]).withColumnRenamed("over", "parent_conv_id")
    return closed.where("parent IS NULL").select(*RESULT).unionByName(below.select(*RESULT)).unionByName(top.select(*RESULT))


def conversation_keys(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, key): the ids of a conversation's turns one after the other, each of ``WIDTH`` bytes.

    Turns are ordered by turn (null first), then role and the text's SHA-256; null role and text count as empty. A key is one
    value, so a conversation can have some 80 million turns.
    """
    text, role = F.coalesce(text_col, F.lit("")), F.coalesce(role_col, F.lit(""))
    text_sha = F.sha2(text.cast("binary"), 256)
    name = F.substring(F.sha2(F.concat(F.sha2(role.cast("binary"), 256), text_sha).cast("binary"), 256), 1, 32)
    rows = turns.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.struct(
        F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text_sha.alias("sha"),
        F.concat(name, F.lpad(F.hex(F.octet_length(text)), 16, "0")).alias("id")).alias("t"))
    ids = F.transform(F.sort_array(F.collect_list("t")), lambda t: t["id"])
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(ids, "")).alias("key"))


def rebuilt_keys(keys: DataFrame) -> DataFrame:
    """``keys`` in which conversation c begins with the first h turns of conversation c - c % 5 in place of its own first h;
    h is crc32(c as text) % 9. Without that conversation, or with fewer turns of it, it begins with fewer; a null id is its own base."""
    turns = (F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % 9).cast("int")
    bases = keys.where("conv_id IS NULL OR conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.substring("key", 1, MOST_BASE_TURNS * WIDTH).alias("head"))
    own = keys.select("conv_id", "key", (turns * WIDTH).alias("cut"))
    joined = own.join(bases, (F.col("conv_id") - F.col("conv_id") % 5).eqNullSafe(F.col("base")), "left")
    return joined.select("conv_id", F.expr("concat(substring(coalesce(head, X''), 1, cut), substring(key, cut + 1))").alias("key"))


def prefix_trie(keys: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per distinct prefix of whole turns of ``keys`` (conv_id, key): conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The keys are range-partitioned and sorted, equal ones by conversation, so copies of a conversation or a first turn that a third of
    all share are spread evenly. Runs of the sorted keys become adaptive radix trees of bounded size. A block gives most of its nodes
    whole; those on its first and last key's path, a few per block, are summed up over the blocks. Blocks are written to the shared
    folder. The digest of the conversations that end at one node is taken in order by one task, from lists already joined.

    A null conv_id is a member, but no smallest one and not listed in ``ends_sha256``. Repeated conv_ids count each time. A key of no
    turns ends at the root. No keys give no nodes.
    """
    return merged_nodes(cut(partial_nodes(keys, block_rows, block_bytes)))


#: crc32 in SQL: the table of one byte's remainders, made by its rule, and the sum over a text of ASCII characters.
CRC_TABLE_SQL = "SELECT list(list_reduce([b] || range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY b) AS tab FROM (SELECT unnest(range(256)) AS b)"


def crc32_sql(text: str, table: str = "tab") -> str:
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce([4294967295] || {codes}, lambda a, b: xor(a >> 8, {table}[(xor(a, b) & 255) + 1])), 4294967295)"


TRIE_SQL = f"""
WITH crc AS ({CRC_TABLE_SQL}),
o AS (SELECT conv_id, sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS id, strlen(coalesce(text, ''))::BIGINT AS bytes,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS p
      FROM conversations),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, coalesce({crc32_sql("conv_id::VARCHAR")} % 9, 0) AS h FROM (SELECT DISTINCT conv_id FROM conversations), crc),
r AS (SELECT c.conv_id, 0 AS own, o.p, o.id, o.bytes FROM c JOIN o ON o.conv_id IS NOT DISTINCT FROM c.base AND o.p <= c.h
      UNION ALL SELECT c.conv_id, 1, o.p, o.id, o.bytes FROM c JOIN o ON o.conv_id IS NOT DISTINCT FROM c.conv_id AND o.p > c.h),
s AS (SELECT c.conv_id, coalesce(string_agg(r.id, '' ORDER BY r.own, r.p), '') AS key, coalesce(list(r.bytes ORDER BY r.own, r.p) FILTER (r.id IS NOT NULL), []) AS sizes
      FROM c LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
n AS (SELECT d AS depth, left(key, 64 * d) AS pre, min(conv_id) AS conv_id, count(*) AS n, max(CASE WHEN d > 0 THEN sizes[d] ELSE 0 END) AS bytes,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length(key) = 64 * d), '')) AS ends_sha256
      FROM (SELECT conv_id, key, sizes, unnest(range(length(key) // 64 + 1))::INTEGER AS d FROM s) GROUP BY d, left(key, 64 * d)),
k AS (SELECT depth - 1 AS depth, left(pre, 64 * (depth - 1)) AS pre, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM n LEFT JOIN k USING (depth, pre)),
t AS (SELECT a.pre, a.depth, sum((b.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((b.n - 1) * b.bytes)::BIGINT AS saved_tokens
      FROM f a JOIN f b ON starts_with(b.pre, a.pre) GROUP BY a.pre, a.depth)
SELECT f.conv_id, f.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, t.n_leaves, t.saved_tokens, f.ends_sha256
FROM f JOIN t USING (pre, depth) LEFT JOIN f u ON u.depth = f.depth - 1 AND u.pre = left(f.pre, 64 * u.depth)
"""
