"""Exact Jaccard self-join of word-shingle sets, with set-relation skipping.

Sets share few members unless they are alike, so only prefixes of the sets (rare members first) enter the
index lists. Two kinds of work are skipped without losing a link:

* Index level: an index list is cut into blocks by set size, and an entry carries its position. Blocks whose
  sizes cannot pass are never read, and entries too far back are left out.
* Answer level: every set is first compared with one hub. What a set shares with its hub bounds what it can
  share with any other member of that hub's circle, so answers of similar sets follow from each other; and sets
  already known to be connected need no further comparison for the groups. ``jaccard_links``, which gives every
  link, compares these too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import shingles
from tallyforge.llm.common import cut, keep, map_slices, slices
from tallyforge.llm.graph import components
from tallyforge.operators.joins import spread_join

#: The frequency sketch counts all members in this many buckets (a power of two).
SKETCH_BITS = 16
#: An index list this many times the sketch's mean bucket is split over several tasks.
_HEAVY, _SPLITS = 4, 16
_BLOCK = 4096


def _first_pass(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (doc_id, n, x, odd) and, from each task, the sketch's counts (block, counts)."""

    def body(batches):
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for piece in slices(batches, "text"):
            n, x, odd = [], [], []
            for one in shingles.shingle_sets(piece.column("text"), width):
                n.append(len(one))
                x.append(shingles.set_hash(one))
                odd.append(shingles.parity_bits(one))
                np.add.at(counts, (one >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            rows = piece.num_rows
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(n, pa.int32()), pa.array(x, pa.int64()), pa.array(odd, pa.binary()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.list_(pa.int64()))], names=["doc_id", "n", "x", "odd", "block", "counts"])
        blocks = [b for b in range(len(counts) // _BLOCK) if counts[b * _BLOCK:(b + 1) * _BLOCK].any()]
        if blocks:
            none = len(blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(none, pa.int64()), pa.array([-1] * none, pa.int32()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary()),
                 pa.array(blocks, pa.int32()), pa.array([counts[b * _BLOCK:(b + 1) * _BLOCK] for b in blocks], pa.list_(pa.int64()))],
                names=["doc_id", "n", "x", "odd", "block", "counts"])

    return docs.mapInArrow(body, "doc_id long, n int, x long, odd binary, block int, counts array<long>")


def _sketch(first: DataFrame) -> np.ndarray:
    """Counts of all members of all sets by bucket; of fixed size."""
    summed = (first.where("n = -1").select("block", F.posexplode("counts").alias("at", "c"))
              .groupBy((F.col("block") * _BLOCK + F.col("at")).alias("bucket")).agg(F.sum("c").alias("c")).toPandas())
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    counts[summed["bucket"].to_numpy(dtype=np.int64)] = summed["c"].to_numpy(dtype=np.int64)
    return counts


def _postings(docs: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """Index entries (token, sub, x, n, pos) of each set's prefix, in the order of (bucket count, hash)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    heavy = _HEAVY * int(counts.mean()) + 64

    def run(piece):
        counts, shift = shared.value, np.uint64(64 - SKETCH_BITS)
        token, x, n, pos, sub = [], [], [], [], []
        for one in shingles.shingle_sets(piece.column("text"), width):
            if not len(one):
                continue
            often = counts[(one >> shift).astype(np.int64)]
            size = len(one) + (-percent * len(one)) // 100 + 1
            order = np.lexsort((one, often))[:size]
            name = shingles.set_hash(one)
            token.append(one[order])
            x.append(np.full(size, name, dtype=np.int64))
            n.append(np.full(size, len(one), dtype=np.int32))
            pos.append(np.arange(size, dtype=np.int32))
            sub.append(np.where(often[order] > heavy, name % _SPLITS, -1).astype(np.int8))
        if not token:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in ([t.view(np.int64) for t in token], sub, x, n, pos)],
                                          names=["token", "sub", "x", "n", "pos"])

    return map_slices(docs, "text", run, "token long, sub byte, x long, n int, pos int")


def _shared_entries(postings: DataFrame) -> DataFrame:
    """Entries whose token another set has too, copies of a set once. Lists of frequent tokens are spread over
    several tasks and come whole."""

    def body(batches):
        held, same = None, False  # the last row, and whether its token was seen before it
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            token, x = now.column("token").to_numpy(), now.column("x").to_numpy()
            sub = now.column("sub").to_numpy()
            again = np.zeros(len(token), dtype=bool)
            again[0] = same
            again[1:] = token[1:] == token[:-1]
            copy = np.zeros(len(token), dtype=bool)
            copy[1:] = again[1:] & (x[1:] == x[:-1])
            # a row is alone if no row of its token with another set stands beside its run of copies
            new_set = again & ~copy
            more = np.zeros(len(token), dtype=bool)
            last = len(token) - 1
            nxt = np.append(np.flatnonzero(~copy), len(token))
            heads = nxt[:-1]
            following = nxt[1:]
            known = following <= last
            more[heads[known]] = again[following[known]]
            keep = ~copy & (new_set | more | (sub >= 0))
            tail = heads[-1]  # its fate depends on what follows
            keep[tail:] = False
            if keep.any():
                yield now.filter(pa.array(keep)).combine_chunks().to_batches()[0]
            held, same = now.slice(tail, 1).combine_chunks().to_batches()[0], bool(again[tail])
        if held is not None and (same or held.column("sub")[0].as_py() >= 0):
            yield held

    cols = ["token", "sub", "x", "n", "pos"]
    dealt = postings.repartition("token", "sub").sortWithinPartitions("token", "sub", "x")
    return dealt.select(*cols).mapInArrow(body, "token long, sub byte, x long, n int, pos int")


def _open_lists(entries: DataFrame, part: DataFrame) -> DataFrame:
    """Entries of the lists whose sets are not all connected, with their set's root and the list's commonest root."""
    rooted = (entries.join(part.withColumnRenamed("node", "x"), "x", "left")
              .select("token", "x", "n", "pos", F.coalesce("component", "x").alias("root")))
    counted = rooted.groupBy("token", "root").agg(F.count("*").alias("c"))
    mixed = counted.groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.count("*").alias("roots"))
    return rooted.join(mixed.where("roots > 1").drop("roots"), "token")


def _may_link(a: str, b: str, percent: int):
    """Whether sizes and positions of two entries of one list leave room for a link."""
    na, nb, pa_, pb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    most = F.least(na - pa_, nb - pb)
    return ((100 + percent) * most >= percent * (na + nb)) & (100 * F.least(na, nb) >= percent * F.greatest(na, nb))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, na, nb, shared) of the pairs that parity bits cannot rule out, counted on the whole sets."""
    left = nodes.select(F.col("x").alias("a"), F.col("n").alias("na"), F.col("odd").alias("odd_a"), F.col("doc").alias("doc_a"))
    right = nodes.select(F.col("x").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("odd_b"), F.col("doc").alias("doc_b"))

    def near(batches):
        for batch in batches:
            a, b = batch.column("odd_a").to_pylist(), batch.column("odd_b").to_pylist()
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            gap = np.fromiter((shingles.parity_distance(p, q) for p, q in zip(a, b)), dtype=np.int64, count=len(a))
            # members in one set only: at most total - 2 * shared
            keep = gap * (100 + percent) <= total.astype(np.int64) * (100 - percent)
            yield batch.filter(pa.array(keep)).select(["a", "b", "na", "nb", "doc_a", "doc_b"])

    close = cut(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "doc_a", "doc_b", "odd_a", "odd_b")
                .mapInArrow(near, "a long, b long, na int, nb int, doc_a long, doc_b long"))
    # a bit map of fixed size tells which documents may be wanted, so that only their sets are made and moved
    bits = 1 << 21

    def bit(c):
        return F.pmod(F.xxhash64(c), F.lit(bits)).cast("int")

    wanted = close.select(F.explode(F.array("doc_a", "doc_b")).alias("doc")).select(bit("doc").alias("bit"))
    # at most 2^15 rows
    wanted = wanted.groupBy((F.col("bit") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("mask"))
    asked = docs.withColumn("bit", bit("doc_id")).withColumn("word", (F.col("bit") / 64).cast("int"))
    asked = asked.join(F.broadcast(wanted), "word").where(F.expr("(shiftrightunsigned(mask, bit % 64) & 1L) = 1"))

    def sets(piece):
        made = shingles.shingle_sets(piece.column("text"), width)
        ends = np.cumsum([0] + [len(s) for s in made])
        flat = np.concatenate(made).view(np.int64) if made else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array([shingles.set_hash(s) for s in made], pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["doc", "x", "members"])

    made = map_slices(asked.select("doc_id", "text"), "text", sets, "doc long, x long, members array<long>")
    p = close.join(made.select(F.col("doc").alias("d1"), F.col("x").alias("a"), F.col("members").alias("set_a")), "a").where("doc_a <=> d1")
    p = p.join(made.select(F.col("doc").alias("d2"), F.col("x").alias("b"), F.col("members").alias("set_b")), "b").where("doc_b <=> d2")
    return cut(p.select("a", "b", "na", "nb", F.size(F.array_intersect("set_a", "set_b")).alias("shared")).distinct())


def _start(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, ...]:
    """(rows, members, nodes, entries, known): the sets, their index entries, and each set's pair with its hub."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    first = keep(_first_pass(rows, width))
    members = first.where("n >= 0").select("doc_id", "n", "x", "odd")
    nodes = keep(members.where("n > 0").groupBy("x").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("odd").alias("odd")))
    entries = keep(_shared_entries(_postings(rows, _sketch(first), width, percent)))

    # every set against one hub: the set that stands first in most of its lists, so has least of its own
    hubs = entries.groupBy("token").agg(F.min(F.struct("pos", "x", "n")).alias("hub"), F.count("*").alias("c")).where("c > 1")
    star = (entries.join(hubs, "token").where("x <> hub.x").select(F.struct("x", "n", "pos").alias("e"), "hub")
            .where(_may_link("e", "hub", percent)).groupBy(F.col("e.x").alias("a"), F.col("hub.x").alias("b")).agg(F.count("*").alias("c"))
            .groupBy("a").agg(F.max(F.struct("c", "b")).alias("best")).select("a", F.col("best.b").alias("b")))
    known = _verified(star, nodes, rows, width, percent)
    return rows, members, nodes, entries, known


def _linked(percent: int):
    return (100 + percent) * F.col("shared") >= percent * (F.col("na") + F.col("nb"))


def _band(percent: int):
    """Blocks by set size: sets of linked documents lie in one block or in two neighbours."""
    return F.floor(F.log("n") / math.log(100 / percent) + 1e-9).cast("int") if percent < 100 else F.col("n")


def _ruled_out(percent: int):
    """Of members shared with one hub and members beyond it, two sets have at most the smaller numbers in common."""
    common = F.least("l.shared", "r.shared") + F.least(F.col("l.n") - F.col("l.shared"), F.col("r.n") - F.col("r.shared"))
    return F.coalesce((F.col("l.hub") == F.col("r.hub")) & ((100 + percent) * common < percent * (F.col("l.n") + F.col("r.n"))), F.lit(False))


def jaccard_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, set_key.

    A document's set holds its distinct ``width``-word shingles (A-Z lowered, words split at white space); with
    fewer words the whole sequence is one shingle. Two documents link when their sets share at least ``percent``
    hundredths of their union, tested on the whole sets. component_id is the smallest doc_id of all documents
    connected by links; set_key names the set.

    Sets are 64-bit hashes, equal for equal shingles; two different shingles of one pair coincide with a chance
    near 2^-64. Documents with equal sets are one node from the start, so copies cost one index entry. The order
    of members comes from a fixed-size count over all documents. A token's list is linear work: sets meet the
    list's hub first, and only sets that are still unconnected meet the rest of it, block by block. Memory
    depends neither on lists nor on groups, and nothing but the sketch (65,536 counts) and the bit map reaches
    every task.

    Null and empty texts and texts of white space have no shingle, link with nothing and are their own
    component, as a null doc_id is where its whole component has none. Repeated rows repeat in the result. Other
    columns are ignored. An empty table gives no rows.
    """
    rows, members, nodes, entries, known = _start(docs, width, percent, id_col, text_col)
    linked = _linked(percent)
    edges = known.where(linked).select("a", "b")
    part = components(edges)

    # sets that are still apart, list by list and block by block
    with_hub = known.select(F.col("a").alias("x"), F.col("b").alias("hub"), "shared")
    lists = keep(_open_lists(entries, part).withColumn("block", _band(percent)).join(with_hub, "x", "left"))
    minor = lists.where("root <> major").withColumn("block", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)))
    pairs = (minor.alias("l").join(lists.alias("r"), ["token", "block"])
             .where("l.root <> r.root AND (r.root = r.major OR l.x < r.x)").where(_may_link("l", "r", percent))
             .where(~_ruled_out(percent))
             .select(F.least("l.x", "r.x").alias("a"), F.greatest("l.x", "r.x").alias("b")).distinct())
    tested = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _verified(pairs.join(tested, ["a", "b"], "left_anti"), nodes, rows, width, percent).where(linked).select("a", "b")

    part = components(edges.unionByName(more))
    rooted = members.join(part.withColumnRenamed("node", "x"), "x", "left").select("doc_id", "n", "x", F.coalesce("component", "x").alias("root"))
    shared = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("low"), F.count("*").alias("c")).where("c > 1")
    return spread_join(rooted, shared.select("root", "low"), ["root"], how="left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("low", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"), F.col("x").alias("set_key"))


def jaccard_links(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, membership): every link between different sets, and the documents that hold each set.

    ``links`` has a row per linked pair of distinct sets: a, b (set keys, a < b), na, nb (their sizes) and shared (the
    members in common, counted on the whole sets). ``membership`` has a row per input row: doc_id, n_shingles,
    set_key, n_links, the last being the number of other rows whose sets link with the row's own, equal sets included.
    A document's links follow from its set's; copies are never paired. Sets, links and odd rows are as in ``jaccard_groups``.

    Here no pair is skipped for being connected already: all pairs that sizes, positions and what both sets share with
    one hub leave open are compared. Work and result grow with the number of links, so with the square of a group of
    different near copies.
    """
    rows, members, nodes, entries, known = _start(docs, width, percent, id_col, text_col)
    with_hub = known.select(F.col("a").alias("x"), F.col("b").alias("hub"), "shared")
    lists = keep(entries.withColumn("block", _band(percent)).join(with_hub, "x", "left"))
    around = lists.withColumn("block", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)))
    pairs = (around.alias("l").join(lists.alias("r"), ["token", "block"]).where("l.x <> r.x").where(_may_link("l", "r", percent))
             .where(~_ruled_out(percent)).select(F.least("l.x", "r.x").alias("a"), F.greatest("l.x", "r.x").alias("b")).distinct())
    swap = F.col("a") > F.col("b")
    tested = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                          F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"), "shared").distinct()
    more = _verified(pairs.join(tested, ["a", "b"], "left_anti"), nodes, rows, width, percent)
    links = keep(tested.unionByName(more).where(_linked(percent)))

    copies = members.where("n > 0").groupBy("x").agg(F.count("*").alias("copies"))
    ends = links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y")))
    others = ends.join(copies.select(F.col("x").alias("y"), "copies"), "y").groupBy("x").agg(F.sum("copies").alias("others"))
    per_set = copies.join(others, "x", "left").select("x", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return links, spread_join(members.select("doc_id", "n", "x"), per_set, ["x"], how="left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.col("x").alias("set_key"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


JACCARD_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^ \\t\\n\\x0b\\f\\r]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g FROM w),
n AS (SELECT doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT node, e.b FROM r JOIN e ON r.seen = e.a)
SELECT n.doc_id, n.n AS n_shingles, (SELECT min(seen) FROM r WHERE node = n.doc_id) AS component_id FROM n
"""
