"""Near-duplicate vectors by Euclidean p-stable hashing."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import cut
from tallyforge.llm.graph import components

#: Hash tables, projections in each and width of a quantum. Normalised vectors with a cosine of 0.93 are at most
#: 0.374 apart and agree in one projection with a chance of 0.88, so they meet in some table with one of 0.99;
#: vectors at right angles meet in a given table with a chance below 10^-4.
TABLES, PROJECTIONS, WIDTH = 40, 17, 2.5
#: Vectors of one unit that are held together when two units must be compared member by member.
BLOCK = 1024
_EPS = 1e-9


def _matrices(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, normalised vectors in double precision) for each length in an Arrow list column."""
    sizes = np.asarray(column.value_lengths())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    out = []
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        m = values[(ends[at] - size)[:, None] + np.arange(size)]
        out.append((at, m / np.linalg.norm(m, axis=1, keepdims=True)))
    return out


def _buckets(vectors: DataFrame, seed: int) -> DataFrame:
    """(c, bucket): for each table, the hashed quanta of a vector's random projections."""

    def body(batches):
        for batch in batches:
            for at, m in _matrices(batch.column("emb")):
                rng = np.random.default_rng([seed, m.shape[1]])
                lines = rng.standard_normal((m.shape[1], TABLES * PROJECTIONS))
                shift = rng.uniform(0, WIDTH, TABLES * PROJECTIONS)
                quanta = np.floor((m @ lines + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(at), TABLES, PROJECTIONS)
                keys = rng.integers(1, 1 << 63, (TABLES, PROJECTIONS), dtype=np.int64).view(np.uint64) | np.uint64(1)
                h = (quanta * keys).sum(axis=2, dtype=np.uint64)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                ids = batch.column("c").take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(np.arange(len(at)), TABLES))),
                     batch.column("label").take(pa.array(np.repeat(at, TABLES))),
                     pa.array(np.tile(np.arange(TABLES, dtype=np.int32), len(at))),
                     pa.array((h ^ (h >> np.uint64(32))).view(np.int64).ravel())], names=["c", "label", "t", "h"])

    out = vectors.select("c", "label", "emb").mapInArrow(body, f"c long, label {dict(vectors.dtypes)['label']}, t int, h long")
    return out.select("c", F.xxhash64("label", "t", "h").alias("bucket"))


def _cosines(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with the cosine of the two vectors; pairs of different length or label have none."""
    keep = [c for c in pairs.columns if c not in ("a", "b")]
    left = vectors.select(F.col("c").alias("a"), F.col("emb").alias("x"), F.col("label").alias("la"))
    right = vectors.select(F.col("c").alias("b"), F.col("emb").alias("y"), F.col("label").alias("lb"))
    both = pairs.join(left, "a").join(right, "b").where("la = lb AND size(x) = size(y)").select("a", "b", *keep, "x", "y")

    def body(batches):
        for batch in batches:
            cos = np.empty(batch.num_rows)
            for (at, x), (_, y) in zip(_matrices(batch.column("x")), _matrices(batch.column("y"))):
                cos[at] = np.einsum("ij,ij->i", x, y)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("a", "b", *keep)], pa.array(cos)], names=["a", "b", *keep, "cos"])

    types = dict(pairs.dtypes)
    return both.mapInArrow(body, ", ".join(f"{c} {types[c]}" for c in ("a", "b", *keep)) + ", cos double")


def near_vectors(vectors: DataFrame, cosine: float = 0.93, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of one label link when their cosine, in double precision, is at least ``cosine``. Candidates come from
    the tables of p-stable hashes: normalised vectors are projected on random lines, the lines are cut into
    quanta, and vectors that agree in all quanta of some table share a bucket.

    Equal vectors are one candidate. In each bucket vectors first meet the bucket's first one. Those within half
    the linking angle of it form a unit: any two of them link for certain, so a bucket that holds a third of all
    rows is counted without its pairs. Then units meet, each once however many buckets they share; the angle
    between their centres and their radii tell whether all, none or some of their members link, and only in the
    last case members are compared, block against block. So every link reported has been proven, and no pair that
    shares a bucket is left out. Whether two vectors share one is a matter of probability, which rises with their cosine:
    a pair near ``cosine`` can be missed (recall 0.996 in a group with cosines around 0.95, see the README). A
    group in which hardly any vector lies within half the angle of another comes out pair by pair.

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows whose label or id is null,
    link with nothing. Vectors of different lengths never link. Rows repeated with one id are vectors of their own.
    Other columns are ignored. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("emb"))
    finite = F.forall("emb", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("emb", lambda e: e != 0)
    rows = rows.withColumn("key", F.when(usable, F.sha2(F.concat_ws("|", F.col("label").cast("string"), F.col("emb").cast("string")), 256)))
    classes = cut(rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("emb").alias("emb"))
        .withColumn("c", F.xxhash64("key")))
    vecs = classes.select("c", "label", "emb", "m")
    buckets = cut(_buckets(vecs, seed))

    # each vector against the first of its buckets, by hashed name
    heads = buckets.groupBy("bucket").agg(F.min("c").alias("head"), F.max("c").alias("top")).where("head <> top").select("bucket", "head")
    shared = cut(buckets.join(heads, "bucket"))
    limit, half = math.acos(cosine), math.acos(cosine) / 2
    to_head = _cosines(shared.where("c <> head").select(F.col("c").alias("a"), F.col("head").alias("b")).distinct(), vecs)
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cos"))))
    inside = to_head.select("a", "b", angle.alias("angle")).where(F.col("angle") <= half - _EPS)
    chosen = inside.groupBy("a").agg(F.min(F.struct("b", "angle")).alias("best")).select(F.col("a").alias("c"), F.col("best.b").alias("unit"), F.col("best.angle").alias("angle"))
    member = cut(vecs.select("c", "m").join(chosen, "c", "left").select(
        "c", "m", F.coalesce("unit", "c").alias("unit"), F.coalesce("angle", F.lit(0.0)).alias("angle")))
    units = member.groupBy("unit").agg(F.sum("m").alias("size"), F.count("*").alias("classes"), F.max("angle").alias("radius"))

    # units that share a bucket; their centres may lie in other units
    places = shared.select("bucket", "c").join(member.select("c", "unit"), "c").select("bucket", "unit").distinct()
    met = (places.alias("l").join(places.alias("r"), "bucket").where("l.unit < r.unit")
           .select(F.col("l.unit").alias("a"), F.col("r.unit").alias("b")).distinct())
    sized = _cosines(met, vecs).select("a", "b", angle.alias("apart"))
    sized = sized.join(units.select(F.col("unit").alias("a"), F.col("size").alias("size_a"), F.col("classes").alias("n_a"), F.col("radius").alias("r_a")), "a")
    sized = cut(sized.join(units.select(F.col("unit").alias("b"), F.col("size").alias("size_b"), F.col("classes").alias("n_b"), F.col("radius").alias("r_b")), "b")
                .where(F.col("apart") - F.col("r_a") - F.col("r_b") <= limit + _EPS))
    all_link = F.col("apart") + F.col("r_a") + F.col("r_b") <= limit - _EPS
    sure, unsure = sized.where(all_link), sized.where(~all_link)
    by_unit = sure.select(F.explode(F.array(F.struct(F.col("a").alias("unit"), F.col("size_b").alias("more")),
                                            F.struct(F.col("b").alias("unit"), F.col("size_a").alias("more")))).alias("e")).select("e.*")
    by_unit = by_unit.groupBy("unit").agg(F.sum("more").alias("more"))
    counted = cut(_compared(unsure, member, vecs, cosine))
    by_class = counted.groupBy("c").agg(F.sum("more").alias("more"))
    edges = sure.select("a", "b").unionByName(counted.select("a", "b").distinct())
    part = components(edges.unionByName(member.select(F.col("c").alias("a"), F.col("unit").alias("b"))))
    own = (member.join(units.select("unit", "size"), "unit").join(by_unit.withColumnRenamed("more", "u"), "unit", "left")
           .join(by_class.withColumnRenamed("more", "v"), "c", "left").join(part.withColumnRenamed("node", "c"), "c", "left")
           .select("c", (F.col("size") - 1 + F.coalesce("u", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("links"), F.coalesce("component", "c").alias("root")))
    own = cut(own.join(classes.select("c", "key", "low"), "c"))
    found = own.join(own.groupBy("root").agg(F.min("low").alias("component")), "root").select("key", "links", "component")
    out = rows.select("vec_id", "key").join(found, "key", "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
                      F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))


def _compared(unsure: DataFrame, member: DataFrame, vecs: DataFrame, cosine: float) -> DataFrame:
    """(a, b, c, more): for units a and b compared member by member, the vectors that each member c links with.

    Members are dealt into blocks, so that a task holds two blocks at a time whatever the units' sizes.
    """
    full = member.join(vecs.select("c", "emb"), "c").select("unit", "c", "m", "emb")
    blocks_a, blocks_b = F.ceil(F.col("n_a") / BLOCK).cast("int"), F.ceil(F.col("n_b") / BLOCK).cast("int")
    left = (unsure.join(full.withColumnRenamed("unit", "a"), "a")
            .select("a", "b", F.pmod(F.xxhash64("c"), blocks_a).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), blocks_b - 1)).alias("j"), "c", "m", "emb", F.lit(0).alias("side")))
    right = (unsure.join(full.withColumnRenamed("unit", "b"), "b")
             .select("a", "b", F.explode(F.sequence(F.lit(0), blocks_a - 1)).alias("i"), F.pmod(F.xxhash64("c"), blocks_b).cast("int").alias("j"), "c", "m", "emb", F.lit(1).alias("side")))

    def links(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        side, c, m = (t.column(x).to_numpy() for x in ("side", "c", "m"))
        (_, v), = _matrices(t.column("emb").combine_chunks())
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        hit = v[one] @ v[two].T >= cosine
        close = np.abs(v[one] @ v[two].T - cosine) < 1e-12
        for p, q in zip(*np.nonzero(close)):  # decide by the plain sum where rounding matters
            hit[p, q] = float((v[one[p]] * v[two[q]]).sum()) >= cosine
        more = np.concatenate([hit @ m[two], hit.T @ m[one]]) if len(one) and len(two) else np.zeros(0, np.int64)
        ids = np.concatenate([c[one], c[two]]) if len(more) else np.zeros(0, np.int64)
        ids, more = ids[more > 0], more[more > 0]
        n = len(ids)
        return pa.table({"a": pa.array(np.full(n, t.column("a")[0].as_py()), pa.int64()), "b": pa.array(np.full(n, t.column("b")[0].as_py()), pa.int64()),
                         "c": pa.array(ids, pa.int64()), "more": pa.array(more, pa.int64())})

    return left.unionByName(right).groupBy("a", "b", "i", "j").applyInArrow(links, "a long, b long, c long, more long")


#: All pairs, for small tables; the hashing finds all of them where links are well above the threshold.
VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
                     FROM embeddings WHERE label IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
r AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT node, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON vec_id = node
"""
