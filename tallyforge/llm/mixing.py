"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Shares of the mixture, in characters, that the registered query asks for.
WEIGHTS = {"src0": 0.15, "src1": 0.15, "src2": 0.1, "src3": 0.1}
REST = 0.5
#: One draw has a mean of at most this; larger means are sums of independent draws.
MEAN_PER_DRAW = 16.0
_TWO52 = float(1 << 52)


def _hex(text, digits: int):
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def _cdf(mean):
    """Cumulative Poisson probabilities of 0, 1, 2, ... up to where the rest is below one draw's resolution."""
    steps = F.sequence(F.lit(1), F.ceil(mean + 12.0 * F.sqrt(mean) + 24.0).cast("int"))
    first = F.exp(-mean)

    def step(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all"))

    return F.aggregate(steps, F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all")), step, lambda acc: acc["all"])


def poisson_mix(docs: DataFrame, weights: Mapping[str, float] = WEIGHTS, rest: float = REST, seed: int = 0,
                budget: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row repeated a Poisson number of times, in a global random order.

    Every source named in ``weights`` is a group of its own; all others, null included, are one group with
    the weight ``rest``. A group's mean repetition rate is its share of ``budget`` characters (all characters
    there are, unless given) over the characters it has, so the expected mixture meets the weights. Each
    document's count inverts the Poisson distribution at uniform numbers hashed from the seed and its id:
    the same on every run and for every partitioning.

    Groups without characters take no share. The columns are those of ``docs`` followed by ``copy`` (1 to the
    count) and ``shuffle_key``; existing columns of these names are replaced. A row without an id is seeded by
    its text; rows repeated with one id get equal counts. Weights of 0 drop a group, negative ones are an error.

    The table of rates has a row per named source and one more: the only side that is broadcast. Documents
    move once, in the final shuffle, dealt by a hash of (id, copy), so a hot source or document is spread.
    """
    if rest < 0 or any(w < 0 for w in weights.values()):
        raise ValueError("a weight is negative")
    named = [s for s in weights if s is not None]
    group = F.when(F.col(source_col).isin(named), F.col(source_col)) if named else F.lit(None).cast("string")
    weight = F.lit(float(rest))
    for name in named:
        weight = F.when(F.col("g") == name, F.lit(float(weights[name]))).otherwise(weight)
    sizes = (docs.select(group.alias("g"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("n"))
             .groupBy("g").agg(F.sum("n").alias("size")).where("size > 0").withColumn("w", weight))
    all_of = Window.partitionBy(F.lit(1))  # at most one row per named source and one more
    total = F.sum("size").over(all_of) if budget is None else F.lit(budget)
    rate = total.cast("double") * F.col("w") / F.sum("w").over(all_of) / F.col("size")
    rates = sizes.select("g", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    rates = rates.select("g", F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN_PER_DRAW)).cast("int").alias("draws"), "rate")
    rates = rates.select("g", "draws", _cdf(F.col("rate") / F.col("draws")).alias("cdf"))

    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), group.alias("g"),
                       F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))).alias("key"))

    def draw(j):
        return _hex(F.concat_ws("|", F.lit(f"draw {seed}"), F.col("key"), j.cast("string")), 13) / F.lit(_TWO52)

    us = F.transform(F.sequence(F.lit(1), F.col("draws")), draw)
    # how many probabilities lie at or below u: the smallest k with u < P(X <= k)
    count = F.aggregate(us, F.lit(0), lambda acc, u: acc + F.size(F.filter("cdf", lambda c: c <= u)))
    drawn = (rows.join(F.broadcast(rates), rows["g"].eqNullSafe(rates["g"]))
             .select("row", "key", count.alias("copies")).where("copies > 0"))
    copies = drawn.select("row", "key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    dealt = copies.select("row", "copy", _hex(F.concat_ws("|", F.lit(f"order {seed}"), F.col("key"), F.col("copy").cast("string")), 15).alias("shuffle_key"))
    return dealt.repartition("shuffle_key").sortWithinPartitions("shuffle_key").select("row.*", "copy", "shuffle_key")


def mix_sql(weights: Mapping[str, float] = WEIGHTS, rest: float = REST, seed: int = 0, docs: str = "documents") -> str:
    """The same mixture for DuckDB, its probabilities from the closed form instead of the recurrence."""
    names = ", ".join(f"'{s}'" for s in weights)
    weight = "CASE " + " ".join(f"WHEN g = '{s}' THEN {w!r}::DOUBLE" for s, w in weights.items()) + f" ELSE {float(rest)!r}::DOUBLE END"
    unit = f"('0x' || substr(md5(concat_ws('|', 'draw {seed}', key, j)), 1, 13))::BIGINT / {_TWO52!r}::DOUBLE"
    return f"""
mix_d AS (SELECT *, CASE WHEN source IN ({names}) THEN source END AS g,
                 coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS key FROM {docs}),
mix_w AS (SELECT g, sum(length(coalesce(text, ''))) AS size, {weight} AS w FROM mix_d GROUP BY g HAVING sum(length(coalesce(text, ''))) > 0),
mix_r AS (SELECT g, (sum(size) OVER ())::DOUBLE * w / sum(w) OVER () / size AS rate FROM mix_w),
mix_m AS (SELECT g, greatest(1, ceil(rate / {MEAN_PER_DRAW}))::BIGINT AS draws, rate / greatest(1, ceil(rate / {MEAN_PER_DRAW})) AS m FROM mix_r),
mix_p AS (SELECT g, m, draws, k, sum(exp(k * ln(m) - m - lgamma(k + 1))) OVER (PARTITION BY g ORDER BY k) AS p
          FROM mix_m, range(0, 120) AS r(k) WHERE k <= ceil(m + 12 * sqrt(m) + 24)),
mix_u AS (SELECT DISTINCT mix_d.g, key, j, {unit} AS u
          FROM mix_d JOIN mix_m ON mix_d.g IS NOT DISTINCT FROM mix_m.g, range(1, 1000) AS q(j) WHERE j <= draws),
mix_c AS (SELECT key, mix_u.g, sum((p <= u)::BIGINT)::BIGINT AS copies
          FROM mix_u JOIN mix_p ON mix_u.g IS NOT DISTINCT FROM mix_p.g GROUP BY key, mix_u.g),
mix AS (SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
               ('0x' || substr(md5(concat_ws('|', 'order {seed}', mix_d.key, copy)), 1, 15))::BIGINT AS shuffle_key
        FROM mix_d JOIN mix_c ON mix_d.key = mix_c.key AND mix_d.g IS NOT DISTINCT FROM mix_c.g, range(1, 10000) AS x(copy) WHERE copy <= copies)"""
