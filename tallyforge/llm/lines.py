"""Deletion of line runs that repeat earlier ones, found by winnowing over line hashes."""

from __future__ import annotations

from collections import deque

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm import shingles
from tallyforge.llm.common import keep, map_slices
from tallyforge.operators.joins import spread_join

#: A run must hold this many words before it counts as a passage.
MIN_WORDS = 50
_PRIME, _BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F


def run_windows(text: bytes, min_words: int) -> list[tuple[int, int, int, int, bytes]]:
    """(start, end, at, fingerprint, digest) of every window of ``text`` and of its extensions.

    A window starts at a line with a word and ends at the first line with which it has ``min_words`` words. Its fingerprint is
    the least hash of its lines, the first of which is line ``at``: wherever the window stands, the same line is selected.
    A window is extended to the right by each further line before the next window's end, and to the left by each line
    without words before it; an extension keeps its window's fingerprint. Beyond those lines the neighbouring window takes over, so
    every run of ``min_words`` words or more is the union of windows and extensions that lie in it. Time and memory are
    linear in the lines.
    """
    lines = text.split(b"\n")
    counts = [len(line.split()) for line in lines]
    windows, end, held = [], 0, 0
    for start, own in enumerate(counts):
        while end < len(lines) and held < min_words:
            held += counts[end]
            end += 1
        if held < min_words:
            break
        if own:
            windows.append((start, end - 1))
        held -= own
    if not windows:
        return []
    hashes = [xxhash.xxh3_128_intdigest(line) for line in lines]
    sums, powers = [0], [1]  # a span's digest is a polynomial of its lines' hashes
    for h in hashes:
        sums.append((sums[-1] * _BASE + h + 1) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    out, least, reach = [], deque(), 0
    for (a, b), (_, stop) in zip(windows, [*windows[1:], (0, len(lines))]):
        while reach <= b:
            while least and hashes[least[-1]] > hashes[reach]:
                least.pop()
            least.append(reach)
            reach += 1
        while least[0] < a:
            least.popleft()
        blank = a
        while blank and not counts[blank - 1]:
            blank -= 1
        for i, j in [(a, b), *((a, t) for t in range(b + 1, stop)), *((h, b) for h in range(blank, a))]:
            gram = (sums[j + 1] - sums[i] * powers[j + 1 - i]) % _PRIME
            out.append((i, j, least[0], (hashes[least[0]] >> 64) - (1 << 63), gram.to_bytes(16, "big")))
    return out


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    def run(piece):
        data, offsets = shingles.utf8(piece.column("text"))
        raw, at, cols = data.tobytes(), offsets.tolist(), ([], [], [], [], [], [])
        for i in range(piece.num_rows):
            for window in run_windows(raw[at[i]:at[i + 1]], min_words):
                for col, value in zip(cols, (i, *window)):
                    col.append(value)
        rows = pa.array(cols[0], pa.int32())
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").take(rows), piece.column("h").take(rows), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
             pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.binary())], names=["doc_id", "h", "start", "end", "at", "mark", "gram"])

    return map_slices(docs, "text", run, "doc_id long, h long, start int, end int, at int, mark long, gram binary")


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _mask(starts: pd.Series, ends: pd.Series) -> pd.Series:
    """Which lines, by number, the runs cover."""

    def one(a, b):
        covered = [False] * (max(b) + 1)
        for i, j in sorted(zip(a, b)):
            while j >= i and not covered[j]:
                covered[j] = True
                j -= 1
        return covered

    return pd.Series([one(a, b) for a, b in zip(starts, ends)])


def drop_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row (all input columns as a struct), text, n_lines, n_deleted.

    A line is deleted when it lies in a run of whole lines that holds at least ``min_words`` words and stands at an earlier
    place too, earlier by (doc_id, line). Every deleted line has an equal one that stays.

    Each window selects its line of least hash as fingerprint, so equal windows anywhere select equal lines. Fingerprints whose
    selected line is a single place are dropped. Around the others the places are joined: windows by their 127-bit digests with
    the earliest place of the same window, and so are their extensions line by line to both sides, each of which may have an
    earliest place of its own. The union of what matches is each longest repeated run. No two places are ever compared pair by
    pair, so a frequent line costs work in proportion to its places: the earliest place is a partial aggregate, and the
    joins deal a key's rows to 16 tasks.

    Lines end at a line feed and are compared as they are. Null text stays null, with no line; an empty text has
    one empty line. Rows that agree in id and text are one document, so none of them is the later one; a null id
    comes after all others. A document may lose all its lines; its row stays, with an empty text. Extra columns
    pass through the struct. An empty table gives no rows.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col)).alias("h"))
    windows = keep(_windows(rows.select("doc_id", "h", "text"), min_words))
    document = (F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("h").alias("h"))
    place, selected = F.struct(*document, F.col("start").alias("start")), F.struct(*document, F.col("at").alias("at"))
    marks = windows.groupBy("mark").agg(F.min(selected).alias("low"), F.max(selected).alias("high")).where("low <> high").select("mark")
    near = spread_join(windows, marks, ["mark"]).select("doc_id", "h", "start", "end", "gram", place.alias("place"))
    first = near.groupBy("gram").agg(F.min("place").alias("first"), F.count("*").alias("places")).where("places > 1")
    later = spread_join(near, first, ["gram"]).where("place <> first")
    runs = later.groupBy("doc_id", "h").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    masks = runs.select(F.col("doc_id").alias("id"), F.col("h").alias("key"), _mask("starts", "ends").alias("mask"))  # lists no longer than a document
    joined = rows.join(masks, (rows["h"] == masks["key"]) & rows["doc_id"].eqNullSafe(masks["id"]), "left").select("row", "text", "mask")
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.coalesce(F.get(F.col("mask"), i), F.lit(False)))
    return joined.select(
        "row", F.when(F.col("mask").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        (F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(F.filter("mask", lambda m: m)), F.lit(0)).cast("bigint").alias("n_deleted"))


LINES_SQL = f"""
WITH t AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
r AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM t),
w AS (SELECT doc_id, i, l, len(regexp_extract_all(l, '[^ \\t\\n\\x0b\\f\\r]+')) AS n FROM r),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM w),
m AS (SELECT doc_id, c, min(i) AS j FROM c GROUP BY doc_id, c),
b AS (SELECT doc_id, c - n AS p, max(i) AS i FROM c GROUP BY doc_id, c - n),
g AS (SELECT a.doc_id, a.i, m.j FROM c a ASOF JOIN m ON a.doc_id = m.doc_id AND a.c - a.n + {MIN_WORDS} <= m.c
      UNION SELECT a.doc_id, b.i, a.i FROM c a ASOF JOIN b ON a.doc_id = b.doc_id AND a.c - {MIN_WORDS} >= b.p),
x AS (SELECT g.doc_id, g.i, g.j, string_agg(c.l, chr(10) ORDER BY c.i) AS gram FROM g JOIN c ON g.doc_id = c.doc_id AND c.i BETWEEN g.i AND g.j GROUP BY ALL),
y AS (SELECT *, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS place FROM x),
z AS (SELECT DISTINCT c.doc_id, c.i FROM y JOIN c ON y.doc_id = c.doc_id AND c.i BETWEEN y.i AND y.j WHERE place > 1),
k AS (SELECT c.doc_id, count(*) AS n_lines, count(z.i) AS n_deleted, coalesce(string_agg(l, chr(10) ORDER BY c.i) FILTER (z.i IS NULL), '') AS text
      FROM c LEFT JOIN z ON c.doc_id = z.doc_id AND c.i = z.i GROUP BY c.doc_id)
SELECT t.doc_id, k.text, k.n_lines, coalesce(k.n_deleted, 0) AS n_deleted FROM t LEFT JOIN k USING (doc_id)
"""
