"""Language identification with spans, by word scores and a Viterbi search over words."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import crc_mod, least_hashed, map_slices

#: Buckets of letter-triple counts, and documents of each language that are learned from at most.
BUCKETS, DOCS_PER_LANGUAGE, MOST_LANGUAGES = 1 << 16, 1000, 1000
#: What a change of language between two words costs, in units of the words' log-probabilities.
SWITCH = 12.0
#: A script counts as a language's own if it holds at least this share of its letters.
_OWN = 0.02
# First and last code points of scripts; what lies outside is script 0.
_SCRIPTS = [
    (0x0041, 0x024F, 1), (0x1E00, 0x1EFF, 1), (0x0370, 0x03FF, 2), (0x1F00, 0x1FFF, 2), (0x0400, 0x052F, 3), (0x0530, 0x058F, 4), (0x0590, 0x05FF, 5),
    (0x0600, 0x077F, 6), (0x08A0, 0x08FF, 6), (0x0900, 0x097F, 7), (0x0980, 0x09FF, 8), (0x0A00, 0x0A7F, 9), (0x0B80, 0x0BFF, 10), (0x0C00, 0x0C7F, 11),
    (0x0E00, 0x0E7F, 12), (0x10A0, 0x10FF, 13), (0x1100, 0x11FF, 14), (0xAC00, 0xD7AF, 14), (0x3040, 0x30FF, 15), (0x3400, 0x9FFF, 16), (0x20000, 0x3FFFF, 16),
]
N_SCRIPTS = 17
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    """By code point: whether it is a letter, its small form, its script."""
    if not _TABLES:
        n = 0x110000
        _TABLES["letter"] = np.fromiter((chr(i).isalpha() for i in range(n)), dtype=bool, count=n)
        small = np.arange(n, dtype=np.uint32)
        for i in np.flatnonzero(_TABLES["letter"][:0x1F000]):
            c = chr(i).lower()
            if len(c) == 1:
                small[i] = ord(c)
        _TABLES["small"] = small
        script = np.zeros(n, dtype=np.int8)
        for a, b, s in _SCRIPTS:
            script[a:b + 1] = s
        _TABLES["script"] = script
    return _TABLES


class Words:
    """The words (runs of letters) of some texts: place, length, script, and the letter triples of all."""

    def __init__(self, texts: list[str]):
        t = _tables()
        lengths = np.array([len(x) for x in texts], dtype=np.int64)
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if len(texts) else np.zeros(0, np.int64)
        letter = t["letter"][codes]
        at = np.flatnonzero(letter)
        small = np.where(letter, t["small"][codes], 0).astype(np.uint64)
        before, after = np.zeros_like(small), np.zeros_like(small)
        before[1:], after[:-1] = small[:-1], small[1:]
        h = (before[at] * np.uint64(0x9E3779B97F4A7C15) + small[at] * np.uint64(0xD6E8FEB86659FD93) + after[at] * np.uint64(0xA0761D6478BD642F))
        self.triples = (h >> np.uint64(48)).astype(np.int64)
        heads = np.flatnonzero(before[at] == 0)
        self.heads, self.starts = heads, at[heads]
        self.sizes = np.diff(np.append(heads, len(at)))
        self.scripts = t["script"][codes[self.starts]]
        self.of_text = np.searchsorted(self.starts, self.first) if len(texts) else np.zeros(0, np.int64)
        self.of_text = np.append(self.of_text, len(self.starts))


class LanguageModel:
    """Log-probabilities of letter triples by language, and the scripts of each language."""

    def __init__(self, names: list[str], triples: np.ndarray, scripts: np.ndarray):
        self.names = names
        total = triples.sum(axis=1, keepdims=True)
        self.logs = np.log((triples + 0.2) / (total + 0.2 * BUCKETS)).T.astype(np.float32)
        own = scripts >= _OWN * np.maximum(1, scripts.sum(axis=1, keepdims=True))
        self.barred = np.where(own | ~own.any(axis=0), 0.0, -1e6).T.astype(np.float32)  # by script: languages that do not use it

    def label(self, words: Words) -> np.ndarray:
        """The language of every word: per text the best sequence, a change costing ``SWITCH``.

        Texts are searched side by side, the k-th words of all of them in one step.
        """
        if not len(words.starts):
            return np.zeros(0, np.int64)
        scores = np.add.reduceat(self.logs[words.triples], words.heads, axis=0) + self.barred[words.scripts]
        sizes = np.diff(words.of_text)
        order = np.argsort(-sizes, kind="stable")
        first, sizes = words.of_text[:-1][order], sizes[order]
        live = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")  # texts that have a k-th word
        value = scores[first[:live[0]]].copy()
        best = np.zeros(len(scores), dtype=np.int16)  # the best language before each word
        moved = np.zeros(scores.shape, dtype=bool)
        last = np.zeros(len(order), dtype=np.int64)
        for k in range(1, sizes[0]):
            n = live[k]
            if n < len(value):
                last[n:len(value)] = value[n:].argmax(axis=1)
                value = value[:n]
            at = first[:n] + k
            top = value.argmax(axis=1)
            other = value[np.arange(n), top] - SWITCH
            change = other[:, None] > value
            best[at], moved[at] = top, change
            value = np.where(change, other[:, None], value) + scores[at]
        last[:len(value)] = value.argmax(axis=1)
        out = np.zeros(len(scores), dtype=np.int64)
        now = last.copy()
        for k in range(sizes[0] - 1, -1, -1):
            n = live[k]
            at = first[:n] + k
            out[at] = now[:n]
            now[:n] = np.where(moved[at, now[:n]], best[at], now[:n])
        return out


def fit_languages(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> LanguageModel | None:
    """A model of the languages named in ``lang_col``, learned from at most ``docs_per_language`` documents of each (those
    of least hashed id, whole) and at most ``MOST_LANGUAGES`` languages, those with the most documents. None without a document of
    known language. Of documents that share an id one counts, and those without an id are one. Counting runs on the
    executors; counts of fixed size per language reach the driver and the workers.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col), F.lit("sample")).alias("h"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    picked = least_hashed(rows, "lang", "h", docs_per_language, MOST_LANGUAGES)
    limits = picked.groupBy("lang").agg(F.max("h").alias("limit"))  # a row per language
    sample = rows.join(F.broadcast(limits), "lang").where("h <= limit").groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")

    def count(piece):
        langs, texts = piece.column("lang").to_pylist(), piece.column("text").to_pylist()
        out = []
        for lang in sorted(set(langs)):
            words = Words([t for t, x in zip(texts, langs) if x == lang])
            counts = np.concatenate([np.bincount(words.triples, minlength=BUCKETS), np.bincount(words.scripts, words.sizes, minlength=N_SCRIPTS).astype(np.int64)])
            seen = np.flatnonzero(counts)
            out.append(pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(counts[seen].astype(np.int64))],
                                                  names=["lang", "slot", "c"]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if sum(b.num_rows for b in out) else None

    counted = map_slices(sample, "text", count, "lang string, slot int, c long").groupBy("lang", "slot").agg(F.sum("c").alias("c")).toPandas()
    if not len(counted):
        return None
    names = sorted(counted["lang"].unique())
    table = np.zeros((len(names), BUCKETS + N_SCRIPTS))
    table[[names.index(x) for x in counted["lang"]], counted["slot"].to_numpy()] = counted["c"].to_numpy()
    return LanguageModel(names, table[:, :BUCKETS], table[:, BUCKETS:])


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, lang_pred, score, spans (array of start, end, lang in code points).

    Words are runs of letters; a word's script leaves only the languages that use it (all, where none does), and the
    sequence of languages with the best sum of word scores, less ``SWITCH`` for each change, labels the words. A span runs
    from the first to the last of neighbouring words of one language. lang_pred is the language with the most letters,
    score its share of the letters.

    Null texts, texts without a letter, and all texts where there is no model get "und", score 0 and no span. Repeated rows
    repeat, other columns are ignored, an empty table gives no rows. Whole texts are labelled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(piece):
        known = shared.value
        words = Words([t or "" for t in piece.column("text").to_pylist()])
        labels = known.label(words) if known is not None else None
        preds, scores, spans = [], [], []
        for i in range(piece.num_rows):
            a, b = words.of_text[i], words.of_text[i + 1]
            if known is None or a == b:
                preds.append("und")
                scores.append(0.0)
                spans.append([])
                continue
            letters = np.bincount(labels[a:b], words.sizes[a:b], minlength=len(known.names))
            top = int(letters.argmax())
            preds.append(known.names[top])
            scores.append(float(letters[top] / letters.sum()))
            edges = np.flatnonzero(np.diff(labels[a:b])) + a
            starts, ends = np.append(a, edges + 1), np.append(edges, b - 1)
            spans.append([{"start": int(words.starts[s] - words.first[i]), "end": int(words.starts[e] + words.sizes[e] - words.first[i]),
                           "lang": known.names[labels[s]]} for s, e in zip(starts, ends)])
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                                          names=["doc_id", "lang_pred", "score", "spans"])

    return map_slices(rows, "text", run, "doc_id long, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>", 2 << 20)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans: a third of the documents, by their ids' checksum, is kept from learning."""
    out = identify(docs, fit_languages(docs.where(crc_mod(F.col("doc_id"), 3) != 1)))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "spans")
