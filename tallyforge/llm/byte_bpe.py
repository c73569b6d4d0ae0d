"""Byte-level BPE encoding and decoding by a local rank file."""

from __future__ import annotations

import base64
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices

#: A longer text is encoded in parts of about this many characters.
PART_CHARS = 64 << 10
#: A match of the pattern with more characters than this is merged without another search by the pattern.
PIECE_CHARS = 8 << 10
#: Where no match of the pattern can lie on both sides: before white space, and where a run of letters or of numerals ends.
SAFE = r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """tiktoken's encoding of texts of any length by given ranks.

    The library's search by the pattern needs a stack as deep as a run of white space, so long texts are cut at safe
    boundaries first, and a part that has none is cut into the pattern's matches. The classes of letters and numerals
    are those of the library: characters that this Python does not know are looked up by it.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None, part_chars: int = PART_CHARS, piece_chars: int = PIECE_CHARS):
        import regex
        import tiktoken

        self.pattern = pattern or default_pattern()
        self.part_chars, self.piece_chars = part_chars, piece_chars
        self.encoding = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})  # one match, found without a stack
        single = {bytes([i]): i for i in range(256)}
        self.classes = [(stand, tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={}))
                        for stand, name in (("a", r"\p{L}"), ("0", r"\p{N}"))]
        self.matches, self.safe = regex.compile(self.pattern), regex.compile(SAFE)

    def _seen(self, text: str) -> str:
        """``text`` with a letter, numeral or mark of the library's class in place of characters unknown here."""
        unknown = {c for c in set(text) if unicodedata.category(c) == "Cn"}
        return text.translate({ord(c): next((s for s, e in self.classes if e.encode_ordinary(c)), "�") for c in unknown}) if unknown else text

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The parts of a text, each with whether it is one match of the pattern."""
        if len(text) <= self.part_chars:
            yield text, False
            return
        seen, at = self._seen(text), 0
        while at < len(text):
            found = self.safe.search(seen, at + self.part_chars)
            end = found.start() if found else len(text)
            if end - at <= 2 * self.part_chars:
                yield text[at:end], False
            else:
                begin, white = at, []  # white: the matches since the last that was not white space; only the text behind them tells them apart
                for m in self.matches.finditer(seen, at, end):
                    if m.end() - m.start() > self.piece_chars:
                        solid = white[0][0] if white else m.start()
                        if begin < solid:
                            yield text[begin:solid], False
                        for a, b in [*white, m.span()]:
                            yield text[a:b], True
                        begin, white = m.end(), []
                    else:
                        white = [*white, m.span()] if m.group().isspace() else []
                if begin < end:
                    yield text[begin:end], False
            at = end

    def encode(self, text: str) -> np.ndarray:
        out = [np.array((self.whole if one else self.encoding).encode_ordinary(part), np.int32) for part, one in self.parts(text)]
        return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, np.int32), *out])

    def decode(self, ids: np.ndarray) -> bytes:
        step = 1 << 20
        return b"".join(self.encoding.decode_bytes(ids[i:i + step].tolist()) for i in range(0, len(ids), step))


_ENCODERS: dict[str, ByteBpe] = {}


def _encoder(shared) -> ByteBpe:
    """The Python worker's encoder for broadcast ranks, kept from task to task."""
    made, *parts = shared.value
    if made not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[made] = ByteBpe(*parts)
    return _ENCODERS[made]


def _share(df: DataFrame, ranks: str | None, pattern: str | None):
    known = default_pattern()
    part_chars = PART_CHARS if pattern in (None, known) else 1 << 62  # the boundaries are safe for the known pattern only
    return df.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, read_ranks(ranks or default_ranks()), pattern or known, part_chars))


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, ids.

    ``ids`` are the whole text's tokens by the rank file ``ranks``, each match of ``pattern`` merged by itself, without
    special tokens, exactly as tiktoken gives them. Texts of any length are encoded in the memory of their ids (4 bytes
    each) and of one part; only one run of a single class of characters, such as a megabyte of blanks, has to be merged
    as a whole. The ranks, one file of fixed size, are broadcast from the driver, so executors need no copy of it.
    A pattern other than the tokenizers' own is applied to whole texts, as its safe boundaries are not known.

    Null and empty texts have no ids. Bytes that are no UTF-8 count as U+FFFD. Rows are independent: repeated rows
    repeat, ids of any value pass, other columns are ignored, an empty table gives no rows.
    """
    shared = _share(docs, ranks, pattern)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))

    def run(piece):
        encoder = _encoder(shared)
        got = [encoder.encode(t.decode("utf-8", "replace")) for t in piece.column("text").to_pylist()]
        offsets = np.cumsum([0, *map(len, got)])
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *got])))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), ids], names=["doc_id", "ids"])

    return map_slices(rows, "text", run, "doc_id long, ids array<int>", 2 << 20)


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``encoded`` (with ``ids``) and ``bytes``, the raw bytes that the ids stand for.

    Bytes and not text: ids may stand for parts of a character. Null ids give null, no ids give no bytes; an id that the
    rank file does not have, or a null among them, is an error. Columns of the input stay, one named ``bytes`` is replaced.
    """
    shared = _share(encoded, ranks, None)
    rows = encoded.drop("bytes")

    def body(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                decoder = _encoder(shared)
                data = [decoder.decode(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else None for ids in batch.column("ids")]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, "bytes"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(body, schema + ", bytes binary")


def token_digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of a frame with ``ids`` and ``bytes``."""
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                          F.sha2("bytes", 256).alias("decoded_sha256"))
