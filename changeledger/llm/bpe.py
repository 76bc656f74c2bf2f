"""Byte-level BPE: texts to token ids with a rank file, and ids back to bytes."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .batches import as_bytes, decoded, grouped, with_row

#: Longer texts are encoded in parts of about this many characters.
PART_CHARS = 1 << 16

# A position between a visible character and white space: no alternative of the usual
# pre-token patterns spans it, and none looks behind, so both sides split as the whole text does.
_SAFE = re.compile(r"(?<=[\w!-~])(?=[ \n\t])")

# White space as the encoder's pattern engine has it (fixed values). A run of more is too deep for
# that engine; what the pattern makes of a run is known: all but its last character are one
# pre-token, or all of it at the end of a text.
_LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of `base64 rank` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def load_encoding(path: str, pattern: str):
    """The tiktoken encoder of a rank file, without special tokens."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut a text before white space that follows a visible character, at least `size` apart.

    A stretch without such a place stays whole.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Encoder:
    """Token ids of whole texts of any length."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        self._path = ranks_path
        self._encoding = load_encoding(ranks_path, pattern)
        self._whole = None

    def ids(self, text: str | None) -> list[np.ndarray]:
        """The ids, as arrays to be joined."""
        if not text:
            return []
        found, start = [], 0
        for run in _LONG_SPACE.finditer(text) if len(text) >= 1000 else ():
            end = run.end() - (run.end() < len(text))
            found += self._ordinary(text[start : run.start()])
            found.append(self._one_piece(text[run.start() : end]))
            start = end
        return found + self._ordinary(text[start:])

    def _ordinary(self, text: str) -> list[np.ndarray]:
        return [self._encoding.encode_to_numpy(part, disallowed_special=()) for part in safe_parts(text) if part]

    def _one_piece(self, text: str) -> np.ndarray:
        if self._whole is None:
            self._whole = load_encoding(self._path, r"(?s:.+)")
        return self._whole.encode_to_numpy(text, disallowed_special=())


def with_token_ids(documents: DataFrame, ranks_path: str, pattern: str, text_column: str = "text", output: str = "token_ids") -> DataFrame:
    """Add the token ids of every text as an array; ids are those of the whole text.

    Null and empty texts have no tokens. A column already named `output` is replaced. `ranks_path`
    is a file on every worker.
    """
    source = with_row(documents, text=as_bytes(text_column))
    schema = StructType([source.schema["row"], StructField("ids", ArrayType(IntegerType(), False), False)])

    def encode(batches):
        encoder = Encoder(ranks_path, pattern)
        for batch in grouped(batches):
            ends, parts = [0], []
            for text in decoded(batch.column("text")):
                ids = encoder.ids(text)
                parts += ids
                ends.append(ends[-1] + sum(map(len, ids)))
            values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("row"), tokens], names=["row", "ids"])

    kept = [F.col(f"row.`{c}`") for c in documents.columns if c != output]
    return source.mapInArrow(encode, schema).select(*kept, F.col("ids").alias(output))


def with_decoded_bytes(encoded: DataFrame, ranks_path: str, ids_column: str = "token_ids", output: str = "decoded") -> DataFrame:
    """Add the bytes that token ids stand for. Null ids give no bytes; an id without a token is an error."""
    source = with_row(encoded, ids=F.col(ids_column))
    schema = StructType([source.schema["row"], StructField("bytes", BinaryType(), False)])

    def decode(batches):
        ranks = load_ranks(ranks_path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        token_of = table.__getitem__
        for batch in batches:
            texts = [b"".join(map(token_of, row)) if row else b"" for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary())], names=["row", "bytes"])

    kept = [F.col(f"row.`{c}`") for c in encoded.columns if c != output]
    return source.mapInArrow(decode, schema).select(*kept, F.col("bytes").alias(output))


def digest(encoded: DataFrame) -> DataFrame:
    """Per document: token count, SHA-256 of the ids and of the decoded bytes."""
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
