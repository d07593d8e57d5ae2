"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from gotera.llm.common import BATCH_BYTES, beside_text, mapped, quoted

LONG = 100_000
STEP = 50_000
# Places where the split pattern of byte-level BPE ends a match whatever follows: a letter or digit before ASCII white
# space, and inside unbroken ASCII text a change of class after a letter or digit. Letters of both sides of a boundary are
# classed alike by every Unicode version.
BOUNDARY = regex.compile(r"(?<=[\p{L}\p{N}])(?=[\x20\t\n\r])|(?<=[A-Za-z])(?=[\x21-\x40\x5B-\x60\x7B-\x7E])"
                         r"|(?<=[0-9])(?=[\x21-\x2F\x3A-\x7E])")


def pieces(text: str) -> Iterator[str]:
    """The text itself, or a long text in parts of about ``STEP`` characters that no match crosses."""
    start = 0
    while len(text) - start > LONG:
        cut = BOUNDARY.search(text, start + STEP)
        if cut is None or cut.start() >= len(text):
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encoding(rank_file: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines()) if token}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_ids(coder, text: str) -> np.ndarray:
    found = [np.asarray(coder.encode_ordinary(part), dtype=np.int32) for part in pieces(text)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def weighed(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices of a few megabytes of one column, so that a batch of long texts is not answered at once."""
    for batch in batches:
        sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], dtype=np.int32)[
            batch.column(column).offset:batch.column(column).offset + len(batch) + 1]) if len(batch) else []
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > BATCH_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < len(batch):
            yield batch.slice(start)


def rank_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Every row with ``out``: its text's token ids, each match of ``pattern`` encoded separately, no special tokens.

    A null text is encoded as an empty one (no ids). Long texts are split where no match crosses, which leaves the ids as
    they are and keeps the library's working memory small; a stretch without such a place stays whole. The rank file is
    read on the driver and sent along (under a megabyte). Rows stay in their partitions; a column named ``out`` is replaced.
    """
    kept = [c for c in df.columns if c.lower() != out.lower()]
    source, at = beside_text(df, kept, text)
    ranks = df.sparkSession.sparkContext.broadcast(rank_bytes(rank_file))

    def run(batches):
        coder = encoding(ranks.value, pattern)
        for batch in weighed(batches, at):
            found = [token_ids(coder, value.as_py() or "") for value in batch.column(at)]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found), type=pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], ids], names=[*kept, out])

    return mapped(source, run, df.select(*[quoted(c) for c in kept]).schema.add(out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row with ``out``: the bytes of its token ids (binary; ids cut inside a character stay raw bytes).

    Null ids decode to null, no ids to no bytes; an id that the ranks lack, or a null among the ids, raises. A column
    named ``out`` is replaced.
    """
    kept = [c for c in df.columns if c.lower() != out.lower()]
    source = df.select(*[quoted(c) for c in kept], quoted(ids).alias("_ids"))
    ranks = df.sparkSession.sparkContext.broadcast(rank_bytes(rank_file))

    def run(batches):
        coder = encoding(ranks.value, pattern)
        for batch in weighed(batches, len(kept)):
            found = [None if value is None else coder.decode_bytes(value) for value in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, type=pa.binary())], names=[*kept, out])

    return mapped(source, run, source.drop("_ids").schema.add(out, "binary"))
