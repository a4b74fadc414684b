"""Token ids as ORC: sorted stripes of run-length encoded integers with row indexes and Bloom filters."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Chunks in the young table of a Python worker. When it is full it becomes the old one, and what is
#: used again moves on from there, so that frequent chunks are never encoded anew.
CACHED_CHUNKS = 350_000

#: Texts encoded together.
GROUP = 400

#: ORC writer settings: integers are run-length encoded (version 2) by the format itself.
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}

#: Marks at the end of a word that are a piece by themselves.
_MARKS = ".,;:!?"

#: Stands for a chunk whose text must not be cut around it; the ids of any other chunk are not empty.
_UNCUT = b""


class ChunkEncoder:
    """The tokenizers library with a memory for text between single blanks and newlines.

    The pre-splitting pattern of byte-level vocabularies always starts a new piece at a blank that
    stands alone between other characters, and makes a lone newline a piece by itself, so a text may be cut
    there. A chunk stands for itself with a blank before; one that begins with a newline has no blank. A
    word's letters and the marks behind them are pieces of their own, so a chunk of both is put together.
    Texts with other white space next to a blank, or with what may be a special token, are not cut.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.newline = self._batch(["\n"])[0]
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _batch(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _marks(self, text: str) -> bytes:
        found = self.marks.get(text)
        if found is None:
            found = self.marks[text] = self._batch([text])[0]
        return found

    def _learn(self, chunks: set[str]) -> None:
        """Fill the young table with chunks that it lacks."""
        known, old, composed, new, odd = self.known, self.old, [], set(), []
        for chunk in chunks:
            if (ids := old.get(chunk)) is not None:
                known[chunk] = ids
                continue
            body = chunk[1:] if chunk[:1] == "\n" else chunk
            if not body or body[0].isspace() or body[-1].isspace() or "<|" in body:
                known[chunk] = _UNCUT
            elif "\n" in body:
                odd.append(chunk)
            else:
                word = body.rstrip(_MARKS)
                if len(word) < len(body) and word.isalpha():
                    base = chunk[: len(chunk) - len(body) + len(word)]
                    composed.append((chunk, base, body[len(word) :]))
                    if base not in known and base not in chunks:
                        if (ids := old.get(base)) is not None:
                            known[base] = ids
                        else:
                            new.add(base)
                else:
                    new.add(chunk)
        self._encode_words([c for c in new if c[0] != "\n"], " ", b"")
        self._encode_words([c for c in new if c[0] == "\n"], "", self.newline)
        known.update(zip(odd, self._batch([c if c[0] == "\n" else " " + c for c in odd])))
        known.update((chunk, known[base] + self._marks(marks)) for chunk, base, marks in composed)

    def _encode_words(self, chunks: list[str], blank: str, before: bytes) -> None:
        """Encode chunks without a newline inside, many to a text: a lone newline is a piece by itself."""
        groups = [chunks[k : k + GROUP] for k in range(0, len(chunks), GROUP)]
        joined = self._batch(["\n".join(blank + c.lstrip("\n") for c in g) for g in groups])
        newline = int.from_bytes(self.newline, "little")
        for group, ids in zip(groups, joined):
            ends = (np.flatnonzero(np.frombuffer(ids, "<u4") == newline) * 4).tolist()
            self.known.update(
                (c, before + ids[i:j]) for c, i, j in zip(group, [0, *(e + 4 for e in ends)], [*ends, len(ids)])
            )

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """The text's first chunk and all others; an empty first one keeps a text whole."""
        if "\n\n" not in text:
            return text.replace("\n", " \n").split(" ")
        # Blank lines stay inside their chunk. One that begins with a newline would be taken for a cut.
        return [""] if " \n" in text else text.split(" ")

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        """Ids of each text with the end id, as little-endian 32-bit integers.

        Each different chunk of the texts is looked up once.
        """
        if len(self.known) > CACHED_CHUNKS:
            self.known, self.old = {}, self.known
        cut = list(map(self._chunks, texts))
        first = np.cumsum([0, *(len(c) - 1 for c in cut)])
        every = list(chain.from_iterable(c[1:] for c in cut))
        # Both name the different chunks in the order of their first places.
        chunks, places = list(dict.fromkeys(every)), pa.array(every, pa.large_string()).dictionary_encode().indices
        self._learn({c for c in chunks if c not in self.known})
        ids = pa.array(list(map(self.known.__getitem__, chunks)), pa.large_binary()).take(places)
        _, offset_buffer, data_buffer = ids.buffers()
        offsets = np.frombuffer(offset_buffer or bytes(8), np.int64)[ids.offset : ids.offset + len(ids) + 1]
        data = memoryview(data_buffer or b"")
        # A chunk that must not be cut has no ids, nor has a text's first one if the text is kept whole.
        open_chunks = np.flatnonzero(offsets[1:] == offsets[:-1])
        uncut = set((np.searchsorted(first, open_chunks, side="right") - 1).tolist())
        uncut |= {k for k, c in enumerate(cut) if not c[0]}
        heads = self._batch([t if k in uncut else c[0] for k, (t, c) in enumerate(zip(texts, cut))])
        at = offsets[first].tolist()
        return [
            b"".join((head, end)) if k in uncut else b"".join((head, data[at[k] : at[k + 1]], end))
            for k, head in enumerate(heads)
        ]


@lru_cache(maxsize=2)
def encoder(definition: str) -> ChunkEncoder:
    return ChunkEncoder(definition)


def encoded(docs: DataFrame, definition: str, end_id: int) -> DataFrame:
    """(seq, doc_id, n_tokens, ids) in ascending doc_id order; ``seq`` numbers the rows in that order.

    A null text counts as empty and has the end id alone. A null doc_id comes first; rows that share
    a doc_id are ordered by text. Texts are sorted, not ids: they are the smaller.
    """
    end = np.array([end_id], "<u4").tobytes()

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with_cache = encoder(definition)
        for batch in batches:
            # Handed on in small parts, so that a batch is never held whole in both forms.
            for k in range(0, len(batch), GROUP):
                found = with_cache.encode([t or "" for t in batch[k : k + GROUP].to_pylist()], end)
                offsets = np.cumsum([0, *(len(x) // 4 for x in found)])
                values = pa.array(np.frombuffer(b"".join(found), "<i4"))
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    ordered = (
        docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    return ordered.select(
        F.monotonically_increasing_id().alias("seq"), "doc_id", ids(F.col("text")).alias("ids")
    ).select("seq", "doc_id", F.size("ids").alias("n_tokens"), "ids")


def write_tokens(docs: DataFrame, path: str, definition: str, end_id: int = 2) -> None:
    """Write the token file set: one ORC file per range of doc_id, rows in doc_id order.

    Readers take stripes in parallel, skip them by the doc_id statistics of stripes and row groups,
    and look single documents up through the Bloom filters. An empty table gives files without rows.
    """
    encoded(docs, definition, end_id).write.mode("error").options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("seq bigint, doc_id bigint, n_tokens int, ids array<int>").orc(path)


def with_starts(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``start``: the number of ids of all documents before.

    Running counts inside each file's rows and one offset per file; the window over all files holds
    one row per file.
    """
    part = tokens.withColumn("_part", F.shiftrightunsigned("seq", 33))
    sums = part.groupBy("_part").agg(F.sum("n_tokens").alias("_n"))
    before = sums.select(
        F.col("_part").alias("_of"),
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias(
            "_offset"
        ),
    )
    inside = F.sum("n_tokens").over(
        Window.partitionBy("_part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    ) - F.col("n_tokens")
    return (
        part.withColumn("_inside", inside)
        .join(before, F.col("_part") == F.col("_of"))
        .withColumn("start", (F.col("_offset") + F.col("_inside")).cast("long"))
        .drop("_part", "_of", "_offset", "_inside")
    )


def ids_crc32(ids: Column) -> Column:
    """crc32 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("bigint")
    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data = np.ascontiguousarray(batch.values.to_numpy(), "<u4")
            at = batch.offsets.to_pylist()
            yield pa.array([zlib.crc32(data[i:j]) for i, j in zip(at, at[1:])], pa.int64())

    return crc(ids)
