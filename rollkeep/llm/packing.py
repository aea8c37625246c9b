"""Operator 5: pack documents into sequences of a fixed length, by bounded-space online best fit.

Documents are tokenised and cut where they lie. The small piece rows are then dealt by hash, and each
partition is packed by itself as pieces come: a fixed number of open sequences in a bitset keyed by free
space; a piece goes where it leaves the least space; when no more may be open, the fullest is closed.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.chunks import ChunkEncoder
from rollkeep.llm.common import checkpointed, slices

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts as the tokenizers library gives them from this file, without adding special tokens of its own.

    A text that holds the string of one of the vocabulary's added tokens, as <|endoftext|>, is encoded whole, as only the
    library finds these; all others go chunk by chunk.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.chunks = ChunkEncoder(_ids_of(self.model))

    @classmethod
    def of(cls, path: str) -> Encoder:
        """Each worker opens the vocabulary once."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def encode(self, texts: Sequence[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, in order; null counts as empty."""
        whole = [bool(t) and any(a in t for a in self.added) for t in texts]
        for text, alone, ids in zip(texts, whole, self.chunks.encode(None if w else t for t, w in zip(texts, whole, strict=True)), strict=True):
            yield np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if alone else ids


def _ids_of(model) -> Callable[[Sequence[str]], list[bytes]]:
    """A function that encodes distinct chunks.

    Chunks that begin with a space and end otherwise stay apart when joined, so they are encoded as one text; the
    bytes of each token tell where one ends. Others are encoded one by one.
    """
    vocabulary = model.get_vocab()
    size = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        size[i] = len(token)  # this vocabulary writes one character for each byte

    def encode(new: Sequence[str], at_once: int = 20_000) -> list[bytes]:
        out: list[bytes] = [b""] * len(new)
        alike = [i for i, c in enumerate(new) if c[0] == " " and not c[-1].isspace()]
        for k in range(0, len(alike), at_once):
            part = alike[k : k + at_once]
            ids = np.array(model.encode_batch_fast(["".join([new[i] for i in part])], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(new[i].encode()) for i in part])
            after = np.searchsorted(np.cumsum(size[ids]), ends) + 1
            data, begin = ids.tobytes(), 0
            for i, end in zip(part, (after * 4).tolist(), strict=True):
                out[i] = data[begin:end]
                begin = end
        other = [i for i, x in enumerate(out) if not x]
        for i, x in zip(other, model.encode_batch_fast([new[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = np.array(x.ids, "<u4").tobytes()
        return out

    return encode


def cut(df: DataFrame, path: str, size: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text", id_bytes: int = 4) -> DataFrame:
    """Pieces of the tokenised documents: key, piece, start, length, ids (binary), ids_crc32.

    ids are little-endian unsigned numbers of id_bytes (2 or 4) bytes; an id that does not fit raises. ids_crc32 is that of
    four-byte ids.

    path: a byte-level BPE vocabulary file of the tokenizers library, present on every executor. A document is
    its ids and the id `end`. Longer ones than `size` are cut so that every piece but the first has `size` ids.
    Null and empty texts give one piece that holds `end` alone; repeated rows are separate documents.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = Encoder.of(path), np.array([end], "<u4").tobytes()
        for batch in slices(batches):
            at, number, start, ids = [], [], [], []
            for i, one in enumerate(encoder.encode(batch["text"].to_pylist())):
                one += tail
                n = len(one) // 4
                first = n % size or size
                for k, a in enumerate([0, *range(first, n, size)]):
                    at.append(i)
                    number.append(k)
                    start.append(a)
                    ids.append(one[a * 4 : (a + size if k else first) * 4])
            length = pa.array([len(x) // 4 for x in ids], pa.int64())
            crc = pa.array([zlib.crc32(x) for x in ids], pa.int64())
            if id_bytes == 2:
                ids = [narrow(x) for x in ids]
            columns = [batch["key"].take(pa.array(at, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), length, pa.array(ids, pa.binary()), crc]
            yield pa.RecordBatch.from_arrays(columns, [key, "piece", "start", "length", "ids", "ids_crc32"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(rows, f"`{key}` {kind}, piece int, start long, length long, ids binary, ids_crc32 long")


def narrow(ids: bytes) -> bytes:
    """Four-byte ids as two-byte ids."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() > 0xFFFF:
        raise ValueError("an id does not fit into two bytes")
    return wide.astype("<u2").tobytes()


class OpenBins:
    """At most `most` open sequences of `size` places; bit f of the bitset tells that one with f free places is open."""

    def __init__(self, size: int, most: int, first: int = 0) -> None:
        self.size, self.most, self.next = size, most, first
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits, self.n = 0, 0

    def put(self, length: int) -> tuple[int, int]:
        """The sequence and the offset that a piece of this length gets."""
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            number = self._take(free)
        else:
            if self.n == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.size, self.next
            self.next += 1
        if left := free - length:
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.n += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        self.n -= 1
        if not self.by_free[free]:
            self.bits ^= 1 << free
        return number


def pack(pieces: DataFrame, size: int = 2048, open_bins: int = 4096, rows_each: int = 40_000) -> DataFrame:
    """pieces (with a column length, 1 to size) with sequence_id and offset.

    Partitions of about rows_each pieces are packed apart, so each wastes at most the space of its last open
    sequences; no task sees more. The order within a partition is that of a hash of the row, so a run on the
    same rows gives the same packing. A null length or one out of range raises. No pieces give no rows. Input columns of these
    names are replaced.
    """
    pieces = checkpointed(pieces.drop("sequence_id", "offset"))
    count = pieces.count()
    order = F.xxhash64(*pieces.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins = OpenBins(size, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            lengths = batch["length"].to_pylist()
            if not all(x is not None and 1 <= x <= size for x in lengths):
                raise ValueError(f"a piece's length is not within 1 and {size}")
            places = np.array([bins.put(x) for x in lengths], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places[:, 0]), pa.array(places[:, 1])], [*batch.schema.names, "sequence_id", "offset"])

    dealt = pieces.repartition(max(1, -(-count // rows_each)), order).sortWithinPartitions(order, *[F.col(f"`{c}`") for c in pieces.columns])
    return dealt.mapInArrow(rows, schema)
