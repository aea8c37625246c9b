"""Operator 1: byte-level BPE encoding and decoding with DuckDB recursive queries in each partition.

Each distinct piece of the pattern becomes one row a byte (w: piece, p: place, t: token). A recursive
query joins neighbouring tokens with the merge table, contracts the leftmost pair of the smallest rank
of every piece, and goes on until no piece has a pair left. Decoding gathers the bytes of each text's
ids by an ordered aggregation. Rows of a piece stay in order of p throughout; the queries check this.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.chunks import ChunkEncoder, joined
from rollkeep.llm.common import slices

#: Longer pieces are first cut where no token of the vocabulary can cross; what is still longer goes through LONG below.
SHORT = 64

_PAIRS = """
     select q.*, m.r from (
       select w, p, t, {more} case when lead(w) over () = w then
           case when lead(p) over () > p then t::bigint << 20 | lead(t) over () else error('order of tokens lost') end
         end as ab
       from s where not done) q left join merges m on m.ab = q.ab"""

#: One contraction for each piece and turn: the leftmost pair of the smallest rank.
PLAIN = f"""
with recursive s(w, p, t, done) as (
  select w, p, t, false from tokens
  union all
  (with x as materialized ({_PAIRS.format(more="")}),
   b as materialized (select w, min(r::bigint << 32 | p) as best from x where r is not null group by w)
   select w, p, case when mine then r else t end, done from (
     select w, p, t, r, mine, done, lag(mine, 1, false) over () as gone from (
       select x.w, x.p, x.t, x.r, coalesce((x.r::bigint << 32 | x.p) = b.best, false) as mine, b.best is null as done
       from x left join b on b.w = x.w)) where not gone)
) select w, p, t from s where done"""

#: For long pieces: contracts every occurrence of the smallest pair in one turn where this equals contracting the
#: leftmost one again and again, which holds unless the new token has a merge of smaller rank with a token of the piece.
LONG = f"""
with recursive s(w, p, t, done, turn) as (
  select w, p, t, false, 0 from tokens
  union all
  (with x as materialized ({_PAIRS.format(more="turn,")} where turn < {{turns}}),
   b as materialized (select w, min(r::bigint << 32 | p) as best from x where r is not null group by w),
   odd as materialized (
     select distinct b.w from b join early e on e.new = (b.best >> 32) join x on x.w = b.w and x.t = e.other),
   hit as materialized (
     select x.w, x.p, x.t, x.r, x.turn, b.best is null as done,
       case when b.best is null or x.r is null then false
            when odd.w is not null then (x.r::bigint << 32 | x.p) = b.best
            else x.r = (b.best >> 32) end as hit
     from x left join b on b.w = x.w left join odd on odd.w = x.w),
   runs as materialized (
     select *, sum(case when hit then 0 else 1 end) over (rows unbounded preceding) as run from hit),
   mine as materialized (
     select *, hit and (row_number() over (partition by run, hit order by w, p)) % 2 = 1 as mine from runs)
   select w, p, case when mine then r else t end, done, turn + 1 from (
     select *, lag(mine, 1, false) over (order by w, p) as gone from mine) where not gone order by w, p)
) select w, p, t, done from s where done or turn = {{turns}} order by w, p"""

DECODE = "select g, string_agg(v.hex, '' order by p) as hex from tokens join vocabulary v on v.id = tokens.t group by g"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file: base64 token and number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Merges:
    """A DuckDB connection with the merge table and the vocabulary of one rank file; one for each Python worker."""

    _open: dict[str, Merges] = {}

    def __init__(self, path: str) -> None:
        import duckdb

        ranks = read_ranks(path)
        rows = [(a, b, r) for token, r in ranks.items() for k in range(1, len(token)) if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None]
        a, b, r = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        early = r < np.maximum(a, b)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "preserve_insertion_order": True})
        self._load("merges", {"ab": a << 20 | b, "r": r.astype(np.int32)})
        self._load("early", {"new": np.concatenate([a[early], b[early]]), "other": np.concatenate([b[early], a[early]]).astype(np.int32)})
        self._load("vocabulary", {"id": np.array(list(ranks.values()), np.int32), "hex": [x.hex() for x in ranks]})
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.two, self.three = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        self.two[[x[0] << 8 | x[1] for x in ranks if len(x) == 2]] = True
        self.three[[x[i] << 16 | x[i + 1] << 8 | x[i + 2] for x in ranks for i in range(len(x) - 2)]] = True

    @classmethod
    def of(cls, path: str) -> Merges:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace temp table {name} as select * from given")
        self.db.unregister("given")

    def cuts(self, piece: bytes) -> list[bytes]:
        """The piece cut wherever no token of the vocabulary can cross, so that each part contracts by itself.

        A token across two bytes is these two, or has them with the byte before or with the one after.
        """
        b = np.frombuffer(piece, np.uint8).astype(np.int32)
        pair = b[:-1] << 8 | b[1:]
        crossed = self.two[pair]
        triple = self.three[b[:-2] << 16 | pair[1:]]
        crossed[:-1] |= triple
        crossed[1:] |= triple
        ends = np.flatnonzero(~crossed) + 1
        return [piece[i:j] for i, j in zip([0, *ends.tolist()], [*ends.tolist(), len(piece)], strict=True)]

    def encode(self, pieces: Sequence[str], at_once: int = 20_000, long_bytes: int = 100_000) -> list[bytes]:
        """The ids of each piece, as the merges of the whole piece give them."""
        data = [x.encode("utf-8", "surrogatepass") for x in pieces]
        parts = {i: self.cuts(x) for i, x in enumerate(data) if len(x) > SHORT}
        units = list({x for i, x in enumerate(data) if x and i not in parts} | {x for cut in parts.values() for x in cut})
        out: list[bytes] = [b""] * len(units)
        short = [i for i, x in enumerate(units) if len(x) <= SHORT]
        for k in range(0, len(short), at_once):
            self._turns(units, short[k : k + at_once], out, False)
        group: list[int] = []
        for i in [*(i for i, x in enumerate(units) if len(x) > SHORT), None]:  # long ones together, as far as memory is bounded
            if group and (i is None or sum(len(units[j]) for j in group) + len(units[i]) > long_bytes):
                self._turns(units, group, out, True)
                group = []
            if i is not None:
                group.append(i)
        known = dict(zip(units, out, strict=True))
        return [b"".join([known[x] for x in parts[i]]) if i in parts else known.get(x, b"") for i, x in enumerate(data)]

    def _turns(self, data: list[bytes], which: list[int], out: list[bytes], long: bool) -> None:
        sizes = np.array([len(data[i]) for i in which])
        w = np.repeat(np.arange(len(which), dtype=np.int32), sizes)
        p = np.arange(len(w), dtype=np.int32)
        t = self.byte[np.frombuffer(b"".join(data[i] for i in which), np.uint8)]
        while True:
            self._load("tokens", {"w": w, "p": p, "t": t})
            if not long:
                got = self.db.sql(PLAIN).to_arrow_table()
                order = np.lexsort((got["p"].to_numpy(), w := got["w"].to_numpy()))
                w, t = w[order], got["t"].to_numpy()[order]
                break
            got = self.db.sql(LONG.format(turns=max(1, min(64, 2_000_000 // len(w))))).to_arrow_table()
            w, p, t = (got[c].to_numpy() for c in "wpt")
            if got["done"].to_numpy(zero_copy_only=False).all():
                break
        ends = np.searchsorted(w, np.arange(len(which) + 1)) * 4
        ids = t.astype("<u4").tobytes()
        for k, i in enumerate(which):
            out[i] = ids[ends[k] : ends[k + 1]]

    def decode(self, ids: Sequence[bytes]) -> list[bytes]:
        """The bytes of each id sequence (little-endian unsigned 32-bit); an id outside the vocabulary raises."""
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        t = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        self._load("tokens", {"g": np.repeat(np.arange(len(ids), dtype=np.int32), sizes), "p": np.arange(len(t), dtype=np.int32), "t": t})
        if self.db.execute("select count(*) from tokens anti join vocabulary v on v.id = tokens.t").fetchall()[0][0]:
            raise ValueError("an id is not in the vocabulary")
        out = [b""] * len(ids)
        for i, text in self.db.execute(DECODE).fetchall():
            out[i] = bytes.fromhex(text)
        return out


class Codec:
    """Encoder and decoder of whole texts over one rank file and pattern; remembers distinct pieces, up to a number."""

    _open: dict[tuple[str, str], Codec] = {}

    def __init__(self, path: str, pattern: str, keep: int = 250_000) -> None:
        import regex

        self.merges, self.split, self.keep = Merges.of(path), regex.compile(pattern).findall, keep
        self.pieces: dict[str, bytes] = {}
        self.chunks = ChunkEncoder(self._chunks, keep)

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._open:
            cls._open[path, pattern] = cls(path, pattern)
        return cls._open[path, pattern]

    def _chunks(self, new: Sequence[str]) -> Iterator[bytes]:
        return joined([self.split(x) for x in new], self.pieces, self.merges.encode, self.keep)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        return self.chunks.encode(texts)

    def decode(self, ids: Iterable[bytes], at_once: int = 4_000_000) -> Iterator[bytes]:
        """Bytes of each id sequence; works on about at_once bytes of ids at a time."""
        group: list[bytes] = []
        held = 0
        for one in ids:
            group.append(one)
            held += len(one)
            if held >= at_once:
                yield from self.merges.decode(group)
                group, held = [], 0
        if group:
            yield from self.merges.decode(group)


def _add(df: DataFrame, fn, schema: str) -> DataFrame:
    return df.mapInArrow(fn, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), schema]))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """df with ids (array of int) and n_tokens (long) of each whole text, without special tokens.

    path: the rank file, present on every executor; pattern: what splits a text before the merges.
    Null and empty texts give no ids; repeated rows stay; other columns pass through, but for input columns named
    ids or n_tokens, which are replaced. An empty table gives no rows. No shuffle.
    """
    df = df.drop("ids", "n_tokens")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for batch in slices(batches):
            found = list(codec.encode(batch[text].to_pylist()))
            sizes = np.array([len(x) // 4 for x in found], np.int64)
            flat = pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(sizes)], [*batch.schema.names, "ids", "n_tokens"])

    return _add(df, rows, "ids array<int>, n_tokens long")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """df with decoded (binary): the bytes that the ids stand for. Null ids give null, none give empty bytes; unknown ids raise. An input column named decoded is replaced."""
    df = df.drop("decoded")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for batch in slices(batches):
            given = batch[ids].to_pylist()
            data = codec.decode(np.array(x or [], "<u4").tobytes() for x in given)
            out = pa.array([None if x is None else y for x, y in zip(given, data, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "decoded"])

    return _add(df, rows, "decoded binary")


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of each row: encodes, decodes the ids again, and keeps digests only.

    Both steps run on the same partition, so neither ids nor bytes leave the worker. Null and empty texts have no ids;
    repeated rows stay; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for batch in slices(batches):
            sizes: list[int] = []
            names: list[str] = []

            def ids(texts=batch["text"].to_pylist(), sizes=sizes, names=names) -> Iterator[bytes]:
                for one in codec.encode(texts):
                    sizes.append(len(one) // 4)
                    names.append(hashlib.sha256(one).hexdigest())
                    yield one

            back = [hashlib.sha256(x).hexdigest() for x in codec.decode(ids())]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(sizes, pa.int64()), pa.array(names, pa.string()), pa.array(back, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(rows, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
