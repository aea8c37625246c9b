"""Operator 3: embedding near-dedup by Euclidean p-stable hashing and exact cosine checks.

Vectors are normalised and projected on random Gaussian directions; each table's key is a group of
quantised projections. Vectors of one label that share a key in some table are compared by their cosine in
double precision. Equal vectors are one until the end, and large buckets are dealt over several tasks.

Buckets are first met by small rows: a vector's number and 128 signs of its projections on other directions. Only vectors
that have a partner in a bucket whose signs differ little bring their components there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import OWN, checkpointed
from rollkeep.llm.components import connected_components
from rollkeep.llm.simhash import smallest_linked


def collision(distance: float, width: float) -> float:
    """The probability that one quantised Gaussian projection agrees for two points at this distance."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(threshold: float, width: float, each: int, recall: float) -> int:
    """Tables that find a pair at the threshold with this probability, with `each` projections to a table."""
    p = collision(math.sqrt(2 - 2 * threshold), width) ** each
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled by their largest component first, so that no square over- or underflows."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def bucket_keys(unit_vectors: np.ndarray, tables: int, each: int, width: float, seed: int) -> np.ndarray:
    """A 32-bit key for each of n vectors and each table, from `each` quantised projections of the normalised vector."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((unit_vectors.shape[1], tables * each))
    shift = rng.uniform(0, width, tables * each)
    mix = rng.integers(1, 2**63, (tables, each), dtype=np.uint64) | np.uint64(1)
    cells = np.floor((unit_vectors @ a + shift) / width).astype(np.int64).astype(np.uint64).reshape(len(unit_vectors), tables, each)
    return ((cells * mix).sum(axis=2, dtype=np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signs(unit_vectors: np.ndarray, seed: int) -> np.ndarray:
    """128 bits for each vector, as two longs: on which side of random planes it lies."""
    planes = np.random.default_rng(seed + 1).standard_normal((unit_vectors.shape[1], 128))
    return np.packbits(unit_vectors @ planes > 0, axis=1).view(np.int64)


def most_signs(threshold: float, far: float = 6.5) -> int:
    """The signs of 128 in which vectors at the threshold differ at most, but for `far` standard deviations: one such pair in 10**10 has more."""
    p = math.acos(threshold) / math.pi
    return min(128, math.ceil(128 * p + far * math.sqrt(128 * p * (1 - p))))


_NAME = ("label", "bucket", "lo", "hi")


def _grouped(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.Table]:
    """Whole groups (label, bucket, lo, hi), which come one after another; about at_once rows a turn."""
    held: pa.Table | None = None
    for batch in batches:
        for k in range(0, batch.num_rows, at_once):
            got = pa.Table.from_batches([batch.slice(k, at_once)])
            held = got if held is None or not len(held) else pa.concat_tables([held, got])
            if len(held) >= at_once:
                name = np.stack([held[c].to_numpy().astype(np.int64) for c in _NAME], axis=1)
                last = np.flatnonzero((name[1:] != name[:-1]).any(axis=1))
                if len(last):  # the last group may go on in the next batch
                    yield held.slice(0, last[-1] + 1)
                    held = held.slice(last[-1] + 1)
    if held is not None and len(held):
        yield held


def _sides(block: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the two sides of each group; twice the same where a bucket, or a share of one, meets itself."""
    name = np.stack([block[c].to_numpy().astype(np.int64) for c in _NAME], axis=1)
    salt = block["salt"].to_numpy()
    ends = np.flatnonzero((name[1:] != name[:-1]).any(axis=1)) + 1
    for g in np.split(np.arange(len(name)), ends):
        lo, hi = name[g[0], 2:]
        yield (g, g) if lo == hi else (g[salt[g] == lo], g[salt[g] == hi])


def _partners(batches: Iterator[pa.RecordBatch], most: int, at_once: int = 4_000) -> Iterator[pa.RecordBatch]:
    """The rows of each group whose signs differ in at most `most` places from those of another row there."""
    for block in _grouped(batches, at_once):
        s = np.stack([block[c].to_numpy().view(np.uint64) for c in ("s0", "s1")], axis=1)
        found = np.zeros(len(block), bool)
        for one, two in _sides(block):
            differ = sum(np.bitwise_count(s[one, k][:, None] ^ s[two, k][None, :]).astype(np.int32) for k in (0, 1))
            near = differ <= most
            if one is two:
                np.fill_diagonal(near, False)
            found[one] |= near.any(axis=1)
            found[two] |= near.any(axis=0)
        names = [*_NAME, "salt", "rep"]
        yield pa.RecordBatch.from_arrays([pa.array(block[c].to_numpy()[found]) for c in names], names)


def _verify(batches: Iterator[pa.RecordBatch], threshold: float, at_once: int = 4_000) -> Iterator[pa.RecordBatch]:
    """Per group: for each vector with a link there, the copies newly linked and the smallest number reached."""
    for block in _grouped(batches, at_once):
        n = len(block)
        ids, weight, bucket = (block[c].to_numpy().astype(np.int64) for c in ("rep", "copies", "bucket"))
        sizes = block["embedding"].combine_chunks().value_lengths().to_numpy()
        flat, ends = block["embedding"].combine_chunks().flatten().to_numpy().astype(np.float64), np.r_[0, np.cumsum(sizes)]
        keys = block["keys"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        new, x, y = np.zeros(n, np.int64), [], []
        for one, two in _sides(block):
            if not len(one) or not len(two) or sizes[one[0]] != sizes[two[0]]:
                continue
            u, w = (unit(flat[ends[g][:, None] + np.arange(sizes[g[0]])]) for g in (one, two))
            i, j = np.nonzero(u @ w.T >= threshold - 1e-9)
            i, j = (i[i < j], j[i < j]) if one is two else (i, j)
            exact = np.einsum("ij,ij->i", u[i], w[j]) >= threshold
            i, j = one[i[exact]], two[j[exact]]
            x.append(i)
            y.append(j)
            t = int(bucket[one[0]] >> 32)
            first = ~(keys[i, :t] == keys[j, :t]).any(axis=1) if t else np.ones(len(i), bool)  # counted in the first table that has both
            np.add.at(new, i[first], weight[j[first]])
            np.add.at(new, j[first], weight[i[first]])
        x, y = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (x, y))
        by_id = np.argsort(ids, kind="stable")
        place = np.empty(n, np.int64)
        place[by_id] = np.arange(n)
        root = ids[by_id][smallest_linked(n, place[x], place[y])][place]
        out = np.flatnonzero((new > 0) | (root != ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(root[out]), pa.array(new[out])], ["a", "b", "links"])


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
    width: float = 2.0, each: int = 10, recall: float = 0.999, seed: int = 7, block: int = 1_000,
) -> DataFrame:
    """key, n_links, component_id and kept of each row.

    Rows link if their labels are equal and not null and the cosine of their vectors is at least threshold, in
    double precision. Null, empty, zero vectors and such with null or non-finite components, and rows with a null
    key, link with nothing and are kept. Vectors of different lengths never link. Repeated rows count as different
    rows. Keys and labels may be of any type that has an order; labels are named by 64 bits of hash. `recall` is the
    probability with which a pair right at the threshold is found; closer ones are found more surely. An empty table gives
    no rows. Other columns are not looked at.
    """
    tables = tables_for(threshold, width, each, recall)
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("embedding", lambda x: x != 0)
    fit = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & ~zero, F.lit(False))
    good = rows.where(fit)
    reps = good.groupBy("label", "embedding").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    reps = checkpointed(reps.withColumn("rep", F.monotonically_increasing_id()).withColumn("name", F.xxhash64("label")))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, n = batch["embedding"], len(batch)
            sizes = column.value_lengths().to_numpy()
            keys, sides = np.zeros((n, tables), np.int32), np.zeros((n, 2), np.int64)
            flat, ends = column.flatten().to_numpy(), np.r_[0, np.cumsum(sizes)]
            for size in np.unique(sizes):
                which = np.flatnonzero(sizes == size)
                v = unit(flat[ends[which, None] + np.arange(size)])
                keys[which] = bucket_keys(v, tables, each, width, seed)
                sides[which] = signs(v, seed)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * tables), pa.array(keys.reshape(-1)))
            # vectors of different lengths stay apart, as their labels' names do
            names = batch["label"].to_numpy() ^ (sizes.astype(np.int64) * 0x9E3779B97F4A7C1)
            yield pa.RecordBatch.from_arrays([batch["rep"], pa.array(names), pa.array(sides[:, 0].copy()), pa.array(sides[:, 1].copy()), lists], ["rep", "label", "s0", "s1", "keys"])

    hashed = reps.select("rep", F.col("name").alias("label"), "embedding").mapInArrow(keyed, "rep long, label long, s0 long, s1 long, keys array<int>")
    hashed = checkpointed(hashed)
    at = F.shiftleft(F.col("table").cast("long"), 32) + F.col("key").cast("long").bitwiseAND(0xFFFFFFFF)
    members = hashed.select("rep", "label", "s0", "s1", F.posexplode("keys").alias("table", "key")).select("rep", "label", "s0", "s1", at.alias("bucket"))
    sizes = members.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = checkpointed(sizes)
    dealt = members.join(sizes, ["label", "bucket"]).withColumn("parts", F.ceil(F.col("n") / block).cast("long"))
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("parts"))).withColumn("mate", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select("label", "bucket", F.least("salt", "mate").alias("lo"), F.greatest("salt", "mate").alias("hi"), "salt", "rep", "s0", "s1")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = most_signs(threshold)
    together = lambda df: df.repartition(n, *_NAME).sortWithinPartitions(*_NAME)
    met = checkpointed(together(dealt).mapInArrow(lambda it: _partners(it, most), "label long, bucket long, lo long, hi long, salt long, rep long"))
    brought = hashed.select("rep", "keys").join(reps.select("rep", "copies", "embedding"), "rep")
    found = checkpointed(together(met.join(brought, "rep")).mapInArrow(lambda it: _verify(it, threshold), "a long, b long, links long"))

    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("a", "b")).select(F.col("node").alias("rep"), "component")
    named = checkpointed(reps.join(counts, "rep", "left").join(parts, "rep", "left").withColumn("c", F.coalesce("component", "rep")))
    least = named.groupBy("c").agg(F.min("least").alias("smallest"))
    named = checkpointed(named.join(least, "c").select(F.col("label").alias(f"{OWN}l"), F.col("embedding").alias(f"{OWN}e"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "smallest"))
    linked = good.join(named, (F.col("label") == F.col(f"{OWN}l")) & (F.col("embedding") == F.col(f"{OWN}e")))
    linked = linked.select("id", "n_links", F.col("smallest").alias("component_id"))
    alone = rows.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
