"""Operator 9: SimHash near-dedup with a binary trie self-join.

Fingerprints that differ in at most two bits agree in two of their four 16-bit quarters at least. So
distinct fingerprints meet under the six keys of two quarters; keys with one fingerprint end there.
Under a key, node pairs of the fingerprints' binary trie are walked down together, bit by bit, counting
differing bits, and pruned once over budget. Keys with many fingerprints are dealt over several tasks.

The pipeline stage keeps one of texts whose sets of five-word shingles are similar. There fingerprints are cut
into ten parts and the trie join has a larger budget; only texts that it finds together bring their shingles, and
pairs are confirmed by the exact similarity where they meet, so that no table of candidate pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import OWN, checkpointed, slices
from rollkeep.llm.components import connected_components
from rollkeep.llm.filters import member_filter

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()  # bytes split at space and \t to \r


def _shingles(w: list[bytes], words: int) -> bytes:
    """Eight bytes of hash for each shingle of so many words; fewer words are one shingle, none give none."""
    from xxhash import xxh64_digest

    if not w:
        return b""
    shingles = map(b" ".join, zip(*(w[k:] for k in range(words)))) if len(w) >= words else [b" ".join(w)]
    return b"".join(map(xxh64_digest, shingles, repeat(42)))


def _majority(data: bytes) -> int:
    n = len(data) // 8
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(data), 1 << 19):  # bounded memory for very long texts
        ones += np.unpackbits(np.frombuffer(data[k : k + (1 << 19)], np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text's shingles of so many words, repeats included; 0 without any word."""
    return _majority(_shingles(_words(text), words))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """key and fp (long, the fingerprint's bits) of each row; null text counts as empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(x, words) for x in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(found.view(np.int64))], [key, "fp"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(rows, f"`{key}` {kind}, fp long")


def trie_pairs(fp: np.ndarray, group: np.ndarray, side: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal group whose fp (uint64) differ in at most budget bits.

    Groups with one side (0) are joined with themselves, groups with sides 0 and 1 with each other only.
    Equal values of a group and side are pairs as well. All groups walk down together, one bit a turn; a trie
    node is a range of the sorted values, as those with a common prefix stand together.
    """
    order = np.lexsort((fp, side, group))
    fp, group, side = fp[order], group[order], side[order]
    n = len(fp)
    head = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])]) if n else np.zeros(0, np.int64)
    tail = np.r_[head[1:], n] if n else head
    paired = np.r_[group[head[1:]] == group[head[:-1]], False] if n else np.zeros(0, bool)  # a side 0 before its side 1
    other = np.where(paired, np.arange(len(head)) + 1, np.arange(len(head)))
    first = np.r_[True, ~paired[:-1]] if n else paired
    use = first & (paired | (side[head] == 0))
    a0, a1, b0, b1 = head[use], tail[use], head[other[use]], tail[other[use]]
    diff = np.zeros(len(a0), np.int64)
    left, right = [], []
    for bit in range(63, -1, -1):
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            x, y = a0[single], b0[single]
            near = (np.bitwise_count(fp[x] ^ fp[y]) <= budget) & (x != y)
            left.append(x[near])
            right.append(y[near])
            a0, a1, b0, b1, diff = (v[~single] for v in (a0, a1, b0, b1, diff))
        if not len(a0):
            break
        ones = np.r_[0, np.cumsum((fp >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        cross = a0 != b0
        parts = [(a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1), tuple(v[cross] for v in (am, a1, b0, bm, diff + 1))]
        a0, a1, b0, b1, diff = (np.concatenate(v) for v in zip(*parts, strict=True))
        stay = (a1 > a0) & (b1 > b0) & (diff <= budget) & ((a0 != b0) | (a1 - a0 > 1))
        a0, a1, b0, b1, diff = (v[stay] for v in (a0, a1, b0, b1, diff))
    each = (a1 - a0) * (b1 - b0)  # ranges of equal values remain
    at = np.repeat(np.arange(len(a0)), each)
    off = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
    x, y = a0[at] + off // (b1 - b0)[at], b0[at] + off % (b1 - b0)[at]
    once = (a0 != b0)[at] | (x < y)
    left.append(x[once])
    right.append(y[once])
    x, y = np.concatenate(left), np.concatenate(right)
    return order[x[x != y]], order[y[x != y]]


def smallest_linked(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of n places, the smallest place that the pairs x, y reach from it."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if (root == before).all():
            return root


def _whole(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], at_once: int) -> Iterator[np.ndarray]:
    """Rows of columns, the first three of which name groups that come one after another; whole groups, about at_once rows a turn."""
    held: list[np.ndarray] = []
    count = 0
    for batch in batches:
        for k in range(0, batch.num_rows, at_once):
            part = batch.slice(k, at_once)
            rows = np.stack([part[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in columns], axis=1)
            held.append(rows)
            count += len(rows)
            if count >= at_once:
                rows = np.concatenate(held)
                last = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1))
                if len(last):  # the last group may go on in the next batch
                    yield rows[: last[-1] + 1]
                    rows = rows[last[-1] + 1 :]
                held, count = [rows], len(rows)
    if count:
        yield np.concatenate(held)


def _pairs(rows: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    _, group = np.unique(rows[:, :3], axis=0, return_inverse=True)
    return trie_pairs(rows[:, 4].view(np.uint64), group.reshape(-1), (rows[:, 3] != rows[:, 1]).astype(np.int8), budget)


def _join(batches: Iterator[pa.RecordBatch], budget: int, at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Links of the groups (key, lo, hi), which come one after another: each fingerprint with the smallest one it reaches."""
    for rows in _whole(batches, ("key", "lo", "hi", "salt", "fp"), at_once):
        x, y = _pairs(rows, budget)
        order = np.argsort(rows[:, 4], kind="stable")
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows))
        root = smallest_linked(len(rows), place[x], place[y])
        linked = np.flatnonzero(root != np.arange(len(rows)))
        fp = rows[order, 4]
        yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], ["a", "b"])


def _dealt(fps: DataFrame, parts: int, block: int) -> DataFrame:
    """Rows of fps under the keys of two of their fingerprint's parts, as groups (key, lo, hi) that stand together.

    A key with over `block` rows is dealt by a hash into shares of about `block`; each pair of shares is a group of
    its own, so no group grows with the data.
    """
    width = 64 // parts
    part = [F.shiftrightunsigned("fp", width * k).bitwiseAND((1 << width) - 1) for k in range(parts)]
    keys = F.array(*[F.lit(i << 32) + F.shiftleft(part[p], width) + part[q] for i, (p, q) in enumerate(combinations(range(parts), 2))])
    members = fps.select("*", F.explode(keys).alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("of")).where("of > 1")
    sizes = checkpointed(sizes)
    dealt = members.join(sizes, "key").withColumn("parts", F.ceil(F.col("of") / block).cast("long"))
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64(*fps.columns), F.col("parts"))).withColumn("mate", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("salt", "mate").alias("lo"), F.greatest("salt", "mate").alias("hi"), "salt", *fps.columns)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def near_links(fps: DataFrame, budget: int = 2, block: int = 1_000) -> DataFrame:
    """Links (a, b) that join all values of fps (distinct fp: long) within budget differing bits of each other, directly or through others.

    budget is at most 2: with more, two values need not share two quarters, and the meeting would miss some.
    """
    if budget > 2:
        raise ValueError("the budget is 2 bits at most")
    return _dealt(fps, 4, block).mapInArrow(lambda it: _join(it, budget), "a long, b long")


def _fitting(rows: np.ndarray, budget: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (key, lo, hi, salt, fp, id, n) within budget bits whose sizes n can be similar; each under the first key that both have only."""
    width = 64 // parts
    two = np.array(list(combinations(range(parts), 2)))
    x, y = _pairs(rows, budget)
    n, fp = rows[:, 6], rows[:, 4].view(np.uint64)
    fit = 5 * np.minimum(n[x], n[y]) >= 4 * np.maximum(n[x], n[y])
    x, y = x[fit], y[fit]
    unlike = fp[x] ^ fp[y]
    same = np.stack([(unlike >> np.uint64(width * k)) & np.uint64((1 << width) - 1) == 0 for k in range(parts)], axis=1)
    one = same.argmax(axis=1)
    same[np.arange(len(x)), one] = False
    here = (np.stack([one, same.argmax(axis=1)], axis=1) == two[rows[x, 0] >> 32]).all(axis=1)
    return x[here], y[here]


_GROUP = ("key", "lo", "hi", "salt", "fp", "id", "n")


def _members(batches: Iterator[pa.RecordBatch], budget: int, parts: int, at_once: int = 6_000) -> Iterator[pa.RecordBatch]:
    """The rows of each group that have a fitting row there."""
    for rows in _whole(batches, _GROUP, at_once):
        x, y = _fitting(rows, budget, parts)
        rows = rows[np.unique(np.r_[x, y])]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(_GROUP))], list(_GROUP))


def shared_shingles(x: np.ndarray, y: np.ndarray, flat: np.ndarray, ends: np.ndarray, at_once: int = 2_000_000) -> np.ndarray:
    """How many values the sets x[i] and y[i] share; set k is flat[ends[k]:ends[k + 1]], its values distinct."""
    _, value = np.unique(flat, return_inverse=True)
    span = int(value.max(initial=0)) + 1
    size = np.diff(ends)
    held = np.sort(np.repeat(np.arange(len(size)), size) * span + value)
    swap = size[x] > size[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    out = np.zeros(len(x), np.int64)
    cuts = np.searchsorted(np.cumsum(size[x]), np.arange(at_once, int(size[x].sum()) + at_once, at_once)) + 1
    begin = 0
    for end in np.minimum(cuts, len(x)):
        if end > begin:
            p, q = x[begin:end], y[begin:end]
            of = np.repeat(np.arange(len(p)), size[p])
            off = np.arange(len(of)) - np.repeat(np.cumsum(size[p]) - size[p], size[p])
            asked = q[of] * span + value[ends[p][of] + off]
            at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            out[begin:end] = np.bincount(of, held[at] == asked, len(p))
            begin = end
    return out


def _linked(batches: Iterator[pa.RecordBatch], budget: int, parts: int, at_once: int = 3_000) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of ids whose sets s are similar: in each group, every id with the smallest one that it reaches there."""

    def links(table: pa.Table) -> pa.RecordBatch:
        rows = np.stack([table[c].to_numpy().astype(np.int64) for c in _GROUP], axis=1)
        sets = table["s"].combine_chunks()
        flat, ends = sets.flatten().to_numpy(), np.r_[0, np.cumsum(sets.value_lengths().to_numpy())].astype(np.int64)
        x, y = _fitting(rows, budget, parts)
        n = np.diff(ends)
        close = 9 * shared_shingles(x, y, flat, ends) >= 4 * (n[x] + n[y])
        ids = rows[:, 5]
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = ids[order][smallest_linked(len(ids), place[x[close]], place[y[close]])][place]
        out = np.flatnonzero(root != ids)
        return pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(root[out])], ["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        for k in range(0, batch.num_rows, at_once):
            got = pa.Table.from_batches([batch.slice(k, at_once)])
            held = got if held is None or not len(held) else pa.concat_tables([held, got])
            if len(held) >= at_once:
                name = np.stack([held[c].to_numpy() for c in _GROUP[:3]], axis=1)
                last = np.flatnonzero((name[1:] != name[:-1]).any(axis=1))
                if len(last):  # the last group may go on in the next batch
                    yield links(held.slice(0, last[-1] + 1))
                    held = held.slice(last[-1] + 1)
    if held is not None and len(held):
        yield links(held)


def _texts(docs: DataFrame, key: str, text: str, words: int, whole: bool) -> DataFrame:
    """fp and u (128 bits of name of the text's words) and n (distinct shingles) of each row, with its key or, if whole, its distinct shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in slices(batches):
            fp, u, n, shingles = [], [], [], []
            for x in batch["text"].to_pylist():
                w = _words(x)
                data = _shingles(w, words)
                fp.append(_majority(data))
                u.append(xxh64_intdigest(b" ".join(w), 7))
                own = np.unique(np.frombuffer(data, np.int64))
                n.append(len(own))
                if whole:
                    shingles.append(own)
            fields = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (fp, u)] + [pa.array(n, pa.int64())]
            last = pa.array(shingles, pa.list_(pa.int64())) if whole else batch["key"]
            yield pa.RecordBatch.from_arrays([*fields, last], ["fp", "u", "n", "s" if whole else "key"])

    last = "s array<long>" if whole else f"key {docs.schema[key].dataType.simpleString()}"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(rows, f"fp long, u long, n long, {last}")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, budget: int = 14, parts: int = 10, block: int = 300) -> DataFrame:
    """key and component_id of each row: the smallest key that links reach, itself included.

    Texts link whose sets of shingles of `words` words have a Jaccard similarity of 0.8 or more, if their fingerprints
    differ in at most `budget` bits and agree in two of `parts` parts (so up to parts - 2 bits surely). Equal words are
    one unit. A row of a group is there once, with its shingles if a fitting row is there too; links leave a group as
    one row for each member at most. A null key never names a group, as in near_groups.
    """
    rows = checkpointed(_texts(docs, key, text, words, False))
    units = rows.groupBy("fp", "u", "n").agg(F.min("key").alias("least")).withColumn("id", F.monotonically_increasing_id())
    units = checkpointed(units)
    dealt = _dealt(units.where(F.col("least").isNotNull()).select("fp", "id", "n"), parts, block)
    kind = ", ".join(f"{c} long" for c in _GROUP)
    members = checkpointed(dealt.mapInArrow(lambda it: _members(it, budget, parts), kind))
    sets = _sets(units.join(members.select("id").distinct(), "id"), docs, key, text, words)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = members.join(sets, "id").repartition(n, *_GROUP[:3]).sortWithinPartitions(*_GROUP[:3])
    links = checkpointed(met.select(*_GROUP, "s").mapInArrow(lambda it: _linked(it, budget, parts), "a long, b long"))
    joined = connected_components(links).select(F.col("node").alias("id"), "component")
    units = checkpointed(units.join(joined, "id", "left").withColumn("c", F.coalesce("component", "id")))
    least = units.groupBy("c").agg(F.min("least").alias("component_id"))
    grouped = checkpointed(units.join(least, "c").select("fp", "u", "component_id"))
    return rows.join(grouped, ["fp", "u"]).select(F.col("key").alias(key), "component_id")


def _sets(units: DataFrame, docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(id, s): the distinct shingles of each unit (id, fp, u, least). Texts are read once more, and only those of units go to Python."""
    asked = checkpointed(units.select("id", "fp", "u", "least"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(key).alias("h"))
    rows = member_filter(asked.select(F.xxhash64("least").alias("h")).distinct(), asked.count()).mark(rows, "h").where("maybe")
    return checkpointed(_texts(rows, "key", "text", words, True).join(asked, ["fp", "u"]).select("id", "s").dropDuplicates(["id"]))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, budget: int = 2) -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id of each row: the smallest key that links reach, itself included.

    Fingerprints of at most `budget` (2 or less) differing bits link. Texts without a word (null, empty, white
    space) have fingerprint zero and link like others. A null key never names a group: rows of a fingerprint that
    has null keys only get a null component_id and join nothing. Repeated rows get equal results. No rows give none.
    """
    docs = checkpointed(fingerprints(docs, key, text, words))
    named = docs.groupBy("fp").agg(F.min(key).alias(f"{OWN}least"))
    named = checkpointed(named)
    links = near_links(named.where(F.col(f"{OWN}least").isNotNull()).select("fp"), budget)
    parts = connected_components(links).select(F.col("node").alias("fp"), F.col("component").alias(f"{OWN}c"))
    grouped = named.join(parts, "fp", "left").withColumn(f"{OWN}c", F.coalesce(f"{OWN}c", "fp"))
    grouped = checkpointed(grouped)
    least = grouped.groupBy(f"{OWN}c").agg(F.min(f"{OWN}least").alias("component_id"))
    grouped = checkpointed(grouped.join(least, f"{OWN}c").select(F.col("fp").alias(f"{OWN}fp"), "component_id"))
    out = docs.join(grouped, F.col("fp") == F.col(f"{OWN}fp"))
    return out.select(F.col(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs whose key is the smallest of its similar group, and those with a null key; columns as in docs."""
    gone = similar_groups(docs, key, text).where(f"`{key}` <> component_id").select(F.col(key).alias(f"{OWN}gone")).distinct()
    return docs.join(gone, docs[key] == F.col(f"{OWN}gone"), "left_anti")
