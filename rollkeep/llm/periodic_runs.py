"""Operator 11: runs of repeating words, found in a grammar-compressed text.

The word ids of each text are compressed by Re-Pair: pairs that occur more than once become nonterminals, the more
frequent of two overlapping pairs first, many pairs in one round; a balanced tree stands over what is left. Every run
crosses the boundary between the two halves of exactly one lowest node of the derivation. So each nonterminal is searched
once, for periods around its boundary only; what it holds is translated to all its positions in the text, and of the
intervals of one period the maximal ones remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least so many words, and so many periods.
WORDS, TIMES = 6, 4
#: The bytes between words.
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes of text that are worked on together, and pairs of node and period that are tested together; neither changes results.
BYTES, TESTS = 1 << 21, 1 << 22
RUN = "struct<start:long,length:long,period:long>"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts one after another, as they stand in the texts' memory, and the text of each."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if ends[0] == ends[-1]:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[: ends[-1]]
    blank = BLANK[data[ends[0] :]]
    cut = np.concatenate(([True], blank[1:] != blank[:-1]))
    cut[ends[:-1][ends[:-1] < ends[-1]] - ends[0]] = True
    begin = np.flatnonzero(cut)
    places = np.append(begin, len(blank)) + ends[0]
    pieces = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(places.astype(np.int64)), texts.buffers()[2])
    is_word = ~blank[begin]
    return pieces.filter(pa.array(is_word)), np.searchsorted(ends, places[:-1][is_word], "right") - 1


class Names:
    """Numbers for stretches of 2**k words, equal for equal stretches; made when they are asked for."""

    def __init__(self, words: np.ndarray) -> None:
        self.levels = [words]

    def __getitem__(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            now, step = self.levels[-1], 1 << (len(self.levels) - 1)
            n = max(0, len(now) - step)
            self.levels.append(pd.factorize(now[:n].astype(np.int64) * (len(self.levels[0]) + 1) + now[step : step + n])[0])
        return self.levels[k]

    def common(self, one: np.ndarray, two: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from places one and two on are equal, or before and at them for back; at most so many."""
        got = np.zeros(len(one), np.int64)
        steps = np.full(len(one), -1)

        def grow(at: np.ndarray, k: int) -> np.ndarray:
            at = at[most[at] - got[at] >= 1 << k]
            first, second = (x[at] - got[at] - (1 << k) + 1 if back else x[at] + got[at] for x in (one, two))
            at = at[self[k][first] == self[k][second]] if len(at) else at
            got[at] += 1 << k
            return at

        on, k = np.arange(len(one)), 0
        while len(on):
            on = grow(on, k)
            steps[on] = k
            k += 1
        for k in range(k - 1, -1, -1):  # what is left is shorter than the step that failed
            grow(np.flatnonzero(steps + 1 > k), k)
        return got


class Nodes:
    """The nodes of the derivation of some texts: begin, middle and end of one place of each, and all places."""

    def __init__(self) -> None:
        self.first: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.count = 0

    def add(self, node: np.ndarray, begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> None:
        """Pairs that were made, by a number for each nonterminal; those too short for a run are left out."""
        long = end - begin >= WORDS
        if long.any():
            code, first = np.unique(node[long], return_index=True)
            begin, middle, end = begin[long], middle[long], end[long]
            self.first.append(np.stack((begin, middle, end))[:, first])
            self.places.append(np.stack((np.searchsorted(code, node[long]) + self.count, begin)))
            self.count += len(code)


def derive(words: np.ndarray, doc: np.ndarray) -> Nodes:
    """The nodes of the grammars of all texts; words that stand in different texts never pair.

    A round counts the pairs of all texts and replaces those that no overlapping pair beats, by count and then by a
    scattered number, so that rounds stay few and trees low. In a stretch of one repeated pair every second one is taken.
    """
    nodes = Nodes()
    begin = np.arange(len(words))
    end = begin + 1
    symbol = pd.factorize(doc * (len(words) + 1) + words)[0].astype(np.int64)
    symbols = len(words)
    done: list[tuple[np.ndarray, ...]] = []
    while len(symbol) > 1:
        key = np.where(doc[:-1] == doc[1:], symbol[:-1] * symbols + symbol[1:], -1)
        code, found = pd.factorize(key)
        count = np.bincount(code, minlength=len(found))
        count[found == -1] = 0
        weight = np.where(count > 1, (count << 32) + (np.arange(len(found)) * 0x9E3779B1 & 0xFFFFFFFF), 0)[code]
        before, after = np.append(0, weight[:-1]), np.append(weight[1:], 0)
        at = np.arange(len(weight))
        stretch = np.maximum.accumulate(np.where(weight != before, at, 0))
        taken = np.flatnonzero((weight > 0) & (weight >= before) & (weight >= after) & ((at - stretch) % 2 == 0))
        more = np.zeros(doc[-1] + 1 if len(doc) else 0, bool)
        more[doc[taken]] = True
        nodes.add(code[taken], begin[taken], begin[taken + 1], end[taken + 1])
        symbol[taken], end[taken] = symbols + code[taken], end[taken + 1]
        symbols += len(found)
        stay = np.ones(len(symbol), bool)
        stay[taken + 1] = False
        goes_on = more[doc]
        done.append(tuple(x[stay & ~goes_on] for x in (begin, end, doc)))
        symbol, begin, end, doc = (x[stay & goes_on] for x in (symbol, begin, end, doc))
    begin, end, doc = (np.concatenate([d[i] for d in done] + [x]) for i, x in enumerate((begin, end, doc)))
    while len(doc) > 1:
        at = np.arange(len(doc))
        change = np.append(True, doc[1:] != doc[:-1])
        within = at - np.maximum.accumulate(np.where(change, at, 0))
        taken = np.flatnonzero((within[:-1] % 2 == 0) & (doc[:-1] == doc[1:]))
        if not len(taken):
            break
        nodes.add(taken, begin[taken], begin[taken + 1], end[taken + 1])
        end[taken] = end[taken + 1]
        stay = np.ones(len(doc), bool)
        stay[taken + 1] = False
        begin, end, doc = begin[stay], end[stay], doc[stay]
    return nodes


def _tests(most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(node, period) for periods from 1 to the most of each node, in parts of bounded size; a node with more than that stands alone."""
    total = np.cumsum(most)
    begin = 0
    while begin < len(most):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + TESTS, "right")))
        node = np.repeat(np.arange(begin, end), most[begin:end])
        yield node, np.arange(len(node)) - (np.repeat(total[begin:end] - most[begin:end], most[begin:end]) - done) + 1
        begin = end


def crossing(names: Names, nodes: np.ndarray) -> np.ndarray:
    """(node, begin, end, period) of the runs within nodes (begin, middle, end) that cross their middle, as far as they go there.

    A run of four periods or more has two periods at least on one side of the middle; there the pair of words around the
    middle stands again, one period further. Only the smallest period of a stretch is given.
    """
    begin, middle, end = nodes
    out = [np.zeros((4, 0), np.int64)]
    for side, room in ((1, end - middle), (-1, middle - begin)):
        most = np.minimum(room // 2, (end - begin) // TIMES)
        for node, q in _tests(most):
            m = middle[node]
            same = np.flatnonzero(names[1][m - 1] == names[1][m - 1 + side * q])
            node, q, m = node[same], q[same], m[same]
            left, right = (m, m + q) if side > 0 else (m - q, m)
            after = names.common(left, right, end[node] - right, False)
            before = names.common(left - 1, right - 1, left - begin[node], True)
            b, e = left - before, right + after
            good = e - b >= np.maximum(WORDS, TIMES * q)
            out.append(np.stack((node, b, e, q))[:, good])
    found = np.concatenate(out, 1)
    found = found[:, np.lexsort(found[::-1])]
    return found[:, np.append(True, (found[:3, 1:] != found[:3, :-1]).any(0))[: found.shape[1]]]


def runs_of(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(begin, end, period) of all runs of texts given as word numbers, one text after another; sorted by begin, then period."""
    nodes = derive(words, doc)
    if not nodes.count:
        return np.zeros((3, 0), np.int64)
    first, places = np.concatenate(nodes.first, 1), np.concatenate(nodes.places, 1)
    node, b, e, q = crossing(Names(words), first)
    places = places[:, np.argsort(places[0], kind="stable")]
    low, high = (np.searchsorted(places[0], node, side) for side in ("left", "right"))
    times = high - low
    at = np.repeat(low - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
    shift = places[1, at] - np.repeat(first[0, node], times)
    b, e, q = (np.repeat(x, times) + (shift if moves else 0) for x, moves in ((b, True), (e, True), (q, False)))
    by = np.lexsort((-e, b, q))
    b, e, q = b[by], e[by], q[by]
    top = e + q * (len(words) + 1)  # ends of one period, after all of smaller ones
    whole = np.append(True, top[1:] > np.maximum.accumulate(top)[:-1])[: len(b)]
    b, e, q = b[whole], e[whole], q[whole]
    by = np.lexsort((q, b))
    return np.stack((b[by], e[by], q[by]))


def _batch(texts: pa.Array) -> list[pa.Array]:
    """n_words, runs and collapsed of some texts."""
    words, doc = words_of(texts)
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    begin, end, period = runs_of(ids, doc)
    size = np.bincount(doc, minlength=len(texts))
    start = np.append(0, np.cumsum(size))
    owner = doc[begin] if len(begin) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts)))), pa.int32())
    runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(x) for x in (begin - start[owner], end - begin, period)], ["start", "length", "period"]))
    held = np.zeros(len(ids) + 1, np.int64)
    np.add.at(held, begin + period, 1)
    np.add.at(held, end, -1)
    kept = np.cumsum(held)[:-1] == 0
    left = pa.array(np.append(0, np.cumsum(np.bincount(doc[kept], minlength=len(texts)))), pa.int64())
    collapsed = pc.binary_join(pa.LargeListArray.from_arrays(left, words.filter(pa.array(kept))), pa.scalar(" ", pa.large_string())).cast(pa.string())
    return [pa.array(size), runs, collapsed]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The same rows in parts of about BYTES of text; a longer text stands alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, runs and collapsed of every row.

    Words are what stands between ASCII blanks. A run is a maximal stretch of words with smallest period q and at least
    max(6, 4 q) words; runs are sorted by start, then period. collapsed: the words, joined by one space, without those
    that any run holds after its first q words. Null and empty texts have no word, no run and empty collapsed text; rows
    with a null or repeated key are rows like others, other columns are not read, and an empty table gives no rows. Texts
    are worked on where they are read, whole, some megabytes at a time; nothing is shuffled.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), *_batch(part.column(1))], ["key", "n_words", "runs", "collapsed"])

    out = rows.mapInArrow(found, f"key {rows.schema['key'].dataType.simpleString()}, n_words long, runs array<{RUN}>, collapsed string")
    return out.withColumnRenamed("key", key)
