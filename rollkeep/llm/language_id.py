"""Operator 2: hierarchical language identification.

A text's byte trigrams first decide the language family; then one-versus-one linear support vector machines
separate the languages within that family. Families are also told apart by one-versus-one machines.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import bring_back, held_out, set_aside, slices
from rollkeep.llm.linear import svm

#: Language codes by family; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
}
UNKNOWN = "und"
SIZE = 4096


def features(text: str) -> np.ndarray:
    """Root counts of hashed byte trigrams of the whole lower-cased text, of length 1."""
    b = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(SIZE, np.float32)
    for k in range(0, len(b) - 2, 1 << 20):  # bounded memory for very long texts
        p = b[k : k + (1 << 20) + 2].astype(np.uint32)
        code = (p[:-2] * np.uint32(0x9E3779B1) + p[1:-1] * np.uint32(0x85EBCA77) + p[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(20)
        counts += np.bincount(code, minlength=SIZE)
    x = np.sqrt(counts)
    return x / max(1e-9, float(np.linalg.norm(x)))


class Model:
    """Pairwise machines between families and within each; `names` of languages by family."""

    def __init__(self, x: np.ndarray, lang: list[str], families: dict[str, list[str]] = FAMILIES) -> None:
        of = {code: family for family, codes in families.items() for code in codes}
        self.names: dict[str, list[str]] = {}
        for code in sorted(set(lang)):
            self.names.setdefault(of.get(code, code), []).append(code)
        langs = np.array(lang)
        in_family = np.array([of.get(code, code) for code in lang])
        self.pairs = {"": self._machines(x, in_family, sorted(self.names))}
        for family, codes in self.names.items():
            self.pairs[family] = self._machines(x, langs, codes)

    @staticmethod
    def _machines(x: np.ndarray, labels: np.ndarray, names: list[str]) -> dict[tuple[str, str], np.ndarray]:
        out = {}
        for a, b in combinations(names, 2):
            rows = (labels == a) | (labels == b)
            out[a, b] = svm(x[rows], np.where(labels[rows] == a, 1.0, -1.0)).astype(np.float32)
        return out

    @staticmethod
    def _vote(x: np.ndarray, names: list[str], machines: dict) -> tuple[np.ndarray, np.ndarray]:
        """The place in names of each row's winner, and how sure its closest vote was, from 0 to 1."""
        votes, sums = np.zeros((len(x), len(names))), np.zeros((len(x), len(names)))
        sure = np.ones((len(x), len(names)))
        for (a, b), w in machines.items():
            margin = x @ w[:-1] + w[-1]
            p = 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))
            for name, sign, q in ((a, 1, p), (b, -1, 1 - p)):
                k = names.index(name)
                votes[:, k] += sign * margin > 0
                sums[:, k] += sign * margin
                sure[:, k] = np.minimum(sure[:, k], q)
        best = (votes + 1e-6 * np.tanh(sums)).argmax(axis=1)
        return best, sure[np.arange(len(x)), best]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        families = sorted(self.names)
        family, score = self._vote(x, families, self.pairs[""])
        out = [""] * len(x)
        score = score.astype(np.float64)
        for k, name in enumerate(families):
            rows = np.flatnonzero(family == k)
            codes = self.names[name]
            best, sure = self._vote(x[rows], codes, self.pairs[name])
            score[rows] *= sure
            for i, j in zip(rows.tolist(), best.tolist(), strict=True):
                out[i] = codes[j]
        return out, score


def bounded_sample(rows: DataFrame, label: str, key: str, each: int, labels: int = 64) -> DataFrame:
    """About `each` rows of every label, at most 1.5 times so many, chosen by a hash of the key; all of rarer labels.

    Of more than `labels` labels the most frequent ones (then the smallest) count; rows of others are left out.
    """
    most = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n_")).orderBy(F.col("n_").desc(), label).limit(labels)
    counts = {r[0]: r[1] for r in most.collect()}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))]) if counts else F.lit(None)
    chance = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    return rows.where(chance < share[F.col(label)]) if counts else rows.limit(0)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, and the places (two bytes) and values (four bytes) of the features that are not zero, of texts with a letter."""
    for batch in slices(batches):
        kept = [(features(t), code) for t, code in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True) if any(c.isalpha() for c in t)]
        at = [np.flatnonzero(x) for x, _ in kept]
        columns = [[code for _, code in kept], [a.astype(np.uint16).tobytes() for a in at], [x[a].tobytes() for (x, _), a in zip(kept, at, strict=True)]]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["lang", "at", "value"])


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", each: int = 800) -> Model | None:
    """A model from a bounded sample: about `each` rows for every value of lang, of those that may be learned from.

    At most the 64 most frequent values of lang are learned. The driver gets features only, at most 24 KB a row, whatever
    the texts' length. Null or letterless texts and null languages are left out; no such rows give None.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key)).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    got = bounded_sample(rows, "lang", "key", each).select("text", "lang").mapInArrow(_counted, "lang string, at binary, value binary").collect()
    if not got:
        return None
    x = np.zeros((len(got), SIZE), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    return Model(x, [r["lang"] for r in got])


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with held_out, lang_pred and score, from the whole text alone.

    und with score 0 if the text is null or has no letter, or if there is no model. Other columns pass through,
    repeated rows stay, an empty table gives no rows. No shuffle. Input columns of these names are replaced.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter = regex.compile(r"\p{L}").search
        for batch in slices(batches):
            texts = batch[text].to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if model and t and letter(t)]
            for k in range(0, len(known), 512):
                part = known[k : k + 512]
                found, sure = model.predict(np.stack([features(texts[i]) for i in part]))
                scores[part] = sure
                for i, name in zip(part, found, strict=True):
                    names[i] = name
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names, "lang_pred", "score"])

    marked = docs.drop("lang_pred", "score").withColumn("held_out", held_out(key))
    return marked.mapInArrow(rows, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields), "lang_pred string, score double"]))


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of docs whose language can be told; those of und go. The model learns from docs itself. Columns as in docs.

    If no row has a language to learn from, nothing can be told apart, and all rows stay.
    """
    model = train(docs, key, text, lang)
    if model is None:
        return docs
    rows = identify(set_aside(docs, ["held_out", "lang_pred", "score"]), model, key, text)
    return bring_back(rows.where(F.col("lang_pred") != UNKNOWN), docs.columns)
