"""Operator 7: toxicity by a counterfactually regularised classifier.

A logistic regression on five-byte windows of the normalised text. Every labelled text gives counterfactual pairs:
where it names groups of people, these terms are swapped for others of their kind; where it names none, a mention of
one is put in, and then of another. The score changes that such pairs cause are penalised, so that a neutral mention
of a group does not count as toxic.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import bring_back, checkpointed, held_out, set_aside, slices
from rollkeep.llm.language_id import bounded_sample
from rollkeep.llm.linear import Sparse, logistic

#: Terms that name groups of people; those of one row may stand for each other.
IDENTITY = [
    ["men", "women", "boys", "girls", "trans people"],
    ["man", "woman", "boy", "girl", "trans person"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["christian", "muslim", "jew", "hindu", "buddhist", "atheist"],
    ["jewish", "islamic", "catholic", "protestant"],
    ["africans", "americans", "arabs", "asians", "europeans", "latinos", "immigrants", "refugees"],
    ["african", "american", "arab", "asian", "european", "latino", "immigrant", "refugee"],
    ["gay people", "lesbians", "bisexual people", "straight people"],
    ["gay", "lesbian", "bisexual", "straight", "queer"],
    ["black people", "white people", "brown people"],
    ["old people", "young people", "elderly people", "teenagers"],
    ["disabled people", "blind people", "deaf people", "autistic people"],
    ["disabled", "blind", "deaf", "autistic"],
    ["männer", "frauen", "jungen", "mädchen"],
    ["christen", "muslime", "juden", "atheisten"],
    ["ausländer", "einwanderer", "flüchtlinge", "türken", "araber", "afrikaner"],
    ["schwule", "lesben"],
    ["hommes", "femmes", "garçons", "filles"],
    ["chrétiens", "musulmans", "juifs", "athées"],
    ["immigrés", "réfugiés", "africains", "arabes"],
    ["homosexuels", "lesbiennes"],
    ["hombres", "mujeres", "chicos", "chicas"],
    ["cristianos", "musulmanes", "judíos", "ateos"],
    ["inmigrantes", "refugiados", "africanos", "árabes"],
    ["homosexuales", "lesbianas"],
]
_KIND = {term: terms for terms in IDENTITY for term in terms}
_TERM = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, _KIND), key=len, reverse=True)) + r")\b")
#: ASCII that is neither letter nor digit becomes a space.
_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SIZE = 1 << 20
WIDTH = 5
THRESHOLD = 0.3


def windows(text: str) -> np.ndarray:
    """Hashes of all five-byte windows of the lower-cased whole text with single spaces between words."""
    data = b" ".join([b"", *text.lower().encode("utf-8", "surrogatepass").translate(_WORDS).split(), b""])
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < WIDTH:
        return np.zeros(0, np.uint32)
    n = len(b) - WIDTH + 1
    h = np.zeros(n, np.uint32)
    for k in range(WIDTH):
        h = (h ^ b[k : k + n]) * np.uint32(0x01000193) + (h >> np.uint32(15))
    return (h ^ (h >> np.uint32(11))) & np.uint32(SIZE - 1)


def counterfactuals(text: str) -> list[tuple[str, str]]:
    """Two pairs of texts that differ in the groups they name only.

    A text with identity terms, and the text with each of them swapped for the next one of its kind, and for the one
    after. Else the text and a mention put into its middle, and that mention and another of its kind; a hash of the
    text chooses them.
    """
    text = text.lower()
    if _TERM.search(text):
        turn = lambda k: _TERM.sub(lambda m: (t := _KIND[m[0]])[(t.index(m[0]) + k) % len(t)], text)
        return [(text, turn(1)), (text, turn(2))]
    pick = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    terms = IDENTITY[pick % len(IDENTITY)]
    at = text.find(" ", len(text) // 2)
    at = len(text) if at < 0 else at
    one, two = (f"{text[:at]} {terms[(pick // len(IDENTITY) + k) % len(terms)]}{text[at:]}" for k in (0, 1))
    return [(text, one), (one, two)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bin, toxic, clean): texts of each class that hold a window of this hash; one row for each hash that a task met."""
    counts = np.zeros((2, SIZE), np.int32)
    for batch in slices(batches):
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            counts[label][np.unique(windows(text))] += 1
    met = np.flatnonzero(counts.any(axis=0))
    for k in range(0, len(met), 100_000):
        part = met[k : k + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(counts[c][part].astype(np.int64)) for c in (1, 0))], ["bin", "toxic", "clean"])


def _places(text: str, place: np.ndarray) -> np.ndarray:
    at = place[np.unique(windows(text))]
    return at[at >= 0]


def features(text: str, place: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The chosen windows that a text has; and for each counterfactual pair those that it adds (k + 1) and takes away (-k - 1)."""
    moved = []
    for one, two in counterfactuals(text):
        a, b = _places(one, place), _places(two, place)
        moved.append(np.r_[np.setdiff1d(b, a) + 1, -np.setdiff1d(a, b) - 1])
    return _places(text, place), moved


def identity_windows() -> np.ndarray:
    """The windows of all identity terms: always features, so that the penalty holds them."""
    return np.unique(np.concatenate([windows(t) for terms in IDENTITY for t in terms]))


class Model:
    """Weights of the chosen window hashes; `constant` is the log odds of a text without any; `pairs` and `moved` count counterfactual pairs and those that change a feature."""

    def __init__(self, chosen: np.ndarray, rows: list[np.ndarray], changes: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, pull: float = 1.0) -> None:
        n = len(chosen)
        changes_ = [c for c in changes if len(c)]
        x = Sparse.of(rows, [np.ones(len(r), np.float32) for r in rows], n)
        swaps = Sparse.of([np.abs(c) - 1 for c in changes_], [np.sign(c).astype(np.float32) for c in changes_], n)
        w = logistic(x, toxic.astype(np.float32), weight.astype(np.float32), swaps, pull)
        self.chosen, self.values, self.constant = chosen.astype(np.int32), w[:-1].astype(np.float32), float(w[-1])
        self.pairs, self.moved = len(changes), len(changes_)

    @classmethod
    def of_texts(cls, texts: list[str], toxic: np.ndarray, chosen: np.ndarray, pull: float = 1.0) -> Model:
        """The model of labelled texts held in memory, with the given windows as features."""
        place = places_of(chosen)
        got = [features(t, place) for t in texts]
        return cls(chosen, [g[0] for g in got], [m for g in got for m in g[1]], toxic, np.ones(len(texts)), pull)

    def table(self) -> np.ndarray:
        """Weights by window hash; built once in each worker."""
        if "_table" not in self.__dict__:
            self._table = np.zeros(SIZE, np.float32)
            self._table[self.chosen] = self.values
        return self._table

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def score(self, text: str | None) -> float:
        weights = self.table()
        h = windows(text or "")
        hit = np.unique(h[weights[h] != 0])
        z = self.constant + float(weights[hit].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def places_of(chosen: np.ndarray) -> np.ndarray:
    place = np.full(SIZE, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    return place


def telling_windows(counts: DataFrame, n_toxic: int, n_clean: int, most: int, least: tuple[float, float] = (2.0, 4.0)) -> np.ndarray:
    """The window hashes whose shares differ most between the classes, by a two-sample z score; at most `most`.

    least: the z score that a window needs if more toxic texts have it, and if more clean ones do.
    """
    p, q = (F.col("toxic") + 0.5) / (n_toxic + 1), (F.col("clean") + 0.5) / (n_clean + 1)
    error = F.sqrt(p * (1 - F.least(p, F.lit(0.999))) / (n_toxic + 1) + q * (1 - F.least(q, F.lit(0.999))) / (n_clean + 1))
    rows = counts.groupBy("bin").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).withColumn("z", F.abs(p - q) / error).where(F.col("z") >= F.when(p > q, least[0]).otherwise(least[1]))
    return np.array(sorted(r.bin for r in rows.orderBy(F.col("z").desc(), "bin").limit(most).select("bin").collect()), np.int64)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", each: int = 4_000, most: int = 2_000, pull: float = 1.0) -> Model | None:
    """A model from a bounded sample: about `each` labelled rows of either class, of those that may be learned from.

    The sample's texts stay on the executors: the driver gets at most `most` window hashes, and for each sampled row the
    numbers of those that it holds. Classes are weighted back to their shares. Null labels and null texts are left out;
    without rows of both classes there is no model (None).
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(key)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    sample = bounded_sample(known, "label", "key", each)  # at most a few thousand small rows, so it is broadcast
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key")
    rows = checkpointed(rows.select("text", "label").repartition(8, F.xxhash64("text")))
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    telling = telling_windows(rows.mapInArrow(_counted, "bin int, toxic long, clean long"), sizes[1], sizes[0], most)
    chosen = np.union1d(telling, identity_windows())

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places_of(chosen)
        for batch in slices(batches):
            got = [features(t, place) for t in batch["text"].to_pylist()]
            held = pa.array([x.astype(np.int16).tobytes() for x, _ in got], pa.binary())
            moved = [pa.array([m[k].astype(np.int16).tobytes() for _, m in got], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch["label"], held, *moved], ["label", "held", "one", "two"])

    got = rows.mapInArrow(told, "label int, held binary, one binary, two binary").collect()
    toxic = np.array([r["label"] for r in got])
    numbers = lambda x: np.frombuffer(x, np.int16).astype(np.int32)
    weight = np.where(toxic == 1, counts[1] / sizes[1], counts[0] / sizes[0])
    return Model(chosen, [numbers(r["held"]) for r in got], [numbers(r[c]) for r in got for c in ("one", "two")], toxic, weight * len(toxic) / weight.sum(), pull)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (1 if score >= 0.3) of each whole text.

    Null and empty texts get the score of a text without known windows; without a model all scores are 0.
    Other columns pass through, repeated rows stay, an empty table gives no rows. No shuffle. Input columns
    of these names are replaced.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([model.score(t) if model else 0.0 for t in batch[text].to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    marked = docs.drop("score", "predicted").withColumn("held_out", held_out(key))
    return marked.mapInArrow(rows, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields), "score double, predicted int"]))


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic; columns as in docs."""
    rows = score(set_aside(docs, ["held_out", "score", "predicted"]), train(docs, labels, key, text), key, text)
    return bring_back(rows.where("predicted = 0"), docs.columns)
