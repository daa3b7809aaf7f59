"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean embedding of its hashed byte n-grams. Embeddings and the linear layer are
trained together by stochastic gradient descent in numpy on a bounded sample of labelled
excerpts. Part of the sample is held back to fit a temperature and the threshold below which a
prediction is rejected.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.shared import PLACES, places, whole_text

UNKNOWN = "und"
_ORDERS = (2, 3, 4)
_CHUNK = 1 << 16


@dataclasses.dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled excerpts used in training, ``excerpt`` their length,
    ``languages`` the label values.

    ``reject_share`` is the share of rightly predicted held-back excerpts that the rejection
    threshold may cost; the threshold never exceeds ``reject_below``.
    """

    sample_rows: int = 8_000
    languages: int = 1_000
    excerpt: int = 400
    buckets: int = 1 << 16
    dimensions: int = 16
    epochs: int = 6
    rate: float = 0.5
    reject_share: float = 0.0005
    reject_below: float = 0.5
    seed: int = 7


@dataclasses.dataclass(frozen=True)
class Model:
    """Languages, the score each n-gram adds to each, bias, temperature, rejection threshold."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, text: str) -> np.ndarray:
        return _softmax(self._logits(text) / self.temperature)

    def _logits(self, text: str) -> np.ndarray:
        data = _bytes(text)
        total, count = np.zeros(len(self.languages)), 0
        for k in range(0, len(data), _CHUNK):  # chunks overlap by what an n-gram reaches over
            ids = subwords(data[k:k + _CHUNK + max(_ORDERS) - 1], len(self.table), _CHUNK)
            total += np.take(self.table, ids, axis=0).sum(axis=0, dtype=np.float64)
            count += len(ids)
        return total / max(count, 1) + self.bias


def _bytes(text: str) -> np.ndarray:
    words = " ".join(["", *text.lower().split(), ""])
    return np.frombuffer(words.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def subwords(data: np.ndarray, buckets: int, starts: int | None = None) -> np.ndarray:
    """Hashed ids of the byte n-grams that begin in the first ``starts`` bytes."""
    wide, found = data.astype(np.uint64), []
    value = wide
    for n in range(2, max(_ORDERS) + 1):
        if len(data) < n:
            break
        value = value[:-1] * np.uint64(257) + wide[n - 1:]
        if n in _ORDERS:
            mixed = (value + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(40))[:starts] % np.uint64(buckets))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, dtype=np.int64)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], languages: list[str], settings: Settings = Settings()) -> Model:
    """Fit on four fifths of the excerpts; temperature and threshold on the rest."""
    names = tuple(sorted(set(languages)))
    if not names:
        return Model((), np.zeros((settings.buckets, 0), np.float32), np.zeros(0), 1.0, 0.0)
    target = np.array([names.index(x) for x in languages])
    grams = [subwords(_bytes(t), settings.buckets) for t in texts]
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(texts))
    held, fitted = order[::5], np.concatenate([order[k::5] for k in range(1, 5)])
    if not len(fitted):
        fitted = order
    embed = rng.normal(0, 0.1, (settings.buckets, settings.dimensions)).astype(np.float32)
    weight = np.zeros((settings.dimensions, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    steps, total = 0, settings.epochs * len(fitted)
    for _ in range(settings.epochs):
        for k in rng.permutation(fitted):
            rate = settings.rate * (1 - steps / total)
            steps += 1
            if not len(grams[k]):
                continue
            mean = embed[grams[k]].mean(axis=0)
            off = _softmax(mean @ weight + bias)
            off[target[k]] -= 1
            back = weight @ off
            weight -= rate * np.outer(mean, off)
            bias -= 0.1 * rate * off
            np.add.at(embed, grams[k], -rate * 10 / len(grams[k]) * back)
    model = Model(names, embed @ weight, bias.astype(np.float64), 1.0, 0.0)
    if not len(held):
        return model
    logits = np.array([model._logits(texts[k]) for k in held])
    right = target[held]

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[np.arange(len(held)), right] + 1e-12).mean()

    temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    sure = _softmax(logits / temperature)
    hit = sure.argmax(axis=1) == right
    least = np.quantile(sure.max(axis=1)[hit], settings.reject_share) if hit.any() else 0.0
    return dataclasses.replace(
        model, temperature=temperature, threshold=float(min(least, settings.reject_below)))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", settings: Settings = Settings()) -> Model:
    """Train on a sample of the labelled rows, about as many of each language.

    Rows without language or letters are left out. The sample has at most ``sample_rows``
    excerpts of at most ``excerpt`` characters, chosen by hashes of id and text: only these
    reach the driver. No labelled row gives a model without languages, which rejects all. More
    than ``languages`` label values are an error, as is a sample without a row.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), whole_text(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).limit(settings.languages + 1).collect()}
    if not counts:
        return train([], [], settings)
    if len(counts) > settings.languages:
        raise ValueError(f"more than {settings.languages} languages: is {lang_col} a label?")
    each = -(-settings.sample_rows // len(counts))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items())
                           for x in (lang, places(each, n))])
    draw = lambda what: F.xxhash64(F.lit(what), "id", F.xxhash64("text"))
    chosen = rows.where(F.pmod(draw("row"), F.lit(PLACES)) < share[F.col("lang")])
    # Excerpts of several lengths, from anywhere in the text.
    length = F.element_at(F.array(*[F.lit(max(1, settings.excerpt // d)) for d in (1, 3, 10)]),
                          (F.pmod(draw("length"), F.lit(3)) + 1).cast("int"))
    start = F.pmod(draw("start"), F.greatest(F.length("text") - length, F.lit(0)) + 1) + 1
    # Cut before the rows are ordered: whole texts stay where they are.
    excerpts = chosen.select(
        F.substring("text", start.cast("int"), length).alias("text"), "lang",
        draw("order").alias("order"))
    sample = excerpts.orderBy("order", "lang", "text").limit(settings.sample_rows).collect()
    if not sample:
        raise RuntimeError(f"none of {sum(counts.values())} labelled rows was drawn")
    sample.sort(key=lambda r: (r["lang"], r["text"]))
    return train([r["text"] for r in sample], [r["lang"] for r in sample], settings)


def identify(text_col: str, model: Model) -> Column:
    """``lang``, ``score`` and ``accepted`` of a text column, as a struct.

    The whole text is read. Null texts and texts without a letter give ``und`` with score 0, as
    does a model without languages; ``accepted`` is false for these and where the calibrated
    score is below the model's threshold.
    """
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])

    def of(batch: pa.Array) -> pa.Array:
        found = []
        for value in batch:
            text = value.as_py()
            if text is None or not model.languages or not any(map(str.isalpha, text)):
                found.append({"lang": UNKNOWN, "score": 0.0, "accepted": False})
                continue
            sure = model.probabilities(text)
            k = int(sure.argmax())
            score = min(1.0, float(sure[k]))
            found.append({"lang": model.languages[k], "score": score,
                          "accepted": score >= model.threshold})
        return pa.array(found, type=kind)

    return F.arrow_udf(of, "lang string, score double, accepted boolean")(
        F.col(text_col).cast("string"))
