"""Toxicity by nearest labelled examples under exact TF-IDF cosine, with evidence.

Terms are all words and word beginnings of a text, hashed to a wide fixed space; their document
frequencies are counted over all documents. Every labelled example of a bounded sample sits in
an inverted index whose postings are cut into blocks of examples with the largest weight of each,
so blocks that cannot reach the nearest found so far are skipped and the result stays exact. The
score is the distance-weighted vote of the nearest alone, calibrated on held-back examples.
"""

from __future__ import annotations

import dataclasses
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.shared import PLACES, materialise, places, whole_text

_WORD, _SPACE = re.compile(r"\w+"), re.compile(r"\s")
_STEMS = (4, 5)
#: Characters that are made into terms together, about, and bytes from which on a word is hashed alone.
_CHARACTERS, _LONG = 1 << 18, 32
#: Texts that are looked up together, and blocks of the index that are searched before others are
#: skipped.
_TEXTS, _AHEAD = 64, 8
#: Terms in more than one example in so many are kept as rows of a matrix.
_FREQUENT = 10
#: Entries from which on a list is copied whole.
_SLICED = 100
#: A cosine from which on two texts have the same terms.
_SAME = 1 - 1e-6
#: Centres by which examples are ordered, and how often they are moved.
_CENTRES, _ROUNDS = 24, 6


@dataclasses.dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled examples (half of them toxic where there are enough).

    ``space`` is the number of places that terms are hashed to, ``nearest`` how many examples
    vote, ``block`` the examples to a block of postings.
    """

    sample_rows: int = 8_000
    space: int = 1 << 21
    nearest: int = 300
    block: int = 64
    evidence: int = 3


def word_terms(word: str) -> tuple[str, ...]:
    """The word itself, and its beginnings (marked) where it is longer."""
    return (word, *[f"{word[:n]}*" for n in _STEMS if len(word) > n])


# --- terms -------------------------------------------------------------------------------

@functools.cache
def _in_words() -> np.ndarray:
    """Which characters stand in words."""
    found = np.zeros(0x110000, dtype=bool)
    for run in _WORD.finditer("".join(map(chr, range(len(found))))):
        found[run.start():run.end()] = True
    return found


#: What a byte does to a crc32.
_CRC = np.array([zlib.crc32(bytes([k ^ 255])) for k in range(256)], np.uint32) ^ 0xFF000000


def _step(crc: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _CRC[(crc ^ byte) & 255] ^ (crc >> 8)


def _crc32(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, marked: np.ndarray
           ) -> np.ndarray:
    """The crc32 of ranges of bytes, with a ``*`` behind those that are marked."""
    order = np.argsort(-sizes, kind="stable")
    at, long_first = starts[order], -sizes[order]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for k in range(min(_LONG, int(sizes.max(initial=0)))):
        n = np.searchsorted(long_first, -k)  # these have more than k bytes
        crc[:n] = _step(crc[:n], data[at[:n] + k])
    for k in range(np.searchsorted(long_first, -_LONG)):
        crc[k] = zlib.crc32(data[at[k]:at[k] - long_first[k]]) ^ 0xFFFFFFFF
    found = np.empty_like(crc)
    found[order] = crc
    return np.where(marked, _step(found, ord("*")), found) ^ np.uint32(0xFFFFFFFF)


def text_vectors(texts: list[str], space: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places in order and counts of all terms of each text: the crc32 of :func:`word_terms`."""
    lowered = [text.lower() for text in texts]
    joined = "\n".join([*lowered, ""])
    letters = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    byte = np.arange(len(letters) + 1)
    if len(data) > len(letters):
        byte[1:] = np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF))
    edges = np.nonzero(np.diff(_in_words()[letters], prepend=False))[0]
    start, stop = edges[::2], edges[1::2]
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in lowered]), start, side="right")
    starts, stops, of = [start], [stop], [text]
    for n in _STEMS:
        longer = stop - start > n
        starts.append(start[longer])
        stops.append(start[longer] + n)
        of.append(text[longer])
    marked = np.arange(sum(map(len, starts))) >= len(start)
    first = byte[np.concatenate(starts)]
    crc = _crc32(data, first, byte[np.concatenate(stops)] - first, marked)
    key = np.sort(np.concatenate(of) * space + crc % space)
    new = np.nonzero(np.diff(key, prepend=-1))[0]
    counts, key = np.diff(new, append=len(key)), key[new]
    ends = np.searchsorted(key, np.arange(1, len(texts)) * space)
    return list(zip(np.split(key % space, ends), np.split(counts, ends), strict=True))


def long_text_vector(text: str, space: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one text, cut at white space, so that memory for its letters is bounded."""
    at, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    begin = 0
    while begin < len(text):
        cut = _SPACE.search(text, begin + _CHARACTERS)
        end = cut.end() if cut else len(text)
        piece = text_vectors([text[begin:end]], space)[0]
        at, of = np.unique(np.concatenate([at, piece[0]]), return_inverse=True)
        both = np.zeros(len(at), np.int64)
        np.add.at(both, of, np.concatenate([counts, piece[1]]))
        counts, begin = both, end
    return at, counts


def packed(at: np.ndarray, counts: np.ndarray) -> bytes:
    """Steps between places and counts, byte by byte, so that zeros stand together."""
    both = np.column_stack([np.diff(at, prepend=0), counts]).astype("<u4")
    return both.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u4")
    return np.cumsum(both[:, 0], dtype=np.int32), both[:, 1].astype(np.int32)


def term_vector(text_col: str, space: int) -> Column:
    """All terms of the whole text, as :func:`packed` has them."""
    def of(batch: pa.Array) -> pa.Array:
        found, texts, size = [], [], 0
        for value in batch:
            texts.append(value.as_py())
            size += len(texts[-1])
            if size >= _CHARACTERS:
                long = texts.pop() if len(texts[-1]) > _CHARACTERS else None
                if texts:
                    found += [packed(*v) for v in text_vectors(texts, space)]
                if long is not None:
                    found.append(packed(*long_text_vector(long, space)))
                texts, size = [], 0
        if texts:
            found += [packed(*v) for v in text_vectors(texts, space)]
        return pa.array(found, type=pa.binary())

    return F.arrow_udf(of, "binary")(whole_text(text_col))


def _term_counts(space: int):
    """Vectors to the number of rows that have each term, once for a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(space, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                n[unpacked(value.as_py())[0]] += 1
        found = np.nonzero(n)[0]
        for k in range(0, len(found), 65536):
            part = found[k:k + 65536]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(n[part])], names=["term", "n"])

    return run


def document_frequency(vectors: DataFrame, space: int) -> np.ndarray:
    """How many rows of ``vector`` have each term."""
    counts = (vectors.select("vector").mapInArrow(_term_counts(space), "term int, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    frequency = np.zeros(space)
    frequency[counts.column("term").to_numpy()] = counts.column("n").to_numpy()
    return frequency


# --- index -------------------------------------------------------------------------------

def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Index:
    """Examples as unit vectors in an inverted index with block maxima.

    Examples that use the same frequent terms lie side by side, so that a block's largest weights
    say much about each of its examples. The postings of frequent terms are columns of a matrix,
    a block of whose rows is multiplied with the texts that it may still serve; the short lists of
    other terms are added up first and are part of the bounds. The search is in single precision,
    with bounds that allow for its error; whatever may be nearest is then summed in double precision.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], block: int) -> None:
        self.size, self.block = len(vectors), block
        sizes = np.array([len(at) for at, _ in vectors], dtype=np.int64)
        term = np.concatenate([np.empty(0, np.int32), *[at for at, _ in vectors]], dtype=np.int32)
        weight = np.concatenate([np.empty(0, np.float32), *[w for _, w in vectors]],
                                dtype=np.float32)
        self.terms, term, n = np.unique(term, return_inverse=True, return_counts=True)
        # Numbered by frequency, so that the lists most often read lie together.
        order = np.argsort(-n, kind="stable")
        self.terms, n = self.terms[order], n[order]
        term = np.argsort(order)[term]
        often = n * _FREQUENT > self.size
        self.row = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
        self.number = _neighbourhoods(
            np.repeat(np.arange(self.size), sizes), self.row[term], weight, sizes)
        place = np.empty(self.size, dtype=np.min_scalar_type(max(1, self.size)))
        place[self.number] = np.arange(self.size)
        example, row = np.repeat(place, sizes), self.row[term]
        self.dense = example[row >= 0], row[row >= 0], weight[row >= 0]
        example, weight, term = example[row < 0], weight[row < 0], term[row < 0]
        order = np.argsort(term, kind="stable")
        self.postings = example[order], weight[order]
        self.stops = np.cumsum(np.bincount(term, minlength=len(self.terms))).astype(np.int32)
        self._make()

    def _make(self) -> None:
        blocks = -(-self.size // self.block)
        self.matrix = np.zeros((blocks * self.block, int((self.row >= 0).sum())), np.float32)
        self.matrix[self.dense[:2]] = self.dense[2]
        self.most = self.matrix.reshape(blocks, self.block, -1).max(axis=1) if blocks else None
        self.numbers = np.full(int(self.terms.max(initial=-1)) + 2, -1, np.int32)
        self.numbers[self.terms] = np.arange(len(self.terms))

    def __getstate__(self) -> dict:
        made = ("matrix", "most", "numbers")  # again where the index arrives
        return {k: v for k, v in self.__dict__.items() if k not in made}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._make()

    def known(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which terms the examples have, and their numbers in ``terms``."""
        k = self.numbers[np.minimum(at, len(self.numbers) - 1)]  # the last is no term
        there = k >= 0
        return there, k[there]

    def nearest(self, at: np.ndarray, weight: np.ndarray, n: int) -> list[tuple[float, int]]:
        """The ``n`` examples of largest cosine above 0, ties by number, as (cosine, example)."""
        cosine, example = self.nearest_of([(at, weight)], n)[0]
        return list(zip(cosine.tolist(), example.tolist(), strict=True))

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]],
                   n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """:meth:`nearest` of several vectors, as arrays."""
        if not self.size:
            return [(np.empty(0), np.empty(0, np.int64)) for _ in vectors]
        width, rows = self.matrix.shape
        blocks = width // self.block
        query = np.zeros((len(vectors), rows), np.float32)
        rare = np.empty((len(vectors), width))
        slack = np.empty(len(vectors))  # how far sums of so many terms may be off, as a share
        found = []
        for q, (at, weight) in enumerate(vectors):
            there, k = self.known(at)
            weight, row = weight[there], self.row[k]
            found.append((row[row >= 0], weight[row >= 0]))
            slack[q] = (len(k) + 8) * 2.0 ** -23
            query[q, row[row >= 0]] = weight[row >= 0]
            k, weight = k[row < 0], weight[row < 0]
            rare[q] = self._rare(k, weight)
        score = rare.astype(np.float32)
        in_blocks = score.reshape(len(vectors), blocks, self.block)
        bound = (in_blocks.max(axis=2) + query @ self.most.T) * (1 + slack[:, None])
        done = np.zeros(bound.shape, dtype=bool)
        ahead = min(blocks, -(-n // self.block) + _AHEAD)
        first = np.argpartition(-bound, ahead - 1, axis=1)[:, :ahead]
        np.put_along_axis(done, first, True, axis=1)
        self._multiply(score, query, done)
        reached = np.take_along_axis(in_blocks, first[:, :, None], axis=1).reshape(len(score), -1)
        least = _at_least(reached, n) * (1 - slack)
        # The other blocks that may still reach the nearest found.
        behind = ~done & (bound > 0) & (bound >= least[:, None])
        self._multiply(score, query, behind)
        done |= behind
        best = []
        for q, (row, weight) in enumerate(found):
            block = np.nonzero(done[q])[0]
            there = in_blocks[q, block].ravel()
            least_ = _at_least(there[None], n)[0] * (1 - 2 * slack[q])
            hit = np.nonzero((there > 0) & (there >= least_))[0]
            hit = block[hit // self.block] * self.block + hit % self.block
            cosine = rare[q, hit] + self.matrix.take(hit, 0).take(row, 1) @ weight
            # Equal examples tie whatever the order of the sums.
            cosine, number = np.round(cosine, 12), self.number[hit]
            order = np.lexsort((number, -cosine))[:n]
            order = order[cosine[order] > 0]
            best.append((np.minimum(cosine[order], 1), number[order]))
        return best

    def _rare(self, k: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What terms with lists add to each example."""
        start = np.where(k > 0, self.stops[k - 1], 0)
        sizes = self.stops[k] - start
        # Long lists are copied whole, entries of short ones picked.
        long = sizes >= _SLICED
        order = np.concatenate([np.nonzero(~long)[0], np.nonzero(long)[0]])
        of = _ranges(start[~long], sizes[~long])
        slices = list(map(slice, start[long].tolist(), (start + sizes)[long].tolist()))
        place, share = [np.concatenate([values.take(of), *map(values.__getitem__, slices)])
                        for values in self.postings]
        return np.bincount(place, np.repeat(weight[order], sizes[order]) * share,
                           len(self.matrix))

    def _multiply(self, score: np.ndarray, query: np.ndarray, of: np.ndarray) -> None:
        for b in np.nonzero(of.any(axis=0))[0].tolist():
            texts = np.nonzero(of[:, b])[0]
            part = slice(b * self.block, (b + 1) * self.block)
            score[texts, part] += query[texts] @ self.matrix[part].T


def _at_least(scores: np.ndarray, n: int) -> np.ndarray:
    """The ``n``-th largest of each row; 0 where there are fewer."""
    width = scores.shape[1]
    return np.partition(scores, width - n, axis=1)[:, width - n] if n <= width else np.zeros(
        len(scores))


def _neighbourhoods(example: np.ndarray, row: np.ndarray, weight: np.ndarray,
                    sizes: np.ndarray) -> np.ndarray:
    """An order of the examples: by which of a few centres is nearest, then by size.

    Centres are means of what is nearest to them, over frequent terms. The order decides only how
    many blocks a search can skip.
    """
    matrix = np.zeros((len(sizes), int(row.max(initial=-1)) + 1), np.float32)
    matrix[example[row >= 0], row[row >= 0]] = weight[row >= 0]
    centres = matrix[np.linspace(0, len(sizes) - 1, min(_CENTRES, len(sizes))).astype(int)]
    nearest = np.zeros(len(sizes), dtype=np.int64)
    for _ in range(_ROUNDS):
        length = np.linalg.norm(centres, axis=1, keepdims=True)
        nearest = (matrix @ (centres / np.maximum(length, 1e-9)).T).argmax(axis=1) if len(
            centres) else nearest
        for c in range(len(centres)):
            if (nearest == c).any():
                centres[c] = matrix[nearest == c].mean(axis=0)
    return np.lexsort((np.arange(len(sizes)), sizes, nearest))


def unit(at: list[int], counts: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TF-IDF unit vector, with logarithmic term frequency.

    Weights are rounded to single precision; cosines of such vectors are summed in double.
    """
    at_ = np.asarray(at, dtype=np.int32)
    weight = (1 + np.log(np.asarray(counts, dtype=np.float64))) * idf[at_] if len(at_) else (
        np.empty(0))
    if len(at_):
        weight = (weight / np.linalg.norm(weight)).astype(np.float32).astype(np.float64)
    return at_, weight


@dataclasses.dataclass(frozen=True)
class Model:
    """Weights of terms, the index, its examples' labels, and the calibration of the vote."""

    idf: np.ndarray
    index: Index
    ids: tuple
    toxic: np.ndarray
    weight: np.ndarray
    chances: tuple[np.ndarray, np.ndarray]
    blank: float
    settings: Settings

    def vote(self, cosine: np.ndarray, example: np.ndarray) -> float:
        """Log odds of the vote, in which a neighbour weighs as much as its cosine."""
        votes = self.weight * np.bincount(self.toxic[example], cosine, 2)
        votes += 0.1 * self.weight / self.weight.sum()  # what few and far neighbours leave open
        return float(np.log(votes[1] / votes[0]))

    def scores(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list]]:
        """Score and evidence of each (terms, counts)."""
        units = [unit(at, counts, self.idf) for at, counts in vectors]
        for cosine, example in self.index.nearest_of(units, self.settings.nearest):
            if not len(example):
                yield self.blank, []
                continue
            shown = slice(self.settings.evidence)
            yield float(np.interp(self.vote(cosine, example), *self.chances)), [
                (self.ids[e], c, int(self.toxic[e]))
                for c, e in zip(cosine[shown].tolist(), example[shown].tolist(), strict=True)]


def _monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and chances of toxicity, between which scores are drawn straight.

    The chances are the non-decreasing ones of least weighted squared error.
    """
    blocks: list[list[float]] = []  # first and last vote, weight of toxic ones, weight
    for value in np.unique(x):
        of = x == value
        blocks.append([value, value, float(w[of] @ y[of]), float(w[of].sum())])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, last, toxic, all_ = blocks.pop()
            blocks[-1][1:] = [last, blocks[-1][2] + toxic, blocks[-1][3] + all_]
    ends = np.array(blocks)
    return ends[:, :2].ravel(), np.repeat(ends[:, 2] / ends[:, 3], 2)


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", settings: Settings = Settings()
        ) -> tuple[Model, DataFrame]:
    """A model from labelled ids, and ``id`` with the term vector of every document, written.

    ``labelled`` has an id and a 0/1 label; rows with null in either are left out. Rows whose
    text is null count as empty. At most ``sample_rows`` examples, chosen by a hash of their
    id, reach the driver, as vectors of all their terms. Inverse document frequencies count
    all of ``docs``.
    """
    labels = labelled.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")
    ).where("id is not null and toxic in (0, 1)")
    there = {r["toxic"]: r["n"] for r in
             labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = settings.sample_rows // 2
    draw = F.xxhash64(F.lit("example"), "id")
    chosen = None
    for value in (0, 1):
        drawn = places(half, there.get(value, 0))
        part = (labels.where((F.col("toxic") == value) & (F.pmod(draw, F.lit(PLACES)) < drawn))
                .orderBy(draw, "id").limit(half))
        chosen = part if chosen is None else chosen.unionByName(part)
    vectors = materialise(docs.select(
        F.col(id_col).alias("id"), term_vector(text_col, settings.space).alias("vector")),
        "toxicity-terms")
    frequency = document_frequency(vectors, settings.space)
    idf = (np.log((1 + vectors.count()) / (1 + frequency)) + 1).astype(np.float32)

    # At most sample_rows ids.
    sample = vectors.join(F.broadcast(chosen), "id").toArrow()
    examples = [(i, t, *unpacked(v)) for i, t, v in zip(
        *[sample.column(c).to_pylist() for c in ("id", "toxic", "vector")], strict=True)]
    del sample
    examples.sort(key=lambda r: (r[0], r[1], r[2].tobytes(), r[3].tobytes()))
    return train(examples, there, idf, settings), vectors


def train(examples: list[tuple], there: dict[int, int], idf: np.ndarray,
          settings: Settings = Settings()) -> Model:
    """A model from (id, label, terms, counts) of examples; ``there`` are all labels of a class.

    Every fifth example is held back for the calibration: its own vote and those of examples with
    the same terms are left out of what its neighbours say.
    """
    toxic = np.array([t for _, t, _, _ in examples], dtype=np.int64)
    sizes = [int((toxic == v).sum()) for v in (0, 1)]
    prior = [there.get(v, 0) / max(1, sizes[v]) for v in (0, 1)]
    scale = max(prior) or 1.0
    weight = np.array([max(p / scale, 1e-3) for p in prior])  # of one example in all documents
    ids = [i for i, _, _, _ in examples]
    units = [unit(at, counts, idf) for _, _, at, counts in examples]
    del examples
    full = [k for k, (at, _) in enumerate(units) if len(at)]
    # Examples without a word are neighbours of nothing: their votes are a constant.
    blank = np.array([k for k in range(len(units)) if not len(units[k][0])], dtype=np.int64)
    tallies = [weight[v] * (toxic[blank] == v).sum() for v in (0, 1)] if len(blank) else [0, 0]
    nothing = (tallies[1] + 0.05) / (tallies[0] + tallies[1] + 0.5)

    index = Index([units[k] for k in full], settings.block)
    even = np.array([-1.0, 1.0]), np.array([0.0, 1.0])
    model = Model(idf, index, tuple(ids[k] for k in full), toxic[full], weight, even,
                  float(nothing), settings)

    votes, labels = [], []
    held = full[::5]
    for k in range(0, len(held), _TEXTS):
        part = held[k:k + _TEXTS]
        found = index.nearest_of([units[e] for e in part], 2 * settings.nearest)
        for e, (cosine, example) in zip(part, found, strict=True):
            others = np.nonzero(cosine < _SAME)[0][:settings.nearest]
            if len(others):
                votes.append(model.vote(cosine[others], example[others]))
                labels.append(toxic[e])
    if not votes:
        return model
    labels = np.array(labels)
    return dataclasses.replace(
        model, chances=_monotone(np.array(votes), labels, weight[labels]))


def score(vectors: DataFrame, model: Model) -> DataFrame:
    """``id``, ``score`` and ``evidence`` (id, cosine and label of the nearest examples).

    ``vectors`` has ``id`` and ``vector``. A text that shares no term with an example has no
    neighbour: its score is the toxic share of examples without a word, its evidence empty.
    """
    kind = pa.struct([("score", pa.float64()), ("evidence", pa.list_(pa.struct([
        ("id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])))])

    def of(batch: pa.Array) -> pa.Array:
        found = []
        for k in range(0, len(batch), _TEXTS):
            vectors = [unpacked(value.as_py()) for value in batch[k:k + _TEXTS]]
            found += [{"score": p, "evidence": [
                {"id": i, "cosine": s, "toxic": t} for i, s, t in near]}
                for p, near in model.scores(vectors)]
        return pa.array(found, type=kind)

    scored = F.arrow_udf(
        of, "score double, evidence array<struct<id:bigint,cosine:double,toxic:int>>")("vector")
    return vectors.select("id", scored.alias("scored")).select("id", "scored.*")
