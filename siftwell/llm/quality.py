"""A document quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 64 words.  Every passage of the whole text is
encoded (shares of character classes, word lengths, repetition; then a learned
tanh layer), gated attention weights the passages of a bag,

    weight_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))),

and a logistic layer scores the weighted sum of the passage encodings.  Only
document labels are needed for training: the attention learns which passages
carry them.  Training uses a bounded sample of labelled documents: at most
TRAIN_DOCUMENTS, taken in the order of a hash of their ids as long as all their
passages together number at most TRAIN_PASSAGES (one that would exceed this is
left out).  Every passage of a document is used, in training and in scoring.

A null, empty or blank text is a bag with one all-zero passage, and gets a score
like any other.  Without labels of both kinds the score is the smoothed share of
label 1 (0.5 without labels).  Repeated rows are scored alike, and are separate
documents in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.shared import Tables
from siftwell.llm.words import Words, slices

PASSAGE_WORDS = 64
#: Bounds of the training sample.
TRAIN_DOCUMENTS = 4000
TRAIN_PASSAGES = 300_000
_HIDDEN, _ATTENTION, _STEPS = 16, 8, 400

#: Character classes by byte: the rest is class 0.
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t\v\f", ".,;:", "!", "?", "|", "\"'()-", "#$%&*+/<=>@[\\]^_`{}~"]
_CLASS = np.zeros(256, np.uint8)
for _k, _members in enumerate(_CLASSES):
    _CLASS[[ord(c) for c in _members]] = _k + 1
_N_CLASSES = len(_CLASSES) + 1
FEATURES = _N_CLASSES + 6


def encode_passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the first passage of each row; a row without words has one of zeros."""
    counts = words.counts
    per_row = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(per_row)])
    out = np.zeros((first[-1], FEATURES), np.float32)
    if not len(words):
        return out, first
    rows = words.rows
    at = np.arange(len(words)) - words.first[rows]
    passage = first[rows] + at // PASSAGE_WORDS
    opening = at % PASSAGE_WORDS == 0
    # a passage's bytes: from its first word to the next passage or the row's end
    begin = words.start[opening]
    end = np.append(begin[1:], len(words.data))
    row_end = words.offsets[rows[opening] + 1]
    end = np.minimum(end, row_end)
    inside = np.zeros(len(words.data) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end, -1)
    kept = np.cumsum(inside[:-1]) > 0
    of_byte = np.repeat(passage[opening], end - begin)
    found = np.bincount(of_byte * _N_CLASSES + _CLASS[words.data[kept]], minlength=len(out) * _N_CLASSES).reshape(len(out), _N_CLASSES)
    n_bytes = np.maximum(1, found.sum(1, keepdims=True))
    out[:, :_N_CLASSES] = found / n_bytes
    n_words = np.maximum(1, np.bincount(passage, minlength=len(out)))
    length = words.end - words.start
    keys = words.hashes()

    def share(of_words: np.ndarray) -> np.ndarray:
        return np.bincount(passage, of_words, len(out)) / n_words

    for k, gap in enumerate((1, 2)):
        same = np.zeros(len(words))
        same[gap:] = (keys[gap:] == keys[:-gap]) & (passage[gap:] == passage[:-gap])
        out[:, _N_CLASSES + k] = share(same)
    last, opener = _CLASS[words.data[words.end - 1]], _CLASS[words.data[words.start]]
    out[:, _N_CLASSES + 2] = share((last > 6) & (last != 7))  # ends in a mark other than . , ; :
    out[:, _N_CLASSES + 3] = share(opener == 2)
    out[:, _N_CLASSES + 4] = share(length) / 10
    out[:, _N_CLASSES + 5] = np.log1p(np.bincount(passage, minlength=len(out))) / 4
    return out, first


@dataclass
class BagModel:
    """Weights of the encoder, the gated attention and the logistic layer; prior: the score where there are none."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * g) @ w["w"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a = e / np.add.reduceat(e, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1])
        return {"h": h, "t": t, "g": g, "a": a, "bag": bag, "z": z, "p": 1 / (1 + np.exp(-(z @ w["c"] + w["d"])))}

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(first) - 1, self.prior)
        return self._forward(self._scaled(x), first)["p"]

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -20, 20)

    def _gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of all bags."""
        w = self.weights
        f = self._forward(x, first)
        bag, a, h = f["bag"], f["a"], f["h"]
        dlogit = (f["p"] - y) / len(y)
        dz = dlogit[:, None] * w["c"]
        of_a = np.sum(h * dz[bag], 1)
        de = a * (of_a - np.add.reduceat(a * of_a, first[:-1])[bag])
        dtg = de[:, None] * w["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = (a[:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h**2)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dlogit, "d": dlogit.sum()}

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> BagModel:
        """Adam on the log loss of all bags, with a small penalty on the weights."""
        self.mean, self.scale = x.mean(0), x.std(0) + 0.02
        x = self._scaled(x)
        rng = np.random.default_rng(5)
        shapes = {"W": (FEATURES, _HIDDEN), "b": (_HIDDEN,), "V": (_HIDDEN, _ATTENTION), "U": (_HIDDEN, _ATTENTION), "w": (_ATTENTION,), "c": (_HIDDEN,), "d": ()}
        self.weights = w = {k: rng.normal(0, 1 / np.sqrt(max(1, s[0] if s else 1)), s) * (k not in "bd") for k, s in shapes.items()}
        m, v = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
        for step in range(1, _STEPS + 1):
            grad = self._gradient(x, first, y)
            for k, g in grad.items():
                g = g + 1e-4 * w[k] * (k not in "bd")
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g**2
                w[k] = w[k] - 0.03 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned: crc32 of the id as text leaves 2 when divided by 4; a null id is not one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = TRAIN_DOCUMENTS, passages: int = TRAIN_PASSAGES) -> BagModel:
    """Fit a model on at most sample labelled documents of that many passages outside the held-out fold, chosen by a hash of their ids.

    Rows without an id or label are left out.
    """
    chosen = (
        labels.where(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id", "y")
        .limit(sample)
    )
    rows = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text")).join(F.broadcast(chosen), "id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x, first = encode_passages(Words(part.column("text")))
            bags = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(np.diff(first), pa.int64()), pa.array(bags, pa.binary())], names=["id", "y", "n", "x"])

    kind = documents.schema[id_col].dataType.simpleString()
    encoded = Tables(documents.sparkSession).put(rows.mapInArrow(encode, f"id {kind}, y int, n long, x binary").withColumn("hash", F.xxhash64("x")))
    order = [F.xxhash64("id"), "id", "y", "n", "hash"]
    sizes = encoded.select("id", "y", "n", "hash").orderBy(*order).limit(sample).toPandas()
    left, chosen_rows = passages, []
    for k, n in enumerate(sizes["n"].tolist()):
        if n <= left:
            left -= n
            chosen_rows.append(k)
    if not chosen_rows:
        return BagModel(0.5)
    wanted = documents.sparkSession.createDataFrame(list(sizes[["id", "hash"]].iloc[chosen_rows].drop_duplicates().itertuples(index=False, name=None)), f"id {kind}, hash long")
    found = encoded.join(F.broadcast(wanted), ["id", "hash"]).orderBy(*order).limit(len(chosen_rows)).toPandas()
    y = (found["y"].to_numpy() == 1).astype(float)
    model = BagModel(float((y.sum() + 1) / (len(y) + 2)))
    if 0 < y.sum() < len(y):
        bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in found["x"]]
        model.fit(np.concatenate(bags).astype(np.float64), np.concatenate([[0], np.cumsum([len(b) for b in bags])]), y)
    return model


def score(df: DataFrame, model: BagModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """df with a column of scores between 0 and 1, higher where label 1 is likelier; a column of that name is replaced."""
    df = df.drop(score_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            got = model.scores(*encode_passages(Words(part.column(text_col))))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())], names=[*part.schema.names, score_col])

    return df.mapInArrow(run, df.withColumn(score_col, F.lit(0.0).cast("double")).schema)
