"""Quality scores from compression: how much better a text packs with a dictionary built
from good texts than with one from bad texts.

Two Zstandard dictionaries are trained on labelled text. The difference of the two
compressed sizes, normalised by their sum and by the size without a dictionary,
becomes a probability by logistic calibration on labelled texts that the dictionaries
have not seen; the plain compression ratio and the length correct for texts that are
repetitive or too short for a difference to show.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import map_texts, slices

#: Labelled rows of each class that the model is fitted on, at most, in the order of a hash of the id.
SAMPLE_ROWS = 3000
#: Longer texts are not taken into that sample; they are scored like all others.
SAMPLE_CHARS = 1 << 16
DICTIONARY_BYTES = 110 << 10
LEVEL = 3
_NEWTON_STEPS = 50
_RIDGE = 0.1


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class CompressionModel:
    dictionaries: dict[int, bytes | None]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the intercept

    def scorer(self):
        packers = {label: _packer(data) for label, data in self.dictionaries.items()}
        plain = _packer(None)

        def score(texts: list[str]) -> np.ndarray:
            x = (_features(packers, plain, texts) - self.mean) / self.scale
            return _sigmoid(x @ self.weights[:-1] + self.weights[-1])

        return score


def _packer(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    more = {}
    if dictionary:
        more["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        more["dict_data"].precompute_compress(level=LEVEL)
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    return zstandard.ZstdCompressor(compression_params=params, **more)


def _features(packers, plain, texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        data = text.encode()
        good, bad, alone = (len(p.compress(data)) for p in (packers[1], packers[0], plain))
        out[i] = (
            (bad - good) / (bad + good),
            (bad - good) / alone,
            np.log((alone + 1) / (len(data) + 1)),
            np.log1p(len(data)),
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _dictionary(texts: list[str]) -> bytes | None:
    samples = [t.encode() for t in texts if t]
    if not samples:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: use it as it is
        return b"".join(samples)[:DICTIONARY_BYTES] or None


def fit_texts(rows: list[tuple[str, int, bool]]) -> CompressionModel:
    """Fit on (text, label, for the dictionaries); the other rows calibrate."""
    dictionaries = {label: _dictionary([t for t, y, part in rows if y == label and part]) for label in (0, 1)}
    model = CompressionModel(dictionaries, np.zeros(4), np.ones(4), np.zeros(5))
    rest = [(t, y) for t, y, part in rows if not part] or [(t, y) for t, y, _ in rows]
    labels = np.array([y for _, y in rest], float)
    if not len(labels):
        return model
    x = _features({k: _packer(v) for k, v in dictionaries.items()}, _packer(None), [t for t, _ in rest])
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.c_[(x - model.mean) / model.scale, np.ones(len(x))]
    model.weights = _logistic(x, labels)
    return model


def _logistic(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic regression; a Newton step is halved until the loss falls, as whole
    steps run away where the classes are nearly separable."""

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - labels @ z + _RIDGE / 2 * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(_NEWTON_STEPS):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + _RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - labels) + _RIDGE * w)
        before, size = loss(w), 1.0
        while size > 1e-6 and not loss(w - size * step) < before:
            size /= 2
        if size <= 1e-6:
            break
        w = w - size * step
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> CompressionModel:
    """Fit on a bounded sample (SAMPLE_ROWS a class) of the labelled rows that are not held out.

    The ids are drawn from the labels alone, so only the sampled texts leave the documents.
    Rows without an id or a label of 0 or 1 are not used; of repeated labels the smallest
    holds. Without any usable label every score is 0.5.
    """
    own = labels.select(F.col(key).alias("_key"), F.col("quality").cast("int").alias("_label"))
    own = own.filter(F.col("_key").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_key")))
    own = own.groupBy("_key").agg(F.min("_label").alias("_label")).withColumn("_hash", F.xxhash64("_key"))
    drawn = None
    for label in (0, 1):
        part = own.filter(F.col("_label") == label).orderBy("_hash", "_key").limit(SAMPLE_ROWS)
        drawn = part if drawn is None else drawn.union(part)
    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    rows = (
        texts.join(F.broadcast(drawn), "_key")  # 2 * SAMPLE_ROWS rows at most
        .filter(F.length("_text") <= SAMPLE_CHARS)
        .groupBy("_key", "_label", "_hash")
        .agg(F.min("_text").alias("_text"))
        .collect()
    )
    rows.sort(key=lambda r: (r["_hash"], r["_key"]))
    return fit_texts([(r["_text"], r["_label"], r["_hash"] % 2 == 0) for r in rows])


def score_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, held_out, score (0 to 1) and predicted (score >= 0.5) of every row.

    Null and empty texts get the score of an empty text; a null key is not held out;
    repeated rows get a row each; an empty table gives none. Only key and text are read.
    """
    model = fit(docs, labels, key, text)

    def work():
        score = model.scorer()
        return lambda keys, texts: {"key": keys, "score": score(texts).tolist()}

    kind = docs.schema[key].dataType.simpleString()
    out = map_texts(docs, key, text, work, f"key {kind}, score double")
    return out.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose score is 0.5 or more."""
    model = fit(docs, labels, key, text)

    def run(batches):
        score = model.scorer()
        for batch in batches:
            for part in slices(batch, text):
                texts = [x or "" for x in part.column(text).cast(pa.string()).to_pylist()]
                yield part.filter(pa.array(score(texts) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
