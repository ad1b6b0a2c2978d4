"""Compression classifier: which of two zstandard dictionaries, of good or of bad text, fits a text better.

One dictionary is trained on pieces of good labelled texts, one on pieces of bad ones. A text's main
feature is the difference of its two compressed sizes over their sum; beside it stand the sizes over the
text's own length, the log of that length and the size without a dictionary. A logistic curve over these
and their squares, fitted on labelled texts that took no part in the dictionaries, makes the score.

The model is fitted on a bounded, uniform sample of the labelled rows (``SAMPLE`` ids a class and purpose,
by the hash of the id; of their whole texts ``PIECES`` pieces a class, by hash). Every text is scored whole.

Defined cases: null text scores as empty text; rows labelled both ways count as bad; without labelled rows
of both classes every score is the smoothed share of good labels; repeated rows are scored each; other
columns are carried; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import private, text_batches, text_fold, written

SAMPLE = 3000
PIECES, PIECE_BYTES = 4096, 2048
DICTIONARY_BYTES, LEVEL = 1 << 16, 3
FOLDS, DICTIONARY_FOLDS = 5, (1, 2)
CUT = 0.3
BATCH_BYTES = 8 << 20


def _measure(good: bytes, bad: bytes) -> Callable[[bytes], list[float]]:
    """Features of one text under the two dictionaries."""
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    by = []
    for content in (good, bad):
        kept = zstandard.ZstdCompressionDict(content)
        kept.precompute_compress(level=LEVEL)
        by.append(zstandard.ZstdCompressor(dict_data=kept, **plain))
    alone = zstandard.ZstdCompressor(**plain)

    def of(text: bytes) -> list[float]:
        n, g, b = max(1, len(text)), len(by[0].compress(text)), len(by[1].compress(text))
        return [(b - g) / (b + g), (b - g) / n, g / n, float(np.log1p(len(text))), len(alone.compress(text)) / n]

    return of


def _design(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, x**2, x[:, :1] * x[:, 1:]], axis=1)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60) -> Callable[[np.ndarray], np.ndarray]:
    """Ridge logistic regression by damped Newton steps; returns probabilities of 1."""
    x = _design(x)
    mean, sd = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / sd])
    keep = np.full(z.shape[1], ridge)
    keep[0] = 1e-6

    def loss(w):
        return np.logaddexp(0, z @ w).sum() - y @ (z @ w) + (keep * w**2).sum() / 2

    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (p - y) + keep * w)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break

    def score(raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(w[0] + ((_design(raw) - mean) / sd) @ w[1:], -30, 30)))

    return score


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> dict:
    """A model from the labelled rows whose fold is not 0: dictionaries and the scoring curve."""
    fold = text_fold(F.col("label_id"), FOLDS)
    marked = labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").cast("int").alias("y"))
    marked = marked.withColumn("fold", fold).filter("fold <> 0 AND label_id IS NOT NULL")
    counts = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if not counts.get(0) or not counts.get(1):
        return {"prior": prior}
    for_dictionary = F.col("fold").isin(*DICTIONARY_FOLDS)
    chosen = None
    for y in (0, 1):
        for use in (for_dictionary, ~for_dictionary):
            part = marked.filter((F.col("y") == y) & use).orderBy(F.xxhash64("label_id", F.lit(1)), "label_id").limit(SAMPLE)
            chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(chosen.withColumn("dictionary", for_dictionary))  # at most 4 * SAMPLE ids
    taken = docs.select(F.col(doc_id).alias("own"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("bytes"))
    sample = written(taken.join(chosen, F.col("own") == F.col("label_id")).select("own", "bytes", "y", "dictionary"), "labelled")

    cuts = F.sequence(F.lit(0), F.floor((F.octet_length("bytes") - 1) / PIECE_BYTES).cast("int"))
    pieces = sample.filter("dictionary AND octet_length(bytes) > 0").select("own", "y", F.posexplode(F.transform(cuts, lambda k: F.substring("bytes", k * PIECE_BYTES + 1, F.lit(PIECE_BYTES)))).alias("at", "piece"))
    made = {}
    for y in (0, 1):
        order = F.xxhash64("own", "at"), F.col("own"), F.col("at")
        rows = pieces.filter(F.col("y") == y).orderBy(*order).limit(PIECES).select("piece").collect()
        made[y] = _dictionary([bytes(r.piece) for r in rows])
    measured = sample.filter("NOT dictionary").mapInArrow(_measuring(made[1], made[0]), "y int, x array<double>").collect()
    y, x = np.array([r.y for r in measured], float), np.array([r.x for r in measured], float)
    if len(set(y)) < 2:
        return {"prior": prior}
    order = np.lexsort([*x.T, y])  # the same model whatever order the rows came in
    return {"prior": prior, "good": made[1], "bad": made[0], "score": _fit(x[order], y[order])}


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; the text itself where there is too little to train on."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, pieces)) // 8)), pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICTIONARY_BYTES]


def _measuring(good: bytes, bad: bytes):
    schema = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _measure(good, bad)
        for batch in text_batches(batches, 1, BATCH_BYTES):
            x = [of(b) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2).cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], schema=schema)

    return run


def classify(df: DataFrame, model: dict, text: str = "text", cut: float = CUT, drop_text: bool = False) -> DataFrame:
    """``df`` with score (0 to 1, higher: good likelier) and predicted (1 if score >= cut) added."""
    if "score" not in model:
        out = df.withColumn("score", F.lit(float(model["prior"])))
    else:
        (row,) = private(df, "_row")
        kept = [c for c in df.columns if not (drop_text and c == text) and c.lower() not in ("score", "predicted")]
        scored = df.select(F.struct(*kept).alias(row), F.col(text).cast("string").alias("_text"))
        row_type = scored.schema[row].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of = _measure(model["good"], model["bad"])
            for batch in text_batches(batches, 1, BATCH_BYTES):
                x = np.array([of(t.encode() if t else b"") for t in batch.column(1).to_pylist()], float)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model["score"](x))], names=[row, "score"])

        out = scored.mapInArrow(run, f"{row} {row_type}, score double").select(f"{row}.*", "score")
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
