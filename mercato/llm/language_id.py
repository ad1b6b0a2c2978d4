"""Language of texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point alone. A trigram's vector binds
(multiplies) its letters' vectors, the first rotated by two places and the second by one. A text bundles
(adds) the vectors of all its trigrams; a language's prototype bundles its learning texts. The language
whose prototype has the largest cosine with the text is predicted. Texts are lower-cased; runs of other
characters count as one gap letter, and gaps also stand at both ends.

Prototypes are learnt on about ``SAMPLE`` documents a language, drawn by the hash of the id at a rate that
the language's count sets; sums are of whole numbers, so they do not depend on the order of rows.

Defined cases: null text and text without letters get ``und`` and score 0; without any learning text every
text does; equal cosines go to the first language by name; repeated rows are predicted each; other columns
are carried; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import private, text_batches

SAMPLE = 2000
DIMENSIONS, SEED = 1024, 20
UNKNOWN = "und"
#: Trigram vectors that a worker keeps before it starts anew.
KEPT = 40_000
BATCH_BYTES = 8 << 20
_RATE = 1 << 20


class Space:
    """Letter and trigram vectors, made on demand."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letter_no = np.full(0x110000, -1, np.int64)
        self.letter_no[0] = 0  # the gap
        self.letters = self._letter(0)[None]
        self.rows: dict[int, int] = {}
        self.trigrams = np.empty((0, dimensions), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        return (np.random.default_rng([SEED, code]).integers(0, 2, self.dimensions) * 2 - 1).astype(np.int8)

    def _codes(self, text: str) -> np.ndarray:
        """Numbers of the letters of a text, gaps as 0."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        numbers = self.letter_no[codes]
        if (numbers < 0).any():
            for code in np.unique(codes[numbers < 0]).tolist():
                if chr(code).isalpha():
                    self.letter_no[code] = len(self.letters)
                    self.letters = np.vstack([self.letters, self._letter(code)[None]])
                else:
                    self.letter_no[code] = 0
            numbers = self.letter_no[codes]
        numbers = np.concatenate([[0], numbers, [0]])
        return numbers[np.r_[True, (numbers[1:] != 0) | (numbers[:-1] != 0)]]

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The vector of a text (whole numbers), or None without letters."""
        n = self._codes(text or "")
        if len(n) < 3:
            return None
        keys, counts = np.unique((n[:-2] << 42) | (n[1:-1] << 21) | n[2:], return_counts=True)
        return counts.astype(np.float32) @ self._vectors(keys) if len(keys) <= KEPT else self._many(keys, counts)

    def _many(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(self.dimensions, np.float32)
        for k in range(0, len(keys), KEPT):
            total += counts[k : k + KEPT].astype(np.float32) @ self._vectors(keys[k : k + KEPT])
        return total

    def _vectors(self, keys: np.ndarray) -> np.ndarray:
        new = [k for k in keys.tolist() if k not in self.rows]
        if new:
            if len(self.rows) + len(new) > KEPT:
                self.rows, self.trigrams, new = {}, self.trigrams[:0], keys.tolist()
            k = np.array(new)
            a, b, c = (self.letters[(k >> s) & 0x1FFFFF] for s in (42, 21, 0))
            made = (np.roll(a, 2, axis=1) * np.roll(b, 1, axis=1) * c).astype(np.float32)
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.trigrams = np.vstack([self.trigrams, made])
        return self.trigrams[[self.rows[k] for k in keys.tolist()]]


_spaces: dict[int, Space] = {}


def space(dimensions: int = DIMENSIONS) -> Space:
    """The worker's vectors, kept from task to task."""
    if dimensions not in _spaces:
        _spaces[dimensions] = Space(dimensions)
    return _spaces[dimensions]


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit prototypes by language, from the rows of ``docs`` with a language."""
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang")).filter("lang IS NOT NULL")
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return {}
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r.lang, min(_RATE, -(-_RATE * sample // r.n)))])
    chosen = known.filter(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(_RATE)) < F.element_at(rates, F.col("lang")))
    schema = pa.schema([("lang", pa.string()), ("total", pa.binary())])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in text_batches(batches, 0, BATCH_BYTES):
            for t, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vector = space(dimensions).bundle(t)
                if vector is not None:
                    totals[g] = totals.get(g, 0) + vector.astype(np.float64)
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([v.tobytes() for v in totals.values()], pa.binary())], schema=schema)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.float64) for b in pdf["total"])
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "total": [total.tobytes()]})

    parts = chosen.select("text", "lang").mapInArrow(bundle, "lang string, total binary")
    totals = {r.lang: np.frombuffer(bytes(r.total), np.float64) for r in parts.groupBy("lang").applyInPandas(add, "lang string, total binary").collect()}
    return {g: (v / (np.linalg.norm(v) or 1)).astype(np.float32) for g, v in sorted(totals.items())}


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS, drop_text: bool = False) -> DataFrame:
    """``df`` with lang_pred and score (the cosine, 0 at least) added."""
    (row,) = private(df, "_row")
    kept = [c for c in df.columns if not (drop_text and c == text) and c.lower() not in ("lang_pred", "score")]
    rows = df.select(F.struct(*kept).alias(row), F.col(text).cast("string").alias("_text"))
    names = list(prototypes)
    table = np.stack(list(prototypes.values())) if names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 1, BATCH_BYTES):
            said, scores = [], []
            for t in batch.column(1).to_pylist():
                vector = space(dimensions).bundle(t) if names else None
                if vector is None or not (size := np.linalg.norm(vector)):
                    said.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = table @ vector / size
                best = int(np.argmax(cosines))
                said.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string()), pa.array(scores, pa.float64())], names=[row, "lang_pred", "score"])

    return rows.mapInArrow(run, f"{row} {rows.schema[row].dataType.simpleString()}, lang_pred string, score double").select(f"{row}.*", "lang_pred", "score")


