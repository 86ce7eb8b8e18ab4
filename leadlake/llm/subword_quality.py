"""Quality classifier on supervised subword embeddings.

A document is the mean of learned vectors: one for each of its words, its pairs of neighbouring words and the
character n-grams of its words, all hashed into one table. A softmax over the two labels reads the mean. Vectors
and softmax are trained together by stochastic gradient descent in numpy, one document a step, on a bounded sample
of labelled texts.

The softmax is linear in the mean, so after training each vector is folded into the one number by which it moves
the difference of the two logits. Tasks then score whole texts with a table of 2^BITS floats.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.arrow_text import text_bytes
from leadlake.llm.common import arrow_column, tidy
from leadlake.llm.words import BETWEEN_BLANKS, mixed, word_hashes, word_spans

BITS = 17
#: Code points of the n-grams.
GRAMS = (3, 4, 5)
#: Fixed value: what a word pair is hashed as that repeats one word.
AGAIN = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Code points, and words, whose features are made at once: bounds the arrays of a very long text.
PIECE = 1 << 20
BLANK = np.zeros(33, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Settings:
    #: Labelled documents of each class that the fit may use, about; taken by a hash of their ids.
    per_class: int = 4_000
    dimensions: int = 16
    epochs: int = 10
    #: First steps of the vectors, of which a text moves each by its share of the mean only, and of the softmax.
    #: Both fall to none in a straight line.
    vector_rate: float = 100.0
    softmax_rate: float = 0.5
    #: Score from which a document is predicted to be of label 1.
    threshold: float = 0.3


# ---------------------------------------------------------------- features


def _blank(codes: np.ndarray) -> np.ndarray:
    return BLANK[np.minimum(codes, 32)] & (codes <= 32)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(64 - BITS)).astype(np.int32)


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts that lie one after the other, and where each text begins (plus the end)."""
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, begins[offsets]


def _grams(codes: np.ndarray, begins: np.ndarray):
    """(text, bucket) of all n-grams, in pieces. A word is read with one blank before and after it; an n-gram may
    begin or end with that blank, and a text begins and ends with one."""
    texts = len(begins) - 1
    # a blank stands before each text and after the last one
    at = np.arange(len(codes)) + np.repeat(np.arange(1, texts + 1), np.diff(begins))
    padded = np.full(len(codes) + texts + 1, 32, np.uint32)
    padded[at] = codes
    starts = begins[:-1] + np.arange(1, texts + 1)  # of each text in the padded codes
    blank = _blank(padded)
    padded[blank] = 32
    most = max(GRAMS)
    for low in range(0, len(padded), PIECE):
        some = padded[low : low + PIECE + most - 1].astype(np.uint64)
        gap = blank[low : low + PIECE + most - 1]
        total = some * _FACTOR
        inside = np.zeros(len(some), bool)  # a blank among the inner characters
        for size in range(2, most + 1):
            n = min(PIECE, len(some) - size + 1)
            if n <= 0:
                break
            if size > 2:
                inside = inside[:n] | gap[size - 2 : size - 2 + n]
            total = (total[:n] ^ some[size - 1 : size - 1 + n]) * _FACTOR
            if size in GRAMS:
                found = np.flatnonzero(~inside[:n])
                text = np.searchsorted(starts, found + (low + 1), side="right") - 1
                yield text, _buckets(total[found] + np.uint64(size))


def _words(data: np.ndarray, offsets: np.ndarray):
    """(text, bucket) of all words and all pairs of neighbours, in pieces."""
    begins, ends = word_spans(data, offsets, BETWEEN_BLANKS)
    before, before_text = np.empty(0, np.uint64), np.empty(0, np.int64)
    for low in range(0, len(begins), PIECE):
        some = slice(low, low + PIECE)
        hashes = word_hashes(data, begins[some], ends[some])
        text = np.searchsorted(offsets, begins[some], side="right") - 1
        yield text, _buckets(hashes)
        hashes, text = np.concatenate([before, hashes]), np.concatenate([before_text, text])
        same = text[1:] == text[:-1]
        first, second = hashes[:-1][same], hashes[1:][same]
        yield text[1:][same], _buckets(np.where(first == second, AGAIN, mixed(first) * _FACTOR + second))
        before, before_text = hashes[-1:], text[-1:]


def features(data: np.ndarray, offsets: np.ndarray):
    """(text, bucket) of all features of texts that lie one after the other in UTF-8, in pieces."""
    yield from _words(data, offsets)
    yield from _grams(*_code_points(data, offsets))


# ---------------------------------------------------------------- the fit


def train(texts, labels, gains, settings: Settings) -> tuple[np.ndarray, float]:
    """(number of each bucket, constant): the logit of label 1 is the mean of a text's numbers, plus the constant.

    `texts`: (different buckets, share of the text's features) of each; `gains`: weight of each text. The vectors
    take plain steps, so that one text of rare features can't move them as far as many texts of a common one; the
    softmax's steps fall with the errors it has seen.
    """
    rng = np.random.default_rng(11)
    dims = settings.dimensions
    table = rng.uniform(-1, 1, (1 << BITS, dims)).astype(np.float32) / dims
    out, constant = np.zeros((dims, 2), np.float32), np.zeros(2, np.float32)
    seen = np.full(2, 1e-8, np.float32)
    for epoch in range(settings.epochs):
        left = np.float32(1 - epoch / settings.epochs)
        for i in rng.permutation(len(texts)):
            bucket, share = texts[i]
            mean = share @ table[bucket]
            logits = mean @ out + constant
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[labels[i]] -= 1
            error *= gains[i]
            table[bucket] -= np.outer(share, np.float32(settings.vector_rate) * left * (out @ error))
            seen += error**2
            step = np.float32(settings.softmax_rate) * left / np.sqrt(seen) * error
            out -= np.outer(mean, step)
            constant -= step
    fold = out[:, 1] - out[:, 0]
    return table @ fold, float(constant[1] - constant[0])


def _packed(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted buckets by their distances, and their counts: mostly small numbers, which compress well."""
    return zlib.compress(np.concatenate([np.diff(buckets, prepend=0), counts]).astype(np.uint32).tobytes(), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, and their shares of all features of the text."""
    gaps, counts = np.frombuffer(zlib.decompress(packed), np.uint32).reshape(2, -1)
    return np.cumsum(gaps, dtype=np.int32), (counts / max(1, int(counts.sum()))).astype(np.float32)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> tuple[np.ndarray, float]:
    """Fit on the labelled rows of `docs`; `labels` (id, label 0 or 1; other labels, null and ids of both labels
    are left out).

    At most about 2 x per_class ids are used. Rows that share an id count as one document, by the least of their
    texts, so a repeated id can't make the sample larger. The driver gets the different buckets of each text, 2^BITS
    at most. A class counts by its share of all labelled ids, however many are sampled, so that scores are
    probabilities. Without labelled texts every score is 0.5.
    """
    settings = settings or Settings()
    listed = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    single = listed.where("label in (0, 1) and doc_id is not null").groupBy("doc_id")
    single = single.agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    counts = {r["label"]: r["n"] for r in single.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return np.zeros(1 << BITS, np.float32), 0.0
    limit = F.lit(0)
    for label, n in counts.items():
        limit = F.when(F.col("label") == label, int(min(1.0, settings.per_class / n) * (1 << 30))).otherwise(limit)
    sample = single.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) < limit).select("doc_id", "label")

    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = own.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def extract(batches):
        for batch in batches:
            ids, known, texts = (batch.column(i) for i in range(3))
            for i in range(len(batch)):
                counted = np.zeros(1 << BITS, np.int64)
                for _, bucket in features(*text_bytes(texts.slice(i, 1))):
                    counted += np.bincount(bucket, minlength=1 << BITS)
                some = np.flatnonzero(counted)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, 1), known.slice(i, 1), pa.array([_packed(some, counted[some])])], ["doc_id", "label", "packed"]
                )

    id_type = own.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(tidy(extract), f"doc_id {id_type}, label int, packed binary")
    texts, known = [], []
    for row in sorted(found.collect(), key=lambda r: r["doc_id"]):
        texts.append(_unpacked(row["packed"]))
        known.append(row["label"])
    total, sampled = sum(counts.values()), np.bincount(known, minlength=2)
    gains = [counts[y] / total * len(known) / sampled[y] for y in known]
    return train(texts, known, np.array(gains, np.float32), settings)


# ---------------------------------------------------------------- scores


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: id, score (0 to 1, the chance of label 1), predicted (1 from the threshold on).

    Every text is read whole. Null, empty and blank texts get the score of the constant alone. Repeated rows and null
    ids are rows like any other; other columns, whatever their names, are not read. An empty table gives no rows. The
    broadcast table has 2^BITS floats (half a MB).
    """
    settings = settings or Settings()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def rate(batches):
        numbers, constant = shared.value
        for batch in batches:
            sums, found = np.zeros(len(batch)), np.zeros(len(batch))
            for text, bucket in features(*text_bytes(arrow_column(batch, "text"))):
                sums += np.bincount(text, weights=numbers[bucket], minlength=len(batch))
                found += np.bincount(text, minlength=len(batch))
            z = sums / np.maximum(found, 1) + constant
            scores = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [arrow_column(batch, "doc_id"), pa.array(scores), pa.array((scores >= settings.threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    rated = rows.mapInArrow(tidy(rate), f"doc_id {id_type}, score double, predicted int")
    return rated.withColumnRenamed("doc_id", id_col)
