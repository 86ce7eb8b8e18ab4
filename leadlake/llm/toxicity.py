"""Toxicity classifier with counterfactual regularisation.

A logistic model over hashed words and word beginnings is fitted to labelled texts. Where a labelled text names a
group of people, copies are made with the name of another group in its place, and a difference between the
scores of a text and its copies is penalised. So the model can't learn that naming a group is toxic, and neutral
mentions keep their low scores. The fit sees a bounded sample of labelled texts; scoring sees every text whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.arrow_text import text_bytes
from leadlake.llm.common import arrow_column, tidy
from leadlake.llm.words import LOWERED, word_hashes, word_spans

#: Groups of names that may stand for one another, in the languages of the corpus. The default of a
#: parameter; name the groups of other languages there.
IDENTITIES = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("man", "woman"),
    ("men", "women"),
    ("immigrant", "refugee", "native"),
    ("immigrants", "refugees", "natives"),
    ("arab", "chinese", "indian", "mexican", "turkish", "polish", "russian"),
    ("disabled", "blind", "deaf"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("noir", "blanc", "asiatique", "africain", "européen", "arabe"),
    ("homme", "femme"),
    ("hommes", "femmes"),
    ("immigré", "réfugié"),
    ("immigrés", "réfugiés"),
    ("christ", "muslim", "jude", "hindu", "buddhist", "atheist"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarzer", "weißer", "asiate", "afrikaner", "europäer", "araber"),
    ("mann", "frau"),
    ("männer", "frauen"),
    ("einwanderer", "flüchtling"),
    ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("negro", "blanco", "asiático", "africano", "europeo", "árabe"),
    ("hombre", "mujer"),
    ("hombres", "mujeres"),
    ("inmigrante", "refugiado"),
    ("inmigrantes", "refugiados"),
)
#: Words are runs of letters; every byte that is not ASCII counts as one.
LETTERS = np.zeros(256, bool)
LETTERS[ord("a") : ord("z") + 1] = True
LETTERS[0x80:] = True
BITS = 18
#: Bytes of word beginnings, 0 for the whole word; each kind is hashed apart.
KINDS = (0, 4, 5)


@dataclass(frozen=True)
class Settings:
    identities: Sequence[Sequence[str]] = field(default=IDENTITIES)
    #: Labelled texts of each class that the fit may use, about; taken by a hash of their ids.
    per_class: int = 4_000
    #: Copies of a text with other names.
    copies: int = 2
    #: Weight of the penalty on score changes; of the weights' sizes, by which the first fit chooses features; of
    #: their squares in the second fit, which weighs the chosen ones.
    counterfactual: float = 1.0
    lasso: float = 1e-3
    ridge: float = 1e-4
    #: Features in fewer sampled texts than this are not used.
    least_texts: int = 3
    steps: int = 200
    rate: float = 0.3


# ---------------------------------------------------------------- features


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature): different features of each text, in order."""
    data = LOWERED[data]
    begins, ends = word_spans(data, offsets, LETTERS)
    text = np.searchsorted(offsets, begins, side="right") - 1
    found = []
    for number, size in enumerate(KINDS):
        some = slice(None) if not size else ends - begins > size
        stop = ends if not size else np.minimum(ends, begins + size)
        hashes = word_hashes(data, begins[some], stop[some]) * np.uint64(2 * number + 1)
        found.append((text[some].astype(np.int64) << BITS) | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    keys = np.unique(np.concatenate(found))
    return keys >> BITS, keys & ((1 << BITS) - 1)


class Swaps:
    """Copies of a text with each name of a group replaced by the next ones of its list."""

    def __init__(self, identities: Sequence[Sequence[str]], copies: int):
        self.copies, self.next = copies, {}
        for group in identities:
            for i, name in enumerate(group):
                # a name of two groups (of two languages) is swapped within the first
                self.next.setdefault(name, [group[(i + k) % len(group)] for k in range(1, copies + 1)])
        names = "|".join(sorted(map(re.escape, self.next), key=len, reverse=True))
        self.pattern = re.compile(rf"\b(?:{names})\b", re.IGNORECASE) if names else None

    def of(self, text: str) -> list[str]:
        if self.pattern is None or not self.pattern.search(text):
            return []
        return [self.pattern.sub(lambda m, k=k: self.next[m[0].lower()][k], text) for k in range(self.copies)]


# ---------------------------------------------------------------- the fit


def _sampled(labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, float]]:
    """About `per_class` labelled ids of each class, and the share taken of each."""
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {k: min(1.0, settings.per_class / n) for k, n in counts.items()}
    limit = F.lit(0)
    for label, share in shares.items():
        limit = F.when(F.col("label") == label, int(share * (1 << 30))).otherwise(limit)
    return labels.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) < limit), shares


def fit_weights(texts: list[np.ndarray], labels, shares, pairs, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights by feature, and the constant. `texts`: features of each sampled text; `pairs`: (text, features of a
    copy). Texts count by the inverse of the share taken of their class, so scores are probabilities."""
    weights = np.zeros(1 << BITS)
    if not len(texts):
        return weights, 0.0
    label = np.asarray(labels, float)
    gain = np.array([1 / shares[y] for y in labels])
    gain /= gain.sum()
    prior = min(max(float((gain * label).sum()), 1e-6), 1 - 1e-6)
    constant = float(np.log(prior / (1 - prior)))
    column = np.concatenate(texts).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    common = np.bincount(column, minlength=1 << BITS) >= settings.least_texts
    named, changed = len(pairs), np.empty(0, np.int64)
    side = np.empty(0)
    if named:  # a pair is a row of its own: features of the text count 1, those of the copy -1
        parts = [(k, f, s) for k, (i, copy) in enumerate(pairs) for f, s in ((texts[i], 1.0), (copy, -1.0))]
        changed = np.concatenate([f for _, f, _ in parts]).astype(np.int64)
        pair = np.concatenate([np.full(len(f), k) for k, f, _ in parts])
        side = np.concatenate([np.full(len(f), s) for _, f, s in parts])
        common[changed] = True
    kept = common[column]
    column, row = column[kept], row[kept]
    used = np.flatnonzero(common)
    place = np.zeros(1 << BITS, np.int64)
    place[used] = np.arange(len(used))
    column, changed = place[column], place[changed]

    def descend(w, constant, open_, lasso, ridge):
        seen, seen_constant = np.zeros(len(used)), 0.0
        for _ in range(settings.steps):
            z = np.bincount(row, weights=w[column], minlength=len(texts)) + constant
            error = gain * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
            slope = np.bincount(column, weights=error[row], minlength=len(used)) + ridge * w
            if named:
                change = np.bincount(pair, weights=side * w[changed], minlength=named)
                pull = settings.counterfactual * change / named
                slope += np.bincount(changed, weights=side * pull[pair], minlength=len(used))
            seen += slope**2
            seen_constant += error.sum() ** 2
            step = settings.rate / (np.sqrt(seen) + 1e-8)
            w = w - step * slope
            w = np.where(open_, np.sign(w) * np.maximum(np.abs(w) - step * lasso, 0), 0)
            constant -= settings.rate * float(error.sum() / (np.sqrt(seen_constant) + 1e-8))
        return w, constant

    open_ = np.ones(len(used), bool)
    w = np.zeros(len(used))
    for lasso, ridge in ((settings.lasso, 0.0), (0.0, settings.ridge)):
        w, constant = descend(w, constant, open_, lasso, ridge)
        open_ = w != 0  # the second fit weighs only what the first has chosen
    weights[used] = w
    return weights, constant


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> tuple[np.ndarray, float]:
    """Fit on the labelled rows of `docs`; `labels` (id, label 0 or 1; other labels and null are left out).

    At most about 2 x per_class ids are used, and one text of each, the least, so that an id which very many rows
    share can't make the sample larger; the driver gets the different feature numbers (2^18 at most each). Repeated
    labels of an id count as often. Where no sampled text names a group there is no pair, and the model is a plain
    logistic one. Without labelled texts every score is 0.5.
    """
    settings = settings or Settings()
    listed = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    sample, shares = _sampled(listed.where("label in (0, 1) and doc_id is not null"), settings)
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = own.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    texts = wanted.groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")

    def extract(batches):
        swaps = Swaps(settings.identities, settings.copies)
        for batch in batches:
            for doc_id, label, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                texts = [text or "", *swaps.of(text or "")]
                row, feature = features(*text_bytes(pa.array(texts, pa.large_string())))
                cut = np.searchsorted(row, np.arange(1, len(texts)))
                packed = [f.astype(np.int32).tobytes() for f in np.split(feature, cut)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id]), pa.array([label], pa.int32()), pa.array([packed], pa.list_(pa.binary()))],
                    ["doc_id", "label", "features"],
                )

    id_type = own.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(tidy(extract), f"doc_id {id_type}, label int, features array<binary>")
    texts, known, pairs = [], [], []
    for row in sorted(found.collect(), key=lambda r: (r["doc_id"], r["label"], r["features"][0])):
        own_features, *copies = (np.frombuffer(f, np.int32) for f in row["features"])
        pairs += [(len(texts), c) for c in copies]
        texts.append(own_features)
        known.append(row["label"])
    return fit_weights(texts, known, shares, pairs, settings)


# ---------------------------------------------------------------- scores


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: id, score (0 to 1), predicted (1 from 0.5 on).

    Null, empty and wordless texts get the score of the constant alone. Repeated rows and null ids are rows like
    any other; other columns are not read. An empty table gives no rows. The weights (2 MB) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def rate(batches):
        weights, constant = shared.value
        for batch in batches:
            row, feature = features(*text_bytes(arrow_column(batch, "text")))
            z = np.bincount(row, weights=weights[feature], minlength=len(batch)) + constant
            scores = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [arrow_column(batch, "doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    rated = rows.mapInArrow(tidy(rate), f"doc_id {id_type}, score double, predicted int")
    return rated.withColumnRenamed("doc_id", id_col)
