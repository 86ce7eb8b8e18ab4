"""Near-duplicates by MinHash with tensored banding; every link is confirmed on full shingle sets.

A document has `collections` small collections of `rows` minhashes. A table's key joins the hashes of two of
them, so 12 collections of 2 give 66 tables of 4 hashes from 24 minhashes instead of 264. Documents of similarity
s meet in a table unless fewer than two collections agree: at s = 0.85 that is 7 in a million. More rows a
collection (with more collections) suit larger corpora.

Texts with equal sets are one node from the start. A bucket never emits all its pairs. First its members meet the
smallest of them, and what is linked becomes one component. Then only members outside the component of their
bucket's smallest one meet the rest: each pair in the first table that holds both, and only if sketches of up to
1,024 further minhashes do not rule the link out, so no link that decides a component is missed.

Joins name the merge join where Spark would size a side by compressed files, or by what a Python step reads (a text
makes a row for each of 66 tables): such a side can be many times its estimate, and too large for the driver to
broadcast.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.arrow_text import text_bytes
from leadlake.llm.common import Scratch, arrow_column, tidy
from leadlake.llm.components import components
from leadlake.llm.words import mixed, text_shingles
from leadlake.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    #: Words of a shingle, and the least similarity in percent.
    words: int = 3
    percent: int = 85
    collections: int = 12
    rows: int = 2


#: Minhashes of a sketch, of which four bits each are kept; and of the finer one that only documents get whose
#: buckets hold more than one component.
SKETCHED, FINE = 128, 1024
#: Deviations from the mean of a sketch's distance at the least similarity that are let through: one pair in
#: some millions at that similarity lies beyond.
DEVIATIONS = 5.5


def most_distance(percent: int, hashed: int) -> int:
    """Greatest number of bits in which sketches may differ: an unequal minhash differs in two of four on average."""
    unequal = 1 - percent / 100
    deviation = math.sqrt(hashed * (5 * unequal - 4 * unequal**2))
    return math.ceil(2 * hashed * unequal + DEVIATIONS * deviation)


def _seeds(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def minhashes(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Least value under each of the hash functions."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, (1 << 18) // len(seeds))
    for at in range(0, len(shingles), step):
        some = shingles[at : at + step]
        np.minimum(least, ((some[:, None] ^ seeds) * (seeds | np.uint64(1))).min(axis=0), out=least)
    return least


def collection_hashes(least: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each collection of `rows` minhashes."""
    total = np.arange(len(least) // rows, dtype=np.uint64)
    for k in range(rows):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + least[k::rows])
    return total


def table_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys for all pairs of collections; the last eight bits are the table's number."""
    first, second = np.triu_indices(hashes.shape[-1], 1)
    keys = mixed(hashes[..., first] * np.uint64(0x9E3779B97F4A7C15) + hashes[..., second])
    return (keys << np.uint64(8)) | np.arange(len(first), dtype=np.uint64)


def sketch_of(least: np.ndarray) -> np.ndarray:
    """Four bits of each minhash, sixteen to a long."""
    bits = (least >> np.uint64(40)) & np.uint64(15)
    return (bits.reshape(-1, 16) << np.arange(0, 64, 4, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, n_shingles, digest, hashes, sketch) of `docs` (doc_id, text); the last three are null for an empty
    set."""
    hashed = settings.collections * settings.rows
    seeds = _seeds(hashed + SKETCHED)

    def sign(batches):
        for batch in batches:
            sets = text_shingles(*text_bytes(arrow_column(batch, "text")), settings.words)
            hashes, sketches = [], []
            for shingles in sets:
                least = minhashes(shingles, seeds) if len(shingles) else None
                hashes.append(None if least is None else collection_hashes(least[:hashed], settings.rows).view(np.int64))
                sketches.append(None if least is None else sketch_of(least[hashed:]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    arrow_column(batch, "doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "hashes", "sketch"],
            )

    kinds = "doc_id long, n_shingles long, digest binary, hashes array<long>, sketch array<long>"
    return docs.mapInArrow(tidy(sign), kinds)


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) for every table."""

    def explode(batches):
        for batch in batches:
            if not len(batch):
                continue
            hashes = arrow_column(batch, "hashes").flatten().to_numpy().view(np.uint64).reshape(len(batch), -1)
            keys = table_keys(hashes)
            node = np.repeat(arrow_column(batch, "node").to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(node, pa.int64())], ["key", "node"]
            )

    return nodes.select("node", "hashes").mapInArrow(tidy(explode), "key long, node long")


def confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Of `pairs` (a, b): those whose full sets are similar enough. `texts`: (node, text).

    The pivot b may be in very many pairs: it is joined last, as a key that AQE can split.
    """
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b"
    )

    def compare(batches):
        pivot, pivot_set = None, None
        for batch in batches:
            a, b = (arrow_column(batch, c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            sets = text_shingles(*text_bytes(arrow_column(batch, "text_a")), settings.words)
            text_b, linked = arrow_column(batch, "text_b"), np.zeros(len(a), bool)
            for i, own in enumerate(sets):
                if b[i] != pivot:
                    pivot = b[i]
                    pivot_set = text_shingles(*text_bytes(text_b.slice(i, 1)), settings.words)[0]
                shared = len(np.intersect1d(own, pivot_set, assume_unique=True))
                linked[i] = 100 * shared >= settings.percent * (len(own) + len(pivot_set) - shared)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(tidy(compare), "a long, b long")


def fine_sketches(texts: DataFrame, settings: Settings) -> DataFrame:
    """(node, fine) of `texts` (node, text)."""
    seeds = _seeds(settings.collections * settings.rows + SKETCHED + FINE)[-FINE:]

    def sign(batches):
        for batch in batches:
            sets = text_shingles(*text_bytes(arrow_column(batch, "text")), settings.words)
            fine = [sketch_of(minhashes(s, seeds)).view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([arrow_column(batch, "node"), pa.array(fine, pa.list_(pa.int64()))], ["node", "fine"])

    return texts.select("node", "text").mapInArrow(tidy(sign), "node long, fine array<long>")


def _close(a: str, b: str, hashed: int, settings: Settings) -> str:
    """SQL: the sketches a and b do not rule a link out."""
    bits = " + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(hashed // 16))
    return f"{bits} <= {most_distance(settings.percent, hashed)}"


def _pivot_pairs(members: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): each member of a bucket with the smallest one."""
    pivots = members.groupBy("key").agg(F.min("node").alias("b"))
    pairs = members.join(pivots.hint("merge"), "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    sketched = nodes.select("node", "sketch")
    x, y = sketched.alias("x").hint("merge"), sketched.alias("y").hint("merge")
    near = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
    return near.where(_close("x.sketch", "y.sketch", SKETCHED, settings)).select("a", "b")


def _open_members(members: DataFrame) -> DataFrame:
    """Members (key, node, component) of buckets that hold several components, with the smallest one as `low`."""
    several = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return members.join(several.where("low < high").select("key", "low").hint("merge"), "key")


def _rest_pairs(opened: DataFrame, nodes: DataFrame, fine: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): what may still be linked in open buckets.

    a lies outside the component of its bucket's smallest component, b in any other than a's. A pair is formed in
    the first table that holds both, which their collection hashes tell.
    """
    opened = opened.join(nodes.select("node", "hashes", "sketch").hint("merge"), "node").join(fine.hint("merge"), "node")
    n = settings.collections
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    earlier = [sum(1 << c for c in range(j) if c != i) for i, j in pairs]
    masks = f"array({', '.join(map(str, earlier))})"
    agreeing = " + ".join(f"IF(x.hashes[{c}] = y.hashes[{c}], {1 << c}, 0)" for c in range(n))
    condition = f"""x.key = y.key AND x.component <> y.component AND (y.component = x.low OR x.node < y.node)
        AND ({agreeing}) & x.earlier = 0 AND {_close("x.sketch", "y.sketch", SKETCHED, settings)}
        AND {_close("x.fine", "y.fine", FINE, settings)}"""
    x = opened.where("component <> low").withColumn("earlier", F.expr(f"{masks}[int(key & 255)]"))
    found = x.alias("x").join(opened.alias("y"), F.expr(condition))
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def near_duplicates(
    docs: DataFrame, keep: Scratch, settings: Settings | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id (the smallest id that links reach), kept.

    Null, empty and wordless texts have an empty set and are linked with nothing. Rows without an id are kept and
    have no component. Rows that share an id are one document: one of their texts is searched for links, and all
    get its component. Other columns are not read. An empty table gives no rows. Intermediate tables go to
    `keep`; the result is lazy and reads them.
    """
    settings = settings or Settings()
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = keep(signatures(docs, settings), "signatures")
    named = signed.where("digest is not null and doc_id is not null")
    classes = keep(
        named.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first(F.struct("hashes", "sketch")).alias("of")),
        "classes",
    )
    one = F.min_by(F.struct("digest", "of.hashes", "of.sketch"), "digest").alias("x")
    nodes = keep(classes.groupBy("node").agg(one).select("node", "x.*"), "nodes")

    rows = bucket_rows(nodes)
    shared = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = keep(rows.join(shared.select("key").hint("merge"), "key"), "members")

    # one text for each node of an open bucket; rows of a repeated id that hold another set fall away
    wanted = members.select("node").distinct().join(nodes.select("node", "digest").hint("merge"), "node")
    found = docs.join(wanted.hint("merge"), docs["doc_id"] == wanted["node"]).select("node", "digest", "text")

    def same_set(batches):
        for batch in batches:
            sets = text_shingles(*text_bytes(arrow_column(batch, "text")), settings.words)
            digests = arrow_column(batch, "digest").to_pylist()
            same = pa.array([set_digest(s) == d for s, d in zip(sets, digests, strict=True)], pa.bool_())
            yield batch.select(["node", "text"]).filter(same)

    texts = keep(found.mapInArrow(tidy(same_set), "node long, text string").dropDuplicates(["node"]), "texts")

    first = keep(confirmed(keep(_pivot_pairs(members, nodes, settings), "first-pairs"), texts, settings), "first-links")
    labels = components(first)
    known = labels.select("node", "component")
    labelled = members.join(known.hint("merge"), "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    opened = keep(_open_members(labelled), "open-members")
    fine = keep(fine_sketches(texts.join(opened.select("node").distinct().hint("merge"), "node"), settings), "fine-sketches")
    rest = keep(_rest_pairs(opened, nodes, fine, settings), "rest-pairs")
    more = keep(confirmed(rest, texts, settings), "rest-links")
    labels = components(first.unionByName(more))

    by_digest = classes.select("digest", "node")
    result = signed.select("doc_id", "n_shingles", "digest").join(by_digest.hint("merge"), "digest", "left")
    result = result.join(cut_lineage(labels).hint("merge"), "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return result.select(
        F.col("doc_id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
