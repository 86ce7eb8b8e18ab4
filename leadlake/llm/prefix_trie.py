"""Prefix trie of conversations in a node table with minimal perfect hashing.

Every prefix of a conversation has a digest: a polynomial of its turns' digests, modulo a prime. Shards of
conversations list their different prefix digests, give each a slot by a minimal perfect hash (and verify that no
other digest stands there), scatter counts into flat arrays, and add up subtrees through an array of parent slots,
the deepest first. Shards need not hold whole subtrees: what they have counted for one node is added up in Spark, so
a first turn that a third of all conversations share is some rows of each shard.

A polynomial can be computed in pieces. So turns are sorted over the whole table, conversations may lie in several
tasks, and no conversation, however long, is held by one. Deep conversations are cut into bands of turns as well:
subtrees are added up within bands, then between the bands' topmost nodes, by the same function.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import Scratch, arrow_column, tidy
from leadlake.llm.words import FACTOR, mixed

#: The polynomial's prime and base.
PRIME, BASE = (1 << 127) - 1, 0x5D588B656C0780BB9F1A2C6B27B3C4D1
#: Key of the empty prefix.
ROOT = bytes(16)


@dataclass(frozen=True)
class Settings:
    #: A conversation takes up to `borrowed` - 1 first turns of the one whose number is the next lower multiple of
    #: `family`.
    family: int = 20
    borrowed: int = 4
    #: Prefixes of a shard, about, and depths of a band.
    shard_rows: int = 200_000
    band: int = 4096


# ---------------------------------------------------------------- polynomials of turns


def _number(digest: bytes) -> int:
    return 1 + int.from_bytes(digest[:15], "big")


def _key(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _value(key: bytes) -> int:
    return int.from_bytes(key, "big")


class Powers(dict):
    """BASE to the n, also below 0. The first ones are remembered."""

    def __missing__(self, n: int) -> int:
        value = pow(BASE, n, PRIME)
        if abs(n) < 1 << 16:
            self[n] = value
        return value


def turn_digests(chats: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of `chats` (conv_id, turn, role, text); null role or text is empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = chats.where("conv_id is not null")
    return rows.select(F.col("conv_id").cast("long"), "turn", F.unhex(F.sha2(framed, 256)).alias("digest"), words.alias("words"))


def own_prefixes(turns: DataFrame, keep: Scratch) -> DataFrame:
    """(conv_id, pos, value, digest, words): each turn's place, from 1, and the polynomial of the turns up to it.

    Turns are sorted over the whole table by conversation, turn and digest. A task numbers and adds up what it
    holds; the share that earlier tasks hold of its first conversation is put before that. One row a task reaches
    the driver.
    """
    ordered = turns.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "digest")
    ordered = ordered.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest")

    def run(batches):
        part, now, pos, total, powers = TaskContext.get().partitionId(), None, 0, 0, Powers()
        for batch in batches:
            places, values = [], []
            for conv, digest in zip(arrow_column(batch, "conv_id").to_pylist(), arrow_column(batch, "digest").to_pylist(), strict=True):
                if conv != now:
                    now, pos, total = conv, 0, 0
                pos += 1
                total = (total + _number(digest) * powers[pos]) % PRIME
                places.append(pos)
                values.append(_key(total))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(batch), part, np.int32)),
                    arrow_column(batch, "conv_id"),
                    pa.array(places, pa.int64()),
                    pa.array(values, pa.binary()),
                    arrow_column(batch, "digest"),
                    arrow_column(batch, "words"),
                ],
                ["part", "conv_id", "pos", "value", "digest", "words"],
            )

    kinds = "part int, conv_id long, pos long, value binary, digest binary, words long"
    local = keep(ordered.select("conv_id", "digest", "words").mapInArrow(tidy(run), kinds), "local-prefixes")

    last = F.max(F.struct("conv_id", "pos", "value")).alias("last")
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"), last).orderBy("part").collect()
    carried, open_ = {}, (None, 0, 0)  # what tasks before this one hold of its first conversation
    powers = Powers()
    for row in ends:
        conv, pos, value = open_
        if row["first"] == conv:
            carried[row["part"]] = (conv, pos, value)
        conv, pos, value = row["last"]["conv_id"], row["last"]["pos"], _value(row["last"]["value"])
        if open_[0] == conv:
            value = (open_[2] + value * powers[open_[1]]) % PRIME
            pos += open_[1]
        open_ = (conv, pos, value)
    if not carried:
        return local.drop("part")
    shared = local.sparkSession.sparkContext.broadcast(carried)

    def shift(batches):
        powers = Powers()
        for batch in batches:
            parts, convs, places, values = (arrow_column(batch, c).to_pylist() for c in ("part", "conv_id", "pos", "value"))
            for i, part in enumerate(parts):
                before = shared.value.get(part)
                if before and before[0] == convs[i]:
                    places[i] += before[1]
                    values[i] = _key((before[2] + _value(values[i]) * powers[before[1]]) % PRIME)
            yield pa.RecordBatch.from_arrays(
                [arrow_column(batch, "conv_id"), pa.array(places, pa.int64()), pa.array(values, pa.binary()), arrow_column(batch, "digest"), arrow_column(batch, "words")],
                ["conv_id", "pos", "value", "digest", "words"],
            )

    return keep(local.mapInArrow(tidy(shift), kinds.removeprefix("part int, ")), "prefixes")


# ---------------------------------------------------------------- rebuilt conversations


def rebuilt_paths(chats: DataFrame, keep: Scratch, settings: Settings) -> DataFrame:
    """(conv_id, depth, key, parent, digest, words, ends): every prefix of every rebuilt conversation, the empty one
    included; `ends` marks the whole conversation.

    A conversation meets the few borrowed turns of its donor, one row; its own turns then meet that row by its
    number, where AQE splits a conversation that very many rows hold.
    """
    own = own_prefixes(turn_digests(chats), keep)
    turn = F.struct("pos", "value", "digest", "words")
    borrowable = F.collect_list(F.when(F.col("pos") < settings.borrowed, turn))  # null is not collected
    counted = keep(
        own.groupBy("conv_id").agg(F.max("pos").alias("n_own"), F.sort_array(borrowable).alias("head")), "conversations"
    )
    donor = (F.col("conv_id") - F.col("conv_id") % settings.family).alias("donor")
    checksum = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    donors = counted.select(F.col("conv_id").alias("donor"), F.col("head").alias("given"))
    convs = counted.select("*", donor, (checksum % settings.borrowed).cast("int").alias("h")).join(donors, "donor", "left")
    empty = F.expr("CAST(array() AS array<struct<pos: bigint, value: binary, digest: binary, words: bigint>>)")
    convs = convs.select(
        "conv_id",
        "h",
        F.slice(F.coalesce("given", empty), 1, F.col("h")).alias("given"),
        F.try_element_at("head", F.when(F.col("h") > 0, F.col("h")))["value"].alias("cut"),
        F.greatest(F.col("n_own") - F.col("h"), F.lit(0)).alias("kept"),
    )
    convs = keep(convs, "rebuilt")

    top = convs.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("words"),
        ((F.size("given") == 0) & (F.col("kept") == 0)).alias("ends"),
    )
    lent = convs.select("conv_id", "given", "kept", F.posexplode("given").alias("at", "turn")).select(
        "conv_id",
        F.col("turn.pos").alias("depth"),
        F.col("turn.value").alias("key"),
        F.when(F.col("at") == 0, F.lit(ROOT)).otherwise(F.col("given")[F.col("at") - 1]["value"]).alias("parent"),
        F.col("turn.digest").alias("digest"),
        F.col("turn.words").alias("words"),
        ((F.col("at") == F.size("given") - 1) & (F.col("kept") == 0)).alias("ends"),
    )
    base = F.coalesce(F.try_element_at("given", F.lit(-1))["value"], F.lit(ROOT))
    info = convs.where("kept > 0").select(
        "conv_id", "h", "kept", F.size("given").alias("t"), base.alias("base"), F.coalesce("cut", F.lit(ROOT)).alias("cut")
    )
    rest = own.join(info, "conv_id").where("pos > h")

    def rebuild(batches):
        powers = Powers()
        for batch in batches:
            columns = [arrow_column(batch, c).to_pylist() for c in ("pos", "value", "digest", "h", "t", "base", "cut")]
            depths, keys, parents = [], [], []
            for pos, value, digest, h, t, base, cut in zip(*columns, strict=True):
                moved = (_value(value) - _value(cut)) * powers[t - h]
                key = (_value(base) + moved) % PRIME
                depth = t + pos - h
                depths.append(depth)
                keys.append(_key(key))
                parents.append(_key((key - _number(digest) * powers[depth]) % PRIME))
            ends = [p - h == k for p, h, k in zip(columns[0], columns[3], arrow_column(batch, "kept").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    arrow_column(batch, "conv_id"),
                    pa.array(depths, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(parents, pa.binary()),
                    arrow_column(batch, "digest"),
                    arrow_column(batch, "words"),
                    pa.array(ends, pa.bool_()),
                ],
                ["conv_id", "depth", "key", "parent", "digest", "words", "ends"],
            )

    kinds = "conv_id long, depth long, key binary, parent binary, digest binary, words long, ends boolean"
    return keep(top.unionByName(lent).unionByName(rest.mapInArrow(tidy(rebuild), kinds)), "paths")


# ---------------------------------------------------------------- node tables


def _halves(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of 16 bytes as two numbers."""
    both = np.frombuffer(b"".join(keys.to_pylist()), np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


class SlotTable:
    """Slots 0 to n - 1 for n different digests, by a minimal perfect hash.

    Each level hashes the digests that are left into as many places. Those alone in their place stay there, others
    go to the next level. A digest's slot is the number of taken places before its own.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels, taken = [], 0
        left_high, left_low = high, low
        while len(left_high):
            places = len(left_high)
            at = self._places(left_high, left_low, len(self.levels), places)
            alone = np.bincount(at, minlength=places) == 1
            ranks = np.cumsum(alone) - 1 + taken
            self.levels.append((places, alone, ranks))
            taken += int(alone.sum())
            stay = ~alone[at]
            left_high, left_low = left_high[stay], left_low[stay]
            if len(self.levels) > 200:
                raise ValueError("equal digests can't be told apart")
        self.high, self.low = np.zeros(taken, np.uint64), np.zeros(taken, np.uint64)
        slots = self._find(high, low)
        self.high[slots], self.low[slots] = high, low

    @staticmethod
    def _places(high: np.ndarray, low: np.ndarray, level: int, places: int) -> np.ndarray:
        seed = np.uint64(FACTOR * (level + 1) % (1 << 64))
        hashed = mixed(high + seed) ^ mixed(low - seed)
        return (((mixed(hashed) >> np.uint64(32)) * np.uint64(places)) >> np.uint64(32)).astype(np.int64)

    def _find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        slots, open_ = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, (places, alone, ranks) in enumerate(self.levels):
            at = self._places(high[open_], low[open_], level, places)
            here = alone[at]
            slots[open_[here]] = ranks[at[here]]
            open_ = open_[~here]
        return slots

    def __len__(self) -> int:
        return len(self.high)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each digest, verified against the digest that stands there; -1 for unknown ones."""
        slots = self._find(high, low)
        wrong = (slots < 0) | (self.high[slots] != high) | (self.low[slots] != low) if len(self) else np.ones(len(high), bool)
        return np.where(wrong, -1, slots)


def _table_of(group: pa.Table) -> tuple[SlotTable, np.ndarray, np.ndarray]:
    """The node table of a shard's paths (key, parent), the slot of each row, and that of its parent or -1."""
    keys = group.column("key").combine_chunks()
    high, low = _halves(keys)
    both = np.unique(np.stack([high, low], axis=1), axis=0)
    table = SlotTable(both[:, 0], both[:, 1])
    slots = table.slots(high, low)
    parent_high, parent_low = _halves(group.column("parent").combine_chunks().fill_null(b"\xff" * 16))
    return table, slots, table.slots(parent_high, parent_low)


def _bytes_of(table: SlotTable, slots: np.ndarray) -> pa.Array:
    both = np.stack([table.high[slots], table.low[slots]], axis=1)
    return pa.array([row.tobytes() for row in both], pa.binary())


def _sharded(paths: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """Paths with the shard they go to: conversations by their number, and bands of depths."""
    shard = F.pmod(F.xxhash64("conv_id"), F.lit(shards)).alias("shard")
    return paths.select("*", shard, F.floor(F.col("depth") / settings.band).alias("span"))


def node_counts(paths: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """(key, depth, parent, words, conv_id, n_convs): one row a node. Digests of different prefixes that collide stop
    the job."""

    def count(group: pa.Table) -> pa.Table:
        table, slots, _ = _table_of(group)
        convs = group.column("conv_id").to_numpy()
        members = np.bincount(slots, minlength=len(table))
        least = np.full(len(table), np.iinfo(np.int64).max)
        np.minimum.at(least, slots, convs)
        row = np.zeros(len(table), np.int64)
        row[slots] = np.arange(len(slots))  # any row of the node: key, parent, digest and depth are its own
        one = group.select(["key", "depth", "parent", "digest", "words"]).take(pa.array(row))
        same = pa.array(slots)
        for name in ("parent", "digest", "depth"):
            if not one.column(name).take(same).equals(group.column(name)):
                raise ValueError(f"two prefixes have one digest ({name})")
        return one.append_column("conv_id", pa.array(least)).append_column("n_convs", pa.array(members, pa.int64()))

    kinds = "key binary, depth long, parent binary, digest binary, words long, conv_id long, n_convs long"
    rows = _sharded(paths.select("conv_id", "key", "depth", "parent", "digest", "words"), shards, settings)
    partial = rows.groupBy("shard", "span").applyInArrow(lambda t: count(t.select(["conv_id", "key", "depth", "parent", "digest", "words"])), kinds)
    same = [F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"one_{c}") for c in ("depth", "parent", "digest")]
    ends = [F.min(c).alias(c) for c in ("depth", "parent", "words", "conv_id")]
    nodes = partial.groupBy("key").agg(*ends, F.sum("n_convs").alias("n_convs"), *same)
    sure = F.when(F.col("one_depth") & F.col("one_parent") & F.col("one_digest"), F.col("n_convs"))
    raised = F.coalesce(sure, F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    return nodes.select("key", "depth", "parent", "words", "conv_id", raised.alias("n_convs"))


def _added_up(paths: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """(key, leaves, saved): sums over each node's subtree, as far as its band reaches.

    `paths` (conv_id, depth, key, parent, leaves, saved): a node's own numbers stand in one of its rows, others have
    0. A shard adds the numbers of its nodes to their ancestors, all of which it holds down from the band's top.
    """

    def add(group: pa.Table) -> pa.Table:
        table, slots, parents = _table_of(group)
        depth, up = np.zeros(len(table), np.int64), np.full(len(table), -1)
        depth[slots], up[slots] = group.column("depth").to_numpy(), parents
        sums = {name: np.zeros(len(table), np.int64) for name in ("leaves", "saved")}
        for name, total in sums.items():
            np.add.at(total, slots, group.column(name).to_numpy())
        order = np.argsort(-depth, kind="stable")
        edges = np.flatnonzero(np.diff(-depth[order])) + 1
        for level in np.split(order, edges):  # the deepest first
            inner = level[up[level] >= 0]
            for total in sums.values():
                np.add.at(total, up[inner], total[inner])
        some = np.flatnonzero((sums["leaves"] != 0) | (sums["saved"] != 0))
        return pa.table({"key": _bytes_of(table, some), **{name: total[some] for name, total in sums.items()}})

    columns = ["conv_id", "depth", "key", "parent", "leaves", "saved"]
    rows = _sharded(paths.select(columns), shards, settings)
    partial = rows.groupBy("shard", "span").applyInArrow(lambda t: add(t.select(columns)), "key binary, leaves long, saved long")
    return partial.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def subtree_sums(paths: DataFrame, keep: Scratch, shards: int, settings: Settings, level: int = 0) -> DataFrame:
    """(key, leaves, saved): sums over each node's whole subtree; nodes with none may be left out.

    Where paths are deeper than a band, the topmost nodes of bands form a trie of their own, whose sums are found
    first, in the same way, and then counted as numbers of the nodes above them.
    """
    if (paths.agg(F.max("depth")).first()[0] or 0) < settings.band:
        return _added_up(paths, shards, settings)
    sums = _added_up(paths, shards, settings)
    tops = paths.where(F.col("depth") % settings.band == 0)
    above = tops.select("conv_id", (F.col("depth") + settings.band).alias("depth"), F.col("key").alias("above"))
    # each top with the top of the band above on the same path; its sums stand in one of its rows, the owner's
    owner = tops.groupBy("key").agg(F.min("conv_id").alias("conv_id")).join(sums, "key")
    upper = tops.select("conv_id", "depth", "key").join(above, ["conv_id", "depth"], "left").join(owner, ["key", "conv_id"], "left")
    upper = upper.select(
        "conv_id",
        (F.col("depth") / settings.band).cast("long").alias("depth"),
        "key",
        F.col("above").alias("parent"),
        F.coalesce("leaves", F.lit(0)).alias("leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    upper = keep(upper, f"tops-{level}")
    full = subtree_sums(upper, keep, shards, settings, level + 1)
    # below a band lies what the tops of the next one hold: it counts as the number of their parents
    edge = tops.where("depth > 0").select("key", "parent").distinct()
    below = edge.join(full, "key").groupBy(F.col("parent").alias("key"))
    below = below.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    lowest = paths.where(F.col("depth") % settings.band == settings.band - 1)
    held = lowest.groupBy("key").agg(F.min("conv_id").alias("conv_id")).join(below, "key")
    more = paths.join(held, ["key", "conv_id"], "left").select(
        "conv_id",
        "depth",
        "key",
        "parent",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
    )
    return _added_up(keep(more, f"band-sums-{level}"), shards, settings)


# ---------------------------------------------------------------- conversations that end at a node

#: Numbers that are joined to one text before they are hashed.
JOINED = 4096


def _end_digests(paths: DataFrame) -> DataFrame:
    """(key, ends_sha256) of nodes where conversations end.

    The numbers are sorted over all tasks and joined to texts of some thousands; the texts of one node then pass one
    hash in order, as a stream: SHA-256 can't be computed in pieces, but no task holds a node's numbers.
    """
    ends = paths.where("ends").select("key", "conv_id")
    ordered = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def join(batches):
        now, numbers = None, []

        def sent():
            joined = ",".join(map(str, numbers))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([numbers[0]], pa.int64()), pa.array([joined])], ["key", "first", "joined"])

        for batch in batches:
            for key, conv in zip(arrow_column(batch, "key").to_pylist(), arrow_column(batch, "conv_id").to_pylist(), strict=True):
                if numbers and (key != now or len(numbers) == JOINED):
                    yield sent()
                    numbers = []
                now = key
                numbers.append(conv)
        if numbers:
            yield sent()

    def digest(batches):
        now, state, keys, digests = None, None, [], []
        for batch in batches:
            for key, joined in zip(arrow_column(batch, "key").to_pylist(), arrow_column(batch, "joined").to_pylist(), strict=True):
                if key != now:
                    if state is not None:
                        keys.append(now)
                        digests.append(state.hexdigest())
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(joined.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
            keys, digests = [], []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    texts = ordered.mapInArrow(tidy(join), "key binary, first long, joined string")
    placed = texts.repartition("key").sortWithinPartitions("key", "first").select("key", "joined")
    return placed.mapInArrow(tidy(digest), "key binary, ends_sha256 string")


# ---------------------------------------------------------------- the trie


def trie(chats: DataFrame, keep: Scratch, settings: Settings | None = None) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    `chats` (conv_id, turn, role, text): turns are ordered by turn, null first, equal ones by the digest of role and
    text, so repeated rows are turns like any other. Null roles and texts are empty ones. Rows without a conv_id
    belong to no conversation and are left out. A negative number's donor is the next multiple towards zero, as SQL's
    remainder has it. Other columns are not read. An empty table gives no rows, also no root. Intermediate tables go
    to `keep`; the result is lazy and reads them.
    """
    settings = settings or Settings()
    paths = rebuilt_paths(chats.select("conv_id", "turn", "role", "text"), keep, settings)
    shards = max(1, -(-paths.count() // settings.shard_rows))
    nodes = keep(node_counts(paths, shards, settings), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = keep(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "nodes-with-children")

    own = nodes.select(
        "key",
        "conv_id",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    valued = paths.select("conv_id", "depth", "key", "parent").join(own, ["key", "conv_id"], "left")
    valued = keep(valued.fillna(0, ["leaves", "saved"]), "valued-paths")
    sums = subtree_sums(valued, keep, shards, settings)

    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, "key", "left").join(_end_digests(paths), "key", "left").join(above, "parent", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("leaves", F.lit(0).cast("long")).alias("n_leaves"),
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
