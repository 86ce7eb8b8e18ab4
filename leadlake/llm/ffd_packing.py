"""Packing of tokenised documents by first-fit decreasing, in randomised groups.

A document's ids, with an end id, are cut into pieces of at most one sequence. Pieces are dealt at random into
groups of bounded size; each group is packed by itself, longest piece first, into the first sequence with room.
A tournament tree over the room of each sequence finds that one in logarithmic time.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.bpe_count import byte_names
from leadlake.llm.common import Scratch, arrow_column, tidy

#: Words that a task remembers with their ids, and their greatest length.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64
#: Characters of a text that are tokenised at once.
SLICE = 1 << 20


#: Words of ASCII and Latin-1 letters only.
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Words of such letters, digits and ASCII marks, but apostrophes and what may begin a special token; and their runs.
MIXED = re.compile(r"(?:[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:;=-@\[-`{-~]|<(?!\|))+").fullmatch
RUNS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+").findall
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal", "ids"]


@dataclass(frozen=True)
class Settings:
    sequence: int = 4096
    end_id: int = 2
    #: Pieces in a group, about.
    group_pieces: int = 20_000
    seed: int = 0


class Ids(dict):
    """Ids of words as little-endian 32-bit numbers, for a tokenizer that drops white space.

    Such a tokenizer takes each stretch between blanks by itself, so the ids of a text are those of its stretches.
    Words met lately are remembered: when the memory is full it becomes the old one, of which words that come
    again are taken over.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.old: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize, self.names = self.tokenizer.model.tokenize, byte_names()
        #: Whether words of Latin letters may go to the model straight away: tried on some.
        self.direct = self.cuts = False
        self.direct = all(self.letters(w) == self.whole(w) for w in ("The", "ZEBRAS", "élan", "Straße", "qxzjÿÀþ"))
        #: Whether it cuts between letters, digits and runs of marks, and between digits: tried on some. No added token
        #: may lie in such a word.
        tried = ("end.", "End.%%%", "É!!", '"(so)', "a1b22c", "1,000.5", "x--y_z", "ne...", "<b>it</b>", "a@b.co/~c", "[`{^}|]+=")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.cuts = not any(MIXED(t.content) for t in added) and all(
            b"".join(map(self.whole, RUNS(w))) == self.whole(w) for w in tried
        )

    def whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def letters(self, word: str) -> bytes:
        """Of a word of Latin letters: no normalisation but case, and no cut inside."""
        low = word.lower()
        if low != word and self.direct:
            return self[low]
        mapped = low if low.isascii() else "".join([self.names[b] for b in low.encode("utf-8")])
        return array("I", [t.id for t in self.tokenize(mapped)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            # between an ASCII letter and a full stop or comma every word pattern of this kind cuts
            if word[-1] in ".," and len(word) > 1 and word[-2].isascii() and word[-2].isalpha():
                ids = self[word[:-1]] + self[word[-1]]
            elif self.direct and (word.isascii() and word.isalpha() or LATIN(word)):
                ids = self.letters(word)
            elif self.cuts and MIXED(word) and len(runs := RUNS(word)) > 1:
                ids = b"".join(map(self.__getitem__, runs))
            else:
                ids = self.whole(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
                self[""] = b""
            self[word] = ids
        return ids

    def of(self, text: str) -> Iterator[bytes]:
        """Ids of a text, slice by slice."""
        begin = 0
        while begin < len(text):
            end = len(text)
            if end - begin > SLICE:
                end = text.rfind(" ", begin, begin + SLICE) + 1
                end = end if end > begin else (text.find(" ", begin) + 1 or len(text))
            some = text[begin:end]
            for blank in "\n\t\r":
                some = some.replace(blank, " ")
            yield b"".join(map(self.__getitem__, some.split(" ")))
            begin = end


def cut_pieces(slices: Iterator[bytes], settings: Settings) -> Iterator[bytes]:
    """Full sequences of ids, and the rest with the end id."""
    size, held = 4 * settings.sequence, bytearray()
    for some in slices:
        held += some
        while len(held) > size:  # a full one stays held, as an end id is still to come
            yield bytes(held[:size])
            del held[:size]
    held += np.array([settings.end_id], "<u4").tobytes()
    while held:
        yield bytes(held[:size])
        del held[:size]


def pieces_of(
    docs: DataFrame, tokenizer: str, settings: Settings, *, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, deal, ids): the pieces of every row of `docs`.

    `deal` is a random number fixed by the seed, the task and the row's place in it."""
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        ids, n, task = Ids(shared.value), 0, TaskContext.get().partitionId()
        for batch in batches:
            made, rows = [], []
            for row, text in enumerate(arrow_column(batch, "text")):
                n += 1
                deal, start, first = zlib.crc32(f"{settings.seed}/{task}/{n}".encode()), 0, len(made)
                for piece in cut_pieces(ids.of(text.as_py() or ""), settings):
                    made.append([start, len(piece) // 4, zlib.crc32(piece), 0, deal, piece if with_ids else None])
                    rows.append(row)
                    start += len(piece) // 4
                for piece in made[first:]:
                    piece[3] = start
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)] if made else []
            if columns:
                doc_ids = arrow_column(batch, "doc_id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([doc_ids, *columns], PIECE)

    return rows.mapInArrow(
        tidy(cut), f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, deal long, ids binary"
    )


class Tournament:
    """Winner tree over the room of sequences: each node holds the most room below it."""

    def __init__(self, sequences: int, room: int):
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def first_with(self, size: int) -> int:
        """The first sequence with room for `size`; there is always one."""
        node = 1
        while node < self.leaves:
            node *= 2
            if self.most[node] < size:
                node += 1
        return node - self.leaves

    def fill(self, sequence: int, size: int) -> int:
        """Take the room; returns what was free."""
        node = sequence + self.leaves
        free = self.most[node]
        self.most[node] = free - size
        while node > 1:
            node //= 2
            better = max(self.most[2 * node], self.most[2 * node + 1])
            if self.most[node] == better:
                break
            self.most[node] = better
        return free


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece. Equal sizes go in the order given."""
    tree = Tournament(len(sizes), room)
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        sequence[i] = at = tree.first_with(size)
        offset[i] = room - tree.fill(at, size)
    return sequence, offset


def pack(
    docs: DataFrame,
    tokenizer: str,
    keep: Scratch,
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    `tokenizer` is the path of a definition that the tokenizers library reads; it must drop white space. Null and
    empty texts are one piece of the end id. Repeated rows are packed each by itself; null ids stay null; other
    columns are not read. An empty table gives no rows. Pieces are written once to `keep` before they are dealt,
    so a repeated task can't deal them anew; the result is lazy and reads them. Groups hold about the same number
    of pieces whatever the ids or texts, and only lengths are shuffled unless ids are asked for.
    """
    settings = settings or Settings()
    pieces = keep(
        pieces_of(docs, tokenizer, settings, id_col=id_col, text_col=text_col, with_ids=with_ids), "pieces"
    )
    groups = max(1, round(pieces.count() / settings.group_pieces))
    if not with_ids:
        pieces = pieces.drop("ids")
    fields = [f for f in pieces.schema.fields if f.name != "deal"]

    def pack_group(rows: pa.Table) -> pa.Table:
        sequence, offset = first_fit_decreasing(rows.column("length").to_numpy(), settings.sequence)
        group = rows.column("group")[0].as_py()
        rows = rows.select([f.name for f in fields])
        rows = rows.append_column("sequence_id", pa.array(sequence + (group << 32), pa.int64()))
        return rows.append_column("offset", pa.array(offset, pa.int64()))

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("deal", "start"), F.lit(groups)))
    schema = pieces.drop("deal").schema.add("sequence_id", "long").add("offset", "long")
    packed = dealt.drop("deal").groupBy("group").applyInArrow(pack_group, schema)
    return packed.withColumnRenamed("doc_id", id_col)


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets) from a result of `pack` with ids: ids of the pieces in order, packed as
    little-endian 32-bit numbers. A sequence is at most 16 KB, so each is one small row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", F.col(id_col).alias("id"))))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p.ids))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            joined.alias("ids"),
            F.transform("parts", lambda p: p.id).alias("doc_ids"),
            F.transform("parts", lambda p: p.offset).alias("offsets"),
        )
    )
