"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are made.

A word's bytes form a linked list. A heap holds its adjacent pairs by merge rank; the lowest is popped, merged,
and the two new neighbours pushed, until no pair has a rank: O(n log n) for a word of n bytes. The count is the
number of initial symbols minus the number of merges. A text is cut into words by the vocabulary's pattern.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import arrow_column, tidy

#: Fixed value: the word pattern of this family of byte-level vocabularies.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a task remembers, and their greatest length; the memory is emptied when it is full.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64
#: Characters of a text whose words are listed at once; longer texts are walked word by word.
LISTED_CHARS = 1 << 20


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printable, else
    the next free one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """Merge ranks by pair, and the strings that count as one token wherever they occur."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in content["model"]["merges"]]
    return {
        "ranks": {pair: rank for rank, pair in enumerate(pairs)},
        "special": [t["content"] for t in content["added_tokens"]],
    }


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left when no adjacent pair has a rank. Of equal ranks the leftmost pair merges first."""
    end = len(symbols)
    left, right = list(range(-1, end - 1)), list(range(1, end + 1))
    heap = [
        (rank, i) for i in range(end - 1) if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None
    ]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = right[i]
        if symbols[i] is None or j >= end or ranks.get((symbols[i], symbols[j])) != rank:
            continue  # one of the two has changed since the pair was pushed
        symbols[i] += symbols[j]
        symbols[j] = None
        right[i] = k = right[j]
        merges += 1
        if k < end:
            left[k] = i
            if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (rank, i))
        h = left[i]
        if h >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (rank, h))
    return end - merges


class Counter(dict):
    """Counts of words seen, by word; `tokens` counts a text."""

    def __init__(self, vocabulary: dict):
        super().__init__()
        self.ranks = vocabulary["ranks"]
        self.names = byte_names()
        self.words = regex.compile(WORD_PATTERN)
        special = sorted(vocabulary["special"], key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def __missing__(self, word: str) -> int:
        count = merged_count([self.names[b] for b in word.encode("utf-8")], self.ranks)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count

    def tokens(self, text: str) -> int:
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def plain(self, text: str) -> int:
        if len(text) <= LISTED_CHARS:
            return sum(map(self.__getitem__, self.words.findall(text)))
        return sum(self[m.group()] for m in self.words.finditer(text))


def count_tokens(
    docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """Per row of `docs`: its id, UTF-8 bytes, tokens, and whether it has more than `limit` tokens.

    `vocabulary` is the path of a byte-level BPE file; its merges (some 50,000, fixed by the file) are broadcast.
    Null and empty texts have no bytes and no tokens. Repeated rows and null ids are rows like any other; other
    columns are not read. Whole texts are counted; of a long one only the current word is copied.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        counter = Counter(shared.value)
        for batch in batches:
            texts = [t or "" for t in arrow_column(batch, "text").to_pylist()]
            sizes = [len(t) if t.isascii() else len(t.encode("utf-8")) for t in texts]
            tokens = [counter.tokens(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [arrow_column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(tidy(count), f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("doc_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
