"""Quality rules: a hashed n-gram log-likelihood ratio of trusted texts to the raw corpus.

Every word, every pair of neighbouring words, and every word's last characters, which show endings, punctuation and
markup, fall into buckets by hash, each kind of n-gram into buckets of its own. Two multinomials over all buckets are
counted: of the trusted documents and of all. A document's score is the mean over its n-grams of
log p(bucket | trusted) / p(bucket | raw), so length does not matter, and it is kept if the score reaches a fixed
threshold and no base rule fails. There is no drawing of lots. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that separate words, and those that count as symbols.
BLANKS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"


@dataclass(frozen=True)
class Settings:
    #: Longest n-gram of words that counts beside the endings (1: words, 2: pairs as well, 0: endings alone).
    words: int = 0
    #: Characters of a word's ending, and buckets that each kind of n-gram is hashed to (a power of two).
    ending: int = 3
    buckets: int = 1 << 16
    #: Pseudo-count of each bucket in the raw multinomial; the trusted one gets its share of it.
    smoothing: float = 1.0
    #: Least mean log ratio: below it a document's n-grams are e times rarer in trusted texts than in the corpus.
    threshold: float = -1.0
    #: Base rules: least words, and most words in repeated 3-word windows, in percent.
    least_words: int = 50
    most_repeated: int = 50

    @property
    def all_buckets(self) -> int:
        return (1 + self.words) * self.buckets


#: The settings of `judge` and `keep_good`: endings, words and pairs of words.
N_GRAMS = Settings(words=2)


def once(value: Column, use) -> Column:
    """`use(value)` with `value` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text) -> Column:
    """Array of words; empty for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def bucket_of(word: Column, settings: Settings) -> Column:
    start = F.greatest(F.length(word) - settings.ending, F.lit(0)) + 1
    return F.xxhash64(F.substr(word, start)).bitwiseAND(F.lit(settings.buckets - 1)).cast("int")


def starts_of(words: Column, settings: Settings) -> Column:
    """Array with a struct for each word: the word and those after it that its longest n-gram holds, else null."""
    after = [F.slice(words, 1 + k, F.size(words)).alias(f"w{k}") for k in range(1, settings.words)]
    return F.arrays_zip(words.alias("w0"), *after)


def grams_at(start: str, settings: Settings) -> list[Column]:
    """Buckets of the n-grams that begin with a word: its ending, the word, the pair and so on; null at the end."""
    words = [F.col(f"{start}.w{k}") for k in range(max(1, settings.words))]
    found = [bucket_of(words[0], settings)]
    for n in range(1, settings.words + 1):
        hashed = F.xxhash64(*words[:n]).bitwiseAND(F.lit(settings.buckets - 1)).cast("int") + n * settings.buckets
        found.append(F.when(words[n - 1].isNotNull(), hashed))
    return found


def n_grams(n_words: Column, settings: Settings) -> Column:
    """Number of n-grams in a text of so many words."""
    return sum((F.greatest(n_words - k, F.lit(0)) for k in range(settings.words)), n_words)


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Windows are compared by 64-bit hashes. Where some are
    equal, hashes are sorted with their places, equal neighbours give the places, and sorted places the words they
    cover."""
    hash_at = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), hash_at)
    placed = lambda hs: F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    again = lambda all_: F.transform(
        F.filter(
            all_,
            lambda x, i: (x.h == F.get(all_, i - 1).h).eqNullSafe(True) | (x.h == F.get(all_, i + 1).h).eqNullSafe(True),
        ),
        lambda x: x["at"],
    )
    covered = lambda at: F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct((s.n + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")),
    )["n"]
    count = lambda hs: once(placed(hs), lambda all_: once(F.sort_array(again(all_)), covered))
    found = once(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) < F.size(hs), count(hs)).otherwise(0))
    return F.when(F.size(words) >= 3, found).otherwise(0).cast("long")


def base_counts(text: Column, words: Column) -> dict[str, Column]:
    """The counts that base rules and reports use."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": once(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
        "n_repeat_words": _repeated_words(words),
    }


def ratio_table(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """One row: the log ratio of every bucket, as an array. All n-grams of all documents are counted, and all of the
    trusted ones; each task adds up its buckets first, so no more than `all_buckets` rows leave it.

    Trusted ids grow with the corpus, so both sides are shuffled at every size. A document sends its text, which takes
    less room than the buckets of its n-grams.
    """
    ids = trusted.select(F.col(id_col).alias("trusted_id")).where("trusted_id is not null").distinct()
    sent = docs.select(F.col(id_col).alias("sent_id"), F.col(text_col).alias("sent_text"))
    marked = sent.join(ids.hint("merge"), F.col("sent_id") == F.col("trusted_id"), "left").select(
        F.col("trusted_id").isNotNull().cast("long").alias("of_trusted"), words_of(F.col("sent_text")).alias("words")
    )
    starts = marked.select("of_trusted", F.explode(starts_of(F.col("words"), settings)).alias("start"))
    each = starts.select("of_trusted", F.explode(F.array(*grams_at("start", settings))).alias("bucket"))
    counts = each.where("bucket is not null").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("of_trusted").alias("trusted")
    )
    # all at most `all_buckets` counts in one row beside their totals, so texts are read once
    together = counts.agg(
        F.sum("raw").alias("raw_all"),
        F.sum("trusted").alias("trusted_all"),
        F.collect_list(F.struct("bucket", "raw", "trusted")).alias("counts"),
    )
    a, size = settings.smoothing, settings.all_buckets
    share = F.col("trusted_all") / F.col("raw_all")
    ratio = F.log(
        (F.col("trusted") + a * share) / (F.col("trusted_all") + a * size * share)
    ) - F.log((F.col("raw") + a) / (F.col("raw_all") + a * size))
    ratio = F.when(F.col("trusted_all") > 0, ratio).otherwise(0.0)
    rated = together.select("raw_all", "trusted_all", F.inline("counts")).select("bucket", ratio.alias("ratio"))
    every = docs.sparkSession.range(size, numPartitions=1).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(rated, "bucket", "left").select("bucket", F.coalesce("ratio", F.lit(0.0)).alias("ratio"))
    in_order = F.array_sort(F.collect_list(F.struct("bucket", "ratio")))
    return filled.agg(F.transform(in_order, lambda x: x.ratio).alias("ratios"))


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_digest: bool = False,
) -> DataFrame:
    """Per row of `docs`: id, the counts, base_failed, score, kept. `trusted` (id_col) lists trusted documents.

    Null, empty and wordless texts have no words, score 0, and fail the base rules. Without trusted documents
    every score is 0. Repeated rows are judged and counted each; null ids stay null and are never trusted; other
    columns are not read. An empty table gives no rows. A document's n-grams are added up in the task that reads
    it, so one row a document is shuffled; the task's map is keyed by the row alone, as it is looked up for each word. `with_digest` adds the SHA-256 of the text.
    """
    settings = settings or N_GRAMS
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    listed = trusted.select(F.col(id_col).alias("doc_id"))
    ratios = ratio_table(own, listed, "doc_id", "text", settings).select("ratios").scalar()
    split = own.select("doc_id", "text", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words"))
    counts = base_counts(F.col("text"), F.col("words"))
    if with_digest:
        counts["digest"] = F.sha2("text", 256)
    counted = split.select("doc_id", "row", "words", *[c.alias(n) for n, c in counts.items()])
    known = ["doc_id", *counts]
    each = counted.select("row", *known, F.explode_outer(starts_of(F.col("words"), settings)).alias("start"))
    # a text without words has one row without a word
    rated = [F.coalesce(F.get(ratios, bucket), F.lit(0.0)) for bucket in grams_at("start", settings)]
    ratio = F.when(F.col("start").isNotNull(), sum(rated[1:], rated[0]))
    # texts among the columns are keys, as a map's values have to be of fixed width
    wide = [c for c, kind in each.dtypes if c in known and kind in ("string", "binary")]
    fixed = [F.first(c).alias(c) for c in known if c not in wide]
    summed = each.groupBy("row", *wide).agg(F.sum(ratio).alias("total"), *fixed)
    failed = (F.col("n_words") < settings.least_words) | (
        100 * F.col("n_repeat_words") > settings.most_repeated * F.col("n_words")
    )
    scored = summed.select(
        F.col("doc_id").alias(id_col),
        *counts,
        (F.coalesce("total", F.lit(0.0)) / F.greatest(n_grams(F.col("n_words"), settings), F.lit(1))).alias("score"),
        failed.alias("base_failed"),
    )
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= settings.threshold))


def keep_good(
    docs: DataFrame,
    trusted: DataFrame,
    settings: Settings | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with all their columns.

    A verdict depends on the text alone, so rows are found again by the digest of their text. Null texts go. The
    digests are as many as the texts kept and take more room than Spark counts for them, so both sides are shuffled.
    """
    judged = judge(docs, trusted, settings, id_col=id_col, text_col=text_col, with_digest=True)
    good = judged.where("kept").select(F.col("digest").alias("good_digest")).distinct()
    return docs.join(good.hint("merge"), F.sha2(docs[text_col], 256) == good["good_digest"], "left_semi")
