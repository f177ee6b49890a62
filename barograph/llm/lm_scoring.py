"""Cross-entropy difference: how much closer a text is to a target corpus than to the background.

Two bigram models share one vocabulary, one order and one smoothing: all words and all pairs of
neighbouring words that occur often enough in all documents, counted in the target and in the
background. The tables grow with the corpus. They are matched: the background is scaled to the size
of the target, so that neither is sharper only because it saw more, and both lean on their words,
and those on the shared words, by the same weights. Each token of a text has a loss under both; the
mean difference is the score, lower being closer to the target.

Words are counted as 64-bit hashes. Tables up to a bound are sent to the tasks as sorted arrays; larger
ones are joined with the pairs of every document, which are added up per document before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import by_batch, documents, mixed, pieces, rows_to_batch, stored
from barograph.session import ship_package


@dataclass(frozen=True)
class LanguageModelRules:
    #: Words and pairs that occur less often in all documents are unknown to both models.
    least_count: int = 5
    #: What a pair's count leans on its second word: the words' probability counts as so many pairs.
    pair_weight: float = 8.0
    #: What a word's count in a corpus leans on the shared words, as so many words.
    word_weight: float = 1000.0
    #: Tables up to this number of words and pairs are broadcast (24 bytes each).
    broadcast_rows: int = 3_000_000
    #: Ids of the target corpus up to this number are broadcast (8 bytes each); beyond, texts are shuffled.
    broadcast_ids: int = 2_000_000


DEFAULT_RULES = LanguageModelRules()
#: The word before the first word of a text.
START = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, word before) of every token: runs between ASCII white space, ASCII letters in lower
    case, as hashes."""
    lower = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    split = pc.ascii_split_whitespace(lower)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    there = np.fromiter(map(len, words), np.int64, len(words)) > 0
    codes = coded.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    kept = there[codes]
    row, word = row[kept], hashes[codes[kept]]
    before = np.roll(word, 1)
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    before[first] = START
    return row, word, before


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(before) * np.uint64(0xD1B54A32D192ED03) + word)


def counted(docs: DataFrame, rules: LanguageModelRules) -> DataFrame:
    """(key, pair, target, background): counts of words and pairs over all rows (text, is_target), those
    that are frequent enough. ``pair`` tells pairs from words; START counts the texts."""
    schema = pa.schema([("key", pa.int64()), ("pair", pa.bool_()), ("target", pa.int64()), ("background", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 16_000_000):
            row, word, before = tokens_of(batch.column("text"))
            marked = batch.column("is_target").to_numpy(zero_copy_only=False)[row]
            starts = before[before == START], marked[before == START]
            parts = (False, word, marked), (False, *starts), (True, pair_key(before, word), marked)
            for pair, keys, target in parts:
                found, at = np.unique(keys, return_inverse=True)
                totals = [np.bincount(at, weights, len(found)).astype(np.int64) for weights in (target, None)]
                yield rows_to_batch(schema, [found.view(np.int64), np.full(len(found), pair), *totals])

    ship_package(docs.sparkSession)
    sums = (
        docs.select("text", "is_target")
        .mapInArrow(count, "key long, pair boolean, target long, background long")
        .groupBy("key", "pair")
        .agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    )
    return stored(sums, "lm-counts")


@dataclass(frozen=True)
class Totals:
    """Tokens of both corpora, and how many different words there are."""

    target: int
    background: int
    words: int

    @property
    def scale(self) -> float:
        return self.target / self.background if self.target and self.background else 1.0


def totals_of(counts: DataFrame) -> Totals:
    words = counts.where(~F.col("pair") & (F.col("key") != F.lit(int(START.view(np.int64)))))
    row = words.agg(F.sum("target"), F.sum("background"), F.count(F.lit(1))).first()
    return Totals(row[0] or 0, row[1] or 0, row[2])


def losses(pair, before, word, shared, size: float, rules: LanguageModelRules, log2=np.log2):
    """-log2 P(word | word before) from the counts of the pair, the word before and the word in one corpus of
    ``size`` words, and the word's share of all words. Works on arrays and on Columns."""
    share = (word + rules.word_weight * shared) / (size + rules.word_weight)
    return log2(before + rules.pair_weight) - log2(pair + rules.pair_weight * share)


def _both(pair, before, word, totals: Totals, rules: LanguageModelRules, log2=np.log2) -> tuple:
    """Losses under the target and the background; each count is (target, background)."""
    shared = (word[1] + 1) / float(totals.background + totals.words + 1)
    target = losses(pair[0], before[0], word[0], shared, float(totals.target), rules, log2)
    scaled = [x[1] * totals.scale for x in (pair, before, word)]
    return target, losses(*scaled, shared, totals.background * totals.scale, rules, log2)


@dataclass(frozen=True)
class Table:
    """Frequent words and pairs as sorted keys with their counts in both corpora."""

    keys: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> Table:
        keys = rows["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        return Table(keys[order], np.stack([rows[n].to_numpy()[order] for n in ("target", "background")]).astype(float))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Counts in both corpora, 0 where a key is not in the table."""
        if not len(self.keys):
            return np.zeros((2, len(keys)))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[:, at], 0.0)


_RESULT = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _scored_in_tasks(rows: DataFrame, kept: DataFrame, totals: Totals, rules: LanguageModelRules) -> DataFrame:
    parts = [kept.where(F.col("pair") == pair).select("key", "target", "background") for pair in (False, True)]
    words, pairs = (Table.of(part.toArrow()) for part in parts)
    shared = rows.sparkSession.sparkContext.broadcast((words, pairs))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()),
         *[(n, pa.float64()) for n in ("target_loss", "background_loss", "score")]]
    )

    def make():
        words, pairs = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, word, before = tokens_of(batch.column("text"))
            found = pairs.find(pair_key(before, word)), words.find(before), words.find(word)
            both = _both(*found, totals, rules)
            n = np.bincount(row, minlength=batch.num_rows)
            with np.errstate(invalid="ignore"):
                target, background = (np.bincount(row, x, batch.num_rows) / n for x in both)
            none = n == 0
            columns = [pa.array(x, mask=none) for x in (target, background, target - background)]
            return rows_to_batch(schema, [batch.column("doc_id"), n, *columns])

        return step

    return by_batch(rows, make, _RESULT)


def _scored_by_joins(rows: DataFrame, kept: DataFrame, totals: Totals, rules: LanguageModelRules) -> DataFrame:
    """The same scores where the tables are too large to send: a document's different pairs meet the
    tables in three joins, and their losses are added up per document."""
    numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    schema = pa.schema([("row", pa.int64()), ("word", pa.int64()), ("before", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, word, before = tokens_of(batch.column("text"))
            keys = pair_key(before, word)
            order = np.lexsort((keys, row))
            new = np.ones(len(order), bool)
            new[1:] = (row[order][1:] != row[order][:-1]) | (keys[order][1:] != keys[order][:-1])
            at = order[new]
            n = np.diff(np.append(np.flatnonzero(new), len(order)))
            ids = batch.column("row").to_numpy(zero_copy_only=False)[row[at]]
            return rows_to_batch(schema, [ids, *[x[at].view(np.int64) for x in (word, before, keys)], n])

        return step

    pairs = by_batch(numbered.select("row", "text"), make, "row long, word long, before long, pair long, n long")

    def looked(frame: DataFrame, column: str, pair: bool) -> DataFrame:
        counts = kept.where(F.col("pair") == pair).select(
            F.col("key").alias(column), F.struct("target", "background").alias(f"{column}_n")
        )
        return frame.join(counts, column, "left")

    found = looked(looked(looked(pairs, "pair", True), "before", False), "word", False)

    def both(column: str) -> list[Column]:
        return [F.coalesce(F.col(f"{column}_n.{n}"), F.lit(0)).cast("double") for n in ("target", "background")]

    target, background = _both(both("pair"), both("before"), both("word"), totals, rules, F.log2)
    sums = found.groupBy("row").agg(
        F.sum("n").alias("n_tokens"),
        F.sum(F.col("n") * target).alias("target"),
        F.sum(F.col("n") * background).alias("background"),
    )
    return numbered.select("doc_id", "row").join(sums, "row", "left").select(
        "doc_id",
        F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"),
        (F.col("target") / F.col("n_tokens")).alias("target_loss"),
        (F.col("background") / F.col("n_tokens")).alias("background_loss"),
        ((F.col("target") - F.col("background")) / F.col("n_tokens")).alias("score"),
    )


def cross_entropy_difference(
    docs: DataFrame,
    targets: DataFrame,
    rules: LanguageModelRules = DEFAULT_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every whole text.

    ``targets`` has the ids (``doc_id``) of the target corpus; all documents are the background.
    Losses are bits per token. One row per row: a null or empty text has no tokens and null losses,
    repeated rows count and stay, null ids are background, other columns are not read, no rows give
    no rows, and without targets the target model knows only the shared words.
    """
    rows = documents(docs, id_col, text_col)
    ids = targets.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    marks = stored(ids.withColumn("is_target", F.lit(True)), "lm-targets")
    marks = F.broadcast(marks) if marks.count() <= rules.broadcast_ids else marks
    marked = rows.join(marks, "doc_id", "left").select("text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    counts = counted(marked, rules)
    totals = totals_of(counts)
    kept = counts.where(F.col("background") >= rules.least_count)
    small = kept.limit(rules.broadcast_rows + 1).count() <= rules.broadcast_rows
    score = _scored_in_tasks if small else _scored_by_joins
    return score(rows, kept, totals, rules)
