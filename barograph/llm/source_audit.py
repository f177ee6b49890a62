"""How far the sources of a language diverge in the terms they use.

For a block of a language's terms, every (group, count level) pair is an indicator column: one where
a term occurs that often in that group, level zero included. The matrix of these columns times its
transpose holds, for every two groups, the table of how many terms have level a here and level b
there. Prices depend on levels only, so each table is priced entry by entry, exactly in integers,
and blocks are added.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barograph.llm.common import pieces, stored
from barograph.session import ship_package


@dataclass(frozen=True)
class AuditRules:
    least_documents: int = 3  # documents of a language that must hold a term
    scale: int = 1_000_000_000  # of a probability
    top_terms: int = 200  # ranks reported per group
    block_counts: int = 100_000  # term counts of one block, about
    tile: int = 64  # groups whose columns stand in one matrix
    columns: int = 4096  # of one indicator matrix, about
    cells: int = 8_000_000  # of one indicator matrix
    held_terms: int = 300_000  # term counts a task adds up before it sends them


DEFAULT_RULES = AuditRules()

#: A-Z become a-z; all other ASCII but a-z separates terms.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame, rules: AuditRules = DEFAULT_RULES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group. A task
    adds up before it sends, so a hot source sends few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = defaultdict(Counter)
        held: dict[tuple, Counter] = defaultdict(Counter)

        def sent() -> pa.RecordBatch:
            rows = [
                (lang, source, term, n, held[lang, source][term])
                for (lang, source), terms in counts.items()
                for term, n in terms.items()
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            names = ("lang", "source", "term", "n", "docs")
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            arrays[2] = arrays[2].cast(pa.string())
            counts.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in pieces(batches):
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group, text in zip(groups, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                terms = text.translate(_TERM_BYTES).split()
                counts[group].update(terms)
                held[group].update(set(terms))
            if sum(map(len, counts.values())) > rules.held_terms:
                yield sent()
        yield sent()

    ship_package(docs.sparkSession)
    return (
        docs.mapInArrow(run, _COUNTS)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def kept_terms(counts: DataFrame, rules: AuditRules = DEFAULT_RULES) -> DataFrame:
    """(lang, source, term, n, total, first): counts of the terms that enough documents of the language
    hold, with the language's count; ``first`` marks one row per term."""
    term = Window.partitionBy("lang", "term")
    return (
        counts.withColumn("total", F.sum("n").over(term))
        .withColumn("in_docs", F.sum("docs").over(term))
        .withColumn("first", F.col("source") == F.min("source").over(term))
        .where(F.col("in_docs") >= rules.least_documents)
        .select("lang", "source", "term", "n", "total", "first")
    )


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, tokens, vocabulary, lang_tokens) of every group that occurs."""
    languages = kept.groupBy("lang").agg(
        F.sum(F.col("first").cast("long")).alias("vocabulary"), F.sum("n").alias("lang_tokens")
    )
    tokens = kept.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    return (
        docs.select("lang", "source")
        .distinct()
        .join(tokens, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .na.fill(0, ["tokens", "vocabulary", "lang_tokens"])
    )


def _price(n: np.ndarray, tokens: int, vocabulary: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (n + 1) / (tokens + vocabulary)) in whole numbers."""
    whole = tokens + vocabulary
    if len(n) and int(n.max()) + 1 > (2**63 - 1) // scale:
        return np.array([1 + scale * (int(x) + 1) // whole for x in n], np.int64)
    return 1 + scale * (n + 1) // whole


class Block:
    """Counts of the terms of one block in all groups of its language. Rows without a term are the groups."""

    def __init__(self, rows: pd.DataFrame, rules: AuditRules):
        heads = rows[rows["term"].isna()].sort_values("source")
        counts = rows[rows["term"].notna()]
        self.rules = rules
        self.sources = heads["source"].to_numpy(object)
        self.tokens = heads["n"].tolist()
        self.vocabulary = int(heads["vocabulary"].iloc[0])
        self.group = pd.Index(self.sources).get_indexer(counts["source"])
        self.term = pd.factorize(counts["term"])[0]
        self.n = counts["n"].to_numpy(np.int64)
        self.terms = int(self.term.max()) + 1 if len(counts) else 0
        self.levels = len(np.unique(self.n)) + 1

    def tile(self, number: int) -> range:
        start = number * self.rules.tile
        return range(start, min(start + self.rules.tile, len(self.sources)))

    def runs(self) -> Iterator[tuple[int, int]]:
        """Runs of terms whose indicator matrix keeps to the limits. Every term makes at most one column
        per group; where there are few levels, so do all terms together."""
        width = min(self.rules.tile, len(self.sources))
        size = max(1, self.rules.columns // width)
        if width * self.levels <= self.rules.columns:
            size = max(size, self.rules.cells // (width * self.levels))
        for start in range(0, self.terms, size):
            yield start, min(start + size, self.terms)

    def indicators(self, run: tuple[int, int], groups: range) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(matrix, group of a column, level of a column), a row per term of the run."""
        start, stop = run
        inside = (self.term >= start) & (self.term < stop)
        inside &= (self.group >= groups.start) & (self.group < groups.stop)
        counts = np.zeros((stop - start, len(groups)), np.int64)
        counts[self.term[inside] - start, self.group[inside] - groups.start] = self.n[inside]
        found = [np.unique(column, return_inverse=True) for column in counts.T]
        first = np.cumsum([0, *(len(levels) for levels, _ in found)])
        matrix = np.zeros((stop - start, first[-1]), np.float32)  # exact for sums below 2^24
        for at, (_, column) in zip(first, found, strict=False):
            matrix[np.arange(stop - start), at + column] = 1
        group = np.repeat(np.arange(groups.start, groups.stop), np.diff(first))
        return matrix, group, np.concatenate([levels for levels, _ in found])

    def tables(self, left: range, right: range) -> Iterator[tuple[np.ndarray, ...]]:
        """Entries of the joint tables of two tiles, by runs: (group, level, group, level, terms)."""
        for run in self.runs():
            a, group_a, level_a = self.indicators(run, left)
            b, group_b, level_b = (a, group_a, level_a) if left == right else self.indicators(run, right)
            product = a.T @ b
            i, j = np.nonzero(product)
            yield group_a[i], level_a[i], group_b[j], level_b[j], product[i, j].astype(np.int64)

    def prices(self, groups: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """p of every (group, level)."""
        out = np.empty(len(groups), np.int64)
        for g in np.unique(groups):
            at = groups == g
            out[at] = _price(levels[at], self.tokens[g], self.vocabulary, self.rules.scale)
        return out

    def values(self, number: int) -> pd.DataFrame:
        """(source, item, value) of the groups of one tile with those of its own and of later tiles."""
        left = self.tile(number)
        out = []
        for other in range(number, -(-len(self.sources) // self.rules.tile)):
            right = self.tile(other)
            here, there = (np.zeros((len(left), len(right)), np.int64) for _ in range(2))
            for g, level_g, h, level_h, terms in self.tables(left, right):
                p, q = self.prices(g, level_g), self.prices(h, level_h)
                square = (p - q) ** 2
                at = (g - left.start, h - right.start)
                np.add.at(here, at, square // q * terms)
                np.add.at(there, at, square // p * terms)
            g, h = np.indices(here.shape)
            g, h = g.ravel() + left.start, h.ravel() + right.start
            out.append((g, h, here.ravel()))
            if other > number:
                out.append((h, g, there.ravel()))
        g, h, value = (np.concatenate(parts) for parts in zip(*out, strict=True))
        apart = g != h
        return pd.DataFrame(
            {"source": self.sources[g[apart]], "item": self.sources[h[apart]], "value": value[apart]}
        )


def _blocks(kept: DataFrame, groups: DataFrame, rules: AuditRules) -> DataFrame:
    """Counts dealt to blocks of terms that occur about equally often, with all groups of the language."""
    term_class = F.floor(F.log2(F.col("total"))).cast("int")
    languages = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / rules.tile).cast("int").alias("tiles")
    )
    sizes = stored(
        kept.groupBy("lang", term_class.alias("class"))
        .agg(F.ceil(F.count(F.lit(1)) / rules.block_counts).cast("int").alias("parts"))
        .unionByName(languages.select("lang", F.lit(-1).alias("class"), F.lit(1).alias("parts")))
        .join(languages, "lang"),
        "audit-blocks",
    )
    tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    counts = (
        kept.withColumn("class", term_class)
        .join(sizes, ["lang", "class"])
        .withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
        .select("lang", "class", "part", tile, "term", "source", "n", F.lit(0).cast("long").alias("vocabulary"))
    )
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    heads = (
        sizes.select("lang", "class", "tiles", part)
        .select("lang", "class", "part", tile)
        .join(groups, "lang")
        .select(
            "lang", "class", "part", "tile", F.lit(None).cast("string").alias("term"), "source",
            F.col("tokens").alias("n"), "vocabulary",
        )
    )
    return counts.unionByName(heads)


def pair_values(kept: DataFrame, groups: DataFrame, rules: AuditRules = DEFAULT_RULES) -> DataFrame:
    """(lang, source, item, value): every two groups of a language, priced over all kept terms."""

    def price(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = Block(rows, rules).values(int(key[3]))
        out.insert(0, "lang", key[0])
        return out

    ship_package(kept.sparkSession)
    return (
        _blocks(kept, groups, rules)
        .groupBy("lang", "class", "part", "tile")
        .applyInPandas(price, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def joint_tables(kept: DataFrame, groups: DataFrame, rules: AuditRules = DEFAULT_RULES) -> DataFrame:
    """(lang, source, level, item, item_level, terms): how many kept terms occur ``level`` times in one
    group and ``item_level`` times in another, for groups in ascending order of name; no zero entries."""

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, number, out = Block(rows, rules), int(key[3]), []
        for other in range(number, -(-len(block.sources) // rules.tile)):
            for g, a, h, b, terms in block.tables(block.tile(number), block.tile(other)):
                at = g < h
                out.append(
                    pd.DataFrame(
                        {
                            "lang": key[0], "source": block.sources[g[at]], "level": a[at],
                            "item": block.sources[h[at]], "item_level": b[at], "terms": terms[at],
                        }
                    )
                )
        names = ["lang", "source", "level", "item", "item_level", "terms"]
        return pd.concat(out)[names] if out else pd.DataFrame(columns=names)

    ship_package(kept.sparkSession)
    keys = ["lang", "source", "level", "item", "item_level"]
    return (
        _blocks(kept, groups, rules)
        .groupBy("lang", "class", "part", "tile")
        .applyInPandas(
            count, "lang string, source string, level long, item string, item_level long, terms long"
        )
        .groupBy(*keys)
        .agg(F.sum("terms").alias("terms"))
    )


def term_values(kept: DataFrame, groups: DataFrame, rules: AuditRules = DEFAULT_RULES) -> DataFrame:
    """(lang, source, item, value): kept terms that a group holds more often than its language."""
    frame = kept.join(groups, ["lang", "source"])
    frame = frame.withColumn("p_whole", F.col("tokens") + F.col("vocabulary")).withColumn(
        "q_whole", F.col("lang_tokens") + F.col("vocabulary")
    )
    scale = f"CAST({rules.scale} AS DECIMAL(12, 0))"
    return (
        frame.withColumn("p", F.expr(f"1 + ({scale} * CAST(n + 1 AS DECIMAL(20, 0))) div p_whole"))
        .withColumn("q", F.expr(f"1 + ({scale} * CAST(total + 1 AS DECIMAL(20, 0))) div q_whole"))
        .where("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    )


def audit(
    docs: DataFrame,
    rules: AuditRules = DEFAULT_RULES,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): per group its distance from every other source of its
    language (part ``pair``) and its most typical terms (part ``term``).

    Null texts, languages and sources count as ''. Each row is a document, also a repeated one. A group
    without terms takes part with counts of zero; a language without kept terms has values of zero; the
    only source of a language has no pairs. Ties are ranked by the UTF-8 bytes of the item. Texts of any
    length are read whole, other columns are not read, an empty table gives no rows.
    """
    texts = docs.select(
        *[
            F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)
            for column, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        ]
    )
    kept = stored(kept_terms(term_counts(texts, rules), rules), "audit-terms")
    groups = stored(groups_of(texts, kept), "audit-groups")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(frame: DataFrame, part: str) -> DataFrame:
        return frame.select("lang", "source", F.lit(part).alias("part"), "item", "value").withColumn(
            "rank", F.row_number().over(best)
        )

    terms = ranked(term_values(kept, groups, rules), "term").where(F.col("rank") <= rules.top_terms)
    return ranked(pair_values(kept, groups, rules), "pair").unionByName(terms)

