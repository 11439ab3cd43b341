"""Named text featurizers: fitted on training rows, applied to any rows.

Input rows carry their keys, a text (or several) and perhaps a label; output rows carry the same columns
without the texts, and `features`. Fitting brings only the vocabulary to the driver, whose size is set by
the featurizer; word vectors stay in a table. Applying works row by row, without a shuffle; only `complex_bow` joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import IDF, CountVectorizerModel, IDFModel, VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from notesight.config import stage
from notesight.functions.tokens import ngrams, remove_stop_words, word_tokens
from notesight.functions.words import REMOVER_STOP_WORDS, SECTION_HEADERS
from notesight.operators import word_vectors
from notesight.operators.features import block_vocabularies, final_tokens, gram_counts, vocabulary
from notesight.operators.terms import MAX_BROADCAST_TERMS, correct_spelling, sentence_sentiment, token_counts

PART, WHOLE = "part", "is_whole"


@dataclass(frozen=True)
class Block:
    """A run of count features: the most frequent n-grams of one text column."""

    column: str
    n: int
    size: int


@dataclass(frozen=True)
class Featurizer:
    name: str
    blocks: tuple[Block, ...] = ()
    stem: bool = True
    idf: bool = False
    word2vec: bool = False
    seed: int = 12345
    partitions: int | None = None
    dimensions: int = 100
    min_count: int = 5

    @property
    def columns(self) -> list[str]:
        named = list(dict.fromkeys(block.column for block in self.blocks))
        return named or ["text"]

    def fit(self, df: DataFrame) -> "FittedFeaturizer":
        fitted = FittedFeaturizer(self, self._vocabularies(df) if self.blocks else [])
        if self.idf:
            fitted.idf_model = IDF(inputCol="counts", outputCol="features").fit(fitted.counts(df))
        if self.word2vec:
            tokens = df.select(remove_stop_words(final_tokens(F.col("text"), self.stem)).alias("tokens"))
            # as many training tasks as the table has splits
            if self.partitions:
                tokens = tokens.repartition(self.partitions)
            partitions = self.partitions or tokens.rdd.getNumPartitions()
            fitted.word_vectors = word_vectors.fit(tokens, self.dimensions, self.min_count, self.seed, partitions)
        return fitted


    def _vocabularies(self, df: DataFrame) -> list[tuple[Block, list[str]]]:
        grams = [self.grams(block) for block in self.blocks]
        counts = gram_counts(self.tokens(df), grams)
        # bounded by the sizes of the blocks
        rows = block_vocabularies(counts, [block.size for block in self.blocks]).collect()
        rows.sort(key=lambda row: (row["block"], -row["n"], row["term"]))
        terms = [[row["term"] for row in rows if row["block"] == i] for i in range(len(self.blocks))]
        return [(block, found) for block, found in zip(self.blocks, terms) if found]

    def tokens(self, df: DataFrame) -> DataFrame:
        """The rows with `tokens_..` in place of the texts, and in `carry_..` the last tokens before a row
        that goes on from another part of its admission."""
        tokens = {f"tokens_{name}": remove_stop_words(final_tokens(F.col(name), self.stem)) for name in self.columns}
        empty = {f"carry_{name}": F.array().cast("array<string>") for name in self.columns}
        rows = df.withColumns(tokens | empty).drop(*self.columns)
        context = max((block.n for block in self.blocks), default=1) - 1
        if PART not in df.columns or context == 0:
            return rows
        return rows.filter(WHOLE).unionByName(self._carry(rows.filter(~F.col(WHOLE)), context))

    def _carry(self, parts: DataFrame, context: int) -> DataFrame:
        """From the last few tokens of each earlier part, a handful of words per part."""
        keys = [name for name in parts.columns if not name.startswith(("tokens_", "carry_")) and name not in (PART, WHOLE)]
        earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        tails = parts.select(*keys, PART, *[last_items(F.col(f"tokens_{name}"), context).alias(name) for name in self.columns])
        named = [F.col(name).alias(f"of_{name}") for name in [*keys, PART]]
        carried = tails.select(*named, *[
            last_items(F.flatten(F.collect_list(name).over(earlier)), context).alias(f"carry_{name}") for name in self.columns
        ])
        same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in [*keys, PART]]
        rows = parts.drop(*[f"carry_{name}" for name in self.columns])
        return rows.join(carried, same).drop(*[f"of_{name}" for name in [*keys, PART]])

    def grams(self, block: Block) -> Column:
        """The n-grams of a block over the columns of `tokens`."""
        tokens = F.col(f"tokens_{block.column}")
        if block.n == 1:
            return tokens
        return ngrams(F.concat(last_items(F.col(f"carry_{block.column}"), block.n - 1), tokens), block.n)


def last_items(items: Column, count: int) -> Column:
    return F.when(F.size(items) > count, F.slice(items, -count, count)).otherwise(items)


@dataclass
class FittedFeaturizer:
    plan: Featurizer
    vocabularies: list[tuple[Block, list[str]]] = field(default_factory=list)
    idf_model: IDFModel | None = None
    word_vectors: word_vectors.WordVectors | None = None

    @property
    def size(self) -> int:
        return self.plan.dimensions if self.plan.word2vec else sum(len(terms) for _, terms in self.vocabularies)

    def feature_map(self, spark: SparkSession) -> DataFrame:
        """(feature, value): what each slot of `features` counts; empty for word vectors. Terms of a column
        other than the text are written `column:term`."""
        values = [
            term if block.column == "text" else f"{block.column}:{term}"
            for block, terms in self.vocabularies
            for term in terms
        ]
        return spark.createDataFrame(list(enumerate(values)), "feature bigint, value string")

    def counts(self, df: DataFrame) -> DataFrame:
        """The rows with the vector `counts`. The vectors of an admission's parts are added."""
        counted = self._counts(self.plan.tokens(df))
        if PART not in df.columns:
            return counted
        whole, parts = counted.filter(WHOLE).drop(PART, WHOLE), counted.filter(~F.col(WHOLE)).drop(PART, WHOLE)
        keys = [name for name in whole.columns if name != "counts"]
        added = parts.groupBy(*keys).agg(Summarizer.sum(F.col("counts")).alias("counts"))
        return whole.unionByName(added)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.plan.word2vec:
            return self._word_vectors(df)
        counted = self.counts(df)
        if self.idf_model is not None:
            return self.idf_model.transform(counted).drop("counts")
        return counted.withColumnRenamed("counts", "features")

    def _counts(self, df: DataFrame) -> DataFrame:
        outputs = []
        for i, (block, terms) in enumerate(self.vocabularies):
            df = df.withColumn("grams", self.plan.grams(block))
            model = CountVectorizerModel.from_vocabulary(terms, inputCol="grams", outputCol=f"counts_{i}")
            df = model.transform(df).drop("grams")
            outputs.append(f"counts_{i}")
        df = df.drop(*[name for name in df.columns if name.startswith(("tokens_", "carry_"))])
        if len(outputs) == 1:
            return df.withColumnRenamed(outputs[0], "counts")
        return VectorAssembler(inputCols=outputs, outputCol="counts").transform(df).drop(*outputs)

    def _word_vectors(self, df: DataFrame) -> DataFrame:
        tokens = remove_stop_words(final_tokens(F.col("text"), self.plan.stem))
        rows = self.word_vectors.transform(df.withColumn("tokens", tokens).drop("text"))
        if PART not in df.columns:
            return rows.drop("n_tokens")
        whole = rows.filter(WHOLE).drop("n_tokens", PART, WHOLE)
        keys = [name for name in whole.columns if name != "features"]
        mean = Summarizer.mean(F.col("features"), F.col("n_tokens").cast("double")).alias("features")
        return whole.unionByName(rows.filter(~F.col(WHOLE)).groupBy(*keys).agg(mean))


@dataclass(frozen=True)
class ComplexFeaturizer:
    """Counts of spelling-corrected words, and the summed sentence sentiment as the last feature."""

    dictionary: DataFrame
    lexicon: DataFrame
    negators: tuple[str, ...] = ()
    name: str = "complex_bow"
    size: int = 1000
    max_distance: int = 2

    def corrections(self, words: DataFrame) -> DataFrame:
        """(term, corrected, distance) of the distinct `term`s of a table, found once."""
        return stage(correct_spelling(words, self.dictionary, self.max_distance))

    def corrected(self, counts: DataFrame, corrections: DataFrame, keys: Sequence[str]) -> DataFrame:
        """(keys, term, n) after correction, without stop words."""
        # one row for each distinct wrong word; if they are few, the counts stay where they are
        changed = corrections.filter("distance > 0").select("term", "corrected")
        if changed.count() <= MAX_BROADCAST_TERMS:
            changed = F.broadcast(changed)
        fixed = counts.join(changed, "term", "left").withColumn("term", F.coalesce("corrected", "term"))
        return (
            fixed.filter(~F.col("term").isin(REMOVER_STOP_WORDS))
            .groupBy(*keys, "term")
            .agg(F.sum("n").alias("n"))
        )

    def fit(self, df: DataFrame) -> "FittedComplexFeaturizer":
        counts = stage(token_counts(df, word_tokens(F.col("text"))))
        corrections = self.corrections(counts)
        top = vocabulary(self.corrected(counts, corrections, []), self.size).orderBy("feature").collect()
        return FittedComplexFeaturizer(self, [row["value"] for row in top], corrections)


@dataclass
class FittedComplexFeaturizer:
    plan: ComplexFeaturizer
    terms: list[str]
    corrections: DataFrame

    @property
    def size(self) -> int:
        return len(self.terms) + 1

    def feature_map(self, spark: SparkSession) -> DataFrame:
        values = [*self.terms, "(sentiment)"]
        return spark.createDataFrame(list(enumerate(values)), "feature bigint, value string")

    def transform(self, df: DataFrame) -> DataFrame:
        """Needs the key columns to be unique up to `part`."""
        keys = [name for name in df.columns if name not in ("text", PART, WHOLE)]
        scores = sentence_sentiment(df, self.plan.lexicon, self.plan.negators, keys)
        sentiment = scores.groupBy(*keys).agg(F.sum("score").alias("sentiment"))
        # only vocabulary terms are gathered: at most `size` distinct ones per row
        words = df.select(*keys, F.explode(word_tokens(F.col("text"))).alias("term"))
        # a word's correction depends on the dictionary only: what the fit has seen is not corrected again
        unseen = words.select("term").distinct().join(self.corrections.select("term"), "term", "left_anti")
        corrections = self.corrections.unionByName(self.plan.corrections(unseen))
        counted = words.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))
        counts = self.plan.corrected(counted, corrections, keys).filter(F.col("term").isin(self.terms))
        grams = counts.groupBy(*keys).agg(
            F.flatten(F.collect_list(F.array_repeat("term", F.col("n").cast("int")))).alias("grams")
        )
        rows = (
            df.select(*keys).distinct()
            .join(grams, keys, "left")
            .join(sentiment, keys, "left")
            .select(
                *keys,
                F.coalesce("grams", F.array().cast("array<string>")).alias("grams"),
                F.coalesce("sentiment", F.lit(0.0)).alias("sentiment"),
            )
        )
        model = CountVectorizerModel.from_vocabulary(self.terms, inputCol="grams", outputCol="counts")
        joined = VectorAssembler(inputCols=["counts", "sentiment"], outputCol="features")
        return joined.transform(model.transform(rows)).drop("grams", "counts", "sentiment")


def _section_blocks() -> tuple[Block, ...]:
    columns = ["text", *SECTION_HEADERS]
    return tuple(Block(column, n, size) for column in columns for n, size in ((1, 2000), (2, 1000)))


FEATURIZERS = {
    "bag_of_words": Featurizer("bag_of_words", (Block("text", 1, 3000),)),
    "tf_idf": Featurizer("tf_idf", (Block("text", 1, 3000),), stem=False, idf=True),
    "ngrams": Featurizer("ngrams", (Block("text", 1, 3000), Block("text", 2, 1000))),
    "section_bow": Featurizer("section_bow", _section_blocks()),
    "word2vec": Featurizer("word2vec", word2vec=True),
}


def featurizer(name: str, **options) -> Featurizer | ComplexFeaturizer:
    """A featurizer by name; `complex_bow` needs its dictionary and lexicon as options."""
    if name == "complex_bow":
        return ComplexFeaturizer(**options)
    if name not in FEATURIZERS:
        raise ValueError(f"unknown featurizer {name!r}; known: {', '.join([*FEATURIZERS, 'complex_bow'])}")
    return FEATURIZERS[name]
