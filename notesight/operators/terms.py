"""Jobs against a word list: term matches, dictionary words, spelling, sentiment.

A word list is a DataFrame. Lists up to a checked size go to the executors whole; larger ones are joined."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from notesight.config import stage
from notesight.functions.tokens import sentences, word_tokens

MAX_BROADCAST_TERMS = 200_000
MAX_BROADCAST_CHARS = 20_000_000

#: Characters of a word list, and of its longest term, up to which it is compiled into one pattern.
MAX_PATTERN_CHARS = 1_000_000
MAX_PATTERN_TERM = 256
#: Letters of a term by which terms and places meet.
GRAM = 8
#: Size of the filter of places, at most, as a power of two of bits; and letters that go on at a time.
MAX_FILTER_BITS, MAX_BATCH_CHARS = 28, 1 << 23
#: Words of texts that are matched and put together again at a time (a longer text goes alone).
MAX_CHUNK_WORDS = 1 << 20
#: Between the terms found, before they are joined by spaces; a list with this character is joined.
BREAK = "\x01"
LETTER = r"[\p{L}\p{N}]"


def _alternatives(words: list[str]) -> str:
    """A pattern of sorted words, none the beginning of another, that tries each letter once."""
    if len(words) == 1:
        return _literal(words[0])
    common = os.path.commonprefix([words[0], words[-1]])
    groups = groupby((word[len(common) :] for word in words), lambda rest: rest[0])
    return _literal(common) + "(?:" + "|".join(_alternatives(list(group)) for _, group in groups) + ")"


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in text)


def terms_in(text: Column, terms: Sequence[str], whole_words: bool = False) -> Column:
    """All occurrences of the terms, as `match_terms` gives them, in one pass over the text and without a shuffle.

    The text is read backwards. Of the terms that end at one place each is the beginning of the next longer one
    when read so; a term's level is the number of such beginnings. At each place one pattern takes the
    term of every level, shortest first, and turning the result round gives the order asked for."""
    levels: list[list[str]] = []
    inside: list[str] = []
    for word in sorted({term[::-1] for term in terms if term}):
        while inside and not word.startswith(inside[-1]):
            inside.pop()
        if len(inside) == len(levels):
            levels.append([])
        levels[len(inside)].append(word)
        inside.append(word)
    if not levels:
        return F.lit("")
    edge, begin = (f"(?!{LETTER})", f"(?<!{LETTER})") if whole_words else ("", "")
    # without edges there is no level unless there is the first one
    skip = ["|" if whole_words or number else "" for number in range(len(levels))]
    taken = "".join(f"(?=({_alternatives(level)}){edge}{none})" for level, none in zip(levels, skip))
    found = F.regexp_replace(
        F.reverse(F.coalesce(text, F.lit(""))), F.lit(f"(?s)(?:{begin}{taken})?."),
        F.lit("".join(f"${level}{BREAK}" for level in range(1, len(levels) + 1))),
    )
    return F.regexp_replace(F.btrim(F.reverse(found), F.lit(BREAK)), BREAK + "+", " ")


def words_in(text: Column, words: Sequence[str]) -> Column:
    """`terms_in` for whole words and terms that are such: an occurrence is a run of letters and digits, looked up as one."""
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{LETTER}+"), F.lit(0))
    return F.array_join(F.filter(runs, lambda run: run.isin(list(words))), " ")


def match_terms(
    df: DataFrame,
    terms: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    whole_words: bool = False,
    max_pattern: int = MAX_PATTERN_CHARS,
) -> DataFrame:
    """(keys, terms), a row for each row of `df`: every occurrence of every term in the text, overlaps and
    substrings included, by end position and at one end the longest first, joined by a space. `whole_words`
    keeps only occurrences with no letter or digit next to them.

    A list whose size has been checked becomes a pattern, or a set of words if whole words are asked for and every term is one. A larger one is joined, with the same result. Of such words
    those of the texts are joined: see `_match_words`. Otherwise each term is known by
    its rarest few letters, texts are filtered by these within the row, and only the places that may be a term's are joined,
    with the letters around them. Occurrences are gathered per row, so that what is shuffled has one row for each."""
    listed = terms.select("term").filter("term != ''").distinct()
    size = listed.agg(
        F.count("term").alias("terms"), F.sum(F.length("term")).alias("chars"), F.max(F.length("term")).alias("longest"),
        F.bool_and(F.rlike("term", F.lit(rf"\A{LETTER}+\z"))).alias("are_words"),
        F.collect_set(F.least(F.length("term"), F.lit(GRAM))).alias("widths"), F.max(F.contains("term", F.lit(BREAK))).alias("breaks"),
    ).first()
    if not size["terms"]:
        return df.select(*keys, F.lit("").alias("terms"))
    if size["chars"] <= max_pattern and size["longest"] <= MAX_PATTERN_TERM and not size["breaks"]:
        words = [row["term"] for row in listed.collect()]
        if whole_words and size["are_words"]:
            return df.select(*keys, words_in(F.col(text), words).alias("terms"))
        return df.select(*keys, terms_in(F.col(text), words, whole_words).alias("terms"))
    listed = stage(listed)
    if whole_words and size["are_words"]:
        return _match_words(df, listed, keys, text, size["terms"])
    keyed = rare_grams(listed, GRAM)
    hits = _gram_hits(df, keys, text, keyed, size["terms"], size["widths"], size["longest"])
    # where a term would begin if the place is that of its gram
    start = F.col("at") - F.col("offset")
    same = (F.col("gram") == F.col("term_gram")) & (start >= 0) & (F.substr("around", start + 1, F.col("size")) == F.col("term"))
    if whole_words:
        letter = "^" + LETTER
        before = F.when(start > 0, F.substr("around", start, F.lit(1)))
        same = same & ~F.coalesce(before, F.lit(" ")).rlike(letter)
        same = same & ~F.substr("around", start + F.col("size") + 1, F.lit(1)).rlike(letter)
    met = hits.join(keyed, same, "left")
    end = F.col("place") - F.col("offset") + F.col("size")
    hit = F.when(F.col("term").isNotNull(), F.struct(end.alias("end"), (-F.col("size")).alias("shorter"), "term"))
    # every row has a place of its own without a gram, so that rows without an occurrence stay
    some = met.filter(F.col("term").isNotNull() | F.col("gram").isNull())
    ordered = F.array_sort(F.collect_list(hit))
    return some.groupBy("row", *keys).agg(F.array_join(F.transform(ordered, lambda h: h["term"]), " ").alias("terms")).drop("row")


def _match_words(
    df: DataFrame, listed: DataFrame, keys: Sequence[str], text: str, n_terms: int, chunk_words: int = MAX_CHUNK_WORDS
) -> DataFrame:
    """`match_terms` for whole words and a list of such: runs of letters and digits that are in the list.

    Texts are taken a chunk of rows at a time. A chunk sends each distinct word that passes a bit set of the list once, with the
    numbers of the places it has in the chunk, and one row with the keys and the last place of each text. The words the list knows
    meet again by chunk and are put in order there; a frequent word costs one row per chunk."""
    allowed = df.sparkSession.sparkContext.broadcast(_gram_filter(listed.select(F.xxhash64("term").alias("term_gram")), n_terms))
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{LETTER}+"), F.lit(0))
    rows = df.select(*keys, words.alias("searched_words"))
    rows = rows.withColumn("word_keys", F.transform("searched_words", lambda word: F.xxhash64(word)))
    of_keys = [rows.schema[c] for c in keys]
    held_type = ArrayType(StructType([*of_keys, StructField("words_end", IntegerType())]))
    schema = StructType([*StructType.fromDDL("chunk long, term string, at array<int>").fields, StructField("held", held_type)])

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filtered = allowed.value
        mask = np.uint64(64 * len(filtered) - 1)
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            of_words, of_hashes = batch.column("searched_words"), batch.column("word_keys")
            ends = of_words.offsets.to_numpy()
            begin = 0
            while begin < batch.num_rows:
                stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + chunk_words, "right")) - 1)
                first, n = int(ends[begin]), int(ends[stop] - ends[begin])
                low = of_hashes.values.slice(first, n).to_numpy().view(np.uint64) & mask
                places = np.flatnonzero(filtered[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1))
                coded = of_words.values.slice(first, n).take(pa.array(places)).dictionary_encode()
                numbers = coded.indices.to_numpy()
                cuts = np.concatenate([[0], np.bincount(numbers, minlength=len(coded.dictionary)).cumsum()])
                at = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(places[numbers.argsort(kind="stable")], pa.int32()))
                held = pa.StructArray.from_arrays(
                    [*[batch.column(c).slice(begin, stop - begin) for c in keys], pa.array(ends[begin + 1 : stop + 1] - first, pa.int32())],
                    [*keys, "words_end"],
                )
                count = len(coded.dictionary)
                # the row with the keys goes by a term that no word equals
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count + 1, chunk)), pa.concat_arrays([coded.dictionary, pa.array([f" {chunk}"])]),
                        pa.concat_arrays([at, pa.nulls(1, at.type)]),
                        pa.concat_arrays([pa.nulls(count, pa.list_(held.type)), pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)]),
                    ],
                    schema.names,
                )
                begin, chunk = stop, chunk + 1

    def texts(chunk: pa.Table) -> pa.Table:
        whole = chunk.combine_chunks()
        is_key = pc.is_valid(whole["held"])
        held = whole.filter(is_key)["held"].combine_chunks().flatten()
        known = whole.filter(pc.invert(is_key)).select(["term", "at"]).combine_chunks()
        at = known["at"].combine_chunks()
        place = at.flatten().to_numpy()
        order = place.argsort()
        found = known["term"].combine_chunks().take(pc.list_parent_indices(at).take(pa.array(order)))
        cuts = np.concatenate([[0], np.searchsorted(place[order], held.field("words_end").to_numpy())])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found), " ")
        return pa.Table.from_arrays([*[held.field(c) for c in keys], joined], [*keys, "terms"])

    known = listed.withColumn("known", F.lit(True))
    met = rows.mapInArrow(chunks, schema).join(known, "term", "left").filter("known OR held IS NOT NULL").drop("known")
    return met.groupBy("chunk").applyInArrow(texts, StructType([*of_keys, *StructType.fromDDL("terms string").fields]))


def _gram_keys(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit number for each `width` code points in a row."""
    out = np.full(max(len(codes) - width + 1, 0), width, np.uint64)
    for j in range(width):
        out = (out + codes[j : j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def rare_grams(listed: DataFrame, width: int) -> DataFrame:
    """(term, size, offset, term_gram): each term with that of its grams of `width` letters (or fewer, if it is shorter) which
    the fewest terms of the list have."""

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column(0).to_pylist()
            keys = [_gram_keys(_codes(t), min(len(t), width)).view(np.int64) for t in terms]
            counts = [len(k) for k in keys]
            owner = np.repeat(np.arange(len(terms)), counts)
            offsets = [np.arange(n, dtype=np.int32) for n in counts]
            flat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(flat(offsets, np.int32)), pa.array(flat(keys, np.int64))],
                ["term", "offset", "term_gram"],
            )

    every = listed.mapInArrow(grams, "term string, offset int, term_gram long")
    common = every.groupBy("term_gram").agg(F.count(F.lit(1)).alias("held_by"))
    rarest = F.min(F.struct("held_by", "term_gram", "offset")).alias("rarest")
    return every.join(common, "term_gram").groupBy("term").agg(rarest).select(
        "term", F.length("term").alias("size"), "rarest.offset", "rarest.term_gram"
    )


def _gram_filter(keyed: DataFrame, n_terms: int) -> np.ndarray:
    """A bit for each of so many remainders of the grams: one in sixteen is set, or more if there are too many terms."""
    bits = 1 << min(max(10, (16 * n_terms - 1).bit_length()), MAX_FILTER_BITS)
    place = F.col("term_gram").bitwiseAND(F.lit(bits - 1))
    words = keyed.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(term_gram & 63 AS int))")).alias("bits"))
    out = np.zeros(bits >> 6, np.int64)
    found = words.toPandas()  # at most bits / 64 rows
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def _gram_hits(
    df: DataFrame, keys: Sequence[str], text: str, keyed: DataFrame, n_terms: int, widths: Sequence[int], longest: int
) -> DataFrame:
    """(keys, row, place, gram, around, at): the places of the texts whose grams may be those of a term, with as many letters
    around as the longest term needs, and one place without a gram for each row."""
    spark = df.sparkSession
    allowed = spark.sparkContext.broadcast(_gram_filter(keyed, n_terms))
    rows = df.select(*keys, F.monotonically_increasing_id().alias("row"), F.coalesce(text, F.lit("")).alias("searched_text"))
    kept = [*keys, "row"]
    schema = StructType([*[rows.schema[c] for c in kept], *StructType.fromDDL("place int, gram long, around string, at int").fields])
    reach = longest + 1

    def hits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filtered = allowed.value
        mask = np.uint64(64 * len(filtered) - 1)

        def cut(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
            owner, place, gram, around, at = zip(*found)
            columns = [batch.column(c).take(pa.array(owner)) for c in kept]
            columns += [pa.array(place, pa.int32()), pa.array(gram, pa.int64()), pa.array(around, pa.string()), pa.array(at, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            found, held = [], 0
            for i, value in enumerate(batch.column("searched_text").to_pylist()):
                found.append((i, None, None, None, None))
                codes = _codes(value)
                for width in widths:
                    grams = _gram_keys(codes, width)
                    low = grams & mask
                    bit = filtered[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1)
                    for place in np.flatnonzero(bit).tolist():
                        begin = max(0, place - reach)
                        piece = value[begin : place + reach]
                        found.append((i, place, int(grams[place].view(np.int64)), piece, place - begin))
                        held += len(piece)
                    if held > MAX_BATCH_CHARS:
                        yield cut(batch, found)
                        found, held = [], 0
            if found:
                yield cut(batch, found)

    return rows.mapInArrow(hits, schema)


def dictionary_words(
    df: DataFrame, terms: DataFrame, keys: Sequence[str], text: str = "text", max_terms: int = MAX_BROADCAST_TERMS
) -> DataFrame:
    """(keys, words), a row for each row of `df`: the distinct white-space separated words of the text that the list knows,
    sorted and joined by a space.

    A list of checked size is looked up within the row; a larger one is joined, whose words are gathered per row."""
    listed = terms.select(F.col("term").alias("word")).filter("word IS NOT NULL").distinct()
    split = F.array_distinct(F.split(F.coalesce(text, F.lit("")), r"\s+"))
    size = listed.agg(F.count("word").alias("terms"), F.sum(F.length("word")).alias("chars")).first()
    if size["terms"] <= max_terms and (size["chars"] or 0) <= MAX_BROADCAST_CHARS:
        known = [row["word"] for row in listed.collect()]
        kept = F.filter(split, lambda word: word.isin(known)) if known else F.array().cast("array<string>")
        return df.select(*keys, F.array_join(F.array_sort(kept), " ").alias("words"))
    numbered = df.withColumn("row", F.monotonically_increasing_id())  # before the words, so that they share it
    rows = numbered.select(*keys, "row", F.explode_outer(split).alias("word"))
    found = rows.join(listed.withColumn("known", F.lit(True)), "word", "left")
    kept = F.array_sort(F.collect_list(F.when(F.col("known"), F.col("word"))))
    return found.groupBy("row", *keys).agg(F.array_join(kept, " ").alias("words")).drop("row")


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(term, n) over the whole table."""
    return df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _deletions(word: Column, distance: int) -> Column:
    """The word and everything left of it when up to `distance` letters are taken out. Letters go from left to
    right, so every choice of letters is made once."""

    def one_less(item: Column) -> Column:
        rest, begin = item["rest"], item["begin"]
        places = F.when(begin <= F.length(rest), F.sequence(begin, F.length(rest))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            places,
            lambda place: F.struct(
                F.concat(F.substring(rest, F.lit(1), place - 1), F.substring(rest, place + 1, F.length(rest))).alias("rest"),
                place.alias("begin"),
            ),
        )

    level = F.array(F.struct(word.alias("rest"), F.lit(1).alias("begin")))
    levels = [level]
    for _ in range(distance):
        level = F.flatten(F.transform(level, one_less))
        levels.append(level)
    return F.array_distinct(F.transform(F.concat(*levels), lambda item: item["rest"]))


def correct_spelling(tokens: DataFrame, dictionary: DataFrame, max_distance: int = 2) -> DataFrame:
    """(term, corrected, distance) for the distinct `term`s of `tokens`. A term the dictionary (term, n)
    has stays; others become the nearest dictionary term within `max_distance` edits, the more frequent
    one on a tie, then the first by name; NULL distance and no change if there is none.

    Two words within d edits share a string reached by at most d deletions from both, so an equi-join on
    those strings finds all candidates. Terms too long for any dictionary word are left out before their
    deletions are made; whole words are used as join strings, so the words that meet at one string are
    all within 2d edits of each other."""
    known = dictionary.groupBy("term").agg(F.sum("n").alias("n"))
    terms = tokens.select("term").distinct()
    longest = known.agg(F.max(F.length("term"))).scalar()
    # a term becomes a hundred rows, so it is spread by number: adaptive execution would merge the small input
    tasks = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unknown = terms.join(known.select("term"), "term", "left_anti").repartition(tasks)
    wanted = unknown.filter(F.length("term") <= longest + max_distance).select(
        "term", F.explode(_deletions(F.col("term"), max_distance)).alias("rest")
    )
    offered = known.select(
        F.col("term").alias("candidate"), "n", F.explode(_deletions(F.col("term"), max_distance)).alias("rest")
    )
    near = F.levenshtein("term", "candidate", max_distance)
    rank = F.struct("distance", (-F.col("n")).alias("rarity"), "candidate")
    best = (
        wanted.join(offered, "rest")
        .filter(F.abs(F.length("term") - F.length("candidate")) <= max_distance)
        .withColumn("distance", near)
        .filter("distance >= 0")
        .groupBy("term")
        .agg(F.min(rank).alias("best"))
        .select("term", F.col("best.candidate").alias("corrected"), F.col("best.distance").alias("distance"))
    )
    kept = known.select("term", F.col("term").alias("corrected"), F.lit(0).alias("distance"))
    return (
        terms.join(best.unionByName(kept), "term", "left")
        .select("term", F.coalesce("corrected", "term").alias("corrected"), "distance")
    )


def sentence_rows(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, sentence number from 0, sentence)."""
    return df.select(*keys, F.posexplode(sentences(F.col(text))).alias("sentence_no", "sentence"))


def sentence_sentiment(
    df: DataFrame, lexicon: DataFrame, negators: Sequence[str], keys: Sequence[str], text: str = "text"
) -> DataFrame:
    """(keys, sentence_no, score): the sum of the polarities of a sentence's words in the lexicon (term,
    polarity); the word right after a negator counts reversed. Sentences without such words score 0."""
    tokens = word_tokens(F.col("sentence"))
    # each word with the one before it; nothing else of the sentence rides along
    pairs = F.zip_with(tokens, F.concat(F.array(F.lit("")), tokens), lambda word, before: F.struct(word.alias("term"), before.alias("after")))
    words = sentence_rows(df, keys, text).select(*keys, "sentence_no", F.explode_outer(pairs).alias("pair")).select(
        *keys, "sentence_no", "pair.term", "pair.after"
    )
    listed = lexicon.groupBy("term").agg(F.sum("polarity").alias("polarity"))
    size = listed.agg(F.count("term").alias("terms"), F.sum(F.length("term")).alias("chars")).first()
    if size["terms"] <= MAX_BROADCAST_TERMS and (size["chars"] or 0) <= MAX_BROADCAST_CHARS:
        listed = F.broadcast(listed)  # words are scored where they are; only sums per sentence are shuffled
    sign = F.when(F.col("after").isin(list(negators)), F.lit(-1)).otherwise(F.lit(1))
    return words.join(listed, "term", "left").groupBy(*keys, "sentence_no").agg(
        F.coalesce(F.sum(F.col("polarity") * sign), F.lit(0)).cast("double").alias("score")
    )
