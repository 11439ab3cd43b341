"""The registered queries of the numbered operators, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.llm import (
    bitpack, boosting, decision_list, decontaminate, dominance, forest, packing, passages, pii, ranked, ring, runs, warc,
)
from notesight.llm.common import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary file, by its path; it is not part of the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    "op1_warc",
    """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
    ),
    f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
    SELECT page_id, CAST(n AS bigint) AS payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS bigint) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
        CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM p JOIN f USING (h)
    """,
)
def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    warc.write(warc.archived(table(spark, sf_dir, "pages"), "page_id", "url", "html"), folder)
    return warc.read(spark, folder).select(
        warc.page_of("record_id").alias("page_id"),
        # of a response the length of what was read, of a revisit what its HTTP headers say
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


@query("op2_bin_slack")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer(), end_id=0).drop("ids")


@query("op3_collinear_chains")
def shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared(table(spark, sf_dir, "documents").select("doc_id", "text"), least=50)


@query("op4_decision_list")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    judged = decision_list.judge(docs, rules, keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query("op5_bounded_ring")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("ring_key"),
    )
    placed = ring.assign(rows, F.col("ring_key"), shards=8, ties=["doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


LOWER_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op6_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, {LOWER_WORDS} AS w FROM documents),
    b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {LOWER_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS text
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)
    ),
    scanned AS (
        SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS text
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
    ),
    hits AS (SELECT doc_id, item_id, i, n FROM scanned JOIN windows USING (n, text)),
    hit_words AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
    ),
    hit_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS varchar) AS item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
)
def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


@query("op7_lsh_forest")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.groups(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2, percent=80)


@query("op8_deobfuscate")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    base = F.filter("spans", lambda s: ~s["disguised"])
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )


@query("op9_boosted_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    trees = boosting.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return boosting.score(docs, trees).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")


@query("op10_bit_packing")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bitpack.read(bitpack.write(docs, tokenizer(), end_id=2), with_ids=False)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: of every tenth document by a hash of the id, the words from some place on repeat a period."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", hashed.alias("h"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")).alias("w"))
    place = words.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10)).filter("h % 10 = 0 AND n > 0")
    period = place.withColumn("a", F.expr("g % n")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("transform(sequence(0L, n - 1L), i -> w[int(if(i < a, i, a + (i - a) % p))])")
    others = words.filter("NOT coalesce(h % 10 = 0 AND size(w) > 0, false)")
    return period.select("doc_id", F.array_join(again, " ").alias("text")).unionByName(others.select("doc_id", "text"))


@query("op11_minimizer_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.detect(docs, keep=["doc_id"], digests=True)
    first = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(first)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["s"]).alias("start"), best["length"].alias("length"),
        (-best["p"]).alias("period"), "runs_sha256", "collapsed_sha256",
    ).withColumn("exponent_milli", F.expr("1000 * length div period"))


@query("op12_dominance_packing")
def fewest_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dominance.pack(docs, tokenizer("word_bpe_49k.json"), end_id=0, with_ids=False)


TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    "op13_range_maxima",
    f"""
    WITH q AS (
        SELECT item_id, term, count(*) AS times
        FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark) GROUP BY ALL
    ),
    d AS (SELECT doc_id, {TERMS} AS w FROM documents),
    s AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM d WHERE len(w) > 0),
    tf AS (SELECT doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM d)
           WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS double) / CAST(2 * df + 1 AS double))) AS bigint) AS w FROM df, s
    ),
    impacts AS (
        SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + CAST((75 * n * n_docs) // n_terms AS bigint))) AS impact FROM tf, s
    ),
    scores AS (
        SELECT item_id, doc_id, CAST(sum(times * w * impact) AS bigint) AS score
        FROM q JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS integer) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 10
    """,
)
def best_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked.top(docs, table(spark, sf_dir, "benchmark"), k=10)
