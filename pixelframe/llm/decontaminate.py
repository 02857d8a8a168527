"""Operator 8: benchmark decontamination by winnowing, in DataFrame functions.

Texts are lower-cased (A-Z) and cut into words.  A window is 10 consecutive
words of a benchmark item; an item of fewer words, but not none, is one window.
A document word inside any occurrence of a window is hit.

Winnowing: of every 6 consecutive 5-word hashes the smallest is kept, in
documents and in benchmark windows alike, so every shared span of 10 words
shares a kept hash at the same place.  An equality join on the kept hashes
gives possible window starts; each is extended to the whole window, and only
equal words count.  Items of fewer than 10 words have no winnowing guarantee:
for each such length in the benchmark, all spans of that length are hashed.

Work goes by distinct text (MD5), so copies of a text are matched once.
Benchmark tables are broadcast only up to ``BROADCAST_ROWS`` rows, counted
first; beyond that the joins shuffle.

Defined results: null or empty text has no words and no hits; a benchmark item
without words matches nothing; repeated benchmark rows count once per item_id;
a null item_id counts as the empty string; ``items_sha256`` of no item is the
SHA-256 of the empty string; equal documents get equal results; further columns
are ignored; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pixelframe.llm.base import lower_ascii, read_table, split_words, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
K = 5
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return split_words(lower_ascii(text), SEPARATORS)


def _gram_hash(words: str, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), i + d) for d in range(k)])


def _grams(words: str, k: int) -> Column:
    """Hash of the k words from each position on; none where fewer are left."""
    return F.slice(F.transform(F.col(words), lambda _, i: _gram_hash(words, i, k)),
                   F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0)))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, span, words): every window of every item."""
    b = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item_id"),
                         words_of(benchmark["text"]).alias("w"))
    b = b.where(F.size("w") > 0).withColumn("span", F.least(F.size("w"), F.lit(size)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("span") + 1)
    return b.select("item_id", "span", "w", F.explode(starts).alias("at")).select(
        "item_id", "span", F.slice("w", F.col("at"), F.col("span")).alias("words")).distinct()


def _window_prints(wins: DataFrame, size: int, k: int) -> DataFrame:
    """(f, offset) of full windows: the smallest k-word hash and where it is, the rightmost of equal ones."""
    g = wins.where(F.col("span") == size).select("words").distinct().withColumn("g", _grams("words", k))
    best = F.array_min(F.transform("g", lambda h, i: F.struct(h.alias("f"), (-i).alias("back"))))
    return g.select(best.alias("b")).select(F.col("b.f").alias("f"), (-F.col("b.back")).alias("offset")).distinct()


def _document_prints(texts: DataFrame, size: int, k: int) -> DataFrame:
    """(key, f, p): hashes that are the smallest of some window of ``size`` words around them."""
    n = size - k + 1
    d = texts.where(F.size("w") >= size).select("key", _grams("w", k).alias("g"))
    d = d.withColumn("low", F.transform("g", lambda h, i: F.least(h, *[F.get("g", i + j) for j in range(1, n)])))
    kept = F.filter(F.transform("g", lambda h, i: F.when(
        h == F.greatest(*[F.get("low", i - j) for j in range(n)]), F.struct(h.alias("f"), i.alias("p")))),
        lambda s: s.isNotNull())
    return d.select("key", F.inline(kept))


def _sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def match(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, k: int = K,
          broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(occurrences, items): ``occurrences`` has (key, start, span), the places of
    benchmark windows in each distinct text (``key``: MD5); ``items`` (key, item_id)."""
    wins = stored(windows(benchmark, size), "windows")
    texts = docs.where(docs["text"].isNotNull()).select(F.md5(docs["text"]).alias("key"), docs["text"].alias("text"))
    tokens = texts.select("key", words_of(F.col("text")).alias("w"))
    prints = _sized(stored(_window_prints(wins, size, k), "prints"), broadcast_rows)
    starts = _document_prints(tokens, size, k).join(prints, "f").select(
        "key", (F.col("p") - F.col("offset")).alias("start"), F.lit(size).alias("span")).where("start >= 0")
    for r in wins.where(F.col("span") < size).select("span").distinct().collect():  # fewer than ``size`` lengths
        short = _sized(wins.where(F.col("span") == r.span).select(
            _gram_hash("words", F.lit(0), r.span).alias("f")).distinct(), broadcast_rows)
        spans = tokens.where(F.size("w") >= r.span).select("key", F.posexplode(_grams("w", r.span)).alias("start", "f"))
        starts = starts.union(spans.join(short, "f").select("key", "start", F.lit(r.span).alias("span")))
    starts = stored(starts.distinct(), "starts")
    by_text = starts.groupBy("key").agg(F.collect_list(F.struct("start", "span")).alias("at"))  # within one text
    found = texts.join(_sized(by_text.select("key"), broadcast_rows), "key", "left_semi").dropDuplicates(["key"])
    found = found.join(by_text, "key").select("key", "at", words_of(F.col("text")).alias("w"))
    spelled = found.select("key", F.explode(F.transform("at", lambda a: F.struct(
        a["start"].alias("start"), a["span"].alias("span"),
        F.array_join(F.slice("w", a["start"] + 1, a["span"]), " ").alias("spelled")))).alias("a")).select("key", "a.*")
    spelled = spelled.where(F.size(F.split("spelled", " ")) == F.col("span"))
    by_spelling = wins.select(F.array_join("words", " ").alias("spelled"), "item_id")
    hits = stored(spelled.join(by_spelling, "spelled").select("key", "start", "span", "item_id"), "hits")
    return hits.select("key", "start", "span").distinct(), hits.select("key", "item_id").distinct()


def covered(at: Column) -> Column:
    """Number of words under an array of (start, span), each word once."""
    first = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc, a):
        end = F.greatest(acc["end"], a["start"] + a["span"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], F.least(a["start"], end))).alias("n"))

    return F.aggregate(F.sort_array(at), first, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs`` (doc_id, text)."""
    occurrences, items = match(docs, benchmark, **options)
    hit = occurrences.groupBy("key").agg(F.collect_list(F.struct("start", "span")).alias("at")).select(
        "key", covered(F.col("at")).cast("long").alias("n_hit"))
    named = items.groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    per_text = hit.join(named, "key")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.size(split_words(docs["text"], r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"),
                       F.md5(docs["text"]).alias("key"))
    joined = rows.join(per_text, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                         F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    occurrences, _ = match(docs, benchmark, **options)
    key = F.coalesce(F.md5(docs["text"]), F.lit(""))
    dirty = occurrences.select(F.col("key").alias("__hit_key")).distinct()
    return docs.join(dirty, key == dirty["__hit_key"], "left_anti")


def op8_decontaminate(spark, sf_dir) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLE = rf"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_SQL_WORDS} AS w FROM benchmark),
bl AS (SELECT item, w, least(len(w), 10) AS span FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, span, array_to_string(w[i:i + span - 1], ' ') AS win
       FROM (SELECT item, w, span, unnest(range(1, len(w) - span + 2)) AS i FROM bl)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
spans AS (SELECT DISTINCT span FROM bw),
dw AS (SELECT r, i, span, array_to_string(w[i:i + span - 1], ' ') AS win
       FROM (SELECT r, w, span, unnest(range(1, len(w) - span + 2)) AS i FROM d, spans WHERE len(w) >= span)),
m AS (SELECT r, i, dw.span, item FROM dw JOIN bw USING (win) WHERE dw.span = bw.span),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + span)) AS x FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS ids
      FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(ids, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
