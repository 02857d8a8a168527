"""Operator 6: line dedup by an exact set-similarity join, in DataFrame functions.

A line is the set of its words; a line goes when an earlier line of the whole
table has a Jaccard similarity of 0.8 or more with it.  Earlier
means: smaller doc_id (null last), then smaller line number.  A document keeps
its row even if none of its lines is left.

Lines of equal word sets form one class; all but the first of a class go.
Between classes: words become 64-bit ids in order of rarity (all words of the
table are counted in 2^20 hash buckets; the upper 7 bits of an id are the
logarithm of the count, the others the word's hash).  For Jaccard 0.8 two sets
of n words must share one of their floor(0.2 n) + 1 rarest, so each class is
indexed under these (prefix filter); joined pairs must fit in length and in what
can still match after the shared word (positional filter).  The Jaccard
similarity of what is left is computed on the words themselves.

Two classes must further differ in no more than (n + m) / 9 words, and no fewer
than the bits in which their 128-bit parity sketches differ, which leaves few
pairs that are not similar.

Only the first line of a class can still be in question, and one similar class
that began earlier settles it.  A prefix word found at most ``CROWD`` times in
the whole table is a key by itself.  A more frequent one is a key together with
each later word of a prefix that is longer by one word: two similar sets share
two words there.  So the classes under a key do not grow with the table, unless
they are alike.  (Sets of more than ``LONG`` words would have too many such keys;
they and all they can be similar to meet under frequent words alone.)

A class is compared with a few earlier ones first: with the earliest one under a key
of more than ``CROWD`` classes, and, under its rarest words of more than about ``BUSY``,
with the ``FIRST`` there and those some places before it (``BACK``).  What these settle
looks at no other class; each class left over meets all earlier ones under its keys
that fit.  So the result is that of all pairs, and groups of many similar lines cost a
few pairs per line.
Lines of fewer than 4 different words can only be similar when equal and are
not joined.

Defined results: null text has no lines and stays null; blank lines stay;
documents of equal doc_id are ordered by a hash of their text, and rows equal in
both keep and lose the same lines; further columns stay as they are; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pixelframe.functions.ranges import global_index
from pixelframe.llm.base import WS, discard, read_table, stored

BUCKET_BITS = 20
_REST = (1 << 56) - 1  # the bits of a word's hash that its id keeps
CROWD = 4096
LONG = 256
BUSY = 512
BUSY_KEYS = 4
FIRST = (1, 2)
BACK = (1, 2, 4, 8, 16, 64)
BROADCAST_ROWS = 1_000_000


def _cut(text: Column) -> Column:
    """Cut at single spaces, the fast way, unless there is other white space; may hold empty words."""
    odd = text.contains("\t") | text.contains("\r") | text.contains("\x0b") | text.contains("\x0c")
    return F.when(odd, F.split(text, WS)).otherwise(F.split(text, " "))


def line_words(line: Column) -> Column:
    """Words of a line."""
    return F.array_remove(_cut(line), "")


def _bucket(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BUCKET_BITS).cast("int")


def word_levels(docs: DataFrame) -> Column:
    """The rarity of the words in each of the 2^20 hash buckets, as a constant of
    one byte a bucket: 1 (none) to 127, three steps for each doubling of the
    number of words in the bucket over the whole table."""
    words = docs.select(F.explode(_cut(F.replace(docs["text"], F.lit("\n"), F.lit(" ")))).alias("w")).where("w != ''")
    none = docs.sparkSession.range(1 << BUCKET_BITS).select(F.col("id").cast("int").alias("b"), F.lit(0).alias("n"))
    counts = words.select(_bucket(F.xxhash64("w")).alias("b"), F.lit(1).alias("n")).union(none).groupBy("b").agg(F.sum("n").alias("n"))
    level = F.least(F.lit(127), F.floor(F.log2(F.col("n") + 1) * 3).cast("int") + 1)
    runs = stored(counts.groupBy(F.shiftright("b", 12).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("b", F.char(level).alias("level")))).alias("found")).select(
        "run", F.array_join("found.level", "").alias("levels")), "levels")
    levels = "".join(r["levels"] for r in runs.orderBy("run").collect())
    discard(runs)
    return F.lit(bytearray(levels, "ascii"))


def _word_ids(words: Column, levels: Column) -> Column:
    """Distinct word ids, rarest first: the level of the word's bucket, then 56 bits of its hash."""

    def word_id(hashed: Column) -> Column:
        level = F.ascii(F.substring(levels, _bucket(hashed) + 1, F.lit(1)).cast("string"))
        return F.shiftleft(level.cast("long"), 56).bitwiseOR(hashed.bitwiseAND(F.lit(_REST)))

    hashes = F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))
    return F.sort_array(F.transform(hashes, word_id))


def _place(table: str = "") -> Column:
    c = (lambda n: F.col(f"{table}.{n}")) if table else F.col
    return F.struct(c("doc_id").isNull().alias("last"), c("doc_id").alias("doc_id"),
                    c("text_hash").alias("text_hash"), c("line_no").alias("line_no"))


def _lines(docs: DataFrame) -> DataFrame:
    cut = docs.where(docs["text"].isNotNull()).select(
        docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"),
        F.split(docs["text"], "\n").alias("lines"))
    return cut.select("doc_id", "text_hash", F.posexplode("lines").alias("line_no", "line"))


def index_lines(docs: DataFrame, levels: Column) -> DataFrame:
    """(doc_id, text_hash, line_no, k1, k2, n, sketch, sketch2, prefix) of every
    line with a word: its class (two hashes of its word set), its number of
    different words, the two halves of their parity sketch and the ids of the rarest
    of them, one more than the prefix filter needs."""
    some = F.length(F.ltrim("line", F.lit(" \t\r\x0b\x0c"))) > 0  # a filter on the words would cut them twice
    ids = _lines(docs).where(some).select("doc_id", "text_hash", "line_no", _word_ids(line_words(F.col("line")), levels).alias("ids"))
    n = F.size("ids")
    # n - ceil(0.8 n) + 2 in whole numbers: similar sets share one word even without the last of these, and two with it
    length = F.when(n < 4, F.lit(0)).otherwise(F.floor(n / 5).cast("int") + 2)

    def parity(bit) -> Column:  # of how many ids fall on each of 64 bits; a shift of a long takes the lowest six bits
        return F.aggregate("ids", F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(F.call_function(
            "shiftleft", bit(x), F.shiftright(x, 33).cast("int"))))

    half = parity(lambda x: F.shiftright(x, 39).bitwiseAND(F.lit(1).cast("long")))
    whole = parity(lambda x: F.lit(1).cast("long"))
    return ids.select("doc_id", "text_hash", "line_no", F.xxhash64("ids").alias("k1"),
                      F.xxhash64(F.lit(1), "ids").alias("k2"), n.alias("n"), half.alias("half"), whole.alias("whole"),
                      F.slice("ids", F.lit(1), length).alias("prefix")).select(
        "doc_id", "text_hash", "line_no", "k1", "k2", "n", F.col("half").alias("sketch"),
        F.col("half").bitwiseXOR(F.col("whole")).alias("sketch2"), "prefix")


def _fits(x: str, y: str) -> Column:
    """Length, parity and positional filters between two prefix rows of a word, ``y`` earlier."""
    c = F.col
    return ((c(f"{y}.o") < c(f"{x}.o"))
            & ((F.bit_count(c(f"{x}.sketch").bitwiseXOR(c(f"{y}.sketch")))
                + F.bit_count(c(f"{x}.sketch2").bitwiseXOR(c(f"{y}.sketch2")))) * 9 <= c(f"{x}.n") + c(f"{y}.n"))
            & (F.least(f"{x}.n", f"{y}.n") * 5 >= F.greatest(f"{x}.n", f"{y}.n") * 4)
            & ((F.least(f"{x}.at", f"{y}.at") + F.least(c(f"{x}.n") - c(f"{x}.at"), c(f"{y}.n") - c(f"{y}.at"))) * 9
               >= (c(f"{x}.n") + c(f"{y}.n")) * 4))


def _met(later: DataFrame, earlier: DataFrame) -> DataFrame:
    """(a, b): classes ``a`` that began before ``b``, share a prefix word and fit."""
    x, y = later.hint("merge").alias("x"), earlier.hint("merge").alias("y")
    return x.join(y, (F.col("x.word") == F.col("y.word")) & _fits("x", "y")).select(
        F.col("y.o").alias("a"), F.col("x.o").alias("b")).distinct()


def _open_met(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """``_met`` of the rows that are not of ``settled`` (o, known) with all of them.  What
    tells them (``upto``: o, or -1) is named on both sides of one condition, so
    that both are the same rows and share one exchange."""
    upto = F.coalesce(F.when(F.col("known").isNull(), F.col("o")), F.lit(-1).cast("long"))  # never null, or one side is filtered
    rows = rows.join(settled, "o", "left").select(*rows.columns, upto.alias("upto")).hint("merge")
    x, y = rows.alias("x"), rows.alias("y")
    asks = F.greatest("y.o", "y.upto") < F.col("x.upto")
    return x.join(y, (F.col("x.word") == F.col("y.word")) & asks & _fits("x", "y")).select(
        F.col("y.o").alias("a"), F.col("x.o").alias("b")).distinct()


def _keys(classes: DataFrame, crowd: int, long: int) -> tuple[DataFrame, DataFrame]:
    """(word, o, n, at, sketch, sketch2): the keys of the classes, those that are
    rare words (of at most ``crowd`` classes each) and those of frequent words;
    ``at`` is the place of the word, for a pair of words that of the rarer one."""

    def rare(word: Column) -> Column:
        return F.shiftrightunsigned(word, 56) <= _rarity(crowd)

    about = ["o", "n", "sketch", "sketch2"]
    some = classes.where(F.size("prefix") > 0)
    words = F.slice("prefix", F.lit(1), F.size("prefix") - 1)
    alone = some.select(*about, F.posexplode(words).alias("at", "word")).where(rare(F.col("word")))
    often = some.where(F.exists(words, lambda w: ~rare(w))).select(*about, "prefix", F.posexplode(words).alias("at", "word"))
    often = often.where(~rare(F.col("word")))
    later = F.slice("prefix", F.col("at") + 2, F.size("prefix"))
    pairs = F.when(F.col("n") <= long, F.transform(later, lambda v: F.xxhash64("word", v))).otherwise(F.array().cast("array<long>"))
    # a set of more than ``long`` words and one that can be similar to it
    single = F.when(F.col("n") * 5 > long * 4, F.array(F.xxhash64("word"))).otherwise(F.array().cast("array<long>"))
    often = often.select(*about, "at", F.explode(F.concat(pairs, single)).alias("word"))
    columns = ["word", "o", "n", "at", "sketch", "sketch2"]
    return alone.select(columns), often.select(columns)


def _rarity(words: int) -> int:
    """The highest level of buckets that surely have no more than ``words`` words."""
    return math.floor(3 * math.log2(words + 1))


def _beside(classes: DataFrame, busy: int, crowd: int) -> DataFrame:
    """(a, b): every class under its ``BUSY_KEYS`` rarest prefix words of more than about
    ``busy`` and at most ``crowd`` classes, beside those that fit of the word's earliest
    classes (``FIRST``) and of those some places before it (``BACK``): a few pairs for a class."""
    level = lambda w: F.shiftrightunsigned(w, 56)
    words = F.slice("prefix", F.lit(1), F.size("prefix") - 1)
    at = F.size(F.filter(words, lambda w: level(w) <= _rarity(busy)))  # rarest first
    some = classes.where(F.size("prefix") > 0).select("o", "n", "sketch", "sketch2", words.alias("words"), at.alias("at"))
    rows = reduce(DataFrame.union, [some.withColumn("at", F.col("at") + k).withColumn("word", F.get("words", F.col("at")))
                                    for k in range(BUSY_KEYS)]).where(level(F.col("word")) <= _rarity(crowd))
    order = Window.partitionBy("word").orderBy("o")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    about = F.struct("o", "n", "at", "sketch", "sketch2")
    others = {f"first{i}": F.nth_value(about, i).over(so_far) for i in FIRST} | {f"back{i}": F.lag(about, i).over(order) for i in BACK}
    found = rows.select("o", about.alias("x"), *[c.alias(name) for name, c in others.items()])
    met = F.array_compact(F.array(*[F.when(_fits("x", y), F.col(f"{y}.o")) for y in others]))
    return found.select(F.explode(F.array_distinct(met)).alias("a"), F.col("o").alias("b"))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _similar(docs: DataFrame, pairs: DataFrame, classes: DataFrame, broadcast_rows: int) -> DataFrame:
    """(b,) of the pairs whose word sets have the similarity, by the words themselves."""
    used = pairs.select(F.col("a").alias("o")).union(pairs.select(F.col("b").alias("o"))).distinct()
    reps = stored(classes.join(used, "o").select("o", "n", "place.doc_id", "place.text_hash", "place.line_no"), "reps")
    lines = _lines(docs).alias("l")
    r = _sized(reps, broadcast_rows).alias("r")
    same = (F.col("l.text_hash") == F.col("r.text_hash")) & (F.col("l.line_no") == F.col("r.line_no")) \
        & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
    # the different words as one string, a third of the size of an array of them
    spelled = stored(lines.join(r, same).select("o", "n", F.array_join(F.array_distinct(line_words(F.col("line"))), " ").alias("words"))
                     .dropDuplicates(["o"]), "spelled")
    x = spelled.select(F.col("o").alias("a"), F.col("words").alias("x"), F.col("n").alias("nx"))
    y = spelled.select(F.col("o").alias("b"), F.col("words").alias("y"), F.col("n").alias("ny"))
    shared = F.size(F.array_intersect(F.split("x", " "), F.split("y", " ")))
    found = stored(pairs.join(x, "a").join(y, "b").where(shared * 9 >= (F.col("nx") + F.col("ny")) * 4).select("b").distinct(), "similar")
    discard(reps, spelled)
    return found


def similar_classes(docs: DataFrame, classes: DataFrame, broadcast_rows: int, crowd: int = CROWD, long: int = LONG,
                    busy: int = BUSY) -> DataFrame:
    """(o,) of the classes that are similar to a class which began earlier."""
    alone, often = _keys(classes, crowd, long)
    counts = often.groupBy("word").agg(F.count("*").alias("c")).where(F.col("c") > crowd)
    hot = stored(counts.select("word"), "hot")
    hot_words = _sized(hot, broadcast_rows)
    bounded = often.join(hot_words, "word", "left_anti").select(often.columns)
    crowded = stored(often.join(hot_words, "word", "left_semi").select(often.columns), "crowded")
    earliest = crowded.groupBy("word").agg(F.min(F.struct(*often.columns[1:])).alias("e")).select("word", "e.*")
    pairs = stored(_beside(classes, busy, crowd).union(_met(crowded, earliest)).distinct(), "pairs")
    settled = _similar(docs, pairs, classes, broadcast_rows).withColumnRenamed("b", "o")
    known = _sized(settled.withColumn("known", F.lit(True)), broadcast_rows)
    rest = crowded.join(settled, "o", "left_anti").select(crowded.columns)
    more = stored(_open_met(alone.union(bounded), known).union(_met(rest, crowded)).join(pairs, ["a", "b"], "left_anti").distinct(), "pairs")
    discard(hot, crowded, pairs)
    if more.isEmpty():
        return settled
    return settled.union(_similar(docs, more, classes, broadcast_rows))


def removed_lines(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS, crowd: int = CROWD, long: int = LONG,
                  busy: int = BUSY) -> DataFrame:
    """(doc_id, text_hash, line_no) of the lines that go."""
    indexed = stored(index_lines(docs, word_levels(docs)), "indexed")
    # what depends on the words alone is the same in every line of a class
    firsts = indexed.groupBy("k1", "k2").agg(F.min(_place()).alias("place"), *[
        F.first(c).alias(c) for c in ("n", "sketch", "sketch2", "prefix")])
    ordered = global_index(firsts, [F.col("place"), F.col("k1"), F.col("k2")], "o")
    classes = stored(ordered, "classes")
    discard(ordered)
    places = stored(indexed.select("k1", "k2", _place().alias("place")), "places")
    discard(indexed)
    near = similar_classes(docs, classes, broadcast_rows, crowd, long, busy).withColumn("near", F.lit(True))
    first = classes.select("k1", "k2", "o", F.col("place").alias("first")).join(near, "o", "left").drop("o")
    gone = stored(places.join(first, ["k1", "k2"]).where("near or place > first").select("place.*"), "gone")
    discard(places, classes)
    return gone


def drop_lines(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS, crowd: int = CROWD, long: int = LONG,
               busy: int = BUSY) -> DataFrame:
    """``docs`` with ``__n_lines`` and ``__removed`` (line numbers) added and the lines gone from ``text``."""
    gone = removed_lines(docs, broadcast_rows, crowd, long, busy)
    r = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("__removed"))  # lines of one text
    r = r.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__removed")
    if gone.count() <= broadcast_rows:
        r = F.broadcast(r)
    joined = docs.join(r, docs["doc_id"].cast("long").eqNullSafe(F.col("__id"))
                       & (F.xxhash64(docs["text"]) == F.col("__hash")), "left")
    joined = joined.withColumn("__lines", F.split("text", "\n")).withColumn(
        "__n_lines", F.coalesce(F.size("__lines"), F.lit(0)))
    kept = F.array_except(F.sequence(F.lit(0), F.col("__n_lines") - 1), F.col("__removed"))
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n"))
    return joined.withColumn("text", text).drop("__id", "__hash", "__lines")


def dedup(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS, crowd: int = CROWD, long: int = LONG,
          busy: int = BUSY) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed, text) for every row of ``docs`` (doc_id, text)."""
    out = drop_lines(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]), broadcast_rows, crowd, long, busy)
    gone = F.coalesce(F.sort_array("__removed"), F.array().cast("array<int>"))
    return out.select("doc_id", F.col("__n_lines").cast("long").alias("n_lines"),
                      F.size(gone).cast("long").alias("n_removed"), F.array_join(gone, ",").alias("removed"), "text")


def without_repeated_lines(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with all columns, its later similar lines gone and ``n_chars``, if there, counted again."""
    out = drop_lines(docs, broadcast_rows)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op6_lines(spark, sf_dir) -> DataFrame:
    return dedup(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH l AS (SELECT doc_id, line_no, line, doc_id * 100000000 + line_no AS place,
                  list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS w
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                        unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents)),
g AS (SELECT w, min(place) AS first, row_number() OVER () AS id FROM l WHERE len(w) > 0 GROUP BY w),
t AS (SELECT id, len(w) AS n, unnest(w) AS x FROM g WHERE len(w) >= 4),
df AS (SELECT x, count(*) AS df FROM t GROUP BY x),
r AS (SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY df, x) AS k FROM t JOIN df USING (x)),
p AS (SELECT DISTINCT a.id AS a, b.id AS b FROM r a JOIN r b USING (x)
      WHERE a.id < b.id AND a.k <= a.n // 5 + 1 AND b.k <= b.n // 5 + 1
        AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
near AS (SELECT DISTINCT CASE WHEN x.first < y.first THEN y.id ELSE x.id END AS id
         FROM p JOIN g x ON x.id = p.a JOIN g y ON y.id = p.b
         WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (len(x.w) + len(y.w))),
gone AS (SELECT l.place FROM l JOIN g USING (w) WHERE l.place > g.first OR g.id IN (SELECT id FROM near)),
m AS (SELECT l.*, gone.place IS NOT NULL AS out FROM l LEFT JOIN gone USING (place))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (out) AS BIGINT) AS n_removed,
       coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (out), '') AS removed,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT out), '') AS text
FROM m GROUP BY doc_id
"""
