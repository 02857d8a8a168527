"""Operator 9: quality rules by distribution divergence.

Two histograms of a document, its character classes and its common (function)
words, are compared with the reference of its language by Jensen-Shannon
distance.  References are the mean histograms of all documents of a language
that pass the base rules; the function words themselves are fixed lists.
A document is rejected when a distance exceeds its threshold, which is wider
for short texts by what they differ by chance.

Guards: documents under ``MIN_WORDS`` words fail the base rules anyway and add
nothing to a reference; a distance only counts where the document is long
enough for it (``MIN_CHARS``, ``MIN_WORDS``).  Every language of the table
has a reference of its own; one without a list of function words is measured by
how far it uses those of the others.  A null language is compared with every
reference and judged by the nearest one.  A language
without a single document that may enter its reference is judged by the base
rules alone.  Null text is empty text; equal rows are judged alike; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pixelframe.llm.base import read_table, stored

MIN_WORDS = 50
MIN_CHARS = 200
MAX_CHAR_DISTANCE = 0.15
MAX_WORD_DISTANCE = 0.35
# what a short text may differ by chance: added to the squared threshold, per character and per word
CHAR_ALLOWANCE = 9.0
WORD_ALLOWANCE = 6.0
REPEAT_PERCENT = 50
TRIM_ROUNDS = 3

# Function words of four languages (fixed values).
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was as with are be by this from at not have or an had".split(),
    "de": "der die und das den von zu mit ist des im für nicht ein eine auf sich dem als auch es an er so sie".split(),
    "fr": "le la les de des et en un une du dans que qui pour par sur pas est au il ne ce se plus avec".split(),
    "es": "el la los las de del y en un una que se por con para al no es lo su como más o este ha".split(),
}
LANGUAGES = tuple(COMMON_WORDS)
_VOCABULARY = {w.encode(): i for i, w in enumerate(dict.fromkeys(w for ws in COMMON_WORDS.values() for w in ws))}
N_WORD_BINS = len(_VOCABULARY) + 1  # the last is every other word
# classes: lower-case letter, upper-case letter, digit, white space, sentence mark, other ASCII mark, other character
N_CHAR_BINS = 7
_SENTENCE = ".,;:!?'\"-()"


def _char_table() -> np.ndarray:
    table = np.full(0x3000, 6, np.uint8)
    for c in range(0x3000):
        ch = chr(c)
        if ch.islower() or (ch.isalpha() and not ch.isupper()):
            table[c] = 0
        elif ch.isupper():
            table[c] = 1
        elif ch.isdigit():
            table[c] = 2
        elif ch.isspace():
            table[c] = 3
        elif ch in _SENTENCE:
            table[c] = 4
        elif c < 128:
            table[c] = 5
    return table


_CHAR_TABLE = _char_table()


class _Bins(dict):
    """Bin of each written word; emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        bare = word.strip(b".,;:!?'\"-()").decode("utf-8", "replace").lower().encode()
        i = self[word] = _VOCABULARY.get(bare, N_WORD_BINS - 1)
        return i


_BINS = _Bins()
_WS_BYTES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, first included."""
    n = len(words)
    if n < 4:
        return 0
    ids = _Ids()
    a = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    v = len(ids)
    if v < 2_000_000:
        key = (a[:-2] * v + a[1:-1]) * v + a[2:]
    else:
        _, pair = np.unique(a[:-1] * v + a[1:], return_inverse=True)
        key = pair[:-1].astype(np.int64) * v + a[2:]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, _WS_BYTES))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    return len(words), len(text) - spaces, symbols, dup, repeated_words(words), words


def char_histogram(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_CHAR_TABLE[np.minimum(code, 0x2FFF)], minlength=N_CHAR_BINS).astype(float)


def word_histogram(words: list[bytes]) -> np.ndarray:
    return np.bincount(np.fromiter(map(_BINS.__getitem__, words), np.int64, len(words)),
                       minlength=N_WORD_BINS).astype(float)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (root of the divergence in bits) of two histograms."""
    if p.sum() <= 0 or q.sum() <= 0:
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def kl(x):
        at = x > 0
        return float((x[at] * np.log2(x[at] / m[at])).sum())

    return float(np.sqrt(max(0.0, (kl(p) + kl(q)) / 2)))


def base_fails(n_words: int, n_repeat: int, min_words: int = MIN_WORDS, percent: int = REPEAT_PERCENT) -> bool:
    return n_words < min_words or 100 * n_repeat > percent * n_words


def _batches(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names])


def _means(part: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    n = 1 + N_CHAR_BINS + N_WORD_BINS
    rows = part.groupBy("lang").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(n)]).collect()
    out = {}
    for r in rows:
        x = np.array(r[1:], float)
        out[r[0]] = (x[1:1 + N_CHAR_BINS] / x[0], x[1 + N_CHAR_BINS:] / x[0])
    return out


def distances(chars: np.ndarray, words: np.ndarray, lang: str | None, refs: dict) -> tuple[float, float]:
    """(character, word) distance to the language's reference; of a null language
    to the nearest by their sum; (0, 0) where there is nothing to compare with."""
    if lang is not None:
        near = [refs[lang]] if lang in refs else []
    else:
        near = list(refs.values())
    pairs = [(js_distance(chars, c), js_distance(words, w)) for c, w in near]
    return min(pairs, key=sum, default=(0.0, 0.0))


def verdict(n_words: int, n_chars: int, d: tuple[float, float]) -> bool:
    far_chars = n_chars >= MIN_CHARS and d[0] ** 2 > MAX_CHAR_DISTANCE ** 2 + CHAR_ALLOWANCE / n_chars
    far_words = n_words >= MIN_WORDS and d[1] ** 2 > MAX_WORD_DISTANCE ** 2 + WORD_ALLOWANCE / n_words
    return not (far_chars or far_words)


_MEASURES = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
             ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())]


def measure(docs: DataFrame) -> DataFrame:
    """One pass over the texts: the base counts and both histograms of every
    row, as a small table in the shared folder."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *_MEASURES,
                        ("chars", pa.list_(pa.int32())), ("common", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in schema.names]
            for doc_id, text, lang in _batches(batch, "doc_id", "text", "lang"):
                *counts, words = base_counts(text)
                row = (doc_id, lang, *counts, char_histogram(text or "").astype(np.int32),
                       word_histogram(words).astype(np.int32))
                for c, v in zip(cols, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return stored(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], docs["lang"]).mapInArrow(
        run, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, chars array<int>, common array<int>"), "measures")


def references(measured: DataFrame, rounds: int = TRIM_ROUNDS) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean histograms by language over all rows of ``measure`` that pass the
    base rules.  Each further round leaves out the rows that the references so
    far reject, so that junk does not pull its language's reference towards
    itself.  One row per language reaches the driver."""
    refs: dict = {}
    for _ in range(rounds):
        refs = _means(measured.mapInArrow(_sums(refs), "lang string, sums array<double>")) or refs
    return refs


def _sums(refs: dict):
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, n, rep, c, w in _batches(batch, "lang", "n_words", "n_repeat_words", "chars", "common"):
                if lang is None or base_fails(n, rep):
                    continue
                c, w = np.array(c, float), np.array(w, float)
                if refs and not verdict(n, int(c.sum()), distances(c, w, lang, refs)):
                    continue
                total[lang] = total.get(lang, 0.0) + np.concatenate([[1.0], c / c.sum(), w / w.sum()])
        if total:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(total), "sums": [x.tolist() for x in total.values()]},
                schema=pa.schema([("lang", pa.string()), ("sums", pa.list_(pa.float64()))]))

    return run


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, distances and verdict of every row of ``docs`` (doc_id, text, lang)."""
    measured = measure(docs)
    refs = references(measured)
    schema = pa.schema([("doc_id", pa.int64()), *_MEASURES, ("base_failed", pa.bool_()), ("kept", pa.bool_()),
                        ("char_distance", pa.float64()), ("word_distance", pa.float64())])

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in schema.names]
            names = ["doc_id", *[n for n, _ in _MEASURES], "lang", "chars", "common"]
            for doc_id, n, wc, sym, dup, rep, lang, c, w in _batches(batch, *names):
                failed = base_fails(n, rep)
                c, w = np.array(c, float), np.array(w, float)
                d = distances(c, w, lang, refs)
                row = (doc_id, n, wc, sym, dup, rep, failed, not failed and verdict(n, int(c.sum()), d), *d)
                for col, v in zip(cols, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return measured.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                    "n_repeat_words long, base_failed boolean, kept boolean, "
                                    "char_distance double, word_distance double")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    refs = references(measure(docs))

    def run(batches):
        for batch in batches:
            keep = []
            text_at, lang_at = batch.schema.get_field_index("text"), batch.schema.get_field_index("lang")
            for text, lang in zip(batch.column(text_at).to_pylist(), batch.column(lang_at).to_pylist()):
                text = text or ""
                words = text.encode("utf-8", "surrogatepass").split()
                ok = not base_fails(len(words), repeated_words(words))
                keep.append(ok and verdict(len(words), len(text), distances(
                    char_histogram(text), word_histogram(words), lang, refs)))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_rules(spark, sf_dir) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))
