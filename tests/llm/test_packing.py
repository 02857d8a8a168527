import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pixelframe.llm.packing import pack, plan
from pixelframe.llm.tokens import ByteBPE, PieceBPE, chunked

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [" ", "  ", "\n", "\t", "\r\n", "'s", "'", "a", "B", "word", "é", "漢字", "\U0001F600", "12", "½", "!?", "\x00", "\x1c", "\x85",
       " ", " ", "​", "▁", "<s>", "<0x0A>", "<|endoftext|>", "ǅ", "́", "ͅ", "\U0001E900", "…", "​"]


@pytest.fixture(scope="module")
def whole():
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    return Tokenizer.from_file(PATH), plain


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=12).map("".join))
def test_chunks_give_the_ids_of_the_whole_text(text):
    default, plain = Tokenizer.from_file(PATH) if not CACHE else CACHE[0], None
    if not CACHE:
        plain = Tokenizer.from_file(PATH)
        plain.encode_special_tokens = True
        CACHE.extend([default, plain, ByteBPE(PATH), ByteBPE(PATH, plain=True),
                      PieceBPE(public_tokenizers.path("piece_bpe_32k.model"))])
    default, plain, memo, memo_plain, piece = CACHE
    text = text.encode("utf-8", "ignore").decode()

    def ids(m, spaced):
        chunks, own = chunked(pa.array([text, "", text + " end"]), spaced)
        return np.frombuffer(b"".join(m[chunks[c]] for c in own[0]), "<u4").tolist()

    assert ids(memo, False) == default.encode(text, add_special_tokens=False).ids
    assert not text or ids(memo_plain, True) == plain.encode(" " + text, add_special_tokens=False).ids
    if text and "▁" not in text:
        assert ids(piece, True) == piece.model.encode(text)


CACHE: list = []


def best_fit(lengths, capacity):
    """Piece by piece: pairs of large ones first, then the rest in the smallest gap."""
    left = sorted(lengths, reverse=True)
    large, rooms = [n for n in left if 3 * n > capacity], []
    while large:
        a = large.pop(0)
        b = next((n for n in large if a + n <= capacity), 0)
        if b:
            large.remove(b)
        rooms.append(capacity - a - b)
    for n in left[len(left) - sum(3 * n <= capacity for n in left):]:
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 3, 7, 10, 30, 64])
    lengths = [rng.choice([rng.randint(1, capacity), max(1, capacity // rng.randint(1, 5))]) for _ in range(rng.choice([0, 1, 5, 60, 300]))]
    runs = plan(Counter(lengths), capacity)
    rows, seen = [], Counter()
    for n in lengths:
        rank, seen[n] = seen[n], seen[n] + 1
        length, first, each, sequence, place = max((r for r in runs.tolist() if r[0] == n and r[1] <= rank), key=lambda r: r[1])
        rows.append({"sequence_id": sequence + (rank - first) // each, "offset": place + (rank - first) % each * n, "length": n})
    assert check_packed(rows, capacity) == best_fit(lengths, capacity) >= -(-sum(lengths) // capacity)


@pytest.mark.parametrize("capacity", [2048, 50])
def test_rows(docs, corpus, no_docs, whole, capacity):
    want = []
    for i, text, *_ in corpus + [(98, "an <|endoftext|> inside", None, None, 0)]:
        ids = np.array(whole[0].encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = (len(ids) - 1) % capacity + 1
        at = 0
        for k, stop in enumerate(range(first, len(ids) + 1, capacity)):
            want.append((i, k, at, stop - at, zlib.crc32(ids[at:stop].tobytes())))
            at = stop
    more = docs.sparkSession.createDataFrame([(98, "an <|endoftext|> inside", None, None, 0)], docs.schema)
    wide = docs.union(more).withColumn("length", F.lit("x")).withColumn("part", F.lit(1)).withColumn("rank", F.lit(1))
    rows = [r.asDict() for r in pack(wide, capacity=capacity).collect()]
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(want)
    assert check_packed(rows, capacity) == best_fit([w[3] for w in want], capacity)
    assert pack(no_docs).count() == 0
