import hashlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pixelframe.llm import alignment
from pixelframe.llm.alignment import alignments
from pixelframe.llm.base import read_table
from pixelframe.llm.tokens import byte_level_bytes

NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Brute:
    """Both whole-text tokenizers, groups by sets of byte ends, counts in a dictionary."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        self.back = byte_level_bytes()

    def b_bytes(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        whole = (" " + text).encode()
        parts = [[bytes(self.back[c] for c in self.a.id_to_token(i)) for i in a], [self.b_bytes(i) for i in b]]
        if any(b"".join(p) != whole for p in parts):
            return None
        ends = [[sum(map(len, p[:k + 1])) for k in range(len(p))] if len(p) < 3000 else self.running(p) for p in parts]
        out, low = [], 0
        places = [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            group = []
            for s, ids in enumerate((a, b)):
                k = places[s]
                while places[s] < len(ids) and ends[s][places[s]] <= end:
                    places[s] += 1
                group.append(ids[k:places[s]])
            out.append(tuple(group))
            low = end
        assert low == len(whole)
        return out

    @staticmethod
    def running(parts):
        at, out = 0, []
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    def rows(self, items):
        groups = [(i, self.groups(t)) for i, t in items]
        links = [Counter((x, y) for ga, gb in g or [] for x in ga for y in gb) for _, g in groups]
        count = Counter(p for c in links for p in c)
        top = {}
        for (x, _), n in count.items():
            top[x] = max(n, top.get(x, 0))
        for (i, g), c in zip(groups, links):
            text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g or [])
            yield (i, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(c.values()),
                   sum(n for (x, y), n in c.items() if count[x, y] == top[x]), sum(n * count[p] for p, n in c.items()),
                   hashlib.sha256(text.encode()).hexdigest() if g else "")


ODD = [" leading", "  two spaces  inside and after  ", "line\n\nbreaks \n and\ttabs \t", "mark ▁ here", "a▁b", "<s> </s> <unk> <0x0A> <|endoftext|>",
       "漢字かな交じり文 テスト", "emoji \U0001F600\U0001F468‍\U0001F469 ok", "\x00 null \x1c byte", "don't it's WE'LL", "x" * 5000,
       "é" * 300 + " " + "ß" * 10, "no break and thin spaces", "áb combining", "1234567890 12 ½ ¾", "．。、", " ", "\n", "   "]


@pytest.mark.parametrize("block_tokens", [500, 4_000_000])
def test_rows(spark, docs, corpus, no_docs, block_tokens):
    more = [(1000 + k, t, None, None, 0) for k, t in enumerate(ODD)]
    table = docs.union(spark.createDataFrame(more, docs.schema)).withColumn("pair", F.lit(1)).withColumn("block", F.lit("x"))
    got = Counter(tuple(r[n] for n in NAMES) for r in alignments(table, block_tokens=block_tokens).collect())
    assert got == Counter(Brute().rows([(r[0], r[1]) for r in corpus + more]))
    assert alignments(no_docs).count() == 0


def test_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    got = sorted(tuple(r[n] for n in NAMES) for r in alignments(docs).collect())
    assert got == sorted(Brute().rows([(r.doc_id, r.text) for r in docs.collect()]))


@pytest.mark.parametrize("few", [0, 4096])
def test_groups_and_windows(monkeypatch, few):
    monkeypatch.setattr(alignment, "_FEW", few)
    v = alignment.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    text = " one Überraschung, 漢字 twotwotwo" + "\U0001F600 ü" * 3
    a, b = v.a.whole.encode(text, add_special_tokens=False).ids, v.b.model.encode(text[1:])
    cuts = alignment.Cuts(array("I", a).tobytes(), array("I", b).tobytes(), v)
    n_groups, n_links, n_pairs, pairs, times, texts = cuts.align(np.arange(len(cuts.ends)), v)
    want = Brute().groups(text[1:])
    assert "".join(texts)[:-1] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)
    assert n_groups.sum() == len(want) and n_links.sum() == times.sum() and n_pairs.sum() == len(pairs)
    links = Counter((x, y) for ga, gb in want for x in ga for y in gb)
    got = Counter()
    for p, t in zip(pairs.tolist(), times.tolist()):
        got[p >> 16, p & 0xFFFF] += t
    assert got == links
    assert len(set(cuts.keys())) == len({tuple(k) for k in cuts.keys()}) <= len(cuts.ends)
