"""Alignment against the two tokenizers run on whole texts and plain loops."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tradestar.llm.alignment import _STRETCH, PerfectHash, Tokenizers, _keys, _parts, _stretch, align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["It's Ünïcode—ﬁ ½ ① İstanbul é", "tab\tnew\nline\x0bvt\x0cff\rcr nbsp em\x85nel\x1cfs \x1c a\x1c b",
       "<|endoftext|> and <s>x</s><unk><0x41>", "日本語 テキスト　全角 한국어 عربى 🎉", "  lead", "tail  ", "a\n\n\nb \n c\n d",
       "\n", " ", "\n\n", " \n x", "x \n", "x\t\n y\t", "a" * 3000, "1234567 3.14!?.. don't they'll", "a▁b", "\x00z",
       "-- ** __ \n\n - item\n   - nested\n", " a  b　", "é́ ‍"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B)
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in letters} | {
        chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in letters)}

    def tokens(text):
        x = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            m = re.fullmatch("<0x(..)>", p)
            y.append((i, bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = text and b"".join(t for _, t in x) == whole == b"".join(t for _, t in y)
        return (x, y) if same else ([], [])
    return tokens


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(tokens, texts):
    docs, count = [], Counter()
    for t in texts:
        x, y = map(spans, tokens(t or ""))
        links = [(i, j) for i, s, e in x for j, u, v in y if s < v and u < e] if len(x) < 2000 else None
        if links is None:  # the same, without looking at all pairs
            links, k = [], 0
            for i, s, e in x:
                while k and y[k][1] >= s and y[k - 1][2] > s:
                    k -= 1
                while y[k][2] <= s:
                    k += 1
                j = k
                while j < len(y) and y[j][1] < e:
                    links.append((i, y[j][0]))
                    j += 1
        count.update(set(links))
        docs.append((x, y, links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for x, y, links in docs:
        ends = sorted({e for *_, e in x} & {e for *_, e in y})
        groups, begin = [], 0
        for e in ends:
            side = lambda z: ",".join(str(i) for i, _, v in z if begin < v <= e)  # noqa: B023, E731
            groups.append(f"{side(x)}|{side(y)}")
            begin = e
        text = ";".join(groups)
        out.append((len(x), len(y), len(ends), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if x else "", text))
    return out


def made(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, align string").repartition(3)


def got(df):
    return [tuple(r.align) for r in sorted(df.collect(), key=lambda r: r.doc_id)]


def random_texts(seed, n=120):
    rng = random.Random(seed)
    letters = "etaoin shrdlu\n\n  éß日▁\t,.'0123-\x1c　\r"
    return ["".join(rng.choices(letters, [9] * 13 + [2] * (len(letters) - 13), k=rng.randint(0, 150))) for _ in range(n)]


def test_stretches_leave_tokens_alone(plain):
    t = Tokenizers(A, B)
    for text in [*ODD, *random_texts(1, 500)]:
        if not text or "▁" in text:
            continue
        parts = _STRETCH.findall(" " + text)
        assert "".join(parts) == " " + text
        x, y = plain(text)
        a, b = ([i for s in parts for i in t.ids(s)[k].tolist()] for k in (0, 1))
        assert a == [i for i, _ in x] and b == [i for i, _ in y], repr(text)
        order, good, n_a, n_b, n_links, a, b, pairs = t.aligned(list(dict.fromkeys(parts)))
        assert all(good) and sorted(order) == sorted(set(parts)) and n_links.sum() == len(pairs)
        own = [t.ids(s) for s in order]
        assert a.tolist() == [i for x, _ in own for i in x.tolist()] and n_a.tolist() == [len(x) for x, _ in own]
        assert b.tolist() == [i for _, x in own for i in x.tolist()] and n_b.tolist() == [len(x) for _, x in own]
        cut = [_stretch(k) for k in _keys(text)]
        assert "".join(cut) == " " + text
        assert [i for s in cut for i in t.ids(s)[0].tolist()] == [i for i, _ in x], repr(text)
        assert [i for s in cut for i in t.ids(s)[1].tolist()] == [i for i, _ in y], repr(text)
        assert "".join(_stretch(k) for p in _parts(text, 5) for k in _keys(p)) == " " + text


def test_each_token_spelt_out_comes_back_as_itself():
    """Then ranks of tokens are ranks of merges, and tiktoken's ids the file's."""
    model = Tokenizer.from_file(A).model
    assert all(model.tokenize(model.id_to_token(i))[0].id == i for i in range(50256))


def test_equals_brute_force(spark, plain):
    texts = [*ODD, None, "", *random_texts(2), *ODD[:4]]
    assert got(align(made(spark, texts), A, B)) == brute(plain, texts)


def test_many_shards_and_passes(spark, plain):
    texts = [*ODD, None, *random_texts(3)]
    want = brute(plain, texts)
    assert got(align(made(spark, texts), A, B, shard_pairs=100, pass_shards=2)) == want
    assert got(align(made(spark, texts), A, B, with_groups=False, shard_pairs=400, pass_shards=1)) == [
        w[:-1] for w in want]


def test_driver_tables(spark, plain):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    texts = [r.text for r in df.collect()]
    result = align(df, A, B)
    assert result.columns == ["doc_id", "lang", "source", "n_chars", "align"]
    assert got(result) == brute(plain, texts)


def test_long_text_and_empty_table(spark, plain):
    texts = ["word and\nline " * 200_000, "word and\nline"]
    long, short = got(align(made(spark, texts), A, B, with_groups=False))
    x, y = plain(texts[0])
    assert long[:2] == (len(x), len(y)) and short == brute(plain, texts[1:])[0][:4] + short[4:]
    assert align(made(spark, texts).limit(0), A, B).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 63, 1000, 50_000):
        keys = rng.choice(10 ** 9, n, replace=False) if n else np.zeros(0, np.int64)
        assert sorted(PerfectHash.of(keys).places(keys).tolist()) == list(range(n))
