"""Packing: exact round trip of all token ids, full sequences, BM25 neighbours against a plain loop."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlake.llm import packing, textbuf
from tests.llm.conftest import DOC_SCHEMA, prose, rows as sorted_rows


@pytest.fixture(scope="module")
def vocabulary():
    return packing.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    t = Tokenizer.from_str(vocabulary.text)
    t.encode_special_tokens = True
    return t


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


ODD = ["", " ", "a\x00b", "Ça, École!? Straße... 3,5. x, I.B.M. œuvre. L'été, 's. it's", "naïve ÿ÷× ªº äb", "̈ x\xa0y",
       "don't 'S Σ ΑΣ ΑΣ. İI", "<|endoftext|> hi<|startoftext|>", "　東京 naïve\tÜ\n", "a\x1cb\x85c", "é. é!!1", "...", "a,b c;"]


def test_ids_by_word_are_the_texts_ids(vocabulary, tokenizer):
    texts = [*ODD, *[prose(i, 50) + ODD[i] for i in range(len(ODD))], *ODD]
    encoder = packing.Encoder(vocabulary.text)
    for size in (1, 1 << 20):
        got = []
        for _, data, offsets in textbuf.chunks(pa.array(texts), size):
            ids, bounds = encoder.texts(data, offsets)
            got += [ids[a:z].tolist() for a, z in zip(bounds[:-1], bounds[1:])]
        assert got == [whole(tokenizer, t) for t in texts]


def test_words_are_forgotten_and_found_again(vocabulary, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    encoder = packing.Encoder(vocabulary.text)
    for i in range(5):
        text = prose(i, 30)
        (_, data, offsets), = textbuf.chunks(pa.array([text]))
        assert encoder.texts(data, offsets)[0].tolist() == whole(tokenizer, text)


def check_pieces(pieces, texts, tokenizer, window):
    """Every id in one piece, gapless offsets, and sequences that are full or a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids, at = np.array(whole(tokenizer, texts[doc]), "<u4"), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)


@pytest.mark.parametrize("window,shard", [(2048, 1 << 18), (64, 700), (16, 1)])
def test_round_trip(spark, vocabulary, tokenizer, window, shard):
    texts = {i: prose(i, (i * 37) % 400, 300) for i in range(120)} | {200: prose(1, 20_000, 5000), 201: None, 202: "", 203: " "}
    texts |= {300 + i: prose(7, 40) for i in range(60)}
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in texts.items()], DOC_SCHEMA).repartition(3)
    got = packing.pack(docs, vocabulary, window=window, shard_tokens=shard).collect()
    check_pieces(got, texts, tokenizer, window)


def test_reruns_cut_alike(spark, vocabulary):
    docs = spark.createDataFrame([(i, prose(i, 90), "en", "a", 1) for i in range(80)], DOC_SCHEMA).repartition(2)
    first, second = (sorted_rows(packing.pack(docs, vocabulary, window=128)) for _ in range(2))
    assert first == second


def test_odd_rows_and_clashing_columns(spark, vocabulary, tokenizer, odd_docs, odd_rows, clashing):
    want = Counter()
    for r in odd_rows:
        want[r[0]] += len(whole(tokenizer, r[1]))
    extra = clashing.withColumns({c: F.lit("x") for c in ("kind", "ids", "start", "length", "s1", "salt", "crcs", "sequence_id")})
    for docs in (odd_docs, extra):
        got = Counter()
        for p in packing.pack(docs, vocabulary).collect():
            got[p.doc_id] += p.length
        assert got == want


def test_empty_table(spark, vocabulary, no_docs):
    assert packing.pack(no_docs, vocabulary).collect() == []


def plain_scores(tails, df, count, mean, seed):
    """BM25 of every tail for the seed's distinct ids, term by term."""
    out = []
    for tail in tails:
        tf, score = Counter(tail), 0.0
        for t in sorted(set(tails[seed])):
            if tf[t]:
                idf = math.log(1 + (count - df[t] + 0.5) / (df[t] + 0.5))
                score += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(tail) / mean))
        out.append(score)
    return out


def test_windows_are_filled_by_score():
    rng = np.random.default_rng(3)
    tails = [rng.integers(0, 60, rng.integers(5, 30)) for _ in range(40)]
    df = Counter(t for tail in tails for t in set(tail.tolist()))
    mean = sum(map(len, tails)) / len(tails)
    idf = np.array([math.log(1 + (len(tails) - df[t] + 0.5) / (df[t] + 0.5)) for t in range(60)])
    lists = [t.tolist() for t in tails]
    used, window = set(), 64
    sequences = list(packing.pack_shard(tails, idf, mean, window))
    rest = None
    for sequence in sequences:
        if sum(n for *_, n in sequence) < window:
            break
        seed = sequence[0][0]
        if rest is None:
            assert seed == min(set(range(40)) - used)
        else:
            assert sequence[0][:2] == rest
        used.add(seed)
        scores = plain_scores(lists, df, len(tails), mean, seed)
        for d, start, n in sequence[1:]:
            best = max(scores[x] for x in range(40) if x not in used)
            assert scores[d] == pytest.approx(best, abs=1e-9)
            used.add(d)
        d, start, n = sequence[-1]
        rest = (d, start + n) if start + n < len(tails[d]) else None
    assert sum(n for s in sequences for *_, n in s) == sum(map(len, tails))


def test_neighbours_are_like_their_seed():
    """Documents of five vocabularies meet their own kind."""
    rng = np.random.default_rng(5)
    kinds = rng.integers(0, 5, 100)
    tails = [np.concatenate([rng.integers(100 * k, 100 * k + 100, 50), rng.integers(500, 520, 10)]) for k in kinds]
    same = total = 0
    for sequence in packing.pack_shard(tails, np.ones(520), 60.0, 240):
        owners = [int(kinds[d]) for d, *_ in sequence]
        same += sum(k == owners[0] for k in owners[1:])
        total += len(owners) - 1
    assert same > 0.9 * total
