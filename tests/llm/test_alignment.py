"""Token alignment against the libraries and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gavelkit.llm import alignment
from gavelkit.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ROWS = "doc_id bigint, text string, run string, part int, pairs string, n_a int, block int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, "p", 2, 3) for i, t in rows], ROWS)


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = alignment._shown_bytes()
    bytes_a = {i: bytes(shown[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    bytes_b = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())}
    return lambda t: a.encode(f" {t}", add_special_tokens=False).ids, b.encode, bytes_a, bytes_b


def brute(rows, sides):
    encode_a, encode_b, bytes_a, bytes_b = sides
    docs, held = [], Counter()
    for i, text in rows:
        xs, ys = (encode_a(text), encode_b(text)) if text else ([], [])
        said = [b"".join(m[k] for k in ids) for m, ids in ((bytes_a, xs), (bytes_b, ys))]
        if not text or said != [f" {text}".encode()] * 2:
            docs.append((i, 0, 0, 0, [], ""))
            continue
        spans = []
        for m, ids in ((bytes_a, xs), (bytes_b, ys)):
            at = 0
            spans.append([(k, at, at := at + len(m[k])) for k in ids])
        links, j0 = [], 0
        for x, s, e in spans[0]:
            while spans[1][j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][1] < e:
                links.append((x, spans[1][j][0]))
                j += 1
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, p, q = [], 0, 0
        for end in common:
            ga, gb = [], []
            while p < len(xs) and spans[0][p][2] <= end:
                ga.append(str(xs[p]))
                p += 1
            while q < len(ys) and spans[1][q][2] <= end:
                gb.append(str(ys[q]))
                q += 1
            groups.append(f"{','.join(ga)}|{','.join(gb)}")
        docs.append((i, len(xs), len(ys), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(set(links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = [(i, na, nb, ng, len(k), sum(held[p] == best[p[0]] for p in k), sum(held[p] for p in k), sha) for i, na, nb, ng, k, sha in docs]
    return sorted(out, key=str), sorted((a, b, n, n == best[a]) for (a, b), n in held.items())


def odd_rows():
    r = random.Random(4)
    pool = "the of and straße naïve 東京都 😀 <|endoftext|> <s> <0x41> ' 's it's 12345 a1b2 Zoë́ x\ty\n\n  z ½ №".split(" ")
    rows = [(None, None), (1, ""), (2, " "), (3, "▁ mark"), (4, "\x00nul\x7f"), (5, "same"), (5, "same"), (None, "same"), (6, " wide 　"), (7, "x" * 30_000), (8, "ab c " * 20_000)]
    return rows + [(k, " ".join(r.choice(pool) for _ in range(r.randint(1, 40)))) for k in range(10, 150)]


@pytest.mark.parametrize(("parts", "run_links", "fan"), [(128, 2_000_000, 64), (3, 300, 2)])
def test_equals_brute_force(spark, sides, parts, run_links, fan):
    rows = odd_rows()
    docs, pairs = alignment.aligned(table(spark, rows), A, B, parts=parts, run_links=run_links, fan=fan)
    want_docs, want_pairs = brute(rows, sides)
    assert sorted(map(tuple, docs.collect()), key=str) == want_docs
    assert sorted(map(tuple, pairs.collect())) == want_pairs


def test_empty(spark):
    for rows in ([], [(1, None)]):
        docs, pairs = alignment.aligned(table(spark, rows), A, B)
        assert docs.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert [tuple(r) for r in docs.collect()] == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows] and pairs.count() == 0


def test_lists_merge_over_frames():
    r = np.random.default_rng(1)
    lists = [np.unique(r.integers(0, 500, 200)) for _ in range(7)] + [np.zeros(0, np.int64)]
    raw = [alignment.framed(k, k % 5 + 1, frame=9) for k in lists]
    keys, counts = (np.concatenate(x) for x in zip(*alignment.merged(raw), strict=True))
    want = Counter()
    for k in lists:
        for v in k.tolist():
            want[v] += v % 5 + 1
    assert list(zip(keys.tolist(), counts.tolist(), strict=True)) == sorted(want.items())
    marked = [(k, c, b) for part in alignment.with_best(alignment.merged(raw), 4) for k, c, b in zip(*(x.tolist() for x in part), strict=True)]
    assert marked == [(k, c, c == max(v for q, v in want.items() if q >> 4 == k >> 4)) for k, c in sorted(want.items())]


def test_vocabularies_encode_like_the_libraries(spark, sides, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text] + [t for _, t in odd_rows() if t]
    a, b = alignment.ByteVocabulary(A), alignment.PieceVocabulary(B)
    for t, x, y in zip(texts, a.encode(texts), b.encode(texts), strict=True):
        assert x.tolist() == sides[0](t) and y.tolist() == sides[1](t)


def test_query_equals_brute_force(spark, sides, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = QUERIES["op12_alignment"](spark, sf_dir)
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, sides)[0]
