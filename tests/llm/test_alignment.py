import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF

from barline.llm import queries, token_alignment
from barline.llm.queries import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
DOCS = "doc_id long, text string, n_a string, piece string"
LONG = " ".join(f"wörd{i % 97} the, 日本 {'x' * (i % 40)}" for i in range(3000))
EDGE = [(1, None), (2, ""), (3, "Hello  world, hello"), (3, "Hello  world, hello"), (None, "Hello world"), (4, LONG), (5, "a ▁ b"), (6, "<|endoftext|> </s> <s>"), (7, "😀é" * 50), (8, " \n\t "), (9, "x" * 5000), (10, "null\0byte"), (None, None)]


def brute(rows):
    """By the libraries' own calls, all pairs of each group spelt out."""
    import os

    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    left, right = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    own = token_alignment.ByteTokenizer(A).bytes
    spell = lambda i: bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for doc, text in rows:
        groups, data = [], (" " + (text or "")).encode()
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        if text and b"".join(own[i] for i in a) == data and b"".join(spell(i) for i in b) == data:
            ea, eb = ({e: k for k, e in enumerate(np.cumsum([len(f(i)) for i in x]).tolist())} for f, x in ((own.__getitem__, a), (spell, b)))
            i = j = 0
            for end in sorted(set(ea) & set(eb)):
                i2, j2 = ea[end] + 1, eb[end] + 1
                groups.append((a[i:i2], b[j:j2]))
                i, j = i2, j2
        else:
            a = b = []
        found.append((doc, len(a), len(b), groups, Counter((x, y) for p, q in groups for x in p for y in q)))
    count = Counter(pair for f in found for pair in f[4])
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    join = lambda ids: ",".join(map(str, ids))
    return Counter(
        (doc, n_a, n_b, len(groups), links.total(), sum(k for p, k in links.items() if count[p] == best[p[0]]), sum(k * count[p] for p, k in links.items()),
         hashlib.sha256(";".join(f"{join(p)}|{join(q)}" for p, q in groups).encode()).hexdigest() if groups else "")
        for doc, n_a, n_b, groups, links in found
    )


@pytest.mark.parametrize("piece", [7, 1000, token_alignment.PIECE])
def test_alignment_of_edge_cases(spark, piece):
    rows = spark.createDataFrame([(*r, "x", None) for r in EDGE], DOCS)
    assert Counter(map(tuple, token_alignment.align(rows, A, B, piece).collect())) == brute(EDGE)


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.align(spark.createDataFrame([], DOCS), A, B).collect() == []


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.QUERIES["op11_token_alignment"](spark, SF).collect())) == brute(rows)


def test_crossings_part_no_shared_end_and_are_even():
    rng = np.random.default_rng(3)
    for n, m, piece in [(500, 300, 16), (1, 400, 7), (400, 1, 7), (50, 50, 1), (0, 20, 4)]:
        a, b = (np.sort(rng.choice(700, k, replace=False)) for k in (n, m))
        cuts = token_alignment.merge_path(a, b, piece)
        assert cuts[0] == (0, 0) and cuts[-1] == (n, m)
        for (i, j), (k, o) in zip(cuts, cuts[1:], strict=False):
            assert k + o - i - j <= piece + 1 and not set(a[:k].tolist()) & set(b[o:].tolist()) and (not k or not len(b[o:]) or a[k - 1] < b[o])


def test_a_group_of_many_tokens_is_counted_not_expanded():
    a, b = np.full(60_000, 5), np.full(70_000, 9)
    keys, numbers = token_alignment.linked_pairs(a, np.zeros(60_000, np.int64), b, np.zeros(70_000, np.int64))
    assert keys.tolist() == [5 << 32 | 9] and numbers.tolist() == [60_000 * 70_000]
