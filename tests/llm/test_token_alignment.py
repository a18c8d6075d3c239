"""op13: alignment of two tokenizers against whole-text encoding by the libraries."""

import collections
import hashlib
import random

import numpy as np
import pytest

from attrition.llm import token_alignment as ta

COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tok():
    import public_tokenizers as P
    return ta.Tokenizers(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


def aligned(tok, text):
    """Links and groups of one whole text, token by token."""
    if not text:
        return [], []
    a, b = tok.a.encode(" " + text, add_special_tokens=False).ids, tok.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(tok.a_bytes[i] for i in a) != raw or b"".join(tok.b_bytes[i] for i in b) != raw:
        return [], []
    spans = []
    for ids, table in ((a, tok.a_bytes), (b, tok.b_bytes)):
        at, own = 0, []
        for i in ids:
            own.append((at, at + len(table[i])))
            at += len(table[i])
        spans.append(own)
    links, j = [], 0
    for x, (lo, hi) in enumerate(spans[0]):
        while spans[1][j][1] <= lo:
            j += 1
        k = j
        while k < len(b) and spans[1][k][0] < hi:
            links.append((a[x], b[k]))
            k += 1
    both = {e for _, e in spans[0]} & {e for _, e in spans[1]}
    groups, i, j = [], 0, 0
    for cut in sorted(both):
        x, y = i, j
        while i < len(a) and spans[0][i][1] <= cut:
            i += 1
        while j < len(b) and spans[1][j][1] <= cut:
            j += 1
        groups.append((a[x:i], b[y:j]))
    return links, groups


def brute(tok, docs):
    found = [(i, *aligned(tok, t)) for i, t in docs]
    count = collections.Counter(link for _, links, _ in found for link in links)
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    rows = []
    for i, links, groups in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                     sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                     hashlib.sha256(text.encode()).hexdigest() if links else ""))
    return sorted(rows, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


def odd_texts(n):
    rng = random.Random(3)
    parts = [" ", "  ", "a", "é", "\n", "\t", " ", "　", "日本", "'s", "12", "!?", "▁", "<|endoftext|>", "the", "\x00", "\r\n",
             " ​", "😀", "<0x41>", "</s>", "ﬁ", " house", " Überraschung"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_alignment_equals_brute_force(spark, tok, monkeypatch):
    monkeypatch.setattr(ta, "CHUNK_BYTES", 4096)
    texts = odd_texts(400) + ["the house " * 30] * 40 + [None, "", " ", "  ", "x", "lorem ipsum " * 3000]
    docs = list(enumerate(texts)) + [(3, "again"), (3, "again"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], "doc_id long, text string, link string, cid long, pairs string")
    assert result(ta.alignment(df.repartition(3))) == brute(tok, docs)


def test_documents_table(spark, tok):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(ta.op13_token_alignment(spark, sf)) == brute(tok, docs)


def test_empty_table(spark):
    assert ta.alignment(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pointer_jumping_labels_components():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.randint(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n - 1)), n})) for _ in range(2))
        left, right = ta.component_ends(a, b)
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        for ends, label in ((a, left), (b, right)):
            # a token's component ends at the first shared place from its own end on
            assert [a[x] for x in label] == [next(s for s in shared if s >= e) for e in ends.tolist()]
