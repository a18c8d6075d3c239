"""op12: spot signatures, the edited fingerprints and the comparison, against brute force."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from attrition.llm import spot_signatures as ss

COLS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def signatures(text):
    """Tuples of anchor and content words."""
    w, anchors = words(text), set(ss.ANCHORS)
    out = set()
    for i, x in enumerate(w):
        if x in anchors:
            chain = [y for y in w[i + 1:] if y not in anchors][:ss.CHAIN]
            if len(chain) == ss.CHAIN:
                out.add((x, *chain))
    return out or ({("words", *w)} if w else {("bytes", text)} if text else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def sample(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["house", "Tree", "öl", "river", "stone", "42", "light", "sound", "x"] + ss.ANCHORS[:12] * 2
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + ["", None, "!!!", "\U0001F600\U0001F600\U0001F600é", "the", "no anchors here at all" * 3]


def brute_edits(docs):
    docs = [(i, t or "") for i, t in docs]
    docs.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    rows = []
    for k, (i, t) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        n = len(t) // 3
        edited = t[:len(t) - n] + following[:n]
        rows.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(signatures(t), signatures(edited)),
                     jaccard(signatures(t), signatures(following))))
    return rows


def test_signatures_equal_brute_force():
    texts = sample(300)
    sets = ss.signature_sets(pa.array(texts), ss.anchor_hashes())
    want = [signatures(t or "") for t in texts]
    assert list(map(len, sets)) == list(map(len, want))
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert ss.likeness(sets[i], sets[j]) == pytest.approx(jaccard(want[i], want[j]))
    assert ss.likeness(sets[0][:1], sets[1], at_least=0.9) == 0.0


@pytest.mark.parametrize("size", [300, 1 << 22])
def test_edited_fingerprints(spark, monkeypatch, size):
    monkeypatch.setattr(ss, "SLICE_BYTES", size)
    docs = list(enumerate(sample(120), start=-20)) + [(None, "the last house of stone"), (500, "the first tree in light " * 4000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, fingerprint string, part int")
    rows = {r.doc_id: r for r in ss.edited_fingerprints(df.repartition(5)).select(*COLS).collect()}
    want = brute_edits(docs)
    assert len(rows) == len(want)
    for i, n, digest, near_edited, near_next in want:
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert (r.near_edited, r.near_next) == (pytest.approx(near_edited), pytest.approx(near_next))
        a, b = ({p[k:k + 8] for k in range(0, len(p), 8)} for p in (r.fingerprint, r.edited_fingerprint))
        assert jaccard(a, b) == pytest.approx(r.near_edited)


def test_repeated_single_and_empty(spark):
    schema = "doc_id long, text string"
    assert ss.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []
    one = ss.edited_fingerprints(spark.createDataFrame([(1, "the river of stone and light")], schema)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    many = ss.edited_fingerprints(spark.createDataFrame([(1, "the river of stone and light")] * 50 + [(1, "the house is on a tree")], schema)).collect()
    assert len(many) == 51 and len({r.fingerprint for r in many}) == 2


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(4)
    texts = sample(150, 2)
    for t in list(texts[:60]):                              # near copies: a word changed, or two appended
        w = (t or "").split()
        if len(w) > 25:
            w[rng.randrange(len(w))] = "changed"
            texts += [" ".join(w), " ".join([*w, "extra", "end"])]
    texts += ["the stone in the river is a light of sound"] * 30
    docs = list(enumerate(texts)) + [(None, texts[0])]
    got = {r.doc_id: r for r in ss.near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    sets = [signatures(t or "") for t in texts]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[max(find(i), find(j))] = min(find(i), find(j))
    assert {i: got[i].component_id for i in range(len(texts))} == {i: find(i) for i in range(len(texts))}
    assert got[None].component_id is None
    assert ss.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []
