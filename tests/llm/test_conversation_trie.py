"""op11: the conversation prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from attrition.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, p1 string, depth string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        leader = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(leader, [])[:h] + turns[h:]
    return out


def brute(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves = {p: int(p not in kids) for p in members}
    saved = {p: (len(m) - 1) * (len(p[-1][1]) if p else 0) for p, m in members.items()}
    for p in sorted(members, key=len, reverse=True):
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest())
                  for p, m in members.items())


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def result(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


@pytest.mark.parametrize("band", [2, 8])
def test_trie_equals_brute_force(spark, band):
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 12), 100, 101, 205, 300, -3]:                   # 200 is absent, so 205 has no leader
        for t in range(rng.choice([1, 2, 4, 7])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a", "bé", "", None, "\U0001F600x"])))
    rows += [(400, t, "user", "deep" + "é" * (t % 3)) for t in range(40)]
    rows += [(c, t, "user", "same") for c in range(401, 431) for t in range(9)]     # a large group of copies
    rows += [(7, 1, "user", "again"), (7, 1, "user", "again"), (8, None, "user", "first"), (None, 0, "user", "nobody")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = result(ct.prefix_trie(ct.rebuilt_paths(df), band))
    assert got == brute(rebuilt(rows))


def test_plain_conversations_and_long_paths(spark, monkeypatch):
    monkeypatch.setattr(ct, "BLOCK", 16)                                # many prefix windows a conversation
    rows = [(1, t, "u", f"t{t}") for t in range(70)] + [(2, t, "u", f"t{t}" if t < 65 else "x") for t in range(80)] + [(3, 0, "u", "t0")]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    paths = {c: [(r, x) for k, _, r, x in rows if k == c] for c in (1, 2, 3)}
    assert result(ct.prefix_trie(ct.plain_paths(df), 4)) == brute(paths)


def test_empty_and_bad_band(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert result(ct.prefix_trie(ct.rebuilt_paths(df))) == []
    assert result(ct.prefix_trie(ct.plain_paths(spark.createDataFrame([(None, 1, "u", "x", "", "")], SCHEMA)))) == []
    with pytest.raises(ValueError):
        ct.prefix_trie(df, band=3)
