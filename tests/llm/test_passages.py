"""op2's automata on very long and on repetitive passages."""

import time
import weakref

import numpy as np
import pyarrow as pa
import pytest

from attrition.llm import substring_dedup as sd
from attrition.llm import words
from attrition.llm.chunks import pack_batch
from attrition.llm.words import split_words


def recurring(texts, window):
    """Starts of windows that also start anywhere else, and the words they cover."""
    seen, starts, at = {}, [], 0
    for t in texts:
        w = t.split()
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i:i + window]), []).append(at + i)
        at += len(w)
    starts = sorted(i for places in seen.values() if len(places) > 1 for i in places)
    cover = np.zeros(at, bool)
    for i in starts:
        cover[i:i + window] = True
    return np.array(starts, np.int64), cover


def test_pieces_keep_every_window_whole():
    for size in (3, 4, 11, 12, 13, 40, 101):
        lo, hi = sd._pieces(np.array([5, 500]), np.array([5 + size, 503]), 3)
        own = [(a, b) for a, b in zip(lo, hi) if a < 400]
        assert all(b - a <= 12 for a, b in own) and own[0][0] == 5 and own[-1][1] == 5 + size
        assert all(any(a <= i and i + 3 <= b for a, b in own) for i in range(5, 5 + size - 2))
        assert (lo[-1], hi[-1]) == (500, 503)


def test_nested_runs_of_one_word_take_linear_time():
    texts = ["w " * (35 + 3 * i) for i in range(300)] + ["other words here"]
    starts, cover = recurring(texts, 35)
    w = split_words(pa.array(texts))
    began = time.time()
    assert np.array_equal(sd._covered(w, starts, 35, sd.AUTOMATON_WORDS), cover)
    assert time.time() - began < 60         # 145,000 words; before, some hundred passages ended at each of them


def test_mixed_passages_equal_the_windows():
    rng = np.random.default_rng(2)
    base = [f"a{i}" for i in range(400)]
    texts = [" ".join(rng.choice(["x", "y"], 60)) for _ in range(5)]
    texts += [" ".join(base), "one " + " ".join(base[30:330]) + " two", " ".join(base[100:200] * 3)]
    starts, cover = recurring(texts, 10)
    assert np.array_equal(sd._covered(split_words(pa.array(texts)), starts, 10, 50), cover)


def test_passage_of_more_distinct_words_than_characters():
    n = 1_200_000
    text = " ".join(map(str, range(n)))
    w = split_words(pa.array([text]))
    starts = np.arange(n - 34)          # as if the text had a copy elsewhere
    assert sd._covered(w, starts, 35, sd.AUTOMATON_WORDS).all()


def test_tasks_give_memory_back_once_their_words_are_gone(spark, monkeypatch):
    class Asked(Exception):
        pass

    class Chunks:
        def mapInArrow(self, task, schema):
            raise Asked(task)

    alive, left = [], []

    def split(column):
        alive.append(weakref.ref(w := words.split_words(column)))
        return w

    monkeypatch.setattr(sd, "pack", lambda *a, **kw: Chunks())
    monkeypatch.setattr(sd, "bucket_count", lambda *a: 1)
    monkeypatch.setattr(sd, "split_words", split)
    for module in (sd, words):
        monkeypatch.setattr(module, "give_back", lambda: left.append(sum(r() is not None for r in alive)))
    with pytest.raises(Asked) as e:
        sd.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    body = pa.RecordBatch.from_pydict({"text": pa.array([" ".join(f"w{i % 50}" for i in range(200))])})
    batch = pa.RecordBatch.from_pydict({"cid": pa.array([0], pa.int64()), "payload": pa.array([pack_batch(body)], pa.binary())})
    assert sum(b.num_rows for b in e.value.args[0](iter([batch]))) == 1
    assert len(alive) == 1 and left == [0]
