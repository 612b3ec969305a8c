"""Posting lists of line dedup: long ones, their order, and those that are read again."""

import itertools
import random

import corpus_pipeline
import numpy as np
import pytest
from cases import removed_lines

from tallybook.llm import lines


def one_list(n: int, seed: int, words: int = 4000, at: int = 0) -> tuple[dict[str, np.ndarray], list[set[int]]]:
    """Postings of n random sets under one token, some like another, in order, and the sets."""
    rng = random.Random(seed)
    sets: list[set[int]] = []
    for k in range(n):
        own = set(rng.sample(range(words), rng.randrange(8, 40)))
        if k and rng.random() < 0.05:
            own = set(rng.choice(sets))
            own.symmetric_difference_update(rng.sample(range(words), rng.randrange(1, 4)))
        sets.append(own)
    bits = [[0, 0] for _ in sets]
    for k, own in enumerate(sets):
        for w in own:
            bits[k][w >> 6 & 1] ^= 1 << (w & 63)
    parity, parity_2 = (np.array([b[half] for b in bits], np.uint64).view(np.int64) for half in (0, 1))
    return {
        "token": np.full(n, 7), "ord": np.arange(n), "line": np.zeros(n, np.int32), "name": np.arange(n) + 1, "parity": parity,
        "parity_2": parity_2, "size": np.array([len(x) for x in sets], np.int32), "at": np.full(n, at, np.int32),
    }, sets


def test_long_lists_are_compared_in_blocks():
    """A list of 6,000 unlike sets of one class of sizes, far over `pivots`, is not taken apart."""
    rng = np.random.default_rng(4)
    n = 6000
    column = {c: rng.integers(-(1 << 62), 1 << 62, n) for c in ("name", "parity", "parity_2")}
    column |= {"token": np.full(n, 7), "ord": np.arange(n), "line": np.zeros(n, np.int32), "size": np.full(n, 30, np.int32), "at": np.zeros(n, np.int32)}
    met = [(x, y, left) for x, y, left in lines._Lists(column, lines.Similar()).meetings(None)]
    assert not any(y is None for _, y, _ in met)


@pytest.mark.parametrize("every", [False, True])
def test_blocks_give_what_one_by_one_gives(monkeypatch, every):
    column, sets = one_list(1500, 5)
    marked = (np.arange(1500) % 3 == 0).astype(np.int32) if every else None
    given = []
    for many in (lines.MANY_PAIRS, 1 << 60):
        monkeypatch.setattr(lines, "MANY_PAIRS", many)
        monkeypatch.setattr(lines, "BLOCK_SETS", 100)
        own = lines._Lists(column, lines.Similar())
        found = set()
        for x, y, left in own.meetings(marked):
            found |= set(zip(own.column["ord"][x].tolist(), own.column["ord"][y].tolist(), left.tolist(), strict=True))
        given.append(found)
    assert given[0] == given[1] and len(given[0]) > 10
    alike = {(x, y) for x in range(1500) for y in range(x) if 10 * len(sets[x] & sets[y]) >= 8 * len(sets[x] | sets[y])}
    if every:
        assert {p for p in alike if marked[p[0]]} <= {(x, y) for x, y, _ in given[0]}
    else:
        # Nobody stays open who has a similar set before it.
        assert {x for x, _ in alike} <= {x for x, *_ in given[0]}


def test_postings_are_in_order_of_token_place_and_set():
    rng = np.random.default_rng(6)
    kind = np.dtype(lines.POSTED)
    for low, high in ((0, 50), (-(1 << 62), lines.LAST)):
        rows = np.zeros(3000, kind)
        for c in kind.names:
            rows[c] = rng.integers(0, 900 if c == "token" else 3, len(rows))
        rows["ord"] = rng.integers(low, high, len(rows))
        rows["ord"][::7] = lines.LAST if high == lines.LAST else 3
        rows["name"], rows["parity"] = rng.integers(-9, 9, len(rows)), 0
        tokens, counts = np.unique(rows["token"], return_counts=True)
        want = [r for r in rows.tolist() if r[0] in set(tokens[counts > 1].tolist())]
        key = lambda r: (r[0], r[1], r[5], r[2], r[3])
        assert [key(r) for r in lines._in_order(rows).tolist()] == sorted(map(key, want))
    assert len(lines._in_order(rows[:0])) == 0


def some_lines(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    rows = []
    for k in range(200):
        base = [f"b{n}" for n in range(rng.randrange(1, 16))]
        rows.append((k, " ".join([*base, *(f"c{rng.randrange(8)}" for _ in range(rng.randrange(5)))])))
    return rows + [(300 + k, f"a b c d x{k % 40}") for k in range(80)]


def test_lists_taken_apart_by_more_words(spark):
    """So few sets are compared in blocks here that lists count as long."""
    rows = some_lines(9)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    how = lines.Similar(pivots=1, by_bits=1)
    met = lines.candidates(lines.postings(docs, how, lines.rarity(docs, how)), how)
    assert met.filter("name_2 IS NULL").count() > 0
    want = {i: n for i, n in removed_lines(rows).items() if n}
    assert {r["ord"]: set(r["lines"]) for r in lines.removed_lines(docs, how).collect()} == want


def test_open_sets_meet_the_same_by_either_way(spark, monkeypatch):
    """Open lists are read from packed lines or joined with postings."""
    docs = spark.createDataFrame(some_lines(3), "doc_id BIGINT, text STRING")
    how = lines.Similar()
    packed = lines.packed_sets(docs, how, lines.rarity(docs, how)).filter("new").localCheckpoint()
    pairs = lines.candidates(packed, how).filter("left")
    open_ = pairs.selectExpr("token", "name_1 AS name", "parity_1 AS parity").distinct().limit(30).localCheckpoint()
    got = [sorted(tuple(r) for r in lines.other_candidates(packed, open_, how).collect())]
    monkeypatch.setattr(lines, "SMALL_ROWS", 1)
    got.append(sorted(tuple(r) for r in lines.other_candidates(packed, open_, how).collect()))
    assert got[0] == got[1] and len(got[0]) > 30
    assert {r[:2] for r in got[0]} <= {(r["token"], r["name"]) for r in open_.collect()}


def test_the_pipeline_does_not_take_lists_of_some_thousands_apart(spark, monkeypatch):
    """9,000 lines of eight out of sixteen words, none like another: lists of thousands of sets, and no line goes."""

    def never(*_):
        raise AssertionError("a list was taken apart")

    monkeypatch.setattr(lines, "deeper", never)
    own = list(itertools.combinations([f"w{n}" for n in range(16)], 8))
    random.Random(2).shuffle(own)
    texts = ["\n".join(" ".join(x) for x in own[k : k + 20]) for k in range(0, 9000, 20)]
    docs = spark.createDataFrame([(k, x, "en", "a", len(x)) for k, x in enumerate(texts)], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    left = corpus_pipeline.line_dedup(spark, docs, "")
    assert {r["doc_id"]: r["text"] for r in left.collect()} == dict(enumerate(texts))
