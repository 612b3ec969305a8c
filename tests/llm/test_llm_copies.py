"""Line dedup, substring dedup, MinHash, decontamination and the pipeline, against brute force."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest
from cases import components, distance, documents, frame, kept_words, long_text, removed_lines, words
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tallybook.llm import common, decontaminate, hashes, lines, minhash, quality, substrings
from tallybook.llm import components as graph
from tallybook.llm.queries import QUERIES

LOOSE = [(k, t) for k, t, *_ in documents() if k is not None and k not in (0, 13)] + [(0, documents()[0][1])]


def edited(rng: random.Random, count: int = 60, vocabulary: int = 400) -> list[tuple[int, str]]:
    """Texts with copies, edited copies, shared passages, common lines and short ones."""
    rare = [f"v{k}" for k in range(vocabulary)]
    common = "the of and to in is it that for on".split()
    word = lambda: rng.choice(common) if rng.random() < 0.4 else rng.choice(rare)
    line = lambda n: " ".join(word() for _ in range(n))
    passage = line(70)
    made: list[str] = []
    for _ in range(count):
        kind = rng.random()
        if made and kind < 0.15:
            made.append(rng.choice(made))
        elif made and kind < 0.45:
            tokens = rng.choice(made).split(" ")
            for _ in range(rng.randrange(1, 6)):
                tokens[rng.randrange(len(tokens))] = word()
            made.append(" ".join(tokens))
        elif kind < 0.6:
            made.append(f"{line(rng.randrange(40))}\n{passage} {line(rng.randrange(40))}")
        else:
            made.append("\n".join(line(rng.randrange(1, 30)) for _ in range(rng.randrange(1, 8))))
    return list(enumerate(made))


# ---- 4 lines ----


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_by_brute_force(spark, seed):
    rows = edited(random.Random(seed), 120, 120)
    got = lines.deduped(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    gone = removed_lines(rows)
    assert sum(map(len, gone.values())) > 30
    for r in got:
        text = r["doc"]["text"]
        want = [x for k, x in enumerate(text.split("\n")) if k not in gone[r["doc"]["doc_id"]]]
        assert (r["kept_text"], r["n_removed"]) == ("\n".join(want), len(gone[r["doc"]["doc_id"]]))


def test_lines_of_given_documents(spark, sf, given):
    gone = removed_lines(given)
    for r in QUERIES["op4_lines"](spark, sf).collect():
        text = dict(given)[r["doc_id"]]
        want = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[r["doc_id"]])
        assert (r["n_removed"], r["kept_sha256"]) == (len(gone[r["doc_id"]]), hashlib.sha256(want.encode()).hexdigest())


def test_lines_of_awkward_rows(spark):
    docs = frame(spark).withColumns({"doc": F.lit("x"), "lines": F.lit("y"), "kept_text": F.lit("z")})
    out = lines.deduped(docs).collect()
    assert Counter((r["doc"]["doc_id"], r["doc"]["doc"]) for r in out) == Counter((r[0], "x") for r in documents())
    by_id = {r["doc"]["doc_id"]: r for r in out if r["doc"]["doc_id"] not in (None, 0, 13)}
    assert (by_id[5]["n_lines"], by_id[6]["n_lines"], by_id[7]["n_lines"]) == (0, 0, 3)
    assert by_id[1]["n_removed"] == 1 and by_id[15]["n_removed"] == 1 and by_id[8]["n_removed"] == 0
    null_id = [r for r in out if r["doc"]["doc_id"] is None and r["doc"]["text"]]
    assert [r["n_removed"] for r in null_id] == [1]  # later than any other
    left = lines.without_repeats(docs)
    ids = Counter(r["doc_id"] for r in left.collect())
    assert left.columns == docs.columns and ids[0] == 2 and 1 not in ids and ids[5] == ids[6] == 1
    assert lines.deduped(docs.limit(0)).count() == 0


def test_a_second_round_finds_what_the_first_candidate_hides(spark):
    """The first candidate agrees in all filters and is not similar; a later one is."""
    bits = lambda w: int(lines._tokens(hashes.words(w.encode()))[0] & np.uint64(4095))
    pool = [f"k{n}" for n in range(600)]
    rare, base = ["rare1"], pool[:9]
    # Words that flip the same bits as three words of the line.
    twins = [next(w for w in (f"t{n}" for n in range(200_000)) if bits(w) == bits(b)) for b in base[:3]]
    last = pool[20]
    false, true, late = rare + twins + base[3:], rare + base[:8] + [last], rare + base
    known = pool + twins * 4
    filler = [(10 + k, " ".join(known[k : k + 4])) for k in range(len(known) - 4)] * 3
    rows = [(0, " ".join(false)), (1, " ".join(true)), (2, " ".join(late)), *filler]
    gone = removed_lines(rows[:3])
    assert gone == {0: set(), 1: set(), 2: {0}}
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    how = lines.Similar()
    met = lines.candidates(lines.postings(docs, how, lines.rarity(docs, how)), how).collect()
    named = {tuple(int(x[0]) for x in next(lines._sets([" ".join(t).encode()])).names()): k for k, t in enumerate((false, true, late))}
    assert {(named[r["name_1"], r["parity_1"]], named[r["name_2"], r["parity_2"]]) for r in met} >= {(2, 0)}
    assert (2, 1) not in {(named[r["name_1"], r["parity_1"]], named[r["name_2"], r["parity_2"]]) for r in met if r["token"] == lines._tokens(hashes.words(b"rare1")).view(np.int64)[0]}
    want = {i: n for i, n in removed_lines(list(dict.fromkeys(rows))).items() if n}
    assert want[2] == {0} and {r["ord"]: set(r["lines"]) for r in lines.removed_lines(docs).collect()} == want


def test_large_groups_of_lines_are_not_paired_out(spark):
    """400 variants of one line: a row per variant and word of its prefix at most, not one per pair."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(30)]
    rows = []
    for k in range(400):
        own = list(base)
        own[rng.randrange(30)] = f"x{k}"
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    how = lines.Similar()
    assert lines.candidates(lines.postings(docs, how, lines.rarity(docs, how)), how).count() <= 400 * 7
    assert {r["ord"] for r in lines.removed_lines(docs).collect()} == set(range(1, 400))


@pytest.mark.parametrize("pivots", [1, 3])
def test_long_lists_are_taken_apart(spark, monkeypatch, pivots):
    """Every list is long here; what is found by more words is what brute force finds."""
    monkeypatch.setattr(lines, "LIST_ROWS", 50)
    rng = random.Random(pivots)
    rows = []
    for k in range(150):
        base = [f"b{n}" for n in range(rng.randrange(1, 16))]
        rows.append((k, " ".join([*base, *(f"c{rng.randrange(8)}" for _ in range(rng.randrange(5)))])))
    rows += [(200 + k, f"a b c d x{k % 40}") for k in range(80)] + [(300, "a b c d"), (301, "a b c"), (302, "a"), (303, "a a")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    want = {i: n for i, n in removed_lines(rows).items() if n}
    for most in (2, 4):
        how = lines.Similar(pivots=pivots, most_words=most)
        assert {r["ord"]: set(r["lines"]) for r in lines.removed_lines(docs, how).collect()} == want


def test_unlike_lines_with_one_rare_word(spark):
    """40,000 lines under one word, none similar to another but for planted ones."""
    rng = random.Random(8)
    rows = [(k, " ".join(["rare", *(f"w{rng.randrange(3000)}" for _ in range(12))])) for k in range(40_000)]
    rows += [(50_000 + k, rows[k * 1000][1] + " more") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(8)
    how = lines.Similar()
    counts = lines.rarity(docs, how)
    # As if all other words were much more common.
    counts[int(lines._tokens(hashes.words(b"rare"))[0] % np.uint64(how.rarity_buckets))] = 0
    with common.Scratch() as scratch:
        sets = scratch.stored(lines.line_sets(docs, how, counts), "lines")
        start = time.time()
        found = lines.similar_sets(sets.filter("at >= 0"), docs, counts, how, scratch)
        assert time.time() - start < 60
        planted = sets.filter("ord >= 50000").select("name").distinct()
        assert planted.count() == planted.join(found, "name").count() == found.count() == 40


# ---- 5 substrings ----


@pytest.mark.parametrize("seed", [3, 4])
def test_substrings_by_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = edited(rng, 80)
    rows += [(100 + k, " ".join(["same"] * n)) for k, n in enumerate((49, 50, 51, 120))]
    # Passages that begin and end elsewhere in each document, next to one another.
    source = [w for _, t in rows for w in words(t)]
    for k in range(30):
        cuts = [rng.randrange(len(source) - 90) for _ in range(3)]
        rows.append((200 + k, " ".join(w for c in cuts for w in source[c : c + rng.randrange(30, 90)])))
    rng.shuffle(rows)
    out = substrings.parsed(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    want = kept_words(rows)
    assert {r["doc"]["doc_id"]: r["kept_text"] for r in out} == {k: " ".join(v) for k, v in want.items()}
    texts = dict(rows)
    for r in out:
        own = words(r["doc"]["text"])
        for f in r["factors"]:
            stretch = own[f["from"] : f["from"] + f["words"]]
            assert f["words"] >= 50 and f["ref"] < r["doc"]["doc_id"]
            assert stretch == words(texts[f["ref"]])[f["ref_from"] : f["ref_from"] + f["words"]]
        inside = {k for f in r["factors"] for k in range(f["from"], f["from"] + f["words"])}
        assert r["n_removed"] == len(inside)


def test_a_factor_goes_on_over_blocks(spark):
    """A long copy is one factor; where its reference changes, the next factor begins one window later."""
    rng = random.Random(9)
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    a, b = draw(900), draw(700)
    rows = [(1, draw(5) + a), (2, b), (3, draw(7) + a[100:800] + b[50:650] + draw(9)), (4, a[800:] + b[:60])]
    out = substrings.parsed(spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id BIGINT, text STRING")).collect()
    got = {r["doc"]["doc_id"]: [tuple(f) for f in r["factors"]] for r in out}
    assert got == {1: [], 2: [], 3: [(7, 700, 1, 105), (707, 600, 2, 50)], 4: [(0, 100, 1, 805), (100, 60, 2, 0)]}
    place = lambda at: (1, 0, at)
    found = [(0, 3, place(10)), (3, 2, place(13)), (5, 1, place(40)), (6, 4, (2, 0, 0)), (6, 4, (2, 0, 0))]
    assert substrings.factors(found, 50) == [(0, 54, 1, 10), (5, 50, 1, 40), (6, 53, 2, 0)]


def test_hot_contents_go_to_many_tasks(spark):
    """One passage in every document, at other places: its rows are dealt out where they meet their reference."""
    rows = spark.range(40_000).select(F.lit(7).cast("bigint").alias("anchor"), F.col("id").alias("ord"))
    rows = rows.unionByName(spark.range(40_000).select(F.col("id").alias("anchor"), F.col("id").alias("ord")))
    known = rows.groupBy("anchor").agg(F.min("ord").alias("first"), F.count("*").alias("n"))
    met = substrings._met(rows, known, ["anchor"], 80_000)
    assert met.count() == 80_000 and met.columns == ["anchor", "ord", "first"]
    assert met.filter((F.col("anchor") == 7) & (F.col("first") != 0)).count() == 0
    plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in substrings._met(rows, known, ["anchor"], 80_000).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 25_000


def test_substrings_of_awkward_rows(spark):
    docs = frame(spark).withColumns({"doc": F.lit("x"), "factors": F.lit("y"), "ord": F.lit("z")})
    out = substrings.parsed(docs).collect()
    assert Counter((r["doc"]["doc_id"], r["doc"]["factors"]) for r in out) == Counter((r[0], "y") for r in documents())
    by_id = {r["doc"]["doc_id"]: r for r in out if r["doc"]["doc_id"] not in (None, 0, 13)}
    want = kept_words(LOOSE)
    for k in (1, 2, 3, 5, 6, 7, 8, 9, 12, 14):
        assert by_id[k]["kept_text"] == " ".join(want[k])
    assert [r["n_removed"] for r in out if r["doc"]["doc_id"] == 0] == [0, 0]  # rows of one id are no references
    assert [r["n_removed"] for r in out if r["doc"]["doc_id"] is None and r["n_words"]] == [len(words(documents()[0][1]))]
    assert substrings.parsed(docs.limit(0)).count() == 0


# ---- 8 MinHash ----


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_components_by_brute_force(spark, seed):
    rows = edited(random.Random(seed), 150)
    groups = minhash.grouped(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in groups}
    assert got == components(rows)


def test_minhash_of_awkward_rows(spark):
    docs = frame(spark).withColumns({"th": F.lit("x"), "h1": F.lit("y"), "doc": F.lit("z")})
    out = minhash.grouped(docs).collect()
    assert len(out) == len(documents())
    want = components(LOOSE)
    for r in out:
        if r["doc_id"] in want and r["doc_id"] != 13:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert {r["component_id"] for r in out if r["doc_id"] is None} == {0, None}
    kept = Counter(r["doc_id"] for r in minhash.keep_first(docs).collect())
    # 9 and 10 are one text in lower case; both texts of id 13 stay; rows without words all stay.
    assert kept == Counter([0, 4, 5, 6, 7, 8, 9, 11, 12, 13, 13, 14, 15, None])
    assert minhash.keep_first(docs).columns == docs.columns
    assert minhash.grouped(docs.limit(0)).count() == minhash.keep_first(docs.limit(0)).count() == 0


def test_a_chain_of_near_copies(spark):
    """Each text is like the next, the ends are not: links beyond the pivots are found."""
    tokens = [f"t{k}" for k in range(100)]
    rows = []
    for k in range(25):
        rows.append((k, " ".join(tokens)))
        tokens = tokens[4:] + [f"n{k}-{j}" for j in range(4)]
    random.Random(1).shuffle(rows)
    assert components(rows)[24][1] == 0
    got = minhash.grouped(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert {r["component_id"] for r in got} == {0}


def test_a_large_group_is_not_paired_out(spark):
    """400 near copies of one text and 400 texts with one passage: pairs stay in proportion to documents."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(160)]
    passage = [f"p{k}" for k in range(60)]
    rows = [(0, " ".join(base))]
    for k in range(1, 400):
        own = list(base)
        own[rng.randrange(160)] = f"e{k}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, " ".join(passage + [f"q{k}-{j}" for j in range(90)])) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r["component_id"] for r in minhash.grouped(docs).collect()}
    assert got == {k: (0 if k < 1000 else k) for k, _ in rows}
    with common.Scratch() as scratch:
        classes = scratch.stored(minhash.classes_of(minhash.signed(docs)), "classes")
        assert minhash.links(docs, classes, minhash.Signature(), scratch).count() < 10_000
    assert not scratch.tables


@examples(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=4, deadline=None)
def test_connected_components(spark, pairs):
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT")).collect()}
    root = {n: n for p in pairs for n in p}
    for _ in range(40):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: root[n] for n in linked}


# ---- 10 decontamination ----


@examples(st.text(alphabet="abc", min_size=1, max_size=70), st.text(alphabet="abc", max_size=90))
@settings(max_examples=200, deadline=None)
def test_bit_parallel_distance(item, text):
    assert decontaminate.least_distance(decontaminate.masks(item), len(item), text)[0] == min(len(item), distance(item, text))


def test_every_occurrence_within_the_budget_is_found(spark):
    rng = random.Random(11)
    letter = lambda: rng.choice("abcdefghijklmnop ")
    texts = ["".join(letter() for _ in range(rng.randrange(30, 200))) for _ in range(12)]
    items = [(k, t) for k, t in enumerate(texts)] + [(50, None), (51, ""), (52, "too short"), (3, texts[3])]
    rows, n = [], 0
    for k, text in enumerate(texts):
        form = decontaminate.compared(text)
        for edits in (0, 1, int(len(form) * 0.08), int(len(form) * 0.08) + 3):
            body = list(form)
            for _ in range(edits):
                at = rng.randrange(len(body))
                kind = rng.random()
                body[at : at + 1] = [letter()] if kind < 0.4 else [] if kind < 0.7 else [body[at], letter()]
            around = "".join(letter() for _ in range(80))
            rows.append((n, f"{around}  {''.join(body).upper()}\n{around}"))
            n += 1
    rows += [(900, None), (901, ""), (902, long_text())]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    budget = decontaminate.Budget(block_chars=300)  # several passes
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id BIGINT, text STRING"), budget).collect()
    got = Counter((r["doc_id"], r["item_id"], r["distance"]) for r in found)
    want = Counter()
    for doc_id, text in rows[:-3]:
        for item_id, item in items:
            form = decontaminate.compared(item)
            if len(form) >= 25:
                d = distance(form, decontaminate.compared(text))
                if d <= int(len(form) * 0.08):
                    want[(doc_id, item_id, d)] += 1
    assert got == want and len(want) >= 30


def test_decontamination_of_awkward_rows(spark, sf):
    docs = frame(spark).withColumns({"doc": F.lit("x"), "matches": F.lit("y"), "item_id": F.lit("z")})
    items = spark.createDataFrame([(1, documents()[0][1][:60])], "item_id BIGINT, text STRING")
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert {0, 1, 2, 3, 4} & {r["doc_id"] for r in left.collect()} == {4} - ({4} & hit(4, items))
    assert decontaminate.clean(docs, items.limit(0)).count() == len(documents())
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def hit(doc_id, items):
    form = decontaminate.compared(items.first()["text"])
    text = next(t for k, t, *_ in documents() if k == doc_id)
    return {doc_id} if distance(form, decontaminate.compared(text)) <= int(len(form) * 0.08) else set()


def test_exact_passages_of_given_documents(spark, sf, given):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    holds = {(i, r["item_id"]) for i, t in given for r in items if t and r["text"] in t}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op10_decontamination"](spark, sf).collect()}
    assert holds and holds <= found


# ---- pipeline ----


def test_pipeline_by_brute_force(spark, sf):
    """Each stage against a plain version of it on the stage's own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in kept.collect()]
        texts = [(r[0], r[1]) for r in before]
        kept = stage(spark, kept, sf)
        after = [tuple(r) for r in kept.collect()]
        if k < 4:
            assert kept.columns == columns
        if k == 0:
            good = {r["doc"]["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
            assert sorted(after) == sorted(r for r in before if r[0] in good)
        if k == 1:
            gone, want = removed_lines(texts), {}
            for i, t in texts:
                left = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
                if not gone[i] or words(left):
                    want[i] = left
            assert {r[0]: r[1] for r in after} == want
            assert all(r[4] == len(r[1]) for r in after)
        if k == 2:
            groups = components(texts)
            assert sorted(after) == sorted(r for r in before if groups[r[0]][1] == r[0])
        if k == 3:
            items = [decontaminate.compared(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            left = {r[0] for r in after}
            assert all((r in after) == (r[0] in left) for r in before)
            assert not any(x in decontaminate.compared(r[1]) for r in after for x in items)
            assert all(any(x[:9] in decontaminate.compared(r[1]) for x in items) for r in before if r[0] not in left)
        if k == 4:
            assert {r[0] for r in after} == {i for i, _ in texts}
        print(name, len(before), len(after))
    run = corpus_pipeline.run(spark, sf)
    assert sorted(tuple(r)[:5] for r in run.collect()) == sorted(r[:5] for r in after)


def test_lines_are_stored_once_with_their_prefix(spark):
    """A row per line, however many words it is posted under; a set its task has sent before has one word."""
    texts = [(1, "a b c d e f g h i j k\nx y"), (2, "k j i h g f e d c b a\n\nx z")]
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").coalesce(1)
    how = lines.Similar()
    counts = lines.rarity(docs, how)
    packed = lines.packed_sets(docs, how, counts)
    rows = {(r["ord"], r["line"]): r for r in packed.collect()}
    assert {at: (r["size"], r["new"], len(r["tokens"])) for at, r in rows.items()} == {
        (1, 0): (11, True, 3), (1, 1): (2, True, 1), (2, 0): (11, False, 1), (2, 2): (2, True, 1)
    }
    got = sorted((r["ord"], r["line"], r["at"], r["token"]) for r in lines.unpacked(packed).collect())
    want = [(*at, k if r["new"] else -1, t) for at, r in rows.items() for k, t in enumerate(r["tokens"])]
    assert got == sorted(want)
