"""Results that are to be whole: nothing of a document goes that no other has."""

import random
from collections import Counter, defaultdict

import numpy as np
from cases import documents, frame, removed_lines, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallybook.llm import decontaminate, lines
from tallybook.llm.queries import vocabulary

SHARED = "this licence line stands in very many texts"


def test_unique_short_lines_keep_their_document(spark):
    """A document goes with its last word, not with the last of its lines that were compared."""
    rows = [
        (0, SHARED, "en", "a", 1),
        (1, f"rose red\n{SHARED}\nsky blue", "en", "a", 1),
        (2, f"{SHARED}\n一行没有空格的文字", "zh", "a", 1),
        (3, f"{SHARED}\n \t\n\x0b\n", "en", "a", 1),
        (4, SHARED.upper(), "en", "a", 1),
        (5, "", "en", "a", 0),
        (6, None, "en", "a", 0),
        (7, "short", "en", "a", 5),
    ]
    want = {0: SHARED, 1: "rose red\nsky blue", 2: "一行没有空格的文字", 5: "", 6: None, 7: "short"}
    docs = frame(spark, rows)
    assert {r["doc_id"]: r["text"] for r in lines.without_repeats(docs).collect()} == want
    out = corpus_pipeline.line_dedup(spark, docs, "").collect()
    assert {r["doc_id"]: r["n_chars"] for r in out} == {k: None if t is None else len(t) for k, t in want.items()}


def test_long_lists_of_lines_are_not_broadcast(spark, monkeypatch):
    """Few rows with very many line numbers are joined by a shuffle."""
    monkeypatch.setattr(lines, "SMALL_ROWS", 10)
    for count, sent in ((3, True), (600, False)):
        text = "\n".join(f"a{k} b{k} c{k} d{k} e{k}" for k in range(count))
        out = lines.deduped(frame(spark, [(k, text, "en", "a", 1) for k in range(2)]))
        assert ("strategy=broadcast" in out._jdf.queryExecution().analyzed().toString()) == sent
        assert {r["doc"]["doc_id"]: r["n_removed"] for r in out.collect()} == {0: 0, 1: count}


def test_pipeline_gives_sequences_that_can_be_read(spark, sf):
    """The result alone holds every text that came to the last stage; on the way, only repeats and blanks go."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, sf)
        if name == "line dedup":
            gone, want = removed_lines(list(texts.items())), {}
            for i, t in texts.items():
                left = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
                if not gone[i] or words(left):
                    want[i] = left
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces, sequences = defaultdict(dict), defaultdict(dict)
    for r in corpus_pipeline.run(spark, sf).collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"]
        pieces[r["doc_id"]][r["start"]] = ids
        sequences[r["sequence_id"]][r["offset"]] = ids
    exact = Tokenizer.from_file(vocabulary().definition)
    for i, text in texts.items():
        own = np.concatenate([x for _, x in sorted(pieces[i].items())])
        assert own.tolist() == [*exact.encode(text, add_special_tokens=False).ids, 2]
    assert pieces.keys() == texts.keys()
    for parts in sequences.values():
        at = 0
        for offset, ids in sorted(parts.items()):
            assert offset == at
            at += len(ids)
        assert at <= 1024


def test_pipeline_on_awkward_and_empty_tables(spark, folder):
    """Nulls, repeated ids and rows, clashing names: every stage keeps the columns and adds no row; the clean text stays whole."""
    rng = random.Random(4)
    prose = [" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randrange(3, 8))) for _ in range(60)) for _ in range(4)]
    rows = documents() + [(100 + k, text, "en", "a", len(text)) for k, text in enumerate(prose)]
    names = ("row", "doc", "piece", "ids", "length", "th", "ord", "cid", "words", "line", "kept", "lines")
    docs = frame(spark, rows).withColumns({n: F.lit(n) for n in names})
    item = " ".join(prose[1].split(" ")[10:40])
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, None)], "item_id BIGINT, text STRING")
    for sub, part in (("full", docs), ("empty", docs.limit(0))):
        part.write.parquet(f"{folder}/{sub}/documents.parquet")
        benchmark.write.parquet(f"{folder}/{sub}/benchmark.parquet")
        held = spark.read.parquet(f"{folder}/{sub}/documents.parquet")
        left = Counter(r["doc_id"] for r in held.collect())
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = stage(spark, held, f"{folder}/{sub}")
            assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{sub}/stage{k}")
            held = spark.read.parquet(f"{folder}/{sub}/stage{k}")
            stay = Counter(r["doc_id"] for r in held.collect())
            assert not stay - left
            left = stay
        packed = corpus_pipeline.run(spark, f"{folder}/{sub}").collect()
        assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == left
    exact = Tokenizer.from_file(vocabulary().definition)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/full/stage3").collect()}
    assert {100, 102, 103} <= texts.keys() and 101 not in texts and 1 not in texts
    pieces = defaultdict(dict)
    for r in corpus_pipeline.run(spark, f"{folder}/full").collect():
        pieces[r["doc_id"]][r["start"]] = np.frombuffer(bytes(r["ids"]), "<u4")
    for i in (100, 102, 103):
        assert texts[i] == prose[i - 100]
        own = np.concatenate([x for _, x in sorted(pieces[i].items())])
        assert own.tolist() == [*exact.encode(texts[i], add_special_tokens=False).ids, 2]
    assert not packed


def test_short_items_are_met_as_whole_words(spark):
    items = [(1, "Who was Ada?"), (2, "pi"), (3, "水的化学式是什么"), (4, " "), (5, None)]
    rows = [
        (0, "spin, Pi."),
        (1, "spin pie api"),
        (2, "so who  was\nADA? nobody"),
        (3, "who was ida?"),
        (4, "请问水的化学式是什么呢"),
        (5, "pi"),
        (6, ""),
        (7, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"], r["from"], r["to"]) for r in found} == {
        (0, 2, 0, 6, 8),
        (2, 1, 0, 3, 15),
        (4, 3, 0, 2, 10),
        (5, 2, 0, 0, 2),
    }
    assert {r["doc_id"] for r in decontaminate.clean(docs, benchmark).collect()} == {1, 3, 6, 7}
