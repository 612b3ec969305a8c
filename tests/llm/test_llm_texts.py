"""Language, packing, secrets, quality, chat and sharding: brute force, round trips and awkward rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import documents, frame, long_text, words
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import chat, hashes, language, packing, quality, secrets, sharding
from tallybook.llm.queries import QUERIES, vocabulary

EMPTY = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


# ---- hashes ----


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = [(t or "").encode() for _, t, *_ in documents()]
    whole = [hashes.words(t).tolist() for t in texts]
    assert [h.tolist() for h in hashes.words_of(texts)] == whole
    assert [len(h) for h in whole] == [len(words(t.decode())) for t in texts]
    monkeypatch.setattr(hashes, "BLOCK", 64)
    assert [h.tolist() for h in hashes.words_of(texts)] == whole
    names = {}
    for t, h in zip(texts, whole, strict=True):
        for w, x in zip(words(t.decode()), h, strict=True):
            assert names.setdefault(x, w) == w


# ---- 1 language ----


def test_language_on_held_out_rows(spark, sf):
    rows = QUERIES["op1_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    texts = [("en", "the cat and the dog"), ("de", "der hund und die katze"), (None, "zzz zzz"), ("fr", "le chat et le chien")]
    model = language.train(spark.createDataFrame([(t, k) for k, t in texts * 5], "text STRING, lang STRING"))
    assert model.languages == ["de", "en", "fr"]
    docs = frame(spark).select("doc_id", "text", F.lit("x").alias("lang_pred"), F.lit(2).alias("row"))
    out = language.predict(docs, model, ("doc_id", "lang_pred")).collect()
    by_text = {(r["row"]["doc_id"], r["lang_pred"] == "und", r["score"] == 0) for r in out}
    assert {(5, True, True), (6, True, True), (7, True, True), (11, True, True), (9, False, False), (None, True, True)} <= by_text
    assert len(out) == len(documents()) and {r["row"]["lang_pred"] for r in out} == {"x"}
    nothing = language.train(spark.createDataFrame([], "text STRING, lang STRING"))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    one = language.train(spark.createDataFrame([("a b", "en")], "text STRING, lang STRING"))
    assert {r["lang_pred"] for r in language.predict(docs, one).collect()} == {"und", "en"}
    assert language.predict(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [2, 3, 7, 8, 40])
def test_codewords_are_apart(n):
    code = language.codewords(n)
    apart = [(a != b).sum() for k, a in enumerate(code) for b in code[:k]]
    assert min(apart) >= (1 if n < 4 else code.shape[1] // 4)
    assert all(abs(c.sum()) < n for c in code.T)


def test_a_wrong_bit_is_corrected(spark):
    """With one classifier turned round, loss-weighted decoding still finds the language."""
    rng = random.Random(1)
    syllables = {k: [f"{a}{b}" for a in k for b in "aeiou"] for k in ("bdfg", "hjkl", "mnpq", "rstv")}
    rows = [(" ".join("".join(rng.choices(s, k=3)) for _ in range(30)), k) for k, s in syllables.items() for _ in range(10)]
    model = language.train(spark.createDataFrame(rows, "text STRING, lang STRING"))
    model.odds[:, 2] *= -1
    out = language.predict(spark.createDataFrame(rows, "text STRING, doc_id STRING"), model).collect()
    assert all(r["lang_pred"] == r["row"]["doc_id"] for r in out)


# ---- 2 packing ----


def check_packing(rows, docs, most=1024):
    """rows: row, piece, start, length, ids, sequence_id, offset of every document, its ids known by an own encoder."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary().definition)
    want = Counter()
    for doc_id, text in docs:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % most or most
        starts = [0, *range(first, len(ids), most)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[(doc_id, k, a, ids[a:b].tobytes())] += 1
    assert Counter((r["row"]["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] * 4 == len(r["ids"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= most
    return sequences


def test_packing_of_given_documents(spark, sf, given):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs, vocabulary()).collect()
    sequences = check_packing(rows, given)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= 1.02 * -(-total // 1024) + 1
    query = QUERIES["op2_packing"](spark, sf).collect()
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in query) == Counter(
        (r["row"]["doc_id"], r["piece"], zlib.crc32(r["ids"])) for r in rows
    )
    assert len({r["sequence_id"] for r in query}) == len(sequences)


def test_packing_of_awkward_rows(spark):
    docs = frame(spark).withColumns({"piece": F.lit("x"), "length": F.lit(1), "row": F.lit(2)})
    rows = packing.pack(docs, vocabulary(), keep=("doc_id", "piece")).collect()
    check_packing(rows, [(r[0], r[1]) for r in documents()])
    assert {r["row"]["piece"] for r in rows} == {"x"}
    assert packing.pack(docs.limit(0), vocabulary()).count() == 0
    capacity = packing.Capacity(tokens=256, documents=3, attention=20_000, weights=(1, 1, 1))
    rows = [r for r in packing.place(numbered(spark, [7, 100, 100, 3, 141, 50, 1, 1, 1, 1, 90] * 30), capacity).collect()]
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["piece_row"]["length"]))
    for pieces in held.values():
        sizes = [n for _, n in sorted(pieces)]
        assert sum(sizes) <= 256 and len(sizes) <= 3 and sum(n * n for n in sizes) <= 20_000
        assert [o for o, _ in sorted(pieces)] == [sum(sizes[:k]) for k in range(len(sizes))]
    assert len(rows) == 330


def numbered(spark, sizes):
    return packing.number(spark.createDataFrame([(n,) for n in sizes], "length BIGINT"))


@examples(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12), st.sampled_from(["norm", "dot", "best"]), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_plan_keeps_every_constraint(lengths, rule, documents_each):
    cap = packing.Capacity(tokens=64, documents=documents_each, attention=64 * 64, rule=rule)
    placed = Counter()
    for count, holds in packing.plan(lengths, cap):
        assert count > 0
        assert sum(n * k for n, k in holds) <= 64 and sum(k for _, k in holds) <= documents_each
        for n, k in holds:
            placed[n] += count * k
    assert placed == Counter(lengths)


def placed_one_by_one(lengths, cap):
    """What each sequence holds, every piece placed by itself: the brute-force version of the plan."""
    weight = [w / c**2 for w, c in zip(cap.weights, (cap.tokens, cap.documents, cap.attention), strict=True)]
    bins = []
    for length in sorted(lengths, reverse=True):
        need = (length, 1, length * length)

        def merit(left, need=need):
            if cap.rule == "dot":
                return sum(w * x * y for w, x, y in zip(weight, left, need, strict=True))
            return -sum(w * (x - y) ** 2 for w, x, y in zip(weight, left, need, strict=True))

        for _ in range(lengths[length]):
            fit = [(merit(left), left, holds) for left, holds in bins if all(x >= y for x, y in zip(left, need, strict=True))]
            left, holds = max(fit)[1:] if fit else ((cap.tokens, cap.documents, cap.attention), ())
            if fit:
                bins.remove((left, holds))
            same = holds[-1][1] if holds and holds[-1][0] == length else 0
            holds = (*holds[: -1 if same else None], (length, same + 1))
            bins.append((tuple(x - y for x, y in zip(left, need, strict=True)), holds))
    return Counter(holds for _, holds in bins)


@examples(st.dictionaries(st.integers(1, 64), st.integers(1, 12), max_size=8), st.sampled_from(["norm", "dot"]), st.sampled_from([2, 5, 64]))
@settings(max_examples=150, deadline=None)
def test_plan_equals_placing_one_by_one(lengths, rule, documents_each):
    cap = packing.Capacity(tokens=64, documents=documents_each, attention=64 * 64, rule=rule)
    got = Counter()
    for count, holds in packing.plan(lengths, cap):
        got[holds] += count
    assert got == placed_one_by_one(lengths, cap)


ENCODERS: list = []


@examples(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_ranks_encode_like_the_definition(text):
    from tokenizers import Tokenizer

    if not ENCODERS:
        ENCODERS.extend([vocabulary().encoder(), Tokenizer.from_file(vocabulary().definition)])
    fast, exact = ENCODERS
    assert list(fast(text)) == exact.encode(text, add_special_tokens=False).ids




# ---- 3 secrets ----

def spans_of(text):
    found = []
    rules = [
        ("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 1, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
        ("hex", r"[0-9a-f]+", 0, 0, 24),
    ]
    for nr, (kind, pattern, flags, group, least) in enumerate(rules):
        for m in re.finditer(pattern, text, flags):
            if len(m[group]) >= least:
                found.append((m.start(), nr, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_spans_by_brute_force(spark, folder):
    rng = random.Random(2)
    parts = ["password", "PassWD", "token", "secret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "A1B2C3D4E5F6G7H8", "abcdef", "0123456789ab", "é", "😀", "x", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(1500)]
    texts += ["password=token: abcdefgh", "AKIA" * 9, "f" * 23 + " " + "f" * 24, "token==abc token==abcdef", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "path BIGINT, text STRING")
    secrets.open_ledger(spark, folder)
    secrets.scan(docs, folder, secrets.BASE)
    got = {r["path"]: r["t"] for r in secrets.findings(docs, folder, secrets.BASE).select("path", secrets.as_text(F.col("spans")).alias("t")).collect()}
    assert got == {k: spans_of(t or "") for k, t in enumerate(texts)}
    assert sum(map(bool, got.values())) > 200


def test_only_unseen_pairs_are_scanned(spark, folder):
    """A new version of a file, a new rule and a changed rule scan what they add, and nothing twice."""
    secrets.open_ledger(spark, folder)
    first = spark.createDataFrame([("a", "token = abcdefgh"), ("b", "token = abcdefgh"), ("c", "plain")], "path STRING, text STRING")
    assert first.count() == 3
    secrets.scan(first, folder, secrets.BASE)
    assert secrets.read_ledger(spark, folder).count() == 2 * 3
    assert secrets.unseen(secrets.content_address(first), secrets.read_ledger(spark, folder), secrets.BASE).count() == 0
    more = first.unionByName(spark.createDataFrame([("a", "AKIA" + "Z" * 16)], first.schema))
    secrets.scan(more, folder, secrets.BASE)
    assert secrets.read_ledger(spark, folder).count() == 3 * 3
    pem = secrets.Rule("pem", 1, "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
    secrets.scan(more, folder, (*secrets.BASE, pem))
    changed = secrets.Rule("hex", 2, "[0-9a-f]{8,}")
    rules = (secrets.BASE[0], secrets.BASE[1], changed, pem)
    todo = secrets.unseen(secrets.content_address(more), secrets.read_ledger(spark, folder), rules).collect()
    assert [list(r["todo"]) for r in todo] == [["hex@2"]] * 3
    secrets.scan(more, folder, rules)
    ledger = secrets.read_ledger(spark, folder)
    assert ledger.count() == ledger.select("blob", "rule").distinct().count() == 3 * 5
    found = Counter((r["path"], r["t"]) for r in secrets.findings(more, folder, rules).select("path", secrets.as_text(F.col("spans")).alias("t")).collect())
    assert found == Counter({("a", "assign:0:16"): 1, ("b", "assign:0:16"): 1, ("c", ""): 1, ("a", "access:0:20"): 1})


def test_secrets_of_awkward_rows(spark, folder):
    docs = frame(spark).select(F.col("doc_id").alias("path"), "text", F.lit(1).alias("blob"), F.lit(2).alias("spans"))
    secrets.open_ledger(spark, folder)
    secrets.scan(docs, folder, secrets.BASE + secrets.ADDED)
    found = secrets.findings(docs, folder, secrets.BASE + secrets.ADDED).collect()
    assert Counter(r["path"] for r in found) == Counter(r[0] for r in documents())
    assert secrets.findings(docs.limit(0), folder, secrets.BASE).count() == 0


def test_very_many_matches_in_one_text(spark):
    """32,000 matches: the spans are placed in runs, so time grows as the matches do."""
    rule = secrets.Rule("hex", 1, r"[0-9a-f]+", at_least=3)
    sizes = [n % 5 + 1 for n in range(32_000)]
    text = "".join("é" * (n % 3 + 1) + "a" * n for n in sizes)
    want, at = [], 0
    for n in sizes:
        at += n % 3 + 1 + n
        if n >= 3:
            want.append((at - n, at))
    for count in (0, 1, 511, 512, 513, 32_000):
        part = "".join("é" * (n % 3 + 1) + "a" * n for n in sizes[:count])
        docs = spark.createDataFrame([(part,)], "text STRING")
        start = time.time()
        got = docs.select(secrets._spans(F.col("text"), rule).alias("s")).first()["s"]
        assert time.time() - start < 10
        upto = len(part)
        assert [(s["from"], s["to"]) for s in got] == [w for w in want if w[1] <= upto]
    assert len(text) == upto


# ---- 6 quality ----


def test_quality_of_awkward_rows(spark):
    docs = frame(spark).withColumns({"n_words": F.lit("x"), "kept": F.lit("y"), "fence": F.lit("z")})
    out = quality.judge(docs).collect()
    assert Counter((r["doc"]["doc_id"], r["doc"]["n_words"], r["doc"]["kept"]) for r in out) == Counter((r[0], "x", "y") for r in documents())
    by_id = {r["doc"]["doc_id"]: r for r in out}
    assert by_id[5]["n_words"] == by_id[7]["n_words"] == 0 and by_id[5]["base_failed"] and not by_id[5]["kept"]
    assert by_id[14]["base_failed"] and by_id[14]["n_repeat_words"] == by_id[14]["n_words"]
    assert by_id[15]["n_dup_lines"] == 1 and by_id[8]["n_words"] == 60_000
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.judge(docs.limit(0)).count() == 0


def test_thresholds_follow_the_corpus(spark):
    """What is rare in one source is usual in another; the same text is judged by its own source."""
    rng = random.Random(5)
    prose = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))
    marked = lambda: " ".join(w + ("#" if rng.random() < 0.4 else "") for w in prose().split())
    rows = [(k, prose(), "en", "plain", 0) for k in range(150)] + [(200 + k, marked(), "en", "marked", 0) for k in range(150)]
    odd = marked()
    rows += [(900, odd, "en", "plain", 0), (901, odd, "en", "marked", 0)]
    kept = {r["doc"]["doc_id"]: r["kept"] for r in quality.judge(frame(spark, rows)).collect()}
    assert not kept[900] and kept[901]
    assert sum(not v for v in kept.values()) == 1


@pytest.mark.parametrize("count", [1, 5, 30, 99, 100])
def test_a_rare_language_is_judged_by_itself(spark, count):
    """Clean documents with longer words than the corpus has stay, however few; junk among them goes."""
    rng = random.Random(count)
    text = lambda k: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(k, k + 3))) for _ in range(60))
    rows = [(k, text(4), "en", "a", 0) for k in range(300)]
    rows += [(1000 + k, text(11), "fi", f"s{k % 7}", 0) for k in range(count)]
    if count >= 30:
        rows.append((5000, " ".join(["x#$"] * 3 + list("abcdefgh") * 8) + text(1), "fi", "s1", 0))
    kept = {r["doc"]["doc_id"]: r["kept"] for r in quality.judge(frame(spark, rows)).collect()}
    assert all(kept[i] for i in kept if i < 5000)
    assert 5000 not in kept or not kept[5000]


def test_sketches_merge_and_bound_their_error(spark):
    values = spark.range(0, 100_000).select(F.col("id").alias("v"))
    bins = values.select("v", quality.bin_of(F.col("v")).alias("bin")).withColumn("low", quality.lowest_of(F.col("bin")))
    worst = bins.agg(F.max((F.col("v") - F.col("low")) / F.greatest("v", F.lit(1))), F.min(F.col("v") - F.col("low")), F.countDistinct("bin")).first()
    assert worst[0] <= 1 / 32 and worst[1] == 0 and worst[2] < 64 + 32 * 12


# ---- 7 chat ----


def test_turns_of_one_number_are_ordered_by_what_they_say(spark):
    """By raw text, whatever escapes and marks make of it."""
    texts = ["a b", "a", "a<b", "a[b", "a\\b", None, "a\x01", "é", "~", "a~", "<", "[", "\\"]
    rows = [(1, 0, "user", t) for t in texts] + [(1, 0, None, "z"), (1, None, "user", "first")]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").repartition(3)
    out = chat.read_back(chat.format_turns(turns.withColumn("content", chat.text_part(F.col("text"))))).collect()
    said = [("user", "first"), ("", "z"), *(("user", t) for t in sorted((t or "" for t in texts), key=str.encode))]
    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    assert [(r["n_turns"], r["turns_sha256"]) for r in out] == [(len(rows), digest)]


@examples(st.text(alphabet="\\<[|>/]sINSTturnbodyed é😀\n", max_size=40))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    for control in (chat.TURN, chat.BODY, chat.END, "<s>", "</s>", "[INST]", "[/INST]", "<|"):
        assert control not in escaped


def test_control_strings_in_texts(spark, sf):
    row = QUERIES["op7_chat"](spark, sf).filter("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(said)
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_typed_parts(spark):
    parts = [
        ("text", "see <this>", None, None),
        ("image", None, "img-1", 28 * 28 * 3 + 1),
        None,
        ("audio", None, "aud-1", 81),
        ("text", " and ", None, None),
        ("document", None, None, 2),
        ("image", None, "img-2", None),
        ("video", "as text", "x", 5),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, None)]), (1, 2, None, None), (1, 3, "assistant", [])]
    turns = spark.createDataFrame(rows, f"conv_id INT, turn INT, role STRING, content {chat.PARTS}").withColumn("formatted", F.lit("x"))
    out = chat.format_turns(turns).orderBy("turn").collect()
    assert out[0]["formatted"] == "<|turn|>user<|body|>see <\\this><|image:0|><|audio:1|> and <|document:2|><|image:3|>as text<|end|>"
    assert [tuple(a) for a in out[0]["attachments"]] == [(0, "image", "img-1", 4), (1, "audio", "aud-1", 3), (2, "document", None, 3000), (3, "image", "img-2", 0)]
    assert out[1]["formatted"][out[1]["loss_from"] : out[1]["loss_to"]] == "ok"
    assert (out[0]["loss_from"], out[0]["loss_to"]) == (0, 0)
    assert chat.read_turn(out[2]["formatted"]) == ("", "")


def test_chat_of_awkward_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "assistant", "b"), (1, None, "user", None), (None, 1, None, "c"), (None, 0, "user", "c"), (2, 5, "assistant", ""), (2, 5, "assistant", ""), (3, 1, "assistant", long_text())]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").withColumn("n_turns", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns.withColumn("content", chat.text_part(F.col("text"))))).collect()}
    want = {1: [("user", ""), ("assistant", "b"), ("user", "a")], None: [("user", "c"), ("", "c")], 2: [("assistant", "")] * 2, 3: [("assistant", long_text())]}
    assert set(got) == set(want)
    for conv, said in want.items():
        assert got[conv]["n_turns"] == len(said)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert got[conv]["loss_chars"] == sum(len(t) for r, t in said if r == "assistant")
    assert chat.read_back(chat.format_turns(turns.limit(0).withColumn("content", chat.text_part(F.col("text"))))).count() == 0


# ---- 9 sharding ----


def check_shards(rows, shards, total):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
    assert sum(map(len, by_shard.values())) == total
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    sizes = [len(by_shard.get(k, [])) for k in range(shards)]
    assert set(by_shard) <= set(range(shards)) and max(sizes) - min(sizes) <= 1


def test_shards_of_given_documents(spark, sf, given):
    rows = QUERIES["op9_sharding"](spark, sf).collect()
    check_shards(rows, 16, len(given))
    texts = {i: (t or "").encode() for i, t in given}
    assert {(r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows} == {
        (i, len(t) + 1, zlib.crc32(t), "rows", None) for i, t in texts.items()
    }


def test_shards_of_awkward_rows(spark):
    docs = frame(spark).withColumns({"shard": F.lit("x"), "slot": F.lit("y"), "row": F.lit("z"), "block": F.lit("b")})
    rows = sharding.shuffle_to_shards(docs, 3, block_rows=4, cell_rows=2).collect()
    check_shards(rows, 3, len(documents()))
    assert Counter(r["row"]["doc_id"] for r in rows) == Counter(r[0] for r in documents())
    assert sharding.shuffle_to_shards(docs.limit(0), 3).count() == 0
    one = sharding.shuffle_to_shards(docs.limit(1), 16).collect()
    assert [(r["shard"], r["slot"]) for r in one] == [(0, 0)]


def test_the_shuffle_is_uniform(spark):
    """Over many seeds every row comes to every place about equally often."""
    rows = spark.range(0, 8, 1, 2).select(F.col("id").alias("doc_id"))
    seen = Counter()
    for seed in range(60):
        for r in sharding.shuffle_to_shards(rows, 2, seed=seed, block_rows=2, cell_rows=4).collect():
            seen[(r["row"]["doc_id"], r["shard"])] += 1
    assert len(seen) == 16 and all(12 <= n <= 48 for n in seen.values())


def test_draws_follow_the_hypergeometric_law():
    rng = random.Random(4)
    for good, bad, drawn in ((5, 7, 6), (30, 10, 12), (3, 0, 2), (0, 9, 4), (6, 6, 12)):
        got = Counter(sharding.hypergeometric(good, bad, drawn, rng) for _ in range(4000))
        from math import comb

        for k in range(drawn + 1):
            p = comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn) if k <= good and drawn - k <= bad else 0
            assert abs(got[k] / 4000 - p) < 0.04
    big = sharding.hypergeometric(10**10, 3 * 10**10, 10**9, rng)
    assert abs(big - 2.5e8) < 1e5
    blocks, shards = [7, 0, 30, 13], [13, 13, 12, 12]
    drawn = sharding.matrix(blocks, shards, 1)
    assert [sum(r) for r in drawn] == blocks and [sum(c) for c in zip(*drawn, strict=True)] == shards
