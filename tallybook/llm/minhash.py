"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures, confirmed on full sets.

A document's set holds its distinct 5-word shingles; documents with one set are one class, and only classes go on. Each
class has a signature of K independent minima. Two classes with Jaccard similarity s agree in K * s coordinates on
average, and a pair is retained from T agreements on (K and T make a miss at s = 0.75 as unlikely as 1 in 10 million).

Inverted join. A class is posted under (coordinate, value). Two signatures with T agreements of K share a posting among
any K - T + 1 of theirs, if both choose by one order; so each class posts only the prefix of its K - T + 1 rarest
coordinate-value pairs. Long posting lists, as those of a passage that many documents share, come last in that order:
they are skipped, and only looked into for pairs found otherwise, where all K coordinates are compared. Rarity comes from
a table of hashed counts of fixed size; any common order gives the same result.

Pairs. In each list every class is first paired with one pivot, the class with the most postings in common with
others. What is retained is confirmed by the exact similarity of the full sets, and linked classes become components.
Then the lists that still hold classes of several components, those with one pivot taken together, are compared class
by class, between components only, in pairs of blocks of a bounded number of classes: signatures first, and the full sets
of what is left. Of what is found only links that join components are written, so neither copies nor half-similar
versions by the thousand give a row per pair, and no link between components is lost.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with nothing; with
fewer than 5 words the whole sequence is the one shingle; null and repeated ids take part like others (a null id never
names a component unless all its documents have none); an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import Scratch, as_bytes, stored, text_or_empty, with_results
from tallybook.llm.components import components
from tallybook.llm.hashes import distinct, mix, runs, words_of

LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Signature:
    shingle_words: int = 5
    #: Links from similarity percent / 100 on.
    percent: int = 75
    coordinates: int = 128
    #: Agreements a retained pair has at least.
    agreements: int = 70
    #: Size of the table of hashed posting counts.
    rarity_buckets: int = 1 << 16

    @property
    def prefix(self) -> int:
        return self.coordinates - self.agreements + 1


def shingles(words: np.ndarray, length: int, seed: int = 4) -> np.ndarray:
    """The sorted hashes of the distinct shingles; a short sequence is one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return distinct(runs(words, min(length, len(words)), seed))


def signature(hashes: np.ndarray, how: Signature) -> np.ndarray:
    """The upper 32 bits of the minimum under each of the permutations."""
    random = np.random.Generator(np.random.PCG64(0x516))
    turn = random.integers(0, 1 << 64, how.coordinates, np.uint64)
    factor = random.integers(0, 1 << 63, how.coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(how.coordinates, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1024):
        part = (hashes[None, at : at + 1024] ^ turn[:, None]) * factor[:, None]
        np.minimum(least, part.min(1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _set_id(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of shingle hashes."""
    with np.errstate(over="ignore"):
        one = mix(hashes + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(hashes))
        two = mix(hashes ^ np.uint64(0x5DEECE66D1234567)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


SETS = {"n_shingles": T.LongType(), "h1": T.LongType(), "h2": T.LongType(), "signature": T.BinaryType()}


def signed(docs: DataFrame, how: Signature = Signature()) -> DataFrame:
    """docs (doc_id, text) -> doc_id, th (hash of the text), n_shingles, h1 and h2 (name of the set), signature."""
    text = text_or_empty(F.col("text"))
    rows = docs.select(F.struct("doc_id", F.xxhash64(text).alias("th")).alias("row"), text.alias("text"))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        out: list[list] = [[], [], [], []]
        texts = [x.lower() for x in as_bytes(batch.column("text"))]
        for words in words_of(texts):
            found = shingles(words, how.shingle_words)
            one, two = _set_id(found)
            made = (len(found), one, two, signature(found, how).tobytes() if len(found) else b"")
            for column, value in zip(out, made, strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return {k: pa.array(c, t) for k, c, t in zip(SETS, out, kinds, strict=True)}

    return with_results(rows, "row", SETS, work).select("row.*", *SETS)


def classes_of(sets: DataFrame) -> DataFrame:
    """One row per distinct set: cid, n_shingles, h1, h2, signature, a document to read it from, the least doc_id.

    cid numbers the rows, so the table has to be stored before it is used.
    """
    sample = F.struct(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"), "th")
    grouped = (
        sets.filter("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(
            F.min(sample).alias("sample"),
            F.min("doc_id").alias("least_id"),
            F.max("n_shingles").alias("n_shingles"),
            F.max("signature").alias("signature"),
        )
    )
    return grouped.withColumn("cid", F.monotonically_increasing_id())


def _posting_hashes(signatures: pa.Array, how: Signature) -> np.ndarray:
    """classes x coordinates: a hash of (coordinate, value)."""
    values = np.frombuffer(b"".join(signatures.to_pylist()), "<u4").reshape(-1, how.coordinates)
    return mix(values.astype(np.uint64) | (np.arange(how.coordinates, dtype=np.uint64) + np.uint64(1)) << np.uint64(32))


def _rarity(classes: DataFrame, how: Signature) -> np.ndarray:
    """Posting counts by hash bucket."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(how.rarity_buckets, np.int64)
        for batch in batches:
            hashes = _posting_hashes(batch.column("signature"), how) % np.uint64(how.rarity_buckets)
            counts += np.bincount(hashes.ravel().astype(np.int64), minlength=how.rarity_buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=schema.names)

    found = classes.select("signature").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(how.rarity_buckets, np.int64)
    for row in found:
        counts[row["bucket"]] = row["n"]
    return counts


def postings(classes: DataFrame, how: Signature = Signature()) -> DataFrame:
    """posting (hash of coordinate and value), cid: the prefix of each class."""
    # One count per bucket, whatever the corpus.
    rarity = classes.sparkSession.sparkContext.broadcast(_rarity(classes, how))
    schema = T.StructType([T.StructField("posting", T.LongType()), T.StructField("cid", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes = _posting_hashes(batch.column("signature"), how)
            counts = rarity.value[(hashes % np.uint64(how.rarity_buckets)).astype(np.int64)]
            order = np.lexsort((hashes, counts), axis=1)[:, : how.prefix]
            chosen = np.take_along_axis(hashes, order, 1).view(np.int64)
            cids = np.repeat(batch.column("cid").to_numpy(), how.prefix)
            yield pa.RecordBatch.from_arrays([pa.array(chosen.ravel()), pa.array(cids)], names=schema.names)

    return classes.select("signature", "cid").mapInArrow(run, schema)


RETAINED = {"agreements": T.IntegerType()}


def retained(pairs: DataFrame, members: DataFrame, how: Signature) -> DataFrame:
    """pairs (a, b of cid) -> those whose sizes allow a link and whose signatures agree often enough."""
    own = members.select("cid", "n_shingles", "signature")
    left = own.select(F.col("cid").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    right = own.select(F.col("cid").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    joined = pairs.join(left, "a").join(right, "b")
    fits = 100 * F.least("n_a", "n_b") >= how.percent * F.greatest("n_a", "n_b")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        if not batch.num_rows:
            return {"agreements": pa.array([], pa.int32())}
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, how.coordinates) for c in ("s_a", "s_b")
        )
        return {"agreements": pa.array((a == b).sum(1).astype(np.int32))}

    rows = joined.filter(fits).select(F.struct("a", "b").alias("pair"), "s_a", "s_b")
    counted = with_results(rows, "pair", RETAINED, work)
    return counted.filter(F.col("agreements") >= how.agreements).select("pair.*")


def confirmed(pairs: DataFrame, members: DataFrame, how: Signature) -> DataFrame:
    """pairs (a, b) -> those whose full sets are similar enough."""
    left = members.select(F.col("cid").alias("a"), F.col("text").alias("t_a"))
    right = members.select(F.col("cid").alias("b"), F.col("text").alias("t_b"))
    rows = pairs.join(left, "a").join(right, "b").select(F.struct("a", "b").alias("pair"), "t_a", "t_b")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        linked = []
        sides = (words_of([x.lower() for x in as_bytes(batch.column(c))]) for c in ("t_a", "t_b"))
        for a, b in zip(*sides, strict=True):
            a, b = shingles(a, how.shingle_words), shingles(b, how.shingle_words)
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * both >= how.percent * (len(a) + len(b) - both))
        return {"linked": pa.array(linked, pa.bool_())}

    return with_results(rows, "pair", {"linked": T.BooleanType()}, work).filter("linked").select("pair.*")


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def links(docs: DataFrame, classes: DataFrame, how: Signature, scratch: Scratch) -> DataFrame:
    """Confirmed links between classes (a, b), enough to connect every component of the graph of all links."""
    posted = postings(classes, how)
    lists = posted.groupBy("posting").agg(F.count("*").alias("length")).filter("length > 1")
    met = scratch.stored(posted.join(lists, "posting"), "met")

    weight = met.groupBy("cid").agg(F.sum("length").alias("weight"))
    weighed = met.join(weight, "cid")
    pivots = weighed.groupBy("posting").agg(F.max(F.struct("weight", "cid")).alias("top"))
    pivots = pivots.select("posting", F.col("top.cid").alias("pivot"))
    star = met.join(pivots, "posting").filter(F.col("cid") != F.col("pivot"))
    text = text_or_empty(F.col("text"))
    ord_ = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))
    # Only classes that share a posting go on, each with its signature and the text of one document.
    wanted = classes.join(weight.select("cid"), "cid").select("sample.ord", "sample.th", "cid", "n_shingles", "signature")
    sources = docs.select(ord_.alias("ord"), F.xxhash64(text).alias("th"), text.alias("text"))
    # Equal rows give equal texts: one of them is enough. The join has brought them together.
    once = sources.join(wanted, ["ord", "th"]).dropDuplicates(["ord", "th"])
    members = scratch.stored(once.drop("ord", "th"), "members")

    first = scratch.stored(confirmed(retained(_pairs(star, "cid", "pivot"), members, how), members, how), "links")
    roots = components(first)
    rooted = star.select("pivot", "cid").distinct().join(roots, F.col("cid") == F.col("node"), "left")
    groups = rooted.select("pivot", "cid", F.coalesce("root", "cid").alias("root"))
    return first.unionByName(_across(groups, members, how, scratch))


#: Classes of a group are compared in blocks of about so many.
BLOCK_CLASSES = 256


def _blocked(groups: DataFrame) -> DataFrame:
    """groups (pivot, cid, root) -> pivot, i, j, own, cid, root: any two classes of a group meet in one (i, j).

    Groups of one component, or of one class beside its pivot, have nothing to compare.
    """
    several = F.col("low") < F.col("high")
    sizes = groups.groupBy("pivot").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = groups.join(sizes.filter(several), "pivot").withColumn("blocks", F.ceil(F.col("n") / BLOCK_CLASSES))
    placed = open_.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return placed.select(
        "pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "root"
    )


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (pivot, i, j), from batches in that order."""
    held: list[pa.RecordBatch] = []

    def parts(table: pa.Table, last: bool) -> Iterator[pa.Table]:
        keys = np.stack([table.column(c).to_numpy() for c in ("pivot", "i", "j")], 1)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        ends = np.r_[starts[1:], len(keys)]
        for a, b in zip(starts, ends, strict=True):
            if b == len(keys) and not last:
                held.extend(table.slice(a).to_batches())
            else:
                yield table.slice(a, b - a)

    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([*held, batch])
            held.clear()
            yield from parts(table, False)
    if held:
        table = pa.Table.from_batches(held)
        held.clear()
        yield from parts(table, True)


def _open_pairs(table: pa.Table, how: Signature) -> Iterator[tuple[int, np.ndarray]]:
    """Row a and the rows b after it that are of another component and agree with it often enough."""
    signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(-1, how.coordinates)
    sizes, roots, own = (table.column(c).to_numpy() for c in ("n_shingles", "root", "own"))
    first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    left = np.flatnonzero(own == first)
    right = np.flatnonzero(own == second)
    for k, a in enumerate(left):
        b = left[k + 1 :] if first == second else right
        small, large = np.minimum(sizes[b], sizes[a]), np.maximum(sizes[b], sizes[a])
        b = b[(roots[b] != roots[a]) & (100 * small >= how.percent * large)]
        if len(b):
            b = b[(signatures[b] == signatures[a]).sum(1) >= how.agreements]
        if len(b):
            yield int(a), b


def _compared(blocked: DataFrame, members: DataFrame, *columns: str) -> DataFrame:
    """The rows of blocks with what is compared, each (pivot, i, j) in one task and in order."""
    rows = blocked.join(members.select("cid", "n_shingles", "signature", *columns), "cid")
    keys = ["pivot", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "cid")


def _across(groups: DataFrame, members: DataFrame, how: Signature, scratch: Scratch) -> DataFrame:
    """Links (a, b) between components of one group, enough to join all that are linked."""
    alive = T.StructType([T.StructField("pivot", T.LongType()), T.StructField("cid", T.LongType())])
    link = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, cids = [], []
        for table in _block_pairs(batches):
            found = {r for a, b in _open_pairs(table, how) for r in (a, *b.tolist())}
            if found:
                pivots += [table.column("pivot")[0].as_py()] * len(found)
                cids += [table.column("cid")[r].as_py() for r in found]
        yield pa.RecordBatch.from_arrays([pa.array(pivots, pa.int64()), pa.array(cids, pa.int64())], names=alive.names)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []
        for table in _block_pairs(batches):
            cids, roots = table.column("cid").to_numpy(), table.column("root").to_pylist()
            texts = [x.lower() for x in as_bytes(table.column("text").combine_chunks())]
            sets = [shingles(w, how.shingle_words) for w in words_of(texts)]
            joined = {r: r for r in roots}

            def find(r: int, joined: dict[int, int] = joined) -> int:
                while joined[r] != r:
                    r = joined[r]
                return r

            for a, others in _open_pairs(table, how):
                for b in others.tolist():
                    one, two = find(roots[a]), find(roots[b])
                    if one == two:
                        continue
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if 100 * both >= how.percent * (len(sets[a]) + len(sets[b]) - both):
                        joined[one] = two
                        links.append((int(cids[a]), int(cids[b])))
        columns = zip(*links, strict=True) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=link.names)

    blocked = _blocked(groups)
    left = scratch.stored(_compared(blocked, members).mapInArrow(agree, alive).distinct(), "agreeing")
    again = groups.join(left, ["pivot", "cid"])
    return scratch.stored(_compared(_blocked(again), members, "text").mapInArrow(confirm, link), "links")


def grouped(docs: DataFrame, how: Signature = Signature()) -> DataFrame:
    """docs (doc_id, text) -> doc_id, th, n_shingles, component_id, and the document the component keeps (ord, th)."""
    with Scratch() as scratch:
        return stored(_grouped(docs, how, scratch), "groups")


def _grouped(docs: DataFrame, how: Signature, scratch: Scratch) -> DataFrame:
    sets = scratch.stored(signed(docs.select("doc_id", "text"), how), "sets")
    classes = scratch.stored(classes_of(sets), "classes")
    roots = components(links(docs, classes, how, scratch))
    rooted = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "h1", "h2", "sample", "least_id", F.coalesce("root", "cid").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.min("sample").alias("stays"))
    named = rooted.join(groups, "root").select("h1", "h2", "component_id", "stays")
    some = sets.filter("n_shingles > 0").join(named, ["h1", "h2"])
    none = sets.filter("n_shingles = 0").select(
        "*", F.col("doc_id").alias("component_id"), F.struct(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"), "th").alias("stays")
    )
    columns = ["doc_id", "th", "n_shingles", "component_id", "stays"]
    return some.select(*columns).unionByName(none.select(*columns))


def keep_first(docs: DataFrame, how: Signature = Signature()) -> DataFrame:
    """docs with one document of each component, the one with the least id; documents without words all stay."""
    kept = (
        grouped(docs, how)
        .filter("n_shingles > 0")
        .select(F.col("stays.ord").alias("own_ord"), F.col("stays.th").alias("own_th"))
        .distinct()
    )
    text = text_or_empty(F.col("text"))
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"),
        F.xxhash64(text).alias("th"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("empty"),
    )
    found = rows.filter("not empty").join(kept, (F.col("ord") == F.col("own_ord")) & (F.col("th") == F.col("own_th")))
    # Rows that agree in id and text are copies too.
    return found.dropDuplicates(["ord", "th"]).select("doc.*").unionByName(rows.filter("empty").select("doc.*"))
