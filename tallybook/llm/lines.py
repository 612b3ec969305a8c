"""Line dedup by an exact set-similarity join.

A line's set holds its distinct words in lower case (A-Z). A line with a word is removed if an
earlier line, in order of document and place, has a set of Jaccard similarity percent / 100 or more; lines are judged on
the input, not on what is left, so the result does not depend on any order of work. Lines without a word always stay.

Equal sets are settled by grouping: all but the first line go. Sets are posted under the words of their prefix, the
n - ceil(t n) + 1 rarest ones: two similar sets share one of these. Rarity comes from hashed counts of all words in a
table of fixed size; any common order gives the same result. Pairs that meet under a word pass a length filter, a
positional filter (the words from here on have to suffice for the overlap) and a parity filter (128 bits that each word
flips one of: sets that differ in d words differ in at most d bits). What is left is verified on the full sets. Texts are
hashed once for rarity and once for a stored table of lines, each with the words of its prefix, which every later step reads.

A line needs one earlier match, not all of them. So each posting list is read in order, by classes of size, and a set
leaves it with the first earlier set that passes the filters with `margin` bits to spare; up to there, it takes what just
passes as well. Thousands of copies of a line, all a little different, give a row each and not a row per pair. Sets that
left a list and have no similar set among their candidates get all the others in a second round, so nothing is missed.
The first sets of a class are met by all others one by one; if many pairs are left, blocks of sets are compared with blocks
by their parity bits alone, and the filters see what that lets through.
Where unlike lines make a list so long that a set is still open after `pivots` candidates, or `by_bits` times as many sets
in blocks, the list's sets are posted again under its word and each other one of a prefix that is longer by one: similar
sets share two words of that. This goes on, word by word, until no list is long, so no list is compared in full.
Postings go through the shuffle as bytes, many in a row: by row, the JVM took longer with them than the comparison.

Defined results: null and empty texts have no line and stay as they are; null ids count as larger than any other; rows
that agree in id and text are one document, and get the same result; rows that share only the id are ordered by place,
then by a hash of the line's set; an empty table gives an empty table; extra columns stay, whatever their names. Words
are told apart by 46 bits of a hash, within one line or one verified pair of lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import (
    Scratch,
    as_bytes,
    checked_small,
    joined_small,
    parts,
    stored,
    text_or_empty,
    with_results,
)
from tallybook.llm.hashes import distinct, flat_words, mix

LAST = (1 << 63) - 1
#: Tables of up to so many rows (of about 100 bytes) are sent to every task; beyond it the join shuffles.
SMALL_ROWS = 500_000


@dataclass(frozen=True)
class Similar:
    percent: int = 80
    rarity_buckets: int = 1 << 18
    #: Candidates that a set meets in a list before its list counts as long and is taken apart by one more word.
    pivots: int = 2000
    #: Words under which a list may be taken apart; sets that share so many are compared in full.
    most_words: int = 4
    #: Bits below the bound of the parity filter from which on a candidate is taken for similar until verified.
    margin: int = 2
    #: Sets of a list that are compared by their bits alone, in blocks, for the time of one candidate.
    by_bits: int = 32


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty(F.col("text"))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"), F.xxhash64(text).alias("th"), text.alias("text")
    )


@dataclass
class _Sets:
    """The sets of some lines: numbers of the lines, and for each the place of its tokens in `tokens` (sorted)."""

    line: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray

    @property
    def of(self) -> np.ndarray:
        """For each token the place of its line."""
        return np.repeat(np.arange(len(self.line)), self.sizes)

    def parity(self, half: int) -> np.ndarray:
        """64 of the 128 bits, each of which tells whether the set has an odd number of the tokens that flip it."""
        if not len(self.line):
            return np.zeros(0, np.int64)
        mine = (self.tokens >> np.uint64(6) & np.uint64(1)) == half
        bits = np.where(mine, np.uint64(1) << (self.tokens & np.uint64(63)), np.uint64(0))
        return np.bitwise_xor.reduceat(bits, self.starts).view(np.int64)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each set, and the first half of its parity bits."""
        if not len(self.line):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sums = np.add.reduceat(mix(self.tokens + np.uint64(77)), self.starts)
        return mix(sums + self.sizes.astype(np.uint64)).view(np.int64), self.parity(0)


#: Bits of a token; with the number of a line in its block it fits into one number that sorts fast.
TOKEN_BITS = 46
_TOKEN = np.uint64((1 << TOKEN_BITS) - 1)


def _tokens_of(of: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (line, token) pairs in order."""
    if not len(of) or of[-1] < 1 << (64 - TOKEN_BITS):
        packed = distinct(of.astype(np.uint64) << np.uint64(TOKEN_BITS) | tokens)
        return (packed >> np.uint64(TOKEN_BITS)).astype(np.int64), packed & _TOKEN
    order = np.lexsort((tokens, of))
    of, tokens = of[order], tokens[order]
    new = np.r_[True, (of[1:] != of[:-1]) | (tokens[1:] != tokens[:-1])]
    return of[new], tokens[new]


def _tokens(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - TOKEN_BITS)


def _sets(lines: list[bytes]) -> Iterator[_Sets]:
    """The sets of those lines that have a token."""
    for first, hashes, places in flat_words(lines):
        if not len(hashes):
            continue
        of = np.repeat(np.arange(len(places) - 1), np.diff(places))
        of, tokens = _tokens_of(of, _tokens(hashes))
        sizes = np.bincount(of, minlength=len(places) - 1)
        enough = sizes > 0
        tokens = tokens[enough[of]]
        sizes = sizes[enough]
        yield _Sets(np.flatnonzero(enough) + first, np.cumsum(sizes) - sizes, sizes, tokens)


def _by_rarity(sets: _Sets, rare: np.ndarray) -> np.ndarray:
    """The order of the tokens by line, rarity and token; tokens are in order of line and token."""
    of, n = sets.of, len(sets.tokens)
    if n < 1 << 20 and len(sets.line) < 1 << 20:
        rank = np.minimum(rare, (1 << 24) - 1).astype(np.uint64)
        packed = of.astype(np.uint64) << np.uint64(44) | rank << np.uint64(20) | np.arange(n, dtype=np.uint64)
        return (np.sort(packed) & np.uint64((1 << 20) - 1)).astype(np.int64)
    return np.lexsort((np.minimum(rare, (1 << 24) - 1), of))


def _lines(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The lines of all texts of a batch, the row of each, and its number in its text."""
    split = [x.lower().split(b"\n") for x in as_bytes(batch.column("text"))]
    counts = np.array([len(x) for x in split], np.int64)
    rows = np.repeat(np.arange(len(split)), counts)
    numbers = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return [line for x in split for line in x], rows, numbers


#: The counts of a task are sent in so many rows.
SEGMENTS = 64


def rarity(docs: DataFrame, how: Similar) -> np.ndarray:
    """How often words occur, by hash bucket of the word."""
    schema = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("n", T.BinaryType())])

    def sent(counts: np.ndarray) -> pa.RecordBatch:
        split = [(k, x.tobytes()) for k, x in enumerate(np.array_split(counts, SEGMENTS)) if x.any()]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in split], pa.int32()), pa.array([x for _, x in split], pa.binary())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(how.rarity_buckets, np.int64)
        for batch in parts(batches):
            for _, hashes, _ in flat_words([x.lower() for x in as_bytes(batch.column("text"))]):
                buckets = (_tokens(hashes) % np.uint64(how.rarity_buckets)).astype(np.int64)
                counts += np.bincount(buckets, minlength=how.rarity_buckets)
        yield sent(counts)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(how.rarity_buckets, np.int64)
        own = np.array_split(counts, SEGMENTS)
        for batch in batches:
            for k, n in zip(batch.column("segment").to_pylist(), batch.column("n").to_pylist(), strict=True):
                own[k] += np.frombuffer(n, np.int64)
        yield sent(counts)

    found = _keyed(docs).select("text").mapInArrow(run, schema).repartition("segment").mapInArrow(added, schema)
    # A number per bucket, whatever the corpus.
    counts = np.zeros(how.rarity_buckets, np.int64)
    own = np.array_split(counts, SEGMENTS)
    for row in found.collect():
        own[row["segment"]] += np.frombuffer(row["n"], np.int64)
    return counts


#: One row per line and word of its prefix; `at` is the word's place in the order of rarity. A line whose set the task
#: has sent before has one row, with `at` -1.
SETS = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("th", T.LongType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("name", T.LongType()),
        T.StructField("parity", T.LongType()),
        T.StructField("parity_2", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("token", T.LongType()),
        T.StructField("at", T.IntegerType()),
    ]
)
#: The same, one row per line: the words of its prefix in order, or the first one if the set is not `new` to the task.
PACKED = T.StructType([*SETS.fields[:7], T.StructField("tokens", T.ArrayType(T.LongType())), T.StructField("new", T.BooleanType())])
#: Names that a task remembers; a set that is sent twice does no harm.
REMEMBERED = 200_000


def packed_sets(docs: DataFrame, how: Similar, counts: np.ndarray) -> DataFrame:
    """PACKED lines that have a word: the one pass in which texts are hashed for their lines."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        sent: set[int] = set()
        for batch in parts(batches):
            ords, hashes = batch.column("ord").to_numpy(), batch.column("th").to_numpy()
            lines, rows, numbers = _lines(batch)
            for sets in _sets(lines):
                (names, parities), second = sets.names(), sets.parity(1)
                new = np.zeros(len(names), bool)
                for k, name in enumerate(names.tolist()):
                    if name not in sent:
                        sent.add(name)
                        new[k] = True
                if len(sent) > REMEMBERED:
                    sent.clear()
                of = sets.of
                rare = counts[(sets.tokens % np.uint64(how.rarity_buckets)).astype(np.int64)]
                ordered = sets.tokens[_by_rarity(sets, rare)]
                at = np.arange(len(of)) - np.repeat(sets.starts, sets.sizes)
                taken = np.where(new, prefix(sets.sizes, how.percent), 1)
                words = pa.array(ordered[at < taken[of]].view(np.int64))
                row = rows[sets.line]
                wide = (ords[row], hashes[row], numbers[sets.line].astype(np.int32), names, parities, second, sets.sizes.astype(np.int32))
                tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(taken)].astype(np.int32)), words)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in wide), tokens, pa.array(new)], names=PACKED.names)

    # In order, so that the first line of a set in a task is the earliest one there.
    return _keyed(docs).sortWithinPartitions("ord", "th").mapInArrow(run, PACKED)


def unpacked(packed: DataFrame) -> DataFrame:
    """PACKED lines as SETS."""
    wide = packed.select("*", F.posexplode("tokens").alias("place", "token"))
    return wide.withColumn("at", F.when(F.col("new"), F.col("place")).otherwise(-1)).select(*SETS.names)


def line_sets(docs: DataFrame, how: Similar, counts: np.ndarray) -> DataFrame:
    """SETS of all lines that have a word."""
    return unpacked(packed_sets(docs, how, counts))


def postings(docs: DataFrame, how: Similar, counts: np.ndarray) -> DataFrame:
    """The prefixes of all sets."""
    return line_sets(docs, how, counts).filter("at >= 0")


def prefix(sizes: np.ndarray, percent: int, shared: int = 1) -> np.ndarray:
    """Similar sets have so many words in common among so many of their rarest ones."""
    return np.minimum(sizes - (percent * sizes + 99) // 100 + shared, sizes)


PLACE = ["ord", "line"]
SET = ["name", "parity"]
#: Two sets that met: the first is the later one and has left its list with this candidate, or not (`left`). Where it
#: is still open after `pivots` candidates, there is no second one.
PAIRS = T.StructType(
    [
        T.StructField("token", T.LongType()),
        *(T.StructField(f"{c}_{k}", T.LongType()) for k in (1, 2) for c in (*SET, *PLACE)),
        T.StructField("left", T.BooleanType()),
    ]
)
POSTING = ["token", *PLACE, *SET, "parity_2", "size", "at"]


def posting_names(token: np.ndarray, name: np.ndarray) -> np.ndarray:
    """A hash of each pair of a token and a set."""
    return mix(token.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + name.view(np.uint64))


def _order(key: np.ndarray) -> np.ndarray:
    """The stable order of keys that are not negative; small ones are sorted together with their places, which is faster."""
    bits = np.uint64(len(key).bit_length())
    if not len(key) or int(key.max()) >> int(64 - bits):
        return np.argsort(key, kind="stable")
    packed = np.sort(key.astype(np.uint64) << bits | np.arange(len(key), dtype=np.uint64))
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


class _Lists:
    """Whole posting lists, in which sets are compared with those before them.

    Sets can only be similar to sets of their own class of size or the next one on either side, so each list is taken apart by class.
    """

    def __init__(self, column: dict[str, np.ndarray], how: Similar, words: int = 1) -> None:
        token = column["token"]
        number = np.cumsum(np.r_[True, token[1:] != token[:-1]]) - 1 if len(token) else np.zeros(0, np.int64)
        size = column["size"].astype(np.int64)
        key = number * 256 + self.classes(size, how)
        order = _order(key)
        # A set that several tasks sent counts once, at its first line.
        mixed = posting_names(token, column["name"])[order]
        ranked = np.sort(mixed)
        again = np.isin(mixed, distinct(ranked[1:][ranked[1:] == ranked[:-1]])).nonzero()[0]
        if len(again):
            _, first = np.unique(mixed[again], return_index=True)
            order = np.delete(order, np.delete(again, first))
        self.how, self.words = how, words
        self.row = order
        self.column = {c: v[order] for c, v in column.items()}
        self.size = size[order]
        self.reach = self.size - self.column["at"]
        self.bits = [self.column[c].view(np.uint64) for c in ("parity", "parity_2")]
        #: More bits than that no similar set differs in, whatever its size.
        self.cap = self.bound(self.size, self.size * 100 // how.percent)
        #: In order of list, class and place.
        self.sorted = key[order] << 32 | order

    @staticmethod
    def classes(size: np.ndarray, how: Similar) -> np.ndarray:
        """Classes of sizes; those of a list leave a gap to the next list's."""
        return np.minimum(np.floor(np.log(np.maximum(size, 1)) / np.log(100 / how.percent) + 1e-9).astype(np.int64) + 1, 250)

    def apart(self) -> np.ndarray:
        """Rows whose class holds one size, of which different sets are never similar."""
        n = self.size
        own = self.classes(n, self.how)
        single = (self.classes(n - 1, self.how) != own) | (n == 1)
        single &= self.classes(n + 1, self.how) != own
        return single & (-(-self.how.percent * 2 * n // (100 + self.how.percent)) >= n)

    def segment(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row where the rows of its class + step begin, and where those before it end."""
        own = self.sorted >> 32
        if not step:
            rows = np.arange(len(own))
            return np.maximum.accumulate(np.where(np.r_[True, own[1:] != own[:-1]][: len(own)], rows, 0)), rows
        firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][: len(own)])
        starts = np.repeat(np.searchsorted(self.sorted, (own[firsts] + step) << 32), np.diff(np.r_[firsts, len(own)]))
        there = np.flatnonzero(own[np.minimum(starts, len(own) - 1)] == own + step)
        ends = starts.copy()
        ends[there] = np.searchsorted(self.sorted, (own[there] + step) << 32 | self.row[there])
        return starts, ends

    def bound(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """In how many words similar sets of sizes up to n and m can differ; 255 stands for more."""
        return np.minimum((n + m) * (100 - self.how.percent) // (100 + self.how.percent), 255).astype(np.uint8)

    def spare(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that pass all filters, and the bits by which they stay below the parity bound."""
        percent = self.how.percent
        some = np.flatnonzero(np.bitwise_count(self.bits[0][x] ^ self.bits[0][y]) <= self.cap[x])
        x, y = x[some], y[some]
        n, m = self.size[x], self.size[y]
        some = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
        x, y, n, m = x[some], y[some], n[some], m[some]
        overlap = -(-percent * (n + m) // (100 + percent))
        spare = n + m - 2 * overlap - np.bitwise_count(self.bits[0][x] ^ self.bits[0][y])
        some = (spare >= 0) & (np.minimum(self.reach[x], self.reach[y]) >= overlap)
        x, y, spare = x[some], y[some], spare[some]
        spare = spare - np.bitwise_count(self.bits[1][x] ^ self.bits[1][y])
        some = spare >= 0
        return x[some], y[some], spare[some]

    def meetings(self, every: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray]]:
        """Rows x, y (y before x in its list; both pass the filters), and whether x leaves its list with y.

        After `pivots` candidates, or `by_bits` times as many sets that are compared in blocks, x is given without y if a
        longer prefix can take its list apart. With `every`, the rows it marks meet all and never leave.
        """
        least = -(-self.how.percent * self.size // 100)
        splits = (least > self.words) & (self.words < self.how.most_words) & (every is None)
        apart = self.apart()
        open_ = np.ones(len(self.size), bool) if every is None else every[self.row].astype(bool)
        for step in (0, -1, 1):
            starts, ends = self.segment(step)
            x = np.flatnonzero(open_ & (starts < ends) & (~apart if not step else True))
            k = 0
            # The k-th set of every segment against those after it that are still open, all lists at once.
            while len(x):
                one, two, spare = self.spare(x, starts[x] + k)
                if len(one):
                    done = spare >= self.how.margin if every is None else np.zeros(len(one), bool)
                    yield one, two, done
                    open_[one[done]] = every is not None
                k += 1
                x = x[open_[x] & (starts[x] + k < ends[x])]
                if k == min(FEW, self.how.pivots) and len(x):
                    cuts = np.flatnonzero(np.r_[True, starts[x][1:] != starts[x][:-1], True])
                    many = np.add.reduceat(ends[x] - starts[x] - k, cuts[:-1]) >= MANY_PAIRS
                    for g in np.flatnonzero(many):
                        rows = x[cuts[g] : cuts[g + 1]]
                        yield from self.in_blocks(rows, starts[rows[0]], k, ends, splits, open_, every is not None)
                    x = x[~np.repeat(many, np.diff(cuts))]
                if k == self.how.pivots and splits[x].any():
                    long = x[splits[x]]
                    yield long, None, np.zeros(len(long), bool)
                    x = x[~splits[x]]

    def in_blocks(
        self, rows: np.ndarray, start: int, k: int, ends: np.ndarray, splits: np.ndarray, open_: np.ndarray, stay: bool
    ) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray]]:
        """The meetings of rows with the sets of one segment from its k-th on, by bits first, blocks of both at once."""
        most = start + self.how.pivots * self.how.by_bits
        for at in range(0, len(rows), BLOCK_ROWS):
            block = rows[at : at + BLOCK_ROWS]
            # Rows of a class come in order, and their ends too.
            until = np.where(splits[block], np.minimum(ends[block], most), ends[block])
            for first in range(start + k, int(until.max()), BLOCK_SETS):
                some = open_[block] & (until > first)
                block, until = block[some], until[some]
                if not len(block):
                    break
                last = min(first + BLOCK_SETS, int(until.max()))
                bound = self.bound(self.size[block], self.size[first:last].max())
                bits = np.bitwise_count(self.bits[0][block][:, None] ^ self.bits[0][first:last])
                if bound.max() > 16:
                    # Large sets: half of the bits would let too many pass. Two counts of 64 at most fit into a byte.
                    bits += np.bitwise_count(self.bits[1][block][:, None] ^ self.bits[1][first:last])
                one, two = np.divmod(np.flatnonzero(bits <= bound[:, None]), last - first)
                near = two + first < until[one]
                one, two, spare = self.spare(block[one[near]], two[near] + first)
                if not len(one):
                    continue
                done = np.zeros(len(one), bool) if stay else spare >= self.how.margin
                if done.any():
                    # Each row takes what it meets up to the set it leaves with.
                    leaves, where = np.unique(one[done], return_index=True)
                    place = np.minimum(np.searchsorted(leaves, one), len(leaves) - 1)
                    taken = (leaves[place] != one) | (two <= two[done][where][place])
                    one, two, done = one[taken], two[taken], done[taken]
                    open_[leaves] = False
                yield one, two, done
        long = rows[splits[rows] & open_[rows] & (ends[rows] > most)]
        if len(long):
            yield long, None, np.zeros(len(long), bool)


#: Sets of a segment that all others meet one by one before the rest is compared in blocks, if it has so many pairs.
FEW = 4
MANY_PAIRS = 3000
#: Rows and sets of a block; its bits fit into a processor's cache.
BLOCK_ROWS = 256
BLOCK_SETS = 1024
#: Rows of posting lists handled together.
LIST_ROWS = 300_000
#: Postings travel as bytes, those of a bucket of tokens together: a row of Spark's costs more than the work on it.
POSTED = [("token", "<i8"), ("ord", "<i8"), ("name", "<i8"), ("parity", "<i8"), ("parity_2", "<i8"), ("line", "<i4"), ("size", "<i4"), ("at", "<i4")]
DEALT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("postings", T.BinaryType())])
#: Buckets of tokens for each partition of a shuffle, so that partitions get about as much, and in all.
BUCKETS_A_PARTITION = 32
MOST_BUCKETS = 1 << 15


@dataclass
class _Open:
    """Pairs of a token and a set whose lists are to be read again."""

    tokens: np.ndarray
    names: np.ndarray

    def __post_init__(self) -> None:
        self.tokens, self.names = distinct(self.tokens), distinct(self.names)
        # Most tokens are told from these by a few of their bits.
        self.some = np.zeros(1 << 22, bool)
        self.some[self.tokens & ((1 << 22) - 1)] = True

    def lists(self, token: np.ndarray) -> np.ndarray:
        """Places of the tokens that are among these."""
        near = np.flatnonzero(self.some[token & ((1 << 22) - 1)])
        return near[_among(token[near], self.tokens)]


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each is among the known ones, which are in order."""
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x if len(known) else np.zeros(len(x), bool)


def _records(batch: pa.RecordBatch, kind: np.dtype, open_: _Open | None) -> np.ndarray:
    """Postings, or PACKED lines, as an array of postings; of open ones the whole lists, with their sets marked."""
    made: dict[str, np.ndarray] = {}
    if "tokens" in batch.schema.names:
        sizes = batch.column("tokens").value_lengths().to_numpy()
        of = np.repeat(np.arange(len(sizes)), sizes)
        made = {"token": batch.column("tokens").flatten().to_numpy(), "at": np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)}
    else:
        of = np.arange(batch.num_rows)
        made = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "at")}
    if open_:
        some = open_.lists(made["token"])
        of, made = of[some], {c: x[some] for c, x in made.items()}
        names = posting_names(made["token"], batch.column("name").to_numpy(zero_copy_only=False)[of])
        made["wanted"] = _among(names, open_.names)
    rows = np.empty(len(of), kind)
    for c in kind.names:
        rows[c] = made[c] if c in made else batch.column(c).to_numpy(zero_copy_only=False)[of]
    return rows


def _dealt(lists: DataFrame, kind: np.dtype, open_: _Open | None) -> DataFrame:
    """DEALT postings, those of a bucket in one partition and together."""
    shared = lists.sparkSession.sparkContext.broadcast(open_) if open_ else None
    buckets = min(BUCKETS_A_PARTITION * int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        bucket = (mix(rows["token"].view(np.uint64)) % np.uint64(buckets)).astype(np.uint16)
        sizes = np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(sizes)
        data = rows[np.argsort(bucket, kind="stable")].view(np.uint8)
        places = np.r_[0, np.cumsum(sizes[some])] * kind.itemsize
        blobs = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), blobs], names=DEALT.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in parts(batches, 10_000):
            held.append(_records(batch, kind, shared.value if shared else None))
            if sum(map(len, held)) >= LIST_ROWS:
                yield sent(held)
                held = []
        if sum(map(len, held)):
            yield sent(held)

    return lists.mapInArrow(run, DEALT).repartition("bucket").sortWithinPartitions("bucket")


def _in_order(rows: np.ndarray) -> np.ndarray:
    """Postings by token, place and set; those of a token that occurs once are left out, for they meet nothing."""
    if not len(rows):
        return rows
    order = np.argsort(rows["token"])
    token = rows["token"][order]
    new = np.r_[True, token[1:] != token[:-1], True]
    some = ~(new[:-1] & new[1:])
    order, number = order[some], np.cumsum(new[:-1])[some]
    place = rows["ord"][order]
    low, line = place.min(initial=LAST), rows["line"][order]
    wide, long = int(place.max(initial=0)) - int(low), int(line.max(initial=0)).bit_length()
    if len(order) and (int(number[-1]).bit_length() + wide.bit_length() + long) < 64:
        at = number << (wide.bit_length() + long) | (place - low) << long | line
        ranked = np.argsort(at)
        at = at[ranked]
        # Rows that share an id only are in order of their sets.
        tied = (at[1:] == at[:-1]).any()
        order = order[ranked]
    else:
        tied = True
    rows = rows[order]
    return rows[np.lexsort(tuple(rows[c] for c in ("parity", "name", "line", "ord", "token")))] if tied else rows


def _whole_lists(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[dict[str, np.ndarray]]:
    """Postings in parts that end with a bucket, and so with a list."""
    held: list[np.ndarray] = []
    size, last = 0, None

    def joined() -> dict[str, np.ndarray]:
        rows = _in_order(np.concatenate(held))
        return {c: np.ascontiguousarray(rows[c]) for c in kind.names}

    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("postings"), strict=True):
            if bucket != last and size >= LIST_ROWS:
                yield joined()
                held, size = [], 0
            held.append(np.frombuffer(data.as_py(), kind))
            size, last = size + len(held[-1]), bucket
    if size:
        yield joined()


def _gathered(meetings: Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same in fewer parts; y is -1 where there is none."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for x, y, left in meetings:
        held.append((x, np.full(len(x), -1) if y is None else y, left))
        size += len(x)
        if size >= 10_000:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def _met(lists: DataFrame, how: Similar, marked: bool, words: int = 1, open_: _Open | None = None) -> DataFrame:
    """PAIRS of sets that meet under a token and pass the filters; the second one is the earlier.

    Takes postings or PACKED lines. Where some of them are marked, by `wanted` or by open_, only these meet others.
    """
    kind = np.dtype([*POSTED, ("wanted", "<i4")] if marked else POSTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for column in _whole_lists(batches, kind):
            own = _Lists(column, how, words)
            for x, y, left in _gathered(own.meetings(column["wanted"] if marked else None)):
                ends = [pa.array(own.column[c][x].astype(np.int64)) for c in (*SET, *PLACE)]
                ends += [pa.array(own.column[c][y].astype(np.int64), mask=y < 0) for c in (*SET, *PLACE)]
                yield pa.RecordBatch.from_arrays([pa.array(own.column["token"][x]), *ends, pa.array(left)], names=PAIRS.names)

    return _dealt(lists, kind, open_).mapInArrow(run, PAIRS)


def _columns(posted: DataFrame) -> list[str]:
    return [c for c in POSTING if c not in ("token", "at")] + ["tokens"] if "tokens" in posted.columns else POSTING


def candidates(posted: DataFrame, how: Similar, words: int = 1) -> DataFrame:
    """For each token and set its candidates up to the first likely one; a list stands for so many words.

    Takes postings or PACKED lines.
    """
    return _met(posted.select(*_columns(posted)), how, marked=False, words=words)


def other_candidates(posted: DataFrame, open_: DataFrame, how: Similar) -> DataFrame:
    """All candidates of the sets in open_ (token, name, parity) under those tokens."""
    if open_.count() <= SMALL_ROWS:
        few = open_.select("token", "name").distinct().toPandas()
        token, name = (few[c].to_numpy(np.int64) for c in ("token", "name"))
        return _met(posted.select(*_columns(posted)), how, marked=True, open_=_Open(token, posting_names(token, name)))
    posted = unpacked(posted) if "tokens" in posted.columns else posted
    tokens = joined_small(posted.select(*POSTING), open_.select("token").distinct(), ["token"], SMALL_ROWS)
    wanted = open_.select("token", *SET, F.lit(1).alias("wanted")).distinct()
    lists = tokens.join(wanted, ["token", *SET], "left").withColumn("wanted", F.coalesce("wanted", F.lit(0)))
    return _met(lists, how, marked=True)


def deeper(posted: DataFrame, long: DataFrame, docs: DataFrame, counts: np.ndarray, how: Similar, words: int, scratch: Scratch) -> DataFrame:
    """Postings of long lists under one more word each: `words` in all.

    Two similar sets have `words` words in common among prefix(.., words) of theirs, so those that met in a long list
    meet again under a pair of its word and another. Postings (token, where, set) of the lists `long` (token) are
    given; `used` has the words that a list stands for.
    """
    lists = joined_small(posted, long.select("token").distinct(), ["token"], SMALL_ROWS)
    lists = scratch.stored(lists, "long-lists")
    sets = scratch.stored(_texts_of(docs, lists.select(*PLACE)), "line-tokens")
    rows = lists.select(F.struct(*POSTING, "used").alias("row"), *SET).join(sets, SET).select("row", "tokens")
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    kind = T.StructType([*(f for f in lists.schema.fields if f.name in POSTING), lists.schema["used"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in parts(batches):
            out = []
            for row, data in zip(batch.column("row").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                own = np.frombuffer(data, np.uint64)
                rare = counts[(own % np.uint64(how.rarity_buckets)).astype(np.int64)]
                ranked = own[np.lexsort((own, np.minimum(rare, (1 << 24) - 1)))].view(np.int64)
                first = ranked[: prefix(np.array([len(own)]), how.percent, words)[0]].tolist()
                for word in first:
                    if word not in row["used"]:
                        used = sorted([*row["used"], word])
                        token = int(mix(np.array([hash(tuple(used)) & (1 << 63) - 1], np.uint64)).view(np.int64)[0])
                        out.append(row | {"token": token, "used": used, "at": 0})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema(
        [(f.name, pa.list_(pa.int64()) if f.name == "used" else pa.int32() if f.dataType == T.IntegerType() else pa.int64()) for f in kind]
    )
    return scratch.stored(rows.mapInArrow(run, kind), "long-lists")


TOKENS = T.StructType([SETS["name"], SETS["parity"], T.StructField("tokens", T.BinaryType())])


def _texts_of(docs: DataFrame, places: DataFrame) -> DataFrame:
    """name, parity and the tokens of the sets at the given places (ord, line), each once."""
    per_doc = places.groupBy("ord").agg(F.collect_set("line").alias("lines"))
    rows = joined_small(_keyed(docs), per_doc, ["ord"], SMALL_ROWS, "lines").select("text", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            lines = []
            for text, numbers in zip(as_bytes(batch.column("text")), batch.column("lines").to_pylist(), strict=True):
                own = text.lower().split(b"\n")
                # Another row of the same id may have fewer lines.
                lines += [own[k] for k in numbers if k < len(own)]
            for sets in _sets(lines):
                names, parities = sets.names()
                tokens = [x.tobytes() for x in np.split(sets.tokens, sets.starts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(parities), pa.array(tokens)], names=TOKENS.names)

    return rows.mapInArrow(run, TOKENS).dropDuplicates(SET)


def verified(pairs: DataFrame, sets: DataFrame, how: Similar) -> DataFrame:
    """The pairs whose full sets are similar."""
    joined = pairs
    for k in (1, 2):
        own = sets.select(*(F.col(c).alias(f"{c}_{k}") for c in ("name", "parity", "tokens")))
        joined = joined.join(own, [f"name_{k}", f"parity_{k}"])
    rows = joined.select(F.struct(*pairs.columns).alias("pair"), "tokens_1", "tokens_2")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        out = []
        for one, two in zip(batch.column("tokens_1").to_pylist(), batch.column("tokens_2").to_pylist(), strict=True):
            a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= how.percent * (len(a) + len(b) - both))
        return {"similar": pa.array(out, pa.bool_())}

    return with_results(rows, "pair", {"similar": T.BooleanType()}, work).filter("similar").select("pair.*")


def _ends(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """What both ends of pairs have in these columns."""
    sides = [pairs.select(*(F.col(f"{c}_{k}").alias(c) for c in columns)) for k in (1, 2)]
    return sides[0].unionByName(sides[1]).distinct()


def _similar(pairs: DataFrame, docs: DataFrame, how: Similar, scratch: Scratch) -> DataFrame:
    """The first sets of the pairs that are similar."""
    sets = scratch.stored(_texts_of(docs, _ends(pairs, PLACE)), "line-tokens")
    ends = [f"{c}_{k}" for k in (1, 2) for c in SET]
    good = verified(pairs.select(*ends).distinct(), sets, how)
    return scratch.stored(good.select(*(F.col(f"{c}_1").alias(c) for c in SET)).distinct(), "similar-lines")


def similar_sets(posted: DataFrame, docs: DataFrame, counts: np.ndarray, how: Similar, scratch: Scratch) -> DataFrame:
    """name, parity of the sets that are like a set with an earlier first line; takes postings or PACKED lines."""
    found, words = None, 1
    while True:
        met = scratch.stored(candidates(posted, how, words), "line-pairs")
        pairs = met.filter(F.col("name_2").isNotNull())
        new = _similar(pairs, docs, how, scratch)
        # Sets that left a list and were not settled get what else is there.
        gone = pairs.filter("left").select("token", F.col("name_1").alias("name"), F.col("parity_1").alias("parity"))
        open_ = scratch.stored(gone.join(new, SET, "left_anti"), "open-lines")
        if not open_.isEmpty():
            more = scratch.stored(other_candidates(posted, open_, how), "line-pairs")
            new = new.unionByName(_similar(more, docs, how, scratch))
        found = new if found is None else found.unionByName(new)
        # Lists in which sets met their share of candidates are taken apart by one more word.
        long = met.filter(F.col("name_2").isNull())
        if long.isEmpty():
            return found.distinct()
        words += 1
        if "tokens" in posted.columns:
            posted = unpacked(posted)
        if "used" not in posted.columns:
            posted = posted.withColumn("used", F.array("token"))
        posted = deeper(posted, long, docs, counts, how, words, scratch)


def removed_lines(docs: DataFrame, how: Similar = Similar()) -> DataFrame:
    """ord, th, lines: the numbers of the lines that go."""
    with Scratch() as scratch:
        return stored(_removed(docs, how, scratch), "removed-lines")


def _removed(docs: DataFrame, how: Similar, scratch: Scratch) -> DataFrame:
    counts = rarity(docs, how)
    sets = scratch.stored(packed_sets(docs, how, counts), "lines")
    similar = similar_sets(sets.filter("new"), docs, counts, how, scratch)
    lines = sets.select("ord", "th", "line", *SET)
    repeated = lines.groupBy(*SET).count().filter("count > 1").select(*SET, F.lit(False).alias("similar"))
    told = repeated.unionByName(similar.withColumn("similar", F.lit(True))).groupBy(*SET).agg(F.max("similar").alias("similar"))
    touched = scratch.stored(joined_small(lines, told, SET, SMALL_ROWS), "touched-lines")
    place = F.struct("ord", "line", "th")
    firsts = touched.filter(~F.col("similar")).groupBy(*SET).agg(F.min(place).alias("first"))
    later = joined_small(touched.filter(~F.col("similar")), firsts, SET, SMALL_ROWS).filter(place > F.col("first"))
    gone = touched.filter("similar").select("ord", "th", "line").unionByName(later.select("ord", "th", "line"))
    return gone.groupBy("ord", "th").agg(F.collect_set("line").alias("lines"))


def deduped(docs: DataFrame, how: Similar = Similar()) -> DataFrame:
    """docs (doc_id, text and others) -> `doc` (the whole row), n_lines, n_removed and the kept text."""
    gone = removed_lines(docs, how).select(F.col("ord").alias("own_ord"), F.col("th").alias("own_th"), "lines")
    text = text_or_empty(F.col("text"))
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"),
        F.xxhash64(text).alias("th"),
    )
    own = (F.col("ord") == F.col("own_ord")) & (F.col("th") == F.col("own_th"))
    rows = rows.join(checked_small(gone, SMALL_ROWS, "lines"), own, "left")
    kinds = {
        "n_lines": T.LongType(),
        "n_removed": T.LongType(),
        "kept_text": T.StringType(),
    }

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        counts, removed, kept = [], [], []
        texts = as_bytes(batch.column("doc").field("text"))
        for text, numbers in zip(texts, batch.column("lines").to_pylist(), strict=True):
            lines, drop = text.split(b"\n") if text else [], set(numbers or ())
            left = [line for k, line in enumerate(lines) if k not in drop]
            counts.append(len(lines))
            removed.append(len(drop))
            kept.append(b"\n".join(left).decode())
        return {
            "n_lines": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(kept, pa.string()),
        }

    return with_results(rows.select("doc", "lines"), "doc", kinds, work)


def without_repeats(docs: DataFrame, how: Similar = Similar()) -> DataFrame:
    """The documents with the removed lines taken out of their texts.

    A document that loses lines and has no word left goes.
    """
    has_word = F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    done = deduped(docs, how).filter((F.col("n_removed") == 0) | has_word)
    text = F.when(F.col("n_removed") == 0, F.col("doc.text")).otherwise(F.col("kept_text"))
    return done.withColumn("doc", F.col("doc").withField("text", text)).select("doc.*")
