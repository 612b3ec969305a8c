"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with each white space run as one space. A test item of m characters may be met with up
to k = floor(m * error_share) edits. Cut into k + 1 pieces, at least one piece of an occurrence with k edits is
untouched, so every occurrence has an exact piece hit at nearly its place. All pieces are searched at once (an
Aho-Corasick automaton); around each hit, overlapping windows merged, Myers' bit-parallel algorithm finds the least edit
distance of the item to any stretch of the document. No occurrence within the budget is missed.

The items are the queries: they are read in blocks of bounded size, and each block goes over all documents. Defined
results: null and empty items match nothing; items of fewer than `min_chars` characters are met without an edit and as
whole words only, with `to` - `from` as their length, so that a caller may leave out what occurs by chance; null and
empty documents have no match; repeated items and documents are matched each; empty tables give empty tables; extra
columns of documents stay as they are. Positions are code points of the compared form.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import with_results

MATCH = "array<struct<item_id: bigint, distance: int, budget: int, from: int, to: int>>"


@dataclass(frozen=True)
class Budget:
    #: Edits per character of an item.
    error_share: float = 0.08
    #: Shorter items are met exactly, as whole words.
    min_chars: int = 25
    #: Characters of items searched in one pass over the documents.
    block_chars: int = 4_000_000

    def edits(self, chars: int) -> int:
        return int(chars * self.error_share) if chars >= self.min_chars else 0


def compared(text: str | None) -> str:
    return " ".join((text or "").lower().split())


#: A letter or digit of a script that parts its words.
_JOINS = re.compile(r"[^\W_\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] neither begins nor ends inside a word."""
    return not any(0 < k < len(text) and _JOINS.match(text[k - 1]) and _JOINS.match(text[k]) for k in (start, end))


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item cut into edits + 1 pieces of nearly equal length, with their places."""
    cuts = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    """For each character the places where the item has it, as bits."""
    out: dict[str, int] = {}
    for k, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << k
    return out


def least_distance(bits: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of an item of m characters to any stretch of text, and where that stretch ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for k, c in enumerate(text, 1):
        eq = bits.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(xv | up) & full
        minus = up & xv
        if score < best:
            best, end = score, k
    return best, end


class Matcher:
    """One block of items."""

    def __init__(self, items: list[tuple[int, str]], budget: Budget) -> None:
        import ahocorasick

        self.items = [(i, text, budget.edits(len(text)), masks(text)) for i, text in items]
        self.short = [len(text) < budget.min_chars for _, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for nr, (_, text, edits, _) in enumerate(self.items):
            for at, piece in pieces(text, edits):
                places.setdefault(piece, []).append((nr, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Item number and a stretch of text that may hold it; stretches of an item that overlap are one."""
        starts: dict[int, list[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for nr, at in where:
                if not self.short[nr] or whole_words(text, last + 1 - size, last + 1):
                    starts.setdefault(nr, []).append(last + 1 - size - at)
        for nr, found in starts.items():
            _, item, edits, _ = self.items[nr]
            low = high = None
            for start in sorted(set(found)):
                a, b = max(0, start - edits), min(len(text), start + len(item) + edits)
                if high is not None and a <= high:
                    high = max(high, b)
                    continue
                if high is not None:
                    yield nr, low, high
                low, high = a, b
            yield nr, low, high

    def matches(self, text: str) -> list[dict[str, int]]:
        """The best occurrence of each item found in a text in the compared form."""
        best: dict[int, dict[str, int]] = {}
        for nr, a, b in self.windows(text):
            item_id, item, edits, bits = self.items[nr]
            distance, end = least_distance(bits, len(item), text[a:b])
            if distance <= edits and (nr not in best or distance < best[nr]["distance"]):
                best[nr] = {
                    "item_id": item_id,
                    "distance": distance,
                    "budget": edits,
                    "from": max(0, a + end - len(item)),
                    "to": a + end,
                }
        return list(best.values())


def _blocks(items: DataFrame, budget: Budget) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text) in the compared form, in blocks."""
    block: list[tuple[int, str]] = []
    size = 0
    for item_id, text in items.select("item_id", "text").toLocalIterator():
        form = compared(text)
        if not form:
            continue
        block.append((item_id, form))
        size += len(form)
        if size >= budget.block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def _with_matches(rows: DataFrame, block: list[tuple[int, str]], budget: Budget) -> DataFrame:
    kind = T._parse_datatype_string(MATCH)
    shared = rows.sparkSession.sparkContext.broadcast(block)
    arrow = pa.list_(
        pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32()), ("from", pa.int32()), ("to", pa.int32())])
    )
    matcher: list[Matcher] = []

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        if not matcher:
            matcher.append(Matcher(shared.value, budget))
        found = [matcher[0].matches(compared(x.as_py())) for x in batch.column("doc").field("doc").field("text")]
        return {"matches": pa.array(found, arrow)}

    return with_results(rows, "doc", {"matches": kind}, work)


def matched(docs: DataFrame, items: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """docs (text and others) -> `doc` (the whole row) and `matches`, the best occurrence of each item met."""
    out = docs.select(F.struct("*").alias("doc"), F.array().cast(MATCH).alias("matches"))
    for block in _blocks(items, budget):
        own = _with_matches(out.select(F.struct("doc", "matches").alias("doc")), block, budget)
        out = own.select("doc.doc", F.concat("doc.matches", "matches").alias("matches"))
    return out


def contaminated(docs: DataFrame, items: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row per document and item met: doc_id, item_id, distance, budget, from, to."""
    return matched(docs.select("doc_id", "text"), items, budget).select("doc.doc_id", F.inline("matches"))


def clean(docs: DataFrame, items: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """The documents that meet no item, with their columns."""
    return matched(docs, items, budget).filter(F.size("matches") == 0).select("doc.*")
