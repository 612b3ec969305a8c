"""Small tables with every awkward case, and brute-force versions to hold results against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

_PROSE = [
    "the quick brown fox jumps over the lazy dog while seven wizards quietly mix their boxing jars of odd jam",
    "every morning the old baker opened his small shop and carried warm loaves to the market by the river bank",
    "a long train of heavy wagons rolled through the valley before the first light touched the western hills there",
    "nobody in the village remembered when the clock had stopped but all agreed that it was showing the right hour",
]


def long_text(words: int = 60_000) -> str:
    return " ".join(f"w{k * 7919 % 100_003}" for k in range(words))


def documents() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and repeated ids."""
    base = " ".join(_PROSE)
    return [
        (0, base, "en", "a", 1),
        (1, base, "en", "a", 1),  # an exact copy
        (2, base + " indeed", "en", None, 1),  # a near copy
        (3, "\n".join(_PROSE), None, "b", None),  # the same words on lines
        (4, "\n".join([_PROSE[1], "other words make this line differ from what came before it today", _PROSE[0]]), "en", "b", 2),
        (5, None, "en", "a", 0),
        (6, "", None, None, 0),
        (7, " \t\n\n ", "en", "a", 3),
        (8, long_text(), "en", "a", 9),
        (9, "word", "en", "a", 4),
        (10, "Word", "en", "a", 4),
        (11, "12 34 !! ??", "de", "a", 4),
        (12, "Zürich \u00a0 größer \U0001f600 naïve \u2028 x\u0085y", "de", "b", 4),
        (None, base, "en", "a", 1),
        (None, None, None, None, None),
        (0, base, "en", "a", 1),  # a repeated row
        (13, "one text of the same id with nothing in common", "en", "a", 1),
        (13, "another text under the id that the row before has", "en", "a", 1),
        (14, ("again and again the same words come round in this text " * 12).strip(), "en", "a", 1),
        (15, "\n".join(["a line that is written twice in this text here"] * 2 + ["and one that is not"]), "en", "a", 1),
    ]


def frame(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(documents() if rows is None else rows, schema)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(docs: list[tuple[int, str]], percent: int = 75) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of the shingle set, least reachable id), by comparing every pair that shares a shingle."""
    sets = {}
    for i, t in docs:
        w = words(lower(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    holders, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            shared.update((j, i) for j in holders[x])
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), k in shared.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    least = {}
    for i in sets:
        least[find(i)] = min(least.get(find(i), i), i)
    return {i: (len(s), least[find(i)]) for i, s in sets.items()}


def kept_words(docs: list[tuple[int, str]], window: int = 50) -> dict[int, list[str]]:
    first: dict[tuple, int] = {}
    for i, t in sorted(docs):
        w = words(t)
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j : j + window]), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def removed_lines(docs: list[tuple[int, str]], percent: int = 80) -> dict[int, set[int]]:
    """doc_id -> numbers of the lines that an earlier line is like, by comparing all pairs of lines."""
    gone, earlier = {}, []
    for i, t in sorted(docs):
        gone[i] = set()
        for k, line in enumerate(lower(t).split("\n")):
            s = set(words(line))
            if not s:
                continue
            if any(100 * len(s & e) >= percent * len(s | e) for e in earlier):
                gone[i].add(k)
            earlier.append(s)
    return gone


def distance(a: str, b: str) -> int:
    """Least edit distance of a to any stretch of b, by the full table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)
