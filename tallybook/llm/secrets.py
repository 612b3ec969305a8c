"""Secret scans over every version of every file, each content scanned once per rule version.

A blob is a distinct text, named by its SHA-256. The ledger (a Parquet folder) holds one row per blob and rule version
that was ever scanned, with the spans found, also if there are none. A scan content-addresses the given versions, drops
the (blob, rule version) pairs that the ledger holds, reads one copy of each blob that is left, and appends the new
pairs; findings are then joined back to all paths of a blob. A changed rule gets a new version, and only that rule is
scanned again.

Everything is a DataFrame expression. Positions come from the text between the matches: its pieces and the matches
alternate, so running sums of their lengths are the spans.

Defined results: null text is the empty text, one blob; null and repeated paths are paths like any other; an empty
table finds nothing; extra columns are not read. Offsets count code points, the end is exclusive. Matches are leftmost,
not overlapping, per rule; a match that fails the length test is dropped but has used up its text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import text_or_empty


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    #: The group whose length counts, and its least length.
    group: int = 0
    at_least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns. Where a run has to be long anyway, the pattern asks for the length itself: same matches, less work.
BASE = (
    Rule(
        "assign",
        1,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1,
        at_least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pat", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
#: Matches of a text that are placed together.
RUN = 512
LEDGER = "blob binary, rule string, spans array<struct<from: int, to: int>>"


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<from, to>> of the rule's matches; the text is searched again only where it has one."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, rule.pattern, -1)
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.zip_with(
        F.zip_with(found, measured, lambda m, g: F.struct(F.length(m).alias("size"), F.length(g).alias("counted"))),
        F.slice(between, 1, F.size(found)),
        lambda m, b: F.struct(m["size"].alias("size"), m["counted"].alias("counted"), F.length(b).alias("gap")),
    )
    none = F.array().cast("array<struct<from: int, to: int>>")

    def step(done: Column, m: Column) -> Column:
        start = done["at"] + m["gap"]
        end = start + m["size"]
        span = F.array(F.struct(start.alias("from"), end.alias("to")))
        kept = F.when(m["counted"] >= rule.at_least, F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    def of_run(at: Column, run: Column) -> Column:
        return F.aggregate(run, F.struct(at.alias("at"), none.alias("spans")), step, lambda done: done["spans"])

    def all_spans(steps: Column) -> Column:
        """Runs of matches one by one: arrays that grow are copied at every step, so none grows beyond a run."""
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN)), lambda k: F.slice(steps, k.cast("int") * RUN + 1, RUN))

        def begin(done: Column, run: Column) -> Column:
            chars = F.aggregate(run, F.lit(0), lambda sum_, m: sum_ + m["gap"] + m["size"])
            placed = F.array(F.struct(done["at"].alias("at"), run.alias("run")))
            return F.struct((done["at"] + chars).alias("at"), F.concat(done["runs"], placed).alias("runs"))

        kind = "struct<at: int, runs: array<struct<at: int, run: array<struct<size: int, counted: int, gap: int>>>>>"
        empty = F.struct(F.lit(0).alias("at"), F.array().alias("runs")).cast(kind)
        placed = F.aggregate(runs, empty, begin, lambda done: done["runs"])
        return F.flatten(F.transform(placed, lambda r: of_run(r["at"], r["run"])))

    # Through an array of one, so that the matches are searched once and not for every run.
    spans = F.transform(F.array(steps), all_spans)[0]
    return F.when(text.rlike(rule.pattern), spans).otherwise(none)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def open_ledger(spark: SparkSession, path: str) -> None:
    """An empty ledger, if there is none."""
    spark.range(0).select(F.inline(F.from_json(F.lit("[]"), f"array<struct<{LEDGER}>>"))).write.mode("append").parquet(path)


def content_address(versions: DataFrame) -> DataFrame:
    """versions (path, text) -> path, blob (SHA-256 of the text's UTF-8)."""
    return versions.select("path", F.unhex(F.sha2(F.encode(text_or_empty(F.col("text")), "UTF-8"), 256)).alias("blob"))


def unseen(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, one of its paths, and the keys of the rules it has not been scanned with."""
    wanted = F.array(*(F.lit(r.key) for r in rules))
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    seen = ledger.filter(F.col("rule").isin([r.key for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "path", todo.alias("todo")).filter(F.size("todo") > 0)


def scan(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...]) -> None:
    """Scan what the ledger lacks of versions (path, text) under rules, and append it to the ledger."""
    spark = versions.sparkSession
    todo = unseen(content_address(versions), read_ledger(spark, ledger_path), rules)
    one_copy = todo.select(F.col("path").alias("from_path"), F.col("blob").alias("wanted"), "todo")
    with_text = versions.select(
        "path", "text", F.unhex(F.sha2(F.encode(text_or_empty(F.col("text")), "UTF-8"), 256)).alias("blob")
    ).join(one_copy, F.col("path").eqNullSafe(F.col("from_path")) & (F.col("blob") == F.col("wanted")))
    text = text_or_empty(F.col("text"))
    results = [
        F.when(F.array_contains("todo", r.key), F.struct(F.lit(r.key).alias("rule"), _spans(text, r).alias("spans")))
        for r in rules
    ]
    found = with_text.select("blob", F.array(*results).alias("results"))
    # Below a generator: a filter on the results would run the searches twice.
    rows = found.select("blob", F.inline(F.filter("results", lambda x: x.isNotNull()))).dropDuplicates(["blob", "rule"])
    rows.write.mode("append").parquet(ledger_path)


def findings(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...]) -> DataFrame:
    """path, and its spans (kind, from, to) by start, then in the order of the rules; every path has a row."""
    order = F.from_json(
        F.lit("{" + ", ".join(f'"{r.key}": {k}' for k, r in enumerate(rules)) + "}"), "map<string, int>"
    )
    ledger = read_ledger(versions.sparkSession, ledger_path).filter(
        F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0)
    )
    kind = F.split_part(F.col("rule"), F.lit("@"), F.lit(1))
    span = F.transform(
        "spans", lambda s: F.struct(s["from"].alias("from"), order[F.col("rule")].alias("nr"), kind.alias("kind"), s["to"].alias("to"))
    )
    per_blob = ledger.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list(span))).alias("spans"))
    nothing = F.array().cast("array<struct<from: int, nr: int, kind: string, to: int>>")
    return content_address(versions).join(per_blob, "blob", "left").select("path", F.coalesce("spans", nothing).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["to"].cast("string"))), ","
    )
