"""The queries that SQL can express, for DuckDB over the same tables.

Not among them: op1 (a trained model), op2 (a tokenizer), op9 (any
uniform shuffle is right), op10 (edit distance to any stretch of a text), op11 (a trained model), op13 (eigenvectors) and
the pipeline. Tests hold those against brute force, round trips and held-out accuracy.
"""

from __future__ import annotations

from tallybook.llm.chat import BODY, END, LOSS_ROLE, TURN
from tallybook.llm.divergence import TERM, Audit
from tallybook.llm.lines import Similar
from tallybook.llm.minhash import Signature
from tallybook.llm.quality import FEATURES, Rules
from tallybook.llm.secrets import ADDED, BASE, Rule
from tallybook.llm.substrings import WINDOW

WORD = r"[^\x20\x09-\x0D]+"
WORDS = f"""d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS words FROM d)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(rule: Rule, nr: int) -> str:
    pattern = _quoted(rule.pattern)
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {nr} AS nr, {rule.at_least} AS least,
      unnest(regexp_extract_all(t, {pattern}, 0)) AS m, unnest(regexp_extract_all(t, {pattern}, {rule.group})) AS g,
      unnest(string_split_regex(t, {pattern})[1:len(regexp_extract_all(t, {pattern}, 0))]) AS gap,
      unnest(range(len(regexp_extract_all(t, {pattern}, 0)))) AS i FROM d"""


def _secrets() -> str:
    rules = BASE + ADDED
    found = " UNION ALL ".join(_matches(r, k) for k, r in enumerate(rules))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nr)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({found}),
      placed AS (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e
        FROM m),
      spans AS (SELECT doc_id, kind, nr, e - length(m) AS s, e FROM placed WHERE length(g) >= least),
      rows AS (SELECT d.doc_id, kind, nr, s, e FROM d LEFT JOIN spans ON d.doc_id = spans.doc_id)
      SELECT doc_id, {counts}, sha256({joined} FILTER (WHERE nr < {len(BASE)}), '')) AS base_sha256,
        {joined}, '') AS spans FROM rows GROUP BY doc_id"""


def _lines() -> str:
    how = Similar()
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
      split AS (SELECT doc_id, CASE WHEN t = '' THEN [] ELSE string_split(t, chr(10)) END AS parts FROM d),
      lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS k FROM split),
      worded AS (SELECT doc_id, k, list_sort(list_distinct(regexp_extract_all(translate(line, '{upper}', '{lower}'), '{WORD}'))) AS s
        FROM lines),
      sets AS (SELECT s, len(s) AS n, min((doc_id, k)) AS place, row_number() OVER (ORDER BY min((doc_id, k))) AS id
        FROM worded WHERE len(s) > 0 GROUP BY s),
      listed AS (SELECT id, n, unnest(s) AS token FROM sets),
      counted AS (SELECT token, count(*) AS c FROM listed GROUP BY token),
      ranked AS (SELECT id, n, l.token, row_number() OVER (PARTITION BY id ORDER BY c, l.token) AS pos
        FROM listed l JOIN counted c ON l.token = c.token),
      posted AS (SELECT * FROM ranked WHERE pos <= n - ({how.percent} * n + 99) // 100 + 1),
      met AS (SELECT DISTINCT a.id AS later, b.id AS earlier FROM posted a JOIN posted b ON a.token = b.token AND a.id > b.id
        WHERE 100 * least(a.n, b.n) >= {how.percent} * greatest(a.n, b.n)),
      shared AS (SELECT later, x.n AS n, y.n AS m, len(list_intersect(x.s, y.s)) AS k
        FROM met JOIN sets x ON x.id = later JOIN sets y ON y.id = earlier),
      alike AS (SELECT DISTINCT later FROM shared WHERE 100 * k >= {how.percent} * (n + m - k)),
      gone AS (SELECT w.doc_id, w.k FROM worded w JOIN sets ON sets.s = w.s
        WHERE (w.doc_id, w.k) > sets.place OR sets.id IN (SELECT later FROM alike)),
      marked AS (SELECT l.*, g.k IS NOT NULL AS removed FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.k = g.k),
      sums AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT removed), '') AS kept FROM marked GROUP BY doc_id)
      SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN sums ON sums.doc_id = d.doc_id"""


def _substrings() -> str:
    return f"""WITH {WORDS},
      windows AS (SELECT doc_id, unnest(range(1, len(words) - {WINDOW - 2})) AS i, words FROM w WHERE len(words) >= {WINDOW}),
      named AS (SELECT doc_id, i, md5(array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS h FROM windows),
      firsts AS (SELECT h, min(doc_id) AS first FROM named GROUP BY h),
      gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM named JOIN firsts USING (h) WHERE doc_id > first),
      listed AS (SELECT doc_id, unnest(words) AS x, unnest(range(1, len(words) + 1)) AS p FROM w),
      marked AS (SELECT l.*, g.p IS NOT NULL AS removed FROM listed l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p),
      sums AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
        coalesce(string_agg(x, ' ' ORDER BY p) FILTER (WHERE NOT removed), '') AS kept FROM marked GROUP BY doc_id)
      SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN sums ON w.doc_id = sums.doc_id"""


def _quality() -> str:
    rules = Rules()

    def value(f) -> str:  # noqa: ANN001
        return f"{f.scale} * {f.numerator} // greatest({f.denominator}, 1)"

    features = " UNION ALL ".join(f"SELECT lang, source, '{f.name}' AS feature, {value(f)} AS v FROM good" for f in FEATURES)
    shift = "(length(bin(v)) - 6)"
    fences, tests = [], []
    for f in FEATURES:
        spread = f"{rules.reach} * greatest(high - low, {f.least}) * (in_lang + {rules.few}) // in_lang"
        low = f"low - {spread}" if f.both_sides else "0"
        fences.append(
            f"max(CASE WHEN feature = '{f.name}' THEN {low} END) AS {f.name}_from, "
            f"max(CASE WHEN feature = '{f.name}' THEN high + {spread} END) AS {f.name}_to"
        )
        tests.append(f"coalesce({value(f)} BETWEEN a.{f.name}_from AND a.{f.name}_to, TRUE)")
    return f"""WITH {WORDS},
      listed AS (SELECT doc_id, len(words) AS n, unnest(range(1, greatest(len(words) - 6, 1))) AS i, words FROM w),
      named AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS h FROM listed WHERE i <= n - 7),
      twice AS (SELECT doc_id, i FROM named WHERE TRUE QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
      covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
      lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
      repeated AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
        WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
      measured AS (SELECT w.doc_id, lang, source, len(words) AS n_words,
          CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
          len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
          coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
          len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_echoes
        FROM w JOIN (SELECT doc_id, lang, source FROM documents) USING (doc_id)
        LEFT JOIN repeated USING (doc_id) LEFT JOIN covered USING (doc_id)),
      judged AS (SELECT *, n_words < {rules.min_words}
        OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM measured),
      good AS (SELECT * FROM judged WHERE NOT base_failed),
      features AS ({features}),
      binned AS (SELECT lang, source, feature, CASE WHEN v < 64 THEN v ELSE {shift} * 32 + (v >> {shift}) END AS bin
        FROM features),
      sketch AS (SELECT lang, source, feature, bin, count(*) AS n FROM binned GROUP BY ALL),
      langs AS (SELECT lang, feature, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang, feature) AS in_lang
        FROM sketch GROUP BY lang, feature, bin),
      groups AS (SELECT DISTINCT lang, source, feature FROM sketch),
      lent AS (SELECT g.lang, g.source, g.feature, l.bin, in_lang, {rules.parent} * l.n + coalesce(s.n, 0) * in_lang AS n
        FROM groups g JOIN langs l ON l.lang IS NOT DISTINCT FROM g.lang AND l.feature = g.feature
        LEFT JOIN sketch s ON s.lang IS NOT DISTINCT FROM g.lang AND s.source IS NOT DISTINCT FROM g.source
          AND s.feature = g.feature AND s.bin = l.bin),
      ranked AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, feature ORDER BY bin) AS upto,
        sum(n) OVER (PARTITION BY lang, source, feature) AS total,
        CASE WHEN bin < 64 THEN bin ELSE (bin - (bin // 32 - 1) * 32) << (bin // 32 - 1) END AS least FROM lent),
      drawn AS (SELECT lang, source, feature, max(in_lang) AS in_lang, min(CASE WHEN 4 * upto >= total THEN least END) AS low,
        min(CASE WHEN 4 * upto >= 3 * total THEN least END) AS high FROM ranked GROUP BY lang, source, feature),
      fences AS (SELECT lang, source, {", ".join(fences)} FROM drawn GROUP BY lang, source)
      SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND {" AND ".join(tests)} AS kept
      FROM judged j
      LEFT JOIN fences a ON a.lang IS NOT DISTINCT FROM j.lang AND a.source IS NOT DISTINCT FROM j.source"""


def _chat() -> str:
    said = "'</s>[INST] ok [/INST]'"
    marks = len(TURN) + len(BODY) + len(END)

    def escaped(x: str) -> str:
        return rf"(2 * length({x}) - length(replace(replace(replace({x}, '\', ''), '<', ''), '[', '')))"

    order = "ORDER BY turn NULLS FIRST, role NULLS FIRST, x"
    return f"""WITH t AS (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', {said}), (-7, 1, 'assistant', {said})),
      e AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM t)
      SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(r || chr(10) || x || chr(10), '' {order})) AS turns_sha256,
        CAST(sum(CASE WHEN role = '{LOSS_ROLE}' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(x, '' {order}) FILTER (WHERE role = '{LOSS_ROLE}'), '')) AS loss_sha256,
        CAST(sum({marks} + {escaped('r')} + {escaped('x')}) AS BIGINT) AS formatted_chars
      FROM e GROUP BY conv_id"""


def _minhash() -> str:
    how = Signature()
    n = how.shingle_words
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
      w AS (SELECT doc_id, regexp_extract_all(t, '{WORD}') AS words FROM d),
      listed AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {n - 2}, 2))) AS i FROM w WHERE len(words) > 0),
      s AS (SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + {n - 1}], ' ')) AS h FROM listed),
      sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
      shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id
        GROUP BY ALL),
      links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * k >= {how.percent} * (x.n + y.n - k)),
      edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
      reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
      least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
      SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(least.b, w.doc_id)) AS component_id,
        w.doc_id <= coalesce(least.b, w.doc_id) AS kept
      FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id LEFT JOIN least ON least.a = w.doc_id"""


def _divergence() -> str:
    how = Audit()
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def share(n: str, total: str) -> str:
        return f"1 + ({how.scale} * (CAST({n} AS HUGEINT) + {how.prior})) // ({total} + {how.prior} * v)"

    return f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
      w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '{TERM}')) AS term FROM d),
      kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {how.min_docs}),
      langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
      g AS (SELECT DISTINCT lang, source FROM d),
      c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term
        GROUP BY ALL),
      sizes AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
      full_rows AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
          {share("coalesce(c.n, 0)", "coalesce(sizes.total, 0)")} AS p, {share("kept.n", "langs.total")} AS q
        FROM g JOIN kept ON g.lang = kept.lang JOIN langs ON langs.lang = g.lang
        LEFT JOIN sizes ON sizes.lang = g.lang AND sizes.source = g.source
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
      sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM full_rows a JOIN full_rows b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
      results AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL SELECT lang, source, 'term', term, p - q FROM full_rows WHERE n > 0 AND p > q),
      ranked AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM results)
      SELECT * FROM ranked WHERE part = 'pair' OR rank <= {how.top_terms}"""


SQL: dict[str, str] = {
    "op12_divergence": _divergence(),
    "op3_secrets": _secrets(),
    "op4_lines": _lines(),
    "op5_substrings": _substrings(),
    "op6_quality": _quality(),
    "op7_chat": _chat(),
    "op8_minhash": _minhash(),
}
