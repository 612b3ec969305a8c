"""The same results in SQL over the given tables, for an engine other than Spark."""

from __future__ import annotations

from tallybook.plans.registry import ASKED, NEVER, ROWS_PER_REQUEST, ROWS_PER_TRIGGER, SMALL_BATCH, SMALL_BODY, WIDE
from tallybook.plans.views import COPY_STEP, FIRST_COMMIT, HALF, ORPHAN_STEP, REQUEST_ROWS, SEEDED
from tallybook.sources.log_writer import MULTIPLIER, SEED
from tallybook.schemas import EARLIEST, NO_OFFSET, PARTITIONS, REQUEST_BOUNDS, STAGE_BOUNDS, TOPIC


def _dashed(h: str) -> str:
    return (
        f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)"
        f"||'-'||substr({h},17,4)||'-'||substr({h},21,12))"
    )


def _uuid(kind: str, key: str) -> str:
    return _dashed(f"md5('{kind}'||CAST({key} AS VARCHAR))")


ACCOUNTS = f"""accounts AS (SELECT c_custkey AS id, CAST(round(c_acctbal*100) AS BIGINT) AS balance,
  TIMESTAMP '{SEEDED}' AS created_at FROM customer)"""
TRANSACTIONS = """transactions AS (SELECT o_orderkey AS id, o_custkey AS account_id,
  CAST(round(o_totalprice*100) AS BIGINT) AS amount, o_orderdate AS created_at FROM orders)"""
POSTINGS = f"""postings AS (SELECT event_id AS id,
  user_id + CASE WHEN event_id % 37 = 0 THEN {ORPHAN_STEP} ELSE 0 END AS account_id,
  CAST(round(value*100) AS BIGINT) AS amount, ts AS created_at FROM events)"""
DELIVERIES = f"""{POSTINGS},
copies AS (SELECT *, 0 AS copy FROM postings
  UNION ALL SELECT *, 1 FROM postings WHERE id % 10 = 0
  UNION ALL SELECT *, 2 FROM postings WHERE id % 50 = 0),
deliveries AS (SELECT id, account_id, amount + CASE WHEN copy = 2 THEN 1 ELSE 0 END AS amount, created_at,
  CAST(account_id % {PARTITIONS} AS INTEGER) AS partition_id,
  CAST(copy AS BIGINT) * {COPY_STEP} + id AS log_offset,
  CASE WHEN copy > 0 THEN copy + 1 WHEN created_at >= TIMESTAMP '{HALF}' THEN 1 ELSE 0 END AS batch_id
  FROM copies)"""
FIRSTS = """firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY partition_id, log_offset)
  AS rn FROM deliveries) WHERE rn = 1)"""
# What appending batch after batch keeps.
APPENDED = """appended AS (SELECT * REPLACE (CAST(batch_id AS BIGINT) AS batch_id) FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY batch_id, partition_id, log_offset) AS rn FROM deliveries) WHERE rn = 1)"""
# What a stream keeps: damaged originals go to quarantine, so a later copy may be the first good one.
GOOD = f"""good AS (SELECT * FROM deliveries WHERE NOT (id % 101 = 7 AND log_offset < {COPY_STEP})),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch_id, partition_id, log_offset)
  AS rn FROM good) WHERE rn = 1)"""
COMMITS = f"""commits AS (SELECT partition_id, batch_id, max(log_offset) AS last_offset, count(*) AS rows_delivered,
  TIMESTAMP '{FIRST_COMMIT}' + CAST(batch_id AS INTEGER) * INTERVAL 1 DAY AS committed_at
  FROM deliveries GROUP BY partition_id, batch_id)"""
ALL_PARTITIONS = f"parts AS (SELECT CAST(p AS INTEGER) AS partition_id FROM range({WIDE}) t(p))"
DELIVERIES_WIDE = DELIVERIES.replace(f"account_id % {PARTITIONS} ", f"account_id % {WIDE} ")
COMMITS_WIDE = COMMITS.replace("FROM deliveries", f"FROM deliveries WHERE partition_id <> {NEVER}")
SOME = """remaining AS (SELECT partition_id, max(log_offset) AS last_offset FROM deliveries
  WHERE partition_id % 7 <> 3 GROUP BY partition_id)"""
ITEMS = f"""{POSTINGS},
items AS (SELECT *, id // {REQUEST_ROWS} AS batch_id, copy * {REQUEST_ROWS} + id % {REQUEST_ROWS} AS seat FROM (
  SELECT *, 0 AS copy FROM postings
  UNION ALL SELECT *, 1 FROM postings WHERE id % 10 = 0 AND (id // {REQUEST_ROWS}) % 4 = 0)),
placed AS (SELECT batch_id, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY seat) - 1 AS INTEGER) AS pos,
  seat, id AS n, {_uuid('t', 'id')} AS id, {_uuid('a', 'account_id')} AS account_id, amount FROM items)"""
# The request bodies themselves, for their length.
BODIES = """texts AS (SELECT batch_id, count(*) AS n_items, string_agg('{"id":"'
  || CASE WHEN seat = 0 AND batch_id % 12 = 5 THEN 'not-a-uuid'
          WHEN seat = 0 AND batch_id % 12 = 9 THEN 'URN:UUID:' || upper(id) ELSE id END || '",'
  || CASE WHEN seat = 0 AND batch_id % 12 = 4 THEN '' ELSE '"account_id":"' || account_id || '",' END || '"amount":'
  || CASE WHEN seat = 0 AND batch_id % 12 = 1 THEN amount || '.5'
          WHEN seat = 0 AND batch_id % 12 = 2 THEN '"' || amount || '"'
          WHEN seat = 0 AND batch_id % 12 = 3 THEN '12345678901234567890' ELSE CAST(amount AS VARCHAR) END
  || CASE WHEN seat = 0 AND batch_id % 12 = 6 THEN ',"note":"' || repeat('x', 8000) || '"' ELSE '' END || '}', ','
  ORDER BY seat) AS t FROM placed GROUP BY batch_id),
bodies AS (SELECT batch_id, n_items, CASE batch_id % 12 WHEN 7 THEN '[' || t WHEN 8 THEN '{"items":[' || t || ']}'
  WHEN 10 THEN '[]' WHEN 11 THEN '[' || t || '] x' ELSE '[' || t || ']' END AS body FROM texts)"""
JUDGED = f"""{ITEMS}, {BODIES},
judged AS (SELECT batch_id, CAST(strlen(body) AS INTEGER) AS body_bytes, n_items,
  CASE WHEN strlen(body) > {SMALL_BODY} THEN 'body_too_large'
       WHEN batch_id % 12 IN (1,2,3,4,5,7,8,11) THEN 'invalid_body'
       WHEN batch_id % 12 <> 10 AND n_items > {SMALL_BATCH} THEN 'too_many_rows' END AS reason FROM bodies)"""
_SPREAD = "CAST(pow(10.0, {k} % 13) AS BIGINT)"


def _signed(key: str, amount: str) -> str:
    spread = _SPREAD.format(k=key)
    return (
        f"CASE WHEN {key} % 17 = 0 THEN 0 ELSE {amount} * {spread} * "
        f"CASE WHEN {key} % 3 = 0 THEN -1 ELSE 1 END END"
    )


def _typed(number: str, text: str) -> str:
    return (
        f"CASE WHEN {number} % 23 = 0 THEN substr({text},1,35) WHEN {number} % 5 = 1 THEN upper({text}) "
        f"WHEN {number} % 5 = 2 THEN 'urn:uuid:'||{text} WHEN {number} % 5 = 3 THEN '{{'||{text}||'}}' "
        f"WHEN {number} % 5 = 4 THEN replace({text},'-','') ELSE {text} END"
    )


def _varint_hex(v: str) -> str:
    """Hex of the varint of a non-negative number below 2**35."""
    whens, parts = [], []
    for n in range(1, 6):
        bytes_ = [
            f"printf('%02x', (({v} >> {7 * i}) & 127)" + (" | 128)" if i < n - 1 else ")") for i in range(n)
        ]
        parts.append("||".join(bytes_))
        whens.append(f"WHEN {v} < {1 << (7 * n)} THEN {parts[-1]}")
    return "CASE " + " ".join(whens) + " END"


def _shard(text: str, n: int) -> str:
    return f"CAST(CAST('0x'||substr(replace({text},'-',''),17,16) AS UBIGINT) % {n} AS INTEGER)"


_POSTING = "id, account_id, amount, created_at"
_PLACED = f"{_POSTING}, partition_id, log_offset"
_UUID_PLACED = (
    f"{_uuid('t', 'id')} AS id, {_uuid('a', 'account_id')} AS account_id, amount, created_at, partition_id, log_offset"
)
_UUID_ACCOUNTS = f"(SELECT {_uuid('a', 'id')} AS id, balance, created_at FROM accounts)"

_STAGES = ", ".join(f"('{b:g}', {round(b * 1_000_000)})" for b in STAGE_BOUNDS)
_BOUNDS = ", ".join(f"('{b:g}', {round(b * 1_000_000)})" for b in REQUEST_BOUNDS)



def _murmur2(table: str) -> str:
    """CTEs from `table` (h: hex of 16 bytes) to `hashed` (hash): one step per column."""
    low, times, steps = 4294967295, MULTIPLIER, []
    words = ", ".join(
        f"CAST('0x'||substr(h,{8 * i + 7},2)||substr(h,{8 * i + 5},2)||substr(h,{8 * i + 3},2)||substr(h,{8 * i + 1},2) AS BIGINT) AS w{i}"
        for i in range(4)
    )
    steps.append(f"words AS (SELECT *, {words} FROM {table})")
    steps.append("once AS (SELECT *, " + ", ".join(f"(w{i} * {times}) & {low} AS a{i}" for i in range(4)) + " FROM words)")
    steps.append("twice AS (SELECT *, " + ", ".join(f"(xor(a{i}, a{i} >> 24) * {times}) & {low} AS b{i}" for i in range(4)) + " FROM once)")
    steps.append(f"m0 AS (SELECT *, xor(({SEED ^ 16}::BIGINT * {times}) & {low}, b0) AS s0 FROM twice)")
    for i in (1, 2, 3):
        steps.append(f"m{i} AS (SELECT *, xor((s{i - 1} * {times}) & {low}, b{i}) AS s{i} FROM m{i - 1})")
    steps.append(f"last_but AS (SELECT *, (xor(s3, s3 >> 13) * {times}) & {low} AS s4 FROM m3)")
    steps.append("hashed AS (SELECT *, xor(s4, s4 >> 15) AS hash FROM last_but)")
    return ", ".join(steps)


SQL: dict[str, str] = {
    "keyed_log": f"""WITH {DELIVERIES}, keyed AS (SELECT *, md5('a'||CAST(account_id AS VARCHAR)) AS h,
          md5('t'||CAST(id AS VARCHAR)) AS t, amount AS cents, batch_id >= 2 AS later FROM deliveries), {_murmur2('keyed')},
        routed AS (SELECT *, CAST((hash & 2147483647) % {PARTITIONS} AS INTEGER) AS part FROM hashed)
        SELECT h AS key_hex, '0a10'||t||'1210'||h||CASE WHEN cents = 0 THEN '' ELSE '18'||{_varint_hex('cents')} END AS value_hex,
          part AS partition, row_number() OVER (PARTITION BY part ORDER BY later, log_offset) - 1 AS offset,
          created_at AS timestamp FROM routed""",
    "log_by_offset": f"""WITH {DELIVERIES}, keyed AS (SELECT *, md5('a'||CAST(account_id AS VARCHAR)) AS h FROM deliveries),
        {_murmur2('keyed')},
        routed AS (SELECT *, CAST((hash & 2147483647) % {PARTITIONS} AS INTEGER) AS part FROM hashed),
        placed AS (SELECT h, part, batch_id, row_number() OVER (PARTITION BY part ORDER BY least(batch_id, 1), log_offset) - 1 AS place,
          count(*) FILTER (WHERE batch_id = 0) OVER (PARTITION BY part) AS held FROM routed)
        SELECT h AS key_hex, part AS partition, place AS offset, (place - held) // {ROWS_PER_TRIGGER} AS batch
        FROM placed WHERE part <= 31 AND batch_id > 0""",
    "running_balances": f"""WITH {ACCOUNTS}, {TRANSACTIONS},
        net AS (SELECT account_id, sum(amount) AS net_change, count(*) AS n FROM transactions GROUP BY account_id)
        SELECT id, CAST(balance + coalesce(net_change, 0) AS BIGINT) AS balance, coalesce(n, 0) AS postings
        FROM accounts LEFT JOIN net ON id = account_id""",
    "remembered_ids": f"""WITH {DELIVERIES}, {GOOD} SELECT partition_id, count(*) AS passed, count(DISTINCT id) AS remembered,
        CAST(sum(amount) AS BIGINT) AS amount FROM kept GROUP BY partition_id""",
    "net_change": f"""WITH {TRANSACTIONS}
        SELECT account_id, CAST(sum(amount) AS BIGINT) AS net_change FROM transactions GROUP BY account_id""",
    "balance_fold": f"""WITH {ACCOUNTS}, {TRANSACTIONS},
        net AS (SELECT account_id, sum(amount) AS net_change FROM transactions GROUP BY account_id)
        SELECT id, CAST(balance + coalesce(net_change, 0) AS BIGINT) AS balance
        FROM accounts LEFT JOIN net ON id = account_id""",
    "dedupe_first": f"WITH {DELIVERIES}, {FIRSTS} SELECT {_PLACED} FROM firsts",
    "ledger_merge": f"""WITH {DELIVERIES}, {FIRSTS} SELECT {_PLACED} FROM firsts f
        WHERE NOT EXISTS (SELECT 1 FROM deliveries d WHERE d.batch_id = 0 AND d.id = f.id)""",
    "ledger_append": f"WITH {DELIVERIES}, {APPENDED} SELECT {_PLACED} FROM appended",
    "clear_table": f"""WITH {DELIVERIES}, {APPENDED}
        SELECT 'ledger before' AS "table", batch_id, count(*) AS n FROM appended GROUP BY batch_id
        UNION ALL SELECT 'ledger', NULL::BIGINT, 0 UNION ALL SELECT 'accounts', NULL::BIGINT, count(*) FROM customer""",
    "external_tables": f"""WITH {DELIVERIES}, {APPENDED}
        SELECT id, account_id, amount, 0::BIGINT AS run_id, batch_id FROM appended""",
    "receipt_time": f"""WITH {DELIVERIES}, {APPENDED},
        timed AS (SELECT *, TIMESTAMP '{FIRST_COMMIT}' + CAST(batch_id AS INTEGER) * INTERVAL 1 DAY AS committed_at FROM appended)
        SELECT id, batch_id, committed_at, epoch_us(committed_at) - epoch_us(created_at) AS waited_us FROM timed""",
    "history_archive": f"""WITH {DELIVERIES}, {FIRSTS} SELECT {_POSTING} FROM firsts f
        WHERE NOT EXISTS (SELECT 1 FROM deliveries d WHERE d.batch_id = 0 AND d.id = f.id)""",
    "orphan_transactions": f"""WITH {ACCOUNTS}, {DELIVERIES}, {FIRSTS}
        SELECT account_id, CAST(sum(amount) AS BIGINT) AS net_change, count(*) AS postings FROM firsts f
        WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.id = f.account_id) GROUP BY account_id""",
    "batch_offsets": f"""WITH {DELIVERIES} SELECT partition_id, max(log_offset) AS last_offset,
        count(*) AS rows_delivered FROM deliveries GROUP BY partition_id""",
    "committed_offsets": f"""WITH {DELIVERIES_WIDE}, {COMMITS_WIDE}, {ALL_PARTITIONS},
        latest AS (SELECT partition_id, max(last_offset) AS last_offset, arg_max(committed_at, last_offset)
          AS updated_at FROM commits GROUP BY partition_id)
        SELECT partition_id, coalesce(last_offset, {NO_OFFSET}) AS last_offset, updated_at
        FROM parts LEFT JOIN latest USING (partition_id)""",
    "start_offsets": f"""WITH {DELIVERIES_WIDE}, {SOME}, {ALL_PARTITIONS}
        SELECT partition_id, coalesce(last_offset + 1, {EARLIEST}) AS start_offset
        FROM parts LEFT JOIN remaining USING (partition_id)""",
    "init_offsets": f"""WITH {DELIVERIES_WIDE}, {SOME}, {ALL_PARTITIONS}
        SELECT partition_id, coalesce(last_offset, {NO_OFFSET}) AS last_offset
        FROM parts LEFT JOIN remaining USING (partition_id)""",
    "partition_range": f"WITH {DELIVERIES} SELECT {_PLACED} FROM deliveries WHERE partition_id BETWEEN 0 AND 31",
    "partitions_with_work": f"""WITH {DELIVERIES} SELECT partition_id, count(*) AS pending FROM deliveries
        WHERE batch_id > 1 GROUP BY partition_id""",
    "json_decode": f"""WITH {ITEMS} SELECT batch_id, pos, id, account_id, amount FROM placed
        WHERE batch_id % 12 IN (0, 6, 9)""",
    "batch_explode": f"""WITH {ITEMS} SELECT batch_id, pos,
        CASE WHEN seat = 0 AND batch_id % 12 = 5 THEN NULL ELSE id END AS id,
        CASE WHEN seat = 0 AND batch_id % 12 = 4 THEN NULL ELSE account_id END AS account_id,
        CASE WHEN seat = 0 AND batch_id % 12 IN (1, 2, 3) THEN NULL ELSE amount END AS amount
        FROM placed WHERE batch_id % 12 NOT IN (7, 8, 10, 11)""",
    "batch_admission": f"WITH {JUDGED} SELECT batch_id, reason, body_bytes FROM judged WHERE reason IS NOT NULL",
    "created_counts": f"""WITH {JUDGED} SELECT batch_id,
        CAST(CASE WHEN reason IS NULL THEN 201 ELSE 400 END AS INTEGER) AS status,
        CASE WHEN reason IS NULL THEN CASE WHEN batch_id % 12 = 10 THEN 0 ELSE n_items END END AS created_count,
        CASE reason WHEN 'body_too_large' THEN 'Request body too large' WHEN 'invalid_body' THEN
        'Invalid request body' WHEN 'too_many_rows' THEN 'Request batch size too large' END AS message
        FROM judged""",
    "proto_decode": f"""WITH {ITEMS} SELECT batch_id, pos, id, account_id, {_signed('n', 'amount')} AS amount
        FROM placed WHERE batch_id % 5 IN (0, 3)""",
    "proto_admission": f"""WITH {ITEMS}, sizes AS (SELECT batch_id, count(*) AS n_items FROM placed GROUP BY batch_id),
        judged AS (SELECT *, CASE WHEN batch_id % 5 IN (1, 2) THEN 'Invalid request body'
          WHEN batch_id % 5 <> 4 AND n_items > {SMALL_BATCH} THEN 'Request batch size too large' END AS message
          FROM sizes)
        SELECT batch_id, CAST(CASE WHEN message IS NULL THEN 201 ELSE 400 END AS INTEGER) AS status,
        CASE WHEN message IS NULL THEN CASE WHEN batch_id % 5 = 4 THEN 0 ELSE n_items END END AS created_count,
        message FROM judged""",
    "proto_roundtrip": f"""WITH {POSTINGS}, s AS (SELECT id AS n, {_uuid('t', 'id')} AS id,
        {_uuid('a', 'account_id')} AS account_id, {_signed('id', 'amount')} AS amount FROM postings)
        SELECT CAST(CASE WHEN amount = 0 THEN 36 WHEN amount < 0 THEN 47
          ELSE 37 + greatest(1, CAST(ceil((length(ltrim(bin(amount), '0'))) / 7.0) AS INTEGER)) END AS INTEGER) AS bytes,
        TRUE AS decoded, id, account_id, amount FROM s""",
    "to_log_record": f"""WITH {POSTINGS} SELECT md5('a'||CAST(account_id AS VARCHAR)) AS key_hex,
        '0a10'||md5('t'||CAST(id AS VARCHAR))||'1210'||md5('a'||CAST(account_id AS VARCHAR))
        || CASE WHEN amount = 0 THEN '' ELSE '18'||{_varint_hex('amount')} END AS value_hex,
        created_at AS timestamp, '{TOPIC}' AS topic FROM postings""",
    "quarantine": f"""WITH {DELIVERIES} SELECT md5('a'||CAST(account_id AS VARCHAR)) AS key_hex,
        partition_id AS partition, log_offset AS offset FROM deliveries
        WHERE id % 101 = 7 AND log_offset < {COPY_STEP}""",
    "account_lookup": f"""WITH {ACCOUNTS}, {POSTINGS}, known AS {_UUID_ACCOUNTS},
        asked AS (SELECT id AS request_id, CASE WHEN id % 23 = 0 THEN NULL ELSE {_uuid('a', 'account_id')} END AS id
          FROM postings)
        SELECT request_id, CAST(CASE WHEN a.id IS NULL THEN 400 WHEN k.id IS NULL THEN 404 ELSE 200 END AS INTEGER)
        AS status, a.id, balance, created_at FROM asked a LEFT JOIN known k ON a.id = k.id""",
    "transaction_lookup": f"""WITH {TRANSACTIONS}, {DELIVERIES},
        known AS (SELECT {_uuid('t', 'id')} AS id, {_uuid('a', 'account_id')} AS account_id, amount, created_at
          FROM transactions),
        asked AS (SELECT log_offset AS request_id, CASE WHEN id % 23 = 0 THEN NULL ELSE
          {_uuid('t', f'(id + CASE WHEN account_id >= {ORPHAN_STEP} THEN {ORPHAN_STEP} ELSE 0 END)')} END AS id
          FROM deliveries)
        SELECT request_id, CAST(CASE WHEN a.id IS NULL THEN 400 WHEN k.id IS NULL THEN 404 ELSE 200 END AS INTEGER)
        AS status, a.id, account_id, amount, created_at FROM asked a LEFT JOIN known k ON a.id = k.id""",
    "account_by_id": f"WITH {ACCOUNTS} SELECT id, balance, created_at FROM accounts WHERE id = {ASKED}",
    "transaction_by_id": f"WITH {TRANSACTIONS} SELECT {_POSTING} FROM transactions WHERE id = {ASKED}",
    "account_txn_count": f"""WITH {ACCOUNTS}, {TRANSACTIONS} SELECT a.id AS account_id, count(t.id) AS n
        FROM accounts a LEFT JOIN transactions t ON t.account_id = a.id GROUP BY a.id""",
    "uuid_validate": f"""WITH {POSTINGS}, u AS (SELECT id, {_uuid('a', 'account_id')} AS t FROM postings)
        SELECT id, {_typed('id', 't')} AS given, id % 23 <> 0 AS valid,
        CASE WHEN id % 23 <> 0 THEN t END AS canonical FROM u""",
    "uuid_roundtrip": f"""WITH {POSTINGS} SELECT id AS key, CAST(16 AS INTEGER) AS bytes, {_uuid('t', 'id')} AS id
        FROM postings""",
    "shard_of": f"""WITH {ACCOUNTS}, u AS {_UUID_ACCOUNTS}
        SELECT id, {_shard('id', 2)} AS of_2, {_shard('id', 3)} AS of_3, {_shard('id', 64)} AS of_64 FROM u""",
    "pg_epoch": f"""WITH {POSTINGS} SELECT id, epoch_us(created_at) - epoch_us(TIMESTAMP '2000-01-01') AS wire_us,
        created_at FROM postings""",
    "functions_in_sql": f"""WITH {POSTINGS}, u AS (SELECT id, CASE WHEN id % 23 <> 0 THEN {_uuid('a', 'account_id')} END AS t, created_at
        FROM postings) SELECT id, t AS canonical, t AS again, {_shard('t', 64)} AS shard,
        epoch_us(created_at) - epoch_us(TIMESTAMP '2000-01-01') AS wire_us, created_at FROM u""",
    "lookups_in_sql": f"""WITH {ACCOUNTS}, {TRANSACTIONS} SELECT {_uuid('t', 't.id')} AS id, {_uuid('a', 't.account_id')} AS account_id,
        t.amount, a.balance FROM transactions t JOIN accounts a ON a.id = t.account_id""",
    "seed_accounts": f"""WITH {ACCOUNTS}, u AS {_UUID_ACCOUNTS}
        SELECT id, CAST(1000 AS BIGINT) AS balance, created_at, {_shard('id', 2)} AS shard FROM u""",
    "account_ids_csv": f"WITH {ACCOUNTS}, u AS {_UUID_ACCOUNTS} SELECT id AS account_id FROM u",
    "union_partitions": f"""WITH {DELIVERIES_WIDE} SELECT {_uuid('t', 'id')} AS id, {_uuid('a', 'account_id')} AS account_id,
        amount, created_at, partition_id FROM deliveries""",
    "union_shards": f"""WITH {ACCOUNTS}, u AS {_UUID_ACCOUNTS}
        SELECT id, balance, created_at, {_shard('id', 2)} AS shard FROM u""",
    "request_counts": """SELECT event_type AS path, 'POST' AS method,
        CAST(CASE event_type WHEN 'error' THEN 500 ELSE 201 END AS INTEGER) AS status, count(*) AS requests
        FROM events GROUP BY event_type""",
    "rows_staged": f"""WITH {DELIVERIES}, {COMMITS}
        SELECT CAST(sum(rows_delivered) AS BIGINT) AS rows_staged FROM commits""",
    "latency_histogram": f"""WITH b(le, bound) AS (VALUES {_BOUNDS}, ('+Inf', 9223372036854775807)),
        r AS (SELECT event_type AS path, CAST(CASE event_type WHEN 'error' THEN 500 ELSE 201 END AS INTEGER) AS status,
          CAST(round(value*1000) AS BIGINT) AS us FROM events),
        t AS (SELECT path, status, count(*) AS total, CAST(sum(us) AS BIGINT) AS total_value FROM r GROUP BY ALL)
        SELECT t.path, 'POST' AS method, t.status, b.le,
          (SELECT count(*) FROM r WHERE r.path = t.path AND r.us <= b.bound) AS bucket_count, total, total_value
        FROM t, b""",
    "messages_produced": f"""WITH {JUDGED} SELECT CAST(sum(CASE WHEN batch_id % 12 = 10 THEN 0 ELSE n_items END) AS BIGINT)
        AS messages_produced FROM judged WHERE reason IS NULL""",
    "stage_histogram": f"""WITH b(le, bound) AS (VALUES {_STAGES}, ('+Inf', 9223372036854775807)),
        e AS (SELECT event_type AS path, CAST(round(value*1000) AS BIGINT) AS us FROM events),
        r AS (SELECT path, path AS label, us FROM e UNION ALL SELECT path, NULL, us FROM e),
        t AS (SELECT label, count(*) AS total, CAST(sum(us) AS BIGINT) AS total_value FROM r GROUP BY label)
        SELECT t.label AS path, b.le, (SELECT count(*) FROM r WHERE r.label IS NOT DISTINCT FROM t.label
          AND r.us <= b.bound) AS bucket_count, total, total_value FROM t, b""",
    "latest_gauge": """SELECT event_type AS path, CAST(round(arg_max(value, event_id)*1000) AS BIGINT) AS latency_us
        FROM events GROUP BY event_type""",
    "consumer_lag": f"""WITH {DELIVERIES_WIDE}, {COMMITS_WIDE},
        d AS (SELECT partition_id, max(log_offset) AS dispatched FROM deliveries GROUP BY partition_id),
        c AS (SELECT partition_id, max(last_offset) AS committed FROM commits WHERE batch_id < 2 GROUP BY partition_id)
        SELECT partition_id, dispatched, coalesce(committed, {NO_OFFSET}) AS committed,
          dispatched - coalesce(committed, {NO_OFFSET}) AS lag FROM d LEFT JOIN c USING (partition_id)""",
    "load_report": f"""WITH r AS (SELECT epoch_us(ts) AS t, CAST(round(value*1000) AS BIGINT) AS us,
          event_type <> 'error' AS ok FROM events),
        a AS (SELECT count(*) AS n, count(*) FILTER (WHERE ok) AS good, (max(t + us) - min(t)) / 1e6 AS seconds,
          sum(us) / count(*) / 1e6 AS mean, max(us) / 1e6 AS top,
          quantile_cont(us / 1e6, 0.95) AS p95, quantile_cont(us / 1e6, 0.99) AS p99 FROM r)
        SELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM (
          SELECT 'requests' AS metric, CAST(n AS DOUBLE) AS value FROM a
          UNION ALL SELECT 'rows_per_second', good * {ROWS_PER_REQUEST} / seconds FROM a
          UNION ALL SELECT 'success_percent', good * 100 / n FROM a
          UNION ALL SELECT 'latency_mean_s', mean FROM a UNION ALL SELECT 'latency_max_s', top FROM a
          UNION ALL SELECT 'latency_p95_s', p95 FROM a UNION ALL SELECT 'latency_p99_s', p99 FROM a)""",
    "stored_percentiles": f"""SELECT event_type AS path, CAST(fraction AS DOUBLE) AS fraction, count(*) AS n, true AS within
        FROM events, (VALUES (0.5), (0.95), (0.99)) f(fraction) WHERE ts >= TIMESTAMP '{HALF}' GROUP BY ALL""",
    "batch_counters": f"""WITH {DELIVERIES},
        judged AS (SELECT id, CAST(batch_id AS BIGINT) AS batch_id, id % 101 = 7 AND log_offset < {COPY_STEP} AS bad FROM deliveries),
        firsts AS (SELECT min(batch_id) AS batch_id FROM judged WHERE NOT bad GROUP BY id),
        came AS (SELECT batch_id, count(*) AS added FROM firsts GROUP BY batch_id),
        counted AS (SELECT batch_id, count(*) AS delivered, count(*) FILTER (WHERE bad) AS rejected FROM judged GROUP BY batch_id)
        SELECT batch_id, delivered, rejected, coalesce(added, 0) AS added, delivered - rejected - coalesce(added, 0) AS repeated
        FROM counted LEFT JOIN came USING (batch_id)""",
    "log_source": f"""WITH {DELIVERIES}, {GOOD}, {COMMITS},
        c AS (SELECT partition_id, max(last_offset) AS done FROM commits WHERE batch_id < 2 GROUP BY partition_id)
        SELECT {_UUID_PLACED} FROM good LEFT JOIN c USING (partition_id)
        WHERE partition_id BETWEEN 0 AND 31 AND log_offset > coalesce(done, -1)""",
    "stream_ingest": f"WITH {DELIVERIES}, {GOOD} SELECT {_UUID_PLACED} FROM kept",
    "stream_fold": f"""WITH {ACCOUNTS}, {DELIVERIES}, {GOOD},
        net AS (SELECT account_id, sum(amount) AS net_change FROM kept GROUP BY account_id)
        SELECT {_uuid('a', 'id')} AS id, CAST(balance + coalesce(net_change, 0) AS BIGINT) AS balance
        FROM accounts LEFT JOIN net ON id = account_id""",
    "stepwise_fold": f"""WITH {ACCOUNTS}, {DELIVERIES}, {FIRSTS},
        net AS (SELECT account_id, sum(amount) AS net_change FROM firsts GROUP BY account_id)
        SELECT id, CAST(balance + coalesce(net_change, 0) AS BIGINT) AS balance
        FROM accounts LEFT JOIN net ON id = account_id""",
    "open_accounts": f"""WITH {ACCOUNTS}, {DELIVERIES}, {FIRSTS},
        all_net AS (SELECT account_id, sum(amount) AS net_change FROM firsts GROUP BY account_id),
        late_net AS (SELECT account_id, sum(amount) AS net_change FROM firsts WHERE batch_id > 0 GROUP BY account_id)
        SELECT id, CAST(balance + coalesce(CASE WHEN id % 3 <> 0 THEN a.net_change ELSE l.net_change END, 0) AS BIGINT)
          AS balance
        FROM accounts LEFT JOIN all_net a ON id = a.account_id LEFT JOIN late_net l ON id = l.account_id
        WHERE id % 3 <> 0 OR id % 2 = 0""",
    "dedupe_bounded": f"""WITH {DELIVERIES}, {GOOD}
        SELECT {_uuid('t', 'id')} AS id, {_uuid('a', 'account_id')} AS account_id, partition_id FROM kept""",
}
