"""DuckDB SQL stating, for each registered query, the result it must give.

The CTEs below restate the test-table mapping of ``sources/testdata.py``
in SQL; each query then states its operator in plain SQL over them.
Column names are the same as the Spark results.
"""

from __future__ import annotations

from ..schemas import TRANSACTION_PAYLOAD

PAYLOAD = [f.name for f in TRANSACTION_PAYLOAD.fields]

# Event-time boundary of a run over the whole table: Spark keeps the
# maximum event time in milliseconds and the watermark is that minus the
# 5-minute delay.  A window is emitted once its end is at or before it.
WATERMARK = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 MINUTE FROM events)"

TUMBLING = """
SELECT date_trunc('minute', ts) AS window_start,
       date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
       count(*)::BIGINT AS transactions_count
FROM events
GROUP BY 1, 2
"""

SLIDING = """
SELECT date_trunc('minute', ts) - to_minutes(i) AS window_start,
       date_trunc('minute', ts) - to_minutes(i) + INTERVAL 5 MINUTE AS window_end,
       count(*)::BIGINT AS transactions_count
FROM (SELECT ts, unnest(range(5)) AS i FROM events)
GROUP BY 1, 2
"""


def _tx_columns(customer_id: str = "CAST(user_id AS VARCHAR)", amount: str = "value") -> str:
    return f"""
        'T' || event_id AS transaction_id,
        {customer_id} AS customer_id,
        '4' || lpad(CAST(user_id AS VARCHAR), 15, '0') AS card_number,
        'M' || k AS merchant_id,
        'Merchant ' || k AS merchant_name,
        CASE k % 4 WHEN 0 THEN 'grocery' WHEN 1 THEN 'electronics' WHEN 2 THEN 'travel'
                   ELSE 'dining' END AS merchant_category,
        {amount} AS amount,
        'USD' AS currency,
        event_type AS transaction_type,
        CASE WHEN k % 2 = 0 THEN 'online' ELSE 'pos' END AS payment_channel,
        'DEV' || user_id AS device_id,
        'City ' || (user_id % 12) AS city,
        CASE WHEN k >= 90 THEN 'GB' ELSE 'US' END AS country,
        ts AS transaction_timestamp,
        k >= 90 AS is_international,
        CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS status,
        event_id, ts"""


EVENTS_K = "(SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

TX = f"tx AS (SELECT {_tx_columns()} FROM {EVENTS_K})"
DIRTY_TX = f"""dtx AS (SELECT {_tx_columns(
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END",
    "CASE WHEN event_id % 11 = 0 THEN -value ELSE value END")} FROM {EVENTS_K})"""

BRONZE_CUSTOMERS_COLUMNS = """
        CAST(c_custkey AS VARCHAR) AS customer_id,
        split_part(c_name, '#', 1) AS first_name,
        split_part(c_name, '#', 2) AS last_name,
        CASE c_custkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE 'Other' END AS gender,
        CAST(18 + c_custkey % 58 AS INTEGER) AS age,
        'City ' || (c_custkey % 12) AS city,
        'State ' || n_regionkey AS state,
        n_name AS country,
        CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS DECIMAL(18,2)) AS annual_income,
        c_mktsegment AS customer_segment,
        CASE WHEN c_custkey % 101 = 100 THEN '2020-02-30'
             ELSE strftime(DATE '2015-01-01' + CAST(c_custkey % 3650 AS INTEGER), '%Y-%m-%d')
        END AS account_open_date,
        CAST(c_custkey % 100 AS INTEGER) AS risk_score,
        CAST((c_custkey % 50) * 100 AS DECIMAL(18,2)) AS preferred_spending_min,
        CAST((c_custkey % 50) * 100 + 5000 AS DECIMAL(18,2)) AS preferred_spending_max,
        'City ' || (c_custkey % 12) AS preferred_city,
        n_name AS preferred_country,
        'DEV' || c_custkey AS trusted_device_id,
        '4' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS card_number,
        CASE c_custkey % 4 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' WHEN 2 THEN 'Amex'
                           ELSE 'RuPay' END AS card_type,
        lower(replace(c_name, '#', '.') || '@example.com') AS email,
        CAST(c_acctbal AS DECIMAL(18,2)) AS transaction_limit,
        TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS update_timestamp"""

BRONZE_CUST = f"""bcust AS (SELECT {BRONZE_CUSTOMERS_COLUMNS}
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
CUST = f"""{BRONZE_CUST},
cust AS (SELECT * REPLACE (CAST(try_strptime(account_open_date, '%Y-%m-%d') AS DATE)
                           AS account_open_date)
         FROM bcust WHERE customer_id IS NOT NULL)"""


def _watchlist(raw: bool) -> str:
    risk = "CASE WHEN value > 400 THEN 'high' WHEN value > 250 THEN 'medium' ELSE 'low' END"
    action = "CASE WHEN value > 400 THEN 'block' WHEN value > 250 THEN 'review' ELSE 'monitor' END"
    if not raw:
        risk, action = f"upper({risk})", f"upper({action})"
    effective = ("strftime(ts, '%d-%b-%Y %H:%M:%S')" if raw else "date_trunc('second', ts)")
    return f"""
        printf('WL%06d', event_id) AS watchlist_id,
        '4' || lpad(CAST(user_id AS VARCHAR), 15, '0') AS entity_id,
        'CARD' AS watch_type,
        {risk} AS risk_level,
        {action} AS action,
        'R' || (event_id % 5) AS reason_code,
        'large error event' AS reason_description,
        {effective} AS effective_from,
        'monitoring' AS reported_by,
        'events' AS reported_source,
        'City ' || (user_id % 12) AS city,
        'US' AS country
    FROM events WHERE event_type = 'error' AND value > 150"""


WL_RAW = f"wlraw AS (SELECT {_watchlist(True)})"
WL = f"wl AS (SELECT {_watchlist(False)})"

LINEAGE = ("'transactions' AS kafka_topic, 0 AS kafka_partition, event_id AS kafka_offset, "
           "ts AS kafka_timestamp")

JSON_VALUE = "to_json({" + ", ".join(
    f"'{c}': " + ("strftime(ts, '%Y-%m-%d %H:%M:%S.%f')" if c == "transaction_timestamp" else c)
    for c in PAYLOAD) + "})::VARCHAR"

# json_parse: every 13th value is not JSON (all fields NULL), the next one
# has the amount as a quoted string (amount NULL).
JSON_PARSE = f"""WITH {TX}
SELECT {", ".join(
    f"CASE WHEN event_id % 13 = 0 THEN NULL ELSE {c} END AS {c}" if c != "amount" else
    "CASE WHEN event_id % 13 IN (0, 1) THEN NULL ELSE amount END AS amount" for c in PAYLOAD)},
       {LINEAGE}
FROM tx"""

HIGH_VALUE_SELECT = """
SELECT 'ALERT-' || t.transaction_id AS alert_id,
       'HIGH_VALUE_TRANSACTION' AS alert_type,
       t.transaction_id, t.customer_id,
       c.email AS customer_email,
       concat_ws(' ', c.first_name, c.last_name) AS customer_name,
       t.amount AS transaction_amount, c.transaction_limit, t.currency, t.merchant_name,
       t.merchant_category, t.transaction_type, t.payment_channel, t.city, t.country,
       t.is_international, t.transaction_timestamp, t.status
FROM tx t JOIN cust c ON t.customer_id = c.customer_id
WHERE t.amount > CAST(c.transaction_limit AS DOUBLE)"""

FRAUD_SELECT = """
SELECT concat_ws('-', 'FRAUD', t.transaction_id, w.watchlist_id) AS alert_id,
       'FRAUD_WATCHLIST_MATCH' AS alert_type,
       t.transaction_id, t.customer_id,
       c.email AS customer_email,
       concat_ws(' ', c.first_name, c.last_name) AS customer_name,
       t.card_number, t.amount, t.currency, t.merchant_id, t.merchant_name,
       t.merchant_category, t.transaction_type, t.payment_channel, t.device_id,
       t.city AS transaction_city, t.country AS transaction_country,
       t.transaction_timestamp, t.is_international, t.status AS transaction_status,
       w.watchlist_id, w.watch_type, w.risk_level, w.action, w.reason_code,
       w.reason_description, w.effective_from AS watchlist_effective_from,
       w.reported_by, w.reported_source, w.city AS watchlist_city,
       w.country AS watchlist_country
FROM tx t
JOIN wl w ON t.card_number = w.entity_id
JOIN cust c ON t.customer_id = c.customer_id"""

EXPECTATIONS = [
    ("valid_transaction_id", "drop", "transaction_id IS NOT NULL"),
    ("valid_customer_id", "drop", "customer_id IS NOT NULL"),
    ("valid_card_number", "drop", "card_number IS NOT NULL"),
    ("valid_merchant_id", "drop", "merchant_id IS NOT NULL"),
    ("valid_amount", "warn", "amount > 0"),
]
TX_OUT = ", ".join(PAYLOAD)



def _h(expr: str) -> str:
    """HTML-escaped text, NULL as empty (as ``html_text``)."""
    return ("coalesce(replace(replace(replace(replace(CAST(" + expr +
            " AS VARCHAR), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '')")


def _money(expr: str) -> str:
    return f"format('{{:,.2f}}', {expr})"


def _when(expr: str) -> str:
    """Date and time; the second's fraction in six digits unless it is zero."""
    return f"replace(strftime({expr}, '%Y-%m-%d %H:%M:%S.%f'), '.000000', '')"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The rules of the messages, stated apart from the code that renders them: a
# message per high-value alert with all its fields, its id and time; one
# digest per customer whose subject has the customer's full count.
_HV_FIELDS = {
    "Transaction ID": _h("transaction_id"),
    "Amount": f"{_h('currency')} || ' ' || {_h(_money('transaction_amount'))}",
    "Your Limit": f"{_h('currency')} || ' ' || {_h(_money('transaction_limit'))}",
    "Merchant": _h("merchant_name"), "Category": _h("merchant_category"),
    "Transaction Type": _h("transaction_type"), "Payment Channel": _h("payment_channel"),
    "Location": f"{_h('city')} || ', ' || {_h('country')}",
    "International": "CASE WHEN is_international THEN 'Yes' ELSE 'No' END",
    "Timestamp": _h(_when("transaction_timestamp")), "Status": _h("status"),
}
_HV_NOTICES = ("<ul><li>If you recognize this transaction, no action is needed.</li>"
               "<li>If you don't recognize this transaction, please contact us immediately.</li>"
               "<li>You can adjust your transaction limit in your account settings.</li></ul>")


def high_value_messages(alert_time: str) -> str:
    rows = " || ".join(f"'<tr><td>{label}:</td><td>' || {value} || '</td></tr>'"
                       for label, value in _HV_FIELDS.items())
    return f"""
SELECT customer_email AS recipient, customer_name AS recipient_name,
       '⚠️ High-Value Transaction Alert - ' || coalesce(transaction_id, '') AS subject,
       '<p>Dear ' || {_h('customer_name')} || ',</p>'
       || '<p>One of your transactions is above the limit you have set:</p><table>'
       || {rows} || '</table>' || {_q(_HV_NOTICES)} || '<p>Alert ID: ' || {_h('alert_id')}
       || {alert_time} || '</p>' AS body,
       1::BIGINT AS alert_count
FROM hv"""


_FRAUD_FIELDS = {
    "Transaction ID": _h("transaction_id"),
    "Amount": f"{_h('amount')} || ' ' || {_h('currency')}",
    "Merchant": _h("merchant_name"), "Type": _h("transaction_type"),
    "Location": f"{_h('transaction_city')} || ', ' || {_h('transaction_country')}",
    "Timestamp": _h(_when("transaction_timestamp")), "Alert Type": _h("alert_type"),
    "Risk Level": _h("risk_level"), "Action": _h("action"), "Reason": _h("reason_description"),
}
_HEADER = "".join(f"<th>{c}</th>" for c in _FRAUD_FIELDS)
_FRAUD_NOTICES = ("<ul><li>If you recognize these transactions, no action is needed.</li>"
                  "<li>If you don't recognize any of these transactions, please contact us "
                  "immediately.</li></ul>")
FRAUD_LINES = f"""
SELECT customer_email AS recipient, customer_name AS recipient_name, alert_id,
       '<tr>' || {" || ".join(f"'<td>' || {c} || '</td>'" for c in _FRAUD_FIELDS.values())}
       || '</tr>' AS row_html
FROM fa"""
FRAUD_DIGESTS = f"""
SELECT customer_email AS recipient, customer_name AS recipient_name,
       '🚨 Fraud Transaction Alert - ' || count(*) || ' Detected' AS subject,
       '<p>Dear ' || {_h('customer_name')} || ',</p>'
       || '<p>Transactions on a watch-listed card were found on your account:</p>'
       || '<table><thead><tr>{_HEADER}</tr></thead><tbody><!--lines--></tbody></table>'
       || {_q(_FRAUD_NOTICES)} AS body,
       count(*)::BIGINT AS alert_count
FROM fa GROUP BY customer_email, customer_name"""

ALERT_CTES = f"{TX}, {WL}, {CUST}, hv AS ({HIGH_VALUE_SELECT}), fa AS ({FRAUD_SELECT})"
OUTBOX = f"""WITH {ALERT_CTES}
SELECT 'high_value' AS flow, * FROM ({high_value_messages("''")})
UNION ALL
SELECT 'fraud' AS flow, * FROM ({FRAUD_DIGESTS})"""

DELIVERED = "(SELECT max(event_id) FROM events WHERE event_type = 'error' AND value > 150 " \
            "AND ts < TIMESTAMP '2024-01-16 00:00:00')"

WL_NUMBER = "CAST(substr(watchlist_id, 3) AS BIGINT)"
# The feed CSV as ``catalog._stage_feed`` is described: ids without a number,
# quotes, commas and line breaks.
FEED = f"WITH {WL_RAW}"
FEED_OUT = f"""* REPLACE (
        CASE WHEN {WL_NUMBER} % 9 = 0 THEN 'X' || watchlist_id ELSE watchlist_id END AS watchlist_id,
        'said "hi", twice' || chr(10) || 'by ' || reported_by AS reason_description)"""
_RECORD = ("watchlist_id", "entity_id", "watch_type", "risk_level", "action", "reason_code",
           "reason_description", "effective_from", "reported_by", "reported_source", "city",
           "country")
_CUT = "".join(f"CASE WHEN {WL_NUMBER} % 5 = 0 THEN NULL ELSE {c} END AS {c}, " for c in _RECORD)
_LINE = ("'{' || " + " || ',' || ".join(f"""'"{c}":"' || {c} || '"'""" for c in _RECORD) + " || '}'")
WATCHLIST_RESCUED = f"""WITH {WL_RAW} SELECT {_CUT}
    CASE WHEN {WL_NUMBER} % 5 = 0 THEN substr({_LINE}, 1, 30)
         WHEN {WL_NUMBER} % 3 = 0 THEN '{{"region":"eu","batch":"' || {WL_NUMBER} || '"}}'
    END AS rescued_data FROM wlraw"""

_CUT_NEWER = "".join(f"CASE WHEN newer AND n % 5 = 0 THEN NULL ELSE {c} END AS {c}, " for c in _RECORD)

ORACLE: dict[str, str] = {
    "tumbling_count": f"SELECT * FROM ({TUMBLING}) WHERE window_end <= {WATERMARK}",
    "sliding_count": f"SELECT * FROM ({SLIDING}) WHERE window_end <= {WATERMARK}",
    "tumbling_count_batch": TUMBLING,
    "late_rows_dropped": f"""SELECT * FROM ({TUMBLING.replace("FROM events", "FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'")}) WHERE window_end <= {WATERMARK}""",
    "sliding_count_batch": SLIDING,
    "bronze_transactions": f"""WITH {TX}
        SELECT CAST(transaction_id AS VARCHAR) AS key, {JSON_VALUE} AS value,
               'transactions' AS topic, 0 AS "partition", event_id AS "offset",
               ts AS "timestamp", 0 AS "timestampType"
        FROM tx""",
    "silver_transactions": f"WITH {TX} SELECT {TX_OUT}, {LINEAGE} FROM tx",
    "json_parse": JSON_PARSE,
    "expect_or_drop": f"""WITH {DIRTY_TX} SELECT {TX_OUT} FROM dtx
        WHERE {" AND ".join(p for _, a, p in EXPECTATIONS if a == "drop")}""",
    "expect_warn": f"WITH {DIRTY_TX} SELECT {TX_OUT} FROM dtx",
    "expectation_metrics": f"WITH {DIRTY_TX} " + " UNION ALL ".join(
        f"SELECT '{n}' AS expectation, '{a}' AS action, "
        f"count(*) FILTER (WHERE NOT coalesce({p}, false))::BIGINT AS failed_rows, "
        f"count(*)::BIGINT AS total_rows FROM dtx" for n, a, p in EXPECTATIONS),
    "bronze_customers": f"WITH {BRONZE_CUST} SELECT * FROM bcust",
    "silver_customers": f"WITH {CUST} SELECT * FROM cust",
    "stream_static_join": f"""WITH {TX}, {CUST}
        SELECT t.transaction_id, t.customer_id, t.amount, c.transaction_limit,
               c.email AS customer_email,
               concat_ws(' ', c.first_name, c.last_name) AS customer_name
        FROM tx t JOIN cust c ON t.customer_id = c.customer_id""",
    "high_value_transactions": f"WITH {TX}, {CUST} {HIGH_VALUE_SELECT}",
    "alert_id": f"""WITH {TX}, {WL}, {CUST}
        SELECT t.transaction_id, w.watchlist_id,
               concat_ws('-', 'FRAUD', t.transaction_id, w.watchlist_id) AS alert_id,
               concat_ws(' ', c.first_name, c.last_name) AS customer_name
        FROM tx t JOIN wl w ON t.card_number = w.entity_id
        JOIN cust c ON t.customer_id = c.customer_id""",
    "bronze_watchlist": f"WITH {WL_RAW} SELECT *, NULL::VARCHAR AS rescued_data FROM wlraw",
    "source_file_lineage": f"""WITH {WL_RAW} SELECT *, NULL::VARCHAR AS rescued_data,
        true AS in_drop_folder, true AS is_part_file FROM wlraw""",
    "watchlist_rescued": WATCHLIST_RESCUED,
    "silver_watchlist": f"WITH {WL} SELECT *, NULL::VARCHAR AS rescued_data FROM wl",
    "stream_stream_join": f"""WITH {TX}, {WL}
        SELECT t.transaction_id, t.card_number, t.transaction_timestamp, w.watchlist_id,
               w.effective_from
        FROM tx t JOIN wl w ON t.card_number = w.entity_id""",
    "fraud_transactions": f"WITH {TX}, {WL}, {CUST} {FRAUD_SELECT}",
    "alert_message_high_value": f"WITH {ALERT_CTES} " + high_value_messages(
        f"'<br>Alert Time: ' || {_h(_when('transaction_timestamp'))}"),
    "alert_digest": f"WITH {ALERT_CTES} {FRAUD_DIGESTS}",
    "alert_digest_lines": f"WITH {ALERT_CTES} {FRAUD_LINES}",
    "alert_outbox": OUTBOX,
    "alert_outbox_lines": f"WITH {ALERT_CTES} SELECT 'fraud' AS flow, * FROM ({FRAUD_LINES})",
    "outbox_batch_summary": f"""SELECT flow, count(*)::BIGINT AS messages,
        sum(alert_count)::BIGINT AS alerts FROM ({OUTBOX}) GROUP BY flow""",
    "compacted_transactions": f"WITH {TX} SELECT {TX_OUT} FROM tx",
    "customers_current": f"""WITH {BRONZE_CUST} SELECT * REPLACE (
            CASE WHEN customer_id::BIGINT % 3 = 0 THEN 'Moved' ELSE city END AS city,
            CASE WHEN customer_id::BIGINT % 3 <> 0 AND customer_id::BIGINT % 7 = 0 THEN 'CORRECTED'
                 ELSE customer_segment END AS customer_segment,
            CASE WHEN customer_id::BIGINT % 3 = 0 THEN update_timestamp + INTERVAL 1 DAY
                 ELSE update_timestamp END AS update_timestamp) FROM bcust""",
    "alert_outbox_indexed": OUTBOX,
    "delivery_tally": f"""SELECT flow, count(*)::BIGINT AS messages,
        count(*) FILTER (WHERE length(recipient) % 3 = 0)::BIGINT AS delivered,
        count(*) FILTER (WHERE length(recipient) % 3 = 1)::BIGINT AS failed,
        count(*) FILTER (WHERE length(recipient) % 3 = 2)::BIGINT AS pending
        FROM ({OUTBOX}) GROUP BY flow""",
    "late_rows": f"""WITH {TX} SELECT {TX_OUT} FROM tx WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
        AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {WATERMARK}""",
    "watchlist_evolved": f"""WITH {WL_RAW}, placed AS (
            SELECT *, {WL_NUMBER} AS n, strptime(effective_from, '%d-%b-%Y %H:%M:%S')
                   >= TIMESTAMP '2024-01-16 00:00:00' AS newer, {_LINE} AS line FROM wlraw)
        SELECT {_CUT_NEWER}
               CASE WHEN NOT (newer AND n % 5 = 0) AND n % 3 = 0 THEN 'eu' END AS region,
               CASE WHEN newer AND n % 5 = 0 THEN NULL
                    WHEN newer AND n % 2 = 1 THEN n + 0.5::DOUBLE ELSE n::DOUBLE END AS score,
               CASE WHEN newer AND n % 5 <> 0 THEN n % 4 = 0 END AS checked,
               CASE WHEN newer AND n % 5 = 0 THEN substr(line, 1, 30) END AS rescued_data
        FROM placed""",
    "watchlist_high_water_mark": f"""SELECT {DELIVERED} AS max_id_num,
        printf('WL%06d', {DELIVERED}) AS latest_watchlist_id""",
    "watchlist_new_records": f"""{FEED} SELECT {FEED_OUT}, NULL::VARCHAR AS note FROM wlraw
        WHERE {WL_NUMBER} % 9 <> 0 AND {WL_NUMBER} > {DELIVERED}""",
    "watchlist_rejects": f"""{FEED} SELECT {FEED_OUT}, NULL::VARCHAR AS note FROM wlraw
        WHERE {WL_NUMBER} % 9 = 0""",
}
# The same rows by another mechanism.
ORACLE |= {"sliding_count_chained": ORACLE["sliding_count"],
           "watchlist_delta_matches": ORACLE["stream_stream_join"],
           "high_value_pruned_join": ORACLE["high_value_transactions"],
           "expectations_committed": ORACLE["expectation_metrics"]}
