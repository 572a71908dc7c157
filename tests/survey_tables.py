"""The account tables of FIXTURES.md section 3, for its regression counts."""

from tidemark.sources.tables import AccountTables, conform_all

STATEMENTS = {
    "created": """
        SELECT concat('acct-', CAST(user_id AS STRING)) AS account_id_hashed,
               concat('user-', CAST(CAST(floor(user_id / 3) AS BIGINT) AS STRING))
                 AS user_id_hashed,
               CASE WHEN user_id % 11 = 10 THEN NULL
                    WHEN user_id % 3 = 0 THEN 'uk_retail'
                    WHEN user_id % 3 = 1 THEN 'uk_retail_pot'
                    ELSE 'uk_retail_joint' END AS account_type,
               MIN(ts) AS created_ts
        FROM {ev} WHERE user_id % 13 <> 12 GROUP BY user_id""",
    "closed": """
        SELECT concat('acct-', CAST(user_id AS STRING)) AS account_id_hashed, ts AS closed_ts
        FROM {ev} WHERE event_type = 'error' AND user_id % 4 <> 0 AND value > 25""",
    "reopened": """
        SELECT concat('acct-', CAST(user_id AS STRING)) AS account_id_hashed, ts AS reopened_ts
        FROM {ev} WHERE event_type = 'signup' AND user_id % 7 <> 3 AND value > 60""",
    "transactions": """
        SELECT concat('acct-', CAST(user_id AS STRING)) AS account_id_hashed,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date,
               CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT)
                 AS transactions_num
        FROM {ev} WHERE event_type IN ('purchase', 'view') AND value > 90
        GROUP BY user_id, CAST(ts AS DATE)""",
}


def survey_tables(spark, folder: str, before: str | None = None) -> AccountTables:
    """`before` keeps only events earlier than that timestamp."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    started = "CAST(ts AS DATE) >= DATE '2024-01-01' + CAST(user_id % 15 AS INT)"
    ev = events.filter(started)
    if before:
        ev = ev.filter(f"ts < TIMESTAMP_NTZ'{before}'")
    frames = {name: spark.sql(text, ev=ev) for name, text in STATEMENTS.items()}
    return conform_all(**frames)
