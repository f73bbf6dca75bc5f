"""The same queries as ANSI SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

LINES = """
lines AS (
  SELECT CAST(o_custkey AS VARCHAR) AS client_id,
         'NI' || CAST(o_custkey AS VARCHAR) AS client_nino,
         CAST(l_suppkey AS VARCHAR) AS adviser_id,
         CAST(o_orderdate AS DATE) AS fee_date,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END
              AS DECIMAL(18,2)) AS fee_amount,
         l_quantity, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

COLS = "client_id, client_nino, adviser_id, fee_date, fee_amount"

LEDGERS = {
    "base": f"SELECT {COLS} FROM lines",
    "raw": f"""
  SELECT CASE WHEN l_quantity = 1 AND l_tax = 0.08 THEN NULL ELSE client_id END AS client_id,
         client_nino, adviser_id, fee_date, fee_amount FROM lines
  UNION ALL
  SELECT {COLS} FROM lines WHERE l_quantity = 50""",
    "faulty": """
  SELECT CASE WHEN l_quantity = 1 AND l_tax = 0.08 THEN NULL ELSE client_id END AS client_id,
         client_nino, adviser_id, fee_date, fee_amount FROM lines
  UNION ALL
  SELECT client_id, CASE WHEN l_tax = 0 THEN client_nino || 'X' ELSE client_nino END,
         adviser_id, fee_date, fee_amount FROM lines WHERE l_quantity = 50""",
    "bulky": f"""
  SELECT {COLS} FROM lines
  UNION ALL
  SELECT {COLS} FROM lines WHERE l_quantity >= 45""",
    "events": """
  SELECT CAST(user_id AS VARCHAR) AS client_id, 'NI' || CAST(user_id AS VARCHAR) AS client_nino,
         event_type AS adviser_id, CAST(ts AS DATE) AS fee_date, CAST(value AS DECIMAL(18,2)) AS fee_amount
  FROM events""",
}

FEE_ID = (
    "md5(client_id || chr(31) || adviser_id || chr(31) || CAST(fee_date AS VARCHAR) || chr(31) "
    "|| CAST(fee_amount AS VARCHAR))"
)
COMPLETE = (
    "client_id IS NOT NULL AND client_nino IS NOT NULL AND adviser_id IS NOT NULL "
    "AND fee_date IS NOT NULL AND fee_amount IS NOT NULL"
)
FEE_OUT = "fee_id, client_id, client_nino, adviser_id, fee_date, CAST(fee_amount AS DOUBLE) AS fee_amount"


def ledger(variant: str, name: str = "raw_fees") -> str:
    return f"{name} AS ({LEDGERS[variant]})"


def staged(source: str = "raw_fees", name: str = "stg") -> str:
    return f"{name} AS (SELECT DISTINCT {FEE_ID} AS fee_id, {COLS} FROM {source} WHERE {COMPLETE})"


def dimension(stg: str = "stg", name: str = "dim") -> str:
    return f"""{name} AS (
  SELECT client_id, fee_date AS first_fee_date, adviser_id AS first_adviser_id,
         substr(CAST(fee_date AS VARCHAR), 1, 7) AS cohort_month
  FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY fee_date, fee_id) AS rn FROM {stg})
  WHERE rn = 1)"""


def values(stg: str = "stg", dim: str = "dim", name: str = "ltv", windows=(1, 3, 6)) -> str:
    sums = "".join(
        f"""
         sum(CASE WHEN f.fee_date < c.first_fee_date + INTERVAL {n} MONTH
                  THEN f.fee_amount ELSE 0 END) AS ltv_{n}_month,"""
        for n in windows
    )
    return f"""{name} AS (
  SELECT f.client_id, c.first_fee_date,{sums}
         sum(f.fee_amount) AS ltv_total
  FROM {stg} f JOIN {dim} c ON f.client_id = c.client_id
  GROUP BY f.client_id, c.first_fee_date)"""


def hundredths(units: str, parts: str) -> str:
    """units / parts / 100 with 2 decimals, half away from zero: the quotient and the remainder decide."""
    up = f"CASE WHEN 2 * (abs({units}) % {parts}) >= {parts} THEN 1 ELSE 0 END"
    return f"CAST(sign({units}) * (abs({units}) // {parts} + {up}) AS DOUBLE) / 100"


def mean(total: str, count: str) -> str:
    """Mean of an amount in pounds, to pennies."""
    return hundredths(f"CAST({total} * 100 AS HUGEINT)", count)


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


LTV_OUT = (
    "client_id, first_fee_date, CAST(ltv_1_month AS DOUBLE) AS ltv_1_month, "
    "CAST(ltv_3_month AS DOUBLE) AS ltv_3_month, CAST(ltv_6_month AS DOUBLE) AS ltv_6_month, "
    "CAST(ltv_total AS DOUBLE) AS ltv_total"
)

COHORT = f"""
SELECT c.cohort_month, count(DISTINCT l.client_id) AS client_count,
       {mean('sum(l.ltv_1_month)', 'count(*)')} AS avg_ltv_1_month,
       {mean('sum(l.ltv_3_month)', 'count(*)')} AS avg_ltv_3_month,
       {mean('sum(l.ltv_6_month)', 'count(*)')} AS avg_ltv_6_month,
       {dbl('sum(l.ltv_1_month)')} AS total_ltv_1_month,
       {dbl('sum(l.ltv_3_month)')} AS total_ltv_3_month,
       {dbl('sum(l.ltv_6_month)')} AS total_ltv_6_month,
       {dbl('percentile_disc(0.5) WITHIN GROUP (ORDER BY l.ltv_6_month)')} AS median_ltv_6_month
FROM dim c JOIN ltv l ON c.client_id = l.client_id
"""


def adviser_report(adviser: str = "c.first_adviser_id", dim: str = "dim", ltv: str = "ltv") -> str:
    return f"""
SELECT {adviser} AS adviser_id, count(DISTINCT c.client_id) AS client_count,
       {dbl('sum(l.ltv_1_month)')} AS total_client_ltv_1_month,
       {dbl('sum(l.ltv_3_month)')} AS total_client_ltv_3_month,
       {dbl('sum(l.ltv_6_month)')} AS total_client_ltv_6_month,
       {dbl('sum(l.ltv_total)')} AS total_client_ltv_all_time,
       {mean('sum(l.ltv_6_month)', 'count(*)')} AS avg_client_ltv_6_month,
       CAST(rank() OVER (ORDER BY sum(l.ltv_6_month) DESC) AS BIGINT) AS rank_by_ltv_6_month
FROM {dim} c JOIN {ltv} l ON c.client_id = l.client_id
GROUP BY {adviser}
"""


def chain(variant: str) -> str:
    parts = [] if variant == "events" else [LINES]
    return with_(*parts, ledger(variant), staged(), dimension(), values())


# The incremental queries: first load to 1999-06-30 with old national insurance numbers, then the rest.
EARLY = f"""early AS (
  SELECT DISTINCT {FEE_ID} AS fee_id, client_id, 'OLD' || client_nino AS client_nino, adviser_id, fee_date, fee_amount
  FROM raw_fees WHERE fee_date <= DATE '1999-06-30' AND {COMPLETE})"""


def upserted(incoming: str) -> str:
    return f"""
SELECT {FEE_OUT} FROM {incoming}
UNION ALL
SELECT {FEE_OUT} FROM early WHERE fee_id NOT IN (SELECT fee_id FROM {incoming})
"""


RECENT = "recent AS (SELECT * FROM stg WHERE fee_date >= (SELECT max(fee_date) FROM early) - INTERVAL 3 DAY)"

EXPECTED = """expected AS (
  SELECT f.client_id,
         sum(CASE WHEN f.fee_date < m.first_seen + INTERVAL 1 MONTH THEN f.fee_amount ELSE 0 END) AS e1,
         sum(CASE WHEN f.fee_date < m.first_seen + INTERVAL 3 MONTH THEN f.fee_amount ELSE 0 END) AS e3,
         sum(CASE WHEN f.fee_date < m.first_seen + INTERVAL 6 MONTH THEN f.fee_amount ELSE 0 END) AS e6,
         sum(f.fee_amount) AS et
  FROM {stg} f JOIN (SELECT client_id, min(fee_date) AS first_seen FROM {stg} GROUP BY client_id) m
    ON f.client_id = m.client_id
  GROUP BY f.client_id)"""

FAULTY_BESIDE_CLEAN = [
    LINES, ledger("raw"), staged(), dimension(), values(),
    ledger("faulty", "raw_faulty"), staged("raw_faulty", "stg_faulty"),
]


def summary(variant: str) -> str:
    unique = {
        "stg_fees.fee_id": "stg", "dim_clients.client_id": "dim", "rpt_client_ltv.client_id": "ltv",
        "rpt_cohort_ltv.cohort_month": "cohort", "rpt_adviser_ltv.adviser_id": "adviser",
    }
    required = [
        ("stg", "stg_fees", ["fee_id", "client_id", "client_nino", "adviser_id", "fee_date", "fee_amount"]),
        ("dim", "dim_clients", ["client_id", "first_fee_date", "first_adviser_id", "cohort_month"]),
        ("ltv", "rpt_client_ltv", ["client_id"]),
        ("cohort", "rpt_cohort_ltv", ["cohort_month"]),
        ("adviser", "rpt_adviser_ltv", ["adviser_id"]),
    ]
    rows = [
        f"""SELECT 'unique {label}' AS "check", (SELECT count(*) FROM (
              SELECT {label.split('.')[1]} FROM {cte} WHERE {label.split('.')[1]} IS NOT NULL
              GROUP BY 1 HAVING count(*) > 1)) AS violations"""
        for label, cte in unique.items()
    ]
    rows += [
        f"SELECT 'not_null {table}.{c}', (SELECT count(*) FROM {cte} WHERE {c} IS NULL)"
        for cte, table, columns in required
        for c in columns
    ]
    rows.append(
        "SELECT 'one nino per client', (SELECT count(*) FROM "
        "(SELECT client_id FROM stg GROUP BY 1 HAVING count(DISTINCT client_nino) > 1))"
    )
    rows.append(
        "SELECT 'financial reconciliation', (SELECT CASE WHEN abs((SELECT sum(fee_amount) FROM stg) "
        "- (SELECT sum(ltv_total) FROM ltv)) > 0.01 THEN 1 ELSE 0 END)"
    )
    rows.append(
        "SELECT 'row count reconciliation', (SELECT CASE WHEN s > r OR r - s > r * 0.05 THEN 1 ELSE 0 END FROM "
        "(SELECT (SELECT count(*) FROM raw_fees) AS r, (SELECT count(*) FROM stg) AS s))"
    )
    rows.append(
        "SELECT 'ltv recomputation', (SELECT count(*) FROM expected e JOIN ltv l ON e.client_id = l.client_id "
        "WHERE abs(e1 - ltv_1_month) > 0.01 OR abs(e3 - ltv_3_month) > 0.01 OR abs(e6 - ltv_6_month) > 0.01 "
        "OR abs(et - ltv_total) > 0.01)"
    )
    head = with_(
        LINES, ledger(variant), staged(), dimension(), values(),
        f"cohort AS ({COHORT} GROUP BY c.cohort_month)", f"adviser AS ({adviser_report()})",
        EXPECTED.format(stg="stg"),
    )
    return head + "\nSELECT \"check\", CAST(violations AS BIGINT) AS violations FROM (" + " UNION ALL ".join(rows) + ")"


def anomalies(days: int, sigmas: float) -> str:
    """Sums of pennies are exact integers; the spread is taken from them."""
    frame = f"OVER (ORDER BY fee_date ROWS BETWEEN {days} PRECEDING AND 1 PRECEDING)"
    return f""",
daily AS (SELECT fee_date, count(*) AS fees, CAST(sum(fee_amount) * 100 AS HUGEINT) AS u FROM stg GROUP BY fee_date),
stats AS (SELECT fee_date, fees, u, count(*) {frame} AS n, CAST(sum(u) {frame} AS HUGEINT) AS s,
                 CAST(sum(u * u) {frame} AS HUGEINT) AS ss FROM daily),
shown AS (
  SELECT fee_date, fees, CAST(CAST(u AS DECIMAL(38,0)) / 100 AS DOUBLE) AS total_fees,
         CASE WHEN n >= 2 THEN {hundredths('s', 'n')} END AS expected_fees,
         CASE WHEN n >= 2 THEN round(sqrt(CAST(ss * n - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / 100.0, 2)
         END AS deviation
  FROM stats)
SELECT *, coalesce(abs(total_fees - expected_fees) > deviation * {sigmas}, false) AS anomalous FROM shown"""



def calendar_anomalies(days: int, sigmas: float) -> str:
    frame = f"OVER (ORDER BY fee_date RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"
    return f""",
weekdays AS (SELECT * FROM stg WHERE dayofweek(fee_date) <> 0),
summed AS (SELECT fee_date, count(*) AS fees, CAST(sum(fee_amount) * 100 AS HUGEINT) AS u FROM weekdays GROUP BY fee_date),
calendar AS (SELECT CAST(unnest(generate_series((SELECT min(fee_date) FROM weekdays), (SELECT max(fee_date) FROM weekdays), INTERVAL 1 DAY)) AS DATE) AS fee_date),
daily AS (SELECT c.fee_date, coalesce(fees, 0) AS fees, CAST(coalesce(u, 0) AS HUGEINT) AS u FROM calendar c LEFT JOIN summed s ON s.fee_date = c.fee_date),
stats AS (SELECT fee_date, fees, u, count(*) {frame} AS n, CAST(sum(u) {frame} AS HUGEINT) AS s,
                 CAST(sum(u * u) {frame} AS HUGEINT) AS ss, coalesce(sum(CASE WHEN fees > 0 THEN 1 ELSE 0 END) {frame}, 0) AS busy FROM daily),
shown AS (
  SELECT fee_date, fees, CAST(CAST(u AS DECIMAL(38,0)) / 100 AS DOUBLE) AS total_fees,
         CASE WHEN n >= 2 THEN {hundredths('s', 'n')} END AS expected_fees,
         CASE WHEN n >= 2 THEN round(sqrt(CAST(ss * n - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / 100.0, 2) END AS deviation,
         fees = 0 AS silent, busy, n
  FROM stats)
SELECT fee_date, fees, total_fees, expected_fees, deviation, silent,
       coalesce(abs(total_fees - expected_fees) > deviation * {sigmas}, false) OR (silent AND n > 0 AND busy * 2 >= n) AS anomalous FROM shown"""


def keyed_digest(column: str, secret: str) -> str:
    """HMAC-SHA256 by its definition, for a secret of at most 64 bytes."""
    inner, outer = ("".join(f"{b ^ pad:02x}" for b in secret.encode().ljust(64, b"\0")) for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({column}))))"


def layer_rows(prefix: str = "") -> dict[str, str]:
    return {
        "raw_fees": f"{prefix}raw_fees", "stg_fees": f"{prefix}stg", "dim_clients": f"{prefix}dim",
        "rpt_client_ltv": f"{prefix}ltv", "rpt_cohort_ltv": f"{prefix}cohort", "rpt_adviser_ltv": f"{prefix}adviser",
    }


def build_ctes(variant: str, prefix: str = "") -> list[str]:
    p = prefix
    return [
        ledger(variant, f"{p}raw_fees"),
        staged(f"{p}raw_fees", f"{p}stg"),
        dimension(f"{p}stg", f"{p}dim"),
        values(f"{p}stg", f"{p}dim", f"{p}ltv"),
        f"{p}cohort AS (SELECT DISTINCT cohort_month FROM {p}dim)",
        f"{p}adviser AS (SELECT DISTINCT first_adviser_id AS adviser_id FROM {p}dim)",
    ]


def build_measures(prefix: str) -> str:
    money = {"raw_fees": "fee_amount", "stg_fees": "fee_amount", "rpt_client_ltv": "ltv_total"}
    rows = []
    for table, cte in layer_rows(prefix).items():
        rows.append(f"SELECT '{table}' AS tab, 'rows' AS measure, CAST(count(*) AS DOUBLE) AS v FROM {cte}")
        if table in money:
            rows.append(f"SELECT '{table}', '{money[table]}', CAST(sum({money[table]}) AS DOUBLE) FROM {cte}")
    return " UNION ALL ".join(rows)


def _queries() -> dict[str, str]:
    raw_stg = with_(LINES, ledger("raw"), staged())
    faulty_stg = with_(LINES, ledger("faulty"), staged())
    clean = chain("raw")
    q = {}

    q["stg_fees"] = f"{raw_stg} SELECT {FEE_OUT} FROM stg"
    q["stg_clustered"] = q["stg_fees"]
    q["stg_fees_by_key"] = f"""{faulty_stg}
SELECT fee_id, client_id, min(client_nino) AS client_nino, adviser_id, fee_date,
       CAST(min(fee_amount) AS DOUBLE) AS fee_amount
FROM stg GROUP BY fee_id, client_id, adviser_id, fee_date"""
    q["stg_incremental_slice"] = f"""{raw_stg}
SELECT {FEE_OUT} FROM stg WHERE fee_date >= (SELECT max(fee_date) FROM raw_fees) - INTERVAL 3 DAY"""
    incremental = with_(LINES, ledger("raw"), staged(), EARLY, RECENT)
    q["stg_upsert"] = incremental + upserted("recent")
    reading = """SELECT '{name}' AS reading, count(*) AS "rows", min(fee_date) AS first_date, max(fee_date) AS last_date,
       count(*) FILTER (client_nino LIKE 'OLD%') AS old_numbers, CAST(CAST(sum(CAST(fee_amount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS total_fees FROM ({rows})"""
    q["published_versions"] = incremental + " UNION ALL ".join(
        " " + reading.format(name=name, rows=rows)
        for name, rows in {"held": "SELECT * FROM early", "upserted": upserted("recent"), "restored": "SELECT * FROM early"}.items()
    )
    q["stg_append_columns"] = f"""{incremental}
SELECT {FEE_OUT}, 'GBP' AS currency FROM recent
UNION ALL
SELECT {FEE_OUT}, NULL AS currency FROM early WHERE fee_id NOT IN (SELECT fee_id FROM recent)"""
    span = "filled AS (SELECT * FROM stg WHERE fee_date BETWEEN DATE '1996-02-01' AND DATE '1996-04-30')"
    q["backfill_range"] = with_(LINES, ledger("raw"), staged(), EARLY, span) + upserted("filled")

    q["dim_clients"] = f"{clean} SELECT * FROM dim"
    q["client_ltv"] = f"{clean} SELECT {LTV_OUT} FROM ltv"
    q["client_ltv_single_pass"] = q["client_ltv"]
    q["client_ltv_by_layout"] = q["client_ltv"]
    q["client_ltv_yearly"] = (
        with_(LINES, ledger("raw"), staged(), dimension(), values(windows=(12, 24)))
        + " SELECT client_id, first_fee_date, CAST(ltv_12_month AS DOUBLE) AS ltv_12_month, "
        "CAST(ltv_24_month AS DOUBLE) AS ltv_24_month, CAST(ltv_total AS DOUBLE) AS ltv_total FROM ltv"
    )
    q["client_ltv_events"] = f"{chain('events')} SELECT {LTV_OUT} FROM ltv"
    q["cohort_ltv"] = f"{clean} {COHORT} GROUP BY c.cohort_month ORDER BY c.cohort_month"
    q["adviser_ltv"] = f"{clean} {adviser_report()} ORDER BY rank_by_ltv_6_month"
    q["top_advisers"] = f"{clean} {adviser_report()} ORDER BY rank_by_ltv_6_month, adviser_id LIMIT 10"

    q["check_unique_fee_id"] = f"""{faulty_stg}
SELECT fee_id, count(*) AS n_records FROM stg WHERE fee_id IS NOT NULL GROUP BY fee_id HAVING count(*) > 1"""
    q["check_not_null_summary"] = with_(LINES, ledger("raw")) + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, count(*) AS null_rows FROM raw_fees WHERE {c} IS NULL"
        for c in COLS.split(", ")
    )
    q["check_client_nino"] = f"""{faulty_stg}
SELECT client_id, count(DISTINCT client_nino) AS nino_count FROM stg
GROUP BY client_id HAVING count(DISTINCT client_nino) > 1"""
    q["check_financial_reconciliation"] = with_(*FAULTY_BESIDE_CLEAN) + """
SELECT CAST(s AS DOUBLE) AS staging_total_fees, CAST(r AS DOUBLE) AS reporting_total_fees,
       CAST(s - r AS DOUBLE) AS discrepancy
FROM (SELECT (SELECT sum(fee_amount) FROM stg_faulty) AS s, (SELECT sum(ltv_total) FROM ltv) AS r)
WHERE abs(s - r) > 0.01"""
    q["check_row_counts"] = with_(LINES, ledger("bulky"), staged()) + """
SELECT r AS raw_count, s AS staging_count, r - s AS rows_removed,
       """ + hundredths("((r - s) * 10000)", "nullif(r, 0)") + """ AS pct_removed
FROM (SELECT (SELECT count(*) FROM raw_fees) AS r, (SELECT count(*) FROM stg) AS s)
WHERE s > r OR r - s > r * 0.05"""
    pairs = [("e1", "ltv_1_month"), ("e3", "ltv_3_month"), ("e6", "ltv_6_month"), ("et", "ltv_total")]
    q["check_ltv_recompute"] = (
        with_(*FAULTY_BESIDE_CLEAN, EXPECTED.format(stg="stg_faulty"))
        + " SELECT e.client_id, "
        + ", ".join(f"CAST({e} AS DOUBLE) AS expected_{a}, CAST({a} AS DOUBLE) AS actual_{a}" for e, a in pairs)
        + " FROM expected e JOIN ltv l ON e.client_id = l.client_id WHERE "
        + " OR ".join(f"abs({e} - {a}) > 0.01" for e, a in pairs)
    )
    q["check_summary"] = summary("raw")
    q["check_summary_faulty"] = summary("faulty")
    q["refresh_run"] = summary("base")

    q["ingest_summary"] = with_(LINES) + """
SELECT min(fee_date) AS first_date, max(fee_date) AS last_date, CAST(sum(fee_amount) AS DOUBLE) AS total_fees,
       count(*) AS "rows" FROM lines"""
    q["quarantine_summary"] = with_(LINES, ledger("raw")) + """
SELECT CASE WHEN client_id IS NULL THEN 'missing required: client_id' ELSE 'accepted' END AS outcome,
       count(*) AS "rows" FROM raw_fees GROUP BY 1"""
    q["refresh_run_versioned"] = q["refresh_run"]
    q["stream_arrivals"] = with_(LINES, ledger("base"), staged()) + f" SELECT {FEE_OUT} FROM stg"

    last = """last AS (
  SELECT client_id, fee_date AS last_fee_date, adviser_id AS last_adviser_id
  FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY fee_date DESC, fee_id DESC) AS rn FROM stg)
  WHERE rn = 1)"""
    q["last_touch"] = f"{raw_stg}, {last} SELECT * FROM last"
    q["last_touch_ltv"] = f"{clean}, {last} {adviser_report('c.last_adviser_id', 'last')}"
    q["fee_weighted"] = f"""{clean}
SELECT f.adviser_id, count(DISTINCT f.client_id) AS client_count,
       {", ".join(dbl(f"sum(CASE WHEN f.fee_date < c.first_fee_date + INTERVAL {n} MONTH THEN f.fee_amount ELSE 0 END)")
                  + f" AS credited_ltv_{n}_month" for n in (1, 3, 6))},
       {dbl('sum(f.fee_amount)')} AS credited_ltv_total
FROM stg f JOIN dim c ON f.client_id = c.client_id GROUP BY f.adviser_id"""
    names = ["ltv_1_month", "ltv_3_month", "ltv_6_month", "ltv_total"]
    q["time_weighted"] = f"""{clean},
days AS (SELECT DISTINCT client_id, fee_date, adviser_id FROM stg),
per_day AS (SELECT client_id, fee_date, count(*) AS k,
                   coalesce(lead(fee_date) OVER (PARTITION BY client_id ORDER BY fee_date), CAST(fee_date + INTERVAL 1 DAY AS DATE)) - fee_date AS len
            FROM days GROUP BY client_id, fee_date),
pairs AS (SELECT client_id, adviser_id, CAST(sum(len * 1000000 // k) AS HUGEINT) AS w
          FROM days JOIN per_day USING (client_id, fee_date) GROUP BY client_id, adviser_id),
cuts AS (SELECT p.client_id, adviser_id, w, row_number() OVER (PARTITION BY p.client_id ORDER BY w DESC, adviser_id) = 1 AS rest,
                {", ".join(f"CAST({c} * 100 AS HUGEINT) AS {c}, CAST({c} * 100 AS HUGEINT) * w // CAST(sum(w) OVER (PARTITION BY p.client_id) AS HUGEINT) AS cut_{c}" for c in names)}
         FROM pairs p JOIN ltv l ON p.client_id = l.client_id),
credits AS (SELECT adviser_id, w,
                   {", ".join(f"cut_{c} + CASE WHEN rest THEN {c} - sum(cut_{c}) OVER (PARTITION BY client_id) ELSE 0 END AS {c}" for c in names)}
            FROM cuts)
SELECT p.adviser_id, count(*) AS client_count, CAST(sum(w) AS DOUBLE) / 1000000 AS tenure_days,
       {", ".join(f"CAST(sum({c}) AS DOUBLE) / 100 AS credited_{c}" for c in names)}
FROM credits p
GROUP BY p.adviser_id"""

    q["freshness"] = with_(LINES) + """
SELECT latest, CAST(DATE '2001-08-10' - latest AS BIGINT) AS age_days,
       DATE '2001-08-10' - latest > 3 AS stale FROM (SELECT max(fee_date) AS latest FROM lines)"""
    q["daily_anomaly"] = raw_stg + anomalies(28, 3.0)
    q["daily_anomaly_events"] = with_(ledger("events"), staged()) + anomalies(7, 1.0)
    q["calendar_anomaly"] = raw_stg + calendar_anomalies(14, 2.0)
    q["layer_counts"] = with_(LINES, *build_ctes("raw")) + " UNION ALL ".join(
        f" SELECT '{table}' AS \"table\", count(*) AS \"rows\" FROM {cte}" for table, cte in layer_rows().items()
    )
    q["count_changes"] = with_(LINES) + """
SELECT fee_date AS run_id, 'fees' AS "table", n AS "rows", previous_rows FROM (
  SELECT fee_date, n, lag(n) OVER (ORDER BY fee_date) AS previous_rows
  FROM (SELECT fee_date, count(*) AS n FROM lines GROUP BY fee_date))
WHERE abs(n - previous_rows) > previous_rows * 0.5"""
    runs = with_(LINES, ledger("raw"), staged(), ledger("bulky", "raw_bulky"), staged("raw_bulky", "stg_bulky"))
    pairs = {"raw_fees": ("raw_fees", "raw_bulky"), "stg_fees": ("stg", "stg_bulky")}
    q["recorded_counts"] = f'''{runs} SELECT 'second' AS run_id, "table", "rows", previous_rows FROM (''' + " UNION ALL ".join(
        f'''SELECT '{table}' AS "table", (SELECT count(*) FROM {new}) AS "rows", (SELECT count(*) FROM {old}) AS previous_rows'''
        for table, (old, new) in pairs.items()
    ) + ''') WHERE abs("rows" - previous_rows) > previous_rows * 0.05'''
    q["declared_rules"] = with_(LINES, ledger("raw")) + """
SELECT 'not_null client_id' AS rule, count(*) AS violations FROM raw_fees WHERE client_id IS NULL
UNION ALL SELECT 'between fee_amount', count(*) FROM raw_fees WHERE fee_amount NOT BETWEEN -100000 AND 100000
UNION ALL SELECT 'between fee_date', count(*) FROM raw_fees
  WHERE fee_date NOT BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'
UNION ALL SELECT 'unique client_id', count(*) FROM
  (SELECT client_id FROM raw_fees WHERE client_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
    q["late_rows_skipped"] = (
        with_(LINES, ledger("raw"), staged(), ledger("base", "all_fees"), staged("all_fees", "stg_all"))
        + f" SELECT {FEE_OUT} FROM stg_all WHERE fee_id NOT IN (SELECT fee_id FROM stg) "
        "AND fee_date < (SELECT max(fee_date) FROM raw_fees) - INTERVAL 3 DAY"
    )
    q["matured_cohorts"] = (
        f"{clean} {COHORT} WHERE c.first_fee_date + INTERVAL 6 MONTH <= DATE '1999-12-31' GROUP BY c.cohort_month"
    )
    q["reconcile_ltv"] = (
        with_(
            *FAULTY_BESIDE_CLEAN,
            EXPECTED.format(stg="stg_faulty"),
        )
        + """
SELECT * FROM (
  SELECT coalesce(e.client_id, l.client_id) AS client_id,
         CASE WHEN l.client_id IS NULL THEN 'missing in report' WHEN e.client_id IS NULL THEN 'missing in fees'
              WHEN abs(e1 - ltv_1_month) > 0.01 OR abs(e3 - ltv_3_month) > 0.01 OR abs(e6 - ltv_6_month) > 0.01
                   OR abs(et - ltv_total) > 0.01 THEN 'differs' END AS status,
         CAST(et AS DOUBLE) AS expected_ltv_total, CAST(ltv_total AS DOUBLE) AS actual_ltv_total
  FROM expected e FULL JOIN ltv l ON e.client_id = l.client_id) WHERE status IS NOT NULL"""
    )
    q["compare_builds"] = with_(LINES, *build_ctes("raw"), *build_ctes("faulty", "f_")) + f"""
SELECT coalesce(b.tab, a.tab) AS "table", coalesce(b.measure, a.measure) AS measure, b.v AS "before", a.v AS "after",
       CAST(round(CAST(a.v - b.v AS DECIMAL(38,6)), 2) AS DOUBLE) AS difference
FROM ({build_measures("")}) b FULL JOIN ({build_measures("f_")}) a ON a.tab = b.tab AND a.measure = b.measure"""
    q["trace_to_raw"] = f"""{clean},
best AS (SELECT adviser_id FROM ({adviser_report()}) ORDER BY rank_by_ltv_6_month, adviser_id LIMIT 1)
SELECT {FEE_ID} AS fee_id, client_id, client_nino, adviser_id, fee_date, CAST(fee_amount AS DOUBLE) AS fee_amount
FROM raw_fees
WHERE client_id IN (SELECT client_id FROM dim WHERE first_adviser_id IN (SELECT adviser_id FROM best))"""

    q["trace_to_file"] = f"""{clean},
best AS (SELECT adviser_id FROM ({adviser_report()}) ORDER BY rank_by_ltv_6_month, adviser_id LIMIT 1),
records AS (
  SELECT *, strftime(fee_date, '%Y-%m') AS source_month,
         row_number() OVER (PARTITION BY strftime(fee_date, '%Y-%m')
                            ORDER BY client_id NULLS FIRST, client_nino, adviser_id, fee_date, fee_amount) AS source_row
  FROM raw_fees)
SELECT {FEE_ID} AS fee_id, client_id, adviser_id, fee_date, CAST(fee_amount AS DOUBLE) AS fee_amount, source_month, source_row
FROM records
WHERE client_id IN (SELECT client_id FROM dim WHERE first_adviser_id IN (SELECT adviser_id FROM best))"""
    fault = "CASE WHEN l_tax = 0 THEN CAST(l_quantity AS INTEGER) ELSE 0 END"
    q["quarantine_by_column"] = f"""WITH written AS (
  SELECT {fault} AS fault, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
judged AS (
  SELECT fault, amount, CASE fault WHEN 1 THEN 'client_id: missing' WHEN 3 THEN 'fee_date: not a date'
                WHEN 4 THEN 'fee_date: not a date; fee_amount: not a number' WHEN 5 THEN 'fee_amount: not a number'
                WHEN 6 THEN 'wrong number of columns' WHEN 7 THEN 'wrong number of columns' ELSE '' END AS reason
  FROM written)
SELECT CASE WHEN reason = '' THEN 'accepted' ELSE 'rejected' END AS outcome, reason, count(*) AS "rows",
       CAST(sum(amount) FILTER (fault NOT IN (4, 5, 7)) AS DOUBLE) AS total_fees,
       count(*) FILTER (reason <> '') AS records_kept, count(*) FILTER (fault = 2) AS quoted_newlines
FROM judged GROUP BY reason"""
    cases = [
        ("(4, 5)", [("adviser_id", "missing", 3), ("fee_date", "moved", 3), ("fee_amount", "moved", 4)]),
        ("(6, 7)", [("currency", "extra", 6)]),
        ("(8, 9)", [("client_nino", "renamed", 2)]),
        ("(10, 11, 12)", [("client_id", "moved", 5), ("client_nino", "moved", 4), ("fee_date", "moved", 2), ("fee_amount", "moved", 1)]),
    ]
    q["header_drift"] = with_(LINES, "months AS (SELECT DISTINCT strftime(fee_date, '%Y-%m') AS month, month(fee_date) AS m FROM lines)") + " UNION ALL ".join(
        f" SELECT month, '{column}' AS column_name, '{drift}' AS drift, {position} AS position FROM months WHERE m IN {months}"
        for months, drifts in cases for column, drift, position in drifts
    )
    q["landing_freshness"] = with_(LINES) + " SELECT count(DISTINCT year(fee_date)) AS files, true AS has_bytes, true AS recent, false AS stale FROM lines"
    q["changed_fees"] = incremental + """
SELECT fee_date, fee_id, 'added' AS change FROM recent WHERE fee_id NOT IN (SELECT fee_id FROM early)
UNION ALL
SELECT r.fee_date, r.fee_id, 'changed' FROM recent r JOIN early e ON e.fee_id = r.fee_id WHERE r.client_nino <> e.client_nino"""
    q["pii_masked"] = f"""{raw_stg}
SELECT fee_id, client_id, sha256(client_nino) AS client_nino, adviser_id, fee_date,
       CAST(fee_amount AS DOUBLE) AS fee_amount FROM stg"""
    q["pii_masked_keyed"] = f"""{raw_stg}
SELECT fee_id, client_id, {keyed_digest('client_nino', 'a secret for the tests alone')} AS client_nino, adviser_id, fee_date,
       CAST(fee_amount AS DOUBLE) AS fee_amount FROM stg"""
    patterns = {"nino": "^NI[0-9]+X?$", "md5": "^[0-9a-f]{32}$"}
    q["pii_scan"] = faulty_stg + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, '{p}' AS pattern, count(*) AS matching_rows FROM stg "
        f"WHERE regexp_matches({c}, '{r}')"
        for c in ("fee_id", "client_id", "client_nino", "adviser_id")
        for p, r in patterns.items()
    )
    found = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
        "nino": r"[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?\d{2} ?\d{2} ?\d{2} ?[A-D]",
    }
    q["pii_scan_documents"] = " UNION ALL ".join(
        f"SELECT 'text' AS column_name, '{p}' AS pattern, count(*) AS matching_rows FROM documents "
        f"WHERE regexp_matches(text, '{r}')"
        for p, r in found.items()
    )
    return q


ORACLE_SQL = _queries()
