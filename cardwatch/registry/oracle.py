"""The SQL twin of every query that has one, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from cardwatch.operators.blend import weight_trials
from cardwatch.operators.profile import AMOUNT_EDGES, AMOUNT_LABELS, TRUST_EDGES, TRUST_LABELS
from cardwatch.schema import BINARY, ENGINEERED, NUMERIC, RAW_COLUMNS, RAW_FEATURES, TIME_OF_DAY_ORDER, TIMES_OF_DAY
from cardwatch.schema import feature_names, one_hot_names
from cardwatch.sources.standin import EVENT_TYPES

FEATURES = feature_names(EVENT_TYPES)
SCORES = ["score_a", "score_b", "score_c"]

TX = """b AS (
  SELECT event_id AS transaction_id, round(value*3,2) AS amount, CAST(hour(ts) AS INT) AS transaction_hour,
    event_type AS merchant_category,
    CASE WHEN (event_id*7 + user_id) % 10 = 3 THEN 1 ELSE 0 END AS foreign_transaction,
    CASE WHEN (event_id*31 + user_id*3) % 13 = 0 THEN 1 ELSE 0 END AS location_mismatch,
    25 + CAST(regexp_extract(props,'[0-9]+',0) AS INT) % 75 AS device_trust_score,
    CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts
      RANGE BETWEEN INTERVAL '24' HOUR PRECEDING AND CURRENT ROW) - 1 AS INT) AS velocity_last_24h,
    CAST(18 + user_id % 52 AS INT) AS cardholder_age,
    CASE WHEN event_id % 5 = 4 THEN 'test' ELSE 'train' END AS split
  FROM events),
tx AS (
  SELECT *, CASE WHEN 2*foreign_transaction + 2*location_mismatch
      + CASE WHEN device_trust_score < 40 THEN 2 ELSE 0 END
      + CASE WHEN transaction_hour <= 5 THEN 1 ELSE 0 END
      + CASE WHEN velocity_last_24h >= 4 THEN 1 ELSE 0 END
      + CASE WHEN amount > 500 THEN 1 ELSE 0 END
      >= CASE WHEN transaction_id % 7 = 0 THEN 4 ELSE 6 END THEN 1 ELSE 0 END AS is_fraud
  FROM b),
train AS (SELECT * FROM tx WHERE split = 'train')"""

_TIME_OF_DAY = (
    "CASE WHEN transaction_hour BETWEEN 0 AND 5 THEN 'Night' WHEN transaction_hour BETWEEN 6 AND 11 THEN 'Morning' "
    "WHEN transaction_hour BETWEEN 12 AND 17 THEN 'Afternoon' ELSE 'Evening' END"
)
ENGINEERED_SQL = {
    "is_night_transaction": "CASE WHEN transaction_hour BETWEEN 0 AND 5 THEN 1 ELSE 0 END",
    "time_of_day_category": _TIME_OF_DAY,
    "amount_to_trust_ratio": "amount / (device_trust_score + CAST(0.000001 AS DOUBLE))",
    "amount_velocity_ratio": "amount / (velocity_last_24h + 1)",
    "is_high_risk_location": "CASE WHEN foreign_transaction = 1 OR location_mismatch = 1 THEN 1 ELSE 0 END",
    "location_anomaly_score": "foreign_transaction + location_mismatch",
    "is_high_amount": "CASE WHEN amount > 500 THEN 1 ELSE 0 END",
    "is_low_trust": "CASE WHEN device_trust_score < 40 THEN 1 ELSE 0 END",
}
_FE_COLUMNS = ", ".join(f"{sql} AS {name}" for name, sql in ENGINEERED_SQL.items())
_HOT = ", ".join(
    [f"CASE WHEN merchant_category = '{v}' THEN 1 ELSE 0 END AS merchant_category_{v}" for v in EVENT_TYPES]
    + [f"CASE WHEN time_of_day_category = '{v}' THEN 1 ELSE 0 END AS time_of_day_category_{v}" for v in TIMES_OF_DAY]
)
FE = f"{TX},\nfe AS (SELECT *, {_FE_COLUMNS} FROM tx),\nenc AS (SELECT *, {_HOT} FROM fe)"

SC = f"""{TX},
q AS (SELECT *,
    CASE WHEN device_trust_score<40 THEN 1 ELSE 0 END lt, CASE WHEN transaction_hour<=5 THEN 1 ELSE 0 END ng,
    CASE WHEN velocity_last_24h>=3 THEN 1 ELSE 0 END v3, CASE WHEN velocity_last_24h>=4 THEN 1 ELSE 0 END v4,
    CASE WHEN velocity_last_24h>=5 THEN 1 ELSE 0 END v5, CASE WHEN amount>200 THEN 1 ELSE 0 END a2,
    CASE WHEN amount>300 THEN 1 ELSE 0 END a3, CASE WHEN amount>500 THEN 1 ELSE 0 END a5 FROM tx),
sc AS (SELECT transaction_id, split, is_fraud,
    CAST(4*foreign_transaction+4*location_mismatch+5*lt+3*ng+2*v4+2*a5 AS DOUBLE)/CAST(20 AS DOUBLE) AS score_a,
    CAST(6*foreign_transaction+6*location_mismatch+4*lt+2*ng+v5+a3 AS DOUBLE)/CAST(20 AS DOUBLE) AS score_b,
    CAST(4*foreign_transaction+4*location_mismatch+3*lt+5*ng+2*v3+2*a2 AS DOUBLE)/CAST(20 AS DOUBLE) AS score_c
  FROM q),
oof AS (SELECT * FROM sc WHERE split = 'train'),
ls AS (
  SELECT transaction_id, split, is_fraud, 'score_a' AS model, score_a AS score FROM sc
  UNION ALL SELECT transaction_id, split, is_fraud, 'score_b', score_b FROM sc
  UNION ALL SELECT transaction_id, split, is_fraud, 'score_c', score_c FROM sc),
lo AS (SELECT * FROM ls WHERE split = 'train')"""

FOLD_SQL = (
    "CAST((row_number() OVER (PARTITION BY is_fraud ORDER BY "
    "md5(concat('42:', CAST(transaction_id AS VARCHAR))), transaction_id) - 1) % {k} AS INT)"
)


def r6(sql: str, name: str) -> str:
    """Rounded for comparison. A mean of cents can end exactly half-way at six digits, so means keep ten."""
    return f"round(CAST({sql} AS DOUBLE), {10 if name.endswith('mean') else 6}) AS {name}"


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _f1(tp: str, fp: str, fn: str) -> str:
    return f"CASE WHEN 2*{tp}+{fp}+{fn} = 0 THEN 0 ELSE 2.0*{tp}/(2*{tp}+{fp}+{fn}) END"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE CAST({a} AS DOUBLE)/({b}) END"


def _quality() -> dict[str, str]:
    raw = [*RAW_COLUMNS, "is_fraud"]
    types = {c: "int" for c in RAW_COLUMNS} | {"transaction_id": "bigint", "amount": "double", "merchant_category": "string"}
    hidden = "CASE WHEN split = 'test' THEN NULL ELSE is_fraud END"
    return {
        "q01_null_counts": f"WITH {TX} "
        + union(
            [
                f"SELECT split, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM tx GROUP BY split"
                for c in RAW_COLUMNS
            ]
        ),
        "q02_duplicate_rows": f"WITH {TX} SELECT split, CAST(sum(n-1) AS BIGINT) AS duplicate_rows FROM "
        f"(SELECT split, count(*) AS n FROM tx GROUP BY {', '.join(raw)}, split) GROUP BY split",
        "q03_duplicate_keys": f"WITH {TX} SELECT split, count(*) - count(DISTINCT transaction_id) AS duplicate_keys "
        "FROM tx GROUP BY split",
        "q04_id_overlap": f"WITH {TX} SELECT count(*) AS overlap FROM (SELECT transaction_id FROM tx WHERE split='train' "
        "INTERSECT SELECT transaction_id FROM tx WHERE split='test')",
        "q05_schema_match": f"WITH {TX} "
        + union(
            [
                f"SELECT '{c}' AS column_name, '{types[c]}' AS train_type, '{types[c]}' AS test_type, true AS types_match, "
                f"count({c}) FILTER (split='train') AS train_non_null, count({c}) FILTER (split='test') AS test_non_null FROM tx"
                for c in RAW_COLUMNS
            ]
        ),
        "q06_domain_check": f"WITH {TX} "
        + union(
            [
                f"SELECT split, '{c}' AS column_name, count(DISTINCT {c}) FILTER ({c} IN (0,1)) AS values_seen, "
                f"count(*) FILTER ({c} IS NULL OR {c} NOT IN (0,1)) AS outside, "
                f"list_sort(list(DISTINCT {c})) = [0,1] AS passed FROM tx GROUP BY split"
                for c in BINARY
            ]
        ),
        "q07_edge_counts": f"WITH {TX} "
        + union(
            [
                f"SELECT split, '{c}' AS column_name, count(*) FILTER ({c} = 0) AS zeros, "
                f"count(*) FILTER ({c} < 0) AS negatives FROM tx GROUP BY split"
                for c in NUMERIC
            ]
        ),
        "q08_shape": f"WITH {TX} SELECT split, count(*) AS n_rows, "
        "CAST(CASE WHEN split='train' THEN 10 ELSE 9 END AS BIGINT) AS n_columns FROM tx GROUP BY split",
        "q09_engineered_gate": f"WITH {FE} SELECT "
        f"CAST(sum(CASE WHEN split='train' THEN {' + '.join(f'CAST({c} IS NULL AS INT)' for c in FEATURES)} ELSE 0 END) AS BIGINT) AS train_nulls, "
        f"CAST(sum(CASE WHEN split='test' THEN {' + '.join(f'CAST({c} IS NULL AS INT)' for c in FEATURES)} ELSE 0 END) AS BIGINT) AS test_nulls, "
        "count(*) FILTER (split='train') AS train_rows, count(*) FILTER (split='test') AS test_rows, "
        "true AS label_in_train, false AS label_in_test, count(*) = (SELECT count(*) FROM events) AS rows_conserved, "
        "true AS passed FROM enc",
        "q10_preview": f"WITH {TX} SELECT {', '.join(raw)} FROM train ORDER BY transaction_id LIMIT 5",
        "q10_column_info": f"WITH {TX} "
        + union(
            [f"SELECT '{c}' AS column_name, '{(types | {'is_fraud': 'int'})[c]}' AS dtype, count({c}) AS non_null FROM train" for c in raw]
        ),
        "s01_derive_transactions": f"WITH {TX} SELECT {', '.join(RAW_COLUMNS)}, split, is_fraud FROM tx",
        "s01_read_transactions": f"WITH {TX} SELECT {', '.join(RAW_COLUMNS)}, split, {hidden} AS is_fraud FROM tx",
        "s02_read_engineered": f"WITH {FE} SELECT transaction_id, split, {', '.join(FEATURES)}, {hidden} AS is_fraud FROM enc",
        "s03_write_table": f"WITH {TX} SELECT split, count(*) AS n_rows, {r6('sum(amount)', 'amount_sum')}, "
        "CAST(sum(transaction_id) AS BIGINT) AS id_sum FROM tx GROUP BY split",
        "s04_id_sidecar": f"WITH {TX} SELECT transaction_id FROM tx WHERE split='test'",
        "s04_id_range": f"WITH {TX} SELECT min(transaction_id) AS min_id, max(transaction_id) AS max_id, count(*) AS n_ids "
        "FROM tx WHERE split='test'",
    }


def _describe(columns: list[str], table: str, keys: str = "", suffix: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return union(
        [
            f"SELECT {lead}'{c}' AS feature, count({c}) AS count, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'std')}, "
            f"{r6(f'min({c})', 'min')}, {r6(f'quantile_cont({c}, 0.25)', 'p25')}, {r6(f'quantile_cont({c}, 0.5)', 'p50')}, "
            f"{r6(f'quantile_cont({c}, 0.75)', 'p75')}, {r6(f'max({c})', 'max')} FROM {table} {suffix}"
            for c in columns
        ]
    )


def _pct_pair() -> str:
    return (
        f"{r6('100.0 * count(*) FILTER (is_fraud=0) / count(*)', 'legitimate_pct')}, "
        f"{r6('100.0 * count(*) FILTER (is_fraud=1) / count(*)', 'fraud_pct')}"
    )


def _bins(column: str, edges: list[int], labels: list[str]) -> str:
    cases = " ".join(
        f"WHEN {column} > {lo} AND {column} <= {hi} THEN '{label}'"
        for lo, hi, label in zip(edges, edges[1:], labels, strict=False)
    )
    return f"CASE {cases} END"


def _rate_by_bin(column: str, edges: list[int], labels: list[str], name: str) -> str:
    return (
        f"WITH {TX} SELECT {name}, {r6('100.0 * avg(is_fraud)', 'rate_pct')}, count(*) AS n FROM "
        f"(SELECT {_bins(column, edges, labels)} AS {name}, is_fraud FROM train) WHERE {name} IS NOT NULL GROUP BY {name}"
    )


def _corr(a: str, b: str) -> str:
    return (
        f"CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN NULL "
        f"ELSE covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END"
    )


CORRELATED = [*RAW_FEATURES, "is_fraud", *[f"merchant_category_{v}" for v in EVENT_TYPES]]


def _profile() -> dict[str, str]:
    fence = "WITH {tx}, fences AS ({f})"
    iqr_f = union(
        [f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM train" for c in NUMERIC]
    )
    long_train = union([f"SELECT '{c}' AS feature, is_fraud, CAST({c} AS DOUBLE) AS value FROM train" for c in NUMERIC])
    hist = union(
        [
            f"SELECT split AS grp, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, 40 AS bins FROM tx"
            for c in NUMERIC
        ]
    )
    hist_class = union(
        [
            f"SELECT is_fraud AS grp, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {n} AS bins FROM enc WHERE split='train'"
            for c, n in (
                ("device_trust_score", 30),
                ("amount", 50),
                ("amount_to_trust_ratio", 40),
                ("amount_velocity_ratio", 40),
            )
        ]
    )

    def histogram(cte: str, long: str, key: str) -> str:
        return (
            f"WITH {cte}, v AS ({long}), r AS (SELECT grp, feature, bins, min(value) AS low, max(value) AS high, "
            "count(*) AS total FROM v GROUP BY grp, feature, bins), "
            "p AS (SELECT v.grp, v.feature, CASE WHEN high = low THEN 0 ELSE "
            "least(CAST(floor((value-low)*r.bins/(high-low)) AS INT), r.bins-1) END AS bin FROM v JOIN r USING (grp, feature)), "
            "g AS (SELECT r.*, CAST(unnest(range(bins)) AS INT) AS bin FROM r), "
            "c AS (SELECT grp, feature, bin, count(*) AS n FROM p GROUP BY grp, feature, bin) "
            f"SELECT grp AS {key}, feature, bin, round(low + (high-low)/bins*bin, 6) AS left_edge, coalesce(n, 0) AS n, "
            "CASE WHEN high = low THEN NULL ELSE round(coalesce(n,0)/(total*((high-low)/bins)), 6) END AS density "
            "FROM g LEFT JOIN c USING (grp, feature, bin)"
        )

    drift = union(
        [
            f"SELECT '{c}' AS feature, "
            + ", ".join(
                r6(f"{fn} FILTER (split='{s}')", f"{s}_{n}")
                for n, fn in (("mean", f"avg({c})"), ("median", f"quantile_cont({c}, 0.5)"), ("std", f"stddev_samp({c})"))
                for s in ("train", "test")
            )
            + " FROM tx"
            for c in NUMERIC
        ]
    )
    target = union([f"SELECT '{c}' AS feature, {_corr(c, 'is_fraud')} AS r FROM enc WHERE split='train'" for c in FEATURES])
    original = [*RAW_FEATURES, "is_fraud"]
    engineered_types = {c: "int" for c in [*FEATURES, "is_fraud"]} | {
        c: "double" for c in ("amount", "amount_to_trust_ratio", "amount_velocity_ratio")
    }
    grid = lambda v: r6(f"100.0 * avg(is_fraud) FILTER (location_mismatch={v})", f"location_mismatch_{v}")
    return {
        "p01_describe": f"WITH {TX} {_describe([*RAW_FEATURES, 'is_fraud'], 'train')}",
        "p02_value_counts": f"WITH {TX} SELECT merchant_category, count(*) AS n FROM train GROUP BY 1",
        "p03_value_shares": f"WITH {TX} SELECT is_fraud, count(*) AS n, "
        f"{r6('count(*) / sum(count(*)) OVER ()', 'share')} FROM train GROUP BY 1",
        "p04_n_unique": f"WITH {TX} "
        + union([f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM train" for c in [*RAW_COLUMNS, "is_fraud"]]),
        "p04_unique_values": f"WITH {TX} SELECT DISTINCT merchant_category FROM train",
        "p05_class_balance": f"WITH {TX} SELECT n, n0, n1, round(100.0*n0/n, 6) AS pct0, round(100.0*n1/n, 6) AS pct1, "
        "CAST(n0 // n1 AS BIGINT) AS ratio, round(n1/n, 6) AS prevalence FROM (SELECT count(*) AS n, "
        "count(*) FILTER (is_fraud=0) AS n0, count(*) FILTER (is_fraud=1) AS n1 FROM train)",
        "p06_rate_by_category": f"WITH {TX} SELECT merchant_category, {r6('100.0*avg(is_fraud)', 'rate_pct')}, "
        "100.0*avg(is_fraud) > 1.51 AS above_baseline FROM train GROUP BY 1",
        "p07_rate_by_hour": f"WITH {TX} SELECT transaction_hour, {r6('100.0*avg(is_fraud)', 'rate_pct')}, count(*) AS n, "
        "CASE WHEN transaction_hour <= 5 THEN 1 ELSE 0 END AS is_night FROM train GROUP BY 1",
        "p08_crosstab_counts": f"WITH {TX} SELECT transaction_hour, count(*) FILTER (is_fraud=0) AS legitimate, "
        "count(*) FILTER (is_fraud=1) AS fraud FROM train GROUP BY 1",
        "p09_crosstab_row_pct": f"WITH {FE} "
        + union(
            [
                f"SELECT '{c}' AS flag, {c} AS flag_value, {_pct_pair()} FROM fe WHERE split='train' GROUP BY {c}"
                for c in [*BINARY, "is_high_risk_location", "is_high_amount", "is_low_trust"]
            ]
        ),
        "p10_crosstab2_margins": f"WITH {TX} SELECT CASE WHEN grouping(foreign_transaction)=1 THEN 'All' ELSE "
        "CAST(foreign_transaction AS VARCHAR) END AS foreign_transaction, CASE WHEN grouping(location_mismatch)=1 THEN 'All' "
        "ELSE CAST(location_mismatch AS VARCHAR) END AS location_mismatch, count(*) FILTER (is_fraud=0) AS legitimate, "
        'count(*) FILTER (is_fraud=1) AS fraud, count(*) AS "all" FROM train t '
        "GROUP BY GROUPING SETS ((t.foreign_transaction, t.location_mismatch), ())".replace(
            "grouping(foreign_transaction)", "grouping(t.foreign_transaction)"
        ).replace("grouping(location_mismatch)", "grouping(t.location_mismatch)"),
        "p11_crosstab2_row_pct": f"WITH {TX} SELECT foreign_transaction, location_mismatch, {_pct_pair()} FROM train GROUP BY 1, 2",
        "p12_interaction_grid": f"WITH {TX} SELECT foreign_transaction, {grid(0)}, {grid(1)} FROM train GROUP BY 1",
        "p13_rate_by_trust_bin": _rate_by_bin("device_trust_score", TRUST_EDGES, TRUST_LABELS, "trust_bin"),
        "p14_rate_by_amount_bin": _rate_by_bin("amount", AMOUNT_EDGES, AMOUNT_LABELS, "amount_bin"),
        "p15_rate_and_count_by_velocity": f"WITH {TX} SELECT velocity_last_24h, {r6('100.0*avg(is_fraud)', 'rate_pct')}, "
        "count(*) AS n FROM train GROUP BY 1",
        "p16_rate_by_location_score": f"WITH {FE} SELECT location_anomaly_score, {r6('100.0*avg(is_fraud)', 'rate_pct')}, "
        "count(*) AS n FROM fe WHERE split='train' GROUP BY 1",
        "p17_corr_matrix": f"WITH {FE}, s AS (SELECT "
        + ", ".join(
            f"{_corr(CORRELATED[i], CORRELATED[j])} AS c{i}_{j}" for i in range(len(CORRELATED)) for j in range(i)
        )
        + " FROM enc WHERE split='train') "
        + union(
            [
                f"SELECT '{CORRELATED[i]}' AS row_name, '{CORRELATED[j]}' AS column_name, round(c{i}_{j}, 6) AS correlation FROM s"
                for i in range(len(CORRELATED))
                for j in range(i)
            ]
        ),
        "p18_corr_with_target": f"WITH {FE}, t AS ({target}) SELECT feature, round(r, 6) AS correlation FROM t",
        "p18_top_correlations": f"WITH {FE}, t AS ({target}) SELECT feature, round(r, 6) AS correlation FROM t "
        "WHERE r IS NOT NULL ORDER BY round(abs(r), 9) DESC, feature LIMIT 5",
        "p19_iqr_outliers": fence.format(tx=TX, f=iqr_f)
        + f", v AS ({long_train}), w AS (SELECT *, q1-(q3-q1)*1.5 AS lower, q3+(q3-q1)*1.5 AS upper FROM fences) "
        "SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, round(upper, 6) AS upper, "
        "count(*) FILTER (value < lower OR value > upper) AS outliers, "
        "round(100.0*count(*) FILTER (value < lower OR value > upper)/count(*), 6) AS pct "
        "FROM v JOIN w USING (feature) GROUP BY feature, q1, q3, lower, upper",
        "p20_split_drift": f"WITH {TX} {drift}",
        "p21_feature_ranges": f"WITH {FE} "
        + union(
            [
                f"SELECT '{c}' AS feature, {r6(f'min({c})', 'min')}, {r6(f'max({c})', 'max')}, {r6(f'avg({c})', 'mean')}, "
                f"{r6(f'stddev_samp({c})', 'std')} FROM enc"
                for c in FEATURES
            ]
        ),
        "p22_grouped_feature_stats": f"WITH {FE} "
        + union(
            [
                f"SELECT '{c}' AS feature, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'std')} FROM fe WHERE split='train'"
                for c in ("amount_to_trust_ratio", "amount_velocity_ratio")
            ]
        ),
        "p23_histogram_by_split": histogram(TX, hist, "split"),
        "p23_histogram_by_class": histogram(FE, hist_class, "is_fraud"),
        "p24_box_summary": f"WITH {TX}, v AS ({long_train}), q AS (SELECT is_fraud, feature, quantile_cont(value, 0.25) AS p25, "
        "quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75 FROM v GROUP BY 1, 2), "
        "w AS (SELECT *, p25-(p75-p25)*1.5 AS lo, p75+(p75-p25)*1.5 AS hi FROM q) "
        "SELECT is_fraud, feature, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, "
        "round(min(value) FILTER (value BETWEEN lo AND hi), 6) AS whisker_low, "
        "round(max(value) FILTER (value BETWEEN lo AND hi), 6) AS whisker_high, "
        "count(*) FILTER (value < lo OR value > hi) AS fliers FROM v JOIN w USING (is_fraud, feature) "
        "GROUP BY is_fraud, feature, p25, p50, p75",
        "p25_minority_plus_sample": f"WITH {TX}, r AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY "
        "md5(concat('42:', CAST(transaction_id AS VARCHAR))), transaction_id) AS rn FROM train) "
        "SELECT transaction_id, amount, device_trust_score, transaction_hour, velocity_last_24h, is_fraud FROM r "
        "WHERE is_fraud = 1 OR rn <= 500",
        "p26_feature_catalog": f"WITH {FE} "
        + union(
            [
                f"SELECT '{c}' AS column_name, '{engineered_types[c]}' AS dtype, count(DISTINCT {c}) AS n_unique, "
                f"'{'Original' if c in original else 'Engineered'}' AS source FROM enc WHERE split='train'"
                for c in [*FEATURES, "is_fraud"]
            ]
        ),
        "p27_category_counts_ordered": f"WITH {FE} "
        + union(
            [
                f"SELECT {i} AS position, '{v}' AS time_of_day_category, nullif(count(*), 0) AS n FROM fe "
                f"WHERE split='train' AND time_of_day_category='{v}'"
                for i, v in enumerate(TIME_OF_DAY_ORDER)
            ]
        ),
    }


def _features() -> dict[str, str]:
    hidden = "CASE WHEN split = 'test' THEN NULL ELSE is_fraud END AS is_fraud"
    single = {
        f"f{i:02d}_{name}": f"WITH {FE} SELECT transaction_id, {name} FROM fe"
        for i, name in enumerate(ENGINEERED_SQL, start=1)
    }
    engineered = ", ".join(ENGINEERED_SQL)
    k = 5
    folded = f"folded AS (SELECT *, {FOLD_SQL.format(k=k)} AS fold FROM enc WHERE split='train')"
    scaler = union(
        [
            f"SELECT {i} AS fold, '{c}' AS feature, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_pop({c})', 'std')} "
            f"FROM folded WHERE fold <> {i}"
            for i in range(k)
            for c in NUMERIC
        ]
    )
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)
    z = ", ".join(f"round(({c}-m_{c})/s_{c}, 6) AS {c}" for c in NUMERIC)
    return single | {
        "f09_one_hot": f"WITH {FE} SELECT transaction_id, {', '.join(one_hot_names(EVENT_TYPES))} FROM enc",
        "f10_bool_to_int": f"WITH {FE} SELECT transaction_id, CAST(amount > 500 AS INT) AS dear, "
        "CAST(device_trust_score < 40 AS INT) AS distrusted FROM tx",
        "f11_combine": f"WITH {TX} SELECT {', '.join(RAW_COLUMNS)}, split, {hidden} FROM tx",
        "f12_split_back_train": f"WITH {FE} SELECT transaction_id, {', '.join(FEATURES)}, is_fraud FROM enc WHERE split='train'",
        "f12_split_back_test": f"WITH {FE} SELECT transaction_id, {', '.join(FEATURES)} FROM enc WHERE split='test'",
        "f13_engineer_features": f"WITH {FE} SELECT {', '.join(RAW_COLUMNS)}, split, {engineered} FROM fe",
        "f14_preprocess": f"WITH {FE} SELECT transaction_id, split, {', '.join(FEATURES)}, {hidden} FROM enc",
        "f15_standard_scale": f"WITH {TX}, m AS (SELECT {stats} FROM train) SELECT transaction_id, split, {z} "
        "FROM tx, m",
        "f15_fold_scaler": f"WITH {FE}, {folded} {scaler}",
        "f16_feature_matrix": f"WITH {FE} SELECT transaction_id, is_fraud, CAST({len(FEATURES)} AS INT) AS n_features, "
        f"round({' + '.join(f'CAST({c} AS DOUBLE)' for c in FEATURES)}, 6) AS feature_sum FROM enc WHERE split='train'",
    }


_COUNTS = (
    "count(*) FILTER (is_fraud=1 AND yhat=1) AS tp, count(*) FILTER (is_fraud=0 AND yhat=1) AS fp, "
    "count(*) FILTER (is_fraud=1 AND yhat=0) AS fn, count(*) FILTER (is_fraud=0 AND yhat=0) AS tn"
)
_METRICS = (
    f"round(CAST({_f1('tp', 'fp', 'fn')} AS DOUBLE), 6) AS f1, round({_ratio('tp', 'tp+fp')}, 6) AS precision, "
    f"round({_ratio('tp', 'tp+fn')}, 6) AS recall, round({_ratio('tp+tn', 'tp+fp+fn+tn')}, 6) AS accuracy"
)


def _curve(source: str, keys: str = "model") -> str:
    return (
        f"d AS (SELECT {keys}, score, count(*) FILTER (is_fraud=1) AS pos, count(*) FILTER (is_fraud=0) AS neg "
        f"FROM {source} GROUP BY {keys}, score), "
        f"c AS (SELECT *, sum(pos) OVER (PARTITION BY {keys} ORDER BY score DESC) AS tp, "
        f"sum(neg) OVER (PARTITION BY {keys} ORDER BY score DESC) AS fp, sum(pos) OVER (PARTITION BY {keys}) AS n_pos, "
        f"sum(neg) OVER (PARTITION BY {keys}) AS n_neg FROM d)"
    )


_SWEEP = f"""grid AS (SELECT CAST(0.01 AS DOUBLE) + CAST(i AS DOUBLE)*CAST(0.01 AS DOUBLE) AS threshold FROM range(99) t(i)),
sweep AS (SELECT model, threshold, count(*) FILTER (is_fraud=1 AND score>=threshold) AS tp,
    count(*) FILTER (is_fraud=0 AND score>=threshold) AS fp, count(*) FILTER (is_fraud=1 AND score<threshold) AS fn
  FROM lo, grid GROUP BY model, threshold),
swept AS (SELECT *, CAST({_f1('tp', 'fp', 'fn')} AS DOUBLE) AS f1, {_ratio('tp', 'tp+fp')} AS precision,
    {_ratio('tp', 'tp+fn')} AS recall FROM sweep),
best AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) AS rn FROM swept)"""

# The fixture's experiment log: every model and the blend, evaluated at three thresholds in turn.
LOG_THRESHOLDS = [0.3, 0.6, 0.5]
LOG_WEIGHTS = {"score_a": 0.5, "score_b": 0.3, "score_c": 0.2}
_BLEND = "(score_a*CAST(0.5 AS DOUBLE) + score_b*CAST(0.3 AS DOUBLE) + score_c*CAST(0.2 AS DOUBLE)) / CAST(1.0 AS DOUBLE)"
_LOG = f"""lm AS (SELECT is_fraud, model, score FROM lo
  UNION ALL SELECT is_fraud, 'Ensemble_SoftVoting', {_BLEND} FROM oof),
{_curve('lm')},
ap AS (SELECT model, coalesce(sum(pos * tp / (tp+fp)) / nullif(max(n_pos), 0), 0) AS ap FROM c GROUP BY model),
runs AS (SELECT * FROM (VALUES {', '.join(f'({i}, CAST({t} AS DOUBLE))' for i, t in enumerate(LOG_THRESHOLDS))}) r(run, t)),
rc AS (SELECT model, run, count(*) FILTER (is_fraud=1 AND score>=t) AS tp, count(*) FILTER (is_fraud=0 AND score>=t) AS fp,
    count(*) FILTER (is_fraud=1 AND score<t) AS fn, count(*) FILTER (is_fraud=0 AND score<t) AS tn FROM lm, runs GROUP BY model, run),
results AS (SELECT CAST(run AS BIGINT) AS run_seq, model AS Model_Name, round({_ratio('tp+tn', 'tp+fp+fn+tn')}, 4) AS CV_Accuracy,
    round(CAST({_f1('tp', 'fp', 'fn')} AS DOUBLE), 4) AS CV_F1_Score, round(ap, 4) AS CV_PR_AUC,
    round({_ratio('tp', 'tp+fp')}, 4) AS CV_Precision, round({_ratio('tp', 'tp+fn')}, 4) AS CV_Recall
  FROM rc JOIN ap USING (model)),
latest AS (SELECT * FROM results WHERE run_seq = 2)"""


def _evaluate() -> dict[str, str]:
    at_half = "h AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS yhat FROM lo)"
    report = (
        "SELECT model, 'Legitimate' AS row_name, lp AS precision, lr AS recall, lf AS f1, tn+fp AS support FROM m "
        "UNION ALL SELECT model, 'Fraud', fp_, fr, ff, tp+fn FROM m "
        "UNION ALL SELECT model, 'accuracy', acc, acc, acc, tp+fp+fn+tn FROM m "
        "UNION ALL SELECT model, 'macro avg', (lp+fp_)/2, (lr+fr)/2, (lf+ff)/2, tp+fp+fn+tn FROM m "
        "UNION ALL SELECT model, 'weighted avg', (lp*(tn+fp)+fp_*(tp+fn))/(tp+fp+fn+tn), (lr*(tn+fp)+fr*(tp+fn))/(tp+fp+fn+tn), "
        "(lf*(tn+fp)+ff*(tp+fn))/(tp+fp+fn+tn), tp+fp+fn+tn FROM m"
    )
    checks = [
        ("Shape match", "(SELECT count(*) FROM sub) = (SELECT count(*) FROM smp)"),
        ("Column names", "true"),
        (
            "Transaction IDs match",
            "(SELECT count(*) FROM (SELECT transaction_id FROM sub) s FULL JOIN (SELECT transaction_id FROM smp) p "
            "USING (transaction_id) WHERE s.transaction_id IS NULL OR p.transaction_id IS NULL) = 0",
        ),
        ("is_fraud binary (0/1)", "(SELECT count(*) FROM sub WHERE is_fraud NOT IN (0,1) OR is_fraud IS NULL) = 0"),
        ("No null values", "(SELECT count(*) FROM sub WHERE is_fraud IS NULL OR transaction_id IS NULL) = 0"),
        ("is_fraud is integer", "true"),
        ("Reasonable fraud %", "(SELECT avg(is_fraud) > 0.005 AND avg(is_fraud) < 0.10 FROM sub)"),
    ]
    summary = union(
        [
            f"SELECT model, CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (score>={t}) AS n_fraud, count(*) AS total, "
            f"round(100.0*count(*) FILTER (score>={t})/count(*), 6) AS fraud_pct FROM ls WHERE split='test' GROUP BY model"
            for t in (0.5, 0.3)
        ]
    )
    named = union(
        [
            f"SELECT model, '{n}' AS strategy, CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (is_fraud=1 AND score>={t}) AS tp, "
            f"count(*) FILTER (is_fraud=0 AND score>={t}) AS fp, count(*) FILTER (is_fraud=1 AND score<{t}) AS fn FROM lo GROUP BY model"
            for n, t in (("Standard (0.5)", 0.5), ("Aggressive (0.3)", 0.3))
        ]
    )
    by_fold = (
        f"WITH {SC}, fl AS (SELECT transaction_id, {FOLD_SQL.format(k=5)} AS fold FROM oof), "
        "lf AS (SELECT lo.*, fold FROM lo JOIN fl USING (transaction_id))"
    )
    return {
        "e01_threshold_predict": f"WITH {SC} SELECT transaction_id, CASE WHEN score_a >= 0.5 THEN 1 ELSE 0 END AS at_least, "
        "CASE WHEN score_a > 0.5 THEN 1 ELSE 0 END AS above FROM sc",
        "e02_confusion_matrix": f"WITH {SC}, {at_half}, m AS (SELECT model, {_COUNTS} FROM h GROUP BY model) "
        "SELECT model, 0 AS actual, 0 AS predicted, tn AS n FROM m UNION ALL SELECT model, 0, 1, fp FROM m "
        "UNION ALL SELECT model, 1, 0, fn FROM m UNION ALL SELECT model, 1, 1, tp FROM m",
        "e03_pooled_metrics": f"WITH {SC}, {at_half}, m AS (SELECT model, {_COUNTS} FROM h GROUP BY model) SELECT model, {_METRICS} FROM m",
        "e04_classification_report": f"WITH {SC}, {at_half}, k AS (SELECT model, {_COUNTS} FROM h GROUP BY model), "
        f"m AS (SELECT *, {_ratio('tn', 'tn+fn')} AS lp, {_ratio('tn', 'tn+fp')} AS lr, CAST({_f1('tn', 'fn', 'fp')} AS DOUBLE) AS lf, "
        f"{_ratio('tp', 'tp+fp')} AS fp_, {_ratio('tp', 'tp+fn')} AS fr, CAST({_f1('tp', 'fp', 'fn')} AS DOUBLE) AS ff, "
        f"{_ratio('tp+tn', 'tp+fp+fn+tn')} AS acc FROM k) SELECT model, row_name, round(precision, 6) AS precision, "
        f"round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM ({report})",
        "e05_roc_points": f"WITH {SC}, {_curve('lo')} SELECT model, round({_ratio('fp', 'n_neg')}, 6) AS fpr, "
        f"round({_ratio('tp', 'n_pos')}, 6) AS tpr, round(score, 6) AS threshold FROM c "
        "UNION ALL SELECT DISTINCT model, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST('inf' AS DOUBLE) FROM lo",
        "e05_roc_corners": f"WITH {SC}, {_curve('lo')}, n AS (SELECT *, lead(pos) OVER w AS np, lead(neg) OVER w AS nn, "
        "row_number() OVER w AS i FROM c WINDOW w AS (PARTITION BY model ORDER BY score DESC)) "
        f"SELECT model, round({_ratio('fp', 'n_neg')}, 6) AS fpr, round({_ratio('tp', 'n_pos')}, 6) AS tpr, "
        "round(score, 6) AS threshold FROM n WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg "
        "UNION ALL SELECT DISTINCT model, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST('inf' AS DOUBLE) FROM lo",
        "e06_roc_auc": f"WITH {SC}, {_curve('lo')} SELECT model, round(sum(neg*(tp-pos/2.0))/(max(n_pos)*max(n_neg)), 6) AS roc_auc "
        "FROM c GROUP BY model",
        "e07_pr_points": f"WITH {SC}, {_curve('lo')} SELECT model, round({_ratio('tp', 'tp+fp')}, 6) AS precision, "
        f"round({_ratio('tp', 'n_pos')}, 6) AS recall, round(score, 6) AS threshold FROM c "
        "UNION ALL SELECT DISTINCT model, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE) FROM lo",
        "e08_average_precision": f"WITH {SC}, {_curve('lo')} SELECT model, "
        "round(coalesce(sum(pos*tp/(tp+fp))/nullif(max(n_pos), 0), 0), 6) AS average_precision FROM c GROUP BY model",
        "e09_prevalence_baseline": f"WITH {TX} SELECT split, {r6('avg(is_fraud)', 'prevalence')} FROM tx GROUP BY split",
        "e10_threshold_sweep": f"WITH {SC}, {_SWEEP} SELECT model, round(threshold, 6) AS threshold, tp, fp, fn, "
        "round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall FROM swept",
        "e11_best_threshold": f"WITH {SC}, {_SWEEP} SELECT model, round(CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END, 6) AS best_threshold, "
        "round(f1, 6) AS best_f1 FROM best WHERE rn = 1",
        "e12_threshold_at": f"WITH {SC}, {_SWEEP}, tg AS (SELECT CAST(0.5 AS DOUBLE) AS target UNION ALL SELECT CAST(0.3 AS DOUBLE)), "
        "n AS (SELECT *, row_number() OVER (PARTITION BY model, target ORDER BY abs(threshold-target), threshold) AS near FROM swept, tg) "
        "SELECT model, target, round(threshold, 6) AS threshold, round(f1, 6) AS f1, round(precision, 6) AS precision, "
        "round(recall, 6) AS recall FROM n WHERE near = 1",
        "e13_strategy_table": f"WITH {SC}, {_SWEEP}, s AS ({named} UNION ALL SELECT model, 'Optimal', threshold, tp, fp, fn FROM best WHERE rn=1) "
        f"SELECT model, strategy, round(threshold, 6) AS threshold, round(CAST({_f1('tp', 'fp', 'fn')} AS DOUBLE), 6) AS f1, "
        f"round({_ratio('tp', 'tp+fp')}, 6) AS precision, round({_ratio('tp', 'tp+fn')}, 6) AS recall, fp, fn FROM s",
        "e14_prediction_summary": f"WITH {SC} {summary}",
        "e15_submission": f"WITH {SC} SELECT transaction_id, CASE WHEN {_BLEND} >= 0.5 THEN 1 ELSE 0 END AS is_fraud FROM sc WHERE split='test'",
        "e15_submission_aggressive": f"WITH {SC} SELECT transaction_id, CASE WHEN {_BLEND} >= 0.3 THEN 1 ELSE 0 END AS is_fraud "
        "FROM sc WHERE split='test'",
        "e16_validate_submission": f"WITH {SC}, sub AS (SELECT transaction_id, CASE WHEN {_BLEND} >= 0.5 THEN 1 ELSE 0 END AS is_fraud "
        "FROM sc WHERE split='test'), smp AS (SELECT transaction_id, 0 AS is_fraud FROM tx WHERE split='test') "
        + union([f"SELECT '{n}' AS check_name, {sql} AS passed" for n, sql in checks]),
        "m04_fold_metrics": f"{by_fold}, h AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS yhat FROM lf), "
        f"m AS (SELECT model, fold, {_COUNTS} FROM h GROUP BY model, fold), {_curve('lf', 'model, fold')}, "
        "ap AS (SELECT model, fold, coalesce(sum(pos*tp/(tp+fp))/nullif(max(n_pos), 0), 0) AS ap FROM c GROUP BY model, fold), "
        f"pf AS (SELECT model, fold, ap, CAST({_f1('tp', 'fp', 'fn')} AS DOUBLE) AS f1, {_ratio('tp', 'tp+fp')} AS precision, "
        f"{_ratio('tp', 'tp+fn')} AS recall, {_ratio('tp+tn', 'tp+fp+fn+tn')} AS accuracy FROM m JOIN ap USING (model, fold)) "
        "SELECT model, round(avg(f1), 9) AS mean_f1, round(avg(precision), 9) AS mean_precision, round(avg(recall), 9) AS mean_recall, "
        "round(avg(accuracy), 9) AS mean_accuracy, round(avg(ap), 9) AS mean_average_precision FROM pf GROUP BY model",
    }


TRIALS = weight_trials(100, 3)


def _models() -> dict[str, str]:
    total_sql = [sum(w) for w in TRIALS]
    trial_rows = ", ".join(
        f"({i}, CAST({w[0]!r} AS DOUBLE), CAST({w[1]!r} AS DOUBLE), CAST({w[2]!r} AS DOUBLE), CAST({t!r} AS DOUBLE))"
        for i, (w, t) in enumerate(zip(TRIALS, total_sql, strict=True))
    )
    search = (
        f"trials AS (SELECT * FROM (VALUES {trial_rows}) v(trial, wa, wb, wc, total)), "
        "bl AS (SELECT trial, is_fraud, CASE WHEN (score_a*wa + score_b*wb + score_c*wc)/total >= 0.5 THEN 1 ELSE 0 END AS yhat "
        f"FROM oof, trials), tc AS (SELECT trial, {_COUNTS} FROM bl GROUP BY trial), "
        f"ts AS (SELECT trial, wa/total AS w_score_a, wb/total AS w_score_b, wc/total AS w_score_c, "
        f"CAST({_f1('tp', 'fp', 'fn')} AS DOUBLE) AS f1 FROM tc JOIN trials USING (trial))"
    )
    rounded = ", ".join(f"round(w_{m}, 6) AS w_{m}" for m in SCORES)
    consensus = union(
        [
            f"SELECT '{m}' AS model, '{c}' AS feature, abs({_corr(f'e.{c}', f's.{m}')}) AS importance "
            "FROM enc e JOIN sc s USING (transaction_id) WHERE e.split='train'"
            for m in SCORES
            for c in RAW_FEATURES
        ]
    )
    fe_in_sc = SC + ",\nfe AS (SELECT *, " + _FE_COLUMNS + " FROM tx),\nenc AS (SELECT *, " + _HOT + " FROM fe)"
    final = (
        f"WITH {SC}, fs AS (SELECT (SELECT {_f1s('oof', _BLEND)}) AS cand, (SELECT {_f1s('oof', 'score_a')}) AS inc) "
        f"SELECT transaction_id, CASE WHEN cand > inc THEN CASE WHEN {_BLEND} >= 0.5 THEN 1 ELSE 0 END "
        "ELSE CASE WHEN score_a >= 0.5 THEN 1 ELSE 0 END END AS is_fraud FROM sc, fs WHERE split='test'"
    )
    return {
        "m01_pos_weight": f"WITH {TX} SELECT round(count(*) FILTER (is_fraud=0) / count(*) FILTER (is_fraud=1), 6) AS pos_weight FROM train",
        "m02_balanced_weights": f"WITH {TX}, c AS (SELECT count(*) AS n, count(*) FILTER (is_fraud=1) AS n1 FROM train) "
        "SELECT transaction_id, round(CASE WHEN is_fraud=1 THEN n/(2*n1) ELSE n/(2*(n-n1)) END, 6) AS weight FROM train, c",
        "m03_stratified_folds": f"WITH {TX} SELECT transaction_id, is_fraud, {FOLD_SQL.format(k=5)} AS fold FROM train",
        "m08_weighted_blend": f"WITH {SC} SELECT transaction_id, round({_BLEND}, 6) AS blend FROM sc",
        "m09_search_weights": f"WITH {SC}, {search} SELECT trial, {rounded}, round(f1, 6) AS f1 FROM ts",
        "m09_best_weights": f"WITH {SC}, {search} SELECT trial, {rounded}, round(f1, 6) AS f1 FROM ts ORDER BY ts.f1 DESC, trial LIMIT 1",
        "m10_soft_vote": f"WITH {SC} SELECT transaction_id, round({_BLEND}, 6) AS vote_score, "
        f"CASE WHEN {_BLEND} > 0.5 THEN 1 ELSE 0 END AS prediction FROM sc WHERE split='test'",
        "m12_pick_top_models": f"WITH {SC}, {_LOG} SELECT Model_Name, CV_F1_Score FROM latest WHERE Model_Name <> 'Ensemble_SoftVoting' "
        "ORDER BY CV_F1_Score DESC, Model_Name LIMIT 2",
        "m13_leaderboard": f"WITH {SC}, {_LOG} SELECT CAST(row_number() OVER (ORDER BY CV_F1_Score DESC, Model_Name) AS INT) AS Rank, "
        "Model_Name, CV_F1_Score, CV_Precision, CV_Recall, CV_PR_AUC, CV_Accuracy FROM latest",
        "m14_select_final": final,
        "m16_importance_consensus": f"WITH {fe_in_sc}, imp AS ({consensus}), sh AS (SELECT model, feature, "
        "importance / sum(importance) OVER (PARTITION BY model) AS share FROM imp) "
        "SELECT feature, round(avg(share), 6) AS mean_importance FROM sh GROUP BY feature",
        "s05_append_result": f"WITH {SC}, {_LOG} SELECT run_seq, Model_Name, CV_Accuracy, CV_F1_Score, CV_PR_AUC, CV_Precision, CV_Recall FROM results",
    }


def _f1s(table: str, score: str) -> str:
    tp = f"count(*) FILTER (is_fraud=1 AND {score} >= 0.5)"
    wrong = f"count(*) FILTER ((is_fraud=1) <> ({score} >= 0.5))"
    return f"CASE WHEN 2*{tp}+{wrong} = 0 THEN 0 ELSE 2.0*{tp}/(2*{tp}+{wrong}) END FROM {table}"


def _neighbors() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in RAW_FEATURES)
    z = ", ".join(f"CASE WHEN s_{c} = 0 THEN {c}-m_{c} ELSE ({c}-m_{c})/s_{c} END AS {c}" for c in RAW_FEATURES)
    d2 = " + ".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in RAW_FEATURES)
    return (
        f"{TX}, m AS (SELECT {stats} FROM train), z AS (SELECT transaction_id, split, is_fraud, {z} FROM tx, m), "
        f"pairs AS (SELECT a.transaction_id, b.transaction_id AS neighbor_id, b.is_fraud, round({d2}, 9) AS d2 "
        "FROM z a, z b WHERE a.split='test' AND b.split='train'), "
        "near AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY transaction_id ORDER BY d2, neighbor_id) AS INT) AS neighbor_rank "
        "FROM pairs) WHERE neighbor_rank <= 5)"
    )


def _learners() -> dict[str, str]:
    per_class = ", ".join(
        f"avg({c}) FILTER (is_fraud={k}) AS m{k}_{c}, var_pop({c}) FILTER (is_fraud={k}) AS v{k}_{c}"
        for k in (0, 1)
        for c in RAW_FEATURES
    )
    widest = ", ".join(f"var_pop({c})" for c in RAW_FEATURES)

    def density(k: int) -> str:
        return " + ".join(
            f"(-0.5*ln(2*pi()*(v{k}_{c}+extra)) - 0.5*({c}-m{k}_{c})*({c}-m{k}_{c})/(v{k}_{c}+extra))" for c in RAW_FEATURES
        )

    odds = f"greatest(least({density(1)} + ln(n1/n0) - ({density(0)}), 700), -700)"
    return {
        "m29_knn_join": f"WITH {_neighbors()} SELECT transaction_id, neighbor_rank, neighbor_id, round(d2, 6) AS d2 FROM near",
        "m29_knn_vote": f"WITH {_neighbors()} SELECT transaction_id, round(avg(is_fraud), 6) AS uniform_score, "
        "round(CASE WHEN count(*) FILTER (d2=0) > 0 THEN avg(is_fraud) FILTER (d2=0) ELSE "
        "sum(CASE WHEN d2 > 0 THEN is_fraud/sqrt(d2) ELSE 0 END)/sum(CASE WHEN d2 > 0 THEN 1/sqrt(d2) ELSE 0 END) END, 6) "
        "AS distance_score FROM near GROUP BY transaction_id",
        "m30_gaussian_nb": f"WITH {TX}, st AS (SELECT count(*) FILTER (is_fraud=0) AS n0, count(*) FILTER (is_fraud=1) AS n1, "
        f"CAST(0.000000001 AS DOUBLE)*greatest({widest}) AS extra, {per_class} FROM train) "
        f"SELECT transaction_id, round(1/(1+exp(-({odds}))), 6) AS score FROM tx, st WHERE split='test'",
    }


def _boosted_fits() -> dict[str, str]:
    """Boosters over two flags, or one with missing values: few cells, in which all rows have one score."""
    pair = "foreign_transaction, location_mismatch"
    p = "(1/(1+exp(-s)))"
    cells = f"c AS (SELECT {pair}, count(*) AS n, sum(is_fraud) AS pos FROM train GROUP BY ALL)"
    odds = "z AS (SELECT sum(pos)::DOUBLE AS n1, sum(n-pos)::DOUBLE AS n0 FROM c)"

    def steps(rate: float, penalty: float, w0: str, w1: str, start: str) -> str:
        gradient, hessian = f"({w1}*pos*(1-{p}) - {w0}*(n-pos)*{p})", f"(({w1}*pos + {w0}*(n-pos))*{p}*(1-{p}))"
        step = f"s + {rate}::DOUBLE*{gradient}/({hessian}+{penalty}) AS s"
        kept = f"{pair}, n, pos, n0, n1"
        return f"{cells}, {odds}, r0 AS (SELECT {kept}, {start} AS s FROM c, z), r1 AS (SELECT {kept}, {step} FROM r0), r2 AS (SELECT {kept}, {step} FROM r1)"

    def missing(k: int) -> str:
        side = lambda what: "(" + " + ".join(f"sum({{0}}) FILTER ({w})" for w in what) + ")"
        score = lambda what: f"power({side(what).format('g')}, 2)/({side(what).format('h')}+1)"
        low, high, none = "v = 0", "v = 1", "v IS NULL"
        return (
            f"g{k} AS (SELECT v, n, pos, n0, n1, s, n0/n1*pos*({p}-1) + (n-pos)*{p} AS g, (n0/n1*pos + n-pos)*{p}*(1-{p}) AS h FROM r{k}), "
            f"d{k} AS (SELECT {score([low, none])} + {score([high])} >= {score([low])} + {score([high, none])} AS with_low FROM g{k}), "
            f"r{k + 1} AS (SELECT v, n, pos, n0, n1, s - 0.3::DOUBLE*sum(g) OVER w/(sum(h) OVER w + 1) AS s FROM g{k}, d{k} "
            "WINDOW w AS (PARTITION BY coalesce(v, CASE WHEN with_low THEN 0 ELSE 1 END)))"
        )

    def stump(k: int) -> str:
        flags = pair.split(", ")
        sides = union(
            [f"SELECT {i} AS place, {f} AS side, sum(wp) AS pos, sum(wn) AS neg FROM w{k} GROUP BY {f}" for i, f in enumerate(flags)]
        )
        return (
            f"s{k} AS ({sides}), b{k} AS (SELECT place FROM s{k} GROUP BY place ORDER BY sum(2*pos*neg/(pos+neg)), place LIMIT 1), "
            f"v{k} AS (SELECT place, side, CASE WHEN pos > neg THEN 1 ELSE -1 END AS vote, least(pos, neg) AS wrong, pos+neg AS whole "
            f"FROM s{k} JOIN b{k} USING (place)), e{k} AS (SELECT ln((sum(whole)-sum(wrong))/sum(wrong)) AS say FROM v{k}), "
            f"w{k + 1} AS (SELECT {pair}, wp*CASE WHEN vote < 0 THEN exp(say) ELSE 1 END AS wp, wn*CASE WHEN vote > 0 THEN exp(say) ELSE 1 END AS wn, "
            f"d + say*vote AS d, says + say AS says FROM w{k}, v{k}, e{k} "
            f"WHERE side = CASE WHEN place = 0 THEN {flags[0]} ELSE {flags[1]} END)"
        )

    final = f"SELECT {pair}, round({p}, 6) AS score FROM r2"
    return {
        "m27_two_rounds": f"WITH {TX}, {steps(0.3, 0, '1', '1', 'ln(n1/n0)')} {final}",
        "m25_symmetric_trees": f"WITH {TX}, {steps(0.5, 3, '(n0+n1)/(2*n0)', '(n0+n1)/(2*n1)', '0::DOUBLE')} {final}",
        "m23_missing_side": f"WITH {TX}, c AS (SELECT CASE WHEN transaction_id % 4 <> 0 THEN foreign_transaction END AS v, count(*) AS n, "
        f"sum(is_fraud) AS pos FROM train GROUP BY ALL), {odds}, r0 AS (SELECT *, 0::DOUBLE AS s FROM c, z), {missing(0)}, {missing(1)} "
        f"SELECT v AS known_foreign, round({p}, 6) AS score FROM r2",
        "m26_three_rounds": f"WITH {TX}, {cells}, w0 AS (SELECT {pair}, pos::DOUBLE AS wp, (n-pos)::DOUBLE AS wn, 0::DOUBLE AS d, 0::DOUBLE AS says FROM c), "
        f"{stump(0)}, {stump(1)}, {stump(2)} SELECT {pair}, round(1/(1+exp(-d/says)), 6) AS score FROM w3",
    }


def _exact_fits() -> dict[str, str]:
    weighted = (
        "count(*) FILTER (is_fraud=1)*(n/(2.0*n1)) / (count(*) FILTER (is_fraud=1)*(n/(2.0*n1)) + "
        "count(*) FILTER (is_fraud=0)*(n/(2.0*n0)))"
    )
    sizes = "z AS (SELECT count(*) AS n, count(*) FILTER (is_fraud=0) AS n0, count(*) FILTER (is_fraud=1) AS n1 FROM train)"
    models = ["LogisticRegression", "RandomForest", "AdaBoost", "GradientBoosting", "SVC", "KNN", "GaussianNB", "MLPClassifier"]
    # The stump takes the feature whose sides leave the least impurity; each side votes for its larger class.
    sides = union(
        [
            f"SELECT '{f}' AS feature, {k} AS place, {f} AS side, count(*) FILTER (is_fraud=1) AS pos, "
            f"count(*) FILTER (is_fraud=0) AS neg FROM train GROUP BY {f}"
            for k, f in enumerate(["location_mismatch", "foreign_transaction"])
        ]
    )
    return {
        "m05_oof_coverage": f"WITH {TX}, f AS (SELECT is_fraud, {FOLD_SQL.format(k=5)} AS fold FROM train) SELECT fold, "
        "count(*) AS n_rows, count(*) FILTER (is_fraud=1) AS n_pos, count(*) AS n_probabilities, count(*) AS n_consistent "
        "FROM f GROUP BY fold",
        "m20_category_rate": f"WITH {TX}, {sizes} SELECT merchant_category AS category, "
        f"round(CAST({weighted} AS DOUBLE), 3) AS score FROM train, z GROUP BY merchant_category, n, n0, n1",
        "m22_single_split": f"WITH {TX}, {sizes} SELECT foreign_transaction, round(CAST({weighted} AS DOUBLE), 6) AS score "
        "FROM train, z GROUP BY foreign_transaction, n, n0, n1",
        "m26_single_stump": f"WITH {TX}, d AS ({sides}), g AS (SELECT feature, place, "
        "sum(2.0*pos*neg/(pos+neg)) AS impurity FROM d GROUP BY ALL), "
        "best AS (SELECT feature FROM g ORDER BY impurity, place LIMIT 1), "
        "w AS (SELECT side, pos, neg, CASE WHEN pos > neg THEN 1 ELSE -1 END AS vote, least(pos, neg) AS wrong "
        "FROM d JOIN best USING (feature)), "
        "s AS (SELECT foreign_transaction, max(CASE WHEN (SELECT feature FROM best) = 'foreign_transaction' THEN w.vote ELSE v.vote END) "
        "AS vote FROM train JOIN w ON w.side = foreign_transaction JOIN w v ON v.side = location_mismatch GROUP BY 1) "
        "SELECT foreign_transaction, round(1/(1+exp(-CAST(vote AS DOUBLE))), 6) AS score FROM s",
        "m27_single_round": f"WITH {TX} SELECT foreign_transaction, "
        "round(1/(1+exp(-2*avg(2*is_fraud-1))), 6) AS score FROM train GROUP BY foreign_transaction",
        "s06_round_trip": f"WITH {TX}, m(model) AS (VALUES {', '.join(f'({m!r})' for m in models)}) "
        "SELECT model, count(*) AS n_rows, CAST(0 AS DOUBLE) AS largest_difference FROM tx, m WHERE split='test' GROUP BY model",
        "x05_stream_equals_batch": f"WITH {TX} SELECT count(*) AS n_rows, CAST(0 AS DOUBLE) AS largest_difference "
        "FROM tx WHERE split='test'",
    }


def _inputs() -> dict[str, str]:
    """Model inputs by position."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in RAW_FEATURES)
    scaled = union(
        [
            f"SELECT transaction_id, {k} AS position, round(CASE WHEN s_{c} = 0 THEN 0 ELSE ({c}-m_{c})/s_{c} END, 6)::DOUBLE AS value FROM tx, m WHERE split='test'"
            for k, c in enumerate(RAW_FEATURES)
        ]
    )
    plain = union(
        [f"SELECT transaction_id, {k} AS position, round({c}, 6)::DOUBLE AS value FROM enc WHERE split='train'" for k, c in enumerate(FEATURES)]
    )
    return {
        "f15_population_scaler": f"WITH {TX}, m AS (SELECT {stats} FROM train) {scaled}",
        "f16_matrix_positions": f"WITH {FE} {plain}",
    }


def _resampling() -> dict[str, str]:
    """Undersampling, SMOTE, ADASYN, rules over two flags, other scalers."""
    d2 = " + ".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in RAW_FEATURES)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in RAW_FEATURES)
    z = ", ".join(f"CASE WHEN s_{c} = 0 THEN {c}-m_{c} ELSE ({c}-m_{c})/s_{c} END AS {c}" for c in RAW_FEATURES)
    bits = lambda what: f"('0x' || substr(md5('42:{what}:' || transaction_id::VARCHAR || ':' || copy::VARCHAR), 1, 8))::BIGINT"
    order = "md5(concat('42:', CAST(transaction_id AS VARCHAR))), transaction_id"
    near = lambda name, those: (
        f"{name} AS (SELECT * FROM (SELECT a.transaction_id, b.transaction_id AS neighbor_id, b.is_fraud, row_number() OVER "
        f"(PARTITION BY a.transaction_id ORDER BY round({d2}, 9), b.transaction_id) AS rank FROM z a, z b "
        f"WHERE a.is_fraud = 1 AND a.transaction_id <> b.transaction_id AND {those}) WHERE rank <= 5)"
    )
    between = ", ".join(f"round(a.{c} + gap*(b.{c}-a.{c}), 6)::DOUBLE AS {c}" for c in RAW_FEATURES)
    base = (
        f"{TX}, m AS (SELECT {stats} FROM train), z AS (SELECT transaction_id, is_fraud, {z} FROM train, m), "
        f"{near('few', 'b.is_fraud = 1')}, s AS (SELECT transaction_id, count(*) AS n_near FROM few GROUP BY 1), "
        "c AS (SELECT count(*) FILTER (is_fraud=1) AS n1, count(*) FILTER (is_fraud=0) AS n0 FROM train)"
    )
    made = (
        "d AS (SELECT transaction_id, unnest(range(1, copies + 1))::INTEGER AS copy FROM k), "
        f"p AS (SELECT transaction_id, copy, {bits('neighbour')} % n_near + 1 AS rank, {bits('gap')} / 4294967296::DOUBLE AS gap FROM d JOIN s USING (transaction_id)) "
        f"SELECT p.transaction_id, copy, neighbor_id, round(gap, 6) AS gap, {between} FROM p JOIN few USING (transaction_id, rank) "
        "JOIN train a ON a.transaction_id = p.transaction_id JOIN train b ON b.transaction_id = neighbor_id"
    )
    even = (
        f"k AS (SELECT transaction_id, (n0-n1)//n1 + CASE WHEN row_number() OVER (ORDER BY {order}) <= (n0-n1)%n1 THEN 1 ELSE 0 END AS copies "
        "FROM train, c WHERE is_fraud=1)"
    )
    dense = (
        f"{near('around', 'true')}, r AS (SELECT transaction_id, avg(1-is_fraud) AS share FROM around GROUP BY 1), "
        "k AS (SELECT transaction_id, round(share / (SELECT sum(share) FROM r) * (n0-n1))::BIGINT AS copies FROM r, c)"
    )
    pair = "foreign_transaction, location_mismatch"
    leaves = f"leaves AS (SELECT {pair}, count(*) AS n, count(*) FILTER (is_fraud=1) AS n_pos FROM train GROUP BY ALL)"
    before = "CASE WHEN score_a >= 0.5 THEN 1 ELSE 0 END"
    scaled = ", ".join(
        f"round(CASE WHEN h_{c} > l_{c} THEN ({c}-l_{c})::DOUBLE/(h_{c}-l_{c}) ELSE 0 END, 6)::DOUBLE AS {c}" for c in RAW_FEATURES
    )
    ends = ", ".join(f"min({c}) AS l_{c}, max({c}) AS h_{c}" for c in RAW_FEATURES)
    return {
        "x01_undersample": f"WITH {TX}, r AS (SELECT transaction_id, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY {order}) AS place FROM train) "
        "SELECT transaction_id, is_fraud FROM r WHERE is_fraud=1 OR place <= 2*(SELECT count(*) FROM train WHERE is_fraud=1)",
        "x02_smote": f"WITH {base}, {even}, {made}",
        "x02_adasyn": f"WITH {base}, {dense}, {made}",
        "x03_leaf_purity": f"WITH {TX}, {leaves} SELECT {pair}, n, n_pos, round(n_pos/n, 6) AS purity FROM leaves",
        "x03_rule_override": f"WITH {SC}, {leaves}, o AS (SELECT {before} AS before, coalesce(n >= 20 AND n_pos >= 0.25*n, false) AS hit "
        f"FROM sc JOIN tx USING (transaction_id) LEFT JOIN leaves USING ({pair})) "
        "SELECT before, CASE WHEN hit THEN 1 ELSE before END AS after, count(*) AS n_rows FROM o GROUP BY ALL",
        "x04_min_max_scale": f"WITH {TX}, e AS (SELECT {ends} FROM train) SELECT transaction_id, {scaled} FROM tx, e WHERE split='test'",
        "x04_label_encode": f"WITH {TX} SELECT transaction_id, (list_position([{', '.join(repr(e) for e in sorted(EVENT_TYPES))}], merchant_category)-1)::INTEGER "
        "AS merchant_category_code FROM tx WHERE split='test'",
    }


def oracle_sql() -> dict[str, str]:
    return _quality() | _profile() | _features() | _evaluate() | _models() | _learners() | _exact_fits() | _boosted_fits() | _inputs() | _resampling()
