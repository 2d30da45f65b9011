"""The same results in standard SQL, to check the queries against another engine."""

from __future__ import annotations

from sievework.plans.bookings_view import BOOKINGS_SQL
from sievework.plans.queries import LINE_KEY, LINE_NUMBERS, PRICE_CUT
from sievework.spec import DOUBLE, INTEGER, indicator_name
from sievework.specs import BOOKING, CUSTOMER, LINEITEM, ORDERS


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- bookings, step by step --------------------------------------------------------------


def _typed() -> str:
    types = {INTEGER: "integer", DOUBLE: "double"}
    columns = [
        f"try_cast(trim({c.name}) AS {types[c.kind]}) AS {c.name}" if c.numeric
        else f"trim({c.name}) AS {c.name}"
        for c in BOOKING.columns
    ]
    return f"SELECT {', '.join(columns)} FROM raw"


def _flagged() -> str:
    d = BOOKING.date
    date = (
        f"try_strptime(concat_ws('-', cast({d.year} AS varchar), lpad(cast({d.month} AS varchar), 2, '0'), "
        f"lpad(cast({d.day} AS varchar), 2, '0')), '%Y-%m-%d')"
    )
    missing = " OR ".join(f"{c} IS NULL" for c in BOOKING.names)
    negative = " OR ".join(f"{c} < 0" for c in BOOKING.numeric)
    binary = " OR ".join(f"{c} IS NULL OR {c} NOT IN (0, 1)" for c in BOOKING.binaries)
    category = " OR ".join(
        f"{c} IS NULL OR {c} NOT IN ({_quoted(BOOKING[c].domain)})" for c in BOOKING.categorical
    )
    target = f"{BOOKING.target} IS NULL OR {BOOKING.target} NOT IN ({_quoted(BOOKING[BOOKING.target].domain)})"
    return f"""
    SELECT *,
      cast(coalesce({missing}, false) AS integer) AS missing_required_value,
      cast(arrival_date_full IS NULL AS integer) AS invalid_arrival_date,
      cast(total_nights_check <= 0 AS integer) AS zero_or_negative_night_stay,
      cast(total_guests_check <= 0 AS integer) AS zero_or_negative_guest_count,
      cast(coalesce({negative}, false) AS integer) AS negative_numeric_value,
      cast({binary} AS integer) AS invalid_binary_value,
      cast({category} AS integer) AS invalid_category_value,
      cast({target} AS integer) AS invalid_target_value
    FROM (SELECT *, cast({date} AS date) AS arrival_date_full,
            no_of_weekend_nights + no_of_week_nights AS total_nights_check,
            no_of_adults + no_of_children AS total_guests_check
          FROM typed)
    """


ANY_RULE = "(" + " OR ".join(f"coalesce({f}, 0) = 1" for f in BOOKING.flags) + ")"

# Half-up rounding of a price to cents, in whole numbers: prices have two decimals.
_CENTS = "cast(round(avg_price_per_room * 100) AS bigint)"
_GUESTS = "(no_of_adults + no_of_children)"
_PREVIOUS = "(no_of_previous_cancellations + no_of_previous_bookings_not_canceled)"
DERIVED = {
    "total_nights": "no_of_weekend_nights + no_of_week_nights",
    "total_guests": "no_of_adults + no_of_children",
    "has_children": "cast(no_of_children > 0 AS integer)",
    "arrival_day_of_week": "dayofweek(arrival_date_full) + 1",
    "arrival_quarter": "quarter(arrival_date_full)",
    "previous_total_bookings": _PREVIOUS,
    "arrival_is_weekend": "cast(dayofweek(arrival_date_full) IN (0, 6) AS integer)",
    "estimated_booking_value": f"{_CENTS} * (no_of_weekend_nights + no_of_week_nights) / 100.0::double",
    "avg_price_per_guest": f"((2 * {_CENTS} + {_GUESTS}) // (2 * {_GUESTS})) / 100.0::double",
    "previous_cancellation_rate": f"CASE WHEN {_PREVIOUS} > 0 THEN "
    f"cast(no_of_previous_cancellations AS double) / {_PREVIOUS} ELSE 0.0 END",
}
LABEL_SQL = f"CASE WHEN {BOOKING.target} = '{BOOKING.positive_value}' THEN 1 ELSE 0 END"


def _indicators(spec) -> list[str]:
    return [
        f"cast({source} = '{level}' AS integer) AS {indicator_name(source, level)}"
        for source in spec.feature_spec.one_hot
        for level in spec[source].levels
    ]


def _features() -> str:
    plain = [
        DERIVED.get(c, c) + f" AS {c}"
        for c in (*BOOKING.feature_spec.scaled, *BOOKING.feature_spec.binary)
    ]
    columns = ["booking_id", *plain, *_indicators(BOOKING), f"{LABEL_SQL} AS {BOOKING.label}"]
    return f"SELECT {', '.join(columns)} FROM clean"


def _in_train(key: str) -> str:
    return f"('0x' || substr(md5(cast({key} AS varchar)), 1, 8))::bigint % 100 < 80"


STEPS = {
    "raw": BOOKINGS_SQL,
    "typed": _typed(),
    "flagged": _flagged(),
    "clean": f"SELECT {', '.join(BOOKING.clean_names)} FROM flagged WHERE NOT {ANY_RULE}",
    "features": _features(),
    "train": f"SELECT * FROM features WHERE {_in_train('booking_id')}",
}


def _with(last: str, body: str) -> str:
    """The booking steps up to ``last`` as common table expressions, then ``body``."""
    names = list(STEPS)
    steps = names[: names.index(last) + 1]
    ctes = ", ".join(f"{n} AS MATERIALIZED ({STEPS[n]})" for n in steps)
    return f"WITH {ctes} {body}"


def _each(items, select) -> str:
    return " UNION ALL ".join(select(i) for i in items)


# --- orders, scored ----------------------------------------------------------------------

SCORED = f"""
scored AS MATERIALIZED (
  SELECT o_orderkey, cast(o_orderstatus = 'F' AS integer) AS label,
         cast(o_totalprice > {PRICE_CUT} AS double) AS prediction, o_totalprice AS score
  FROM orders)
"""


def _distribution(source: str, column: str) -> str:
    return f"""SELECT {column}, count(*) AS count,
      round(count(*) * 100.0::double / sum(count(*)) OVER (), 2) AS percentage
      FROM {source} GROUP BY {column}"""


def _areas(score: str, columns: str) -> str:
    return f"""
    WITH {SCORED},
    points AS (SELECT {score} AS s, sum(label)::double AS pos, (count(*) - sum(label))::double AS neg
               FROM scored GROUP BY 1),
    curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
              FROM points WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
    steps AS (SELECT *, tp / (tp + fp) AS precision,
                     CASE WHEN tp + fp > pos + neg THEN (tp - pos) / (tp + fp - pos - neg)
                          ELSE tp / (tp + fp) END AS before
              FROM curve),
    areas AS (SELECT cast(sum(pos) AS bigint) AS positives, cast(sum(neg) AS bigint) AS negatives,
                     round(sum(neg * (tp - pos + pos / 2)) / (sum(pos) * sum(neg)), 9) AS roc_auc,
                     round(sum(pos * (precision + before) / 2) / sum(pos), 9) AS pr_auc
              FROM steps)
    SELECT {columns} FROM areas"""


def oracle_sql() -> dict[str, str]:
    lines = ", ".join(LINE_KEY)
    rest = [
        c for c in (
            "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate",
        )
    ]
    flags = ", ".join(BOOKING.flags)
    clean_columns = ", ".join(
        f"cast({c} AS varchar) AS {c}" if c == BOOKING.date.output else c for c in BOOKING.clean_names
    )
    rejected = f"SELECT booking_id, {flags} FROM flagged WHERE {ANY_RULE}"
    scaled = BOOKING.feature_spec.scaled
    duplicates = "SELECT cast(sum(n) AS bigint) AS rows, count(*) AS distinct_rows, cast(sum(n - 1) AS bigint) AS duplicates"
    customer_types = [
        ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
        ("c_acctbal", "double"), ("c_mktsegment", "string"),
    ]
    any_clean = f"SELECT count(*) FILTER (WHERE {ANY_RULE}) FROM flagged WHERE NOT {ANY_RULE}"
    line_rules = {
        "missing_required_value": " OR ".join(f"{c} IS NULL" for c in LINEITEM.names),
        "no_discount_or_tax": "l_discount + l_tax <= 0",
        "negative_numeric_value": " OR ".join(f"{c} < 0" for c in LINEITEM.numeric),
        "invalid_category_value": " OR ".join(
            f"{c} IS NULL OR {c} NOT IN ({_quoted(LINEITEM[c].domain)})" for c in LINEITEM.categorical
        ),
    }
    customer_rules, order_rules = (
        {
            "missing_required_value": " OR ".join(f"{c} IS NULL" for c in spec.names),
            "negative_numeric_value": "coalesce(" + " OR ".join(f"{c} < 0" for c in spec.numeric) + ", false)",
            "invalid_category_value": " OR ".join(
                f"{c} IS NULL OR {c} NOT IN ({_quoted(spec[c].domain)})" for c in spec.categorical
            ),
        }
        for spec in (CUSTOMER, ORDERS)
    )
    order_rules["invalid_target_value"] = f"o_orderstatus IS NULL OR o_orderstatus NOT IN ({_quoted(ORDERS['o_orderstatus'].domain)})"
    unknown = _each(
        BOOKING.categorical,
        lambda c: f"""SELECT DISTINCT '{c}' AS "column", {c} AS value FROM typed
          WHERE {c} NOT IN ({_quoted(BOOKING[c].domain)})""",
    )
    rules = [(f, f"{f} = 1") for f in BOOKING.flags]
    rules += [("any_rule", ANY_RULE), ("non_positive_room_price", "avg_price_per_room <= 0")]
    test_labels = f"""SELECT {BOOKING.label} AS label, count(*) AS n FROM features
      WHERE NOT ({_in_train('booking_id')}) GROUP BY 1"""
    pairs = [*BOOKING.feature_names, BOOKING.label]
    model_names = ("Decision Tree", "Random Forest", "Gradient Boosted Tree", "Logistic Regression")
    metrics = f"""
          classes AS (
            SELECT k, count(*) FILTER (WHERE label = k)::double AS actual,
              count(*) FILTER (WHERE prediction = k)::double AS predicted,
              count(*) FILTER (WHERE label = k AND prediction = k)::double AS correct
            FROM scored, (VALUES (0), (1)) AS v(k) GROUP BY k),
          rates AS (SELECT *, coalesce(correct / nullif(predicted, 0), 0) AS p,
                           coalesce(correct / nullif(actual, 0), 0) AS r FROM classes),
          metrics AS (SELECT round(sum(correct) / sum(actual), 9) AS accuracy,
            round(sum(p * actual) / sum(actual), 9) AS precision,
            round(sum(r * actual) / sum(actual), 9) AS recall,
            round(sum(coalesce(2 * p * r / nullif(p + r, 0), 0) * actual) / sum(actual), 9) AS f1_score
          FROM rates)"""
    oracles = {
        "clean_assertion_faults": _with(
            "flagged",
            ", faulty AS (SELECT * FROM flagged UNION ALL SELECT * FROM flagged WHERE no_of_adults = 1) "
            + _each(
                BOOKING.clean_names,
                lambda c: f"""SELECT 'missing_value' AS "check", '{c}' AS "column",
                  count(*) - count({c}) AS violations FROM faulty""",
            )
            + f" UNION ALL SELECT 'rejected_row', '*', count(*) FILTER (WHERE {ANY_RULE}) FROM faulty"
            + " UNION ALL SELECT 'duplicate_key', 'booking_id', count(*) - count(DISTINCT booking_id) FROM faulty",
        ),
        "quality_report": _with(
            "flagged",
            _each(
                rules,
                lambda r: f"""SELECT 'violations' AS report, '{r[0]}' AS item,
                  (count(*) FILTER (WHERE {r[1]}))::double AS value FROM flagged""",
            )
            + f""" UNION ALL SELECT 'duplicate_rows', '*', (SELECT count(*) FROM typed)
                - (SELECT count(*) FROM (SELECT DISTINCT * FROM typed))::double
              UNION ALL SELECT 'duplicate_keys', 'booking_id', (count(*) - count(DISTINCT booking_id))::double FROM typed
              UNION ALL SELECT 'unknown_labels', "column" || '=' || value, 1 FROM ({unknown})""",
        ),
        "full_profile": _with(
            "typed",
            "SELECT 'shape' AS report, 'rows' AS item, count(*)::double AS value FROM typed UNION ALL "
            + _each(BOOKING.names, lambda c: f"SELECT 'nulls', '{c}', (count(*) - count({c}))::double FROM typed")
            + " UNION ALL "
            + _each(
                BOOKING.categorical,
                lambda c: f"SELECT 'categories', concat_ws('=', '{c}', {c}), count(*)::double FROM typed GROUP BY {c}",
            )
            + f""" UNION ALL SELECT 'target', {BOOKING.target},
                round(count(*) * 100.0::double / sum(count(*)) OVER (), 2) FROM typed GROUP BY {BOOKING.target} UNION ALL """
            + _each(BOOKING.numeric, lambda c: f"SELECT 'numbers', '{c}', round(avg({c}), 6) FROM typed"),
        ),
        "duplicate_rows_fingerprint": f"""{duplicates} FROM (SELECT count(*) AS n FROM (
            SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS a,
                   CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS b FROM orders) GROUP BY a, b)""",
        "clean_target_distribution": _with("clean", _distribution("clean", BOOKING.target)),
        "hash_split_total": """SELECT count(*) AS rows, count(*) - count(DISTINCT o_orderkey) AS shared FROM orders""",
        "correlation_report": _with(
            "features",
            "SELECT feature_a, feature_b, CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) + 0.0 END AS r FROM ("
            + _each(
                [(a, b) for i, a in enumerate(pairs) for b in pairs[i + 1 :]],
                lambda e: f"SELECT '{e[0]}' AS feature_a, '{e[1]}' AS feature_b, corr({e[0]}, {e[1]}) AS r FROM features",
            )
            + ")",
        ),
        "model_label_totals": _with(
            "features",
            f"""SELECT model, label::integer AS label, n AS rows FROM ({test_labels}),
            (VALUES {', '.join(f"('{m}')" for m in model_names)}) AS m(model)""",
        ),
        "node_predictions": _with(
            "features",
            f"""SELECT model, label::double AS label, n AS agreed FROM ({test_labels}),
            (VALUES ('Decision Tree'), ('Random Forest'), ('Gradient Boosted Tree'), ('Large Forest')) AS m(model)""",
        ),
        "leaf_occupancy": _with(
            "features",
            f"""SELECT {BOOKING.label}::double AS label, count(*) AS stored, count(*) AS routed, 0 AS differing
            FROM features WHERE {_in_train('booking_id')} GROUP BY 1""",
        ),
        "importance_file": """SELECT model, 1.0::double AS total, 0 AS differing, 0 AS unknown
            FROM (VALUES ('Decision Tree'), ('Random Forest'), ('Gradient Boosted Tree')) AS m(model)""",
        "reloaded_best_model": _with(
            "features", f"SELECT label, n AS rows, 0 AS differing, 0 AS better FROM ({test_labels})"
        ),
        "spread_sizes": _with(
            "clean",
            f"""SELECT CASE WHEN {_in_train('booking_id')} THEN 'train' ELSE 'test' END AS split,
            count(*) AS rows, {len(BOOKING.feature_names)} AS features, 5 AS partitions FROM clean GROUP BY 1""",
        ),
        "listed_tables": _each(
            ("nation", "customer", "orders"),
            lambda t: f"""SELECT '{t}' AS "tableName", 0 AS temporary, count(*) AS rows FROM {t}""",
        ),
        "rescored_rows": _with("features", f"SELECT label, n AS agreed FROM ({test_labels})"),
        "report_files": f"""WITH {SCORED}, {metrics}
          SELECT 'actual_label_distribution' AS report, label::varchar AS item,
            round(count(*) * 100.0::double / sum(count(*)) OVER (), 2) AS value FROM scored GROUP BY label
          UNION ALL SELECT 'prediction_distribution', prediction::integer::varchar,
            round(count(*) * 100.0::double / sum(count(*)) OVER (), 2) FROM scored GROUP BY prediction
          UNION ALL SELECT 'confusion_matrix', label || '/' || prediction::integer, count(*)::double
            FROM scored GROUP BY label, prediction
          UNION ALL SELECT 'metrics', metric, value FROM (UNPIVOT metrics ON COLUMNS(*) INTO NAME metric VALUE value)""",
        "schema_audit": _each(
            enumerate(customer_types, 1),
            lambda e: f"""SELECT {e[0]} AS position, '{e[1][0]}' AS "column", '{e[1][1]}' AS type,
              1 AS nullable, 1 AS expected, count(*) AS rows,
              count(*) - count({e[1][0]}) AS nulls FROM customer""",
        ),
        "table_shape": "SELECT count(*) AS rows, 11 AS columns FROM lineitem",
        "preview": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
          cast(o_orderdate AS varchar) AS o_orderdate, o_orderpriority
          FROM orders ORDER BY o_orderkey LIMIT 5""",
        "trim_and_coerce": _with("typed", "SELECT * FROM typed"),
        "embedded_header_filter": """SELECT cast(c_custkey AS varchar) AS c_custkey, c_name,
          cast(c_nationkey AS varchar) AS c_nationkey, c_mktsegment FROM customer""",
        "assemble_date": _with(
            "flagged",
            "SELECT booking_id, cast(arrival_date_full AS varchar) AS arrival_date_full FROM flagged",
        ),
        "quality_flags": _with(
            "flagged",
            f"SELECT booking_id, total_nights_check, total_guests_check, {flags} FROM flagged",
        ),
        "violation_summary": _with(
            "flagged",
            _each(
                rules,
                lambda r: f"SELECT '{r[0]}' AS rule, count(*) FILTER (WHERE {r[1]}) AS violations FROM flagged",
            ),
        ),
        "clean_rows": _with("clean", f"SELECT {clean_columns} FROM clean"),
        "rejected_rows": _with("flagged", rejected),
        "csv_contract_scan": _with("flagged", rejected),
        "stored_verdicts": _with(
            "flagged",
            f"""SELECT 'clean' AS side, count(*) FILTER (WHERE NOT {ANY_RULE}) AS rows FROM flagged
            UNION ALL SELECT 'rejected', count(*) FILTER (WHERE {ANY_RULE}) FROM flagged""",
        ),
        "clean_assertion": _with(
            "clean",
            _each(
                BOOKING.clean_names,
                lambda c: f"""SELECT 'missing_value' AS "check", '{c}' AS "column",
                  count(*) - count({c}) AS violations FROM clean""",
            )
            + f" UNION ALL SELECT 'rejected_row', '*', ({any_clean})"
            + " UNION ALL SELECT 'duplicate_key', 'booking_id', count(*) - count(DISTINCT booking_id) FROM clean",
        ),
        "generic_rules_lineitem": _each(
            [*line_rules.items(), ("any_rule", " OR ".join(f"coalesce({r}, false)" for r in line_rules.values()))],
            lambda r: f"SELECT '{r[0]}' AS rule, count(*) FILTER (WHERE {r[1]}) AS violations FROM lineitem",
        ),
        "negative_numeric_customer": f"""SELECT c_custkey, {', '.join(f'cast({r} AS integer) AS {n}' for n, r in customer_rules.items())}
          FROM customer WHERE {' OR '.join(f'({r})' for r in customer_rules.values())}""",
        "large_keys": f"""SELECT o_orderkey + 6000000000 AS o_orderkey,
          {', '.join(f'cast({r} AS integer) AS {n}' for n, r in order_rules.items())} FROM orders""",
        "unknown_labels": _with("typed", unknown),
        "null_counts": _with(
            "typed",
            _each(
                BOOKING.names,
                lambda c: f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM typed""",
            ),
        ),
        "frequency_tables": _each(
            [("orders", "o_orderstatus"), ("orders", "o_orderpriority"), ("customer", "c_mktsegment")],
            lambda e: f"""SELECT '{e[1]}' AS "column", {e[1]} AS value, count(*) AS count
              FROM {e[0]} GROUP BY {e[1]}""",
        ),
        "target_distribution": _distribution("orders", "o_orderstatus"),
        "numeric_moments": _each(
            LINE_NUMBERS,
            lambda c: f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
              round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem""",
        ),
        "exact_percentiles": _each(
            [(c, p) for c in LINE_NUMBERS for p in (0.1, 0.25, 0.5, 0.75, 0.99)],
            lambda e: f"""SELECT '{e[0]}' AS "column", {e[1]}::double AS probability,
              quantile_disc({e[0]}, {e[1]}) AS value FROM lineitem""",
        ),
        "duplicate_rows": f"""{duplicates} FROM (SELECT count(*) AS n FROM lineitem
          GROUP BY {lines}, {', '.join(rest)})""",
        "duplicate_documents": f"""{duplicates} FROM (SELECT count(*) AS n FROM documents
          GROUP BY text, lang, source, n_chars)""",
        "duplicate_keys": f"{duplicates} FROM (SELECT count(*) AS n FROM lineitem GROUP BY {lines})",
        "dedupe_keep_one": f"""SELECT {lines}, {', '.join(rest[:-1])},
          cast(l_shipdate AS varchar) AS l_shipdate
          FROM lineitem QUALIFY row_number() OVER (PARTITION BY {lines} ORDER BY {', '.join(rest)}) = 1""",
        "retention_summary": _with(
            "flagged",
            f"""SELECT count(*) FILTER (WHERE NOT {ANY_RULE}) AS kept,
            count(*) FILTER (WHERE {ANY_RULE}) AS removed, count(*) AS total FROM flagged""",
        ),
        "engineered_features": _with(
            "clean",
            f"""SELECT booking_id, {', '.join(f'{e} AS {n}' for n, e in DERIVED.items())},
            {LABEL_SQL} AS {BOOKING.label} FROM clean""",
        ),
        "one_hot_orders": f"SELECT o_orderkey, {', '.join(_indicators(ORDERS))} FROM orders",
        "feature_table": _with("features", "SELECT * FROM features"),
        "hash_split_md5": f"""SELECT o_orderkey,
          CASE WHEN {_in_train('o_orderkey')} THEN 'train' ELSE 'test' END AS split FROM orders""",
        "split_sizes": _with(
            "clean",
            f"""SELECT CASE WHEN {_in_train('booking_id')} THEN 'train' ELSE 'test' END AS split,
            count(*) AS rows FROM clean GROUP BY 1""",
        ),
        "split_table": _with(
            "clean",
            f"""SELECT CASE WHEN {_in_train('booking_id')} THEN 'train' ELSE 'test' END AS split,
            CASE WHEN booking_status = 'Canceled' THEN 1 ELSE 0 END AS {BOOKING.label}, count(*) AS rows FROM clean GROUP BY 1, 2""",
        ),
        "embedding_correlations": """
          WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings)
          SELECT concat('d', a.d) AS feature_a, concat('d', b.d) AS feature_b, round(corr(a.x, b.x), 6) AS r
          FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.d < b.d GROUP BY a.d, b.d""",
        "ml_input_sizes": _with(
            "clean",
            f"""SELECT CASE WHEN {_in_train('booking_id')} THEN 'train' ELSE 'test' END AS split,
            count(*) AS rows, {len(BOOKING.feature_names)} AS features FROM clean GROUP BY 1""",
        ),
        "scaling_stats": _with(
            "train",
            _each(
                scaled,
                lambda c: f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean,
                  round(stddev_samp({c}), 6) AS std FROM train""",
            ),
        ),
        "standardized": f"""
          WITH s AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s' for c in LINE_NUMBERS)}
                     FROM lineitem WHERE {_in_train('l_orderkey')})
          SELECT {lines}, {', '.join(f'round(({c} - {c}_m) / {c}_s, 4) + 0.0 AS {c}_scaled' for c in LINE_NUMBERS)}
          FROM lineitem, s""",
        "normalized_test_rows": _with(
            "train",
            f""", s AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s' for c in scaled)}
                        FROM train)
            SELECT booking_id, {', '.join(
                f'CASE WHEN coalesce({c}_s, 0) = 0 THEN 0.0 ELSE round(({c} - {c}_m) / {c}_s, 4) + 0.0 END AS {c}_scaled'
                for c in scaled)},
              {', '.join((*BOOKING.feature_spec.binary, *BOOKING.one_hot_names, BOOKING.label))}
            FROM features, s WHERE NOT ({_in_train('booking_id')})""",
        ),
        "target_correlation": _with(
            "features",
            f"""SELECT feature, round(r, 6) AS r FROM (""" + _each(
                BOOKING.feature_names,
                lambda c: f"SELECT '{c}' AS feature, corr({c}, {BOOKING.label}) AS r FROM features",
            ) + ") WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, feature LIMIT 12",
        ),
        "pairwise_correlation": _each(
            [(a, b) for i, a in enumerate(LINE_NUMBERS) for b in LINE_NUMBERS[i + 1:]],
            lambda e: f"""SELECT '{e[0]}' AS feature_a, '{e[1]}' AS feature_b,
              round(corr({e[0]}, {e[1]}), 6) AS r FROM lineitem""",
        ),
        "majority_baseline": f"""WITH {SCORED},
          m AS (SELECT label FROM scored WHERE {_in_train('o_orderkey')}
                GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
          SELECT m.label::double AS majority_label, count(*) FILTER (WHERE s.label = m.label) AS correct,
            count(*) AS rows, round(count(*) FILTER (WHERE s.label = m.label)::double / count(*), 9) AS accuracy
          FROM scored s, m WHERE NOT ({_in_train('o_orderkey')}) GROUP BY m.label""",
        "confusion_matrix": f"""WITH {SCORED}
          SELECT label, prediction, count(*) AS count FROM scored GROUP BY 1, 2""",
        "result_files": f"""WITH {SCORED}
          SELECT label, prediction, count(*) AS count FROM scored GROUP BY 1, 2""",
        "label_distribution": f"WITH {SCORED} {_distribution('scored', 'label')}",
        "prediction_distribution": f"WITH {SCORED} {_distribution('scored', 'prediction')}",
        "classification_metrics": f"WITH {SCORED}, {metrics} SELECT * FROM metrics",
        "roc_auc": _areas("score", "positives, negatives, roc_auc"),
        "pr_auc": _areas("floor(score / 1000)", "positives, negatives, pr_auc"),
        "binned_areas": _areas("score", "roc_auc, pr_auc, 1 AS roc_auc_close, 1 AS pr_auc_close"),
        "csv_round_trip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "table_round_trip": """SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, c_mktsegment
          FROM customer""",
        "written_table_counts": _with(
            "features",
            f"""SELECT 'clean' AS "table", count(*) AS rows FROM clean
            UNION ALL SELECT 'rejected', count(*) FROM flagged WHERE {ANY_RULE}
            UNION ALL SELECT 'train', count(*) FROM features WHERE {_in_train('booking_id')}
            UNION ALL SELECT 'test', count(*) FROM features WHERE NOT ({_in_train('booking_id')})""",
        ),
    }
    return oracles
