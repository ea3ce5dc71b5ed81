"""DuckDB SQL for the queries whose results SQL can state."""

from __future__ import annotations

PRODUCT_EVENTS = """
product_events AS (
  SELECT event_id,
         CASE event_type WHEN 'click' THEN 'a' WHEN 'view' THEN 'b' WHEN 'signup' THEN 'c'
                         WHEN 'purchase' THEN 'd' WHEN 'error' THEN 'e' END AS nutrition_grade_fr,
         value AS value_100g,
         CASE WHEN event_type = 'click' THEN value END AS click_100g,
         CASE WHEN event_type = 'error' THEN value END AS error_100g,
         CASE WHEN event_type = 'refund' THEN value END AS refund_100g,
         CASE WHEN event_type = 'view' THEN 'NaN'::DOUBLE ELSE value END AS nan_100g,
         CASE WHEN event_type = 'signup' THEN props ELSE value::VARCHAR END AS mixed_100g,
         event_type || '-' || props AS packaging
  FROM events)"""

NULL_PROFILE = (
    "null_profile AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", count(*) AS row_count, "
        f"count(*) FILTER (WHERE {v} IS NULL OR isnan({v})) AS null_count, "
        f"count(*) FILTER (WHERE {v} IS NULL OR isnan({v})) / count(*) AS null_share FROM product_events"
        for i, (c, v) in enumerate(
            [
                ("value_100g", "value_100g"),
                ("click_100g", "click_100g"),
                ("error_100g", "error_100g"),
                ("refund_100g", "refund_100g"),
                ("nan_100g", "nan_100g"),
                ("mixed_100g", "TRY_CAST(mixed_100g AS DOUBLE)"),
            ]
        )
    )
    + ")"
)

GRADED = """
graded AS (
  SELECT o_orderkey, o_orderpriority,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0
              WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 1 END AS label
  FROM orders)"""

LINE_PRICES = """
line_prices AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax
  FROM lineitem)"""

FILLED = (
    "filled AS (SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM line_prices)) AS {c}_imputed"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    + " FROM line_prices)"
)

JUDGED = """
judged AS (
  SELECT doc_id, quality AS label, n_chars, lang, n_chars::DOUBLE AS score,
         (n_chars > 400)::INT AS prediction, (n_chars > 200)::INT AS prediction_low
  FROM documents JOIN labels USING (doc_id))"""

JUDGED_LINES = """
judged AS (
  SELECT (l_returnflag = 'R')::INT AS label, l_extendedprice AS score FROM lineitem)"""

ROC = """
steps AS (
  SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM judged GROUP BY score),
ranked AS (
  SELECT score, pos, neg,
         (sum(pos) OVER high)::BIGINT AS pos_upto, (sum(neg) OVER high)::BIGINT AS neg_upto,
         (sum(pos) OVER ())::BIGINT AS all_pos, (sum(neg) OVER ())::BIGINT AS all_neg,
         lead(pos) OVER high AS next_pos, lead(neg) OVER high AS next_neg,
         row_number() OVER high AS place
  FROM steps WINDOW high AS (ORDER BY score DESC)),
points AS (
  SELECT 'Infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
  UNION ALL
  SELECT score, neg_upto / all_neg, pos_upto / all_pos FROM ranked {corners}),
area AS (
  SELECT sum(neg * (2 * pos_upto - pos))::DOUBLE / (2.0::DOUBLE * max(all_pos) * max(all_neg)) AS auc
  FROM ranked)"""
ALL_POINTS = ROC.format(corners="")
CORNERS = ROC.format(
    corners="WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"
)


def _cells(prediction: str) -> str:
    return f"""
  SELECT count(*) FILTER (WHERE label = 1 AND {prediction} = 1) AS tp, count(*) FILTER (WHERE label = 0 AND {prediction} = 0) AS tn,
         count(*) FILTER (WHERE label = 0 AND {prediction} = 1) AS fp, count(*) FILTER (WHERE label = 1 AND {prediction} = 0) AS fn
  FROM judged"""


def _rates(cells: str) -> str:
    return f"""
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM (
    SELECT *, coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0.0) AS accuracy,
           coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
           coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall
    FROM {cells})"""


# Of a model that finds the rule: every row of ``judged`` is right.
PERFECT = """
  SELECT count(*) FILTER (WHERE label = 1) AS tp, count(*) FILTER (WHERE label = 0) AS tn,
         count(*) FILTER (WHERE label NOT IN (0, 1)) AS fp, count(*) FILTER (WHERE label IS NULL) AS fn,
         avg((label IS NOT NULL)::INT)::DOUBLE AS auc, avg((label IS NOT NULL)::INT)::DOUBLE AS accuracy,
         avg((label = 1)::INT) FILTER (WHERE label = 1)::DOUBLE AS precision,
         avg((label = 1)::INT) FILTER (WHERE label = 1)::DOUBLE AS recall,
         avg((label = 1)::INT) FILTER (WHERE label = 1)::DOUBLE AS f1
  FROM judged"""


def _bucket(key: str, salt: str) -> str:
    return f"('0x' || substr(md5('{salt}:' || {key}::VARCHAR), 1, 8))::BIGINT"


def _in_train(key: str) -> str:
    return f"{_bucket(key, 'split:42')} < {int(0.8 * 2**32)}"


# Line items with two flags and labels that overlap: four cells, each with its own share of ones.
FLAGGED = f"""
flagged AS (
  SELECT (l_linenumber > 3)::INT AS late, (l_quantity > 25)::INT AS large,
         (l_partkey % 10 < CASE WHEN l_linenumber <= 3 AND l_quantity <= 25 THEN 2 WHEN l_quantity <= 25 THEN 7
                                WHEN l_linenumber <= 3 THEN 6 ELSE 4 END)::INT AS label,
         {_in_train("l_orderkey")} AS in_train
  FROM lineitem),
shares AS (SELECT late, large, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS y, avg(label) AS p
           FROM flagged WHERE in_train GROUP BY late, large)"""

# Scores by family. Boosting: the first tree has the means of labels -1 and 1, nine more follow the slope
# of the logistic loss at a tenth of their leaves' means. Logistic: Newton's method on the cells, without interaction.
FAMILY_SCORES = {
    "forest": "SELECT late, large, p AS score FROM shares",
    "boosted": """
  WITH RECURSIVE boost AS (
    SELECT late, large, p, 1 AS step, 2 * p - 1 AS f FROM shares
    UNION ALL
    SELECT late, large, p, step + 1, f + 0.1 * (4 * p / (1 + exp(2 * f)) - 4 * (1 - p) / (1 + exp(-2 * f)))
    FROM boost WHERE step < 10)
  SELECT late, large, 1 / (1 + exp(-2 * f)) AS score FROM boost WHERE step = 10""",
    "logistic": """
  WITH RECURSIVE
    t AS (SELECT max(n) FILTER (WHERE late + large = 0) AS n0, max(n) FILTER (WHERE late > large) AS na,
                 max(n) FILTER (WHERE late < large) AS nb, max(n) FILTER (WHERE late + large = 2) AS nc,
                 max(y) FILTER (WHERE late + large = 0) AS y0, max(y) FILTER (WHERE late > large) AS ya,
                 max(y) FILTER (WHERE late < large) AS yb, max(y) FILTER (WHERE late + large = 2) AS yc
          FROM shares),
    newton AS (
      SELECT 1 AS step, 0.0::DOUBLE AS w, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb
      UNION ALL
      SELECT step + 1, w + (g * (haa * hbb - hab * hab) + ga * (hab * hb - ha * hbb) + gb * (ha * hab - haa * hb)) / det,
             wa + (g * (hab * hb - ha * hbb) + ga * (h * hbb - hb * hb) + gb * (ha * hb - h * hab)) / det,
             wb + (g * (ha * hab - haa * hb) + ga * (ha * hb - h * hab) + gb * (h * haa - ha * ha)) / det
      FROM (
        SELECT *, h * (haa * hbb - hab * hab) - ha * (ha * hbb - hab * hb) + hb * (ha * hab - haa * hb) AS det
        FROM (
          SELECT step, w, wa, wb, y0 - n0 * p0 + ya - na * pa + yb - nb * pb + yc - nc * pc AS g,
                 ya - na * pa + yc - nc * pc AS ga, yb - nb * pb + yc - nc * pc AS gb,
                 v0 + va + vb + vc AS h, va + vc AS ha, vb + vc AS hb, va + vc AS haa, vb + vc AS hbb, vc AS hab
          FROM (
            SELECT *, n0 * p0 * (1 - p0) AS v0, na * pa * (1 - pa) AS va, nb * pb * (1 - pb) AS vb, nc * pc * (1 - pc) AS vc
            FROM (
              SELECT *, 1 / (1 + exp(-w)) AS p0, 1 / (1 + exp(-w - wa)) AS pa, 1 / (1 + exp(-w - wb)) AS pb,
                     1 / (1 + exp(-w - wa - wb)) AS pc
              FROM newton, t WHERE step < 20)))))
  SELECT late, large, 1 / (1 + exp(-w - late * wa - large * wb)) AS score FROM newton, shares WHERE step = 20""",
}


def _cell_scores(model: str, family: str, n_trees: str = "NULL") -> str:
    return f"""
SELECT '{model}' AS model, {n_trees}::INT AS n_trees, late::DOUBLE AS late_n, large::DOUBLE AS large_n, n_test,
       true AS is_one_score, round(score, 4) AS score
FROM ({FAMILY_SCORES[family]}) JOIN (SELECT late, large, count(*) AS n_test FROM flagged WHERE NOT in_train GROUP BY late, large)
     USING (late, large)"""


def _flag_metrics(model: str, family: str) -> str:
    return f"""
SELECT '{model}' AS model, * FROM (
  WITH judged AS (SELECT label, score, (score > 0.5)::INT AS prediction
                  FROM flagged JOIN ({FAMILY_SCORES[family]}) USING (late, large) WHERE NOT in_train),
       {ALL_POINTS}, cells AS ({_cells('prediction')})
  SELECT *, (SELECT auc FROM area) AS auc FROM ({_rates('cells')}))"""


def _tells(name: str, rule: str, source: str) -> str:
    """1 if a column's value alone gives the label, else 0."""
    return (
        f"(SELECT (max(n) = 1)::INT::DOUBLE FROM (SELECT count(DISTINCT {rule}) AS n FROM {source} GROUP BY {name}))"
    )


BASE_VS_OPTIMISED = (
    f"WITH {JUDGED}, base AS ({_cells('prediction')}), optimised AS ({_cells('prediction_low')}) "
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{measure}' AS measure, (SELECT {value} FROM base) AS base, "
        f"(SELECT {value} FROM optimised) AS optimised"
        for i, (measure, value) in enumerate(
            [("TP", "tp"), ("TN", "tn"), ("FP", "fp"), ("FN", "fn"), ("Total errors", "fp + fn")], start=1
        )
    )
)

METRIC_REPORT = (
    f"WITH {JUDGED}, {ALL_POINTS}, base AS ({_cells('prediction')}), optimised AS ({_cells('prediction_low')}), "
    f"found AS (SELECT 'base' AS variant, * FROM ({_rates('base')}) "
    f"UNION ALL SELECT 'optimised' AS variant, * FROM ({_rates('optimised')})) "
    + " UNION ALL ".join(
        f"SELECT variant, '{m}' AS metric, round({m}, 4) AS value FROM found"
        for m in ("accuracy", "precision", "recall", "f1")
    )
    + " UNION ALL SELECT variant, 'auc' AS metric, round((SELECT auc FROM area), 4) AS value FROM found"
)


def _scaled(name: str, bounds: str) -> str:
    return (
        f"round(coalesce(({name} - (SELECT min({name}) FROM {bounds})) / "
        f"nullif((SELECT max({name}) FROM {bounds}) - (SELECT min({name}) FROM {bounds}), 0), 0.5), 6)"
    )


def _profile(table: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS \"column\", '{type_}' AS \"type\", "
        f"(SELECT count(*) FROM {table}) AS n_rows, {len(columns)} AS n_columns"
        for i, (name, type_) in enumerate(columns)
    )


def _subsets(rows: str, key: str, subsets: int) -> str:
    return f"""
WITH source AS ({rows}),
smallest AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM source GROUP BY label)),
ranked AS (
  SELECT {key}, label, subset, row_number() OVER (
           PARTITION BY label, subset ORDER BY md5('subset:42:' || subset || ':' || {key})) AS place
  FROM source, (SELECT unnest(range({subsets}))::INT AS subset))
SELECT {key}, label, subset FROM ranked WHERE place <= (SELECT n FROM smallest)"""


def _preview_cells(columns: list[str]) -> str:
    shown = {"o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"}
    return "WITH first_rows AS (SELECT *, row_number() OVER (ORDER BY o_orderkey)::INT AS row FROM orders " \
        "ORDER BY o_orderkey LIMIT 5) " + " UNION ALL ".join(
            f"SELECT row, {i} AS position, '{c}' AS field, {shown.get(c, c)}::VARCHAR AS value FROM first_rows"
            for i, c in enumerate(columns)
        )


def oracle() -> dict[str, str]:
    sql = {}

    sql["tsv_round_trip"] = "SELECT * FROM events"
    sql["tsv_inferred_profile"] = _profile(
        "events",
        [
            ("event_id", "int"),
            ("ts", "timestamp"),
            ("user_id", "int"),
            ("event_type", "string"),
            ("value", "double"),
            ("props", "string"),
        ],
    )
    sql["tsv_lines_in_cells"] = "SELECT * FROM documents"
    sql["tsv_one_spanning_file"] = "SELECT * FROM documents"
    sql["table_profile_lineitem"] = _profile(
        "lineitem",
        [
            ("l_orderkey", "bigint"),
            ("l_partkey", "bigint"),
            ("l_suppkey", "bigint"),
            ("l_linenumber", "int"),
            ("l_quantity", "double"),
            ("l_extendedprice", "double"),
            ("l_discount", "double"),
            ("l_tax", "double"),
            ("l_returnflag", "string"),
            ("l_linestatus", "string"),
            ("l_shipdate", "timestamp_ntz"),
        ],
    )
    sql["export_readable_csv"] = """
SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice, 7.0::DOUBLE AS constant,
       p_size::DOUBLE AS p_size_imputed, p_retailprice AS p_retailprice_imputed,
       7.0::DOUBLE AS constant_imputed
FROM part"""
    sql["preview_long"] = _preview_cells(
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    )
    sql["preview_rows"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5"
    sql["metric_report_file"] = METRIC_REPORT
    sql["base_vs_optimised_file"] = BASE_VS_OPTIMISED

    sql["select_by_suffix"] = (
        f"WITH {PRODUCT_EVENTS} SELECT event_id, value_100g, click_100g, error_100g, refund_100g, "
        "nan_100g, mixed_100g FROM product_events"
    )
    sql["cast_numeric"] = (
        f"WITH {PRODUCT_EVENTS} SELECT event_id, TRY_CAST(mixed_100g AS DOUBLE) AS mixed_100g FROM product_events"
    )
    sql["malformed_profile"] = f"WITH {PRODUCT_EVENTS} " + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", "
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS malformed_count FROM product_events"
        for i, c in enumerate(["mixed_100g", "packaging", "value_100g"])
    )
    sql["null_profile"] = f"WITH {PRODUCT_EVENTS}, {NULL_PROFILE} SELECT * FROM null_profile"
    sql["dense_columns"] = (
        f"WITH {PRODUCT_EVENTS}, {NULL_PROFILE} "
        'SELECT (row_number() OVER (ORDER BY null_share, position))::INT AS rank, "column", null_count, null_share '
        "FROM null_profile WHERE null_share < 0.999"
    )
    sql["clean_project"] = f"""
WITH {PRODUCT_EVENTS}
SELECT value_100g, click_100g, error_100g, nan_100g, TRY_CAST(mixed_100g AS DOUBLE) AS mixed_100g,
       nutrition_grade_fr, event_id,
       lower(regexp_replace(packaging, '[^a-zA-Z0-9 ]', '', 'g')) AS packaging
FROM product_events"""
    sql["clean_summary"] = (
        "SELECT count(*) AS final_row_count, 5 AS numeric_features_count, "
        "1 AS categorical_features_count FROM events"
    )
    sql["normalize_text"] = (
        "SELECT doc_id, lower(regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g')) AS text FROM documents"
    )

    sql["grade_labels"] = f"WITH {GRADED} SELECT * FROM graded"
    sql["drop_unlabelled"] = f"WITH {GRADED} SELECT * FROM graded WHERE label IS NOT NULL"
    sql["label_stats"] = (
        f"WITH {GRADED} SELECT count(*) FILTER (WHERE label = 0) AS negatives, count(*) FILTER (WHERE label = 1) AS positives, "
        "count(*) FILTER (WHERE label IS NULL) AS discarded FROM graded"
    )
    sql["label_distribution"] = (
        f"WITH {GRADED} SELECT label, count(*) AS n_rows, count(*) / sum(count(*)) OVER () AS share "
        "FROM graded WHERE label IS NOT NULL GROUP BY label"
    )

    sql["impute_median"] = f"WITH {LINE_PRICES}, {FILLED} SELECT * FROM filled"
    sql["minmax_scale"] = f"""
WITH parts AS (SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice, 7.0::DOUBLE AS constant FROM part)
SELECT p_partkey, {_scaled('p_size', 'parts')} AS p_size_scaled,
       {_scaled('p_retailprice', 'parts')} AS p_retailprice_scaled,
       {_scaled('constant', 'parts')} AS constant_scaled
FROM parts"""
    sql["vector_columns"] = f"WITH {LINE_PRICES}, {FILLED} SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"{_scaled(c + '_imputed', 'filled')} AS {c}_scaled"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ) + " FROM filled"
    sql["scale_test_rows"] = f"""
WITH train AS (SELECT o_totalprice FROM orders WHERE {_in_train('o_orderkey')})
SELECT o_orderkey, {_scaled('o_totalprice', 'train')} AS o_totalprice_scaled
FROM orders WHERE NOT ({_in_train('o_orderkey')})"""
    sql["preprocess_status"] = "SELECT 4 AS num_features"

    sql["hash_split"] = (
        f"SELECT o_orderkey, CASE WHEN {_in_train('o_orderkey')} THEN 'train' ELSE 'test' END AS part FROM orders"
    )
    sql["hash_folds"] = f"SELECT doc_id, ({_bucket('doc_id', 'fold:42')} % 3)::INT AS fold FROM labels"
    sql["balanced_subsets"] = _subsets("SELECT doc_id, quality AS label FROM labels", "doc_id", 5)
    sql["balanced_orders"] = _subsets(
        "SELECT o_orderkey, (o_orderpriority = '1-URGENT')::INT AS label FROM orders", "o_orderkey", 3
    )
    sql["majority_vote_fixed"] = """
WITH voted AS (
  SELECT doc_id, (n_chars > 400)::INT AS vote_0,
         ((length(text) - length(replace(text, ' ', ''))) * 6 < length(text))::INT AS vote_1,
         (lang = 'en')::INT AS vote_2, (source = 'src0')::INT AS vote_3, quality
  FROM documents JOIN labels USING (doc_id))
SELECT *, (vote_0 + vote_1 + vote_2 >= 2)::INT AS of_three,
       (vote_0 + vote_1 + vote_2 + vote_3 >= 3)::INT AS of_four
FROM voted"""

    sql["confusion"] = f"WITH {JUDGED} {_cells('prediction')}"
    sql["metrics_fixed"] = (
        f"WITH {JUDGED}, {ALL_POINTS}, cells AS ({_cells('prediction')}) "
        f"SELECT *, (SELECT auc FROM area) AS auc FROM ({_rates('cells')})"
    )
    sql["roc_points"] = f"WITH {JUDGED}, {ALL_POINTS} SELECT * FROM points"
    sql["roc_points_lines"] = f"WITH {JUDGED_LINES}, {ALL_POINTS} SELECT * FROM points"
    sql["roc_corners_lines"] = f"WITH {JUDGED_LINES}, {CORNERS} SELECT * FROM points"
    sql["auc_exact"] = f"WITH {JUDGED}, {ALL_POINTS} SELECT * FROM area"
    sql["auc_exact_lines"] = f"WITH {JUDGED_LINES}, {ALL_POINTS} SELECT * FROM area"
    sql["misclassified"] = (
        f"WITH {JUDGED} SELECT doc_id, label, prediction, n_chars FROM judged "
        "WHERE label <> prediction ORDER BY doc_id LIMIT 5"
    )
    sql["misclassified_all"] = (
        f"WITH {JUDGED} SELECT doc_id, label, prediction, n_chars, lang FROM judged WHERE label <> prediction"
    )
    sql["label_pairs"] = f"WITH {JUDGED} SELECT doc_id, label, prediction FROM judged"
    sql["compare_confusions"] = BASE_VS_OPTIMISED

    sql["training_info"] = (
        "SELECT 'LogisticRegressionModel' AS model_type, count(*) AS training_rows "
        f"FROM documents JOIN labels USING (doc_id) WHERE {_in_train('doc_id')}"
    )
    sql["score_rows"] = (
        "SELECT doc_id, length(text)::DOUBLE AS chars_n, quality AS label, true AS is_class, "
        "true AS is_probability FROM documents JOIN labels USING (doc_id) "
        f"WHERE NOT ({_in_train('doc_id')})"
    )

    test_rows = f"SELECT quality FROM documents JOIN labels USING (doc_id) WHERE NOT ({_in_train('doc_id')})"
    sql["model_totals"] = " UNION ALL ".join(
        f"SELECT '{model}' AS model, count(*) AS n_test, count(*) FILTER (WHERE quality = 1) AS n_positive, "
        f"true AS auc_in_range FROM ({test_rows})"
        for model in ("Random Forest", "Logistic Regression", "GBT")
    )
    lines = f"SELECT *, (l_linenumber > 3)::INT AS label FROM lineitem WHERE NOT ({_in_train('l_orderkey')})"
    people = f"SELECT *, (c_nationkey > 12)::INT AS label FROM customer WHERE NOT ({_in_train('c_custkey')})"
    for name in ("train_forest", "train_boosted", "train_logistic", "select_top_features"):
        sql[name] = f"WITH judged AS ({lines}) SELECT * FROM ({PERFECT})"
    families = "(VALUES ('Random Forest'), ('Logistic Regression'), ('GBT')) AS m(model)"
    variants = "(VALUES ('base'), ('optimised')) AS v(variant)"
    sql["compare_models"] = f"WITH judged AS ({lines}) SELECT * FROM {families}, ({PERFECT})"
    sql["model_comparison_file"] = f"WITH judged AS ({lines}) SELECT model, accuracy, auc FROM {families}, ({PERFECT})"
    sql["experiment_metrics"] = f"WITH judged AS ({people}) SELECT * FROM {variants}, ({PERFECT})"
    sql["model_roc_curves"] = f"""
WITH judged AS ({lines})
SELECT model, auc AS tpr_without_alarm, auc AS tpr_with_alarm, 1.0::DOUBLE AS last_fpr FROM {families}, ({PERFECT})"""
    sql["train_forest_lines"] = f"""
SELECT l_orderkey, l_linenumber::DOUBLE AS line_n, label, label AS prediction, label = 1 AS leans_to_one
FROM ({lines})"""
    sql["balanced_ensemble"] = (
        "SELECT l_orderkey, l_linenumber::DOUBLE AS line_n, label, "
        + ", ".join(f"label AS vote_{i}" for i in range(5))
        + f", label AS prediction FROM ({lines})"
    )
    sql["ensemble_votes"] = f"SELECT l_orderkey, label, 5 * label AS n_votes FROM ({lines})"
    for name in ("importance_rank", "feature_rank_file"):
        sql[name] = f"""
SELECT row_number() OVER (ORDER BY importance DESC)::INT AS rank, feature, importance
FROM (SELECT 'line_n' AS feature, {_tells('l_linenumber', 'l_linenumber > 3', 'lineitem')} AS importance
      UNION ALL
      SELECT 'quantity_n', {_tells('l_quantity', 'l_linenumber > 3', 'lineitem')})"""
    nation = _tells("c_nationkey", "c_nationkey > 12", "customer")
    sql["importance_features"] = f"""
SELECT 'nation_n' AS feature, {nation} = 1 AS is_telling
UNION ALL SELECT 'balance_n', (SELECT corr(c_acctbal, (c_nationkey > 12)::INT) FROM customer) > 0.9"""
    sql["tuning_report"] = f"""
SELECT (row_number() OVER (ORDER BY t, d) - 1)::INT AS candidate, t AS "numTrees", d AS "maxDepth", {nation} AS mean_auc,
       row_number() OVER (ORDER BY t, d) = 1 AS is_best
FROM (SELECT unnest([50, 100]) AS t), (SELECT unnest([5, 10]) AS d)"""
    sql["tuning_candidates"] = f"""
SELECT 0 AS candidate, 3 AS num_trees, 0 AS max_depth, {nation} / 2 AS mean_auc, false AS is_best
UNION ALL SELECT 1, 5, 5, {nation}, true UNION ALL SELECT 2, NULL, 5, {nation}, false"""
    sql["experiment_report_files"] = f"""
WITH judged AS ({people}), cells AS (SELECT * FROM ({PERFECT}))
SELECT variant || ' ' || name AS name, n
FROM {variants}, (SELECT 'tp' AS name, tp AS n FROM cells UNION ALL SELECT 'tn', tn FROM cells
                  UNION ALL SELECT 'fp', fp FROM cells UNION ALL SELECT 'fn', fn FROM cells)
UNION ALL SELECT 'label ' || (c_nationkey > 12)::INT, count(*) FROM customer GROUP BY c_nationkey > 12
UNION ALL SELECT 'wrong rows', fp + fn FROM cells"""

    families = {"Random Forest": "forest", "Logistic Regression": "logistic", "GBT": "boosted"}
    sql["trained_cells"] = (
        f"WITH {FLAGGED} {_cell_scores('base forest', 'forest', '100')} "
        f"UNION ALL {_cell_scores('boosted trees', 'boosted')} UNION ALL {_cell_scores('logistic', 'logistic')}"
    )
    sql["compared_cells"] = f"WITH {FLAGGED} " + " UNION ALL ".join(
        _cell_scores(model, family, "20" if family == "forest" else "NULL") for model, family in families.items()
    )
    sql["compare_overlapping"] = f"WITH {FLAGGED} " + " UNION ALL ".join(
        _flag_metrics(model, family) for model, family in families.items()
    )
    sql["train_stump"] = f"""
WITH lines AS (
       SELECT l_linenumber::DOUBLE AS line, l_quantity AS quantity, {_in_train('l_orderkey')} AS in_train,
              (l_partkey % 10 < CASE WHEN l_quantity > 33 THEN 7 WHEN l_linenumber > 5 THEN 5 ELSE 3 END)::INT AS label
       FROM lineitem),
     counted AS (
       SELECT feature, value, sum(n)::DOUBLE AS n, sum(y)::DOUBLE AS y FROM (
         SELECT 'line' AS feature, line AS value, count(*) AS n, sum(label) AS y FROM lines WHERE in_train GROUP BY line
         UNION ALL
         SELECT 'quantity', quantity, count(*), sum(label) FROM lines WHERE in_train GROUP BY quantity)
       GROUP BY feature, value),
     sides AS (
       SELECT feature, value, sum(n) OVER low AS n1, sum(y) OVER low AS y1,
              sum(n) OVER (PARTITION BY feature) AS n, sum(y) OVER (PARTITION BY feature) AS y
       FROM counted WINDOW low AS (PARTITION BY feature ORDER BY value)),
     best AS (  -- the least mean Gini impurity of both sides
       SELECT * FROM sides WHERE n1 < n
       ORDER BY y1 * (n1 - y1) / n1 + (y - y1) * (n - n1 - y + y1) / (n - n1), feature, value LIMIT 1),
     sided AS (
       SELECT quantity, CASE WHEN (CASE feature WHEN 'line' THEN line ELSE quantity END) <= value
                             THEN y1 / n1 ELSE (y - y1) / (n - n1) END AS score
       FROM lines, best WHERE NOT in_train)
SELECT (score > 0.5)::INT AS prediction, round(score, 6) AS score, count(*) AS n_test,
       min(quantity) AS least, max(quantity) AS most
FROM sided GROUP BY 1, 2"""
    votes = ", ".join(f"max(vote) FILTER (WHERE subset = {i}) AS vote_{i}" for i in range(5))
    sql["balanced_votes"] = f"""
WITH told AS (SELECT o_orderkey, (o_custkey % 8)::DOUBLE AS cell_n, (o_orderkey % 7 < 2)::INT AS label,
                     {_in_train('o_orderkey')} AS in_train FROM orders),
     members AS ({_subsets('SELECT o_orderkey, label FROM told WHERE in_train', 'o_orderkey', 5)}),
     voted AS (SELECT cell_n, subset, (avg(m.label) > 0.5)::INT AS vote
               FROM members m JOIN told USING (o_orderkey) GROUP BY cell_n, subset),
     by_cell AS (SELECT cell_n, {votes}, (sum(vote) > 2)::INT AS prediction FROM voted GROUP BY cell_n)
SELECT o_orderkey, cell_n, label, by_cell.* EXCLUDE (cell_n) FROM told JOIN by_cell USING (cell_n) WHERE NOT in_train"""

    sql["median_sketch_rank"] = f"WITH {LINE_PRICES} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n_values, count({c}) > 0 AS is_middle FROM line_prices"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    sql["three_class_accuracy"] = """
SELECT count(*) FILTER (WHERE l_linenumber < 7 AND
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END = l_linenumber % 3) / count(*) AS accuracy
FROM lineitem"""
    sql["split_without_keys"] = """
SELECT o_orderkey % 3 = 0 AS without_key, count(*) AS n_rows, true AS is_split FROM orders GROUP BY 1"""
    sql["tsv_mixed_files"] = (
        "SELECT doc_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS text, lang, source, n_chars FROM documents"
    )
    sql["misclassified_lookup"] = f"""
WITH {JUDGED}
SELECT nullif(doc_id, CASE WHEN doc_id % 50 = 0 THEN doc_id END) AS key, label, prediction, n_chars,
       CASE WHEN doc_id % 50 <> 0 AND doc_id % 7 <> 0 THEN lang END AS lang
FROM judged WHERE label <> prediction"""
    sql["experiment_totals"] = f"""
WITH judged AS (SELECT quality, {_in_train('doc_id')} AS in_train FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'rows' AS step, count(*) AS n FROM judged
UNION ALL SELECT 'negatives', count(*) FILTER (WHERE quality = 0) FROM judged
UNION ALL SELECT 'positives', count(*) FILTER (WHERE quality = 1) FROM judged
UNION ALL SELECT 'discarded', count(*) FILTER (WHERE quality IS NULL) FROM judged
UNION ALL SELECT 'training rows', count(*) FROM judged WHERE quality IS NOT NULL AND in_train
UNION ALL SELECT 'exported rows', count(*) FROM judged WHERE quality IS NOT NULL
UNION ALL SELECT unnest(['base', 'optimised']), count(*) FROM judged WHERE quality IS NOT NULL AND NOT in_train"""
    return sql
