"""DuckDB SQL for the queries that SQL can express, by query name."""

from __future__ import annotations

_VIEWS = {
    "lines": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "ratings": """
        SELECT CAST(epoch(o_orderdate) AS BIGINT) AS timestamp,
               CAST(1 + (CAST(l_quantity AS BIGINT) - 1) % 5 AS DOUBLE) AS rating,
               'U' || o_custkey AS user_id, 'P' || l_partkey AS parent_asin
        FROM lines""",
    "metadata": """
        SELECT 'P' || p_partkey AS parent_asin, nullif(p_brand, 'Brand#1') AS store
        FROM part""",
    "actions": """
        SELECT CAST(floor(epoch(ts)) AS INTEGER) AS timestamp,
               CAST(CASE event_type WHEN 'purchase' THEN 5 WHEN 'click' THEN 3
                    WHEN 'view' THEN 2 WHEN 'signup' THEN 1 END AS FLOAT) AS rating,
               'U' || user_id AS user_id, 'P' || json_extract_string(props, '$.k') AS parent_asin
        FROM events""",
    "joined": """
        SELECT parent_asin, timestamp, rating, user_id, store
        FROM ratings JOIN metadata USING (parent_asin) WHERE store IS NOT NULL""",
    "labelled": """
        SELECT user_id, parent_asin, store, CASE WHEN rating >= 4.5 THEN 1 ELSE 0 END AS label
        FROM joined""",
    "user_map": """
        SELECT 'user_id_map' AS feature, value, CAST(row_number() OVER (
                   ORDER BY md5(concat_ws('|', 'ids', 'user_id_map', value)), value) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT user_id AS value FROM joined)""",
    "item_map": """
        SELECT 'parent_id_map' AS feature, value, CAST(row_number() OVER (
                   ORDER BY md5(concat_ws('|', 'ids', 'parent_id_map', value)), value) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT parent_asin AS value FROM joined)""",
    "store_map": """
        SELECT 'store_id_map' AS feature, value, CAST(row_number() OVER (
                   ORDER BY md5(concat_ws('|', 'ids', 'store_id_map', value)), value) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT store AS value FROM joined)""",
    "maps": "SELECT * FROM user_map UNION ALL SELECT * FROM item_map UNION ALL SELECT * FROM store_map",
    "encoded": """
        SELECT i.idx AS parent_asin, j.timestamp, j.rating, u.idx AS user_id, s.idx AS store
        FROM joined j JOIN user_map u ON j.user_id = u.value
             JOIN item_map i ON j.parent_asin = i.value JOIN store_map s ON j.store = s.value""",
    "predictions": """
        SELECT CAST(o_custkey AS INTEGER) AS map_user_id, CAST(l_partkey AS INTEGER) AS parent_asin,
               l_quantity, l_extendedprice FROM lines""",
    "scored": """
        SELECT (l_quantity - 25.0::DOUBLE) / 10.0::DOUBLE AS logit,
               CASE WHEN 1 + (CAST(l_quantity AS BIGINT) - 1) % 5 >= 4.5 THEN 1 ELSE 0 END AS label
        FROM lineitem""",
    "versions": """
        SELECT o_orderpriority AS model, o_orderdate + to_microseconds(o_orderkey) AS timestamp,
               CAST(o_orderkey AS INTEGER) AS version FROM orders""",
    "history": """
        SELECT o_orderpriority AS run_id, CAST(year(o_orderdate) AS INTEGER) AS epoch,
               min(o_totalprice) AS train_loss, max(o_totalprice) AS train_roc_auc,
               CAST(min(o_custkey) AS DOUBLE) AS test_loss, CAST(max(o_custkey) AS DOUBLE) AS test_roc_auc
        FROM orders GROUP BY ALL""",
    "batches": """
        SELECT user_id, CAST(rating AS BIGINT) AS batch_id,
               min(parent_asin) || ',' || max(parent_asin) AS recommendations
        FROM ratings GROUP BY ALL""",
    "vectors": """
        SELECT feature, idx, [instr('0123456789abcdef', substr(md5(concat_ws('|', feature, value)),
                   CAST(j AS INTEGER), 1)) - 9 for j in range(1, 9)] AS vector
        FROM maps""",
    "items": """
        SELECT DISTINCT i.idx AS parent_asin, i.value AS asin, s.idx AS store_id,
               list_concat(iv.vector, sv.vector) AS vector
        FROM metadata m JOIN item_map i ON m.parent_asin = i.value JOIN store_map s ON m.store = s.value
             JOIN vectors iv ON iv.feature = 'parent_id_map' AND iv.idx = i.idx
             JOIN vectors sv ON sv.feature = 'store_id_map' AND sv.idx = s.idx""",
    "users": """
        SELECT u.idx AS map_user_id, u.value AS user_id, v.vector
        FROM user_map u JOIN vectors v ON v.feature = 'user_id_map' AND v.idx = u.idx""",
    "item_sums": """
        SELECT *, CAST(list_sum(vector) AS BIGINT) AS total,
               CAST(list_sum([x * x for x in vector]) AS BIGINT) AS squares FROM items""",
    "user_sums": """
        SELECT *, CAST(list_sum(vector) AS BIGINT) AS total,
               CAST(list_sum([x * x for x in vector]) AS BIGINT) AS squares FROM users""",
}


def _uses(view: str) -> list[str]:
    text = _VIEWS[view]
    return [name for name in _VIEWS if name != view and _mentions(text, name)]


def _mentions(text: str, name: str) -> bool:
    words = text.replace(",", " ").replace("(", " ").replace(")", " ").split()
    return any(
        word.upper() in ("FROM", "JOIN") and following == name
        for word, following in zip(words, words[1:])
    )


def _with(sql: str) -> str:
    """Prefix the query with the views it needs."""
    needed: set[str] = set()
    queue = [name for name in _VIEWS if _mentions(sql, name)]
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += _uses(name)
    if not needed:
        return sql
    views = ", ".join(f"{name} AS ({_VIEWS[name].strip()})" for name in _VIEWS if name in needed)
    return f"WITH {views} {sql}"


def _negatives(rounds: int, extra: str = "") -> str:
    keyed = """
        SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '{seed}', user_id, parent_asin,
                  store, CAST(copy AS VARCHAR))), user_id, parent_asin, store) AS position
        FROM (SELECT user_id, parent_asin, store, row_number() OVER (
                  PARTITION BY user_id, parent_asin, store) - 1 AS copy
              FROM labelled WHERE label = 1)"""
    parts = ["SELECT user_id, parent_asin, store, label FROM labelled"]
    for i in range(rounds):
        parts.append(
            f"""SELECT u.user_id, i.parent_asin, i.store, 0 AS label
            FROM ({keyed.format(seed='42-users')}) u
                 JOIN ({keyed.format(seed=f'42-items-{i}')}) i USING (position) {extra}"""
        )
    return " UNION ALL ".join(parts)


_ROW_SPLIT = """
    SELECT user_id, parent_asin, store, label,
           CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', user_id, parent_asin, store,
                CAST(label AS VARCHAR))), user_id, parent_asin, store, label)
                <= ceil(0.2 * count(*) OVER ()) THEN 'validation' ELSE 'train' END AS split
    FROM labelled"""

_TRAINED = """
    WITH labels AS (
        SELECT user_id, parent_asin, store, CASE WHEN rating >= 4.5 THEN 1 ELSE 0 END AS label FROM encoded),
    sides AS (
        SELECT label, row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR),
                   CAST(parent_asin AS VARCHAR), CAST(store AS VARCHAR), CAST(label AS VARCHAR))),
                   user_id, parent_asin, store, label) <= ceil(0.2 * count(*) OVER ()) AS validation
        FROM labels),
    numbers AS (
        SELECT CAST(sum(CASE WHEN validation THEN 0 ELSE 1 + label END) AS BIGINT) AS n_train,
               CAST(sum(CASE WHEN validation THEN 1 + label ELSE 0 END) AS BIGINT) AS n_validation
        FROM sides)
    SELECT '{model}' AS model, CAST(n AS INTEGER) AS epoch, true AS proper, true AS lowered, n_train, n_validation,
           (SELECT count(*) FROM user_map) AS n_users, (SELECT count(*) FROM item_map) AS n_items,
           (SELECT count(*) FROM store_map) AS n_stores
    FROM numbers, range(10) r(n)"""

_BY_TIME = """
    SELECT timestamp, rating, user_id, parent_asin, row_number() OVER (
               ORDER BY timestamp, rating, user_id, parent_asin) - 1 AS place, count(*) OVER () AS n
    FROM ratings"""

_ALL_PAIRS = """
    SELECT u.map_user_id, u.user_id, i.parent_asin, i.asin, i.store_id,
           0.5::DOUBLE * ((u.total + i.total) * (u.total + i.total) - (u.squares + i.squares))
               AS predicted_rating
    FROM user_sums u CROSS JOIN item_sums i"""

_RECOMMENDED = f"""
    SELECT user_id, string_agg(asin, ',' ORDER BY place, asin) AS recommendations
    FROM (SELECT user_id, asin, rank() OVER (PARTITION BY user_id ORDER BY predicted_rating DESC) AS place
          FROM ({_ALL_PAIRS}) WHERE user_id IN (SELECT user_id FROM actions))
    WHERE place <= 5 GROUP BY user_id"""

_STABLE_LOSS = """round(avg(ln(1 + exp(-abs(logit))) + greatest(logit, 0) - label * logit), 9)"""

_AUC = """
    SELECT CASE WHEN pos > 0 AND neg > 0
           THEN CAST(twice_ranks - pos * (pos + 1) AS DOUBLE) / (2.0::DOUBLE * pos * neg) END AS roc_auc
    FROM (SELECT sum(CASE WHEN label = 1 THEN 2 * below + ties + 1 ELSE 0 END) AS twice_ranks,
                 sum(label) AS pos, sum(1 - label) AS neg
          FROM (SELECT label, rank() OVER (ORDER BY logit) - 1 AS below,
                       count(*) OVER (PARTITION BY logit) AS ties FROM ({rows})))"""

_LINEAR = """
    SELECT user_id, parent_asin, store, rating,
           ((2 * user_id + 3 * parent_asin + 5 * store) % 17 - 8) / 4.0::DOUBLE AS logit FROM encoded"""

_MESSAGE_COLUMNS = "timestamp, rating, user_id, parent_asin"

def _network_logit(inputs: int = 24, hidden: tuple[int, ...] = (3, 2)) -> str:
    """The whole-number network over a list ``v``, layer by layer, as nested selects."""
    select, names = "SELECT *", [f"v[{n + 1}]" for n in range(inputs)]
    source = "{rows}"
    for layer, units in enumerate([*hidden, 1]):
        columns = []
        for c in range(units):
            terms = " + ".join(f"({(7 * r + 3 * c + layer) % 5 - 2}) * {n}" for r, n in enumerate(names))
            total = f"({terms} + ({c - 1}))"
            columns.append(f"{total if layer == len(hidden) else f'greatest(0, {total})'} AS h{layer}_{c}")
        source = f"({select}, {', '.join(columns)} FROM {source})"
        names = [f"h{layer}_{c}" for c in range(units)]
    cross = "0.5 * (pow(list_sum(v), 2) - list_sum([x * x for x in v]))"
    return f"(SELECT *, CAST({names[0]} + {cross} AS FLOAT) AS logit FROM {source})"


_NETWORK = _network_logit()
_REGISTERED = """
    SELECT 'DeepFM' AS model, 0 AS version, 3::BIGINT AS epochs, count(DISTINCT user_id) AS n_users
    FROM (SELECT user_id, parent_asin FROM ratings UNION ALL SELECT user_id, parent_asin FROM actions)
         JOIN metadata USING (parent_asin) WHERE store IS NOT NULL"""

_ORACLE = {
    # sources and sinks
    "scan_jsonl": f"SELECT {_MESSAGE_COLUMNS} FROM ratings",
    "scan_csv": "SELECT * FROM joined",
    "scan_parquet": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 45",
    "scan_parquet_whole": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "scan_collection": "SELECT * FROM metadata",
    "inline_relation": """
        SELECT name, count(*) AS n FROM ratings JOIN (VALUES (1.0, 'poor'), (2.0, 'fair'),
            (3.0, 'good'), (4.0, 'fine'), (5.0, 'best')) v(r, name) ON rating = r GROUP BY name""",
    "scan_feature_maps": "SELECT value, idx FROM store_map",
    "sink_feature_maps": "SELECT * FROM maps",
    "sink_csv": f"SELECT {_MESSAGE_COLUMNS} FROM ratings",
    "sink_append": f"""
        SELECT {_MESSAGE_COLUMNS} FROM ratings UNION ALL
        SELECT CAST(timestamp AS BIGINT), CAST(rating AS DOUBLE), user_id, parent_asin FROM actions""",
    "kv_upsert": """
        SELECT user_id, arg_max(recommendations, batch_id) AS recommendations, max(batch_id) AS batch_id
        FROM batches GROUP BY user_id""",
    "scan_recommendations": """
        SELECT user_id, arg_max(recommendations, batch_id) AS recommendations
        FROM batches GROUP BY user_id""",
    "sink_recommendations_csv": """
        SELECT user_id, recommendations AS top_k_asins FROM batches""",
    "sink_jsonl": "SELECT * FROM metadata",
    "sink_history": "SELECT * FROM history",
    "registry_append": """
        SELECT count(*) AS n_versions, CAST(arg_max(version, timestamp) + 1 AS INTEGER) AS next_version
        FROM versions""",
    "publish_json": f"SELECT {_MESSAGE_COLUMNS} FROM actions",
    # projection, filters, scalar functions
    "project_columns": f"SELECT {_MESSAGE_COLUMNS} FROM joined",
    "drop_null_store": "SELECT * FROM metadata WHERE store IS NOT NULL",
    "drop_null_any": f"""
        SELECT {_MESSAGE_COLUMNS} FROM actions WHERE timestamp IS NOT NULL AND rating IS NOT NULL
        AND user_id IS NOT NULL AND parent_asin IS NOT NULL""",
    "drop_columns": "SELECT timestamp, user_id, parent_asin FROM ratings",
    "replace_columns": """
        SELECT timestamp, rating * 2 AS rating, user_id,
               CAST(substr(parent_asin, 2) AS INTEGER) AS parent_asin FROM ratings""",
    "cast_columns": """
        SELECT user_id, CAST(timestamp AS VARCHAR) AS timestamp, CAST(rating AS INTEGER) AS rating
        FROM actions""",
    "binarize_rating": """
        SELECT user_id, rating, CASE WHEN rating >= 4.5 THEN 1 ELSE 0 END AS label FROM actions""",
    "positive_rows": "SELECT * FROM labelled WHERE label = 1",
    "array_contains_filter": """
        SELECT doc_id FROM documents WHERE list_contains(string_split(text, ' '), 'the')""",
    "filter_low_occurrence": """
        SELECT * FROM joined WHERE user_id IN (
            SELECT user_id FROM joined GROUP BY user_id HAVING count(*) >= 30)""",
    "parse_actions_json": """
        SELECT event_id,
               CASE WHEN event_type NOT IN ('error', 'signup')
                    THEN CAST(floor(epoch(ts)) AS INTEGER) END AS timestamp,
               CASE WHEN event_type NOT IN ('error', 'click') THEN 4.0::FLOAT END AS rating,
               CASE WHEN event_type <> 'error' THEN 'U' || user_id END AS user_id,
               CASE WHEN event_type <> 'error' THEN 'P' || json_extract_string(props, '$.k') END AS parent_asin
        FROM events""",
    "encode_json": """
        SELECT '{"user_id":"' || user_id || '","parent_asin":"' || parent_asin || '","timestamp":'
               || timestamp || '}' AS value FROM ratings""",
    "map_lookup": """
        SELECT event_id, CASE event_type WHEN 'purchase' THEN 5 WHEN 'click' THEN 3 WHEN 'view' THEN 2
               WHEN 'signup' THEN 1 END AS weight FROM events""",
    "invert_map": "SELECT idx AS key, value AS original FROM store_map",
    "feature_vector": """
        SELECT map_user_id || ',' || parent_asin || ',' || CAST(l_quantity AS INTEGER) AS vector
        FROM predictions""",
    "join_list": "SELECT user_id, batch_id, recommendations FROM batches",
    "sigmoid": "SELECT logit, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-logit)), 9) AS probability FROM scored",
    "format_id": "SELECT p_partkey, 'ID_' || p_partkey AS item FROM part",
    "run_id": "SELECT event_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS run_id FROM events",
    "epoch_seconds": "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events",
    # joins and lookups
    "join_ratings_metadata": """
        SELECT parent_asin, timestamp, rating, user_id, store
        FROM ratings JOIN metadata USING (parent_asin)""",
    "semi_join_users": f"""
        SELECT {_MESSAGE_COLUMNS} FROM ratings WHERE user_id IN (SELECT user_id FROM actions)""",
    "encode_minus_one": """
        SELECT user_id, coalesce(idx, -1) AS parent_asin, timestamp
        FROM ratings LEFT JOIN item_map ON parent_asin = value""",
    "encode_null": """
        SELECT user_id, parent_asin, timestamp, idx AS map_item_id
        FROM ratings LEFT JOIN item_map ON parent_asin = value""",
    "item_feature_store": """
        SELECT i.idx AS parent_asin, s.idx AS store_id
        FROM metadata m JOIN item_map i ON m.parent_asin = i.value JOIN store_map s ON m.store = s.value""",
    "decode_entities": """
        SELECT u.value AS user_id, i.value AS asin, place AS rank
        FROM (SELECT *, CAST(rank() OVER (PARTITION BY map_user_id ORDER BY l_extendedprice DESC)
                     AS INTEGER) AS place FROM predictions) p
             LEFT JOIN user_map u ON p.map_user_id = u.idx LEFT JOIN item_map i ON p.parent_asin = i.idx
        WHERE place <= 5""",
    # aggregates
    "distinct_values": "SELECT DISTINCT parent_asin FROM joined",
    "feature_maps_extended": """
        WITH given AS (
            SELECT 'user_id_map' AS feature, user_id AS value, rating FROM joined
            UNION ALL SELECT 'parent_id_map', parent_asin, rating FROM joined),
        each AS (
            SELECT feature, value, CASE WHEN max(rating) = 5 THEN 0 ELSE 1 END AS later
            FROM given GROUP BY feature, value)
        SELECT feature, value, CAST(row_number() OVER (
                   PARTITION BY feature ORDER BY later, md5(concat_ws('|', 'ids', feature, value)), value) - 1
               AS INTEGER) AS idx
        FROM each""",
    "feature_map_user": "SELECT * FROM user_map",
    "feature_map_item": "SELECT * FROM item_map",
    "feature_map_store": "SELECT * FROM store_map",
    "feature_sizes": """
        SELECT 'user_id_map' AS feature, count(DISTINCT user_id) AS size FROM joined UNION ALL
        SELECT 'parent_id_map', count(DISTINCT parent_asin) FROM joined UNION ALL
        SELECT 'store_id_map', count(DISTINCT store) FROM joined""",
    "value_counts": "SELECT user_id, count(*) AS n FROM joined GROUP BY user_id",
    "explode_value_counts": """
        SELECT value, count(*) AS n
        FROM (SELECT unnest(string_split(text, ' ')) AS value FROM documents)
        GROUP BY value ORDER BY n DESC, value LIMIT 50""",
    "recommendation_lists": """
        SELECT 'U' || map_user_id AS user_id,
               string_agg('P' || parent_asin, ',' ORDER BY place) AS top_k_asins
        FROM (SELECT *, row_number() OVER (PARTITION BY map_user_id
                     ORDER BY l_extendedprice DESC, parent_asin) AS place FROM predictions)
        WHERE place <= 5 GROUP BY map_user_id""",
    "split_counts": f"SELECT split, count(*) AS n FROM ({_ROW_SPLIT}) GROUP BY split",
    "roc_auc": _AUC.format(rows="SELECT * FROM scored"),
    "bce_logits_loss": f"SELECT {_STABLE_LOSS} AS loss FROM scored",
    "next_model_version": """
        SELECT CAST(coalesce(arg_max(version, timestamp) + 1, 0) AS INTEGER) AS next_version
        FROM versions""",
    # order, ranks, positions
    "rank_predictions": """
        SELECT map_user_id, parent_asin, l_quantity AS predicted_rating,
               CAST(rank() OVER (PARTITION BY map_user_id ORDER BY l_quantity DESC) AS BIGINT) AS rank
        FROM predictions""",
    "topk_per_user": """
        SELECT * FROM (
            SELECT map_user_id, parent_asin, l_quantity AS predicted_rating,
                   CAST(rank() OVER (PARTITION BY map_user_id ORDER BY l_quantity DESC) AS INTEGER) AS rank
            FROM predictions) WHERE rank <= 5""",
    "topk_per_user_exact": """
        SELECT * FROM (
            SELECT map_user_id, parent_asin, l_quantity AS predicted_rating, CAST(row_number() OVER (
                   PARTITION BY map_user_id ORDER BY l_quantity DESC, parent_asin) AS INTEGER) AS rank
            FROM predictions) WHERE rank <= 5""",
    "topk_repeated_requests": """
        SELECT map_user_id, parent_asin, predicted_rating, rank, count(*) AS copies FROM (
            SELECT map_user_id, parent_asin, l_extendedprice AS predicted_rating, id, CAST(rank() OVER (
                   PARTITION BY map_user_id ORDER BY l_extendedprice DESC) AS INTEGER) AS rank
            FROM (SELECT *, row_number() OVER () AS id FROM predictions)
                 JOIN events ON user_id = map_user_id)
        WHERE rank <= 200 GROUP BY map_user_id, parent_asin, predicted_rating, rank, id""",
    "latest_model_version": "SELECT * FROM versions ORDER BY timestamp DESC, version DESC LIMIT 1",
    "last_registered_model": "SELECT * FROM versions ORDER BY version DESC LIMIT 1",
    "current_model_version": """
        SELECT model, timestamp, version FROM versions ORDER BY timestamp DESC, version DESC LIMIT 1""",
    "sort_by_time": f"SELECT {_MESSAGE_COLUMNS} FROM ratings ORDER BY timestamp, user_id, parent_asin",
    "row_position": """
        SELECT parent_asin, user_id, row_number() OVER (ORDER BY parent_asin, user_id) - 1 AS position
        FROM ratings""",
    "temporal_split": f"""
        SELECT {_MESSAGE_COLUMNS}, CASE WHEN place < floor(0.8 * n) THEN 'train' ELSE 'validation' END AS split
        FROM ({_BY_TIME})""",
    "tail_fraction": f"SELECT {_MESSAGE_COLUMNS} FROM ({_BY_TIME}) WHERE place >= floor(0.9 * n)",
    # unions, sampling
    "union_stream_history": f"""
        SELECT CAST(timestamp AS BIGINT) AS timestamp, CAST(rating AS DOUBLE) AS rating, user_id, parent_asin
        FROM actions UNION ALL SELECT {_MESSAGE_COLUMNS} FROM ratings""",
    "union_missing_columns": """
        SELECT parent_asin, user_id, NULL::BIGINT AS timestamp, NULL::DOUBLE AS rating FROM actions
        UNION ALL SELECT parent_asin, user_id, timestamp, rating FROM ratings""",
    "train_test_split": _ROW_SPLIT,
    "negative_sampling": _negatives(1),
    "negative_sampling_k3": _negatives(3),
    "negative_sampling_strict": _negatives(
        1,
        """WHERE (u.user_id, i.parent_asin, i.store) NOT IN (
               SELECT (user_id, parent_asin, store) FROM labelled WHERE label = 1)""",
    ),
    "sample_with_replacement": """
        SELECT id AS draw, value
        FROM (SELECT id, CAST('0x' || substr(md5(concat_ws('|', '42', CAST(id AS VARCHAR))), 1, 15) AS BIGINT)
                     % (SELECT max(idx) + 1 FROM user_map) AS pick FROM range(50) r(id))
             JOIN user_map ON idx = pick""",
    "sample_rows": f"""
        SELECT {_MESSAGE_COLUMNS} FROM ratings
        ORDER BY md5(concat_ws('|', '42', CAST(timestamp AS VARCHAR), CAST(rating AS VARCHAR), user_id,
                 parent_asin)) LIMIT 10""",
    "minibatch_assignment": """
        SELECT user_id, parent_asin, store, label, position, position // 16 AS batch
        FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42-epoch-0', user_id, parent_asin,
                     store, CAST(label AS VARCHAR), CAST(copy AS VARCHAR)))) - 1 AS position
              FROM (SELECT *, row_number() OVER (PARTITION BY user_id, parent_asin, store, label) - 1 AS copy
                    FROM labelled))""",
    # models
    "fm_cross_term": """
        SELECT vec_id, 0.5::DOUBLE * (pow(list_sum(v), 2) - list_sum([x * x for x in v])) AS cross_term
        FROM (SELECT vec_id, [floor(CAST(x AS DOUBLE) * 100.0::DOUBLE) for x in embedding] AS v
              FROM embeddings)""",
    "embedding_lookup": """
        SELECT e.user_id, e.parent_asin, e.store,
               array_to_string(list_concat(u.vector, i.vector, s.vector), ',') AS vector
        FROM encoded e JOIN vectors u ON u.feature = 'user_id_map' AND u.idx = e.user_id
             JOIN vectors i ON i.feature = 'parent_id_map' AND i.idx = e.parent_asin
             JOIN vectors s ON s.feature = 'store_id_map' AND s.idx = e.store""",
    "batch_predict": f"""
        SELECT user_id, parent_asin, store, CAST(logit AS FLOAT) AS predicted_rating FROM ({_LINEAR})""",
    "evaluate_model": f"""
        WITH scored_rows AS (
            SELECT logit, CASE WHEN rating >= 4.5 THEN 1 ELSE 0 END AS label FROM ({_LINEAR}))
        SELECT (SELECT {_STABLE_LOSS} FROM scored_rows) AS loss,
               ({_AUC.format(rows="SELECT * FROM scored_rows")}) AS roc_auc""",
    "deepfm_score": "SELECT user_id, parent_asin, store, logit FROM " + _NETWORK.format(rows="""
        (SELECT e.user_id, e.parent_asin, e.store, list_concat(u.vector, i.vector, s.vector) AS v
         FROM encoded e JOIN vectors u ON u.feature = 'user_id_map' AND u.idx = e.user_id
             JOIN vectors i ON i.feature = 'parent_id_map' AND i.idx = e.parent_asin
             JOIN vectors s ON s.feature = 'store_id_map' AND s.idx = e.store)"""),
    "train_deepfm": _TRAINED.format(model="DeepFM"),
    "train_fm": _TRAINED.format(model="FM"),
    "retrain": _REGISTERED,
    "stream_retrain": _REGISTERED,
    "sink_sampled_users": """
        SELECT value FROM (SELECT id, CAST('0x' || substr(md5(concat_ws('|', '42', CAST(id AS VARCHAR))), 1, 15) AS BIGINT)
                   % (SELECT count(*) FROM user_map) AS idx FROM range(50) r(id)) d
        JOIN user_map ON user_map.idx = d.idx""",
    "recommend_latest_model": """
        SELECT user_id, string_agg(asin, ',' ORDER BY place, asin) AS recommendations
        FROM (SELECT user_id, asin, rank() OVER (PARTITION BY user_id ORDER BY logit DESC) AS place
              FROM """ + _NETWORK.format(rows="""
                (SELECT u.user_id, i.asin, list_concat(u.vector, i.vector) AS v
                 FROM users u CROSS JOIN items i WHERE u.user_id IN (SELECT user_id FROM actions))""") + """)
        WHERE place <= 5 GROUP BY user_id""",
    "registry_roundtrip": """
        SELECT feature, count(*) AS n, 1 AS version, 'v2' AS maps_version FROM maps GROUP BY feature""",
    # jobs
    "ingest_collections": """
        SELECT parent_asin, timestamp, rating, user_id, store
        FROM ratings JOIN metadata USING (parent_asin)""",
    "prepare_dataset": "SELECT parent_asin, timestamp, rating, user_id, store FROM encoded",
    "recommend_topk": _RECOMMENDED,
    "unknown_requests": """
        SELECT 'U' || (c_custkey * 2) AS user_id FROM customer
        WHERE 'U' || (c_custkey * 2) NOT IN (SELECT user_id FROM joined)""",
    "candidate_scoring": f"""
        SELECT * FROM (
            SELECT map_user_id, parent_asin, store_id, predicted_rating, CAST(row_number() OVER (
                   PARTITION BY map_user_id ORDER BY predicted_rating DESC, parent_asin) AS INTEGER) AS rank
            FROM ({_ALL_PAIRS})) WHERE rank <= 3""",
    # streams
    "stream_requests": "SELECT user_id FROM actions",
    "stream_actions": f"SELECT {_MESSAGE_COLUMNS} FROM actions",
    "stream_recommend": _RECOMMENDED,
    "stream_restart": """
        SELECT 'U' || user_id AS user_id, 'ID_U' || user_id AS recommendations,
               CAST(max(CASE WHEN event_type = 'click' THEN 0 ELSE 1 END) AS BIGINT) AS batch_id
        FROM events GROUP BY user_id""",
}


def _complete(sql: str) -> str:
    text = sql.strip()
    if text.startswith("WITH "):
        return _with(text).replace(f" {text}", ", " + text[len("WITH "):], 1)
    return _with(text)


ORACLE_SQL = {name: _complete(sql) for name, sql in _ORACLE.items()}
