"""The registered queries once more, as SQL over the given tables.

Written independently of the Spark plans: joins are made row by row where the library
joins counts, rolling sums where it shares windows, and so on.
"""

from __future__ import annotations

from shelfwise.catalog.tables import ACTIONS, TRAIN_END, VALID_END

# Category lists of the given tables at the checked scale.
COLORS = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
MATERIALS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
STATUSES = ("canceled_orders", "delivered_orders")

_LOGS = """
tracker AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         ts, CAST(ts AS DATE) AS d, CAST(floor(epoch(ts)) AS BIGINT) AS sec, event_id,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'view_description'
              WHEN 'signup' THEN 'favorite' WHEN 'purchase' THEN 'to_cart' ELSE 'remove' END AS action_type,
         event_type AS action_widget
  FROM events),
purchases AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         ts AS created_timestamp, CAST(floor(epoch(ts)) AS BIGINT) AS sec, event_id,
         CASE WHEN event_id % 4 = 3 THEN 'canceled_orders' ELSE 'delivered_orders' END AS last_status,
         CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS last_status_timestamp
  FROM events WHERE event_type = 'purchase'),
joined AS (
  SELECT t.*, o.last_status, o.created_sec
  FROM tracker t LEFT JOIN (
    SELECT user_id, item_id, CAST(last_status_timestamp AS DATE) AS d, last_status, sec AS created_sec
    FROM purchases) o
  ON t.user_id = o.user_id AND t.item_id = o.item_id AND t.d = o.d)"""

_ITEMS = """
items AS (
  SELECT p_partkey AS item_id, p_size AS catalogid, p_partkey % 97 AS variant_id, p_partkey % 31 AS model_id,
         p_name AS itemname, e.embedding AS fclip_embed, p_type, p_brand
  FROM part LEFT JOIN embeddings e ON p_partkey = e.vec_id),
attrs AS (
  SELECT item_id, pos, attr_name, attr_value, is_aspect, 1 - is_aspect AS show_char FROM (
    SELECT item_id, catalogid, 0 AS pos, 'Type' AS attr_name, p_type AS attr_value, 0 AS is_aspect FROM items
    UNION ALL SELECT item_id, catalogid, 1, 'Brand', p_brand, 0 FROM items
    UNION ALL SELECT item_id, catalogid, 2, 'ColorBase', split_part(itemname, ' ', 1), 1 FROM items
    UNION ALL SELECT item_id, catalogid, 3, 'Material', split_part(itemname, ' ', 2), 1 FROM items)
  WHERE catalogid <= 45),
freq AS (SELECT attr_name, attr_value, count(*) AS freq FROM attrs GROUP BY ALL),
cut AS (SELECT greatest(1, CAST(floor((SELECT count(*) FROM items) * {share}) AS BIGINT)) AS at_least),
frequent AS (SELECT f.* FROM freq f, cut WHERE f.freq >= at_least)"""

_COMBINED = """CASE WHEN last_status = 'delivered_orders' THEN 5.0 WHEN action_type = 'to_cart' THEN 3.0
  WHEN action_type = 'favorite' THEN 3.0 WHEN action_type = 'view_description' THEN 1.0
  WHEN action_type = 'review_view' THEN 1.0 ELSE 0.0 END"""

# Ratings need clicks and orders of the training period only.
_RATED = f"""
rated AS (
  SELECT user_id, item_id, CAST(sum(label) AS DOUBLE) AS rating FROM (
    SELECT t.user_id, t.item_id, {_COMBINED} AS label
    FROM (SELECT * FROM tracker WHERE sec <= {TRAIN_END}) t LEFT JOIN (
      SELECT user_id, item_id, CAST(last_status_timestamp AS DATE) AS d, last_status
      FROM purchases WHERE sec <= {TRAIN_END}) o
    ON t.user_id = o.user_id AND t.item_id = o.item_id AND t.d = o.d)
  WHERE label > 0 GROUP BY ALL),
pop AS (SELECT item_id, sum(rating) AS score FROM rated GROUP BY ALL),
popular AS (SELECT row_number() OVER (ORDER BY score DESC, item_id) AS rank, item_id, score
  FROM (SELECT item_id, coalesce(score, 0) AS score FROM (SELECT DISTINCT item_id FROM tracker WHERE sec <= {TRAIN_END}) LEFT JOIN pop USING (item_id))),
truth AS (
  SELECT DISTINCT user_id, item_id FROM purchases
  WHERE last_status = 'delivered_orders' AND sec > {TRAIN_END} AND sec <= {VALID_END}),
known AS (SELECT DISTINCT user_id FROM tracker WHERE sec <= {TRAIN_END}),
users AS (SELECT c_custkey AS user_id FROM customer)"""


def _logs(body: str, *more: str) -> str:
    return "WITH " + ",".join([_LOGS, *more]) + "\n" + body


def _items(body: str, share: float, *more: str) -> str:
    return "WITH " + ",".join([_ITEMS.format(share=share), *more]) + "\n" + body


def _day(col: str = "d") -> str:
    return f"strftime({col}, '%Y-%m-%d') AS date"


def _six(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {name}"


def _big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def _count_if(action: str) -> str:
    return f"sum(CASE WHEN action_type = '{action}' THEN 1 ELSE 0 END)"


_DAILY_WIDE = "daily AS (SELECT d, user_id, item_id, " + ", ".join(
    f"{_count_if(a)} AS cnt_{a}" for a in ACTIONS
) + " FROM tracker GROUP BY ALL)"


def _rolling(direction: str) -> str:
    frame = {"past": "{w} PRECEDING AND 1 PRECEDING", "forward": "CURRENT ROW AND {m} FOLLOWING"}[direction]
    sums = []
    for w in (14, 7, 1):
        between = frame.format(w=w, m=w - 1)
        for a in ACTIONS:
            over = f"PARTITION BY user_id, item_id ORDER BY d - DATE '1970-01-01' RANGE BETWEEN {between}"
            sums.append(f"CAST(coalesce(sum(cnt_{a}) OVER ({over}), 0) AS BIGINT) AS cnt_{a}_sum_{w}d_past")
    return "rolling AS (SELECT d, user_id, item_id, " + ", ".join(sums) + " FROM daily)"


_ROLLED = [f"cnt_{a}_sum_{w}d_past" for w in (14, 7, 1) for a in ACTIONS]


def _target(label_true: str, horizon: int | None) -> str:
    limit = f"AND f.first_pos <= b.d + INTERVAL {horizon} DAY" if horizon else ""
    return f"""
    base AS (SELECT DISTINCT d, user_id, item_id FROM tracker),
    firsts AS (SELECT user_id, item_id, min(d) AS first_pos FROM joined WHERE {label_true} GROUP BY ALL),
    target AS (SELECT b.d, b.user_id, b.item_id,
      CASE WHEN f.first_pos >= b.d {limit} THEN 1 ELSE 0 END AS target
      FROM base b LEFT JOIN firsts f ON b.user_id = f.user_id AND b.item_id = f.item_id),
    best AS (SELECT user_id, item_id, max(target) AS target FROM target GROUP BY ALL)"""


_DELIVERED = "last_status = 'delivered_orders'"
_DELIVERED_OR_CART = "(last_status = 'delivered_orders' OR action_type = 'to_cart')"

_PAIRS = "pairs AS (SELECT user_id, item_id, " + ", ".join(
    f"{_big(_count_if(a), a)}" for a in ACTIONS
) + " FROM tracker GROUP BY ALL)"
_LATEST = """latest AS (SELECT user_id, item_id, last_status FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id
      ORDER BY last_status_timestamp DESC, last_status DESC) AS rn FROM purchases) WHERE rn = 1)"""
_PAIR_FEATURES = (
    "pf AS (SELECT l.user_id, l.item_id, l.last_status, "
    + ", ".join(f"coalesce(p.{a}, 0) AS {a}" for a in ACTIONS)
    + " FROM latest l LEFT JOIN pairs p ON l.user_id = p.user_id AND l.item_id = p.item_id)"
)


def _rates(signals: dict[str, str]) -> str:
    rows = []
    for name, cond in signals.items():
        rows.append(
            f"SELECT '{name}' AS signal, count(*) AS n_pairs, "
            f"{_six('avg(CASE WHEN last_status = $$delivered_orders$$ THEN 1.0 ELSE 0.0 END)', 'delivered_rate')}, "
            f"{_six('avg(CASE WHEN last_status = $$canceled_orders$$ THEN 1.0 ELSE 0.0 END)', 'canceled_rate')} "
            f"FROM pf WHERE {cond}"
        )
    return " UNION ALL ".join(rows)


def _correlations() -> str:
    rows = []
    for a in ACTIONS:
        raw, log = f"corr(y, {a})", f"corr(y, ln(1 + {a}))"
        clean = [f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END" for c in (raw, log)]
        rows.append(
            f"SELECT '{a}' AS feature, {_six(clean[0], 'pearson')}, {_six(clean[1], 'pearson_log1p')}, "
            f"{_six(f'abs({clean[0]})', 'abs_pearson')}, {_six(f'abs({clean[1]})', 'abs_pearson_log1p')} FROM y"
        )
    y = "y AS (SELECT *, CASE WHEN last_status = 'delivered_orders' THEN 1.0 ELSE 0.0 END AS y FROM pf)"
    return _logs(" UNION ALL ".join(rows), _PAIRS, _LATEST, _PAIR_FEATURES, y)


_CELLS = """
observed AS (SELECT action_type, last_status, count(*) AS o FROM joined GROUP BY ALL),
grid AS (
  SELECT a.action_type, s.last_status, coalesce(o.o, 0) AS o
  FROM (SELECT DISTINCT action_type FROM observed) a CROSS JOIN (SELECT DISTINCT last_status FROM observed) s
  LEFT JOIN observed o ON a.action_type IS NOT DISTINCT FROM o.action_type AND s.last_status IS NOT DISTINCT FROM o.last_status),
cells AS (
  SELECT g.*, n, r * c / n AS e, r / n * (c / n) AS chance FROM grid g
  JOIN (SELECT action_type, CAST(sum(o) AS DOUBLE) AS r FROM grid GROUP BY ALL) rs ON g.action_type IS NOT DISTINCT FROM rs.action_type
  JOIN (SELECT last_status, CAST(sum(o) AS DOUBLE) AS c FROM grid GROUP BY ALL) cs ON g.last_status IS NOT DISTINCT FROM cs.last_status,
  (SELECT CAST(sum(o) AS DOUBLE) AS n FROM grid))"""

_IDS = f"""
base AS (SELECT DISTINCT d, user_id, item_id FROM tracker),
umap AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx
         FROM (SELECT DISTINCT user_id FROM tracker WHERE {{seen}})),
imap AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS item_idx
         FROM (SELECT DISTINCT item_id FROM tracker WHERE {{seen}})),
indexed AS (SELECT b.*, user_idx, item_idx FROM base b JOIN umap USING (user_id) JOIN imap USING (item_id))"""
_HISTORY = """
history AS (SELECT *, list(item_idx) OVER (PARTITION BY user_idx ORDER BY d, item_idx
    ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS seq FROM indexed)"""


def _text(seq: str) -> str:
    return f"coalesce(array_to_string({seq}, ' '), '')"


def _split_rows(conditions: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{split}' AS split, user_id, item_id, sec "
        f"FROM {'tracker' if table == 'tracker' else 'purchases'} WHERE {cond}"
        for table, split, cond in conditions
    )


_IN_TRAIN = f"sec <= {TRAIN_END}"
_IN_VALID = f"sec > {TRAIN_END} AND sec <= {VALID_END}"
_BUCKET = "(((user_id + 17) % 800) + 800) % 800"

_MICRO = "list_transform({v}, lambda x: CAST(round(CAST(x AS DOUBLE) * 1e6, 0) AS BIGINT))"


def _metrics(predictions: str) -> str:
    """Recall and NDCG of a (user_id, rank, item_id) relation against truth."""
    per_user, rows = [], []
    for k in (5, 10, 20):
        per_user.append(
            f"count(CASE WHEN hit AND rank <= {k} THEN 1 END) / CAST(any_value(n_truth) AS DOUBLE) AS recall_at_{k}, "
            f"sum(CASE WHEN hit AND rank <= {k} THEN 1.0 / log2(rank + 1) ELSE 0.0 END) / any_value("
            f"(SELECT sum(1.0 / log2(i + 1)) FROM range(1, 1 + {k}) r(i) WHERE i <= n_truth)) AS ndcg_at_{k}"
        )
        for m in ("recall", "ndcg"):
            rows.append(f"SELECT '{m}_at_{k}' AS metric, {_six(f'coalesce(avg({m}_at_{k}), 0)', 'value')} FROM scored")
    return f"""
    preds AS ({predictions}),
    truths AS (SELECT user_id, count(*) AS n_truth FROM truth GROUP BY ALL),
    marked AS (SELECT p.user_id, p.rank, n_truth, t.item_id IS NOT NULL AS hit
      FROM preds p JOIN truths USING (user_id)
      LEFT JOIN truth t ON p.user_id = t.user_id AND p.item_id = t.item_id),
    scored AS (SELECT user_id, {', '.join(per_user)} FROM marked GROUP BY user_id)
    {' UNION ALL '.join(rows)}"""


def _with_metrics(predictions: str) -> str:
    return "WITH " + ",".join([_LOGS, _RATED, _metrics(predictions)])


_USER_TOP = """
ranked AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank,
  item_id, rating AS score FROM rated)"""


def _fallback(n: int) -> str:
    return f"""
    own AS (SELECT user_id, rank, item_id, score FROM ranked WHERE rank <= {n}
      AND user_id IN (SELECT user_id FROM known) AND user_id IN (SELECT user_id FROM users)),
    listed AS (
      SELECT * FROM own
      UNION ALL
      SELECT u.user_id, p.rank, p.item_id, p.score
      FROM (SELECT user_id FROM users WHERE user_id NOT IN (SELECT user_id FROM own)) u,
           (SELECT * FROM popular WHERE rank <= {n}) p)"""


_DELIVERED_POPULAR = f"""
bought AS (
  SELECT t.item_id, count(*) AS score FROM tracker t JOIN purchases o
  ON t.user_id = o.user_id AND t.item_id = o.item_id AND t.d = CAST(o.last_status_timestamp AS DATE)
  WHERE t.sec <= {TRAIN_END} AND o.sec <= {TRAIN_END} AND o.last_status = 'delivered_orders' GROUP BY ALL),
wanted AS (SELECT row_number() OVER (ORDER BY coalesce(score, 0) DESC, item_id) AS rank, item_id
  FROM (SELECT DISTINCT item_id FROM tracker WHERE sec <= {TRAIN_END}) LEFT JOIN bought USING (item_id))"""


def _facts(with_vector: str, popular: str = "popular") -> str:
    """Facts of complete lists of 20, given the users that a model has a vector of."""
    return f"""SELECT user_id, CAST(n AS BIGINT) AS n_items, CAST(n AS BIGINT) AS n_distinct, CAST(1 AS BIGINT) AS first_rank,
      CAST(n AS BIGINT) AS last_rank, CAST(1 AS BIGINT) AS falls,
      CASE WHEN user_id NOT IN ({with_vector}) THEN top END AS cold_list
      FROM users, (SELECT count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY rank) AS top FROM {popular} WHERE rank <= 20)"""


_LISTS = "user_id, CAST(rank AS BIGINT) AS rank, item_id, " + _six("score", "score")

_DELIVERED_PAIRS = f"""
liked AS (
  SELECT DISTINCT t.user_id, t.item_id FROM tracker t JOIN purchases o
  ON t.user_id = o.user_id AND t.item_id = o.item_id AND t.d = CAST(o.last_status_timestamp AS DATE)
  WHERE t.sec <= {TRAIN_END} AND o.sec <= {TRAIN_END} AND o.last_status = 'delivered_orders'),
pos AS (SELECT user_idx, item_idx FROM liked JOIN umap USING (user_id) JOIN imap USING (item_id)),
drawn AS (SELECT *, CAST('0x' || substr(md5(user_idx || ':' || item_idx || ':0:42'), 1, 15) AS BIGINT)
  % (SELECT count(*) FROM imap) AS neg_idx FROM pos)"""

_VIEW = (
    "feats AS (SELECT t.d, t.user_id, t.item_id, b.target, r.cnt_to_cart_sum_7d_past FROM target t "
    "JOIN best b ON t.user_id = b.user_id AND t.item_id = b.item_id "
    "JOIN rolling r ON t.d = r.d AND t.user_id = r.user_id AND t.item_id = r.item_id)"
)
_ROLL_PAST = [_DAILY_WIDE, _rolling("past")]
_FEATURE_PARTS = [_target(_DELIVERED, None), *_ROLL_PAST]


def _view(where: str = "") -> str:
    return _logs(
        f"""SELECT f.user_id, f.item_id, {_day('f.d')}, CAST(target AS BIGINT) AS target, cnt_to_cart_sum_7d_past,
        CAST(p_size AS VARCHAR) AS catalogid, CAST(p_partkey % 97 AS VARCHAR) AS variant_id,
        CAST(p_partkey % 31 AS VARCHAR) AS model_id, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
        FROM feats f LEFT JOIN part ON f.item_id = p_partkey LEFT JOIN customer ON f.user_id = c_custkey {where}""",
        *_FEATURE_PARTS,
        _VIEW,
    )


def _flags(prefix: str, attr: str, values: tuple[str, ...]) -> str:
    return ", ".join(
        f"CAST(coalesce(max(CASE WHEN attr_name = '{attr}' AND attr_value = '{v}' THEN 1 ELSE 0 END), 0) AS BIGINT)"
        f" AS {prefix}_{v}"
        for v in values
    )


_KEPT = "kept AS (SELECT a.* FROM attrs a JOIN frequent f ON a.attr_name = f.attr_name AND a.attr_value = f.attr_value)"


def _main(attr: str) -> str:
    return f"min(CASE WHEN attr_name = '{attr}' THEN attr_value END) AS {attr.lower()}_main"


_ALL_FLAGS = _flags("color", "ColorBase", COLORS) + ", " + _flags("material", "Material", MATERIALS)



def _drawn(side: int, factors: int, ids: str, idx: str, name: str) -> str:
    """Rows (id, idx, d, v) of start vectors; users are side 0, items side 1."""
    value = f"(CAST('0x' || substr(md5('{side}:' || {idx} || ':' || d || ':42'), 1, 15) AS BIGINT) % 1048576) / CAST(1048576 AS DOUBLE) - 0.5"
    return f"{name} AS (SELECT {ids}.*, d, CAST(CAST((CAST({value} AS DOUBLE)) / {factors} AS FLOAT) AS DOUBLE) AS v FROM {ids}, range({factors}) AS r(d))"


# Half a step of ALS with two factors, solved by Cramer's rule.
_HALF_STEP = [
    _IDS.format(seen=_IN_TRAIN),
    _drawn(1, 2, "imap", "item_idx", "iv"),
    "wide_items AS (SELECT item_id, any_value(v) FILTER (d = 0) AS a, any_value(v) FILTER (d = 1) AS b FROM iv GROUP BY item_id)",
    """sides AS (
      SELECT user_id, g.aa + sum(0.5 * rating * a * a) + 0.05 * count(*) AS aa, g.ab + sum(0.5 * rating * a * b) AS ab,
        g.bb + sum(0.5 * rating * b * b) + 0.05 * count(*) AS bb, sum((1 + 0.5 * rating) * a) AS ra, sum((1 + 0.5 * rating) * b) AS rb
      FROM rated JOIN wide_items USING (item_id), (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM wide_items) g
      GROUP BY user_id, g.aa, g.ab, g.bb)""",
    """solved AS (SELECT user_id, (ra * bb - rb * ab) / (aa * bb - ab * ab) AS x, (rb * aa - ra * ab) / (aa * bb - ab * ab) AS y FROM sides)""",
    """half_lists AS (
      SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
      FROM (SELECT user_id, item_id, x * a + y * b AS score FROM solved, wide_items WHERE user_id IN (SELECT user_id FROM truth))
      UNION ALL
      SELECT u.user_id, p.item_id, p.score, p.rank FROM (SELECT DISTINCT user_id FROM truth WHERE user_id NOT IN (SELECT user_id FROM solved)) u, popular p)""",
]

# One step from drawn vectors along the whole gradient.
_FIRST_STEP = [
    _IDS.format(seen=_IN_TRAIN),
    _DELIVERED_PAIRS,
    """triples AS (SELECT row_number() OVER () AS t, user_idx, item_idx, neg_idx FROM drawn d WHERE NOT EXISTS (
      SELECT 1 FROM pos p WHERE p.user_idx = d.user_idx AND p.item_idx = d.neg_idx))""",
    _drawn(0, 4, "umap", "user_idx", "uv"),
    _drawn(1, 4, "imap", "item_idx", "iv"),
    """vecs AS (
      SELECT 0 AS side, user_idx AS idx, d, v FROM uv UNION ALL SELECT 0, user_idx, 4, 1.0 FROM umap
      UNION ALL SELECT 1, item_idx, d, v FROM iv UNION ALL SELECT 1, item_idx, 4, 0.0 FROM imap)""",
    """gaps AS (
      SELECT t, user_idx, item_idx, neg_idx, sum(u.v * (i.v - j.v)) AS gap FROM triples
      JOIN vecs u ON u.side = 0 AND u.idx = user_idx JOIN vecs i ON i.side = 1 AND i.idx = item_idx AND i.d = u.d
      JOIN vecs j ON j.side = 1 AND j.idx = neg_idx AND j.d = u.d GROUP BY ALL)""",
    """moves AS (
      SELECT 0 AS side, user_idx AS idx, i.d, (i.v - j.v) / (1 + exp(gap)) AS change FROM gaps
        JOIN vecs i ON i.side = 1 AND i.idx = item_idx JOIN vecs j ON j.side = 1 AND j.idx = neg_idx AND j.d = i.d
      UNION ALL SELECT 1, item_idx, u.d, u.v / (1 + exp(gap)) FROM gaps JOIN vecs u ON u.side = 0 AND u.idx = user_idx
      UNION ALL SELECT 1, neg_idx, u.d, -u.v / (1 + exp(gap)) FROM gaps JOIN vecs u ON u.side = 0 AND u.idx = user_idx)""",
    """stepped AS (
      SELECT side, idx, d, n, CASE WHEN side = 0 AND d = 4 THEN 1.0 WHEN n IS NULL THEN v ELSE v + 0.5 * (total / n - 0.01 * v) END AS v
      FROM vecs LEFT JOIN (SELECT side, idx, d, sum(change) AS total, count(*) AS n FROM moves GROUP BY ALL) USING (side, idx, d))""",
]


def _loss(vectors: str) -> str:
    return f"""(SELECT t, sum(u.v * (i.v - j.v)) AS gap FROM triples
      JOIN {vectors} u ON u.side = 0 AND u.idx = user_idx JOIN {vectors} i ON i.side = 1 AND i.idx = item_idx AND i.d = u.d
      JOIN {vectors} j ON j.side = 1 AND j.idx = neg_idx AND j.d = u.d GROUP BY t)"""


_DICTIONARY = "dictionary AS (SELECT row_number() OVER (ORDER BY attr_name, attr_value) - 1 AS value_id, attr_name, attr_value, freq FROM freq)"
_VALUE_IDS = "array_to_string(list_sort(list(DISTINCT value_id)), ' ')"

ORACLES: dict[str, str] = {
    "scan_project": "SELECT event_id, user_id, event_type FROM events",
    "scan_glob_counts": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in ("customer", "events", "orders", "part")
    ),
    "test_users": "SELECT DISTINCT user_id FROM events",
    "shard_counts": "SELECT ((user_id % 64) + 64) % 64 AS shard, count(*) AS n_rows FROM events GROUP BY ALL",
    "submission": _logs(
        """SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY rank)
           AS "item_id_1 item_id_2 ... item_id_100" FROM listed GROUP BY user_id""",
        _RATED,
        _USER_TOP,
        _fallback(100),
    ),
    "infer_submission": _logs(
        """, scored AS (SELECT u.vec_id AS user_id, i.vec_id AS item_id,
            list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score FROM embeddings u, embeddings i),
        best AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scored),
        fallback AS (SELECT item_id, row_number() OVER (ORDER BY coalesce(score, 0) DESC, item_id) AS rank
          FROM (SELECT vec_id AS item_id FROM embeddings) LEFT JOIN pop USING (item_id)),
        lists AS (SELECT * FROM best WHERE rank <= 20 AND user_id IN (SELECT user_id FROM users)
          UNION ALL SELECT u.user_id, f.item_id, f.rank FROM users u, fallback f
          WHERE f.rank <= 20 AND u.user_id NOT IN (SELECT vec_id FROM embeddings))
        SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY rank)
          AS "item_id_1 item_id_2 ... item_id_100" FROM lists GROUP BY user_id""",
        _RATED,
    ).replace("\n, scored AS", ",\nscored AS"),
    "item_base": _items(
        f"""SELECT item_id, array_to_string({_MICRO.format(v='fclip_embed')}, ' ') AS fclip_embed,
        CAST(catalogid AS VARCHAR) AS catalogid, CAST(variant_id AS VARCHAR) AS variant_id,
        CAST(model_id AS VARCHAR) AS model_id FROM items""",
        0.01,
    ),
    "epoch_filter": _logs(f"SELECT user_id, item_id, sec FROM tracker WHERE sec > {TRAIN_END}"),
    "user_bucket": f"""SELECT user_id, {_BUCKET} AS bucket,
        (((-user_id - 40 + 17) % 800) + 800) % 800 AS bucket_of_negative
        FROM (SELECT DISTINCT user_id FROM events)""",
    "coerce_features": _items(
        f"""SELECT item_id, {_six('catalogid', 'as_float')}, CAST(variant_id AS VARCHAR) AS as_token_seq,
        coalesce(TRY_CAST(mixed AS BIGINT), 0) AS as_token,
        {_six('coalesce(fclip_embed[1], 0)', 'first_component')},
        coalesce(array_to_string({_MICRO.format(v='fclip_embed')}, ' '), '') AS as_float_seq,
        {_six('TRY_CAST(mixed AS FLOAT)', 'label')},
        CAST(TRY_CAST('2024-01-' || lpad(CAST(catalogid AS VARCHAR), 2, '0') AS DATE) - DATE '1970-01-01' AS BIGINT) AS day
        FROM (SELECT *, CASE WHEN catalogid < 25 THEN CAST(catalogid AS VARCHAR) ELSE itemname END AS mixed FROM items)""",
        0.01,
    ),
    "safe_attr_names": _items(
        """SELECT attr_value, translate(lower(attr_value), ' -/', '___') AS safe FROM (
        SELECT DISTINCT attr_value FROM attrs UNION SELECT DISTINCT o_orderpriority FROM orders)""",
        0.01,
    ),
    "item_attrs_long": _items(
        """SELECT item_id, CAST(pos AS BIGINT) AS pos, attr_name, attr_value, CAST(is_aspect AS BIGINT) AS is_aspect,
        CAST(show_char AS BIGINT) AS show_char FROM attrs""",
        0.01,
    ),
    "labels_all": _logs(
        f"""SELECT user_id, item_id, {_day()}, action_type, last_status,
        {_six(f"CAST(action_type = 'to_cart' AND {_DELIVERED} AS INT)", "to_cart_and_delivered")},
        {_six("CAST(action_type = 'to_cart' AS INT)", "to_cart")},
        {_six(f"CAST({_DELIVERED} AS INT)", "delivered")},
        {_six(_COMBINED, "combined")},
        {_six(f"CASE WHEN {_DELIVERED} OR action_type IN ('to_cart', 'favorite') THEN 1 ELSE 0 END", "combined2")},
        {_big(f"CAST({_DELIVERED} AS INT)", "target_delivered")},
        {_big(f"CASE WHEN {_DELIVERED_OR_CART} THEN 1 ELSE 0 END", "target_combined")} FROM joined"""
    ),
    "split_time": _logs(
        _split_rows([(t, s, c) for t in ("tracker", "orders") for s, c in (("train", _IN_TRAIN), ("valid", _IN_VALID))])
    ),
    "split_time_user": _logs(
        _split_rows(
            [
                (t, s, c)
                for t in ("tracker", "orders")
                for s, c in (("train", f"{_IN_TRAIN} AND {_BUCKET} >= 80"), ("valid", f"{_IN_VALID} AND {_BUCKET} < 80"))
            ]
        )
    ),
    "split_only_train": _logs(_split_rows([("tracker", "train", "true"), ("orders", "train", "true")])),
    "split_fast_users": _logs(
        """SELECT 'tracker' AS table_name, user_id, item_id, sec FROM tracker WHERE user_id IN (SELECT user_id FROM few)
        UNION ALL
        SELECT 'orders', user_id, item_id, sec FROM purchases WHERE user_id IN (SELECT user_id FROM few)""",
        "few AS (SELECT DISTINCT user_id FROM purchases ORDER BY user_id LIMIT 25)",
    ),
    "valid_users": _logs("SELECT DISTINCT user_id FROM truth ORDER BY user_id LIMIT 100", _RATED),
    "tracker_orders_left": _logs(f"SELECT user_id, item_id, {_day()}, sec, action_type, last_status FROM joined"),
    "inter_features": _logs(
        f"""SELECT {_day('t.d')}, t.user_id, t.item_id, CAST(b.target AS BIGINT) AS target,
        {', '.join('r.' + c for c in _ROLLED)} FROM target t
        JOIN best b ON t.user_id = b.user_id AND t.item_id = b.item_id
        LEFT JOIN rolling r ON t.d = r.d AND t.user_id = r.user_id AND t.item_id = r.item_id""",
        *_FEATURE_PARTS,
    ),
    "inter_features_horizon": _logs(
        f"""SELECT {_day('t.d')}, t.user_id, t.item_id, CAST(t.target AS BIGINT) AS target,
        {', '.join('r.' + c for c in _ROLLED)} FROM target t
        LEFT JOIN rolling r ON t.d = r.d AND t.user_id = r.user_id AND t.item_id = r.item_id""",
        _target(_DELIVERED, 3),
        *_ROLL_PAST,
    ),
    "training_view": _view(),
    "training_view_pos": _view("WHERE target > 0"),
    "interactions_indexed": _logs(
        f"SELECT user_id, item_id, {_day()}, user_idx, item_idx FROM indexed", _IDS.format(seen=_IN_TRAIN)
    ),
    "item_attrs_frequent": _items(
        """SELECT attr_name, attr_value, item_id, CAST(pos AS BIGINT) AS pos, CAST(is_aspect AS BIGINT) AS is_aspect,
        CAST(show_char AS BIGINT) AS show_char FROM kept""",
        0.04,
        _KEPT,
    ),
    "pair_features": _logs("SELECT * FROM pf", _PAIRS, _LATEST, _PAIR_FEATURES),
    "cold_users": _logs(
        "SELECT user_id, CAST(user_id IN (SELECT user_id FROM known) AS BIGINT) AS is_known FROM users", _RATED
    ),
    "item_features": _items(
        f"""SELECT i.item_id, CAST(catalogid AS VARCHAR) AS catalogid, CAST(variant_id AS VARCHAR) AS variant_id,
        CAST(model_id AS VARCHAR) AS model_id, {_main('Type')}, {_main('Brand')}, {_ALL_FLAGS},
        count(attr_name) AS n_attributes, CAST(coalesce(sum(is_aspect), 0) AS BIGINT) AS n_aspects,
        CAST(coalesce(sum(show_char), 0) AS BIGINT) AS n_show_characteristics
        FROM items i LEFT JOIN attrs a ON i.item_id = a.item_id GROUP BY 1, 2, 3, 4""",
        0.01,
    ),
    "basis": _logs(f"SELECT DISTINCT {_day()}, user_id, item_id FROM tracker"),
    "daily_actions": _logs(
        f"SELECT {_day()}, user_id, item_id, action_type, count(*) AS cnt FROM tracker GROUP BY ALL"
    ),
    "daily_actions_wide": _logs(
        f"SELECT {_day()}, user_id, item_id, {', '.join(_big(f'cnt_{a}', f'cnt_{a}') for a in ACTIONS)} FROM daily",
        _DAILY_WIDE,
    ),
    "pair_actions_pivot": _logs("SELECT * FROM pairs", _PAIRS),
    "first_positive": _logs(
        "SELECT user_id, item_id, strftime(first_pos, '%Y-%m-%d') AS first_pos_date FROM firsts",
        _target(_DELIVERED, None),
    ),
    "target_horizon": _logs(
        f"SELECT {_day()}, user_id, item_id, CAST(target AS BIGINT) AS target FROM target",
        _target(_DELIVERED_OR_CART, 3),
    ),
    "target_dedup": _logs(
        f"""SELECT {_day('t.d')}, t.user_id, t.item_id, CAST(b.target AS BIGINT) AS target
        FROM target t JOIN best b ON t.user_id = b.user_id AND t.item_id = b.item_id""",
        _target(_DELIVERED_OR_CART, 3),
    ),
    "attr_frequency": _items("SELECT attr_name, attr_value, freq FROM frequent", 0.04),
    "attr_main": _items(
        f"""SELECT a.item_id, min(CASE WHEN f.attr_name = 'Type' THEN f.attr_value END) AS type_main,
        min(CASE WHEN f.attr_name = 'Brand' THEN f.attr_value END) AS brand_main
        FROM attrs a LEFT JOIN frequent f ON a.attr_name = f.attr_name AND a.attr_value = f.attr_value
        GROUP BY a.item_id""",
        0.03,
    ),
    "attr_multihot": _items(f"SELECT item_id, {_ALL_FLAGS} FROM attrs GROUP BY item_id", 0.01),
    "attr_counts": _items(
        """SELECT i.item_id, count(attr_name) AS n_attributes, CAST(coalesce(sum(is_aspect), 0) AS BIGINT) AS n_aspects,
        CAST(coalesce(sum(show_char), 0) AS BIGINT) AS n_show_characteristics
        FROM items i LEFT JOIN attrs a ON i.item_id = a.item_id GROUP BY i.item_id""",
        0.01,
    ),
    "ratings": _logs(f"SELECT user_id, item_id, {_six('rating', 'rating')} FROM rated", _RATED),
    "ratings_binary": _logs(
        "SELECT user_id, item_id, 1.0::DOUBLE AS rating FROM liked", _IDS.format(seen=_IN_TRAIN), _DELIVERED_PAIRS
    ),
    "popularity_weight": _logs(f"SELECT item_id, {_six('score', 'score')} FROM pop", _RATED),
    "popularity_count": _logs(
        f"""SELECT item_id, {_six('count(*)', 'score')}
        FROM (SELECT DISTINCT d, user_id, item_id FROM tracker WHERE {_IN_TRAIN}) GROUP BY item_id"""
    ),
    "value_counts": _logs(
        'SELECT action_widget, count(*) AS "count" FROM tracker GROUP BY ALL HAVING count(*) > 1000'
    ),
    "time_bounds": _logs(
        """SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS "first", strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS "last",
        min(sec) AS first_epoch, max(sec) AS last_epoch, 'tracker' AS table_name FROM tracker
        UNION ALL
        SELECT strftime(min(created_timestamp), '%Y-%m-%d %H:%M:%S'), strftime(max(created_timestamp), '%Y-%m-%d %H:%M:%S'),
        min(sec), max(sec), 'orders' FROM purchases"""
    ),
    "last_status": _logs("SELECT * FROM latest", _LATEST),
    "dedup_keep_last": _logs(
        """SELECT user_id, item_id, last_status FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, item_id ORDER BY created_timestamp DESC, last_status DESC) AS rn FROM purchases) WHERE rn = 1"""
    ),
    "user_features": _logs(f"SELECT DISTINCT user_id FROM tracker WHERE sec <= {VALID_END}"),
    "signal_rates": _logs(_rates({a: f"{a} > 0" for a in ACTIONS}), _PAIRS, _LATEST, _PAIR_FEATURES),
    "any_signal_rate": _logs(
        _rates({"any": "favorite > 0 OR to_cart > 0 OR view_description > 0"}), _PAIRS, _LATEST, _PAIR_FEATURES
    ),
    "rolling_forward": _logs(
        f"SELECT {_day()}, user_id, item_id, {', '.join(_ROLLED)} FROM rolling", _DAILY_WIDE, _rolling("forward")
    ),
    "rolling_past": _logs(
        f"SELECT {_day()}, user_id, item_id, {', '.join(_ROLLED)} FROM rolling", _DAILY_WIDE, _rolling("past")
    ),
    "rolling_stacked": _logs(
        " UNION ALL ".join(
            f"SELECT {_day()}, user_id, item_id, '{w}d' AS \"window\", "
            + ", ".join(c if c.endswith(f"_sum_{w}d_past") else f"CAST(0 AS BIGINT) AS {c}" for c in _ROLLED)
            + " FROM rolling"
            for w in (14, 7, 1)
        ),
        _DAILY_WIDE,
        _rolling("forward"),
    ),
    "user_history": _logs(
        f"""SELECT user_id, item_id, {_day()}, user_idx, item_idx, {_text('seq')} AS item_id_list,
        CAST(coalesce(len(seq), 0) AS BIGINT) AS item_length FROM history""",
        _IDS.format(seen="true"),
        _HISTORY,
    ),
    "user_history_padded": _logs(
        f"""SELECT user_id, item_id, {_day()}, array_to_string(list_concat(
        list_transform(range(0, 12 - coalesce(len(seq), 0)), lambda x: CAST(0 AS BIGINT)),
        list_transform(coalesce(seq, CAST([] AS BIGINT[])), lambda x: x + 1)), ' ') AS padded FROM history""",
        _IDS.format(seen="true"),
        _HISTORY,
    ),
    "float_seq_padded": f"""SELECT vec_id, array_to_string(list_concat(
        list_transform(range(0, 70 - len(embedding)), lambda x: CAST(0 AS BIGINT)), {_MICRO.format(v='embedding')}), ' ') AS padded
        FROM embeddings""",
    "batch_ids": _logs(
        f"""SELECT {_day()}, user_id, item_id, user_id % 16 AS shard, CAST(floor((row_number() OVER (
        PARTITION BY user_id % 16 ORDER BY user_id, d, item_id) - 1) / 64) AS BIGINT) AS batch
        FROM (SELECT DISTINCT d, user_id, item_id FROM tracker)"""
    ),
    "popular_topn": _logs(
        f"SELECT CAST(rank AS BIGINT) AS rank, item_id, {_six('score', 'score')} FROM popular WHERE rank <= 20", _RATED
    ),
    "user_topn": _logs(f"SELECT {_LISTS} FROM ranked WHERE rank <= 10", _RATED, _USER_TOP),
    "label_corr": _correlations(),
    "union_splits": _logs(f"SELECT user_id, item_id, sec FROM tracker WHERE sec <= {VALID_END}"),
    "union_relaxed": _logs(
        f"""SELECT {_day()}, user_id, item_id, action_type, count(*) AS cnt, CAST(NULL AS BIGINT) AS n_orders,
        CAST(NULL AS BIGINT) AS n_delivered FROM tracker GROUP BY ALL
        UNION ALL
        SELECT strftime(last_status_timestamp, '%Y-%m-%d'), user_id, item_id, NULL, NULL, count(*),
        count(CASE WHEN {_DELIVERED} THEN 1 END) FROM purchases GROUP BY 1, 2, 3"""
    ),
    "id_map": _logs(
        f"""SELECT id AS ext_id, row_number() OVER (ORDER BY id) - 1 AS idx, 'user' AS kind
        FROM (SELECT DISTINCT user_id AS id FROM tracker WHERE sec <= {VALID_END})
        UNION ALL SELECT id, row_number() OVER (ORDER BY id) - 1, 'item'
        FROM (SELECT DISTINCT item_id AS id FROM tracker WHERE sec <= {VALID_END})"""
    ),
    "recommend_with_fallback": _logs(f"SELECT {_LISTS} FROM listed", _RATED, _USER_TOP, _fallback(20)),
    "fallback_by_position": _logs(
        f"""SELECT u.user_id, CAST(p.rank AS BIGINT) AS rank, p.item_id, {_six('k - p.rank + 1', 'score')}
        FROM (SELECT user_id FROM users WHERE user_id NOT IN (SELECT user_id FROM known)) u,
        (SELECT *, count(*) OVER () AS k FROM popular WHERE rank <= 20) p""",
        _RATED,
    ),
    "dot_topk": f"""SELECT user_id, rank, item_id, {_six('score', 'score')} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
          SELECT u.vec_id AS user_id, i.vec_id AS item_id,
          list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score
          FROM embeddings u, embeddings i)) WHERE rank <= 10""",
    "ground_truth": _logs("SELECT * FROM truth", _RATED),
    "ground_truth_features": _logs(
        "SELECT DISTINCT user_id, item_id FROM target WHERE target > 0", _target(_DELIVERED, None)
    ),
    "eval_metrics": "WITH "
    + ",".join([_LOGS, _RATED, _USER_TOP, _metrics("SELECT user_id, rank, item_id FROM ranked WHERE rank <= 20")]),
    "eval_popularity": _with_metrics(
        "SELECT u.user_id, p.rank, p.item_id FROM (SELECT DISTINCT user_id FROM truth) u, popular p WHERE p.rank <= 100"
    ),
    "sequence_training_view": _logs(
        f"""SELECT f.user_id, f.item_id, f.d - DATE '1970-01-01' AS date, {_six('f.target', 'target')},
        {_six('f.cnt_to_cart_sum_7d_past', 'cnt_to_cart_sum_7d_past')}, h.user_idx, h.item_idx,
        {_text('h.seq')} AS item_id_list, CAST(coalesce(len(h.seq), 0) AS BIGINT) AS item_length,
        CAST(coalesce(p_size, 0) AS BIGINT) AS catalogid, CAST(coalesce(p_partkey % 97, 0) AS BIGINT) AS variant_id,
        {_six('coalesce(e.embedding[1], 0)', 'fclip_embed')}
        FROM feats f JOIN history h ON f.d = h.d AND f.user_id = h.user_id AND f.item_id = h.item_id
        LEFT JOIN part ON f.item_id = p_partkey LEFT JOIN embeddings e ON p_partkey = e.vec_id""",
        *_FEATURE_PARTS,
        _VIEW,
        _IDS.format(seen="true").replace("base AS", "base2 AS").replace("FROM base b", "FROM base2 b"),
        _HISTORY,
    ),
    "dataset_stats": _logs(
        f"""SELECT 'n_users' AS statistic, count(DISTINCT user_id) AS "value" FROM tracker WHERE {_IN_TRAIN}
        UNION ALL SELECT 'n_items', count(DISTINCT item_id) FROM tracker WHERE {_IN_TRAIN}
        UNION ALL SELECT 'n_positive_pairs', count(*) FROM rated
        UNION ALL SELECT 'n_truth_pairs', count(*) FROM truth
        UNION ALL SELECT 'n_valid_users', count(DISTINCT user_id) FROM truth""",
        _RATED,
    ),
    "bpr_triples": _logs(
        """SELECT user_idx, item_idx, neg_idx FROM drawn d WHERE NOT EXISTS (
        SELECT 1 FROM pos p WHERE p.user_idx = d.user_idx AND p.item_idx = d.neg_idx)""",
        _IDS.format(seen=_IN_TRAIN),
        _DELIVERED_PAIRS,
    ),
    "contingency": _logs("SELECT action_type, last_status, o AS observed FROM grid", _CELLS),
    "pearson_residuals": _logs(
        f"""SELECT action_type, last_status, o AS observed, {_six('e', 'expected')},
        {_six('(o - e) / sqrt(e + 1e-12)', 'residual')} FROM cells""",
        _CELLS,
    ),
    "pmi": _logs(
        f"SELECT action_type, last_status, {_six('ln((o / n + 1e-12) / (chance + 1e-12))', 'pmi')} FROM cells", _CELLS
    ),
    "cramers_v": _logs(
        f"""SELECT CAST(n AS BIGINT) AS n, {_six('chi2', 'chi2')}, {_six('sqrt(chi2 / (n * greatest(1, least(r - 1, c - 1))))', 'cramers_v')}
        FROM (SELECT any_value(n) AS n, sum((o - e) * (o - e) / (e + 1e-12)) AS chi2,
        (SELECT count(*) FROM (SELECT DISTINCT action_type FROM grid)) AS r, (SELECT count(*) FROM (SELECT DISTINCT last_status FROM grid)) AS c FROM cells)""",
        _CELLS,
    ),
    "als_topn": _logs(_facts("SELECT user_id FROM rated"), _RATED),
    "bpr_topn": _logs(
        _facts("SELECT user_id FROM liked", "wanted"), _RATED, _DELIVERED_POPULAR, _IDS.format(seen=_IN_TRAIN), _DELIVERED_PAIRS
    ),
    "als_residuals": _logs(
        f"""SELECT v.user_id, CAST(any_value(n) AS BIGINT) AS n_positive,
        {_six("sqrt(sum(pow(gx + off + 0.05 * n * v.v, 2))) / sqrt(sum(want * want))", "residual")},
        {_six("sum(gx * v.v) + any_value(part) + 0.05 * any_value(n) * sum(v.v * v.v)", "loss")}
        FROM uv v JOIN offs USING (user_id, d) JOIN gxs USING (user_id, d) JOIN ns USING (user_id) GROUP BY v.user_id""",
        _RATED,
        _IDS.format(seen=_IN_TRAIN),
        _drawn(0, 4, "umap", "user_idx", "uv"),
        _drawn(1, 4, "imap", "item_idx", "iv"),
        """g AS (SELECT a.d AS d1, b.d AS d2, sum(a.v * b.v) AS g FROM iv a JOIN iv b USING (item_id) GROUP BY ALL),
        s AS (SELECT r.user_id, r.item_id, any_value(rating) AS r, sum(u.v * i.v) AS s FROM rated r JOIN uv u USING (user_id)
          JOIN iv i ON i.item_id = r.item_id AND i.d = u.d GROUP BY r.user_id, r.item_id),
        offs AS (SELECT user_id, d, sum((0.5 * r * s - (1 + 0.5 * r)) * v) AS off, sum((1 + 0.5 * r) * v) AS want FROM s JOIN iv USING (item_id) GROUP BY ALL),
        gxs AS (SELECT u.user_id, g.d1 AS d, sum(g.g * u.v) AS gx FROM uv u JOIN g ON g.d2 = u.d GROUP BY ALL),
        ns AS (SELECT user_id, count(*) AS n, sum((1 + 0.5 * r) * pow(1 - s, 2) - s * s) AS part FROM s GROUP BY user_id)""",
    ),
    "als_half_step": _logs(
        f"SELECT user_id, array_to_string({_MICRO.format(v='[x, y]')}, ' ') AS vector FROM solved", _RATED, *_HALF_STEP
    ),
    "als_lists": _logs(
        f"SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, {_six('score', 'score')} FROM half_lists WHERE rank <= 20", _RATED, *_HALF_STEP
    ),
    "als_eval": "WITH " + ",".join([_LOGS, _RATED, *_HALF_STEP, _metrics("SELECT user_id, rank, item_id FROM half_lists WHERE rank <= 100")]),
    "bpr_first_step": _logs(
        """SELECT CAST(side AS BIGINT) AS side, idx, string_agg(CAST(CAST(round(v * 1e6, 0) AS BIGINT) AS VARCHAR), ' ' ORDER BY d) AS vector,
        CAST(coalesce(any_value(n), 0) AS BIGINT) AS n FROM stepped GROUP BY side, idx""",
        _RATED,
        *_FIRST_STEP,
    ),
    "bpr_losses": _logs(
        f"""SELECT 'start' AS moment, {_six('avg(ln(1 + exp(-gap)))', 'loss')} FROM {_loss('vecs')}
        UNION ALL SELECT 'after', {_six('avg(ln(1 + exp(-gap)))', 'loss')} FROM {_loss('stepped')}""",
        _RATED,
        *_FIRST_STEP,
    ),
    "daily_actions_map": _logs(
        f"""SELECT {_day()}, user_id, item_id, coalesce(string_agg(action_type || ':' || n, ' ' ORDER BY action_type), '') AS counts
        FROM (SELECT d, user_id, item_id, action_type, count(*) AS n FROM tracker GROUP BY ALL) GROUP BY d, user_id, item_id"""
    ),
    "hot_items": _logs("SELECT item_id AS id, count(*) AS n FROM tracker GROUP BY item_id HAVING count(*) > (SELECT count(*) FROM tracker) * 0.0105"),
    "attr_dictionary": _items("SELECT * FROM dictionary", 0.01, _DICTIONARY),
    "attr_sparse": _items(f"SELECT item_id, {_VALUE_IDS} AS value_ids FROM attrs JOIN dictionary USING (attr_name, attr_value) GROUP BY item_id", 0.01, _DICTIONARY),
    "item_features_sparse": _items(
        f"""SELECT i.item_id, CAST(i.catalogid AS VARCHAR) AS catalogid, CAST(variant_id AS VARCHAR) AS variant_id, CAST(model_id AS VARCHAR) AS model_id,
        CASE WHEN i.catalogid <= 45 THEN p_type END AS type_main, CASE WHEN i.catalogid <= 45 THEN p_brand END AS brand_main,
        CASE WHEN i.catalogid <= 45 THEN CAST(4 AS BIGINT) ELSE 0 END AS n_attributes, CASE WHEN i.catalogid <= 45 THEN CAST(2 AS BIGINT) ELSE 0 END AS n_aspects,
        CASE WHEN i.catalogid <= 45 THEN CAST(2 AS BIGINT) ELSE 0 END AS n_show_characteristics, coalesce(value_ids, '') AS value_ids
        FROM items i LEFT JOIN (
          SELECT item_id, {_VALUE_IDS} AS value_ids FROM attrs JOIN dictionary USING (attr_name, attr_value) GROUP BY item_id) v ON v.item_id = i.item_id""",
        0.01,
        _DICTIONARY,
    ),
    "commit_log": _logs(
        f"""SELECT CAST(entry AS BIGINT) AS entry, count(*) AS n_noted, count(*) AS n_rows, count(DISTINCT ((user_id % 16) + 16) % 16) AS n_shards
        FROM (SELECT 1 AS entry, user_id FROM tracker WHERE {_IN_TRAIN} UNION ALL SELECT 2, user_id FROM tracker) GROUP BY entry"""
    ),
    "metrics_json": "WITH "
    + ",".join([_LOGS, _RATED, _USER_TOP, _metrics("SELECT user_id, rank, item_id FROM ranked WHERE rank <= 20")]),
    "label_selector": _logs(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS kind, '{name}' AS label, {_six(f'sum(CAST({sql} AS DOUBLE))', 'total')}, count({sql}) AS n_known FROM joined"
            for kind, name, sql in (
                ("rating", "to_cart_and_delivered", f"CAST(action_type = 'to_cart' AND {_DELIVERED} AS INT)"),
                ("rating", "to_cart", "CAST(action_type = 'to_cart' AS INT)"),
                ("rating", "delivered", f"CAST({_DELIVERED} AS INT)"),
                ("rating", "combined", f"({_COMBINED})"),
                ("rating", "combined2", f"(CASE WHEN {_DELIVERED} OR action_type IN ('to_cart', 'favorite') THEN 1 ELSE 0 END)"),
                ("target", "delivered", f"CAST({_DELIVERED} AS INT)"),
                ("target", "combined", f"(CASE WHEN {_DELIVERED_OR_CART} THEN 1 ELSE 0 END)"),
            )
        )
    ),
}

# The same rows by another way.
for _way, _same in {
    "tracker_orders_bucketed": "tracker_orders_left",
    "inter_features_bucketed": "inter_features",
    "training_view_hot": "training_view",
    "interactions_indexed_hot": "interactions_indexed",
}.items():
    ORACLES[_way] = ORACLES[_same]
