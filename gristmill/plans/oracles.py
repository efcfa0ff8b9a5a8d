"""Independent SQL for the registered queries, over the same tables.

Sampling and k-means results depend on random draws; those queries return what every draw or fit
must fulfil (distinct rows of the table, plausible sizes, labels in range, one best k).
"""

from __future__ import annotations

from gristmill.plans import fixtures as fx

_KEY = ", ".join(fx.LINE_KEY)
_GAPS = ", ".join(f"{sql} AS {name}" for name, sql in fx.GAPS.items())
_GAPPY = f"SELECT {_KEY}, {_GAPS} FROM lineitem"
_CENTS = "DECIMAL(18,2)"

# The white space of Unicode plus the four ASCII separators.
_SPACE = r"[\pZ\t\n\v\f\r\x{85}\x{1C}-\x{1F}]+"


def _per_gap_column(select: str) -> str:
    """``select`` once per column with gaps, with its position, name and values ``v``."""
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS \"column\", 'double' AS type, "
        f"{select} FROM (SELECT {name} AS v FROM ({_GAPPY}))"
        for i, name in enumerate(fx.GAPS)
    ]
    return " UNION ALL ".join(parts)


def _scaled(source: str, cols, keep: str = "*") -> str:
    """Rows of ``source`` with ``z_`` columns."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in cols)
    scaled = ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in cols)
    return (
        f"SELECT {keep}, {scaled} FROM ({source}) t, "
        f"(SELECT {stats} FROM ({source}) u) moments"
    )


def _labelled(source: str, cols, centers) -> str:
    """Rows of ``source`` (which has ``cols``) with the nearest of the given centres."""
    names = [f"d{i}" for i in range(len(centers))]
    distances = ", ".join(
        "(" + " + ".join(f"({c} - ({v})) * ({c} - ({v}))" for c, v in zip(cols, point)) + f") AS d{i}"
        for i, point in enumerate(centers)
    )
    lowest = f"list_min([{', '.join(names)}])"
    return (
        f"SELECT *, CAST(list_position([{', '.join(names)}], {lowest}) - 1 AS INTEGER) AS cluster "
        f"FROM (SELECT *, {distances} FROM ({source}) s) x"
    )


def _unsigned_zero(column: str) -> str:
    """Rounded; adding zero turns the -0.0 of a small negative number into 0.0."""
    return f"round({column}, 4) + CAST(0 AS DOUBLE)"


_LINE_COLS = ["l_quantity", "l_extendedprice"]
_LINE_SCALED = _scaled("SELECT * FROM lineitem", _LINE_COLS)
_LINE = _labelled(_LINE_SCALED, fx.LINE_Z, fx.LINE_CENTERS)
_PART = _labelled(
    _scaled("SELECT * FROM part", ["p_size", "p_retailprice"]),
    ["z_p_size", "z_p_retailprice"],
    fx.PART_CENTERS,
)


def _silhouette(labelled: str, a: str, b: str) -> str:
    """Mean silhouette of two-dimensional labelled rows."""
    return f"""
        WITH rows_ AS (
            SELECT row_number() OVER () AS id, cluster AS c, {a} AS x, {b} AS y FROM ({labelled}) l
        ), groups_ AS (
            SELECT c AS g, count(*) AS n, sum(x * x + y * y) AS psi, sum(x) AS sx, sum(y) AS sy
            FROM rows_ GROUP BY c
        ), far AS (
            SELECT id, c, g, n,
                   x * x + y * y + psi / n - 2 * (x * sx + y * sy) / n AS dist
            FROM rows_, groups_
        ), scored AS (
            SELECT id,
                   max(CASE WHEN c = g THEN n END) AS n_own,
                   max(CASE WHEN c = g THEN dist END) AS own,
                   min(CASE WHEN c <> g THEN dist END) AS other
            FROM far GROUP BY id
        )
        SELECT round(avg(CASE WHEN n_own = 1 THEN 0
            ELSE (other - own * n_own / (n_own - 1)) / greatest(other, own * n_own / (n_own - 1))
            END), 4) AS silhouette
        FROM scored"""


def _best_k() -> str:
    scores = " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS k, silhouette FROM ("
        + _silhouette(_labelled(_LINE_SCALED, fx.LINE_Z, points), *fx.LINE_Z)
        + f") q{k}"
        for k, points in fx.CENTER_SETS.items()
    )
    return f"SELECT k, silhouette FROM ({scores}) ORDER BY silhouette DESC, k LIMIT 1"


def _joint_lloyd() -> str:
    """Iterations from the given sets of centres, one pair of tables each."""
    start = ", ".join(f"({k}, {c}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for k, points in fx.CENTER_SETS.items() for c, (x, y) in enumerate(points))
    parts = [
        f"p AS MATERIALIZED (SELECT row_number() OVER () AS id, {fx.LINE_Z[0]} AS x, {fx.LINE_Z[1]} AS y FROM ({_LINE_SCALED}) s)",
        f"c0(k, c, x, y) AS (VALUES {start})",
    ]
    for i in range(fx.JOINT_ITERATIONS):
        parts.append(
            f"l{i} AS (SELECT id, k, any_value(p.x) AS x, any_value(p.y) AS y, min({{'d': (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y), 'c': c.c}}) AS m FROM p, c{i} c GROUP BY id, k)"
        )
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT k, m.c AS c, avg(x) AS x, avg(y) AS y, count(*) AS n, sum(m.d) AS far FROM l{i} GROUP BY 1, 2)")
    last = f"c{fx.JOINT_ITERATIONS}"
    return (
        f"WITH {', '.join(parts)} SELECT CAST(k AS INTEGER) AS k, CAST(c AS INTEGER) AS c, n, round(sum(far) OVER (PARTITION BY k), 3) AS cost, "
        f"round(x, 3) AS x, round(y, 3) AS y FROM {last}"
    )


def _seeds(rounds: int = 2, wanted: int = 10) -> str:
    """Keyed oversampling of part, then the heavy and far candidates, unrolled for five clusters."""
    far = "list_min([(p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) FOR q IN cand])"
    rank = "CAST('0x' || substr(md5('42:{0}:' || CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT)"
    parts = [
        f"p AS MATERIALIZED (SELECT p_partkey, z_p_size AS x, z_p_retailprice AS y FROM ({_scaled('SELECT * FROM part', ['p_size', 'p_retailprice'])}) s)",
        f"k0 AS MATERIALIZED (SELECT 0 AS turn, m.x AS x, m.y AS y FROM (SELECT min({{'r': {rank.format(0)}, 'x': x, 'y': y}}) AS m FROM p))",
    ]
    for turn in range(1, rounds + 1):
        before = f"k{turn - 1}"
        parts += [
            f"f{turn} AS MATERIALIZED (SELECT p.*, {far} AS far FROM p, (SELECT list({{'x': x, 'y': y}}) AS cand FROM {before}))",
            f"k{turn} AS MATERIALIZED (SELECT * FROM {before} UNION ALL SELECT DISTINCT {turn}, x, y FROM f{turn}"
            f" WHERE {rank.format(turn)} < {wanted} * 4294967296.0 * far / (SELECT sum(far) FROM f{turn}) AND far > 0)",
        ]
    parts += [
        f"q AS MATERIALIZED (SELECT row_number() OVER (ORDER BY turn, x, y) - 1 AS i, x, y FROM k{rounds})",
        "w AS MATERIALIZED (SELECT q.i, q.x, q.y, coalesce(n, 0) AS w FROM q LEFT JOIN (SELECT m.i AS i, count(*) AS n FROM ("
        "SELECT p_partkey, min({'d': (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y), 'i': q.i}) AS m FROM p, q GROUP BY p_partkey) GROUP BY 1) USING (i))",
        "s0 AS MATERIALIZED (SELECT 0 AS c, i, x, y FROM w ORDER BY w DESC, i LIMIT 1)",
    ]
    for c in range(1, 5):
        gap = f"(SELECT min((w.x - s.x) * (w.x - s.x) + (w.y - s.y) * (w.y - s.y)) FROM s{c - 1} s)"
        parts.append(f"s{c} AS MATERIALIZED (SELECT * FROM s{c - 1} UNION ALL (SELECT {c}, i, x, y FROM w ORDER BY w * {gap} DESC, i LIMIT 1))")
    return (
        f"WITH {', '.join(parts)} SELECT CAST(k AS INTEGER) AS k, CAST(c AS INTEGER) AS c, round(x, 4) AS x, round(y, 4) AS y "
        "FROM s4, (VALUES (3), (5)) AS v(k) WHERE c < k"
    )


def _in_range(nulls: str) -> str:
    tests = []
    for name, (lo, hi) in fx.BOUNDS.items():
        inside = f"({name} >= {lo} AND {name} <= {hi})"
        tests.append(inside if nulls == "reject" else f"({name} IS NULL OR {inside})")
    return f"SELECT * FROM ({_GAPPY}) WHERE " + " AND ".join(tests)


def _part_formats() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS format, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS sum_size, "
        f"CAST(sum(CAST(p_retailprice AS {_CENTS})) AS DOUBLE) AS sum_price FROM part"
        for name in ("tsv", "csv", "jsonl", "parquet")
    )


def _range_profile() -> str:
    bounds = " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in fx.LINE_BOUNDS.items())
    source = _scaled(f"SELECT * FROM lineitem WHERE {bounds}", _LINE_COLS)
    labelled = _labelled(source, fx.LINE_Z, fx.LINE_CENTERS)
    means = ", ".join(f"round(avg({c}), 4) AS avg_{c}" for c in _LINE_COLS)
    return f"SELECT cluster, count(*) AS n, {means} FROM ({labelled}) GROUP BY cluster"


_DIRTY = f"SELECT {_KEY}, {fx.DIRTY_PRICE} AS price FROM lineitem"
# Fixed value: the number that lenient parsing looks for.
_NUMBER = r"(-?\d+(?:\.\d+)?)"
_RANK = "CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"

SQL: dict[str, str] = {
    "tsv_roundtrip_sum": f"""
        SELECT l_returnflag, count(*) AS n,
               CAST(sum(CAST(l_quantity AS {_CENTS})) AS DOUBLE) AS sum_qty,
               CAST(sum(CAST(l_extendedprice AS {_CENTS})) AS DOUBLE) AS sum_price
        FROM lineitem GROUP BY l_returnflag""",
    "multiline_csv_roundtrip": """
        SELECT doc_id, lang, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS text_length
        FROM documents""",
    "inferred_csv_types": """
        SELECT p_partkey, p_brand, p_retailprice, 'string' AS brand_type, 'double' AS price_type
        FROM part""",
    "jsonl_flatten": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(NULL AS DOUBLE) AS not_there
        FROM events""",
    "format_dispatch": _part_formats(),
    **dict.fromkeys(("corrupt_split", "corrupt_stored"), """
        SELECT CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 'bad' ELSE 'good' END AS side,
               count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS sum_key
        FROM part GROUP BY 1"""),
    "small_csv_sink": """
        SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS avg
        FROM part GROUP BY p_brand""",
    "parquet_sink": f"""
        SELECT o_orderstatus, count(*) AS n,
               CAST(sum(CAST(o_totalprice AS {_CENTS})) AS DOUBLE) AS sum_price
        FROM orders GROUP BY o_orderstatus""",
    "resolve_synonyms": f"""
        SELECT {_KEY}, l_quantity AS quantity, l_extendedprice AS price, l_tax AS tax
        FROM lineitem""",
    "select_present": "SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders",
    "range_strict": _in_range("reject"),
    "range_null_tolerant": _in_range("keep"),
    "drop_all_null": f"SELECT * FROM ({_GAPPY}) WHERE coalesce(quantity, price, tax) IS NOT NULL",
    "complete_cases": f"""
        SELECT * FROM ({_GAPPY})
        WHERE quantity IS NOT NULL AND price IS NOT NULL AND tax IS NOT NULL""",
    "parse_strict": f"""
        SELECT {_KEY}, TRY_CAST(replace(price, ',', '.') AS DOUBLE) AS price FROM ({_DIRTY})""",
    "parse_lenient": f"""
        SELECT {_KEY},
               TRY_CAST(nullif(regexp_extract(replace(price, ',', '.'), '{_NUMBER}', 1), '')
                        AS DOUBLE) AS price
        FROM ({_DIRTY})""",
    "parse_lenient_documents": f"""
        SELECT doc_id,
               TRY_CAST(nullif(regexp_extract(replace(text, ',', '.'), '{_NUMBER}', 1), '')
                        AS DOUBLE) AS number
        FROM documents""",
    "word_count_space": """
        SELECT word, count(*) AS n
        FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
    "word_count_ws": f"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '{_SPACE}')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "describe": _per_gap_column(
        "count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS stddev, "
        "round(min(v), 4) AS min, round(max(v), 4) AS max"
    ),
    "profile_merged": _per_gap_column(
        "count(*) AS n_rows, count(*) - count(v) AS nulls, count(v) AS count, round(avg(v), 4) AS mean, "
        "round(stddev_samp(v), 4) AS stddev, round(min(v), 4) AS min, round(max(v), 4) AS max"
    ),
    "jsonl_variants": """
        SELECT event_id, CASE WHEN event_id % 5 < 2 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
               CAST(NULL AS VARCHAR) AS not_there FROM events""",
    "exports_by_header": """
        SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, CAST(p_retailprice AS DOUBLE) AS price,
               CASE WHEN p_partkey % 2 <> 0 THEN p_brand END AS brand FROM part""",
    "clustered_range": f"""
        SELECT {_KEY}, l_quantity, l_extendedprice FROM lineitem
        WHERE {" AND ".join(f"{c} >= {lo} AND {c} <= {hi}" for c, (lo, hi) in fx.NARROW_BOUNDS.items())}""",
    "null_counts": _per_gap_column("count(*) - count(v) AS nulls"),
    "group_count_avg": """
        SELECT event_type, count(*) AS n, round(avg(value), 4) AS avg
        FROM events GROUP BY event_type ORDER BY event_type""",
    "head_ordered": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
    "sample_keyed": f"""
        SELECT c_custkey, c_mktsegment FROM customer
        WHERE {_RANK.format(key="c_custkey")} % 1000 < 200""",
    "sample_keyed_capped": f"""
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY {_RANK.format(key="o_orderkey")} LIMIT 1000""",
    "medians_exact": " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", round(median({name}), 4) AS median FROM ({_GAPPY})"
        for name in fx.GAPS
    ),
    "medians_narrowed": " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", round(quantile_cont({name}, 0.5), 4) AS median FROM ({_GAPPY})"
        for name in fx.GAPS
    ),
    "impute_median": f"""
        SELECT {_KEY}, {", ".join(
            f"round(coalesce({n}, (SELECT median({n}) FROM ({_GAPPY}))), 4) AS {n}"
            for n in fx.GAPS)}
        FROM ({_GAPPY})""",
    "moments": " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", round(avg({name}), 4) AS mean, "
        f"round(stddev_samp({name}), 4) AS stddev FROM ({_GAPPY})"
        for name in fx.GAPS
    ),
    "standardize": f"""
        SELECT {_KEY}, {", ".join(f"{_unsigned_zero(f'z_{n}')} AS {n}" for n in fx.GAPS)}
        FROM ({_scaled(_GAPPY, list(fx.GAPS))})""",
    "vector_standardize": f"""
        SELECT {_KEY}, {", ".join(f"{_unsigned_zero(f'z_{n}')} AS z_{n}" for n in fx.GAPS)}
        FROM ({_scaled(
            f"SELECT * FROM ({_GAPPY}) WHERE quantity + price + tax IS NOT NULL",
            list(fx.GAPS))})""",
    "bad_vectors": "SELECT count(*) AS n_bad FROM lineitem WHERE l_linenumber >= 6",
    "assign_fixed": f"SELECT {_KEY}, cluster FROM ({_LINE})",
    "cluster_sizes": f"SELECT cluster, count(*) AS n FROM ({_LINE}) GROUP BY cluster",
    "cluster_sizes_in_range": _range_profile(),
    "cluster_rows": f"SELECT p_partkey, p_brand FROM ({_PART}) WHERE cluster = 1",
    "cluster_profile": f"""
        SELECT cluster, count(*) AS n, round(avg(p_size), 4) AS avg_p_size,
               round(avg(p_retailprice), 4) AS avg_p_retailprice
        FROM ({_PART}) GROUP BY cluster""",
    "cluster_examples": f"""
        SELECT cluster, p_partkey, p_name, p_brand FROM (
            SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY p_partkey) AS place
            FROM ({_PART})) WHERE place <= 5""",
    "lloyd_step": f"""
        SELECT cluster, count(*) AS n, {", ".join(f"round(avg({z}), 4) AS {z}" for z in fx.LINE_Z)}
        FROM ({_LINE}) GROUP BY cluster""",
    "silhouette_fixed": _silhouette(_LINE, *fx.LINE_Z),
    "best_k_fixed": _best_k(),
    "kmeans_labels_nearest": "SELECT count(*) AS n_rows, count(*) AS n_nearest FROM lineitem",
    "model_roundtrip_score": "SELECT count(*) AS n_rows, count(*) AS n_same FROM lineitem",
    # Draws and fits differ from run to run; the queries return what each of them must fulfil.
    **dict.fromkeys(
        ("sample_target", "sample_capped", "sample_fraction"),
        "SELECT count(*) > 0 AS in_table, count(*) > 0 AS size_plausible FROM lineitem",
    ),
    **dict.fromkeys(
        ("medians_approx", "medians_merged"),
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) > 0 AS rank_near_middle FROM lineitem" for c in fx.GAPS),
    ),
    "vector_impute": f"""
        SELECT count(*) AS n_rows, count(*) AS n_as_expected FROM ({_GAPPY})
        WHERE {" OR ".join(f"{c} IS NOT NULL" for c in fx.GAPS)}""",
    **{
        name: f"SELECT k, n AS n_fitted, n AS n_rows, n > 0 AS cost_falls, n > 0 AS same_score, n > 0 AS best_is_marked FROM range(3, {end}) AS r(k), (SELECT count(*) AS n FROM lineitem)"
        for name, end in (("kmeans_sweep", 11), ("kmeans_fast", 7))
    },
    **dict.fromkeys(
        ("kmeans_train", "saved_model_scores", "kmeans_refit"),
        "SELECT count(*) AS n_rows, count(*) AS n_nearest, count(*) > 0 AS all_labels_occur FROM lineitem",
    ),
    "kmeans_seeds": _seeds(),
    "lloyd_joint": _joint_lloyd(),
    "kmeans_centers": "SELECT cluster, n > 0 AS inside FROM range(0, 3) AS r(cluster), (SELECT count(*) AS n FROM lineitem)",
    "sweep_report": "SELECT k, n > 0 AS names_the_best, n > 0 AS same_score FROM range(3, 7) AS r(k), (SELECT count(*) AS n FROM lineitem)",
}
