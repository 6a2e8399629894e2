"""SQL for DuckDB with the same results as the queries of the catalog."""

from __future__ import annotations

from topicpulse.queries.catalog import SHARE

# Longest walk looked at by the recursive path query; far above the longest shortest
# path of the test tables, which a test checks.
WALK_LIMIT = 12

# Shared definitions in dependency order; a query lists the ones it starts from.
PARTS: dict[str, tuple[str, str]] = {
    "users0": (
        "",
        """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS screen_name,
        CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS flag FROM customer""",
    ),
    "spam": ("users0", "SELECT DISTINCT id FROM users0 WHERE flag = '1'"),
    "users1": (
        "users0 spam",
        "SELECT id, screen_name FROM users0 WHERE id NOT IN (SELECT id FROM spam)",
    ),
    "posts0": (
        "",
        """SELECT CAST(event_id AS VARCHAR) AS "tweetId", CAST(user_id AS VARCHAR) AS "userId",
        ts, event_type AS category FROM events""",
    ),
    "posts1": (
        "posts0 spam",
        'SELECT * FROM posts0 WHERE "userId" NOT IN (SELECT id FROM spam)',
    ),
    "edges0": (
        "",
        """SELECT CAST(user_id AS VARCHAR) AS "Source",
        regexp_extract(props, '"k": *([0-9]+)', 1) AS "Target" FROM events""",
    ),
    "pairs": ("edges0", 'SELECT DISTINCT "Source", "Target" FROM edges0'),
    "edges1": (
        "pairs spam",
        """SELECT * FROM pairs WHERE "Source" NOT IN (SELECT id FROM spam)
        AND "Target" NOT IN (SELECT id FROM spam)""",
    ),
    "names": (
        "posts1",
        "SELECT DISTINCT category FROM posts1 WHERE category IS NOT NULL",
    ),
    "span": (
        "posts1",
        "SELECT min(ts) AS lo, max(ts) AS hi, datesub('day', min(ts), max(ts)) AS d FROM posts1",
    ),
    "totals": (
        "users1 posts1",
        """SELECT u.id, count(*) AS tweets_total FROM users1 u
        LEFT JOIN posts1 p ON u.id = p."userId" GROUP BY u.id""",
    ),
    "feats": (
        "totals names posts1 span",
        """SELECT t.id, n.category, t.tweets_total, coalesce(c.posts, 0) AS posts,
        coalesce(c.days, 0) AS days,
        CAST(coalesce(c.posts, 0) AS DOUBLE) / greatest(1, t.tweets_total) AS focus_rate,
        CAST(coalesce(c.days, 0) AS DOUBLE) / s.d AS activeness_1,
        CAST(coalesce(c.posts, 0) AS DOUBLE) / s.d AS activeness_2,
        CAST(coalesce(c.posts, 0) * coalesce(c.days, 0) AS DOUBLE) / s.d AS activeness_3
        FROM totals t CROSS JOIN names n CROSS JOIN span s
        LEFT JOIN (SELECT "userId", category, count(*) AS posts,
            count(DISTINCT CAST(ts AS DATE)) AS days FROM posts1 GROUP BY 1, 2) c
        ON c."userId" = t.id AND c.category = n.category""",
    ),
    "focus": (
        "feats names",
        """SELECT id, category FROM feats
        WHERE focus_rate >= CAST(1 AS DOUBLE) / (SELECT count(*) FROM names)""",
    ),
    "chosen": (
        "users1 focus",
        """SELECT u.id, coalesce(string_agg(f.category, ',' ORDER BY f.category), '') AS topics
        FROM users1 u LEFT JOIN focus f ON u.id = f.id GROUP BY u.id""",
    ),
    "nodes1": ("edges1", 'SELECT "Source" AS id FROM edges1 UNION SELECT "Target" FROM edges1'),
    "tr": (
        "edges1 focus",
        """SELECT a.category AS c, e."Source" AS s, e."Target" AS t FROM edges1 e
        JOIN focus a ON a.id = e."Source"
        JOIN focus b ON b.id = e."Target" AND b.category = a.category""",
    ),
    "gnodes": ("tr", "SELECT s AS id FROM tr UNION SELECT t FROM tr"),
    "nc": (
        "tr gnodes",
        "SELECT c, id FROM (SELECT DISTINCT c FROM tr) CROSS JOIN gnodes",
    ),
    "deg": (
        "tr nc",
        """SELECT nc.c, nc.id, CAST(count(e.id) AS DOUBLE) AS degree FROM nc LEFT JOIN
        (SELECT c, s AS id FROM tr UNION ALL SELECT c, t FROM tr) e
        ON e.c = nc.c AND e.id = nc.id GROUP BY 1, 2""",
    ),
    "links": (
        "tr nc",
        """SELECT tr.c, tr.s, tr.t, 0.85::DOUBLE / o.n AS w, 0::DOUBLE AS b FROM tr
        JOIN (SELECT c, s, count(*) AS n FROM tr GROUP BY 1, 2) o ON o.c = tr.c AND o.s = tr.s
        UNION ALL SELECT c, id, id, 0::DOUBLE, 0.15::DOUBLE FROM nc""",
    ),
    "pr": (
        "links nc",
        """SELECT 0 AS i, c, id, 0.15::DOUBLE AS r FROM nc
        UNION ALL
        SELECT pr.i + 1, l.c, l.t, sum(pr.r * l.w + l.b) FROM pr
        JOIN links l ON l.c = pr.c AND l.s = pr.id WHERE pr.i < 100
        GROUP BY pr.i, l.c, l.t""",
    ),
    "walks": (
        "tr nc",
        f"""SELECT 0 AS l, c, id AS s, id AS v, 1::DOUBLE AS k FROM nc
        UNION ALL
        SELECT w.l + 1, w.c, w.s, tr.t, sum(w.k) FROM walks w
        JOIN tr ON tr.c = w.c AND tr.s = w.v WHERE w.l < {WALK_LIMIT}
        GROUP BY w.l, w.c, w.s, tr.t""",
    ),
    "sp": (
        "walks",
        "SELECT c, s, v, min(l) AS d, arg_min(k, l) AS k FROM walks GROUP BY 1, 2, 3",
    ),
    "close": (
        "sp nc",
        """SELECT nc.c, nc.id, coalesce(CAST(count(sp.d) AS DOUBLE) / sum(sp.d), 0) AS closeness
        FROM nc LEFT JOIN sp ON sp.c = nc.c AND sp.v = nc.id AND sp.d > 0 GROUP BY 1, 2""",
    ),
    "through": (
        "sp",
        """SELECT a.c, a.s, a.v, sum(a.k * b.k / st.k) AS part FROM sp a
        JOIN sp b ON b.c = a.c AND b.s = a.v AND b.d > 0
        JOIN sp st ON st.c = a.c AND st.s = a.s AND st.v = b.v AND st.d = a.d + b.d
        WHERE a.d > 0 GROUP BY 1, 2, 3""",
    ),
    "betw": (
        "through nc",
        """SELECT nc.c, nc.id, coalesce(sum(x.part), 0) AS betweenness
        FROM nc LEFT JOIN through x ON x.c = nc.c AND x.v = nc.id GROUP BY 1, 2""",
    ),
    "members": ("deg", "SELECT * FROM deg WHERE degree > 0"),
    "sampled": (
        "members",
        f"""SELECT * FROM (SELECT c, id, least(1.0::DOUBLE, {SHARE}::DOUBLE * greatest(1.0::DOUBLE,
            degree / (sum(degree) OVER (PARTITION BY c) / count(*) OVER (PARTITION BY c))))
            AS chance FROM members)
        WHERE CAST('0x' || substr(md5('0:' || c || ':' || id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE
            < chance""",
    ),
    "betws": (
        "through nc sampled",
        """SELECT nc.c, nc.id, coalesce(sum(x.part / x.chance), 0) AS betweenness FROM nc
        LEFT JOIN (SELECT through.*, sampled.chance FROM through JOIN sampled
            ON sampled.c = through.c AND sampled.id = through.s) x
        ON x.c = nc.c AND x.v = nc.id GROUP BY 1, 2""",
    ),
    "betwe": (
        "through nc sampled",
        """SELECT nc.c, nc.id, coalesce(sum(x.part / x.chance), 0) AS betweenness,
        sqrt(coalesce(sum((1 - x.chance) * (x.part / x.chance) ^ 2), 0)) AS std_error FROM nc
        LEFT JOIN (SELECT t.c, t.s, t.v, sampled.chance, sum(t.part) AS part
            FROM through t JOIN sampled ON sampled.c = t.c AND sampled.id = t.s
            GROUP BY 1, 2, 3, 4) x
        ON x.c = nc.c AND x.v = nc.id GROUP BY 1, 2""",
    ),
    "closeo": (
        "sp nc",
        """SELECT nc.c, nc.id, coalesce(CAST(count(sp.d) AS DOUBLE) / sum(sp.d), 0) AS closeness
        FROM nc LEFT JOIN sp ON sp.c = nc.c AND sp.s = nc.id AND sp.d > 0 GROUP BY 1, 2""",
    ),
    "steps2": ("tr", "SELECT c, s, t FROM tr UNION SELECT c, t, s FROM tr"),
    "walks2": (
        "steps2 nc",
        f"""SELECT 0 AS l, c, id AS s, id AS v FROM nc
        UNION
        SELECT w.l + 1, w.c, w.s, x.t FROM walks2 w
        JOIN steps2 x ON x.c = w.c AND x.s = w.v WHERE w.l < {WALK_LIMIT}""",
    ),
    "closeb": (
        "walks2 nc gnodes",
        """SELECT nc.c, nc.id, coalesce(CAST(count(d) AS DOUBLE) / sum(d) * count(d)
            / ((SELECT count(*) FROM gnodes) - 1), 0) AS closeness FROM nc
        LEFT JOIN (SELECT c, s, v, min(l) AS d FROM walks2 GROUP BY 1, 2, 3) p
        ON p.c = nc.c AND p.v = nc.id AND p.d > 0 GROUP BY 1, 2""",
    ),
    "cent": (
        "deg close betw pr",
        """SELECT deg.id, deg.c AS category, degree, closeness, betweenness, pr.r AS pagerank
        FROM deg JOIN close ON close.c = deg.c AND close.id = deg.id
        JOIN betw ON betw.c = deg.c AND betw.id = deg.id
        JOIN pr ON pr.c = deg.c AND pr.id = deg.id AND pr.i = 100""",
    ),
    "featv": (
        "feats nodes1",
        """SELECT id, m.measure, category, m.value FROM feats,
        LATERAL (VALUES ('dict_activeness_1', activeness_1), ('dict_activeness_2', activeness_2),
            ('dict_activeness_3', activeness_3), ('dict_focus_rate', focus_rate)) m(measure, value)
        WHERE id IN (SELECT id FROM nodes1)""",
    ),
    "centv": (
        "cent nodes1 users1 tr",
        """SELECT u.id, m.measure, u.c AS category,
        CASE m.measure WHEN 'betweennessCentrality' THEN betweenness
            WHEN 'closenessCentrality' THEN closeness
            WHEN 'degreeCentrality' THEN degree ELSE pagerank END AS value
        FROM (SELECT nodes1.id, t.c FROM nodes1 JOIN users1 ON users1.id = nodes1.id
            CROSS JOIN (SELECT DISTINCT c FROM tr) t) u
        LEFT JOIN cent ON cent.id = u.id AND cent.category = u.c
        CROSS JOIN (VALUES ('betweennessCentrality'), ('closenessCentrality'),
            ('degreeCentrality'), ('pageRank')) m(measure)""",
    ),
    "featm": (
        "featv",
        """SELECT id, measure, category, CASE WHEN hi = lo THEN 0.5
        ELSE round((x - lo) / (hi - lo), 7) END AS value FROM (
        SELECT id, measure, category, coalesce(value, 0) AS x,
            min(coalesce(value, 0)) OVER (PARTITION BY measure, category) AS lo,
            max(coalesce(value, 0)) OVER (PARTITION BY measure, category) AS hi FROM featv)""",
    ),
    "centm": (
        "centv",
        """SELECT id, measure, category, CASE WHEN hi = lo THEN 0.5
        ELSE round((x - lo) / (hi - lo), 7) END AS value FROM (
        SELECT id, measure, category, coalesce(value, 0) AS x,
            min(coalesce(value, 0)) OVER (PARTITION BY measure, category) AS lo,
            max(coalesce(value, 0)) OVER (PARTITION BY measure, category) AS hi FROM centv)""",
    ),
}

RECURSIVE = ("pr", "walks", "walks2")


def r6(column: str) -> str:
    return f"round({column}, 6) AS {column}"


def with_parts(needed: str, select: str, **other: tuple[str, str]) -> str:
    """``select`` behind the definitions it needs; ``other`` replaces some of them."""
    parts = PARTS | other
    wanted: set[str] = set()
    stack = needed.split()
    while stack:
        name = stack.pop()
        if name not in wanted:
            wanted.add(name)
            stack += parts[name][0].split()
    ordered = [name for name in parts if name in wanted]
    recursive = "RECURSIVE " if wanted & set(RECURSIVE) else ""
    body = ",\n".join(f"{name} AS ({parts[name][1]})" for name in ordered)
    return f"WITH {recursive}{body}\n{select}"


def _measure(name: str, part: str, alias: str | None = None) -> str:
    return with_parts(part, f'SELECT c AS "Category", id, {alias or r6(name)} FROM {part}')


_FEATURE_RATES = ["focus_rate", "activeness_1", "activeness_2", "activeness_3"]

ORACLE: dict[str, str] = {
    "spam_users": with_parts("spam", "SELECT id FROM spam"),
    "users_clean": with_parts("users1", "SELECT id, screen_name FROM users1"),
    "posts_clean": with_parts("posts1", 'SELECT "tweetId", "userId", category FROM posts1'),
    "edges_dedup": with_parts("pairs", 'SELECT "Source", "Target" FROM pairs'),
    "edges_clean": with_parts("edges1", 'SELECT "Source", "Target" FROM edges1'),
    "parsed_dates": with_parts(
        "posts0",
        """SELECT "tweetId", strftime(ts, '%Y-%m-%d %H:%M:%S') AS posted_at,
        strftime(ts, '%Y-%m-%d') AS posted_date FROM posts0""",
    ),
    "user_totals": with_parts("totals", "SELECT id, tweets_total FROM totals"),
    "most_active_users": with_parts(
        "totals", "SELECT id, tweets_total FROM totals ORDER BY tweets_total DESC, id"
    ),
    "dataset_span": with_parts(
        "span",
        """SELECT strftime(lo, '%Y-%m-%d %H:%M:%S') AS first_at,
        strftime(hi, '%Y-%m-%d %H:%M:%S') AS last_at, d AS span_days FROM span""",
    ),
    "topics": with_parts("names", "SELECT category FROM names ORDER BY category"),
    "screen_names": with_parts("users1", "SELECT DISTINCT screen_name FROM users1"),
    "posts_by_topic": with_parts("feats", "SELECT id, category, posts FROM feats"),
    "days_by_topic": with_parts("feats", "SELECT id, category, days FROM feats"),
    **{
        name: with_parts("feats", f"SELECT id, category, {r6(name)} FROM feats")
        for name in _FEATURE_RATES
    },
    "user_features": with_parts(
        "feats",
        "SELECT id, category, tweets_total, posts, days, "
        + ", ".join(r6(name) for name in _FEATURE_RATES)
        + " FROM feats",
    ),
    "user_topics": with_parts("chosen", "SELECT id, topics FROM chosen"),
    "nodes": with_parts("nodes1", "SELECT id FROM nodes1"),
    "node_topics": with_parts(
        "nodes1 chosen",
        "SELECT n.id, c.topics FROM nodes1 n LEFT JOIN chosen c ON c.id = n.id",
    ),
    "edge_shared_topics": with_parts(
        "edges1 chosen tr",
        """SELECT e."Source", e."Target", a.topics AS source_topics, b.topics AS target_topics,
        CASE WHEN a.topics IS NULL OR b.topics IS NULL THEN NULL
            ELSE coalesce(x.topics, '') END AS shared_topics
        FROM edges1 e LEFT JOIN chosen a ON a.id = e."Source"
        LEFT JOIN chosen b ON b.id = e."Target"
        LEFT JOIN (SELECT s, t, string_agg(c, ',' ORDER BY c) AS topics FROM tr GROUP BY 1, 2) x
        ON x.s = e."Source" AND x.t = e."Target" """,
    ),
    "labelled_edges": with_parts(
        "tr", 'SELECT s AS "Source", t AS "Target", c AS "Category" FROM tr'
    ),
    "edge_topics": with_parts("tr", 'SELECT DISTINCT c AS "Category" FROM tr'),
    "graph_nodes": with_parts("gnodes", "SELECT id FROM gnodes"),
    "merged_edges": with_parts(
        "tr",
        """SELECT s AS "Source", t AS "Target", c AS "Category" FROM tr
        UNION SELECT t, s, c FROM tr""",
    ),
    "merged_nodes": with_parts("gnodes", "SELECT id FROM gnodes"),
    "degree": _measure("degree", "deg", "degree"),
    "degree_by_user": _measure("degree", "deg", "degree") + " ORDER BY id DESC",
    "closeness": _measure("closeness", "close"),
    "closeness_out": _measure("closeness", "closeo"),
    "closeness_both": _measure("closeness", "closeb"),
    "betweenness": _measure("betweenness", "betw"),
    "betweenness_reduced": _measure("betweenness", "betw"),
    "closeness_sketched": _measure("closeness", "close"),
    "betweenness_sampled": _measure("betweenness", "betws"),
    "betweenness_errors": with_parts(
        "betwe",
        f'''SELECT c AS "Category", id, {r6("betweenness")}, {r6("std_error")} FROM betwe''',
    ),
    "pagerank": with_parts(
        "pr",
        'SELECT c AS "Category", id, round(r, 6) AS pagerank '
        "FROM pr WHERE i = 100",
    ),
    "centralities": with_parts(
        "cent",
        "SELECT id, category, "
        + ", ".join(r6(name) for name in ("degree", "closeness", "betweenness", "pagerank"))
        + " FROM cent",
    ),
    "merged": with_parts(
        "featv centv",
        f"""SELECT id, measure, category, {r6('value')} FROM featv
        UNION ALL SELECT id, measure, category, {r6('value')} FROM centv""",
    ),
    "scaled_features_minmax": with_parts(
        "featm", "SELECT id, measure, category, value FROM featm"
    ),
    "scaled_features_std": with_parts(
        "featv",
        """SELECT id, measure, category,
        CASE WHEN coalesce(sd, 0) = 0 THEN 0.0 ELSE round(x / sd, 7) END AS value FROM (
        SELECT id, measure, category, coalesce(value, 0) AS x,
            stddev_samp(coalesce(value, 0)) OVER (PARTITION BY measure, category) AS sd
        FROM featv)""",
    ),
    "scaled_centralities": with_parts(
        "centm", "SELECT id, measure, category, value FROM centm"
    ),
    "users_appended": with_parts(
        "users1 tr",
        """SELECT u.id AS id_str, u.screen_name, d.c AS "Category", d.degree, r.run
        FROM users1 u LEFT JOIN (
            SELECT c, id, CAST(count(*) AS DOUBLE) AS degree
            FROM (SELECT c, s AS id FROM tr UNION ALL SELECT c, t FROM tr) GROUP BY 1, 2) d
        ON d.id = u.id CROSS JOIN (VALUES ('one'), ('two')) r(run)""",
    ),
    "users_enriched": with_parts(
        "users1 names featm centm",
        """SELECT u.id AS id_str, u.screen_name, n.category, f.value AS focus_rate,
        d.value AS degree FROM users1 u CROSS JOIN names n
        LEFT JOIN featm f ON f.id = u.id AND f.category = n.category
            AND f.measure = 'dict_focus_rate'
        LEFT JOIN centm d ON d.id = u.id AND d.category = n.category
            AND d.measure = 'degreeCentrality'""",
    ),
    "user_records": with_parts(
        "featm centm", "SELECT * FROM featm UNION ALL SELECT * FROM centm"
    ),
    "user_records_left": with_parts(
        "featm centm",
        "SELECT * FROM featm UNION ALL SELECT * FROM centm",
        posts1=("posts0", "SELECT * FROM posts0"),
        nodes1=("users1", "SELECT id FROM users1"),
        close=(
            "sp nc gnodes",
            """SELECT nc.c, nc.id, coalesce(CAST(count(sp.d) AS DOUBLE) / sum(sp.d)
            * (CAST(count(sp.d) AS DOUBLE) / ((SELECT count(*) FROM gnodes) - 1)), 0) AS closeness
            FROM nc LEFT JOIN sp ON sp.c = nc.c AND sp.v = nc.id AND sp.d > 0 GROUP BY 1, 2""",
        ),
    ),
    "user_records_raw": with_parts(
        "feats nodes1",
        """SELECT id, category, tweets_total, posts, days FROM feats
        WHERE id IN (SELECT id FROM nodes1)""",
        totals=(
            "users1 posts1",
            """SELECT u.id, count(p."tweetId") AS tweets_total FROM users1 u
            LEFT JOIN posts1 p ON u.id = p."userId" GROUP BY u.id""",
        ),
    ),
    "users_shaped": with_parts(
        "users0", "SELECT id, screen_name, flag AS category_rf FROM users0"
    ),
    "users_without_flag": with_parts("users0", "SELECT id, screen_name FROM users0"),
    "stage_counts": with_parts(
        "users0 users1 posts0 edges0 edges1 tr nodes1",
        " UNION ALL ".join(
            f"SELECT '{stage}' AS stage, count(*) AS rows FROM {part}"
            for stage, part in (
                ("users", "users0"),
                ("users_clean", "users1"),
                ("posts", "posts0"),
                ("edges", "edges0"),
                ("edges_clean", "edges1"),
                ("edges_labelled", "tr"),
                ("nodes", "nodes1"),
            )
        ),
    ),
}
