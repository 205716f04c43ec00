"""DuckDB SQL for every registered query that SQL can state.

Written independently of the Spark code from the semantics in the docs:
the same mapping of tables, the same fixed taxonomy head (rendered from
the shared constants), the split / blank / merge rules stated in SQL.
"""

from __future__ import annotations

import datetime as _dt

from tagloom.plans import scenario as S
from tagloom.schemas import GOODS_COLUMNS, LOGS_COLUMNS, ORDERS_COLUMNS, USERS_COLUMNS


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows, cols) -> str:
    body = ",\n    ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}) AS v({', '.join(cols)})"


_SHIFTED = (_dt.date.fromisoformat(S.AS_OF_ORDERS) - _dt.timedelta(days=30)).isoformat()

HEAD = f"""
head AS (SELECT CAST(id AS BIGINT) AS id, CAST(name AS VARCHAR) AS name, CAST(rule AS VARCHAR) AS rule,
                CAST(level AS INTEGER) AS level, CAST(pid AS BIGINT) AS pid
         FROM {_values(S.HEAD_TAGS, ['id', 'name', 'rule', 'level', 'pid'])}),
jobs AS (SELECT CAST({S.JOB_TAG_BASE} + min(c_custkey) AS BIGINT) AS id,
                c_mktsegment AS name, c_mktsegment AS rule, 5 AS level, CAST(7 AS BIGINT) AS pid
         FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment),
tax AS (SELECT * FROM head UNION ALL SELECT * FROM jobs),
users AS (SELECT CAST(c_custkey AS VARCHAR) AS id,
                 CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END AS gender,
                 c_mktsegment AS job,
                 CASE WHEN c_custkey % 13 = 0 THEN '\\N'
                      ELSE strftime(DATE '1940-01-01' + CAST((c_custkey * 7919) % 21915 AS INTEGER), '%Y-%m-%d') END AS birthday
          FROM customer),
osrc AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS memberId,
                CAST(CAST(epoch_ms(o_orderdate) // 1000 AS BIGINT) AS VARCHAR) AS finishTime,
                o_orderstatus AS orderstatus
         FROM orders),
logs AS (SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS global_user_id,
                event_type AS loc_url,
                CASE WHEN event_id % 17 = 0 THEN '\\N' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS log_time
         FROM events),
stored AS (SELECT CAST(c.c_custkey AS VARCHAR) AS userId,
                  CASE WHEN c.c_nationkey < 3 THEN concat_ws(',', CAST(j.id AS VARCHAR), g.t)
                       WHEN c.c_nationkey < 5 THEN '0' || g.t || ', ' || g.t || ',' || CAST(j.id AS VARCHAR) || ',x9'
                       WHEN c.c_nationkey < 10 THEN CAST(j.id AS VARCHAR) || ',' || CAST(j.id AS VARCHAR) || ',,'
                       WHEN c.c_nationkey < 15 THEN ' '
                       WHEN c.c_nationkey < 20 THEN NULL
                       ELSE ',' || g.t || ',,' || CAST(j.id AS VARCHAR) || ',' END AS tagsId
           FROM customer c
           LEFT JOIN jobs j ON j.name = c.c_mktsegment
           CROSS JOIN LATERAL (SELECT CASE WHEN c.c_custkey % 2 = 0 THEN '5' ELSE '6' END AS t) g
           WHERE c.c_acctbal >= 0),
bands AS (SELECT id AS tagsId, CAST(split_part(rule, '-', 1) AS INTEGER) AS start_,
                 CAST(split_part(rule, '-', 2) AS INTEGER) AS end_, pid
          FROM tax WHERE pid IN (14, 23)),
lists AS (SELECT CAST(c_custkey AS VARCHAR) AS userId, t AS tagsId
          FROM customer, (VALUES ('31,5'), ('5,32,,'), (' '), (NULL)) AS l(t) WHERE c_custkey % 2 = 0),
lastp AS (SELECT memberId AS userId, max(CAST(finishTime AS BIGINT)) AS maxFinishTime FROM osrc GROUP BY memberId),
days AS (SELECT userId, CAST(date_diff('day', CAST(epoch_ms(maxFinishTime * 1000) AS DATE), DATE '{_SHIFTED}') AS INTEGER) AS days
         FROM lastp),
cycle AS (SELECT d.userId, d.days, CAST(b.tagsId AS VARCHAR) AS tagsId, b.start_ AS "start", b.end_ AS "end"
          FROM days d JOIN bands b ON b.pid = 23 AND d.days BETWEEN b.start_ AND b.end_)
"""

# The union of a user's new lists: blank ones left out, shorter lists first, each tag once.
def _collapse(rows: str) -> str:
    union = f"list_filter(cat, lambda x, i: list_position(cat, x) = i)"
    return f"""(SELECT userId, CASE WHEN len(ls) = 0 THEN lo WHEN len(ls) = 1 THEN ls[1] ELSE array_to_string({union}, ',') END AS tagsId
  FROM (SELECT userId, lo, ls, flatten(list_transform(ls, lambda y: {_jsplit('y')})) AS cat
        FROM (SELECT userId, min(tagsId) AS lo,
                     list(DISTINCT tagsId ORDER BY length(tagsId), tagsId) FILTER (WHERE NOT {_blank('tagsId')}) AS l0, coalesce(l0, []) AS ls
              FROM {rows} GROUP BY userId)))"""


def _upsert(new: str, store: str, merge: bool) -> str:
    cell = f"CASE WHEN n.userId IS NOT NULL THEN {_merge('n.tagsId', 's.tagsId')} END" if merge else "n.tagsId"
    return f"""(SELECT coalesce(n.userId, s.userId) AS userId, coalesce({cell}, s.tagsId) AS tagsId
  FROM {new} n FULL OUTER JOIN {store} s ON n.userId = s.userId)"""


# Java-style split of a comma list: trailing empties dropped, '' -> [''].
def _jsplit(x: str) -> str:
    return (f"(CASE WHEN {x} = '' THEN [''] WHEN regexp_replace({x}, ',+$', '') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(regexp_replace({x}, ',+$', ''), ',') END)")


def _blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_matches({x}, '^\\s*$'))"


def _merge(n: str, o: str) -> str:
    cat = f"list_concat({_jsplit(n)}, {_jsplit(o)})"
    first = f"list_filter({cat}, lambda x, i: list_position({cat}, x) = i)"
    return (f"(CASE WHEN {_blank(n)} THEN {o} WHEN {_blank(o)} THEN {n} "
            f"ELSE array_to_string({first}, ',') END)")


def _with(body: str) -> str:
    return "WITH " + HEAD.strip() + ",\n" + body


# catalog taxonomy: paths from part loaded level by level (insert if absent)
def _catalog_ctes() -> str:
    parts = ["""p0 AS (SELECT DISTINCT p_type AS l1, string_split(p_name, ' ')[1] AS l2,
                CASE WHEN len(string_split(p_name, ' ')) >= 2 THEN string_split(p_name, ' ')[2] END AS l3,
                p_brand AS l4 FROM part),
r0 AS (SELECT l1, l2, l3, l4, CAST(-1 AS BIGINT) AS pid FROM p0),
t0 AS (SELECT id, name, rule, level, pid FROM tax)"""]
    for d in range(1, 5):
        rest = ", ".join(f"r.l{k}" for k in range(d + 1, 5))
        rest_sel = (rest + ", ") if rest else ""
        parts.append(f"""c{d} AS (SELECT DISTINCT l{d} AS name, pid FROM r{d-1} WHERE l{d} IS NOT NULL AND l{d} <> ''),
n{d} AS (SELECT c.name, c.pid FROM c{d} c
        WHERE NOT EXISTS (SELECT 1 FROM t{d-1} t WHERE t.level = {d} AND t.name = c.name AND t.pid = c.pid)),
t{d} AS (SELECT id, name, rule, level, pid FROM t{d-1}
        UNION ALL
        SELECT CAST((SELECT max(id) FROM t{d-1}) + row_number() OVER (ORDER BY pid, name) AS BIGINT), name,
               CAST(NULL AS VARCHAR), {d}, pid FROM n{d}),
r{d} AS (SELECT {rest_sel}t.id AS pid FROM r{d-1} r JOIN t{d} t
        ON t.level = {d} AND t.name = r.l{d} AND t.pid = r.pid
        WHERE r.l{d} IS NOT NULL AND r.l{d} <> '')""")
    parts.append("""cat AS (SELECT id, name,
        CASE WHEN level = 4 AND rule IS NULL THEN
            'inType=table##hbaseTable=tbl_goods##family=detail##selectFields=productid##brand=' || name
            || '##pathId=' || CAST(pid AS VARCHAR) || '##note=a=b##selectFields=productid,price'
        ELSE rule END AS rule, level, pid FROM t4)""")
    return ",\n".join(parts)


_MODELS = _values(S.HEAD_MODELS, ["id", "tag_id", "model_name", "state", "model_main", "sche_time"])


def _logs_line(arity: bool) -> str:
    f = [
        "CAST(event_id AS VARCHAR)", "CAST(event_id AS VARCHAR)",
        "'10.0.' || CAST(user_id % 256 AS VARCHAR) || '.1'", "''", "''",
        "CAST(user_id AS VARCHAR)", "coalesce(props, '')", "''", "''", "event_type",
        "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    ]
    sep = "chr(1)"
    full = f"concat_ws({sep}, {', '.join(f)})"
    if not arity:
        return full
    h10 = f"concat_ws({sep}, {', '.join(f[:10])})"
    h9 = f"concat_ws({sep}, {', '.join(f[:9])})"
    return f"""(CASE event_id % 8
        WHEN 0 THEN {full}
        WHEN 1 THEN {h10}
        WHEN 2 THEN {h10} || {sep}
        WHEN 3 THEN {h9} || {sep} || {sep}
        WHEN 4 THEN {h9}
        WHEN 5 THEN {full} || {sep} || 'extra'
        WHEN 6 THEN {full} || {sep} || {sep}
        ELSE '' END)"""


def _parse_logs(arity: bool) -> str:
    n = len(LOGS_COLUMNS)
    cols = ",\n       ".join(
        f"coalesce(f[{i + 1}], '') AS {c}" if i == n - 1 else f"f[{i + 1}] AS {c}"
        for i, c in enumerate(LOGS_COLUMNS)
    )
    return f"""WITH lines AS (SELECT {_logs_line(arity)} AS line FROM events),
split AS (SELECT CASE WHEN line = '' THEN ['']
                      WHEN regexp_replace(line, chr(1) || '+$', '') = '' THEN []::VARCHAR[]
                      ELSE string_split(regexp_replace(line, chr(1) || '+$', ''), chr(1)) END AS f
          FROM lines)
SELECT {cols}
FROM split WHERE len(f) IN ({n - 1}, {n})"""


def _extract(columns, mapped, table) -> str:
    """All columns of an extract: mapped ones, and the rest from their name and the row key."""
    key = mapped[columns[0]]
    cell = lambda c: mapped.get(c) or ("'\\N'" if len(c) % 3 == 0 else f"'{c}:' || {key}")
    return "SELECT " + ", ".join(f'{cell(c)} AS "{c}"' for c in columns) + f" FROM {table}"


_USERS_MAPPED = {
    "id": "CAST(c_custkey AS VARCHAR)",
    "username": "c_name",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END",
    "birthday": "CASE WHEN c_custkey % 13 = 0 THEN '\\N' ELSE "
    "strftime(DATE '1940-01-01' + CAST((c_custkey * 7919) % 21915 AS INTEGER), '%Y-%m-%d') END",
    "job": "c_mktsegment",
    "nationality": "CAST(c_nationkey AS VARCHAR)",
    "money": "CAST(c_acctbal AS VARCHAR)",
}
_GOODS_MAPPED = {
    "id": "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
    "orderid": "CAST(l_orderkey AS VARCHAR)",
    "productid": "CAST(l_partkey AS VARCHAR)",
    "price": "CAST(l_extendedprice AS VARCHAR)",
    "number": "CAST(l_quantity AS VARCHAR)",
    "status": "l_linestatus",
}
_ORDERS_MAPPED = {
    "id": "CAST(o_orderkey AS VARCHAR)",
    "memberid": "CAST(o_custkey AS VARCHAR)",
    "orderstatus": "o_orderstatus",
    "orderamount": "CAST(o_totalprice AS VARCHAR)",
    "finishtime": "CAST(CAST(epoch_ms(o_orderdate) // 1000 AS BIGINT) AS VARCHAR)",
    "remark": "o_orderpriority",
}


def _typed_users() -> str:
    kinds = {"id": "BIGINT", "birthday": "DATE", "money": "DOUBLE", "nationality": "INTEGER"}
    cells = []
    for c in USERS_COLUMNS:
        v = f"nullif(\"{c}\", '\\N')"
        cells.append(f'TRY_CAST({v} AS {kinds[c]}) AS "{c}"' if c in kinds else f'{v} AS "{c}"')
    return f"SELECT {', '.join(cells)} FROM ({_extract(USERS_COLUMNS, _USERS_MAPPED, 'customer')})"


def _position(key: str, table: str) -> str:
    return f"SELECT id, row_number() OVER (ORDER BY id) AS position FROM (SELECT {key} AS id FROM {table})"


_AS_OF_EV = S.AS_OF_EVENTS
_RECENT_FROM = (_dt.date.fromisoformat(S.AS_OF_EVENTS) - _dt.timedelta(days=S.LOOKBACK_DAYS)).isoformat()


def _segments() -> str:
    """Lloyd's iterations over the measures of two dates, the second from the centres of the first."""
    before = (_dt.date.fromisoformat(_AS_OF_EV) - _dt.timedelta(days=7)).isoformat()

    def measured(as_of: str) -> str:
        recent = f"DATE '{as_of}' - {S.LOOKBACK_DAYS}"
        return f"""SELECT userId, CAST(date_diff('day', CAST(max(t) AS DATE), DATE '{as_of}') AS DOUBLE) AS r,
       CAST(count(*) FILTER (WHERE t >= {recent}) AS DOUBLE) AS f,
       coalesce(round(CAST(count(*) FILTER (WHERE t >= {recent} AND act = 'view') AS DOUBLE)
                / nullif(count(*) FILTER (WHERE t >= {recent} AND act = 'click'), 0), 6), 0.0) AS e
FROM l WHERE t < DATE '{as_of}' GROUP BY userId"""

    def far(c: str) -> str:
        return " + ".join(f"(z[{j}] - {c}[{j}]) * (z[{j}] - {c}[{j}])" for j in (1, 2, 3))

    def near(points: str, centres: str, extra: str = "") -> str:
        best = f"list_min(list_transform(range(1, 5), lambda k: {{'d': {far('c[k]')}, 'k': k}}))"
        return f"(SELECT userId, z, c{extra}, ({best}).k AS k FROM {points}, {centres})"

    def step(name: str, points: str, begin: str) -> str:
        mean = ", ".join(f"round(avg(z[{j}]) FILTER (WHERE k = g), 9)" for j in (1, 2, 3))
        return f"""{name} AS (
  SELECT 0 AS i, {begin} AS c
  UNION ALL
  SELECT i + 1, list(CASE WHEN m[1] IS NULL THEN c[g] ELSE m END ORDER BY g)
  FROM (SELECT i, any_value(c) AS c, g, [{mean}] AS m FROM {near(points, name, ', i')}, (SELECT unnest(range(1, 5)) AS g) WHERE i < 10 GROUP BY i, g)
  GROUP BY i
)"""

    z = "[(r - ar) / sr, (f - af) / sf, (e - ae) / se]"
    start = "[[-t, t, t] FOR t IN [1.5, 0.5, -0.5, -1.5]]"
    return f"""WITH RECURSIVE l AS (SELECT CAST(user_id AS VARCHAR) AS userId, event_type AS act,
                  CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS t FROM events WHERE event_id % 17 <> 0),
one AS ({measured(before)}), two AS ({measured(_AS_OF_EV)}),
u AS (SELECT avg(r) AS ar, avg(f) AS af, avg(e) AS ae, coalesce(nullif(stddev_samp(r), 0), 1) AS sr,
             coalesce(nullif(stddev_samp(f), 0), 1) AS sf, coalesce(nullif(stddev_samp(e), 0), 1) AS se FROM one),
p1 AS (SELECT userId, {z} AS z FROM one, u), p2 AS (SELECT userId, {z} AS z FROM two, u),
{step('c1', 'p1', f'CAST({start} AS DOUBLE[][])')},
{step('c2', 'p2', '(SELECT c FROM c1 WHERE i = 10)')},
last AS (SELECT c FROM c2 WHERE i = 10)
SELECT userId, CAST(k - 1 AS INTEGER) AS rank, round(c[k][1] * sr + ar, 6) AS c_recency, round(c[k][2] * sf + af, 6) AS c_frequency,
       round(c[k][3] * se + ae, 6) AS c_engagement
FROM {near('p2', 'last')}, u"""


def oracle_sql() -> dict[str, str]:
    status = lambda join: _with(f"""st AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 30 GROUP BY rule)
SELECT o.memberId AS userId, st.tag AS tagsId FROM osrc o {join} st ON o.orderstatus = st.rule""")
    exact = lambda pid, col: _with(f"""r AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = {pid} GROUP BY rule)
SELECT u.id AS userId, r.tag AS tagsId FROM users u LEFT JOIN r ON u.{col} = r.rule""")
    cycle_merged_store = f"""n AS (SELECT userId, tagsId FROM cycle),
m AS (SELECT coalesce(n.userId, s.userId) AS userId,
             coalesce(CASE WHEN n.userId IS NOT NULL THEN {_merge('n.tagsId', 's.tagsId')} END, s.tagsId) AS tagsId
      FROM n FULL OUTER JOIN stored s ON n.userId = s.userId)"""
    q = {
        "cycle_tags": _with("SELECT * FROM cycle"),
        "last_purchase": _with("SELECT userId, maxFinishTime FROM lastp"),
        "recency_days": _with("SELECT userId, days FROM days"),
        "gender_tags": exact(4, "gender"),
        "job_tags": exact(7, "job"),
        "job_tags_sql": exact(7, "job"),
        "job_tags_sql_fn": exact(7, "job"),
        "merge_tags_sql": _with(f"""SELECT n.userId, {_merge('n.tagsId', 's.tagsId')} AS tagsId
FROM cycle n LEFT JOIN stored s ON n.userId = s.userId"""),
        "status_tags_null": status("LEFT JOIN"),
        "status_tags_drop": status("JOIN"),
        "distinct_user_tags": _with("""st AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 30 GROUP BY rule)
SELECT DISTINCT o.memberId AS userId, st.tag AS tagsId FROM osrc o JOIN st ON o.orderstatus = st.rule"""),
        "merge_tags": _with(f"""SELECT n.userId, {_merge('n.tagsId', 's.tagsId')} AS tagsId
FROM cycle n LEFT JOIN stored s ON n.userId = s.userId"""),
        "replace_tags": _with("""r AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 4 GROUP BY rule),
n AS (SELECT u.id AS userId, r.tag AS tagsId FROM users u LEFT JOIN r ON u.gender = r.rule)
SELECT coalesce(n.userId, s.userId) AS userId, coalesce(n.tagsId, s.tagsId) AS tagsId
FROM n FULL OUTER JOIN stored s ON n.userId = s.userId"""),
        "upsert_store": _with(f"""st AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 30 GROUP BY rule),
new AS (SELECT o.memberId AS userId, st.tag AS tagsId FROM osrc o JOIN st ON o.orderstatus = st.rule
        UNION ALL SELECT * FROM lists)
SELECT * FROM {_upsert(_collapse('new'), 'stored', True)}"""),
        "store_round_trip": _with(f"""st AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 30 GROUP BY rule),
status AS (SELECT o.memberId AS userId, st.tag AS tagsId FROM osrc o JOIN st ON o.orderstatus = st.rule),
one AS (SELECT * FROM {_upsert(_collapse('status'), 'stored', True)}),
two AS (SELECT * FROM {_upsert(_collapse('lists'), 'one', False)})
SELECT * FROM {_upsert(_collapse('lists'), 'two', True)}"""),
        "model_run_job_merge": _with(f"""r AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 7 GROUP BY rule),
new AS (SELECT u.id AS userId, r.tag AS tagsId FROM users u LEFT JOIN r ON u.job = r.rule)
SELECT * FROM {_upsert('new', 'stored', True)}"""),
        "model_run_cycle_merge": _with(cycle_merged_store + "\nSELECT userId, tagsId FROM m"),
        "model_run_multi": _with("""st AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 30 GROUP BY rule),
toks AS (SELECT userId, tagsId AS t FROM cycle
         UNION ALL SELECT o.memberId, st.tag FROM osrc o JOIN st ON o.orderstatus = st.rule
         UNION ALL SELECT userId, unnest(string_split(tagsId, ',')) FROM stored WHERE tagsId IS NOT NULL),
keys AS (SELECT userId FROM cycle UNION SELECT o.memberId FROM osrc o JOIN st ON o.orderstatus = st.rule
         UNION SELECT userId FROM stored),
ids AS (SELECT userId, TRY_CAST(trim(t) AS BIGINT) AS id FROM toks WHERE TRY_CAST(trim(t) AS BIGINT) IS NOT NULL)
SELECT k.userId, (SELECT array_to_string(list_sort(list_distinct(list(i.id))), ',') FROM ids i WHERE i.userId = k.userId) AS tagsId
FROM keys k"""),
        "tag_coverage": _with(cycle_merged_store + """,
ex AS (SELECT DISTINCT userId, TRY_CAST(trim(t) AS BIGINT) AS tag
       FROM (SELECT userId, unnest(string_split(tagsId, ',')) AS t FROM m WHERE tagsId IS NOT NULL))
SELECT ex.tag AS tagsId, t.name, count(*) AS users
FROM ex LEFT JOIN tax t ON t.id = ex.tag WHERE ex.tag IS NOT NULL
GROUP BY ex.tag, t.name"""),
        "source_select": _with("SELECT id, job FROM users"),
        "rule_map": _with(_catalog_ctes() + """,
parts AS (SELECT id, unnest(string_split(rule, '##')) AS part, unnest(generate_series(1, len(string_split(rule, '##')))) AS pos
          FROM cat WHERE level = 4 AND rule IS NOT NULL),
kv AS (SELECT id, pos, string_split(part, '=') AS f FROM parts)
SELECT id, key, value FROM (
  SELECT id, f[1] AS key, f[2] AS value, row_number() OVER (PARTITION BY id, f[1] ORDER BY pos DESC) AS rn FROM kv)
WHERE rn = 1"""),
        "taxonomy_path_load": _with(_catalog_ctes() + "\nSELECT id, name, level, pid FROM cat"),
        "taxonomy_by_level": _with(_catalog_ctes() + "\nSELECT id, name, pid FROM cat WHERE level = 3"),
        "taxonomy_children": _with(_catalog_ctes() + """
SELECT id, name, level, pid FROM cat
WHERE pid IN (SELECT id FROM cat WHERE name = 'ECONOMY' AND level = 1 AND pid = -1)"""),
        "tag_model_join": _with(_catalog_ctes() + f""",
models AS (SELECT CAST(id AS BIGINT) AS id, CAST(tag_id AS BIGINT) AS tag_id, model_name, CAST(state AS INTEGER) AS state
           FROM {_MODELS}
           UNION ALL
           SELECT id + 100000, id, 'brand_' || CAST(id AS VARCHAR), 1 FROM cat
           WHERE level = 4 AND starts_with(name, 'Brand#1'))
SELECT c.id, c.name, m.id AS model_id, m.model_name, m.state
FROM cat c LEFT JOIN models m ON m.tag_id = c.id WHERE c.level = 4"""),
        "ingest_logs": _parse_logs(False),
        "ingest_arity": _parse_logs(True),
        "ingest_orders": _extract(ORDERS_COLUMNS, _ORDERS_MAPPED, "orders"),
        "ingest_users": _extract(USERS_COLUMNS, _USERS_MAPPED, "customer"),
        "ingest_goods": _extract(GOODS_COLUMNS, _GOODS_MAPPED, "lineitem"),
        "typed_users": _typed_users(),
        "publish_logs": _position("CAST(event_id AS VARCHAR)", "events"),
        "publish_users": _position(_USERS_MAPPED["id"], "customer"),
        "publish_orders": _position(_ORDERS_MAPPED["id"], "orders"),
        "publish_goods": _position(_GOODS_MAPPED["id"], "lineitem"),
        "bulk_sorted_by_key": _parse_logs(False),
        "publish_two_loads": """SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type = 'signup' THEN 'signup/again' ELSE event_type END AS loc_url,
       row_number() OVER (ORDER BY CAST(event_id AS VARCHAR)) AS position
FROM events""",
        "wide_row_range": _with("""s AS (SELECT id, memberId, finishTime, CAST(NULL AS VARCHAR) AS nope FROM osrc)
SELECT * FROM s WHERE id >= '25' AND id < '6' AND memberId NOT LIKE '7%'"""),
        "activity_rfe": f"""WITH l AS (SELECT CAST(user_id AS VARCHAR) AS userId, event_type AS act,
                  CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS t FROM events WHERE event_id % 17 <> 0),
u AS (SELECT * FROM l WHERE t < TIMESTAMP '{_AS_OF_EV} 00:00:00'),
a AS (SELECT userId, max(t) AS last_t,
             count(*) FILTER (WHERE t >= TIMESTAMP '{_RECENT_FROM} 00:00:00') AS frequency,
             count(*) FILTER (WHERE t >= TIMESTAMP '{_RECENT_FROM} 00:00:00' AND act = 'view') AS views,
             count(*) FILTER (WHERE t >= TIMESTAMP '{_RECENT_FROM} 00:00:00' AND act = 'click') AS clicks
      FROM u GROUP BY userId)
SELECT userId, CAST(date_diff('day', CAST(last_t AS DATE), DATE '{_AS_OF_EV}') AS INTEGER) AS recency,
       CAST(frequency AS BIGINT) AS frequency,
       round(CAST(views AS DOUBLE) / nullif(clicks, 0), 6) AS engagement
FROM a""",
        "ingest_outcomes": f"""WITH lines AS (SELECT {_logs_line(True)} AS line FROM events),
stripped AS (SELECT line, regexp_replace(line, chr(1) || '+$', '') AS s FROM lines),
widths AS (SELECT line, CASE WHEN line = '' THEN 1 WHEN s = '' THEN 0 ELSE len(string_split(s, chr(1))) END AS w FROM stripped),
named AS (SELECT CASE WHEN w = {len(LOGS_COLUMNS)} THEN 'kept' WHEN w = {len(LOGS_COLUMNS) - 1} THEN 'repaired' WHEN line = '' THEN 'empty'
                      WHEN w < {len(LOGS_COLUMNS)} THEN 'short' ELSE 'long' END AS outcome FROM widths)
SELECT o.outcome, count(n.outcome) AS observed, count(n.outcome) AS written
FROM (VALUES ('kept'), ('repaired'), ('empty'), ('short'), ('long')) AS o(outcome) LEFT JOIN named n USING (outcome) GROUP BY o.outcome""",
        "category_users": _with(_catalog_ctes() + """,
tree AS (SELECT id, [id] AS up, [name] AS path FROM cat WHERE pid = -1
         UNION ALL SELECT c.id, list_append(t.up, c.id), list_append(t.path, c.name) FROM tree t JOIN cat c ON c.pid = t.id),
named AS (SELECT p_partkey, [p_type, string_split(p_name, ' ')[1], string_split(p_name, ' ')[2], p_brand] AS l FROM part),
cut AS (SELECT p_partkey, l[1:coalesce(list_position(list_transform(l, lambda x: coalesce(x = '', TRUE)), TRUE), 5) - 1] AS path FROM named),
held AS (SELECT DISTINCT o_custkey AS u, unnest(t.up) AS id
         FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN cut ON p_partkey = l_partkey JOIN tree t ON t.path = cut.path)
SELECT cat.id, cat.name, CAST(cat.level AS INTEGER) AS level, count(*) AS users FROM held JOIN cat ON cat.id = held.id GROUP BY ALL""").replace("WITH ", "WITH RECURSIVE ", 1),
        "audience_sets": _with("""st AS (SELECT CAST(max(id) AS VARCHAR) AS tag, rule FROM tax WHERE pid = 30 GROUP BY rule),
lists2 AS (SELECT userId, tagsId FROM stored UNION ALL SELECT o.memberId, st.tag FROM osrc o JOIN st ON o.orderstatus = st.rule),
held AS (SELECT DISTINCT userId, t FROM (SELECT userId, TRY_CAST(trim(unnest(string_split(tagsId, ','))) AS BIGINT) AS t FROM lists2) WHERE t IS NOT NULL),
pairs AS (SELECT g.a, tax.id AS b FROM (VALUES (5), (6)) AS g(a), tax WHERE tax.pid IN (7, 30))
SELECT CAST(t AS VARCHAR) AS audience, count(*) AS users FROM held GROUP BY t
UNION ALL
SELECT CAST(p.a AS VARCHAR) || '+' || CAST(p.b AS VARCHAR), count(y.userId)
FROM pairs p LEFT JOIN held x ON x.t = p.a LEFT JOIN held y ON y.t = p.b AND y.userId = x.userId GROUP BY p.a, p.b"""),
        "activity_rfe_incremental": f"""WITH l AS (SELECT CAST(user_id AS VARCHAR) AS userId, event_type AS act,
                  CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS t FROM events WHERE event_id % 17 <> 0),
d AS (SELECT CAST(unnest(generate_series(DATE '{_AS_OF_EV}' - 6, DATE '{_AS_OF_EV}', INTERVAL 1 DAY)) AS DATE) AS as_of),
a AS (SELECT as_of, userId, max(t) AS last_t, count(*) FILTER (WHERE t >= as_of - {S.LOOKBACK_DAYS}) AS frequency,
             count(*) FILTER (WHERE t >= as_of - {S.LOOKBACK_DAYS} AND act = 'view') AS views,
             count(*) FILTER (WHERE t >= as_of - {S.LOOKBACK_DAYS} AND act = 'click') AS clicks
      FROM d JOIN l ON t < as_of GROUP BY as_of, userId)
SELECT as_of, userId, CAST(date_diff('day', CAST(last_t AS DATE), as_of) AS INTEGER) AS recency, frequency,
       round(CAST(views AS DOUBLE) / nullif(clicks, 0), 6) AS engagement FROM a""",
        "activity_segments": _segments(),
        "visit_hour_tags": """WITH l AS (SELECT CAST(user_id AS VARCHAR) AS userId,
                  (date_part('hour', ts) * 3600 + date_part('minute', ts) * 60 + floor(date_part('second', ts))) * (2 * pi() / 86400) AS a
           FROM events WHERE event_id % 17 <> 0),
h AS (SELECT userId, (atan2(sum(sin(a)), sum(cos(a))) * (12 / pi()) + 24) AS r FROM l GROUP BY userId),
v AS (SELECT userId, CAST(floor(round(r - 24 * floor(r / 24), 6) % 24) AS BIGINT) AS value FROM h)
SELECT userId, value, CAST(91 + value // 6 AS VARCHAR) AS tagsId FROM v""",
        "activity_clusters": f"""SELECT DISTINCT CAST(user_id AS VARCHAR) AS userId, CAST(1 AS BIGINT) AS n_tags,
       TRUE AS ranked, TRUE AS ranks_ordered
FROM events WHERE event_id % 17 <> 0 AND ts < TIMESTAMP '{_AS_OF_EV} 00:00:00'""",
        "age_band_tags": _with(f"""ag AS (SELECT id AS userId, TRY_CAST(birthday AS DATE) AS b FROM users),
age AS (SELECT userId, CAST(year(DATE '{S.AS_OF_ORDERS}') - year(b)
          - CASE WHEN month(DATE '{S.AS_OF_ORDERS}') < month(b)
                   OR (month(DATE '{S.AS_OF_ORDERS}') = month(b) AND day(DATE '{S.AS_OF_ORDERS}') < day(b))
                 THEN 1 ELSE 0 END AS INTEGER) AS age FROM ag)
SELECT a.userId, a.age, CAST(b.tagsId AS VARCHAR) AS tagsId
FROM age a JOIN bands b ON b.pid = 14 AND a.age BETWEEN b.start_ AND b.end_"""),
    }
    return q
