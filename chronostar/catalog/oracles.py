"""Expected results of the registered queries as SQL over the test tables.

Written as plain set descriptions (``EXISTS``, ``row_number``), not in the shape
of the Spark plans, so that agreement means something.
"""

from __future__ import annotations

import re

from chronostar.schemas import HISTORY, STAR

T1 = "TIMESTAMP '2024-02-01 00:00:00'"
T2 = "TIMESTAMP '2024-02-02 00:00:00'"
OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
BATCH = "20240202"
NO_UPDATE = "CAST(NULL AS INTEGER)"
SNAPSHOTS = "(SELECT 1 AS v UNION ALL SELECT 2) s"

# Common table expressions by name; each statement gets the ones it needs.
VIEWS: dict[str, str] = {
    "categories": """
SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS category_id, p_type AS name
  FROM (SELECT DISTINCT p_type FROM part) t""",
    "subcategories": """
SELECT CAST(row_number() OVER (ORDER BY p_type, p_brand) AS INTEGER) AS subcategory_id, c.category_id, p_brand AS name
  FROM (SELECT DISTINCT p_type, p_brand FROM part) t
  JOIN categories c ON c.name = t.p_type""",
    "users": f"""
SELECT c_custkey AS user_id, c_mktsegment AS first_name, substr(c_name, 10) AS last_name,
       lower(c_name) || '@example.com' AS email,
       CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN v = 2 AND c_custkey % 30 = 6 THEN '555-9999'
            ELSE '555-' || CAST(c_custkey % 10000 AS STRING) END AS phone,
       CASE WHEN v = 2 AND c_custkey % 10 = 3 THEN n_name || ' (moved)' ELSE n_name END AS country,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS TIMESTAMP) AS registered_at, v AS snapshot
  FROM customer
  JOIN nation ON n_nationkey = c_nationkey
  CROSS JOIN {SNAPSHOTS}
 WHERE (v = 1 AND c_custkey % 20 <> 19) OR (v = 2 AND c_custkey % 25 <> 7)""",
    "sales_managers": f"""
SELECT s_suppkey AS manager_id, 'Supplier' AS first_name, substr(s_name, 10) AS last_name,
       CASE WHEN v = 2 AND s_suppkey % 7 = 2 THEN 'new.' ELSE '' END || lower(s_name) || '@example.com' AS email,
       CAST(DATE '1994-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS TIMESTAMP) AS hired_at, v AS snapshot
  FROM supplier
  CROSS JOIN {SNAPSHOTS}""",
    "courses": f"""
SELECT p_partkey AS course_id, p_name AS title, p_type AS subject,
       CASE WHEN p_partkey % 9 = 5 THEN CASE WHEN v = 2 THEN '' ELSE NULL END
            ELSE 'size ' || CAST(p_size AS STRING) END AS description,
       CAST(floor(p_retailprice) AS INTEGER) + CASE WHEN v = 2 AND p_partkey % 9 = 4 THEN 10 ELSE 0 END
         AS price_in_rubbles,
       CAST(DATE '1994-06-01' + CAST(p_partkey % 300 AS INTEGER) AS TIMESTAMP) AS created_at,
       c.category_id, sc.subcategory_id, v AS snapshot
  FROM part
  JOIN categories c ON c.name = p_type
  JOIN subcategories sc ON sc.category_id = c.category_id AND sc.name = p_brand
  CROSS JOIN {SNAPSHOTS}""",
    "li": """
SELECT (l_orderkey * 10 + l_linenumber) * 100000 - 1
         + row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                              ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS id,
       l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_shipdate
  FROM lineitem""",
    "enrollments": f"""
SELECT id AS enrollment_id, o_custkey AS user_id, l_partkey AS course_id, o_orderdate AS enrolled_at,
       CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'cancelled'
            WHEN v = 2 AND o_orderkey % 8 = 1 THEN 'completed' ELSE 'active' END AS status, v AS snapshot
  FROM li
  JOIN orders ON o_orderkey = l_orderkey
  CROSS JOIN {SNAPSHOTS}
 WHERE v = 2 OR o_orderkey % 50 <> 49""",
    "sales": f"""
SELECT id AS sale_id, id AS enrollment_id, l_suppkey AS manager_id, l_shipdate AS sale_date,
       CAST(floor(l_extendedprice) AS INTEGER) * CASE WHEN v = 2 AND l_orderkey % 12 = 6 THEN 2 ELSE 1 END
         AS cost_in_rubbles, v AS snapshot
  FROM li
  CROSS JOIN {SNAPSHOTS}
 WHERE v = 2 OR l_orderkey % 50 <> 49""",
    "traffic_sources": f"""
SELECT CAST(row_number() OVER (PARTITION BY v ORDER BY event_type) AS INTEGER) AS source_id, event_type AS name,
       CASE WHEN v = 2 AND event_type IN ('error', 'signup') THEN 'messaging' WHEN event_type IN ('click', 'view')
            THEN 'web' WHEN event_type = 'purchase' THEN 'referral' ELSE 'ads' END AS channel,
       CASE WHEN event_type = 'view' THEN NULL ELSE 'Weight=' || CAST(v AS STRING) END AS details, v AS snapshot
  FROM (SELECT DISTINCT event_type FROM events) e
  CROSS JOIN {SNAPSHOTS}""",
    "user_traffic": f"""
SELECT user_id, source_id, ts AS referred_at,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'C' || CAST(event_id % 97 AS STRING) ||
            CASE WHEN v = 2 AND event_id % 13 = 4 THEN '-2026' ELSE '-2025' END END AS campaign_code, v AS snapshot
  FROM events
  JOIN (SELECT source_id, name FROM traffic_sources WHERE snapshot = 1) t ON t.name = event_type
  CROSS JOIN {SNAPSHOTS}
 WHERE event_id % 4 <> 3 AND (v = 2 OR event_id % 20 <> 0)""",
    "user_traffic_csv": f"""
SELECT user_id, source_id, ts AS referred_at,
       CASE WHEN event_id % 33 = 2 THEN '' ELSE 'CSV' || CAST(event_id % 89 AS STRING) ||
            CASE WHEN v = 2 AND event_id % 12 = 7 THEN '-2026' ELSE '-2025' END END AS campaign_code, v AS snapshot
  FROM events
  JOIN (SELECT source_id, name FROM traffic_sources WHERE snapshot = 1) t ON t.name = event_type
  CROSS JOIN {SNAPSHOTS}
 WHERE (event_id % 4 = 3 OR event_id % 50 = 2) AND (v = 2 OR event_id % 16 <> 15)""",
}


class _Entity:
    """SQL pieces of one history table; parents are ``(table, natural key, surrogate key)``."""

    def __init__(self, name, sk, key, source, distinct=(), empty=(), parents=(), audit="source_id"):
        self.name, self.sk, self.key, self.source = name, sk, key, source
        self.distinct, self.empty, self.parents, self.audit = distinct, empty, parents, audit
        self.columns = HISTORY[name].names
        self.payload = [c for c in self.columns[1:] if c not in HISTORY_AUDIT and c != audit]

    def source_rows(self, snapshot: int) -> str:
        """Source rows with the keys of their parents' open versions in the same generation."""
        cols = ", ".join(f"x.{c}" if c not in self.keys_of_parents else f"p_{c}.{c}" for c in self.payload)
        carried = "".join(f", x.{n}" for _, n, _ in self.parents if n not in self.payload)
        joins = "".join(
            f"\n  JOIN h{snapshot}_{t} p_{sk} ON p_{sk}.{n} = x.{n} AND p_{sk}.end_date = {OPEN}"
            for t, n, sk in self.parents
        )
        return f"\nSELECT {cols}{carried}\n  FROM ({self.source}) x{joins}\n WHERE x.snapshot = {snapshot}"

    @property
    def keys_of_parents(self) -> list[str]:
        return [sk for _, _, sk in self.parents]

    def same_key(self, a: str, b: str) -> str:
        return " AND ".join(f"{a}.{k} = {b}.{k}" for k in self.key)

    def differs(self, a: str, b: str) -> str:
        tests = [f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in self.distinct]
        tests += [f"coalesce({a}.{c}, '') <> coalesce({b}.{c}, '')" for c in self.empty]
        return "(" + " OR ".join(tests) + ")"

    @property
    def order(self) -> str:
        return "user_id, source_id, referred_at" if self.name == "user_traffic" else ", ".join(self.key)

    @property
    def cols(self) -> str:
        return ", ".join(self.payload)

    @property
    def carried(self) -> str:
        return "".join(f", {n}" for _, n, _ in self.parents if n not in self.payload)


HISTORY_AUDIT = ("start_date", "end_date", "insert_id", "update_id", "source_id_audit")


def _plain(name: str) -> str:
    return f"SELECT * FROM {name}"


COURSE_SOURCE = (
    "SELECT c.*, g.name AS category, b.name AS sub_category FROM courses c "
    "JOIN categories g ON g.category_id = c.category_id JOIN subcategories b ON b.subcategory_id = c.subcategory_id"
)

ENTITIES = {
    e.name: e
    for e in (
        _Entity(
            "users",
            "user_sk",
            ["user_id"],
            _plain("users"),
            distinct=("first_name", "last_name", "email", "phone", "country", "registered_at"),
        ),
        _Entity(
            "sales_managers",
            "sales_manager_sk",
            ["manager_id"],
            _plain("sales_managers"),
            distinct=("first_name", "last_name", "email", "hired_at"),
        ),
        _Entity(
            "courses",
            "course_sk",
            ["course_id"],
            COURSE_SOURCE,
            distinct=("title", "subject", "price_in_rubbles", "created_at", "category", "sub_category"),
            empty=("description",),
        ),
        _Entity(
            "enrollments",
            "enrollment_sk",
            ["enrollment_id"],
            _plain("enrollments"),
            distinct=("user_id", "course_id", "enrolled_at", "status"),
            parents=(("users", "user_id", "user_sk"), ("courses", "course_id", "course_sk")),
        ),
        _Entity(
            "sales",
            "sale_sk",
            ["sale_id"],
            _plain("sales"),
            distinct=("enrollment_id", "manager_id", "sale_date", "cost_in_rubbles"),
            parents=(
                ("enrollments", "enrollment_id", "enrollment_sk"),
                ("sales_managers", "manager_id", "sales_manager_sk"),
            ),
        ),
        _Entity(
            "traffic_sources",
            "traffic_source_sk",
            ["source_id"],
            _plain("traffic_sources"),
            distinct=("name", "channel"),
            empty=("details",),
            audit="source_id_audit",
        ),
        _Entity(
            "user_traffic",
            "user_traffic_sk",
            ["user_sk", "traffic_source_sk", "referred_at"],
            _plain("user_traffic"),
            empty=("campaign_code",),
            parents=(("users", "user_id", "user_sk"), ("traffic_sources", "source_id", "traffic_source_sk")),
            audit="source_id_audit",
        ),
    )
}

CSV = _Entity(
    "user_traffic",
    "user_traffic_sk",
    ["user_id", "source_id", "referred_at"],
    _plain("user_traffic_csv"),
    parents=ENTITIES["user_traffic"].parents,
    audit="source_id_audit",
)


def _opened(e: _Entity, ts: str, batch: int | str, audit: int, sk: str, rows: str) -> str:
    return (
        f"SELECT {sk} AS {e.sk}, {e.cols}, {ts} AS start_date, {OPEN} AS end_date, {audit} AS {e.audit}, "
        f"{batch} AS insert_id, {NO_UPDATE} AS update_id{e.carried}\n  FROM {rows}"
    )


def _numbered(start: str, order: str) -> str:
    return f"{start} + row_number() OVER (ORDER BY {order})"


def _last(table: str, sk: str) -> str:
    return f"(SELECT max({sk}) FROM {table})"


def _merged(e: _Entity, before: str, closed: str, opened: str, audit: int, order: str, batch: str = BATCH) -> str:
    """History ``before`` with the ``closed`` keys ended, plus the ``opened`` rows."""
    return f"""
SELECT {e.sk}, {e.cols}, start_date,
       CASE WHEN {e.sk} IN (SELECT {e.sk} FROM {closed}) THEN {T2} ELSE end_date END AS end_date, {e.audit}, insert_id,
       CASE WHEN {e.sk} IN (SELECT {e.sk} FROM {closed}) THEN {batch} ELSE update_id END AS update_id{e.carried}
  FROM {before}
UNION ALL
{_opened(e, T2, batch, audit, _numbered(_last(before, e.sk), order), opened)}"""


for _e in ENTITIES.values():
    _n = _e.name
    VIEWS[f"s1_{_n}"] = _e.source_rows(1)
    VIEWS[f"s2_{_n}"] = _e.source_rows(2)
    if _n != "user_traffic":
        VIEWS[f"h1_{_n}"] = _opened(_e, T1, 1, 1, _numbered("0", _e.order), f"s1_{_n}")
    # New: no open version. Changed: an open version that differs (one row per pair). Closed: its key.
    VIEWS[f"n2_{_n}"] = (
        f"SELECT * FROM s2_{_n} s WHERE NOT EXISTS (SELECT 1 FROM h1_{_n} w WHERE {_e.same_key('w', 's')})"
    )
    VIEWS[f"c2_{_n}"] = (
        f"SELECT w.{_e.sk}, s.* FROM s2_{_n} s JOIN h1_{_n} w ON {_e.same_key('w', 's')} WHERE {_e.differs('s', 'w')}"
    )
    VIEWS[f"o2_{_n}"] = (
        f"SELECT {_e.cols}{_e.carried} FROM n2_{_n} UNION ALL SELECT {_e.cols}{_e.carried} FROM c2_{_n}"
    )
    VIEWS[f"k2_{_n}"] = f"SELECT {_e.sk} FROM c2_{_n}"
    _target = f"h2_{_n}" if _n != "user_traffic" else "m2_user_traffic"
    VIEWS[_target] = _merged(_e, f"h1_{_n}", f"k2_{_n}", f"o2_{_n}", 1, _e.order)

VIEWS["k2_users"] += (
    "\nUNION ALL SELECT w.user_sk FROM h1_users w WHERE w.user_id NOT IN (SELECT user_id FROM users WHERE snapshot = 2)"
)
VIEWS["s1_csv"], VIEWS["s2_csv"] = CSV.source_rows(1), CSV.source_rows(2)
_UT = ENTITIES["user_traffic"]
VIEWS["h1_user_traffic"] = f"""
{_opened(_UT, T1, 1, 1, _numbered("0", _UT.order), "s1_user_traffic")}
UNION ALL
{_opened(_UT, T1, 1, 2, _numbered("(SELECT count(*) FROM s1_user_traffic)", _UT.order), "s1_csv")}"""

# The extract's pass over the referrals left by the operational pass (m2). Keys match
# through any version of the user and the source; the oldest open referral stands for its key.
VIEWS["b2_csv"] = f"""
SELECT w.user_traffic_sk, w.campaign_code, u.user_id, t.source_id, w.referred_at
  FROM m2_user_traffic w
  JOIN h2_users u ON u.user_sk = w.user_sk
  JOIN h2_traffic_sources t ON t.traffic_source_sk = w.traffic_source_sk
 WHERE w.end_date = {OPEN}"""
VIEWS["n2_csv"] = """
SELECT 0 AS step, s.* FROM s2_csv s
 WHERE NOT EXISTS (SELECT 1 FROM b2_csv b
                    WHERE b.user_id = s.user_id AND b.source_id = s.source_id AND b.referred_at = s.referred_at)"""
VIEWS["a2_csv"] = """
SELECT c.user_id, c.source_id, c.referred_at
  FROM user_traffic_csv c
  JOIN (SELECT *, row_number() OVER (PARTITION BY user_id, source_id, referred_at ORDER BY user_traffic_sk) AS rn
          FROM b2_csv) b
    ON b.rn = 1 AND b.user_id = c.user_id AND b.source_id = c.source_id AND b.referred_at = c.referred_at
 WHERE c.snapshot = 2 AND coalesce(c.campaign_code, '') <> coalesce(b.campaign_code, '')"""
VIEWS["c2_csv"] = "SELECT 1 AS step, s.* FROM s2_csv s JOIN a2_csv USING (user_id, source_id, referred_at)"
VIEWS["k2_csv"] = "SELECT b.user_traffic_sk FROM b2_csv b JOIN a2_csv USING (user_id, source_id, referred_at)"
VIEWS["o2_csv"] = (
    f"SELECT step, {_UT.cols}{_UT.carried} FROM n2_csv UNION ALL SELECT step, {_UT.cols}{_UT.carried} FROM c2_csv"
)
VIEWS["h2_user_traffic"] = _merged(
    CSV, "m2_user_traffic", "k2_csv", "o2_csv", 2, "step, user_id, source_id, referred_at"
)

# --- star ---------------------------------------------------------------------------

DIMENSION_SQL = {
    "dim_user": (
        "users",
        "user_sk AS user_key, user_id, first_name, last_name, email, "
        "CAST(registered_at AS DATE) AS signup_date, country",
    ),
    "dim_course": (
        "courses",
        "course_sk AS course_key, course_id, title, subject, price_in_rubbles, category, sub_category",
    ),
    "dim_traffic_source": (
        "traffic_sources",
        "traffic_source_sk AS traffic_source_key, source_id AS traffic_source_id, name, channel",
    ),
    "dim_sales_manager": (
        "sales_managers",
        "sales_manager_sk AS sales_manager_key, manager_id, first_name, last_name, email, "
        "CAST(hired_at AS DATE) AS hired_at",
    ),
}
for _d, (_t, _cols) in DIMENSION_SQL.items():
    for _g in (1, 2):
        VIEWS[f"d{_g}_{_d}"] = f"SELECT {_cols} FROM h{_g}_{_t} WHERE end_date = {OPEN}"

DATED = {
    "users": "registered_at",
    "courses": "created_at",
    "enrollments": "enrolled_at",
    "sales": "sale_date",
    "user_traffic": "referred_at",
}
VIEWS["bounds"] = "SELECT " + ", ".join(
    f"(SELECT CAST({f}({c}) AS DATE) FROM h1_{t}) AS {f}_{t}" for t, c in DATED.items() for f in ("min", "max")
)
VIEWS["span"] = f"""
SELECT least({", ".join(f"min_{t}" for t in DATED)}) AS first, greatest({", ".join(f"max_{t}" for t in DATED)}) AS last
  FROM bounds"""


def _calendar(span: str) -> str:
    return f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(dayofweek(d) AS INTEGER) AS weekday
  FROM (SELECT unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY)) AS d
          FROM ({span}) s) x"""


VIEWS["d1_dim_date"] = _calendar("SELECT first, last FROM span")


def _latest(table: str, by: str = "user_sk") -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by}
        ORDER BY referred_at DESC, user_traffic_sk DESC) AS rn FROM {table} WHERE end_date = {OPEN}) z WHERE rn = 1"""


def _fact(g: int, open_only: bool) -> str:
    only = f" AND e.end_date = {OPEN}" if open_only else ""
    return f"""
SELECT s.sale_sk AS sale_key, s.sale_id, e.user_sk AS user_key, e.course_sk AS course_key,
       s.sales_manager_sk AS sales_manager_key,
       CAST(coalesce(t.traffic_source_sk, -1) AS BIGINT) AS traffic_source_key, d.date_key,
       s.cost_in_rubbles AS total_in_rubbles, 1 AS enrollment_count
  FROM h{g}_sales s
  JOIN h{g}_enrollments e ON e.enrollment_sk = s.enrollment_sk{only}
  LEFT JOIN ({_latest(f"h{g}_user_traffic")}) t ON t.user_sk = e.user_sk
  JOIN d1_dim_date d ON d.date = CAST(s.sale_date AS DATE)
 WHERE s.end_date = {OPEN}"""


VIEWS["f1"] = _fact(1, False)
VIEWS["f2"] = _fact(2, True)


def statement(body: str) -> str:
    """Prefix ``body`` with the views it needs, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"(?<![\w.]){name}(?!\w)", text):
                need(VIEWS[name])
                if name not in order:
                    order.append(name)

    need(body)
    chain = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    return (f"WITH {chain}\n" if order else "") + body.strip()


def _versions(e: _Entity, source: str, where: str = "TRUE", with_key: bool = True, **override: str) -> str:
    names = HISTORY[e.name].names[0 if with_key else 1 :]
    cols = []
    for n in names:
        expr = override.get(n, n)
        if n == "end_date":
            expr = f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
        elif n == "update_id":
            expr = f"CAST({expr} AS VARCHAR)"
        cols.append(f"{expr} AS {n}")
    return f"SELECT {', '.join(cols)} FROM {source} WHERE {where}"


def _opened_now(e: _Entity, rows: str, audit: int = 1) -> str:
    return _versions(e, f"({_opened(e, T2, BATCH, audit, 'CAST(NULL AS BIGINT)', rows)}) o", with_key=False)


def _closed_now(e: _Entity, before: str, keys: str) -> str:
    return _versions(e, before, f"{e.sk} IN (SELECT {e.sk} FROM {keys})", end_date=T2, update_id=BATCH)


def _checks(name: str, generation: str, tables: dict, parents: str) -> list[str]:
    """One SELECT per declared rule of a table."""
    table = tables[name]
    src = f"{generation}{name}"

    def one(rule: str, column: str, count: str) -> str:
        return (
            f"SELECT '{name}' AS \"table\", '{rule}:{column}' AS rule, '{column}' AS \"column\", "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    required = [c.name for c in table.columns if c.required]
    out = [one("not_null", c, f"SELECT count(*) FROM {src} WHERE {c} IS NULL") for c in required]
    out += [
        one("max_length", c.name, f"SELECT count(*) FROM {src} WHERE length({c.name}) > {c.length}")
        for c in table.columns
        if c.length
    ]
    out += [one("non_negative", c, f"SELECT count(*) FROM {src} WHERE {c} < 0") for c in table.non_negative]
    for c, values in table.enums.items():
        allowed = ", ".join(f"'{v}'" for v in values)
        out.append(one("enum", c, f"SELECT count(*) FROM {src} WHERE {c} NOT IN ({allowed})"))
    for key in table.unique:
        k = ",".join(key)
        out.append(one("unique", k, f"SELECT count(*) FROM (SELECT {k} FROM {src} GROUP BY {k} HAVING count(*) > 1) q"))
    for fk in table.foreign_keys:
        parent = f"{parents}{fk.parent}" if fk.parent != "dim_date" else "d1_dim_date"
        out.append(
            one(
                "foreign_key",
                fk.column,
                f"SELECT count(*) FROM {src} x WHERE {fk.column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE p.{fk.parent_column} = x.{fk.column})",
            )
        )
    return out


# The operational tables' rules, written out: required columns, lengths, keys, parents.
SOURCE_RULES = {
    "users": (
        "user_id first_name last_name email country registered_at",
        {"first_name": 100, "last_name": 100, "email": 255, "phone": 20, "country": 100},
        ["user_id", "email"],
        {},
    ),
    "sales_managers": (
        "manager_id first_name last_name email hired_at",
        {"first_name": 100, "last_name": 100, "email": 255},
        ["manager_id", "email"],
        {},
    ),
    "courses": (
        "course_id title subject price_in_rubbles created_at category_id subcategory_id",
        {"title": 255, "subject": 100},
        ["course_id"],
        {"category_id": "categories", "subcategory_id": "subcategories"},
    ),
    "enrollments": (
        "enrollment_id user_id course_id enrolled_at status",
        {"status": 20},
        ["enrollment_id"],
        {"user_id": "users", "course_id": "courses"},
    ),
    "sales": (
        "sale_id enrollment_id manager_id sale_date cost_in_rubbles",
        {},
        ["sale_id", "enrollment_id"],
        {"enrollment_id": "enrollments", "manager_id": "sales_managers"},
    ),
    "traffic_sources": ("source_id name channel", {"name": 100, "channel": 100}, ["source_id"], {}),
    "user_traffic": (
        "user_id source_id referred_at",
        {"campaign_code": 50},
        ["user_id,source_id,referred_at"],
        {"user_id": "users", "source_id": "traffic_sources"},
    ),
    "categories": ("category_id name", {"name": 100}, ["category_id", "name"], {}),
    "subcategories": ("subcategory_id category_id name", {"name": 100}, ["subcategory_id"], {"category_id": "categories"}),
}
SOURCE_CHECKS = {
    ("courses", "non_negative", "price_in_rubbles"): "price_in_rubbles < 0",
    ("sales", "non_negative", "cost_in_rubbles"): "cost_in_rubbles < 0",
    ("enrollments", "enum", "status"): "status NOT IN ('active', 'completed', 'cancelled')",
}


def _source_checks() -> list[str]:
    found = []

    def one(table: str, rule: str, column: str, count: str) -> None:
        found.append(
            f"SELECT '{table}' AS \"table\", '{rule}:{column}' AS rule, '{column}' AS \"column\", "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    def rows(table: str) -> str:
        plain = table in ("categories", "subcategories")
        return table if plain else f"(SELECT * FROM {table} WHERE snapshot = 1)"

    for t, (required, lengths, keys, parents) in SOURCE_RULES.items():
        for c in required.split():
            one(t, "not_null", c, f"SELECT count(*) FROM {rows(t)} x WHERE {c} IS NULL")
        for c, n in lengths.items():
            one(t, "max_length", c, f"SELECT count(*) FROM {rows(t)} x WHERE length({c}) > {n}")
        for k in keys:
            repeated = f"SELECT {k} FROM {rows(t)} x GROUP BY {k} HAVING count(*) > 1"
            one(t, "unique", k, f"SELECT count(*) FROM ({repeated}) q")
        for c, parent in parents.items():
            missing = f"{c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {rows(parent)} p)"
            one(t, "foreign_key", c, f"SELECT count(*) FROM {rows(t)} x WHERE {missing}")
    for (t, rule, c), broken in SOURCE_CHECKS.items():
        one(t, rule, c, f"SELECT count(*) FROM {rows(t)} x WHERE {broken}")
    return found


VIEWS["d2_fact_sales"] = "SELECT * FROM f2"
VIEWS["d2_dim_date"] = "SELECT * FROM d1_dim_date"


def _bodies() -> dict[str, str]:
    sql: dict[str, str] = {}
    for e in ENTITIES.values():
        n = e.name
        start = _opened(e, T1, 1, 1, _numbered("0", e.order), f"s1_{n}")
        sql[f"scd2_{n}_initial"] = _versions(e, f"({start}) o")
        sql[f"scd2_{n}_new"] = _opened_now(e, f"n2_{n}")
        sql[f"scd2_{n}_changed"] = _opened_now(e, f"c2_{n}")
        sql[f"scd2_{n}_closed"] = _closed_now(e, f"h1_{n}", f"c2_{n}")
        sql[f"scd2_{n}_merge"] = _versions(e, f"h2_{n}" if n != "user_traffic" else "m2_user_traffic")
    users, ut = ENTITIES["users"], ENTITIES["user_traffic"]
    sql["scd2_users_deleted"] = _versions(
        users,
        "h1_users",
        "user_id NOT IN (SELECT user_id FROM users WHERE snapshot = 2)",
        end_date=T2,
        update_id=BATCH,
    )
    csv_start = _opened(ut, T1, 1, 2, _numbered("(SELECT count(*) FROM s1_user_traffic)", ut.order), "s1_csv")
    sql["scd2_user_traffic_csv_initial"] = _versions(ut, f"({csv_start}) o")
    sql["scd2_user_traffic_csv_new"] = _opened_now(ut, "n2_csv", 2)
    sql["scd2_user_traffic_csv_changed"] = _opened_now(ut, "c2_csv", 2)
    sql["scd2_user_traffic_csv_closed"] = _closed_now(ut, "m2_user_traffic", "k2_csv")
    sql["scd2_user_traffic_csv_merge"] = _versions(ut, "h2_user_traffic")
    sql["user_traffic_union"] = """
SELECT user_id, source_id, referred_at, campaign_code, 1 AS source_id_audit FROM user_traffic WHERE snapshot = 1
UNION ALL
SELECT user_id, source_id, referred_at, campaign_code, 2 FROM user_traffic_csv WHERE snapshot = 1"""
    sql["user_traffic_partial_key_match"] = """
SELECT s.user_sk, s.traffic_source_sk, s.referred_at, s.campaign_code, count(*) AS versions
  FROM s2_user_traffic s
  JOIN (SELECT referred_at, campaign_code FROM h1_user_traffic
        UNION ALL SELECT referred_at, campaign_code FROM n2_user_traffic) w
    ON w.referred_at = s.referred_at AND coalesce(w.campaign_code, '') <> coalesce(s.campaign_code, '')
 GROUP BY ALL"""

    for d, (t, cols) in DIMENSION_SQL.items():
        key = cols.split(" ")[0]
        dim_key = STAR[d].names[0]
        touched = f"SELECT {key} FROM h2_{t} WHERE insert_id = {BATCH} OR update_id = {BATCH}"
        sql[d] = f"SELECT * FROM d1_{d}"
        sql[f"{d}_refresh"] = f"""
SELECT * FROM d1_{d} WHERE {dim_key} NOT IN ({touched})
UNION ALL
SELECT * FROM d2_{d} WHERE {dim_key} IN ({touched})"""
        if d in ("dim_user", "dim_traffic_source"):
            sql[f"{d}_fill_missing"] = f"SELECT * FROM d1_{d} UNION SELECT * FROM d2_{d}"
    sql["dim_date"] = "SELECT * FROM d1_dim_date"
    sql["dim_date_extend"] = _calendar(
        f"""SELECT least(lo, a) AS first, greatest(hi, b) AS last
  FROM (SELECT CAST(min(created_at) AS DATE) AS lo, CAST(max(created_at) AS DATE) AS hi FROM h1_courses) c,
       (SELECT CAST(min(sale_date) AS DATE) AS a, CAST(max(sale_date) AS DATE) AS b FROM h2_sales
         WHERE insert_id = {BATCH} AND end_date = {OPEN}) n"""
    )
    sql["dim_date_day_count"] = """
SELECT first, last, CAST(date_diff('day', first, last) + 1 AS INTEGER) AS days FROM span"""
    sql["fact_sales"] = "SELECT * FROM f1"
    sql["fact_sales_rebuild"] = "SELECT * FROM f2"
    sql["fact_sales_current_keys"] = f"""
SELECT s.sale_sk AS sale_key, s.sale_id,
       CAST(coalesce((SELECT u.user_sk FROM h2_users u WHERE u.end_date = {OPEN} AND u.user_id = e.user_id), -1)
         AS BIGINT) AS user_key,
       CAST(coalesce(c.course_sk, -1) AS BIGINT) AS course_key,
       CAST(coalesce(m.sales_manager_sk, -1) AS BIGINT) AS sales_manager_key,
       CAST(coalesce(a.traffic_source_sk, -1) AS BIGINT) AS traffic_source_key, d.date_key,
       s.cost_in_rubbles AS total_in_rubbles, 1 AS enrollment_count
  FROM h2_sales s
  JOIN h2_enrollments e ON e.enrollment_id = s.enrollment_id AND e.end_date = {OPEN}
  LEFT JOIN h2_courses c ON c.course_id = e.course_id AND c.end_date = {OPEN}
  LEFT JOIN h2_sales_managers m ON m.manager_id = s.manager_id AND m.end_date = {OPEN}
  LEFT JOIN ({_latest("h2_user_traffic", "user_id")}) t ON t.user_id = e.user_id
  LEFT JOIN h2_traffic_sources a ON a.source_id = t.source_id AND a.end_date = {OPEN}
  JOIN d1_dim_date d ON d.date = CAST(s.sale_date AS DATE)
 WHERE s.end_date = {OPEN}"""
    sql["latest_traffic_per_user"] = (
        f"SELECT user_sk, traffic_source_sk, referred_at, campaign_code FROM ({_latest('h2_user_traffic')}) l"
    )

    sql["pred_is_distinct_from"] = """
SELECT a.user_id, a.phone AS old_phone, b.phone AS new_phone FROM users a JOIN users b ON a.user_id = b.user_id
 WHERE a.snapshot = 1 AND b.snapshot = 2 AND a.phone IS DISTINCT FROM b.phone"""
    sql["pred_null_as_empty"] = """
SELECT a.course_id, a.description IS DISTINCT FROM b.description AS null_safe,
       coalesce(a.description, '') <> coalesce(b.description, '') AS null_as_empty
  FROM courses a JOIN courses b ON a.course_id = b.course_id WHERE a.snapshot = 1 AND b.snapshot = 2"""
    sql["join_inner_lookup"] = "SELECT course_id, category, sub_category FROM s1_courses"
    sql["join_active_lookup"] = "SELECT enrollment_id, user_sk, course_sk FROM s2_enrollments"
    sql["join_anti_new"] = "SELECT user_id, email FROM n2_users"
    sql["join_composite_key"] = """
SELECT s.user_sk, s.traffic_source_sk, s.referred_at, s.campaign_code AS source_campaign, w.user_traffic_sk,
       w.campaign_code AS stored_campaign
  FROM s2_user_traffic s JOIN h1_user_traffic w
    ON (w.user_sk, w.traffic_source_sk, w.referred_at) = (s.user_sk, s.traffic_source_sk, s.referred_at)"""
    sql["join_left_default"] = f"""
SELECT e.enrollment_sk, CAST(coalesce(t.traffic_source_sk, -1) AS BIGINT) AS traffic_source_key
  FROM h1_enrollments e LEFT JOIN ({_latest("h1_user_traffic")}) t ON t.user_sk = e.user_sk"""
    sql["join_date_dim"] = """
SELECT s.sale_id, d.date_key, d.weekday FROM h1_sales s JOIN d1_dim_date d ON d.date = CAST(s.sale_date AS DATE)"""
    sql["join_semi_touched"] = f"""
SELECT * FROM d1_dim_user WHERE user_key IN
  (SELECT user_sk FROM h2_users WHERE insert_id = {BATCH} OR update_id = {BATCH})"""
    sql["join_scalar_subquery"] = """
SELECT e.enrollment_sk, e.enrollment_id,
       (SELECT u.user_id FROM h2_users u WHERE u.user_sk = e.user_sk) AS user_id,
       (SELECT c.course_id FROM h2_courses c WHERE c.course_sk = e.course_sk) AS course_id
  FROM h2_enrollments e"""

    def counts(g: int) -> str:
        rows = [f"SELECT 'warehouse' AS layer, '{t}' AS \"table\", count(*) AS rows FROM h{g}_{t}" for t in HISTORY]
        stars = {**{d: f"d{g}_{d}" for d in DIMENSION_SQL}, "dim_date": "d1_dim_date", "fact_sales": f"f{g}"}
        rows += [f"SELECT 'star_schema', '{t}', count(*) FROM {v}" for t, v in stars.items()]
        return "\nUNION ALL ".join(rows)

    sql["agg_row_counts"] = counts(2)
    sql["full_load"] = counts(1)
    sql["incremental_load"] = "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) FILTER (end_date = {OPEN}) AS open, "
        f"count(*) FILTER (end_date <> {OPEN}) AS closed, "
        f"count(*) FILTER (insert_id = {BATCH} OR update_id = {BATCH}) AS touched FROM h2_{t}"
        for t in HISTORY
    )
    # The extract alone on top of the full load: every open referral is still the first generation's.
    sql["stream_csv_arrivals"] = f"""
WITH acts AS (
  SELECT c.user_id, c.source_id, c.referred_at, c.campaign_code
    FROM (SELECT * FROM user_traffic_csv WHERE snapshot = 2) c
    JOIN (SELECT *, row_number() OVER (PARTITION BY user_id, source_id, referred_at ORDER BY user_traffic_sk) AS rn
            FROM h1_user_traffic) w
      ON w.rn = 1 AND w.user_id = c.user_id AND w.source_id = c.source_id AND w.referred_at = c.referred_at
   WHERE c.campaign_code <> coalesce(w.campaign_code, '')),
fresh AS (
  SELECT user_id, source_id, referred_at, campaign_code FROM user_traffic_csv c
   WHERE snapshot = 2 AND NOT EXISTS (SELECT 1 FROM h1_user_traffic w WHERE w.user_id = c.user_id
           AND w.source_id = c.source_id AND w.referred_at = c.referred_at)
  UNION ALL SELECT * FROM acts),
hit AS (
  SELECT w.user_traffic_sk FROM h1_user_traffic w JOIN acts USING (user_id, source_id, referred_at))
SELECT user_sk, traffic_source_sk, referred_at, campaign_code, start_date,
       CASE WHEN user_traffic_sk IN (SELECT user_traffic_sk FROM hit) THEN '2024-02-02 00:00:00'
            ELSE '9999-12-31 00:00:00' END AS end_date,
       source_id_audit, insert_id,
       CASE WHEN user_traffic_sk IN (SELECT user_traffic_sk FROM hit) THEN '{BATCH}' END AS update_id
  FROM h1_user_traffic
UNION ALL
SELECT u.user_sk, t.traffic_source_sk, f.referred_at, f.campaign_code, {T2}, '9999-12-31 00:00:00', 2, {BATCH}, NULL
  FROM fresh f JOIN h1_users u ON u.user_id = f.user_id JOIN h1_traffic_sources t ON t.source_id = f.source_id"""
    sql["csv_extract_scan"] = """
SELECT user_id, source_id, referred_at, 'say "' || campaign_code || '",' || chr(10) || 'twice' AS campaign_code
  FROM user_traffic_csv WHERE snapshot = 1"""
    sql["csv_extract_rejects"] = """
SELECT CAST(4 - short::INT + long::INT AS INTEGER) AS n_fields, 4 AS n_columns,
       user_id || CASE WHEN short THEN '' ELSE ',' || source_id END || ',' || strftime(referred_at, '%Y-%m-%d')
         || ',' || campaign_code || CASE WHEN long THEN ',more' ELSE '' END AS record
  FROM (SELECT user_id % 13 = 4 AS short, user_id % 17 = 6 AS long, user_id, source_id, referred_at, campaign_code
          FROM user_traffic_csv WHERE snapshot = 1) r
 WHERE short <> long"""
    sql["agg_date_bounds"] = "SELECT * FROM bounds"
    sql["agg_batch_sale_bounds"] = f"""
SELECT CAST(min(sale_date) AS DATE) AS min_sale_date, CAST(max(sale_date) AS DATE) AS max_sale_date
  FROM h2_sales WHERE insert_id = {BATCH} AND end_date = {OPEN}"""
    sql["agg_least_greatest"] = "SELECT first, last FROM span"
    summary = []
    for e in ENTITIES.values():
        n = e.name
        for label, rows in (
            ("new", f"n2_{n}"),
            ("changed", f"c2_{n}"),
            (
                "unchanged",
                f"(SELECT 1 FROM s2_{n} s JOIN h1_{n} w ON {e.same_key('w', 's')} WHERE NOT {e.differs('s', 'w')}) q",
            ),
            (
                "missing",
                f"(SELECT 1 FROM h1_{n} w WHERE NOT EXISTS (SELECT 1 FROM s2_{n} s WHERE {e.same_key('w', 's')})) q",
            ),
        ):
            summary.append(
                f"SELECT '{n}' AS \"table\", '{label}' AS class, count(*) AS rows FROM {rows} HAVING count(*) > 0"
            )
    for label, rows in (("new", "n2_csv"), ("changed", "c2_csv"), ("closed", "k2_csv")):
        summary.append(
            f"SELECT 'user_traffic_csv' AS \"table\", '{label}' AS class, count(*) AS rows FROM {rows} HAVING count(*) > 0"
        )
    sql["agg_merge_summary"] = "\nUNION ALL ".join(summary)

    sql["assign_surrogate_keys"] = """
SELECT o_orderkey, o_orderdate, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk FROM orders"""
    sql["limit_sample"] = "SELECT * FROM d1_dim_course ORDER BY course_key LIMIT 5"
    sql["top_users_by_id"] = _versions(users, "h1_users") + " ORDER BY user_id DESC LIMIT 5"
    sql["insert_ignore_conflicts"] = """
SELECT sale_id, manager_id, CAST(sale_date AS DATE) AS day FROM sales WHERE snapshot = 1
UNION ALL
SELECT id, l_suppkey, day
  FROM (SELECT (l_orderkey * 10 + l_linenumber) * 100000 AS id, l_suppkey, CAST(l_shipdate AS DATE) AS day,
               row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
                                  ORDER BY CAST(l_shipdate AS DATE), l_suppkey) AS rn
          FROM lineitem) x
 WHERE rn = 1 AND id NOT IN (SELECT sale_id FROM sales WHERE snapshot = 1)"""
    sql["scalar_casts"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_key,
       CAST(floor(o_totalprice) AS INTEGER) AS price, CAST(o_orderkey AS VARCHAR) AS key_text,
       TIMESTAMP '2024-02-01 10:20:30' AS stamp FROM orders"""
    sql["last_month_range"] = """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
       CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS first_day,
       CAST(date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS DATE) AS last_day FROM orders"""
    sql["batch_id_from_date"] = """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS batch_id
  FROM orders"""

    sql["upsert_users"] = """
SELECT * EXCLUDE (snapshot) FROM users u
 WHERE snapshot = 2 OR user_id NOT IN (SELECT user_id FROM users WHERE snapshot = 2)"""
    sql["update_traffic_sources"] = """
SELECT a.source_id, a.name, CASE WHEN b.name <> 'click' THEN b.channel ELSE a.channel END AS channel,
       CASE WHEN b.name <> 'click' THEN b.details ELSE a.details END AS details
  FROM traffic_sources a JOIN traffic_sources b ON a.source_id = b.source_id WHERE a.snapshot = 1 AND b.snapshot = 2"""
    sql["delete_users"] = """
SELECT * EXCLUDE (snapshot) FROM users
 WHERE snapshot = 1 AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
    sql["delete_users_list"] = """
SELECT * EXCLUDE (snapshot) FROM users
 WHERE snapshot = 1 AND user_id % 3 <> 1 AND email NOT LIKE '%7@example.com'"""
    sql["double_last_month_cost"] = """
SELECT sale_id, enrollment_id, manager_id, sale_date,
       CASE WHEN CAST(sale_date AS DATE) BETWEEN DATE '1997-02-01' AND DATE '1997-02-28' THEN cost_in_rubbles * 2
            ELSE cost_in_rubbles END AS cost_in_rubbles
  FROM sales WHERE snapshot = 1"""

    sql["revenue_by_quarter"] = """
SELECT d.year, d.quarter, CAST(sum(f.total_in_rubbles) AS BIGINT) AS revenue,
       CAST(sum(f.enrollment_count) AS BIGINT) AS sales
  FROM f1 f JOIN d1_dim_date d ON d.date_key = f.date_key GROUP BY d.year, d.quarter"""
    pivot = ", ".join(
        f"CAST(coalesce(sum(f.total_in_rubbles) FILTER (coalesce(t.channel, 'unknown') = '{c}'), 0) AS BIGINT) AS {c}"
        for c in ("ads", "messaging", "referral", "web", "unknown")
    )
    pivot += ", CAST(0 AS BIGINT) AS other"
    sql["traffic_source_pivot"] = f"""
SELECT d.year, d.quarter, {pivot}
  FROM f1 f JOIN d1_dim_date d ON d.date_key = f.date_key
  LEFT JOIN d1_dim_traffic_source t ON t.traffic_source_key = f.traffic_source_key GROUP BY d.year, d.quarter"""
    # After the merge: from the open sales and what they refer to now, without any surrogate key.
    merged = f"""
WITH acts AS (
SELECT s.cost_in_rubbles AS revenue, CAST(s.sale_date AS DATE) AS day, e.course_id, c.title, u.country, c.category,
       a.channel
  FROM h2_sales s
  JOIN h2_enrollments e ON e.enrollment_id = s.enrollment_id AND e.end_date = {OPEN}
  LEFT JOIN h2_courses c ON c.course_id = e.course_id AND c.end_date = {OPEN}
  LEFT JOIN h2_users u ON u.user_id = e.user_id AND u.end_date = {OPEN}
  LEFT JOIN ({_latest("h2_user_traffic", "user_id")}) t ON t.user_id = e.user_id
  LEFT JOIN h2_traffic_sources a ON a.source_id = t.source_id AND a.end_date = {OPEN}
 WHERE s.end_date = {OPEN})"""
    totals = "CAST(sum(revenue) AS BIGINT) AS revenue, count(*) AS sales"
    quarter = "CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter"
    sql["revenue_by_quarter_merged"] = f"{merged}\nSELECT {quarter}, {totals} FROM acts GROUP BY 1, 2"
    channels = ", ".join(
        f"CAST(coalesce(sum(revenue) FILTER (coalesce(channel, 'unknown') = '{c}'), 0) AS BIGINT) AS {c}"
        for c in ("ads", "messaging", "referral", "web", "unknown")
    )
    sql["traffic_source_pivot_merged"] = f"""{merged}
SELECT {quarter}, {channels}, CAST(0 AS BIGINT) AS other FROM acts GROUP BY 1, 2"""
    sql["top_selling_courses_merged"] = f"""{merged}
SELECT course_id, title, {totals} FROM acts GROUP BY course_id, title ORDER BY revenue DESC, course_id LIMIT 10"""
    sql["filtered_revenue_merged"] = f"""{merged}
SELECT coalesce(country, 'unknown') AS country, coalesce(category, 'unknown') AS category, {totals}
  FROM acts GROUP BY 1, 2"""
    names = ("open sales", "fact", "revenue by quarter", "top selling courses", "filtered revenue")
    open_sales = f"FROM h2_sales WHERE end_date = {OPEN}"
    amount = "CAST(sum(cost_in_rubbles) AS BIGINT) AS revenue"
    sql["fact_reconciliation"] = "\nUNION ALL ".join(
        [f"SELECT '{n}' AS report, {amount}, count(*) AS sales {open_sales}" for n in names]
        + [f"SELECT 'traffic source pivot' AS report, {amount}, CAST(NULL AS BIGINT) AS sales {open_sales}"]
    )
    sql["top_selling_courses"] = """
SELECT c.course_id, c.title, CAST(sum(f.total_in_rubbles) AS BIGINT) AS revenue,
       CAST(sum(f.enrollment_count) AS BIGINT) AS sales
  FROM f1 f JOIN d1_dim_course c ON c.course_key = f.course_key
 GROUP BY c.course_id, c.title ORDER BY revenue DESC, c.course_id LIMIT 10"""
    sql["filtered_revenue"] = """
SELECT u.country, c.category, CAST(sum(f.total_in_rubbles) AS BIGINT) AS revenue,
       CAST(sum(f.enrollment_count) AS BIGINT) AS sales
  FROM f1 f
  JOIN d1_dim_user u ON u.user_key = f.user_key
  JOIN d1_dim_course c ON c.course_key = f.course_key
  JOIN d1_dim_date d ON d.date_key = f.date_key
 WHERE c.category IN ('ECONOMY', 'PROMO', 'STANDARD') AND d.date BETWEEN DATE '1995-01-01' AND DATE '1997-06-30'
   AND u.country IN ('NATION_1', 'NATION_2', 'NATION_3')
 GROUP BY u.country, c.category"""

    def rule(table: str, name: str, column: str, source: str, broken: str) -> str:
        return (
            f"SELECT '{table}' AS \"table\", '{name}:{column}' AS rule, '{column}' AS \"column\", "
            f"count(*) AS violations FROM {source} WHERE {broken}"
        )

    sql["dq_not_null"] = "\nUNION ALL ".join(
        rule("users", "not_null", c, "h2_users", f"{c} IS NULL") for c in HISTORY["users"].names
    )
    sql["dq_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
    sql["dq_foreign_key"] = "\nUNION ALL ".join(
        f"""SELECT '{fk.column}' AS "column", '{fk.parent}' AS parent, CAST({fk.column} AS BIGINT) AS key,
       count(*) AS rows FROM f2 WHERE {fk.column} NOT IN (SELECT {fk.parent_column} FROM d2_{fk.parent})
 GROUP BY {fk.column}"""
        for fk in STAR["fact_sales"].foreign_keys
    )
    sql["dq_max_length"] = "\nUNION ALL ".join(
        rule("customer", "max_length", c, "customer", f"length({c}) > {n}")
        for c, n in (("c_name", 17), ("c_mktsegment", 9))
    )
    sql["dq_non_negative"] = rule("customer", "non_negative", "c_acctbal", "customer", "c_acctbal < 0")
    sql["dq_enum"] = "\nUNION ALL ".join(
        (
            rule("orders", "enum", "o_orderstatus", "orders", "o_orderstatus NOT IN ('F', 'O')"),
            rule("orders", "enum", "o_orderpriority", "orders", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"),
        )
    )
    sql["dq_single_active"] = f"""
SELECT user_id, source_id, referred_at, count(*) AS rows FROM h2_user_traffic WHERE end_date = {OPEN}
 GROUP BY user_id, source_id, referred_at HAVING count(*) > 1"""
    sql["dq_source_rules"] = "\nUNION ALL ".join(_source_checks())
    checks = [c for t in HISTORY for c in _checks(t, "h2_", HISTORY, "h2_")]
    checks += [c for t in STAR for c in _checks(t, "d2_", STAR, "d2_")]
    sql["dq_declared_rules"] = "\nUNION ALL ".join(checks)
    return sql


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in _bodies().items():
        body = body.strip()
        if body.startswith("WITH "):
            views = statement(body)
            head, _, _ = views.rpartition("WITH acts AS")
            out[name] = head.rstrip() + ",\nacts AS" + body.removeprefix("WITH acts AS")
        else:
            out[name] = statement(body)
    return out
