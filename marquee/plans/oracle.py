"""DuckDB SQL for every registered query (the independent oracle).

Each query is ``WITH <derived inputs> <body>``; the derived inputs restate
``marquee.sources.fixtures`` in SQL over the raw parquet views.
"""

from __future__ import annotations

FIXTURE_GENRES = ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE", "brand#2"]

CTE = {
    "ratings": """ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS uid, CAST(l.l_partkey AS INTEGER) AS mid,
         CAST(ceil(l.l_quantity / 10) AS DOUBLE) AS score,
         CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', l.l_shipdate) AS INTEGER) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "movies": """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name, '' AS descri,
         CAST(p_size AS VARCHAR) AS timelong, '' AS issue, '' AS shoot, '' AS language,
         concat_ws('|', p_type, p_brand) AS genres, '' AS actors, '' AS direstors
  FROM part)""",
    "tags": """tags AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS uid, CAST(l.l_partkey AS INTEGER) AS mid,
         o.o_orderpriority AS tag,
         CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o.o_orderdate) AS INTEGER) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "feat": """feat AS MATERIALIZED (
  SELECT CAST(vec_id AS INTEGER) AS mid, CAST((i - 1) // 8 AS INTEGER) AS k, sum(CAST(e AS DOUBLE)) AS f
  FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)
  GROUP BY ALL)""",
    "sims": """nrm AS MATERIALIZED (SELECT mid, sqrt(sum(f * f)) AS nr FROM feat GROUP BY mid),
dots AS MATERIALIZED (
  SELECT a.mid AS mid, b.mid AS other_mid, sum(a.f * b.f) AS d
  FROM feat a JOIN feat b ON a.k = b.k AND a.mid <> b.mid GROUP BY ALL),
sims AS MATERIALIZED (
  SELECT d.mid, d.other_mid, d.d / (x.nr * y.nr) AS sim
  FROM dots d JOIN nrm x ON d.mid = x.mid JOIN nrm y ON d.other_mid = y.mid
  WHERE x.nr > 0 AND y.nr > 0 AND d.d / (x.nr * y.nr) > 0.6)""",
    "log": """log AS MATERIALIZED (
  SELECT CAST(user_id AS INTEGER) AS uid,
         CAST(event_id % (SELECT count(*) FROM embeddings) AS INTEGER) AS mid,
         CAST(least(5.0, 0.5 + floor(value / 10) * 0.5) AS DOUBLE) AS score,
         CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS INTEGER) AS "timestamp",
         ts, event_id
  FROM events)""",
    "trig": """trig AS MATERIALIZED (
  SELECT uid, mid FROM log
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC, mid DESC) = 1)""",
    "rec": """rec AS MATERIALIZED (
  SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC, mid DESC) AS INTEGER) AS pos,
         mid, score
  FROM log QUALIFY pos <= 11)""",
    "hist": """hist AS MATERIALIZED (SELECT DISTINCT uid, mid FROM log)""",
    "cand": """cand AS MATERIALIZED (
  SELECT t.uid, s.other_mid AS mid, s.sim,
         CAST(row_number() OVER (PARTITION BY t.uid ORDER BY s.sim DESC, s.other_mid ASC) AS INTEGER) AS rank
  FROM trig t JOIN sims s ON s.mid = t.mid
  WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.uid = t.uid AND h.mid = s.other_mid)
  QUALIFY rank <= 10)""",
    "scores": """pairs AS (
  SELECT c.uid, c.mid AS cand, r.score AS r_score, s.sim
  FROM cand c JOIN rec r ON c.uid = r.uid JOIN sims s ON s.mid = c.mid AND s.other_mid = r.mid),
scores AS (
  SELECT uid, cand AS mid,
         avg(sim * r_score) + log2(greatest(count_if(r_score > 3), 1))
           - log2(greatest(count_if(r_score <= 3), 1)) AS score
  FROM pairs GROUP BY uid, cand)""",
    "lines": """lines AS (
  SELECT concat_ws(chr(9), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
         CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR),
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR),
         CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR), l_returnflag, l_linestatus,
         strftime(l_shipdate, '%Y-%m-%d'), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
}

# Inputs each CTE needs, in dependency order.
DEPS = {
    "sims": ["feat"],
    "trig": ["log"],
    "rec": ["log"],
    "hist": ["log"],
    "cand": ["feat", "sims", "log", "trig", "hist"],
    "scores": ["feat", "sims", "log", "trig", "rec", "hist", "cand"],
}


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [CTE[n] for n in order] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n" + body


def genre_values() -> str:
    return "genre_seed(genre) AS (VALUES " + ", ".join(f"('{g}')" for g in FIXTURE_GENRES) + ")"
