"""Common table expressions: the estate tables of FIXTURES.md and the results built on them."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"
CUTOFF = f"({AS_OF} - INTERVAL 180 DAY)"


def floor_days(later: str, earlier: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {earlier}, {later}) / 86400000000.0) AS BIGINT)"


def round2(x: str) -> str:
    """Half to even on the binary value; the error term is what x*100 lost to rounding."""
    t = f"({x} * CAST(100 AS DOUBLE))"
    c = f"({x} * CAST(134217729 AS DOUBLE))"
    hi = f"({c} - ({c} - {x}))"
    err = f"(({hi} * CAST(100 AS DOUBLE) - {t}) + ({x} - {hi}) * CAST(100 AS DOUBLE))"
    n = f"floor({t})"
    d = f"(({t} - {n}) - CAST(0.5 AS DOUBLE))"
    up = f"({d} > 0 OR ({d} = 0 AND ({err} > 0 OR ({err} = 0 AND {n} % 2 = 1))))"
    return f"((CASE WHEN {up} THEN {n} + 1 ELSE {n} END) / CAST(100 AS DOUBLE))"


def total(x: str) -> str:
    return f"COALESCE(CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE), CAST(0 AS DOUBLE))"


def float_text(x: str) -> str:
    return rf"regexp_replace(CAST(CAST({x} AS DECIMAL(28,2)) AS VARCHAR), '(\.\d)0$', '\1')"


def _newest(events: str, k: int = 5) -> str:
    return f"""
      SELECT project_id, region, dataset_id, max(creation_time) AS last_time,
             string_agg(strftime(creation_time, '%Y-%m-%d %H:%M') || ' (' || user_email || ')', chr(10) ORDER BY rn) AS details
      FROM (SELECT *, row_number() OVER (PARTITION BY project_id, region, dataset_id
                                         ORDER BY creation_time DESC, user_email) AS rn FROM {events})
      WHERE rn <= {k} GROUP BY project_id, region, dataset_id"""


TEST_NAME = "regexp_matches(lower(dataset_id), 'test|temp|tmp|demo|poc|beta')"
UNUSED = "(last_read_time IS NULL AND last_write_time IS NULL)"
ABANDONED = "(touched IS NULL OR touched > 365)"
GONE_OR_ZERO = "COALESCE(size, CAST(0 AS DOUBLE))"
RANK = (
    "CASE tranche WHEN 'Tranche 1: Abandoned Test/Temp (>1yr)' THEN 0 WHEN 'Tranche 2: Abandoned Large Prod (>1yr)' THEN 1 "
    "WHEN 'Tranche 3: Abandoned Small Prod (>1yr)' THEN 2 WHEN 'Tranche 4: Stale (No Access 180d, No Write >6mo)' THEN 3 "
    "WHEN 'Tranche 5: Active Test (Housekeeping)' THEN 4 WHEN 'Active' THEN 5 ELSE 99 END"
)
SHEET_ORDER = f"{RANK}, size_gb DESC, project, region, dataset"

CTES: dict[str, str] = {
    "parts": """
      SELECT p_partkey, p_size, p_partkey // 4 AS gid, r_name AS project_id,
             CASE WHEN ((p_partkey // 4) // 5) % 2 = 0 THEN 'eu' ELSE 'europe-west2' END AS region,
             ['test_area','tmp_load','poc','orders_latest','sales','core','billing','crm'][(p_partkey // 4) % 8 + 1]
               || '_' || (p_partkey // 4) AS dataset_id,
             't_' || p_partkey AS table_name
      FROM part JOIN region ON r_regionkey = (p_partkey // 4) % 5""",
    "datasets": "SELECT DISTINCT gid, project_id, region, dataset_id FROM parts",
    "descriptions": """
      SELECT project_id, region, dataset_id, '"desc ' || gid || '"' AS description FROM datasets WHERE gid % 3 = 0""",
    "tables": """
      SELECT project_id, region, dataset_id, table_name,
             TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * ((p_partkey * 37) % 2400) AS creation_time
      FROM parts""",
    "changes": f"""
      SELECT l_partkey, sum(l_quantity) AS quantity,
             max(CASE WHEN l_shipdate < {AS_OF} AND ((l_partkey // 4) % 3 = 0
                       OR ((l_partkey // 4) % 3 = 1 AND l_quantity >= 40) OR l_quantity = 50) THEN l_shipdate END) AS modified
      FROM lineitem GROUP BY l_partkey""",
    "storage": """
      SELECT project_id, region, dataset_id, table_name, modified,
             CASE WHEN p_partkey % 23 = 0 THEN 0 ELSE CAST(quantity * p_size * 4194304 AS BIGINT) END AS bytes
      FROM parts JOIN changes ON l_partkey = p_partkey WHERE gid % 29 <> 0 AND p_partkey % 17 <> 0""",
    "jobs": """
      SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS job_id, r_name AS project_id,
             CASE WHEN o_orderkey % 2 = 0 THEN 'eu' ELSE 'europe-west2' END AS region,
             o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400) AS creation_time,
             CASE WHEN o_custkey % 10 = 0 THEN 'svc' || o_custkey || '@x.iam.gserviceaccount.com'
                  ELSE 'u' || o_custkey || '@example.com' END AS user_email,
             o_orderstatus
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey""",
    "recent": f"SELECT * FROM jobs WHERE creation_time > {CUTOFF}",
    "lines": """
      SELECT j.job_id, j.project_id, j.region, j.creation_time, j.user_email, j.o_orderstatus,
             p.project_id AS ref_project, p.dataset_id, p.table_name, l_partkey,
             min(l_partkey) OVER (PARTITION BY j.o_orderkey) AS first_part,
             row_number() OVER (PARTITION BY j.o_orderkey ORDER BY l_partkey) AS nth
      FROM recent j JOIN lineitem ON l_orderkey = j.o_orderkey JOIN parts p ON p_partkey = l_partkey""",
    "refs": """
      SELECT * FROM lines UNION ALL
      SELECT * REPLACE ('t_' || xor(l_partkey, 1) AS table_name) FROM lines UNION ALL
      SELECT * FROM lines WHERE nth = 1 AND o_orderstatus = 'F'""",
    "read_events": "SELECT * FROM refs WHERE ref_project = project_id",
    "write_events": "SELECT * FROM lines WHERE nth = 1 AND o_orderstatus = 'F' AND ref_project = project_id",
    "reads": _newest("read_events"),
    "writes": _newest("write_events"),
    "metadata": """
      SELECT d.project_id, d.region, d.dataset_id,
             trim(COALESCE(max(o.description), 'No Description'), '"') AS description,
             sum(s.bytes) / 1024 / 1024 / 1024 AS size, max(s.modified) AS modified
      FROM datasets d LEFT JOIN descriptions o USING (project_id, region, dataset_id)
      LEFT JOIN storage s USING (project_id, region, dataset_id)
      GROUP BY d.project_id, d.region, d.dataset_id""",
    "profiles": """
      SELECT m.*, r.last_time AS last_read_time, w.last_time AS last_write_time,
             COALESCE(r.details, 'No Read Access (180d)') AS last_reads,
             COALESCE(w.details, 'No Write Access (180d)') AS last_writes
      FROM metadata m LEFT JOIN reads r USING (project_id, region, dataset_id)
      LEFT JOIN writes w USING (project_id, region, dataset_id)""",
    "aged": f"""
      SELECT *, {floor_days(AS_OF, "modified")} AS touched,
             {floor_days(AS_OF, "greatest(last_read_time, last_write_time, modified)")} AS idle, {TEST_NAME} AS is_test
      FROM profiles""",
    "classed": f"""
      SELECT *, CASE WHEN {ABANDONED} AND is_test THEN 'Tranche 1: Abandoned Test/Temp (>1yr)'
                     WHEN {ABANDONED} AND {GONE_OR_ZERO} > 100 THEN 'Tranche 2: Abandoned Large Prod (>1yr)'
                     WHEN {ABANDONED} THEN 'Tranche 3: Abandoned Small Prod (>1yr)'
                     WHEN idle > 180 THEN 'Tranche 4: Stale (No Access 180d, No Write >6mo)'
                     WHEN is_test THEN 'Tranche 5: Active Test (Housekeeping)' ELSE 'Active' END AS tranche
      FROM aged""",
    "control": f"""
      SELECT project_id AS project, region, dataset_id AS dataset, description,
             {round2(GONE_OR_ZERO)} AS size_gb, {round2(f"({GONE_OR_ZERO} * CAST(0.02 AS DOUBLE))")} AS monthly_cost, tranche,
             CASE left(tranche, 9) WHEN 'Tranche 1' THEN 'Critical' WHEN 'Tranche 2' THEN 'Critical' WHEN 'Tranche 3' THEN 'High'
                  WHEN 'Tranche 4' THEN 'Medium' ELSE 'Low' END AS priority,
             idle AS days_since_activity, touched AS days_since_modified, last_read_time, last_write_time, last_reads, last_writes,
             COALESCE(strftime(modified, '%Y-%m-%d %H:%M:%S'), 'Never/Historical') AS last_storage_update,
             CASE WHEN touched > 365 THEN 'CONFIRMED: NO MODS > 1YR' ELSE 'REVIEW' END AS deletion_status
      FROM classed""",
    "candidates": """
      SELECT * FROM control WHERE starts_with(tranche, 'Tranche 1:') AND starts_with(deletion_status, 'CONFIRMED')""",
    "last_readers": """
      SELECT *, CASE WHEN starts_with(last_reads, 'No Read Access') THEN NULL
                     ELSE split_part(split_part(last_reads, chr(10), 1), ' (', 1) END AS last_read_when,
             CASE WHEN starts_with(last_reads, 'No Read Access') THEN NULL
                  ELSE rtrim(split_part(split_part(last_reads, chr(10), 1), ' (', 2), ')') END AS last_read_who
      FROM candidates""",
    "readers": """
      SELECT last_read_who AS reader, count(DISTINCT dataset) AS datasets, max(last_read_when) AS last_read
      FROM last_readers WHERE last_read_who IS NOT NULL GROUP BY last_read_who""",
    "policies": """
      SELECT *, '{"access":[{"role":"OWNER","userByEmail":"owner' || gid % 7 || '@example.com"},'
        || '{"role":"READER","groupByEmail":"grp' || gid % 11 || '@example.com"},'
        || CASE WHEN gid % 2 = 0 THEN '{"role":"WRITER","userByEmail":"w' || gid || '@example.com"},' ELSE '' END
        || '{"view":{"projectId":"' || project_id || '","datasetId":"' || dataset_id || '","tableId":"v"}}],'
        || '"labels":{"team":"t' || gid % 5 || '"}}' AS policy_json
      FROM datasets""",
    "numbered": """
      SELECT c.*, gid, project || ':' || dataset AS key,
             'gs://backup/backups/' || project || '_' || dataset || '_backup.json' AS backup_path
      FROM control c JOIN datasets d ON d.project_id = project AND d.region = c.region AND d.dataset_id = dataset""",
    "state": f"""
      SELECT key, project, dataset, tranche, backup_path, {AS_OF} - INTERVAL 1 DAY * (gid % 15) AS scream_initiated_at,
             CASE (gid // 2) % 4 WHEN 2 THEN 'deleted' WHEN 3 THEN 'restored' ELSE 'scream_test' END AS status,
             CAST(NULL AS TIMESTAMP) AS deleted_at, CAST(NULL AS TIMESTAMP) AS restored_at, gid AS seq, gid
      FROM numbered WHERE contains(deletion_status, 'CONFIRMED') AND gid % 2 = 0""",
    "targets": """
      SELECT n.*, s.status AS state_status
      FROM numbered n LEFT JOIN (SELECT key, status FROM state WHERE status IN ('deleted', 'scream_test')) s USING (key)
      WHERE n.tranche = 'Tranche 1: Abandoned Test/Temp (>1yr)' AND contains(deletion_status, 'CONFIRMED')""",
    "purges": f"""
      SELECT *, {floor_days(AS_OF, "scream_initiated_at")} AS days_elapsed FROM state WHERE status = 'scream_test'""",
    "report_rows": f"""
      SELECT s.status, CASE s.status WHEN 'scream_test' THEN 'Scream Test Active' WHEN 'deleted' THEN 'Deleted' ELSE 'Restored' END
               AS status_label, s.key, s.tranche, c.size_gb, c.monthly_cost,
             strftime(scream_initiated_at, '%Y-%m-%dT%H:%M:%S') AS initiated_at,
             {floor_days(AS_OF, "scream_initiated_at")} AS days_elapsed,
             CASE WHEN s.status = 'scream_test' AND {floor_days(AS_OF, "scream_initiated_at")} >= 7 THEN 'YES' ELSE '' END AS ready,
             s.seq
      FROM state s JOIN numbered c USING (key)""",
    "sections": """
      SELECT status, status_label, count(*) AS datasets, min(seq) AS first_seq FROM report_rows GROUP BY status, status_label""",
    "report_totals": f"""
      SELECT count(*) AS datasets, {total("size_gb")} AS size_gb, {total("monthly_cost")} AS monthly_cost FROM report_rows""",
}


def with_ctes(select: str) -> str:
    """The select behind every definition; DuckDB leaves out those it does not need."""
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in CTES.items()) + "\n" + select
