"""One SQL text per registered query."""

from __future__ import annotations

from oracle.estate_sql import AS_OF, CUTOFF, SHEET_ORDER, TEST_NAME, UNUSED, floor_days, float_text, round2, total, with_ctes

_DS = "project_id AS project, region, dataset_id AS dataset"
_CONTROL = (
    "project, region, dataset, description, size_gb, monthly_cost, tranche, priority, days_since_activity, "
    "days_since_modified, last_read_time, last_write_time, last_reads, last_writes, last_storage_update, deletion_status"
)
_TRANCHE = f"""
  SELECT *, CASE WHEN {UNUSED} AND {TEST_NAME} THEN 'Tranche 1: Stale Test/Temp'
                 WHEN {UNUSED} AND size > 100 THEN 'Tranche 2: High Saving Stale (>100GB)'
                 WHEN {UNUSED} THEN 'Tranche 3: Stale Production'
                 WHEN {TEST_NAME} THEN 'Tranche 4: Active Test/Temp (Review Needed)'
                 WHEN size > 500 THEN 'Active (Large: Monitor)' ELSE 'Active' END AS tranche
  FROM profiles"""
_PRIORITY = """CASE left(tranche, 9) WHEN 'Tranche 1' THEN 'Critical' WHEN 'Tranche 2' THEN 'Critical'
  WHEN 'Tranche 3' THEN 'High' WHEN 'Tranche 4' THEN 'Medium' ELSE 'Low' END"""
_ZERO = "CAST(0 AS DOUBLE)"
_COST = round2("(size * CAST(0.02 AS DOUBLE))")
_BIGGEST = """
  SELECT project_id, region, dataset_id, table_name, creation_time, bytes / 1024 / 1024 / 1024 AS size,
         row_number() OVER (PARTITION BY project_id, region ORDER BY bytes DESC, dataset_id, table_name) AS size_rank
  FROM tables JOIN storage USING (project_id, region, dataset_id, table_name) WHERE bytes > 0"""
_STATE = "key, project, dataset, tranche, backup_path"
_OK = "gid % 5 <> 4"
_RESTORE = """
  key, project, dataset, tranche, status AS prior_status,
  CASE WHEN status = 'restored' THEN 'skip' ELSE 'restore' END AS action,
  CASE WHEN status = 'restored' THEN 'already marked as restored' END AS reason, backup_path"""
_ENTRY = """json_extract_string(e, '$.role') AS role,
  COALESCE(json_extract_string(e, '$.userByEmail'), json_extract_string(e, '$.groupByEmail')) AS member"""


def _entries(kept: str) -> str:
    return f"""
      SELECT project_id || ':' || dataset_id AS key, region, position, {_ENTRY}
      FROM (SELECT project_id, region, dataset_id, unnest(entries) AS e,
                   CAST(unnest(range(len(entries))) AS BIGINT) AS position
            FROM (SELECT project_id, region, dataset_id,
                         list_filter(json_extract(policy_json, '$.access[*]'), lambda e: {kept}) AS entries FROM policies))"""


def _last(events: str) -> str:
    return f"SELECT {_DS}, max(creation_time) AS last_access_time FROM {events} GROUP BY project_id, region, dataset_id"


def _restored() -> str:
    return f"""SELECT key, CASE WHEN status = 'restored' THEN 'skipped' WHEN {_OK} THEN 'restored' ELSE 'failed' END AS result
               FROM state"""


_QUERIES: dict[str, str] = {
    "last_read_by_dataset": _last("read_events"),
    "last_write_by_dataset": _last("write_events"),
    "top_k_reads": f"""
      SELECT {_DS}, table_name AS table_id, creation_time, user_email, job_id, rn
      FROM (SELECT *, row_number() OVER (PARTITION BY project_id, region, dataset_id
              ORDER BY creation_time DESC, user_email, job_id, table_name) AS rn FROM read_events) WHERE rn <= 2""",
    "read_details_text": f"SELECT {_DS}, last_time AS last_access_time, details FROM reads",
    "write_details_text": f"SELECT {_DS}, last_time AS last_access_time, details FROM writes",
    "dataset_metadata": f"SELECT {_DS}, description, size AS size_gb, modified AS last_storage_modified FROM metadata",
    "table_last_access": f"""
      SELECT {_DS}, table_name, max(creation_time) AS last_accessed FROM refs
      GROUP BY project_id, region, dataset_id, table_name""",
    "largest_tables_per_scope": f"""
      SELECT {_DS}, table_name, creation_time, size AS size_gb, size_rank FROM ({_BIGGEST}) WHERE size_rank <= 100""",
    "stale_tables": f"""
      SELECT CASE WHEN starts_with(project_id, 'A') THEN 'first.example.com' ELSE 'second.example.com' END AS organisation,
             project_id AS project, 'region-' || region AS region, dataset_id AS dataset, table_name,
             {round2("size")} AS size_gb, strftime(creation_time, '%Y-%m-%d %H:%M:%S') || '+00:00' AS created,
             'NEVER (>180 days)' AS last_accessed, 'ZOMBIE DATA' AS status,
             'DELETE: No query history found for 180 days.' AS action, {_COST} AS monthly_waste
      FROM ({_BIGGEST}) t
      WHERE size_rank <= 100 AND {floor_days(AS_OF, "creation_time")} > 180
        AND NOT EXISTS (SELECT 1 FROM refs r WHERE r.project_id = t.project_id AND r.region = t.region
                        AND r.dataset_id = t.dataset_id AND r.table_name = t.table_name)""",
    "access_audit": f"""
      SELECT {_DS}, description, {round2("size")} AS size_gb, modified AS last_storage_update, last_reads, last_writes,
             CASE WHEN {UNUSED} THEN 'STALE' WHEN {TEST_NAME} THEN 'TEST DATA' ELSE 'ACTIVE' END AS status,
             CASE WHEN ({UNUSED} OR {TEST_NAME}) AND size > 100 THEN 'Critical' WHEN {UNUSED} THEN 'High'
                  WHEN {TEST_NAME} THEN 'Medium' ELSE 'Low' END AS priority,
             CASE WHEN {UNUSED} THEN 'DELETE (No access 180d)' WHEN {TEST_NAME} THEN 'Verify & Cleanup (Test/Temp naming)'
                  ELSE 'Keep' END AS action
      FROM profiles""",
    "tranche_audit": f"""
      SELECT {_DS}, description, COALESCE({round2("size")}, {_ZERO}) AS size_gb, COALESCE({_COST}, {_ZERO}) AS monthly_cost,
             tranche, {_PRIORITY} AS priority, last_read_time, last_write_time, last_reads, last_writes,
             modified AS last_storage_update
      FROM ({_TRANCHE})""",
    "exported_audit": f"""
      SELECT project_id AS "Project", region AS "Region", dataset_id AS "Dataset", description AS "Description",
             COALESCE({round2("size")}, {_ZERO}) AS "Size (GB)", COALESCE({_COST}, {_ZERO}) AS "Monthly Cost ($)",
             tranche AS "Tranche", {_PRIORITY} AS "Cleanup Priority", last_read_time AS "Last Read Time",
             last_write_time AS "Last Write Time", last_reads AS "Last 5 Reads (Who/When)",
             last_writes AS "Last 5 Writes (Who/When)", modified AS "Last Storage Update"
      FROM ({_TRANCHE})""",
    "deep_history_audit": f"SELECT {_CONTROL} FROM control",
    "audit_roundtrip": f"SELECT {_CONTROL}, NOT (project = 'ASIA' AND region = 'eu') AS history_ok FROM control",
    "scope_coverage": """
      SELECT project, region, history_ok, count(*) AS datasets,
             CAST(count(*) FILTER (days_since_modified > 365) AS BIGINT) AS without_rule,
             CAST(count(*) FILTER (days_since_modified > 365 AND history_ok) AS BIGINT) AS with_rule
      FROM (SELECT *, NOT (project = 'ASIA' AND region = 'eu') AS history_ok FROM control)
      GROUP BY project, region, history_ok""",
    "confirmed_targets": """
      SELECT project, region, dataset, tranche, size_gb, monthly_cost, deletion_status FROM control
      WHERE contains(deletion_status, 'CONFIRMED')""",
    "tranche_list": "SELECT DISTINCT tranche FROM control",
    "tranche1_candidates": """
      SELECT project, region, dataset, tranche, size_gb, monthly_cost, last_reads, deletion_status FROM candidates""",
    "reader_summary": """
      SELECT reader, datasets, last_read,
             CASE WHEN contains(reader, 'gserviceaccount.com') THEN
                    CASE WHEN datasets > 1 THEN 'Service account, single-day bulk scan' ELSE 'Service account, single read' END
                  WHEN datasets > 1 THEN 'Single-day bulk scan' ELSE 'Single read' END AS pattern
      FROM readers""",
    "unread_datasets": "SELECT project, region, dataset FROM last_readers WHERE last_read_who IS NULL",
    "bulk_scan_insight": """
      SELECT (SELECT count(*) FROM candidates) AS candidates,
             CAST(COALESCE(sum(datasets), 0) AS BIGINT) AS datasets_with_reads,
             CAST(COALESCE(sum(datasets) FILTER (datasets > 1), 0) AS BIGINT) AS bulk_scanned_datasets,
             count(*) FILTER (datasets > 1) AS bulk_readers
      FROM readers""",
    "candidate_totals": f"""
      SELECT *, format('{{:,.0f}}', size_gb) AS size_text, format('{{:,.2f}}', monthly_cost) AS cost_text
      FROM (SELECT count(*) AS datasets, {total("size_gb")} AS size_gb, {total("monthly_cost")} AS monthly_cost FROM candidates)""",
    "recency_series": """
      SELECT project, region, dataset,
             CASE WHEN last_read_time IS NOT NULL THEN CAST(days_since_activity AS DOUBLE) END AS days_since_read,
             CAST(days_since_modified AS DOUBLE) AS days_since_modified
      FROM (SELECT * FROM candidates ORDER BY days_since_activity DESC NULLS LAST, project, region, dataset LIMIT 15)""",
    "top_cost": """
      SELECT project, region, dataset, CAST(days_since_activity AS VARCHAR) AS days_inactive,
             format('{:,.2f}', size_gb) AS size_text, format('{:,.2f}', monthly_cost) AS cost_text
      FROM (SELECT * FROM candidates ORDER BY monthly_cost DESC NULLS LAST, project, region, dataset LIMIT 6)""",
    "tranche_overview": f"""
      , per AS (SELECT tranche, {total("monthly_cost")} AS monthly_cost, {total("size_gb")} AS size_gb,
                          count(*) AS datasets, count(DISTINCT project) AS projects FROM control GROUP BY tranche)
      SELECT * FROM per UNION ALL
      SELECT 'Subtotal (Cleanup)', {total("monthly_cost")}, {total("size_gb")}, CAST(sum(datasets) AS BIGINT),
             CAST(sum(projects) AS BIGINT) FROM per WHERE tranche <> 'Active'""",
    "restricted_policy_entries": _entries("json_extract_string(e, '$.role') IS NOT DISTINCT FROM 'OWNER'"),
    "revoked_policy_entries": _entries("json_extract_string(e, '$.role') IS DISTINCT FROM 'OWNER'"),
    "labels_after_scream_test": f"SELECT {_DS}, 'cleanup-status=scream-test,team=t' || gid % 5 AS labels FROM policies",
    "policy_snapshot": """
      SELECT key, p.region, backup_path, policy_json FROM state s
      JOIN policies p ON p.project_id = s.project AND p.dataset_id = s.dataset""",
    "scream_test_plan": """
      SELECT key, project, region, dataset, tranche, size_gb, monthly_cost,
             CASE WHEN state_status IS NULL THEN 'restrict' ELSE 'skip' END AS action,
             CASE WHEN state_status IS NOT NULL THEN 'already processed (Status: ' || state_status || ')' END AS reason,
             backup_path, CASE WHEN state_status IS NULL THEN 'cleanup-status:scream-test' END AS set_label
      FROM targets""",
    "scream_test_log": f"""
      SELECT key, CASE WHEN state_status IS NULL THEN 'restrict' ELSE 'skip' END AS action,
             CASE WHEN state_status IS NOT NULL THEN 'Skipping ' || key || ' - already processed (Status: ' || state_status || ')'
                  WHEN {_OK} THEN 'Scream test applied successfully for ' || key
                  ELSE 'ERROR: Failed to apply scream test for ' || key || ' - dataset access NOT modified' END AS message
      FROM targets""",
    "state_after_scream_test": f"""
      SELECT {_STATE}, {AS_OF} AS scream_initiated_at, 'scream_test' AS status, CAST(NULL AS TIMESTAMP) AS deleted_at,
             CAST(NULL AS TIMESTAMP) AS restored_at FROM targets WHERE state_status IS NULL AND {_OK}
      UNION ALL
      SELECT {_STATE}, scream_initiated_at, status, deleted_at, restored_at FROM state
      WHERE key NOT IN (SELECT key FROM targets WHERE state_status IS NULL AND {_OK})""",
    "purge_plan": """
      SELECT key, project, dataset, tranche, days_elapsed, CAST(7 AS BIGINT) AS threshold,
             CASE WHEN days_elapsed >= 7 THEN 'delete' ELSE 'skip' END AS action,
             CASE WHEN days_elapsed < 7 THEN 'only ' || days_elapsed || ' days elapsed (threshold: 7)' END AS reason
      FROM purges""",
    "state_after_purge": f"""
      SELECT {_STATE}, scream_initiated_at, CASE WHEN gone THEN 'deleted' ELSE status END AS status,
             CASE WHEN gone THEN {AS_OF} END AS deleted_at, restored_at
      FROM (SELECT *, key IN (SELECT key FROM purges WHERE days_elapsed >= 7 AND {_OK}) AS gone FROM state)""",
    "restore_by_tranche": f"SELECT {_RESTORE} FROM state WHERE starts_with(tranche, 'Tranche 2:')",
    "restore_all": f"SELECT {_RESTORE} FROM state WHERE status = 'scream_test'",
    "restore_by_key": f"SELECT {_RESTORE} FROM state",
    "restore_unknown_keys": """
      SELECT key FROM numbered WHERE contains(deletion_status, 'CONFIRMED') AND key NOT IN (SELECT key FROM state)""",
    "restore_outcomes": f"""
      SELECT count(*) FILTER (result = 'restored') AS restored, count(*) FILTER (result = 'failed') AS failed,
             count(*) FILTER (result = 'skipped') AS skipped, CAST(0 AS BIGINT) AS unreported,
             count(*) FILTER (result = 'failed') > 0 AS run_failed FROM ({_restored()})""",
    "restore_failures": f"SELECT key FROM ({_restored()}) WHERE result = 'failed'",
    "state_after_restore": f"""
      SELECT {_STATE}, scream_initiated_at, CASE WHEN back THEN 'restored' ELSE status END AS status, deleted_at,
             CASE WHEN back THEN {AS_OF} END AS restored_at
      FROM (SELECT *, status = 'scream_test' AND {_OK} AS back FROM state)""",
    "backed_up_plan": """
      SELECT key, region, CASE WHEN state_status IS NOT NULL THEN 'skip' WHEN project = 'ASIA' THEN 'fail' ELSE 'restrict' END AS action,
             CASE WHEN state_status IS NOT NULL THEN 'already processed (Status: ' || state_status || ')'
                  WHEN project = 'ASIA' THEN 'no backup' END AS reason,
             CASE WHEN acts THEN 'cleanup-status:scream-test' END AS set_label, CASE WHEN acts THEN 'OWNER' END AS first_role,
             CAST(NULL AS VARCHAR) AS second_role
      FROM (SELECT *, state_status IS NULL AND project <> 'ASIA' AS acts FROM targets)""",
    "restored_entries": """
      SELECT key, position, json_extract_string(e, '$.role') AS role
      FROM (SELECT key, unnest(entries) AS e, CAST(unnest(range(len(entries))) AS BIGINT) AS position
            FROM (SELECT key, json_extract(policy_json, '$.access[*]') AS entries FROM state s
                  JOIN policies p ON p.project_id = s.project AND p.dataset_id = s.dataset WHERE status = 'scream_test'))""",
    "action_log": f"""
      SELECT '[2001-08-02T00:00:00] ' || message AS line FROM (
        SELECT CASE WHEN state_status IS NOT NULL THEN 'Skipping ' || key || ' - already processed (Status: ' || state_status || ')'
                    WHEN {_OK} THEN 'Scream test applied successfully for ' || key
                    ELSE 'ERROR: Failed to apply scream test for ' || key || ' - dataset access NOT modified' END AS message FROM targets
        UNION ALL
        SELECT CASE WHEN days_elapsed < 7 THEN 'Skipping ' || key || ' - only ' || days_elapsed || ' days elapsed (threshold: 7)'
                    WHEN {_OK} THEN 'Deleted ' || key ELSE 'ERROR: Failed to delete ' || key END FROM purges
        UNION ALL
        SELECT CASE WHEN {_OK} THEN 'Successfully restored ' || key ELSE 'ERROR: Failed to restore ' || key END
        FROM state WHERE status = 'scream_test')""",
    "state_roundtrip": f"""
      SELECT {_STATE}, scream_initiated_at, CASE WHEN gone THEN 'deleted' ELSE status END AS status,
             CASE WHEN gone THEN {AS_OF} END AS deleted_at, restored_at
      FROM (SELECT *, key IN (SELECT key FROM purges WHERE days_elapsed >= 7 AND {_OK}) AS gone FROM state)""",
    "audit_without_history": f"""
      SELECT project, region, dataset, history_ok, CASE WHEN NOT history_ok THEN 'REVIEW: access log missing'
               WHEN unused THEN 'STALE' WHEN is_test THEN 'TEST DATA' ELSE 'ACTIVE' END AS status,
             CASE WHEN NOT history_ok THEN 'Review' WHEN (unused OR is_test) AND size > 100 THEN 'Critical' WHEN unused THEN 'High'
                  WHEN is_test THEN 'Medium' ELSE 'Low' END AS priority,
             CASE WHEN NOT history_ok THEN 'REVIEW: the access log of this scope could not be read.'
                  WHEN unused THEN 'DELETE (No access 180d)' WHEN is_test THEN 'Verify & Cleanup (Test/Temp naming)' ELSE 'Keep' END AS action
      FROM (SELECT {_DS}, size, NOT (project_id = 'ASIA' AND region = 'eu') AS history_ok, {UNUSED} AS unused, {TEST_NAME} AS is_test
            FROM profiles)""",
    "estate_roundtrip": f"""
      SELECT {_DS}, description, size AS size_gb, modified AS last_storage_modified FROM metadata
      WHERE project_id IN ('ASIA', 'EUROPE')""",
    "sheet_ranks": f"""
      SELECT project, region, dataset, row_number() OVER (PARTITION BY project ORDER BY {SHEET_ORDER}) AS place FROM control""",
    "status_rows": "SELECT * FROM report_rows",
    "status_counts": "SELECT * FROM sections",
    "status_totals": "SELECT * FROM report_totals",
    "report_lines": f"""
      SELECT CAST(block AS BIGINT) AS block, CAST(section AS BIGINT) AS section, CAST(part AS BIGINT) AS part, key, line FROM (
        SELECT 0 AS block, 0 AS section, part, '' AS key, line FROM (VALUES
          (0, '# Decommissioning Status Report'), (1, ''), (2, 'Generated: 2001-08-02T00:00:00'),
          (3, 'Made from the workflow state and the control table; edits to this text are lost when it is made again'), (4, '')
        ) head(part, line)
        UNION ALL
        SELECT 1, first_seq, part, '', CASE part WHEN 0 THEN '## ' || status_label || ' (' || datasets || ')' ELSE line END
        FROM sections, (VALUES (0, NULL), (1, ''),
          (2, '| Dataset | Tranche | Size (GB) | Monthly Cost ($) | Initiated | Days Elapsed | Ready for Phase D |'),
          (3, '|---|---|---|---|---|---|---|'), (5, '')) frame(part, line)
        UNION ALL
        SELECT 1, first_seq, 4, key, '| ' || key || ' | ' || tranche || ' | ' || {float_text("size_gb")} || ' | '
          || {float_text("monthly_cost")} || ' | ' || initiated_at || ' | ' || days_elapsed || ' | ' || ready || ' |'
        FROM report_rows JOIN sections USING (status)
        UNION ALL
        SELECT 2, 0, part, '', CASE part WHEN 0 THEN '## Totals' WHEN 1 THEN '- Datasets tracked: ' || datasets
          WHEN 2 THEN '- Combined size: ' || format('{{:,.2f}}', size_gb) || ' GB'
          ELSE '- Combined monthly cost: $' || format('{{:,.2f}}', monthly_cost) END
        FROM report_totals, (VALUES (0), (1), (2), (3)) totals(part))""",
}


_NEW_SIZES = """
  SELECT project_id, region, dataset_id, table_name, (bytes % 7 + 1) / 1024 / 1024 / 1024 AS size,
         row_number() OVER (PARTITION BY project_id, region ORDER BY bytes % 7 DESC, dataset_id, table_name) AS size_rank
  FROM tables JOIN storage USING (project_id, region, dataset_id, table_name)"""
_SHEET = """
  SELECT *, row_number() OVER (ORDER BY dataset DESC, project, region, copy) AS seq FROM (
    SELECT key, project, region, dataset, tranche, size_gb, 0 AS copy, deletion_status, gid FROM numbered
    UNION ALL
    SELECT key, project, region, dataset, 'Tranche 1: Seen Again', size_gb + 1, 1, deletion_status, gid FROM numbered WHERE gid % 3 = 0)"""
_UNKNOWN = """
  SELECT *, CASE WHEN touched > 365 THEN CASE WHEN is_test THEN 'Tranche 1: Abandoned Test/Temp (>1yr)'
                   WHEN COALESCE(size, 0) > 100 THEN 'Tranche 2: Abandoned Large Prod (>1yr)' ELSE 'Tranche 3: Abandoned Small Prod (>1yr)' END
                 WHEN idle > 180 THEN 'Tranche 4: Stale (No Access 180d, No Write >6mo)'
                 WHEN is_test THEN 'Tranche 5: Active Test (Housekeeping)' ELSE 'Active' END AS class
  FROM aged"""
_NAMES = "test/temp/tmp/demo/poc/beta"
_ENTERED = f"SELECT key FROM targets WHERE state_status IS NULL AND {_OK}"
_QUERIES |= {
    "access_audit_places": f"""
      SELECT project, region, dataset, priority, row_number() OVER (ORDER BY CASE priority WHEN 'Critical' THEN 0 WHEN 'High' THEN 1
        WHEN 'Medium' THEN 2 ELSE 3 END, size_gb DESC NULLS LAST, project, region, dataset) AS place FROM ({_QUERIES["access_audit"]})""",
    "tranche_audit_places": f"""
      SELECT project, region, dataset, tranche, row_number() OVER (ORDER BY CASE left(tranche, 9) WHEN 'Tranche 1' THEN 0 WHEN 'Tranche 2' THEN 1
        WHEN 'Tranche 3' THEN 2 WHEN 'Tranche 4' THEN 3 ELSE CASE tranche WHEN 'Active' THEN 5 ELSE 4 END END,
        size_gb DESC NULLS LAST, project, region, dataset) AS place FROM ({_QUERIES["tranche_audit"]})""",
    "stale_table_places": f"""
      SELECT project, region, dataset, table_name, row_number() OVER (ORDER BY monthly_waste DESC, project, region, dataset, table_name) AS place
      FROM ({_QUERIES["stale_tables"]})""",
    "reader_places": "SELECT reader, datasets, row_number() OVER (ORDER BY datasets DESC, reader) AS place FROM readers",
    "empty_plan_roundtrip": """
      SELECT 'plan' AS name, CAST(1 AS BIGINT) AS step, count(*) AS rows FROM targets UNION ALL
      SELECT 'plan', 2, 0 UNION ALL SELECT 'plan', 3, count(*) FROM targets WHERE project <> 'ASIA' UNION ALL
      SELECT 'state', 1, count(*) FROM state UNION ALL
      SELECT 'state', 2, 0 UNION ALL SELECT 'state', 3, count(*) FROM state WHERE project <> 'ASIA'""",
    "written_rows": """
      SELECT 'audit' AS name, CAST(1 AS BIGINT) AS version, count(*) AS rows FROM control UNION ALL
      SELECT 'audit', 2, count(*) FROM control WHERE deletion_status = 'REVIEW' UNION ALL
      SELECT 'state', 1, count(*) FROM state UNION ALL SELECT 'state', 2, count(*) FROM state WHERE status = 'restored' UNION ALL
      SELECT 'backups', 1, count(*) FROM state""",
    "bundle_roundtrip": f"""
      SELECT * FROM (VALUES
        ('readme', 'Tranche 1', 'Stale Test/Temp: The name holds one of {_NAMES}, and nothing read or wrote it for 180 days. First to go.'),
        ('readme', 'Tranche 2', 'High Saving Stale: Other datasets over 100 GB without access for 180 days. They save the most.'),
        ('readme', 'Tranche 3', 'Stale Production: Other datasets up to 100 GB without access for 180 days.'),
        ('readme', 'Tranche 4', 'Active Test/Temp: The name holds one of {_NAMES}, but the dataset is in use. For review.'),
        ('readme', 'Column: Description', 'Dataset Metadata: The description among the options of the dataset, which may name an owner or a purpose.'),
        ('readme', 'Column: Last 5 Access', 'Audit Trail: The newest 5 jobs that read or wrote the dataset, each with its time and user.'),
        ('readme', 'Column: Monthly Cost', 'Financial Impact: An estimate at $0.02 per GB and month.')) t(member, name, text)
      UNION ALL
      SELECT 'audit_results', project || ':' || region || ':' || dataset,
             description || '|' || tranche || '|' || priority || '|' || last_reads || '|' || last_writes
      FROM ({_QUERIES["tranche_audit"]}) WHERE project <> 'ASIA'""",
    "sheet_roundtrip": f"""
      , sheet AS ({_SHEET}),
      labels AS (SELECT tranche, row_number() OVER (ORDER BY min(seq)) AS place FROM sheet GROUP BY tranche)
      SELECT 'tranche' AS kind, tranche AS name, place, CAST(NULL AS DOUBLE) AS size_gb FROM labels UNION ALL
      SELECT 'meant by 1', arg_min(tranche, place), 1, NULL FROM labels WHERE starts_with(tranche, 'Tranche 1:') UNION ALL
      SELECT 'key', key, NULL, arg_max(size_gb, seq) FROM sheet GROUP BY key""",
    "repeated_targets": f"""
      , sheet AS ({_SHEET}),
      found AS (SELECT s.key, t.status, row_number() OVER (PARTITION BY s.key ORDER BY seq) AS nth FROM sheet s
                LEFT JOIN (SELECT key, status FROM state WHERE status IN ('deleted', 'scream_test')) t USING (key)
                WHERE contains(deletion_status, 'CONFIRMED')),
      judged AS (SELECT key, CASE WHEN status IS NULL AND nth = 1 THEN 'restrict' ELSE 'skip' END AS action,
                        CASE WHEN status IS NOT NULL THEN 'already processed (Status: ' || status || ')' WHEN nth > 1 THEN 'repeated key' END AS reason
                 FROM found)
      SELECT key, action, reason, count(*) AS rows FROM judged GROUP BY ALL""",
    "broken_scopes": f"""
      , scopes AS (SELECT DISTINCT project_id AS project, region, NOT (project_id = 'AFRICA' AND region = 'eu') AS metadata_ok,
                     NOT ((project_id = 'ASIA' AND region = 'europe-west2') OR (project_id = 'EUROPE' AND region = 'eu')) AS history_ok FROM datasets),
      unread AS (SELECT t.project_id AS project, t.region, count(*) AS n FROM ({_BIGGEST}) t JOIN scopes s ON s.project = t.project_id AND s.region = t.region
                 WHERE metadata_ok AND size_rank <= 100 AND {floor_days(AS_OF, "creation_time")} > 180
                   AND NOT (history_ok AND EXISTS (SELECT 1 FROM refs r WHERE r.project_id = t.project_id AND r.region = t.region
                            AND r.dataset_id = t.dataset_id AND r.table_name = t.table_name)) GROUP BY ALL),
      found AS (SELECT project, region, count(*) AS datasets, count(*) FILTER (contains(deletion_status, 'CONFIRMED')) AS confirmed,
                       count(*) FILTER (last_read_time IS NOT NULL) AS read FROM control GROUP BY ALL)
      SELECT project, region, metadata_ok, history_ok, CASE WHEN metadata_ok THEN datasets ELSE 0 END AS datasets,
             CASE WHEN metadata_ok AND history_ok THEN confirmed ELSE 0 END AS confirmed,
             CASE WHEN metadata_ok AND history_ok THEN read ELSE 0 END AS read, COALESCE(n, 0) AS unused_tables
      FROM scopes JOIN found USING (project, region) LEFT JOIN unread USING (project, region)""",
    "incremental_access": """
      SELECT project_id AS project, region, dataset_id AS dataset, r.last_time AS last_read_time, w.last_time AS last_write_time,
             r.details AS last_reads, w.details AS last_writes
      FROM reads r FULL JOIN writes w USING (project_id, region, dataset_id)""",
    "many_largest_tables": f"""
      SELECT {_DS}, table_name, size AS size_gb, size_rank FROM ({_NEW_SIZES}) WHERE size_rank <= 1500""",
    "state_after_batches": f"""
      SELECT {_STATE}, {AS_OF} AS scream_initiated_at, 'restored' AS status, CAST(NULL AS TIMESTAMP) AS deleted_at, {AS_OF} AS restored_at
      FROM targets WHERE state_status IS NULL AND {_OK}
      UNION ALL
      SELECT {_STATE}, scream_initiated_at, CASE WHEN due THEN 'deleted' WHEN active THEN 'restored' ELSE status END,
             CASE WHEN due THEN {AS_OF} END, CASE WHEN active AND NOT due THEN {AS_OF} ELSE restored_at END
      FROM (SELECT *, status = 'scream_test' AND {_OK} AS active,
                   status = 'scream_test' AND {_OK} AND {floor_days(AS_OF, "scream_initiated_at")} >= 7 AS due
            FROM state WHERE key NOT IN ({_ENTERED}))""",
    "report_roundtrip": f"""
      SELECT row_number() OVER (ORDER BY block, section, part, key) AS line_no, line FROM ({_QUERIES["report_lines"]})""",
    "report_without_context": f"""
      SELECT key, '| ' || key || ' | ' || tranche || ' | n/a | n/a | ' || initiated_at || ' | ' || days_elapsed || ' | ' || ready || ' |' AS line
      FROM report_rows WHERE starts_with(key, 'ASIA:')
      UNION ALL
      SELECT '', 'No entries in state.json yet — no Scream Tests have been initiated (or this is dry-run only).'""",
    "deep_audit_unknown_storage": f"""
      SELECT {_DS}, class AS tranche, CASE left(class, 9) WHEN 'Tranche 1' THEN 'Critical' WHEN 'Tranche 2' THEN 'Critical'
               WHEN 'Tranche 3' THEN 'High' WHEN 'Tranche 4' THEN 'Medium' ELSE 'Low' END AS priority,
             idle AS days_since_activity, touched AS days_since_modified, strftime(modified, '%Y-%m-%d %H:%M:%S') AS last_storage_update,
             CASE WHEN touched > 365 THEN 'CONFIRMED: NO MODS > 1YR' ELSE 'REVIEW' END AS deletion_status
      FROM (SELECT * REPLACE (CASE WHEN modified IS NULL AND {UNUSED} THEN NULL ELSE idle END AS idle) FROM ({_UNKNOWN}))""",
    "backup_buckets": "SELECT 'backup' AS bucket, count(*) AS backups FROM state",
}


_ACCESS_NAMES = {
    "project": "Project", "region": "Region", "dataset": "Dataset", "description": "Description", "size_gb": "Size (GB)",
    "last_storage_update": "Last Storage Update", "last_reads": "Last 5 Reads (Who/When)", "last_writes": "Last 5 Writes (Who/When)",
    "status": "Status", "priority": "Cleanup Priority", "action": "Recommended Action",
}
_DEEP_NAMES = {
    "project": "Project", "region": "Region", "dataset": "Dataset", "description": "Description", "size_gb": "Size (GB)",
    "monthly_cost": "Monthly Cost ($)", "tranche": "Tranche", "priority": "Cleanup Priority",
    "days_since_activity": "Days Since Last Activity", "days_since_modified": "Days Since Last Modified",
    "last_read_time": "Last Read Time", "last_write_time": "Last Write Time", "last_reads": "Last 5 Reads (Who/When)",
    "last_writes": "Last 5 Writes (Who/When)", "last_storage_update": "Last Storage Update", "deletion_status": "Defensible Deletion Status",
}
_TABLE_NAMES = {
    "organisation": "Organisation", "project": "Project ID", "region": "Region", "dataset": "Dataset", "table_name": "Table",
    "size_gb": "Size (GB)", "created": "Created", "last_accessed": "Last Accessed", "status": "Status", "action": "Action",
    "monthly_waste": "Monthly Waste ($)",
}


def _renamed(query: str, names: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{old} AS "{new}"' for old, new in names.items()) + f" FROM ({_QUERIES[query]})"


_QUERIES |= {
    "exported_access_audit": _renamed("access_audit", _ACCESS_NAMES),
    "exported_deep_audit": _renamed("deep_history_audit", _DEEP_NAMES),
    "exported_stale_tables": _renamed("stale_tables", _TABLE_NAMES),
    "other_status_counts": """
      SELECT status, CASE status WHEN 'scream_test' THEN 'Scream Test Active' WHEN 'deleted' THEN 'Deleted' WHEN 'restored' THEN 'Restored'
               ELSE status END AS status_label, count(*) AS datasets, min(seq) AS first_seq
      FROM (SELECT seq, CASE WHEN project = 'ASIA' THEN 'on hold' WHEN project = 'EUROPE' THEN 'unknown' ELSE status END AS status FROM state)
      GROUP BY status""",
}


def oracle_queries() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in _QUERIES.items()}
