import json

import pytest

from estate_hygiene.operators import lifecycle
from helpers import NOW, ago, audit, by_key, outcomes, policies, records, state

POLICY = json.dumps({"access": [{"role": "OWNER", "userByEmail": "a@x"}, {"role": "READER", "userByEmail": "b@x"}], "n": 1})


def naive(when):
    return when.replace(tzinfo=None)


def plan(spark, targets, entries=(), documents=None):
    documents = {f"p:{t['dataset']}": POLICY for t in targets} if documents is None else documents
    return lifecycle.plan_scream_test(audit(spark, *targets), state(spark, *entries), policies(spark, documents), NOW, "gs://b")


def test_plan_carries_backup_restriction_and_label(spark):
    [row] = plan(spark, [{"dataset": "d"}]).collect()
    assert (row.key, row.action, row.reason) == ("p:d", "restrict", None)
    assert row.backup_path == "gs://b/backups/p_d_backup.json"
    assert json.loads(row.policy_json) == json.loads(POLICY)
    assert json.loads(row.restricted_policy) == {"access": [{"role": "OWNER", "userByEmail": "a@x"}], "n": 1}
    assert row.set_label == "cleanup-status:scream-test" and row.planned_at == naive(NOW)


@pytest.mark.parametrize(
    "status,action,reason",
    [
        ("scream_test", "skip", "already processed (Status: scream_test)"),
        ("deleted", "skip", "already processed (Status: deleted)"),
        ("restored", "restrict", None),
    ],
)
def test_processed_datasets_are_skipped_and_restored_ones_retested(spark, status, action, reason):
    [row] = plan(spark, [{"dataset": "d"}], [{"key": "p:d", "status": status}]).collect()
    assert (row.action, row.reason) == (action, reason)
    assert (row.restricted_policy is None) == (action == "skip")


def test_missing_backup_fails_only_that_target(spark):
    got = by_key(plan(spark, [{"dataset": "d"}, {"dataset": "e"}, {"dataset": "f"}], documents={"p:d": POLICY, "p:f": "{broken"}))
    assert {k: (r.action, r.reason) for k, r in got.items()} == {
        "p:d": ("restrict", None),
        "p:e": ("fail", "no backup"),
        "p:f": ("fail", "unreadable policy"),
    }


def test_repeated_key_is_restricted_once_in_sheet_order(spark):
    targets = [{"dataset": "d", "region": "us", "size_gb": 1.0}, {"dataset": "d", "region": "eu", "size_gb": 2.0}]
    both = policies(spark, {"p:d": POLICY})
    both = both.unionByName(both.selectExpr("project_id", "'us' region", "dataset_id", "policy_json"))
    got = lifecycle.plan_scream_test(audit(spark, *targets), state(spark), both, NOW, None)
    assert sorted(records(got, "region", "action", "reason")) == [
        ("eu", "restrict", None),
        ("us", "skip", "repeated key"),
    ]


def test_a_failed_first_occurrence_leaves_the_second_to_be_tried(spark):
    targets = [{"dataset": "d", "region": "us", "size_gb": 2.0}, {"dataset": "d", "region": "eu", "size_gb": 1.0}]
    got = lifecycle.plan_scream_test(audit(spark, *targets), state(spark), policies(spark, {"p:d": POLICY}), NOW, None)
    assert sorted(records(got, "region", "action", "reason")) == [("eu", "restrict", None), ("us", "fail", "no backup")]


def test_no_targets_give_an_empty_plan(spark):
    targets = audit(spark, {"dataset": "d"}).where("false")
    assert records(lifecycle.plan_scream_test(targets, state(spark), policies(spark, {}), NOW, None)) == []


def test_only_successes_enter_the_state(spark):
    p = plan(spark, [{"dataset": d} for d in "def"], documents={"p:d": POLICY, "p:e": POLICY})
    got = lifecycle.apply_outcomes(state(spark), p, outcomes(spark, p__d=True, p__e=False, p__f=True), NOW)
    assert records(got.drop("seq")) == [
        ("p:d", "p", "d", "Tranche 1: Abandoned Test/Temp (>1yr)", "gs://b/backups/p_d_backup.json", naive(NOW), "scream_test", None, None)
    ]


def test_new_records_follow_in_sheet_order(spark):
    targets = [{"dataset": d, "size_gb": s} for d, s in [("d", 1.0), ("e", 3.0), ("f", 2.0)]]
    old = [{"key": "q:z", "seq": 41}]
    got = lifecycle.apply_outcomes(state(spark, *old), plan(spark, targets, old), outcomes(spark, p__d=True, p__e=True, p__f=True), NOW)
    ordered = sorted(got.collect(), key=lambda r: r.seq)
    assert [r.key for r in ordered] == ["q:z", "p:e", "p:f", "p:d"] and len({r.seq for r in ordered}) == 4


def test_a_retest_replaces_the_whole_record_in_place(spark):
    old = [{"key": "p:d", "status": "restored", "restored_at": ago(1), "scream_initiated_at": ago(50), "seq": 0}, {"key": "p:e", "seq": 1}]
    got = by_key(lifecycle.apply_outcomes(state(spark, *old), plan(spark, [{"dataset": "d"}], old), outcomes(spark, p__d=True), NOW))
    assert (got["p:d"].status, got["p:d"].restored_at, got["p:d"].seq) == ("scream_test", None, 0)
    assert got["p:d"].scream_initiated_at == naive(NOW) and got["p:e"].scream_initiated_at == naive(ago(10))


def test_applying_twice_changes_nothing_more(spark):
    p, ok = plan(spark, [{"dataset": d} for d in "de"]), outcomes(spark, p__d=True, p__e=True)
    once = lifecycle.apply_outcomes(state(spark), p, ok, NOW)
    twice = lifecycle.apply_outcomes(once, p, ok.union(ok), NOW)
    assert sorted(records(once)) == sorted(records(twice))


def test_looking_at_a_plan_leaves_the_state_alone(spark):
    before = state(spark, {"key": "p:z"})
    rows = records(before)
    lifecycle.plan_scream_test(audit(spark, {"dataset": "d"}), before, policies(spark, {"p:d": POLICY}), NOW, None).collect()
    lifecycle.plan_purge(before, NOW).collect()
    assert records(before) == rows


@pytest.mark.parametrize("seconds,days,action", [(0, 7, "delete"), (-1, 6, "skip")])
def test_retention_is_inclusive(spark, seconds, days, action):
    [row] = lifecycle.plan_purge(state(spark, {"key": "p:d", "scream_initiated_at": ago(7, seconds)}), NOW).collect()
    assert (row.days_elapsed, row.action, row.threshold) == (days, action, 7)
    assert row.reason == (None if action == "delete" else "only 6 days elapsed (threshold: 7)")


def test_purge_looks_only_at_active_tests(spark):
    entries = [{"key": f"p:{s}", "status": s} for s in ("deleted", "restored", "odd")] + [{"key": "p:d"}]
    assert records(lifecycle.plan_purge(state(spark, *entries), NOW), "key") == [("p:d",)]
    assert records(lifecycle.plan_purge(state(spark, *entries), NOW, retention_days=14), "action") == [("skip",)]


def test_unknown_initiation_is_never_deleted(spark):
    [row] = lifecycle.plan_purge(state(spark, {"key": "p:d", "scream_initiated_at": None}), NOW).collect()
    assert (row.action, row.reason) == ("skip", "no initiation time")


def test_purge_outcomes(spark):
    entries = [{"key": "p:a"}, {"key": "p:b"}, {"key": "p:c"}, {"key": "p:d", "status": "restored"}]
    got = by_key(lifecycle.apply_purge(state(spark, *entries), outcomes(spark, p__a=True, p__b=False, p__d=True), NOW))
    assert {k: (r.status, r.deleted_at) for k, r in got.items()} == {
        "p:a": ("deleted", naive(NOW)),
        "p:b": ("scream_test", None),
        "p:c": ("scream_test", None),
        "p:d": ("restored", None),
    }


def test_logs(spark):
    p = plan(spark, [{"dataset": d} for d in "defgh"], [{"key": "p:e"}], {f"p:{d}": POLICY for d in "degh"})
    reports = spark.createDataFrame(
        [("p:d", True, True), ("p:g", False, True), ("p:h", True, False)], "key string, ok boolean, label_ok boolean"
    )
    assert sorted(r.message for r in lifecycle.scream_test_log(p, reports).collect()) == [
        "ERROR: Failed to apply scream test for p:g - dataset access NOT modified",
        "Failed to backup p:f (no backup). Skipping.",
        "Scream test applied successfully for p:d",
        "Scream test applied successfully for p:h",
        "Skipping p:e - already processed (Status: scream_test)",
        "WARNING: Failed to label p:h - continuing with access restriction",
    ]
    purge = lifecycle.plan_purge(state(spark, {"key": "p:a"}, {"key": "p:b"}, {"key": "p:c", "scream_initiated_at": ago(3)}), NOW)
    assert sorted(r.message for r in lifecycle.purge_log(purge, outcomes(spark, p__a=True)).collect()) == [
        "Deleted p:a",
        "ERROR: Failed to delete p:b",
        "Skipping p:c - only 3 days elapsed (threshold: 7)",
    ]
