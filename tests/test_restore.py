import json

import pytest

from estate_hygiene.operators import lifecycle, policy, restore
from estate_hygiene.sources import tables
from helpers import NOW, audit, by_key, outcomes, policies, records, state

T1, T11, T2 = "Tranche 1: Abandoned", "Tranche 1.1: Special", "Tranche 2: Large"


def naive(when):
    return when.replace(tzinfo=None)


@pytest.fixture()
def entries(spark):
    return state(
        spark,
        {"key": "p:a", "tranche": T1},
        {"key": "p:b", "tranche": T11},
        {"key": "p:c", "tranche": T2, "status": "restored"},
        {"key": "p:d", "tranche": T1, "status": "deleted"},
    )


@pytest.mark.parametrize(
    "choice,keys",
    [
        ({"keys": "p:d"}, ["p:d"]),
        ({"keys": "p:x"}, []),
        ({"tranche": "1"}, ["p:a", "p:d"]),
        ({"tranche": "1.1"}, ["p:b"]),
        ({"tranche": T2}, ["p:c"]),
        ({"tranche": "Tranche 1"}, ["p:a", "p:b", "p:d"]),
        ({"every": True}, ["p:a", "p:b"]),
        ({"keys": "p:a", "tranche": "2", "every": True}, ["p:a"]),
    ],
)
def test_selection(entries, choice, keys):
    assert sorted(r.key for r in restore.select_restore(entries, **choice).collect()) == keys


def test_selection_needs_a_choice(entries):
    with pytest.raises(ValueError):
        restore.select_restore(entries)


def test_several_keys_and_unknown_ones(spark, entries):
    asked = spark.createDataFrame([("p:a",), ("p:a",), ("p:x",)], "key string")
    assert records(restore.select_restore(entries, keys=asked), "key") == [("p:a",)]
    assert records(restore.unknown_keys(entries, asked)) == [("p:x",)]


def snapshots(spark, entries, *without):
    rows = entries.select("key", "backup_path").collect()
    kept = [(r.key, "eu", r.backup_path, json.dumps({"access": [r.key]})) for r in rows if r.key not in without]
    return spark.createDataFrame(kept, "key string, region string, backup_path string, policy_json string")


def test_plan(spark, entries):
    got = by_key(restore.plan_restore(entries, snapshots(spark, entries, "p:b")))
    assert {k: (r.action, r.reason, r.prior_status) for k, r in got.items()} == {
        "p:a": ("restore", None, "scream_test"),
        "p:b": ("fail", "no backup", "scream_test"),
        "p:c": ("skip", "already marked as restored", "restored"),
        "p:d": ("restore", None, "deleted"),
    }
    assert json.loads(got["p:a"].policy_json) == {"access": ["p:a"]}


def test_outcomes_and_counts(spark, entries):
    plan = restore.plan_restore(entries, snapshots(spark, entries, "p:b"))
    results = restore.restore_results(plan, outcomes(spark, p__a=True, p__d=False))
    assert dict(records(results)) == {"p:a": "restored", "p:b": "failed", "p:c": "skipped", "p:d": "failed"}
    assert tuple(restore.outcome_counts(results).first()) == (1, 2, 1, 0, True)
    assert records(restore.failed_keys(results)) == [("p:b",), ("p:d",)]
    fine = restore.restore_results(plan.where("key = 'p:a'"), outcomes(spark, p__a=True))
    assert tuple(restore.outcome_counts(fine).first()) == (1, 0, 0, 0, False)
    assert sorted(r.message for r in restore.restore_log(plan, outcomes(spark, p__a=True)).collect()) == [
        "ERROR: Failed to restore p:b",
        "ERROR: Failed to restore p:d",
        "Skipping p:c - already marked as restored.",
        "Successfully restored p:a",
    ]


def test_state_after_restore(spark, entries):
    got = by_key(lifecycle.apply_restore(entries, outcomes(spark, p__a=True, p__b=False, p__c=True, p__d=True), NOW))
    assert {k: (r.status, r.restored_at) for k, r in got.items()} == {
        "p:a": ("restored", naive(NOW)),
        "p:b": ("scream_test", None),
        "p:c": ("restored", None),
        "p:d": ("restored", naive(NOW)),
    }


def test_restrict_then_restore_gives_the_original_policy(spark):
    text = json.dumps({"access": [{"role": "OWNER"}, {"role": "READER", "userByEmail": "é@x"}, {"view": {"a": 1}}], "x": [1, None]})
    targets, current = audit(spark, {"dataset": "d"}), policies(spark, {"p:d": text})
    backup = policy.snapshot_policies(current, targets, "gs://b")
    plan = lifecycle.plan_scream_test(targets, state(spark), current, NOW, "gs://b")
    after = lifecycle.apply_outcomes(state(spark), plan, outcomes(spark, p__d=True), NOW)
    [row] = restore.plan_restore(restore.select_restore(after, every=True), backup).collect()
    assert row.action == "restore" and row.policy_json == text


def test_a_restriction_waits_for_its_stored_backup(spark, tmp_path):
    text = json.dumps({"access": [{"role": "READER", "userByEmail": "a@x"}]})
    targets, current = audit(spark, {"dataset": "d"}, {"dataset": "e"}), policies(spark, {"p:d": text, "p:e": text})
    plan = lifecycle.plan_scream_test(targets, state(spark), current, NOW, "gs://b")
    tables.write_snapshots(policy.snapshots_of(plan.where("key = 'p:d'")), str(tmp_path))
    gated = by_key(lifecycle.require_backup(plan, tables.read_policy_snapshot(spark, str(tmp_path))))
    assert {k: (r.action, r.reason, r.restricted_policy is None) for k, r in gated.items()} == {
        "p:d": ("restrict", None, False),
        "p:e": ("fail", "no backup", True),
    }


def test_two_regions_of_one_key_keep_the_policy_that_was_restricted(spark, tmp_path):
    targets = audit(spark, {"dataset": "d", "region": "us"}, {"dataset": "d", "region": "eu"})
    eu = policies(spark, {"p:d": '{"access":[],"at":"eu"}'})
    both = eu.unionByName(eu.selectExpr("project_id", "'us' region", "dataset_id", "replace(policy_json, 'eu', 'us') policy_json"))
    plan = lifecycle.plan_scream_test(targets, state(spark), both, NOW, "gs://b")
    tables.write_snapshots(policy.snapshots_of(plan), str(tmp_path))
    [row] = tables.read_policy_snapshot(spark, str(tmp_path)).collect()
    assert (row.region, json.loads(row.policy_json)["at"]) == ("eu", "eu")


def test_a_clash_of_backups_fails_its_rows_and_no_others(spark, entries):
    made = snapshots(spark, entries)
    clash = made.where("key = 'p:a'").selectExpr("key", "'us' region", "backup_path", "'{}' policy_json")
    plan = by_key(restore.plan_restore(restore.select_restore(entries, every=True), made.unionByName(clash)))
    assert {k: (r.action, r.reason) for k, r in plan.items()} == {
        "p:a": ("fail", "different policies for one backup path"), "p:b": ("restore", None),
    }


def test_a_clash_of_backups_stops_the_restriction_that_needs_them(spark):
    targets, documents = audit(spark, {"dataset": "d"}, {"dataset": "e"}), policies(spark, {"p:d": '{"access":[]}', "p:e": '{"access":[]}'})
    plan = lifecycle.plan_scream_test(targets, state(spark), documents, NOW, "gs://bucket")
    stored = policy.snapshots_of(plan)
    clash = stored.where("key = 'p:d'").selectExpr("key", "'us' region", "backup_path", "'{}' policy_json")
    found = by_key(lifecycle.require_backup(plan, stored.unionByName(clash)))
    assert {k: (r.action, r.reason) for k, r in found.items()} == {
        "p:d": ("fail", "different policies for one backup path"), "p:e": ("restrict", None),
    }
