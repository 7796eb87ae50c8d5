import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from estate_hygiene.operators import policy
from helpers import audit, by_key, evaluate, policies, records

OWNER = {"role": "OWNER", "userByEmail": "admin@x.com"}
READER = {"role": "READER", "userByEmail": "user@x.com"}
VIEW = {"view": {"projectId": "p", "datasetId": "d", "tableId": "v"}}


def restricted(spark, document, safe=()):
    text = document if isinstance(document, str) or document is None else json.dumps(document)
    [got] = evaluate(spark, policy.restrict_policy(F.col("x"), safe), "x string", [(text,)])
    return got and json.loads(got)


def test_only_owners_stay(spark):
    assert restricted(spark, {"access": [OWNER, READER, VIEW]}) == {"access": [OWNER]}


def test_other_fields_survive(spark):
    rest = {"n": 1, "big": 12345678901234567, "f": 1.5, "b": True, "z": None, "deep": {"a": [1, {"b": "ü"}]}, "labels": {"k": "v"}}
    assert restricted(spark, {**rest, "access": [READER]}) == {**rest, "access": []}


def test_missing_or_empty_access(spark):
    assert restricted(spark, {"access": []}) == {"access": []}
    assert restricted(spark, {"a": 1}) == {"a": 1, "access": []}


def test_safe_principals_stay(spark):
    assert restricted(spark, {"access": [READER, VIEW, OWNER]}, ["user@x.com"]) == {"access": [READER, OWNER]}


def test_owner_is_an_exact_role(spark):
    odd = [{"role": "owner"}, {"role": "DATAOWNER"}, {"role": None}, {}]
    assert restricted(spark, {"access": odd}) == {"access": []}


def test_unreadable_documents_give_null(spark):
    assert restricted(spark, "{not json") is None
    assert restricted(spark, "[1]") is None
    assert restricted(spark, None) is None


entries = st.lists(
    st.fixed_dictionaries(
        {}, optional={"role": st.sampled_from(["OWNER", "READER", "WRITER"]), "userByEmail": st.sampled_from(["a@x", "b@x"])}
    ),
    max_size=6,
)


@settings(max_examples=20, deadline=None)
@given(st.lists(entries, min_size=1, max_size=10))
def test_kept_and_revoked_make_up_the_original(spark, accesses):
    rows = [(json.dumps({"access": a}),) for a in accesses]
    df = spark.createDataFrame(rows, "x string").select(
        F.to_json(F.to_variant_object(policy.kept_entries(F.col("x"), ["a@x"]))).alias("kept"),
        F.to_json(F.to_variant_object(policy.revoked_entries(F.col("x"), ["a@x"]))).alias("revoked"),
    )
    for access, got in zip(accesses, df.collect(), strict=True):
        keep = [e for e in access if e.get("role") == "OWNER" or e.get("userByEmail") == "a@x"]
        assert json.loads(got.kept) == keep
        assert json.loads(got.revoked) == [e for e in access if e not in keep]


def test_duplicate_revoked_entries_are_all_listed(spark):
    df = policies(spark, {"p:d": json.dumps({"access": [READER, OWNER, READER]})})
    assert records(policy.revoked_policy_entries(df), "position", "role", "member") == [
        (0, "READER", "user@x.com"),
        (1, "READER", "user@x.com"),
    ]
    assert records(policy.restricted_policy_entries(df), "key", "member") == [("p:d", "admin@x.com")]


def test_labels_are_set_once(spark):
    labelled = policy.labels_text(policy.label_dataset(policy.labels_of(F.col("x"))))
    rows = [('{"labels":{"team":"a"}}',), ('{"labels":{"cleanup-status":"old","b":"c"}}',), ("{}",)]
    assert evaluate(spark, labelled, "x string", rows) == [
        "cleanup-status=scream-test,team=a",
        "b=c,cleanup-status=scream-test",
        "cleanup-status=scream-test",
    ]


def test_backup_paths(spark):
    path = lambda root: evaluate(spark, policy.backup_path(F.lit("project"), F.lit("dataset"), root))[0]
    assert path("gs://my-bucket") == "gs://my-bucket/backups/project_dataset_backup.json"
    assert path(None) == "backups/project_dataset_backup.json"


def test_snapshot_of_a_missing_policy_is_null(spark):
    targets = audit(spark, {"dataset": "d"}, {"dataset": "e"})
    got = by_key(policy.snapshot_policies(policies(spark, {"p:d": "{}", "p:z": "{}"}), targets, "gs://b"))
    assert {k: r.policy_json for k, r in got.items()} == {"p:d": "{}", "p:e": None}
    assert got["p:e"].backup_path == "gs://b/backups/p_e_backup.json"
