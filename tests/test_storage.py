from estate_hygiene.operators import storage as ops
from helpers import ago, options, records, schemata, storage, stored, tables


def naive(when):
    return when.replace(tzinfo=None)


def test_metadata_sums_sizes_and_takes_the_last_change(spark):
    got = ops.dataset_metadata(
        schemata(spark, "d"),
        options(spark),
        storage(spark, stored("d", 1.5, ago(9), "a"), stored("d", 2.0, ago(3), "b"), stored("other", 9, ago(1))),
    )
    assert records(got) == [("p", "eu", "d", "No Description", 3.5, naive(ago(3)))]


def test_datasets_without_tables_stay_with_unknown_size(spark):
    got = ops.dataset_metadata(schemata(spark, "d"), options(spark), storage(spark))
    assert records(got, "size_gb", "last_storage_modified") == [(None, None)]


def test_only_the_description_option_is_used(spark):
    opts = options(
        spark,
        {"schema_name": "d", "option_name": "description", "option_value": '"about "d""'},
        {"schema_name": "d", "option_name": "location", "option_value": '"eu"'},
        {"schema_name": "e", "option_name": "location", "option_value": '"eu"'},
    )
    got = ops.dataset_metadata(schemata(spark, "d", "e"), opts, storage(spark))
    assert sorted(records(got, "dataset_id", "description")) == [("d", 'about "d'), ("e", "No Description")]


def test_same_dataset_in_two_regions_gives_two_rows(spark):
    both = schemata(
        spark,
        {"schema_name": "d", "project_id": "p", "region": "eu"},
        {"schema_name": "d", "project_id": "p", "region": "us"},
    )
    got = ops.dataset_metadata(both, options(spark), storage(spark, stored("d", 2.0), stored("d", 3.0, region="us")))
    assert sorted(records(got, "region", "size_gb")) == [("eu", 2.0), ("us", 3.0)]


def test_empty_and_unsized_tables_are_left_out(spark):
    catalogue = tables(spark, *[{"table_schema": "d", "table_name": t, "creation_time": ago(1)} for t in "abcd"])
    sizes = storage(spark, stored("d", 1.0, table="a"), stored("d", 0, table="b"), stored("d", None, table="c"), stored("d", 1.0, table="x"))
    assert records(ops.nonempty_tables(catalogue, sizes), "table_name") == [("a",)]


def test_largest_tables_per_scope_with_ties_by_name(spark):
    names = ["a", "b", "c", "d"]
    rows = [{"table_schema": "d", "table_name": t, "creation_time": ago(1), "region": r} for t in names for r in ("eu", "us")]
    sizes = [stored("d", {"a": 1, "b": 5, "c": 5, "d": 2}[t], table=t, region=r) for t in names for r in ("eu", "us")]
    got = ops.largest_tables(tables(spark, *rows), storage(spark, *sizes), top_n=3)
    expected = [(r, t, i + 1) for r in ("eu", "us") for i, t in enumerate(["b", "c", "d"])]
    assert sorted(records(got, "region", "table_name", "size_rank")) == sorted(expected)
