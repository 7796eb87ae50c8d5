"""Text expressions over dataset names, descriptions, readers and keys."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values.
TEST_NAME_TOKENS = ("test", "temp", "tmp", "demo", "poc", "beta")
NO_DESCRIPTION = "No Description"
SERVICE_ACCOUNT_DOMAIN = "gserviceaccount.com"


def is_test_name(name: Column) -> Column:
    """Substring test, so ``latest`` and ``template`` count too."""
    return F.lower(name).rlike("|".join(TEST_NAME_TOKENS))


def clean_description(option_value: Column) -> Column:
    return F.trim(F.coalesce(option_value, F.lit(NO_DESCRIPTION)), F.lit('"'))


def capitalise(text: Column) -> Column:
    """First letter upper, the rest lower; ``initcap`` would raise every word."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(text.substr(F.lit(2), F.length(text))))


def dataset_key(project: Column, dataset: Column) -> Column:
    return F.concat(project, F.lit(":"), dataset)


def organisation(project: Column, by_prefix: Mapping[str, str], default: str) -> Column:
    """First matching project-id prefix decides."""
    label = F.lit(default)
    for prefix, name in reversed(list(by_prefix.items())):
        label = F.when(project.startswith(prefix), F.lit(name)).otherwise(label)
    return label


def is_service_account(user: Column) -> Column:
    return user.contains(SERVICE_ACCOUNT_DOMAIN)


def bucket_of(path: Column) -> Column:
    """Bucket of an object-store path such as ``gs://bucket/backups/x.json``; null for local paths."""
    return F.when(path.startswith("gs://"), F.split(path, "/").getItem(2))


def starts_with_digit(text: str) -> bool:
    return text[:1].isdigit()


def is_number_like(text: str) -> bool:
    """Digits and dots only, as in the tranche shorthand ``1.1``."""
    return re.fullmatch(r"[\d.]*", text) is not None


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores before it the first name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
