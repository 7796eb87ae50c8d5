"""Audits against plain-Python answers on random estates."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from estate_hygiene.operators import storage as storage_ops
from estate_hygiene.plans import audits
from estate_hygiene.sources import estate
from helpers import NOW, ago, job, jobs, options, ref, records, schemata, storage, stored, tables

WORDS = ["sales", "test_x", "latest", "core", "tmp", "billing"]


def naive(when):
    return when.replace(tzinfo=None) if when else None


class RandomEstate:
    def __init__(self, spark, seed):
        rng = random.Random(seed)
        scopes = [(p, r) for p in ("p", "q") for r in ("eu", "us")]
        self.datasets = [(p, r, f"{w}_{i}") for p, r in scopes for i, w in enumerate(WORDS * 3)]
        self.tables = [(*d, f"t{n}") for d in self.datasets for n in range(rng.randrange(4))]
        self.size, self.modified, self.created = {}, {}, {}
        for t in self.tables:
            self.size[t] = rng.choice([0, rng.randrange(1, 700 * 1024**3), rng.randrange(1, 10**6)])
            self.modified[t] = rng.choice([None, NOW - timedelta(seconds=rng.randrange(900 * 86400))])
            self.created[t] = NOW - timedelta(seconds=rng.randrange(500 * 86400))
        self.description = {d: f'"about {d[2]}"' for d in self.datasets if rng.random() < 0.5}
        self.jobs = []
        for n in range(400):
            p, r = rng.choice(scopes)
            refs = rng.choices(self.tables, k=rng.randrange(5)) if rng.random() < 0.9 else None
            dest = rng.choice(self.tables) if rng.random() < 0.4 else None
            when = NOW - timedelta(seconds=rng.randrange(400 * 86400))
            self.jobs.append((n, p, r, when, f"u{rng.randrange(30)}@x", refs, dest))
        self.spark = spark

    def frames(self):
        s = self.spark
        as_ref = lambda t: ref(t[2], t[3], t[0])
        return {
            "schemata": schemata(s, *[{"project_id": p, "region": r, "schema_name": d} for p, r, d in self.datasets]),
            "options": options(s, *[
                {"project_id": d[0], "region": d[1], "schema_name": d[2], "option_name": "description", "option_value": v}
                for d, v in self.description.items()
            ]),
            "storage": storage(s, *[
                {"project_id": t[0], "region": t[1], "table_schema": t[2], "table_name": t[3],
                 "total_logical_bytes": self.size[t], "storage_last_modified_time": self.modified[t]} for t in self.tables
            ]),
            "jobs": jobs(s, *[
                job(str(n), when, user, None if refs is None else [as_ref(t) for t in refs], dest and as_ref(dest), p, r)
                for n, p, r, when, user, refs, dest in self.jobs
            ]),
        }

    def table_frames(self):
        f = self.frames()
        catalogue = tables(self.spark, *[
            {"project_id": t[0], "region": t[1], "table_schema": t[2], "table_name": t[3], "creation_time": self.created[t]}
            for t in self.tables
        ])
        return catalogue, f["storage"], f["jobs"]

    def events(self, dataset, kind):
        p, r, d = dataset
        found = []
        for _, jp, jr, when, user, refs, dest in self.jobs:
            if (jp, jr) != (p, r) or not when > NOW - timedelta(days=180):
                continue
            touched = (refs or []) if kind == "READ" else [dest] if dest else []
            found += [(when, user) for t in touched if t[0] == jp and t[2] == d]
        return sorted(found, key=lambda e: (-e[0].timestamp(), e[1]))[:5]

    def profile(self, dataset):
        mine = [t for t in self.tables if t[:3] == dataset]
        text = lambda es, none: "\n".join(f"{w:%Y-%m-%d %H:%M} ({u})" for w, u in es) or none
        reads, writes = self.events(dataset, "READ"), self.events(dataset, "WRITE")
        return {
            "size": sum(self.size[t] for t in mine) / 1024**3 if mine else None,
            "modified": max((self.modified[t] for t in mine if self.modified[t]), default=None),
            "read": reads[0][0] if reads else None,
            "write": writes[0][0] if writes else None,
            "reads": text(reads, "No Read Access (180d)"),
            "writes": text(writes, "No Write Access (180d)"),
            "description": self.description.get(dataset, "No Description").strip('"'),
            "test": any(x in dataset[2] for x in ("test", "temp", "tmp", "demo", "poc", "beta")),
        }


@pytest.fixture(scope="module", params=[1, 2])
def random_estate(spark, request):
    return RandomEstate(spark, request.param)


def money(size):
    return 0.0 if size is None else round(size * 0.02, 2)


def test_deep_history_audit(random_estate):
    expected = []
    for d in random_estate.datasets:
        f = random_estate.profile(d)
        size = f["size"] or 0.0
        touched = (NOW - f["modified"]).days if f["modified"] else None
        times = [t for t in (f["read"], f["write"], f["modified"]) if t]
        idle = (NOW - max(times)).days if times else None
        if touched is None or touched > 365:
            n = 1 if f["test"] else 2 if size > 100 else 3
        else:
            n = 4 if idle > 180 else 5 if f["test"] else 0
        tranche, priority = {
            1: ("Tranche 1: Abandoned Test/Temp (>1yr)", "Critical"),
            2: ("Tranche 2: Abandoned Large Prod (>1yr)", "Critical"),
            3: ("Tranche 3: Abandoned Small Prod (>1yr)", "High"),
            4: ("Tranche 4: Stale (No Access 180d, No Write >6mo)", "Medium"),
            5: ("Tranche 5: Active Test (Housekeeping)", "Low"),
            0: ("Active", "Low"),
        }[n]
        expected.append((
            *d, f["description"], round(size, 2), money(size), tranche, priority, idle, touched, naive(f["read"]),
            naive(f["write"]), f["reads"], f["writes"],
            f"{f['modified']:%Y-%m-%d %H:%M:%S}" if f["modified"] else "Never/Historical",
            "CONFIRMED: NO MODS > 1YR" if touched and touched > 365 else "REVIEW",
        ))
    order = {"T": 0, "A": 1}
    expected.sort(key=lambda r: (order[r[6][0]], r[6][:9], -r[4], r[0], r[1], r[2]))
    assert records(audits.deep_history_audit(**random_estate.frames(), as_of=NOW)) == expected


def test_tranche_audit(random_estate):
    expected = []
    for d in random_estate.datasets:
        f = random_estate.profile(d)
        stale, size = f["read"] is None and f["write"] is None, f["size"] or 0.0
        if stale:
            n, priority = (1, "Critical") if f["test"] else (2, "Critical") if size > 100 else (3, "High")
        else:
            n, priority = (4, "Medium") if f["test"] else (5, "Low") if size > 500 else (6, "Low")
        tranche = ["Tranche 1: Stale Test/Temp", "Tranche 2: High Saving Stale (>100GB)", "Tranche 3: Stale Production",
                   "Tranche 4: Active Test/Temp (Review Needed)", "Active (Large: Monitor)", "Active"][n - 1]
        expected.append((n, (
            *d, f["description"], round(size, 2), money(f["size"]), tranche, priority, naive(f["read"]), naive(f["write"]),
            f["reads"], f["writes"], naive(f["modified"]),
        )))
    expected.sort(key=lambda e: (e[0], -e[1][4], e[1][:3]))
    assert records(audits.tranche_audit(**random_estate.frames(), as_of=NOW)) == [e[1] for e in expected]


def test_access_audit(random_estate):
    expected = []
    for d in random_estate.datasets:
        f = random_estate.profile(d)
        stale = f["read"] is None and f["write"] is None
        status, rank, action = (
            ("STALE", 1, "DELETE (No access 180d)") if stale
            else ("TEST DATA", 2, "Verify & Cleanup (Test/Temp naming)") if f["test"] else ("ACTIVE", 3, "Keep")
        )
        if (f["size"] or 0) > 100 and (stale or f["test"]):
            rank = 0
        size = None if f["size"] is None else round(f["size"], 2)
        row = (*d, f["description"], size, naive(f["modified"]), f["reads"], f["writes"], status,
               ("Critical", "High", "Medium", "Low")[rank], action)
        expected.append((rank, size is None, -(size or 0), d, row))
    expected.sort(key=lambda e: e[:4])
    assert records(audits.access_audit(**random_estate.frames(), as_of=NOW)) == [e[4] for e in expected]


@pytest.mark.parametrize("named", [True, False])
@pytest.mark.parametrize("top_n", [5, 100])
def test_stale_table_audit(random_estate, named, top_n):
    e = random_estate
    expected = []
    for p, r in {t[:2] for t in e.tables}:
        mine = [t for t in e.tables if t[:2] == (p, r) and e.size[t] > 0]
        used = {
            (t[2], t[3])
            for _, jp, jr, when, _, refs, _ in e.jobs
            if (jp, jr) == (p, r) and when > NOW - timedelta(days=180)
            for t in refs or []
        }
        for t in sorted(mine, key=lambda t: (-e.size[t], t[2], t[3]))[:top_n]:
            if (t[2], t[3]) not in used and (NOW - e.created[t]).days > 180:
                gb = e.size[t] / 1024**3
                expected.append((
                    "one" if p == "p" else "two", p, f"region-{r}", t[2], t[3], round(gb, 2), str(e.created[t]),
                    "NEVER (>180 days)", "ZOMBIE DATA", "DELETE: No query history found for 180 days.", round(gb * 0.02, 2),
                ))
    expected.sort(key=lambda r: (-r[10], *r[1:5]))
    scopes = {"projects": ["p", "q"], "regions": ["eu", "us"]} if named else {}
    got = audits.stale_table_audit(
        *e.table_frames(), as_of=NOW, top_n=top_n, organisations={"p": "one"}, default_organisation="two", **scopes
    )
    assert records(got) == expected


def test_small_unused_tables_outside_the_cut_are_not_reported(spark):
    catalogue = tables(spark, *[{"table_schema": "d", "table_name": t, "creation_time": ago(300)} for t in ("big", "small")])
    sizes = storage(spark, stored("d", 9, table="big"), stored("d", 1, table="small"))
    used = jobs(spark, job("1", ago(1), refs=[ref("d", "big", "elsewhere")]))
    assert records(audits.stale_table_audit(catalogue, sizes, used, NOW, top_n=1)) == []
    assert len(records(audits.stale_table_audit(catalogue, sizes, used, NOW, top_n=2))) == 1


def test_scope_limits_the_table_audit(spark):
    rows = [{"table_schema": "d", "table_name": "t", "creation_time": ago(300), "project_id": p} for p in ("p", "q")]
    sizes = storage(spark, *[stored("d", 1, project_id=p) for p in ("p", "q")])
    got = audits.stale_table_audit(tables(spark, *rows), sizes, jobs(spark), NOW, projects=["q"], regions=["eu"])
    assert records(got, "project", "region") == [("q", "region-eu")]


def test_unreadable_usage_shows_in_the_table_audit(spark, covered):
    rows = [{"table_schema": "d", "table_name": "t", "creation_time": ago(300), "project_id": p} for p in "pqrs"]
    sizes = storage(spark, *[stored("d", 1, project_id=p) for p in "pqrs"])
    got = audits.stale_table_audit(tables(spark, *rows), sizes, jobs(spark), NOW, coverage=covered)
    assert records(got, "project", "history_ok") == [("p", True), ("q", False)]


@pytest.fixture()
def covered(spark):
    scopes = spark.createDataFrame([("p", "eu"), ("q", "eu"), ("r", "eu"), ("s", "eu")], "project_id string, region string")
    loads = [("p", s, True, None) for s in ("METADATA", "READ", "WRITE")]
    loads += [("q", "METADATA", True, None), ("q", "READ", False, "403 denied"), ("q", "WRITE", True, None)]
    loads += [("r", "METADATA", False, "500 oops"), ("r", "READ", True, None), ("r", "WRITE", True, None)]
    rows = [(p, "eu", s, ok, error) for p, s, ok, error in loads]
    return estate.scope_coverage(scopes, spark.createDataFrame(rows, "project_id string, region string, source string, ok boolean, error string"))


def test_scope_coverage(covered):
    got = {r.project_id: tuple(r)[2:] for r in covered.select("project_id", "region", "metadata_ok", "history_ok", "denied").collect()}
    assert got == {"p": (True, True, False), "q": (True, False, True), "r": (False, True, False), "s": (False, False, False)}


def test_unreadable_log_can_be_kept_from_confirming(spark, covered):
    frames = {
        "schemata": schemata(spark, *[{"schema_name": "d", "project_id": p, "region": "eu"} for p in "pqrs"]),
        "options": options(spark),
        "storage": storage(spark, *[stored("d", 1, ago(500), project_id=p) for p in "pqrs"]),
        "jobs": jobs(spark),
    }
    plain = audits.deep_history_audit(**frames, as_of=NOW, coverage=covered)
    strict = audits.deep_history_audit(**frames, as_of=NOW, coverage=covered, require_history=True)
    columns = ("project", "history_ok", "deletion_status")
    confirmed = "CONFIRMED: NO MODS > 1YR"
    assert records(plain, *columns) == [("p", True, confirmed), ("q", False, confirmed)]
    assert records(strict, *columns) == [("p", True, confirmed), ("q", False, "REVIEW")]
    for audit in (audits.access_audit, audits.tranche_audit):
        assert sorted(records(audit(**frames, as_of=NOW, coverage=covered), "project", "history_ok")) == [("p", True), ("q", False)]
    with pytest.raises(ValueError):
        audits.deep_history_audit(**frames, as_of=NOW, require_history=True)


def test_export_headers(random_estate):
    frames = random_estate.frames()
    exported = audits.with_headers(audits.deep_history_audit(**frames, as_of=NOW), audits.DEEP_HEADERS)
    assert exported.columns[4:6] == ["Size (GB)", "Monthly Cost ($)"] and exported.columns[-1] == "Defensible Deletion Status"
    assert exported.where(F.col("Size (GB)") > 100).count() > 0
    assert len(audits.with_headers(audits.access_audit(**frames, as_of=NOW), audits.ACCESS_HEADERS).columns) == 11
    assert len(audits.with_headers(audits.tranche_audit(**frames, as_of=NOW), audits.TRANCHE_HEADERS).columns) == 13
    stale = audits.stale_table_audit(*random_estate.table_frames(), as_of=NOW)
    assert audits.with_headers(stale, audits.TABLE_HEADERS).columns[-1] == "Monthly Waste ($)"
