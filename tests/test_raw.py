import hashlib
import random
from datetime import date, datetime
from decimal import Decimal

import pytest

from ledgermill import schemas
from ledgermill.plans import pipeline
from ledgermill.sources import raw
from ledgermill.sources.layers import Layers


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture()
def base(tmp_path):
    write(
        tmp_path / "accounts/ingest_date=2024-01-01/accounts.csv",
        "account_id,customer_id,account_type,balance_usd,open_date\nA0,C0,checking,1,2020-01-01\n",
    )
    write(
        tmp_path / "accounts/ingest_date=2024-01-02/accounts.csv",
        "account_id,customer_id,account_type,balance_usd,open_date\n"
        'A1 ,C1,"say ""hi"", you",10.005,2022/01/15\n'
        "A2,NA,nan,,15-08-2023\n"
        " A3,C3,  ,3,never\n",
    )
    return tmp_path


def test_the_latest_date_is_read_and_typed(spark, base):
    rows = [tuple(r) for r in raw.read_typed(spark, str(base), "accounts").orderBy("account_id").collect()]
    assert rows == [
        ("A1", "C1", 'say "hi", you', Decimal("10.01"), date(2022, 1, 15)),
        ("A2", None, None, None, date(2023, 8, 15)),
        ("A3", "C3", "", Decimal("3.00"), None),
    ]
    old = raw.read_typed(spark, str(base), "accounts", date(2024, 1, 1))
    assert [r.account_id for r in old.collect()] == ["A0"]


def test_only_the_wanted_folder_is_scanned(spark, base):
    plan = raw.read_typed(spark, str(base), "accounts", date(2024, 1, 1))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan._jdf.queryExecution().toString()


def test_bad_numbers_fail_the_batch(spark, base):
    write(
        base / "accounts/ingest_date=2024-01-03/accounts.csv",
        "account_id,customer_id,account_type,balance_usd,open_date\nA1,C1,x,ten,2022/01/15\n",
    )
    with pytest.raises(Exception, match="balance_usd: cannot load ten"):
        raw.read_typed(spark, str(base), "accounts").collect()


def test_quoted_line_breaks_need_multiline(spark, tmp_path):
    write(tmp_path / "branches/ingest_date=2024-01-01/b.csv", 'branch_id,branch_name,manager_name\nB1,"two\nlines",m\n')
    rows = raw.read_typed(spark, str(tmp_path), "branches", multiline=True).collect()
    assert [tuple(r) for r in rows] == [("B1", "two\nlines", "m")]


def test_surplus_and_missing_fields_fail_the_batch(spark, tmp_path):
    head = "branch_id,branch_name,manager_name\n"
    for k, record in enumerate(("B3,Third,Cy,EXTRA,FIELDS", "B3,Third", '"B3,Third,Cy')):
        base = tmp_path / str(k)
        write(base / "branches/ingest_date=2024-01-01/b.csv", f"{head}B1,a,b\n{record}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            raw.read_typed(spark, str(base), "branches").select("branch_id").collect()


def test_line_breaks_survive_landing_on_request_only(spark, tmp_path):
    rows = spark.createDataFrame([("B1", "two\nlines", "m"), ("B2", "one", None)], schemas.raw_schema("branches"))
    with pytest.raises(Exception, match="line break"):
        raw.land(rows, str(tmp_path / "a"), "branches", date(2024, 1, 1))
    raw.land(rows, str(tmp_path / "b"), "branches", date(2024, 1, 1), multiline=True)
    back = raw.read_typed(spark, str(tmp_path / "b"), "branches", multiline=True)
    assert sorted(map(tuple, back.collect())) == [("B1", "two\nlines", "m"), ("B2", "one", None)]


def test_manifest_of_odd_names_and_broken_records(spark, tmp_path):
    write(tmp_path / "in/my file+100%.csv", 'a,b\n1,"x\ny"\n2,z\n')
    one = raw.manifest_tables(spark, str(tmp_path / "in"), multiline=True).first()
    assert (one.source_file, one.record_count) == ("my file+100%.csv", 2)


def test_large_files_have_a_digest_of_their_lines(spark, tmp_path, monkeypatch):
    write(tmp_path / "in/a.csv", "a,b\n1,x\n2,y\n")
    write(tmp_path / "in/b.csv", "a,b\n2,y\n1,x\n")
    write(tmp_path / "in/c.csv", "a,b\n2,y\n1,z\n")
    monkeypatch.setattr(raw, "CHECKSUM_BYTES", 3)
    rows = {r.source_file: r for r in raw.manifest_tables(spark, str(tmp_path / "in")).collect()}
    assert {r.checksum_sha256 for r in rows.values()} == {None}
    assert rows["a.csv"].line_digest == rows["b.csv"].line_digest != rows["c.csv"].line_digest
    first = [int(hashlib.sha256(x.encode()).hexdigest()[:15], 16) for x in ("a,b", "1,x", "2,y")]
    assert rows["a.csv"].line_digest == f"3:{sum(first)}"


def test_only_a_missing_list_means_nothing_is_published(spark, tmp_path):
    assert Layers(spark, str(tmp_path / "new")).tables("mart") == {}
    (tmp_path / "mart/_published/run=1").mkdir(parents=True)
    write(tmp_path / "mart/_published/run=1/part-0.parquet", "not a list")
    with pytest.raises(Exception):
        Layers(spark, "nosuchscheme://lake").tables("mart")


def test_a_published_run_is_closed(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    layers.write("mart", "a", spark.range(2), "1")
    layers.publish("mart", "1", ["a"])
    with pytest.raises(ValueError, match="is published"):
        layers.write("mart", "a", spark.range(3), "1")


def test_dates_must_agree(spark, base):
    write(base / "branches/ingest_date=2024-01-01/branches.csv", "branch_id,branch_name,manager_name\nB1,a,b\n")
    assert raw.resolve_date(spark, str(base), tables=("accounts",)) == date(2024, 1, 2)
    assert raw.resolve_date(spark, str(base), date(2024, 1, 1)) == date(2024, 1, 1)
    with pytest.raises(ValueError, match="do not share"):
        raw.resolve_date(spark, str(base), tables=("accounts", "branches"))


def test_landing_a_date_again_replaces_only_that_date(spark, tmp_path):
    rows = spark.createDataFrame([("M1", " a, b ", None), ("M2", 'q"q', "")], schemas.raw_schema("merchants"))
    for day, frame in ((1, rows), (2, rows), (2, rows.limit(1))):
        raw.land(frame, str(tmp_path), "merchants", date(2024, 1, day))
    landed = raw.read_raw(spark, str(tmp_path), "merchants")
    assert sorted(map(tuple, landed.collect())) == [
        ("M1", " a, b ", None, date(2024, 1, 1)),
        ("M1", " a, b ", None, date(2024, 1, 2)),
        ("M2", 'q"q', None, date(2024, 1, 1)),
    ]


def test_discovery_and_manifest(spark, base, tmp_path):
    write(base / "deep/er/Loans.csv", "a,b\n")
    write(base / "deep/notes.txt", "not data\n")
    found = {r.file_name: r.table_name for r in raw.discover(spark, str(base)).collect()}
    assert found == {"accounts.csv": "accounts", "Loans.csv": "loans"}
    files = raw.manifest_tables(spark, str(base))
    rows = {(r.source_file, r.path.split("=")[-1][:10]): r for r in files.collect()}
    newest = rows["accounts.csv", "2024-01-02"]
    content = (base / "accounts/ingest_date=2024-01-02/accounts.csv").read_bytes()
    assert (newest.record_count, newest.file_size_bytes) == (3, len(content))
    assert newest.checksum_sha256 == hashlib.sha256(content).hexdigest()
    assert [r.record_count for k, r in rows.items() if k[0] == "Loans.csv"] == [0]
    at = datetime(2024, 1, 2, 3)
    document = raw.manifest(files, spark, "b1", "folder", date(2024, 1, 2), at, at)
    raw.write_manifest(document, str(tmp_path / "out"), "b1", files)
    assert spark.read.json(str(tmp_path / "out/manifest_files/manifest_b1")).count() == 3
    stored = spark.read.json(str(tmp_path / "out/manifests/manifest_b1")).first()
    assert stored.status == "SUCCESS" 
    assert [(t.table_name, t.files, t.record_count) for t in stored.tables] == [("accounts", 2, 4), ("loans", 1, 0)]
    assert stored.tables[0].checksum_sha256 is None and len(stored.tables[1].checksum_sha256) == 64
    failed = raw.manifest(None, spark, "b2", "folder", date(2024, 1, 2), at, at, "no source").first()
    assert (failed.status, failed.error, failed.tables) == ("FAILED", "no source", [])


def test_ingest_lands_all_tables_and_records_its_end(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "raw")
    write(source / "x/Accounts.csv", "account_id,customer_id,account_type,balance_usd,open_date\nA1,C1,x,1,2020-01-01\n")
    write(source / "branches.csv", "branch_id,branch_name,manager_name\nB1,a,b\nB2,c,d\n")
    write(source / "other.csv", "q\n1\n")
    day, tables = date(2024, 1, 2), ("accounts", "branches")
    files = raw.ingest(spark, str(source), base, day, "b1", tables=tables).collect()
    assert sorted((r.table_name, r.record_count, len(r.checksum_sha256)) for r in files) == [("accounts", 1, 64), ("branches", 2, 64)]
    assert [r.account_id for r in raw.read_typed(spark, base, "accounts").collect()] == ["A1"]
    assert spark.read.json(f"{base}/manifests/manifest_b1").first().status == "SUCCESS"
    with pytest.raises(FileNotFoundError, match="loans"):
        raw.ingest(spark, str(source), base, day, "b2", tables=(*tables, "loans"))
    failed = spark.read.json(f"{base}/manifests/manifest_b2").first()
    assert failed.status == "FAILED" and "loans" in failed.error
    at = datetime(2024, 1, 2)
    assert raw.manifest(None, spark, "b3", "folder", day, at, None).first().status == "RUNNING"


def test_no_file_is_an_error(spark, tmp_path):
    write(tmp_path / "readme.txt", "x")
    with pytest.raises(FileNotFoundError):
        raw.discover(spark, str(tmp_path))


def test_layers_switch_when_published(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    layers.write_all("mart", {"a": spark.range(1), "b": spark.range(2)}, "1")
    layers.publish("mart", "1", ["a", "b"])
    layers.write("mart", "a", spark.range(5), "2")
    assert layers.read("mart", "a").count() == 1
    layers.publish("mart", "2", ["a"])
    layers.write("mart", "b", spark.range(3), "2")
    assert layers.read("mart", "b").count() == 2
    layers.publish("mart", "2", [], added=("b",))
    fresh = Layers(spark, str(tmp_path))
    assert {t: df.count() for t, df in fresh.tables("mart").items()} == {"a": 5, "b": 5}
    assert not fresh.has("mart", "c") and not fresh.has("other", "a")


def test_malformed_records_are_set_aside_on_request(spark, tmp_path):
    names = schemas.raw_schema("loans").names
    good = [f"L{k}" + "," * (len(names) - 1) for k in range(5)]
    folder = tmp_path / "loans/ingest_date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("\n".join([",".join(names), *good[:3], "L9,short", *good[3:], good[0] + ",long", ""]))
    (folder / "b.csv").write_text(",".join(names) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_typed(spark, str(tmp_path), "loans").collect()
    kept, rejected = raw.read_divided(spark, str(tmp_path), "loans")
    assert sorted(r.loan_id for r in kept.collect()) == [f"L{k}" for k in range(5)]
    aside = sorted((r.first_field, r.record, r.file.rpartition("/")[2], r.table_name) for r in rejected.collect())
    assert aside == [("L0", good[0] + ",long", "a.csv", "loans"), ("L9", "L9,short", "a.csv", "loans")]
    assert kept.schema == raw.read_typed(spark, str(tmp_path), "loans").schema

    layers = Layers(spark, str(tmp_path / "lake"))
    s = pipeline.Settings(on_malformed="quarantine")
    empty = spark.createDataFrame([], kept.schema)
    counts = pipeline.load_staging(layers, lambda t: (kept, rejected) if t == "loans" else empty, s).collect()
    assert {r.table_name: r["rows"] for r in counts if r["rows"]} == {"stg_loans": 5, "stg_loans_rejected": 2}
    assert layers.read(pipeline.STG, "stg_loans_rejected").count() == 2


def ordered_digest(content: bytes) -> str:
    lines = content.split(b"\n")[: -1 if content.endswith(b"\n") else None]
    hashes = [hashlib.sha256(line).hexdigest() for line in lines]
    sums = [sum(p * int(h[k : k + 12], 16) for p, h in enumerate(hashes, 1)) for k in (0, 12, 24)]
    return hashlib.sha256(":".join(map(str, [len(content), len(lines), *sums])).encode()).hexdigest()


def test_digest_of_whole_files_read_in_many_blocks(spark, tmp_path):
    rng = random.Random(0)
    lines = ["id,text"] + [f"{k},{'x' * rng.randrange(40)}é" for k in range(500)]
    swapped = lines[:]
    swapped[100], swapped[400] = swapped[400], swapped[100]
    files = {
        "a": "\n".join(lines) + "\n", "copy": "\n".join(lines) + "\n", "swapped": "\n".join(swapped) + "\n", "open": "\n".join(lines),
        "returns": "\r\n".join(lines) + "\r\n", "gaps": "\n\n".join(lines) + "\n\n", "one": "id,text",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    digests = []
    for size in ("700", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            lined = raw.line_digests(spark, str(tmp_path))
            rows = raw.manifest_tables(spark, str(tmp_path)).collect() if size == "128m" else None
            digests.append({r.file.rsplit("/", 1)[1]: (r.line_digest, r.ordered) for r in lined.collect()})
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert digests[0] == digests[1] and len(digests[0]) == len(files)
    got = {r.table_name: r.content_digest for r in rows}
    assert got == {n: ordered_digest(t.encode()) for n, t in files.items()}
    assert got["a"] == got["copy"] and len(set(got.values())) == len(files) - 1
