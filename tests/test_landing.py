import gzip
import os

import pytest

from millrace.plans import landing, lms
from millrace.plans.refine import Layers, ingest
from millrace.sources import files, headers
from millrace.sources.manifest import CLAIMED, LANDED, QUARANTINED, SKIPPED, Manifest, Outcome
from millrace.streaming.drops import land_available
from tests.lms_rows import csv_text, row

DAY1, DAY2 = "2024-01-15", "2024-01-16"


@pytest.fixture
def drops(tmp_path):
    folder = tmp_path / "drops"
    folder.mkdir()

    def write(name, text):
        (folder / name).write_text(text)
        return str(folder / name)

    write.folder = str(folder)
    return write


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "tables"))


def states(layers):
    rows = landing.manifest_of(layers.landing).read().filter("state <> 'claimed'").collect()
    return {r.path.rsplit("/", 1)[1]: (r.state, r.rows, r.reason) for r in rows}


BAD = "Who,Cares\r\n1,2\r\n"
KEYLESS = csv_text(row("7")).replace("Student_ID,", "Pupil,")


@pytest.mark.parametrize("how", ["batch", "stream"])
def test_bad_files_never_stand_in_the_way(spark, layers, drops, tmp_path, how):
    def land(day):
        if how == "batch":
            return ingest(spark, drops.folder, layers.landing, day)
        return land_available(spark, drops.folder, layers.landing, day, str(tmp_path / "checkpoint"))

    drops("a.csv", csv_text(row("1")))
    drops("bad.csv", BAD)
    drops("keyless.csv", KEYLESS)
    drops("twice.csv", csv_text(row("8")).replace("Name,", "Student_ID,"))
    drops("z.csv", csv_text(row("2"), row("3")))
    land(DAY1)
    assert sorted(r.Student_ID for r in layers.landing.read().collect()) == ["1", "2", "3"]
    assert states(layers) == {
        "a.csv": (LANDED, 1, None), "z.csv": (LANDED, 2, None),
        "bad.csv": (QUARANTINED, None, "no known column"),
        "keyless.csv": (QUARANTINED, None, "columns missing: Student_ID"),
        "twice.csv": (QUARANTINED, None, "columns twice: Student_ID"),
    }
    # The file is mended, and a new one comes: both land, nothing else is read again.
    path = drops("bad.csv", csv_text(row("9")))
    os.utime(path, (1_900_000_000, 1_900_000_000))
    drops("late.csv", csv_text(row("4")))
    land(DAY2)
    assert sorted(r.Student_ID for r in layers.landing.read().collect()) == ["1", "2", "3", "4", *(["9"] if how == "batch" else [])]


def test_a_file_that_cannot_be_read_is_found_among_many(spark, layers, drops):
    paths = [drops(f"{n}.csv", csv_text(row(str(n)))) for n in range(5)]
    listing = files.listing(spark, drops.folder)
    new = {r.path: r for r in listing.collect()}
    layout = headers.by_position(lms.EXTRACT)
    os.remove(paths[3])
    manifest = landing.manifest_of(layers.landing)
    assert landing._land(manifest, layers.landing, DAY1, lms.EXTRACT, 1, {layout: list(new)}, new) == 4
    assert sorted(r.Student_ID for r in layers.landing.read().collect()) == ["0", "1", "2", "4"]
    assert [r.path.rsplit("/", 1)[1] for r in manifest.quarantine().collect()] == ["3.csv"]


def test_a_run_that_died_between_the_commits_lands_nothing_twice(spark, layers, drops, monkeypatch):
    drops("a.csv", csv_text(row("1")))

    def broken(self, outcomes):
        outcomes = list(outcomes)
        if any(o.state == LANDED for o in outcomes):
            raise RuntimeError("lost the driver")
        return record(self, outcomes)

    record = Manifest.record
    with monkeypatch.context() as patched:
        patched.setattr(Manifest, "record", broken)
        with pytest.raises(RuntimeError, match="lost the driver"):
            ingest(spark, drops.folder, layers.landing, DAY1)
    drops("b.csv", csv_text(row("2")))
    assert ingest(spark, drops.folder, layers.landing, DAY1) == 1
    assert sorted(r.Student_ID for r in layers.landing.read().collect()) == ["1", "2"]
    assert {name: state for name, (state, _, _) in states(layers).items()} == {"a.csv": LANDED, "b.csv": LANDED}


def test_tables_from_before_manifests_get_one(spark, layers, drops):
    drops("a.csv", csv_text(row("1")))
    ingest(spark, drops.folder, layers.landing, DAY1)
    files.delete(spark, landing.manifest_of(layers.landing).path)
    assert ingest(spark, drops.folder, layers.landing, DAY1) == 0
    assert states(layers)["a.csv"][:2] == (LANDED, 1)


def test_files_in_the_manifest_are_not_opened(spark, layers, drops, monkeypatch):
    drops("a.csv", csv_text(row("1")))
    drops("small.csv", csv_text())
    ingest(spark, drops.folder, layers.landing, DAY1)
    monkeypatch.setattr(headers, "headers_of", lambda spark, paths: {p: pytest.fail(p) for p in paths})
    monkeypatch.setattr(layers.landing, "read", lambda: pytest.fail("the landed rows were read"))
    assert ingest(spark, drops.folder, layers.landing, DAY2) == 0


def test_a_long_history_is_cut_by_a_runtime_filter(spark, tmp_path, settings, plan):
    manifest = Manifest(spark, str(tmp_path / "files"))
    manifest.append(spark.range(50_000).selectExpr(
        "concat('f', id) as path", "timestamp '2024-01-01' as modified", f"'{LANDED}' as state", "1L as rows",
        "cast(null as string) as reason", "'d' as batch"))
    spark.range(49_990, 50_010).selectExpr("concat('f', id) as path", "timestamp '2024-01-01' as modified").write.parquet(str(tmp_path / "listing"))
    listing = spark.read.parquet(str(tmp_path / "listing"))
    assert sorted(r.path for r in manifest.unseen(listing).collect()) == [f"f{n}" for n in range(50_000, 50_010)]
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0")
    slow = manifest.unseen(listing.filter("path > 'f4'"))
    assert "might_contain" in plan(slow).lower() and slow.count() == 10


def test_outcomes_decide_what_is_new(spark, tmp_path, rows):
    manifest = Manifest(spark, str(tmp_path / "files"))
    listing = spark.createDataFrame([(n, 2) for n in "abcd"], "path string, m int").selectExpr("path", "timestamp_seconds(m) as modified")
    assert manifest.unseen(listing).count() == 4 and manifest.unfinished(listing).count() == 0
    old = listing.first().modified.replace(second=0)
    now = listing.first().modified
    manifest.record([Outcome("a", old, LANDED, 1), Outcome("b", old, QUARANTINED), Outcome("c", now, SKIPPED, 0), Outcome("d", now, CLAIMED)])
    assert sorted(r.path for r in manifest.unseen(listing).collect()) == ["b", "d"]
    assert [r.path for r in manifest.unfinished(listing).collect()] == ["d"]


def test_rows_land_without_a_staged_copy(spark, layers, drops, monkeypatch):
    drops("a.csv", csv_text(row("1", Age="sixteen"), row("2")))
    staged, real = [], landing.staged
    monkeypatch.setattr(landing, "staged", lambda df, name: (staged.append(name), real(df, name))[1])
    assert ingest(spark, drops.folder, layers.landing, DAY1) == 1
    assert staged == ["bad-lines"]
    assert [r.Line.split(",")[0] for r in landing.rejects_of(layers.landing).read().collect()] == ["1"]


def test_compressed_drops_land_like_others(spark, layers, drops):
    with gzip.open(f"{drops.folder}/a.csv.gz", "wt", newline="") as file:
        file.write(csv_text(row("1", Name="Ann"), row("2")))
    assert ingest(spark, drops.folder, layers.landing, DAY1) == 1
    assert sorted((r.Student_ID, r.Name) for r in layers.landing.read().collect()) == [("1", "Ann"), ("2", "John Doe")]
    assert ingest(spark, drops.folder, layers.landing, DAY1) == 0
