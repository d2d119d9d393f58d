"""End-to-end capture over object folders: zstd PNGs, a manifest, ZIP intake."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from capture_lake.plans.capture import capture_files
from capture_lake.session import scratch_path
from conftest import png_bytes, zstd_bytes


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def make_zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for n, c in members:
            zf.writestr(n, c)
    return buf.getvalue()


def ocr_factory():
    # A stand-in recogniser: reads the image width from the header; one
    # NULL block and one short line to exercise the skips.
    def fn(png, box):
        w = int.from_bytes(png[16:20], "big")
        return [None, [{"text": f"w{w}", "confidence": 0.9}, {"text": "box", "confidence": 0.7}], []]
    return fn


def pdf_factory():
    def fn(b):
        if not b.startswith(b"%PDF"):
            raise ValueError("not a pdf")
        return b[4:].decode().split("\f")
    return fn


@pytest.fixture()
def bucket(spark):
    base = scratch_path(spark, "bucket").replace("file:", "")
    images, intake = f"{base}/images", f"{base}/intake"
    write(f"{images}/2024/01/01/a.png.zst", zstd_bytes(png_bytes(200, 100)))
    write(f"{images}/2024/01/01/b.png.zst", zstd_bytes(png_bytes(60, 40)))      # same hash as a: in-batch dup
    write(f"{images}/2024/01/01/c.png.zst", b"\x00" * 32)                      # corrupt frame
    write(f"{images}/2024/01/01/d.png.zst", zstd_bytes(b"plain text"))          # not an image
    write(f"{images}/2024/01/01/e.png.zst", zstd_bytes(png_bytes(30, 5)))       # already in target
    write(f"{images}/2024/01/01/f.png.zst", zstd_bytes(png_bytes(300, 200)))    # zip without pdf
    write(f"{images}/2024/01/01/notes.txt", b"skip me")
    write(f"{intake}/exam1.zip", make_zip([("readme.txt", b"r"), ("report.PDF", b"%PDF page one\f\f page two ")]))
    write(f"{intake}/exam2.zip", make_zip([("readme.txt", b"r")]))
    manifest = spark.createDataFrame([
        ("2024/01/01/a.png.zst", {"content-hash": "H1", "source-intake-key": "exam1.zip", "pdf-producer": "rl"}),
        ("2024/01/01/b.png.zst", {"content-hash": "H1"}),
        ("2024/01/01/c.png.zst", {"content-hash": "H3"}),
        ("2024/01/01/d.png.zst", {"content-hash": "H4"}),
        ("2024/01/01/e.png.zst", {"content-hash": "H5"}),
        ("2024/01/01/f.png.zst", {"content-hash": "", "source-intake-key": "exam2.zip", "image-width": "999"}),
    ], "key string, metadata map<string,string>")
    target = spark.createDataFrame([("H5", "/old")], "file_hash string, original_path string")
    return images, intake, manifest, target


def test_capture_files_end_to_end(spark, bucket):
    images, intake, manifest, target = bucket
    res = capture_files(spark, images, manifest, target, ocr_factory, pdf_factory, intake_root=intake, partitions=4)
    recs = {r.key: r for r in res.records.collect()}
    assert sorted(recs) == ["2024/01/01/a.png.zst", "2024/01/01/f.png.zst"]
    a = recs["2024/01/01/a.png.zst"]
    assert (a.file_hash, a.image_width, a.image_height) == ("H1", 200, 100)
    assert a.ocr_raw_text == "w200 box" and a.ocr_confidence_mean == pytest.approx(0.8)
    assert a.pdf_raw_text == "page one\n---\n page two" and a.pdf_producer == "rl" and a.pdf_creator == "unknown"
    assert a.processing_duration_ms >= 0 and a.processed_at is not None
    f = recs["2024/01/01/f.png.zst"]
    assert f.image_width == 999 and f.image_height == 200 and f.pdf_raw_text == ""  # metadata wins; no pdf
    quarantine = {r.key: r for r in res.quarantine.collect()}
    assert sorted(quarantine) == ["2024/01/01/c.png.zst", "2024/01/01/d.png.zst"]
    assert "ZstdError" in quarantine["2024/01/01/c.png.zst"].error
    assert "UnidentifiedImageError" in quarantine["2024/01/01/d.png.zst"].error
    assert quarantine["2024/01/01/c.png.zst"].label == "H3"
    status = {r.key: r.status for r in res.results.collect()}
    assert status["2024/01/01/b.png.zst"] == "duplicate" and status["2024/01/01/e.png.zst"] == "duplicate"
    o = res.outcome().first()
    assert (o.total, o.succeeded, o.files_extracted, o.rows_written) == (6, 4, 2, 2)


def test_interval_and_prefix_listing(spark, bucket):
    from capture_lake.sources.listing import list_objects
    images = bucket[0]
    assert list_objects(spark, images, suffix=".png.zst").count() == 6
    assert list_objects(spark, images).count() == 7
    assert list_objects(spark, images, prefix="2024/01/01/a").count() == 1
    assert list_objects(spark, images, start="2000-01-01", end="2000-01-02").count() == 0
    assert list_objects(spark, images, start="2000-01-01", end="2999-01-01").count() == 7
    plan = list_objects(spark, images, start="2000-01-01", end="2999-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "modificationTime" in plan and "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_run_single(spark, bucket):
    from capture_lake.plans.capture import run_single

    images, intake, manifest, target = bucket

    def job(keys):
        return capture_files(spark, images, manifest, target, ocr_factory, pdf_factory, intake_root=intake,
                             keys=keys)

    assert run_single(job, "2024/01/01/a.png.zst") == {"status": "ok", "key": "2024/01/01/a.png.zst", "rows": 1}
    assert run_single(job, "2024/01/01/e.png.zst")["rows"] == 0  # duplicate: success, no rows
    with pytest.raises(RuntimeError, match="ZstdError"):
        run_single(job, "2024/01/01/c.png.zst")
    with pytest.raises(RuntimeError, match="not found"):
        run_single(job, "2024/01/01/zzz.png.zst")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_rows(spark, images, manifest):
    from capture_lake.session import stored
    from capture_lake.sources import listing as L
    from capture_lake.sources import objects as O

    return stored(L.attach_metadata(O.list_objects(spark, images, suffix=L.CAPTURE_SUFFIX), manifest))


def test_bytes_are_never_exchanged_and_do_not_leave_the_extractor(spark, bucket):
    from capture_lake.plans.capture import assemble_payloads
    from capture_lake.sources import objects as O

    images, _, manifest, _ = bucket
    rows = stored_rows(spark, images, manifest)
    joined = O.read_payloads(rows, images)
    plan = plan_of(joined).split("\n")
    assert "content" not in "".join(l for l in plan if "Exchange" in l) and not any("Join" in l or "Union" in l for l in plan)
    assert joined.count() == 6
    small = O.read_payloads(rows, images, task_bytes=70_000)  # about a task per object, the same rows
    assert small.rdd.getNumPartitions() == 6
    assert sorted((r.key, bytes(r.content)) for r in small.collect()) == sorted((r.key, bytes(r.content)) for r in joined.collect())
    checked = assemble_payloads(joined, ocr_factory)
    out = [l for l in plan_of(checked).split("\n") if "MapInArrow" in l][0]
    returned = out.rsplit("[", 1)[-1]
    assert "__ocr_in" not in returned and "__img#" not in returned and "content" not in returned


def test_each_object_is_opened_once_whatever_its_time(spark):
    """Sixty objects of one modification time and a straggler, read by many tasks: one open each."""
    from capture_lake.sources import objects as O

    base = scratch_path(spark, "opens").replace("file:", "")
    for i in range(61):
        write(f"{base}/in/d{i % 7}/{i}.png.zst", b"x" * (100 + i))
        os.utime(f"{base}/in/d{i % 7}/{i}.png.zst", (1_700_000_000 - 10**8 * (i == 60),) * 2)
    rows = stored_rows(spark, f"{base}/in", spark.createDataFrame([], "key string, metadata map<string,string>"))
    opens = spark.sparkContext.accumulator(0)

    def read(path):
        opens.add(1)
        with open(path.removeprefix("file:"), "rb") as f:
            return f.read()

    got = O.read_payloads(rows, f"{base}/in", task_bytes=400_000, read=read).select("key", F.length("content").alias("n")).collect()
    assert sorted(r.n for r in got) == [100 + i for i in range(61)]
    assert opens.value == 61


def test_packs_are_even_by_bytes(spark):
    from capture_lake.session import stored
    from capture_lake.sources import objects as O

    rows = stored(spark.range(0, 5000, 1, 7).select(F.col("id").cast("string").alias("path"), (F.col("id") % 97 * 10_000).alias("size")))
    packs = O.in_packs(rows, 10_000_000).groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.col("size") + O.OPEN_BYTES).alias("w"), F.count("*").alias("n")).collect()
    total = sum(p.w for p in packs)
    assert sum(p.n for p in packs) == 5000
    assert len(packs) == -(-total // 10_000_000)
    assert max(p.w for p in packs) <= 11_100_000


def test_every_name_is_listed_level_by_level(spark):
    from capture_lake.sources import objects as O

    base = scratch_path(spark, "names").replace("file:", "")
    names = ["a.png.zst", "_x.png.zst", ".x/b.png.zst", "_d/e/.f.png.zst", "d/e/f/g/h.png.zst", "d/ä b[1].png.zst", "d.txt"]
    for n in names:
        write(f"{base}/in/{n}", n.encode())
    os.makedirs(f"{base}/in/empty/er")
    listed = {r.key: (r.size, r.path) for r in O.list_objects(spark, f"{base}/in").collect()}
    assert listed == {n: (len(n.encode()), f"file:{base}/in/{n}") for n in names}
    assert {r.key for r in O.list_objects(spark, f"file:{base}/in/", "d").collect()} == {n for n in names if n.startswith("d")}
    assert {r.key for r in O.list_objects(spark, f"{base}/in", "d/e/f/").collect()} == {"d/e/f/g/h.png.zst"}
    assert O.list_objects(spark, f"{base}/in", "nowhere/").count() == 0
    assert O.list_objects(spark, f"{base}/missing").count() == 0
    assert O.list_objects(spark, f"{base}/in", suffix=".png.zst", start="2000-01-01", end="2001-01-01").count() == 0
    manifest = spark.createDataFrame([], "key string, metadata map<string,string>")
    res = capture_files(spark, f"{base}/in", manifest, None, ocr_factory)
    assert {r.key for r in res.results.collect()} == {n for n in names if n.endswith(".png.zst")}


@pytest.mark.parametrize("names", [["a[1].png.zst"], ["a?.png.zst", "ab.png.zst"], ["{x}.png.zst", "x.png.zst"], ["a*.png.zst", "a b.png.zst"]])
def test_keys_are_not_globs(spark, names):
    base = scratch_path(spark, "globs").replace("file:", "")
    for i, name in enumerate(names):
        write(f"{base}/in[1]/{name}", zstd_bytes(png_bytes(10 + i, 9)))
    manifest = spark.createDataFrame([(names[0], {"content-hash": "H0"})], "key string, metadata map<string,string>")
    res = capture_files(spark, f"{base}/in[1]", manifest, None, ocr_factory)
    assert sorted((r.key, r.image_width) for r in res.records.collect()) == sorted((n, 10 + i) for i, n in enumerate(names))
    one = capture_files(spark, f"{base}/in[1]", manifest, None, ocr_factory, keys=[names[0]])
    assert [(r.key, r.file_hash) for r in one.records.collect()] == [(names[0], "H0")]


def test_vanished_object_is_a_failure(spark, bucket):
    from capture_lake.plans.capture import capture_rows, payload_process

    images, _, manifest, _ = bucket
    listing = stored_rows(spark, images, manifest)
    inner = payload_process(spark, images, ocr_factory)

    def process(rows):  # the object goes after it has been listed
        if os.path.exists(f"{images}/2024/01/01/f.png.zst"):
            os.remove(f"{images}/2024/01/01/f.png.zst")
        return inner(rows)

    res = capture_rows(listing, None, process)
    gone = {r.key: r.error for r in res.quarantine.collect()}
    assert gone["2024/01/01/f.png.zst"].startswith("FileNotFoundError")
    assert res.outcome().first().total == 6


def test_good_copy_behind_a_corrupt_one_is_written(spark):
    base = scratch_path(spark, "copies").replace("file:", "")
    write(f"{base}/a.png.zst", b"corrupt")
    write(f"{base}/b.png.zst", zstd_bytes(png_bytes(20, 10)))
    write(f"{base}/c.png.zst", zstd_bytes(png_bytes(20, 10)))
    for i, n in enumerate("abc"):
        os.utime(f"{base}/{n}.png.zst", (1_700_000_000 + i, 1_700_000_000 + i))
    manifest = spark.createDataFrame([(f"{n}.png.zst", {"content-hash": "H"}) for n in "abc"], "key string, metadata map<string,string>")
    res = capture_files(spark, base, manifest, None, ocr_factory)
    assert {r.key[0]: r.status for r in res.results.collect()} == {"a": "quarantine", "b": "ok", "c": "duplicate"}
    o = res.outcome().first()
    assert (o.total, o.succeeded, o.rows_written) == (3, 2, 1)


def test_duration_covers_slow_archives(spark, bucket):
    images, intake, manifest, target = bucket

    def slow_pdf():
        import time
        inner = pdf_factory()

        def fn(b):
            time.sleep(0.3)
            return inner(b)
        return fn

    res = capture_files(spark, images, manifest, target, ocr_factory, slow_pdf, intake_root=intake)
    spent = {r.key: r.processing_duration_ms for r in res.records.collect()}
    assert spent["2024/01/01/a.png.zst"] >= 300


def test_range_rules_can_be_left_to_reports(spark, bucket):
    images, _, _, _ = bucket
    zero = spark.createDataFrame([("2024/01/01/a.png.zst", {"content-hash": "H1", "image-height": "0"})], "key string, metadata map<string,string>")
    keys = ["2024/01/01/a.png.zst"]
    assert capture_files(spark, images, zero, None, ocr_factory, keys=keys).records.count() == 0
    assert capture_files(spark, images, zero, None, ocr_factory, keys=keys, enforce_rules=False).records.first().image_height == 0


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from capture_lake.session import shared_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)))


def test_capture_histograms(spark, bucket):
    images, intake, manifest, target = bucket
    res = capture_files(spark, images, manifest, target, ocr_factory, pdf_factory, intake_root=intake)
    conf = {r.le: r.value for r in res.confidence_histogram().collect() if r.series == "bucket"}
    assert conf["0.7"] == 0 and conf["0.8"] == 2 and conf["+Inf"] == 2
    dur = {r.series: r.value for r in res.duration_histogram().collect() if r.series != "bucket"}
    assert dur["count"] == 2


def test_ocr_runs_once_per_fresh_image(spark, bucket):
    images, intake, manifest, target = bucket
    calls = spark.sparkContext.accumulator(0)

    def counting_factory():
        inner = ocr_factory()

        def fn(png, box):
            calls.add(1)
            return inner(png, box)
        return fn

    res = capture_files(spark, images, manifest, target, counting_factory, pdf_factory, intake_root=intake)
    res.records.collect()
    res.quarantine.collect()
    res.outcome().collect()
    assert calls.value == 2  # a and f: duplicates and broken payloads never reach OCR


def test_prefix_pushed_into_listing_path(spark, bucket):
    from capture_lake.sources.listing import list_objects
    images = bucket[0]
    assert list_objects(spark, images, prefix="2024/01/0").count() == 7      # partial folder name
    assert list_objects(spark, images, prefix="2024/01/01/b").count() == 1
    assert list_objects(spark, images, prefix="2025/").count() == 0          # nothing there: empty, no error
    # only the prefix's objects are listed at all (before any filter)
    listed = list_objects(spark, images, prefix="2024/01/01/a").inputFiles()
    assert len(listed) == 1 and listed[0].endswith("2024/01/01/a.png.zst")
