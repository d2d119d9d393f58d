import json
import os

import pytest

from capture_lake import cli
from capture_lake.session import scratch_path
from conftest import png_bytes, zstd_bytes


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def setup(spark):
    base = scratch_path(spark, "cli").replace("file:", "")
    images, intake = f"{base}/images", f"{base}/intake"
    write(f"{images}/a.png.zst", zstd_bytes(png_bytes(40, 20)))
    write(f"{images}/b.png.zst", b"broken")
    import io
    import zipfile
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("r.pdf", b"%PDF hello")
    write(f"{intake}/x.zip", buf.getvalue())
    with open(f"{base}/manifest.json", "w") as f:
        f.write(json.dumps({"key": "a.png.zst", "metadata": {"content-hash": "HA", "source-intake-key": "x.zip"}}) + "\n")
        f.write(json.dumps({"key": "b.png.zst", "metadata": {"content-hash": "HB"}}) + "\n")
    return base, images, intake


def args_for(base, images, intake, table, *extra):
    return ["capture", "--images", images, "--manifest", f"{base}/manifest.json", "--intake", intake,
            "--table", table, "--warehouse", f"{base}/wh",
            "--ocr", "extractors_fixture:make_ocr", "--pdf", "extractors_fixture:make_pdf", *extra]


def last_line(capsys):
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_cli_batch_key_retry(spark, capsys):
    base, images, intake = setup(spark)
    table = "capture_lake_t.cli_records"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    parser = cli.build_parser()
    run = lambda *extra: cli.run(parser.parse_args(args_for(base, images, intake, table, *extra)), spark)
    write(f"{images}/_hidden/c.png.zst", b"x")  # listed like any other
    write(f"{images}/sub/.d.png.zst", b"x")
    assert run() == 0
    out = last_line(capsys)
    assert out["total"] == 4 and out["files_extracted"] == 1 and out["rows_written"] == 1
    os.remove(f"{images}/_hidden/c.png.zst")
    os.remove(f"{images}/sub/.d.png.zst")
    row = spark.table(table).first()
    assert (row.file_hash, row.ocr_raw_text, row.pdf_raw_text, row.image_width) == ("HA", "w40", "hello", 40)
    assert spark.read.parquet(f"{base}/wh/cli_records_quarantine").count() == 3  # kept without being asked for
    # single key: duplicate now (success, 0 rows); broken key fails the run
    assert run("--key", "a.png.zst") == 0
    assert last_line(capsys)["rows"] == 0
    assert run("--key", "b.png.zst") == 1
    # a second run over more objects counts its own writes only
    write(f"{images}/e.png.zst", zstd_bytes(png_bytes(12, 20)))  # no manifest row: no hash
    assert run() == 0
    out = last_line(capsys)
    assert (out["total"], out["succeeded"], out["rows_written"]) == (3, 2, 1)
    # fail, fix, retry, gone
    write(f"{images}/b.png.zst", zstd_bytes(png_bytes(50, 20)))
    assert run("--retry") == 0
    out = last_line(capsys)
    assert (out["total"], out["rows_written"]) == (1, 1)  # the removed ones are no longer listed
    assert run("--retry") == 0
    assert last_line(capsys)["total"] == 0
    spark.catalog.refreshTable(table)
    assert sorted(r.file_hash for r in spark.table(table).collect()) == ["", "HA", "HB"]
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_cli_stream(spark, capsys):
    base, images, intake = setup(spark)
    table = "capture_lake_t.cli_stream"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    parser = cli.build_parser()
    write(f"{images}/x/k.png.zst", zstd_bytes(png_bytes(33, 20)))
    run = lambda *extra: cli.run(parser.parse_args(args_for(base, images, intake, table, "--stream", "--available-now", *extra)), spark)
    assert run("--prefix", "a") == 0
    spark.catalog.refreshTable(table)
    assert [(r.file_hash, r.pdf_raw_text) for r in spark.table(table).collect()] == [("HA", "hello")]
    assert os.path.isdir(f"{base}/wh/cli_stream_checkpoint")  # the next application finds it
    capsys.readouterr()
    assert run("--prefix", "a") == 0  # nothing is read again
    assert "rows_written" not in capsys.readouterr().out
    # the broken one is logged as a failure
    assert run("--checkpoint", f"{base}/ck2") == 0
    failed = spark.read.parquet(f"{base}/wh/cli_stream_results").where("status = 'quarantine'")
    assert [r.key for r in failed.collect()] == ["b.png.zst"]
    spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("extra", [
    ["--stream", "--start", "2024-01-01", "--end", "2024-01-02"], ["--stream", "--key", "k"], ["--stream", "--retry"],
    ["--available-now"], ["--checkpoint", "c"], ["--retry", "--key", "k"], ["--start", "2024-01-01"],
])
def test_cli_rejects_options_a_mode_would_ignore(extra):
    with pytest.raises(SystemExit):
        cli.check_options(cli.build_parser().parse_args(args_for("b", "i", "n", "a.t", *extra)))
