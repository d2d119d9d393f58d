from __future__ import annotations

import os
import struct
import sys
import tempfile
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle  # noqa: E402


def pytest_collection_modifyitems(session, config, items):
    # Test modules define extractor factories; workers cannot import them,
    # so pickle their functions by value.
    for mod in {item.module for item in items if getattr(item, "module", None) is not None}:
        cloudpickle.register_pickle_by_value(mod)
    import extractors_fixture

    cloudpickle.register_pickle_by_value(extractors_fixture)


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from capture_lake.session import local_session, shared_dir

    s = local_session(cores="*", shuffle_partitions=8, app="capture_lake_tests")
    shared_dir(s)  # uses spark.checkpoint.dir when set, else a fresh temp folder
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="capture-lake-test-")


def png_bytes(width: int, height: int, rgb=(128, 64, 32)) -> bytes:
    """A minimal valid RGB PNG (test fixture; no imaging library needed)."""
    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + bytes(rgb) * width for _ in range(height))
    ihdr = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def zstd_bytes(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)
