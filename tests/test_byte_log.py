import random

import pytest

from tallyloom.sources import byte_log


def test_ranges_hold_every_line_once(tmp_path, monkeypatch):
    rng = random.Random(4)
    lines = [b"x" * rng.choice([0, 1, 5, 30, 200]) + "ș".encode() * rng.randrange(3) for _ in range(300)]
    for last in (b"", b"open end"):
        path = tmp_path / f"a{len(last)}.log"
        path.write_bytes(b"".join(x + b"\n" for x in lines) + last)
        store, size = byte_log.Store(str(path)), path.stat().st_size
        for step in (7, 64, 1 << 20):
            monkeypatch.setattr(byte_log, "STEP_BYTES", step)
            assert store.line_end(str(path), 0, size) == size - len(last)
            for width in (1, 13, 100, size):
                got = [x for r in byte_log.ranges({str(path): (0, size)}, width) for x in store.lines(r, True)]
                want = lines + ([last] if last else [])
                assert [x for _, x in got] == want
                assert [path.read_bytes()[o : o + len(x)] for o, x in got] == want


@pytest.fixture
def follow(spark, tmp_path):
    def run(logs, n, **options):
        stream = byte_log.follow_log(spark, str(logs), **options)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "progress"))
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
        rows = spark.read.schema(byte_log.SCHEMA).parquet(str(tmp_path / "rows")).collect()
        assert len(rows) == n
        return rows

    return run


def test_a_stream_reads_only_what_is_new(spark, tmp_path, follow, monkeypatch):
    logs = tmp_path / "logs"
    logs.mkdir()
    a, b = logs / "a.log", logs / "b.log"
    a.write_bytes(b"one\ntwo\nthr")
    rows = follow(logs, 2, range_bytes=4)
    assert [(r.offset, r.line) for r in sorted(rows, key=lambda r: r.offset)] == [(0, "one"), (4, "two")]
    # the part that has been read is spoilt: a second look at it would show
    with a.open("r+b") as f:
        f.write(b"ONE\nTWO\n")
    with a.open("ab") as f:
        f.write("ee\nvier ș\n".encode())
    b.write_bytes(b"b1\r\nb2\n\xff\n")
    rows = follow(logs, 7, range_bytes=5)
    assert sorted(r.line for r in rows) == sorted(["one", "two", "three", "vier ș", "b1", "b2", "�"])
    follow(logs, 7)
    a.write_bytes(b"new\n")  # replaced by a shorter file
    assert sum(r.line == "new" for r in follow(logs, 8)) == 1
    (logs / "_hidden.log").write_bytes(b"no\n")
    b.unlink()
    follow(logs, 8)


def test_batch_from_offsets(spark, tmp_path):
    path = tmp_path / "a.log"
    path.write_bytes(b"one\ntwo\nthree")
    got = lambda **o: sorted((r.offset, r.line) for r in byte_log.read_log(spark, str(path), **o).collect())
    assert got() == [(0, "one"), (4, "two"), (8, "three")] == got(range_bytes=3)
    assert got(offsets={str(path): 4}) == [(4, "two"), (8, "three")]
    assert got(offsets={str(path): 400}) == got()  # a shorter file was replaced
    path.write_bytes(b"")
    assert got() == []
    assert byte_log.read_log(spark, str(tmp_path / "none")).count() == 0
