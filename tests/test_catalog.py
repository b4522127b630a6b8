from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import changelog, joins, stats, vocab
from tallyloom.sources import annotations, catalog
from tallyloom.streaming import streams

SEGMENTS = "segment_id string, video_id string, speaker_id string, duration double, asd_score double, wer double, tier string, review_status string"


@pytest.fixture
def segments(spark):
    return spark.createDataFrame([("s1", "v1", "a", 2.6, 8.4, 0.1, "A", "approved"), ("s2", "v1", "a", 3.0, 2.0, None, "B", ""), ("s3", "v1", "b", 1.0, 1.0, 0.2, "C", "rejected"), ("s4", "v2", "", 1.0, None, 0.0, "A", "approved")], SEGMENTS)


def test_views(segments):
    speakers = {r.speaker_id: r for r in stats.speaker_stats(segments).collect()}
    assert set(speakers) == {"a", "b"} and speakers["a"].total_duration == 5.6 and speakers["a"].total_segments == 2 and speakers["a"].avg_wer == 0.05
    fresh = {r.video_id: r for r in stats.fresh_video_stats(segments).collect()}
    assert (fresh["v1"].total_segments, fresh["v1"].tier_a, fresh["v1"].tier_c) == (2, 1, 0)
    assert stats.dataset_overview(segments).first().speakers == 3
    assert {r.video_id: r.validated for r in stats.videos_validated(segments).collect()} == {"v1": False, "v2": True}
    empty = segments.filter("false")
    assert stats.dataset_overview(empty).first().segments == 0 and stats.speaker_stats(empty).count() == 0


def test_vocabulary(spark):
    rec = spark.sql("SELECT 's1' segment_id, array(named_struct('word','BUNĂ','start',0D,'end',.5D), named_struct('word','BUNĂ','start',1D,'end',.9D)) words")
    text = spark.createDataFrame([("s2", "Vremea, vremea! azi", 3.0)], "segment_id string, text string, d double")
    got = {r.word: (r.samples, r.occurrences, r.duration) for r in vocab.vocabulary(vocab.recorded(rec), vocab.fallback(text, "text", "d")).collect()}
    assert got == {"BUNĂ": (1, 2, 0.5), "VREMEA": (1, 2, 2.0), "AZI": (1, 1, 1.0)}


def test_changelog(spark):
    cur = spark.createDataFrame([(1, "a", "w1"), (2, "b", None)], "k int, n string, words string")
    new = spark.createDataFrame([(2, "B", None), (3, "c", "w3")], "k int, n string, words string")
    assert {r.k: (r.n, r.words) for r in changelog.upsert(cur, new, "k", ["words"]).collect()} == {1: ("a", "w1"), 2: ("B", None), 3: ("c", "w3")}
    assert [r.k for r in changelog.insert_absent(cur, new.union(new), "k").collect()] == [3]
    assert {r.k: r.n for r in changelog.set_columns(cur, spark.createDataFrame([(1, "z")], "k int, n string"), "k").collect()} == {1: "z", 2: "b"}
    log = spark.createDataFrame([("s", 1, "approve", None), ("s", 2, "save", "t"), ("t", 1, "reject", None), ("t", 2, "revert", None)], "k string, at int, action string, text string")
    assert {r.k: (r.status, r.text, r.edited) for r in changelog.review_state(log, "k", "at").collect()} == {"s": ("approved", "t", 1), "t": ("", None, 0)}
    files = spark.createDataFrame([(f"b{i}",) for i in range(7)], "name string")
    assert sorted(r.name for r in changelog.newest_backups(files, "name").filter("expired").collect()) == ["b0", "b1"]
    jobs = spark.createDataFrame([(1, "running", "2024-01-01 00:00:00"), (2, "pending", "2024-01-01 00:00:00"), (3, "running", "2024-01-01 00:09:30")], "job_id int, status string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    state = changelog.job_states(jobs, "2024-01-01 00:10:00")
    assert {r.job_id: r.status for r in state.collect()} == {1: "interrupted", 2: "pending", 3: "running"}
    assert changelog.next_claim(state).count() == 0 and changelog.next_claim(state.filter("job_id < 3")).first().job_id == 2


def test_merge_and_orphans(spark):
    cur = spark.createDataFrame([(1, "", "x"), (2, "in", None)], "k int, env string, noise string")
    new = spark.createDataFrame([(1, "out", "y"), (2, "out", "low")], "k int, env string, noise string")
    fill = {(r.k, r.column): r.new for r in joins.merge_proposals(cur, new, "k", ["env", "noise"]).collect()}
    assert fill == {(1, "env"): "out", (2, "noise"): "low"}
    assert joins.merge_proposals(cur, new, "k", ["env", "noise"], overwrite=True).count() == 4
    assert {(r.k, r.side) for r in joins.orphans(cur, new.withColumn("k", F.col("k") + 1), "k").collect()} == {(1, "left"), (3, "right")}


def test_documents_round_trip(spark):
    fields = {"segment_id": "id", "start": "time.start", "end": "time.end", "wer": "wer.value"}
    rows = spark.createDataFrame([("a", 1.0, 2.0, 0.0), ("b", None, 3.0, 0.5)], "segment_id string, start double, end double, wer double")
    docs = catalog.to_documents(rows, fields, {"wer": 0.0})
    assert docs.select("wer.value").first()[0] is None
    assert catalog.differences(rows, catalog.to_rows(docs, fields, {"wer": 0.0})).count() == 0
    words = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y")], "k string, i int, word string")
    back = catalog.word_rows(catalog.embed_words(words, "k", "i", ["word"]), "k").orderBy("word_index").collect()
    assert [(r.word_index, r.word) for r in back] == [(0, "y"), (1, "x")]


def test_annotation_round_trip(spark, tmp_path):
    content = "Text:  BUNA SEARA\nOriginal:  BUNA\nConf:  3\nWORD START END ASDSCORE\nBUNA 0.00 0.40 9.5\nSEARA 0.50 1.00 8.0"
    got = annotations.parse(spark.createDataFrame([("f", content)], "path string, content string"))
    row = got.first()
    assert (row.text, row.original, row.conf, len(row.words), row.words[1].score) == ("BUNA SEARA", "BUNA", 3, 2, 8.0)
    assert got.select(annotations.render()).first()[0] == content
    loose = annotations.parse(spark.createDataFrame([("f", "A 0 1 2\nnot four")], "path string, content string"))
    assert len(loose.first().words) == 1 and annotations.parse(spark.createDataFrame([("f", "A 0 1 2")], "path string, content string"), True, 2).first().words == []
    annotations.write(got, str(tmp_path / "out"), "path")
    assert annotations.parse(annotations.read(spark, str(tmp_path / "out"))).first().text == "BUNA SEARA"


def test_files(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v/a.json").write_text('{"s1": {"status": "approved", "trimmed": true}, "s2": {"status": "odd"}}')
    verdicts = catalog.read_verdicts(spark, str(tmp_path / "v/a.json"))
    assert {r.segment_id: (r.status, r.trimmed) for r in verdicts.collect()} == {"s1": ("approved", 1), "s2": ("", 0)}
    current = spark.createDataFrame([("s1", ""), ("s3", "")], "segment_id string, review_status string")
    assert catalog.import_verdicts(current, verdicts).count() == 1
    lines = spark.createDataFrame([("http://x",), ("md_001 http://y",), ("# no",), ("",)], "value string")
    assert [(r.video_id, r.url) for r in catalog.import_lines(lines).collect()] == [(None, "http://x"), ("md_001", "http://y")]
    rows = spark.createDataFrame([("a", 1), ("b", None), ("c", 0)], "k string, flag int")
    catalog.export_csv(rows, str(tmp_path / "csv"), ["flag"])
    assert {r.k: r.flag for r in catalog.read_csv(spark, str(tmp_path / "csv"), "k string, flag string").collect()} == {"a": "True", "b": None, "c": "False"}
    catalog.backup({"rows": rows}, str(tmp_path / "bak"))
    assert catalog.differences(rows, catalog.restore(spark, str(tmp_path / "bak"), {"rows": rows.schema})["rows"]).count() == 0
    assert catalog.listing(spark, str(tmp_path / "v")).count() == 1
    clips = spark.sql("SELECT 'v' video_id, 'c' clip_id, 0 clip_index, 0D start, 1D end, 0D content_start, 'media' boundary_start_type, 'media' boundary_end_type, '' audio_speaker_label, array(named_struct('raw','a','clean','A','start',0.12345D,'end',1D,'conf',1D,'spk','S')) words")
    catalog.manifests(clips).write.json(str(tmp_path / "man"))
    read = catalog.read_manifests(spark, str(tmp_path / "man"), "v")
    assert read.first().words[0].start == 0.123 and catalog.read_manifests(spark, str(tmp_path / "man"), "w").count() == 0


def test_streams_equal_batch(spark, tmp_path):
    rows = spark.sql("SELECT id, CAST(id % 3 AS BIGINT) user_id, timestamp_micros(id * 600000000) at, CAST(id AS DOUBLE) value FROM range(60)")
    rows.repartition(4).write.parquet(str(tmp_path / "in.parquet"))
    s = streams.source(spark, str(tmp_path / "in.parquet"), max_files=1)
    out = streams.drained(streams.tumbling(s, "at", "1 hour", "user_id", late="1 day"), str(tmp_path / "w"), "complete")
    assert catalog.differences(out.select("start", "user_id", "n", "total"), streams.tumbling(rows, "at", "1 hour", "user_id")).count() == 0
    assert streams.drained(streams.once(s, "at", "30 days", "user_id").select("user_id"), str(tmp_path / "o")).count() == 3
    assert streams.sessions(rows, "at", "1 hour", "user_id").count() == 3


def test_log_state(spark):
    lines = ["Processing video 1/2: md_001", "Step 1: Downloading video: md_001", "Step 2: splitting", "error: x", "Processing video 2/2: md_002"]
    got = streams.log_state(spark.createDataFrame([("j", i, m) for i, m in enumerate(lines)], "job string, i int, msg string"), "job", "i").first()
    assert (got.videos, got.current_video, got.stage, got.position, got.total, got.errors) == (2, "md_002", None, 2, 2, 1)


def test_fresh_paths_are_cleared(spark):
    from tallyloom import session

    path = session.fresh_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert session.clear_fresh(spark) >= 1 and not Path(path.removeprefix("file://")).exists() and session.clear_fresh(spark) == 0


def test_import_lines_query_with_odd_addresses(spark, tmp_path):
    from tallyloom.queries import QUERIES

    pages = [(1, "http://x"), (3, "http://x"), (2, "http://y"), (4, "http://y"), (6, "a b+c%20"), (7, "# z"), (8, None), (9, ""), (5, "http://x"), (10, "http://y")]
    spark.createDataFrame(pages, "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, QUERIES["import_lines"](spark, str(tmp_path)).collect()))
    assert got == sorted((i, f"md_{i}" if i % 2 == 0 else None, url) for i, url in pages if i % 5)
