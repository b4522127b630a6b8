import random
import re
from datetime import datetime, timedelta

from tallyloom.streaming import job_log

STAGES = ["download", "vad", "face", "asd", "asr", "export", "quality"]


def plain(lines):
    """Line by line, without state stores or windows."""
    s = {"stage": None, "done": set(), "errors": [], "opened": set(), "video": None, "position": 0, "total": 0, "exported": 0, "clip": 0, "clips": 0, "speakers": 0}
    seen, finished, failed, told = [], set(), set(), []

    def fresh(v):
        s.update(stage=None, done=set(), errors=[], opened=set(), clip=0, clips=0, video=v)
        if v not in seen:
            seen.append(v)

    find = lambda p, m: re.search(p, m, re.I | re.A)
    for m in lines:
        m = (m or "").strip()
        if x := find(r"Processing video\s+(\d+)/(\d+):\s*(\S+)", m):
            s.update(position=int(x[1]), total=int(x[2]))
            fresh(x[3])
            told.append(None)
            continue
        if find("Step 1:", m):
            x = find(r"video:\s*(\S+)", m)
            if x and x[1] != s["video"]:
                fresh(x[1])
            s["stage"] = "download"
            s["opened"].add("download")
            told.append("download")
            continue
        if find("Step 2:|Splitting video by VAD|existing clips found", m):
            if s["stage"] == "download":
                s["done"].add("download")
            s["stage"] = "vad"
            s["opened"].add("vad")
            told.append("vad")
            continue
        if find(r"Step 3:|Processing clips\.\.\.", m):
            if s["stage"] == "vad":
                s["done"].add("vad")
            s["stage"] = "face"
            s["opened"] |= {"face", "asd", "asr", "export"}
            told.append("face")
            continue
        if x := find(r"(\d+)\s+clips?\s+to\s+process", m):
            s["clips"] = int(x[1])
        for stage, p in [("face", r"\]\s*face detection"), ("asd", r"\]\s*(ASD scoring|SyncNet verification)"), ("asr", r"\]\s*transcribing"), ("export", r"\]\s*exporting LRS2"), ("quality", r"^(Speaker identity \[|Auto-set metadata for)")]:
            if find(p, m):
                s["stage"] = stage
                s["opened"].add(stage)
                if stage == "quality" and (x := find(r"→\s*(\d+)\s+speakers?", m)):
                    s["speakers"] += int(x[1])
                break
        if x := find(r"CLIP\s+(\d+)/(\d+)\s+(dropped|exported)", m):
            s.update(clip=int(x[1]), clips=int(x[2]))
            s["exported"] += x[3].lower() == "exported"
        if x := find(r"Exported\s+(\d+)\s+segments?", m):
            s["exported"] = s["exported"] or int(x[1])
            s["done"] |= {"face", "asd", "asr", "export"}
            if s["video"]:
                finished.add(s["video"])
        if x := find(r"Pipeline failed for\s+(\S+?)\s*:", m):
            failed.add(x[1])
            s["errors"].append(s["stage"] or "download")
            s["opened"].add(s["stage"] or "download")
        if find(r"Pipeline finished(?!\s+with\s+errors)|Process exited with code 0", m):
            s["done"] |= set(STAGES) - set(s["errors"])
        if find(r"Process exited with code [^0]|Pipeline finished with errors", m):
            if s["stage"] or not s["errors"]:
                s["errors"].append(s["stage"] or "download")
                s["opened"].add(s["stage"] or "download")
        told.append(s["stage"] or (s["errors"][0] if s["errors"] else None))
    listed = lambda k: [x for x in STAGES if x in s[k]]
    return (s["stage"], listed("done"), listed("errors"), listed("opened"), s["video"], s["position"], s["total"], len(seen), len(finished), len(failed), s["exported"], s["clip"], s["clips"], s["speakers"]), told


SOME = [
    "Processing video {n}/9: v_{v}", "Step 1: fetch video: v_{v}", "step 1: again", "Step 2: cut", "Splitting video by VAD", "12 existing clips found", "Step 3: go", "Processing clips...", "{n} clips to process", "1 clip to process",
    "[clip_1] face detection", "[clip_1] ASD scoring (3/5 tracks)...", "[c] SyncNet verification", "[c] transcribing", "[c] exporting LRS2", "Speaker identity [x] → {n} speakers", "Auto-set metadata for s", " Speaker identity [y]",
    "CLIP {n}/{v} dropped (short)", "CLIP {n}/{v} exported: ok", "Exported {n} segments", "Exported 0 segments", "clip {n}/3 EXPORTED: Exported 5 segments", "Pipeline failed for v_{v}: boom", "Pipeline failed for x: [c] transcribing",
    "Pipeline finished", "Pipeline finished with errors", "Process exited with code 0", "Process exited with code 1", "noise", None, "", "saved all", "error here",
]


def logs(n_jobs, seed):
    rng = random.Random(seed)
    weights = [rng.choice([1, 1, 3]) for _ in SOME]
    return {j: [t.format(n=rng.randrange(1, 6), v=rng.randrange(1, 5)) if t is not None else None for t in rng.choices(SOME, weights, k=rng.randrange(1, 40))] for j in range(n_jobs)}


def test_batch_equals_line_by_line(spark):
    held = logs(150, 7)
    rows = [(j, i, m) for j, lines in held.items() for i, m in enumerate(lines)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "job long, n long, msg string")
    got = {r.job: tuple(r)[1:] for r in job_log.fold(df, "job", "n").collect()}
    want = {j: plain(lines) for j, lines in held.items()}
    assert set(got) == set(want)
    for j in want:
        assert got[j] == want[j][0], held[j]
    stages = {(r.job, r.n): r.stage for r in job_log.feed(df, "job", "n").collect()}
    assert stages == {(j, i): s for j in want for i, s in enumerate(want[j][1])}
    assert job_log.fold(df.filter("false"), "job", "n").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    held, begin = logs(12, 9), datetime(2024, 1, 1)
    rows = [(j, i, begin + timedelta(seconds=i), m) for j, lines in held.items() for i, m in enumerate(lines)]
    schema = "job long, order long, at timestamp, msg string"
    top = max(map(len, held.values()))
    for k, (a, b) in enumerate([(0, 8), (8, 20), (5, 9), (20, top)]):  # the third file is late
        spark.createDataFrame([r for r in rows if a <= r[1] < b], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/f{k}")
    # and one job long after, which moves the watermark: others have fallen silent by then
    spark.createDataFrame([(99, 0, begin + timedelta(hours=1), "Step 1: x")], schema).coalesce(1).write.parquet(f"{tmp_path}/in/f4")
    out = []
    with job_log.state_store(spark):
        for k in range(5):  # a run for each file, from the checkpoint
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/f[0-{k}]")
            query = job_log.follow(stream).writeStream.foreachBatch(lambda df, epoch: out.extend(df.collect())).outputMode("update")
            query = query.option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
            query.awaitTermination()
    df = spark.createDataFrame(rows, schema)
    want = {r.job: tuple(r)[1:] for r in job_log.fold(df, "job", "order").collect()}
    last = {}
    for r in out:
        if not r.silent and r.job != 99:
            last[r.job] = r
    assert {j: tuple(r)[1:15] for j, r in last.items()} == want
    assert {j: r.late for j, r in last.items()} == {j: max(0, min(len(lines), 9) - 5) for j, lines in held.items()}
    over = lambda lines: bool(lines[-1]) and bool(re.search(r"pipeline finished|exited with", lines[-1], re.I))
    assert {r.job for r in out if r.silent} == {j for j, lines in held.items() if not over(lines)}


def test_bulk_import(spark):
    lines = ["[1/4] Importing: u1", "md_001 downloaded OK", "MD_001 downloaded ok", "[2/4] importing: u2", "md_002 download error: x", "download returned None", "download returned no path", "download returned None",
        "Already in CSV (same YouTube ID abc) : skipped", "Already in CSV (same YouTube ID abc): skipped", "Already in CSV as md_9: skipped", "noise", None]
    df = spark.createDataFrame([(1, i, m) for i, m in enumerate(lines)] + [(2, 0, "nothing yet")], "job long, n long, msg string")
    got = {r.job: tuple(r)[1:] for r in job_log.fold_imports(df, "job", "n").collect()}
    assert got == {1: (2, 4, 2, 3, 2, 7), 2: (0, 0, 0, 0, 0, 0)}


def test_a_batch_reads_and_writes_a_jobs_state_once():
    from pyspark.sql import Row

    class State:
        def __init__(self):
            self.held, self.calls = {}, 0

        def get(self):
            self.calls += 1
            return self.held.get(None)

        def update(self, value):
            self.calls += 1
            self.held[None] = value

        def getValue(self, key):  # noqa: N802
            self.calls += 1
            return self.held.get(key)

        def updateValue(self, key, value):  # noqa: N802
            self.calls += 1
            self.held[key] = value

    class Handle:
        now, videos, timers = State(), State(), []
        getValueState = lambda self, *a: self.now  # noqa: E731, N815
        getMapState = lambda self, *a: self.videos  # noqa: E731, N815
        listTimers = lambda self: self.timers  # noqa: E731, N815
        deleteTimer = lambda self, t: self.timers.remove(t)  # noqa: E731, N815
        registerTimer = lambda self, t: self.timers.append(t)  # noqa: E731, N815

    handle, log = Handle(), job_log.JobLog(1000)
    log.init(handle)
    lines = ["Processing video 1/2: a", "Step 1: video: a", "Step 2:", "Step 3:", "Exported 4 segments", "Pipeline failed for b: x"] * 50
    for start in (0, 300):
        told = list(log.handleInputRows((7,), iter([Row(order=start + i, msg=m, at_ms=5) for i, m in enumerate(lines)]), None))
        assert [(r.job, r.videos, r.finished, r.failed, r.exported, r.done, r.errors, r.late) for r in told] == [(7, 1, 1, 1, 4, ["download", "vad", "face", "asd", "asr", "export"], ["face"], 0)]
        assert handle.timers == [1005]
    assert handle.now.calls == 4 and handle.videos.calls == 4  # two videos written, then read and found the same
