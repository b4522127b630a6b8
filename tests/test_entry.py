import ast
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.queries().keys() >= entry.oracle_sql().keys()
    if Path("/root/testdata/sf0.001").exists():
        assert entry.entry(spark).count() > 0


def test_nothing_else_imports_the_optional_subpackage():
    for path in (ROOT / "tallyloom").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        names = [n for x in ast.walk(ast.parse(path.read_text())) if isinstance(x, (ast.Import, ast.ImportFrom)) for n in ([a.name for a in x.names] if isinstance(x, ast.Import) else [x.module or ""])]
        assert not any(n.startswith(("tallyloom.llm", "corpus_pipeline")) for n in names), path


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no tables")
@pytest.mark.parametrize("name", [
    "video_stats", "training_funnel", "speaker_balance", "vocabulary", "interval_max_overlap", "cluster_components", "as_of", "review_state", "review_queues", "explorer_sorts", "video_payload", "segment_payload",
    "corpus_kpis", "overview_payload", "sentence_windows", "wer_turns", "best_lag", "one_euro", "gaussian_smooth", "stream_jobs", "log_state", "log_chunks", "annotation_files", "manifest_files", "csv_import", "recorded_drops",
    "trimmed_words", "drop_reasons", "clean_words", "sentence_ends", "content_hash", "outlier_labels", "cosine_top1", "duration_quantiles",
    "tier_quantiles", "region_balance", "distributions", "job_log_state", "job_log_feed", "import_state", "tail_lines", "turn_changes", "live_overview", "cosine_links", "vocab_fallback", "upsert_rows", "editable_upsert",
])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    con, where = duckdb.connect(), "/root/testdata/sf0.001"
    for p in Path(where).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    got = entry.queries()[name](spark, where)
    columns = sorted(got.columns)
    show = lambda rows: sorted(repr([round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r]) for r in rows)
    want = con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert show(got.select(columns).collect()) == show(want)
    assert sys.modules
