"""Registered query: the streaming note statistics, driven to completion
over the notes derived from ``documents`` (staged as parquet files in the
shared checkpoint folder, read as a file stream)."""

from __future__ import annotations

import uuid

from wardline.plans.catalog import register
from wardline.plans.queries_text import SW
from wardline.plans.oracle_text import tokens_sql
from wardline.session import scratch_path
from wardline.sources.testdata import notes_view
from wardline.streaming.notes import latest_note_stats, start_note_stats


@register("stream_note_stats", f"""
    SELECT pid, MIN(chart_ts) AS first_ts, CAST(SUM(len({tokens_sql('text', SW)})) AS BIGINT) AS n_tokens,
           COUNT(*) AS n_notes FROM notes_f_v GROUP BY pid""")
def q_stream_note_stats(spark, sf_dir):
    notes = notes_view(spark, sf_dir)
    src = scratch_path(spark, "note-files")
    notes.write.parquet(src)
    name = f"note_stats_{uuid.uuid4().hex[:8]}"
    out = scratch_path(spark, "note-stats")
    q = start_note_stats(spark, src, notes.schema, name, SW, output_dir=out)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return latest_note_stats(spark, out)
