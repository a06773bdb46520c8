"""Structured Streaming forms of the text-row jobs.

The original jobs read bounded files only; nothing here adds new operators.
It offers the same text-row source and per-year count over files that keep
arriving in a folder, with state and checkpoints kept by Spark in the shared
checkpoint folder so a restarted query resumes where it stopped.
"""

from tessera.streaming.songs import song_rows_stream, songs_per_year_stream

__all__ = ["song_rows_stream", "songs_per_year_stream"]
